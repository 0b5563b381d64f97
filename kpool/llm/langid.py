"""Language of web pages by fusing evidence as a Bayesian would.

Evidence of a page: its visible text, the language its markup declares, and
its host.  Everything is learned from whole tables by grouped aggregation:

* *text*: byte trigrams, hashed to ``BUCKETS`` cells, counted per language
  over all labelled texts (``BUCKETS`` x languages numbers, whatever the
  input); a page's log-likelihood is tempered, as trigrams are not
  independent;
* *declared language*: how often each declaration comes with each language,
  smoothed; a wrong or default declaration loses weight by itself;
* *host prior*: shares of languages per host, smoothed towards those of its
  parent domain, these towards those of the address suffix, these towards all
  pages'.  Counts come from the text's posterior, so a host's many pages speak
  for its few doubtful ones.

The posterior is proportional to prior x declaration x tempered text.

Defined cases: null HTML has no text and no declaration, a null URL an empty
host; such pages rest on what is left, in the end on the shares of all pages.
Ties go to the language that comes first in the alphabet.  Without labelled
texts the language is null.  Ids play no part; repeated rows get equal results.
"""

from __future__ import annotations

import html as markup
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpool.llm._io import cut, ship, text_bytes
from kpool.llm.urls import address

BUCKETS = 1 << 15
TEMPER = 0.25  # weight of a trigram beside independent evidence
MOST = 400.0  # cap on a page's log-likelihood ratio, so that no text outweighs all doubt

_MARK = re.compile(r"(?ai)<(?:(script|style|template|noscript|/?nav)(?=[\s/>])[^>]*(?:>|\Z)|!--)")
_END = {name: re.compile(rf"(?ai)</{name}(?=[\s/>])[^>]*(?:>|\Z)") for name in ("script", "style", "template", "noscript")} | {"": re.compile("-->")}
_TAG = re.compile(r"(?s)<[^>]*(>|\Z)")
_LANG = re.compile(r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,8})")

_CLASS = np.arange(256, dtype=np.uint32)
_CLASS[65:91] += 32  # A-Z
for _low, _high in ((0, 65), (91, 97), (123, 128)):
    _CLASS[_low:_high] = 32  # digits, marks and white space are gaps


def trigrams(data: bytes) -> np.ndarray:
    """Cells of the byte trigrams of a text, A-Z lower-cased, runs of other
    ASCII marks taken as one gap."""
    x = _CLASS[np.frombuffer(b" " + data + b" ", np.uint8)]
    x = x[(x != 32) | (np.append(0, x[:-1]) != 32)]
    if len(x) < 3:
        return np.empty(0, np.uint32)
    return ((x[:-2] << 16 | x[1:-1] << 8 | x[2:]) * np.uint32(2654435761)) >> np.uint32(17)


def _without_hidden(page: str) -> str:
    """A page without comments, scripts, styles, templates and navigation.

    What is never closed hides the rest of the page, as a browser has it, but
    not ``nav`` and ``noscript``.  An end of ``nav`` closes the last one open.
    """
    parts, at, navs, unclosed = [], 0, [], False
    while mark := _MARK.search(page, at):
        parts.append(page[at:mark.start()])
        at, name = mark.end(), (mark[1] or "").lower()
        if name == "nav":
            navs.append(len(parts))
        elif name == "/nav":
            if navs:
                del parts[navs.pop():]
        elif name == "noscript" and unclosed:
            continue
        elif end := _END[name].search(page, at):
            at = end.end()
        elif name == "noscript":
            unclosed = True
        else:
            return " ".join(parts)
    return " ".join([*parts, page[at:]])


def visible_text(page: str) -> str:
    return markup.unescape(_TAG.sub(" ", _without_hidden(page)))


def declared_language(page: str) -> str | None:
    found = _LANG.search(page)
    return found[1].lower() if found else None


def trigram_counts(texts: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, cell, n) over all texts; each task sends one row per language and cell."""

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for data, name in zip(batch.column(0), batch.column(1).to_pylist()):
                got = sums.setdefault(name, np.zeros(BUCKETS, np.int64))
                got += np.bincount(trigrams(data.as_py()), minlength=BUCKETS)
        for name, got in sums.items():
            cells = np.flatnonzero(got)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(cells), pa.string()), pa.array(cells.astype(np.int32)), pa.array(got[cells])], names=["lang", "cell", "n"])

    rows = texts.filter(F.col(lang).isNotNull()).select(text_bytes(text).alias("data"), F.col(lang).cast("string"))
    return rows.mapInArrow(count, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))


class TextModel:
    def __init__(self, counts: list[tuple[str, int, int]], smooth: float = 0.5):
        self.langs = sorted({c[0] for c in counts})
        table = np.full((len(self.langs), BUCKETS), smooth)
        at = {name: i for i, name in enumerate(self.langs)}
        for name, cell, n in counts:
            table[at[name], cell] += n
        self.log_p = np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32) if self.langs else table

    def likelihoods(self, data: bytes) -> np.ndarray:
        """Tempered log-likelihood per language, 0 for the likeliest."""
        total = TEMPER * self.log_p[:, trigrams(data)].sum(axis=1, dtype=np.float64)
        return np.maximum(total - total.max(initial=-np.inf), -MOST)


def fit_text_model(texts: DataFrame, text: str = "text", lang: str = "lang") -> TextModel:
    return TextModel([tuple(r) for r in trigram_counts(texts, text, lang).collect()])  # at most languages x BUCKETS


def page_evidence(pages: DataFrame, model: TextModel, id_col: str, url: str, html: str) -> DataFrame:
    """id, host and its ancestors, declared language, log-likelihoods."""
    host, _ = address(url)

    def read(batches):
        for batch in batches:
            declared, scores = [], []
            for page in batch.column("_html").to_pylist():
                page = page or ""
                declared.append(declared_language(page))
                scores.append(model.likelihoods(visible_text(page).encode()))
            flat = pa.array(np.concatenate(scores) if scores else np.empty(0))
            ends = pa.array(np.arange(len(scores) + 1, dtype=np.int32) * len(model.langs))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("host"), pa.array(declared, pa.string()), pa.ListArray.from_arrays(ends, flat)],
                                             names=["_id", "host", "declared", "text"])

    rows = pages.select(F.col(id_col).alias("_id"), host.alias("host"), F.col(html).alias("_html"))
    kind = rows.schema["_id"].dataType.simpleString()
    rows = rows.mapInArrow(read, f"_id {kind}, host string, declared string, text array<double>")
    parts = F.split("host", "\\.")
    return rows.withColumns({"suffix": F.element_at(parts, -1), "parent": F.array_join(F.slice(parts, F.greatest(F.lit(1), F.size(parts) - 1), 2), ".")})


def _normal(logs: Column) -> Column:
    """Probabilities of an array of log weights."""
    top = F.array_max(logs)
    odds = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(odds, lambda x: x / F.aggregate(odds, F.lit(0.0), lambda a, b: a + b))


def _sums(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Summed posterior per language of each group."""
    return rows.groupBy(*keys).agg(F.array(*(F.sum(F.col("p")[i]) for i in range(n))).alias("c"))


def _smoothed(counts: Column, parent: Column, strength: float) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)
    return F.zip_with(counts, parent, lambda c, q: (c + strength * q) / (total + strength))


def identify_language(pages: DataFrame, texts: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html", text: str = "text",
                      lang: str = "lang", strength: float = 10.0, doubt: float = 1.0) -> DataFrame:
    """One row per page: id, lang, p (its posterior), text_lang (by text alone), declared, host."""
    ship(pages.sparkSession)
    model = fit_text_model(texts, text, lang)
    n, names = len(model.langs), F.array(*map(F.lit, model.langs)).cast("array<string>")
    none = F.lit(None).cast("string")
    evidence = page_evidence(pages, model, id_col, url, html)
    if not n:
        return evidence.select(F.col("_id").alias(id_col), none.alias("lang"), F.lit(None).cast("double").alias("p"), none.alias("text_lang"), "declared", "host")
    rows = cut(evidence.withColumn("p", _normal(F.col("text"))))

    # shares of languages: all pages, suffix, parent domain, host; each smoothed towards the one before
    hosts = cut(_sums(rows, ["suffix", "parent", "host"], n))
    fold = lambda keys: hosts.groupBy(*keys).agg(F.array(*(F.sum(F.col("c")[i]) for i in range(n))).alias("c"))
    whole = fold([]).first()["c"] or [0.0] * n  # one row
    base = F.array(*(F.lit((c + 1.0) / (sum(filter(None, whole)) + n)) for c in (x or 0.0 for x in whole)))
    at_suffix = fold(["suffix"]).select("suffix", _smoothed(F.col("c"), base, strength).alias("q1"))
    at_parent = fold(["suffix", "parent"]).join(at_suffix, "suffix").select("suffix", "parent", _smoothed(F.col("c"), F.col("q1"), strength).alias("q2"))
    prior = hosts.join(at_parent, ["suffix", "parent"]).select("host", _smoothed(F.col("c"), F.col("q2"), strength).alias("prior"))

    # how likely a declaration is with each language (none declared counts as a declaration)
    said = F.coalesce("declared", F.lit(""))
    table = cut(_sums(rows.withColumn("said", said), ["said"], n))
    sums = table.agg(F.count("*"), *(F.sum(F.col("c")[i]) for i in range(n))).first()
    with_lang = table.select("said", F.array(*((F.col("c")[i] + doubt) / (float(sums[1 + i] or 0.0) + doubt * (sums[0] + 1)) for i in range(n))).alias("d"))

    rows = rows.withColumn("said", said).join(prior, "host").join(with_lang, "said")
    logs = F.zip_with(F.zip_with("prior", "d", lambda a, b: F.log(a) + F.log(b)), "text", lambda a, b: a + b)
    rows = rows.withColumn("post", _normal(logs))
    first = lambda c: F.element_at(names, F.array_position(c, F.array_max(c)).cast("int"))
    return rows.select(F.col("_id").alias(id_col), first(F.col("post")).alias("lang"), F.array_max("post").alias("p"), first(F.col("p")).alias("text_lang"), "declared", "host")
