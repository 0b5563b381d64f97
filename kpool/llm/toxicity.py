"""Toxicity scores: a learned lexicon, fuzzy look-up, context and a classifier.

1. *Lexicon.*  From at most ``sample`` labelled texts (those of least hash; a
   documented bound), one for each least shingle hash so that near copies
   count once, words are counted by grouped aggregation; those significantly
   more common in toxic texts are the lexicon's terms, each with its log-odds.
2. *Look-up.*  The terms form a trie.  A word's Levenshtein automaton
   (bit-parallel, one edit from 5 letters on, two from 9 on) is run over the
   trie, so all terms within reach are met in one walk.  Near spellings that
   the sample holds get log-odds of their own, so ordinary words that happen
   to lie near a term count for little.
   A token that is no term and holds more than letters is looked up by its
   runs of letters too, as the lexicon is learned from them.
3. *Context.*  Around each hit a window of words is scored: quotation marks and
   words of report lower it (quotation), second persons raise it (abuse).
4. *Score.*  A logistic regression over these sums, fitted on the sample, gives
   the score of every whole text.

Labels, language, source and id are no inputs of a score.  Defined cases: null
and empty texts are scored as texts without hits.  A document labelled more
than once is toxic if any label says so; null labels are ignored.  Without
labels, or with labels of one class, the score is that class's share (0 if
there is none).  A null id is never held out; repeated rows score equally.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from kpool.llm._io import cut, Scratch, ship

EDGE = "\"'`.,;:!?()[]{}<>*_~#$%&|-‘’“”«»…"
QUOTES = frozenset("\"“”«»`")
REPORT = frozenset("said says called calling word words term quote quoted quoting wrote write means meaning phrase insult slur".split())
SECOND = frozenset("you your you're youre yours u ur yourself".split())
LONG = 80  # letters of the longest token kept between texts
LETTERS = re.compile(r"[^\W\d_]+")
SPAN = 6  # words looked at on either side of a hit
FEATURES = ("plain", "quoted", "near", "near_quoted", "addressed", "density", "any")


#: a word with the quotation marks around it, and its (weight, exact) if it is a hit
Piece = tuple[str, tuple[float, bool] | None]


def edits_allowed(length: int) -> int:
    return 0 if length < 5 else 1 if length < 9 else 2


class Lexicon:
    """Terms in a trie, and look-up of words by intersection with their
    Levenshtein automata."""

    def __init__(self, terms: dict[str, float], variants: dict[str, float] | None = None, unseen: float = 1.0, limit: int = 700_000):
        self.terms, self.variants, self.unseen, self.limit = dict(terms), dict(variants or {}), unseen, limit
        self.trie: dict = {}
        for term in self.terms:
            node = self.trie
            for c in term:
                node = node.setdefault(c, {})
            node[""] = term
        # A word within k edits of a term holds one of the term's k + 1 pieces
        # unchanged: the first at its start, the last at its end, or one between.
        self.heads, self.tails, self.middles = defaultdict(set), defaultdict(set), defaultdict(set)
        for term in self.terms:
            if k := edits_allowed(len(term)):
                cuts = [len(term) * i // (k + 1) for i in range(k + 2)]
                first, *between, last = [term[x:y] for x, y in zip(cuts, cuts[1:])]
                self.heads[len(first)].add(first)
                self.tails[len(last)].add(last)
                for piece in between:
                    self.middles[len(piece)].add(piece)
        self.lengths = {n for t in self.terms if (k := edits_allowed(len(t))) for n in range(len(t) - k, len(t) + k + 1)}
        self.seen: set[str] = set()
        self.hits: dict[str, list[Piece]] = {}

    def __getstate__(self):
        return self.terms, self.variants, self.unseen, self.limit

    def __setstate__(self, state):
        self.__init__(*state)

    def within(self, word: str, edits: int) -> list[tuple[int, str]]:
        """(distance, term) for all terms at most ``edits`` from ``word``.

        ``rows[e]`` is the set of the word's positions reachable with at most e
        edits, as bits; one step reads a trie letter.
        """
        masks: dict[str, int] = defaultdict(int)
        for i, c in enumerate(word):
            masks[c] |= 1 << i
        full, top = 1 << len(word), (2 << len(word)) - 1
        start = [(2 << e) - 1 & top for e in range(edits + 1)]
        found, stack = [], [(self.trie, start)]
        while stack:
            node, rows = stack.pop()
            for c, child in node.items():
                if c == "":
                    found += [(e, child) for e, r in enumerate(rows) if r & full][:1]
                    continue
                mask, before, new = masks.get(c, 0), 0, []
                for e, r in enumerate(rows):
                    to = (r & mask) << 1  # the letter fits
                    if e:  # term letter added, changed, or word letter left out
                        to |= before | before << 1 | new[e - 1] << 1
                    new.append(to & top)
                    before = r
                if new[-1]:
                    stack.append((child, new))
        return sorted(found)

    def near(self, core: str) -> tuple[int, str] | None:
        """The nearest term within the edits allowed for the term's length."""
        if core in self.terms:
            return 0, core
        n = len(core)
        if n not in self.lengths or not self._may_be_near(core, n):
            return None
        return next(((e, t) for e, t in self.within(core, 2 if n >= 7 else 1) if e <= edits_allowed(len(t))), None)

    def _may_be_near(self, core: str, n: int) -> bool:
        for size, pieces in self.heads.items():
            if core[:size] in pieces:
                return True
        for size, pieces in self.tails.items():
            if core[-size:] in pieces:
                return True
        for size, pieces in self.middles.items():
            for i in range(1, n - size):
                if core[i:i + size] in pieces:
                    return True
        return False

    def hit(self, token: str) -> tuple[float, bool] | None:
        """(weight, exact) of a token with marks around it, or None."""
        core = token.strip(EDGE)
        if not 3 <= len(core) <= 40 or (found := self.near(core)) is None:
            return None
        weight = self.terms[found[1]] if found[0] == 0 else self.variants.get(core, self.unseen)
        return (weight, found[0] == 0) if weight > 0 else None

    def pieces(self, token: str) -> list[Piece] | None:
        """The token as one hit, or its runs of letters if a hit is among them."""
        whole = self.hit(token)
        if not (whole and whole[1] or token.strip(EDGE).isalpha()):
            runs, at = [], 0
            for run in LETTERS.finditer(token):
                runs.append((_quotes(token[at:run.start()]) + run[0], self.hit(run[0])))
                at = run.end()
            if any(got and (got[1] or not whole) for _, got in runs):
                runs[-1] = runs[-1][0] + _quotes(token[at:]), runs[-1][1]
                return runs
        return [(token, whole)] if whole else None

    def hits_among(self, tokens: set[str]) -> dict[str, list[Piece]]:
        """Pieces of a text's distinct tokens that hold hits; tokens met before
        are not looked up again, long ones are not kept."""
        if len(self.seen) > self.limit:
            self.seen, self.hits = set(), {}
        long = {}
        for token in tokens - self.seen:
            got = self.pieces(token)
            if len(token) <= LONG:
                self.seen.add(token)
            if got is not None:
                (self.hits if len(token) <= LONG else long)[token] = got
        return {t: self.hits[t] for t in tokens & self.hits.keys()} | long

    def features(self, text: str | None) -> list[float]:
        tokens = (text or "").lower().split()
        hits = self.hits_among(set(tokens))
        if not hits:
            return [0.0] * len(FEATURES)
        sums = dict.fromkeys(FEATURES, 0.0)
        pieces = [p for t in tokens for p in hits.get(t) or ((t, None),)]
        words = [p[0] for p in pieces]
        for i, (word, hit) in enumerate(pieces):
            if hit is None:
                continue
            weight, exact = hit
            around = words[max(0, i - SPAN):i], words[i + 1:i + 1 + SPAN]
            quoted = self._quoted(word, *around)
            sums[("quoted" if quoted else "plain") if exact else ("near_quoted" if quoted else "near")] += weight
            if not quoted and any(w.strip(EDGE) in SECOND for side in around for w in side):
                sums["addressed"] += weight
        loud = sums["plain"] + sums["near"]
        return [math.log1p(sums[k]) for k in FEATURES[:5]] + [math.log1p(100 * loud / len(words)), float(sums["plain"] > 0)]

    @staticmethod
    def _quoted(token: str, before: list[str], after: list[str]) -> bool:
        """Within marks of quotation, or named by a word of report."""
        lead, tail = token[:len(token) - len(token.lstrip(EDGE))], token[len(token.rstrip(EDGE)):]
        opened = bool(QUOTES & set(lead)) or sum(c in QUOTES for w in before for c in w) % 2 == 1
        closed = bool(QUOTES & set(tail)) or any(c in QUOTES for w in after for c in w)
        return opened and closed or any(w.strip(EDGE) in REPORT for w in before[-3:])


def _quotes(marks: str) -> str:
    return "".join([c for c in marks if c in QUOTES])


def _one_of_copies(texts: DataFrame, shingle: int = 4) -> DataFrame:
    """One text for each least shingle hash, which near copies mostly share."""

    def sketch(batches):
        from xxhash import xxh64_intdigest

        for batch in batches:
            least = []
            for value in batch.column("_text").to_pylist():
                words = (value or "").lower().encode().split()
                least.append(min((xxh64_intdigest(b" ".join(words[i:i + shingle])) for i in range(max(1, len(words) - shingle + 1)))) - (1 << 63))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least, pa.int64())], names=["_text", "_toxic", "_sketch"])

    marked = texts.mapInArrow(sketch, "_text string, _toxic int, _sketch long")
    first = F.row_number().over(W.partitionBy("_sketch").orderBy(F.xxhash64("_text"), F.desc("_toxic")))
    return marked.withColumn("_nth", first).filter("_nth = 1").select("_text", "_toxic")


def vocabulary(texts: DataFrame, text: str, toxic: str) -> DataFrame:
    """word, toxic and other texts that hold it."""

    def count(batches):
        for batch in batches:
            words, marks = [], []
            for value, mark in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = set(LETTERS.findall((value or "").lower()))
                words += own
                marks += [mark] * len(own)
            if words:
                yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(marks, pa.int32())], names=["word", "toxic"])

    rows = texts.select(F.col(text), F.col(toxic).cast("int")).mapInArrow(count, "word string, toxic int")
    return rows.groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))


def learn_lexicon(words: DataFrame, n_bad: int, n_good: int, ratio: float = 8.0, size: int = 1000) -> Lexicon:
    """Words whose likelihood-ratio statistic for 'more common in toxic texts'
    passes a test corrected for the number of words, and that are ``ratio``
    times as common there; the ``size`` strongest if there are more."""
    odds = F.log((F.col("bad") + 0.5) / (n_bad + 1)) - F.log((F.col("good") + 0.5) / (n_good + 1))
    share, seen = n_bad / (n_bad + n_good), F.col("bad") + F.col("good")
    part = lambda n, p: F.when(n > 0, n * F.log(n / (seen * p))).otherwise(0.0)
    rows = words.withColumn("odds", odds).withColumn("test", 2 * (part(F.col("bad"), share) + part(F.col("good"), 1 - share)))
    limit = 2 * math.log(max(10, 10 * words.count()))
    strong = rows.filter((F.col("test") >= limit) & (F.col("odds") >= math.log(ratio)) & (F.length("word") >= 3))
    terms = {r["word"]: r["odds"] for r in strong.orderBy(F.desc("test"), "word").limit(size).collect()}
    lexicon = Lexicon(terms)

    def alike(batches):
        for batch in batches:
            yield batch.filter(pa.array([w not in terms and 3 <= len(w) <= 40 and lexicon.near(w) is not None for w in batch.column("word").to_pylist()], pa.bool_()))

    # words of the sample near a term: few, as terms are few and edits at most two
    variants = {r["word"]: r["odds"] for r in rows.select("word", "odds").mapInArrow(alike, "word string, odds double").collect()} if terms else {}
    seen = sorted(terms.values())
    return Lexicon(terms, variants, unseen=seen[len(seen) // 2] / 2 if seen else 1.0)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights (constant first) by Newton steps on the ridge-penalised likelihood."""
    x = np.column_stack([np.ones(len(x)), x])
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out(id_col: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
                   sample: int = 20_000, ridge: float = 1.0, lexicon_size: int = 1000) -> DataFrame:
    """One row per document: id, held_out, score, predicted.

    Learned from at most ``sample`` labelled rows; the lexicon holds the
    ``lexicon_size`` terms that tell the classes apart best."""
    ship(docs.sparkSession)
    marks = (labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull() & ~held_out(id_col))
             .groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label).cast("int")).alias("_toxic")))
    some = cut(marks.orderBy(F.xxhash64("_id"), "_id").limit(sample))  # at most ``sample`` rows: safe to broadcast
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(some), "_id").select("_text", "_toxic")
    tables = Scratch()
    texts = tables.write(_one_of_copies(texts), "labelled")
    n, n_bad = texts.agg(F.count("*"), F.coalesce(F.sum("_toxic"), F.lit(0))).first()
    if n and 0 < n_bad < n:
        lexicon = learn_lexicon(cut(vocabulary(texts, "_text", "_toxic")), n_bad, n - n_bad, size=lexicon_size)
        seen = _with_features(texts.select("_text", "_toxic"), lexicon, "_toxic").toArrow()
        x = np.column_stack([seen.column(f).to_numpy() for f in FEATURES])
        weights = fit_logistic(x, seen.column("_toxic").to_numpy().astype(float), ridge)
    else:
        lexicon, weights = Lexicon({}), np.zeros(1 + len(FEATURES))
        weights[0] = 35.0 if n and n_bad == n else -35.0
    tables.drop()
    found = _with_features(docs.select(F.col(text).alias("_text"), F.col(id_col).alias("_id")), lexicon, "_id")
    line = F.lit(float(weights[0]))
    for name, w in zip(FEATURES, weights[1:].tolist()):
        line = line + F.lit(w) * F.col(name)
    score = 1 / (1 + F.exp(-line))
    return found.select(F.col("_id").alias(id_col), held_out("_id").alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


def _with_features(rows: DataFrame, lexicon: Lexicon, keep: str) -> DataFrame:
    """``keep`` and the features of ``_text``."""

    def measure(batches):
        for batch in batches:
            values = np.array([lexicon.features(t) for t in batch.column("_text").to_pylist()], float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(keep), *(pa.array(values[:, i]) for i in range(len(FEATURES)))], names=[keep, *FEATURES])

    kind = rows.schema[keep].dataType.simpleString()
    return rows.mapInArrow(measure, f"{keep} {kind}, " + ", ".join(f"`{f}` double" for f in FEATURES))
