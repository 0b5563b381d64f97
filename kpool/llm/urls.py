"""URL verdicts: rules by host and path, and boosted trees where no rule fits.

Only DataFrame expressions and Spark ML's DataFrame API.  URLs that a rule
judges are the labelled ones.  From them come smoothed block rates per address
suffix (a grouped aggregate over all of them) and gradient-boosted trees over
lexical features: lengths, depth, digit ratio, character entropy, parameter
counts and the suffix statistics.  The trees are fitted on the ``sample``
labelled URLs of least hash (a documented bound); every URL is judged.

Defined cases: a null URL, or one without ``://``, has an empty host and path.
Without labelled URLs the rest is allowed; with one class of labels the rest
gets that class.  Ids play no part; repeated rows get equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpool.llm._io import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ("length", "host_length", "host_labels", "depth", "digit_ratio", "entropy", "parameters", "hyphens", "fragment", "suffix_rate", "suffix_seen")


def address(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL column."""
    u = F.coalesce(F.col(url), F.lit(""))
    rest = F.when(F.instr(u, "://") > 0, F.expr(f"substring(coalesce(`{url}`, ''), instr(coalesce(`{url}`, ''), '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.regexp_replace(rest, "^[^/?#]*", ""), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null where none fits.  A
    rule ``host/path`` fits its host and all subdomains, for paths that start
    with ``/path``.  ``rules`` is a list that fits in a plan."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _entropy(text: str) -> Column:
    """Bits per character, from runs of the sorted characters."""
    runs = f"""aggregate(array_sort(filter(split({text}, ''), c -> c <> '')),
        named_struct('c', '', 'n', 0L, 's', 0.0D),
        (a, c) -> IF(a.c = c, named_struct('c', c, 'n', a.n + 1L, 's', a.s),
                     named_struct('c', c, 'n', 1L, 's', a.s + IF(a.n > 0, a.n * log2(a.n), 0.0D))),
        a -> a.s + IF(a.n > 0, a.n * log2(a.n), 0.0D))"""
    return F.expr(f"IF(length({text}) = 0, 0.0D, log2(length({text})) - {runs} / length({text}))")


def lexical(urls: DataFrame) -> DataFrame:
    """Lexical features of column ``_u`` with ``host`` and ``path``."""
    u = F.col("_u")
    query = F.regexp_extract(u, "\\?([^#]*)", 1)
    digits = F.length(u) - F.length(F.regexp_replace(u, "[0-9]", ""))
    return urls.withColumns({
        "length": F.length(u).cast("double"),
        "host_length": F.length("host").cast("double"),
        "host_labels": F.size(F.split("host", "\\.")).cast("double"),
        "depth": F.size(F.filter(F.split("path", "/"), lambda x: x != "")).cast("double"),
        "digit_ratio": F.when(F.length(u) > 0, digits / F.length(u)).otherwise(0.0),
        "entropy": _entropy("_u"),
        "parameters": F.when(query != "", F.size(F.split(query, "&"))).otherwise(0).cast("double"),
        "hyphens": (F.length(u) - F.length(F.replace(u, F.lit("-")))).cast("double"),
        "fragment": F.contains(u, F.lit("#")).cast("double"),
        "suffix": F.regexp_extract("host", "[^.]*\\z", 0),
    })


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url: str = "url", sample: int = 16384,
               trees: int = 20, depth: int = 4, strength: float = 20.0, seed: int = 42) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, p_block (null where a rule decided)."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    host, path = address(url)
    base = pages.select(F.col(id_col).alias("_id"), F.coalesce(F.col(url), F.lit("")).alias("_u"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    # the features are needed twice (labelled and all), the HTML never
    rows = lexical(cut(base.withColumn("rule", rule).withColumn("_v", verdict)))

    labelled = rows.filter(F.col("_v").isNotNull())
    rates = labelled.groupBy("suffix").agg(F.count("*").cast("double").alias("_n"), F.count_if(F.col("_v") == "block").cast("double").alias("_b"))
    rates = cut(rates)
    n, blocked = rates.agg(F.coalesce(F.sum("_n"), F.lit(0.0)), F.coalesce(F.sum("_b"), F.lit(0.0))).first()
    out = ["_id", "host", "path", "rule"]
    if not n or not 0 < blocked < n:
        other = F.lit("block" if n and blocked else "allow")
        return rows.select(*out, F.coalesce("_v", other).alias("verdict"), F.lit(None).cast("double").alias("p_block")).withColumnRenamed("_id", id_col)

    rate = blocked / n
    rates = rates.select("suffix", ((F.col("_b") + strength * rate) / (F.col("_n") + strength)).alias("suffix_rate"), F.log1p("_n").alias("suffix_seen"))
    rows = rows.join(rates, "suffix", "left").fillna({"suffix_rate": rate, "suffix_seen": 0.0})
    vector = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    # distinct URLs, of each class up to ``sample``, weighted so that classes and copies count as in all rows
    urls = rows.filter(F.col("_v").isNotNull()).withColumn("label", (F.col("_v") == "block").cast("double")) \
        .groupBy("_u").agg(F.first("label").alias("label"), F.count("*").cast("double").alias("weight"), *[F.first(f).alias(f) for f in FEATURES])
    some = None
    for label, rows_of_class in ((0.0, n - blocked), (1.0, blocked)):
        part = cut(urls.filter(F.col("label") == label).orderBy(F.xxhash64("_u"), "_u").limit(sample).select("label", "weight", *FEATURES).repartition(4))
        held = part.agg(F.sum("weight")).first()[0]
        part = part.withColumn("weight", F.col("weight") * (rows_of_class / held))
        some = part if some is None else some.union(part)
    some = vector.transform(cut(some)).select("label", "weight", "features")
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, seed=seed, weightCol="weight").fit(some)
    scored = model.transform(vector.transform(rows)).withColumn("_p", vector_to_array("probability")[1])
    p = F.when(F.col("_v").isNull(), F.col("_p"))
    return scored.select(*out, F.coalesce("_v", F.when(p >= 0.5, "block").otherwise("allow")).alias("verdict"), p.alias("p_block")).withColumnRenamed("_id", id_col)
