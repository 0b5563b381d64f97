"""Quality rules as weak supervision, in DataFrame expressions only.

Each rule votes good (+1), bad (-1) or abstains (0) on a text.  Votes are
combined by a naive Bayes label model: expectation-maximisation estimates each
rule's accuracy and the share of good texts without labels, and a text's
posterior probability replaces the demand that every rule pass.  Texts enter
EM as counts of vote patterns (at most 3^rules, however many texts), gathered
by one grouped aggregation over all rows; the few patterns are fitted on the
driver and the posterior is a sum of literals per vote.

Defined cases: a null text has no words; it and all texts without words fail
the base test.  Ids play no part; repeated rows get equal results.  Columns
that clash with an added one are replaced.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpool.llm._io import Scratch, cut, fresh

SPACE = "[\\x20\\x09-\\x0D]+"
MANY = 48  # repeated windows up to which membership is by search, else by sorting

#: (rule, measure, votes bad below, votes bad above, votes good from, votes good to)
RULES = (
    ("length", "n_words", 50, 100_000, 100, 50_000),
    ("word_length", "mean_word", 2.5, 12.0, 3.0, 9.0),
    ("symbols", "symbol_share", None, 0.05, 0.0, 0.005),
    ("symbol_ratio", "symbols_a_word", None, 0.10, 0.0, 0.02),
    ("bare_words", "bare_share", None, 0.20, 0.0, 0.10),
    ("line_repeats", "line_share", None, 0.30, 0.0, 0.10),
    ("window_repeats", "window_share", None, 0.35, 0.0, 0.15),
    ("variety", "variety", 0.15, None, 0.30, 1.0),
    ("letters", "letter_share", 0.80, None, 0.90, 1.0),
)

#: Where EM starts: P(vote | good), P(vote | bad).  A rule rarely says bad of a good text.
START = {1: (0.90, 0.50), 0: (0.08, 0.20), -1: (0.02, 0.30)}


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (and the
    shares the rules read) to ``docs``."""
    t = F.coalesce(F.col(text), F.lit(""))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_letters", "n_bare"]
    docs = docs.drop(*[c for c in docs.columns if c in names])
    trimmed = F.regexp_replace(t, "^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+\\z", "")
    docs = docs.withColumn("_w", F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE)).otherwise(F.array().cast("array<string>")))
    docs = docs.withColumn("n_words", F.size("_w").cast("long"))
    # hashes of 3-word windows, one for each but the last two words
    grams = F.when(F.size("_w") >= 3, F.expr("transform(slice(_w, 1, size(_w) - 2), (x, i) -> xxhash64(x, _w[i + 1], _w[i + 2]))"))
    docs = docs.withColumn("_g", F.coalesce(grams, F.array().cast("array<bigint>")))
    docs = docs.withColumn("_s", F.when(F.size(F.array_distinct("_g")) < F.size("_g"), F.sort_array("_g")))
    twice = F.expr("array_distinct(filter(transform(slice(_s, 2, size(_s) - 1), (x, i) -> IF(x = _s[i], x, NULL)), x -> x IS NOT NULL))")
    docs = docs.withColumn("_r", F.when(F.col("_s").isNotNull(), twice)).drop("_s")
    few = F.expr("filter(transform(_g, (x, i) -> IF(array_contains(_r, x), i, -1)), i -> i >= 0)")
    placed = F.expr("sort_array(transform(_g, (x, i) -> struct(x AS h, i AS i)))")
    docs = docs.withColumn("_o", F.when(F.size("_r") > MANY, placed))
    many = F.expr("sort_array(filter(transform(_o, (x, i) -> IF((i > 0 AND _o[i - 1].h = x.h) OR (i + 1 < size(_o) AND _o[i + 1].h = x.h), x.i, -1)), i -> i >= 0))")
    docs = docs.withColumn("_p", F.when(F.size("_r") > MANY, many).when(F.size("_r") > 0, few))
    # words under those windows: three for each, less the overlap with the window before
    cover = F.expr("aggregate(transform(_p, (x, i) -> IF(i = 0, 3, least(3, x - _p[i - 1]))), 0, (a, x) -> a + x)")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    docs = docs.withColumn("_l", lines)
    return docs.withColumns({
        "word_chars": F.length(F.regexp_replace(t, SPACE, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.regexp_replace(t, "[#*$%&|<>]", ""))).cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "n_repeat_words": F.coalesce(F.when(F.size("_p") > 0, cover), F.lit(0)).cast("long"),
        "n_lines": F.size("_l").cast("long"),
        "n_distinct": F.size(F.array_distinct("_w")).cast("long"),
        # words without a letter
        "n_bare": F.regexp_count(t, F.lit("(?<![^\\x20\\x09-\\x0D])[^\\p{L}\\x20\\x09-\\x0D]+(?![^\\x20\\x09-\\x0D])")).cast("long"),
        "n_letters": F.length(F.regexp_replace(t, "[^\\p{L}]", "")).cast("long"),
    }).drop("_w", "_g", "_r", "_o", "_p", "_l")


def _share(a: str, b: str) -> Column:
    return F.coalesce(F.col(a) / F.when(F.col(b) > 0, F.col(b)), F.lit(0.0))


def votes(measured: DataFrame) -> Column:
    """Array of votes, one for each of RULES."""
    shares = {"n_words": F.col("n_words"), "mean_word": _share("word_chars", "n_words"), "symbol_share": _share("n_symbols", "word_chars"),
              "symbols_a_word": _share("n_symbols", "n_words"), "bare_share": _share("n_bare", "n_words"),
              "line_share": _share("n_dup_lines", "n_lines"), "window_share": _share("n_repeat_words", "n_words"),
              "variety": _share("n_distinct", "n_words"), "letter_share": _share("n_letters", "word_chars")}

    def vote(rule) -> Column:
        _, of, low, high, good_from, good_to = rule
        x = shares[of]
        bad = reduce(Column.__or__, [c for c in (x < low if low is not None else None, x > high if high is not None else None) if c is not None])
        return F.when(bad, -1).when((x >= good_from) & (x <= good_to), 1).otherwise(0).cast("tinyint")

    return F.array(*map(vote, RULES))


def fit_label_model(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 100, tolerance: float = 1e-7,
                    prior: float = 0.8) -> tuple[float, list[dict[int, tuple[float, float]]]]:
    """EM over counted vote patterns.  Returns the share of good texts and, for
    each rule, {vote: (P(vote | good), P(vote | bad))}.

    It starts from START for every rule, so that class 'good' stays the one
    the rules vote for; counts are smoothed by one.
    """
    rules = len(patterns[0][0]) if patterns else 0
    total = sum(n for _, n in patterns)
    given = [dict(START) for _ in range(rules)]
    before = -math.inf
    for _ in range(rounds):
        good = 0.0
        sums = [{v: [1.0, 1.0] for v in (-1, 0, 1)} for _ in range(rules)]
        likelihood = 0.0
        for pattern, n in patterns:
            a, b = math.log(prior), math.log(1 - prior)
            for j, v in enumerate(pattern):
                a, b = a + math.log(given[j][v][0]), b + math.log(given[j][v][1])
            top = max(a, b)
            norm = top + math.log(math.exp(a - top) + math.exp(b - top))
            p = math.exp(a - norm)
            likelihood += n * norm
            good += n * p
            for j, v in enumerate(pattern):
                sums[j][v][0] += n * p
                sums[j][v][1] += n * (1 - p)
        prior = min(max((good + 1) / (total + 2), 1e-4), 1 - 1e-4)
        for j in range(rules):
            whole = [sum(sums[j][v][c] for v in (-1, 0, 1)) for c in (0, 1)]
            given[j] = {v: (sums[j][v][0] / whole[0], sums[j][v][1] / whole[1]) for v in (-1, 0, 1)}
            # a rule that votes must not be worse than chance for its own class
            if given[j][1][0] * given[j][-1][1] < given[j][1][1] * given[j][-1][0]:
                given[j] = {v: (sum(given[j][v]) / 2,) * 2 for v in (-1, 0, 1)}
        if abs(likelihood - before) <= tolerance * max(1.0, abs(likelihood)):
            break
        before = likelihood
    return prior, given


def posterior(model, votes_col: str) -> Column:
    prior, given = model
    log_odds = F.lit(math.log(prior) - math.log(1 - prior))
    for j, by_vote in enumerate(given):
        v = F.col(votes_col)[j]
        weight = {k: math.log(g) - math.log(b) for k, (g, b) in by_vote.items()}
        log_odds = log_odds + F.when(v > 0, weight[1]).when(v < 0, weight[-1]).otherwise(weight[0])
    return 1 / (1 + F.exp(-log_odds))


def _model(marked: DataFrame):
    return fit_label_model(sorted((tuple(r[0]), r[1]) for r in marked.groupBy("_votes").count().collect()))  # at most 3^rules


def base_test(n_words: str = "n_words", n_repeat_words: str = "n_repeat_words") -> Column:
    """True for texts that fail it: few words, or most of them in repeated windows."""
    return (F.col(n_words) < 50) | (100 * F.col(n_repeat_words) > 50 * F.col(n_words))


def _judged(marked: DataFrame, model, keep_from: float) -> DataFrame:
    failed = base_test()
    return (marked.withColumn("p_good", posterior(model, "_votes")).withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= keep_from)).drop("_votes"))


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, keep_from: float = 0.5, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, the base counts, base_failed, kept, p_good."""
    measured = measures(docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_t")), "_t")
    marked = cut(measured.select("_id", *BASE, votes(measured).alias("_votes")))
    return _judged(marked, _model(marked), keep_from).select(F.col("_id").alias(id_col), *BASE, "base_failed", "kept", "p_good")


def keep_good(docs: DataFrame, keep_from: float = 0.5, text: str = "text") -> DataFrame:
    """Rows of ``docs`` that are kept; columns unchanged.  The texts are measured
    once: rows and votes are written (compressed) to the shared folder, where
    the model and the verdicts read them."""
    kept = docs.columns
    measured = measures(docs.select(F.struct(*kept).alias("_row"), F.col(text).alias("_t")), "_t")
    names = [fresh(kept, n) for n in ("votes", "n_words", "n_repeat_words")]
    marked = Scratch().write(measured.select("_row.*", votes(measured).alias(names[0]), *[F.col(n).alias(m) for n, m in zip(("n_words", "n_repeat_words"), names[1:])]),
                             "quality")
    model = _model(marked.select(F.col(names[0]).alias("_votes")))
    good = posterior(model, names[0]) >= keep_from
    return marked.filter(~base_test(*names[1:]) & good).select(*kept)
