"""One thin query per operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kpool.llm._io import ship
from kpool.llm._tree import MAX_EPOCHS, SEED, WEIGHTS, levels
from kpool.llm._tree import ORACLE as MIX_SQL
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

SEQUENCE = 4096


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@register("op2_best_fit_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kpool.llm.packing import pack, token_pieces

    pieces = token_pieces(table(spark, sf_dir, "documents"), word_tokenizer(), SEQUENCE)
    return pack(pieces, SEQUENCE)


@register("op5_token_files")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kpool.llm.tokens import read_token_shards, write_token_shards

    return read_token_shards(write_token_shards(table(spark, sf_dir, "documents"), word_tokenizer()))


@register("op4_simhash_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kpool.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), radius=3, shingle=3)


@register("op8_substring_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kpool.llm.substring import dedup_substrings

    return dedup_substrings(table(spark, sf_dir, "documents"), digest=True)


@register("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kpool.llm.quality import judge

    return judge(table(spark, sf_dir, "documents"))


@register("op10_mixing", MIX_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kpool.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents"), levels(), WEIGHTS, max_epochs=MAX_EPOCHS, seed=SEED, narrow_result=True)


#: (verdict, rule)
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


@register("op6_url_filter")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kpool.llm.urls import judge_urls

    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@register("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kpool.llm.toxicity import score_toxicity

    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op7_nearest_neighbours")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kpool.llm.ann import nearest

    return nearest(table(spark, sf_dir, "embeddings"), k=20, every=20)


@register("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kpool.llm.langid import identify_language

    return identify_language(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


@register("op11_embedding_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kpool.llm.whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"), components=8)


@register("op12_byte_level_bpe")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from kpool.llm.byte_bpe import decode_bpe, encode_bpe

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = encode_bpe(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    digits = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decode_bpe(coded, ranks).select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                                           F.sha2(digits.cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kpool.llm.spelling import spelling_variants

    return spelling_variants(table(spark, sf_dir, "documents"))
