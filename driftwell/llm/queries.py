"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import anchors, contain, impacts
from .anchors import substring_dedup
from .contain import containment
from .impacts import search
from .language import fit, held_out, identify_languages
from .mixing import WORD_COUNT, mix_sources
from .quality import quality_rules
from .secrets import secret_scan
from .sharding import shard_rows
from .simhash import near_duplicates
from .sketches import minhash_near_duplicates
from .suffixes import suffix_dedup
from .tokens import token_counts
from .whitening import whiten

TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), keep=("doc_id",))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents")).drop("findings")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out())
    model = fit(docs.where("not held_out"), "text", "lang")
    return identify_languages(docs, model, keep=("doc_id", "held_out"))


def op4_token_counts(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """tokenizer: path of a tokenizers JSON file; by default the installed public one."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path(TOKENIZER)
    with open(tokenizer, encoding="utf-8") as f:
        return token_counts(table(spark, sf_dir, "documents"), f.read())


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    dealt = shard_rows(rows, shards=40, key=("doc_id", "text_crc32", "size"))
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"), texts=False)


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and item that it holds; documents that hold none have no row."""
    found = containment(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", F.col("m.item").alias("item_id"), F.floor(F.col("m.containment") * 1000 + 1e-6).cast("long").alias("contained_permille"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")


def op10_difference_cover_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), texts=False)


def op9_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", F.expr(WORD_COUNT).alias("words"))
    return mix_sources(rows, tokens="words", key=("doc_id", "words")).drop("words")


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_near_duplicates(table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_quality_rules, op2_secret_scan, op3_language_id, op4_token_counts, op5_sharding, op6_suffix_array_dedup, op7_benchmark_decontamination, op8_simhash_near_dedup, op9_temperature_mixing, op10_difference_cover_dedup, op11_minhash_near_dedup, op12_lexical_search, op13_embedding_whitening)}


def oracle_sql() -> dict[str, str]:
    return {"op7_benchmark_decontamination": contain.ORACLE, "op10_difference_cover_dedup": anchors.ORACLE, "op12_lexical_search": impacts.ORACLE}
