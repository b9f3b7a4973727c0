"""The training-corpus pipeline: quality rules, near-dedup, decontamination, mixing, sharding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwell.llm.common import BATCH_KEY, drop_scratch, scratch_mark, small_batches, written
from driftwell.llm.contain import containment
from driftwell.llm.mixing import WORD_COUNT, mix_sources
from driftwell.llm.neardup import deduplicate
from driftwell.llm.quality import quality_rules
from driftwell.llm.sharding import shard_rows

#: SimHash bits, hypergeometric draws and compression ratios have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def neutral(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with columns named column0, column1, .., which clash with nothing, and their names by the old ones."""
    names = {c: f"column{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def restored(df: DataFrame, names: dict[str, str], *more: str) -> DataFrame:
    return df.select(*[F.col(n).alias(c) for c, n in names.items() if c not in more], *more)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in their compression band, with 50 words or more and no more than half of them in repeated windows.

    Null and empty texts go. Repeated rows and rows without an id stay like others. No documents give none.
    """
    small_batches(spark)
    plain, names = neutral(docs)
    return restored(quality_rules(plain, text=names["text"]).where("kept"), names)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of least doc_id; nulls last, of equal ids one row.

    Texts without a word are no copies of each other and stay. No documents give none.
    """
    small_batches(spark)
    plain, names = neutral(docs)
    return restored(deduplicate(plain, text=names["text"], doc_id=names["doc_id"]), names)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts hold none; without items all documents stay, and no documents give none."""
    small_batches(spark)
    plain, names = neutral(docs)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return restored(containment(plain, items, text=names["text"], keep=tuple(names.values())).where("size(matches) = 0"), names)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once for each epoch of its source that it is in.

    A null source is a source of its own. Texts without a word are in every whole epoch. Rows equal in id and text are in the same epochs.
    No documents give none.
    """
    plain, names = neutral(docs)
    mixed = mix_sources(plain, source=names["source"], tokens=WORD_COUNT.replace("text", names["text"]), key=(names["doc_id"], names["text"]))
    return restored(mixed, names)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with their shard (0 to 39) and slot; columns of these names give way. Rows equal in id and text get places of their own. No documents give none."""
    plain, names = neutral(docs)
    return restored(shard_rows(plain, key=(names["doc_id"], names["text"])), names, "shard", "slot")


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written and read again, and what it left behind goes.

    The session's number of rows in an Arrow batch is as before when the stages with Python workers are done.
    """
    docs, mark, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch_mark(), spark.conf.get(BATCH_KEY)
    try:
        for name, stage in STAGES[:-1]:
            docs = written(stage(spark, docs, sf_dir), "stage")
            drop_scratch(spark, mark, keep=1)
    finally:
        spark.conf.set(BATCH_KEY, before)
    return STAGES[-1][1](spark, docs, sf_dir)
