"""A corpus made ready for training: five stages, each on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from omnishelf.llm import decontamination, near_dedup, packing, quality, substring_dedup
from omnishelf.llm.common import read_table, ready, scratch, shared_folder, stored
from omnishelf.llm.registry import tokenizer_path


# Each stage looks at doc_id and text alone; the whole row travels beside them in one struct, so no
# column of the documents can clash with the operators' own or get lost.


def _carried(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
    )


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` less the rows whose id and text are named: (doc_id, print) as the operators give it.

    A null id is an id like others here, and texts under one id are told apart.
    """
    names = gone.select(F.col("doc_id").alias("gone_id"), F.col("print").alias("gone_print"))
    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (
        F.xxhash64("text") == F.col("gone_print")
    )
    named = stored(names.distinct()).hint("merge")
    return _carried(docs).join(named, same, "left_anti").select("row.*")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.score_quality(_carried(docs), model).filter("predicted = 1").select("row.*")


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; documents without an id stay."""
    return _without(docs, near_dedup.near_duplicates(docs, with_print=True).filter("NOT kept"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines and sentences that an earlier document has; n_chars follows."""
    cut = substring_dedup.dedup_units(_carried(docs))
    now = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        now["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return cut.select(*[now.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = read_table(spark, sf_dir, "benchmark")
    return _without(docs, decontamination.contaminated(docs, benchmark, with_print=True))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality", keep_good),
    ("near_dedup", keep_one_of_near),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

# Trained models, sketches and tokenizers have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again. What they leave in the shared folder on the way is
    removed at the end; only the result's table stays."""
    docs = read_table(ready(spark), sf_dir, "documents")
    keep = shared_folder(spark)
    with scratch(spark):
        for name, stage in STAGES:
            done = stage(spark, docs, sf_dir)
            docs = stored(done, keep if name == STAGES[-1][0] else None)
    return docs
