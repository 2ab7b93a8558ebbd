"""Cleaning of a document table for training, from the raw table to packed sequences."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

import public_tokenizers
from netsift.llm import neardup, packing, secrets, substrings, toxicity
from netsift.llm.links import stored
from netsift.llm.queries import held_out

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _with_text(docs: DataFrame, text: F.Column) -> DataFrame:
    """``docs`` with another text and its length."""
    return docs.withColumn("text", text).withColumn("n_chars", F.length("text").cast("bigint"))


def shielded(stage: Stage) -> Stage:
    """The stage with all columns but id, text and length out of the way of its working columns, whatever their names."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        aside = {c: f"_column_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text", "n_chars")}
        done = stage(spark, docs.withColumnsRenamed(aside), sf_dir)
        return done.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])

    return run


@shielded
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learnt on the labelled ones of them outside the held-out fold, does not reject.

    Repeated rows are judged each for itself; null and empty texts get the score
    of the model's intercept. Without any label nothing is rejected but for a
    score of exactly one half, which counts as toxic.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.fit(docs, labels.filter(~held_out(F.col("doc_id"))))
    return toxicity.score(docs, model).filter("predicted = 0").drop("score", "predicted")


@shielded
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate component; of rows that repeat an id, one.

    Null and empty texts are like nothing and stay, as do all rows with a null id.
    """
    found = neardup.near_duplicates(docs.select("doc_id", "text"))
    kept = docs.join(found.filter("kept and doc_id is not null").select("doc_id"), "doc_id", "left_semi")
    one = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    once = kept.withColumn("_place", F.row_number().over(one)).filter("_place = 1").drop("_place")
    return once.select(docs.columns).unionByName(docs.filter("doc_id is null"))


@shielded
def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that stand earlier; a text that loses words has the others joined by one space.

    Documents of which nothing is left go; those without any repeat stay as they
    are, null and empty texts among them. Rows that repeat an id are one source.
    """
    done = substrings.remove_repeats(docs).filter("n_removed = 0 or n_removed < n_words")
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    changed = F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return done.withColumn("text", text).withColumn("n_chars", changed).select(docs.columns)


@shielded
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in them replaced by a mark.

    Null and empty texts stay as they are; repeated rows are searched each for itself.
    """
    found = secrets.scan(docs, *secrets.fitted(docs.select("doc_id", "text")))
    return _with_text(found, secrets.redacted()).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 ids.

    A null or empty text is the closing id alone; repeated rows are packed each
    for itself, under the same id. Other columns are left out.
    """
    packed = packing.pack(docs, TOKENIZER)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substrings", drop_repeats),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]
#: The stages train models and compare hashed shingles, which SQL does not express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; each but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
