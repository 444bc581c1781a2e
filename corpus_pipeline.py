"""A corpus from raw documents: language, lines, near copies, mixture, packing."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicloom.llm import language, lines, minhash, mixing, packing, queries
from civicloom.llm.names import numbered
from civicloom.queries.registry import ready
from civicloom.session import pin, pins, unpin

# A document of which no language holds this share is rejected.
LEAST_SCORE = 0.4


# What the stages before have pinned, by application.
_left: dict[str, list[str]] = {}


def stage(fn):
    """A stage's rows are written before the next one runs, so that one begins by deleting what
    stages before it have pinned; but what its own documents would still be read from stays."""

    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ready(spark)
        left = _left.setdefault(spark.sparkContext.applicationId, [])
        there = set(pins(spark))
        left[:] = [path for path in left if path in there]
        read = docs.inputFiles() if left else []
        done = [path for path in left if not any(f"{path}/" in file for file in read)]
        unpin(spark, done)
        before = set(pins(spark))
        result = fn(spark, docs, sf_dir)
        left[:] = [path for path in left if path not in done] + [path for path in pins(spark) if path not in before]
        return result

    return run_stage


@stage
def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from the labelled ones. Null texts, texts without
    a letter and even mixtures of three languages go."""
    plain, name = numbered(docs)
    learned = language.learn(docs.where(~queries.held_out()))
    found = language.identify(plain, learned, text_col=name["text"])
    accepted = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    return found.where(accepted).select(*plain.columns).toDF(*docs.columns)


@stage
def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand, give or take two characters from nine characters up, in
    an earlier place; ``n_chars`` follows the text."""
    left = lines.drop_repeated_lines(docs, edits=queries.LINE_EDITS)
    kind = docs.schema["n_chars"].dataType
    return left.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), "n_chars"))


@stage
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by similar word shingles, the one with the smallest id.
    Rows that agree in id and text are one document; which of their other columns stay is open."""
    found = minhash.near_duplicates(docs, words=5, percent=80)
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").dropDuplicates(["doc_id", "text"]).select(*docs.columns)


@stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return mixing.mix(docs, queries.MIX_WEIGHTS, queries.MAX_REPEATS, queries.MIX_SEED)


@stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their token ids, sequences and offsets, read from the filled
    sequences, which are written to the shared folder."""
    return packing.pieces_of(pin(queries.packed_sequences(docs), "sequences"))


STAGES = [
    ("language", identified),
    ("lines", without_repeated_lines),
    ("near_copies", without_near_copies),
    ("mixture", mixed),
    ("packing", packed),
]

# Mixtures of n-gram models have no SQL form; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again, and deleted
    when the next one's are written."""
    docs, written = ready(spark).read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, function in STAGES[:-1]:
        docs = pin(function(spark, docs, sf_dir), name)
        if written is not None:
            unpin(spark, [written])
        written = pins(spark)[-1]
    return STAGES[-1][1](spark, docs, sf_dir)
