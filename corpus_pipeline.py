"""From raw documents to a training mixture: five stages, each one operator on all that is left.

Every stage takes the documents its predecessor kept. Its result is written as Parquet to the
shared folder and read again, so a lost executor costs one stage at most.

Defined cases, besides those of the operators: a document is a row; ``doc_id``, ``text`` and ``source`` are read, ``text``
and ``n_chars`` (its length, if there is such a column) are rewritten where a stage takes lines out, and all other
columns pass through unchanged, whatever their names; the last stage adds ``copy``, in place of a column of that
name. A missing text is an empty one and fails the quality rules; rows without an id, or with one that repeats, are
told apart by their texts; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom import runtime
from tabloom.llm import decontaminate, line_dedup, mixing, near_dedup, quality_rules, text


def _carried(docs: DataFrame) -> DataFrame:
    """What the operators read, and all columns but the text in one, so that no name can clash with theirs."""
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    return docs.select(others.alias("pipeline__row"), "doc_id", "text", "source")


def _restored(done: DataFrame, docs: DataFrame, *, rewritten: bool = False) -> DataFrame:
    """The columns of ``docs`` again, with the length of the text if a stage has ``rewritten`` it."""
    found = {c: F.col("pipeline__row").getField(c) for c in docs.columns if c != "text"} | {"text": F.col("text")}
    if rewritten and "n_chars" in found:
        found["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return done.select(*[found[c].alias(c) for c in docs.columns])


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality rules reject, and without the frequent lines of their source."""
    own = _carried(docs)
    limits = runtime.store(quality_rules.frequent_lines(own), "lines")
    good = quality_rules.judge(own, limits=limits).filter("kept").select(*own.columns)
    return _restored(quality_rules.without_frequent_lines(good, limits), docs, rewritten=True)


def lines_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines that other documents hold as well; documents that lose all words go."""
    done = line_dedup.dedup_lines(_carried(docs))
    left = (F.col("n_dropped") == 0) | (F.btrim(F.col("text"), F.lit(text.WHITE)) != "")
    return _restored(done.filter(left), docs, rewritten=True)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near duplicates."""
    return _restored(near_dedup.keep_one(_carried(docs)), docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a passage of the benchmark."""
    clean = decontaminate.drop_matches(_carried(docs), text.table(spark, sf_dir, "benchmark"), unnamed=True)
    return _restored(clean, docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights; ``copy`` numbers the repeats."""
    return mixing.mix(docs, text.word_count(F.col("text")), body="text")


STAGES = [
    ("quality_rules", good_documents),
    ("line_dedup", lines_once),
    ("near_dedup", one_of_each_class),
    ("decontaminate", without_benchmark),
    ("mixing", mixture),
]

# Near duplicates and alignments are beyond SQL; the tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = text.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = runtime.store(stage(spark, docs, sf_dir), name)
    return docs
