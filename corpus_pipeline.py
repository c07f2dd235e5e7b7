"""A corpus pipeline: each stage works on what the one before kept.

``STAGES`` lists the stages; ``run`` applies them to ``documents``, writing every
stage's rows under the shared folder and reading them again. ``ORACLE_SQL`` is None:
a fitted classifier and ProbMinHash have no SQL form, so tests/llm compares the
stages with brute-force versions.

The caller's columns pass through as they are, whatever they are called; only ``text`` changes (lines cut
out), and mixing adds its own columns. Results for odd input: NULL texts stay (line dedup keeps NULL,
near-duplicates count it as empty, of which one row stays); repeated rows are near-duplicates; an empty table gives
no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferryline.llm import decontaminate, lines, mixing, near_dups, toxicity
from ferryline.llm.queries import fold, read
from ferryline.llm.rows import as_doc, unpacked
from ferryline.shared import delete_path, new_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier does not reject; it learns as in its own query."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), learn=~fold(5))
    packed = docs.select(as_doc(docs), "text")
    return toxicity.score_toxicity(packed, model).where("predicted = 0").select(*unpacked(docs.columns))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with later occurrences of three-line windows cut out."""
    packed = docs.select(as_doc(docs), "doc_id", "text")
    return lines.dedup_lines(packed).select(*unpacked(docs.columns, {"text": F.col("text")}))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates."""
    return near_dups.drop_near_duplicates(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that contain no benchmark item, verbatim or with other names and numbers."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their slots; the mix is the rows with ``in_mix``, in order of ``slot``."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage's rows are deleted once the next one's are written."""
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete_path(spark, before)
        before = path
    return docs
