"""The caller's columns survive all stages of the pipeline, whatever they are called."""

import os
import shutil

import corpus_pipeline
from llm_paths import SF_DIR
from pyspark.sql import functions as F

CLASHES = ["score", "predicted", "n_lines", "n_removed", "uid", "doc", "class_id", "kept", "hits"]


def test_clashing_columns(spark, new_dir):
    folder = new_dir("tables")
    os.makedirs(folder)
    for name in ("labels", "benchmark"):
        shutil.copy(f"{SF_DIR}/{name}.parquet", folder)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < 300")
    odd = spark.createDataFrame([(9001, None), (9002, ""), (9003, "so\nlo"), (9003, "so\nlo")], "doc_id long, text string")
    odd = odd.select("doc_id", "text", F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"),
                     F.length("text").cast("long").alias("n_chars"))
    docs = docs.unionByName(odd)
    marked = docs.select("*", *[F.concat(F.lit(f"{c}-"), "doc_id").alias(c) for c in CLASHES])
    marked.write.parquet(f"{folder}/documents.parquet")
    out = corpus_pipeline.run(spark, folder)
    assert out.columns[:len(marked.columns)] == marked.columns
    rows = out.collect()
    assert 0 < len(rows) <= docs.count()
    assert all(r[c] == f"{c}-{r.doc_id}" for r in rows for c in CLASHES)
    # Of NULL and empty texts, those that line dedup emptied included, one row stays; so does one of repeated rows.
    assert sum(not r.text for r in rows) == 1 and sum(r.doc_id == 9003 for r in rows) == 1
    empty = new_dir("empty")
    shutil.copytree(folder, empty, ignore=shutil.ignore_patterns("documents*"))
    marked.where("false").write.parquet(f"{empty}/documents.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
