"""Connected components of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.shared import delete_path, materialize

#: Turns before labels of labels are followed too; stars are done by then.
PLAIN_TURNS = 3


def components(links: DataFrame) -> DataFrame:
    """``(id, label)`` for each end of the links ``(a, b)``; the label is the least id.

    Each round takes the least label among the neighbours and, after the first rounds,
    the label of that label, so long chains shrink fast; labels are written once a round and the old
    ones deleted. Neighbour minima are partial aggregates, so a hub costs no more.
    """
    spark = links.sparkSession
    both = materialize(links.select("a", "b").unionAll(
        links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = materialize(both.groupBy(F.col("a").alias("id")).agg(
        F.least(F.col("id"), F.min("b")).alias("label")), "labels")
    turn = 0
    while True:
        by_id = labels.select(F.col("id").alias("b"), F.col("label").alias("other"))
        near = both.join(by_id, "b").groupBy(F.col("a").alias("id")).agg(F.min("other").alias("near"))
        best = labels.join(near, "id").select("id", "label", F.least("label", "near").alias("next"))
        if turn >= PLAIN_TURNS:
            of_best = labels.select(F.col("id").alias("next"), F.col("label").alias("jump"))
            best = best.join(of_best, "next", "left").select(
                "id", "label", F.least("next", F.coalesce("jump", "next")).alias("next"))
        new = materialize(best, "labels")
        moved = new.where(F.col("next") != F.col("label")).limit(1).count()
        for old in labels.inputFiles()[:1]:
            delete_path(spark, old.rsplit("/", 1)[0])
        if not moved:
            return new.select("id", "label")
        labels = new.select("id", F.col("next").alias("label"))
        turn += 1
