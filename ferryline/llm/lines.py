"""Line dedup with overlapping windows of consecutive lines.

Every run of ``window`` consecutive lines is hashed; a window seen before (in an
earlier document, or earlier in the same one) marks the lines it covers, and the
marked lines of a document go. Only digests are shuffled for the search; the
texts move once, to meet their marks.

Results for odd input: a NULL text stays NULL (no lines); an empty text is one
empty line; texts of fewer lines than the window are never changed; documents are
ordered by id (NULL first), equal ids and repeated rows by their stored row number,
so exactly one occurrence of each window stays; a window that repeats within its own
span (``a a a a``) loses the lines that its later occurrences cover. An empty table
gives an empty table. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferryline.llm.rows import col, numbered, unpacked

WINDOW = 3


def _split(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value bound as a lambda's argument, so that inner lambdas don't repeat it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def dedup_lines(df: DataFrame, text: str = "text", doc_id: str = "doc_id",
                n_chars: str = "n_chars", window: int = WINDOW) -> DataFrame:
    """``df`` with the repeated lines cut out of ``text``, and ``n_lines``, ``n_removed``.

    ``n_chars``, where it exists, counts the new text of a changed row.
    """
    def digests(lines: Column) -> Column:
        starts = F.size(lines) - F.lit(window)
        return F.when(starts >= 0, F.transform(
            F.sequence(F.lit(1), starts + 1),
            lambda i: F.unhex(F.md5(F.array_join(F.slice(lines, i, window), "\n")))))

    rows = numbered(df, col(doc_id).alias("id"), _once(_split(col(text)), digests).alias("windows"),
                    purpose="lines")

    seen = rows.select("uid", "id", F.posexplode("windows").alias("pos", "window"))
    first = (
        seen.groupBy("window")
        .agg(F.min(F.struct("id", "uid", "pos")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("window", F.col("first.uid").alias("first_uid"),
                F.col("first.pos").alias("first_pos"))
    )
    later = (
        seen.join(first, "window")
        .where((F.col("uid") != F.col("first_uid")) | (F.col("pos") != F.col("first_pos")))
        .groupBy("uid").agg(F.collect_set("pos").alias("later"))
    )

    old = F.col("doc").getField(text)
    covered = F.flatten(F.transform("later", lambda p: F.sequence(p, p + F.lit(window - 1))))
    cut = F.col("later").isNotNull()

    def rest(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered)
        return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")

    result = rows.select("uid", "doc").join(later, "uid", "left").select(
        "doc", "later", F.coalesce(F.when(cut, _once(_split(old), rest)), old).alias("new"),
        F.when(old.isNull(), 0).otherwise(F.size(_split(old))).cast("bigint").alias("lines"),
        F.when(cut, F.size(F.array_distinct(covered))).otherwise(0).cast("bigint").alias("gone"),
    )
    changed = {text: F.col("new")}
    if n_chars.lower() in [c.lower() for c in df.columns]:
        changed[n_chars] = F.when(cut, F.length("new").cast(df.schema[n_chars].dataType)).otherwise(
            F.col("doc").getField(n_chars))
    return result.select(
        *unpacked([c for c in df.columns if c.lower() not in ("n_lines", "n_removed")], changed),
        F.col("lines").alias("n_lines"), F.col("gone").alias("n_removed"),
    )
