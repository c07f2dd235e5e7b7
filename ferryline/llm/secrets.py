"""Secret scan with corpus-wide ownership frequency.

Patterns give candidate spans; the digest of each candidate's value is counted over
the distinct repositories and owners that hold it. A value held by many owners, or in
many repositories of however few owners, is a copied example; one that few hold and that
looks random is taken for live.
Long mixed tokens outside the fixed patterns (kind ``bare``) are reported only when
the counts make them live. Positions come from the lengths of the pieces between
matches, so everything is built-in functions; counting is three cascaded
aggregations, so a value copied into a third of all documents is reduced before each shuffle.

Results for odd input: NULL and empty texts have no spans; a NULL owner or repository
counts as one value of its own; repeated rows are separate rows of the result but one
repository; an empty table gives no rows. Positions count code points, end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ferryline.llm.rows import col, numbered
from ferryline.shared import materialize

# The kinds in their order, with pattern and the group that holds the value.
# The length conditions of access and hex are part of the pattern: each matches whole
# runs, so a run that is too short has no longer match inside.
ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
KINDS = {
    "assign": (ASSIGN, 2, 6),
    "access": (r"AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
    "bare": (r"[A-Za-z0-9+/_=-]{32,}", 0, 32),
}
BASE = ("assign", "access", "hex")

#: More owners than this make a value a copied example.
MAX_OWNERS = 2
#: More repositories than this do so too, whoever owns them.
MAX_REPOSITORIES = 10
#: A live-looking value has at least so many characters and different ones.
LIVE_CHARS, LIVE_DISTINCT = 16, 8


def _pieces(text: Column, kind: str) -> Column:
    """NULL, or the lengths between the matches, those of the matches, and the values."""
    pattern, group, _ = KINDS[kind]
    return F.when(F.rlike(text, F.lit(pattern)), F.struct(
        F.transform(F.split(text, pattern, -1), lambda p: F.length(p)).alias("between"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                    lambda m: F.length(m)).alias("lengths"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("values"),
    ))


def candidate_spans(rows: DataFrame) -> DataFrame:
    """``(uid, kind, kind_no, start, end, value)`` of the stored pieces."""
    found = None
    for no, (kind, (_, _, least)) in enumerate(KINDS.items()):
        one = rows.where(F.col(kind).isNotNull()).select(
            "uid", "owner", "repository", F.lit(kind).alias("kind"), F.lit(no).alias("kind_no"),
            F.posexplode(F.arrays_zip(
                F.col(kind)["between"].alias("between"), F.col(kind)["lengths"].alias("size"),
                F.col(kind)["values"].alias("value"))).alias("at", "m"),
        )
        found = one if found is None else found.unionAll(one)
    gone_before = Window.partitionBy("uid", "kind").orderBy("at")
    end = F.sum(F.col("m.between") + F.coalesce("m.size", F.lit(0))).over(gone_before)
    spans = found.select(
        "uid", "owner", "repository", "kind", "kind_no", "m.value", (end - F.col("m.size")).alias("start"), end.alias("end")
    ).where(F.col("value").isNotNull())
    value = F.col("value")
    return spans.where(
        F.when(F.col("kind") == "assign", F.length(value) >= KINDS["assign"][2])
        .when(F.col("kind") == "bare", value.rlike("[a-z]") & value.rlike("[A-Z]") & value.rlike("[0-9]"))
        .otherwise(F.lit(True))
    ).select("uid", "owner", "repository", "kind", "kind_no", "start", "end", "value",
             F.unhex(F.sha2(value, 256)).alias("digest"))


def ownership(spans: DataFrame) -> DataFrame:
    """Per value: how many owners, repositories and occurrences it has."""
    return (
        spans.groupBy("digest", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("digest", "owner").agg(F.count(F.lit(1)).alias("repositories"),
                                        F.sum("n").alias("n"))
        .groupBy("digest").agg(F.count(F.lit(1)).alias("owners"),
                               F.sum("repositories").alias("repositories"),
                               F.sum("n").alias("occurrences"))
    )


def scan_secrets(df: DataFrame, text: str = "text", owner: str = "source",
                 repository: str = "doc_id", max_owners: int = MAX_OWNERS,
                 keep: list[str] | None = None,
                 max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """``doc`` (the columns in ``keep``) and ``spans`` of every row of ``df``.

    ``spans`` is an array of structs in order of start and kind: start, kind_no, kind,
    end, status (live, example, weak), owners, repositories.
    """
    body = F.coalesce(col(text), F.lit(""))
    rows = numbered(
        df, col(owner).cast("string").alias("owner"),
        col(repository).cast("string").alias("repository"),
        *[_pieces(body, k).alias(k) for k in KINDS], only=keep, purpose="secrets",
    )
    spans = materialize(candidate_spans(rows), "spans")
    value = F.col("value")
    live_shape = ((F.length(value) >= LIVE_CHARS)
                  & (F.size(F.array_distinct(F.split(value, ""))) >= LIVE_DISTINCT))
    status = (F.when((F.col("owners") > max_owners) | (F.col("repositories") > max_repositories), "example")
              .when(live_shape, "live").otherwise("weak"))
    judged = spans.join(ownership(spans), "digest").select(
        "uid", "kind_no", "kind", "start", "end", status.alias("status"), "owners", "repositories")
    base = judged.where(F.col("kind") != "bare")
    bare = judged.where((F.col("kind") == "bare") & (F.col("status") == "live"))
    taken = spans.where(F.col("kind") != "bare").select(
        F.col("uid").alias("t_uid"), F.col("start").alias("t_start"), F.col("end").alias("t_end"))
    free = bare.join(taken, (F.col("uid") == F.col("t_uid")) & (F.col("start") < F.col("t_end"))
                     & (F.col("t_start") < F.col("end")), "left_anti")
    per_row = base.unionAll(free).groupBy("uid").agg(F.array_sort(F.collect_list(F.struct(
        "start", "kind_no", "kind", "end", "status", "owners", "repositories"))).alias("found"))
    return rows.select("uid", "doc").join(per_row, "uid", "left").select(
        "doc", F.coalesce("found", F.array().cast(per_row.schema["found"].dataType)).alias("spans"))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
