"""A Merkle manifest of a table, built level by level and audited by a recursive climb.

``build`` makes each row a leaf and hashes runs of ``fanout`` consecutive nodes, first within
each group (a source), then over the groups' subroots. Every level is stored as rows that
name their parent: ``(tree, level, idx)`` is a run of nodes, ``kids`` the digests of its members
one after another, ``up_tree, up_level, up_idx`` the run it belongs to and ``slot`` its place there.
The trees of groups are numbered from 0; the tree over the subroots is -1.

``audit`` climbs from the leaves to the root by a recursive query. A climber is a run of
leaves: its leaves share all siblings above them, so it carries one list of siblings (``path``)
and one hash of each leaf (``folded``). Each turn joins the climbers with the run they
have reached, puts their hashes in their place among the members, and hashes. Runs with many
leaves below them are met by many climbers; they are few by count (at most levels x
``CROWN``), so a second recursion joins them by broadcast, and the first one, by key, meets
only runs below that size.

Digests are lowercase hex SHA-256 and are hashed as text.

Results for odd input: NULL in any column is a leaf field of its own (``-``); NULL groups are
one group, the first; rows with equal order values are ordered by their digests; repeated rows are
leaves of their own; a group of one row has its leaf as subroot; with one group its
subroot is the root; an empty table has no rows and a NULL root. Columns of the table are looked
up by name once, so extra columns do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferryline.llm.rows import as_doc, col, positions
from ferryline.shared import materialize

FANOUT = 16
DIGEST = 64  #: characters of a digest
#: Runs with more than one in so many of all leaves below them, and more than the least number, are broadcast.
CROWN, CROWN_LEAST = 1_024, 4_096
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def leaf_digest(values: list[Column]) -> Column:
    """SHA-256 of the values, each as ``-`` if NULL, else its UTF-8 length, a colon and itself."""
    texts = [v.cast("string") for v in values]
    fields = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*fields), 256)


@dataclass(frozen=True)
class Manifest:
    """A built manifest: runs of leaves, runs of nodes, subroots and the root."""

    leaf_runs: DataFrame  #: ``tree, idx, items``: a run's leaves as ``(pos, doc, leaf, claim)``
    nodes: DataFrame
    starts: DataFrame  #: of each run of leaves the run above it
    root: str | None
    rows: int


def build(
    df: DataFrame,
    columns: list[str],
    group: str = "source",
    order: str = "doc_id",
    claims: dict[str, Column] | None = None,
    keep: list[str] | None = None,
    fanout: int = FANOUT,
) -> Manifest:
    """The manifest of ``df`` over ``columns``.

    ``claims`` replaces some columns in the digests to be audited (``claim``); without it each
    claim is the leaf itself. ``keep`` names the columns that results carry.
    """
    changed = claims or {}
    leaf = leaf_digest([col(c) for c in columns])
    claim = leaf_digest([changed.get(c, col(c)) for c in columns]) if changed else leaf
    leaves = materialize(df.select(
        col(group).alias("own_group"), col(order).alias("own_order"), as_doc(df, keep),
        leaf.alias("leaf"), claim.alias("claim"), F.monotonically_increasing_id().alias("uid")), "leaves", "zstd")
    placed = positions(leaves, ["own_group"], ["own_order", "leaf", "uid"], "leaves").drop("uid")
    groups = positions(
        placed.where("pos = 0").select("own_group"), [], ["own_group"], "groups"
    ).select(F.col("own_group").alias("g"), F.col("pos").alias("tree"))
    joined = placed.join(groups, F.col("own_group").eqNullSafe(F.col("g")))
    first = materialize(
        joined.groupBy("tree", F.col("group_rows").alias("n"), F.expr(f"pos div {fanout}").alias("idx")).agg(
            F.sort_array(F.collect_list(F.struct("pos", "leaf", "claim", "doc"))).alias("items")
        ).withColumn("kids", F.array_join("items.leaf", "")), "leaf-runs", "zstd")
    total = first.agg(F.sum(F.size("items")).alias("rows"), F.max("n").alias("most"),
                      F.max("tree").alias("last")).first()
    rows, most, trees = total.rows or 0, total.most or 0, (-1 if total.last is None else total.last) + 1

    nodes, subroots = [], []
    runs = first.select("tree", "n", "idx", "kids", F.size("items").cast("bigint").alias("leaves"))
    digest = F.sha2("kids", 256)
    subroots.append(runs.where("n = 1").withColumns({"level": F.lit(0), "digest": F.col("kids")}))
    runs, level = runs.where("n > 1"), 1
    while fanout ** (level - 1) < most:
        at = runs.withColumns({"level": F.lit(level), "digest": digest})
        subroots.append(at.where(F.col("n") <= fanout**level))
        nodes.append(_linked(at.where(F.col("n") > fanout**level), F.col("tree"), level + 1, F.col("idx"), fanout))
        runs, level = _runs(nodes[-1]), level + 1

    tops = materialize(reduce(DataFrame.unionByName, subroots), "subroots", "zstd")
    if trees > 1:
        nodes.append(_linked(tops.withColumn("n", F.lit(trees).cast("bigint")), F.lit(-1).cast("bigint"),
                             1, F.col("tree"), fanout))
        runs, level = _runs(nodes[-1]), 1
        while fanout ** (level - 1) < trees:
            at = runs.withColumns({"level": F.lit(level), "digest": digest})
            last = fanout**level >= trees
            nodes.append(_unlinked(at) if last else _linked(at, F.col("tree"), level + 1, F.col("idx"), fanout))
            runs, level = _runs(nodes[-1]), level + 1
    else:
        nodes.append(_unlinked(tops))
    every = reduce(DataFrame.unionByName, nodes)
    root = every.where("up_tree IS NULL").select("digest").first()
    inner = first.where("n > 1").select(
        "tree", "idx", F.col("tree").alias("at_tree"), F.lit(1).alias("at_level"), F.col("idx").alias("at_idx"),
        F.lit(None).cast("bigint").alias("slot"), F.size("items").cast("bigint").alias("at_leaves"),
        F.col("items.claim").alias("folded"), F.lit(None).cast("string").alias("subroot"))
    alone = first.where("n = 1").select("tree", "idx", F.col("items.claim").alias("folded")).join(
        every.where("level = 0").select(
            "tree", F.col("up_tree").alias("at_tree"), F.col("up_level").alias("at_level"),
            F.col("up_idx").alias("at_idx"), "slot", F.col("up_leaves").alias("at_leaves"),
            F.col("digest").alias("subroot")), "tree")
    return Manifest(first, every.where("level > 0"), inner.unionByName(alone),
                    root.digest if root else None, rows)


def _linked(at: DataFrame, up_tree: Column, up_level: int, place: Column, fanout: int) -> DataFrame:
    """Stored nodes with their links to the run above, and its number of leaves."""
    up = at.withColumns({
        "up_tree": up_tree, "up_level": F.lit(up_level), "up_idx": F.floor(place / fanout).cast("bigint"),
        "slot": (place % fanout).cast("bigint")})
    siblings = Window.partitionBy("up_tree", "up_level", "up_idx")
    return materialize(up.withColumn("up_leaves", F.sum("leaves").over(siblings)), "nodes", "zstd")


def _unlinked(at: DataFrame) -> DataFrame:
    """The root: a node without a run above it."""
    return materialize(at.select(
        "*", F.lit(None).cast("bigint").alias("up_tree"), F.lit(None).cast("int").alias("up_level"),
        *[F.lit(None).cast("bigint").alias(c) for c in ("up_idx", "slot", "up_leaves")]), "nodes", "zstd")


def _runs(nodes: DataFrame) -> DataFrame:
    """The runs above the nodes: digests in order of their places."""
    members = F.sort_array(F.collect_list(F.struct("slot", "digest")))
    return nodes.groupBy(F.col("up_tree").alias("tree"), "n", F.col("up_idx").alias("idx")).agg(
        F.array_join(members["digest"], "").alias("kids"), F.sum("leaves").alias("leaves"))


CLIMB = f"""
    WITH RECURSIVE climb AS (
        SELECT tree, idx, at_tree, at_level, at_idx, slot, at_leaves, folded, subroot, path FROM {{start}}
        UNION ALL
        SELECT c.tree, c.idx, n.up_tree, n.up_level, n.up_idx, n.slot, n.up_leaves,
               transform(c.folded, (h, i) -> sha2(overlay(
                   n.kids PLACING h FROM CAST(coalesce(c.slot, i) * {DIGEST} + 1 AS INT)), 256)),
               IF(n.tree >= 0 AND coalesce(n.up_tree, -1) = -1, n.digest, c.subroot),
               IF(c.slot IS NULL, c.path, concat(c.path, overlay(
                   n.kids PLACING '' FROM CAST(c.slot * {DIGEST} + 1 AS INT) FOR {DIGEST})))
        FROM climb c JOIN {{nodes}} n
          ON c.at_tree = n.tree AND c.at_level = n.level AND c.at_idx = n.idx)
    SELECT * FROM climb WHERE at_tree IS NULL OR at_leaves > {{limit}}"""


def audit(manifest: Manifest) -> DataFrame:
    """Of each leaf: ``doc, leaf, claim, subroot, root, proof_sha256, folded_root, verified``.

    ``proof_sha256`` is the digest of the leaf's siblings, level by level; ``folded_root`` is the root
    that follows from the claim and the original siblings.
    """
    spark = manifest.nodes.sparkSession
    limit = max(CROWN_LEAST, manifest.rows // CROWN)
    start = manifest.starts.withColumn("path", F.lit(""))
    low = _climbed(spark, start, manifest.nodes.where(F.col("leaves") <= limit), limit)
    crown = F.broadcast(manifest.nodes.where(F.col("leaves") > limit))
    top = _climbed(spark, low, crown, manifest.rows).where("at_tree IS NULL")
    runs = manifest.leaf_runs.select("tree", "idx", "items", "n", "kids")
    siblings = F.expr(f"IF(n = 1, '', overlay(kids PLACING '' FROM place * {DIGEST} + 1 FOR {DIGEST}))")
    root = F.lit(manifest.root).cast("string")
    return runs.join(top, ["tree", "idx"]).select(
        "n", "kids", "path", "subroot", "folded", F.posexplode("items").alias("place", "item")
    ).withColumn("folded_root", F.col("folded")[F.col("place")]).select(
        "item.doc", "item.leaf", "item.claim", "subroot", root.alias("root"),
        F.sha2(F.concat(siblings, "path"), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == root).alias("verified"))


def _climbed(spark: SparkSession, start: DataFrame, nodes: DataFrame, limit: int) -> DataFrame:
    """Climbers that have reached the root or a run of more than ``limit`` leaves, stored once."""
    with _without_row_limit(spark):
        return materialize(
            spark.sql(CLIMB.replace("{limit}", str(limit)), start=start, nodes=nodes), "climbed", "zstd")


@contextmanager
def _without_row_limit(spark: SparkSession) -> Iterator[None]:
    """Recursive queries here make a row for each run and level, however large the table is."""
    old = spark.conf.get(ROW_LIMIT, None)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(ROW_LIMIT)
        else:
            spark.conf.set(ROW_LIMIT, old)
