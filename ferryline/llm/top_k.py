"""Exact search for the largest inner products: ball trees per shard, in waves.

Vectors become integers, ``floor(scale * x)``, and are dealt into shards of nearby
vectors by planes that are fitted on a bounded sample; every vector is in one shard. A shard's root
ball bounds what a query can find there. In the first wave each query searches the ball tree
of the shard of greatest bound, then of the next 3, the next 12, and so on; between waves the
``k``-th score found so far goes with the query, and shards (and, inside them, nodes) that cannot
beat it are left out. Results are exact whatever the planes are.

Sizes: a shard has about ``shard_rows`` vectors, hot regions are split by row; a task gets
one shard and at most about ``QUERY_BLOCK`` queries. The planes and root balls are the only data that go
to all tasks; their number is bounded by ``ROOT_BYTES``, beyond which shards get larger instead.

Results for odd input: vectors that are NULL or hold NULL, NaN or infinite components, and rows with a
NULL id, take no part; a vector meets those of its own length only; rows with equal ids are rows of their
own; equal vectors tie and come by id; a query without candidates has no rows; an empty table has none.
Components so large that scores could pass 64 bits raise ``OverflowError``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferryline.llm.ball_tree import Balls, BallTree, ball, halves
from ferryline.llm.rows import col
from ferryline.shared import delete_path, materialize

SHARD_ROWS = 8_192
QUERY_BLOCK = 4_096
SAMPLE = 32_768
ROOT_BYTES = 32 << 20
WAVE_GROWTH = 4
#: Lengths from which an inner product may pass 64 bits.
LONGEST = 2.0**31

PACKED = "uid bigint, vec_id bigint, asks boolean, dim int, packed binary, length double"
FOUND = "uid bigint, score bigint, vec_id bigint"


def unpack(packed: pd.Series, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.int64).reshape(len(packed), dim) if dim else np.zeros(
        (len(packed), 0), np.int64)


def pack_vectors(df: DataFrame, vector: str, vec_id: str, is_query: Column, scale: int) -> DataFrame:
    """The rows that take part, with their vectors as packed integers."""
    component = col(vector)
    bad = F.exists(component, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.where(component.isNotNull() & ~bad & col(vec_id).isNotNull()).select(
        F.monotonically_increasing_id().alias("uid"), col(vec_id).cast("bigint").alias("vec_id"),
        F.coalesce(is_query, F.lit(False)).alias("asks"), component.cast("array<double>").alias("v"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            whole = [np.floor(scale * np.asarray(v, np.float64)) for v in batch["v"]]
            length = np.array([np.sqrt((v * v).sum()) for v in whole])
            if len(length) and length.max() >= LONGEST:
                raise OverflowError("inner products of these vectors may pass 64 bits")
            yield pd.DataFrame({
                "uid": batch["uid"], "vec_id": batch["vec_id"], "asks": batch["asks"],
                "dim": np.array([len(v) for v in whole], np.int32),
                "packed": [v.astype(np.int64).tobytes() for v in whole], "length": length})

    return rows.mapInPandas(run, PACKED)


def fit_planes(sample: np.ndarray, regions: int) -> list[tuple[np.ndarray, float]]:
    """Planes in heap order that halve the sample until there are ``regions`` parts."""
    parts, planes = [sample], []
    while len(parts) < regions:
        halved = []
        for part in parts:
            direction, along = halves(part, part.mean(axis=0)) if len(part) else (
                np.zeros(sample.shape[1]), np.zeros(0))
            cut = float(np.median(along)) if len(along) else 0.0
            planes.append((direction, cut))
            halved += [part[along <= cut], part[along > cut]]
        parts = halved
    return planes


def regions_of(vectors: np.ndarray, planes: list[tuple[np.ndarray, float]]) -> np.ndarray:
    at = np.zeros(len(vectors), np.int64)
    for _ in range(int(np.log2(len(planes) + 1))):
        for node in np.unique(at):
            direction, cut = planes[node]
            here = at == node
            at[here] = 2 * node + 1 + (vectors[here] @ direction > cut)
    return at - len(planes)


def deal(packed: DataFrame, shard_rows: int) -> DataFrame:
    """The packed vectors with the shard of each, stored once."""
    sizes = {r.dim: (r.n, r.longest) for r in packed.groupBy("dim").agg(
        F.count(F.lit(1)).alias("n"), F.max("length").alias("longest")).collect()}
    drawn = packed.orderBy(F.xxhash64("uid")).limit(SAMPLE).select("dim", "packed").toPandas()
    planes = {}
    for dim, own in drawn.groupby("dim"):
        most = max(1, ROOT_BYTES // (16 * dim + 64))
        regions = min(-(-sizes[dim][0] // shard_rows), most, len(own))
        planes[dim] = fit_planes(unpack(own["packed"], dim).astype(np.float64),
                                 1 << max(0, regions - 1).bit_length()) if dim else []

    @F.pandas_udf("int")
    def region(dims: pd.Series, vectors: pd.Series) -> pd.Series:
        out = np.zeros(len(dims), np.int32)
        for dim in dims.unique():
            if planes.get(dim):
                here = (dims == dim).to_numpy()
                out[here] = regions_of(unpack(vectors[here], dim).astype(np.float64), planes[dim])
        return pd.Series(out)

    placed = materialize(packed.withColumn("region", region("dim", "packed")), "regions", "zstd")
    parts = placed.groupBy("dim", "region").agg(
        F.ceil(F.count(F.lit(1)) / (2 * shard_rows)).alias("parts"))
    return placed.join(F.broadcast(parts), ["dim", "region"]).withColumn("shard", F.concat_ws(
        "/", "dim", "region", F.pmod(F.xxhash64("uid"), F.col("parts")).cast("string"))).drop("region", "parts")


def root_balls(dealt: DataFrame) -> pd.DataFrame:
    """Ball and least id of every shard; their number is bounded by ``deal``."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        dim = int(rows["dim"].iloc[0])
        center, radius = ball(unpack(rows["packed"], dim).astype(np.float64))
        return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "dim": [dim], "center": [center.tobytes()],
                             "radius": [radius], "least_id": [rows["vec_id"].min()]})

    return dealt.groupBy("shard").applyInPandas(
        run, "shard string, dim int, center binary, radius double, least_id bigint").toPandas()


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int = 10,
    vector: str = "embedding",
    vec_id: str = "vec_id",
    scale: int = 1024,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: of each query the ``k`` largest inner products with other rows."""
    dealt = materialize(deal(materialize(
        pack_vectors(df, vector, vec_id, is_query, scale), "packed", "zstd"), shard_rows), "shards", "zstd")
    balls = root_balls(dealt)
    queries = dealt.where("asks").select("uid", "dim", "packed")
    best = None
    done, width = 0, 1
    while done < (balls.groupby("dim").size().max() if len(balls) else 0):
        visits = _visits(queries, best, balls, done, done + width, k)
        found = _searched(visits, dealt, k)
        every = found if best is None else best.unionByName(found)
        place = F.row_number().over(Window.partitionBy("uid").orderBy(F.col("score").desc(), "vec_id"))
        older, best = best, materialize(every.withColumn("place", place).where(F.col("place") <= k).select(
            "uid", "score", "vec_id"), "best", "zstd")
        for past in [visits] if older is None else [visits, older]:
            for file in past.inputFiles()[:1]:
                delete_path(df.sparkSession, file.rsplit("/", 1)[0])
        done, width = done + width, width * WAVE_GROWTH
    if best is None:
        best = df.sparkSession.createDataFrame([], FOUND)
    names = dealt.where("asks").select("uid", F.col("vec_id").alias("query_id"))
    rank = F.row_number().over(Window.partitionBy("uid").orderBy(F.col("score").desc(), "vec_id"))
    return best.withColumn("rank", rank).join(names, "uid").select("query_id", "rank", "vec_id", "score")


def _visits(queries: DataFrame, best: DataFrame | None, roots: pd.DataFrame,
            first: int, last: int, k: int) -> DataFrame:
    """Each query with the shards of ranks ``first`` to ``last`` by bound that may beat its ``k``-th score."""
    if best is None:
        asked = queries.withColumns({"kth": F.lit(None).cast("bigint"), "kth_id": F.lit(None).cast("bigint")})
    else:
        full = best.groupBy("uid").agg(
            F.count(F.lit(1)).alias("have"), F.min(F.struct("score", (-F.col("vec_id")).alias("minus"))).alias("w")
        ).where(F.col("have") >= k).select(
            "uid", F.col("w.score").alias("kth"), (-F.col("w.minus")).alias("kth_id"))
        asked = queries.join(full, "uid", "left")
    asked = asked.withColumns({"kth": F.coalesce("kth", F.lit(-(2**63))),
                               "kth_id": F.coalesce("kth_id", F.lit(2**63 - 1))})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, own in batch.groupby("dim"):
                here = roots[roots["dim"] == dim]
                center = np.array([np.frombuffer(c, np.float64) if dim else np.zeros(0) for c in here["center"]])
                balls = Balls(center, here["radius"].to_numpy(), here["least_id"].to_numpy())
                bounds = balls.bounds(unpack(own["packed"], dim).astype(np.float64))
                open_ = balls.open(bounds, own["kth"].to_numpy(), own["kth_id"].to_numpy())
                ranked = np.argsort(-bounds, axis=1, kind="stable")[:, first:last]
                query = np.repeat(np.arange(len(own)), ranked.shape[1])
                keep = open_[query, ranked.ravel()]
                out = own.iloc[query[keep]].copy()
                out["shard"] = here["shard"].to_numpy()[ranked.ravel()[keep]]
                yield out[["shard", "uid", "dim", "packed", "kth", "kth_id"]]

    return materialize(asked.mapInPandas(
        run, "shard string, uid bigint, dim int, packed binary, kth bigint, kth_id bigint"), "visits", "zstd")


def _searched(visits: DataFrame, dealt: DataFrame, k: int) -> DataFrame:
    """What the visits find; each shard meets its visits in blocks."""
    blocks = F.broadcast(visits.groupBy("shard").agg(  # a row for each shard at most
        F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("blocks")))
    asked = visits.join(blocks, "shard").withColumn("block", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int"))
    shards = dealt.join(blocks, "shard").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({"uid": [], "score": [], "vec_id": []})
        dim = int(rows["dim"].iloc[0])
        tree = BallTree(unpack(rows["packed"], dim), rows["vec_id"].to_numpy(), rows["uid"].to_numpy())
        asked, score, ids = tree.search(
            unpack(queries["packed"], dim), queries["uid"].to_numpy(), k,
            queries["kth"].to_numpy(), queries["kth_id"].to_numpy())
        return pd.DataFrame({"uid": queries["uid"].to_numpy()[asked], "score": score.astype(np.int64),
                             "vec_id": ids})

    return asked.groupBy("shard", "block").cogroup(
        shards.select("shard", "block", "uid", "vec_id", "dim", "packed").groupBy("shard", "block")
    ).applyInPandas(run, FOUND)
