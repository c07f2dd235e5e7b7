"""Near-duplicates by ProbMinHash over word shingles.

Every shingle of five words sends a Poisson process of arrivals to registers chosen at random; a
register keeps the shingle that arrived first. The rate is the weight of the shingle, 1 however
often it is in the text: a link is defined on sets, and with any other weight repeated lines
would keep texts apart in banding whose sets are alike. Arrivals are drawn one round after the other for all
shingles that can still be first somewhere, and end early for the rest. Equal registers
estimate the probability Jaccard similarity of two texts, with equal weights the Jaccard similarity
of their shingle sets. Bands of registers propose
candidates; a proposal counts when the exact Jaccard similarity of the shingle sets
reaches the threshold. Only sizes that rule this out spare the comparison.

Texts that are equal word for word are one class before anything else; only one of
each takes part in banding. In every band bucket all members are compared with one
leader, the member that shares most buckets, so proposals grow with the members, not
their square. Links merge into classes. The members of buckets that are then still of
several classes are compared in blocks: members of the largest class and the others are dealt into blocks
of bounded size, each pair of blocks but those of the largest class alone is one bounded group, and a product of
its 0/1 matrices counts all shared shingles; only links that merge classes leave the group. So every proposed pair of
different texts is decided, unless both ends already are in one class.

Results for odd input: NULL and empty texts (no words) are equal texts, one class; a
text of fewer than five words is one shingle of all of them; repeated rows are in one
class; a class is named by its least id (NULL first), whose row is the one kept; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.llm.graph import components
from ferryline.llm.rows import col, numbered, unpacked
from ferryline.llm.words import list_array, mix64, runs_of_hashes, signed, slices, text_buffers, words_of
from ferryline.shared import materialize

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 32, 8
#: Members of a block, and columns of the matrices in which two blocks are compared.
BLOCK, COLUMNS = 192, 4096
BATCH_BYTES = 6_000_000
_BASE = np.uint64(0xD6E8FEB86659FD93)


def shingles(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct shingles of a batch, in row order."""
    w = words_of(texts)
    n = np.diff(w.first)
    every = runs_of_hashes(w.hash, size, _BASE)
    inside = w.row[:len(every)] == w.row[size - 1:] if len(every) else np.zeros(0, bool)
    rows, values = w.row[:len(every)][inside], every[inside]
    short = np.flatnonzero((n > 0) & (n < size))
    if len(short):
        whole = []
        for r in short.tolist():  # at most four words each
            x = np.uint64(0)
            for v in w.hash[w.first[r]:w.first[r + 1]]:
                x = x * _BASE + v
            whole.append(x)
        rows = np.concatenate([rows, short])
        values = np.concatenate([values, mix64(np.array(whole, np.uint64) + np.uint64(1))])
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[new], values[new]


def _uniform(seed: np.ndarray, turn: int, stream: int) -> np.ndarray:
    return mix64(seed + np.uint64((turn * 2 + stream + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))


def signatures(rows: np.ndarray, values: np.ndarray, n: int,
               registers: int = BANDS * ROWS) -> np.ndarray:
    """ProbMinHash signatures, an array of n rows; the low bits name the shingle."""
    first = np.full(n * registers, np.uint64(2**64 - 1))
    keep = np.uint64((1 << 24) - 1)
    seed, time = mix64(values), np.zeros(len(values))
    turn = 0
    while len(rows):
        u = (_uniform(seed, turn, 0) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        time = time - np.log1p(-u)
        register = (_uniform(seed, turn, 1) >> np.uint64(32)).astype(np.int64) * registers >> 32
        packed = (time.view(np.uint64) & ~keep) | (seed & keep)
        np.minimum.at(first, rows * registers + register, packed)
        new = np.ones(len(rows), bool)
        new[1:] = rows[1:] != rows[:-1]
        last = (first.reshape(n, registers)[rows[new]].max(axis=1) & ~keep).view(np.float64)
        last = np.where(np.isnan(last), np.inf, last)
        more = time < last[np.cumsum(new) - 1]
        rows, seed, time = rows[more], seed[more], time[more]
        turn += 1
    return (first & keep).astype(np.uint32).reshape(n, registers)


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    n, registers = signature.shape
    parts = signature.reshape(n, bands, registers // bands).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (n, bands)).copy()
    for k in range(parts.shape[2]):
        key = key * _BASE + parts[:, :, k]
    return mix64(key)


def _parts(batches):
    for batch in batches:
        texts = batch.column("body").cast(pa.large_string())
        for a, b in slices(np.diff(text_buffers(texts)[1]), BATCH_BYTES):
            yield batch.slice(a, b - a), texts.slice(a, b - a)


def sketch(rows: DataFrame) -> DataFrame:
    """``(uid, digest, bands)``: digest of the words, and the band keys (none without words)."""

    def run(batches):
        for batch, texts in _parts(batches):
            n = len(texts)
            digests = [hashlib.blake2b(b"\n".join((t or "").encode().split()), digest_size=16).digest()
                       for t in texts.to_pylist()]
            r, v = shingles(texts)
            some = np.unique(r)
            keys = band_keys(signatures(np.searchsorted(some, r), v, len(some)))
            per_row = np.zeros(n, np.int64)
            per_row[some] = keys.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), pa.array(digests, pa.binary()),
                 list_array(pa.array(signed(keys.ravel())), per_row)], ["uid", "digest", "bands"])

    return rows.mapInArrow(run, "uid bigint, digest binary, bands array<bigint>")


def shingle_sets(rows: DataFrame) -> DataFrame:
    """``(uid, shingles, size)`` for the verification."""

    def run(batches):
        for batch, texts in _parts(batches):
            r, v = shingles(texts)
            sizes = np.bincount(r, minlength=len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), list_array(pa.array(signed(v)), sizes),
                 pa.array(sizes, pa.int64())], ["uid", "shingles", "size"])

    return rows.mapInArrow(run, "uid bigint, shingles array<bigint>, size bigint")


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``(a, b)`` whose shingle sets are alike enough.

    The sets meet unless their sizes alone leave the similarity below the threshold.
    """

    def with_side(df: DataFrame, side: str, *columns: str) -> DataFrame:
        other = sets.select(F.col("uid").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns])
        return df.join(other, side)

    possible = with_side(with_side(pairs, "a", "size"), "b", "size").where(
        F.least("size_a", "size_b") >= F.lit(similarity) * F.greatest("size_a", "size_b")).select("a", "b")
    met = with_side(with_side(materialize(possible, "possible"), "a", "shingles"), "b", "shingles")
    shared = F.size(F.array_intersect("shingles_a", "shingles_b"))
    union = F.size("shingles_a") + F.size("shingles_b") - shared
    return met.where(shared >= F.lit(similarity) * union).select("a", "b")


def links_in_blocks(names: np.ndarray, known: np.ndarray, sets: list[np.ndarray],
                    similarity: float) -> list[tuple[int, int]]:
    """Links that merge the ``known`` classes of the members of two blocks, under one for each class."""
    n, sizes = len(names), np.array([len(x) for x in sets])
    values, where = np.unique(np.concatenate(sets), return_inverse=True)
    member = np.repeat(np.arange(n), sizes)
    order = np.argsort(where, kind="stable")
    where, member = where[order], member[order]
    shared = np.zeros((n, n), np.float32)
    for a in range(0, len(values), COLUMNS):
        i, j = np.searchsorted(where, [a, a + COLUMNS])
        holds = np.zeros((n, COLUMNS), np.float32)
        holds[member[i:j], where[i:j] - a] = 1
        shared += holds @ holds.T
    shared = shared.astype(np.float64)
    near = shared >= similarity * (sizes[:, None] + sizes[None, :] - shared)
    _, first, known = np.unique(known, return_index=True, return_inverse=True)
    near |= known[:, None] == known[None, :]
    label = np.arange(n)
    while True:
        lower = np.where(near, label[None, :], n).min(axis=1)
        lower = np.minimum(label, lower)
        lower = np.minimum(lower, lower[lower])
        if (lower == label).all():
            break
        label = lower
    return [(int(names[label[i]]), int(names[i])) for i in first.tolist() if known[label[i]] != known[i]]


def classes_of(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``(id, label)`` of members that are linked; ``members`` are ``(bucket, uid)``."""
    size = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    weight = members.join(size, "bucket").groupBy("uid").agg(F.sum("size").alias("weight"))
    weighed = materialize(members.join(weight, "uid"), "buckets")
    leader = weighed.groupBy("bucket").agg(
        F.max(F.struct("weight", (-F.col("uid")).alias("least"))).alias("top")).select(
        "bucket", (-F.col("top.least")).alias("leader"))
    led = materialize(weighed.join(leader, "bucket").where(
        F.col("uid") != F.col("leader")).select("bucket", "uid", "leader"), "led")
    pairs = led.select(F.least("uid", "leader").alias("a"), F.greatest("uid", "leader").alias("b")).distinct()
    links = materialize(verified(pairs, sets, similarity), "near")
    labels = components(links)
    # A bucket is settled when the rest of its members are of one class.
    rest = materialize(led.join(labels, F.col("uid") == F.col("id"), "left").select(
        "bucket", "uid", F.coalesce("label", "uid").alias("label")), "rest")
    # In others, members of the largest class are compared with the members outside it only.
    counted = rest.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = counted.groupBy("bucket").agg(
        F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("labels")).where(
        "labels > 1").select("bucket", F.col("top.label").alias("top"),
                             F.ceil(F.col("top.n") / BLOCK).cast("int").alias("of_top"),
                             F.ceil((F.col("n") - F.col("top.n")) / BLOCK).cast("int").alias("of_rest"))
    in_top, place = F.col("label") == F.col("top"), F.xxhash64("uid")
    opened = rest.join(mixed, "bucket").select(
        "bucket", "uid", "label",
        F.when(in_top, F.pmod(place, F.col("of_top"))).otherwise(
            F.col("of_top") + F.pmod(place, F.col("of_rest"))).cast("int").alias("own"),
        F.explode(F.sequence(F.when(in_top, F.col("of_top")).otherwise(0),
                             F.col("of_top") + F.col("of_rest") - 1)).alias("other"))
    dealt = opened.select(
        "bucket", "uid", "label", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        found = links_in_blocks(group["uid"].to_numpy(), group["label"].to_numpy(), [np.asarray(x) for x in group["shingles"]], similarity)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    more = materialize(dealt.join(sets.select("uid", "shingles"), "uid").groupBy("bucket", "i", "j").applyInPandas(
        compare, "a bigint, b bigint").distinct(), "near")
    return components(links.unionAll(more))


def near_duplicates(df: DataFrame, text: str = "text", doc_id: str = "doc_id",
                    similarity: float = SIMILARITY,
                    keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The stored rows ``(uid, doc)`` and their marks ``(uid, id, class_id, kept)``.

    ``class_id`` is the least id of the row's class; ``kept`` marks one row of each class.
    """
    only = None if keep is None else list(dict.fromkeys([*keep, doc_id, text]))
    rows = numbered(df, only=only, purpose="near-rows")
    bodies = rows.select("uid", F.col("doc").getField(text).alias("body"))
    sketches = materialize(sketch(bodies), "sketches")
    least = sketches.groupBy("digest").agg(F.min("uid").alias("first"))
    alone = sketches.join(least.select(F.col("first").alias("uid")), "uid", "left_semi")
    banded = alone.select("uid", F.explode("bands").alias("bucket"))
    several = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    members = materialize(banded.join(several, "bucket").select("bucket", "uid"), "members")
    wanted = bodies.join(members.select("uid").distinct(), "uid", "left_semi")
    sets = materialize(shingle_sets(wanted), "sets")
    labels = classes_of(members, sets, similarity)
    first = sketches.select("uid", "digest").join(least, "digest").select("uid", "first")
    of_class = first.join(labels, F.col("first") == F.col("id"), "left").select(
        "uid", F.coalesce("label", "first").alias("class"))
    ids = rows.select("uid", F.col("doc").getField(doc_id).alias("id")).join(of_class, "uid")
    best = ids.groupBy("class").agg(F.min(F.struct("id", "uid")).alias("best"))
    marks = ids.join(best, "class").select(
        "uid", "id", F.col("best.id").alias("class_id"), (F.col("uid") == F.col("best.uid")).alias("kept"))
    return rows, marks


def drop_near_duplicates(df: DataFrame, text: str = "text", doc_id: str = "doc_id",
                         similarity: float = SIMILARITY) -> DataFrame:
    """``df`` with one row of each class of near-duplicates."""
    rows, marks = near_duplicates(df, text, doc_id, similarity)
    return rows.join(marks.where("kept").select("uid"), "uid").select(*unpacked(df.columns))
