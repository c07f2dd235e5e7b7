"""Document fingerprints from content-defined chunks.

A gear hash over the last 32 bytes chooses chunk boundaries; the normalised form asks
for more zero bits before the normal chunk size and fewer after it, with a least and a
greatest size. A fingerprint is the set of chunk digests with their lengths, printed
in digest order, so a shift of the text changes only the chunks around the edit.
Likeness is containment: the length of a text's chunks that the other text also has,
over the length of all its chunks.

``next_documents`` brings to each row the text of the next row in descending id. The
rows are dealt into ranges of ids, each range starts with an id that occurs, and that
row is sent to the range before it as well, so texts move once and no task sees more
than its ranges.

Results for odd input: NULL is the empty text; two empty texts are alike (1), an empty and
a non-empty one are not (0); NULL ids come last; equal ids are ordered by text; a single
row is followed by itself; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.llm.rows import col
from ferryline.llm.words import mix64

LEAST, NORMAL, MOST = 8, 32, 128
STRICT_BITS, LOOSE_BITS = 6, 4
#: Ranges of ids for each shuffle partition, which evens out their sizes.
RANGES_PER_PARTITION = 4
#: Characters of input after which finished rows are handed on.
HAND_ON = 4_000_000

#: The gear table: 256 scrambled numbers, the same everywhere.
GEAR = (mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        >> np.uint64(32)).astype(np.uint32)


def chunk_ends(data: bytes) -> list[int]:
    """Where the chunks of ``data`` end."""
    size = len(data)
    if size <= LEAST:
        return [size] if size else []
    h = GEAR[np.frombuffer(data, np.uint8)]
    for step in (1, 2, 4, 8, 16):  # doubles the window up to 32 bytes
        if step >= size:
            break
        wider = h.copy()
        wider[step:] += h[:-step] << np.uint32(step)
        h = wider
    at = np.flatnonzero(h < np.uint32(1 << (32 - LOOSE_BITS)))
    loose = (at + 1).tolist()
    strict = (at[h[at] < np.uint32(1 << (32 - STRICT_BITS))] + 1).tolist()
    ends, start = [], 0
    loose.append(size + MOST)
    strict.append(size + MOST)
    while size - start > LEAST:
        end = strict[bisect_left(strict, start + LEAST)]
        if end >= start + NORMAL:
            end = min(loose[bisect_left(loose, start + NORMAL)], start + MOST)
        start = min(end, size)
        ends.append(start)
    if start < size:
        ends.append(size)
    return ends


def chunk_set(text: str) -> dict[int, int]:
    """Digest (48 bits) to length of the distinct chunks."""
    data = text.encode("utf-8", "surrogatepass")
    digest, start, found = xxhash.xxh3_64_intdigest, 0, {}
    for end in chunk_ends(data):
        found[digest(data[start:end]) >> 16] = end - start
        start = end
    return found


def fingerprint_text(chunks: dict[int, int]) -> str:
    return ",".join([f"{d:012x}:{chunks[d]}" for d in sorted(chunks)])


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """Share of ``a`` by length that ``b`` contains."""
    if not a:
        return 0.0 if b else 1.0
    return sum([n for d, n in a.items() if d in b]) / sum(a.values())


def edit(text: str, following: str) -> str:
    """The last half of ``text`` replaced by the beginning of the other text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def next_documents(df: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Sorted partitions of ``(part, tail, id, body)``; a tail row only ends its part."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = parts * RANGES_PER_PARTITION
    rows = df.select(col(doc_id).cast("bigint").alias("id"), F.coalesce(col(text), F.lit("")).alias("body"))
    cuts = rows.agg(F.percentile_approx(
        "id", [i / n for i in range(1, n)] + [1.0], max(10_000, 10 * n))).first()[0] or []
    starts = np.unique(np.array(cuts, np.int64))  # one id for each range

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(starts, ids.to_numpy()).astype(np.int32))

    if len(starts):
        own = F.struct(
            F.when(F.col("id").isNull(), 0).otherwise(range_of(F.coalesce("id", F.lit(0)))).alias("part"),
            F.lit(False).alias("tail"))
        also = F.struct(((F.col("own.part") + 1) % len(starts)).cast("int").alias("part"),
                        F.lit(True).alias("tail"))
        is_head = F.col("id").isin([int(x) for x in starts])
        rows = rows.select("id", "body", own.alias("own")).select("id", "body", F.explode(
            F.when(is_head, F.array("own", also)).otherwise(F.array("own"))).alias("p")).select(
            "p.part", "p.tail", "id", "body")
    else:
        rows = rows.select(F.lit(0).alias("part"), F.lit(False).alias("tail"), "id", "body")
    return rows.repartition(parts, "part").sortWithinPartitions(
        "part", "tail", F.col("id").desc_nulls_last(), "body"
    ).withColumn("id", F.col("id").cast("string"))  # pandas has no integers with NULL


SCHEMA = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")


def fingerprint_neighbours(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Fingerprints of every text and of its edit with the next text, and their likeness."""

    def described(item: tuple, following: str) -> tuple:
        number, body = item
        edited = edit(body, following)
        own, changed, other = chunk_set(body), chunk_set(edited), chunk_set(following)
        return (number, len(body), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                fingerprint_text(own), fingerprint_text(changed),
                containment(own, changed), containment(own, other))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done, size = [], 0
        part, head, held = None, None, None

        def frame() -> pd.DataFrame:
            out = pd.DataFrame(done, columns=[c.split()[0] for c in SCHEMA.split(", ")])
            return out.astype({"doc_id": "Int64", "n_chars": "int64"})

        for batch in batches:
            for p, tail, number, body in zip(batch["part"], batch["tail"], batch["id"], batch["body"],
                                             strict=True):
                if p != part:
                    if held is not None:
                        done.append(described(held, head))
                    part, head, held = p, body, None
                    new = True
                else:
                    new = False
                if held is not None:
                    done.append(described(held, body))
                    held = None
                    size += len(body)
                elif tail and not new:
                    continue
                if not tail:
                    held = (None if number is None else int(number), body)
                if size > HAND_ON:
                    yield frame()
                    done, size = [], 0
        if held is not None:
            done.append(described(held, head))
        if done:
            yield frame()

    return next_documents(df, text, doc_id).mapInPandas(run, SCHEMA)
