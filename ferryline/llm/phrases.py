"""Phrase collocations of each language, from exact n-gram counts in quotient filters.

1. Tasks cut their texts into words and hand on chunks: the words of a chunk with their counts,
   and the text as numbers of those words, 0 between pieces.
2. Word counts over all chunks give the vocabulary; words rarer than ``least`` are in no candidate
   and in no part of one, so they get no id. Ids are dense within a language.
3. Each chunk meets the ids of its words and counts its n-grams in counting quotient filters
   (``quotient``), one for each prefix of the permuted keys.
4. Filters of one prefix are merged, at most ``FAN`` at a time; while several groups of chunks are
   left the merged filters split into longer prefixes, so sizes stay as they are however many chunks there are.
5. Scores, containment and ranks are joins and groupings of the n-grams that occur ``least`` times.

A word or n-gram that is everywhere is one entry of each chunk. No dictionary is sent to all tasks.

Results for odd input: NULL texts are empty; a NULL language is ``und``, together with rows of that
name; an empty table, and languages without candidates, have no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferryline.llm.quotient import ORDER, QuotientFilter, filters_of, ids_of, ngrams
from ferryline.llm.rows import col, positions
from ferryline.llm.words import text_buffers
from ferryline.shared import materialize

LEAST = 30
TOP = 2_000
SCALE = 2_000_000
#: Percentage of a candidate's occurrences within a longer one from which it is dropped.
WITHIN = 80
CHUNK_BYTES, PENDING_BYTES = 8 << 20, 24 << 20
FAN = 256
SPLIT_BITS = 8
#: N-gram occurrences for which a prefix is worth while.
PREFIX_ROWS = 1 << 20

# What ends a piece, and what else ends a word.
_PIECE = np.zeros(256, bool)
_PIECE[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_BREAK = _PIECE.copy()
_BREAK[[ord(" "), ord("\t")]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

CHUNKS = "chunk bigint, lang string, word string, local int, n bigint, tokens binary"
CHUNK_SCHEMA = pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("word", pa.string()),
                          ("local", pa.int32()), ("n", pa.int64()), ("tokens", pa.binary())])
FILTERS = pa.schema([("lang", pa.string()), ("owner", pa.int64()), ("prefix", pa.int64()),
                     ("filter", pa.binary())])
COUNTED = pa.schema([("lang", pa.string()), ("ids", pa.list_(pa.int64())), ("a", pa.int64())])


def encode(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, their counts, and the texts as numbers of words from 1, with 0 before each piece."""
    data, offsets = text_buffers(texts)
    data = _LOWER[data]
    inside = ~_BREAK[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    marks = _PIECE[data].astype(np.int32)
    rows = offsets[:-1][offsets[:-1] < len(data)]
    begins[rows] = inside[rows]
    marks[rows] += 1
    start = np.flatnonzero(begins)
    if not len(start):
        return pa.array([], pa.large_string()), np.zeros(0, np.int64), np.zeros(0, np.int32)
    piece = np.cumsum(marks)[start]
    ends = np.zeros(len(start) + 1, np.int64)
    np.cumsum(np.add.reduceat(inside, start, dtype=np.int64), out=ends[1:])
    words = pa.LargeStringArray.from_buffers(
        len(start), pa.py_buffer(ends), pa.py_buffer(data[inside])).dictionary_encode()
    local = words.indices.to_numpy()
    breaks = np.append(True, piece[1:] != piece[:-1])
    tokens = np.zeros(len(local) + int(breaks.sum()), np.int32)
    tokens[np.arange(len(local)) + np.cumsum(breaks)] = local + 1
    return words.dictionary, np.bincount(local, minlength=len(words.dictionary)), tokens


def chunks_of(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """Chunks of about ``CHUNK_BYTES``, each of one language: rows of its words, and one of its tokens."""
    rows = docs.select(F.coalesce(col(lang), F.lit("und")).alias("lang"),
                       F.coalesce(col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, pending, sizes = TaskContext.get().partitionId() << 40, {}, {}

        def flush(name: str) -> Iterator[pa.RecordBatch]:
            nonlocal made
            words, counts, tokens = encode(pa.concat_arrays(pending.pop(name)))
            sizes.pop(name)
            made, n = made + 1, len(words)
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([made] * n, pa.int64()), pa.array([name] * n), words.cast(pa.string()),
                     pa.array(np.arange(1, n + 1, dtype=np.int32)), pa.array(counts.astype(np.int64)),
                     pa.nulls(n, pa.binary())], schema=CHUNK_SCHEMA)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([made], pa.int64()), pa.array([name]), pa.nulls(1, pa.string()),
                     pa.nulls(1, pa.int32()), pa.array([len(tokens)], pa.int64()),
                     pa.array([tokens.tobytes()], pa.binary())], schema=CHUNK_SCHEMA)

        for batch in batches:
            names = batch.column("lang").dictionary_encode()
            for code, name in enumerate(names.dictionary.to_pylist()):
                own = batch.column("text").filter(pc.equal(names.indices, code)).cast(pa.large_string())
                for low in range(0, len(own), 512):  # texts are added until the chunk is full
                    part = own.slice(low, 512)
                    pending.setdefault(name, []).append(part)
                    sizes[name] = sizes.get(name, 0) + (pc.sum(pc.binary_length(part)).as_py() or 0)
                    if sizes[name] >= CHUNK_BYTES:
                        yield from flush(name)
            while sum(sizes.values()) >= PENDING_BYTES:
                yield from flush(max(sizes, key=sizes.get))
        for name in list(pending):
            yield from flush(name)

    return materialize(rows.mapInArrow(run, CHUNKS), "chunks", "zstd")


def count_ngrams(chunks: DataFrame, vocabulary: DataFrame, bits: int, least: int) -> DataFrame:
    """``(lang, ids, a)`` of the n-grams of ids that occur ``least`` times or more; ids are in ``bits`` bits."""
    texts = chunks.where("tokens IS NOT NULL")
    most = texts.groupBy("lang").agg(F.count(F.lit(1)).alias("chunks"), F.sum("n").alias("n")).agg(
        F.max("chunks").alias("chunks"), F.max("n").alias("n")).first()
    owners = most.chunks or 1
    step = min(SPLIT_BITS, max(0, ((ORDER - 1) * (most.n or 0) // PREFIX_ROWS).bit_length()), 2 * bits)
    known = chunks.where("tokens IS NULL").join(vocabulary, ["lang", "word"]).select(
        F.col("chunk").alias("of_chunk"), "local", "id")

    def counted(own: pa.Table, words: pa.Table) -> pa.Table:
        out = []
        for row in own.to_pylist():
            tokens = np.frombuffer(row["tokens"], np.int32)
            id_of = np.zeros(int(tokens.max(initial=0)) + 1, np.int64)
            id_of[words["local"].to_numpy()] = words["id"].to_numpy()
            high, low = ngrams(id_of[tokens], bits)
            out += [(row["lang"], row["chunk"], prefix, f.to_bytes())
                    for prefix, f in filters_of(high, low, 2 * bits, step)]
        return _table(out, FILTERS)

    filters = texts.select("chunk", "lang", "tokens").groupBy("chunk").cogroup(
        known.groupBy("of_chunk")).applyInArrow(counted, FILTERS_DDL)
    done = step
    while True:
        owners = -(-owners // FAN)
        last = owners == 1
        further = 0 if last else min(SPLIT_BITS, 2 * bits - done)
        merged = filters.withColumn("team", F.pmod(F.xxhash64("owner"), F.lit(owners)).cast("int")).groupBy(
            "lang", "prefix", "team").applyInArrow(
                _merging(bits, least if last else 0, further), COUNTED_DDL if last else FILTERS_DDL)
        if last:
            return materialize(merged, "ngrams", "zstd")
        filters, done = merged, done + further


FILTERS_DDL = "lang string, owner bigint, prefix bigint, filter binary"
COUNTED_DDL = "lang string, ids array<bigint>, a bigint"


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([list(c) for c in zip(*rows)] if rows else [[] for _ in schema], schema=schema)


def _merging(bits: int, least: int, further: int):
    """A function from the filters of a prefix to their merged filters, or (``least``) to its n-grams."""

    def run(own: pa.Table) -> pa.Table:
        lang, prefix, team = (own[c][0].as_py() for c in ("lang", "prefix", "team"))
        whole = QuotientFilter.merged([QuotientFilter.from_bytes(f.as_py()) for f in own["filter"]])
        if not least:
            return _table([(lang, team, prefix << further | head, f.to_bytes())
                           for head, f in whole.split(further)], FILTERS)
        often = whole.counts >= least
        head = np.uint64(prefix << (whole.half - whole.prefix_bits))
        ids = ids_of(whole.high[often] | head, whole.low[often], bits)
        sizes = (ids > 0).sum(axis=1)
        offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
        return pa.table([pa.array([lang] * len(ids), pa.string()),
                         pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids[ids > 0])),
                         pa.array(whole.counts[often])], schema=COUNTED)

    return run


def exact(column: Column) -> Column:
    """A count as a decimal, whose products do not overflow."""
    return column.cast("decimal(20,0)")


def scored(ngrams_: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Candidates with ``l``, ``r`` and ``score`` of their weakest cut."""
    counts = ngrams_.unionByName(vocabulary.select("lang", F.array("id").alias("ids"), F.col("f").alias("a")))
    cuts = ngrams_.select("lang", "ids", "a", F.explode(F.expr("sequence(1, size(ids) - 1)")).alias("k"))
    cuts = cuts.select("*", F.expr("slice(ids, 1, k)").alias("first"),
                       F.expr("slice(ids, k + 1, size(ids))").alias("rest"))
    parts = counts.select("lang", F.col("ids").alias("part"), F.col("a").alias("f"))
    both = cuts.join(parts.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"]).join(
        parts.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.call_function(
        "div", exact(F.col("a")) * F.lit(SCALE).cast("decimal(7,0)"), exact(F.col("l")) + exact(F.col("r")))
    return both.groupBy("lang", "ids", "a").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")).select(
        "lang", "ids", "a", "cut.l", "cut.r", "cut.score")


def not_within(candidates: DataFrame, ngrams_: DataFrame) -> DataFrame:
    """Candidates that do not mostly occur inside one longer candidate."""
    inner = ngrams_.where(F.size("ids") > 2).select("lang", "a", F.explode(F.expr("""
        flatten(transform(sequence(2, size(ids) - 1),
                          n -> transform(sequence(1, size(ids) - n + 1), i -> slice(ids, i, n))))""")).alias("ids"))
    around = inner.groupBy("lang", "ids").agg(F.max("a").alias("longer"))
    return candidates.join(around, ["lang", "ids"], "left").where(
        F.col("longer").isNull() | (exact(F.col("longer")) * 100 < exact(F.col("a")) * WITHIN)).drop("longer")


def mine_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST,
                 top: int = TOP) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the first ``top`` phrases of each language."""
    chunks = chunks_of(docs, text, lang)
    words = materialize(chunks.where("tokens IS NULL").groupBy("lang", "word").agg(
        F.sum("n").alias("f")), "words", "zstd")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    vocabulary = materialize(positions(words.where(F.col("f") >= least), ["lang"], ["word"], "words").select(
        "lang", "word", "f", (F.col("pos") + 1).alias("id")), "vocabulary", "zstd")
    bits = (vocabulary.agg(F.max("id")).first()[0] or 1).bit_length()
    ngrams_ = count_ngrams(chunks, vocabulary.select("lang", "word", "id"), bits, least)
    best = materialize(not_within(scored(ngrams_, vocabulary), ngrams_), "candidates", "zstd")
    spelled = best.select("lang", "ids", F.posexplode("ids").alias("at", "id")).join(
        vocabulary.select("lang", "id", "word"), ["lang", "id"]).groupBy("lang", "ids").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("at", "word")))["word"], " ").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = best.join(spelled, ["lang", "ids"]).withColumn("rank", F.row_number().over(order).cast("bigint"))
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
