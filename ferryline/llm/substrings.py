"""Exact removal of repeated word sequences by recompression.

Texts are parsed by rounds: runs of one symbol get a name, then neighbouring symbols
of two classes (a coin for each symbol) are paired and get a name. Names are hashes of
what they stand for, so all tasks name alike without asking each other, and inside
equal substrings the parse is equal up to a margin that the substring itself
determines. For each window of ``window`` words the certain interior is computed, and
the least name of a phrase of ``PHRASE`` interior symbols is its high-level symbol;
a window too plain to have one (long runs) is its own symbol.

A symbol that occurs in one text only cannot belong to a window of two texts. Windows
under shared symbols are hashed whole and counted over the texts: that decides, exactly
up to the collision of two 64-bit hashes (symbol and window) at once. Repeats within one text are found in
its own task. Every text takes part once, however many rows hold it: rows of equal
words lose all words if a window fits. Counting is by partial aggregates and joins on single
symbols or windows, never by pairs.

Results for odd input: NULL and empty texts have no words and keep none; texts of fewer
words than the window lose words never; repeated rows are occurrences elsewhere, so both
lose their words; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.llm.rows import col
from ferryline.llm.words import (
    Words, list_array, mix64, runs_of_hashes, signed, slices, text_buffers, words_of,
)
from ferryline.shared import materialize

WINDOW = 35
ROUNDS, PHRASE = 2, 4
BATCH_BYTES = 6_000_000
_NAME, _PHRASE, _WINDOW = (np.uint64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))


def parse_round(sym: np.ndarray, row: np.ndarray, turn: int, lo: np.ndarray, hi: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One round over all rows; ``lo`` and ``hi`` bound the certain interior of each window."""
    new = np.ones(len(sym), bool)
    new[1:] = (sym[1:] != sym[:-1]) | (row[1:] != row[:-1])
    of_run, at = np.cumsum(new) - 1, np.flatnonzero(new)
    length = np.diff(np.append(at, len(sym))).astype(np.uint64)
    runs = np.where(length > 1, mix64(sym[at] * _NAME + length), sym[at])
    row = row[at]
    some = lo < hi
    lo, hi = np.where(some, of_run[lo] + 1, 0), np.where(some, of_run[hi - 1], 0)

    right = (mix64(runs + np.uint64(turn + 1) * _PHRASE) & np.uint64(1)).astype(bool)
    leads = np.zeros(len(runs), bool)
    leads[:-1] = ~right[:-1] & right[1:] & (row[:-1] == row[1:])
    starts = np.ones(len(runs), bool)
    starts[1:] = ~leads[:-1]
    of_pair, at = np.cumsum(starts) - 1, np.flatnonzero(starts)
    follower = runs[np.minimum(at + 1, len(runs) - 1)]
    names = np.where(leads[at], mix64(runs[at] * _NAME + follower), runs[at])
    some = lo < hi
    last = np.where(some, hi - 1, 0)
    first = np.minimum(np.where(some, lo, 0), len(runs) - 1)
    begin = np.minimum(first + right[first], len(runs) - 1)
    lo = np.where(some, of_pair[begin], 0)
    hi = np.where(some, of_pair[last] + right[last], 0)
    empty = some & right[first] & (first >= last)
    return names, row[at], np.where(empty, 0, lo), np.where(empty, 0, hi)


def window_symbols(w: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, hash and high-level symbol of every window of the batch."""
    if len(w.hash) < window:
        none = np.zeros(0, np.uint64)
        return np.zeros(0, np.int64), none, none
    start = np.flatnonzero(w.row[:len(w.row) - window + 1] == w.row[window - 1:])
    whole = runs_of_hashes(w.hash, window, _WINDOW)[start]
    symbol = mix64(whole + _PHRASE)
    sym, row, lo, hi = w.hash, w.row, start, start + window
    for turn in range(ROUNDS):
        sym, row, lo, hi = parse_round(sym, row, turn, lo, hi)
    least = [runs_of_hashes(sym, PHRASE, _PHRASE)]
    many = hi - lo - PHRASE + 1
    some = np.flatnonzero(many > 0)
    if len(some):
        lo, many = lo[some], many[some]
        step = 1
        while 2 * step <= many.max():
            least.append(np.minimum(least[-1][:-step], least[-1][step:]))
            step *= 2
        level = np.floor(np.log2(many)).astype(np.int64)
        for k, table in enumerate(least):
            at = level == k
            a = lo[at]
            symbol[some[at]] = np.minimum(table[a], table[a + many[at] - (1 << k)])
    return start, whole, symbol


def covered_words(n: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Which of n words lie in a window that starts at one of ``starts``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return np.cumsum(edge[:n]) > 0


def repeated_in_row(row: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Which windows occur more than once in their own row."""
    order = np.lexsort((whole, row))
    same = (row[order][1:] == row[order][:-1]) & (whole[order][1:] == whole[order][:-1])
    out = np.zeros(len(row), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def kept_bytes(w: Words, row: int, gone: np.ndarray) -> bytes:
    a = w.first[row]
    return b" ".join([w.data[w.start[a + i]:w.end[a + i]].tobytes() for i in np.flatnonzero(~gone)])


def _parts(batches, name: str = "body"):
    for batch in batches:
        texts = batch.column(name).cast(pa.large_string())
        for a, b in slices(np.diff(text_buffers(texts)[1]), BATCH_BYTES):
            yield batch.slice(a, b - a), texts.slice(a, b - a)


def remove_repeats(df: DataFrame, text: str = "text", doc_id: str = "doc_id",
                   window: int = WINDOW, texts: bool = False) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 and, with ``texts``, the kept words."""

    def parse(batches):
        for batch, bodies in _parts(batches):
            n = len(bodies)
            w = words_of(bodies)
            start, whole, symbol = window_symbols(w, window)
            row = w.row[start]
            twice = repeated_in_row(row, whole)
            cut_rows = set(row[twice].tolist())
            digests, hashes, gone_n, kept = [], [], [], []
            for r, body in enumerate(bodies.to_pylist()):
                every = b" ".join((body or "").encode().split())
                digests.append(hashlib.blake2b(every, digest_size=16).digest())
                left, gone = every, 0
                if r in cut_rows:
                    mine = start[twice & (row == r)] - w.first[r]
                    cut = covered_words(int(w.first[r + 1] - w.first[r]), mine, window)
                    left, gone = kept_bytes(w, r, cut), int(cut.sum())
                hashes.append(hashlib.sha256(left).hexdigest())
                gone_n.append(gone)
                kept.append(left.decode() if texts else None)
            order = np.lexsort((symbol, row))
            new = np.ones(len(order), bool)
            new[1:] = (row[order][1:] != row[order][:-1]) | (symbol[order][1:] != symbol[order][:-1])
            at = order[new]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(w.first).astype(np.int64)),
                 pa.array(digests, pa.binary()), pa.array(gone_n, pa.int64()), pa.array(hashes),
                 pa.array(kept, pa.string()),
                 list_array(pa.array(signed(symbol[at])), np.bincount(row[at], minlength=n))],
                ["doc_id", "n_words", "digest", "gone", "sha", "kept", "symbols"])

    source = df.select(col(doc_id).alias("doc_id"), col(text).alias("body"))
    kind = source.schema["doc_id"].dataType.simpleString()
    rows = materialize(source.mapInArrow(
        parse, f"doc_id {kind}, n_words bigint, digest binary, gone bigint, sha string, kept string, "
               "symbols array<bigint>").withColumn("uid", F.monotonically_increasing_id()), "parsed")

    one = rows.groupBy("digest").agg(F.min("uid").alias("rep"), F.count(F.lit(1)).alias("copies"))
    once = rows.select("uid", "symbols").join(one.select(F.col("rep").alias("uid")), "uid", "left_semi")
    symbols = once.select("uid", F.explode("symbols").alias("symbol"))
    shared = symbols.groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("symbol")
    candidates = symbols.join(shared, "symbol").groupBy("uid").agg(F.collect_list("symbol").alias("symbols"))
    wanted = candidates.join(rows.select("uid", "digest"), "uid").select("uid", "digest", "symbols")

    def keyed(batches):
        for batch, bodies in _parts(batches):
            digests = [hashlib.blake2b(b" ".join((t or "").encode().split()), digest_size=16).digest()
                       for t in bodies.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), bodies.cast(pa.string())], ["digest", "body"])

    bodies = source.select("body").mapInArrow(keyed, "digest binary, body string")

    def hashed(batches):
        for batch, bodies in _parts(batches):
            n = len(bodies)
            w = words_of(bodies)
            start, whole, symbol = window_symbols(w, window)
            row = w.row[start]
            lists = batch.column("symbols")
            theirs = np.diff(lists.offsets.to_numpy())
            values = lists.flatten().to_numpy().view(np.uint64)
            wanted_pairs = mix64(values) + np.repeat(np.arange(n), theirs).astype(np.uint64) * _NAME
            hit = np.isin(mix64(symbol) + row.astype(np.uint64) * _NAME, wanted_pairs)
            row, whole = row[hit], whole[hit]
            order = np.lexsort((whole, row))
            new = np.ones(len(order), bool)
            new[1:] = (row[order][1:] != row[order][:-1]) | (whole[order][1:] != whole[order][:-1])
            at = order[new]
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), bodies.cast(pa.string()),
                 list_array(pa.array(signed(whole[at])), np.bincount(row[at], minlength=n))],
                ["uid", "body", "windows"])

    met = bodies.join(wanted, "digest").select("uid", "body", "symbols")
    tested = materialize(met.mapInArrow(hashed, "uid bigint, body string, windows array<bigint>"), "windows")
    single = one.where("copies = 1").select(F.col("rep").alias("uid"))
    each = tested.select("uid", F.explode("windows").alias("whole"))
    # Copies of one text carry one uid, so only windows of different texts pass.
    common = each.groupBy("whole").agg(F.min("uid").alias("a"), F.max("uid").alias("b")).where("a < b").select("whole")
    decided = each.join(common, "whole").groupBy("uid").agg(F.collect_set("whole").alias("common"))

    def cut(batches):
        for batch, bodies in _parts(batches):
            n = len(bodies)
            w = words_of(bodies)
            start, whole, _ = window_symbols(w, window)
            row = w.row[start]
            gone = repeated_in_row(row, whole)
            lists = batch.column("common")
            pairs = mix64(lists.flatten().to_numpy().view(np.uint64)) + np.repeat(
                np.arange(n), np.diff(lists.offsets.to_numpy())).astype(np.uint64) * _NAME
            gone |= np.isin(mix64(whole) + row.astype(np.uint64) * _NAME, pairs)
            covered = covered_words(len(w.hash), start[gone], window)
            hashes, numbers, kept = [], [], []
            for r in range(n):
                mine = covered[w.first[r]:w.first[r + 1]]
                left = kept_bytes(w, r, mine)
                hashes.append(hashlib.sha256(left).hexdigest())
                numbers.append(int(mine.sum()))
                kept.append(left.decode() if texts else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), pa.array(numbers, pa.int64()), pa.array(hashes), pa.array(kept, pa.string())],
                ["uid", "new_gone", "new_sha", "new_kept"])

    result = tested.select("uid", "body").join(decided.join(single, "uid", "left_semi"), "uid").select(
        "uid", "body", "common").mapInArrow(cut, "uid bigint, new_gone bigint, new_sha string, new_kept string")
    whole = (F.col("copies") > 1) & (F.col("n_words") >= window)
    nothing = hashlib.sha256(b"").hexdigest()
    final = rows.select("uid", "doc_id", "n_words", "digest", "gone", "sha", "kept").join(
        one, "digest").join(result, "uid", "left")
    kept = [F.when(whole, F.lit("") if texts else F.lit(None)).otherwise(
        F.coalesce("new_kept", "kept")).alias("kept_text")] if texts else []
    return final.select(
        "doc_id", "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("new_gone", "gone")).alias("n_removed"),
        F.when(whole, nothing).otherwise(F.coalesce("new_sha", "sha")).alias("kept_sha256"), *kept)
