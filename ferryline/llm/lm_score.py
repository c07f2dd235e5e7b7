"""Language-model scores from a subword lattice.

An existing piece vocabulary spans all segmentations of a text; a unigram model over
the pieces gives each segmentation a probability, and the forward recursion in log
space adds them up to the marginal probability of the text. No piece crosses a word,
so the lattice of a text is the chain of its words' lattices, and each distinct word
is worked out once, in parallel, over a table of words that grows with the corpus.

The vocabulary's own scores start the model (ranks of a merge vocabulary are read as a
Zipf law, log probabilities as they are); rounds of expectation maximisation over all
words of the training rows, weighted by their counts, fit it: each task adds up
expected piece counts from forward and backward sums, Spark adds the tasks. Single
bytes are pieces too, so every word has a probability. The end of a text is a piece.

The same word table carries the plain word counts of the base score. Scoring needs the
table for every token: the ``frequent`` words (a bounded number) are held by each task,
the rest meet the table in one join by word, reduced per document on either side.

Results for odd input: NULL and empty texts are one end; without training rows the
base score is log10(0.1/0.1) = 0 a token and the pieces keep their first scores; repeated
rows count each; ids that are NULL hash as the empty string; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferryline.llm.rows import col
from ferryline.llm.words import list_array, mix64, slices, text_buffers, words_of
from ferryline.shared import materialize

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
ROUNDS = 2
FREQUENT = 50_000
#: Weight of the first scores against the counts, in expected pieces.
PRIOR = 1000.0
#: Bytes of text and cells of a lattice worked on at once.
BATCH_BYTES, CELLS = 8_000_000, 2_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
NO = -1e30
#: Bits of the filter before the search among the pieces, and its odd multiplier.
FILTER_BITS, _MIX = 20, np.uint64(0xBF58476D1CE4E5B9)


@lru_cache
def read_pieces(path: str) -> tuple[tuple[bytes, ...], tuple[float, ...]]:
    """Pieces as bytes (a space marks the start of a word) and their first log probabilities."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found: dict[bytes, float] = {}
    scores = []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i).replace("▁", " ").encode()
        if piece and b" " not in piece[1:]:
            scores.append((piece, model.get_score(i)))
    ranked = all(s <= 0 and s == int(s) for _, s in scores)
    for piece, s in scores:
        found[piece] = -np.log(10.0 - s) if ranked else s
    lowest = min(found.values(), default=0.0) - np.log(10.0)
    for b in range(256):
        found.setdefault(bytes([b]), lowest)
    total = np.logaddexp.reduce(np.array(list(found.values())))
    pieces = tuple(sorted(found))
    return pieces, tuple(float(found[p] - total) for p in pieces)


def _hash(piece: bytes) -> int:
    value = 0
    for b in piece:
        value = (value * int(_BASE) + b + 1) & (2**64 - 1)
    return value


def _slot(value: np.ndarray) -> np.ndarray:
    """The bit of the filter that stands for a hash before mixing."""
    return ((value * _MIX) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


@dataclass
class Pieces:
    """Sorted hashes of the pieces and, in the same order, their log probabilities.

    ``seen`` marks the slots of their hashes; most substrings of a word are no piece and
    stop there, without a search among the hashes.
    """

    hashes: np.ndarray
    logs: np.ndarray
    sizes: list[int]
    seen: np.ndarray

    def parts(self) -> tuple:
        return self.hashes, self.logs, self.sizes, self.seen

    @staticmethod
    def of(pieces: tuple[bytes, ...], logs: np.ndarray) -> Pieces:
        plain = np.array([_hash(p) for p in pieces], np.uint64)
        hashes = mix64(plain)
        order = np.argsort(hashes)
        seen = np.zeros(1 << FILTER_BITS, bool)
        seen[_slot(plain)] = True
        return Pieces(hashes[order], np.asarray(logs)[order], sorted({len(p) for p in pieces}), seen)

    def edges(self, letters: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each piece size that occurs: the positions and words of the pieces, and their places.

        ``letters`` has a row for each position and a column for each word.
        """
        wide = len(letters)
        plus = letters.astype(np.uint64) + np.uint64(1)
        value = np.zeros_like(plus)
        for size in range(1, min(self.sizes[-1], wide) + 1):
            value = value[:wide - size + 1] * _BASE + plus[size - 1:]
            if size not in self.sizes:
                continue
            at, word = np.nonzero(self.seen[_slot(value)])
            key = mix64(value[at, word])
            place = np.minimum(np.searchsorted(self.hashes, key), len(self.hashes) - 1)
            hit = self.hashes[place] == key
            if hit.any():
                yield size, at[hit], word[hit], place[hit]

    def lattice(self, letters: np.ndarray) -> tuple[list[tuple], dict[int, np.ndarray]]:
        """The edges, and for each size the log probability of the piece at each position."""
        found, logs = [], {}
        for size, at, word, place in self.edges(letters):
            found.append((size, at, word, place))
            logs[size] = np.full((len(letters) - size + 1, letters.shape[1]), NO)
            logs[size][at, word] = self.logs[place]
        return found, logs


def _add(terms: list[np.ndarray]) -> np.ndarray:
    """Log of the sum of the exponentials."""
    top = terms[0]
    for x in terms[1:]:
        top = np.maximum(top, x)
    return top + np.log(sum([np.exp(x - top) for x in terms]))


def forward(logs: dict[int, np.ndarray], wide: int, words: int) -> np.ndarray:
    alpha = np.full((wide + 1, words), NO)
    alpha[0] = 0
    used = {s: (x > NO).any(axis=1) for s, x in logs.items()}
    for end in range(1, wide + 1):
        alpha[end] = _add([alpha[end - s] + logs[s][end - s] for s in logs if s <= end and used[s][end - s]])
    return alpha


def backward(logs: dict[int, np.ndarray], wide: int, words: int) -> np.ndarray:
    beta = np.full((wide + 1, words), NO)
    beta[wide] = 0
    used = {s: (x > NO).any(axis=1) for s, x in logs.items()}
    for at in range(wide - 1, -1, -1):
        beta[at] = _add([beta[at + s] + logs[s][at] for s in logs if at + s <= wide and used[s][at]])
    return beta


def by_width(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices and letters (with the word mark) of words of equal width, in bounded groups."""
    width = np.array([len(w) for w in words], np.int64)
    order = np.argsort(width, kind="stable")
    cuts = np.flatnonzero(np.diff(width[order])) + 1
    for group in np.split(order, cuts):
        if not len(group):
            continue
        wide = int(width[group[0]]) + 1
        many = max(1, CELLS // (wide * 16))
        for i in range(0, len(group), many):
            part = group[i:i + many]
            text = b"".join([b" " + words[j] for j in part])
            letters = np.frombuffer(text, np.uint8).reshape(len(part), wide)
            yield part, np.ascontiguousarray(letters.T)


def word_logs(pieces: Pieces, words: list[bytes]) -> np.ndarray:
    """Natural log of the marginal probability of each word."""
    out = np.zeros(len(words))
    for part, letters in by_width(words):
        _, logs = pieces.lattice(letters)
        out[part] = forward(logs, *letters.shape)[-1]
    return out


def expected(pieces: Pieces, words: list[bytes], counts: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in the words, by their counts."""
    total = np.zeros(len(pieces.hashes))
    for part, letters in by_width(words):
        found, logs = pieces.lattice(letters)
        alpha, beta = forward(logs, *letters.shape), backward(logs, *letters.shape)
        for size, at, word, place in found:
            use = np.exp(alpha[at, word] + pieces.logs[place] + beta[at + size, word] - alpha[-1, word])
            total += np.bincount(place, use * counts[part][word], len(total))
    return total


def _lowered(column: pa.Array) -> pa.Array:
    data, offsets = text_buffers(column)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(column), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(_LOWER[data].tobytes())]
    ).view(pa.large_string())


def _strings(w, at: np.ndarray) -> pa.Array:
    """The words at the places ``at`` as a string column."""
    size = (w.end - w.start)[at]
    offsets = np.zeros(len(at) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    inner = np.arange(int(offsets[-1])) - np.repeat(offsets[:-1], size)
    body = w.data[np.repeat(w.start[at], size) + inner]
    return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets.tobytes()), pa.py_buffer(body.tobytes()))


def _pieces_of_batches(batches, name: str) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Parts of the batches whose texts have a bounded total."""
    for batch in batches:
        texts = batch.column(name).cast(pa.large_string())
        size = np.diff(text_buffers(texts)[1])
        for a, b in slices(size, BATCH_BYTES):
            yield batch.slice(a, b - a), _lowered(texts.slice(a, b - a))


def count_words(df: DataFrame, text: str, learn: Column) -> DataFrame:
    """``(word, c, n)``: occurrences of each word in training rows and in all rows."""

    def run(batches):
        for batch, texts in _pieces_of_batches(batches, "body"):
            w = words_of(texts)
            _, first, where, n = np.unique(w.hash, return_index=True, return_inverse=True, return_counts=True)
            learnt = batch.column("learn").to_numpy(zero_copy_only=False).astype(float)
            c = np.bincount(where, learnt[w.row], len(first)).astype(np.int64)
            if len(first):
                yield pa.RecordBatch.from_arrays(
                    [_strings(w, first).cast(pa.string()), pa.array(c), pa.array(n.astype(np.int64))], ["word", "c", "n"])

    found = df.select(col(text).alias("body"), learn.alias("learn")).mapInArrow(run, "word string, c bigint, n bigint")
    return found.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def fit_pieces(words: DataFrame, ends: int, path: str, rounds: int) -> tuple[Pieces, float]:
    """The fitted pieces, and the log probability of the end of a text."""
    names, first = read_pieces(path)
    logs = np.array(first)
    end = np.log(0.5)
    context = words.sparkSession.sparkContext
    learnt = words.where("c > 0").select("word", "c")
    for _ in range(rounds):
        current = context.broadcast(Pieces.of(names, logs + np.log1p(-np.exp(end))).parts())

        def run(batches, current=current):
            known = Pieces(*current.value)
            total = np.zeros(len(known.hashes))
            for batch in batches:
                bodies = [x.encode() for x in batch.column("word").to_pylist()]
                total += expected(known, bodies, batch.column("c").to_numpy(zero_copy_only=False).astype(float))
            at = np.flatnonzero(total > 0)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["piece", "uses"])

        rows = learnt.mapInArrow(run, "piece int, uses double").groupBy("piece").agg(
            F.sum("uses").alias("uses")).collect()  # at most one row for each piece of the vocabulary
        order = np.argsort(mix64(np.array([_hash(p) for p in names], np.uint64)))
        uses = np.exp(np.array(first)) * PRIOR
        for piece, n in rows:
            uses[order[piece]] += n
        logs = np.log(uses / uses.sum())
        end = np.log((ends + 0.5) / (uses.sum() + ends + 1))
        current.unpersist()
    return Pieces.of(names, logs + np.log1p(-np.exp(end))), float(end)


SCHEMA = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
          "base_score double, score double")


def score_texts(df: DataFrame, learn: Column, text: str = "text", doc_id: str = "doc_id",
                vocabulary: str = VOCABULARY, rounds: int = ROUNDS, frequent: int = FREQUENT) -> DataFrame:
    """The columns of ``SCHEMA`` for every row; ``learn`` marks the training rows."""
    learn = F.coalesce(learn, F.lit(False))
    counted = materialize(count_words(df, text, learn), "word-counts")
    ends = df.where(learn).count()
    sums = counted.agg(F.sum("c").alias("c"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
    tokens, kinds = (sums["c"] or 0) + ends, (sums["v"] or 0) + (ends > 0)
    pieces, end_log = fit_pieces(counted, ends, vocabulary, rounds)
    below = tokens + 0.1 * (kinds + 1)
    ten = float(np.log(10))
    model = df.sparkSession.sparkContext.broadcast(pieces.parts())

    def lattice(batches):
        fitted = Pieces(*model.value)
        for batch in batches:
            bodies = [x.encode() for x in batch.column("word").to_pylist()]
            logs = word_logs(fitted, bodies) / ten
            c = batch.column("c").to_numpy(zero_copy_only=False)
            base = np.log10((c + 0.1) / below)
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), pa.array(c > 0), pa.array(base), pa.array(logs), batch.column("n")],
                ["word", "known", "base", "model", "n"])

    table = materialize(counted.mapInArrow(
        lattice, "word string, known boolean, base double, model double, n bigint"), "word-scores")
    top = table.orderBy(F.desc("n"), "word").limit(frequent).toArrow()  # bounded by `frequent`
    w = words_of(top.column("word").combine_chunks().cast(pa.large_string())) if top.num_rows else None
    keys = w.hash if w is not None else np.zeros(0, np.uint64)
    order = np.argsort(keys)
    held = df.sparkSession.sparkContext.broadcast((keys[order], *[
        top.column(c).to_numpy().astype(float)[order] for c in ("known", "base", "model")]))

    def split(batches):
        known_keys, known, base, logs = held.value
        for batch, texts in _pieces_of_batches(batches, "body"):
            n = batch.num_rows
            w = words_of(texts)
            if len(known_keys):
                at = np.minimum(np.searchsorted(known_keys, w.hash), len(known_keys) - 1)
                hit = known_keys[at] == w.hash
            else:
                at, hit = np.zeros(len(w.hash), np.int64), np.zeros(len(w.hash), bool)
            sums = [np.bincount(w.row[hit], x[at[hit]], n).astype(float) for x in (known, base, logs)]
            rest = np.flatnonzero(~hit)
            pair = mix64(w.hash[rest]) ^ (w.row[rest].astype(np.uint64) * _BASE)
            _, one, tf = np.unique(pair, return_index=True, return_counts=True)
            back = np.argsort(rest[one])
            places, tf = rest[one][back], tf[back].astype(np.int32)
            per_row = np.bincount(w.row[places], minlength=n)
            items = pa.StructArray.from_arrays(
                [_strings(w, places).cast(pa.string()), pa.array(tf)], ["word", "tf"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("learn"), pa.array(np.diff(w.first).astype(np.int64) + 1),
                 pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2]),
                 list_array(items, per_row)],
                ["doc_id", "learn", "n_tokens", "known", "base", "model", "rest"])

    rows = materialize(df.select(
        col(doc_id).cast("bigint").alias("doc_id"), learn.alias("learn"), col(text).alias("body")
    ).mapInArrow(split, "doc_id bigint, learn boolean, n_tokens bigint, known bigint, base double, "
                        "model double, rest array<struct<word:string,tf:int>>")
        .withColumn("uid", F.monotonically_increasing_id()), "lm-rows")
    rare = rows.select("uid", F.explode("rest").alias("r")).select("uid", "r.word", "r.tf").join(
        table.select("word", F.col("known").alias("w_known"), F.col("base").alias("w_base"),
                     F.col("model").alias("w_model")), "word")
    added = rare.groupBy("uid").agg(
        F.sum(F.when(F.col("w_known"), F.col("tf")).otherwise(0)).alias("more_known"),
        F.sum(F.col("tf") * F.col("w_base")).alias("more_base"),
        F.sum(F.col("tf") * F.col("w_model")).alias("more_model"))
    end_base = float(np.log10((ends + 0.1) / below))

    def with_more(name: str) -> Column:
        return F.col(name) + F.coalesce(f"more_{name}", F.lit(0))

    return rows.select("uid", "doc_id", "learn", "n_tokens", "known", "base", "model").join(
        added, "uid", "left").select(
        "doc_id", (~F.col("learn")).alias("held_out"), "n_tokens",
        (with_more("known") + int(ends > 0)).alias("n_known"), F.lit(tokens).cast("bigint").alias("train_tokens"),
        (with_more("base") + end_base).alias("base_score"),
        (with_more("model") + end_log / ten).alias("score"))


