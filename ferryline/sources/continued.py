"""Records that go on in the next line: an escaped line feed inside, a line feed after.

A line that ends in an odd number of backslashes is continued by the next one. Files are
read in blocks by many tasks, so a record may begin in one block and end in another. Each
task puts together what lies within its blocks; batches without such lines pass
unchanged. Only the pieces at the edges of blocks are shuffled: a block's lines up to its
first whole record, and the open ones at its end. Put in order by file and block they complete each
other; blocks within a long record are open from end to end and link up likewise. Whether a line is continued
is known from the line alone, whatever block it is in, so no task needs to know another's state.

The edges are found in a pass of their own, which reads the text a second time but writes nothing.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferryline.sources.text import PROVENANCE, read_lines

# These functions travel to the executors whole, so nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: What a piece of text is to its block.
WHOLE, EDGE = 0, 1

_FILE, _BLOCK, _PARTITION = PROVENANCE
_PIECES = f"value string, {_FILE} string, {_BLOCK} bigint, {_PARTITION} int, _place int, _number bigint, _open boolean"


def is_continued(lines: pa.Array) -> np.ndarray:
    """Which lines (bytes) end in an odd number of backslashes; only those ending in one are looked at."""
    ends = pc.ends_with(lines, b"\\").to_numpy(zero_copy_only=False).astype(bool)
    for i in np.flatnonzero(ends):
        line = lines[int(i)].as_py()
        ends[i] = (len(line) - len(line.rstrip(b"\\"))) % 2 == 1
    return ends


class _Block:
    """The lines of one block, in order, as they come; bytes, which need not be UTF-8."""

    def __init__(self, file: str, start: int, partition: int):
        self.key = (file, start, partition)
        self.inside = start == 0  #: a file's first line begins a record
        self.held: list[bytes] = []
        self.edges: list[tuple[bytes, int, bool]] = []

    def take(self, lines: pa.Array) -> pa.Array:
        """The records that are whole after these lines."""
        flags = is_continued(lines)
        first = bool(self.held) or not self.inside
        touched = np.flatnonzero(flags | np.append(first, flags[:-1]))  # continued or a continuation
        if not len(touched):
            return lines
        parts, begin = [], 0
        for run in np.split(touched, np.flatnonzero(np.diff(touched) != 1) + 1):
            parts.append(lines.slice(begin, run[0] - begin))
            records = [r for k in run.tolist() if (r := self._add(lines[k].as_py(), bool(flags[k]))) is not None]
            parts.append(pa.array(records, lines.type))
            begin = int(run[-1]) + 1
        return pa.concat_arrays([*parts, lines.slice(begin)])

    def _add(self, line: bytes, continued: bool) -> bytes | None:
        """The record that ``line`` ends, unless it began before this block."""
        self.held.append(line)
        if continued:
            return None
        record, self.held = b"\n".join(self.held), []
        if self.inside:
            return record
        self.edges.append((record, 0, False))
        self.inside = True
        return None

    def end(self) -> list[tuple[bytes, int, bool]]:
        if self.held:
            self.edges.append((b"\n".join(self.held), len(self.edges), True))
        return self.edges


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block: _Block | None = None

    def rows(key: tuple, values: pa.Array, place: int, numbers=None, opens=None) -> pa.RecordBatch:
        n = len(values)
        return pa.RecordBatch.from_arrays(
            [values.view(pa.string()), pa.array([key[0]] * n, pa.string()), pa.array([key[1]] * n, pa.int64()),
             pa.array([key[2]] * n, pa.int32()), pa.array([place] * n, pa.int32()),
             pa.array(numbers or [0] * n, pa.int64()), pa.array(opens or [False] * n, pa.bool_())],
            ["value", _FILE, _BLOCK, _PARTITION, "_place", "_number", "_open"])

    def ended() -> Iterator[pa.RecordBatch]:
        if block is not None and (edges := block.end()):
            yield rows(block.key, pa.array([e[0] for e in edges], pa.binary()), EDGE,
                       [e[1] for e in edges], [e[2] for e in edges])

    for batch in batches:
        lines, starts, files = batch.column("value").view(pa.binary()), batch.column(_BLOCK), batch.column(_FILE).dictionary_encode()
        partition = batch.column(_PARTITION)[0].as_py() if len(lines) else 0
        codes, at = files.indices.to_numpy(zero_copy_only=False), starts.to_numpy(zero_copy_only=False)
        changes = np.flatnonzero((np.diff(codes) != 0) | (np.diff(at) != 0)) + 1 if len(lines) else []
        cuts = [0, *[int(c) for c in changes], len(lines)]
        for low, high in zip(cuts, cuts[1:]):
            if low == high:
                continue
            key = (files.dictionary[int(codes[low])].as_py(), int(at[low]), partition)
            if block is None or block.key != key:
                yield from ended()
                block = _Block(*key)
            whole = block.take(lines.slice(low, high - low))
            if len(whole):
                yield rows(key, whole, WHOLE)
    yield from ended()


def read_continued(spark: SparkSession, path: str, *, provenance: bool = False) -> DataFrame:
    """One row ``value`` per record of files whose records may hold escaped line feeds.

    With ``provenance`` as :func:`read_lines`: a record belongs to the block it begins in. A record that is
    open at the end of its file keeps its last backslash, which decoding rejects.
    """
    def pieces() -> DataFrame:
        return read_lines(spark, path, provenance=True).mapInArrow(_pieces, _PIECES)

    columns = ["value", *PROVENANCE] if provenance else ["value"]
    in_file = Window.partitionBy(_FILE).orderBy(_BLOCK, "_number")
    follows = F.lag("_open", 1, False).over(in_file)
    edges = pieces().where(F.col("_place") == EDGE).withColumn("_follows", follows).withColumn(
        "_record", F.sum((~F.col("_follows")).cast("bigint")).over(in_file))
    piece = F.struct(_BLOCK, "_number", "value", _PARTITION)
    joined = edges.groupBy(_FILE, "_record").agg(F.sort_array(F.collect_list(piece)).alias("p")).select(
        F.array_join("p.value", "\n").alias("value"), _FILE,
        F.col("p")[0][_BLOCK].alias(_BLOCK), F.col("p")[0][_PARTITION].alias(_PARTITION))
    return pieces().where(F.col("_place") == WHOLE).select(*columns).unionByName(joined.select(*columns))
