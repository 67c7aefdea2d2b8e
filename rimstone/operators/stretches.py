"""Words in stretches: those of one key that follow each other in the input as one binary value.

A stretch goes through joins and shuffles as one value, whatever the number of its words, and is read with numpy and
Arrow a batch at a time, so that a word costs no row, no object and no turn of a loop. Bytes of equal weight of its
numbers stand together, which shuffles compress.
"""

from __future__ import annotations

import struct
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Functions of this module travel to executors by value, so that executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Number of words, whether their numbers count on by one, bytes of a length, whether there are nulls.
HEAD = "<IBBB"
FIRST = "<q"
# Bits of a word's nulls; those of its places follow.
NO_TEXT, NO_IDX, NO_PLACE = 1, 2, 4
# Bytes of stretches that are read at once: a reader's memory does not grow with the rows of a batch.
CHUNK_BYTES = 8 << 20


def binary(column: pa.Array) -> pa.Array:
    return column.cast(pa.binary() if pa.types.is_string(column.type) or pa.types.is_binary(column.type) else pa.large_binary())


def bounds(lengths: np.ndarray) -> np.ndarray:
    """Where each of the runs of these lengths begins, and the end of the last."""
    found = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=found[1:])
    return found


def changes(batch: pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """Whether a row has another key than the row before it; a null key is always another one."""
    starts = np.zeros(batch.num_rows, dtype=bool)
    starts[:1] = True
    for k in keys:
        column = batch.column(k)
        differs = pc.fill_null(pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)), True)
        starts[1:] |= differs.to_numpy(zero_copy_only=False)
    return starts


def stretches(batch: pa.RecordBatch, keys: Sequence[str], places: Sequence[str]) -> pa.RecordBatch:
    firsts = np.flatnonzero(changes(batch, keys))
    ends = np.append(firsts[1:], batch.num_rows)
    nulls = np.zeros(batch.num_rows, np.uint8)

    def filled(name: str, bit: int, empty) -> pa.Array:
        column = batch.column(name)
        if not column.null_count:
            return column
        nulls[column.is_null().to_numpy(zero_copy_only=False)] |= bit
        return column.fill_null(empty)

    text = filled("text", NO_TEXT, "")
    idx = filled("idx", NO_IDX, 0).to_numpy().astype(np.int64)
    values = np.empty((len(places), batch.num_rows))
    for i, name in enumerate(places):
        values[i] = filled(name, NO_PLACE << i, 0.0).to_numpy()
    weights = values.view(np.uint8).reshape(len(places), batch.num_rows, 8)

    _, offsets, data = binary(text).buffers()
    wide = np.int64 if pa.types.is_large_string(text.type) or pa.types.is_large_binary(text.type) else np.int32
    offsets = np.frombuffer(offsets, wide)[text.offset : text.offset + batch.num_rows + 1]
    data = memoryview(data if data is not None else b"")
    lengths = np.diff(offsets).astype(np.uint32)
    short = lengths.astype(np.uint8)
    longest = np.maximum.reduceat(lengths, firsts)
    skips = np.zeros(batch.num_rows, np.int64)
    skips[1:] = idx[1:] != idx[:-1] + 1
    skips[firsts] = 0
    skipping = np.add.reduceat(skips, firsts)
    with_nulls = np.maximum.reduceat(nulls, firsts)

    made = []
    for a, b, most, skipped, null in zip(firsts.tolist(), ends.tolist(), longest.tolist(), skipping.tolist(), with_nulls.tolist()):
        made.append(
            b"".join(
                (
                    struct.pack(HEAD, b - a, not skipped, 1 if most < 256 else 4, null > 0),
                    idx[a:b].tobytes() if skipped else struct.pack(FIRST, idx[a]),
                    (short if most < 256 else lengths)[a:b].tobytes(),
                    weights[:, a:b].transpose(0, 2, 1).tobytes(),
                    nulls[a:b].tobytes() if null else b"",
                    data[offsets[a] : offsets[b]],
                )
            )
        )
    columns = [batch.column(k).take(pa.array(firsts)) for k in keys]
    return pa.RecordBatch.from_arrays([*columns, pa.array(made, pa.binary())], names=[*keys, "stretch"])


def stretched(words: DataFrame, keys: Sequence[str], places: Sequence[str]) -> DataFrame:
    """One row for each stretch of a key: the keys, and `stretch` with the words' `idx`, `text` and `places`.

    A key has as many of these rows as there are stretches of it, so words in any order are kept whole, only less packed.
    """
    keys, places = list(keys), list(places)
    schema = T.StructType([words.schema[k] for k in keys] + [T.StructField("stretch", T.BinaryType())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield stretches(batch, keys, places)

    return words.select(*keys, "idx", "text", *[F.col(c).cast("double").alias(c) for c in places]).mapInArrow(pack, schema)


@dataclass
class Words:
    """The words of some rows, one after the other: `row` has each word's row, `bounds` where a row's words begin."""

    row: np.ndarray
    bounds: np.ndarray
    idx: np.ndarray
    text: pa.Array
    places: np.ndarray
    nulls: np.ndarray

    def null(self, bits: int) -> np.ndarray:
        return (self.nulls & bits) > 0


def read(parts: pa.Array, n_places: int) -> Words:
    """The words of lists of stretches, in the order in which they are listed."""
    sizes = pc.fill_null(pc.list_value_length(parts), 0).to_numpy()
    counts, idx, lengths, places, nulls, data = [], [], [], [], [], []
    for part in parts.flatten().to_pylist():
        n, counting, width, null = struct.unpack_from(HEAD, part)
        at = struct.calcsize(HEAD)
        counts.append(n)
        if counting:
            first = struct.unpack_from(FIRST, part, at)[0]
            idx.append(np.arange(first, first + n))
            at += struct.calcsize(FIRST)
        else:
            idx.append(np.frombuffer(part, np.int64, n, at))
            at += 8 * n
        lengths.append(np.frombuffer(part, np.uint8 if width == 1 else np.uint32, n, at))
        at += width * n
        weights = np.frombuffer(part, np.uint8, 8 * n * n_places, at).reshape(n_places, 8, n)
        places.append(np.ascontiguousarray(weights.transpose(0, 2, 1)).view(np.float64).reshape(n_places, n))
        at += 8 * n * n_places
        nulls.append(np.frombuffer(part, np.uint8, n, at) if null else np.zeros(n, np.uint8))
        data.append(memoryview(part)[at + n * null :])
    if not counts:
        nothing = np.zeros(0, np.int64)
        none = pa.array([], pa.large_binary())
        return Words(nothing, np.zeros(len(parts) + 1, np.int64), nothing, none, np.zeros((n_places, 0)), nothing.astype(np.uint8))
    nulls = np.concatenate(nulls)
    counts = np.array(counts, np.int64)
    of_row = np.repeat(np.arange(len(parts)), sizes)
    row = np.repeat(of_row, counts)
    offsets = bounds(np.concatenate(lengths))
    valid = None
    if nulls.any():
        valid = pa.py_buffer(np.packbits((nulls & NO_TEXT) == 0, bitorder="little").tobytes())
    buffers = [valid, pa.py_buffer(offsets), pa.py_buffer(b"".join(data))]
    text = pa.Array.from_buffers(pa.large_binary(), len(row), buffers)
    return Words(row, bounds(np.bincount(row, minlength=len(parts))), np.concatenate(idx), text, np.concatenate(places, axis=1), nulls)


def chunks(batch: pa.RecordBatch, column: str = "parts", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of about `most` bytes of stretches; a row with more is a slice of its own."""
    parts = batch.column(column)
    lengths = pc.fill_null(pc.list_value_length(parts), 0).to_numpy()
    ends = bounds(pc.binary_length(parts.flatten()).to_numpy())[bounds(lengths)]
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + most, side="right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


def per_chunk(function: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch):
                made = function(chunk)
                if made.num_rows:
                    yield made

    return run
