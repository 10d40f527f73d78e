"""Count-min sketches built in tasks, merged by blocks, and read as bitmaps.

A task counts its hashes in ``depth`` rows of ``2^log2`` cells and sends, for each block of 65,536 cells,
the cells it touched. Blocks are merged by Spark, one block at a time in memory. The merged counts
never fall below the true ones, so the bitmap "all rows count at least ``least``" loses no hash that
occurs that often. Its size is fixed by ``log2`` and ``depth`` (``depth * 2^log2 / 8`` bytes, at most 32 MB
here), which bounds what passes through the driver and is broadcast; a larger input makes it less
selective, never wrong.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from heliolake.llm.words import U, mix

BLOCK = 1 << 16
LOG2_LEAST, LOG2_MOST = 16, 27
SCHEMA = "block long, cells binary, counts binary"
#: Hashes that a task holds before it sends their cells.
HELD = 1 << 19
_SEEDS = tuple(U(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3))


def width(items: float, room: int = 16) -> int:
    """log2 of the cells for about ``items`` hashes, within the fixed bounds."""
    return min(max(int(max(items, 1) * room - 1).bit_length(), LOG2_LEAST), LOG2_MOST)


def cells_of(hashes: np.ndarray, row: int, log2: int) -> np.ndarray:
    return (mix(hashes ^ _SEEDS[row]) >> U(64 - log2)).astype(np.int64)


def gaps(cells: np.ndarray) -> bytes:
    """Ascending cells of a block as one byte per gap; 255 stands for 255 more and goes on."""
    step = np.diff(cells, prepend=0)
    size = step // 255 + 1
    out = np.full(int(size.sum()), 255, np.uint8)
    out[np.cumsum(size) - 1] = step % 255
    return out.tobytes()


def from_gaps(raw) -> np.ndarray:
    steps = np.frombuffer(raw, np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps != 255]


def counted(hashes: np.ndarray, log2: int, depth: int) -> Iterator[tuple[int, bytes, bytes]]:
    """``(block, cells as gaps, places and counts of cells met more than once)`` of the blocks that the hashes touch."""
    for row in range(depth):
        cells, counts = np.unique(cells_of(hashes, row, log2), return_counts=True)
        blocks, at = np.unique(cells >> 16, return_index=True)
        ends = np.append(at[1:], len(cells))
        cells &= BLOCK - 1
        for b, i, j in zip(blocks.tolist(), at.tolist(), ends.tolist()):
            more = np.flatnonzero(counts[i:j] > 1)
            yield (row << 32) | b, gaps(cells[i:j]), np.stack((more, np.minimum(counts[i:j][more], 65535)), 1).astype("<u2").tobytes()


class Counter:
    """Collects hashes in a task and gives their sketch rows in bounded portions."""

    def __init__(self, log2: int, depth: int):
        self.log2, self.depth, self.parts, self.held = log2, depth, [], 0

    def add(self, hashes: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
        self.parts.append(hashes)
        self.held += len(hashes)
        if self.held >= HELD:
            yield from self.flush()

    def flush(self) -> Iterator[tuple[int, bytes, bytes]]:
        if self.held:
            yield from counted(np.concatenate(self.parts), self.log2, self.depth)
        self.parts, self.held = [], 0


def as_batch(rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(list(cols[0]), pa.int64()), pa.array(list(cols[1]), pa.binary()), pa.array(list(cols[2]), pa.binary())],
                                      names=["block", "cells", "counts"])


def sketch(df: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], log2: int, depth: int) -> DataFrame:
    """Sketch rows of ``df``: ``hashes`` gives the hashes of one batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(log2, depth)
        for batch in batches:
            for h in hashes(batch):
                rows = list(counter.add(h))
                if rows:
                    yield as_batch(rows)
        yield as_batch(list(counter.flush()))
    return df.mapInArrow(run, SCHEMA)


def _merge(least: list[int]):
    """Cells of merged blocks: as bits for one threshold, else four bits that tell how many thresholds (at most 15) the count reaches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, counts = None, np.zeros(BLOCK, np.uint32)

        def done():
            if len(least) == 1:
                cells = np.packbits(counts >= least[0])
            else:
                level = np.searchsorted(least, counts, "right").astype(np.uint8)
                cells = level[::2] | level[1::2] << 4
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([cells.tobytes()], pa.binary())], names=["block", "cells"])

        for batch in batches:
            for b, cells, n in zip(batch.column("block").to_pylist(), batch.column("cells"), batch.column("counts")):
                if b != block:
                    if block is not None and (counts >= least[0]).any():
                        yield done()
                    block = b
                    counts[:] = 0
                at = from_gaps(cells.as_buffer())       # different cells, so plain indexing adds them all
                add = np.ones(len(at), np.uint32)
                more = np.frombuffer(n.as_buffer(), "<u2").reshape(-1, 2)
                add[more[:, 0]] = more[:, 1]
                counts[at] = np.minimum(counts[at] + add, 1 << 30)
        if block is not None and (counts >= least[0]).any():
            yield done()
    return run


class Bitmap:
    """Hashes whose estimated count is at least the sketch's ``least``; pickled with its broadcast."""

    def __init__(self, log2: int, depth: int, bits: np.ndarray):
        self.log2, self.depth, self.bits = log2, depth, bits

    def __contains__(self, h: int) -> bool:
        return bool(self.holds(np.array([h], U))[0])

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for row in range(self.depth):
            cells = cells_of(hashes, row, self.log2)
            out &= (self.bits[row][cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1 == 1
        return out


class Levels:
    """How many of the sketch's thresholds a hash's estimated count reaches (four bits a cell, one row)."""

    def __init__(self, log2: int, cells: np.ndarray):
        self.log2, self.cells = log2, cells

    def of(self, hashes: np.ndarray) -> np.ndarray:
        at = cells_of(hashes, 0, self.log2)
        return (self.cells[at >> 1] >> ((at & 1) << 2).astype(np.uint8)) & np.uint8(15)


def _blocks(rows: DataFrame, least: list[int]) -> DataFrame:
    return rows.repartition("block").sortWithinPartitions("block").mapInArrow(_merge(least), "block long, cells binary")


def merged(spark: SparkSession, rows: DataFrame, log2: int, depth: int, least: int):
    """The broadcast bitmap of the merged sketch."""
    bits = np.zeros((depth, max(1 << log2, BLOCK) >> 3), np.uint8)
    for r in _blocks(rows, [least]).collect():
        at = (r["block"] & 0xFFFFFFFF) * (BLOCK >> 3)
        bits[r["block"] >> 32, at:at + (BLOCK >> 3)] = np.frombuffer(r["cells"], np.uint8)
    return spark.sparkContext.broadcast(Bitmap(log2, depth, bits))


def levels(spark: SparkSession, rows: DataFrame, log2: int, thresholds: list[int]):
    """The broadcast levels of a merged sketch of depth 1 (``2^log2 / 2`` bytes)."""
    if not 1 < len(thresholds) < 16:
        raise ValueError("2 to 15 thresholds")
    cells = np.zeros(max(1 << log2, BLOCK) >> 1, np.uint8)
    for r in _blocks(rows, thresholds).collect():
        cells[r["block"] * BLOCK >> 1:(r["block"] + 1) * BLOCK >> 1] = np.frombuffer(r["cells"], np.uint8)
    return spark.sparkContext.broadcast(Levels(log2, cells))
