"""Frequency counters of fixed size over all documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tidelog.llm import words as W

#: Number of counters, whatever the corpus; a hash shares its counter with others.
COUNTERS = 1 << 18
PARTS = 64


def slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(COUNTERS)).astype(np.int64)


def frequency_levels(texts: DataFrame, hashes_of: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """For each counter how frequent its hashes are: 0, or a level of doubling.

    ``hashes_of`` gives the hashes of a block of texts (bytes, offsets); all
    hashes of all texts are counted.  Only counters well above the mean get a level.
    """
    part = COUNTERS // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for _, raw, offsets in W.text_blocks(batch.column(0)):
                total += np.bincount(slots(hashes_of(raw, offsets)), minlength=COUNTERS)
        pack = zstandard.ZstdCompressor(level=1)
        yield pa.RecordBatch.from_pydict({"part": pa.array(range(PARTS), pa.int32()), "counts": pa.array(
            [pack.compress(total[i * part:(i + 1) * part].tobytes()) for i in range(PARTS)], pa.binary())})

    def add(key, table):
        unpack = zstandard.ZstdDecompressor()
        total = sum(np.frombuffer(unpack.decompress(x.as_py()), np.int64) for x in table.column("counts"))
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    rows = (texts.select("text").mapInArrow(run, "part int, counts binary").groupBy("part")
            .applyInArrow(add, "part int, counts binary").collect())
    total = np.zeros(COUNTERS, np.int64)
    for i, counts in rows:
        total[i * part:(i + 1) * part] = np.frombuffer(counts, np.int64)
    mean = max(total.mean(), 1)
    return np.where(total >= 4 * mean, np.log2(np.maximum(total, 1) / mean), 0).astype(np.uint8)


def packed_texts(docs: DataFrame, key: str, kind: str, **more: str) -> DataFrame:
    """``key``, more columns with their types, and the text, compressed for a shuffle."""
    kinds = {key: kind, **more}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(
                [pack.compress(x.as_buffer()) for x in batch.columns[-1]], pa.binary())], [*kinds, "packed"])

    return docs.select(*kinds, "text").mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in kinds.items()) + ", packed binary")
