"""Shared by the operators: words and hashes of Arrow texts, linked classes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from funnelspark.sources.storage import written

SLICE_BYTES = 1 << 20
_HASHED_BYTES = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened while ``df`` has such a column already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_digest(text: Column) -> Column:
    """16 bytes that stand for a text; null for null."""
    return F.unhex(F.md5(text))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts have at most ``limit`` bytes together, or one row."""
    offsets = utf8(batch.column(column))[1]
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first)
        first = last


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_table(is_word) -> np.ndarray:
    return np.array([bool(is_word(b)) for b in range(256)])


#: Words of lower-case letters, digits and everything beyond ASCII.
PLAIN = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
#: Words between white space.
SPACED = byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
_LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def lower(data: np.ndarray) -> np.ndarray:
    """A to Z in lower case."""
    return _LOWER[data]


def mix(x: np.ndarray) -> np.ndarray:
    """Scatters the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, n of each."""
    if not _powers or len(_powers["up"]) < n:
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            row = np.full(max(n, _HASHED_BYTES + 1), base, np.uint64)
            row[0] = 1
            _powers[key] = np.multiply.accumulate(row)
    return _powers["up"][:n], _powers["down"][:n]


class Words:
    """The words of some texts: text number, begin, end and hash of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: np.ndarray):
        inside = kind[data]
        before, after = np.zeros_like(inside), np.zeros_like(inside)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        before[edges] = False
        after[edges - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.text = np.searchsorted(offsets, self.start, "right") - 1
        self.counts = np.bincount(self.text, minlength=len(offsets) - 1)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.place = np.arange(len(self.start)) - self.first[self.text]
        self.hash = self._hashed(data)

    def _hashed(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.start), np.uint64)
        i = 0
        while i < len(out):
            begin = self.start[i]
            j = max(i + 1, int(np.searchsorted(self.end, begin + _HASHED_BYTES, "right")))
            part = data[begin : self.end[j - 1]].astype(np.uint64) + np.uint64(1)
            up, down = _power(len(part))
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part * up, out=total[1:])
            start, end = self.start[i:j] - begin, self.end[i:j] - begin
            out[i:j] = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
            i = j
        return out

    def runs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The hash of n words from each word on, and whether the text has them."""
        size = len(self.hash)
        out = np.zeros(size, np.uint64)
        if size < n:
            return out, np.zeros(size, bool)
        m = size - n + 1
        factor = 1
        for k in range(n):
            out[:m] += self.hash[k : k + m] * np.uint64(factor)
            factor = factor * 0xFF51AFD7ED558CCD % (1 << 64)
        whole = np.zeros(size, bool)
        whole[:m] = self.text[:m] == self.text[n - 1 :]
        return mix(out), whole


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of ``edges`` (``a``, ``b``): the smallest node it reaches.

    Every round gives each node the smallest root around it and then that root's own
    root, so paths halve; rounds are written tables, and nothing is collected.
    """
    both = written(
        edges.select("a", "b").union(edges.select("b", "a")).where("a != b").distinct(), "edges"
    )
    roots = written(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("root")), "roots")
    while True:
        near = both.join(roots.select(F.col("node").alias("b"), "root"), "b")
        lowest = (
            near.select(F.col("a").alias("node"), "root")
            .union(roots.select("node", "root"))
            .groupBy("node")
            .agg(F.min("root").alias("root"))
        )
        up = lowest.select(F.col("node").alias("root"), F.col("root").alias("above"))
        jumped = lowest.join(up, "root", "left").select(
            "node", F.least("root", F.coalesce("above", "root")).alias("root")
        )
        following = written(jumped, "roots")
        moved = following.join(roots.withColumnRenamed("root", "was"), "node").where("root != was")
        if moved.isEmpty():
            return following
        roots = following


def with_columns(df: DataFrame, **types) -> StructType:
    """The schema of ``df`` with more columns."""
    return StructType([*df.schema.fields, *(StructField(name, kind) for name, kind in types.items())])

