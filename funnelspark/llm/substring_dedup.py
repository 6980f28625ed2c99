"""Removal of word runs that an earlier document has, by difference-cover anchors.

A window is 13 words. Of every 7 consecutive places, 0, 1 and 3 are cover places: for any
two places one shift below 7 takes both to cover places. So two equal windows share a run
of 13 - 6 = 7 words that begins at a cover place in both. Only these anchors, 3 of 7
places, are hashed and shuffled first; the windows around repeated anchors follow.

Texts travel in compressed blocks of about 2 MB. A block sends each anchor once, to the
bucket of its hash, and gets one bit back; so an anchor in a third of all documents costs
one entry a block, and neither buckets nor blocks grow with a hot passage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from funnelspark.llm.common import SPACED, Words, free_name, slices, utf8
from funnelspark.sources.storage import written

WINDOW = 13
PERIOD = 7
COVER = (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1
#: Bytes of text whose anchors make one bucket.
BUCKET_BYTES = 16 << 20

_MESSAGE = "key long, kind int, other long, payload binary"
_SCHEMA = pa.schema(
    [("key", pa.int64()), ("kind", pa.int32()), ("other", pa.int64()), ("payload", pa.binary())]
)
_TEXTS, _ANCHORS, _REPEATED, _WINDOWS, _EARLIER = range(5)


def _messages(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], _SCHEMA)


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _short(hashes: np.ndarray) -> np.ndarray:
    """Five bytes a hash; the bucket holds more bits of it."""
    return np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8)[:, :5]


class _Block:
    """Words, anchors and windows of one block, the same each time it is unpacked."""

    def __init__(self, batch: pa.RecordBatch, ids: str, text: str, buckets: int):
        self.data, self.offsets = utf8(batch.column(text))
        self.words = words = Words(self.data, self.offsets, SPACED)
        ids = batch.column(ids)
        self.known = ids.is_valid().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        hashes, whole = words.runs(ANCHOR)
        at = np.flatnonzero(whole & np.isin(words.place % PERIOD, COVER) & self.known[words.text])
        bucket = (hashes[at] >> np.uint64(40)) % np.uint64(buckets)
        # The lowest bit tells an anchor that two documents of the block have.
        low = hashes[at] & np.uint64((1 << 40) - 2) | bucket << np.uint64(40)
        order = np.argsort(low, kind="stable")
        fresh = np.ones(len(at), bool)
        fresh[1:] = low[order][1:] != low[order][:-1]
        number = np.cumsum(fresh) - 1
        self.at, self.number = at[order], number
        self.anchors = low[order][fresh]
        self.bucket = (self.anchors >> np.uint64(40)).astype(np.int64)
        owner = self.ids[words.text[self.at]]
        least = np.full(len(self.anchors), np.iinfo(np.int64).max)
        most = np.full(len(self.anchors), np.iinfo(np.int64).min)
        np.minimum.at(least, number, owner)
        np.maximum.at(most, number, owner)
        self.shared = least < most

    def sent(self, block: int) -> list[tuple]:
        values = _short(self.anchors | self.shared.astype(np.uint64))
        return [
            (int(b), _ANCHORS, block, values[i:j].tobytes()) for b, i, j in _stretches(self.bucket)
        ]

    def windows(self, repeated: np.ndarray, buckets: int) -> None:
        """The windows with a repeated anchor, once each, with the smallest id that has them."""
        words = self.words
        hashes, whole = words.runs(WINDOW)
        marks = np.zeros(len(hashes) + PERIOD + 1, np.int64)
        marks[self.at[repeated[self.number]]] = 1
        total = np.concatenate([[0], np.cumsum(marks)])
        n = np.arange(len(hashes))
        self.start = n[whole & (total[n + PERIOD] > total[n])]
        bucket = (hashes[self.start] >> np.uint64(20)) % np.uint64(buckets)
        order = np.lexsort((hashes[self.start], bucket))
        self.start = self.start[order]
        self.window = hashes[self.start]
        bucket = bucket[order].astype(np.int64)
        fresh = np.ones(len(order), bool)
        fresh[1:] = self.window[1:] != self.window[:-1]
        self.nth = np.cumsum(fresh) - 1
        self.window, self.window_bucket = self.window[fresh], bucket[fresh]
        self.owner = self.ids[words.text[self.start]]
        self.least = np.full(len(self.window), np.iinfo(np.int64).max)
        np.minimum.at(self.least, self.nth, self.owner)

    def sent_windows(self, block: int) -> list[tuple]:
        both = np.stack([self.window, self.least.view(np.uint64)], 1)
        return [
            (int(b), _WINDOWS, block, np.ascontiguousarray(both[i:j]).tobytes())
            for b, i, j in _stretches(self.window_bucket)
        ]

    def removed(self, earlier: np.ndarray) -> np.ndarray:
        """Whether each word is in a window that a smaller id has."""
        hit = self.start[earlier[self.nth] | (self.least[self.nth] < self.owner)]
        steps = np.zeros(len(self.words.hash) + WINDOW + 1, np.int64)
        np.add.at(steps, hit, 1)
        np.add.at(steps, hit + WINDOW, -1)
        return np.cumsum(steps)[: len(self.words.hash)] > 0

    def joined(self, kept: np.ndarray) -> pa.Array:
        """The kept words of each text, one space between them."""
        words = self.words
        out = np.full(len(self.data) + 1, 0x20, np.uint8)
        keep = np.zeros(len(self.data) + 2, np.int8)
        start, end, text = words.start[kept], words.end[kept], words.text[kept]
        more = np.zeros(len(start), bool)
        more[:-1] = text[1:] == text[:-1]
        np.add.at(keep, start, 1)
        np.add.at(keep, end + more, -1)
        inside = np.cumsum(keep, dtype=np.int8)[:-1] > 0
        letters = SPACED[self.data]
        out[:-1][letters] = self.data[letters]
        sizes = np.zeros(len(self.offsets) - 1, np.int64)
        np.add.at(sizes, text, end - start + more)
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        buffers = [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(out[inside].tobytes())]
        return pa.Array.from_buffers(pa.large_string(), len(sizes), buffers)


def _stretches(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, begin, end) of each stretch of equal values."""
    edges = np.flatnonzero(np.diff(values)) + 1
    for i, j in zip([0, *edges], [*edges, len(values)], strict=True):
        if j > i:
            yield values[i], int(i), int(j)


def _bits(messages: pa.Table, kind: int, buckets: np.ndarray) -> np.ndarray:
    """Answers of all buckets of a block, in the order of what it had sent."""
    found = messages.filter(pa.compute.equal(messages["kind"], kind))
    answers = dict(zip(found["other"].to_pylist(), found["payload"].to_pylist(), strict=True))
    parts = [
        np.unpackbits(np.frombuffer(answers[int(b)], np.uint8), count=j - i) for b, i, j in _stretches(buckets)
    ]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


def _repeated(messages: pa.Table) -> pa.Table:
    """For each block, which of its anchors of this bucket another document has too."""
    payloads = messages["payload"].to_pylist()
    sizes = [len(p) // 5 for p in payloads]
    values = np.zeros((sum(sizes), 8), np.uint8)
    values[:, :5] = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, 5)
    values = values.view(np.uint64).ravel()
    order = np.argsort(values >> np.uint64(1), kind="stable")
    ranked = values[order]
    fresh = np.ones(len(ranked), bool)
    fresh[1:] = ranked[1:] >> np.uint64(1) != ranked[:-1] >> np.uint64(1)
    number = np.cumsum(fresh) - 1
    several = np.bincount(number) > 1
    several |= np.bincount(number, (ranked & np.uint64(1)).astype(float)) > 0
    return _answers(messages, sizes, order, several[number], _REPEATED)


def _earlier(messages: pa.Table) -> pa.Table:
    """For each block, which of its windows a document outside has that is smaller."""
    payloads = messages["payload"].to_pylist()
    sizes = [len(p) // 16 for p in payloads]
    both = np.frombuffer(b"".join(payloads), np.uint64).reshape(-1, 2)
    least = both[:, 1].copy().view(np.int64)
    order = np.argsort(both[:, 0], kind="stable")
    ranked = both[order, 0]
    fresh = np.ones(len(ranked), bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    number = np.cumsum(fresh) - 1
    smallest = np.minimum.reduceat(least[order], np.flatnonzero(fresh))
    return _answers(messages, sizes, order, smallest[number] < least[order], _EARLIER)


def _answers(messages: pa.Table, sizes: list[int], order: np.ndarray, said: np.ndarray, kind: int) -> pa.Table:
    bits = np.zeros(len(order), bool)
    bits[order] = said
    ends = np.cumsum(sizes)
    rows = [
        (block, kind, bucket, np.packbits(bits[end - size : end]).tobytes())
        for block, bucket, size, end in zip(
            messages["other"].to_pylist(), messages["key"].to_pylist(), sizes, ends, strict=True
        )
    ]
    return pa.Table.from_batches([_messages(rows)])


def remove_repeated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` (long) and ``kept_text`` (string).

    A word goes if a window over it also starts in a document with a smaller id. Windows
    are judged on the input. Null text has no words and an empty ``kept_text``; fewer than
    13 words never match. A null id is neither earlier nor later than another and keeps
    all; rows of one id leave each other alone. Columns of these names that ``docs`` has
    already are kept, and the new ones get a trailing ``_``.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text_column))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, text_column):
                block += 1
                yield _messages(
                    [
                        (block, _TEXTS, 0, _packed(part)),
                        *_Block(part, id_column, text_column, buckets).sent(block),
                    ]
                )

    def unpacked(messages: pa.Table) -> tuple[_Block, pa.RecordBatch]:
        texts = messages.filter(pa.compute.equal(messages["kind"], _TEXTS))["payload"][0].as_py()
        batch = pa.ipc.open_stream(texts).read_next_batch()
        block = _Block(batch, id_column, text_column, buckets)
        block.windows(_bits(messages, _REPEATED, block.bucket), buckets)
        return block, batch

    def second(messages: pa.Table) -> pa.Table:
        block, _ = unpacked(messages)
        return pa.Table.from_batches([_messages(block.sent_windows(messages["key"][0].as_py()))])

    names = [free_name(docs, n) for n in ("n_words", "n_removed", "kept_text")]
    kinds = (LongType(), LongType(), StringType())
    schema = StructType(
        [*docs.schema.fields, *(StructField(n, k) for n, k in zip(names, kinds, strict=True))]
    )

    def last(messages: pa.Table) -> pa.Table:
        block, batch = unpacked(messages)
        gone = block.removed(_bits(messages, _EARLIER, block.window_bucket))
        counts = block.words.counts.astype(np.int64)
        lost = np.bincount(block.words.text[gone], minlength=len(counts)).astype(np.int64)
        arrays = [*batch.columns, pa.array(counts), pa.array(lost), block.joined(~gone).cast(pa.string())]
        return pa.Table.from_arrays(arrays, names=[*batch.schema.names, *names])

    sent = written(docs.mapInArrow(first, _MESSAGE), "blocks")
    texts = sent.where(F.col("kind") == _TEXTS)
    repeated = written(
        sent.where(F.col("kind") == _ANCHORS).groupBy("key").applyInArrow(_repeated, _MESSAGE), "repeated"
    )
    windows = texts.union(repeated).groupBy("key").applyInArrow(second, _MESSAGE)
    earlier = windows.groupBy("key").applyInArrow(_earlier, _MESSAGE)
    return texts.union(repeated).union(earlier).groupBy("key").applyInArrow(last, schema)
