"""Benchmark decontamination: a broadcast set of n-grams, scanned over token windows.

Words are runs of digits, letters and characters beyond ASCII, A to Z in lower case. The
benchmark's windows of 10 words (an item of fewer words is one window) are broadcast as a
dictionary. Documents are scanned by 64-bit hashes of all their windows, and every hit is
looked up by its words before it counts. A benchmark of more than ``BLOCK_BYTES`` is split
by item into blocks, scanned one after the other over the written results.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from funnelspark.llm.common import PLAIN, Words, free_name, lower, slices, utf8
from funnelspark.sources.storage import written

WINDOW = 10
#: Bytes of benchmark text that are broadcast at once.
BLOCK_BYTES = 8 << 20
_SIEVE_BITS = 22


class _Grams:
    """The windows of some benchmark items, by number of words."""

    def __init__(self, items: list[tuple[str, str]]):
        self.words: dict[bytes, set[str]] = defaultdict(set)
        hashes = defaultdict(list)
        data, offsets = utf8(pa.array([text for _, text in items], pa.string()))
        data = lower(data)
        words = Words(data, offsets, PLAIN)
        for n in range(1, WINDOW + 1):
            values, whole = words.runs(n)
            if n < WINDOW:
                whole = whole & (words.counts[words.text] == n)
            for at in np.flatnonzero(whole):
                self.words[_joined(data, words, at, n)].add(items[words.text[at]][0])
            if whole.any():
                hashes[n] = values[whole]
        self.hashes = {n: np.unique(v) for n, v in hashes.items()}
        self.sieve = {}
        for n, values in self.hashes.items():
            self.sieve[n] = np.zeros(1 << _SIEVE_BITS, bool)
            self.sieve[n][values >> np.uint64(64 - _SIEVE_BITS)] = True

    def hits(self, data: np.ndarray, words: Words) -> Iterator[tuple[int, int, set[str]]]:
        """First word, number of words and items of each window found."""
        for n, known in self.hashes.items():
            values, whole = words.runs(n)
            at = np.flatnonzero(whole & self.sieve[n][values >> np.uint64(64 - _SIEVE_BITS)])
            near = np.minimum(np.searchsorted(known, values[at]), len(known) - 1)
            for i in at[known[near] == values[at]]:
                items = self.words.get(_joined(data, words, i, n))
                if items:
                    yield int(i), n, items


def _joined(data: np.ndarray, words: Words, at: int, n: int) -> bytes:
    pairs = zip(words.start[at : at + n].tolist(), words.end[at : at + n].tolist(), strict=True)
    return b" ".join(data[s:e].tobytes() for s, e in pairs)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words`` (long), ``items`` (sorted distinct item ids as text) and
    ``hit_spans`` (first and last word of each run of hit words, from 0).

    Null and empty texts have no words and no hits; null or wordless items never hit, and
    a null item id counts as empty text. An empty benchmark hits nothing. New columns
    whose name ``docs`` has get a trailing ``_``.
    """
    spark = docs.sparkSession
    names = [free_name(docs, n) for n in ("n_words", "items", "hit_spans")]
    extra = "long, array<string>, array<struct<first:long,last:long>>".split(", ", 2)
    added = StructType.fromDDL(", ".join(f"`{n}` {k}" for n, k in zip(names, extra, strict=True)))
    result = docs.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in added.fields))
    rows = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"), F.col(item_text).alias("text")
    ).where("octet_length(text) > 0")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    block = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    for number in range(blocks):
        items = [(r["id"], r["text"]) for r in rows.where(block == number).toLocalIterator()]
        grams = spark.sparkContext.broadcast(_Grams(items))
        result = result.mapInArrow(_scan(grams, text_column, names), result.schema)
        if blocks > 1:
            result = written(result, "scanned")
    return result


def _scan(grams, text_column: str, names: list[str]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_column):
                yield _scanned(part, grams.value, text_column, names)

    return scan


def _scanned(part: pa.RecordBatch, grams: _Grams, text_column: str, names: list[str]) -> pa.RecordBatch:
    data, offsets = utf8(part.column(text_column))
    data = lower(data)
    words = Words(data, offsets, PLAIN)
    hit = np.zeros(len(words.hash), bool)
    items: dict[int, set[str]] = defaultdict(set)
    for at, n, found in grams.hits(data, words):
        hit[at : at + n] = True
        items[int(words.text[at])] |= found
    # Runs end where a word is not hit or the text ends.
    edge = np.zeros(len(hit) + 1, bool)
    edge[words.first[:-1]] = True
    starts = np.flatnonzero(hit & (edge[:-1] | ~np.concatenate([[False], hit[:-1]])))
    ends = np.flatnonzero(hit & (edge[1:] | ~np.concatenate([hit[1:], [False]])))
    spans: dict[int, list] = defaultdict(list)
    for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
        text = int(words.text[s])
        spans[text].append({"first": int(words.place[s]), "last": int(words.place[e])})
    old_items, old_spans = part.column(names[1]), part.column(names[2])
    new_items, new_spans = [], []
    for i in range(part.num_rows):
        new_items.append(sorted(items.get(i, set()) | set(old_items[i].as_py() or ())))
        new_spans.append(_merged([*spans.get(i, ()), *(old_spans[i].as_py() or ())]))
    columns = {
        names[0]: pa.array(words.counts.astype(np.int64)),
        names[1]: pa.array(new_items, pa.list_(pa.string())),
        names[2]: pa.array(new_spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
    }
    arrays = [columns.get(f.name, part.column(i)) for i, f in enumerate(part.schema)]
    return pa.RecordBatch.from_arrays(arrays, names=part.schema.names)


def _merged(spans: list[dict]) -> list[dict]:
    out: list[dict] = []
    for span in sorted(spans, key=lambda s: s["first"]):
        if out and span["first"] <= out[-1]["last"] + 1:
            out[-1] = {"first": out[-1]["first"], "last": max(span["last"], out[-1]["last"])}
        else:
            out.append(span)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """``docs`` without the documents in which a benchmark window occurs."""
    found = contamination(docs, benchmark, text_column, **options)
    spans = found.columns[-1]
    return found.where(F.size(spans) == 0).select(*docs.columns)


def cut(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """``docs`` without the hit words; what stands between two hit words goes with them."""
    found = contamination(docs, benchmark, text_column, **options)
    spans = found.columns[-1]

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(text_column))
            words = Words(lower(data), offsets, PLAIN)
            texts = []
            for i, text in enumerate(batch.column(text_column)):
                parts, at, first = [], offsets[i], words.first[i]
                for span in batch.column(spans)[i].as_py():
                    parts.append(data[at : words.start[first + span["first"]]].tobytes())
                    at = words.end[first + span["last"]]
                parts.append(data[at : offsets[i + 1]].tobytes())
                texts.append(b"".join(parts).decode() if text.is_valid else None)
            at = batch.schema.get_field_index(text_column)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return found.mapInArrow(shorten, found.schema).select(*docs.columns)
