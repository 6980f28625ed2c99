"""Best-fit packing of documents into token sequences by a grouping genetic algorithm.

Documents are cut into pieces of at most ``LIMIT`` tokens. Pieces below the limit are dealt
by hash into instances of about ``INSTANCE`` pieces; each instance has a few islands, each
with a population of packings. The gene of a packing is a bin: crossover injects whole well-filled
bins of one parent into the other, takes out the bins that hold one of their pieces again, and places
the displaced pieces by best fit; mutation dissolves badly filled bins. After each round
an island's elite migrates to the next one. Bins of the best packing that are not well
filled are opened, and their pieces of all instances make a smaller problem, until one
instance is left or opening bins frees more than half of the pieces.

An instance whose best packing has as many bins as its tokens need at least is not evolved further.
Every stage is a written table, and a task holds one instance at a time.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.llm.common import byte_table, lower, slices, utf8
from funnelspark.sources.storage import written

LIMIT = 4096
#: The id after every document.
END = 1
#: Pieces of an instance, about.
INSTANCE = 4096
ISLANDS = 3
POPULATION = 4
ROUNDS = 3
GENERATIONS = 8
#: A bin with at most this many tokens free is well filled.
SLACK = 4

_SLICE_BYTES = 4 << 20
_STRETCHES_AT_ONCE = 1 << 20
#: Characters of the stretches that a worker keeps the ids of.
_REMEMBERED = 8_000_000

_SPACE = byte_table(lambda b: b == 0x20 or 0x09 <= b <= 0x0D)
_LETTER = byte_table(lambda b: 0x61 <= b <= 0x7A)

Packing = np.ndarray
"""The bin of each piece."""


# Tokens


class Coder:
    """Token ids of texts, by encoding each distinct stretch once.

    For tokenizers that lower the case, drop white space, and take runs of letters and of
    other signs as words. Such a text may be cut before any word, and between an ASCII letter and
    an ASCII sign; only an apostrophe can join the letters that follow it.
    """

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.special = [token.content.encode() for token in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.chars = 0
        self.ids, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def _of_stretches(self, stretches: list[str]) -> np.ndarray:
        """The place of each stretch among those encoded so far."""
        if self.chars > _REMEMBERED:
            self._forget()
        fresh = list(dict.fromkeys(s for s in stretches if s not in self.places))
        if fresh:
            # Small ASCII letters are one word, which the model takes as it is.
            whole = [s.isascii() and s.isalpha() and s.islower() for s in fresh]
            others = iter(
                self.tokenizer.encode_batch([s for s, w in zip(fresh, whole) if not w], add_special_tokens=False)
            )
            tokens = self.tokenizer.model.tokenize
            lists = [[t.id for t in tokens(s)] if w else next(others).ids for s, w in zip(fresh, whole)]
            counts = np.fromiter(map(len, lists), np.int64, len(lists))
            ids = np.fromiter(chain.from_iterable(lists), np.uint32, int(counts.sum()))
            self.places.update(zip(fresh, range(len(self.counts), len(self.counts) + len(fresh))))
            self.ids, self.counts = np.concatenate([self.ids, ids]), np.concatenate([self.counts, counts])
            self.chars += sum(map(len, fresh))
        return np.fromiter(map(self.places.__getitem__, stretches), np.int64, len(stretches))

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``data`` in lower case, and where its stretches begin."""
        small = lower(data)
        space, letter, plain = _SPACE[small], _LETTER[small], small < 0x80
        sign = plain & ~letter & ~space
        ends = letter.copy()
        # The second byte of a letter from U+00C0 to U+00FF; 0xC3 only begins such characters.
        ends[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        cut = np.zeros(len(data), bool)
        cut[1:] = (space[:-1] & ~space[1:]) | (ends[:-1] & sign[1:])
        cut[1:] |= sign[:-1] & (small[:-1] != 0x27) & letter[1:]
        cut[offsets[offsets < len(data)]] = True
        raw = data.tobytes()
        for sign_text in self.special:
            at = raw.find(sign_text)
            while at >= 0:
                # Special signs count wherever they stand, so such a text is encoded whole.
                i = int(np.searchsorted(offsets, at, "right")) - 1
                small[offsets[i] : offsets[i + 1]] = data[offsets[i] : offsets[i + 1]]
                cut[offsets[i] + 1 : offsets[i + 1]] = False
                at = raw.find(sign_text, int(offsets[i + 1]))
        return small, np.flatnonzero(cut)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, ``END`` after each, and where each text begins."""
        data, offsets = utf8(texts)
        small, begin = self._cuts(data, offsets)
        ends = np.append(begin, len(small)).astype(np.int64)
        stretches = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(ends), pa.py_buffer(small))
        coded = stretches.dictionary_encode()
        trimmed = pc.ascii_rtrim_whitespace(coded.dictionary)
        places = self._of_stretches(trimmed.to_pylist())[coded.indices.to_numpy()]
        starts = np.cumsum(self.counts) - self.counts
        parts = []
        for i in range(0, len(places), _STRETCHES_AT_ONCE):
            some = places[i : i + _STRETCHES_AT_ONCE]
            size = self.counts[some]
            first = np.repeat(starts[some] - (np.cumsum(size) - size), size)
            parts.append(self.ids[first + np.arange(len(first))])
        ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        upto = np.concatenate([[0], np.cumsum(self.counts[places])])[np.searchsorted(begin, offsets)]
        ids = np.insert(ids, upto[1:], END)
        return ids.astype("<u4", copy=False), upto + np.arange(len(upto))


@lru_cache(maxsize=1)
def coder(tokenizer: str) -> Coder:
    """Kept for the tasks of one Python worker."""
    return Coder(tokenizer)


def pieces(
    docs: DataFrame, tokenizer: str, limit: int = LIMIT, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and a ``uid`` for every piece of every row."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts_of = coder(tokenizer)
        for batch in batches:
            for part in slices(batch, "text", _SLICE_BYTES):
                ids, offsets = texts_of.encode(part.column("text"))
                size = np.diff(offsets)
                n = -(-size // limit)
                row = np.repeat(np.arange(len(n)), n)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                start = nth * limit
                length = np.minimum(size[row] - start, limit)
                begin = offsets[row] + start
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(begin.tolist(), (begin + length).tolist())]
                yield pa.record_batch(
                    [
                        part.column("id").take(pa.array(row)), pa.array(nth.astype(np.int32)),
                        pa.array(start), pa.array(length), pa.array(sums, pa.int64()),
                    ],
                    ["id", "piece", "start", "length", "ids_crc32"],
                )

    id_type = docs.schema[id_column].dataType.simpleString()
    named = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    found = named.mapInArrow(cut, f"id {id_type}, piece int, start long, length long, ids_crc32 long")
    return written(found.withColumn("uid", F.monotonically_increasing_id()), "pieces")


# Packings of one instance


def best_fit(sizes: np.ndarray, items: np.ndarray, packing: Packing, limit: int, fills: np.ndarray) -> None:
    """Put ``items``, in order, into the fullest bin that takes each, or a new one.

    ``fills`` has the tokens in each bin of ``packing``; both must have room for new bins.
    """
    used = fills.nonzero()[0]
    by_space: dict[int, list[int]] = {}
    for b, space in zip(used.tolist(), (limit - fills[used]).tolist()):
        by_space.setdefault(space, []).append(b)
    mask = sum(1 << space for space in by_space)
    free = int(used[-1]) + 1 if len(used) else 0
    for item, size in zip(items.tolist(), sizes[items].tolist()):
        fitting = mask >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            same = by_space[space]
            b = same.pop()
            if not same:
                mask ^= 1 << space
        else:
            space, b = limit, free
            free += 1
        packing[item] = b
        left = space - size
        if not by_space.get(left):
            by_space[left] = []
            mask |= 1 << left
        by_space[left].append(b)


def filled(sizes: np.ndarray, packing: Packing) -> np.ndarray:
    """The tokens in each bin."""
    return np.bincount(packing, sizes, minlength=1).astype(np.int64)


def renumbered(packing: Packing) -> Packing:
    return np.unique(packing, return_inverse=True)[1].astype(np.int32)


def packed(sizes: np.ndarray, order: np.ndarray, limit: int) -> Packing:
    packing = np.zeros(len(sizes), np.int32)
    best_fit(sizes, order, packing, limit, np.zeros(1, np.int64))
    return renumbered(packing)


def merit(sizes: np.ndarray, packing: Packing) -> tuple[int, int]:
    """Fewer bins first, then more uneven ones: the least is best."""
    fills = filled(sizes, packing)
    return len(fills), -int((fills * fills).sum())


def refitted(sizes: np.ndarray, packing: Packing, loose: np.ndarray, limit: int) -> Packing:
    """``packing`` with the pieces marked ``loose`` placed anew, largest first."""
    packing = packing.copy()
    fills = np.bincount(packing[~loose], sizes[~loose], minlength=1).astype(np.int64)
    items = loose.nonzero()[0]
    best_fit(sizes, items[np.argsort(-sizes[items], kind="stable")], packing, limit, fills)
    return renumbered(packing)


def crossed(sizes: np.ndarray, a: Packing, b: Packing, draw: np.random.Generator, limit: int) -> Packing:
    """``a`` with some whole well-filled bins of ``b``; pieces they displace are best-fitted."""
    fills = filled(sizes, b)
    well = (fills >= max(limit - SLACK, np.median(fills))).nonzero()[0]
    if not len(well):
        return a
    chosen = np.zeros(len(fills), bool)
    chosen[draw.choice(well, draw.integers(1, max(2, len(well) // 8 + 1)), replace=False)] = True
    injected = chosen[b]
    hit = np.zeros(a.max() + 1, bool)
    hit[a[injected]] = True
    loose = hit[a] & ~injected
    child = np.where(injected, a.max() + 1 + b, a)
    return refitted(sizes, renumbered(child), loose, limit)


def mutated(sizes: np.ndarray, packing: Packing, draw: np.random.Generator, limit: int) -> Packing:
    """``packing`` with the emptiest bins and a few others dissolved and best-fitted."""
    fills = filled(sizes, packing)
    dissolved = np.zeros(len(fills), bool)
    dissolved[np.argsort(fills, kind="stable")[: int(draw.integers(1, 4))]] = True
    dissolved[draw.integers(0, len(fills), 1 + len(fills) // 20)] = True
    return refitted(sizes, packing, dissolved[packing], limit)


def least_bins(sizes: np.ndarray, limit: int) -> int:
    return -(-int(sizes.sum()) // limit)


def first_population(sizes: np.ndarray, draw: np.random.Generator, limit: int) -> list[Packing]:
    """Best fit in falling order of size, and of sizes shaken by a tenth unless that is as good as can be."""
    found = [packed(sizes, np.argsort(-sizes, kind="stable"), limit)]
    while len(found) < POPULATION and merit(sizes, found[0])[0] > least_bins(sizes, limit):
        shaken = sizes * draw.uniform(0.9, 1.1, len(sizes))
        found.append(packed(sizes, np.argsort(-shaken, kind="stable"), limit))
    return found


def evolved(sizes: np.ndarray, population: list[Packing], draw: np.random.Generator, limit: int, generations: int) -> list[Packing]:
    """``population`` after some generations, the best first."""
    ranked = sorted(((merit(sizes, p), i, p) for i, p in enumerate(population)), key=lambda x: x[:2])
    least = least_bins(sizes, limit)
    for g in range(generations):
        if ranked[0][0][0] <= least:
            break
        if len(ranked) > 1:
            # The better of two drawn at random is a parent.
            mother, father = (min(draw.integers(0, len(ranked), 2)) for _ in range(2))
            child = crossed(sizes, ranked[mother][2], ranked[father][2], draw, limit)
        else:
            child = ranked[0][2]
        if draw.random() < 0.5 or len(ranked) == 1:
            child = mutated(sizes, child, draw, limit)
        ranked.append((merit(sizes, child), len(population) + g, child))
        ranked = sorted(ranked, key=lambda x: x[:2])[:POPULATION]
    return [p for _, _, p in ranked]


# Instances and islands

_STATE = (
    "instance long, island int, uids binary, sizes binary, population binary, elite binary,"
    " bins long, score long, least long"
)


def _row(instance: int, island: int, uids: np.ndarray, sizes: np.ndarray, population: list[Packing], limit: int) -> tuple:
    bins, score = merit(sizes, population[0])
    return (
        instance, island, uids.tobytes(), sizes.tobytes(), np.concatenate(population).tobytes(),
        population[0].tobytes(), bins, score, least_bins(sizes, limit),
    )


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[column.split()[0] for column in _STATE.split(", ")])


def _islands(items: DataFrame, limit: int) -> DataFrame:
    """A row for each island of each instance of ``items`` (``uid``, ``length``, ``instance``)."""

    def begin(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        instance, island = map(int, key)
        frame = frame.sort_values("uid")
        sizes = frame["length"].to_numpy(np.int64)
        draw = np.random.default_rng([instance, island])
        population = first_population(sizes, draw, limit)
        return _frame([_row(instance, island, frame["uid"].to_numpy(np.int64), sizes, population, limit)])

    spread = items.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))))
    return written(spread.groupBy("instance", "island").applyInPandas(begin, _STATE), "islands")


def _migrated(state: DataFrame, number: int, limit: int) -> DataFrame:
    """Each island after a round that begins with the elite of the one before it."""

    def live(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for row in frame.itertuples(index=False):
                sizes = np.frombuffer(row.sizes, np.int64)
                population = list(np.frombuffer(row.population, np.int32).reshape(-1, len(sizes)))
                population.append(np.frombuffer(row.migrant, np.int32))
                draw = np.random.default_rng([int(row.instance), int(row.island), number])
                population = evolved(sizes, population, draw, limit, GENERATIONS)
                rows.append(_row(row.instance, row.island, np.frombuffer(row.uids, np.int64), sizes, population, limit))
            yield _frame(rows)

    migrants = state.select("instance", ((F.col("island") + 1) % ISLANDS).alias("island"), F.col("elite").alias("migrant"))
    return written(state.join(migrants, ["instance", "island"]).mapInPandas(live, _STATE), "islands")


def _best(state: DataFrame, limit: int) -> DataFrame:
    """``uid``, ``instance``, ``bin``, ``offset`` and ``fill`` of its bin for each piece, by the best packing."""

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                sizes, packing = np.frombuffer(row.sizes, np.int64), np.frombuffer(row.elite, np.int32)
                order = np.argsort(packing, kind="stable")
                size, bins = sizes[order], packing[order]
                fills = filled(sizes, packing)
                offset = np.cumsum(size) - size - (np.cumsum(fills) - fills)[bins]
                yield pd.DataFrame(
                    {
                        "uid": np.frombuffer(row.uids, np.int64)[order], "instance": row.instance,
                        "bin": bins.astype(np.int64), "offset": offset, "fill": fills[bins], "length": size,
                    }
                )

    rank = F.struct("bins", "score", "island")
    best = state.groupBy("instance").agg(F.min_by(F.struct("uids", "sizes", "elite"), rank).alias("best"))
    return written(
        best.select("instance", "best.*").mapInPandas(
            place, "uid long, instance long, bin long, offset long, fill long, length long"
        ),
        "placed",
    )


def sequences(items: DataFrame, limit: int = LIMIT, instance: int = INSTANCE) -> DataFrame:
    """``uid``, ``sequence_id`` and ``offset`` for ``items`` (``uid``, ``length`` up to ``limit``).

    A piece of the whole length is a sequence by itself. ``uid`` is a number from 0, one for each piece.
    """
    full = items.where(F.col("length") == limit)
    parts = [full.select("uid", (F.lit(1 << 62) + F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    rest = items.where(F.col("length") < limit).select("uid", "length")
    n, level = rest.count(), 0
    while n:
        count = -(-n // instance)
        state = _islands(rest.withColumn("instance", F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(count))), limit)
        for number in range(ROUNDS):
            best = state.groupBy("instance").agg(F.min("bins").alias("bins"), F.first("least").alias("least"))
            if best.where("bins > least").isEmpty():
                break
            state = _migrated(state, number, limit)
        placed = _best(state, limit)
        loose = F.col("fill") < limit - SLACK
        freed = placed.where(loose).count() if count > 1 else 0
        again = 0 < freed <= max(n // 2, instance)
        kept = placed.where(~loose) if again else placed
        number = F.lit(level << 56) + F.col("instance") * F.lit(1 << 24) + F.col("bin")
        parts.append(kept.select("uid", number.alias("sequence_id"), "offset"))
        if not again:
            break
        rest, n, level = placed.where(loose).select("uid", "length"), freed, level + 1
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def pack(
    docs: DataFrame, tokenizer: str, limit: int = LIMIT, id_column: str = "doc_id", text_column: str = "text",
    instance: int = INSTANCE,
) -> DataFrame:
    """One row per piece: the id, ``piece, start, length, ids_crc32, sequence_id, offset``.

    ``tokenizer`` is the JSON of a tokenizer that drops white space. A document is its ids and ``END``;
    null text is empty, so such a document has one token. Only documents longer than
    ``limit`` are cut, into pieces of that length and a last one. Rows that repeat, or that have a null
    id, are documents like others. Very long texts are encoded whole. ``offset`` is the
    place in the sequence, without gaps. Other columns of ``docs`` are not read. No rows give no rows.
    """
    cut = pieces(docs, tokenizer, limit, id_column, text_column)
    places = sequences(cut.select("uid", "length"), limit, instance)
    return cut.join(places, "uid").select(
        F.col("id").alias(id_column), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
