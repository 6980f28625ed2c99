"""Toxic spans by a linear-chain conditional random field.

Only documents are labelled, so tokens are labelled from them first, by a lexicon of the
words that significantly mark toxic documents. The field has two states; a word, its neighbours (hashed) and
the transitions carry weights, trained by forward-backward in numpy on a bounded sample.
Scoring runs forward-backward over whole texts, in chains of ``CHAIN`` words, and a
document's score is calibrated from its largest and its summed marginals.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from funnelspark.llm.common import PLAIN, Words, free_name, lower, mix, slices, utf8, with_columns

CHAIN = 32
HASH_BITS = 18
#: The sample: at most so many documents of each label, of at most so many bytes.
SAMPLE_DOCS = 2000
SAMPLE_BYTES = 20_000
EPOCHS = 12
BATCHES = 16
THRESHOLD = 0.7
#: A lexicon word: this share of its contexts is toxic, and at most so many words are as
#: pure by chance.
PURE = 0.95
CHANCE = 0.01
_SHIFT = np.uint64(64 - HASH_BITS)


@dataclass
class Model:
    """Weights for the toxic state of a word, its first 4 and 6 bytes, and its neighbours."""

    emit: np.ndarray
    bias: float
    move: np.ndarray
    calibration: np.ndarray

    def _scores(self, codes: np.ndarray) -> np.ndarray:
        """How much each place (time, chain) favours the toxic state."""
        total = np.full(codes.shape[1:], self.bias, np.float32)
        for weights, code in zip(self.emit, _features_of(codes), strict=True):
            total += weights[code]
        return np.clip(total, -30, 30)

    def marginals(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward-backward: the toxic state's probability at each place, and of each pair of states."""
        _, length, count = codes.shape
        real = codes[0] >= 0
        toxic = np.where(real, np.exp(self._scores(codes)), 1).astype(np.float64)
        move = np.exp(self.move)
        ahead, back = np.ones((length, 2, count)), np.ones((length, 2, count))
        ahead[0, 1] = toxic[0]
        ahead[0] /= ahead[0].sum(0)
        for t in range(1, length):
            step = move.T @ ahead[t - 1]
            step[1] *= toxic[t]
            step /= step.sum(0)
            # Past the end of a chain nothing moves.
            ahead[t] = np.where(real[t], step, ahead[t - 1])
        for t in range(length - 2, -1, -1):
            step = back[t + 1].copy()
            step[1] *= toxic[t + 1]
            step = move @ step
            step /= step.sum(0)
            back[t] = np.where(real[t + 1], step, back[t + 1])
        both = ahead * back
        chance = both[:, 1] / both.sum(1)
        joint = np.zeros((2, 2))
        for t in range(1, length):
            later = back[t].copy()
            later[1] *= toxic[t]
            pair = ahead[t - 1][:, None] * move[:, :, None] * later[None]
            pair /= pair.sum((0, 1))
            joint += pair[:, :, real[t]].sum(2)
        return np.where(real, chance, 0), joint

    def scored(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, Words]:
        """A score for each text, and the marginal of each of its words."""
        words = Words(lower(data), offsets, PLAIN)
        chance = self._of_words(*_chains(words, lower(data)))
        return self.calibrated(*_pooled(chance, words, len(offsets) - 1)), chance, words

    def _of_words(self, codes: np.ndarray, chain: np.ndarray, place: np.ndarray) -> np.ndarray:
        chance = np.zeros(len(chain))
        for first in range(0, codes.shape[2], 4096):
            part, _ = self.marginals(codes[:, :, first : first + 4096])
            some = slice(*np.searchsorted(chain, [first, first + 4096]))
            chance[some] = part[place[some], chain[some] - first]
        return chance

    def calibrated(self, largest: np.ndarray, total: np.ndarray) -> np.ndarray:
        x = _features(largest, total) @ self.calibration
        return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def _features(largest: np.ndarray, total: np.ndarray) -> np.ndarray:
    odds = np.log((largest + 1e-4) / (1 - largest + 1e-4))
    return np.stack([np.ones_like(odds), odds, np.log1p(total)], 1)


def _pooled(chance: np.ndarray, words: Words, texts: int) -> tuple[np.ndarray, np.ndarray]:
    largest = np.zeros(texts)
    np.maximum.at(largest, words.text, chance)
    # A word counts from even odds on, so that length alone adds nothing.
    return largest, np.bincount(words.text, np.where(chance >= 0.5, chance, 0), texts)


def _prefixes(words: Words, data: np.ndarray) -> list[np.ndarray]:
    """Hashes of the first 4 and 6 bytes of each word; a shorter word's is its own."""
    begins = []
    for n in (4, 6):
        code = np.full(len(words.start), n, np.uint64)
        for k in range(n):
            inside = words.start + k < words.end
            byte = data[np.minimum(words.start + k, len(data) - 1)] if len(data) else np.zeros(0, np.uint8)
            code = code * np.uint64(257) + np.where(inside, byte.astype(np.uint64) + np.uint64(1), np.uint64(0))
        begins.append(mix(code))
    return begins


def _chains(words: Words, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of word and prefixes as (kind, place, chain), and the chain and place of each word."""
    pieces = -(-words.counts // CHAIN)
    first = np.cumsum(pieces) - pieces
    chain = first[words.text] + words.place // CHAIN
    place = words.place % CHAIN
    codes = np.full((3, CHAIN, int(pieces.sum())), -1, np.int32)
    for kind, hashes in enumerate([words.hash, *_prefixes(words, data)]):
        codes[kind, place, chain] = (hashes >> _SHIFT).astype(np.int32)
    return codes, chain, place


def _features_of(codes: np.ndarray) -> Iterator[np.ndarray]:
    """The code of each feature at each place; -1, whose weight is 0, where there is none."""
    yield from codes
    around = np.full_like(codes[0], -1)
    around[1:] = codes[0][:-1]
    yield around
    around = np.full_like(codes[0], -1)
    around[:-1] = codes[0][1:]
    yield around


_FEATURES = 5


def marked(words: Words, data: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Which words of toxic texts have themselves or their prefix in a lexicon."""
    found = np.zeros(len(words.hash), bool)
    for units in (words.hash, *_prefixes(words, data)):
        found |= np.isin(units, lexicon(units, words, toxic))
    return found & (toxic[words.text] == 1)


def lexicon(units: np.ndarray, words: Words, toxic: np.ndarray) -> np.ndarray:
    """Those of ``units``, one for each word, that mark toxic texts.

    A unit counts once for each pair of neighbours it has, so copies of a text count once.
    It is taken if nearly all its contexts are toxic, and so many that no unit of the
    vocabulary would be expected to have as many by chance.
    """
    before, after = np.zeros_like(words.hash), np.zeros_like(words.hash)
    before[1:], after[:-1] = words.hash[:-1], words.hash[1:]
    context = mix(before + np.uint64(3) * after)
    order = np.lexsort((toxic[words.text], context, units))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (np.diff(units[order]) != 0) | (np.diff(context[order]) != 0)
    values, number, counts = np.unique(units[order][fresh], return_inverse=True, return_counts=True)
    bad = np.bincount(number, toxic[words.text[order][fresh]], len(values))
    share = min(max(bad.sum() / max(counts.sum(), 1), 1e-6), 0.999)
    least = np.log(len(values) / CHANCE) / -np.log(share)
    return values[(bad >= PURE * counts) & (bad >= least)]


def train(texts: list[str], toxic: list[int], epochs: int = EPOCHS, seed: int = 5) -> Model | None:
    """A model, or None if a label is missing or no word marks the toxic texts."""
    label = np.array(toxic, float)
    if not len(label) or label.min() == label.max():
        return None
    data, offsets = utf8(pa.array(texts, pa.string()))
    words = Words(lower(data), offsets, PLAIN)
    codes, chain, place = _chains(words, lower(data))
    hit = marked(words, lower(data), label)
    if not hit.any():
        return None
    target = np.zeros(codes.shape[1:])
    target[place[hit], chain[hit]] = 1
    rng = np.random.default_rng(seed)
    positive = np.flatnonzero(target.any(0))
    others = np.flatnonzero(~target.any(0))
    some = np.concatenate([positive, rng.permutation(others)[: 3 * len(positive) + 500]])
    size = (1 << HASH_BITS) + 1
    model = Model(np.zeros((_FEATURES, size), np.float32), -2.0, np.zeros((2, 2)), np.array([-2.0, 1, 0]))
    squares = np.full(model.emit.shape, 1e-2, np.float32)
    square_bias, square_move = 1e-2, np.full((2, 2), 1e-2)
    batch = -(-len(some) // BATCHES)
    for _ in range(epochs):
        rng.shuffle(some)
        for first in range(0, len(some), batch):
            part = some[first : first + batch]
            code, want = codes[:, :, part], target[:, part]
            chance, joint = model.marginals(code)
            slope = np.where(code[0] >= 0, want - chance, 0)
            for k, c in enumerate(_features_of(code)):
                gain = np.roll(np.bincount(c.ravel() + 1, slope.ravel(), size), -1) - 1e-3 * model.emit[k]
                gain[-1] = 0
                squares[k] += gain * gain
                model.emit[k] += 0.5 * gain / np.sqrt(squares[k])
            square_bias += slope.sum() ** 2
            model.bias += 0.5 * slope.sum() / np.sqrt(square_bias)
            seen = np.zeros((2, 2))
            for a in (0, 1):
                for b in (0, 1):
                    seen[a, b] = ((want[:-1] == a) & (want[1:] == b) & (code[0, 1:] >= 0)).sum()
            slope = seen - joint
            square_move += slope * slope
            model.move += 0.2 * slope / np.sqrt(square_move)
    chance = model._of_words(codes, chain, place)
    model.calibration = _logistic(_features(*_pooled(chance, words, len(label))), label)
    return model


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Regularised logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w += np.linalg.solve(curve, x.T @ (y - p) - 0.1 * w)
    return w


def fitted(
    docs: DataFrame, labels: DataFrame, text_column: str = "text", id_column: str = "doc_id", label_column: str = "toxic",
    sample_docs: int = SAMPLE_DOCS,
) -> Model | None:
    """A model from at most ``sample_docs`` labelled documents of each label.

    Drawn by hash of the id before any text is read; documents of more than
    ``SAMPLE_BYTES`` bytes and null texts are left out. An id with both labels is toxic.
    """
    known = labels.where(F.col(label_column).isin(0, 1) & F.col(id_column).isNotNull())
    known = known.groupBy(F.col(id_column).alias("labelled")).agg(F.max(label_column).alias("label"))
    order = Window.partitionBy("label").orderBy(F.xxhash64("labelled"), "labelled")
    drawn = known.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= sample_docs)
    texts = docs.where(F.octet_length(text_column) <= SAMPLE_BYTES)
    texts = texts.select(F.col(id_column).alias("labelled"), F.col(text_column).alias("passage"))
    rows = texts.join(F.broadcast(drawn.select("labelled", "label")), "labelled").collect()
    rows = sorted((r["labelled"], r["passage"], r["label"]) for r in rows)
    return train([r[1] for r in rows], [r[2] for r in rows])


def tag(docs: DataFrame, model: Model | None, text_column: str = "text") -> DataFrame:
    """``docs`` with ``score`` (double) and ``spans`` (begin and end of toxic words, in UTF-8 bytes).

    Neighbouring toxic words make one span. Null and empty texts have the lowest score and
    no span; without a model every score is 0. Names taken already get a trailing ``_``.
    """
    names = [free_name(docs, n) for n in ("score", "spans")]
    spans = StructType.fromDDL("s array<struct<begin:long,end:long>>")[0].dataType
    schema = with_columns(docs, **dict(zip(names, (DoubleType(), spans), strict=True)))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span_type = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in slices(batch, text_column):
                scores, found = np.zeros(part.num_rows), [[] for _ in range(part.num_rows)]
                if known:
                    data, offsets = utf8(part.column(text_column))
                    scores, chance, words = known.scored(data, offsets)
                    last = -2
                    for i in np.flatnonzero(chance >= 0.5).tolist():
                        text = int(words.text[i])
                        begin, end = int(words.start[i] - offsets[text]), int(words.end[i] - offsets[text])
                        if i == last + 1 and found[text]:
                            found[text][-1]["end"] = end
                        else:
                            found[text].append({"begin": begin, "end": end})
                        last = i
                arrays = [*part.columns, pa.array(scores), pa.array(found, span_type)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*part.schema.names, *names])

    return docs.mapInArrow(score, schema)
