"""SentencePiece encoding and decoding by a streaming Viterbi search.

Places in a text are the states, pieces the steps between them. A place keeps the last
piece of the best path to it, and a step reaches back at most as far as the longest piece,
so only that window of places can still be continued. Whenever all paths from the window
lead back through one place, the ids up to it are final and are given out; memory does not
grow with the text. No piece holds a space mark after another character, so every word's
beginning is such a place, and words are looked up in a bounded cache.

A BPE model has no sum to maximise: the best path to a place is the one that the merges
make, and a step is admissible if the merges leave its piece and the one before it as they
are. Exactly one is, so each place still has one back pointer, and the ids are those of
the library. With ``unigram`` the path with the largest sum of scores is taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType

from funnelspark.llm.common import free_name, slices, with_columns

MARK = "▁"
#: Words whose ids a worker remembers; then it starts anew.
CACHED_WORDS = 100_000
#: Longer words are searched one by one, in windows.
LONG_WORD = 40
LEARNED_AT_ONCE = 10_000
#: Characters read before the ids up to the meeting place of all paths are given out.
WINDOW = 256
_PAIR_BITS = 20
_NEVER = float("inf")


class _Cache(dict):
    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[key] = self.make(key)
        return value


class Codec:
    """Ids of texts and back, for a model without text normalisation and with byte pieces."""

    def __init__(self, model: bytes, unigram: bool = False):
        reader = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = reader.get_piece_size()
        self.unigram = unigram
        self.pieces = [reader.id_to_piece(i) for i in range(size)]
        self.scores = [reader.get_score(i) for i in range(size)]
        #: The number of a piece, 0 for what only begins pieces.
        self.steps: dict[str, int] = {}
        self.rank: dict[str, float] = {}
        self.byte_ids: dict[int, int] = {}
        self.bytes: list[bytes] = []
        for i, piece in enumerate(self.pieces):
            if reader.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.bytes.append(bytes([int(piece[1:-1], 16)]))
            elif i == 0 or reader.is_control(i) or reader.is_unknown(i) or reader.is_unused(i):
                self.bytes.append(b"")
            else:
                self.steps[piece], self.rank[piece] = i, -self.scores[i]
                self.bytes.append(piece.replace(MARK, " ").encode())
        for piece in list(self.steps):
            for end in range(1, len(piece)):
                self.steps.setdefault(piece[:end], 0)
        probe = "  ﬁ Ａ\t é\n "
        if len(self.byte_ids) < 256 or reader.decode(reader.encode(probe)) != probe:
            raise ValueError("the model normalises texts or lacks byte pieces")
        if any(MARK in piece.lstrip(MARK) for piece in self.rank):
            raise ValueError("a piece of the model spans words")
        self.longest = max(map(len, self.rank))
        self.unknown_score = min(self.scores[i] for i in self.steps.values() if i) - 10
        # The prefixes of pieces as a tree: edges (node, character) and the node each leads to.
        nodes = {prefix: k for k, prefix in enumerate(["", *sorted(self.steps)])}
        keys = np.array([nodes[p[:-1]] << 21 | ord(p[-1]) for p in nodes if p], np.int64)
        order = np.argsort(keys)
        self.edges, self.children = keys[order], np.array([k for p, k in nodes.items() if p], np.int64)[order]
        self.node_piece = np.array([0, *(self.steps[p] for p in nodes if p)], np.int32)
        self.pairs, self.pairs_agree = np.full(1 << _PAIR_BITS, -1), np.zeros(1 << _PAIR_BITS, bool)
        self._borders = _Cache(self._borders_of)
        self._agree = _Cache(self._left_alone)
        self.line = "\n" if any("\n" in piece for piece in self.rank) else " \n"
        self.words: dict[str, tuple[int, ...]] = {}

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; a space mark is put before a text that is not empty."""
        cut = [self._cut(text) if text else [] for text in texts]
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
        words = self.words
        self._learn([w for w in set(chain.from_iterable(cut)) if w not in words])
        return [np.fromiter(chain.from_iterable(map(words.__getitem__, c)), np.int32) for c in cut]

    def _cut(self, text: str) -> list[str]:
        # A mark in the text is a space, as in the library. A line's end that no piece holds
        # begins a word of its own, one without mark.
        words = text.replace(MARK, " ").replace("\n", self.line).split(" ")
        return list(self._with_spaces(words)) if "" in words else words

    def _learn(self, words: list[str]) -> None:
        """Remember the ids of new words: the same search, place by place for all words at once."""
        rest = []
        for begin in range(0, len(words), LEARNED_AT_ONCE):
            some = words[begin : begin + LEARNED_AT_ONCE]
            heads = [len(self.line) > 1 and w.startswith("\n") for w in some]
            texts = [w[1:] if head else MARK + w for w, head in zip(some, heads, strict=True)]
            short = [len(t) <= LONG_WORD for t in texts] if not self.unigram else [False] * len(texts)
            rest += [w for w, ok in zip(some, short, strict=True) if not ok]
            keep = [k for k, ok in enumerate(short) if ok]
            found = self._together([texts[k] for k in keep])
            for k, ids in zip(keep, found, strict=True):
                if ids is None:
                    rest.append(some[k])
                else:
                    self.words[some[k]] = (self.byte_ids[10], *ids) if heads[k] else ids
        for word in rest:
            self.words[word] = self._word(word)

    def _together(self, texts: list[str]) -> list[tuple[int, ...] | None]:
        """Ids of short texts, None for one with a character that is no piece."""
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
        lengths = np.array([len(t) for t in texts], np.int64)
        if not len(codes):
            return [()] * len(texts)
        first = np.cumsum(lengths) - lengths
        # A text has one slot more than characters: the place after each.
        slot_of = first + np.arange(len(texts))
        left = np.repeat(first + lengths, lengths) - np.arange(len(codes))
        pieces = np.zeros((self.longest + 1, len(codes)), np.int32)
        at, node = np.arange(len(codes)), np.zeros(len(codes), np.int64)
        for size in range(1, self.longest + 1):
            alive = left[at] >= size
            at, node = at[alive], node[alive]
            key = node << 21 | codes[at + size - 1]
            place = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            alive = self.edges[place] == key
            at, node = at[alive], self.children[place[alive]]
            pieces[size, at] = self.node_piece[node]
        sizes = np.zeros(len(codes) + len(texts), np.int64)
        numbers = np.zeros(len(codes) + len(texts), np.int64)
        for offset in range(int(lengths.max())):
            some = np.flatnonzero(lengths > offset)
            where, slot = first[some] + offset, slot_of[some] + offset
            for size in range(1, self.longest + 1):
                number = pieces[size, where]
                usable = number > 0
                if not usable.any():
                    continue
                own, number = slot[usable], number[usable].astype(np.int64)
                fresh = sizes[own + size] == 0
                own, number = own[fresh], number[fresh]
                good = self._agreed(numbers[own] << 20 | number)
                own, number = own[good], number[good]
                sizes[own + size], numbers[own + size] = size, number
        end = np.zeros(len(sizes), bool)
        here = slot_of + lengths
        known = np.ones(len(texts), bool)
        while True:
            moving = np.flatnonzero((here > slot_of) & known)
            if not len(moving):
                break
            end[here[moving]] = True
            known[moving] = sizes[here[moving]] > 0
            here[moving] -= sizes[here[moving]]
        total = np.concatenate([[0], np.cumsum(end)])
        edges = total[np.append(slot_of, len(sizes))].tolist()
        flat = numbers[end].tolist()
        return [tuple(flat[a:b]) if ok else None for a, b, ok in zip(edges, edges[1:], known.tolist(), strict=False)]

    def _agreed(self, pairs: np.ndarray) -> np.ndarray:
        """Whether each pair of neighbouring pieces is left alone; a table remembers the latest."""
        place = (pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - _PAIR_BITS)).astype(np.int64)
        said = self.pairs_agree[place]
        new = np.flatnonzero(self.pairs[place] != pairs)
        if len(new):
            fresh, number = np.unique(pairs[new], return_inverse=True)
            found = np.array([self._left_alone(p) for p in fresh.tolist()], bool)
            said[new] = found[number]
            self.pairs[place[new]], self.pairs_agree[place[new]] = pairs[new], said[new]
        return said

    def decode(self, ids) -> str:
        text = b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text

    def _with_spaces(self, words: list[str]) -> Iterator[str]:
        """Words without the mark before them; spaces beyond one are marks of the next word."""
        waiting = ""
        for word in words:
            if not word:
                waiting += MARK
            elif waiting and len(self.line) > 1 and word.startswith("\n"):
                yield waiting[1:]
                yield word
                waiting = ""
            else:
                yield waiting + word
                waiting = ""
        if waiting:
            yield waiting[1:]

    def _word(self, word: str) -> tuple[int, ...]:
        alone = len(self.line) > 1 and word.startswith("\n")
        return tuple(self.stream(word if alone else MARK + word))

    def stream(self, text: str) -> Iterator[int]:
        """The ids of a text whose spaces are marks, as soon as they are final."""
        places = self._places_by_sum if self.unigram else self._places
        begin, before, window = 0, 0, WINDOW
        while len(text) - begin > window:
            sizes, numbers = places(text[begin : begin + window], before)
            meet = self._meeting(sizes)
            if not meet:
                window *= 2
                continue
            yield from self._path(text[begin : begin + meet], sizes, numbers)
            # The piece that ends at the meeting place still decides what may follow.
            begin, before, window = begin + meet, numbers[meet], WINDOW
        sizes, numbers = places(text[begin:], before)
        yield from self._path(text[begin:], sizes, numbers)

    def _places(self, text: str, before: int) -> tuple[list[int], list[int]]:
        """Size and number of the piece that ends at each place; number 0 is a character without piece."""
        longest, steps, agree, n = self.longest, self.steps, self._agree, len(text)
        sizes, numbers = [0] * (n + 1), [before] * (n + 1)
        for at in range(n):
            if at and not sizes[at]:
                continue  # only a path that is given up already leads here
            before = numbers[at] << 20
            number = steps.get(text[at], -1)
            if not sizes[at + 1] and (number <= 0 or agree[before | number]):
                sizes[at + 1], numbers[at + 1] = 1, max(number, 0)
            for end in range(at + 2, min(n, at + longest) + 1):
                number = steps.get(text[at:end])
                if number is None:
                    break
                if number > 0 and not sizes[end] and agree[before | number]:
                    sizes[end], numbers[end] = end - at, number
        return sizes, numbers

    def _places_by_sum(self, text: str, before: int) -> tuple[list[int], list[int]]:
        longest, steps, n = self.longest, self.steps, len(text)
        sizes, numbers, best = [0] * (n + 1), [before] * (n + 1), [0.0, *[-1e300] * n]
        for at in range(n):
            if at and not sizes[at]:
                continue
            for end in range(at + 1, min(n, at + longest) + 1):
                number = steps.get(text[at:end], -1 if end == at + 1 else None)
                if number is None:
                    break
                if number <= 0 and end > at + 1:
                    continue
                score = best[at] + (self.scores[number] if number > 0 else self.unknown_score)
                if score > best[end]:
                    sizes[end], numbers[end], best[end] = end - at, max(number, 0), score
        return sizes, numbers

    def _meeting(self, sizes: list[int]) -> int:
        """The place that all paths from the last places lead through, 0 if there is none."""
        places = set(range(max(0, len(sizes) - self.longest), len(sizes)))
        while len(places) > 1:
            latest = max(places)
            places.remove(latest)
            places.add(latest - sizes[latest])
        return places.pop()

    def _path(self, text: str, sizes: list[int], numbers: list[int]) -> list[int]:
        ids, place = [], len(text)
        while place > 0:
            if numbers[place]:
                ids.append(numbers[place])
            else:
                ids += [self.byte_ids[b] for b in reversed(text[place - 1].encode())]
            place -= sizes[place]
        ids.reverse()
        return ids

    def _left_alone(self, pair: int) -> bool:
        """Whether the merges leave these neighbours, or a first piece, as they are.

        Merges go by rank. While both pieces are made, the symbols at their common border
        grow; two that stand there together would be merged if their rank comes before
        the next merge of either. At the same rank the left one goes first.
        """
        before, number = pair >> 20, pair & 0xFFFFF
        if not self._borders[number]:
            return False
        if not before:
            return True
        left, right = iter(self._borders[before][1]), iter(self._borders[number][0])
        (x, x_ends), (y, y_ends) = next(left), next(right)
        while True:
            rank = self.rank.get(x + y)
            if rank is not None and rank < x_ends and rank <= y_ends:
                return False
            if x_ends == y_ends == _NEVER:
                return True
            if x_ends <= y_ends:
                x, x_ends = next(left)
            else:
                y, y_ends = next(right)

    def _borders_of(self, number: int) -> tuple[list, list] | None:
        """The symbols at a piece's two ends as its merges go on, each with the rank that ends it.

        None if the merges do not make the piece.
        """
        piece = self.pieces[number]
        symbols, first, last = list(piece), [], []
        while len(symbols) > 1:
            pairs = [(self.rank.get(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False))]
            rank, at = min(pairs)
            if rank == _NEVER:
                return None
            if at == 0:
                first.append((symbols[0], rank))
            if at == len(symbols) - 2:
                last.append((symbols[-1], rank))
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return [*first, (piece, _NEVER)], [*last, (piece, _NEVER)]


_codecs: dict[bytes, Codec] = {}


def _codec(model: bytes, unigram: bool = False) -> Codec:
    """The codec of this worker, which later tasks use again."""
    key = model + bytes([unigram])
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(model, unigram)
    return _codecs[key]


def read_model(path: str) -> bytes:
    """A model file, about 1 MB, read by the driver and broadcast."""
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, model: bytes, text_column: str = "text", unigram: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (array of int), ``n_tokens`` (long) and ``same`` (boolean).

    ``same`` tells whether the ids decode to the text; only the mark U+2581 in a text comes
    back as a space, as in the library. All three are null for null text; an empty text has
    no ids. Names that ``docs`` has already get a trailing ``_``.
    """
    names = [free_name(docs, n) for n in ("ids", "n_tokens", "same")]
    kinds = (ArrayType(IntegerType()), LongType(), BooleanType())
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value, unigram)
        for batch in batches:
            for part in slices(batch, text_column):
                texts = part.column(text_column).to_pylist()
                found = codec.encode_all(texts)
                same = [t is not None and codec.decode(f.tolist()) == t.replace(MARK, " ") for t, f in zip(texts, found, strict=True)]
                missing = np.array([t is None for t in texts], bool)
                sizes = np.array([len(f) for f in found], np.int64)
                ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                flat = pa.array(np.concatenate([np.zeros(0, np.int32), *found]))
                new = [
                    pa.ListArray.from_arrays(ends, flat, mask=pa.array(missing)),
                    pa.array(sizes, mask=missing), pa.array(same, mask=missing),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, *names])

    return docs.mapInArrow(work, with_columns(docs, **dict(zip(names, kinds, strict=True))))


def decode(rows: DataFrame, model: bytes, ids_column: str = "ids") -> DataFrame:
    """``rows`` with ``decoded`` (string); null ids give null, and no ids an empty text."""
    name = free_name(rows, "decoded")
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in batches:
            lists = batch.column(ids_column).cast(pa.list_(pa.int32()))
            flat, edges = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            valid = lists.is_valid().to_pylist()
            texts = [
                codec.decode(flat[a:b].tolist()) if ok else None
                for ok, a, b in zip(valid, edges[:-1], edges[1:], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, name]
            )

    return rows.mapInArrow(work, with_columns(rows, **{name: StringType()}))
