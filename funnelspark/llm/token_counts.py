"""Token counts that follow edits: a segment tree over the pre-tokens of each document.

A leaf holds up to ``LEAF`` runs of pre-tokens between single spaces; cutting there never
changes how a text is tokenized. Tree nodes hold sums of characters and tokens. An edit
descends to the leaves it touches, encodes again only these and one leaf of context on
each side, and updates the sums on the paths to the root. Trees are columns, so they can
be stored beside the text and taken up again with the next edits.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType

from funnelspark.llm.common import free_name, slices, with_columns

LEAF = 32
CACHED_RUNS = 300_000
#: Fixed value: the white space of the pattern.
SPACE = "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

#: An edit: ``length`` characters from ``start`` on are replaced by ``insert``.
EDITS = "array<struct<start:long,length:long,insert:string>>"


class Counter:
    """Token counts of runs, remembered."""

    def __init__(self, ranks: bytes, pattern: str):
        pairs = (line.split() for line in ranks.splitlines() if line)
        self.encoding = tiktoken.Encoding(
            "counted", pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={}
        )
        self.known: dict[str, int] = {}

    def count(self, run: str) -> int:
        found = self.known.get(run)
        if found is None:
            if len(self.known) >= CACHED_RUNS:
                self.known.clear()
            found = self.known[run] = len(self.encoding.encode_ordinary(run))
        return found


_counters: dict[tuple, Counter] = {}


def _counter(ranks: bytes, pattern: str) -> Counter:
    if (ranks, pattern) not in _counters:
        _counters.clear()
        _counters[ranks, pattern] = Counter(ranks, pattern)
    return _counters[ranks, pattern]


def runs(text: str) -> list[str]:
    """``text`` cut before single spaces between words; other white space stays in its run."""
    first, *rest = text.split(" ")
    if "" not in rest and not any(map(str.isspace, rest)):
        return [first, *(" " + r for r in rest)] if first else [" " + r for r in rest]
    out = [first] if first else []
    for run in rest:
        # White space alone would be cut differently beside other white space.
        if not run.strip(SPACE) and out and out[-1][-1] in SPACE:
            out[-1] += " " + run
        else:
            out.append(" " + run)
    return out


class Tree:
    """Sums over leaves: ``chars`` and ``tokens`` hold the root at 1, leaves from ``width`` on."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        if len(chars) != len(tokens) or len(chars) & (len(chars) - 1):
            raise ValueError("a tree has a power of two of nodes")
        self.chars, self.tokens, self.width = chars, tokens, len(chars) // 2

    @classmethod
    def over(cls, leaf_chars, leaf_tokens) -> Tree:
        width = 1 << max(0, len(leaf_chars) - 1).bit_length()
        nodes = np.zeros((2, 2 * width), np.int64)
        nodes[0, width : width + len(leaf_chars)] = leaf_chars
        nodes[1, width : width + len(leaf_tokens)] = leaf_tokens
        while width > 1:
            half = width // 2
            nodes[:, half:width] = nodes[:, width : 2 * width : 2] + nodes[:, width + 1 : 2 * width : 2]
            width = half
        return cls(*nodes)

    def total(self) -> int:
        return int(self.tokens[1])

    def find(self, place: int) -> tuple[int, int]:
        """The leaf with the character at ``place``, and where it begins; past the end the last with any."""
        place = min(place, int(self.chars[1]) - 1)
        node, begin = 1, 0
        while node < self.width:
            node *= 2
            if place >= begin + self.chars[node]:
                begin += int(self.chars[node])
                node += 1
        return node - self.width, begin

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        node = leaf + self.width
        more = chars - int(self.chars[node]), tokens - int(self.tokens[node])
        while node:
            self.chars[node] += more[0]
            self.tokens[node] += more[1]
            node //= 2


def build(text: str, counter: Counter) -> Tree:
    parts = runs(text)
    starts = range(0, len(parts), LEAF)
    if not parts:
        return Tree.over([0], [0])
    chars = np.add.reduceat(np.fromiter(map(len, parts), np.int64, len(parts)), starts)
    tokens = np.add.reduceat(np.fromiter(map(counter.count, parts), np.int64, len(parts)), starts)
    return Tree.over(chars, tokens)


def edit(text: str, tree: Tree, start: int, length: int, insert: str, counter: Counter) -> tuple[str, Tree, int]:
    """The text, its tree and how many characters were encoded after one edit.

    Places beyond the text's end are its end.
    """
    start = min(max(start, 0), len(text))
    stop = min(start + max(length, 0), len(text))
    if not text:
        return insert, build(insert, counter), len(insert)
    first, begin = tree.find(max(start - 1, 0))
    last, last_begin = tree.find(stop)
    end = last_begin + int(tree.chars[tree.width + last])
    # Context: a leaf on each side that has more than white space.
    while first > 0:
        first -= 1
        size = int(tree.chars[tree.width + first])
        begin -= size
        if text[begin : begin + size].strip(SPACE):
            break
    while last + 1 < tree.width and end < len(text):
        last += 1
        size = int(tree.chars[tree.width + last])
        end += size
        if text[end - size : end].strip(SPACE):
            break
    region = text[begin:start] + insert + text[stop:end]
    edited = text[:begin] + region + text[end:]
    parts = runs(region)
    slots = last - first + 1
    sizes = [len(p) for p in parts]
    counts = [counter.count(p) for p in parts]
    step = -(-len(parts) // slots) if parts else 1
    if step > 2 * LEAF:
        # The leaves would grow too large: the tree gets more of them, the others as they are.
        leaves = [(sum(sizes[i : i + LEAF]), sum(counts[i : i + LEAF])) for i in range(0, len(parts), LEAF)]
        leaf_chars, leaf_tokens = tree.chars[tree.width :], tree.tokens[tree.width :]
        around = [np.concatenate([a[:first], np.array(b, np.int64), a[last + 1 :]]) for a, b in zip((leaf_chars, leaf_tokens), zip(*leaves, strict=True), strict=True)]
        used = len(around[0]) - int((around[0][::-1] > 0).argmax())
        return edited, Tree.over(around[0][:used], around[1][:used]), len(region)
    for slot in range(slots):
        some = slice(slot * step, (slot + 1) * step)
        tree.put(first + slot, sum(sizes[some]), sum(counts[some]))
    return edited, tree, len(region)


def count(docs: DataFrame, ranks: bytes, pattern: str, text_column: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` (long) and the tree's nodes, ``tree_chars`` and ``tree_tokens``.

    Null text has nulls, an empty text 0 tokens and a tree of one empty leaf. Names taken
    already get a trailing ``_``.
    """
    names = [free_name(docs, n) for n in ("n_tokens", "tree_chars", "tree_tokens")]
    kinds = (LongType(), ArrayType(LongType()), ArrayType(LongType()))
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pattern))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(*shared.value)
        for batch in batches:
            for part in slices(batch, text_column):
                texts = part.column(text_column).to_pylist()
                trees = [None if t is None else build(t, counter) for t in texts]
                columns = [
                    pa.array([t and t.total() for t in trees], pa.int64()),
                    pa.array([t and t.chars for t in trees], pa.list_(pa.int64())),
                    pa.array([t and t.tokens for t in trees], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*part.schema.names, *names])

    return docs.mapInArrow(work, with_columns(docs, **dict(zip(names, kinds, strict=True))))


def recount(
    counted: DataFrame, ranks: bytes, pattern: str, edits_column: str = "edits", text_column: str = "text",
    tree_columns: tuple[str, str] = ("tree_chars", "tree_tokens"),
) -> DataFrame:
    """``counted`` after its edits, applied in order: text and tree columns are replaced, and
    ``n_tokens_edited``, ``n_edits`` and ``chars_encoded`` (long) are added.

    ``edits_column`` has the type ``EDITS``; null edits are none, a null insert is empty,
    and edits of a null text are made on an empty one that stays null if there are none.
    """
    names = [free_name(counted, n) for n in ("n_tokens_edited", "n_edits", "chars_encoded")]
    schema = with_columns(counted, **dict.fromkeys(names, LongType()))
    shared = counted.sparkSession.sparkContext.broadcast((ranks, pattern))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(*shared.value)
        for batch in batches:
            for part in slices(batch, text_column):
                given = [part.column(c).to_pylist() for c in (text_column, edits_column, *tree_columns)]
                texts, chars, tokens, totals, numbers, encoded = [], [], [], [], [], []
                for text, edits, tree_chars, tree_tokens in zip(*given, strict=True):
                    tree, work_done = None, 0
                    if text is not None:
                        tree = Tree(np.array(tree_chars, np.int64), np.array(tree_tokens, np.int64))
                    elif edits:
                        text, tree = "", Tree.over([0], [0])
                    for e in edits or ():
                        text, tree, more = edit(text, tree, e["start"] or 0, e["length"] or 0, e["insert"] or "", counter)
                        work_done += more
                    texts.append(text)
                    chars.append(tree and tree.chars)
                    tokens.append(tree and tree.tokens)
                    totals.append(tree and tree.total())
                    numbers.append(len(edits or ()))
                    encoded.append(work_done)
                new = {
                    text_column: pa.array(texts, pa.string()),
                    tree_columns[0]: pa.array(chars, pa.list_(pa.int64())),
                    tree_columns[1]: pa.array(tokens, pa.list_(pa.int64())),
                }
                arrays = [new.get(n, part.column(i)) for i, n in enumerate(part.schema.names)]
                arrays += [pa.array(x, pa.int64()) for x in (totals, numbers, encoded)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*part.schema.names, *names])

    return counted.mapInArrow(work, schema)

