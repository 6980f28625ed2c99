"""Packing against the tokenizer library, optimal packings and its own rules."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from funnelspark.llm import packing
from funnelspark.llm.queries import TOKENIZERS

SCHEMA = "doc_id long, text string, uid int, piece string"


@pytest.fixture(scope="module")
def tokenizer():
    with open(f"{TOKENIZERS}/word_bpe_49k.json", encoding="utf-8") as file:
        return file.read()


@pytest.fixture(scope="module")
def library(tokenizer):
    from tokenizers import Tokenizer

    return Tokenizer.from_str(tokenizer)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [1]


def test_ids_are_those_of_the_library(tokenizer, library):
    """Any white space, marks that compose, specials, contractions, capitals of any kind."""
    draw = random.Random(1)
    signs = [
        *"abcABK  \t\n\r\x0b\x0c\x1c\x1f\x85\xa0 ̸́̈é'ßΣσİ1२!?.=,\x00漢😀가×÷ÀÿÃ",
        "<|endoftext|>", "<|EndOfText|>", "<|", "|>", "'s", " 'll", "n't", "'RE", "it's", '"\'s', "don''t", "K",
    ]
    texts = ["".join(draw.choice(signs) for _ in range(draw.randrange(40))) for _ in range(20_000)]
    texts += [None, "", " ", "x" * 5000]
    ids, offsets = packing.Coder(tokenizer).encode(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == ids_of(library, text), repr(text)


def check(rows, found, library, limit):
    """The rules of the result; the number of sequences."""
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    got = found.collect()
    wanted = []
    for doc_id, text in rows:
        ids = np.array(ids_of(library, text), "<u4")
        for piece, start in enumerate(range(0, len(ids), limit)):
            part = ids[start : start + limit]
            wanted.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(wanted, key=key)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= limit
    return len(bins)


def test_documents(spark, tokenizer, library):
    draw = random.Random(2)
    words = "alpha beta gamma, it's Δ Σ. rare".split()
    rows = [(i, " ".join(draw.choice(words) for _ in range(int(draw.expovariate(1 / 40))))) for i in range(600)]
    rows += [(700, None), (701, ""), (None, "a b"), (None, None), (3, rows[3][1]), *[(5, "x y z")] * 300]
    rows.append((800, "word " * 300_000))
    docs = spark.createDataFrame([(*r, 1, "p") for r in rows], SCHEMA).repartition(4)
    n = check(rows, packing.pack(docs, tokenizer, 256, instance=200), library, 256)
    total = sum(len(ids_of(library, text)) for _, text in rows)
    assert n <= -(-total // 256) + 2


def test_no_rows(spark, tokenizer, library):
    assert check([], packing.pack(spark.createDataFrame([], SCHEMA), tokenizer), library, 4096) == 0


def fewest(sizes, limit):
    """The least number of bins, by trying all ways to place each piece."""
    best = len(sizes)

    def place(i, fills):
        nonlocal best
        if len(fills) >= best:
            return
        if i == len(sizes):
            best = len(fills)
            return
        for j in {fill: j for j, fill in enumerate(fills) if fill + sizes[i] <= limit}.values():
            place(i + 1, [*fills[:j], fills[j] + sizes[i], *fills[j + 1 :]])
        place(i + 1, [*fills, sizes[i]])

    place(0, [])
    return best


def islands(sizes, limit):
    """What the islands of one instance find, without Spark."""
    draws = [np.random.default_rng([1, i]) for i in range(packing.ISLANDS)]
    populations = [packing.first_population(sizes, draw, limit) for draw in draws]
    for _ in range(packing.ROUNDS):
        elites = [p[0] for p in populations]
        populations = [
            packing.evolved(sizes, [*p, elites[i - 1]], draws[i], limit, packing.GENERATIONS)
            for i, p in enumerate(populations)
        ]
    return [p for population in populations for p in population]


def test_small_instances_are_packed_best():
    draw = random.Random(4)
    for _ in range(60):
        sizes = np.array(sorted((draw.randrange(1, 60) for _ in range(draw.randrange(1, 13))), reverse=True))
        every = islands(sizes, 100)
        assert all(packing.filled(sizes, p).max() <= 100 for p in every)
        assert min(packing.merit(sizes, p)[0] for p in every) == fewest(sizes.tolist(), 100)


def test_evolution_beats_best_fit():
    """Triplets that fill their bins exactly, where best fit in falling order needs more bins."""
    draw = random.Random(6)
    gained = 0
    for _ in range(6):
        sizes = []
        for _ in range(12):
            a = draw.randrange(380, 490)
            b = draw.randrange(250, 1000 - a - 250)
            sizes += [a, b, 1000 - a - b]
        sizes = np.array(sizes)
        first = packing.merit(sizes, packing.packed(sizes, np.argsort(-sizes, kind="stable"), 1000))
        best = min(packing.merit(sizes, p) for p in islands(sizes, 1000))
        assert best <= first
        gained += best < first
    assert gained


def test_crossover_keeps_whole_bins():
    sizes = np.array([50, 50, 40, 60, 30, 70, 20, 10])
    a = packing.renumbered(np.array([0, 1, 0, 2, 1, 3, 1, 0]))
    b = packing.renumbered(np.array([0, 0, 1, 1, 2, 2, 3, 3]))
    for seed in range(20):
        child = packing.crossed(sizes, a, b, np.random.default_rng(seed), 100)
        assert packing.filled(sizes, child).max() <= 100
        assert any(child[i] == child[j] for i, j in ((0, 1), (2, 3), (4, 5)))


def test_large_pieces_stay_alone(spark):
    """Nothing fits beside another piece: no level follows."""
    items = spark.createDataFrame([(i, 60 + i % 40) for i in range(500)] + [(500, 100)], "uid long, length long")
    assert packing.sequences(items, 100, 50).select("sequence_id").distinct().count() == 501
