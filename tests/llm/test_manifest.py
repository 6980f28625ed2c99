"""The Merkle manifest against trees built row by row."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from funnelspark.llm import manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, Leaf string, tree int, lo int"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(values):
    texts = [None if v is None else str(v) for v in values]
    return sha("".join("-" if t is None else f"{len(t.encode())}:{t}" for t in texts))


def tree_of(digests):
    """The root and the siblings (left, right) of each digest, level by level."""
    paths = [[] for _ in digests]
    nodes = [(d, [i]) for i, d in enumerate(digests)]
    while len(nodes) > 1:
        parents = []
        for a in range(0, len(nodes), 8):
            run = nodes[a : a + 8]
            for j, (_, members) in enumerate(run):
                for i in members:
                    paths[i].append(("".join(d for d, _ in run[:j]), "".join(d for d, _ in run[j + 1 :])))
            parents.append((sha("".join(d for d, _ in run)), [i for _, m in run for i in m]))
        nodes = parents
    return nodes[0][0], paths


def plain(rows, tampers):
    """``(doc_id, leaf, subroot, root, proof, folded, verified)`` of rows of ``FIELDS`` order."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    found, subroots = [], []
    for lang in sorted(groups, key=lambda x: (x is not None, (x or "").encode())):
        members = sorted(groups[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        subroot, paths = tree_of([leaf_of(r) for r in members])
        subroots.append(subroot)
        found.append((members, paths))
    root, above = tree_of(subroots) if subroots else (None, [])
    out = []
    for (members, paths), subroot, upper in zip(found, subroots, above):
        for row, path in zip(members, paths):
            node = leaf_of(tampers(row))
            for left, right in path + upper:
                node = sha(left + node + right)
            proof = sha("".join(left + right for left, right in path + upper))
            out.append((row[0], leaf_of(row), subroot, root, proof, node, node == root))
    return out


def tampered_by_hash(row):
    doc_id, *rest, text = row
    if doc_id is None or zlib.crc32(str(doc_id).encode()) % 3 or text is None:
        return row
    return (doc_id, *rest, text.translate(str.maketrans(UPPER, UPPER.lower())))


def compare(spark, rows):
    """``rows`` in the order of ``FIELDS``."""
    data = [(d, text, lang, source, n, "x", 1, 2) for d, source, lang, n, text in rows]
    docs = spark.createDataFrame(data, SCHEMA).repartition(3)
    low = F.when(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.translate("text", UPPER, UPPER.lower())
    ).otherwise(F.col("text"))
    found = manifest.manifest(docs, FIELDS, "lang", "doc_id", {"text": low})
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(plain(rows, tampered_by_hash), key=key)


@pytest.mark.parametrize("n", [1, 8, 65])
def test_sizes_of_one_tree(spark, n):
    """Runs of one, of eight and shorter last ones, with one tree and one level above."""
    compare(spark, [(i, "s", "en", i, f"Text {i}") for i in range(n)])


def test_nulls_ties_and_many_groups(spark):
    draw = random.Random(5)
    langs = [None, "", "-", "=", "é", "z", "Z", *[f"l{i}" for i in range(70)]]
    rows = [
        (
            draw.choice([None, draw.randrange(40)]), draw.choice([None, "", "web"]), draw.choice(langs),
            draw.choice([None, 3]), draw.choice([None, "", "A b", "Ünï", "a\n:1"]),
        )
        for _ in range(300)
    ]
    compare(spark, rows + rows[:20])


def test_very_long_text(spark):
    compare(spark, [(1, "s", "en", 5, "Aé " * 700_000), (2, "s", "en", None, "b")])


def test_no_rows(spark):
    found = manifest.manifest(spark.createDataFrame([], SCHEMA), FIELDS, "lang", "doc_id")
    assert found.count() == 0
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_untampered_rows_verify(spark):
    docs = spark.createDataFrame([(i, f"{i}", "a", "b", 1, "", 0, 0) for i in range(20)], SCHEMA)
    assert manifest.manifest(docs, FIELDS, "lang", "doc_id").where("NOT verified").count() == 0
