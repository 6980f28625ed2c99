"""Embedding links where there are links: against all pairs, and in dense groups."""

import resource

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from funnelspark.llm import embedding_dedup
from funnelspark.sources.storage import written


def by_all_pairs(ids, rows, cosine=0.9):
    units = rows / np.linalg.norm(rows, axis=1)[:, None]
    near = units @ units.T >= cosine
    np.fill_diagonal(near, False)
    component = np.array(ids)
    while True:
        lower = np.array([min([component[i], *component[near[i]]]) for i in range(len(ids))])
        if (lower == component).all():
            return [(i, int(n), int(c), i == c) for i, n, c in zip(ids, near.sum(1), component)]
        component = lower


def test_planted_links_of_64_dimensions(spark):
    """Chains, copies, pairs just above and below the bound, and vectors alone."""
    rng = np.random.default_rng(1)
    rows = [rng.standard_normal(64) for _ in range(200)]
    for i in range(60):
        base = rows[i] / np.linalg.norm(rows[i])
        side = rng.standard_normal(64)
        side -= base * (side @ base)
        side /= np.linalg.norm(side)
        for cosine in (0.9 + 1e-4, 0.9 - 1e-4, 0.97):
            rows.append(3 * (cosine * base + np.sqrt(1 - cosine**2) * side))
    rows += rows[:10]
    rows = np.array(rows)
    ids = list(range(100, 100 + len(rows)))
    table = spark.createDataFrame([(i, r.tolist()) for i, r in zip(ids, rows)], "vec_id long, embedding array<double>")
    found = embedding_dedup.links(table.repartition(4), tile=64)
    got = sorted(tuple(r) for r in found.select("vec_id", "n_links", "component_id", "kept").collect())
    expected = by_all_pairs(ids, rows)
    assert got == expected and sum(n for _, n, _, _ in expected) > 300


def test_a_dense_group_takes_bounded_memory():
    """One tile of 5,000 near vectors: pairs are verified in runs."""
    rng = np.random.default_rng(2)
    rows = np.ones((5000, 64)) + 0.05 * rng.standard_normal((5000, 64))
    names = [b"%032d" % i for i in range(len(rows))]
    tile = pa.table(
        {
            "n": [64] * 5000, "block": [0] * 5000, "cell": [0] * 5000, "other": [0] * 5000, "i": [0] * 5000,
            "j": [0] * 5000, "raw": [r.tobytes() for r in rows], "node": names, "copies": [1] * 5000,
            "right": [False] * 5000,
        }
    )
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    found = embedding_dedup._joined(tile, 0.9)
    grown = (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024
    counts = [n for n in found["links"].to_pylist() if n is not None]
    assert counts == [4999] * 5000
    assert grown < 1000


@pytest.mark.parametrize("element", ["float", "double"])
def test_a_vector_is_stored_once_however_many_tiles_there_are(spark, monkeypatch, tmp_path, element):
    """With 13 sides and more a vector is in one file; tasks are handed names of files, not vectors."""
    rng = np.random.default_rng(3)
    rows = rng.standard_normal((200, 64)).astype(np.float32).astype(float)
    rows[100:130] = (rows[:30] + 0.1 * rng.standard_normal((30, 64))).astype(np.float32)
    rows[190:] = rows[:10]
    ids = list(range(200))
    table = spark.createDataFrame(list(zip(ids, rows.tolist())), f"vec_id long, embedding array<{element}>")
    plans = []

    def watched(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, label)

    monkeypatch.setattr(embedding_dedup, "written", watched)
    monkeypatch.setattr(embedding_dedup, "new_folder", lambda spark, label: f"file:{tmp_path}/{label}", raising=False)
    got = embedding_dedup.links(table, tile=16)
    assert sorted(tuple(r) for r in got.collect()) == by_all_pairs(ids, rows)
    assert not any("Generate" in plan for plan in plans) and sum("raw#" in plan for plan in plans) == 1
    files = list((tmp_path / "vectors").glob("*.arrow"))
    sides = [pa.ipc.open_file(file).read_all() for file in files]
    names = [name for side in sides for name in side["node"].to_pylist()]
    assert len(names) == len(set(names)) == 190 and max(map(len, sides)) <= 16 and len(files) >= 12
    assert {len(raw) for side in sides for raw in side["raw"].to_pylist()} == {64 * (4 if element == "float" else 8)}


@pytest.mark.parametrize("sides", range(1, 12))
def test_any_two_sides_meet_once(sides):
    met = Counter(
        tuple(sorted((i, (i + k) % sides)))
        for _, i, first, last in embedding_dedup._units({64: sides}) for k in range(first, last)
    )
    assert met == Counter((i, j) for i in range(sides) for j in range(i, sides))
