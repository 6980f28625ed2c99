"""The operators on small inputs with nulls, empty and repeated rows, against plain Python."""

import re
import textwrap
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from compare import connect, duck_table, spark_table, type_differences
from conftest import SMALLEST
from pyspark.sql import functions as F

import corpus_pipeline
from funnelspark.llm import (
    decontaminate, embedding_dedup, language_id, licenses, near_dedup, queries, sentencepiece_codec, sharding,
    substring_dedup, token_counts, toxicity,
)
from funnelspark.llm.common import PLAIN, Words, components, lower, utf8

WORDS = [f"w{i}" for i in range(400)]
LONG = " ".join(WORDS)
NEAR = LONG.replace("w200 ", "changed ")
SHARED = " ".join(WORDS[100:140])
ROWS = [
    (1, LONG, "a"), (2, LONG, "a"), (3, NEAR, None), (4, None, "b"), (5, "", "b"), (6, "", None),
    (7, f"begin {SHARED} end", "c"), (8, "one two", "c"), (8, "one two", "c"), (None, "no id here", "d"),
    (9, "MIT is not here.\nReleased under the MIT License.\n1 2 3", "e"), (10, "12 34 !!", "e"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_words long, score double, ids string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", s, 7, 0.5, "x", 3) for i, t, s in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, SHARED), (2, "one TWO"), (3, None), (4, ""), (5, "...")]
    return spark.createDataFrame(rows, "item_id long, text string")


def model_file(name):
    return sentencepiece_codec.read_model(f"{queries.TOKENIZERS}/{name}")


def by_id(df, *columns):
    return sorted((tuple(r[c] for c in ("doc_id", *columns)) for r in df.collect()), key=repr)


# Token counts


def test_counts_follow_edits(spark, docs, empty):
    ranks = model_file("byte_bpe_50k.tiktoken")
    counter = token_counts.Counter(ranks, queries.PATTERN)
    counted = token_counts.recount(
        token_counts.count(queries.edits_of(docs), ranks, queries.PATTERN), ranks, queries.PATTERN
    )
    for row in counted.collect():
        if row["text"] is None:
            assert row["n_tokens"] is None and row["n_tokens_edited"] is None
        else:
            assert row["n_tokens_edited"] == len(counter.encoding.encode_ordinary(row["text"]))
    assert token_counts.count(empty, ranks, queries.PATTERN).count() == 0


def test_only_the_region_of_an_edit_is_encoded():
    counter = token_counts.Counter(model_file("byte_bpe_50k.tiktoken"), queries.PATTERN)
    rng = np.random.default_rng(1)
    letters = list("ab  \n\t the's 12.é漢\x1c ")
    for text in (LONG, " \n  ", "", " x"):
        tree = token_counts.build(text, counter)
        for _ in range(60):
            insert = "".join(rng.choice(letters, rng.integers(0, 9)))
            start, length = int(rng.integers(len(text) + 2)), int(rng.choice([0, 1, 30]))
            text, tree, encoded = token_counts.edit(text, tree, start, length, insert, counter)
            assert tree.total() == len(counter.encoding.encode_ordinary(text))
            assert tree.chars[1] == len(text)
            assert encoded <= len(insert) + 8 * 40 * token_counts.LEAF


# Sharding


def test_shards_are_even_and_gapless(spark, docs, empty):
    big = docs.select("doc_id", "text").union(
        spark.range(1000, 4000).select("id", F.when(F.col("id") % 3 == 0, "hot text").otherwise(F.concat(F.lit("t"), "id")))
    )
    rows = sharding.shard(big, 5, ranges_per_shard=4).collect()
    sizes, slots = Counter(), defaultdict(list)
    for r in rows:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert len(rows) == big.count() and set(sizes) == set(range(5))
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r["size"] for r in rows)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    got = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert got[3]["text_crc32"] == zlib.crc32(NEAR.encode())
    assert [(r["size"], r["text_crc32"]) for r in rows if r["doc_id"] == 4 and r["text_crc32"] is None] == [(8, None)]
    assert sharding.shard(empty, 5).count() == 0


# Licences


def test_licences_are_found_and_confirmed(docs, empty):
    model = licenses.fitted(docs)
    found = {r["doc_id"]: r for r in licenses.scan(docs, model).collect()}
    assert [s["family"] for s in found[9]["statements"]] == ["MIT"]
    assert found[9]["n_paragraphs"] == 3 and found[4]["n_paragraphs"] == 0
    assert all(not r["statements"] for i, r in found.items() if i != 9)
    assert licenses.scan(empty, licenses.fitted(empty)).count() == 0


@pytest.mark.parametrize("family", licenses.TEMPLATES)
def test_every_template_is_recognised(family):
    model = licenses.train(["some plain words of no licence at all", "another line"] * 20)
    for statement in licenses.TEMPLATES[family]:
        found = model.found(licenses.Paragraphs(*utf8(pa.array([f"Before\n{statement}\nafter"]))))
        assert family in [model.families[f] for _, f, _ in found]


@pytest.mark.parametrize("family", licenses.TEMPLATES)
def test_statements_across_lines_and_anywhere_in_long_lines(family):
    model = licenses.train(["some plain words of no licence at all", "another line"] * 20)
    names = list(licenses.TEMPLATES)
    for statement in licenses.TEMPLATES[family]:
        texts = [textwrap.fill(f"{lead} {statement}", 70) for lead in ("x", "some plain words", "a " * 25)]
        plain = [f"p{k}" for k in range(140)]
        texts += [" ".join([*plain[:k], statement, *plain[k:]]) for k in range(131)]
        found = model.statements(licenses.Paragraphs(*utf8(pa.array(texts))))
        assert {t for t, f, *_ in found if names[f] == family} == set(range(len(texts)))
        assert all(names[f] == family for _, f, *_ in found)
    apart = pa.array(["Permission is hereby granted, free of charge, to any person\n\nobtaining a copy of this"])
    assert not model.statements(licenses.Paragraphs(*utf8(apart)))


# Decontamination


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 100])
def test_contamination(docs, benchmark, empty, block_bytes):
    found = decontaminate.contamination(docs, benchmark, block_bytes=block_bytes)
    rows = {r["doc_id"]: r for r in found.collect()}
    spans = {i: [tuple(s) for s in r["hit_spans"]] for i, r in rows.items()}
    assert spans[1] == spans[2] == [(100, 139)] and spans[7] == [(1, 40)] and spans[8] == [(0, 1)]
    assert rows[7]["items"] == ["1"] and rows[8]["items"] == ["2"] and not spans[4] and not spans[10]
    assert rows[1]["n_words"] == 7 and rows[1]["n_words_"] == 400 and rows[4]["n_words_"] == 0
    assert by_id(decontaminate.cut(docs, benchmark).where("doc_id IN (7, 8)"), "text") == [
        (7, "begin  end"), (8, ""), (8, "")
    ]
    kept = decontaminate.clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r[0] for r in kept.select("doc_id").collect()} == {None, 4, 5, 6, 9, 10}
    assert decontaminate.contamination(empty, benchmark).count() == 0
    assert decontaminate.clean(docs, benchmark.limit(0)).count() == len(ROWS)


# Near duplicates


def test_near_duplicates(docs, empty):
    got = by_id(near_dedup.near_duplicates(docs), "class_id", "kept")
    assert got == sorted(
        [(1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (5, 5, True), (6, 5, False), (7, 7, True),
         (8, 8, True), (8, 8, True), (None, None, True), (9, 9, True), (10, 10, True)], key=repr,
    )
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r[0] for r in kept.select("doc_id").collect()) == Counter([1, 4, 5, 7, 8, None, 9, 10])
    assert near_dedup.near_duplicates(empty).count() == 0


def test_similarity_is_the_banded_alignment():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a = rng.integers(0, 12, rng.integers(1, 30))
        b = np.concatenate([a[: rng.integers(len(a) + 1)], rng.integers(0, 12, rng.integers(4)), a[rng.integers(len(a)) :]])
        lcs = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                lcs[i + 1, j + 1] = lcs[i, j] + 1 if x == y else max(lcs[i, j + 1], lcs[i + 1, j])
        m = lcs[-1, -1]
        expected = len(b) > 0 and m >= 0.8 * (len(a) + len(b) - m) - 1e-9
        assert near_dedup.similar(a, b) == expected


def test_a_group_of_near_copies_is_one_class(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(60):
        words = list(WORDS[:150])
        for k in rng.integers(150, size=rng.integers(0, 5)):
            words[k] = f"x{rng.integers(10**6)}"
        rows.append((i, " ".join(words)))
    sequences = [_shingles(t) for _, t in rows]
    root = list(range(60))
    for _ in range(60):
        for i in range(60):
            for j in range(60):
                if near_dedup.similar(sequences[i], sequences[j]):
                    root[i] = min(root[i], root[j])
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert by_id(got, "class_id") == sorted(enumerate(root), key=repr)


def test_short_near_copies_are_all_found(spark):
    rng = np.random.default_rng(4)
    texts = []
    for size in [*range(1, 10)] * 6 + [*range(10, 25)] * 4:
        words = [f"v{k}" for k in rng.integers(10**6, size=size)]
        if size > 8:
            words[6:8] = words[:2]
        texts += [words, [*words, "added"], ["added", *words], words[:-1]]
    rows = [(i, " ".join(words)) for i, words in enumerate(texts) if words]
    sequences = {i: _shingles(t) for i, t in rows}
    root = dict.fromkeys(sequences)
    for i in sequences:
        root[i] = next((root[j] for j in range(i - i % 4, i) if j in root and near_dedup.similar(sequences[i], sequences[j])), i)
    assert all(root[i + 1] == i for i in range(0, len(texts), 4) if len(texts[i]) in (8, 9))
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert by_id(got, "class_id") == sorted(root.items(), key=repr)


def test_rare_keys_meet_for_every_similar_pair(spark):
    """Also with repeats, in any order of the cells, and with the bound on places."""
    rng = np.random.default_rng(5)
    sequences = {b"x": [1] * 10, b"y": [1] * 9, b"p": [1, *range(50, 70)]}
    for i in range(60):
        base = rng.integers(0, 30, rng.integers(1, 60))
        sequences[b"a%d" % i] = base.tolist()
        for k in range(2):
            other = np.delete(base, rng.integers(len(base), size=rng.integers(0, 1 + len(base) // 6)))
            sequences[b"%d%d" % (k, i)] = np.insert(other, 0, rng.integers(0, 30, rng.integers(0, 3))).tolist()
    rows = [(bytearray(d), s) for d, s in sequences.items() if s]
    keys = near_dedup._prefixes(spark.createDataFrame(rows, "digest binary, shingles array<long>"))
    pairs = near_dedup._near_in_size(keys.withColumn("root", F.col("digest")))
    found = {frozenset((bytes(r["a"]), bytes(r["b"]))) for r in pairs.collect()}
    names = [bytes(d) for d, _ in rows]
    similar = {
        frozenset((x, y)) for i, x in enumerate(names) for y in names[:i]
        if near_dedup.similar(np.array(sequences[x]), np.array(sequences[y]))
    }
    assert len(similar) > 60 and similar <= found


def test_common_passages_and_a_large_family(spark):
    """2,000 near copies are one class; texts that share half of their words are none."""
    rng = np.random.default_rng(6)
    rows = []
    for i in range(2000):
        words = list(WORDS[:120])
        words[int(rng.integers(120))] = f"x{i}"
        rows.append((i, " ".join(words)))
    passage = [f"common{k}" for k in range(60)]
    for i in range(2000, 2600):
        rows.append((i, " ".join([*passage, *(f"own{i}of{k}" for k in range(45))])))
    rows += [(2600 + i, rows[2000 + i][1] + " end") for i in range(20)]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(8))
    expected = [(i, 0 if i < 2000 else i if i < 2600 else i - 600) for i, _ in rows]
    assert by_id(got, "class_id") == sorted(expected, key=repr)


def _shingles(text):
    data, offsets = utf8(pa.array([text]))
    return near_dedup.shingles(Words(lower(data), offsets, PLAIN))[1]


# SentencePiece


def test_ids_are_the_librarys(docs, empty):
    model = model_file("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    coded = sentencepiece_codec.encode(docs, model)
    for r in coded.collect():
        assert r["ids_"] == (None if r["text"] is None else library.encode(r["text"]))
        assert r["same"] is (None if r["text"] is None else True)
    decoded = sentencepiece_codec.decode(coded.select("doc_id", "text", "ids_"), model, "ids_")
    assert decoded.where("NOT text <=> decoded").count() == 0
    assert sentencepiece_codec.encode(empty, model).count() == 0


def test_streams_of_any_text():
    model = model_file("piece_bpe_32k.model")
    library, codec = sentencepiece.SentencePieceProcessor(model_proto=model), sentencepiece_codec.Codec(model)
    rng = np.random.default_rng(4)
    letters = list("ab the  \n\t▁é漢字😀ingtionA0_")
    texts = ["".join(rng.choice(letters, rng.integers(0, 200))) for _ in range(150)]
    texts += ["".join(rng.choice(["the", "in", "tion", "a"], 3000)), "a" * 5000]
    for text, ids in zip(texts, codec.encode_all(texts), strict=True):
        assert ids.tolist() == library.encode(text)


def test_largest_sum_of_scores():
    codec = sentencepiece_codec.Codec(model_file("piece_bpe_32k.model"), unigram=True)
    text = sentencepiece_codec.MARK + "thentions"
    best = [0.0] + [-1e300] * len(text)
    for end in range(1, len(text) + 1):
        for at in range(end):
            number = codec.steps.get(text[at:end], 0)
            if number > 0:
                best[end] = max(best[end], best[at] + codec.scores[number])
    assert sum(codec.scores[i] for i in codec.encode("thentions")) == best[-1]


# Toxicity


def test_toxic_spans(spark, docs, empty):
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(WORDS, 40)) for _ in range(300)]
    bad = [i % 3 == 0 for i in range(300)]
    texts = [f"{t} vile{WORDS[i % 5]} {' '.join(t.split()[:4])}" if b else t for i, (t, b) in enumerate(zip(texts, bad, strict=True))]
    model = toxicity.train(texts[:200], [int(b) for b in bad[:200]])
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in toxicity.tag(frame, model).collect()}
    right = sum((rows[i]["score"] >= toxicity.THRESHOLD) == bad[i] for i in range(200, 300))
    assert right >= 97
    words = [texts[i].encode()[s["begin"] : s["end"]].decode() for i in range(300) for s in rows[i]["spans"]]
    assert np.mean([w.startswith("vile") for w in words]) > 0.9
    tagged = toxicity.tag(docs, model)
    assert tagged.columns[: len(docs.columns)] == docs.columns and tagged.count() == len(ROWS)
    assert toxicity.tag(empty, None).count() == 0
    assert {r["score_"] for r in toxicity.tag(docs, None).collect()} == {0.0}


def test_marginals_are_those_of_all_taggings():
    rng = np.random.default_rng(6)
    model = toxicity.Model(
        rng.standard_normal((5, (1 << toxicity.HASH_BITS) + 1)).astype(np.float32), 0.3, rng.standard_normal((2, 2)), np.zeros(3)
    )
    model.emit[:, -1] = 0
    codes = rng.integers(0, 50, (3, 6, 1)).astype(np.int32)
    scores = model._scores(codes)[:, 0]
    weight = np.zeros((6, 2))
    for tags in np.ndindex(*[2] * 6):
        value = sum(scores[i] for i in range(6) if tags[i]) + sum(model.move[tags[i], tags[i + 1]] for i in range(5))
        for i in range(6):
            weight[i, tags[i]] += np.exp(value)
    assert np.allclose(model.marginals(codes)[0][:, 0], weight[:, 1] / weight.sum(1), atol=1e-5)


# Language


def test_languages(spark, docs, empty):
    learned = spark.read.parquet(f"{SMALLEST}/documents.parquet")
    model = language_id.fitted(learned.where(queries.remainder("doc_id", 4) != 2))
    held = language_id.identify(learned.where(queries.remainder("doc_id", 4) == 2), model)
    assert held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.9
    found = language_id.identify(docs, model)
    assert found.columns == [*docs.columns, "lang_pred", "score_"]
    labels = {r["doc_id"]: r["lang_pred"] for r in found.collect()}
    assert all(labels[i] == "und" for i in (4, 5, 6, 10)) and labels[1] in model.labels
    assert language_id.identify(empty, language_id.fitted(empty)).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(docs, language_id.fitted(empty)).collect()} == {"und"}


def test_slopes_are_those_of_the_loss():
    rng = np.random.default_rng(7)
    model = language_id.train(["abc def", "xyz uvw"], ["a", "b"], steps=1)
    for p in model.parameters():
        p += rng.standard_normal(p.shape).astype(np.float32) * 0.1
    codes, target = rng.integers(97, 100, (6, 4)), np.array([0, 1, 1, 0])
    _, slopes = model.gradients(codes, target)
    for p, slope in zip(model.parameters(), slopes, strict=True):
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        old, ends = p[at], []
        for step in (1e-2, -1e-2):
            p[at] = old + step
            ends.append(model.gradients(codes, target)[0])
        p[at] = old
        assert (ends[0] - ends[1]) / 2e-2 == pytest.approx(slope[at], rel=0.1, abs=1e-3)


# Embeddings


def test_links(spark):
    rng = np.random.default_rng(8)
    rows = rng.standard_normal((150, 8))
    rows[50:100] = rows[:50] + 0.2 * rng.standard_normal((50, 8))
    rows[100:110] = rows[3]
    unit = rows / np.linalg.norm(rows, axis=1)[:, None]
    near = unit @ unit.T >= embedding_dedup.COSINE
    np.fill_diagonal(near, False)
    root = np.arange(150)
    for _ in range(150):
        root = np.minimum(root, np.where(near, root[None], 999).min(1))
    odd = [[0.0] * 8, None, [], [float("nan")] * 8, [None] * 8, [float("inf")] * 8, [1.0, 2.0]]
    data = [(i, r.tolist(), "x") for i, r in enumerate(rows)] + [(200 + i, v, "x") for i, v in enumerate(odd)]
    frame = spark.createDataFrame([(None, rows[3].tolist(), "x"), *data], "vec_id long, embedding array<double>, n_links string")
    got = {r["vec_id"]: r for r in embedding_dedup.links(frame, tile=16).collect()}
    copies = {3, *range(100, 110)}
    for i in range(150):
        more = bool(near[i, 3]) or i in copies
        assert got[i]["n_links"] == near[i].sum() + more
        assert got[i]["component_id"] == root[i] and got[i]["kept"] == (root[i] == i)
    assert got[None]["component_id"] == root[3] and got[None]["kept"] is False
    for i in range(len(odd)):
        assert (got[200 + i]["n_links"], got[200 + i]["component_id"]) == (0, 200 + i)
    assert embedding_dedup.links(frame.limit(0)).count() == 0


def test_each_link_is_counted_in_one_block():
    """Pairs within the slack of an earlier block's share, found by several blocks."""
    n = 64
    cut = embedding_dedup._cuts(n)[0]
    share = 0.2 * (cut[1] - cut[0]) / n
    turn = embedding_dedup.rotation(n)
    for extra in np.linspace(-1e-6, 2e-6, 31):
        a, b = np.zeros(n), np.zeros(n)
        half = np.sqrt(share + extra) / 2
        a[0], b[0] = half, -half
        a[40] = b[40] = np.sqrt(1 - half * half)
        rows = [(v @ turn.T).tobytes() for v in (a, b)]
        total = 0
        for block in range(embedding_dedup.BLOCKS):
            group = pa.table({
                "n": [n] * 2, "block": [block] * 2, "cell": [0] * 2, "other": [0] * 2, "i": [0] * 2, "j": [0] * 2,
                "raw": rows, "node": [b"a", b"b"], "copies": [1, 1], "right": [False] * 2,
            })
            found = embedding_dedup._joined(group, 0.9)
            total += sum(k for k in found["links"].to_pylist() if k is not None)
        assert total == 2


# Substrings


def test_repeated_passages(docs, empty):
    found = {r["doc_id"]: r for r in substring_dedup.remove_repeated(docs).collect()}
    assert found[1]["n_removed"] == 0 and found[1]["kept_text"] == LONG
    assert found[2]["n_removed"] == 400 and found[2]["kept_text"] == ""
    assert found[3]["kept_text"] == "changed" and found[7]["kept_text"] == "begin end"
    assert found[4]["n_words_"] == 0 and found[4]["kept_text"] == "" and found[8]["n_removed"] == 0
    assert substring_dedup.remove_repeated(empty).count() == 0


def test_repeated_passages_against_all_windows(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(120):
        words = [str(w) for w in rng.integers(0, 10**6, 60)]
        if rows and i % 2:
            other = rows[rng.integers(len(rows))][1].split()
            begin, size = rng.integers(0, 40), rng.integers(10, 25)
            words[rng.integers(0, 40) :] = other[begin : begin + size]
        rows.append((int(rng.integers(0, 100)), "\t ".join(words)))
    windows = defaultdict(set)
    texts = [(i, re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in rows]
    for i, words in texts:
        for p in range(len(words) - 12):
            windows[tuple(words[p : p + 13])].add(i)
    expected = []
    for i, words in texts:
        gone = {q for p in range(len(words) - 12) if min(windows[tuple(words[p : p + 13])]) < i for q in range(p, p + 13)}
        expected.append((i, len(gone), " ".join(w for q, w in enumerate(words) if q not in gone)))
    got = substring_dedup.remove_repeated(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    assert by_id(got, "n_removed", "kept_text") == sorted(expected, key=repr)


# Classes, queries, pipeline


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(50, 51), (52, 51), (60, 60)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(31)} | {50: 50, 51: 50, 52: 50}


@pytest.mark.parametrize("name", queries.ORACLE)
def test_query_matches_sql(spark, name):
    with connect(SMALLEST) as duck:
        result = queries.QUERIES[name](spark, SMALLEST)
        assert type_differences(result, duck, queries.ORACLE[name]) == []
        found, expected = spark_table(result), duck_table(duck, queries.ORACLE[name])
    assert found[0] == expected[0] and found[1] == expected[1] and found[1]


@pytest.mark.parametrize("name", set(queries.QUERIES) - set(queries.ORACLE))
def test_query_covers_its_table(spark, name):
    result = queries.QUERIES[name](spark, SMALLEST)
    if "piece" in result.columns:
        result = result.where("piece = 0")
    ids = [r["doc_id"] for r in result.select("doc_id").collect()]
    expected = spark.read.parquet(f"{SMALLEST}/documents.parquet").select("doc_id").collect()
    assert sorted(ids) == sorted(r[0] for r in expected)


def test_pipeline_stages(spark, docs):
    kept = docs
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, SMALLEST)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert kept.columns == docs.columns
        seen[name] = Counter(r[0] for r in kept.select("doc_id").collect())
    assert seen["language_id"] == Counter([1, 2, 3, 7, 8, 8, None, 9])
    assert seen["near_dedup"] == Counter([1, 7, 8, None, 9])
    assert seen["substring_dedup"] == seen["decontaminate"] == seen["sentencepiece"] == seen["near_dedup"]
    assert kept.where("NOT same").count() == 0


def test_pipeline_runs(spark):
    assert 0 < corpus_pipeline.run(spark, SMALLEST).count() < 200
