"""Spelling variants against comparing all pairs of words."""

import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from funnelspark.llm import spelling


def near(a, b):
    """One insertion, deletion or replacement apart."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain(counts):
    out, forms = [], {}
    for word, n in counts.items():
        beside = [other for other in counts if near(word, other)]
        best = min(beside, key=lambda w: (-counts[w], w), default=None)
        forms[word] = best if best is not None and counts[best] >= 10 * n else None
        out.append((word, len(beside)))
    found = []
    for word, n_near in out:
        root = word
        while forms[root] is not None:
            root = forms[root]
        form = forms[word]
        found.append((word, form, root, counts[word], n_near, counts.get(form)))
    return sorted(found, key=lambda r: r[0])


def found(frame):
    assert frame.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, frame.collect()), key=lambda r: r[0])


def plain_counts(rows):
    low = str.maketrans(spelling.UPPER, spelling.UPPER.lower())
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {word: n for word, n in counts.items() if n >= 2}


def test_all_pairs_of_a_small_alphabet(spark):
    """Runs of equal letters, ties and chains of forms."""
    draw = random.Random(3)
    counts = {}
    for _ in range(500):
        word = "".join(draw.choice("abé") for _ in range(draw.randrange(2, 8)))
        counts[word] = draw.choice([1, 2, 10, 20, 100, 200, 1000, 10_000, 100_000])
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    assert found(spelling.spelling_variants(words)) == plain(counts)


def test_one_word_with_many_variants(spark):
    """A hot form: its groups stay as small as the alphabet."""
    base = "abcdefghij"
    counts = {base: 10**6}
    for i in range(len(base)):
        for x in "abcdefghijklmnopqrstuvwxyzàÿ":
            counts.setdefault(base[:i] + x + base[i + 1 :], 5)
            counts.setdefault(base[:i] + x + base[i:], 7)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert found(spelling.spelling_variants(words)) == plain(counts)
    assert spelling.rotations(words).groupBy("key").count().agg(F.max("count")).first()[0] <= 30


def test_documents(spark):
    draw = random.Random(8)
    base = ["straßen", "Weather", "weather", "WEATHERS", "wether", "ÀÉÎõü÷×ÿ", "letters", "setters", "short", "runningx"]
    rows = [
        (draw.choice([None, i]), " ".join(draw.choice(base) + draw.choice(["", ",", "1", "œ"]) for _ in range(60)))
        for i in range(80)
    ]
    rows += [(90, None), (91, ""), (92, "12 ; 中"), *rows[:10]]
    docs = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n int")
    assert found(spelling.variants_of(docs)) == plain(plain_counts(rows))


def test_very_long_text(spark):
    rows = [(1, "Weathery " * 150_000 + "weatherx " * 3 + "a" * 20_000), (2, "weathers")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(spelling.variants_of(docs)) == plain(plain_counts(rows))


def test_no_rows(spark):
    assert found(spelling.variants_of(spark.createDataFrame([], "doc_id long, text string"))) == []
    assert found(spelling.spelling_variants(spark.createDataFrame([], "word string, n long"))) == []
