"""Near-duplicate documents by order MinHash.

The k-mers of a document are its 5-word shingles, each labelled with its occurrence
number. A sketch is the 5 k-mers with the smallest hashes, in text order; documents that
agree in one of 30 sketches are candidates. Agreement needs the same order, so moved
paragraphs count as different. A candidate pair is verified by banded alignment: with D
shingles inserted or deleted between the two sequences, the similarity is
``(a + b - D) / (a + b + D)``, and 0.8 or more means a near duplicate.

Near duplicates share at least 0.8 of the k-mers of each. So of texts with up to ``EXACT``
k-mers, the rarest are keys as well, one more than a near duplicate can lack: a
pair whose shorter text has up to 20 is always a candidate. Without repeated shingles, a
longer pair misses all sketches with probability 2.5e-5 at most (27 and 27 k-mers, 24 in
common), near 7e-6 at 0.8 between long texts.

Pairs of a bucket are not all emitted: a few of its members are compared with the others,
linked ones become classes, and members of different classes that still share a
bucket meet again only by their rare k-mers (``_linked_classes``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from funnelspark.llm.common import PLAIN, Words, components, free_name, lower, mix, slices, text_digest, utf8
from funnelspark.sources.storage import written

SHINGLE = 5
SAMPLED = 5
SKETCHES = 30
SIMILARITY = 0.8
#: Texts with up to so many shingles find each other by single shingles, without chance.
EXACT = 25
#: Members of a bucket that those of its other classes are compared with in a round.
PIVOTS = 4
#: Cells of the counts that tell common shingles from rare ones.
CELLS = 1 << 18
#: Bits that mark the texts of open buckets, and those of one page of the bitmap functions.
MARKS = 1 << 23
PAGE_BITS = 32_768

_SEEDS = mix(np.arange(1, 2 * SKETCHES + 2, dtype=np.uint64))
_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of each shingle; a shorter text is one shingle."""
    hashes, found = words.runs(SHINGLE)
    for n in range(1, SHINGLE):
        short = (words.counts[words.text] == n) & (words.place == 0)
        if short.any():
            hashes = np.where(short, words.runs(n)[0], hashes)
            found = found | short
    return words.text[found], hashes[found]


def labelled(doc: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Hashes of shingles and their occurrence number within their text."""
    order = np.lexsort((grams, doc))
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (grams[order][1:] != grams[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    begin = np.flatnonzero(fresh)
    nth = np.zeros(len(doc), np.uint64)
    nth[order] = np.arange(len(doc)) - begin[np.cumsum(fresh) - 1]
    return mix(grams + nth * np.uint64(0xC2B2AE3D27D4EB4F))


def sketches(texts: pa.Array) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Text number and key of each sketch, and of all shingles of texts that have few."""
    data, offsets = utf8(texts)
    doc, grams = shingles(Words(lower(data), offsets, PLAIN))
    n = len(offsets) - 1
    counts = np.bincount(doc, minlength=n)
    grams = labelled(doc, grams)
    few = np.flatnonzero(counts[doc] <= EXACT)
    singles = doc[few], mix(grams[few] ^ _SEEDS[-1])
    owners, keys = [doc[:0]], [grams[:0]]
    # Shorter texts have no near duplicate beyond EXACT.
    many = counts > int(EXACT * SIMILARITY + 1e-9)
    doc, grams = doc[many[doc]], grams[many[doc]]
    # About four times the sample lies below this bound; only those are ranked.
    share = np.minimum(1.0, 4 * SAMPLED / np.maximum(counts, 1))
    bound = np.where(share < 1, (share * 2.0**63).astype(np.uint64) * np.uint64(2), _MOST)[doc]
    needed = np.where(many, SAMPLED, 0)
    for j in range(SKETCHES if len(doc) else 0):
        values = mix(grams ^ _SEEDS[j])
        low = values <= bound
        lacking = np.bincount(doc[low], minlength=n) < needed
        if lacking.any():
            low |= lacking[doc]
        low = np.flatnonzero(low)
        low = low[np.lexsort((values[low], doc[low]))]
        chosen = np.sort(low[_rank(doc[low]) < SAMPLED])
        owner = doc[chosen]
        place = _rank(owner).astype(np.uint64)
        parts = mix(grams[chosen] + (place + np.uint64(1)) * np.uint64(0x9FB21C651E98DF25))
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        owners.append(owner[starts])
        keys.append(mix(np.add.reduceat(parts, starts) ^ _SEEDS[SKETCHES + j]))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return (owner[order], np.concatenate(keys)[order]), singles


def _lists(owner: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
    """A list of 64-bit values for each of n owners."""
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.view(np.int64)))


def _rank(groups: np.ndarray) -> np.ndarray:
    """The place of each element within its stretch of equal values."""
    starts = np.flatnonzero(np.diff(groups, prepend=-1))
    return np.arange(len(groups)) - np.repeat(starts, np.diff(starts, append=len(groups)))


def band(n: int, m: int, threshold: float = SIMILARITY) -> int:
    """The insertions and deletions that leave two sequences of n and m shingles similar."""
    return int((n + m) * (1 - threshold) / (1 + threshold) + 1e-9)


def common(a: np.ndarray, b: np.ndarray) -> int:
    """How many shingles two sequences share in any order, repeats counted."""
    both = np.intersect1d(a, b)
    sides = [np.searchsorted(x, both, "right") - np.searchsorted(x, both, "left") for x in (np.sort(a), np.sort(b))]
    return int(np.minimum(*sides).sum())


def similar(a: np.ndarray, b: np.ndarray, threshold: float = SIMILARITY) -> bool:
    """Whether two shingle sequences reach ``threshold``.

    The furthest reach on each diagonal is followed for 0, 1, 2, ... insertions and
    deletions, within the band that the threshold allows.
    """
    n, m = len(a), len(b)
    if not n or not m:
        return False
    most = band(n, m, threshold)
    if abs(n - m) > most or n + m - 2 * common(a, b) > most:
        return False
    a, b = a.tolist(), b.tolist()
    reach = {1: 0}
    for d in range(most + 1):
        for k in range(-d, d + 1, 2):
            down = k == -d or k != d and reach[k - 1] < reach[k + 1]
            x = reach[k + 1] if down else reach[k - 1] + 1
            y = x - k
            while x + 64 <= n and a[x : x + 64] == b[y : y + 64]:
                x, y = x + 64, y + 64
            while x < n and y < m and a[x] == b[y]:
                x, y = x + 1, y + 1
            reach[k] = x
            if x >= n and y >= m:
                return True
    return False


def _beside(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs`` (``a``, ``b``) with the shingles of both, ``left`` and ``right``."""
    return pairs.join(texts.select(F.col("digest").alias("b"), F.col("shingles").alias("right")), "b").join(
        texts.select(F.col("digest").alias("a"), F.col("shingles").alias("left")), "a"
    )


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The classes ``root_a`` and ``root_b`` of those pairs that are near duplicates."""

    def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            good = [similar(a, b) for a, b in zip(frame["left"], frame["right"], strict=True)]
            yield frame.loc[good, ["root_a", "root_b"]]

    found = _beside(pairs, texts).select("left", "right", "root_a", "root_b")
    return found.mapInPandas(check, "root_a binary, root_b binary").distinct()


def _members(bands: DataFrame) -> DataFrame:
    """``key``, ``digest`` and how ``central`` the text is, for keys that several texts have."""
    several = bands.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    shared = written(bands.join(several, "key"), "shared")
    central = shared.groupBy("digest").agg(F.sum("size").alias("central"))
    return written(shared.select(*[c for c in shared.columns if c != "size"]).join(central, "digest"), "members")


def _merged(roots: DataFrame, pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``roots`` after the classes of those ``pairs`` that are near duplicates became one."""
    links = written(_verified(pairs, texts), "links")
    higher = components(links.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
    higher = higher.select(F.col("node").alias("root"), F.col("root").alias("higher"))
    return written(
        roots.join(higher, "root", "left").select("node", F.coalesce("higher", "root").alias("root")), "classes"
    )


def _opened(members: DataFrame, roots: DataFrame) -> tuple[DataFrame, float]:
    """The members of buckets with several classes, and the number of pairs of those classes, about."""
    now = members.join(roots.withColumnRenamed("node", "digest"), "digest")
    rank = F.struct("central", "digest", "root")
    sizes = now.groupBy("key", "root").agg(F.count("*").alias("n"), F.max(rank).alias("top"))
    keys = (
        sizes.groupBy("key")
        .agg(
            F.count("*").alias("classes"),
            F.max("top").alias("top"),
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.col("n")).alias("same"),
        )
        .where("classes > 1")
        .select("key", F.col("top.root").alias("low"), "n", "same")
    )
    rows = written(now.join(keys, "key"), "open")
    return rows, rows.agg(F.sum(F.expr("(n * n - same) / n"))).first()[0] or 0


def _rounds(members: DataFrame, roots: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The classes after comparing central members, and the buckets left open.

    In each round a bucket's most central members, those whose own buckets are largest,
    are compared with the members of its other classes. Rounds go on while they cut the
    number of pairs of different classes in a bucket by a fifth.
    """
    rows, pairs = _opened(members, roots)
    while pairs:
        nth = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("central"), F.desc("digest")))
        pivots = rows.where("root = low").withColumn("nth", nth).where(F.col("nth") <= PIVOTS)
        pivots = pivots.select("key", F.col("digest").alias("a"), F.col("root").alias("root_a"))
        others = rows.where("root != low").select("key", F.col("digest").alias("b"), F.col("root").alias("root_b"))
        roots = _merged(roots, pivots.join(others, "key").drop("key").distinct(), texts)
        before = pairs
        rows, pairs = _opened(members, roots)
        if pairs > 0.8 * before:
            return roots, rows
    return roots, None


def _linked_classes(members: DataFrame, texts: DataFrame) -> DataFrame:
    """``node``, ``root``: the classes of the texts that share buckets.

    Buckets that rounds of comparisons leave open hold texts that share some common passage but are
    mostly no near duplicates. Their texts get new buckets by rare k-mers (``_prefixes``), in
    which every near duplicate among them meets, and texts with only common ones in common do not.
    """
    alone = members.select(F.col("digest").alias("node")).distinct().withColumn("root", F.col("node"))
    roots, left = _rounds(members, written(alone, "classes"), texts)
    if left is None:
        return roots
    rare = _members(_prefixes(_marked(texts, left)))
    roots, left = _rounds(rare, roots, texts)
    return roots if left is None else _merged(roots, _near_in_size(left), texts)


def _marked(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``texts`` of the digests in ``wanted``, and a few others, without a shuffle of either's texts.

    The digests set bits of a bitmap of fixed size, which is broadcast. A text that is let through
    by chance only makes candidates more.
    """
    place = F.pmod(F.xxhash64("digest"), F.lit(MARKS))
    page, bit = F.floor(place / PAGE_BITS).cast("int"), (place % PAGE_BITS).cast("int")
    pages = wanted.groupBy(page.alias("page")).agg(F.bitmap_construct_agg(bit).alias("bits"))
    near = texts.withColumns({"page": page, "bit": bit}).join(F.broadcast(pages), "page")
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.call_function("shiftright", byte, F.col("bit") % 8).bitwiseAND(1) == 1
    return near.where(is_set).select(*texts.columns)


def _prefixes(texts: DataFrame) -> DataFrame:
    """``digest``, ``key``, ``place`` and ``size_of`` the text: the rarest k-mers of each text, one more than it may lack.

    K-mers are put in one order for all texts: by the number of texts that have a shingle of the
    same cell, then by hash. Two near duplicates share at least 0.8 of the k-mers of each,
    so whatever the order, the first of those they share is among these keys of both. The
    counts of ``CELLS`` cells are all that is gathered and broadcast.
    """
    cell = F.pmod(F.col("shingle"), F.lit(CELLS)).cast("int")
    counts = texts.select(F.explode(F.array_distinct("shingles")).alias("shingle")).groupBy(cell.alias("cell")).count()
    frequent = np.zeros(CELLS, np.int64)
    for row in counts.toLocalIterator():
        frequent[row["cell"]] = row["count"]
    shared = texts.sparkSession.sparkContext.broadcast(frequent)

    def rarest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for digest, shingles in zip(frame["digest"], frame["shingles"], strict=True):
                grams = np.asarray(shingles, np.int64)
                kmers = labelled(np.zeros(len(grams), np.int64), grams.view(np.uint64))
                n = len(kmers)
                first = np.lexsort((kmers, shared.value[grams % CELLS]))[: int(n * (1 - SIMILARITY) + 1e-9) + 1]
                yield pd.DataFrame(
                    {"digest": [digest] * len(first), "key": kmers[first].view(np.int64), "place": range(len(first)), "size_of": n}
                )

    return texts.mapInPandas(rarest, "digest binary, key long, place long, size_of long")


def _near_in_size(rows: DataFrame) -> DataFrame:
    """The pairs of different classes in a bucket that can share enough k-mers.

    What a pair shares from its first common key on lies behind the key's place in both texts.
    """
    a = rows.select("key", F.col("digest").alias("a"), F.col("root").alias("root_a"), F.col("place").alias("p"), F.col("size_of").alias("n"))
    b = rows.select("key", F.col("digest").alias("b"), F.col("root").alias("root_b"), F.col("place").alias("q"), F.col("size_of").alias("m"))
    least = (F.col("n") + F.col("m")) * (SIMILARITY / (1 + SIMILARITY)) - 1e-6
    enough = (F.col("n") - F.col("p") >= least) & (F.col("m") - F.col("q") >= least)
    return a.join(b, "key").where((F.col("root_a") < F.col("root_b")) & enough).drop("key", "n", "m", "p", "q").distinct()


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``digest``, ``class_id`` and ``kept``.

    ``class_id`` is the smallest id of the class: of all texts that links of equal or
    near-duplicate texts reach. ``kept`` marks the row with that id. Case and punctuation
    do not count. Equal texts share a class, also without any word; null text is alone in
    its class (``digest`` null). A class whose ids are all null has a null ``class_id``
    and keeps every row; beside other ids a null id is not kept.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                lists = [_lists(*some, part.num_rows) for some in sketches(part.column("text"))]
                yield pa.record_batch(
                    [part.column("digest"), part.column("id"), *lists], ["digest", "id", "keys", "singles"]
                )

    named = docs.select(
        text_digest(F.col(text_column)).alias("digest"), F.col(id_column).alias("id"), F.col(text_column).alias("text")
    )
    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = utf8(part.column("text"))
                doc, grams = shingles(Words(lower(data), offsets, PLAIN))
                lists = _lists(doc, grams, part.num_rows)
                yield pa.record_batch([part.column("digest"), lists], ["digest", "shingles"])

    id_type = docs.schema[id_column].dataType.simpleString()
    rows = written(named.mapInArrow(sketch, f"digest binary, id {id_type}, keys array<long>, singles array<long>"), "sketches")

    distinct = rows.where("size(keys) > 0 OR size(singles) > 0").groupBy("digest").agg(
        F.min("id").alias("id"), F.any_value("keys").alias("keys"), F.any_value("singles").alias("singles")
    )
    lacked = F.floor(F.size("singles") * (1 - SIMILARITY) + 1e-9)
    singles = distinct.select("digest", "id", lacked.alias("lacked"), F.explode("singles").alias("key"))
    singles = written(singles, "singles")
    common_last = Window.partitionBy("digest").orderBy("texts", "key")
    rarest = (
        singles.join(singles.groupBy("key").agg(F.count("*").alias("texts")), "key")
        .withColumn("nth", F.row_number().over(common_last))
        .where("nth <= lacked + 1")
    )
    bands = distinct.select("digest", "id", F.explode("keys").alias("key")).union(rarest.select("digest", "id", "key"))
    members = _members(bands)

    reps = members.groupBy(F.col("digest").alias("d")).agg(F.min("id").alias("i"))
    texts = written(
        named.join(reps, F.col("digest").eqNullSafe(F.col("d")) & F.col("id").eqNullSafe(F.col("i")), "left_semi")
        .select("digest", "text")
        .dropDuplicates(["digest"])
        .mapInArrow(sequences, "digest binary, shingles array<long>"),
        "texts",
    )
    roots = _linked_classes(members, texts)

    # Classes meet by their distinct texts; copies join the result by their text alone.
    alone = rows.where("digest IS NOT NULL").groupBy("digest").agg(F.min("id").alias("least"))
    classed = alone.join(roots.withColumnRenamed("node", "digest"), "digest", "left")
    classed = classed.withColumn("class", F.coalesce("root", "digest"))
    least = classed.groupBy("class").agg(F.min("least").alias("least"))
    least = classed.select("digest", "class").join(least, "class").drop("class")
    class_id = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("least"))
    return rows.select("digest", "id").join(least, "digest", "left").select(
        F.col("id").alias(id_column), "digest", class_id.alias("class_id"), F.col("id").eqNullSafe(class_id).alias("kept")
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one row of each class, all columns as they are.

    Of rows with equal id and text one stays; null texts and classes without ids all stay.
    """
    d, i, nth = (free_name(docs, f"{name}_of_class") for name in ("digest", "id", "nth"))
    kept = near_duplicates(docs, id_column, text_column).where("kept")
    kept = kept.select(F.col("digest").alias(d), F.col(id_column).alias(i)).distinct()
    mark = free_name(docs, "digest_of_row")
    rows = docs.withColumn(mark, text_digest(F.col(text_column))).join(
        kept, F.col(mark).eqNullSafe(F.col(d)) & F.col(id_column).eqNullSafe(F.col(i)), "left_semi"
    )
    same = Window.partitionBy(mark, id_column).orderBy(F.lit(0))
    rows = rows.withColumn(nth, F.row_number().over(same))
    alone = F.col(id_column).isNull() | F.col(mark).isNull()
    return rows.where(alone | (F.col(nth) == 1)).select(*docs.columns)
