"""Spelling variants of words by permuterm rotations.

A word is marked with a terminator and turned to all its rotations. Words that differ by
one replaced code point have rotations that differ in their last place only, and the
whole rotation of a word with one code point less is just what stands before that place. So
all rotations are sorted, ``key`` being all but the last place: a group of equal keys is a
prefix range that holds words of one length and at most one shorter word. A group has no
more members than there are code points to a place, so its size doesn't grow with the
input.

Of a group each member learns how many neighbours it has there and the best of them;
pairs are not emitted. Each pair of words meets once: a deletion from a run of equal code
points counts at the first one only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark.sources.storage import written

#: What a run of letters is, and which letters lose their case.
LETTERS = "A-Za-zÀ-ÿ"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Of a run in a document, one in so many (by checksum) loses a code point.
CUT_ONE_IN = 31
SHORTEST = 7
LEAST_COUNT = 2
#: A form has at least so many times the occurrences of its variant.
FORM_RATIO = 10

TERMINATOR = "$"


def word_counts(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", cut_one_in: int = CUT_ONE_IN,
    shortest: int = SHORTEST, least: int = LEAST_COUNT,
) -> DataFrame:
    """``word`` and ``n``, the words of at least ``shortest`` code points that occur ``least`` times."""
    lowered = F.translate(text_column, UPPER, UPPER.lower())
    # A run is matched whole; shorter ones have no word even if nothing is cut.
    runs = F.regexp_extract_all(lowered, F.lit(f"([{LETTERS}]{{{shortest},}})"), F.lit(1))
    found = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    size = F.length("run")
    place = (F.col("h") % size).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, size))
    words = found.withColumn("h", h).select(
        F.when(F.col("h") % cut_one_in == 0, cut).otherwise(F.col("run")).alias("word")
    )
    return words.where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def rotations(words: DataFrame) -> DataFrame:
    """``key``, ``last`` (one code point or none), ``n`` and ``first`` for each rotation of each word.

    A rotation with a last place stands for the word without that place; ``first`` tells
    that its code point doesn't repeat the one before. A rotation without one is whole.
    """
    word, i = F.col("word"), F.col("i")
    size = F.length(word)
    at = F.substring(word, i + 1, F.lit(1))
    behind, ahead = F.substring(word, i + 1, size), F.substring(word, F.lit(1), i)
    whole = F.struct(
        F.concat(behind, F.lit(TERMINATOR), ahead).alias("key"), F.lit("").alias("last"), F.lit(True).alias("first")
    )
    beyond = F.substring(word, i + 2, size)
    open_place = F.struct(
        F.concat(beyond, F.lit(TERMINATOR), ahead).alias("key"), at.alias("last"),
        ((i == 0) | (F.substring(word, i, F.lit(1)) != at)).alias("first"),
    )
    turned = words.select("word", "n", F.explode(F.sequence(F.lit(0), size)).alias("i"))
    both = F.when(i < size, F.array(whole, open_place)).otherwise(F.array(whole))
    return turned.select("n", F.explode(both).alias("turn")).select("turn.*", "n")


def word_of(key: Column, last: Column) -> Column:
    """The word of a rotation: what follows the terminator, the last place and the rest, in order."""
    return F.concat(F.substring_index(key, TERMINATOR, -1), last, F.substring_index(key, TERMINATOR, 1))


def neighbours(words: DataFrame) -> DataFrame:
    """``word``, ``n_near`` and ``best`` (``minus``, ``word``) for the words of ``words`` that have a near word.

    ``minus`` is the count below zero, so the least struct has the largest count and, among
    equals, the smallest word.
    """
    turned = rotations(words).repartitionByRange("key").sortWithinPartitions("key", "last")
    member = F.struct((-F.col("n")).alias("minus"), word_of(F.col("key"), F.col("last")).alias("word"), F.col("last") == "", "first")
    member = member.cast("struct<minus:bigint,word:string,whole:boolean,first:boolean>")
    groups = (
        turned.groupBy("key").agg(F.array_sort(F.collect_list(member)).alias("members")).where(F.size("members") > 1)
    )
    same = F.filter("members", lambda m: ~m["whole"])
    firsts = F.filter("members", lambda m: ~m["whole"] & m["first"])
    shorter = F.filter("members", lambda m: m["whole"])
    groups = groups.select("members", same.alias("same"), firsts.alias("firsts"), shorter.alias("shorter"))

    def name(member: Column) -> Column:
        return F.struct(member["minus"].alias("minus"), member["word"].alias("word"))

    def seen(m: Column) -> Column:
        other = F.when(F.col("same")[0]["word"] == m["word"], F.get("same", F.lit(1))).otherwise(F.col("same")[0])
        less = F.when(m["first"], F.get("shorter", F.lit(0)))
        n_less = F.when(m["first"], F.size("shorter")).otherwise(0)
        best = F.when(m["whole"], name(F.get("firsts", F.lit(0)))).otherwise(_least(other, less, name))
        n_near = F.when(m["whole"], F.size("firsts")).otherwise(F.size("same") - 1 + n_less)
        return F.struct(m["word"].alias("word"), n_near.cast("long").alias("n_near"), best.alias("best"))

    each = groups.select(F.explode(F.transform("members", seen)).alias("found")).select("found.*").where("n_near > 0")
    return each.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def _least(a: Column, b: Column, name) -> Column:
    """The lesser of two structs of which either may be null."""
    return F.when(b.isNull(), F.when(a.isNotNull(), name(a))).when(a.isNull(), name(b)).otherwise(
        F.least(name(a), name(b))
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` for every row of ``forms`` (``word``, ``form``): the end of the chain of forms.

    Each round doubles the steps taken. Counts rise along a chain by ``FORM_RATIO``, so it
    has fewer steps than the largest count has digits.
    """
    at = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = at.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        at = written(stepped, "roots")
        if at.where("moved").isEmpty():
            return at.select("word", "root")
        at = at.select("word", "root")


def spelling_variants(words: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for the distinct words of ``words`` (``word``, ``n``).

    Two words are near if they differ by one inserted, deleted or replaced code point. The
    form is the near word of the largest count, the smallest of several, if it has
    ``ratio`` times the word's count, else null; ``root`` is the last form on the way, the word itself
    without one. A word must not hold the terminator ``$``; the empty word counts as a
    word. Long words cost the square of their length. No words give no rows.
    """
    words = written(words.select("word", "n"), "words")
    near = neighbours(words)
    is_form = -F.col("best.minus") >= F.col("n") * ratio
    found = words.join(near, "word", "left").select(
        "word",
        F.when(is_form, F.col("best.word")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, -F.col("best.minus")).alias("form_n"),
    )
    found = written(found, "forms")
    ends = roots(found.where("form IS NOT NULL").select("word", "form"))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def variants_of(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The spelling variants among the words of ``docs``.

    Words are runs of letters of whole texts, A to Z in lower case, of which one in
    ``CUT_ONE_IN`` per document loses a code point by checksum. Null text has no words, a null id counts
    as empty text, rows that repeat count again, other columns are not read. Very long texts are read
    whole. No rows give no rows.
    """
    return spelling_variants(word_counts(docs, id_column, text_column))
