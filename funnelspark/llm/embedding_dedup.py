"""Links between embeddings by a subspace pigeonhole join.

Unit vectors of cosine c are ``2 - 2c`` apart in squared distance. After a random rotation
the coordinates are split into blocks; if two vectors are within that distance, then in at
least one block they are within the block's share of it, in proportion to its dimensions.
Each block is joined by range along its first coordinate: vectors further apart there than
the share's root are not compared. What is near in a block, found in single precision with room for
its rounding, has its cosine verified in double precision at once.

Distinct vectors lie once in files of bounded size that all tasks can open. A task is handed names of
files, never vectors, and reads two files at a time, so what is stored and shuffled grows with the vectors
and not with the tiles they are compared in.

A pair is counted in its first block whose distance, summed in a fixed order from the
vectors alone, is within the share; the slack only widens the search. Tiles return a count for each vector
and one edge to the smallest vector of its linked group in the tile, never pairs. Equal
vectors are joined as one and counted by their number.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from funnelspark.llm.common import components
from funnelspark.sources.rolling import opened
from funnelspark.sources.storage import new_folder, written

COSINE = 0.9
BLOCKS = 4
#: Vectors in one side of a tile, and their numbers, so that longer vectors make smaller tiles.
TILE = 4096
TILE_NUMBERS = 1 << 22
#: Tiles of a task, at least, and tasks at most.
TILES = 4
TASKS = 20_000
#: Vectors compared at once with those in their range.
RUN = 128
#: Numbers gathered at once when pairs are verified.
GATHERED = 1 << 22
#: Added to squared distances and cells, against rounding: candidates are verified exactly.
_SLACK = 1e-6


def rotation(n: int) -> np.ndarray:
    """A fixed random rotation of n dimensions."""
    q, r = np.linalg.qr(np.random.default_rng(n).standard_normal((n, n)))
    return q * np.sign(np.diag(r))


def _cuts(n: int) -> list[tuple[int, int]]:
    edges = np.linspace(0, n, min(BLOCKS, n) + 1).astype(int).tolist()
    return list(zip(edges, edges[1:], strict=False))


def _budget(cosine: float, n: int, cut: tuple[int, int]) -> float:
    return (2 - 2 * cosine) * (cut[1] - cut[0]) / n + _SLACK


def links(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", cosine: float = COSINE,
    tile: int = TILE,
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept``: one row per row of ``vectors``.

    Two rows are linked if their vectors have equal length and a cosine of at least
    ``cosine``, which must be below 1. Null, empty and zero vectors and those with null or
    non-finite components link with nothing. Rows with equal vectors are linked, with
    equal ids too. ``component_id`` is the smallest id that links reach; null ids are
    passed over, and an unlinked row has its own.
    """

    kind = vectors.schema[vector_column].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    # Floats are stored as they are: as doubles they would be no more exact and twice as long.
    stored = np.dtype(np.float32 if single else np.float64)

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column("vector").cast(pa.list_(pa.from_numpy_dtype(stored)))
            values = given.values.to_numpy(zero_copy_only=False)
            edges, valid = given.offsets.to_numpy(), given.is_valid().to_numpy(zero_copy_only=False)
            sizes = np.where(valid, np.diff(edges), 0)
            raw: list[bytes | None] = [None] * batch.num_rows
            for n in np.unique(sizes[sizes > 0]):
                at = np.flatnonzero(sizes == n)
                rows = values[edges[at][:, None] + np.arange(n)]
                good = np.isfinite(rows).all(1)
                scale = np.abs(np.where(np.isfinite(rows), rows, 0)).max(1)
                good &= scale > 0
                for i, row in zip(at[good], rows[good] + stored.type(0), strict=True):
                    raw[i] = row.tobytes()
            yield pa.record_batch([batch.column("id"), pa.array(raw, pa.binary())], ["id", "raw"])

    spark = vectors.sparkSession
    id_type = vectors.schema[id_column].dataType.simpleString()
    given = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("vector"))
    rows = given.mapInArrow(prepare, f"id {id_type}, raw binary")
    rows = rows.withColumn("node", F.when(F.col("raw").isNotNull(), F.unhex(F.sha2("raw", 256))))
    size = (F.octet_length("raw") / stored.itemsize).cast("int").alias("n")
    nodes = rows.where("raw IS NOT NULL").groupBy(size, "node").agg(
        F.any_value("raw").alias("raw"), F.count("*").alias("copies"), F.min("id").alias("least")
    )
    folder = new_folder(spark, "vectors")
    # Vectors go into the files; their table has all else, and a row names the file of its vector.
    placed = nodes.sortWithinPartitions("n").mapInArrow(
        lambda batches: _stored(batches, folder, tile), f"node binary, n int, copies long, least {id_type}, file string"
    )
    nodes = written(placed, "nodes")
    # A row for each file, which holds a tile's side of one length of vectors.
    files = nodes.groupBy("n", "file").count().orderBy("n", "file").collect()
    panels = _panels([(f.n, f.file, f["count"]) for f in files], tile)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, i, first, last in zip(*(batch.column(c).to_pylist() for c in ("n", "i", "first", "last"))):
                yield from _row_of_tiles(folder, panels[n], i, range(first, last), stored, cosine)

    units = _units({n: len(names) for n, names in panels.items()})
    work = spark.createDataFrame(units, "n int, i int, first int, last int").repartition(max(1, min(len(units), TASKS)))
    # b is null in the rows that count, and links is null in the rows that connect.
    found = written(work.mapInArrow(joined, "a binary, b binary, links long"), "found")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    roots = components(found.where("b IS NOT NULL").select("a", "b"))
    known = (
        nodes.select("node", "copies", "least").join(counts, "node", "left").join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    smallest = known.groupBy("root").agg(F.min("least").alias("component"))
    known = known.join(smallest, "root").select("node", "copies", "links", "component")
    # The vectors are read again, which is less than to keep them with their ids.
    result = rows.select("id", "node").join(known, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component"))
    return result.select(
        F.col("id").alias(id_column),
        F.coalesce(F.coalesce("links", F.lit(0)) + F.col("copies") - 1, F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )


def _rows_of_a_side(n: int, tile: int) -> int:
    return max(1, min(tile, TILE_NUMBERS // n))


def _stored(batches: Iterator[pa.RecordBatch], folder: str, tile: int) -> Iterator[pa.RecordBatch]:
    """Write the vectors, sorted by length, to files of a tile's side; the other columns with the file's name.

    A repeated task writes files of its own, and only those that its rows name are read.
    """
    system, root = opened(folder)
    system.create_dir(root, recursive=True)
    kept: list[pa.Table] = []
    attempt = f"{TaskContext.get().taskAttemptId():08d}-{uuid4().hex}"
    done = 0

    def close() -> pa.RecordBatch:
        nonlocal done
        rows = pa.concat_tables(kept).combine_chunks()
        kept.clear()
        name = f"{attempt}-{done:06d}.arrow"
        done += 1
        side = rows.select(["node", "raw", "copies"])
        with system.open_output_stream(f"{root}/{name}") as out, pa.ipc.new_file(out, side.schema) as file:
            file.write_table(side)
        table = rows.drop_columns(["raw"]).append_column("file", pa.array([name] * len(rows), pa.string()))
        return table.select(["node", "n", "copies", "least", "file"]).to_batches()[0]

    for batch in batches:
        given = pa.Table.from_batches([batch])
        lengths = given["n"].to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(lengths)) + 1).tolist(), len(lengths)]
        for first, last in zip(edges, edges[1:]):
            while first < last:
                n = int(lengths[first])
                if kept and kept[0]["n"][0].as_py() != n:
                    yield close()
                take = min(last - first, _rows_of_a_side(n, tile) - sum(map(len, kept)))
                kept.append(given.slice(first, take))
                first += take
                if sum(map(len, kept)) == _rows_of_a_side(n, tile):
                    yield close()
    if kept:
        yield close()


def _panels(files: Iterable[tuple[int, str, int]], tile: int) -> dict[int, list[list[str]]]:
    """For each length of vectors the sides of its tiles: files that hold about ``tile`` vectors together."""
    panels: dict[int, list[list[str]]] = {}
    held: dict[int, int] = {}
    for n, name, count in files:
        sides = panels.setdefault(n, [])
        if not sides or held[n] + count > _rows_of_a_side(n, tile):
            sides.append([])
            held[n] = 0
        sides[-1].append(name)
        held[n] += count
    return panels


def _offsets(sides: int, i: int) -> int:
    """How many sides, from ``i`` on and around, ``i`` is compared with, so that any two meet once."""
    return sides // 2 + (sides % 2 == 1 or i < sides // 2)


def _units(sides: dict[int, int]) -> list[tuple[int, int, int, int]]:
    """Runs of tiles that share their left side: its number, and from which to which side, counted from it."""
    each = max(TILES, -(-sum(m * (m // 2 + 1) for m in sides.values()) // TASKS))
    return [
        (n, i, first, min(first + each, _offsets(m, i)))
        for n, m in sides.items() for i in range(m) for first in range(0, _offsets(m, i), each)
    ]


@dataclass(frozen=True)
class _Side:
    """Vectors of a tile: their names, unit vectors, number of copies, and the rotated coordinates."""

    names: np.ndarray
    exact: np.ndarray
    copies: np.ndarray
    turned: np.ndarray

    @classmethod
    def of(cls, rows: pa.Table, stored: np.dtype, n: int) -> _Side:
        raw = np.frombuffer(b"".join(rows["raw"].to_pylist()), stored).reshape(-1, n)
        exact = unit(raw.astype(np.float64))
        names = np.array([*rows["node"].to_pylist(), None], object)[:-1]
        return cls(names, exact, rows["copies"].to_numpy(), exact @ rotation(n))


def _row_of_tiles(
    folder: str, sides: list[list[str]], i: int, offsets: Iterable[int], stored: np.dtype, cosine: float
) -> Iterator[pa.RecordBatch]:
    """Links of side ``i`` with the sides that many further on, itself with an offset of 0."""
    system, root = opened(folder)

    def side(number: int) -> pa.Table:
        def read(name: str) -> pa.Table:
            with system.open_input_file(f"{root}/{name}") as file:
                return pa.ipc.open_file(file).read_all()

        return pa.concat_tables([read(name) for name in sides[number]])

    rows = side(i)
    n = len(rows["raw"][0].as_py()) // stored.itemsize
    left = _Side.of(rows, stored, n)
    blocks = range(len(_cuts(n)))
    totals = np.zeros(len(left.names), np.int64)
    for offset in offsets:
        right = _Side.of(side((i + offset) % len(sides)), stored, n) if offset else None
        counts, root_of, names = _tile(left, right, blocks, cosine)
        totals += counts[: len(totals)]
        counts[: len(totals)] = 0
        yield _found(names, counts, root_of)
    yield _found(left.names, totals, np.arange(len(totals)))


def _found(names: np.ndarray, counts: np.ndarray, root: np.ndarray) -> pa.RecordBatch:
    """Rows that count and rows that connect."""
    some, edges = np.flatnonzero(counts), np.flatnonzero(root != np.arange(len(root)))
    return pa.record_batch(
        {
            "a": pa.array([*names[some], *names[edges]], pa.binary()),
            "b": pa.array([*[None] * len(some), *names[root[edges]]], pa.binary()),
            "links": pa.array([*counts[some].tolist(), *[None] * len(edges)], pa.int64()),
        }
    )


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by the largest component first, so nothing overflows."""
    rows = rows / np.abs(rows).max(1)[:, None]
    return rows / np.sqrt((rows * rows).sum(1))[:, None]


def _owners(exact: np.ndarray, x: np.ndarray, y: np.ndarray, cosine: float) -> np.ndarray:
    """The block that counts each pair of vectors, the same in every tile.

    Sums run element by element, so they depend on the pair alone. If rounding puts a
    pair beyond the share of every block, the relatively nearest one counts it.
    """
    n = exact.shape[1]
    cuts = _cuts(n)
    some, places = np.unique(np.concatenate([x, y]), return_inverse=True)
    x, y = places[: len(x)], places[len(x) :]
    turned = _turned(exact[some]).T.copy()
    ratios = np.zeros((len(cuts), len(x)))
    for block, cut in enumerate(cuts):
        for k in range(*cut):
            gap = turned[k, x] - turned[k, y]
            ratios[block] += gap * gap
        ratios[block] /= _budget(cosine, n, cut) - _SLACK
    return np.where((ratios <= 1).any(0), (ratios <= 1).argmax(0), ratios.argmin(0))


def _turned(exact: np.ndarray) -> np.ndarray:
    """Unit vectors turned element by element: no row's result depends on the others."""
    matrix = rotation(exact.shape[1])
    out = np.zeros_like(exact)
    for k, row in enumerate(matrix):
        out += exact[:, k : k + 1] * row
    return out


def _near(left: np.ndarray, right: np.ndarray, budget: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of rows of both whose squared distance may be within ``budget``, in runs.

    Sorted by their first coordinates, so that a run of ``left`` meets only what is in its range. One
    product in single precision makes the distances; ``budget`` is widened by more than its rounding.
    """
    budget += 1e-6 * (left.shape[1] + 16)
    reach = np.sqrt(budget)
    in_left, in_right = left[:, 0].argsort(), right[:, 0].argsort()
    left, right = left[in_left], right[in_right]
    # (-2x, |x|^2, 1) by (y, 1, |y|^2) is the distance.
    squares, ones = (left * left).sum(1)[:, None], np.ones((len(left), 1))
    wide = np.hstack([-2 * left, squares, ones]).astype(np.float32)
    squares, ones = (right * right).sum(1)[:, None], np.ones((len(right), 1))
    high = np.hstack([right, ones, squares]).astype(np.float32)
    limit = np.float32(budget)
    for begin in range(0, len(left), RUN):
        end = min(begin + RUN, len(left))
        first = np.searchsorted(right[:, 0], left[begin, 0] - reach, "left")
        last = np.searchsorted(right[:, 0], left[end - 1, 0] + reach, "right")
        if first >= last:
            continue
        near = np.flatnonzero(wide[begin:end] @ high[first:last].T <= limit)
        if len(near):
            yield in_left[begin + near // (last - first)], in_right[first + near % (last - first)]


def _tile(
    left: _Side, right: _Side | None, blocks: Iterable[int], cosine: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links that ``blocks`` count between two sides, or within the left one.

    A number for each vector and the smallest vector of its linked group, by their places in the names.
    """
    inside, n = right is None, left.exact.shape[1]
    other = left if inside else right
    shift = 0 if inside else len(left.names)
    exact, names, copies = (
        getattr(left, name) if inside else np.concatenate([getattr(left, name), getattr(right, name)])
        for name in ("exact", "names", "copies")
    )
    counts = np.zeros(len(names), np.int64)
    pairs_a, pairs_b = [], []
    run = max(1, GATHERED // n)
    for block in blocks:
        cut = _cuts(n)[block]
        budget = _budget(cosine, n, cut)
        for near_x, near_y in _near(left.turned[:, slice(*cut)], other.turned[:, slice(*cut)], budget):
            near_y = near_y + shift
            if inside:
                near_x, near_y = near_x[near_x < near_y], near_y[near_x < near_y]
            # Dense groups have very many pairs near; their vectors are gathered in runs.
            for first in range(0, len(near_x), run):
                x, y = near_x[first : first + run], near_y[first : first + run]
                linked = (exact[x] * exact[y]).sum(1) >= cosine
                x, y = x[linked], y[linked]
                if not len(x):
                    continue
                mine = _owners(exact, x, y, cosine) == block
                x, y = x[mine], y[mine]
                np.add.at(counts, x, copies[y])
                np.add.at(counts, y, copies[x])
                pairs_a.append(x.astype(np.int32))
                pairs_b.append(y.astype(np.int32))
    x, y = (np.concatenate(p) if p else np.zeros(0, int) for p in (pairs_a, pairs_b))
    root = np.arange(len(names))
    while True:
        lower = root.copy()
        np.minimum.at(lower, x, root[y])
        np.minimum.at(lower, y, root[x])
        lower = lower[lower]
        if (lower == root).all():
            break
        root = lower
    return counts, root, names


def _joined(group: pa.Table, cosine: float) -> pa.Table:
    """The links that one block counts in a tile of doubles given as a table.

    It is within one side if its numbers and cells are equal; otherwise ``right`` tells the sides apart.
    """
    n, block = group["n"][0].as_py(), group["block"][0].as_py()
    inside = group["cell"][0].as_py() == group["other"][0].as_py() and group["i"][0].as_py() == group["j"][0].as_py()
    side = np.dtype(np.float64)
    right = group["right"]
    left, other = (group, None) if inside else (group.filter(pc.invert(right)), group.filter(right))
    if other is not None and not (len(left) and len(other)):
        return pa.table({"a": pa.array([], pa.binary()), "b": pa.array([], pa.binary()), "links": pa.array([], pa.int64())})
    counts, root, names = _tile(
        _Side.of(left, side, n), None if other is None else _Side.of(other, side, n), [block], cosine
    )
    return pa.Table.from_batches([_found(names, counts, root)])
