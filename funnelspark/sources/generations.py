"""Tables kept as immutable generations of buckets, switched by one small file.

A table has parts (``rows``, narrow ``keys``, ...), each split into buckets. A run writes the
buckets it replaces into new folders, ``<table>/<part>/generation=<run>/bucket=<b>``, and then one
manifest file that names the folder of every bucket. The manifest file appears by a single
rename, so a reader sees all of a run or nothing of it, and a run that is lost
anywhere before leaves the table as it was; repeating it writes folders of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.sources.storage import whole_variants

_MANIFEST = "run string, buckets int, part string, bucket int, generation string, pages int, version long"
_NO_ROWS = "generation=none/bucket=-1"
#: Manifests and their folders that ``vacuum`` leaves for readers of older versions.
KEPT_VERSIONS = 2


@dataclass(frozen=True)
class Snapshot:
    """One version of a table: the generation of each bucket of each part."""

    version: int
    run: str
    buckets: int
    pieces: Mapping[str, Mapping[int, str]]
    #: Pages of the key bitmap of each bucket.
    pages: Mapping[int, int]


class ConcurrentRun(RuntimeError):
    """Another run has committed the same version first."""


def _folder(spark: SparkSession, path: str):
    """The Hadoop file system and path of a folder."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


def _names(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """What follows ``prefix`` in the names of a folder's entries."""
    files, folder = _folder(spark, path)
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(name.removeprefix(prefix) for name in names if name.startswith(prefix))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all manifests that are left."""
    return spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")


def newest_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the newest version; of two runs that claim it, those of the first by name."""
    rows = manifest(spark, path)
    first = F.min_by("run", F.struct(-F.col("version"), F.col("run"))).alias("run")
    newest = rows.agg(F.max("version").alias("version"), first)
    return rows.join(F.broadcast(newest), ["version", "run"])


def newest(spark: SparkSession, path: str, upto: int | None = None) -> Snapshot | None:
    """The newest version, ``upto`` one if given; None before the first.

    Collects a row for each bucket of each part.
    """
    schema = _MANIFEST.removesuffix(", version long")
    versions = map(int, _names(spark, f"{path}/manifest", "version="))
    for version in sorted((v for v in versions if upto is None or v <= upto), reverse=True):
        rows = spark.read.schema(schema).parquet(f"{path}/manifest/version={version}").collect()
        if rows:
            break
    else:
        return None
    run = min(row.run for row in rows)
    rows = [row for row in rows if row.run == run]
    pieces: dict[str, dict[int, str]] = {}
    for row in rows:
        if row.part:
            pieces.setdefault(row.part, {})[row.bucket] = row.generation
    pages = {row.bucket: row.pages for row in rows if row.pages}
    return Snapshot(version, run, rows[0].buckets, pieces, pages)


def read(
    spark: SparkSession, path: str, part: str, schema: str, at: Snapshot | None, buckets: Iterable[int] | None = None
) -> DataFrame:
    """A part as of a version, with ``bucket``; only the given buckets' folders are listed."""
    pieces = dict(at.pieces.get(part, {})) if at else {}
    chosen = pieces if buckets is None else set(buckets) & set(pieces)
    folders = [f"{path}/{part}/generation={pieces[b]}/bucket={b}" for b in sorted(chosen)]
    if not folders:
        return spark.createDataFrame([], f"{schema}, bucket int")
    rows = spark.read.schema(f"{schema}, bucket int, generation string").option("basePath", f"{path}/{part}")
    return rows.parquet(*folders).drop("generation")


def changes_since(spark: SparkSession, path: str, schema: str, version: int) -> DataFrame | None:
    """What the runs after ``version`` have listed as ``changes``; None if some are no longer kept."""
    last = newest(spark, path).version
    kept = set(map(int, _names(spark, f"{path}/manifest", "version=")))
    if not kept.issuperset(range(version, last + 1)):
        return None
    found = spark.createDataFrame([], schema)
    for later in range(version + 1, last + 1):
        found = found.unionByName(read(spark, path, "changes", schema, newest(spark, path, later)).drop("bucket"))
    return found


def read_live(spark: SparkSession, path: str, part: str, schema: str) -> DataFrame:
    """A part of whatever version is newest when the frame is run.

    The manifest is joined, not resolved now, and prunes the folders to scan. ``REFRESH
    TABLE`` on a view of the frame lists the files anew.
    """
    rows = spark.read.schema(f"{schema}, bucket int, generation string").parquet(f"{path}/{part}")
    current = newest_manifest(spark, path).where(F.col("part") == part).select("bucket", "generation")
    return rows.join(F.broadcast(current), ["bucket", "generation"], "left_semi").drop("generation")


class Change:
    """One run's new version of a table."""

    def __init__(self, spark: SparkSession, path: str, before: Snapshot | None, buckets: int):
        self.spark, self.path, self.before, self.buckets = spark, path.rstrip("/"), before, buckets
        self.run = uuid4().hex
        self.pieces = {part: dict(pieces) for part, pieces in before.pieces.items()} if before else {}
        # Changes are those of one version.
        self.pieces.pop("changes", None)
        self.pages = dict(before.pages) if before else {}

    def replace(
        self, part: str, rows: DataFrame, replaced: Iterable[int] | None = None, sort_by: Sequence[str] = (),
        gather: Sequence[str] = (),
    ) -> None:
        """Put ``rows``, with their ``bucket``, in the place of some buckets, by default of all.

        A task writes a file for each of its buckets. Rows that lie in any order are shuffled by
        ``gather``, the keys or the bucket, so that few tasks share a bucket.
        """
        folder = f"{self.path}/{part}/generation={self.run}"
        rows = rows.repartition(*gather) if gather else rows
        with whole_variants(self.spark):
            (
                rows.sortWithinPartitions("bucket", *sort_by)
                .write.mode("overwrite").partitionBy("bucket").parquet(folder)
            )
        if self.before is None:
            # A folder of the usual shape, so that frames over a table without rows know its columns.
            columns = [c for c in rows.columns if c != "bucket"]
            rows.select(*columns).limit(0).write.mode("overwrite").parquet(f"{self.path}/{part}/{_NO_ROWS}")
        pieces = self.pieces.setdefault(part, {})
        for bucket in list(pieces) if replaced is None else replaced:
            pieces.pop(bucket, None)
        for name in _names(self.spark, folder, "bucket="):
            pieces[int(name)] = self.run

    def keep(self, part: str, buckets: Iterable[int]) -> None:
        """Leave these buckets of a part as they were before, whatever has been written for them."""
        before = self.before.pieces.get(part, {}) if self.before else {}
        pieces = self.pieces.setdefault(part, {})
        for bucket in buckets:
            pieces.pop(bucket, None)
            if bucket in before:
                pieces[bucket] = before[bucket]

    def written(self, part: str, schema: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """What a part will hold."""
        return read(self.spark, self.path, part, schema, self._snapshot(0), buckets)

    def _snapshot(self, version: int) -> Snapshot:
        return Snapshot(version, self.run, self.buckets, self.pieces, self.pages)

    def commit(self) -> Snapshot:
        """Switch readers to this version; raises if another run has been faster."""
        version = self.before.version + 1 if self.before else 0
        rows = [(self.run, self.buckets, "", -1, "", 0)]
        for part, pieces in self.pieces.items():
            for bucket, generation in pieces.items():
                pages = self.pages.get(bucket, 0) if part == "keys" else 0
                rows.append((self.run, self.buckets, part, bucket, generation, pages))
        schema = _MANIFEST.removesuffix(", version long")
        one_file = self.spark.createDataFrame(rows, schema).coalesce(1)
        folder = f"{self.path}/manifest/version={version}"
        one_file.write.mode("append").parquet(folder)
        if len(_names(self.spark, folder, "part-")) > 1 and newest(self.spark, self.path).run != self.run:
            raise ConcurrentRun(f"version {version} of {self.path} is that of another run")
        return self._snapshot(version)


def vacuum(spark: SparkSession, path: str, keep: int = KEPT_VERSIONS) -> int:
    """Remove manifests before the newest ``keep`` and folders that the others don't name.

    Only for a time when no run is writing the table and no reader uses an older version.
    Returns the number of folders removed.
    """
    versions = sorted(map(int, _names(spark, f"{path}/manifest", "version=")))
    if not versions:
        return 0
    kept = manifest(spark, path).where(F.col("version").isin(versions[-keep:])).collect()
    # The runs that claimed a version in vain count as kept until their version goes.
    used = {(row.part, row.bucket, row.generation) for row in kept if row.part}
    removed = 0

    def remove(folder: str) -> None:
        nonlocal removed
        files, name = _folder(spark, folder)
        files.delete(name, True)
        removed += 1

    files, folder = _folder(spark, path)
    parts = [s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory()]
    for part in sorted(set(parts) - {"manifest"}):
        for generation in _names(spark, f"{path}/{part}", "generation="):
            if f"generation={generation}" in _NO_ROWS:
                continue
            root = f"{path}/{part}/generation={generation}"
            buckets = {int(b) for b in _names(spark, root, "bucket=")}
            current = {b for p, b, g in used if (p, g) == (part, generation)}
            if not current:
                remove(root)
                continue
            for bucket in sorted(buckets - current):
                remove(f"{root}/bucket={bucket}")
    for version in versions[:-keep]:
        remove(f"{path}/manifest/version={version}")
    return removed
