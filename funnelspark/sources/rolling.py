"""A sink of text lines whose tasks roll their files by size.

Every task writes its lines in the order they come and begins another file once one has reached the limit,
so nothing is shuffled or sorted and a file is over the limit by less than a line. Files
appear under their names when their task is done. Each task also lists its files; the commit
message it returns has only counts.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "rolling_lines"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path with or without a scheme, and the path in it."""
    scheme, colon, rest = path.partition(":")
    if colon and not rest.startswith("//"):
        path = f"{scheme}://{rest}"
    return fs.FileSystem.from_uri(path)


@dataclass
class TaskFiles(WriterCommitMessage):
    """What one task has written."""

    rows: int
    files: int
    bytes: int


class RollingWriter(DataSourceArrowWriter):
    """Options: ``path`` of the files, ``keys`` of the lists of files, ``name`` of a file, ``max_bytes``."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.keys, self.name = options["path"], options["keys"], options["name"]
        self.max_bytes = int(options["max_bytes"])
        for path in (self.path, self.keys):
            system, folder = opened(path)
            if overwrite and system.get_file_info(folder).type == fs.FileType.Directory:
                system.delete_dir(folder)
            system.create_dir(folder, recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> TaskFiles:
        system, folder = opened(self.path)
        context = TaskContext.get()
        task, attempt = context.partitionId(), context.taskAttemptId()
        done: list[dict] = []
        out, size, rows = None, 0, 0

        def hidden(n: int) -> str:
            # Names with a dot are no data to readers, so lost attempts do not show.
            return f"{folder}/.{self.name}_task{task:05d}_batch{n:04d}.{attempt}"

        def close() -> None:
            nonlocal out, size, rows
            out.close()
            done.append({"key": f"{self.name}_task{task:05d}_batch{len(done) + 1:04d}.json", "rows": rows, "bytes": size})
            out, size, rows = None, 0, 0

        for batch in iterator:
            lines = batch.column(0)
            ends = np.cumsum(pc.binary_length(lines).to_numpy(zero_copy_only=False))
            first = 0
            while first < len(lines):
                if out is None:
                    out = system.open_output_stream(hidden(len(done) + 1))
                before = ends[first - 1] if first else 0
                # Up to the line that reaches the limit, and that one.
                last = min(int(np.searchsorted(ends, before + self.max_bytes - size)) + 1, len(lines))
                part = lines.slice(first, last - first)
                out.write("".join(f"{line}\n" for line in part.to_pylist()).encode())
                size, rows, first = size + int(ends[last - 1] - before), rows + len(part), last
                if size >= self.max_bytes:
                    close()
        if out is not None:
            close()
        for n, file in enumerate(done, start=1):
            system.move(hidden(n), f"{folder}/{file['key']}")
        if done:
            keys, at = opened(self.keys)
            with keys.open_output_stream(f"{at}/task{task:05d}.json") as listing:
                listing.write("".join(json.dumps(file) + "\n" for file in done).encode())
        return TaskFiles(sum(f["rows"] for f in done), len(done), sum(f["bytes"] for f in done))

    def commit(self, messages: list[TaskFiles | None]) -> None:
        """Leave the totals beside the lists, as a sign that all tasks are done."""
        keys, at = opened(self.keys)
        given = [m for m in messages if m is not None]
        totals = {name: sum(getattr(m, name) for m in given) for name in ("rows", "files", "bytes")}
        with keys.open_output_stream(f"{at}/_totals.json") as out:
            out.write(json.dumps(totals).encode())

    def abort(self, messages: list[TaskFiles | None]) -> None:
        """Files of finished tasks stay; the run that is repeated replaces them."""


class RollingLines(DataSource):
    """``df.write.format("rolling_lines")`` for a frame with one column of text."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> RollingWriter:
        return RollingWriter(self.options, overwrite)


_KEYS = "key string, rows long, bytes long"


def roll_lines(lines: DataFrame, path: str, keys: str, name: str, max_bytes: int) -> DataFrame:
    """Write the only column of ``lines`` below ``path``; ``key``, ``rows``, ``bytes`` of every file.

    Whatever the two folders held is replaced. A line must have no line break. Both are paths that
    every task can open, local ones of a shared disk or those of a store.
    """
    spark = lines.sparkSession
    spark.dataSource.register(RollingLines)
    (
        lines.write.format(FORMAT).mode("overwrite")
        .options(path=path, keys=keys, name=name, max_bytes=str(max_bytes)).save()
    )
    return written_files(spark, keys)


def written_files(spark: SparkSession, keys: str) -> DataFrame:
    return spark.read.schema(_KEYS).json(keys)
