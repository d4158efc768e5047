"""Documents exported in two phases: tasks stage files, the driver's commit makes them visible at once.

Below the path of an export:

    data/<export>-<attempt>/<partition>-<task attempt>.jsonl    a line per document, staged by one attempt of one task
    _commits/<number>-<export>.json                             the files that count, written last, under a name of its own

A reader takes the files that commits name and no others, so what a failed, retried or speculative task
left behind is never read, and a job that dies before its commit leaves the export as it was. An export
committed again under its name counts in its newest form only, so a job can be run again after any failure.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from tillwork.sources.mapping import map_columns
from tillwork.sources.sinks import documents

NAME = "tillwork_documents"


def _files(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path; Hadoop writes local paths as file:/x, Arrow as file:///x."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


@dataclass
class Staged(WriterCommitMessage):
    """A file of one task attempt; no file for a partition without rows."""

    file: str | None
    documents: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, export: str, replace: bool, column: int):
        self.path, self.export, self.replace, self.column = path, export, replace, column
        self.folder = f"data/{export}-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        store, root = _files(self.path)
        name, stream, count = f"{self.folder}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.jsonl", None, 0
        try:
            for batch in iterator:
                if batch.num_rows:
                    if stream is None:
                        store.create_dir(f"{root}/{self.folder}", recursive=True)
                        stream = store.open_output_stream(f"{root}/{name}")
                    stream.write(("\n".join(batch.column(self.column).to_pylist()) + "\n").encode())
                    count += batch.num_rows
        finally:
            if stream is not None:
                stream.close()
        return Staged(name if count else None, count)

    def commit(self, messages: list[Staged | None]) -> None:
        store, root = _files(self.path)
        done = [m for m in messages if m is not None and m.file is not None]
        commit = {
            "export": self.export, "replaces_all": self.replace, "documents": sum(m.documents for m in done),
            "files": sorted(m.file for m in done),
        }
        last = max((n for n, _ in _commit_names(store, root)), default=0)
        store.create_dir(f"{root}/_commits", recursive=True)
        name = f"{root}/_commits/{last + 1:012d}-{self.export}.json"
        with store.open_output_stream(f"{name}.writing") as out:
            out.write(json.dumps(commit).encode())
        store.move(f"{name}.writing", name)

    def abort(self, messages: list[Staged | None]) -> None:
        """Delete what was staged; a task that still runs may stage a file after that, which vacuum_export deletes."""
        store, root = _files(self.path)
        if store.get_file_info(f"{root}/{self.folder}").type == fs.FileType.Directory:
            store.delete_dir(f"{root}/{self.folder}")


class DocumentExport(DataSource):
    """Spark data source of that name: option path, option export (a name), the column document is what is written."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        export = self.options["export"]
        if not re.fullmatch(r"[A-Za-z0-9_.=]+", export):
            raise ValueError(f"an export's name is made of letters, digits, dots, underscores and equals signs: {export!r}")
        return _Writer(self.options["path"], export, overwrite, schema.fieldNames().index("document"))


def _commit_names(store: fs.FileSystem, root: str) -> list[tuple[int, str]]:
    found = store.get_file_info(fs.FileSelector(f"{root}/_commits", allow_not_found=True))
    return sorted((int(f.base_name.split("-")[0]), f.path) for f in found if f.base_name.endswith(".json"))


def _commits(path: str) -> list[dict]:
    """The commits that count, oldest first: the newest of each export since the last that replaced all."""
    store, root = _files(path)
    counted: dict[str, dict] = {}
    for _, name in _commit_names(store, root):
        with store.open_input_stream(name) as stream:
            commit = json.loads(stream.read()) | {"name": name}
        if commit["replaces_all"]:
            counted.clear()
        counted.pop(commit["export"], None)
        counted[commit["export"]] = commit
    return list(counted.values())


def export_committed(
    df: DataFrame, path: str, key: list[str], export: str, mapping: list[dict] | None = None, include_all: bool = True, replace_all: bool = False,
) -> None:
    """Map columns and export a JSON document per row, clustered by key ranges, all of them or none.

    export names the run (a feed date, a version): the same name again replaces that run's documents, another
    name adds to them, replace_all makes this run the only one. One job commits to a path at a time. Keys are
    not compared between exports. The path is one that Arrow and Spark both reach.
    """
    spark = df.sparkSession
    spark.dataSource.register(DocumentExport)
    mapped = df if mapping is None else map_columns(df, mapping, include_all)
    rows = documents(mapped.repartitionByRange(*key), key).select("document")
    rows.write.format(NAME).option("path", path).option("export", export).mode("overwrite" if replace_all else "append").save()


def read_export(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The documents of all commits that count, read by a schema; no rows where nothing is committed."""
    files = [f"{path.rstrip('/')}/{file}" for commit in _commits(path) for file in commit["files"]]
    return spark.read.schema(schema).json(files) if files else spark.createDataFrame([], schema)


def vacuum_export(path: str) -> int:
    """Delete staged files that no counting commit names, and the commits that count no more; how many files went.

    Not while a job writes to the path: its files are not committed yet. Commits go oldest first, so a reader
    sees the same documents at every moment.
    """
    store, root = _files(path)
    commits = _commits(path)
    names, kept = {c["name"] for c in commits}, {file for c in commits for file in c["files"]}
    for _, name in _commit_names(store, root):
        if name not in names:
            store.delete_file(name)
    found = store.get_file_info(fs.FileSelector(f"{root}/data", allow_not_found=True, recursive=True))
    stale = [f.path for f in found if f.type == fs.FileType.File and f.path.removeprefix(f"{root}/") not in kept]
    for file in stale:
        store.delete_file(file)
    return len(stale)
