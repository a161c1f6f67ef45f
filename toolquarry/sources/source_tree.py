"""Source trees as tables.

Spark's own file sources pass over every name that starts with ``_`` or ``.`` and
so lose files such as ``__init__.py``. Here tasks list folders, level by level: a table
of folders in, files and folders out, spread anew before the next level. Listing and
reading are separate steps: the listing is small and can be filtered, joined and spread
evenly before any file is opened.
"""

import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stored
from ..schemas import SOURCE_PATHS

# File contents handed to Spark at once.
_BATCH_BYTES = 32 * 1024 * 1024
_LISTED = "path STRING, uri STRING, length BIGINT, is_folder BOOLEAN"


def open_root(uri: str):
    """File system and plain path of a folder."""
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), os.path.abspath(uri)


def _lister(root: str, excludes: frozenset, prune_from: int):
    """Folders (``path`` below the root) to what lies right below them.

    Excluded names are passed over from ``prune_from`` folders below the root on; symbolic
    links to folders are never followed.
    """

    def entries(filesystem, base, folder):
        local = isinstance(filesystem, fs.LocalFileSystem)
        for info in filesystem.get_file_info(fs.FileSelector(f"{base}/{folder}" if folder else base)):
            path = f"{folder}/{info.base_name}" if folder else info.base_name
            if info.base_name in excludes and path.count("/") >= prune_from:
                continue
            if info.type == fs.FileType.File:
                yield path, info.path, info.size, False
            elif info.type == fs.FileType.Directory and not (local and os.path.islink(info.path)):
                yield path, info.path, None, True

    def listing(batches):
        filesystem, base = open_root(root)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                rows = []
                for row in entries(filesystem, base, folder):
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    def _batch(rows):
        kinds = (pa.string(), pa.string(), pa.int64(), pa.bool_())
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["path", "uri", "length", "is_folder"])

    return listing


def list_tree(
    spark: SparkSession,
    root: str,
    work_path: str,
    excludes: Iterable[str] = (),
    project: str | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Files below ``root``: ``project, path, uri, length``; ``path`` is relative to the project.

    The direct subfolders of ``root`` are the projects, and files right in ``root`` belong to
    a project with an empty name. With ``project`` all of ``root`` is the one project of that
    name. ``excludes`` are folder and file names not to look into, below the projects.

    A root that does not exist is an error. Every level is stored below ``work_path``, which
    all machines share; ``tasks`` list a level.
    """
    filesystem, base = open_root(root)
    if filesystem.get_file_info(base).type != fs.FileType.Directory:
        raise FileNotFoundError(f"{root} is not a folder")
    tasks = tasks or 2 * spark.sparkContext.defaultParallelism
    listing = _lister(root, frozenset(excludes), 1 if project is None else 0)
    folders = spark.createDataFrame([("",)], "path STRING")
    files = None
    while True:
        level = stored(folders.repartition(tasks, "path").mapInArrow(listing, _LISTED), work_path, "level")
        found = level.where("NOT is_folder").drop("is_folder")
        files = found if files is None else files.unionByName(found)
        folders = level.where("is_folder").select("path")
        if folders.isEmpty():
            break
    if project is not None:
        return files.select(F.lit(project).alias("project"), "path", "uri", "length")
    inner = F.instr("path", "/")
    return files.select(
        F.when(inner > 0, F.substring_index("path", "/", 1)).otherwise(F.lit("")).alias("project"),
        F.expr("if(instr(path, '/') > 0, substr(path, instr(path, '/') + 1), path)").alias("path"),
        "uri",
        "length",
    )


def with_contents(filesystem, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Add ``content`` to listed files (``uri``), as batches of bounded size."""
    contents, held, begin = [], 0, 0
    for i, uri in enumerate(batch.column("uri")):
        with filesystem.open_input_stream(uri.as_py()) as stream:
            contents.append(stream.read())
        held += len(contents[-1])
        if held >= _BATCH_BYTES or i + 1 == batch.num_rows:
            part = batch.slice(begin, i + 1 - begin)
            column = pa.array(contents, type=pa.binary())
            yield pa.RecordBatch.from_arrays([*part.columns, column], [*part.schema.names, "content"])
            contents, held, begin = [], 0, i + 1


def read_contents(paths: DataFrame, root: str, partitions: int | None = None) -> DataFrame:
    """Add ``content`` to listed files.

    The listing is spread by file first, so a project that holds a third of all files is read
    by all tasks. The number of tasks is fixed: by the size of the listing alone, adaptive
    execution would merge them into a few.
    """
    spark = paths.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def read(batches):
        filesystem, _ = open_root(root)
        for batch in batches:
            yield from with_contents(filesystem, batch)

    wanted = paths.select("project", "path", "uri", "length").repartition(partitions, "uri")
    return wanted.mapInArrow(read, SOURCE_PATHS + ", content BINARY")


def read_tree(
    spark: SparkSession,
    root: str,
    work_path: str,
    excludes: Iterable[str] = (),
    project: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """``source_files`` table of a tree: ``project, path, content``."""
    listed = list_tree(spark, root, work_path, excludes, project)
    return read_contents(listed, root, partitions).select("project", "path", "content")
