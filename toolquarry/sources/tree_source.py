"""Source trees as a Spark data source: ``spark.read.format("srctree")``.

The listing of a tree (``list_tree``) is a stored table; the source reads files by it. Partitions
are planned from the footers of the listing alone, so many files in one folder are read by many
tasks, and no list of files meets anywhere. Excluded names and file types are options of the source,
and filters on the columns of the listing can be pushed into it: what they drop is never opened.
"""

import json
import uuid
from collections.abc import Iterable
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from .source_tree import list_tree, open_root, with_contents

FORMAT = "srctree"
SCHEMA = "project STRING, path STRING, parts STRING, ext STRING, length BIGINT, content BINARY"
FILES = 1000  # files of one partition
_GROUP_BYTES = 1 << 20  # row groups of a stored listing, so that a task reads little of it

_COMPARED = {
    ds.EqualTo: pc.equal,
    ds.GreaterThan: pc.greater,
    ds.GreaterThanOrEqual: pc.greater_equal,
    ds.LessThan: pc.less,
    ds.LessThanOrEqual: pc.less_equal,
    ds.StringContains: pc.match_substring,
    ds.StringStartsWith: pc.starts_with,
    ds.StringEndsWith: pc.ends_with,
}
_LISTED = ("project", "path", "parts", "ext", "length")


def _understood(f: ds.Filter) -> bool:
    if isinstance(f, ds.Not):
        return _understood(f.child)
    if not isinstance(f, (ds.In, ds.IsNotNull, *_COMPARED)) or len(f.attribute) > 1 or f.attribute[0] not in _LISTED:
        return False
    if isinstance(f, ds.In):
        return None not in f.value
    return isinstance(f, ds.IsNotNull) or f.value is not None


def _passes(rows: pa.Table, f: ds.Filter) -> pa.ChunkedArray:
    if isinstance(f, ds.Not):
        return pc.invert(_passes(rows, f.child))
    column = rows[f.attribute[0]]
    if isinstance(f, ds.IsNotNull):
        return column.is_valid()
    if isinstance(f, ds.In):
        return pc.is_in(column, value_set=pa.array(list(f.value), column.type))
    return _COMPARED[type(f)](column, f.value)


class Files(NamedTuple):
    """Rows ``first`` to ``first + n`` of a row group of the listing."""

    listing: str
    group: int
    first: int
    n: int


class FilePartition(ds.InputPartition):
    def __init__(self, files: Files):
        super().__init__(files)


class SourceTreeReader(ds.DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.listing = options["root"], options["listing"]
        self.files = int(options.get("files", FILES))
        self.filters: list[ds.Filter] = [
            ds.Not(ds.StringContains(("parts",), f"/{name}/")) for name in json.loads(options.get("excludes", "[]"))
        ]
        if "types" in options:
            self.filters.append(ds.In(("ext",), tuple(json.loads(options["types"]))))

    def partitions(self):
        from pyarrow import fs

        filesystem, base = open_root(self.listing)
        names = [i.path for i in filesystem.get_file_info(fs.FileSelector(base)) if i.path.endswith(".parquet")]
        planned = []
        for name in sorted(names):
            with filesystem.open_input_file(name) as file:
                footer = pq.read_metadata(file)
            for group in range(footer.num_row_groups):
                rows = footer.row_group(group).num_rows
                planned += [FilePartition(Files(name, group, i, min(self.files, rows - i))) for i in range(0, rows, self.files)]
        return planned or [FilePartition(Files("", 0, 0, 0))]

    def read(self, partition):
        listing, group, first, n = partition.value
        if not n:
            return
        filesystem, _ = open_root(self.listing)
        with filesystem.open_input_file(listing) as file:
            rows = pq.ParquetFile(file).read_row_group(group, columns=["project", "path", "uri", "length"]).slice(first, n)
        rows = rows.append_column("parts", pc.binary_join_element_wise("/", rows["path"], "/", ""))
        ext = pc.extract_regex(rows["path"], r"\.(?P<ext>[A-Za-z]+)$").combine_chunks()
        rows = rows.append_column("ext", pc.fill_null(pc.struct_field(ext, "ext"), ""))
        for f in self.filters:
            rows = rows.filter(_passes(rows, f))
        filesystem, _ = open_root(self.root)
        for batch in rows.combine_chunks().to_batches():
            for read in with_contents(filesystem, batch):
                yield read.select([*_LISTED, "content"])


class FilteringReader(SourceTreeReader):
    """Takes pushed filters; a session that pushes none accepts no such reader."""

    def pushFilters(self, filters):
        for f in filters:
            if _understood(f):
                self.filters.append(f)
            else:
                yield f


class SourceTree(ds.DataSource):
    """``project, path, parts, ext, length, content`` of the files of a listing.

    ``parts`` is the path between slashes, so that ``NOT contains(parts, '/build/')`` passes over
    a folder or file name; ``ext`` is the file type. Options: ``listing`` (the stored table of
    ``list_tree``, a folder that tasks can open), ``root``, ``files`` per partition, ``excludes`` and
    ``types`` (JSON lists of names and of file types), and ``push`` (``true`` to take pushed filters).
    """

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        options = dict(self.options)
        return (FilteringReader if options.get("push") == "true" else SourceTreeReader)(options)


def register_source_tree(spark: SparkSession) -> None:
    """Make ``srctree`` known to a session."""
    spark.dataSource.register(SourceTree)


def not_below(*names: str) -> Column:
    """Files without any of these folder or file names in their path, as filters that can be pushed."""
    keep = F.lit(True)
    for name in names:
        keep = keep & ~F.contains(F.col("parts"), F.lit(f"/{name}/"))
    return keep


def load_tree(
    spark: SparkSession,
    root: str,
    work_path: str,
    excludes: Iterable[str] = (),
    types: Iterable[str] | None = None,
    project: str | None = None,
    files: int = FILES,
    push: bool = False,
) -> DataFrame:
    """The files below ``root`` through the ``srctree`` source; the listing is kept in ``work_path``.

    Files below folders named in ``excludes`` and files of other than the given ``types`` are not
    opened. A partition has up to ``files`` files. Projects are told as by ``list_tree``; the listing
    holds all files, so that languages can be detected from it.

    With ``push`` filters on the result are pushed too (``spark.sql.python.filterPushdown.enabled``
    must be on). Such a result is for one use: Spark 4.1 keeps pushed filters with the loaded
    source, so two branches of a query would see the filters of the later one.
    """
    register_source_tree(spark)
    listing = f"{work_path.rstrip('/')}/listing-{uuid.uuid4().hex}"
    listed = list_tree(spark, root, work_path, project=project)
    listed.write.option("parquet.block.size", _GROUP_BYTES).parquet(listing)
    options = {"listing": listing, "root": root, "files": files, "push": push, "excludes": json.dumps(sorted(set(excludes)))}
    if types is not None:
        options["types"] = json.dumps(sorted(set(types)))
    return spark.read.format(FORMAT).options(**options).load()
