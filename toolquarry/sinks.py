"""Writing catalogs and samples."""

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from .functions import stored
from .functions.id_filter import id_filter
from .functions.places import beside, file_system, join_parts, put, recover
from .operators.catalog import sort_catalog
from .operators.samples import new_samples, sample_json
from .operators.training_text import entry_json
from .sources.catalog_files import catalog_format, read_catalog
from .sources.sample_files import IDS, ids_by_part, known_ids

_SEPARATOR = ",\n"


def catalog_lines(catalog: DataFrame, *keys: str) -> DataFrame:
    """``*keys, line``: the lines of one JSON array of entries per ``keys``, in name order.

    Brackets and commas go by position, so null and repeated names are entries like others.
    """
    if not keys:
        raise ValueError("lines of several catalogs need keys; save_catalog writes a single one")
    order = Window.partitionBy(*keys).orderBy("name", "entry")
    rows = catalog.select(*keys, "name", entry_json(catalog).alias("entry"))
    line = F.concat(
        F.when(F.row_number().over(order) == 1, F.lit("[\n")).otherwise(F.lit("")),
        F.lit("  "),
        F.col("entry"),
        F.when(F.lead("entry").over(order).isNull(), F.lit("\n]")).otherwise(F.lit(",")),
    )
    return rows.select(*keys, F.row_number().over(order).alias("position"), line.alias("line"))


def _json_entries(catalog: DataFrame) -> DataFrame:
    """``line``: every entry followed by a comma, in order of name and entry over all partitions."""
    rows = catalog.select("name", entry_json(catalog).alias("entry")).orderBy("name", "entry")
    return rows.select(F.concat(F.lit("  "), "entry", F.lit(_SEPARATOR[0])).alias("line"))


def save_catalog(catalog: DataFrame, path: str, fmt: str | None = None, counted: Observation | None = None) -> DataFrame:
    """Replace the catalog stored at ``path`` and return the stored one, in name order.

    ``fmt`` is ``json`` (one file with a JSON array) or ``parquet`` (a folder); by default a path
    that ends in ``.json`` is JSON. A file is never replaced by a folder, nor a folder by a
    file. The catalog may be derived from the one stored there: it is written beside it and put
    in its place when whole. Both formats are sorted by range and written by many tasks; the
    parts of a JSON array then stream into one file. ``counted`` gets ``entries`` on the way.
    """
    spark = catalog.sparkSession
    fmt = catalog_format(path, fmt)
    recover(spark, path)
    files, target = file_system(spark, path)
    if files.exists(target) and files.getFileStatus(target).isDirectory() != (fmt == "parquet"):
        raise ValueError(f"{path} holds a catalog of the other format; name another path or format")
    new = beside(path, "new")
    rows = sort_catalog(catalog) if fmt == "parquet" else _json_entries(catalog)
    if counted is not None:
        rows = rows.observe(counted, F.count(F.lit(1)).alias("entries"))
    if fmt == "parquet":
        rows.write.parquet(new)
        put(spark, new, path)
    else:
        parts = beside(path, "new")
        rows.write.text(parts, lineSep="\n")
        join_parts(spark, parts, new, "[\n", "\n]\n", len(_SEPARATOR.encode()))
        put(spark, new, path)
    return read_catalog(spark, path, fmt=fmt)


def save_samples(samples: DataFrame, path: str, fmt: str = "json") -> None:
    """Replace the sample file: JSON lines, or Parquet."""
    _write(samples, path, fmt, "overwrite")


def _write(samples: DataFrame, path: str, fmt: str, mode: str) -> None:
    if fmt == "json":
        samples.select(sample_json(samples).alias("value")).write.mode(mode).text(path)
    else:
        samples.write.mode(mode).format(fmt).save(path)


def _part_names(spark: SparkSession, path: str) -> dict[str, str]:
    """Name and path of every file of samples: of a folder, or the one file."""
    files, target = file_system(spark, path)
    if not files.exists(target):
        return {}
    found = [s.getPath() for s in files.listStatus(target) if s.isFile()]
    return {p.getName(): p.toString() for p in found if p.getName()[0] not in "_."}


def index_ids(spark: SparkSession, path: str, ids_path: str, fmt: str = "json") -> DataFrame:
    """Ids of the stored samples, from a table ``id, part`` at ``ids_path`` that is brought up to date.

    ``part`` is the file that an id stands in; the files that have been read are named beside
    the table, in ``<ids_path>.parts``, after their ids are stored. Only files not named there
    are read, whoever wrote them: a run that was killed between samples and ids has left such
    files. Ids of files that are gone do not count. The names of the files come to the driver.
    """
    parts, named_path = _part_names(spark, path), f"{ids_path.rstrip('/')}.parts"
    files, target = file_system(spark, named_path)
    named = set()
    if files.exists(target):
        named = {r["part"] for r in spark.read.schema("part STRING").parquet(named_path).collect()}
    if missing := sorted(parts.keys() - named):
        found = ids_by_part(spark, [parts[name] for name in missing], fmt)
        found.write.mode("append").parquet(ids_path)
        spark.createDataFrame([(name,) for name in missing], "part STRING").write.mode("append").parquet(named_path)
        named |= set(missing)
    if not named:
        return spark.createDataFrame([], IDS)
    # Rows of older tables have no part; the files themselves have told their ids again.
    known = spark.read.schema(IDS).parquet(ids_path).where("part IS NOT NULL")
    if gone := sorted(named - parts.keys()):
        known = known.join(spark.createDataFrame([(name,) for name in gone], "part STRING"), "part", "left_anti")
    return known.select("id", "part")


def append_samples(
    samples: DataFrame, path: str, fmt: str = "json", ids_path: str | None = None, work_path: str | None = None
) -> None:
    """Append the samples whose id is not in the sample file yet.

    For one writer at a time: two runs at once cannot see each other's ids. JSON lines have
    to be read whole for their ids. With ``ids_path`` the ids are kept there as Parquet too
    (``index_ids``), so that every line is read for its id once, and only ids that a Bloom filter
    of the new ones lets through take part in the join. A run that dies, at whatever step, may
    be repeated: samples that it stored count as stored, even if their ids were not kept, and
    no sample with an id is stored twice. The samples are worked out twice, for their ids and for
    writing them; with ``work_path`` once, and stored there.
    """
    spark = samples.sparkSession
    if ids_path is None:
        _write(new_samples(samples, known_ids(spark, path, fmt)), path, fmt, "append")
        return
    known = index_ids(spark, path, ids_path, fmt)
    if work_path is not None:
        samples = stored(samples, work_path, "samples")
    known = known.where(id_filter(samples)("id"))
    _write(new_samples(samples, known), path, fmt, "append")
    index_ids(spark, path, ids_path, fmt)


__all__ = ["append_samples", "catalog_lines", "index_ids", "save_catalog", "save_samples"]
