"""Catalog files: one JSON array of tool entries."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import let, quoted
from ..functions.places import recover
from ..schemas import CATALOG

_STRICT = {"allowSingleQuotes": "false"}


def _other_keys(json_object: str, *known: str) -> Column:
    """JSON text of the keys not listed (SQL text of an object), null if there are none.

    Values keep their text: numbers their digits, nested objects the order of their keys.
    """
    names = ", ".join(f"'{k}'" for k in known)
    kind = f"schema_of_variant(from_json({json_object}, 'map<string,variant>')[e.key])"
    value = f"if({kind} = 'STRING', {quoted('e.value')}, coalesce(e.value, 'null'))"
    entries = f"filter(map_entries(from_json({json_object}, 'map<string,string>')), e -> e.key NOT IN ({names}))"
    members = f"transform({entries}, e -> concat({quoted('e.key')}, ':', {value}))"
    return F.expr(let("ms", members, "if(size(ms) > 0, concat('{', array_join(ms, ','), '}'), NULL)"))


def parse_catalog(documents: DataFrame, *keys: str) -> DataFrame:
    """Entries of catalog documents (``value``: whole JSON text) in file order.

    Anything but a JSON list is an error. ``keys`` are columns to carry along.
    """
    entries = F.from_json("value", "array<string>", _STRICT)
    checked = F.coalesce(
        entries, F.raise_error(F.lit("a tool catalog must be a JSON list")).cast("array<string>")
    )
    rows = documents.select(*keys, F.posexplode(checked).alias("ord", "entry"))
    return rows.select(
        *keys,
        "ord",
        F.get_json_object("entry", "$.type").alias("type"),
        F.get_json_object("entry", "$.function.name").alias("name"),
        F.get_json_object("entry", "$.function.description").alias("description"),
        F.get_json_object("entry", "$.function.parameters").alias("parameters"),
        _other_keys("entry", "type", "function").alias("extra"),
        _other_keys("get_json_object(entry, '$.function')", "name", "description", "parameters").alias("function_extra"),
    )


def catalog_format(path: str, fmt: str | None = None) -> str:
    """``json`` or ``parquet``: as told, else by the end of the path."""
    fmt = fmt or ("json" if path.endswith(".json") else "parquet")
    if fmt not in ("json", "parquet"):
        raise ValueError(f"a catalog is json or parquet, not {fmt}")
    return fmt


def read_catalog(
    spark: SparkSession, path: str, missing_ok: bool = False, fmt: str | None = None
) -> DataFrame:
    """Read a catalog: one JSON array in a file, or a Parquet folder.

    A JSON array is one document and is read as one row. Keep large catalogs as
    Parquet. With ``missing_ok`` a path that does not exist is an empty catalog. A version that
    a killed run had moved aside and not replaced is taken up again.
    """
    recover(spark, path)
    try:
        if catalog_format(path, fmt) == "json":
            return parse_catalog(spark.read.text(path, wholetext=True))
        found = spark.read.parquet(path)
    except AnalysisException as e:
        if missing_ok and e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], CATALOG)
        raise
    if "ord" in found.columns:
        return found
    return found.withColumn("ord", F.lit(0))
