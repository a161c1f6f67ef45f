"""Sample files: ``id, tool_names, messages`` as JSON lines or Parquet."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import trimmed
from ..schemas import SAMPLES

_STRICT = {"allowSingleQuotes": "false"}
IDS = "id STRING, part STRING"


def read_samples(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Read samples; call arguments stay raw JSON text. A malformed line is an error."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    return spark.read.schema(SAMPLES).json(path, mode="FAILFAST", allowSingleQuotes="false")


def _only_object(line: Column, fields: str) -> Column:
    """The fields of the one JSON object a line holds, null for any other line.

    Inside brackets, text after a first document makes the line malformed.
    """
    items = F.from_json(F.concat(F.lit("["), line, F.lit("]")), f"array<struct<{fields}>>", _STRICT)
    one = F.startswith(line, F.lit("{")) & (F.size(items) == 1)
    return F.when(one, F.get(items, F.lit(0)))


def parse_lines(lines: DataFrame, fields: str, *keys: str) -> DataFrame:
    """Fields of the objects among ``lines`` (``value``); all other lines are passed over.

    ``keys`` are columns to carry along.
    """
    found = _only_object(F.expr(trimmed("value")), fields)
    return lines.select(found.alias("o"), *keys).filter(F.col("o").isNotNull()).select("o.*", *keys)


def read_valid_samples(spark: SparkSession, path: str) -> DataFrame:
    """Read samples and pass over blank lines, malformed lines and non-objects."""
    return parse_lines(spark.read.text(path), SAMPLES)


def line_ids(lines: DataFrame) -> DataFrame:
    """Ids of the objects among ``lines``, as text; a null id counts as none."""
    return parse_lines(lines, "id: string").filter(F.col("id").isNotNull())


def known_ids(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Ids in a sample file or folder; no rows if there is none yet.

    JSON lines have to be read whole to get at the ids, Parquet reads one column.
    """
    try:
        if fmt == "parquet":
            return spark.read.parquet(path).select("id").filter(F.col("id").isNotNull())
        return line_ids(spark.read.text(path))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], "id STRING")
        raise


def ids_by_part(spark: SparkSession, files: list[str], fmt: str = "json") -> DataFrame:
    """``id, part``: the ids in some sample files, with the name of the file that holds them."""
    part = F.col("_metadata.file_name").alias("part")
    if fmt == "parquet":
        found = spark.read.parquet(*files).select("id", part)
    else:
        found = parse_lines(spark.read.text(files).select("value", part), "id: string", "part")
    return found.filter(F.col("id").isNotNull())
