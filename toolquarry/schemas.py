"""Table layouts shared by all operators."""

from pyspark.sql import types as T

EMPTY_PARAMETERS = '{"type":"object","properties":{},"required":[]}'

SOURCE_PATHS = "project STRING, path STRING, uri STRING, length BIGINT"
SOURCE_FILES = "project STRING, path STRING, content BINARY"

TOOL_DEFS = (
    "project STRING, path STRING, lang STRING, lang_rank INT, ext_rank INT, "
    "pattern_rank INT, ordinal INT, name STRING, description STRING, parameters STRING"
)

CATALOG = (
    "ord INT, type STRING, name STRING, description STRING, parameters STRING, "
    "extra STRING, function_extra STRING"
)

TOOL_CALL = "STRUCT<function: STRUCT<name: STRING, arguments: STRING>>"
MESSAGE = (
    "STRUCT<role: STRING, content: STRING, name: STRING, "
    f"tool_calls: ARRAY<{TOOL_CALL}>>"
)
SAMPLES = f"id STRING, tool_names ARRAY<STRING>, messages ARRAY<{MESSAGE}>"


def struct(**fields) -> T.StructType:
    """``struct(a=T.StringType())``: a struct whose fields may all be null."""
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])
