"""Extraction as SQL table functions.

After ``register_table_functions(spark)``::

    SELECT f.path, t.name, t.parameters FROM files f, LATERAL python_tools(f.text) t

``python_tools``, ``node_tools`` and ``java_tools`` give the tools of one text: ``pattern_rank,
ordinal, name, description, parameters``. They are temporary SQL functions over the helpers of
the languages, so names, types and schemas are worked out by the same expressions as in
``operators.extract``, a query needs one Arrow exchange per function, and no shuffle.
"""

from pyspark.sql import SparkSession

from .functions import unix_newlines
from .operators import java_tools, node_tools, python_tools
from .operators.per_file import parsed

_LANGUAGES = {"python_tools": python_tools, "node_tools": node_tools, "java_tools": java_tools}
_RESULT = "pattern_rank INT, ordinal INT, name STRING, description STRING, parameters STRING"


def register_table_functions(spark: SparkSession) -> None:
    """Make the table functions known to a session.

    A null text, one that is not UTF-8, not worth a look or does not parse gives no rows; what
    was skipped, and why, is told by ``operators.extract.skipped_files``. Join them with ``LATERAL``;
    Spark 4.1 takes a ``LEFT JOIN LATERAL`` over an explode like an inner one.
    """
    for name, language in _LANGUAGES.items():
        # A lateral join accepts deterministic functions only.
        spark.udf.register(f"toolquarry_{name}_facts", parsed(language.find, language.FOUND, once=False))
        text = f"if(is_valid_utf8(source) AND {language.may_hold_tools('source')}, {unix_newlines('source')}, NULL)"
        found = f"toolquarry_{name}_facts({text}).found"
        tools = language.tools(found, text) if language is java_tools else language.tools(found)
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(source STRING) RETURNS TABLE ({_RESULT}) RETURN "
            f"SELECT tool.pattern_rank, ordinal, tool.name, tool.description, tool.parameters "
            f"FROM (SELECT posexplode({tools}) AS (ordinal, tool))"
        )


__all__ = ["register_table_functions"]
