"""Extraction over a table of source files.

One scan serves all languages: each file is routed by its type, files that cannot
hold a tool are dropped by column predicates, and the rest go through one Arrow
exchange with the helpers of their language. No shuffle.
"""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import java_tools, node_tools, python_tools
from .files import LANGUAGES, decode_text, keep_languages, route_files

_HELPERS = {"python": python_tools, "node": node_tools, "java": java_tools}
_KEYS = ("project", "path", "lang", "lang_rank", "ext_rank")

#: Columns that put tool definitions in discovery order.
ORDER = ("project", "lang_rank", "ext_rank", "path", "pattern_rank", "ordinal")


def scan_files(files: DataFrame, languages: Iterable[str] = LANGUAGES) -> DataFrame:
    """One row per file worth a look: its keys, ``tools``, and ``reason, detail`` if skipped.

    ``files`` holds ``project, path, content``, or is already routed. A null content is
    reported like one that is not UTF-8.
    """
    wanted = [lang for lang in LANGUAGES if lang in set(languages)]
    routed = files if "lang_rank" in files.columns else route_files(files)
    routed = keep_languages(routed, wanted)
    wanted = wanted or LANGUAGES  # no known language keeps no file

    raw = "CAST(content AS STRING)"
    worth = [f"lang = '{lang}' AND {_HELPERS[lang].may_hold_tools(raw)}" for lang in wanted]
    kept = routed.filter(" OR ".join(["content IS NULL", f"NOT is_valid_utf8({raw})", *worth]))
    texts = decode_text(kept).select(*_KEYS, "text")

    def parse(lang: str) -> Column:
        needed = f"lang = '{lang}'"
        if lang == "java":
            needed += f" AND {java_tools.may_hold_annotations('text')}"
        return _HELPERS[lang].parse(F.expr(f"if({needed}, text, NULL)")).alias(f"_{lang}")

    parsed = texts.select(*_KEYS, "text", *map(parse, wanted))
    tools = [
        f"WHEN '{lang}' THEN "
        + (java_tools.tools("_java.found", "text") if lang == "java" else _HELPERS[lang].tools(f"_{lang}.found"))
        for lang in wanted
    ]
    reason, detail = (
        "coalesce(" + ", ".join([*[f"_{lang}.{field}" for lang in wanted], "NULL"]) + ")"
        for field in ("reason", "detail")
    )
    return parsed.select(
        *_KEYS,
        F.expr(f"CASE lang {' '.join(tools)} END").alias("tools"),
        F.expr(f"if(text IS NULL, 'bad_utf8', {reason})").alias("reason"),
        F.expr(detail).alias("detail"),
    )


def tool_defs(scanned: DataFrame) -> DataFrame:
    """Tool definitions of scanned files, one row per tool."""
    # A plain explode would have the optimizer test for empty lists beforehand, and
    # so work out the lists twice.
    rows = scanned.select(*_KEYS, F.posexplode_outer("tools").alias("ordinal", "tool"))
    return rows.filter(F.col("ordinal").isNotNull()).select(
        *_KEYS,
        "tool.pattern_rank",
        "ordinal",
        "tool.name",
        "tool.description",
        "tool.parameters",
    )


def skipped_files(scanned: DataFrame) -> DataFrame:
    """Files that were looked at and could not be read, with the reason."""
    return scanned.filter(F.col("reason").isNotNull()).select("project", "path", "reason", "detail")


def extract_tools(files: DataFrame, languages: Iterable[str] = LANGUAGES) -> DataFrame:
    """Tool definitions of a table of source files."""
    return tool_defs(scan_files(files, languages))
