"""Choosing which source files to read: folders, file types, languages, text."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lookup, unix_newlines

# Folder names skipped unless the caller gives a list of their own.
DEFAULT_EXCLUDES = (
    ".git",
    ".venv",
    "venv",
    "env",
    "__pycache__",
    "node_modules",
    "dist",
    "build",
    "target",
    ".idea",
    ".vscode",
    "gemma_finetune_env",
    "functiongemma-finetuned",
)

# Languages in scan order, and file types in scan order per language.
LANGUAGES = ("python", "node", "java")
FILE_TYPES = {
    "python": ("py",),
    "node": ("ts", "js", "mts", "cts", "tsx", "jsx"),
    "java": ("java",),
}

def _ext(path: Column) -> Column:
    return F.regexp_extract(path, r"\.([A-Za-z]+)\z", 1)


def drop_excluded(paths: DataFrame, excludes: Iterable[str] = DEFAULT_EXCLUDES) -> DataFrame:
    """Drop files with an excluded name anywhere in their project-relative path.

    ``excludes`` replaces the default list, it does not extend it.
    """
    names = sorted(set(excludes))
    if not names:
        return paths
    parts = F.split("path", "/")
    return paths.filter(~F.arrays_overlap(parts, F.lit(names)))


def route_files(paths: DataFrame) -> DataFrame:
    """Keep the file types we can read and add ``ext, lang, lang_rank, ext_rank``."""
    lang_of = {e: lang for lang, exts in FILE_TYPES.items() for e in exts}
    lang_ranks = {lang: i for i, lang in enumerate(LANGUAGES)}
    rank_of = {e: i for exts in FILE_TYPES.values() for i, e in enumerate(exts)}
    return (
        paths.filter(_ext(F.col("path")).isin(*lang_of))
        .withColumn("ext", _ext(F.col("path")))
        .withColumns(
            {
                "lang": F.expr(lookup("ext", lang_of)),
                "lang_rank": F.expr(lookup("ext", {e: lang_ranks[x] for e, x in lang_of.items()})),
                "ext_rank": F.expr(lookup("ext", rank_of)),
            }
        )
    )


def parse_languages(text: str) -> list[str]:
    """Split ``"python, node"``; names of no known language are ignored later."""
    return [part.strip() for part in text.split(",") if part.strip()]


def keep_languages(routed: DataFrame, languages: Iterable[str]) -> DataFrame:
    """Keep the files of the named languages."""
    return routed.filter(F.col("lang").isin(*languages))


def _marks_node(path: Column) -> Column:
    return (path == "package.json") | _ext(path).isin("ts", "js")


def project_languages(paths: DataFrame) -> DataFrame:
    """Languages seen in each project: ``project, languages`` (sorted names).

    Looks at all paths, excluded folders too. Three boolean aggregates per
    project: map-side combine keeps a huge project from becoming a hot spot.
    """
    path = F.col("path")
    base = F.substring_index(path, "/", -1)
    seen = paths.groupBy("project").agg(
        F.bool_or(base.isin("pom.xml", "build.gradle") | (_ext(path) == "java")).alias("java"),
        F.bool_or(_marks_node(path)).alias("node"),
        F.bool_or(_ext(path) == "py").alias("python"),
    )
    names = [F.when(F.col(lang), F.lit(lang)) for lang in ("java", "node", "python")]
    return seen.select("project", F.array_compact(F.array(*names)).alias("languages"))


def keep_detected(routed: DataFrame, all_paths: DataFrame) -> DataFrame:
    """Keep files whose language is among the detected ones of their project.

    A ``.py``, ``.ts``, ``.js`` or ``.java`` file proves its own language, so only
    the few files of other types are joined with the projects that have it.
    """
    sure = F.col("ext").isin("py", "ts", "js", "java")
    node_projects = all_paths.filter(_marks_node(F.col("path"))).select("project").distinct()
    unsure = routed.filter(~sure).join(node_projects, "project", "left_semi")
    return routed.filter(sure).unionByName(unsure.select(*routed.columns))


def decode_text(files: DataFrame) -> DataFrame:
    """Add ``text``: content with plain newlines, null where it is not UTF-8."""
    raw = "CAST(content AS STRING)"
    return files.withColumn("text", F.expr(f"if(is_valid_utf8({raw}), {unix_newlines(raw)}, NULL)"))


def valid_text_files(files: DataFrame) -> DataFrame:
    """Keep the files that are UTF-8 text."""
    return files.filter(F.is_valid_utf8(F.col("content").cast("string")))
