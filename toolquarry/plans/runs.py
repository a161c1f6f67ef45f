"""Source tree to catalog, catalog to samples, samples to training text."""

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession

from ..functions import stored
from ..operators.catalog import merge_tools, nameless_entries
from ..operators.extract import scan_files, skipped_files, tool_defs
from ..operators.files import (
    DEFAULT_EXCLUDES,
    drop_excluded,
    keep_detected,
    keep_languages,
    parse_languages,
    route_files,
)
from ..operators.samples import generate_samples
from ..operators.training_text import ChatTemplate, format_samples, mark_budget, tool_lists
from ..sinks import append_samples, save_catalog, save_samples
from ..sources import list_tree, read_catalog, read_contents, read_samples

AUTO = "auto"


def select_files(
    paths: DataFrame, languages: str = AUTO, excludes: Iterable[str] = DEFAULT_EXCLUDES
) -> DataFrame:
    """Files to scan: not excluded, of a readable type, of a wanted language.

    ``languages`` is a comma list, or ``auto`` for those detected per project.
    """
    routed = route_files(drop_excluded(paths, excludes))
    if languages == AUTO:
        return keep_detected(routed, paths)
    return keep_languages(routed, parse_languages(languages))


def discover_tools(
    files: DataFrame, languages: str = AUTO, excludes: Iterable[str] = DEFAULT_EXCLUDES
) -> DataFrame:
    """Scan a ``project, path, content`` table; see ``scan_files`` for the result."""
    return scan_files(select_files(files, languages, excludes))


class CatalogRun(NamedTuple):
    """The stored catalog and what the run did."""

    catalog: DataFrame
    entries: int
    dropped: int  # existing entries without a name


def catalog_from_tree(
    spark: SparkSession,
    root: str,
    catalog_path: str,
    work_path: str,
    languages: str = AUTO,
    excludes: Iterable[str] = DEFAULT_EXCLUDES,
    project: str | None = None,
    fmt: str | None = None,
    skipped_path: str | None = None,
) -> CatalogRun:
    """Scan the projects below ``root`` and merge their tools into a stored catalog.

    With ``project`` the whole of ``root`` is one project of that name. ``fmt`` is the format
    of the catalog, ``json`` or ``parquet``; by default the end of its path tells. The tree is
    listed once: detection and reading work on the same snapshot, kept below ``work_path``.
    Files that could not be read are written to ``skipped_path`` (Parquet) if it is given.
    """
    excludes = list(excludes)
    # Detection looks into excluded folders too; a fixed choice need not list them.
    pruned = () if languages == AUTO else excludes
    listed = list_tree(spark, root, work_path, pruned, project)
    scanned = scan_files(read_contents(select_files(listed, languages, excludes), root))
    if skipped_path is not None:
        scanned = stored(scanned, work_path, "scanned")  # two readers, one scan
        skipped_files(scanned).write.mode("overwrite").parquet(skipped_path)
    existing = read_catalog(spark, catalog_path, missing_ok=True, fmt=fmt)
    dropped = nameless_entries(existing).head()["nameless"]
    counted = Observation()  # entries are counted while they are written
    catalog = save_catalog(merge_tools(existing, tool_defs(scanned)), catalog_path, fmt, counted)
    return CatalogRun(catalog, counted.get["entries"], dropped)


def samples_from_catalog(
    spark: SparkSession,
    catalog_path: str,
    samples_path: str,
    append: bool = False,
    ids_path: str | None = None,
    work_path: str | None = None,
) -> None:
    """Write one sample per catalog entry, or append those not there yet.

    ``ids_path`` and ``work_path``: see ``append_samples``.
    """
    samples = generate_samples(read_catalog(spark, catalog_path))
    if append:
        append_samples(samples, samples_path, ids_path=ids_path, work_path=work_path)
    else:
        save_samples(samples, samples_path)


def training_text(
    spark: SparkSession,
    samples_path: str,
    catalog_path: str,
    work_path: str,
    template: ChatTemplate = ChatTemplate(),
    budget: int = 1024,
) -> DataFrame:
    """``id, text, n_tokens_proxy, over_budget`` of a sample file.

    The lists of tools behind the samples are resolved once and kept below ``work_path``.
    """
    samples, catalog = read_samples(spark, samples_path), read_catalog(spark, catalog_path)
    lists = stored(tool_lists(samples, catalog), work_path, "tool_lists")
    texts = format_samples(samples, catalog, template, lists).select("id", "text")
    return mark_budget(texts, budget)
