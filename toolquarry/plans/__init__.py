"""The three runs, end to end."""

from .runs import CatalogRun, catalog_from_tree, discover_tools, samples_from_catalog, training_text

__all__ = ["CatalogRun", "catalog_from_tree", "discover_tools", "samples_from_catalog", "training_text"]
