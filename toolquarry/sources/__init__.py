"""Reading source trees, catalogs and sample files."""

from .catalog_files import parse_catalog, read_catalog
from .sample_files import known_ids, read_samples, read_valid_samples
from .source_tree import list_tree, read_contents, read_tree
from .tree_source import load_tree, not_below, register_source_tree

__all__ = [
    "known_ids",
    "list_tree",
    "load_tree",
    "not_below",
    "parse_catalog",
    "read_catalog",
    "read_contents",
    "read_samples",
    "read_tree",
    "read_valid_samples",
    "register_source_tree",
]
