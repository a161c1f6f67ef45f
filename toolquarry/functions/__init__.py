"""SQL text of common expressions, and stored steps.

The expression helpers take and give SQL text. Nested lambdas built from Column objects cost
thousands of calls into the JVM per plan; a text is one.
"""

from .json_text import json_items, last_values, parameters_json, quoted
from .lineage import stored, work_folder
from .text import blank_to_null, let, literal, lookup, token_count, trimmed, unix_newlines

__all__ = [
    "blank_to_null",
    "json_items",
    "last_values",
    "let",
    "literal",
    "lookup",
    "parameters_json",
    "quoted",
    "stored",
    "token_count",
    "trimmed",
    "unix_newlines",
    "work_folder",
]
