"""Tools declared in Python files by a ``tool`` decorator.

The task-side helper reads facts off the syntax tree; types and the parameter
schema are column expressions.
"""

import ast
from collections import deque

from pyspark.sql import types as T

from ..functions import lookup, parameters_json
from ..schemas import struct
from .per_file import parsed

# JSON type by annotation. "List[]" is a subscripted name,
# ".List" an attribute such as typing.List; all else is a string.
ANNOTATION_TYPES = {
    "str": "string",
    "int": "integer",
    "float": "number",
    "bool": "boolean",
    "dict": "object",
    "list": "array",
    "List[]": "array",
    "list[]": "array",
    "Sequence[]": "array",
    "Iterable[]": "array",
    "Tuple[]": "array",
    "Set[]": "array",
    "set[]": "array",
    "Dict[]": "object",
    "dict[]": "object",
    "Mapping[]": "object",
    ".List": "array",
    ".Sequence": "array",
    ".Iterable": "array",
    ".Tuple": "array",
    ".Set": "array",
    ".Dict": "object",
    ".Mapping": "object",
}

_NESTING = (ast.stmt, ast.excepthandler, ast.match_case)

_PARAM = struct(name=T.StringType(), annotation=T.StringType(), required=T.BooleanType())
FOUND = struct(
    name=T.StringType(), description=T.StringType(), params=T.ArrayType(_PARAM)
)


def _label(node):
    """Last name of ``x`` or ``a.b.x``."""
    return getattr(node, "attr", None) if isinstance(node, ast.Attribute) else getattr(node, "id", None)


def _annotation(node):
    """Short text of an annotation, looking through Optional and Union."""
    while isinstance(node, ast.Subscript) and getattr(node.value, "id", "") in ("Optional", "Union"):
        node = node.slice
        if isinstance(node, ast.Tuple) and node.elts:
            node = node.elts[0]
    if isinstance(node, ast.Subscript):
        return f"{getattr(node.value, 'id', '')}[]"
    if isinstance(node, ast.Attribute):
        return f".{node.attr}"
    return getattr(node, "id", "")


def _given_name(decorator):
    """Text constant naming the tool: first argument, else name= or tool_name=."""
    if not isinstance(decorator, ast.Call):
        return ""
    named = [k.value for k in decorator.keywords if k.arg in ("name", "tool_name")]
    texts = [
        v.value
        for v in decorator.args[:1] + named
        if isinstance(v, ast.Constant) and isinstance(v.value, str)
    ]
    return texts[0] if texts else ""


def _params(fn):
    """Positional parameters; one without a default is required."""
    args = fn.args.posonlyargs + fn.args.args
    first_default = len(args) - len(fn.args.defaults)
    rows = [
        {"name": a.arg, "annotation": _annotation(a.annotation), "required": i < first_default}
        for i, a in enumerate(args)
    ]
    return rows[1:] if rows and rows[0]["name"] in ("self", "cls") else rows


def _statements(tree):
    """All statements, level by level; expressions hold no function definitions."""
    waiting = deque([tree])
    while waiting:
        node = waiting.popleft()
        yield node
        waiting += [c for c in ast.iter_child_nodes(node) if isinstance(c, _NESTING)]


def find(text):
    rows = []
    for fn in _statements(ast.parse(text)):
        if not isinstance(fn, ast.FunctionDef):
            continue
        marks = [d for d in fn.decorator_list if _label(getattr(d, "func", d)) == "tool"]
        if marks:
            doc = (ast.get_docstring(fn) or "").strip().splitlines()
            rows.append(
                {
                    "name": _given_name(marks[0]) or fn.name,
                    "description": doc[0] if doc else "",
                    "params": _params(fn),
                }
            )
    return rows


parse = parsed(find, FOUND)


def may_hold_tools(text: str) -> str:
    """Cheap test (SQL text) that no file with a tool fails.

    A decorator needs ``@`` and the word itself; names outside ASCII may be another
    spelling of the same word, so those files are parsed too.
    """
    spelled = f"(contains({text}, 'tool') OR octet_length({text}) <> length({text}))"
    return f"(contains({text}, '@') AND contains({text}, 'def') AND {spelled})"


def tools(found: str) -> str:
    """``array<struct<pattern_rank,name,description,parameters>>`` of a parsed file."""
    json_type = f"coalesce({lookup('a.annotation', ANNOTATION_TYPES)}, 'string')"
    typed = f"named_struct('name', a.name, 'type', {json_type}, 'required', a.required)"
    return f"""transform({found}, t -> named_struct(
        'pattern_rank', 0,
        'name', t.name,
        'description', t.description,
        'parameters', {parameters_json(f"transform(t.params, a -> {typed})")}))"""
