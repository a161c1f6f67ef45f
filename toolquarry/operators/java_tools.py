"""Tools declared in Java files.

Annotated methods need the text that follows an annotation and balanced
parentheses, so a task-side helper cuts them out. Registered, constructed and
built tools are plain regex columns.
"""

import re

from pyspark.sql import types as T

from ..functions import literal, lookup, parameters_json, trimmed
from ..schemas import EMPTY_PARAMETERS, struct
from .brackets import PARENS, QUOTED, bracket_index, closing
from .per_file import parsed

# JSON type by Java type; all else is a string.
JAVA_TYPES = {
    "String": "string",
    "CharSequence": "string",
    "UUID": "string",
    "int": "integer",
    "Integer": "integer",
    "long": "integer",
    "Long": "integer",
    "double": "number",
    "Double": "number",
    "float": "number",
    "Float": "number",
    "BigDecimal": "number",
    "boolean": "boolean",
    "Boolean": "boolean",
}

# What to look for in the sources.
_ANNOTATION = re.compile(r"@(?:McpTool|Tool)\b\s*(?:\(([^)]*)\))?")
_METHOD = re.compile(r"\w[<>,\[\].\s]*\s([A-Za-z_]\w*)\s*\(")
_NAMED = r'(?U)\b(?:name|value)\s*=\s*"([^"]+)"'
_ANY_TEXT = r'"([^"]+)"'
_REGISTERED = r'(?U)\bregisterTool\s*\(\s*"([^"]+)"'
_CONSTRUCTED = (
    r"(?U)\baddTool\s*\(\s*new\s+(?![\d.])[\w.]*Tool\s*\("
    r'\s*"([^"]+)"\s*(?:,\s*"([^"]*)")?'
)
_BUILT = r'(?U)\bTool\s*\.\s*builder\s*\(\s*"([^"]+)"'

_QUOTED = re.compile(QUOTED, re.DOTALL)
_INNERMOST = re.compile(r"\([^()]*\)|<[^<>]*>")

FOUND = struct(arguments=T.StringType(), method=T.StringType(), params=T.StringType())


def _plain_params(text):
    """Parameter list without quoted text, annotation arguments and type arguments."""
    text, left = _QUOTED.sub("", text), 1
    while left:
        text, left = _INNERMOST.subn("", text)
    return text


def find(text):
    rows, at, method = [], -1, None
    index, last = bracket_index(text, PARENS), text.rfind(")")
    for mark in _ANNOTATION.finditer(text):
        if at < mark.end():  # else the method found before still lies ahead
            method = _METHOD.search(text, mark.end())
            at = method.start() if method else len(text)
        row = {"arguments": mark[1], "method": None, "params": None}
        if method:
            end = closing(text, method.end() - 1, PARENS, index) or (method.end() <= last and text.find(")", method.end()) + 1)
            if end:
                row["method"] = method[1]
                row["params"] = _plain_params(text[method.end() : end - 1])
        rows.append(row)
    return rows


parse = parsed(find, FOUND)


def may_hold_tools(text: str) -> str:
    """Cheap test (SQL text) that no file with a tool fails."""
    return f"contains({text}, 'Tool')"


def may_hold_annotations(text: str) -> str:
    """Cheap test (SQL text) that no file with an annotated method fails."""
    return f"(contains({text}, '@Tool') OR contains({text}, '@McpTool'))"


def json_type(java_type: str) -> str:
    """JSON type of a Java type such as ``int[]``, ``java.util.UUID``, ``List<String>``."""
    bare = f"regexp_replace(replace({trimmed(java_type)}, '[]', ''), '<.*?>', '')"
    first = f"regexp_extract({bare}, {literal(r'(?U)^\S*')}, 0)"
    base = f"substring_index({first}, '.', -1)"
    return f"coalesce({lookup(base, JAVA_TYPES)}, 'string')"


def signature_parameters(params: str) -> str:
    """Parameter schema of a plain parameter list; every parameter is required."""
    bare = f"regexp_replace(part, {literal(r'(?U)@\w+\s*')}, '')"
    bare = trimmed(f"regexp_replace({bare}, {literal(r'(?U)\bfinal\b\s+')}, '')")
    words = f"transform(split({params}, ','), part -> split({bare}, {literal(r'(?U)\s+')}))"
    one = f"named_struct('name', element_at(w, -1), 'type', {json_type('w[0]')}, 'required', true)"
    named = f"transform(filter({words}, w -> size(w) >= 2), w -> {one})"
    return f"coalesce({parameters_json(named)}, {literal(EMPTY_PARAMETERS)})"


def _tool(rank: int, name: str, description: str = "''", parameters: str = literal(EMPTY_PARAMETERS)) -> str:
    return f"""named_struct(
        'pattern_rank', {rank},
        'name', {trimmed(name)},
        'description', {description},
        'parameters', {parameters})"""


def annotated_tools(found: str) -> str:
    """``@Tool`` / ``@McpTool`` methods, named by the annotation or the method."""
    by_annotation = [
        f"nullif({trimmed(f'regexp_extract(t.arguments, {literal(p)}, 1)')}, '')" for p in (_NAMED, _ANY_TEXT)
    ]
    name = f"coalesce({', '.join(by_annotation)}, t.method, '')"
    tool = _tool(0, name, parameters=signature_parameters("t.params"))
    return f"coalesce(transform({found}, t -> {tool}), array())"


def _matches(text: str, word: str, pattern: str, group: int = 1) -> str:
    """All matches; a text without the word, a part of any match, skips the regex."""
    found = f"regexp_extract_all({text}, {literal(pattern)}, {group})"
    return f"if(contains({text}, {literal(word)}), {found}, CAST(array() AS array<string>))"


def registered_tools(text: str) -> str:
    """``registerTool("name", …)``."""
    return f"transform({_matches(text, 'registerTool', _REGISTERED)}, n -> {_tool(1, 'n')})"


def constructed_tools(text: str) -> str:
    """``addTool(new …Tool("name", "description", …))``."""
    names, descriptions = (_matches(text, "addTool", _CONSTRUCTED, group) for group in (1, 2))
    return f"zip_with({names}, {descriptions}, (n, d) -> {_tool(2, 'n', trimmed('d'))})"


def built_tools(text: str) -> str:
    """``Tool.builder("name")``."""
    return f"transform({_matches(text, 'builder', _BUILT)}, n -> {_tool(3, 'n')})"


def tools(found: str, text: str) -> str:
    """``array<struct<pattern_rank,name,description,parameters>>`` of a file."""
    legs = [annotated_tools(found), registered_tools(text), constructed_tools(text), built_tools(text)]
    return f"filter(concat({', '.join(legs)}), t -> t.name <> '')"
