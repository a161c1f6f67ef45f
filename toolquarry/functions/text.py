"""Text expressions."""

from collections.abc import Mapping


def literal(value: str | int) -> str:
    """SQL literal of a text or number; ``$`` is escaped as ``${…}`` would be replaced."""
    if isinstance(value, int):
        return str(value)
    for char, escape in (("\\", "\\\\"), ("'", "\\'"), ("$", "\\u0024")):
        value = value.replace(char, escape)
    return f"'{value}'"


def trimmed(text: str) -> str:
    """Strip every kind of white space; SQL ``trim`` strips blanks only."""
    return f"regexp_replace({text}, {literal(r'(?U)^\s+|\s+\z')}, '')"


def unix_newlines(text: str) -> str:
    """Turn CR and CR LF into LF; texts without a CR skip the regex."""
    return f"if(contains({text}, '\\r'), regexp_replace({text}, '\\r\\n?', '\\n'), {text})"


def token_count(text: str) -> str:
    """Number of white-space separated tokens of the whole text.

    White space at either end splits off an empty piece; taking those off the count
    is cheaper than trimming the text first.
    """
    return f"""CASE WHEN {text} = '' THEN 0 ELSE
        size(split({text}, {literal(r'(?U)\s+')}))
        - if({text} rlike {literal(r'(?U)\A\s')}, 1, 0)
        - if(right({text}, 1) rlike {literal(r'(?U)\s')}, 1, 0) END"""


def blank_to_null(json_text: str) -> str:
    """Null for JSON text that holds nothing: no text, ``{}``, ``[]``, ``null``."""
    return (
        f"""if(trim({json_text}) IN ('', '{{}}', '[]', 'null', 'false', '0', '""'), NULL, {json_text})"""
    )


def lookup(key: str, table: Mapping[str, str | int]) -> str:
    """Value of a small fixed table, null for keys it does not hold."""
    pairs = ", ".join(literal(x) for item in table.items() for x in item)
    return f"try_element_at(map({pairs}), {key})"


def let(name: str, value: str, body: str) -> str:
    """Evaluate ``value`` once per row and use it by name many times in ``body``.

    Lambdas re-evaluate whatever they mention, so a parsed document must be bound
    before a lambda walks over it.
    """
    return f"transform(array({value}), {name} -> {body})[0]"
