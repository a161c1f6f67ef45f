"""JSON kept as text.

Objects stay text because key order carries meaning here (parameter order) and
because argument objects differ from tool to tool; a struct would pad every row
with the keys of all others, and a variant would sort the keys.
"""

from .text import let


def quoted(text: str) -> str:
    """JSON string literal of a text value, null for null."""
    return f"if({text} IS NULL, NULL, trim(BOTH '[]' FROM to_json(array({text}))))"


def last_values(entries: str) -> str:
    """Entries of an object (``array<struct<key,value>>``), one per key.

    A repeated key keeps its first place and its last value. Null gives none.
    """
    one_each = "transform(ks, k -> element_at(filter(es, e -> e.key = k), -1))"
    keys = let("ks", "array_distinct(transform(es, e -> e.key))", f"if(size(ks) = size(es), es, {one_each})")
    empty = "CAST(array() AS array<struct<key:string,value:string>>)"
    return let("es", f"coalesce({entries}, {empty})", keys)


def json_items(json_array: str) -> str:
    """Items of a JSON array, each as JSON text."""
    typed = f"try_variant_get(try_parse_json({json_array}), '$', 'array<variant>')"
    item = f"if(schema_of_variant(v) = 'STRING', {quoted('s')}, coalesce(s, 'null'))"
    return f"zip_with(from_json({json_array}, 'array<string>'), {typed}, (s, v) -> {item})"


def parameters_json(params: str) -> str:
    """Parameter schema text from ``array<struct<name,type,required>>``, null for null.

    A repeated name keeps its first place and its last type.
    """
    last = "element_at(filter(ps, p -> p.name = n), -1).type"
    one = f"""concat({quoted('n')}, ':{{"type":"', {last}, '","description":""}}')"""
    required = f"transform(filter(ps, p -> p.required), p -> {quoted('p.name')})"
    return let(
        "ps",
        params,
        f"""concat(
            '{{"type":"object","properties":{{',
            array_join(transform(array_distinct(transform(ps, p -> p.name)), n -> {one}), ','),
            '}},"required":[',
            array_join({required}, ','),
            ']}}')""",
    )
