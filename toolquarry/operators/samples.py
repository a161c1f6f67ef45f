"""Sample conversations made from catalog entries, and appending them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import let, literal, lookup, quoted, trimmed
from ..schemas import MESSAGE, TOOL_CALL
from .catalog import schema_type

# The stand-in value of each JSON type, as JSON text.
DUMMY_VALUES = {
    "string": '"example"',
    "integer": "1",
    "number": "1.0",
    "boolean": "true",
    "array": "[]",
    "object": "{}",
}

# The texts of a generated conversation.
USER_TEXT = ("Use the tool `", "` to help with: ")
TOOL_RESULT = '{"ok": true}'
FINAL_ANSWER = "Done."


_PROPERTY = "struct<type:string,enum:string>"
_TYPED = f"struct<properties:map<string,{_PROPERTY}>,required:array<string>>"
_UNTYPED = "struct<properties:map<string,string>>"


def _value(schema: str) -> str:
    """Stand-in value for a parsed property schema (``_PROPERTY``)."""
    # The reader writes JSON compactly, so a text item starts right after the bracket.
    text = "coalesce(items[0], 'null')"
    item = f"""if(startswith(s.enum, '["'), {quoted(text)}, {text})"""
    listed = let("items", "from_json(s.enum, 'array<string>')", f"if(size(items) > 0, {item}, NULL)")
    typed = lookup(let("kind", "s.type", schema_type("kind")), DUMMY_VALUES)
    value = f"coalesce(if(s.enum IS NULL, NULL, {listed}), {typed}, {literal(DUMMY_VALUES['string'])})"
    return let("s", schema, value)


def dummy_value(schema: str) -> str:
    """JSON text of a stand-in value for a property schema (JSON text); SQL text.

    The first ``enum`` item if there is one, else a value by ``type``.
    """
    return _value(f"from_json({schema}, '{_PROPERTY}')")


def dummy_arguments(parameters: str) -> str:
    """JSON text of an argument object that fills the required parameters; SQL text.

    One parse reads all property schemas. It gives none of them if a single one is not
    an object; only then they are parsed one by one.
    """
    one_by_one = f"""transform_values(
        from_json({parameters}, '{_UNTYPED}').properties, (k, v) -> from_json(v, '{_PROPERTY}'))"""
    parsed = let(
        "doc",
        f"from_json({parameters}, '{_TYPED}')",
        f"""named_struct(
            'properties', map_entries(coalesce(doc.properties, {one_by_one})),
            'required', array_distinct(coalesce(doc.required, CAST(array() AS array<string>))))""",
    )
    # Of a repeated key the last value counts.
    schema = "try_element_at(filter(p.properties, e -> e.key = name), -1).value"
    pairs = f"transform(p.required, name -> concat({quoted('name')}, ':', {_value(schema)}))"
    return let("p", parsed, f"concat('{{', array_join({pairs}, ','), '}}')")


def _message(role: str, content: Column, name: Column | None = None, calls: Column | None = None):
    return F.struct(
        F.lit(role).alias("role"),
        content.alias("content"),
        (F.lit(None).cast("string") if name is None else name).alias("name"),
        (F.lit(None) if calls is None else calls).cast(f"array<{TOOL_CALL}>").alias("tool_calls"),
    )


def generate_samples(catalog: DataFrame) -> DataFrame:
    """One four-message conversation per catalog entry."""
    name = F.col("name")
    before, after = map(literal, USER_TEXT)
    asked = F.expr(trimmed(f"concat({before}, name, {after}, coalesce(description, ''))"))
    call = F.struct(
        F.struct(name.alias("name"), F.expr(dummy_arguments("parameters")).alias("arguments")).alias("function")
    )
    messages = F.array(
        _message("user", asked),
        _message("assistant", F.lit(""), calls=F.array(call)),
        _message("tool", F.lit(TOOL_RESULT), name=name),
        _message("assistant", F.lit(FINAL_ANSWER)),
    )
    return catalog.select(
        F.concat(F.lit("auto-"), name, F.lit("-1")).alias("id"),
        F.array(name).alias("tool_names"),
        messages.cast(f"array<{MESSAGE}>").alias("messages"),
    )


def message_json(message: str) -> str:
    """JSON text of one message (SQL text); null fields are left out.

    Call arguments are JSON text already and go in as the object they are; a text that is
    no JSON is quoted.
    """
    arguments = f"if(try_parse_json(c.function.arguments) IS NULL, {quoted('c.function.arguments')}, c.function.arguments)"
    call = f"""concat('{{"function":{{', concat_ws(',',
        concat('"name":', {quoted('c.function.name')}), concat('"arguments":', {arguments})), '}}}}')"""
    fields = [f"""concat('"{f}":', {quoted(f'{message}.{f}')})""" for f in ("role", "name", "content")]
    calls = f"""concat('"tool_calls":[', array_join(transform({message}.tool_calls, c -> {call}), ','), ']')"""
    return f"concat('{{', concat_ws(',', {', '.join(fields)}, {calls}), '}}')"


def sample_json(samples: DataFrame) -> Column:
    """A sample as one JSON line, call arguments as objects; null fields are left out."""
    messages = f"""concat('"messages":[', array_join(transform(messages, m -> {message_json('m')}), ','), ']')"""
    fields = [f"""concat('"id":', {quoted('id')})""", """concat('"tool_names":', to_json(tool_names))""", messages]
    return F.expr(f"concat('{{', concat_ws(',', {', '.join(fields)}), '}}')")


def new_samples(samples: DataFrame, known_ids: DataFrame) -> DataFrame:
    """Samples whose id is not known yet. Samples without an id always stay.

    Known ids are made distinct before the join. Samples without an id, which match
    nothing, are spread over the tasks by what they hold. Samples are not compared with
    each other, and are read once.
    """
    has_id = F.coalesce(F.col("id"), F.lit("")) != ""
    plain = [c for c, kind in samples.dtypes if "map<" not in kind and "variant" not in kind]
    spread = F.concat(F.lit("-"), F.pmod(F.xxhash64(*plain), F.lit(10_007)).cast("string"))
    key = F.when(has_id, F.concat(F.lit("+"), "id")).otherwise(spread)
    ids = known_ids.select("id").filter(has_id).distinct().select(F.concat(F.lit("+"), "id").alias("_key"))
    return samples.withColumn("_key", key).join(ids, "_key", "left_anti").select(*samples.columns)
