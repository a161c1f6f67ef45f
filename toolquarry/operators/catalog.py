"""The tool catalog: one entry per tool name."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import blank_to_null, json_items, last_values, let
from ..schemas import EMPTY_PARAMETERS
from .extract import ORDER

_KEPT = ("type", "description", "parameters", "extra", "function_extra")


def to_entries(tool_defs: DataFrame) -> DataFrame:
    """Catalog entries of tool definitions, with nothing left null."""
    return tool_defs.select(
        F.lit("function").alias("type"),
        "name",
        F.coalesce("description", F.lit("")).alias("description"),
        F.coalesce(F.expr(blank_to_null("parameters")), F.lit(EMPTY_PARAMETERS)).alias("parameters"),
    )


def merge_tools(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Merge tool definitions into a catalog by name.

    An existing entry wins over incoming ones and the last of several existing
    entries wins among them. Incoming definitions, in discovery order, fill a
    missing description or parameter schema only. Entries without a name vanish;
    ``nameless_entries`` counts them.

    One aggregate over the union of both sides: every function in it combines
    map-side, so a name that fills a third of all rows shuffles one row per task.
    """
    old = existing.select("name", F.col("ord").alias("_old"), *_KEPT)
    new = incoming.select(
        "name",
        F.struct(*ORDER).alias("_new"),
        F.coalesce("description", F.lit("")).alias("description"),
        F.coalesce(F.expr(blank_to_null("parameters")), F.lit(EMPTY_PARAMETERS)).alias("parameters"),
    )
    has_text = F.coalesce(F.col("description"), F.lit("")) != ""
    is_new = F.col("_new").isNotNull()
    merged = (
        old.unionByName(new, allowMissingColumns=True)
        .filter(F.coalesce(F.col("name"), F.lit("")) != "")
        .groupBy("name")
        .agg(
            F.max_by(F.struct(*_KEPT), "_old").alias("kept"),
            F.min_by("description", F.when(is_new & has_text, F.col("_new"))).alias("described"),
            F.min_by("parameters", "_new").alias("typed"),
        )
    )
    kept = F.col("kept")
    is_kept = kept.isNotNull()
    return merged.select(
        F.when(is_kept, kept["type"]).otherwise(F.lit("function")).alias("type"),
        "name",
        F.coalesce(
            F.nullif(kept["description"], F.lit("")),
            "described",
            F.when(is_kept, kept["description"]).otherwise(F.lit("")),
        ).alias("description"),
        F.coalesce(F.expr(blank_to_null("kept.parameters")), "typed", kept["parameters"]).alias("parameters"),
        kept["extra"].alias("extra"),
        kept["function_extra"].alias("function_extra"),
    )


def nameless_entries(existing: DataFrame) -> DataFrame:
    """How many entries a merge drops for want of a name."""
    nameless = F.coalesce(F.col("name"), F.lit("")) == ""
    return existing.agg(F.count_if(nameless).alias("nameless"))


def sort_catalog(catalog: DataFrame) -> DataFrame:
    """Entries in code-point order of their names."""
    return catalog.orderBy("name")


def catalog_counts(catalog: DataFrame, *by: str) -> DataFrame:
    """Number of entries, in total or per given columns."""
    return catalog.groupBy(*by).agg(F.count(F.lit(1)).alias("tools"))


def parse_parameters(parameters: str) -> str:
    """``struct<properties: array<struct<key,value>>, required: array<string>>``.

    One parse; whatever is missing or of the wrong kind is empty.
    """
    shape = "struct<properties:map<string,string>,required:array<string>>"
    parts = f"""named_struct(
        'properties', {last_values('map_entries(doc.properties)')},
        'required', coalesce(doc.required, CAST(array() AS array<string>)))"""
    return let("doc", f"from_json({parameters}, '{shape}')", parts)


def schema_type(kind: str) -> str:
    """The ``type`` of a property schema (raw JSON text); of a list of types the first."""
    first = f"get(from_json({kind}, 'array<string>'), 0)"
    return f"coalesce(if(startswith({kind}, '['), {first}, {kind}), 'string')"


def tool_params(catalog: DataFrame) -> DataFrame:
    """One row per parameter: ``name, param, ord, type, description, enum, required``."""
    parsed = catalog.select("name", F.expr(parse_parameters("parameters")).alias("_parsed"))
    # Outer, so that the optimizer adds no test that parses a second time.
    rows = parsed.select(
        "name",
        F.col("_parsed.required").alias("_required"),
        F.posexplode_outer("_parsed.properties").alias("ord", "_p"),
    ).filter(F.col("ord").isNotNull())
    schema = F.from_json("_p.value", "struct<type:string,description:string,enum:string>")
    return rows.select("*", schema.alias("_schema")).select(
        "name",
        F.col("_p.key").alias("param"),
        "ord",
        F.expr(schema_type("_schema.type")).alias("type"),
        F.coalesce("_schema.description", F.lit("")).alias("description"),
        F.expr(json_items("_schema.enum")).alias("enum"),
        F.array_contains("_required", F.col("_p.key")).alias("required"),
    )
