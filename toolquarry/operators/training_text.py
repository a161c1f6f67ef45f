"""From conversations to training text."""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import literal, quoted, token_count
from ..functions.positions import numbered_within
from ..schemas import MESSAGE, TOOL_CALL

# Fixed value: the message put in front of a conversation that brings none.
INSTRUCTION_ROLE = "developer"
INSTRUCTION = "You are a model that can do function calling with the following functions"
_OPENING_ROLES = ("system", "developer")


class ChatTemplate(NamedTuple):
    """Markers around the parts of a rendered conversation.

    The reading model defines its own markers, so callers pass theirs.
    """

    tools_begin: str = "<tools>"
    tools_separator: str = "\n"
    tools_end: str = "</tools>\n"
    turn_begin: str = "<turn:"
    role_end: str = ">"
    name_begin: str = "["
    name_end: str = "]"
    call_begin: str = "<call:"
    call_name_end: str = ">"
    call_end: str = "</call>"
    turn_end: str = "</turn>\n"


# ---- assembling conversations from one row per turn ---------------------------------


def assemble_turns(turns: DataFrame, span: int) -> DataFrame:
    """Conversations as nested rows: ``conv_id, part, first, messages`` in turn order.

    ``turns`` holds ``conv_id, turn, role, text``. ``part`` is ``floor(turn / span)``, so no
    task has to hold more than ``span`` turn numbers of a conversation; choose a span that
    one row can hold. Read the parts in order to get a conversation back. ``first`` marks its
    part with the lowest turn, found by a minimum that reads no text. Turns should be
    numbered densely: gaps give more parts and lose nothing. A null turn counts as 0, and
    turns of equal numbers are ordered by role and text; many of them are for ``number_turns``.
    """
    part = F.floor(F.coalesce("turn", F.lit(0)) / span).cast("bigint")
    rows = turns.select("conv_id", part.alias("part"), "turn", "role", "text")
    # Lists do not shrink map-side: shuffle the rows, then collect.
    collected = rows.repartition("conv_id", "part").groupBy("conv_id", "part").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("_turns")
    )
    message = lambda t: F.struct(
        t["role"].alias("role"),
        t["text"].alias("content"),
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast(f"array<{TOOL_CALL}>").alias("tool_calls"),
    )
    messages = F.transform("_turns", message).cast(f"array<{MESSAGE}>")
    lowest = rows.groupBy(F.col("conv_id").alias("_conv")).agg(F.min("part").alias("_lowest"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    return collected.join(lowest, same).select(
        "conv_id", "part", (F.col("part") == F.col("_lowest")).alias("first"), messages.alias("messages")
    )


def number_turns(turns: DataFrame, work_path: str) -> DataFrame:
    """``turns`` with dense turn numbers, so that ``assemble_turns`` cuts parts by position.

    Turns are numbered from 0 in the order of their own numbers (null first), roles and texts,
    within each conversation: null, equal and sparse numbers split into parts of ``span`` turns
    like others. The sorted turns are kept below ``work_path``.
    """
    numbered = numbered_within(turns, ["conv_id"], [F.asc_nulls_first("turn"), "role", "text"], work_path, "_number")
    return numbered.withColumn("turn", F.col("_number")).drop("_number")


# ---- samples ------------------------------------------------------------------------


def add_instruction(samples: DataFrame) -> DataFrame:
    """Put the instruction message in front unless a sample opens with one.

    Of a conversation in parts only the first one gets it.
    """
    none = F.array().cast(f"array<{MESSAGE}>")
    messages = F.coalesce("messages", none)
    opening = F.get(messages, F.lit(0))["role"]
    instruction = F.struct(
        F.lit(INSTRUCTION_ROLE).alias("role"),
        F.lit(INSTRUCTION).alias("content"),
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast(f"array<{TOOL_CALL}>").alias("tool_calls"),
    )
    with_it = F.concat(F.array(instruction).cast(f"array<{MESSAGE}>"), messages)
    has_one = F.coalesce(opening.isin(*_OPENING_ROLES), F.lit(False))
    if "first" in samples.columns:
        has_one = has_one | ~F.col("first")
    return samples.withColumn("messages", F.when(has_one, messages).otherwise(with_it))


def entry_json(catalog: DataFrame) -> Column:
    """JSON text of a catalog entry, unknown keys included; null fields are left out."""

    def inside(json_object: str) -> list[str]:
        known = json_object in catalog.columns
        return [f"nullif(substr({json_object}, 2, length({json_object}) - 2), '')"] if known else []

    function = [
        f"""concat('"name":', {quoted('name')})""",
        f"""concat('"description":', {quoted('description')})""",
        """concat('"parameters":', parameters)""",
        *inside("function_extra"),
    ]
    entry = [
        f"""concat('"type":', {quoted('type')})""",
        f"""concat('"function":{{', concat_ws(',', {', '.join(function)}), '}}')""",
        *inside("extra"),
    ]
    return F.expr(f"concat('{{', concat_ws(',', {', '.join(entry)}), '}}')")


def catalog_entries(catalog: DataFrame) -> DataFrame:
    """``ord, name, entry``: entries as JSON text in catalog order.

    Without an ``ord`` column the catalog is taken to be in name order.
    """
    ord_ = F.col("ord") if "ord" in catalog.columns else F.lit(0)
    return catalog.select(ord_.alias("ord"), "name", entry_json(catalog).alias("entry"))


#: Key of the list of all tools, for samples that name none.
ALL_TOOLS = "*"


def tools_key() -> Column:
    """Names which tools a sample may call: its distinct names, or all of them."""
    names = F.array_sort(F.array_distinct(F.coalesce("tool_names", F.array().cast("array<string>"))))
    return F.when(F.size(names) > 0, F.to_json(names)).otherwise(F.lit(ALL_TOOLS))


def tool_lists(samples: DataFrame, catalog: DataFrame) -> DataFrame:
    """``tools_key, tools``: the catalog entries (JSON text) behind each key of ``samples``.

    Samples share few different lists of names, so the lists are made distinct first (one
    column, map-side) and resolved once. The whole catalog is one of them, and only where a
    sample asks for it. Entries keep catalog order and unknown names are dropped; a key that
    names no known tool has no row.
    """
    entries = catalog_entries(catalog)
    asked = samples.select(tools_key().alias("tools_key")).distinct()
    named = asked.where(F.col("tools_key") != ALL_TOOLS)
    named = named.select("tools_key", F.explode(F.from_json("tools_key", "array<string>")).alias("name"))
    every = asked.where(F.col("tools_key") == ALL_TOOLS)
    # one row of a key that is asked for beside all entries: a condition, not a product
    entries = entries.withColumn("_all", F.lit(ALL_TOOLS))
    found = named.join(entries, "name").select("tools_key", "ord", "name", "entry")
    found = found.unionByName(
        entries.join(every, F.col("_all") == F.col("tools_key")).select("tools_key", "ord", "name", "entry")
    )
    tools = F.array_sort(F.collect_list(F.struct("ord", "name", "entry")))
    return found.groupBy("tools_key").agg(F.transform(tools, lambda t: t["entry"]).alias("tools"))


def select_tools(samples: DataFrame, catalog: DataFrame, lists: DataFrame | None = None) -> DataFrame:
    """Add ``tools``: the catalog entries (JSON text) each sample may call.

    A sample that names none gets the whole catalog, as a row of its own text; use
    ``tools_key`` and ``tool_lists`` to keep both apart at scale. ``lists`` is a stored
    ``tool_lists``, which saves deriving it from the samples once more. Nothing is measured
    beforehand: adaptive execution chooses the join and divides a list that many share.
    """
    lists = tool_lists(samples, catalog) if lists is None else lists
    joined = samples.withColumn("tools_key", tools_key()).join(lists, "tools_key", "left")
    tools = F.coalesce("tools", F.array().cast("array<string>"))
    return joined.select(*samples.columns, tools.alias("tools"))


def render_message(message: str, template: ChatTemplate) -> str:
    """Text of one message (SQL text)."""
    t = ChatTemplate(*map(literal, template))
    call = f"""concat({t.call_begin}, coalesce(c.function.name, ''), {t.call_name_end},
        coalesce(c.function.arguments, '{{}}'), {t.call_end})"""
    return f"""concat(
        {t.turn_begin}, coalesce({message}.role, ''), {t.role_end},
        coalesce(concat({t.name_begin}, {message}.name, {t.name_end}), ''),
        coalesce({message}.content, ''),
        coalesce(array_join(transform({message}.tool_calls, c -> {call}), ''), ''),
        {t.turn_end})"""


def render_chat(samples: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """Add ``text``: the tools, if the sample has any, then all messages.

    Of a conversation in parts only the first one shows the tools.
    """
    turns = F.expr(f"array_join(transform(messages, m -> {render_message('m', template)}), '')")
    if "tools" not in samples.columns:
        return samples.withColumn("text", turns)
    listed = F.concat(
        F.lit(template.tools_begin),
        F.array_join("tools", template.tools_separator),
        F.lit(template.tools_end),
    )
    shown = F.size("tools") > 0
    if "first" in samples.columns:
        shown = shown & F.col("first")
    head = F.when(shown, listed).otherwise(F.lit(""))
    return samples.withColumn("text", F.concat(head, turns))


def format_samples(
    samples: DataFrame,
    catalog: DataFrame,
    template: ChatTemplate = ChatTemplate(),
    lists: DataFrame | None = None,
) -> DataFrame:
    """Training text of each sample: instruction, tool selection, rendering."""
    return (
        samples.transform(add_instruction)
        .transform(select_tools, catalog, lists)
        .transform(render_chat, template)
    )


def mark_budget(texts: DataFrame, budget: int) -> DataFrame:
    """Add ``n_tokens_proxy, over_budget``; tokens are white-space separated words.

    A stand-in for a tokenizer, which is part of the model and not of the data.
    """
    counted = texts.withColumn("n_tokens_proxy", F.expr(token_count("text")))
    return counted.withColumn("over_budget", F.col("n_tokens_proxy") > budget)


def budget_counts(texts: DataFrame, budget: int, *by: str) -> DataFrame:
    """Texts and over-budget texts per given columns."""
    return (
        mark_budget(texts, budget)
        .groupBy(*by)
        .agg(F.count(F.lit(1)).alias("texts"), F.count_if("over_budget").alias("over_budget"))
    )
