"""Queries over the driver's tables, each with the SQL that states its answer.

The tables hold no program sources and no catalogs, so Spark derives both from
their rows: one file, entry or sample per row of the whole table.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import unix_newlines, work_folder
from .operators import catalog as C
from .operators import extract as X
from .operators import files as S
from .operators import samples as G
from .operators import training_text as R
from .operators.java_tools import json_type
from .schemas import CATALOG, EMPTY_PARAMETERS, MESSAGE
from .sinks import append_samples, catalog_lines, save_catalog, save_samples
from .sources import parse_catalog
from .sources.sample_files import line_ids, read_samples
from .table_functions import register_table_functions

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(sql: str):
    def register(run: Query) -> Query:
        _QUERIES[run.__name__] = run
        _SQL[run.__name__] = sql
        return run

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(*parts: Column | str) -> Column:
    """Concatenate literal text (str) and columns."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _pick(key: str, *choices: Column | str) -> Column:
    """Choice number ``key`` modulo their count."""
    options = [F.lit(c) if isinstance(c, str) else c for c in choices]
    n = len(options)
    picked = F.when(F.col(key) % n == 0, options[0])
    for i, option in enumerate(options[1:], 1):
        picked = picked.when(F.col(key) % n == i, option)
    return picked


def _sql_list(*texts: str) -> str:
    return "[" + ", ".join("'" + t.replace("'", "''") + "'" for t in texts) + "]"


def _params(*fields: tuple[str, str], required: tuple[str, ...] | None = None) -> str:
    """Parameter schema text as the extractors write it."""
    names = [name for name, _ in fields] if required is None else required
    props = ",".join(f'"{n}":{{"type":"{t}","description":""}}' for n, t in fields)
    return (
        f'{{"type":"object","properties":{{{props}}},"required":['
        + ",".join(f'"{n}"' for n in names)
        + "]}"
    )


def _part_files(spark: SparkSession, sf_dir: str, ext: str, content: Column) -> DataFrame:
    """A source file per part. The few columns of part are spread before any text is made of them,
    so that files are parsed by all tasks, however few splits the table has."""
    parts = _table(spark, sf_dir, "part").repartition(spark.sparkContext.defaultParallelism, "p_partkey")
    files = parts.select(
        F.col("p_brand").alias("project"),
        _text("src/f", F.col("p_partkey"), f".{ext}").alias("path"),
        content.cast("binary").alias("content"),
    )
    return files


_FOUND = ("path", "name", "description", "parameters")


def _found(files: DataFrame, *languages: str) -> DataFrame:
    return X.extract_tools(files, languages).select(*_FOUND)


def _sql_found(ext: str, *legs: tuple[str, str, str, str]) -> str:
    """Union of legs ``(name, description, parameters, condition)`` over part."""
    return " UNION ALL ".join(
        f"SELECT 'src/f' || p_partkey || '.{ext}' AS path, {name} AS name, "
        f"{description} AS description, {parameters} AS parameters FROM part WHERE {condition}"
        for name, description, parameters, condition in legs
    )


# ---- source files -------------------------------------------------------------------

_PATHS = (
    "package.json",
    "src/app.tsx",
    "lib/view.jsx",
    "a/mod.mts",
    "a/mod.cts",
    "tools/x.py",
    "web/index.ts",
    "src/T.java",
    "pom.xml",
    "sub/build.gradle",
    "node_modules/m/i.js",
    "README.md",
    "sub/package.json",
    ".hidden/__init__.py",
    "build/gen.ts",
    "builder/gen.tsx",
    "a/Upper.PY",
)
_PATH_SQL = f"({_sql_list(*_PATHS)})[(o_orderkey % {len(_PATHS)} + 1)::INT]"
_PATHS_SQL = (
    f"WITH paths AS (SELECT o_orderkey AS id, 'c' || o_custkey AS project, {_PATH_SQL} AS path FROM orders), "
    "typed AS (SELECT *, regexp_extract(path, '\\.([A-Za-z]+)$', 1) AS ext FROM paths)"
)
_ROUTED_SQL = (
    _PATHS_SQL
    + ", routed AS (SELECT *, CASE WHEN ext = 'py' THEN 'python' WHEN ext = 'java' THEN 'java' ELSE 'node' END AS lang, "
    "CASE WHEN ext IN ('py', 'java') THEN 0 ELSE list_position(['ts','js','mts','cts','tsx','jsx'], ext) - 1 END AS ext_rank "
    "FROM typed WHERE ext IN ('py','java','ts','js','mts','cts','tsx','jsx'))"
)


def _order_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        _text("c", F.col("o_custkey")).alias("project"),
        _pick("o_orderkey", *_PATHS).alias("path"),
    )


@_query(
    _PATHS_SQL + " SELECT id, project, path FROM paths WHERE NOT list_has_any(string_split(path, '/'), "
    "['.git','.venv','venv','env','__pycache__','node_modules','dist','build','target','.idea','.vscode'])"
)
def excluded_paths(spark, sf_dir):
    return S.drop_excluded(_order_paths(spark, sf_dir))


@_query(
    _ROUTED_SQL + " SELECT id, path, ext, lang, CASE lang WHEN 'python' THEN 0 WHEN 'node' THEN 1 ELSE 2 END AS lang_rank, "
    "ext_rank FROM routed"
)
def file_routing(spark, sf_dir):
    routed = S.route_files(_order_paths(spark, sf_dir))
    return routed.select("id", "path", "ext", "lang", "lang_rank", "ext_rank")


@_query(_ROUTED_SQL + " SELECT id, path, lang FROM routed WHERE lang IN ('python', 'java')")
def language_filter(spark, sf_dir):
    routed = S.route_files(_order_paths(spark, sf_dir))
    return S.keep_languages(routed, S.parse_languages("java, cobol ,python")).select("id", "path", "lang")


@_query(
    _PATHS_SQL + " SELECT project, concat_ws(',', "
    "CASE WHEN bool_or(ext = 'java' OR path IN ('pom.xml', 'sub/build.gradle')) THEN 'java' END, "
    "CASE WHEN bool_or(path = 'package.json' OR ext IN ('ts', 'js')) THEN 'node' END, "
    "CASE WHEN bool_or(ext = 'py') THEN 'python' END) AS languages FROM typed GROUP BY project"
)
def project_languages(spark, sf_dir):
    seen = S.project_languages(_order_paths(spark, sf_dir))
    return seen.select("project", F.array_join("languages", ",").alias("languages"))


@_query(
    _ROUTED_SQL + " SELECT id, project, path FROM routed WHERE ext IN ('py', 'java', 'ts', 'js') OR project IN "
    "(SELECT project FROM typed WHERE path = 'package.json' OR ext IN ('ts', 'js'))"
)
def detected_files(spark, sf_dir):
    paths = _order_paths(spark, sf_dir)
    return S.keep_detected(S.route_files(paths), paths).select("id", "project", "path")


@_query(
    "SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN p_name || chr(10) || 'é' || chr(10) || p_type "
    "ELSE chr(65279) || p_name END AS text FROM part WHERE p_partkey % 4 <> 3"
)
def valid_text_files(spark, sf_dir):
    name = F.col("p_name").cast("binary")
    content = _pick(
        "p_partkey",
        name,
        _text(F.col("p_name"), "\r\né\r", F.col("p_type")).cast("binary"),
        F.concat(F.unhex(F.lit("EFBBBF")), name),
        F.concat(name, F.unhex(F.lit("EDA080"))),
    )
    files = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), content.alias("content"))
    return S.decode_text(S.valid_text_files(files)).select("id", "text")


# ---- tool extraction ----------------------------------------------------------------


@_query(
    _sql_found(
        "py",
        (
            "'t' || p_partkey",
            "p_name || '.'",
            f"'{_params(('size', 'integer'), ('brand', 'string'), required=('size',))}'",
            "p_partkey % 6 = 1",
        ),
        (
            "'h' || p_partkey",
            "''",
            f"'{_params(('a', 'string'), ('b', 'number'), required=('a',))}'",
            "p_partkey % 6 = 2",
        ),
        (
            "'t' || p_partkey",
            "p_type",
            f"'{_params(('items', 'array'), ('more', 'object'), required=('items',))}'",
            "p_partkey % 6 = 3",
        ),
        ("'a' || p_partkey", "''", f"'{_params(('x', 'boolean'))}'", "p_partkey % 6 = 5"),
        ("'b' || p_partkey", "''", f"'{EMPTY_PARAMETERS}'", "p_partkey % 6 = 5"),
    )
)
def python_tools(spark, sf_dir):
    return _found(_python_files(spark, sf_dir), "python")


def _python_files(spark, sf_dir):
    key, name = F.col("p_partkey"), F.col("p_name")
    content = _pick(
        "p_partkey",
        _text('@mcp.tool("t', key, '")\ndef f(size: int:\n    pass\n'),
        _text(
            '@mcp.tool("t', key, '")\ndef f(size: int, brand: str = "x"):\n    """', name,
            '.\n\n    More text.\n    """\n',
        ),
        _text(
            '@tool(name="t', key, '")\nasync def g(a): pass\n\n@tool\ndef h', key,
            "(a, b: Optional[float] = None, *c, d: int): pass\n",
        ),
        _text(
            'class C:\n    @server.tool(tool_name="t', key,
            '")\n    def m(self, items: List[int], more: dict = {}):\n        """', F.col("p_type"), '"""\n',
        ),
        "# no tool in here\n@cache\ndef f(): pass\n",
        _text("@tool\ndef a", key, '(x: bool): pass\n\n@tool("b', key, '")\ndef z(): pass\n'),
    )
    return _part_files(spark, sf_dir, "py", content)


@_query(
    "SELECT 'src/f' || p_partkey || '.py' AS path, 'syntax_error' AS reason FROM part WHERE p_partkey % 6 = 0"
)
def skipped_files(spark, sf_dir):
    scanned = X.scan_files(_python_files(spark, sf_dir), ["python"])
    return X.skipped_files(scanned).select("path", "reason")


def _found_in_sql(spark, files, function):
    register_table_functions(spark)
    query = f"SELECT f.path, t.name, t.description, t.parameters FROM {{files}} f, LATERAL {function}(CAST(f.content AS STRING)) t"
    return spark.sql(query, files=files)


@_query(_SQL["python_tools"])
def sql_python_tools(spark, sf_dir):
    return _found_in_sql(spark, _python_files(spark, sf_dir), "python_tools")


_ANNOTATIONS = {
    "str": "string",
    "int": "integer",
    "float": "number",
    "bool": "boolean",
    "dict": "object",
    "list": "array",
    "List[int]": "array",
    "typing.Sequence": "array",
    "Mapping[str, int]": "object",
    "typing.Dict": "object",
    "Optional[int]": "integer",
    "Union[bool, None]": "boolean",
    "Optional[List[str]]": "array",
    "int | None": "string",
    "typing.List[int]": "string",
    "tuple[int, int]": "string",
    "Custom": "string",
}


@_query(
    "SELECT 't' || p_partkey AS name, "
    f"'{_params(('v', '%')).split('%')[0]}' || "
    f"({_sql_list(*_ANNOTATIONS.values())})[(p_partkey % {len(_ANNOTATIONS)} + 1)::INT] || "
    f"'{_params(('v', '%')).split('%')[1]}' AS parameters FROM part"
)
def python_annotations(spark, sf_dir):
    content = _text(
        "@tool\ndef t", F.col("p_partkey"), "(v: ", _pick("p_partkey", *_ANNOTATIONS), "): pass\n"
    )
    return _found(_part_files(spark, sf_dir, "py", content), "python").select("name", "parameters")


@_query(
    _sql_found(
        "ts",
        (
            "'n' || p_partkey",
            "p_name",
            '\'{"type":"object","properties":{"size":{"type":"integer","enum":[\' || p_size || \',7]}},"required":["size"]}\'',
            "p_partkey % 3 < 2",
        ),
        ("'n' || p_partkey", "p_name", f"'{EMPTY_PARAMETERS}'", "p_partkey % 3 = 2"),
    )
)
def node_json_tools(spark, sf_dir):
    return _found(_node_files(spark, sf_dir), "node")


def _node_files(spark, sf_dir):
    size = F.col("p_size")
    schema = _pick(
        "p_partkey",
        _text('{"type": "object", "properties": {"size": {"type": "integer", "enum": [', size, ', 7]}}, "required": ["size"]}'),
        _text("{ type: 'object', properties: { size: { type: 'integer', enum: [", size, ", 7,] }, }, required: ['size'] }"),
        "{ size: z.number() }",
    )
    content = _text(
        "// it's a comment (\nserver.registerTool(\n  'n", F.col("p_partkey"), "',\n  {\n    /* }, */ description: \"",
        F.col("p_name"), "\",\n    inputSchema: ", schema, ",\n    note: `), }`\n  },\n  async (a) => ({ ok: [1, 2] })\n);\n",
    )
    return _part_files(spark, sf_dir, "ts", content)


@_query(
    _sql_found(
        "js",
        (
            "'z' || p_partkey",
            "p_type",
            "'{\"type\":\"object\",\"properties\":{\"size\":{\"type\":\"string\",\"description\":\"\"},\"a' || p_partkey || '\":{\"type\":\"string\",\"description\":\"\"}},"
            "\"required\":[\"a' || p_partkey || '\",\"size\"]}'",
            "p_partkey % 2 = 0",
        ),
        ("'o' || p_partkey", "''", f"'{EMPTY_PARAMETERS}'", "p_partkey % 2 = 1"),
    )
)
def node_zod_tools(spark, sf_dir):
    key = F.col("p_partkey")
    content = _pick(
        "p_partkey",
        _text(
            'registerTool("z', key, '", { description: `', F.col("p_type"),
            "`, inputSchema: z.object({ size: z.number().min(1), a", key, ": z.string(), size: z.any() }).strict() }, run)",
        ),
        _text("tool({ name: ' o", key, " ', inputSchema: z.object(Shape) }, run); tool(name, {}); toolbox('x')"),
    )
    return _found(_part_files(spark, sf_dir, "js", content), "node")


@_query(
    _sql_found(
        "java",
        (
            "'j' || p_partkey",
            "''",
            f"'{_params(('text', 'string'), ('times', 'integer'), ('all', 'string'))}'",
            "p_partkey % 3 = 0",
        ),
        ("'m' || p_partkey", "''", f"'{_params(('price', 'number'))}'", "p_partkey % 3 = 1"),
        ("p_name", "''", f"'{EMPTY_PARAMETERS}'", "p_partkey % 3 = 2"),
    )
)
def java_annotated_tools(spark, sf_dir):
    return _found(_java_files(spark, sf_dir), "java")


def _java_files(spark, sf_dir):
    key = F.col("p_partkey")
    content = _pick(
        "p_partkey",
        _text(
            '@McpTool(name = "j', key,
            '")\npublic String m(@P(description = "a, (b)") String text, final int times, Map<String, List<String>> all) {}',
        ),
        _text("@Tool\n  @Override\n  protected static double m", key, "(double price) {}\n@ToolParam int x(int y) {}"),
        _text('@Tool(description = "', F.col("p_name"), '")\nvoid run() {}'),
    )
    return _part_files(spark, sf_dir, "java", content)


@_query(_SQL["node_json_tools"])
def sql_node_tools(spark, sf_dir):
    return _found_in_sql(spark, _node_files(spark, sf_dir), "node_tools")


@_query(_SQL["java_annotated_tools"])
def sql_java_tools(spark, sf_dir):
    return _found_in_sql(spark, _java_files(spark, sf_dir), "java_tools")


@_query(
    _sql_found(
        "java",
        ("'c' || p_partkey", "p_name", f"'{EMPTY_PARAMETERS}'", "p_partkey % 3 = 0"),
        ("'c' || p_partkey", "''", f"'{EMPTY_PARAMETERS}'", "p_partkey % 3 = 1"),
    )
)
def java_ctor_tools(spark, sf_dir):
    key = F.col("p_partkey")
    content = _pick(
        "p_partkey",
        _text('s.addTool(new Tool("c', key, '", " ', F.col("p_name"), ' ", x));'),
        _text('s.addTool( new a.b.MathTool ( "c', key, '"));'),
        _text('s.addTool(new ToolImpl("c', key, '"));'),
    )
    return _found(_part_files(spark, sf_dir, "java", content), "java")


@_query(
    _sql_found(
        "java",
        ("'b' || p_partkey", "''", f"'{EMPTY_PARAMETERS}'", "true"),
        ("p_brand", "''", f"'{EMPTY_PARAMETERS}'", "true"),
    )
)
def java_builder_tools(spark, sf_dir):
    content = _text(
        'Tool.builder("b', F.col("p_partkey"), '").description("x").build();\nTool . builder ( "', F.col("p_brand"), '" );'
    )
    return _found(_part_files(spark, sf_dir, "java", content), "java")


@_query(
    _sql_found(
        "java",
        ("'r' || p_partkey", "''", f"'{EMPTY_PARAMETERS}'", "true"),
        ("p_type", "''", f"'{EMPTY_PARAMETERS}'", "p_partkey % 2 = 0"),
    )
)
def java_register_tools(spark, sf_dir):
    content = _text(
        'server.registerTool("r', F.col("p_partkey"), '", x -> 1);\n',
        _pick("p_partkey", _text('registerTool(\n  "', F.col("p_type"), '")'), 'unregisterTool("x"); registerTool(name)'),
    )
    return _found(_part_files(spark, sf_dir, "java", content), "java")


_JAVA_TYPES = {
    "String": "string",
    "java.util.UUID": "string",
    "int": "integer",
    "Long": "integer",
    "int[]": "integer",
    "double": "number",
    "java.math.BigDecimal": "number",
    "boolean": "boolean",
    "List<Integer>": "string",
    "Map<String, List<String>>": "string",
    "Integer ": "integer",
}


@_query(
    f"SELECT p_partkey AS id, ({_sql_list(*_JAVA_TYPES.values())})[(p_partkey % {len(_JAVA_TYPES)} + 1)::INT] AS json_type FROM part"
)
def java_type_map(spark, sf_dir):
    java_type = _pick("p_partkey", *_JAVA_TYPES)
    types = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), java_type.alias("t"))
    return types.select("id", F.expr(json_type("t")).alias("json_type"))


@_query(
    "SELECT CASE doc_id % 3 WHEN 0 THEN 'python' WHEN 1 THEN 'node' ELSE 'java' END AS lang, 'd' || doc_id AS name, "
    "CASE doc_id % 3 WHEN 2 THEN '' ELSE source END AS description, CASE doc_id % 3 "
    f"WHEN 0 THEN '{_params(('n_chars', 'integer'))}' WHEN 1 THEN '{_params(('text', 'string'))}' "
    f"ELSE '{_params(('text', 'string'), ('limit', 'integer'))}' END AS parameters FROM documents"
)
def document_sources(spark, sf_dir):
    """All languages in one scan; every file carries a whole document as comment."""
    text = F.regexp_replace(F.expr(unix_newlines("text")), r"\*/", "* /")
    key, source = F.col("doc_id"), F.col("source")
    content = _pick(
        "doc_id",
        _text(
            "# ", F.replace(text, F.lit("\n"), F.lit("\n# ")), '\n@mcp.tool("d', key,
            '")\ndef f(n_chars: int):\n    """', source, '"""\n',
        ),
        _text(
            "/* ", text, ' */\nserver.registerTool("d', key, '", { description: "', source,
            '", inputSchema: z.object({ text: z.string() }) }, run);\n',
        ),
        _text("/* ", text, ' */\n@Tool("d', key, '")\npublic String f(String text, int limit) {}\n'),
    )
    files = _table(spark, sf_dir, "documents").select(
        F.col("source").alias("project"),
        _text("d", key, _pick("doc_id", ".py", ".ts", ".java")).alias("path"),
        content.cast("binary").alias("content"),
    )
    return X.extract_tools(files).select("lang", "name", "description", "parameters")


# ---- catalog ------------------------------------------------------------------------

_SHAPE = '{"type":"object","properties":{"x":{"type":"string"}},"required":["x"]}'
# A third of all rows carries the same name.
_TOOL_SQL = "CASE WHEN o_orderkey % 3 = 0 THEN 'common' ELSE 'c' || o_custkey END"
_DESCRIPTION_SQL = "CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderpriority || o_orderkey END"
_PARAMETERS_SQL = f"CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '{{}}' ELSE '{_SHAPE}' END"
_MERGED_SQL = (
    f"SELECT name, coalesce(nullif(arg_max(description, id) FILTER (WHERE old), ''), "
    "arg_min(description, id) FILTER (WHERE NOT old AND description <> ''), '') AS description, "
    "coalesce(arg_max(parameters, id) FILTER (WHERE old AND parameters <> '{}' AND id = top), "
    "arg_min(parameters, id) FILTER (WHERE NOT old), arg_max(parameters, id) FILTER (WHERE old AND id = top)) AS parameters "
    "FROM (SELECT *, max(id) FILTER (WHERE old) OVER (PARTITION BY name) AS top FROM "
    f"(SELECT o_orderkey AS id, o_orderkey % 5 < 2 AS old, {_TOOL_SQL} AS name, {_DESCRIPTION_SQL} AS description, "
    f"CASE WHEN o_orderkey % 5 < 2 THEN {_PARAMETERS_SQL} ELSE coalesce(nullif({_PARAMETERS_SQL}, '{{}}'), '{EMPTY_PARAMETERS}') END AS parameters "
    "FROM orders)) GROUP BY name"
)


def _tool_rows(spark, sf_dir):
    key = F.col("o_orderkey")
    return _table(spark, sf_dir, "orders").select(
        key.alias("id"),
        F.when(key % 3 == 0, F.lit("common")).otherwise(_text("c", F.col("o_custkey"))).alias("name"),
        F.when(F.col("o_orderstatus") == "F", F.lit("")).otherwise(_text(F.col("o_orderpriority"), key)).alias("description"),
        F.when(key % 4 == 1, F.lit("{}")).when(key % 4 > 1, F.lit(_SHAPE)).alias("parameters"),
    )


def _order_tools(spark, sf_dir):
    """Existing entries and incoming definitions from orders."""
    rows = _tool_rows(spark, sf_dir)
    existing = rows.filter(F.col("id") % 5 < 2).select(
        F.col("id").alias("ord"),
        F.lit("function").alias("type"),
        "name",
        "description",
        "parameters",
        F.lit(None).cast("string").alias("extra"),
        F.lit(None).cast("string").alias("function_extra"),
    )
    incoming = rows.filter(F.col("id") % 5 >= 2).select(
        F.lit("p").alias("project"),
        F.lit("a.py").alias("path"),
        F.lit("python").alias("lang"),
        *[F.lit(0).alias(c) for c in ("lang_rank", "ext_rank", "pattern_rank")],
        F.col("id").alias("ordinal"),
        "name",
        "description",
        "parameters",
    )
    return existing, incoming


def _merged(spark, sf_dir):
    return C.merge_tools(*_order_tools(spark, sf_dir))


@_query(_MERGED_SQL)
def merge_catalog(spark, sf_dir):
    return C.sort_catalog(_merged(spark, sf_dir)).select("name", "description", "parameters")


@_query(
    f"SELECT 'function' AS type, {_TOOL_SQL} AS name, {_DESCRIPTION_SQL} AS description, "
    f"coalesce(nullif({_PARAMETERS_SQL}, '{{}}'), '{EMPTY_PARAMETERS}') AS parameters FROM orders"
)
def catalog_entries(spark, sf_dir):
    return C.to_entries(_tool_rows(spark, sf_dir))


@_query(
    "SELECT p_brand AS project, 'python' AS lang, CAST(sum(CASE p_partkey % 6 WHEN 5 THEN 2 ELSE 1 END) AS BIGINT) AS tools "
    "FROM part WHERE p_partkey % 6 IN (1, 2, 3, 5) GROUP BY p_brand"
)
def catalog_counts(spark, sf_dir):
    return C.catalog_counts(X.extract_tools(_python_files(spark, sf_dir)), "project", "lang")


@_query(
    "WITH n AS (SELECT *, 'c' || p_partkey AS name FROM part) "
    "SELECT name, 'size' AS param, 0 AS ord, 'integer' AS type, p_name AS description, "
    "'[' || p_size || ',\"' || p_type || '\",1.5,null]' AS enum, true AS required FROM n UNION ALL "
    "SELECT name, 'a.b \"' || p_brand || '\"', 1, 'array', '', NULL, false FROM n UNION ALL "
    "SELECT name, 'é', 2, 'string', '', '[]', true FROM n"
)
def tool_params(spark, sf_dir):
    parameters = _text(
        '{"type": "object", "properties": {"size": {"type": ["integer", "null"], "description": "', F.col("p_name"),
        '", "enum": [', F.col("p_size"), ', "', F.col("p_type"), '", 1.5, null]}, "a.b \\"', F.col("p_brand"),
        '\\"": {"type": "array"}, "é": {"enum": []}}, "required": ["é", "size", "x"]}',
    )
    catalog = _table(spark, sf_dir, "part").select(
        _text("c", F.col("p_partkey")).alias("name"), parameters.alias("parameters")
    )
    enum = F.concat(F.lit("["), F.array_join("enum", ","), F.lit("]"))
    return C.tool_params(catalog).withColumn("enum", enum)


@_query(
    "SELECT doc, CAST(x.i AS INTEGER) AS ord, 'function' AS type, 'n' || x.k AS name, x.d AS description, "
    "'{\"type\":\"object\",\"properties\":{\"z\":{},\"b\":{}}}' AS parameters, "
    "'{\"tier\":' || x.k || ',\"meta\":{\"z\":1.0,\"a\":[2,\"é\"]},\"note\":\"q\\\"' || x.k || '\",\"none\":null}' AS extra, "
    "'{\"strict\":true}' AS function_extra FROM (SELECT p_partkey // 10 AS doc, unnest(list_transform(list_sort(list({'k': p_partkey, 'd': p_name})), "
    "lambda e, i: {'i': i - 1, 'k': e.k, 'd': e.d})) AS x FROM part GROUP BY p_partkey // 10)"
)
def catalog_documents(spark, sf_dir):
    """Catalog files of ten entries, read back entry by entry."""
    entry = _text(
        '{"type": "function", "tier": ', F.col("p_partkey"), ', "meta": {"z": 1.0, "a": [2, "é"]}, "note": "q\\"', F.col("p_partkey"),
        '", "none": null, "function": {"name": "n', F.col("p_partkey"),
        '", "description": "', F.col("p_name"),
        '", "parameters": {"type": "object", "properties": {"z": {}, "b": {}}}, "strict": true}}',
    )
    documents = (
        _table(spark, sf_dir, "part")
        .groupBy(F.floor(F.col("p_partkey") / 10).alias("doc"))
        .agg(F.array_sort(F.collect_list(F.struct("p_partkey", entry.alias("entry")))).alias("es"))
        .select(
            "doc",
            F.concat(
                F.lit("[\n"), F.array_join(F.transform("es", lambda e: e["entry"]), ",\n"), F.lit("\n]")
            ).alias("value"),
        )
    )
    return parse_catalog(documents, "doc")


_ENTRY_SQL = (
    "SELECT name, '{\"type\":\"function\",\"function\":{\"name\":\"' || name || '\",\"description\":\"' || description || "
    f"'\"' || coalesce(',\"parameters\":' || parameters, '') || '}}}}' AS entry FROM ({_MERGED_SQL})"
)


@_query(_ENTRY_SQL)
def catalog_json(spark, sf_dir):
    return R.catalog_entries(_merged(spark, sf_dir)).select("name", "entry")


@_query(
    "SELECT left(name, 2) AS doc, '[' || chr(10) || string_agg('  ' || entry, ',' || chr(10) ORDER BY name) || chr(10) || ']' AS text "
    f"FROM ({_ENTRY_SQL}) GROUP BY left(name, 2)"
)
def catalog_texts(spark, sf_dir):
    """Whole catalog files, one for every beginning of a name."""
    merged = _merged(spark, sf_dir).withColumn("doc", F.left("name", F.lit(2)))
    lines = F.array_sort(F.collect_list(F.struct("position", "line")))
    whole = catalog_lines(merged, "doc").groupBy("doc").agg(lines.alias("lines"))
    return whole.select("doc", F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("text"))


# ---- samples ------------------------------------------------------------------------

_EVENT_TYPES = ("string", "integer", "number", "boolean", "array", "object", "weird")
_EVENT_VALUES = ('"example"', "1", "1.0", "true", "[]", "{}", '"example"')
_N = len(_EVENT_TYPES)


@_query(
    f"SELECT event_id AS id, '{{\"' || event_type || '\":' || ({_sql_list(*_EVENT_VALUES)})[(event_id % {_N} + 1)::INT] || "
    "',\"of\":' || CASE event_id % 4 WHEN 0 THEN '\"' || event_type || '\"' WHEN 1 THEN user_id::VARCHAR WHEN 2 THEN '1' ELSE 'null' END || "
    "',\"gone\":\"example\"}' AS arguments FROM events"
)
def dummy_arguments(spark, sf_dir):
    kind = F.col("event_type")
    enum = _pick(
        "event_id",
        _text('["', kind, '", 2]'),
        _text("[", F.col("user_id"), ', "b"]'),
        "[]",
        "[null, 1]",
    )
    parameters = _text(
        '{"required": ["', kind, '", "of", "gone", "of"], "properties": {"of": {"type": ["integer", "null"], "enum": ', enum,
        '}, "', kind, '": {"type": "', _pick("event_id", *_EVENT_TYPES), '"}, "free": {"type": "integer"}}}',
    )
    tools = _table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), parameters.alias("p"))
    return tools.select("id", F.expr(G.dummy_arguments("p")).alias("arguments"))


_GENERATED_SQL = (
    "SELECT 'auto-' || name || '-1' AS id, name AS tool_names, "
    "rtrim('Use the tool `' || name || '` to help with: ' || description) AS asked, "
    "'{\"role\":\"assistant\",\"content\":\"\",\"tool_calls\":[{\"function\":{\"name\":\"' || name || '\",\"arguments\":' || "
    "CASE WHEN parameters LIKE '%\"x\"%' THEN '{\"x\":\"example\"}' ELSE '{}' END || '}}]}' AS call, "
    "'{\"role\":\"tool\",\"name\":\"' || name || '\",\"content\":\"{\\\"ok\\\": true}\"}' AS result, "
    f"'{{\"role\":\"assistant\",\"content\":\"Done.\"}}' AS final FROM ({_MERGED_SQL})"
)


@_query(_GENERATED_SQL)
def generated_samples(spark, sf_dir):
    return _sample_fields(G.generate_samples(_merged(spark, sf_dir)))


def _sample_fields(samples):
    messages = [F.expr(G.message_json(f"messages[{i}]")) for i in range(4)]
    return samples.select(
        "id",
        F.array_join("tool_names", ",").alias("tool_names"),
        F.col("messages")[0]["content"].alias("asked"),
        *[m.alias(n) for m, n in zip(messages[1:], ("call", "result", "final"), strict=True)],
    )


@_query(
    "SELECT '{\"id\":\"' || id || '\",\"tool_names\":[\"' || tool_names || '\"],\"messages\":[{\"role\":\"user\",\"content\":\"' || "
    f"asked || '\"}},' || call || ',' || result || ',' || final || ']}}' AS line FROM ({_GENERATED_SQL})"
)
def sample_lines(spark, sf_dir):
    """Generated samples as they are stored, call arguments as objects."""
    samples = G.generate_samples(_merged(spark, sf_dir))
    return samples.select(G.sample_json(samples).alias("line"))


@_query(_MERGED_SQL)
def stored_catalog(spark, sf_dir):
    """The merged catalog, written as one JSON array in two steps and read back."""
    path = f"{work_folder(spark)}/tools.json"
    merged = _merged(spark, sf_dir)
    first = save_catalog(merged.where("name < 't3'"), path)
    rest = merged.where("NOT name < 't3'").withColumn("ord", F.lit(0))
    return save_catalog(first.unionByName(rest, allowMissingColumns=True), path).select("name", "description", "parameters")


@_query(_GENERATED_SQL)
def stored_samples(spark, sf_dir):
    """Generated samples, written as JSON lines and read back."""
    path = f"{work_folder(spark)}/samples"
    save_samples(G.generate_samples(_merged(spark, sf_dir)), path)
    return _sample_fields(read_samples(spark, path))


@_query(
    "WITH k AS (SELECT 'auto-' || p_partkey || '-1' AS id FROM part WHERE p_size % 2 = 0), "
    "e AS (SELECT event_id, CASE WHEN event_id % 3 > 0 THEN 'auto-' || user_id || '-1' END AS id FROM events), "
    "a AS (SELECT id FROM e WHERE event_id % 2 = 0 AND (id IS NULL OR id NOT IN (SELECT id FROM k))), "
    "b AS (SELECT id FROM e WHERE event_id % 2 = 1 AND (id IS NULL OR id NOT IN "
    "(SELECT id FROM k UNION ALL SELECT id FROM a WHERE id IS NOT NULL))) "
    "SELECT id, count(*) AS n FROM (SELECT * FROM k UNION ALL SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY id"
)
def appended_samples(spark, sf_dir):
    """Samples stored in one go, then two batches appended with a table of known ids."""
    folder = work_folder(spark)
    sample = lambda i: (i.alias("id"), F.array(F.lit("t")).alias("tool_names"), F.expr(f"CAST(array() AS ARRAY<{MESSAGE}>)").alias("messages"))
    known = _table(spark, sf_dir, "part").where("p_size % 2 = 0")
    save_samples(known.select(*sample(_text("auto-", F.col("p_partkey"), "-1"))), f"{folder}/samples")
    event_id = F.when(F.col("event_id") % 3 > 0, _text("auto-", F.col("user_id"), "-1"))
    for half in (0, 1):
        batch = _table(spark, sf_dir, "events").where(f"event_id % 2 = {half}").select(*sample(event_id))
        append_samples(batch, f"{folder}/samples", ids_path=f"{folder}/ids")
    return read_samples(spark, f"{folder}/samples").groupBy("id").agg(F.count("*").alias("n"))


@_query(
    "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'auto-' || user_id || '-1' END AS id FROM events "
    "WHERE event_id % 3 = 0 OR user_id NOT IN (SELECT p_partkey FROM part WHERE p_size % 2 = 0)"
)
def append_new_samples(spark, sf_dir):
    sample_id = F.when(F.col("event_id") % 3 != 0, _text("auto-", F.col("user_id"), "-1"))
    samples = _table(spark, sf_dir, "events").select("event_id", sample_id.alias("id"))
    known = _table(spark, sf_dir, "part").filter(F.col("p_size") % 2 == 0)
    return G.new_samples(samples, known.select(_text("auto-", F.col("p_partkey"), "-1").alias("id")))


@_query(
    "SELECT CASE event_id % 3 WHEN 0 THEN 'e' || event_id ELSE event_id::VARCHAR END AS id FROM events WHERE event_id % 9 < 2"
)
def sample_line_ids(spark, sf_dir):
    """Ids of sample lines among blank, malformed and other lines."""
    key = F.col("event_id")
    line = _pick(
        "event_id",
        _text('\t {"tool_names": [], "id": "e', key, '", "messages": [{"role": "user"}]} '),
        _text('{"id": ', key, "}"),
        _text('{"id": "e', key, '"}{"id": "x"}'),
        _text('{"id": "e', key, '",}'),
        _text('[{"id": "e', key, '"}]'),
        "",
        _text('{"id": null, "n": ', key, "}"),
        _text("{'id': ", key, "}"),
        _text('"', key, '"'),
    )
    return line_ids(_table(spark, sf_dir, "events").select(line.alias("value")))


# ---- training text ------------------------------------------------------------------

# The conversations here have a few turns each, so that a small span gives several parts.
_SPAN = 3
_INSTRUCTION_TURN = f"'<turn:{R.INSTRUCTION_ROLE}>{R.INSTRUCTION}</turn>' || chr(10)"
_PARTS_SQL = (
    f"(SELECT *, CAST(floor(turn / {_SPAN}) AS BIGINT) AS part, "
    f"floor(turn / {_SPAN}) = min(floor(turn / {_SPAN})) OVER (PARTITION BY conv_id) AS first FROM conversations)"
)
_OPEN_SQL = "NOT first OR arg_min(role, turn) IN ('system', 'developer')"
_CHAT_SQL = (
    f"SELECT conv_id AS id, part, first, CASE WHEN {_OPEN_SQL} THEN '' ELSE {_INSTRUCTION_TURN} END || "
    "string_agg('<turn:' || role || '>' || text || '</turn>' || chr(10), '' ORDER BY turn) AS text "
    f"FROM {_PARTS_SQL} GROUP BY conv_id, part, first"
)


@_query(
    "SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn // 2 NULLS FIRST, role, text) - 1 AS turn, role, text "
    "FROM (SELECT conv_id, CASE WHEN turn % 3 > 0 THEN turn END AS turn, role, text FROM conversations)"
)
def numbered_turns(spark, sf_dir):
    """Null and equal turn numbers made dense."""
    odd = F.when(F.col("turn") % 3 > 0, F.floor(F.col("turn") / 2))
    turns = _table(spark, sf_dir, "conversations").select("conv_id", odd.alias("turn"), "role", "text")
    return R.number_turns(turns, work_folder(spark))


@_query(f"SELECT id, part, text FROM ({_CHAT_SQL})")
def chat_text(spark, sf_dir):
    """Flat turns: assembled in parts, instruction added to the first, rendered."""
    parts = R.assemble_turns(_table(spark, sf_dir, "conversations"), _SPAN)
    return R.render_chat(R.add_instruction(parts)).select(F.col("conv_id").alias("id"), "part", "text")


def _chats(spark, sf_dir):
    names = _pick(
        "conv_id", F.lit(None).cast("array<string>"), F.array(F.lit("MEDIUM"), F.lit("none"), F.lit("ECONOMY"))
    )
    return R.assemble_turns(_table(spark, sf_dir, "conversations"), _SPAN).select(
        F.col("conv_id").alias("id"), "part", "first", names.alias("tool_names"), "messages"
    )


def _type_catalog(spark, sf_dir):
    return (
        _table(spark, sf_dir, "part")
        .groupBy(F.col("p_type").alias("name"))
        .agg(F.lit("function").alias("type"), F.min("p_name").alias("description"))
        .withColumn("parameters", F.lit(_SHAPE))
    )


_TYPE_ENTRY_SQL = (
    "SELECT p_type AS name, '{\"type\":\"function\",\"function\":{\"name\":\"' || p_type || '\",\"description\":\"' || min(p_name) || "
    f"'\",\"parameters\":{_SHAPE}}}}}' AS entry FROM part GROUP BY p_type"
)


@_query(
    f"SELECT conv_id AS id, part, CASE WHEN {_OPEN_SQL} THEN '' ELSE 'developer,' END || "
    f"string_agg(role, ',' ORDER BY turn) AS roles FROM {_PARTS_SQL} GROUP BY conv_id, part, first"
)
def instruction_messages(spark, sf_dir):
    roles = F.array_join(F.transform("messages", lambda m: m["role"]), ",")
    return R.add_instruction(_chats(spark, sf_dir)).select("id", "part", roles.alias("roles"))


@_query(
    f"WITH t AS ({_TYPE_ENTRY_SQL}) SELECT event_id AS id, CASE event_id % 5 "
    "WHEN 0 THEN (SELECT string_agg(entry, ';' ORDER BY name) FROM t) WHEN 1 THEN (SELECT string_agg(entry, ';' ORDER BY name) FROM t) "
    "WHEN 2 THEN '' WHEN 3 THEN (SELECT string_agg(entry, ';' ORDER BY name) FROM t WHERE name IN ('SMALL', 'ECONOMY')) "
    "ELSE coalesce((SELECT entry FROM t WHERE name = upper(event_type)), '') || coalesce((SELECT entry FROM t WHERE name = 'PROMO'), '') END AS tools FROM events"
)
def tool_selection(spark, sf_dir):
    names = _pick(
        "event_id",
        F.lit(None).cast("array<string>"),
        F.array().cast("array<string>"),
        F.array(F.lit("unknown")),
        F.array(*map(F.lit, ("SMALL", "unknown", "ECONOMY", "SMALL"))),
        F.array(F.upper("event_type"), F.lit("PROMO")),
    )
    samples = _table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), names.alias("tool_names"))
    selected = R.select_tools(samples, _type_catalog(spark, sf_dir))
    return selected.select("id", F.array_join("tools", ";").alias("tools"))


@_query(
    f"WITH t AS ({_TYPE_ENTRY_SQL}), c AS ({_CHAT_SQL}) SELECT id, part, CASE WHEN first THEN '<tools>' || CASE WHEN id % 2 = 0 "
    "THEN (SELECT string_agg(entry, chr(10) ORDER BY name) FROM t) "
    "ELSE (SELECT string_agg(entry, chr(10) ORDER BY name) FROM t WHERE name IN ('MEDIUM', 'ECONOMY')) END || "
    "'</tools>' || chr(10) ELSE '' END || text AS text FROM c"
)
def training_texts(spark, sf_dir):
    """Samples and catalog to training text."""
    return R.format_samples(_chats(spark, sf_dir), _type_catalog(spark, sf_dir)).select("id", "part", "text")


_SPACE = r"[\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
_TOKENS_SQL = (
    f"SELECT lang, source, len(list_filter(regexp_split_to_array(text, '{_SPACE}'), lambda w: w <> '')) AS n FROM documents"
)


@_query(
    f"SELECT lang, source, count(*) AS texts, count(*) FILTER (WHERE n > 1024) AS over_budget FROM ({_TOKENS_SQL}) GROUP BY lang, source"
)
def sequence_budget(spark, sf_dir):
    return R.budget_counts(_table(spark, sf_dir, "documents"), 1024, "lang", "source")


@_query(
    "SELECT 'auto-brand' || p_brand || '-1' AS id, 'Use the tool `brand' || p_brand || '` to help with: ' || "
    "arg_min(p_name, 'src/f' || p_partkey || '.py') || '.' AS asked, '{\"size\":1}' AS arguments FROM part GROUP BY p_brand"
)
def flagship(spark, sf_dir):
    """Python sources to catalog to samples."""
    content = _text('@mcp.tool("brand', F.col("p_brand"), '")\ndef f(size: int):\n    """', F.col("p_name"), '."""\n')
    incoming = X.extract_tools(_part_files(spark, sf_dir, "py", content))
    samples = G.generate_samples(C.merge_tools(spark.createDataFrame([], CATALOG), incoming))
    call = F.get(F.get("messages", F.lit(1))["tool_calls"], F.lit(0))["function"]
    return samples.select(
        "id", F.get("messages", F.lit(0))["content"].alias("asked"), call["arguments"].alias("arguments")
    )
