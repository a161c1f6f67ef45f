"""Extraction in SQL."""

import pytest

from toolquarry.operators.extract import extract_tools
from toolquarry.table_functions import register_table_functions

FILES = {
    "a.py": '@tool\r\ndef f(x: int, y=1):\r\n    """About f."""\r\n@mcp.tool("g")\r\ndef h(): pass\r\n',
    "broken.py": "@tool\ndef f(:\n",
    "plain.py": "x = 1\n",
    "bad.py": b"@tool\ndef f(): pass # \xff\n",
    "a.ts": "server.registerTool('n', { description: 'About n', inputSchema: z.object({ q: z.string() }) }, f); tool('m', {})",
    "A.java": '@Tool(name = "j")\npublic void j(int a) {}\nx.addTool(new MyTool("k", "d")); registerTool("r")',
}
FUNCTIONS = {"py": ("python", "python_tools"), "ts": ("node", "node_tools"), "java": ("java", "java_tools")}


@pytest.fixture
def files(spark, source_files):
    register_table_functions(spark)
    register_table_functions(spark)  # again is no error
    return source_files(FILES)


@pytest.mark.parametrize("ext", FUNCTIONS)
def test_rows_equal_those_of_the_operator(spark, files, ext):
    lang, function = FUNCTIONS[ext]
    columns = "path, pattern_rank, ordinal, name, description, parameters"
    query = f"SELECT {columns} FROM {{files}} f, LATERAL {function}(CAST(content AS STRING)) WHERE endswith(path, '.{ext}')"
    got = spark.sql(query, files=files)
    want = extract_tools(files, [lang]).selectExpr(*columns.split(", "))
    assert sorted(got.collect()) == sorted(want.collect()) and want.count() >= 2
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1


def test_with_other_sql(spark, files):
    query = """
        SELECT path, count(t.name) AS n FROM {files} f, LATERAL python_tools(CAST(content AS STRING)) t
        GROUP BY path HAVING path LIKE '%.py' ORDER BY path"""
    assert [tuple(r) for r in spark.sql(query, files=files).collect()] == [("a.py", 2)]
    assert spark.sql("SELECT name FROM python_tools('@tool\ndef one(): pass')").collect() == [("one",)]
    assert spark.sql("SELECT * FROM python_tools(NULL)").count() == 0
