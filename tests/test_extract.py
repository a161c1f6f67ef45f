"""Golden cases: source files in, exact tool definitions out."""

import json

import pytest

from toolquarry.operators.extract import extract_tools, scan_files, skipped_files, tool_defs

EMPTY = {"type": "object", "properties": {}, "required": []}


def schema(required=None, **types):
    props = {k: {"type": v, "description": ""} for k, v in types.items()}
    return {"type": "object", "properties": props, "required": list(types) if required is None else required}


@pytest.fixture
def tools(source_files):
    def run(path, text):
        rows = extract_tools(source_files({path: text})).orderBy("pattern_rank", "ordinal").collect()
        return [(r["name"], r["description"], json.loads(r["parameters"])) for r in rows]

    return run


PYTHON_CASES = {
    "methods beside a function": (
        '''
class Inventory:
    @registry.tool(name="stock.count")
    def count(self, sku: str, *, warehouse: str = "main", exact: bool):
        """Count items on hand.
        Reads the ledger."""

    @registry.tool
    def move(self, sku: str, quantity: int, target=None): ...

@registry.tool("audit")
def run_audit(since: "date", flags: list):
    return flags
''',
        [
            ("audit", "", schema(since="string", flags="array")),
            ("stock.count", "Count items on hand.", schema(sku="string")),
            ("move", "", schema(["sku", "quantity"], sku="string", quantity="integer", target="string")),
        ],
    ),
    "names": (
        '''
@tool("first")
def a(): pass
@m.tool(name="by_name")
def b(): pass
@m.x.tool(tool_name="by_tool_name")
def c(): pass
@tool("", name="unused")
def d(): pass
@tool(NAME, name="second")
def e(): pass
@tool(" padded ")
def f(): pass
@cache
@tool("inner")
def g(): pass
@tool(7)
def h(): pass
@toolbox
def i(): pass
@tool.x
def j(): pass
@x.tool("one")
@x.tool("two")
def k(): pass
''',
        [
            (n, "", EMPTY)
            for n in ["first", "by_name", "by_tool_name", "d", "second", " padded ", "inner", "h", "one"]
        ],
    ),
    "annotations": (
        '''
import typing
@tool
def f(a, b: str, c: int, d: float, e: bool, f: dict, g: list, h: List[int], i: typing.List,
      j: Dict[str, int], k: typing.Mapping, l: Optional[int], m: Union[bool, None],
      n: int | None, o: "int", p: typing.List[int], q: tuple[int, int], r: Tuple[int], s: Set[int],
      t: Optional[List[int]], u: Custom, v: Mapping[str, str], w: Optional["int"], x: typing.Optional[int]):
    pass
''',
        [
            (
                "f",
                "",
                schema(
                    a="string", b="string", c="integer", d="number", e="boolean", f="object", g="array",
                    h="array", i="array", j="object", k="object", l="integer", m="boolean", n="string",
                    o="string", p="string", q="string", r="array", s="array", t="array", u="string",
                    v="object", w="string", x="string",
                ),
            )
        ],
    ),
    "signatures": (
        '''
class C:
    @tool
    def m(self, a, b=1, *args, k: int, **kw): pass
    @tool
    def n(cls, /, a: int, *, only=2): pass
@tool
def o(a, /, b: int, c: bool = True): pass
@tool
def p(self=1, a=2): pass
@tool
async def skipped(): pass
def outer():
    @tool
    def inner(z: int): "one line"
''',
        [
            ("o", "", schema(["a", "b"], a="string", b="integer", c="boolean")),
            ("p", "", schema([], a="string")),
            ("m", "", schema(["a"], a="string", b="string")),
            ("n", "", schema(a="integer")),
            ("inner", "one line", schema(z="integer")),
        ],
    ),
    "blank docstring": ('@tool\ndef f():\n    """   \n   """\n', [("f", "", EMPTY)]),
    "full-width spelling of the decorator": ("@ｔｏｏｌ\ndef f(): pass\n", [("f", "", EMPTY)]),
    "carriage returns": ('@tool\r\ndef f():\r\n    """A\r\n    B"""\r\n', [("f", "A", EMPTY)]),
    "quotes in names": ('@tool("a\\"b\\\\é")\ndef f(): pass\n', [('a"b\\é', "", EMPTY)]),
}

NODE_CASES = {
    "schema before description, two tools": (
        """
export function setup(hub) {
  hub.registerTool('invoice.create', {
    inputSchema: {
      type: 'object',
      properties: {
        lines: { type: 'array', items: { type: 'object', properties: { net: { type: 'number' } } } },
        due: { type: 'string' },
      },
      required: ['lines', 'due'],
    },
    description: 'Creates an invoice',
  }, create);
  hub.registerTool('invoice.list', { description: 'Lists invoices' }, list);
}
""",
        [
            (
                "invoice.create",
                "Creates an invoice",
                {
                    "type": "object",
                    "properties": {
                        "lines": {"type": "array", "items": {"type": "object", "properties": {"net": {"type": "number"}}}},
                        "due": {"type": "string"},
                    },
                    "required": ["lines", "due"],
                },
            ),
            ("invoice.list", "Lists invoices", EMPTY),
        ],
    ),
    "zod validators in chains": (
        """
hub.tool('ticket.close', {
  inputSchema: z.object({
    id: z.coerce.number().int(), reason: z.enum(['done', 'dup']),
    notify: z.array(z.string().email()).default([])
  }),
  description: `Closes a ticket`
}, close);
""",
        [("ticket.close", "Closes a ticket", schema(["id", "notify", "reason"], id="string", reason="string", notify="string"))],
    ),
    "commas, colons and quotes in strings of a schema": (
        """tool("n", { inputSchema: { 'a-b': "x, } y: z", c: 'it\\'s "so"', } })""",
        [("n", "", {"a-b": "x, } y: z", "c": 'it\'s "so"'})],
    ),
    "object form": (
        "tool({ name: ' n ', description: `d`, inputSchema: { type: 'object', properties: { a: { type: 'number', }, }, } }, run)",
        [("n", "d", {"type": "object", "properties": {"a": {"type": "number"}}})],
    ),
    "description in second place loses the rest": (
        'server.tool("n", "about", { a: z.string() }, run)',
        [("n", "", EMPTY)],
    ),
    "schema that is not JSON": (
        'registerTool("n", { inputSchema: { a: z.string() } })',
        [("n", "", EMPTY)],
    ),
    "schema without a type": (
        'registerTool("n", { inputSchema: { "a": 1 } })',
        [("n", "", {"a": 1})],
    ),
    "wrapped zod": (
        'registerTool("n", { inputSchema: toJson(z.object({ a: z.string() })), x: 1 })',
        [("n", "", schema(a="string"))],
    ),
    "zod of a variable": ('registerTool("n", { inputSchema: z.object(Shape) })', [("n", "", EMPTY)]),
    "zod in a string": ('registerTool("n", { inputSchema: "z.object({a: z.x})" })', [("n", "", EMPTY)]),
    "zod after a string": (
        'registerTool("n", { inputSchema: "a" + z.object({ a: z.string() }), b: 1 })',
        [("n", "", EMPTY)],
    ),
    "zod call with type arguments": (
        'registerTool("n", { inputSchema: z.object<{ a: B }>({ a: z.string() }).partial(), b: c })',
        [("n", "", EMPTY)],
    ),
    "escapes and quotes in values": (
        r"""registerTool("n", { inputSchema: { type: 'object', note: 'say "hi"', $ref: 'a\\b', list: [1.50, true, null,], } })""",
        [("n", "", {"type": "object", "note": 'say "hi"', "$ref": "a\\b", "list": [1.5, True, None]})],
    ),
    "name and description by other quotes": (
        """registerTool({ 'name': 'quoted key', description: 'it"s', name: `n`, title: "t" })""",
        [("n", "", EMPTY)],
    ),
    "comments, quotes and brackets inside": (
        """
// registerTool("commented", {})
registerTool( /* first */ "hidden", {});
registerTool("a\\'b", { /* }, ) */ description: 'with (', // it's, odd
  title: "), }" }, run);
registerTool(`tick`, meta);
registerTool("", { name: "none" });
registerTool(name, { name: "none" });
registerTool("  ", {});
registerTool(, "late");
toolbox("x"); mytool("y"); tool ("spaced");
""",
        [
            ("commented", "", EMPTY),
            ("a'b", "with (", EMPTY),
            ("tick", "", EMPTY),
            ("late", "", EMPTY),
            ("spaced", "", EMPTY),
        ],
    ),
    "call that never ends": ('registerTool("kept", { description: "d" }, function () {', [("kept", "d", EMPTY)]),
    "cut off in the first argument": ('registerTool("lost"', []),
    "registerTool before tool": ('tool("a"); registerTool("b")', [("b", "", EMPTY), ("a", "", EMPTY)]),
    "description deep in the schema": (
        'tool("n", { inputSchema: { properties: { a: { description: "deep" } } } })',
        [("n", "deep", {"properties": {"a": {"description": "deep"}}})],
    ),
    "comment ended by a lone carriage return": ('tool("a", // c, d\r{ description: "e" })', [("a", "e", EMPTY)]),
}

JAVA_CASES = {
    "modifiers, throws and varargs": (
        """
class Orders {
  @McpTool(description = "Cancels", name = "order_cancel")
  protected static boolean cancel(long orderId, String... reasons) throws IOException {
    return true;
  }

  @Tool(name = "order_total")
  public BigDecimal total(@NotNull List<Line> lines, double rate, boolean net) { return null; }

  int untouched(int a) { return a; }
}
""",
        [
            ("order_cancel", "", schema(orderId="integer", reasons="string")),
            ("order_total", "", schema(lines="string", rate="number", net="boolean")),
        ],
    ),
    "names": (
        """
  @Tool("quoted") public int a(long x) { }
  @Tool(value = "valued", other = "o") public int b() { }
  @Tool(description = "Does it") int c(double y) { }
  @ToolParam("skipped") int d(int z) { }
  @Tool(returnDirect = true)
  protected static Map<String, List<String>> e(final Map<String, Integer> m, java.util.UUID id, boolean[] flags) { }
""",
        [
            ("quoted", "", schema(x="integer")),
            ("valued", "", EMPTY),
            ("Does it", "", schema(y="number")),
            ("e", "", schema(m="string", id="string", flags="boolean")),
        ],
    ),
    "annotated parameters": (
        '''
  @Tool
  public String f(@P(description = "a, (b)") String c, @Valid @Size(min = 1, max = 2) final List<Map<String, Long>> d, BigDecimal e, Float... g) {
''',
        [("f", "", schema(c="string", d="string", e="number", g="string"))],
    ),
    "three ways to hand over a tool": (
        """
    var weekly = Tool.builder("report.weekly").build();
    hub.addTool(new tools.ReportTool("report.daily", "Daily report"));
    hub.addTool(new ExportTool("export", Format.CSV));
    hub.addTool(new ToolAdapter("adapted"));
    hub.registerTool("ping", this::ping);
""",
        [
            ("ping", "", EMPTY),
            ("report.daily", "Daily report", EMPTY),
            ("export", "", EMPTY),
            ("report.weekly", "", EMPTY),
        ],
    ),
    "two annotations before one method": (
        "@Tool(name=\"x\")\n@McpTool\npublic void m(int a) {}",
        [("x", "", schema(a="integer")), ("m", "", schema(a="integer"))],
    ),
    "no method": ("@Tool class X { }", []),
    "open parameter list": ("@Tool void f(int a", []),
}


@pytest.mark.parametrize("case", PYTHON_CASES)
def test_python(tools, case):
    text, expected = PYTHON_CASES[case]
    assert tools("a/b.py", text) == expected


@pytest.mark.parametrize("case", NODE_CASES)
def test_node(tools, case):
    text, expected = NODE_CASES[case]
    assert tools("a/b.ts", text) == expected


@pytest.mark.parametrize("case", JAVA_CASES)
def test_java(tools, case):
    text, expected = JAVA_CASES[case]
    assert tools("a/B.java", text) == expected


def test_unreadable_files_are_reported_and_harm_nothing(source_files):
    scanned = scan_files(
        source_files(
            {
                "good.py": "@tool\ndef f(): pass\n",
                "bad.py": "@tool\ndef f(:\n",
                "bom.py": "\ufeff@tool\ndef f(): pass\n",
                "bytes.py": b"@tool\ndef f(): pass # \xff\n",
                "bytes.ts": b"\xed\xa0\x80",
                "nul.py": "@tool\ndef f(): pass\n\0",
                "deep.py": "@tool\ndef f(): pass\nx = " + "-" * 100_000 + "1\n",
                "lone.py": '@tool("\\ud800")\ndef f(): pass\n',
                "plain.py": "def broken(:\n",
                "notes.txt": "@tool",
            }
        )
    )
    assert [r["path"] for r in tool_defs(scanned).collect()] == ["good.py"]
    reasons = {r["path"]: r["reason"] for r in skipped_files(scanned).collect()}
    assert set(reasons) == {
        "bad.py", "bom.py", "bytes.py", "bytes.ts", "nul.py", "deep.py", "lone.py",
    }
    assert reasons["bad.py"] == reasons["bom.py"] == "syntax_error"
    assert reasons["bytes.py"] == reasons["bytes.ts"] == "bad_utf8"
    assert reasons["lone.py"] == "parser_error"


def test_all_languages_in_one_scan(source_files):
    files = source_files(
        {
            "j/T.java": '@Tool("j") void x() {}',
            "n/i.js": 'tool("n")',
            "p/a.py": "@tool\ndef p(): pass",
        }
    )
    rows = extract_tools(files).orderBy("lang_rank").collect()
    assert [(r["lang"], r["name"]) for r in rows] == [("python", "p"), ("node", "n"), ("java", "j")]
    assert [r["name"] for r in extract_tools(files, ["java", "cobol"]).collect()] == ["j"]
    assert extract_tools(files, ["cobol"]).collect() == []
