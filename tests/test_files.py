from toolquarry.operators import files as S


def paths(spark, *rows):
    return spark.createDataFrame(rows, "project STRING, path STRING")


def kept(df):
    return sorted((r["project"], r["path"]) for r in df.collect())


def test_any_folder_of_the_path_excludes_a_file(spark):
    df = paths(
        spark,
        ("p", "build/x.py"),
        ("p", "builder/x.py"),
        ("p", "a/node_modules/b/x.js"),
        ("p", "a/venv"),
        ("build", "x.py"),
        ("p", ".github/x.py"),
    )
    assert kept(S.drop_excluded(df)) == [("build", "x.py"), ("p", ".github/x.py"), ("p", "builder/x.py")]


def test_given_excludes_replace_the_defaults(spark):
    df = paths(spark, ("p", "build/x.py"), ("p", "gen/x.py"))
    assert kept(S.drop_excluded(df, ["gen"])) == [("p", "build/x.py")]
    assert len(kept(S.drop_excluded(df, []))) == 2


def test_routing(spark):
    names = ["a.py", "a.ts", "a.js", "a.mts", "a.cts", "a.tsx", "a.jsx", "A.java", "a.mjs", "a.PY", "py", "a.py.txt", ".py"]
    routed = S.route_files(paths(spark, *[("p", n) for n in names]))
    got = {r["path"]: (r["lang"], r["lang_rank"], r["ext_rank"]) for r in routed.collect()}
    assert got == {
        "a.py": ("python", 0, 0),
        ".py": ("python", 0, 0),
        "a.ts": ("node", 1, 0),
        "a.js": ("node", 1, 1),
        "a.mts": ("node", 1, 2),
        "a.cts": ("node", 1, 3),
        "a.tsx": ("node", 1, 4),
        "a.jsx": ("node", 1, 5),
        "A.java": ("java", 2, 0),
    }


PROJECTS = (
    ("py", "x.py"),
    ("tsx only", "x.tsx"),
    ("tsx and ts", "x.tsx"),
    ("tsx and ts", "node_modules/x.ts"),
    ("package", "package.json"),
    ("package", "x.jsx"),
    ("deep package", "a/package.json"),
    ("deep package", "x.mts"),
    ("maven", "a/pom.xml"),
    ("gradle", "build.gradle"),
    ("java", "A.java"),
    ("all", "x.py"),
    ("all", "x.js"),
    ("all", "A.java"),
    ("none", "README"),
)


def test_project_languages(spark):
    rows = S.project_languages(paths(spark, *PROJECTS)).collect()
    assert {r["project"]: r["languages"] for r in rows} == {
        "py": ["python"],
        "tsx only": [],
        "tsx and ts": ["node"],
        "package": ["node"],
        "deep package": [],
        "maven": ["java"],
        "gradle": ["java"],
        "java": ["java"],
        "all": ["java", "node", "python"],
        "none": [],
    }


def test_detection_keeps_files_of_detected_languages(spark):
    df = paths(spark, *PROJECTS)
    expected = [
        ("all", "A.java"), ("all", "x.js"), ("all", "x.py"), ("java", "A.java"), ("package", "x.jsx"),
        ("py", "x.py"), ("tsx and ts", "node_modules/x.ts"), ("tsx and ts", "x.tsx"),
    ]
    assert kept(S.keep_detected(S.route_files(df), df)) == expected


def test_language_list(spark):
    assert S.parse_languages(" python,, java ,cobol") == ["python", "java", "cobol"]
    routed = S.route_files(paths(spark, ("p", "a.py"), ("p", "a.ts"), ("p", "A.java")))
    assert kept(S.keep_languages(routed, ["java", "cobol"])) == [("p", "A.java")]


def test_text(spark):
    rows = [("a", bytearray(b"1\r\n2\r3\n")), ("b", bytearray(b"\xc0\x80")), ("c", bytearray("é".encode()))]
    df = spark.createDataFrame(rows, "path STRING, content BINARY")
    assert {r["path"]: r["text"] for r in S.decode_text(df).collect()} == {"a": "1\n2\n3\n", "b": None, "c": "é"}
    assert sorted(r["path"] for r in S.valid_text_files(df).collect()) == ["a", "c"]
