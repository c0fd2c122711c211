import os
import random
import re

import pytest
from pyspark.sql import functions as F

from boughwork.functions import ignore, paths
from boughwork.operators import documented, filters, layout, parse
from boughwork.plans import documents, stages
from boughwork.sources import textfile
from boughwork.sources.directory import expand, read_directory, read_lines


def tree(spark, text):
    rows = [(p.rstrip("/"), p.endswith("/")) for p in text.split()]
    return spark.createDataFrame(rows, "relpath string, is_dir boolean").repartition(3)


def names(df):
    return sorted(r["relpath"] for r in df.collect())


def lines(spark, text):
    return parse.lines_of(spark.createDataFrame([(1, text)], "doc_id int, text string"))


def drawn(df):
    return [r["line"] for r in sorted(df.collect(), key=lambda r: r["ord"])]


def documented_in(spark, text):
    return {r["relpath"]: r["comment"] for r in parse.parse_tree(lines(spark, text)).collect()}


def test_preorder(spark):
    got = layout.preorder(tree(spark, "b.txt A/ A/z.py A/Sub/ A/Sub/q c/ A.txt a-/")).collect()
    assert [r["relpath"] for r in sorted(got, key=lambda r: r["ord"])] == "A A/Sub A/Sub/q A/z.py a- c A.txt b.txt".split()


def test_depth_and_extensions(spark):
    entries = tree(spark, "a.py B.PY .py c.tar.gz d/ d/e/ d/e/f")
    assert names(filters.depth_limit(entries, 0)) == names(filters.depth_limit(entries, -1)) == []
    assert names(filters.by_extension(entries, "PY")) == ["B.PY", "a.py", "d", "d/e"]
    assert names(filters.by_extension(entries, "tar.gz")) == ["d", "d/e"]
    assert names(filters.by_extension(entries, [])) == names(filters.by_extension(entries, "")) == names(entries)
    assert paths.normal_extensions("py") == [".py"]


def test_names_and_pruning(spark):
    assert names(filters.by_name(tree(spark, ".git/ x/.git .gitkeep/ .gitkeep"))) == [".gitkeep", "x/.git"]
    assert names(filters.by_name(tree(spark, ".git/"), [])) == [".git"]
    entries = tree(spark, "out/ out/x keep")
    known = spark.createDataFrame([("out/x", ["c"])], "relpath string, comment array<string>")
    shown = filters.visible(entries, rules=ignore.parse_rules(["/out/"]), documented=known)
    assert names(shown) == ["keep"] and names(documented.removed(shown, known)) == ["out/x"]


@pytest.mark.parametrize(
    "rules,text,mode,gone",
    [
        (["*.pyc", "!keep.pyc"], "a.pyc keep.pyc", "simple", ["a.pyc"]),
        (["!keep.pyc", "*.pyc"], "a.pyc keep.pyc", "simple", ["a.pyc", "keep.pyc"]),
        (["/data/"], "data/ x/data/ y/data", "simple", ["data"]),
        (["**/foo"], "foo x/foo", "simple", ["x/foo"]),
        (["foo/**"], "foo/ foo/a", "simple", ["foo/a"]),
        (["a*b"], "a/b", "simple", ["a/b"]),
        (["a/b"], "a/b x/a/b", "simple", ["a/b", "x/a/b"]),
        (["[!a]x", "[z"], "bx ax [z", "simple", ["[z", "bx"]),
        (["# no", "", " b "], "b #", "simple", ["b"]),
        (["**/foo"], "foo x/foo xfoo", "git", ["foo", "x/foo"]),
        (["foo/**"], "foo/ foo/a", "git", ["foo/a"]),
        (["a*b"], "a/b axb", "git", ["axb"]),
        (["a/b"], "a/b x/a/b", "git", ["a/b"]),
        (["data/"], "data/ data/x y/data", "git", ["data", "data/x"]),
        (["a/**/z"], "a/z a/b/z a/b/c/z az", "git", ["a/b/c/z", "a/b/z", "a/z"]),
    ],
)
def test_ignore_rules(spark, rules, text, mode, gone):
    entries = tree(spark, text)
    hit = ignore.ignored(F.col("relpath"), F.col("is_dir"), ignore.parse_rules(rules), mode)
    assert names(entries.where(hit)) == gone


PUBLISHED = [
    ([r"\#notes"], ["#notes"]),
    ([r"\!keep"], ["!keep"]),
    ([r"a\*b"], ["a*b"]),
    (["[[:digit:]]x"], ["1x"]),
    (["x\\ "], ["x "]),
    (["x\\   "], ["x "]),
    (["a*b   "], ["a*b", "axb"]),
    ([r"\a*b"], ["a*b", "axb"]),
    (["ends\\"], []),
    ([r"[\!#]*"], ["!keep", "#notes"]),
    (["[!!#]*s"], ["]bars", "bars", "ends"]),
    (["[^!#]*s"], ["]bars", "bars", "ends"]),
    (["[]x]*s"], ["]bars"]),
    ([r"[\]]*"], ["]bars"]),
    (["[a-b-]*s"], ["bars"]),
    (["[z-a]*"], []),
    (["[[:upper:][:digit:]]*"], ["1x", "Dir", "Dir/in"]),
    (["[[:nothing:]]*", "[[:alpha:]"], []),
    (["D?r/**"], ["Dir/in"]),
    (["Dir[!a]in", "Dir?in", "Dir[/]in"], []),
    (["/*", "!D*", "!/axb"], ["!keep", "#notes", "1x", "]bars", "a*b", "bars", "ends", "x "]),
    (["**", "!**/in"], ["!keep", "#notes", "1x", "Dir", "]bars", "a*b", "axb", "bars", "ends", "x "]),
]


@pytest.mark.parametrize("many", [ignore.MANY_RULES, 0])
def test_published_ignore_rules(spark, many, monkeypatch):
    monkeypatch.setattr(ignore, "MANY_RULES", many)
    found = ["#notes", "!keep", "a*b", "axb", "1x", "x ", "]bars", "bars", "ends", "Dir", "Dir/in"]
    entries = spark.createDataFrame([(p, p == "Dir") for p in found], "relpath string, is_dir boolean")
    hits = [ignore.ignored(F.col("relpath"), F.col("is_dir"), ignore.parse_rules(rules)).alias(f"c{i}") for i, (rules, _) in enumerate(PUBLISHED)]
    rows = entries.select("relpath", *hits).collect()
    for i, (rules, gone) in enumerate(PUBLISHED):
        assert sorted(r["relpath"] for r in rows if r[f"c{i}"]) == sorted(gone), rules


@pytest.mark.parametrize("mode", ["git", "simple"])
def test_many_rules_in_one_structure(spark, mode, monkeypatch):
    rng = random.Random(4)
    bits = ["a", "b", "ab", "*", "a*", "*b", "?", "[ab]", "[!a]b", "**", "a.b", "*.b"]
    lines = [rng.choice(["", "", "!"]) + rng.choice(["", "", "/"]) + "/".join(rng.choices(bits, k=rng.choice([1, 1, 2, 3]))) + rng.choice(["", "", "/"]) for _ in range(60)]
    rules = ignore.parse_rules(lines, mode)
    found = sorted({"/".join(rng.choices(["a", "b", "ab", "ba", "a.b", "c", "bb.b"], k=rng.randint(1, 4))) for _ in range(300)})
    entries = spark.createDataFrame([(p, len(p) % 2 == 0) for p in found], "relpath string, is_dir boolean")
    parts = [rules, rules[:20], rules[40:], rules[:3]]

    def verdicts(many):
        monkeypatch.setattr(ignore, "MANY_RULES", many)
        return sorted(map(tuple, entries.select("relpath", *(ignore.ignored(F.col("relpath"), F.col("is_dir"), some, mode).alias(f"c{i}") for i, some in enumerate(parts))).collect()))

    assert verdicts(64) == verdicts(0)


def test_ten_thousand_rules_are_one_expression(spark):
    rules = ignore.parse_rules([f"n{i}.*" if i % 3 else f"!n{i}.txt" for i in range(10_000)])
    entries = spark.range(20_000).selectExpr("concat('d/n', id, '.txt') as relpath", "false as is_dir")
    hit = entries.where(ignore.ignored(F.col("relpath"), F.col("is_dir"), rules))
    assert hit.count() == sum(i % 3 > 0 for i in range(10_000))
    assert len(hit._jdf.queryExecution().optimizedPlan().toString()) < 2000


@pytest.mark.parametrize("mode,kept", [("simple", ["data", "data/raw", "data/tmp"]), ("git", ["data", "data/raw"])])
def test_documented_entries_stay(spark, mode, kept):
    entries = tree(spark, "data/ data/raw/ data/tmp/")
    known = spark.createDataFrame([("data", []), ("data/raw", [])], "relpath string, comment array<string>")
    rules = ignore.parse_rules(["/data/"])
    assert names(filters.visible(entries, rules=rules, documented=known, mode=mode)) == kept


def test_lines_of_a_tree(spark):
    entries = tree(spark, "a/ a/b/ a/b/c d/ e").withColumn("comment", F.when(F.col("relpath") == "a/b/c", F.array(F.lit("one"), F.lit("two"))).when(F.col("relpath") == "e", F.array(F.lit("end"), F.lit("more"))))
    assert drawn(layout.render(entries, 12)) == [
        "├── a",
        "│   └── b",
        "│       └── c  <- one",
        "│              two",
        "│",
        "├── d",
        "│",
        "└── e       <- end",
        "               more",
    ]
    assert drawn(layout.render(tree(spark, "only/"))) == ["└── only"]
    assert drawn(layout.render(tree(spark, "x").limit(0))) == []


def test_parsing(spark):
    assert documented_in(spark, "├── a\n│       ├── x\n│       └── y") == {"a": [], "a/x": [], "a/x/y": []}
    assert documented_in(spark, "├── a  <- one\n└── a  <- two") == {"a": ["two"]}
    assert documented_in(spark, "├── a\n│                t") == {"a": ["t"]}
    assert documented_in(spark, "└── x <- y") == {"x <- y": []}
    assert documented_in(spark, "├── x/  # note\n│       │\n└── z") == {"x": ["note"], "z": []}
    assert documented_in(spark, "├── \n└── a  # b  <- c") == {"a": ["b  <- c"]}
    deep = "\n".join("    " * d + f"└── n{d}" for d in (0, 1, 2, 3, 1, 2, 0, 7))
    assert sorted(documented_in(spark, deep)) == ["n0", "n0/n1", "n0/n1/n2", "n0/n1/n2/n3", "n0/n7"]
    two = spark.createDataFrame([(1, "├── a\n│   └── x"), (2, "├── b\n│       └── y"), (3, None), (4, "")], "doc_id int, text string")
    assert sorted((r["doc_id"], r["relpath"]) for r in parse.parse_tree(parse.lines_of(two)).collect()) == [(1, "a"), (1, "a/x"), (2, "b"), (2, "b/y")]


def plain_parse(text):
    """Line after line, as the documents say."""
    stack, found, last = [], {}, None
    for line in text:
        if not line.strip("│ "):
            continue
        groups = re.match("(?:│   |    )*", line)[0]
        rest = line[len(groups) :]
        if rest[:4] in (layout.TEE, layout.ELBOW) and len(rest) > 4:
            name, _, said = (rest[4:] + "  <-").partition("  <-")
            stack = [*stack[: len(groups) // 4], name.rstrip()]
            last = "/".join(stack)
            said = said.removesuffix("  <-").strip()
            found[last] = [said] if said else []
        elif last is not None and (rest.startswith(" ") or groups.endswith("    ")):
            found[last].append(rest.strip())
    return found


def test_long_texts_are_read_in_parts(spark, monkeypatch):
    rng = random.Random(8)
    texts = {}
    for key in (1, 2, 3, None):
        text = []
        for i in range(rng.choice([40, 90])):
            groups = "".join(rng.choices(["│   ", "    "], k=rng.choice([0, 0, 1, 2, 3, 6])))
            text.append(rng.choice([f"{groups}├── n{rng.randint(0, 5)}", f"{groups}└── m{i}  <- c{i}", f"{groups}  more {i}", "│   │", "```", f"{groups}said", "", f"├── t{i}"]))
        texts[key] = text
    rows = [(k, i, line) for k, text in texts.items() for i, line in enumerate(text)]
    table = spark.createDataFrame(rows, "doc_id int, line_no int, text string").repartition(7)
    want = {k: plain_parse(text) for k, text in texts.items()}
    blocks = sorted(map(tuple, parse.fenced_blocks(table).collect()), key=str)
    left = sorted(map(tuple, parse.collapse_spacers(table).collect()), key=str)
    assert len(blocks) > 10
    for size in (1, 2, 7, 100_000):
        monkeypatch.setattr(parse, "_LINES", size)
        got = {k: {} for k in texts}
        for r in parse.parse_tree(table).collect():
            assert r["relpath"] not in got[r["doc_id"]]
            got[r["doc_id"]][r["relpath"]] = r["comment"]
        assert got == want
        assert sorted(map(tuple, parse.fenced_blocks(table).collect()), key=str) == blocks
        assert sorted(map(tuple, parse.collapse_spacers(table).collect()), key=str) == left


def test_nulls_repeated_rows_and_empty_tables(spark):
    rows = [(None, True), ("a", None), ("a", True), ("a/b", False), ("a/b", False), ("", False)]
    entries = spark.createDataFrame(rows, "relpath string, is_dir boolean")
    assert drawn(layout.render(entries)) == ["├── ", "│", "├── a", "├── a", "│   ├── b", "│   └── b", "│", "└── "]
    text = spark.createDataFrame([(None, 0, "├── a"), (None, 1, None), (1, None, "├── b"), (1, 5, "```"), (1, 7, "```")], "doc_id int, line_no int, text string")
    assert [tuple(r) for r in parse.parse_tree(text).collect()] == [(None, "a", [])]
    assert [tuple(r) for r in parse.fenced_blocks(text).collect()] == [(1, 5, 7, False)]
    assert [r["text"] for r in parse.collapse_spacers(text).collect()] == ["├── a", "```", "```"]
    known = spark.createDataFrame([("a", ["x"]), (None, ["n"]), ("q", [])], "relpath string, comment array<string>")
    for op in (layout.preorder, layout.siblings, layout.render, filters.visible, lambda e: filters.prune(e, e), lambda e: documented.attach(e, known.limit(0)), lambda e: documented.difference(e, known.limit(0))):
        assert op(entries.limit(0)).count() == 0 and op(entries).count() >= 5
    for op in (parse.parse_tree, parse.fenced_blocks, parse.collapse_spacers, parse.make_help, parse.tree_block):
        assert op(text.limit(0)).count() == 0


def test_the_plan_of_parsing_does_not_grow_with_depth(spark):
    def size(depth):
        text = "\n".join("    " * d + f"└── n{d}" for d in range(depth))
        found = parse.parse_tree(lines(spark, text))
        assert found.count() == depth
        return len(found._jdf.queryExecution().optimizedPlan().toString())

    assert abs(size(2) - size(60)) < 200


def test_make_help(spark, monkeypatch):
    for size in (100_000, 1, 3):
        monkeypatch.setattr(parse, "_LINES", size)
        make_help(spark)


def make_help(spark):
    text = "## first line\nx:\n\n## Build it\n.PHONY: build\nbuild: dep\n\techo\nother: x\n## Too near\nnear:\n\n## One\n## Two\nboth: x\n\n## No target"
    got = parse.make_help(lines(spark, text)).collect()
    assert sorted((r["target"], r["description"]) for r in got) == [("both", "One"), ("build", "Build it")]
    assert {r["line"] for r in got} == {"build" + " " * 20 + "Build it", "both" + " " * 21 + "One"}


def test_chunks_meet_at_their_edges(spark, monkeypatch):
    rng = random.Random(6)
    found = {"d", "e", "e/only"} | {f"d/f{i:03}" for i in range(40)}
    for _ in range(150):
        parts = rng.choices("abcd", k=rng.randint(1, 6))
        found |= {"/".join(parts[:i]) for i in range(1, len(parts) + 1)}
    dirs = {p.rpartition("/")[0] for p in found} | {f"d/f{i:03}" for i in range(9)}
    rows = [(p, p in dirs, 7) for p in sorted(found) if p != "a/b"]  # an ancestor that isn't listed
    entries = spark.createDataFrame(rows, "relpath string, is_dir boolean, _range int").repartition(5)
    own = {p: d for p, d, _ in rows}
    kids = {}
    for p in sorted(own, key=lambda p: (not own[p], p.rpartition("/")[2])):
        kids.setdefault(p.rpartition("/")[0], []).append(p)
    want = {}
    for group in kids.values():
        for i, p in enumerate(group):
            above = ["/".join(p.split("/")[:k]) for k in range(1, p.count("/") + 1)]
            bars = "".join(layout.BLANK if kids[a.rpartition("/")[0]][-1] == a else layout.BAR for a in above if a in own)
            want[p] = (p == group[-1], i > 0 and own[group[i - 1]], bars)
    text = drawn(layout.render(entries.select("relpath", "is_dir")))
    for bits in (0, 1, 3, 16):
        monkeypatch.setattr(layout, "CHUNK_BITS", bits)
        both = layout.prefixed(layout.siblings(entries))
        assert both.columns == ["relpath", "is_dir", "_range", "parent", "is_last", "spacer", "prefix"]
        got = both.collect()
        assert len(got) == len(rows) and {r["relpath"]: (r["is_last"], r["spacer"], r["prefix"]) for r in got} == want
        assert {r["_range"] for r in got} == {7} and drawn(layout.render(entries)) == text


HELPERS = ["row", "place", "chunk", "more", "given", "line", "key0", "group", "part", "of", "in", "before", "_key", "_at", "_range", "_place", "_k1", "_bucket", "at", "known", "_known", "shown", "k", "n", "_next", "_comment", "_gone", "tag", "region"]


def test_helper_names_may_be_columns(spark):
    plain = tree(spark, "a/ a/b/ a/b/c.py d/ d/e.py z.py")
    crowded = plain.select("*", *(F.concat(F.lit(f"{h} of "), "relpath").alias(h) for h in HELPERS))
    known = spark.createDataFrame([("a/b", ["x"]), ("gone", ["y"])], "relpath string, comment array<string>").select("*", *(F.lit(h).alias(h) for h in HELPERS))

    def same(df, kept=len(HELPERS)):
        rows = df.collect()
        assert rows and all(r[h] == f"{h} of {r['relpath']}" for r in rows for h in HELPERS)
        return rows

    assert len(same(layout.preorder(crowded))) == 6
    assert len(same(layout.numbered(crowded, "relpath"))) == 6
    assert len(same(layout.prefixed(layout.siblings(crowded)))) == 6
    assert drawn(layout.render(crowded)) == drawn(layout.render(plain))
    assert len(same(filters.visible(crowded, ignore_dirs=["d"], rules=ignore.parse_rules(["z.py"]), documented=known))) == 3
    assert len(same(documented.attach(crowded, known))) == 6
    assert sorted(map(tuple, documented.difference(crowded, known).collect())) == sorted(map(tuple, documented.difference(plain, known.select("relpath")).collect()))
    text = lines(spark, "```\n├── a  <- b\n│   └── c\n```\n│\n│\nend\n## x\n\ny: z")
    crowded = text.select("*", *(F.concat(F.lit(f"{h} of "), "line_no").alias(h) for h in HELPERS))
    for op in (parse.fenced_blocks, parse.tree_block, parse.parse_tree, parse.make_help):
        assert sorted(map(tuple, op(crowded).collect()), key=str) == sorted(map(tuple, op(text).collect()), key=str) != []
    left = parse.collapse_spacers(crowded).collect()
    assert len(left) == 9 and all(r[h] == f"{h} of {r['line_no']}" for r in left for h in HELPERS)


def test_numbering(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k")).repartition(9)
    got = layout.numbered(rows, "k").collect()
    assert sorted((r["k"], r["ord"]) for r in got) == [(i, i) for i in range(5000)]
    assert layout.numbered(rows.limit(0), "k").columns == ["k", "ord"] and layout.numbered(rows.limit(0), "k").count() == 0


def test_blocks(spark):
    assert parse.tree_block(lines(spark, "```\n├── a\n")).count() == 0
    text = "a\n```\nplain\n```\n```\n├── a\n```\n```\n└── odd"
    assert [tuple(r) for r in parse.tree_block(lines(spark, text)).collect()] == [(1, 4, 6)]
    assert [r["text"] for r in lines(spark, "a\r\nb\rc d\n").orderBy("line_no").collect()] == ["a", "b", "c", "d"]
    assert lines(spark, "").count() == 0


def test_update_and_export(spark, tmp_path):
    root = tmp_path / "p"
    for name in ("src/core/deep.py", "src/__init__.py", ".env", "empty.txt", ".git/x", "data/.gitkeep", "build/out.o"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text("")
    (root / ".gitignore").write_text("build/\n")
    seen = read_directory(spark, str(root), 2)
    assert {"src/__init__.py", ".env", "empty.txt", "data", ".git"} <= set(names(seen)) and "src/core/deep.py" not in names(seen)
    out = tmp_path / "t.md"
    documents.export_directory_tree(spark, str(root), str(out), max_levels=2)
    fresh = out.read_text()
    assert fresh == "```\n├── data\n│\n├── src\n│   ├── core\n│   │\n│   └── __init__.py\n│\n├── .env\n├── .gitignore\n└── empty.txt\n```\n"
    doc = tmp_path / "R.md"
    doc.write_bytes("# T\r\n```\r\n├── src   <- the code\r\n│            in Python\r\n└── gone  # old\r\n```\r\nend".encode())
    said = documents.update_directory_tree(spark, str(root), str(doc), max_levels=1)
    assert doc.read_bytes().decode() == "# T\n```\n├── data\n│\n├── src                       <- the code\n│                                in Python\n│\n├── .env\n├── .gitignore\n└── empty.txt\n```\nend\n"
    assert said.splitlines() == [f"Updated '{doc}':", "  Added (4):", "    + data", "    + .env", "    + .gitignore", "    + empty.txt", "  Removed (1):", "    - gone"]
    once = doc.read_text()
    documents.update_directory_tree(spark, str(root), str(doc), max_levels=1)
    assert doc.read_text() == once
    with pytest.raises(FileNotFoundError):
        documents.update_directory_tree(spark, str(root), str(tmp_path / "none.md"))
    with pytest.raises(ValueError):
        documents.update_directory_tree(spark, os.devnull, str(doc))
    (tmp_path / "plain.md").write_text("no tree")
    with pytest.raises(ValueError):
        documents.update_directory_tree(spark, str(root), str(tmp_path / "plain.md"))


GOLDEN = {
    "before": [
        "# Tool",
        "",
        "```",
        "├── LICENSE      <- Terms of use",
        "├── Makefile     <- Commands like `make x`",
        "├── README.md    <- Read this first.",
        "├── data",
        "│   ├── raw      <- As it came.",
        "│   └── interim  <- Half way.",
        "│",
        "├── docs         <- Pages",
        "│",
        "├── project.toml  <- Settings of the ",
        "│                   package and others",
        "│",
        "└── tool_pkg   <- The code.",
        "    │",
        "    ├── __init__.py    <- A package",
        "    ├── steps                ",
        "    │   ├── __init__.py ",
        "    │   └── run.py     <- Runs          ",
        "    │",
        "    └── plots.py       <- Draws",
        "```",
        "",
        "end",
    ],
    "after": [
        "├── docs                      <- Pages",
        "│   ├── more",
        "│   │   └── index.md",
        "│   │",
        "│   └── site.yml",
        "│",
        "├── tool_pkg                  <- The code.",
        "│   ├── steps",
        "│   │   └── run.py            <- Runs",
        "│   │",
        "│   ├── __init__.py           <- A package",
        "│   └── plots.py              <- Draws",
        "│",
        "├── Makefile                  <- Commands like `make x`",
        "├── project.toml              <- Settings of the",
        "│                                package and others",
        "└── README.md                 <- Read this first.",
    ],
}


def test_golden_update_by_the_command_line(spark, tmp_path, monkeypatch, capsys):
    root = tmp_path / "p"
    for name in ("tool_pkg/steps/run.py", "tool_pkg/__init__.py", "tool_pkg/plots.py", "docs/more/index.md", "docs/site.yml", "Makefile", "project.toml"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text("")
    readme = root / "README.md"
    readme.write_text("\n".join(GOLDEN["before"]))
    documents.main([str(readme), "--root", str(root), "--debug"])
    assert readme.read_text().splitlines() == [*GOLDEN["before"][:3], *GOLDEN["after"], *GOLDEN["before"][-3:]]
    said = capsys.readouterr().out.splitlines()
    assert said[0] == f"[debug] Scanning root: {root}" and said[2:7] == ["    [dir]  docs", "    [dir]  tool_pkg", "    [file] Makefile", "    [file] project.toml", "    [file] README.md"]
    assert said[7:] == [
        f"Updated '{readme}':",
        "  Added (3):",
        *(f"    + docs/{x}" for x in ("more", "more/index.md", "site.yml")),
        "  Removed (5):",
        *(f"    - {x}" for x in ("LICENSE", "data", "data/interim", "data/raw", "tool_pkg/steps/__init__.py")),
    ]
    documents.main([str(readme), "--root", str(root)])
    assert capsys.readouterr().out.splitlines()[1:] == ["  Added: none", "  Removed: none"]

    monkeypatch.setattr("builtins.input", lambda prompt: pytest.fail("asked without need"))
    documents.main(["-c", "--root", str(root), "--max-levels", "1", "--ext", "md"])
    (fresh,) = root.glob("directory_structure_*.md")
    assert fresh.read_text() == "```\n├── docs\n│\n├── tool_pkg\n│\n└── README.md\n```\n"
    assert documents.default_file(str(root)) == str(fresh)
    for answer, changed in (("n", False), ("yes", False), ("Y ", True)):
        fresh.write_text("old")
        monkeypatch.setattr("builtins.input", lambda prompt: answer)
        documents.main(["-c", "--root", str(root), "--max-levels", "1"])
        assert (fresh.read_text() != "old") == changed
    documents.main(["-c", "new.md", "--root", str(root), "--no-gitignore"])
    assert (root / "new.md").is_file()
    with pytest.raises(SystemExit):
        documents.main([])


def test_stage_contracts(spark, tmp_path):
    assert set(stages.STAGES) == {"dataset", "features", "train", "predict", "plots"}
    with pytest.raises(NotImplementedError):
        stages.STAGES["train"].run(spark, stages.Paths(tmp_path))


def test_stage_reads_and_writes_its_files(spark, tmp_path):
    from pyspark.sql.types import StructType

    (tmp_path / "data/raw").mkdir(parents=True)
    (tmp_path / "data/raw/dataset.csv").write_text("a,b\n1,x\n2,\n")
    where, schema = stages.Paths(tmp_path), StructType.fromDDL("a int, b string")
    stages.STAGES["dataset"].run(spark, where, {"dataset.csv": schema}, lambda rows: rows.withColumn("c", F.col("a") * 2))
    got = spark.read.csv(str(where.of("processed") / "dataset.csv"), header=True).collect()
    assert sorted((r["a"], r["b"], r["c"]) for r in got) == [("1", "x", "2"), ("2", None, "4")]
    assert [where.of(n).relative_to(tmp_path).as_posix() for n in ("interim", "external", "models", "figures")] == ["data/interim", "data/external", "models", "reports/figures"]


def test_stages_save_and_load_models_and_figures(spark, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    from pyspark.sql.types import StructType

    where = stages.Paths(tmp_path)
    where.of("processed").mkdir(parents=True)
    for name, text in (("features.csv", "id,x\n1,1\n2,2\n3,4\n"), ("labels.csv", "id,y\n1,2\n2,4\n3,8\n"), ("test_features.csv", "id,x\n7,10\n"), ("dataset.csv", "x\n1\n")):
        (where.of("processed") / name).write_text(text)
    schemas = {"features.csv": StructType.fromDDL("id int, x double"), "labels.csv": StructType.fromDDL("id int, y double"), "test_features.csv": StructType.fromDDL("id int, x double"), "dataset.csv": StructType.fromDDL("x int")}

    def predicted():
        (own,) = spark.read.csv(str(where.of("processed") / "test_predictions.csv"), header=True).collect()
        return round(float(own["prediction"]), 6)

    steps = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="v"), LinearRegression(featuresCol="v", labelCol="y")])
    for _ in range(2):  # the second time over the first one's files
        stages.STAGES["train"].run(spark, where, schemas, lambda x, y: steps.fit(x.join(y, "id")))
        stages.STAGES["predict"].run(spark, where, schemas, lambda x, model: model.transform(x).select("id", "prediction"))
        assert predicted() == 20.0
    stages.STAGES["train"].run(spark, where, schemas, lambda x, y: {"factor": 3.0})
    stages.STAGES["predict"].run(spark, where, schemas, lambda x, model: x.select("id", (F.col("x") * model["factor"]).alias("prediction")))
    assert predicted() == 30.0
    stages.STAGES["plots"].run(spark, where, schemas, lambda x: b"figure of %d" % x.count())
    assert (where.of("figures") / "plot.png").read_bytes() == b"figure of 1"

    class Figure:
        def savefig(self, path, format):
            with open(path, "w") as f:
                f.write(format)
            raise OSError("half way")

    with pytest.raises(OSError):
        stages.STAGES["plots"].run(spark, where, schemas, lambda x: Figure())
    assert (where.of("figures") / "plot.png").read_bytes() == b"figure of 1"
    assert not [p for p in tmp_path.rglob(".*") if not p.name.endswith(".crc")]


def test_lines_of_files(spark, tmp_path):
    texts = {"a.txt": "one\r\ntwo\n", "b.txt": "", "c.txt": "x\x0b\n\ry\u2028z\x0c", "d.txt": "x\x0b\n", "e.txt": "\n\n\r", "f.txt": "é\u0085\x1c\r\r\nend\r", "g.txt": "no end", "h.txt": "\ufeffx\ny", "i.txt": "\ufeffx\n"}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    got = read_lines(spark, str(tmp_path)).collect()
    want = [(name, i, line) for name, text in texts.items() for i, line in enumerate(text.replace("\r\n", "\n").replace("\r", "\n").splitlines())]
    assert sorted((r["doc_id"].rpartition("/")[2], r["line_no"], r["text"]) for r in got) == sorted(want)


def test_lines_of_a_file_in_splits(spark, tmp_path):
    text = [f"line {i} " + "é" * (i % 50) for i in range(20_000)]
    (tmp_path / "big.txt").write_text("\r\n".join(text))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50k")
    try:
        assert spark.read.text(str(tmp_path), lineSep="\n").rdd.getNumPartitions() > 10
        got = {r["line_no"]: r["text"] for r in read_lines(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == dict(enumerate(text))


def test_one_file_of_many_tasks(spark, tmp_path):
    target = tmp_path / "sub [1]" / "out.md"
    target.parent.mkdir()
    rows = spark.range(0, 20_000, 1, 9).select(F.col("id").alias("ord"), F.concat(F.lit("é "), "id").alias("line")).orderBy(F.rand(3))
    for _ in range(2):
        textfile.write_lines(rows, str(target), "head\n", "tail\n")
        assert target.read_text().splitlines() == ["head", *(f"é {i}" for i in range(20_000)), "tail"]
        assert os.listdir(target.parent) == ["out.md"]
    failing = rows.withColumn("line", F.when(F.col("ord") == 15_000, F.raise_error(F.lit("no"))).otherwise(F.col("line")))
    with pytest.raises(Exception):
        textfile.write_lines(failing, str(target))
    assert os.listdir(target.parent) == ["out.md"] and target.read_text().startswith("head")
    textfile.write_lines(rows.limit(0), str(target), "a", "b", empty="-")
    assert target.read_text() == "a-b"


def test_listing_is_dealt_out(spark, tmp_path):
    found = set()
    for a in range(6):
        for b in range(5):
            (tmp_path / f"top/d{a}/e{b}").mkdir(parents=True)
            for c in range(b):
                (tmp_path / f"top/d{a}/e{b}/f{c}").write_text("")
    (tmp_path / "top/d1/skip/x").mkdir(parents=True)
    for folder, dirs, files in os.walk(tmp_path):
        dirs[:] = [] if folder.endswith("skip") else dirs
        found |= {os.path.relpath(os.path.join(folder, n), tmp_path) for n in dirs + files}
    for tasks in (1, 4, 20, 1000):
        for levels in range(6):
            seen = read_directory(spark, str(tmp_path), levels, ("skip",), tasks)
            assert names(seen) == sorted(p for p in found if p.count("/") < levels)
            if levels == 5 and tasks > 1:
                sizes = [len(p) for p in seen.rdd.glom().collect()]
                assert len(sizes) == min(tasks, len(sizes)) > 3 and max(sizes) < len(found) / 2


def test_expanding_ends_at_a_loop(spark):
    rows = [("a", ""), ("b", "a"), ("c", "b"), ("a", "c"), ("d", "c"), ("x", "a"), ("d", "x"), ("far", "y"), ("", "d")]
    table = spark.createDataFrame(rows, "id string, parent string")
    got = sorted(tuple(r) for r in expand(table, "").collect())
    assert got == [("a", "", 1), ("b", "a", 2), ("c", "b", 3), ("d", "x", 3), ("x", "a", 2)]
    assert sorted(tuple(r) for r in expand(table, "", 2).collect()) == [r for r in got if r[2] <= 2]
    assert expand(table, "", 0).count() == 0 and expand(table, "none").count() == 0
    chain = spark.createDataFrame([(str(i + 1), str(i)) for i in range(12)], "id string, parent string")
    assert sorted((int(r["id"]), r["depth"]) for r in expand(chain, "0").collect()) == [(i, i) for i in range(1, 13)]


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
