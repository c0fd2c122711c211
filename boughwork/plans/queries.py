"""Registered queries of the tree operators, and the same results in DuckDB's SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boughwork.functions import ignore, paths
from boughwork.operators import documented as docs
from boughwork.operators import filters, layout, parse
from boughwork.sources.directory import expand


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries: regions and nations as directories, suppliers as files."""
    region = _table(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("r"))
    nation = _table(spark, sf_dir, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    nation = nation.select("n_nationkey", F.concat_ws("/", "r", "n_name").alias("n"))
    supplier = _table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    top = region.select(F.col("r").alias("relpath"), F.lit(True).alias("is_dir"))
    middle = nation.select(F.col("n").alias("relpath"), F.lit(True).alias("is_dir"))
    return top.unionByName(middle).unionByName(supplier.select(F.concat_ws("/", "n", "s_name").alias("relpath"), F.lit(False).alias("is_dir")))


_GEO = """geo AS (
  SELECT r_name AS relpath, true AS is_dir FROM region
  UNION ALL SELECT r_name || '/' || n_name, true FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT r_name || '/' || n_name || '/' || s_name, false FROM supplier
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def web(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries: the hosts, languages and pages of ``pages.url`` without query and fragment."""
    path = F.rtrim(F.regexp_replace(F.regexp_extract("url", "^[a-z]+://([^?#]*)", 1), "/+$", ""))
    leaf = _table(spark, sf_dir, "pages").select(path.alias("relpath")).where("relpath <> ''").distinct()
    above = leaf.select(F.explode(paths.ancestors_of(F.col("relpath"))).alias("relpath")).distinct()
    every = leaf.join(above, "relpath", "left_anti").withColumn("is_dir", F.lit(False))
    return every.unionByName(above.withColumn("is_dir", F.lit(True)))


_WEB = """leaf AS (SELECT DISTINCT regexp_replace(regexp_extract(url, '^[a-z]+://([^?#]*)', 1), '/+$', '') AS relpath FROM pages),
parts AS (SELECT relpath, string_split(relpath, '/') AS p FROM leaf WHERE relpath <> ''),
above AS (SELECT DISTINCT array_to_string(p[1:i], '/') AS relpath FROM (SELECT p, unnest(range(1, len(p))) AS i FROM parts)),
web AS (SELECT relpath, true AS is_dir FROM above UNION ALL
  SELECT relpath, false FROM parts WHERE relpath NOT IN (SELECT relpath FROM above))"""

_KEY = "list_transform(string_split(relpath, '/'), lambda x, i: {'f': CASE WHEN i < len(string_split(relpath, '/')) THEN false ELSE NOT is_dir END, 'l': lower(x), 'n': x})"
_ARRANGED = """named AS (SELECT *, string_split(relpath, '/') AS p FROM {0}),
arranged AS (SELECT relpath, is_dir, p, array_to_string(p[1:len(p)-1], '/') AS parent,
  lead(relpath) OVER w IS NULL AS is_last, coalesce(lag(is_dir) OVER w, false) AS spacer
  FROM named WINDOW w AS (PARTITION BY array_to_string(p[1:len(p)-1], '/') ORDER BY NOT is_dir, lower(p[-1]), p[-1]))"""
_PREFIXED = """prefixed AS (SELECT a.relpath, a.is_dir, a.is_last, a.spacer, a.p,
  coalesce((SELECT string_agg(CASE WHEN b.is_last THEN '    ' ELSE '│   ' END, '' ORDER BY len(b.p)) FROM arranged b
    WHERE starts_with(a.relpath, b.relpath || '/')), '') AS prefix FROM arranged a)"""


def docs_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.col("doc_id").cast("string"), F.lit("."), F.when(F.col("doc_id") % 2 == 0, F.upper("lang")).otherwise(F.col("lang")))
    return _table(spark, sf_dir, "documents").select(F.concat_ws("/", "source", name).alias("relpath"), F.lit(False).alias("is_dir"))


_DOCS = "docs_tree AS (SELECT source || '/' || doc_id || '.' || CASE WHEN doc_id % 2 = 0 THEN upper(lang) ELSE lang END AS relpath, false AS is_dir FROM documents)"


def _known(entries: DataFrame) -> DataFrame:
    """A documented set made from the entries: every other name, with comments, and one that is gone."""
    picked = entries.where(F.length("relpath") % 2 == 0)
    comment = F.when(F.length("relpath") % 4 == 0, F.array(F.concat(F.lit("about "), paths.name_of(F.col("relpath"))), F.lit("second line"))).otherwise(F.array().cast("array<string>"))
    gone = picked.where("not is_dir").select(F.concat("relpath", F.lit(".old")).alias("relpath"), F.array(F.lit("gone")).alias("comment"))
    return picked.select("relpath", comment.alias("comment")).unionByName(gone)


_KNOWN = """known AS (SELECT relpath, CASE WHEN length(relpath) % 4 = 0 THEN ['about ' || string_split(relpath, '/')[-1], 'second line'] ELSE [] END AS comment
  FROM geo WHERE length(relpath) % 2 = 0
  UNION ALL SELECT relpath || '.old', ['gone'] FROM geo WHERE length(relpath) % 2 = 0 AND NOT is_dir)"""

_RULES = ["*.html", "blog.*/", "!blog.*.example.net/", "/*.com/de", "[a-m]*"]


def tree_preorder(spark, sf_dir):
    return layout.preorder(web(spark, sf_dir)).select("ord", "relpath")


def tree_is_last(spark, sf_dir):
    return layout.siblings(web(spark, sf_dir)).select("relpath", "is_last")


def tree_spacers(spark, sf_dir):
    return layout.siblings(web(spark, sf_dir)).select("relpath", "spacer")


def tree_prefix(spark, sf_dir):
    return layout.prefixed(layout.siblings(geo(spark, sf_dir))).select("relpath", "prefix")


def tree_render(spark, sf_dir):
    return layout.render(geo(spark, sf_dir))


def tree_render_comments(spark, sf_dir):
    entries = geo(spark, sf_dir)
    return layout.render(docs.attach(entries, _known(entries)).select("relpath", "is_dir", "comment"))


def tree_depth_limit(spark, sf_dir):
    return filters.depth_limit(web(spark, sf_dir), 2)


def tree_recursive_expand(spark, sf_dir):
    entries = geo(spark, sf_dir).select(F.col("relpath").alias("id"), paths.parent_of(F.col("relpath")).alias("parent"))
    return expand(entries, "", 3)


def filter_ext(spark, sf_dir):
    return filters.by_extension(docs_tree(spark, sf_dir), ["EN", ".fr"]).select("relpath")


def filter_names(spark, sf_dir):
    return filters.by_name(web(spark, sf_dir), ["en", "de"], ["1", "99.html"])


def filter_prune(spark, sf_dir):
    entries = web(spark, sf_dir)
    return filters.prune(entries, filters.by_name(entries, ["en", "de"]))


def ignore_last_match(spark, sf_dir):
    rules = ignore.parse_rules(_RULES)
    return web(spark, sf_dir).select("relpath", ignore.ignored(F.col("relpath"), F.col("is_dir"), rules, "simple").alias("ignored"))


def ignore_git(spark, sf_dir):
    rules = ignore.parse_rules(_RULES)
    return web(spark, sf_dir).select("relpath", ignore.ignored(F.col("relpath"), F.col("is_dir"), rules, "git").alias("ignored"))


def odd_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries named with the letters that mean something in a rule, a file for each document."""
    kinds = ["#", "!", "a*b", "7x", "tail", "Up", "[", "back\\"]
    kind, key = F.element_at(F.array(*map(F.lit, kinds)), (F.col("doc_id") % 8 + 1).cast("int")), F.col("doc_id").cast("string")
    name = F.concat(kind, key, F.when(F.col("doc_id") % 8 == 4, " ").when(F.col("doc_id") % 8 == 6, "]").otherwise(""))
    return _table(spark, sf_dir, "documents").select(F.concat_ws("/", "lang", name).alias("relpath"), F.lit(False).alias("is_dir"))


_ESCAPES = [r"\#*[0-6]", r"\!*[^1-4]", r"a\*b*", "!a[*]b*[!0-4]", "[[:digit:]]x*", "!?[[:alpha:]]*[[:digit:]]1", "tail*\\ ", "[[:upper:]][![:upper:]]*", r"!*[\5-7]", r"\[*[]]", r"[\]\[]?[4]]", "!*[[:nothing:]]*", r"back\\*[\1\3]", "open\\"]


def ignore_escapes(spark, sf_dir):
    rules = ignore.parse_rules(_ESCAPES)
    return odd_names(spark, sf_dir).select("relpath", ignore.ignored(F.col("relpath"), F.col("is_dir"), rules).alias("ignored"))


def _many_rules() -> list[ignore.Rule]:
    """Thousands of rules about single documents, after one about a language."""
    lines = ["*.[Ee][Nn]", *(f"!{k}.EN" for k in range(0, 20_000, 6)), *(f"{k}.*" for k in range(3, 40_000, 9)), *(f"!/*/{k}.?[a-z]" for k in range(3, 30_000, 27))]
    return ignore.parse_rules(lines)


def ignore_many(spark, sf_dir):
    verdict = ignore.ignored(F.col("relpath"), F.col("is_dir"), _many_rules())
    return docs_tree(spark, sf_dir).select("relpath", verdict.alias("ignored"))


def documented_bypass(spark, sf_dir):
    entries = geo(spark, sf_dir)
    return filters.by_rules(entries, ignore.parse_rules(["*A*", "!*Supplier*"]), _known(entries), "simple")


def comment_attach(spark, sf_dir):
    entries = geo(spark, sf_dir)
    return docs.attach(entries, _known(entries)).select("relpath", F.array_join("comment", "|").alias("comment"), "found")


def diff_found(spark, sf_dir):
    entries = geo(spark, sf_dir)
    return docs.found(entries, _known(entries)).select("relpath")


def diff_added(spark, sf_dir):
    entries = geo(spark, sf_dir)
    return docs.added(entries, _known(entries)).select("relpath")


def diff_removed(spark, sf_dir):
    entries = geo(spark, sf_dir)
    return docs.removed(entries, _known(entries)).select("relpath")


def diff_counts(spark, sf_dir):
    entries = geo(spark, sf_dir)
    return docs.difference(entries, _known(entries)).groupBy("status").agg(F.count("*").alias("n"), F.max("ord").alias("last_ord"))


def diff_ordered(spark, sf_dir):
    entries = geo(spark, sf_dir)
    return docs.difference(entries, _known(entries))


def parse_roundtrip(spark, sf_dir):
    """What the rendered tree of ``geo`` documents, each region in a text of its own, read back."""
    entries = geo(spark, sf_dir)
    known = docs.attach(entries, _known(entries)).select("relpath", "is_dir", "comment")
    rendered = layout.render(known, key=F.substring_index("relpath", "/", 1))
    lines = rendered.select(F.col("key").alias("doc_id"), F.col("ord").alias("line_no"), F.col("line").alias("text"))
    return parse.parse_tree(lines).select("relpath", F.array_join("comment", "|").alias("comment"))


def parse_duplicates(spark, sf_dir):
    """Of the entries of a brand's block, one for each part in its size's name, the last counts."""
    part = _table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_size")
    text = F.concat(F.lit("├── size "), "p_size", F.lit("  <- part "), "p_partkey", F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("\n         and key "), "p_partkey")).otherwise(F.lit("")))
    lines = part.select(F.col("p_brand").alias("doc_id"), "p_partkey", F.posexplode(F.split(text, "\n")).alias("pos", "text"))
    lines = lines.select("doc_id", (2 * F.col("p_partkey") + F.col("pos")).alias("line_no"), "text")
    return parse.parse_tree(lines).select("doc_id", "relpath", F.array_join("comment", "|").alias("comment"))


def tree_document(spark, sf_dir):
    """A fenced document for each region, its lines joined."""
    entries = geo(spark, sf_dir)
    rendered = layout.render(entries, key=F.substring_index("relpath", "/", 1))
    lines = F.array_sort(F.collect_list(F.struct("ord", "line")))
    text = F.array_join(F.transform(lines, lambda x: x["line"]), "\n")
    return rendered.groupBy(F.col("key").alias("region")).agg(F.concat(F.lit("```\n"), text, F.lit("\n```\n")).alias("document"))


def lines_explode(spark, sf_dir):
    return parse.lines_of(_table(spark, sf_dir, "documents")).select("doc_id", "line_no", "text")


def _fenced(spark, sf_dir):
    """Document lines where short ones are spacers, and fences or tree lines by number."""
    text = F.when(F.col("line_no") % 4 == 1, F.lit("```")).when(F.length("text") % 7 == 0, F.lit("│   │")).when(F.length("text") % 5 == 0, F.lit("├── x")).otherwise(F.col("text"))
    return lines_explode(spark, sf_dir).withColumn("text", text)


_FENCED = r"""lines AS (SELECT doc_id, unnest(range(0, len(l))) AS line_no, unnest(l) AS raw FROM (
    SELECT doc_id, CASE WHEN l[-1] = '' THEN l[1:len(l)-1] ELSE l END AS l FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))),
fenced AS (SELECT doc_id, line_no, CASE WHEN line_no % 4 = 1 THEN '```' WHEN length(raw) % 7 = 0 THEN '│   │' WHEN length(raw) % 5 = 0 THEN '├── x' ELSE raw END AS text FROM lines)"""


def collapse_runs(spark, sf_dir):
    return parse.collapse_spacers(_fenced(spark, sf_dir))


def fence_pairs(spark, sf_dir):
    found = parse.fenced_blocks(_fenced(spark, sf_dir))
    return found.select("doc_id", F.col("start").alias("start_line"), F.col("end").alias("end_line"), F.coalesce("has_tree", F.lit(False)).alias("has_tree"))


def first_block(spark, sf_dir):
    return parse.tree_block(_fenced(spark, sf_dir)).select("doc_id", F.col("start").alias("start_line"), F.col("end").alias("end_line"))


def splice(spark, sf_dir):
    """The rendered tree put between two regions' names as if those were fences."""
    names = _table(spark, sf_dir, "region").select(F.lit(1).alias("doc_id"), F.col("r_regionkey").alias("line_no"), F.col("r_name").alias("text"))
    return parse.splice(names, (1, 3), tree_render(spark, sf_dir))


def set_diff(spark, sf_dir):
    """Nations outside Asia."""
    nation = _table(spark, sf_dir, "nation")
    asia = _table(spark, sf_dir, "region").where("r_name = 'ASIA'")
    return nation.select("n_nationkey").exceptAll(nation.join(asia, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey"))


def make_help(spark, sf_dir):
    """Targets documented in a make file made of the regions and nations."""
    lines = F.array(F.lit(""), F.concat(F.lit("## About "), "n_name"), F.lit(".PHONY: x"), F.concat(F.lower(F.regexp_replace("n_name", "[^A-Za-z]", "_")), F.lit(": all")), F.lit("\techo"))
    text = _table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("doc_id"), F.posexplode(lines).alias("line_no", "text"))
    return parse.make_help(text).select("doc_id", "target", "description", "line")


_NAMES = """tree_preorder tree_is_last tree_spacers tree_prefix tree_render tree_render_comments tree_depth_limit tree_recursive_expand filter_ext
filter_names filter_prune ignore_last_match ignore_git ignore_escapes ignore_many documented_bypass comment_attach diff_found diff_added diff_removed diff_counts diff_ordered parse_roundtrip parse_duplicates tree_document
lines_explode collapse_runs fence_pairs first_block splice set_diff make_help""".split()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: globals()[name] for name in _NAMES}


def oracle_sql() -> dict[str, str]:
    web_arranged, geo_arranged = _ARRANGED.format("web"), _ARRANGED.format("geo")
    head = "prefix || CASE WHEN is_last THEN '└── ' ELSE '├── ' END || p[-1]"
    lines = f"CASE WHEN spacer THEN [prefix || '│'] ELSE [] END || [{head}]"
    rendered = f"rendered AS (SELECT {_KEY} AS k, unnest(range(0, len({lines}))) AS pos, unnest({lines}) AS line FROM prefixed)"
    ordered = "SELECT row_number() OVER (ORDER BY k, pos) - 1 AS ord, line FROM rendered"
    indent = "(prefix || CASE WHEN is_last THEN '    ' ELSE '│   ' END)"
    first = f"CASE WHEN len(coalesce(comment, [])) = 0 THEN {head} ELSE {head} || repeat(' ', greatest(2, 30 - length({head}))) || '<- ' || comment[1] END"
    said = f"CASE WHEN spacer THEN [prefix || '│'] ELSE [] END || [{first}] || CASE WHEN len(coalesce(comment, [])) > 1 THEN [{indent} || repeat(' ', greatest(1, 33 - length({indent}))) || comment[2]] ELSE [] END"
    commented = f"rendered AS (SELECT {_KEY} AS k, unnest(range(0, len({said}))) AS pos, unnest({said}) AS line FROM prefixed LEFT JOIN known USING (relpath))"
    pairs = f"""WITH {_FENCED}, marked AS (SELECT *, text = '```' AS fence, sum(CASE WHEN text = '```' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS n FROM fenced),
blocks AS (SELECT doc_id, (n - 1) // 2 AS pair, min(line_no) FILTER (WHERE fence) AS start_line, max(line_no) FILTER (WHERE fence) AS end_line,
  coalesce(bool_or(NOT fence AND n % 2 = 1 AND (contains(text, '├──') OR contains(text, '└──'))), false) AS has_tree FROM marked WHERE n > 0 GROUP BY doc_id, pair HAVING max(line_no) FILTER (WHERE fence) > min(line_no) FILTER (WHERE fence))"""
    simple = """CASE WHEN regexp_full_match(relpath, '(.*/)?[a-m].*') THEN true
      WHEN is_dir AND regexp_full_match(relpath, '.*[.]com/de') THEN true
      WHEN is_dir AND regexp_full_match(relpath, '(.*/)?blog[.].*[.]example[.]net') THEN false
      WHEN is_dir AND regexp_full_match(relpath, '(.*/)?blog[.].*') THEN true
      WHEN regexp_full_match(relpath, '.*[.]html') THEN true ELSE false END"""
    simple = simple.replace("WHEN is_dir AND regexp_full_match(relpath, '.*[.]com/de')", "WHEN regexp_full_match(relpath, '.*[.]com/de')")
    git = """CASE WHEN regexp_full_match(relpath, '(.*/)?[a-m][^/]*(/.*)?') THEN true
      WHEN regexp_full_match(relpath, '[^/]*[.]com/de(/.*)?') THEN true
      WHEN regexp_full_match(relpath, CASE WHEN is_dir THEN '(.*/)?blog[.][^/]*[.]example[.]net(/.*)?' ELSE '(.*/)?blog[.][^/]*[.]example[.]net/.*' END) THEN false
      WHEN regexp_full_match(relpath, CASE WHEN is_dir THEN '(.*/)?blog[.][^/]*(/.*)?' ELSE '(.*/)?blog[.][^/]*/.*' END) THEN true
      WHEN regexp_full_match(relpath, '(.*/)?[^/]*[.]html(/.*)?') THEN true ELSE false END"""
    name = "string_split(relpath, '/')[-1]"
    hits = [r"#.*[0-6]", r"!.*[^1-4]", r"a\*b.*", r"a\*b.*[^0-4]", r"[0-9]x.*", r".[A-Za-z].*[0-9]1", r"tail.* ", r"[A-Z][^A-Z].*", r".*[5-7]", r"\[.*\]", r"[\]\[].?4\]", None, r"back\\.*[13]", None]
    last = " ".join(f"WHEN regexp_full_match(name, '{hit}') THEN {not rule.startswith('!')}" for rule, hit in reversed(list(zip(_ESCAPES, hits))) if hit)
    escapes = rf"""SELECT lang || '/' || name AS relpath, CASE {last} ELSE false END AS ignored FROM (SELECT lang, ['#', '!', 'a*b', '7x', 'tail', 'Up', '[', 'back\'][doc_id % 8 + 1] || doc_id || CASE doc_id % 8 WHEN 4 THEN ' ' WHEN 6 THEN ']' ELSE '' END AS name FROM documents)"""
    return {
        "ignore_escapes": escapes,
        "ignore_many": f"WITH {_DOCS}, d AS (SELECT relpath, string_split({name}, '.')[1]::BIGINT AS id, string_split({name}, '.')[2] AS ext FROM docs_tree) SELECT relpath, CASE WHEN id % 27 = 3 AND id < 30000 AND regexp_full_match(ext, '.[a-z]') THEN false WHEN id % 9 = 3 AND id < 40000 THEN true WHEN id % 6 = 0 AND id < 20000 AND ext = 'EN' THEN false ELSE lower(ext) = 'en' END AS ignored FROM d",
        "tree_preorder": f"WITH {_WEB} SELECT row_number() OVER (ORDER BY {_KEY}) - 1 AS ord, relpath FROM web",
        "tree_is_last": f"WITH {_WEB}, {web_arranged} SELECT relpath, is_last FROM arranged",
        "tree_spacers": f"WITH {_WEB}, {web_arranged} SELECT relpath, spacer FROM arranged",
        "tree_prefix": f"WITH {_GEO}, {geo_arranged}, {_PREFIXED} SELECT relpath, prefix FROM prefixed",
        "tree_render": f"WITH {_GEO}, {geo_arranged}, {_PREFIXED}, {rendered} {ordered}",
        "tree_render_comments": f"WITH {_GEO}, {_KNOWN}, {geo_arranged}, {_PREFIXED}, {commented} {ordered}",
        "tree_depth_limit": f"WITH {_WEB} SELECT relpath, is_dir FROM web WHERE len(string_split(relpath, '/')) <= 2",
        "tree_recursive_expand": f"WITH {_GEO} SELECT relpath AS id, array_to_string(p[1:len(p)-1], '/') AS parent, len(p)::INTEGER AS depth FROM (SELECT relpath, string_split(relpath, '/') AS p FROM geo)",
        "filter_ext": f"WITH {_DOCS} SELECT relpath FROM docs_tree WHERE lower(regexp_extract(relpath, '[.][^.]+$')) IN ('.en', '.fr')",
        "filter_names": f"WITH {_WEB} SELECT relpath, is_dir FROM web WHERE NOT (is_dir AND string_split(relpath, '/')[-1] IN ('en', 'de')) AND NOT (NOT is_dir AND string_split(relpath, '/')[-1] IN ('1', '99.html'))",
        "filter_prune": f"WITH {_WEB} SELECT relpath, is_dir FROM web WHERE len(list_filter(string_split(CASE WHEN is_dir THEN relpath ELSE regexp_replace(relpath, '/[^/]*$', '') END, '/'), lambda x: x IN ('en', 'de'))) = 0",
        "ignore_last_match": f"WITH {_WEB} SELECT relpath, {simple} AS ignored FROM web",
        "ignore_git": f"WITH {_WEB} SELECT relpath, {git} AS ignored FROM web",
        "documented_bypass": f"WITH {_GEO}, {_KNOWN} SELECT relpath, is_dir FROM geo WHERE NOT (contains(relpath, 'A') AND NOT contains(relpath, 'Supplier')) OR relpath IN (SELECT relpath FROM known)",
        "comment_attach": f"WITH {_GEO}, {_KNOWN} SELECT relpath, coalesce(array_to_string(comment, '|'), '') AS comment, known.relpath IS NOT NULL AS found FROM geo LEFT JOIN known USING (relpath)".replace("known.relpath IS NOT NULL", "comment IS NOT NULL"),
        "diff_found": f"WITH {_GEO}, {_KNOWN} SELECT relpath FROM geo SEMI JOIN known USING (relpath)",
        "diff_added": f"WITH {_GEO}, {_KNOWN} SELECT relpath FROM geo ANTI JOIN known USING (relpath)",
        "diff_removed": f"WITH {_GEO}, {_KNOWN} SELECT relpath FROM known ANTI JOIN geo USING (relpath)",
        "diff_counts": f"WITH {_GEO}, {_KNOWN}, s AS (SELECT CASE WHEN known.comment IS NOT NULL THEN 'found' ELSE 'added' END AS status FROM geo LEFT JOIN known USING (relpath) UNION ALL SELECT 'removed' FROM known ANTI JOIN geo USING (relpath)) SELECT status, count(*) AS n, count(*) - 1 AS last_ord FROM s GROUP BY status",
        "diff_ordered": f"WITH {_GEO}, {_KNOWN}, s AS (SELECT relpath, CASE WHEN comment IS NOT NULL THEN 'found' ELSE 'added' END AS status, {_KEY} AS k FROM geo LEFT JOIN known USING (relpath)) SELECT relpath AS path, status, row_number() OVER (PARTITION BY status ORDER BY k) - 1 AS ord FROM s UNION ALL SELECT relpath, 'removed', row_number() OVER (ORDER BY relpath) - 1 FROM known ANTI JOIN geo USING (relpath)",
        "parse_roundtrip": f"WITH {_GEO}, {_KNOWN} SELECT relpath, coalesce(array_to_string(comment, '|'), '') AS comment FROM geo LEFT JOIN known USING (relpath)",
        "parse_duplicates": "SELECT p_brand AS doc_id, 'size ' || p_size AS relpath, 'part ' || max(p_partkey) || CASE WHEN max(p_partkey) % 3 = 0 THEN '|and key ' || max(p_partkey) ELSE '' END AS comment FROM part GROUP BY p_brand, p_size",
        "tree_document": f"WITH {_GEO}, {geo_arranged}, {_PREFIXED}, rendered AS (SELECT p[1] AS region, {_KEY} AS k, unnest(range(0, len({lines}))) AS pos, unnest({lines}) AS line FROM prefixed) SELECT region, '```' || chr(10) || string_agg(line, chr(10) ORDER BY k, pos) || chr(10) || '```' || chr(10) AS document FROM rendered GROUP BY region",
        "lines_explode": f"WITH {_FENCED} SELECT doc_id, line_no, raw AS text FROM lines",
        "collapse_runs": f"WITH {_FENCED}, n AS (SELECT *, lead(text) OVER (PARTITION BY doc_id ORDER BY line_no) AS nx FROM fenced) SELECT doc_id, line_no, text FROM n WHERE NOT regexp_full_match(text, '[│ ]*') OR (nx IS NOT NULL AND NOT regexp_full_match(nx, '[│ ]*'))",
        "fence_pairs": f"{pairs} SELECT doc_id, start_line, end_line, has_tree FROM blocks",
        "first_block": f"{pairs} SELECT doc_id, min(start_line) AS start_line, arg_min(end_line, start_line) AS end_line FROM blocks WHERE has_tree GROUP BY doc_id",
        "splice": f"WITH {_GEO}, {geo_arranged}, {_PREFIXED}, {rendered}, o AS ({ordered}), a AS (SELECT 0 AS part, r_regionkey::BIGINT AS pos, r_name AS line FROM region WHERE r_regionkey <= 1 UNION ALL SELECT 1, ord, line FROM o UNION ALL SELECT 2, r_regionkey, r_name FROM region WHERE r_regionkey >= 3) SELECT row_number() OVER (ORDER BY part, pos) - 1 AS ord, line FROM a",
        "set_diff": "SELECT n_nationkey FROM nation EXCEPT SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'",
        "make_help": "SELECT n_nationkey AS doc_id, t AS target, 'About ' || n_name AS description, t || repeat(' ', greatest(0, 25 - length(t))) || 'About ' || n_name AS line FROM (SELECT *, lower(regexp_replace(n_name, '[^A-Za-z]', '_', 'g')) AS t FROM nation)",
    }
