"""Write a fresh tree document, or update the tree inside one."""

from __future__ import annotations

import argparse
import datetime
import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boughwork.functions.ignore import Rule, parse_rules
from boughwork.operators import documented as docs
from boughwork.operators import filters, layout, parse
from boughwork.sources.directory import as_uri, read_directory, read_lines
from boughwork.sources.scratch import settle
from boughwork.sources.textfile import write_lines


def _rules(root: str, use_gitignore: bool, mode: str) -> list[Rule]:
    path = os.path.join(root, ".gitignore")
    if not use_gitignore or not os.path.isfile(path):
        return []
    with open(path, encoding="utf-8") as f:
        return parse_rules(f.read().splitlines(), mode)


def default_file(root: str) -> str:
    return os.path.join(root, f"directory_structure_{datetime.date.today():%Y-%m-%d}.md")


def _entries(spark: SparkSession, root: str, max_levels: int, extensions, ignore_dirs, use_gitignore: bool, documented: DataFrame | None, mode: str) -> DataFrame:
    dirs = filters.IGNORED_DIRS if ignore_dirs is None else tuple(ignore_dirs)
    found = read_directory(spark, root, max_levels, dirs)
    return filters.visible(found, max_levels, extensions, dirs, _rules(root, use_gitignore, mode), documented, mode)


def export_directory_tree(spark: SparkSession, root_dir: str, output_file: str | None = None, extensions: str | Iterable[str] | None = None, max_levels: int = 3, alignment_col: int = 30, ignore_dirs: Iterable[str] | None = None, use_gitignore: bool = True, mode: str = "git") -> str:
    """Write the tree of a directory, without comments, to one file (by default a dated one in
    the directory) and return its path."""
    if not os.path.isdir(root_dir):
        raise ValueError(f"not a directory: {root_dir}")
    output_file = output_file or default_file(root_dir)
    entries = _entries(spark, root_dir, max_levels, extensions, ignore_dirs, use_gitignore, None, mode)
    write_lines(layout.render(entries, alignment_col), output_file, "```\n", "```\n", empty="\n")
    return output_file


def merge_tree(spark: SparkSession, entries_of, lines: DataFrame, alignment_col: int = 30) -> tuple[DataFrame, DataFrame]:
    """``(new lines, difference)`` of one document's lines (doc_id, line_no, text).

    ``entries_of`` gives the entries to show for the documented ones. ValueError if the
    document has no fenced block with a tree.
    """
    block = parse.tree_block(lines).first()
    if block is None:
        raise ValueError("no fenced block with a tree")
    inside = lines.where((F.col("line_no") > block["start"]) & (F.col("line_no") < block["end"]))
    known = settle(parse.parse_tree(inside).select("relpath", "comment"), "documented")
    entries = settle(entries_of(known), "entries")
    new = layout.render(docs.attach(entries, known).select("relpath", "is_dir", "comment"), alignment_col)
    return parse.splice(lines, (block["start"], block["end"]), new), docs.difference(entries, known)


def report(md_file: str, difference: DataFrame) -> str:
    """What was added, in tree order, and removed, by name."""
    rows = sorted(difference.where("status <> 'found'").collect(), key=lambda r: r["ord"])
    out = [f"Updated '{md_file}':"]
    for status, sign in (("added", "+"), ("removed", "-")):
        own = [f"    {sign} {r['path']}" for r in rows if r["status"] == status]
        out += [f"  {status.capitalize()} ({len(own)}):", *own] if own else [f"  {status.capitalize()}: none"]
    return "\n".join(out)


def update_directory_tree(spark: SparkSession, root_dir: str, md_file: str, extensions: str | Iterable[str] | None = None, max_levels: int = 3, alignment_col: int = 30, ignore_dirs: Iterable[str] | None = None, use_gitignore: bool = True, mode: str = "git") -> str:
    """Update the tree inside a markdown file, keeping comments, and return what changed."""
    if not os.path.isfile(md_file):
        raise FileNotFoundError(md_file)
    if not os.path.isdir(root_dir):
        raise ValueError(f"not a directory: {root_dir}")
    lines = read_lines(spark, as_uri(md_file))
    new, difference = merge_tree(spark, lambda known: _entries(spark, root_dir, max_levels, extensions, ignore_dirs, use_gitignore, known, mode), lines, alignment_col)
    said = report(md_file, difference)
    write_lines(new, md_file)
    return said


def main(argv: list[str] | None = None) -> None:
    """Update ``md_file`` (from the working folder), or with -c write a new file (from --root)."""
    parser = argparse.ArgumentParser(description=main.__doc__)
    parser.add_argument("md_file", nargs="?")
    parser.add_argument("-c", "--create", nargs="?", const="", metavar="NEW_FILE")
    parser.add_argument("--root", default=".")
    parser.add_argument("--max-levels", type=int, default=3)
    parser.add_argument("--alignment-col", type=int, default=30)
    parser.add_argument("--ext", nargs="*")
    parser.add_argument("--no-gitignore", action="store_true")
    parser.add_argument("--debug", action="store_true")
    given = parser.parse_args(argv)
    if given.create is None and not given.md_file:
        parser.error("name a markdown file, or give -c")
    spark = SparkSession.builder.appName("boughwork").getOrCreate()
    options = {"extensions": given.ext, "max_levels": given.max_levels, "alignment_col": given.alignment_col, "use_gitignore": not given.no_gitignore}
    if given.debug:
        print(f"[debug] Scanning root: {os.path.abspath(given.root)}")
        if os.path.isdir(given.root):
            top = layout.preorder(_entries(spark, given.root, 1, given.ext, None, not given.no_gitignore, None, "git")).collect()
            print(f"[debug] Top-level items found ({len(top)}):")
            for r in sorted(top, key=lambda r: r["ord"]):
                print("   ", "[dir] " if r["is_dir"] else "[file]", r["relpath"])
        else:
            print(f"[debug] not a directory: {given.root}")
    if given.create is not None:
        target = os.path.join(given.root, given.create) if given.create else default_file(given.root)
        if os.path.exists(target) and input(f"{target} exists. Overwrite? [y/n] ").strip().lower() != "y":
            print("Left as it is:", target)
            return
        print("Successfully wrote directory structure to:", export_directory_tree(spark, given.root, target, **options))
    else:
        print(update_directory_tree(spark, given.root, given.md_file, **options))


if __name__ == "__main__":
    main()
