"""Ignore rules: parsed on the driver, the last one that matches decides.

Few rules become Java regular expressions, one a rule. Many are compiled into one
:class:`RuleSet`, which walks a path's components once for all of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import takewhile

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: More rules than this are matched by a :class:`RuleSet`.
MANY_RULES = 64

# The named character classes, as ranges of ASCII.
_NAMED = {
    "alnum": "09AZaz", "alpha": "AZaz", "blank": "\t\t  ", "cntrl": "\x00\x1f\x7f\x7f", "digit": "09", "graph": "!~",
    "lower": "az", "print": " ~", "punct": "!/:@[`{~", "space": "\t\r  ", "upper": "AZ", "xdigit": "09AFaf",
}
_STAR, _ONE, _NEVER = "[^/]*", "[^/]", "(?!)"


@dataclass(frozen=True)
class Rule:
    pattern: str
    negate: bool
    dir_only: bool
    anchored: bool


def parse_rules(lines: list[str], mode: str = "git") -> list[Rule]:
    """One rule a line; blank lines and ``#`` comments don't count. ``!`` negates, a final
    ``/`` asks for a directory, a leading ``/`` anchors at the root. White space at the ends
    goes; in ``git`` mode a space behind a backslash stays. A backslash there takes the
    meaning of ``#``, ``!`` and what follows it."""
    rules = []
    for line in lines:
        rest = line.strip()
        if mode == "git" and _odd_backslashes(rest) and line.lstrip()[len(rest) : len(rest) + 1] == " ":
            rest += " "
        if not rest or rest.startswith("#"):
            continue
        negate = rest.startswith("!")
        rest = rest[1:] if negate else rest
        dir_only = rest.endswith("/")
        rest = rest[:-1] if dir_only else rest
        anchored = rest.startswith("/")
        rules.append(Rule(rest[1:] if anchored else rest, negate, dir_only, anchored))
    return rules


def _odd_backslashes(text: str) -> bool:
    return (len(text) - len(text.rstrip("\\"))) % 2 == 1


def _class(pattern: str, at: int) -> tuple[str, int] | None:
    """The character class that opens at ``at`` as a regex, and the place after it."""
    first = at + 2 if pattern[at + 1 : at + 2] in ("!", "^") else at + 1
    end = pattern.find("]", first + 1)
    if end < 0:
        return None
    body = re.sub(r"([\\\[\]^&~|])", r"\\\1", pattern[first:end])
    negated = pattern[at + 1] == "!"
    if pattern[at + 1] == "^":
        body = r"\^" + body
    return f"[{'^' if negated else ''}{body}]", end + 1


def glob_regex(pattern: str, star: str = ".*", one: str = ".") -> str:
    """A shell pattern as a regex without anchors; an unclosed ``[`` is itself."""
    out, at = [], 0
    while at < len(pattern):
        c = pattern[at]
        if c == "*":
            while at + 1 < len(pattern) and pattern[at + 1] == "*":
                at += 1
            out.append(star)
        elif c == "?":
            out.append(one)
        elif c == "[" and (found := _class(pattern, at)):
            out.append(found[0])
            at = found[1]
            continue
        else:
            out.append(_plain(c))
        at += 1
    return "".join(out)


def _plain(c: str) -> str:
    return c if c.isalnum() or c in "_ " or ord(c) > 0x7F else "\\" + c


def _git_class(pattern: str, at: int) -> tuple[str, int] | None:
    """As :func:`_class`, by the published rules: ``!`` or ``^`` negates, names such as
    ``[:digit:]`` are known, a backslash escapes, and no class holds ``/``. None if it isn't
    closed; an unknown name never matches."""
    at += 1
    negated = pattern[at : at + 1] in ("!", "^")
    at += negated
    ranges: list[tuple[int, int]] = []
    known, opened = True, at

    def letter(i: int) -> tuple[int, int]:
        i += pattern[i] == "\\" and i + 1 < len(pattern)
        return ord(pattern[i]), i + 1

    while at < len(pattern) and (pattern[at] != "]" or at == opened):
        end = pattern.find(":]", at + 2) if pattern.startswith("[:", at) else -1
        if end >= 0:
            pairs = _NAMED.get(pattern[at + 2 : end], "")
            known = known and bool(pairs)
            ranges += [(ord(a), ord(b)) for a, b in zip(pairs[::2], pairs[1::2])]
            at = end + 2
            continue
        low, at = letter(at)
        high = low
        if pattern[at : at + 1] == "-" and pattern[at + 1 : at + 2] not in ("", "]"):
            high, at = letter(at + 1)
        ranges.append((low, high))
    if at >= len(pattern):
        return None
    slash = ord("/")
    cut = [part for a, b in ranges for part in ((a, min(b, slash - 1)), (max(a, slash + 1), b)) if part[0] <= part[1]]
    body = "".join(_plain(chr(a)) + (f"-{_plain(chr(b))}" if b > a else "") for a, b in sorted(set(cut)))
    if not known or not (body or negated):
        return _NEVER, at + 1
    return f"[^/{body}]" if negated else f"[{body}]", at + 1


def git_components(pattern: str) -> list[list[str]]:
    """A pattern's components between slashes, each a list of steps: a regex of one character,
    or ``_STAR``. A backslash takes the next character's meaning; one that ends the pattern
    never matches. An unclosed ``[`` is itself."""
    parts: list[list[str]] = [[]]
    at = 0
    while at < len(pattern):
        c, at = pattern[at], at + 1
        if c == "\\":
            parts[-1].append(_plain(pattern[at]) if at < len(pattern) else _NEVER)
            at += 1
        elif c == "/":
            parts.append([])
        elif c == "[" and (found := _git_class(pattern, at - 1)):
            parts[-1].append(found[0])
            at = found[1]
        else:
            parts[-1].append({"*": _STAR, "?": _ONE}.get(c) or _plain(c))
    return parts


def _spans(part: list[str]) -> bool:
    """Whether a component is ``**``."""
    return part == [_STAR, _STAR]


def _component(part: list[str]) -> str:
    return re.sub(f"(?:{re.escape(_STAR)})+", lambda m: _STAR, "".join(part))


def simple_regex(rule: Rule) -> str:
    """Shell matching of whole paths: ``*`` crosses ``/``; a rule that isn't anchored also
    matches the name alone and any tail that follows a ``/``."""
    body = glob_regex(rule.pattern)
    if rule.anchored:
        return f"(?s)^{body}$"
    return f"(?s)^(?:.*/)?{body}$"


def git_regex(rule: Rule, below: str = "(?:/.*)?") -> str:
    """Published gitignore rules: ``*`` stays within a name, a slash inside anchors, ``**``
    spans directories, and a matched directory takes all ``below`` it along."""
    parts = git_components(rule.pattern)
    out = "" if rule.anchored or len(parts) > 1 else "(?:.*/)?"
    for i, part in enumerate(parts):
        last = i == len(parts) - 1
        if _spans(part):
            out += ".*" if last else "(?:.*/)?"
        else:
            out += _component(part) + ("" if last else "/")
    return f"(?s)^{out}{below}$"


class _Shapes:
    """Patterns by the letters that they end or begin with, so that few are tried for a name."""

    def __init__(self) -> None:
        self._tails: dict[str, list] = {}
        self._heads: dict[str, list] = {}
        self._sizes: tuple[set[int], set[int]] = (set(), set())

    def add(self, head: str, tail: str, item: object) -> None:
        table, key, sizes = (self._heads, head, self._sizes[1]) if len(head) > len(tail) else (self._tails, tail, self._sizes[0])
        table.setdefault(key, []).append(item)
        sizes.add(len(key))

    def of(self, whole: str, starts: tuple[int, ...] = (0,)) -> Iterator[object]:
        """What ``whole``, or what begins at one of ``starts`` in it, may match."""
        for n in self._sizes[0]:
            if n <= len(whole):
                yield from self._tails.get(whole[len(whole) - n :], ())
        for n in self._sizes[1]:
            for at in starts:
                yield from self._heads.get(whole[at : at + n], ())


def _letters(part: list[str]) -> str:
    """The letters of the steps up to the first that isn't one."""
    return "".join(step[-1] for step in takewhile(lambda step: len(step) == 1 or len(step) == 2 and step[0] == "\\", part))


class _Node:
    """Where a walk over a path's components stands: what a next component may lead to."""

    def __init__(self, loops: bool = False) -> None:
        self.names: dict[str, _Node] = {}
        self.shapes: dict[str, _Node] = {}
        self.by_letters = _Shapes()
        self.loops = loops  # any component leads back here
        self.span: _Node | None = None  # the node of a ``**`` that follows
        self.ends: tuple[int, int] = (-1, -1)  # the last rule that ends here, for all and for directories

    def child(self, part: list[str]) -> _Node:
        if _spans(part):
            self.span = self.span or _Node(loops=True)
            return self.span
        head = _letters(part)
        if len(head) == len(part):
            return self.names.setdefault(head, _Node())
        shape = _component(part)
        if shape not in self.shapes:
            self.shapes[shape] = _Node()
            self.by_letters.add(head, _letters(part[::-1])[::-1], (re.compile(f"(?s:{shape})"), self.shapes[shape]))
        return self.shapes[shape]


class RuleSet:
    """Rules in one structure; :meth:`last` gives the place of the last that matches.

    In ``git`` mode a trie over components, in ``simple`` mode a table of the literal rules,
    looked up by a path's tails. Wildcards are tried where the letters at their ends fit.
    """

    def __init__(self, rules: list[Rule], mode: str):
        self._rules, self._mode = rules, mode

    @cached_property
    def _trie(self) -> _Node:
        root = _Node()
        for i, rule in enumerate(self._rules):
            parts = git_components(rule.pattern)
            node = root if rule.anchored or len(parts) > 1 else root.child([_STAR, _STAR])
            for part in parts:
                node = node.child(part)
            node.ends = (node.ends[0] if rule.dir_only else i, i if rule.dir_only else node.ends[1])
        return root

    @cached_property
    def _tables(self) -> tuple[dict, dict, _Shapes]:
        whole, tails, shapes = {}, {}, _Shapes()
        for i, rule in enumerate(self._rules):
            found = re.search(r"(?s)^([^*?\[]*)[*?\[].*?([^*?\]]*)$", rule.pattern)
            if found:
                shapes.add(found[1], found[2], (i, rule.dir_only, re.compile(simple_regex(rule).removesuffix("$"))))
            else:
                table = whole if rule.anchored else tails
                old = table.get(rule.pattern, (-1, -1))
                table[rule.pattern] = (old[0], i) if rule.dir_only else (i, old[1])
        return whole, tails, shapes

    @cached_property
    def _seen(self) -> dict[int, dict[str, list[_Node]]]:
        return {}

    def _next(self, node: _Node, name: str) -> list[_Node]:
        known = self._seen.setdefault(id(node), {})
        if name not in known:
            if len(known) > 100_000:
                known.clear()
            known[name] = [*filter(None, [node.names.get(name)]), *(n for shape, n in node.by_letters.of(name) if shape.fullmatch(name))]
        return known[name]

    def last(self, path: str, is_dir: bool) -> int:
        """-1 if no rule matches."""
        return max(self._git(path, is_dir) if self._mode == "git" else self._simple(path, is_dir), default=-1)

    def _git(self, path: str, is_dir: bool) -> Iterator[int]:
        names = path.split("/")
        nodes = [self._trie]
        for i, name in enumerate(names):
            folder, reached = is_dir or i < len(names) - 1, []
            while nodes:
                node = nodes.pop()
                reached += self._next(node, name)
                if node.loops:
                    reached.append(node)
                if node.span:  # it may take no component at all
                    nodes.append(node.span)
            nodes = list(dict.fromkeys(reached))
            for node in nodes:
                yield node.ends[0]
                if folder:
                    yield node.ends[1]

    def _simple(self, path: str, is_dir: bool) -> Iterator[int]:
        whole, tails, shapes = self._tables
        starts = (0, *(i + 1 for i, c in enumerate(path) if c == "/"))
        for table, keys in ((whole, [path]), (tails, [path[at:] for at in starts])):
            for key in keys:
                plain, folder = table.get(key, (-1, -1))
                yield plain
                if is_dir:
                    yield folder
        for i, dir_only, shape in sorted(shapes.of(path, starts), key=lambda x: -x[0]):
            if (is_dir or not dir_only) and shape.fullmatch(path):
                yield i
                break


def ignored(path: Column, is_dir: Column, rules: list[Rule], mode: str = "git") -> Column:
    """Whether the last rule that matches ignores the entry; false without a match.

    A rule for directories matches a file in ``git`` mode only through a directory above it.
    """
    if mode not in ("git", "simple"):
        raise ValueError(f"unknown mode {mode!r}")
    if len(rules) > MANY_RULES:
        return _by_set(path, is_dir, rules, mode)
    verdict = F.lit(False)
    for rule in rules:
        hit = path.rlike(simple_regex(rule) if mode == "simple" else git_regex(rule))
        if rule.dir_only:
            hit = is_dir & hit if mode == "simple" else F.when(is_dir, hit).otherwise(path.rlike(git_regex(rule, "/.*")))
        verdict = F.when(hit, F.lit(not rule.negate)).otherwise(verdict)
    return verdict


def _by_set(path: Column, is_dir: Column, rules: list[Rule], mode: str) -> Column:
    """A worker compiles the rules once, whatever number of tasks it runs."""
    held = SparkSession.active().sparkContext.broadcast(RuleSet(rules, mode))
    negated = [r.negate for r in rules]

    @F.pandas_udf("boolean")
    def judge(paths: pd.Series, dirs: pd.Series) -> pd.Series:
        last = held.value.last
        found = (last(p, bool(d)) if p is not None else -1 for p, d in zip(paths, dirs))
        return pd.Series([i >= 0 and not negated[i] for i in found], dtype=bool)

    return judge(path, is_dir)
