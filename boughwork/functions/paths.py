"""Expressions over relative path keys: components joined by ``/``, none at either end."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def components(path: Column) -> Column:
    return F.split(path, "/")


def name_of(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def parent_of(path: Column) -> Column:
    """The containing directory's key, empty at the top level."""
    parts = components(path)
    return F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), "/")


def depth_of(path: Column) -> Column:
    """1 for the top level."""
    return F.size(components(path))


def ancestors_of(path: Column) -> Column:
    """Keys of all containing directories, outermost first; empty at the top level."""
    parts = components(path)
    levels = F.filter(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: i > 0)
    return F.transform(levels, lambda i: F.array_join(F.slice(parts, 1, i), "/"))


def suffix_of(name: Column) -> Column:
    """Lower-cased extension with its dot; empty for dotfiles, a final dot and no dot."""
    return F.lower(F.regexp_extract(name, "^.+?([.][^.]+)$", 1))


def normal_extensions(extensions: str | Iterable[str] | None) -> list[str] | None:
    """Lower-cased, with a leading dot, each once; None (no filter) for nothing."""
    if not extensions:
        return None
    given = [extensions] if isinstance(extensions, str) else list(extensions)
    return sorted({e.lower() if e.startswith(".") else "." + e.lower() for e in given}) or None


def preorder_key(path: Column, is_dir: Column) -> Column:
    """Sorts a tree in pre-order: per level directories first, then the lower-cased name,
    then the name. A parent's key is the beginning of its children's."""
    parts = components(path)
    return F.transform(
        parts,
        lambda x, i: F.struct(
            F.when(i < F.size(parts) - 1, False).otherwise(~is_dir).alias("f"), F.lower(x).alias("l"), x.alias("n")
        ),
    )
