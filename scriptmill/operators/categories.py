"""Category of a script path (both lookup rules of the original tool).

The category map is 133 fixed directory entries.  The prefix rule is a single
``CASE`` projection (first match in map order, inside whole-stage codegen);
the directory rule looks up the file's directory of each depth the map has.
Neither needs a join.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import CATEGORY_DIRS
from ..functions.text import col_of


def category_by_prefix(path, category_dirs=CATEGORY_DIRS) -> Column:
    """First category, in map order, with a directory that is a string prefix.

    No ``/`` is needed after the directory (``common/travelers`` is
    ``travel``); ``other`` when nothing matches.
    """
    p = col_of(path)
    out = None
    for _, cat, d in category_dirs:
        cond = p.startswith(d)
        out = F.when(cond, F.lit(cat)) if out is None else out.when(cond, F.lit(cat))
    return out.otherwise(F.lit("other"))


def _by_depth(directories) -> dict[int, list[str]]:
    out: dict[int, list[str]] = {}
    for d in directories:
        out.setdefault(d.count("/") + 1, []).append(d)
    return out


def _prefix(path: Column, depth: int) -> tuple[Column, Column]:
    """A file's directory of some depth, and whether it has one (a bare name counts as its own)."""
    prefix = F.substring_index(path, "/", depth)
    return prefix, F.lit(True) if depth == 1 else F.length(path) > F.length(prefix)


def in_category_directory(path, category_dirs=CATEGORY_DIRS) -> Column:
    """Whether a category directory lies above the file: a set lookup per depth, cheap
    enough to be evaluated wherever the optimizer moves it."""
    out = F.lit(False)
    for depth, ds in sorted(_by_depth({d for _, _, d in category_dirs}).items()):
        prefix, has = _prefix(col_of(path), depth)
        out = out | (has & prefix.isin(sorted(ds)))
    return out


def directory_categories(path, category_dirs=CATEGORY_DIRS) -> Column:
    """``array<struct<cat_ord, category>>`` of every category directory above a
    file, in map order: a ``CASE`` over the directories of each depth."""
    of_dir: dict[str, list[tuple[int, str]]] = {}
    for o, c, d in category_dirs:
        of_dir.setdefault(d, []).append((o, c))
    cell = lambda o, c: F.struct(F.lit(o).alias("cat_ord"), F.lit(c).alias("category"))
    none = F.expr("cast(array() as array<struct<cat_ord:int,category:string>>)")
    found = [none]
    for depth, ds in sorted(_by_depth(of_dir).items()):
        prefix, has = _prefix(col_of(path), depth)
        case = F
        for d in ds:
            case = case.when(has & (prefix == d), F.array(*[cell(o, c) for o, c in of_dir[d]]))
        found.append(case.otherwise(none))
    return F.sort_array(F.concat(*found))
