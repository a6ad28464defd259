"""Column functions that carry Python's text rules into Spark SQL.

All of them are built-in expressions (JVM side, whole-stage codegen); none
is a Python UDF.  Java's ``\\w``, ``\\s``, ``\\d`` and ``.`` differ from
Python's, so the classes are spelled out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python str.strip() / \s : the 29 Unicode whitespace code points.
WS = r"[\t-\r\x{1c}-\x{1f}\x{85}\p{Z}]"
# The same without the newline (whitespace that may sit inside one line).
WSL = r"[\t\x{0b}-\r\x{1c}-\x{1f}\x{85}\p{Z}]"
# Python \w on str patterns.
WORD = r"[\p{L}\p{N}_]"
# Python \d on str patterns.
DIGIT = r"\p{Nd}"
# Python '.' (everything but a newline).
DOT = r"[^\n]"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """``str.strip()`` with Python's whitespace set."""
    return F.regexp_replace(col_of(c), rf"^{WS}+|{WS}+\z", "")


def is_blank(c) -> Column:
    """True when the text is empty or whitespace only."""
    return col_of(c).rlike(rf"^{WS}*\z")


def count_char(c, ch: str) -> Column:
    """Occurrences of a one-character string."""
    c = col_of(c)
    return (F.length(c) - F.length(F.replace(c, F.lit(ch), F.lit("")))).cast("long")


def line_count(c) -> Column:
    """``text.count('\\n') + 1``."""
    return count_char(c, "\n") + F.lit(1)


def decode_text(content) -> Column:
    """Decode bytes as ``utf-8-sig`` with ``errors='replace'`` in text mode.

    Bad bytes become U+FFFD, one leading BOM goes, ``\\r\\n`` and ``\\r``
    become ``\\n``.
    """
    s = F.make_valid_utf8(col_of(content).cast("string"))
    s = F.regexp_replace(s, "^\ufeff", "")
    return F.regexp_replace(s, "\r\n?", "\n")


def relative_path(path, root: str | None) -> Column:
    """Path below ``root`` with ``/`` separators; other paths unchanged."""
    p = F.replace(col_of(path), F.lit("\\"), F.lit("/"))
    if not root:
        return p
    r = root.replace("\\", "/").rstrip("/") + "/"
    return F.when(p.startswith(r), F.substring(p, len(r) + 1, 1 << 30)).otherwise(p)


def path_parts(path) -> Column:
    """Components of a ``/`` separated path (empty parts dropped)."""
    return F.filter(F.split(col_of(path), "/"), lambda x: x != "")


def cut_with_ellipsis(c, keep: int, limit: int) -> Column:
    """``s[:keep] + '...'`` when ``len(s) > limit``, else ``s``."""
    c = col_of(c)
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, keep), F.lit("..."))).otherwise(c)


def fill_template(template, **values) -> Column:
    """``template.format(**values)`` for templates whose values hold no braces.

    Values are substituted one after the other; pass the one that may contain
    brace text last so that nothing is substituted twice.
    """
    out = col_of(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), col_of(value))
    return out


def fixed_6(c) -> Column:
    """``'%.6f' % x``: the binary value rounded half to even (below 2**31; larger
    values as their shortest decimal text rounds).

    Rounding the shortest decimal text gives the same but where that text ends in
    a 5 at the seventh decimal.  There the value is compared with the tie ``p / 2e6``
    exactly: the product with 2e6 and its rounding error (a value split into halves
    of 26 bits makes every partial product exact) less the whole number ``p``.
    """
    x = F.abs(col_of(c).cast("double"))
    # by the shortest decimal text; products with seven digits stay exact
    text = F.when(x < float(1 << 31), x).otherwise(F.lit(0.0)).cast("decimal(28,18)")
    seventh = text * F.lit(10_000_000).cast("decimal(8,0)")
    tie = (seventh == F.floor(seventh)) & (seventh % 10 == 5)
    scale = F.lit(2_000_000.0)
    p = (text * F.lit(2_000_000).cast("decimal(7,0)")).cast("long")
    big = x * F.lit(134_217_729.0)
    high = big - (big - x)
    y = x * scale
    over = (y - p.cast("double")) + ((high * scale - y) + (x - high) * scale)
    below = F.floor(p / 2).cast("long")
    n = below + F.when(over > 0, 1).when(over < 0, 0).otherwise(below % 2)
    million = F.lit(1_000_000)
    exact = F.concat(F.when(col_of(c) < 0, "-").otherwise(""), F.floor(n / million).cast("string"), F.lit("."),
                     F.lpad((n % million).cast("string"), 6, "0"))
    return F.when(tie, exact).otherwise(F.format_string("%.6f", col_of(c).cast("double")))
