"""JSON text as Python's ``json.dumps(json.loads(text), separators=(",", ":"))`` writes it.

The text is taken apart into tokens and each token is rewritten where it lies, so
keys keep their order and nothing is built that is larger than the text.  All
repetitions are possessive: strings of any length pass.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of

STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
NUMBER = r"-?[0-9]++(?:\.[0-9]++)?+(?:[eE][+-]?[0-9]++)?+"
TOKEN = rf"{STRING}|{NUMBER}|[A-Za-z]++|[^ \t\n\r]"
#: runs that stay, escapes by number, escaped slashes, runs of characters that are escaped
PIECE = r"(?:[\x20-\x5b\x5d-\x7e]++|\\[^u/])++|\\u[0-9a-fA-F]{4}|\\/|[^\x20-\x7e]++"


def compact_json(c) -> Column:
    """JSON text without whitespace outside strings."""
    return F.regexp_replace(col_of(c), rf"({STRING})|[ \t\n\r]++", "$1")


def python_float(x: Column) -> Column:
    """``repr`` of a double: the shortest digits that read back as the same value,
    in scientific notation below 1e-4 and from 1e16.

    Whole numbers of more than 16 digits are rounded half to even as 64-bit integers.
    Beyond 2**63 a value midway between two texts of 16 digits may get the other
    one; it reads back the same."""
    def whole(a: Column) -> Column:
        def rounded(v: Column) -> Column:
            unit = F.when(v < 10**16, 1).when(v < 10**17, 10).when(v < 10**18, 100).otherwise(1000).cast("long")
            head, rest = F.call_function("div", v, unit), v % unit
            return (head + F.when(rest * 2 > unit, 1).when(rest * 2 == unit, head % 2).otherwise(0)) * unit

        text = lambda near: F.when(near.cast("double") == a, F.concat(
            F.substring(near.cast("string"), 1, 1), F.lit("."), F.substring(near.cast("string"), 2, 20), F.lit("e"), F.length(near.cast("string")) - 1))
        return F.when((a >= float(1 << 53)) & (a < float(1 << 63)), _let(rounded(a.cast("long")), text))

    def scientific(a: Column) -> Column:
        reads_back = lambda p: _let(F.format_string(f"%.{p}e", a), lambda t: F.when(t.cast("double") == a, t))
        return F.coalesce(reads_back(0), reads_back(14), whole(a), reads_back(15), F.format_string("%.16e", a))

    def laid_out(d: Column) -> Column:
        digits, e, k = d["digits"], d["e"], F.length(d["digits"])
        fixed = (F.when(e < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits))
                 .when(k <= e + 1, F.concat(digits, F.repeat(F.lit("0"), e + 1 - k), F.lit(".0")))
                 .otherwise(F.concat(F.substring(digits, F.lit(1), e + 1), F.lit("."), F.substring(digits, e + 2, k))))
        mantissa = F.when(k == 1, digits).otherwise(F.concat(F.substring(digits, 1, 1), F.lit("."), F.substring(digits, F.lit(2), k)))
        power = F.concat(F.when(e < 0, "-").otherwise("+"), F.when(F.abs(e) < 10, "0").otherwise(""), F.abs(e).cast("string"))
        return F.when((e >= -4) & (e < 16), fixed).otherwise(F.concat(mantissa, F.lit("e"), power))

    parts = lambda sci: F.struct(
        F.regexp_replace(F.replace(F.substring_index(sci, "e", 1), F.lit("."), F.lit("")), "(?<=.)0+$", "").alias("digits"),
        F.substring_index(sci, "e", -1).cast("int").alias("e"))
    text = _let(F.abs(x), lambda a: F.when(a == float("inf"), "Infinity").when(F.isnan(a), "NaN").otherwise(
        _let(_let(scientific(a), parts), laid_out)))
    return F.concat(F.when(x.cast("string").startswith("-"), "-").otherwise(""), text)


def _let(value: Column, f) -> Column:
    """``f(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _number(token: Column) -> Column:
    return F.when(token.rlike("[.eE]"), python_float(token.cast("double"))).when(token == "-0", "0").otherwise(token)


def _string(token: Column) -> Column:
    """A string token in ASCII, escaped as Python does."""
    short = {8: r"\b", 9: r"\t", 10: r"\n", 12: r"\f", 13: r"\r", 34: r"\"", 92: r"\\"}

    def piece(p: Column) -> Column:
        code = F.conv(F.substring(p, 3, 4), 16, 10).cast("int")
        named = F.when(code.between(32, 126) & ~code.isin(34, 92), F.char(code))
        for value, text in short.items():
            named = named.when(code == value, text)
        units = F.lower(F.hex(F.encode(p, "UTF-16BE")))
        return (F.when(p.startswith("\\u"), named.otherwise(F.lower(p))).when(p == "\\/", "/")
                .when(p.rlike(r"^[^\x20-\x7e]"), F.regexp_replace(units, "(....)", r"\\u$1")).otherwise(p))

    pieces = F.array_join(F.transform(F.regexp_extract_all(token, F.lit(PIECE), F.lit(0)), piece), "")
    return F.when(token.rlike(r"\\[u/]|[^\x20-\x7e]"), pieces).otherwise(token)


def python_json(c) -> Column:
    """JSON text as Python writes it: no whitespace outside strings, numbers as
    ``int`` and ``float`` print, strings in ASCII with Python's escapes.

    A key that stands twice in an object stays twice (Python keeps the last);
    text that is no JSON only loses the whitespace outside strings; null stays null.
    """
    c = col_of(c)
    one = lambda t: F.when(t.startswith('"'), _string(t)).when(t.rlike("^-?[0-9]"), _number(t)).otherwise(t)
    tokens = F.array_join(F.transform(F.regexp_extract_all(c, F.lit(TOKEN), F.lit(0)), one), "")
    # most texts hold nothing but plain strings and whole numbers
    rewritten = c.rlike(r"\\[u/]|[^\t\n\r\x20-\x7e]|[0-9][.eE]|-0") & F.get_json_object(c, "$").isNotNull()
    return F.when(rewritten, tokens).otherwise(compact_json(c))
