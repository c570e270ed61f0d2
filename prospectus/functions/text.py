"""String helpers as Column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python treats as whitespace (str.isspace / Unicode ``\s``),
# written so that both Java regex and RE2 read the class the same way.
PY_WS = (r"[\t\n\x{0b}\x{0c}\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}"
         r"\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")


# The same characters as a SQL string literal of \\uXXXX escapes, for btrim.
_WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
             + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000")
WS_LITERAL = "'" + "".join(f"\\u{ord(ch):04x}" for ch in _WS_CHARS) + "'"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """``str.strip()``: Spark's ``trim`` only removes blanks, so trim the whole
    Python whitespace set (a character-set trim, no regex)."""
    return F.call_function("btrim", col_(c), F.expr(WS_LITERAL))


def nullif_empty(c) -> Column:
    c = col_(c)
    return F.when(c != "", c)



def clean_str(c) -> Column:
    """Falsy -> null; whitespace runs -> one blank; strip; '' -> null."""
    return nullif_empty(py_strip(F.regexp_replace(col_(c), f"{PY_WS}+", " ")))


def to_int(c, integer: bool = False) -> Column:
    """Integers pass as they are; text keeps its digits only (sign and dot dropped).

    ``integer`` says that the column is of an integer type (a Column doesn't tell).
    """
    return col_(c).cast("bigint") if integer else _digits_to_bigint(col_(c))


def _digits_to_bigint(c: Column) -> Column:
    digits = F.regexp_replace(c.cast("string"), r"[^0-9]", "")
    return F.when(digits != "", digits.try_cast("bigint"))


def to_float(c) -> Column:
    """Parse as double or null (plain cast raises under ANSI mode)."""
    return col_(c).cast("string").try_cast("double")

