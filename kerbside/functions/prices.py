"""Price parsing and casting (P1, P2, P3, P5). Column expressions only.

Three text-price policies exist and disagree on bad input:

* ``zero`` (Bronze landing): drop '£' and ',', unparseable or missing -> 0.
* ``fail`` (staging model): drop ',' only, hard cast; '£' raises under ANSI.
* ``null`` (warehouse feed): drop '£' and ',', whole-number cast, bad -> NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters stripped from a text price.
POUND = "£"
THOUSANDS = ","
NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _strip_pound_and_commas(c: Column) -> Column:
    return F.replace(F.replace(c.cast("string"), F.lit(POUND), F.lit("")), F.lit(THOUSANDS), F.lit(""))


def _number(text: Column) -> Column:
    """Text as a double, NULL unless all of it is a decimal number: the JVM's
    parser also takes type suffixes such as '12d'."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def parse_price(c: Column | str, mode: str = "zero") -> Column:
    c = _col(c)
    if mode == "zero":
        return F.coalesce(_number(_strip_pound_and_commas(c)), F.lit(0.0))
    if mode == "fail":
        # Raised explicitly, so the failure does not depend on ANSI mode.
        text = F.replace(c.cast("string"), F.lit(THOUSANDS), F.lit(""))
        parsed = _number(text)
        return F.when(text.isNotNull() & parsed.isNull(),
                      F.raise_error(F.concat(F.lit("price is not a number: "), text)).cast("double")
                      ).otherwise(parsed)
    if mode == "null":
        # Whole pounds, half away from zero ('12.5' -> 13), via DECIMAL so the
        # result does not depend on the engine's text->INT rule.
        return F.round(_strip_pound_and_commas(c).try_cast("decimal(18,4)")).try_cast("int")
    raise ValueError(f"unknown price mode {mode!r}")


def cast_price(c: Column | str) -> Column:
    """DECIMAL(10,2); overflow raises, as in the reference engines."""
    return _col(c).cast("decimal(10,2)")
