"""Per-listing text heuristics (E2-E5, P12) as Catalyst expressions.

All of these run inside whole-stage codegen: higher-order array functions
for the badge walk, ``contains`` / ``regexp_extract`` for the text rules.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Badge type carrying mileage; fuel words tried in this order;
# the fallbacks when nothing matches.
MILEAGE_BADGE = "MILEAGE"
FUEL_WORDS = ("Petrol", "Diesel", "Hybrid", "Electric")
UNKNOWN_FUEL = "Unknown"
AUTO_WORD = "Auto"
ENGINE_SIZE_PATTERN = r"(\d\.\d)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def badge_mileage(badges: Column | str) -> Column:
    """Mileage from MILEAGE badges: strip commas, first space-separated token
    as int; an absent text counts as '0'; unparseable text is skipped; the
    last parseable badge wins; no badge -> 0."""
    badges = _col(badges)
    mileage_badges = F.filter(badges, lambda b: b["type"] == F.lit(MILEAGE_BADGE))
    parsed = F.transform(
        mileage_badges,
        lambda b: F.split_part(F.replace(F.coalesce(b["displayText"], F.lit("0")), F.lit(","), F.lit("")),
                               F.lit(" "), F.lit(1)).try_cast("int"))
    good = F.filter(parsed, lambda x: x.isNotNull())
    return F.coalesce(F.try_element_at(good, F.lit(-1)), F.lit(0))


def infer_fuel(sub_title: Column | str, grabber: Column | str,
               fuel_filter: str | Column | None = None) -> Column:
    """Explicit filter wins (empty counts as none); else the first fuel word
    found, case-sensitive, in grabber or subtitle; else 'Unknown'."""
    sub = F.coalesce(_col(sub_title), F.lit(""))
    grab = F.coalesce(_col(grabber), F.lit(""))
    guess = F.lit(UNKNOWN_FUEL)
    for word in reversed(FUEL_WORDS):
        guess = F.when(grab.contains(word) | sub.contains(word), F.lit(word)).otherwise(guess)
    if fuel_filter is None:
        return guess
    if isinstance(fuel_filter, str):
        return F.lit(fuel_filter) if fuel_filter else guess
    return F.coalesce(F.nullif(fuel_filter, F.lit("")), guess)


def infer_transmission(sub_title: Column | str, grabber: Column | str) -> Column:
    sub = F.coalesce(_col(sub_title), F.lit(""))
    grab = F.coalesce(_col(grabber), F.lit(""))
    return F.when(sub.contains(AUTO_WORD) | grab.contains(AUTO_WORD), F.lit("Automatic")).otherwise(F.lit("Manual"))


def infer_engine_size(sub_title: Column | str) -> Column:
    """First d.d anywhere in the subtitle ('12.5 TDI' -> 2.5), else 0.0."""
    hit = F.regexp_extract(F.coalesce(_col(sub_title), F.lit("")), ENGINE_SIZE_PATTERN, 1)
    return F.coalesce(F.nullif(hit, F.lit("")).try_cast("double"), F.lit(0.0))


def brand_from_title(title: Column | str) -> Column:
    """Upper-cased first word when the title has a space, '' otherwise;
    NULL stays NULL."""
    t = _col(title)
    return (F.when(t.isNull(), F.lit(None).cast("string"))
            .when(F.instr(t, " ") > 0, F.upper(F.substring_index(t, " ", 1)))
            .otherwise(F.lit("")))
