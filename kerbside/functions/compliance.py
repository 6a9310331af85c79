"""Fuel normalisation, emission-zone compliance and derived metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First compliant model year per fuel, the fuels the lenient
# rule always passes, and the reference year for vehicle age.
PETROL_FROM_YEAR = 2006
DIESEL_FROM_YEAR = 2015
LENIENT_ALWAYS_COMPLIANT = ("Hybrid", "Electric", "Other")
AS_OF_YEAR = 2025


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_fuel(fuel: Column | str) -> Column:
    """lower(trim(x)); trims spaces only, like the reference engines."""
    return F.lower(F.trim(_col(fuel)))


def compliance_flag(fuel: Column | str, year: Column | str, rule: str = "strict") -> Column:
    """strict: on the normalised fuel, petrol >= 2006 or diesel >= 2015, all else false.
    lenient: exact-case Petrol/Diesel thresholds, and Hybrid/Electric/Other true."""
    fuel, year = _col(fuel), _col(year)
    if rule == "strict":
        petrol, diesel = F.lit("petrol"), F.lit("diesel")
        flag = (F.when((fuel == petrol) & (year >= PETROL_FROM_YEAR), F.lit(True))
                .when((fuel == diesel) & (year >= DIESEL_FROM_YEAR), F.lit(True)))
    elif rule == "lenient":
        flag = (F.when((fuel == F.lit("Petrol")) & (year >= PETROL_FROM_YEAR), F.lit(True))
                .when((fuel == F.lit("Diesel")) & (year >= DIESEL_FROM_YEAR), F.lit(True))
                .when(fuel.isin(*LENIENT_ALWAYS_COMPLIANT), F.lit(True)))
    else:
        raise ValueError(f"unknown compliance rule {rule!r}")
    return flag.otherwise(F.lit(False))


def vehicle_age(year: Column | str, as_of_year: int = AS_OF_YEAR) -> Column:
    return F.lit(as_of_year) - _col(year)


def price_per_mile(price: Column | str, mileage: Column | str, zero: str = "null") -> Column:
    """zero='null': price / NULLIF(mileage, 0). zero='zero': mileage > 0 ? price/mileage : 0."""
    price, mileage = _col(price), _col(mileage)
    if zero == "null":
        return price.cast("double") / F.nullif(mileage, F.lit(0))
    if zero == "zero":
        return F.when(mileage > 0, price.cast("double") / mileage).otherwise(F.lit(0.0))
    raise ValueError(f"unknown zero policy {zero!r}")


def price_efficiency(avg_price: Column | str, avg_age: Column | str) -> Column:
    return _col(avg_price) / F.nullif(_col(avg_age), F.lit(0))


def exact_mean(c: Column) -> Column:
    """Mean of a DECIMAL column as DOUBLE, from the exact decimal sum:
    identical in every engine, unlike a DOUBLE running average."""
    return F.sum(c).cast("double") / F.nullif(F.count(c), F.lit(0))


def exact_price(c: Column | str) -> Column:
    """A DOUBLE price as DECIMAL, so that a sum does not depend on row order."""
    return _col(c).cast("decimal(18,4)")
