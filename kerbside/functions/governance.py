"""Role-based masking and row policies (V1-V3) as column expressions.

The role is an argument (Spark has no session role), so each policy folds to
either the column or a constant at plan time.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Role names, the masked price and text, and the brands the
# developer role may see.
ADMIN_ROLES = ("ULEZ_ADMIN", "SYSADMIN")
TEXT_ROLES = ("ULEZ_ADMIN", "SYSADMIN", "ULEZ_DEVELOPER")
DEVELOPER_ROLE = "ULEZ_DEVELOPER"
MASKED_PRICE = -999.99
MASKED_TEXT = "*********"
DEVELOPER_BRANDS = ("BMW", "AUDI")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mask_price(c: Column | str, role: str, dtype: str = "double") -> Column:
    """The value for admin roles, else -999.99 in the column's numeric type."""
    c = _col(c)
    return c if role in ADMIN_ROLES else F.lit(MASKED_PRICE).cast(dtype)


def mask_text(c: Column | str, role: str) -> Column:
    c = _col(c)
    return c if role in TEXT_ROLES else F.lit(MASKED_TEXT)


def row_policy(brand: Column | str, role: str,
               developer_brands: tuple[str, ...] = DEVELOPER_BRANDS) -> Column:
    """Admins see all rows; the developer role only the listed brands
    (case-sensitive); everyone else none."""
    if role in ADMIN_ROLES:
        return F.lit(True)
    if role == DEVELOPER_ROLE:
        return F.coalesce(_col(brand).isin(*developer_brands), F.lit(False))
    return F.lit(False)
