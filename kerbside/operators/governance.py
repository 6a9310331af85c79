"""Governed views (V4): row policy on the unmasked brand, then masking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.governance import DEVELOPER_BRANDS, mask_price, mask_text, row_policy

DEFAULT_PRICE_COLS = ("avg_price_compliant", "avg_price_non_compliant")
DEFAULT_TEXT_COLS = ("model",)


def filter_rows(df: DataFrame, role: str, brand_col: str = "brand",
                developer_brands: Sequence[str] = DEVELOPER_BRANDS) -> DataFrame:
    """V3 as a table operator."""
    return df.filter(row_policy(brand_col, role, tuple(developer_brands)))


def mask_columns(df: DataFrame, role: str, price_cols: Sequence[str] = (),
                 text_cols: Sequence[str] = ()) -> DataFrame:
    """V1 + V2 as a table operator: masked columns keep their names and order."""
    types = dict(df.dtypes)
    masked = {c: mask_price(c, role, types[c]) for c in price_cols}
    masked.update({c: mask_text(c, role) for c in text_cols})
    return df.select(*[masked.get(c, F.col(c)).alias(c) for c in df.columns])


def governed_view(df: DataFrame, role: str, price_cols: Sequence[str] = DEFAULT_PRICE_COLS,
                  text_cols: Sequence[str] = DEFAULT_TEXT_COLS, brand_col: str = "brand",
                  developer_brands: Sequence[str] = DEVELOPER_BRANDS,
                  view_name: str | None = None) -> DataFrame:
    """V4: filter on the unmasked brand first, then mask; optionally register
    the result as a temp view so consumers only ever see the governed form."""
    out = mask_columns(filter_rows(df, role, brand_col, developer_brands), role, price_cols, text_cols)
    if view_name:
        out.createOrReplaceTempView(view_name)
    return out
