"""L3: the warehouse models in dependency order: staging view -> fact
table -> impact mart (K6 materialisation per model)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from kerbside.functions.compliance import AS_OF_YEAR
from kerbside.operators.gold import impact_summary
from kerbside.operators.warehouse import build_fact, stage_listings
from kerbside.sinks.layers import materialize


def run_warehouse_models(raw: DataFrame, price_mode: str = "fail", as_of_year: int = AS_OF_YEAR,
                         materializations: dict[str, str] | None = None,
                         location: str | None = None) -> dict[str, DataFrame]:
    """Returns {'stg_cars', 'fct_cars', 'mart_ulez_impact'}. With
    ``materializations`` (model -> 'view' | 'table') and a ``location`` the
    models are also materialised; tables are written once and read back so
    the mart does not recompute the fact."""
    kinds = {"stg_cars": "view", "fct_cars": "table", "mart_ulez_impact": "table", **(materializations or {})}
    stg = stage_listings(raw, price_mode)
    if location:
        stg = materialize(stg, "stg_cars", kinds["stg_cars"], location)
    fct = build_fact(stg, as_of_year)
    if location:
        fct = materialize(fct, "fct_cars", kinds["fct_cars"], location)
    mart = impact_summary(fct)
    if location:
        mart = materialize(mart, "mart_ulez_impact", kinds["mart_ulez_impact"], location)
    return {"stg_cars": stg, "fct_cars": fct, "mart_ulez_impact": mart}
