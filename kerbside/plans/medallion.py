"""Pipelines: medallion batch (L1), segmentation (L2), document ingest (L4)
and incremental Silver (I1).

Every layer is written once to its own folder and read back, so Gold reads
the persisted Silver instead of repeating the dedup shuffle, and each later
stage starts from files rather than from a long lineage (which also makes a
lost executor cheap to recover from).
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from kerbside.operators import gold, segments
from kerbside.operators.dedup import dedup_latest
from kerbside.operators.silver import build_silver, guard_nonempty, silver_candidates, silver_columns
from kerbside.schemas import SILVER
from kerbside.sinks.layers import write_bronze, write_layer
from kerbside.sources.bronze import read_bronze_union, read_layer
from kerbside.sources.documents import concat_pages, ingest_listings

log = logging.getLogger("kerbside.pipeline")


@dataclass
class MedallionOutput:
    silver: DataFrame
    market_impact: DataFrame
    diesel_devaluation: DataFrame
    paths: dict[str, str]


def run_medallion(spark: SparkSession, bronze_root: str | Sequence[str], out_root: str,
                  tie_breakers: Sequence[str] = (), rule: str = "strict",
                  bronze: DataFrame | None = None) -> MedallionOutput:
    """L1: Q6 -> S2/S3 -> P4-P7, P14 -> W1 -> K2 -> Q6 -> A1 -> K2 -> A2 -> K2.

    Each layer is written whole beside its path and then swapped in. Silver is
    checked for rows on its files, which saves a second dedup; an empty Silver
    raises before any mart is built."""
    raw = bronze if bronze is not None else read_bronze_union(spark, bronze_root, keep_extra=tie_breakers)
    paths = {name: f"{out_root.rstrip('/')}/{name}" for name in
             ("silver/fct_cars", "gold/mart_market_impact", "gold/mart_diesel_devaluation")}
    silver = write_layer(build_silver(raw, tie_breakers=tie_breakers, rule=rule), paths["silver/fct_cars"])
    guard_nonempty(silver, "Silver")
    impact = write_layer(gold.market_impact(silver), paths["gold/mart_market_impact"])
    diesel = write_layer(gold.diesel_devaluation(silver), paths["gold/mart_diesel_devaluation"])
    return MedallionOutput(silver, impact, diesel, paths)


def run_segmentation(spark: SparkSession, silver_path: str, out_path: str,
                     restarts: int = segments.RESTARTS) -> DataFrame | None:
    """L2: S4 -> P15, P16 -> M1-M4 -> K2; an empty input warns and stops."""
    silver = read_layer(spark, silver_path, SILVER)
    if silver.isEmpty():
        log.warning("segmentation skipped: %s has no rows", silver_path)
        return None
    seg = segments.segment_market(spark, silver, restarts=restarts)
    log.info("K=%s silhouette=%s", seg.k, seg.silhouette)
    return write_layer(seg.clusters, out_path)


def ingest_documents(spark: SparkSession, doc_paths: str | Sequence[str], make: str, fuel_type: str,
                     bronze_root: str, at: datetime | None = None, per_line: bool = False) -> bool:
    """L4: S1 -> E1-E5 -> P1 -> E6 -> K1 for one brand x fuel batch (all of its
    pages at once). Returns whether a batch was written."""
    listings = concat_pages(spark, [doc_paths] if isinstance(doc_paths, str) else doc_paths, per_line=per_line)
    batch = ingest_listings(listings, make, fuel_type, at or datetime.now())
    written = write_bronze(batch, bronze_root)
    if not written:
        log.warning("empty batch, nothing written: %s / %s", make, fuel_type)
    return written


def incremental_silver(state: DataFrame, new_bronze: DataFrame, tie_breakers: Sequence[str] = (),
                       rule: str = "strict", stamp: bool = False) -> DataFrame:
    """The Silver state after ``new_bronze``, without re-reading old Bronze.

    ``state`` is ``silver_state``'s table: one row per id with the stamp and
    tie columns it won by. State and the batch's cleaned rows go through one
    dedup by those columns: one shuffle, trimmed per key before it. So a row
    that arrives late does not replace a newer one, the NULL id collapses to
    one row, and the result equals a full refresh over old + new Bronze."""
    fresh, order = silver_candidates(new_bronze, tie_breakers, rule, stamp)
    cols = [*silver_columns(stamp), *order]
    return dedup_latest(state.select(*cols).unionByName(fresh.select(*cols)), "id", order)


def refresh_silver(spark: SparkSession, new_bronze: DataFrame, state_path: str, silver_path: str,
                   tie_breakers: Sequence[str] = (), rule: str = "strict", stamp: bool = True) -> DataFrame:
    """I1's write path: bring the stored state up to date (or start it) and
    publish Silver from it; each is replaced whole."""
    fresh, order = silver_candidates(new_bronze, tie_breakers, rule, stamp)
    cols = [*silver_columns(stamp), *order]
    stored = read_layer(spark, state_path, fresh.select(*cols).schema)
    state = write_layer(incremental_silver(stored, new_bronze, tie_breakers, rule, stamp), state_path)
    return write_layer(state.select(*silver_columns(stamp)), silver_path)
