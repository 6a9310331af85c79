"""Sharding along a Hilbert curve (operator 6).

Documents are points: each metadata dimension is quantised to ``bits`` bits,
the Hilbert index orders the grid so that neighbours on the curve are
neighbours in every dimension, and the curve is cut into runs of equal row
counts (law ``rows``). A shard then covers a small box of the metadata space,
which readers prune by the minimum and maximum of several columns at once.

Numbers are cut at approximate quantiles over all rows, with bounded sketches.
Text is cut the same way on a number made of the six bytes that follow the
prefix all values share, which keeps its order.

Cases: a NULL dimension has the lowest cell; a NULL text is empty; ties on
the curve are ordered by text checksum, size and id, so copies with equal
metadata stand together and one very common cell can still be cut; repeated
rows are ordered arbitrarily among themselves and are equal; an empty table
gives no rows. Other columns are not read by ``assign``; ``write_shards``
keeps them under any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm.common import as_bytes, settle
from kerbside.session import scratch_path


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of each row of grid coordinates (n, d): the
    coordinates are turned into the curve's transposed form, one bit plane at
    a time, and their bits interleaved."""
    x = [cells[:, i].astype(np.int64).copy() for i in range(cells.shape[1])]
    d = len(x)
    for plane in reversed(range(1, bits)):
        low = (1 << plane) - 1
        for i in range(d):
            flip = x[i] >> plane & 1 == 1
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    turn = np.zeros(len(cells), np.int64)
    for plane in reversed(range(1, bits)):
        turn = np.where(x[d - 1] >> plane & 1 == 1, turn ^ (1 << plane) - 1, turn)
    out = np.zeros(len(cells), np.int64)
    for plane in reversed(range(bits)):
        for i in range(d):
            out = out << 1 | ((x[i] ^ turn) >> plane & 1)
    return out


def _numbers(df: DataFrame, dims: list[str]) -> DataFrame:
    """Each dimension as a double that keeps its order."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    texts = [c for c in dims if not isinstance(kinds[c], (T.NumericType, T.BooleanType, T.DateType, T.TimestampType))]
    shared = {}
    if texts:
        ends = df.agg(*(f(F.col(c).cast("string")).alias(f"{f.__name__}_{i}") for i, c in enumerate(texts) for f in (F.min, F.max))).first()
        for i, c in enumerate(texts):
            a, b = (ends[f"{k}_{i}"] or "" for k in ("min", "max"))
            shared[c] = next((k for k, (p, q) in enumerate(zip(a, b)) if p != q), min(len(a), len(b)))
    out = df
    for c in dims:
        if c in shared:
            rest = F.substring(F.substr(F.col(c).cast("string"), F.lit(shared[c] + 1)).cast("binary"), 1, 6)
            out = out.withColumn(c, F.conv(F.rpad(F.hex(rest), 12, "0"), 16, 10).cast("double"))
        elif isinstance(kinds[c], (T.DateType, T.TimestampType)):
            out = out.withColumn(c, F.unix_timestamp(F.col(c)).cast("double"))
        else:
            out = out.withColumn(c, F.col(c).cast("int" if isinstance(kinds[c], T.BooleanType) else "double").cast("double"))
    return out


def curve(df: DataFrame, dims: list[str], bits: int = 6) -> DataFrame:
    """Add ``curve``, the Hilbert index of the quantised dimensions."""
    marks = [k / (1 << bits) for k in range(1, 1 << bits)]
    cuts = df.agg(*(F.percentile_approx(c, marks, 10000).alias(c) for c in dims)).first()
    edges = [sorted(set(cuts[c] or [])) for c in dims]

    def index(parts):
        for columns in parts:
            cells = []
            for values, edge in zip(columns, edges):
                v = values.to_numpy(dtype="float64", na_value=np.nan)
                cell = np.searchsorted(np.array(edge, "float64"), np.nan_to_num(v, nan=-np.inf), side="right")
                # few distinct values spread over the whole axis, so each dimension steers the curve's high bits
                cells.append(np.where(np.isnan(v), 0, (cell << bits) // (len(edge) + 1)))
            yield pd.Series(hilbert_index(np.stack(cells, axis=1), bits))

    index.__annotations__ = {"parts": Iterator[tuple[pd.Series, ...]], "return": Iterator[pd.Series]}
    return df.withColumn("curve", F.pandas_udf(index, "long")(*(F.col(c) for c in dims)))


def assign(df: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
           dims: tuple[str, ...] = ("lang", "source", "n_chars"), bits: int = 6) -> DataFrame:
    """Per row: id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and
    ``grown_shard`` (NULL under this law).

    Only narrow rows move: a range partitioning on the curve and the tie
    columns, sorted within partitions and written once. A row's rank is its
    partition's offset, from one count per partition, plus its place in it, so
    no task sees all rows. Counts of shards are at most one apart."""
    names = [f"dim_{i}" for i in range(len(dims))]
    text = F.coalesce(as_bytes(text_col), F.lit(b""))
    narrow = settle(_numbers(df.select(
        F.col(id_col).alias("row_id"), (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), *(F.col(c).alias(n) for c, n in zip(dims, names))), names), "narrow")
    order = ["curve", "text_crc32", "size", "row_id"]
    ranged = curve(narrow, names, bits).select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    placed = settle(ranged.withColumns({"part": F.shiftright(place, 33), "place": place.bitwiseAND(F.lit((1 << 33) - 1))}), "ranged")
    counts = {r.part: r.n for r in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    total, before, offsets = sum(counts.values()), 0, []
    for part in sorted(counts):
        offsets.append((part, before))
        before += counts[part]
    # One row per partition of the sort: bounded by the partition count.
    table = df.sparkSession.createDataFrame(offsets, "part long, before long")
    rank = F.col("before") + F.col("place")
    shard = F.expr(f"cast((before + place) * {shards}L div {max(total, 1)}L as int)")
    first = F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")
    return (placed.join(F.broadcast(table), "part").withColumn("shard", shard)
            .select(F.col("row_id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                    (rank - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve"))



def write_shards(df: DataFrame, path: str, shards: int = 40, dims: tuple[str, ...] = ("lang", "source", "n_chars"),
                 bits: int = 6) -> DataFrame:
    """Write whole rows as ``shards`` runs of the curve, one folder each
    (``shard=N``), and return per shard its count and the minimum and maximum
    of each dimension, which readers use to skip shards. Rows are cut at
    approximate shard bounds of the curve by a range partitioning, so a very
    common cell can span folders' files but no task holds more than its range."""
    names = [f"dim_{i}" for i in range(len(dims))]
    whole = df.select(F.struct("*").alias("whole"), *(F.col(c).alias(n) for c, n in zip(dims, names)))
    indexed = curve(_numbers(whole, names), names, bits).select("whole", "curve")
    tie = F.xxhash64(F.to_json("whole"))
    ranged = indexed.withColumn("tie", tie).repartitionByRange(shards, "curve", "tie")
    out = ranged.withColumn("shard", F.spark_partition_id())
    rows = out.sortWithinPartitions("curve", "tie").select("shard", F.struct("whole.*").alias("row"))
    target = path or scratch_path(df.sparkSession, "shards")
    rows.write.partitionBy("shard").parquet(target)
    back = df.sparkSession.read.parquet(target)
    return back.groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"), *(
        f(F.col(f"row.`{c}`")).alias(f"{k}_{c}") for c in dims for k, f in (("min", F.min), ("max", F.max))))
