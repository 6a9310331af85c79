"""SimHash near-duplicates by multi-index hashing (operator 3).

A fingerprint has 64 bits: bit ``i`` is set if it is set in more than half of
the text's shingle hashes (XXH64, seed 42). Two texts are linked if their
fingerprints differ in at most ``max_distance`` bits, and linked texts form
components.

The search works on distinct fingerprints. A fingerprint has two segments of
32 bits, each with its table of buckets. Within a segment the Hamming ball of
radius 1 is enumerated; a bucket's address is the ball's point together with
the other segment as it is. Two fingerprints that differ in at most two bits
meet in a bucket: with both bits in one segment, at the point between them;
with one bit in each, at the first's half and the second's other half. The
members of a bucket differ from its address in at most one bit, so a bucket
never has more than 65 fingerprints, however common a segment value is; the
plain form, which files a fingerprint under one segment alone, would compare
all pairs of a large group of near copies. Members fetched from a bucket are
verified by their complete distance and linked to the bucket's first.

Cases: NULL and empty texts, and texts without a word, have fingerprint zero
and are linked like any other; fewer words than a shingle form one shingle of
them all; repeated rows are rows of one component; a NULL id stays a row and
its component is the smallest id that it is linked to, or NULL if there is
none; an empty table gives no rows. Other columns are not read by
``near_duplicates`` and pass ``drop_near_duplicates`` unchanged under any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm.common import as_bytes, settle
from kerbside.llm.components import connected_components

#: Hashes that are spread into bits at a time.
BLOCK = 1 << 15


def fingerprint(raw: bytes | None, shingle_words: int = 3) -> int:
    """The unsigned fingerprint of a text in UTF-8. bytes.lower() and
    bytes.split() know ASCII only: A-Z, and 0x20 and 0x09-0x0D."""
    import xxhash

    words = (raw or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, 42) for s in shingles], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), BLOCK):
        part = hashes[i:i + BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, columns: dict[str, Column | str], text_col: str = "text", shingle_words: int = 3) -> DataFrame:
    """One row per input row: the given columns and ``fp``, the fingerprint as
    a signed long. A narrow pass."""
    def run(batches):
        for batch in batches:
            raw = batch.column(batch.num_columns - 1)
            found = np.empty(len(raw), np.uint64)
            for i in range(len(raw)):
                found[i] = fingerprint(raw[i].as_py(), shingle_words)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found.view(np.int64))],
                                             names=[*batch.schema.names[:-1], "fp"])

    picked = df.select(*(F.col(c).alias(n) if isinstance(c, str) else c.alias(n) for n, c in columns.items()),
                       as_bytes(text_col).alias("raw_text"))
    return picked.mapInArrow(run, T.StructType([*picked.schema.fields[:-1], T.StructField("fp", T.LongType())]))


def links(distinct_fps: DataFrame, max_distance: int = 2) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) that join the
    same components as all pairs within ``max_distance`` bits (0 to 2) do."""
    if not 0 <= max_distance <= 2:
        raise ValueError("balls of radius 1 find distances of 0 to 2 bits")
    if max_distance == 0:
        return distinct_fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("false")
    low = F.expr("transform(sequence(0, 31), i -> fp ^ shiftleft(1L, i))")
    high = F.expr("transform(sequence(32, 63), i -> fp ^ shiftleft(1L, i))")
    filed = distinct_fps.select("fp", F.explode(F.concat(F.array("fp"), low, high)).alias("address"))
    buckets = filed.groupBy("address").agg(F.array_sort(F.collect_list("fp")).alias("found")).where(F.size("found") > 1)
    # At distance 1 or 2 members can be apart by two bits: link all that verify
    # (at most 65 x 64 / 2 pairs) or, where two bits are enough, the first with each.
    if max_distance == 2:
        pairs = buckets.select(F.col("found")[0].alias("a"), F.explode(F.slice("found", 2, 64)).alias("b"))
    else:
        one = buckets.select("found", F.explode("found").alias("a"))
        pairs = one.select("a", F.explode("found").alias("b")).where("a < b")
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance).distinct()


def components_of(marked: DataFrame, max_distance: int = 2) -> DataFrame:
    """``marked`` (row_id, fp) -> (fp, component): the smallest row_id of each
    component, for every distinct fingerprint."""
    least = settle(marked.groupBy("fp").agg(F.min("row_id").alias("least_id")), "fingerprints")
    roots = connected_components(links(least.select("fp"), max_distance))
    rooted = least.join(roots, least.fp == roots.node, "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root"))
    best = rooted.groupBy("root").agg(F.min("least_id").alias("component"))
    return rooted.join(best, "root").select("fp", "component", "root")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = 3, max_distance: int = 2) -> DataFrame:
    """Per row: id, ``fingerprint`` (16 hex digits) and ``component_id``, the
    smallest id that can be reached. A group of copies costs one fingerprint in
    the search; its rows meet the component in a join that adaptive execution
    splits."""
    marked = settle(fingerprints(df, {"row_id": id_col}, text_col, shingle_words), "marked")
    found = components_of(marked, max_distance)
    return marked.join(found, "fp").select(
        F.col("row_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"))


def _content(df: DataFrame) -> Column:
    """A hash of the row's columns, maps left out (they have no hash)."""
    def plain(kind) -> bool:
        if isinstance(kind, T.ArrayType):
            return plain(kind.elementType)
        if isinstance(kind, T.StructType):
            return all(plain(f.dataType) for f in kind.fields)
        return not isinstance(kind, (T.MapType, T.VariantType))

    whole = F.struct("*")
    kept = [f.name for f in df.schema.fields if plain(f.dataType)]
    return F.xxhash64(*(whole.getField(c) for c in kept))


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle_words: int = 3, max_distance: int = 2) -> DataFrame:
    """The rows with one row of each component kept, that with the smallest
    id; among rows of that id, the first by their content's hash. Rows keep
    all their columns. Only ids, content hashes and fingerprints are written;
    the rows themselves move once, to meet the kept ids. ``df`` is read twice:
    pass a written table."""
    id_key = F.coalesce(F.concat(F.lit("i"), F.col(id_col).cast("string")), F.lit("n"))
    marked = settle(fingerprints(df, {"row_id": id_col, "id_key": id_key, "content": _content(df)}, text_col, shingle_words), "marked")
    found = components_of(marked, max_distance).select("fp", "root")
    first = F.min(F.struct(F.col("row_id").isNull().alias("none"), "row_id", "content", "id_key"))
    kept = settle(marked.join(found, "fp").groupBy("root").agg(first.alias("first")).select("first.id_key", "first.content"), "kept")
    # Repeated rows are cut to one per task before the rows are dealt by key;
    # the join with the kept keys then needs no dealing of its own.
    rows = df.select(id_key.alias("id_key"), _content(df).alias("content"), F.struct("*").alias("whole"))
    nth = F.row_number().over(Window.partitionBy("id_key", "content").orderBy(F.lit(1)))
    single = rows.withColumn("nth", nth).where("nth = 1")
    return single.join(kept, ["id_key", "content"], "left_semi").select("whole.*")
