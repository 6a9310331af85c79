"""Importance resampling towards a target distribution (operator 11).

Features are all runs of 1 to 3 consecutive words, joined by a blank; a
feature's bucket is its CRC-32 modulo ``buckets``. Bucket totals of the corpus
and of the target text give each bucket a gain, the scaled and floored log
ratio of its smoothed frequencies. A document's weight is the sum of the gains
of its features; Gumbel noise seeded by its id is added, and the highest
scores are drawn, which is a draw without replacement by weight.

Buckets come from a head-tail vocabulary. One pass finds the words and word
pairs that are frequent in the corpus: each task counts what makes up a share
of ``SHARE`` or more of a block and Spark adds the counts up. The head, bounded
by ``HEAD_WORDS`` and ``HEAD_PAIRS``, is broadcast: for a frequent word its CRC
states (alone, and after a blank), for a frequent pair its CRC, thus its
bucket. A word of the tail takes its CRC from its bytes. A state is carried
over a further word by the CRC's linear shift for that many bytes (tables for
short words) and by the CRC of the bytes themselves for long ones, so every
feature has its exact bucket whether or not it is in the head: the head decides
how fast it is found, never what it is. Both feed the same exact totals.

Words are maximal runs of letters a-z, digits and non-ASCII characters after
lower-casing A-Z only; in UTF-8 those are byte classes.

Cases: NULL, empty and wordless texts have no features, weight 0, and are not
drawn; documents with fewer than ``min_words`` words are not drawn; a NULL id
is an empty one for the noise and comes last among ties; repeated rows are
ranked one after the other; with no target text or no documents all gains
follow from the smoothing alone; an empty table gives no rows; a text of any
length is read in blocks of bounded size. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import as_bytes, ranked, settle, slices

BUCKETS = 10000
HEAD_WORDS, HEAD_PAIRS = 8192, 32768
#: Words and pairs are counted for the head where they make up this share of a block.
SHARE = 1 / 20000
#: Words of up to this many bytes have shift tables and can be in the head.
SHORT = 62
#: Words in a block, about.
BLOCK_WORDS = 1 << 18
PIECE_BYTES = 2 << 20

#: A-Z to a-z; a-z, digits and the bytes of non-ASCII characters stay; all others to a blank.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def pieces(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a few MB at a time."""
    text = raw.translate(WORD_BYTES)
    start = 0
    while start < len(text):
        end = text.find(b" ", start + PIECE_BYTES)
        if end < 0:
            end = len(text)
        yield text[start:end].split()
        start = end


def blocks(texts: Iterable[bytes | None]) -> Iterator[tuple[list[bytes], np.ndarray, int]]:
    """(words, number of the text of each, carried): the words of the texts in
    blocks. A text cut between blocks carries its last two words over; they
    stand first in the next block and end no feature there."""
    words: list[bytes] = []
    owners: list[int] = []
    counts: list[int] = []
    carried = own = 0
    for d, raw in enumerate(texts):
        for k, part in enumerate(pieces(raw or b"")):
            own = own if k else 0  # words of this text in the block
            if len(words) >= BLOCK_WORDS:
                yield words, np.repeat(np.array(owners, np.int64), counts), carried
                carried = own = min(2, own)
                words, owners, counts = words[len(words) - own:], [d], [own]
            words.extend(part)
            owners.append(d)
            counts.append(len(part))
            own += len(part)
    if len(words) > carried:
        yield words, np.repeat(np.array(owners, np.int64), counts), carried


def shift_tables(most: int) -> np.ndarray:
    """``table[n, k, b]``: what byte ``b`` at place ``k`` of a CRC state
    becomes when ``n`` zero bytes follow. The state is linear, so a whole
    state's shift is the XOR over its four bytes."""
    step = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)
    tables = [np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], np.uint32)]
    for _ in range(most):
        tables.append(tables[-1] >> np.uint32(8) ^ step[tables[-1] & np.uint32(255)])
    return np.stack(tables)


class Hasher:
    """Buckets of the features of word lists. ``words`` and ``pairs`` (of
    numbers into ``words``) are the head, the most frequent first."""

    def __init__(self, words: list[bytes], pairs: list[tuple[int, int]]):
        self.number = {w: i for i, w in enumerate(words)}
        self.head = self._states(words)
        self.shifts = shift_tables(SHORT + 1).reshape(-1)
        bits = max(8, (4 * len(pairs)).bit_length())
        self.turn = np.uint64(64 - bits)
        self.pair_key, self.pair_crc = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.uint32)
        first, second = np.array(pairs, np.int64).reshape(-1, 2).T
        crc = self._carry(self.head[0][first], second, self.head)
        slots = self._slot(first * HEAD_WORDS + second)
        for slot, key, c in zip(slots.tolist(), (first * HEAD_WORDS + second).tolist(), crc.tolist()):
            if self.pair_key[slot] < 0:  # a pair that meets a more frequent one is computed like the tail's
                self.pair_key[slot], self.pair_crc[slot] = key, c

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.turn).astype(np.int64)

    @staticmethod
    def _states(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """CRC of each word, CRC of it after a blank, and the bytes of the latter."""
        return (np.fromiter(map(zlib.crc32, words), np.uint32, len(words)),
                np.fromiter((zlib.crc32(b" " + w) for w in words), np.uint32, len(words)),
                np.fromiter(map(len, words), np.int64, len(words)) + 1)

    def _carry(self, state: np.ndarray, codes: np.ndarray, states) -> np.ndarray:
        """CRC states carried over a blank and a short word each."""
        base = np.minimum(states[2][codes], SHORT + 1) << 10
        return (self.shifts[base + (state & np.uint32(255))] ^ self.shifts[base + 256 + (state >> np.uint32(8) & np.uint32(255))]
                ^ self.shifts[base + 512 + (state >> np.uint32(16) & np.uint32(255))]
                ^ self.shifts[base + 768 + (state >> np.uint32(24))] ^ states[1][codes])

    def codes(self, words: list[bytes]) -> tuple[np.ndarray, tuple]:
        """Each word's number, the head's or one after it, and the states by number."""
        codes = np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))
        tail = np.flatnonzero(codes < 0)
        if not tail.size:
            return codes, self.head
        rare = [words[i] for i in tail.tolist()]
        new = {w: k for k, w in enumerate(dict.fromkeys(rare), len(self.number))}
        codes[tail] = np.fromiter(map(new.__getitem__, rare), np.int64, len(rare))
        return codes, tuple(map(np.concatenate, zip(self.head, self._states(list(new)))))

    def features(self, words: list[bytes], owner: np.ndarray, carried: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """(buckets, owners) of all features that end in the block's own words."""
        codes, states = self.codes(words)
        one = states[0][codes]
        at = np.flatnonzero(owner[1:] == owner[:-1]) + 1  # last words of pairs
        two = np.zeros(len(words), np.uint32)
        key = codes[at - 1] * HEAD_WORDS + codes[at]
        slot = self._slot(key)
        known = (self.pair_key[slot] == key) & (np.maximum(codes[at - 1], codes[at]) < len(self.number))
        two[at[known]] = self.pair_crc[slot[known]]
        rest = at[~known]
        two[rest] = self._carry(one[rest - 1], codes[rest], states)
        self._long(words, rest, codes, states, one, two)
        at3 = at[1:][at[1:] == at[:-1] + 1]  # last words of triples: the word before ends a pair of the same text
        three = np.zeros(len(words), np.uint32)
        three[at3] = self._carry(two[at3 - 1], codes[at3], states)
        self._long(words, at3, codes, states, two, three)
        parts = [(one, np.arange(carried, len(words))), (two, at[at >= carried]), (three, at3[at3 >= carried])]
        return (np.concatenate([crc[i] for crc, i in parts]) % np.uint32(buckets)).astype(np.int64), np.concatenate([owner[i] for _, i in parts])

    @staticmethod
    def _long(words, at, codes, states, state, out) -> None:
        """Long words go through the CRC byte by byte."""
        for i in at[states[2][codes[at]] > SHORT + 1].tolist():
            out[i] = zlib.crc32(words[i], zlib.crc32(b" ", int(state[i - 1])))


def frequent(texts: Iterable[bytes | None], words_seen: Counter, pairs_seen: Counter) -> int:
    """Add the frequent words and pairs of the texts to the counters; the
    number of words read."""
    total = 0
    for words, owner, carried in blocks(texts):
        least = max(2, int(len(words) * SHARE))
        common = {w: n for w, n in Counter(words).items() if n >= least and len(w) <= SHORT}
        words_seen.update(common)
        number = {w: i for i, w in enumerate(common)}
        codes = np.fromiter(map(number.get, words, repeat(-1)), np.int64, len(words))
        both = (codes[1:] >= 0) & (codes[:-1] >= 0) & (owner[1:] == owner[:-1])
        keys, n = np.unique(codes[:-1][both] * len(common) + codes[1:][both], return_counts=True)
        names = list(common)
        for key, k in zip(keys[n >= least].tolist(), n[n >= least].tolist()):
            pairs_seen[names[key // len(common)], names[key % len(common)]] += k
        total += len(words) - carried
        for seen in (words_seen, pairs_seen):
            if len(seen) > 8 / SHARE:  # bounded: the least frequent go
                for k, _ in seen.most_common()[int(4 / SHARE):]:
                    del seen[k]
    return total


def head(df: DataFrame, text_col: str) -> tuple[list[bytes], list[tuple[int, int]]]:
    """The frequent words and pairs of all texts, bounded by the head's size."""

    def run(batches):
        words_seen, pairs_seen = Counter(), Counter()
        total = sum(frequent(part.column(0).to_pylist(), words_seen, pairs_seen) for part in slices(batches, 0))
        least = total * SHARE
        rows = [(w, None, n) for w, n in words_seen.items() if n >= least] + [(a, b, n) for (a, b), n in pairs_seen.items() if n >= least]
        for i in range(0, len(rows), 10000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i:i + 10000]), (pa.binary(), pa.binary(), pa.int64()))],
                                             names=["first", "second", "n"])

    seen = df.select(as_bytes(text_col).alias("raw")).mapInArrow(run, "first binary, second binary, n long")
    seen = settle(seen.groupBy("first", "second").agg(F.sum("n").alias("n")), "frequent")
    words = [bytes(r.first) for r in seen.where("second IS NULL").orderBy(F.desc("n"), "first").limit(HEAD_WORDS).collect()]
    number = {w: i for i, w in enumerate(words)}
    pairs = [(number.get(bytes(r.first)), number.get(bytes(r.second)))
             for r in seen.where("second IS NOT NULL").orderBy(F.desc("n"), "first", "second").limit(HEAD_PAIRS).collect()]
    return words, [p for p in pairs if None not in p]


def _worker_hasher(shared) -> Hasher:
    if "hasher" not in shared.value:
        shared.value["hasher"] = Hasher(shared.value["words"], shared.value["pairs"])
    return shared.value["hasher"]


def bucket_totals(df: DataFrame, shared, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features per bucket over all texts, added up in each task
    first: at most one row per bucket and task is shuffled."""

    def run(batches):
        hasher, n = _worker_hasher(shared), np.zeros(buckets, np.int64)
        for part in slices(batches, 0):
            for words, owner, carried in blocks(part.column(0).to_pylist()):
                n += np.bincount(hasher.features(words, owner, carried, buckets)[0], minlength=buckets)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n[at], pa.int64())], names=["bucket", "n"])

    tasks = df.select(as_bytes(text_col).alias("raw")).mapInArrow(run, "bucket long, n long")
    return tasks.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket; ``buckets`` rows reach the driver."""
    spark = source.sparkSession
    both = (spark.range(buckets).withColumnRenamed("id", "bucket")
            .join(source.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left")
            .select("bucket", *(F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in "st")))
    both = settle(both, "buckets")
    sums = both.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()
    ratio = (F.col("t") + 1) * (sums.s + buckets) / ((F.col("s") + 1) * (sums.t + buckets))
    gains = np.zeros(buckets, np.int64)
    for r in both.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain")).collect():
        gains[r.bucket] = r.gain
    return gains


def weigh(df: DataFrame, shared, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``row_id``, ``n_words``, ``n_features`` and ``weight``. A narrow pass."""
    buckets = len(gains)
    given = df.sparkSession.sparkContext.broadcast(gains.astype(np.float64))

    def run(batches):
        hasher, gain = _worker_hasher(shared), given.value
        for part in slices(batches, 1):
            n = len(part)
            n_words, n_features, weight = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for words, owner, carried in blocks(part.column(1).to_pylist()):
                n_words += np.bincount(owner[carried:], minlength=n)
                found, whose = hasher.features(words, owner, carried, buckets)
                n_features += np.bincount(whose, minlength=n)
                weight += np.rint(np.bincount(whose, weights=gain[found], minlength=n)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x, pa.int64()) for x in (n_words, n_features, weight))],
                                             names=["row_id", "n_words", "n_features", "weight"])

    id_type = df.select(F.col(id_col).alias("i")).schema["i"].dataType.simpleString()
    return (df.select(F.col(id_col).alias("row_id"), as_bytes(text_col).alias("raw"))
            .mapInArrow(run, f"row_id {id_type}, n_words long, n_features long, weight long"))


def resample(df: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, seed: int = 42,
             id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """Per row: id, ``n_words``, ``n_features``, ``weight``, ``score`` and
    ``rank`` (from 1; NULL if not drawn). Of the documents of at least
    ``min_words`` words, floor(percent / 100 of them) are drawn: the highest
    scores, ties to the smaller id. Three narrow passes over the texts; only
    ids and numbers are written, ranged by score and counted per partition."""
    words, pairs = head(df, text_col)
    shared = df.sparkSession.sparkContext.broadcast({"words": words, "pairs": pairs})
    gains = bucket_gains(bucket_totals(df, shared, text_col, buckets), bucket_totals(target, shared, target_col, buckets), buckets)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("row_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = settle(weigh(df, shared, gains, id_col, text_col).withColumn("score", F.col("weight") + noise), "scored")
    fit = F.col("n_words") >= min_words
    drawn = scored.where(fit).count() * percent // 100
    places = ranked(scored.where(fit), [F.desc("score"), F.asc_nulls_last("row_id")], "ranked")
    columns = [F.col("row_id").alias(id_col), "n_words", "n_features", "weight", "score"]
    return (places.select(*columns, F.when(F.col("rank") < drawn, F.col("rank") + 1).alias("rank"))
            .union(scored.where(~fit).select(*columns, F.lit(None).cast("long").alias("rank"))))


def draw(df: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The drawn rows with all their columns. Rows are told apart by id."""
    chosen = resample(df, target, id_col=id_col, **options).where("rank IS NOT NULL").select(F.col(id_col).alias("chosen")).distinct()
    whole = df.select(F.struct("*").alias("whole"), F.col(id_col).alias("row_id"))
    return whole.join(chosen, F.col("row_id").eqNullSafe(F.col("chosen")), "left_semi").select("whole.*")
