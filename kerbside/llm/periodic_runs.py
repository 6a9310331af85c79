"""Periodic runs of words (operator 12).

A run is a stretch of consecutive words with smallest period q (words q apart
are equal), at least ``max(min_length, exponent * q)`` words long, that no
neighbouring word extends with that period.

Recompression: the word sequence is rewritten in rounds. A round first
replaces each block of equal neighbours by one symbol (letter and run length),
then, with the letters parted into left and right ones, each left-right pair
by one symbol. Equal stretches are rewritten alike but for a bounded border,
so the rounds are a run-length grammar in which the longest common extension
of two positions is found by going up while the symbols agree, taking the
border symbols off, and down again to where they differ (``Grammar.extend``;
all queries of a batch go together, level by level).

Candidates come from a harmonic grid: a run of period q has at least
(exponent - 1) * q neighbouring positions whose word equals that q further on,
so one of them is on the grid of that spacing, and its neighbours q apart
match as well. Over all q the grids have n log n points. What is left on the
grid is extended both ways by grammar queries, exactly; of runs with the same
ends the smallest period is the run's.

Texts go in batches with a separator of its own between any two, so nothing
extends over a border. Words are numbered per batch. Only texts with a
candidate enter the grammar.

Cases: NULL, empty and blank texts have no words and no runs; repeated rows
each give a row; an empty table gives no rows; a text of any length is taken
whole, with memory in proportion to the longest text (about 150 bytes a
word); other columns are not read, so they may have any name.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import SPACE_CLASS, as_bytes, slices
from kerbside.llm.quality_rules import let

#: Grid points looked at together.
AT_ONCE = 1 << 20


def _names(keys: np.ndarray) -> np.ndarray:
    """A number from 0 for each distinct key."""
    import pandas as pd

    return pd.factorize(keys)[0].astype(np.int64)


class Grammar:
    """Run-length grammar over ``letters`` that starts and ends with a letter
    that occurs once. Queries compare positions with equal ``part``; rounds
    end when no letter occurs twice in a part."""

    def __init__(self, letters: np.ndarray, part: np.ndarray):
        self.rounds = []
        while self._repeats(letters, part):
            begin = np.concatenate([[0], np.flatnonzero(letters[1:] != letters[:-1]) + 1])
            length = np.diff(np.append(begin, len(letters)))
            block_of = np.repeat(np.arange(len(begin)), length)
            blocks = letters[begin]
            if length.max() > 1:
                blocks = _names(blocks * (int(length.max()) + 1) + length)
            first, second = self._pairs(blocks, len(self.rounds))
            child = np.flatnonzero(~second)
            pair_of = np.cumsum(~second) - 1
            self.rounds.append((letters, block_of, begin, length, blocks, first, second, pair_of, child))
            most = int(blocks.max()) + 1
            other = np.where(first[child], blocks[np.minimum(child + 1, len(blocks) - 1)] + 1, 0)
            letters, part = _names(blocks[child] * (most + 1) + other), part[begin][child]

    @staticmethod
    def _repeats(letters: np.ndarray, part: np.ndarray) -> bool:
        import pandas as pd

        return len(pd.unique(part * (int(letters.max()) + 1) + letters)) < len(letters)

    @staticmethod
    def _pairs(blocks: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
        """Part the letters by a bit of their hash, the side that leads being
        the one with more pairs; marks of the first and second of each pair."""
        mixed = (blocks.astype(np.uint64) + np.uint64(1 + turn)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        side = mixed >> np.uint64(63) == 0
        pairs = max(side[:-1] & ~side[1:], ~side[:-1] & side[1:], key=np.count_nonzero)
        return np.append(pairs, False), np.concatenate([[False], pairs])

    def extend(self, x: np.ndarray, y: np.ndarray, step: int) -> np.ndarray:
        """How many letters agree from positions ``x`` and ``y`` on, these
        included, going right (``step`` 1) or left (-1)."""
        start, who = x, np.arange(len(x))
        level_stops, block_stops = [], []  # (who, x, y) that differ at letters, at blocks of each round
        for letters, block_of, begin, length, blocks, first, second, pair_of, _ in self.rounds:
            same = letters[x] == letters[y]
            stops = [(who[~same], x[~same], y[~same])]
            who, x, y = who[same], x[same], y[same]
            bx, by = block_of[x], block_of[y]
            if step > 0:
                left_x, left_y = begin[bx] + length[bx] - x, begin[by] + length[by] - y
            else:
                left_x, left_y = x - begin[bx] + 1, y - begin[by] + 1
            # Of two blocks of one letter the shorter rest ends first, and there the letters differ.
            same = left_x == left_y
            fewer = np.minimum(left_x, left_y)
            stops.append((who[~same], (x + step * fewer)[~same], (y + step * fewer)[~same]))
            level_stops.append(stops)
            inside = (left_x != length[bx]) | (left_y != length[by])
            who, bx, by = who[same], (bx + step * inside)[same], (by + step * inside)[same]
            # A symbol that is the far half of a pair is compared by itself.
            half = second if step > 0 else first
            inside = half[bx] | half[by]
            differ = inside & (blocks[bx] != blocks[by])
            block_stops.append([(who[differ], bx[differ], by[differ])])
            who, bx, by = who[~differ], (bx + step * inside)[~differ], (by + step * inside)[~differ]
            x, y = pair_of[bx], pair_of[by]
        at = (who, x, y)
        for r in range(len(self.rounds) - 1, -1, -1):
            letters, block_of, begin, length, blocks, first, second, pair_of, child = self.rounds[r]
            who, x, y = at
            bx, by = child[x], child[y]
            if step < 0:
                bx, by = bx + first[bx], by + first[by]
            same = blocks[bx] == blocks[by]
            who, bx, by = map(np.concatenate, zip((who, bx + step * same, by + step * same), *block_stops[r]))
            x, y = begin[bx], begin[by]
            if step < 0:
                x, y = x + length[bx] - 1, y + length[by] - 1
            fewer = np.where(letters[x] == letters[y], np.minimum(length[bx], length[by]), 0)
            at = tuple(map(np.concatenate, zip((who, x + step * fewer, y + step * fewer), *level_stops[r])))
        out = np.zeros(len(start), np.int64)
        out[at[0]] = step * (at[1] - start[at[0]])
        return out


def _grid(ends: np.ndarray, sizes: np.ndarray, exponent: int, min_length: int):
    """(positions, periods, neighbours) of the grids, some at a time. ``sizes``
    are the texts' word counts, longest first, ``ends`` their last positions;
    period q's grid covers the texts long enough for a run of it."""
    periods = np.arange(1, max(1, int(sizes[0]) // exponent) + 1)
    need = np.maximum(min_length, exponent * periods)
    long_enough = np.searchsorted(-sizes, -need, side="right")
    periods, need, long_enough = (a[long_enough > 0] for a in (periods, need, long_enough))
    neighbours = need // periods - 1
    spacing = neighbours * periods
    counts = np.maximum(ends[long_enough - 1] - periods, 0) // spacing + 1
    total = np.cumsum(counts)
    start = 0
    while start < len(periods):
        stop = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + AT_ONCE)))
        n = counts[start:stop]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        yield place * np.repeat(spacing[start:stop], n), np.repeat(periods[start:stop], n), np.repeat(neighbours[start:stop], n)
        start = stop


def _candidates(ids: np.ndarray, part: np.ndarray, ends: np.ndarray, sizes: np.ndarray, exponent: int, min_length: int):
    """Grid points (position, period) that a run of that period may hold:
    as many neighbours in a row, q apart, match as any such run has."""
    last = len(ids) - 1
    found = []
    for at, q, neighbours in _grid(ends, sizes, exponent, min_length):
        ok = at + q <= last
        at, q, neighbours = at[ok], q[ok], neighbours[ok]
        ok = (ids[at] == ids[at + q]) & (part[at] == part[at + q])
        at, q, neighbours = at[ok], q[ok], neighbours[ok]
        in_row = np.ones(len(at), np.int64)
        for way in (1, -1):
            on = np.ones(len(at), bool)
            for k in range(1, int(neighbours.max(initial=1))):
                there = at + way * k * q
                on &= (there >= 0) & (there + q <= last)
                on[on] = ids[there[on]] == ids[there[on] + q[on]]
                in_row += on
        ok = in_row >= neighbours
        found.append((at[ok], q[ok]))
    return tuple(map(np.concatenate, zip(*found))) if found else (np.zeros(0, np.int64),) * 2


def runs_of(texts: list[list], exponent: int = 4, min_length: int = 6) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of all runs of the word lists, by text,
    start and period. ``exponent`` is 2 at least: a shorter run need not have
    a grid point."""
    if exponent < 2 or min_length < 2:
        raise ValueError("exponent and min_length must be 2 or more")
    sizes = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] >= min_length]
    if not order.size:
        return (np.zeros(0, np.int64),) * 4
    words = [w for i in order.tolist() for w in texts[i]]
    number = dict(zip(dict.fromkeys(words), range(len(words))))
    sizes = sizes[order]
    # separator, text, separator, text, ..., separator
    ends = np.cumsum(sizes + 1)  # the separator behind each text
    begins = ends - sizes
    ids = np.empty(int(ends[-1]) + 1, np.int64)
    borders = np.concatenate([[0], ends])
    inner = np.ones(len(ids), bool)
    inner[borders] = False
    ids[inner] = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    ids[borders] = len(number) + np.arange(len(borders))
    part = np.concatenate([[0], np.repeat(np.arange(len(sizes)), sizes + 1)])
    at, q = _candidates(ids, part, ends - 1, sizes, exponent, min_length)
    if not at.size:
        return (np.zeros(0, np.int64),) * 4
    # Only texts with candidates enter the grammar; a text goes with the separator behind it.
    held = np.zeros(len(sizes), bool)
    held[part[at]] = True
    keep = held[part]
    keep[0] = True
    moved = np.cumsum(keep) - 1
    grammar = Grammar(_names(ids[keep]), part[keep])
    at = moved[at]
    start, end, period = [], [], []
    for i in range(0, len(at), AT_ONCE):
        a, p = at[i:i + AT_ONCE], q[i:i + AT_ONCE]
        right, left = grammar.extend(a, a + p, 1), grammar.extend(a - 1, a + p - 1, -1)
        s, e = a - left, a + p + right
        ok = e - s >= np.maximum(min_length, exponent * p)
        by = np.lexsort((p[ok], e[ok], s[ok]))
        s, e, p = s[ok][by], e[ok][by], p[ok][by]
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
        start.append(s[new])
        end.append(e[new])
        period.append(p[new])
    s, e, p = map(np.concatenate, (start, end, period))
    by = np.lexsort((p, e, s))
    s, e, p = s[by], e[by], p[by]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    s, e, p = s[new], e[new], p[new]
    whose = part[keep][s]
    out = order[whose], s - moved[begins[whose]], e - s, p
    by = np.lexsort((out[3], out[1], out[0]))
    return tuple(a[by] for a in out)


def collapse(words: list[bytes], start, length, period) -> bytes:
    """The words joined by blanks, without those that a run holds after its
    first period."""
    if not len(start):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return b" ".join(w for w, depth in zip(words, accumulate(change.tolist())) if not depth)


def find_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", exponent: int = 4, min_length: int = 6) -> DataFrame:
    """Per row: id, ``runs`` (array of start, length, period in words, by
    start and period) and ``collapsed``, the text with each run reduced to its
    first period. A narrow pass, no shuffle."""

    def run(batches):
        for part in slices(batches, 1):
            texts = [(raw or b"").split() for raw in part.column(1).to_pylist()]
            whose, *found = runs_of(texts, exponent, min_length)
            bounds = np.searchsorted(whose, np.arange(len(texts) + 1))
            collapsed = [collapse(words, *(f[a:b] for f in found)) for words, a, b in zip(texts, bounds[:-1], bounds[1:])]
            structs = pa.StructArray.from_arrays([pa.array(f, pa.int64()) for f in found], names=["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), structs), pa.array(collapsed, pa.binary())],
                names=["row", "runs", "collapsed"])

    id_type = df.select(F.col(id_col).alias("i")).schema["i"].dataType.simpleString()
    out = (df.select(F.col(id_col).alias("row"), as_bytes(text_col).alias("raw"))
           .mapInArrow(run, f"row {id_type}, runs array<struct<start: long, length: long, period: long>>, collapsed binary"))
    return out.select(F.col("row").alias(id_col), "runs", F.col("collapsed").cast("string").alias("collapsed"))


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Digest columns of ``find_runs``'s result: the number of runs, the
    longest one (ties: smallest start, then period), and hashes."""
    longest = let(F.col("runs"), lambda runs: F.get(F.array_sort(F.transform(runs, lambda r: F.struct(
        (-r["length"]).alias("under"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")))), F.lit(0)))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return (found.withColumn("longest", longest).select(
        id_col, F.size("runs").cast("long").alias("n_runs"), "longest.start", "longest.length", "longest.period",
        F.expr("1000 * longest.length div longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


def with_planted_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) with the rule of the registered query: with h the CRC-32 of
    the decimal id and g = h // 10, a text of n words whose h is divisible by
    10 repeats, from word a = g % n on, the p = 1 + (n - a) // (3 + g % 8)
    words that stand there. Other texts, and those of a NULL id, are unchanged."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))

    def cycled(w):
        n, g = F.size(w), F.expr(f"crc32(cast(cast(`{id_col}` as string) as binary)) div 10")
        a = (g % n).cast("int")
        rest = n - a
        p = (F.lit(1) + F.floor(rest / (F.lit(3) + g % 8))).cast("int")
        times = F.ceil(rest / p).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(F.slice(w, a + 1, p), times)), F.lit(1), rest)
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, F.lit(1), a), tail), " "))

    words = F.filter(F.split(F.col(text_col), f"[{SPACE_CLASS}]+"), lambda w: w != "")
    return df.select(F.col(id_col), F.when(h % 10 == 0, F.coalesce(let(words, cycled), F.col(text_col))).otherwise(
        F.col(text_col)).alias(text_col))
