"""Benchmark decontamination: n-gram seeds and alignment (operator 4).

Benchmark items are taken in blocks of bounded text, each block searched
against all documents in one pass. Every n-gram of an item is a seed, so any
unedited stretch of ``seed_words`` words of an item is found; leaving out the
more common of two neighbours would lose the copies that hold only that one.
Documents meet items on the seeds, through an index of the block's n-grams that
is broadcast (bounded by the block). A common phrase brings up many items, so
items and stretches with too few shared words to reach ``min_score`` go before
the alignment; a score cannot exceed their number. Where seeds of an item
fall, the stretch of the document around them is aligned with the item by
Smith-Waterman over words (match 1, mismatch and gap -1); the score is divided
by the item's length. ``min_score`` 0.5 is met by a copy with a quarter of its
words replaced, or by half of an item.

Words are lower-cased and end at Unicode white space, punctuation and control
characters; format characters such as soft hyphens are left out. A character of
a script that is written without blanks (Chinese, Japanese, Thai and others) is
a word. Cases: NULL or empty texts and items have no words and match nothing;
items of fewer than ``seed_words`` words match nothing, or with ``short_items``
the documents that hold all their words in sequence; items
with equal words are searched once and all reported; repeated rows are all
reported; an empty table on either side gives no pairs; other columns pass
``drop_contaminated`` unchanged under any name.
"""

from __future__ import annotations

import re
import string
import sys
import unicodedata
from collections import defaultdict
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import as_bytes, slices, text_of

#: ASCII punctuation and controls as blanks.
_BLANK = string.punctuation.encode() + bytes([*range(32), 127])
BLANKED = bytes.maketrans(_BLANK, b" " * len(_BLANK))


def _category_class(wanted) -> str:
    """All characters whose category is wanted, as ranges of a character class."""
    out, start = [], None
    for c in range(0x80, sys.maxunicode + 2):
        inside = c <= sys.maxunicode and wanted(unicodedata.category(chr(c)))
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            out.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return "".join(out)


#: Scripts written without blanks: Thai, Lao, Myanmar, Khmer, Tai Le, New Tai Lue, Tai Tham, Balinese, Han with its
#: radicals and marks, Kana, Bopomofo, Yi, Javanese, Myanmar and Tai Viet extensions, half-width Kana, Han extensions.
UNSPACED = ("\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u1950-\u19ff\u1a20-\u1aaf\u1b00-\u1b7f\u2e80-\u2fdf\u3005-\u3007\u3021-\u3029"
            "\u3031-\u3035\u3038-\u303c\u3040-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\ua000-\ua4cf"
            "\ua980-\ua9ff\uaa60-\uaadf\uf900-\ufaff\uff66-\uff9f\U0001aff0-\U0001b16f\U00020000-\U0003ffff")
#: White space, punctuation and controls end a word, and so does the zero-width space; other format characters are dropped.
_ENDS = re.escape(string.punctuation) + "\\x00-\\x20\\x7f\u200b" + _category_class(lambda c: c[0] in "PZ" or c == "Cc")
WORD = re.compile(f"(?![{_ENDS}])[{UNSPACED}]|[^{_ENDS}{UNSPACED}]+")
FORMAT = re.compile("(?!\u200b)[" + _category_class(lambda c: c == "Cf") + "]+")


def words_of(raw: bytes | None) -> list[bytes]:
    text = text_of(raw).lower()
    if text.isascii():
        return text.encode().translate(BLANKED).split()
    return [w.encode("utf-8", "replace") for w in WORD.findall(FORMAT.sub("", text))]


def smith_waterman(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """(score, end in a, end in b) of the best local alignment; two rows of
    the table are held."""
    column = np.arange(len(b) + 1)
    above = np.zeros(len(b) + 1, np.int64)
    best = (0, 0, 0)
    for i, word in enumerate(a, 1):
        row = np.zeros(len(b) + 1, np.int64)
        np.maximum(above[:-1] + np.where(b == word, 1, -1), above[1:] - 1, out=row[1:])
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + column) - column  # gaps along the row
        j = int(row.argmax())
        if row[j] > best[0]:
            best = (int(row[j]), i, j)
        above = row
    return best


def spread(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (many[0] numbers), first[1], ... in one array."""
    return np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())


def portions(sizes: np.ndarray, most: int = 1 << 20):
    """Slices of about ``most`` in sum of ``sizes``, of one element at least."""
    group = (np.cumsum(sizes) - sizes) // most
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
    return [slice(i, j) for i, j in zip(edges, edges[1:])]


class Block:
    """Benchmark items of one block: vocabulary, words and seeds."""

    def __init__(self, items: list[tuple[object, list[bytes]]], seed_words: int, short_items: bool = False):
        self.n = seed_words
        by_words: dict[tuple, list] = defaultdict(list)
        for item_id, words in items:
            if len(words) >= (1 if short_items else seed_words):
                by_words[tuple(words)].append(item_id)
        self.vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for ws in by_words for w in ws), 1)}
        self.base = len(self.vocabulary) + 1
        self.ids = list(by_words.values())
        self.sizes = np.array([len(ws) for ws in by_words], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.words = np.array([self.vocabulary[w] for ws in by_words for w in ws], np.int64)
        self.index()

    def item(self, i: int) -> np.ndarray:
        return self.words[self.starts[i]:self.starts[i] + self.sizes[i]]

    def index(self) -> None:
        """The seeds, sorted, and the places (item, offset) of each."""
        at, codes = self.codes(self.words)
        item = np.searchsorted(self.starts, at, "right") - 1
        inside = at + self.n <= self.starts[item] + self.sizes[item]
        at, codes, item = at[inside], codes[inside], item[inside]
        order = np.argsort(codes, kind="stable")
        self.seeds, first = np.unique(codes[order], return_index=True)
        self.first = np.append(first, len(order))
        self.at_item, self.at_offset = item[order], (at - self.starts[item])[order]
        #: Items shorter than a seed: length -> first word -> items.
        self.short: dict[int, dict[int, list[int]]] = {}
        for i in np.flatnonzero(self.sizes < self.n).tolist():
            self.short.setdefault(int(self.sizes[i]), {}).setdefault(int(self.item(i)[0]), []).append(i)

    def short_matches(self, numbers: np.ndarray) -> list[tuple]:
        """The items shorter than a seed that the document has word for word,
        at their first place."""
        out = []
        for size, by_word in self.short.items():
            for word in np.intersect1d(numbers, np.array(list(by_word), np.int64)).tolist():
                at = np.flatnonzero(numbers[:max(len(numbers) - size + 1, 0)] == word)
                for one in by_word[word]:
                    same = at
                    for k, w in enumerate(self.item(one).tolist()):
                        same = same[numbers[same + k] == w]
                    if same.size:
                        out.append((self.ids[one], 1.0, size, int(same[0]), int(same[0]) + size))
        return out

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.array(list(map(self.vocabulary.get, words, repeat(0))), np.int64)

    def codes(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and codes of the n-grams whose words are all known. Past
        the range of a long, codes wrap and may collide, which only adds
        candidates for the alignment to refuse."""
        size = len(numbers) - self.n + 1
        if size <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        known = np.ones(size, bool)
        code = np.zeros(size, np.int64)
        for k in range(self.n):
            part = numbers[k:k + size]
            known &= part > 0
            code = code * self.base + part
        at = np.flatnonzero(known)
        return at, code[at]

    def found(self, table: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which codes are in the sorted table, and where."""
        where = np.searchsorted(table, codes)
        hit = np.flatnonzero(table[np.minimum(where, len(table) - 1)] == codes) if len(table) else np.zeros(0, np.int64)
        return hit, where[hit]

    def shared(self, item: np.ndarray, has) -> np.ndarray:
        """For each of the items, how many of its words pass ``has(words,
        positions in item)``."""
        out = [np.zeros(0, np.int64)]
        for s in portions(self.sizes[item]):
            many = self.sizes[item[s]]
            ok = has(self.words[spread(self.starts[item[s]], many)], np.repeat(np.arange(s.start, s.start + len(many)), many))
            out.append(np.add.reduceat(ok, np.cumsum(many) - many, dtype=np.int64))
        return np.concatenate(out)

    def runs(self, numbers: np.ndarray, min_score: float) -> list[np.ndarray]:
        """item, start, end of each stretch of the document that has seeds of
        the item and enough of its words."""
        at, codes = self.codes(numbers)
        hit, seed = self.found(self.seeds, codes)
        none = [np.zeros(0, np.int64)] * 3
        if not hit.size:
            return none
        once = np.unique(seed)
        item = np.unique(self.at_item[spread(self.first[once], self.first[once + 1] - self.first[once])])
        present = np.zeros(self.base, bool)
        present[numbers] = True
        item = item[self.shared(item, lambda words, _: present[words]) >= min_score * self.sizes[item]]
        if not item.size:
            return none
        wanted = np.zeros(len(self.sizes), bool)
        wanted[item] = True
        many, far = self.first[seed + 1] - self.first[seed], int(self.sizes.max())
        wide = len(numbers) + far
        keys = [np.zeros(0, np.int64)]
        for s in portions(many):
            place = spread(self.first[seed[s]], many[s])
            begin = np.repeat(at[hit[s]], many[s]) - self.at_offset[place]
            use = wanted[self.at_item[place]]
            keys.append(np.unique(self.at_item[place[use]] * wide + begin[use] + far))
        item, begin = np.divmod(np.unique(np.concatenate(keys)), wide)
        begin -= far
        size = self.sizes[item]
        slack = size // 2 + 1
        lo, hi = np.maximum(begin - slack, 0), np.minimum(begin + size + slack, len(numbers))
        opens = np.append(True, (np.diff(item) > 0) | (lo[1:] > hi[:-1]))
        item, lo, hi = item[opens], lo[opens], hi[np.append(opens[1:], True)]
        order = np.argsort(numbers, kind="stable")
        placed = numbers[order] * (len(numbers) + 1) + order

        def within(words, run):
            base = words * (len(numbers) + 1)
            after = np.searchsorted(placed, base + lo[run])
            return (after < len(placed)) & (placed[np.minimum(after, len(placed) - 1)] < base + hi[run])

        enough = self.shared(item, within) >= min_score * self.sizes[item]
        return [item[enough], lo[enough], hi[enough]]

    def matches(self, words: list[bytes], min_score: float) -> list[tuple]:
        """(item ids, score, words matched net, start, end) for each item that
        the document has, at its best place."""
        numbers = self.numbers(words)
        found: dict[int, tuple] = {}
        for one, a, b in zip(*(x.tolist() for x in self.runs(numbers, min_score))):
            target, stretch = self.item(one), numbers[a:b]
            # a score cannot exceed the stretch's words that the item has
            if np.isin(stretch, target).sum() < min_score * len(target):
                continue
            score, i, j = smith_waterman(target, stretch)
            if score >= min_score * len(target) and score > found.get(one, (0,))[0]:
                back = smith_waterman(target[:i][::-1], stretch[:j][::-1])
                found[one] = (score, a + j - back[2], a + j)
        return [*((self.ids[one], best[0] / int(self.sizes[one]), *best) for one, best in found.items()), *self.short_matches(numbers)]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, seed_words: int, block_bytes: int, short_items: bool):
    """Items in blocks of about ``block_bytes``; the driver holds one block."""
    held, size = [], 0
    for row in benchmark.select(F.col(id_col).alias("i"), as_bytes(text_col).alias("t")).toLocalIterator():
        raw = bytes(row.t) if row.t is not None else b""
        if held and size + len(raw) > block_bytes:
            yield Block(held, seed_words, short_items)
            held, size = [], 0
        held.append((row.i, words_of(raw)))
        size += len(raw)
    if held:
        yield Block(held, seed_words, short_items)


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", seed_words: int = 3,
                       min_score: float = 0.5, block_bytes: int = 2 << 20, short_items: bool = False) -> DataFrame:
    """(id, item, score, start_word, end_word) of each document that holds an
    item, at its best place."""
    types = [d.select(F.col(c).alias("i")).schema["i"].dataType for d, c in ((docs, id_col), (benchmark, item_col))]
    schema = f"row {types[0].simpleString()}, item {types[1].simpleString()}, score double, start_word long, end_word long"
    found = []
    for block in _blocks(benchmark, item_col, item_text_col, seed_words, block_bytes, short_items):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def search(batches, shared=shared):
            mine = shared.value
            for part in slices(batches, 1):
                at, items, rest = [], [], []
                for i, raw in enumerate(part.column(1).to_pylist()):
                    for ids, score, _, a, b in mine.matches(words_of(raw), min_score):
                        at += [i] * len(ids)
                        items += ids
                        rest += [(score, a, b)] * len(ids)
                columns = list(zip(*rest)) if rest else [(), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(at, pa.int64())), pa.array(items, item_type), pa.array(columns[0], pa.float64()),
                     pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())],
                    names=["row", "item", "score", "start_word", "end_word"])

        from pyspark.sql.pandas.types import to_arrow_type

        item_type = to_arrow_type(types[1])
        found.append(docs.select(F.col(id_col).alias("row"), as_bytes(text_col).alias("raw")).mapInArrow(search, schema))
    if not found:
        found = [docs.sparkSession.createDataFrame([], schema)]
    pairs = reduce(DataFrame.unionAll, found)
    return pairs.select(F.col("row").alias(id_col), F.col("item").alias(item_col), "score", "start_word", "end_word")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", seed_words: int = 3, min_score: float = 0.5,
                      block_bytes: int = 2 << 20, short_items: bool = False) -> DataFrame:
    """The rows that hold no benchmark item, with all their columns. Rows pass
    the search of each block in turn and are never joined or moved."""
    packed = docs.select(F.struct("*").alias("whole"), as_bytes(text_col).alias("raw"))
    for block in _blocks(benchmark, item_col, item_text_col, seed_words, block_bytes, short_items):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def clean(batches, shared=shared):
            mine = shared.value
            for part in slices(batches, 1):
                yield part.filter(pa.array([not mine.matches(words_of(raw), min_score) for raw in part.column(1).to_pylist()]))

        packed = packed.mapInArrow(clean, packed.schema)
    return packed.select("whole.*")
