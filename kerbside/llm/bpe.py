"""BPE encoding and decoding with a merge automaton (operator 1).

The merges are compiled into one deterministic automaton by successive merge
gadgets. Before any merge the automaton has a single state in which every byte
may follow every byte. The gadget of merge ``(x, y) -> xy`` takes each path
``p -x-> q -y-> r``, adds the arc ``p -xy-> r`` and sends ``x`` to a copy of
``q`` that has no ``y`` arc. By induction the state reached depends only on
the last token read, so states are tokens, and the arcs leaving token ``u``
are: those of its right half at the moment ``u`` was made, plus one for each
later token whose left half could follow, minus the merges ``(u, .)``. These
inherited rows are kept as the parent links ``left``/``right`` with the merge
number, and a row's entries are filled in on first use (``follows``).

A word's BPE tokens are the only path through the automaton that spells the
word. A word prefix has one such path too, so the search (longest arc first)
visits each byte position at most once.

Cases: a NULL text is an empty text (no tokens); an empty text decodes to an
empty text; a special token's string in a text is that token; bytes that are
not UTF-8 are read as U+FFFD; every input row gives one output row, repeated
rows included. Columns of the input other than id and text are not read, so
extra columns may have any name.
"""

from __future__ import annotations

import gc
import json
import re
import unicodedata
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import as_bytes, slices, text_of

NEVER = 1 << 60
#: Entries kept per worker; caches only save time, results don't depend on them.
MAX_CACHED = 300_000
IDS = np.dtype("int32")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary:
    printable Latin-1 bytes stand for themselves, the others for the letters
    from U+0100 on, in order."""
    printable = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    hidden = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


def read_vocabulary(path: str) -> dict:
    """The parts of a byte-level BPE ``tokenizer.json``: byte labels by id,
    merges as id triples in order, special tokens. The file bounds the size."""
    with open(path, encoding="utf-8") as f:
        doc = json.load(f)
    letters = byte_letters()
    raw = lambda s: bytes(letters[c] for c in s)
    ids = {raw(k): v for k, v in doc["model"]["vocab"].items()}
    merges = []
    for pair in doc["model"]["merges"]:
        x, y = map(raw, pair.split(" ") if isinstance(pair, str) else pair)
        merges.append((ids[x], ids[y], ids[x + y]))
    special = {t["content"]: t["id"] for t in doc.get("added_tokens", [])}
    return {"ids": ids, "merges": merges, "special": special}


class _Table:
    """Integer keys to values in a flat array, looked up many at a time."""

    def __init__(self, entries: dict[int, int]):
        bits = max(8, (2 * len(entries)).bit_length())
        self.mask, self.shift = (1 << bits) - 1, np.uint64(64 - bits)
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        slots = self._slot(np.fromiter(entries, np.int64, len(entries))).tolist() if entries else []
        for slot, (k, v) in zip(slots, entries.items()):
            while self.keys[slot] != -1:
                slot = (slot + 1) & self.mask
            self.keys[slot], self.values[slot] = k, v

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where there is none."""
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], -1)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        while open_.size:
            slot[open_] = (slot[open_] + 1) & self.mask
            found = self.keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out


class MergeAutomaton:
    """States and arcs are token ids."""

    def __init__(self, ids: dict[bytes, int], merges: list[tuple[int, int, int]], special: dict[str, int]):
        size = max([*ids.values(), *special.values()]) + 1
        self.label = [b""] * size
        for raw, i in ids.items():
            self.label[i] = raw
        for s, i in special.items():
            self.label[i] = s.encode()
        self.left, self.right, self.made = [-1] * size, [-1] * size, [-1] * size
        self.merge_at: dict[int, int] = {}
        self.size = size
        self.rows: dict[int, bool] = {}
        self.arcs = {raw: i for raw, i in ids.items() if len(raw) == 1}
        for k, (x, y, xy) in enumerate(merges):
            self._gadget(k, x, y, xy)
        self._spelling()

    def _gadget(self, k: int, x: int, y: int, xy: int) -> None:
        """Apply merge ``k``: the arc ``xy`` exists only if ``y`` could follow
        ``x`` at this moment; from now on it cannot."""
        possible = self.label[x] in self.arcs and self.label[y] in self.arcs and self._open(x, y, k)
        self.merge_at.setdefault(x * self.size + y, k)
        if possible and self.made[xy] < 0 and self.label[xy] not in self.arcs:
            self.left[xy], self.right[xy], self.made[xy] = x, y, k
            self.arcs[self.label[xy]] = xy

    def _open(self, u: int, v: int, before: int) -> bool:
        """Does state ``u`` have an arc ``v`` when the merges below ``before``
        have been applied? Follows the rows' parent links."""
        while True:
            if self.merge_at.get(u * self.size + v, NEVER) < before:
                return False
            made_u, made_v = self.made[u], self.made[v]
            if made_u < 0 and made_v < 0:
                return True
            if made_v > made_u:  # v's arcs were put where its left half could be read, that merge included
                before, v = made_v + 1, self.left[v]
            elif made_u > made_v:  # u's row was copied from its right half
                before, u = made_u, self.right[u]
            else:
                before, u, v = made_u, self.right[u], self.left[v]

    def follows(self, u: int, v: int) -> bool:
        key = u * self.size + v
        known = self.rows.get(key)
        if known is None:
            if len(self.rows) >= 2 * MAX_CACHED:
                self.rows.clear()
            known = self.rows[key] = self._open(u, v, NEVER)
        return known

    def _spelling(self) -> None:
        """Tables that spell arcs byte by byte: ``step`` maps a node and a byte
        to the next node, ``arc_at`` has the arc that a node spells, or -1."""
        step: dict[int, int] = {}
        arc_at = [-1]
        for raw, v in self.arcs.items():
            node = 0
            for byte in raw:
                key = node << 8 | byte
                node = step.get(key, 0)
                if not node:
                    node = step[key] = len(arc_at)
                    arc_at.append(-1)
            arc_at[node] = v
        self.step, self.arc_at = step, arc_at
        self.label_array = np.empty(self.size, object)
        self.label_array[:] = self.label
        self.step_table, self.merge_table = _Table(step), _Table(self.merge_at)
        self.arc_array, self.left_array, self.right_array, self.made_array = (
            np.array(x, np.int64) for x in (arc_at, self.left, self.right, self.made))

    def encode(self, word: bytes) -> tuple[int, ...]:
        """The one path that spells the word."""
        whole = self.arcs.get(word)
        if whole is not None:
            return (whole,)
        step, arc_at, rows, size, n = self.step, self.arc_at, self.rows, self.size, len(word)
        path: list[int] = []
        open_arcs: list[list] = []
        dead = set()
        at, u, arcs = 0, -1, None
        while at < n:
            if arcs is None:  # all arcs that the bytes from here spell, longest last
                arcs, node, j = [], 0, at
                while j < n:
                    node = step.get(node << 8 | word[j])
                    if node is None:
                        break
                    j += 1
                    if arc_at[node] >= 0:
                        arcs.append((arc_at[node], j))
            while arcs:
                v, j = arcs.pop()
                if j in dead:
                    continue
                if u >= 0:
                    allowed = rows.get(u * size + v)
                    if not (self.follows(u, v) if allowed is None else allowed):
                        continue
                open_arcs.append(arcs)
                path.append(v)
                at, u, arcs = j, v, None
                break
            else:  # no arc leads on: step back and take a shorter one
                if not path:
                    raise ValueError("a byte of the word is not in the vocabulary")
                dead.add(at)
                arcs = open_arcs.pop()
                at -= len(self.label[path.pop()])
                u = path[-1] if path else -1
        return tuple(path)

    def _open_many(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """``_open`` for many pairs, all merges applied."""
        allowed, at = np.ones(len(u), bool), np.arange(len(u))
        before = np.full(len(u), NEVER, np.int64)
        while at.size:
            merge = self.merge_table(u * self.size + v)
            made_u, made_v = self.made_array[u], self.made_array[v]
            blocked = (merge >= 0) & (merge < before)
            allowed[at[blocked]] = False
            on = ~blocked & ((made_u >= 0) | (made_v >= 0))
            at, u, v, made_u, made_v = at[on], u[on], v[on], made_u[on], made_v[on]
            before = np.where(made_v > made_u, made_v + 1, made_u)
            u, v = np.where(made_u >= made_v, self.right_array[u], u), np.where(made_v >= made_u, self.left_array[v], v)
        return allowed

    def encode_many(self, words: list[bytes], at_once: int = 4096, longest: int = 64) -> list[bytes]:
        """``encode`` for many words together, each word's ids as the bytes of
        an ``IDS`` array: every arc that any word's bytes spell, then for each
        prefix length the one arc that the state before it leaves open."""
        out = [b""] * len(words)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        while order and len(words[order[-1]]) > longest:
            i = order.pop()
            out[i] = np.array(self.encode(words[i]), IDS).tobytes()
        for start in range(0, len(order), at_once):
            chosen = order[start:start + at_once]
            for i, tokens in zip(chosen, self._encode_block([words[i] for i in chosen])):
                out[i] = tokens
        return out

    def _encode_block(self, words: list[bytes]) -> list[bytes]:
        sizes = np.array([len(w) for w in words], np.int64)
        width = int(sizes.max())
        if not width:
            return [b""] * len(words)
        text = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width).astype(np.int64)
        row, begin = np.nonzero(np.arange(width) < sizes[:, None])
        node = np.zeros(len(row), np.int64)
        arcs = []
        for length in range(1, width + 1):
            on = begin + length <= sizes[row]
            row, begin, node = row[on], begin[on], node[on]
            node = self.step_table(node << 8 | text[row, begin + length - 1]).astype(np.int64)
            on = node > 0
            row, begin, node = row[on], begin[on], node[on]
            if not row.size:
                break
            arc = self.arc_array[node]
            is_arc = arc >= 0
            arcs.append((row[is_arc], begin[is_arc], arc[is_arc], np.full(int(is_arc.sum()), length, np.int64)))
        row, begin, arc, length = (np.concatenate(x) for x in zip(*arcs))
        end = begin + length
        by_end = np.argsort(end, kind="stable")
        row, begin, arc, end = row[by_end], begin[by_end], arc[by_end], end[by_end]
        last = np.full((len(words), width + 1), -1, np.int64)  # the state each prefix leads to
        came = np.zeros((len(words), width + 1), np.int64)  # where its last arc begins
        bounds = np.searchsorted(end, np.arange(1, width + 2))
        for e in range(1, width + 1):
            part = slice(bounds[e - 1], bounds[e])
            r, b, v = row[part], begin[part], arc[part]
            u = last[r, b]
            ok = b == 0
            later = np.flatnonzero((b > 0) & (u >= 0))
            ok[later] = self._open_many(u[later], v[later])
            last[r[ok], e], came[r[ok], e] = v[ok], b[ok]
        if (last[np.arange(len(words)), sizes][sizes > 0] < 0).any():
            raise ValueError("a byte of a word is not in the vocabulary")
        at, columns, rows = sizes.copy(), [], np.arange(len(words))
        while at.any():
            columns.append(np.where(at > 0, last[rows, at], -1))
            at = came[rows, at]
        forward = np.stack(columns[::-1], axis=1)
        found = forward >= 0
        ids = forward[found].astype(IDS).tobytes()
        ends = (np.cumsum(found.sum(axis=1)) * IDS.itemsize).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def decode(self, tokens: Iterable[int]) -> bytes:
        """Emit the labels of the arcs."""
        return b"".join(map(self.label.__getitem__, tokens))

    def decode_array(self, tokens: np.ndarray) -> bytes:
        """``decode`` of an array of ids."""
        return b"".join(self.label_array[tokens].tolist())


# --- pre-splitting -------------------------------------------------------------

def _classes() -> tuple[str, str, str]:
    """Letters, numbers and white space below U+0530 as character classes."""
    groups = {"L": [], "N": [], "S": []}
    for cp in range(0x530):
        kind = unicodedata.category(chr(cp))[0]
        if chr(cp).isspace() and cp not in range(0x1C, 0x20):
            groups["S"].append(cp)
        elif kind in "LN" and cp != 0x52F + 1:
            groups[kind].append(cp)

    def spans(points):
        out, start = [], points[0]
        for a, b in zip(points, [*points[1:], None]):
            if b != a + 1:
                out.append(f"\\u{start:04x}-\\u{a:04x}")
                start = b
        return "".join(out)
    return tuple(spans(groups[k]) for k in "LNS")


def _fast_pattern() -> re.Pattern:
    """Fixed value: the pattern that splits text before byte-level merges."""
    letter, number, space = _classes()
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
                      f"|[{space}]+(?![^{space}])|[{space}]+")


class WordSplitter:
    """Pre-tokens of a text. Below U+0530 all Unicode versions agree and a
    plain pattern serves; other text goes through the tokenizers library's
    splitter, whose Unicode tables the results must follow."""

    def __init__(self):
        from tokenizers import pre_tokenizers

        self.near = _fast_pattern()
        self.far = re.compile("[԰-\U0010ffff]")
        self.library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)

    def __call__(self, text: str) -> list[str]:
        if not self.far.search(text):
            return self.near.findall(text)
        return [text[a:b] for a, b in (span for _, span in self.library.pre_tokenize_str(text))]


class Codec:
    """Encoder and decoder of one worker."""

    def __init__(self, vocabulary: dict):
        self.automaton = MergeAutomaton(**vocabulary)
        self.special = vocabulary["special"]
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.split_words = WordSplitter()
        self.beside = re.compile(r" \s|\s |\A | \Z")
        self.lone = re.compile(r"(?<=\S) (?=\S)")
        self.special_ids = {x: np.array([i], IDS).tobytes() for x, i in self.special.items()}
        self.known: dict[str, bytes] = {}  # ids by pre-token
        self.pieces: dict[str, bytes] = {}  # by what stands between two lone blanks

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        return [np.frombuffer(ids, IDS).tolist() for ids in self.encode_buffers(texts)]

    def encode_buffers(self, texts: list[str]) -> list[bytes]:
        """Token ids of each whole text, as the bytes of an ``IDS`` array.
        Texts are cut where a pre-token must start: at special tokens and at
        each blank that stands between two other characters. Each new piece is
        encoded once for all texts. Nothing here makes reference cycles, so the
        cycle collector, which would walk the caches again and again, rests
        meanwhile."""
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self._encode_buffers(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode_buffers(self, texts: list[str]) -> list[bytes]:
        plans, new = [], set()
        for text in texts:
            parts = self.split_special.split(text) if self.split_special and any(s in text for s in self.special) else [text]
            plan = []
            for part in parts:
                if part in self.special:
                    plan.append(part)
                elif part:
                    cut = self.lone.split(part) if self.beside.search(part) else part.split(" ")
                    cut[1:] = [" " + x for x in cut[1:]]
                    plan.append(cut)
                    new.update(cut)
            plans.append(plan)
        if len(self.pieces) + len(new) > MAX_CACHED:
            self.pieces = {k: self.pieces[k] for k in new & self.pieces.keys()}
        self._learn([x for x in new if x not in self.pieces])
        ids = self.pieces.__getitem__
        return [b"".join(chain.from_iterable((self.special_ids[part],) if isinstance(part, str) else map(ids, part) for part in plan))
                for plan in plans]

    def _learn(self, pieces: list[str]) -> None:
        split = {x: self.split_words(x) for x in pieces}
        words = {w for parts in split.values() for w in parts}
        if len(self.known) + len(words) > MAX_CACHED:
            self.known = {k: self.known[k] for k in words & self.known.keys()}
        new = [w for w in words if w not in self.known]
        self.known.update(zip(new, self.automaton.encode_many([w.encode() for w in new])))
        for x, parts in split.items():
            self.pieces[x] = self.known[parts[0]] if len(parts) == 1 else b"".join(map(self.known.__getitem__, parts))

    def decode(self, tokens: Iterable[int]) -> str:
        return self.automaton.decode(tokens).decode("utf-8", "replace")

    def decode_buffer(self, ids: bytes) -> str:
        return self.automaton.decode_array(np.frombuffer(ids, IDS)).decode("utf-8", "replace")


def worker_codec(shared) -> Codec:
    """The worker's codec, compiled once and kept beside the broadcast
    vocabulary for the tasks that follow."""
    if "codec" not in shared.value:
        shared.value["codec"] = Codec({k: shared.value[k] for k in ("ids", "merges", "special")})
    return shared.value["codec"]


def _shared_vocabulary(spark, path: str):
    return spark.sparkContext.broadcast(read_vocabulary(path))


def encode_decode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``token_ids`` (array of int) of the whole text and
    ``decoded``, the text that those ids spell. A narrow pass, no shuffle; the
    vocabulary (bounded by its file) is broadcast."""
    shared = _shared_vocabulary(df.sparkSession, path)

    def run(batches):
        codec = worker_codec(shared)
        for part in slices(batches, 1, max_bytes=1 << 20):
            ids = codec.encode_buffers([text_of(raw) for raw in part.column(1).to_pylist()])
            ends = np.cumsum([0, *map(len, ids)]) // IDS.itemsize
            tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), IDS)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), tokens, pa.array([codec.decode_buffer(x) for x in ids], pa.string())],
                names=["row", "token_ids", "decoded"])

    id_type = df.select(F.col(id_col).alias("i")).schema["i"].dataType.simpleString()
    out = (df.select(F.col(id_col).alias("row"), as_bytes(text_col).alias("raw"))
           .mapInArrow(run, f"row {id_type}, token_ids array<int>, decoded string"))
    return out.select(F.col("row").alias(id_col), "token_ids", "decoded")


def decode_tokens(df: DataFrame, path: str, id_col: str = "doc_id", tokens_col: str = "token_ids") -> DataFrame:
    """Per row: the id and ``decoded``; a NULL list decodes to an empty text."""
    shared = _shared_vocabulary(df.sparkSession, path)

    def run(batches):
        automaton = MergeAutomaton(shared.value["ids"], [], shared.value["special"])
        for part in batches:
            decoded = [automaton.decode(t or ()).decode("utf-8", "replace") for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(decoded, pa.string())], names=["row", "decoded"])

    id_type = df.select(F.col(id_col).alias("i")).schema["i"].dataType.simpleString()
    out = (df.select(F.col(id_col).alias("row"), F.col(tokens_col).cast("array<int>").alias("tokens"))
           .mapInArrow(run, f"row {id_type}, decoded string"))
    return out.select(F.col("row").alias(id_col), "decoded")


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Digest columns of ``encode_decode``'s result."""
    return encoded.select(
        id_col, F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
