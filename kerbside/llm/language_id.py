"""Language identification with hyperdimensional profiles (operator 8).

Each letter has a random vector of ``dim`` signs. An n-gram's vector binds its
letters' vectors, each permuted (rotated) by its place, by multiplication; a
text's vector bundles its n-grams' vectors by addition. A language's prototype
is the bundle of all learning texts in it; a text gets the language whose
prototype has the greatest cosine with the text's vector.

Letters are lower-cased; anything else is one word mark. Code points below 512
have a vector each, the others share 512 by remainder, so the letter table is
bounded. Learning reads the texts and languages of the rows that are not held
out, all of them; it returns one vector per language and task, and prototypes
(languages x ``dim`` numbers) are broadcast.

Cases: a NULL text, or one without a letter, is ``und`` with score 0, as is
any text if there is nothing to learn from; a NULL language is not learned; a
NULL id is not held out; equal cosines go to the first language by name;
repeated rows each give a row; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import as_bytes, slices, text_of

SLOTS = 1024
GRAM = 3
#: N-gram vectors kept per worker; they only save time.
MAX_CACHED = 12_000
#: Characters that are turned into n-grams at a time.
BLOCK = 1 << 20


class Space:
    """Letter vectors and n-gram bundles of one worker."""

    def __init__(self, dim: int, seed: int):
        self.dim = dim
        self.letters = np.random.default_rng(seed).choice(np.array([-1, 1], np.int8), (SLOTS, dim))
        self.slot = np.zeros(0x110000, np.int16)
        for cp in range(0x110000):
            if chr(cp).isalpha():
                self.slot[cp] = cp if cp < SLOTS // 2 else SLOTS // 2 + cp % (SLOTS // 2)
        self.row: dict[int, int] = {}
        self.cache = np.zeros((MAX_CACHED, dim), np.float32)

    def grams(self, raw: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct n-gram codes of a text and their counts; none without a
        letter."""
        text = text_of(raw).lower()
        codes, counts = [], []
        last = np.zeros(1, np.int64)  # a text begins and ends at a word mark
        for i in range(0, max(len(text), 1), BLOCK):
            slots = self.slot[np.frombuffer(text[i:i + BLOCK].encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int64)
            x = np.concatenate([last, slots, np.zeros(1 if i + BLOCK >= len(text) else 0, np.int64)])
            x = x[np.concatenate([[True], (x[1:] > 0) | (x[:-1] > 0)])]
            if len(x) >= GRAM:
                code = (x[:-2] * SLOTS + x[1:-1]) * SLOTS + x[2:]
                some = np.unique(code.astype(np.int32), return_counts=True)
                codes.append(some[0])
                counts.append(some[1])
            last = x[-2:]
        if len(codes) > 1:
            code, where = np.unique(np.concatenate(codes), return_inverse=True)
            return code, np.bincount(where, np.concatenate(counts)).astype(np.int64)
        return (codes[0], counts[0]) if codes else (np.zeros(0, np.int32), np.zeros(0, np.int64))

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        """N-gram vectors: the letters' vectors, rotated by place, multiplied."""
        a, b, c = codes // (SLOTS * SLOTS), codes // SLOTS % SLOTS, codes % SLOTS
        out = np.roll(self.letters[a], 2, axis=1)
        out *= np.roll(self.letters[b], 1, axis=1)
        out *= self.letters[c]
        return out

    def rows(self, codes: np.ndarray) -> np.ndarray:
        """N-gram vectors as floats, through the cache."""
        if len(codes) > MAX_CACHED:
            return self.vectors(codes).astype(np.float32)
        listed = codes.tolist()
        new = [c for c in listed if c not in self.row]
        if len(self.row) + len(new) > MAX_CACHED:
            self.row.clear()
            new = listed
        if new:
            start = len(self.row)
            self.cache[start:start + len(new)] = self.vectors(np.array(new, np.int64))
            self.row.update(zip(new, range(start, start + len(new))))
        return self.cache[[self.row[c] for c in listed]]

    def bundles(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The vector of each text, from its n-gram counts."""
        codes = np.unique(np.concatenate([c for c, _ in texts]))
        out = np.zeros((len(texts), self.dim), np.float32)
        for i in range(0, len(codes), MAX_CACHED):
            part = codes[i:i + MAX_CACHED]
            weight = np.zeros((len(texts), len(part)), np.float32)
            for k, (c, n) in enumerate(texts):
                here = slice(*np.searchsorted(c, [part[0], part[-1] + 1]))
                weight[k, np.searchsorted(part, c[here])] = n[here]
            out += weight @ self.rows(part)
        return out


def _worker_space(shared) -> Space:
    if "space" not in shared.value:
        shared.value["space"] = Space(shared.value["dim"], shared.value["seed"])
    return shared.value["space"]


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _bundled(shared, batches, column: int):
    """Pairs (batch, vectors) of a few texts at a time."""
    space = _worker_space(shared)
    for part in slices(batches, column, max_bytes=1 << 20, max_rows=64):
        yield part, space.bundles([space.grams(raw) for raw in part.column(column).to_pylist()])


def learn(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", dim: int = 1024,
          seed: int = 11) -> dict[str, np.ndarray]:
    """Prototype of each language, from all rows that are not held out."""
    shared = df.sparkSession.sparkContext.broadcast({"dim": dim, "seed": seed})

    def run(batches):
        space, total = _worker_space(shared), {}
        for part in slices(batches, 1):
            for lang, raw in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                code, n = space.grams(raw)
                held = total.setdefault(lang, {"codes": [], "n": [], "size": 0})
                held["codes"].append(code)
                held["n"].append(n)
                held["size"] += len(code)
                if held["size"] > 1 << 20:
                    _merge(held)
        out = []
        for lang, held in total.items():
            _merge(held)
            vector = np.zeros(dim)
            for i in range(0, len(held["codes"][0]), 4096):
                vector += held["n"][0][i:i + 4096].astype(np.float64) @ space.vectors(held["codes"][0][i:i + 4096].astype(np.int64))
            out.append((lang, vector.tolist()))
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.string()), pa.array([v for _, v in out], pa.list_(pa.float64()))],
                                         names=["lang", "vector"])

    texts = df.where(F.col(lang_col).isNotNull() & ~held_out(id_col)).select(
        F.col(lang_col).cast("string").alias("lang"), as_bytes(text_col).alias("raw"))
    # Sums of whole numbers: exact, whatever their order.
    parts = texts.mapInArrow(run, "lang string, vector array<double>").select("lang", F.posexplode("vector").alias("axis", "x"))
    out: dict[str, np.ndarray] = {}
    for row in parts.groupBy("lang", "axis").agg(F.sum("x").alias("x")).collect():
        out.setdefault(row.lang, np.zeros(dim))[row.axis] = row.x
    return {k: out[k] for k in sorted(out) if out[k].any()}


def _merge(held: dict) -> None:
    if len(held["codes"]) > 1:
        code, where = np.unique(np.concatenate(held["codes"]), return_inverse=True)
        held["codes"], held["n"] = [code], [np.bincount(where, np.concatenate(held["n"])).astype(np.int64)]
    held["size"] = 0


def predict(df: DataFrame, prototypes: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text",
            dim: int = 1024, seed: int = 11) -> DataFrame:
    """Per row: id, ``lang_pred`` and ``score``, the greatest cosine (0 if it
    is negative). Reads the text alone."""
    names = list(prototypes)
    axes = np.stack([v / np.linalg.norm(v) for v in prototypes.values()]).astype(np.float32) if names else np.zeros((0, dim), np.float32)
    shared = df.sparkSession.sparkContext.broadcast({"dim": dim, "seed": seed, "axes": axes, "names": names})

    def run(batches):
        axes, names = shared.value["axes"], shared.value["names"]
        for part, vectors in _bundled(shared, batches, 1):
            size = np.linalg.norm(vectors, axis=1)
            if names:
                cosine = vectors @ axes.T / np.where(size > 0, size, 1)[:, None]
                best = cosine.argmax(axis=1)
                score = np.clip(cosine[np.arange(len(best)), best], 0, 1).astype(np.float64)
                lang = [names[b] if s > 0 else "und" for b, s in zip(best, size)]
            else:
                lang, score = ["und"] * len(size), np.zeros(len(size))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang, pa.string()), pa.array(np.where(size > 0, score, 0.0))],
                                             names=["row", "lang_pred", "score"])

    id_type = df.select(F.col(id_col).alias("i")).schema["i"].dataType.simpleString()
    out = (df.select(F.col(id_col).alias("row"), as_bytes(text_col).alias("raw"))
           .mapInArrow(run, f"row {id_type}, lang_pred string, score double"))
    return out.select(F.col("row").alias(id_col), "lang_pred", "score")


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the rows that are not held out, predict all rows."""
    found = predict(df, learn(df, id_col, text_col, lang_col), id_col, text_col)
    return found.select(id_col, held_out(id_col).alias("held_out"), "lang_pred", "score")
