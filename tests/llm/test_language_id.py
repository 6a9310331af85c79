import random
import zlib

import numpy as np
import pytest

from kerbside.llm import language_id as li

SCHEMA = "doc_id long, text string, lang string, score string"
SOUNDS = {"aa": ["ba", "la", "ma"], "bb": ["kri", "tro", "sku"], "cc": ["你", "好", "学"], "dd": ["ñu", "é", "lle"]}


def rows(n=240):
    rnd = random.Random(7)
    out = []
    for i in range(n):
        lang = rnd.choice(list(SOUNDS))
        words = ["".join(rnd.choice(SOUNDS[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(3, 60))]
        out.append((i, " ".join(words).capitalize() + ".", lang, "x"))
    return out


def brute_vector(text, space):
    letters = [0] + [int(space.slot[ord(c)]) for c in text.lower()] + [0]
    x = [s for i, s in enumerate(letters) if i == 0 or s or letters[i - 1]]
    total = np.zeros(space.dim)
    for a, b, c in zip(x, x[1:], x[2:]):
        total += np.roll(space.letters[a], 2).astype(int) * np.roll(space.letters[b], 1) * space.letters[c]
    return total


def test_bundles_match_brute_force(monkeypatch):
    space = li.Space(256, 3)
    texts = ["", "a", "Ab, cd!", "  x  y ", "123 --", "你好 ÜBER", "long words " * 50]
    got = space.bundles([space.grams(t.encode()) for t in texts])
    assert all((g == brute_vector(t, space)).all() for g, t in zip(got, texts))
    monkeypatch.setattr(li, "BLOCK", 7)
    assert (space.bundles([space.grams(t.encode()) for t in texts]) == got).all()


def test_prototypes_and_cosines(spark):
    data = rows(40)
    learned = li.learn(spark.createDataFrame(data, SCHEMA).repartition(3), dim=256)
    space = li.Space(256, 11)
    want = {}
    for i, text, lang, _ in data:
        if zlib.crc32(str(i).encode()) % 4 != 2:
            want[lang] = want.get(lang, 0) + brute_vector(text, space)
    assert list(learned) == sorted(want) and all((learned[k] == want[k]).all() for k in want)
    got = {r.doc_id: r for r in li.predict(spark.createDataFrame(data, SCHEMA), learned, dim=256).collect()}
    for i, text, *_ in data:
        v = brute_vector(text, space)
        cosine = {k: v @ p / np.linalg.norm(v) / np.linalg.norm(p) for k, p in want.items()}
        assert got[i].lang_pred == max(cosine, key=cosine.get)
        assert got[i].score == pytest.approx(max(cosine.values()), abs=1e-5)


def test_held_out_accuracy(spark):
    data = rows()
    got = {r.doc_id: r for r in li.identify(spark.createDataFrame(data, SCHEMA)).collect()}
    truth = {i: lang for i, _, lang, _ in data}
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
    out = [r for r in got.values() if r.held_out]
    assert len(out) > 30 and sum(r.lang_pred == truth[r.doc_id] for r in out) > 0.97 * len(out)


def test_edges(spark):
    data = [(1, None, "en", "x"), (2, "", "en", "x"), (3, "12 !?", "en", "x"), (None, "hello there", None, "x"), (4, "hello there", "en", "x"),
            (4, "hello there", "en", "x"), (5, "x" * 100000, None, "x")]
    got = li.identify(spark.createDataFrame(data, SCHEMA)).collect()
    assert len(got) == len(data)
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in got if r.doc_id in (1, 2, 3))
    assert {r.lang_pred for r in got if r.doc_id in (4, None)} == {"en"} and all(0 <= r.score <= 1 for r in got)
    assert li.identify(spark.createDataFrame([], SCHEMA)).count() == 0
    none = [(i, "some words", None, "x") for i in range(3)]
    assert {r.lang_pred for r in li.identify(spark.createDataFrame(none, SCHEMA)).collect()} == {"und"}
