import random

import numpy as np

from kerbside.llm import decontaminate as dc

DOCS = "doc_id long, text string, lang string, score double"
ITEMS = "item_id long, text string"


def brute_sw(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    best = 0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (1 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def corpus():
    rnd = random.Random(8)
    vocab = [f"w{i}" for i in range(400)]
    common = ["the", "of", "and", "to"]
    pick = lambda n: [rnd.choice(common if rnd.random() < 0.4 else vocab) for _ in range(n)]
    items = [pick(rnd.randint(14, 40)) for _ in range(15)]
    docs, leaked = [], set()
    for d in range(60):
        words = pick(rnd.randint(20, 200))
        if d % 3 == 0:
            item = rnd.randrange(len(items))
            copy = list(items[item])
            if d % 2:  # an edited copy: a word in ten replaced, one left out
                for k in range(4, len(copy), 10):
                    copy[k] = "edited"
                del copy[len(copy) // 2]
            at = rnd.randrange(len(words))
            words[at:at] = copy
        docs.append((d, words))
    return docs, items


def test_alignment_matches_brute_force():
    rnd = random.Random(1)
    for _ in range(60):
        a, b = ([rnd.randrange(5) for _ in range(rnd.randint(1, 25))] for _ in range(2))
        score, i, j = dc.smith_waterman(np.array(a), np.array(b))
        assert score == brute_sw(a, b)
        if score:
            assert brute_sw(a[:i], b[:j]) == score


def test_pairs_match_alignment_of_all_pairs(spark):
    docs, items = corpus()
    docs_df = spark.createDataFrame([(i, " ".join(w).title() + ".", "en", 0.5) for i, w in docs], DOCS)
    items_df = spark.createDataFrame([(i, ", ".join(w)) for i, w in enumerate(items)], ITEMS)
    want = {(d, i): brute_sw(x, w) / len(x) for d, w in docs for i, x in enumerate(items) if brute_sw(x, w) >= 0.5 * len(x)}
    for size in (2 << 20, 300):  # one block, many blocks
        got = {(r.doc_id, r.item_id): r.score for r in dc.contaminated_pairs(docs_df, items_df, block_bytes=size).collect()}
        assert got == want
    assert {d for d, _ in want} == {d for d, _ in docs if d % 3 == 0}


def test_spans_point_at_the_copy(spark):
    docs_df = spark.createDataFrame([(1, "x y z one two three four five six q r", "en", 0.1)], DOCS)
    items_df = spark.createDataFrame([(7, "One two three, four five six!"), (8, "one two three four five six")], ITEMS)
    rows = sorted(tuple(r) for r in dc.contaminated_pairs(docs_df, items_df).collect())
    assert rows == [(1, 7, 1.0, 3, 9), (1, 8, 1.0, 3, 9)]


def test_common_passages_are_still_found(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    docs = [(i, f"start{i} {passage} end{i}", "en", 0.0) for i in range(80)] + [(100, "other text " * 30, "en", 0.0)]
    items_df = spark.createDataFrame([(1, passage)], ITEMS)
    got = dc.contaminated_pairs(spark.createDataFrame(docs, DOCS), items_df).collect()
    assert {r.doc_id for r in got} == set(range(80))


def test_edges(spark):
    docs = [(1, None, None, None), (2, "", "en", 0.0), (None, "a b c d e f g h", "en", 0.0), (3, "a b c d e f g h", "en", 0.0),
            (3, "a b c d e f g h", "en", 0.0), (4, "quite different words here", "en", 0.0)]
    docs_df = spark.createDataFrame(docs, DOCS)
    items_df = spark.createDataFrame([(1, "A b c d e f g h"), (2, None), (3, ""), (None, "a b"), (None, "b c d e f g")], ITEMS)
    got = sorted(((r.doc_id, r.item_id) for r in dc.contaminated_pairs(docs_df, items_df).collect()), key=str)
    assert got == sorted([(d, i) for d in (None, 3, 3) for i in (1, None)], key=str)
    kept = dc.drop_contaminated(docs_df, items_df)
    assert kept.columns == docs_df.columns and {r.doc_id for r in kept.collect()} == {1, 2, 4}
    none, empty = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert dc.contaminated_pairs(none, items_df).count() == 0
    assert dc.contaminated_pairs(docs_df, empty).count() == 0
    assert dc.drop_contaminated(docs_df, empty).count() == len(docs)


def test_copies_edited_after_every_third_word(spark):
    """All copies whose unedited stretches are three words long, also beside
    whole and other copies, which make each n-gram of the item occur."""
    long, short = [f"a{i}" for i in range(48)], [f"b{i}" for i in range(7)]
    docs = [[w for i, x in enumerate(long) for w in ([x, f"new{i}"] if i % 3 == 2 else [x])], [*short[:3], "other", *short[4:]]]
    for shift in range(4):
        docs.append([f"new{i}" if i % 4 == shift else w for i, w in enumerate(long)])
    for whole in ([], [long, short], [long, long[1:], short, short]):
        texts = [["x", "y", *w, "z"] for w in docs + whole]
        docs_df = spark.createDataFrame([(i, " ".join(w), "en", 0.5) for i, w in enumerate(texts)], DOCS)
        items_df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate((long, short))], ITEMS)
        want = {(d, i): brute_sw(x, w) / len(x) for d, w in enumerate(texts) for i, x in enumerate((long, short))
                if brute_sw(x, w) >= 0.5 * len(x)}
        got = {(r.doc_id, r.item_id): r.score for r in dc.contaminated_pairs(docs_df, items_df).collect()}
        assert got == want and {d for d, _ in got} == set(range(len(texts)))
        assert dc.drop_contaminated(docs_df, items_df).count() == 0


def test_common_phrase_in_many_items(spark):
    """A phrase that all items and documents share brings up all pairs; those
    that reach the score are exactly the ones that alignment of all pairs finds."""
    rnd = random.Random(3)
    phrase = ["which", "of", "the", "following"]
    items = [phrase + [f"v{rnd.randrange(90)}" for _ in range(rnd.randint(1, 9))] for _ in range(60)]
    docs = [[f"v{rnd.randrange(90)}" for _ in range(20)] + phrase + rnd.choice(items)[2:] + phrase for _ in range(30)]
    docs_df = spark.createDataFrame([(i, " ".join(w), "en", 0.5) for i, w in enumerate(docs)], DOCS)
    items_df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], ITEMS)
    want = {(d, i): brute_sw(x, w) / len(x) for d, w in enumerate(docs) for i, x in enumerate(items) if brute_sw(x, w) >= 0.5 * len(x)}
    got = {(r.doc_id, r.item_id): r.score for r in dc.contaminated_pairs(docs_df, items_df).collect()}
    assert got == want and len(want) > 60


def test_words_of_all_scripts(spark):
    han, thai = "敏捷的棕色狐狸跳过了懒狗", "สวัสดีชาวโลก"
    items = [(1, han), (2, thai), (3, "it’s one “quoted” passage — with dashes"), (4, "naïve café owners weigh soft sugar"), (5, "東京"), (6, "Kilimanjaro")]
    docs = [(1, "前言" + han + "。后记", "zh", 0.0), (2, "ก " + thai + "ๆ", "th", 0.0), (3, "x it s one 'quoted' passage with dashes é", "en", 0.0),
            (4, "x\u00a0naïve\u3000café\u2003owners\u00a0weigh\u00a0soft\u00a0su\u00adgar\u2028y", "fr", 0.0), (5, "私は東京に住む", "ja", 0.0),
            (6, "京東 kilimanjaros", "ja", 0.0), (7, "up Kilimanjaro!", "en", 0.0), (8, han[:4] + "别的" + han[6:], "zh", 0.0)]
    docs_df, items_df = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    got = {(r.doc_id, r.item_id): r.score for r in dc.contaminated_pairs(docs_df, items_df, short_items=True).collect()}
    assert got == {(1, 1): 1.0, (2, 2): 1.0, (3, 3): 1.0, (4, 4): 1.0, (5, 5): 1.0, (7, 6): 1.0, (8, 1): 8 / 12}
    assert {r.doc_id for r in dc.drop_contaminated(docs_df, items_df, short_items=True).collect()} == {6}
    assert {r.item_id for r in dc.contaminated_pairs(docs_df, items_df).collect()} == {1, 2, 3, 4}
    for text in ("a.b\tc\x0bd\x00e_f", "A $5 [x]"):  # one rule with and without other characters
        assert dc.words_of((text + " é").encode()) == [*dc.words_of(text.encode()), "é".encode()]
