import math
import random

import public_tokenizers
import pytest

from kerbside.llm import token_counts as tc

SCHEMA = "doc_id long, text string, n_tokens string"


def brute(word, pieces):
    """Best segmentation by trying every cut."""
    unknown = min(pieces.values()) - tc.UNKNOWN_PENALTY

    def best(s):
        if not s:
            return 0.0, 0
        found = []
        for k in range(1, len(s) + 1):
            score, n = best(s[k:])
            if s[:k] in pieces:
                found.append((score + pieces[s[:k]], -(n + 1)))
            if k == 1:
                found.append((score + unknown, -(n + len(s[0].encode()))))
        score, n = max(found)
        return score, -n
    return best(tc.MARK + word)[1]


PIECES = {"▁": -4.0, "a": -3.0, "b": -3.1, "ab": -3.3, "▁a": -3.9, "▁ab": -4.6, "ba": -3.7, "abab": -6.1, "é": -5.0, "bb": -9.0}


def test_counts_match_every_segmentation():
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abé你") for _ in range(rnd.randint(1, 9))) for _ in range(150)]
    counter = tc.Counter(PIECES)
    texts = [" ".join(words[i:i + 5]).encode() for i in range(0, 150, 5)]
    got = counter.count(texts)
    assert got == [(5, sum(brute(w, PIECES) for w in words[i:i + 5])) for i in range(0, 150, 5)]
    assert tc.Counter(PIECES).count(texts[::-1]) == got[::-1]


def test_counts_match_the_library():
    from tokenizers import Tokenizer, models

    pieces = tc.zipf_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    model = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces.items()], unk_id=0, byte_fallback=False))
    counter = tc.Counter(pieces)
    rnd = random.Random(1)
    for _ in range(300):
        word = "".join(rnd.choice(["th", "er", "ing", "on", "a", "e", "über", "ción", "x"]) for _ in range(rnd.randint(1, 6)))
        tokens = model.encode(tc.MARK + word).tokens
        best = sum(pieces[t] for t in tokens)
        n = counter.count([word.encode()])[0][1]
        # equal unless the library broke a tie of scores another way
        assert n == len(tokens) or math.isclose(best, sum(pieces[t] for t in tokens))


def test_probabilities_sum_to_one():
    pieces = tc.zipf_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    assert sum(map(math.exp, pieces.values())) == pytest.approx(1.0)


def test_query_rows(spark, monkeypatch):
    texts = [None, "", " \n", "ab  a\tb", "abab", "abab", "a" * 3000]
    df = spark.createDataFrame([(i if i else None, t, "x") for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: (r.n_pretokens, r.n_tokens) for r in tc.count_tokens(df, PIECES).collect()}
    alone = [tc.Counter(PIECES).count([(t or "").encode()])[0] for t in texts]
    assert got == {(i if i else None): alone[i] for i in range(len(texts))}
    assert tc.count_tokens(spark.createDataFrame([], SCHEMA), PIECES).count() == 0


def test_small_cache_does_not_change_results(monkeypatch):
    texts = [f"ab{'a' * i} ba b{'b' * (i % 3)}".encode() for i in range(40)]
    want = tc.Counter(PIECES).count(texts)
    monkeypatch.setattr(tc, "MAX_CACHED", 3)
    small = tc.Counter(PIECES)
    assert [small.count([t])[0] for t in texts] == want
