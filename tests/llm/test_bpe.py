import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kerbside.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, token_ids int, decoded string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_vocabulary(PATH))


def strings():
    rnd = random.Random(1)
    parts = ["a", "b", "A", "aa", "th", "the", " ", "  ", "\n", "\t", "1", "²", "é", "ß", "你", "😀", "\u200b", "'s", "'", "''",
             "<|endoftext|>", "<|end", "\xa0", "\x1c", "\u0301", ".", ",", "...", "!!", "ing", "tion", "\x00", "\u3000", "\x85"]
    made = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))) for _ in range(3000)]
    wild = ["".join(chr(rnd.choice([rnd.randrange(32, 127), rnd.randrange(0xE000, 0x110000), rnd.randrange(0xD800)])) for _ in range(12)) for _ in range(500)]
    return made + wild + ["", "a" * 5000, "ab" * 2000, "<|endoftext|><|endoftext|>", "".join(rnd.choice("ab") for _ in range(2000))]


def test_ids_and_text_match_the_library(codec, library):
    texts = strings()
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert codec.encode_all(texts) == want
    assert [codec.decode(ids) for ids in want] == [library.decode(ids, skip_special_tokens=False) for ids in want]


def test_one_word_and_many_words_agree(codec):
    rnd = random.Random(2)
    words = [bytes(rnd.choice(b"thenigro aeiou\xc3\xa9") for _ in range(rnd.randint(1, 30))) for _ in range(2000)]
    together = codec.automaton.encode_many(words, at_once=100, longest=20)
    assert [tuple(np.frombuffer(x, bpe.IDS).tolist()) for x in together] == [codec.automaton.encode(w) for w in words]


def test_splitter_covers_every_near_code_point(codec):
    split = codec.split_words
    for cp in range(0x530):
        for text in (f"a{chr(cp)}1{chr(cp)}. {chr(cp)}", f"a {chr(cp)}{chr(cp)} b"):
            assert split.near.findall(text) == [text[a:b] for _, (a, b) in split.library.pre_tokenize_str(text)]


def test_small_caches_do_not_change_results(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_CACHED", 7)
    small = bpe.Codec(bpe.read_vocabulary(PATH))
    texts = ["the cat sat on the mat. " * 3, "one two  three\nfour five six seven eight", "nine ten"]
    assert [small.encode(t) for t in texts] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_automaton_forbids_what_merges_join():
    letters = {b"a": 0, b"b": 1, b"ab": 2, b"aa": 3, b"aab": 4}
    auto = bpe.MergeAutomaton(letters, [(0, 1, 2), (0, 0, 3), (0, 2, 4)], {})
    assert not auto.follows(0, 1) and not auto.follows(0, 0) and not auto.follows(0, 3) and auto.follows(3, 0)
    assert auto.encode(b"aaaab") == (3, 4) and auto.encode(b"aaa") == (3, 0) and auto.encode(b"aaaa") == (3, 3)


def test_round_trip_query(spark, library):
    texts = [None, "", "Hello world's  end\n", "<|endoftext|>x", "é" * 3, "Hello world's  end\n"]
    df = spark.createDataFrame([(i if i else None, t, 0, "x") for i, t in enumerate(texts)], SCHEMA)
    encoded = bpe.encode_decode(df, PATH)
    got = sorted((tuple(r) for r in bpe.digests(encoded).collect()), key=str)
    want = []
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((i if i else None, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert got == sorted(want, key=str)
    decoded = {r.doc_id: r.decoded for r in bpe.decode_tokens(encoded, PATH).collect()}
    assert decoded == {(i if i else None): t or "" for i, t in enumerate(texts)}
    assert bpe.encode_decode(spark.createDataFrame([], SCHEMA), PATH).count() == 0
