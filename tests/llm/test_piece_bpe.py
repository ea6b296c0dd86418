import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from loomcat.llm import piece_bpe

from samples import documents, empty, odd

PATH = public_tokenizers.path("piece_bpe_32k.model")
BITS = ["word", " ", "  ", "\n", "\t", "a", "aa", "the", "ing", "é", "漢字", "\U0001f600", "<0x41>", "<s>", "</s>", "<unk>", "▁", "x" * 40, "ab" * 30, " " * 37, " " * 15, "1234", "​", "\x00", "Zürich", "…", "--", "=====", "tion", "ssss", "def f(x):\n        return", "é", "\xa0"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def own():
    return piece_bpe.PieceEncoder(PATH)


def test_ids_equal_the_library(library):
    r = random.Random(1)
    texts = ["".join(r.choice(BITS) for _ in range(r.randint(0, 50))) for _ in range(1500)]
    texts += ["".join(r.choice("abcdest ") for _ in range(r.randint(0, 400))) for _ in range(500)]
    for limit, batch in ((300_000, 400_000), (50, 100)):
        own = piece_bpe.PieceEncoder(PATH, limit=limit, batch=batch)
        for k in range(0, len(texts), 500):
            for text, ids in zip(texts[k : k + 500], own.encode_batch(texts[k : k + 500]), strict=True):
                assert ids.tolist() == library.encode(text), repr(text)
                assert own.decode(ids.tolist()) == library.decode(ids.tolist()) == text.replace("▁", " ")


def test_words_without_borders(library, own):
    """Words longer than the rounds look at whole, of letters that merge in many ways."""
    r = random.Random(2)
    texts = ["".join(r.choice(letters) for _ in range(r.randint(40, 2500))) for letters in ("aeinst", "ea", "tion", "s", "=-", "的一是不了") for _ in range(25)]
    assert [x.tolist() for x in own.encode_batch(texts)] == library.encode(texts)


def test_pairs_that_rank_before_what_made_them():
    """A vocabulary in which ``ab`` gives way to ``aba`` once it is made: one merge at a time."""
    v = object.__new__(piece_bpe.Vocabulary)
    pieces = ["a", "b", "aba", "ab"]
    v.size, v.reach = 4, 3
    v.id_of_rank = np.array([2, 3])
    v.keys, v.ranks = np.array([1, 3 * 4 + 0]), np.array([1, 0], np.int32)
    v.risky = np.array([False, True])
    for text, parts in (("abab", ["aba", "b"]), ("ababab", ["aba", "b", "ab"]), ("aab", ["a", "ab"]), ("ab" * 40, None)):
        symbols, word = piece_bpe.merge_rounds(v, np.array([pieces.index(c) for c in text]), np.zeros(len(text), np.int64))
        got = [pieces[i] for i in symbols]
        assert "".join(got) == text and set(word.tolist()) == {0}
        held = list(text)
        while True:  # by the definition: the best pair, the leftmost of equal ones
            best = min(((["aba", "ab"].index(x + y), k) for k, (x, y) in enumerate(zip(held, held[1:], strict=False)) if x + y in ("aba", "ab")), default=None)
            if best is None:
                break
            held[best[1] : best[1] + 2] = [held[best[1]] + held[best[1] + 1]]
        assert got == held == (parts or held)


def test_any_ids_are_decoded_as_by_the_library(library, own):
    r = random.Random(4)
    for _ in range(2000):
        ids = [r.choice([0, 1, 2, 259, 28705, 300, 5000, r.randint(3, 258), r.randint(0, 31999)]) for _ in range(r.randint(0, 12))]
        assert own.decode(ids) == library.decode(ids), ids


def test_long_words_take_about_linear_time(library, own):
    r = random.Random(3)
    for text in ("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(300_000)), "a" * 300_000, " " * 300_000):
        begin = time.time()
        ids = own.encode_batch([text])[0]
        assert time.time() - begin < 10
        assert ids.tolist() == library.encode(text)


def test_rows(spark, library):
    docs = documents(spark, seed=2, count=60).unionByName(odd(spark))
    wanted = []
    for i, text in docs.select("doc_id", "text").collect():
        ids = library.encode(text or "")
        wanted.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(map(str, map(tuple, piece_bpe.encode_decode(docs).collect()))) == sorted(map(str, wanted))
    assert piece_bpe.encode_decode(empty(spark)).count() == 0
