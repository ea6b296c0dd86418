import hashlib
import random

import public_tokenizers
from loomcat.llm import chunk_bpe
from tokenizers import Tokenizer

from samples import documents, empty, odd

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library():
    out = Tokenizer.from_file(PATH)
    out.no_truncation()
    out.no_padding()
    return out


def test_ids_equal_the_library():
    bpe, own = library(), chunk_bpe.ChunkEncoder(PATH, mask=0x7)
    pieces = ["word", " ", "  ", "\n", "\t", "'s", "'re", "don't", "123", "é", "漢字", "\U0001f600", "<|endoftext|>", " ", "...", " a", "b ", "Zürich", "\r\n", "​", "x" * 50]
    r = random.Random(1)
    for _ in range(1500):
        text = "".join(r.choice(pieces) for _ in range(r.randint(0, 40)))
        ids = bpe.encode(text, add_special_tokens=False).ids
        import numpy as np

        assert np.frombuffer(own.encode(text), "<u4").tolist() == ids, repr(text)
        assert own.decode(ids) == bpe.decode(ids, skip_special_tokens=False)


def test_broken_special_tokens_and_runs():
    """Added tokens, contractions and runs of one kind that any cut can split."""
    import numpy as np

    bpe, r = library(), random.Random(2)
    pieces = ["<|endoftext|>", "<|endoftext|", "<|endo", "ftext|>", "<", "|", "'", "l", "ll", "  ", "   \n", "\t\t", "x" * 300, "漢字かな" * 20, "1" * 40, "é", "e\u0301", "\xa0", "\x1c", "\x85", "def f(x):\n        return x\n"]
    for mask in (0x3, 0xF, 0xFF):
        own = chunk_bpe.ChunkEncoder(PATH, mask=mask, limit=64)
        for _ in range(400):
            text = "".join(r.choice(pieces) for _ in range(r.randint(0, 60)))
            assert np.frombuffer(own.encode(text), "<u4").tolist() == bpe.encode(text, add_special_tokens=False).ids, repr(text)


def test_shared_passages_are_encoded_once():
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8)))
    kinds = {
        "prose": " ".join(word() for _ in range(4000)),
        "double spaces": "  ".join(word() for _ in range(4000)),
        "code": "\n".join(f"\tif {word()}({word()}):\n\t\t{word()} += '{word()}'" for _ in range(800)),
        "no spaces": "".join(chr(r.randint(0x4E00, 0x9000)) + r.choice(["", "", "。"]) for _ in range(8000)),
    }
    for kind, shared in kinds.items():
        own = chunk_bpe.ChunkEncoder(PATH)
        own.encode(word() + " " + shared)
        first = own.encoded
        assert first >= len(shared), kind
        own.encode("Other beginnings of any length. " + shared + " and ends")
        assert own.encoded - first < 0.1 * len(shared), kind
        assert own.joined < 0.5 * own.seen, kind


def test_one_long_run_takes_linear_time():
    own = chunk_bpe.ChunkEncoder(PATH)
    own.encode("x" * 400_000)
    assert own.joined < 6 * 400_000


def test_rows(spark):
    bpe = library()
    docs = documents(spark, seed=2, count=60).unionByName(odd(spark))
    wanted = []
    for i, text in docs.select("doc_id", "text").collect():
        ids = bpe.encode(text or "", add_special_tokens=False).ids
        decoded = bpe.decode(ids, skip_special_tokens=False)
        wanted.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(str, map(tuple, chunk_bpe.encode_decode(docs).collect()))) == sorted(map(str, wanted))
    assert chunk_bpe.encode_decode(empty(spark)).count() == 0
