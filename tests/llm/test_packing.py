import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from loomcat.llm import packing
from tokenizers import Tokenizer

from samples import documents, empty, odd


def check(docs, capacity):
    bpe = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = []
    for r in docs.collect():
        ids = [*bpe.encode(r.text or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            wanted.append((r.doc_id, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = packing.pack_documents(docs, capacity=capacity).collect()
    assert sorted(map(str, (tuple(r)[:5] for r in got))) == sorted(map(str, wanted))
    rows = defaultdict(list)
    for r in got:
        rows[r.sequence_id].append((r.offset, r.length))
    for places in rows.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(rows), sum(r.length for r in got)


def test_pieces_and_places(spark):
    used, total = check(documents(spark, count=200).unionByName(odd(spark)), 2048)
    assert used <= total / 2048 * 1.05 + 1


def test_small_capacity(spark):
    check(documents(spark, seed=11, count=60), 97)


def best_fit_decreasing(lengths, capacity=2048):
    from bisect import bisect_left, insort

    gaps, used = [], 0
    for n in sorted(lengths.tolist(), reverse=True):
        k = bisect_left(gaps, n)
        gap = gaps.pop(k) if k < len(gaps) else capacity
        used += gap == capacity
        insort(gaps, gap - n)
    return used


def test_plan_is_no_worse_than_best_fit():
    r = np.random.default_rng(4)
    lengths = np.concatenate([r.integers(1, 2049, 4000), r.integers(600, 800, 3000)])
    values, counts = np.unique(lengths, return_counts=True)
    runs, used = packing.plan(dict(zip(values.tolist(), counts.tolist(), strict=True)))
    assert used <= 1.01 * best_fit_decreasing(lengths)
    order = np.sort(lengths)[::-1]
    rank = np.arange(len(order))
    run = runs[np.searchsorted(runs[:, 0], rank, "right") - 1]
    places = defaultdict(list)
    for s, o, n in zip(run[:, 1] + rank - run[:, 0], run[:, 2], order, strict=True):
        places[s].append((int(o), int(n)))
    for p in places.values():
        p.sort()
        assert [o for o, _ in p] == np.cumsum([0, *[n for _, n in p[:-1]]]).tolist() and p[-1][0] + p[-1][1] <= 2048


def test_empty(spark):
    assert packing.pack_documents(empty(spark)).count() == 0
