import hashlib
import random
import re

import pytest
from loomcat.llm.fill_middle import FillMiddle, fill_in_middle

from samples import documents, empty, odd


def plain_version(rule, key, text):
    """With a list of all units, by the definition."""
    units = re.findall(rule.unit, text)
    digest = hashlib.sha256(f"{rule.seed}:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
    if text == "" or any(m in text for m in rule.markers) or h3 % 100 >= rule.fim_rate:
        return len(units), "plain", None, None, text
    a, b = sorted([h1 % (len(units) + 1), h2 % (len(units) + 1)])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < rule.spm_rate:
        return len(units), "spm", len(p), len(m), rule.suffix + s + rule.prefix + p + rule.middle + m
    return len(units), "psm", len(p), len(m), rule.prefix + p + rule.suffix + s + rule.middle + m


def test_texts():
    r = random.Random(3)
    bits = ["\n", "\n\n", "a", "line\n", "é", "漢字\n", "<", "P>", "<P", "<S", "\r\n", "\U0001f600", " ", "<<"]
    for rule in (FillMiddle(), FillMiddle(seed=1, fim_rate=60, spm_rate=0), FillMiddle(unit=r"\s*\S+\s*|\s+", prefix="[pre]", suffix="[suf]", middle="[mid]")):
        for k in range(600):
            text = "".join(r.choice(bits) for _ in range(r.randint(0, 30)))
            got = rule.apply(str(k), text)
            assert got == plain_version(rule, str(k), text)
            assert rule.restore(got[1], got[4]) == text


def test_texts_with_markers_stay_plain():
    for marker in ("<P>", "<S>", "<M>"):
        assert FillMiddle().apply("1", f"a\n{marker}\nb")[1:] == ("plain", None, None, f"a\n{marker}\nb")


def test_markers_that_cannot_be_told_apart():
    for marks in (("", "b", "c"), ("<P>", "<P>", "c"), ("aba", "x", "y"), ("ab", "bc", "y"), ("abc", "b", "y")):
        with pytest.raises(ValueError):
            FillMiddle(prefix=marks[0], suffix=marks[1], middle=marks[2])


def test_a_long_text_of_many_units():
    text = "x\n" * 1_000_000
    n, form, a, b, output = FillMiddle().apply("5", text)
    assert (n, len(output)) == (1_000_000, len(text) + 9) and FillMiddle().restore(form, output) == text and a % 2 == b % 2 == 0


def test_rows(spark):
    docs = documents(spark, count=60).unionByName(odd(spark))
    wanted = []
    for i, text in docs.select("doc_id", "text").collect():
        n, form, a, b, output = plain_version(FillMiddle(), "" if i is None else str(i), text or "")
        wanted.append((i, n, form, a, b, hashlib.sha256(output.encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest(), output))
    got = fill_in_middle(docs, with_output=True)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, wanted))
    assert {r.form for r in got.collect()} == {"plain", "psm", "spm"}
    assert fill_in_middle(empty(spark)).count() == 0
