"""Rows for the tests: invented texts with copies, junk and secrets, and odd cases."""

import random

EXTRA = "id string, score string, keys string, size string, _size string, kept string, marks string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
CLASH = ("x", "s", None, "z", "_z", None, "m")


def word(r):
    return "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9)))


def prose(r, n):
    return " ".join(word(r) + r.choice(["", "", "", "", ".", ","]) for _ in range(n)).capitalize() + "."


def texts(seed=1, count=120):
    r = random.Random(seed)
    out = []
    for k in range(count):
        kind = k % 8
        if kind == 1 and out:
            words = out[-1].split(" ")
            words[r.randrange(len(words))] = word(r)
            out.append(" ".join(words))
        elif kind == 2:
            out.append(out[r.randrange(len(out))])
        elif kind == 3:
            out.append(prose(r, 40) + f' token = "{"".join(r.choice("0123456789abcdef") for _ in range(40))}" ' + prose(r, 30))
        elif kind == 4:
            out.append(" ".join(w.upper() + "!!" for w in prose(r, r.randint(30, 120)).split()))
        elif kind == 5:
            out.append(" ".join([word(r)] * r.randint(30, 200)))
        else:
            out.append("\n".join(prose(r, r.randint(20, 90)) for _ in range(r.randint(1, 4))))
    return out


def odd_rows():
    """Nulls, blank, tied, repeated and very long texts; a missing id."""
    long = prose(random.Random(9), 60_000)
    same = prose(random.Random(8), 50)
    return [
        (1, None, None, None, None, *CLASH),
        (2, "", "en", "a", 0, *CLASH),
        (3, " \n\t ", "en", "a", 4, *CLASH),
        (4, "one", "en", "a", 3, *CLASH),
        (5, long, "en", "a", len(long), *CLASH),
        (6, same, "en", "a", len(same), *CLASH),
        (7, same, "en", None, None, *CLASH),
        (7, same, "en", None, None, *CLASH),
        (None, same, "en", "a", len(same), *CLASH),
        (2**53 + 1, "an id that no double holds", "en", "a", None, *CLASH),
        (8, "ünï çödé 漢字 \U0001f600 &amp; \x00 end", "xx", "b", 25, *CLASH),
    ]


def documents(spark, seed=1, count=120):
    rows = [(100 + k, t, "en", f"src{k % 3}", len(t), *CLASH) for k, t in enumerate(texts(seed, count))]
    return spark.createDataFrame(rows, SCHEMA)


def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
