"""Secret scans: fixed patterns and a linear-chain conditional random field.

1. Three base patterns (assigned values, access keys, hexadecimal runs).
2. A conditional random field tags every token as begin, inside or outside of a secret.
   Its features are the token's shape, the shapes of two tokens before and one after,
   and those of the whole text (``file features``). It is trained on the driver with
   synthetic lines from a fixed seed (``examples``), by gradient on the likelihood, and
   decoded by Viterbi.

Decoding is exact but mostly skipped: where a token's score for outside exceeds the
others by more than the transitions can give back, every best path goes through outside
there; Viterbi runs over the stretches between such tokens only.

Spans of the field that a base span covers aren't added. Work is one narrow pass over
the rows; a token memo of bounded size serves each worker.

Defined results: a null text counts as empty; an empty text has no spans; rows are
independent, so repeated rows give repeated results and an empty table an empty one;
very long texts are scanned whole; columns other than the id and the text are ignored,
whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, ship, table, text_or_empty
from .tokens import _Memo

KINDS = ("assign", "access", "hex", "field")

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

Span = tuple[int, int, int]  # start, kind, end


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start and kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


TOKEN = re.compile(r"[\w+/.-]+=*|[^\w\s+/.-]+")
KEYWORDS = frozenset("password passwd passphrase pwd pass secret token apikey api key auth bearer access private credential credentials".split())
STRONG = frozenset("password passwd passphrase pwd secret token apikey bearer credential credentials".split())
PREFIXES = ("AKIA", "ghp_", "gho_", "sk_live_", "sk-", "xoxb-", "xoxp-", "AIza", "eyJ", "glpat-")
SHAPE = 26
FILE = 5


def shape(token: str) -> int:
    """The features of a token as bits."""
    if len(token) < 16 and token.isalpha() and (low := token.lower()) not in KEYWORDS:  # most tokens
        n = len(token)
        return 1 << (6 + (n >= 6) + (n >= 12)) | 1 << (11 if token == low else 12 if token[1:] == low[1:] else 13 if token.isupper() else 14)
    core = token.rstrip("=").strip(".-/+")
    if not core or not (core[0].isalnum() or core[0] == "_"):
        return (1 if any(c in "\"'`" for c in token) else 0) | (2 if any(c in "=:" for c in token) else 0) | 4
    bits = 1 << 3 if token[-1] == "=" else 0
    n = len(core)
    low = core.lower()
    parts = low.replace("-", "_").replace(".", "_").replace("/", "_").split("_")
    if not KEYWORDS.isdisjoint(parts):
        bits |= (1 << 5) | (0 if STRONG.isdisjoint(parts) else 1 << 4)
    length = 6 + (n >= 6) + (n >= 12) + (n >= 20) + (n >= 32)
    bits |= 1 << length
    if core.isalpha():
        bits |= 1 << (11 if core.islower() else 12 if core[1:].islower() else 13 if core.isupper() else 14)
        if n < 16:
            return bits
    digits = sum(c.isdigit() for c in core)
    letters = sum(c.isalpha() for c in core)
    bits |= (1 << 15 if digits else 0) | (1 << 16 if digits and not letters else 0) | (1 << 17 if digits and letters else 0)
    bits |= 1 << 18 if n >= 16 and all(c in "0123456789abcdef" for c in core) and digits and letters else 0
    bits |= 1 << 19 if core.startswith(PREFIXES) and n >= 12 else 0
    turns = sum(a.islower() != b.islower() for a, b in zip(core, core[1:], strict=False))
    bits |= 1 << 20 if n >= 8 and turns * 3 >= n else 0
    bits |= 1 << 21 if n >= 16 and len(set(core)) >= min(12, 0.5 * n) else 0
    bits |= (1 << 22 if "." in core else 0) | (1 << 23 if "/" in core or "+" in core else 0) | (1 << 24 if "_" in core or "-" in core else 0)
    kinds = len({"d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "s" for c in core})
    return bits | (1 << 25 if kinds >= 3 and n >= 6 else 0)


def unpacked(codes: np.ndarray) -> np.ndarray:
    return ((codes[:, None] >> np.arange(SHAPE)[None, :]) & 1).astype(np.float32)


def file_bits(codes: np.ndarray) -> np.ndarray:
    """Features of the whole text, from its tokens' shapes."""
    n = max(1, len(codes))
    signs = (codes & 2).astype(bool).sum()
    words = (codes & (3 << 11)).astype(bool).sum()
    return np.array([(codes & (1 << 4)).any(), signs * 20 > n, words * 2 > n, n < 24, n >= 400], np.float32)


# ---- training lines ----

LETTERS = "abcdefghijklmnopqrstuvwxyz"
MIXED = LETTERS + LETTERS.upper() + "0123456789"


class _Lines:
    """Synthetic lines with their secrets, from a seed."""

    def __init__(self, seed: int):
        self.draw = np.random.default_rng(seed)

    def pick(self, options):
        return options[int(self.draw.integers(len(options)))]

    def chars(self, alphabet: str, low: int, high: int) -> str:
        return "".join(self.pick(alphabet) for _ in range(int(self.draw.integers(low, high + 1))))

    def word(self) -> str:
        w = self.chars(LETTERS, 1, 13)
        return self.pick([w, w, w, w, w.title(), w.upper()]) + self.pick(["", "", "", "", ",", ".", "!!", "***", "$$$", " |", "&&&"])

    def prose(self, low: int, high: int) -> list[tuple[str, bool]]:
        return [(self.word(), False) for _ in range(int(self.draw.integers(low, high + 1)))]

    def secret(self) -> tuple[str, bool]:
        """(value, is it known by itself)"""
        kind = int(self.draw.integers(8))
        if kind == 0:
            return self.chars("0123456789abcdef", self.pick([32, 40, 64]), 64)[: self.pick([32, 40, 64])], True
        if kind == 1:
            return "AKIA" + self.chars(LETTERS.upper() + "0123456789", 16, 16), True
        if kind == 2:
            return self.pick(PREFIXES[1:]) + self.chars(MIXED, 20, 36), True
        if kind == 3:
            return "eyJ" + ".".join(self.chars(MIXED + "_-", 16, 30) for _ in range(3)), True
        if kind == 4:
            return self.chars(MIXED + "+/", 24, 44) + self.pick(["", "=", "=="]), True
        if kind == 5:
            return self.chars(MIXED, 3, 6) + self.pick("@!#%&") + self.chars(MIXED, 3, 6) + self.pick("0123456789"), False
        return self.chars(MIXED, 5, 12) + self.chars("0123456789", 1, 3), False

    def planted(self) -> list[tuple[str, bool]]:
        value, known = self.secret()
        key = self.pick(["password", "passwd", "secret", "token", "api_key", "apikey", "auth_token", "secret_key", "Password", "API_KEY", "client_secret", "pwd"])
        form = int(self.draw.integers(8 if known else 6))
        before, after = {
            0: (f'{key} = "', '"'), 1: (f"{key}: ", ""), 2: (f"{key}=", ""), 3: (f"{key} is ", self.pick(["", ".", ","])),
            4: (f"export {key.upper()}=", ""), 5: (f"'{key}': '", "'"), 6: ("", ""), 7: ("Authorization: Bearer ", ""),
        }[form]
        return [(before, False), (value, True), (after + self.pick(["", "", "###", "%%%"]), False)]

    def harmless(self) -> list[tuple[str, bool]]:
        n = lambda a, b: self.chars("0123456789", a, b)
        w = lambda: self.chars(LETTERS, 2, 10)
        return [(self.pick([
            n(1, 19), f"({n(3, 3)}) {n(3, 3)}-{n(4, 4)}", f"+{n(1, 2)} {n(3, 3)} {n(4, 4)}", f"{n(3, 3)}-{n(2, 2)}-{n(4, 4)}", f"{n(4, 4)} {n(4, 4)} {n(4, 4)} {n(4, 4)}",
            f"{w()}.{n(1, 3)}@{w()}{n(1, 1)}.example.com", f"https://www.{w()}.example.org/{w()}/{n(1, 5)}?page={n(1, 1)}", f"{n(1, 3)}.{n(1, 3)}.{n(1, 3)}.{n(1, 3)}",
            f"v{n(1, 1)}.{n(1, 2)}.{n(1, 2)}", f"{n(4, 4)}-{n(2, 2)}-{n(2, 2)}", f"{w()}_{w()}.py", f"/{w()}/{w()}/{w()}.txt", f"{w()} = {w()}", f"token = {w()};", f"the token {w()} of {w()}",
            f"password {w()} {w()}", f"secret: {w()}", f"{w()}-{w()}-{w()}", f"{w().title()}{w().title()}{w().title()}", f"#{self.chars('0123456789abcdef', 6, 6)}", self.chars(LETTERS, 16, 30), self.chars(LETTERS, 14, 24).upper(),
            f"SPDX-License-Identifier: {w().title()}-{n(1, 1)}.0", f"Copyright (c) {n(4, 4)} {w().title()}", f"{self.chars(LETTERS.upper(), 2, 2)}{n(2, 2)} {n(4, 4)} {n(4, 4)} {n(4, 4)}", f"{w()}({w()}, {n(1, 3)})", f"{w()}{n(1, 4)}",
        ]), False)]

    def line(self) -> tuple[str, list[tuple[int, int]]]:
        parts = self.prose(0, 12)
        for _ in range(int(self.draw.integers(0, 3))):
            parts += [*(self.planted() if self.draw.random() < 0.5 else self.harmless()), *[(" ", False)], *self.prose(1, 8)]
        text, spans, last = "", [], " "
        for value, secret in parts:
            glue = "" if secret or last.endswith(("=", '"', "'", " ")) or not value or not value[0].isalnum() else " "
            text += glue
            if secret:
                spans.append((len(text), len(text) + len(value)))
            text += value
            last = text[-1:] or " "
            if secret:
                last = " "  # what follows a value says itself whether it is joined
        return text, spans


def tagged_lines(lines: int, seed: int, longest: int) -> list[tuple[list[str], np.ndarray]]:
    """(tokens, tags) of synthetic lines; tags 0 outside, 1 begin, 2 inside."""
    source, out = _Lines(seed), []
    while len(out) < lines:
        text, spans = source.line()
        found = list(TOKEN.finditer(text))[:longest]
        tags = np.zeros(len(found), np.int64)
        for a, b in spans:
            inside = [i for i, m in enumerate(found) if a <= m.start() < b]
            tags[inside] = 2
            tags[inside[:1]] = 1
        if found:
            out.append(([m[0] for m in found], tags))
    return out


def examples(lines: int = 1000, seed: int = 5, longest: int = 48) -> list[tuple[np.ndarray, np.ndarray]]:
    """(shapes, tags) of the training lines."""
    return [(np.array([shape(x) for x in tokens], np.int64), tags) for tokens, tags in tagged_lines(lines, seed, longest)]


def inputs(codes: np.ndarray) -> np.ndarray:
    """Feature rows of a text: own shape, two before, one after, the file, and a constant."""
    own = unpacked(codes)
    none = np.zeros((2, SHAPE), np.float32)
    before = np.vstack([none, own])
    whole = np.tile(file_bits(codes), (len(codes), 1))
    return np.hstack([own, before[1:-1], before[:-2], np.vstack([own[1:], none[:1]]), whole, np.ones((len(codes), 1), np.float32)])


def train(data: list[tuple[np.ndarray, np.ndarray]], steps: int = 100, rate: float = 0.15, ridge: float = 2e-4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights of features, of transitions and of the first tag, by Adam on the likelihood."""
    count, long = len(data), max(len(c) for c, _ in data)
    x = np.zeros((long, count, 4 * SHAPE + FILE + 1), np.float32)
    hot = np.zeros((long, count, 3))
    real = np.zeros((long, count, 1))
    for i, (codes, tags) in enumerate(data):
        x[: len(codes), i], hot[np.arange(len(codes)), i, tags], real[: len(codes), i] = inputs(codes), 1, 1
    flat = x.reshape(-1, x.shape[2])
    pairs = np.einsum("tns,tnr->sr", hot[:-1], hot[1:])
    weights = [np.zeros((x.shape[2], 3)), np.zeros((3, 3)), np.zeros(3)]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    for k in range(1, steps + 1):
        w, t, first = weights
        e = (flat @ w.astype(np.float32)).reshape(hot.shape).astype(float)
        # past its end a line goes on with the likelihood 1, which changes nothing
        node, step, start = np.where(real > 0, np.exp(e - e.max(axis=2, keepdims=True)), 1), np.exp(t), np.exp(first)
        ahead, back = np.empty_like(e), np.ones_like(e)
        ahead[0] = node[0] * start
        ahead[0] /= ahead[0].sum(axis=1, keepdims=True)
        for i in range(1, long):
            new = node[i] * (ahead[i - 1] @ step)
            ahead[i] = np.where(real[i] > 0, new / new.sum(axis=1, keepdims=True), ahead[i - 1])
        for i in range(long - 2, -1, -1):
            new = (node[i + 1] * back[i + 1]) @ step.T
            back[i] = np.where(real[i + 1] > 0, new / new.sum(axis=1, keepdims=True), 1)
        share = ahead * back
        share *= real / share.sum(axis=2, keepdims=True)
        edge = ahead[:-1, :, :, None] * step * (node * back)[1:, :, None, :]
        edge *= real[1:, :, :, None] / edge.sum(axis=(2, 3), keepdims=True)
        slopes = [flat.T @ (share - hot).reshape(-1, 3).astype(np.float32), edge.sum(axis=(0, 1)) - pairs, (share[0] - hot[0]).sum(axis=0)]
        for j, g in enumerate(slopes):
            g = g / count + ridge * weights[j]
            m, v = moments[j]
            m[:] = 0.9 * m + 0.1 * g
            v[:] = 0.99 * v + 0.01 * g * g
            weights[j] = weights[j] - rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return tuple(weights)


@functools.lru_cache(1)
def trained() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return train(examples())


class Field:
    """The trained field over texts. Tokens of one shape share their scores, so a text is
    a list of shape numbers; scores are those of begin and inside less that of outside."""

    def __init__(self, weights: tuple[np.ndarray, np.ndarray, np.ndarray], memo: int = 200_000):
        w, self.t, self.first = weights
        self.w = (w - w[:, :1])[:, 1:]
        self.numbers = _Memo(self._number, memo)
        came = np.vstack([self.t, self.first[None, :]])  # from each tag, or from the start
        go = np.hstack([self.t, np.zeros((3, 1))])  # to each tag, or to the end
        self.most = np.array([(came[:, s] - came[:, 0]).max() + (go[s] - go[0]).max() for s in (1, 2)])
        self.known: dict[int, int] = {}
        self.codes = np.zeros(0, np.int64)
        self.own = np.zeros((4, 0, 2))

    def _number(self, token: str) -> int:
        code = shape(token)
        if code not in self.known:
            self.known[code] = len(self.known)
            bits = unpacked(np.array([code], np.int64))
            self.codes = np.append(self.codes, code)
            self.own = np.concatenate([self.own, np.stack([bits @ self.w[k * SHAPE : (k + 1) * SHAPE] for k in range(4)])], axis=1)
        return self.known[code]

    def scores(self, tokens: list[str]) -> np.ndarray:
        at = np.fromiter(map(self.numbers.__getitem__, tokens), np.int64, len(tokens))
        e = self.own[0][at]
        e += self.w[-1] + file_bits(self.codes[at]) @ self.w[4 * SHAPE : -1]
        e[1:] += self.own[1][at[:-1]]
        e[2:] += self.own[2][at[:-2]]
        e[:-1] += self.own[3][at[1:]]
        return e

    def tags(self, tokens: list[str]) -> np.ndarray:
        """The best tag of every token: 0 outside, 1 begin, 2 inside."""
        out = np.zeros(len(tokens), np.int8)
        if not tokens:
            return out
        e = self.scores(tokens)
        open_ = (e >= -self.most).any(axis=1)
        if not open_.any():
            return out
        edge = np.diff(np.concatenate([[0], open_.astype(np.int8), [0]]))
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
            start = self.first if a == 0 else self.t[0]
            end = np.zeros(3) if b == len(tokens) else self.t[:, 0]
            out[a:b] = self._viterbi([[0.0, *x] for x in e[a:b].tolist()], start.tolist(), end.tolist())
        return out

    def _viterbi(self, e: list, start: list, end: list) -> list[int]:
        t = self.t.tolist()
        score = [start[s] + e[0][s] for s in range(3)]
        back = []
        for own in e[1:]:
            pick = [max(range(3), key=lambda p, s=s: score[p] + t[p][s]) for s in range(3)]
            score = [score[pick[s]] + t[pick[s]][s] + own[s] for s in range(3)]
            back.append(pick)
        at = max(range(3), key=lambda s: score[s] + end[s])
        path = [at]
        for pick in reversed(back):
            at = pick[at]
            path.append(at)
        return path[::-1]

    def spans(self, text: str) -> list[Span]:
        found = TOKEN.findall(text)
        tags = self.tags(found)
        if not tags.any():
            return []
        out: list[Span] = []
        for m, tag, before in zip(TOKEN.finditer(text), tags.tolist(), [0, *tags.tolist()[:-1]], strict=True):
            if tag == 1 or tag == 2 and not before:
                out.append((m.start(), 3, m.end()))
            elif tag == 2:
                out[-1] = (out[-1][0], 3, m.end())
        return out


@functools.lru_cache(1)
def _field(packed: bytes) -> Field:
    """One field a worker process, so that its memo outlives a task."""
    import pickle

    return Field(pickle.loads(packed))


def all_spans(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), by start and kind."""
    base = base_spans(text)
    return base, sorted([*base, *uncovered(field.spans(text), base)])


def uncovered(spans: list[Span], base: list[Span]) -> list[Span]:
    """The spans that no base span covers; both lists are sorted, so one walk over them will do."""
    out, k, reach = [], 0, -1
    for s in spans:
        while k < len(base) and base[k][0] <= s[0]:
            reach = max(reach, base[k][2])
            k += 1
        if reach < s[2]:
            out.append(s)
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_assign, n_access, n_hex, base_sha256, spans`` a row."""
    import pickle

    ship(docs.sparkSession)
    packed = pickle.dumps(trained())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        field = _field(packed)
        for batch in batches:
            rows = []
            for text in batch["text"]:
                base, every = all_spans(text, field)
                n = [sum(k == j for _, k, _ in base) for j in range(3)]
                rows.append((*n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
            out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])
            out.insert(0, "id", batch["id"].array)
            yield out

    source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return map_batches(source, run, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string").withColumnRenamed("id", id_col)


MASK = "[SECRET]"


def masked(text: str, spans: list[Span]) -> str:
    """The text with each stretch that spans cover replaced by ``MASK``."""
    out, at = [], 0
    for a, _, b in sorted(spans):
        if a >= at:
            out += [text[at:a], MASK]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with secrets masked in the text and the length of texts that change; other
    texts and columns, nulls too, as they are."""
    import pickle

    ship(docs.sparkSession)
    packed = pickle.dumps(trained())

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        field = _field(packed)
        return texts.map(lambda x: None if x is None else masked(x, all_spans(x, field)[1]))

    new = clean(F.col(text_col))
    length = F.when(new.eqNullSafe(F.col(text_col)), F.col(length_col)).otherwise(F.length(new).cast("long")).alias(length_col)
    return docs.select(*[new.alias(c) if c == text_col else length if c == length_col else F.col(c) for c in docs.columns])


def op4_secret_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
