"""SentencePiece (BPE with byte fallback) encoding and decoding by vectorised merge rounds.

Texts are cut into words where no piece can reach across. The symbols of all words that a
batch brings and that the memo does not know lie in flat numpy arrays. A round looks up the
rank of every pair of neighbours, takes the least rank of each word, merges its leftmost pairs
of that rank in all words at once, and compacts the arrays; words in which no pair is left
leave them. It ends when no word is left.

Merging all leftmost pairs of one rank in one round gives what merging them one by one gives,
unless a merge makes a pair that ranks before it; ranks of pieces for which the vocabulary
allows that are merged one at a time. A word of more than ``LONG`` symbols takes, in place of
the least rank of the whole word, the least within ``reach`` symbols on either side, ``reach``
being the length of the longest piece: merges from farther away cannot touch the pair before
it is due. So a text without any word border takes few rounds as well.

Pieces that share one score are runs of the space symbol, which rank last of all. What is left
of a run is grouped at the end, from a table of what the merges one by one give.

Defined results: a null text counts as empty; an empty text has no ids; rows are independent,
so repeated rows give repeated results and an empty table an empty one; very long texts are
encoded whole; columns other than the id and the text are ignored, whatever their names.
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

from .common import map_batches, ship, table, text_or_empty, tokenizer_file

SPACE = "▁"
WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
NONE = np.iinfo(np.int32).max  # the rank of a pair that is no piece
LONG = 48


class Vocabulary:
    """The pieces of a model and, for every pair of pieces that makes a piece, its rank."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        special = {i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)}
        if model.encode(" a  b ", out_type=str) != model.encode_as_pieces(" a  b ") or model.decode(model.encode(" a  b ")) != " a  b ":
            raise ValueError("only models that keep all white space are supported")
        self.unknown = model.unk_id()
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        if not all(model.is_byte(int(i)) for i in self.byte_ids):
            raise ValueError("only models with byte fallback are supported")
        ids = {p: i for i, p in enumerate(self.pieces) if i not in special}
        score = {p: model.get_score(i) for p, i in ids.items()}
        by_rank = sorted((p for p in ids if len(p) > 1 and p.strip(SPACE)), key=lambda p: -score[p])
        runs = [p for p in ids if len(p) > 1 and not p.strip(SPACE)]
        if len({score[p] for p in by_rank}) < len(by_rank) or (runs and max(score[p] for p in runs) >= min(score[p] for p in by_rank)) or len({score[p] for p in runs}) > 1:
            raise ValueError("pieces must have scores of their own, but for runs of spaces, which rank last")
        if any(SPACE in p.lstrip(SPACE) for p in by_rank):
            raise ValueError("no piece may hold a space after another character")
        self.id_of_rank = np.array([ids[p] for p in by_rank], np.int64)
        self.rank_of = {p: r for r, p in enumerate(by_rank)}
        self.reach = max(map(len, ids))
        keys, ranks, risky = [], [], np.zeros(len(by_rank), bool)
        for rank, piece in enumerate(by_rank):
            for k in range(1, len(piece)):
                left, right = piece[:k], piece[k:]
                if left in ids and right in ids:
                    keys.append(ids[left] * size + ids[right])
                    ranks.append(rank)
                    for half in (left, right):  # a pair with this half may come up, and before it, once the half is made
                        if self.rank_of.get(half, -1) > rank:
                            risky[self.rank_of[half]] = True
        order = np.argsort(keys)
        self.keys, self.ranks, self.risky, self.size = np.array(keys, np.int64)[order], np.array(ranks, np.int32)[order], risky, size
        # characters: the piece of each, and the pairs that stand side by side in some piece
        top = max(ord(p) for p in ids if len(p) == 1) + 1
        self.char_ids = np.full(top, -1, np.int64)
        for p, i in ids.items():
            if len(p) == 1:
                self.char_ids[ord(p)] = i
        self.inside = np.unique(np.array([ord(a) << 21 | ord(b) for p in by_rank for a, b in zip(p, p[1:], strict=False)], np.int64))
        self.space_id = ids[SPACE]
        self.runs = {len(p): ids[p] for p in [*runs, SPACE]}
        self.longest_run = max(self.runs)
        self.tails = [self._grouped(n) for n in range(3 * self.longest_run)]
        if any(self.tails[n][0] != self.longest_run for n in range(2 * self.longest_run, 3 * self.longest_run)):
            raise ValueError("runs of spaces must be grouped by the longest piece")
        self.bytes_of = [b"" if i in special else p.replace(SPACE, " ").encode() for i, p in enumerate(self.pieces)]
        for b, i in enumerate(self.byte_ids.tolist()):
            self.bytes_of[i] = bytes([b])
        self.bytes_of[self.unknown] = model.decode([self.unknown]).encode()
        self.bytes_only = set(self.byte_ids.tolist())
        self.control = {i for i in range(size) if model.is_control(i)}
        self.digits = [str(i) for i in range(size)]

    def _grouped(self, n: int) -> list[int]:
        """How one run of ``n`` spaces is grouped: always the leftmost pair that makes a piece."""
        parts = [1] * n
        while True:
            k = next((k for k in range(len(parts) - 1) if parts[k] + parts[k + 1] in self.runs), None)
            if k is None:
                return parts
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def run_ids(self, n: int) -> list[int]:
        """The ids of a run of ``n`` spaces. As soon as the longest piece stands, nothing joins it."""
        most = self.longest_run
        whole = max(0, n // most - 1)
        return [self.runs[most]] * whole + [self.runs[k] for k in self.tails[n - whole * most]]

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left * self.size + right
        wanted[(left < 0) | (right < 0)] = -1
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == wanted, self.ranks[at], NONE).astype(np.int32)


def _least_around(rank: np.ndarray, reach: int) -> np.ndarray:
    """The least rank within ``reach`` places on either side, by windows of doubling width."""
    width, low = 1, np.concatenate([np.full(reach, NONE, np.int32), rank, np.full(reach, NONE, np.int32)])
    while 2 * width <= 2 * reach + 1:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = 2 * reach + 1 - width
    return np.minimum(low[: len(rank)], low[rest : rest + len(rank)])


def merge_rounds(v: Vocabulary, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge the symbols of many words, which ``word`` numbers in ascending order, until no
    pair is left; the symbols that remain and their words, in order. A symbol below 0 joins nothing."""
    done: list[tuple[np.ndarray, np.ndarray]] = []
    rank = np.full(len(symbols), NONE, np.int32)  # of a symbol with the next one
    stale = np.arange(len(symbols) - 1)
    while len(symbols):
        stale = stale[word[stale] == word[stale + 1]]
        rank[stale] = v.pair_ranks(symbols[stale], symbols[stale + 1])
        starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        sizes = np.diff(starts, append=len(word))
        low = np.minimum.reduceat(rank, starts)
        finished = low == NONE
        if finished.any():
            out = np.repeat(finished, sizes)
            done.append((symbols[out], word[out]))
            symbols, word, rank = symbols[~out], word[~out], rank[~out]
            low, sizes = low[~finished], sizes[~finished]
            if not len(symbols):
                break
        bound = np.repeat(low, sizes)
        if sizes.max() > LONG:
            wide = np.repeat(sizes > LONG, sizes)
            bound = np.where(wide, _least_around(rank, v.reach), bound)
        due = (rank == bound) & (rank != NONE)
        # neighbouring pairs of one rank: the 1st, 3rd, ... of them merge, if all before them are due as well
        same = np.concatenate([[False], (rank[1:] == rank[:-1]) & (word[1:] == word[:-1])])
        place = np.arange(len(rank))
        first = np.maximum.accumulate(np.where(same, 0, place))
        blocked = np.maximum.accumulate(np.where(due, -1, place))
        hit = np.flatnonzero(due & (blocked < first) & ((place - first) % 2 == 0))
        delicate = v.risky[rank[hit]]
        if delicate.any():
            alone = np.ones(len(hit), bool)
            at = hit[delicate]
            free = np.ones(len(at), bool)
            for k in range(1, max(LONG, v.reach) + 1):  # none of its rank before it, in its word or within reach
                back = np.maximum(at - k, 0)
                free &= ~((at >= k) & (rank[back] == rank[at]) & (word[back] == word[at]))
            alone[delicate] = free
            hit = hit[alone]
        symbols[hit] = v.id_of_rank[rank[hit]]
        keep = np.ones(len(symbols), bool)
        keep[hit + 1] = False
        new_place = np.cumsum(keep) - 1
        now = new_place[hit]
        symbols, word, rank = symbols[keep], word[keep], rank[keep]
        rank[now] = NONE
        before = now[now > 0] - 1
        rank[before] = NONE
        touched = np.zeros(len(symbols), bool)
        touched[now] = touched[before] = True
        stale = np.flatnonzero(touched[:-1])
    if not done:
        return symbols, word
    all_symbols, all_words = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.argsort(all_words, kind="stable")
    return all_symbols[order], all_words[order]


class PieceEncoder:
    """Ids of texts, with a bounded memo of words; ``batch`` characters of new words share a round."""

    def __init__(self, path: str, limit: int = 300_000, batch: int = 400_000):
        self.v, self.limit, self.batch = Vocabulary(path), limit, batch
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _look_up(self, words: dict[str, None]) -> dict[str, bytes]:
        """The ids of words, as little-endian unsigned 32-bit numbers."""
        out, new = {}, []
        for word in words:
            ids = self.memo.get(word) or self.old.get(word)
            if ids is None:
                new.append(word)
            else:
                out[word] = ids
        out |= zip(new, self._encode_words(new), strict=True)
        if len(self.memo) > self.limit // 2:
            self.memo, self.old = {}, self.memo
        self.memo.update((w, ids) for w, ids in out.items() if len(w) <= LONG)
        return out

    def _encode_words(self, words: list[str]) -> list[bytes]:
        out: list[bytes] = []
        begin = size = 0
        for k, word in enumerate(words):
            size += len(word)
            if size >= self.batch:
                out += self._round(words[begin : k + 1])
                begin, size = k + 1, 0
        return out + self._round(words[begin:])

    def _round(self, words: list[str]) -> list[bytes]:
        if not words:
            return []
        v = self.v
        code = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
        symbols = np.where(code < len(v.char_ids), v.char_ids[np.minimum(code, len(v.char_ids) - 1)], -1)
        symbols[symbols < 0] = -1 - code[symbols < 0]  # stands for a character without a piece
        # words end for the rounds also where two characters stand side by side in no piece
        pair = code[:-1] << 21 | code[1:]
        at = np.searchsorted(v.inside, pair)
        at[at == len(v.inside)] = 0
        apart = (v.inside[at] != pair) | (owner[1:] != owner[:-1])
        stretch = np.concatenate([[0], np.cumsum(apart)])
        first = np.flatnonzero(np.concatenate([[True], apart]))
        merged, of = merge_rounds(v, symbols, stretch)
        return self._ids(merged, owner[first][of], len(words))

    def _ids(self, symbols: np.ndarray, owner: np.ndarray, words: int) -> list[bytes]:
        v = self.v
        plain = (symbols >= 0) & (symbols != v.space_id)
        double = (symbols[1:] == v.space_id) & (symbols[:-1] == v.space_id) & (owner[1:] == owner[:-1])
        counts = np.bincount(owner, minlength=words)
        ends = np.cumsum(counts)
        odd = set(owner[symbols < 0].tolist()) | set(owner[1:][double].tolist())
        data, out = symbols.astype("<u4").tobytes(), []
        if plain.all() or not odd:
            return [data[4 * (e - c) : 4 * e] for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
        for k, (e, c) in enumerate(zip(ends.tolist(), counts.tolist(), strict=True)):
            out.append(self._spelt(symbols[e - c : e]) if k in odd else data[4 * (e - c) : 4 * e])
        return out

    def _spelt(self, symbols: np.ndarray) -> bytes:
        """With bytes for characters without a piece, and runs of spaces grouped."""
        v, out, spaces = self.v, [], 0
        for s in [*symbols.tolist(), None]:
            if s == v.space_id:
                spaces += 1
                continue
            if spaces:
                out += v.run_ids(spaces)
                spaces = 0
            if s is not None and s >= 0:
                out.append(s)
            elif s is not None:
                out += v.byte_ids[list(chr(-1 - s).encode())].tolist()
        return np.array(out, "<u4").tobytes()

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        split = [WORD.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        known = self._look_up(dict.fromkeys(w for words in split for w in words))
        return [np.frombuffer(b"".join(map(known.__getitem__, words)), "<u4") for words in split]

    def decode(self, ids: list[int]) -> str:
        """As the library decodes: the space that encoding puts before a text is dropped again."""
        v = self.v
        parts = list(map(v.bytes_of.__getitem__, ids))
        first = next((k for k, i in enumerate(ids) if i not in v.control), None)
        if first is not None and v.pieces[ids[first]].startswith(SPACE):
            parts[first] = parts[first][1:]
        if v.control.isdisjoint(ids):  # else bytes on both sides of such an id would join
            try:
                return b"".join(parts).decode()
            except UnicodeDecodeError:
                pass
        return _lenient(v, ids, parts)


def _lenient(v: Vocabulary, ids: list[int], parts: list[bytes]) -> str:
    """Ids that no text gives: every byte piece that is part of no character becomes U+FFFD."""
    out, k = [], 0
    while k < len(ids):
        if ids[k] not in v.bytes_only:
            out.append(parts[k].decode())
            k += 1
            continue
        end = k
        while end < len(ids) and ids[end] in v.bytes_only:
            end += 1
        data = b"".join(parts[k:end])
        while data:
            for n in (1, 2, 3, 4):
                try:
                    out.append(data[:n].decode())
                    data = data[n:]
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                data = data[1:]
        k = end
    return "".join(out)


@functools.lru_cache(1)
def encoder(path: str) -> PieceEncoder:
    """One encoder a worker process, so that its memo outlives a task."""
    return PieceEncoder(path)


def groups(texts: list[str], most: int = 1_000_000) -> Iterator[slice]:
    """Consecutive texts of about ``most`` characters together; a longer text is alone with those before it."""
    begin = size = 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= most:
            yield slice(begin, k + 1)
            begin, size = k + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def encode_decode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "piece_bpe_32k.model", with_ids: bool = False) -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256`` a row, plus ``ids`` and ``decoded`` if asked."""
    ship(docs.sparkSession)
    more = ", ids array<int>, decoded string" if with_ids else ""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = encoder(tokenizer_file(tokenizer))
        digits = codec.v.digits
        for batch in batches:
            texts = batch["text"].tolist()
            for part in groups(texts):
                rows = []
                for found in codec.encode_batch(texts[part]):
                    ids = found.tolist()
                    decoded = codec.decode(ids)
                    row = [len(ids), hashlib.sha256(",".join(map(digits.__getitem__, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()]
                    rows.append([*row, ids, decoded] if with_ids else row)
                out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if with_ids else [])])
                out.insert(0, "id", batch["id"].iloc[part].array)
                yield out

    source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    out = map_batches(source, run, f"n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
    return out.withColumnRenamed("id", id_col)


def op13_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"))
