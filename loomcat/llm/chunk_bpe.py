"""BPE encoding and decoding by content-defined chunk reuse.

1. A rolling hash over the bytes cuts each text into chunks, so passages that documents
   share give the same chunks wherever they stand.
2. Each distinct chunk is encoded once by itself and kept with the cuts between its
   pre-tokens; its ids are right for any text but near its ends.
3. Where two chunks meet, a window over the join is encoded again, from a cut in the left
   chunk to one in the right. It must give the left chunk's ids at its beginning, and at
   its end, from some cut on, those of the right chunk. If the right side doesn't agree,
   the window grows within the chunk, then over the next one; if the left one doesn't, it
   grows to the whole text.

What a worker process has encoded it keeps for later tasks, in a bounded memo that
forgets what isn't used; processes share no chunks, as a join of all chunks with a table
of them would shuffle the texts several times over to save less than that costs.

Defined results: a null text counts as empty; an empty text has no ids; rows
are independent, so repeated rows give repeated results and an empty table an
empty one; very long texts are encoded whole; columns other than the id and the text are
ignored, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, ship, table, text_or_empty, tokenizer_file
from .tokens import ByteBpe, _Memo

WINDOW = 8
REACH = 32


def gear_table(seed: int = 11) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**32, 256, dtype=np.uint32)


def chunks(data: bytes, gear: np.ndarray, mask: int, most: int = 4096) -> Iterator[bytes]:
    """Cut after each place where the rolling hash of the last ``WINDOW`` bytes
    has zeros under ``mask``, never inside a character, at ``most`` bytes at latest."""
    if len(data) <= WINDOW:
        yield data
        return
    b = np.frombuffer(data, np.uint8)
    g = gear[b]
    h = g[WINDOW - 1 :].copy()
    for k in range(1, WINDOW):
        h += g[WINDOW - 1 - k : len(g) - k] << np.uint32(k)
    ends = np.flatnonzero((h & np.uint32(mask)) == 0) + WINDOW
    begin = 0
    for end in [*ends.tolist(), len(data)]:
        while end - begin > most:
            stop = begin + most
            while data[stop] & 0xC0 == 0x80:
                stop -= 1
            yield data[begin:stop]
            begin = stop
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        if end > begin:
            yield data[begin:end]
            begin = end


class Chunk(NamedTuple):
    text: str
    cuts: array  # where its pre-tokens begin, and its length
    at: array  # how many bytes of ids come before each cut
    ids: bytes
    last: int  # number of the last cut that holds whatever follows


class ChunkEncoder:
    def __init__(self, path: str, mask: int = 0xFF, limit: int = 60_000):
        self.bpe = ByteBpe(path)
        self.gear, self.mask = gear_table(), mask
        self.memo = _Memo(self._chunk, limit)
        self.seen = self.encoded = self.joined = 0  # characters in chunks, in those encoded, in windows

    def _chunk(self, data: bytes) -> Chunk:
        text = data.decode()
        self.encoded += len(text)
        parts, ids = self.bpe.split(text)
        cuts = array("I", accumulate(map(len, parts), initial=0))
        return Chunk(text, cuts, array("I", accumulate(map(len, ids), initial=0)), b"".join(ids), bisect_right(cuts, max(0, self.bpe.settled(text))) - 1)

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        out: list[bytes] = []
        held: list[str] = []  # text from a cut on, whose ids are not settled yet
        size = patience = 0
        known = None  # ids of the left chunk that the next window must give again
        for k, data in enumerate(chunks(text.encode(), self.gear, self.mask)):
            chunk = self.memo[data]
            self.seen += len(chunk.text)
            begin: int | None = 0
            if k:  # a long window that found no agreement is tried again when it has doubled
                begin = self._join("".join(held), known, chunk, out) if size <= 16 * REACH or size >= patience else None
                if begin == -1:
                    return self._plain(text)
            if begin is None or begin >= chunk.last:
                held.append(chunk.text)
                size += len(chunk.text)
                patience = patience if size < patience else 2 * size
                continue
            stop = chunk.last - 1
            out.append(chunk.ids[chunk.at[begin] : chunk.at[stop]])
            held, known = [chunk.text[chunk.cuts[stop] :]], chunk.ids[chunk.at[stop] : chunk.at[chunk.last]]
            size, patience = len(held[0]), 0
        out.append(self._plain("".join(held)))
        return b"".join(out)

    def _plain(self, text: str) -> bytes:
        return b"".join(self.bpe.split(text)[1])

    def decode(self, ids: list[int]) -> str:
        return self.bpe.decode(ids)

    def _join(self, left: str, known: bytes | None, chunk: Chunk, out: list[bytes]) -> int | None:
        """Encode windows over a join, growing until both sides agree; their ids go to
        ``out``. The number of the chunk's cut from which its own ids hold, None if there
        is none in this chunk, -1 if the left side does not agree."""
        reach, n = REACH, len(left)
        while True:
            end = chunk.cuts[min(bisect_left(chunk.cuts, reach), len(chunk.cuts) - 1)]
            window = left + chunk.text[:end]
            self.joined += len(window)
            parts, ids = self.bpe.split(window)
            if known is not None and ids[:1] != [known]:
                return -1
            settled, at = self.bpe.settled(window), 0
            for j, part in enumerate(parts):
                after = at + len(part)
                if after > settled:
                    break
                if at >= n:
                    i = bisect_left(chunk.cuts, at - n)
                    if i < chunk.last and chunk.cuts[i] == at - n and chunk.ids[chunk.at[i] : chunk.at[i + 1]] == ids[j]:
                        out += ids[:j]
                        return i
                at = after
            if end == len(chunk.text):
                return None
            reach *= 4


@functools.lru_cache(1)
def encoder(path: str) -> ChunkEncoder:
    """One encoder a worker process, so that its memos outlive a task."""
    return ChunkEncoder(path)


def encode_decode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "byte_bpe_50k.json", with_ids: bool = False) -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256`` a row, plus ``ids`` and ``decoded`` if asked."""
    ship(docs.sparkSession)
    more = ", ids array<int>, decoded string" if with_ids else ""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = encoder(tokenizer_file(tokenizer))
        digits = codec.bpe.digits
        for batch in batches:
            rows = []
            for text in batch["text"]:
                ids = np.frombuffer(codec.encode(text), "<u4").tolist()
                decoded = codec.decode(ids)
                row = [len(ids), hashlib.sha256(",".join(map(digits.__getitem__, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()]
                rows.append([*row, ids, decoded] if with_ids else row)
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if with_ids else [])])
            out.insert(0, "id", batch["id"].array)
            yield out

    source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    out = map_batches(source, run, f"n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
    return out.withColumnRenamed("id", id_col)


def op9_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"))
