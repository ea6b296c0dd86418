"""Byte-level BPE through bounded memos of short units.

The ``tokenizers`` library stays the authority: units outside a plain
character set go through its pipeline or its own pre-tokenizer. Plain texts (ASCII and
Latin-1 letters, digits, ASCII punctuation) are split as the pipeline's own
pre-tokenizer splits them, and each distinct pre-token goes through the
library's BPE model once. ``tests/llm`` compares the ids with the library's.
"""

from __future__ import annotations

import re

import numpy as np

LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Printable ASCII without apostrophe (contractions) and "<" (special tokens).
PLAIN = re.compile(rf"[!-&(-;=-~{LETTERS}]+")
#: All of ASCII that is printable or white space; what ``\\s`` means is the same here in both.
PLAIN_BYTES = re.compile(rf"[\t-\r -~{LETTERS}]*")
WORD_PARTS = re.compile(rf"[{LETTERS}]+|[0-9]|[^{LETTERS}0-9]+")
#: The pre-tokenizer's own classes, over plain texts.
BYTE_PARTS = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level BPE:
    printable bytes stand for themselves, the others follow from U+0100 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b) if b in own else chr(extra))
        extra += b not in own
    return out


class _Memo(dict):
    """A dict that computes what it lacks. When it is full it becomes the old half, from
    which entries in use come back; what isn't used is forgotten with the next change."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit // 2, {}

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


class _Bpe:
    """Ids are little-endian unsigned 32-bit numbers in bytes."""

    def __init__(self, path: str, limit: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.alphabet = dict(enumerate(byte_alphabet()))
        self.parts = _Memo(self._part, limit)

    def _part(self, part: str) -> bytes:
        mapped = part if part.isascii() and part.isalnum() else part.encode().decode("latin-1").translate(self.alphabet)
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(mapped)])

    def library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


class WordBpe(_Bpe):
    """A lower-casing BPE that drops white space: every space and line end
    separates units, so a text's ids are the ids of its units in order."""

    def __init__(self, path: str, limit: int = 600_000):
        super().__init__(path, limit)
        self.units = _Memo(self._unit, limit)

    def _unit(self, unit: str) -> bytes:
        if not unit:
            return b""
        if unit.isascii() and unit.isalpha():  # most units are one pre-token
            return self.parts[unit.lower()]
        if PLAIN.fullmatch(unit):
            return b"".join([self.parts[p] for p in WORD_PARTS.findall(unit.lower())])
        return self.library(unit)

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.units.__getitem__, text.replace("\n", " ").split(" ")))


class ByteBpe(_Bpe):
    """A lossless byte-level BPE, by pre-tokens. A pre-token depends on no text before it,
    and where it ends is settled ``LOOKAHEAD`` characters later, unless an added token begins there."""

    LOOKAHEAD = 2

    def __init__(self, path: str, limit: int = 600_000):
        super().__init__(path, limit)
        self.byte_of = [b""] * self.tokenizer.get_vocab_size(with_added_tokens=True)
        back = {c: b for b, c in self.alphabet.items()}
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.byte_of[i] = bytes([back[c] for c in token]) if all(c in back for c in token) else token.encode()
        self.digits = [str(i) for i in range(len(self.byte_of))]
        self.added = {t.content: np.array([i], "<u4").tobytes() for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.any_added = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None

    def split(self, text: str) -> tuple[list[str], list[bytes]]:
        """The pre-tokens of a text, added tokens as well, and the ids of each."""
        if not (self.any_added and self.any_added.search(text)):
            parts = self._split(text)
            return parts, list(map(self.parts.__getitem__, parts))
        parts = [p for k, x in enumerate(self.any_added.split(text)) for p in ([x] if k % 2 else self._split(x))]
        return parts, [self.added.get(p) or self.parts[p] for p in parts]

    def _split(self, text: str) -> list[str]:
        if PLAIN_BYTES.fullmatch(text):
            return BYTE_PARTS.findall(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)] if text else []

    def settled(self, text: str) -> int:
        """Up to where the cuts between pre-tokens hold whatever follows the text."""
        end = len(text)
        for token in self.added:
            k = text.find(token[0], max(0, len(text) - len(token) + 1))
            while k >= 0 and not token.startswith(text[k:]):
                k = text.find(token[0], k + 1)
            end = min(end, k) if k >= 0 else end
        return end - self.LOOKAHEAD

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.byte_of.__getitem__, ids)).decode("utf-8", "replace")
