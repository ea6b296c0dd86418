"""Large word tables: one walk over a text finds all their words.

The words of a table make one automaton (Aho-Corasick), built once and given to every
worker process once. A text of any length costs one walk, however many words there are. From
the entries found, columns take the first by the table's order, the only one, or all.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .shipping import ship

_JOINERS = re.compile(r"[\s_-]+")
_WORD_CHARACTERS = frozenset("abcdefghijklmnopqrstuvwxyz0123456789_")


def word_form(text: str) -> str:
    """Lower case; white space, ``_`` and ``-`` as single spaces."""
    return _JOINERS.sub(" ", text.lower())


@dataclass(frozen=True)
class Entry:
    """A label and its words: ``words`` stand between characters that are no ASCII letters or digits (words of other
    scripts between those that are no letters or digits at all), ``parts`` anywhere. What stands before one of ``not_before`` doesn't count."""

    label: str
    words: tuple[str, ...] = ()
    parts: tuple[str, ...] = ()
    not_before: tuple[str, ...] = ()


class Matcher:
    """The automaton of a table of entries."""

    def __init__(self, entries: Sequence[Entry]):
        import ahocorasick

        self.entries = entries
        uses: dict[str, list[tuple[int, bool]]] = {}
        for k, entry in enumerate(entries):
            for words, whole in ((entry.words, True), (entry.parts, False)):
                for word in words:
                    uses.setdefault(word_form(word).strip(), []).append((k, whole))
        if "" in uses:
            raise ValueError("a word of a vocabulary must not be empty")
        self.automaton = ahocorasick.Automaton()
        for word, where in uses.items():
            self.automaton.add_word(word, (len(word), word.isascii(), tuple(where)))
        if uses:
            self.automaton.make_automaton()
        self.stops = [tuple(word_form(w).strip() for w in e.not_before) for e in entries]

    def found(self, text: str | None) -> list[int]:
        """The numbers of the entries that a text names, in the table's order."""
        if not text or not len(self.automaton):
            return []
        text = word_form(text)
        out: set[int] = set()
        for last, (size, plain, where) in self.automaton.iter(text):
            begin, end = last + 1 - size, last + 1
            free = not any(c in _WORD_CHARACTERS or not plain and c.isalnum() for c in text[max(0, begin - 1) : begin] + text[end : end + 1])
            for k, whole in where:
                if k in out or whole and not free:
                    continue
                rest = text[end : end + 1].isspace() + end
                if not any(text.startswith(s, end) or text.startswith(s, rest) for s in self.stops[k]):
                    out.add(k)
        return sorted(out)


@functools.lru_cache(8)
def _matcher(entries: tuple[Entry, ...]) -> Matcher:
    """One a worker process and table."""
    return Matcher(entries)


class Vocabulary:
    """A table of entries, in order of precedence. Stands wherever ordered rules do
    (``rules.first_match``, ``unique_match``, ``all_matches``); texts need no other form."""

    def __init__(self, entries: Sequence[Entry]):
        self.table = tuple(entries)
        Matcher(self.table)  # fails here rather than in a task

        table = self.table

        @F.pandas_udf("array<int>")
        def find(texts: pd.Series) -> pd.Series:
            return texts.map(_matcher(table).found)

        self._find = find

    def entries(self, text: Column) -> Column:
        """The numbers of the entries that a text names, in order; none for a missing text."""
        if spark := SparkSession.getActiveSession():
            ship(spark)
        return self._find(text)

    def labels(self, text: Column) -> Column:
        names = F.array(*[F.lit(e.label) for e in self.table])
        return F.array_distinct(F.transform(self.entries(text), lambda k: F.get(names, k)))
