"""Ordered rules: a table of patterns compiled into one column expression, or a vocabulary of words."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .vocabulary import Vocabulary


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str
    unless: str | None = None

    def met(self, text: Column) -> Column:
        out = F.rlike(text, F.lit(self.pattern))
        return out & ~F.rlike(text, F.lit(self.unless)) if self.unless else out


Rules = Sequence[Rule] | Vocabulary


def first_match(rules: Rules, text: Column, default: Column | None = None) -> Column:
    """The label of the first rule that is met."""
    if isinstance(rules, Vocabulary):
        found = F.get(rules.labels(text), 0)
        return found if default is None else F.coalesce(found, default)
    out = None
    for r in rules:
        out = F.when(r.met(text), r.label) if out is None else out.when(r.met(text), r.label)
    return out.otherwise(F.lit(None).cast("string") if default is None else default)


def all_matches(rules: Rules, text: Column) -> Column:
    """The distinct labels of all rules that are met, in the order of the rules."""
    if isinstance(rules, Vocabulary):
        return rules.labels(text)
    return F.array_distinct(F.array_compact(F.array(*[F.when(r.met(text), r.label) for r in rules])))


def unique_match(rules: Rules, text: Column) -> Column:
    """The label, if the rules that are met agree on one."""
    labels = all_matches(rules, text)
    return F.when(F.size(labels) == 1, F.get(labels, 0))


def reasons(conditions: dict[str, Column]) -> Column:
    """The names of the conditions that hold."""
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), name) for name, c in conditions.items()]))
