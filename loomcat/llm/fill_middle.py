"""Fill-in-middle transformation: a text is cut at two places between units, and its parts
are put in an order that lets a model learn to fill the middle.

The cuts are found by two passes of a lazy matcher over the text. The first counts the
units; the second advances to the smaller of two drawn ranks, then on to the larger, and
stops. No list of units is ever made, so a text of any number of units takes the memory of
its own characters only. The draws depend on the seed and the id alone: a row gives the same
result on any executor and in any batch.

Defined results: a null text counts as empty, an empty text stays plain; a null id is drawn
as the empty string; a text that holds a marker stays plain, as its parts could not be told
again; rows are independent, so repeated rows give repeated results and an empty table an
empty one; very long texts are cut whole; columns other than the id and the text are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, ship, table, text_or_empty

LINES = r"[^\n]*\n|[^\n]+"


@dataclass(frozen=True)
class FillMiddle:
    """Parameters: ``unit`` must match at least one character wherever it matches, and its
    matches must cover a text; ``fim_rate`` and ``spm_rate`` are percentages, the first of all
    texts, the second of the transformed ones."""

    seed: int = 7
    unit: str = LINES
    fim_rate: int = 100
    spm_rate: int = 50
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        marks = self.markers
        # no marker may begin within another one, or within itself: then each is found where it was put
        if not all(marks) or len(set(marks)) < 3 or any(a[k:] and b.startswith(a[k:]) for a in marks for b in marks for k in range(a == b, len(a))) or any(a != b and a in b for a in marks for b in marks):
            raise ValueError("markers must not be empty, overlap or hold one another")

    @property
    def markers(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle

    def draws(self, key: str) -> list[int]:
        digest = hashlib.sha256(f"{self.seed}:{key}".encode()).hexdigest()
        return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]

    def count(self, text: str) -> int:
        """First pass."""
        return sum(1 for _ in re.finditer(self.unit, text))

    def cuts(self, text: str, first: int, second: int) -> tuple[int, int]:
        """Second pass: where the unit of rank ``first`` ends, and that of ``second``, which is not less."""
        units = re.finditer(self.unit, text)
        ends = []
        done = at = 0
        for rank in (first, second):
            for match in islice(units, rank - done):
                at = match.end()
            done = rank
            ends.append(at)
        return ends[0], ends[1]

    def apply(self, key: str, text: str) -> tuple[int, str, int | None, int | None, str]:
        """``n, form, prefix_chars, middle_chars, output``."""
        n = self.count(text)
        h1, h2, h3, h4 = self.draws(key)
        if not text or any(m in text for m in self.markers) or h3 % 100 >= self.fim_rate:
            return n, "plain", None, None, text
        first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
        a, b = self.cuts(text, first, second)
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if h4 % 100 < self.spm_rate:
            return n, "spm", a, b - a, f"{self.suffix}{suffix}{self.prefix}{prefix}{self.middle}{middle}"
        return n, "psm", a, b - a, f"{self.prefix}{prefix}{self.suffix}{suffix}{self.middle}{middle}"

    def restore(self, form: str, output: str) -> str:
        """The exact text, from the output and the form alone."""
        if form == "plain":
            return output
        lead, follow = (self.suffix, self.prefix) if form == "spm" else (self.prefix, self.suffix)
        one, rest = output.removeprefix(lead).split(follow, 1)
        two, middle = rest.split(self.middle, 1)
        return two + middle + one if form == "spm" else one + middle + two


def fill_in_middle(docs: DataFrame, rule: FillMiddle | None = None, id_col: str = "doc_id", text_col: str = "text", with_output: bool = False) -> DataFrame:
    """``id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` a row, plus
    ``output`` if asked."""
    rule = rule or FillMiddle()
    ship(docs.sparkSession)
    columns = ["n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256", *(["output"] if with_output else [])]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
        for batch in batches:
            rows = []
            for key, text in zip(batch["key"], batch["text"], strict=True):
                *head, output = rule.apply(key, text)
                row = [*head, digest(output), digest(rule.restore(head[1], output))]
                rows.append([*row, output] if with_output else row)
            out = pd.DataFrame(rows, columns=columns).astype({"prefix_chars": "Int64", "middle_chars": "Int64"})
            out.insert(0, "id", batch["id"].array)
            yield out

    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key"), text_or_empty(text_col).alias("text"))
    more = ", output string" if with_output else ""
    out = map_batches(source, run, f"n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string{more}")
    return out.withColumnRenamed("id", id_col)


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
               sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
    h AS (
        SELECT *, len(units) AS n, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2, ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4 FROM d),
    f AS (
        SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
               CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                    WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h),
    p AS (
        SELECT *, array_to_string(units[1:a], '') AS pre, array_to_string(units[a + 1:b], '') AS mid, array_to_string(units[b + 1:], '') AS suf FROM f)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM p"""
