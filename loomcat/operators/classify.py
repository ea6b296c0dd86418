"""Classification ladders: the first branch that holds decides, and says so."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def resolve_brand(brand: Column, aliases: dict[str, str], trusted: Column) -> Column:
    """The alias of a brand, else the brand if it is trusted, else ``unknown``."""
    out = None
    for name, target in aliases.items():
        out = F.when(brand == name, target) if out is None else out.when(brand == name, target)
    rest = F.when(trusted, brand).otherwise("unknown")
    return rest if out is None else out.otherwise(rest)


# Where a gender may come from that is taken for verified.
VERIFIED = ("engine", "url", "text", "config_default")


def is_unverified_unisex(gender: Column, source: Column) -> Column:
    """Is ``gender`` (an array) just unisex, from no source that is verified?"""
    return F.coalesce((F.size(gender) == 1) & (F.get(gender, 0) == "unisex"), F.lit(False)) & ~F.coalesce(source.isin(*VERIFIED), F.lit(False))
