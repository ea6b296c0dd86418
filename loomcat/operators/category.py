"""Categories and subcategories: canonical values, their other spellings, and what names say.

Vocabularies are data: a ``Taxonomy`` holds them, and its ladders compile into columns."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import match_form
from ..rules import Rules, first_match, unique_match


@dataclass(frozen=True)
class Taxonomy:
    """``canonical`` values with their valid subcategories; ``spellings`` of other sources (in
    match form); ``priority`` rules (the first that is met decides) before ``aliases`` (one
    category must be alone); ``subcategories``: ordered rules by category; ``noise``: phrases whose
    words are no categories, though they sound like those in ``noisy``; ``foreign``: names of what doesn't belong in
    the catalogue; ``stronger``: (current, inferred) pairs where the name doesn't count.

    Rules are a few patterns or a ``Vocabulary`` of any number of words."""

    canonical: dict[str, tuple[str, ...]]
    spellings: dict[str, str] = field(default_factory=dict)
    priority: Rules = ()
    aliases: Rules = ()
    subcategories: dict[str, Rules] = field(default_factory=dict)
    noise: tuple[str, ...] = ()
    noisy: tuple[str, ...] = ()
    foreign: str | None = None
    stronger: tuple[tuple[str, str], ...] = ()

    def without_noise(self, text: Column) -> Column:
        for phrase in self.noise:
            text = F.regexp_replace(text, f"(?i){phrase}", " ")
        return text

    def prior(self, text: Column) -> Column:
        return first_match(self.priority, self.without_noise(text)) if self.priority else F.lit(None).cast("string")

    def infer(self, text: Column) -> Column:
        """The category that a text names, if it names one."""
        clean = self.without_noise(text)
        return F.coalesce(self.prior(text), unique_match(self.aliases, clean)) if self.aliases else self.prior(text)

    def current(self, raw: Column, form: Column) -> Column:
        """A given value as a canonical one."""
        spelt = [F.when(form == k, v) for k, v in self.spellings.items()]
        return F.when(raw.isin(*self.canonical), raw).otherwise(F.coalesce(*spelt) if spelt else F.lit(None).cast("string"))


def resolve_category(taxonomy: Taxonomy, category: Column, name: Column, trusted: Column | None = None, overrides: tuple[str, ...] = ()) -> Column:
    """``value, reason, confidence, review``: a canonical category or null, never another value.

    A canonical or otherwise spelt value stays, unless the name says more: phrases that only
    sound like the category, a value of ``other``, a priority rule, one of ``overrides`` (these
    even from ``trusted`` sources), or any other category, which a person then reviews."""
    trusted = F.lit(False) if trusted is None else trusted
    raw = F.coalesce(F.trim(category), F.lit(""))
    current = taxonomy.current(raw, F.lower(F.regexp_replace(F.translate(raw, "_-", "  "), r"\s+", " ")))
    inferred, prior = taxonomy.infer(name), taxonomy.prior(name)
    override = F.when(inferred.isin(*overrides), inferred) if overrides else F.lit(None).cast("string")
    out = lambda value, reason, confidence, review=False: F.struct((value if isinstance(value, Column) else F.lit(value)).cast("string").alias("value"), (reason if isinstance(reason, Column) else F.lit(reason)).cast("string").alias("reason"), F.lit(float(confidence)).alias("confidence"), F.lit(review).alias("review"))
    kept = out(current, F.when(current != raw, "category_canonicalized"), 0.9)
    noisy = taxonomy.without_noise(name) != name
    named = inferred.isNotNull()
    stronger = F.lit(False)
    for have, found in taxonomy.stronger:
        stronger = stronger | ((current == have) & (inferred == found))
    differs = lambda c: F.coalesce(c != current, F.lit(False))
    with_current = (
        F.when(noisy & current.isin(*taxonomy.noisy), out(F.when(differs(inferred), inferred).otherwise("other"), "category_keyword_noise_override", 0.95))
        .when((current == "other") & named, out(inferred, "category_other_text_fallback", 0.8))
        .when(F.coalesce(stronger, F.lit(False)), kept)
        .when(differs(prior) & ~trusted, out(prior, "category_priority_text_override", 0.9))
        .when(differs(override), out(override, "category_trusted_title_override", 0.9))
        .when(differs(inferred) & ~trusted, out(inferred, "category_text_conflict", 0.5, True))
        .otherwise(kept)
    )
    foreign = F.coalesce(F.rlike(name, F.lit(taxonomy.foreign)), F.lit(False)) if taxonomy.foreign else F.lit(False)
    return (
        F.when(foreign, out("other", "category_non_fashion_name", 0.99))
        .when((raw == "") & named, out(inferred, "category_missing_text_fallback", 0.84))
        .when(raw == "", out(None, "category_missing", 0, True))
        .when(current.isNotNull(), with_current)
        .when(named, out(inferred, "category_noise_text_fallback", 0.8))
        .otherwise(out("other", "category_unresolved_other_fallback", 0.2))
    )


def resolve_subcategory(taxonomy: Taxonomy, category: Column, subcategory: Column, text: Column) -> Column:
    """``value, reason``: a valid subcategory of the category, from the given one, else from its
    words and ``text`` by the category's rules, else null."""
    raw = F.coalesce(F.trim(subcategory), F.lit(""))
    given = raw != ""
    form = match_form(F.concat_ws(" ", raw, text))
    valid, found = F.lit(False), F.lit(None).cast("string")
    for name, values in taxonomy.canonical.items():
        valid = valid | ((category == name) & raw.isin(*values)) if values else valid
        if taxonomy.subcategories.get(name):
            found = F.when(category == name, first_match(taxonomy.subcategories[name], form)).otherwise(found)
    out = lambda value, reason: F.struct(value.cast("string").alias("value"), (reason if isinstance(reason, Column) else F.lit(reason)).cast("string").alias("reason"))
    nothing = F.lit(None)
    return (
        F.when(category.isNull() | (category == "other"), out(nothing, F.when(given, "no_category")))
        .when(valid, out(raw, nothing))
        .when(found.isNotNull(), out(found, F.when(given, "canonicalized").otherwise("text_fallback")))
        .otherwise(out(nothing, F.when(given, "noncanonical_dropped")))
    )


def by_source(rules: Rules, taxonomy: Taxonomy, kind: Column, tags: Column, title: Column, noise_kinds: tuple[str, ...] = (), broad: dict[str, Rules] | None = None, title_rules: Rules = ()) -> Column:
    """The category of a shop's product: by its type unless that says nothing, then its tags,
    then its title (``title_rules`` first). ``broad`` types give way to what their rules find
    in title and tags."""
    form = lambda text: taxonomy.without_noise(F.lower(F.translate(text, "_", " ")))
    k, words, tagged = form(F.trim(kind)), form(title), form(F.array_join(tags, " "))
    by_kind = F.when((k != "") & ~k.isin(*noise_kinds) if noise_kinds else k != "", first_match(rules, k))
    for category, narrower in (broad or {}).items():
        by_kind = F.when(by_kind == category, first_match(narrower, F.concat_ws(" ", words, tagged), F.lit(category))).otherwise(by_kind)
    by_title = F.coalesce(first_match(title_rules, F.trim(words)), first_match(rules, words)) if title_rules else first_match(rules, words)
    return F.when(k == "other", "other").otherwise(F.coalesce(by_kind, F.when(tagged != "", first_match(rules, tagged)), by_title))
