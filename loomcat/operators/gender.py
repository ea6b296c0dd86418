"""Whom a product is for: words in its texts and address, and the ladder that weighs them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ascii_word, contains_any, match_form
from ..functions.urls import path

GENDERS = ("men", "women", "unisex")
PARTING = "\x1e"

# Words that name an audience; the first of a pair stand as whole words, the
# second (Korean, which has no word borders here) anywhere in a text.
AUDIENCE = {
    "men": ("men|mens|men's|man|male|hombre|homme|uomo|herren", ("남성", "남자", "남자용", "멘즈")),
    "women": ("women|womens|women's|woman|female|mujer|femme|donna|damen|ladies", ("여성", "여자", "여자용", "우먼", "레이디스")),
    "unisex": (r"unisex|genderless|gender[-\s]?free", ("남녀공용", "공용", "유니섹스")),
    "kids": (r"kids?|kid's|child|children|childrens|boys?|boy's|girls?|girl's|baby|infant|toddler|junior|nino|nina|enfant|bambino", ("키즈", "아동", "유아", "주니어", "베이비", "어린이")),
}


@dataclass(frozen=True)
class SiteRules:
    """What is known of one site: further patterns by gender, prefixes of department tags by
    gender, patterns that only look like children's words, and whether a default of unisex is verified."""

    patterns: dict[str, list[str]] = field(default_factory=dict)
    departments: dict[str, list[str]] = field(default_factory=dict)
    kids_noise: tuple[str, ...] = ()
    verified_unisex: bool = False


def clean_genders(values: Column) -> Column:
    """The known genders of an array, trimmed, in lower case, each once."""
    low = F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda x: F.lower(F.trim(x)))
    return F.array_distinct(F.filter(low, lambda x: F.coalesce(x.isin(*GENDERS), F.lit(False))))


def names(text: Column, audience: str) -> Column:
    """Does a text (its own form and its match form, one after the other) name an audience?"""
    words, parts = AUDIENCE[audience]
    return F.coalesce(F.rlike(text, F.lit("(?i)" + ascii_word(words))) | contains_any(text, parts), F.lit(False))


def audience_of(text: Column) -> Column:
    return F.struct(*[names(text, a).alias(a) for a in AUDIENCE])


def from_words(found: Column) -> Column:
    """Men or women if one of them is named; if both are, or none, unisex if that is named."""
    one = found["men"] != found["women"]
    return F.when(one, F.when(found["men"], "men").otherwise("women")).when(found["unisex"], "unisex")


def only_one(flags: dict[str, Column], unisex_wins: bool) -> Column:
    """The gender whose flag alone is set; of several, unisex if that may win."""
    count = sum((f.cast("int") for f in flags.values()), F.lit(0))
    out = F.when(count == 1, F.coalesce(*[F.when(f, g) for g, f in flags.items()]))
    return out.when(flags["unisex"], "unisex") if unisex_wins and "unisex" in flags else out


def by_site(text: Column, rules: SiteRules) -> Column:
    flags = {g: F.coalesce(F.rlike(text, F.lit("|".join(f"(?:{p})" for p in patterns))), F.lit(False)) for g, patterns in rules.patterns.items() if patterns}
    return only_one(flags, True) if flags else F.lit(None).cast("string")


def by_department(tags: Column, rules: SiteRules) -> Column:
    low = F.transform(tags, lambda t: F.lower(t))
    starts = lambda g: F.coalesce(F.exists(low, lambda t: F.rlike(t, F.lit("^(?:" + "|".join(map(_literal, rules.departments[g])) + ")"))), F.lit(False)) if rules.departments.get(g) else F.lit(False)
    men, women, unisex = map(starts, GENDERS)
    return F.when(unisex | (men & women), "unisex").when(men, "men").when(women, "women")


def _literal(prefix: str) -> str:
    return r"\Q" + prefix.lower() + r"\E"


def by_label(name: Column) -> Column:
    """The audience that a name states as such: ``for women``, ``(Men's)``."""
    label = lambda who: F.coalesce(F.rlike(name, F.lit(rf"(?i)(?:\bfor\s+(?:{who})\b|[(\[]\s*(?:{who})\s*[)\]])")), F.lit(False))
    men, women = label("men(?:'?s)?|man"), label("women(?:'?s)?|woman")
    return F.when(men & ~women, "men").when(women & ~men, "women")


def resolve_gender(
    df: DataFrame,
    given: str = "gender",
    source: str = "gender_source",
    name: str = "name",
    category: str = "category",
    subcategory: str = "subcategory",
    tags: str = "tags",
    url: str = "product_url",
    brand_scope: str | None = None,
    rules: SiteRules = SiteRules(),
) -> DataFrame:
    """``df`` with ``resolved_gender, resolved_source, gender_conflict``.

    A gender is taken from a product's own evidence, else a default, else it stays open:
    no evidence is no unisex. ``source`` says where ``given`` comes from; all but
    ``config_default`` count as the site's own statement.

    1. Children's words decide for nobody, unless text or address name adults.
    2. A stated men or women holds, unless the name labels the other; if the address then
       speaks against the label, that is a conflict.
    3. Address against text: the definite one wins over unisex; men against women is a
       conflict (a stated unisex then stands).
    4. A definite address, then a definite text, then a stated unisex, then either's unisex.
    5. A site default of one gender (unisex only if verified), then a brand's single scope."""
    words = F.concat_ws(" ", F.col(name), F.col(category), F.col(subcategory), F.array_join(tags, " "))
    query = F.regexp_extract(F.col(url), r"(\?[^#]*)", 1)
    target = F.when(path(F.col(url)) == "", F.col(url)).otherwise(F.concat(path(F.col(url)), query))
    texts = {"_words": words, "_name": F.col(name), "_tags": F.array_join(tags, " "), "_url": F.col(url), "_at": F.coalesce(F.try_url_decode(target), target)}
    # all texts of a row go to the one Python worker that folds them in one piece
    piece = F.array_join(F.array(*[F.translate(F.coalesce(t, F.lit("")), PARTING, " ") for t in texts.values()]), PARTING)
    folded = df.withColumns(texts).withColumn("_forms", F.split(match_form(piece), PARTING))
    form = {t: F.trim(F.get("_forms", k)) for k, t in enumerate(texts)}
    formed = folded.withColumns({t: form[t] if t == "_at" else F.concat_ws("\n", F.col(t), form[t]) for t in texts})

    def without_noise(text: Column) -> Column:
        for pattern in rules.kids_noise:
            text = F.regexp_replace(text, pattern, " ")
        return text

    at = audience_of(F.col("_at"))
    found = formed.withColumns(
        {
            "_in_words": audience_of(F.col("_words")),
            "_in_name": audience_of(F.col("_name")),
            "_in_tags": audience_of(F.col("_tags")),
            "_from_url": only_one({g: at[g] for g in GENDERS}, False),
            "_kids": names(without_noise(F.col("_words")), "kids") | names(without_noise(F.col("_url")), "kids"),
            "_given": clean_genders(F.col(given)),
        }
    )
    mixed = lambda c: F.col(c)["men"] & F.col(c)["women"]
    raw = F.coalesce(F.when(~mixed("_in_words"), by_site(F.col("_words"), rules)), from_words(F.col("_in_words")))
    departments = F.coalesce(by_department(F.col(tags), rules), F.when(mixed("_in_tags"), "unisex"))
    explicit = F.when(~mixed("_in_name"), F.coalesce(by_site(F.col("_name"), rules), by_label(F.col(name))))
    is_default = F.coalesce(F.col(source) == "config_default", F.lit(False))
    single = F.when(F.size("_given") == 1, F.get("_given", 0))
    scope = clean_genders(F.col(brand_scope)) if brand_scope else F.array().cast("array<string>")
    weighed = found.withColumns({"_raw": raw, "_explicit": explicit, "_stated": F.when(~is_default, single), "_default": F.when(is_default, single), "_scope": F.when(F.size(scope) == 1, F.get(scope, 0))})
    weighed = weighed.withColumn("_text", F.coalesce("_raw", departments))

    from_url, text, stated, label = F.col("_from_url"), F.col("_text"), F.col("_stated"), F.col("_explicit")
    definite = lambda c: F.coalesce(c.isin("men", "women"), F.lit(False))
    answer = lambda g, s, conflict=False: F.struct(g.cast("string").alias("gender"), (s if isinstance(s, Column) else F.lit(s)).cast("string").alias("source"), F.lit(conflict).alias("conflict"))
    nobody = F.lit(None)
    against = definite(label) & (label != stated)
    by_statement = F.when(against & definite(from_url) & (from_url != label), answer(nobody, nobody, True)).when(against, answer(label, "text")).otherwise(answer(stated, F.col(source)))
    differ = F.coalesce(from_url != text, F.lit(False))
    by_difference = F.when(from_url == "unisex", answer(text, "text")).when(text == "unisex", answer(from_url, "url")).when(stated.isNotNull(), answer(stated, F.col(source))).otherwise(answer(nobody, nobody, True))
    usable_default = definite(F.col("_default")) | (F.col("_default") == "unisex") & F.lit(rules.verified_unisex)
    ladder = (
        F.when(F.col("_raw").isNull() & from_url.isNull() & F.col("_kids"), answer(nobody, nobody))
        .when(definite(stated), by_statement)
        .when(differ, by_difference)
        .when(definite(from_url), answer(from_url, "url"))
        .when(definite(text), answer(text, "text"))
        .when(stated.isNotNull(), answer(stated, F.col(source)))
        .when(from_url.isNotNull(), answer(from_url, "url"))
        .when(text.isNotNull(), answer(text, "text"))
        .when(is_default & (F.size("_given") > 0), F.when(usable_default, answer(F.col("_default"), "config_default")).otherwise(answer(nobody, nobody)))
        .when(definite(F.col("_scope")), answer(F.col("_scope"), "brand_scope"))
        .otherwise(answer(nobody, nobody))
    )
    return weighed.withColumn("_ladder", ladder).select(*df.columns, F.col("_ladder.gender").alias("resolved_gender"), F.col("_ladder.source").alias("resolved_source"), F.col("_ladder.conflict").alias("gender_conflict"))
