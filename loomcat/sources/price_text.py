"""Prices in texts: one pass makes tokens of label, currency and number, and rules over the
tokens answer what a text means, what a label says and which amounts there are.

A comma always separates thousands: ``1.299,00 EUR`` reads 1.299.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# How currencies, prices and signs are written.
SIGNS = {"USD": "$", "EUR": "€", "GBP": "£", "KRW": "₩￦"}
REFERENCES = {"&#36;": "$", "&dollar;": "$", "&pound;": "£", "&euro;": "€"}
SALE = ("할인판매가", "할인가", "세일가", "최종가", "sale price", "discounted price")
ORIGINAL = ("소비자가", "정상가", "정가", "판매가", "list price", "regular price")
#: Labels that make a number in won an amount, the surest first; "price" is also the end of longer ones.
SURE = ("할인판매가", "판매가", "price")
LEAST_WON = 1000
LONGEST = 80

_ANY_LABEL = "|".join(x.replace(" ", r"\s*") for x in sorted({*SALE, *ORIGINAL, *SURE}, key=len, reverse=True))
_ANY_SIGN = "[" + "".join(SIGNS.values()) + "]"
TOKEN = rf"(?i)(?:({_ANY_LABEL})\s*[:：]?\s*)?({'|'.join(SIGNS)})?\s*({_ANY_SIGN})?\s*([0-9][0-9,]*)(\.[0-9]+)?"


def decoded(text: Column) -> Column:
    text = text.cast("string")
    return reduce(lambda t, r: F.regexp_replace(t, f"(?i){r}", REFERENCES[r].replace("$", r"\$")), REFERENCES, text)


def currency_of(code: Column, sign: Column) -> Column:
    """By code or sign."""
    return F.coalesce(*[F.when((code == name) | F.contains(F.lit(signs), sign), name) for name, signs in SIGNS.items()])


def tokens(text: Column) -> Column:
    """``label, code, sign, currency, digits, fraction`` of every number of a text, in order: what stands
    right before it, null where nothing does. Labels are in lower case, with single spaces."""
    clean = decoded(text)
    part = lambda k: F.transform(F.regexp_extract_all(clean, F.lit(TOKEN), k), lambda x: F.nullif(x, F.lit("")))
    fields = F.arrays_zip(*[part(k).alias(n) for k, n in enumerate(("label", "code", "sign", "digits", "fraction"), 1)])

    def token(t: Column) -> Column:
        label = F.regexp_replace(F.lower(t["label"]), r"(?<=[a-z])\s*price$", " price")
        code = F.upper(t["code"])
        return F.struct(label.alias("label"), code.alias("code"), t["sign"].alias("sign"), currency_of(code, t["sign"]).alias("currency"), F.replace(t["digits"], F.lit(","), F.lit("")).alias("digits"), t["fraction"].alias("fraction"))

    return F.transform(fields, token)


def infer_currency(text: Column) -> Column:
    """The first of dollar, euro, pound and won that a text names, by code or sign."""
    clean = decoded(text)
    words = F.split(F.upper(clean), "[^A-Z0-9_]+")
    named = lambda code: reduce(lambda a, s: a | F.contains(clean, F.lit(s)), SIGNS[code], F.array_contains(words, code))
    return F.coalesce(*[F.when(named(code), code) for code in SIGNS])


def _currency(text: Column, hint: str | None) -> Column:
    return F.lit(hint) if hint else F.coalesce(infer_currency(text), F.lit("KRW"))


def amount(token: Column, currency: Column) -> Column:
    """A token's amount, null if it isn't plausible: won have four digits or more and no fraction."""
    won = F.when(F.length(token["digits"]) >= 4, token["digits"].try_cast("double"))
    other = F.concat(token["digits"], F.coalesce(token["fraction"], F.lit(""))).try_cast("double")
    value = F.when(currency == "KRW", won).otherwise(other)
    return F.when((value > 0) & ((currency != "KRW") | (value >= LEAST_WON)), value)


def _first(found: Column, currency: Column) -> Column:
    return F.get(F.filter(F.transform(found, lambda t: amount(t, currency)), lambda x: x.isNotNull()), 0)


def price_candidate(text: Column, hint: str | None = "KRW") -> Column:
    """The amount that a text most likely means, null if there is none. In won the number with
    the surest label or sign counts, or a bare one if it is the whole text and the currency is
    given; in others the first one with their sign, or any if the currency is given."""
    currency, found = _currency(text, hint), tokens(text)

    def doubt(t: Column) -> Column:
        ends = lambda word: F.endswith(t["label"], F.lit(word))
        by_label = F.when(t["label"] == SURE[0], 0).when(t["label"] == SURE[1], 1).when(ends(SURE[2]), 2)
        bare = F.lit(bool(hint)) & (F.replace(decoded(text), F.lit(","), F.lit("")) == F.concat(t["digits"], F.coalesce(t["fraction"], F.lit("")))) & F.coalesce(t["fraction"] == ".00", F.lit(True))
        return F.coalesce(by_label, F.when(F.contains(F.lit(SIGNS["KRW"]), t["sign"]), 3), F.when(t["code"] == "KRW", 4), F.when(bare, 5))

    plausible = F.filter(found, lambda t: amount(t, F.lit("KRW")).isNotNull())
    ranked = F.transform(plausible, lambda t, k: F.struct(doubt(t).alias("doubt"), k.alias("place"), amount(t, F.lit("KRW")).alias("amount")))
    won = F.array_min(F.filter(ranked, lambda r: r["doubt"].isNotNull()))["amount"]
    own = F.get(F.filter(found, lambda t: t["currency"] == currency), 0)
    token = F.coalesce(own, F.get(found, 0)) if hint else own
    return F.when(currency == "KRW", won).otherwise(amount(token, currency))


def labelled_price(text: Column, role: str, hint: str | None = "KRW") -> Column:
    """The amount after a label of ``role``, ``sale`` or ``original``, whose sign, if any, is the currency's."""
    currency = _currency(text, hint)
    labels = F.array(*map(F.lit, SALE if role == "sale" else ORIGINAL))
    said = F.filter(tokens(text), lambda t: F.array_contains(labels, t["label"]) & F.coalesce(t["currency"] == currency, F.lit(True)))
    return _first(said, currency)


def price_candidates(text: Column, hint: str | None = "KRW") -> Column:
    """All plausible amounts of a text, in order: numbers with the currency's sign, in won also those with a sure label."""
    currency = _currency(text, hint)
    sure = lambda t: reduce(lambda a, w: a | F.endswith(t["label"], F.lit(w)), SURE, F.lit(False))
    signed = lambda t: F.when(currency == "KRW", F.contains(F.lit(SIGNS["KRW"]), t["sign"])).otherwise(t["currency"] == currency)
    counted = F.filter(tokens(text), lambda t: F.coalesce(signed(t), F.lit(False)) | F.coalesce((currency == "KRW") & sure(t), F.lit(False)))
    return F.filter(F.transform(F.coalesce(counted, F.array()), lambda t: amount(t, currency)), lambda x: x.isNotNull())


def is_price_like(text: Column) -> Column:
    """Is a text made of nothing but amounts, their signs and labels?"""
    words = "|".join([_ANY_LABEL, *SIGNS, _ANY_SIGN, "원"])
    digits = F.regexp_replace(text, rf"(?i)(?:{words})|[\s.,:：%+~/()\[\]-]", "")
    return F.coalesce(F.length(F.trim(text)).between(1, LONGEST) & F.rlike(digits, F.lit("^[0-9]+$")), F.lit(False))
