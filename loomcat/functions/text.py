"""Text functions over columns."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def ascii_word(pattern: str) -> str:
    """``pattern`` between ASCII word borders, whatever letters of other scripts stand beside it."""
    return rf"(?<![A-Za-z0-9_])(?:{pattern})(?![A-Za-z0-9_])"


def fold_compatible(text: Column) -> Column:
    """NFKD without combining marks; Spark has no Unicode normaliser."""

    @F.pandas_udf("string")
    def fold(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: x if x is None or x.isascii() else "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)))

    return fold(text)


def composed(text: Column) -> Column:
    """NFKC."""

    @F.pandas_udf("string")
    def compose(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFKC", x))

    return compose(text)


def match_form(text: Column) -> Column:
    """Decomposed without marks, lower case, ``_`` and ``-`` and runs of space as one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(F.translate(fold_compatible(text), "_-", "  ")), r"\s+", " "))


def entity_form(text: Column) -> Column:
    """NFKC, lower case, every run that is neither letter nor digit as one space."""
    return F.trim(F.regexp_replace(F.lower(composed(text)), r"[^\p{L}\p{N}]+", " "))


def identifier_form(text: Column) -> Column:
    return F.upper(F.regexp_replace(text, r"[^A-Za-z0-9]", ""))


def brand_form(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_replace(text, r"^\[[^\]]*\]\s*", "")), r"[^a-z0-9]", "")


def contains_any(text: Column, words: Sequence[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(text, F.lit(w))
    return out


# Labels that pages put before a product's name.
NAME_LABELS = r"상품명|제품명|product\s*name|name|제조사|판매가|브랜드|소비자가|적립금"


def clean_name(name: Column, labels: str = NAME_LABELS, passes: int = 3) -> Column:
    """White space as single spaces; leading labels with their colon dropped, at most ``passes`` times."""
    name = F.trim(F.regexp_replace(name, r"\s+", " "))
    for _ in range(passes):
        name = F.trim(F.regexp_replace(name, rf"(?i)^(?:{labels})\s*[:：]\s*", ""))
    return name


ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def strip_html(html: Column) -> Column:
    """Text without tags, common references decoded, white space as single spaces."""
    out = F.regexp_replace(html, r"(?s)<(script|style)[^>]*>.*?</(script|style)>", " ")
    out = F.regexp_replace(out, r"<[^>]*>", " ")
    for name, value in ENTITIES:
        out = F.replace(out, F.lit(name), F.lit(value))
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def html_attribute(html: Column, tag: str, attribute: str) -> Column:
    return F.nullif(F.regexp_extract(html, rf'<{tag}[^>]*\s{attribute}="([^"]*)"', 1), F.lit(""))


# Schemes of addresses and parts of names that messages must not give away.
SCHEMES = ("http", "https", "postgres", "postgresql")
CREDENTIALS = ("api key", "password", "secret", "token")
#: What an address is made of: the characters of RFC 3986 but the apostrophe, and letters and digits of any script.
ADDRESS = r"[\p{L}\p{N}\-._~:/?#\[\]@!$&()*+,;=%]+"


def safe_message(text: Column, most: int = 2000) -> Column:
    """Addresses, bearer tokens and the values of credentials hidden, then cut. A credential is a
    pair of name and value, with ``=`` or ``:`` between, whose name holds one of ``CREDENTIALS``."""
    names = "|".join(x.replace(" ", "[ _-]?") for x in CREDENTIALS)
    out = F.regexp_replace(text, rf"(?i)(?<![\p{{L}}\p{{N}}_])(?:{'|'.join(SCHEMES)})://{ADDRESS}", "[url]")
    out = F.regexp_replace(out, r"(?i)(?<![\p{L}\p{N}_])(bearer\s+)[^\s,;]+", "$1[hidden]")
    out = F.regexp_replace(out, rf"(?i)({names})([A-Za-z0-9_-]*)\s*[=:]\s*[^,;\s]+", "$1$2=[hidden]")
    return F.substring(out, 1, most)


# What reviewers say of themselves, after which labels, and the unit or the length of what they say.
BODY = {
    "height": (("키", "신장", "height"), "cm"),
    "weight": (("몸무게", "체중", "weight"), "kg"),
    "usual_size": (("평소 사이즈", "보통 사이즈", "usual size"), 10),
    "purchased_size": (("구매 사이즈", "선택 사이즈", "purchased size", "주문 사이즈"), 10),
    "body_type": (("체형", "body type"), 20),
}


def labelled_value(text: Column, labels: Sequence[str], kind: str | int) -> Column:
    """What follows the first of ``labels`` (spaces in them optional) and a colon or none: a number of
    two or three digits with the unit ``kind`` or none, or a line's text up to a comma, at most ``kind`` characters."""
    label = "|".join(x.replace(" ", r"\s*") for x in labels)
    value = rf"[0-9]{{2,3}}(?:\s*{kind})?" if isinstance(kind, str) else rf"[^,\n]{{1,{kind}}}"
    pattern = rf"(?i)(?:{label})\s*[:：]?\s*({value})"
    return F.when(F.rlike(text, F.lit(pattern)), F.trim(F.regexp_extract(text, pattern, 1)))


def body_info(text: Column) -> Column:
    """``height, weight, usual_size, purchased_size, body_type`` as texts; null if none is there."""
    found = {k: labelled_value(text, labels, kind) for k, (labels, kind) in BODY.items()}
    return F.when(F.coalesce(*found.values()).isNotNull(), F.struct(*[v.alias(k) for k, v in found.items()]))


def tokens(form: Column) -> Column:
    """The distinct words of a text in ``entity_form``."""
    return F.array_distinct(F.filter(F.split(form, " "), lambda x: x != ""))


def trigrams(text: Column) -> Column:
    """Distinct three-letter substrings; the whole text if it is shorter."""
    n = F.length(text)
    parts = F.transform(F.sequence(F.lit(1), F.greatest(n - 2, F.lit(1))), lambda i: F.substring(text, i, F.lit(3)))
    return F.when(n == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(parts))


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    total = F.size(F.array_union(a, b))
    return F.when(total == 0, F.lit(0.0)).otherwise(both.cast("double") / total)
