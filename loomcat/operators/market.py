"""Does a shop sell to a market? What its pages and price probes tell."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.urls import absolute, host, path
from ..sources.page_tree import Page, bound, select

# The market, its currency and languages, how many hours an open question waits, and what a probe is.
MARKET, CURRENCY, LANGUAGES = "kr", "KRW", ("en", "ko")
RETRY_HOURS = 24
MOST_LINKS = 5
PROBE = "struct<context string, storefront_url string, currency string, variant_price_count int, country_codes array<string>, status string>"


def _locale_segment(segment: Column) -> Column:
    """Is a part of a path the market, alone or with a language before or after it?"""
    names = [MARKET, *[f"{a}{sep}{b}" for lang in LANGUAGES for a, b, seps in ((lang, MARKET, "-_"), (MARKET, lang, "-_")) for sep in seps]]
    return F.lower(segment).isin(*names)


def is_localized(url: Column) -> Column:
    """Does an address name the market, in a part of its path or in a parameter on country, market, region or locale?"""
    segments = F.split(path(url), "/")
    pairs = F.split(F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1), "&")
    wanted = [MARKET, f"ko-{MARKET}", f"ko_{MARKET}"]
    names = lambda p: F.rlike(F.split(p, "=")[0], F.lit("(?i)(?:country|market|region|locale)$")) & F.regexp_extract(F.lower(F.get(F.split(p, "="), 1)), r"^(?:ko[-_])?[a-z]+", 0).isin(*wanted)
    there = F.exists(segments, _locale_segment) | F.exists(pairs, lambda p: F.coalesce(names(p), F.lit(False)))
    return F.coalesce(there, F.lit(False)) & host(url).isNotNull()


def localized_links(page: Page, url: Column) -> Column:
    """The shop's own pages for the market that a page links to, up to the part that names it, the first ``MOST_LINKS``."""
    hrefs = F.transform(select(page.nodes, "[href]"), lambda i: absolute(page.attribute(page.node(i), "href"), url))

    def front(u: Column) -> Column:
        segments = F.split(path(u), "/")
        at = F.get(F.filter(F.transform(segments, lambda s, k: F.when(_locale_segment(s), k)), lambda k: k.isNotNull()), 0)
        origin = F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)
        return F.when(at.isNotNull(), F.concat(origin, F.array_join(F.slice(segments, 1, at + 1), "/"))).otherwise(u)

    own = F.filter(hrefs, lambda u: F.coalesce(F.rlike(u, F.lit("(?i)^https?://")) & (host(u) == host(url)) & is_localized(u), F.lit(False)))
    return F.slice(F.array_distinct(F.transform(own, front)), 1, MOST_LINKS)


def market_countries(page: Page, html: Column) -> Column:
    """The countries that a page's selectors of country name: values of options, hidden fields and pairs in its scripts; none on
    a page that has no such selector."""
    code = lambda v: F.when(F.rlike(v, F.lit("^[A-Za-z]{2}$")), F.upper(v))
    capital = lambda v: F.when(F.rlike(v, F.lit("^[A-Z]{2}$")), v)
    value = lambda i: page.attribute(page.node(i), "value")
    options = F.transform(select(page.nodes, "option[value]"), lambda i: capital(value(i)))
    fields = F.transform(select(page.nodes, "input[name=country_code][value]"), lambda i: code(value(i)))
    quote = "[\"']"
    pairs = F.regexp_extract_all(html, F.lit(rf"{quote}(?:country|iso)_code{quote}\s*:\s*{quote}([A-Z][A-Z]){quote}"), 1)
    low = F.lower(html)
    speaks = F.contains(low, F.lit("localization")) | F.rlike(low, F.lit("country[-_]?(?:selector|code)"))
    none = F.array().cast("array<string>")
    return F.when(F.coalesce(speaks, F.lit(False)), F.array_distinct(F.array_compact(F.concat(options, fields, F.coalesce(pairs, none))))).otherwise(none)


def offer_currencies(data: Column) -> Column:
    """The currencies of the offers with a price inside products of a page's linked data, however deep, each once.
    The session's workers need the package: call ``shipping.ship``."""
    from ..sources.registry import read_json

    def offers(root) -> Iterator[str]:
        waiting = [(root, False)]
        while waiting:
            value, inside = waiting.pop()
            if isinstance(value, list):
                waiting += [(v, inside) for v in reversed(value)]
            elif isinstance(value, dict):
                kind = str(value.get("@type") or "").lower()
                inside = inside or kind == "product"
                currency = value.get("priceCurrency")
                if inside and kind == "offer" and isinstance(currency, str) and len(currency) == 3 and currency.isascii() and currency.isalpha():
                    try:
                        if 0 < float(value.get("price") if value.get("price") is not None else value.get("lowPrice")) < float("inf"):
                            yield currency.upper()
                    except (TypeError, ValueError):
                        pass
                waiting += [(v, inside) for v in reversed(value.values())]

    @F.pandas_udf("array<string>")
    def read(blocks: pd.Series) -> pd.Series:
        def one(texts) -> list[str]:
            found: dict[str, None] = {}
            for text in texts if texts is not None else ():
                try:
                    found |= dict.fromkeys(offers(read_json(text)))
                except ValueError:
                    continue
            return list(found)

        return blocks.map(one)

    return read(data)


def assess_market(probes: Column, origin: Column) -> Column:
    """``status, localization, shipping, currency, storefront_url, retry_hours`` from an array of ``PROBE``.

    A shop of the market's own country is ``eligible_origin``. Else prices in its currency count, together with a sign that they are
    for it: an address that names it, a shop that changes currency when asked, or a country list with it.
    One country alone may be the visitor's own, so only a list of two or more can exclude the market."""
    none = F.array().cast(f"array<{PROBE}>")
    known = F.coalesce(probes, none)
    own = MARKET.upper()

    def weighed(all_: Column) -> Column:
        good = F.filter(all_, lambda p: p["status"] == "ok")
        default = F.get(F.filter(good, lambda p: p["context"] == "default"), 0)
        priced = F.filter(good, lambda p: (p["currency"] == CURRENCY) & (p["variant_price_count"] > 0))
        best = F.coalesce(F.get(F.filter(priced, lambda p: p["context"] == "localized_url"), 0), F.get(priced, 0))
        countries = F.array_distinct(F.flatten(F.transform(all_, lambda p: F.coalesce(p["country_codes"], F.array().cast("array<string>")))))
        errors = (F.size(all_) > 0) & F.forall(all_, lambda p: p["status"] == "network_error")
        return F.struct(default.alias("default"), best.alias("best"), countries.alias("countries"), errors.alias("errors"))

    def decided(w: Column) -> Column:
        best, default = w["best"], w["default"]
        named, listed = F.array_contains(w["countries"], own), F.size(w["countries"]) >= 2
        sure = lambda c: F.coalesce(c, F.lit(False))
        changes = sure((best["context"] == "shopify_market") & (default["currency"] != CURRENCY))
        local = sure(is_localized(best["storefront_url"])) | changes | named
        shipping = F.when(named, "supported").when(listed, "unsupported").otherwise("unknown")
        status = (
            F.when(sure(F.upper(origin) == own), "eligible_origin").when(best.isNotNull() & local & (shipping != "unsupported"), "eligible_storefront").when(best.isNotNull(), "price_only")
            .when(shipping == "unsupported", "unsupported").when(w["errors"], "retryable_error").otherwise("inconclusive")
        )
        at_home = status == "eligible_origin"
        return F.struct(
            status.alias("status"),
            F.when(at_home | local, "supported").when(shipping == "unsupported", "unsupported").otherwise("unknown").alias("localization"),
            F.when(at_home, "unknown").otherwise(shipping).alias("shipping"),
            F.when(~at_home, F.coalesce(best["currency"], default["currency"])).alias("currency"),
            F.when(~at_home, best["storefront_url"]).alias("storefront_url"),
            F.when(status.isin("retryable_error", "inconclusive"), RETRY_HOURS).alias("retry_hours"),
        )

    return bound(bound(known, weighed), decided)
