"""Parsers and rules by key, and parsers of payloads."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from json.decoder import scanstring
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shipping import ship


class ParserRegistry:
    """What to use for a key: functions of frames, or rules over columns."""

    def __init__(self) -> None:
        self._parsers: dict[str, Any] = {}

    def register(self, key: str, parser: Any) -> None:
        if key in self._parsers:
            raise ValueError(f"{key} is registered already")
        self._parsers[key] = parser

    def has(self, key: str) -> bool:
        return key in self._parsers

    def keys(self) -> list[str]:
        return sorted(self._parsers)

    def resolve(self, key: str) -> Any:
        if key not in self._parsers:
            raise KeyError(f"no parser {key}; there are {', '.join(self.keys())}")
        return self._parsers[key]


def detail_fields(text: Column, label: str = "material", code_label: str = "code") -> Column:
    """``material, product_code`` of a detail text: the composition after its label, else the
    first bare one."""
    composition = r"((?:[a-z]+ \d{1,3}%(?:, )?)+)"
    labelled = F.regexp_extract(F.lower(text), rf"{label}\s*:\s*{composition}", 1)
    bare = F.regexp_extract(F.lower(text), composition, 1)
    code = F.regexp_extract(text, rf"(?i){code_label}\s*:\s*([A-Za-z0-9-]+)", 1)
    none = F.lit("")
    return F.struct(F.coalesce(F.nullif(labelled, none), F.nullif(bare, none)).alias("material"), F.nullif(code, none).alias("product_code"))


def list_entry(price: Column, original: Column) -> Column:
    """``price, original, on_sale`` of a list entry whose numbers are texts; null without a price."""
    number = lambda c: F.regexp_replace(c, r"[^0-9.]", "").try_cast("double")
    p, o = number(price), F.coalesce(number(original), number(price))
    return F.when(p.isNotNull(), F.struct(p.alias("price"), o.alias("original"), (p < o).alias("on_sale")))


def grade_price(prices: Column, *grades: str) -> Column:
    """The price of the first grade that a map has."""
    return F.coalesce(*[F.try_element_at(prices, F.lit(g)) for g in grades])


def rates_per_unit(payload: Column, needed: tuple[str, ...] = ("KRW", "USD", "EUR")) -> Column:
    """KRW a unit of every currency of a rate payload; null unless all ``needed`` are there."""
    parsed = F.from_json(payload, "struct<base_code: string, rates: map<string, double>>")
    rates = parsed["rates"]
    krw = F.try_element_at(rates, F.lit("KRW"))
    whole = F.lit(True)
    for code in needed:
        whole = whole & F.coalesce(F.try_element_at(rates, F.lit(code)) > 0, F.lit(False))
    return F.when(whole, F.transform_values(rates, lambda _, v: krw / v))


_JSON_TOKEN = re.compile(r"[ \t\n\r]*(?:(?P<mark>[{}\[\],:])|(?P<string>\")|(?P<word>-?Infinity|NaN|true|false|null|-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?))")


def deep_json(text: str) -> Any:
    """What a JSON text of any depth holds, read without recursion; ValueError if it is none."""
    root: list = []
    stack: list[list | dict] = [root]
    keys: list[str] = [""]
    wanted, at = {"value"}, 0

    def put(value: Any) -> None:
        if isinstance(stack[-1], list):
            stack[-1].append(value)
        else:
            stack[-1][keys[-1]] = value

    def follows() -> set[str]:
        return {"end"} if len(stack) == 1 else {",", "]" if isinstance(stack[-1], list) else "}"}

    while m := _JSON_TOKEN.match(text, at):
        at = m.end()
        mark = m["mark"]
        if m["string"]:
            value, at = scanstring(text, at)
            if "key" in wanted:
                keys[-1], wanted = value, {":"}
                continue
        elif m["word"]:
            value = json.loads(m["word"])
        elif mark in ("{", "["):
            if "value" not in wanted:
                raise ValueError(f"no JSON at {at}")
            inner: list | dict = {} if mark == "{" else []
            put(inner)
            stack.append(inner)
            keys.append("")
            wanted = {"key", "}"} if mark == "{" else {"value", "]"}
            continue
        else:
            if mark not in wanted:
                raise ValueError(f"no JSON at {at}")
            if mark in "}]":
                stack.pop()
                keys.pop()
                wanted = follows()
            else:
                wanted = {"value"} if mark == ":" or isinstance(stack[-1], list) else {"key"}
            continue
        if "value" not in wanted:
            raise ValueError(f"no JSON at {at}")
        put(value)
        wanted = follows()
    if wanted != {"end"} or text[at:].strip(" \t\n\r"):
        raise ValueError(f"no JSON at {at}")
    return root[0]


def read_json(text: str) -> Any:
    try:
        return json.loads(text)
    except RecursionError:
        return deep_json(text)


def payload_objects(df: DataFrame, id_: str, payload: str) -> DataFrame:
    """Every object of a JSON payload, however deep, that has id, name and price:
    ``id_, object_id, name, price``. The shape is unknown, so a Pandas function descends. A
    payload that is no JSON has no objects."""
    ship(df.sparkSession)
    kind = df.schema[id_].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def found(root):
            waiting = [root]
            while waiting:
                node = waiting.pop()
                if isinstance(node, dict):
                    if {"id", "name", "price"} <= node.keys() and isinstance(node["price"], int | float):
                        yield str(node["id"]), str(node["name"]), float(node["price"])
                    waiting += reversed(node.values())
                elif isinstance(node, list):
                    waiting += reversed(node)

        for batch in batches:
            rows = []
            for i, text in zip(batch["_i"], batch["_p"], strict=True):
                try:
                    rows += [(i, *x) for x in found(read_json(text))] if text else []
                except ValueError:
                    continue
            yield pd.DataFrame(rows, columns=[id_, "object_id", "name", "price"])

    return df.select(F.col(id_).alias("_i"), F.col(payload).alias("_p")).mapInPandas(run, f"{id_} {kind}, object_id string, name string, price double")


def robots_rules(text: Column) -> Column:
    """The disallowed paths for all agents in a robots text."""
    block = F.regexp_extract(text, r"(?is)user-agent:\s*\*\s*\n(.*?)(?:\n\s*user-agent:|$)", 1)
    return F.regexp_extract_all(block, F.lit(r"(?im)^\s*disallow:\s*(\S+)"), 1)
