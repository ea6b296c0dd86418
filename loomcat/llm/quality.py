"""Quality classifier by a sparse rule ensemble.

1. Statistics of the whole text are Spark columns (``STATISTICS``).
2. A bounded sample of labelled rows (``SAMPLE``, by hash of the id) gives the training
   data; statistics are computed for these rows only and held by the driver.
3. Small trees, each fitted to what the ones before leave over on a random half of the
   rows, are cut into their paths; every path is a rule, a conjunction of thresholds.
4. Logistic regression with an absolute-value penalty keeps few rules.
5. The kept rules and weights are compiled into one column expression, so scoring all
   rows is a narrow projection without shuffle or Python.

Defined results: a null text counts as empty; an empty text has the statistics 0 and is
scored like any other; repeated rows are scored alike; rows without an id are scored but
never learnt from (``held_out`` false); of several labels of an id the smallest counts,
and labels other than 0 and 1 are ignored; if one class or all labels are missing, the
smoothed share of label 1 is every row's score; an empty table gives an empty result;
very long texts are scored whole; columns other than id and text are ignored, whatever
their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SAMPLE = 20_000
THRESHOLD = 0.7
TREES, DEPTH, CUTS, SEED = 24, 3, 24, 7
PENALTY = 2e-3


def _share(part: Column, of: Column) -> Column:
    return F.when(of > 0, part.cast("double") / of).otherwise(F.lit(0.0))


def counts(text: str) -> list[dict[str, Column]]:
    """What is counted in a text column without nulls, in two steps."""
    words, lines = F.col("_word_list"), F.col("_line_list")
    count = lambda pattern: F.regexp_count(F.col(text), F.lit(pattern))
    blank = F.trim(F.col(text)) == ""
    return [
        {"_word_list": F.split(F.lower(F.col(text)), r"\s+"), "_line_list": F.split(F.col(text), "\n+")},
        {
            "_chars": F.length(text),
            "_words": F.when(blank, 0).otherwise(F.size(words)),
            "_distinct_words": F.when(blank, 0).otherwise(F.size(F.array_distinct(words))),
            "_lines": F.size(lines),
            "_distinct_lines": F.size(F.array_distinct(lines)),
            "_upper": count(r"[A-ZÀ-ÖØ-Þ]"),
            "_digits": count(r"[0-9]"),
            "_symbols": count(r"[^\p{L}\p{N}\s.,;:'\"()-]"),
            "_stops": count(r"[.?!](?=\s|$)"),
        },
    ]


def statistics() -> dict[str, Column]:
    """What the rules look at, from the counts."""
    c = F.col
    return {
        "words": c("_words").cast("double"),
        "repeated_words": F.when(c("_words") > 0, 1 - _share(c("_distinct_words"), c("_words"))).otherwise(F.lit(0.0)),
        "repeated_lines": F.when(c("_lines") > 0, 1 - _share(c("_distinct_lines"), c("_lines"))).otherwise(F.lit(0.0)),
        "word_length": _share(c("_chars"), c("_words")),
        "upper_share": _share(c("_upper"), c("_chars")),
        "digit_share": _share(c("_digits"), c("_chars")),
        "symbols_a_word": _share(c("_symbols"), c("_words")),
        "stops_a_word": _share(c("_stops"), c("_words")),
    }


STATISTICS = ("words", "repeated_words", "repeated_lines", "word_length", "upper_share", "digit_share", "symbols_a_word", "stops_a_word")


def with_statistics(docs: DataFrame, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` with the statistics, without its text unless that is to be kept."""
    out = docs.withColumn("_text", F.coalesce(F.col(text_col), F.lit("")))
    for step in counts("_text"):
        out = out.withColumns(step)
    kept = [F.col(x) for x in docs.columns if keep_text or x != text_col]
    return out.select(*kept, *[x.alias(k) for k, x in statistics().items()])


Condition = tuple[int, bool, float]  # statistic, is it above, threshold
Rule = tuple[Condition, ...]


def _split(x: np.ndarray, y: np.ndarray, cuts: list[np.ndarray], least: int) -> tuple[int, float] | None:
    """The threshold that lowers the squared error most."""
    best, found, total = 1e-9, None, y.sum()
    for f, thresholds in enumerate(cuts):
        if not len(thresholds):
            continue
        bucket = np.searchsorted(thresholds, x[:, f], "left")
        n = np.bincount(bucket, minlength=len(thresholds) + 1)[:-1].cumsum()
        s = np.bincount(bucket, y, minlength=len(thresholds) + 1)[:-1].cumsum()
        ok = (n >= least) & (len(y) - n >= least)
        gain = np.where(ok, s**2 / np.maximum(n, 1) + (total - s) ** 2 / np.maximum(len(y) - n, 1) - total**2 / len(y), 0)
        if gain.max() > best:
            best, found = gain.max(), (f, float(thresholds[gain.argmax()]))
    return found


def _grow(x: np.ndarray, y: np.ndarray, at: np.ndarray, cuts: list[np.ndarray], depth: int, path: Rule, rules: set[Rule], fit: np.ndarray, everyone: np.ndarray) -> None:
    if path:
        rules.add(path)
    found = _split(x[at], y[at], cuts, max(3, len(y) // 500)) if depth else None
    if found is None:
        fit[everyone] = y[at].mean()
        return
    f, t = found
    for above in (False, True):
        own, all_ = (x[i, f] > t if above else x[i, f] <= t for i in (at, everyone))
        merged = tuple(c for c in path if c[:2] != (f, above)) + ((f, above, t),)  # a later threshold of one kind is the stricter
        _grow(x, y, at[own], cuts, depth - 1, merged, rules, fit, everyone[all_])


def tree_rules(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> list[Rule]:
    cuts = []
    for f in range(x.shape[1]):
        values = np.unique(np.quantile(x[:, f], np.linspace(0, 1, CUTS + 2)))
        cuts.append(np.unique((values[1:] + values[:-1]) / 2))
    draw, rules, score = np.random.default_rng(seed), set(), np.full(len(y), y.mean())
    for _ in range(trees):
        half = np.sort(draw.choice(len(y), max(1, len(y) // 2), replace=False))
        fit = np.zeros(len(y))
        _grow(x, y - score, half, cuts, depth, (), rules, fit, np.arange(len(y)))
        score = score + 0.3 * fit
    return sorted(rules)


def holds(rules: list[Rule], x: np.ndarray) -> np.ndarray:
    out = np.ones((len(x), len(rules)), bool)
    for k, rule in enumerate(rules):
        for f, above, t in rule:
            out[:, k] &= x[:, f] > t if above else x[:, f] <= t
    return out


def sparse_logistic(z: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = 600) -> tuple[float, np.ndarray]:
    """Intercept and weights by accelerated proximal gradient steps."""
    centre, spread = z.mean(axis=0), np.maximum(z.std(axis=0), 0.05)
    a = (z - centre) / spread
    step = 4 / max(1e-9, np.linalg.eigvalsh(np.hstack([np.ones((len(a), 1)), a]).T @ np.hstack([np.ones((len(a), 1)), a]) / len(a))[-1])
    w = v = np.zeros(a.shape[1])
    b = c = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    momentum = 1.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-np.clip(c + a @ v, -40, 40))) - y
        new = v - step * (a.T @ error) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        new_b = c - step * error.mean()
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        v, c = new + (momentum - 1) / after * (new - w), new_b + (momentum - 1) / after * (new_b - b)
        w, b, momentum = new, new_b, after
    return float(b - (w * centre / spread).sum()), w / spread


@dataclass
class RuleModel:
    intercept: float
    rules: list[tuple[Rule, float]]

    def column(self) -> Column:
        """The score over columns named as in ``STATISTICS``."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            met = F.lit(True)
            for f, above, t in rule:
                met = met & (F.col(STATISTICS[f]) > t if above else F.col(STATISTICS[f]) <= t)
            total = total + F.when(met, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))

    def describe(self) -> list[str]:
        return [f"{w:+.3f} if " + " and ".join(f"{STATISTICS[f]} {'>' if above else '<='} {t:.4g}" for f, above, t in rule) for rule, w in self.rules]


def fit_rules(x: np.ndarray, y: np.ndarray) -> RuleModel:
    if not len(y) or y.min() == y.max():
        rate = (y.sum() + 1) / (len(y) + 2)
        return RuleModel(float(np.log(rate / (1 - rate))), [])
    rules = tree_rules(x, y)
    met, first = np.unique(holds(rules, x), axis=1, return_index=True)  # rules that hold for the same rows count once
    del met
    rules = [rules[i] for i in sorted(first)]
    intercept, weights = sparse_logistic(holds(rules, x).astype(float), y)
    return RuleModel(intercept, [(r, float(w)) for r, w in zip(rules, weights, strict=True) if w])


def is_held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> RuleModel:
    """The model from at most about ``sample`` labelled ids that aren't held out."""
    usable = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~is_held_out(id_col))
    one = usable.groupBy(F.col(id_col).alias("_label_id")).agg(F.min(label_col).alias("_label"))
    total = one.count()
    if total > sample:
        one = one.filter(F.pmod(F.xxhash64("_label_id"), F.lit(1 << 30)) < int(sample / total * (1 << 30)))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_doc"))
    # the sample has a bounded number of ids, so it may be broadcast at any input size
    labelled = texts.join(F.broadcast(one), F.col("_id") == F.col("_label_id")).select("_id", "_label", "_doc")
    rows = with_statistics(labelled, "_doc").groupBy("_id").agg(F.min("_label").alias("_label"), F.min(F.struct(*STATISTICS)).alias("s"))
    got = rows.select("_id", "_label", "s.*").orderBy("_id").toPandas()
    return fit_rules(got[list(STATISTICS)].to_numpy(float).reshape(-1, len(STATISTICS)), got["_label"].to_numpy(float))


def score(docs: DataFrame, model: RuleModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``id, held_out, score, predicted`` a row."""
    scored = with_statistics(docs.select(F.col(id_col), F.col(text_col)), text_col).select(id_col, is_held_out(id_col).alias("held_out"), model.column().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: RuleModel, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, their columns unchanged."""
    own = {f"_own{k}": c for k, c in enumerate(docs.columns)}  # no clash with the statistics' names
    text = f"_own{docs.columns.index(text_col)}"
    # a predicate isn't pushed below a projection with a row number, so the statistics are
    # computed once a row and not once for every rule that looks at them
    scored = with_statistics(docs.toDF(*own), text, keep_text=True).withColumns({"_score": model.column(), "_row": F.monotonically_increasing_id()})
    return scored.filter((F.col("_score") >= threshold) & (F.col("_row") >= 0)).select(*[F.col(k).alias(c) for k, c in own.items()])


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
