"""Image selection: candidate tiers and suppression of overlapping boxes."""

from __future__ import annotations

import functools
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import discard, materialise


def overlap(a: Column, b: Column) -> Column:
    """Intersection over union of boxes ``x0, y0, x1, y1``."""
    side = lambda lo, hi: F.greatest(F.least(a[hi], b[hi]) - F.greatest(a[lo], b[lo]), F.lit(0.0))
    area = lambda c: (c["x1"] - c["x0"]) * (c["y1"] - c["y0"])
    both = side("x0", "x1") * side("y0", "y1")
    total = area(a) + area(b) - both
    return F.when(total > 0, both / total).otherwise(F.lit(0.0))


SIDES = ("x0", "y0", "x1", "y1")


#: An image with at most so many boxes is settled by itself; the boxes of those with more meet by cells.
FEW = 64


def _by_size(boxes: DataFrame, image: str) -> tuple[DataFrame, DataFrame]:
    """The boxes of images with at most ``FEW``, and of those with more. The large ones are written, so that they are
    counted once and, where they are not many, all boxes meet them without a shuffle."""
    large = materialise(boxes.groupBy(image).agg(F.count("*").alias("_n")).filter(F.col("_n") > FEW).select(image), "large")
    return boxes.join(large, image, "left_anti"), boxes.join(large, image, "left_semi")


def overlapping(nodes: DataFrame, image: str, limit: float, cell: float = 64.0) -> DataFrame:
    """``image, a, b``: the pairs ``a < b`` of boxes of an image that overlap by more than ``limit`` (above 0). ``nodes`` has
    ``image`` and ``node``, a struct with the box's sides that no other box of the image equals.

    Boxes meet by the cell of a grid in which their intersection begins. Grids of cells twice
    as wide at each level take boxes of any size: one lies in two cells of its level each way at most, and as
    boxes that overlap by ``limit`` differ by no more than that in width and height, it needs a few levels only."""
    deep = math.floor(math.log2(1 / limit)) + 1

    def axis(lo: str, hi: str) -> tuple[Column, Column]:
        """The level of a box along an axis, and its cells there and at the levels above that matter."""
        low, high = F.col(f"node.{lo}").cast("double"), F.col(f"node.{hi}").cast("double")
        own = F.greatest(F.ceil(F.log2((high - low) / cell)), F.lit(0)).cast("int")
        at = lambda level: F.transform(F.sequence(F.floor(low / _width(level, cell)), F.floor(high / _width(level, cell))), lambda c: F.struct(level.alias("level"), c.alias("cell")))
        return own, F.flatten(F.transform(F.sequence(own, own + deep), at))

    (ox, xs), (oy, ys) = axis("x0", "x1"), axis("y0", "y1")
    dealt = nodes.select(image, "node", ox.alias("ox"), oy.alias("oy"), F.explode(xs).alias("x"), ys.alias("_ys")).withColumn("y", F.explode("_ys"))
    side = lambda name: dealt.select(image, "x", "y", F.struct("node", "ox", "oy").alias(name))

    def meets(axis_: str, lo: str) -> Column:
        level = F.col(f"{axis_}.level")
        begin = F.greatest(F.col(f"a.node.{lo}"), F.col(f"b.node.{lo}")).cast("double")
        return (level == F.greatest(F.col(f"a.o{axis_}"), F.col(f"b.o{axis_}"))) & (F.col(f"{axis_}.cell") == F.floor(begin / _width(level, cell)))

    met = side("a").join(side("b"), [image, "x", "y"]).filter((F.col("a.node") < F.col("b.node")) & meets("x", "x0") & meets("y", "y0"))
    return met.filter(overlap(F.col("a.node"), F.col("b.node")) > limit).select(image, F.col("a.node").alias("a"), F.col("b.node").alias("b"))


def _width(level: Column, cell: float) -> Column:
    return F.lit(cell) * F.pow(F.lit(2.0), level)


def _has_area() -> Column:
    return (F.col("x1") > F.col("x0")) & (F.col("y1") > F.col("y0"))


def _pair_counts(boxes: DataFrame, key: str, limit: float) -> DataFrame:
    """``key, k``: how many pairs of rows of a key overlap. Equal boxes are counted, not paired."""
    nodes = boxes.filter(_has_area()).groupBy(key, *SIDES).agg(F.count("*").alias("n"))
    nodes = materialise(nodes.select(key, F.struct(*SIDES, "n").alias("node")), "boxes")
    product = lambda x, y: x.cast("decimal(20,0)") * y
    among = nodes.select(key, (product(F.col("node.n"), F.col("node.n") - 1) / 2).alias("k"))
    between = overlapping(nodes, key, limit).select(key, product(F.col("a.n"), F.col("b.n")).alias("k"))
    return among.union(between).groupBy(key).agg(F.sum("k").alias("k")).filter("k > 0")


def overlap_counts(boxes: DataFrame, image: str, limit: float) -> DataFrame:
    """``image, heavy``: how many pairs of an image's rows with different ``box`` overlap by more than ``limit`` (above 0, below 1).

    The rows of a small image meet each other; of a large one all pairs are counted less those of one ``box``."""
    few, many = _by_size(boxes.filter(_has_area()).filter(F.col(image).isNotNull() & F.col("box").isNotNull()).select(image, "box", *SIDES), image)
    side = lambda name: few.select(image, F.struct("box", *SIDES).alias(name))
    met = side("a").join(side("b"), image).filter((F.col("a.box") < F.col("b.box")) & (overlap(F.col("a"), F.col("b")) > limit))
    small = met.groupBy(image).agg(F.count("*").alias("heavy"))
    many = materialise(many, "large-images")
    all_ = _pair_counts(many, image, limit)
    same = _pair_counts(many.withColumn("_one", F.struct(F.col(image).alias("image"), "box")), "_one", limit)
    same = same.groupBy(F.col("_one.image").alias(image)).agg(F.sum("k").alias("_same"))
    return small.unionByName(all_.join(same, image, "left").select(image, (F.col("k") - F.coalesce("_same", F.lit(0))).cast("long").alias("heavy")).filter("heavy > 0"))


def _greedy(order: Column, beaten: Callable[[Column, Column], Column]) -> Column:
    """Those of an array, in order, that none kept before beats."""
    return F.aggregate(order, F.slice(order, 1, 0), lambda kept, x: F.when(beaten(kept, x), kept).otherwise(F.concat(kept, F.array(x))))


def suppress(boxes: DataFrame, image: str, limit: float, cell: float = 64.0) -> DataFrame:
    """``image, box`` of greedy suppression: of boxes of an image that overlap by more than
    ``limit`` (above 0) the one with the higher score stays (ties: the first ``box``).

    A small image is gone through in the order of its boxes. Of a large one, of equal boxes the best goes on alone. The others meet as in ``overlapping``. Then rounds: boxes
    that no better one overlaps stay, those that they overlap go. Each round settles at
    least the best box that is open, so they end."""
    best = F.min(F.struct((-F.col("score")).alias("order"), "box"))
    flat = boxes.filter(~F.coalesce(_has_area(), F.lit(False))).select(image, "box")  # these overlap nothing, not even equal ones
    few, many = _by_size(boxes.filter(_has_area()).select(image, "box", "score", *SIDES), image)
    order = F.struct((-F.col("score")).alias("order"), "box", *SIDES)
    # at most FEW boxes of an image
    beaten = lambda kept, box: F.exists(kept, lambda k: overlap(k, box) > limit)
    settled = few.groupBy(image).agg(F.array_sort(F.collect_list(order)).alias("_all")).select(image, F.explode(_greedy(F.col("_all"), beaten)).alias("_kept"))
    flat = flat.union(settled.select(image, "_kept.box"))
    many = materialise(many, "large-images")
    # a node is unique: its place in the order, and the place that no other node of the image has
    nodes = many.groupBy(image, *SIDES).agg(best.alias("best")).select(image, F.struct("best.order", "best.box", *SIDES).alias("node"))
    nodes = materialise(nodes, "boxes")
    edges = materialise(overlapping(nodes, image, limit, cell).select(image, F.col("a").alias("win"), F.col("b").alias("lose")), "overlaps")
    losers = []
    while not edges.isEmpty():
        beaten = edges.select(image, F.col("lose").alias("win")).distinct()
        gone = materialise(edges.join(beaten, [image, "win"], "left_anti").select(image, F.col("lose").alias("node")).distinct(), "suppressed")
        losers.append(gone)
        # a box that is gone beats none, and needs no further judgement
        left = edges.join(gone.withColumnRenamed("node", "win"), [image, "win"], "left_anti").join(gone.withColumnRenamed("node", "lose"), [image, "lose"], "left_anti")
        last, edges = edges, materialise(left, "overlaps")
        discard(boxes.sparkSession, last)
    out = nodes.join(functools.reduce(DataFrame.union, losers), [image, "node"], "left_anti") if losers else nodes
    return out.select(image, F.col("node.box").alias("box")).union(flat)


def needs_new_image(current: Column, width: Column, utility: Column, least: int = 400) -> Column:
    return current.isNull() | utility | F.coalesce(width < least, F.lit(True))
