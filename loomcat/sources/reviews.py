"""Reviews of products, from a table of pages: boards that list them, links to single ones, or
whichever of the two works. What a browser would visit is a join by address here.

``pages`` has ``url, html``; ``products`` has ``url``. Every parser gives two frames: ``reviews`` with
``url, place, author, date, text, photos, body`` and ``collections`` with ``url, review_count, status,
confirmed_empty, error``, a row a product. A page that is asked for and not there is a failure.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import body_info
from ..functions.urls import absolute
from ..scratch import materialise
from ..shipping import ship
from .page_tree import Page, bound, page_tree, select

# Where boards and their articles keep what.
BOARD, WRITE = "/board/product/list.html", r"/board/product/write\.html\?board_no=([0-9]+)&product_no=([0-9]+)"
COUNT = r"(?i)(?:리뷰|후기|review)\s*([0-9]+)"
BOARD_CONTENT = ".board_content, .view-content, .article-content, .entry-content, #bo_content"
ARTICLE_CONTENT = ".fr-view, .board_content, .view-content, .article-content, .entry-content"
ARTICLE_AUTHOR = ".board_view_info .name, .article-writer .name, .writer .name"
ARTICLE_META = ".board_view_info, .article-info, .view-info"
DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
LONGEST, PHOTOS = 1000, 5

REVIEW = "struct<author string, date string, text string, photos array<string>, detail string>"


class Reviews(NamedTuple):
    reviews: DataFrame
    collections: DataFrame


def _number(text: Column, pattern: str = "([0-9]+)") -> Column:
    return F.regexp_extract(text, pattern, 1).try_cast("long")


def _found(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 0), F.lit(""))


def _photos(page: Page, within: Column, selector: str) -> Column:
    sources = F.transform(select(page.nodes, selector, within), lambda i: page.attribute(page.node(i), "src"))
    return F.slice(F.array_distinct(F.filter(sources, lambda s: F.startswith(s, F.lit("http")))), 1, PHOTOS)


def board_link(page: Page) -> Column:
    """``board, count, observed``: the board that a product page links to, and how many reviews it says there are."""
    link = lambda i: bound(page.node(i), lambda n: F.struct(F.coalesce(page.attribute(n, "href"), F.lit("")).alias("href"), page.text(n).alias("text")))

    def read(links: Column) -> Column:
        first = lambda test: F.get(F.filter(links, test), 0)
        listed = first(lambda a: F.contains(a["href"], F.lit(BOARD)) & F.contains(a["href"], F.lit("link_product_no")))
        tab = first(lambda a: F.rlike(a["text"], F.lit(COUNT)))
        write = first(lambda a: F.rlike(a["href"], F.lit(WRITE)))["href"]
        own, told = _number(listed["text"]), _number(tab["text"], COUNT)
        made = F.concat(F.lit(f"{BOARD}?board_no="), F.regexp_extract(write, WRITE, 1), F.lit("&link_product_no="), F.regexp_extract(write, WRITE, 2))
        use_tab = F.coalesce(own, F.lit(0)) == 0
        board = F.coalesce(listed["href"], F.when(use_tab & F.contains(tab["href"], F.lit("board")), tab["href"]), made)
        count = F.coalesce(F.when(~use_tab, own), told, F.lit(0))
        return F.struct(board.alias("board"), count.alias("count"), (own.isNotNull() | told.isNotNull()).alias("observed"))

    return bound(F.transform(select(page.nodes, "a"), link), read)


def board_rows(page: Page) -> Column:
    """The reviews that a board's table lists, as ``REVIEW``."""

    def row(i: Column) -> Column:
        return bound(page.node(i), cells)

    def cells(tr: Column) -> Column:
        return bound(select(page.nodes, "td", tr), lambda tds: F.when(F.size(tds) >= 3, entry(tr, tds)))

    def entry(tr: Column, tds: Column) -> Column:
        writers = F.transform(select(page.nodes, 'td[class*="writer"]', tr), page.node)
        last = lambda values: F.element_at(F.filter(F.concat(F.array(F.lit(None).cast("string")), values), lambda x: x.isNotNull()), -1)
        named = F.transform(writers, lambda td: page.text_of(".name", td))
        dated = F.transform(writers, lambda td: _found(page.text(td), DATE))
        known = lambda values: F.when(F.exists(values, lambda x: x.isNotNull()), last(values))
        comment = page.first(".comment", tr)
        link = page.first('a[href*="/article/"]', comment)
        flat = lambda t: F.trim(F.regexp_replace(t, r"\s+", " "))
        said = F.coalesce(F.nullif(F.when(link.isNotNull(), page.text(link)).otherwise(flat(page.text(comment))), F.lit("")), flat(page.text(page.node(F.get(tds, 2)))))
        fields = F.struct(known(named).alias("author"), known(dated).alias("date"), F.substring(said, 1, LONGEST).alias("text"), _photos(page, tr, 'img[src*="review"], img[src*="board"]').alias("photos"), page.attribute(link, "href").alias("detail"))
        return bound(fields, lambda f: F.when(f["author"].isNotNull() | (F.length(f["text"]) > 5), f.cast(REVIEW)))

    return F.array_compact(F.transform(select(page.nodes, "table tr"), row))


def _visited(pages: DataFrame, asked: Column, by: DataFrame) -> DataFrame:
    """``url, tree`` of the pages that ``asked`` of ``by`` names: one an address (of several the greatest html), read once however many ask for it."""
    ship(pages.sparkSession)
    wanted = by.select(asked.alias("url")).filter("url is not null").distinct()
    return pages.join(wanted, "url", "left_semi").groupBy("url").agg(F.max("html").alias("html")).select("url", page_tree(F.col("html")).alias("tree"))


def _outcome(failures: Column, empty: Column, error: str) -> list[Column]:
    return [F.when(failures == 0, "succeeded").otherwise("partial").alias("status"), empty.alias("confirmed_empty"), F.when(failures > 0, F.concat(failures, F.lit(error))).alias("error")]


def board_reviews(products: DataFrame, pages: DataFrame, most: int) -> Reviews:
    """Reviews that a board lists, at most ``most`` a product, with what their own pages add: the
    whole text and what reviewers say of themselves."""
    visited, link = _visited(pages, F.col("url"), products), F.col("link")
    own = products.select("url").distinct().join(visited.select("url", board_link(Page(F.col("tree"))).alias("link")), "url", "left")
    own = materialise(own.select("url", absolute(link["board"], F.col("url")).alias("board"), F.coalesce(link["count"], F.lit(0)).alias("count"), F.coalesce(link["observed"], F.lit(False)).alias("observed")), "board-links")
    visited = _visited(pages, F.col("board"), own)
    boards = own.join(visited.select(F.col("url").alias("board"), board_rows(Page(F.col("tree"))).alias("rows")), "board", "left")
    boards = materialise(boards.withColumn("rows", F.slice("rows", 1, most)), "boards")
    listed = boards.select("url", "board", F.posexplode("rows").alias("place", "row")).withColumn("detail", absolute(F.col("row.detail"), F.col("board")))
    page, visited = Page(F.col("tree")), _visited(pages, F.col("detail"), listed)
    read = visited.select(F.col("url").alias("detail"), F.lit(True).alias("there"), body_info(F.col("tree.text")).alias("body"), F.substring(page.text_of(BOARD_CONTENT), 1, LONGEST).alias("content"))
    joined = listed.join(read, "detail", "left")
    reviews = joined.select(
        "url", "place", "row.author", "row.date", F.when(F.length("content") > F.length("row.text"), F.col("content")).otherwise(F.col("row.text")).alias("text"), "row.photos", "body", (F.col("detail").isNotNull() & F.col("there").isNull()).alias("failed"),
    )
    reviews = materialise(reviews, "board-reviews")
    counts = reviews.groupBy("url").agg(F.count("*").alias("n"), F.count_if("failed").alias("failures"))
    all_ = boards.select("url", "board", "count", "observed", F.col("rows").isNotNull().alias("there")).join(counts, "url", "left").fillna(0, ["n", "failures"])
    empty = (F.col("failures") == 0) & F.col("observed") & (F.col("count") == 0) & (F.col("n") == 0)
    problem = (
        F.when(F.col("board").isNull(), "review board source not found").when(~F.rlike("board", F.lit("^https?://")), "invalid review board URL").when(~F.col("there"), "review board parsing failed")
        .when((F.col("failures") == 0) & ~empty & (F.col("n") == 0), "review board returned no authoritative count or rows")
    )
    status, confirmed, error = _outcome(F.col("failures"), empty, " review detail(s) failed")
    collections = all_.withColumn("problem", problem).select(
        "url", F.when(F.col("count") == 0, F.col("n")).otherwise(F.col("count")).alias("review_count"), F.when(F.col("problem").isNotNull(), "failed").otherwise(status).alias("status"), (F.col("problem").isNull() & confirmed).alias("confirmed_empty"), F.coalesce("problem", error).alias("error"),
    )
    return Reviews(reviews.drop("failed"), collections)


def inline_reviews(products: DataFrame, pages: DataFrame, most: int) -> Reviews:
    """Reviews with pages of their own that a product page links to, the first ``most`` different links."""
    page = Page(F.col("tree"))
    hrefs = F.array_distinct(F.transform(select(page.nodes, 'a[href*="/article/review/"]'), lambda i: page.attribute(page.node(i), "href")))
    linked = _visited(pages, F.col("url"), products).select("url", F.slice(hrefs, 1, most).alias("hrefs"))
    own = materialise(products.select("url").distinct().join(linked, "url", "left"), "inline-links")
    listed = own.select("url", F.posexplode("hrefs").alias("place", "href")).withColumn("detail", absolute(F.col("href"), F.col("url")))
    content, meta = page.first(ARTICLE_CONTENT), page.text_of(ARTICLE_META)
    said = F.coalesce(page.text(content), F.lit(""))
    read = _visited(pages, F.col("detail"), listed).select(
        F.col("url").alias("detail"), F.lit(True).alias("there"), page.text_of(ARTICLE_AUTHOR).alias("author"), _found(F.coalesce(meta, said), DATE).alias("date"),
        F.substring(said, 1, LONGEST).alias("text"), F.coalesce(_photos(page, content, "img"), F.array().cast("array<string>")).alias("photos"), body_info(said).alias("body"),
    )
    joined = materialise(listed.join(read, "detail", "left").withColumn("failed", F.col("there").isNull()), "inline-reviews")
    reviews = joined.filter((F.length("text") > 3) | F.col("author").isNotNull()).select("url", "place", "author", "date", "text", "photos", "body")
    failures = joined.groupBy("url").agg(F.count_if("failed").alias("failures"))
    counted = own.join(failures, "url", "left").join(reviews.groupBy("url").agg(F.count("*").alias("n")), "url", "left").fillna(0, ["n", "failures"])
    nothing = F.coalesce(F.size("hrefs"), F.lit(0)) <= 0
    status, confirmed, error = _outcome(F.col("failures"), F.lit(False), " inline review detail(s) failed")
    collections = counted.select("url", F.col("n").alias("review_count"), F.when(nothing, "failed").otherwise(status).alias("status"), confirmed, F.when(nothing, "inline review source not found").otherwise(error).alias("error"))
    return Reviews(reviews, collections)


def no_reviews(products: DataFrame) -> Reviews:
    """Reviews that nobody asks for."""
    kind = "url string, place int, author string, date string, text string, photos array<string>, body struct<height string, weight string, usual_size string, purchased_size string, body_type string>"
    collections = products.select("url").distinct().select("url", F.lit(0).cast("long").alias("review_count"), F.lit("not_requested").alias("status"), F.lit(False).alias("confirmed_empty"), F.lit(None).cast("string").alias("error"))
    return Reviews(products.sparkSession.createDataFrame([], kind), collections)


def first_useful(*attempts: Reviews) -> Reviews:
    """For every product the first attempt that succeeded (or was not asked for), else the first partial one,
    else a failure with all errors."""
    rank = F.when(F.col("status").isin("succeeded", "not_requested"), 0).when(F.col("status") == "partial", 1).otherwise(2)
    tried = None
    for k, attempt in enumerate(attempts):
        one = attempt.collections.withColumns({"rank": rank, "attempt": F.lit(k)})
        tried = one if tried is None else tried.unionByName(one)
    best = tried.groupBy("url").agg(F.min_by(F.struct("review_count", "status", "confirmed_empty", "error", "attempt"), F.struct("rank", "attempt")).alias("b"), F.array_sort(F.collect_list(F.when(F.col("error").isNotNull(), F.struct("attempt", "error")))).alias("errors"))
    failed = F.col("b.status") == "failed"
    errors = F.array_join(F.transform("errors", lambda e: e["error"]), "; ")
    chosen = materialise(best.select("url", F.when(failed, 0).otherwise(F.col("b.review_count")).alias("review_count"), "b.status", (~failed & F.col("b.confirmed_empty")).alias("confirmed_empty"), F.when(failed, F.coalesce(F.nullif(errors, F.lit("")), F.lit("no review strategy succeeded"))).otherwise(F.col("b.error")).alias("error"), "b.attempt"), "reviews-chosen")
    reviews = None
    for k, attempt in enumerate(attempts):
        one = attempt.reviews.join(chosen.filter((F.col("attempt") == k) & (F.col("status") != "failed")).select("url"), "url", "left_semi")
        reviews = one if reviews is None else reviews.unionByName(one)
    return Reviews(reviews, chosen.drop("attempt"))
