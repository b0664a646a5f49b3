"""Page evidence: extraction, lines that most pages of a host repeat, differencing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import web
from .ordering import broadcast_if_small, written

SHARE, LEAST_PAGES, MOST_CHARS = 0.45, 3, 40_000


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    h = F.col(html)
    return pages.withColumns({"title": web.title(h), "declared_lang": web.declared_language(h), "headings": web.headings(h), "main_text": web.page_text(h), "method": web.main_method(h)})


def chrome_lines(pages: DataFrame, group: str, text: str, page: str, share: float = SHARE, least: int = LEAST_PAGES) -> DataFrame:
    """(group, line, n_pages) of lines on at least `share` of a group's pages, each counted once a page."""
    sizes = pages.groupBy(group).agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= least)
    lines = pages.select(group, F.explode(F.array_distinct(F.split(text, "\n"))).alias("line")).where("line != ''")
    n = lines.groupBy(group, "line").agg(F.count(F.lit(1)).alias("n_pages"))
    return n.join(sizes, group).where(F.col("n_pages") >= share * F.col("pages")).select(group, "line", "n_pages")


def differenced(pages: DataFrame, group: str, text: str, page: str, method: str | None = None) -> DataFrame:
    """pages with main text without its group's repeated lines (order and repeats kept), capped, labelled.

    page is a key of pages; method, if given, is the column that names how the text was found. Lines meet the repeated
    ones by an anti-join on (group, line), so a host's lines are never gathered; only a page's own lines are. pages is
    written first: what finds its texts would run once for the lines, once for the repeated ones and once for the rows.
    """
    pages = written(pages)
    lines = pages.select(group, page, F.posexplode(F.split(text, "\n")).alias("_at", "_line"))
    chrome = written(chrome_lines(pages, group, text, page).select(group, F.col("line").alias("_line")))
    kept = lines.join(broadcast_if_small(chrome), [group, "_line"], "left_anti").groupBy(page).agg(F.sort_array(F.collect_list(F.struct("_at", "_line"))).alias("_kept"))
    joined = pages.withColumn("_text", F.col(text).isNotNull()).join(kept, page, "left").join(broadcast_if_small(written(chrome.select(group, F.lit(True).alias("_some")).distinct())), group, "left")
    own = F.col(method) if method else F.lit("FULL_BODY")
    label = F.when(F.col("_some").isNull(), own).when(own == "MAIN_ELEMENT", "MAIN_ELEMENT_AND_DIFFERENCED").otherwise("BOILERPLATE_DIFFERENCED")
    out = F.when(F.col("_text"), F.coalesce(F.array_join(F.transform("_kept", lambda x: x["_line"]), "\n"), F.lit("")))
    return joined.withColumns({"main_text": F.substring(out, 1, MOST_CHARS), "truncated": F.char_length(out) > MOST_CHARS, "method": label}).drop("_kept", "_some", "_text")


def eligibility(status: str = "http_status", kind: str = "content_type", size: str = "byte_count"):
    """The first reason against a fetched page, or null."""
    return (F.when(F.col(status).isNull(), "NO_RESPONSE").when(~F.col(status).between(200, 299), "HTTP_STATUS")
            .when(~web.is_html(F.col(kind)), "NOT_HTML").when(F.col(size) == 0, "EMPTY_BODY"))


def redirect_gaps(attempts: DataFrame, host: str, at: str) -> DataFrame:
    """Seconds since the host's attempt before: the pacing audit."""
    w = Window.partitionBy(host).orderBy(at)
    return attempts.withColumn("gap_s", F.col(at).cast("double") - F.lag(F.col(at).cast("double")).over(w))
