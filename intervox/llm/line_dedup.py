"""Site-relative line dedup: lines that more than a given share of a host's pages contain are boilerplate.

A page's lines are the pieces of its HTML between block elements, without script, style and comments, with inline
tags removed and white space collapsed. Native DataFrame code throughout: pages are parsed once into a written table of
lines; each page sends the distinct hashes of its lines, which tasks combine before the shuffle, so a hot host or a very
common line is counts and no long group.

The flagged lines of one host number at most (distinct lines of its mean page) / ratio, because each of them is in
more than ratio of the pages. They travel to the pages by broadcast only where their counted total is within
BROADCAST_LINES, else by a sort-merge join whose skewed hosts Spark splits.

Defined cases: a null url or one without a host belongs to the host ''; null or empty html has no lines; pages of any
length are parsed whole; lines repeated in a page count once for it and are all dropped when flagged; a line in exactly
the ratio of the pages stays; repeated rows, and rows with null page_ids, are pages of their own; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Share of a host's pages beyond which a line is dropped, and the fewest pages that must contain it.
RATIO, MIN_PAGES = 0.3, 3
BROADCAST_LINES = 200_000

BLOCKS = "address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h1|h2|h3|h4|h5|h6|head|header|hr|html|li|main|meta|nav|ol|option|p|pre|section|select|table|tbody|td|textarea|tfoot|th|thead|title|tr|ul"
SPLIT = rf"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|</?(?:{BLOCKS})\b[^>]*>|[\r\n]+"
INLINE, BLANKS = r"<[^>]*>", r"[\x20\x09-\x0D]+"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def page_lines(html: F.Column) -> F.Column:
    pieces = F.split(F.coalesce(html, F.lit("")), SPLIT)
    pieces = F.transform(pieces, lambda x: F.trim(F.regexp_replace(F.when(F.contains(x, F.lit("<")), F.regexp_replace(x, INLINE, "")).otherwise(x), BLANKS, " ")))
    return F.array_remove(pieces, "")


def host_of(url: F.Column) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def parsed_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, host, lines of each page, written: parsing costs more than writing and reading the lines."""
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), page_lines(F.col(html_col)).alias("lines"))
    return written(rows, "pages")


def boilerplate(parsed: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, line, pages, host_pages) of parsed pages: hashes of the lines to drop, written to the shared folder."""
    lines = F.array_distinct(F.transform("lines", lambda x: F.xxhash64(x)))
    # null stands for the page itself: its count is the host's page total.
    seen = parsed.select("host", F.explode(F.concat(lines, F.array(F.lit(None).cast("long")))).alias("line"))
    counts = seen.groupBy("host", "line").agg(F.count("*").alias("pages"))
    counts = written(counts.where(F.col("line").isNull() | (F.col("pages") >= min_pages)), "lines")
    totals = counts.where("line is null").select("host", F.col("pages").alias("host_pages"))
    flagged = counts.where("line is not null").join(totals.hint("merge"), "host")
    return written(flagged.where(F.col("pages") > F.lit(ratio) * F.col("host_pages")).select("host", "line", "pages", "host_pages"), "flagged")


def line_dedup(
    pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """page_id, host, n_lines, n_removed, text (kept lines joined by newlines): one row for each page."""
    parsed = parsed_pages(pages, id_col, url_col, html_col)
    flagged = boilerplate(parsed, ratio, min_pages)
    drops = flagged.groupBy("host").agg(F.collect_list("line").alias("drops"))
    if flagged.count() <= BROADCAST_LINES:
        drops = F.broadcast(drops)
    else:
        drops = written(drops, "drops").hint("merge")
    rows = parsed.join(drops, "host", "left")
    kept = F.when(F.col("drops").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x: ~F.array_contains("drops", F.xxhash64(x))))
    return rows.withColumn("kept", kept).select(
        "page_id",
        "host",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_removed"),
        F.array_join("kept", "\n").alias("text"),
    )
