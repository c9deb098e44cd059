"""Operator 8: line deduplication by the frequency of a line within its site.

Pages are grouped by site (the host of their address). A line that stands on
more than ``RATIO`` of a site's pages is boilerplate there, unless it stands on
a single page (``MIN_PAGES`` is 2; callers may ask for more), and is dropped from all of the site's pages; the same line is
kept on sites where it is rare.

Each page offers a line once, as a digest, and counts are summed before the
shuffle, so neither a hot site nor a hot line gathers anywhere. A site has at
most (lines per page / ``RATIO``) boilerplate lines whatever its size, so they
travel as one array per site; the table of sites is broadcast while it has at
most ``BROADCAST_LINES`` lines, which is counted, and joined by shuffle beyond.

Lines are compared without white space at their ends; empty ones are neither
counted nor kept. Null or empty text: no lines. A null or unreadable site is no
site: its pages keep every line. Repeated rows count as pages of their own,
except with ``by_text``: then pages of a site with the same lines count as one,
above and below the fraction bar, so that copies cannot make a text boilerplate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeworks.loop import Workspace

RATIO = 0.1
MIN_PAGES = 2
BROADCAST_LINES = 50_000

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)"
_HIDDEN = r"(?is)<(?:script|style)\b.*?</(?:script|style)>|<!--.*?-->"
_BREAK = r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>"
_TAG = r"<[^>]*>"


def host(url: Column) -> Column:
    """The host of an address in lower case; null where there is none."""
    found = F.lower(F.regexp_extract(url, _HOST, 1))
    return F.when(found != "", found)


def html_lines(html: Column) -> Column:
    """The lines a page shows: one for each block, without tags, scripts and styles."""
    shown = F.regexp_replace(html, _HIDDEN, "")
    shown = F.regexp_replace(shown, _BREAK, "\n")
    return text_lines(F.regexp_replace(shown, _TAG, ""))


def text_lines(text: Column) -> Column:
    """Lines of a text, trimmed, without empty ones."""
    trimmed = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(" \t\r")))
    return F.filter(trimmed, lambda x: x != "")


def boilerplate(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, by_text: bool = False) -> DataFrame:
    """``(site, digest, n, total)`` of the boilerplate lines of pages ``(site, lines)``."""
    once = F.array_distinct(F.transform("lines", lambda x: F.md5(x)))
    sited = pages.filter(F.col("site").isNotNull()).select("site", "lines", once.alias("digests"))
    if by_text:
        whole = F.md5(F.array_join("lines", "\n")).alias("whole")
        sited = sited.select("site", whole, "digests").groupBy("site", "whole").agg(F.first("digests").alias("digests"))
    counts = sited.select("site", F.explode("digests").alias("digest")).groupBy("site", "digest").agg(F.count(F.lit(1)).alias("n"))
    totals = sited.groupBy("site").agg(F.count(F.lit(1)).alias("total"))
    return counts.filter(F.col("n") >= min_pages).join(totals, "site").filter(F.col("n") > F.col("total") * ratio)


def drop_boilerplate(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, by_text: bool = False) -> DataFrame:
    """``pages`` with ``lines`` and ``kept``, the lines that stay, in their order.

    Needs the columns ``site`` and ``lines``; every other column is kept, but
    one named ``kept`` is replaced.
    """
    found = boilerplate(pages.select("site", "lines"), ratio, min_pages, by_text)
    name = next(x for x in (f"dropped_{k}" for k in range(len(pages.columns) + 1)) if x not in pages.columns)
    # Written, so that what was counted is what is joined, and is found once.
    per_site, seen = Workspace(pages.sparkSession).keep(
        found.groupBy("site").agg(F.collect_list("digest").alias(name)), "boilerplate", lines=F.sum(F.size(name)))
    few = (seen.get("lines") or 0) <= BROADCAST_LINES
    joined = pages.join(F.broadcast(per_site) if few else per_site, "site", "left")
    kept = F.when(F.col(name).isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda x: ~F.array_contains(F.col(name), F.md5(x))))
    return joined.withColumn("kept", kept).drop(name)


def page_report(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(page_id, site, n_lines, n_dropped, kept_sha256)`` of ``(page_id, url, html)``."""
    lined = pages.select("page_id", host(F.col("url")).alias("site"), html_lines(F.col("html")).alias("lines"))
    done = drop_boilerplate(lined, ratio, min_pages)
    return done.select(
        "page_id", "site", F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
        F.sha2(F.array_join("kept", "\n"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH lined AS (
  SELECT row_number() OVER () AS r, page_id,
    nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)', 1)), '') AS site,
    list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
      '(?is)<(?:script|style)\b.*?</(?:script|style)>|<!--.*?-->', '', 'g'),
      '(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>', chr(10), 'g'),
      '<[^>]*>', '', 'g'), chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))), lambda x: x <> '') AS lines
  FROM pages),
totals AS (SELECT site, count(*) AS total FROM lined WHERE site IS NOT NULL GROUP BY site),
counts AS (SELECT site, line, count(*) AS n
  FROM (SELECT site, unnest(list_distinct(lines)) AS line FROM lined WHERE site IS NOT NULL) GROUP BY site, line),
dropped AS (SELECT site, list(line) AS gone FROM counts JOIN totals USING (site)
  WHERE n >= 2 AND n > total * 0.1::DOUBLE GROUP BY site),
done AS (SELECT page_id, site, lines, CASE WHEN gone IS NULL THEN lines
    ELSE list_filter(lines, lambda x: NOT list_contains(gone, x)) END AS kept
  FROM lined LEFT JOIN dropped USING (site))
SELECT page_id, site, len(lines)::BIGINT AS n_lines, (len(lines) - len(kept))::BIGINT AS n_dropped,
  sha256(array_to_string(kept, chr(10))) AS kept_sha256
FROM done
"""
