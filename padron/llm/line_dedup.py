"""Line dedup by site-relative frequency.

Text lines of each page are counted by host: the share of the host's pages that hold a line
decides whether it is boilerplate of that site. DataFrame functions only.

Defined cases: null or empty HTML has no lines. Each row is a page of its own, repeated rows and
rows without page_id included, and has one row in the result. A URL that is null or has no host
belongs to the host "". Hosts with fewer than `min_pages` pages lose nothing: a share of two
pages says little. Lines are told apart by 64-bit hashes within a host.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.llm.texts import broadcast_if_small
from padron.session import materialise

#: Elements whose content is no text, dropped whole.
INVISIBLE = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->"
#: Tags that end a line; the others vanish within it.
BREAKS = (r"(?i)</?(address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head"
          r"|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>")
TAGS = r"<[^>]*>"
#: Fixed values of HTML.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&nbsp;": " ", "&amp;": "&"}


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(
        F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def text_lines(html: Column) -> Column:
    """Visible lines of a page: trimmed, inner white space single, without empty ones."""
    html = F.regexp_replace(F.coalesce(html, F.lit("")), INVISIBLE, "")
    html = F.regexp_replace(F.regexp_replace(html, BREAKS, "\n"), TAGS, "")
    for entity, char in ENTITIES.items():
        html = F.replace(html, F.lit(entity), F.lit(char))
    html = F.regexp_replace(html, r"[ \t\r\f\x0B]+", " ")
    return F.filter(F.transform(F.split(html, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def boilerplate(rows: DataFrame, max_ratio: float, min_pages: int) -> DataFrame:
    """Per host: the hashes of its boilerplate lines, of rows (host, lines).

    Only hashes are shuffled. A page contributes each of its lines once and counts are summed
    before the shuffle, so neither a large host nor a line on all pages gathers in a task. A
    host's list has at most 1/max_ratio times as many entries as its pages have lines on average.
    """
    totals = rows.groupBy("host").agg(F.count("*").alias("pages"))
    lines = rows.select("host", F.explode(F.transform(
        F.array_distinct("lines"), lambda x: F.xxhash64(x))).alias("line"))
    counts = lines.groupBy("host", "line").agg(F.count("*").alias("holding"))
    return counts.filter(F.col("holding") > 1).join(totals, "host").filter(
        (F.col("pages") >= min_pages) & (F.col("holding") > F.col("pages") * F.lit(max_ratio))
    ).groupBy("host").agg(F.collect_list("line").alias("common"))


def drop_boilerplate(pages: DataFrame, max_ratio: float = 0.25,
                     min_pages: int = 5) -> DataFrame:
    """Per page: page_id, host, n_lines, n_dropped, text (the lines that stay, by newline).

    A line goes if more than `max_ratio` of the pages of its host hold it. The lists of hosts are
    broadcast only if they are few; else pages are shuffled by host, and since each host has one
    list, adaptive execution can split a large host over tasks.
    """
    rows = materialise(pages.select(
        "page_id", host(F.col("url")).alias("host"), text_lines(F.col("html")).alias("lines")),
        "lines")
    common = broadcast_if_small(
        materialise(boilerplate(rows.select("host", "lines"), max_ratio, min_pages), "common"),
        2_000)
    stays = F.filter("lines", lambda x: F.coalesce(
        ~F.array_contains("common", F.xxhash64(x)), F.lit(True)))
    kept = rows.join(common, "host", "left").withColumn("kept", stays)
    return kept.select(
        "page_id", "host", F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
        F.array_join("kept", "\n").alias("text"))
