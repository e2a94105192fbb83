"""The main content of pages: blocks by their density of text and links, without what a site repeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .retrieval import small
from .stages import cut

# Tags that end a block of text.
BLOCK_TAGS = "address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h1|h2|h3|h4|h5|h6|header|hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul"
#: Words of a block at least, the greatest share of its characters in links, and what makes it a site's boilerplate: on so many pages and on such a share of them.
LEAST_WORDS, LINK_SHARE, REPEATS, REPEAT_SHARE = 5, 1 / 3, 3, 0.1


def blocks(html: Column) -> Column:
    """Array of (text, words, link_chars) of the blocks between block tags, in order, white space squeezed, empty ones left out.

    Scripts, styles, comments and the head go; text in links counts as link_chars. Other tags vanish.
    """
    plain = F.regexp_replace(F.coalesce(html, F.lit("")), "[\\x01\\x02]", " ")
    plain = F.regexp_replace(plain, r"(?is)<(?:script|style|head)\b[^>]*>.*?</(?:script|style|head)>|<!--.*?-->", " ")
    plain = F.regexp_replace(plain, rf"(?i)</?(?:{BLOCK_TAGS})\b[^>]*>", "\n")
    plain = F.regexp_replace(plain, r"(?i)<a\b[^>]*>", "\x01")
    plain = F.regexp_replace(F.regexp_replace(plain, r"(?i)</a\s*>", "\x02"), r"<[^>]+>", " ")
    squeezed = lambda c: F.trim(F.regexp_replace(c, r"[\s\x01\x02]+", " "))

    def block(part):
        text = squeezed(part)
        outside = squeezed(F.regexp_replace(part, "\x01[^\x01\x02]*\x02", " "))
        return F.struct(text.alias("text"), F.when(text == "", 0).otherwise(F.size(F.split(text, " "))).alias("words"), (F.length(text) - F.length(outside)).alias("link_chars"))

    return F.filter(F.transform(F.split(plain, "\n"), block), lambda b: b["text"] != "")


def site_of(url: Column) -> Column:
    """The host, lower-cased, without www or m."""
    return F.regexp_replace(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z]+://([^/?#]*)", 1)), r"^(?:www|m)\.", "")


def main_content(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, n_blocks, n_kept, main): the blocks of each page that are text, joined by line ends.

    A block is kept if it has ``LEAST_WORDS`` words, no more than ``LINK_SHARE`` of its characters in links, and is not
    on ``REPEATS`` pages or more and ``REPEAT_SHARE`` or more of its site's. Pages without blocks have an empty main;
    rows that repeat an id are pages of their own.
    """
    rows = pages.select(F.col(id_col).alias("id"), site_of(F.col(url_col)).alias("site"), blocks(F.col(html_col)).alias("blocks"), F.xxhash64(id_col, url_col, html_col).alias("page"))
    rows = cut(rows)
    dense = lambda b: (b["words"] >= LEAST_WORDS) & (b["link_chars"] <= LINK_SHARE * F.length(b["text"]))
    texts = F.array_distinct(F.transform(F.filter("blocks", dense), lambda b: F.xxhash64(b["text"])))
    sites = rows.groupBy("site").agg(F.count(F.lit(1)).alias("pages"))
    often = rows.select("site", F.explode(texts).alias("hash")).groupBy("site", "hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= REPEATS)
    often = often.join(sites, "site").where(F.col("n") >= REPEAT_SHARE * F.col("pages")).groupBy("site").agg(F.collect_set("hash").alias("often"))
    told = rows.join(small(often), "site", "left")
    kept = F.filter("blocks", lambda b: dense(b) & ~F.array_contains(F.coalesce("often", F.array().cast("array<bigint>")), F.xxhash64(b["text"])))
    return told.withColumn("kept", kept).select(F.col("id").alias(id_col), F.size("blocks").alias("n_blocks"), F.size("kept").alias("n_kept"), F.array_join("kept.text", "\n").alias("main"))
