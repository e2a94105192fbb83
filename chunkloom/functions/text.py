"""Text expressions: canonical forms, tokens, sentences, and text from rows, HTML and tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


#: Texts of these characters alone are NFKC already: letters of Latin, Cyrillic and Han without composition marks.
STABLE = r"\x00-\x7F\xA1-\xA7\xA9\xAB\xAC\xAE\xB0\xB1\xB6\xB7\xBB\xBF-\u0131\u0134-\u013E\u0141-\u0148\u014A-\u017E\u0400-\u0481\u2013\u2014\u2018\u2019\u201C\u201D\u4E00-\u9FFF"


def nfkc(text: Column) -> Column:
    """Unicode NFKC. Only texts that it may change travel to Python; the others pass as nulls.

    A text of as many bytes as characters is ASCII. The rest is matched in one run from its start: looking for a
    character outside of these takes Java six times as long.
    """

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.str.normalize("NFKC")

    unstable = (F.octet_length(text) != F.length(text)) & ~text.rlike(rf"\A[{STABLE}]*+\z")
    return F.coalesce(run(F.when(unstable, text)), text)


def canonicalize(text: Column) -> Column:
    """NFKC; white space runs become one space; trimmed. Null is empty."""
    return squeezed(nfkc(text))


def squeezed(text: Column) -> Column:
    """``canonicalize`` for texts that are NFKC already, without Python."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))


def line_canonicalize(text: Column) -> Column:
    """NFKC; newlines as LF, no blanks at line ends, trimmed as a whole. Null is empty."""
    unix = F.regexp_replace(F.coalesce(nfkc(text), F.lit("")), r"\r\n?", "\n")
    return F.regexp_replace(F.regexp_replace(unix, r"[ \t]+(\n|$)", "$1"), r"^\s+|\s+$", "")


def reflow(text: Column) -> Column:
    """Drops ``(cid:n)`` marks, control characters become spaces, then canonical."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), r"\(cid:\d+\)", "")
    return squeezed(F.regexp_replace(plain, r"[\x00-\x1F\x7F]", " "))


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda t: t != "")


def token_count(text: Column) -> Column:
    return F.size(tokens(text)).cast("long")


def words(text: Column) -> Column:
    """Lower-cased runs of ASCII letters, digits and underscores."""
    # runs are matched themselves: Java takes ten times as long to split at what isn't one of these characters
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9_]+"), F.lit(0))


def sentences(text: Column) -> Column:
    """Parts that end in . ! or ? before white space."""
    marked = F.regexp_replace(squeezed(text), r"([.!?]) ", "$1\n")
    return F.filter(F.split(marked, "\n"), lambda s: s != "")


def row_to_text(columns: list[str]) -> Column:
    """``k: v | k: v`` with nulls as empty."""
    return F.concat_ws(" | ", *(F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns))


def html_to_text(html: Column) -> Column:
    """Without scripts, styles and tags, white space squeezed."""
    bare = html
    for tag in ("script", "style"):
        bare = F.regexp_replace(bare, rf"(?is)<{tag}[^>]*>.*?</{tag}>", " ")
    return squeezed(F.regexp_replace(bare, r"(?s)<[^>]+>", " "))


def html_title(html: Column) -> Column:
    return squeezed(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def html_markdown(html: Column) -> Column:
    """The main content as Markdown: navigation, forms and scripts dropped, headings and list items marked."""
    body = html
    for tag in ("script", "style", "nav", "header", "footer", "aside", "form", "title"):
        body = F.regexp_replace(body, rf"(?is)<{tag}\b[^>]*>.*?</{tag}>", " ")
    body = F.regexp_replace(F.regexp_replace(body, r"(?s)<!--.*?-->", " "), r"\s+", " ")
    for level in range(1, 7):
        body = F.regexp_replace(body, rf"(?is)<h{level}\b[^>]*>(.*?)</h{level}>", f"\n{'#' * level} $1\n")
    body = F.regexp_replace(body, r"(?is)<li\b[^>]*>", "\n- ")
    body = F.regexp_replace(body, r"(?is)</?(?:p|div|br|tr|table|ul|ol|section|article|main|body|html|head)\b[^>]*>", "\n")
    body = F.regexp_replace(F.regexp_replace(body, r"(?s)<[^>]+>", ""), r" *\n *", "\n")
    return F.regexp_replace(F.regexp_replace(body, r"\n{2,}", "\n\n"), r"^\s+|\s+$", "")


def decoded_tokens(tokens_: Column) -> Column:
    """Tokens as text again, one space between them."""
    return F.array_join(tokens_, " ")


def file_name(url: Column) -> Column:
    """Last part of the path, without query and fragment."""
    return F.element_at(F.split(F.regexp_replace(url, r"[?#].*$", ""), "/"), -1)


def extension(name: Column) -> Column:
    """Lower-cased extension without the dot; empty if there is none."""
    return F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)$", 1))


def detected_extension(key: Column, content_type: Column, said_name: Column) -> Column:
    """Extension of an object's %-decoded key, else of the file name its metadata say, else md or txt by its type; else empty."""
    path = F.try_url_decode(F.replace(F.regexp_replace(key, r"[?#].*$", ""), F.lit("+"), F.lit("%2B")))
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    aliased = lambda e: F.when(e.isin("markdown", "mdown"), "md").otherwise(e)
    own, said = extension(F.coalesce(path, key)), extension(F.coalesce(said_name, F.lit("")))
    return F.when(own != "", aliased(own)).when(said != "", aliased(said)).when(kind.contains("markdown"), "md").when(kind.startswith("text/"), "txt").otherwise("")


def clock(seconds: Column) -> Column:
    """``HH:MM:SS.mmm``; negative times are 0."""
    ms = F.round(F.greatest(seconds, F.lit(0.0)) * 1000).cast("long")
    return F.format_string("%02d:%02d:%02d.%03d", F.floor(ms / 3600000), F.floor(ms / 60000) % 60, F.floor(ms / 1000) % 60, ms % 1000)


def ocr_line_valid(line: Column, least_chars: int = 5, least_share: float = 0.6) -> Column:
    kept = F.length(F.regexp_replace(line, r"[^\p{L}\p{N}]", ""))
    return (F.length(line) >= least_chars) & (kept / F.greatest(F.length(line), F.lit(1)) >= least_share)


def text_valid(text: Column, more_than: int = 20) -> Column:
    return (F.length(text) > more_than) & text.rlike(r"\p{L}")


def table_valid(rows: Column) -> Column:
    """Two rows and columns at least, and letters in half of the cells."""
    cells = F.flatten(rows)
    lettered = F.size(F.filter(cells, lambda c: c.rlike(r"\p{L}")))
    return (F.size(rows) >= 2) & (F.array_max(F.transform(rows, F.size)) >= 2) & (lettered * 2 >= F.size(cells))


def table_markdown(rows: Column) -> Column:
    line = lambda r: F.concat(F.lit("| "), F.array_join(r, " | "), F.lit(" |"))
    rule = F.concat(F.lit("| "), F.array_join(F.transform(F.get(rows, F.lit(0)), lambda _: F.lit("---")), " | "), F.lit(" |"))
    return F.concat_ws("\n", line(F.get(rows, F.lit(0))), rule, F.array_join(F.transform(F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0))), line), "\n"))


def table_tsv(rows: Column) -> Column:
    return F.array_join(F.transform(rows, lambda r: F.array_join(r, "\t")), "\n")


def fix_hyphens(text: Column) -> Column:
    """A line that ends in a hyphen is glued to the next one."""
    return F.regexp_replace(text, r"-\n\s*", "")
