"""Fields of web pages, by column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Named character references that catalogue pages use.
NAMED = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&middot;": "·", "&copy;": "©", "&amp;": "&"}


def unescaped(text: Column) -> Column:
    for name, char in NAMED.items():
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def plain(markup: Column) -> Column:
    """Text without tags, white space collapsed."""
    return F.trim(F.regexp_replace(unescaped(F.regexp_replace(markup, "<[^>]*>", "")), "[ \\t\\r\\n]+", " "))


def element(page: Column, tag: str) -> Column:
    """The markup in the first element of that name."""
    return F.regexp_extract(page, f"(?s)<{tag}[^>]*>(.*?)</{tag}>", 1)


def detail(pages: DataFrame, key: str, page: str) -> DataFrame:
    """key, title, heading, n_paragraphs, first_paragraph."""
    p = F.regexp_extract_all(page, F.lit("(?s)<p>([^<]+)</p>"), F.lit(1))
    return pages.select(key, plain(element(F.col(page), "title")).alias("title"), plain(element(F.col(page), "h1")).alias("heading"), F.size(p).cast("long").alias("n_paragraphs"), F.coalesce(plain(F.get(p, F.lit(0))), F.lit("")).alias("first_paragraph"))


def links(pages: DataFrame, key: str, page: str) -> DataFrame:
    """key, href, label of each link."""
    found = F.regexp_extract_all(page, F.lit('<a href="([^"]*)">[^<]*</a>'), F.lit(1))
    labels = F.regexp_extract_all(page, F.lit('<a href="[^"]*">([^<]*)</a>'), F.lit(1))
    return pages.select(key, F.explode(F.arrays_zip(found.alias("href"), labels.alias("label"))).alias("x")).select(key, F.col("x.href").alias("href"), unescaped(F.col("x.label")).alias("label"))


def without_variants(text: Column) -> Column:
    """Text without inline notes of other readings, in brackets."""
    return F.regexp_replace(text, "[（(][^（()）]*一作[^（()）]*[）)]", "")


def id_in(url: Column) -> Column:
    return F.regexp_extract(url, r"(?:_|/|=)([0-9a-f]{8,}|\d+)(?:\.aspx|\.html?|/)?(?:[?#].*)?$", 1)
