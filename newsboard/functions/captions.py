"""Text of digest, board and channel messages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from newsboard.functions.time import stamp

# Message formats.
CAPTION_TITLES = {
    "company_names": "*Companies and Organizations:* ",
    "topic_labels": "*XR Topics:* ",
    "categories": "*Market:* ",
}
LATEST_TITLE = ":new: *Latest 10 XR articles*"
TOP_TITLE = ":top: *Top XR news*"
BOARD_TITLES = {
    "companies": ":100: *Top Mentioned Companies in XR",
    "categories": ":100: *Top Mentioned Company Markets in XR",
    "category_groups": ":100: *Top Mentioned Company Submarkets in XR",
    "topics": ":100: *Top Mentioned XR Topics",
}


def byline(author: Column, site: Column) -> Column:
    return F.concat_ws(" - ", author, site)


def headline(url: Column, title: Column) -> Column:
    blank = lambda c: F.coalesce(c, F.lit(""))
    return F.concat(F.lit(":postbox: <"), blank(url), F.lit("|"), blank(title), F.lit(">"))


def names_of(names: Column) -> Column:
    """Sorted non-NULL names joined by `` - ``; NULL without a name."""
    kept = F.array_sort(F.array_compact(names))
    return F.when(F.size(kept) > 0, F.array_join(kept, " - "))


def caption(title: str, names: Column) -> Column:
    return F.concat(F.lit(title), names_of(names))


def captions(company_names: Column, topic_labels: Column, categories: Column) -> Column:
    """Array of the captions that have something to say."""
    lines = F.array(
        caption(CAPTION_TITLES["company_names"], company_names),
        caption(CAPTION_TITLES["topic_labels"], topic_labels),
        caption(CAPTION_TITLES["categories"], categories),
    )
    return F.array_compact(lines)


def bullets(sentences: Column) -> Column:
    """``* sentence`` paragraphs; NULL when no sentence has text."""
    lines = F.transform(
        sentences, lambda s: F.concat(F.lit("* "), F.coalesce(s, F.lit("")))
    )
    return F.when(
        F.exists(sentences, lambda s: s.isNotNull()), F.array_join(lines, "\n\n")
    )


def author_line(author: Column, site: Column, published: Column) -> Column:
    return F.concat(F.lit("*Author:* "), byline(author, site), F.lit(" on "), stamp(published))


def rank_line(rank: Column, name: Column, freq: Column) -> Column:
    return F.format_string("%2d | *%s* (%d)", rank, name, freq)
