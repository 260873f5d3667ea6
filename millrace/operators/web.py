"""Links, paragraphs and clean-up of stored web pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import strings
from millrace.operators.sets import first_occurrences, remove_matching, stack
from millrace.operators.windows import run_heads

# Headings that mark the paragraphs to keep.
HEADINGS = ("Overview", "Exports", "Imports", "Tariffs", "Ranking", "Description")
# Fixed value: links to service pages.
SERVICE_LINKS = r"^/(Special|index)"

_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>"
_HREF = r"""(?is)<a\s[^>]*?href\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)"""


def visible(html: Column) -> Column:
    """Markup without comments, scripts and style sheets."""
    return F.regexp_replace(html, _HIDDEN, "")


def extract_links(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per anchor with an address, numbered from 0 in page order."""
    found = F.regexp_extract_all(visible(F.col(html)), F.lit(_HREF), F.lit(1))
    return pages.select(key, F.posexplode(found).alias("pos", "href")).withColumn(
        "href", F.btrim("href", F.lit("\"'"))
    )


def matching_links(links: DataFrame, pattern: str, keys: Sequence[str], pos: str = "pos") -> DataFrame:
    """Links that match, each once per key at its first position."""
    return first_occurrences(links.filter(F.col("href").rlike(pattern)), [*keys, "href"], [pos])


def drop_service_links(links: DataFrame, pattern: str = SERVICE_LINKS) -> DataFrame:
    return remove_matching(links, "href", pattern)


def absolute_links(links: DataFrame, pages: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """Add the full address of each link, taking the site from its page."""
    sites = pages.select(key, strings.site_of(F.col(url)).alias("__site"))
    return links.join(sites, key).withColumn("url", strings.absolute_url(F.col("href"), F.col("__site"))).drop("__site")


def expand_links(links: DataFrame, seeds: DataFrame) -> DataFrame:
    """Links of the seed pages, and the links of those that were not seen on the first level.

    ``links`` has parent, pos and href, ``seeds`` parent and seed_pos. Each
    address appears once, at its first place on its level.
    """
    one = links.join(seeds, "parent").select("href", "seed_pos", F.col("pos").alias("pos1"))
    one = first_occurrences(one, ["href"], ["seed_pos", "pos1"])
    below = links.withColumnsRenamed({"parent": "__parent", "href": "child"})
    two = one.join(below, F.col("href") == F.col("__parent")).select(
        F.col("child").alias("href"), "seed_pos", "pos1", F.col("pos").alias("pos2")
    )
    two = first_occurrences(two, ["href"], ["seed_pos", "pos1", "pos2"]).join(one.select("href"), "href", "left_anti")
    return stack([one.withColumn("level", F.lit(1)), two.withColumn("level", F.lit(2))])


def contents_with_heads(links: DataFrame, keys: Sequence[str], pos: str, group: Column, head: Column) -> DataFrame:
    """Ordered contents with a head entry before each run of one group.

    Heads share the position of the entry they precede; ``kind`` 0 sorts them first.
    """
    marked = run_heads(links.withColumn("__g", group), keys, [pos], "__g", "__head")
    entries = F.array(
        F.when(F.col("__head") == 1, F.struct(F.lit(0).alias("kind"), head.alias("entry"))),
        F.struct(F.lit(1).alias("kind"), F.col("href").alias("entry")),
    )
    return marked.select(*keys, pos, F.explode(F.filter(entries, lambda e: e.isNotNull())).alias("e")).select(
        *keys, pos, "e.kind", "e.entry"
    )


def heading_paragraphs(
    pages: DataFrame, headings: Sequence[str] = HEADINGS, mark: str = "strong", key: str = "page_id", html: str = "html"
) -> DataFrame:
    """Paragraphs that hold ``<mark>Heading``, one row per heading held, tags stripped.

    A paragraph runs to its end tag or, where that is missing, to the next paragraph.
    """
    # A start tag may stand in for a missing end tag.
    cut = F.regexp_replace(visible(F.col(html)), r"(?i)<p\b", "</p><p")
    found = F.regexp_extract_all(cut, F.lit(r"(?is)<p\b[^>]*>.*?</p>"), F.lit(0))
    names = F.array(*[F.lit(h) for h in headings])
    rows = pages.select(key, F.posexplode(found).alias("pos", "__p"))
    held = F.filter(names, lambda h: F.contains(F.col("__p"), F.concat(F.lit(f"<{mark}>"), h)))
    return rows.select(key, "pos", F.explode(held).alias("heading"), strings.strip_tags(F.col("__p")).alias("text"))


def clean_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages with a charset declaration and without described images and link tags."""
    c = strings.drop_link_tags(strings.drop_images(strings.add_charset(F.col(html))))
    return pages.withColumn(html, c)
