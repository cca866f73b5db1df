"""Records out of page tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.aggregate import distinct_by_key

# fixed values: what is never content
NOISE = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
ANCHOR = r'(?is)<a\b[^>]*?href="([^"]*)"[^>]*>(.*?)</a>'
TAG = r"(?s)<[^>]*>"


def visible(html: Column) -> Column:
    """Markup without scripts, styles and comments."""
    return F.regexp_replace(html, NOISE, "")


def inner_text(html: Column) -> Column:
    """Text between tags, the most common entities decoded, trimmed."""
    out = F.regexp_replace(html, TAG, "")
    # fixed values: basic entities; the ampersand is decoded last
    for entity, char in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.regexp_replace(out, r"^\s+|\s+$", "")


def extract_cards(
    pages: DataFrame, html: str, block: str, fields: Mapping[str, str], keep: Sequence[str] = ()
) -> DataFrame:
    """Repeated blocks of a page to rows; a field that is missing is ''.

    ``block`` is a pattern for the opening tag of a block; a block reaches to
    the next opening, so nested tags do no harm. Each field is a pattern whose
    first group is the value; tags inside it are removed.
    """
    parts = F.split(visible(F.col(html)), block)
    blocks = pages.select(*keep, F.posexplode(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))).alias("card", "_b"))
    return blocks.select(
        *keep, "card", *[inner_text(F.regexp_extract("_b", pattern, 1)).alias(n) for n, pattern in fields.items()]
    )


def extract_links(pages: DataFrame, html: str, keep: Sequence[str] = (), label: str | None = None) -> DataFrame:
    """Anchors as (position, href, text) rows; only those with the given text if asked."""
    body = visible(F.col(html))
    zipped = F.arrays_zip(
        F.regexp_extract_all(body, F.lit(ANCHOR), F.lit(1)).alias("href"),
        F.regexp_extract_all(body, F.lit(ANCHOR), F.lit(2)).alias("label"),
    )
    rows = pages.select(*keep, F.posexplode(zipped).alias("pos", "_a"))
    rows = rows.select(*keep, "pos", F.col("_a.href").alias("href"), inner_text(F.col("_a.label")).alias("label"))
    return rows if label is None else rows.filter(F.col("label") == label)


def next_page(pages: DataFrame, html: str, key: str, label: str = ">") -> DataFrame:
    """The first link of each page whose text is the label."""
    links = extract_links(pages, html, [key], label)
    return links.groupBy(key).agg(F.min_by("href", "pos").alias("next_href"))


def extract_spec_table(pages: DataFrame, html: str, keep: Sequence[str] = ()) -> DataFrame:
    """Captioned key/value tables to (caption, key, value) rows."""
    tables = F.regexp_extract_all(visible(F.col(html)), F.lit(r"(?is)<table\b[^>]*>(.*?)</table>"), F.lit(1))
    one = pages.select(*keep, F.explode(tables).alias("_t"))
    rows = one.select(
        *keep,
        inner_text(F.regexp_extract("_t", r"(?is)<caption\b[^>]*>(.*?)</caption>", 1)).alias("caption"),
        F.explode(F.regexp_extract_all("_t", F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))).alias("_r"),
    )
    return rows.select(
        *keep,
        "caption",
        inner_text(F.regexp_extract("_r", r"(?is)<th\b[^>]*>(.*?)</th>", 1)).alias("key"),
        inner_text(F.regexp_extract("_r", r"(?is)<td\b[^>]*>(.*?)</td>", 1)).alias("value"),
    ).filter(F.col("key") != "")


def spec_map(specs: DataFrame, page_key: str) -> DataFrame:
    """Spec rows of a page as a map caption → key → value; one page has few rows."""
    inner = specs.groupBy(page_key, "caption", "key").agg(F.max("value").alias("value"))
    tables = inner.groupBy(page_key, "caption").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "value")))).alias("m")
    )
    return tables.groupBy(page_key).agg(F.map_from_entries(F.collect_list(F.struct("caption", "m"))).alias("specs"))


def page_count(pages: DataFrame, html: str, pattern: str, out: str = "pages") -> DataFrame:
    """Whole number from the first group of a pattern; 1 where the page has none."""
    found = F.regexp_extract(F.col(html), pattern, 1).try_cast("int")
    return pages.withColumn(out, F.coalesce(found, F.lit(1)))


def first_by_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Records deduplicated by key, the first seen kept."""
    return distinct_by_key(df.filter(F.col(key).isNotNull()), key, order)
