"""Records from page markup."""

from pyspark.sql import functions as F

from tabloom.operators import markup
from tabloom.queries.registry import Tables, query

CLEAN = r"regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', '', 'g')"


def text_sql(c: str) -> str:
    out = f"regexp_replace({c}, '(?s)<[^>]*>', '', 'g')"
    for e, ch in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")]:
        out = f"replace({out}, '{e}', '{ch}')"
    return rf"regexp_replace({out}, '^\s+|\s+$', '', 'g')"


@query(
    "h1_extract_cards",
    rf"""
    with b as (select page_id, regexp_split_to_array({CLEAN}, '(?i)<li\b[^>]*>') as parts from pages),
    u as (select page_id, unnest(range(2, len(parts) + 1)) as i, parts from b),
    c as (select page_id, (i - 2)::int as card, parts[i] as b from u)
    select page_id, card, {text_sql("regexp_extract(b, '(?is)<a[^>]*>(.*?)</a>', 1)")} as name,
      regexp_extract(b, '(?is)href="([^"]*)"', 1) as link, '' as price from c
    """,
)
def h1(t: Tables):
    fields = {"name": r"(?is)<a[^>]*>(.*?)</a>", "link": r'(?is)href="([^"]*)"', "price": r'(?is)<p class="price">(.*?)</p>'}
    return markup.extract_cards(t.dealt("pages"), "html", r"(?i)<li\b[^>]*>", fields, ["page_id"])


@query(
    "h1_extract_paragraph_cards",
    rf"""
    with b as (select page_id, regexp_split_to_array({CLEAN}, '(?i)<p\b[^>]*>') as parts from pages),
    u as (select page_id, unnest(range(2, len(parts) + 1)) as i, parts from b),
    c as (select page_id, (i - 2)::int as card, parts[i] as b from u)
    select page_id, card, md5({text_sql("regexp_extract(b, '(?is)<b>(.*?)(?:<br>|</p>)', 1)")}) as title,
      md5({text_sql("regexp_extract(b, '(?is)^(.*?)</p>', 1)")}) as body from c
    """,
)
def h1_paragraphs(t: Tables):
    fields = {"title": r"(?is)<b>(.*?)(?:<br>|</p>)", "body": r"(?is)^(.*?)</p>"}
    cards = markup.extract_cards(t.dealt("pages"), "html", r"(?i)<p\b[^>]*>", fields, ["page_id"])
    return cards.withColumns({c: F.md5(F.col(c).cast("binary")) for c in fields})


LINKS = rf"""
    select page_id, (i - 1)::int as pos, hrefs[i] as href, {text_sql("labels[i]")} as label from (
      select page_id, hrefs, labels, unnest(range(1, len(hrefs) + 1)) as i from (
        select page_id, regexp_extract_all({CLEAN}, '(?is)<a\b[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 1) as hrefs,
          regexp_extract_all({CLEAN}, '(?is)<a\b[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 2) as labels from pages))
"""


@query("h2_extract_links", LINKS)
def h2(t: Tables):
    return markup.extract_links(t.dealt("pages"), "html", ["page_id"])


@query("h2_links_by_label", f"select * from ({LINKS}) where label = 'la'")
def h2_label(t: Tables):
    return markup.extract_links(t.dealt("pages"), "html", ["page_id"], "la")


@query("h2_next_page", "select page_id, '/list?page=' || (page_id + 1) as next_href from pages")
def h2_next(t: Tables):
    link = F.concat(
        F.lit('<ul class="pagination"><li><a href="/list?page='), (F.col("page_id") + 1).cast("string"),
        F.lit('">&gt;</a></li><li><a href="/list?page=last">&gt;|</a></li></ul>'),
    )
    return markup.next_page(t.dealt("pages").withColumn("html", F.concat("html", link)), "html", "page_id")


def _spec_pages(t: Tables):
    row = lambda k, c: F.concat(F.lit(f'<tr class="row"><th>{k}</th><td> '), F.col(c).cast("string"), F.lit(" </td></tr>"))
    html = F.concat(
        F.lit("<div><script>var t='<table>';</script><table><caption>Main</caption>"), row("brand", "p_brand"), row("type", "p_type"),
        F.lit("</table><table class='x'><caption> Size </caption>"), row("size", "p_size"), F.lit("</table></div>"),
    )
    return t.part.select("p_partkey", html.alias("html"))


@query(
    "h3_extract_spec_table",
    """
    select p_partkey, 'Main' as caption, 'brand' as key, p_brand as value from part
    union all select p_partkey, 'Main', 'type', p_type from part union all select p_partkey, 'Size', 'size', p_size::varchar from part
    """,
)
def h3(t: Tables):
    return markup.extract_spec_table(_spec_pages(t), "html", ["p_partkey"])


@query("h3_spec_map", "select p_partkey, p_type as type, p_size::varchar as size from part")
def h3_map(t: Tables):
    specs = markup.spec_map(markup.extract_spec_table(_spec_pages(t), "html", ["p_partkey"]), "p_partkey")
    return specs.select("p_partkey", F.col("specs")["Main"]["type"].alias("type"), F.col("specs")["Size"]["size"].alias("size"))


@query(
    "h4_page_count",
    r"select page_id, coalesce(try_cast(nullif(regexp_extract(url, '[?&]page=(\d+)', 1), '') as int), 1) as pages from pages",
)
def h4(t: Tables):
    return markup.page_count(t.dealt("pages"), "url", r"[?&]page=(\d+)").select("page_id", "pages")


@query(
    "h5_first_by_key",
    """
    select event_id, user_id, event_type from (
      select *, row_number() over (partition by user_id, event_type order by ts, event_id) as rn from events) where rn = 1
    """,
)
def h5(t: Tables):
    keyed = t.events.withColumn("key", F.struct("user_id", "event_type"))
    return markup.first_by_key(keyed, "key", ["ts", "event_id"]).select("event_id", "user_id", "event_type")
