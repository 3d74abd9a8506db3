"""Links of stored web pages."""

from pyspark.sql import functions as F

from quizloom.operators import links
from quizloom.plans.catalog.registry import query, table

# The test pages hold no PDF links, so every link is taken.
LINKS_SQL = """
    WITH m AS (
        SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) AS root,
            regexp_extract_all(html, '(?is)<a\\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 1) AS hrefs,
            regexp_extract_all(html, '(?is)<a\\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 2) AS texts
        FROM pages),
    l AS (
        SELECT page_id, root, unnest(range(len(hrefs)))::int AS pos, unnest(texts) AS text,
            unnest(hrefs) AS href FROM m)
"""


def page_links(spark, sf_dir):
    return links.with_links(table(spark, sf_dir, "pages"), needle="")


@query(LINKS_SQL + "SELECT page_id, pos, trim(text) AS text, href FROM l")
def link_extract(spark, sf_dir):
    return links.link_rows(page_links(spark, sf_dir)).drop("url")


@query(LINKS_SQL + "SELECT page_id, pos, trim(text) AS text, href FROM l")
def link_markup(spark, sf_dir):
    """The same links from harder markup: a quoted ``>``, repeated attributes, anchors in scripts and comments."""
    hidden = """concat('<!-- <a href="/no">x</a> > --><script>"<a href=/no>", 1 < 2, "</a>"</script>', html)"""
    harder = """replace(html_, '<a href="', '<a title="a > b" data-href=\\'/no\\' HREF=/first href="')"""
    pages = table(spark, sf_dir, "pages").withColumn("html_", F.expr(hidden))
    pages = pages.withColumn("html", F.expr(harder)).drop("html_")
    return links.link_rows(links.with_links(pages, needle="")).drop("url")


@query(
    LINKS_SQL
    + """SELECT page_id, pos, root || href AS url FROM l
    UNION ALL
    SELECT page_id, unnest(range(6))::int - 6, unnest(['https://other.org/' || page_id || '.pdf',
        root || '/docs/' || page_id || '.pdf', root || '/b/' || page_id || '.pdf?x=1#f',
        split_part(root, '//', 1) || '//cdn.org/' || page_id || '.pdf', root || '/?f=' || page_id || '.pdf',
        root || '/up.pdf'])
    FROM (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) AS root FROM pages)"""
)
def link_resolve(spark, sf_dir):
    """The pages' links, and six made from each page: absolute, relative, dots, other host, query, above the root.

    Those are picked by the default needle; the seventh isn't.
    """
    made = """concat('<a href="https://other.org/', page_id, '.pdf">1</a><a href="docs/', page_id, '.pdf">2</a>',
        '<a href="/a/../b/./', page_id, '.pdf?x=1#f">3</a><a href="//cdn.org/', page_id, '.pdf">4</a>',
        '<a href="?f=', page_id, '.pdf">5</a><a href="/../up.pdf">6</a><a href="/x.html">7</a>')"""
    own = links.link_rows(page_links(spark, sf_dir)).select("page_id", "pos", "url")
    crafted = table(spark, sf_dir, "pages").withColumn("html", F.expr(made))
    rows = links.link_rows(links.with_links(crafted))
    return own.unionByName(rows.select("page_id", (F.col("pos") - 6).alias("pos"), "url"))


@query(
    LINKS_SQL
    + """SELECT page_id,
        arg_min(root || href, pos) FILTER (WHERE lower(text) LIKE '%th%' OR lower(href) LIKE '%qu%')
            AS prova_url,
        coalesce(
            arg_min(root || href, pos) FILTER (WHERE lower(text) LIKE '%e%' AND lower(text) LIKE '%n%'
                AND lower(text) NOT LIKE '%d%' AND lower(text) NOT LIKE '%u%'),
            arg_min(root || href, pos) FILTER (WHERE lower(text) LIKE '%e%'
                AND lower(text) NOT LIKE '%t%' AND lower(text) NOT LIKE '%l%'))
            AS gabarito_url,
        count(*)::int AS total_links
    FROM l GROUP BY page_id"""
)
def link_classify(spark, sf_dir):
    """First exam link, first key link with its fallback, and the link count."""
    return links.classify_links(
        page_links(spark, sf_dir),
        exam_text="th",
        exam_href="qu",
        key_all=["e", "n"],
        key_none=["d", "u"],
        fallback_all=["e"],
        fallback_none=["t", "l"],
    )
