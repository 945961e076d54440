"""Extraction from the pages table, link operators and the flagship job."""

from __future__ import annotations

from pyspark.sql import functions as F

from wordloom import rules
from wordloom.functions import text as tx, tokenizers as tk
from wordloom.operators import ordering, pages as pg, vocabulary as vb
from wordloom.plans import sql
from wordloom.plans.registry import query
from wordloom.plans.text_queries import STOP_WORDS
from wordloom.sources.tables import table

_OPTIONS = {"stop_words": STOP_WORDS, "extra_letters": rules.LATIN_EXTRA}
_BODY = sql.body("html")
_TITLE = sql.nodes(r"regexp_extract(html, '(?is)<h1(?:\s[^>]*)?>(.*?)</h1\s*>', 1)", "")


def _pages(spark, d):
    return table(spark, d, "pages")


@query("page_title", f"SELECT page_id, {_TITLE} AS title FROM pages")
def page_title(spark, d):
    return pg.with_fields(_pages(spark, d), fields=["title"]).select("page_id", "title")


@query("page_strip_boilerplate", f"SELECT page_id, {_BODY} AS body FROM pages")
def page_strip_boilerplate(spark, d):
    return _pages(spark, d).select("page_id", pg.strip_boilerplate(F.col("html")).alias("body"))


@query("page_paragraphs", f"SELECT page_id, {sql.paragraphs(_BODY)} AS text FROM pages")
def page_paragraphs(spark, d):
    body = pg.strip_boilerplate(F.col("html"))
    return _pages(spark, d).select("page_id", pg.article_text(body).alias("text"))


# The pages carry no dates and no sections: marks computed from page_id are put in
# front of the html, one kind of mark per residue.
_EN = "January February March April May June July August September October November December".split()
_RU = "января февраля марта апреля мая июня июля августа сентября октября ноября декабря".split()


def _dated(spark, d):
    ts = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id") * 3661)
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    meta = '<meta property="article:published_time" content="%s">'
    month = lambda names: F.get(F.array(*[F.lit(n) for n in names]), F.month(ts) - 1)
    clock, day, year = F.date_format(ts, "HH:mm:ss"), F.dayofmonth(ts), F.year(ts)
    marks = [
        F.format_string(meta, iso),
        F.format_string('<meta itemprop="datePublished" content="soon"><time datetime="%s">x</time>', iso),
        F.format_string("<time>%s</time>", F.substring(iso, 1, 10)),
        F.format_string("<div>at %s UTC</div>", iso),
        F.lit(""),
        F.format_string(meta, F.concat(iso, F.lit("+05:00"))),
        F.format_string(meta, F.format_string("Tue, %02d %s %d %s GMT", day, F.substring(month(_EN), 1, 3), year, clock)),
        F.format_string("<time>%s</time>", F.format_string("%d %s %d г., %s МСК", day, month(_RU), year, F.substring(clock, 1, 5))),
        F.format_string("<time>%s</time>", F.format_string("%s %d, %d", month(_EN), day, year)),
        F.format_string(meta, F.format_string("%s 25:61 +0300", F.substring(iso, 1, 10))),
    ]
    mark = F.get(F.array(*marks), (F.col("page_id") % len(marks)).cast("int"))
    return _pages(spark, d).withColumn("html", F.concat(mark, "html"))


@query("page_date", """
    SELECT page_id, CASE page_id % 10 WHEN 2 THEN strftime(ts, '%Y-%m-%dT00:00:00') WHEN 4 THEN NULL
        WHEN 5 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S+05:00') WHEN 6 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00')
        WHEN 7 THEN strftime(ts, '%Y-%m-%dT%H:%M:00+03:00') WHEN 8 THEN strftime(ts, '%Y-%m-%dT00:00:00') WHEN 9 THEN NULL
        ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS date
    FROM (SELECT page_id, make_timestamp((1700000000 + page_id * 3661) * 1000000) AS ts FROM pages)""")
def page_date(spark, d):
    """Dates by priority (meta tag, time element, date in the text) and in several ways of writing."""
    out = pg.with_fields(_dated(spark, d), fields=["date"])
    return out.select("page_id", pg.iso_date(F.col("date_local"), F.col("date_zone")).alias("date"))


@query("page_category", """SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'Sport & Life ' || page_id
    WHEN 1 THEN 'Home / News ' || page_id WHEN 2 THEN 'Home News ' || page_id WHEN 3 THEN 'Home Shop A ' || page_id || ' B'
    END AS category FROM pages""")
def page_category(spark, d):
    """Sections as a meta tag, as breadcrumbs with elements of their own kind in them, unclosed, or absent."""
    marks = [
        '<meta content=" Sport &amp; Life %d" name="article:section">',
        '<div class="top breadcrumbs"><a href="/">Home</a> / <b>News %d</b></div>',
        '<div class=\'breadcrumb\'><div>Home</div><DIV><div>News %d</div></DIV></div><div>no</div>',
        '<ul class="breadcrumb"><li>Home<li>Shop<ul><li>A %d</li></ul><li>B</ul><ul><li>no</ul>',
        '<section class="breadcrumb"><section>never closed %d</section>',
        "<!-- %d -->",
    ]
    mark = F.get(F.array(*[F.format_string(m, F.col("page_id")) for m in marks]), (F.col("page_id") % len(marks)).cast("int"))
    marked = _pages(spark, d).withColumn("html", F.concat(mark, "html"))
    return pg.with_fields(marked, fields=["category"]).select("page_id", "category")


_ARTICLE_TEXT = sql.clean(sql.paragraphs(_BODY), STOP_WORDS, rules.LATIN_EXTRA)
ARTICLES = f"""(SELECT page_id, {_TITLE} AS title, {_ARTICLE_TEXT} AS text, NULL::VARCHAR AS date, url,
    NULL::VARCHAR AS category FROM pages)"""


def article_rows(spark, d):
    return pg.articles(_pages(spark, d), **_OPTIONS)


@query("articles", f"SELECT * FROM {ARTICLES} WHERE regexp_matches(text, '\\S')")
def articles(spark, d):
    return article_rows(spark, d).select("page_id", "title", "text", "date", "url", "category")


@query("edit_distance", f"""SELECT page_id, round(CASE WHEN greatest(length(a), length(b)) = 0 THEN 0.0
    ELSE levenshtein(a, b) / greatest(length(a), length(b)) END, 6) AS distance FROM (
    SELECT page_id, translate(t, u, v) AS a, translate(c, u, v) AS b FROM (
        SELECT page_id, {_TITLE} AS t, {sql.clean(_TITLE, STOP_WORDS)} AS c,
        'äöüßÄÖÜéèêàâçîïôûùëñóíáúÉÈÊÀÇÓÍÁÚÑ' AS u, '{"".join(chr(c) for c in range(14, 32)) + "{}|~^`@#$%&*_=+;:"}' AS v
        FROM pages))""")
def edit_distance(spark, d):
    """Title against its cleaned form. DuckDB compares bytes, so its side first maps
    the accented letters one to one to single-byte characters."""
    rows = pg.with_fields(_pages(spark, d), fields=["title"]).select("page_id", F.col("title").alias("a"))
    rows = rows.withColumn("b", tx.clean_text(F.col("a"), stop_words=STOP_WORDS))
    return rows.select("page_id", F.round(
        tx.normalized_edit_distance(F.col("a"), F.col("b")), 6).alias("distance"))


# --- links -----------------------------------------------------------------------------------------

_VISIBLE = sql.sub(sql.sub(sql.sub("html", "(?s)<!--.*?-->", " "), r"(?is)<script\b.*?</script\s*>", " "),
                   r"(?is)<style\b.*?</style\s*>", " ")
_HREFS = f"""(SELECT page_id, url, unnest(h) AS href, unnest(range(len(h)))::INT AS link_idx FROM (
    SELECT page_id, url, list_transform(regexp_extract_all({_VISIBLE}, '(?is)<a\\s[^>]*?href="([^"]*)"', 1),
        lambda x: {sql.entities('x')}) AS h FROM pages))"""
_LINKS = f"""(SELECT *, regexp_extract(url, '^(https?)://', 1) AS scheme,
    regexp_extract(url, '^https?://([^/?#]*)', 1) AS netloc,
    regexp_extract(href, '^([^?#]*)', 1) AS path,
    regexp_extract(url, '^(https?://[^/?#]*)', 1) || href AS link FROM {_HREFS})"""


@query("page_links", f"SELECT page_id, link_idx, href FROM {_HREFS}")
def page_links(spark, d):
    return pg.links(_pages(spark, d)).select("page_id", "link_idx", "href")


@query("links_resolved", f"SELECT page_id, link_idx, link FROM {_LINKS}")
def links_resolved(spark, d):
    return pg.resolved_links(_pages(spark, d)).select("page_id", "link_idx", "link")


@query("url_parts", r"""SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme,
    regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS netloc,
    regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages""")
def url_parts(spark, d):
    return _pages(spark, d).select("page_id", pg.url_parts(F.col("url")).alias("u")).select("page_id", "u.*")


@query("links_http", f"SELECT page_id, link_idx, link FROM {_LINKS} WHERE scheme IN ('http', 'https')")
def links_http(spark, d):
    out = pg.resolved_links(_pages(spark, d)).filter(pg.is_web(F.col("scheme")))
    return out.select("page_id", "link_idx", "link")


_SITE = "example.com"


@query("links_same_site", f"SELECT page_id, link_idx, link FROM {_LINKS} WHERE netloc LIKE '%{_SITE}%'")
def links_same_site(spark, d):
    out = pg.resolved_links(_pages(spark, d)).filter(pg.on_domain(F.col("netloc"), F.lit(_SITE)))
    return out.select("page_id", "link_idx", "link")


@query("links_no_media", f"""SELECT page_id, link_idx, link || ext AS link FROM (
    SELECT *, CASE page_id % 3 WHEN 0 THEN '.JPG' WHEN 1 THEN '.pdf?x=1' ELSE '' END AS ext FROM {_LINKS})
    WHERE ext = ''""")
def links_no_media(spark, d):
    """Two pages in three get a media ending on their links."""
    ext = F.when(F.col("page_id") % 3 == 0, ".JPG").when(F.col("page_id") % 3 == 1, ".pdf?x=1").otherwise("")
    found = pg.links(_pages(spark, d))
    out = found.withColumn("link", pg.resolve_url(F.col("url"), F.concat("href", ext)))
    path = pg.url_parts(F.col("link"))["path"]
    return out.filter(~pg.is_media(path)).select("page_id", "link_idx", "link")


@query("links_distinct", f"""SELECT link, page_id, link_idx FROM (SELECT *, row_number() OVER (
    PARTITION BY link ORDER BY page_id, link_idx) AS n FROM {_LINKS}) WHERE n = 1""")
def links_distinct(spark, d):
    """First occurrence of every link; links of two site groups are put together first."""
    com = pg.site_links(_pages(spark, d), F.lit(_SITE))
    found = pg.resolved_links(_pages(spark, d)).filter(
        pg.is_web(F.col("scheme")) & ~pg.on_domain(F.col("netloc"), F.lit(_SITE)) & ~pg.is_media(F.col("path")))
    return ordering.first_seen(com.unionByName(found), "link", "page_id", "link_idx")


# --- flagship ------------------------------------------------------------------------------------------

_TOP = 5


@query("flagship", f"""
    WITH a AS (SELECT page_id, url, text, len({sql.words('text')}) AS n FROM {ARTICLES}
        WHERE len({sql.words('text')}) >= {rules.ARTICLE_MIN_WORDS}),
    b AS (SELECT * FROM (SELECT *, sum(n) OVER (ORDER BY page_id) - n AS before FROM a)
        WHERE before < {rules.CORPUS_WORD_BUDGET}),
    t AS (SELECT regexp_extract(url, '^https?://([^/?#]*)', 1) AS site,
        unnest({sql.regex_words('text')}) AS token FROM b)
    SELECT site, token, cnt, rank FROM (SELECT *, row_number() OVER (
        PARTITION BY site ORDER BY cnt DESC, token)::BIGINT AS rank FROM (
        SELECT site, token, count(*)::BIGINT AS cnt FROM t GROUP BY site, token)) WHERE rank <= {_TOP}""")
def flagship(spark, d):
    """Pages to cleaned articles, long ones up to the word budget, top words by site."""
    found = pg.articles(_pages(spark, d), fields=False, **_OPTIONS)
    kept = ordering.budget_prefix(pg.long_articles(found), "page_id", F.col("n_words"), rules.CORPUS_WORD_BUDGET)
    kept = kept.withColumn("site", pg.url_parts(F.col("url"))["netloc"])
    counts = vb.token_counts(kept, tk.regex_words(F.col("text"), rules.LATIN_EXTRA), ["site"])
    return vb.top_tokens_by(counts, ["site"], _TOP)
