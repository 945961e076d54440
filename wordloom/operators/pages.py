"""Extraction from raw pages: title, date, category, paragraphs, links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wordloom import rules
from wordloom.functions import text as tx
from wordloom.functions.text import bind, let

_ANY_TAG = "<[^>]*>"
# Stand for a tag between two text nodes, for a break between pieces, for null.
_NODE, _FIELD, _NULL = "\x01", "\x02", "\x03"


def drop_comments(html: Column) -> Column:
    return F.regexp_replace(html, "(?s)<!--.*?-->", " ")


def strip_boilerplate(html: Column) -> Column:
    """Remove comments and the elements that hold no article text, content included."""
    out = drop_comments(html)
    for tag in rules.BOILERPLATE_TAGS:
        out = F.regexp_replace(out, rf"(?is)<{tag}\b.*?</{tag}\s*>", " ")
    return out


def _marked(html: Column) -> Column:
    return F.regexp_replace(html, _ANY_TAG, _NODE)


def node_text(marked: Column, separator: str = " ") -> Column:
    """Text nodes of decoded text with marks for tags: each trimmed, empty ones
    dropped, joined."""
    nodes = F.transform(F.split(marked, _NODE), tx.trim_ws)
    return F.array_join(F.array_remove(nodes, ""), separator)


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of one tag, quotes removed; null when absent or empty."""
    raw = F.regexp_extract(
        tag, rf"(?is)[\s\"'/]{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", 1
    )
    return F.nullif(F.regexp_replace(raw, "^[\"']|[\"']$", ""), F.lit(""))


def _meta(html: Column, keys: str) -> Column:
    """Raw content of the first <meta> tag with one of the given key attributes."""
    return _attribute(F.regexp_extract(html, rf"(?is)<meta\s(?=[^>]*?\b(?:{keys}))[^>]*>", 0), "content")


def _key(attributes: list[str], value: str) -> str:
    names = "|".join(attributes)
    return rf"(?:{names})\s*=\s*(?:\"{value}\"|'{value}'|{value}(?=[\s/>]))"


def _element(html: Column, tag: str) -> Column:
    return F.regexp_extract(html, rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>", 1)


# The opening tag of an element of the breadcrumb class.
_CRUMB = (
    r"(?is)<([a-z][a-z0-9]*)\b[^>]*\bclass\s*=\s*(?:\"(?:[^\"]*\s)?breadcrumbs?(?:\s[^\"]*)?\""
    r"|'(?:[^']*\s)?breadcrumbs?(?:\s[^']*)?')[^>]*>"
)


def balanced(html: Column, opening: str) -> Column:
    """The first element whose opening tag matches, from that tag up to its own closing tag; null if there
    is none or it is never closed.

    ``opening`` is a pattern with the tag's name as its first group. The page is cut before every tag of
    that name, and a fold counts how deep each cut is: the element ends where the count is back at nought.
    """
    def element(page: Column) -> Column:
        rest = F.substr(page, F.regexp_instr(page, F.lit(opening)))
        name = F.regexp_extract(page, opening, 1)
        return let(F.split(rest, F.concat(F.lit("(?i)(?=</?"), name, F.lit("[\\s/>])"))), closed)

    def closed(parts: Column) -> Column:
        def step(state: Column, part: Column) -> Column:
            depth = state["depth"] + F.when(part.startswith("</"), -1).when(part.startswith("<"), 1).otherwise(0)
            return F.struct(
                depth.alias("depth"), (state["at"] + 1).alias("at"),
                F.coalesce(state["end"], F.when(depth == 0, state["at"])).alias("end"))

        start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("end"))
        end = F.aggregate(parts, start, step, lambda state: state["end"])
        return F.array_join(F.slice(parts, F.lit(1), end), "")

    return let(html, lambda page: F.when(F.rlike(page, F.lit(opening)), element(page)))


FIELDS = ("title", "date", "category")


def raw_fields(html: Column, body: Column, fields: Sequence[str] = FIELDS) -> Column:
    """The pieces of a page that the named fields are read from, still encoded, as one string: decoding
    then costs one call per page. Pieces of other fields aren't looked for."""
    page = drop_comments(html)
    when_has = lambda pattern, value: F.when(F.rlike(value, F.lit(pattern)), value)
    pieces = {
        "title": lambda: [
            _meta(page, _key(["property", "name"], "og:title")),
            _marked(_element(page, "h1")),
            _marked(_element(when_has(r"(?i)<title[\s>]", page), "title")),
        ],
        "date": lambda: [
            _meta(body, _key(["property", "name"], "article:published_time") + "|"
                  + _key(["itemprop"], "datePublished")),
            _attribute(F.regexp_extract(body, r"(?is)<time(?:\s[^>]*)?>", 0), "datetime"),
            _marked(_element(body, "time")),
            F.regexp_extract(F.regexp_replace(body, _ANY_TAG, " "), rules.ISO_DATE, 0),
        ],
        "category": lambda: [
            _meta(body, _key(["property", "name"], "article:section")),
            _marked(balanced(body, _CRUMB)),
        ],
    }
    return F.array_join(F.array(*[piece for f in FIELDS if f in fields for piece in pieces[f]()]), _FIELD, _NULL)


def parse_fields(decoded: Column, fields: Sequence[str] = FIELDS) -> Column:
    """The named fields of decoded :func:`raw_fields` as a struct; a date is ``(raw, local, zone)``."""
    sizes = {"title": 3, "date": 4, "category": 2}

    def build(parts: Column) -> Column:
        filled = lambda c: F.nullif(c, F.lit(""))
        first, out = 0, []
        for f in FIELDS:
            if f not in fields:
                continue
            part = lambda i, at=first: F.nullif(F.get(parts, F.lit(at + i)), F.lit(_NULL))
            first += sizes[f]
            if f == "title":
                # og:title, else the first <h1>, else <title>, else null
                out.append(F.coalesce(tx.trim_ws(part(0)), filled(node_text(part(1), "")), node_text(part(2), "")).alias(f))
            elif f == "date":
                candidates = F.array(tx.trim_ws(part(0)), F.coalesce(part(1), filled(node_text(part(2), ""))), filled(part(3)))
                dates = F.filter(
                    F.transform(candidates, lambda c: F.struct(c.alias("raw"), read_date(c).alias("when"))),
                    lambda d: d["when"]["local"].isNotNull())
                out.append(F.get(dates, F.lit(0)).alias(f))
            else:
                # article:section, else the text of the breadcrumb element, else null
                out.append(F.coalesce(tx.trim_ws(part(0)), node_text(part(1))).alias(f))
        return F.struct(*out)

    return let(F.split(decoded, _FIELD), build)


def with_fields(pages: DataFrame, html: str = "html", body: str | None = None, fields: Sequence[str] = FIELDS) -> DataFrame:
    """Add the named fields: ``title``, ``category``, and for the date ``date_raw``, ``date_local`` (as the page
    says it), ``date_zone`` (its offset from UTC, null where the page names none) and ``date_ts`` (the moment).

    The date comes from the meta tag, else the <time> element, else an ISO date in
    the text: the first that parses. Date and category are read after boilerplate
    removal, the title before it.
    """
    out = pages if body else bind(pages, "_body", strip_boilerplate(F.col(html)))
    out = tx.bind_unescaped(out, "_raw", raw_fields(F.col(html), F.col(body or "_body"), fields))
    out = bind(out, "_f", parse_fields(F.col("_raw"), fields))
    added = {f: F.col(f"_f.{f}") for f in ("title", "category") if f in fields}
    if "date" in fields:
        local, zone = F.col("_f.date.when.local"), F.col("_f.date.when.zone")
        added |= {
            "date_raw": F.col("_f.date.raw"), "date_local": local, "date_zone": zone,
            "date_ts": F.try_to_timestamp(F.concat(local, F.coalesce(zone, F.lit("+00:00"))), F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
        }
    return out.withColumns(added).drop("_raw", "_f", "_body")


_TIME = r"(?:[T,\s]+(?:(?:в|at)\s+)?(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,]\d+)?)?)?"
_ZONE = r"\s*(Z|[A-Za-zА-Яа-я]{2,4}|(?:GMT|UTC)?[+-]\d{2}:?\d{2})?"
_WEEKDAY = r"^(?:[A-Za-zА-Яа-яЁё]+\.?,?\s+)?"
_MONTH = r"([A-Za-zА-Яа-яЁё]{3,})\.?"
#: Ways to write a date, and where year, month, day, hour, minute, second and zone are in each.
_WRITTEN = (
    (r"^(\d{4})-(\d{2})-(\d{2})" + _TIME + _ZONE + "$", "$1|$2|$3|$4|$5|$6|$7"),
    (r"^(\d{1,2})[./](\d{1,2})[./](\d{4})" + _TIME + _ZONE + "$", "$3|$2|$1|$4|$5|$6|$7"),
    (_WEEKDAY + r"(\d{1,2})[.\s-]+" + _MONTH + r"[,\s-]+(\d{4})(?:\s*г(?:ода|\.)?)?" + _TIME + _ZONE + "$", "$3|$2|$1|$4|$5|$6|$7"),
    (_WEEKDAY + _MONTH + r"\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4})" + _TIME + _ZONE + "$", "$3|$1|$2|$4|$5|$6|$7"),
)


def read_date(raw: Column) -> Column:
    """struct(local, zone) of a written date, nulls if it is none.

    ``local`` is ``yyyy-MM-ddTHH:mm:ss`` as written, ``zone`` its offset such as ``+05:00``. Months may be
    numbers or English or Russian names, in full or short; zones offsets or common names. A date
    with a zone that is not known is no date.
    """
    def fields_of(text: Column) -> Column:
        found = F.lit(None).cast("string")
        for pattern, order in reversed(_WRITTEN):
            found = F.when(F.rlike(text, F.lit("(?iu)" + pattern)), F.regexp_replace(text, "(?iu)" + pattern, order)).otherwise(found)
        return F.split(found, r"\|")

    def build(f: Column) -> Column:
        part = lambda i: F.nullif(F.get(f, F.lit(i)), F.lit(""))
        months, zones = (F.create_map(*[F.lit(x) for pair in table.items() for x in pair]) for table in (rules.MONTHS, rules.ZONES))
        month = F.coalesce(part(1).try_cast("int"), F.try_element_at(months, F.substring(F.lower(part(1)), 1, 3)))
        zone = F.upper(part(6))
        digits = F.regexp_replace(zone, "^(?:GMT|UTC)(?=[+-])|:", "")
        offset = F.when(F.rlike(digits, F.lit(r"^[+-]\d{4}$")), F.concat(F.substring(digits, 1, 3), F.lit(":"), F.substring(digits, 4, 2)))
        offset = F.coalesce(offset, F.try_element_at(zones, zone))
        number = lambda i: F.coalesce(part(i).try_cast("int"), F.lit(0))
        local = F.try_make_timestamp_ntz(part(0).try_cast("int"), month, part(2).try_cast("int"), number(3), number(4), number(5))
        known = zone.isNull() | offset.isNotNull()
        return F.struct(F.when(known, F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss")).alias("local"), F.when(local.isNotNull(), offset).alias("zone"))

    return let(fields_of(tx.trim_ws(raw)), build)


def iso_date(local: Column, zone: Column) -> Column:
    """ISO 8601 with the offset where there is one."""
    return F.concat(local, F.coalesce(zone, F.lit("")))


# A paragraph ends at the next <p>, or where an enclosing block ends.
_BLOCK_END = (
    r"(?is)</(?:p|article|main|section|div|body|html|blockquote|td|th|tr|table|li|ul|ol|form"
    r"|footer|header|aside|nav)\s*>.*"
)


def paragraph_marks(body: Column) -> Column:
    """All <p> contents as one still encoded string with marks for tags and
    paragraph starts; a new <p> closes an open one."""
    return let(F.split(body, r"(?i)<p(?:\s[^>]*)?>"), lambda starts: F.array_join(F.transform(
        F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))),
        lambda piece: _marked(F.regexp_replace(piece, _BLOCK_END, "")),
    ), _FIELD))


def paragraph_texts(decoded: Column) -> Column:
    """Paragraphs with enough words out of decoded :func:`paragraph_marks`."""
    return F.filter(
        F.transform(F.split(decoded, _FIELD), lambda piece: node_text(piece)),
        lambda p: F.size(tx.words(p)) >= rules.PARAGRAPH_MIN_WORDS,
    )


def article_text(body: Column) -> Column:
    return F.array_join(paragraph_texts(tx.unescape(paragraph_marks(body))), "\n\n")


def articles(
    pages: DataFrame, url: str = "url", html: str = "html", fields: bool = True, **clean_options
) -> DataFrame:
    """One row per page with text: title, cleaned text, date, url, category; without
    ``fields`` only the text and the url, and nothing else is looked for.

    Further columns of ``pages`` (such as an order column) are kept.
    """
    out = bind(pages.filter(F.col(html).isNotNull()), "_body", strip_boilerplate(F.col(html)))
    out = tx.bind_unescaped(out, "_marks", paragraph_marks(F.col("_body")))
    text = tx.clean_text(F.array_join(paragraph_texts(F.col("_marks")), "\n\n"), **clean_options)
    out = bind(out, "text", text, keep=lambda t: ~tx.is_blank(t)).drop("_marks")
    if not fields:
        return out.drop("_body", html)
    out = with_fields(out, html, "_body")
    return out.withColumns({
        "title": F.coalesce("title", F.lit("")), "date": iso_date(F.col("date_local"), F.col("date_zone")),
    }).drop("_body", html)


# --- links -------------------------------------------------------------------------

_ANCHOR = r"(?is)<a\s(?:[^>]*?[\s\"'/])?href\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"


def hrefs(html: Column) -> Column:
    """All ``<a href>`` values in page order; scripts, styles and comments do not count."""
    visible = drop_comments(html)
    for tag in ("script", "style"):
        visible = F.regexp_replace(visible, rf"(?is)<{tag}\b.*?</{tag}\s*>", " ")
    found = F.regexp_extract_all(visible, F.lit(_ANCHOR), 1)
    joined = F.array_join(
        F.transform(found, lambda h: F.regexp_replace(h, "^[\"']|[\"']$", "")), _NODE
    )
    return F.when(F.size(found) > 0, F.split(tx.unescape(joined), _NODE)).otherwise(
        F.array().cast("array<string>")
    )


def links(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per link with its index ``link_idx`` on the page."""
    return pages.select(
        *[c for c in pages.columns if c != html],
        F.posexplode(hrefs(F.col(html))).alias("link_idx", "href"),
    )


# RFC 3986 appendix B; a missing part is told from an empty one by its delimiter.
_URI = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"


def url_parts(url: Column) -> Column:
    """struct(scheme, netloc, path): lowercased scheme, authority with its port."""
    part = lambda i: F.regexp_extract(url, "(?s)" + _URI, i)
    return F.struct(
        F.lower(part(1)).alias("scheme"),
        F.regexp_replace(part(2), "^//", "").alias("netloc"),
        part(3).alias("path"),
    )


def _remove_dot_segments(path: Column) -> Column:
    def fold(stack: Column, segment: Column) -> Column:
        # The first element is the empty string before the leading slash.
        up = F.slice(stack, 1, F.greatest(F.size(stack) - 1, F.lit(1)))
        return F.when(segment == "..", up).when(segment == ".", stack).otherwise(
            F.concat(stack, F.array(segment))
        )

    def resolve(p: Column) -> Column:
        segments = F.split(p, "/")
        rest = F.slice(segments, 2, F.greatest(F.size(segments), F.lit(1)))
        kept = F.aggregate(rest, F.array(F.lit("")), fold)
        ends_open = F.rlike(p, F.lit(r"/\.\.?$"))
        out = F.array_join(F.when(ends_open, F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")
        return F.when(F.rlike(p, F.lit(r"/\.\.?(?:/|$)")), out).otherwise(p)

    return let(path, resolve)


def resolve_url(base: Column, ref: Column) -> Column:
    """Reference resolution for hierarchical (http-like) bases."""
    def build(pair: Column) -> Column:
        b, r = pair["b"], pair["r"]
        part = lambda of, i: F.regexp_extract(of, "(?s)" + _URI, i)
        scheme, authority, path = part(r, 1), part(r, 2), part(r, 3)
        query, fragment = part(r, 4), part(r, 5)
        b_path = part(b, 3)
        folder = F.regexp_replace(b_path, "[^/]*$", "")
        folder = F.when((folder == "") & (part(b, 2) != ""), F.lit("/")).otherwise(folder)
        root = F.concat(F.lower(part(b, 1)), F.lit(":"), part(b, 2))
        return (
            F.when(r == "", b)
            .when((scheme != "") & ((F.lower(scheme) != F.lower(part(b, 1))) | (authority != "")), r)
            .when(authority != "", F.concat(F.lower(part(b, 1)), F.lit(":"), authority,
                                            path, query, fragment))
            .when(path == "", F.concat(root, b_path,
                                       F.when(query != "", query).otherwise(part(b, 4)), fragment))
            .when(path.startswith("/"), F.concat(root, _remove_dot_segments(path), query, fragment))
            .otherwise(F.concat(root, _remove_dot_segments(F.concat(folder, path)), query, fragment))
        )

    return let(F.struct(base.alias("b"), ref.alias("r")), build)


def resolved_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Every link of every page, absolute, with its scheme, netloc and path."""
    out = bind(links(pages, html), "link", resolve_url(F.col(url), F.col("href")))
    return bind(out, "_u", url_parts(F.col("link"))).select("*", "_u.*").drop("_u")


def is_web(scheme: Column) -> Column:
    return scheme.isin("http", "https")


def on_domain(netloc: Column, domain: Column | None, exact_suffix: bool = False) -> Column:
    """Links of an allowed site: no domain given, a relative link, or a netloc that
    contains the domain (or, with ``exact_suffix``, is it or a subdomain of it)."""
    if domain is None:
        return F.lit(True)
    if exact_suffix:
        match = (netloc == domain) | netloc.endswith(F.concat(F.lit("."), domain))
    else:
        match = F.contains(netloc, domain)
    return (domain == "") | (netloc == "") | match


def is_media(path: Column) -> Column:
    return F.rlike(path, F.lit(r"(?i)\.(?:" + "|".join(rules.MEDIA_EXTENSIONS) + ")$"))


def site_links(
    pages: DataFrame, domain: Column | None = None, url: str = "url", html: str = "html"
) -> DataFrame:
    """Web links of the allowed site that do not point at media files."""
    out = resolved_links(pages, url, html)
    return out.filter(
        is_web(F.col("scheme")) & on_domain(F.col("netloc"), domain) & ~is_media(F.col("path"))
    )


def long_articles(df: DataFrame, text: str = "text", minimum: int = rules.ARTICLE_MIN_WORDS) -> DataFrame:
    """Rows with enough words, counted on the given (cleaned) text, as ``n_words``."""
    return bind(df, "n_words", tx.word_count(F.col(text)), keep=lambda n: n >= minimum)
