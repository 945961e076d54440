"""Cleaning and preprocessing over the documents and pages tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from wordloom import rules
from wordloom.functions import text as tx
from wordloom.operators import pages
from wordloom.plans import sql
from wordloom.plans.registry import query
from wordloom.sources.sinks import plain_corpus
from wordloom.sources.tables import table

STOP_WORDS = sorted({w for lang in ("en", "de", "fr", "es") for w in rules.STOPWORDS[lang]})
ABBREVIATIONS = rules.ABBREVIATIONS["en"]


def _documents(name: str, fn: Callable[[Column], Column], sql_expr: str) -> None:
    """A per-row text operator over ``documents``."""
    @query(name, f"SELECT doc_id, {sql_expr} AS text FROM documents")
    def run(spark, d):
        return table(spark, d, "documents").select("doc_id", fn(F.col("text")).alias("text"))


def _pages(name: str, fn: Callable[[Column], Column], sql_expr: str, column: str = "html") -> None:
    @query(name, f"SELECT page_id, {sql_expr} AS text FROM pages")
    def run(spark, d):
        return table(spark, d, "pages").select("page_id", fn(F.col(column)).alias("text"))


_pages("strip_tags", tx.strip_tags, sql.sub("html", rules.TAG, " "))
_documents("charset_filter", tx.charset_filter,
           sql.sub("text", rf"[^{rules.KEEP_ALPHABET}\s{rules.KEEP_PUNCT}]", " "))
_documents("collapse_ws", tx.collapse_ws, sql.collapse("text"))
_documents("lowercase", F.lower, "lower(text)")
_documents("stopwords", lambda t: tx.drop_words(F.lower(t), STOP_WORDS),
           sql.drop_words("lower(text)", STOP_WORDS))
_documents("clean_text",
           lambda t: tx.clean_text(t, stop_words=STOP_WORDS, extra_letters=rules.LATIN_EXTRA),
           sql.clean("text", STOP_WORDS, rules.LATIN_EXTRA))
_documents("clean_text_default", tx.clean_text, sql.clean("text", rules.STOPWORDS["ru"]))
_documents("dashes", tx.unify_dashes, "translate(text, '—–', '--')")
_documents("quotes", tx.unify_quotes, "translate(text, '“”«»', '\"\"\"\"')")
_documents("punct_before", tx.no_space_before_punct, sql.sub("text", rf"\s([{rules.PUNCT}])", r"\1"))
_documents("punct_spacing", tx.space_punctuation, sql.spacing("text"))
_documents("mask_numbers", tx.mask_numbers, sql.mask_numbers("text"))
_documents("mask_emails", tx.mask_emails, sql.mask_emails("text"))
_documents("mask_patterns", tx.mask_patterns,
           sql.mask_emails(sql.mask_urls(sql.mask_numbers("text"))))
_documents("expand_abbreviations", lambda t: tx.expand_abbreviations(t, ABBREVIATIONS),
           sql.abbreviations("text", ABBREVIATIONS))
_RULES = [("e.g.", "for $1 example"), ("in", "\\in"), ("de", "[de]")]
_SQL_RULES = [(s, f.replace("\\", "\\\\")) for s, f in _RULES]


@query("abbreviation_table", f"SELECT doc_id, {sql.abbreviations('text', _SQL_RULES)} AS text FROM documents")
def abbreviation_table(spark, d):
    """The rules as a table, with replacements that hold a dollar sign and a backslash."""
    rows = [(i, s, f) for i, (s, f) in enumerate(_RULES)]
    rules_df = spark.createDataFrame(rows[::-1], "ord int, short string, full string")
    text = tx.expand_abbreviations(F.col("text"), tx.rule_table(rules_df))
    return table(spark, d, "documents").select("doc_id", text.alias("text"))


_documents("preprocess_default", tx.preprocess, sql.preprocess("text"))
_documents("preprocess_mask_first", lambda t: tx.preprocess(t, order="mask_first"),
           sql.preprocess_mask_first("text"))
_documents("trim_ws", lambda t: tx.trim_ws(F.concat(F.lit("\n \t"), t, F.lit(" \n"))),
           sql.sub("(chr(10) || ' ' || chr(9) || text || ' ' || chr(10))", r"^\s+|\s+$", ""))
_documents("rejoin", lambda t: F.array_join(tx.words(t), " "), sql.join(sql.words("text")))
_pages("mask_urls", tx.mask_urls, sql.mask_urls("url"), "url")
_pages("unescape", tx.unescape, sql.entities("html"))


@query("strip_links", "SELECT page_id, "
       + sql.sub("(html || ' ' || url || ' end')", r"http\S+", " ") + " AS text FROM pages")
def strip_links(spark, d):
    """Links sit in the pages' url column; the page text follows them."""
    text = F.concat("html", F.lit(" "), "url", F.lit(" end"))
    return table(spark, d, "pages").select("page_id", tx.strip_links(text).alias("text"))


_ASCII = "".join(map(chr, range(0x21, 0x7F)))
_FULL_WIDTH = "".join(chr(ord(c) + 0xFEE0) for c in _ASCII)


@query("nfkc", "SELECT doc_id, text FROM documents")
def nfkc(spark, d):
    """The documents in full-width letters, brought back by compatibility normalization."""
    wide = F.translate("text", _ASCII, _FULL_WIDTH)
    return table(spark, d, "documents").select("doc_id", tx.nfkc(wide).alias("text"))


@query("decode_lossy", "SELECT doc_id, regexp_replace(text, '[^\\x00-\\x7f]', chr(65533), 'g') "
       "AS text FROM documents")
def decode_lossy(spark, d):
    """The documents as Latin-1 bytes, read as UTF-8 with replacement characters."""
    bytes_ = F.encode("text", "ISO-8859-1").cast("string")
    return table(spark, d, "documents").select("doc_id", F.make_valid_utf8(bytes_).alias("text"))


@query("plain_corpus", "SELECT doc_id, replace(text, chr(10), ' ') AS text FROM documents")
def plain_lines(spark, d):
    return plain_corpus(table(spark, d, "documents").select("doc_id", "text"))


@query("word_count", f"SELECT doc_id, len({sql.words('text')})::BIGINT AS n_words FROM documents")
def word_count(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.word_count(F.col("text")).alias("n_words"))


@query("drop_blank", "SELECT doc_id, text FROM (SELECT doc_id, "
       + sql.sub("text", "[a-zA-Z.,]", "") + " AS text FROM documents) "
       "WHERE regexp_matches(text, '\\S')")
def drop_blank(spark, d):
    """Documents that still hold something once plain letters are removed."""
    rest = F.regexp_replace("text", "[a-zA-Z.,]", "")
    return table(spark, d, "documents").select("doc_id", rest.alias("text")).filter(
        ~tx.is_blank(F.col("text"))
    )


@query("min_words", f"SELECT doc_id, n_words FROM (SELECT doc_id, len({sql.words(sql.clean('text', STOP_WORDS, rules.LATIN_EXTRA))})::BIGINT "
       f"AS n_words FROM documents) WHERE n_words >= {rules.ARTICLE_MIN_WORDS}")
def min_words(spark, d):
    """Documents with enough words after cleaning."""
    cleaned = tx.clean_text(F.col("text"), stop_words=STOP_WORDS, extra_letters=rules.LATIN_EXTRA)
    docs = table(spark, d, "documents").select("doc_id", cleaned.alias("text"))
    return pages.long_articles(docs).select("doc_id", "n_words")
