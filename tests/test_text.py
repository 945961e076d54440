"""Cleaning, preprocessing and tokenizers: golden values and random Unicode."""

import html
import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from wordloom import rules
from wordloom.functions import text as tx, tokenizers as tk

STOP = ["и", "в", "на", "не", "что"]


def test_clean_text_golden(apply):
    cases = {
        "<p>Ёлка и «дом» — в https://a.ru/x?q=1 Москве!</p>": "лка дом москве!",
        "HTTP://A.RU и мир": "http a.ru мир",
        "и, и не он": "и, он",
        "a b\tc  d": "a b c d",
        "x < y и z > w": "x w",
    }
    assert apply(lambda c: tx.clean_text(c, stop_words=STOP), list(cases)) == list(cases.values())
    assert apply(lambda c: tx.clean_text(c, stop_words=None, keep_yo=True), ["Ёлка и"]) == ["ёлка и"]
    assert apply(lambda c: tx.clean_text(c, lowercase=False, stop_words=None), ["А б"]) == ["А б"]


PREPROCESS = [
    ("Цена 3.14, т.е. 12 руб.", "цена <NUM>. <NUM>, т. е. <NUM> руб.", "цена <NUM>, то есть <NUM> руб."),
    ("См. https://a.ru/12 и www.b.ru", "см. https: //a. ru/<NUM> и www. b. ru", "см. <URL> и <URL>"),
    ("Пиши a.b@c.com или 77@x.com", "пиши a. b@c. com или <NUM>@x. com", "пиши <EMAIL> или <NUM>@x. com"),
    ("В 2020 г. РФ и США , и др.",) + (
        "в <NUM> год российская федерация и соединенные штаты америки, и другие",) * 2,
    ("«Привет» — мир&nbsp;&amp; ЕС",) + ('"привет" - мир & европейский союз',) * 2,
    ("И т.д...", "и т. д. ..", "и так далее. ."),
    ("user@host 1,234,567", "user@host <NUM>, <NUM>, <NUM>", "user@host <NUM>, <NUM>"),
    ("", "", ""),
    (None, "", ""),
]


def test_preprocess_golden(apply):
    texts = [p[0] for p in PREPROCESS]
    assert apply(tx.preprocess, texts) == [p[1] for p in PREPROCESS]
    assert apply(lambda c: tx.preprocess(c, order="mask_first"), texts) == [p[2] for p in PREPROCESS]


def test_preprocess_switches(apply):
    off = dict(lowercase=False, normalize_punctuation=False, replace_patterns=False, expand=False)
    assert apply(lambda c: tx.preprocess(c, **off), [" А , 1 РФ\n"]) == ["А , 1 РФ"]
    assert apply(lambda c: tx.preprocess(c, **{**off, "replace_patterns": True}), ["А 1 иван@почта.рф"]) == [
        "А <NUM> <EMAIL>"]
    assert apply(lambda c: tx.preprocess(c, **{**off, "expand": True}), ["РФ рфр ГГ."]) == [
        "российская федерация рфр ГГ."]
    with pytest.raises(ValueError):
        tx.preprocess(None, order="sideways")


def test_tokenizers_golden(apply):
    texts = ["«(Привет),» a-b ... it's! 12,5", "Ёж-ик don't x_y 3d", ""]
    assert apply(tk.naive, texts) == [["Привет", "a-b", "it's", "12,5"], ["Ёж-ик", "don't", "x_y", "3d"], []]
    assert apply(tk.regex_words, texts) == [
        ["Привет", "a-b", "it's"], ["Ёж-ик", "don't", "x", "y", "d"], []]
    assert apply(tk.wordpunct, texts)[:2] == [
        ["«(", "Привет", "),»", "a", "-", "b", "...", "it", "'", "s", "!", "12", ",", "5"],
        ["Ёж", "-", "ик", "don", "'", "t", "x_y", "3d"]]
    assert apply(tk.rule_tokens, ["Кто-то, 3.14!"]) == [["Кто-то", ",", "3.14", "!"]]
    assert apply(tk.sentence_tokens, ["Это дом, т.е. 3.5 м... Don't go-on! (U.S.A.) 10:30", None, ""]) == [
        ["Это", "дом", ",", "т.е.", "3.5", "м", "...", "Don't", "go-on", "!", "(", "U.S.A.", ")", "10:30"], None, []]
    assert apply(tk.sentence_words, ["Это дом. Тут он!"]) == [["Это", "дом", "Тут", "он"]]
    with pytest.raises(ValueError):
        tk.resolve("nope")


def test_own_tokenizer(apply):
    import pandas as pd
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("array<string>")
    def bars(s: pd.Series) -> pd.Series:
        return s.str.split("|")

    assert apply(tk.resolve(bars), ["a|b"]) == [["a", "b"]]


# --- against one-line Python equivalents on random text --------------------------------------

PIECES = st.one_of(
    st.sampled_from(list(" \t\n\r\x0b\x0c\x1c\x1f\x85\xa0  　.,!?;:-—–«»“”\"'<>&@_/()…")),
    st.sampled_from(["http://", "HTTPS://a", "www.", "a.b@c.com", "12", "3.14", "1,5", "т.е.", "РФ", "г.",
                     "&amp;", "&lt", "&nbsp;", "&copy ", "&#38;", "&hellip;", "<p>", "ﬁ", "é", "é",
                     "Ё", "ё", "ß", "İ", "ς", "²", "٣", "क्षि", "Ａ", "😀", "日本"]),
    st.text(alphabet="абвгАБВabcXYZ019", max_size=4),
)
TEXTS = st.lists(st.lists(PIECES, max_size=14).map("".join), min_size=40, max_size=40)
HYPOTHESIS = settings(max_examples=4, deadline=None,
                      suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


def py_abbreviations(t):
    for short, full in rules.ABBREVIATIONS_RU:
        right = r"\b" if short[-1].isalnum() else ""
        t = re.sub(r"\b" + re.escape(short) + right, full, t, flags=re.I)
    return t


PYTHON = {
    "words": (tx.words, str.split),
    "trim_ws": (tx.trim_ws, str.strip),
    "collapse_ws": (tx.collapse_ws, lambda t: re.sub(r"\s+", " ", t).strip()),
    "strip_tags": (tx.strip_tags, lambda t: re.sub(r"<[^>]+>", " ", t)),
    "strip_links": (tx.strip_links, lambda t: re.sub(r"http\S+", " ", t)),
    "charset": (tx.charset_filter, lambda t: re.sub(r"[^a-zA-Zа-яА-Я0-9\s.,!?]", " ", t)),
    "before": (tx.no_space_before_punct, lambda t: re.sub(r"\s([,.!?;:])", r"\1", t)),
    "after": (tx.space_after_punct, lambda t: re.sub(r"([,.!?;:])([^\s])", r"\1 \2", t)),
    "numbers": (tx.mask_numbers, lambda t: re.sub(r"\b\d+(?:[.,]\d+)?\b", "<NUM>", t)),
    "urls": (tx.mask_urls, lambda t: re.sub(r"(https?://\S+|www\.\S+)", "<URL>", t, flags=re.I)),
    "emails": (tx.mask_emails, lambda t: re.sub(r"\b[\w.-]+@[\w.-]+\.\w+\b", "<EMAIL>", t)),
    "abbreviations": (tx.expand_abbreviations, py_abbreviations),
    "marks": (tx.unify_marks, lambda t: re.sub("[“”«»]", '"', t.replace("—", "-").replace("–", "-"))),
    "unescape": (tx.unescape, html.unescape),
    "nfkc": (tx.nfkc, lambda t: unicodedata.normalize("NFKC", t)),
    "naive": (tk.naive, lambda t: [p for p in (w.strip(rules.NAIVE_STRIP) for w in t.split()) if p]),
    "regex": (tk.regex_words, lambda t: re.findall(
        r"[A-Za-zА-Яа-яЁё]+(?:[-'][A-Za-zА-Яа-яЁё]+)*", t)),
}


@given(texts=TEXTS)
@HYPOTHESIS
def test_matches_python(spark, texts):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    rows = df.select("i", "x", *[fn(F.col("x")).alias(k) for k, (fn, _) in PYTHON.items()]).collect()
    for row in rows:
        for key, (_, expected) in PYTHON.items():
            assert row[key] == expected(row.x), (key, row.x)


def test_nfkc_safe_characters_are_stable():
    inside = re.compile(f"[{tx._NFKC_SAFE}\\x00-\\x7f]")
    safe = [chr(c) for c in range(0x3000) if inside.match(chr(c))]
    assert len(safe) > 500
    for c in safe:
        assert unicodedata.normalize("NFKC", c) == c and not unicodedata.combining(c), hex(ord(c))


def test_clean_text_idempotent(spark, documents):
    from pyspark.sql import functions as F

    once = documents.select(tx.clean_text(F.col("text")).alias("a"))
    assert once.filter(F.col("a") != tx.clean_text(F.col("a"))).count() == 0
