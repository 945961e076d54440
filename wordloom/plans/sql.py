"""SQL fragments shared by the DuckDB counterparts."""

from __future__ import annotations

import re

from wordloom import rules


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '\\s+'), lambda w: w <> '')"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def sub(x: str, pattern: str, to: str, flags: str = "g") -> str:
    return f"regexp_replace({x}, {text(pattern)}, {text(to)}, '{flags}')"


def wrapped(x: str) -> str:
    """Every run of word characters between two marks: RE2 has no lookaround, and
    the marks stand in for word boundaries."""
    return sub(x, r"([\p{L}\p{N}_]+)", "\x01\\1\x02")


def unwrapped(x: str) -> str:
    return sub(x, "[\x01\x02]", "")


def join(tokens: str) -> str:
    return f"array_to_string({tokens}, ' ')"


def drop_words(x: str, stop_words: list[str]) -> str:
    listed = ", ".join(text(w) for w in stop_words)
    return f"array_to_string(list_filter({words(x)}, lambda v: v not in ({listed})), ' ')"


def clean(x: str, stop_words: list[str], extra: str = "") -> str:
    out = sub(sub(x, rules.TAG, " "), r"http\S+", " ")
    out = sub(out, rf"[^{rules.KEEP_ALPHABET}{extra}\s{rules.KEEP_PUNCT}]", " ")
    return drop_words(f"lower({collapse(out)})", stop_words)


def mask_numbers(x: str) -> str:
    number = "\x01\\p{Nd}+\x02(?:[.,]\x01\\p{Nd}+\x02)?"
    return unwrapped(sub(wrapped(x), number, rules.NUM_TOKEN))


def mask_urls(x: str) -> str:
    return sub(x, r"(https?://\S+|www\.\S+)", rules.URL_TOKEN, "gi")


def mask_emails(x: str) -> str:
    word = r"\p{L}\p{N}_"
    return sub(x, rf"[{word}][{word}.-]*@[{word}.-]+\.[{word}]+", rules.EMAIL_TOKEN)


def abbreviations(x: str, table) -> str:
    for short, full in table:
        body = re.sub(r"\w+", lambda m: f"\x01{m[0]}\x02", short).replace(".", r"\.")
        x = unwrapped(sub(wrapped(x), body, full, "gi"))
    return x


def spacing(x: str) -> str:
    return sub(sub(x, rf"\s([{rules.PUNCT}])", r"\1"), rf"([{rules.PUNCT}])([^\s])", r"\1 \2")


def unify(x: str) -> str:
    return f"translate({x}, '—–“”«»', '--\"\"\"\"')"


def entities(x: str) -> str:
    for name, char in [("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")]:
        x = f"replace({x}, '&{name};', {text(char)})"
    return x


def preprocess(x: str) -> str:
    out = sub(unify(entities(f"lower({x})")), r"\s+", " ")
    out = f"trim({spacing(out)})"
    return f"trim({abbreviations(mask_emails(mask_urls(mask_numbers(out))), rules.ABBREVIATIONS_RU)})"


def preprocess_mask_first(x: str) -> str:
    out = sub(unify(entities(f"lower({x})")), r"\s+", " ")
    masked = mask_emails(mask_urls(mask_numbers(out)))
    return f"trim({spacing(abbreviations(masked, rules.ABBREVIATIONS_RU))})"


def body(x: str) -> str:
    out = sub(x, "(?s)<!--.*?-->", " ")
    for tag in rules.BOILERPLATE_TAGS:
        out = sub(out, rf"(?is)<{tag}\b.*?</{tag}\s*>", " ")
    return out


def nodes(x: str, separator: str) -> str:
    parts = f"string_split({entities(sub(x, '<[^>]*>', chr(1)))}, chr(1))"
    trimmed = f"list_transform({parts}, lambda n: regexp_replace(n, '^\\s+|\\s+$', '', 'g'))"
    return f"array_to_string(list_filter({trimmed}, lambda n: n <> ''), '{separator}')"


def paragraphs(x: str) -> str:
    end = (
        r"(?is)</(p|article|main|section|div|body|html|blockquote|td|th|tr|table|li|ul|ol|form"
        r"|footer|header|aside|nav)\s*>.*"
    )
    pieces = f"(regexp_split_to_array({x}, '(?i)<p(?:\\s[^>]*)?>'))[2:]"
    inner = nodes(sub("q", end, "", ""), " ")
    return (
        f"array_to_string(list_filter(list_transform({pieces}, lambda q: {inner}), "
        f"lambda p: len({words('p')}) >= {rules.PARAGRAPH_MIN_WORDS}), chr(10) || chr(10))"
    )


LATIN_WORD = (
    f"[{rules.WORD_ALPHABET}{rules.LATIN_EXTRA}]+"
    f"(?:[-''][{rules.WORD_ALPHABET}{rules.LATIN_EXTRA}]+)*"
)


def regex_words(x: str) -> str:
    return f"regexp_extract_all({x}, '{LATIN_WORD}')"


WORDPUNCT_CLASS = r"\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}"


def wordpunct(x: str) -> str:
    return f"regexp_extract_all({x}, '[{WORDPUNCT_CLASS}]+|[^{WORDPUNCT_CLASS}\\s]+')"


def plain_regex(pattern: str) -> str:
    """Possessive quantifiers as ordinary ones: RE2 is linear without them."""
    return pattern.replace("++", "+").replace("*+", "*")
