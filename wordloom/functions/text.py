"""String operators as Column -> Column functions; everything runs in the JVM
except the two rare-case helpers imported from ``kernels``."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wordloom import rules
from wordloom.functions import kernels

WS = rules.WS
_W = rules.WORD_CHAR
# Word boundaries over Python's word characters, spelled out because \b differs.
_NOT_AFTER_WORD, _NOT_BEFORE_WORD = rf"(?<![{_W}])", rf"(?![{_W}])"

# The cheap test comes first at every position; possessive runs cannot backtrack.
NUM = rf"(?=\p{{Nd}}){_NOT_AFTER_WORD}\p{{Nd}}+(?:[.,]\p{{Nd}}+)?{_NOT_BEFORE_WORD}"
URL = rf"(?=[hHwW])(?iu)(?:https?://[^{WS}]+|www\.[^{WS}]+)"
# A match starts at the first word character of the run before the at sign.
EMAIL = rf"{_NOT_AFTER_WORD}[{_W}][{_W}.-]*+@[{_W}.-]+\.[{_W}]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def bind(
    df: DataFrame, name: str, value: Column, keep: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Add a column that is computed once per row, optionally keeping only some rows.

    As the output of a generator it is a plain column to everything above: the
    optimizer neither copies a long expression into each of its uses nor pushes the
    filter, and with it the whole expression, below earlier steps.
    """
    items = F.array(value)
    if keep is not None:
        items = F.filter(items, keep)
    return df.select("*", F.explode(items).alias(name))


# --- white space -------------------------------------------------------------------

def words(text: Column) -> Column:
    """White-space words, no empty strings (Unicode white space)."""
    return F.array_remove(F.split(text, f"[{WS}]+"), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def trim_ws(text: Column) -> Column:
    return F.regexp_replace(text, f"^[{WS}]++|(?<![{WS}])[{WS}]++$", "")


def squeeze_ws(text: Column) -> Column:
    return F.regexp_replace(text, f"[{WS}]+", " ")


def collapse_ws(text: Column) -> Column:
    # After squeezing only U+0020 can be left at the ends.
    return F.trim(squeeze_ws(text))


def flatten_newlines(text: Column) -> Column:
    return F.translate(text, "\n", " ")


def is_blank(text: Column) -> Column:
    """True for null, empty and white-space-only text."""
    return F.coalesce(~F.rlike(text, F.lit(f"[^{WS}]")), F.lit(True))


# --- cleaning ------------------------------------------------------------------------

def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, rules.TAG, " ")


def strip_links(text: Column) -> Column:
    return F.regexp_replace(text, rules.LINK, " ")


def charset_filter(text: Column, extra_letters: str = "", keep_yo: bool = False) -> Column:
    letters = rules.KEEP_ALPHABET + ("ёЁ" if keep_yo else "") + extra_letters
    return F.regexp_replace(text, f"[^{letters}{WS}{rules.KEEP_PUNCT}]", " ")


def drop_words(text: Column, stop_words: Sequence[str]) -> Column:
    """Remove exact white-space words; punctuation stays attached and protects a word."""
    kept = F.filter(words(text), lambda w: ~w.isin(list(stop_words)))
    return F.array_join(kept, " ")


def clean_text(
    text: Column,
    lowercase: bool = True,
    stop_words: Sequence[str] | None = tuple(rules.STOPWORDS["ru"]),
    extra_letters: str = "",
    keep_yo: bool = False,
) -> Column:
    out = collapse_ws(charset_filter(strip_links(strip_tags(text)), extra_letters, keep_yo))
    if lowercase:
        out = F.lower(out)
    if stop_words:
        out = drop_words(out, stop_words)
    return out


# --- entities and Unicode form -----------------------------------------------------------

_FAST_ENTITIES = [
    ("lt", "<"), ("gt", ">"), ("quot", '"'), ("nbsp", " "), ("copy", "©"),
    ("middot", "·"), ("laquo", "«"), ("raquo", "»"), ("mdash", "—"), ("ndash", "–"),
    ("hellip", "…"), ("amp", "&"),  # the ampersand comes last: one decoding level only
]
_RARE_ENTITY = "&(?!(?:" + "|".join(n for n, _ in _FAST_ENTITIES) + ");)[a-zA-Z#]"


def _entity_parts(text: Column) -> Column:
    """The text with its common entities decoded, and the text if it has a rare one."""
    def split_up(t: Column) -> Column:
        fast = t
        for name, char in _FAST_ENTITIES:
            fast = F.replace(fast, F.lit(f"&{name};"), F.lit(char))
        marked = F.contains(t, F.lit("&"))
        return F.struct(
            F.when(marked, fast).otherwise(t).alias("fast"),
            F.when(marked & F.rlike(t, F.lit(_RARE_ENTITY)), t).alias("rare"),
        )

    return let(text, split_up)


def unescape(text: Column) -> Column:
    """HTML5 entity decoding. Common entities stay in the JVM; only texts with
    another entity are sent to Python, the rest travel as nulls."""
    both = _entity_parts(text)
    return F.coalesce(kernels.html_unescape(both["rare"]), both["fast"])


def bind_unescaped(df: DataFrame, name: str, text: Column) -> DataFrame:
    """:func:`unescape` as a column that is computed once: a long ``text`` expression goes
    neither to Python and to the result beside it, nor into each use."""
    out = bind(df, "_parts", _entity_parts(text))
    decoded = F.coalesce(kernels.html_unescape(F.col("_parts.rare")), F.col("_parts.fast"))
    return out.withColumn(name, decoded).drop("_parts")


# Characters that NFKC leaves alone in any company: no decomposition, no combining.
_NFKC_SAFE = "\x80-\x9f«»À-ıĴ-ľŁ-ňŊ-žЀ-ҁҊ-ԯ–—“”‘’€"
# ASCII is passed over by one comparison; only other characters meet the long class.
_NFKC_SUSPECT = rf"[^\x00-\x7f](?<![{_NFKC_SAFE}])"


def nfkc(text: Column) -> Column:
    """Unicode NFKC; texts made only of stable characters never leave the JVM."""
    changed = kernels.nfkc(F.when(F.rlike(text, F.lit(_NFKC_SUSPECT)), text))
    return F.coalesce(changed, text)


# --- punctuation ---------------------------------------------------------------------------

def unify_dashes(text: Column) -> Column:
    return F.translate(text, rules.DASHES, "-" * len(rules.DASHES))


def unify_quotes(text: Column) -> Column:
    return F.translate(text, rules.QUOTES, '"' * len(rules.QUOTES))


def unify_marks(text: Column) -> Column:
    """Dashes and quotes in one pass, over texts that have any."""
    marks, plain = rules.DASHES + rules.QUOTES, "-" * len(rules.DASHES) + '"' * len(rules.QUOTES)
    return let(text, lambda t: F.when(
        F.rlike(t, F.lit(f"[{marks}]")), F.translate(t, marks, plain)).otherwise(t))


def no_space_before_punct(text: Column) -> Column:
    return F.regexp_replace(text, f"[{WS}]([{rules.PUNCT}])", "$1")


def space_after_punct(text: Column) -> Column:
    return F.regexp_replace(text, f"([{rules.PUNCT}])([^{WS}])", "$1 $2")


def space_punctuation(text: Column) -> Column:
    return space_after_punct(no_space_before_punct(text))


# --- placeholders and abbreviations ------------------------------------------------------------

def mask_numbers(text: Column) -> Column:
    return F.regexp_replace(text, NUM, rules.NUM_TOKEN)


def mask_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL, rules.URL_TOKEN)


def mask_emails(text: Column) -> Column:
    return let(text, lambda t: F.when(
        F.contains(t, F.lit("@")), F.regexp_replace(t, EMAIL, rules.EMAIL_TOKEN)).otherwise(t))


def mask_patterns(text: Column, extra: Iterable[tuple[str, str]] = ()) -> Column:
    """Numbers, then URLs, then e-mails, then the caller's (regex, token) pairs."""
    out = mask_emails(mask_urls(mask_numbers(text)))
    for pattern, token in extra:
        out = F.regexp_replace(out, pattern, token)
    return out


def _abbreviation_regex(short: str) -> str:
    body = "".join(c if c.isalnum() else "\\" + c for c in short)
    left = _NOT_AFTER_WORD if short[0].isalnum() else ""
    right = _NOT_BEFORE_WORD if short[-1].isalnum() else ""
    return left + body + right


def _quoted(replacement: str) -> str:
    """A replacement in which ``$`` and a backslash stand for themselves."""
    return replacement.replace("\\", "\\\\").replace("$", "\\$")


#: A rule table becomes part of an expression, so it is of the size of a list that people write.
MOST_RULES = 2_000


def rule_table(table: DataFrame, short: str = "short", full: str = "full", order: str = "ord") -> list[tuple[str, str]]:
    """An (abbreviation, expansion) table, in its order, for :func:`expand_abbreviations`; rows without an abbreviation
    don't count, a null expansion is empty."""
    rows = table.filter(F.col(short).isNotNull() & (F.col(short) != "")).orderBy(order, short).select(
        short, F.coalesce(full, F.lit(""))).limit(MOST_RULES + 1).collect()
    if len(rows) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    return [(r[0], r[1]) for r in rows]


def expand_abbreviations(
    text: Column, table: Sequence[tuple[str, str]] = tuple(rules.ABBREVIATIONS_RU)
) -> Column:
    """Apply the ordered (abbreviation, expansion) table, ignoring case.

    Most texts hold none of them: one combined search decides, and only then do
    the single replacements run.
    """
    if not table:
        return text
    # Both cases are spelled out, with the two letters that fold to ASCII ones.
    initials = {c for short, _ in table for c in (short[0].lower(), short[0].upper())}
    initials |= {fold for c, fold in (("s", "ſ"), ("k", "K")) if c in initials}
    first = "".join(c if c.isalnum() else "\\" + c for c in sorted(initials))
    any_of = f"(?=[{first}])(?iu)(?:" + "|".join(_abbreviation_regex(s) for s, _ in table) + ")"

    def expand(t: Column) -> Column:
        out = t
        for short, full in table:
            out = F.regexp_replace(out, "(?iu)" + _abbreviation_regex(short), _quoted(full))
        return F.when(F.rlike(t, F.lit(any_of)), out).otherwise(t)

    return let(text, expand)


def preprocess(
    text: Column,
    lowercase: bool = True,
    normalize_punctuation: bool = True,
    replace_patterns: bool = True,
    expand: bool = True,
    abbreviations: Sequence[tuple[str, str]] = tuple(rules.ABBREVIATIONS_RU),
    extra_patterns: Iterable[tuple[str, str]] = (),
    order: str = "reference",
) -> Column:
    """Bring a text to one standard form; null becomes the empty string.

    ``order="reference"`` spaces punctuation before masking, so ``3.14`` turns into
    two numbers. ``order="mask_first"`` masks and expands first, which keeps
    decimals, addresses and dotted abbreviations whole.
    """
    if order not in ("reference", "mask_first"):
        raise ValueError(f"unknown order {order!r}")
    out = F.coalesce(text, F.lit(""))
    if lowercase:
        out = F.lower(out)
    if normalize_punctuation:
        out = squeeze_ws(unify_marks(unescape(out)))
        if order == "reference":
            out = F.trim(space_punctuation(out))
    if replace_patterns:
        out = mask_patterns(out, extra_patterns)
    if expand:
        out = expand_abbreviations(out, abbreviations)
    if normalize_punctuation and order == "mask_first":
        out = space_punctuation(out)
    # Once white space is squeezed, only U+0020 can be left at the ends.
    return F.trim(out) if normalize_punctuation else trim_ws(out)


# --- distances ------------------------------------------------------------------------------------

def normalized_edit_distance(a: Column, b: Column) -> Column:
    """Levenshtein distance over the longer length; 0 for two empty texts.

    For titles, words and other short texts: the built-in is quadratic.
    """
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(0.0)).otherwise(
        F.levenshtein(a, b).cast("double") / F.nullif(longest, F.lit(0))
    )
