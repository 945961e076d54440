"""Arrow-batched helpers for what the built-in functions cannot express.

Each is a few lines around a standard-library call or a published algorithm;
Spark decides which rows reach them and how the work is spread.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, StringType


@pandas_udf(StringType())
def html_unescape(text: pd.Series) -> pd.Series:
    return text.map(html.unescape, na_action="ignore")


@pandas_udf(StringType())
def nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def _bit_parallel(a: str, b: str) -> int:
    """Bit-parallel edit distance (Myers 1999, Hyyrö 2003).

    The column of the dynamic-programming table is held as the bits of two Python
    integers, so one text step costs a few long-integer operations.
    """
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return len(a)
    m = len(b)
    full, top = (1 << m) - 1, 1 << (m - 1)
    where: dict[str, int] = {}
    for i, ch in enumerate(b):
        where[ch] = where.get(ch, 0) | (1 << i)
    plus, minus, distance = full, 0, m
    for ch in a:
        eq = where.get(ch, 0)
        vertical = eq | minus
        diagonal = (((eq & plus) + plus) ^ plus) | eq
        h_plus = minus | (full & ~(diagonal | plus))
        h_minus = plus & diagonal
        if h_plus & top:
            distance += 1
        elif h_minus & top:
            distance -= 1
        h_plus = ((h_plus << 1) | 1) & full
        h_minus = (h_minus << 1) & full
        plus = h_minus | (full & ~(vertical | h_plus))
        minus = h_plus & vertical
    return distance


def _trimmed(a: str, b: str) -> tuple[str, str]:
    """Both without what they share at their ends."""
    def shared(x: str, y: str) -> int:
        low, high = 0, min(len(x), len(y))
        while low < high:
            mid = (low + high + 1) // 2
            if x[low:mid] == y[low:mid]:
                low = mid
            else:
                high = mid - 1
        return low

    n = shared(a, b)
    a, b = a[n:], b[n:]
    n = shared(a[::-1], b[::-1])
    return a[:len(a) - n], b[:len(b) - n]


def _inside(a: str, b: str) -> bool:
    """Whether ``a`` is a subsequence of ``b``."""
    at = 0
    for ch in a:
        at = b.find(ch, at) + 1
        if not at:
            return False
    return True


def _gaps(text: str, loose: re.Pattern) -> tuple[str, dict[int, str]]:
    """A text without its loose characters, and runs of these by the place where they were."""
    parts, at, gaps, last = [], 0, {}, 0
    for m in loose.finditer(text):
        parts.append(text[last:m.start()])
        at += m.start() - last
        gaps[at] = m[0]
        last = m.end()
    return "".join([*parts, text[last:]]), gaps


def _spacing_distance(a: str, b: str) -> int | None:
    """Edit distance of texts that differ in *loose* characters only, white space and those that only
    one of them has, where two bounds prove it; None where they don't.

    Editing each gap between the others for itself is one way, so the distance is no more than the gaps' sum. It is
    no less than the difference in length and what one text has and the other hasn't at all.
    """
    loose = re.compile(f"[\\s{re.escape(''.join(sorted(set(a) ^ set(b))))}]+")
    (x, in_a), (y, in_b) = _gaps(a, loose), _gaps(b, loose)
    if x != y:
        return None
    most = sum(_bit_parallel(in_a.get(k, ""), in_b.get(k, "")) if in_a.get(k) != in_b.get(k) else 0 for k in in_a.keys() | in_b.keys())
    have, want = Counter("".join(in_a.values())), Counter("".join(in_b.values()))
    least = max((have - want).total(), (want - have).total())
    # A character that b hasn't at all is deleted or replaced; the lengths ask for the rest.
    foreign = sum(n for ch, n in have.items() if ch not in want and ch not in x)
    missing = sum(n for ch, n in want.items() if ch not in have and ch not in x)
    least = max(least, len(b) - len(a) + foreign, len(a) - len(b) + missing)
    return most if most == least else None


def spacing(line: str, plain: str) -> tuple[int, int, int, int]:
    """What :func:`gap_distances` needs of a line and its words without what is between them: how many runs without white
    space it has (-1 where these aren't the words), how many white characters and spaces, and edits to one space between runs."""
    runs = line.split()
    if "".join(runs) != plain:
        return -1, 0, 0, 0
    white, spaces = len(line) - len(plain), line.count(" ")
    if white == len(runs) - 1:  # single characters, none at an end
        return len(runs), white, spaces, white - spaces
    inner = line.strip()
    return len(runs), white, spaces, len(line) - len(inner) + sum(len(g) - (" " in g) for g in re.findall(r"\s+", inner))


def gap_distances(gaps: np.ndarray, tokens: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Edit distances of lines from their tokens joined by spaces, from counts alone, where two bounds prove them; -1
    where they don't.

    ``gaps`` has a row of :func:`spacing` for each line; its tokens spell its words but for ``marks`` characters in all that
    they add, and none goes on beyond white space. Editing each gap for itself is one way. No way has fewer edits than the
    lengths and the characters ask for that one text has and the other hasn't.
    """
    runs, white, spaces, most = gaps.T
    most = most + tokens - runs + marks
    foreign, wanted = white - spaces, tokens - 1
    longer = marks + wanted - white
    least = np.maximum.reduce([longer + foreign, -longer, foreign + np.maximum(spaces - wanted, 0), marks + np.maximum(wanted - spaces, 0)])
    return np.where((most == least) & (runs >= 0) & (tokens > 0), most, -1)


def spaced_distance(line: str, plain: str, tokens: int, marks: int) -> int | None:
    """:func:`gap_distances` of one line, None where the bounds prove nothing."""
    found = int(gap_distances(np.array([spacing(line, plain)]), np.array([tokens]), np.array([marks]))[0])
    return None if found < 0 else found


def levenshtein(a: str, b: str) -> int:
    """Edit distance. In linear time where one text is part of the other, character by character, or where both
    differ in single white space; bit-parallel on what differs otherwise."""
    a, b = _trimmed(a, b)
    if len(a) > len(b):
        a, b = b, a
    if _inside(a, b):
        return len(b) - len(a)
    found = _spacing_distance(a, b)
    return _bit_parallel(a, b) if found is None else found


def edit_fraction(a: str, b: str) -> float:
    longest = max(len(a), len(b))
    return levenshtein(a, b) / longest if longest else 0.0


@pandas_udf(DoubleType())
def long_edit_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    """Normalized edit distance for whole documents."""
    return pd.Series([
        None if x is None or y is None else edit_fraction(x, y) for x, y in zip(a, b)
    ], dtype="float64")
