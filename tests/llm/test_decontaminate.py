import random
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import LONG
from wordloom.llm.decontaminate import find_leaks, folded, located, merged

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "item_id bigint, text string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(texts, items, window):
    """Words, hit words with their spans, and item ids, straight from the definition."""
    out = []
    for text in texts:
        found = list(WORD.finditer(lower(text)))
        words = [m[0] for m in found]
        hit, names = set(), set()
        for name, item in items:
            own = WORD.findall(lower(item))
            n = min(window, len(own))
            for win in {tuple(own[k:k + n]) for k in range(len(own) - n + 1)} if n else ():
                for k in range(len(words) - n + 1):
                    if tuple(words[k:k + n]) == win:
                        hit.update(range(k, k + n))
                        names.add(name)
        spans = []
        for k in sorted(hit):
            if spans and k - 1 in hit:
                spans[-1] = spans[-1][0], found[k].end()
            else:
                spans.append((found[k].start(), found[k].end()))
        out.append((len(words), len(hit), spans, sorted(str(n) for n in names if n is not None)))
    return out


def leaks(spark, texts, items, window, **more):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    out, n = find_leaks(docs, spark.createDataFrame(items, SCHEMA), window, **more)
    return [(r[n["words"]], r[n["hit"]], [tuple(s) for s in r[n["spans"]]], r[n["items"]]) for r in out.orderBy("doc_id").collect()]


def random_case(seed):
    rng = random.Random(seed)
    say = lambda n: "".join(rng.choice(["a", "B", "é", "x1", "日"]) + rng.choice([" ", ", ", "\n", ".\t", "_"]) for _ in range(n))
    return [say(rng.randrange(40)) for _ in range(60)], [(i, say(rng.choice([0, 1, 2, 3, 5, 9]))) for i in range(12)]


@pytest.mark.parametrize("seed", range(4))
def test_same_as_brute_force(spark, seed):
    texts, items = random_case(seed)
    assert leaks(spark, texts, items, 4) == brute(texts, items, 4)


def test_blocks_of_items_find_the_same(spark):
    texts, items = random_case(9)
    assert leaks(spark, texts, items, 4, most_bytes=60) == leaks(spark, texts, items, 4) == brute(texts, items, 4)


def test_helpers():
    assert folded("A-b, É1!".encode()) == " a b É1 ".encode()
    assert folded(b"") == b"  "
    assert merged([5, 0, 2], [7, 2, 4]) == [(0, 4), (5, 7)]
    assert located("é b-C d".encode(), [(0, 1), (1, 3)]) == [(0, 1), (2, 5)]


def test_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, "a b c"), (1, "d e f"), (None, "f g h"), (2, None), (3, ""), (4, "?!")], SCHEMA)
    out, n = find_leaks(odd, items, 3)
    assert out.columns[:len(odd.columns)] == odd.columns and out.count() == odd.count()
    got = {(r.doc_id, r.text): (r[n["words"]], r[n["hit"]], r[n["items"]]) for r in out.collect()}
    assert got[1, "a b c d e f g h"] == (8, 8, ["1"])
    assert got[None, None] == got[3, None] == got[4, ""] == (0, 0, [])
    assert got[6, LONG] == (60_000, 0, [])
    assert find_leaks(none, items, 3)[0].count() == 0
    empty, n = find_leaks(odd, items.limit(0), 3)
    assert empty.filter(F.col(n["hit"]) > 0).count() == 0


def test_names_that_clash(spark):
    docs = spark.createDataFrame([(1, "a b", "x", "y")], "doc_id int, text string, _words string, items string")
    out, n = find_leaks(docs, spark.createDataFrame([(1, "a b")], SCHEMA), 2)
    row = out.first()
    assert (row["_words"], row["items"], row[n["words"]], row[n["items"]]) == ("x", "y", 2, ["1"])
