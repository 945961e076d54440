import hashlib
import re

import pytest
from hypothesis import given, settings, strategies as st

from wordloom.llm import fim

TEXTS = st.text(alphabet=st.sampled_from("abC <>PSM/é日😀\n."), max_size=40)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(name, text):
    """Units, form and output, straight from the definition."""
    u = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{name}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    n = len(u)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", text, None, None
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(u[a:b]) for a, b in ((0, low), (low, high), (high, n)))
    if h4 % 100 < 20:
        return n, "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return n, "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


@given(TEXTS, st.integers())
@settings(max_examples=400, deadline=None)
def test_pieces_same_as_brute_force(text, name):
    data = text.encode()
    n, form, parts = fim.descriptors(data, str(name), "1", 90, 20)
    pieces = parts if form == "plain" else fim.arrange(parts, form)
    buffers = data, b"<P><S><M>"
    output = b"".join(fim.read(pieces, buffers)).decode()
    assert (n, form, output) == brute(name, text)[:3]
    assert fim.digest(pieces, buffers) == sha(output)
    back = fim.disarrange(output.encode(), form)
    assert b"".join(fim.read(back, (output.encode(),))).decode() == text


def test_cut_keeps_what_is_described():
    pieces = [(0, 0, 4), (1, 2, 3)]
    assert fim.cut(pieces, 2) == [(0, 0, 2), (0, 2, 2), (1, 2, 3)]
    assert fim.cut(pieces, 5) == [(0, 0, 4), (1, 2, 1), (1, 3, 2)]
    with pytest.raises(ValueError):
        fim.cut(pieces, 9)
    with pytest.raises(ValueError):
        fim.disarrange(b"<S>a<M>b", "psm")


def test_odd_rows_and_round_trip(spark, odd, none):
    out, n = fim.transform(odd)
    back, m = fim.restore(out, n["output"], n["form"])
    rows = back.collect()
    assert back.columns[:len(odd.columns)] == odd.columns and len(rows) == odd.count()
    for r in rows:
        want = brute("null" if r.doc_id is None else r.doc_id, r.text or "")
        assert (r[n["units"]], r[n["form"]], r[n["output"]], r[n["prefix_chars"]], r[n["middle_chars"]]) == want
        assert r[n["output_sha256"]] == sha(want[2])
        assert r[m["restored"]] == (r.text or "") and r[m["restored_sha256"]] == sha(r.text or "")
    assert fim.transform(none)[0].count() == 0


def test_hashes_without_building_the_output(spark, odd):
    full, n = fim.transform(odd)
    bare, k = fim.transform(odd, with_output=False)
    assert k["output"] not in bare.columns
    pick = lambda df, c: sorted(r[0] for r in df.select(c).collect())
    assert pick(full, n["output_sha256"]) == pick(bare, k["output_sha256"])


def test_names_that_clash(spark):
    docs = spark.createDataFrame([(1, "a b c", "x", "y")], "doc_id int, text string, _form string, output string")
    out, n = fim.transform(docs)
    row = out.first()
    assert (row["_form"], row["output"]) == ("x", "y") and row[n["form"]] == brute(1, "a b c")[1]


def test_a_text_of_many_megabytes():
    text = ("word, " * 1_000_000).encode()
    n, form, parts = fim.descriptors(text, "2", "1", 100, 0)
    assert n == 3_000_000 and sum(k for *_, k in parts) == len(text)
