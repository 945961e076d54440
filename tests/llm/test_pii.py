import hashlib
import random
import re
import time

from pyspark.sql import functions as F

from wordloom.llm import pii

RE = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    out = []
    for k, pattern in enumerate(RE):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if k == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if k == 2 and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if k == 3 and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_of_random_texts(table_of):
    rng = random.Random(5)
    parts = ["a@b.c", "@", ".", "x.y", "1", "22", "255", "256", "007", ".", "-", " ", "+", "(", ")", "4111 1111 1111 1111",
             "4111111111111112", "+44 20 7946 0958", "é", "a", "_", "%", "\n", "10.0.0.1", "378282246310005", "😀", "000", "99999999999999999999"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(2500)]
    got = pii.find_entities(table_of(texts)).select("id", "base").collect()
    assert len(got) == len(texts)
    for r in got:
        assert [(b.start, b.kind, b.end) for b in r.base] == brute(texts[r.id]), texts[r.id]


def test_many_matches_in_one_text(table_of):
    text = "see 10.1.2.3 or a@b.cd " * 3000
    [r] = pii.find_entities(table_of([text])).select("base").collect()
    assert [(b.start, b.kind, b.end) for b in r.base] == brute(text)


def test_long_runs_are_linear(table_of):
    texts = ["a" * 200_000, "1" * 200_000, "1." * 100_000, "+1" * 100_000, "a@" * 100_000, "a@b" + ".c" * 100_000,
             "1 " * 100_000, "+1" + " (" * 100_000, "a@b." * 50_000, "." * 200_000, "-" * 200_000 + "@x.y"]
    start = time.time()
    got = {r.id: [(b.start, b.kind, b.end) for b in r.base] for r in pii.find_entities(table_of(texts)).select("id", "base").collect()}
    assert time.time() - start < 60
    assert got[5] == [(0, 0, len(texts[5]))] and got[0] == [] and got[10] == [(0, 0, 200_004)]
    assert got[2] == brute(texts[2])


def test_disclosing_terms(table_of):
    others = [f"plain text number {w} about weather and other things" for w in "abcdefghij"]
    near = [f"{w} write zorblat at jo@ex.org about weather" for w in ("please", "never", "always", "do")]
    out = {r.id: r for r in pii.find_spans(table_of(others + near)).collect()}
    assert all(not out[i].terms and not out[i].base for i in range(len(others)))  # clean texts are left alone
    for i, text in enumerate(near, len(others)):
        terms = {text[t.start:t.end] for t in out[i].terms}
        assert "zorblat" in terms and "weather" not in terms and "about" not in terms
    clean = {r.doc_id: r.text for r in pii.sanitise(table_of(others + near)).collect()}
    assert clean[0] == others[0]
    assert "zorblat" not in clean[10] and "<EMAIL>" in clean[10] and "weather" in clean[10]
    mild = {r.doc_id: r.text for r in pii.sanitise(table_of(others + near), remove=2.0).collect()}
    assert "<TERM>" in mild[10]


def test_terms_far_from_the_entity(table_of):
    filler = " ".join(["about weather and other things of the day"] * 20)
    far = [f"{w} ask jo@ex.org {filler} for zorblat, {filler} Zorblat" for w in ("please", "never", "always", "do")]
    texts = far + [f"jo@ex.org and {filler}"] + [f"{w} {filler}" for w in "abcdefghij"] + ["zorblatt without"]
    out = {r.id: r for r in pii.find_spans(table_of(texts)).collect()}
    for i, text in enumerate(far):
        assert [text[t.start:t.end] for t in out[i].terms if text[t.start:t.end].lower() == "zorblat"] == ["zorblat", "Zorblat"]
    assert not any(out[i].terms for i in range(len(far), len(texts)))


def plain(rows, reach, contexts, least):
    """Terms of each row (start, end, disclosure) by their definition."""
    import collections
    import math

    term = re.compile(r"[^\W\d_]{3,}")
    near, held = [], []
    for _, text in rows:
        mine = {}
        for k, pattern in enumerate(RE):
            ends = [(m.start(), m.end()) for m in pattern.finditer(text or "")]
            for i, (a, b) in enumerate(ends):
                if (a, k, b) not in brute(text):
                    continue
                low, high = ends[i - 1][1] if i else 0, ends[i + 1][0] if i + 1 < len(ends) else len(text)
                digits = re.sub("[^0-9]", "", text[a:b])
                name = pii.KINDS[k] + ":" + (text[a:b].lower(), text[a:b], digits, digits)[k]
                around = text[max(low, a - reach):a] + "|" + text[b:min(high, b + reach)]
                mine[name] = min(mine.get(name, "~"), hashlib.md5(around.encode()).hexdigest())
        near.append(mine)
        held.append({m[0].lower() for m in term.finditer(text or "")})
    n_c = collections.Counter(c for mine in near for c in mine)
    n_t = collections.Counter(t for terms in held for t in terms)
    n_ct, seen = collections.Counter(), collections.defaultdict(set)
    for mine, terms in zip(near, held):
        for c, context in mine.items():
            for t in terms:
                n_ct[c, t] += 1
                seen[c, t].add(context)
    told = {}
    for (c, t), n in n_ct.items():
        if len(seen[c, t]) >= contexts and n_c[c] < len(rows):
            told[c, t] = 1 + math.log2(n / n_t[t]) / math.log2(len(rows) / n_c[c])
    out = []
    for (_, text), mine in zip(rows, near):
        spans = []
        for m in term.finditer(text or ""):
            d = max((told.get((c, m[0].lower()), -9) for c in mine), default=-9)
            if d >= least and not any(a < m.end() and m.start() < b for a, _, b in brute(text)):
                spans.append((m.start(), m.end()))
        out.append(spans)
    return out


def random_corpus():
    rng = random.Random(8)
    words = [a + b + c for a in "abc" for b in "defg" for c in ("x", "yz", "Q")]
    ids = ["jo@ex.org", "10.0.0.1", "4111 1111 1111 1111", "+44 20 7946 0958", "al@ex.org"]
    texts = []
    for _ in range(120):
        topic = rng.randrange(8)
        some = [rng.choice(words[topic * 4:topic * 4 + 6] if rng.random() < 0.7 else words) for _ in range(rng.randint(0, 30))]
        if topic < 5 and rng.random() < 0.9:
            some.insert(rng.randint(0, len(some)), ids[topic])
        texts.append(", ".join(some))
    texts += texts[:20] + [None, ""]
    return texts


def test_random_corpora_against_the_definition(table_of, monkeypatch):
    texts = random_corpus()
    monkeypatch.setattr(pii, "_HOT", 10)  # many keys are broadcast here; the other tests have few or none
    got = {r.id: [(t.start, t.end) for t in r.terms] for r in pii.find_spans(table_of(texts), generalise=0.6).collect()}
    want = plain(list(enumerate(texts)), 48, 3, 0.6)
    assert sum(map(len, want)) > 30 and [got[i] for i in range(len(texts))] == want


def test_copies_are_no_evidence(table_of):
    texts = ["call zorblat at jo@ex.org now"] * 20 + ["other words here"] * 5
    assert not any(r.terms for r in pii.find_spans(table_of(texts)).collect())


def test_odd_rows(odd, none, odd_rows):
    got = pii.find_spans(odd).collect()
    assert len(got) == len(odd_rows) and not any(r.base or r.terms for r in got)
    assert sorted(map(str, pii.sanitise(odd).collect())) == sorted(map(str, odd.collect()))
    assert pii.find_spans(none).collect() == [] and pii.sanitise(none).collect() == []


def test_no_python_in_the_plan(odd):
    plan = pii.find_entities(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_digest_column_of_the_query(spark, tmp_path, table_of):
    from wordloom.llm.queries_native import op1_pii

    texts = ["mail a@b.cd or +44 20 7946 0958", None]
    table_of(texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op1_pii(spark, str(tmp_path)).collect()}
    assert got[0].base_sha256 == hashlib.sha256(b"email:5:11,phone:15:31").hexdigest()
    assert (got[0].n_email, got[0].n_ip, got[0].n_card, got[0].n_phone) == (1, 0, 0, 1)
    assert got[1].base_sha256 == hashlib.sha256(b"").hexdigest() and got[1].spans == ""


def test_query_equals_its_sql_where_terms_disclose(spark, tmp_path, table_of):
    import duckdb
    from wordloom.llm.queries_native import _pii_sql, op1_pii

    told = [f"{w} zo@ex.org and then {w} some more of it, far from zorblat and Quuxy {'ab' * i}" for i, w in enumerate("cdefghij")]
    table_of(random_corpus() + told).write.parquet(f"{tmp_path}/documents.parquet")
    got = op1_pii(spark, str(tmp_path))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = db.execute(f"SELECT {', '.join(got.columns)} FROM ({_pii_sql()})").fetchall()
    rows = [tuple(r) for r in got.collect()]
    assert sorted(rows) == sorted(want) and sum(r[got.columns.index("n_term")] for r in rows) > 10
