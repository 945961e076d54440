"""Pages, ordering, vocabularies, statistics and sources on small fixtures."""

from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from wordloom.functions import text as tx
from wordloom.operators import grid, ordering, pages as pg, similarity, stats, vocabulary as vb
from wordloom.session import new_path
from wordloom.sources import jsonl, sinks


def page_rows(spark, *htmls):
    return spark.createDataFrame(list(enumerate(htmls)), "page_id bigint, html string")


def test_page_fragment(spark):
    html = ("<nav><p>menu one two three</p></nav><script>var t='</p>';</script>"
            "<article><p><b>One two three.<br><p>Four five six seven.</p><p>x y</p></article>")
    row = page_rows(spark, html).select(pg.article_text(pg.strip_boilerplate(F.col("html")))).first()
    assert row[0] == "One two three.\n\nFour five six seven."


def test_page_fields(spark):
    pages = page_rows(
        spark,
        "<meta property='og:title' content=' A &amp; B '><h1>x</h1><title>t</title>",
        "<h1> One <b>two</b></h1><title>t</title>",
        "<title> T&eacute;st &#38; </title>",
        "<p>none</p><!-- <h1>no</h1> -->",
        "<meta name='article:published_time' content='2024-05-06T07:08:09+00:00'>",
        "<meta itemprop=datePublished content='someday'><time datetime='06.05.2024'>x</time>",
        "<time>2024-05-06</time><meta content='Sport' property='article:section'>",
        "<p>at 2024-05-06T01:02:03 it</p><ul class='x breadcrumb'><li>Home</li><li>News</li></ul>",
        "<header><meta name='article:section' content='gone'></header><i class='breadcrumbs-x'>no</i>",
    )
    rows = pg.with_fields(pages).withColumn("d", pg.iso_date(F.col("date_local"), F.col("date_zone"))).orderBy("page_id").collect()
    assert [r.title for r in rows[:4]] == ["A & B", "Onetwo", "Tést &", None]
    assert [r.d for r in rows[4:8]] == [
        "2024-05-06T07:08:09+00:00", "2024-05-06T00:00:00", "2024-05-06T00:00:00", "2024-05-06T01:02:03"]
    assert [r.category for r in rows[6:]] == ["Sport", "Home News", None]


@pytest.mark.parametrize("raw, want", [
    ("Tue, 01 Dec 2026 10:00:00 GMT", "2026-12-01T10:00:00+00:00"),
    ("01 Dec 2026 10:00:00 +0530", "2026-12-01T10:00:00+05:30"),
    ("2026-12-01T10:00:00.123+05:00", "2026-12-01T10:00:00+05:00"),
    ("2026-12-01T10:00Z", "2026-12-01T10:00:00+00:00"),
    ("2026-12-01 10:00:00", "2026-12-01T10:00:00"),
    ("1 декабря 2026 г., 10:00", "2026-12-01T10:00:00"),
    ("Вторник, 1 Декабря 2026 в 10:00 МСК", "2026-12-01T10:00:00+03:00"),
    ("9 мая 2026", "2026-05-09T00:00:00"),
    ("December 1st, 2026 at 9:05 EST", "2026-12-01T09:05:00-05:00"),
    ("Sept. 3, 2026", "2026-09-03T00:00:00"),
    ("01.12.2026 10:00", "2026-12-01T10:00:00"),
    ("1/12/2026", "2026-12-01T00:00:00"),
    (" 2026-12-01 ", "2026-12-01T00:00:00"),
    ("2026-13-01", None), ("31 June 2026", None), ("2026-12-01 25:00", None), ("1 Foo 2026", None),
    ("2026-12-01T10:00 XQZ", None), ("soon", None), ("", None), (None, None),
])
def test_dates(apply, raw, want):
    assert apply(lambda c: pg.iso_date(*[pg.read_date(c)[k] for k in ("local", "zone")]), [raw]) == [want]


def test_moment_of_a_date(spark):
    pages = page_rows(spark, "<time>2026-12-01T01:00:00+05:00</time>", "<time>2026-12-01</time>")
    rows = pg.with_fields(pages, fields=["date"]).orderBy("page_id").collect()
    assert [r.date_ts.isoformat() for r in rows] == ["2026-11-30T20:00:00", "2026-12-01T00:00:00"]
    assert "title" not in rows[0].asDict() and "category" not in rows[0].asDict()


@pytest.mark.parametrize("html, want", [
    ("<div class=x><p class='breadcrumb'>A</p></div>", "A"),
    ("<div class='breadcrumb'><div>Home</div><div>News</div></div><div>no</div>", "Home News"),
    ("<ul class='breadcrumbs'><li>A<ul><li>B</ul><li>C</UL><ul>no</ul>", "A B C"),
    ("<div class='breadcrumb'><divider>A</divider><div><div>B</div></div></div>no", "A B"),
    ("<ol class='breadcrumb'></ol>no", ""),
    ("<div class='breadcrumb'><div>never closed</div>", None),
    ("<div>none</div>", None),
    ("<div class='breadcrumb'>" + "<div>x" * 300 + "</div>" * 301 + "no", " ".join("x" * 300)),
])
def test_balanced_elements(spark, html, want):
    df = page_rows(spark, html)
    assert pg.with_fields(df, fields=["category"]).first().category == want


def test_articles_drop_blank(spark):
    pages = spark.createDataFrame(
        [("http://a/1", "<p>Hello big world again</p>"), ("http://a/2", "<p>no</p>"), ("http://a/3", None)],
        "url string, html string")
    rows = pg.articles(pages).collect()
    assert [(r.url, r.text, r.title, r.date, r.category) for r in rows] == [
        ("http://a/1", "hello big world again", "", None, None)]


def test_links(spark):
    html = ("<a class='x' href='/a.JPG'>1</a><script>'<a href=\"/no\">'</script><!-- <a href='/c'> -->"
            "<a href=b?x=1&amp;y=2>2</a><a name=q>3</a><A HREF=\"mailto:x@y.z\">4</A>")
    pages = spark.createDataFrame([("https://s.ru/d/e", html)], "url string, html string")
    assert [r.href for r in pg.links(pages).orderBy("link_idx").collect()] == [
        "/a.JPG", "b?x=1&y=2", "mailto:x@y.z"]
    assert [r.link for r in pg.site_links(pages).collect()] == ["https://s.ru/d/b?x=1&y=2"]
    assert pg.site_links(pages, F.lit("other.ru")).count() == 0
    hosts = spark.createDataFrame([("aria.ru",), ("ria.ru",), ("x.ria.ru",), ("",)], "h string")
    keep = lambda **k: [r.h for r in hosts.filter(pg.on_domain(F.col("h"), F.lit("ria.ru"), **k)).collect()]
    assert keep() == ["aria.ru", "ria.ru", "x.ria.ru", ""] and keep(exact_suffix=True) == ["ria.ru", "x.ria.ru", ""]


def test_resolve_url(spark):
    bases = ["http://a.com/b/c/d?q#f", "https://a.com", "http://a.com:80/x/", "http://a.com/b/../c"]
    refs = ["", "g", "./g", "g/", "/g", "//h.org/p", "?y", "g?y", "#s", "g#s", "../g", "../..", "../../../g",
            "./", ".", "..", "g/./h/../i", "http://z.com/../k", "mailto:a@b", "/a/../b", "/./x", "g;x=1/../y", "..g"]
    df = spark.createDataFrame([(b, r) for b in bases for r in refs], "b string, r string")
    rows = df.withColumn("u", pg.resolve_url(F.col("b"), F.col("r"))).collect()
    wrong = {(r.b, r.r): (r.u, urljoin(r.b, r.r)) for r in rows if r.u != urljoin(r.b, r.r)}
    assert wrong == {}


@pytest.mark.parametrize("partitions", [1, 8])
def test_ordering(spark, partitions):
    counts = [120, 90, 300, 100, 50, 200]
    df = spark.createDataFrame(list(enumerate(counts)), "pos bigint, n bigint").repartition(partitions)
    long = df.filter("n >= 100")
    kept = ordering.budget_prefix(long, "pos", F.col("n"), 500)
    assert sorted(r.pos for r in kept.collect()) == [0, 2, 3]
    assert ordering.budget_prefix(long, "pos", F.col("n"), 10_000).count() == 4
    assert ordering.budget_prefix(long, "pos", F.col("n"), 0).count() == 0
    assert sorted(r.pos for r in ordering.first_n(df, "pos", 4).collect()) == [0, 1, 2, 3]
    assert ordering.first_n(df, "pos", 0).count() == 6
    train = ordering.split_train_test(df, "pos").filter("is_train")
    assert sorted(r.pos for r in train.collect()) == [0, 1, 2, 3]
    assert ordering.split_train_test(df.limit(1), "pos").filter("is_train").count() == 0
    assert ordering.split_train_test(df.limit(0), "pos").count() == 0


def test_prefix_over_sparse_positions(spark):
    """Positions crowded at one end of a huge range, as hot as they come."""
    pos = [*range(50_000), 2**40, 2**61, 2**62]
    df = spark.createDataFrame([(p,) for p in pos], "pos bigint")
    for n in (1, 4_095, 4_097, 49_999, 50_000, 50_001, 50_003):
        assert ordering.prefix_end(df, "pos", F.lit(1), n) == pos[n - 1]
    assert ordering.prefix_end(df, "pos", F.lit(1), 50_004) is None


def test_sample(spark, documents):
    a = {r.doc_id for r in ordering.sample_n(documents, "doc_id", 20, seed=1).collect()}
    b = {r.doc_id for r in ordering.sample_n(documents.repartition(5), "doc_id", 20, seed=1).collect()}
    c = {r.doc_id for r in ordering.sample_n(documents, "doc_id", 20, seed=2).collect()}
    assert a == b and len(a) == 20 and a != c


def test_vocabulary_and_oov(spark):
    texts = ["a b c", "a d", "b c A", "c", "Z a e"]
    df = spark.createDataFrame(list(enumerate(texts)), "pos bigint, text string")
    out = grid.compare(df, "pos", "text", {"ws": tx.words}, ["none"], similarity_sample=10).first()
    assert (out.vocab_size, round(out.oov_pct, 6)) == (4, 66.666667)
    assert out.semantic_similarity == pytest.approx(1.0)
    words = tx.words(F.col("text"))
    inside = vb.oov_between(df.filter("pos = 3"), words, df, words).first()
    assert (inside.test_tokens, inside.oov_pct) == (1, 0.0)
    assert vb.oov_between(df.limit(0), words, df, words).first().oov_pct == 0.0


def test_grid_similarity_against_a_plain_loop(spark):
    from collections import Counter

    rows = [(0, "Cats cats dogs the"), (1, "the The, dogs"), (2, ""), (3, None), (4, "ponies running the")]
    df = spark.createDataFrame(rows, "pos bigint, text string")
    lemmas = spark.createDataFrame([("cats", "cat"), ("cats", "kat"), ("Cats", "cat")], "token string, lemma string")
    out = grid.compare(df, "pos", "text", {"ws": tx.words}, ["none", "porter"], lemmas)
    got = {r.normalizer: r.semantic_similarity for r in out.collect()}
    porter = {"Cats": "cat", "cats": "cat", "dogs": "dog", "ponies": "poni", "running": "run", "The,": "the,"}
    table = {"none": {}, "porter": porter, "lemma": {"cats": "cat", "Cats": "cat"}}
    for name, forms in table.items():
        total = 0.0
        for _, text in rows:
            own = Counter((text or "").lower().split())
            made = Counter(forms.get(t, t).lower() for t in (text or "").split())
            norm = sum(n * n for n in own.values()) * sum(n * n for n in made.values())
            total += sum(n * made[t] for t, n in own.items()) / norm ** 0.5 if norm else 0.0
        assert got[name] == pytest.approx(total / len(rows)), name


def test_seconds_of_combinations(spark):
    df = spark.createDataFrame([(i, "a b c") for i in range(20)], "pos bigint, text string")
    rows = grid.combination_seconds(df, "pos", "text", {"ws": tx.words}, {"none": lambda t: t}, 5).collect()
    assert [(r.tokenizer, r.normalizer, r.rows) for r in rows] == [("ws", "none", 5)] and rows[0].seconds > 0


def test_grid_all_combinations(spark, documents):
    lemmas = spark.createDataFrame([("the", "THE"), ("ing", "in")], "token string, lemma string")
    rows = grid.compare(documents, "doc_id", "text", lemmas=lemmas, similarity_sample=10).collect()
    assert len({(r.tokenizer, r.normalizer) for r in rows}) == 20
    by = {(r.tokenizer, r.normalizer): r for r in rows}
    for tok in ("naive", "regex", "rules", "wordpunct", "sentences"):
        assert by[tok, "porter"].vocab_size <= by[tok, "none"].vocab_size
    assert all(0 <= r.oov_pct <= 100 and 0 <= r.semantic_similarity <= 1 for r in rows)


def test_similarity(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>")
    got = [r[0] for r in df.select(similarity.cosine(F.col("a"), F.col("b"))).collect()]
    assert got == [pytest.approx(0.5 ** 0.5), 0.0]
    texts = spark.createDataFrame([(0, "a a b"), (1, "")], "pos bigint, text string")
    scores = similarity.bag_cosines(texts, "pos", F.col("text"), F.array(F.lit("a")))
    assert [r.cosine for r in scores.orderBy("pos").collect()] == [pytest.approx(2 / 5 ** 0.5), 0.0]
    empty = similarity.bag_cosines(texts, "pos", F.lit(None).cast("string"), F.array().cast("array<string>"))
    assert [r.cosine for r in empty.collect()] == [0.0, 0.0]
    embed = lambda t: F.array(F.length(t).cast("float"), F.lit(1.0).cast("float"))
    mean = similarity.mean_similarity(texts, "pos", F.col("text"), tx.words(F.col("text")), embed=embed)
    assert mean.first()[0] == pytest.approx(1.0)
    assert similarity.mean_similarity(texts.limit(0), "pos", F.col("text"), tx.words(F.col("text"))).first()[0] == 0.0


def test_statistics(spark):
    df = spark.createDataFrame([(v,) for v in [1, 1, 2, 4, 5, 5]], "v bigint")
    dist = stats.distribution(df, F.col("v"))
    row = stats.mean_and_median(dist).first()
    assert (row.n, row["mean"], row["median"]) == (6, 3.0, 3.0)
    assert [(r.bin, r.cnt) for r in stats.histogram(dist, 4).orderBy("bin").collect()] == [(1, 2), (2, 1), (4, 3)]
    assert stats.mean_and_median(dist.limit(0)).first()["mean"] == 0.0
    one = stats.histogram(dist.filter("value = 5"), 4).collect()
    assert [(r.bin, r.cnt) for r in one] == [(1, 2)]


def test_edit_distance(apply, spark):
    df = spark.createDataFrame([("kitten", "sitting"), ("😀a", "a"), ("", "")], "a string, b string")
    got = [r[0] for r in df.select(tx.normalized_edit_distance(F.col("a"), F.col("b"))).collect()]
    assert got == [pytest.approx(3 / 7), 0.5, 0.0]


# --- sources and sinks ------------------------------------------------------------------------

LINES = ['{"text":"x"}', '{"text":" x "}', '{"text":" "}', '{"text":5}', '{"text":null}', '{"title":"t"}', "bad",
         "", '{"text":true}', "[1]", '"s"', '{"text":"a"} b', '{"text":""}', '{"text":"y","n":{"k":[1]},"d":null}']


@pytest.fixture
def lines_path(spark):
    path = new_path(spark, "test-lines")
    spark.createDataFrame([(line,) for line in LINES], "value string").coalesce(1).write.text(path)
    return path


def test_readers(spark, lines_path):
    read = lambda mode, **k: [
        (r.pos, r.text) for r in jsonl.read_texts(spark, lines_path, mode, **k).orderBy("pos").collect()]
    assert read("lenient") == [(0, "x"), (1, " x "), (2, " "), (13, "y")]
    assert read("lenient", max_records=2) == [(0, "x"), (1, " x ")]
    assert read("lenient", max_records=0) == read("lenient")
    assert read("strict") == [(0, "x"), (1, "x"), (13, "y")]
    assert read("coerce") == [(0, "x"), (1, "x"), (3, "5"), (8, "True"), (13, "y")]
    assert read("coerce", max_records=3) == [(0, "x"), (1, "x"), (3, "5")]
    assert read("strict", text_field="title") == [(5, "t")]
    with pytest.raises(ValueError):
        read("other")


def test_line_numbers_over_splits(spark, tmp_path):
    for name, n in (("b", 700), ("a", 900)):
        (tmp_path / f"{name}.jsonl").write_text("".join(f"{name}{i}\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        rows = jsonl.number_lines(jsonl.read_lines(spark, str(tmp_path))).orderBy("pos").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.line for r in rows] == [f"a{i}" for i in range(900)] + [f"b{i}" for i in range(700)]
    assert [r.pos for r in rows] == list(range(1600))


def test_lossy_decoding(spark, tmp_path):
    (tmp_path / "x.jsonl").write_bytes(b'{"text":"caf\xe9 ok"}\n')
    assert [r.text for r in jsonl.read_texts(spark, str(tmp_path)).collect()] == ["caf� ok"]


def test_record_passthrough(spark):
    import json

    df = spark.createDataFrame([(i, line) for i, line in enumerate(LINES)], "i int, line string")
    out = jsonl.transform_records(df, lambda t: F.upper(tx.trim_ws(t)))
    kept, rejected = jsonl.quarantine(out)
    got = {r.i: json.loads(r.record_json) for r in kept.collect()}
    assert got == {0: {"text": "X"}, 1: {"text": "X"}, 2: {"text": ""}, 4: {"text": None}, 5: {"title": "t"},
                   12: {"text": ""}, 13: {"text": "Y", "n": {"k": [1]}, "d": None}}
    assert {r.i: r.reason for r in rejected.collect()} == {
        3: "text is BIGINT", 6: "malformed json", 7: "blank line", 8: "text is BOOLEAN", 9: "not an object",
        10: "not an object", 11: "malformed json"}


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("t", "é\nx", None, "u", None)],
                                 "title string, text string, date string, url string, category string")
    sinks.append_articles(rows, str(tmp_path / "a"))
    sinks.append_articles(rows, str(tmp_path / "a"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "a")).collect()]
    assert lines == ['{"title":"t","text":"é\\nx","date":null,"url":"u","category":null}'] * 2
    sinks.write_plain_corpus(rows, str(tmp_path / "p"))
    assert [r.value for r in spark.read.text(str(tmp_path / "p")).collect()] == ["é x"]
    metrics = spark.createDataFrame([("a\"b", 0.00005, None)], "n string, x double, y double")
    sinks.write_csv(sinks.format_metrics(metrics, ["x", "y"]), str(tmp_path / "c"))
    back = sinks.read_csv(spark, str(tmp_path / "c"), "n string, x string, y string").first()
    assert tuple(back) == ('a"b', "0.0001", None)


@pytest.mark.parametrize("bound", [500_000, 1])
def test_stop_word_join_small_and_large(spark, monkeypatch, bound):
    """The broadcast and the salted join give the same rows, one key being hot."""
    monkeypatch.setattr(vb, "BROADCAST_ROWS", bound)
    texts = ["the cat the", "the the the dog", "a the"] * 20
    df = spark.createDataFrame(list(enumerate(texts)), "pos bigint, text string")
    stop = spark.createDataFrame([("the",), ("a",), ("zzz",)], "token string")
    rows = vb.remove_stop_words(df, "pos", tx.words(F.col("text")), stop).collect()
    want = [(p, i, w) for p, t in enumerate(texts) for i, w in enumerate(t.split()) if w not in ("the", "a")]
    assert sorted((r.pos, r.idx, r.token) for r in rows) == want


def test_sketches_unite(spark, documents):
    words = tx.words(F.col("text"))
    exact = vb.vocabulary_size(documents, words).first()[0]
    halves = documents.withColumn("half", F.col("doc_id") % 2)
    parts = vb.vocabulary_sketches(halves, words, ["half"])
    united = vb.united_vocabulary_size(parts).first()[0]
    whole = vb.united_vocabulary_size(vb.vocabulary_sketches(documents, words)).first()[0]
    # One set of tokens, but a sketch estimates otherwise than a union of sketches.
    assert abs(united - whole) < 0.01 * exact
    assert all(abs(n - exact) < 4 * 0.008 * exact for n in (united, whole))
    assert {r.half for r in vb.united_vocabulary_size(parts, ["half"]).collect()} == {0, 1}
    assert vb.united_vocabulary_size(parts.limit(0)).first()[0] == 0


def test_approximate_vocabulary_size(documents):
    words = tx.words(F.col("text"))
    exact = vb.vocabulary_size(documents, words).first()[0]
    assert abs(vb.vocabulary_size(documents, words, approximate=True).first()[0] - exact) < 0.05 * exact


def test_grid_similarity_of_documents_cut_by_batches(spark):
    """Documents whose rows come in several Arrow batches, and more than one document in a batch."""
    rows = [(i, " ".join(f"w{(i * j) % 7}" for j in range(1 + i))) for i in range(12)] + [(None, "lost Lost"), (3, "more")]
    df = spark.createDataFrame(rows, "pos bigint, text string")
    scores = {}
    for size in (3, 10_000):
        before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            scores[size] = grid.compare(df, "pos", "text", {"ws": tx.words}, ["none", "porter"]).collect()
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert {(r.normalizer, round(r.semantic_similarity, 9)) for r in scores[3]} == {
        (r.normalizer, round(r.semantic_similarity, 9)) for r in scores[10_000]}


def test_grid_sends_a_row_for_a_token_of_a_document(spark, documents):
    """Neither tokenizers nor normalizers multiply what goes from task to task."""
    from wordloom.functions import normalizers as nz, tokenizers as tk

    tokens = documents.select(F.explode(tx.words(F.col("text"))).alias("token")).distinct()
    forms = grid.token_forms(tokens, nz.NORMALIZERS)
    out = grid.vector_similarity(documents, "doc_id", "text", tk.TOKENIZERS, forms, list(nz.NORMALIZERS))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("MapInArrow")]
    assert "Generate" not in above  # nothing is spelled out as rows after the join


def test_bag_cosines_shuffle_texts_only(spark):
    """Terms are grouped where their document is, rows of one key together."""
    texts = spark.createDataFrame([(0, "a a b"), (1, "c"), (1, "C d"), (2, None)], "pos bigint, text string")
    out = similarity.bag_cosines(texts, "pos", F.col("text"), tx.words(F.col("text")))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(pos") == plan.count("Exchange") == 1 and ", term" not in plan.split("Exchange")[1].split("\n")[0]
    rows = {r.pos: r.cosine for r in out.collect()}
    assert rows == {0: pytest.approx(1.0), 1: pytest.approx(3 / 15 ** 0.5), 2: 0.0}


@pytest.mark.parametrize("frequent", [0, 3, 200_000])
def test_grid_similarity_whatever_is_listed_as_frequent(spark, documents, monkeypatch, frequent):
    """Forms worked out in place are those of the table, and documents' rows stay where they are."""
    rows = [(0, "Cats cats Dogs the, the"), (1, "the The, dogs PONIES"), (2, ""), (3, None), (4, "ponies running the"), (4, "Cats")]
    df = spark.createDataFrame(rows, "pos bigint, text string")
    lemmas = spark.createDataFrame([("cats", "cat"), ("cats", "kat"), ("Cats", "Cat"), ("ponies", "pony")], "token string, lemma string")
    monkeypatch.setattr(grid, "FREQUENT", frequent)
    names, plans, similarity = ["none", "porter", "lemma"], [], grid.vector_similarity
    monkeypatch.setattr(grid, "vector_similarity", lambda *a: plans.append(similarity(*a)) or plans[-1])
    got = grid.compare(df, "pos", "text", {"ws": tx.words, "naive": grid.tk.naive}, names[:2], lemmas)
    tokens = df.select(F.explode(tx.words(F.col("text"))).alias("token")).union(df.select(F.explode(grid.tk.naive(F.col("text"))))).distinct()
    forms = grid.token_forms(tokens, {n: grid.nz.NORMALIZERS[n] for n in names[:2]}, lemmas)
    want = similarity(df, "pos", "text", {"ws": tx.words, "naive": grid.tk.naive}, forms, names)
    key = lambda r: (r.tokenizer, r.normalizer, round(r.semantic_similarity, 9))
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
    physical = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in physical and "BroadcastHashJoin" in physical


def test_metrics_tokenize_once_for_their_lemmas(spark, monkeypatch, documents, tmp_path):
    """The grid and its seconds share one lemma table, and that tokenizes the texts once."""
    from wordloom.plans import source_queries, token_queries

    documents.filter("doc_id < 30").write.parquet(f"{tmp_path}/documents.parquet")
    made, stored, build, keep = [], [], token_queries.lemma_lookup, token_queries.materialize
    monkeypatch.setattr(token_queries, "lemma_lookup", lambda *a: made.append(1) or build(*a))
    monkeypatch.setattr(token_queries, "materialize", lambda df, label: stored.append(label) or keep(df, label))
    monkeypatch.setattr(token_queries, "_TIMED_ROWS", 5)
    assert source_queries.metrics_csv(spark, str(tmp_path)).count() == 20
    assert made == [1] and stored == ["counts", "lemmas"]
