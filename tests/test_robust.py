"""Inputs that used to lose rows, kill a task or stall it."""

import time

import pytest
from pyspark.sql import functions as F

from wordloom.functions import text as tx, tokenizers as tk
from wordloom.operators.subword import encode
from wordloom.operators.subword.model import SubwordModel
from wordloom.sources import jsonl


def timed(spark, text, fn):
    df = spark.createDataFrame([(text,)], "x string")
    start = time.time()
    out = df.select(fn(F.col("x")).alias("y")).first().y
    assert time.time() - start < 20
    return out


def test_long_hyphen_chain(spark):
    assert timed(spark, "a-" * 50_000 + "a b", tk.regex_words) == ["a-" * 50_000 + "a", "b"]
    assert timed(spark, "a-" * 50_000 + "a b", tk.rule_tokens) == ["a-" * 50_000 + "a", "b"]


def test_long_number_chain(spark):
    assert timed(spark, "1." * 50_000 + "1 2", tk.rule_tokens) == ["1." * 50_000 + "1", "2"]


def test_many_inner_spaces(spark):
    text = "a" + " " * 50_000 + "b"
    assert timed(spark, " " + text + " ", tx.trim_ws) == text


def test_bpe_of_a_very_long_word():
    vocab = ["[UNK]", "a", "b", "ab", "abab"]
    model = SubwordModel("bpe", vocab, merges=[(1, 2), (3, 3)], merge_ids=[3, 4])
    start = time.time()
    tokens, ids = encode.bpe_encoder(model)("ab" * 50_000)
    assert time.time() - start < 5
    assert ids == [4] * 25_000 and tokens[0] == "abab"
    assert encode.bpe_encoder(model)("aababb")[1] == [1, 4, 2]


def test_lines_survive_other_splits(spark, tmp_path):
    path = f"{tmp_path}/lines"
    rows = spark.range(0, 3000, 1, 3).select(F.to_json(F.struct(F.col("id").alias("text").cast("string").alias("text"))).alias("value"))
    rows.write.text(path)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        texts = jsonl.read_texts(spark, path)
        spark.conf.set(key, "1000")
        got = texts.orderBy("pos").collect()
    finally:
        spark.conf.set(key, before)
    assert [r.pos for r in got] == list(range(3000))
    assert [int(r.text) for r in got] == list(range(3000))


def test_coerce_limit_inside_a_line(spark, tmp_path):
    path = f"{tmp_path}/parts"
    lines = ['{"text": "a"}\x0b{"text": "b"}\x0b{"text": "c"}', '{"text": "d"}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    for n in (1, 2, 3, 4, 9):
        got = [r.text for r in jsonl.read_texts(spark, path, "coerce", max_records=n).collect()]
        assert sorted(got) == list("abcd")[:n]


@pytest.mark.parametrize("value", ["0", "0.0", "0e0", "0.00", "-0.0", "false", "null", '""', "[]", "{}"])
def test_falsy_texts_pass_through(spark, value):
    df = spark.createDataFrame([(f'{{"text": {value}, "k": 1}}',)], "line string")
    row = jsonl.transform_records(df, lambda t: F.upper(t)).first()
    assert row.reason is None and row.record_json is not None


def test_other_numbers_are_dropped(spark):
    df = spark.createDataFrame([('{"text": 0.5}',), ('{"text": true}',)], "line string")
    assert all(r.record_json is None for r in jsonl.transform_records(df, lambda t: F.upper(t)).collect())


def test_breadcrumb_is_a_class_of_its_own(spark):
    from wordloom.operators import pages

    html = ["<div class='my-breadcrumb'>no</div>", "<div class='a breadcrumb b'>yes</div>", '<nav></nav><ul class="breadcrumbs">too</ul>',
            '<p class="breadcrumb-item">no</p>']
    df = spark.createDataFrame([(i, f"<html><body>{h}</body></html>") for i, h in enumerate(html)], "page_id int, html string")
    got = {r.page_id: r.category for r in pages.with_fields(df).collect()}
    assert [got[i] for i in range(4)] == [None, "yes", "too", None]


def test_a_limit_opens_few_files(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"part {i:04d}.jsonl").write_text("".join(f'{{"text": "{i}-{k}"}}\n' for k in range(10)))
    path = str(tmp_path)
    files = jsonl.prefix_files(spark, path, 95)
    assert len(files) <= 16 and files[0].endswith("part 0000.jsonl")
    texts = [r.text for r in jsonl.read_texts(spark, path, "lenient", max_records=95).orderBy("pos").collect()]
    assert texts == [f"{n // 10}-{n % 10}" for n in range(95)]
    assert len(jsonl.prefix_files(spark, path, 10_000)) == 300


def test_abbreviations_from_a_table(spark):
    from wordloom.functions import text as tx

    table = spark.createDataFrame([(2, "b", "$1"), (1, "a.", "\\b"), (3, None, "x"), (4, "", "x"), (5, "c", None)], "ord int, short string, full string")
    df = spark.createDataFrame([("a. b c d",)], "text string")
    rows = tx.rule_table(table)
    assert rows == [("a.", "\\b"), ("b", "$1"), ("c", "")]
    assert df.select(tx.expand_abbreviations(F.col("text"), rows)).first()[0] == "\\$1 $1  d"
