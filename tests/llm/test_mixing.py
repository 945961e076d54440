import random

import pytest
from pyspark.sql import functions as F

from wordloom.llm import mixing


def corpus(spark, n=3000):
    rng = random.Random(1)
    rows = [(i, "w " * rng.choice([10, 300, 2500]), rng.choice(["en", "en", "de"]), rng.choice("aaaabc"), 0) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, kept int")


def shares(df, by, weight):
    rows = df.groupBy(by).agg(F.sum(weight).alias("w")).collect()
    total = sum(r.w for r in rows)
    return {r[0]: r.w / total for r in rows}


def test_raked_shares_meet_the_targets(spark):
    docs = corpus(spark)
    goals = {"source": {"a": 0.2, "b": 0.3, "c": 0.5}, "lang": {"en": 0.5, "de": 0.5}}
    targets = {d: spark.createDataFrame(list(g.items()), f"{d} string, target double") for d, g in goals.items()}
    out, names = mixing.sample_to_targets(docs, targets, sweeps=12)
    out = out.withColumn("w", F.col(names["n_tokens"]) * F.col(names["ratio"])).persist()
    for d, goal in goals.items():
        got = shares(out, d, "w")
        assert all(abs(got[v] - s) < 1e-3 for v, s in goal.items()), got
    kept = shares(out.filter(names["kept"]), "source", F.col(names["n_tokens"]))
    assert all(abs(kept[v] - s) < 0.08 for v, s in goals["source"].items()), kept
    assert out.agg(F.max(names["probability"])).first()[0] == 1.0
    assert "kept" in out.columns and names["kept"] != "kept"


def test_values_without_target_go(spark):
    docs = corpus(spark, 50)
    goal = spark.createDataFrame([("a", 1.0)], "source string, target double")
    out, names = mixing.sample_to_targets(docs, {"source": goal})
    assert {r.source for r in out.filter(names["kept"]).collect()} == {"a"}


def test_token_count(spark):
    texts = ["", " ", "a", " a\t\nb ", "a\x0bb\x1fc", "a\u00a0b", " " * 50_000 + "a" + " " * 50_000 + "b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(mixing.token_count(F.col("t")).alias("n"))
    assert [r.n for r in df.collect()] == [0, 0, 1, 2, 2, 1, 2]


def test_odd_rows(odd, odd_rows, none):
    out, names = mixing.sample_to_targets(odd)
    got = out.collect()
    assert len(got) == len(odd_rows)
    fate = {}
    for r in got:
        fate.setdefault((r.doc_id, r.text), set()).add(r[names["kept"]])
    assert all(len(f) == 1 for f in fate.values())
    out, names = mixing.sample_to_targets(none)
    assert out.collect() == []


def test_draw_is_even(spark):
    u = [r.u for r in spark.range(2000).select(mixing.draw(F.col("id"), "s").alias("u")).collect()]
    assert 0 <= min(u) and max(u) < 1 and abs(sum(u) / len(u) - 0.5) < 0.03
