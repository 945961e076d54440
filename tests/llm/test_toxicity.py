import random

import pytest
from pyspark.sql import functions as F

from wordloom.llm import toxicity as tx


def test_fold():
    same = ["idiot", "1d1ot", "IDIOT", "іdіοt", "id!ot", "i​diot", "ｉｄｉｏｔ", "idi0t"]
    assert {tx.fold(w) for w in same} == {" idiot "}
    assert tx.fold("lo5er, LOSER!") == " ioser ioser "
    assert tx.fold("") == "  " and tx.fold(" -- ") == "  "


def test_words_and_beginnings_and_exceptions():
    lexicon = tx.Lexicon({f" {tx.fold('scum').strip()} ": 3.0, " idio": 2.0}, (" pond scum ",))
    a = lexicon.automaton()
    assert sum(tx.matches(a, tx.fold("you scum and idiots")).values()) == 5.0
    assert tx.matches(a, tx.fold("scumble pond scum")) == {}
    assert len(tx.matches(a, tx.fold("scum scum"))) == 2
    assert tx.Lexicon().automaton() is None and tx.matches(None, " a ") == {}


def corpus(spark, n=1200):
    rng = random.Random(4)
    plain = [f"word{i}" for i in range(80)]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(20, 80))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(rng.randint(2, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "1d!ot", "scum", "mor0n"]))
        elif i % 60 == 1:
            words[5:5] = ["pond", "scum"]
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    return (spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string, hits int"),
            spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    lexicon = tx.learn(docs, labels, F.col("doc_id") % 4 != 2)
    assert " pond scum " in lexicon.exceptions and " idiot " in lexicon.weights
    scored, score, hits = tx.with_scores(docs, lexicon)
    assert score not in docs.columns and set(docs.columns) <= set(scored.columns)
    rows = scored.filter("doc_id % 4 = 2").select("doc_id", F.col(score).alias("s")).collect()
    right = sum((r.s >= 0.3) == (r.doc_id % 6 == 0) for r in rows)
    assert right / len(rows) > 0.97
    assert all(0 <= r.s <= 1 for r in rows)


def test_learning_reads_only_its_fold(spark):
    docs, labels = corpus(spark, 300)
    lexicon = tx.learn(docs, labels.withColumn("toxic", F.when(F.col("doc_id") % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic"))),
                       F.col("doc_id") % 4 != 2)
    assert lexicon == tx.learn(docs, labels, F.col("doc_id") % 4 != 2)


def test_odd_rows(odd, odd_rows, none, spark):
    lexicon = tx.Lexicon({" word ": 1.0})
    scored, score, hits = tx.with_scores(odd, lexicon)
    got = scored.collect()
    assert len(got) == len(odd_rows) and {r[hits] for r in got} == {0, 60_000}
    assert sorted(map(str, scored.select(*odd.columns).collect())) == sorted(map(str, odd.collect()))
    assert tx.with_scores(none, lexicon)[0].collect() == []
    no_labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert tx.learn(odd, no_labels, F.lit(True)).weights == {}
    some = spark.createDataFrame([(None, 1), (1, None), (1, 1), (1, 0), (99, 1)], "doc_id bigint, toxic int")
    assert tx.learn(odd, some, F.lit(True)).weights == {}
