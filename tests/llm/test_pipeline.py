import corpus_pipeline as cp
from wordloom.llm import near_dedup as nd, toxicity
from wordloom.llm.queries_corpus import held_out
from tests.llm.test_near_dedup import classes

FOLDER = "/root/testdata/sf0.001"


def test_every_stage_against_a_plain_one(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}

    stage = dict(cp.STAGES)
    calm = stage["toxicity"](spark, docs, FOLDER).collect()
    lexicon = toxicity.learn(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"), ~held_out(4))
    automaton = lexicon.automaton()
    for r in before.values():
        folded = toxicity.fold(r.text)
        bad = toxicity.score(lexicon, sum(toxicity.matches(automaton, folded).values()), max(folded.count(" ") - 1, 0)) >= 0.3
        assert (r in calm) != bad

    calm_df = spark.createDataFrame(calm, docs.schema)
    last = {}
    for r in sorted(calm):
        last[r.text] = r
    single = stage["exact_dedup"](spark, calm_df, FOLDER).collect()
    assert sorted(single) == sorted(last.values())

    single_df = spark.createDataFrame(sorted(single), docs.schema)
    want, _ = classes([r.text for r in sorted(single)], nd.document_frequencies(single_df, 5))
    apart = stage["near_dedup"](spark, single_df, FOLDER).collect()
    assert sorted(apart) == [r for i, r in enumerate(sorted(single)) if want[i] == i]

    mixed = stage["mixing"](spark, spark.createDataFrame(sorted(apart), docs.schema), FOLDER).collect()
    assert 0 < len(mixed) <= len(apart) and set(mixed) <= set(apart)


def test_run(spark):
    out = cp.run(spark, FOLDER)
    ids = {r.doc_id for r in out.collect()}
    assert ids <= {r.doc_id for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert {"doc_id", "piece", "sequence_id", "offset", "length"} <= set(out.columns)


def test_stages_on_odd_rows(odd, none, spark, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd, none):
        for name, stage in cp.STAGES:
            out = stage(spark, docs, str(tmp_path))
            out.collect()
            assert name == "packing" or out.columns == docs.columns
