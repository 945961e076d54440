"""Subword training and encoding, with the public ``tokenizers`` package as oracle."""

import json
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, normalizers, pre_tokenizers, trainers

from wordloom.functions import kernels, tokenizers as tk
from wordloom.functions.kernels import edit_fraction
from wordloom.operators.subword import batch, encode, evaluate, grid, merging, model as md, registry, types as ty, unigram
from wordloom.plans import subword_queries
from wordloom.session import exists, new_path


def library(model, trainer, texts):
    tok = Tokenizer(model)
    tok.normalizer = normalizers.Sequence([normalizers.NFKC()])
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    tok.train_from_iterator([t.replace("\n", " ") for t in texts], trainer)
    return tok


def library_bpe(texts, size, min_frequency):
    trainer = trainers.BpeTrainer(vocab_size=size, min_frequency=min_frequency, special_tokens=["[UNK]"],
                                  show_progress=False)
    return library(models.BPE(unk_token="[UNK]"), trainer, texts)


@pytest.fixture(scope="module")
def texts(spark):
    return [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()]


@pytest.fixture(scope="module")
def types(spark):
    return ty.word_types(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).cache()


@pytest.fixture(scope="module")
def bpe(types):
    return merging.train_bpe(types, 260, 3)


def check_merges(model, tok):
    spec = json.loads(tok.to_str())["model"]
    assert [[model.vocab[l], model.vocab[r]] for l, r in model.merges] == spec["merges"]
    assert {t: i for i, t in enumerate(model.vocab)} == spec["vocab"]


def test_bpe_equals_library(bpe, texts):
    check_merges(bpe, library_bpe(texts, 260, 3))


@pytest.mark.parametrize("contexts", [100_000, 300])
def test_bpe_equals_library_with_few_contexts(types, texts, contexts):
    """Fewer contexts mean fewer merges a round and the same merges."""
    check_merges(merging.train(types, 500, 3, "bpe", contexts), library_bpe(texts, 500, 3))


def test_bpe_of_full_size_equals_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    check_merges(merging.train_bpe(ty.word_types(docs), 8_000, 2), library_bpe(texts, 8_000, 2))


def test_decide_stops_at_the_bar():
    symbols = ["", "a", "b", "c"]

    def spell(l, r):
        text = symbols[l] + symbols[r]
        if text in symbols:
            return symbols.index(text), True
        symbols.append(text)
        return len(symbols) - 1, False

    contexts = [([1, 2, 3], 5), ([1, 2], 4), ([2, 3], 2)]
    assert merging.decide(contexts, (6, 3, 1), 1, spell) == [(1, 2, 4)]
    assert merging.decide(contexts, None, 3, spell) == [(1, 2, 4)]  # a known symbol ends the round


def test_bpe_repeated_characters(spark):
    words = {"aaaa": 5, "aaab": 7, "abab": 4, "aabaa": 3, "bbbbb": 6, "xyzxyz": 9, "a": 50, "zyx": 2}
    df = spark.createDataFrame(list(words.items()), "word string, cnt bigint")
    corpus = [" ".join([w] * n) for w, n in words.items()]
    check_merges(merging.train_bpe(df, 60, 2), library_bpe(corpus, 60, 2))


def test_truncated_model_is_the_smaller_training(bpe, types):
    small, trained = bpe.truncated(150), merging.train_bpe(types, 150, 3)
    assert (small.vocab, small.merges) == (trained.vocab, trained.merges)


def encoded(model, words):
    fn = encode.encoder(model)
    return [fn(w) for w in words]


def test_bpe_encode_equals_library(bpe, texts):
    tok = library_bpe(texts, 260, 3)
    for text in [*texts[:30], "日本 the 😀x", ""]:
        want = tok.encode(text)
        pre = [w for w, _ in pre_tokenizers.Whitespace().pre_tokenize_str(text)]
        got = encoded(bpe, pre)
        assert [t for ts, _ in got for t in ts] == want.tokens and [i for _, ids in got for i in ids] == want.ids


def test_corpus_encode_equals_library(spark, bpe, texts, documents):
    tok = library_bpe(texts, 260, 3)
    col = encode.encode_column(spark, bpe, F.col("text"))
    rows = documents.select("doc_id", col.alias("e")).orderBy("doc_id").collect()
    for row, text in zip(rows, texts):
        want = tok.encode(text)
        assert (row.e.tokens, row.e.ids) == (want.tokens, want.ids)


def test_wordpiece(types, texts):
    model = merging.train_wordpiece(types, 260, 3)
    assert len(model.vocab) == 260 and len(set(model.vocab)) == 260
    tok = Tokenizer(models.WordPiece({t: i for i, t in enumerate(model.vocab)}, unk_token="[UNK]",
                                     max_input_chars_per_word=100))
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    for text in [*texts[:30], "日本 the", "x" * 101, "t" * 100]:
        want = tok.encode(text)
        got = encoded(model, [w for w, _ in pre_tokenizers.Whitespace().pre_tokenize_str(text)])
        assert [t for ts, _ in got for t in ts] == want.tokens and [i for _, ids in got for i in ids] == want.ids
    trainer = trainers.WordPieceTrainer(vocab_size=260, min_frequency=3, special_tokens=["[UNK]"], show_progress=False)
    theirs = set(library(models.WordPiece(unk_token="[UNK]"), trainer, texts).get_vocab())
    assert len(theirs & set(model.vocab)) >= 250


@pytest.fixture(scope="module")
def uni(types):
    return unigram.train_unigram(types, 200)


def test_unigram_training(uni, types, texts):
    assert len(uni.vocab) == 200 and uni.vocab[0] == "[UNK]" and uni.scores[0] == 0.0
    assert set(ty.alphabet(types)) <= set(uni.vocab)
    trainer = trainers.UnigramTrainer(vocab_size=200, unk_token="[UNK]", special_tokens=["[UNK]"], show_progress=False)
    theirs = library(models.Unigram(), trainer, texts)
    ours_len = sum(len(ids) for t in texts for _, ids in encoded(uni, [
        w for w, _ in pre_tokenizers.Whitespace().pre_tokenize_str(t.replace("\n", " "))]))
    theirs_len = sum(len(theirs.encode(t.replace("\n", " ")).ids) for t in texts)
    assert ours_len <= 1.1 * theirs_len


def substrings(types, longest):
    counts = {}
    for r in types.collect():
        for i in range(len(r.word)):
            for n in range(1, longest + 2):
                if i + n <= len(r.word):
                    counts[r.word[i:i + n]] = counts.get(r.word[i:i + n], 0) + r.cnt
    most = {}
    for p, n in counts.items():
        most[p[:-1]] = max(most.get(p[:-1], 0), n)
    return {p: n for p, n in counts.items() if len(p) <= longest and (len(p) == 1 or n >= 2 and n > most.get(p, 0))}


@pytest.mark.parametrize("parts", [1, 8, 61])
def test_seeds_against_brute_force(spark, types, parts):
    """Repeats that go over the borders of range partitions included."""
    odd = spark.createDataFrame([("aaaaaaaaaaaaaaaaaaaaaaaa", 3), ("abab" * 9, 1), ("ab", 1), ("x", 1), ("日本日本", 2), ("a" * 40, 1)], "word string, cnt bigint")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        for df in (odd, types.limit(3_000).unionByName(odd) if parts == 8 else odd):
            df = df.groupBy("word").agg(F.sum("cnt").alias("cnt"))
            assert {r.piece: r.cnt for r in unigram.seed_pieces(df).collect()} == substrings(df, 16)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("parts", [1, 8, 61])
def test_every_seed_against_brute_force(spark, parts):
    """Repeats that one character always follows included."""
    words = {"a" * 24: 3, "abab" * 9: 1, "ab": 1, "x": 1, "日本日本": 2, "a" * 40: 1, "unique": 1, "repeated": 5}
    df = spark.createDataFrame(list(words.items()), "word string, cnt bigint")
    counts = {}
    for w, n in words.items():
        for i in range(len(w)):
            for k in range(1, min(16, len(w) - i) + 1):
                counts[w[i:i + k]] = counts.get(w[i:i + k], 0) + n
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r.piece: (r.cnt, r.score) for r in unigram.seed_pieces(df, every=True).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == {p: (n, n * len(p)) for p, n in counts.items() if len(p) == 1 or n >= 2}


def test_seeds_of_a_very_long_word(spark):
    df = spark.createDataFrame([("".join(chr(97 + (i * i + i // 7) % 26) for i in range(1_000_000)), 1)], "word string, cnt bigint")
    row = unigram.seed_pieces(df).agg(F.count("*"), F.max("cnt"), F.sum(F.when(F.length("piece") == 1, F.col("cnt")))).first()
    assert row[0] > 26 and row[2] == 1_000_000


@pytest.mark.parametrize("viterbi", [False, True])
def test_unigram_counts_of_lattices_against_words_one_by_one(spark, viterbi):
    """Long, very frequent and very unlikely words included, and pieces that are gone."""
    import random

    import numpy as np

    draw = random.Random(3)
    words = {"".join(draw.choice("abcé") for _ in range(draw.randint(1, 30))): draw.randint(1, 9) for _ in range(300)}
    words |= {"ab" * 300: 2, "abc" * 50: 1, "z": 4, "cab": 1 << 33, "z" * 200: 3}
    names = sorted({w[i:i + k] for w in list(words)[:40] for i in range(len(w)) for k in range(1, 6)} | set("abcéz"))
    lengths = np.array([len(p) for p in names])
    scores = np.array([np.nan if len(p) > 1 and draw.random() < .4 else -40.0 if p == "z" else -draw.random() * 6 for p in names])
    shared = spark.sparkContext.broadcast(names)
    rows = spark.createDataFrame([(0, w, n) for w, n in words.items()], "id int, word string, cnt bigint").repartition(3)
    lattice = rows.mapInArrow(unigram._lattices(shared), unigram._LATTICE)
    got = unigram._count_job(lattice, shared, lengths, scores, viterbi)
    table = {p: x for p, x in zip(names, scores.tolist()) if x == x}
    want = dict.fromkeys(names, 0.0)
    for w, n in words.items():
        uses = [(w[a:b], 1.0) for a, b, _ in unigram.best_path(w, table, 5)] if viterbi else unigram.expected_counts(w, table, 5).items()
        for piece, x in uses:
            want[piece] += n * x
    assert got.tolist() == pytest.approx([want[p] for p in names], rel=1e-6, abs=1e-5)


def test_unigram_losses_against_best_paths(spark):
    import numpy as np

    names = ["a", "aa", "aaa", "ab", "aba", "abab", "b", "bab"]
    scores = np.array([-1.0, -1.5, -2.5, -1.2, -3.0, -2.0, np.nan, -2.2])
    used = np.arange(8.0)
    shared = spark.sparkContext.broadcast(names)
    rows = spark.createDataFrame([(i, w, 1) for i, w in enumerate(names) if len(w) > 1], "id int, word string, cnt bigint")
    got = unigram._losses(rows.mapInArrow(unigram._lattices(shared), unigram._LATTICE), scores, used)
    table = {p: x for p, x in zip(names, scores.tolist()) if x == x}
    for i, piece in enumerate(names):
        if len(piece) > 1:
            path = unigram.best_path(piece, table, 4, skip=piece)
            want = float("inf") if path is None else used[i] / used.sum() * (table[piece] - sum(table[piece[a:b]] for a, b, _ in path))
            assert got[i] == pytest.approx(want), piece


def test_unigram_model_is_the_same_however_dealt(spark, types):
    sizes = unigram.train_unigram_sizes(types.coalesce(1), [900, 300])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 3)
    try:
        assert unigram.train_unigram(types.repartition(7), 300) == sizes[300]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert (len(sizes[900].vocab), len(sizes[300].vocab)) == (900, 300)


def test_unigram_encode_equals_library(uni, texts):
    tok = Tokenizer(models.Unigram(list(zip(uni.vocab, uni.scores)), unk_id=0))
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    for text in [*texts[:30], "日本 the", "theный", "xZ😀😀y"]:
        want = tok.encode(text)
        got = encoded(uni, [w for w, _ in pre_tokenizers.Whitespace().pre_tokenize_str(text)])
        assert [t for ts, _ in got for t in ts] == want.tokens and [i for _, ids in got for i in ids] == want.ids


def test_encoders_remember_within_a_bound(bpe):
    """By characters, so that many words or long ones don't fill a worker; the tokens are the same."""
    import tracemalloc

    words = [f"{i:x}th" * (1 + i % 9) for i in range(30_000)]
    plain = encode.encoder(bpe, remember=0)
    for remember in (0, 50, encode._REMEMBER):
        fn = encode.encoder(bpe, remember)
        assert [fn(w) for w in words[:300] * 2] == [plain(w) for w in words[:300] * 2]
    tracemalloc.start()
    fn = encode.encoder(bpe)
    for w in words:
        fn(w * 4)
    kept, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert kept < 100 * encode._REMEMBER


def test_save_and_load(spark, bpe, uni):
    for model in (bpe, uni):
        path = new_path(spark, "test-model")
        md.save(spark, model, path)
        assert md.load(spark, path) == model


def test_registry(spark, bpe, uni):
    root, calls = new_path(spark, "test-models"), []
    train = lambda: calls.append(1) or {"b": bpe, "u": uni}
    assert registry.trained(spark, root, train) == registry.trained(spark, root, train) == {"b": bpe, "u": uni}
    assert calls == [1] and registry.load_all(spark, root, ["u"]) == {"u": uni}
    assert {(r.model, r.kind, r.learned_size) for r in registry.listed(spark, root).collect()} == {
        ("b", "bpe", len(bpe.vocab)), ("u", "unigram", len(uni.vocab))}
    with pytest.raises(KeyError):
        registry.load_all(spark, root, ["w"])
    registry.forget(spark, root)
    assert not exists(spark, root)


def test_evaluate_against_a_plain_loop(spark, bpe, uni, documents, texts):
    sample = documents.filter("doc_id < 12")
    rows = {r.model: r for r in evaluate.evaluate(sample, {"bpe": bpe, "uni": uni}).collect()}
    for key, model in (("bpe", bpe), ("uni", uni)):
        fn = encode.encoder(model)
        cut = lambda t: [x for w, _ in pre_tokenizers.Whitespace().pre_tokenize_str(t) for x in fn(w)[0]]
        words = [len(cut(w)) for t in texts[:12] for w in t.split()]
        back = [" ".join(x for x in cut(t) if x != "[UNK]") for t in texts[:12]]
        r = rows[key]
        assert (r.total_lines, r.total_words, r.total_tokens) == (12, len(words), sum(max(1, n) for n in words))
        assert r.fragmented_words == sum(n > 1 for n in words)
        assert r.frag_percent == pytest.approx(100 * r.fragmented_words / len(words))
        assert r.compression_ratio == pytest.approx(len(words) / r.total_tokens)
        assert r.reconstruction_exact_frac == pytest.approx(sum(a == b for a, b in zip(back, texts)) / 12)
        assert r.avg_normalized_edit_distance == pytest.approx(
            sum(edit_fraction(a, b) for a, b in zip(back, texts)) / 12)


def test_lossless_reconstruction(bpe, documents):
    row = evaluate.reconstruction(documents, {"bpe": bpe}, lossless=True).first()
    assert (row.reconstruction_exact_frac, row.avg_normalized_edit_distance) == (1.0, 0.0)


def test_token_statistics(spark, bpe, documents, texts):
    extra = spark.createDataFrame([(10_000, "日本 the 日")], "doc_id bigint, text string")
    docs = documents.unionByName(extra)
    counts, words = evaluate.token_counts(docs, {"bpe": bpe}), evaluate.word_counts(docs, {"bpe": bpe})
    row = evaluate.token_statistics(counts, words).first()
    tok = library_bpe(texts, 260, 3)
    enc = [tok.encode(t).tokens for t in [*texts, "日本 the 日"]]
    assert row.total_tokens == sum(map(len, enc)) and row.unk_count == row.unk_by_string == 3
    assert row.oov_ratio == pytest.approx(3 / row.total_tokens)
    lengths = evaluate.token_length_distribution(counts)
    assert lengths.agg(F.sum("cnt")).first()[0] == row.total_tokens


def test_training_grid(documents):
    rows = grid.training_grid(documents.filter("doc_id < 60"), (120, 140), 3).collect()
    assert [(r.model, r.vocab_size) for r in sorted(rows, key=lambda r: (r.model, r.vocab_size))] == [
        (k, s) for k in ("bpe", "unigram", "wordpiece") for s in (120, 140)]
    assert all(exists(documents.sparkSession, r.model_file) for r in rows)
    assert all((r.min_frequency is None) == (r.model == "unigram") for r in rows)
    by = {(r.model, r.vocab_size): r for r in rows}
    assert by["bpe", 140].total_tokens <= by["bpe", 120].total_tokens


def test_pretokens_match_library(apply, texts):
    odd = ["क्षि a‍b x_y—z", "１２ ﬁ Ⅷ", "a b\tc"]
    want = [[w for w, _ in pre_tokenizers.Whitespace().pre_tokenize_str(normalizers.NFKC().normalize_str(t))]
            for t in [*texts[:20], *odd]]
    assert apply(tk.subword_pretokens, [*texts[:20], *odd]) == want


def test_reconstruction_of_long_lines_needs_no_table(monkeypatch):
    """Lines that hold the continuation mark: the distance follows from counts, not from a quadratic comparison."""
    monkeypatch.setattr(kernels, "_bit_parallel", None)
    monkeypatch.setattr(kernels, "levenshtein", None)
    line = "ab #a, b\nab " * 20_000 + "b"
    model = md.SubwordModel("wordpiece", ["[UNK]", "a", "b", "#", ",", "##b"])
    words = [w for w, _ in pre_tokenizers.Whitespace().pre_tokenize_str(line)]
    shapes = [encode.shape(w, encode.encoder(model)(w)[0]) for w in words]
    assert all(s.spelled for s in shapes)
    tokens, marks = sum(s.tokens for s in shapes), sum(s.marks for s in shapes)
    # "ab" gets " ##" twice, "#" and "," a space before or behind them, and the line end becomes one.
    assert kernels.spaced_distance(line, "".join(words), tokens, marks) == 20_000 * (3 + 3 + 1 + 1 + 1)


def test_restored_and_counted_against_the_encoders(spark, bpe, uni):
    """Unknown characters, marks in the text, repeated white space, compatibility characters, empty and null lines."""
    wordpiece = md.SubwordModel("wordpiece", ["[UNK]", "t", "h", "e", "#", "##h", "##e", "##he"])
    models = {"bpe": bpe, "uni": uni, "wp": wordpiece}
    lines = ["the #the ##the", "the  the\n\nthe ", "日本 the", "ﬁ the", "", "the", "he#the,the", " ", None, "## [UNK] the"]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, text string")
    for lossless in (False, True):
        shared = encode.Shared(spark, models)
        pretokens = tk.subword_pretokens(F.col("text"))
        line = F.coalesce(F.array_join(pretokens, "") if lossless else F.col("text"), F.lit(""))
        got = {(r.i, r.x.model): r.x for r in df.select("i", shared.restored(pretokens, line, lossless).alias("x")).collect()}
        counted = {(r.i, r.x.model): r.x.n_tokens for r in df.select("i", shared.counted(pretokens).alias("x")).collect()}
        for i, text in enumerate(lines):
            words = [w for w, _ in pre_tokenizers.Whitespace().pre_tokenize_str(normalizers.NFKC().normalize_str(text or ""))]
            for key, model in models.items():
                tokens = [t for w in words for t in encode.encoder(model)(w)[0]]
                if lossless:
                    want, back = "".join(words), "".join(t[2:] if len(t) > 2 and t.startswith("##") else t for t in tokens)
                else:
                    want, back = text or "", " ".join(t for t in tokens if t != "[UNK]")
                assert (got[i, key].back.same, got[i, key].back.distance) == (want == back, edit_fraction(want, back)), (lossless, text, key)
                assert counted[i, key] == len(tokens)


def test_unigram_encoder_takes_the_best_path(uni):
    rng = random.Random(4)
    scores = dict(zip(uni.vocab[1:], uni.scores[1:]))
    unknown, longest = min(scores.values()) - unigram.UNKNOWN_PENALTY, max(map(len, scores))
    letters, fn = sorted({c for t in scores for c in t}) + ["日"], encode.encoder(uni)
    for _ in range(300):
        word = "".join(rng.choice(letters) for _ in range(rng.randint(0, 30)))
        known = [word[a:b] for a, b, k in unigram.best_path(word, scores, longest, unknown=unknown) if k]
        assert [t for t, i in zip(*fn(word)) if i] == known


def test_models_share_their_word_types(spark, tmp_path, texts, monkeypatch):
    """The corpus is cut into words once, not once for each kind of model."""
    calls, count = [], subword_queries.ty.word_types
    monkeypatch.setattr(subword_queries.ty, "word_types", lambda *a: calls.append(1) or count(*a))
    monkeypatch.setitem(subword_queries._SIZES, "unigram", 120)
    spark.createDataFrame([(i, t) for i, t in enumerate(texts[:20])], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    models = subword_queries._models(spark, str(tmp_path), *md.KINDS)
    assert list(models) == list(md.KINDS) and calls == [1]
    subword_queries.forget_models(spark, str(tmp_path))


@pytest.fixture(scope="module")
def few(spark, texts, tmp_path_factory):
    """A folder of forty documents, so that its full-size models are trained once for the tests."""
    folder = str(tmp_path_factory.mktemp("few"))
    spark.createDataFrame(list(enumerate(texts[:40])), "doc_id bigint, text string").write.parquet(f"{folder}/documents.parquet")
    yield folder
    subword_queries.forget_models(spark, folder)


def test_corpus_encode_gives_tokens_and_ids_of_the_full_size(spark, few, texts):
    tok = library_bpe(texts[:40], subword_queries.rules.VOCAB_SIZES[-1], 2)
    assert len(tok.get_vocab()) > 1_000
    for r in subword_queries.corpus_encode(spark, few).collect():
        want = tok.encode(texts[r.doc_id])
        assert (r.tokens, r.ids, r.n_tokens) == (" ".join(want.tokens), " ".join(map(str, want.ids)), len(want.ids))


def test_wordpiece_vocab_is_trained_until_no_pair_is_left(spark, few):
    """A vocabulary below the full size means that no two neighbours come together as often as asked for."""
    vocab = {r.token for r in subword_queries.wordpiece_vocab(spark, few).collect()}
    assert 1_000 < len(vocab) < subword_queries.rules.VOCAB_SIZES[-1]
    model = subword_queries._model(spark, few, "wordpiece", subword_queries._FULL)
    pieces = {i: t for i, t in enumerate(model.vocab)}
    assert vocab == set(pieces.values())
    words = [([pieces[i] for i in ids], r.cnt) for r, ids in _segmented(spark, few, model)]
    pairs = {}
    for tokens, cnt in words:
        for pair in zip(tokens, tokens[1:]):
            pairs[pair] = pairs.get(pair, 0) + cnt
    assert max(pairs.values()) < 2


def _segmented(spark, folder, model):
    """Word types with the symbols that the merges leave, replayed one by one."""
    index, mark = {t: i for i, t in enumerate(model.vocab)}, "##" if model.kind == "wordpiece" else ""
    rows = ty.word_types(spark.read.parquet(f"{folder}/documents.parquet")).collect()
    words = [[index[(mark if i else "") + c] for i, c in enumerate(r.word)] for r in rows]
    holders = {}
    for at, ids in enumerate(words):
        for i in ids:
            holders.setdefault(i, set()).add(at)
    for (left, right), new in zip(model.merges, model.merge_ids):
        for at in list(holders.get(left, set()) & holders.get(right, set())):
            ids, out = words[at], []
            for i in ids:
                if out and out[-1] == left and i == right:
                    out[-1] = new
                else:
                    out.append(i)
            words[at] = out
            holders.setdefault(new, set()).add(at)
    return zip(rows, words)


def test_full_vocabulary_ends_training(spark):
    """A merge that spells a known symbol needs no room, but comes too late once the vocabulary is full."""
    types = spark.createDataFrame([("###", 9)], "word string, cnt long")
    model = merging.train(types, 4, 2, "wordpiece")
    assert model.vocab == ["[UNK]", "#", "###", "##"] and len(model.merges) == 1


def test_evaluation_is_of_full_size_models(spark, few):
    kinds, size = {"bpe", "wordpiece", "unigram"}, subword_queries.rules.VOCAB_SIZES[-1]
    models = subword_queries._models(spark, few, *md.KINDS, sizes=dict.fromkeys(md.KINDS, size))
    docs = spark.read.parquet(f"{few}/documents.parquet")
    want = {r.model: r for r in evaluate.evaluate(docs, models).collect()}
    got = {r.model: r for r in subword_queries.evaluate_model(spark, few).collect()}
    assert got == want and set(got) == kinds
    stats = {r.model: r for r in subword_queries.model_token_stats(spark, few).collect()}
    assert set(stats) == kinds and all(r.distinct_tokens > 1_000 for r in stats.values())
    back = {r.model: r for r in subword_queries.reconstruction(spark, few).collect()}
    for kind in kinds:
        assert back[kind].reconstruction_exact_frac == round(want[kind].reconstruction_exact_frac, 6)
        assert back[kind].avg_normalized_edit_distance == round(want[kind].avg_normalized_edit_distance, 6)


def test_counts_of_many_words_against_the_encoders(spark, bpe, uni, types, texts):
    """Truncated, foreign and repeating models, unknown characters, marks, long words and words no WordPiece model covers."""
    models = {
        "bpe": bpe, "cut": bpe.truncated(150), "own": merging.train_bpe(types, 200, 40_000), "uni": uni,
        "few": md.SubwordModel("unigram", ["[UNK]", "a", "b", "ab", "ba", "aba"], [], [], [0.0, -1.0, -1.0, -2.0, -2.0, -3.0]),
        "wp": merging.train(types, 400, 3, "wordpiece"), "bare": md.SubwordModel("wordpiece", ["[UNK]", "a", "ab", "##b", "##ba"]),
        "runs": md.SubwordModel("bpe", ["[UNK]", "a", "b", "aa", "aaaa"], [(1, 1), (3, 3)], [3, 4], [], 3),
        "again": md.SubwordModel("bpe", ["[UNK]", "a", "aa", "aaa"], [(1, 1), (1, 2), (2, 1)], [2, 3, 3], [], 2),
    }
    rng = random.Random(5)
    words = sorted({w for t in texts[:30] for w in t.split()} | {"".join(rng.choice("ab") for _ in range(rng.randint(1, 25))) for _ in range(300)}
                   | {"a" * n for n in range(120)} | {"日", "a日b", "##a", "a##b", "[UNK]", "b" * 5_000})
    got = batch.Counter(models).counts(pa.array(words), words)
    for (name, model), counts in zip(models.items(), got):
        fn = encode.encoder(model, 0)
        for word, n in zip(words, counts.tolist()):
            want = encode.shape(word, fn(word)[0])
            assert n < 0 or want == encode.Shape(n, 2 * (n - 1) if model.kind == "wordpiece" else 0, True, True), (name, word)
    left = (got < 0).sum(axis=1)
    assert left[list(models).index("again")] == len(words) and left[list(models).index("runs")] < len(words)
    assert left[list(models).index("bpe")] < len(words) // 4


def test_sums_travel_in_few_rows_and_lose_no_bit(spark, monkeypatch):
    """Each task returns as many rows as there are parts, however many pieces it met, and large sums are exact."""
    monkeypatch.setattr(unigram, "_CARRY_AFTER", 3)
    rng = random.Random(6)
    values = [(rng.randrange(40), rng.choice([1, (1 << 40) - 1, 1 << 60, rng.randrange(1 << 50)])) for _ in range(300)]
    sums = [unigram._Sums(40) for _ in range(3)]
    for i, (piece, value) in enumerate(values):
        if value < 1 << 60:
            sums[i % 3].add(np.array([piece] * 2), np.array([value] * 2))
        else:
            sums[i % 3].add_one(piece, 2 * value)
    tasks = [s.parts(4) for s in sums]
    assert [t.num_rows for t in tasks] == [4, 4, 4]
    table, got = pa.Table.from_batches(tasks), [0] * 40
    for part in range(4):
        row = unigram._added(table.filter(pa.array([p == part for p in table.column("part").to_pylist()]))).to_pylist()[0]
        for i, low, high in zip(row["i"], row["low"], row["high"]):
            got[i] = (high << 40) + low
    want = [0] * 40
    for piece, value in values:
        want[piece] += 2 * value
    assert got == want
