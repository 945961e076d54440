"""Tokenizers, vocabularies, statistics, set operations and order operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from wordloom import rules
from wordloom.functions import normalizers as nz, text as tx, tokenizers as tk
from wordloom.operators import grid, ordering, pages, similarity, stats, vocabulary as vb
from wordloom.plans import sql
from wordloom.plans.registry import query
from wordloom.plans.text_queries import STOP_WORDS
from wordloom.session import materialize
from wordloom.sources.tables import table


def _regex(text="text"):
    return tk.regex_words(F.col(text), rules.LATIN_EXTRA)


def _lower_regex(text="text"):
    return tk.regex_words(F.lower(F.col(text)), rules.LATIN_EXTRA)


def _tokens(name, fn, sql_tokens):
    @query(name, None if sql_tokens is None else
           f"SELECT doc_id, {sql.join(sql_tokens)} AS tokens, len({sql_tokens})::BIGINT AS n_tokens "
           "FROM documents")
    def run(spark, d):
        out = table(spark, d, "documents").select("doc_id", fn(F.col("text")).alias("t"))
        return out.select(
            "doc_id", F.array_join("t", " ").alias("tokens"), F.size("t").cast("bigint").alias("n_tokens")
        )


_STRIP = sql.text(rules.NAIVE_STRIP)
_NAIVE = (f"list_filter(list_transform({sql.words('text')}, lambda v: trim(v, {_STRIP})), "
          "lambda v: v <> '')")
_RULES = r"""regexp_extract_all(text,
    '\p{Nd}+(?:[.,]\p{Nd}+)*|\p{L}[\p{L}\p{M}]*(?:-\p{L}[\p{L}\p{M}]*)*|\S')"""

_tokens("ws_tokens", tx.words, sql.words("text"))
_tokens("tok_naive", tk.naive, _NAIVE)
_tokens("tok_regex", lambda t: tk.regex_words(t, rules.LATIN_EXTRA), sql.regex_words("text"))
_tokens("tok_regex_default", tk.regex_words,
        f"regexp_extract_all(text, {sql.text(sql.plain_regex(tk.regex_pattern()))})")
_tokens("tok_rules", tk.rule_tokens, _RULES)
_tokens("tok_wordpunct", tk.wordpunct, sql.wordpunct("text"))
_SENTENCES = f"regexp_extract_all(text, {sql.text(sql.plain_regex(tk.SENTENCE_PATTERN).replace('[^' + rules.WS + ']', chr(92) + 'S'))})"
_tokens("tok_sentences", tk.sentence_tokens, _SENTENCES)
_tokens("tok_sentence_words", lambda t: tk.sentence_words(t, "en", "US"), None)


# --- token counts and vocabularies --------------------------------------------------------

_DOC_TOKENS = f"(SELECT doc_id, lang, source, unnest({sql.regex_words('lower(text)')}) AS token FROM documents)"
_COUNTS = f"SELECT token, count(*)::BIGINT AS cnt FROM {_DOC_TOKENS} GROUP BY token"


def _counts(spark, d, by=()):
    return vb.token_counts(table(spark, d, "documents"), _lower_regex(), by)


@query("token_freq", _COUNTS)
def token_freq(spark, d):
    return _counts(spark, d)


@query("top_tokens", f"{_COUNTS} ORDER BY cnt DESC, token LIMIT 50")
def top_tokens(spark, d):
    return vb.top_tokens(_counts(spark, d), 50)


@query("top_tokens_by_lang", f"""
    SELECT lang, token, cnt, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY cnt DESC, token)::BIGINT AS rank FROM (
            SELECT lang, token, count(*)::BIGINT AS cnt FROM {_DOC_TOKENS} GROUP BY lang, token))
    WHERE rank <= 20""")
def top_tokens_by_lang(spark, d):
    return vb.top_tokens_by(_counts(spark, d, ["lang"]), ["lang"], 20)


_SPLIT = """(SELECT *, row_number() OVER (ORDER BY doc_id) - 1 < floor(0.8 * count(*) OVER ()) AS is_train
    FROM documents)"""


@query("split_80_20", f"SELECT doc_id, is_train FROM {_SPLIT}")
def split_80_20(spark, d):
    docs = table(spark, d, "documents").select("doc_id")
    return ordering.split_train_test(docs, "doc_id", 0.8)


_TRAIN_VOCAB = f"""(SELECT DISTINCT token FROM (
    SELECT unnest({sql.regex_words('lower(text)')}) AS token FROM {_SPLIT} WHERE is_train))"""


@query("vocab_size", f"SELECT count(*)::BIGINT AS vocab_size FROM {_TRAIN_VOCAB}")
def vocab_size(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    train = ordering.split_train_test(docs, "doc_id").filter("is_train")
    return vb.vocabulary_size(train, _regex())


@query("vocab_size_approx")
def vocab_size_approx(spark, d):
    return vb.vocabulary_size(table(spark, d, "documents"), _regex(), approximate=True)


@query("vocab_size_sketches")
def vocab_size_sketches(spark, d):
    """Sketches by language and source, stored, and united by language."""
    docs = table(spark, d, "documents")
    stored = materialize(vb.vocabulary_sketches(docs, _lower_regex(), ["lang", "source"]), "sketches")
    return vb.united_vocabulary_size(stored, ["lang"])


@query("vocabulary", f"SELECT DISTINCT token FROM {_DOC_TOKENS}")
def vocabulary(spark, d):
    return vb.vocabulary(table(spark, d, "documents"), _regex())


_BENCH = f"(SELECT unnest({sql.regex_words('lower(text)')}) AS token FROM benchmark)"
_OOV = """SELECT count(*)::BIGINT AS test_tokens, count(*) FILTER (WHERE v.token IS NULL)::BIGINT AS oov_tokens,
    round(100.0 * count(*) FILTER (WHERE v.token IS NULL) / count(*), 6)::DOUBLE AS oov_pct FROM """


def _rounded(df, *names, places=6):
    return df.withColumns({n: F.round(n, places) for n in names})


@query("oov_rate", f"{_OOV} {_BENCH} t LEFT JOIN (SELECT DISTINCT token FROM {_DOC_TOKENS}) v USING (token)")
def oov_rate(spark, d):
    """Benchmark tokens that the documents do not hold."""
    out = vb.oov_between(table(spark, d, "benchmark"), _regex(), table(spark, d, "documents"), _regex())
    return _rounded(out, "oov_pct")


@query("oov_split", f"""{_OOV} (SELECT unnest({sql.regex_words('lower(text)')}) AS token FROM {_SPLIT}
    WHERE NOT is_train) t LEFT JOIN {_TRAIN_VOCAB} v USING (token)""")
def oov_split(spark, d):
    docs = ordering.split_train_test(table(spark, d, "documents").select("doc_id", "text"), "doc_id")
    counts = grid.token_table(docs, "doc_id", "text", {"regex": lambda t: _lower_regex()}, "is_train")
    return _rounded(counts.agg(*vb.oov_columns(F.col("train"), F.col("test"), with_size=False)), "oov_pct")


_CONV = f"(SELECT DISTINCT unnest({sql.regex_words('lower(text)')}) AS token FROM conversations)"
_DOCV = f"(SELECT DISTINCT token FROM {_DOC_TOKENS})"


def _vocabularies(spark, d):
    return (vb.vocabulary(table(spark, d, "conversations"), _regex()),
            vb.vocabulary(table(spark, d, "documents"), _regex()))


@query("oov_tokens", f"SELECT token FROM {_CONV} WHERE token NOT IN (SELECT token FROM {_DOCV})")
def oov_tokens(spark, d):
    return vb.unseen_tokens(*_vocabularies(spark, d))


@query("iv_tokens", f"SELECT token FROM {_CONV} WHERE token IN (SELECT token FROM {_DOCV})")
def iv_tokens(spark, d):
    return vb.seen_tokens(*_vocabularies(spark, d))


@query("vocab_union", f"SELECT token FROM {_CONV} UNION SELECT token FROM {_DOCV}")
def vocab_union(spark, d):
    a, b = _vocabularies(spark, d)
    return a.union(b).distinct()


@query("vocab_except", f"SELECT token FROM {_DOCV} EXCEPT SELECT token FROM {_CONV}")
def vocab_except(spark, d):
    a, b = _vocabularies(spark, d)
    return b.subtract(a)


@query("vocab_intersect", f"SELECT token FROM {_CONV} INTERSECT SELECT token FROM {_DOCV}")
def vocab_intersect(spark, d):
    a, b = _vocabularies(spark, d)
    return a.intersect(b)


# Words that make up at least this share of the corpus are the data-driven stop list.
_FREQUENT = 0.0025


@query("stopwords_join", f"""
    WITH rows AS (SELECT doc_id, unnest(w) AS token, unnest(range(len(w))) AS idx FROM (
        SELECT doc_id, {sql.words('lower(text)')} AS w FROM documents)),
    stop AS (SELECT token FROM rows GROUP BY token HAVING count(*) >= {_FREQUENT} * (SELECT count(*) FROM rows))
    SELECT doc_id, count(*)::BIGINT AS kept, sum(length(token))::BIGINT AS chars
    FROM rows WHERE token NOT IN (SELECT token FROM stop) GROUP BY doc_id""")
def stopwords_join(spark, d):
    """Stop words taken from the corpus itself, removed by an anti join."""
    docs, words = table(spark, d, "documents"), tx.words(F.lower("text"))
    counts = materialize(vb.token_counts(docs, words), "counts")
    total = counts.agg(F.sum("cnt").alias("n")).scalar()
    stop = counts.filter(F.col("cnt") >= F.lit(_FREQUENT) * total).select("token")
    kept = vb.remove_stop_words(docs, "doc_id", words, stop)
    return kept.groupBy("doc_id").agg(
        F.count("*").alias("kept"), F.sum(F.length("token")).alias("chars"))


_LEMMAS = f"""WITH c AS MATERIALIZED ({_COUNTS}),
    shorter AS MATERIALIZED (SELECT token AS lemma, token || 's' AS token FROM c)
    SELECT c.token, c.cnt, coalesce(lemma, c.token) AS lemma FROM c LEFT JOIN shorter ON shorter.token = c.token"""


@query("lemma_lookup", _LEMMAS)
def lemma_lookup(spark, d):
    """The lemma table pairs a token in -s with its shorter form where both occur."""
    counts = materialize(_counts(spark, d), "counts")  # the texts are tokenized once
    plural = counts.filter(F.col("token").endswith("s")).select(
        "token", F.expr("left(token, length(token) - 1)").alias("lemma"))
    lemmas = plural.join(counts.select(F.col("token").alias("lemma")), "lemma", "left_semi")
    return vb.lemmatize(counts, lemmas.select("token", "lemma"))


@query("stem_porter")
def stem_porter(spark, d):
    return _counts(spark, d).withColumn("stem", nz.porter(F.col("token")))


# The tables hold no Cyrillic: the letters are mapped to Cyrillic ones first.
_LATIN, _CYRILLIC = "abcdefghijklmnopqrstuvwxyz", "абцдефгхийклмнопярстувшхыз"


@query("stem_snowball_ru")
def stem_snowball_ru(spark, d):
    counts = _counts(spark, d).withColumn("token", F.translate("token", _LATIN, _CYRILLIC))
    return counts.withColumn("stem", nz.snowball_ru(F.col("token")))


# --- statistics -------------------------------------------------------------------------------

_WP = "(SELECT unnest(" + sql.wordpunct("text") + ") AS token FROM documents)"
_LENGTHS = f"SELECT length(token)::BIGINT AS value, count(*)::BIGINT AS cnt FROM {_WP} GROUP BY 1"
_WORDS = f"(SELECT unnest({sql.words('text')}) AS word FROM documents)"
_PER_WORD = f"SELECT len({sql.wordpunct('word')})::BIGINT AS value, count(*)::BIGINT AS cnt FROM {_WORDS} GROUP BY 1"


def _hist_sql(dist: str, bins: int) -> str:
    return f"""WITH d AS ({dist}), m AS (SELECT min(value)::DOUBLE lo, max(value)::DOUBLE hi FROM d)
        SELECT bin, round(bin_start, 6) AS bin_start, sum(cnt)::BIGINT AS cnt FROM (
            SELECT least(CASE WHEN hi > lo THEN floor((value - lo) / ((hi - lo) / {bins}))::BIGINT + 1
                ELSE 1 END, {bins}) AS bin, lo + (bin - 1) * ((hi - lo) / {bins}) AS bin_start, cnt
            FROM d, m) GROUP BY 1, 2"""


def _lengths(spark, d):
    counts = vb.token_counts(table(spark, d, "documents"), tk.wordpunct(F.col("text")))
    return stats.distribution(counts, F.length("token").cast("bigint"), weight=F.col("cnt"))


def _per_word(spark, d):
    words = vb.token_counts(table(spark, d, "documents"), tx.words(F.col("text")))
    n = F.size(tk.wordpunct(F.col("token"))).cast("bigint")
    return stats.distribution(words, n, weight=F.col("cnt"))


@query("token_length_dist", _LENGTHS)
def token_length_dist(spark, d):
    return _lengths(spark, d)


@query("hist_token_length", _hist_sql(_LENGTHS, 40))
def hist_token_length(spark, d):
    return _rounded(stats.histogram(_lengths(spark, d), 40), "bin_start")


@query("hist_tokens_per_word", _hist_sql(_PER_WORD, 20))
def hist_tokens_per_word(spark, d):
    return _rounded(stats.histogram(_per_word(spark, d), 20), "bin_start")


@query("tokens_per_word", f"""SELECT count(*)::BIGINT AS n, round(avg(n), 6) AS mean, median(n)::DOUBLE AS median
    FROM (SELECT len({sql.wordpunct('word')}) AS n FROM {_WORDS})""")
def tokens_per_word(spark, d):
    return _rounded(stats.mean_and_median(_per_word(spark, d)), "mean")


def _summary_sql(by: str) -> str:
    group = f"GROUP BY {by}" if by else ""
    return f"""SELECT {by + ',' if by else ''} count(*)::BIGINT AS documents,
        sum(len({sql.words('text')}))::BIGINT AS total_words,
        sum(len({sql.wordpunct('text')}))::BIGINT AS total_tokens,
        round(sum(len({sql.wordpunct('text')})) / sum(len({sql.words('text')})), 6) AS tokens_per_word
        FROM documents {group}"""


@query("corpus_summary", _summary_sql(""))
def corpus_summary(spark, d):
    docs = table(spark, d, "documents")
    return _rounded(stats.corpus_summary(docs, F.col("text"), tk.wordpunct(F.col("text"))), "tokens_per_word")


@query("corpus_summary_by_lang", _summary_sql("lang"))
def corpus_summary_by_lang(spark, d):
    docs = table(spark, d, "documents")
    return _rounded(
        stats.corpus_summary(docs, F.col("text"), tk.wordpunct(F.col("text")), ["lang"]), "tokens_per_word")


@query("corpus_summary_by_quality", f"""SELECT quality, count(*)::BIGINT AS documents,
    sum(len({sql.words('text')}))::BIGINT AS total_words FROM documents JOIN labels USING (doc_id)
    GROUP BY quality""")
def corpus_summary_by_quality(spark, d):
    # Counted first: the join carries a number for each document, not its text.
    counted = table(spark, d, "documents").select("doc_id", tx.word_count(F.col("text")).alias("n"))
    return counted.join(table(spark, d, "labels"), "doc_id").groupBy("quality").agg(
        F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_words"))


# A vocabulary of the most frequent tokens; everything else is unknown.
_KNOWN = 1000


@query("unk_ratio", f"""
    WITH known AS ({_COUNTS} ORDER BY cnt DESC, token LIMIT {_KNOWN}),
    t AS (SELECT k.token FROM (SELECT unnest({sql.regex_words('lower(text)')}) AS token FROM conversations) c
        LEFT JOIN known k USING (token))
    SELECT count(*)::BIGINT AS total_tokens, count(*) FILTER (WHERE token IS NULL)::BIGINT AS unk_count,
        round(count(*) FILTER (WHERE token IS NULL) / count(*), 6) AS oov_ratio FROM t""")
def unk_ratio(spark, d):
    """Conversation tokens looked up in a closed vocabulary of the documents."""
    known = vb.top_tokens(_counts(spark, d), _KNOWN).select("token", F.col("token").alias("known"))
    talk = vb.token_counts(table(spark, d, "conversations"), _lower_regex())
    looked_up = talk.join(F.broadcast(known), "token", "left").select(
        F.coalesce("known", F.lit(rules.UNK)).alias("token"), "cnt")
    return _rounded(stats.unk_ratio(looked_up), "oov_ratio")


@query("decode", f"""SELECT doc_id, array_to_string(list_filter(list_transform({sql.words('text')},
    lambda v: CASE WHEN length(v) > 8 THEN '[UNK]' ELSE v END), lambda v: v <> '[UNK]'), ' ') AS text
    FROM documents""")
def decode(spark, d):
    """Token arrays, long words replaced by the unknown token, back to text."""
    from wordloom.operators.subword.model import decode as join_tokens

    marked = F.transform(tx.words(F.col("text")), lambda w: F.when(
        F.length(w) > 8, F.lit(rules.UNK)).otherwise(w))
    return table(spark, d, "documents").select("doc_id", join_tokens(marked).alias("text"))


# --- similarity and distance -----------------------------------------------------------------------

@query("cosine_pairs", """SELECT a.vec_id // 2 AS pair, round(list_cosine_similarity(
    a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cosine
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1 WHERE a.vec_id % 2 = 0""")
def cosine_pairs(spark, d):
    """Vector 2k with vector 2k + 1."""
    e = table(spark, d, "embeddings").withColumn("pair", F.expr("vec_id div 2"))
    even, odd = (e.filter(F.col("vec_id") % 2 == r).select("pair", "embedding") for r in (0, 1))
    return _rounded(similarity.paired_cosine(even, odd, "pair", "embedding"), "cosine")


_CLEAN = sql.clean("text", STOP_WORDS, rules.LATIN_EXTRA)


_SIMILARITY = f"""
    WITH o AS (SELECT doc_id, token, count(*) n FROM (SELECT doc_id, unnest({sql.words('lower(text)')}) token
        FROM documents) GROUP BY ALL),
    p AS (SELECT doc_id, token, count(*) n FROM (SELECT doc_id, unnest({sql.words(_CLEAN)}) token
        FROM documents) GROUP BY ALL),
    dot AS (SELECT doc_id, sum(o.n * p.n) x FROM o JOIN p USING (doc_id, token) GROUP BY doc_id),
    no AS (SELECT doc_id, sqrt(sum(n * n)) x FROM o GROUP BY doc_id),
    np AS (SELECT doc_id, sqrt(sum(n * n)) x FROM p GROUP BY doc_id)
    SELECT doc_id, round(coalesce(dot.x / (no.x * np.x), 0.0), 6)::DOUBLE AS cosine FROM documents
    LEFT JOIN dot USING (doc_id) LEFT JOIN no USING (doc_id) LEFT JOIN np USING (doc_id)"""


def _cleaned_words():
    return tx.words(tx.clean_text(F.col("text"), stop_words=STOP_WORDS, extra_letters=rules.LATIN_EXTRA))


@query("text_similarity", _SIMILARITY)
def text_similarity(spark, d):
    """Each document against its cleaned form."""
    out = similarity.bag_cosines(table(spark, d, "documents"), "doc_id", F.col("text"), _cleaned_words())
    return _rounded(out, "cosine")


@query("semantic_similarity", f"SELECT round(coalesce(avg(cosine), 0.0), 4)::DOUBLE AS semantic_similarity FROM ({_SIMILARITY})")
def semantic_similarity(spark, d):
    """The mean over all documents."""
    out = similarity.mean_similarity(table(spark, d, "documents"), "doc_id", F.col("text"), _cleaned_words())
    return _rounded(out, "semantic_similarity", places=4)


@query("pair_by_pos", f"""SELECT a.conv_id, a.turn, len({sql.words('a.text')})::BIGINT AS words,
    len({sql.words('b.text')})::BIGINT AS next_words FROM conversations a JOIN conversations b
    ON b.conv_id = a.conv_id AND b.turn = a.turn + 1""")
def pair_by_pos(spark, d):
    """Each turn with the next one of its conversation."""
    turns = table(spark, d, "conversations").select(
        "conv_id", "turn", tx.word_count(F.col("text")).alias("words"))
    following = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("words").alias("next_words"))
    return turns.join(following, ["conv_id", "turn"])


# --- prefixes and samples ---------------------------------------------------------------------------

@query("budget_prefix", f"""
    WITH w AS (SELECT doc_id, len({sql.words('text')})::BIGINT AS n_words FROM documents)
    SELECT doc_id, n_words FROM (SELECT *, sum(n_words) OVER (ORDER BY doc_id) - n_words AS before FROM w
        WHERE n_words >= {rules.ARTICLE_MIN_WORDS}) WHERE before < {rules.CORPUS_WORD_BUDGET}""")
def budget_prefix(spark, d):
    docs = pages.long_articles(table(spark, d, "documents")).select("doc_id", "n_words")
    return ordering.budget_prefix(docs, "doc_id", F.col("n_words"), rules.CORPUS_WORD_BUDGET)


@query("first_n", "SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 137")
def first_n(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "n_chars")
    return ordering.first_n(docs, "doc_id", 137)


@query("sample_n", "SELECT doc_id, lang FROM documents ORDER BY md5('7:' || doc_id), doc_id LIMIT 200")
def sample_n(spark, d):
    return ordering.sample_n(table(spark, d, "documents").select("doc_id", "lang"), "doc_id", 200, seed=7)


# --- tokenizer grid ------------------------------------------------------------------------------------

def _grid_sql(name: str) -> str:
    return f"""SELECT '{name}' AS tokenizer, 'none' AS normalizer,
        (SELECT count(DISTINCT token) FROM t WHERE is_train)::BIGINT AS vocab_size,
        (SELECT round(100.0 * count(*) FILTER (WHERE token NOT IN (SELECT token FROM t WHERE is_train))
            / count(*), 6) FROM t WHERE NOT is_train)::DOUBLE AS oov_pct
        FROM (SELECT 1)"""


SQL_TOKENIZERS = {
    "naive": _NAIVE, "regex": f"regexp_extract_all(text, {sql.text(sql.plain_regex(tk.regex_pattern()))})",
    "rules": _RULES, "wordpunct": sql.wordpunct("text"), "sentences": _SENTENCES,
}


def grid_oracle(*names: str) -> str:
    parts = []
    for name in names:
        tokens = SQL_TOKENIZERS[name]
        parts.append(f"""SELECT * FROM (WITH t AS (SELECT is_train, lower(unnest({tokens})) AS token
            FROM {_SPLIT}) {_grid_sql(name)})""")
    return " UNION ALL ".join(parts)


@query("tokenizer_grid", grid_oracle(*SQL_TOKENIZERS))
def tokenizer_grid(spark, d):
    """Five tokenizers without normalization: vocabulary size and OOV rate."""
    out = grid.compare(
        table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text",
        tokenizers=list(SQL_TOKENIZERS), normalizers=["none"], similarity=False)
    return _rounded(out, "oov_pct")


def grid_lemmas(spark, d):
    return materialize(lemma_lookup(spark, d).filter("token <> lemma").select("token", "lemma"), "lemmas")


def _both_sql(name: str) -> str:
    """A tokenizer's rows without normalization and with the lemma table, similarity included."""
    return f"""SELECT * FROM (WITH f AS MATERIALIZED (
            SELECT doc_id, is_train, tokens.token AS raw, lower(coalesce(lemma, tokens.token)) AS lemma, lower(tokens.token) AS plain
            FROM (SELECT doc_id, is_train, unnest({SQL_TOKENIZERS[name]}) AS token FROM s) tokens LEFT JOIN lemmas USING (token)),
        v AS (SELECT doc_id, is_train, 'none' AS normalizer, plain AS token FROM f UNION ALL SELECT doc_id, is_train, 'lemma', lemma FROM f),
        known AS (SELECT normalizer, token, bool_or(is_train) AS seen, count(*) FILTER (NOT is_train) AS tests FROM v GROUP BY ALL),
        counts AS (SELECT normalizer, count(*) FILTER (seen)::BIGINT AS vocab_size,
            round(100.0 * sum(tests) FILTER (NOT seen) / sum(tests), 6)::DOUBLE AS oov_pct FROM known GROUP BY normalizer),
        w AS (SELECT doc_id, normalizer, token, count(*) AS n FROM v GROUP BY ALL),
        scores AS (SELECT w.doc_id, normalizer, sum(w.n * coalesce(o.n, 0)) / sqrt(sum(w.n * w.n) * any_value(norms.x)) AS score
            FROM w LEFT JOIN o ON o.doc_id = w.doc_id AND o.token = w.token JOIN norms ON norms.doc_id = w.doc_id GROUP BY ALL)
        SELECT '{name}' AS tokenizer, normalizer, vocab_size, oov_pct,
            round((SELECT sum(score) FROM scores WHERE scores.normalizer = counts.normalizer) / (SELECT count(*) FROM documents), 6)::DOUBLE
                AS semantic_similarity FROM counts)"""


def grid_similarity_oracle() -> str:
    return f"""WITH s AS MATERIALIZED (SELECT * FROM {_SPLIT}), lemmas AS MATERIALIZED (SELECT token, lemma FROM ({_LEMMAS}) WHERE token <> lemma),
        o AS MATERIALIZED (SELECT doc_id, token, count(*) AS n FROM (SELECT doc_id, unnest({sql.words('lower(text)')}) AS token FROM documents) GROUP BY ALL),
        norms AS MATERIALIZED (SELECT doc_id, sum(n * n) AS x FROM o GROUP BY doc_id)
        {" UNION ALL ".join(_both_sql(n) for n in SQL_TOKENIZERS)}"""


@query("tokenizer_grid_similarity", grid_similarity_oracle())
def tokenizer_grid_similarity(spark, d):
    """What SQL can say of the full grid: all tokenizers, plain and with lemmas, similarity included."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    out = grid.compare(docs, "doc_id", "text", list(SQL_TOKENIZERS), ["none"], grid_lemmas(spark, d))
    return _rounded(out, "oov_pct", "semantic_similarity")


@query("tokenizer_grid_full")
def tokenizer_grid_full(spark, d):
    """All twenty combinations with similarity; the lemma table is data-driven."""
    return full_grid(spark, d, grid_lemmas(spark, d))


def full_grid(spark, d, lemmas):
    return grid.compare(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text", lemmas=lemmas)


_TIMED_ROWS = 100  # the size of the sample whose seconds are reported


@query("tokenizer_seconds")
def tokenizer_seconds(spark, d):
    """Seconds of each combination over a sample of texts."""
    return grid_seconds(spark, d, grid_lemmas(spark, d))


def grid_seconds(spark, d, lemmas):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return grid.combination_seconds(docs, "doc_id", "text", tk.TOKENIZERS, nz.NORMALIZERS, _TIMED_ROWS, lemmas)
