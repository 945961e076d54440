"""Subword training, encoding and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from wordloom import rules
from wordloom.operators.subword import encode, evaluate, grid, merging, model as md, registry, types as ty, unigram
from wordloom.plans import sql
from wordloom.plans.registry import query
from wordloom.session import discard, new_path, store
from wordloom.sources import sinks
from wordloom.sources.tables import table, version

# Vocabulary sizes whose merges DuckDB's plain recursion can follow, over the whole table; others have the full size.
_SIZES = {"bpe": 260, "wordpiece": 350, "unigram": rules.VOCAB_SIZES[-1]}
_FULL = dict.fromkeys(md.KINDS, rules.VOCAB_SIZES[-1])
_MIN_FREQUENCY = 2


def _docs(spark, d):
    return table(spark, d, "documents").select("doc_id", "text")


def _root(spark, d, *settings) -> str:
    """The registry for models of the documents as they are now."""
    return registry.root_for(spark, version(spark, d, "documents"), *settings)


def _models(spark, d, *kinds: str, sizes: dict[str, int] | None = None) -> dict[str, md.SubwordModel]:
    """Trained where the registry has no model of these documents yet, and read from there. The word types
    are counted once for all that are trained."""
    out, stored, sizes = {}, [], sizes or _SIZES
    for kind in kinds:
        def train(kind=kind):
            if not stored:
                stored.extend(store(ty.word_types(_docs(spark, d)), "types"))
            types = stored[0]
            if kind == "unigram":
                return {kind: unigram.train_unigram(types, sizes[kind])}
            return {kind: merging.train(types, sizes[kind], _MIN_FREQUENCY, kind)}

        out |= registry.trained(spark, _root(spark, d, kind, sizes[kind], _MIN_FREQUENCY), train)
    if stored:
        discard(spark, stored[1])
    return out


def _model(spark, d, kind: str, sizes: dict[str, int] | None = None) -> md.SubwordModel:
    return _models(spark, d, kind, sizes=sizes)[kind]


def forget_models(spark, d) -> None:
    """Remove the registries of these documents, so that the next query trains anew."""
    for settings in [(kind, sizes[kind], _MIN_FREQUENCY) for sizes in (_SIZES, _FULL) for kind in md.KINDS] + [("grid",)]:
        registry.forget(spark, _root(spark, d, *settings))


# Symbols are written between the marks chr(1) and chr(2), so that replacing the text of
# two neighbours by the text of their union is one merge, left to right. Five digits in front of each
# stand for the order in which symbols came to be, by which ties are broken.
_TYPES = f"""(SELECT word, count(*)::BIGINT AS cnt FROM (
    SELECT unnest({sql.wordpunct("replace(text, chr(10), ' ')")}) AS word FROM documents) GROUP BY word)"""


def _training(kind: str) -> str:
    tail = "'##'" if kind == "wordpiece" else "''"
    cut = "substr(p.r, 8)" if kind == "wordpiece" else "substr(p.r, 6)"
    tails = "UNION ALL SELECT DISTINCT '##' || unnest((regexp_extract_all(word, '(?s).'))[2:]) FROM types" if tail != "''" else ""
    return f"""WITH RECURSIVE types AS MATERIALIZED {_TYPES},
    room AS MATERIALIZED (SELECT {_SIZES[kind]} - 1 - count(*) AS n FROM (
        SELECT DISTINCT unnest(regexp_extract_all(word, '(?s).')) AS c FROM types {tails})),
    steps AS (
        SELECT 0 AS it, word, cnt, chr(1) || array_to_string(list_transform(
            regexp_extract_all(word, '(?s).'), lambda c, i: CASE WHEN i > 1 AND {tail} <> '' THEN '00001' || {tail} ELSE '00000' END || c),
            chr(2) || chr(1)) || chr(2) AS syms, ''::VARCHAR AS l, ''::VARCHAR AS r, 0::BIGINT AS c FROM types
        UNION ALL
        SELECT s.it + 1, s.word, s.cnt, replace(s.syms, chr(1) || p.l || chr(2) || chr(1) || p.r || chr(2),
            chr(1) || lpad((s.it + 2)::VARCHAR, 5, '0') || substr(p.l, 6) || {cut} || chr(2)), p.l, p.r, p.c
        FROM steps s, (
            SELECT l, r, sum(cnt)::BIGINT AS c FROM (
                SELECT cnt, unnest(y[:-2]) AS l, unnest(y[2:]) AS r FROM (
                    SELECT cnt, string_split(syms[2:-2], chr(2) || chr(1)) AS y FROM steps) WHERE len(y) > 1)
            GROUP BY l, r ORDER BY c DESC, l, r LIMIT 1) p
        WHERE s.it < (SELECT n FROM room))"""


def _symbols(x: str = "syms") -> str:
    return f"list_transform(string_split({x}[2:-2], chr(2) || chr(1)), lambda y: substr(y, 6))"


# Training to the full size. A step takes the best pairs, in their order, as far as none of them shares a border
# with another or spells a symbol that is there, and none can come after a pair that those before it make: such a pair is no
# more frequent than the three neighbours it is made of are now. Words are lists of ids in a table that keeps the last
# state of each word; merges are kept beside them under negative keys.
def _full_training(kind: str) -> str:
    tails = cut = mark = ""
    if kind == "wordpiece":
        tails, cut, mark = "UNION ALL SELECT DISTINCT 1, '##' || unnest((regexp_extract_all(word, '(?s).'))[2:]) FROM types", "[3:]", "'##' || "
    pairs = "unnest(ids[:-2]) AS l, unnest(ids[2:]) AS r"
    return f"""WITH RECURSIVE types AS MATERIALIZED (SELECT word, cnt, row_number() OVER (ORDER BY word) AS key FROM {_TYPES}),
    alphabet AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY part, token))::INTEGER AS id, token FROM (
        SELECT DISTINCT 0 AS part, unnest(regexp_extract_all(word, '(?s).')) AS token FROM types {tails})),
    numbers AS MATERIALIZED (SELECT map(list(token), list(id)) AS m FROM alphabet),
    state(key, cnt, ids, l, r, new, token) USING KEY (key) AS (
        SELECT key, cnt, list_transform(regexp_extract_all(word, '(?s).'), lambda c, i:
            m[CASE WHEN i > 1 THEN {mark} c ELSE c END]), 0, 0, 0, '' FROM types, numbers
        UNION
        (WITH s AS MATERIALIZED (SELECT * FROM recurring.state),
        w AS MATERIALIZED (SELECT key, cnt, ids FROM s WHERE key > 0 AND len(ids) > 1),
        tokens AS MATERIALIZED (SELECT id, token FROM alphabet UNION SELECT new, token FROM s WHERE key < 0),
        made AS MATERIALIZED (
            SELECT max(id) + 1 AS id, {_FULL[kind]} - 1 - max(id) AS room, (SELECT count(*) FROM s WHERE key < 0) AS n FROM tokens),
        top AS MATERIALIZED (
            SELECT p.*, l.token || r.token{cut} AS token, row_number() OVER (ORDER BY c DESC, p.l, p.r) AS k FROM (
                SELECT l, r, sum(cnt)::BIGINT AS c FROM (SELECT cnt, {pairs} FROM w)
                GROUP BY ALL HAVING c >= {_MIN_FREQUENCY} ORDER BY c DESC, l, r LIMIT 400) p
            JOIN tokens l ON l.id = p.l JOIN tokens r ON r.id = p.r),
        blocks AS (
            SELECT k, min(bar) AS bar FROM (
                SELECT k, x - 1048576 * sum(cnt)::BIGINT AS bar FROM (
                    SELECT cnt, unnest(ids[:-3]) AS x, unnest(ids[2:-2]) AS l, unnest(ids[3:]) AS r FROM w) JOIN top USING (l, r) GROUP BY k, x
                UNION ALL
                SELECT k, 1048575 - 1048576 * sum(cnt)::BIGINT FROM (
                    SELECT cnt, unnest(ids[:-3]) AS l, unnest(ids[2:-2]) AS r, unnest(ids[3:]) AS x FROM w) JOIN top USING (l, r) GROUP BY k, x)
            GROUP BY k),
        judged AS (
            SELECT t.*, o.id AS old, coalesce(min(b.bar) OVER before < l - 1048576 * c, false)
                OR coalesce(bool_or(o.id IS NOT NULL) OVER before, false) OR row_number() OVER (PARTITION BY t.token ORDER BY k) > 1
                OR count(*) FILTER (o.id IS NULL) OVER before >= room AS late
            FROM top t LEFT JOIN blocks b USING (k) LEFT JOIN tokens o ON o.token = t.token, made
            WINDOW before AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        ends AS (SELECT least((SELECT min(k) FROM judged WHERE late),
            (SELECT min(j.k) FROM top i JOIN top j ON j.l = i.r AND j.k > i.k), (SELECT min(j.k) FROM top i JOIN top j ON j.r = i.l AND j.k > i.k)) AS k),
        batch AS MATERIALIZED (
            SELECT l, r, coalesce(old, made.id + j.k - 1)::INTEGER AS new, token, -made.n - j.k AS key FROM judged j, ends, made
            WHERE (ends.k IS NULL OR j.k < ends.k) AND made.room > 0),
        hits AS (
            SELECT w.key, i, new, l = r AS same FROM (
                SELECT key, {pairs}, unnest(range(1, len(ids))) AS i FROM w) w JOIN batch USING (l, r)),
        kept AS (
            SELECT key, list(i ORDER BY i) AS places, list(new ORDER BY i) AS news FROM (
                SELECT key, i, new, same, row_number() OVER (PARTITION BY key, new, i - o ORDER BY i) AS nth FROM (
                    SELECT *, row_number() OVER (PARTITION BY key, new ORDER BY i) AS o FROM hits))
            WHERE NOT same OR nth % 2 = 1 GROUP BY key)
        SELECT w.key, w.cnt, list_transform(list_filter(range(1, len(ids) + 1), lambda i: NOT list_contains(places, i - 1)),
            lambda i: coalesce(news[list_position(places, i)], ids[i])), 0, 0, 0, '' FROM w JOIN kept USING (key)
        UNION ALL SELECT key, 0, NULL, l, r, new, token FROM batch))"""


_BPE_FINAL = f"{_training('bpe')}, enc AS MATERIALIZED (SELECT word, cnt, {_symbols()} AS tokens FROM steps WHERE it = (SELECT n FROM room))"


@query("word_types", f"SELECT word, cnt FROM {_TYPES}")
def word_types(spark, d):
    return ty.word_types(_docs(spark, d))


@query("pair_counts", f"""SELECT l AS left, r AS right, sum(cnt)::BIGINT AS cnt FROM (
    SELECT cnt, unnest(y[:-2]) AS l, unnest(y[2:]) AS r FROM (
        SELECT cnt, regexp_extract_all(word, '(?s).') AS y FROM {_TYPES}) WHERE len(y) > 1) GROUP BY l, r""")
def pair_counts(spark, d):
    """Adjacent character pairs: what the first merge is chosen from."""
    return merging.first_pairs(ty.word_types(_docs(spark, d)))


def _merge_rows(spark, model):
    return md.merges_table(spark, model).select("rank", "left", "right")


@query("bpe_merges", f"{_training('bpe')} SELECT DISTINCT it::BIGINT - 1 AS rank, substr(l, 6) AS left, substr(r, 6) AS right "
       "FROM steps WHERE it > 0")
def bpe_merges(spark, d):
    return _merge_rows(spark, _model(spark, d, "bpe"))


@query("wordpiece_merges", f"{_training('wordpiece')} SELECT DISTINCT it::BIGINT - 1 AS rank, substr(l, 6) AS left, "
       "substr(r, 6) AS right FROM steps WHERE it > 0")
def wordpiece_merges(spark, d):
    return _merge_rows(spark, _model(spark, d, "wordpiece"))


_WP_VOCAB = """(SELECT DISTINCT unnest(regexp_extract_all(word, '(?s).')) AS token FROM types
    UNION SELECT DISTINCT '##' || unnest((regexp_extract_all(word, '(?s).'))[2:]) FROM types
    UNION SELECT DISTINCT substr(l, 6) || substr(r, 8) FROM steps WHERE it > 0)"""


@query("wordpiece_vocab", f"{_full_training('wordpiece')} SELECT token FROM alphabet UNION SELECT token FROM state WHERE key < 0 UNION SELECT '[UNK]'")
def wordpiece_vocab(spark, d):
    """The vocabulary of the full size."""
    return md.vocab_table(spark, _model(spark, d, "wordpiece", _FULL)).select("token")


@query("unigram_seeds", f"""SELECT piece, sum(cnt)::BIGINT AS cnt, (sum(cnt) * length(piece))::BIGINT AS score
    FROM (SELECT cnt, unnest(flatten(list_transform(range(1, length(word) + 1), lambda i: list_transform(
        range(1, least(16, length(word) - i + 1) + 1), lambda n: substr(word, i, n))))) AS piece FROM {_TYPES})
    GROUP BY piece HAVING length(piece) = 1 OR sum(cnt) >= 2""")
def unigram_seeds(spark, d):
    """Every repeated substring; training takes those of them that no one character always follows."""
    return unigram.seed_pieces(ty.word_types(_docs(spark, d)), every=True)


@query("unigram_vocab")
def unigram_vocab(spark, d):
    return md.vocab_table(spark, _model(spark, d, "unigram")).select("token", F.round("score", 4).alias("score"))


def _encoded_types(spark, d, kind):
    """Distinct pre-tokens with their encoding."""
    model = _model(spark, d, kind)
    types = ty.word_types(_docs(spark, d))
    udf = encode.encode_udf(spark, {kind: model}, remember=0)
    out = types.withColumn("e", udf(F.lit(kind), F.array("word")))
    return out.select("word", F.array_join("e.tokens", " ").alias("tokens"),
                      F.size("e.ids").cast("bigint").alias("n_tokens"))


@query("bpe_encode", f"{_BPE_FINAL} SELECT word, {sql.join('tokens')} AS tokens, len(tokens)::BIGINT AS n_tokens FROM enc")
def bpe_encode(spark, d):
    return _encoded_types(spark, d, "bpe")


_WORDPIECE_ENCODED = f"""{_training('wordpiece')},
    vocab AS MATERIALIZED (SELECT token FROM {_WP_VOCAB}),
    longest AS MATERIALIZED (
        SELECT word, i, max(n) AS n FROM (
            SELECT word, i, unnest(range(1, least(length(word) - i + 1, (SELECT max(length(token)) FROM vocab)) + 1)) AS n
            FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM types))
        WHERE CASE WHEN i > 1 THEN '##' ELSE '' END || substr(word, i, n) IN (SELECT token FROM vocab)
        GROUP BY word, i),
    walk AS (
        SELECT word, 1::BIGINT AS i, ''::VARCHAR AS tokens, 0::BIGINT AS n_tokens FROM types
        UNION ALL
        SELECT w.word, w.i + x.n, w.tokens || CASE WHEN w.i > 1 THEN ' ##' ELSE '' END || substr(w.word, w.i, x.n),
            w.n_tokens + 1 FROM walk w JOIN longest x ON x.word = w.word AND x.i = w.i)
    SELECT word, CASE WHEN length(word) > {rules.WORDPIECE_MAX_CHARS} THEN '[UNK]' ELSE tokens END AS tokens,
        CASE WHEN length(word) > {rules.WORDPIECE_MAX_CHARS} THEN 1 ELSE n_tokens END AS n_tokens
    FROM walk WHERE i > length(word)"""


@query("wordpiece_encode", _WORDPIECE_ENCODED)
def wordpiece_encode(spark, d):
    return _encoded_types(spark, d, "wordpiece")


@query("unigram_encode")
def unigram_encode(spark, d):
    return _encoded_types(spark, d, "unigram")


@query("corpus_encode", f"""{_full_training('bpe')},
    vocab AS (SELECT id, token FROM alphabet UNION SELECT new, token FROM state WHERE key < 0),
    enc AS MATERIALIZED (
        SELECT word, count(*) AS n, string_agg(token, ' ' ORDER BY i) AS tokens, string_agg(id::VARCHAR, ' ' ORDER BY i) AS ids
        FROM (SELECT word, unnest(ids) AS id, unnest(range(len(ids))) AS i FROM types JOIN state USING (key)) JOIN vocab USING (id) GROUP BY word),
    pre AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM (SELECT doc_id, {sql.wordpunct('text')} AS w FROM documents))
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_tokens, coalesce(chars, 0)::BIGINT AS chars, coalesce(tokens, '') AS tokens,
        coalesce(ids, '') AS ids FROM documents LEFT JOIN (
        SELECT doc_id, sum(n) AS n, sum(length(word)) AS chars, string_agg(tokens, ' ' ORDER BY i) AS tokens,
            string_agg(ids, ' ' ORDER BY i) AS ids FROM pre JOIN enc USING (word) GROUP BY doc_id) USING (doc_id)""")
def corpus_encode(spark, d):
    """Tokens and ids of every document by the full-size model, encoded in place."""
    enc = encode.encode_column(spark, _model(spark, d, "bpe", _FULL), F.col("text"))
    out = _docs(spark, d).withColumn("e", enc)
    return out.select("doc_id", F.size("e.ids").cast("bigint").alias("n_tokens"),
                      F.length(F.array_join("e.tokens", "")).cast("bigint").alias("chars"),
                      F.array_join("e.tokens", " ").alias("tokens"), F.array_join("e.ids", " ").alias("ids"))


_WORD_COUNTS = f"""{_BPE_FINAL},
    w AS (SELECT word AS ws, count(*)::BIGINT AS cnt FROM (SELECT unnest({sql.words('text')}) AS word FROM documents)
        GROUP BY word),
    n AS (SELECT ws, any_value(w.cnt) AS cnt, sum(len(tokens))::BIGINT AS n FROM (
        SELECT ws, cnt, unnest({sql.wordpunct('ws')}) AS word FROM w) w JOIN enc USING (word) GROUP BY ws)"""


def _metrics(spark, d):
    models = _models(spark, d, "bpe")
    return evaluate.word_metrics(evaluate.word_counts(_docs(spark, d), models))


@query("subword_totals", f"""{_WORD_COUNTS} SELECT (SELECT count(*) FROM documents)::BIGINT AS total_lines,
    sum(cnt)::BIGINT AS total_words, sum(greatest(n, 1) * cnt)::BIGINT AS total_tokens FROM n""")
def subword_totals(spark, d):
    lines = _docs(spark, d).agg(F.count("*").alias("total_lines"))
    return _metrics(spark, d).select("total_words", "total_tokens", lines.scalar().alias("total_lines"))


@query("fragmentation", f"""{_WORD_COUNTS} SELECT coalesce(sum(cnt) FILTER (WHERE n > 1), 0)::BIGINT AS fragmented_words,
    round(100.0 * coalesce(sum(cnt) FILTER (WHERE n > 1), 0) / sum(cnt), 6)::DOUBLE AS frag_percent FROM n""")
def fragmentation(spark, d):
    return _metrics(spark, d).select("fragmented_words", F.round("frag_percent", 6).alias("frag_percent"))


@query("compression", f"""{_WORD_COUNTS} SELECT round(sum(cnt) / sum(greatest(n, 1) * cnt), 6)::DOUBLE
    AS compression_ratio FROM n""")
def compression(spark, d):
    return _metrics(spark, d).select(F.round("compression_ratio", 6).alias("compression_ratio"))


@query("subword_tokens_per_word", f"""{_WORD_COUNTS} SELECT n AS n_tokens, sum(cnt)::BIGINT AS cnt FROM n GROUP BY n""")
def subword_tokens_per_word(spark, d):
    models = _models(spark, d, "bpe")
    return evaluate.word_counts(_docs(spark, d), models).select("n_tokens", "cnt")


@query("subword_token_freq", f"""{_BPE_FINAL} SELECT token, sum(cnt)::BIGINT AS cnt FROM (
    SELECT unnest(tokens) AS token, cnt FROM enc) GROUP BY token""")
def subword_token_freq(spark, d):
    return evaluate.token_counts(_docs(spark, d), _models(spark, d, "bpe")).select("token", "cnt")


@query("reconstruction")
def reconstruction(spark, d):
    models = _models(spark, d, *md.KINDS, sizes=_FULL)
    out = evaluate.reconstruction(_docs(spark, d), models)
    return out.withColumns({c: F.round(c, 6) for c in out.columns[2:]})


@query("evaluate_model")
def evaluate_model(spark, d):
    return evaluate.evaluate(_docs(spark, d), _models(spark, d, *md.KINDS, sizes=_FULL))


@query("model_token_stats")
def model_token_stats(spark, d):
    docs, models = _docs(spark, d), _models(spark, d, *md.KINDS, sizes=_FULL)
    return evaluate.token_statistics(evaluate.token_counts(docs, models), evaluate.word_counts(docs, models))


@query("model_roundtrip", f"""SELECT 'bpe' AS model, word, tokens FROM ({_BPE_FINAL} SELECT word, {sql.join('tokens')} AS tokens FROM enc)
    UNION ALL SELECT 'wordpiece', word, tokens FROM ({_WORDPIECE_ENCODED})""")
def model_roundtrip(spark, d):
    """Save models of both kinds as one registry, load them and encode with what was loaded."""
    root = new_path(spark, "models")
    registry.save_all(spark, _models(spark, d, "bpe", "wordpiece"), root)
    shared = encode.Shared(spark, registry.load_all(spark, root))
    out = ty.word_types(_docs(spark, d)).select("word", shared.encoded(F.array("word"), remember=0).alias("x"))
    return out.select("x.model", "word", F.array_join("x.enc.tokens", " ").alias("tokens"))


@query("model_registry")
def model_registry(spark, d):
    """What the registry of the full-size grid holds."""
    root = _root(spark, d, "grid")
    grid.trained_grid(_docs(spark, d), rules.VOCAB_SIZES, rules.MIN_FREQUENCY, "text", md.KINDS, root)
    return registry.listed(spark, root)


def _grid(spark, d):
    return grid.training_grid(_docs(spark, d), rules.VOCAB_SIZES, rules.MIN_FREQUENCY, root=_root(spark, d, "grid"))


@query("training_grid")
def training_grid(spark, d):
    """Nine models of the full sizes, trained, saved and measured."""
    return _grid(spark, d)


@query("training_results_csv")
def training_results_csv(spark, d):
    """The nine rows through CSV."""
    out = _grid(spark, d)
    path = new_path(spark, "training")
    sinks.write_csv(out, path)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out.schema)
    return sinks.read_csv(spark, path, schema)
