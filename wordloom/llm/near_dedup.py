"""Near-duplicates by improved consistent weighted sampling.

A text is a weighted set of its five-word shingles: how often each occurs, times a smoothed inverse
document frequency, 1 + s ln(N / df) / ln(N + 1) with df from a count-min sketch of fixed size over all
documents. s is small by default: what a large group of near copies shares is frequent, and a steep idf
would tear the group apart. Two texts are near-duplicates from a weighted Jaccard similarity of 0.8 on.

1. Consistent weighted samples of each text; equal with the probability of the similarity.
   Texts of one weighted set are one node from here on, so exact copies cost one row.
2. Bands of samples bring nodes into buckets (very large ones are dealt into blocks). In a bucket or
   block, nodes whose samples agree often enough are candidates; each proposes the most central
   one, so a group of near copies gives a star around its original, not all pairs.
3. The exact similarity of the proposed pairs decides; a hub's pairs are verified in chunks, and
   the pairs that hold are joined up to components.
4. Candidates that still lie in two components meet once more, bucket by bucket, with their texts:
   the likeliest pairs first, each is verified unless its components have been joined by then. After that
   every candidate pair is verified, rejected or inside one component. A very large bucket meets in pairs of
   blocks, each a key of its own: those outside its largest component with each other and with all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from wordloom.llm.common import Words, batch, byte_lists, mix, partitions, planes, slices, unplanes, whole
from wordloom.llm.components import components
from wordloom.session import materialize

_U = np.uint64
BANDS, ROWS = 9, 4
SAMPLES = BANDS * ROWS
#: Samples that must agree: of pairs at 0.8, fewer than one in ten thousand fall below.
AGREE = 19
_BLOCK = 4096
_SEEDS = mix(np.arange(1, 2 * SAMPLES + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))
WIDTH, DEPTH = 1 << 18, 2
_CHUNK = 1 << 14


def shingles(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, shingle hash (ascending in each text) and how often it occurs. A text of fewer than
    ``n`` words has one shingle, all its words; a text without words has none."""
    words = Words(texts)
    hashes, low = words.runs(n)
    text = words.text_of(low)
    few = np.flatnonzero((words.counts > 0) & (words.counts < n))
    if len(few):
        hashes = np.concatenate((hashes, words.run(words.first[few], words.first[few + 1])))
        text = np.concatenate((text, few))
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    if not len(text):
        return text, hashes, text
    first = np.flatnonzero(np.concatenate(([True], (np.diff(hashes.view(np.int64)) != 0) | (np.diff(text) != 0))))
    return text[first], hashes[first], np.diff(np.concatenate((first, [len(text)])))


# --- document frequencies ----------------------------------------------------------------

def _cells(hashes: np.ndarray) -> np.ndarray:
    return np.stack([(mix(hashes + _SEEDS[i]) % _U(WIDTH)).astype(np.int64) + i * WIDTH for i in range(DEPTH)])


def _sketch(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(WIDTH * DEPTH, np.int64)
        for b in batches:
            texts = byte_lists(b.column("text"))
            for low, high in slices(texts):
                cells = _cells(shingles(texts[low:high], n)[1]).ravel()
                counts += np.bincount(cells, minlength=len(counts))
        parts = counts.reshape(-1, _CHUNK)
        yield batch([("chunk", pa.int32()), ("data", pa.binary())],
                    [(i, planes(p)) for i, p in enumerate(parts) if p.any()])

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        for i, data in zip(b.column("chunk").to_pylist(), b.column("data").to_pylist()):
            sums[i] = sums.get(i, 0) + unplanes(data)
    yield batch([("chunk", pa.int32()), ("data", pa.binary())], [(i, planes(p)) for i, p in sums.items()])


def document_frequencies(texts: DataFrame, n: int) -> np.ndarray:
    """The count-min sketch of all texts: ``WIDTH * DEPTH`` counters, whatever the input."""
    parts = texts.select("text").mapInArrow(_sketch(n), "chunk int, data binary")
    parts = parts.repartition(partitions(texts), "chunk").mapInArrow(_add, "chunk int, data binary")
    out = np.zeros((WIDTH * DEPTH // _CHUNK, _CHUNK), np.int64)
    for r in parts.toLocalIterator():
        out[r.chunk] = unplanes(r.data)
    return out.ravel()


class Weights:
    """tf times the smoothed idf, 1 + strength * ln(N / df) / ln(N + 1)."""

    def __init__(self, sketch: np.ndarray, documents: int, strength: float):
        idf = 1 + strength * np.log(max(documents, 1) / np.clip(sketch, 1, max(documents, 1))) / np.log(documents + 1.0 if documents else 2.0)
        self.idf = idf.astype(np.float32)

    def of(self, hashes: np.ndarray, tf: np.ndarray) -> np.ndarray:
        return tf.astype(np.float32) * self.idf[_cells(hashes)].max(axis=0)  # the least count


# --- samples --------------------------------------------------------------------------

def samples(text: np.ndarray, hashes: np.ndarray, weights: np.ndarray, texts: int) -> np.ndarray:
    """``SAMPLES`` 32-bit samples of each text that has shingles; 0 for others."""
    out = np.zeros((texts, SAMPLES), np.int32)
    if not len(text):
        return out
    first = np.flatnonzero(np.concatenate(([True], np.diff(text) != 0)))
    size = np.diff(np.concatenate((first, [len(text)])))
    owner = text[first]
    log_w = np.log(weights)
    unit = np.float32(2.0 ** -21)

    def uniform(h: np.ndarray, shift: int) -> np.ndarray:
        return ((h >> _U(shift)) & _U(0x1FFFFF)).astype(np.float32) * unit + unit / 2

    for k in range(SAMPLES):
        h = mix(hashes + _SEEDS[2 * k])
        g = (h ^ _SEEDS[2 * k + 1]) * _U(0xD1342543DE82EF95)
        g ^= g >> _U(32)
        r = -np.log(uniform(h, 0) * uniform(h, 21))
        log_c = np.log(-np.log(uniform(g, 0) * uniform(g, 21)))
        beta = uniform(h, 42)
        t = np.floor(log_w / r + beta)
        log_a = log_c - r * (t - beta + 1)
        least = np.minimum.reduceat(log_a, first)
        at = np.flatnonzero(log_a == np.repeat(least, size))
        at = at[np.searchsorted(at, first)]  # the first smallest of each text
        picked = mix(hashes[at] ^ (t[at].astype(np.int64).view(_U) * _U(0xFF51AFD7ED558CCD)))
        out[owner, k] = (picked >> _U(32)).astype(np.uint32).view(np.int32)
    return out


_SIGNED = [("node", pa.binary()), ("sample", pa.list_(pa.int32()))]


def _sign(n: int, weights: Weights, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = byte_lists(b.column("text"))
            for low, high in slices(texts):
                text, hashes, tf = shingles(texts[low:high], n)
                count = high - low
                w = weights.of(hashes, tf)
                sample = samples(text, hashes, w, count)
                node = np.zeros((count, 2), _U)
                marks = mix(hashes ^ (tf.astype(_U) * _U(0x9E3779B97F4A7C15)))
                if len(text):
                    first = np.flatnonzero(np.concatenate(([True], np.diff(text) != 0)))
                    node[text[first], 0] = np.add.reduceat(marks, first)
                    node[text[first], 1] = np.add.reduceat(mix(marks), first)
                has = np.zeros(count, bool)
                has[text] = True
                raw = [node[i].tobytes() if has[i] else None for i in range(count)]
                part = b.slice(low, count)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in columns], pa.array(raw, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(np.arange(count + 1) * SAMPLES, pa.int32()), pa.array(sample.ravel()))],
                    [*columns, "node", "sample"])

    return run


# --- candidates ---------------------------------------------------------------------------

_PAIR = [("a", pa.binary()), ("b", pa.binary())]


def _buckets(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[int, list[tuple]]]:
    """The rows of each bucket, which come sorted by bucket."""
    now, rows = None, []
    for b in batches:
        for row in zip(*[b.column(c).to_pylist() for c in ("bucket", *columns)]):
            if row[0] != now and rows:
                yield now, rows
                rows = []
            now = row[0]
            rows.append(row[1:])
    if rows:
        yield now, rows


def _agreement(some: np.ndarray, others: np.ndarray) -> np.ndarray:
    """In how many samples each of ``some`` agrees with each of ``others``."""
    same = np.zeros((len(some), len(others)), np.uint8)
    for k in range(some.shape[1]):
        same += some[:, k][:, None] == others[:, k][None, :]
    return same


def _candidates(sample: np.ndarray, root: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Some rows low .. high-1 at a time: their agreement with all rows up to theirs, and whether that makes
    a candidate pair of two components."""
    for low in range(0, len(sample), 512):
        high = min(low + 512, len(sample))
        same = _agreement(sample[low:high], sample[:high])
        yield low, high, same, (same >= AGREE) & (root[low:high, None] != root[None, :high])


def _propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each member of a bucket a pair with the most central member that it agrees with."""
    for _, rows in _buckets(batches, ["node", "sample"]):
        sample = np.array([r[1] for r in rows], np.int32)
        central = np.concatenate([_agreement(sample[i:i + 512], sample).sum(axis=1, dtype=np.int64)
                                  for i in range(0, len(rows), 512)])
        order = np.lexsort(([r[0] for r in rows], -central))
        node, sample = [rows[i][0] for i in order], sample[order]
        out = []
        for low, high, _, fit in _candidates(sample, np.arange(len(node))):
            for i in range(low, high):
                if (other := np.flatnonzero(fit[i - low, :i])).size:
                    out.append((min(node[i], node[other[0]]), max(node[i], node[other[0]])))
        yield batch(_PAIR, out)


def _still_open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of each bucket that are candidates with a member of another component."""
    for bucket, rows in _buckets(batches, ["node", "root", "sample"]):
        if len({r[1] for r in rows}) > 1:
            root = np.unique([r[1] for r in rows], return_inverse=True)[1]
            some = np.zeros(len(rows), bool)
            for low, high, _, fit in _candidates(np.array([r[2] for r in rows], np.int32), root):
                lower = np.tril(np.ones((high, high), bool), -1)[low:high]
                fit &= lower
                some[low:high] |= fit.any(axis=1)
                some[:high] |= fit.any(axis=0)
            yield batch([("bucket", pa.int64()), ("node", pa.binary())], [(bucket, rows[i][0]) for i in np.flatnonzero(some)])


def _resolve(n: int, weights: "Weights", least: float):
    """Buckets of open members with their texts, to the pairs that join components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _buckets(batches, ["node", "root", "sample", "text"]):
            root = np.unique([r[1] for r in rows], return_inverse=True)[1]
            up = list(range(int(root.max()) + 1))
            bags: dict[int, tuple] = {}

            def find(x: int) -> int:
                while up[x] != x:
                    up[x] = up[up[x]]
                    x = up[x]
                return x

            def bag(i: int) -> tuple:
                if i not in bags:
                    _, h, tf = shingles([rows[i][3].encode()], n)
                    bags[i] = h, weights.of(h, tf)
                return bags[i]

            out = []
            for low, high, same, fit in _candidates(np.array([r[2] for r in rows], np.int32), root):
                for i in range(low, high):
                    others = np.flatnonzero(fit[i - low, :i])
                    for j in others[np.argsort(-same[i - low, others].astype(int), kind="stable")]:
                        a, b = find(root[i]), find(root[j])
                        if a != b and similarity(bag(i), bag(j)) >= least:
                            up[a] = b
                            out.append((min(rows[i][0], rows[j][0]), max(rows[i][0], rows[j][0])))
            yield batch(_PAIR, out)

    return run


def _meetings(placed: DataFrame, block: int) -> DataFrame:
    """bucket, node, root, sample: any two members of a bucket with different roots share a bucket here too. One
    of more than ``block`` members (column n) becomes buckets of about ``block`` at most: blocks of its largest
    component meet blocks of the others, and those each other."""
    columns = ["bucket", "node", "root", "sample"]
    hot = placed.filter(F.col("n") > block)
    parts = hot.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("c")).groupBy("bucket").agg(
        F.max(F.struct("c", "root")).alias("most"), F.sum("c").alias("all"))
    parts = parts.select("bucket", F.col("most.root").alias("main"), F.ceil(2 * F.col("most.c") / block).alias("inner"),
                         F.ceil(2 * (F.col("all") - F.col("most.c")) / block).alias("outer")).filter("outer > 0")
    apart = F.col("root") != F.col("main")
    own = F.pmod(F.xxhash64("node", "bucket"), F.when(apart, F.col("outer")).otherwise(F.col("inner")))
    blocks = lambda n, key: F.transform(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1), key)
    key = lambda kind, i, j: F.xxhash64("bucket", F.lit(kind), i, j)
    keys = F.when(apart, F.concat(
        blocks("inner", lambda j: key(0, F.col("own"), j)),
        blocks("outer", lambda j: key(1, F.least("own", j), F.greatest("own", j))),
    )).otherwise(blocks("outer", lambda j: key(0, j, F.col("own"))))
    dealt = hot.join(parts, "bucket").withColumn("own", own).select(F.explode(keys).alias("bucket"), "node", "root", "sample")
    return placed.filter(F.col("n") <= block).select(*columns).unionByName(dealt)


# --- verification ---------------------------------------------------------------------------

def similarity(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two (sorted hashes, weights)."""
    (h, w), (g, v) = x, y
    at = np.minimum(np.searchsorted(g, h), len(g) - 1)
    both = g[at] == h
    least = float(np.minimum(w[both], v[at[both]]).sum(dtype=np.float64))
    whole_sum = float(w.sum(dtype=np.float64)) + float(v.sum(dtype=np.float64)) - least
    return least / whole_sum if whole_sum else 0.0


def _verify(n: int, weights: Weights, least: float):
    """Rows sorted by group, the hub first; a row for each member: how similar it is to the hub."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, hub, hub_node = None, None, None
        for b in batches:
            out = []
            for group, member, node, text in zip(*[b.column(c).to_pylist() for c in ("grp", "member", "node", "text")]):
                _, h, tf = shingles([text.encode()], n)
                bag = h, weights.of(h, tf)
                if member:
                    if group == now:
                        s = similarity(hub, bag)
                        out.append((hub_node, node, s, s >= least))
                else:
                    now, hub, hub_node = group, bag, node
            yield batch([("a", pa.binary()), ("b", pa.binary()), ("similarity", pa.float64()), ("near", pa.bool_())], out)

    return run


def verify(pairs: DataFrame, texts: DataFrame, n: int, weights: Weights, least: float, chunk: int = 256) -> DataFrame:
    """a, b, similarity, near for pairs of nodes. Of a pair, the node with more pairs is its hub; the hub's text
    goes to each chunk of its pairs, so a hub of a third of the corpus is many groups."""
    degree = pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("d"))
    da, db = (degree.select(F.col("node").alias(c), F.col("d").alias(f"d{c}")) for c in "ab")
    led = pairs.join(da, "a").join(db, "b")
    first = (F.col("da") > F.col("db")) | ((F.col("da") == F.col("db")) & (F.col("a") < F.col("b")))
    led = led.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("hub"),
                     F.when(first, F.col("b")).otherwise(F.col("a")).alias("node"),
                     F.greatest("da", "db").alias("d"))
    part = F.pmod(F.xxhash64("node"), F.ceil(F.col("d") / chunk).cast("bigint"))
    led = materialize(led.withColumn("grp", F.xxhash64("hub", part)), "pairs")
    # Two hubs may share a group number only if their hashes collide; the hub stands beside it.
    asks = led.select("grp", "hub", F.lit(1).alias("member"), "node").unionByName(
        led.select("grp", "hub", F.lit(0).alias("member"), F.col("hub").alias("node")).distinct())
    rows = asks.join(texts, "node").select(F.concat("hub", F.hex("grp").cast("binary")).alias("grp"), "member", "node", "text")
    rows = rows.repartition(partitions(pairs), "grp").sortWithinPartitions("grp", "member")
    return rows.mapInArrow(_verify(n, weights, least), "a binary, b binary, similarity double, near boolean")


# --- the whole --------------------------------------------------------------------------------

def near_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 5, least: float = 0.8,
    strength: float = 0.25,
) -> DataFrame:
    """One row for each document: its id, ``text_md5``, class_id (the smallest id of its class),
    class_size and kept (one row of each class: the one with class_id).

    Classes are the components of the verified pairs; texts without words are classes of
    their own, or of their copies. Null ids come last: a class of null ids has a null class_id. Repeated rows are copies, of
    which one is kept. Empty tables give no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_column).alias("id"), whole(text_column).alias("text"))
    rows = rows.withColumn("h", F.md5("text"))
    weights = Weights(document_frequencies(rows, shingle), docs.count(), strength)
    kind = rows.schema["id"].dataType.simpleString()
    signed = rows.mapInArrow(_sign(shingle, weights, ["id", "h"]), f"id {kind}, h string, node binary, sample array<int>")
    # A text without words has no shingles: its node is its checksum, and it gets no bands.
    bare = F.col("node").isNull()
    signed = materialize(signed.select("id", "h", bare.alias("bare"), F.coalesce("node", F.unhex("h")).alias("node"), "sample"), "signed")
    nodes = materialize(signed.filter(~F.col("bare")).groupBy("node").agg(
        F.min("h").alias("h"), F.min("sample").alias("sample")), "nodes")

    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.slice("sample", i * ROWS + 1, F.lit(ROWS))))
    banded = nodes.select("node", F.explode(bands).alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = materialize(banded.join(shared, "bucket").select("node", "bucket", "n"), "members")
    active = nodes.join(members.select("node").distinct(), "node")
    active = materialize(active, "active")
    texts = rows.groupBy("h").agg(F.min("text").alias("text")).join(active.select("h", "node"), "h").select("node", "text")
    texts = materialize(texts, "texts")

    by_bucket = lambda df: df.repartition(partitions(docs), "bucket").sortWithinPartitions("bucket", "node")
    # A block of a very large bucket proposes for itself; every band deals the nodes anew.
    part = F.pmod(F.xxhash64("node", "bucket"), F.ceil(F.col("n") / _BLOCK))
    block = F.when(F.col("n") <= _BLOCK, F.col("bucket")).otherwise(F.xxhash64("bucket", part))
    placed = members.join(active.select("node", "sample"), "node").select(block.alias("bucket"), "node", "sample")
    pairs = materialize(by_bucket(placed).mapInArrow(_propose, "a binary, b binary").distinct(), "proposed")
    judged = materialize(verify(pairs, texts, shingle, weights, least), "judged")
    edges = judged.filter("near").select("a", "b")
    roots = components(edges)

    # Of buckets with the same members one is enough.
    alike = members.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("mark"))
    alike = alike.groupBy("n", "mark").agg(F.min("bucket").alias("bucket")).select("bucket")
    state = active.select("node", "sample").join(roots, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"), "sample")
    state = materialize(state, "state")
    placed = members.join(alike, "bucket").join(state, "node").select("bucket", "node", "root", "sample", "n")
    left = materialize(by_bucket(_meetings(placed, _BLOCK)).mapInArrow(_still_open, "bucket bigint, node binary"), "open")
    if not left.isEmpty():
        told = left.join(state, "node").join(texts, "node").select("bucket", "node", "root", "sample", "text")
        more = by_bucket(told).mapInArrow(_resolve(shingle, weights, least), "a binary, b binary").distinct()
        roots = components(materialize(edges.unionByName(more), "edges"))

    rooted = signed.join(roots, "node", "left").select("id", "h", F.coalesce("root", "node").alias("root"))
    rooted = materialize(rooted, "rooted")
    order = lambda: F.struct(F.col("id").isNull().alias("a"), F.col("id").alias("b"), F.col("h").alias("c"))
    classes = rooted.groupBy("root").agg(F.min(order()).alias("first"), F.count(F.lit(1)).alias("class_size"))
    classes = materialize(classes, "classes")
    copy = F.row_number().over(Window.partitionBy("id", "h").orderBy("id"))
    out = rooted.withColumn("copy", copy).join(classes, "root")
    return out.select(F.col("id").alias(id_column), F.col("h").alias("text_md5"), F.col("first.b").alias("class_id"), "class_size",
                      ((order() == F.col("first")) & (F.col("copy") == 1)).alias("kept"))


def drop_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The kept document of each class, with all its columns; of repeated rows one."""
    from wordloom.llm.common import free_name

    groups = near_groups(docs, id_column, text_column, **options)
    h, n = free_name(docs, "h"), free_name(docs, "n")
    gone = materialize(groups.filter(~F.col("kept")).select(F.col(id_column).alias("id"), F.col("text_md5").alias("h")).join(
        groups.filter("kept").select(F.col(id_column).alias("id"), F.col("text_md5").alias("h")), ["id", "h"], "left_anti").distinct(), "gone")
    marked = docs.withColumn(h, F.md5(whole(text_column)))
    left = marked.join(gone, marked[id_column].eqNullSafe(gone.id) & (marked[h] == gone.h), "left_anti")
    repeated = not docs.groupBy(id_column).count().filter("count > 1").isEmpty()
    if repeated:
        others: list[Column] = [F.to_json(F.struct(*[c for c in docs.columns if c != text_column]))]
        once = Window.partitionBy(id_column, h).orderBy(*others)
        left = left.withColumn(n, F.row_number().over(once)).filter(F.col(n) == 1)
    return left.select(*docs.columns)
