"""Exact self-join of documents by Jaccard similarity of word shingles, in the metric space of sets.

d(A, B) = 1 - |A & B| / |A | B| is a metric, and so is the size of the symmetric difference, by
which a similarity of at least 3/4 means |A ^ B| <= (|A| + |B|) / 7.

1. Documents of equal sets are one class; a class needs no comparisons among its members.
2. Two sets that similar share a shingle among the first few of each (in an order that all share:
   seldom shingles first, then by hash). The documents that hold such a shingle, cut where sizes
   differ too much, make a region, and its smallest document is the region's pivot. Every document
   is replicated to the regions (pivots) of all its first shingles, so that two linked documents
   meet in at least one; most regions have one document and end here. Regions of seldom shingles
   are made from packed postings, bucket by bucket; those of frequent ones by joins, whose hot
   keys Spark splits, so that a shingle of a third of all documents is in no single task.
3. Distances to pivots are taken exactly. A document within 1/4 of the pivot is linked with it.
   Members of a region that are both linked with the pivot are in one component and are not
   compared. Only regions with members beyond 1/4 are joined further: their far members meet all
   others within windows that follow from the triangle inequality (distances to the pivot, to the
   empty set, and to the sets' parity sketches), in blocks of bounded size.
4. What windows leave is compared exactly. Links and classes give components.

The result is exact; no step has a cap on members, partners or candidates.

Nulls and texts without words have an empty set and are linked with nothing (component: the
document itself). A null doc_id takes part in nothing and has a null component. Rows that repeat a
doc_id are in one component. Very long texts have larger sets and sketches. Extra columns are
ignored; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .common import id_text, parallelism, written
from .components import components

K = 5
#: A similarity of NUM / DEN or more links.
NUM, DEN = 3, 4
#: A shingle in this share of a task's documents (and in HOT_LEAST) is a candidate for a frequent one; it is
#: one if candidates of all tasks add up to HOT_TOTAL of all documents. So there are at most
#: (mean set size / HOT_TOTAL) frequent shingles, whatever the corpus' size.
HOT_SHARE, HOT_LEAST, HOT_TOTAL = 1 / 256, 16, 1 / 4096
#: Buckets of seldom shingles at most.
MOST_BUCKETS = 1 << 20
#: Members of a region that one task compares with one another.
BLOCK = 2000


def text_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text; fewer than K words: one for them all."""
    n = len(offsets) - 1
    start, end, doc = tk.word_spans(data, offsets, tk.ASCII_SPACE)
    words = tk.span_hash(tk.prefix_hash(tk.LOWER[data]), start, end)
    value, at = tk.windows(words, doc, K)
    cut = np.searchsorted(doc[at], np.arange(n + 1)) if len(at) else np.zeros(n + 1, np.int64)
    first = np.searchsorted(doc, np.arange(n + 1))
    out = []
    for i in range(n):
        if cut[i + 1] > cut[i]:
            out.append(np.unique(value[cut[i] : cut[i + 1]]))
        elif first[i + 1] > first[i]:
            own = words[first[i] : first[i + 1]]
            out.append(tk.windows(own + np.uint64(len(own)), np.zeros(len(own), np.int64), len(own))[0])
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def prefix_size(n: int) -> int:
    return n - -(-NUM * n // DEN) + 1


def sketch(values: np.ndarray) -> np.ndarray:
    """Parities of the set's hashes in 2**i cells: the Hamming distance of two sketches never exceeds |A ^ B|."""
    cells = 1 << min(16, max(8, int(len(values) - 1).bit_length()))
    return np.packbits(np.bincount((tk.mix(values) & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1 > 0)


def folded(x: np.ndarray, size: int) -> np.ndarray:
    """A sketch over fewer cells."""
    return np.bitwise_xor.reduce(x.reshape(-1, size), axis=0) if len(x) > size else x


def apart(a: np.ndarray, b: np.ndarray) -> int:
    size = min(len(a), len(b))
    return int(np.bitwise_count(folded(a, size) ^ folded(b, size)).sum())


def similar(a: np.ndarray, b: np.ndarray) -> tuple[bool, float]:
    """Linked, and the exact distance."""
    both = len(a) + len(b) - len(np.union1d(a, b))
    union = len(a) + len(b) - both
    return DEN * both >= NUM * union and union > 0, 1 - both / union if union else 1.0


# --- passes over texts ------------------------------------------------------------------------

SETS = "kind int, doc_id long, n long, d1 long, d2 long"


def set_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """kind 0: a document's set size and digest; kind 1: a frequent shingle (d1) and in how many of the task's documents (n)."""
    names, seen, docs = [x.split()[0] for x in SETS.split(", ")], [], 0
    kept_values, kept_counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def fold() -> None:
        nonlocal kept_values, kept_counts, seen
        if seen:
            values, counts = np.unique(np.concatenate(seen), return_counts=True)
            few = counts >= 2  # what occurs once among so many is left out; the order need not be perfect
            values, inverse = np.unique(np.concatenate([kept_values, values[few]]), return_inverse=True)
            kept_counts = np.bincount(inverse, weights=np.concatenate([kept_counts, counts[few]])).astype(np.int64)
            kept_values, seen = values, []

    for batch in tk.slices(batches):
        sets = text_sets(*tk.flat(batch.column("text")))
        docs += len(sets)
        seen.append(np.concatenate(sets))
        if sum(map(len, seen)) > 2 << 20:
            fold()
        digests = np.frombuffer(b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets), np.int64).reshape(-1, 2)
        n = np.fromiter(map(len, sets), np.int64, len(sets))
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(sets), np.int32)), batch.column("doc_id"), pa.array(n), pa.array(digests[:, 0].copy()), pa.array(digests[:, 1].copy())], names=names)
    fold()
    hot = kept_counts >= max(HOT_LEAST, docs * HOT_SHARE)
    m = int(hot.sum())
    yield pa.RecordBatch.from_arrays([pa.array(np.ones(m, np.int32)), pa.nulls(m, pa.int64()), pa.array(kept_counts[hot]), pa.array(kept_values[hot].view(np.int64)), pa.nulls(m, pa.int64())], names=names)


def postings(docs: DataFrame, hot: np.ndarray, buckets: int) -> DataFrame:
    """Blobs of postings of documents' first shingles: bucket, values (without the bucket's bits), doc ids, set sizes.

    Postings of frequent shingles (by their number in hot) have buckets below 0, dealt out evenly.
    """
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def blobs(bucket: np.ndarray, value: np.ndarray, doc: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.argsort(bucket, kind="stable")
        kinds, first = np.unique(bucket[order], return_index=True)
        cut = [*first.tolist(), len(order)]
        value, doc, n = value[order], doc[order], n[order]
        parts = [slice(a, b) for a, b in zip(cut[:-1], cut[1:])]
        for at in range(0, len(parts), 64):
            some = parts[at : at + 64]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(kinds[at : at + 64], pa.int32()),
                    pa.array([(value[p] >> np.uint64(16)).astype("<u4").tobytes() for p in some], pa.binary()),
                    pa.array([value[p].astype("<u2").tobytes() for p in some], pa.binary()),
                    pa.array([doc[p].tobytes() for p in some], pa.binary()),
                    pa.array([n[p].astype("<u4").tobytes() for p in some], pa.binary()),
                ],
                names=["bucket", "high", "low", "docs", "sizes"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pending: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        turn = TaskContext.get().partitionId()

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal turn
            if not pending:
                return
            value, doc, n, frequent = (np.concatenate(x) for x in zip(*pending))
            pending.clear()
            seldom = ~frequent
            yield from blobs((value[seldom] & np.uint64(buckets - 1)).astype(np.int32), value[seldom] >> np.uint64(16), doc[seldom], n[seldom])
            if frequent.any():
                number = np.searchsorted(shared.value, value[frequent]).astype(np.uint64)
                yield from blobs((-1 - (turn + np.arange(len(number)) // 4096) % buckets).astype(np.int32), number, doc[frequent], n[frequent])
                turn += len(number) // 4096 + 1

        size = 0
        for batch in tk.slices(batches):
            sets = text_sets(*tk.flat(batch.column("text")))
            ids = batch.column("doc_id").to_pylist()
            mine: set[bytes] = set()
            for doc, values in zip(ids, sets):
                if not len(values):
                    continue
                key = hashlib.blake2b(values.tobytes(), digest_size=16).digest()
                if key in mine:  # the class has a member in this batch already
                    continue
                mine.add(key)
                frequent = shared.value[np.minimum(np.searchsorted(shared.value, values), len(shared.value) - 1)] == values if len(shared.value) else np.zeros(len(values), bool)
                many = prefix_size(len(values))
                rare = values[~frequent][:many]
                chosen = np.concatenate([rare, values[frequent][: many - len(rare)]])
                pending.append((chosen, np.full(many, doc, np.int64), np.full(many, len(values), np.int64), np.arange(many) >= len(rare)))
                size += many
            if size > 1 << 20:
                yield from flush()
                size = 0
        yield from flush()

    return docs.mapInArrow(run, "bucket int, high binary, low binary, docs binary, sizes binary")


REGIONS = "hot long, pivot long, doc_id long, n long"


def regions(frame: pd.DataFrame) -> pd.DataFrame:
    """Of a bucket: every member of every region, with the region's pivot (hot: -1); each pair once. Postings of frequent shingles are only unpacked (hot: their number)."""
    high, low = (np.frombuffer(b"".join(frame[c]), t).astype(np.uint64) for c, t in (("high", "<u4"), ("low", "<u2")))
    doc, n = np.frombuffer(b"".join(frame["docs"]), np.int64), np.frombuffer(b"".join(frame["sizes"]), "<u4").astype(np.int64)
    value = high << np.uint64(16) | low
    if frame["bucket"].iloc[0] < 0:
        return pd.DataFrame({"hot": value.astype(np.int64), "pivot": doc, "doc_id": doc, "n": n})
    _, inverse, count = np.unique(value, return_inverse=True, return_counts=True)
    many = np.flatnonzero(count[inverse] > 1)
    value, doc, n = inverse[many], doc[many], n[many]
    order = np.lexsort((doc, n, value))
    value, doc, n = value[order], doc[order], n[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (DEN * n[:-1] < NUM * n[1:])  # no set beyond is similar to one before
    region = np.cumsum(fresh) - 1
    order = np.lexsort((doc, region))
    region, doc, n = region[order], doc[order], n[order]
    first = np.flatnonzero(np.diff(region, prepend=-1))
    out = pd.DataFrame({"hot": np.full(len(doc), -1), "pivot": doc[first][region], "doc_id": doc, "n": n})
    return out[out.pivot != out.doc_id].drop_duplicates(["pivot", "doc_id", "n"])


def frequent_regions(found: DataFrame) -> DataFrame:
    """pivot and doc_id of the regions of frequent shingles, from their postings.

    Sizes are classed by powers of DEN / NUM; a document takes part in its class and the one above,
    so that two sets of possible similarity share one. Pivots are minima, taken before the shuffle.
    """
    size_class = F.floor(F.log("n") / F.log(F.lit(DEN / NUM)))
    rows = found.where("hot >= 0").select("hot", "doc_id", F.explode(F.array(size_class, size_class + 1)).alias("class"))
    pivots = written(rows.groupBy("hot", "class").agg(F.min("doc_id").alias("pivot"), F.max("doc_id").alias("last")).where("last > pivot").drop("last"))
    return rows.join(pivots, ["hot", "class"]).where("doc_id > pivot").select("pivot", "doc_id").distinct()


def text_table(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id, n, sketch and text of the wanted documents."""

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        sets = text_sets(*tk.flat(rows.column("text")))
        return pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([sketch(s).tobytes() for s in sets], pa.binary()), rows.column("text")], names=["doc_id", "n", "sketch", "text"])

    return docs.join(wanted, "doc_id", "left_semi").mapInArrow(tk.arrow_map(batch), "doc_id long, n long, sketch binary, text string")


def sketch_filter(pairs: DataFrame, texts: DataFrame, a: str, b: str) -> DataFrame:
    """pairs with maybe: whether sizes and sketches leave a similarity of NUM / DEN possible."""
    slim = texts.select("doc_id", "n", "sketch")
    joined = pairs.join(slim.select(F.col("doc_id").alias(a), F.col("n").alias("n_a"), F.col("sketch").alias("s_a")), a)
    joined = joined.join(slim.select(F.col("doc_id").alias(b), F.col("n").alias("n_b"), F.col("sketch").alias("s_b")), b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            bound = [sketch_bound(p, q, m, n) for p, q, m, n in zip(x.column("s_a").to_pylist(), x.column("s_b").to_pylist(), x.column("n_a").to_pylist(), x.column("n_b").to_pylist())]
            yield pa.RecordBatch.from_arrays([x.column(a), x.column(b), pa.array(bound, pa.float64())], names=[a, b, "at_least"])

    return joined.mapInArrow(run, f"{a} long, {b} long, at_least double")


def sketch_bound(p: bytes, q: bytes, m: int, n: int) -> float:
    """A distance that the two sets have at least."""
    h = max(abs(m - n), apart(np.frombuffer(p, np.uint8), np.frombuffer(q, np.uint8)))
    return 2 * h / (m + n + h) if h else 0.0


def verify(pairs: DataFrame, texts: DataFrame, a: str, b: str) -> DataFrame:
    """pairs with their exact distance."""
    slim = texts.select("doc_id", "text")
    joined = pairs.select(a, b).join(slim.select(F.col("doc_id").alias(a), F.col("text").alias("t_a")), a)
    joined = joined.join(slim.select(F.col("doc_id").alias(b), F.col("text").alias("t_b")), b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in tk.slices(batches, "t_a", 1 << 20):
            left, right = text_sets(*tk.flat(x.column("t_a"))), text_sets(*tk.flat(x.column("t_b")))
            found = [similar(p, q) for p, q in zip(left, right)]
            yield pa.RecordBatch.from_arrays([x.column(a), x.column(b), pa.array([f[0] for f in found], pa.bool_()), pa.array([f[1] for f in found], pa.float64())], names=[a, b, "linked", "distance"])

    return joined.mapInArrow(run, f"{a} long, {b} long, linked boolean, distance double")


# --- regions with far members -----------------------------------------------------------------

MAX_DISTANCE = 1 - NUM / DEN


def block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block: far members against members of other components, by the windows."""
    for rows in tk.whole_groups(batches, ["pivot", "row", "col"]):
        column = {c: rows.column(c).to_numpy() for c in ("pivot", "row", "col", "side", "doc_id", "n", "distance", "far", "label")}
        raw, offsets = tk.flat(rows.column("sketch"))
        size = np.diff(offsets)
        fresh = np.ones(rows.num_rows, bool)
        fresh[1:] = (column["pivot"][1:] != column["pivot"][:-1]) | (column["row"][1:] != column["row"][:-1]) | (column["col"][1:] != column["col"][:-1])
        cuts = [*np.flatnonzero(fresh).tolist(), rows.num_rows]
        out: list[np.ndarray] = [np.zeros((0, 2), np.int64)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            side, doc, n, d, far, label = (column[c][a:b] for c in ("side", "doc_id", "n", "distance", "far", "label"))
            near = np.flatnonzero(side == 1)
            for u in np.flatnonzero(side == 0).tolist():
                # A far member's distance to the pivot is a lower bound; a linked one's is exact.
                able = (DEN * np.minimum(n[near], n[u]) >= NUM * np.maximum(n[near], n[u])) & (label[near] != label[u])
                able &= np.where(far[near], doc[near] > doc[u], d[u] - d[near] <= MAX_DISTANCE + 1e-9)
                for y in _close(raw, offsets[a:b], size[a:b], u, near[able], n):
                    out.append(np.array([[doc[u], doc[y]]]))
        pairs = np.concatenate(out)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _close(raw: np.ndarray, offsets: np.ndarray, size: np.ndarray, u: int, others: np.ndarray, n: np.ndarray) -> list[int]:
    """Which of the others the sketches leave possible for u."""
    found: list[int] = []
    own = raw[offsets[u] : offsets[u] + size[u]]
    for z in np.unique(size[others]).tolist():
        some = others[size[others] == z]
        least = min(len(own), z)
        stack = raw[offsets[some][:, None] + np.arange(z)]
        if z > least:
            stack = np.bitwise_xor.reduce(stack.reshape(len(some), -1, least), axis=1)
        h = np.bitwise_count(stack ^ folded(own, least)).sum(axis=1)
        found += some[(NUM + DEN) * h <= n[u] + n[some]].tolist()
    return found


def far_pairs(checked: DataFrame, texts: DataFrame, partitions: int) -> DataFrame:
    """Candidate pairs within regions that have far members: checked has pivot, doc_id, label (of its component so far), distance and far."""
    open_regions = checked.groupBy("pivot").agg(F.count("*").alias("members"), F.count_if("far").alias("n_far"), F.min("label").alias("x"), F.max("label").alias("y")).where("n_far > 0 and x < y")
    cells = written(open_regions.select("pivot", F.ceil(F.col("members") / BLOCK).cast("int").alias("cols"), F.ceil(F.col("n_far") / BLOCK).cast("int").alias("rows")))
    members = checked.join(cells, "pivot").join(texts.select("doc_id", "n", "sketch"), "doc_id")
    spot = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n)).cast("int")
    # Every far member meets every column of its row; every member is in one column, in all rows.
    near = members.select("*", F.lit(1).alias("side"), spot("cols").alias("col"), F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("row"))
    far = members.where("far").select("*", F.lit(0).alias("side"), F.explode(F.sequence(F.lit(0), F.col("cols") - 1)).alias("col"), spot("rows").alias("row"))
    both = near.unionByName(far).select("pivot", "row", "col", "side", "doc_id", "n", "distance", "far", "label", "sketch")
    return both.repartition(partitions, "pivot", "row", "col").sortWithinPartitions("pivot", "row", "col").mapInArrow(block_pairs, "a long, b long").distinct()


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    spark = docs.sparkSession
    base = id_text(docs)
    partitions = parallelism(spark)
    sets = written(base.mapInArrow(set_pass, SETS))
    own = sets.where("kind = 0").select("doc_id", "n", "d1", "d2")
    # Bounded: see HOT_TOTAL.
    often = sets.where("kind = 1").groupBy("d1").agg(F.sum("n").alias("n")).where(F.col("n") >= own.count() * HOT_TOTAL)
    hot = np.sort(often.select("d1").toArrow().column("d1").to_numpy().view(np.uint64))

    named = base.where("doc_id is not null")
    buckets = min(MOST_BUCKETS, 1 << max(8, (named.rdd.getNumPartitions() // 2).bit_length()))
    blobs = postings(named, hot, buckets).repartition(min(buckets, max(partitions, 64)), "bucket")
    found = written(blobs.groupBy("bucket").applyInPandas(regions, REGIONS))
    members = found.where("hot < 0").select("pivot", "doc_id").distinct().unionByName(frequent_regions(found))

    # Copies are compared as their class' first document.
    classes = written(own.where("n > 0 and doc_id is not null").groupBy("d1", "d2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("last > first"))
    same = written(own.join(classes, ["d1", "d2"]).where("doc_id > first").select(F.col("first").alias("a"), F.col("doc_id").alias("b")))
    of = lambda name: same.select(F.col("b").alias(name), F.col("a").alias(f"{name}_first"))
    members = members.join(of("pivot"), "pivot", "left").join(of("doc_id"), "doc_id", "left")
    members = members.select(F.coalesce("pivot_first", "pivot").alias("pivot"), F.coalesce("doc_id_first", "doc_id").alias("doc_id"))
    members = written(members.where("pivot <> doc_id").distinct())

    wanted = members.select("doc_id").union(members.select(F.col("pivot").alias("doc_id"))).distinct()
    texts = written(text_table(named, wanted))
    bounds = written(sketch_filter(members, texts, "pivot", "doc_id").groupBy("pivot", "doc_id").agg(F.min("at_least").alias("at_least")))
    maybe = bounds.where(F.col("at_least") <= MAX_DISTANCE + 1e-9)
    exact = written(verify(maybe, texts, "pivot", "doc_id").groupBy("pivot", "doc_id").agg(F.max("linked").alias("linked"), F.min("distance").alias("distance")))
    links = exact.where("linked").select(F.col("pivot").alias("a"), F.col("doc_id").alias("b"))

    so_far = components(links.unionByName(same)).select(F.col("component").alias("a"), F.col("node").alias("b"))

    checked = bounds.join(exact, ["pivot", "doc_id"], "left").join(so_far.select(F.col("b").alias("doc_id"), F.col("a").alias("label")), "doc_id", "left")
    checked = written(checked.select("pivot", "doc_id", F.coalesce("label", "doc_id").alias("label"), F.coalesce("distance", "at_least").alias("distance"), (~F.coalesce("linked", F.lit(False))).alias("far")))
    more = written(far_pairs(checked, texts, partitions))
    found = components(so_far.unionByName(verify(more, texts, "a", "b").where("linked").select("a", "b")))
    out = own.join(found, own["doc_id"] == found["node"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


ORACLE_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < {K} THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - {K} + 2), lambda i: array_to_string(words[i : i + {K} - 1], ' ')) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE {DEN} * common >= {NUM} * (x.n + y.n - common)),
r(doc_id, least) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.least FROM r JOIN l ON l.a = r.doc_id WHERE r.least < l.b)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.least) AS component_id
FROM documents d JOIN r ON r.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""
