"""Benchmark decontamination by a distributed positional inverted index.

The corpus is indexed in self-contained segments (one row each: documents of a few MB, with a
posting list of word positions for every term), stored in the shared folder. Test windows are
looked up in every segment: the posting lists of a window's terms are taken from the rarest (in
the whole corpus) to the most frequent, each shifted by the term's place in the window, and
intersected. What is left are exact phrase occurrences; the same lists, intersected with a
tolerance for the rarest terms, give proximity matches. Neither depends on how the corpus is
partitioned.

Only terms that the test items contain are given posting lists. The test set is taken in blocks of
about BLOCK_BYTES of text, one after the other: a block is read, its terms are indexed and looked up,
the result is written, and the block is released before the next one is read. So what the driver and
the broadcasts hold is bounded whatever the size of the test set, and every block is one more pass over
the corpus. Results of several blocks are merged by document; those of one and of many are equal.

Items are told apart by item_id: rows that repeat one are searched row by row, and a document that
holds windows of several lists the id once. Rows with a null item_id are searched like any others;
as in ORACLE_SQL, their hits count, they are together one of n_items, and they are not listed in
items, its digest or near_items.

Nulls and empty texts have no words and stay clean; an item without words matches nothing. A null
doc_id is kept as it is; repeated rows get a row each. Very long texts form a segment alone.
Empty tables give no rows, or only clean ones. Extra columns are ignored.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .common import id_text, written

WINDOW = 10
#: Bytes of test text broadcast at once.
BLOCK_BYTES = 16 << 20
#: Proximity: the rarest terms of a window, each within SLOP words of its place.
RARE_TERMS, SLOP = 3, 3
GAP = 64  # free positions between documents: more than a window and the tolerance
CANDIDATES = 1 << 20

SEPARATOR = np.ones(256, bool)
SEPARATOR[48:58] = SEPARATOR[97:123] = SEPARATOR[128:] = False

SEGMENT = "segment long, doc_ids array<long>, n_words array<long>, terms binary, sizes binary, postings binary"
FOUND = "segment long, place long, doc_id long, n_words long, runs array<struct<start:long,end:long>>, items array<string>, near_items array<string>"


class TestBlock:
    """Windows of a block of test items, their terms, and the items that hold each window."""

    def __init__(self, ids: list, texts: pa.Array):
        data, offsets = tk.flat(texts)
        data = tk.LOWER[data]
        start, end, doc = tk.word_spans(data, offsets, SEPARATOR)
        words = tk.span_hash(tk.prefix_hash(data), start, end)
        self.ids = [None if x is None else str(x) for x in ids]
        self.terms = np.unique(words)
        term = np.searchsorted(self.terms, words)
        first = np.searchsorted(doc, np.arange(len(ids)))
        count = np.bincount(doc, minlength=len(ids)) if len(doc) else np.zeros(len(ids), np.int64)
        by_length: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for item, (a, n) in enumerate(zip(first.tolist(), count.tolist())):
            if n:
                width = min(n, WINDOW)
                rows = np.lib.stride_tricks.sliding_window_view(term[a : a + n], width)
                by_length.setdefault(width, []).append((rows, np.full(len(rows), item)))
        #: (distinct windows as rows of terms, window numbers and item numbers that belong together)
        self.windows = []
        for rows in by_length.values():
            distinct, inverse = np.unique(np.concatenate([r for r, _ in rows]).astype(np.int32), axis=0, return_inverse=True)
            pairs = np.unique(np.stack([inverse.ravel(), np.concatenate([i for _, i in rows])], axis=1), axis=0)
            self.windows.append((distinct, pairs[:, 0], pairs[:, 1]))


def test_rows(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def n_blocks(benchmark: DataFrame) -> int:
    """Blocks that the test set is taken in."""
    size = test_rows(benchmark).agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return max(1, math.ceil(size / BLOCK_BYTES))


def read_block(benchmark: DataFrame, i: int, n: int) -> TestBlock:
    """The i-th of n blocks; rows are spread by item and text, so that a block has about its share of the bytes."""
    rows = test_rows(benchmark)
    arrow = (rows if n == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)).toArrow()
    return TestBlock(arrow.column("item_id").to_pylist(), arrow.column("text").combine_chunks())


def build_index(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """Segments with posting lists for the given terms (sorted word hashes)."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        vocabulary, number = shared.value, TaskContext.get().partitionId() << 32
        for batch in tk.slices(batches):
            data, offsets = tk.flat(batch.column("text"))
            data = tk.LOWER[data]
            start, end, doc = tk.word_spans(data, offsets, SEPARATOR)
            words = tk.span_hash(tk.prefix_hash(data), start, end)
            n_words = np.bincount(doc, minlength=batch.num_rows)
            place = np.arange(len(words)) + GAP * (doc + 1)
            term = np.searchsorted(vocabulary, words)
            hit = np.flatnonzero(vocabulary[np.minimum(term, len(vocabulary) - 1)] == words) if len(vocabulary) else np.zeros(0, np.int64)
            order = hit[np.argsort(term[hit], kind="stable")]
            kinds, sizes = np.unique(term[order], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([n_words], pa.list_(pa.int64())),
                    *(pa.array([x.astype("<u4").tobytes()], pa.binary()) for x in (kinds, sizes, place[order])),
                ],
                names=[x.split()[0] for x in SEGMENT.split(", ")],
            )
            number += 1

    return id_text(docs).mapInArrow(run, SEGMENT)


def occurrences(index: DataFrame, n_terms: int) -> np.ndarray:
    """How often each term stands in the corpus; what is gathered is a number for each test term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            for kinds, sizes in zip(batch.column("terms"), batch.column("sizes")):
                total[np.frombuffer(kinds.as_py(), "<u4")] += np.frombuffer(sizes.as_py(), "<u4")
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "n"])

    found = index.select("terms", "sizes").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(n_terms, np.int64)
    out[found.column("term").to_numpy()] = found.column("n").to_numpy()
    return out


class Segment:
    def __init__(self, row: dict, n_terms: int):
        kinds, sizes = (np.frombuffer(row[k], "<u4").astype(np.int64) for k in ("terms", "sizes"))
        self.postings = np.frombuffer(row["postings"], "<u4").astype(np.int64)
        self.size = np.zeros(n_terms, np.int64)
        self.size[kinds] = sizes
        self.first = np.zeros(n_terms, np.int64)
        self.first[kinds] = np.cumsum(sizes) - sizes
        self.keys = (np.repeat(kinds, sizes) << 32) | self.postings
        self.n_words = np.array(row["n_words"], np.int64)
        self.base = np.cumsum(self.n_words) - self.n_words + GAP * np.arange(1, len(self.n_words) + 1)

    def holds(self, term: np.ndarray, place: np.ndarray, slop: int = 0) -> np.ndarray:
        """Which places (give or take slop) are in the terms' posting lists."""
        term = term.astype(np.int64)
        low = (term << 32) | np.maximum(place - slop, 0)
        at = np.minimum(np.searchsorted(self.keys, low), len(self.keys) - 1)
        found = self.keys[at]
        return (found >= low) & (found <= ((term << 32) | (place + slop)))

    def search(self, rows: np.ndarray, rare: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of exact matches the windows and first places, of proximity matches the windows and documents. rare: places of each window's terms, rarest first."""
        none = np.zeros(0, np.int64)
        exact, near = [(none, none)], [(none, none)]
        if not len(self.keys):
            return *exact[0], *near[0]
        width = rows.shape[1]
        few = min(RARE_TERMS, width)
        size = np.take_along_axis(self.size[rows], rare, axis=1)
        alive = np.flatnonzero(size[:, :few].min(axis=1) > 0)
        load = np.cumsum(size[alive, 0])
        cut = [0, *np.searchsorted(load, np.arange(CANDIDATES, int(load[-1]) if len(load) else 0, CANDIDATES)).tolist(), len(alive)]
        for a, b in zip(cut[:-1], cut[1:]):
            own = alive[a:b]
            n = size[own, 0]
            window = np.repeat(own, n)
            anchor = rows[own, rare[own, 0]]
            start = self.postings[np.repeat(self.first[anchor] - (np.cumsum(n) - n), n) + np.arange(n.sum())] - rare[window, 0]
            w, s = window, start
            for j in range(1, width):
                spot = rare[w, j]
                keep = self.holds(rows[w, spot], s + spot)
                w, s = w[keep], s[keep]
            exact.append((w, s))
            w, s = window, start
            for j in range(1, few):
                spot = rare[w, j]
                keep = self.holds(rows[w, spot], s + spot, SLOP)
                w, s = w[keep], s[keep]
            pairs = np.unique(np.stack([w, self.document(s + rare[w, 0])], axis=1), axis=0)
            near.append((pairs[:, 0], pairs[:, 1]))
        return *(np.concatenate(x) for x in zip(*exact)), *(np.concatenate(x) for x in zip(*near))

    def document(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.base, place, "right") - 1


def look_up(index: DataFrame, block: TestBlock, total: np.ndarray) -> DataFrame:
    """A row for every document: runs of hit words (counted in the document), items found exactly and nearly."""
    shared = index.sparkSession.sparkContext.broadcast((block, total))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test, totals = shared.value
        orders = [np.argsort(totals[rows], axis=1, kind="stable") for rows, _, _ in test.windows]
        for batch in batches:
            for row in batch.to_pylist():
                segment = Segment(row, len(totals))
                n = len(segment.n_words)
                items: list[set] = [set() for _ in range(n)]
                near: list[set] = [set() for _ in range(n)]
                runs: list[list] = [[] for _ in range(n)]
                total = int(segment.base[-1] + segment.n_words[-1]) + GAP if n else 0
                cover = np.zeros(total + 1, np.int64)
                for (rows, window_of, item_of), rare in zip(test.windows, orders):
                    w, s, nw, nd = segment.search(rows, rare)
                    np.add.at(cover, s, 1)
                    np.add.at(cover, s + rows.shape[1], -1)
                    first = np.searchsorted(window_of, np.arange(len(rows) + 1))
                    for window, d, out in ((w, segment.document(s), items), (nw, nd, near)):
                        pairs = np.unique(np.stack([window, d], axis=1), axis=0)
                        for x, y in pairs.tolist():
                            out[y].update(item_of[first[x] : first[x + 1]].tolist())
                hit = np.diff((np.cumsum(cover) > 0).astype(np.int8), prepend=0)
                a, b = np.flatnonzero(hit == 1), np.flatnonzero(hit == -1)
                d = segment.document(a)
                for x, y, z in zip(a.tolist(), b.tolist(), d.tolist()):
                    runs[z].append({"start": x - int(segment.base[z]), "end": y - int(segment.base[z])})
                ids = lambda sets: [{test.ids[i] for i in x} for x in sets]
                text = lambda sets: pa.array([sorted(x - {None}) + [None] * (None in x) for x in sets], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["segment"]] * n, pa.int64()),
                        pa.array(range(n), pa.int64()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(segment.n_words, pa.int64()),
                        pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                        text(ids(items)),
                        text([x - {None} for x in ids(near)]),
                    ],
                    names=["segment", "place", "doc_id", "n_words", "runs", "items", "near_items"],
                )

    return index.mapInArrow(run, FOUND)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for every document, as in FOUND."""
    n = n_blocks(benchmark)
    if n == 1:
        block = read_block(benchmark, 0, 1)
        index = written(build_index(docs, block.terms))
        return look_up(index, block, occurrences(index, len(block.terms)))
    docs, parts = written(id_text(docs)), []  # the same segments in every pass
    for i in range(n):
        block = read_block(benchmark, i, n)
        index = written(build_index(docs, block.terms))
        parts.append(written(look_up(index, block, occurrences(index, len(block.terms)))))
    out = reduce(lambda a, b: a.unionByName(b), parts)
    joined = out.groupBy("segment", "place").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("runs"))).alias("runs"),
        *(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("items", "near_items")),
    )
    merged = """aggregate(runs, cast(array() as array<struct<start:bigint,end:bigint>>), (done, x) ->
        if(size(done) > 0 and element_at(done, -1).end >= x.start,
           concat(slice(done, 1, size(done) - 1), array(named_struct('start', element_at(done, -1).start, 'end', greatest(element_at(done, -1).end, x.end)))),
           concat(done, array(x))))"""
    return joined.withColumn("runs", F.expr(merged))


def summary(found: DataFrame) -> DataFrame:
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda done, x: done + x["end"] - x["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("runs") > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near_items"),
        F.array_join("items", ",").alias("items"),
    )


ORACLE_SQL = rf"""
WITH t AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
l AS (
  SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM t),
win AS (
  SELECT id AS item, i AS pos, words[i : i + least({WINDOW}, len(words)) - 1] AS words
  FROM (SELECT id, words, unnest(range(1, len(words) - least({WINDOW}, len(words)) + 2)) AS i FROM l WHERE kind = 'i' AND len(words) > 0)),
sizes AS (SELECT DISTINCT len(words) AS n FROM win),
spots AS (
  SELECT id AS doc, i AS pos, n, array_to_string(words[i : i + n - 1], ' ') AS phrase
  FROM (SELECT id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM l, sizes WHERE kind = 'd' AND len(words) >= n)),
hits AS (SELECT doc, spots.pos, n, item FROM spots JOIN win ON phrase = array_to_string(win.words, ' ') AND n = len(win.words)),
covered AS (SELECT doc, count(DISTINCT place) AS n_hit FROM (SELECT doc, unnest(range(pos, pos + n)) AS place FROM hits) GROUP BY doc),
found AS (SELECT doc, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc, CAST(item AS VARCHAR) AS item FROM hits) GROUP BY doc),
post AS (SELECT id AS doc, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM l WHERE kind = 'd'),
total AS (SELECT word, count(*) AS n FROM post GROUP BY word),
terms AS (
  SELECT item, pos, word, k, row_number() OVER (PARTITION BY item, pos ORDER BY coalesce(n, 0), k) AS nth
  FROM (SELECT item, pos, unnest(words) AS word, generate_subscripts(words, 1) AS k FROM win) LEFT JOIN total USING (word)),
rare AS (SELECT * FROM terms WHERE nth <= {RARE_TERMS}),
kept AS (SELECT p.* FROM post p SEMI JOIN rare ON rare.word = p.word),
close AS (
  SELECT a.doc, r.item, r.pos, a.place, count(DISTINCT o.nth) AS n, any_value(r.width) AS all_n
  FROM (SELECT *, count(*) OVER (PARTITION BY item, pos) AS width FROM rare) r JOIN kept a ON a.word = r.word AND r.nth = 1
  JOIN rare o ON o.item = r.item AND o.pos = r.pos
  JOIN kept q ON q.doc = a.doc AND q.word = o.word AND abs(q.place - (a.place - r.k + o.k)) <= CASE WHEN o.nth = 1 THEN 0 ELSE {SLOP} END
  GROUP BY a.doc, r.item, r.pos, a.place),
near AS (SELECT doc, count(DISTINCT item) AS n_near_items FROM close WHERE n = all_n GROUP BY doc)
SELECT id AS doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near_items, 0) AS n_near_items, coalesce(items, '') AS items
FROM l LEFT JOIN covered c ON c.doc = id LEFT JOIN found f ON f.doc = id LEFT JOIN near e ON e.doc = id WHERE kind = 'd'
"""
