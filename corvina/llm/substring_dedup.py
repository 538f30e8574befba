"""Removal of repeated byte strings, by content-anchored window hashes.

A byte goes if a LENGTH-byte string that covers it also starts earlier in the corpus (smaller
doc_id, or same document and earlier start). External induced sorting of all suffixes, the method
dealt, writes a tuple for each of them several times over, which is many times the input on disk (see
README for figures). Here no suffix array is made: windows of equal bytes are brought together by hashes.

1. Every LENGTH-byte window has one anchor, the least of the hashes of its GRAM-byte strings (the
   leftmost of equals). Equal windows have the same anchor at the same place; consecutive windows
   with one anchor (about 35) form a run.
2. Runs are spread by the hash of their anchor's string and sorted by (anchor, hash of the whole run,
   document, place). All but the first of equal runs are repeats in every window, without looking
   at one of them.
3. Where runs with one anchor string differ, the runs' first occurrences are read again and their
   windows compared one by one; anchors with more than WIDE different runs (of up to 69 windows
   each) do that by window hash over all tasks instead of in one.

Within a map task, all but the first of equal runs are settled before the shuffle. Spark's sorts
and shuffles spill to disk, so no shard has to fit in memory. The result is exact but for hashes:
anchors, runs and windows are each compared by 64 bits, runs and windows among those with equal
anchors only, so n different runs at one anchor make an error with a probability of about
n ** 2 / 2 ** 65.

Nulls and empty texts have no bytes. Rows with a null doc_id stay whole and are no source for
others. Rows that repeat a doc_id count as one document: the same place in both is not earlier,
and what is removed at a place is removed in all. Very long texts are handled whole. Empty tables
give no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .common import id_text, parallelism, written

LENGTH, GRAM = 100, 32
SPREAD = LENGTH - GRAM + 1  # anchors that a window can have
#: Text of a task whose runs are compared before the shuffle; runs whose windows a task compares at once.
FLUSH_BYTES, WIDE = 24 << 20, 1 << 12
MOST_BUCKETS = 1 << 20

RUNS = "kind int, key long, doc_id long, lo long, hi long, back int"


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` values in a row."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of every run: its text, first and last window (places in data), anchor, hash of the anchor's string, hash of the run."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return (none,) * 4 + (none.astype(np.uint64),) * 2
    prefix = tk.prefix_hash(data)
    places = np.arange(len(data) - GRAM + 1)
    grams = tk.span_hash(prefix, places, places + GRAM)
    least = sliding_min((grams & np.uint64(0xFFFFFFFF00000000)) | places.astype(np.uint64), SPREAD)
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    long = np.flatnonzero(np.diff(offsets) >= LENGTH)
    valid = np.zeros(len(anchor) + 1, np.int32)
    np.add.at(valid, offsets[long], 1)
    np.add.at(valid, offsets[long + 1] - LENGTH + 1, -1)
    window = np.flatnonzero(np.cumsum(valid[:-1]) > 0)
    if not len(window):
        return (none,) * 4 + (none.astype(np.uint64),) * 2
    anchor = anchor[window]
    doc = np.searchsorted(offsets, window, "right") - 1
    fresh = np.ones(len(window), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(window)) - 1
    lo, hi, anchor = window[first], window[last], anchor[first]
    whole = tk.span_hash(prefix, lo, hi + LENGTH) ^ tk.mix((anchor - lo).astype(np.uint64))
    return doc[first], lo, hi, anchor, grams[anchor], whole


def _packed(*columns: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(c.tobytes() for c in columns))


def run_blobs(docs: DataFrame, buckets: int) -> DataFrame:
    """bucket, n and packed columns of runs; settled: runs that an earlier one in the same task equals."""

    def blob(bucket: int, settled: bool, doc, lo, hi, back, gram=None, whole=None) -> tuple:
        order = np.lexsort((lo, doc))
        doc, lo, hi, back = doc[order], lo[order], hi[order], back[order]
        where = _packed(np.diff(doc, prepend=0), lo.astype("<u4"), (hi - lo).astype(np.uint8), back.astype(np.uint8))
        if settled:
            return bucket, True, len(doc), where, b""
        gram, whole = gram[order], whole[order]
        return bucket, False, len(doc), where, gram.tobytes() + whole.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pending: list[tuple[np.ndarray, ...]] = []
        size, turn = 0, TaskContext.get().partitionId()

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal turn
            if not pending:
                return
            doc, lo, hi, back, gram, whole = (np.concatenate(x) for x in zip(*pending))
            pending.clear()
            order = np.lexsort((lo, doc, whole, gram))
            doc, lo, hi, back, gram, whole = (x[order] for x in (doc, lo, hi, back, gram, whole))
            fresh = np.ones(len(doc), bool)
            fresh[1:] = (gram[1:] != gram[:-1]) | (whole[1:] != whole[:-1])
            first = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
            later = (doc != doc[first]) | (lo != lo[first])
            bucket = (gram & np.uint64(buckets - 1)).astype(np.int64)
            rows = []
            for settled, chosen in ((False, np.flatnonzero(fresh)), (True, np.flatnonzero(later))):
                if settled:  # nothing is compared with these: they are dealt out evenly
                    bucket[chosen] = (turn + np.arange(len(chosen)) // 4096) % buckets
                    turn += len(chosen) // 4096 + 1
                chosen = chosen[np.argsort(bucket[chosen], kind="stable")]
                kinds, at = np.unique(bucket[chosen], return_index=True)
                for b, part in zip(kinds.tolist(), np.split(chosen, at[1:])):
                    rows.append(blob(b, settled, doc[part], lo[part], hi[part], back[part], gram[part], whole[part]))
            for at in range(0, len(rows), 64):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at : at + 64]), (pa.int32(), pa.bool_(), pa.int64(), pa.binary(), pa.binary()))], names=["bucket", "settled", "n", "place", "hashes"])

        for batch in tk.slices(batches):
            data, offsets = tk.flat(batch.column("text"))
            text, lo, hi, anchor, gram, whole = runs(data, offsets)
            ids = batch.column("doc_id").to_numpy()
            base = offsets[text]
            pending.append((ids[text], lo - base, hi - base, anchor - lo, gram, whole))
            size += len(data)
            if size > FLUSH_BYTES:
                yield from flush()
                size = 0
        yield from flush()

    return docs.mapInArrow(run, "bucket int, settled boolean, n long, place binary, hashes binary")


def _unpacked(frame: pd.DataFrame) -> tuple[np.ndarray, ...]:
    parts = []
    for n, place in zip(frame["n"], frame["place"]):
        raw = zstandard.ZstdDecompressor().decompress(place)
        parts.append((np.cumsum(np.frombuffer(raw, np.int64, n)), np.frombuffer(raw, "<u4", n, 8 * n).astype(np.int64), np.frombuffer(raw, np.uint8, n, 12 * n).astype(np.int64), np.frombuffer(raw, np.uint8, n, 13 * n).astype(np.int64)))
    if not parts:
        return (np.zeros(0, np.int64),) * 4
    doc, lo, more, back = (np.concatenate(x) for x in zip(*parts))
    return doc, lo, lo + more, back


def joined_ranges(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """The same starts in fewer ranges: those that meet or overlap become one."""
    order = np.lexsort((hi, lo, doc))
    doc, lo, hi = doc[order], lo[order], hi[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (lo[1:] > hi[:-1] + 1)
    first = np.flatnonzero(fresh)
    return doc[first], lo[first], np.maximum.reduceat(hi, first) if len(first) else hi


def compare_runs(frame: pd.DataFrame, wide: int = WIDE) -> pd.DataFrame:
    """Of a bucket: kind 0, repeated runs; kind 1, first runs of anchors that have several; kind 2, of more than `wide`."""
    done = _unpacked(frame[frame["settled"]])
    mine = frame[~frame["settled"]]
    doc, lo, hi, back = _unpacked(mine)
    gram, whole = [], []
    for n, raw in zip(mine["n"], mine["hashes"]):
        gram.append(np.frombuffer(raw, np.uint64, n))
        whole.append(np.frombuffer(raw, np.uint64, n, 8 * n))
    repeated, out = [done[:3]], []
    if len(doc):
        gram, whole = np.concatenate(gram), np.concatenate(whole)
        _, group, count = np.unique(gram, return_inverse=True, return_counts=True)
        many = np.flatnonzero(count[group] > 1)
        group, whole, gram, doc, lo, hi, back = (x[many] for x in (group, whole, gram, doc, lo, hi, back))
        order = np.lexsort((lo, doc, whole, group))
        group, whole, gram, doc, lo, hi, back = (x[order] for x in (group, whole, gram, doc, lo, hi, back))
        fresh = np.ones(len(doc), bool)
        fresh[1:] = (group[1:] != group[:-1]) | (whole[1:] != whole[:-1])
        first = np.flatnonzero(fresh)[np.cumsum(fresh) - 1] if len(doc) else np.zeros(0, np.int64)
        later = (doc != doc[first]) | (lo != lo[first])
        classes = np.bincount(group[fresh]) if len(doc) else np.zeros(0, np.int64)
        several = fresh & (classes[group] > 1) if len(doc) else fresh
        key = gram.view(np.int64)
        repeated.append((doc[later], lo[later], hi[later]))
        kind = np.where(classes[group[several]] > wide, 2, 1).astype(np.int32) if len(doc) else np.zeros(0, np.int32)
        out.append((kind, key[several], doc[several], lo[several], hi[several], back[several]))
    doc, lo, hi = joined_ranges(*(np.concatenate(x) for x in zip(*repeated)))
    zeros = np.zeros(len(doc), np.int64)
    out.append((zeros.astype(np.int32), zeros, doc, lo, hi, zeros))
    columns = [np.concatenate(x) for x in zip(*out)]
    return pd.DataFrame(dict(zip(("kind", "key", "doc_id", "lo", "hi", "back"), columns)))


def run_texts(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """The asked runs with their bytes."""
    by_doc = asked.groupBy("doc_id").agg(F.collect_list(F.struct("key", "lo", "hi", "back")).alias("asked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.slices(batches):
            data, offsets = tk.flat(batch.column("text"))
            lists = batch.column("asked")
            flat = lists.flatten()
            doc = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            lo, hi = flat.field("lo").to_numpy(), flat.field("hi").to_numpy()
            start = offsets[doc] + lo
            body = data.tobytes()
            for at in range(0, len(doc), 1 << 15):
                part = slice(at, at + (1 << 15))
                raw = [body[a : a + n + LENGTH] for a, n in zip(start[part].tolist(), (hi - lo)[part].tolist())]
                yield pa.RecordBatch.from_arrays([flat.field("key")[part], batch.column("doc_id").take(pa.array(doc[part])), flat.field("lo")[part], pa.array(raw, pa.binary())], names=["key", "doc_id", "lo", "raw"])

    return docs.join(by_doc, "doc_id").mapInArrow(run, "key long, doc_id long, lo long, raw binary")


def _windows(batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, ...]:
    """document, start and hash of every window in the runs."""
    data, offsets = tk.flat(batch.column("raw"))
    n = np.diff(offsets) - LENGTH + 1
    run = np.repeat(np.arange(len(n)), n)
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = offsets[run] + step
    return batch.column("doc_id").to_numpy()[run], batch.column("lo").to_numpy()[run] + step, tk.span_hash(tk.prefix_hash(data), at, at + LENGTH)


def _ranges(doc: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """Consecutive starts as ranges."""
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1)
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(doc)) - 1 if len(doc) else first
    return pa.RecordBatch.from_arrays([pa.array(doc[first]), pa.array(start[first]), pa.array(start[last])], names=["doc_id", "lo", "hi"])


def by_groups(table: pa.Table, most: int) -> Iterator[pa.Table]:
    """Parts of about `most` rows that never end within a key."""
    key = table.column("key").to_numpy()
    ends = np.append(np.flatnonzero(key[1:] != key[:-1]) + 1, len(key))
    at = 0
    while at < len(key):
        i = max(int(np.searchsorted(ends, at + most, "right")) - 1, int(np.searchsorted(ends, at, "right")))
        yield table.slice(at, int(ends[i]) - at)
        at = int(ends[i])


def compare_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key; windows that an earlier one with the same key equals, as ranges of starts."""
    for rows in (part for table in tk.whole_groups(batches, ["key"]) for part in by_groups(table, WIDE)):
        doc, start, value = _windows(rows)
        order = np.lexsort((start, doc, value))
        doc, start, value = doc[order], start[order], value[order]
        fresh = np.ones(len(doc), bool)
        fresh[1:] = value[1:] != value[:-1]
        first = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
        later = (doc != doc[first]) | (start != start[first])
        yield _ranges(doc[later], start[later])


def wide_windows(texts: DataFrame) -> DataFrame:
    """The same by window hash over all tasks, for anchors that have very many different runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                doc, start, value = _windows(batch.slice(at, 4096))
                yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(start), pa.array(value.view(np.int64))], names=["doc_id", "start", "value"])

    rows = written(texts).mapInArrow(run, "doc_id long, start long, value long")
    # Minima are taken before the shuffle, and written, so that Spark can split a hot key of the join.
    place = F.struct("doc_id", "start")
    firsts = written(rows.groupBy("value").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("last > first").select("value", "first"))
    later = rows.join(firsts, "value").where(F.struct("doc_id", "start") > F.col("first"))
    return later.select("doc_id", F.col("start").alias("lo"), F.col("start").alias("hi"))


REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"


def remove(batch: pa.RecordBatch) -> pa.RecordBatch:
    data, offsets = tk.flat(batch.column("text"))
    lists = batch.column("found").fill_null([])
    flat = lists.flatten()
    doc = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
    size = np.diff(offsets)[doc]
    start = np.minimum(flat.field("lo").to_numpy(), size)
    end = np.minimum(flat.field("hi").to_numpy() + LENGTH, size)
    cover = np.zeros(len(data) + 1, np.int32)
    np.add.at(cover, offsets[doc] + start, 1)
    np.add.at(cover, offsets[doc] + end, -1)
    gone = np.cumsum(cover[:-1]) > 0
    out: list[list] = [[], [], [], []]
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        own = gone[a:b]
        edges = np.diff(own.astype(np.int8), prepend=0, append=0)
        spans = [{"start": x, "end": y} for x, y in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist())]
        for column, x in zip(out, (int(own.sum()), len(spans), hashlib.sha256(data[a:b][~own].tobytes()).hexdigest(), spans)):
            column.append(x)
    types = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(offsets)), *(pa.array(c, t) for c, t in zip(out, types))], names=[x.split()[0] for x in REMOVED.split(", ")[:5]] + ["spans"])


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, lo, hi: windows of LENGTH bytes that start at lo to hi also start earlier in the corpus."""
    named = id_text(docs).where("doc_id is not null")
    partitions = parallelism(docs.sparkSession)
    buckets = min(MOST_BUCKETS, 1 << max(8, (named.rdd.getNumPartitions() // 2).bit_length()))
    blobs = run_blobs(named, buckets).repartition(min(buckets, max(partitions, 64)), "bucket")
    wide = WIDE
    found = written(blobs.groupBy("bucket").applyInPandas(lambda frame: compare_runs(frame, wide), RUNS))
    narrow = run_texts(named, found.where("kind = 1")).repartition(partitions, "key").sortWithinPartitions("key")
    wide = run_texts(named, found.where("kind = 2"))
    out = found.where("kind = 0").select("doc_id", "lo", "hi").unionByName(written(narrow.mapInArrow(compare_windows, "doc_id long, lo long, hi long")))
    if found.where("kind = 2").limit(1).count():
        out = out.unionByName(written(wide_windows(wide)))
    return out


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """A row for every document: what is removed, and the digest of what stays (see REMOVED)."""
    by_doc = repeated_spans(docs).groupBy(F.col("doc_id").alias("id")).agg(F.collect_list(F.struct("lo", "hi")).alias("found"))
    base = id_text(docs)
    joined = base.join(by_doc, base["doc_id"] == by_doc["id"], "left").select("doc_id", "text", "found")
    return joined.mapInArrow(tk.arrow_map(remove), REMOVED)


ORACLE_SQL = f"""
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, i, md5_number(substr(x, 2 * i + 1, {2 * LENGTH})) AS h FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - {LENGTH} + 1)) AS i FROM t)),
f AS (SELECT h, min(struct_pack(d := doc_id, i := i)) AS first FROM w GROUP BY h HAVING count(*) > 1),
later AS (SELECT doc_id, i FROM w JOIN f USING (h) WHERE doc_id <> first.d OR i <> first.i),
marked AS (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {LENGTH} THEN 0 ELSE 1 END AS fresh FROM later),
numbered AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
gone AS (SELECT doc_id, run, min(i) AS a, max(i) + {LENGTH} AS b FROM numbered GROUP BY doc_id, run),
sums AS (SELECT doc_id, sum(b - a) AS n, count(*) AS spans FROM gone GROUP BY doc_id),
edges AS (SELECT doc_id, a, b FROM gone UNION ALL SELECT doc_id, length(x) // 2, NULL FROM t),
gaps AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a, b NULLS LAST), 0) AS a, a AS b FROM edges),
kept AS (SELECT doc_id, string_agg(substr(x, 2 * gaps.a + 1, 2 * (gaps.b - gaps.a)), '' ORDER BY gaps.a) AS x FROM gaps JOIN t USING (doc_id) GROUP BY doc_id)
SELECT doc_id, length(t.x) // 2 AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(kept.x)) AS kept_sha256
FROM t JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)
"""
