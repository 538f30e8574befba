"""Best-fit packing of tokenised documents into sequences, certified by lower bounds.

Texts become token ids (plus an end id), long ones are cut into pieces of the sequence length.
Pieces are dealt over Spark partitions of bounded size; each packs its share by best-fit decreasing
and certifies its bin count by dual-feasible functions: one that needs as many bins as its lower
bound says is settled. Partitions with a gap between the two give up their emptiest bins, exchange
those pieces through a shuffle into fewer partitions, and best-fit decreasing runs again on them,
until no partition has a gap, the number of bins is the bound of the whole corpus, a single
partition is left, or PATIENCE rounds in a row have saved no bin. report() tells the gap that is left.

Nulls and empty texts give one piece that holds the end id alone. Repeated rows and ties are
packed like any others; rows with a null doc_id too. An empty table gives no rows. Extra columns
are ignored. Every row that enters leaves; nothing but a histogram of lengths (at most one row for
each length up to the capacity) reaches the driver.
"""

from __future__ import annotations

import bisect
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textkit as tk
from .common import id_text, written

CAPACITY, END_ID = 4096, 1
#: Pieces that one task packs at most, and the share of them, in bins, that a partition gives up in a round.
PER_PARTITION, OPEN_SHARE = 50_000, 200
#: Rounds at most, and those in a row that may save nothing; what the last one packs stays as it is.
ROUNDS, PATIENCE = 32, 3
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long, slack long, certified boolean"

# --- tokens -----------------------------------------------------------------------------------

#: Distinct units kept per Python worker.
CACHE_UNITS = 400_000
_HARD = np.zeros(256, bool)
_HARD[:9] = _HARD[14:32] = True
_HARD[[39, 60, 127]] = True  # contractions start with ', special tokens with <
_KIND = np.full(256, 3, np.uint8)
_KIND[np.r_[65:91, 97:123, 128:256]] = 1
_KIND[48:58] = 2
_ENCODERS: dict[str, Encoder] = {}


class Encoder:
    """Ids of texts, by units that the tokenizer treats apart from their surroundings.

    A unit is a run of letters, a digit or a run of other signs within a word of ASCII and Latin-1
    letters; any other word (between white space) is one unit. Each unit is encoded once and kept.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.latin = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)}
        self.known: dict[int, bytes] = {}

    @staticmethod
    def of(path: str) -> Encoder:
        if path not in _ENCODERS:
            _ENCODERS[path] = Encoder(path)
        return _ENCODERS[path]

    def unit(self, raw: bytes, hard: bool) -> bytes:
        text = raw.decode()
        if hard:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            text = text.lower()
            ids = [t.id for t in self.tokenizer.model.tokenize(text if text.isascii() else text.translate(self.latin))]
        return np.array(ids, "<u4").tobytes()

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of ids of each text."""
        n_texts = len(offsets) - 1
        start, end, doc = tk.word_spans(data, offsets, tk.ASCII_SPACE)
        if not len(start):
            return np.zeros(0, "<u4"), np.zeros(n_texts, np.int64)
        cont = (data >= 0x80) & (data <= 0xBF) & (data != 0x97) & (data != 0xB7)
        pair = (data[:-1] == 0xC3) & cont[1:]
        latin = np.zeros(len(data), bool)
        latin[:-1] |= pair
        latin[1:] |= pair
        bad = np.zeros(len(data) + 1, np.int64)
        np.cumsum(_HARD[data] | (data >= 0x80) & ~latin, out=bad[1:])
        hard_word = bad[end] > bad[start]
        change = np.zeros(len(data) + 1, np.int8)
        change[start[hard_word]] += 1
        change[end[hard_word]] -= 1
        in_hard = np.cumsum(change[:-1], dtype=np.int8) > 0
        kind = np.where(tk.ASCII_SPACE[data], 0, _KIND[data])
        first = np.zeros(len(data), bool)
        first[1:] = ((kind[1:] != kind[:-1]) | (kind[1:] == 2)) & (kind[1:] > 0) & ~in_hard[1:]
        first[start] = True
        u_start = np.flatnonzero(first)
        word = np.searchsorted(start, u_start, "right") - 1
        u_end = np.minimum(np.append(u_start[1:], len(data)), end[word])
        # Case only matters outside ASCII: units that differ in it alone share an entry.
        low = np.where(in_hard, data, tk.LOWER[data])
        value = tk.span_hash(tk.prefix_hash(low), u_start, u_end)
        unique, at, inverse = np.unique(value, return_index=True, return_inverse=True)
        known, body, found = self.known, low.tobytes(), []
        hard_u = hard_word[word[at]]
        for h, a, b, hard in zip(unique.tolist(), u_start[at].tolist(), u_end[at].tolist(), hard_u.tolist()):
            ids = known.get(h)
            if ids is None:
                ids = self.unit(body[a:b], hard)
                if len(known) < CACHE_UNITS and b - a < 64:
                    known[h] = ids
            found.append(ids)
        sizes = np.fromiter((len(x) >> 2 for x in found), np.int64, len(found))
        flat = np.frombuffer(b"".join(found), "<u4")
        base = np.cumsum(sizes) - sizes
        size = sizes[inverse]
        ids = flat[np.repeat(base[inverse] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        return ids, np.bincount(doc[word], weights=size, minlength=n_texts).astype(np.int64)


def pieces(docs: DataFrame, tokenizer: str, with_ids: bool = False) -> DataFrame:
    """Pieces of at most CAPACITY ids of every document; with_ids adds the ids themselves."""

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        ids, counts = Encoder.of(tokenizer).encode(*tk.flat(rows.column("text")))
        out: list[list] = [[] for _ in range(6)]
        at = 0
        for doc, n in zip(rows.column("doc_id").to_pylist(), counts.tolist()):
            own = np.append(ids[at : at + n], np.array([END_ID], "<u4"))
            at += n
            for piece, start in enumerate(range(0, n + 1, CAPACITY)):
                part = own[start : start + CAPACITY]
                for column, x in zip(out, (doc, piece, start, len(part), zlib.crc32(part.tobytes()), part if with_ids else None)):
                    column.append(x)
        columns = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), *(pa.array(c, pa.int64()) for c in out[2:5])]
        names = [x.split()[0] for x in PIECES.split(", ")]
        if with_ids:
            columns.append(pa.array(out[5], pa.list_(pa.int64())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names=names)

    return id_text(docs).mapInArrow(tk.arrow_map(batch), PIECES + (", ids array<long>" if with_ids else ""))


# --- bounds -----------------------------------------------------------------------------------


def lower_bound(count: np.ndarray, capacity: int = CAPACITY) -> int:
    """Bins that pieces need at least: the best of three families of dual-feasible functions.

    count[x]: pieces of length x, x from 0 to the capacity. A dual-feasible function maps sizes so
    that what fits in one bin keeps a sum of at most 1; the sum over all pieces bounds the bins.
    """
    x = np.arange(capacity + 1, dtype=np.int64)
    count = count.astype(np.int64)
    best = -(-int((x * count).sum()) // capacity)  # the identity
    # Pieces above capacity - e count as whole bins, those below e not at all.
    items, volume = np.cumsum(count), np.cumsum(x * count)
    for e in range(1, capacity // 2 + 1):
        large = int(items[capacity] - items[capacity - e])
        between = int(volume[capacity - e] - volume[e - 1])
        best = max(best, large - (-between // capacity))
    # Rounding to k-ths.
    for k in range(1, 33):
        scaled = (k + 1) * x
        whole = scaled % capacity == 0
        value = np.where(whole, x * k, scaled // capacity * capacity)  # in units of 1 / (k * capacity)
        best = max(best, -(-int((value * count).sum()) // (k * capacity)))
    return best


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of every piece, and the room left in every bin."""
    n = len(lengths)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    room: list[int] = []
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms: list[int] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        at = bisect.bisect_left(open_rooms, need)
        if at < len(open_rooms):
            left = open_rooms[at]
            b = with_room[left].pop()
            if not with_room[left]:
                open_rooms.pop(at)
        else:
            b, left = len(room), capacity
            room.append(capacity)
        bins[i], offsets[i] = b, capacity - left
        left -= need
        room[b] = left
        if left:
            if not with_room[left]:
                bisect.insort(open_rooms, left)
            with_room[left].append(b)
    return bins, offsets, np.array(room, np.int64)


# --- rounds -----------------------------------------------------------------------------------


def pack_partition(round_no: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        all_frames = [f for f in frames if len(f)]
        if not all_frames:
            return
        rows = pd.concat(all_frames, ignore_index=True)
        lengths = rows["length"].to_numpy(np.int64)
        bins, offsets, room = best_fit(lengths)
        certified = len(room) == lower_bound(np.bincount(lengths, minlength=CAPACITY + 1))
        base = (round_no << 54) + (TaskContext.get().partitionId() << 30)
        yield rows.assign(sequence_id=base + bins, offset=offsets, slack=room[bins], certified=certified)

    return run


def bound_of(parts: DataFrame) -> int:
    """Bins that all pieces together need at least; at most one row for each length reaches the driver."""
    histogram = np.zeros(CAPACITY + 1, np.int64)
    for row in parts.groupBy("length").count().collect():
        histogram[row["length"]] = row["count"]
    return lower_bound(histogram)


def pack(parts: DataFrame) -> DataFrame:
    """parts with length of at most CAPACITY: sequence_id and offset for each, slack (room left in its sequence) and certified (whether its partition met its bound)."""
    names = [x.split()[0] for x in PACKED.split(", ")]
    todo = parts.select(names[:5])
    done: list[DataFrame] = []
    bound, n = bound_of(todo), todo.count()
    closed, least, idle = 0, math.inf, 0
    for round_no in range(ROUNDS):
        parts_now = max(1, math.ceil(n / PER_PARTITION))
        packed = written(todo.repartition(parts_now).mapInPandas(pack_partition(round_no), PACKED))
        bins = packed.groupBy("sequence_id").agg(F.first("slack").alias("slack"), F.count("*").alias("n"), F.first("certified").alias("certified"))
        found = bins.agg(F.count("*").alias("bins"), F.count_if(~F.col("certified")).alias("open")).first()
        total = closed + found["bins"]
        idle = 0 if total < least else idle + 1
        least = min(least, total)
        if parts_now == 1 or not found["open"] or total <= bound or idle >= PATIENCE or round_no == ROUNDS - 1:
            done.append(packed)
            break
        # Of partitions with a gap the emptiest bins, then full ones of many small pieces, are dissolved; their pieces meet others in the next round.
        rank = F.row_number().over(Window.partitionBy(F.shiftright("sequence_id", 30)).orderBy(F.desc("slack"), F.desc("n"), "sequence_id"))
        given = written(bins.where(~F.col("certified")).withColumn("rank", rank).where(F.col("rank") <= max(1, PER_PARTITION // OPEN_SHARE)).select("sequence_id", "n"))
        sums = given.agg(F.count("*").alias("bins"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
        done.append(packed.join(given, "sequence_id", "left_anti").select(names))
        todo = packed.join(given, "sequence_id", "left_semi").select(names[:5])
        closed, n = total - sums["bins"], sums["n"]
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def report(packed: DataFrame) -> dict[str, int]:
    """Bins used, the lower bound of the whole corpus, and the gap between the two."""
    bins, bound = packed.select("sequence_id").distinct().count(), bound_of(packed)
    return {"bins": bins, "bound": bound, "gap": bins - bound}


def pack_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    return pack(written(pieces(docs, tokenizer)))


def sequences(parts_with_ids: DataFrame, packed: DataFrame) -> DataFrame:
    """The ids of every sequence, from pieces(..., with_ids=True) and their packing; at most CAPACITY ids a row."""
    joined = packed.join(parts_with_ids.select("doc_id", "piece", "ids"), ["doc_id", "piece"])
    return joined.groupBy("sequence_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
