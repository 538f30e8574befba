"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

A bounded sample of labelled texts (at most PER_CLASS of each label; rows whose crc32 of doc_id is
divisible by 5 never take part) is turned into term vectors; their weighted matrix is factorised,
and its right singular vectors map any text to a latent-semantic vector. The sample's vectors are
broadcast: their number and size have fixed bounds. Every document's vector is compared with all of
them by exact cosine products in blocks, and its K nearest vote with a weight that rises with the
similarity and corrects for the sampling rate of their label.

Terms are hashed words and word pairs, which have most of a vector's length, word shapes and their
pairs, and shares of repetition, capitals, digits and signs. doc_id, source, lang and
labels are no inputs of a score. A sampled text is no neighbour of itself or of an exact copy: vectors of the
document's own text are left out of its vote (without any other, its score is the share of label 1).
Nulls and empty texts have a term of their own and get a score
like any other. Without labels of both kinds every score is the share of label 1 (1.0 without any).
Where rows of different texts share a labelled doc_id, the least text is the sample's.
Repeated rows each get their row; a null doc_id counts as held out; very long texts are read whole;
extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .common import id_text

#: Bounds of the labelled sample, and of the vectors.
PER_CLASS, RANK = 3000, 64
K, SHARPNESS = 31, 12.0
THRESHOLD = 0.3
BLOCK = 2048

WORD_BINS, WORD_PAIR_BINS, SHAPE_BINS, SHAPE_PAIR_BINS = 2048, 2048, 1024, 1024
#: Shares of repetition, capitals, signs and digits and the mean length of a word, each in LEVELS overlapping levels.
N_SHARES, LEVELS = 7, 8
PARTS = np.cumsum([0, WORD_BINS, WORD_PAIR_BINS, SHAPE_BINS, SHAPE_PAIR_BINS, N_SHARES * LEVELS])
DIMS = int(PARTS[-1])
#: Share of a vector's squared length that each kind of term gets.
PART_WEIGHTS = np.array([0.4, 0.2, 0.2, 0.1, 0.1])

#: Sign classes that shapes are made of: lower-case and other letters, capitals, digits, and single marks.
_CLASS = np.full(256, ord("?"), np.uint8)
_CLASS[97:123] = _CLASS[128:256] = ord("a")
_CLASS[65:91] = ord("A")
_CLASS[48:58] = ord("0")
_CLASS[list(b".,;:!?'\"-|#*$%&<>(){}=/@_+")] = list(b"..;;!!'\"-|#*$%&<>(((==/@_+")


def _bins(value: np.ndarray, n: int) -> np.ndarray:
    return (value % np.uint64(n)).astype(np.int64)


def term_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Dense rows of term frequencies (shares of each kind), one for each text."""
    n = len(offsets) - 1
    out = np.zeros((n, DIMS), np.float32)
    start, end, doc = tk.word_spans(data, offsets, tk.ASCII_SPACE)
    marks = out[:, PARTS[4] :]
    if len(start):
        lower = tk.LOWER[data]
        words = tk.span_hash(tk.prefix_hash(lower), start, end)
        kinds = _CLASS[data]
        keep = np.ones(len(data), bool)
        keep[1:] = kinds[1:] != kinds[:-1]
        keep[start] = True
        at = np.cumsum(keep) - 1
        short = kinds[keep]
        shapes = tk.span_hash(tk.prefix_hash(short), at[start], at[end - 1] + 1)
        same_text = doc[1:] == doc[:-1]
        pair = lambda x: tk.mix((x[1:] * np.uint64(3) + x[:-1])[same_text])
        second = doc[1:][same_text]
        for part, (value, d) in enumerate(((words, doc), (pair(words), second), (shapes, doc), (pair(shapes), second))):
            size = int(PARTS[part + 1] - PARTS[part])
            flat = np.bincount(d * size + _bins(value, size), minlength=n * size)
            out[:, PARTS[part] : PARTS[part + 1]] = flat.reshape(n, size)
        count = np.bincount(doc, minlength=n)
        total = np.maximum(count, 1)
        again = np.zeros(len(words), bool)
        again[1:] = (words[1:] == words[:-1]) & same_text
        repeat = np.zeros(len(words))
        windows, first = tk.windows(words, doc, 4)
        if len(first):
            _, inverse, times = np.unique(tk.mix(windows ^ tk.mix(doc[first].astype(np.uint64))), return_inverse=True, return_counts=True)
            repeat[first] = times[inverse] > 1
        _, one = np.unique(tk.mix(words ^ tk.mix(doc.astype(np.uint64))), return_index=True)
        distinct = np.bincount(doc[one], minlength=n) / total
        chars = np.maximum(np.diff(offsets), 1)
        sums = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])
        shares = [
            tk.per_text(again, doc, n) / total,
            tk.per_text(repeat > 0, doc, n) / total,
            np.clip(1 - distinct - 0.1 * np.log1p(count), 0, 1),
            sums((data >= 65) & (data < 91)) / chars,
            sums((data < 48) & (data != 32) & (data != 10) & (data != 44) & (data != 46)) / chars,
            sums((data >= 48) & (data < 58)) / chars,
            np.minimum(chars / total / 20, 1),
        ]
        for i, share in enumerate(shares):
            level = np.clip(share, 0, 1)[:, None] * (LEVELS - 1)
            marks[:, LEVELS * i : LEVELS * (i + 1)] = np.maximum(0, 1 - np.abs(level - np.arange(LEVELS)))
    else:
        count = np.zeros(n, np.int64)
    marks[count == 0, :] = 0
    marks[count == 0, 0] = 4
    return out


def text_hashes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each whole text."""
    return tk.span_hash(tk.prefix_hash(data), offsets[:-1], offsets[1:])


def shaped(counts: np.ndarray, weight: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """Square roots of shares, weighted and with each kind of term scaled to its part."""
    x = np.sqrt(counts, out=out)
    x *= weight
    for p, share in enumerate(PART_WEIGHTS):
        part = x[:, PARTS[p] : PARTS[p + 1]]
        part *= np.sqrt(share, dtype=np.float32) / np.maximum(np.sqrt(np.einsum("ij,ij->i", part, part)), 1e-12)[:, None]
    return x


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


@dataclass
class Model:
    """weight: of terms; axes: terms to latent dimensions; vectors, labels, votes, texts (hashes): of the sample; prior: share of label 1."""

    prior: float
    weight: np.ndarray | None = None
    axes: np.ndarray | None = None
    vectors: np.ndarray | None = None
    labels: np.ndarray | None = None
    votes: np.ndarray | None = None
    texts: np.ndarray | None = None

    def embed(self, counts: np.ndarray) -> np.ndarray:
        return unit(shaped(counts, self.weight) @ self.axes)

    def score(self, counts: np.ndarray, texts: np.ndarray) -> np.ndarray:
        """texts: hashes of the documents' texts, by which a document's own vector is left out."""
        if self.vectors is None:
            return np.full(len(counts), self.prior)
        cosine = self.embed(counts) @ self.vectors.T
        known = np.flatnonzero(np.isin(texts, self.texts))
        cosine[known] = np.where(texts[known][:, None] == self.texts, -np.inf, cosine[known])
        k = min(K, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        similar = np.take_along_axis(cosine, near, axis=1).astype(np.float64)
        top = similar.max(axis=1, keepdims=True)
        vote = np.exp(SHARPNESS * (similar - np.where(np.isfinite(top), top, 0))) * self.votes[near]
        total = vote.sum(axis=1)
        share = np.divide((vote * self.labels[near]).sum(axis=1), total, out=np.full(len(total), self.prior), where=total > 0)
        return np.clip(share, 0.0, 1.0)


def fit(counts: np.ndarray, labels: np.ndarray, texts: np.ndarray, totals: dict[int, int]) -> Model:
    """counts (overwritten), labels and hashes of texts of the sample; totals: labelled rows of each label that it stands for."""
    everything = sum(totals.values())
    prior = totals.get(1, 0) / everything if everything else 1.0
    if len(set(labels.tolist())) < 2:
        return Model(prior)
    df = np.count_nonzero(counts, axis=0)
    weight = (np.log((1 + len(counts)) / (1 + df)) + 0.5).astype(np.float32)
    weight[PARTS[4] :] = 1.0
    x = shaped(counts, weight, out=counts)
    rank = min(RANK, *x.shape)
    rng = np.random.default_rng(7)
    basis = rng.standard_normal((x.shape[1], rank + 16)).astype(np.float32)
    for _ in range(4):  # subspace iteration
        basis, _ = np.linalg.qr(x.T @ (x @ basis))
    _, _, right = np.linalg.svd(x @ basis, full_matrices=False)
    model = Model(prior, weight, np.ascontiguousarray(basis @ right[:rank].T, np.float32))
    model.vectors = unit(x @ model.axes).astype(np.float32)
    model.labels, model.texts = labels.astype(np.float64), texts
    sampled = {y: int((labels == y).sum()) for y in (0, 1)}
    model.votes = np.array([totals[int(y)] / sampled[int(y)] for y in labels]) / everything * len(labels)
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits on at most PER_CLASS labelled rows of each label that are not held out."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    totals = {r["quality"]: r["count"] for r in usable.groupBy("quality").count().collect()}
    picked = None
    spread = F.xxhash64("doc_id")
    for y in (0, 1):
        one = usable.where(F.col("quality") == y)
        if totals.get(y, 0) > 8 * PER_CLASS:  # so that not every task sends PER_CLASS rows to the one that picks
            one = one.where(spread < -(2**63) + 2**64 * 2 * PER_CLASS // totals[y])
        one = one.orderBy(spread, "doc_id").limit(PER_CLASS)
        picked = one if picked is None else picked.unionByName(one)
    # At most 2 * PER_CLASS rows of two numbers.
    texts = id_text(docs).join(F.broadcast(picked.distinct()), "doc_id").select("doc_id", "quality", "text")
    # An id of very many rows is one row for each task before it is shuffled.
    texts = texts.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))

    def sparse(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = tk.flat(batch.column("text"))
        counts = term_counts(data, offsets)
        rows = [np.flatnonzero(r) for r in counts]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("quality"), pa.array(text_hashes(data, offsets).view(np.int64)), pa.array(rows, pa.list_(pa.int32())), pa.array([c[r] for c, r in zip(counts, rows)], pa.list_(pa.float32()))],
            names=["doc_id", "quality", "hash", "terms", "n"],
        )

    found = texts.mapInArrow(tk.arrow_map(sparse), "doc_id long, quality int, hash long, terms array<int>, n array<float>").toArrow()
    order = np.lexsort((found.column("quality").to_numpy(), found.column("doc_id").to_numpy()))
    counts = np.zeros((len(order), DIMS), np.float32)
    rank = np.argsort(order, kind="stable")
    at = 0
    for part in found.to_batches():
        terms = part.column("terms")
        row = np.repeat(rank[at : at + part.num_rows], terms.value_lengths().to_numpy())
        counts[row, terms.flatten().to_numpy()] = part.column("n").flatten().to_numpy()
        at += part.num_rows
    return fit(counts, found.column("quality").to_numpy()[order], found.column("hash").to_numpy()[order].view(np.uint64), totals)


def scores(model: Model, text: pa.Array) -> np.ndarray:
    """Scores of a batch's texts, in blocks of BLOCK."""
    out = [np.zeros(0)]
    for at in range(0, len(text), BLOCK):
        data, offsets = tk.flat(text.slice(at, BLOCK))
        out.append(model.score(term_counts(data, offsets), text_hashes(data, offsets)))
    return np.concatenate(out)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        score = scores(shared.value, rows.column("text"))
        return pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("held_out"), pa.array(score, pa.float64()), pa.array((score >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = id_text(docs).withColumn("held_out", held_out(F.col("doc_id")))
    return rows.mapInArrow(tk.arrow_map(batch), "doc_id long, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, with all their columns, whose text is predicted to be good."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        return rows.filter(pa.array(scores(shared.value, rows.column("text")) >= THRESHOLD))

    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(tk.arrow_map(batch), docs.schema)
