"""Quality rules: word and repetition rules, then compression bands.

The bands: zstandard's ratio (bytes before / after) over the whole text and over fixed chunks.
Repetitive text has a high ratio, random or binary text a low one; limits depend on length, of
whole texts and of chunks alike, as short texts cannot compress well and frame overhead weighs
more. A text of more than one chunk is tried chunk by chunk up to its last byte: what is left at the
end makes a shorter chunk, with the limits of its length.

Nulls and empty texts: no words, all counts 0, base_failed. Repeated rows each get their row.
Very long texts are handled whole, chunk by chunk. Extra columns are ignored.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from . import textkit as tk
from .common import id_text

CHUNK = 4096
LEVEL = 1
#: (least length in bytes, lowest ratio, highest ratio); the last row whose length is reached counts. Set so that plain prose of
#: other origin (technical English) passes too, with a margin.
WHOLE_BANDS = [(0, 0.0, 99.0), (128, 0.85, 2.4), (256, 1.1, 2.8), (512, 1.2, 2.9), (1024, 1.3, 3.0), (2048, 1.4, 3.1), (4096, 1.5, 3.2), (8192, 1.5, 3.2), (16384, 1.5, 3.3), (65536, 1.5, 3.5)]
#: The same for single chunks, which may be more repetitive: a chunk is more uneven than a text. The share of a text's bytes in chunks outside them that rejects it.
CHUNK_BANDS = [(0, 0.0, 99.0), (128, 0.8, 2.6), (256, 1.0, 3.0), (512, 1.2, 3.1), (1024, 1.35, 3.2), (2048, 1.4, 3.3), (4096, 1.45, 3.4)]
CHUNK_SHARE = 0.5
#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5

SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, zstd_ratio double, n_chunks long, n_chunks_out long, band_failed boolean, kept boolean"


def band(n: int, bands: list[tuple[int, float, float]] = WHOLE_BANDS) -> tuple[float, float]:
    return bands[bisect.bisect_right(bands, (n, 1e9, 1e9)) - 1][1:]


def chunk_verdict(zstd, raw: bytes) -> tuple[float, int, int, bool]:
    """Ratio of the whole text, chunks, chunks outside their band, rejected."""
    if not raw:
        return 0.0, 0, 0, False
    ratio = len(raw) / len(zstd.compress(raw))
    low, high = band(len(raw))
    n = out = outside = 0
    if len(raw) > CHUNK:
        for at in range(0, len(raw), CHUNK):
            part = raw[at : at + CHUNK]
            least, most = band(len(part), CHUNK_BANDS)
            wrong = not least <= len(part) / len(zstd.compress(part)) <= most
            n += 1
            out += wrong
            outside += wrong * len(part)
    return ratio, n, out, not low <= ratio <= high or outside > CHUNK_SHARE * len(raw)


def repeated_words(word_hash: np.ndarray, doc: np.ndarray, n_texts: int) -> np.ndarray:
    """For each text the words in WINDOW-word windows that the text holds twice or more."""
    value, at = tk.windows(word_hash, doc, WINDOW)
    if not len(at):
        return np.zeros(n_texts, np.int64)
    key = tk.mix(value ^ tk.mix(doc[at].astype(np.uint64)))
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    hit = at[count[inverse] > 1]
    cover = np.zeros(len(word_hash) + 1, np.int32)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + WINDOW, -1)
    return tk.per_text(np.cumsum(cover[:-1]) > 0, doc, n_texts)


def duplicate_lines(raw: bytes) -> int:
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)]
    return len(lines) - len(set(lines))


def rule_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    column = batch.column("text")
    data, offsets = tk.flat(column)
    n = batch.num_rows
    start, end, doc = tk.word_spans(data, offsets, tk.ASCII_SPACE)
    hashes = tk.span_hash(tk.prefix_hash(data), start, end)
    words = np.bincount(doc, minlength=n)
    heads = np.zeros(len(data) + 1, np.int64)
    np.cumsum(((data & 0xC0) != 0x80) & ~tk.ASCII_SPACE[data], out=heads[1:])
    chars = heads[offsets[1:]] - heads[offsets[:-1]]
    repeated = repeated_words(hashes, doc, n)
    zstd = zstandard.ZstdCompressor(level=LEVEL)
    symbols, lines, bands = [], [], []
    body = data.tobytes()
    for a, b in zip(offsets[:-1], offsets[1:]):
        raw = body[a:b]
        symbols.append(len(raw) - len(raw.translate(None, SYMBOLS)))
        lines.append(duplicate_lines(raw))
        bands.append(chunk_verdict(zstd, raw))
    base = (words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * words)
    ratio, chunks, out, rejected = (np.array(x) for x in zip(*bands))
    columns = [batch.column("doc_id"), words, chars, symbols, lines, repeated, base, ratio, chunks, out, rejected.astype(bool), ~(base | rejected.astype(bool))]
    return pa.RecordBatch.from_arrays([pa.array(c) if not isinstance(c, pa.Array) else c for c in columns], names=[x.split()[0] for x in SCHEMA.split(", ")])


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per document (see SCHEMA); one pass, nothing is shuffled."""
    return id_text(docs).mapInArrow(tk.arrow_map(rule_batch), SCHEMA)
