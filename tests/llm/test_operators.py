"""Every operator against its plain version, on awkward rows and on the smallest tables."""

import gzip
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvina.llm import decontamination, line_dedup, ngram_join, packing, pii, quality_classifier, quality_rules, registry, secrets, substring_dedup, warc
from corvina.llm.common import written

from . import brute, data as rows

TEXTS = dict(enumerate(rows.TEXTS, 1))


def by_id(df, key, *columns):
    """{key: the columns}; every key once."""
    got = df.collect()
    out = {r[key]: tuple(r[c] for c in columns) for r in got}
    assert len(out) == len(got)
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return written(rows.documents(spark))


@pytest.fixture(scope="module")
def table(spark, data):
    """The documents of the smallest tables, as rows and as a dictionary."""
    df = spark.read.parquet(f"{data}/documents.parquet")
    return df, {r["doc_id"]: r["text"] for r in df.collect()}


@pytest.fixture(scope="module", params=["awkward", "table"])
def corpus(request, docs, table):
    return (docs, TEXTS) if request.param == "awkward" else table


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(registry.tokenizer_path())


# --- spans ------------------------------------------------------------------------------------


@pytest.mark.parametrize("scan, table_of", [(pii.detect_pii, brute.PII), (secrets.scan_secrets, brute.SECRETS)])
def test_base_spans(corpus, scan, table_of):
    df, texts = corpus
    kinds = list(table_of)
    got = by_id(scan(df), "doc_id", *(f"n_{k}" for k in kinds), "base_sha256", "spans")
    assert set(got) == set(texts)
    for d, t in texts.items():
        expected = brute.spans(t, table_of)
        line = brute.joined(expected, kinds)
        assert got[d][:-1] == (*(sum(k == x for x, *_ in expected) for k in kinds), brute.sha(line)), (d, t, got[d], line)
        # The method adds spans; base ones stay, and all are sorted by start.
        reported = got[d][-1].split(",") if got[d][-1] else []
        assert [x for x in reported if x.split(":")[0] in kinds] == (line.split(",") if line else [])
        starts = [int(x.split(":")[1]) for x in reported]
        assert starts == sorted(starts)


def test_checksums_and_context_add_spans(docs):
    got = by_id(pii.detect_pii(docs), "doc_id", "spans")
    text = rows.TEXTS[10]
    found = [text[int(a) : int(b)] for k, a, b in (x.split(":") for x in got[11][0].split(",")) if k in ("iban", "ssn", "localphone")]
    assert found == ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "123-45-6789", "(555) 123-4567"]


def test_context_lowers_a_score():
    plain, order = "number 123-45-6789 social", "order part 123-45-6789 isbn"
    assert [x[0] for x in pii.find(plain)] == ["ssn"] and not pii.find(order)


def test_entropy_spans(docs):
    got = by_id(secrets.scan_secrets(docs), "doc_id", "spans", "n_entropy")
    text = rows.TEXTS[13]
    assert got[14][1] == 1
    kind, a, b = got[14][0].split(",")[0].split(":")
    assert (kind, text[int(a) : int(b)]) == ("entropy", "wJalrXUtnFEMIK7MDENGbPxRfiCYzq83jQ")


def test_secrets_that_look_like_paths_or_edges(spark):
    key = "q9Zt/Xw2Lk7/Rb4Vn/Hs8Yd1Gf/Jm5Cp0TuQxEa"
    plain = "hQzWvKtYbNrXcJmLpDsGfUaE"
    cases = [
        (f"see {key} here", [key]),
        (f"see -{plain}9 here", [plain + "9"]),
        (f"name ={plain}7== here", [plain + "7"]),
        (f"see {plain} here", [plain]),
        (f"x {'0123456789abcdef' * 2}-{plain} y", [plain]),
        ("in /usr/local/lib/python3/site-packages/module_name and getElementsByTagName", []),
        ("a snake_case_identifier_of_many_words and ------------------------", []),
    ]
    got = by_id(secrets.scan_secrets(rows.documents(spark, [t for t, _ in cases], extra=False)), "doc_id", "spans")
    for i, (text, expected) in enumerate(cases, 1):
        spans = [x.split(":") for x in got[i][0].split(",") if x]
        assert [text[int(a) : int(b)] for k, a, b in spans if k == "entropy"] == expected, (text, spans)


def test_entropy_spans_match_a_plain_scan(spark, corpus):
    import random

    df, texts = corpus
    rng = random.Random(5)
    signs = "abcdefXYZ0123456789+/_=-"
    odd = ["".join(rng.choice(signs + " .:=") for _ in range(rng.choice([60, 3000]))) + rng.choice(["", " token=abc", " AKIA" + "7" * 16 + "q" * 30, " secret: " + "x1" * 30]) for _ in range(150)]
    for frame, known in ((df, texts), (rows.documents(spark, odd, extra=False), dict(enumerate(odd, 1)))):
        got = by_id(secrets.scan_secrets(frame), "doc_id", "spans", "n_entropy")
        for d, t in known.items():
            spans = [x.split(":") for x in got[d][0].split(",") if x]
            assert [(int(a), int(b)) for k, a, b in spans if k == "entropy"] == brute.entropies(t), (d, t)


def test_long_and_dense_texts_of_secrets(spark):
    """Time is linear, and no pattern's stack grows with the text."""
    import base64
    import random

    rng = random.Random(1)
    words = [f"{rng.getrandbits(64):016x}" for _ in range(300000)]
    blob = base64.b64encode(rng.randbytes(3_000_000)).decode()
    texts = ["a_" * 1_000_000 + "1234567", " ".join(words), blob, "ab" * 2_000_000, "token=x " * 100_000, "A_1-" * 500_000]
    got = by_id(secrets.scan_secrets(rows.documents(spark, texts, extra=False)), "doc_id", "n_assign", "n_hex", "n_entropy", "spans")
    assert got[2] == (0, len(words), 0, ",".join(f"hex:{17 * i}:{17 * i + 16}" for i in range(len(words))))
    assert got[3] == (0, 0, 1, f"entropy:0:{len(blob.rstrip('='))}")
    assert got[4] == (0, 1, 0, "hex:0:4000000") and got[5] == (0, 0, 0, "") and got[1][:2] == got[6][:2] == (0, 0)


def test_running_sums(spark):
    sizes = (0, 1, 63, 64, 65, 4096, 4097, 300000)
    df = spark.createDataFrame([(n,) for n in sizes], "n int").select("n", F.expr("transform(slice(sequence(0, n), 1, n), x -> x % 7)").alias("v"))
    got = df.select("n", secrets.running(F.col("v")).alias("sums")).collect()
    for r in got:
        total, expected = 0, []
        for i in range(r["n"]):
            total += i % 7
            expected.append(total)
        assert r["sums"] == expected


def test_window_entropy_is_exact(spark):
    strings = ["abcdefghij0123456789KLMNOP", "a" * 20, "ab" * 15, "aaaaaaaaaaaaaaaaaaaaQx7Zk9Lp2Wv5Rt8Yb3Nc6Md"]

    def entropy(s):
        return max(-sum(w.count(c) / 20 * math.log2(w.count(c) / 20) for c in set(w)) for w in (s[i : i + 20] for i in range(len(s) - 19)))

    got = spark.createDataFrame([(s,) for s in strings], "s string").select("s", secrets.window_entropy(F.col("s")).alias("e")).collect()
    for r in got:
        assert r["e"] == pytest.approx(entropy(r["s"]), abs=1e-9)


# --- lines, near duplicates, repeats ----------------------------------------------------------


def test_line_dedup(corpus):
    df, texts = corpus
    out = line_dedup.dedup_lines(df)
    assert by_id(out, "doc_id", "n_lines", "n_dropped", "text") == brute.line_dedup(texts)
    assert [c for c in df.columns if c not in out.columns] == []


def test_line_dedup_runs_in_the_jvm(docs):
    plan = line_dedup.dedup_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    plan = secrets.scan_secrets(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_line_shared_by_most_documents(spark):
    texts = [f"a line that all of them hold\nown {i % 7} line of document" for i in range(400)]
    got = by_id(line_dedup.dedup_lines(rows.documents(spark, texts, extra=False)), "doc_id", "n_lines", "n_dropped", "text")
    assert got == brute.line_dedup(dict(enumerate(texts, 1)))


def test_near_duplicates(corpus):
    df, texts = corpus
    assert by_id(ngram_join.jaccard_components(df), "doc_id", "n_shingles", "component_id") == brute.near_duplicates(texts)


def chained(seed):
    """A text, its variants, and variants of those: links at every distance around the limit."""
    texts = [rows.prose(seed, 90)]
    for i in range(60):
        texts.append(rows.changed(texts[(i * 7) // 10], seed * 1000 + i, 1 + i % 5))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("block", [4, 2000])
def test_far_members_of_regions(spark, monkeypatch, seed, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    texts = [*chained(seed), *(rows.prose(seed + 50, 30) for _ in range(40)), *chained(seed + 10)]
    got = by_id(ngram_join.jaccard_components(rows.documents(spark, texts, extra=False)), "doc_id", "n_shingles", "component_id")
    assert got == brute.near_duplicates(dict(enumerate(texts, 1)))


def test_frequent_shingles(spark):
    """Most documents are near copies of one another, so that all their first shingles are frequent."""
    base = rows.prose(8, 60)
    texts = [*(rows.changed(base, i, i % 4) for i in range(240)), *(rows.prose(i, 25) for i in range(60)), *(base + " " + rows.prose(i, 8) for i in range(30))]
    df = rows.documents(spark, texts, extra=False)
    sets = df.mapInArrow(ngram_join.set_pass, ngram_join.SETS)
    assert sets.where("kind = 1").count() > 20
    got = by_id(ngram_join.jaccard_components(df), "doc_id", "n_shingles", "component_id")
    assert got == brute.near_duplicates(dict(enumerate(texts, 1)))


def test_limit_is_met_exactly(spark):
    words = [f"w{i}" for i in range(200)]
    # 60 shingles of which 60 / 80 are shared, and one fewer.
    texts = [" ".join(words[:64]), " ".join(words[:84]), " ".join(words[:85])]
    got = by_id(ngram_join.jaccard_components(rows.documents(spark, texts, extra=False)), "doc_id", "component_id")
    assert got == {1: (1,), 2: (1,), 3: (1,)}  # the third by way of the second
    got = by_id(ngram_join.jaccard_components(rows.documents(spark, [texts[0], texts[2]], extra=False)), "doc_id", "component_id")
    assert got == {1: (1,), 2: (2,)}


def test_repeats(corpus):
    df, texts = corpus
    texts = {d: t for d, t in texts.items() if len(t or "") < 30000}
    df = df.where(F.coalesce(F.length("text"), F.lit(0)) < 30000)
    assert by_id(substring_dedup.dedup_substrings(df), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.repeats(texts)


def test_repeats_within_a_text_of_one_letter(spark):
    n = 300_000
    docs = spark.createDataFrame([(1, "a" * n), (2, "b" * 99)], "doc_id long, text string")
    # Every window is a run of its own; what reaches the document's row are ranges of many of them.
    assert substring_dedup.repeated_spans(docs).count() < n / 1000
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in substring_dedup.dedup_substrings(docs).collect()}
    assert got == {1: (n - 1, 1), 2: (0, 0)}


def test_joined_ranges():
    got = substring_dedup.joined_ranges(*(np.array(x) for x in ([2, 1, 1, 1, 1], [0, 4, 0, 0, 9], [3, 5, 3, 3, 9])))
    assert [x.tolist() for x in got] == [[1, 1, 2], [0, 9, 0], [5, 9, 3]]


def test_parts_end_with_a_key():
    import pyarrow as pa

    key = [1, 1, 2, 3, 3, 3, 3, 3, 4, 5, 6, 6]
    parts = [p.column("key").to_pylist() for p in substring_dedup.by_groups(pa.table({"key": key}), 3)]
    assert parts == [[1, 1, 2], [3, 3, 3, 3, 3], [4, 5], [6, 6]]


def test_many_different_runs_at_one_anchor(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "WIDE", 3)
    passage = rows.PASSAGE[:110]
    texts = [f"{rows.prose(i, 12)} {passage} {rows.prose(i + 500, 12)}" for i in range(40)]
    got = by_id(substring_dedup.dedup_substrings(rows.documents(spark, texts, extra=False)), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute.repeats(dict(enumerate(texts, 1)))


# --- archives, packing, decontamination, rules ------------------------------------------------

WARC_COLUMNS = ("payload_bytes", "payload_digest", "record_type", "refers_to")


def test_warc(spark, data):
    pages = spark.createDataFrame(rows.PAGES, "page_id long, url string, html string").selectExpr("*", "'x' as original", "'x' as payload").repartition(3)
    assert by_id(warc.archive_pages(pages), "page_id", *WARC_COLUMNS) == brute.warc({p: h for p, _, h in rows.PAGES})
    pages = spark.read.parquet(f"{data}/pages.parquet")
    assert by_id(warc.archive_pages(pages), "page_id", *WARC_COLUMNS) == brute.warc({r["page_id"]: r["html"] for r in pages.collect()})


@pytest.mark.parametrize("most", [warc.MOST_ORIGINALS, 0])
def test_warc_round_trip(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(warc, "MOST_ORIGINALS", most)
    pages = spark.createDataFrame(rows.PAGES, "page_id long, url string, html string")
    recs = warc.records(pages)
    warc.write_archives(recs, warc.resolve(recs), path := f"file://{tmp_path}/archive")
    read = warc.read_archives(spark, path, with_payload=True).collect()
    assert {r["page_id"]: bytes(r["payload"]).decode() for r in read if r["record_type"] == "response"} == {p: h or "" for p, _, h in rows.PAGES if p not in (5, 9, 8)}
    # Any gzip reader opens the files; revisits name records that are there.
    plain = b"".join(gzip.decompress(f.read_bytes()) for f in (tmp_path / "archive").glob("part-*"))
    ids = set(re.findall(rb"WARC-Record-ID: (\S+)", plain))
    named = re.findall(rb"WARC-Refers-To: (\S+)", plain)
    assert len(ids) == len(rows.PAGES) and len(named) == 3 and set(named) < ids
    assert dict(re.findall(rb"WARC-Record-ID: (\S+)[^<]*WARC-Target-URI: (\S+)", plain)).keys() >= set(named)


def test_warc_archives_are_cut_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_GROUPS", 1)
    rng = np.random.default_rng(3)
    htmls = [rng.bytes(n).hex() for n in [1 << 20] * 12 + [10 << 20, 0, 60, 20 << 20]]
    pages = spark.createDataFrame([(i, "u", h) for i, h in enumerate(htmls)], "page_id long, url string, html string").coalesce(1)
    recs = warc.records(pages)
    warc.write_archives(recs, warc.resolve(recs), path := f"file://{tmp_path}/archive", "2020-02-02T02:02:02Z")
    sizes = [f.stat().st_size for f in (tmp_path / "archive").glob("part-*")]
    assert len(sizes) >= 5 and max(sizes) < 30 << 20 and sorted(sizes)[-3] < warc.GROUP_BYTES + (2 << 20)
    read = warc.read_archives(spark, path).collect()
    assert {r["page_id"]: (r["payload_bytes"], r["payload_digest"]) for r in read} == {i: (len(h), hashlib.sha256(h.encode()).hexdigest()) for i, h in enumerate(htmls)}


def test_pieces_are_the_tokenizers(corpus, tokenizer):
    df, texts = corpus
    got = {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in packing.pieces(df, registry.tokenizer_path()).collect()}
    assert got == brute.pieces(texts, tokenizer)


def packed_well(out, total_bound):
    bins = {}
    for r in out:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert len(bins) >= total_bound
    return len(bins)


def test_packing(corpus):
    df, texts = corpus
    out = packing.pack_documents(df, registry.tokenizer_path()).collect()
    assert {r["doc_id"] for r in out} == set(texts)
    n = packed_well(out, 1)
    assert n <= -(-sum(r["length"] for r in out) // packing.CAPACITY) + 1


def test_packing_rounds(spark, monkeypatch):
    import random

    monkeypatch.setattr(packing, "PER_PARTITION", 200)
    monkeypatch.setattr(packing, "OPEN_SHARE", 20)
    rng = random.Random(3)
    parts = spark.createDataFrame([(i, 0, 0, rng.choice([1, 50, 700, 1500, 2049, 4096]), 7) for i in range(3000)], packing.PIECES)
    out = packing.pack(parts).collect()
    assert sorted(r["doc_id"] for r in out) == list(range(3000))
    counts = [0] * (packing.CAPACITY + 1)
    for r in out:
        counts[r["length"]] += 1
    import numpy as np

    bound = packing.lower_bound(np.array(counts))
    n = packed_well(out, bound)
    assert n <= 1.02 * bound + 1
    assert packing.report(spark.createDataFrame(out)) == {"bins": n, "bound": bound, "gap": n - bound}


def test_certified_partitions_are_left_alone(spark, monkeypatch):
    """Whole sequences need no exchange: their partitions meet their bounds, and one round is all."""
    monkeypatch.setattr(packing, "PER_PARTITION", 100)
    parts = spark.range(1000).selectExpr("id as doc_id", "0 as piece", "0L as start", "4096L as length", "0L as ids_crc32")
    out = packing.pack(parts).collect()
    assert all(r["certified"] and r["sequence_id"] >> 54 == 0 for r in out) and packed_well(out, 1000) == 1000


@pytest.mark.parametrize("seed", range(6))
def test_packing_is_optimal_where_bounds_are_tight(seed):
    """Bins that are cut into pieces: no more are needed, and the bound never exceeds what an exhaustive search needs."""
    import random

    import numpy as np

    rng = random.Random(seed)
    lengths = [x for _ in range(4) for x in (lambda c: [c[0], c[1] - c[0], 24 - c[1]])(sorted(rng.sample(range(1, 24), 2)))]

    def least(todo, room):
        if not todo:
            return len(room)
        best, tried = len(lengths), set()
        for i, r in enumerate(room):
            if r >= todo[0] and r not in tried:
                tried.add(r)
                best = min(best, least(todo[1:], [*room[:i], r - todo[0], *room[i + 1 :]]))
        return min(best, least(todo[1:], [*room, 24 - todo[0]])) if len(room) < 5 else best

    exact = least(sorted(lengths, reverse=True), [])
    bound = packing.lower_bound(np.bincount(lengths, minlength=25), 24)
    assert bound <= exact <= len(packing.best_fit(np.array(lengths), 24)[2]) <= exact + 1


def test_last_round_keeps_every_piece(spark, monkeypatch):
    monkeypatch.setattr(packing, "PER_PARTITION", 400)
    monkeypatch.setattr(packing, "ROUNDS", 1)
    parts = spark.range(3000).selectExpr("id as doc_id", "0 as piece", "0L as start", "1 + (id * 7919) % 3000 as length", "0L as ids_crc32")
    assert sorted(r["doc_id"] for r in packing.pack(parts).collect()) == list(range(3000))


def test_sequences_hold_the_ids(docs, tokenizer):
    parts = written(packing.pieces(docs, registry.tokenizer_path(), with_ids=True))
    out = packing.sequences(parts, packing.pack(parts)).collect()
    expected = sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for t in rows.TEXTS)
    assert sum(len(r["ids"]) for r in out) == expected and all(len(r["ids"]) <= packing.CAPACITY for r in out)


def decontaminated(spark, df, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as doc_id")
    return by_id(decontamination.summary(decontamination.contamination(df, benchmark)), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def test_decontamination(spark, docs, table, data):
    assert decontaminated(spark, docs, rows.ITEMS) == brute.contamination(TEXTS, dict(rows.ITEMS))
    items = [tuple(r) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    assert decontaminated(spark, table[0], items) == brute.contamination(table[1], dict(items))


def test_decontamination_in_blocks(spark, docs, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 300)
    assert decontaminated(spark, docs, rows.ITEMS) == brute.contamination(TEXTS, dict(rows.ITEMS))


@pytest.mark.parametrize("block", [16 << 20, 300])
def test_repeated_and_null_item_ids(spark, monkeypatch, block):
    import duckdb

    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    passages = [rows.prose(i, 30) for i in range(200, 204)]
    texts = [*(f"{rows.prose(300 + i, 20)} {p}" for i, p in enumerate(passages)), " ".join(passages), rows.prose(310, 40)]
    items = [(1, passages[0]), (1, passages[0]), (1, passages[1]), (2, passages[1]), (None, passages[1]), (None, passages[2]), (None, passages[3]), (None, passages[3]), (3, "never seen words here")]
    df = rows.documents(spark, texts, extra=False)
    got = decontaminated(spark, df, items)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert (decontamination.n_blocks(benchmark) > 1) == (block == 300)
    assert got[1][1:4] == (30, 1, brute.sha("1")) and got[2][1:4] == (30, 3, brute.sha("1,2")) and got[5][1:4] == (120, 3, brute.sha("1,2"))
    assert got[3][1:] == got[4][1:] == (30, 1, brute.sha(""), True) and got[6][4] is False
    with duckdb.connect() as db:
        documents, benchmark = df.toArrow(), benchmark.toArrow()
        for name, table in (("documents", documents), ("benchmark", benchmark)):
            db.register(name, table)
        result = db.execute(decontamination.ORACLE_SQL)
        names = [x[0] for x in result.description]
        expected = [dict(zip(names, r)) for r in result.fetchall()]
    assert got == {r["doc_id"]: tuple(r[c] for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in expected}


def test_no_benchmark(spark, docs):
    assert decontaminated(spark, docs, []) == brute.contamination(TEXTS, {})


def test_proximity(spark):
    words = [f"rare{i}" for i in range(10)]
    texts = [" ".join(words), " ".join([*words[:5], "extra", *words[5:]]), " ".join([*words[:5], *["extra"] * 30, *words[5:]])]
    benchmark = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    got = by_id(decontamination.summary(decontamination.contamination(rows.documents(spark, texts, extra=False), benchmark)), "doc_id", "n_items", "n_near_items")
    assert got[1] == (1, 1) and got[2] == (0, 1)


def test_proximity_does_not_depend_on_partitions(spark):
    words = rows.PASSAGE.split()
    texts = [" ".join([*rows.prose(i, 30).split(), *words[:i], *["extra"] * (i % 3), *words[i:]]) for i in range(40)]
    df, benchmark = rows.documents(spark, texts, extra=False), spark.createDataFrame(rows.ITEMS, "item_id long, text string")
    found = [by_id(decontamination.summary(decontamination.contamination(df.repartition(n), benchmark)), "doc_id", "n_hit", "n_items", "n_near_items") for n in (1, 17)]
    assert found[0] == found[1] and any(x[2] for x in found[0].values())


def test_quality_rules(corpus):
    df, texts = corpus
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = by_id(quality_rules.quality_rules(df), "doc_id", *columns, "band_failed", "kept")
    for d, t in texts.items():
        assert got[d][:6] == brute.rules(t), (d, t)
        assert got[d][7] == (not got[d][5] and not got[d][6])


def test_compression_bands():
    import random

    import zstandard

    zstd, rng = zstandard.ZstdCompressor(level=quality_rules.LEVEL), random.Random(1)
    verdict = lambda raw: quality_rules.chunk_verdict(zstd, raw)
    noise = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(20000)).encode()
    assert verdict(noise)[3] and verdict(b"again and " * 2000)[3]
    assert verdict(b"") == (0.0, 0, 0, False)
    # Ordinary prose of every length band, from no generator of these tables: Python's own help texts.
    from pydoc_data.topics import topics

    for name in ("exceptions", "naming", "execmodel", "objects", "imports", "types", "specialnames"):
        prose = " ".join(re.sub(r"[*=~^-]{2,}", "", topics.get(name, "")).split()).encode()
        for n in (40, 100, 200, 400, 800, 1500, 3000, 5000, 9000):
            if n <= len(prose):
                assert not verdict(prose[:n])[3], (name, n, verdict(prose[:n]))
    prose = prose * 2
    # Every byte is in a chunk; the last one has the limits of its length.
    assert [verdict(noise[:n])[1] for n in (4096, 4097, 8192, 10000)] == [0, 2, 2, 3]
    mixed = prose[:4096] + noise[:4095]
    assert verdict(mixed)[2] == 1 and verdict(prose[:4096] + noise[:4000])[1] == 2


# --- classifier -------------------------------------------------------------------------------


def auc(pairs):
    """The share of (good, bad) pairs that the score puts in order."""
    good, bad = [s for s, y in pairs if y == 1], [s for s, y in pairs if y == 0]
    return sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))


def test_classifier_on_held_out_rows(spark, data):
    folder = data.replace("sf0.001", "sf0.01")
    got = by_id(registry.op1_quality_classifier(spark, folder), "doc_id", "held_out", "score", "predicted")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    import zlib

    assert all(held == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= s <= 1 and p == (s >= 0.3) for d, (held, s, p) in got.items())
    held = [(got[d][1], y) for d, y in labels.items() if d in got and got[d][0]]
    assert len(held) > 40 and auc(held) > 0.9


def test_labels_of_held_out_rows_are_not_used(spark, data):
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    held = quality_classifier.held_out(F.col("doc_id"))
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    scores = [by_id(quality_classifier.score_documents(docs, quality_classifier.train(docs, x)), "doc_id", "score") for x in (labels, turned)]
    assert scores[0] == scores[1]


def test_classifier_on_awkward_rows(spark, docs):
    labels = spark.createDataFrame([(i, int(i > 14), None) for i in range(1, 38)], "doc_id long, quality int, toxic int")
    model = quality_classifier.train(docs, labels)
    got = by_id(quality_classifier.score_documents(docs, model), "doc_id", "score", "predicted")
    assert set(got) == set(TEXTS) and all(0 <= s <= 1 for s, _ in got.values())
    assert got[1][0] == got[2][0]  # null and empty
    kept = quality_classifier.accepted(docs, model)
    assert kept.schema == docs.schema
    assert {r["doc_id"] for r in kept.collect()} == {d for d, (_, p) in got.items() if p}
    for some in (labels.where("quality = 1"), labels.where("false")):
        only = quality_classifier.score_documents(docs, quality_classifier.train(docs, some))
        assert {r["score"] for r in only.collect()} == {1.0}


def test_sample_of_labelled_rows_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(quality_classifier, "PER_CLASS", 10)
    df = rows.documents(spark, [rows.prose(i, 20) for i in range(600)], extra=False)
    labels = spark.createDataFrame([(i, int(i > 200)) for i in range(1, 601)], "doc_id long, quality int")
    model = quality_classifier.train(df, labels)
    assert sorted(model.labels) == [0.0] * 10 + [1.0] * 10
    smallest = [r[0] for r in labels.where(~quality_classifier.held_out(F.col("doc_id")) & (F.col("quality") == 1)).orderBy(F.xxhash64("doc_id")).limit(10).collect()]
    again = quality_classifier.train(df, labels.where((F.col("quality") == 0) | F.col("doc_id").isin(smallest)))
    assert sorted(map(tuple, again.vectors.round(4).tolist())) == sorted(map(tuple, model.vectors.round(4).tolist()))


def test_votes_match_a_plain_search():
    rng = np.random.default_rng(1)
    counts = (rng.random((120, quality_classifier.DIMS)) * (rng.random((120, quality_classifier.DIMS)) < 0.02)).astype(np.float32)
    labels, texts = np.arange(80) % 2, np.arange(120, dtype=np.uint64) // 2  # neighbouring rows have one text
    model = quality_classifier.fit(counts[:80].copy(), labels, texts[:80], {0: 100, 1: 40})
    whole = model.score(counts, texts)
    parts = np.concatenate([model.score(counts[a : a + 7], texts[a : a + 7]) for a in range(0, 120, 7)])
    assert np.allclose(whole, parts, atol=1e-5)
    vectors = [v / np.linalg.norm(v) for v in quality_classifier.shaped(counts.copy(), model.weight).astype(float) @ model.axes.astype(float)]
    for i in range(120):
        near = sorted(((float(vectors[i] @ vectors[j]), j) for j in range(80) if texts[j] != texts[i]), reverse=True)[: quality_classifier.K]
        votes = [(math.exp(quality_classifier.SHARPNESS * c) * (100 if labels[j] == 0 else 40), labels[j]) for c, j in near]
        assert math.isclose(whole[i], sum(v * y for v, y in votes) / sum(v for v, _ in votes), abs_tol=1e-4)


def test_own_label_is_no_vote(spark, data):
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    own = labels.join(docs.where("length(text) > 300").select("doc_id"), "doc_id").where(~quality_classifier.held_out(F.col("doc_id")) & (F.col("quality") == 1)).orderBy("doc_id").first()["doc_id"]
    turned = labels.withColumn("quality", F.when(F.col("doc_id") == own, 0).otherwise(F.col("quality")))
    # A lone text of label 0 among many that are like it: only its own vote could pull it down.
    score = by_id(quality_classifier.score_documents(docs, quality_classifier.train(docs, turned)), "doc_id", "score")[own][0]
    assert score > 0.9


def test_repeated_ids_send_one_text_each(spark, monkeypatch):
    seen = []
    fit = quality_classifier.fit
    monkeypatch.setattr(quality_classifier, "fit", lambda counts, labels, *a: seen.append(labels.tolist()) or fit(counts, labels, *a))
    docs = spark.createDataFrame([(1 + (i > 900), f"text {i}") for i in range(1000)], "doc_id long, text string")
    ids = [i for i in range(1, 9) if zlib.crc32(str(i).encode()) % 5][:2]
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") == 1, ids[0]).otherwise(ids[1]))
    quality_classifier.train(docs, spark.createDataFrame([(ids[0], 1), (ids[1], 0), (ids[1], 0)], "doc_id long, quality int"))
    assert seen == [[1, 0]]


# --- rows that all of them must take ----------------------------------------------------------

ON_DOCUMENTS = {
    "pii": pii.detect_pii,
    "lines": line_dedup.dedup_lines,
    "secrets": secrets.scan_secrets,
    "near": ngram_join.jaccard_components,
    "packing": lambda d: packing.pack_documents(d, registry.tokenizer_path()),
    "rules": quality_rules.quality_rules,
    "repeats": substring_dedup.dedup_substrings,
    "leaks": lambda d: decontamination.contamination(d, d.sparkSession.createDataFrame(rows.ITEMS, "item_id long, text string")),
    "classifier": lambda d: quality_classifier.score_documents(d, quality_classifier.train(d, d.sparkSession.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int"))),
}


@pytest.mark.parametrize("name", ON_DOCUMENTS)
def test_empty_table(spark, name):
    assert ON_DOCUMENTS[name](spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


@pytest.mark.parametrize("name", ON_DOCUMENTS)
def test_null_ids_and_repeated_rows(spark, name):
    texts = [(None, "a line that two rows hold\nand another one of them"), (None, None), (7, rows.PASSAGE), (7, rows.PASSAGE), (8, None), (8, "a line that two rows hold"), (9, "a line that two rows hold")]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    out = ON_DOCUMENTS[name](df).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in out} == {None: 2, 7: 2, 8: 2, 9: 1}


def test_empty_pages(spark):
    assert warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_null_pages(spark):
    pages = spark.createDataFrame([(None, "u", "x" * 200), (None, None, None), (1, "u", "x" * 200), (1, "u", "x" * 200), (2, None, "x" * 200)], "page_id long, url string, html string")
    got = [(r["page_id"], r["record_type"], r["refers_to"]) for r in warc.archive_pages(pages).collect()]
    assert sorted(got, key=str) == sorted([(None, "response", None)] * 2 + [(1, "response", None)] * 2 + [(2, "revisit", 1)], key=str)


def test_components(spark):
    from corvina.llm.components import components

    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(5, 5), (200, 200), (61, 70), (None, 3)]
    got = by_id(components(spark.createDataFrame(edges, "a long, b long")), "node", "component")
    nodes = {x for e in edges for x in e if x is not None} - {200}
    assert {k: v[0] for k, v in got.items()} == brute.smallest(nodes, [e for e in edges if None not in e and e[0] != 200])
