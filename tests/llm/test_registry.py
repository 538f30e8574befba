"""Queries against their SQL, and the pipeline's stages against plain versions."""

import glob
import os
import random

import duckdb
import pytest

from corvina.llm import registry

from . import brute


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for f in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_sql(name, spark, data, duck):
    df = registry.queries()[name](spark, data)
    result = duck.execute(registry.oracle_sql()[name])
    names = [x[0] for x in result.description]
    assert sorted(names) == sorted(df.columns)
    columns = sorted(names)
    expected = sorted(tuple(str(row[names.index(c)]) for c in columns) for row in result.fetchall())
    assert sorted(tuple(str(r[c]) for c in columns) for r in df.collect()) == expected


def test_pipeline_stages(spark, data):
    import corpus_pipeline

    from corvina.llm.common import written

    texts = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}
    docs = spark.read.parquet(f"{data}/documents.parquet")
    held = [docs]
    for _, stage in corpus_pipeline.STAGES:
        held.append(written(stage(spark, held[-1], data)))
    assert all(x.columns == docs.columns for x in held[1:-1])
    start, good, lines, single, clean = map(texts, held[:-1])
    assert set(good) < set(start) and all(start[d] == t for d, t in good.items())
    predicted = {r["doc_id"] for r in registry.op1_quality_classifier(spark, data).collect() if r["predicted"]}
    assert set(good) == predicted
    assert lines == {d: x[2] for d, x in brute.line_dedup(good).items()}
    assert all(r["n_chars"] == len(r["text"]) for r in held[2].collect())
    assert single == {d: lines[d] for d, x in brute.near_duplicates(lines).items() if x[1] == d}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()}
    assert clean == {d: single[d] for d, x in brute.contamination(single, items).items() if not x[-1]}
    assert {r["doc_id"] for r in held[-1].collect()} == set(clean)
    assert registry.pipeline(spark, data).count() == held[-1].count()


WORDS = "river lantern copper meadow thunder basket velvet harbour pepper candle marble orchard saddle timber violin walnut anchor barley cobalt dragon ember falcon garnet hollow island jasmine kettle lemon mirror nectar".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(1000)) for _ in range(n))


def tables(spark, folder, documents, benchmark):
    docs = spark.createDataFrame(documents, "doc_id long, text string").selectExpr("doc_id", "text", "'en' as lang", "'web' as source", "cast(length(text) as long) as n_chars", "'x' as `__key`", "1 as component_id", "0.5 as score")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(benchmark, "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_pipeline_on_awkward_rows(spark, tmp_path):
    import corpus_pipeline

    passage, first, clean, other = prose(0, 14), prose(1, 60), prose(2, 40), prose(3, 30)
    near = first.rsplit(" ", 1)[0] + " else"
    hit = lambda seed: f"{prose(seed, 30)} {passage} {prose(seed + 1, 30)}"
    # Without labels, every document is good; 2 loses its only line to 1; 7 is a near copy of 1.
    documents = [(1, first), (1, first), (1, other), (2, first), (3, None), (4, ""), (None, hit(10)), (None, clean), (5, hit(20)), (6, prose(30, 20000)), (7, near), (8, "short"), (8, "short")]
    tables(spark, folder := f"file://{tmp_path}", documents, [("i", passage), ("i", passage), (None, None), ("e", "")])
    held = [spark.read.parquet(f"{folder}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        held.append(stage(spark, held[-1], folder))
        assert held[-1].columns == corpus_pipeline.COLUMNS
        held[-1] = held[-1].sparkSession.createDataFrame(held[-1].collect(), held[-1].schema)
    got = sorted(((r["doc_id"], r["text"] or "") for r in held[-1].collect()), key=str)
    assert got == sorted([(1, first), (1, other), (2, ""), (3, ""), (4, ""), (None, clean), (6, documents[9][1]), (8, "short")], key=str)
    packed = corpus_pipeline.run(spark, folder)
    assert sorted((str(r["doc_id"]) for r in packed.where("piece = 0").collect())) == sorted(str(d) for d, _ in got)


def test_pipeline_on_empty_tables(spark, tmp_path):
    tables(spark, folder := f"file://{tmp_path}", [], [])
    assert registry.pipeline(spark, folder).count() == 0
