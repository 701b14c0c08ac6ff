"""Small tables between the steps are few files, and few of a batch's texts are Python strings at a time."""

import pyarrow as pa
import pytest

from tidemark.llm import common, components, near_dedup, packing, quality
from tidemark.llm.queries import tokenizer_path


@pytest.fixture
def many_partitions(spark):
    held = {"spark.sql.shuffle.partitions": "9", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture
def files(monkeypatch):
    """The number of files of each table that is written."""
    out = []

    def counted(df):
        written = common.cut(df)
        out.append(written.rdd.getNumPartitions())
        return written

    monkeypatch.setattr(components, "cut", counted)
    monkeypatch.setattr(near_dedup, "cut", counted)
    return out


def test_components_write_few_files(many_partitions, files):
    edges = many_partitions.createDataFrame([(i, i + 1) for i in range(20)] + [(50, 40), (60, 60), (None, 3)], "a long, b long")
    got = {r.node: r.root for r in components.connected_components(edges).collect()}
    assert got == {i: 0 for i in range(21)} | {40: 40, 50: 40}
    assert len(files) > 3 and set(files[1:]) == {1}


def test_near_duplicates_write_few_files(many_partitions, files):
    base = [" ".join(f"w{i * 40 + j}" for j in range(40)) for i in range(12)]
    rows = [(i, base[i % 12] + " x" * (i // 12)) for i in range(36)]
    kept = near_dedup.one_of_each_group(many_partitions.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id for r in kept.collect()} == set(range(12))
    assert len(files) > 10 and sum(n > 1 for n in files) <= 5  # the fingerprints, the decided pairs and their components' edges


def test_larger_tables_keep_their_partitions(spark):
    df = spark.range(0, 100, 1, 8)
    assert [common.few(df, n, 10).rdd.getNumPartitions() for n in (0, 10, 35, 80, 1000)] == [1, 1, 4, 8, 8]


def test_slices_are_the_batch():
    b = pa.RecordBatch.from_arrays([pa.array([None if i % 7 == 0 else f"t{i}" for i in range(1000)])], names=["t"])
    got = list(common.slices(iter([b, b.slice(0, 0), b.slice(5, 3)])))
    assert max(x.num_rows for x in got) == common.SLICE_ROWS and len(got) == -(-1000 // common.SLICE_ROWS) + 1
    assert pa.Table.from_batches(got).column("t").to_pylist() == b.column("t").to_pylist() + b.column("t").to_pylist()[5:8]


def test_the_pipeline_reads_small_batches(spark):
    pipeline, name = pytest.importorskip("corpus_pipeline"), "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(3000)], "doc_id long, text string").coalesce(1)
    try:
        for held, want in (("10000", common.BATCH_ROWS), ("0", common.BATCH_ROWS), ("100", 100)):
            spark.conf.set(name, held)
            pipeline.packing(spark, docs, "")
            sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"]) for b in batches), "n long").collect()
            assert max(r.n for r in sizes) == want and sum(r.n for r in sizes) == 3000
    finally:
        spark.conf.set(name, before)


def test_batches_of_several_slices(spark):
    texts = [None if i % 97 == 0 else f"word{i} and the other of {i} words " * (1 + i % 5) for i in range(700)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    tok = packing.WordTokenizer(tokenizer_path())
    pieces = {r.doc_id: (r.doc_tokens, r.nth) for r in packing.tokenised_pieces(docs, tokenizer_path()).collect()}
    assert pieces == {i: (len(tok.ids(t or "")) // 4 + 1, 0) for i, t in enumerate(texts)}
    judged = {r.doc_id: r.kept for r in quality.quality_scores(docs).collect()}
    assert len(judged) == 700 and {r.doc_id for r in quality.good_documents(docs).collect()} == {i for i, k in judged.items() if k}
