"""The pipeline, whole and stage by stage, against plain Python."""

import os
from collections import Counter

import pytest
from force import drawn_by_force, survivors
from pyspark.sql import functions as F

from tidemark.llm import packing, quality
from tidemark.llm.queries import tokenizer_path

pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF) or not os.path.exists("/opt/tokenizers/word_bpe_49k.json"), reason="no test data or tokenizer files")


def test_run_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    weights = quality.fitted(docs.selectExpr("coalesce(text, '') AS t"))[1]
    good = [r for r in rows if quality.score(r[1] or "", weights) >= quality.KEEP_FROM]
    last = {}
    for i, text, _ in good:
        last[text or ""] = max(i, last.get(text or "", i))
    distinct = [r for r in good if last[r[1] or ""] == r[0]]
    stay = survivors([(i, t) for i, t, _ in distinct])
    assert len(good) < len(rows) and len(distinct) < len(good) and len(stay) < len(distinct)
    times = drawn_by_force([r for r in distinct if r[0] in stay])
    tok = packing.WordTokenizer(tokenizer_path())
    want = Counter()
    for i, text, _ in distinct:
        if i in stay:
            want[i, len(tok.ids(text or "")) // 4 + 1] = times[i]
    out = pipeline.run(spark, SF).toPandas()
    whole = out.groupby(["doc_id", "doc_tokens"]).length.sum()
    assert {k: n * k[1] for k, n in want.items()} == whole.to_dict()
    for _, s in out.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s.offset.tolist() == [0, *s.length.cumsum().tolist()[:-1]] and s.length.sum() <= 4096


def test_stages_hand_on_the_columns_of_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs]
    for k, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, seen[-1], SF).write.parquet(str(tmp_path / str(k)))
        seen.append(spark.read.parquet(str(tmp_path / str(k))))
    assert all(s.columns == docs.columns for s in seen[:-1]) and all(s.count() for s in seen)
    got = seen[-1].agg(F.sum("length"), F.countDistinct("doc_id")).first()
    assert tuple(got) == tuple(pipeline.run(spark, SF).agg(F.sum("length"), F.countDistinct("doc_id")).first())


def test_stages_take_empty_and_odd_tables(spark, odd, none):
    for table, most in ((none, 0), (odd, 8)):
        out = table
        for _, stage in pipeline.STAGES[:-1]:
            out = stage(spark, out, "")
            assert out.columns == table.columns
        assert (out.count() > 0) == (most > 0)
        packed = pipeline.STAGES[-1][1](spark, out, "")
        assert (packed.count() > 0) == (most > 0)
