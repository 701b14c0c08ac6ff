"""Rows equal in identifier and text spread over groups like any others."""

import os

import pytest

from tidemark.llm import packing
from tidemark.llm.queries import tokenizer_path

needs_tokenizer = pytest.mark.skipif(not os.path.exists("/opt/tokenizers/word_bpe_49k.json"), reason="no tokenizer files")


@needs_tokenizer
@pytest.mark.parametrize("ident", ["CAST(NULL AS LONG)", "7L"])
def test_packing_of_many_equal_rows(spark, ident):
    n, size = 30_000, 64
    rows = spark.range(n).selectExpr(f"{ident} AS doc_id", "IF(id % 3 = 0, '', 'a few words of text') AS text").repartition(4)
    out = packing.pack(rows, tokenizer_path(), sequence_tokens=size, group_docs=1000)
    held = out.selectExpr("sequence_id >> 32 AS grp", "length").groupBy("grp").count().collect()
    assert sum(r["count"] for r in held) == n and len(held) == 30 and max(r["count"] for r in held) < 1500
    full = out.groupBy("sequence_id").agg({"length": "sum", "offset": "max"}).selectExpr("min(`sum(length)`)", "max(`sum(length)`)", "count(*)").first()
    assert full[1] <= size and full[2] * size * 0.9 < n / 3 + 2 * n / 3 * 6
