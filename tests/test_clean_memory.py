"""Decoding of references holds few of a batch's texts as Python strings."""

import tracemalloc

import pyarrow as pa

from tidemark.sources import parse


def test_a_batch_is_decoded_by_slices():
    texts = pa.array([None, " ", *[f" &lt;{i}&gt; " + "x" * 2000 for i in range(20_000)]])
    tracemalloc.start()
    out = parse._decoded(texts)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.type == pa.string() and out[:3].to_pylist() == [None, None, "<0> " + "x" * 2000] and len(out) == len(texts) and out[-1].as_py().startswith("<19999>")
    assert most < 4_000_000  # 80 MB when all were strings at once
    assert parse._decoded(texts.slice(0, 0)).to_pylist() == []
