"""Suffix dedup of long texts that repeat one string: marks are runs, spans are intervals."""

import random
import time

import numpy as np
import pytest
from test_dedup import removed, removed_by_force

from tidemark.llm import suffix_dedup


def test_pieces_have_the_anchors_of_the_whole(monkeypatch):
    r = random.Random(7)
    texts = [bytes(r.choice(b"ab") for _ in range(3000)), b"q" * 2500, b"xyz" * 900, b"", b"short", bytes(r.randrange(256) for _ in range(1000)) * 3]
    for text in texts:
        whole = suffix_dedup.anchors(np.frombuffer(text, np.uint8), np.array([len(text)]))
        for piece in (1 << 20, 700, 64):
            monkeypatch.setattr(suffix_dedup, "PIECE", piece)
            at, h = suffix_dedup.anchors_of(text)
            assert at.tolist() == whole[0].tolist() and h.tolist() == whole[1].tolist()


def test_runs_and_unions():
    r = np.random.default_rng(2)
    for _ in range(200):
        n = int(r.integers(1, 60))
        at, h, of = np.cumsum(r.integers(1, 4, n)), r.integers(0, 2, n), np.sort(r.integers(0, 3, n))
        first, run = suffix_dedup.runs_of(at, h, of, 2)
        back = [(int(at[f]) + (x >> 16) * k, int(h[f]), int(of[f])) for f, x in zip(first, run.tolist()) for k in range(x & 0xFFFF)]
        assert back == list(zip(at.tolist(), h.tolist(), of.tolist()))
        starts, stops = r.integers(0, 50, n), 0
        stops = starts + r.integers(1, 9, n)
        x, y = suffix_dedup.merged(starts, stops)
        assert {i for a, b in zip(x, y) for i in range(a, b)} == {i for a, b in zip(starts, stops) for i in range(a, b)} and (x[1:] > y[:-1]).all()
    first, run = suffix_dedup.runs_of(np.arange(200_000), np.zeros(200_000), np.zeros(200_000), 137)
    assert len(first) == 4 and sum(x & 0xFFFF for x in run.tolist()) == 200_000


@pytest.mark.parametrize("split_rows", [4, 256])
@pytest.mark.parametrize("windows", [50, 500_000])
def test_repeated_strings_equal_brute_force(spark, split_rows, windows, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "WINDOWS", windows)
    r = random.Random(9)
    noise = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    once = noise(260)
    rows = [(1, "=" * 900), (2, noise(300) + "=" * 230 + noise(40)), (3, "ab" * 400), (4, "b" + "ab" * 150), (5, "z" * 200), (6, "y" * 201), (7, noise(137) * 5), (8, once), (9, noise(30) + once), (10, "é" * 400), (None, "=" * 250), (11, noise(500))]
    rows += [(20 + i, noise(50) + "-" * 260 + noise(50)) for i in range(30)]
    assert removed(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), split_rows=split_rows) == removed_by_force(rows)


def test_a_text_of_five_million_equal_characters(spark):
    rows = [(1, "q" * 5_000_000), (2, "a short text"), (3, "p" + "q" * 300), (4, "xy" * 1_000_000)]
    began = time.time()
    got = {r.doc_id: (r.n_bytes, [(s.start, s.stop) for s in r.spans], bytes(r.kept)) for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (5_000_000, [(0, 5_000_000)], b""), 2: (12, [], b"a short text"), 3: (301, [(1, 301)], b"p"), 4: (2_000_000, [(0, 2_000_000)], b"")}
    assert time.time() - began < 240  # far less where nothing else runs
