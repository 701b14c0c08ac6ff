"""Byte-level BPE, fill-in-middle and importance resampling, each against plain Python."""

import hashlib
import math
import os
import random
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import bpe, fim, resample
from tidemark.llm.queries import RANKS, op11_byte_bpe, op12_fill_in_middle, op13_importance_resampling, tokenizer_path

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
needs_ranks = pytest.mark.skipif(not os.path.exists("/opt/tokenizers/byte_bpe_multi_50k.tiktoken"), reason="no rank files")

#: Letters, digits, marks and white space of several kinds, some that libraries' tables disagree on.
ALPHABET = [*"ab's'll 12..\n\r\t  ", "é", "ß", "中", "٣", "Ⅷ", "²", "́", "\x85", "\xa0", " ", "　", "\x1c", "\x1f", "​", "😀", "࢏", "Ɤ", "\U0001e5f8", "\U0001c089", "꟒", "<|endoftext|>"]


def strange(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 40))) for _ in range(n)]


def plain_encoding():
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(tokenizer_path(RANKS)), special_tokens={}), public_tokenizers.PATTERN


@needs_ranks
def test_words_are_those_of_the_library():
    encoding, pattern = plain_encoding()
    splitter, encode = bpe.Splitter(pattern), encoding.encode_ordinary
    for text in [*strange(4000, 1), " " * 50, "\n \n", "x" * 300, "don't we'll  'S 's"]:
        words = [w for c in splitter.chunks(text) for w in splitter.words(c)]
        assert "".join(words) == text and [i for w in words for i in encode(w)] == encode(text), repr(text)


@needs_ranks
def test_encoding_equals_the_library(spark, docs, texts, odd, none):
    encoding, pattern = plain_encoding()
    path = tokenizer_path(RANKS)
    rows = [*texts, *enumerate(strange(300, 2), 1000), (2000, " the" * 30_000), (2001, "q" * 2000)]
    table = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, ids int").repartition(3)
    for chars in (bpe.BLOCK_CHARS, 3000):
        got = {r.doc_id: r for r in bpe.decode(bpe.encode(table, path, pattern, block_chars=chars), path).collect()}
        assert len(got) == len(rows)
        for i, t in rows:
            ids = encoding.encode_ordinary(t or "")
            assert got[i].n_tokens == len(ids) and bytes(got[i].ids) == np.array(ids, "<u4").tobytes() and bytes(got[i].decoded) == (t or "").encode()
    same = bpe.encode(odd, path, pattern)
    assert same.columns == ["doc_id", "n_tokens", "ids"]
    assert sorted((str(r.doc_id), r.n_tokens) for r in same.collect()) == sorted((str(r.doc_id), len(encoding.encode_ordinary(r.text or ""))) for r in odd.collect())
    assert bpe.decode(bpe.encode(none, path, pattern), path).count() == 0
    named = bpe.decode(bpe.encode(odd, path, pattern).selectExpr("ids AS IDS", "doc_id AS decoded", "n_tokens AS n"), path)
    assert named.columns == ["IDS", "n", "decoded"] and named.count() == 8
    held = spark.createDataFrame([(None,), (bytearray(),), (bytearray(struct.pack("<I", 50_300)),)], "ids binary")
    assert {r.decoded if r.decoded is None else bytes(r.decoded) for r in bpe.decode(held.where("ids IS NULL OR length(ids) = 0"), path).collect()} == {None, b""}
    with pytest.raises(Exception, match="no token"):
        bpe.decode(held, path).collect()


@needs_ranks
def test_blocks_list_each_word_once_and_share_one_exchange(spark, docs):
    _, pattern = plain_encoding()
    source = docs.selectExpr("doc_id AS i", "coalesce(text, '') AS t").coalesce(1)
    rows = bpe.blocks(source, pattern, 5, 2000).collect()
    lists = [[w for packed in r.words if packed for w in bpe.unpack_words(packed)] for r in rows]
    assert len(rows) > 10 and all(len(set(x)) == len(x) for x in lists) and len({r.block for r in rows}) == len(rows)
    assert sum(len(r.ids) for r in rows) == docs.count()
    plan = bpe.encode(docs, tokenizer_path(RANKS), pattern)
    plan.collect()
    assert "ReusedExchange" in plan._jdf.queryExecution().executedPlan().toString()


def test_packed_numbers_and_words():
    r = np.random.default_rng(1)
    for x in (np.zeros(0, np.int64), np.array([0, 254, 255, 256, 65_000, 70_000, 20_000_000]), r.integers(0, 1 << 20, 5000)):
        assert (bpe.unpack_numbers(bpe.pack_numbers(x)) == x).all()
    words = sorted({bytes(r.integers(97, 99, r.integers(0, 400)).astype(np.uint8)) for _ in range(300)} | {b"", b"a" * 3000, b"a" * 3001})
    assert bpe.unpack_words(bpe.pack_words(words)) == words


@needs_data
@needs_ranks
def test_encoding_query(spark):
    encoding, _ = plain_encoding()
    got = {r.doc_id: r for r in op11_byte_bpe(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = np.array(encoding.encode_ordinary(r.text or ""), "<u4")
        assert (got[r.doc_id].n_tokens, got[r.doc_id].ids_sha256, got[r.doc_id].decoded_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())


def middle_by_force(ident, text, rate=50, spm=80, seed=42):
    text = text or ""
    parts = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if ident is None else ident}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(parts)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
    if not text or any(x in text for x in fim.SENTINELS) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    return n, *(("spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < spm else ("psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"))


def test_fill_in_middle_equals_brute_force(spark, texts, odd, none, monkeypatch):
    r = random.Random(5)
    more = ["".join(r.choice(["a", "b ", " \t", "\n", "é", "😀 ", "\x0b", "\x1c", "\x85", "\xa0x", "<", "P>", "<S"]) for _ in range(r.randint(0, 30))) for _ in range(600)]
    rows = [*texts, *enumerate(more, 1000), (5000, "x <P> y"), (5001, "<M>"), (5002, " <" * 9), (5003, "<S"), (5004, "P>"), (5005, " "), (5006, "word " * 60_000)]
    for size, batch in ((fim.SLICE_BYTES, fim.BATCH_BYTES), (7, 100)):
        monkeypatch.setattr(fim, "SLICE_BYTES", size)
        for rate in (50, 100):
            some = rows if size > 7 else rows[-400:-1]
            held = pa.array([t or "" for _, t in some], pa.string())
            draw = np.array([[int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) for k in range(4)] for i, _ in some], np.int64)
            for lo, hi in fim.sliced(held, batch):
                made = fim.transformed(held.slice(lo, hi - lo), draw[lo:hi], rate, 80)
                got = list(zip(*[made[c].to_pylist() for c in ("n", "form", "prefix_chars", "middle_chars", "output")], strict=True))
                assert got == [middle_by_force(i, t, rate) for i, t in some[lo:hi]]
                assert fim.gathered(made["output"], made["form"]).to_pylist() == [t or "" for _, t in some[lo:hi]]
    table = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, restored string").repartition(3)
    out = fim.restored(fim.fill_in_middle(table))
    got = {x.doc_id: (x.n, x.form, x.prefix_chars, x.middle_chars, x.output, x.restored) for x in out.collect()}
    assert got == {i: (*middle_by_force(i, t), t or "") for i, t in rows}
    assert len({v[1] for v in got.values()}) == 3
    same = fim.fill_in_middle(odd, rate=100)
    assert same.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert sorted(map(str, (tuple(x) for x in same.collect()))) == sorted(str((x.doc_id, *middle_by_force(x.doc_id, x.text, 100))) for x in odd.collect())
    assert fim.restored(fim.fill_in_middle(none)).count() == 0
    gone = spark.createDataFrame([(None, "x", 1), ("plain", None, 2), ("plain", "y", 3)], "form string, output string, restored int")
    assert [x.restored for x in fim.restored(gone).orderBy("output").collect()] == [None, None, "y"]


@needs_data
def test_fill_in_middle_query(spark):
    got = {r.doc_id: tuple(r)[1:] for r in op12_fill_in_middle(spark, SF).collect()}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        *head, output = middle_by_force(r.doc_id, r.text)
        want[r.doc_id] = (*head, digest(output), digest(r.text or ""))
    assert got == want


def drawn_by_force(docs, target, percent=5, min_words=20, buckets=10_000, seed=42):
    def features(text):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        return words, [zlib.crc32(" ".join(words[i : i + n]).encode()) % buckets for n in (1, 2, 3) for i in range(len(words) - n + 1)]

    corpus, aim = np.zeros(buckets), np.zeros(buckets)
    for counts, texts in ((corpus, [t for _, t in docs]), (aim, target)):
        for t in texts:
            for b in features(t)[1]:
                counts[b] += 1
    gain = [math.floor(1000 * math.log((t + 1) * (corpus.sum() + buckets) / ((s + 1) * (aim.sum() + buckets)))) for s, t in zip(corpus.tolist(), aim.tolist(), strict=True)]
    rows = []
    for i, t in docs:
        words, found = features(t)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in found)
        rows.append([i, len(found), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    able = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: len(able) * percent // 100], 1):
        r[4] = k
    return [tuple(r[:5]) for r in rows]


def test_checksums_of_joined_words():
    shift, r = resample.Shift(), random.Random(2)
    for _ in range(300):
        a, b = (bytes(r.randrange(256) for _ in range(r.choice([0, 1, 5, 63, 64, 65, 200, 5000]))) for _ in range(2))
        assert int(shift(np.array([zlib.crc32(a)], np.uint32), np.array([len(b)]))[0]) ^ zlib.crc32(b) == zlib.crc32(a + b)


def test_resampling_equals_brute_force(spark, texts, odd, none, monkeypatch):
    r = random.Random(6)
    words = ["Alpha", "beta", "GAMMA", "é9", "中文", "x" * 70, "y" * 300, "d1", "_", "e-f", "ÀÉ", "\x7f"]
    more = [(1000 + i, " ".join(r.choice(words) for _ in range(r.randint(0, 60)))) for i in range(200)]
    rows = [*texts, *more, (9000, "alpha beta " * 40_000)]
    target = ["alpha beta gamma", None, "", "d1 e-f", "alpha " * 30]
    table, aim = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, rank int").repartition(3), spark.createDataFrame([(t,) for t in target], "text string")
    for step, percent in ((resample.STEP_WORDS, 5), (50, 37), (resample.STEP_WORDS, 100)):
        monkeypatch.setattr(resample, "STEP_WORDS", step)
        monkeypatch.setattr(resample, "STEP_BYTES", 20 * step)
        got = resample.resample(table, aim, percent=percent).select("doc_id", "n_features", "weight", "score", "rank").collect()
        assert sorted(map(tuple, got)) == sorted(drawn_by_force(rows, target, percent), key=lambda x: x[0])
    out = resample.resample(odd, aim, percent=50, min_words=0)
    assert out.columns == ["doc_id", "n_features", "n_words", "weight", "score", "rank"]
    want = drawn_by_force([(x.doc_id, x.text) for x in odd.collect()], target, 50, 0)
    assert sorted(str(x[:4]) for x in want) == sorted(str((x.doc_id, x.n_features, x.weight, x.score)) for x in out.collect())
    assert sorted(x.rank for x in out.collect() if x.rank) == [1, 2, 3, 4]
    assert resample.resample(none, aim).count() == 0
    assert [x.weight for x in resample.resample(table.limit(3), aim.limit(0)).collect()] is not None


def test_ties_go_to_the_smaller_identifier(spark):
    """A hot score: many rows without features differ in identifier, or not even in that."""
    rows = spark.range(4000).selectExpr("IF(id < 1000, id, NULL) AS doc_id", "0 AS score", "id AS row")
    by = [-rows.score, rows.doc_id.isNull().cast("int"), resample.F.coalesce("doc_id", resample.F.lit(0)), rows.row]
    for need in (1, 640, 1000, 1001, 3999, 4000):
        taken = rows.where(resample.first_rows(rows, by, need))
        assert taken.count() == need and taken.where("doc_id IS NOT NULL").count() == min(need, 1000)
        assert taken.selectExpr("max(doc_id)").first()[0] == min(need, 1000) - 1
    ranked = resample.numbered(rows, [rows.score.desc(), rows.doc_id.asc_nulls_last(), rows.row], "rank")
    assert ranked.where("doc_id IS NOT NULL AND rank <> doc_id + 1").count() == 0 and ranked.selectExpr("count(DISTINCT rank)", "max(rank)").first() == (4000, 4000)


@needs_data
def test_resampling_query(spark):
    docs, aim = ([tuple(r) for r in spark.read.parquet(f"{SF}/{t}.parquet").select(*c).collect()] for t, c in (("documents", ["doc_id", "text"]), ("benchmark", ["text"])))
    got = sorted(map(tuple, op13_importance_resampling(spark, SF).collect()))
    assert got == sorted(drawn_by_force(docs, [t for (t,) in aim]))
