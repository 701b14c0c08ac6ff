"""Exact, near, line and suffix dedup against brute force."""

import hashlib
from collections import Counter

import pytest
import xxhash

from force import lines_by_force

from tidemark.llm import line_dedup, simhash, suffix_dedup
from tidemark.llm.exact_dedup import distinct_documents, exact_dedup

#: Beyond it, doubles don't hold all integers.
BIG = 1 << 60


@pytest.mark.parametrize("split_rows", [256, 2])
def test_exact(docs, texts, split_rows):
    best, size = {}, Counter(t or "" for _, t in texts)
    for i, t in texts:
        best[t or ""] = max(i, best.get(t or "", -1))
    got = {r.doc_id: r for r in exact_dedup(docs, split_rows=split_rows).collect()}
    assert len(got) == len(texts)
    for i, t in texts:
        assert (got[i].keep_id, got[i].group_size, got[i].kept) == (best[t or ""], size[t or ""], best[t or ""] == i)
    smallest = exact_dedup(docs, split_rows=split_rows, keep="smallest").where("kept").count()
    assert smallest == len(size)


@pytest.mark.parametrize("split_rows", [256, 1])
def test_exact_odd_rows(odd, none, split_rows):
    out = exact_dedup(odd, split_rows=split_rows).collect()
    assert len(out) == 8 and Counter(r.text for r in out if r.kept and r.text) == {"same": 1, "alone": 1}
    assert [r.doc_id for r in out if r.kept and not r.text] == [4] and all(r.xd_salt == 5 for r in out)
    assert next(r.keep_id for r in out if r.text == "same") == 2 and next(r.keep_id for r in out if r.text == "alone") is None
    kept = distinct_documents(odd)
    assert kept.columns == odd.columns and kept.count() == 3
    assert exact_dedup(none).count() == 0 and distinct_documents(none).count() == 0


def slow_simhash(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, radius=2):
    ids, root = list(fps), {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(ids)):
        for b in range(a):
            if (fps[ids[a]] ^ fps[ids[b]]).bit_count() <= radius:
                x, y = sorted((find(ids[a]), find(ids[b])))
                root[y] = x
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("split_rows", [256, 1])
def test_simhash(docs, texts, split_rows):
    fps = {i: slow_simhash(t) for i, t in texts}
    want = components(fps)
    got = {r.doc_id: r for r in simhash.near_duplicates(docs, split_rows=split_rows).collect()}
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == {i: (f"{f:016x}", want[i]) for i, f in fps.items()}


def test_covering_masks_miss_no_pair():
    masks = [m & (1 << 64) - 1 for m in simhash.covering_masks(2)]
    assert len(masks) == 7 and all(any(m & ((1 << a) | (1 << b)) == 0 for m in masks) for a in range(64) for b in range(64))


def test_links_of_large_buckets_equal_those_of_small_ones(monkeypatch):
    import numpy as np

    r = np.random.default_rng(1)
    fps = np.unique(r.integers(0, 1 << 12, 300).astype(np.int64))

    def groups(edges):
        root = {int(f): int(f) for f in fps}

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for a, b in edges:
            root[find(a)] = find(b)
        found = {}
        for f in root:
            found.setdefault(find(f), set()).add(f)
        return sorted(map(sorted, found.values()))

    small = groups(simhash.links_in_bucket(fps, 2))
    monkeypatch.setattr(simhash, "SMALL_BUCKET", 1)
    assert groups(simhash.links_in_bucket(fps, 2)) == small


def test_simhash_odd_rows(odd, none):
    out = simhash.near_duplicates(odd).collect()
    assert len(out) == 8 and {r.component_id for r in out if r.fingerprint == "0" * 16} == {3}
    assert simhash.near_duplicates(none).count() == 0


def test_simhash_keeps_identifiers(spark):
    rows = [(BIG + 1, "one two three"), (None, "four five six seven"), (BIG + 2, "eight nine ten"), (None, None), (BIG + 3, "one two three")]
    out = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    want = [(i, f"{slow_simhash(t):016x}", {BIG + 3: BIG + 1}.get(i, i)) for i, t in rows]
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)


def test_components_of_a_long_chain_and_a_star(spark):
    from tidemark.llm.components import connected_components

    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(299, k) for k in range(200, 299)] + [(7, 7), (None, 3), (2, 1)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {k: 100 for k in range(100, 140)} | {k: 200 for k in range(200, 300)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_lines(spark):
    import random

    r = random.Random(5)
    base = ["".join(r.choice("abc de") for _ in range(r.randint(18, 40))) for _ in range(25)]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(r.randint(0, 6)):
            x = r.choice(base)
            for _ in range(r.choice([0, 0, 1, 1, 2])):
                j = r.randrange(len(x))
                x = r.choice([x[:j] + x[j + 1 :], x[:j] + "é" + x[j:], x[:j] + "z" + x[j + 1 :]])
            lines.append(x)
        rows.append((i, "\n".join(lines)))
    rows += [(50, None), (51, ""), (52, "short\n\nshort"), (53, "long " * 20_000), (54, "long " * 20_000 + "x")]
    # short lines of all lengths, rows without an identifier, with the same one, and equal rows
    rows += [(60 + i, "\n".join("".join(r.choice("abé") for _ in range(r.randint(0, 9))) for _ in range(6))) for i in range(12)]
    rows += [(None, rows[3][1]), (None, "only here, of no one"), (None, "only here, of no one"), (61, "another text of sixty-one\nab"), (61, "another text of sixty-one\nab"), (BIG + 1, "of the large"), (BIG, "of the larger")]
    want = Counter(zip([i for i, _ in rows], ["\n".join(x) for x in lines_by_force(rows)], strict=True))
    for parts in (1, 5):
        out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)).collect()
        assert Counter((x.doc_id, x.text or "") for x in out) == want
    by = {x.doc_id: x for x in out}
    assert by[50].text is None and by[50].n_lines == 0 and by[51].n_lines == 1 and by[54].n_dropped == 1


def test_lines_odd_rows(odd, none):
    out = line_dedup.dedup_lines(odd)
    assert set(out.columns) == set(odd.columns) | {"n_dropped"} and all((r.kept, r.keep_id) in {(1, 1), (1, None), (1, 2)} for r in out.collect())
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter([(1, "same"), (1, ""), (2, ""), (None, ""), (None, "alone"), (None, ""), (3, None), (4, "")])
    assert line_dedup.dedup_lines(none).count() == 0


def removed_by_force(rows, span=200):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row."""
    count, out = Counter(), []
    raws = [(i, (t or "").encode()) for i, t in rows]
    for _, raw in raws:
        count.update(raw[k : k + span] for k in range(len(raw) - span + 1))
    for i, raw in raws:
        gone = bytearray(len(raw))
        for k in range(len(raw) - span + 1):
            if count[raw[k : k + span]] > 1:
                gone[k : k + span] = b"\1" * span
        runs = sum(1 for k, x in enumerate(gone) if x and (k == 0 or not gone[k - 1]))
        out.append((i, len(raw), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(raw, gone, strict=True) if not g)).hexdigest()))
    return Counter(out)


def removed(df, **how):
    return Counter((r.doc_id, r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in suffix_dedup.remove_repeats(df, **how).collect())


@pytest.mark.parametrize("split_rows", [256, 2])
def test_suffixes(docs, texts, split_rows, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "RUN_ROWS", 50)
    want = removed_by_force(texts)
    assert removed(docs, split_rows=split_rows) == want and sum(k[2] for k in want) > 5000


@pytest.mark.parametrize("split_rows", [256, 1])
def test_suffixes_of_rows_without_an_identifier_of_their_own(spark, texts, split_rows):
    p, u, v = "p" * 3 + "repeated passage %d " * 20, "".join(map(str, range(300))), " ".join(map(str, range(7000, 7200)))
    rows = [(1, p), (2, p), (2, u), (None, p), (None, v), (None, v), (3, "y" + v[:250]), (4, "a" * 700), (None, "lone " + " ".join(map(str, range(500, 700)))), (BIG + 1, p + "1"), (BIG + 2, p + "2"), (5, None), (6, "")]
    want = removed_by_force(rows)
    for parts in (1, 4):
        assert removed(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts), split_rows=split_rows) == want
    assert sum(n for k, n in want.items() if k[1] == len(u) and k[2] == 0) == 1


def test_suffixes_odd_rows(odd, none):
    assert removed(odd) == removed_by_force([(r.doc_id, r.text) for r in odd.collect()]) and suffix_dedup.remove_repeats(none).count() == 0


def test_loser_tree_merges_front_coded_runs():
    import random

    r = random.Random(2)
    runs = [sorted("".join(r.choice("ab") for _ in range(r.randint(0, 9))).encode() for _ in range(r.randint(0, 30))) for _ in range(7)]
    coded = [(suffix_dedup.front_code(x), len(x)) for x in runs]
    tree = suffix_dedup.LoserTree([((s, p, None) for s, p in suffix_dedup.front_decode(b, n)) for b, n in coded])
    got = list(tree)
    want = sorted(s for x in runs for s in x)
    assert [g[0] for g in got] == want
    for (a, _, _), (b, p, _) in zip(got, got[1:], strict=False):
        assert p == suffix_dedup.common_prefix(a, b, 0)
    assert list(suffix_dedup.LoserTree([])) == []
