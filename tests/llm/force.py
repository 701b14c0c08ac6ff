"""Plain Python twins of operators, for tests."""

import math
import struct

import xxhash

from tidemark.llm import line_dedup, mixing


def grams(text):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def alike(a, b):
    return a == b or (bool(a | b) and 5 * len(a & b) >= 4 * len(a | b))


def survivors(rows):
    """The identifiers that stay of (identifier, text): the smallest of each group of near-duplicates, by all pairs."""
    sets, root = {i: grams(t) for i, t in rows}, {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if find(a) != find(b) and alike(sets[a], sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i for i in ids if find(i) == i}


def hash_of(*parts):
    """Spark's xxhash64 of strings, ints and (value,) longs, as an unsigned number."""
    h = 42
    for p in parts:
        raw = p.encode() if isinstance(p, str) else struct.pack("<q", p[0]) if isinstance(p, tuple) else struct.pack("<i", p)
        h = xxhash.xxh64_intdigest(raw, h)
    return h


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def entropy(tokens, a):
    w = [t**a for t in tokens]
    return -sum(x / sum(w) * math.log(x / sum(w)) for x in w)


def drawn_by_force(rows, max_repeats=mixing.MAX_REPEATS, evenness=mixing.EVENNESS, seed=11, block_docs=mixing.BLOCK_DOCS):
    """How often each (identifier, text, source) is drawn, by identifier; identifiers are unique."""
    own, held = {}, {}
    for i, text, source in rows:
        n = len((text or "").encode().split())
        own.setdefault(source, []).append((f"{i}:{signed(xxhash.xxh64_intdigest((text or '').encode(), 42))}", i, n))
    tokens = {s: sum(n for *_, n in docs) for s, docs in own.items()}
    used = [t for t in tokens.values() if t]
    low, high = 0.0, 1.0
    aim = entropy(used, 1) + evenness * (entropy(used, 0) - entropy(used, 1))
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if entropy(used, mid) >= aim else (low, mid)
    spread = math.log(max(used) / min(used))
    a = max(low, 1 - math.log(max_repeats) / spread if spread > math.log(max_repeats) else 0.0)
    blocks = max(1, -(-max(map(len, own.values())) // block_docs))
    for source, docs in own.items():
        t = tokens[source]
        quota = round(t * (max(used) / t) ** (1 - a)) if t else 0
        epochs, rest = divmod(quota, t) if t else (1, 0)
        for _, i, _ in docs:
            held[i] = epochs
        in_block = {}
        for d in docs:
            in_block.setdefault(signed(hash_of(seed, d[0])) % blocks, []).append(d)
        name = "-" if source is None else f"={source}"
        for b in sorted(in_block, key=lambda b: (hash_of(seed + 1, name, (b,)) >> 1, b)):
            size = sum(n for *_, n in in_block[b])
            if rest <= 0:
                break
            left = rest
            for d in sorted(in_block[b], key=lambda d: (signed(hash_of(seed + 2, d[0])), d[0])):
                if d[2] <= left:
                    held[d[1]] += 1
                    left -= d[2]
            rest -= size
    return held


def lines_by_force(docs: list[tuple[int | None, str | None]]) -> list[list[str]]:
    """The lines that stay in each row by comparing all with all."""

    def near(a: str, b: str) -> bool:
        if abs(len(a) - len(b)) > 1:
            return False
        p = 0
        while p < min(len(a), len(b)) and a[p] == b[p]:
            p += 1
        s = 0
        while s < min(len(a), len(b)) - p and a[-1 - s] == b[-1 - s]:
            s += 1
        return max(len(a), len(b)) - p - s <= 1

    def order(i: int) -> tuple:
        ident, text = docs[i][0], docs[i][1] or ""
        return ident is None, signed(xxhash.xxh64_intdigest((text + "\0").encode(), 42)) if ident is None else ident, signed(xxhash.xxh64_intdigest(text.encode(), 42)), i

    places = sorted((order(i), at, i, line) for i, (_, text) in enumerate(docs) for at, line in enumerate((text or "").split("\n")) if line.strip(line_dedup.BLANK))
    first: dict[str, tuple[int, int]] = {}
    for _, at, i, line in places:
        first.setdefault(line, (i, at))
    order_of = {line: k for k, line in enumerate(first)}
    gone = {a for a in first if any(order_of[b] < order_of[a] and near(a, b) for b in first)}
    kept = {place for line, place in first.items() if line not in gone}
    return [[x for at, x in enumerate((text or "").split("\n")) if not x.strip(line_dedup.BLANK) or (i, at) in kept] for i, (_, text) in enumerate(docs)]
