"""Removal of long repeated byte strings by sorting suffixes.

A byte goes if it lies in a string of `span` bytes that also starts anywhere else. All suffixes of a corpus, cut at
`span` bytes, would be hundreds of times its size, so only those at anchors are sorted: in every window of `span`
bytes the smallest hash of a gram marks its anchors. Equal windows have equal anchors at the same offset, so each
repeated string is met at an anchor, and suffixes whose gram occurs once in the corpus are left out.

A suffix stands with the bytes before it, read backwards, behind it. Each task sorts its suffixes and sends them as
front-coded runs: the length of the prefix shared with the one before, and the rest. The receiver merges its runs with
a loser tree that keeps the known common prefixes and compares bytes beyond them only. In the merged order, neighbours'
common prefixes say which suffixes agree to the right of the anchor, hashes of the bytes before it which agree to the
left; together they say for every offset whether the window there is repeated.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import DERIVED, SPLIT_ROWS, cut, packed, partitions, repeated, row_keys

#: An odd factor: another hash of a hash, one to one.
SPREAD = 0xC2B2AE3D27D4EB4F

#: Bytes of a repeated string, and of the grams whose hashes choose anchors.
SPAN, GRAM = 200, 64
#: Suffixes in one sorted run at most, and those judged at once.
RUN_ROWS, JUDGED_ROWS = 131_072, 16_384
#: Bytes hashed at once, and of a longer text at a time; windows hashed at once.
CHUNK, PIECE, WINDOWS = 1 << 18, 1 << 20, 500_000

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def window_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the size bytes from each position; those that reach beyond the end are of what is there."""
    n = len(codes)
    one = _BYTE[codes]
    out, length, power = one.copy(), 1, _MULTIPLIER
    with np.errstate(over="ignore"):
        for bit in bin(size)[3:]:
            twice = out * power
            if length < n:
                twice[: n - length] += out[length:]
            out, length, power = twice, 2 * length, power * power
            if bit == "1":
                more = out * _MULTIPLIER
                if length < n:
                    more[: n - length] += one[length:]
                out, length, power = more, length + 1, power * _MULTIPLIER
        out ^= out >> np.uint64(31)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(29)
    return out


def _sliding(x: np.ndarray, size: int, best: np.ufunc) -> np.ndarray:
    """best over x[i : i + size], what lies beyond the end left out."""
    out, length = x.copy(), 1
    while length < size:
        step = min(length, size - length)
        out[:-step] = best(out[:-step], out[step:]) if step < len(out) else out[:-step]
        length += step
    return out


def anchors(codes: np.ndarray, lengths: np.ndarray, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Anchor positions in the concatenated documents and their grams' hashes.

    In each window of span bytes inside one document, every gram with the window's smallest hash is an anchor.
    """
    n, width = len(codes), span - gram + 1
    if n < span:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = window_hashes(codes, gram)
    least = _sliding(h, width, np.minimum)
    ends = np.repeat(np.cumsum(lengths), lengths)
    least[np.arange(n) + span > ends] = 0
    # the largest of the minima of the windows that a position lies in: equal to its own hash if it is one of them
    reach = _sliding(least[::-1], width, np.maximum)[::-1]
    at = np.flatnonzero((reach == h) & (reach > 0))
    return at, h[at]


def anchors_of(text: bytes, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """anchors() of one text, in pieces: which grams are chosen near a place depends on span bytes around it only."""
    reach, found = span - gram, []
    for lo in range(0, max(1, len(text)), PIECE):
        start, hi = max(0, lo - reach), min(len(text), lo + PIECE)
        piece = np.frombuffer(text, np.uint8)[start : hi + span]
        at, h = anchors(piece, np.array([len(piece)]), span, gram)
        inside = (at + start >= lo) & (at + start < hi)
        found.append((at[inside] + start, h[inside]))
    return np.concatenate([at for at, _ in found]), np.concatenate([h for _, h in found])


def runs_of(at: np.ndarray, h: np.ndarray, ends: np.ndarray, most_step: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of one gram at even steps become a run: the index of each run's first anchor, and step << 16 | anchors.

    ends: of each anchor's text, so that no run leaves it. A text of one repeated string has few runs, however long.
    """
    n = len(at)
    step = np.diff(at, prepend=0)
    linked = np.zeros(n, bool)
    linked[1:] = (h[1:] == h[:-1]) & (ends[1:] == ends[:-1]) & (step[1:] <= most_step)
    uneven = np.zeros(n, bool)
    uneven[2:] = linked[1:-1] & (step[2:] != step[1:-1])
    first = np.flatnonzero(~linked | uneven)
    sizes = np.diff(first, append=n)
    parts = -(-sizes // 0xFFFF)  # the number of a run's anchors has 16 bits
    first = np.repeat(first, parts) + 0xFFFF * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    sizes = np.diff(first, append=n)
    steps = np.where(sizes > 1, step[np.minimum(first + 1, n - 1)], 1)
    return first, (steps << 16 | sizes).astype(np.int32)


def merged(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of the intervals from starts to stops, those that touch joined, in order."""
    order = np.argsort(starts, kind="stable")
    starts, reached = starts[order], np.maximum.accumulate(stops[order])
    opens = np.ones(len(starts), bool)
    opens[1:] = starts[1:] > reached[:-1]
    return starts[opens], np.append(reached[:-1][opens[1:]], reached[-1:])


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about CHUNK bytes."""
    a = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK:
            yield a, i + 1
            a, size = i + 1, 0
    if a < len(texts):
        yield a, len(texts)


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """The length of the common prefix of a and b, of which known bytes are known to be common."""
    n = min(len(a), len(b))
    at = known
    while at < n and a[at : at + 32] == b[at : at + 32]:
        at += 32
    stop = min(n, at + 32)
    while at < stop and a[at] == b[at]:
        at += 1
    return min(at, n)


def front_code(sorted_: list[bytes]) -> bytes:
    """Sorted strings as (common prefix with the one before, length of the rest) and the rests."""
    heads, rests, last = bytearray(), [], b""
    for s in sorted_:
        p = common_prefix(last, s, 0)
        heads += struct.pack("<HH", p, len(s) - p)
        rests.append(s[p:])
        last = s
    return bytes(heads) + b"".join(rests)


def front_decode(blob: bytes, count: int) -> Iterator[tuple[bytes, int]]:
    """The strings of a front-coded run, each with its common prefix with the one before."""
    at, last = 4 * count, b""
    for p, rest in struct.iter_unpack("<HH", blob[:at]):
        last = last[:p] + blob[at : at + rest]
        at += rest
        yield last, p


class LoserTree:
    """Merges sorted runs of (string, common prefix with the run's string before, payload).

    A contender carries the length of its common prefix with the string that left last. Of two contenders the one with
    the longer such prefix is smaller, and the other's stays known; only if they are equal are bytes compared, from
    there on. Iterating gives (string, common prefix with the string before, payload) in order.
    """

    def __init__(self, runs: list[Iterator[tuple[bytes, int, object]]]):
        self.runs = runs
        self.heads = [next(r, None) for r in runs]
        self.known = [0] * len(runs)

    def _beats(self, a: int, b: int) -> bool:
        """Whether head a leaves before head b; sets what is known of the loser."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        ka, kb = self.known[a], self.known[b]
        if ka != kb:
            return ka > kb
        s, t = x[0], y[0]
        p = common_prefix(s, t, ka)
        if p == len(s) and p == len(t):
            first = a < b
        else:
            first = s[p : p + 1] < t[p : p + 1]
        self.known[b if first else a] = p
        return first

    def __iter__(self) -> Iterator[tuple[bytes, int, object]]:
        k = len(self.runs)
        if not k:
            return
        losers = [-1] * k
        # played from the leaves up; the winner of all is kept apart
        winners = [0] * k + list(range(k))
        for node in range(k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], losers[node] = (a, b) if self._beats(a, b) else (b, a)
        top = winners[1] if k > 1 else 0
        while self.heads[top] is not None:
            s, _, payload = self.heads[top]
            yield s, self.known[top], payload
            after = next(self.runs[top], None)
            self.heads[top] = after
            if after is not None:
                self.known[top] = after[1]
            node = (top + k) // 2
            while node:
                other = losers[node]
                if not self._beats(top, other):
                    losers[node], top = top, other
                node //= 2


def repeated_offsets(strings: np.ndarray, prefix: np.ndarray, right: np.ndarray, left: np.ndarray, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Of each suffix, the least and largest offset at which the window around its anchor is repeated; -1 if none.

    strings: rows of a class hash (8 bytes), span bytes from the anchor and span - gram before it backwards, filled up
    with zeros; prefix: common prefix with the row before; right, left: how many of these bytes there are.
    """
    n, most = len(strings), span - gram
    low, high = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    behind = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for o in range(most + 1):
            if o:
                behind = behind * _MULTIPLIER + _BYTE[strings[:, 8 + span + o - 1]]
            fits = np.flatnonzero((left >= o) & (right >= span - o))
            if len(fits) < 2:
                continue
            run = np.cumsum(prefix < 8 + span - o)[fits].astype(np.uint64)
            key = (behind[fits] ^ (behind[fits] >> np.uint64(32))) * np.uint64(0x94D049BB133111EB) + run * np.uint64(0xD6E8FEB86659FD93)
            order = np.argsort(key, kind="stable")
            k = key[order]
            same = np.zeros(len(k), bool)
            same[1:] = k[1:] == k[:-1]
            same[:-1] |= same[1:]
            hit = fits[order[same]]
            high[hit] = o
            fresh_ = hit[low[hit] < 0]
            low[fresh_] = o
    return low, high


Marked = tuple[int, int, bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def each_marked(batches: Iterator[pa.RecordBatch]) -> Iterator[Marked]:
    """(k1, k2, bytes, grams, places, runs, hot) of the rows that have marks; rows that stand for several come twice."""
    for b in batches:
        lists, copies = b.column("marks"), b.column("copies").to_numpy()
        k1, k2, texts = b.column("k1").to_numpy(), b.column("k2").to_numpy(), b.column("packed")
        ends, found = lists.offsets.to_numpy(), lists.values
        h, at, run, hot = (found.field(n).to_numpy(zero_copy_only=False) for n in ("h", "at", "run", "hot"))
        for i in np.flatnonzero(np.diff(ends)).tolist():
            part = slice(ends[i], ends[i + 1])
            for _ in range(min(int(copies[i]), 2)):
                yield int(k1[i]), int(k2[i]), zstandard.decompress(texts[i].as_py()), h[part], at[part], run[part], hot[part]


def repeated_spans(read: DataFrame, texts: DataFrame, span: int = SPAN, gram: int = GRAM, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """k1, k2, start, stop of strings that hold repeated windows; they overlap.

    read and texts are the same rows: (k1, k2, text) as they are read, and packed, dealt out by (k1, k2).
    """
    spark = texts.sparkSession
    parts, reach = partitions(spark), span - gram
    width = 8 + span + reach

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            raw = [t.encode() for t in pdf["text"].array]
            for a, b in _chunks(raw):
                sizes = np.array([len(t) for t in raw[a:b]], np.int64)
                at, h = anchors_of(raw[a], span, gram) if b == a + 1 else anchors(np.frombuffer(b"".join(raw[a:b]), np.uint8), sizes, span, gram)
                if not len(at):
                    continue
                starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
                doc = np.searchsorted(starts, at, "right") - 1
                first, run = runs_of(at, h, doc, reach + 1)
                at, h, doc = at[first], h[first], doc[first]
                # of empty documents at one start, the last one is found, which is the one with bytes
                where = np.flatnonzero(np.diff(doc, prepend=-1))
                of = pdf.iloc[a:b].iloc[doc[where]]
                lists = {"h": h.view(np.int64), "at": (at - starts[doc]).astype(np.int32), "run": run}
                yield pd.DataFrame({"k1": of["k1"].array, "k2": of["k2"].array} | {n: np.split(x, where[1:]) for n, x in lists.items()})

    marked = cut(read.select("k1", "k2", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(mark, "k1 long, k2 long, h array<long>, at array<int>, run array<int>"))
    each = marked.select("k1", "k2", F.explode(F.arrays_zip("h", "at", "run")).alias("x")).select("k1", "k2", "x.h", "x.at", "x.run")
    suffixes = F.col("run").bitwiseAND(F.lit(0xFFFF)).cast("long")
    total = each.agg(F.sum(suffixes)).first()[0] or 0
    # a gram is hot if its suffixes are more than a quarter of a task's share
    usual, hot = repeated(each, "h", max(split_rows, total // (4 * parts)), suffixes)
    wanted = usual.select("k1", "k2", "h", "at", "run", F.lit(False).alias("hot"))
    if hot is not None:
        wanted = wanted.unionByName(hot.select("k1", "k2", "h", "at", "run", F.lit(True).alias("hot")))
    # a set, as equal rows of several batches mark the same places
    of_doc = wanted.groupBy(F.col("k1").alias("w1"), F.col("k2").alias("w2")).agg(F.collect_set(F.struct("h", "at", "run", "hot")).alias("marks"))
    joined = texts.join(of_doc, (F.col("k1") == F.col("w1")) & (F.col("k2") == F.col("w2")), "left").select("id", "k1", "k2", "packed", "copies", "marks")
    receivers = 4 * parts

    def sort_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[bytes, int, int, int, int, int]] = []

        def send() -> Iterator[pa.RecordBatch]:
            rows.sort(key=lambda r: r[0])
            out, a = [], 0
            to = [int.from_bytes(r[0][:8], "big") * receivers >> 64 for r in rows]
            while a < len(rows):
                b = a
                while b < len(rows) and to[b] == to[a]:
                    b += 1
                blob = zstandard.compress(front_code([r[0] for r in rows[a:b]]), 3)
                out.append((to[a], b - a, blob, zstandard.compress(np.array([r[1:] for r in rows[a:b]], np.int64).T.tobytes(), 3)))
                a = b
            rows.clear()
            if out:
                columns = [pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["receiver", "n", "blob", "places"])

        for k1, k2, raw, hs, places, runs, hots in each_marked(batches):
            # anchors have the smallest hashes of their windows, so these are mixed anew to spread over the receivers
            for h, first, run, is_hot in zip((hs.view(np.uint64) * np.uint64(SPREAD)).tolist(), places.tolist(), runs.tolist(), hots.tolist(), strict=True):
                if is_hot:
                    continue
                for at in range(first, first + (run >> 16) * (run & 0xFFFF), run >> 16):
                    r, b = raw[at : at + span], raw[max(0, at - reach) : at][::-1]
                    rows.append((h.to_bytes(8, "big") + r.ljust(span, b"\0") + b.ljust(reach, b"\0"), k1, k2, at, len(r), len(b)))
                    if len(rows) >= RUN_ROWS:
                        yield from send()
        yield from send()

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        def run(n: int, blob: bytes, places: bytes) -> Iterator[tuple[bytes, int, object]]:
            values = np.frombuffer(zstandard.decompress(places), np.int64).reshape(5, n).T.tolist()
            for (s, p), v in zip(front_decode(zstandard.decompress(blob), n), values, strict=True):
                yield s, p, v

        runs = [run(*r) for r in pdf[["n", "blob", "places"]].itertuples(index=False, name=None)]
        out: list[pd.DataFrame] = []
        rows: list[bytes] = []
        prefix: list[int] = []
        values: list[tuple[int, int, int, int, int]] = []

        def judge() -> None:
            if rows:
                v = np.array(values, np.int64)
                low, high = repeated_offsets(np.frombuffer(b"".join(rows), np.uint8).reshape(-1, width), np.array(prefix), v[:, 3], v[:, 4], span, gram)
                hit = low >= 0
                out.append(pd.DataFrame({"k1": v[hit, 0], "k2": v[hit, 1], "start": v[hit, 2] - high[hit], "stop": v[hit, 2] + span - low[hit]}))
            rows.clear(), prefix.clear(), values.clear()

        for s, p, v in LoserTree(runs):
            if p < 8 and len(rows) >= JUDGED_ROWS:  # a class is never cut
                judge()
            rows.append(s), prefix.append(p), values.append(v)
        judge()
        return pd.concat(out) if out else pd.DataFrame({"k1": [], "k2": [], "start": [], "stop": []}, dtype="int64")

    found = joined.mapInArrow(sort_out, "receiver int, n int, blob binary, places binary").repartition(receivers, "receiver").groupBy("receiver").applyInPandas(merge, "k1 long, k2 long, start long, stop long")
    if hot is None:
        return found

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["k1", "k2", "start", "stop", "key", "n"]
        for k1, k2, raw, _, places, runs, hots in each_marked(batches):
            if not hots.any():
                continue
            at, run = places[hots].astype(np.int64), runs[hots].astype(np.int64)
            # the anchors of a run are so near that the windows around them leave no gap
            low, high = merged(np.maximum(at - reach, 0), np.minimum(at + (run >> 16) * ((run & 0xFFFF) - 1), len(raw) - span) + 1)
            for lo, hi in ((x, min(y, x + WINDOWS)) for x0, y in zip(low.tolist(), high.tolist(), strict=True) for x in range(x0, y, WINDOWS)):
                keys = np.fromiter((xxhash.xxh3_64_intdigest(raw[i : i + span]) for i in range(lo, hi)), np.uint64, hi - lo).view(np.int64)
                own, first, which, n = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
                again = lo + np.flatnonzero(n[which] > 1)  # repeated in this text already
                x, y = merged(again, again + span) if len(again) else (again, again)
                none = pa.nulls(len(x), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), k1)), pa.array(np.full(len(x), k2)), pa.array(x), pa.array(y), none, none], names=names)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (np.full(len(own), k1), np.full(len(own), k2), lo + first, lo + first + span, own, n)], names=names)

    # the windows around hot grams are too many for one receiver: each is a key of its own, that a text sends once; those
    # that a text itself repeats are sent as the intervals they cover
    told = joined.mapInArrow(windows, "k1 long, k2 long, start long, stop long, key long, n long")
    key = F.col("key").bitwiseXOR(F.lit(DERIVED))  # so that adaptive execution can split a hot key
    many = told.where(F.col("key").isNotNull()).groupBy(key.alias("many_key")).agg(F.sum("n").alias("many")).where("many > 1")
    both = told.withColumn("own_key", F.coalesce(key, F.xxhash64("k1", "k2", "start"))).join(many, F.col("own_key") == F.col("many_key"), "left")
    return found.unionByName(both.where("key IS NULL OR many_key IS NOT NULL").select("k1", "k2", "start", "stop"))


def remove_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", split_rows: int = SPLIT_ROWS) -> DataFrame:
    """doc_id, n_bytes, spans (array of start and stop, maximal removed runs), kept (binary), for every row of docs.

    Texts are their UTF-8 bytes, null counts as empty. A byte goes if it lies in a string of span bytes that also
    starts anywhere else, in the same document or another; overlaps count, and the input decides, not what is left.
    Texts shorter than span lose nothing. What is kept may not be valid UTF-8. Every row counts for itself, whether it
    has an identifier of its own, one that other rows have, or none; rows equal in identifier and text are copies of
    each other like any copies. A text's marks are gathered in its row: a few for each span bytes, and one run for each
    65,535 repetitions in a text that repeats one string. An empty table gives an empty result; other columns of docs
    play no part.
    """
    ident, text = docs[f"`{id_col}`"].cast("long"), docs[f"`{text_col}`"].cast("string")
    k1, k2 = row_keys(ident, text)
    read = docs.select(ident.alias("id"), k1.alias("k1"), k2.alias("k2"), F.coalesce(text, F.lit("")).alias("text"))
    # packed for the way, as it is the one thing as large as the input; both joins below read the same exchange
    texts = packed(read, merge=True).repartition(partitions(docs.sparkSession), "k1", "k2")
    spans = repeated_spans(read, texts, span, gram, split_rows)
    of_doc = spans.groupBy(F.col("k1").alias("s1"), F.col("k2").alias("s2")).agg(F.collect_list(F.struct("start", "stop")).alias("found"))
    joined = texts.join(of_doc, (F.col("k1") == F.col("s1")) & (F.col("k2") == F.col("s2")), "left").select("id", "k1", "k2", "packed", "copies", "found")

    def clear(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for packed_text, found in zip(b.column("packed").to_pylist(), b.column("found").to_pylist(), strict=True):
                raw, runs = zstandard.decompress(packed_text), []
                for start, stop in sorted((f["start"], f["stop"]) for f in found or ()):
                    stop = min(stop, len(raw))
                    if runs and start <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], stop)
                    elif start < stop:
                        runs.append([start, stop])
                edges = [0, *(x for r in runs for x in r), len(raw)]
                kept = b"".join(raw[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2))
                rows.append((len(raw), [{"start": x, "stop": y} for x, y in runs], kept))
            n, removed, left = zip(*rows, strict=True) if rows else ((), (), ())
            span_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            out = pa.RecordBatch.from_arrays([b.column("id"), pa.array(n, pa.int64()), pa.array(removed, span_type), pa.array(left, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])
            yield out.take(pa.array(np.repeat(np.arange(b.num_rows), b.column("copies").to_numpy())))

    return joined.mapInArrow(clear, "doc_id long, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary")
