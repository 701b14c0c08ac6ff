"""Importance resampling towards a target's distribution of hashed word n-grams.

Bucket counts of the corpus and of the target give each bucket a gain; a document's weight is the sum over its
features, taken from the gains as an array. With a Gumbel variate added, the highest scores are a draw without
replacement by weight. How high a score must be is found by bisection: jobs count the rows beyond a threshold in the
written scores, then, among rows of the threshold's score, those below an identifier. The selected rows alone are
dealt out by range and numbered.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, partitions

BUCKETS, LONGEST = 10_000, 3
#: Halvings of the bisection that one counting job decides: it counts at 2 ** HALVINGS - 1 thresholds.
HALVINGS = 5
#: Bytes from which a word counts as long: its checksum isn't remembered. Words a worker remembers. Words hashed at a time.
LONG_WORD, WORD_ENTRIES, STEP_WORDS = 64, 500_000, 1_000_000
#: Bytes of a text that are split into words at a time.
STEP_BYTES = 4_000_000
#: What each byte becomes: A to Z small letters, other bytes between words (below 0x80: all but digits and letters) a space.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def _byte_table() -> np.ndarray:
    """What a checksum's lowest byte turns into when a zero byte follows (CRC-32 as in zlib, reflected)."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


def _then(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map of checksums, given for each of their four bytes, applied to crc."""
    return tables[0][crc & 255] ^ tables[1][crc >> 8 & 255] ^ tables[2][crc >> 16 & 255] ^ tables[3][crc >> 24]


class Shift:
    """Checksums as they count once so many more bytes follow: crc(a + b) = shift(crc(a), len(b)) ^ crc(b)."""

    def __init__(self):
        one, byte = _byte_table(), np.arange(256, dtype=np.uint32)
        step = lambda x: (x >> np.uint32(8)) ^ one[x & 255]
        start = np.stack([byte << np.uint32(8 * k) for k in range(4)])
        tables = [start]
        for _ in range(LONG_WORD):
            tables.append(step(tables[-1]))
        self.short = np.stack(tables, axis=1)  # byte, length, value
        self.powers = [tables[1]]  # by 1, 2, 4, ... bytes
        for _ in range(31):
            self.powers.append(_then(self.powers[-1], self.powers[-1]))

    def __call__(self, crc: np.ndarray, size: np.ndarray) -> np.ndarray:
        small, s = np.minimum(size, LONG_WORD), self.short
        out = s[0, small, crc & 255] ^ s[1, small, crc >> 8 & 255] ^ s[2, small, crc >> 16 & 255] ^ s[3, small, crc >> 24]
        rest = np.flatnonzero(size > LONG_WORD)
        for k in range(32):
            on = rest[(size[rest] - LONG_WORD) >> k & 1 == 1]
            if len(on):
                out[on] = _then(self.powers[k], out[on])
        return out


class _Sums(dict):
    """Checksums of a word (low half) and of a space and the word (high half)."""

    def __missing__(self, word: bytes) -> int:
        both = zlib.crc32(word) | zlib.crc32(word, zlib.crc32(b" ")) << 32
        if len(word) < LONG_WORD:
            if len(self) >= WORD_ENTRIES:
                self.clear()
            self[word] = both
        return both


class Featurizer:
    """The buckets of a text's runs of one to three words."""

    def __init__(self):
        self.shift, self.sums = Shift(), _Sums()

    def words(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Both checksums and the length in bytes of each word of text."""
        raw, sums, sizes, lo = text.encode().translate(WORD_BYTES), [], [], 0
        while lo < len(raw):
            hi = raw.find(b" ", lo + STEP_BYTES) if len(raw) - lo > STEP_BYTES else len(raw)
            hi = len(raw) if hi < 0 else hi
            found = raw[lo:hi].split()
            sums.append(np.fromiter(map(self.sums.__getitem__, found), np.uint64, len(found)))
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
            lo = hi
        return (np.concatenate(sums), np.concatenate(sizes)) if sums else (np.zeros(0, np.uint64), np.zeros(0, np.int64))

    def buckets(self, texts: list[str], buckets: int, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Buckets of all features of texts, and the text that each is of; in several parts."""
        each = [self.words(t) for t in texts]
        counts = np.array([len(s) for s, _ in each], np.int64)
        if not counts.sum():
            return
        sums, sizes = (np.concatenate([e[k] for e in each]) for k in (0, 1))
        of = np.repeat(np.arange(len(texts)), counts)
        place = np.arange(len(sums)) - np.repeat(np.cumsum(counts) - counts, counts)  # of a word in its text
        for at in range(0, len(sums), STEP_WORDS):
            lo, hi = max(0, at - longest + 1), min(len(sums), at + STEP_WORDS)
            alone, spaced = (sums[lo:hi] & np.uint64(0xFFFFFFFF)).astype(np.uint32), (sums[lo:hi] >> np.uint64(32)).astype(np.uint32)
            run, size = alone, sizes[lo:hi] + 1
            for n in range(longest):
                if n:  # run[k] ends at word k + n - 1; the next word joins it
                    run = self.shift(run[:-1], size[n:]) ^ spaced[n:]
                ends = np.arange(lo + n, hi)
                whole = (place[ends] >= n) & (ends >= at)
                yield run[whole] % np.uint32(buckets), of[ends[whole]]


_FEATURIZER: list[Featurizer] = []


def featurizer() -> Featurizer:
    """The worker's featurizer: the words it remembers serve all its tasks."""
    if not _FEATURIZER:
        _FEATURIZER.append(Featurizer())
    return _FEATURIZER[0]


def runs(texts: list[str], most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about so many characters each, or one text."""
    lo, held = 0, 0
    for k, t in enumerate(texts):
        if held and held + len(t) > most:
            yield lo, k
            lo, held = k, 0
        held += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """bucket and n of the features of texts (a column t without nulls); a task sends one row for each bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            held = b.column("t").to_pylist()
            for lo, hi in runs(held):
                for found, _ in featurizer().buckets(held[lo:hi], buckets, longest):
                    total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    return texts.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """For each bucket floor(1000 ln of target share over corpus share), with one more of each counted."""
    k, s, t = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((y + 1.0) * (s + k) / ((x + 1.0) * (t + k)))) for x, y in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """doc_id, n_features, n_words and weight of docs (i, t), by the gains of their features' buckets."""
    fields = f"doc_id {docs.schema['i'].dataType.simpleString()}, n_features long, n_words long, weight long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = featurizer()
        for b in batches:
            held = b.column("t").to_pylist()
            out = np.zeros((3, len(held)), np.int64)
            for lo, hi in runs(held):
                for step, (found, of) in enumerate(made.buckets(held[lo:hi], len(gain), longest)):
                    count = np.bincount(of, minlength=hi - lo)
                    out[0, lo:hi] += count
                    if step % longest == 0:
                        out[1, lo:hi] += count
                    np.add.at(out[2, lo:hi], of, gain[found])
            yield pa.RecordBatch.from_arrays([b.column("i"), *[pa.array(x, pa.int64()) for x in out]], names=["doc_id", "n_features", "n_words", "weight"])

    return docs.mapInArrow(run, fields)


def least_reaching(rows: DataFrame, key: Column, need: int, lo: int, hi: int) -> int:
    """The least v in lo..hi for which need of rows have key <= v; all of them have key <= hi, and need is at least 1.

    Each job counts rows at thresholds that part the range evenly, and so decides HALVINGS halvings.
    """
    while lo < hi:
        at = sorted({lo + (hi - lo) * k // (1 << HALVINGS) for k in range(1, 1 << HALVINGS)} | {lo} - {hi})
        found = rows.agg(*[F.count(F.when(key <= v, 1)).alias(f"n{k}") for k, v in enumerate(at)]).first()
        lo, hi = next(((at[k - 1] + 1 if k else lo, v) for k, v in enumerate(at) if found[k] >= need), (at[-1] + 1, hi))
    return lo


def first_rows(rows: DataFrame, keys: list[Column], need: int) -> Column:
    """The condition that need of rows meet, those first by keys (integers; together they tell rows apart)."""
    taken, tied = [], F.lit(True)
    for key in keys:
        here = rows.where(tied)
        lo, hi, n = here.agg(F.min(key), F.max(key), F.count(key)).first()
        if need == 0 or n <= need:
            break
        v = least_reaching(here, key, need, lo, hi)
        need -= here.where(key < v).count()
        taken.append(tied & (key < v))
        tied &= key == v
    return reduce(lambda x, y: x | y, taken, tied) if need else reduce(lambda x, y: x | y, taken, F.lit(False))


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """rows with their rank by order in the column name: dealt out by range and sorted, so that the range's number and
    the place in it tell the rank once the ranges before are counted."""
    placed = cut(rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order).withColumn("placed", F.monotonically_increasing_id()))
    part = F.shiftright("placed", 33).cast("int")
    sizes = {r[0]: r[1] for r in placed.groupBy(part.alias("part")).count().collect()}  # a row for each partition
    before, seen = [], 0
    for p in range(max(sizes, default=-1) + 1):
        before.append(seen)
        seen += sizes.get(p, 0)
    if not before:
        return placed.withColumn(name, F.lit(None).cast("long")).drop("placed")
    offset = F.element_at(F.array(*[F.lit(x).cast("long") for x in before]), part + 1)
    return placed.withColumn(name, offset + F.col("placed").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("placed")


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, buckets: int = BUCKETS, longest: int = LONGEST, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """doc_id, n_features, n_words, weight, score and rank of every row of docs; rank counts the drawn ones from 1.

    Of the rows with at least min_words words floor(percent / 100 of them) are drawn: the highest scores, ties to the
    smaller identifier, null last. The variate added to a weight is drawn from seed and identifier, so rows of equal
    identifier get the same one (a null identifier as if it had no characters); of rows equal in score and identifier
    any may be drawn, each for itself. A text without words, null or empty, has no features and weight 0; texts are
    read whole; an empty docs gives an empty result, an empty target counts no feature. Other columns play no part,
    whatever their names. docs is read twice, target once; buckets gains (bounded) are with every task.
    """
    source = docs.select(F.col(f"`{id_col}`").alias("i"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("t"))
    counts = []
    for texts in (source.select("t"), target.select(F.coalesce(F.col(f"`{target_col}`").cast("string"), F.lit("")).alias("t"))):
        held = np.zeros(buckets, np.int64)
        for r in bucket_counts(texts, buckets, longest).collect():  # a row for each bucket
            held[r[0]] = r[1]
        counts.append(held)
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), ident), 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")
    scored = weights(source, gains(*counts), longest).withColumn("score", F.col("weight") + gumbel)
    scored = cut(scored.withColumn("row", F.monotonically_increasing_id()))
    able = scored.where(F.col("n_words") >= min_words)
    need = able.count() * percent // 100
    by = [-F.col("score"), F.col("doc_id").isNull().cast("int"), F.coalesce("doc_id", F.lit(0)), F.col("row")]
    drawn = (F.col("n_words") >= min_words) & first_rows(able, by, need) if need else F.lit(False)
    ranked = numbered(scored.where(drawn), [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")], "rank")
    return ranked.unionByName(scored.where(~drawn).withColumn("rank", F.lit(None).cast("long"))).drop("row")
