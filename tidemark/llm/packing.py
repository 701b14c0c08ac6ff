"""Packing of tokenised documents into fixed-length sequences: first-fit decreasing with a tournament tree.

Documents are dealt into randomised groups of bounded size. In each group the pieces, largest first, go to the first
sequence with room; a tournament tree over the sequences' remaining capacities finds it in logarithmic time.
"""

from __future__ import annotations

import os
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import partitions, slices

#: Mean number of documents in a packing group.
GROUP_DOCS = 4096
#: Words, and pieces of text between white space, whose ids a worker remembers in each of two generations.
WORD_ENTRIES, CHUNK_ENTRIES = 300_000, 120_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
#: The column that tells repeated rows apart: how many equal ones the task met before.
NTH = ", nth long"
#: Characters of a word from which it counts as long.
LONG_WORD = 64
#: Characters that Python takes for white space and the tokenizer doesn't.
_SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")


class _Remembered(dict):
    """A bounded cache in two generations: a full one becomes the old one, whose entries move up when asked for."""

    def __init__(self, make, make_long, entries: int):
        super().__init__()
        self.make, self.make_long, self.entries, self.old = make, make_long, entries, {}

    def __missing__(self, key: str) -> bytes:
        if len(key) > LONG_WORD:  # rare, and not kept
            return self.make_long(key)
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def merges_only(model: dict) -> bool:
    """Whether a BPE model of the file is one that Merger reads."""
    plain = ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
    return model["type"] == "BPE" and bool(model["end_of_word_suffix"]) and not any(model.get(k) for k in plain)


class Merger:
    """The file's merges applied to one word: the pair of lowest rank first, of equal ones the leftmost.

    The library does the same, at a cost that new words would dominate here; long words are left to it.
    """

    def __init__(self, model: dict):
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        # how byte-level vocabularies write a byte: itself if printable, else the next character from 256 on
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        char = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(printable)))}
        self.inner, self.last = [vocab[char[b]] for b in range(256)], [vocab[char[b] + end] for b in range(256)]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {(vocab[a], vocab[b]): rank << 20 | vocab[a + b] for rank, (a, b) in enumerate(pairs)}

    def ids(self, word: str) -> bytes:
        raw, rank, none = word.encode(), self.rank.get, 1 << 60
        ids = [self.inner[b] for b in raw]
        ids[-1] = self.last[raw[-1]]
        ranks = [rank(p, none) for p in zip(ids, ids[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i, new = ranks.index(best), best & 0xFFFFF
            ids[i] = new
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank((new, ids[i + 1]), none)
            if i:
                ranks[i - 1] = rank((ids[i - 1], new), none)
        return struct.pack(f"<{len(ids)}I", *ids)


class WordTokenizer:
    """The ids of a word-level BPE tokenizer file, as little-endian unsigned 32-bit numbers, with remembered words.

    The file's own normaliser and splitting pattern define the words, which never hold white space; the library
    encodes each new word once. Texts that hold one of the file's special tokens go to the library whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import json

        import regex
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        steps = [x["type"] for x in spec["normalizer"]["normalizers"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if steps != ["NFC", "Replace", "Lowercase"] or split["type"] != "Split" or not split["invert"]:
            raise ValueError(f"{path} is not a tokenizer of lower-case words")
        self.words = regex.compile(split["pattern"]["Regex"]).findall
        self.of_word = _Remembered(Merger(spec["model"]).ids if merges_only(spec["model"]) else self.encode, self.encode, WORD_ENTRIES)
        self.of_chunk = _Remembered(self.chunk, self.chunk, CHUNK_ENTRIES)

    def encode(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def chunk(self, chunk: str) -> bytes:
        """The ids of a piece of text without white space; most are a word, or a word and a mark."""
        if chunk.isalpha():
            return self.of_word[chunk]
        if chunk[-1] in ".,;:!?" and chunk[:-1].isalpha():
            return self.of_word[chunk[:-1]] + self.of_word[chunk[-1]]
        return b"".join(map(self.of_word.__getitem__, self.words(chunk)))

    def normal(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        if "Σ" in text or not unicodedata.is_normalized("NFC", text):
            return self.whole.normalizer.normalize_str(text)
        return text.lower()

    def ids(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self.encode(text)
        plain = self.normal(text)
        if any(c in plain for c in _SEPARATORS):
            return b"".join(map(self.of_word.__getitem__, self.words(plain)))
        return b"".join(map(self.of_chunk.__getitem__, plain.split()))


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """The worker's tokenizer of this file: what it remembers serves all tasks of the worker."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def tokenised_pieces(docs: DataFrame, tokenizer_path: str, sequence_tokens: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's ids and end_id, cut into pieces of at most sequence_tokens: doc_id, start, length, ids_crc32, doc_tokens,
    and nth, which counts the rows of equal identifier and ids within a task; so it doesn't depend on their order.

    A null or empty text has the one id end_id.
    """

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, end = tokenizer(tokenizer_path), np.array([end_id], "<u4").tobytes()
        met: dict[tuple[int | None, int, int], int] = {}
        for b in slices(batches):
            rows = []
            for row, (ident, text) in enumerate(zip(b.column("i").to_pylist(), b.column("t").to_pylist(), strict=True)):
                ids = tok.ids(text) + end
                n = len(ids) // 4
                same = (ident, zlib.crc32(ids), n)
                nth = met[same] = met.get(same, -1) + 1
                for at in range(0, n, sequence_tokens):
                    part = ids[4 * at : 4 * (at + sequence_tokens)]
                    rows.append((row, at, len(part) // 4, zlib.crc32(part), n, nth))
            of, *made = [pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * 6)]
            yield pa.RecordBatch.from_arrays([b.column("i").take(of), *made], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "nth"])

    return docs.select(docs[f"`{id_col}`"].cast("long").alias("i"), F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit("")).alias("t")).mapInArrow(cut_up, PIECES + NTH)


class FirstFit:
    """Bins of one size; place() returns the first bin with room and the room's offset.

    A tournament tree: each inner node holds the largest remaining capacity below it.
    """

    def __init__(self, size: int, most_bins: int):
        self.size, self.leaves = size, 1 << max(0, (most_bins - 1).bit_length())
        self.best = [size] * (2 * self.leaves)

    def place(self, length: int) -> tuple[int, int]:
        best, node = self.best, 1
        while node < self.leaves:
            node *= 2
            if best[node] < length:
                node += 1
        left = best[node]
        bin_, offset = node - self.leaves, self.size - left
        best[node] = left - length
        node //= 2
        while node:
            a, b = best[2 * node], best[2 * node + 1]
            top = a if a >= b else b
            if best[node] == top:
                break
            best[node] = top
            node //= 2
        return bin_, offset


def first_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length; lengths are at most size and come in any order."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    fit = FirstFit(size, max(1, len(lengths)))
    for i in order.tolist():
        bins[i], offsets[i] = fit.place(int(lengths[i]))
    return bins, offsets


def pack(docs: DataFrame, tokenizer_path: str, sequence_tokens: int = 4096, end_id: int = 2, group_docs: int = GROUP_DOCS, seed: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Sequences hold at most sequence_tokens ids, offsets are gapless from 0. Every id of every document lies in
    exactly one piece; documents of more than sequence_tokens ids are cut, others stay whole. Repeated rows are packed
    each for itself, rows without an identifier as well; null and empty texts give one piece of one id, very long ones
    as many pieces as they need; an empty table gives an empty result. Other columns of docs play no part, whatever their names.
    """
    spark = docs.sparkSession
    n = docs.count()
    groups = max(1, -(-n // group_docs))
    pieces = tokenised_pieces(docs, tokenizer_path, sequence_tokens, end_id, id_col, text_col)
    # rows without an identifier are dealt out by content, and equal rows by their number, so that no group grows with them
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("ids_crc32", "doc_tokens", F.lit(seed))).otherwise(F.xxhash64("doc_id", F.lit(seed)))
    key = F.when(F.col("nth") > 0, F.xxhash64(key, "nth")).otherwise(key)
    pieces = pieces.withColumn("grp", F.pmod(key, F.lit(groups))).drop("nth")

    def fill(found: pa.Table) -> pa.Table:
        found = found.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        bins, offsets = first_fit_decreasing(found.column("length").to_numpy(), sequence_tokens)
        sequence = found.column("grp").to_numpy() * (1 << 32) + bins
        return found.drop_columns(["grp"]).append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))

    return pieces.repartition(max(1, min(groups, 4 * partitions(spark))), "grp").groupBy("grp").applyInArrow(fill, PIECES + ", sequence_id long, offset long")
