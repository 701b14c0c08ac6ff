"""Byte-level BPE by a global shuffle of distinct words, and decoding by a join with the table of token bytes.

Documents are gathered into blocks. A block lists each of its pre-tokens ("words") once and holds, for every position
of its documents, the word's place in the list. The lists are exchanged by the words' hash, as a packed row for each
block and bucket of words; the task that gets a bucket encodes each of its distinct words once. The ids go back to the
blocks that asked, where the documents' ids are put together by position.

A block asks for a word once, however often it holds it, so a word that makes up a third of all text is no hot key.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import partitions

#: Characters of text from which a block is full; a single longer text is a block of its own.
BLOCK_CHARS = 8_000_000
#: Words whose ids a task that encodes remembers in each of two generations; beyond that a word may be encoded again.
WORD_ENTRIES = 1_000_000
#: Words of a block that have codes of one byte.
SHORT_CODES = 255
#: Tokens that one step of decoding joins at a time.
STEP_TOKENS = 4_000_000
#: The characters of Unicode's White_Space property, which `\s` of the pattern stands for.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places starts[i], starts[i] + 1, ... of lengths[i] each, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a rank file: a line for each, its bytes in base 64 and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Splitter:
    """Cuts a text into the matches of a pre-token pattern, as the library that encodes does.

    A white-space character after another character always begins a match, whatever surrounds it: no match but one of
    white space alone holds white space after its first character. So a text falls into chunks (white space, then
    other characters) which are cut each for itself, and equal chunks alike.
    """

    def __init__(self, pattern: str):
        import regex
        import tiktoken

        self.chunks = re.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+").findall
        self.found = regex.compile(pattern)
        # merges only `a` or `1` with one byte more, so that its answer shows whether a character joins these
        probe = {bytes([b]): b for b in range(256)} | {bytes([a, b]): 256 * k + b for k, a in ((1, ord("a")), (2, ord("1"))) for b in range(256)}
        self.probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=probe, special_tokens={}).encode_ordinary
        self.stand_in: dict[str, str] = {}

    def like(self, char: str) -> str:
        """A character of the same class. Tables of Unicode differ in age between libraries; they agree on characters
        that Python's own table knows, for others the encoding library is asked."""
        if char not in self.stand_in:
            n = len(char.encode())
            self.stand_in[char] = next((a for a in "a1" if len(self.probe(a + char)) == n), "!") if unicodedata.category(char) == "Cn" else char
        return self.stand_in[char]

    def words(self, chunk: str) -> list[str]:
        if chunk[1:].isascii() and chunk[1:].isalpha() and chunk[0] == " ":
            return [chunk]
        known = chunk if chunk.isascii() else "".join(map(self.like, chunk))
        return [chunk[m.start() : m.end()] for m in self.found.finditer(known)]


_LOADED: dict[tuple, object] = {}


def loaded(make, *args):
    """make(*args), kept by the worker for its later tasks: a splitter, an encoder or a token table."""
    key = (make, *args)
    if key not in _LOADED:
        _LOADED[key] = make(*args)
    return _LOADED[key]


def encoder(ranks_path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(ranks_path), special_tokens={}).encode_ordinary


class _Block:
    """Documents gathered so far: each chunk of text is numbered when it first occurs."""

    def __init__(self):
        self.ids, self.codes, self.chars = [], [], 0
        self.numbers: defaultdict[str, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__

    def add(self, ident, text: str, splitter: Splitter) -> None:
        self.ids.append(ident)
        self.codes.append(np.array([*map(self.numbers.__getitem__, splitter.chunks(text))], np.uint32))
        self.chars += len(text)

    def row(self, splitter: Splitter, number: int, buckets: int) -> tuple:
        """block, words by bucket (packed), codes of all documents (packed), identifiers, words of each document."""
        of_word: defaultdict[str, int] = defaultdict()
        of_word.default_factory = of_word.__len__
        parts = [[of_word[w] for w in splitter.words(chunk)] for chunk in self.numbers]
        lengths = np.array([len(p) for p in parts], np.int64)
        flat = np.array([w for p in parts for w in p], np.int64)
        starts = np.cumsum(lengths) - lengths
        chunk_of = np.concatenate([*self.codes, np.zeros(0, np.uint32)])
        sizes = [int(lengths[c].sum()) for c in self.codes]
        codes = flat[ragged(starts[chunk_of], lengths[chunk_of])] if len(chunk_of) else flat[:0]
        # codes by frequency: most positions then take a byte
        order = np.argsort(-np.bincount(codes, minlength=len(of_word)), kind="stable")
        code = np.empty(len(order), np.int64)
        code[order] = np.arange(len(order))
        raw = [w.encode() for w in of_word]
        bucket = np.array([xxhash.xxh32_intdigest(w) % buckets for w in raw], np.int64)
        listed: list[list[tuple[bytes, int]]] = [[] for _ in range(buckets)]
        for word, k, c in zip(raw, bucket.tolist(), code.tolist(), strict=True):
            listed[k].append((word, c))
        for part in listed:
            part.sort()
        words = [pack_words([w for w, _ in part]) if part else None for part in listed]
        place = np.array([c for part in listed for _, c in part], np.int64)  # the code of each listed word
        body = pack_numbers(code[codes]) + pack_numbers(place)
        mark = xxhash.xxh64(f"{number}\n{len(raw)}\n".encode() + body[0] + body[-1])
        for x in words:
            mark.update(x or b"-")
        return mark.intdigest() - (1 << 63), words, body, self.ids, sizes


def pack_numbers(x: np.ndarray) -> list[bytes]:
    """Numbers from 0 to 2 ** 24 or so: one byte each, and two planes of bytes and a rest for those of SHORT_CODES or more."""
    pack = zstandard.ZstdCompressor(level=3).compress
    long = x[x >= SHORT_CODES] - SHORT_CODES
    parts = [np.minimum(x, SHORT_CODES).astype(np.uint8), (long & 255).astype(np.uint8), (long >> 8 & 255).astype(np.uint8), (long >> 16).astype("<u4")]
    return [pack(p.tobytes()) for p in parts]


def unpack_numbers(packed: list[bytes]) -> np.ndarray:
    one, low, middle, high = (np.frombuffer(zstandard.ZstdDecompressor().decompress(p), t) for p, t in zip(packed, (np.uint8, np.uint8, np.uint8, "<u4"), strict=True))
    out = one.astype(np.int64)
    out[one == SHORT_CODES] = SHORT_CODES + low.astype(np.int64) + (middle.astype(np.int64) << 8) + (high.astype(np.int64) << 16)
    return out


def pack_words(words: list[bytes]) -> bytes:
    """Sorted words, each as what differs from the one before."""
    shared, tails, last = [], [], b""
    for w in words:
        n, most = 0, min(len(w), len(last), 255)
        while n < most and w[n] == last[n]:
            n += 1
        shared.append(n)
        tails.append(w[n:])
        last = w
    head = np.array([len(words)], "<u4").tobytes() + bytes(shared) + np.array([*map(len, tails)], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(tails))


def unpack_words(packed: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    n = int.from_bytes(raw[:4], "little")
    shared, sizes, at = raw[4 : 4 + n], np.frombuffer(raw, "<u4", n, 4 + n).tolist(), 4 + 5 * n
    out, last = [], b""
    for k, size in zip(shared, sizes, strict=True):
        last = last[:k] + raw[at : at + size]
        at += size
        out.append(last)
    return out


def blocks(docs: DataFrame, pattern: str, buckets: int, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """docs (with i and t) as blocks: block, words (a packed list for each bucket), codes, ids, sizes."""
    ident = docs.schema["i"].dataType
    binaries = T.ArrayType(T.BinaryType())
    fields = [("block", T.LongType()), ("words", binaries), ("codes", binaries), ("ids", T.ArrayType(ident)), ("sizes", T.ArrayType(T.LongType()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, number, kind = loaded(Splitter, pattern), TaskContext.get().partitionId() << 32, None

        def emit(b: _Block) -> pa.RecordBatch:
            block, words, body, ids, sizes = b.row(splitter, number, buckets)
            arrays = [pa.array([block], pa.int64()), pa.array([words], pa.list_(pa.binary())), pa.array([body], pa.list_(pa.binary())), pa.array([ids], pa.list_(kind)), pa.array([sizes], pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in fields])

        held = _Block()
        for b in batches:
            kind = b.column("i").type
            for ident_, text in zip(b.column("i").to_pylist(), b.column("t"), strict=True):
                text = text.as_py()
                if held.ids and held.chars + len(text) > block_chars:
                    yield emit(held)
                    held, number = _Block(), number + 1
                held.add(ident_, text, splitter)
        if held.ids:
            yield emit(held)

    return docs.mapInArrow(run, T.StructType([T.StructField(n, t) for n, t in fields]))


def asked(packed: DataFrame) -> DataFrame:
    """What blocks ask for: block, bucket, words (packed). Takes every column, so that the blocks' exchange serves this
    and the putting together alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, words in zip(b.column("block"), b.column("words"), strict=True):
                bucket = np.flatnonzero(words.values.is_valid().to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([pa.repeat(block, len(bucket)), pa.array(bucket, pa.int32()), words.values.take(pa.array(bucket))], names=["block", "bucket", "words"])

    return packed.mapInArrow(run, "block long, bucket int, words binary")


class _Ids(dict):
    """The ids of words, in two generations: a full one becomes the old one, whose entries move up when asked for."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.old = encode, {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = np.array(self.encode(word.decode()), "<u4").tobytes()
        if len(self) >= WORD_ENTRIES:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids


def answered(words: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """block, bucket, and for the words asked for how many ids each has (sizes) and these (ids), packed. All rows of a
    bucket are in one task, which encodes each distinct word once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Ids(loaded(encoder, ranks_path, pattern))
        for b in batches:
            sizes, ids = [], []
            for packed in b.column("words").to_pylist():
                found = [known[w] for w in unpack_words(packed)]
                sizes.append(pack_numbers(np.array([len(x) // 4 for x in found], np.int64)))
                ids.append(pack_numbers(np.frombuffer(b"".join(found), "<u4").astype(np.int64)))
            kind = pa.list_(pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("block"), b.column("bucket"), pa.array(sizes, kind), pa.array(ids, kind)], names=["block", "bucket", "sizes", "ids"])

    return words.mapInArrow(run, "block long, bucket int, sizes array<binary>, ids array<binary>")


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row for each row of docs: its identifier (named id_col), n_tokens, and ids (little-endian unsigned 32-bit).

    ids are those of the rank file for each match of pattern separately, without special tokens (their names in a text
    are plain text). A null text counts as empty and has no ids; repeated rows and rows without an identifier are
    encoded each for itself; texts of any length stay whole; an empty table gives an empty result. Other columns of
    docs play no part, whatever their names.

    docs is read once. Where a lost executor makes Spark read it again, its rows must come in the same order within a
    partition, as those of files and written tables do; a block whose words don't match what was asked for it raises
    an error rather than give wrong ids.
    """
    source = docs.select(F.col(f"`{id_col}`").alias("i"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("t"))
    n = partitions(docs.sparkSession)
    held = blocks(source, pattern, n, block_chars).repartition(n, "block")
    back = answered(asked(held).repartition(n, "bucket"), ranks_path, pattern)
    result = T.StructType([T.StructField(id_col, source.schema["i"].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def together(own: pa.Table, told: pa.Table) -> pa.Table:
        told = told.sort_by("bucket")
        sizes, flat = ([unpack_numbers(x) for x in told.column(c).to_pylist()] for c in ("sizes", "ids"))
        sizes, flat = np.concatenate([*sizes, np.zeros(0, np.int64)]), np.concatenate([*flat, np.zeros(0, np.int64)]).astype("<u4")
        idents, counts, made = [], [], []
        for row in range(own.num_rows):  # one, as blocks are told apart by what they hold
            packed = own.column("codes")[row].as_py()
            codes, place = unpack_numbers(packed[:4]), unpack_numbers(packed[4:])
            if len(place) != len(sizes):
                raise RuntimeError("a block was read in another order than before: write docs to a table first")
            starts, lengths = np.empty(len(place), np.int64), np.empty(len(place), np.int64)
            starts[place], lengths[place] = np.cumsum(sizes) - sizes, sizes
            at = 0
            for size in own.column("sizes")[row].as_py():
                these = codes[at : at + size]
                at += size
                ids = flat[ragged(starts[these], lengths[these])]
                counts.append(len(ids))
                made.append(ids.tobytes())
            idents.append(own.column("ids")[row].values)
        kind = own.schema.field("ids").type.value_type
        return pa.table([pa.concat_arrays(idents) if idents else pa.array([], kind), pa.array(counts, pa.int64()), pa.array(made, pa.binary())], names=[id_col, "n_tokens", "ids"])

    return held.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(together, result)


def token_bytes(ranks_path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token-byte table by id: bytes one after the other, starts and lengths; an id without a token has length -1."""
    ranks = read_ranks(ranks_path)
    lengths = np.full(max(ranks.values(), default=-1) + 1, -1, np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    starts = np.cumsum(np.maximum(lengths, 0)) - np.maximum(lengths, 0)
    flat = np.zeros(int(np.maximum(lengths, 0).sum()), np.uint8)
    for token, rank in ranks.items():
        flat[starts[rank] : starts[rank] + len(token)] = np.frombuffer(token, np.uint8)
    return flat, starts, lengths


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """encoded with one more column, decoded (binary): the bytes of the tokens in ids_col, one after the other.

    ids_col is binary (little-endian unsigned 32-bit ids); null gives null. The token-byte table, whose size is the
    vocabulary's, is with every worker; each batch of ids is joined with it by id. An id that the table lacks is an
    error. A column called decoded gives way to the result; all others are returned.
    """
    kept = [c for c in encoded.columns if c.lower() != "decoded"]
    rows = encoded.select(*[F.col(f"`{c}`") for c in kept])
    where = kept.index(next(c for c in kept if c.lower() == ids_col.lower()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, starts, lengths = loaded(token_bytes, ranks_path)

        def joined(raw: bytes | None) -> bytes | None:
            if raw is None:
                return None
            ids = np.frombuffer(raw, "<u4")
            if len(ids) and (ids.max() >= len(lengths) or (lengths[ids] < 0).any()):
                raise ValueError("an id has no token")
            steps = (ids[at : at + STEP_TOKENS] for at in range(0, len(ids), STEP_TOKENS))
            return b"".join(flat[ragged(starts[s], lengths[s])].tobytes() for s in steps)

        for b in batches:
            made = pa.array([joined(x.as_py()) for x in b.column(where)], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, made], names=[*b.schema.names, "decoded"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("decoded", T.BinaryType())]))
