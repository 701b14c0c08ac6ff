"""Fill-in-middle transformation by displacement scatter.

The texts of a batch stand in one byte array. Where their tokens begin is found by scanning it once; each text's two
cuts part it into prefix, middle and suffix. A difference array holds, at the start of each part, by how much its
shift in the output differs from that of the bytes before; its cumulative sum is every byte's shift, and one scatter
writes the output. restored() finds the parts in the output by their sentinels and gathers the bytes back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Marks before prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: Bytes that are moved together at most, but for one longer text; and bytes whose shifts are held at a time.
BATCH_BYTES, SLICE_BYTES = 16_000_000, 2_000_000


def draws(ident: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the digest of seed and identifier (null: no characters)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def shifts(at: np.ndarray, by: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """The shift of bytes lo to hi - 1, where by[k] counts for every byte from at[k] on (at ascends)."""
    first, last = np.searchsorted(at, (lo, hi - 1), side="right")
    step = np.zeros(hi - lo, np.int64)
    np.add.at(step, at[first:last] - lo, by[first:last])
    step[0] += by[:first].sum()
    return np.cumsum(step)


def moved(source: np.ndarray, starts: np.ndarray, targets: np.ndarray, out: np.ndarray, back: bool = False) -> np.ndarray:
    """Parts of source begin at starts (ascending, empty parts allowed) and go to targets of out: scattered there, or,
    with back, gathered from there into source."""
    by = np.diff(targets - starts, prepend=0)
    for lo in range(0, len(source), SLICE_BYTES):
        hi = min(len(source), lo + SLICE_BYTES)
        place = np.arange(lo, hi) + shifts(starts, by, lo, hi)
        if back:
            source[lo:hi] = out[place]
        else:
            out[place] = source[lo:hi]
    return source if back else out


def occurrences(data: np.ndarray, word: bytes) -> np.ndarray:
    """Where word begins in data (it can't overlap itself)."""
    at = np.flatnonzero(data[: max(0, len(data) - len(word) + 1)] == word[0])
    for k, byte in enumerate(word[1:], 1):
        at = at[data[at + k] == byte]
    return at


def inside(at: np.ndarray, size: int, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of at whose next size bytes lie in one text, and the texts (which end at ends)."""
    text = np.searchsorted(ends, at, side="right")
    fits = at + size <= ends[text] if len(at) else np.zeros(0, bool)
    return at[fits], text[fits]


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array without nulls, and the offsets of its texts in them."""
    wide = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data)])


def sliced(texts: pa.Array, most: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most so many bytes each, or one row."""
    _, offsets = buffer_of(texts)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        yield lo, hi
        lo = hi


def transformed(texts: pa.Array, draw: np.ndarray, rate: int, spm: int, sentinels: tuple[str, ...] = SENTINELS) -> dict[str, pa.Array]:
    """n, form, prefix_chars, middle_chars and output of texts (without nulls), by four draws for each (rows of draw)."""
    data, offsets = buffer_of(texts)
    first, ends, many = offsets[:-1], offsets[1:], len(texts)
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    opens = np.zeros(len(data), bool)
    opens[1:] = space[1:] & ~space[:-1]
    opens[first[first < ends]] = True
    tokens = np.flatnonzero(opens)
    begin = np.searchsorted(tokens, first)
    n = np.searchsorted(tokens, ends) - begin
    marks = [s.encode() for s in sentinels]
    plain = (n == 0) | (draw[:, 2] % 100 >= rate)
    for m in marks:
        plain[inside(occurrences(data, m), len(m), ends)[1]] = True
    cuts = np.sort(draw[:, :2] % (n + 1)[:, None], axis=1)
    spots = np.append(tokens, len(data))
    # a text's last cut may be its end, where the next text's first token begins
    a, b = (np.where(cuts[:, k] == n, ends, spots[np.minimum(begin + cuts[:, k], len(tokens))]) for k in (0, 1))
    a, b = np.where(plain, ends, a), np.where(plain, ends, b)
    spm_form = ~plain & (draw[:, 3] % 100 < spm)
    psm_form = ~plain & ~spm_form
    p, s, m = map(len, marks)
    size = ends - first + np.where(plain, 0, p + s + m)
    out_ends = np.cumsum(size)
    o = out_ends - size
    prefix, middle, suffix = a - first, b - a, ends - b
    to_prefix = np.select([spm_form, psm_form], [o + s + suffix + p, o + p], o)
    to_suffix = np.select([spm_form, psm_form], [o + s, o + p + prefix + s], o + prefix)
    to_middle = np.select([spm_form, psm_form], [o + s + suffix + p + prefix + m, o + p + prefix + s + suffix + m], o + prefix)
    out = np.zeros(int(out_ends[-1]) if many else 0, np.uint8)
    moved(data, np.stack([first, a, b], axis=1).ravel(), np.stack([to_prefix, to_middle, to_suffix], axis=1).ravel(), out)
    for to, mark in ((to_prefix, marks[0]), (to_suffix, marks[1]), (to_middle, marks[2])):
        for k, byte in enumerate(mark):
            out[to[~plain] - len(mark) + k] = byte
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
    chars = lambda x, y: pa.array(heads[y] - heads[x], pa.int64(), mask=plain)
    form = pa.array(np.select([plain, spm_form], ["plain", "spm"], "psm").astype(object), pa.string())
    return {"n": pa.array(n, pa.int64()), "form": form, "prefix_chars": chars(first, a), "middle_chars": chars(a, b), "output": strings(out, np.append(o, out_ends[-1:]) if many else np.zeros(1, np.int64))}


def gathered(outputs: pa.Array, forms: pa.Array, sentinels: tuple[str, ...] = SENTINELS) -> pa.Array:
    """The texts that outputs (without nulls) of these forms were made from."""
    data, offsets = buffer_of(outputs)
    first, ends, many = offsets[:-1], offsets[1:], len(outputs)
    plain = np.array(forms.to_pylist(), dtype=object) == "plain"
    marks = [s.encode() for s in sentinels]
    spot = []
    for m in marks:  # outputs in another form than plain hold each sentinel once
        at, text = inside(occurrences(data, m), len(m), ends)
        place = np.zeros(many, np.int64)
        place[text] = at
        spot.append(place)
    spm = spot[1] < spot[0]
    p, s, m = map(len, marks)
    prefix, suffix, middle = spot[0] + p, spot[1] + s, spot[2] + m
    sizes = [np.where(plain, 0, x) for x in (np.where(spm, spot[2], spot[1]) - prefix, ends - middle, np.where(spm, spot[0], spot[2]) - suffix)]
    size = np.where(plain, ends - first, sum(sizes))
    out_ends = np.cumsum(size)
    o = out_ends - size
    starts = np.stack([o, o + sizes[0], o + sizes[0] + sizes[1]], axis=1)
    targets = np.where(plain[:, None], np.stack([first] * 3, axis=1), np.stack([prefix, middle, suffix], axis=1))
    texts = moved(np.zeros(int(out_ends[-1]) if many else 0, np.uint8), starts.ravel(), targets.ravel(), data, back=True)
    return strings(texts, np.append(o, out_ends[-1:]) if many else np.zeros(1, np.int64))


def fill_in_middle(docs: DataFrame, rate: int = 50, spm: int = 80, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", sentinels: tuple[str, ...] = SENTINELS) -> DataFrame:
    """One row for each row of docs: its identifier (named id_col), n, form, prefix_chars, middle_chars and output.

    A text is cut at two of its n + 1 token borders (tokens: white space and what follows it up to the next), drawn
    from seed and identifier. form: plain where the text is empty or holds a sentinel, and for 100 - rate of a hundred
    others; else spm (suffix first) for so many of a hundred, or psm. prefix_chars and middle_chars are code points,
    null for plain. A null text counts as empty; rows of equal identifier are drawn alike, those without one as if it
    had no characters; texts of any length are moved whole; an empty table gives an empty result. Other columns of
    docs play no part, whatever their names.
    """
    fields = docs.select(F.col(f"`{id_col}`")).schema.fields
    result = T.StructType([*fields, T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())])
    rows = docs.select(F.col(f"`{id_col}`").alias("i"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("t"), *[h.alias(f"h{k}") for k, h in enumerate(draws(F.col(f"`{id_col}`"), seed))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo, hi in sliced(whole.column("t")):
                b = whole.slice(lo, hi - lo)
                draw = np.stack([b.column(f"h{k}").to_numpy(zero_copy_only=False) for k in range(4)], axis=1)
                made = transformed(b.column("t"), draw, rate, spm, sentinels)
                made["output"] = made["output"].cast(pa.string())
                yield pa.RecordBatch.from_arrays([b.column("i"), *made.values()], names=result.names)

    return rows.mapInArrow(run, result)


def restored(outputs: DataFrame, sentinels: tuple[str, ...] = SENTINELS) -> DataFrame:
    """outputs (with form and output, as fill_in_middle() gives) with one more column, restored: the text again.

    A null form or output gives null. A column called restored gives way to the result; all others are returned.
    """
    kept = [c for c in outputs.columns if c.lower() != "restored"]
    rows = outputs.select(*[F.col(f"`{c}`") for c in kept])
    form, output = ([c.lower() for c in kept].index(n) for n in ("form", "output"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo, hi in sliced(whole.column(output).fill_null("")):
                b = whole.slice(lo, hi - lo)
                known = pc.and_(b.column(form).is_valid(), b.column(output).is_valid())
                made = gathered(b.column(output).fill_null(""), pc.if_else(known, b.column(form), "plain"), sentinels).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*b.columns, pc.if_else(known, made, None)], names=[*b.schema.names, "restored"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("restored", T.StringType())]))
