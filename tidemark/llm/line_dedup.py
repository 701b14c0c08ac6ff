"""Line dedup by a deletion-neighbourhood join: lines within one edit of an earlier line go.

Two lines are within one edit (a character inserted, deleted or replaced) just when deleting at most one character
from each gives the same string, at the same place for a replacement. Every line sends its variants as hashed keys,
equal keys are joined, and the edit distance of each found pair is verified on the texts.

Variants are emitted only where they can meet another line's. An edit leaves one half of a line intact, and seven of
its eight segments: lines that share no half, then no seven segments, with another line have no partner, so these two
filters lose none. The variants are then those of the segment that differs.

All of it is one plan: texts travel once, packed, and both joins with them read the same exchange.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import all_repeated, packed, partitions, row_keys

#: A line of nothing else is blank: structure, which stays.
BLANK = " \t\v\f\r"
SEGMENTS = 8


def _halves(line: Column, n: Column) -> Column:
    """Four keys of a line: its halves, and the halves of a line one character shorter from either end."""
    m = n - 1

    def key(kind: int, size: Column, piece: Column) -> Column:
        return F.xxhash64(F.lit(kind), size, piece)

    def half(size: Column) -> Column:
        return F.floor(size / 2).cast("int")

    return F.array(
        key(0, n, F.left(line, half(n))),
        key(1, n, F.right(line, n - half(n))),
        key(0, m, F.left(line, half(m))),
        key(1, m, F.right(line, m - half(m))),
    )


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _bounds(size: int) -> list[int]:
    return [j * size // SEGMENTS for j in range(SEGMENTS + 1)]


def segment_keys(line: str) -> list[tuple[int, int]]:
    """(key, slot): the line without one segment; slot j for segment j of a line as long, 8 + j of one a character shorter."""
    raw, out = line.encode("utf-32-le"), []
    for role, size in enumerate((len(line), len(line) - 1)):
        b = _bounds(size)
        for j in range(SEGMENTS):
            tail = (size - b[j + 1]) * 4
            h = xxhash.xxh3_64_intdigest(raw[: b[j] * 4] + b"\0\0\0\1" + (raw[-tail:] if tail else b""), size * SEGMENTS + j)
            out.append((_signed(h), role * SEGMENTS + j))
    return out


def variants(line: str, slots: list[int]) -> list[tuple[int, str]]:
    """(key, role) of the deletion variants in the given slots: 'same' among lines of one length, 'longer' and 'self'
    between a line and those a character longer."""
    raw, n, out = line.encode("utf-32-le"), len(line), set()
    for slot in slots:
        if slot < SEGMENTS:
            b = _bounds(n)
            for i in range(b[slot], b[slot + 1]):
                out.add((_signed(xxhash.xxh3_64_intdigest(raw[: 4 * i] + raw[4 * i + 4 :], 1000 + i)), "same"))
            out.add((_signed(xxhash.xxh3_64_intdigest(raw, 1)), "self"))
        else:
            b, j = _bounds(n - 1), slot - SEGMENTS
            for i in range(b[j], b[j + 1] + 1):
                out.add((_signed(xxhash.xxh3_64_intdigest(raw[: 4 * i] + raw[4 * i + 4 :], 1)), "longer"))
    return sorted(out)


def within_one_edit(a: str, b: str) -> bool:
    """Whether the edit distance is at most 1: what follows the first difference decides. Linear, however long they are."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    at, n = 0, len(a)
    while at < n and a[at : at + 256] == b[at : at + 256]:
        at += 256
    while at < n and a[at] == b[at]:
        at += 1
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]


#: Where a line stands, in the order in which lines count as earlier: rows without an identifier last.
PLACE = "none boolean, k1 long, k2 long, at int"


def _distinct_lines(rows: DataFrame) -> DataFrame:
    """h1, h2 (its hash) of every distinct line that is compared, and first: the first place, with the keys of its halves.

    What is known of a line is one column, so that all readers of this aggregation share its exchange.
    """
    split = rows.select(F.col("id").isNull().alias("none"), "k1", "k2", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("at", "line"))
    lines = split.where(F.btrim("line", F.lit(BLANK)) != "")
    known = F.struct("none", "k1", "k2", "at", _halves(F.col("line"), F.char_length("line")).alias("halves"))
    return lines.groupBy(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2")).agg(F.min(known).alias("first"))


def kept_lines(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """(k1, k2, at) of the lines that stay: first occurrences without an earlier line within one edit.

    rows and texts are the same rows: (id, k1, k2, text) as they are read, and packed, dealt out by (k1, k2).
    """
    distinct = _distinct_lines(rows)
    # the first hash alone stands for a line here: should two lines share it, both are candidates
    shared = all_repeated(distinct.select("h1", F.explode("first.halves").alias("key")), "key").select("h1").distinct()
    wanted = distinct.join(shared, "h1", "left_semi")
    # the texts of the candidates, each read from its first occurrence's row
    wants = F.collect_list(F.struct("h1", "h2", "first.none", "first.at")).alias("wants")
    of_row = wanted.groupBy(F.col("first.k1").alias("w1"), F.col("first.k2").alias("w2")).agg(wants)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            columns = (b.column(c).to_pylist() for c in ("k1", "k2", "packed", "wants"))
            for k1, k2, text, lines in zip(*columns, strict=True):
                if lines is None:
                    continue
                whole = zstandard.decompress(text).decode().split("\n") if text is not None else [""]
                out += [(w["h1"], w["h2"], w["none"], k1, k2, w["at"], whole[w["at"]]) for w in lines]
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.string())
            made = [pa.array(c, kind) for c, kind in zip(zip(*out, strict=True) if out else [[]] * 7, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(made, names=["h1", "h2", "none", "k1", "k2", "at", "line"])

    # every row and column of texts goes in, so that this join and the last one read one exchange
    found = texts.join(of_row, (F.col("k1") == F.col("w1")) & (F.col("k2") == F.col("w2")), "left").mapInArrow(pick, f"h1 long, h2 long, {PLACE}, line string")
    lines = found.groupBy("h1", "h2").agg(F.any_value(F.struct("none", "k1", "k2", "at", "line")).alias("what"))

    def segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(a, b, *ks) for a, b, line in zip(pdf["h1"], pdf["h2"], pdf["line"], strict=True) for ks in segment_keys(line)], columns=["h1", "h2", "key", "slot"])

    slotted = all_repeated(lines.select("h1", "h2", F.col("what.line").alias("line")).mapInPandas(segments, "h1 long, h2 long, key long, slot int"), "key")
    slots = slotted.groupBy("h1", "h2").agg(F.collect_set("slot").alias("slots"))

    def deletions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            columns = ("h1", "h2", "none", "k1", "k2", "at", "line", "slots")
            rows = [(*known, *v) for *known, line, s in zip(*(pdf[c].array for c in columns), strict=True) for v in variants(line, [int(x) for x in s])]
            yield pd.DataFrame(rows, columns=["h1", "h2", "none", "k1", "k2", "at", "key", "role"])

    emitted = lines.join(slots, ["h1", "h2"]).select("h1", "h2", "what.*", "slots").mapInPandas(deletions, f"h1 long, h2 long, {PLACE}, key long, role string")
    # lines that share a key are those with one character put into one string: by their alphabet, never many
    group = Window.partitionBy("key", F.col("role") == "same")
    me = F.struct("none", "k1", "k2", "at", "h1", "h2")
    found_in = emitted.withColumns(
        {
            "me": me,
            "same": F.min(F.when(F.col("role") == "same", me)).over(group),
            "self": F.min(F.when(F.col("role") == "self", me)).over(group),
            "longer": F.min(F.when(F.col("role") == "longer", me)).over(group),
        }
    )
    partner = F.when(F.col("role") == "same", F.col("same")).when(F.col("role") == "self", F.col("longer")).otherwise(F.col("self"))
    pairs = found_in.withColumn("earlier", partner).where("earlier < me").select("h1", "h2", F.col("earlier.h1").alias("e1"), F.col("earlier.h2").alias("e2")).distinct()
    of = lines.select(F.col("h1").alias("t1"), F.col("h2").alias("t2"), F.col("what.line").alias("earlier_line"))
    own = lines.select("h1", "h2", F.col("what.line").alias("line"))
    both = pairs.join(own, ["h1", "h2"]).join(of, (F.col("e1") == F.col("t1")) & (F.col("e2") == F.col("t2"))).select("h1", "h2", "line", "earlier_line")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = [within_one_edit(x, y) for x, y in zip(b.column("line").to_pylist(), b.column("earlier_line").to_pylist(), strict=True)]
            yield b.select(["h1", "h2"]).filter(pa.array(near, pa.bool_()))

    dropped = both.mapInArrow(verify, "h1 long, h2 long").distinct()
    return distinct.join(dropped, ["h1", "h2"], "left_anti").select("first.k1", "first.k2", "first.at")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of docs, its text without the lines that go, with n_lines and n_dropped.

    Lines are split at newlines and compared as they are. Of equal lines the earliest stays (by identifier, then line
    number; rows with the same identifier by a hash of their texts, rows without one after all others); a line with an
    earlier line within one edit goes as well, everywhere, however short or long it is. Blank lines stay. A null text
    stays null and has no lines; an empty one has one. Of rows equal in identifier and text the second and later ones
    lose all their lines. An empty table gives an empty result. Columns of docs called n_lines or n_dropped give way
    to the results, whatever other columns are called.
    """
    made = {"n_lines", "n_dropped"}
    held = [c for c in docs.columns if c.lower() not in made]
    names = [f"c{i}" for i in range(len(held))]
    ident, text = docs[f"`{id_col}`"].cast("long"), docs[f"`{text_col}`"].cast("string")
    k1, k2 = row_keys(ident, text)
    others = [(c, n) for c, n in zip(held, names, strict=True) if c.lower() != text_col.lower()]
    rows = docs.select(k1.alias("k1"), k2.alias("k2"), ident.alias("id"), text.alias("text"))
    texts = packed(docs.select(*[docs[f"`{c}`"].alias(n) for c, n in others], k1.alias("k1"), k2.alias("k2"), text.alias("text"))).drop("copies").repartition(partitions(docs.sparkSession), "k1", "k2")
    stay = kept_lines(rows, texts).groupBy(F.col("k1").alias("s1"), F.col("k2").alias("s2")).agg(F.collect_list("at").alias("stay"))
    joined = texts.join(stay, (F.col("k1") == F.col("s1")) & (F.col("k2") == F.col("s2")), "left")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for b in batches:
            out = []
            columns = (b.column(c).to_pylist() for c in ("k1", "k2", "packed", "stay"))
            for k1, k2, text, lines in zip(*columns, strict=True):
                first, last = last != (k1, k2), (k1, k2)
                if text is None:
                    out.append((None, 0, 0))
                    continue
                whole, hold = zstandard.decompress(text).decode().split("\n"), set(lines or ()) if first else ()
                left = [x for i, x in enumerate(whole) if i in hold or not x.strip(BLANK)]
                out.append(("\n".join(left), len(whole), len(whole) - len(left)))
            made_ = [pa.array(c, kind) for c, kind in zip(zip(*out, strict=True) if out else [[]] * 3, (pa.string(), pa.int64(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays([*[b.column(n) for _, n in others], *made_], names=[*[n for _, n in others], "text", "n_lines", "n_dropped"])

    fields = [T.StructField(n, docs.schema[c].dataType) for c, n in others]
    results = [T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    # equal rows stand together, so that the first is told from the rest
    out = joined.sortWithinPartitions("k1", "k2").select(*[n for _, n in others], "k1", "k2", "packed", "stay").mapInArrow(rebuild, T.StructType([*fields, *results]))
    place = dict(others)
    return out.select(*[(F.col("text") if c.lower() == text_col.lower() else F.col(place[c])).alias(c) for c in held], "n_lines", "n_dropped")
