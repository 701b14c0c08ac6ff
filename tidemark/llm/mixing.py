"""Mixing sources to target weights: temperature mixing realised as budgeted block permutations.

Token shares p of the sources are raised to an exponent a and normalised: w = p^a / sum(p^a). The exponent is bisected
until the mixture has a target entropy, and until the source repeated most is repeated max_repeats times at most. The
budget is the smallest at which every source is read through at least once, so no document is lost. A source's quota
of tokens is spent in epochs; each epoch is a permutation of blocks and of the documents in a block. In the last one,
blocks are read while they fit the rest of the quota; of the block that doesn't, the documents that do.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, fresh

#: Mean number of documents of the largest source in one block, and of blocks in a range of blocks.
BLOCK_DOCS, RANGE_BLOCKS = 128, 128
#: Exponents that one pass over the sources' totals tries; each pass narrows the bracket by this factor plus one.
PROBES, PASSES = 15, 6
#: The source repeated most is read at most so often, and the mixture's entropy is this part of the way from that of the
#: sources as they are (0) to that of equal shares (1).
MAX_REPEATS, EVENNESS = 2.0, 0.5


def words(text: Column) -> Column:
    """The number of words (runs without ASCII white space); 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def exponent_for_repeats(largest: float, smallest: float, max_repeats: float) -> float:
    """The least exponent in [0, 1] at which the smallest source is read at most max_repeats times as often as the largest."""
    low, high = 0.0, 1.0
    if max_repeats < 1:
        raise ValueError("max_repeats is below 1")
    spread = math.log(largest / smallest)
    if spread <= math.log(max_repeats):
        return 0.0
    for _ in range(60):
        mid = (low + high) / 2
        if (1 - mid) * spread > math.log(max_repeats):
            low = mid
        else:
            high = mid
    return high


def entropies(totals: DataFrame, exponents: list[float]) -> list[float]:
    """The entropy (nats) of the mixture of the sources' tokens at each exponent, by one aggregation over the totals."""
    log_p = F.log("tokens")
    most = totals.agg(F.max(log_p)).first()[0]
    scaled = [(log_p - most) * a for a in exponents]
    sums = totals.agg(*[F.sum(F.exp(x)).alias(f"z{k}") for k, x in enumerate(scaled)], *[F.sum(F.exp(x) * x).alias(f"x{k}") for k, x in enumerate(scaled)]).first()
    return [math.log(sums[f"z{k}"]) - sums[f"x{k}"] / sums[f"z{k}"] for k in range(len(exponents))]


def exponent_for_entropy(totals: DataFrame, target: float) -> float:
    """The exponent in [0, 1] whose mixture of the sources' tokens has the entropy target (nats), or the nearest end.

    Entropy falls as the exponent grows. Each pass cuts the bracket at PROBES exponents.
    """
    low, high = 0.0, 1.0
    for _ in range(PASSES):
        tries = [low + (high - low) * (k + 1) / (PROBES + 1) for k in range(PROBES)]
        found = entropies(totals, tries)
        above = [a for a, e in zip(tries, found, strict=True) if e >= target]
        below = [a for a, e in zip(tries, found, strict=True) if e < target]
        low, high = max(above, default=low), min(below, default=high)
    return low


def exponent(totals: DataFrame, max_repeats: float, evenness: float) -> float:
    """The exponent for sources of these tokens (all above 0): the lower one that both aims allow."""
    most, least = totals.agg(F.max("tokens"), F.min("tokens")).first()
    if most is None or most == least:
        return 0.0 if most else 1.0
    equal, own = entropies(totals, [0.0, 1.0])
    return max(exponent_for_repeats(most, least, max_repeats), exponent_for_entropy(totals, own + evenness * (equal - own)))


def mix_sources(
    docs: DataFrame, max_repeats: float = MAX_REPEATS, evenness: float = EVENNESS, seed: int = 11, block_docs: int = BLOCK_DOCS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """The rows of docs, each as often as it is drawn, with mix_tokens, mix_epoch, mix_order.

    mix_order is in [0, 1): reading by it interleaves the sources in their target weights, epoch after epoch. Every
    row is drawn at least once. A null source is a source of its own; a null text has no tokens, a very long one counts
    whole; sources without tokens are drawn once. A source's tokens miss its quota by less than the smallest document
    left out of the block that the cut falls in. Rows without an identifier, or with the same one, are each drawn, in
    an order by their texts; rows equal in identifier and text take each other's place. An empty table gives an empty
    result. Columns of docs with one of the result's names give way to it.
    """
    made = ("mix_tokens", "mix_epoch", "mix_order")
    src, tok, block, run, epochs, rest, ratio, key, drawn, taken, pos = fresh([*docs.columns, *made], "mx_source", "mx_tok", "mx_block", "mx_run", "mx_epochs", "mx_rest", "mx_ratio", "mx_key", "mx_drawn", "mx_taken", "mx_pos")
    source, text = docs[f"`{source_col}`"].cast("string"), docs[f"`{text_col}`"].cast("string")
    identity = F.concat(F.coalesce(docs[f"`{id_col}`"].cast("string"), F.lit("-")), F.lit(":"), F.xxhash64(F.coalesce(text, F.lit(""))).cast("string"))
    named = docs.withColumns({src: F.when(source.isNull(), "-").otherwise(F.concat(F.lit("="), source)), tok: words(text), key: identity})
    narrow = cut(named.select(src, tok, key))
    totals = cut(narrow.groupBy(src).agg(F.count(F.lit(1)).alias("docs"), F.sum(tok).alias("tokens")))
    used = totals.where("tokens > 0")
    largest, docs_of_largest = used.agg(F.max("tokens")).first()[0] or 1, totals.agg(F.max("docs")).first()[0] or 0
    alpha, blocks = exponent(used, max_repeats, evenness), max(1, -(-docs_of_largest // block_docs))
    # tokens of a source times (largest / tokens)^(1 - a): the largest source is read once, the others oftener
    quota = F.when(F.col("tokens") > 0, F.round(F.col("tokens") * F.pow(F.lit(float(largest)) / F.col("tokens"), F.lit(1.0 - alpha)))).otherwise(0).cast("long")
    plan = totals.withColumn("quota", quota).select(
        F.col(src).alias("p_src"),
        F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.col("tokens"))).otherwise(1).cast("int").alias(epochs),
        F.when(F.col("tokens") > 0, F.col("quota") % F.col("tokens")).otherwise(0).alias(rest),
        F.when(F.col("tokens") > 0, F.col("quota") / F.col("tokens")).otherwise(1.0).alias(ratio),
    )
    in_block = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(blocks))
    inside = Window.partitionBy(src, block).orderBy(F.xxhash64(F.lit(seed + 2), key), key)
    # tokens of a source's blocks before each one, in permuted order: first of its ranges of blocks, then inside them
    order = F.shiftrightunsigned(F.xxhash64(F.lit(seed + 1), src, block), 1)
    ranges = -(-blocks // RANGE_BLOCKS)
    by_block = narrow.withColumn(block, in_block).groupBy(src, block).agg(F.sum(tok).alias("t")).withColumn("o", order).withColumn("r", F.floor(F.col("o") / F.lit(float(1 << 63)) * ranges).cast("int"))

    def before(by: list[str], order_by: list[str]) -> Column:
        window = Window.partitionBy(*by).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("t").over(window), F.lit(0))

    by_range = by_block.groupBy(src, "r").agg(F.sum("t").alias("t"))
    range_start = by_range.select(F.col(src).alias("r_src"), F.col("r").alias("r_r"), before([src], ["r"]).alias("start"))
    starts = by_block.join(range_start, (F.col(src) == F.col("r_src")) & (F.col("r") == F.col("r_r")))
    starts = starts.withColumn("before", F.col("start") + before([src, "r"], ["o", block]))
    planned = cut(starts.join(plan, F.col(src) == F.col("p_src")).select(F.col(src).alias("o_src"), F.col(block).alias("o_block"), "t", (F.col(rest) - F.col("before")).alias("left"), epochs, rest, ratio))
    # the block that the cut falls in, one of each source: its documents in order, each taken if it fits what is left
    cut_here = planned.where("left > 0 AND left < t").select("o_src", "o_block", "left")
    members = narrow.withColumn(block, in_block).join(cut_here, (F.col(src) == F.col("o_src")) & (F.col(block) == F.col("o_block"))).withColumn(pos, F.row_number().over(inside))
    listed = members.groupBy(src, block).agg(F.array_sort(F.collect_list(F.struct(pos, tok))).alias("docs"), F.any_value("left").alias("left"))
    start = F.struct(F.col("left").alias("left"), F.array().cast("array<int>").alias("taken"))
    fill = F.aggregate(
        "docs",
        start,
        lambda have, d: F.struct(
            F.when(d[tok] <= have["left"], have["left"] - d[tok]).otherwise(have["left"]).alias("left"),
            F.when(d[tok] <= have["left"], F.concat(have["taken"], F.array(d[pos]))).otherwise(have["taken"]).alias("taken"),
        ),
    )
    chosen = listed.select(F.col(src).alias("c_src"), F.col(block).alias("c_block"), fill["taken"].alias(taken))
    offsets = planned.join(chosen, (F.col("o_src") == F.col("c_src")) & (F.col("o_block") == F.col("c_block")), "left").select("o_src", "o_block", epochs, ratio, taken, (F.col("left") >= F.col("t")).alias("whole"), F.col(rest).alias("o_rest"))
    rows = named.withColumn(block, in_block).join(offsets, (F.col(src) == F.col("o_src")) & (F.col(block) == F.col("o_block"))).withColumn(pos, F.row_number().over(inside))
    once_more = (F.col("o_rest") > 0) & (F.col("whole") | F.coalesce(F.array_contains(taken, F.col(pos)), F.lit(False)))
    times = F.col(epochs) + F.when(once_more, 1).otherwise(0)
    rows = rows.withColumn(drawn, F.explode(F.sequence(F.lit(0), times - 1)))
    # a place within the epoch, from the hash's upper 31 bits; the cut epoch fills its part of the order alone
    spot = F.shiftrightunsigned(F.xxhash64(F.lit(seed + 3), key, drawn), 33).cast("double") / F.lit(float(1 << 31))
    span = F.when(F.col(drawn) < F.col(epochs), F.lit(1.0)).otherwise(F.col(ratio) - F.col(epochs))
    clash = set(made)
    return rows.select(
        *[F.col(f"`{c}`") for c in docs.columns if c.lower() not in clash],
        F.col(tok).alias("mix_tokens"),
        F.col(drawn).cast("int").alias("mix_epoch"),
        (F.least(F.col(drawn) + spot * span, F.col(ratio) * F.lit(1 - 1e-12)) / F.col(ratio)).alias("mix_order"),
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of docs as often as they are drawn, with docs' own columns in their order, whatever they are called."""
    names = fresh(["mix_tokens", "mix_epoch", "mix_order"], *[f"c{i}" for i in range(len(docs.columns))])
    place = {c.lower(): n for c, n in zip(docs.columns, names, strict=True)}
    plain = docs.select(*[docs[f"`{c}`"].alias(n) for c, n in zip(docs.columns, names, strict=True)])
    out = mix_sources(plain, id_col=place[id_col.lower()], text_col=place[text_col.lower()], source_col=place[source_col.lower()])
    return out.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])


def realised(mixed: DataFrame, docs: DataFrame, max_repeats: float = MAX_REPEATS, evenness: float = EVENNESS, text_col: str = "text", source_col: str = "source") -> DataFrame:
    """source, own_share, target and weight (shares of tokens) of each source with tokens: what was aimed at and drawn."""
    own = docs.groupBy(F.col(f"`{source_col}`").cast("string").alias("of")).agg(F.sum(words(docs[f"`{text_col}`"].cast("string"))).alias("tokens")).where("tokens > 0")
    own = cut(own)
    alpha = exponent(own, max_repeats, evenness)
    got = mixed.groupBy(F.col(f"`{source_col}`").cast("string").alias("source")).agg(F.sum("mix_tokens").alias("drawn"))
    all_own, all_aims = own.agg(F.sum("tokens"), F.sum(F.pow(F.col("tokens"), F.lit(alpha)))).first()
    all_drawn = got.agg(F.sum("drawn")).first()[0]
    both = own.join(got, F.col("of").eqNullSafe(F.col("source")))
    return both.select(F.col("of").alias("source"), (F.col("tokens") / F.lit(all_own)).alias("own_share"), (F.pow(F.col("tokens"), F.lit(alpha)) / F.lit(all_aims)).alias("target"), (F.col("drawn") / F.lit(all_drawn)).alias("weight"))
