"""Quality classifier from weak labels.

Heuristic labellers vote for a document, against it, or stay silent. Expectation-maximisation over the counts of all
vote patterns of the whole corpus estimates how often each labeller votes which way about good documents and about bad ones
of each kind, without true labels; the posterior of a pattern labels the documents that show it. A linear scorer over
hashed words, word shapes and byte pairs learns these posteriors and judges each document by its text alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE_ROWS, slices

#: Hashed features: byte pairs, words, word shapes.
PAIRS, WORDS, SHAPES = 512, 1024, 512
DIMS = PAIRS + WORDS + SHAPES
#: Documents at most that the scorer learns from (a bounded sample, by hash of text).
TRAIN_ROWS = 8192
#: Documents with a score below this go: well below one half, as a clean document lost costs more than a bad one kept.
KEEP_FROM = 0.25

# fixed values: frequent function words of the corpus' languages
FUNCTION_WORDS = frozenset("the of and to a in is it that be for on as with are this by from or an was et de la le les des un une du en que qui est pour dans par sur au der die das und ein eine mit von zu nicht den dem ist im auf für als auch el los las un una por con para es se al lo su del".encode().split())

SPACE, LETTER, UPPER, DIGIT, MARK, SYMBOL = range(6)
_CLASS = np.full(256, LETTER, np.uint8)  # bytes of non-ASCII characters count as letters
_CLASS[:128] = SYMBOL
_CLASS[[9, 10, 11, 12, 13, 32]] = SPACE
_CLASS[97:123] = LETTER
_CLASS[65:91] = UPPER
_CLASS[48:58] = DIGIT
_CLASS[[ord(c) for c in ".,;:'\"()-?"]] = MARK
#: Bytes as the scorer sees them: letters of a kind are one.
_FOLDED = np.where(_CLASS == LETTER, 1, np.where(_CLASS == UPPER, 2, np.where(_CLASS == DIGIT, 3, np.arange(256)))).astype(np.int64)
_PAIR_PLACE = np.arange(1 << 16, dtype=np.int64) * 2654435761 % (1 << 32) % PAIRS
_MIXED = np.random.default_rng(17).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_SOLID = (_CLASS != SPACE).astype(np.int8)
#: Bytes that a plain word ends in, and those of which a word that says something has one.
_PLAIN_END = np.isin(_CLASS, (LETTER, UPPER, DIGIT, MARK))
_SPEAKS = np.isin(_CLASS, (LETTER, UPPER, DIGIT)).astype(np.int64)

#: The labellers. Those of a kind see the same junk in different ways, so that they can bear each other out.
KINDS = {"decorated": ("symbols", "letters", "endings"), "shouting": ("capitals", "exclamations", "symbols"), "tabular": ("bars", "bare_words", "symbols"), "repetitive": ("sentences_again", "words_again", "pairs_again", "compression")}
NAMES = ("symbols", "letters", "endings", "capitals", "exclamations", "bars", "bare_words", "sentences_again", "words_again", "pairs_again", "compression", "function_words")
#: Votes that each labeller is thought to have cast beforehand: for good documents, and either way about bad ones. A weak
#: prior: what the corpus says outweighs it.
PRIOR_VOTES = 2.0
#: Documents thought to have been seen beforehand: good ones, and bad ones of each kind.
GOOD_DOCS, BAD_DOCS = 16.0, 0.5


class Parsed(NamedTuple):
    """A text's bytes, where its words start and stop, and their hashes."""

    raw: bytes
    codes: np.ndarray
    starts: np.ndarray
    stops: np.ndarray
    words: np.ndarray


def parsed(text: str) -> Parsed:
    raw = text.encode("utf-8", "surrogatepass")
    codes = np.frombuffer(raw, np.uint8)
    solid = _SOLID[codes]
    edges = np.flatnonzero(np.diff(solid, prepend=np.int8(0), append=np.int8(0)))
    starts, stops = edges[::2], edges[1::2]
    if not len(starts):
        return Parsed(raw, codes, starts, stops, np.zeros(0, np.uint64))
    inside = np.arange(len(codes), dtype=np.int64) - np.repeat(np.append(0, starts[1:]), np.diff(np.append(np.append(0, starts[1:]), len(codes))))
    with np.errstate(over="ignore"):
        mixed = _MIXED[codes] * (inside.astype(np.uint64) * np.uint64(2) + np.uint64(0x9E3779B97F4A7C15)) * solid.view(np.uint8)
        words = np.add.reduceat(mixed ^ (mixed >> np.uint64(29)), starts)
    return Parsed(raw, codes, starts, stops, words)


def measures(p: Parsed) -> np.ndarray:
    """What the labellers look at, in the order of NAMES; the last value is the number of words."""
    n, words = max(1, len(p.raw)), max(1, len(p.words))
    kinds = np.bincount(_CLASS[p.codes], minlength=6)
    solid = max(1, n - int(kinds[SPACE]))
    letters = int(kinds[LETTER] + kinds[UPPER])
    sentences = [s for s in p.raw.replace(b"\n", b" ").split(b". ") if s]
    plain = bare = again = 0
    if len(p.words):
        plain = _PLAIN_END[p.codes[p.stops - 1]].sum()
        bare = (np.add.reduceat(_SPEAKS[p.codes], p.starts) == 0).sum()
        again = (p.words[1:] == p.words[:-1]).sum()
    with np.errstate(over="ignore"):
        pairs = len(set((p.words[1:] * np.uint64(0xC2B2AE3D27D4EB4F) + p.words[:-1]).tolist()))
    function = sum(map(FUNCTION_WORDS.__contains__, p.raw.lower().split()))
    return np.array(
        [
            kinds[SYMBOL] / solid,
            letters / solid,
            1 - plain / words,
            kinds[UPPER] / max(1, letters),
            p.raw.count(b"!") / words,
            p.raw.count(b"|") / words,
            bare / words,
            1 - len(set(sentences)) / max(1, len(sentences)),
            again / words,
            1 - pairs / max(1, len(p.words) - 1),
            len(zlib.compress(p.raw, 1)) / n,
            function / words,
            len(p.words),
        ]
    )


def votes(m: np.ndarray) -> np.ndarray:
    """1 where a labeller speaks for the text, -1 where it speaks against it, 0 where it is silent, in the order of NAMES.

    Texts of few words are judged by few. No labeller is against a text for lacking the words that it knows.
    """
    symbols, letters, endings, capitals, shouts, bars, bare, sentences, again, pairs, packed, function, words = m
    some, many = words >= 5, words >= 20

    def vote(judges: bool, against: bool, speaks_for: bool) -> int:
        return int(judges) * (-1 if against else int(speaks_for))

    return np.array(
        [
            vote(True, symbols > 0.06, some and symbols < 0.01),
            vote(some, letters < 0.75, letters > 0.9),
            vote(some, endings > 0.3, endings < 0.1),
            vote(some, capitals > 0.4, 0 < capitals < 0.12),
            vote(True, shouts > 0.2, some and shouts == 0),
            vote(True, bars > 0.1, some and bars == 0),
            vote(some, bare > 0.1, bare < 0.03),
            vote(words >= 8, sentences > 0.3, many and sentences < 0.1),
            vote(words >= 8, again > 0.2, again < 0.1),
            vote(many, pairs > 0.4, pairs < 0.2),
            vote(many, packed < 0.2, packed > 0.3),
            vote(some, False, function > 0.12),
        ],
        np.int8,
    )


def pattern(v: np.ndarray) -> int:
    """A vote pattern as a number; there are 3^12 at most."""
    return int(((v.astype(np.int64) + 1) * 3 ** np.arange(len(v))).sum())


def votes_of(number: int) -> list[int]:
    return [number // 3**k % 3 - 1 for k in range(len(NAMES))]


def hashed(p: Parsed) -> np.ndarray:
    """DIMS features: shares of hashed byte pairs, words, and word shapes (first and last byte, length, and whether the
    three words up to here have stood in this order before). Letters of a kind count as one but in words."""
    out = np.zeros(DIMS, np.float32)
    if len(p.codes) > 1:
        folded = _FOLDED[p.codes]
        pairs = _PAIR_PLACE[folded[:-1] * 256 + folded[1:]]
        out[:PAIRS] = np.sqrt(np.bincount(pairs, minlength=PAIRS) / len(pairs))
    if len(p.words):
        word = p.words
        with np.errstate(over="ignore"):
            three = word.copy()
            three[1:] += word[:-1] * np.uint64(0x9E3779B97F4A7C15)
            three[2:] += word[:-2] * np.uint64(0xC2B2AE3D27D4EB4F)
        new = np.zeros(len(word), bool)
        new[np.unique(three, return_index=True)[1]] = True
        shape = ((_FOLDED[p.codes[p.starts]] * 256 + _FOLDED[p.codes[p.stops - 1]]) * 16 + np.minimum(p.stops - p.starts, 15)) * 2 + new
        out[PAIRS : PAIRS + WORDS] = np.sqrt(np.bincount((word >> np.uint64(40)).astype(np.int64) % WORDS, minlength=WORDS) / len(word))
        out[PAIRS + WORDS :] = np.sqrt(np.bincount(shape * 2654435761 % (1 << 32) % SHAPES, minlength=SHAPES) / len(word))
    return out


def first_guess(patterns: np.ndarray, families: list[list[int]]) -> np.ndarray:
    """Where estimation starts: a document is bad of a kind if two labellers of the kind are against it, else good."""
    against = patterns < 0
    out = np.zeros((len(patterns), 1 + len(families)))
    for k, members in enumerate(families):
        out[:, k + 1] = against[:, members].sum(axis=1) >= 2
    out[:, 0] = ~out[:, 1:].any(axis=1)
    out = out * 0.9 + 0.1 / out.shape[1]
    return out / out.sum(axis=1, keepdims=True)


def estimate(patterns: np.ndarray, counts: np.ndarray, families: list[list[int]] | None = None, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns (rows of -1, 0 and 1) and their document counts.

    The classes are good, and bad of each kind (families: the labellers of each). Returns each pattern's posterior of
    being good, each class's share, and for each class and labeller the shares of its votes against and for. Labellers
    are taken as independent given the class. Silence counts for no class: labellers are silent about texts too short
    for them, and those may be any. A labeller that is against documents which others of its kind speak for is found
    wrong about them; its rate about good documents grows, and its word counts less.
    """
    families = [[NAMES.index(n) for n in names] for names in KINDS.values()] if families is None else families
    classes = 1 + len(families)
    if not len(patterns):
        return np.zeros(0), np.full(classes, 1 / classes), np.full((classes, 0, 2), 0.5)
    cast = np.stack([patterns == v for v in (-1, 1)], axis=2).astype(float)  # pattern, labeller, vote
    thought = np.full((classes, patterns.shape[1], 2), 0.5)
    thought[0] = 0.01, 1.0
    expected = np.array([GOOD_DOCS, *[BAD_DOCS] * len(families)])
    post = first_guess(patterns, families)
    for _ in range(rounds):
        weight = counts[:, None] * post
        share = weight.sum(axis=0) + expected
        share /= share.sum()
        seen = np.einsum("pc,plv->clv", weight, cast) + PRIOR_VOTES * thought
        rates = seen / seen.sum(axis=2, keepdims=True)
        odds = np.log(share) + np.einsum("plv,clv->pc", cast, np.log(rates))
        new = np.exp(odds - odds.max(axis=1, keepdims=True))
        new /= new.sum(axis=1, keepdims=True)
        done, post = np.abs(new - post).max() < 1e-9, new
        if done:
            break
    return post[:, 0], share, rates


def fit_scorer(x: np.ndarray, y: np.ndarray, rounds: int = 300, penalty: float = 1e-5) -> np.ndarray:
    """Weights (the bias last) of a logistic scorer for soft labels, by gradient steps with momentum."""
    if not len(x):
        return np.zeros(DIMS + 1, np.float32)
    y = y.astype(np.float32)
    w, v, bias, pull = np.zeros(x.shape[1], np.float32), np.zeros(x.shape[1], np.float32), np.float32(0), np.float32(0)
    for _ in range(rounds):
        miss = 1 / (1 + np.exp(-np.clip(x @ w + bias, -30, 30))) - y
        v = np.float32(0.9) * v - np.float32(2.0) * (x.T @ miss / np.float32(len(y)) + np.float32(penalty) * w)
        pull = np.float32(0.9) * pull - np.float32(2.0) * miss.mean()
        w, bias = w + v, bias + pull
    return np.append(w, bias)


def _plain(docs: DataFrame, text_col: str) -> Column:
    return F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit(""))


def fitted(texts: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[dict[int, float], np.ndarray]:
    """Posterior of each vote pattern, and the scorer's weights, from the column t of texts."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array([pattern(votes(measures(parsed(t)))) for t in b.column("t").to_pylist()], pa.int64())], names=["pattern"])

    counted = texts.mapInArrow(vote, "pattern long").groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("pattern").collect()  # 3^12 rows at most
    seen = np.array([votes_of(r["pattern"]) for r in counted], np.int64).reshape(-1, len(NAMES))
    posterior = estimate(seen, np.array([r["n"] for r in counted], float))[0]
    of_pattern = {r["pattern"]: float(p) for r, p in zip(counted, posterior, strict=True)}

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts_ = [parsed(t) for t in b.column("t").to_pylist()]
            x = pa.array([hashed(p).astype(np.float16).tobytes() for p in texts_], pa.binary())
            yield pa.RecordBatch.from_arrays([x, pa.array([of_pattern[pattern(votes(measures(p)))] for p in texts_], pa.float64())], names=["x", "y"])

    # the texts of smallest hash: their hashes are gathered first, so texts are neither sorted nor moved whole
    least = texts.select(F.xxhash64("t").alias("h")).distinct().orderBy("h").limit(train_rows).collect()
    if not least:
        return of_pattern, fit_scorer(np.zeros((0, DIMS)), np.zeros(0))
    sample = texts.where(F.xxhash64("t") <= F.lit(least[-1]["h"])).dropDuplicates(["t"]).select("t")
    rows = sample.mapInArrow(learn, "x binary, y double").orderBy("x", "y").collect()  # train_rows rows of DIMS halves at most
    x = np.empty((len(rows), DIMS), np.float32)
    for i, r in enumerate(rows):
        x[i] = np.frombuffer(r["x"], np.float16)
    return of_pattern, fit_scorer(x, np.array([r["y"] for r in rows]))


def score(text: str, weights: np.ndarray) -> float:
    """How likely the text is good; of one without a word, how likely texts are."""
    return float(1 / (1 + np.exp(-np.clip(hashed(parsed(text)) @ weights[:-1] + weights[-1], -30, 30))))


def quality_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS, keep_from: float = KEEP_FROM) -> DataFrame:
    """doc_id, quality (the scorer's probability of a good text) and kept, for every row.

    The estimation covers every document; the scorer learns from at most train_rows distinct texts, those of smallest
    hash, so that equal tables give equal models. Each text is read whole, however long. A null text counts as empty.
    Empty texts get no votes and the score that the model gives; rows are judged each for itself, repeated ones and
    those without an identifier as well; an empty table gives an empty result; other columns play no part.
    """
    plain = docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"), _plain(docs, text_col).alias("t"))
    weights = fitted(plain.select("t"), train_rows)[1]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            quality = np.array([score(t, weights) for t in b.column("t").to_pylist()], float)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(quality), pa.array(quality >= keep_from, pa.bool_())], names=["doc_id", "quality", "kept"])

    return plain.mapInArrow(judge, "doc_id long, quality double, kept boolean")


def good_documents(docs: DataFrame, text_col: str = "text", train_rows: int = TRAIN_ROWS, keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of docs that the classifier keeps, each judged by its own text, with docs' own columns.

    Nulls, empty texts, repeated rows and empty tables as in quality_scores().
    """
    weights = fitted(docs.select(_plain(docs, text_col).alias("t")), train_rows)[1]

    @F.arrow_udf("boolean")
    def stays(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in texts:
            pieces = (part.slice(at, SLICE_ROWS).to_pylist() for at in range(0, len(part), SLICE_ROWS))
            yield pa.array([score(t, weights) >= keep_from for piece in pieces for t in piece], pa.bool_())

    return docs.where(stays(_plain(docs, text_col)))
