"""Phrase mining on a weighted de Bruijn graph of words.

Edges are the longest grams: at every word, it and the words that follow it in its piece of text,
``max_words`` at most. Words that have fewer after them, at the end of a piece, give a shorter edge
that leads nowhere. The count of any shorter phrase is the flow out of its node: the edges that
begin with it, plus the shorter ones that end on it.

A gram that is rare ends its edge too, as no frequent phrase begins with it; this changes no flow
of a frequent phrase, and leaves few edges to shuffle. Grams are counted by hash for that, pairs
first, then from level to level those whose parts are frequent. A bitmap of fixed size a level
(``bitmap_bits``) says which hashes are frequent; where two grams meet on a bit, a rare one stays
and is left out once its phrases are counted.

A node through which a great enough share of its flow passes along one edge, all of it if the path
is unary, is compacted into that edge and is no phrase of its own; as no phrase is longer than an
edge, each edge is compacted by itself.

Tasks cut texts to words and count within slices; Spark adds up by whole edges, combined before the
shuffle, so that a word, pair or language with a great part of all rows is spread over tasks by what
follows it. Only phrases that are frequent enough are joined, and no join is forced to be a
broadcast; hot words in joins are left to Spark's skew join. Scores are decimals, floored exactly.

Nulls: a null text has no words; a null language is ``und`` and counted with one of that name.
Empty and long texts: long ones are cut at piece ends, which no gram crosses; a text without words
gives nothing. Ties: the first cut by place, then phrases by count and by bytes. Repeated rows
count as often as they are there. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.session import stage_table

# A-Z become small, piece ends one sign, blanks one blank.
PREPARED = bytes(
    c + 32 if 65 <= c <= 90 else 10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256)
)
SLICE = 1 << 22  # bytes of text that a task works on at once


@dataclass(frozen=True)
class Mining:
    min_words: int = 2
    max_words: int = 3
    min_count: int = 10
    absorbed_percent: int = 50  # share of a phrase's count that makes a longer phrase stand for it
    top: int = 2000  # phrases of a language
    bitmap_bits: int = 24  # 2 to that power of bits a level: 2 MB

    def __post_init__(self):
        if not 2 <= self.min_words <= self.max_words:
            raise ValueError("phrases have two words or more")


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """(lang, prepared text) of about ``SLICE`` bytes from rows of (lang, text), cut at piece ends."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py().translate(PREPARED)
            at = 0
            while len(text) - at > SLICE and (end := text.find(b"\n", at + SLICE)) >= 0:
                yield lang, text[at:end]
                at = end + 1
            held.setdefault(lang, []).append(text[at:])
            size += len(text) - at
            if size > SLICE:
                yield from ((k, b"\n".join(v)) for k, v in held.items())
                held, size = {}, 0
    yield from ((k, b"\n".join(v)) for k, v in held.items())


class Words:
    """The words of a slice in order, as numbers, with their pairs."""

    def __init__(self, lang: str, text: bytes):
        tokens = text.decode("utf-8", "replace").replace("\n", " \n ").split(" ")
        number = {token: i for i, token in enumerate(dict.fromkeys(tokens))}
        codes = np.fromiter(map(number.__getitem__, tokens), np.int64, len(tokens))
        self.known = np.array(list(number), object)
        self.codes = codes[(self.known != "")[codes]]
        ends = (self.known == "\n")[self.codes]
        self.is_word = ~ends
        self.joined = self.is_word[:-1] & self.is_word[1:]  # a word is followed by one of its piece
        seed = pd.util.hash_array(np.array([lang], object)).astype(np.uint64)
        hashes = pd.util.hash_array(self.known, categorize=False).astype(np.uint64)[self.codes]
        pairs = (hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + seed) ^ hashes[1:]
        pairs = (pairs ^ (pairs >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        self.pairs = pairs ^ (pairs >> np.uint64(29))

    def levels(self, bitmaps: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(hashes, may be frequent) of the pairs, triples and so on at every place: one level more than ``bitmaps``.

        Of the last level those are named whose parts may be frequent.
        """
        hashes, able = self.pairs, self.joined
        for bits in bitmaps:
            place = hashes & np.uint64(len(bits) * 64 - 1)
            able = able & (bits[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
            yield hashes, able
            hashes = hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ hashes[1:]
            hashes = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            able = able[:-1] & able[1:]
        yield hashes, able

    def grams(self, bitmaps: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(grams, counts): at every word the longest gram that may be frequent."""
        goes_on = [able for _, able in self.levels(bitmaps)][:-1]
        starts = np.flatnonzero(self.is_word)
        for k in range(1, len(bitmaps) + 2):
            longer = np.zeros(len(starts), bool)
            if k <= len(goes_on):
                inside = starts < len(goes_on[k - 1])
                longer[inside] = goes_on[k - 1][starts[inside]]
            own = starts[~longer]
            starts = starts[longer]
            if not len(own):
                continue
            key = self.codes[own]
            for j in range(1, k):
                key = np.unique(key, return_inverse=True)[1] * len(self.known) + self.codes[own + j]
            _, first, n = np.unique(key, return_index=True, return_counts=True)
            gram = self.known[self.codes[own[first]]]
            for j in range(1, k):
                gram = gram + " " + self.known[self.codes[own[first] + j]]
            yield gram, n


def prepared(documents: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    return documents.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), text.alias("text"))


def frequent_grams(rows: DataFrame, mining: Mining) -> list[np.ndarray]:
    """Of each level from pairs on a bitmap, 64 bits in a number, of the hashes that may be frequent."""
    bitmaps: list[np.ndarray] = []
    for _ in range(2, mining.max_words + 1):
        bitmaps.append(_frequent(rows, bitmaps, mining))
    return bitmaps


def _frequent(rows: DataFrame, bitmaps: list[np.ndarray], mining: Mining) -> np.ndarray:
    shared = rows.sparkSession.sparkContext.broadcast(bitmaps)  # of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, text in slices(batches):
            *_, (hashes, able) = Words(lang, text).levels(shared.value)
            grams, n = np.unique(hashes[able], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(n)], names=["gram", "n"])

    counted = rows.mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    bit = F.col("gram").bitwiseAND(F.lit((1 << mining.bitmap_bits) - 1)).alias("bit")
    frequent = counted.where(F.col("n") >= mining.min_count).select(bit)
    one = F.expr("shiftleft(1L, cast(bit & 63 as int))")
    held = frequent.groupBy(F.shiftright("bit", 6).alias("place")).agg(F.bit_or(one).alias("bits")).toArrow()
    bits = np.zeros(1 << mining.bitmap_bits - 6, np.int64)  # no more rows than that came
    bits[held.column("place").to_numpy()] = held.column("bits").to_numpy()
    return bits.view(np.uint64)


def edges(rows: DataFrame, bitmaps: list[np.ndarray]) -> DataFrame:
    """(lang, gram, n): how often each longest gram occurs."""
    shared = rows.sparkSession.sparkContext.broadcast(bitmaps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, text in slices(batches):
            for gram, n in Words(lang, text).grams(shared.value):
                langs = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(gram), np.int32)))
                yield pa.RecordBatch.from_arrays([langs, pa.array(gram, pa.string()), pa.array(n)], names=["lang", "gram", "n"])

    return rows.mapInArrow(run, "lang string, gram string, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def flows(counted_edges: DataFrame, mining: Mining) -> DataFrame:
    """(lang, phrase, words, n): every phrase up to the longest with ``min_count`` or more, and each
    language's number of words as the phrase of no words.

    Summed from the edges: those that go on from a phrase, and those that end on it.
    """
    size = F.length("gram") - F.length(F.replace("gram", F.lit(" "), F.lit(""))) + 1

    def prefix(k: int) -> Column:
        # A shorter edge is a prefix of its own length only, never of a greater one.
        whole = F.col("size") >= k
        if k == mining.max_words:  # one edge is all of its flow: a rare one need not be shuffled again
            whole &= F.col("n") >= mining.min_count
        phrase = F.substring_index("gram", " ", k) if k else F.lit("")
        return F.when(whole, F.struct(F.lit(k).alias("words"), phrase.alias("phrase")))

    levels = F.array_compact(F.array(*[prefix(k) for k in range(mining.max_words + 1)]))
    sized = counted_edges.withColumn("size", size)
    spread = sized.select("lang", "n", F.explode(levels).alias("at")).select("lang", "at.words", "at.phrase", "n")
    summed = spread.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    return summed.where((F.col("words") == 0) | (F.col("n") >= mining.min_count))


def compacted(counted: DataFrame, mining: Mining) -> DataFrame:
    """(lang, phrase): phrases that a longer one stands for, as enough of their flow passes through it."""
    longer = counted.where(F.col("words") > mining.min_words).withColumn("w", F.split("phrase", " "))
    inner = F.explode(
        F.flatten(
            F.transform(
                F.sequence(F.lit(mining.min_words), F.size("w") - 1),
                lambda size: F.transform(
                    F.sequence(F.lit(1), F.size("w") - size + 1),
                    lambda first: F.array_join(F.slice("w", first, size), " "),
                ),
            )
        )
    )
    greatest = longer.select("lang", inner.alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("through"))
    own = counted.where(F.col("words").between(mining.min_words, mining.max_words - 1)).select("lang", "phrase", "n")
    met = own.join(greatest, ["lang", "phrase"])
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    return met.where(exact("through") * 100 >= exact("n") * mining.absorbed_percent).select("lang", "phrase")


def scored(counted: DataFrame, mining: Mining) -> DataFrame:
    """(lang, phrase, a, l, r, score) of every candidate, by its weakest cut."""
    candidates = counted.where(F.col("words") >= mining.min_words).select("lang", "phrase", "words", F.col("n").alias("a"))
    cut = candidates.select(
        "lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    ).select(
        "lang", "phrase", "a", "k",
        F.expr("substring_index(phrase, ' ', k)").alias("left"),
        F.expr("substring(phrase, length(substring_index(phrase, ' ', k)) + 2)").alias("right"),
    )
    part = lambda side, n: counted.where("words > 0").select("lang", F.col("phrase").alias(side), F.col("n").alias(n))
    # A part of a frequent phrase is as frequent, so inner joins lose no candidate.
    joined = cut.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    wide = {c: F.col(c).cast("decimal(38,0)") for c in ("a", "l", "r")}
    exact = joined.select("lang", "phrase", "a", "k", "l", "r", *[v.alias(f"_{c}") for c, v in wide.items()])
    score = F.expr("cast((cast(1000000 as decimal(38,0)) * _a * _a) div (_l * _r) as bigint)")
    weakest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return exact.groupBy("lang", "phrase", "a").agg(weakest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def mine(documents: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases."""
    rows = prepared(documents)
    counted = stage_table(flows(edges(rows, frequent_grams(rows, mining)), mining), "phrase-flows")
    kept = scored(counted, mining).join(compacted(counted, mining), ["lang", "phrase"], "left_anti")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= mining.top)
    totals = counted.where("words = 0").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
