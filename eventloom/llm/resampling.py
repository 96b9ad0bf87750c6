"""Importance resampling towards a target: hashed n-gram weights, and a Gumbel top-k draw.

Texts are cleaned to words with one blank between; an overlapped scan by regular expression,
bounded by lookarounds, gives the span of every n-gram, whose CRC is its bucket. The corpus and
the target are counted by bucket; a document's weight is the mean log ratio of its n-grams. The
draw adds Gumbel noise that depends on the document alone and takes the highest sums.

Every text is scanned once, as a whole. Its buckets are written as 16-bit numbers to the shared
folder; counts and weights are read from them. What reaches the driver is one number a bucket.
Nulls: a null text has no words, a null id hashes as the empty text and is ranked behind others of
its score. Repeated rows are separate documents, ranked one after the other. A long text is one
row of buckets, two bytes each. Empty tables give no rows, or weights against an empty target.
Other columns of the tables are not read, so their names can't clash.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import extended
from eventloom.operators.ordered import running_total
from eventloom.session import stage_table

# Digits, small letters and all bytes of other characters are parts of words; A-Z become small.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
BLOCK = 1 << 20  # features counted at once


@dataclass(frozen=True)
class Draw:
    max_words: int = 2  # n-grams of 1 to so many words
    buckets: int = 10_000
    min_words: int = 20  # of a document that can be drawn
    percent: int = 25
    seed: int = 7

    def __post_init__(self):
        if not 0 < self.buckets <= 1 << 16:
            raise ValueError("1 to 65,536 buckets are supported")


def clean(text: bytes) -> bytes:
    """Words in small letters, one blank between."""
    return b" ".join(text.translate(WORD_BYTES).split())


def gram_patterns(max_words: int) -> list[regex.Pattern]:
    """One pattern a length; overlapped, each finds a gram at every word that has enough words after it."""
    more = b" [^ ]++"
    return [regex.compile(rb"(?<![^ ])[^ ]++" + more * k + rb"(?![^ ])") for k in range(max_words)]


def features(words: bytes, patterns: list[regex.Pattern], buckets: int) -> np.ndarray:
    """The bucket of every n-gram of a cleaned text, repeats included."""
    crc = [
        zlib.crc32(words[slice(*found.span())])
        for pattern in patterns
        for found in pattern.finditer(words, overlapped=True)
    ]
    return (np.array(crc, np.uint32) % buckets).astype("<u2")


def scan(texts: DataFrame, draw: Draw, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep``'s columns with ``n_words`` and ``features`` (binary, little-endian 16-bit buckets)."""
    source = texts.select(*keep, F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("_text"))
    schema = extended(source, "n_words bigint, features binary", ("_text",))
    max_words, buckets = draw.max_words, draw.buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = gram_patterns(max_words)
        for batch in batches:
            n_words, found = [], []
            for text in batch.column(batch.num_columns - 1):
                words = clean(text.as_py())
                n_words.append(words.count(b" ") + 1 if words else 0)
                found.append(features(words, patterns, buckets).tobytes())
            columns = [*batch.columns[:-1], pa.array(n_words, pa.int64()), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(run, schema)


def bucket_counts(scanned: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket over all rows: summed in the tasks, then by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for row in batch.column(0):
                own = np.frombuffer(row.as_buffer(), "<u2")
                for at in range(0, len(own), BLOCK):
                    total += np.bincount(own[at : at + BLOCK], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    sums = scanned.select("features").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    table = sums.toArrow()  # one row a bucket
    counts = np.zeros(buckets, np.int64)
    counts[table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return counts


def gains(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Floored log ratio, in thousandths, of the smoothed shares of each bucket."""
    size = len(raw)
    all_target, all_raw = float(target.sum() + size), float(raw.sum() + size)
    return np.array(
        [math.floor(1000 * math.log((t + 1) * all_raw / ((s + 1) * all_target))) for t, s in zip(target.tolist(), raw.tolist())],
        np.int64,
    )


def weigh(scanned: DataFrame, gain: np.ndarray) -> DataFrame:
    """The columns of ``scanned`` without ``features``, with ``n_features`` and ``weight``."""
    schema = extended(scanned, "n_features bigint, weight bigint", ("features",))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, weights = [], []
            for row in batch.column(batch.num_columns - 1):
                own = np.frombuffer(row.as_buffer(), "<u2")
                total = sum(int(gain[own[at : at + BLOCK]].sum()) for at in range(0, len(own), BLOCK))
                n.append(len(own))
                weights.append(total // len(own) if len(own) else 0)
            columns = [*batch.columns[:-1], pa.array(n, pa.int64()), pa.array(weights, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    kept = [c for c in scanned.columns if c != "features"]
    return scanned.select(*kept, "features").mapInArrow(run, schema)


def resample(documents: DataFrame, target: DataFrame, draw: Draw = Draw(), id_col: str = "doc_id") -> DataFrame:
    """(id, n_features, weight, score, rank) of every document; ``rank`` is null for those not drawn."""
    identified = documents.withColumnRenamed(id_col, "doc_id").select("doc_id", "text")
    scanned = stage_table(scan(identified, draw, ["doc_id"]), "resample-scan")
    gain = gains(bucket_counts(scan(target.select("text"), draw, []), draw.buckets), bucket_counts(scanned, draw.buckets))
    quota = draw.percent * scanned.where(F.col("n_words") >= draw.min_words).count() // 100

    digest = F.sha2(F.concat(F.lit(f"{draw.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(4294967296.0)
    noise = F.floor(F.lit(-1000) * F.ln(-F.ln(uniform)))
    scored = weigh(scanned, gain).withColumn("score", (F.col("weight") + noise).cast("bigint"))
    out = ["doc_id", "n_features", "weight", "score"]
    # Ranks count the rows before each in one order of all rows, cut by range: no single sorted task.
    placed = scored.where(F.col("n_words") >= draw.min_words).select(
        *out, (-F.col("score")).alias("_first"), F.col("doc_id").isNull().alias("_second"), F.lit(1).cast("bigint").alias("_one")
    )
    order = ["_first", "_second", "doc_id", "n_features", "weight"]
    ranked = running_total(placed, [], order, "_one", "rank")
    drawn = F.when(F.col("rank") <= quota, F.col("rank")).cast("bigint").alias("rank")
    rest = scored.where(F.col("n_words") < draw.min_words).select(*out, F.lit(None).cast("bigint").alias("rank"))
    return ranked.select(*out, drawn).unionByName(rest).withColumnRenamed("doc_id", id_col)
