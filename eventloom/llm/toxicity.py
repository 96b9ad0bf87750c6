"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

The JVM splits and hashes words; n-grams are made from the hashes with array arithmetic. The
model is trained by workers on disjoint parts of the labelled sample; after each pass their
per-coordinate sums, whose size the model bounds, are averaged on Spark in blocks of coordinates,
so the driver gets one array a pass. A row's worker is a hash of its id and a worker takes its
rows in one order, so neither file splits nor cores change a weight. L1 leaves few weights, which
is what is broadcast.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import extended, whole_text
from eventloom.session import stage_table


BLOCK_BITS = 14
MOVES = "block int, worker int, at binary, dz binary, dn binary"


@dataclass(frozen=True)
class Settings:
    """``max_rows`` bounds the labelled sample; ``bits`` the weights (2 ** bits at most).

    ``workers`` is part of the model, as their moves are averaged. A toxic row counts
    ``toxic_weight`` times, as clean rows are far more.
    """

    max_rows: int = 60_000
    bits: int = 20
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.0
    passes: int = 4
    workers: int = 2
    toxic_weight: float = 4.0


@dataclass(frozen=True)
class ToxicityModel:
    index: np.ndarray
    weight: np.ndarray
    bias: float
    bits: int

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.bits, np.float32)
        out[self.index] = self.weight
        return out


def word_codes(text: Column) -> Column:
    """A 32-bit hash of each lower-cased run of letters and digits, of the whole text."""
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda w: F.hash(w))


def features(codes: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of all words, pairs of neighbours and pairs that skip a word.

    ``offsets`` bounds each row's stretch of ``codes``. Numbers wrap on purpose.
    """
    base = codes.astype(np.int64).view(np.uint64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    out_rows, out = [row], [base * np.uint64(0x9E3779B97F4A7C15)]
    for gap, factor in ((1, np.uint64(0xC2B2AE3D27D4EB4F)), (2, np.uint64(0x165667B19E3779F9))):
        if len(base) > gap:
            same = row[gap:] == row[:-gap]
            mixed = (base[:-gap] * factor) ^ (base[gap:] + np.uint64(gap))
            out.append((mixed * np.uint64(0x9E3779B97F4A7C15))[same])
            out_rows.append(row[gap:][same])
    return np.concatenate(out_rows), (np.concatenate(out) >> np.uint64(64 - bits)).astype(np.int64)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _weights(z: np.ndarray, n: np.ndarray, s: Settings) -> np.ndarray:
    shrunk = np.sign(z) * s.l1 - z
    return np.where(np.abs(z) <= s.l1, 0.0, shrunk / ((s.beta + np.sqrt(n)) / s.alpha + s.l2))


def _pass(batches: Iterator[pa.RecordBatch], z: np.ndarray, n: np.ndarray, s: Settings) -> None:
    """One row after the other: predict, then move each present coordinate at its own rate."""
    bias = 1 << s.bits
    for batch in batches:
        labels = batch.column("label").to_numpy(zero_copy_only=False)
        codes, offsets = _lists(batch.column("codes"))
        for i, label in enumerate(labels):
            part = codes[offsets[i] : offsets[i + 1]]
            x = np.append(np.unique(features(part, np.array([0, len(part)]), s.bits)[1]), bias)
            w = _weights(z[x], n[x], s)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -30, 30))) - label
            g *= s.toxic_weight if label else 1.0
            rate = (np.sqrt(n[x] + g * g) - np.sqrt(n[x])) / s.alpha
            z[x] += g - rate * w
            n[x] += g * g


def _moves(worker: int, dz: np.ndarray, dn: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What a worker adds, a row for each block of coordinates it met: places within it and moves."""
    met = np.flatnonzero(dn > 0)
    block = met >> BLOCK_BITS
    for b in np.unique(block):
        own = met[block == b]
        at = (own & ((1 << BLOCK_BITS) - 1)).astype(np.uint16)
        yield pa.RecordBatch.from_pydict(
            {
                "block": pa.array([b], pa.int32()),
                "worker": pa.array([worker], pa.int32()),
                "at": [at.tobytes()],
                "dz": [dz[own].astype(np.float32).tobytes()],
                "dn": [dn[own].astype(np.float32).tobytes()],
            }
        )


def averaged(moves: DataFrame) -> DataFrame:
    """One row (block, dz, dn) a block: the mean over the workers that met a coordinate."""

    def mean(table: pa.Table) -> pa.Table:
        size = 1 << BLOCK_BITS
        dz, dn, met = np.zeros(size), np.zeros(size), np.zeros(size, np.int32)
        for row in table.sort_by("worker").to_pylist():  # the same sums in every run
            at = np.frombuffer(row["at"], np.uint16)
            dz[at] += np.frombuffer(row["dz"], np.float32)
            dn[at] += np.frombuffer(row["dn"], np.float32)
            met[at] += 1
        met = np.maximum(met, 1)
        return pa.table(
            {
                "block": table.column("block").slice(0, 1),
                "dz": [(dz / met).astype(np.float32).tobytes()],
                "dn": [(dn / met).astype(np.float32).tobytes()],
            }
        )

    return moves.groupBy("block").applyInArrow(mean, "block int, dz binary, dn binary")


def sample_labels(labels: DataFrame, s: Settings, id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """(id, label), the larger label of a repeated id; about ``max_rows`` of them, by a hash of the id."""
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(label_col).cast("double").alias("label"))
    )
    share = s.max_rows / max(1, known.count())
    return known if share >= 1 else known.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < int(share * 1_000_000))


def fit(documents: DataFrame, labels: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """Train on the documents that ``labels`` marks. No labels: all weights are 0.

    Rows that share an id are all learned from, one after the other; an id that a labelled row
    repeats has its larger label. Null and empty texts move the bias alone.
    """
    marks = F.broadcast(sample_labels(labels, s, id_col))  # max_rows rows of two numbers
    texts = documents.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("text"))
    h = F.xxhash64("_id")
    rows = texts.join(marks, "_id").select(
        F.pmod(h, F.lit(s.workers)).cast("int").alias("worker"),
        h.alias("h"),
        F.xxhash64("text").alias("t"),
        "label",
        word_codes(F.col("text")).alias("codes"),
    )
    rows = stage_table(rows, "toxicity-sample")
    # A worker's rows go into one partition and stay in this order when they are grouped.
    rows = rows.repartition(s.workers, "worker").sortWithinPartitions("worker", "h", "t")
    size = (1 << s.bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    context = documents.sparkSession.sparkContext
    for _ in range(s.passes):
        state = context.broadcast((z.astype(np.float32), n.astype(np.float32)))

        def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first = next(batches)
            own_z, own_n = (x.astype(np.float64) for x in state.value)
            before = own_n.copy()
            _pass(itertools.chain([first], batches), own_z, own_n, s)
            yield from _moves(first.column("worker")[0].as_py(), own_z - state.value[0], own_n - before)

        # Each worker starts from the same sums; what those that met a coordinate add is averaged.
        for move in averaged(rows.groupBy("worker").applyInArrow(train, MOVES)).collect():  # 2 ** bits * 8 bytes
            first = move["block"] << BLOCK_BITS
            z[first : first + (1 << BLOCK_BITS)] += np.frombuffer(move["dz"], np.float32)[: size - first]
            n[first : first + (1 << BLOCK_BITS)] += np.frombuffer(move["dn"], np.float32)[: size - first]
    w = _weights(z, n, s)
    index = np.flatnonzero(w[:-1])
    return ToxicityModel(index, w[index].astype(np.float32), float(w[-1]), s.bits)


def score(documents: DataFrame, model: ToxicityModel, keep: dict[str, Column], text_col: str = "text") -> DataFrame:
    """``keep``'s columns with ``score`` and ``predicted``; a feature counts once a text.

    Null and empty texts get the score of no feature at all (the bias).
    """
    kept = documents.select(*[c.alias(n) for n, c in keep.items()], word_codes(whole_text(text_col)).alias("_codes"))
    schema = extended(kept, "score double, predicted int", ("_codes",))
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        weights = m.dense()
        for batch in batches:
            codes, offsets = _lists(batch.column(batch.num_columns - 1))
            total = np.full(batch.num_rows, m.bias)
            first = 0
            while first < batch.num_rows:  # some rows at a time, to bound the arrays
                last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + 500_000, "right")) - 1)
                last = min(last, batch.num_rows)
                own = offsets[first : last + 1]
                row, feature = features(codes[own[0] : own[-1]], own - own[0], m.bits)
                held = weights[feature] != 0
                pairs = np.unique((row[held] << m.bits) | feature[held])
                total[first:last] += np.bincount(
                    pairs >> m.bits, weights[pairs & ((1 << m.bits) - 1)], minlength=last - first
                )
                first = last
            p = 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                names=[*batch.schema.names[:-1], "score", "predicted"],
            )

    return kept.mapInArrow(run, schema)
