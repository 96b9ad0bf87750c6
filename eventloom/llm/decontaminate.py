"""Benchmark decontamination by the q-gram lemma.

An item of m characters that stands in a text with at most k edits shares m + 1 - q (k + 1)
of its q-grams or more with it, and all of them lie within k diagonals (place in the text minus
place in the item) of each other. Shared q-grams are counted in bands of diagonals that
overlap by half, so that one band has them all; bands with enough are verified by alignment.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FACTOR = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0x100000001B3)
MAP_BITS = 22


@dataclass(frozen=True)
class Budget:
    """``rate``: edits a character of an item. ``block_chars``: characters of items searched at a time.

    ``slice_hits``: shared q-grams spread out at a time, however common a q-gram is.
    """

    q: int = 8
    rate: float = 0.08
    block_chars: int = 4_000_000
    chunk_chars: int = 1_000_000
    slice_hits: int = 2_000_000

    def edits(self, m: int) -> int:
        """As the rate says, but so few that four shared q-grams are needed at least."""
        return max(0, min(int(self.rate * m), (m - 3) // self.q - 1))


def letters_and_digits(text: Column) -> Column:
    """Lower case, one blank for each run of other characters: what is compared."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _grams(codes: np.ndarray, q: int) -> np.ndarray:
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    wide = codes.astype(np.uint64)
    h = wide[:n].copy()
    for j in range(1, q):
        h *= BASE
        h += wide[j : j + n]
    return h * FACTOR


def banded_edits(item: np.ndarray, text: np.ndarray, first: int, last: int) -> int:
    """Fewest edits that make ``item`` a part of ``text``, on diagonals ``first`` to ``last``.

    One row a character of the item over the cells of the band only; both ends in the text
    are free. The steps to the right within a row are a running minimum.
    """
    width = last - first + 1
    far = len(item) + 1
    steps = np.arange(width)
    places = first + steps
    row = np.where((places >= 0) & (places <= len(text)), 0, far)
    for i, c in enumerate(item):
        at = places + i  # the text's character that a step along a diagonal takes
        inside = (at >= 0) & (at < len(text))
        other = np.ones(width, np.int64)
        other[inside] = text[at[inside]] != c
        diagonal = np.where(inside, row + other, far)
        skipped = np.append(row[1:], far) + 1  # a character of the item is left out
        row = np.minimum(diagonal, skipped)
        row = np.minimum(np.minimum.accumulate(row - steps) + steps, far)
    return int(row.min())


class Searcher:
    """Finds the items of one block in many texts."""

    def __init__(self, items: list[tuple[int, str]], budget: Budget):
        self.budget, q = budget, budget.q
        self.short = [(n, f" {t} ") for n, t in items if 0 < len(t) < 2 * q]
        long = [(n, t) for n, t in items if len(t) >= 2 * q]
        self.numbers = np.array([n for n, _ in long], np.int64)
        self.texts = [t for _, t in long]
        self.codes = [_codes(t) for t in self.texts]
        self.edits = np.array([budget.edits(len(c)) for c in self.codes], np.int64)
        self.needed = np.array([len(c) + 1 - q * (int(k) + 1) for c, k in zip(self.codes, self.edits)], np.int64)
        grams = [_grams(c, q) for c in self.codes]
        every = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        order = np.argsort(every, kind="stable")
        self.item, self.place = item[order], place[order]
        self.grams, self.first, self.count = np.unique(every[order], return_index=True, return_counts=True)
        self.present = np.zeros(1 << MAP_BITS, bool)
        self.present[(self.grams >> np.uint64(64 - MAP_BITS)).astype(np.int64)] = True

    def search(self, texts: list[str]) -> list[dict[int, int]]:
        """Of each text the items found: number to edits."""
        out: list[dict[int, int]] = [{} for _ in texts]
        for i, text in enumerate(texts):
            for number, words in self.short:
                if words in f" {text} ":
                    out[i][number] = 0
        if len(self.grams):
            first = 0
            while first < len(texts):
                last, size = first, 0
                while last < len(texts) and (last == first or size + len(texts[last]) < self.budget.chunk_chars):
                    size += len(texts[last]) + 1
                    last += 1
                self._chunk(texts[first:last], out[first:last])
                first = last
        return out

    def _chunk(self, texts: list[str], out: list[dict[int, int]]) -> None:
        codes = _codes("\0".join(texts))
        sizes = np.array([len(t) for t in texts])
        begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        h = _grams(codes, self.budget.q)
        at = np.flatnonzero(self.present[(h >> np.uint64(64 - MAP_BITS)).astype(np.int64)])
        gram = np.searchsorted(self.grams, h[at])
        gram[gram == len(self.grams)] = 0
        same = self.grams[gram] == h[at]
        at, gram = at[same], gram[same]
        if not len(at):
            return
        doc = np.searchsorted(begins, at, "right") - 1
        bands = int(sizes.max()) + 2 * self._longest() + 2
        keys, shared = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for part, posting in self._hits(gram):
            item = self.item[posting]
            # Not below 0: a text's own diagonals begin at minus the item's length.
            diagonal = at[part] - begins[doc[part]] - self.place[posting] + self._longest()
            band = diagonal // (self.edits[item] + 1)
            own = (item * bands + band) * len(texts) + doc[part]
            own, n = np.unique(np.concatenate([own, own[band > 0] - len(texts)]), return_counts=True)
            keys, back = np.unique(np.concatenate([keys, own]), return_inverse=True)
            shared = np.bincount(back, np.concatenate([shared, n]), len(keys)).astype(np.int64)
        items = keys // len(texts) // bands
        for key in keys[shared >= self.needed[items]].tolist():
            rest, d = divmod(key, len(texts))
            i, b = divmod(rest, bands)
            self._verify(texts[d], i, b * int(self.edits[i] + 1) - self._longest(), out[d])

    def _hits(self, gram: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(number of a found gram, posting) of all postings, ``slice_hits`` at a time."""
        ends = np.cumsum(self.count[gram])
        for low in range(0, int(ends[-1]), self.budget.slice_hits):
            hit = np.arange(low, min(low + self.budget.slice_hits, int(ends[-1])))
            part = np.searchsorted(ends, hit, "right")
            yield part, hit - (ends[part] - self.count[gram[part]]) + self.first[gram[part]]

    def _longest(self) -> int:
        return max(map(len, self.codes))

    def _verify(self, text: str, i: int, first: int, found: dict[int, int]) -> None:
        number, k, m = int(self.numbers[i]), int(self.edits[i]), len(self.codes[i])
        if found.get(number) == 0:
            return
        # A band is two halves of k + 1 diagonals; an alignment may leave it by k on either side.
        low = max(0, first - k)
        region = text[low : max(low, first + 3 * k + 2 + m)]
        if self.texts[i] in region:
            found[number] = 0
            return
        edits = banded_edits(self.codes[i], _codes(region), first - k - low, first - low + 3 * k + 2)
        if edits <= k:
            found[number] = min(edits, found.get(number, edits))


def blocks(benchmark: DataFrame, budget: Budget, id_col: str = "item_id", text_col: str = "text") -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of about ``block_chars`` normalised characters, one at a time on the driver.

    Null and empty texts are left out, as they are no passage; a repeated item keeps each id, and
    items without id are searched like others.
    """
    items = benchmark.select(F.col(id_col).cast("bigint").alias("id"), letters_and_digits(F.col(text_col)).alias("text"))
    items = items.where("text != ''")
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    number = -(-total // budget.block_chars)
    for b in range(number):
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(number)) == b)
        yield sorted(((r["id"], r["text"]) for r in part.toLocalIterator()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def find_items(
    documents: DataFrame,
    benchmark: DataFrame,
    keep: dict[str, Column],
    budget: Budget = Budget(),
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``keep``'s columns, ``items`` (ids in order), ``edits`` (fewest of each) and ``contaminated`` for every document.

    Items without id are in no list; a document that holds one is contaminated all the same.

    A map over the documents for each block of items: nothing is shuffled, and each text is
    searched whole. Null and empty texts have no items.
    """
    context = documents.sparkSession.sparkContext
    rows = documents.select(
        *[c.alias(n) for n, c in keep.items()],
        letters_and_digits(F.col(text_col)).alias("_text"),
        F.array().cast("array<bigint>").alias("items"),
        F.array().cast("array<int>").alias("edits"),
        F.lit(False).alias("contaminated"),
    )

    def searched(rows: DataFrame, items: list[tuple[int | None, str]]) -> DataFrame:
        shared = context.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            item_ids = [i for i, _ in shared.value]
            searcher = Searcher([(n, t) for n, (_, t) in enumerate(shared.value)], budget)
            for batch in batches:
                *kept, texts, old_items, old_edits, old_marks = batch.columns
                found = searcher.search(texts.to_pylist())
                marks = [bool(new) or mark for new, mark in zip(found, old_marks.to_pylist())]
                merged = []
                for new, ids, edits in zip(found, old_items.to_pylist(), old_edits.to_pylist()):
                    fewest = dict(zip(ids, edits))
                    for number, n in new.items():
                        if (i := item_ids[number]) is not None:
                            fewest[i] = min(n, fewest.get(i, n))
                    merged.append(sorted(fewest.items()))
                yield pa.RecordBatch.from_arrays(
                    [
                        *kept,
                        texts,
                        pa.array([[x for x, _ in m] for m in merged], pa.list_(pa.int64())),
                        pa.array([[x for _, x in m] for m in merged], pa.list_(pa.int32())),
                        pa.array(marks, pa.bool_()),
                    ],
                    names=batch.schema.names,
                )

        return rows.mapInArrow(run, rows.schema)

    for items in blocks(benchmark, budget, item_id_col, item_text_col):
        rows = searched(rows, items)
    return rows.drop("_text")
