"""Byte-level BPE in Spark expressions: a fold of ranked merges over the bytes of distinct words.

The rank map is a literal of the query. A SQL map is searched from its beginning, so it is laid
out as a matrix of left and right ids whose sparse rows are pushed into one another: one array of
the rows' offsets, one of entries. Each fold step merges the pair with the lowest rank; a word's
fold ends when no pair has one. Every distinct word of the
corpus is folded once.

The ids come back to the texts by scan task: each task names the words of its texts once, the words
are brought together and folded, and (task, word, ids) is written to the shared folder by task.
The second scan looks its words up in its own file, so neither texts nor occurrences of words are
shuffled, and no task holds more than the words of its own texts. If a task's texts are not those
of the first scan, say as files were cut otherwise, its missing words are merged there, by a heap.
So are words of over ``LONG`` bytes, which are rare and would be slow to fold.

Nulls: a null text is empty and has no ids. Repeated rows are encoded as they stand. Long texts
are one row of a batch. An empty table gives no rows. Only the kept columns and the text are
read, so names can't clash.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import regex
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import extended, let
from eventloom.llm.files import open_store
from eventloom.llm.pieces import cut, lists, marks
from eventloom.session import scratch_path, short_plan_texts

# Fixed value: the characters of Unicode's White_Space property.
WHITE = r"\t-\r \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
PLACES = 1024  # a word's places fit below it
SHIFT = 26
NONE = 1 << SHIFT  # ranks below 65536 times PLACES
LONG = 256
SET = 1 << 20  # distinct chunks a task holds at most


def read_ranks(path: str) -> dict[bytes, int]:
    """Lines of base64 bytes and rank."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}


@dataclass(frozen=True)
class RowTable:
    """A sparse matrix in one array: the cell (row, column) is at ``offsets[row] + column``."""

    offsets: list[int]
    row_at: list[int]  # the row that holds each place, -1: free

    @classmethod
    def build(cls, rows: dict[int, list[int]], width: int) -> RowTable:
        """Each row at the first offset where its columns are free, the longest rows first."""
        free = np.ones(width + sum(map(len, rows.values())), bool)
        row_at = np.full(len(free), -1, np.int64)
        offsets, low = [0] * width, 0
        for row in sorted(rows, key=lambda r: -len(rows[r])):
            own = np.sort(np.array(rows[row]))
            while not free[low]:
                low += 1
            start = max(0, low - int(own[0]))
            while True:
                if (end := start + 2048 + int(own[-1])) > len(free):
                    free = np.append(free, np.ones(end - len(free), bool))
                    row_at = np.append(row_at, np.full(end - len(row_at), -1))
                fits = start + np.flatnonzero(free[start + own[0] : start + own[0] + 2048])
                for column in own[1:]:
                    fits = fits[free[fits + column]]
                if len(fits):
                    break
                start += 2048
            offsets[row] = int(fits[0])
            free[fits[0] + own] = False
            row_at[fits[0] + own] = row
        # Any offset and column together are a place of the array.
        return cls(offsets, row_at[: max(offsets) + width].tolist() + [-1] * (max(offsets) + width - len(row_at)))


def numbers(values: list[int | str]) -> Column:
    """A literal array: the expression is folded to a constant when the query is planned. Empty strings are nulls."""
    return F.split(F.lit(",".join(map(str, values))), ",").try_cast("array<bigint>")


class MergeTable:
    """The literal rank map: (left id, right id) to the id, which is the rank, of their union."""

    def __init__(self, ranks: dict[bytes, int]):
        if max(ranks.values()) >= 1 << 16:
            raise ValueError("ranks up to 65535 are supported")
        self.ranks = ranks
        self.bytes_ids = [ranks[bytes([b])] for b in range(256)]
        pairs = {
            (ranks[token[:i]], ranks[token[i:]]): rank
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        }
        rows: dict[int, list[int]] = {}
        for left, right in pairs:
            rows.setdefault(left, []).append(right)
        table = RowTable.build(rows, max(ranks.values()) + 1)
        # left id * NONE + rank * PLACES, so that the left id taken off leaves a number below NONE
        entries = [
            left * NONE + pairs[left, i - table.offsets[left]] * PLACES if left >= 0 else ""
            for i, left in enumerate(table.row_at)
        ]
        self.offsets, self.entries = numbers(table.offsets), numbers(entries)

    def fold(self, word: Column, then: Callable[[Column], Column] = lambda ids: ids) -> Column:
        """``then`` of the ids (array of bigint) of a word of up to ``LONG`` bytes.

        The literals are bound to variables outside all else, as each expression around a literal writes it
        out anew for the plan's text.
        """
        return let(self.entries, lambda entries: let(self.offsets, lambda offsets: then(self._fold(word, offsets, entries))))

    def _fold(self, word: Column, offsets: Column, entries: Column) -> Column:
        latin = F.decode(F.encode(word, "utf-8"), "iso-8859-1")  # one character a byte
        first = F.transform(F.split(latin, ""), lambda c: F.get(numbers(self.bytes_ids), F.ascii(c)))
        state = lambda ids, best: F.struct(ids.alias("ids"), best.alias("best"))
        none, unknown = F.lit(None).cast("bigint"), F.lit(-1).cast("bigint")

        def best_of(ids: Column) -> Column:
            """rank * PLACES + place of the pair to merge next; null or at least ``NONE`` if there is none."""
            return F.array_min(
                F.transform(ids, lambda x, i: entries[offsets[x] + F.get(ids, i + 1)].bitwiseXOR(F.shiftleft(x, SHIFT)) + i)
            )

        def merge(ids: Column, best: Column) -> Column:
            place = best.bitwiseAND(F.lit(PLACES - 1)).cast("int")
            merged = F.array(F.shiftright(best, PLACES.bit_length() - 1))
            rest = F.slice(ids, place + 3, F.size(ids))
            return F.concat(F.slice(ids, F.lit(1), place), merged, rest)

        def step(s: Column, _: Column) -> Column:
            found = let(
                best_of(s["ids"]),
                lambda b: F.when(b < NONE, state(merge(s["ids"], b), unknown)).otherwise(state(s["ids"], none)),
            )
            return F.when(s["best"].isNull(), s).otherwise(found)

        def run(ids: Column) -> Column:
            steps = F.slice(ids, 2, F.size(ids))  # n - 1 merges at most
            return F.aggregate(steps, state(ids, unknown), step, lambda s: s["ids"])

        return let(first, run)


def id_hex(ids: Column) -> Column:
    """Ids as little-endian 32-bit numbers in hexadecimal."""
    four = lambda x: F.concat(
        F.lpad(F.hex(x.bitwiseAND(F.lit(255))), 2, "0"), F.lpad(F.hex(F.shiftright(x, 8)), 2, "0"), F.lit("0000")
    )
    return F.array_join(F.transform(ids, four), "")


def merge_by_heap(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for a long word, in n log n steps."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # part i is word[i:end[i]]
    alive = [True] * n
    heap = [(ranks[word[i : i + 2]], i, i + 2) for i in range(n - 1) if word[i : i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != stop:
            continue
        alive[end[i]] = False
        end[i] = stop
        if stop < n:
            before[stop] = i
            if (rank := ranks.get(word[i : end[stop]])) is not None:
                heapq.heappush(heap, (rank, i, end[stop]))
        if (left := before[i]) >= 0 and (rank := ranks.get(word[left:stop])) is not None:
            heapq.heappush(heap, (rank, left, stop))
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


def word_pattern(pattern: str) -> regex.Pattern:
    r"""The pattern with white space spelled out: ``\s`` of the engine takes four control characters more."""
    return regex.compile(pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\s", f"[{WHITE}]").replace(r"\S", f"[^{WHITE}]"))


MARKS = marks()
ROWS = 2000  # texts that are cut at a time


def pieces_of(column: pa.Array) -> Iterator[tuple[pa.LargeStringArray, np.ndarray]]:
    """The pieces of some texts at a time, and each text's number of them; null texts are empty."""
    texts = column.cast(pa.string()).fill_null("")
    for i in range(0, len(texts), ROWS):
        yield cut(texts.slice(i, ROWS), MARKS)


def chunks(text: str) -> list[str]:
    """``text`` cut before single blanks and punctuation, where no word of a byte-level pattern goes across."""
    return [piece for pieces, _ in pieces_of(pa.array([text])) for piece in pieces.to_pylist()]


def words_by_task(texts: DataFrame, pattern: str) -> DataFrame:
    """(word, task): the words of up to ``LONG`` bytes of each scan task's texts, mostly once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, find = TaskContext.get().partitionId(), word_pattern(pattern).findall
        held: set[str] = set()

        def rows(found: set[str]) -> pa.RecordBatch:
            words = set(itertools.chain.from_iterable(map(find, found)))
            short = [w for w in words if len(w) <= LONG and len(w.encode()) <= LONG]
            return pa.RecordBatch.from_arrays(
                [pa.array(short, pa.string()), pa.array(np.full(len(short), task, np.int32))], names=["word", "task"]
            )

        for batch in batches:
            for pieces, _ in pieces_of(batch.column(0)):
                held.update(pieces.unique().to_pylist())
                if len(held) >= SET:
                    yield rows(held)
                    held = set()
        yield rows(held)

    return texts.mapInArrow(run, "word string, task int")


def fold_words(named: DataFrame, merges: MergeTable) -> DataFrame:
    """(task, word, ids) of ``named`` (word, task): each distinct word folded once, ids as bytes of 32-bit numbers.

    A word is named once by a task, so its group is bounded by the number of tasks.
    """
    by_word = named.repartition("word").groupBy("word").agg(F.collect_set("task").alias("tasks"))
    folded = by_word.select("word", "tasks", merges.fold(F.col("word"), lambda ids: F.unhex(id_hex(ids))).alias("ids"))
    return folded.select(F.explode("tasks").alias("task"), "word", "ids")


class KnownWords(dict):
    """Word to ids as bytes; words that are not there are merged and not kept."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, word: str) -> bytes:
        return np.array(merge_by_heap(word.encode(), self.ranks), "<u4").tobytes()

    def read(self, folder: str) -> KnownWords:
        """Add what is in the files of ``folder``, if there are any."""
        store, path = open_store(folder)
        files = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
        for file in files:
            if file.base_name.endswith(".parquet"):
                with store.open_input_file(file.path) as source:
                    rows = pq.read_table(source, columns=["word", "ids"])
                self.update(zip(rows.column("word").to_pylist(), rows.column("ids").to_pylist()))
        return self


class ChunkIds(dict):
    """Chunk to the ids of its words as bytes; short chunks are kept, ``SET`` at most at a time.

    A word that stands alone is the same one word, as byte-level patterns look ahead for white space only.
    """

    def __init__(self, words: KnownWords, find: Callable[[str], list[str]]):
        super().__init__()
        self.words, self.find = words, find

    def __missing__(self, chunk: str) -> bytes:
        words = [chunk] if chunk in self.words else self.find(chunk)
        ids = b"".join(map(self.words.__getitem__, words))
        if len(chunk) <= 64:
            if len(self) >= SET:
                self.clear()
            self[chunk] = ids
        return ids


def encode(
    documents: DataFrame, ranks: dict[bytes, int], pattern: str, keep: dict[str, Column], text_col: str = "text"
) -> DataFrame:
    """``keep``'s columns with ``ids`` (array of int) of every whole text and ``ids_sha256`` over them."""
    folder = scratch_path(documents.sparkSession, "words")
    named = words_by_task(documents.select(text_col), pattern)
    folded = fold_words(named, MergeTable(ranks)).repartition("task")
    with short_plan_texts(documents.sparkSession):
        folded.write.partitionBy("task").parquet(folder)

    source = documents.select(*[c.alias(n) for n, c in keep.items()], F.col(text_col).alias("_text"))
    schema = extended(source, "ids array<int>, ids_sha256 string", ("_text",))
    shared = documents.sparkSession.sparkContext.broadcast(ranks)  # the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = KnownWords(shared.value).read(f"{folder}/task={TaskContext.get().partitionId()}")
        ids_of = ChunkIds(known, word_pattern(pattern).findall)
        for batch in batches:
            done = 0
            for pieces, per_text in pieces_of(batch.column(batch.num_columns - 1)):
                flat = pieces.dictionary_encode()
                coded = lists(list(map(ids_of.__getitem__, flat.dictionary.to_pylist())), np.int32)
                out = coded.take(flat.indices)
                ends = out.offsets.to_numpy()[np.concatenate([[0], np.cumsum(per_text)])]
                raw = memoryview(out.values.to_numpy().astype("<i4", copy=False).tobytes())
                shas = [hashlib.sha256(raw[a * 4 : b * 4]).hexdigest() for a, b in itertools.pairwise(ends.tolist())]
                ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), out.values)
                kept = [c.slice(done, len(per_text)) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*kept, ids, pa.array(shas, pa.string())], names=schema.names)
                done += len(per_text)

    return source.mapInArrow(run, schema)


def decode(ids: Column, ranks: dict[bytes, int], then: Callable[[Column], Column] = lambda raw: raw) -> Column:
    """``then`` of the bytes of ``ids``: their pieces from a literal, joined as hexadecimal digits."""
    pieces = [""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token.hex()
    table = F.split(F.lit(",".join(pieces)), ",")
    return let(table, lambda t: then(F.unhex(F.array_join(F.transform(ids, lambda i: F.get(t, i)), ""))))


def round_trip(
    documents: DataFrame, ranks_path: str, pattern: str, keep: dict[str, Column], with_ids: bool = False
) -> DataFrame:
    """``keep``'s columns with ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if asked for, ``ids``."""
    ranks = read_ranks(ranks_path)
    encoded = encode(documents, ranks, pattern, keep)
    decoded = decode(F.col("ids"), ranks, lambda raw: F.sha2(raw, 256))
    out = encoded.select(
        *keep, F.size("ids").cast("bigint").alias("n_tokens"), "ids_sha256", decoded.alias("decoded_sha256"), "ids"
    )
    return out if with_ids else out.drop("ids")
