"""Token-ID output: concatenated ids with Elias-Fano coded document boundaries.

A file (shard) holds the documents of one range of ids, in order:

    magic | ids, little-endian, 2 or 4 bytes each | boundaries | document ids | footer | its length | magic

Boundaries (a document's first token, and the end) and document ids are monotone, so either is an
Elias-Fano sequence: about 2 + log2(universe / n) bits a number, with select samples of 32
bits for every 256th number. No table of 64-bit offsets is kept.
"""

from __future__ import annotations

import hashlib
import json
import os
import sys
import types
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import whole_text
from eventloom.llm.files import committed, open_store
from eventloom.llm.pieces import cut, lists, marks
from eventloom.session import scratch_path, stage_table

MAGIC = b"TOKSHRD1"
SAMPLE = 256


class EliasFano:
    """Monotone numbers from 0: low bits packed, high bits as gaps in unary code."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n = len(v)
        top = int(v[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        places = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits((v[:, None] >> places & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        ones = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros((int(ones[-1]) + 1 if n else 0), np.uint8)
        high[ones] = 1
        return cls(n, low_bits, low.tobytes(), np.packbits(high, bitorder="little").tobytes(), ones[::SAMPLE].astype("<u4"))

    def slice(self, first: int, last: int) -> np.ndarray:
        """Numbers ``first`` to ``last`` - 1; reads only the bits from the sample before them on."""
        if first >= last:
            return np.zeros(0, np.uint64)
        bit = int(self.samples[first // SAMPLE])
        skip, need = first % SAMPLE, last - first
        end = int(self.samples[-(-last // SAMPLE)]) + 1 if -(-last // SAMPLE) < len(self.samples) else len(self.high) * 8
        part = np.frombuffer(self.high, np.uint8)[bit // 8 : -(-end // 8)]
        ones = np.flatnonzero(np.unpackbits(part, bitorder="little")) + bit // 8 * 8
        ones = ones[ones >= bit][skip : skip + need]
        high = (ones - np.arange(first, last)).astype(np.uint64)
        start, stop = first * self.low_bits, last * self.low_bits
        bits = np.unpackbits(np.frombuffer(self.low, np.uint8)[start // 8 : -(-stop // 8)], bitorder="little")
        bits = bits[start % 8 : start % 8 + stop - start].reshape(need, self.low_bits).astype(np.uint64)
        low = (bits << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return (high << np.uint64(self.low_bits)) | low

    def select(self, i: int) -> int:
        return int(self.slice(i, i + 1)[0])

    def parts(self) -> list[bytes]:
        return [self.low, self.high, self.samples.tobytes()]


class ShardWriter:
    """Appends documents in ascending order; memory holds ids of documents and counts, not tokens."""

    def __init__(self, out, width: int):
        self.out, self.width, self.lengths, self.doc_ids, self.nulls = out, width, [], [], 0
        out.write(MAGIC)

    def append(self, doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> None:
        self.nulls += sum(x is None for x in doc_ids)
        self.doc_ids += [x for x in doc_ids if x is not None]
        self.lengths.append(lengths)
        self.out.write(ids.astype(f"<u{self.width}").tobytes())

    def close(self) -> tuple[int, int]:
        lengths = np.concatenate(self.lengths) if self.lengths else np.zeros(0, np.int64)
        bounds = EliasFano.encode(np.concatenate([[0], np.cumsum(lengths)]))
        low = self.doc_ids[0] if self.doc_ids else 0
        names = EliasFano.encode(np.array([x - low for x in self.doc_ids], np.uint64))
        footer = {"width": self.width, "tokens": int(lengths.sum()), "nulls": self.nulls, "lowest": low}
        for key, coded in (("bounds", bounds), ("names", names)):
            footer[key] = [coded.n, coded.low_bits, *map(len, coded.parts())]
            for part in coded.parts():
                self.out.write(part)
        text = json.dumps(footer).encode()
        self.out.write(text + len(text).to_bytes(4, "little") + MAGIC)
        return len(lengths), int(lengths.sum())


class ShardReader:
    """Reads a shard by ranges: the footer and the coded sequences, then ids of the asked documents."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        tail = file.read_at(12, size - 12)
        if file.read_at(8, 0) != MAGIC or tail[4:] != MAGIC:
            raise ValueError("not a complete token shard")
        length = int.from_bytes(tail[:4], "little")
        self.footer = json.loads(file.read_at(length, size - 12 - length))
        self.width, at = self.footer["width"], 8 + self.footer["tokens"] * self.footer["width"]
        self.coded = {}
        for key in ("bounds", "names"):
            n, low_bits, *sizes = self.footer[key]
            parts = []
            for s in sizes:
                parts.append(file.read_at(s, at))
                at += s
            self.coded[key] = EliasFano(n, low_bits, parts[0], parts[1], np.frombuffer(parts[2], "<u4"))
        self.documents = self.coded["bounds"].n - 1

    def read(self, first: int, last: int) -> tuple[list[int | None], np.ndarray, np.ndarray]:
        """Document ids, bounds (one more than documents) and token ids of documents ``first`` to ``last`` - 1."""
        bounds = self.coded["bounds"].slice(first, last + 1).astype(np.int64)
        nulls = self.footer["nulls"]
        names: list[int | None] = [None] * (min(last, nulls) - min(first, nulls))
        own = self.coded["names"].slice(max(first - nulls, 0), max(last - nulls, 0))
        names += [int(x) + self.footer["lowest"] for x in own]
        raw = self.file.read_at(int(bounds[-1] - bounds[0]) * self.width, 8 + int(bounds[0]) * self.width)
        return names, bounds, np.frombuffer(raw, f"<u{self.width}")


def _worker_memory() -> dict:
    """A dictionary that lives as long as the Python worker, over its tasks."""
    return vars(sys.modules.setdefault("_token_pieces", types.ModuleType("_token_pieces")))


class PieceEncoder:
    """Ids of texts; each distinct piece is encoded by the library once while it is remembered.

    Up to ``remember`` pieces of up to ``longest`` characters are remembered; when half of them are
    new, those not seen since the last such time are forgotten. The strings of added
    tokens are those tokens, as is the library's default; a cut is never inside one without white space.
    A text is cut before each white space that follows another character and before punctuation after
    an ASCII letter or digit: no token of a byte-level pre-tokeniser spans such a place, and what it
    does on either side does not depend on the other.
    """

    def __init__(self, tokenizer_json: str, remember: int = 600_000, longest: int = 64):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        added = "".join(t["content"] for t in json.loads(tokenizer_json).get("added_tokens") or [])
        self.marks = marks(added)
        own = hashlib.md5(tokenizer_json.encode()).hexdigest()
        self.memory: list[dict[str, bytes]] = _worker_memory().setdefault(own, [{}, {}])  # of late, and before
        self.remember, self.longest = remember, longest

    @property
    def known(self) -> dict[str, bytes]:
        return self.memory[0]

    def encode(self, texts: pa.StringArray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text, all ids) with ``end_id`` after each text."""
        pieces, per_text = cut(texts, self.marks, any_white=True)
        flat = pieces.dictionary_encode()
        words = flat.dictionary.to_pylist()
        if len(self.known) > self.remember // 2:
            self.memory[:] = {}, self.known
        late, before = self.memory
        known = dict(zip(words, map(late.get, words)))  # of this call
        new = [w for w, ids in known.items() if ids is None]
        again = [(w, ids) for w in new if (ids := before.get(w)) is not None] if before else []
        if again:
            known.update(again)
            late.update(again)
            new = [w for w in new if known[w] is None]
        for i in range(0, len(new), 20_000):
            part = new[i : i + 20_000]
            for w, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                known[w] = array("I", e.ids).tobytes()
                if len(w) <= self.longest:
                    late[w] = known[w]
        # The end of a text is a piece of one id of its own.
        coded = lists([*known.values(), array("I", [end_id]).tobytes()], np.uint32)
        ends = np.cumsum(per_text)
        out = coded.take(pa.array(np.insert(flat.indices.to_numpy(), ends, len(words))))
        counts = np.diff(out.offsets.to_numpy()[np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])])
        return counts, out.values.to_numpy()


def write_shards(
    documents: DataFrame, tokenizer_json: str, folder: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Write shards in ascending order of ``id_col`` and return one row a shard, in order.

    Null ids come first; equal ids are ordered by text. Null texts are empty: only the end id.
    Partitions are ranges of ids, one shard each. Returns (shard, path, documents, tokens).
    """
    vocabulary = len(json.loads(tokenizer_json)["model"]["vocab"])
    width = 2 if vocabulary < 65_536 and end_id < 65_536 else 4
    shared = documents.sparkSession.sparkContext.broadcast(tokenizer_json)
    rows = documents.select(F.col(id_col).cast("bigint").alias("id"), whole_text(text_col).alias("text"))
    rows = rows.repartitionByRange("id").sortWithinPartitions("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        path = f"{folder}/shard-{shard:07d}.tok"
        encoder = PieceEncoder(shared.value)
        with committed(path) as out:
            writer = ShardWriter(out, width)
            for batch in batches:
                for i in range(0, batch.num_rows, 2000):
                    part = batch.slice(i, 2000)
                    writer.append(part.column(0).to_pylist(), *encoder.encode(part.column(1), end_id))
            n, tokens = writer.close()
        if n:
            yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [path], "documents": [n], "tokens": [tokens]})

    return stage_table(rows.mapInArrow(run, "shard bigint, path string, documents bigint, tokens bigint"), "token-shards")


def read_shards(shards: DataFrame, block: int = 512) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the files.

    ``start`` counts the tokens of all documents before it: those of earlier shards are summed
    over the list of shards, which has one short row a file.
    """
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = shards.select("path", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("before"))
    files = max(1, shards.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, name = open_store(path)
                with store.open_input_file(name) as file:
                    reader = ShardReader(file)
                    for first in range(0, reader.documents, block):
                        names, bounds, ids = reader.read(first, min(first + block, reader.documents))
                        ids = ids.astype("<u4")
                        own = bounds - bounds[0]
                        sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(own[:-1], own[1:])]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(names, pa.int64()),
                                pa.array(bounds[:-1] + before),
                                pa.array(np.diff(bounds)),
                                pa.array(sums, pa.int64()),
                            ],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    return placed.repartition(files).mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def round_trip(documents: DataFrame, tokenizer_path: str) -> DataFrame:
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer_json = file.read()
    folder = scratch_path(documents.sparkSession, "token-files")
    return read_shards(write_shards(documents, tokenizer_json, folder))
