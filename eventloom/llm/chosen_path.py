"""N-gram Jaccard join by chosen paths.

A document is the set of its word n-grams, embedded into ``width`` min-hash tokens. In each
run a set follows the paths of the tokens that a hash shared by all sets picks, so that similar
sets meet in the same buckets. Buckets over ``limit`` sets are split again by further tokens;
smaller ones are compared by brute force. As many independent runs are made as the target
recall needs. What sketches let through is verified on the whole n-gram sets.

A pair counts in the first bucket that both sets share (their list of buckets says which),
so links are counted right without listing pairs anywhere. Only sets with a possible partner
in a bucket get their n-grams back.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import space_words, whole_text
from eventloom.session import stage_table

M1, M2, M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


@dataclass(frozen=True)
class JoinSettings:
    """``limit``: sets in a bucket that are compared as it is. ``depth``: most splits of a path.

    A bucket that is still larger at the last depth is compared whole too, in blocks of
    ``limit`` sets against each other, one task a pair of blocks.
    """

    n: int = 5
    similarity: float = 0.8
    recall: float = 0.995
    width: int = 128
    limit: int = 2500
    depth: int = 5
    branching: float = 1.25

    def runs(self) -> int:
        """Runs after which a pair at the threshold has met with probability ``recall``, at the last depth."""
        met = 1.0
        for _ in range(self.depth):
            met = 1 - math.exp(-self.branching * met)
        return math.ceil(math.log(1 - self.recall) / math.log(1 - met))

    def least_equal(self) -> int:
        """Sketch positions that agree, 4.5 standard deviations below what the threshold gives."""
        p = self.similarity + (1 - self.similarity) / 4
        return math.floor(self.width * p - 4.5 * math.sqrt(self.width * p * (1 - p)))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of word hashes; fewer than n words are one n-gram."""
    words = words.view(np.uint64)
    if len(words) == 0:
        return words
    size = min(n, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for j in range(size):
        out = (out ^ words[j : j + len(out)]) * M1
        out ^= out >> np.uint64(29)
    return np.unique(_mix(out))


def _multipliers(width: int) -> tuple[np.ndarray, np.ndarray]:
    numbers = _mix(np.arange(1, 2 * width + 1, dtype=np.uint64) * M1)
    return (numbers[:width] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (numbers[width:] >> np.uint64(32)).astype(np.uint32)


def signature(grams: np.ndarray, width: int) -> np.ndarray:
    """Min-hash of each of ``width`` functions (uint32)."""
    a, b = _multipliers(width)
    low = np.full(width, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(grams), 4096):
        part = (grams[i : i + 4096] >> np.uint64(32)).astype(np.uint32)
        part ^= part >> np.uint32(15)
        values = part[:, None] * a + b
        low = np.minimum(low, (values ^ (values >> np.uint32(16))).min(axis=0))
    return low


def sketch(signatures: np.ndarray) -> np.ndarray:
    """The two lowest bits of each position, as planes: rows of ``width`` / 32 numbers of 64 bits."""
    planes = [np.packbits((signatures >> np.uint32(k) & np.uint32(1)).astype(np.uint8), axis=1) for k in (0, 1)]
    return np.ascontiguousarray(np.concatenate(planes, axis=1)).view(np.int64)


def next_paths(paths: np.ndarray, signatures: np.ndarray, s: JoinSettings) -> tuple[np.ndarray, np.ndarray]:
    """(row, longer path) of the tokens that each row's path picks."""
    tokens = _mix(signatures.astype(np.uint64) | np.arange(s.width, dtype=np.uint64) << np.uint64(32))
    drawn = _mix(tokens ^ _mix(paths.view(np.uint64))[:, None])
    chosen = drawn < np.uint64(s.branching / (s.similarity * s.width) * 2.0**64)
    row, position = np.nonzero(chosen)
    return row, _mix(_mix(paths.view(np.uint64)[row]) * M1 + tokens[row, position]).view(np.int64)


def _word_hashes(text_col: str):
    return F.transform(space_words(whole_text(text_col)), lambda w: F.xxhash64(w))


def _key(text_col: str):
    """The word sequence as 128 bits: documents that agree in it are copies."""
    return F.unhex(F.md5(F.array_join(space_words(whole_text(text_col)), " ")))


def _arrays(column: pa.Array) -> list[np.ndarray]:
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


SKETCH = ("s0", "s1", "s2", "s3")


def embed(documents: DataFrame, s: JoinSettings, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, key, n, sig) of every document with an id and a word."""
    rows = documents.where(F.col(id_col).isNotNull() & whole_text(text_col).rlike(r"[^\x20\x09-\x0D]")).select(
        F.col(id_col).cast("bigint").alias("doc_id"), _key(text_col).alias("key"), _word_hashes(text_col).alias("words")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [ngrams(w, s.n) for w in _arrays(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(x) for x in sets], pa.int32()),
                    pa.array([signature(x, s.width).tobytes() for x in sets], pa.binary()),
                ],
                names=["doc_id", "key", "n", "sig"],
            )

    return rows.mapInArrow(run, "doc_id bigint, key binary, n int, sig binary")


def _split(rows: DataFrame, s: JoinSettings, runs: int = 0) -> DataFrame:
    """(path, doc_id, n, sketch) on the next level; with ``runs`` from the roots, else from ``path``."""
    columns = ["path"] * (not runs) + ["doc_id", "n", "sig"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                *paths, ids, n, raw = batch.columns
                ids, n = ids.to_numpy(), n.to_numpy()
                sigs = np.frombuffer(b"".join(raw.to_pylist()), np.uint32).reshape(-1, s.width)
                sketches = sketch(sigs)
                starts = [p.to_numpy() for p in paths] or [np.full(len(ids), r + 1, np.int64) for r in range(runs)]
                for own in starts:
                    row, path = next_paths(own, sigs, s)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (path, ids[row], n[row], *sketches[row].T)],
                        names=["path", "doc_id", "n", *SKETCH],
                    )

    schema = "path bigint, doc_id bigint, n int, s0 bigint, s1 bigint, s2 bigint, s3 bigint"
    split = rows.select(*columns).mapInArrow(run, schema)
    # A path can be reached by two tokens with one value; a set is in a bucket once.
    return split.groupBy("path", "doc_id").agg(*[F.min(c).alias(c) for c in ("n", *SKETCH)])


def _sized(rows: DataFrame) -> DataFrame:
    """Rows whose bucket has others, with the bucket's size."""
    sizes = rows.groupBy("path").agg(F.count("*").alias("size")).where("size > 1")
    return rows.join(sizes, "path")


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of rows that agree in the first ``keys`` columns, of a stream sorted by them."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        changed = np.zeros(batch.num_rows, bool)
        for c in columns:
            changed[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(changed).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _candidates(table: pa.Table, s: JoinSettings) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a bucket that may be similar by size and sketch and have no bucket in common before."""
    n = table.column("n").to_numpy()
    m = len(n)
    block, first, second = (table.column(c).to_numpy() for c in ("block", "b1", "b2"))
    planes = np.stack([table.column(c).to_numpy() for c in SKETCH], axis=1).view(np.uint64)
    half = planes.shape[1] // 2
    earlier = None
    left, right = [], []
    for i in range(m - 1):
        j = np.arange(i + 1, m)
        if first[0] != second[0]:
            j = j[block[j] != block[i]]
        smaller, larger = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
        j = j[smaller >= s.similarity * larger]
        differ = planes[i] ^ planes[j]
        equal = s.width - np.bitwise_count(differ[:, :half] | differ[:, half:]).sum(axis=1)
        j = j[equal >= s.least_equal()]
        if len(j):
            if earlier is None:
                earlier = [frozenset(x) for x in table.column("earlier").to_pylist()]
            j = np.array([k for k in j.tolist() if earlier[i].isdisjoint(earlier[k])], np.int64)
            left.append(np.full(len(j), i))
            right.append(j)
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _verified(table: pa.Table, s: JoinSettings) -> pa.RecordBatch | None:
    """(doc_id, root, links) of the sets with a similar one among the candidates."""
    left, right = _candidates(table, s)
    if not len(left):
        return None
    ids = table.column("doc_id").to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in table.column("grams").to_pylist()]
    sizes = np.array([len(x) for x in sets])
    ends = np.cumsum(sizes)
    _, dense = np.unique(np.concatenate(sets), return_inverse=True)
    own = [dense[e - k : e] for e, k in zip(ends, sizes)]
    mark = np.zeros(int(dense.max()) + 1, bool)
    links = np.zeros(len(ids), np.int64)
    root = np.arange(len(ids))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    bounds = np.flatnonzero(np.diff(left, prepend=-1, append=-1))
    for a, b in zip(bounds[:-1], bounds[1:]):
        i = int(left[a])
        mark[own[i]] = True
        for j in right[a:b].tolist():
            shared = int(np.count_nonzero(mark[own[j]]))
            if shared >= s.similarity * (sizes[i] + sizes[j] - shared):
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                if x != y:
                    x, y = (x, y) if ids[x] < ids[y] else (y, x)
                    root[y] = x
        mark[own[i]] = False
    linked = np.flatnonzero(links)
    return pa.RecordBatch.from_pydict(
        {"doc_id": ids[linked], "root": ids[[find(int(x)) for x in linked]] if len(linked) else ids[:0], "links": links[linked]}
    )


BUCKET = ("path", "b1", "b2")


def _by_bucket(rows: DataFrame) -> DataFrame:
    return rows.repartition(*BUCKET).sortWithinPartitions(*BUCKET)


def buckets(sets: DataFrame, s: JoinSettings) -> DataFrame:
    """Rows of all final buckets, with block numbers and the earlier buckets of their set.

    ``sets``: (doc_id, n, sig). One shuffle a level; only rows of too large buckets go on, and
    the loop ends when there are none. Each level is written to the shared folder.
    """
    level = stage_table(_sized(_split(sets, s, s.runs())), "paths")
    final: DataFrame | None = None
    for depth in range(1, s.depth + 1):
        large = level.where(F.col("size") > s.limit) if depth < s.depth else level.where(F.lit(False))
        done = level.where(F.col("size") <= s.limit) if depth < s.depth else level
        final = done if final is None else final.unionByName(done)
        if large.isEmpty():
            break
        level = stage_table(_sized(_split(large.select("path", "doc_id").join(sets, "doc_id"), s)), "paths")
    parts = F.ceil(F.col("size") / s.limit).cast("int")
    cut = final.withColumn("block", F.when(F.col("size") > s.limit, F.pmod(F.xxhash64("doc_id"), parts)).otherwise(0).cast("int"))
    others = F.sequence(F.lit(0), F.when(F.col("size") > s.limit, parts - 1).otherwise(0))
    placed = cut.withColumn("other", F.explode(others))
    every = final.groupBy("doc_id").agg(F.collect_set("path").alias("paths"))
    return placed.join(every, "doc_id").select(
        "path",
        F.least("block", "other").alias("b1"),
        F.greatest("block", "other").alias("b2"),
        "block",
        "doc_id",
        "n",
        *SKETCH,
        F.filter("paths", lambda p: p < F.col("path")).alias("earlier"),
    )


def links(documents: DataFrame, sets: DataFrame, s: JoinSettings, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, root, links) a set and bucket: counted links, and the smallest id it is tied to there.

    ``sets``: one row a word sequence (doc_id, key, n, sig).
    """
    rows = buckets(sets, s)

    def keep_possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, len(BUCKET)):
            left, right = _candidates(group, s)
            if len(left):
                yield from group.take(np.union1d(left, right)).combine_chunks().to_batches()

    possible = stage_table(_by_bucket(rows).mapInArrow(keep_possible, rows.schema), "possible")

    # The n-grams of these sets only. Copies of a text share the key but not the id.
    wanted = possible.select("doc_id").distinct().join(sets.select("doc_id", "key"), "doc_id")
    texts = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), _key(text_col).alias("key"), F.col(text_col).alias("text"))
    words = wanted.join(texts, ["doc_id", "key"]).select("doc_id", _word_hashes("text").alias("words"))

    def to_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = [ngrams(w, s.n).tobytes() for w in _arrays(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(grams, pa.binary())], names=["doc_id", "grams"])

    grams = words.mapInArrow(to_grams, "doc_id bigint, grams binary").dropDuplicates(["doc_id"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, len(BUCKET)):
            found = _verified(group, s)
            if found is not None and found.num_rows:
                yield found

    whole = possible.join(grams, "doc_id").select(*possible.columns, "grams")
    found = _by_bucket(whole).mapInArrow(verify, "doc_id bigint, root bigint, links bigint")
    return stage_table(found, "links")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that can be reached over edges (a, b).

    Labels flow along edges and then jump to their label's label, until none changes. Every
    round is written to the shared folder.
    """
    both = edges.where("a != b").select("a", "b").union(edges.where("a != b").select("b", "a")).distinct()
    both = stage_table(both, "edges")
    labels = stage_table(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("label")),
        "labels",
    )
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        moved = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("new"))
        jump = moved.select(F.col("node").alias("new"), F.col("new").alias("further"))
        jumped = moved.join(jump, "new").select("node", F.least("new", "further").alias("new"), "label")
        jumped = stage_table(jumped, "labels")
        labels = jumped.select("node", F.col("new").alias("label"))
        if jumped.where("new != label").isEmpty():
            return labels


def join(documents: DataFrame, s: JoinSettings = JoinSettings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id, n_copies, n_links) of every document.

    ``class_id``: the smallest id among the documents tied to it by copies and links, so
    documents that no chain ties together differ in it. ``n_copies``: other documents with the
    same words. ``n_links``: different word sequences with a Jaccard similarity of
    ``similarity`` or more. Texts without words and rows without id are alone: their class is
    their own id. Ids are taken to be unique; repeated rows are copies. Texts of fewer than
    ``n`` words are one n-gram, so they are similar to copies only.
    """
    embedded = stage_table(embed(documents, s, id_col, text_col), "sets")
    first = embedded.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("members"))
    first = stage_table(first, "first")
    # The embedding of the first document of each word sequence; repeated rows count once.
    sets = stage_table(
        embedded.join(first.select("doc_id", "key"), ["doc_id", "key"], "left_semi").withColumn(
            "row", F.row_number().over(Window.partitionBy("doc_id", "key").orderBy("n"))
        ).where("row = 1").drop("row"),
        "sets",
    )
    found = links(documents, sets, s, id_col, text_col)
    counts = found.groupBy("doc_id").agg(F.sum("links").alias("n_links"))
    tied = components(found.select(F.col("doc_id").alias("a"), F.col("root").alias("b")))
    classes = (
        first.join(tied, first["doc_id"] == tied["node"], "left")
        .join(counts, "doc_id", "left")
        .select(
            "key",
            F.coalesce("label", "doc_id").alias("class_id"),
            (F.col("members") - 1).alias("n_copies"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
        )
    )
    alone = documents.where(F.col(id_col).isNull() | ~whole_text(text_col).rlike(r"[^\x20\x09-\x0D]")).select(
        F.col(id_col).cast("bigint").alias("doc_id")
    )
    return (
        embedded.select("doc_id", "key")
        .join(classes, "key")
        .select("doc_id", "class_id", "n_copies", "n_links")
        .unionByName(
            alone.select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("bigint").alias("n_copies"), F.lit(0).cast("bigint").alias("n_links"))
        )
    )
