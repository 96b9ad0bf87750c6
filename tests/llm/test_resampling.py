"""The draw by importance against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from eventloom.llm import resampling
from eventloom.llm.catalog import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, max_words=2):
    words = WORD.findall((text or "").translate(SMALL))
    return len(words), [" ".join(words[i : i + k]) for k in range(1, max_words + 1) for i in range(len(words) - k + 1)]


def drawn(documents, target, buckets=10_000, percent=25, seed=7):
    """Rows of (doc_id, n_features, weight, score, rank), ranks in one sorted list."""
    place = lambda feature: zlib.crc32(feature.encode()) % buckets
    scanned = [(i, *grams(text)) for i, text in documents]
    s = Counter(place(f) for _, _, own in scanned for f in own)
    t = Counter(place(f) for text in target for f in grams(text)[1])
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets))))
        for b in set(s)
    }
    rows = []
    for i, n, own in scanned:
        weight = sum(gain[place(f)] for f in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((n, (i, len(own), weight, score)))
    able = sorted((r for n, r in rows if n >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = {}
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        ranks.setdefault(row, []).append(rank)
    out = Counter()
    for n, row in sorted(rows, key=lambda r: -r[0]):
        left = ranks.get(row) if n >= 20 else None
        out[(*row, left.pop(0) if left else None)] += 1
    return out


def test_resampling(spark, odd, documents):
    target = pq.read_table(f"{odd}/benchmark.parquet", columns=["text"]).column(0).to_pylist()
    got = QUERIES["op11_importance_resampling"](spark, odd)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == drawn(documents, target)


def test_ties_and_repeated_rows_get_ranks_of_their_own(spark):
    rows = [(7, "a b c d e f g h i j k l m n o p q r s t")] * 8 + [(9, "short text")]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    target = spark.createDataFrame([("a b",)], "text string")
    got = resampling.resample(documents, target, resampling.Draw(percent=50)).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3, 4]
    assert [r["rank"] for r in got if r["doc_id"] == 9] == [None]


@pytest.mark.parametrize("max_words", [1, 2, 4])
def test_spans_of_the_overlapped_scan(max_words):
    rng = np.random.default_rng(max_words)
    letters = list("aZ9é日 \t.,\n\x00-")
    for _ in range(200):
        text = "".join(rng.choice(letters, int(rng.integers(0, 40))))
        words = resampling.clean(text.encode())
        got = resampling.features(words, resampling.gram_patterns(max_words), 65_536)
        assert got.tolist() == [zlib.crc32(g.encode()) % 65_536 for g in grams(text, max_words)[1]]
