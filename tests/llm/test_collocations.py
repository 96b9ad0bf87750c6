"""Phrases of the word graph against plain counting."""

import re
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest

from eventloom.llm import collocations
from eventloom.llm.catalog import QUERIES

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, mining):
    """Rows of the result from counts of every phrase by itself."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(SMALL)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, mining.max_words + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    able = {p: a for p, a in f.items() if len(p[1]) >= mining.min_words and a >= mining.min_count}
    gone = set()
    for (lang, words), a in able.items():
        for k in range(mining.min_words, len(words)):
            for i in range(len(words) - k + 1):
                inner = (lang, words[i : i + k])
                if 100 * a >= mining.absorbed_percent * f[inner]:
                    gone.add(inner)
    by_lang = defaultdict(list)
    for (lang, words), a in able.items():
        if (lang, words) not in gone:
            cuts = []
            for k in range(1, len(words)):
                left, right = f[(lang, words[:k])], f[(lang, words[k:])]
                cuts.append((1_000_000 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            phrase = " ".join(words)
            by_lang[lang].append((-score, -a, phrase.encode(), (phrase, a, left, right, n[lang], score)))
    return Counter(
        (lang, rank, *row[3]) for lang, own in by_lang.items() for rank, row in enumerate(sorted(own)[: mining.top], 1)
    )


def test_collocations(spark, odd):
    rows = pq.read_table(f"{odd}/documents.parquet", columns=["lang", "text"]).to_pylist()
    got = QUERIES["op12_collocations"](spark, odd)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    expected = plain([(r["lang"], r["text"]) for r in rows], collocations.Mining())
    assert Counter(map(tuple, got.collect())) == expected
    assert any(k[0] == "und" for k in expected) == any(r["lang"] == "und" for r in got.collect())


@pytest.mark.parametrize("min_words, max_words, top", [(2, 2, 5), (2, 4, 50), (3, 5, 50)])
def test_other_lengths(spark, min_words, max_words, top):
    text = "a b c d e. A b c d f, b c d\n\n a\ta b  c d; e f a b c! \x00 ü b c d"
    rows = [("en", text)] * 3 + [(None, text + " z"), ("und", "a b c d e f"), ("en", None), ("en", "")]
    mining = collocations.Mining(min_words, max_words, min_count=2, top=top)
    got = collocations.mine(spark.createDataFrame(rows, "lang string, text string"), mining)
    assert Counter(map(tuple, got.collect())) == plain(rows, mining)


def test_scores_are_exact_beyond_64_bits(spark):
    big = 2**40 + 1
    counted = spark.createDataFrame(
        [("en", 1, "x", big + 2), ("en", 1, "y", big + 6), ("en", 2, "x y", big)], "lang string, words int, phrase string, n bigint"
    )
    row = collocations.scored(counted, collocations.Mining()).collect()[0]
    assert row["score"] == 1_000_000 * big * big // ((big + 2) * (big + 6))
