"""Parts of the byte-level encoder by themselves."""

import random

import numpy as np
import public_tokenizers
import pytest

from eventloom.llm import byte_bpe


@pytest.mark.parametrize("seed", range(4))
def test_no_word_goes_across_chunks(seed):
    rng = random.Random(seed)
    find = byte_bpe.word_pattern(public_tokenizers.PATTERN).findall
    letters = "ab'sT  \n\t\x1c\x85\xa0　é日١12#!"
    for _ in range(2000):
        text = "".join(rng.choices(letters, k=rng.randrange(30)))
        cut = byte_bpe.chunks(text)
        assert "".join(cut) == text
        assert [w for c in cut for w in find(c)] == find(text)
        assert all(find(w) == [w] for w in find(text))  # a word alone is one word


def test_words_are_folded_once_and_found_by_task(spark, new_folder):
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    texts = spark.createDataFrame([("the cat sat on the mat",)] * 9 + [("x" * 300,), (None,)], "text string").repartition(3)
    named = byte_bpe.words_by_task(texts, public_tokenizers.PATTERN)
    folded = byte_bpe.fold_words(named, byte_bpe.MergeTable(ranks)).collect()
    words = {r["word"] for r in folded}
    assert words == {"the", " cat", " sat", " on", " the", " mat"}  # the long one is left to the heap
    for r in folded:
        got = np.frombuffer(r["ids"], "<u4").tolist()
        assert got == byte_bpe.merge_by_heap(r["word"].encode(), ranks)
