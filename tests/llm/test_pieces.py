"""Texts are cut into few distinct pieces, of which the same ids come as of whole texts."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from eventloom.llm import byte_bpe, token_files
from eventloom.llm.pieces import cut, marks

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["ab", "N1", " ", "  ", "\n", "\x1c", "　", "\xa0", "é日", "<|endoftext|>", "'s", "n't", ".", "|", "-", "_#", "…", "😀"]


def test_words_with_and_without_punctuation_share_a_piece():
    pieces, counts = cut(pa.array(["the end.", "the end, <|x|>", "", "end"]), marks("<|x|>"))
    assert pieces.to_pylist() == ["the", " end", ".", "the", " end", ",", " <|x|>", "end"] and counts.tolist() == [3, 4, 0, 1]
    assert "".join(byte_bpe.chunks("tell-tale")) == "tell-tale" and byte_bpe.chunks("tell-tale's.") == ["tell", "-tale's", "."]


@pytest.mark.parametrize("any_white", [False, True])
def test_white_space_beyond_ascii_is_no_obstacle(any_white):
    text = "a b　 c d. e \xa0f"
    pieces, _ = cut(pa.array([text]), marks(), any_white)
    assert pieces.to_pylist() == ["a", " b　 c", " d", ".", " e \xa0f"]


@pytest.mark.parametrize("seed", range(3))
def test_ids_of_both_encoders_on_odd_texts(seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(14))) for _ in range(600)]
    library = Tokenizer.from_file(PATH)
    with open(PATH) as file:
        sizes, ids = token_files.PieceEncoder(file.read(), remember=40).encode(pa.array(texts), 0)
    assert ids.tolist() == [i for t in texts for i in [*library.encode(t, add_special_tokens=False).ids, 0]]
    find = byte_bpe.word_pattern(public_tokenizers.PATTERN).findall
    assert all([w for c in byte_bpe.chunks(t) for w in find(c)] == find(t) for t in texts)


def test_pieces_in_use_outlive_the_others():
    with open(PATH) as file:
        encoder = token_files.PieceEncoder(file.read() + " ", remember=20)
    encoded = []
    batch = encoder.tokenizer.encode_batch_fast

    class Counted:
        def encode_batch_fast(self, part, **options):
            encoded.extend(part)
            return batch(part, **options)

    encoder.tokenizer = Counted()
    for k in range(40):
        encoder.encode(pa.array(["the " + " ".join(f"w{k}x{i}" for i in range(5))]), 0)
        assert sum(map(len, encoder.memory)) <= 20 + 2 * 6
    assert encoded.count("the") == 1


def test_empty_and_null_texts(spark):
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    rows = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    got = byte_bpe.encode(rows, ranks, public_tokenizers.PATTERN, {"doc_id": rows.doc_id}).collect()
    assert sorted(r["doc_id"] for r in got) == [1, 2] and all(r["ids"] == [] for r in got)
    assert np.unique([r["ids_sha256"] for r in got]).size == 1
