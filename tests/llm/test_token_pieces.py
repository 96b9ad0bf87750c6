"""The piecewise encoder gives the library's ids, and remembers no long piece."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from eventloom.llm.token_files import PieceEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("seed", range(3))
def test_pieces_are_encoded_as_by_the_library(seed):
    rng = random.Random(seed)
    with open(PATH) as file:
        encoder = PieceEncoder(file.read(), remember=50)
    library = Tokenizer.from_file(PATH)
    parts = ["a", "the", " ", "  ", "\n", "\t", "　", "\xa0", "é日", "<|endoftext|>", "x" * 90, "'s", "12"]
    for _ in range(40):
        texts = ["".join(rng.choices(parts, k=rng.randrange(12))) for _ in range(rng.randrange(12))]
        sizes, ids = encoder.encode(pa.array(texts, pa.string()), 0)
        expected = [[*library.encode(t, add_special_tokens=False).ids, 0] for t in texts]
        assert sizes.tolist() == list(map(len, expected))
        assert ids.tolist() == [i for own in expected for i in own]
        assert max(map(len, encoder.known), default=0) <= 64


def test_added_token_in_a_text():
    with open(PATH) as file:
        sizes, ids = PieceEncoder(file.read()).encode(pa.array(["a <|endoftext|> b"]), 0)
    assert ids.tolist() == [64, 220, 50256, 275, 0] and np.array_equal(sizes, [5])
