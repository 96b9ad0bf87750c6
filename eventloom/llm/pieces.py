"""Texts cut where no token of a byte-level tokenizer goes across, so that most pieces come again and again."""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The characters of Unicode's White_Space property, in ASCII and beyond.
ASCII_WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
WHITE_BEYOND_ASCII = r"[\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
# Four control characters more, which some engines take for white space.
PERHAPS_WHITE = ASCII_WHITE | np.isin(np.arange(256), [28, 29, 30, 31])
LETTER_OR_DIGIT = np.isin(np.arange(256), list((string.ascii_letters + string.digits).encode()))


def marks(but: str = "") -> np.ndarray:
    """ASCII punctuation as a table over bytes, without the apostrophe, which may be in a word, and those in ``but``."""
    return np.isin(np.arange(256), [ord(c) for c in string.punctuation if c not in "'" + but])


def cut(texts: pa.StringArray, before: np.ndarray, any_white: bool = False) -> tuple[pa.LargeStringArray, np.ndarray]:
    """Pieces, which share the texts' memory, and each text's number of pieces.

    A cut is before a blank between two other characters, with ``any_white`` before each white space
    that follows another character, and before one of the marks ``before`` that follows an ASCII letter
    or digit. In texts with white space beyond ASCII, blanks next to such characters are no place to cut.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    start = offsets[0]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[start : offsets[-1]]
    offsets = offsets - start
    white = PERHAPS_WHITE[data]
    begins = np.zeros(len(data) + 1, bool)
    if any_white:
        begins[1:-1] = ASCII_WHITE[data[1:]] & ~white[:-1]
    else:
        begins[1:-2] = (data[1:-1] == 32) & ~white[:-2] & ~white[2:]
    for k in np.flatnonzero(pc.match_substring_regex(texts, WHITE_BEYOND_ASCII).to_numpy(zero_copy_only=False)):
        own, ascii_only = begins[offsets[k] : offsets[k + 1]], data[offsets[k] : offsets[k + 1]] < 128
        own[1:] &= ascii_only[:-1]
        own[:-1] &= ascii_only[1:]
    begins[1:-1] |= before[data[1:]] & LETTER_OR_DIGIT[data[:-1]]
    begins[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
    places = np.flatnonzero(begins[:-1])
    counts = np.searchsorted(places, offsets[1:]) - np.searchsorted(places, offsets[:-1])
    bounds = np.append(places, len(data)).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(places), pa.py_buffer(bounds), pa.py_buffer(data)), counts


def lists(coded: list[bytes], number: type) -> pa.LargeListArray:
    """Numbers as bytes of 32 bits each as a list array, of which texts are put together by ``take``."""
    bounds = np.cumsum(np.fromiter(map(len, [b"", *coded]), np.int64, len(coded) + 1)) // 4
    return pa.LargeListArray.from_arrays(pa.array(bounds), pa.array(np.frombuffer(b"".join(coded), number)))
