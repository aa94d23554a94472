"""White-space words of a batch of texts as numbers, found with array operations only."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True  # the bytes that separate words


class Words(NamedTuple):
    number: np.ndarray   # of each word, in order: its place in ``names``
    text: np.ndarray     # the text that each word lies in
    start: np.ndarray    # byte range in ``body``
    end: np.ndarray
    names: pa.Array      # the distinct words (binary)
    body: np.ndarray     # all texts, each with a line feed behind it


def find_words(bodies: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``body``, ``start``, ``end`` and ``text`` of all words (null has none)."""
    body = np.frombuffer(b"\n".join([b or b"" for b in bodies] + [b""]), np.uint8)
    edge = np.flatnonzero(np.diff(np.r_[True, SPACE[body]].view(np.int8)))
    start, end = edge[0::2], edge[1::2]  # the line feed at the end closes the last word
    ends = np.cumsum([len(b or b"") + 1 for b in bodies], dtype=np.int64)
    return body, start, end, np.searchsorted(ends, start, "right")


def number_words(body: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """``number`` and ``names`` of words that cover all bytes but white space, in order."""
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=offsets[1:])
    packed = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(body[~SPACE[body]])])
    coded = packed.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary


def split_words(bodies: list[bytes | None]) -> Words:
    """All words of all texts."""
    body, start, end, text = find_words(bodies)
    number, names = number_words(body, start, end)
    return Words(number, text, start, end, names, body)
