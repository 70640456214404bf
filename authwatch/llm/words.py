"""Words of texts as numbers: maximal runs of bytes other than blank and \\t to \\r."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa

from authwatch.llm.batches import encoded
from authwatch.llm.rolling import PrefixHash, mix

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_bounds(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Joined bytes, starts and stops of words in them, and words before each text."""
    joined = np.frombuffer(b" " + b" ".join(parts) + b" ", np.uint8)
    space = IS_SPACE[joined]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, stops = edges[::2], edges[1::2]
    sizes = np.array([len(x) + 1 for x in parts], np.int64)
    begins = np.concatenate([[1], 1 + np.cumsum(sizes)])
    return joined, starts, stops, np.searchsorted(starts, begins)


def word_symbols(column: pa.Array, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash per word, and the bounds of the texts among the words.

    A ``salt`` other than 0 takes BLAKE2b, in which no two words can be made to collide.
    """
    parts = encoded(column)
    joined, starts, stops, bounds = word_bounds(parts)
    if salt:
        mark = salt.to_bytes(2)
        return np.frombuffer(b"".join(
            blake2b(word, digest_size=8, salt=mark).digest()
            for part in parts for word in part.split()), np.uint64), bounds.astype(np.int64)
    hashes = PrefixHash(joined).of(starts, stops)
    return mix(hashes + (stops - starts).astype(np.uint64)), bounds.astype(np.int64)
