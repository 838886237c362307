"""Sets of five-word shingles of whole texts, as sorted arrays of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .blocks import Flat, mix, seeds, word_hashes, words_of

WIDTH = 5
_PLACES = seeds(WIDTH, 11) | np.uint64(1)


def shingle_sets(flat: Flat) -> Iterator[np.ndarray]:
    """For each text its distinct shingles; a text of fewer words has its whole sequence as one, an empty one none.

    Words are separated by ASCII white space and compared with A-Z as a-z.
    """
    words = words_of(flat)
    hashes = word_hashes(flat, words)
    size = max(0, len(hashes) - WIDTH + 1)
    whole = np.zeros(size, np.uint64)
    for k in range(WIDTH):
        whole += hashes[k : k + size] * _PLACES[k]
    whole = mix(whole)
    for begin, end in zip(words.first[:-1], words.first[1:], strict=True):
        if end - begin >= WIDTH:
            yield np.unique(whole[begin : end - WIDTH + 1])
        elif end > begin:
            short = (hashes[begin:end] * _PLACES[: end - begin]).sum(dtype=np.uint64, keepdims=True)
            yield mix(short ^ np.uint64(end - begin))
        else:
            yield np.zeros(0, np.uint64)


def digest_of(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that two sets share only if they are equal, but for a chance of 2**-128 or so a pair."""
    low, high = (mix(shingles ^ seed) for seed in seeds(2, 13))
    return tuple(int(x) for x in np.array([low.sum(dtype=np.uint64), high.sum(dtype=np.uint64)]).view(np.int64))
