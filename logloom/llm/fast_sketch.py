"""Fast similarity sketching.

A sketch has ``t`` coordinates. In round ``i`` every element is hashed to a bin and a value; a bin keeps its smallest
value of the first round that reaches it. For ``t`` rounds the bin is random; round ``t + b`` puts all elements into
bin ``b``, so after ``2 t`` rounds every coordinate of a set that is not empty is filled. Two sketches agree in a coordinate with
the probability of the sets' Jaccard similarity, and the number of agreements is as concentrated around its mean as that
of independent draws, or more. Large sets are done after a round or two, so the work is close to one hash per element.

All sets of a slice go through the rounds together; a set leaves once its bins are full.
"""

from __future__ import annotations

import numpy as np

from .blocks import mix, seeds

_LOW = np.uint64(0xFFFFFFFF)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def sketches(sets: list[np.ndarray], t: int) -> np.ndarray:
    """(sets, t) values of 64 bits: the round in the high half, the hash in the low; sets must not be empty."""
    result = np.full((len(sets), t), _EMPTY, np.uint64)
    if not sets:
        return result
    kept = result.ravel()
    sizes = np.array([len(s) for s in sets])
    elements = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)) * t, sizes)
    for i, seed in enumerate(seeds(2 * t, 17)):
        hashed = mix(elements ^ seed)
        if i < t:
            at = owner + ((hashed >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64)
        else:
            at = owner + (i - t)
        open_bins = kept[at] == _EMPTY
        at, hashed = at[open_bins], hashed[open_bins]
        np.minimum.at(kept, at, (hashed & _LOW) + np.uint64(i << 32))
        full = (result != _EMPTY).all(axis=1) if i < 8 or i % 4 == 0 else None
        if full is not None:
            if full.all():
                break
            rest = ~full[owner // t]
            elements, owner = elements[rest], owner[rest]
    return result


def marks_of(result: np.ndarray) -> np.ndarray:
    """One byte of each coordinate; coordinates that differ share it with a chance of 1 in 256."""
    return (mix(result) & np.uint64(0xFF)).astype(np.uint8)


def band_keys(marks: np.ndarray, rows: int) -> np.ndarray:
    """(sets, t / rows) numbers: one for each band of ``rows`` (at most 8) marks and its place. Keys of a band are equal if and only if its marks are."""
    count, t = marks.shape
    bands = t // rows
    parts = np.zeros((count, bands), np.uint64)
    for k in range(rows):
        parts = (parts << np.uint64(8)) | marks[:, : bands * rows].reshape(count, bands, rows)[:, :, k]
    return mix(parts ^ seeds(bands, 23)).view(np.int64)
