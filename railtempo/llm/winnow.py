"""Where texts repeat: content-chosen places ("anchors"), so that only texts that share one need comparing.

A window of `span` units holds span - gram + 1 grams; the places of its least gram hash are its anchors. Equal windows
have the same anchors at the same offsets, so windows need comparing only around anchors whose gram occurs again.
"""

from __future__ import annotations

import numpy as np

MIX = np.uint64(0x9E3779B97F4A7C15)
_RANDOM = np.random.default_rng(7)
BYTE = _RANDOM.integers(1, 2**63, 256, np.uint64) | np.uint64(1)
PLACE = _RANDOM.integers(1, 2**63, 4096, np.uint64) | np.uint64(1)
#: Units whose windows are looked at together.
PIECE = 1 << 15


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * MIX
    return h ^ (h >> np.uint64(29))


def gram_hashes(units: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each run of `gram` units, a power of two."""
    h, size = units, 1
    while size < gram:
        h = mixed(h[:-size] * MIX + h[size:]) if size == 1 else h[:-size] * (MIX + np.uint64(2 * size)) + h[size:]
        size *= 2
    return mixed(h)


def sliding(values: np.ndarray, size: int, least) -> np.ndarray:
    """least (np.minimum or np.maximum) of each `size` values in a row."""
    have = 1
    while have < size:
        step = min(have, size - have)
        values = least(values[:-step], values[step:])
        have += step
    return values


def anchors(units: np.ndarray, begins: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of all windows that lie within one text.

    units: of all texts, one after the other; text i has begins[i] to begins[i + 1].
    """
    ends_at = np.repeat(begins[1:], np.diff(begins)) if len(units) else np.zeros(0, np.int64)
    grams = span - gram + 1
    found: list[np.ndarray] = []
    hashes: list[np.ndarray] = []
    for at in range(0, max(0, len(units) - span + 1), PIECE):
        upto = min(at + PIECE, len(units) - span + 1)
        inside = ends_at[at:upto] >= np.arange(at + span, upto + span)
        if not inside.any():
            continue
        h = gram_hashes(units[at : upto + span - 1], gram) | np.uint64(1)
        low = np.where(inside, sliding(h, grams, np.minimum), np.uint64(0))
        edge = np.zeros(grams - 1, np.uint64)
        best = sliding(np.concatenate([edge, low, edge]), grams, np.maximum)
        places = np.flatnonzero(best == h)
        found.append(places + at)
        hashes.append(h[places])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    places, first = np.unique(np.concatenate(found), return_index=True)
    return places, np.concatenate(hashes)[first]


def word_places(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and for each text where its words begin and end among them."""
    inked = (data != 32) & ((data < 9) | (data > 13))
    heads = inked.copy()
    heads[1:] &= ~inked[:-1]
    edges = begins[:-1][np.diff(begins) > 0]
    heads[edges] = inked[edges]
    starts = np.flatnonzero(heads)
    bounds = np.searchsorted(starts, begins)
    hashes = np.zeros(len(starts), np.uint64)
    per = 1 << 16
    for at in range(0, len(starts), per):
        mine = starts[at : at + per]
        stop = starts[at + per] if at + per < len(starts) else len(data)
        ink = np.flatnonzero(inked[mine[0] : stop])
        own = np.searchsorted(ink, mine - mine[0])
        deep = ink - np.repeat(ink[own], np.diff(np.append(own, len(ink))))
        hashes[at : at + per] = np.add.reduceat(BYTE[data[mine[0] : stop][ink]] * PLACE[deep & 4095], own)
    return mixed(hashes), bounds, starts
