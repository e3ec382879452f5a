"""Windows of a sequence gathered into runs that share an anchor.

Every window of `size` symbols has an anchor: of the `gram`-symbol pieces inside it the
one with the least hash, the leftmost of equals. The anchor depends on the window's
content alone, so equal windows have equal anchors at equal places. Neighbouring windows
mostly share one; a run is a maximal series of them. Repeats are then sought among runs
with equal anchors only, of which there are about 2 / (size - gram + 2) a symbol.
"""

from __future__ import annotations

import numpy as np

_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)
_PLACE = np.uint64(0xFFFFFFFF)


def mixed(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers one to one, so that order and low bits say nothing of the input."""
    values = values.astype(np.uint64)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xC4CEB9FE1A85EC53)
    values ^= values >> np.uint64(33)
    return values


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """For every `width` neighbouring values, where the least of them is, the leftmost of equals.

    Compared by their upper halves; minima running from either end of blocks of `width` values
    meet in the middle of every window.
    """
    n = len(values)
    if n < width:
        return np.zeros(0, np.int64)
    keys = np.full(-(-n // width) * width, _LAST, np.uint64)
    keys[:n] = (values & ~_PLACE) | np.arange(n, dtype=np.uint64)
    blocks = keys.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[: n - width + 1], ahead[width - 1 : n])
    return (least & _PLACE).astype(np.int64)


def runs_of(grams: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows: where the first starts, how many windows, where their anchor is.

    `grams` holds the hash of the piece that starts at each symbol that a piece can start at.
    """
    anchors = leftmost_least(grams, size - gram + 1)
    if not len(anchors):
        return anchors, anchors, anchors
    starts = np.flatnonzero(np.diff(anchors, prepend=-1))
    return starts, np.diff(starts, append=len(anchors)), anchors[starts]
