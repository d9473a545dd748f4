"""Content-defined runs of fixed-size byte windows, in numpy.

Every window of ``size`` bytes has a key that depends on its bytes alone: the
smallest hash of its q-grams, the leftmost of equals being its anchor.
Neighbouring windows mostly share the anchor, so a text becomes runs of windows
with one anchor each (at most ``SPAN`` windows).  Equal windows, wherever they
are, have equal keys and lie at the same distance from their anchors.
"""

from __future__ import annotations

import numpy as np

_P = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_P, -1, 1 << 64)
SPAN = 64  # q-grams of a window: a power of two


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Runs:
    """Finds the runs of many texts at once."""

    def __init__(self, size: int = 100):
        self.size = size
        self.q = size - SPAN + 1
        self.up = _powers(1, _P)
        self.down = _powers(1, _INVERSE)

    @staticmethod
    def _mixed(h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """(text number, start, windows, anchor minus start, key, segment hash) of every
        run.  The segment hash covers all bytes of the run's windows."""
        size = self.size
        lengths = np.array([len(t) for t in texts], np.int64)
        if not len(texts) or int(lengths.max()) < size:
            return tuple(np.empty(0, np.int64) for _ in range(6))
        data = np.frombuffer(b"".join(texts), np.uint8)
        n = len(data)
        if len(self.up) < n + 1:
            self.up, self.down = _powers(n + 1, _P), _powers(n + 1, _INVERSE)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=total[1:])
        least = self._mixed((total[self.q:] - total[:-self.q]) * self.down[:n - self.q + 1])
        anchor, width = np.arange(len(least), dtype=np.int32), 1
        while width < SPAN:
            left = least[:-width] <= least[width:]
            anchor = np.where(left, anchor[:-width], anchor[width:])
            least = np.where(left, least[:-width], least[width:])
            width *= 2
        # starts of whole windows within one text
        ends = np.cumsum(lengths)
        begins = ends - lengths
        first = np.zeros(n + 1, np.int64)
        long = lengths >= size
        np.add.at(first, begins[long], 1)
        np.add.at(first, ends[long] - size + 1, -1)
        at = np.flatnonzero(np.cumsum(first)[:n])
        new = np.ones(len(at), bool)
        new[1:] = (anchor[at[1:]] != anchor[at[:-1]]) | (at[1:] != at[:-1] + 1)
        new[np.searchsorted(at, begins[long])] = True
        head = np.flatnonzero(new)
        reach = np.diff(np.append(head, len(at)))
        start = at[head]
        stop = start + reach + size - 1
        segment = self._mixed((total[stop] - total[start]) * self.down[start] + reach.astype(np.uint64) * np.uint64(_P))
        text = np.searchsorted(ends, start, "right")
        return (text, start - begins[text], reach, anchor[start] - start, least[start].view(np.int64),
                segment.view(np.int64))
