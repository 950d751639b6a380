"""A minimal acyclic transducer from sorted byte strings to their ordinals.

States that accept the same endings are one state; each arc carries how many
strings come before those it leads to, so the sum along a string's path is its
ordinal. Many strings are looked up at once, byte by byte, over sorted arrays.

Only the first ``HEAD`` bytes of a string are states; what a longer one has
beyond them is kept beside its head, so that a string of any length costs little
more than its own bytes.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from itertools import groupby

import numpy as np

HEAD = 256


@dataclass
class Transducer:
    """``arcs`` holds ``state << 8 | byte`` in ascending order; the last state is the start."""

    arcs: np.ndarray
    targets: np.ndarray
    before: np.ndarray
    final: np.ndarray
    #: Ordinal of the first string with each head where there are tails, and the number of strings at its end.
    starts: np.ndarray
    #: Endings beyond the head with their places, by head.
    tails: dict[int, dict[bytes, int]]

    @property
    def size(self) -> int:
        return int(self.starts[-1])

    def dump(self) -> bytes:
        return pickle.dumps(self)

    def _heads(self, heads: Sequence[bytes]) -> np.ndarray:
        """Ordinals among the heads; -1: not there."""
        n = len(heads)
        lengths = np.fromiter(map(len, heads), np.int64, n)
        text = np.frombuffer(b"".join(heads), np.uint8)
        starts = np.cumsum(lengths) - lengths
        out = np.full(n, -1, np.int64)
        live, total = np.arange(n), np.zeros(n, np.int32)
        state = np.full(n, len(self.final) - 1, np.uint32)
        place = 0
        while live.size:
            ended = lengths[live] == place
            if ended.any():
                out[live[ended]] = np.where(self.final[state[ended]], total[ended], -1)
                live, state, total = live[~ended], state[~ended], total[~ended]
            if not live.size or not self.arcs.size:
                break
            wanted = state << np.uint32(8) | text[starts[live] + place]
            at = np.minimum(np.searchsorted(self.arcs, wanted), len(self.arcs) - 1)
            there = self.arcs[at] == wanted
            live, at = live[there], at[there]
            state, total = self.targets[at], total[there] + self.before[at]
            place += 1
        return out

    def ordinals(self, strings: Sequence[bytes]) -> np.ndarray:
        """The ordinal of each string; -1: not in the vocabulary."""
        if not self.tails:
            return self._heads(strings)
        head = self._heads([s[:HEAD] for s in strings])
        out = np.where(head >= 0, self.starts[head], -1)
        for i, s in enumerate(strings):
            if len(s) >= HEAD and head[i] >= 0:
                place = self.tails[int(head[i])].get(s[HEAD:])
                out[i] = -1 if place is None else out[i] + place
        return out


def load(body: bytes) -> Transducer:
    return pickle.loads(body)


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common beginning."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


def build(strings: Iterable[bytes]) -> Transducer:
    """From strings in ascending order, each once; their heads may need 2^24 states."""
    known: dict[tuple[int, ...], int] = {}  # final, then byte and target of each arc
    path: list[list[int]] = [[0]]
    before_head = b""
    starts, tails = [0], {}

    def close(depth: int) -> None:
        """States deeper than ``depth`` get no more arcs: each becomes one that is known, or a new one."""
        while len(path) - 1 > depth:
            state = tuple(path.pop())
            path[-1] += (before_head[len(path) - 1], known.setdefault(state, len(known)))

    for head, group in groupby(strings, key=lambda s: s[:HEAD]):
        members = list(group)
        if len(head) == HEAD:
            tails[len(starts) - 1] = {s[HEAD:]: i for i, s in enumerate(members)}
        starts.append(starts[-1] + len(members))
        close(_shared(before_head, head))
        path += ([0] for _ in range(len(head) - len(path) + 1))
        path[-1][0] = 1
        before_head = head
    close(0)
    known.setdefault(tuple(path[0]), len(known))
    if len(known) >= 1 << 24:
        raise ValueError("too many strings for one transducer")

    arcs, targets, before, final, accepted = [], [], [], [], []
    for state, (ends, *moves) in enumerate(known):  # targets come before the states that lead to them
        count = ends
        for byte, target in zip(moves[::2], moves[1::2], strict=True):
            arcs.append(state << 8 | byte)
            targets.append(target)
            before.append(count)
            count += accepted[target]
        final.append(bool(ends))
        accepted.append(count)
    return Transducer(
        np.array(arcs, np.uint32),
        np.array(targets, np.uint32),
        np.array(before, np.int32),
        np.array(final, bool),
        np.array(starts if tails else starts[-1:], np.int64),
        tails,
    )
