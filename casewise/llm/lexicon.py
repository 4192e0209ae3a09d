"""A lexicon of words as a minimal acyclic transducer in arrays.

Words that end alike share their last states. Each transition carries how many words come before those behind it, so
the sum along a path is the word's number, and the number gives the word's ids. The arrays lie in one file that workers
map into memory; many words are walked through the automaton at once, one byte at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_PARTS = (("keys", np.int64), ("target", np.int32), ("before", np.int32), ("final", np.uint8), ("ids_at", np.int64), ("ids", np.int32))


def minimal_automaton(words: Sequence[bytes]) -> tuple[list[dict[int, int]], list[bool]]:
    """(transitions, final) of each state for distinct words in byte order; state 0 is the last state made, the start.

    Words are added in order. When one leaves the path of the word before, the states behind the fork cannot change any
    more, and each is replaced by an equal state if there is one.
    """
    edges: list[dict[int, int]] = [{}]
    final = [False]
    known: dict[tuple, int] = {}
    path = [0]  # states of the last word, not yet shared

    def share(down_to: int, word: bytes) -> None:
        while len(path) - 1 > down_to:
            state = path.pop()
            look = (final[state], *sorted(edges[state].items()))
            same = known.setdefault(look, state)
            edges[path[-1]][word[len(path) - 1]] = same

    last = b""
    for word in words:
        common = 0
        for a, b in zip(last, word):
            if a != b:
                break
            common += 1
        share(common, last)
        for byte in word[common:]:
            edges.append({})
            final.append(False)
            edges[path[-1]][byte] = len(edges) - 1
            path.append(len(edges) - 1)
        final[path[-1]] = True
        last = word
    share(0, last)
    return edges, final


def compile_lexicon(words: Sequence[bytes], ids: np.ndarray, counts: np.ndarray) -> bytes:
    """The file of the lexicon; ``ids`` are those of the words laid end to end."""
    order = sorted(range(len(words)), key=words.__getitem__)
    edges, final = minimal_automaton([words[i] for i in order])
    reached, number, stack, below = [0], {0: 0}, [0], {}
    while stack:  # children before parents
        state = stack[-1]
        waiting = [t for t in edges[state].values() if t not in below]
        if waiting:
            stack += waiting
            continue
        stack.pop()
        below[state] = final[state] + sum(below[t] for t in edges[state].values())
    for state in reached:
        for _, target in sorted(edges[state].items()):
            if target not in number:
                number[target] = len(reached)
                reached.append(target)
    keys, targets, before = [], [], []
    for state in reached:
        passed = int(final[state])
        for byte, target in sorted(edges[state].items()):
            keys.append(number[state] << 8 | byte)
            targets.append(number[target])
            before.append(passed)
            passed += below[target]
    offsets = np.concatenate([[0], np.cumsum(counts)])
    ordered = np.concatenate([ids[offsets[i] : offsets[i + 1]] for i in order]) if order else ids
    arrays = (
        keys, targets, before, [final[s] for s in reached],
        np.concatenate([[0], np.cumsum(counts[order])]) if order else [0], ordered,
    )
    out = [np.asarray(a, kind) for a, (_, kind) in zip(arrays, _PARTS)]
    head = np.array([len(a) for a in out], np.int64)
    return head.tobytes() + b"".join(a.tobytes() + b"\0" * (-a.nbytes % 8) for a in out)


class Lexicon:
    """A lexicon file mapped into memory."""

    def __init__(self, path: str):
        head = np.fromfile(path, np.int64, len(_PARTS))
        at = head.nbytes
        for (name, kind), n in zip(_PARTS, head.tolist()):
            setattr(self, name, np.memmap(path, kind, "r", at, (n,)) if n else np.zeros(0, kind))
            at += -(-n * np.dtype(kind).itemsize // 8) * 8

    def numbers(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of each span of bytes, -1 if it is no word of the lexicon."""
        state, total = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        active, at = np.arange(len(start)), start.copy()
        if not len(self.keys):
            return np.full(len(start), -1)
        while True:
            active = active[at[active] < end[active]]
            if not len(active):
                break
            keys = state[active] << 8 | data[at[active]]
            place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            there = self.keys[place] == keys
            state[active[~there]] = -1
            active, place = active[there], place[there]
            state[active] = self.target[place]
            total[active] += self.before[place]
            at[active] += 1
        return np.where((state >= 0) & (self.final[np.maximum(state, 0)] > 0), total, -1)
