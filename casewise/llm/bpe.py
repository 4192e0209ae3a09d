"""Byte-pair merging of many words at once, exactly as the merge list of a tokenizer file says."""

from __future__ import annotations

import heapq
import json
from collections.abc import Sequence

import numpy as np

from casewise.llm.common import Numbers, mixed

#: Words of more symbols are merged one at a time with a heap.
WIDEST = 64
_NONE = np.int32(1 << 30)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the files of byte-level tokenizers.

    Printable bytes stand for themselves; the others are numbered from U+0100 on.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters, extra = [], 0x100
    for byte in range(256):
        letters.append(chr(byte if byte in printable else extra))
        extra += byte not in printable
    return letters


class Merges:
    """The vocabulary and merges of a tokenizer file with a byte-level BPE model."""

    def __init__(self, content: str):
        whole = json.loads(content)
        model = whole["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in whole["added_tokens"]}
        self.suffix = model.get("end_of_word_suffix") or ""
        letters = byte_letters()
        self.first = np.array([self.vocab[x] for x in letters], np.int32)
        self.last = np.array([self.vocab[x + self.suffix] for x in letters], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        joined = [self.vocab[a + b] for a, b in pairs]
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, ((a, b), whole_id) in enumerate(zip(pairs, joined)):
            self.ranks.setdefault((self.vocab[a], self.vocab[b]), (rank, whole_id))
        self.pairs = Numbers()
        self.pairs.add(_pair(*np.array([*self.ranks], np.int64).reshape(-1, 2).T))
        # of pair -1, which is none: the last
        self.rank = np.array([*(r for r, _ in self.ranks.values()), _NONE], np.int32)
        self.result = np.array([*(w for _, w in self.ranks.values()), -1], np.int32)

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (``_NONE`` without one) and what it becomes. A symbol of -1 is in no pair."""
        number = self.pairs.find(_pair(left, right))
        return self.rank[number], self.result[number]

    def _merge_block(self, symbols: np.ndarray) -> np.ndarray:
        """Merge every row (padded with -1) to the end: always its lowest rank, the leftmost of equal ones.

        A merged symbol stands in the place of its first part, and -1 in that of the second.
        """
        rows, width = symbols.shape
        if width < 2:
            return symbols
        wide = np.full((rows, width + 2), -1, np.int32)  # a place on each side, so neighbours exist
        wide[:, 1:-1] = symbols
        step = width + 2
        flat = wide.ravel()
        ranks, becomes = np.full((rows, step), _NONE, np.int32), np.full(rows * step, -1, np.int32)
        found = self._look_up(symbols[:, :-1].ravel(), symbols[:, 1:].ravel())
        ranks[:, 1 : width], becomes.reshape(rows, step)[:, 1 : width] = (x.reshape(rows, width - 1) for x in found)
        each = ranks.ravel()
        after, before = np.arange(1, rows * step + 1), np.arange(-1, rows * step - 1)
        active = np.arange(rows)
        while True:
            at = ranks[active].argmin(1) + active * step
            going = each[at] < _NONE
            active, at = active[going], at[going]
            if not len(active):
                return wide[:, 1:-1]
            gone = after[at]
            right, left = after[gone], before[at]
            flat[at], flat[gone] = becomes[at], -1
            each[gone] = _NONE
            after[at], before[right] = right, at
            firsts = np.concatenate([at, left])
            each[firsts], becomes[firsts] = self._look_up(flat[firsts], flat[np.concatenate([right, at])])

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """One word, with a heap of (rank, place) and links between the symbols left."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(self.ranks[p][0], i, p) for i, p in enumerate(zip(symbols, symbols[1:])) if p in self.ranks]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i] if symbols[i] >= 0 else n
            if j >= n or (symbols[i], symbols[j]) != pair:
                continue
            symbols[i], symbols[j] = self.ranks[pair][1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n:
                    near = (symbols[k], symbols[after[k]])
                    if near in self.ranks:
                        heapq.heappush(heap, (self.ranks[near][0], k, near))
        return [s for s in symbols if s >= 0]

    def symbols_of(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Start symbols of words laid end to end; ``ends`` are the ends of the non-empty ones."""
        symbols = self.first[data]
        symbols[ends - 1] = self.last[data[ends - 1]]
        return symbols

    def encode(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words laid end to end, number of ids of each word)."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        symbols = self.symbols_of(data, offsets[1:][sizes > 0])
        return self.merge(symbols, offsets)

    def merge(self, symbols: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for words given as symbols."""
        sizes = np.diff(offsets)
        counts = np.zeros(len(sizes), np.int64)
        out = np.full(len(symbols), -1, np.int32)
        low = 0
        for width in (1, 4, 8, 12, 16, 24, 32, WIDEST):
            for rows in np.array_split(*_blocks(np.flatnonzero((sizes > low) & (sizes <= width)), width)):
                if len(rows):
                    columns = np.arange(width)
                    inside = columns < sizes[rows][:, None]
                    places = np.minimum(offsets[rows][:, None] + columns, len(symbols) - 1)
                    block = self._merge_block(np.where(inside, symbols[places], -1).astype(np.int32))
                    out[places[inside]] = block[inside]
                    counts[rows] = (block >= 0).sum(1)
            low = width
        for row in np.flatnonzero(sizes > WIDEST).tolist():
            ids = self._merge_long(symbols[offsets[row] : offsets[row + 1]].tolist())
            out[offsets[row] : offsets[row] + len(ids)] = ids
            counts[row] = len(ids)
        return out[out >= 0], counts


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A different hash for each pair of symbols."""
    return mixed(left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64) & np.uint64(0xFFFFFFFF))


def _blocks(rows: np.ndarray, width: int) -> tuple[np.ndarray, int]:
    """Blocks of about a million symbols."""
    return rows, max(1, len(rows) * width >> 20)


def gather(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs ``flat[start : start + count]`` laid end to end."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - counts), counts) + np.arange(total)]
