"""What a Python worker knows about the distinct words it has met, kept from one batch to the next."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from casewise.llm.bpe import gather
from casewise.llm.common import Numbers
from casewise.llm.pretokens import Words

#: The table is emptied when it holds so many words or values; it is a store of results, so nothing else changes.
MOST_WORDS, MOST_VALUES = 250_000, 5_000_000


class WordTable:
    """Hash of a word -> a run of numbers, found by ``compute`` for words not seen before."""

    def __init__(self, compute: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], kind):
        self.compute, self.kind = compute, kind
        self._clear()

    def _clear(self) -> None:
        self.numbers = Numbers()
        self.values = np.zeros(1 << 16, self.kind)
        self.start = np.zeros(1 << 16, np.int64)
        self.count = np.zeros(1 << 16, np.int64)
        self.n_words = self.n_values = 0

    def _append(self, flat: np.ndarray, counts: np.ndarray) -> None:
        starts = self.n_values + np.cumsum(counts) - counts
        for name, new, used in (("values", flat, self.n_values), ("start", starts, self.n_words), ("count", counts, self.n_words)):
            array = getattr(self, name)
            if used + len(new) > len(array):
                array = np.concatenate([array, np.zeros(max(len(array), len(new)), array.dtype)])
                setattr(self, name, array)
            array[used : used + len(new)] = new
        self.n_words += len(counts)
        self.n_values += len(flat)

    def look_up(self, words: Words) -> np.ndarray:
        """Place of each word in the table."""
        if self.n_words > MOST_WORDS or self.n_values > MOST_VALUES:
            self._clear()
        hashes = words.hashes()
        places = self.numbers.find(hashes)
        missing = np.flatnonzero(places < 0)
        if len(missing):
            distinct, first = np.unique(hashes[missing], return_index=True)
            at = missing[first]
            flat, counts = self.compute(
                words.data, words.byte_at[words.start[at]], words.byte_at[words.end[at]], words.special[at]
            )
            self.numbers.add(distinct)
            self._append(flat, counts)
            places[missing] = self.numbers.find(hashes[missing])
        return places

    def runs(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the words laid end to end, how many each word has)."""
        counts = self.count[places]
        return gather(self.values, self.start[places], counts), counts
