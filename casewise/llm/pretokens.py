"""Cutting texts into the words that byte-pair merging works on, for many texts at once.

Two rules are known, those of the two tokenizer files: "word" (lower case, white space dropped, digits alone) and "byte"
(white space kept, one space leads the word after it). Strings of added tokens in a text are words of their own.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

from casewise.llm.common import span_hashes

LETTER, NUMBER, SPACE, OTHER = range(4)
#: The Unicode property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@functools.lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """Kind of each code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    for code in range(0x110000):
        category = unicodedata.category(chr(code))[0]
        if category in "LN":
            table[code] = LETTER if category == "L" else NUMBER
    table[WHITE_SPACE] = SPACE
    return table


@dataclass
class Words:
    """Words of many texts in order. Places are code points of all texts laid end to end."""

    codes: np.ndarray
    data: np.ndarray  # the same in UTF-8
    byte_at: np.ndarray  # place -> place in data
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    special: np.ndarray  # id of an added token, or -1
    text_offsets: np.ndarray

    def hashes(self) -> np.ndarray:
        found = span_hashes(self.data, self.byte_at[self.start], self.byte_at[self.end])
        return np.where(self.special >= 0, self.special.astype(np.uint64), found)


def normal_words(text: str) -> str:
    """The normal form of the "word" rule, white space apart. Each letter is lower-cased by itself."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return text.lower()


def _segments(texts: Sequence[str], special: dict[str, int], rule: str):
    """(text pieces, their rows, ids of the added tokens that are pieces)."""
    parts, rows, ids = [], [], []
    pattern = re.compile("|".join(map(re.escape, special))) if special else None
    shape = normal_words if rule == "word" else str
    for row, text in enumerate(texts):
        at = 0
        if pattern and "<" in text:
            for match in pattern.finditer(text):
                for part, token in ((shape(text[at : match.start()]), -1), (match.group(), special[match.group()])):
                    parts.append(part)
                    rows.append(row)
                    ids.append(token)
                at = match.end()
        parts.append(shape(text[at:] if at else text))
        rows.append(row)
        ids.append(-1)
    return parts, np.array(rows, np.int64), np.array(ids, np.int64)


def split(texts: Sequence[str], special: dict[str, int], rule: str) -> Words:
    parts, part_rows, part_ids = _segments(texts, special, rule)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    whole = "".join(parts)
    codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    data = np.frombuffer(whole.encode("utf-8", "surrogatepass"), np.uint8)
    byte_at = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000), out=byte_at[1:])
    ends_at = np.cumsum(sizes)
    starts_at = ends_at - sizes
    n = len(codes)
    # one place more on each side, so neighbours of the first and the last exist
    kind = np.full(n + 2, SPACE, np.uint8)
    kind[1:-1] = kinds()[codes]
    edge = np.zeros(n + 2, bool)  # a part starts here
    edge[starts_at + 1] = True
    edge[n + 1] = True
    own, before, after = kind[1:-1], kind[:-2], kind[2:]
    edge_own, edge_after = edge[1:-1], edge[2:]
    start = (own != before) | edge_own
    if rule == "word":
        start |= own == NUMBER
    else:
        # the last character of a white-space run is alone, unless the text ends; as a space it leads the next word
        last_space = (own == SPACE) & (after != SPACE) & ~edge_after
        start |= last_space
        leads = np.flatnonzero(last_space & (codes == 0x20))
        start[leads + 1] = False
    _contractions(codes, own, before, edge, start, rule)
    inside = own != SPACE if rule == "word" else np.ones(n, bool)
    given = np.flatnonzero(part_ids >= 0)
    for part in given.tolist():
        start[starts_at[part] : ends_at[part]] = False
        start[starts_at[part]] = inside[starts_at[part]] = True
    begin = np.flatnonzero(start & inside)
    if rule == "word":
        stop_mark = np.ones(n + 1, bool)
        stop_mark[:-1] = start | ~inside | edge_own
        stops = np.flatnonzero(stop_mark)
        end = stops[np.searchsorted(stops, begin, "right")] if len(begin) else begin
    else:
        end = np.append(begin[1:], n) if len(begin) else begin
    part_of = np.searchsorted(ends_at, begin, "right")
    rows = part_rows[part_of] if len(begin) else begin
    token = part_ids[part_of] if len(begin) else begin
    lengths = np.bincount(part_rows, sizes, len(texts)).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    return Words(codes, data, byte_at, begin, end, rows, token, offsets)


def _contractions(codes, own, before, edge, start, rule) -> None:
    """An apostrophe that begins a word takes s, t, m, d, re, ve or ll with it; the letters after that are a new word."""
    marks = np.flatnonzero((codes == 0x27) & ((before != OTHER) | edge[1:-1]))
    n = len(codes)
    for at in marks.tolist():
        if rule == "byte" and at and codes[at - 1] == 0x20 and not edge[at + 1]:
            continue
        ending = ""
        for step in (1, 2):
            if at + step < n and not edge[at + step + 1]:
                ending += chr(codes[at + step])
            else:
                break
        taken = 1 if ending[:1] in ("s", "t", "m", "d") and ending else 2 if ending in ("re", "ve", "ll") else 0
        if taken:
            start[at + 1 : at + 1 + taken] = False
            if at + 1 + taken < n and (own[at + 1 + taken] != SPACE or rule == "byte"):
                start[at + 1 + taken] = True
