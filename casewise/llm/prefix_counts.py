"""Token counts at every prefix of a text, by dynamic programming.

The last token of the encoding of a prefix is the one token ending there that the encoding of the shorter prefix may be
followed by: merging the two tokens alone gives the two again. So the count at a prefix is one more than the count before
that token, and one pass over a word gives the counts at all its prefixes. A text's table adds the counts of the words
before; it answers how many tokens a prefix has, and which prefix fits a budget, without encoding again.

Tokens are those of a byte-level tokenizer file; strings of its added tokens in a text are these tokens. Null counts as
empty. An empty text has no tokens and an empty table. Repeated rows give repeated results, an empty table an empty one.
Other columns are kept; a new column that would clash gets underscores in front.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from casewise.llm import pretokens
from casewise.llm.bpe import Merges, byte_letters, gather
from casewise.llm.common import added, mixed, pieces, rolled, span_hashes, span_hashes_at
from casewise.llm.wordtable import WordTable

#: Words of more bytes are done one at a time.
WIDEST = 48
#: Slots for tokens by hash, and for pairs of tokens whose verdicts are kept; powers of two.
TOKEN_SLOTS, PAIR_SLOTS = 1 << 18, 1 << 21


class PrefixCounter:
    def __init__(self, content: str):
        self.merges = Merges(content)
        byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
        self.tokens = {bytes(byte_of[x] for x in token): i for token, i in self.merges.vocab.items()}
        self.raw = [b""] * (max(self.tokens.values()) + 1)
        for token, i in self.tokens.items():
            self.raw[i] = token
        ordered = list(self.tokens)
        sizes = np.fromiter(map(len, ordered), np.int64, len(ordered))
        ends = np.cumsum(sizes)
        hashes = span_hashes(np.frombuffer(b"".join(ordered), np.uint8), ends - sizes, ends)
        self._token_slots(hashes, np.fromiter(self.tokens.values(), np.int64, len(ordered)))
        self.longest = int(sizes.max())
        # pairs whose verdicts are known: a slot holds the last pair that fell into it
        self.pairs = np.full(PAIR_SLOTS, np.iinfo(np.int64).min)
        self.allowed = np.zeros(PAIR_SLOTS, bool)
        self.table = WordTable(self._compute, np.int32)

    # -- which token may follow which ------------------------------------------------------

    def _token_slots(self, hashes: np.ndarray, ids: np.ndarray) -> None:
        """Open addressing: a token lies in the first free slot from the one its hash names."""
        self.slot_hash, self.slot_id = np.zeros(TOKEN_SLOTS, np.uint64), np.full(TOKEN_SLOTS, -1, np.int64)
        for value, token in zip(hashes.tolist(), ids.tolist()):
            slot = value & (TOKEN_SLOTS - 1)
            while self.slot_id[slot] >= 0:
                slot = (slot + 1) & (TOKEN_SLOTS - 1)
            self.slot_hash[slot], self.slot_id[slot] = value, token

    def _tokens_of(self, hashes: np.ndarray) -> np.ndarray:
        """Token of each hash, -1 without one."""
        slot = (hashes & np.uint64(TOKEN_SLOTS - 1)).astype(np.int64)
        found = np.where(self.slot_hash[slot] == hashes, self.slot_id[slot], -1)
        left = np.flatnonzero((self.slot_id[slot] >= 0) & (found < 0))
        while len(left):
            slot[left] = (slot[left] + 1) & (TOKEN_SLOTS - 1)
            same = self.slot_hash[slot[left]] == hashes[left]
            found[left[same]] = self.slot_id[slot[left[same]]]
            left = left[~same & (self.slot_id[slot[left]] >= 0)]
        return found

    def _verdicts(self, keys: np.ndarray) -> np.ndarray:
        """Whether merging each pair of tokens alone gives the pair again; -1 as the first token is a start."""
        slot = (mixed(keys.view(np.uint64)) & np.uint64(PAIR_SLOTS - 1)).astype(np.int64)
        good, known = self.allowed[slot], self.pairs[slot] == keys
        if known.all():
            return good
        new, inverse = np.unique(keys[~known], return_inverse=True)
        first, second = new >> 32, new & 0xFFFFFFFF
        ids, counts = self.merges.encode(
            [(self.raw[a] if a >= 0 else b"") + self.raw[b] for a, b in zip(first.tolist(), second.tolist())]
        )
        start = np.cumsum(counts) - counts
        wanted = np.where(first < 0, 1, 2)
        fits = (counts == wanted) & (ids[start + counts - 1] == second) & ((first < 0) | (ids[start] == first))
        good[~known] = fits[inverse]
        self.pairs[slot[~known]], self.allowed[slot[~known]] = keys[~known], good[~known]
        return good

    # -- words ------------------------------------------------------------------------------

    def byte_counts(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Counts at all byte prefixes of words laid end to end in ``data`` (each prefix as a word of its own)."""
        counts = np.zeros(len(data), np.int32)
        sizes = end - start
        short = np.flatnonzero((sizes <= WIDEST) & (sizes > 0))
        for low, high in ((0, 6), (6, 12), (12, 24), (24, WIDEST)):
            rows = short[(sizes[short] > low) & (sizes[short] <= high)]
            for part in np.array_split(rows, max(1, len(rows) >> 16)):
                if len(part):
                    self._block(data, start[part], sizes[part], counts)
        for row in np.flatnonzero(sizes > WIDEST).tolist():
            counts[start[row] : end[row]] = self._long(data[start[row] : end[row]].tobytes())
        return counts

    def _block(self, data, start, sizes, counts) -> None:
        n, width = len(start), int(sizes.max())
        token = {}  # length -> id of the token of that length at each (word, place), -1 without one
        for length in range(1, min(width, self.longest) + 1):
            places = np.arange(width - length + 1)
            inside = places + length <= sizes[:, None]
            begin = (start[:, None] + places)[inside]
            hashes = span_hashes_at(self.rolled, begin, begin + length)
            found = np.full(inside.shape, -1, np.int64)
            found[inside] = self._tokens_of(hashes)
            token[length] = found
        last = np.full((n, width + 1), -1, np.int64)
        count = np.zeros((n, width + 1), np.int32)
        for stop in range(1, width + 1):
            open_rows = np.flatnonzero(sizes >= stop)
            for length in range(min(stop, self.longest), 0, -1):
                ids = token[length][open_rows, stop - length]
                rows, ids = open_rows[ids >= 0], ids[ids >= 0]
                if not len(rows):
                    continue
                good = self._verdicts(last[rows, stop - length] << 32 | ids)
                rows, ids = rows[good], ids[good]
                last[rows, stop] = ids
                count[rows, stop] = count[rows, stop - length] + 1
                open_rows = open_rows[last[open_rows, stop] < 0]
                if not len(open_rows):
                    break
        inside = np.arange(width) < sizes[:, None]
        counts[(start[:, None] + np.arange(width))[inside]] = count[:, 1:][inside]

    def _long(self, word: bytes) -> np.ndarray:
        last, count = [-1], [0]
        seen: dict[tuple[int, int], bool] = {}
        for stop in range(1, len(word) + 1):
            for length in range(min(stop, self.longest), 0, -1):
                token = self.tokens.get(word[stop - length : stop])
                if token is None:
                    continue
                pair = (last[stop - length], token)
                if pair not in seen:
                    seen[pair] = bool(self._verdicts(np.array([pair[0] << 32 | token], np.int64))[0])
                if seen[pair]:
                    last.append(token)
                    count.append(count[stop - length] + 1)
                    break
        return np.array(count[1:], np.int32)

    def _compute(self, data, start, end, special):
        """Counts at the character prefixes of words. An added token's own table holds the whole token only."""
        sizes = end - start
        raw = gather(data, start, sizes)
        stop = np.cumsum(sizes)
        begin = stop - sizes
        plain = special < 0
        self.rolled = rolled(raw)
        counts = self.byte_counts(raw, begin[plain], stop[plain])
        # a character ends where the next byte begins another one or the word ends
        ends = np.ones(len(raw), bool)
        ends[:-1] = (raw[1:] & 0xC0) != 0x80
        # the first two characters of 're, 've, 'll are not yet one word
        three = begin[plain & (sizes == 3)]
        three = three[(raw[three] == 0x27) & np.isin(raw[three + 1], np.frombuffer(b"rvl", np.uint8))]
        three = three[[bytes(raw[t + 1 : t + 3]) in (b"re", b"ve", b"ll") for t in three.tolist()]] if len(three) else three
        counts[three + 1] = 2
        for row in np.flatnonzero(~plain).tolist():
            counts[begin[row] : stop[row]] = 0
            counts[stop[row] - 1] = 1
        characters = np.concatenate([[0], np.cumsum(ends)])
        return counts[ends], characters[stop] - characters[begin]

    # -- texts ------------------------------------------------------------------------------

    def tables(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(counts at prefixes of 1, 2, ... characters of all texts laid end to end, offsets of the texts)."""
        words = pretokens.split(texts, self.merges.special, "byte")
        places = self.table.look_up(words)
        inner, sizes = self.table.runs(places)
        stop = np.cumsum(sizes)
        totals = inner[stop - 1].astype(np.int64) if len(stop) else np.zeros(0, np.int64)
        so_far = np.cumsum(totals)
        base = so_far - totals
        first_word = np.searchsorted(words.row, np.arange(len(texts)))
        before_text = np.concatenate([[0], so_far])[first_word]
        base = base - before_text[words.row]
        counts = inner + np.repeat(base, sizes)
        self._white_space(texts, words, counts, base)
        self._added(texts, words, counts, base)
        return counts, words.text_offsets

    def _count(self, texts: list[str]) -> list[int]:
        """Tokens of short texts, added tokens taken as plain text."""
        words = pretokens.split(texts, {}, "byte")
        places = self.table.look_up(words)
        totals = self.table.values[self.table.start[places] + self.table.count[places] - 1]
        return np.bincount(words.row, totals, len(texts)).astype(int).tolist()

    def _white_space(self, texts, words, counts, base) -> None:
        """A run of white space that ends the prefix is one word, also where its last character leads the next word."""
        blank = pretokens.kinds()[words.codes] == pretokens.SPACE
        start, end = words.start, words.end
        run = np.flatnonzero(blank[start[:-1]] & blank[start[1:]] & (words.row[:-1] == words.row[1:])) if len(start) > 1 else start[:0]
        run = run[blank[end[run] - 1]]  # the word before is white space only
        if not len(run):
            return
        pieces_of = ["".join(map(chr, words.codes[start[i] : start[i + 1] + 1].tolist())) for i in run.tolist()]
        distinct = {p: 0 for p in pieces_of}
        for piece, n in zip(distinct, self._count(list(distinct))):
            distinct[piece] = n
        counts[start[run + 1]] = base[run] + np.array([distinct[p] for p in pieces_of])

    def _added(self, texts, words, counts, base) -> None:
        """Prefixes that end inside an added token's string: counted as plain text together with the words before."""
        for at in np.flatnonzero(words.special >= 0).tolist():
            row, begin, end = int(words.row[at]), int(words.start[at]), int(words.end[at])
            near = at
            while near > 0 and at - near < 2 and words.row[near - 1] == row and words.special[near - 1] < 0:
                near -= 1
            own = "".join(map(chr, words.codes[words.start[near] : end].tolist()))
            lead = len(own) - (end - begin)
            counts[begin : end - 1] = base[near] + np.array(self._count([own[:n] for n in range(lead + 1, len(own))]))


# -- the tables as a column ---------------------------------------------------------------------


def count_at(table: bytes, n_chars: int) -> int:
    """Tokens of the first ``n_chars`` characters."""
    return int(np.frombuffer(table, "<i2", n_chars).sum())


def longest_prefix(table: bytes, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    fits = np.flatnonzero(np.cumsum(np.frombuffer(table, "<i2"), dtype=np.int64) <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


@functools.lru_cache(maxsize=1)
def _counter(tokenizer: str) -> PrefixCounter:
    with open(tokenizer, encoding="utf-8") as file:
        return PrefixCounter(file.read())


def prefix_tables(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with n_tokens and prefix_tokens.

    prefix_tokens is binary: for each character, by how much the count changes with it, as a little-endian signed 16-bit
    number (``count_at`` and ``longest_prefix`` read it). ``tokenizer`` is the path of the file on all machines.
    """
    n_name, table_name = added(docs, "n_tokens", "prefix_tokens")
    place = docs.columns.index(text_col)

    def run(batches):
        counter = _counter(tokenizer)
        for batch in batches:
            for low, high, data, offsets in pieces(batch.column(place), 1 << 21):
                whole, at = data.tobytes(), offsets.tolist()
                texts = [whole[a:b].decode("utf-8", "replace") for a, b in zip(at, at[1:])]
                counts, ends = counter.tables(texts)
                steps = np.diff(counts, prepend=0)
                filled = ends[:-1] < ends[1:]
                steps[ends[:-1][filled]] = counts[ends[:-1][filled]]
                totals = np.zeros(len(texts), np.int64)
                totals[filled] = counts[ends[1:][filled] - 1]
                tables = pa.Array.from_buffers(
                    pa.binary(), len(texts), [None, pa.py_buffer((ends * 2).astype(np.int32)), pa.py_buffer(steps.astype("<i2"))]
                )
                rows = batch.slice(low, high - low)
                new = [pa.array(totals, pa.int64()), tables]
                yield pa.RecordBatch.from_arrays([*rows.columns, *new], schema=pa.schema(
                    [*rows.schema, pa.field(n_name, pa.int64()), pa.field(table_name, pa.binary())]
                ))

    schema = StructType.fromJson(docs.schema.jsonValue()).add(n_name, "long").add(table_name, "binary")
    return docs.mapInArrow(run, schema)


def truncated(tables: DataFrame, budget: int, text_col: str = "text", table_col: str = "prefix_tokens") -> DataFrame:
    """Cut each text to its longest prefix of at most ``budget`` tokens, from the table alone."""
    from pyspark.sql import functions as F

    @F.pandas_udf("int")
    def fitting(tables):
        return tables.map(lambda table: longest_prefix(table, budget))

    return tables.withColumn(text_col, F.substring(F.col(text_col), F.lit(1), fitting(table_col)))
