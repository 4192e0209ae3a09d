"""BPE encoding and decoding with a lexicon of frequent words.

The words of all texts are counted and the most frequent ones are encoded once and compiled into a minimal acyclic
transducer with their ids as outputs (``lexicon``). Its file goes to every executor through Spark and is mapped into memory
there. Words that the transducer does not know are merged exactly (``bpe``). The lexicon has a fixed number of words, so
neither its file nor the driver's work grows with the input; which words it holds never changes a result.

Ids are those of the tokenizer file without added ends, and strings of its added tokens in a text are these tokens. Null
counts as empty; an empty text has no ids and decodes to an empty text. Repeated rows give repeated results, an empty table
an empty one. Other columns are kept; a new column that would clash gets underscores in front.
"""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from casewise.llm import pretokens
from casewise.llm.bpe import Merges, gather
from casewise.llm.common import Numbers, Tables, added, pieces, span_hashes
from casewise.llm.lexicon import Lexicon, compile_lexicon
from casewise.llm.wordtable import MOST_WORDS, WordTable

#: Words of the lexicon; longer words are left to merging.
LEXICON_WORDS, LONGEST_WORD = 65_536, 48
#: Bytes of text encoded at once; one longer text is encoded alone.
RUN_BYTES = 1 << 19

_WORD_BYTE = np.array([b >= 0x80 or chr(b).isalpha() for b in range(256)])


# -- the lexicon ------------------------------------------------------------------------------


def _count_words(batches):
    """Runs of letters, A-Z lower-cased: what is worth a place in the lexicon need not be cut to the letter.

    A task adds up its counts until it holds ``MOST_WORDS`` words.
    """
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    numbers, counts, held = Numbers(), np.zeros(0, np.int64), []

    def found():
        data, sizes = (np.concatenate(x) for x in zip(*held))
        words = _binary(data, np.concatenate([[0], np.cumsum(sizes)]), pa.binary())
        return pa.RecordBatch.from_arrays([words, pa.array(counts, pa.int64())], ["word", "n"])

    for batch in batches:
        for _, _, data, offsets in pieces(batch.column(0)):
            data = low[data]
            inside = np.zeros(len(data) + 2, bool)
            inside[1:-1] = _WORD_BYTE[data]
            first = np.zeros(len(data) + 2, bool)
            first[offsets + 1] = True
            starts = inside[1:-1] & (~inside[:-2] | first[1:-1])
            ends = inside[1:-1] & (~inside[2:] | first[2:])
            start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
            start, end = start[end - start <= LONGEST_WORD], end[end - start <= LONGEST_WORD]
            hashes = span_hashes(data, start, end)
            at = numbers.find(hashes)
            missing = np.flatnonzero(at < 0)
            if len(missing):
                new, first_at = np.unique(hashes[missing], return_index=True)
                own = missing[first_at]
                numbers.add(new)
                held.append((gather(data, start[own], end[own] - start[own]), end[own] - start[own]))
                at[missing] = numbers.find(hashes[missing])
                counts = np.concatenate([counts, np.zeros(len(new), np.int64)])
            counts += np.bincount(at, minlength=len(counts))
            if len(counts) > MOST_WORDS:
                yield found()
                numbers, counts, held = Numbers(), np.zeros(0, np.int64), []
    if held:
        yield found()


def frequent_words(docs: DataFrame, text_col: str = "text", most: int = LEXICON_WORDS) -> list[bytes]:
    """The ``most`` most frequent words of all texts, ties in byte order."""
    tables = Tables(docs.sparkSession)
    partial = docs.select(text_col).mapInArrow(_count_words, "word binary, n bigint")
    counted = tables.store(partial.groupBy("word").agg(F.sum("n").alias("n")), "words")
    # levels of counts, at most 504: words below the level in which the list ends stay where they are
    level = F.floor(F.log2("n") * 8)
    left, least = most, 0
    for row in counted.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("level")).collect():
        left, least = left - row.words, row.level
        if left <= 0:
            break
    top = counted.where(level >= least).orderBy(F.desc("n"), "word").limit(most)
    found = [bytes(row.word) for row in top.select("word").collect()]
    tables.drop()
    return found


def ship_lexicon(docs: DataFrame, tokenizer: str, text_col: str = "text", most: int = LEXICON_WORDS) -> str:
    """Compile the lexicon, give its file to Spark to send to the executors, and return the file's name."""
    content = open(tokenizer, encoding="utf-8").read()
    words = frequent_words(docs, text_col, most)
    name = f"lexicon-{uuid.uuid4().hex}"
    path = os.path.join(tempfile.mkdtemp(prefix="lexicon-"), name)
    with open(path, "wb") as file:
        file.write(compile_lexicon(words, *Merges(content).encode(words)))
    docs.sparkSession.sparkContext.addFile(path)
    return name


# -- encoding and decoding --------------------------------------------------------------------


class _Encoder:
    def __init__(self, content: str, lexicon_path: str):
        self.merges = Merges(content)
        self.lexicon = Lexicon(lexicon_path)
        self.table = WordTable(self._compute, np.int32)
        names = {i: t for t, i in self.merges.vocab.items()} | {i: t for t, i in self.merges.special.items()}
        raw = [(names.get(i, "") + " ").encode() for i in range(max(names) + 1)]
        self.name_size = np.fromiter(map(len, raw), np.int64, len(raw))
        self.name_at = np.cumsum(self.name_size) - self.name_size
        self.names = np.frombuffer(b"".join(raw), np.uint8)

    def _compute(self, data, start, end, special):
        numbers = self.lexicon.numbers(data, start, end)
        numbers[special >= 0] = -1
        known = np.flatnonzero(numbers >= 0)
        unseen = np.flatnonzero((numbers < 0) & (special < 0))
        counts = np.ones(len(start), np.int64)
        counts[known] = self.lexicon.ids_at[numbers[known] + 1] - self.lexicon.ids_at[numbers[known]]
        sizes = end[unseen] - start[unseen]
        raw = gather(data, start[unseen], sizes)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        merged, counts[unseen] = self.merges.merge(self.merges.symbols_of(raw, offsets[1:]), offsets)
        flat = np.zeros(counts.sum(), np.int32)
        begin = np.cumsum(counts) - counts
        for rows, values in (
            (known, gather(self.lexicon.ids, self.lexicon.ids_at[numbers[known]], counts[known])),
            (unseen, merged),
            (np.flatnonzero(special >= 0), special[special >= 0]),
        ):
            flat[np.repeat(begin[rows] - (np.cumsum(counts[rows]) - counts[rows]), counts[rows]) + np.arange(len(values))] = values
        return flat, counts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts laid end to end, number of ids of each text)."""
        words = pretokens.split(texts, self.merges.special, "word")
        ids, counts = self.table.runs(self.table.look_up(words))
        return ids, np.bincount(words.row, counts, len(texts)).astype(np.int64)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token strings with a space between, as bytes laid end to end, and their offsets."""
        sizes = self.name_size[ids]
        data = gather(self.names, self.name_at[ids], sizes)
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
        keep = np.ones(len(data), bool)
        keep[ends[1:][counts > 0] - 1] = False  # the space after the last token
        return data[keep], ends - np.concatenate([[0], np.cumsum(counts > 0)])


#: The encoder of this worker: one at a time, as each holds the vocabulary and a table of words.
_HELD: dict[tuple[str, str], _Encoder] = {}


def _encoder(tokenizer: str, lexicon: str) -> _Encoder:
    if (tokenizer, lexicon) not in _HELD:
        _HELD.clear()  # the last one goes before the next one is built
        with open(tokenizer, encoding="utf-8") as file:
            _HELD[tokenizer, lexicon] = _Encoder(file.read(), SparkFiles.get(lexicon))
    return _HELD[tokenizer, lexicon]


def _binary(flat: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Bytes laid end to end as a column."""
    data = np.ascontiguousarray(flat)
    return pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def encoded(
    docs: DataFrame, tokenizer: str, text_col: str = "text", most: int = LEXICON_WORDS, decoded: bool = True, width: int = 4
) -> DataFrame:
    """Every row of ``docs`` with n_tokens, ids (binary: little-endian unsigned numbers of ``width`` bytes) and decoded.

    ``tokenizer`` is the path of the tokenizer file on all machines. An id that does not fit in ``width`` bytes is an error.
    """
    kind = {2: np.uint16, 4: np.uint32}[width]
    lexicon = ship_lexicon(docs, tokenizer, text_col, most)
    n_tokens, ids_name, decoded_name = added(docs, "n_tokens", "ids", "decoded")
    place = docs.columns.index(text_col)

    def run(batches):
        encoder = _encoder(tokenizer, lexicon)
        for batch in batches:
            for low, high, data, offsets in pieces(batch.column(place), RUN_BYTES):
                whole, at = data.tobytes(), offsets.tolist()
                texts = [whole[a:b].decode("utf-8", "replace") for a, b in zip(at, at[1:])]
                ids, counts = encoder.encode(texts)
                ends = np.concatenate([[0], np.cumsum(counts)])
                if len(ids) and ids.max() > np.iinfo(kind).max:
                    raise ValueError(f"token id {ids.max()} does not fit in {width} bytes")
                new = [pa.array(counts, pa.int64()), _binary(ids.astype(kind).view(np.uint8), ends * width, pa.binary())]
                if decoded:
                    new.append(_binary(*encoder.decode(ids, counts), pa.string()))
                rows = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([*rows.columns, *new], schema=pa.schema(
                    [*rows.schema, *(pa.field(n, a.type) for n, a in zip((n_tokens, ids_name, decoded_name), new))]
                ))

    schema = StructType.fromJson(docs.schema.jsonValue()).add(n_tokens, "long").add(ids_name, "binary")
    return docs.mapInArrow(run, schema.add(decoded_name, "string") if decoded else schema)
