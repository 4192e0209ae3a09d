"""Language-model scores from a log-frequency Bloom filter.

The counts of words and of pairs of words are quantised to levels that grow by ``GROWTH``, and a word or pair of level q is
put into a Bloom filter q times, with the levels 1 to q. A count is read back by asking for level 1, 2, ... until one is
missing. The filter is built in segments, one for each part of the hash range, by the tasks that add the counts of that
part up, so no count passes through the driver. Every segment has ``ENTRY_BITS`` bits for each of its entries, so the rate of
false hits is the same for every size of corpus. How many segments there are depends on the bytes of the corpus alone, so a
corpus has the same filter and the same scores on every cluster. Counts reach many segments by way of ``GROUPS`` groups of
them, so that what a task sends at once stays in large pieces. A filter of up to ``MOST_BITS`` bits is broadcast, and with it the
exact counts of up to ``MOST_WORDS`` words. What is larger stays in the shared folder: texts are worked on in runs of ``RUN_TOKENS``
tokens, the distinct words and pairs of each run are sent once, in order, to the segments that answer them, and only the answers, in
the same order, go back to their run. Both ways give the same scores.

A text is scored as the sum of log10 of p(w | v) = (c(v w) + MU p(w)) / (c(v) + MU) with p(w) = (c(w) + 1) / (N + V + 1), all
counts from the filter, c(v w) at most c(v) and c(w). The end of a text is a token, and the start counts as one.

``base_score`` uses exact counts of single words, which are kept with the segments.

Words and pairs are known by 64-bit hashes. Null texts are empty, so their only token is the end. With no training text
all counts are 0. Repeated rows give repeated results; a null id is training material. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewise.llm.common import Tables, blob, chained, lower, mixed, pieces, short_shuffles, span_hashes, words

GROWTH, PROBES = 1.5, 3
#: Bits of the filter for each entry: with 3 probes, about 1.5 of 100 questions about absent entries hit falsely.
ENTRY_BITS = 10
#: Bits of the largest filter that is broadcast (128 MB), and words of the largest table of exact counts (64 MB).
MOST_BITS, MOST_WORDS = 1 << 30, 4_000_000
#: Bytes of text for each segment, for the first ``GROUPS`` segments and beyond: a segment stays far below the 2^32 bits that
#: a probe can tell apart.
SEGMENT_BYTES, LARGE_SEGMENT_BYTES = 1 << 23, 1 << 27
#: Segments to which tasks send counts directly; more are reached in two steps.
GROUPS = 512
MU = 300.0
#: Entries, or questions about them, that a task gathers before it puts equal ones together.
HELD = 3_000_000
#: Tokens of a run, one longer text aside: its words and pairs are asked for once.
RUN_TOKENS = 1 << 20
#: How tables of runs and answers are written.
DENSE = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}

_END = np.uint64(0x51ED270B7A1D3C2F)
_KIND = {"word": np.uint64(0x9AE16A3B2F90404F), "pair": np.uint64(0xC2B2AE3D27D4EB4F)}


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words of all texts, an end after each text; number of tokens of each text)."""
    start, end, row = words(data, offsets)
    n = np.bincount(row, minlength=len(offsets) - 1) + 1
    out = np.full(n.sum(), _END, np.uint64)
    out[np.arange(len(row)) + row] = span_hashes(data, start, end)
    return out, n


def pairs(hashes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the token before each token, hash of both); an end stands before the first."""
    before = np.concatenate([[_END], hashes[:-1]]).astype(np.uint64)
    return before, chained(before, hashes)


def rising(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes and the sums of their counts."""
    distinct, inverse = np.unique(hashes, return_inverse=True)
    return distinct, np.bincount(inverse, counts, len(distinct)).astype(np.int64)


# -- counting and building the filter ---------------------------------------------------------


def n_segments(size: int) -> int:
    """Segments for a corpus of ``size`` bytes."""
    return max(1, min(GROUPS, -(-size // SEGMENT_BYTES)), -(-size // LARGE_SEGMENT_BYTES))


_COUNTS = "part int, kind string, keys binary, counts binary"


def _cut(kind: str, keys: np.ndarray, counts: np.ndarray, parts: int) -> pa.RecordBatch:
    """Distinct keys in order, with their counts, for each part of the hash range."""
    cut = np.searchsorted(_part(keys, parts), np.arange(parts + 1))
    rows = np.flatnonzero(cut[:-1] < cut[1:]).tolist()
    return pa.RecordBatch.from_arrays([
        pa.array(rows, pa.int32()), pa.array([kind] * len(rows), pa.string()),
        pa.array([blob(keys[cut[i] : cut[i + 1]]) for i in rows], pa.binary()),
        pa.array([blob(counts[cut[i] : cut[i + 1]].astype(np.uint32)) for i in rows], pa.binary()),
    ], ["part", "kind", "keys", "counts"])


def _counting(parts: int):
    def send(held: list[np.ndarray], kind: str):
        return _cut(kind, *np.unique(np.concatenate(held), return_counts=True), parts)

    def run(batches):
        held, size = {"word": [], "pair": []}, 0
        for batch in batches:
            for _, _, data, offsets in pieces(batch.column(0)):
                hashes, n = tokens(lower(data), offsets)
                held["word"].append(hashes)
                held["pair"].append(pairs(hashes, n)[1])
                size += len(hashes)
                if size > HELD:
                    yield from (send(held[kind], kind) for kind in held)
                    held, size = {"word": [], "pair": []}, 0
        if size:
            yield from (send(held[kind], kind) for kind in held)

    return run


def _dealing(parts: int):
    """Counts of a group of segments, added up where a task meets them together, for each segment."""
    def run(batches):
        held, size = {"word": ([], []), "pair": ([], [])}, 0

        def flushed():
            for kind, (keys, counts) in held.items():
                if keys:
                    yield _cut(kind, *rising(np.concatenate(keys), np.concatenate(counts)), parts)

        for batch in batches:
            for kind, keys, counts in zip(*(batch.column(c).to_pylist() for c in range(1, 4))):
                held[kind][0].append(np.frombuffer(keys, np.uint64))
                held[kind][1].append(np.frombuffer(counts, np.uint32))
                size += len(held[kind][0][-1])
                if size > HELD:
                    yield from flushed()
                    held, size = {"word": ([], []), "pair": ([], [])}, 0
        yield from flushed()

    return run


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Part of the hash range, rising with the hash."""
    return ((hashes >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)).astype(np.int64)


def level(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / np.log(GROWTH) + 1e-9).astype(np.int64)


def _level_counts() -> np.ndarray:
    """Mean count of each level; 0 for level 0."""
    low = GROWTH ** np.arange(0, 120)
    first, last = np.ceil(low - 1e-6), np.ceil(low * GROWTH - 1e-6) - 1
    return np.concatenate([[0.0], np.where(last >= first, (first + last) / 2, low)])


LEVEL_COUNTS = _level_counts()


def _mixed(hashes: np.ndarray, kind: str, at_level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed((hashes ^ _KIND[kind]) + np.uint64(at_level) * np.uint64(0x9E3779B97F4A7C15))


def _probe(value: np.ndarray, i: int, bits) -> np.ndarray:
    """The bit, inside a segment of ``bits`` bits, of probe ``i`` for a mixed (hash, level)."""
    step = (value >> np.uint64(32)) | np.uint64(1)
    return (((value & np.uint64(0xFFFFFFFF)) + np.uint64(i) * step) & np.uint64(0xFFFFFFFF)) * bits >> np.uint64(32)


def _building():
    columns = ["part", "n_bits", "bits", "keys", "counts"]

    def run(frames):
        held = {"word": ([], []), "pair": ([], [])}
        part = None
        for batch in frames:
            for i, kind, keys, counts in zip(*(batch.column(c).to_pylist() for c in range(4))):
                part = i
                held[kind][0].append(np.frombuffer(keys, np.uint64))
                held[kind][1].append(np.frombuffer(counts, np.uint32))
        if part is None:
            return
        found = {kind: rising(np.concatenate(k), np.concatenate(c)) for kind, (k, c) in held.items() if k}
        levels = {kind: level(counts) for kind, (_, counts) in found.items()}
        entries = sum(int(x.sum()) for x in levels.values())
        n_bits = max(64, entries * ENTRY_BITS) + 63 & ~63
        bits = np.zeros(n_bits, bool)
        for kind, (keys, _) in found.items():
            for q in range(1, int(levels[kind].max()) + 1):
                value = _mixed(keys[levels[kind] >= q], kind, q)
                for i in range(PROBES):
                    bits[_probe(value, i, np.uint64(n_bits))] = True
        keys, counts = found.get("word", (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
        yield pa.RecordBatch.from_arrays([
            pa.array([part], pa.int32()), pa.array([n_bits], pa.int64()),
            pa.array([blob(np.packbits(bits, bitorder="little"))], pa.binary()),
            pa.array([blob(keys)], pa.binary()), pa.array([blob(counts)], pa.binary()),
        ], columns)

    return run


class Model:
    """The filter's segments, each with the exact counts of its words, as a table in the shared folder.

    ``bits`` is the whole filter, or None where it is too large to be broadcast.
    """

    def __init__(self, segments: DataFrame, tables: Tables, parts: int, most_bits: int):
        self.tables, self.parts = tables, parts
        self.words = segments.select("keys", "counts")
        self.segments = segments.select("part", "n_bits", "bits", "keys", "counts")
        sizes = segments.select(
            F.coalesce(F.sum(F.length("keys") / 8), F.lit(0)).cast("long").alias("distinct"),
            F.coalesce(F.sum("n_bits"), F.lit(0)).alias("n_bits"),
        ).first()
        self.distinct = sizes.distinct
        sums = self.words.mapInArrow(_sums, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
        self.total = sums.n
        self.bits = self.at = self.n_bits = None
        if sizes.n_bits > most_bits:
            return
        self.n_bits, self.at = np.full(parts, 64, np.uint64), np.zeros(parts, np.int64)
        self.bits, place = np.zeros(8 + sizes.n_bits // 8, np.uint8), 64  # parts without entries share an empty segment
        for row in self.segments.select("part", "n_bits", "bits").toLocalIterator():  # ``most_bits`` at most, a segment at a time
            self.n_bits[row.part], self.at[row.part] = row.n_bits, place
            self.bits[place // 8 : (place + row.n_bits) // 8] = np.frombuffer(row.bits, np.uint8)
            place += row.n_bits

    def drop(self) -> None:
        """Remove the tables; what was scored does not need them any more."""
        self.tables.drop()

    def broadcast_whole(self, most_words: int) -> bool:
        return self.bits is not None and self.distinct <= most_words


def _sums(batches):
    for batch in batches:
        total = sum(int(np.frombuffer(x, np.int64).sum()) for x in batch.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64())], ["n"])


def train(docs: DataFrame, text_col: str = "text", most_bits: int = MOST_BITS, groups: int = GROUPS) -> Model:
    """Count the words and pairs of all texts of ``docs`` and build the filter, to be broadcast up to ``most_bits`` bits."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)).alias("n")).first()["n"]
    parts = n_segments(size)
    tables = Tables(docs.sparkSession)
    counted = docs.select(text_col).mapInArrow(_counting(min(parts, groups)), _COUNTS)
    if parts > groups:
        counted = counted.repartitionById(groups, F.col("part")).mapInArrow(_dealing(parts), _COUNTS)
    built = counted.repartitionById(parts, F.col("part")).mapInArrow(
        _building(), "part int, n_bits bigint, bits binary, keys binary, counts binary"
    )
    with short_shuffles(docs.sparkSession):
        segments = tables.store(built, "segments")
    return Model(segments, tables, parts, most_bits)


# -- scoring --------------------------------------------------------------------------------------


def read_levels(hashes: np.ndarray, kind: str, bits, at, n_bits, parts) -> np.ndarray:
    """Level of each hash, by probes of rising levels until one misses."""
    found = np.zeros(len(hashes), np.int64)
    left, own = np.arange(len(hashes)), _part(hashes, parts) if parts > 1 else None
    for q in range(1, len(LEVEL_COUNTS)):
        if not len(left):
            break
        value = _mixed(hashes[left], kind, q)
        for i in range(PROBES):  # most of what is missing misses at the first probe
            first, size = (at[0], n_bits[0]) if own is None else (at[own], n_bits[own])
            places = _probe(value, i, size).view(np.int64) + first
            hit = np.flatnonzero(bits[places >> 3] >> (places & 7).astype(np.uint8) & 1)
            left, value, own = left[hit], value[hit], own if own is None else own[hit]
        found[left] = q
    return found


def read_counts(hashes: np.ndarray, kind: str, bits, at, n_bits, parts) -> np.ndarray:
    """Quantised count of each hash."""
    return LEVEL_COUNTS[read_levels(hashes, kind, bits, at, n_bits, parts)]


def _distinct(hashes: np.ndarray, find) -> np.ndarray:
    distinct, inverse = np.unique(hashes, return_inverse=True)
    return find(distinct)[inverse]


def _sorted_distinct(hashes: np.ndarray) -> np.ndarray:
    ordered = np.sort(hashes)
    return ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])] if len(ordered) else ordered


def token_scores(single: np.ndarray, joint: np.ndarray, start: float, n: np.ndarray, total: int, distinct: int) -> np.ndarray:
    """Score of each text from the counts of its tokens and of their pairs; ``start`` is the count of an end."""
    context = np.concatenate([[start], single[:-1]])
    joint = np.minimum(joint, np.minimum(single, context))
    p = (single + 1) / (total + distinct + 1)
    values = np.log10((joint + MU * p) / (context + MU))
    return np.add.reduceat(values, np.cumsum(n) - n) if len(n) else np.zeros(0)


def model_scores(hashes: np.ndarray, n: np.ndarray, read, total: int, distinct: int) -> np.ndarray:
    before, both = pairs(hashes, n)
    single = _distinct(hashes, lambda x: read(x, "word"))
    joint = _distinct(both, lambda x: read(x, "pair"))
    return token_scores(single, joint, read(before[:1], "word")[0] if len(n) else 0.0, n, total, distinct)


def exact_counts(hashes: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Count of each hash in a table in order of its keys; 0 where it is not there."""
    if not len(keys):
        return np.zeros(len(hashes), np.int64)
    place = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    return np.where(keys[place] == hashes, counts[place], 0)


_SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def _scores(ids: pa.Array, out: pa.Array, n: np.ndarray, c: np.ndarray, score: np.ndarray, total: int, distinct: int) -> pa.RecordBatch:
    """Rows of ``_SCORES``; ``c`` has the exact count of each token."""
    first = np.cumsum(n) - n
    base = np.add.reduceat(np.log10(c + 1), first) - n * np.log10(total + distinct + 1)
    known = np.add.reduceat((c > 0).astype(np.int64), first)
    return pa.RecordBatch.from_arrays(
        [ids, out, pa.array(n, pa.int64()), pa.array(known), pa.array(base), pa.array(score)],
        ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
    )


def scored(
    docs: DataFrame, model: Model, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
    most_words: int = MOST_WORDS,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row of ``docs``."""
    source = docs.select(F.col(id_col).alias("doc_id"), held_out.alias("held_out"), F.col(text_col).alias("text"))
    out = (_broadcast if model.broadcast_whole(most_words) else _answered)(source, model)
    return out.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score"
    )


def _broadcast(source: DataFrame, model: Model) -> DataFrame:
    total, distinct, parts = model.total, model.distinct, model.parts
    counts = np.zeros(distinct, np.uint64), np.zeros(distinct, np.int64)  # 16 bytes a word
    place = 0
    for row in model.words.toLocalIterator():
        keys = np.frombuffer(row["keys"], np.uint64)
        counts[0][place : place + len(keys)], counts[1][place : place + len(keys)] = keys, np.frombuffer(row["counts"], np.int64)
        place += len(keys)
    order = np.argsort(counts[0])
    shared = source.sparkSession.sparkContext.broadcast((model.bits, model.at, model.n_bits, counts[0][order], counts[1][order]))

    def run(batches):
        bits, at, n_bits, keys, values = shared.value
        for batch in batches:
            for low, high, data, offsets in pieces(batch.column(2)):
                hashes, n = tokens(lower(data), offsets)
                rows = batch.slice(low, high - low)
                score = model_scores(hashes, n, lambda x, kind: read_counts(x, kind, bits, at, n_bits, parts), total, distinct)
                c = _distinct(hashes, lambda x: exact_counts(x, keys, values))
                yield _scores(rows.column(0), rows.column(1), n, c, score, total, distinct)

    return source.mapInArrow(run, _SCORES)


# -- scoring with a model that is not broadcast -------------------------------------------------


def _planes(numbers: np.ndarray, width: int) -> bytes:
    """The ``width`` low bytes of each number, all highest ones first: what numbers in order share lies together and is compressed."""
    return blob(numbers.view(np.uint8).reshape(len(numbers), -1)[:, :width][:, ::-1].T)


def _from_planes(raw: bytes, width: int, kind) -> np.ndarray:
    out = np.zeros((len(raw) // width, np.dtype(kind).itemsize), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, -1)[::-1].T
    return out.view(kind).ravel()


_RUNS = "run bigint, ids array<bigint>, out array<boolean>, n binary, words binary, at binary"


def _runs(most: int):
    """Texts in runs of ``most`` tokens, one row for each: what is asked later is asked about these rows, so they are stored first.

    ``words`` are the distinct words of a run in order of their hashes, ``at`` the place of each token among them.
    """
    def packed(number, held):
        ids, out, hashes, n = zip(*held)
        distinct, at = np.unique(np.concatenate(hashes), return_inverse=True)
        lists = (pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in map(pa.concat_arrays, (ids, out)))
        return pa.RecordBatch.from_arrays([
            pa.array([number], pa.int64()), *lists, pa.array([blob(np.concatenate(n).astype(np.int64))], pa.binary()),
            pa.array([_planes(distinct, 8)], pa.binary()), pa.array([_planes(at.astype(np.uint32), 4)], pa.binary()),
        ], ["run", "ids", "out", "n", "words", "at"])

    def run(batches):
        from pyspark import TaskContext

        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for low, high, data, offsets in pieces(batch.column(2)):
                hashes, n = tokens(lower(data), offsets)
                rows = batch.slice(low, high - low)
                held.append((rows.column(0), rows.column(1), hashes, n))
                size += len(hashes)
                if size >= most:
                    yield packed(number, held)
                    held, size, number = [], 0, number + 1
        if held:
            yield packed(number, held)

    return run


def _run_of(n: bytes, distinct: bytes, at: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(tokens of each text, distinct words, place of each token among them, hash of each pair) of a stored run."""
    n, distinct, at = np.frombuffer(n, np.int64), _from_planes(distinct, 8, np.uint64), _from_planes(at, 4, np.uint32)
    return n, distinct, at, pairs(distinct[at], n)[1]


_QUESTIONS = "part int, run bigint, kind string, bytes binary, n_bits bigint, keys binary, counts binary"


def _asking(parts: int):
    """The distinct words and pairs of each run in order, for each part of the hash range."""

    def run(batches):
        for batch in batches:
            for number, *stored in zip(*(batch.column(c).to_pylist() for c in range(4))):
                _, distinct, _, both = _run_of(*stored)
                for kind, asked in (("word", distinct), ("pair", _sorted_distinct(both))):
                    cut = np.searchsorted(_part(asked, parts), np.arange(parts + 1))
                    rows = np.flatnonzero(cut[:-1] < cut[1:]).tolist()
                    none = pa.nulls(len(rows), pa.binary())
                    yield pa.RecordBatch.from_arrays([
                        pa.array(rows, pa.int32()), pa.array([number] * len(rows), pa.int64()), pa.array([kind] * len(rows), pa.string()),
                        pa.array([_planes(asked[cut[i] : cut[i + 1]], 8) for i in rows], pa.binary()),
                        pa.nulls(len(rows), pa.int64()), none, none,
                    ], ["part", "run", "kind", "bytes", "n_bits", "keys", "counts"])

    return run


_ANSWERS = "run bigint, kind string, part int, levels binary, counts binary"


def _merged(lists: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct numbers of lists that are in order, and the place of each list's numbers among them."""
    numbers = np.concatenate(lists)
    order = np.argsort(numbers, kind="stable")  # merges what is in order
    ordered = numbers[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    at = np.empty(len(numbers), np.int64)
    at[order] = np.cumsum(new) - 1
    return ordered[new], np.split(at, np.cumsum([len(x) for x in lists])[:-1])


def _answering(batches):
    """A segment, then the questions that belong to it, each looked up once for many runs; without a segment all answers are 0."""
    nothing = np.zeros(8, np.uint8), 64, np.zeros(0, np.uint64), np.zeros(0, np.int64)
    part, segment, held, size = -1, nothing, {"word": [], "pair": []}, 0

    def flushed():
        bits, n_bits, keys, counts = segment
        for kind, asked in held.items():
            if not asked:
                continue
            runs, lists = zip(*asked)
            distinct, places = _merged(lists)
            levels = read_levels(distinct, kind, bits, np.zeros(1, np.int64), np.full(1, n_bits, np.uint64), 1).astype(np.uint8)
            exact = exact_counts(distinct, keys, counts) if kind == "word" else None
            yield pa.RecordBatch.from_arrays([
                pa.array(runs, pa.int64()), pa.array([kind] * len(runs), pa.string()), pa.array([part] * len(runs), pa.int32()),
                pa.array([blob(levels[at]) for at in places], pa.binary()),
                pa.array([None if exact is None else _planes(exact[at], 8) for at in places], pa.binary()),
            ], ["run", "kind", "part", "levels", "counts"])

    for batch in batches:
        for own, run, kind, raw, n_bits, keys, counts in zip(*(batch.column(c).to_pylist() for c in range(7))):
            if own != part or size > HELD:
                yield from flushed()
                held, size = {"word": [], "pair": []}, 0
            if own != part:
                part, segment = own, nothing
            if run is None:
                segment = np.frombuffer(raw, np.uint8), n_bits, np.frombuffer(keys, np.uint64), np.frombuffer(counts, np.int64)
                continue
            held[kind].append((run, _from_planes(raw, 8, np.uint64)))
            size += len(held[kind][-1][1])
    yield from flushed()


def _finishing(total: int, distinct: int):
    """A run, then the answers about it, which lie in the order of its questions."""

    def finished(ids, out, stored, found):
        n, own, at, both = _run_of(*stored)
        levels = {kind: LEVEL_COUNTS[np.frombuffer(b"".join(x), np.uint8)] for kind, x in found["levels"].items()}
        exact = np.concatenate([_from_planes(x, 8, np.int64) for x in found["counts"]])
        joint = levels["pair"][np.unique(both, return_inverse=True)[1]]
        start = levels["word"][np.searchsorted(own, _END)]
        score = token_scores(levels["word"][at], joint, start, n, total, distinct)
        return _scores(pa.array(ids, pa.int64()), pa.array(out, pa.bool_()), n, exact[at], score, total, distinct)

    def run(batches):
        number, row, found = None, None, None
        for batch in batches:
            for run, ids, out, n, own, at, kind, levels, counts in zip(*(batch.column(c).to_pylist() for c in range(9))):
                if run != number:
                    if row is not None:
                        yield finished(*row, found)
                    number, row, found = run, None, {"levels": {"word": [], "pair": []}, "counts": []}
                if kind is None:
                    row = ids, out, (n, own, at)
                    continue
                found["levels"][kind].append(levels)
                if kind == "word":
                    found["counts"].append(counts)
        if row is not None:
            yield finished(*row, found)

    return run


def _answered(source: DataFrame, model: Model) -> DataFrame:
    """``_SCORES`` of the rows of ``source``, with counts from the segments in the shared folder."""
    spark, parts = source.sparkSession, model.parts
    tables = Tables(spark)
    runs = tables.store(source.mapInArrow(_runs(RUN_TOKENS), _RUNS), "runs", **DENSE)
    asked = runs.select("run", "n", "words", "at").mapInArrow(_asking(parts), _QUESTIONS)
    segments = model.segments.select(
        "part", F.lit(None).cast("bigint").alias("run"), F.lit(None).cast("string").alias("kind"), F.col("bits").alias("bytes"), "n_bits",
        "keys", "counts",
    )
    found = (
        segments.unionByName(asked).repartitionById(parts, F.col("part"))
        .sortWithinPartitions("part", F.col("run").asc_nulls_first())
        .mapInArrow(_answering, _ANSWERS)
    )
    with short_shuffles(spark):
        answers = tables.store(found, "answers", **DENSE)
    return (
        runs.unionByName(answers, allowMissingColumns=True).repartition(parts, "run")
        .sortWithinPartitions("run", F.col("kind").asc_nulls_first(), "part")
        .select("run", "ids", "out", "n", "words", "at", "kind", "levels", "counts")
        .mapInArrow(_finishing(model.total, model.distinct), _SCORES)
    )
