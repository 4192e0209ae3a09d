"""The pipeline's stages against plain versions, and the queries' SQL."""

import collections
import math
import os
import re
import struct

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from casewise.llm import queries
from casewise.llm.common import Tables
from checks.compare import connect, difference

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


def test_all_queries_are_registered():
    names = [n for n in registered.queries() if n.startswith("op") and "_" in n]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n[2:].split("_")[0].isdigit()) == list(range(1, 14))
    assert "pipeline" in registered.queries()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    found = queries.QUERIES[name](spark, SF).toPandas()
    assert difference(found, connect(SF).execute(queries.SQL[name]).df()) is None


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(-1, None, "en", "s"), (-2, "!!", None, None), (-3, "", None, "s")], "doc_id long, text string, lang string, source string")
    docs = docs.unionByName(odd.withColumn("n_chars", F.lit(0).cast("long"))).select(docs.columns).cache()
    kept = corpus_pipeline.language(spark, docs, SF).cache()
    assert kept.columns == docs.columns
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()} == {-1, -2, -3}
    exact = corpus_pipeline.exact_copies(spark, kept, SF).cache()
    assert exact.count() == len({r.text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for r in kept.collect()})
    near = corpus_pipeline.near_copies(spark, exact, SF).cache()
    assert near.columns == docs.columns and 0 < near.count() <= exact.count()
    mixed = corpus_pipeline.mixing_sources(spark, near, SF).cache()
    assert mixed.columns == docs.columns and set(mixed.select("doc_id").distinct().collect()) <= set(near.select("doc_id").collect())
    tokens = corpus_pipeline.tokens(spark, mixed, SF)
    assert tokens.count() == mixed.count() and tokens.where("n_tokens = 0").count() == 0


def test_unlabelled_documents_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("lang", F.lit(None).cast("string"))
    odd = spark.createDataFrame([(-1, None), (-2, "!! 12"), (-3, "")], "doc_id long, text string")
    docs = docs.unionByName(odd, allowMissingColumns=True).cache()
    kept = corpus_pipeline.language(spark, docs, SF)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in docs.collect() if r.doc_id not in (-1, -2, -3))


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_near_copies_mixing_and_tokens_equal_plain_versions(spark):
    tokenizers = pytest.importorskip("tokenizers")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    exact = corpus_pipeline.exact_copies(spark, corpus_pipeline.language(spark, docs, SF), SF).cache()
    sets = {r.doc_id: shingles(r.text) for r in exact.collect()}
    head, ids = {i: i for i in sets}, sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            both = len(sets[i] & sets[j])
            if both and both * 10 >= 8 * (len(sets[i]) + len(sets[j]) - both) and head[i] != head[j]:
                low, high = sorted((head[i], head[j]))
                head = {x: low if h == high else h for x, h in head.items()}
    near = corpus_pipeline.near_copies(spark, exact, SF).cache()
    assert sorted(r.doc_id for r in near.collect()) == sorted(set(head.values())) and len(set(head.values())) < len(head)

    sized = [(r.source, r.place, r.doc_id, r.words) for r in near.select(
        "source", "doc_id", F.xxhash64(F.lit(17), "doc_id", F.xxhash64("text")).alias("place"), F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).alias("words")
    ).collect()]
    totals = collections.Counter()
    for source, _, _, words in sized:
        totals[source] += words
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted((s for s in totals if s is not None), key=str.encode))}
    weight |= {None: (3, 1, 2)[len(weight) % 3]} if None in totals else {}
    target, left = {}, 1.5 * sum(totals.values())
    for s in sorted(totals, key=lambda s: 2 * totals[s] / weight[s]):
        open_weight = sum(w for x, w in weight.items() if x not in target)
        target[s] = min(2.0 * totals[s], left * weight[s] / open_weight)
        left -= target[s]
    mixed = corpus_pipeline.mixing_sources(spark, near, SF).cache()
    found, got = collections.Counter(r.doc_id for r in mixed.collect()), collections.Counter()
    buckets, finish = max(1, -(-len(sized) // 512)), collections.defaultdict(list)
    for s in totals:
        queue = sorted((x for x in sized if x[0] == s), key=lambda x: (((x[1] % 2**64) >> 20) % buckets, x[1], x[2]))
        for copy in range(2):
            before = copy * totals[s]
            for _, _, i, words in queue:
                got[i] += max(0, min(words, math.floor(target[s] + 1e-9) - before))
                before += words
                finish[i].append(before / target[s])
    wanted = {i: math.floor(got[i] / words + 0.5) for _, _, i, words in sized if words}
    assert dict(found) == {i: n for i, n in wanted.items() if n}
    order = [(t, i) for i, n in wanted.items() for t in finish[i][:n]]
    stored = Tables(spark).store(corpus_pipeline.mixing_sources(spark, near, SF), "mix")
    files = stored.withColumn("file", F.input_file_name()).withColumn("row", F.monotonically_increasing_id()).collect()
    assert [r.doc_id for r in sorted(files, key=lambda r: (r.file.rsplit("/", 1)[1], r.row))] == [i for _, i in sorted(order)]

    tool = tokenizers.Tokenizer.from_file(corpus_pipeline.tokenizer("word_bpe_49k.json"))
    text = {r.doc_id: r.text for r in near.collect()}
    for r in corpus_pipeline.tokens(spark, mixed, SF).collect():
        ids = tool.encode(text[r.doc_id], add_special_tokens=False).ids
        assert list(struct.unpack(f"<{r.n_tokens}I", r.ids)) == ids and r.decoded == tool.decode(ids, skip_special_tokens=False)
