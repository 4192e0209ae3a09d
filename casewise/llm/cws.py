"""Document fingerprints by consistent weighted sampling, with DataFrame functions only.

The terms of a text are its words after lower-casing, each weighted by how often it occurs. For sample k every term has
two gamma(2, 1) numbers r and c and a uniform number b, all from hashes of the term and k. A term of weight S is quantised to
t = floor(ln S / r + b), its hash value is ln c - r (t - b) - r, and the sample is the term with the smallest value together
with its t. Two texts agree in a sample with a probability equal to their generalised Jaccard similarity, the sum of the
smaller weights over the sum of the larger ones, so the share of equal samples estimates it.

Everything about a text happens in the task that holds it: texts are shuffled once, to buckets of neighbouring ids, and
terms are counted and sampled there without another shuffle.

Null texts are empty; texts without words have the fingerprint of zeros, equal to each other and unlike all others. Rows
with the same id are ordered by text, null ids come first. An empty table gives no rows; in a table of one row the next
document is the row itself.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewise.llm.common import partitions

#: Samples of a fingerprint.
SAMPLES = 32
#: Samples that are taken in one row: few enough columns for generated code.
GROUP = 8
#: A text loses a sample with the probability exp(-RARE).
RARE = 30.0
#: Buckets of neighbouring ids for each shuffle partition, and the error of their bounds in buckets.
BUCKETS, ACCURACY = 4, 50

_BLANK = r"[\x20\x09-\x0D]+"


def _uniform(hashed: Column, shift: int, bits: int) -> Column:
    """``bits`` bits of a hash as a number strictly between 0 and 1."""
    part = F.shiftrightunsigned(hashed, shift).bitwiseAND(F.lit((1 << bits) - 1))
    return (part + F.lit(0.5)) * F.lit(2.0**-bits)


def _sampled(term: Column, k: Column, log_weight: Column, limit: Column) -> Column:
    """A number that is smallest for the sampled term: hash value in the high bits, a name of term and t in the low 32 bits.

    The smallest hash value e**v in a text of W words is exponential with rate W, so it is above RARE / W with a probability
    of e**-RARE. Terms that a bound without logarithms, (1 - e**-c) e**-r / S, puts above that are skipped: null.
    """
    first = F.xxhash64(k, term)
    second = F.xxhash64(first)
    r_product = _uniform(first, 0, 21) * _uniform(first, 21, 21)
    c_product = _uniform(second, 0, 32) * _uniform(second, 32, 32)
    r, log_c, b = -F.ln(r_product), F.ln(-F.ln(c_product)), _uniform(first, 42, 22)
    t = F.floor(log_weight / r + b)
    value = log_c - r * (t + F.lit(1.0) - b)
    name = term.bitwiseXOR(t * F.lit(0x9E3779B1)).bitwiseAND(F.lit(0xFFFFFFFF))
    packed = F.shiftleft(((value + F.lit(64.0)) * F.lit(float(1 << 24))).cast("long"), 32).bitwiseOR(name)
    return F.when((F.lit(1.0) - c_product) * r_product <= limit, packed)


def words_of(text: Column) -> Column:
    """Lower-cased words; an empty one may stand before and behind."""
    return F.split(F.lower(text), _BLANK)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples of two fingerprints (arrays)."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x) / F.size(a)


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """bucket, place, extra, doc_id, text, following: each text with that of the next document by id, the last with the first's.

    Ids are cut into buckets at ids of the table. The first row of each bucket is also put, as an extra row, at the end of
    the bucket before, so every bucket knows what follows its last row.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    n = partitions(docs.sparkSession) * BUCKETS
    found = docs.select(key.alias("key")).agg(
        F.percentile_approx("key", [i / n for i in range(n)], n * ACCURACY).alias("cuts"), F.min("key").alias("first")
    ).first()
    bounds = sorted({found["first"] or 0, *(found["cuts"] or [])})
    stride = math.isqrt(len(bounds)) + 1
    every, coarse = F.array(*map(F.lit, bounds)), F.array(*map(F.lit, bounds[::stride]))
    up_to = lambda array: F.size(F.filter(array, lambda bound: bound <= F.col("key")))
    rows = (
        docs.select(key.alias("key"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        .withColumn("coarse", (up_to(coarse) - 1) * stride)
        .withColumn("own", F.col("coarse") + up_to(F.slice(every, F.col("coarse") + 1, F.lit(stride))) - 1)
    )
    before = F.when(F.col("own") > 0, F.col("own") - 1).otherwise(F.lit(len(bounds) - 1))
    places = F.array(F.struct(F.col("own").alias("bucket"), F.lit(False).alias("extra")))
    twice = F.array_append(places, F.struct(before.alias("bucket"), F.lit(True).alias("extra")))
    first = F.get(every, F.col("own")) == F.col("key")
    order = Window.partitionBy("bucket").orderBy("extra", "key", "text")
    return (
        rows.select("doc_id", "text", "key", F.inline(F.when(first, twice).otherwise(places)))
        .select("*", F.row_number().over(order).alias("place"), F.lead("text").over(order).alias("following"))
        .drop("key")
    )


#: 32-bit numbers of a SHA-256 digest.
_DIGEST_PARTS = 8


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each row of ``docs``.

    The edited text is the text whose last half is replaced by as many first characters of the next document.
    Fingerprints are ``samples`` numbers of 8 hex digits.
    """
    half = F.floor(F.length("text") / 2)
    texts = (
        neighbours(docs, id_col, text_col)
        .withColumn("edited", F.concat(
            F.substring(F.col("text"), F.lit(1), (F.length("text") - half).cast("int")),
            F.substring(F.coalesce(F.col("following"), F.lit("")), F.lit(1), half.cast("int")),
        ))
        .withColumn("digest", F.sha2("edited", 256))
    )
    digest = [F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("long") for i in range(_DIGEST_PARTS)]
    about = [F.col("doc_id"), F.length("text").cast("long"), F.col("extra").cast("long"), *digest]
    known = [f"about{i}" for i in range(len(about))]
    # kind 0: a word of both texts; 1: of the text; 2: of the edited text; 3: something known of the document
    from_here = F.lit(1 << 30)
    both = F.array(
        F.struct(F.lit(0).alias("kind"), F.slice("words", F.lit(1), F.col("common")).alias("words")),
        F.struct(F.lit(1).alias("kind"), F.slice("words", F.col("common") + 1, from_here).alias("words")),
        F.struct(F.lit(2).alias("kind"), F.slice("edited_words", F.col("common") + 1, from_here).alias("words")),
        F.struct(F.lit(3).alias("kind"), F.transform(F.array(*about), lambda x: x.cast("string")).alias("words")),
    )
    sizes = F.shiftleft(F.size("words").cast("long"), 32).bitwiseOR(F.size("edited_words").cast("long"))
    kind = F.when(F.col("kind") < 3, F.lit(0)).otherwise(F.col("at") + 1)
    term = F.when(F.col("kind") < 3, F.xxhash64("word")).otherwise(F.col("word").cast("long"))
    counted = (
        texts.withColumns({
            "words": words_of(F.col("text")), "edited_words": words_of(F.col("edited")),
            # the words before the one that the cut is in are the same in both
            "common": F.size(words_of(F.substring(F.col("text"), F.lit(1), (F.length("text") - half).cast("int")))) - 1,
        })
        .select("bucket", "place", sizes.alias("sizes"), F.inline(both))
        .select("bucket", "place", "sizes", "kind", F.posexplode("words").alias("at", "word"))
        .where("kind = 3 OR word != ''")
        .groupBy("bucket", "place", "sizes", kind.alias("about"), term.alias("term"))
        .agg(F.sum(F.when(F.col("kind").isin(0, 1), 1)).alias("weight0"), F.sum(F.when(F.col("kind").isin(0, 2), 1)).alias("weight1"))
    )
    limit = lambda side, size: F.coalesce(F.col(f"weight{side}") * F.lit(RARE) / size, F.lit(-1.0))
    each = F.when(F.col("about") > 0, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(-(-samples // GROUP) - 1)))
    weighted = counted.select(
        "bucket", "place", "about", "term", F.ln("weight0").alias("log0"), F.ln("weight1").alias("log1"),
        limit(0, F.shiftrightunsigned("sizes", 32)).alias("limit0"), limit(1, F.col("sizes").bitwiseAND(F.lit(0xFFFFFFFF))).alias("limit1"),
        F.explode(each).alias("group"),
    )
    mins = [
        F.min(_sampled(F.col("term"), F.col("group") * GROUP + i, F.col(f"log{side}"), F.col(f"limit{side}"))).alias(f"m{side}_{i}")
        for i in range(GROUP)
        for side in (0, 1)
    ]
    facts = [F.max(F.when(F.col("about") == i + 1, F.col("term"))).alias(name) for i, name in enumerate(known)]
    sampled = weighted.groupBy("bucket", "place", "group").agg(*facts, *mins)
    part = lambda side: F.array(
        *(F.coalesce(F.col(f"m{side}_{i}").bitwiseAND(F.lit(0xFFFFFFFF)), F.lit(0)) for i in range(GROUP))
    )
    gathered = (
        sampled.select("bucket", "place", "group", *known, part(0).alias("own"), part(1).alias("edited"))
        .groupBy("bucket", "place")
        .agg(*(F.max(name).alias(name) for name in known), F.sort_array(F.collect_list(F.struct("group", "own", "edited"))).alias("parts"))
    )
    none = F.array_repeat(F.lit(0).cast("long"), samples)
    whole = lambda side: F.slice(F.concat(F.flatten(F.col(f"parts.{side}")), none), 1, samples)
    order = Window.partitionBy("bucket").orderBy("place")
    hexed = lambda numbers: F.array_join(F.transform(numbers, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")
    return (
        gathered.select(
            "bucket", "place", F.col("about0").alias("doc_id"), F.col("about1").alias("n_chars"), F.col("about2").alias("extra"),
            hexed(F.array(*(F.col(f"about{3 + i}") for i in range(_DIGEST_PARTS)))).alias("edited_sha256"),
            whole("own").alias("own"), whole("edited").alias("edited"),
        )
        .withColumn("next", F.lead("own").over(order))
        .where("extra = 0")
        .select(
            "doc_id", "n_chars", "edited_sha256", hexed(F.col("own")).alias("fingerprint"),
            hexed(F.col("edited")).alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("edited")).alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next"),
        )
    )
