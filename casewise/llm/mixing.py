"""Mixing sources to target weights by weighted fair queueing, with DataFrame functions only.

The documents of a source queue in an order given by a hash of their id and text, and again for every further round. Each
copy of a document finishes in virtual time: words of its source queued up to its end, divided by the source's target. All
copies are sorted globally by virtual finish time, and the queue is cut where its running total of words reaches the total
budget, the targets in whole words. The copy of a source in which virtual time 1 falls queues in two pieces, up to
there and from there on, so a source with long documents comes as near to its target as one with short ones. What the
sorted queue gives of each source is always the beginning of that source's own queue, which places the cut in every document.

All sums are in two levels. Places in a source's queue: over buckets of the hash, then inside a bucket. Places in the global
queue: over ranges of virtual time, then inside a range; every source gives its words evenly over virtual time, so
ranges of equal length hold equally many words and need no sample. A source with a large part of all rows is shared out over
all tasks.

Null sources are a source of their own, the last one. Null ids and repeated rows queue as rows of their own (rows equal
in id and text are interchangeable). Null, empty and blank texts have size 0 and nothing is taken of them. A table
without words has targets of 0. Other columns are kept; new columns that would clash get underscores in front.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewise.llm.common import WORD, Tables, added, partitions
from casewise.session import durable

#: Buckets of the hash and ranges of virtual time: one for so many rows, so many at most.
BUCKET_ROWS, MOST_BUCKETS = 512, 1 << 16
#: Columns that a mix adds.
NAMES = ("size", "source_size", "target", "queued", "taken", "virtual_finish")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """source_key, source_size -> also weight and target.

    Weights go round over the sources in code point order. The targets share ``share`` times all words by weight; a
    source above ``cap`` times its size gets that and the others share what is left, until none is above. The sources
    that reach their cap are those with the smallest caps by weight, so one pass in that order finds the level.
    There is one row for each source.
    """
    by_name = Window.orderBy(F.col("source_key") == "", "source_key")
    ranked = sizes.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, map(float, weights))), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    ).withColumn("cap", F.col("source_size") * F.lit(float(cap)))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source_key"))
    everything = Window.partitionBy()
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = left / F.sum("weight").over(after)
    return (
        ranked.withColumn("level", level)
        .withColumn("level", F.when(F.col("cap") > F.col("level") * F.col("weight"), F.col("level")))
        .withColumn("target", F.least("cap", F.coalesce(F.max("level").over(everything) * F.col("weight"), F.col("cap"))))
        .select("source_key", "source_size", "weight", "target")
    )


def time_range(finish: Column, ranges: int) -> Column:
    """Which of ``ranges`` equal parts of virtual time 0 to 1 a finish time is in; later ones are in the last."""
    return F.least(F.floor(finish * F.lit(ranges)), F.lit(ranges - 1)).cast("int")


def queue(placed: DataFrame, rounds: int, ranges: int) -> DataFrame:
    """source_key, size, total, target, queued -> a row for each piece in the queue: source_key, words, end, finish, range.

    ``end`` counts the words of the source up to the end of the piece. Copies that start when their source has given its
    target come after the budget in any order and are left out.
    """
    whole = F.floor("target")
    start = F.col("queued") + F.col("round") * F.col("total")
    served = F.least(F.col("size"), whole - start)
    both = F.array(
        F.struct(served.alias("words"), (start + served).alias("end")),
        F.struct((F.col("size") - served).alias("words"), (start + F.col("size")).alias("end")),
    )
    return (
        placed.where("size > 0 AND target > 0")
        .withColumn("round", F.explode(F.array(*(F.lit(r).cast("long") for r in range(rounds)))))
        .where(start < whole)
        .select("source_key", "target", F.inline(both))
        .where("words > 0")
        .withColumn("finish", F.col("end") / F.col("target"))
        .select("source_key", "words", "end", "finish", time_range(F.col("finish"), ranges).alias("range"))
    )


def truncated(queued: DataFrame, budget: int) -> DataFrame:
    """The queue sorted by finish time, with place (words before a piece) and given (its words within the budget)."""
    sums = queued.groupBy("range").agg(F.sum("words").alias("range_words"))
    offsets = sums.select(
        "range", (F.sum("range_words").over(Window.orderBy("range")) - F.col("range_words")).alias("offset")
    )  # one row for each range
    inside = Window.partitionBy("range").orderBy("finish", "source_key", "end")
    place = F.col("offset") + F.sum("words").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("words")
    return (
        queued.join(F.broadcast(offsets), "range")
        .withColumn("place", place)
        .withColumn("given", F.greatest(F.lit(0).cast("long"), F.least(F.col("words"), F.lit(budget) - F.col("place"))))
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = 17,
) -> DataFrame:
    """Every row of ``docs`` with its place in the mix.

    New columns: size (words), source_size, target (of the source, in words), queued (words of the source before this
    document in a round), taken (words the mix takes, repeats counted), virtual_finish (of its first copy; null when the
    target is 0). Equal inputs give equal results however they are partitioned.
    """
    rows = docs.count()
    buckets = max(1, min(MOST_BUCKETS, -(-rows // BUCKET_ROWS)))
    rounds = max(1, -int(-cap // 1))
    size, total, target, queued, taken, finish = added(docs, *NAMES)
    key, bucket, place, text_hash, offset, inner, given = added(
        docs, "mix_key", "mix_bucket", "mix_place", "mix_text_hash", "mix_offset", "mix_inner", "mix_given"
    )
    sized = docs.withColumns({
        size: n_words(F.col(text_col)),
        key: F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")),
        place: F.xxhash64(F.lit(seed), F.col(id_col), F.xxhash64(text_col)),
        text_hash: F.xxhash64(text_col),  # known before the shuffle, which needs no text then
    }).withColumn(bucket, F.pmod(F.shiftrightunsigned(place, 20), F.lit(buckets)))
    sums = durable(sized.groupBy(key, bucket).agg(F.sum(size).alias("bucket_size")))
    sources = durable(targets(
        sums.groupBy(F.col(key).alias("source_key")).agg(F.sum("bucket_size").alias("source_size")), weights, share, cap
    ))
    up_to = Window.partitionBy(key).orderBy(bucket)
    offsets = (
        sums.withColumn(offset, F.sum("bucket_size").over(up_to) - F.col("bucket_size"))
        .join(sources.withColumnRenamed("source_key", key), key)
        .select(key, bucket, offset, F.col("source_size").alias(total), F.col("target").alias(target))
    )
    inside = Window.partitionBy(key, bucket).orderBy(place, id_col, text_hash)
    placed = (
        sized.join(offsets, [key, bucket])
        .withColumn(inner, F.sum(size).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(size))
        .withColumn(queued, F.col(offset) + F.col(inner))
    )
    tables = Tables(docs.sparkSession)
    narrow = placed.select(
        F.col(key).alias("source_key"), F.col(size).alias("size"), F.col(total).alias("total"), F.col(target).alias("target"),
        F.col(queued).alias("queued"),
    )
    pieces = tables.store(queue(narrow, rounds, buckets), "queue")
    budget = sources.agg(F.sum(F.floor("target"))).first()[0] or 0
    of_source = durable(truncated(pieces, budget).groupBy(F.col("source_key").alias(key)).agg(F.sum("given").alias(given)))
    tables.drop()
    copies = [
        F.greatest(F.lit(0), F.least(F.col(size), F.col(given) - F.lit(copy) * F.col(total) - F.col(queued)))
        for copy in range(rounds)
    ]
    return placed.join(of_source, key, "left").withColumn(given, F.coalesce(given, F.lit(0))).withColumns({
        taken: sum(copies[1:], copies[0]).cast("long"),
        finish: F.when(F.col(target) > 0, (F.col(queued) + F.col(size)) / F.col(target)),
    }).select(*docs.columns, size, total, target, queued, taken, finish)


def in_order(mixed: DataFrame, copies: Column, id_col: str = "doc_id", names: Sequence[str] = NAMES) -> DataFrame:
    """Rows of a mix as often as ``copies`` says, sorted globally by virtual finish time; new columns copy (from 0) and finish.

    Partitions are ranges of virtual time in order, each sorted, so files written from it are the queue.
    """
    size, total, target, queued, *_ = names
    copy, finish = added(mixed, "copy", "finish")
    ranges = partitions(mixed.sparkSession)
    return (
        mixed.withColumn(copy, F.explode(F.when(copies > 0, F.sequence(F.lit(0), copies.cast("int") - 1)).otherwise(F.array().cast("array<int>"))))
        .withColumn(finish, (F.col(queued) + F.col(size) + F.col(copy) * F.col(total)) / F.col(target))
        .repartitionById(ranges, time_range(F.col(finish), ranges))
        .sortWithinPartitions(finish, id_col, copy)
    )


def schedule(mixed: DataFrame, id_col: str = "doc_id", names: Sequence[str] = NAMES) -> DataFrame:
    """One row for each copy that the mix takes, sorted globally by virtual finish time.

    New columns: copy (from 0), finish, words (of this copy, fewer than its size only where the budget ends).
    """
    size, taken = names[0], names[4]
    copy, _, words = added(mixed, "copy", "finish", "words")
    begun = F.when(F.col(taken) > 0, F.ceil(F.col(taken) / F.col(size)))
    left = F.col(taken) - F.col(copy) * F.col(size)
    return in_order(mixed, begun, id_col, names).withColumn(words, F.least(F.col(size), left))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that the mix takes, whole, once for each copy, in the order of the queue (virtual finish time).

    The last copy of a document is kept if at least half of it is taken; a document of which less than half a copy is taken
    goes. Documents without words are not part of a mix.
    """
    names = added(docs, *NAMES)
    size, taken = names[0], names[4]
    copies = F.when(F.col(taken) > 0, F.floor(F.col(taken) / F.col(size) + F.lit(0.5)))
    return in_order(mix(docs, id_col=id_col, **options), copies, id_col, names).select(*docs.columns)
