"""Training-order materialisation: token sequences in a permuted global order, in shards of fixed stride.

Each document's token ids are cut into sequences of ``length`` ids. Sequences get dense numbers (two-level sums over buckets
of a hash of the id), and a keyed Feistel network over the smallest even number of bits that holds them permutes the
numbers; numbers that leave the range walk the cycle until they are inside. So every sequence has its slot in the training
order, a function of key, number and count alone, without a sort of random numbers.

Slots are dense, so ranges of slots are known beforehand: each task gets one range and ``write_shards`` writes its records in
order, one file for each shard, in a few rounds so that the shuffle holds a part of the ids at a time. A reader that stopped at slot s goes on at record s - first_slot of the shard that holds s:
``read_shards`` gives what follows as a table, ``records_from`` one shard after the other. A record is the number of ids (4
bytes), then ``length`` ids of ``width`` bytes each, all little-endian, padded with zeros. In a file, each record follows 13
bytes that say where it comes from (1 or, for a null id of the document, 0; the id, 8 bytes; the part, 4 bytes) and ends with a
line feed, so that Spark's text writer can lay records end to end at a fixed stride.

Null texts are empty, and a document without ids has no sequence. Null ids of documents and repeated rows are sequences of
their own; among rows equal in id and ids the numbers are interchangeable. An empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from casewise.llm.common import Tables, partitions
from casewise.operators.joins import BROADCAST_ROWS

ROUNDS = 4
#: Sequences in a shard.
SHARD = 1024
BUCKET_ROWS, MOST_BUCKETS = 512, 1 << 16
#: How tables of ids are written.
DENSE = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}
#: Shards are written in so many rounds, each with a part of the shards, so that only a part of the ids is in a shuffle at a time.
ROUNDS_OF_SHARDS = 4


def feistel(number: Column, key: int, half_bits: int) -> Column:
    """A permutation of the numbers of ``2 * half_bits`` bits."""
    mask = (1 << half_bits) - 1
    halves = F.array(F.shiftright(number, half_bits), number.bitwiseAND(F.lit(mask)))
    keys = F.array(*(F.lit(key * 1_000_003 + i).cast("long") for i in range(ROUNDS)))
    last = F.aggregate(
        keys, halves,
        lambda two, k: F.array(
            F.get(two, F.lit(1)), F.get(two, F.lit(0)).bitwiseXOR(F.xxhash64(k, F.get(two, F.lit(1))).bitwiseAND(F.lit(mask)))
        ),
    )
    return F.shiftleft(F.get(last, F.lit(0)), half_bits).bitwiseOR(F.get(last, F.lit(1)))


def half_bits_of(n: int) -> int:
    return max(1, -(-max(1, n - 1).bit_length() // 2))


def slots(numbers: DataFrame, number: str, n: int, key: int, tables: Tables) -> DataFrame:
    """The column ``slot``: numbers 0 to n - 1, permuted.

    The network's range is at most four times n, so three of four numbers at most walk on, and a number is walked to its end
    inside the expression. The few that need more than ``WALK`` steps are found among the numbers alone, walked on as a small
    table, and joined.
    """
    half = half_bits_of(n)

    def walk(value: Column) -> Column:
        step = lambda at, _: F.when(at < n, at).otherwise(feistel(at, key, half))
        # runs of 1, 1, 2, 4 ... steps, WALK in all: a number that is inside walks no more run
        runs = [1]
        while sum(runs) < WALK:
            runs.append(min(WALK - sum(runs), sum(runs)))
        return F.aggregate(
            F.array(*map(F.lit, runs)), feistel(value, key, half),
            lambda at, run: F.when(at < n, at).otherwise(F.aggregate(F.sequence(F.lit(1), run), at, step)),
        )

    outside = numbers.sparkSession.range(n).select(F.col("id").alias(number), walk(F.col("id")).alias("slot"))
    left = tables.store(outside.where(F.col("slot") >= n), "walk-0")
    if left.isEmpty():
        return numbers.withColumn("slot", walk(F.col(number)))
    turn, done = 0, []
    while not left.isEmpty():
        turn += 1
        walked = tables.store(left.withColumn("slot", walk(F.col("slot"))), f"walk-{turn}")
        done.append(walked.where(F.col("slot") < n))
        left = walked.where(F.col("slot") >= n)
    late = done[0]
    for more in done[1:]:
        late = late.unionByName(more)
    late = late.withColumnRenamed("slot", "late")
    if late.count() <= BROADCAST_ROWS:
        late = F.broadcast(late)
    joined = numbers.join(late, number, "left")
    return joined.withColumn("slot", F.coalesce(F.col("late"), walk(F.col(number)))).drop("late")


#: Steps of the cycle walk in the expression: about one number in 100 million is still outside after that many.
WALK = 64


def numbered(counts: DataFrame, tables: Tables) -> tuple[DataFrame, int]:
    """(doc_id, fingerprint, n_seqs) -> also ``first``, the number of the document's first sequence; and how many there are."""
    buckets = max(1, min(MOST_BUCKETS, -(-counts.count() // BUCKET_ROWS)))
    placed = counts.withColumn("place", F.xxhash64("doc_id", "content")).withColumn(
        "bucket", F.pmod(F.shiftrightunsigned("place", 20), F.lit(buckets))
    )
    sums = placed.groupBy("bucket").agg(F.sum("n_seqs").alias("total"))
    offsets = sums.withColumn(
        "offset", F.sum("total").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("total")
    ).drop("total")  # one row for each bucket, ``MOST_BUCKETS`` at most
    inside = Window.partitionBy("bucket").orderBy("place", "doc_id", "content").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = placed.join(offsets, "bucket").withColumn(
        "first", F.col("offset") + F.sum("n_seqs").over(inside) - F.col("n_seqs")
    )
    total = sums.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("n")).first()["n"]
    return out.drop("place", "bucket", "offset"), total


def sequences(docs: DataFrame, id_col: str, bytes_col: str, length: int, width: int) -> DataFrame:
    """doc_id, part, ids (binary): the ids of each document, cut."""
    step = length * width
    parts = F.ceil(F.length(bytes_col) / step).cast("int")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(bytes_col).alias("whole")).withColumn(
        "part", F.explode(F.when(parts > 0, F.sequence(F.lit(0), parts - 1)))
    ).select("doc_id", "part", F.substring(F.col("whole"), F.col("part") * step + 1, F.lit(step)).alias("ids"))


def little_endian(number: Column, size: int = 4) -> Column:
    """An int of ``size`` bytes as binary."""
    byte = lambda i: F.shiftrightunsigned(number.cast("long"), 8 * i).bitwiseAND(F.lit(255))
    turned = functools.reduce(Column.bitwiseOR, (F.shiftleft(byte(i), 8 * (size - 1 - i)) for i in range(size)))
    return F.unhex(F.lpad(F.hex(turned), 2 * size, "0"))


def materialised(
    docs: DataFrame, id_col: str = "doc_id", bytes_col: str = "ids", length: int = 1024, width: int = 1, key: int = 2024,
    shard: int = SHARD, tables: Tables | None = None,
) -> DataFrame:
    """slot, shard, row (in its shard), doc_id, part, n_ids, record: in slot order, one range of whole shards in each partition.

    ``bytes_col`` holds the ids, ``width`` bytes each, little-endian. The result is read from ``tables`` and no more from ``docs``,
    which is read once: the ids are stored with the columns that number them, then as sequences with their slots.
    """
    tables = tables or Tables(docs.sparkSession)
    step = length * width
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(bytes_col).alias("whole"),
    ).withColumns({"n_seqs": F.ceil(F.length("whole") / step).cast("long"), "content": F.xxhash64("whole")})
    firsts, total = numbered(tables.store(rows.where("n_seqs > 0"), "whole", **DENSE), tables)
    cut = firsts.withColumn("part", F.explode(F.sequence(F.lit(0), (F.col("n_seqs") - 1).cast("int")))).select(
        "doc_id", "part", (F.col("first") + F.col("part")).alias("number"),
        F.substring(F.col("whole"), F.col("part") * step + 1, F.lit(step)).alias("ids"),
    )
    n = partitions(docs.sparkSession)
    shards = -(-total // shard)
    placed = tables.store(slots(cut, "number", total, key, tables).drop("number"), "placed", **DENSE)
    tables.drop("whole")
    range_of = F.floor(F.floor(F.col("slot") / shard) * n / max(1, shards)).cast("int")
    n_ids = (F.length("ids") / width).cast("int")
    record = F.concat(little_endian(n_ids), F.rpad(F.col("ids"), step, F.lit(b"\0")))
    return (
        placed.repartitionById(n, range_of).sortWithinPartitions("slot")
        .select(
            "slot", F.floor(F.col("slot") / shard).alias("shard"), (F.col("slot") % shard).cast("int").alias("row"),
            "doc_id", "part", n_ids.alias("n_ids"), record.alias("record"),
        )
    )


def shard_files(records: DataFrame) -> DataFrame:
    """(shard, first_slot, n_records, payload): records of a shard laid end to end, ready to be written as one object each."""
    return records.groupBy("shard").agg(
        F.min("slot").alias("first_slot"), F.count(F.lit(1)).alias("n_records"),
        F.sort_array(F.collect_list(F.struct("slot", "record"))).alias("rows"),
    ).select("shard", "first_slot", "n_records", F.aggregate(
        "rows", F.lit(b""), lambda so_far, row: F.concat(so_far, row.record)
    ).alias("payload"))


#: Bytes before and after each record in a file.
HEAD, TAIL = 13, 1


def write_shards(records: DataFrame, folder: str) -> None:
    """Write what ``materialised`` gives: one file of records in slot order for each shard, in ``folder``/shard=<number>.

    In each of ``ROUNDS_OF_SHARDS`` rounds every task writes each so many-th shard of its range.
    """
    known = F.when(F.col("doc_id").isNull(), F.lit(b"\0")).otherwise(F.lit(b"\1"))
    line = F.concat(known, little_endian(F.coalesce("doc_id", F.lit(0)), 8), little_endian(F.col("part")), F.col("record"))
    for turn in range(ROUNDS_OF_SHARDS):
        (
            records.where(F.col("shard") % ROUNDS_OF_SHARDS == turn)
            .select("shard", "slot", line.cast("string").alias("line")).sortWithinPartitions("shard", "slot")
            .select("shard", "line").write.mode("append" if turn else "errorifexists")
            .partitionBy("shard").option("lineSep", "\n").text(folder)
        )


def read_shards(
    spark: SparkSession, folder: str, length: int = 1024, width: int = 1, shard: int = SHARD, first_slot: int = 0
) -> DataFrame:
    """slot, shard, row, doc_id, part, n_ids, record of all slots from ``first_slot`` on; files of earlier shards are not read."""
    files = spark.read.format("binaryFile").load(folder)
    if "shard" not in files.columns:  # no sequences
        files = files.withColumn("shard", F.lit(0))
    stride = HEAD + 4 + length * width + TAIL
    head = np.dtype([("known", "u1"), ("doc_id", "<i8"), ("part", "<i4"), ("n_ids", "<i4"), ("ids", "V", length * width), ("end", "V", TAIL)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                number, content = batch.column(0)[i].as_py(), batch.column(1)[i].as_buffer()
                found = np.frombuffer(content, head, len(content) // stride)
                slot = number * shard + np.arange(len(found))
                kept = np.flatnonzero(slot >= first_slot)
                raw = np.frombuffer(content, np.uint8, len(found) * stride).reshape(-1, stride)[kept, HEAD : stride - TAIL]
                ends = np.arange(len(kept) + 1, dtype=np.int32) * (stride - HEAD - TAIL)
                yield pa.RecordBatch.from_arrays([
                    pa.array(slot[kept]), pa.array(np.full(len(kept), number)), pa.array(kept, pa.int32()),
                    pa.array(found["doc_id"][kept].astype(np.int64), mask=found["known"][kept] == 0),
                    pa.array(found["part"][kept].astype(np.int32)), pa.array(found["n_ids"][kept].astype(np.int32)),
                    pa.Array.from_buffers(pa.binary(), len(kept), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(raw))]),
                ], ["slot", "shard", "row", "doc_id", "part", "n_ids", "record"])

    wanted = files.where((F.col("shard") >= first_slot // shard) & (F.length("content") > 0))
    return wanted.select(F.col("shard").cast("long").alias("shard"), "content").mapInArrow(
        run, "slot bigint, shard bigint, row int, doc_id bigint, part int, n_ids int, record binary"
    )


def records_from(
    spark: SparkSession, folder: str, shard_number: int, first_slot: int, length: int = 1024, width: int = 1, shard: int = SHARD
) -> Iterator[Row]:
    """The rows of ``read_shards`` in slot order from ``first_slot``, in shard ``shard_number``, on; one shard at a time is read."""
    while True:
        rows = read_shards(spark, folder, length, width, shard, max(first_slot, shard_number * shard))
        held = rows.where(F.col("shard") == shard_number).orderBy("slot").collect()
        yield from held
        if not held or held[-1].slot != (shard_number + 1) * shard - 1:
            return
        shard_number += 1
