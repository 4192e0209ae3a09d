"""Bringing each row together with the model of its key, whatever the number of models and the size of a key.

Models that are small together travel to the tasks once. Beyond a measured size, rows and models are shuffled by key: a
key with many rows is cut into parts by a hash, each part gets its own copy of the model, and a task reads the model of
a part and then its rows, batch by batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewise.operators.joins import lookup
from casewise.session import durable

#: Models up to this size together are sent to all tasks.
BROADCAST_BYTES = 48 << 20
#: Rows of a key that are worth a part of their own.
PART_ROWS = 50_000
#: Keys in one batch beyond which rows are shuffled by key, so that work on a key is done in large pieces.
FEW_KEYS = 64

Run = Callable[[object, pa.RecordBatch], Iterator[pa.RecordBatch]]


def _struct_batch(column: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(column.flatten(), [f.name for f in column.type])


def routed(
    rows: DataFrame, models: DataFrame, sizes: DataFrame, prepare: Callable[[list[dict]], object], run: Run, schema: str,
    most_bytes: int = BROADCAST_BYTES, part_rows: int = PART_ROWS, few_keys: int = FEW_KEYS,
) -> DataFrame:
    """``run(model, batch)`` for the rows of each key.

    ``rows`` and ``models`` (a stored table, several rows a key) have the column ``space``; ``sizes`` is (space, bytes).
    ``prepare`` makes a model of the rows of its key, and an empty list stands for a key without one.
    """
    spark = rows.sparkSession
    total = sizes.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    if total["bytes"] <= most_bytes and total["n"] <= few_keys:
        held: dict[str, list[dict]] = {}
        for r in models.toLocalIterator():
            held.setdefault(r["space"], []).append(r.asDict())
        shared = spark.sparkContext.broadcast(held)

        def everywhere(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            made: dict[str | None, object] = {}
            for batch in batches:
                keys = batch.column("space").dictionary_encode()
                codes = keys.indices.fill_null(-1).to_numpy(zero_copy_only=False)
                names = [*keys.dictionary.to_pylist(), None]  # the last is for rows without a key
                for code in sorted(set(codes.tolist())):
                    key = names[code]
                    if key not in made:
                        made[key] = prepare(shared.value.get(key, []))
                    yield from run(made[key], batch.filter(pa.array(codes == code)))

        return rows.mapInArrow(everywhere, schema)

    counts = durable(rows.groupBy("space").agg((F.count(F.lit(1)) / part_rows).cast("int").alias("more")))
    own = F.xxhash64(*[c for c in rows.columns if c != "space"])
    dealt = lookup(rows, counts.where("space IS NOT NULL AND more > 0"), ["space"]).select(
        "space", F.pmod(own, F.coalesce("more", F.lit(0)) + 1).cast("int").alias("part"), F.lit(1).alias("kind"),
        F.lit(None).cast(models.schema.simpleString()).alias("model"), F.struct(*rows.columns).alias("row"),
    )
    copies = F.explode(F.sequence(F.lit(0), F.col("more")))
    sent = models.join(counts, "space").withColumn("part", copies).select(
        "space", "part", F.lit(0).alias("kind"), F.struct(*models.columns).alias("model"),
        F.lit(None).cast(rows.schema.simpleString()).alias("row"),
    )

    def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, model = None, [], None
        for batch in batches:
            keys, parts, kinds = (batch.column(i).to_pylist() for i in range(3))
            low = 0
            while low < batch.num_rows:
                here, kind = (keys[low], parts[low]), kinds[low]
                high = low + 1
                while high < batch.num_rows and (keys[high], parts[high]) == here and kinds[high] == kind:
                    high += 1
                if here != at:
                    at, held, model = here, [], None
                if kind == 0:
                    held += batch.column(3).slice(low, high - low).to_pylist()
                else:
                    if model is None:
                        model = prepare(held)
                        held = []
                    yield from run(model, _struct_batch(batch.column(4).slice(low, high - low)))
                low = high

    both = dealt.unionByName(sent).repartition("space", "part").sortWithinPartitions("space", "part", "kind")
    return both.mapInArrow(in_order, schema)
