"""Ordered shards with halo rows.

Rows are range-partitioned by (key, order columns), so that a key holding any share of the table is
cut into time shards of about ``rows_per_shard`` rows. Each shard then receives the ``halo`` rows of
the same key that precede and follow it, which lets neighbourhood computations run per shard
without ever gathering a key in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OWN, BEFORE, AFTER = 0, 1, 2


def _edges(key: str, halo: int, last: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds copies of the shard's outermost rows, addressed to the neighbouring shards."""

    def tagged(rows: pa.Table, dest: int, kind: int) -> list[pa.RecordBatch]:
        n = rows.num_rows
        out = rows.append_column("_dest", pa.array([dest] * n, pa.int32())).append_column("_halo", pa.array([kind] * n, pa.int8()))
        return out.to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        me = TaskContext.get().partitionId()
        head, head_rows, head_open = [], 0, True
        tail: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            yield from tagged(rows, me, OWN)
            if head_open and me > 0:
                first = head[0][key][0] if head else rows[key][0]
                same = rows.slice(0, halo - head_rows)
                same = same.filter(pc.equal(same[key], first))
                head.append(same)
                head_rows += same.num_rows
                head_open = same.num_rows == rows.num_rows and head_rows < halo
            tail = rows if tail is None else pa.concat_tables([tail, rows])
            tail = tail.slice(max(0, tail.num_rows - halo)).combine_chunks()
        for part in head:
            if part.num_rows:
                yield from tagged(part, me - 1, AFTER)
        if tail is not None and me < last:
            same = tail.filter(pc.equal(tail[key], tail[key][tail.num_rows - 1]))
            yield from tagged(same, me + 1, BEFORE)

    return run


def over_shards(
    df: DataFrame,
    key: str,
    order: list[str],
    fn: Callable[[pa.Table], Iterator[pa.RecordBatch]],
    schema: T.StructType | str,
    rows: int,
    rows_per_shard: int = 150_000,
    halo: int = 2_000,
) -> DataFrame:
    """Run ``fn`` once per shard of ``df``.

    ``key`` is one non-null long column, ``order`` makes rows distinct within a key. ``rows`` is an
    upper bound of the row count (the scan's count, read from file footers). ``fn`` gets a whole
    shard, sorted by key and order, as an Arrow table with the extra column ``_halo``: 0 for the
    shard's own rows, 1 for rows that precede them, 2 for rows that follow.

    ``halo`` must stay well below ``rows_per_shard``: a shard only hears of its direct neighbours.
    """
    parts = max(1, -(-rows // rows_per_shard))
    ordered = [key, *order]
    base = T.StructType([*df.schema.fields, T.StructField("_dest", T.IntegerType()), T.StructField("_halo", T.ByteType())])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if got:
            yield from fn(pa.Table.from_batches(got).sort_by([(c, "ascending") for c in ordered]).combine_chunks())

    if parts == 1:
        only = df.withColumn("_dest", F.lit(0)).withColumn("_halo", F.lit(OWN).cast("tinyint")).repartition(1)
        return only.mapInArrow(whole, schema)
    shards = df.repartitionByRange(parts, *ordered).sortWithinPartitions(*ordered)
    exchanged = shards.mapInArrow(_edges(key, halo, parts - 1), base)
    return exchanged.repartitionById(parts, F.col("_dest")).mapInArrow(whole, schema)
