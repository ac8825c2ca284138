"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

Rows with equal texts form a group that stays in one shard. Differencing adds the two partial
partitions with the largest spread oppositely ordered, until one is left. Up to GROUPS_PER_PART
groups each enter it alone. Of more groups those larger than an even bundle do, and the small ones
are summed into bundles by hash, which still are fine enough to level the large ones: no shares are
levelled before all large groups are in. A group's rows never meet in a task: groups come from a
map-side combined aggregate of digests, and rows get their shard by a join that adaptive execution
splits at hot groups.

Contract: size is the UTF-8 length of the text plus 1 (null: 1; null and empty are equal texts);
repeated rows and repeated or null keys are rows like others; an empty table gives no row; ties go
by digest; texts of any length count whole; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ideamill.llm.common import written

# Items differenced in one task.
GROUPS_PER_PART = 1 << 17


def differencing(sums: list[list[int]]) -> tuple[list[int], list[list[int]]]:
    """Combine partial partitions into one of the same width.

    Each item holds its bins' sums. Returns the final sums and, for each item, the final bin of each
    of its bins.
    """
    if not sums:
        return [], []
    k = len(sums[0])
    # A heap entry is a partition: bins in descending order, and what was joined to make it.
    nodes, heap = [], []
    for i, own in enumerate(sums):
        order = sorted(range(k), key=lambda b: (-own[b], b))
        nodes.append((i, order))
        heap.append((own[order[-1]] - own[order[0]], i, [own[b] for b in order]))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, left = heapq.heappop(heap)
        _, b, right = heapq.heappop(heap)
        joined = [x + y for x, y in zip(left, reversed(right))]
        order = sorted(range(k), key=lambda n: (-joined[n], n))
        nodes.append((a, b, order))
        top = [joined[n] for n in order]
        heapq.heappush(heap, (top[-1] - top[0], len(nodes) - 1, top))
    final = heap[0][2]
    places: list[list[int]] = [[0] * k for _ in sums]
    # From the last partition back: a node's ordered bin n lies in final bin at[n].
    waiting = [(heap[0][1], list(range(k)))]
    while waiting:
        n, at = waiting.pop()
        if len(nodes[n]) == 2:
            i, order = nodes[n]
            for spot, own in enumerate(order):
                places[i][own] = at[spot]
        else:
            a, b, order = nodes[n]
            of = [0] * k
            for spot, joint in enumerate(order):
                of[joint] = at[spot]
            waiting.append((a, of))
            waiting.append((b, of[::-1]))
    return final, places


def balanced_groups(groups: DataFrame, shards: int) -> DataFrame:
    """groups (digest, size) with the shard of each. groups must be a written table."""
    count, total = groups.agg(F.count("*"), F.sum("size")).first()
    few = count <= GROUPS_PER_PART
    bundles = GROUPS_PER_PART // 2
    # Less than `bundles` groups are larger than an even bundle, so items are GROUPS_PER_PART at most.
    alone = F.lit(True) if few else F.col("size") > total // bundles
    named = groups.select("digest", "size", F.when(alone, F.col("digest")).alias("own"),
                          F.when(~alone, F.pmod(F.xxhash64("digest"), F.lit(bundles))).cast("int").alias("bundle"))

    def local(batches: Iterator[pa.RecordBatch]):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks().sort_by(
            [("size", "descending"), ("own", "ascending"), ("bundle", "ascending")])
        # An item is a partition with one bin in use.
        _, places = differencing([[s] + [0] * (shards - 1) for s in table["size"].to_pylist()])
        table = table.drop_columns("size").append_column("shard", pa.array([p[0] for p in places], pa.int32()))
        yield from table.to_batches(max_chunksize=10_000)

    kind = groups.schema["digest"].dataType.simpleString()
    items = named.select("own", "bundle", "size") if few else named.groupBy("own", "bundle").agg(F.sum("size").alias("size"))
    placed = written(items.repartition(1).mapInArrow(local, f"own {kind}, bundle int, shard int"), "kk-items")
    single = placed.where("own IS NOT NULL").select(F.col("own").alias("digest"), "shard")
    if few:
        return single
    bundled = named.where("bundle IS NOT NULL").join(placed.where("bundle IS NOT NULL").select("bundle", "shard"), "bundle")
    return single.unionByName(bundled.select("digest", "shard"))


def shard_documents(docs: DataFrame, shards: int) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): every row with its shard and its place there."""
    text = F.coalesce("text", F.lit(""))
    rows = written(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.sha2(text, 256).alias("digest")), "sized")
    groups = written(rows.groupBy("digest").agg(F.sum("size").alias("size")), "groups")
    placed = written(rows.join(balanced_groups(groups, shards), "digest").drop("digest")
                     .withColumn("part", F.spark_partition_id()), "sharded")
    # Slots: rows count on within a part, parts count on within a shard.
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")
    return placed.withColumn("row", F.row_number().over(inside)).join(starts, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("row") - 1 + F.col("before")).cast("long").alias("slot"))
