"""Resharding by minimum-cost flow.

From the bytes of each old shard and the capacities of the new ones, a minimum-cost flow says how
many bytes go from where to where so that the fewest move. Old shards are cut into blocks by a hash
of doc_id; whole blocks follow the flow, and only the few blocks at the edge of a flow are split
between shards, document by document. Shards that neither gain nor lose keep their files.
"""

import math
from collections import defaultdict
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketframe.llm.common import ship, spill
from marketframe.session import scratch_dir

FINE_BLOCKS = 4096  # most blocks of one old shard
BLOCK_DOCS = 512  # documents that a block should hold at least


def min_cost_flow(
    supply: Sequence[int], demand: Sequence[int], cost: Sequence[Sequence[int]]
) -> list[list[int]]:
    """Cheapest flow[i][j] that sends every supply to the demands; their totals are equal.

    Successive shortest paths with Bellman-Ford, on as many nodes as there are shards.
    """
    rows, columns = len(supply), len(demand)
    source, sink = rows + columns, rows + columns + 1
    edges: list[list[int]] = []  # to, capacity left, cost; edge e and e ^ 1 are opposite
    leaving: list[list[int]] = [[] for _ in range(sink + 1)]

    def add(a: int, b: int, capacity: int, price: int) -> None:
        for x, y, c, p in ((a, b, capacity, price), (b, a, 0, -price)):
            leaving[x].append(len(edges))
            edges.append([y, c, p])

    for i, s in enumerate(supply):
        add(source, i, s, 0)
    for j, d in enumerate(demand):
        add(rows + j, sink, d, 0)
    first = len(edges)
    for i in range(rows):
        for j in range(columns):
            add(i, rows + j, min(supply[i], demand[j]), cost[i][j])
    while True:
        distance, via = [math.inf] * (sink + 1), [-1] * (sink + 1)
        distance[source], changed = 0, True
        while changed:
            changed = False
            for a in range(sink + 1):
                for e in leaving[a] if distance[a] < math.inf else ():
                    b, left, price = edges[e]
                    if left and distance[a] + price < distance[b]:
                        distance[b], via[b], changed = distance[a] + price, e, True
        if distance[sink] == math.inf:
            break
        path, node = [], sink
        while node != source:
            path.append(via[node])
            node = edges[via[node] ^ 1][0]
        amount = min(edges[e][1] for e in path)
        for e in path:
            edges[e][1] -= amount
            edges[e ^ 1][1] += amount
    return [
        [edges[(first + 2 * (i * columns + j)) ^ 1][1] for j in range(columns)] for i in range(rows)
    ]


def capacities(total: int, weights: Sequence[float]) -> list[int]:
    """Whole capacities in proportion to ``weights`` that add up to ``total``."""
    edges, so_far = [0], 0.0
    for weight in weights:
        so_far += weight
        edges.append(round(total * so_far / sum(weights)))
    return [b - a for a, b in zip(edges, edges[1:], strict=False)]


def plan_moves(
    blocks: dict[int, list[tuple[int, int]]], flow: dict[int, dict[int, int]]
) -> tuple[list[tuple[int, int, int]], dict[tuple[int, int], dict[int, int]]]:
    """Whole blocks as (old, block, new); split ones as (old, block) -> bytes for each new shard.

    What stays comes first, so that the blocks that move are the last ones of a shard.
    """
    whole, split = [], {}
    for old, sizes in blocks.items():
        parts = sorted(flow[old].items(), key=lambda x: (x[0] != old, x[0]))
        parts = [[new, amount] for new, amount in parts if amount]
        for block, size in sorted(sizes):
            left, shares = size, {}
            while left and parts:
                take = min(left, parts[0][1])
                shares[parts[0][0]] = shares.get(parts[0][0], 0) + take
                left -= take
                parts[0][1] -= take
                if not parts[0][1]:
                    parts.pop(0)
            if len(shares) == 1:
                whole.append((old, block, next(iter(shares))))
            else:
                split[old, block] = shares
    return whole, split


def fill(sizes: list[int], shares: dict[int, int]) -> list[int]:
    """A shard for each size (descending) so that shards get their shares to within a small one."""
    left = dict(shares)
    out = []
    for size in sizes:
        best = max(left, key=lambda s: (left[s], -s))
        left[best] -= size
        out.append(best)
    return out


def text_size(text: Column) -> Column:
    """UTF-8 bytes of the text and one more."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def _split_blocks(edge: DataFrame, split: dict[tuple[int, int], dict[int, int]]) -> DataFrame:
    """``edge`` (old, block, doc_id, size, crc, n) with the shard of each row."""

    def assign(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["size", "doc_id", "crc"], ascending=[False, True, True])
        shares = split[int(frame["old"].iloc[0]), int(frame["block"].iloc[0])]
        return frame.assign(shard=fill((frame["size"] * frame["n"]).tolist(), shares))

    kind = "old int, block int, doc_id long, size long, crc long, n long, shard int"
    return edge.groupBy("old", "block").applyInPandas(assign, kind)


def reshard(
    docs: DataFrame,
    old_shard: Column,
    weights: Sequence[float] = (1,) * 8,
    path: str | None = None,
    fine_blocks: int = FINE_BLOCKS,
    block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """Every row of ``docs`` with its shard and slot, from the rewritten files.

    ``old_shard``: the shard a row is in now, from 0; null is shard 0. ``weights``: capacities of
    the new shards 0.. in proportion. Added: _shard, _slot (gapless from 0 in each shard), _size.
    A shard's size is within a few documents' rounding of its capacity. Files of shards that gain
    or lose are written below ``path``, a folder per shard, in slot order; rows of the others come
    from ``docs``. A null text has size 1. Rows that repeat doc_id and text move together; a null
    doc_id is like any other. An empty table gives no rows. Columns starting with ``_`` are reserved.
    """
    spark = docs.sparkSession
    ship(spark)
    names = docs.columns
    fine = F.pmod(F.xxhash64("doc_id"), F.lit(fine_blocks)).cast("int")
    keyed = docs.select(
        *names,
        F.coalesce(old_shard, F.lit(0)).cast("int").alias("_old"),
        fine.alias("_fine"),
        text_size(F.col("text")).alias("_size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("_crc"),
    )
    sums = keyed.groupBy("_old", "_fine").agg(F.sum("_size"), F.count("*")).collect()  # bounded
    rows_of: dict[int, int] = defaultdict(int)
    for old, _, _, n in sums:
        rows_of[old] += n
    per_shard = max(rows_of.values(), default=0) // block_docs
    n_blocks = min(fine_blocks, max(1, per_shard))
    sizes: dict[int, dict[int, int]] = defaultdict(lambda: defaultdict(int))
    counts: dict[tuple[int, int], int] = defaultdict(int)
    for old, fine_block, size, n in sums:
        block = fine_block * n_blocks // fine_blocks
        sizes[old][block] += size
        counts[old, block] += n
    olds = sorted(sizes)
    supply = [sum(sizes[o].values()) for o in olds]
    cost = [[int(o != j) for j in range(len(weights))] for o in olds]
    flows = min_cost_flow(supply, capacities(sum(supply), weights), cost)
    flow = {o: dict(enumerate(row)) for o, row in zip(olds, flows, strict=True)}
    whole, split = plan_moves({o: list(b.items()) for o, b in sizes.items()}, flow)
    block = F.floor(F.col("_fine") * n_blocks / fine_blocks).cast("int")
    keyed = keyed.withColumn("_block", block).drop("_fine")

    moves = spark.createDataFrame(whole, "_o int, _b int, _shard int")  # at most blocks x shards
    on = (F.col("_old") == F.col("_o")) & (F.col("_block") == F.col("_b"))
    placed = keyed.join(F.broadcast(moves), on).drop("_o", "_b")
    if split:
        cuts = spark.createDataFrame(list(split), "_o int, _b int")
        edge = keyed.join(F.broadcast(cuts), on).drop("_o", "_b")
        units = edge.groupBy(
            F.col("_old").alias("old"),
            F.col("_block").alias("block"),
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("_size").alias("size"),
            F.col("_crc").alias("crc"),
        ).agg(F.count("*").alias("n"))
        assigned = spill(_split_blocks(units, split), "edge")
        to = assigned.select(*[F.col(c).alias(f"_to_{c}") for c in assigned.columns])
        same = (
            (F.col("_old") == F.col("_to_old"))
            & (F.col("_block") == F.col("_to_block"))
            & F.col("doc_id").eqNullSafe(F.col("_to_doc_id"))
            & (F.col("_size") == F.col("_to_size"))
            & (F.col("_crc") == F.col("_to_crc"))
        )
        edge_rows = edge.join(to, same).select(*edge.columns, F.col("_to_shard").alias("_shard"))
        placed = placed.unionByName(edge_rows)

    # Slots: rows before the block in its shard, and the place within the block.
    edge_counts = assigned.groupBy("shard", "old", "block").agg(F.sum("n").alias("n")).collect() if split else []
    pieces = [(new, old, b, counts[old, b]) for old, b, new in whole] + [tuple(r) for r in edge_counts]
    bases, at = [], defaultdict(int)
    for shard, old, b, n in sorted(pieces):
        bases.append((shard, old, b, at[shard]))
        at[shard] += n
    base = spark.createDataFrame(bases, "_s int, _o int, _b int, _base long")
    on = (F.col("_shard") == F.col("_s")) & on
    placed = placed.join(F.broadcast(base), on).drop("_s", "_o", "_b")
    piece = ["_shard", "_old", "_block"]
    order = Window.partitionBy(*piece).orderBy(F.asc_nulls_first("doc_id"), "_crc", "_size")
    ordered = placed.repartitionByRange(*piece).withColumn(
        "_slot", F.col("_base") + F.row_number().over(order) - 1
    )
    out = ordered.select(*names, "_size", "_slot", "_shard")
    kept = {j for j in range(len(weights)) if _unmoved(flow, j)}
    path = path or f"{scratch_dir(spark, 'shards')}/files"
    out.filter(~F.col("_shard").isin(*kept)).write.partitionBy("_shard").parquet(path)
    schema = out.schema
    rewritten = spark.read.schema(schema).parquet(path).select(*out.columns)
    return rewritten.unionByName(out.filter(F.col("_shard").isin(*kept))) if kept else rewritten


def _unmoved(flow: dict[int, dict[int, int]], shard: int) -> bool:
    gained = any(row[shard] for old, row in flow.items() if old != shard)
    lost = any(amount for new, amount in flow.get(shard, {}).items() if new != shard)
    return not gained and not lost
