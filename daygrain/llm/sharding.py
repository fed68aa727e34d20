"""Shards cut from a Hilbert curve over metadata.

Each document is a point in a small grid whose axes are quantised metadata: source, language
and size, all by rank, so that every axis is used evenly whatever its values: sizes by quantiles, names by the
rows of the more frequent ones before them. The Hilbert curve visits the grid so that neighbours on the curve
are neighbours on every axis. Sorted by curve index and cut into runs, the documents of a shard span
a small box, so a reader that filters on any of the axes can skip most shards by their bounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.llm.tables import tasks_for, written

#: Bits for each axis of the grid.
BITS = 6
#: Rows for a task of the sort.
ROWS_PER_TASK = 1_000_000


def hilbert_index(axes: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of points with coordinates ``axes[d]`` in 0 .. 2**bits - 1.

    Skilling's transform: undo the rotations of the finer levels from the coarsest down, Gray-code
    the axes, then interleave their bits.
    """
    x = axes.astype(np.int64).copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            index = (index << 1) | ((x[i] >> b) & 1)
    return index


def _curve(bits: int):
    """Rows of (doc_id, size, text_crc32, axes …) with the index of the axes in their place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            axes = np.stack([batch.column(k).to_numpy() for k in range(3, batch.num_columns)])
            columns = [*batch.columns[:3], pa.array(hilbert_index(axes, bits))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "size", "text_crc32", "curve"])

    return run


def _ranked(value: Column, bounds: list) -> Column:
    """The cell of a number among ascending bounds; null is in the first."""
    if not bounds:
        return F.lit(0)
    listed = F.array(*[F.lit(b) for b in bounds])
    return F.when(value.isNull(), 0).otherwise(F.size(F.filter(listed, lambda b: b <= value)))


def name_cells(names: list[tuple[str | None, int]], total: int, bits: int) -> dict[str | None, int]:
    """Cells of the most frequent names, first come first: a name starts where the rows before it end."""
    cells, before, found = 1 << bits, 0, {}
    for name, count in names:
        found[name] = min(cells - 1, before * cells // max(1, total))
        before += count
    return found


def _named(value: Column, cells: dict[str | None, int], bits: int) -> Column:
    """The cell of a name; names that are not listed share the last one."""
    out = F.lit((1 << bits) - 1)
    for name, cell in cells.items():
        same = value.isNull() if name is None else value == F.lit(name)
        out = F.when(same, cell).otherwise(out)
    return out


def hilbert_shards(
    docs: DataFrame,
    shards: int = 40,
    bits: int = BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
    named: tuple[str, ...] = ("source", "lang"),
) -> DataFrame:
    """``doc_id, size, text_crc32, curve, shard, slot``: every row in one of ``shards`` runs of the curve.

    The driver learns ``2**bits`` names of each named axis and as many quantiles of the size.

    Law ``rows``: shard sizes in rows differ by one at most, the larger ones first. ``slot`` counts a
    shard's rows from 0 in curve order; equal indexes are ordered by text checksum, size and id, so
    that equal texts of one origin stand together, and a shard's rows do not depend on how the input
    was split. Only ids and numbers cross the network, in one range partitioning by the whole sort
    key, which splits a source or text of any share. The rank of a row is its place in its sorted
    part plus the rows of the parts before, of which the driver learns one number each.

    A null text counts as empty; null metadata have their own cell; missing metadata columns leave
    their axis out; repeated rows each get a slot; an empty table gives no rows. With fewer rows than
    shards the last shards are empty. A very long text counts with all its bytes, and is not copied. Names
    beyond the most frequent ones share a cell. Other columns are ignored, whatever their names.
    """
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 16
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        size.alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit(""))).alias("text_crc32"),
        *[F.col(c).cast("string").alias(f"axis_{i}") for i, c in enumerate(named) if c in docs.columns],
    )
    total = rows.count()
    axes = []
    for c in [c for c in rows.columns if c.startswith("axis_")]:
        # the most frequent names only: as many as there are cells
        counts = rows.groupBy(c).count().orderBy(F.desc("count"), c).limit((1 << bits) - 1).collect()
        axes.append(_named(F.col(c), name_cells([(r[c], r["count"]) for r in counts], total, bits), bits))
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    quantiles = rows.agg(F.percentile_approx("size", shares, 10_000)).first()[0]
    axes.append(_ranked(F.col("size"), sorted(set(quantiles or []))))
    axes = [a.cast("long") for a in axes]
    kind = dict(rows.dtypes)["doc_id"]
    points = rows.select("doc_id", "size", "text_crc32", *[a.alias(f"axis_{i}") for i, a in enumerate(axes)])
    curved = points.mapInArrow(_curve(bits), f"doc_id {kind}, size long, text_crc32 long, curve long")
    key = ["curve", "text_crc32", "size", "doc_id"]
    parts = tasks_for(total, ROWS_PER_TASK)
    placed = written(
        curved.repartitionByRange(parts, *key)
        .sortWithinPartitions(*key)
        .withColumn("place", F.monotonically_increasing_id()),
        "curve",
    )
    part, place = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    counts = sorted(tuple(r) for r in placed.groupBy(part.alias("part")).count().collect())
    before, offsets = 0, []
    for number, count in counts:
        offsets.append((number, before))
        before += count
    starts = docs.sparkSession.createDataFrame(offsets, "part long, before long")
    rank = F.col("before") + place
    small, larger = divmod(before, shards)
    border = larger * (small + 1)
    shard = F.when(rank < border, F.floor(rank / (small + 1))).otherwise(
        larger + F.floor((rank - border) / max(1, small))
    )
    first = F.least(F.col("shard"), F.lit(larger)) * (small + 1) + F.greatest(
        F.col("shard") - larger, F.lit(0)
    ) * small
    return (
        placed.join(F.broadcast(starts), part == F.col("part"))  # one row for each task of the sort
        .withColumn("rank", rank)
        .withColumn("shard", shard.cast("int"))
        .withColumn("slot", (F.col("rank") - first).cast("long"))
        .select("doc_id", "size", "text_crc32", "curve", "shard", "slot")
    )
