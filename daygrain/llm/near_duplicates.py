"""Near-duplicate documents by MinHash with fast similarity sketching.

A sketch has a fixed number of bins. In round i every shingle of a document is thrown into the bin a
hash of round i names, and a bin keeps the least of the values it gets; values of a later round are
larger, so a bin filled in one round is final. Rounds go on until every bin is filled; after as many
rounds as there are bins, further rounds send all shingles to one bin each, so that even a single
shingle fills all. Two documents agree in a bin with a chance of their Jaccard similarity, as with
MinHash, at the cost of a few hashes for each shingle.

Bands of bins propose pairs, and the full sets of shingles decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.llm.byte_hash import U64, lower_ascii, mix, salt, shingles, text_parts, words
from daygrain.llm.components import components
from daygrain.llm.tables import forget, written
from daygrain.llm.word_table import tidied

#: Bands and bins of each: a pair of similarity 0.8 shares no band with a chance of 3 in a million.
BANDS, ROWS = 24, 4
BINS = BANDS * ROWS
#: Documents of a cluster that one task compares with as many at once, and bytes of their sets.
BLOCK, BLOCK_BYTES = 128, 4 << 20

_VALUE = U64((1 << 56) - 1)


def sketches(hashes: np.ndarray, owner: np.ndarray, rows: int, bins: int = BINS) -> np.ndarray:
    """``rows`` x ``bins`` values, from the distinct shingle hashes and the row of each."""
    out = np.full(rows * bins, ~U64(0), U64)
    missing = np.zeros(rows, np.int64)
    missing[owner] = bins
    base = owner * bins
    for turn in range(2 * bins):
        if not len(hashes):
            break
        h = mix(hashes ^ salt(turn))
        value = (U64(turn) << U64(56)) | (h & _VALUE)
        if turn < bins:
            at = base + ((h >> U64(40)) % U64(bins)).astype(np.int64)
        else:
            at = base + (turn - bins)
        # the value leaves out the bits that chose the bin, so mix once more
        value = (value & ~_VALUE) | (mix(h) & _VALUE)
        np.minimum.at(out, at, value)
        if turn % 8 < 2 or turn > bins:
            filled = (out.reshape(rows, bins) != ~U64(0)).all(axis=1)
            going = ~filled[owner]
            if not going.all():
                hashes, owner, base = hashes[going], owner[going], base[going]
    return out.reshape(rows, bins)


def sketched(docs: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, set_a, set_b, sketch, bands`` of each row; no shuffle.

    ``set_a`` and ``set_b`` are sums of hashes over the set, equal for equal sets; ``sketch`` has four
    bytes for each bin.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, bounds in text_parts(batch.column(1)):
                rows = last - first
                found, owner = words(lower_ascii(data), bounds)
                hashes, owner = shingles(found, owner, rows, size)
                sketch = sketches(hashes, owner, rows)
                sums = []
                for other in (U64(0x2545F4914F6CDD1D), U64(0xDA942042E4DD58B5)):
                    total = np.zeros(rows, U64)
                    np.add.at(total, owner, mix(hashes ^ other))
                    sums.append(total.view(np.int64))
                count = np.bincount(owner, minlength=rows)
                band = np.zeros((rows, BANDS), U64)
                for k in range(ROWS):
                    band = mix(band ^ sketch[:, k::ROWS]) + U64(k)
                band = mix(band ^ (np.arange(1, BANDS + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)))
                small = sketch.astype("<u4").view(np.uint8).reshape(rows, 4 * BINS)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, rows),
                        pa.array(count, pa.int64()),
                        *[pa.array(s) for s in sums],
                        pa.array([r.tobytes() for r in small], pa.binary()),
                        pa.array(list(band.view(np.int64)), pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_shingles", "set_a", "set_b", "sketch", "bands"],
                )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col).mapInArrow(
        tidied(run), "doc_id long, n_shingles long, set_a long, set_b long, sketch binary, bands array<long>"
    )


def _sets(docs: DataFrame, size: int, text_col: str) -> DataFrame:
    """``node, shingles``: the sorted distinct shingle hashes of each row as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, bounds in text_parts(batch.column(1)):
                rows = last - first
                found, owner = words(lower_ascii(data), bounds)
                hashes, owner = shingles(found, owner, rows, size)
                ends = np.searchsorted(owner, np.arange(rows + 1))
                sets = [hashes[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, rows), pa.array(sets, pa.binary())], ["node", "shingles"]
                )

    return docs.select("node", text_col).mapInArrow(tidied(run), "node long, shingles binary")


def _similar(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= threshold * union of their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            columns = (batch.column(2).to_pylist(), batch.column(3).to_pylist())
            for i, (one, two) in enumerate(zip(*columns, strict=True)):
                x, y = np.frombuffer(one, U64), np.frombuffer(two, U64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = common > 0 and 100 * common >= threshold * (len(x) + len(y) - common)
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).filter(pa.array(keep)) for k in (0, 1)], ["a", "b"]
            )

    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("one"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("two"))
    return (
        pairs.select("a", "b")
        .join(one, "a")
        .join(two, "b")
        .select("a", "b", "one", "two")
        .mapInArrow(tidied(run), "a long, b long")
    )


def _fits(a: Column, b: Column, threshold: int) -> Column:
    """Whether two set sizes allow the similarity at all."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * threshold


def _common(one: list[np.ndarray], two: list[np.ndarray]):
    """Function of i: sizes of the intersections of ``one[i]`` with each of ``two``.

    Shingles that two sets share get a bit each, and bits are counted.
    """
    sets = one + two
    every, number = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    shared = np.bincount(number, minlength=len(every)) > 1
    bit = np.cumsum(shared) - 1
    keep = shared[number]
    at, row = bit[number[keep]], owner[keep]
    bits = np.zeros((len(sets), int(shared.sum()) // 64 + 1), U64)
    np.bitwise_or.at(bits, (row, at // 64), U64(1) << (at % 64).astype(U64))
    left, right = bits[: len(one)], bits[len(one) :]
    return lambda i: np.bitwise_count(left[i] & right).sum(axis=1, dtype=np.int64)


def _across(threshold: int):
    """Links between different components in two blocks of a cluster, as few as connect them.

    All pairs of different components are tested by sizes, and what those allow by full sets.
    """

    def run(group: pa.Table) -> pa.Table:
        block = group.column("block").to_numpy()
        one, two = (group.filter(pa.array(block == group.column(c)[0].as_py())) for c in ("first", "second"))
        found: list[tuple[int, int]] = []
        if len(one) and len(two):
            sets = [[np.frombuffer(s.as_buffer(), U64) for s in part.column("shingles")] for part in (one, two)]
            common = _common(*sets)
            n, m = (part.column("n").to_numpy() for part in (one, two))
            kin, other = (part.column("component").to_numpy() for part in (one, two))
            nodes, others = (part.column("node").to_numpy() for part in (one, two))
            root = {int(c): int(c) for c in np.r_[kin, other]}

            def find(c: int) -> int:
                while root[c] != c:
                    c = root[c]
                return c

            for i in range(len(one)):
                ok = (other != kin[i]) & (np.minimum(n[i], m) * 100 >= np.maximum(n[i], m) * threshold)
                if not ok.any():
                    continue
                both = common(i)
                ok &= (both > 0) & (100 * both >= threshold * (n[i] + m - both))
                for j in np.flatnonzero(ok):
                    p, q = find(int(kin[i])), find(int(other[j]))
                    if p != q:
                        root[p] = q
                        found.append((int(nodes[i]), int(others[j])))
        columns = zip(*found, strict=True) if found else [[]] * 2
        return pa.table([pa.array(list(c), pa.int64()) for c in columns], names=["a", "b"])

    return run


def near_duplicates(
    docs: DataFrame, size: int = 5, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each row.

    Words are runs of bytes other than white space, A-Z in lower case; a document's set is its
    distinct shingles of ``size`` words, the whole sequence if it has fewer words, nothing if it has
    none. Documents with 100 * intersection >= ``threshold`` * union are linked, and a component is
    what links reach; ``component_id`` is its smallest id.

    Equal sets are one node. In each bucket of a band all nodes are compared with the smallest one,
    so a group of copies costs one pair for each member. Buckets that still hold several components
    after that are joined to clusters by their nodes, and in a cluster all pairs between different
    components are compared, in blocks of ``BLOCK`` x ``BLOCK`` nodes, by size first and then by
    their full sets. Blocks give links that connect components, not pairs. No bucket is capped and
    no link between components of a bucket is left untested.

    A very long text is read whole, in memory of some 23 bytes for each of its bytes. Equal ids and equal
    sets are ties without consequence: the smallest id names a component.

    A row with a null or empty text, or without words, has set size 0 and is alone; so is a row
    without id, which has a null component and is kept. Rows with the same id count as one document
    that is linked to whatever any of them is; each gets its own row. An empty table gives no rows.
    Other columns are ignored.
    """
    rows = written(sketched(docs, size, id_col, text_col), "sketches")
    known = rows.filter("n_shingles > 0 and doc_id is not null")
    nodes = written(
        known.groupBy("set_a", "set_b")
        .agg(F.min(F.struct("doc_id", "n_shingles", "sketch", "bands")).alias("m"), F.count("*").alias("copies"))
        .select("set_a", "set_b", "copies", F.col("m.doc_id").alias("node"), F.col("m.n_shingles").alias("n"), "m.sketch", "m.bands"),
        "nodes",
    )
    bands = nodes.select("node", "n", F.explode("bands").alias("band"))
    pivots = (
        bands.groupBy("band")
        .agg(F.min(F.struct("node", "n")).alias("p"), F.count("*").alias("members"))
        .filter("members > 1")
        .select("band", F.col("p.node").alias("pivot"), F.col("p.n").alias("pivot_n"))
    )
    pivots = written(pivots, "pivots")
    shared = written(bands.join(pivots, "band"), "buckets")
    stars = (
        shared.filter((F.col("node") != F.col("pivot")) & _fits(F.col("n"), F.col("pivot_n"), threshold))
        .select(F.col("pivot").alias("a"), F.col("node").alias("b"))
        .distinct()
    )
    texts = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text"))
    sets = written(_sets(texts.join(shared.select("node").distinct(), "node", "left_semi"), size, "text"), "sets")
    links = written(_similar(stars, sets, threshold).distinct(), "links")
    joined = components(links)

    # what the stars left apart
    labelled = shared.join(joined, "node", "left").select(
        "band", "node", F.coalesce("component_id", "node").alias("component")
    )
    labelled = written(labelled, "labelled")
    mixed = (
        labelled.groupBy("band")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members"), F.min("node").alias("pivot"))
        .filter("low <> high and members > 2")
        .select("band", "pivot")
    )
    mixed = written(mixed, "mixed")
    inside = written(
        labelled.join(mixed, "band").select("pivot", "node", "component").distinct(), "mixed"
    )
    clusters = components(inside.select(F.col("pivot").alias("a"), F.col("node").alias("b")))
    members = written(
        clusters.select("node", F.col("component_id").alias("cluster"))
        .join(inside.groupBy("node").agg(F.min("component").alias("component")), "node")
        .join(nodes.select("node", "n"), "node")
        .join(sets, "node"),
        "members",
    )
    cuts = members.groupBy("cluster").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK, F.sum(F.length("shingles")) / BLOCK_BYTES)).cast("int").alias("blocks")
    )
    cuts = written(cuts, "cuts")
    apart = (
        members.join(cuts, "cluster")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("first", F.least("block", "with"))
        .withColumn("second", F.greatest("block", "with"))
        .drop("blocks", "with")
    )
    more = apart.groupBy("cluster", "first", "second").applyInArrow(_across(threshold), "a long, b long")
    all_links = written(links.unionByName(more), "links")
    final = components(all_links)
    forget(pivots, shared, sets, links, joined, labelled, mixed, inside, clusters, members, cuts, all_links)

    # documents of a set stand under its node; sets of one id stand together
    kin = nodes.filter("copies > 1").select("set_a", "set_b", "node")
    placed = rows.join(kin, ["set_a", "set_b"], "left").withColumn("node", F.coalesce("node", "doc_id"))
    placed = placed.join(final, "node", "left").withColumn(
        "component_id", F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "node")).otherwise(F.col("doc_id"))
    )
    return placed.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def first_of_each(docs: DataFrame, size: int = 5, threshold: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that ``near_duplicates`` keeps: one id of each component."""
    name = "gone_id"
    while name in {c.lower() for c in docs.columns}:
        name = f"_{name}"
    gone = near_duplicates(docs, size, threshold).filter("not kept").select(F.col("doc_id").alias(name)).distinct()
    gone = written(gone, "gone")
    return docs.join(gone.hint("shuffle_hash"), docs["doc_id"] == gone[name], "left_anti")
