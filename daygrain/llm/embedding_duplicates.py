"""Near-duplicate embeddings by iterative quantisation and multi-index Hamming tables.

Rotations are learned on a sample so that the signs of the rotated coordinates are balanced and lose
little: codes and rotation are fitted in turn. Vectors at a small angle then differ in few bits. As many
rotations are learned as give a code of ``TABLES`` x ``CHUNK`` bits, whatever the dimension; each chunk of
it is a table, and two vectors meet if they differ in at most one bit of some chunk. Vectors that meet are
compared by their codes, and those whose codes are close by their cosine on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.byte_hash import U64, mix
from daygrain.llm.components import components
from daygrain.llm.tables import forget, written

#: Distinct vectors that the rotations are learned on.
SAMPLE = 4096
#: Tables and bits of each, at every size: buckets of a label hold a 65,536th of its vectors.
TABLES, CHUNK = 8, 16
#: Bits of a rotation at most, and bits in which the codes of near duplicates differ at most.
BITS, APART = 64, 32
#: Vectors of a bucket that one task compares with as many at once, and pairs it looks at together.
BLOCK, PAIRS = 1000, 1 << 17


def centre_of(vectors: np.ndarray, least: float = 0.6) -> np.ndarray:
    """As much of the mean of unit vectors as leaves nearly all of them a length of ``least``.

    Codes are signs about the centre. Near a tight group that makes up most of the vectors the mean would be the
    group itself, and its members would be seen at wide angles; angles grow by ``1 / least`` at most here.
    """
    if not len(vectors):
        return np.zeros(vectors.shape[1])
    mean = vectors.mean(axis=0)
    along, square = vectors @ mean, mean @ mean
    for part in np.linspace(1, 0, 21):
        length = 1 - 2 * part * along + part * part * square
        if np.quantile(length, 0.01) >= least * least:
            break
    return part * mean


def learn_rotation(vectors: np.ndarray, centre: np.ndarray, rounds: int = 30, seed: int = 0) -> np.ndarray:
    """Projection (dimension x bits) of unit vectors about a centre, by iterative quantisation."""
    dimension = vectors.shape[1]
    bits = min(BITS, dimension)
    centred = vectors - centre
    _, basis = np.linalg.eigh(centred.T @ centred + 1e-9 * np.eye(dimension))
    basis = basis[:, ::-1][:, :bits]
    seen = centred @ basis
    rotation, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))
    for _ in range(rounds if len(vectors) else 0):
        code = np.sign(seen @ rotation)
        left, _, right = np.linalg.svd(code.T @ seen)
        rotation = (left @ right).T
    return basis @ rotation


def learn_codes(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centre and projection to all bits of a code, from rotations that start at different places."""
    bits, parts, centre = TABLES * CHUNK, [], centre_of(vectors)
    while sum(p.shape[1] for p in parts) < bits:
        parts.append(learn_rotation(vectors, centre, seed=len(parts)))
    # the bits of a rotation are spread over the tables
    order = np.argsort(np.arange(bits) % TABLES, kind="stable")
    return centre, np.concatenate(parts, axis=1)[:, :bits][:, order]


def codes_of(vectors: np.ndarray, centre: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Codes as rows of 64-bit numbers, the first coordinate in the lowest bit of the first."""
    signs = ((vectors - centre) @ projection) > 0
    words = [signs[:, k : k + 64].astype(U64) << np.arange(min(64, signs.shape[1] - k), dtype=U64) for k in range(0, signs.shape[1], 64)]
    return np.stack([w.sum(axis=1, dtype=U64) for w in words], axis=1)


def chunks_of(codes: np.ndarray) -> np.ndarray:
    """The chunk of each table, a column each."""
    per_word = 64 // CHUNK
    tables = [(codes[:, t // per_word] >> U64(CHUNK * (t % per_word))) & U64((1 << CHUNK) - 1) for t in range(TABLES)]
    return np.stack(tables, axis=1)


def _unit(values: np.ndarray) -> np.ndarray:
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


WORDS = [f"code_{k}" for k in range(TABLES * CHUNK // 64)]
_CODES = ", ".join(f"{w} long" for w in WORDS)
_PLACE = f"node long, label long, {_CODES}, table int, bucket long, visits boolean"


def _places(models: dict):
    """The buckets each vector is put in: its own of each table, and those of one bit less, as a visitor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            codes = np.zeros((n, len(WORDS)), U64)
            size = batch.column(3).to_numpy()
            raw = batch.column(2)
            for d in np.unique(size):
                at = np.flatnonzero(size == d)
                vectors = raw.take(pa.array(at)).flatten().to_numpy().reshape(len(at), d)
                centre, projection = models.get(int(d)) or learn_codes(np.zeros((0, int(d))))
                codes[at] = codes_of(_unit(vectors), centre, projection)
            node, label = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            group = mix(label.view(U64) ^ (size.astype(U64) << U64(40)))
            own = chunks_of(codes)
            for table in range(TABLES):
                value = own[:, table]
                bits = (value[:, None] >> np.arange(CHUNK, dtype=U64)) & U64(1)
                row, bit = np.nonzero(bits)
                row = np.r_[np.arange(n), row]
                put = np.r_[value, value[row[n:]] ^ (U64(1) << bit.astype(U64))]
                bucket = mix(group[row] ^ mix(put + U64(table << 20))).view(np.int64)
                columns = [node[row], label[row], *(codes[row, k].view(np.int64) for k in range(len(WORDS)))]
                columns += [np.full(len(row), table, np.int32), bucket, np.arange(len(row)) >= n]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [f.split()[0] for f in _PLACE.split(", ")])

    return run


_GROUP = ["bucket", "first", "second"]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows of whole groups, and the number of each row's group, from rows that are sorted by group."""

    def numbered(table: pa.Table) -> np.ndarray:
        keys = [table.column(c).to_numpy() for c in _GROUP]
        new = np.zeros(table.num_rows, bool)
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
        return np.cumsum(new)

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
        group = numbered(table)
        cut = int(np.searchsorted(group, group[-1]))
        held = table.slice(cut)
        if cut:
            yield table.slice(0, cut), group[:cut]
    if held is not None and held.num_rows:
        held = held.combine_chunks()
        yield held, numbered(held)


def _meetings(table: pa.Table, group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of a group whose codes are close: each pair of vectors in the first table it meets in."""
    n = table.num_rows
    last = np.searchsorted(group, group, "right")
    partners = last - np.arange(n) - 1
    visits, label, number = (table.column(c).to_numpy() for c in ("visits", "label", "table"))
    block, across = table.column("block").to_numpy(), table.column("first").to_numpy() != table.column("second").to_numpy()
    codes = np.stack([table.column(w).to_numpy().view(U64) for w in WORDS], axis=1)
    ends = np.cumsum(partners)
    low = 0
    while low < n:
        base = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, base + PAIRS, "right")))
        count = partners[low:high]
        i = np.repeat(np.arange(low, high), count)
        j = np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count) + i + 1
        keep = ~(visits[i] & visits[j]) & (label[i] == label[j]) & (number[i] == number[j])
        keep &= ~across[i] | (block[i] != block[j])
        i, j = i[keep], j[keep]
        differ = codes[i] ^ codes[j]
        near = np.bitwise_count(differ).sum(axis=1, dtype=np.int64) <= APART
        i, j, differ = i[near], j[near], differ[near]
        if len(i):
            met = np.bitwise_count(chunks_of(differ)) <= 1
            first = met.argmax(axis=1) == number[i]
            yield i[first], j[first]
        low = high


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that have a close code in their group."""
    for table, group in _groups(batches):
        wanted = np.zeros(table.num_rows, bool)
        for i, j in _meetings(table, group):
            wanted[i] = wanted[j] = True
        yield from table.filter(pa.array(wanted)).to_batches()


def _links(least: float):
    """Links in groups of vectors: counts of each node, and a pointer that connects it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in _groups(batches):
            n = table.num_rows
            raw = table.column("vector").combine_chunks()
            size = np.diff(np.r_[0, np.cumsum(raw.value_lengths().to_numpy())])
            flat, start = raw.flatten().to_numpy(), np.cumsum(size) - size
            length = np.sqrt(np.add.reduceat(flat * flat, start))
            flat = flat / np.repeat(length, size)
            copies, node = table.column("copies").to_numpy(), table.column("node").to_numpy()
            times, pointer = np.zeros(n, np.int64), np.arange(n)
            ones, others = [], []
            for i, j in _meetings(table, group):
                same = size[i] == size[j]
                i, j = i[same], j[same]
                linked = np.zeros(len(i), bool)
                for d in np.unique(size[i]):
                    at = np.flatnonzero(size[i] == d)
                    for k in range(0, len(at), 1 << 14):
                        part = at[k : k + (1 << 14)]
                        span = np.arange(d)
                        x, y = flat[start[i[part], None] + span], flat[start[j[part], None] + span]
                        linked[part] = (x * y).sum(axis=1) >= least
                i, j = i[linked], j[linked]
                np.add.at(times, i, copies[j])
                np.add.at(times, j, copies[i])
                ones.append(i)
                others.append(j)
            if not ones:
                continue
            i, j = np.concatenate(ones), np.concatenate(others)
            while True:
                low = np.minimum(pointer[i], pointer[j])
                new = pointer.copy()
                np.minimum.at(new, i, low)
                np.minimum.at(new, j, low)
                new = new[new]
                if (new == pointer).all():
                    break
                pointer = new
            found = np.flatnonzero(times)
            columns = [node[found], node[pointer[found]], times[found]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "links"])

    return run


def _grouped(rows: DataFrame) -> DataFrame:
    """Groups together and in order, so that a task reads them one after another."""
    return rows.repartition(*_GROUP).sortWithinPartitions(*_GROUP)


def embedding_duplicates(
    vectors: DataFrame,
    cosine: float = 0.98,
    sample: int = SAMPLE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of each row.

    Rows of one label whose vectors have a cosine of at least ``cosine``, in double precision, are
    linked if the tables bring them together, and none below it; ``n_links`` counts the other rows a
    row is linked to, ``component_id`` is the smallest id that links reach.

    The rotations are learned on the ``sample`` distinct vectors of smallest hash; every row is put in
    the tables. Equal vectors of a label are one node that counts as often as it occurs, so copies
    make no pairs. Codes alone are compared first, and a vector travels only to the groups where it has a
    partner of a close code. A bucket of many nodes is compared in blocks of ``BLOCK`` x ``BLOCK``; blocks give
    counts and pointers, not pairs, and no bucket is capped. Tables and chunks are the same at every size; of
    pairs at a cosine of 0.9805 at least 0.999 meet with 8 to 384 components. There is no text.

    A row links with nothing if its label or id is null, its vector is null, empty, zero, or holds a null
    or a number that is not finite, or no other row has as many components. Rows that share an id are
    rows of their own for ``n_links`` and follow their own vector's component. A row without id has a
    null component and is kept. An empty table gives no rows. Other columns are ignored.
    """
    v = F.col("vector")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    norm = F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    # a sum of squares that is too small or too large for a double can't be divided by
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(
        (F.size("vector") > 0) & ~odd & (norm > 0) & (norm < float("inf")), F.lit(False)
    )
    rows = written(
        rows.withColumn("usable", usable).select(
            "vec_id",
            F.when(F.col("usable"), F.col("label")).alias("label"),
            F.when(F.col("usable"), F.xxhash64("vector")).alias("hash_a"),
            F.when(F.col("usable"), F.xxhash64(F.lit(7), "vector", F.lit(1))).alias("hash_b"),
            F.when(F.col("usable"), F.col("vector")).alias("vector"),
        ),
        "vectors",
    )
    key = ["label", "hash_a", "hash_b"]
    nodes = written(
        rows.filter("label is not null")
        .groupBy(*key)
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
        .withColumn("node", F.monotonically_increasing_id())
        .withColumn("dimension", F.size("vector")),
        "nodes",
    )
    seen: dict[int, list] = {}
    for (vector,) in nodes.orderBy("hash_a", "hash_b").select("vector").limit(sample).collect():
        seen.setdefault(len(vector), []).append(vector)
    models = {d: learn_codes(_unit(np.array(found, float))) for d, found in seen.items()}
    places = written(nodes.select("node", "label", "vector", "dimension").mapInArrow(_places(models), _PLACE), "places")
    live = (
        places.groupBy("bucket")
        .agg(F.count("*").alias("members"), F.min("visits").alias("no_own"))
        .filter("members > 1 and not no_own")
        .select("bucket", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    )
    live = written(live, "buckets")
    blocks = (
        places.join(live, "bucket")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("first", F.least("block", "other"))
        .withColumn("second", F.greatest("block", "other"))
        .drop("blocks", "other")
    )
    schema = f"{_PLACE}, block int, first int, second int"
    blocks = blocks.select(*[f.split()[0] for f in schema.split(", ")])
    close = written(_grouped(blocks).mapInArrow(_candidates, schema), "close")
    with_vectors = close.join(nodes.select("node", "vector", "copies"), "node")
    found = written(_grouped(with_vectors).mapInArrow(_links(cosine), "a long, b long, links long"), "links")
    forget(places, live, close)
    counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    joined = written(
        nodes.select(*key, "node", "least", "copies")
        .join(counts, "node", "left")
        .join(components(found), "node", "left")
        .withColumn("component", F.coalesce("component_id", "node")),
        "components",
    )
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    placed = joined.drop("component_id").join(least, "component").select(
        *key, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    component = F.coalesce("component_id", "vec_id")
    return (
        rows.drop("vector")
        .join(written(placed, "placed"), key, "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            component.alias("component_id"),
            F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
        )
    )
