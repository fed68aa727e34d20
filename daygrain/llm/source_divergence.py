"""How the sources of a language differ in their words: a sum over terms for each pair of sources.

Each group of documents (language and source) and each language gives every term of the language's
vocabulary a smoothed share in billionths. The terms of a language are dealt to blocks and numbered
inside them, so that a group is a few sorted arrays of (term number, count). An unordered pair of
groups is one task: the two arrays of a block are co-grouped and merged by galloping intersection, which
prices the terms that both have; terms of one side only, and terms of neither, follow from totals. The
price is the same from both sides, so it is worked out once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daygrain.llm.tables import written
from daygrain.llm.word_table import tidied

#: A term: letters A to Z in lower case and every character beyond ASCII.
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
#: Shares are counted in parts of this.
WHOLE = 1_000_000_000
#: Counted terms a task holds before it hands them over, and bytes of a text it looks at together.
HELD, AT_ONCE = 500_000, 1 << 20
#: Terms of a block on average, and groups whose arrays a task compares with as many.
BLOCK, TILE = 8_192, 16
#: Documents of a language that a term must occur in, and terms of a group that are told.
LEAST_DOCS, TOLD = 10, 10


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text in lower case, some at a time: a long text is cut where no term is."""
    first = 0
    while len(text) - first > AT_ONCE:
        end = first + AT_ONCE
        while end < len(text) and (text[end] >= 0x80 or 65 <= text[end] & 0xDF <= 90):
            end += 1
        yield TERM.findall(text[first:end].lower())
        first = end
    yield TERM.findall(text[first:].lower() if first else text.lower())


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term of a group, and one row without term for the group itself."""
    counts: dict[tuple, Counter] = {}
    docs: dict[tuple, Counter] = {}

    def flushed() -> Iterator[pa.RecordBatch]:
        for group, found in counts.items():
            terms = [None, *(t.decode() for t in found)]
            n = len(terms)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([group[0]] * n, pa.string()),
                    pa.array([group[1]] * n, pa.string()),
                    pa.array(terms, pa.string()),
                    pa.array([0, *found.values()], pa.int64()),
                    pa.array([0, *map(docs[group].__getitem__, found)], pa.int64()),
                ],
                ["lang", "source", "term", "n", "docs"],
            )
        counts.clear()
        docs.clear()

    held = 0
    for batch in batches:
        groups = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        for group, text in zip(groups, batch.column(2), strict=True):
            count = counts.setdefault(group, Counter())
            seen = docs.setdefault(group, Counter())
            held -= len(count)
            own: set[bytes] = set()
            for terms in terms_of(text.as_buffer().to_pybytes()):
                count.update(terms)
                own.update(terms)
            seen.update(own)
            held += len(count)
            if held >= HELD:
                yield from flushed()
                held = 0
    yield from flushed()


def shares(counts: np.ndarray, divisor: int) -> np.ndarray:
    """``1 + floor(WHOLE * (count + 2) / divisor)`` by long division, three decimal places at a time."""
    rest = counts.astype(np.int64) + 2
    share = rest // divisor
    rest = rest % divisor
    for _ in range(3):
        rest = rest * 1000
        share, rest = share * 1000 + rest // divisor, rest % divisor
    return share + 1


def prices(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def intersection(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the common numbers in two ascending arrays.

    Gallops: for each run of the short array the reach into the long one is doubled until it covers the run,
    and only what lies there is searched, so the work follows the short array.
    """
    if len(short) > len(long):
        b, a = intersection(long, short)
        return a, b
    found_a, found_b, low = [], [], 0
    for first in range(0, len(short), 256):
        run = short[first : first + 256]
        step = 256
        while low + step < len(long) and long[low + step] < run[-1]:
            step *= 2
        part = long[low : low + step + 1]
        at = np.searchsorted(part, run)
        hit = np.flatnonzero((at < len(part)) & (part[np.minimum(at, len(part) - 1)] == run)) if len(part) else []
        found_a.append(first + np.asarray(hit, np.int64))
        found_b.append(low + at[hit] if len(part) else np.zeros(0, np.int64))
        low += int(at[-1]) if len(part) else 0
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_a), np.concatenate(found_b)


class _Group:
    """One group's part of a block."""

    def __init__(self, row: dict):
        self.source, self.number = row["source"], row["number"]
        self.divisor, self.terms = row["n"] + 2 * row["v"], row["terms"]
        self.ids = np.array(row["ids"] or [], np.int64)
        if self.terms:
            self.p = shares(np.array(row["counts"] or [], np.int64), self.divisor)
            self.absent = int(shares(np.zeros(1, np.int64), self.divisor)[0])


def pair_price(a: _Group, b: _Group) -> int:
    """Sum of the prices of all terms of a block: of both, of one alone, of none."""
    if not a.terms:
        return 0
    i, j = intersection(a.ids, b.ids)
    both = int(prices(a.p[i], b.p[j]).sum())
    alone = 0
    for one, at, other in ((a, i, b), (b, j, a)):
        against = prices(one.p, np.int64(other.absent))
        alone += int(against.sum()) - int(against[at].sum())
    neither = a.terms - len(a.ids) - len(b.ids) + len(i)
    return both + alone + neither * int(prices(np.int64(a.absent), np.int64(b.absent)))


_PAIR = "lang string, one string, other string, value long"


def _priced(left: pa.Table, right: pa.Table) -> pa.Table:
    ones, others = ([_Group(r) for r in side.to_pylist()] for side in (left, right))
    same = bool(left.num_rows and right.num_rows) and left.column("ti")[0] == left.column("tj")[0]
    rows = [
        (left.column("lang")[0].as_py(), a.source, b.source, pair_price(a, b))
        for a in ones
        for b in others
        if not same or a.number < b.number
    ]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["lang", "one", "other", "value"])


def _share(count: str, n: str, v: str):
    """``shares`` as a column, with decimals wide enough for any count."""
    return F.expr(f"1L + cast({count} + 2 as decimal(19,0)) * {WHOLE} div cast({n} + 2 * {v} as decimal(20,0))")


def _pairs(kept: DataFrame, groups: DataFrame, vocabulary: DataFrame, blocks: int, tile: int) -> DataFrame:
    """``lang, one, other, value`` of every unordered pair of sources of a language."""
    arrays = kept.groupBy("lang", "source", "block").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("held"))
    arrays = arrays.select("lang", "source", "block", F.col("held.id").alias("ids"), F.col("held.n").alias("counts"))
    terms = vocabulary.groupBy("lang", "block").agg(F.count("*").alias("terms"))
    numbered = groups.select(
        "lang", "source", "n", "v",
        (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("number"),
        F.count("*").over(Window.partitionBy("lang")).alias("sources"),
    )
    parts = written(
        numbered.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        .join(arrays, ["lang", "source", "block"], "left")
        .join(terms, ["lang", "block"], "left")
        .select(
            "lang", "block", "source", "number", "n", "v", F.coalesce("terms", F.lit(0)).alias("terms"), "ids", "counts",
            F.floor(F.col("number") / tile).cast("int").alias("tile"),
            F.floor((F.col("sources") - 1) / tile).cast("int").alias("last"),
        ),
        "arrays",
    )
    left = parts.withColumn("ti", F.col("tile")).withColumn("tj", F.explode(F.sequence("tile", "last")))
    right = parts.withColumn("tj", F.col("tile")).withColumn("ti", F.explode(F.sequence(F.lit(0), "tile")))
    keys = ["lang", "block", "ti", "tj"]
    priced = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_priced, _PAIR)
    return priced.groupBy("lang", "one", "other").agg(F.sum("value").alias("value"))


def source_divergence(
    docs: DataFrame,
    least_docs: int = LEAST_DOCS,
    told: int = TOLD,
    block: int = BLOCK,
    tile: int = TILE,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every group of ``docs``.

    Part ``pair`` has a row for each other source of the language, with the sum over all kept terms of
    ``floor((p - q)**2 / (p + q))`` for the shares p and q in the two groups. Part ``term`` has the ``told``
    terms that the group uses more than its language, by the same price against the language's share. A
    term is kept if it occurs in ``least_docs`` documents of the language; shares are smoothed by 2 and
    counted in billionths. All numbers are whole, so results do not depend on the order of work.

    Texts are counted where they are read, and what crosses the network is terms of groups, not words: a hot
    source or word costs a row a task. Arrays hold about ``block`` terms and a task sees ``tile`` groups
    against ``tile``, so no source or vocabulary has to fit into one task; the result has a row for each
    ordered pair, which grows with the square of the sources of a language.

    Null texts, languages and sources count as empty text. Documents without terms still make their
    group; a language without kept terms has pairs of value 0 and no term rows; a language's only source
    has no pairs. Equal values are ranked by the UTF-8 bytes of the item. Repeated rows are documents of
    their own. Very long texts are counted a part at a time; an empty table gives no rows. Other columns
    are ignored, whatever their names.
    """
    taken = docs.select(
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    parts = taken.mapInArrow(tidied(_counted), "lang string, source string, term string, n long, docs long")
    # tasks have added up their own already: another sum before the shuffle would find little to add
    parts = parts.repartition("lang", "source", "term")
    counted = written(parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counted")
    frequent = counted.filter("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
    frequent = written(frequent.filter(F.col("docs") >= least_docs).select("lang", "term", "total"), "frequent")
    sizes = frequent.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    most = sizes.agg(F.max("v")).first()[0] or 0
    blocks = max(1, -(-most // block))
    here = Window.partitionBy("lang", "block").orderBy("term")
    vocabulary = written(
        frequent.withColumn("block", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int")).withColumn("id", F.row_number().over(here)),
        "vocabulary",
    )
    kept = written(
        counted.select("lang", "source", "term", "n").join(vocabulary, ["lang", "term"]), "kept"
    )
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = written(
        counted.select("lang", "source").distinct()
        .join(own, ["lang", "source"], "left")
        .join(sizes, "lang", "left")
        .select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "v", "lang_n"))),
        "groups",
    )
    pairs = written(_pairs(kept, groups, vocabulary, blocks, tile), "pairs")
    both = pairs.select("lang", F.col("one").alias("source"), F.col("other").alias("item"), "value").unionByName(
        pairs.select("lang", F.col("other").alias("source"), F.col("one").alias("item"), "value")
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    both = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_value).alias("rank"))
    terms = (
        kept.select("lang", "source", F.col("term").alias("item"), F.col("n").alias("here"), "total")
        .join(groups, ["lang", "source"])
        .select("lang", "source", "item", _share("here", "n", "v").alias("p"), _share("total", "lang_n", "v").alias("q"))
        .filter("p > q")
        .select("lang", "source", F.lit("term").alias("part"), "item", F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
        .select("*", F.row_number().over(by_value).alias("rank"))
        .filter(F.col("rank") <= told)
    )
    return both.unionByName(terms)
