"""Document fingerprints: threshold-scaled sketches, in DataFrame functions alone.

A sketch keeps every shingle hash below a fixed fraction of the hash range. Which hashes are kept
does not depend on the document's size, so sketches of a short and a very long text can be compared
for containment, and the sketch of a set of texts is the union of theirs, whatever the order of merging.
A text of few shingles may have none below the threshold; then its sketch says nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrain.llm.tables import tasks_for, text_bytes, written

#: Words of a shingle.
WORDS = 5
#: One shingle hash in so many is kept: fingerprints take about a twentieth of the bytes of the texts.
SCALE = 16
#: Most bounds that the id range is cut at; wider ranges are cut evenly between two bounds.
BOUNDS = 512
#: Consecutive buckets that are put in order together.
TOGETHER = 1024

_LEAST = -(1 << 63)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def sketch(text: Column, words: int = WORDS, scale: int = SCALE) -> Column:
    """Sorted distinct hashes of the text's shingles below the threshold: an array of longs.

    Words are parted by white space and compared in lower case; with fewer than ``words`` the whole
    sequence is one shingle; a null text or one without words has an empty sketch.
    """
    threshold = F.lit(_LEAST + (1 << 64) // scale)

    def shingles(parts: Column) -> Column:
        last = F.greatest(F.size(parts) - words, F.lit(0))
        hashed = F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.xxhash64(F.slice(parts, i, words)))
        return F.when(F.size(parts) > 0, hashed).otherwise(F.array().cast("array<bigint>"))

    parts = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), "")
    low = F.filter(bind(parts, shingles), lambda h: h < threshold)
    return F.sort_array(F.array_distinct(low))


def printed(hashes: Column) -> Column:
    """A sketch as text: the lower 32 bits of each hash, in the order of the hashes, in base 64."""
    digits = F.transform(hashes, lambda h: F.lpad(F.hex(h.bitwiseAND((1 << 32) - 1)), 8, "0"))
    return F.translate(F.base64(F.unhex(F.array_join(digits, ""))), "\r\n", "")


def merged(one: Column, two: Column) -> Column:
    """The sketch of two texts together."""
    return F.sort_array(F.array_union(one, two))


def merge_sketches(rows: DataFrame, by: list[str], sketches: str = "sketch") -> DataFrame:
    """``*by, sketch``: the sketch of all texts of a group, an empty one if none of them has a hash.

    Hashes are made distinct within a task before the shuffle. A result is as long as the sketch of the group's
    shingles, which the threshold bounds by their number over ``SCALE``.
    """
    hashes = rows.select(*by, F.explode_outer(sketches).alias("hash"))
    return hashes.groupBy(*by).agg(F.sort_array(F.collect_set("hash")).alias("sketch"))


def likeness(one: Column, two: Column) -> Column:
    """Share of common hashes among all of two sketches; null for two empty ones."""
    common = F.size(F.array_intersect(one, two))
    return bind(common, lambda c: F.when(F.size(one) + F.size(two) > 0, c / (F.size(one) + F.size(two) - c)))


def containment(part: Column, whole: Column) -> Column:
    """Share of the hashes of one sketch that another holds; null for an empty one."""
    return F.when(F.size(part) > 0, F.size(F.array_intersect(part, whole)) / F.size(part))


def _bucket(key: Column, bounds: list[int], inner: int) -> Column:
    """Number of bounds up to the key, cut evenly into ``inner`` parts between two bounds."""
    if not bounds:
        return F.lit(0)
    all_bounds = F.array(*[F.lit(b) for b in bounds])
    cell = F.size(F.filter(all_bounds, lambda b: b <= key))
    if inner == 1:
        return cell
    low = F.get(all_bounds, cell - 1).cast("double")
    high = F.get(all_bounds, cell).cast("double")
    share = F.coalesce((key.cast("double") - low) / (high - low), F.lit(0.0))
    return cell * inner + F.least(F.floor(share * inner), F.lit(inner - 1)).cast("int")


def _next_buckets(present: DataFrame) -> DataFrame:
    """``bucket, after``: the bucket that follows each of the given ones; the first follows the last.

    Buckets are put in order ``TOGETHER`` at a time, then the ends of these runs, of which there is one
    for some gigabytes of text.
    """
    run = F.floor(F.col("bucket") / TOGETHER)
    numbered = present.select("bucket", run.alias("run"))
    inside = numbered.withColumn("after", F.lead("bucket").over(Window.partitionBy("run").orderBy("bucket")))
    ends = numbered.groupBy("run").agg(F.min("bucket").alias("low"))
    in_order = Window.partitionBy(F.lit(0)).orderBy("run")
    first = F.min("low").over(Window.partitionBy(F.lit(0)))
    ends = ends.select("run", F.coalesce(F.lead("low").over(in_order), first).alias("over"))
    return inside.join(ends, "run").select("bucket", F.coalesce("after", "over").alias("after"))


def _compared(pairs: DataFrame, words: int, scale: int, more: Sequence[Column | str] = ()) -> DataFrame:
    """Edited text, fingerprints and likeness of rows that know the next text and sketch, and ``more`` columns."""
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substr("text", F.lit(1), F.length("text") - half), F.substr("next_text", F.lit(1), half)
    )
    pairs = pairs.withColumn("edited", edited)
    pairs = pairs.withColumn("edited_sketch", sketch(F.col("edited"), words, scale))

    def near(other: str, text: str) -> Column:
        # two empty sketches are alike if the texts are the same
        same = (F.col("text") == F.col(text)).cast("double")
        return F.coalesce(likeness(F.col("sketch"), F.col(other)), same)

    return pairs.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        printed(F.col("sketch")).alias("fingerprint"),
        printed(F.col("edited_sketch")).alias("edited_fingerprint"),
        near("edited_sketch", "edited").alias("near_edited"),
        near("next_sketch", "next_text").alias("near_next"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("contained_edited"),
        *more,
    )


def edited_fingerprints(
    docs: DataFrame,
    words: int = WORDS,
    scale: int = SCALE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Fingerprints of each text and of its edited form, and how alike they are.

    Edited: the last floor(n/2) of n code points are replaced by as many first ones of the next
    document by id, or all it has; the first document follows the last. Gives ``doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, contained_edited``; a
    fingerprint is the printed sketch. Two texts without a kept hash are alike (1) if they are the same, else not (0).

    Texts and sketches cross the network once, dealt to buckets of consecutive ids by quantiles of the ids; copies
    of a text are no hot key. The next document of a bucket's last row is the first row of the bucket after, one
    row of each bucket that is kept aside. Rows of one id are in one bucket.

    A null or empty text has n_chars 0 and an empty fingerprint. A null id comes first; rows with
    one id are ordered by a checksum of their text, and each has the other as its next. The only row
    of a table is its own next. Very long texts are sketched whole. An empty table gives no rows. Other columns
    are ignored, whatever their names.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LEAST)).alias("key"),
        F.crc32(text).alias("check"),
        text.alias("text"),
    )
    buckets = tasks_for(text_bytes(docs, text_col))
    cells = min(buckets, BOUNDS)
    shares = [i / cells for i in range(1, cells)]
    bounds = rows.agg(F.percentile_approx("key", shares, 20 * cells).alias("b")).first().b if shares else []
    bucket = _bucket(F.col("key"), sorted(set(bounds or [])), -(-buckets // cells))
    dealt = rows.withColumns({"sketch": sketch(F.col("text"), words, scale), "bucket": bucket})
    in_bucket = Window.partitionBy("bucket").orderBy("key", "check")
    ordered = (
        dealt.repartitionById(cells * -(-buckets // cells), F.col("bucket"))
        .select("*", F.row_number().over(in_bucket).alias("place"), *[F.lead(c).over(in_bucket).alias(f"next_{c}") for c in ("text", "sketch")])
        .withColumn("last", F.col("next_text").isNull())
    )
    border = (F.col("place") == 1) | F.col("last")
    aside = [F.when(border, F.struct("doc_id", "text", "sketch")).alias("aside"), (F.col("place") == 1).alias("first")]
    kept = written(_compared(ordered, words, scale, ["bucket", "last", *aside]), "fingerprints")
    names = [c for c in kept.columns if c not in ("bucket", "last", "aside", "first")]
    firsts = kept.filter("first").select("bucket", F.col("aside.text").alias("next_text"), F.col("aside.sketch").alias("next_sketch"))
    lasts = kept.filter("last").select("bucket", "aside.*").join(_next_buckets(firsts.select("bucket")), "bucket")
    firsts = firsts.withColumnRenamed("bucket", "after")
    ends = _compared(lasts.join(firsts, "after"), words, scale)
    return kept.filter("not last").select(*names).unionByName(ends)
