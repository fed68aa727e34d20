"""Removal of repeated passages with a partitioned suffix array.

A passage is repeated if its ``length`` bytes also start earlier. A row of ``length`` bytes for every
suffix would multiply the input, so the array is built in levels, and only what a level leaves open
reaches the next one:

1. Every suffix has an anchor: the least by hash of the strings of some bytes inside its first ``length``
   ones. Neighbouring suffixes mostly share theirs, so consecutive ones form a run and travel as one row.
   Equal suffixes have equal anchors. A run whose anchor occurs with no other content is unique, a run
   with the content of an earlier one is repeated as a whole; other runs are open, and fall into shorter
   runs at the next level, whose anchors are longer.
2. At the last level a suffix is a row with all its bytes.

Each level is the same sort: sampled splitters range-partition the rows by their leading bytes (the first
eight of the anchor at the upper levels, all of them at the last one) and then by what follows, down to
document and place, so that a string of any share is spread over buckets. A bucket sorts by multikey
quicksort and compares neighbours. What lies at the border of a bucket stays open at the upper levels; at
the last one the first string of a bucket is compared with the last of the bucket before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.byte_hash import _BASE, _INVERSE, AT_ONCE, BYTES, U64, mix, powers, text_parts
from daygrain.llm.tables import tasks_for, text_bytes, written
from daygrain.llm.word_table import tidied

#: Bytes of the anchors of the levels before the last one.
ANCHORS = (48, 88)
#: Buckets at most: Spark's sample for the splitters is some rows for each.
MOST_BUCKETS = 32_768
#: Bytes of rows that a bucket of the levels after the first one is dealt.
ROWS_PER_BUCKET = 16 << 20

_PLACE = (1 << 32) - 1
_SIGN = U64(1 << 63)


def multikey_order(words: list[np.ndarray]) -> np.ndarray:
    """Order of rows by their words, the first word first.

    Multikey quicksort, a level of all its parts at a time: rows are sorted by a word, and only those
    still equal to a neighbour are sorted by the next one.
    """
    n = len(words[0])
    order = np.argsort(words[0])
    sorted_word = words[0][order]
    part = np.zeros(n, np.int64)
    part[1:] = np.cumsum(sorted_word[1:] != sorted_word[:-1])
    for word in words[1:]:
        same = np.zeros(n, bool)
        same[1:] = part[1:] == part[:-1]
        same[:-1] |= same[1:]
        tied = np.flatnonzero(same)
        if not len(tied):
            break
        rows = order[tied]
        inner = np.lexsort((word[rows], part[tied]))
        order[tied] = rows[inner]
        value = word[order[tied]]
        split = np.zeros(n, bool)
        split[tied[1:]] = (value[1:] != value[:-1]) & (part[tied[1:]] == part[tied[:-1]])
        split[1:] |= part[1:] != part[:-1]
        part = np.cumsum(split)
    return order


class _Hashed:
    """Hashes of any substrings of some texts, from prefix sums of a polynomial."""

    def __init__(self, data: np.ndarray):
        self.n = len(data)
        self.sums = np.zeros(self.n + 1, U64)
        np.cumsum(BYTES[data] * powers(self.n, _BASE), out=self.sums[1:])
        self.inverse = powers(self.n + 1, _INVERSE)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts])

    def every(self, size: int) -> np.ndarray:
        return mix((self.sums[size:] - self.sums[:-size]) * self.inverse[: self.n + 1 - size])


def _lead(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Eight bytes from each place on as numbers that order like the bytes; behind the end lie zeros."""
    found = np.zeros(len(places), U64)
    last = len(data) - 1
    for k in range(8):
        at = places + k
        found = (found << U64(8)) | np.where(at <= last, data[np.minimum(at, last)], 0).astype(U64)
    return (found ^ _SIGN).view(np.int64)


def runs_of(data: np.ndarray, bounds: np.ndarray, length: int, anchor: int):
    """Leading bytes and hash of the anchor, content hash, start and number of suffixes of each run in some texts."""
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return (empty,) * 5
    hashed = _Hashed(data)
    every = hashed.every(anchor)
    # the place below the hash, so that the least also tells its first place
    least = (every & ~U64(_PLACE)) | np.arange(len(every), dtype=U64)
    size, width = 1, length - anchor + 1
    while size * 2 <= width:
        least, size = np.minimum(least[:-size], least[size:]), size * 2
    if size < width:
        least = np.minimum(least[: len(least) - (width - size)], least[width - size :])
    change = np.zeros(len(data) + 1, np.int32)
    long = np.diff(bounds) >= length
    np.add.at(change, bounds[:-1][long], 1)
    np.add.at(change, bounds[1:][long] - length + 1, -1)
    starts = np.flatnonzero(np.cumsum(change[:-1]))  # of suffixes with ``length`` bytes
    if not len(starts):
        return (empty,) * 5
    # a run has one place as its anchor, so its suffixes differ from one another
    place = (least[starts] & U64(_PLACE)).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
    at = np.flatnonzero(new)
    start, count = starts[at], np.diff(np.r_[at, len(starts)])
    content = hashed.of(start, start + count - 1 + length)
    return _lead(data, place[at]), every[place[at]].view(np.int64), content.view(np.int64), start, count


def _place(text):
    """A checksum of the text above the offset in it: tells apart texts that share an id."""
    return F.crc32(F.coalesce(text, F.lit(""))).bitwiseAND((1 << 31) - 1)


def _record(names: str, arrays) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [f.split() for f in names.split(", ")]
    return pa.RecordBatch.from_arrays(
        [a if isinstance(a, pa.Array) else pa.array(a, kinds[k]) for a, (_, k) in zip(arrays, fields, strict=True)],
        [n for n, _ in fields],
    )


def _strings(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Substrings of some bytes."""
    ends = np.cumsum(sizes)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)
    offsets = np.r_[0, ends].astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data[at])])


def _sliced(data: np.ndarray, bounds: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Some texts as they are; one very long text in slices that start each suffix once."""
    if len(data) <= 2 * AT_ONCE or len(bounds) > 2:
        yield 0, data, bounds
        return
    for first in range(0, len(data), AT_ONCE):
        part = data[first : first + AT_ONCE + length - 1]
        yield first, part, np.array([0, len(part)])


_RUN = "lead long, key long, content long, doc long, place long, n int"
_ORDER = ["lead", "key", "content", "doc", "place"]


def _first_runs(length: int, anchor: int):
    """Runs of whole texts, from (doc, check, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column(0).to_numpy(zero_copy_only=False)
            checks = batch.column(1).to_numpy(zero_copy_only=False)
            for first, _, data, bounds in text_parts(batch.column(2)):
                for offset, part, ends in _sliced(data, bounds, length):
                    lead, key, content, start, count = runs_of(part, ends, length, anchor)
                    row = np.searchsorted(ends, start, "right") - 1
                    place = (checks[first + row] << 32) | (offset + start - ends[row])
                    yield _record(_RUN, [lead, key, content, docs[first + row], place, count])

    return run


def _inner_runs(length: int, anchor: int):
    """The runs of the next level inside open runs, with their bytes, from (doc, place, bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, places = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for first, _, data, bounds in text_parts(batch.column(2)):
                lead, key, content, start, count = runs_of(data, bounds, length, anchor)
                row = np.searchsorted(bounds, start, "right") - 1
                place = places[first + row] + start - bounds[row]
                found = _strings(data, start, count + length - 1)
                yield _record(f"{_RUN}, bytes binary", [lead, key, content, docs[first + row], place, count, found])

    return run


def _whole(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    held = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(held).combine_chunks() if held else None


def _first_of(doc: np.ndarray, place: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Rows at the very place of the first row of their group."""
    heads = np.flatnonzero(~same)
    head = heads[np.cumsum(~same) - 1]
    return (doc == doc[head]) & (place == place[head])


_OPEN = "doc long, place long, n int, settled boolean"


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bucket of an upper level: runs that are repeated as a whole, and those that stay open."""
    held = _whole(batches)
    if held is None:
        return
    lead, key, content, doc, place, n = (held.column(c).to_numpy() for c in [*_ORDER, "n"])
    order = multikey_order([lead, key, content, doc, place])
    lead, key, content, doc, place, n = (a[order] for a in (lead, key, content, doc, place, n))
    same_key = np.r_[False, (lead[1:] == lead[:-1]) & (key[1:] == key[:-1])]
    same_run = same_key & np.r_[False, content[1:] == content[:-1]]
    keys = np.cumsum(~same_key) - 1  # number of the anchor
    firsts = ~same_run
    border = (keys == 0) | (keys == keys[-1])
    left = firsts & ((np.bincount(keys, firsts)[keys] > 1) | border)
    # of rows that the table holds twice the first stands for both
    again = np.r_[False, (doc[1:] == doc[:-1]) & (place[1:] == place[:-1])]
    settled = same_run & ~again & ~_first_of(doc, place, same_run)
    chosen = np.flatnonzero(left | settled)
    arrays = [doc[chosen], place[chosen], n[chosen], settled[chosen]]
    if "bytes" not in held.column_names:
        yield _record(_OPEN, arrays)
        return
    texts = held.column("bytes").combine_chunks().take(pa.array(order[chosen]))
    kept = pc.if_else(pa.array(settled[chosen]), pa.scalar(None, pa.binary()), texts)
    yield _record(f"{_OPEN}, bytes binary", [*arrays, kept])


def _contents(length: int):
    """Open runs with their bytes, those of several texts together, from (doc, check, text, runs of that text)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, checks = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            spans = batch.column(3)
            held, size_held = [], 0
            for row in range(batch.num_rows):
                data = np.frombuffer(batch.column(2)[row].as_buffer(), np.uint8)
                start, n = (spans[row].values.field(k).to_numpy() for k in (0, 1))
                for first in range(0, len(start), 4096):
                    at, size = start[first : first + 4096].astype(np.int64), n[first : first + 4096].astype(np.int64)
                    found = _strings(data, at, size + length - 1)
                    held.append((np.full(len(at), docs[row]), (checks[row] << 32) | at, found))
                    size_held += found.nbytes
                    if size_held >= AT_ONCE:
                        yield _joined(held)
                        held, size_held = [], 0
            if held:
                yield _joined(held)

    return cut


def _joined(held: list[tuple]) -> pa.RecordBatch:
    docs, places, found = zip(*held, strict=True)
    return _record("doc long, place long, bytes binary", [np.concatenate(docs), np.concatenate(places), pa.concat_arrays(found)])


def _as_given(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return batches


def _chained(first, then):
    """Both functions of batches in one Python worker; two ``mapInArrow`` in a row take two for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from then(first(batches))

    return run


def _suffixes(length: int):
    """Each suffix of open runs with its bytes, from (doc, place, bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, places = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for first, last, data, bounds in text_parts(batch.column(2), AT_ONCE // 8):
                n = np.diff(bounds) - length + 1
                which = np.repeat(np.arange(last - first), n)
                nth = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
                found = _strings(data, bounds[which] + nth, np.full(len(which), length))
                yield _record("bytes binary, doc long, place long", [found, docs[first + which], places[first + which] + nth])

    return run


#: Where a suffix of the last level lies in its bucket: inside, and repeated; first; last.
_INSIDE, _HEAD, _TAIL = range(3)


def _words(rows: np.ndarray) -> list[np.ndarray]:
    """Strings of one length, a row each, as numbers of eight bytes that order like them."""
    size = -(-rows.shape[1] // 8) * 8
    padded = np.zeros((len(rows), size), np.uint8)
    padded[:, : rows.shape[1]] = rows
    return [padded[:, k : k + 8].copy().view(">u8")[:, 0].astype(U64) for k in range(0, size, 8)]


def _last_level(length: int):
    """One bucket of whole suffixes: those that equal the one before in order, and both borders."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _whole(batches)
        if held is None:
            return
        doc, place = (held.column(c).to_numpy() for c in ("doc", "place"))
        rows = np.concatenate(
            [np.frombuffer(c.buffers()[2], np.uint8)[c.offset * length : (c.offset + len(c)) * length] for c in held.column("bytes").chunks]
        ).reshape(-1, length)
        words = _words(rows)
        order = multikey_order([*words, doc, place])
        same = np.ones(len(order), bool)
        same[:1] = False
        for word in words:
            same[1:] &= word[order[1:]] == word[order[:-1]]
        doc, place = doc[order], place[order]
        # of rows that the table holds twice the first stands for both
        again = np.r_[False, (doc[1:] == doc[:-1]) & (place[1:] == place[:-1])]
        repeated = np.flatnonzero(same & ~again & ~_first_of(doc, place, same))
        at = np.r_[repeated, 0, len(order) - 1]
        edge = np.r_[np.full(len(repeated), _INSIDE), _HEAD, _TAIL]
        border = [None] * len(repeated) + [rows[order[0]].tobytes(), rows[order[-1]].tobytes()]
        yield _record("doc long, place long, edge int, bytes binary", [doc[at], place[at], edge, border])

    return compare


def _removed(length: int, with_text: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, text, spans in zip(*(batch.column(k) for k in range(3)), strict=True):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                found = sorted((s["start"], s["n"]) for s in (spans.as_py() or []))
                kept, at, removed, runs, end = [], 0, 0, 0, -1
                for start, n in found:
                    stop = start + n - 1 + length
                    if start > end:
                        runs += 1
                        kept.append(data[at:start])
                        removed += stop - start
                    elif stop > end:
                        removed += stop - end
                    end = at = max(end, stop)
                kept.append(data[at:])
                rest = b"".join(kept)
                # a cut may leave part of a character; the text form drops such bytes
                last = rest.decode(errors="ignore") if with_text else hashlib.sha256(rest).hexdigest()
                if with_text and not text.is_valid:
                    last = None
                out.append((doc.as_py(), len(data), removed, runs, last))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = [batch.column(0).type, pa.int64(), pa.int64(), pa.int64(), pa.string()]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_text" if with_text else "kept_sha256"]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], *batch.columns[3:]],
                [*names, *["rest"] * (batch.num_columns - 3)],
            )

    return cut


def _buckets(size: int, per_bucket: int) -> int:
    return min(MOST_BUCKETS, tasks_for(size, per_bucket))


def _open_suffixes(level: DataFrame) -> int:
    return level.filter("not settled").agg(F.sum("n")).first()[0] or 0


def repeated_spans(
    docs: DataFrame, length: int = 100, anchors: Sequence[int] = ANCHORS, per_bucket: int | None = None
) -> DataFrame:
    """``doc, place, n``: n consecutive repeated suffixes that start at a place (see ``_place``).

    ``docs`` has the columns doc, check and text. ``per_bucket`` sets the bytes of text or rows of a bucket.
    """
    anchors = [min(a, length - 1) for a in anchors]
    buckets = _buckets(text_bytes(docs), per_bucket or ROWS_PER_BUCKET // 2)
    runs = docs.mapInArrow(tidied(_first_runs(length, anchors[0])), _RUN)
    level = written(runs.repartitionByRange(buckets, *_ORDER).mapInArrow(tidied(_compared), _OPEN), "runs")
    spans = [level.filter("settled").select("doc", "place", "n")]
    wanted = (
        level.filter("not settled")
        .select("doc", F.shiftright("place", 32).alias("check"), F.col("place").bitwiseAND(_PLACE).cast("int").alias("start"), "n")
        .groupBy("doc", "check")
        .agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    )
    opened = docs.join(wanted.hint("shuffle_hash"), ["doc", "check"]).select("doc", "check", "text", "runs")
    contents = _contents(length)
    for anchor in anchors[1:]:
        rows = _open_suffixes(level) // max(1, (length - anchor + 1) // 2) + 1
        buckets = _buckets(rows * 2 * length, per_bucket or ROWS_PER_BUCKET)
        runs = opened.mapInArrow(tidied(_chained(contents, _inner_runs(length, anchor))), f"{_RUN}, bytes binary")
        level = written(
            runs.repartitionByRange(buckets, *_ORDER).mapInArrow(tidied(_compared), f"{_OPEN}, bytes binary"), "inner-runs"
        )
        spans.append(level.filter("settled").select("doc", "place", "n"))
        opened, contents = level.filter("not settled").select("doc", "place", "bytes"), _as_given
    suffixes = opened.mapInArrow(tidied(_chained(contents, _suffixes(length))), "bytes binary, doc long, place long")
    buckets = _buckets(_open_suffixes(level) * (length + 36), per_bucket or ROWS_PER_BUCKET)
    last = written(
        suffixes.repartitionByRange(buckets, "bytes", "doc", "place").mapInArrow(
            tidied(_last_level(length)), "doc long, place long, edge int, bytes binary"
        ),
        "suffixes",
    )
    place = F.struct("doc", "place")
    before = last.filter(F.col("edge") == _TAIL).groupBy("bytes").agg(F.min(place).alias("first"))
    heads = last.filter(F.col("edge") == _HEAD).join(before, "bytes").filter(F.col("first") < place)
    for found in (last.filter(F.col("edge") == _INSIDE), heads):
        spans.append(found.select("doc", "place", F.lit(1).alias("n")))
    out = spans[0]
    for more in spans[1:]:
        out = out.unionByName(more)
    return out


def remove_repeated(
    docs: DataFrame,
    length: int = 100,
    anchors: Sequence[int] = ANCHORS,
    with_text: bool = False,
    carry: Sequence[str] = (),
    id_col: str = "doc_id",
    text_col: str = "text",
    per_bucket: int | None = None,
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (or ``kept_text``) of each row.

    Every byte that lies in a string of ``length`` bytes which also starts earlier is removed: in a
    document with a smaller id, or before in the same one. Strings are taken from the input as it is,
    never across documents, and may overlap. ``n_spans`` counts the maximal removed runs;
    ``kept_text`` leaves out bytes of characters that a cut has split.

    The runs of all documents cross the network once, a row for about 27 bytes, and the texts twice, to
    meet their open runs and their spans; rows of the next levels are for open runs and suffixes alone.
    Splitters cut between equal strings too, so an anchor, passage or copied text of any share is spread.
    A task holds one bucket. Buckets grow with the input once there are ``MOST_BUCKETS`` of them.

    At the upper levels runs are equal if the first eight bytes and a 64-bit hash of their anchors and a
    64-bit hash of their bytes are; at the last level suffixes are compared by all their bytes.

    A null text counts as empty (``kept_text`` stays null); texts shorter than ``length`` keep
    everything; a very long text is read in slices; a null id is smaller than all others; rows with one id are ordered by a checksum of
    their text, and repeats of the same row are one document and get the same result. An empty table
    gives no rows. Other columns are ignored.
    """
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("doc"),
        _place(text).alias("check"),
        text.alias("text"),
        *([F.struct(*[F.col(c) for c in carry]).alias("rest")] if carry else []),
    )
    plain = rows.select("doc", "check", F.coalesce("text", F.lit("")).alias("text"))
    spans = (
        repeated_spans(plain, length, anchors, per_bucket)
        .select("doc", F.shiftright("place", 32).alias("check"), F.col("place").bitwiseAND(_PLACE).cast("int").alias("start"), "n")
        .groupBy("doc", "check")
        .agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    )
    spans = written(spans, "spans")
    kind = dict(docs.dtypes)[id_col]
    last = "kept_text string" if with_text else "kept_sha256 string"
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, {last}"
    if carry:
        schema += f", rest {dict(rows.dtypes)['rest']}"
    return (
        rows.join(spans.hint("shuffle_hash"), ["doc", "check"], "left")
        .select("id", "text", "spans", *["rest"] * bool(carry))
        .mapInArrow(tidied(_removed(length, with_text)), schema)
    )


def without_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``, and ``n_chars`` counted anew if there is one.

    All rows stay, one that is nothing but repeats with an empty text. See ``remove_repeated``.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    cut = remove_repeated(docs, length, with_text=True, carry=rest)
    values = {"doc_id": F.col("doc_id"), "text": F.col("kept_text")} | {c: F.col("rest")[c] for c in rest}
    if "n_chars" in values:
        values["n_chars"] = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
    return cut.select(*[values[c].alias(c) for c in docs.columns])
