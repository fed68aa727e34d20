"""Packing token sequences with a bounded number of open windows.

Documents come in the order of their partition. Each is placed in the open window that it fills best;
when it fits none, a new window is opened, and if the fixed number of open windows is reached, the
fullest is emitted first. What is open at the end of a partition is merged with the open windows of
its neighbours.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.tables import written
from daygrain.llm.word_table import for_worker, give_back, tidied

#: Open windows of a partition.
OPEN = 16
#: Rows of pieces that a task hands over together.
ROWS = 256
#: Partitions whose leftover windows are merged together, so a merge sees OPEN * MERGED windows at most.
MERGED = 16
#: Words, letters and signs a worker remembers, those that stay when these are too many, and texts looked at together.
WORDS, KEPT, TEXTS = 400_000, 200_000, 1024
#: Bytes of a string that may stay; a text without blanks is one long word.
LONGEST = 64
#: Letters that neither composing nor lower case makes more than one letter of, and signs behind them.
_LETTERS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+"
_PLAIN = f"^(?P<letters>{_LETTERS})(?P<signs>[!-&(-/:-@\\[-`{{-~]*)$"


def _gathered(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``size`` numbers from each ``start``, one after another, and where each begins and the last ends."""
    # a batch has fewer than 2**31 tokens
    ends = np.zeros(len(size) + 1, np.int32)
    np.cumsum(size, out=ends[1:])
    at = np.repeat(start - ends[:-1], size)
    at += np.arange(len(at), dtype=np.int32)
    return data[at], ends


class WordIds:
    """Token ids of texts as little-endian 32-bit numbers, tokenizing each distinct word once.

    For tokenizers that drop white space and whose tokens never cross it, the ids of a text are those
    of its words in order. Such a tokenizer also parts letters from the signs behind them and puts them in
    lower case, so a word is put together from bare letters and signs, and letters are tokenized many at a
    time, since their last token tells where a word ends. What is known is held in four arrays: the strings, where
    their ids start, how many these are, and when a string was last asked for. Those not asked for longest are
    forgotten when the arrays are full, so memory is bounded and what is in use stays.
    """

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer_file)
        for whole, parts in ((" a \n b ", ["a", "b"]), ("Ab.", ["ab", "."]), ("ab,(", ["ab", ",("])):
            if self._ids([whole])[0].tolist() != self._ids(parts)[0].tolist():
                raise ValueError("this tokenizer does not part words as the table does")
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[number for token, number in vocabulary.items() if token.endswith("</w>")]] = True
        self.strings = pa.array([], pa.large_string())
        self.start, self.size, self.asked = (np.zeros(0, np.int32) for _ in range(3))
        self.data, self.now = np.zeros(0, "<u4"), 0
        del vocabulary
        give_back()

    def _ids(self, texts: list[str], at_once: int = 2048) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and their number in each; the library holds much more than these for the texts it is given at once."""
        found = [np.zeros(0, "<u4")]
        for first in range(0, len(texts), at_once):
            coded = self.library.encode_batch_fast(texts[first : first + at_once], add_special_tokens=False)
            found.extend(np.array(c.ids, "<u4") for c in coded)
        return np.concatenate(found), np.fromiter(map(len, found[1:]), np.int32, len(texts))

    def _letters(self, words: list[str], together: int = 256) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters and their number in each."""
        groups = [words[i : i + together] for i in range(0, len(words), together)]
        data, sizes = self._ids([" ".join(g) for g in groups], 16)
        cuts = np.flatnonzero(self.ends[data]) + 1
        each = np.diff(np.searchsorted(cuts, np.cumsum(sizes), "right"), prepend=0)
        if each.tolist() != list(map(len, groups)):
            return self._ids(words)
        return data, np.diff(cuts, prepend=0).astype(np.int32)

    def _learn(self, strings: pa.Array) -> None:
        """Put strings that are not known, and their ids, behind those that are."""
        bare = pc.match_substring_regex(strings, f"^{_LETTERS}$")
        for new, ids_of in ((strings.filter(bare), self._letters), (strings.filter(pc.invert(bare)), self._ids)):
            data, size = ids_of(new.to_pylist())
            self.strings = pa.concat_arrays([self.strings, new])
            self.start = np.concatenate([self.start, len(self.data) + np.cumsum(size, dtype=np.int32) - size])
            self.size = np.concatenate([self.size, size])
            self.asked = np.concatenate([self.asked, np.full(len(new), self.now, np.int32)])
            self.data = np.concatenate([self.data, data])

    def _forget(self) -> None:
        """Keep the strings asked for last, but no long ones."""
        short = np.flatnonzero(pc.binary_length(self.strings).to_numpy() <= LONGEST)
        kept = np.sort(short[np.argsort(-self.asked[short], kind="stable")[:KEPT]])
        self.strings = self.strings.take(pa.array(kept))
        self.size, self.asked = self.size[kept], self.asked[kept]
        self.data, ends = _gathered(self.data, self.start[kept], self.size)
        self.start = ends[:-1]

    def _of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and where those of each begin and the last end."""
        plain = pc.extract_regex(words, _PLAIN)
        # by Arrow's lower case, which is the tokenizer's for these letters
        letters = pc.coalesce(pc.utf8_lower(pc.struct_field(plain, [0])), words)
        signs = pc.fill_null(pc.struct_field(plain, [1]), "")
        parts = pa.concat_arrays([letters, signs]).dictionary_encode()
        if len(self.strings) + len(parts.dictionary) > WORDS or self.strings.nbytes > LONGEST * WORDS:
            self._forget()
        self.now += 1
        at = pc.index_in(parts.dictionary, value_set=self.strings)
        unknown = pc.is_null(at)
        place = pc.fill_null(at, 0).to_numpy().copy()
        known = pc.invert(unknown).to_numpy(zero_copy_only=False)
        self.asked[place[known]] = self.now
        new = parts.dictionary.filter(unknown)
        if len(new):
            before = len(self.strings)
            self._learn(new)
            place[~known] = before + pc.index_in(new, value_set=self.strings.slice(before)).to_numpy()
        which = place[parts.indices.to_numpy().reshape(2, -1).T.ravel()]
        data, ends = _gathered(self.data, self.start[which], self.size[which])
        return data, ends[::2]

    def __call__(self, texts: list[str | None] | pa.Array) -> Iterator[bytes]:
        column = texts if isinstance(texts, (pa.Array, pa.ChunkedArray)) else pa.array(texts, pa.large_string())
        column = pc.fill_null(column.cast(pa.large_string()), "")
        for first in range(0, len(column), TEXTS):
            rows = pc.split_pattern(pc.replace_substring(column.slice(first, TEXTS), "\n", " "), " ")
            words = rows.flatten().dictionary_encode()
            ids, ends = self._of(words.dictionary)
            which = words.indices.to_numpy()
            flat, ends = _gathered(ids, ends[which], np.diff(ends)[which])
            flat = flat.tobytes()
            bounds = rows.offsets.to_numpy() - rows.offsets[0].as_py()
            bounds = (4 * ends[bounds].astype(np.int64)).tolist()
            del rows, words, which
            # the allocators would keep several times what is in use
            give_back()
            for low, high in pairwise(bounds):
                yield flat[low:high]


def worker_words(tokenizer_file: str) -> WordIds:
    """One for each worker process, which keeps its table over the tasks it is given."""
    return for_worker(("packing", tokenizer_file), lambda: WordIds(tokenizer_file))


class Windows:
    """Best-fit placement with a fixed number of open windows."""

    def __init__(self, size: int, most_open: int, emit: Callable[[int, list, bool], None]):
        self.size, self.most_open, self.emit = size, most_open, emit
        self.free: list[tuple[int, int]] = []  # (room left, window), the fullest first
        self.held: dict[int, list] = {}
        self.made = 0

    def place(self, length: int, piece) -> None:
        """Put a piece of at most ``size`` tokens into the fullest open window with room for it."""
        at = bisect_left(self.free, (length, -1))
        if at < len(self.free):
            room, window = self.free.pop(at)
        else:
            if len(self.free) == self.most_open:
                self.close(0)
            room, window = self.size, self.made
            self.made += 1
            self.held[window] = []
        self.held[window].append((self.size - room, piece))
        insort(self.free, (room - length, window))
        if room == length:
            self.close(0)

    def close(self, at: int) -> None:
        _, window = self.free.pop(at)
        self.emit(window, self.held.pop(window), False)

    def finish(self) -> None:
        """Hand over the windows that are still open."""
        for _, window in self.free:
            self.emit(window, self.held.pop(window), True)
        self.free = []


def _pieces(batches: Iterator[pa.RecordBatch], ids_of, end_id: int, size: int, most_open: int, with_ids: bool):
    from pyspark import TaskContext

    base = TaskContext.get().partitionId() << 32
    end = np.array([end_id], "<u4").tobytes()
    rows: list[tuple] = []

    def emit(window: int, pieces: list, is_open: bool) -> None:
        for offset, (doc, start, total, ids) in pieces:
            length = len(ids) // 4
            content = np.frombuffer(ids, "<u4").astype(np.int32) if with_ids else zlib.crc32(ids)
            rows.append((doc, start, length, content, total, base + window, offset, is_open))

    def flushed(id_type: pa.DataType) -> pa.RecordBatch:
        names = ["doc_id", "start", "length", "ids" if with_ids else "ids_crc32", "doc_tokens", "window", "offset", "open"]
        kinds = [id_type, pa.int64(), pa.int64(), pa.list_(pa.int32()) if with_ids else pa.int64(), *[pa.int64()] * 3, pa.bool_()]
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        batch = pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)
        rows.clear()
        return batch

    windows, id_type = Windows(size, most_open, emit), pa.int64()
    for batch in batches:
        id_type = batch.column(0).type
        for first in range(0, batch.num_rows, TEXTS):
            docs = batch.column(0).slice(first, TEXTS).to_pylist()
            for doc, ids in zip(docs, ids_of(batch.column(1).slice(first, TEXTS)), strict=True):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, size):
                    piece = ids[4 * start : 4 * (start + size)]
                    windows.place(len(piece) // 4, (doc, start, total, piece))
            if len(rows) >= ROWS:
                yield flushed(id_type)
    windows.finish()
    yield flushed(id_type)


def _merge(size: int, most_open: int):
    """Pack leftover windows as wholes, the fullest first."""

    def merged(group: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []

        def emit(_, windows: list, __) -> None:
            target = windows[0][1]
            out.extend((window, target, shift) for shift, window in windows)

        packed = Windows(size, most_open, emit)
        fills, windows = (group.column(c).to_pylist() for c in ("fill", "window"))
        for fill, window in sorted((-f, w) for f, w in zip(fills, windows, strict=True)):
            packed.place(-fill, window)
        packed.finish()
        columns = zip(*out, strict=True) if out else [[]] * 3
        return pa.table([pa.array(list(c), pa.int64()) for c in columns], names=["window", "target", "shift"])

    return merged


def pack_documents(
    docs: DataFrame,
    tokenizer_file: str,
    size: int = 4096,
    end_id: int = 2,
    most_open: int = OPEN,
    merged_partitions: int = MERGED,
    with_ids: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of documents in sequences of at most ``size`` tokens.

    Gives ``doc_id, start, length, ids (or ids_crc32), doc_tokens, sequence_id, offset``: a piece holds
    the document's ids from ``start`` on and lies at ``offset`` of its sequence, gapless from 0. With
    ``with_ids=False`` the CRC-32 of the ids as little-endian 32-bit numbers stands for the ids.
    A sequence is padded behind its last piece up to ``size``. Documents longer than ``size`` are cut
    into full windows and a rest; others stay whole.

    Packing runs inside each partition as it is read, so texts and ids cross no network, and a long
    text, source or group of copies is no hot key. A task holds ``most_open`` windows and one batch.
    The pieces are written to the shared folder; the windows left open, at most ``most_open`` for each
    partition, are then merged in groups of ``merged_partitions`` neighbouring partitions, however
    many partitions there are.

    A null or empty text is one end id; repeated rows are packed each; an empty table gives no rows.
    Other columns are ignored. ``sequence_id`` is unique, not gapless, and follows the partitions.
    """
    kind = dict(docs.dtypes)[id_col]
    content = "ids array<int>" if with_ids else "ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _pieces(batches, worker_words(tokenizer_file), end_id, size, most_open, with_ids)

    pieces = written(
        docs.select(F.col(id_col).alias("doc_id"), text_col).mapInArrow(
            tidied(run),
            f"doc_id {kind}, start long, length long, {content}, doc_tokens long, window long, offset long, open boolean",
        ),
        "pieces",
    )
    columns = ["doc_id", "start", "length", content.split()[0], "doc_tokens"]
    left = pieces.filter("open")
    fills = left.groupBy("window").agg(F.sum("length").alias("fill"))
    near = F.floor(F.shiftright("window", 32) / merged_partitions)
    moves = fills.groupBy(near.alias("near")).applyInArrow(
        _merge(size, most_open * merged_partitions), "window long, target long, shift long"
    )
    closed = pieces.filter("not open").select(*columns, F.col("window").alias("sequence_id"), "offset")
    moved = left.join(moves, "window").select(
        *columns, F.col("target").alias("sequence_id"), (F.col("offset") + F.col("shift")).alias("offset")
    )
    return closed.unionByName(moved)
