"""SentencePiece ids and their text, segmenting each distinct marked word once.

A model marks a space as U+2581. If no piece holds the mark after another character, no merge can
join what stands before a mark with the mark, so a text falls into chunks (a run of marks and what
follows) that are segmented each on its own. Words repeat, so each task keeps a table of the distinct
chunks it has met and joins the ids back by their position in the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.word_table import ChunkTable, for_worker

MARK = "▁"
CHUNKS = re.compile(f"{MARK}+[^{MARK}]*")


class Codec:
    """Encodes and decodes texts as the library does with the same model file."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = map(self.library.id_to_piece, range(self.library.get_piece_size()))
        crossing = [p for p in pieces if MARK in p.lstrip(MARK)]
        # a text gets one mark in front, and nothing else is changed
        plain = self.library.encode(" a  b ", out_type=str)
        if crossing or "".join(plain) != f"{MARK}{MARK}a{MARK}{MARK}b{MARK}":
            raise ValueError("pieces of this model cross words, or it rewrites texts")
        self.table = ChunkTable(self._segment)

    def _segment(self, chunk: str) -> tuple[int, str, str]:
        """Number of ids, ids as text, and decoded text of a chunk, which starts with a mark."""
        if chunk == MARK:  # a space at the end of a text; without it the library sees no text
            ids = [self.library.piece_to_id(MARK)]
        else:
            ids = self.library.encode(chunk[1:].replace(MARK, " "))
        # the library leaves out the space in front, which stands for the mark it adds
        return len(ids), ",".join(map(str, ids)), " " + self.library.decode(ids)

    def __call__(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, ids joined by commas, decoded text; null counts as empty."""
        if not text:
            return 0, "", ""
        table = self.table
        chunks = [table[c] for c in CHUNKS.findall(MARK + text.replace(" ", MARK))]
        return (
            sum(c[0] for c in chunks),
            ",".join(c[1] for c in chunks),
            "".join(c[2] for c in chunks)[1:],
        )


def worker_codec(model_file: str) -> Codec:
    """One for each worker process, which keeps its table over the tasks it is given."""
    return for_worker(("codes", model_file), lambda: Codec(model_file))


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def sentencepiece_codes(
    docs: DataFrame, model_file: str, digest: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded``: each whole text's ids and the text they decode to.

    With ``digest`` the two long columns are ``ids_sha256`` and ``decoded_sha256`` instead: SHA-256
    of the decimal ids joined by commas, and of the decoded text. The model file has to be at the
    same path on all executors. No shuffle; a task holds one batch of rows and its bounded table.

    A null or empty text has no ids; repeated rows are coded each; an empty table gives no rows; a
    text of any length is coded whole. Other columns are ignored.
    """
    names = ["ids_sha256", "decoded_sha256"] if digest else ["ids", "decoded"]
    ids_type = pa.string() if digest else pa.list_(pa.int32())

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(model_file)
        for batch in batches:
            counts, first, second = [], [], []
            for text in batch.column(1).to_pylist():
                n, ids, decoded = codec(text)
                counts.append(n)
                first.append(sha256(ids) if digest else [int(i) for i in ids.split(",") if i])
                second.append(sha256(decoded) if digest else decoded)
            columns = [pa.array(counts, pa.int64()), pa.array(first, ids_type), pa.array(second, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_tokens", *names])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("doc_id"), text_col).mapInArrow(
        coded,
        f"doc_id {kind}, n_tokens long, {names[0]} {'string' if digest else 'array<int>'}, {names[1]} string",
    )
