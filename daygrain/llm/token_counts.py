"""Token counts of a unigram vocabulary without building the tokens.

An Aho-Corasick automaton lists every piece that occurs in a text; a dynamic program over the end
positions carries the best score and the number of pieces of the best path, no back pointers. Ties
go to the path whose last piece starts first, which is what a tokenizer does that walks the starts in
order and replaces a path only by a better one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.word_table import ChunkTable, for_worker

MARK = "▁"
#: How much worse than the worst piece a character without a piece is, as in unigram tokenizers.
UNKNOWN = 10.0
#: Line breaks and tabs are in no piece, runs of marks only in front of one.
CHUNKS = re.compile(f"[\n\t]|{MARK}+[^{MARK}\n\t]*|[^{MARK}\n\t]+")


class Unigram:
    """Best-path counts for a vocabulary of pieces with scores."""

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.unknown = min(s for _, s in pieces) - UNKNOWN
        self.splits = not any(MARK in p.lstrip(MARK) or "\n" in p or "\t" in p for p, _ in pieces)
        self.table = ChunkTable(self.best)

    def best(self, text: str) -> tuple[int, float]:
        """Number of pieces and score of the best path; a character without a piece counts its bytes."""
        n = len(text)
        arcs: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, arc in self.automaton.iter(text):
            arcs[end].append(arc)
        score, count = [0.0] * (n + 1), [0] * (n + 1)
        for end in range(n):
            best, pieces, longest = None, 0, 0
            if text[end] not in self.single:
                best, longest = score[end] + self.unknown, 1
                pieces = count[end] + len(text[end].encode())
            for length, own in arcs[end]:
                start = end + 1 - length
                total = score[start] + own
                if best is None or total > best or total == best and length > longest:
                    best, pieces, longest = total, count[start] + 1, length
            score[end + 1], count[end + 1] = best, pieces
        return count[n], score[n]

    def __call__(self, text: str | None) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        marked = MARK + text.replace(" ", MARK)
        if not self.splits:
            return self.best(marked)
        table, n, total = self.table, 0, 0.0
        for chunk in CHUNKS.findall(marked):
            pieces, score = table[chunk]
            n += pieces
            total += score
        return n, total


def model_pieces(model_file: str) -> list[tuple[str, float]]:
    """The ordinary pieces of a SentencePiece model and their scores."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return [
        (m.id_to_piece(i), m.get_score(i))
        for i in range(m.get_piece_size())
        if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))
    ]


def worker_unigram(model_file: str) -> Unigram:
    """One for each worker process, which keeps its table over the tasks it is given."""
    return for_worker(("counts", model_file), lambda: Unigram(model_pieces(model_file)))


def unigram_token_counts(
    docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens, score``: pieces of the best unigram segmentation of each whole text.

    The vocabulary is the ordinary pieces of a SentencePiece model with their scores, a space is the
    mark U+2581 and one mark stands in front; a character without a piece becomes its bytes. Scores
    add up as doubles. Where no piece holds a mark or line break after another character, the best
    path splits there, so each distinct word is worked out once for each worker (a bounded table).

    No shuffle. A null or empty text has no tokens and score 0; repeated rows are counted each; an
    empty table gives no rows; a text of any length is counted whole. Other columns are ignored.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unigram = worker_unigram(model_file)
        for batch in batches:
            found = [unigram(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array([s for _, s in found], pa.float64())],
                ["doc_id", "n_tokens", "score"],
            )

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("doc_id"), text_col).mapInArrow(
        counted, f"doc_id {kind}, n_tokens long, score double"
    )
