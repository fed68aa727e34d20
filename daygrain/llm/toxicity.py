"""Toxicity from a weighted lexicon, matched by Aho-Corasick in folded text.

Folding undoes disguises: case, look-alike letters of other scripts, full-width forms, digits in
place of letters, invisible characters. Accents stay, since they tell words apart. The lexicon (whole words, and word beginnings for
terms with many endings) and the phrases that excuse a term are learned from labelled documents; a
document's score is a logistic function of its summed weights, as they are and for its length.
"""

from __future__ import annotations

import math
import unicodedata
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.tables import small_table, written
from daygrain.llm.word_table import release, tidied

#: Digits and signs used in place of letters.
DIGITS = dict(zip("01345789@", "oieastbga", strict=True))
#: Cyrillic and Greek letters that look like Latin ones, both sides in the same order.
ALIKE = dict(zip("аеорсухіѕјһԁԛԝкмтвнαορντκιυεχηωγ", "aeopcyxisjhdqwkmtbhaopvtkiuexnwy", strict=True))
#: Lengths of the word beginnings that may become entries.
STEMS = range(3, 7)
#: Documents of each class that the lexicon is learned from, whole texts.
TOXIC_DOCS, CLEAN_DOCS = 3000, 6000
#: How much likelier in toxic texts an entry is at least, as a logarithm.
LEAST_WEIGHT = 3.0
#: Clean texts that excuse a term beside a word, and counted entries a task holds before it hands them over.
LEAST_EXCUSES, HELD = 3, 100_000


class _Folded(dict):
    """Code point -> folded text, worked out when first met."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        parts = unicodedata.normalize("NFKC", ALIKE.get(char.lower(), char.lower()))
        kept = "".join(c for c in parts if unicodedata.category(c) not in ("Cf", "Mn"))
        text = "".join(ALIKE.get(c, DIGITS.get(c, c)) for c in kept)
        # what is invisible joins its neighbours, what is no letter parts them
        value = "".join(c if c.isalpha() else " " for c in text)
        self[code] = value
        return value


_FOLDED = _Folded()


def fold(text: str) -> str:
    """Folded words between single or several blanks, with a blank at both ends."""
    return f" {unicodedata.normalize('NFC', text).translate(_FOLDED)} "


@dataclass
class Lexicon:
    """``weights``: " word " or " beginning" -> weight. ``excused``: phrases in which a term counts nothing."""

    weights: dict[str, float] = field(default_factory=dict)
    excused: list[str] = field(default_factory=list)
    #: intercept, factor of log(1 + sum), factor of log(1 + sum per 100 characters)
    logistic: tuple[float, float, float] = (-math.inf, 0.0, 0.0)

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            found.add_word(entry, (len(entry), weight))
        for phrase in self.excused:
            found.add_word(phrase, (len(phrase), None))
        if len(found):
            found.make_automaton()
        return found


def hits(automaton, folded: str) -> tuple[dict[int, float], list[tuple[int, int]]]:
    """Best weight by the place of the word, and the spans of excusing phrases."""
    best: dict[int, float] = {}
    spans = []
    if len(automaton):
        for end, (length, weight) in automaton.iter(folded):
            start = end + 1 - length
            if weight is None:
                spans.append((start, end))
            elif weight > best.get(start, 0.0):
                best[start] = weight
    return best, spans


def weight_of(automaton, folded: str) -> float:
    """Sum of the best weight of every word that no excusing phrase covers.

    Phrases that overlap are merged to runs, and each word is looked up among these.
    """
    best, spans = hits(automaton, folded)
    if not spans:
        return sum(best.values())
    firsts, ends = [], []
    for first, end in sorted(spans):
        if ends and first < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            firsts.append(first)
            ends.append(end)
    places = [(at, bisect_right(firsts, at) - 1) for at in best]
    return sum(best[at] for at, run in places if run < 0 or at >= ends[run])


def features(weight: float, text: str) -> tuple[float, float]:
    return math.log1p(weight), math.log1p(100 * weight / (len(text) + 100))


def _keys(words: list[str]) -> list[str]:
    """What a copy of a text has in common with it: three of four minima, or all words of a short text.

    The minima are those of the hashed runs of three words in each residue class.
    """
    runs = {zlib.crc32(" ".join(words[i : i + 3]).encode()) for i in range(len(words) - 2)}
    least = [min(found) for k in range(4) if (found := [r for r in runs if r % 4 == k])]
    if len(least) < 4:
        return [" ".join(words)]
    # the residue tells the class of a minimum, so three of them are the same for the same text only
    return [" ".join(map(str, three)) for three in combinations(least, 3)]


def _first(keys: list[str], seen: set) -> bool:
    """Whether no text before had one of these keys."""
    if not seen.isdisjoint(keys):
        return False
    seen.update(keys)
    return True


def _novel(words: list[str], seen: set) -> bool:
    """Whether a text is no copy of one that was taken before."""
    return _first(_keys(words), seen)


def _entries(words: set[str]) -> set[str]:
    found = {f" {w} " for w in words}
    for n in STEMS:
        found.update(f" {w[:n]}" for w in words if len(w) > n)
    return found


def learn(rows: list[tuple[str, int]]) -> Lexicon:
    """A lexicon from texts labelled 1 (toxic) or 0; see :func:`learn_from`, which does the same on executors."""
    seen: set = set()
    taken = []
    for text, label in rows:
        folded = fold(text)
        if _novel(folded.split(), seen):
            taken.append((text, folded, label))
    n1 = sum(label for *_, label in taken)
    n0 = len(taken) - n1
    if not n1 or not n0:
        return Lexicon()
    by_label, words = (Counter(), Counter()), Counter()
    for _, folded, label in taken:
        own = set(folded.split())
        words.update(own)
        by_label[label].update(_entries(own))
    counts = {entry: (t, by_label[0][entry]) for entry, t in by_label[1].items()}
    lexicon = _lexicon(counts, n1, n0, sum(n > 1 for n in words.values()))
    phrases = (Counter(), Counter())
    automaton = lexicon.automaton()
    for _, folded, label in taken:
        phrases[label].update(_phrases(automaton, folded))
    lexicon.excused = sorted(p for p, n in phrases[0].items() if n >= LEAST_EXCUSES and p not in phrases[1])
    automaton = lexicon.automaton()
    x = np.array([features(weight_of(automaton, f), t) for t, f, _ in taken])
    lexicon.logistic = _logistic(x, np.array([label for *_, label in taken], float))
    return lexicon


def _lexicon(counts: dict[str, tuple[int, int]], n1: int, n0: int, words: int) -> Lexicon:
    """Entries among ``counts`` (texts of each class that have an entry) that tell the classes apart."""
    limit, share = math.log(max(2, words)), n1 / (n1 + n0)
    of_words: Counter = Counter()
    for entry, (t, _) in counts.items():
        if entry.endswith(" "):
            for n in STEMS:
                of_words[entry[: n + 1]] = max(of_words[entry[: n + 1]], t)
    kept = {}
    for entry, (t, c) in sorted(counts.items()):
        if not entry.endswith(" ") and t < 1.5 * of_words[entry]:
            continue  # a beginning that stands for one word alone
        weight = math.log((t + 0.5) / (n1 + 1)) - math.log((c + 0.5) / (n0 + 1))
        if weight < LEAST_WEIGHT:
            continue
        n = t + c
        gain = t * math.log(t / (n * share)) + (c * math.log(c / (n * (1 - share))) if c else 0.0)
        if gain > limit:
            kept[entry] = weight
    return Lexicon(kept)


def _phrases(automaton, folded: str) -> set[str]:
    """A term with its neighbour words, for each term in a text."""
    folded = " ".join(["", *folded.split(), ""])
    phrases = set()
    for at in hits(automaton, folded)[0]:
        end = folded.index(" ", at + 1)
        after, before = folded.find(" ", end + 1), folded.rfind(" ", 0, at)
        phrases.update([folded[at : after + 1]] * (after > 0) + [folded[before : end + 1]] * (before >= 0))
    return phrases


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    return tuple(_fit(np.c_[np.ones(len(x)), x], y))


def _counted(kind: str, of: Callable[[str], Iterable[str]]):
    """Texts of each class that have each of what ``of`` finds, added up in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        held: dict[int, Counter] = {0: Counter(), 1: Counter()}

        def flushed() -> Iterator[pa.RecordBatch]:
            for label, counts in held.items():
                columns = [pa.array(list(counts), pa.string()), pa.array([label] * len(counts), pa.int32()), pa.array(counts.values(), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [kind, "label", "n"])
                counts.clear()

        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                held[label].update(set(of(fold(text.as_py()))))
                if sum(map(len, held.values())) > HELD:
                    yield from flushed()
        yield from flushed()

    return run, f"{kind} string, label int, n long"


def _by_class(sample: DataFrame, kind: str, of: Callable[[str], Iterable[str]]) -> DataFrame:
    """``kind, t, c``: toxic and clean texts that have each."""
    run, schema = _counted(kind, of)
    found = sample.select("text", "label").mapInArrow(tidied(run), schema)
    of_class = [F.sum(F.when(F.col("label") == k, F.col("n")).otherwise(0)).alias(name) for k, name in ((1, "t"), (0, "c"))]
    return found.groupBy(kind).agg(*of_class)


def learn_from(sample: DataFrame) -> Lexicon:
    """A lexicon from ``doc_id, text, label`` rows as :func:`chosen_texts` gives them, 1 for toxic and 0 for clean.

    Copies count once. An entry is kept if the likelihood ratio for it being more frequent in toxic texts exceeds
    what chance gives among so many words, and its weight is at least ``LEAST_WEIGHT``. Terms with a neighbour word
    that ``LEAST_EXCUSES`` clean texts have and no toxic one are excused.

    Texts are read, and entries counted, where they lie. The driver gets some keys of each text to tell copies,
    the entries that occur in enough toxic texts to matter, the excused phrases, and two numbers for each text.
    Whole texts of any length are learned from.
    """
    spark = sample.sparkSession

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_keys(fold(t.as_py()).split()) for t in batch.column(1)]
            digests = [[zlib.crc32(k.encode()) << 32 | zlib.adler32(k.encode()) for k in ks] for ks in found]
            digests = [[d - (1 << 64) if d >> 63 else d for d in ds] for ds in digests]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(digests, pa.list_(pa.int64()))], ["doc_id", "label", "keys"]
            )

    kind = dict(sample.dtypes)["doc_id"]
    rows = sample.select("doc_id", "text", "label").mapInArrow(tidied(keys), f"doc_id {kind}, label int, keys array<long>")
    seen: set = set()
    taken = [r for r in sorted(rows.collect(), key=lambda r: r.doc_id) if _first(r["keys"], seen)]
    n1 = sum(r.label for r in taken)
    n0 = len(taken) - n1
    if not n1 or not n0:
        return Lexicon()
    ids = small_table(spark, [(r.doc_id,) for r in taken], f"doc_id {kind}")
    sample = written(sample.join(F.broadcast(ids), "doc_id"), "labelled")  # TOXIC_DOCS + CLEAN_DOCS rows at most
    counts = written(_by_class(sample, "entry", lambda f: _entries(set(f.split()))), "entries")
    words = counts.filter(F.col("entry").endswith(" ") & (F.col("t") + F.col("c") > 1)).count()
    # fewer toxic texts cannot pass the test, and a word of fewer cannot stand for a beginning that does
    least = math.log(max(2, words)) / math.log((n1 + n0) / n1) / 1.5
    found = {r.entry: (r.t, r.c) for r in counts.filter(F.col("t") >= max(1, math.floor(least))).collect()}
    lexicon = _lexicon(found, n1, n0, words)
    phrases = _by_class(sample, "phrase", _finder(lexicon))
    excused = phrases.filter((F.col("c") >= LEAST_EXCUSES) & (F.col("t") == 0)).select("phrase")
    lexicon.excused = sorted(r.phrase for r in excused.collect())

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            texts = [t.as_py() for t in batch.column(0)]
            x = [features(weight_of(automaton, fold(t)), t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([v[k] for v in x], pa.float64()) for k in (0, 1)), batch.column(1)], ["one", "two", "label"]
            )

    fit = sample.select("text", "label").mapInArrow(tidied(measured), "one double, two double, label int")
    fit = np.array(sorted(map(tuple, fit.collect())))
    lexicon.logistic = _logistic(fit[:, :2], fit[:, 2])
    return lexicon


def _finder(lexicon: Lexicon) -> Callable[[str], set[str]]:
    """``_phrases`` with an automaton that each task builds once."""
    built = []

    def find(folded: str) -> set[str]:
        if not built:
            built.append(lexicon.automaton())
        return _phrases(built[0], folded)

    return find


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.01, rounds: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton's method; both slopes are held at 0 or more."""
    beta, free = np.zeros(x.shape[1]), np.ones(x.shape[1], bool)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (y - p) - ridge * beta
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        beta[free] += np.linalg.solve(hessian[np.ix_(free, free)], gradient[free])
        low = (beta < 0) & (np.arange(len(beta)) > 0)
        beta[low], free = 0.0, free & ~low
    return beta


def chosen_texts(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", toxic: int = TOXIC_DOCS, clean: int = CLEAN_DOCS
) -> DataFrame:
    """``doc_id, text, label`` of at most so many labelled texts of each class: those with the smallest hash of their id.

    Learns from the given label rows only; rows without id or with a label other than 0 and 1 are
    left out, and so are ids without a text. An id counts once, with the least hash of its texts. The driver
    gets the ids of the sample.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label_col).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max(label_col).cast("int").alias("label"))
    )
    with_text = docs.select("doc_id", "text").filter(F.col("text").isNotNull())
    digest = F.xxhash64("text")
    # partial minima where the rows are read, so an id of many rows is one row for each task
    known = known.join(with_text.groupBy("doc_id").agg(F.min(digest).alias("digest")), "doc_id")
    order = [F.xxhash64(F.col("doc_id").cast("string")), "doc_id"]
    chosen = [
        (r.doc_id, value, r.digest)
        for value, most in ((1, toxic), (0, clean))
        for r in known.filter(F.col("label") == value).orderBy(*order).limit(most).collect()
    ]
    kind = dict(labels.dtypes)["doc_id"]
    ids = small_table(docs.sparkSession, chosen, f"doc_id {kind}, label int, digest long")
    return (
        with_text.withColumn("digest", digest)
        .join(F.broadcast(ids), ["doc_id", "digest"])  # TOXIC_DOCS + CLEAN_DOCS rows at most
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.min("label").alias("label"))
    )


def sample_of(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", toxic: int = TOXIC_DOCS, clean: int = CLEAN_DOCS
) -> list[tuple[str, int]]:
    """The texts and labels of :func:`chosen_texts` on the driver, for small tables."""
    texts = chosen_texts(docs, labels, label_col, toxic, clean)
    return [(text, label) for _, text, label in sorted(map(tuple, texts.collect()))]


def training_labels(labels: DataFrame, parts: int = 3, held_out: int = 1) -> DataFrame:
    """Label rows outside the part that is held out, by a checksum of the id."""
    return labels.filter(F.crc32(F.col("doc_id").cast("string")) % parts != held_out)


def _scorer(lexicon: Lexicon):
    """Function of a column of texts: scores and weights."""
    release()
    automaton, beta = lexicon.automaton(), np.array(lexicon.logistic)

    def score_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        weights, x = np.zeros(len(column)), np.zeros((len(column), 2))
        for i, value in enumerate(column):
            text = value.as_py() or ""
            weights[i] = weight_of(automaton, fold(text))
            x[i] = features(weights[i], text)
        if math.isinf(beta[0]):
            return np.zeros(len(column)), weights
        return 1 / (1 + np.exp(-np.clip(beta[0] + x @ beta[1:], -30, 30))), weights

    return score_of


def toxicity_scores(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.7) -> DataFrame:
    """``doc_id, score, predicted, weight`` of each whole text; only the text decides.

    No shuffle: the lexicon goes to the tasks; each of its entries occurs in several of the bounded sample's texts.
    A text is scored whole, in time linear in it and its matches, and at any place a word counts with its best
    entry, so ties change nothing. A null or empty text has weight 0; repeated rows are scored each; an empty
    table gives no rows; a lexicon learned from no or one-sided labels scores 0. Other columns are ignored.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score_of = _scorer(lexicon)
        for batch in batches:
            score, weights = score_of(batch.column(1))
            columns = [pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.array(weights)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], ["doc_id", "score", "predicted", "weight"]
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        tidied(scored), f"doc_id {kind}, score double, predicted int, weight double"
    )


def harmless(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.7) -> DataFrame:
    """The rows, all columns as they are, whose text scores below ``threshold``.

    See ``toxicity_scores``. The decision is taken where the row is read, so no text crosses the
    network. Null and empty texts stay unless the lexicon's base score is that high.
    """
    at = docs.columns.index("text")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score_of = _scorer(lexicon)
        for batch in batches:
            yield batch.filter(pa.array(score_of(batch.column(at))[0] < threshold))

    return docs.mapInArrow(tidied(kept), docs.schema)
