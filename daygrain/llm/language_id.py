"""Language of texts by a bidirectional gated recurrent network over bytes.

Two recurrences, one from each side, read the UTF-8 bytes; a linear layer on both states gives every
position a distribution over the languages, and a document has the mean of its positions. Trained
here in numpy by backpropagation through time on a bounded sample of labelled documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.byte_hash import text_parts
from daygrain.llm.word_table import tidied

#: Language of texts without a letter.
UNDETERMINED = "und"
#: Units of each recurrence for up to four languages; bytes that a recurrence runs over before it starts anew.
UNITS, SPAN = 8, 128
#: Documents of each language to learn from (on average), windows of each, and characters of a window.
PER_LANGUAGE, WINDOWS, WINDOW = 600, 2, 96
#: Passes over the samples, and steps at least: few samples are passed over more often.
EPOCHS, LEAST_STEPS = 8, 300
#: How far from chance to certainty a score is at least for a text to count as one of the learned languages.
LEAST_SCORE = 2 / 15


@dataclass
class Network:
    """``tables``: what a byte adds to the three gates, for both directions; ``states``: the recurrent weights."""

    languages: list[str]
    tables: np.ndarray  # 2 x 256 x 3 units
    states: np.ndarray  # 2 x units x 3 units
    head: np.ndarray  # 2 units x languages
    bias: np.ndarray  # languages

    @classmethod
    def start(cls, languages: list[str], units: int = UNITS, seed: int = 0) -> Network:
        rng = np.random.default_rng(seed)
        n = len(languages)
        return cls(
            languages,
            rng.normal(0, 0.3, (2, 256, 3 * units)).astype(np.float32),
            rng.normal(0, units**-0.5, (2, units, 3 * units)).astype(np.float32),
            rng.normal(0, units**-0.5, (2 * units, n)).astype(np.float32),
            np.zeros(n, np.float32),
        )

    @property
    def at_once(self) -> int:
        """Places that fit in memory at once: some 20 MB for states and distributions."""
        return (5 << 20) // (2 * self.states.shape[1] + len(self.languages))

    def weights(self) -> list[np.ndarray]:
        return [self.tables, self.states, self.head, self.bias]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _run(data: np.ndarray, active: np.ndarray, table: np.ndarray, state: np.ndarray, keep: list | None = None):
    """States (steps x rows x units) of one direction; row i takes part in the first steps only.

    ``data`` is steps x rows, ``active`` the number of rows of each step (rows are sorted by length).
    """
    steps, rows = data.shape
    units = state.shape[0]
    out = np.zeros((steps, rows, units), np.float32)
    h = np.zeros((rows, units), np.float32)
    for t in range(steps):
        n = active[t]
        a = np.take(table, data[t, :n], axis=0)
        u = h[:n] @ state
        gates = _sigmoid(a[:, : 2 * units] + u[:, : 2 * units])
        z, r = gates[:, :units], gates[:, units:]
        new = a[:, 2 * units :] + r * u[:, 2 * units :]
        np.tanh(new, out=new)
        if keep is not None:
            keep.append((n, h[:n].copy(), z, r, new, u[:, 2 * units :]))
        h[:n] = new + z * (h[:n] - new)
        out[t, :n] = h[:n]
    return out


def _back(data, table, state, keep, grad) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of ``table`` and ``state`` from those of the states, walking the steps backwards."""
    d_table, d_state = np.zeros_like(table), np.zeros_like(state)
    dh = np.zeros((data.shape[1], state.shape[0]), np.float32)
    for t in range(len(keep) - 1, -1, -1):
        n, before, z, r, new, u = keep[t]
        d = dh[:n] + grad[t, :n]
        d_new = d * (1 - z) * (1 - new * new)
        d_z = d * (before - new) * z * (1 - z)
        d_r = d_new * u * r * (1 - r)
        d_u = np.concatenate([d_z, d_r, d_new * r], axis=1)
        np.add.at(d_table, data[t, :n], np.concatenate([d_z, d_r, d_new], axis=1))
        d_state += before.T @ d_u
        dh[:n] = d * z + d_u @ state.T
    return d_table, d_state


def _both_ways(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """Bytes by step and row from the left and from the right, active rows, and validity of each place.

    Rows must be sorted by length, the longest first.
    """
    steps = int(lengths[0]) if len(lengths) else 0
    t = np.arange(steps)[:, None]
    valid = t < lengths[None, :]
    last = max(0, len(data) - 1)
    left = data[np.minimum(starts[None, :] + t, last)]
    right_at = np.maximum(lengths[None, :] - 1 - t, 0)
    right = data[np.minimum(starts[None, :] + right_at, last)]
    return left, right, valid.sum(axis=1), valid, right_at


def _flip(states: np.ndarray, right_at: np.ndarray) -> np.ndarray:
    """States by step from the right, put at their place from the left (or the other way round)."""
    return np.take_along_axis(states, right_at[:, :, None], axis=0)


def _distribution(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=-1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=-1, keepdims=True)
    return logits


def positions(network: Network, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """Distribution of every place of spans of bytes, and which places are valid; longest spans first."""
    units = network.states.shape[1]
    left, right, active, valid, right_at = _both_ways(data, starts, lengths)
    forward = _run(left, active, network.tables[0], network.states[0])
    backward = _flip(_run(right, active, network.tables[1], network.states[1]), right_at)
    logits = forward @ network.head[:units] + backward @ network.head[units:] + network.bias
    return _distribution(logits), valid


def pooled(network: Network, data: np.ndarray, bounds: np.ndarray, span: int = SPAN) -> np.ndarray:
    """Mean distribution over the places of each text; a text without bytes has zeros."""
    sizes = np.diff(bounds)
    pieces = -(-sizes // span)
    row = np.repeat(np.arange(len(sizes)), pieces)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = bounds[:-1][row] + nth * span
    lengths = np.minimum(span, sizes[row] - nth * span)
    total = np.zeros((len(sizes), len(network.languages)))
    order = np.argsort(-lengths, kind="stable")
    at_once = max(1, network.at_once // span)
    for first in range(0, len(order), at_once):
        at = order[first : first + at_once]
        found, valid = positions(network, data, starts[at], lengths[at])
        found[~valid] = 0
        np.add.at(total, row[at], found.sum(axis=0))
    return total / np.maximum(sizes, 1)[:, None]


def units_for(languages: int) -> int:
    """Units of each recurrence, growing with the square root of the languages to tell apart."""
    return max(UNITS, math.ceil(UNITS * math.sqrt(languages / 4)))


def train(
    samples: list[tuple[str, bytes]], units: int | None = None, epochs: int = EPOCHS, batch: int = 128, rate: float = 0.02, seed: int = 0
) -> Network | None:
    """A network from windows of bytes and their language; None without samples.

    Without ``units`` there are ``units_for`` as many as there are languages. Samples are passed over
    ``epochs`` times, and as often as makes ``LEAST_STEPS`` steps, so that a small table is learned too.
    """
    samples = [(language, data) for language, data in samples if data]
    if not samples:
        return None
    epochs = max(epochs, math.ceil(LEAST_STEPS / -(-len(samples) // batch)))
    languages = sorted({language for language, _ in samples})
    units = units or units_for(len(languages))
    network = Network.start(languages, units, seed)
    index = {language: i for i, language in enumerate(languages)}
    number = np.array([index[language] for language, _ in samples])
    sizes = np.array([len(data) for _, data in samples])
    joined = np.frombuffer(b"".join(data for _, data in samples), np.uint8)
    begins = np.cumsum(sizes) - sizes
    share = np.bincount(number, minlength=len(languages)) / len(number)
    weight = 1 / (len(languages) * share)
    rng = np.random.default_rng(seed)
    weights = network.weights()
    first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
    step, steps = 0, epochs * -(-len(samples) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(samples))
        for start in range(0, len(order), batch):
            at = order[start : start + batch]
            at = at[np.argsort(-sizes[at], kind="stable")]
            left, right, active, valid, right_at = _both_ways(joined, begins[at], sizes[at])
            kept: tuple[list, list] = ([], [])
            forward = _run(left, active, network.tables[0], network.states[0], kept[0])
            backward = _flip(_run(right, active, network.tables[1], network.states[1], kept[1]), right_at)
            both = np.concatenate([forward, backward], axis=2)
            grad = _distribution(both @ network.head + network.bias)
            grad[:, np.arange(len(at)), number[at]] -= 1
            grad *= (valid * weight[number[at]] / valid.sum())[:, :, None]
            grad = grad.astype(np.float32)
            d_head = both.reshape(-1, 2 * units).T @ grad.reshape(-1, len(languages))
            d_both = grad @ network.head.T
            d_right = _flip(d_both[:, :, units:], right_at)
            one = _back(left, network.tables[0], network.states[0], kept[0], d_both[:, :, :units])
            two = _back(right, network.tables[1], network.states[1], kept[1], d_right)
            grads = [np.stack([one[0], two[0]]), np.stack([one[1], two[1]]), d_head, grad.sum(axis=(0, 1))]
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            step += 1
            now = rate * min(1.0, step / 20) * (1 - step / (steps + 1))
            for w, g, m, v in zip(weights, grads, first, second, strict=True):
                g = g * min(1.0, 1.0 / (norm + 1e-9))
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return network


def training_sample(docs: DataFrame, parts: int = 4, held_out: int = 2, per_language: int = PER_LANGUAGE) -> list[tuple[str, bytes]]:
    """Windows of labelled documents outside the held-out part, of every language among them.

    About ``per_language`` documents of each language, those whose id hashes below a bound that is set
    by the language's number of documents, and ``WINDOWS`` windows of ``WINDOW`` characters of each, at
    places set by the hash. Only these windows reach the driver, so what it gets and the time to learn
    grow with the number of languages.
    """
    known = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).filter(
        F.col("lang").isNotNull()
        & (F.col("lang") != UNDETERMINED)
        & F.col("text").rlike(r"\p{L}")
        & (F.crc32(F.col("doc_id").cast("string")) % parts != held_out)
    )
    bounds = known.groupBy("lang").agg((F.lit(per_language) / F.count("*")).alias("bound"))
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30)) / (1 << 30)
    # a row for each language
    chosen = known.join(F.broadcast(bounds), "lang").filter(place < F.col("bound"))
    windows = []
    for k in range(WINDOWS):
        room = F.greatest(F.length("text") - WINDOW, F.lit(0)) + 1
        at = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(k)), room.cast("long")).cast("int") + 1
        windows.append(F.substr("text", at, F.lit(WINDOW)))
    rows = chosen.select("lang", "doc_id", F.array(*windows).alias("windows")).collect()
    return [(lang, w.encode()) for lang, _, found in sorted(map(tuple, rows)) for w in found]


def _lettered():
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def _predict(network: Network | None, texts: pa.Array, lettered: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Predicted language and score of each text of a column."""
    names = np.array([*(network.languages if network else []), UNDETERMINED], object)
    lettered = lettered.to_numpy(zero_copy_only=False).astype(bool)
    best, score = np.full(len(texts), len(names) - 1), np.zeros(len(texts))
    if network:
        for first, last, data, bounds in text_parts(texts):
            found, part = pooled(network, data, bounds), slice(first, last)
            best[part] = np.where(lettered[part], found.argmax(axis=1), best[part])
            score[part] = np.where(lettered[part], np.clip(found.max(axis=1), 0, 1), 0.0)
    return names[best], score


def languages(docs: DataFrame, network: Network | None) -> DataFrame:
    """``doc_id, lang_pred, score`` of each whole text; only the text decides.

    ``score`` is the mean probability of the predicted language over all bytes. No shuffle; the network
    of a few thousand numbers goes to the tasks. A null text or one without a letter is ``und`` with
    score 0, and so is every text if nothing was learned. A very long text is read whole, some spans at a time; of
    equally likely languages the first by name counts. Repeated rows are predicted each; an empty
    table gives no rows. Other columns are ignored.
    """

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named, score = _predict(network, batch.column(1), batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(named, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"]
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text", _lettered().alias("lettered")).mapInArrow(
        tidied(predicted), f"doc_id {kind}, lang_pred string, score double"
    )


def least_score(languages: int, above_chance: float = LEAST_SCORE) -> float:
    """Bound on the score of the best of so many languages: 0.35 for four, never at or below chance."""
    return 1 / languages + above_chance * (1 - 1 / languages)


def in_languages(docs: DataFrame, network: Network | None, least: float | None = None) -> DataFrame:
    """The rows, all columns as they are, whose text has a language with a score of at least ``least``.

    Without ``least`` it is ``least_score`` of the number of learned languages. See ``languages``: texts
    that are null or without a letter go, and those that no learned language explains better than
    chance. A network of one language gives every text with a letter score 1, so it rejects none of
    them. The decision is taken where the row is read. If nothing was learned every row stays.
    """
    at, columns = docs.columns.index("text"), docs.columns

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named, score = _predict(network, batch.column(at), batch.column(len(columns)))
            keep = (named != UNDETERMINED) & (score >= least)
            yield pa.RecordBatch.from_arrays(batch.columns[: len(columns)], columns).filter(pa.array(keep.astype(bool)))

    if network is None:
        return docs
    least = least_score(len(network.languages)) if least is None else least
    # the added column is taken by its place, so no name can clash with it
    return docs.select("*", _lettered()).mapInArrow(tidied(kept), docs.schema)
