"""Whitening and source divergence against plain versions."""

import re
import sys
from collections import Counter, defaultdict
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import oracle

import __spark_entry__ as entry
from daygrain.llm import source_divergence, whitening

VECTORS = "vec_id long, embedding array<float>, label int, component string, deviation string, n string, size string, whitened string, i string"


def vector_rows(dimension=12, n=150, seed=2):
    draw = np.random.default_rng(seed)
    values = (draw.standard_normal((n, dimension)) * np.linspace(0.05, 2, dimension)).astype(np.float32)
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(values)]
    odd = [
        (900, None, 0), (901, [], 0), (902, [None] + [0.5] * (dimension - 1), 0), (903, [float("nan")] * dimension, 0),
        (904, [float("inf")] + [0.5] * (dimension - 1), 0), (905, [0.5] * (dimension + 1), 0), (906, [3e38] * dimension, 0),
        (None, rows[0][1], None), (0, rows[0][1], 0), (907, [0.0] * dimension, 0),
    ]
    return [(*r, *["x"] * 6) for r in [*rows, *odd]]


def test_whitening_equals_exact_arithmetic(spark):
    rows = vector_rows()
    got = whitening.whitened_components(spark.createDataFrame(rows, VECTORS).repartition(4), 8).collect()
    usable = [r for r in rows if r[1] and len(r[1]) == 12 and all(x is not None and abs(x) < 1e30 for x in r[1])]
    x = [[int(np.floor(1024 * float(c))) + 100000 for c in r[1]] for r in usable]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    centred = np.array([[float(Fraction(n * v - s, n)) for v, s in zip(row, sums)] for row in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    white = centred @ vectors / np.sqrt(values)
    assert len(got) == 8 * n and {r.n for r in got} == {n}
    assert Counter(r.vec_id for r in got) == Counter({r[0]: 0 for r in usable}) + Counter(8 * [r[0] for r in usable])
    deviations = defaultdict(set)
    for r, row in zip(usable, x):
        deviations[r[0]].add(sum((n * v - s) ** 2 for v, s in zip(row, sums)))
    signs = {}
    for k, r in enumerate(usable):
        for c in range(8):
            found = [g for g in got if g.vec_id == r[0] and g.component == c + 1]
            assert {g.deviation for g in found} == deviations[r[0]]
            sign = signs.setdefault(c, np.sign(found[0].whitened * white[k, c]))
            assert found[0].whitened == pytest.approx(sign * white[k, c], rel=1e-9, abs=1e-9)
            assert found[0].explained == pytest.approx(values[c] / values.sum(), rel=1e-12)
    (error,) = {r.identity_error for r in got}
    assert error < 1e-10


def test_whitening_without_variance_or_rows(spark):
    schema = "vec_id long, embedding array<double>"
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for table in (same, same.limit(0), spark.createDataFrame([(1, None)], schema)):
        found = whitening.whitened_components(table)
        assert found.columns == names and found.count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0]) for i in range(5)], schema)
    rows = whitening.whitened_components(line).collect()
    assert {r.component for r in rows} == {1} and {round(r.explained, 12) for r in rows} == {1.0}
    far = spark.createDataFrame([(i, [1e9 * i, 1e9 * (i % 2)]) for i in range(4)], schema)
    assert {r.deviation for r in whitening.whitened_components(far).collect()} == {None}


@pytest.mark.parametrize("shape", [(1, 1), (3, 3), (17, 17), (40, 9), (64, 64)])
def test_cholesky_and_rotations_give_the_eigenvalues(shape):
    size, rank = shape
    draw = np.random.default_rng(size)
    half = draw.standard_normal((size, rank)) * np.logspace(0, -4, rank)
    matrix = half @ half.T
    factor, order = whitening.pivoted_cholesky(matrix)
    assert factor.shape[1] <= rank + 1 and np.allclose(np.triu(factor[: factor.shape[1]], 1), 0)
    assert np.abs(factor @ factor.T - matrix[order][:, order]).max() < 1e-14 * matrix.max()
    values, vectors = whitening.eigen(matrix)
    want = np.linalg.eigvalsh(matrix)[::-1][: len(values)]
    assert np.abs(values - want).max() < 1e-14 * want[0]
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-12


def divergence(rows, least_docs, told):
    """Plain version: every term of the language for every pair."""
    docs = [(lang or "", source or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        here = [d for d in docs if d[0] == lang]
        seen = Counter(t for _, _, terms in here for t in set(terms))
        kept = {t for t, n in seen.items() if n >= least_docs}
        total = Counter(t for _, _, terms in here for t in terms if t in kept)
        groups = {s: Counter(t for _, source, terms in here for t in terms if source == s and t in kept) for _, s, _ in here}

        def share(counts, term):
            return 1 + 10**9 * (counts[term] + 2) // (sum(counts.values()) + 2 * len(kept))

        for s, counts in groups.items():
            pairs, terms = [], []
            for o, others in groups.items():
                if o != s:
                    pairs.append((sum((p - q) ** 2 // (p + q) for t in kept for p, q in [(share(counts, t), share(others, t))]), o))
            for t in counts:
                p, q = share(counts, t), share(total, t)
                if p > q:
                    terms.append(((p - q) ** 2 // (p + q), t))
            for part, found, most in (("pair", pairs, None), ("term", terms, told)):
                for rank, (value, item) in enumerate(sorted(found, key=lambda f: (-f[0], f[1].encode()))[:most], 1):
                    out.add((lang, s, part, item, value, rank))
    return out


def divergence_rows():
    draw = np.random.default_rng(4)
    words = ["the", "The", "naïve", "日本", "a", "b1c", "x-y", "ÉTÉ", "été", *(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90))]
    rows = []
    for i in range(260):
        source = [None, "", "s", "hot", "hot", *(f"s{k}" for k in range(20))][i % 25]
        share = draw.dirichlet(np.full(len(words), 0.2))
        rows.append((" ".join(draw.choice(words, draw.integers(0, 60), p=share)), ["en", "de", None][i % 3], source))
    return [*rows, (None, "en", "empty"), ("", "fr", "a"), ("one two", "fr", "b"), ("1 2 3", "fr", "c"), ("alone", "it", "x"), rows[0], rows[0]]


@pytest.mark.parametrize("block, tile, least_docs", [(32768, 16, 10), (7, 2, 3), (1, 1, 2)])
def test_divergence_equals_every_term_of_every_pair(spark, block, tile, least_docs):
    rows = divergence_rows()
    docs = spark.createDataFrame(
        [(i, *r, *["x"] * 9) for i, r in enumerate(rows)],
        "doc_id long, text string, lang string, source string, term string, n string, docs string, block string, ids string, "
        "value string, rank string, tile string, v string",
    )
    found = source_divergence.source_divergence(docs.repartition(3), least_docs, 10, block, tile).collect()
    assert len(found) == len(set(found))
    assert {tuple(r) for r in found} == divergence(rows, least_docs, 10)
    assert source_divergence.source_divergence(docs.limit(0)).count() == 0


def test_intersection_finds_all_common_numbers():
    draw = np.random.default_rng(1)
    for short, long in ((0, 5), (1, 1), (300, 100000), (5000, 5000), (700, 900)):
        a, b = (np.unique(draw.integers(0, 3 * long, k)) for k in (short, long))
        for x, y in ((a, b), (b, a)):
            i, j = source_divergence.intersection(x, y)
            assert (x[i] == y[j]).all() and x[i].tolist() == sorted(set(x.tolist()) & set(y.tolist()))


def test_shares_are_exact_for_very_large_counts():
    counts, divisor = [0, 7, 10**12, 3 * 10**14], 9 * 10**14
    assert source_divergence.shares(np.array(counts), divisor).tolist() == [1 + 10**9 * (c + 2) // divisor for c in counts]


def test_terms_of_long_texts_are_whole():
    text = ("Große Wörter-und " * 200_000).encode()
    assert [t for part in source_divergence.terms_of(text) for t in part] == source_divergence.TERM.findall(text.lower())


def test_registered_query_equals_its_sql(spark, sf_dir):
    name = "op12_source_divergence"
    df, sql, con = entry.queries()[name](spark, sf_dir), entry.oracle_sql()[name], oracle.connect(sf_dir)
    ours, theirs = oracle.schemas(df, con, sql)
    assert ours == theirs
    assert oracle.spark_table(df) == oracle.sql_table(con, sql)


def test_registered_whitening(spark, sf_dir):
    rows = entry.queries()["op11_whitening"](spark, sf_dir).collect()
    n = spark.read.parquet(f"{sf_dir}/embeddings.parquet").count()
    assert len(rows) == 8 * n and {r.n for r in rows} == {n} and max(r.identity_error for r in rows) < 1e-9
    white = np.zeros((n, 8))
    for r in rows:
        white[r.vec_id, r.component - 1] = r.whitened
    white -= white.mean(axis=0)
    assert np.abs(white.T @ white / n - np.eye(8)).max() < 1e-9
