"""Near duplicates, embeddings, components, toxicity, languages and the pipeline."""

import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import brute

from daygrain.llm import components, embedding_duplicates, language_id, near_duplicates, toxicity


@pytest.fixture(scope="module")
def documents():
    rows = brute.odd_documents()
    base = rows[6][1].split()
    more = []
    for i in range(40):  # near copies of one text at all distances around the threshold
        words = list(base)
        for k in range(0, i // 2 + 1):
            words[(7 * k + 3 * i) % len(words)] = f"w{i}x{k}"
        more.append((1000 + i, " ".join(words), *rows[3][2:]))
    return [*rows, *more]


def test_near_duplicates_equal_brute_force(spark, documents):
    docs = brute.frame(spark, documents)
    texts = {r[0]: r[1] for r in documents}
    for size in (4, 5):
        want = brute.near_groups(texts, size, 80)
        rows = near_duplicates.near_duplicates(docs, size, 80).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
        assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    assert len({c for _, c in want.values()}) < len(want)
    kept = near_duplicates.first_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in want.values()})


def test_near_duplicates_of_odd_rows(spark, documents):
    rows = [documents[6], documents[6], (None, documents[6][1], *documents[6][2:]), (None, None, *documents[6][2:])]
    got = near_duplicates.near_duplicates(brute.frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in got) == [
        ("18", "18", True), ("18", "18", True), ("None", "None", True), ("None", "None", True),
    ]
    assert near_duplicates.near_duplicates(brute.frame(spark, [])).count() == 0


def test_sketches_agree_as_often_as_sets_are_similar():
    draw = np.random.default_rng(3)
    a = np.unique(draw.integers(0, 1 << 62, 300).astype(np.uint64))
    for share in (0.5, 0.8, 0.95):
        cut = int(len(a) * share)
        b = np.r_[a[:cut], draw.integers(0, 1 << 62, len(a) - cut).astype(np.uint64)]
        sketch = near_duplicates.sketches(np.r_[a, b], np.repeat([0, 1], [len(a), len(b)]), 2, 768)
        assert (sketch != ~np.uint64(0)).all()
        assert (sketch[0] == sketch[1]).mean() == pytest.approx(cut / (2 * len(a) - cut), abs=0.06)
    one = near_duplicates.sketches(a[:1], np.zeros(1, np.int64), 2)
    assert (one[0] != ~np.uint64(0)).all() and (one[1] == ~np.uint64(0)).all()


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3), (140, 100)]
    got = {r.node: r.component_id for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 141)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_embedding_links_equal_brute_force(spark):
    draw = np.random.default_rng(5)
    centres = draw.standard_normal((6, 64))
    rows = []
    for i in range(240):
        v = centres[i % 6] + draw.standard_normal(64) * (0.02 + 0.16 * (i % 5) / 4)
        rows.append((i, [float(x) for x in v], i % 2))
    rows += [(300 + k, rows[k][1], rows[k][2]) for k in (0, 0, 1)]
    odd = [
        (400, None, 0), (401, [], 0), (402, [0.0] * 64, 0), (403, [float("nan")] * 64, 0), (404, rows[0][1], None),
        (405, [None, *rows[0][1][1:]], 0), (406, [float("inf")] * 64, 0), (407, [1.0, 2.0], 0),
    ]
    df = spark.createDataFrame([*rows, *odd], "vec_id long, embedding array<double>, label int").repartition(3)
    got = {}
    for r in embedding_duplicates.embedding_duplicates(df).collect():
        got.setdefault(r.vec_id, []).append(r)
    links, groups = {}, brute.Union({r[0] for r in rows})
    for i, (a, x, la) in enumerate(rows):
        links[i] = 0
        for j, (b, y, lb) in enumerate(rows):
            if i != j and la == lb and np.dot(x, y) >= 0.98 * np.linalg.norm(x) * np.linalg.norm(y):
                links[i] += 1
                groups.join(a, b)
    total = sum(links.values())
    assert total > 500
    assert sum(r.n_links for rs in got.values() for r in rs) >= 0.99 * total
    for i, (a, _, _) in enumerate(rows):
        assert all(r.n_links <= links[i] for r in got[a])
        assert {r.component_id for r in got[a]} == {groups.find(a)}
    for a, _, _ in odd:
        assert [(r.n_links, r.component_id, r.kept) for r in got[a]] == [(0, a, True)]
    assert embedding_duplicates.embedding_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("dimension", [16, 32, 64])
def test_recall_of_embedding_links_against_brute_force(spark, dimension):
    """Rows with ids divisible by 50 against all rows, for pairs just above the threshold."""
    draw = np.random.default_rng(dimension)
    base = draw.standard_normal((1500, dimension))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    rows = [base]
    for cosine in (0.9801, 0.981, 0.985):
        side = draw.standard_normal(base.shape)
        side -= (side * base).sum(axis=1, keepdims=True) * base
        side /= np.linalg.norm(side, axis=1, keepdims=True)
        rows.append(cosine * base + np.sqrt(1 - cosine**2) * side)
    vectors = np.stack(rows, axis=1).reshape(-1, dimension)
    df = spark.createDataFrame([(i, [float(x) for x in v], 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in embedding_duplicates.embedding_duplicates(df.repartition(4)).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    asked = np.arange(0, len(vectors), 50)
    want = (unit[asked] @ unit.T >= 0.98).sum(axis=1) - 1
    found = np.array([got[i] for i in asked])
    assert (found <= want).all() and want.sum() > 60
    assert found.sum() >= 0.99 * want.sum()


def test_a_bucket_of_many_vectors_is_compared_in_blocks(spark, monkeypatch):
    draw = np.random.default_rng(3)
    monkeypatch.setattr(embedding_duplicates, "BLOCK", 40)
    centre = draw.standard_normal(24)
    vectors = centre + draw.standard_normal((250, 24)) * 0.12
    schema = "vec_id long, embedding array<double>, label int, node string, bucket string, first string, code_0 string, visits string, copies string, links string"
    df = spark.createDataFrame([(i, [float(x) for x in v], 0, *["x"] * 7) for i, v in enumerate(vectors)], schema)
    got = {r.vec_id: r.n_links for r in embedding_duplicates.embedding_duplicates(df.repartition(3)).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.98).sum(axis=1) - 1
    assert sum(got.values()) >= 0.99 * want.sum() and all(got[i] <= want[i] for i in got) and want.sum() > 2000


def test_folding_undoes_disguises():
    assert toxicity.fold("IDIOT").split() == ["idiot"]
    assert toxicity.fold("1d10t").split() == ["idiot"]
    assert toxicity.fold("іdіоt").split() == ["idiot"]  # Cyrillic
    assert toxicity.fold("ｉｄｉｏｔ, id​iot").split() == ["idiot", "idiot"]
    assert toxicity.fold("café").split() == toxicity.fold("café").split() == ["café"]
    assert toxicity.fold("") == "  "


def _labelled(n=300):
    import random

    draw = random.Random(1)
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeo" for c in ("lan", "rim", "sut", "nop")]
    rows = []
    for i in range(n):
        text = [draw.choice(words) for _ in range(draw.randint(5, 60))]
        toxic = int(i % 3 == 0)
        if toxic:
            for _ in range(draw.randint(1, 3)):
                text.insert(draw.randint(0, len(text)), draw.choice(["vermin", "zorkel", "zorkan", "zorkish", "zorkum"]))
        elif i % 3 == 1:
            text += ["plain", "vermin", "control"]
        rows.append((" ".join(text), toxic))
    return rows


def test_a_lexicon_learns_words_stems_and_excuses():
    lexicon = toxicity.learn(_labelled())
    assert " zork" in lexicon.weights and not any(e.startswith(" plai") for e in lexicon.weights)
    automaton = lexicon.automaton()
    weigh = lambda t: toxicity.weight_of(automaton, toxicity.fold(t))
    assert weigh("balan Z0RKUM drim") > 3 and weigh("balan drim") == 0
    assert toxicity.learn([]).weights == {} and toxicity.learn([("a", 1)]).weights == {}


def test_only_copies_are_left_out_of_learning():
    import random

    draw = random.Random(7)
    words = [f"{a}{b}{c}{d}" for a in "bdfgk" for b in "aeo" for c in "lmnr" for d in ("im", "ut", "op", "as", "el")]
    for size in (1, 2, 3, 5, 8, 12, 40):
        texts = list({tuple(draw.choice(words) for _ in range(size)): None for _ in range(500)})
        seen = set()
        assert [list(t) for t in texts if toxicity._novel(list(t), seen)] == [list(t) for t in texts]
        assert not any(toxicity._novel(list(t), seen) for t in texts)
    long = [draw.choice(words) for _ in range(400)]
    seen = set()
    assert toxicity._novel(long, seen) and not toxicity._novel([*long, "more"], seen)
    assert toxicity._novel(long[:200] + [draw.choice(words) for _ in range(2000)], seen)  # shares a passage only


def test_a_lexicon_learns_from_short_texts():
    import random

    draw = random.Random(9)
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeo" for c in ("lan", "rim", "sut", "nop")]
    rows = []
    for i in range(300):
        text = [draw.choice(words) for _ in range(4)]
        if i % 3 == 0:
            text[draw.randrange(4)] = "zorkel"
        rows.append((" ".join(text), int(i % 3 == 0)))
    assert " zorkel " in toxicity.learn(rows).weights


def test_excused_phrases_cancel_a_term():
    lexicon = toxicity.Lexicon({" vermin ": 5.0}, [" vermin control "], (-2.0, 1.0, 1.0))
    automaton = lexicon.automaton()
    assert toxicity.weight_of(automaton, toxicity.fold("vermin control")) == 0
    assert toxicity.weight_of(automaton, toxicity.fold("vermin here")) == 5.0


def test_toxicity_of_held_out_and_odd_rows(spark, documents):
    rows = _labelled(600)
    lexicon = toxicity.learn(rows[:400])
    odd = brute.frame(spark, [(i, t, *documents[1][2:]) for i, (t, _) in enumerate(rows[400:])] + documents[:6])
    odd = odd.unionByName(odd.limit(1))
    got = toxicity.toxicity_scores(odd, lexicon).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    fresh = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows[400:])], "doc_id long, text string")
    hit = {r.doc_id: r.predicted for r in toxicity.toxicity_scores(fresh, lexicon).collect()}
    right = sum(hit[i] == label for i, (_, label) in enumerate(rows[400:]))
    assert right >= 0.9 * 200
    kept = toxicity.harmless(odd, lexicon)
    assert kept.columns == odd.columns
    assert kept.count() == sum(r.predicted == 0 for r in got)
    nothing = toxicity.toxicity_scores(brute.frame(spark, documents), toxicity.Lexicon()).collect()
    assert {(r.score, r.predicted) for r in nothing} == {(0.0, 0)}
    assert toxicity.toxicity_scores(brute.frame(spark, []), lexicon).count() == 0


def test_toxicity_sample_takes_label_rows_only(spark, documents):
    docs = brute.frame(spark, documents)
    labels = spark.createDataFrame([(3, 1), (3, 1), (18, 0), (None, 1), (21, None), (9999, 1)], "doc_id long, toxic int")
    texts = {r[0]: r[1] for r in documents}
    assert sorted(toxicity.sample_of(docs, labels)) == sorted([(texts[3], 1), (texts[18], 0)])
    assert toxicity.sample_of(docs, labels.limit(0)) == []


def test_learning_on_executors_equals_learning_on_the_driver(spark):
    rows = _labelled(600)
    rows[5] = (rows[5][0] + " plain words" * 40_000, rows[5][1])  # learned from as a whole
    rows += rows[:50]
    sample = spark.createDataFrame([(i, t, label) for i, (t, label) in enumerate(rows)], "doc_id long, text string, label int")
    one, two = toxicity.learn(rows), toxicity.learn_from(sample.repartition(4))
    assert one.weights == two.weights and one.excused == two.excused and one.weights
    assert one.logistic == pytest.approx(two.logistic, rel=1e-6)
    assert toxicity.learn_from(sample.limit(0)) == toxicity.Lexicon() == toxicity.learn_from(sample.filter("label = 1"))


def test_learning_makes_no_rdd_of_a_list(spark, monkeypatch):
    """Of a list Spark makes an RDD with Python workers of its own, which stay beside the others."""
    rows = [(i, t, label) for i, (t, label) in enumerate(_labelled(300))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int").cache()
    texts = docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id")).cache()
    want = toxicity.learn([(t, label) for _, t, label in rows])
    assert docs.count() == texts.count()
    monkeypatch.setattr(spark.sparkContext, "parallelize", None)
    for table in (docs, texts):  # ids of either kind
        sample = toxicity.chosen_texts(table, table.withColumnRenamed("label", "toxic"))
        assert dict(sample.dtypes)["doc_id"] == dict(table.dtypes)["doc_id"]
        assert set(toxicity.learn_from(sample).weights) == set(want.weights) != set()
    assert toxicity.chosen_texts(docs, docs.withColumnRenamed("label", "toxic").limit(0)).count() == 0


def test_a_text_of_many_terms_and_phrases_is_weighed_in_linear_time():
    import random
    import time

    draw = random.Random(2)
    lexicon = toxicity.Lexicon({" vermin ": 5.0, " zork": 4.0}, [" vermin control ", " control vermin ", " nice zorkel "], (-2.0, 1.0, 1.0))
    automaton = lexicon.automaton()
    words = [draw.choice(["vermin", "control", "zorkel", "nice", "balan"]) for _ in range(1500)]
    for size in (0, 1, 2, 50, 1500):
        folded = toxicity.fold(" ".join(words[:size]))
        best, spans = toxicity.hits(automaton, folded)
        plain = sum(w for at, w in best.items() if not any(a <= at < b for a, b in spans))
        assert toxicity.weight_of(automaton, folded) == plain
    start = time.perf_counter()
    toxicity.weight_of(automaton, toxicity.fold(" ".join(words * 500)))  # 5 MB
    assert time.perf_counter() - start < 10


def test_toxicity_sample_is_full_and_has_an_id_once(spark):
    long = "long " * 20_000
    rows = [(i, long if i < 40 else f"text {i}") for i in range(60)] + [(50, "text 50")] * 30 + [(51, "other")] * 30
    rows += [(i, None) for i in range(60, 90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(90)], "doc_id long, toxic int")
    few = toxicity.sample_of(docs, labels, toxic=10, clean=10)
    assert len(few) == 20 and sum(label for _, label in few) == 10
    got = toxicity.sample_of(docs, labels)
    assert sum(t == long for t, _ in got) == 40 and len(got) == 60  # long texts, too, and none without a text
    got = [(t, label) for t, label in got if t != long]
    want = [f"text {i}" for i in range(40, 60) if i != 51]
    assert sorted(t for t, _ in got if t not in ("text 51", "other")) == sorted(want)


def test_gradients_of_the_network():
    network = language_id.Network.start(["a", "b"], units=3, seed=2)
    data = np.frombuffer(b"hello wide world", np.uint8)
    starts, lengths = np.array([0, 6]), np.array([6, 4])
    left, _, active, _, _ = language_id._both_ways(data, starts, lengths)
    table, state = network.tables[0].astype(np.float64), network.states[0].astype(np.float64)
    pull = np.random.default_rng(0).standard_normal((6, 2, 3))
    pull[4:, 1] = 0

    def value(t, s):
        return float((language_id._run(left, active, t, s) * pull).sum())

    kept = []
    language_id._run(left, active, table, state, kept)
    d_table, d_state = language_id._back(left, table, state, kept, pull)
    for array, grad, other in ((table, d_table, 0), (state, d_state, 1)):
        at = np.unravel_index(np.argmax(np.abs(grad)), grad.shape)
        moved = array.copy()
        moved[at] += 1e-2
        less = array.copy()
        less[at] -= 1e-2
        high, low = (value(m, state) if other == 0 else value(table, m) for m in (moved, less))
        assert (high - low) / 2e-2 == pytest.approx(grad[at], rel=0.05)


def test_languages_are_told_apart_and_odd_texts_are_undetermined(spark, documents):
    import random

    draw = random.Random(4)
    sounds = {"xx": ["ka", "ri", "to", "mu"], "yy": ["sch", "ein", "ung", "ber"]}
    make = lambda la: " ".join("".join(draw.choice(sounds[la]) for _ in range(draw.randint(1, 3))) for _ in range(30))
    network = language_id.train([(la, make(la)[:96].encode()) for la in sounds for _ in range(120)], epochs=4)
    rows = [(i, make(la)) for i, la in enumerate(["xx", "yy"] * 20)]
    rows += [(100, None), (101, ""), (102, "42 !!"), (103, make("yy") * 200), (103, make("yy") * 200), (None, "kari")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({})
    got = [(r.doc_id, r.lang_pred, r.score) for r in language_id.languages(df, network).collect()]
    assert sum(p == ["xx", "yy"][i % 2] for i, p, _ in got if i is not None and i < 40) >= 39
    assert sorted((i, p, s) for i, p, s in got if i in (100, 101, 102)) == [(i, "und", 0.0) for i in (100, 101, 102)]
    assert [p for i, p, _ in got if i == 103] == ["yy", "yy"] and all(0 <= s <= 1 for *_, s in got)
    odd = brute.frame(spark, documents)
    kept = language_id.in_languages(odd, network)
    assert kept.columns == odd.columns and kept.count() <= odd.count()
    assert language_id.in_languages(odd, None).count() == odd.count()
    assert {r.lang_pred for r in language_id.languages(odd, None).collect()} == {"und"}
    assert language_id.languages(brute.frame(spark, []), network).count() == 0
    assert language_id.train([]) is None and language_id.training_sample(odd.limit(0)) == []


def test_least_score_follows_the_number_of_languages(spark):
    assert language_id.least_score(4) == pytest.approx(0.35)
    assert all(1 / k < language_id.least_score(k) < 1 for k in range(2, 500))
    unsure = language_id.Network.start(["a", "b"])
    unsure.head[:] = 0  # every text has score 0.5, which is chance
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    assert language_id.in_languages(docs, unsure).count() == 0
    unsure.bias[0] = 1
    assert language_id.in_languages(docs, unsure).count() == 1


def test_every_language_is_learned(spark):
    import random

    draw = random.Random(6)
    sounds = {
        f"l{i:02}": ["".join(draw.choice(part) for part in ("bcdfghklmnprstvz", "aeiou", "bdgklmnrst")) for _ in range(6)]
        for i in range(70)
    }
    make = lambda la: " ".join("".join(draw.choice(sounds[la]) for _ in range(2)) for _ in range(30))
    often = lambda la: 20 if la < "l64" else 12
    rows = [(f"{la}-{k}", make(la), la) for la in sounds for k in range(often(la))]
    docs = spark.createDataFrame(rows, "doc_id string, text string, lang string")
    sample = language_id.training_sample(docs)
    assert {la for la, _ in sample} == set(sounds)
    assert all(len(part) <= language_id.WINDOW for _, part in sample)
    assert language_id.units_for(4) == language_id.UNITS < language_id.units_for(70)
    network = language_id.train(sample, epochs=12)
    fresh = [(str(i), make(la)) for i, la in enumerate(sounds)]
    got = language_id.languages(spark.createDataFrame(fresh, "doc_id string, text string"), network).collect()
    right = {la for r in got if r.lang_pred == (la := list(sounds)[int(r.doc_id)])}
    assert len(right) >= 63 and len([la for la in right if la >= "l64"]) >= 5


def test_pipeline_stages_do_what_they_say(spark, sf_dir):
    import corpus_pipeline
    from daygrain.llm.tables import table, written

    docs = table(spark, sf_dir, "documents")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "language_id", "near_duplicates", "suffix_dedup", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        if name == "packing":
            assert {r.doc_id for r in docs.collect()} == set(before)
            break
        assert docs.columns == columns
        after = {r.doc_id: r for r in docs.collect()}
        if name == "suffix_dedup":
            want = brute.repeats({i: r.text for i, r in before.items()}, 100)
            assert {i: r.text for i, r in after.items()} == {i: w[3].decode(errors="ignore") for i, w in want.items()}
        else:
            assert all(before[i] == r for i, r in after.items())
        if name == "near_duplicates":
            want = brute.near_groups({i: r.text for i, r in before.items()}, 5, 80)
            assert set(after) == {c for _, c in want.values()}
        before = after


def test_first_stages_and_packing_equal_plain_scoring(spark, sf_dir):
    import math
    from collections import defaultdict

    import corpus_pipeline
    from daygrain.llm.queries import tokenizer
    from daygrain.llm.tables import table
    from tokenizers import Tokenizer

    larger = sf_dir.replace("sf0.001", "sf0.01")  # the smallest table with texts to reject
    docs = table(spark, larger, "documents")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    lexicon = toxicity.learn_from(toxicity.chosen_texts(docs, toxicity.training_labels(table(spark, larger, "labels"))))
    automaton, (base, of_sum, of_share) = lexicon.automaton(), lexicon.logistic

    def toxic(text):
        one, two = toxicity.features(toxicity.weight_of(automaton, toxicity.fold(text)), text)
        return 1 / (1 + math.exp(-(base + of_sum * one + of_share * two))) >= 0.7

    kept = corpus_pipeline.without_toxic(spark, docs, larger).collect()
    assert sorted(r.doc_id for r in kept) == sorted(i for i, t in texts.items() if not toxic(t))
    assert 0 < len(kept) < len(texts)

    docs = table(spark, sf_dir, "documents")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    odd = [(-1, ""), (-2, "42 !!"), (-3, None)]
    more = docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string"), allowMissingColumns=True)
    network = language_id.train(language_id.training_sample(more))
    least = language_id.least_score(len(network.languages))

    def explained(text):
        data = np.frombuffer((text or "").encode(), np.uint8)
        score = language_id.pooled(network, data, np.array([0, len(data)])).max()
        return any(c.isalpha() for c in text or "") and score >= least

    kept = corpus_pipeline.in_a_language(spark, more, sf_dir).collect()
    assert sorted(r.doc_id for r in kept) == sorted(i for i, t in [*texts.items(), *odd] if explained(t))
    assert not {-1, -2, -3} & {r.doc_id for r in kept}

    whole, pieces = Tokenizer.from_file(tokenizer("word_bpe_49k.json")), defaultdict(list)
    for r in corpus_pipeline.packed(spark, docs, sf_dir).collect():
        pieces[r.doc_id].append((r.start, r.length, r.ids))
    assert set(pieces) == set(texts)
    for i, found in pieces.items():
        ids = []
        for start, length, part in sorted(found):
            assert start == len(ids) and length == len(part)
            ids += part
        assert ids == [*whole.encode(texts[i], add_special_tokens=False).ids, 2]
