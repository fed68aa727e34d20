"""Token, fingerprint, sharding and packing operators against brute force and the libraries."""

import sys
import zlib
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import brute

public_tokenizers = pytest.importorskip("public_tokenizers")

from daygrain.llm import fingerprints, packing, sentencepiece_codec, sharding, suffix_dedup, token_counts  # noqa: E402

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def documents():
    return brute.odd_documents()


@pytest.fixture(scope="module")
def texts(documents):
    return {r[0]: r[1] for r in documents}


@pytest.fixture(scope="module")
def docs(spark, documents):
    return brute.frame(spark, documents).cache()


@pytest.fixture(scope="module")
def odd(spark, documents):
    """With a repeated row, two texts of one id, and null ids."""
    rows = [*documents, documents[8], (documents[9][0], "another text", *documents[9][2:])]
    return brute.frame(spark, [*rows, (None, "no id", *documents[1][2:]), (None, None, *documents[1][2:])]).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return brute.frame(spark, [])


def removed(frame, **options):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeated(frame, **options).collect()}


def plain_removed(texts):
    return {i: (*w[:3], brute.sha256(w[3])) for i, w in brute.repeats(texts, 100).items()}


@pytest.mark.parametrize("anchors", [(48, 88), (24,), (100, 100, 100)])
@pytest.mark.parametrize("per_bucket", [None, 500])
def test_suffix_dedup_equals_brute_force(docs, texts, anchors, per_bucket):
    want = plain_removed(texts)
    assert removed(docs, anchors=anchors, per_bucket=per_bucket) == want
    assert sum(w[1] for w in want.values()) > 0


def test_suffix_dedup_of_an_anchor_with_thousands_of_contexts(spark):
    """One passage between different words, copies of one text, and a string that fills whole buckets."""
    draw = np.random.default_rng(6)
    word = lambda: "".join(draw.choice(list("abcdefgh "), 30))
    passage, copy = "the same sixty bytes stand here in every one of the documents.", " ".join(word() for _ in range(20))
    texts = {i: f"{word()} {passage} {word()}" for i in range(5000)}
    texts |= {10_000 + i: copy for i in range(300)} | {20_000 + i: "=" * 150 for i in range(200)}
    frame = brute.frame(spark, [(i, t, *brute.odd_documents()[0][2:]) for i, t in texts.items()], 4)
    assert removed(frame, per_bucket=60_000) == plain_removed(texts)


def test_suffix_dedup_takes_one_python_worker_a_task(docs, monkeypatch):
    import re

    seen, write = [], suffix_dedup.written
    monkeypatch.setattr(
        suffix_dedup, "written", lambda df, name: (seen.append(df._jdf.queryExecution().optimizedPlan().toString()), write(df, name))[1]
    )
    for anchors in ((48, 88), (24,)):
        last = suffix_dedup.remove_repeated(docs, anchors=anchors)
        for plan in [*seen, last._jdf.queryExecution().optimizedPlan().toString()]:
            # from the last step down to the table: what lies between two functions in Python is a shuffle
            steps = re.findall("MapInArrow|RepartitionByExpression|Join|Relation", plan)
            assert ("MapInArrow", "MapInArrow") not in zip(steps, steps[1:], strict=False)
    assert len(seen) == 7


def test_open_runs_of_many_texts_travel_together(spark):
    import pyarrow as pa

    runs = pa.array([[{"start": 0, "n": 2}, {"start": 5, "n": 1}]] * 50, pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32())])))
    texts = [f"{k:03d} " + "abcdefghij" * 12 for k in range(50)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(50), pa.int64()), pa.array([7] * 50, pa.int64()), pa.array(texts), runs], ["doc", "check", "text", "runs"])
    out = list(suffix_dedup._contents(100)(iter([batch, batch.slice(0, 0)])))
    assert len(out) == 1
    want = [(k, 7 << 32 | at, texts[k].encode()[at : at + n + 99]) for k in range(50) for at, n in ((0, 2), (5, 1))]
    assert list(zip(*(c.to_pylist() for c in out[0].columns), strict=True)) == want


def test_suffix_dedup_of_few_long_documents(spark):
    """Texts beyond what is handled at once, with shared passages across the cuts."""
    draw = np.random.default_rng(8)
    words = ["".join(draw.choice(list("abcdefgh"), draw.integers(2, 9))) for _ in range(3000)]
    long = [" ".join(draw.choice(words, 18_000)) for _ in range(18)]
    long += [long[0][5000:] + long[1], " ".join(draw.choice(words, 150_000))]
    long[3] = long[3][:60_000] + long[19][400_000:500_000] + long[3][60_000:]
    assert len(long[19]) > 3 * (1 << 18)
    texts = dict(enumerate(long))
    frame = brute.frame(spark, [(i, t, *brute.odd_documents()[0][2:]) for i, t in texts.items()], 4)
    assert removed(frame) == plain_removed(texts)


def test_suffix_dedup_keeps_columns_and_takes_odd_rows(docs, odd, empty, texts):
    cut = suffix_dedup.without_repeats(docs)
    assert cut.columns == docs.columns and cut.dtypes == docs.dtypes
    want = brute.repeats(texts, 100)
    for r in cut.collect():
        assert r.text == (None if texts[r.doc_id] is None else want[r.doc_id][3].decode(errors="ignore"))
        assert r.n_chars == (None if r.text is None else len(r.text)) and r.label.startswith("x")
    assert suffix_dedup.remove_repeated(odd).count() == odd.count()
    assert suffix_dedup.remove_repeated(empty).count() == 0 and suffix_dedup.without_repeats(empty).count() == 0


def test_multikey_order_sorts_by_all_words():
    draw = np.random.default_rng(0)
    for n in (1, 2, 7, 50, 200):
        words = [draw.integers(0, 3, n).astype(np.uint64) for _ in range(5)]
        got = suffix_dedup.multikey_order(words)
        assert (np.stack(words)[:, got] == np.stack(words)[:, np.lexsort(words[::-1])]).all()


def test_shards_differ_by_one_row_and_slots_have_no_gaps(odd, empty):
    rows = sharding.hilbert_shards(odd, shards=7).collect()
    sizes = [sum(r.shard == s for r in rows) for s in range(7)]
    assert len(rows) == odd.count() and max(sizes) - min(sizes) <= 1
    for s in range(7):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    again = sharding.hilbert_shards(odd.repartition(5), shards=7).collect()
    place = lambda rs: sorted((str(r.doc_id), r.text_crc32, r.shard) for r in rs)
    assert place(rows) == place(again)
    assert len({r.shard for r in sharding.hilbert_shards(odd.limit(3), shards=7).collect()}) == 3
    assert sharding.hilbert_shards(empty).count() == 0


def test_filters_touch_few_shards(spark, sf_dir):
    """Bounds by shard: how many shards a reader opens that wants a language, a source or large texts."""
    docs = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/documents.parquet")
    placed = sharding.hilbert_shards(docs, shards=40).join(docs.select("doc_id", "lang", "source"), "doc_id").toPandas()
    touched = lambda rows: rows["shard"].nunique()
    share = placed["lang"].value_counts(normalize=True)
    for lang, rows in placed.groupby("lang"):
        assert touched(rows) <= (15 if share[lang] < 0.5 else 40 * share[lang] + 3)
    assert all(touched(rows) <= 15 for _, rows in placed.groupby("source"))
    for low, high in ((0, 0.1), (0.9, 1)):
        between = placed["size"].between(placed["size"].quantile(low), placed["size"].quantile(high))
        assert touched(placed[between]) <= 15


def test_names_take_cells_by_their_rows():
    cells = sharding.name_cells([("a", 50), (None, 30), ("b", 15), ("c", 5)], 100, 6)
    assert cells == {"a": 0, None: 32, "b": 51, "c": 60}
    assert max(sharding.name_cells([(str(i), 1) for i in range(63)], 10_000, 6).values()) == 0
    assert sharding.name_cells([], 0, 6) == {}


def test_hilbert_curve_visits_neighbours():
    side = 1 << 3
    grid = np.stack(np.meshgrid(*[np.arange(side)] * 3, indexing="ij")).reshape(3, -1)
    index = sharding.hilbert_index(grid, 3)
    assert sorted(index) == list(range(side**3))
    path = grid[:, np.argsort(index)]
    assert (np.abs(np.diff(path, axis=1)).sum(axis=0) == 1).all()


@pytest.mark.parametrize("few", [False, True])
def test_fingerprints_of_edited_texts(docs, texts, few, monkeypatch):
    if few:  # buckets of few rows, empty ones among them, in runs of two
        monkeypatch.setattr(fingerprints, "tasks_for", lambda size: 29)
        monkeypatch.setattr(fingerprints, "BOUNDS", 7)
        monkeypatch.setattr(fingerprints, "TOGETHER", 2)
    rows = {r.doc_id: r for r in fingerprints.edited_fingerprints(docs).collect()}
    ids = sorted(texts)
    assert sorted(rows) == ids
    for i, after in zip(ids, [*ids[1:], ids[0]], strict=True):
        text, new = texts[i] or "", texts[after] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + new[:half]
        r, one, two, three = rows[i], brute.plain_sketch(text), brute.plain_sketch(edited), brute.plain_sketch(new)
        assert r.n_chars == len(text) and r.edited_sha256 == brute.sha256(edited)
        assert (r.fingerprint, r.edited_fingerprint) == (brute.plain_print(one), brute.plain_print(two))
        assert r.near_edited == pytest.approx(brute.plain_near(one, two, text == edited))
        assert r.near_next == pytest.approx(brute.plain_near(one, three, text == new))
        assert r.contained_edited == (pytest.approx(len(set(one) & set(two)) / len(one)) if one else None)
    long = max(texts, key=lambda i: len(texts[i] or ""))
    assert 120 < len(brute.plain_sketch(texts[long])) < 260  # a sixteenth of 2996 shingles
    assert len(rows[long].fingerprint) < 0.1 * len(texts[long])


def test_fingerprints_of_odd_rows(docs, odd, empty):
    assert fingerprints.edited_fingerprints(odd).count() == odd.count()
    assert fingerprints.edited_fingerprints(empty).count() == 0
    alone = fingerprints.edited_fingerprints(docs.filter("doc_id = 18")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0
    twice = docs.filter("doc_id = 18").unionByName(docs.filter("doc_id = 18"))
    rows = fingerprints.edited_fingerprints(twice).collect()
    assert len(rows) == 2 and rows[0] == rows[1] and rows[0].near_next == 1.0  # repeated by value


def test_buckets_follow_one_another_across_runs(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "TOGETHER", 3)
    for present in ([5], [0, 1, 2, 3, 4, 5, 6], [2, 9, 10, 11, 30, 31, 90]):
        df = spark.createDataFrame([(b,) for b in present], "bucket int").repartition(3)
        got = {r.bucket: r.after for r in fingerprints._next_buckets(df).collect()}
        assert got == dict(zip(present, [*present[1:], present[0]], strict=True))


def test_sketches_merge_in_any_order_and_tell_containment(spark):
    from pyspark.sql import functions as F

    draw = np.random.default_rng(2)
    words = [f"w{i}" for i in range(3000)]
    whole = [draw.choice(words) for _ in range(9000)]
    short = whole[4000:5500]
    parts = [" ".join(whole[i : i + 1004]) for i in range(0, 8996, 1000)]  # cut so that no shingle is lost
    df = spark.createDataFrame([(0, p) for p in parts] + [(1, "")], "g int, text string").repartition(4)
    df = df.withColumn("sketch", fingerprints.sketch(F.col("text")))
    got = {r.g: r.sketch for r in fingerprints.merge_sketches(df, ["g"]).collect()}
    assert got == {0: brute.plain_sketch(" ".join(whole)), 1: []}
    two = spark.createDataFrame([(" ".join(short), " ".join(whole), parts[0], parts[1])], "a string, b string, c string, d string")
    a, b, c, d = (fingerprints.sketch(F.col(x)) for x in "abcd")
    row = two.select(fingerprints.containment(a, b).alias("inside"), fingerprints.containment(b, a).alias("share"),
                     fingerprints.merged(c, d).alias("cd"), fingerprints.merged(d, c).alias("dc"), fingerprints.likeness(a, b).alias("near")).first()
    assert row.inside == 1.0 and row.share == pytest.approx(1 / 6, abs=0.05) and row.near == pytest.approx(1 / 6, abs=0.05)
    assert row.cd == row.dc == sorted(set(brute.plain_sketch(parts[0])) | set(brute.plain_sketch(parts[1])))


def test_sentencepiece_codes_equal_the_library(odd, empty, texts):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = sentencepiece_codec.sentencepiece_codes(odd, PIECES).collect()
    assert len(rows) == odd.count()
    for r in rows:
        if r.doc_id is not None and r.doc_id != 27:
            ids = library.encode(texts[r.doc_id] or "")
            assert (r.n_tokens, r.ids, r.decoded) == (len(ids), ids, library.decode(ids))
    digest = {r.doc_id: r for r in sentencepiece_codec.sentencepiece_codes(odd, PIECES, digest=True).collect()}
    ids = library.encode(texts[18])
    assert digest[18].ids_sha256 == brute.sha256(",".join(map(str, ids)))
    assert digest[18].decoded_sha256 == brute.sha256(texts[18])
    assert sentencepiece_codec.sentencepiece_codes(empty, PIECES).count() == 0


def test_packed_pieces_hold_every_id_once(odd, empty, documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    size = 128
    rows = packing.pack_documents(odd, WORDS, size=size, most_open=2, merged_partitions=2).collect()
    want = sorted(
        library.encode(r.text or "", add_special_tokens=False).ids + [2] for r in odd.select("text").collect()
    )
    whole = [p for p in rows if p.doc_id is not None and p.doc_id not in (24, 27)]
    texts = {r[0]: r[1] for r in documents}
    for i in {p.doc_id for p in whole}:
        pieces = sorted((p for p in whole if p.doc_id == i), key=lambda p: p.start)
        ids = [x for p in pieces for x in p.ids]
        assert ids == library.encode(texts[i] or "", add_special_tokens=False).ids + [2]
        assert [p.start for p in pieces] == [sum(q.length for q in pieces[:k]) for k in range(len(pieces))]
    assert sum(p.length for p in rows) == sum(map(len, want))
    for s in {p.sequence_id for p in rows}:
        pieces = sorted((p for p in rows if p.sequence_id == s), key=lambda p: p.offset)
        assert [p.offset for p in pieces] == [sum(q.length for q in pieces[:k]) for k in range(len(pieces))]
        assert sum(p.length for p in pieces) <= size
    digest = packing.pack_documents(odd.filter("doc_id = 18"), WORDS, with_ids=False).collect()
    ids = library.encode(texts[18], add_special_tokens=False).ids + [2]
    assert digest[0].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
    assert packing.pack_documents(empty, WORDS).count() == 0


def test_copies_are_read_in_small_batches(spark, monkeypatch):
    from daygrain.llm import tables

    key, seen, write = "spark.sql.parquet.columnarReaderBatchSize", [], tables.sinks.write_table
    monkeypatch.setattr(tables.sinks, "write_table", lambda *a: (seen.append(int(spark.conf.get(key))), write(*a)))
    before = spark.conf.get(key)
    assert tables.written(spark.range(5), "small").count() == 5
    assert seen == [1024] and spark.conf.get(key) == before


def test_counts_equal_a_unigram_tokenizer(odd, empty, texts):
    from tokenizers import Tokenizer
    from tokenizers.models import Unigram

    pieces = token_counts.model_pieces(PIECES)
    vocabulary = [("<unk>", 0.0), *[(f"<0x{b:02X}>", 0.0) for b in range(256)], *pieces]
    library = Tokenizer(Unigram(vocabulary, unk_id=0, byte_fallback=True))
    for r in token_counts.unigram_token_counts(odd, PIECES).collect():
        if r.doc_id is not None and r.doc_id != 27:
            text = texts[r.doc_id] or ""
            marked = "▁" + text.replace(" ", "▁") if text else ""
            assert r.n_tokens == len(library.encode(marked).ids), text[:40]
    assert token_counts.unigram_token_counts(empty, PIECES).count() == 0


def test_ties_go_to_the_longest_last_piece():
    unigram = token_counts.Unigram([("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0)])
    assert unigram.best("ab") == (1, -2.0)
    assert unigram.best("aba") == (2, -3.0)
    assert unigram.best("") == (0, 0.0)
    assert unigram.best("é")[0] == 2  # the bytes of a character without a piece


ALPHABET = " \n\t abéÉ🙂.,1'ſtsİΣσ\u0301\u00a0\u3000-中d<|ªº²ⅷßŉǰΐ\u212bﬁ\u0958▁0x>\u0000"


def _random_texts(n):
    import random

    draw = random.Random(11)
    return ["".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, 14))) for _ in range(n)]


def test_word_ids_of_random_texts_equal_the_library():
    words = packing.WordIds(WORDS)
    texts = [*_random_texts(3000), "a<|endoftext|>b.", "<|startoftext|>, x"]
    coded = words.library.encode_batch(texts, add_special_tokens=False)
    for text, one, ids in zip(texts, coded, words(texts), strict=True):
        assert np.array(one.ids, "<u4").tobytes() == ids, repr(text)


def test_codes_of_random_texts_equal_the_library():
    codec = sentencepiece_codec.Codec(PIECES)
    for text in _random_texts(3000):
        ids = codec.library.encode(text)
        assert codec(text) == (len(ids), ",".join(map(str, ids)), codec.library.decode(ids)), repr(text)


def test_known_words_take_few_bytes_and_no_call_each():
    import cProfile
    import itertools
    import pstats
    import tracemalloc

    import pyarrow as pa

    distinct = list(map("".join, itertools.product("bdfglmnprt", "aeiou", "bdfglmnprt", "aeiou", "st")))
    text = pa.array([" ".join(distinct), " ".join(w.title() + "." for w in distinct)], pa.large_string())
    words = packing.WordIds(WORDS)
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    seen, calls = [], cProfile.Profile()
    calls.enable()
    seen += map(zlib.crc32, words(text))
    calls.disable()
    held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert held < 100 * len(distinct)
    assert pstats.Stats(calls).total_calls < len(distinct)
    library = words.library.encode_batch(text.to_pylist(), add_special_tokens=False)
    assert seen == [zlib.crc32(np.array(one.ids, "<u4").tobytes()) for one in library]


def test_forgotten_words_are_learned_again(monkeypatch):
    words = packing.WordIds(WORDS)
    monkeypatch.setattr(packing, "WORDS", 40)
    monkeypatch.setattr(packing, "KEPT", 20)
    monkeypatch.setattr(packing, "TEXTS", 2)
    texts = _random_texts(400)
    coded = words.library.encode_batch(texts, add_special_tokens=False)
    assert list(words(texts)) == [np.array(one.ids, "<u4").tobytes() for one in coded]
    assert len(words.strings) <= 40
    long = ["中" * n for n in range(2000, 2100)]
    assert len({ids for ids in words(long)}) == 100
    assert words.strings.nbytes < 3 * 2100 * 4


def test_full_tables_start_anew(monkeypatch):
    words = packing.WordIds(WORDS)
    monkeypatch.setattr(packing, "WORDS", 5)
    monkeypatch.setattr(packing, "KEPT", 3)
    texts = ["one two three four five six seven", "one two"] * 300
    assert len({ids for ids in words(texts)}) == 2
    codec = sentencepiece_codec.Codec(PIECES)
    codec.table.entries = 2
    assert codec("a b c d a b c d")[2] == "a b c d a b c d" and len(codec.table) <= 2
