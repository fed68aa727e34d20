"""The registered queries on the smallest tables, every contract column against plain code; the pipeline on odd tables."""

import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import brute

public_tokenizers = pytest.importorskip("public_tokenizers")

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402

QUERIES = entry.queries()


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").collect()


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs}


def by_id(df):
    rows = df.collect()
    found = {r[0]: r for r in rows}
    assert len(found) == len(rows)
    return found


def test_op1_removes_what_starts_earlier(spark, sf_dir, texts):
    rows = by_id(QUERIES["op1_suffix_dedup"](spark, sf_dir))
    want = {i: (i, *w[:3], brute.sha256(w[3])) for i, w in brute.repeats(texts, 100).items()}
    assert {i: tuple(r)[:5] for i, r in rows.items()} == want and sum(w[2] for w in want.values()) > 0


def test_op2_deals_rows(spark, sf_dir, texts):
    rows = by_id(QUERIES["op2_hilbert_shards"](spark, sf_dir))
    assert set(rows) == set(texts)
    slots = defaultdict(list)
    for i, r in rows.items():
        data = (texts[i] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 16, zlib.crc32(data))
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < 40
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1 and len(slots) == 40


def test_op3_fingerprints_texts_and_their_edits(spark, sf_dir, texts):
    rows = by_id(QUERIES["op3_fingerprints"](spark, sf_dir))
    ids = sorted(texts)
    assert sorted(rows) == ids
    for i, after in zip(ids, [*ids[1:], ids[0]], strict=True):
        text, new = texts[i] or "", texts[after] or ""
        edited = text[: len(text) - len(text) // 2] + new[: len(text) // 2]
        one, two, three = map(brute.plain_sketch, (text, edited, new))
        r = rows[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), brute.sha256(edited))
        assert (r.fingerprint, r.edited_fingerprint) == (brute.plain_print(one), brute.plain_print(two))
        assert r.near_edited == pytest.approx(brute.plain_near(one, two, text == edited))
        assert r.near_next == pytest.approx(brute.plain_near(one, three, text == new))


def test_op4_tells_languages(spark, sf_dir, docs):
    larger = sf_dir.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{larger}/documents.parquet").collect()
    rows = by_id(QUERIES["op4_language_id"](spark, larger))
    learned = {r.lang for r in docs if r.lang and zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    right = wrong = 0
    for d in docs:
        r = rows[d.doc_id]
        assert r.held_out == (zlib.crc32(str(d.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        letters = any(c.isalpha() for c in d.text or "")
        assert r.lang_pred in learned if letters else r.lang_pred == "und"
        if r.held_out and d.lang and letters:
            right, wrong = right + (r.lang_pred == d.lang), wrong + (r.lang_pred != d.lang)
    assert right >= 0.95 * (right + wrong) > 0


def test_op5_codes_as_the_library(spark, sf_dir, texts):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = by_id(QUERIES["op5_sentencepiece_codes"](spark, sf_dir))
    assert set(rows) == set(texts)
    for i, text in texts.items():
        ids = library.encode(text or "")
        assert tuple(rows[i])[:4] == (i, len(ids), brute.sha256(",".join(map(str, ids))), brute.sha256(library.decode(ids)))


def test_op6_packs_every_id_once(spark, sf_dir, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in QUERIES["op6_packing"](spark, sf_dir).collect():
        pieces[r.doc_id].append(r)
        windows[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(texts)
    for i, found in pieces.items():
        ids, at = [*library.encode(texts[i] or "", add_special_tokens=False).ids, 2], 0
        for r in sorted(found, key=lambda r: r.start):
            part = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(part) and r.length > 0
            at += r.length
        assert at == len(ids)
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert sum(n for parts in windows.values() for _, n in parts) >= 0.95 * 4096 * (len(windows) - 1)


def test_op7_groups_near_copies(spark, sf_dir, texts):
    rows = by_id(QUERIES["op7_near_duplicates"](spark, sf_dir))
    want = brute.near_groups(texts, 4, 80)
    assert {i: (r.n_shingles, r.component_id) for i, r in rows.items()} == want
    assert all(r.kept == (i == r.component_id) for i, r in rows.items()) and len({c for _, c in want.values()}) < len(want)


def test_op8_links_close_vectors(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    rows = by_id(QUERIES["op8_embedding_duplicates"](spark, sf_dir))
    usable = [v for v in vectors if v.label is not None and v.embedding and all(x is not None and np.isfinite(x) for x in v.embedding) and any(v.embedding)]
    unit = np.array([v.embedding for v in usable], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    label = np.array([v.label for v in usable])
    linked = (unit @ unit.T >= 0.98) & (label[:, None] == label[None, :])
    groups = brute.Union([v.vec_id for v in vectors])
    for i, j in zip(*np.nonzero(linked), strict=True):
        groups.join(usable[i].vec_id, usable[j].vec_id)
    links = dict(zip((v.vec_id for v in usable), linked.sum(axis=1) - 1, strict=True))
    assert {i: (r.n_links, r.component_id, r.kept) for i, r in rows.items()} == {
        v.vec_id: (links.get(v.vec_id, 0), groups.find(v.vec_id), groups.find(v.vec_id) == v.vec_id) for v in vectors
    }


def test_op10_scores_whole_texts(spark, sf_dir):
    larger = sf_dir.replace("sf0.001", "sf0.01")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{larger}/labels.parquet").collect()}
    rows = by_id(QUERIES["op10_toxicity"](spark, larger))
    assert len(rows) == spark.read.parquet(f"{larger}/documents.parquet").count()
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [(labels[i], r.predicted) for i, r in rows.items() if r.held_out and labels.get(i) is not None]
    assert sum(p for label, p in held if label == 0) == 0 and sum(p for label, p in held if label) >= 0.6 * sum(label for label, _ in held)


#: Names that the operators use inside, as columns of a table.
CLASHES = (
    "gone_id node component_id copies band pivot members cluster block blocks first second doc check rest spans place start n key lead "
    "content runs bytes edge settled id word number label score one two digest held kept_text shard curve window open near fill"
).split()


@pytest.fixture
def folder(spark, tmp_path, sf_dir):
    def make(rows):
        kept = spark.read.parquet(f"{sf_dir}/documents.parquet")
        for i, name in enumerate(CLASHES):
            kept = kept.selectExpr("*", f"'{name}' AS `{name}`" if i % 2 else f"{i} AS `{name}`")
        odd = spark.createDataFrame(
            [(1, None), (2, ""), (3, "42 !!"), (None, "Text without an id, of some words that nobody else uses here."), (5, "x" * 300_000)], "doc_id long, text string"
        )
        kept = kept.unionByName(odd, allowMissingColumns=True).unionByName(kept.limit(7))
        kept.limit(rows).write.parquet(str(tmp_path / "documents.parquet")) if rows is not None else kept.write.parquet(str(tmp_path / "documents.parquet"))
        spark.read.parquet(f"{sf_dir}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
        return str(tmp_path)

    return make


def test_pipeline_takes_any_column_name_and_repeated_rows(spark, folder):
    path = folder(None)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, path)
        assert kept.columns == docs.columns
        assert kept.filter("gone_id <> 0 OR gone_id IS NULL").count() <= 5
    packed = corpus_pipeline.run(spark, path)
    ids = {r.doc_id for r in packed.select("doc_id").distinct().collect()}
    assert ids <= {r.doc_id for r in docs.collect()} and len(ids) > 50 and None in ids


def test_pipeline_of_an_empty_table(spark, folder):
    path = folder(0)
    assert corpus_pipeline.run(spark, path).count() == 0
    for name in ("op1_suffix_dedup", "op3_fingerprints", "op7_near_duplicates", "op12_source_divergence"):
        assert QUERIES[name](spark, path).count() == 0
