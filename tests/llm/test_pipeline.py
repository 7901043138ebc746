"""The corpus pipeline, stage by stage, against brute force."""

import hashlib
from collections import Counter

import pyarrow as pa
import pytest

import corpus_pipeline
from sievemill.llm import mixing
from tests.llm.helpers import words
from tests.llm.test_minhash import brute as near_brute
from tests.llm.test_substring_dedup import brute as substring_brute

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    from tests.conftest import SMALL

    base, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        got = stage(spark, docs, SMALL)
        got.write.parquet(f"{base}/{k}")
        out.append((docs, spark.read.parquet(f"{base}/{k}")))
        docs = out[-1][1]
    return out


def test_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "MinHash near-dedup", "substring dedup", "mixing sources", "SentencePiece"]
    for before, after in stages[:4]:
        assert after.dtypes == before.dtypes


def test_quality_keeps_good_documents(spark, stages, sf_dir):
    before, after = stages[0]
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1").join(before, "doc_id", "left_semi")
    assert good.join(after, "doc_id", "left_anti").count() <= 0.05 * good.count() and after.count() < before.count()


def test_near_dedup(stages):
    before, after = stages[1]
    want = {i for i, _, _, kept in near_brute([(r.doc_id, r.text) for r in before.collect()], corpus_pipeline.SHINGLE) if kept}
    assert {r.doc_id for r in after.collect()} == want


def test_substrings(stages):
    before, after = stages[2]
    want = {i: kept for i, _, _, kept in substring_brute([(r.doc_id, r.text) for r in before.collect()])}
    texts = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        assert b" ".join(words(r.text)).decode() == want[r.doc_id] and r.n_chars == len(r.text)
        assert r.text == texts[r.doc_id] or len(words(r.text)) < len(words(texts[r.doc_id]))


def test_mixing(stages):
    before, after = stages[3]
    assert before.exceptAll(after).count() == 0
    assert before.count() <= after.count() <= mixing.REPETITION * before.count() + 20 * 3


def test_mixed_order(spark, stages):
    before, after = stages[3]
    mixed = mixing.mix(before, repetition=mixing.REPETITION)
    want = [(r.doc_id, r.text) for r in mixed.orderBy("mix key").collect()]
    assert [(r.doc_id, r.text) for r in corpus_pipeline.mixing_stage(spark, before, "").collect()] == want


def test_encoding(stages):
    before, after = stages[4]
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = sorted((r.doc_id, len(sp.encode(r.text, add_eos=True))) for r in before.collect())
    assert sorted((r.doc_id, r.n_tokens) for r in after.collect()) == want


def test_runs_do_not_disturb_each_other(spark, stages, sf_dir, tmp_path):
    first = corpus_pipeline.run(spark, sf_dir)  # not read yet
    spark.read.parquet(f"{sf_dir}/documents.parquet").limit(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() <= 6
    assert first.exceptAll(stages[4][1]).count() == 0 == stages[4][1].exceptAll(first).count()


def test_stages_with_odd_rows_and_clashing_columns(spark, sf_dir):
    """Nulls everywhere, empty and repeated rows, no rows at all, and columns named like inner ones."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, id string, x int, `mix key` double, `cut kept` string, score double, component_id long"
    rows = [(i, t, None, s, None, "k", None, None, None, None, None, None) for i, t, s in [(None, None, None), (None, "null id text", "a"), (1, "", None), (1, "", None), (2, "one two three " * 30, "a"), (3, "one two three " * 30, "b"), (4, None, "a")]]
    full = spark.createDataFrame(rows, schema)
    for docs in (full, full.limit(0)):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            got = stage(spark, docs, sf_dir)
            assert k == 4 or got.columns == docs.columns
            n = got.count()
            assert n >= docs.count() if k in (2, 3, 4) else n <= docs.count()
    good = [(r.doc_id, r.text, r.n_chars) for r in corpus_pipeline.quality_stage(spark, full, sf_dir).collect()]
    trees = corpus_pipeline.quality.fit(full, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scores = trees.score(corpus_pipeline.quality.statistics(pa.array([t or "" for _, t, *_ in rows])))
    assert sorted(good, key=str) == sorted([(r[0], r[1], r[4]) for r, x in zip(rows, scores, strict=True) if x >= corpus_pipeline.QUALITY], key=str)
    mixed = Counter((r.doc_id, r.text, r.kept) for r in corpus_pipeline.mixing_stage(spark, full, sf_dir).collect())
    assert all(mixed[r[0], r[1], "k"] >= sum(x[:2] == r[:2] for x in rows) for r in rows)
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    coded = sorted(((r.doc_id, r.n_tokens, r.decoded_sha256) for r in corpus_pipeline.encoding_stage(spark, full, sf_dir).collect()), key=str)
    assert coded == sorted(((r[0], len(sp.encode(r[1] or "", add_eos=True)), hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in rows), key=str)
    near = {r.doc_id for r in corpus_pipeline.near_dedup_stage(spark, full, sf_dir).collect()}
    assert near == {None, 1, 2, 4}
    cut = [(r.text, r.n_chars, r.kept) for r in corpus_pipeline.substring_stage(spark, full, sf_dir).collect()]
    assert len(cut) == 7 and ("", 0, "k") in cut and all(r[2] == "k" for r in cut)
