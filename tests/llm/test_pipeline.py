from __future__ import annotations

import corpus_pipeline
import public_tokenizers
import pytest
import sentencepiece

from corpora import words_of
from test_line_dedup import brute as brute_lines
from test_near_dedup import brute as brute_near

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returns, written and read again."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, out[-1], SF_DIR).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "mixing", "sentencepiece"]
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes


def test_quality_rules(stages):
    before, after = dict(rows(stages[0])), dict(rows(stages[1]))
    assert after.items() <= before.items() and 0 < len(after) < len(before)
    assert all(len(words_of(text)) >= 50 for text in after.values())


def test_line_dedup(stages):
    before, after = rows(stages[1]), rows(stages[2])
    expected = {r[0]: r[2] for r in brute_lines(before)}
    assert [k for k, _ in after] == [k for k, _ in before]
    assert any(expected.values())
    for (doc_id, old), (_, new) in zip(before, after, strict=True):
        assert len(old.split("\n")) - expected[doc_id] == len(new.split("\n")) or (expected[doc_id] and not new)


def test_near_dedup(stages):
    before, after = rows(stages[2]), rows(stages[3])
    kept = {r[0] for r in brute_near(before, 5) if r[3]}
    assert {k for k, _ in after} == kept and len(after) == len(kept)


def test_mixing(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert set(after) == {r for r in before if words_of(r[1])} | {r for r in before if not words_of(r[1])}
    assert len(after) > len(before) and max(after.count(r) for r in set(after)) <= 2


def test_sentencepiece(stages):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = {r.doc_id: r for r in stages[5].collect()}
    assert stages[5].count() == stages[4].count()
    for doc_id, text in rows(stages[4]):
        assert found[doc_id].n_pieces == len(library.encode(text)) and found[doc_id].round_trip


def test_run_equals_the_stages(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect())) == sorted(map(tuple, stages[5].collect()))
