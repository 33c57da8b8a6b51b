from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from __spark_entry__ import oracle_sql, queries
from stratalake.llm import bpe
from stratalake.llm.queries import ALL

SF = "/root/testdata/sf0.001"


def test_queries_are_registered():
    assert ALL.keys() | {"pipeline"} <= queries().keys()
    numbers = sorted(int(name[2:].split("_")[0]) for name in ALL)
    assert numbers == list(range(1, 14))
    assert not ALL.keys() & oracle_sql().keys()


def test_stages_hand_on_documents(spark, small):
    docs, seen = small, {}
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = _stored(spark, stage, docs)
        seen[name] = docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    texts = {r.doc_id: r.text for r in small.collect()}
    kept = {r.doc_id for r in seen["language_id"]}
    assert kept == {i for i, t in texts.items() if any(map(str.isalpha, t))}
    assert {r.doc_id for r in seen["near_copies"]} <= kept
    assert not any("@mail" in r.text for r in seen["personal_data"])
    assert all(len(r.text) == r.n_chars for r in seen["personal_data"])
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    clean = {r.doc_id: r.text for r in seen["personal_data"]}
    for row in seen["tokens"]:
        ids = library.encode(clean[row.doc_id], add_special_tokens=False).ids
        assert bytes(row.ids) == bpe.little_endian(ids)


def _stored(spark, stage, docs):
    from stratalake.llm.common import stored

    return stored(stage(spark, docs, SF), "test-stage")


def test_odd_rows_pass_every_stage(spark, odd, none):
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES:
            docs = _stored(spark, stage, docs)
        assert docs.columns == ["doc_id", "ids", "n_tokens"]


def test_columns_named_like_those_of_the_stages(spark, small):
    clashing = small.limit(40).selectExpr("*", "doc_id AS id", "text AS row", "'x' AS size")
    docs = clashing
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = _stored(spark, stage, docs)
        assert docs.columns == clashing.columns
    assert docs.count() > 0


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100
