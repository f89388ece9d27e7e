from __future__ import annotations

import __spark_entry__ as entry
import corpus_pipeline
import public_tokenizers as P
from keepwise.llm import language, packing, pii, simhash, toxicity
from keepwise.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    """Each stage on all its predecessor kept, against the operators' own decisions."""
    docs = table(spark, SF, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "toxicity", "SimHash near-dedup", "PII", "best-fit packing"]
    kept, seen = docs, []
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, kept, SF).cache()
        assert out.columns == docs.columns
        seen.append({r.doc_id: r.text for r in out.collect()})
        kept = out
    everything = {r.doc_id: r.text for r in docs.collect()}
    scored = {r.doc_id: r for r in language.identify(docs).collect()}
    assert set(seen[0]) == {i for i, r in scored.items() if r.lang_pred != "und" and r.score >= language.MIN_SCORE}
    first = docs.where(docs.doc_id.isin(list(seen[0])))
    toxic = {r.doc_id for r in toxicity.grade_documents(first, table(spark, SF, "labels")).collect() if r.toxic}
    assert set(seen[1]) == set(seen[0]) - toxic and toxic
    second = docs.where(docs.doc_id.isin(list(seen[1])))
    assert set(seen[2]) == {r.component_id for r in simhash.near_duplicates(second).collect()}
    assert set(seen[3]) == set(seen[2]) and len(seen[2]) < len(seen[1])
    masked = {i for i in seen[3] if seen[3][i] != everything[i]}
    third = docs.where(docs.doc_id.isin(list(seen[2])))
    assert masked == {r.doc_id for r in pii.personal_data(third).collect() if r.spans} and masked
    packed = corpus_pipeline.run(spark, SF)
    encode = packing.text_ids(P.path("byte_bpe_50k.json"), None)
    tokens = {r.doc_id: r.n for r in packed.groupBy("doc_id").agg({"length": "sum"}).toDF("doc_id", "n").collect()}
    assert tokens == {i: len(encode(t)) + 1 for i, t in seen[3].items()}


def test_odd_documents_pass_all_stages(spark, odd_docs, no_docs):
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, SF)
        assert docs.columns == odd_docs.columns, name
        empty = stage(spark, no_docs, SF)
        assert empty.columns == odd_docs.columns and empty.collect() == [], name
    assert corpus_pipeline.STAGES[4][1](spark, docs, SF).count() >= docs.count()
    assert corpus_pipeline.STAGES[4][1](spark, no_docs, SF).collect() == []


def test_every_operator_is_registered():
    names = set(entry.queries())
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14)) and "pipeline" in names
    assert set(entry.oracle_sql()) <= names
