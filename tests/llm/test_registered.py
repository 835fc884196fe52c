"""The registered queries and the pipeline, over whole small tables."""

import brute
import pytest
from compare import connect, duck_rows, spark_rows
from conftest import SF_DIR

import __spark_entry__ as registered
import corpus_pipeline
from dqtable.llm.byte_bpe import encoded
from dqtable.llm.common import read_table
from dqtable.llm.queries import LLM_ORACLE, LLM_QUERIES


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in read_table(spark, SF_DIR, "documents").collect()]


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES) == list(range(1, 14))
    assert set(LLM_QUERIES) | {"pipeline"} <= set(registered.queries())
    assert set(LLM_ORACLE) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_sql(spark, name):
    assert spark_rows(LLM_QUERIES[name](spark, SF_DIR)) == duck_rows(connect(SF_DIR), LLM_ORACLE[name])


def test_contract_columns(spark, documents):
    """The first columns of each query against plain readings of its contract."""
    items = [(r.item_id, r.text) for r in read_table(spark, SF_DIR, "benchmark").collect()]
    rows = {n: LLM_QUERIES[n](spark, SF_DIR).collect() for n in ("op1_pii", "op2_quality_rules", "op4_benchmark_decontamination")}
    text = dict(documents)
    for r in rows["op1_pii"]:
        spans = brute.base_spans(text[r.doc_id])
        assert r.base_sha256 == brute.sha(brute.written(spans))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in spans) for i in range(4)]
    for r in rows["op2_quality_rules"]:
        assert tuple(r)[1:6] == brute.quality(text[r.doc_id])
    hits = [r for r in rows["op4_benchmark_decontamination"] if r.contaminated]
    assert hits and all(tuple(r)[1:6] == brute.decontaminated(text[r.doc_id], items) for r in hits)
    found = brute.Counter(tuple(r) for r in LLM_QUERIES["op8_simhash_dedup"](spark, SF_DIR).collect())
    assert found == brute.near_duplicates(documents)


def test_pipeline(spark, documents):
    """Each stage against its operator's contract, over all that its predecessor kept."""
    items = [(r.item_id, r.text) for r in read_table(spark, SF_DIR, "benchmark").collect()]
    docs = read_table(spark, SF_DIR, "documents")
    columns, rows = docs.columns, documents
    stages = dict(corpus_pipeline.STAGES)
    assert [n.split("_")[0] for n in stages] == ["quality", "simhash", "benchmark", "pii", "byte"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR).cache()
        after = [(r.doc_id, r.text) for r in docs.collect()]
        assert docs.columns == columns
        if name == "quality_rules":
            kept = {r.doc_id for r in LLM_QUERIES["op2_quality_rules"](spark, SF_DIR).where("kept").collect()}
            assert after and {d for d, _ in after} == kept
        elif name == "simhash_near_dedup":
            least = {c for _, _, c in brute.near_duplicates(rows)}
            assert sorted(d for d, _ in after) == sorted(least)
        elif name == "benchmark_decontamination":
            clean = [d for d, t in rows if not brute.decontaminated(t, items)[4]]
            assert sorted(d for d, _ in after) == sorted(clean)
        else:
            old = dict(rows)
            assert sorted(old) == sorted(d for d, _ in after)
            for doc, text in after:
                assert not brute.base_spans(text)
                assert (text == old[doc]) == (not brute.base_spans(old[doc]))
        rows = after
    ids = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in stages["byte_bpe"](spark, docs, SF_DIR).collect()}
    whole = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert ids == whole == {r.doc_id: (r.n_tokens, r.ids_sha256) for r in encoded(docs).collect()}


def test_pipeline_stages_on_odd_tables(spark):
    rows = [(1, None, None, None, None), (None, "", "", "", 0), (None, None, None, None, None)]
    rows += [(2, "word " * 20_000, "en", "s", 1), (2, "word " * 20_000, "en", "s", 1)]
    rows += [(i, " ".join(f"t{i}x{k}" for k in range(80)), "en", "s", 9) for i in (3, 4, 4)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long"
    ).selectExpr("*", "'x' as doc", "1 as kept", "2 as spans", "3 as runs", "4 as fp", "5 as uid")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), SF_DIR).isEmpty()
        assert stage(spark, docs, SF_DIR).count() <= len(rows)
