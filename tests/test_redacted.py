"""Redaction passes rows as Arrow batches, all columns with them."""

from abiflow.llm import pii


def test_redacted_rows_pass_as_arrow(spark):
    texts = ["mail a@b.org", None, "", "call +1 202 555 0100 now", "plain"] * 150
    docs = spark.createDataFrame([(k, t, {"k": [k]}, None) for k, t in enumerate(texts)], "doc_id bigint, text string, more map<string,array<bigint>>, n int").coalesce(1)
    out = pii.redacted(docs)
    assert out.columns == docs.columns and out.schema == docs.schema
    assert "MapInArrow" in out._jdf.queryExecution().executedPlan().toString()
    got = {r.doc_id: (r.text, r.more, r.n) for r in out.collect()}
    assert got == {k: (pii.redact_text(t), {"k": [k]}, None) for k, t in enumerate(texts)}
    assert got[0][0] == "mail [EMAIL]" and got[1][0] is None
