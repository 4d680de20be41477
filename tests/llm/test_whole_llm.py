"""The registered query of operator 6 over the whole table of labels."""

import pytest

import __spark_entry__ as entry


@pytest.fixture
def table(spark, tmp_path):
    """Writes documents and labels and gives their folder."""

    def put(docs, labels=()):
        spark.createDataFrame([(i, t, s) for i, t, s in docs], "doc_id bigint, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
        spark.createDataFrame(list(labels), "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
        return str(tmp_path)

    return put


@pytest.mark.parametrize("block", [500_000, 8_000])
def test_op6_counts_every_target_row(spark, table, monkeypatch, block):
    from newsloom.llm import scratch
    from newsloom.llm.quality import importance

    monkeypatch.setattr(scratch, "BLOCK", block, raising=False)
    n = 21_000
    d = table([(i, f"common words and w{i % 900} v{i % 7919}", "a") for i in range(n + 500)], [(i, 1, 0) for i in range(n)] + [(3, 1, 0), (n, 0, 0)])
    docs = spark.read.parquet(f"{d}/documents.parquet")
    want = {r["doc_id"]: (r["log_weight"], r["kept"]) for r in importance(docs, docs.where(f"doc_id < {n}")).collect()}
    assert {r["doc_id"]: (r["log_weight"], r["kept"]) for r in entry.queries()["op6_importance_resampling"](spark, d).collect()} == want
