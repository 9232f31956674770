"""The registered queries, their SQL twins, and the pipeline's stages on their own inputs."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from nightsift.llm.common import materialize, table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op2_source_mixing", "op3_secret_scans", "op5_warc", "op8_fingerprints", "op11_filter_audit", "op13_line_dedup"])
def test_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    found = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    assert sorted(repr(tuple(r[c] for c in cols)) for r in df.collect()) == sorted(repr(tuple(r[names.index(c)] for c in cols)) for r in found.fetchall())


def test_all_registered():
    assert {n.split("_")[0] for n in entry.queries() if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in entry.queries()


def test_stages(spark):
    docs = table(spark, SF, "documents")
    seen, out = {r.doc_id: r for r in docs.collect()}, docs
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = out
        out = materialize(stage(spark, before, SF), "stage")
        kept.append(out)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
    quality, dedup, secret, mixed, packed = kept
    assert 0.7 * docs.count() < quality.count() < docs.count()
    assert {r.doc_id for r in dedup.collect()} <= {r.doc_id for r in quality.collect()}
    assert dedup.groupBy("text").count().where("count > 1").count() == 0
    for r in secret.collect():
        assert r.n_chars == len(r.text) and (r.text == seen[r.doc_id].text or "[secret]" in r.text)
    assert not any(re.search(r"(?i)token = [\"']?[A-Za-z0-9]{8}", r.text) for r in secret.collect())
    assert {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in secret.collect()}
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in mixed.collect()}
    assert packed.where("piece = 0").count() == mixed.count()
