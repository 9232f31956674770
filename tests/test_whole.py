"""Queries that answer for all of their input, held against DuckDB or plain Python on the smallest tables."""

import weakref
from datetime import date

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from nightsift.fixtures import TABLES, oracle
from nightsift.operators import candidates, lightcurve, reports, requests
from nightsift.plans import registry
from nightsift.streaming import jobs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    out = duckdb.connect()
    for t in TABLES:
        out.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return out


def rows(spark, name, cols):
    return sorted(map(tuple, registry.QUERIES[name](spark, SF).select(*cols).collect()))


def test_j5_all_targets(spark, con):
    want = con.execute(oracle(f"SELECT target_id, event_id FROM (SELECT DISTINCT target_id, field FROM ({registry.FIELDS})) JOIN fx_images USING (field)")).fetchall()
    got = rows(spark, "j5_target_images", ["target_id", "event_id"])
    assert got == sorted(want) and len({t % 50 for t, _ in got}) > 1


PAIRED = "SELECT t.target_id, i.*, least(greatest(window_days,1),30) AS days, least(greatest(max_images,1),50) AS images FROM fx_targets t JOIN fx_images i ON i.field = concat('Fld', t.target_id % 20)"


def test_w2_all_targets(spark, con):
    real = f"SELECT f.target_id, i.*, least(greatest(max_images,1),50) AS images FROM (SELECT DISTINCT target_id, field FROM ({registry.FIELDS})) f JOIN fx_images i USING (field) JOIN (SELECT target_id, max_images FROM fx_targets) USING (target_id)"
    stamp = r"regexp_extract(path,'(\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2})',1)"
    want = con.execute(oracle(f"SELECT target_id, event_id, CAST(n AS INT), total, total > images FROM (SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY {stamp} DESC, dir_date DESC, split_part(path,'/',1) DESC, split_part(path,'/',2)) AS n, count(*) OVER (PARTITION BY target_id) AS total FROM ({real})) WHERE n <= images")).fetchall()
    got = rows(spark, "w2_newest_images", ["target_id", "event_id", "rank", "total", "capped"])
    assert got == sorted(want) and len({t[0] % 50 for t in got}) > 1 and any(t[4] for t in got)


def test_newest_images_of_listed_fields(spark):
    """Targets that bring their fields get what they get by a table of fields; none without a field."""
    images = spark.range(600).selectExpr("id AS event_id", "concat('F', id % 6) AS field", "date_add(DATE '2024-01-01', CAST(id % 9 AS INT)) AS dir_date", "concat('img/wcs_', date_add(DATE '2024-01-01', CAST(id % 9 AS INT)), '_0', id % 7, '-00-00_', id, '.fits') AS path")
    targets = spark.range(40).selectExpr("id AS target_id", "CAST(1 + id % 50 AS INT) AS images")
    fields = targets.selectExpr("target_id", "explode(CASE WHEN target_id % 5 > 0 THEN transform(sequence(1, target_id % 5), i -> concat('F', (i * target_id) % 8)) ELSE array() END) AS field").distinct()
    lists = fields.groupBy("target_id").agg(F.sort_array(F.collect_set("field")).alias("fields"))
    listed = targets.join(lists, "target_id", "left").withColumn("fields", F.coalesce("fields", F.array().cast("array<string>")))
    got, want = (sorted(map(tuple, lightcurve.newest_images(t, f, images).select("target_id", "event_id", "rank", "total", "capped").collect())) for t, f in ((listed, None), (targets, fields)))
    assert got == want and len({r[0] for r in got}) > 20


def test_w3_all_targets(spark, con):
    want = con.execute(oracle(f"SELECT target_id, event_id FROM ({PAIRED}) WHERE dir_date >= (SELECT DATE '2024-01-20') - CAST(days-1 AS INT)")).fetchall()
    got = rows(spark, "w3_within_days", ["target_id", "event_id"])
    assert got == sorted(want) and len({t % 50 for t, _ in got}) == 50


def test_pairs_of_a_field_take_little_space(spark, tmp_path):
    """Many images of one field, targets with nulls, a field of one side only: all pairs, written in a fraction of a byte each."""
    images = spark.range(40_001).selectExpr("id AS event_id", "CASE WHEN id < 40000 THEN 'a' END AS field", "date_sub(DATE '2024-01-20', CAST(id % 4 AS INT)) AS dir_date")
    targets = spark.range(123).selectExpr("id AS target_id", "CASE id WHEN 120 THEN 'b' WHEN 121 THEN NULL ELSE 'a' END AS field", "CAST(1 + id % 3 AS INT) AS days")
    got = lightcurve.images_for_targets(images.select("field", "event_id"), targets.union(targets)).select("target_id", "event_id")
    got.write.option("compression", "snappy").parquet(f"{tmp_path}/j5")
    assert sum(f.stat().st_size for f in (tmp_path / "j5").glob("*.parquet")) < 4 << 20
    counts = spark.read.parquet(f"{tmp_path}/j5").groupBy("target_id").agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("d")).collect()
    assert {r.target_id for r in counts} == {i for i in range(123) if i not in (120, 121)} and all(r.n == r.d == 40_000 for r in counts)
    days = lightcurve.images_within_days(targets, images, date(2024, 1, 20)).groupBy("target_id").agg(F.count("*").alias("n"), F.min("dir_date").alias("d")).collect()
    assert all((r.n, r.d) == (10_000 * (1 + r.target_id % 3), date(2024, 1, 20 - r.target_id % 3)) for r in days) and len(days) == 121


def test_w6_all_lines(spark):
    want = []
    for report, text in registry.load(spark, SF, "fx_report_text").select("report_id", "text").collect():
        lines = text.split("\n")
        want += [(report, i, "~".join(lines[max(0, i - 2) : i + 2])) for i in range(len(lines))]
    assert rows(spark, "w6_context", ["report_id", "line_no", "context"]) == sorted(want)


def test_lines_of_reports_are_not_sorted(spark):
    """W6 moves no line, P19 no more than a row a report."""
    rows = [("a", "x\nProcessing fields F\nb\na\nProcessing complete!"), ("a", "Processing fields F\nc\nProcessing complete!"), ("n", None), ("e", ""), ("u", "Processing fields F\nProcessing complete!")]
    df = spark.createDataFrame(rows, "report_id string, text string")
    got = reports.with_context(df, 2, 1)
    want = [(r, i, x, t.split("\n")[max(0, i - 2) : i + 2]) for r, t in rows if t is not None for i, x in enumerate(t.split("\n"))]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert not any(x in got._jdf.queryExecution().executedPlan().toString() for x in ("Exchange", "Sort", "Window"))
    assert [tuple(r) for r in candidates.combined_body(df).collect()] == [("a", 0, "b"), ("a", 1, "a"), ("a", 0, "c")]
    plan = registry.QUERIES["p19_combined_body"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan


def test_k1_documents_are_bounded(spark, monkeypatch):
    from nightsift.sources import sinks

    made, build = [], sinks.candidate_documents
    monkeypatch.setattr(sinks, "candidate_documents", lambda *a: made.append(build(*a)) or made[0])
    got = registry.QUERIES["k1_document_counts"](spark, SF).collect()
    sizes = [len(r.candidates) for r in made[0].select("candidates").collect()]
    assert max(sizes) <= 100 and sum(sizes) == sum(r.n for r in got) == spark.read.parquet(f"{SF}/events.parquet").count()


def test_admission_holds_no_stretch(spark):
    """A key that is never idle is decided as its rows stream by, with no array of them in the plan."""
    n = 30_000
    df = spark.range(n).selectExpr("id AS event_id", "CASE WHEN id % 3 > 0 THEN id % 3 END AS k", "timestamp_seconds(1700000000 + id DIV 2) AS ts").repartition(5)
    out = requests.admit(df, "k", "ts", "event_id", 2, 600)
    plan = out._jdf.queryExecution().toString()
    assert "collect_list" not in plan and "aggregate(" not in plan
    got = {r.event_id: r.accepted for r in out.collect()}
    held, want = {}, {}
    for i in range(n):
        k, t = (i % 3 or None), i // 2
        held[k] = [x for x in held.get(k, []) if x > t - 600]
        want[i] = len(held[k]) < 2
        held[k] += [t] * want[i]
    assert got == want


def test_sorted_parts_spill():
    rng = np.random.default_rng(1)
    all_ = pd.DataFrame({"t": rng.integers(0, 500, 5000), "event_id": rng.permutation(5000)})
    parts = list(jobs.sorted_parts((all_[i : i + 300] for i in range(0, 5000, 300)), ["t", "event_id"], most=1000, slice_rows=100))
    assert max(map(len, parts)) <= 100
    assert pd.concat(parts, ignore_index=True).equals(all_.sort_values(["t", "event_id"], ignore_index=True))


def test_gate_reads_revisions_one_part_at_a_time():
    live = []

    def parts():
        for i in range(20):
            p = pd.DataFrame({"report_id": "a", "mtime": [pd.Timestamp(2026, 1, 1) + pd.Timedelta(minutes=30 - i)], "text": ["Processing complete!" if i in (3, 12) else "running"]})
            live.append(weakref.ref(p))
            assert sum(r() is not None for r in live) <= 3
            yield p

    class State:
        def exists(self):
            return False

        def update(self, _):
            pass

        def registerTimer(self, _):
            pass

    gate = jobs._Gate(1000)
    gate.done = gate.handle = State()
    (out,) = gate.handleInputRows(("a",), parts(), None)
    assert out["mtime"].tolist() == [pd.Timestamp(2026, 1, 1, 0, 18)]


def test_k8_empty_stderr(spark):
    want = []
    for (i,) in registry.load(spark, SF, "fx_measurements").where("event_id % 6 = 0").select("event_id").collect():
        want.append((i, "timeout", i % 4, "\n".join(f"line {k}" for k in range(max(0, i % 40 - 20), i % 40))))
    assert rows(spark, "k8_skip_log", ["event_id", "reason", "return_code", "stderr_tail"]) == sorted(want)
    assert any(i % 40 == 0 for i, *_ in want)
