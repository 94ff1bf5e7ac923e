"""What jobs, the stream and the queries over them keep on disk."""

from __future__ import annotations

import gzip
import json
import time
from pathlib import Path

from eventmart import queries
from eventmart.operators import silver
from eventmart.plans import jobs, scratch
from eventmart.plans.paths import Lake
from eventmart.sources import partner
from test_jobs import HEAD, event

SF = "/root/testdata/sf0.001"


def drops(tmp_path) -> Lake:
    (tmp_path / "landing").mkdir()
    lines = [f"2026-06-{20 + i % 3}T{i % 24:02d}:00:00Z,product_viewed,s{i % 9},sku-{i % 50},10,c,,{'many' if i % 40 == 7 else 1}" for i in range(120)]
    (tmp_path / "landing/a.csv.gz").write_bytes(gzip.compress((HEAD + "\n".join(lines) + "\n").encode()))
    (tmp_path / "landing/b.ndjson.gz").write_bytes(gzip.compress((json.dumps(event(7)) + "\nnot json\n").encode()))
    (tmp_path / "landing/none.csv.gz").write_bytes(gzip.compress(b""))
    return Lake(str(tmp_path))


def shuffles(spark) -> int:
    return sum(b.name().startswith("shuffle_") for b in (lambda s: [s.apply(i) for i in range(s.size())])(spark._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks()))


def test_drops_and_bronze_are_packed_and_jobs_leave_no_shuffles(spark, tmp_path):
    lake, before = drops(tmp_path), shuffles(spark)
    assert jobs.land(spark, lake) == {"accepted": 118, "rejected": 4, "files": 3, "archived": 3}
    files = [p.name for z in ("bronze", "quarantine") for p in (tmp_path / z).rglob("*") if p.is_file() and not p.name.startswith(".")]
    assert files and all(n.endswith(".json.gz") for n in files)
    assert not list((tmp_path / "quality").glob("stages/*"))
    lost = spark.read.json(lake.path("quarantine", "landing"))
    assert sorted(tuple(r.failed_checks) for r in lost.collect())[:-1] == [("numbers_parsed",)] * 3 and "hour" not in lost.columns
    assert jobs.refine(spark, lake)["raw_records"] == 118
    for _ in range(50):  # files go in the background
        if shuffles(spark) <= before:
            break
        time.sleep(0.2)
    assert shuffles(spark) <= before


def record(key: str, session: str | None, day: int, at: str) -> dict:
    return event(1, day=day, idempotency_key=key, ingested_at=at) | {"session": {"session_id": session}}


def test_copies_in_several_sessions_and_days(spark, tmp_path):
    def refined(name, *records):
        lake = Lake(str(tmp_path / name))
        for day in {r["occurred_at"][:10] for r in records}:
            place = tmp_path / name / f"bronze/dt={day}/hour=10"
            place.mkdir(parents=True, exist_ok=True)
            (place / "a.json").write_text("\n".join(json.dumps(r) for r in records if r["occurred_at"][:10] == day))
        return lake, jobs.refine(spark, lake), sorted((r.idempotency_key, r.session_id, r.partition_date) for r in jobs.read_silver(spark, lake).collect())

    alike = [record("a", "s", 20, "1"), record("a", "s", 20, "2"), record("b", None, 21, "1")]
    lake, row, got = refined("alike", *alike)
    assert got == [("a", "s", "2026-06-20"), ("b", None, "2026-06-21")] and (row["raw_records"], row["processed_records"], row["duplicate_records"], row["days"]) == (3, 2, 1, 2)
    bronze = partner.read_bronze(spark, lake.path("bronze"))
    assert silver.copies(silver.flatten(bronze)).first()["torn"] == 0
    plan = silver.dealt_silver(bronze, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    lake, row, got = refined("torn", *alike, record("a", "t", 22, "3"))
    assert got == [("a", "t", "2026-06-22"), ("b", None, "2026-06-21")] and (row["processed_records"], row["duplicate_records"], row["days"]) == (2, 2, 2)
    # a day of silver of which the deduplication leaves nothing now is kept, and not counted
    (tmp_path / "torn/bronze/dt=2026-06-23/hour=10").mkdir(parents=True)
    (tmp_path / "torn/bronze/dt=2026-06-23/hour=10/a.json").write_text(json.dumps(record("b", "u", 23, "9")))
    row = jobs.refine(spark, lake)
    assert (row["processed_records"], row["days"]) == (2, 2) and jobs.read_silver(spark, lake).count() == 3


def test_a_queue_in_batches_gives_what_one_batch_gives(spark, monkeypatch):
    rows = lambda: sorted(map(str, queries.QUERIES["stream_bronze"](spark, SF).collect()))
    whole, taken = rows(), []
    original = queries.ingest.write_batch
    monkeypatch.setattr(queries, "BATCH_ROWS", 400)
    monkeypatch.setattr(queries.ingest, "write_batch", lambda lines, k, lake: taken.append(k) or original(lines, k, lake))
    assert rows() == whole and taken == [0, 1, 2]


def test_queries_keep_no_zone_that_is_read_no_more(spark, monkeypatch):
    made = []
    original = scratch.new_path
    monkeypatch.setattr(queries, "new_path", lambda s, name: made.append(original(s, name)) or made[-1])
    assert queries.QUERIES["job_silver_events"](spark, SF).count() > 0
    left = {p.name for path in made if Path(path).is_dir() for p in Path(path).iterdir()}
    assert left == {"silver", "quality", "quarantine"}
