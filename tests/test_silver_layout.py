"""Files of silver by days and buckets."""

from __future__ import annotations

from eventmart.plans import jobs
from eventmart.plans.paths import Lake
from test_jobs import HEAD


def landed(spark, tmp_path) -> Lake:
    (tmp_path / "landing").mkdir()
    lines = [f"2026-06-{20 + i % 3}T{i % 24:02d}:00:00Z,product_viewed,s{i},sku-{i},10,c,,1" for i in range(240)]
    (tmp_path / "landing/a.csv").write_text(HEAD + "\n".join(lines) + "\n")
    lake = Lake(str(tmp_path))
    jobs.land(spark, lake)
    return lake


def test_files_of_silver_go_by_days_and_buckets(spark, tmp_path):
    lake = landed(spark, tmp_path)
    assert jobs.refine(spark, lake)["processed_records"] == 240
    assert len(list((tmp_path / "silver/events").rglob("*.parquet"))) <= 3 * spark.sparkContext.defaultParallelism
    assert len({r.partition_hour for r in jobs.read_silver(spark, lake).collect()}) == 24
    jobs.refine(spark, lake, "2026-06-21")
    assert jobs.read_silver(spark, lake).count() == 240 and spark.read.parquet(lake.path("silver", "events")).count() == 240


def test_folders_laid_out_by_hour_stay_so(spark, tmp_path):
    lake = landed(spark, tmp_path)
    jobs.refine(spark, lake)
    whole = sorted(map(str, jobs.read_silver(spark, lake).select("idempotency_key", "partition_date", "partition_hour").collect()))
    older = Lake(str(tmp_path / "older"), {"bronze": lake.path("bronze")})
    jobs.read_silver(spark, lake).write.partitionBy(*jobs.LAYOUT).parquet(older.path("silver", "events"))
    for day in (None, "2026-06-21"):
        jobs.refine(spark, older, day)
        assert sorted(map(str, jobs.read_silver(spark, older).select("idempotency_key", "partition_date", "partition_hour").collect())) == whole
    assert len(list((tmp_path / "older/silver/events").glob("*/partition_hour=*"))) == 24
