import datetime as dt
import os

from tests.fixtures import row, write_hourly, write_plate
from vitrine.plans.ingest import IngestConfig, IngestJob
from vitrine.sources import listing as L


def _touch(path):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    open(path, "w").write("x\n")


def _history(root, days):
    first = dt.date(2021, 6, 1)
    for n in range(days):
        d = first + dt.timedelta(n)
        _touch(f"{root}/h/{d:%Y/%m/%d}/05.csv")
        _touch(f"{root}/p/{d:%Y-%m}/{d:%Y-%m-%d}-PlateLog.txt")
    return first


def test_a_day_of_a_long_history_lists_only_its_folder(spark, tmp, monkeypatch):
    first = _history(tmp, 1000)
    seen = []
    real = L.list_files
    monkeypatch.setattr(L, "list_files", lambda s, where, glob: seen.append(where) or real(s, where, glob))
    day = str(first + dt.timedelta(500))
    hourly = L.list_hourly_logs(spark, f"{tmp}/h", day)
    plate = L.list_plate_logs(spark, f"{tmp}/p", day)
    assert [len(x) for x in seen] == [1, 1] and seen[0][0].endswith(day.replace("-", "/")) and seen[1][0].endswith(f"{day}-PlateLog.txt")
    assert [str(r["file_date"]) for r in hourly.collect()] == [day] == [str(r["file_date"]) for r in plate.collect()]
    # whatever the file index knows lies in that folder
    assert len(hourly.inputFiles()) == 1 and len(plate.inputFiles()) == 1
    whole = L.list_hourly_logs(spark, f"{tmp}/h")
    assert whole.count() == 1000 and seen[2] == f"{tmp}/h"


def test_ranges_over_months_years_and_gaps(spark, tmp):
    for d in ("2023-12-30", "2024-01-01", "2024-02-29", "2024-03-01"):
        _touch(f"{tmp}/{d.replace('-', '/')}/00.csv")
    days = lambda a, b: sorted(str(r["file_date"]) for r in L.list_hourly_logs(spark, tmp, a, b).collect())
    assert days("2023-12-30", "2024-02-29") == ["2023-12-30", "2024-01-01", "2024-02-29"]
    assert days("2024-01-02", "2024-02-28") == [] and days("2024-03-01", "2024-03-01") == ["2024-03-01"]
    assert L.list_hourly_logs(spark, f"{tmp}/none", "2024-01-01").count() == 0
    assert L.list_plate_logs(spark, f"{tmp}/none", "2024-01-01", "2025-01-01").count() == 0


def test_ingest_run_after_midnight_still_sees_the_previous_day(spark, tmp):
    src = os.path.join(tmp, "src")
    write_hourly(src, "2024-01-04", 23, [row(time="23:59:00")])
    write_hourly(src, "2024-01-05", 0, [row(time="00:01:00")])
    write_hourly(src, "2024-01-03", 23, [row(time="23:00:00")])
    job = IngestJob(spark, IngestConfig(src, f"{tmp}/t", f"{tmp}/s"))
    assert sorted(r["file_key"][-11:] for r in job.changed_files("2024-01-05 00:05:00").collect()) == ["20240104_23", "20240105_00"]


def test_audit_files_include_the_following_day(spark, tmp):
    for d in ("2024-01-31", "2024-02-01", "2024-02-02"):
        write_plate(tmp, d, [("2024/01/31 10:00:00", "1")])
    got = L.select_plate_audit_files(L.list_plate_logs(spark, tmp, "2024-01-31", "2024-02-01"), "2024-01-31", "2024-01-31").collect()
    assert sorted(str(r["file_date"]) for r in got) == ["2024-01-31", "2024-02-01"]
