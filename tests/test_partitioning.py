"""Results must not depend on the number of shuffle partitions or on AQE."""

import pytest

import __spark_entry__ as entry
from scripts.check_oracle import digest

SF = "/root/testdata/sf0.001"
NAMES = ["event_seq", "composite_key", "audit_all_lines", "missing_ids_text", "upsert_update",
         "late_rows_by_day"]


@pytest.mark.parametrize("name", NAMES)
def test_same_result_for_any_shuffle_layout(spark, name):
    seen = set()
    for parts, aqe in (("1", "false"), ("13", "false"), ("4", "true")):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.enabled", aqe)
        try:
            df = entry.queries()[name](spark, SF)
            seen.add(digest(df.columns, [tuple(r) for r in df.collect()])[0])
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
            spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(seen) == 1
