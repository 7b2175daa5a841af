"""Every query on empty tables and on tables of nulls: no crash, and nothing made of nothing."""

import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
#: Queries that give rows without data: totals, fixed dimensions, one-row figures.
ROWS = {"kpi_by_nation_rollup", "pipeline_pivot", "coverage_diff", "partition_check", "record_gate", "corpus_measurements", "permit_slots", "badge_agreement", "payload_gate", "document_consistency", "isolated_events", "kpi_by_district", "pipeline_idle"}


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    out = {}
    for kind in ("empty", "nulls"):
        base = tmp_path_factory.mktemp(kind)
        for f in os.listdir(SF):
            df = spark.read.parquet(f"{SF}/{f}")
            none = df.limit(3).selectExpr(*[f"cast(null as {t}) as `{c}`" for c, t in df.dtypes])
            (df.limit(0) if kind == "empty" else none).write.parquet(f"{base}/{f}")
        out[kind] = str(base)
    return out


@pytest.mark.parametrize("kind", ["empty", "nulls"])
@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, folders, kind, name):
    rows = entry.queries()[name](spark, folders[kind]).collect()
    if kind == "empty" and name not in ROWS:
        assert not rows
