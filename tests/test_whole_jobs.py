"""Queries that take every payer of their input."""

import glob

import pyarrow.parquet as pq
import pytest

from checks import queries
from checks.billing import billing
from checks.queries import q_streaming_intake


def test_streaming_intake_keeps_every_payer_of_the_files(spark):
    sf_dir = "/root/testdata/sf0.01"
    lines = billing(spark, sf_dir).groupBy("bill_payer_account_id").count()
    expected = {r.bill_payer_account_id: r["count"] for r in lines.collect()}
    assert "100000000024" in expected
    assert {r.payer_id: r.n_lines for r in q_streaming_intake(spark, sf_dir).collect()} == expected


@pytest.mark.parametrize("one_file", [True, False])
def test_exports_are_read_by_several_tasks(spark, sf_dir, tmp_path, monkeypatch, one_file):
    """A single export file has several row groups, or there are several files; all lines arrive."""
    monkeypatch.setattr(queries, "EXPORT_BLOCK", 4 << 10)
    lines = queries.exported_lines(spark, sf_dir)
    queries.export_lines(lines.repartition(3), str(tmp_path), one_file)
    files = glob.glob(f"{tmp_path}/part-*")
    assert len(files) == (1 if one_file else 3)
    assert all(pq.ParquetFile(f).num_row_groups > 1 for f in files)
    assert spark.read.parquet(str(tmp_path)).count() == lines.count() == billing(spark, sf_dir).count()
