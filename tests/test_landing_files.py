"""Deliveries are landed in files that may be loaded, whatever their size."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from brookledger import catalog
from brookledger.sources import bronze, landing

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def small_limit(monkeypatch):
    """A size limit well below the size of a delivery."""
    limit = 0.01
    for place in (bronze.read_extract, landing.manifest):
        monkeypatch.setitem(place.__kwdefaults__, "max_mb", limit)
    monkeypatch.setattr(catalog, "LANDING_FILE_MB", limit / 4, raising=False)
    return limit


def test_large_deliveries_are_landed_whole(spark, small_limit):
    rows = {e: catalog.SampleBronze(spark, SF_DIR).first(e).count() for e in catalog.ENTITIES}
    got = catalog.bronze_checksums(spark, SF_DIR).collect()
    assert len(got) == rows["accounts"] and all(r["checksum_confirmed"] and r["file_named"] for r in got)
    listed = {r["entity"]: r for r in catalog.landing_manifest(spark, SF_DIR).where("status = 'SUCCESS'").collect()}
    assert {e: r["data_rows"] for e, r in listed.items()} == rows and listed["accounts"]["files"] > 2
    totals = catalog.landing_manifest_totals(spark, SF_DIR).collect()
    assert {r["entity"]: r["failed"] for r in totals} == {e: int(e == "accounts") for e in rows}


def test_csv_bytes_bound_the_files(spark, tmp_path):
    rows = catalog.SampleBronze(spark, SF_DIR).first("accounts")
    landing.land_csv(landing.in_files(rows, file_mb=1), str(tmp_path), "accounts", catalog.LANDING_DAY)
    size, n = landing.listing(spark, str(tmp_path)).agg(F.sum("length"), F.count("*")).first()
    assert n == 2 and size / 2 < landing.csv_bytes(rows) and size < landing.csv_bytes(rows) + 2000
