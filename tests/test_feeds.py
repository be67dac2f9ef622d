"""Tables kept between catalog queries belong to the files they came from."""

from __future__ import annotations

import os
import shutil

import pytest

from tidelake.catalog import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="given tables not present")
def test_changed_files_under_the_same_name_are_seen(spark, tmp_path):
    shutil.copytree(SF, tmp_path / "data")
    place = str(tmp_path / "data")
    before = QUERIES["scan_lake"](spark, place).count()
    events = spark.read.parquet(f"{place}/events.parquet")
    events.limit(100).coalesce(1).write.parquet(str(tmp_path / "fewer"))
    (tmp_path / "data" / "events.parquet").unlink()
    shutil.copytree(tmp_path / "fewer", tmp_path / "data" / "events.parquet")
    after = QUERIES["scan_lake"](spark, place).count()
    assert 100 <= after < before
