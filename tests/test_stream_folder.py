"""The stream queries read ``events`` whether it is one file or a folder of part files."""

import pytest
from conftest import listed

from millrace.plans import PLANS, Tables

SMALL = "/root/testdata/sf0.001"
STREAMS = sorted(name for name in PLANS if name.startswith("stream_") or name == "unified_batch_stream")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.read.parquet(f"{SMALL}/events.parquet").repartition(3).write.parquet(f"{path}/events.parquet")
    return path


@pytest.mark.parametrize("name", STREAMS)
def test_part_files_give_the_rows_of_one_file(spark, folder, name):
    one, parts = (PLANS[name].build(Tables(spark, path)) for path in (SMALL, folder))
    got = listed(parts)
    assert got and got == listed(one)
