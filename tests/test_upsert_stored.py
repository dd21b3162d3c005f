"""The first batch of the merge is cleaned once and stored."""

from legwise.plans.catalog import QUERIES
from conftest import SF_SMALL


def test_first_batch_is_stored_once(spark):
    df = QUERIES["incremental_upsert"](spark, SF_SMALL)
    assert any("upsert-stored" in f for f in df.inputFiles())
    assert df.count() == df.select("trip_date", "row_hash").distinct().count() > 0
