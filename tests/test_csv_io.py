"""CSV event-log scan with a declared schema."""

from pyspark.sql import functions as F

from conftest import SF001
from rankloom import sources as src
from rankloom.session import scratch_path


def test_csv_event_log_scan(spark):
    path = scratch_path(spark, "events-csv")
    click = src.click_log(spark, SF001)
    click.repartition(2).write.option("header", True).csv(path)
    back = src.read_events_csv(spark, path)
    assert dict(back.dtypes) == {"timestamp": "bigint", "visitorid": "int", "event": "string",
                                 "itemid": "int", "transactionid": "bigint"}
    assert back.exceptAll(click).count() == 0 and back.count() == 1000
    assert back.filter(F.col("event") == "event").count() == 0
