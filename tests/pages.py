"""Small page logs for the tests."""

from pyspark.sql.types import LongType, StructField, StructType

from tidemart import schemas

PAGES = StructType([StructField("event_id", LongType()), *schemas.PAGE_LOG.fields])


def page(number, mid, ts, last=None, is_new="0", item="1", page_id="home", shown=0, during=5):
    return (
        number, (mid, "v", "c", "a", is_new), (page_id, last, item, "sku_id", during),
        [(str(n), "sku_id") for n in range(shown)], ts,
    )


def frame(spark, rows):
    return spark.createDataFrame(rows, PAGES)
