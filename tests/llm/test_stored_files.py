"""Files of stored steps."""

import pyarrow.parquet as pq

from purchlake.llm.common import stored


def test_stored_steps_are_packed_well(spark):
    """They stay while later steps shuffle, so they are to be small."""
    df = stored(spark.range(100).selectExpr("id", "concat('text ', id) AS text"), "test-codec")
    path = df.inputFiles()[0].removeprefix("file://")
    row = pq.ParquetFile(path).metadata.row_group(0)
    assert {row.column(i).compression for i in range(row.num_columns)} == {"ZSTD"}
    assert df.count() == 100 and spark.conf.get("spark.sql.parquet.compression.codec") != "zstd"
