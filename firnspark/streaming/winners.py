"""The newest publication of every region and day, kept current by a stateful stream.

The stream is keyed by region and month.  The state of a key holds, for each of its days, when
the newest bulletin was published and analysed; a bulletin that is older than that is dropped
when it arrives, so late corrections may come in any order.  Equal times are settled by a hash of
the row, as in ``tables.latest_publication``.  State goes ``keep`` after the last news of its month; a
bulletin that comes even later is compared with the stored table instead, which every batch is merged into, so the
table is right with or without the state.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from firnspark.operators import tables
from firnspark.operators.lookup import within
from firnspark.session import materialise
from firnspark.sources.storage import read_table, replace_partitions

if TYPE_CHECKING:
    import pandas as pd

# State with a time to live needs this store; without the second setting a run that ends when all is read would go on
# for ever with empty batches that only look for state to drop.
STREAMING = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
ORDER = ["sort_published", "sort_analysed", "sort_tie"]
DAY = "sort_day"
STATE = "days array<bigint>, published array<bigint>, analysed array<bigint>, tie array<bigint>"
FOLDER = "folder_date"
KEEP = dt.timedelta(days=400)


class NewestBulletins(StatefulProcessor):
    """Passes on the bulletins that are newer than all before of their region and day."""

    def __init__(self, columns: list[str], keep: dt.timedelta = KEEP) -> None:
        self.columns, self.keep = columns, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", STATE, int(self.keep.total_seconds() * 1000))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        import pandas as pd

        held = self.newest.get() if self.newest.exists() else ([], [], [], [])
        newest = {day: order for day, *order in zip(*held, strict=True)}
        # At most one row a day of the month.
        fresh: dict[int, pd.DataFrame] = {}
        for part in rows:
            part = part.sort_values(ORDER, kind="stable").drop_duplicates(DAY, keep="last")
            for at, (day, *order) in enumerate(zip(*(part[c].tolist() for c in [DAY, *ORDER]), strict=True)):
                if day not in newest or order > newest[day]:
                    newest[day], fresh[day] = order, part.iloc[[at]]
        if fresh:
            self.newest.update((list(newest), *(list(c) for c in zip(*newest.values(), strict=True))))
            yield pd.concat(list(fresh.values()))[self.columns]

    def close(self) -> None:
        pass


def newest_stream(rows: DataFrame, keep: dt.timedelta = KEEP) -> DataFrame:
    """A stream of the bulletins that are newer than all before of their region and day."""
    least = F.lit(-(2**63)).cast("bigint")
    ordered = rows.withColumns(
        {
            "state_month": F.trunc("forecast_date", "month"),
            DAY: F.unix_date("forecast_date"),
            "sort_published": F.coalesce(F.unix_micros("publish_datetime"), least),
            "sort_analysed": F.coalesce(F.unix_micros("analysis_datetime"), least),
            "sort_tie": F.xxhash64(*sorted(rows.columns)),
        }
    )
    return ordered.groupBy("region_id", "state_month").transformWithStateInPandas(
        NewestBulletins(rows.columns, keep), T.StructType(rows.schema.fields), "Append", "ProcessingTime"
    )


def store_newest(spark: SparkSession, batch: DataFrame, path: str) -> None:
    """Merge bulletins into the stored winners, one folder a month; a batch done twice changes nothing."""
    incoming = materialise(batch.withColumn(FOLDER, F.trunc("forecast_date", "month")))
    requested = materialise(incoming.select(*tables.KEYS, FOLDER).distinct())
    stored = read_table(spark, path, incoming.schema)
    rows = incoming
    if stored is not None:
        rows = rows.unionByName(within(stored, requested, [*tables.KEYS, FOLDER]).select(*incoming.columns))
    # The folder follows from the day, so it does not change the order of equal times.
    newest = tables.latest_publication(rows.drop(FOLDER)).withColumn(FOLDER, F.trunc("forecast_date", "month"))
    replace_partitions(newest, path, requested, [*tables.KEYS, FOLDER], [FOLDER])


def run_winners(spark: SparkSession, source: str, schema: str | T.StructType, path: str, checkpoint: str, keep: dt.timedelta = KEEP) -> None:
    """Process all bulletins below ``source`` (Parquet) that the checkpoint has not seen, then stop."""
    before = {key: spark.conf.get(key, None) for key in STREAMING}
    for key, value in STREAMING.items():
        spark.conf.set(key, value)
    rows = spark.readStream.schema(schema).parquet(source)

    def store(batch: DataFrame, _: int) -> None:
        store_newest(batch.sparkSession, batch, path)

    query = (
        newest_stream(rows, keep)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
