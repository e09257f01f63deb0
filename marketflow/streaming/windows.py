"""Event-time windows and ranked shops over a stream of clicks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.behavior import EVENT_DELAY, WINDOW_SIZE, ranked_shops, shop_windows, top_windows
from ..sinks.keyed import BatchFolders

RANKED_INPUT = "mt_wm_poi_id string, shop_name string, source string, platform string, dt string, hr string, mm string, action_num long"


def windowed(rows: DataFrame, delay: str = EVENT_DELAY, size: str = WINDOW_SIZE, by: Sequence[str] = ("mt_wm_poi_id",)) -> DataFrame:
    """Clicks per closed window. A window closes once an event ``delay`` past its end was seen; later rows are dropped."""
    return shop_windows(rows.withWatermark("event_time", delay), size, by)


class RankedShops:
    """A ``foreachBatch`` sink that keeps the top shops of all windows closed so far.

    The state is the ranked rows themselves, at most ``n`` per platform. A batch
    reads the folder of the batch before it, so a repeated batch finds its input
    unchanged. The folders belong to one checkpoint and are kept beside it.
    """

    def __init__(self, spark: SparkSession, path: str, n: int = 3):
        self.folders, self.n = BatchFolders(spark, path, RANKED_INPUT), n

    def __call__(self, windows: DataFrame, batch_id: int) -> None:
        fields = [f.split()[0] for f in RANKED_INPUT.split(", ")]
        rows = windows.select(*fields)
        if batch_id > 0:
            rows = rows.unionByName(self.folders.read(batch_id - 1))
        self.folders.write(top_windows(rows, self.n).select(*fields), batch_id)

    def result(self, batch_id: int) -> DataFrame:
        """The ranked sink rows after a batch."""
        return ranked_shops(self.folders.read(batch_id), self.n)
