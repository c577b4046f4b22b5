"""Rows by month, counted by the job that they pass through."""

import json
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from loanlake.schemas import SNAPSHOT

#: Different months, with their tags, that a tally keeps apart, and that its sketch tracks while it counts.
MOST_ITEMS = 10_000
TRACKED = 1 << 16

Counts = dict[tuple[date | None, str], int]


class Tally:
    """Counts the rows of a DataFrame by month, and by a tag if one is given, when a job runs over it.

    The counts are a sketch of frequent items that is exact for as many items as it tracks; ``counts`` is None where it
    had to give up. A job whose tasks were repeated after their executor was lost may have counted rows twice, so what
    was written is compared with the files; see ``Lake.publish``.
    """

    def __init__(self, tag: Column | None = None):
        self._tag = None if tag is None else F.coalesce(tag.cast("string"), F.lit(""))
        self._observation = Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        n = F.count("*").alias("n")
        if self._tag is None:  # dates are counted at a seventh of what text costs
            found = F.to_json(F.expr(f"approx_top_k({SNAPSHOT}, {MOST_ITEMS}, {TRACKED})"))
            return df.observe(self._observation, found.alias("items"), F.count(SNAPSHOT).alias("dated"), n)
        month = F.coalesce(F.col(SNAPSHOT).cast("string"), F.lit(""))
        df = df.withColumn("_item", F.concat_ws("|", month, self._tag))
        found = F.to_json(F.expr(f"approx_top_k(_item, {MOST_ITEMS}, {TRACKED})"))
        return df.observe(self._observation, found.alias("items"), n).drop("_item")

    def counts(self) -> Counts | None:
        """Once the job has ended. Where the optimizer has found that there are no rows, nothing was counted."""
        try:
            found = self._observation.get
        except Py4JJavaError as none:
            if "AssertionError" not in str(none.java_exception):
                raise
            return {}
        items = json.loads(found.get("items") or "[]")
        if self._tag is None:
            return _of_dates(items, found.get("dated") or 0, found.get("n") or 0)
        if sum(item["count"] for item in items) != (found.get("n") or 0):
            return None
        out: Counts = {}
        for item in items:
            month, tag = item["item"].split("|", 1)
            out[date.fromisoformat(month) if month else None, tag] = item["count"]
        return out


def _of_dates(items: list[dict], dated: int, n: int) -> Counts | None:
    """Counts of months, of which a sketch tells those that are no NULL."""
    out: Counts = {(date.fromisoformat(item["item"]), ""): item["count"] for item in items if "item" in item}
    if sum(out.values()) != dated:
        return None
    return out | {(None, ""): n - dated} if n > dated else out
