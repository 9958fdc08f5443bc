"""Cohort state (A4, A6, R13): retention from a per-user table and the day's traffic.

The report needs each user's first date and active weeks. Those are kept as a table
of one fixed-width row a user, so a run reads the new days and the state instead of
all history. The state is a snapshot set: a merge writes the new state beside the
old one and publishes it by one commit, with the names of the merged parts, so a
killed merge leaves the old state and can be run again. Minimum and bit union make
merges independent of order, and a part that is merged twice changes nothing; rows
that were withdrawn from a day need ``rebuild``.

The state is written in ``buckets`` folders by the hash of the user, and a merge
rewrites only the buckets that the new rows reach.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficlens.operators import filters as flt
from trafficlens.operators.retention import matrix_of, members_of, merge_user_weeks, user_weeks
from trafficlens.params import ReportParams
from trafficlens.sinks.snapshots import Snapshot, SnapshotSet

STATE = T.StructType([T.StructField("dimension1", T.StringType()), T.StructField("first_date", T.DateType()),
                      T.StructField("weeks", T.LongType()), T.StructField("bucket", T.IntegerType())])


def cohort_traffic(traffic: DataFrame, p: ReportParams) -> DataFrame:
    """The rows that the report counts."""
    return flt.after_date(flt.url_contains(traffic, "landingpagepath", p.section), "date", p.retention_after)


class CohortState:
    """``buckets`` is fixed when the state is begun: about its bytes / 256 MB."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.versions, self.buckets = SnapshotSet(spark, root), buckets

    def merge(self, traffic: DataFrame, part: str) -> Snapshot:
        """Add the traffic of a part (a day, a range of days)."""
        base = self.versions.snapshot()
        new = user_weeks(traffic).withColumn("bucket", self._bucket())
        reached = sorted(r[0] for r in new.select("bucket").distinct().collect())  # at most ``buckets``
        known = base.table(STATE, "bucket").where(F.col("bucket").isin(reached))
        merged = merge_user_weeks(known.drop("bucket"), new.drop("bucket")).withColumn("bucket", self._bucket())
        return self.versions.replace(base, merged, values=reached, column="bucket", info=self._parts(base, part))

    def rebuild(self, traffic: DataFrame, part: str = "rebuild") -> Snapshot:
        """The state of these rows alone, in place of what there is."""
        base = self.versions.snapshot()
        return self.versions.replace(base, user_weeks(traffic).withColumn("bucket", self._bucket()),
                                     values=range(self.buckets), column="bucket", info={"parts": part})

    def parts(self) -> list[str]:
        """The parts merged so far, in order."""
        return [x for x in self.versions.snapshot().info.get("parts", "").split(" ") if x]

    def users(self) -> DataFrame:
        return self.versions.snapshot().table(STATE, "bucket").drop("bucket")

    def retention(self, p: ReportParams) -> DataFrame:
        """R13 from the state: no traffic is read, and users are not shuffled again
        before they are counted."""
        return matrix_of(members_of(self.users(), week52_year=p.retention_week52_year), p.retention_max_age)

    def _bucket(self):
        return F.pmod(F.xxhash64("dimension1"), F.lit(self.buckets)).cast("int")

    def _parts(self, base: Snapshot, part: str) -> dict[str, str]:
        return {"parts": " ".join([*base.info.get("parts", "").split(), part])}
