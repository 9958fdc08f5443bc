"""Distinct counts from a per-day state.

A count of distinct users needs every (group, user) pair again at each run. Here a
merge of new days turns them into bitmaps, and reports only unite bitmaps:

* ``dictionary``: user -> number, in hashed buckets. A user gets the next free number
  of their bucket when first seen and keeps it.
* ``days``: per date, group columns and block of numbers, the bitmap of the users seen
  (Spark's ``bitmap_*`` functions: 32,768 users in 4 KB).

Counts stay exact: a bitmap holds one bit a user, and the union of days does not count
anyone twice. Both tables are snapshot sets. A merge publishes the dictionary first,
then the days, so a crash between the two leaves numbers that no day uses yet; a
merge that is run again, or days that come late, in any order or twice, change nothing
but what is new, because union does not mind repetition. Rows that were withdrawn from
a day need ``replace=True``. A NULL user is not counted, as in ``COUNT(DISTINCT)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficlens.sinks.snapshots import Snapshot, SnapshotSet

BLOCK = 32768        # numbers in a bitmap of Spark's bitmap functions
BUCKET_SPAN = 40     # bits: numbers of bucket b begin at b << BUCKET_SPAN

DICTIONARY = T.StructType([T.StructField("user", T.StringType()), T.StructField("number", T.LongType()),
                           T.StructField("bucket", T.IntegerType())])


class DistinctState:
    """``keys``: group columns and their types, in the rows beside ``date`` and the user.
    ``buckets`` is fixed when the state is begun: about the dictionary's bytes / 256 MB."""

    def __init__(self, spark: SparkSession, root: str, keys: dict[str, T.DataType] | None = None, buckets: int = 64):
        self.spark, self.buckets, self.keys = spark, buckets, dict(keys or {})
        self.dictionary = SnapshotSet(spark, f"{root.rstrip('/')}/dictionary")
        self.days = SnapshotSet(spark, f"{root.rstrip('/')}/days")
        self.schema = T.StructType([T.StructField(k, t) for k, t in self.keys.items()]
                                   + [T.StructField("block", T.LongType()), T.StructField("users", T.BinaryType()),
                                      T.StructField("date", T.DateType())])

    # ------------------------------------------------------------------ writing
    def merge(self, rows: DataFrame, user: str, replace: bool = False) -> Snapshot:
        """Add rows (``date``, the keys, the user). Only the dates and dictionary
        buckets that they reach are read and written. ``replace`` puts the rows in
        place of what their dates held."""
        # One row a (date, group, user) crosses the network, collapsed map-side.
        seen = (rows.where(F.col(user).isNotNull() & F.col("date").isNotNull())
                .select("date", *self.keys, F.col(user).cast("string").alias("user")).distinct()
                .withColumn("bucket", self._bucket()))
        numbers = self._numbered(seen)
        dates = [r[0].isoformat() for r in rows.where(F.col("date").isNotNull()).select("date").distinct().collect()]
        base = self.days.snapshot()
        group = ["date", *self.keys, "block"]
        new = (seen.join(numbers, ["bucket", "user"])
               .withColumn("block", F.bitmap_bucket_number("number"))
               .groupBy(*group).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("users")))
        if not replace:
            known = base.table(self.schema).where(F.col("date").isin([F.to_date(F.lit(x)) for x in dates]))
            new = new.select(*self.schema.names).unionByName(known).groupBy(*group) \
                .agg(F.bitmap_or_agg("users").alias("users"))
        return self.days.replace(base, new, values=dates)

    def _numbered(self, seen: DataFrame) -> DataFrame:
        """The dictionary of the reached buckets, after new users were added to it."""
        base = self.dictionary.snapshot()
        users = seen.select("bucket", "user").distinct()
        reached = sorted(r[0] for r in users.select("bucket").distinct().collect())  # at most ``buckets``
        known = base.table(DICTIONARY, "bucket").where(F.col("bucket").isin(reached))
        last = known.groupBy("bucket").agg(F.max("number").alias("last"))  # one row a bucket
        fresh = users.join(known, ["bucket", "user"], "left_anti")
        place = F.row_number().over(Window.partitionBy("bucket").orderBy("user"))
        start = F.shiftleft(F.col("bucket").cast("bigint"), BUCKET_SPAN)
        added = (fresh.withColumn("place", place).join(last, "bucket", "left")
                 .select("user", (F.coalesce(F.col("last"), start) + F.col("place")).alias("number"), "bucket"))
        after = self.dictionary.replace(base, known.select(*DICTIONARY.names).unionByName(added),
                                        values=reached, column="bucket")
        return after.table(DICTIONARY, "bucket").where(F.col("bucket").isin(reached))

    # ------------------------------------------------------------------ reading
    def counts(self, by: Sequence[Column], name: str, where: Column | None = None) -> DataFrame:
        """Distinct users per group of ``by`` (expressions over ``date`` and the keys).
        Bitmaps are united map-side; one row a (group, block) crosses the network."""
        days = self.days.snapshot().table(self.schema)
        if where is not None:
            days = days.where(where)
        names = [f"_g{i}" for i in range(len(by))]
        days = days.select(*[c.alias(n) for c, n in zip(by, names, strict=True)], "block", "users")
        blocks = days.groupBy(*names, "block").agg(F.bitmap_count(F.bitmap_or_agg("users")).alias("n"))
        return blocks.groupBy(*names).agg(F.sum("n").alias(name))

    def users(self) -> DataFrame:
        return self.dictionary.snapshot().table(DICTIONARY, "bucket").drop("bucket")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("user"), F.lit(self.buckets)).cast("int")
