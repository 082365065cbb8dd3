"""Session facts kept day by day (A02's source), without a full refresh.

``partials`` holds, by day, the aggregates of the day's part of each session;
all of them merge (sums, minima, maxima, category sets).  ``facts`` holds one
row for each session, by the day of its last event.  An update brings whole
days: it aggregates their staged rows once, takes up what the sessions in them
have on the neighbouring days, and writes anew only the partitions of the days
where such sessions may lie.  A day that is brought again replaces its earlier
state, so late data and repeated runs are the same as a first run.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.operators.sessions import _MERGE, FUNNEL_FLAGS, SESSION, session_features, session_funnel, session_level

DAY, LAST, USER = "event_date", "last_date", "user_pseudo_id"
_KEY = [SESSION, USER]


def session_partials(stg: DataFrame) -> DataFrame:
    """``session_features`` of each day apart; the days of one session merge with ``merge_partials``."""
    days = stg.withColumn(USER, F.struct(USER, DAY))  # features group by session and user; the day goes along with the latter
    made = session_features(days)
    return made.select(SESSION, F.col(f"{USER}.{USER}").alias(USER), *[c for c in made.columns if c not in _KEY], F.col(f"{USER}.{DAY}").alias(DAY))


def merge_partials(rows: DataFrame, *more) -> DataFrame:
    """One row for each (session, user) of partial rows; ``more`` are further aggregates."""
    maxima = [c for c, _ in FUNNEL_FLAGS] + ["has_search"]
    aggs = []
    for c in rows.columns:
        if c == "viewed_categories":
            # One set for each day of the session, each bounded by the category taxonomy.
            aggs.append(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c))
        elif c in maxima or c in _MERGE:
            aggs.append((F.max if c in maxima else _MERGE[c])(c).alias(c))
    return rows.groupBy(*_KEY).agg(*aggs, *more)


def _near(days: set[str], span: int) -> set[str]:
    """All dates at most ``span`` days from one of ``days`` (YYYYMMDD)."""
    step = datetime.timedelta(days=1)
    parsed = [datetime.datetime.strptime(d, "%Y%m%d") for d in days]
    return {(d + k * step).strftime("%Y%m%d") for d in parsed for k in range(-span, span + 1)}


class SessionFacts:
    """Session facts under ``path`` in a folder that all executors share.

    ``max_span_days``: how many days after its first event a session's last
    one can be (1: it may go over midnight once).  A keyed session that
    reaches further raises an error when an update sees it, instead of giving
    a wrong row.  Rows without a session id stay with their day and are merged
    by user when read.
    """

    def __init__(self, spark: SparkSession, path: str, max_span_days: int = 1):
        self.spark, self.path, self.span = spark, path.rstrip("/"), max_span_days

    # -------------------------------------------------------------- files
    def _fs(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop

    def days(self, table: str) -> set[str]:
        """The partition values of a table, from its folder's listing."""
        fs, folder = self._fs(f"{self.path}/{table}")
        if not fs.exists(folder):
            return set()
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return {n.partition("=")[2] for n in names if "=" in n}

    def _schema(self, column: str) -> str:
        made = self.spark.createDataFrame([], self.stg_schema)
        fields = [f for f in session_partials(made).schema.fields if f.name != DAY]
        return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"`{column}` string"])

    def _read(self, table: str, column: str, days: set[str] | None = None) -> DataFrame:
        """Rows of the given days only (partition pruning); all days without."""
        schema = self._schema(column)
        there = self.days(table)
        if not there:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/{table}")
        return rows if days is None else rows.where(F.col(column).isin(sorted(there & days)))

    def _replace(self, rows: DataFrame, table: str, column: str, days: set[str]) -> None:
        """Partitions ``days`` of a table become ``rows``; a day without rows loses its partition."""
        target = f"{self.path}/{table}"
        (rows.hint("rebalance", column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(target))
        left = {r[0] for r in rows.select(column).distinct().collect()}  # one for each day of the update
        for day in sorted(days - left):
            fs, folder = self._fs(f"{target}/{column}={day}")
            if fs.exists(folder):
                fs.delete(folder, True)

    # -------------------------------------------------------------- update and read
    def update(self, stg: DataFrame) -> dict[str, set[str]]:
        """Takes up the staged rows of whole days.  Returns the days brought, and the days whose facts were written anew."""
        self.stg_schema = stg.schema
        run = f"{self.path}/run-{uuid.uuid4().hex}"
        session_partials(stg).hint("rebalance", DAY).write.partitionBy(DAY).parquet(f"{run}/partials")
        new = self.spark.read.schema(self._schema(DAY)).parquet(f"{run}/partials")
        brought = {r[0] for r in new.select(DAY).distinct().collect()}
        if not brought:
            return {"brought": set(), "written": set()}
        around = _near(brought, self.span) - brought
        keyed = F.col(SESSION).isNotNull()

        # Sessions of the days now, and those that were in them before.
        was = self._read("partials", DAY, brought).where(keyed).select(*_KEY)
        touched = new.where(keyed).select(*_KEY).unionByName(was).distinct()
        beside = self._read("partials", DAY, around).where(keyed).join(touched, _KEY, "left_semi")
        days = F.to_date(DAY, "yyyyMMdd")
        merged = merge_partials(new.where(keyed).unionByName(beside), F.max(DAY).alias(LAST), F.datediff(F.max(days), F.min(days)).alias("_span"))
        old = self._read("facts", LAST, around | brought)
        kept = old.where(keyed).join(touched, _KEY, "left_anti").unionByName(old.where(~keyed & ~F.col(LAST).isin(sorted(brought))))
        unkeyed = new.where(~keyed).withColumnRenamed(DAY, LAST)
        whole = merged.unionByName(kept.unionByName(unkeyed).withColumn("_span", F.lit(0)))
        whole.write.parquet(f"{run}/facts")
        whole = self.spark.read.schema(whole.schema).parquet(f"{run}/facts")
        if (far := whole.where(F.col("_span") > self.span).select(SESSION).first()) is not None:
            raise ValueError(f"session {far[0]} reaches over more than {self.span} day(s): set max_span_days")

        # Facts first: if the run is cut off here, the same update can be run again from the old partials.
        written = (around | brought) & (self.days("facts") | brought)
        self._replace(whole.drop("_span"), "facts", LAST, written)
        self._replace(new, "partials", DAY, brought)
        fs, folder = self._fs(run)
        fs.delete(folder, True)
        return {"brought": brought, "written": written}

    def read(self) -> DataFrame:
        """All facts, as ``session_features`` of all staged rows would give them (category sets in order)."""
        rows = self._read("facts", LAST).drop(LAST)
        unkeyed = merge_partials(rows.where(F.col(SESSION).isNull()))
        return rows.where(F.col(SESSION).isNotNull()).unionByName(unkeyed.select(*rows.columns))


def facts_in_halves(stg: DataFrame, path: str) -> DataFrame:
    """The session facts built under ``path`` from two halves of the days, the second as an update; A02 and the sums of each session."""
    days = sorted(r[0] for r in stg.select("event_date").distinct().collect())  # one for each day
    facts = SessionFacts(stg.sparkSession, path)
    for half in (days[:len(days) // 2], days[len(days) // 2:]):
        facts.update(stg.where(F.col("event_date").isin(half)))
    level = session_level(facts.read())
    return session_funnel(sessions=level).join(
        level.select(F.col(SESSION).alias("_sid"), "path_length", "total_items_viewed", F.size("viewed_categories").cast("bigint").alias("categories"),
                     "purchased_at", "total_revenue"), F.col(SESSION).eqNullSafe(F.col("_sid"))).drop("_sid")
