"""Structured Streaming over postings (STR1-STR3).

The ``events`` table stands in for a stream of postings: each event is a posting
to an account chosen by its type, amount ``round(value * 100)`` cents (FIXTURES F4).
The events are landed as files split by ``event_id % 5``, so every micro-batch
covers the whole month and batches arrive out of event-time order; corrections (every
7th event, value + 1) are a later version of their events.

* STR1 ``stream_append`` — file source with a fixed schema, ``availableNow``
  trigger, Parquet file sink: the checkpoint is the watermark table, and the
  sink's commit log makes retries exactly-once.
* STR2 ``stream_merge`` — ``foreachBatch`` appends each micro-batch to a change log; the table
  is the row of the highest source version of each key.  Nothing is rewritten, and
  neither the order of batches nor a replay changes the table.  ``compact`` folds the log into
  a base version, committed beside concurrent readers and writers.
* STR3 ``stream_flash`` — daily activity per account as partial sums of each micro-batch, which
  readers add up; no state is kept in the query, so no delay bounds how late a
  posting may be.  Rows more than ``lateness`` behind the event time seen in earlier batches
  count like all others and are recorded in a side table as well.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import ntz_literal
from ..operators import ingest as IG
from ..session import shared_dir
from ..sources.adapter import cents_to_amount, read_source
from ..sources.commits import CommitConflict, commit, commits, present

# --- Fixed values: event type -> posting account ------------------------------------
EVENT_ACCOUNTS = [
    ("click", "51910"),
    ("error", "58400"),
    ("purchase", "33100"),
    ("signup", "34000"),
    ("view", "35000"),
]
SPLIT_FILES = 5
CORRECTION_EVERY = 7
#: ``version`` is the source's order of the changes of one event.
EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()), T.StructField("version", T.IntegerType()),
])


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder (never a machine-local one)."""
    return f"{shared_dir(spark)}/ledgerlake/scratch/{name}-{uuid.uuid4().hex}"


def land_events(spark: SparkSession, sf_dir: str, path: str, corrections: bool = True, only: int | None = None) -> None:
    """Write the events into folders by ``event_id % 5``, corrections into one more (or
    the rows of one folder, ``only``).  One scan, no shuffle; the stream reads the folder."""
    ev = read_source(spark, sf_dir, "events").withColumn("version", F.lit(0))
    bucket = (F.col("event_id") % SPLIT_FILES).cast("int")
    own = F.array(F.struct(F.col("value"), F.col("version"), bucket.alias("bucket")))
    if corrections:
        fix = F.struct((F.col("value") + 1).alias("value"), F.lit(1).alias("version"), F.lit(SPLIT_FILES).alias("bucket"))
        own = F.when(F.col("event_id") % CORRECTION_EVERY == 0, F.concat(own, F.array(fix))).otherwise(own)
    keep = [c for c in ev.columns if c not in ("value", "version")]
    rows = ev.select(*keep, F.inline(own))
    if only is not None:
        rows = rows.where(F.col("bucket") == only)
    rows.write.mode("append").partitionBy("bucket").parquet(path)


def postings(events: DataFrame) -> DataFrame:
    """Event -> posting: account by type, exact cents, DECIMAL amount."""
    acc = F.col("event_type")
    expr = None
    for t, a in EVENT_ACCOUNTS:
        expr = F.when(acc == t, F.lit(a)) if expr is None else expr.when(acc == t, F.lit(a))
    cents = F.round(F.col("value") * 100).cast("bigint")
    return events.select("event_id", "version", "ts", "event_type", expr.alias("account"), cents.alias("cents"),
                         cents_to_amount(cents).alias("amount"))


def read_stream(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    return (spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", files_per_batch)
            .option("recursiveFileLookup", "true").parquet(path))


def stream_append(spark: SparkSession, source: str, sink: str, checkpoint: str) -> None:
    """STR1: append every posting to a Parquet sink, exactly once."""
    q = (postings(read_stream(spark, source)).writeStream.format("parquet")
         .option("path", sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def _tag(checkpoint: str) -> str:
    """Names the batches of one checkpoint: a replay of a batch replaces itself, a stream
    that starts over with another checkpoint adds parts of its own."""
    return hashlib.sha1(checkpoint.encode()).hexdigest()[:12]


def _write_part(df: DataFrame, path: str, part: str) -> None:
    """One part of an append-only table; written again, it replaces itself."""
    df.withColumn("part", F.lit(part)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("part").parquet(path)


def latest_rows(log: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The table that a change log stands for: per key the values of its highest ``order``.

    A change delivered more than once counts once, by its earliest delivery.  Added is the
    first delivery of the key; modified and run are those of the last change whose
    values differ from the change before it (NULL equals '' and 0)."""
    stamps = [IG.MODIFIED, IG.RUN, IG.ADDED]
    values = [c for c in log.columns if c not in (*keys, order, *stamps, "part")]
    one = log.groupBy(*keys, order).agg(F.min(F.struct(*stamps, *values)).alias("r")).select(*keys, order, "r.*")
    before = one.select("*", *[F.lag(c).over(Window.partitionBy(*keys).orderBy(order)).alias(f"t_{c}") for c in values],
                        F.lag(F.lit(1)).over(Window.partitionBy(*keys).orderBy(order)).alias("had"))
    now = before.select(*keys, order, *stamps, *[F.col(c).alias(f"s_{c}") for c in values], *[f"t_{c}" for c in values], "had")
    changed = F.col("had").isNull() | IG.change_predicate(values, one.select(*values).schema)
    last = now.groupBy(*keys).agg(
        F.max_by(F.struct(order, *[F.col(f"s_{c}").alias(c) for c in values]), order).alias("v"), F.min(IG.ADDED).alias(IG.ADDED),
        F.max_by(F.when(changed, F.struct(IG.MODIFIED, IG.RUN)), F.when(changed, F.col(order))).alias("m"))
    return last.select(*keys, "v.*", IG.ADDED, f"m.{IG.MODIFIED}", f"m.{IG.RUN}")


def read_table(spark: SparkSession, root: str, keys: Sequence[str], order: str) -> DataFrame:
    """The current rows: the newest base version and the parts of the log it does not cover."""
    rows = spark.read.parquet(f"{root}/log")
    base = commits(spark, root)
    if base:
        covered = spark.read.parquet(f"{base[-1].path}/covered")
        tail = rows.join(covered, "part", "left_anti").drop("part")
        rows = tail.unionByName(spark.read.parquet(f"{base[-1].path}/rows"))
    else:
        rows = rows.drop("part")
    return latest_rows(rows, keys, order)


def compact(spark: SparkSession, root: str, keys: Sequence[str], order: str) -> None:
    """Fold the parts of the log that are there now into a base version.  Parts written
    meanwhile stay in the log; of two compactions at a time one commits.  Old files remain for
    readers that began before."""
    base = commits(spark, root)
    path = f"{root}/v={len(base) + 1}/{uuid.uuid4().hex}"
    log = spark.read.parquet(f"{root}/log")  # lists the parts once: rows and covered agree
    parts = log.select("part").distinct()
    rows = log
    if base:
        old = spark.read.parquet(f"{base[-1].path}/covered")
        rows = log.join(old, "part", "left_anti")
        parts = parts.unionByName(old).distinct()
    rows = rows.drop("part")
    if base:
        rows = rows.unionByName(spark.read.parquet(f"{base[-1].path}/rows"))
    latest_rows(rows, keys, order).select(*rows.columns).write.parquet(f"{path}/rows")
    parts.write.parquet(f"{path}/covered")
    try:
        commit(spark, root, str(len(base) + 1), path, len(base) - 1)
    except CommitConflict:
        pass  # the other one's base covers at least what was there when it read


def stream_merge(spark: SparkSession, source: str, root: str, checkpoint: str, now, files_per_batch: int = 1) -> None:
    """STR2: every micro-batch appended to the change log of the table at ``root``."""
    post = postings(read_stream(spark, source, files_per_batch)).select("event_id", "version", "ts", "account", "amount")
    tag = _tag(checkpoint)

    def each(batch: DataFrame, batch_id: int) -> None:
        run = f"{tag}-{batch_id}"
        stamped = batch.select("*", IG.ts(now).alias(IG.ADDED), IG.ts(now).alias(IG.MODIFIED), F.lit(run).alias(IG.RUN))
        _write_part(stamped, f"{root}/log", run)

    q = (post.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def merged(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, ["event_id"], "version")


def stream_flash(spark: SparkSession, source: str, sink: str, late_sink: str, checkpoint: str,
                 lateness: dt.timedelta = dt.timedelta(days=1), files_per_batch: int = 1) -> None:
    """STR3: partial sums of (day, account) per micro-batch in ``sink``, late rows in ``late_sink``.

    A batch's high-water mark is written with it, so a replayed batch sees the same marks
    and finds the same late rows.  Days are of the event time's wall clock."""
    post = postings(read_stream(spark, source, files_per_batch))
    tag, marks = _tag(checkpoint), f"{late_sink}_marks"

    def each(batch: DataFrame, batch_id: int) -> None:
        part = f"{tag}-{batch_id}"
        high = None
        if present(spark, marks):
            mine = spark.read.parquet(marks).where((F.col("tag") == tag) & (F.col("BatchId") < batch_id))
            high = mine.agg(F.max("HighWater")).first()[0]
        late = F.lit(False) if high is None else F.col("ts") < ntz_literal(high - lateness)
        _write_part(batch.groupBy(F.to_date("ts").alias("Day"), "account").agg(
            F.count(F.lit(1)).alias("Postings"), F.sum("cents").alias("cents"), F.count_if(late).alias("LatePostings")), sink, part)
        _write_part(batch.where(late).select("event_id", "ts", "account", "cents"), late_sink, part)
        _write_part(batch.agg(F.lit(tag).alias("tag"), F.lit(batch_id).cast("bigint").alias("BatchId"), F.max("ts").alias("HighWater")), marks, part)

    q = (post.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def flash(spark: SparkSession, sink: str) -> DataFrame:
    """The daily flash: partial sums of all batches added up."""
    return spark.read.parquet(sink).groupBy("Day", "account").agg(
        F.sum("Postings").alias("Postings"), F.sum("cents").alias("cents"), F.sum("LatePostings").alias("LatePostings"))


def late_rows(spark: SparkSession, late_sink: str) -> DataFrame:
    return spark.read.schema("event_id bigint, ts timestamp_ntz, account string, cents bigint, part string").parquet(late_sink).drop("part")
