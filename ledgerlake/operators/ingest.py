"""Ingest and table maintenance (SNK1-SNK11).

* ``merge_upsert`` — insert new keys, update only rows whose values differ (NULL
  equals '' and 0), never delete; one full outer join on the key (sort-merge,
  both sides shuffled on the key once; a target stored bucketed by the key skips
  its side of the shuffle).  The result is written as a new version directory
  and committed by a control row written last.
* ``capture_snapshot`` — changed rows in ``(previous, now]`` stamped with the
  Eastern calendar day; the capture log is append-only (one partition per capture
  run, overwritten on retry), and the snapshot table is its latest row per
  (SnapshotDate, key).
* run log operations: start, finish, fail, watermark choice, control seeding.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.commits import CommitConflict, commit, commits, drop_files, present, write_files

EASTERN = "America/New_York"
ADDED, MODIFIED, RUN = "DateAddedUtc", "DateModifiedUtc", "LastRunId"
COPY = "_StagedCopy"


def ts(value: dt.datetime) -> Column:
    """A UTC wall-clock literal (TIMESTAMP_NTZ, parsed from text, so neither the
    session nor the machine time zone is involved)."""
    from ..functions.columns import ntz_literal
    return ntz_literal(value)


# --- SNK2 / SNK3 / SNK1 / SNK4 --------------------------------------------------------

def change_predicate(cols: Sequence[str], schema: T.StructType, t: str = "t_", s: str = "s_") -> Column:
    """SNK2: OR of ``coalesce(target, '') <> coalesce(source, '')`` for text and
    ``coalesce(target, 0) <> coalesce(source, 0)`` for numbers, so NULL equals ''
    and 0 (not ``eqNullSafe``)."""
    def one(c: str) -> Column:
        dtype = schema[c].dataType
        if isinstance(dtype, T.StringType):
            empty = F.lit("")
        elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            empty = F.lit(None).cast(dtype)  # no blank value: NULL vs NULL is unchanged
            return ~F.col(t + c).eqNullSafe(F.col(s + c))
        else:
            empty = F.lit(0).cast(dtype)
        return F.coalesce(F.col(t + c), empty) != F.coalesce(F.col(s + c), empty)
    return reduce(lambda a, b: a | b, [one(c) for c in cols]) if cols else F.lit(False)


def validate_staged(staged: DataFrame, keys: Sequence[str]) -> None:
    """Raise before writing when staging holds NULL or duplicate keys (the target's
    key is NOT NULL and unique).  One aggregation over the staged keys."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    row = staged.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.max(any_null.cast("int")).alias("nul")).agg(
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).alias("dups"),
        F.coalesce(F.sum(F.when(F.col("nul") == 1, F.col("n"))), F.lit(0)).alias("nulls")).first()
    if row["nulls"]:
        raise ValueError(f"staging has {row['nulls']} row(s) with a NULL key")
    if row["dups"]:
        raise ValueError(f"staging has {row['dups']} duplicate key row(s)")


def merge_upsert(target: DataFrame, staged: DataFrame, keys: Sequence[str], run_id: str, now: dt.datetime,
                 value_cols: Sequence[str] | None = None, validate: bool = True) -> DataFrame:
    """SNK1 + SNK3: the merged table with audit stamps and a ``MergeAction`` column
    (INSERT, UPDATE, UNCHANGED, KEPT — the last for target rows absent from staging,
    which are never deleted).

    Target columns: keys + values + DateAddedUtc, DateModifiedUtc, LastRunId.
    Staged columns: keys + values (extra staging columns are ignored)."""
    if validate:
        validate_staged(staged, keys)
    return _merged(target, staged, keys, run_id, now, value_cols).drop(COPY)


def _merged(target: DataFrame, staged: DataFrame, keys: Sequence[str], run_id: str, now: dt.datetime,
            value_cols: Sequence[str] | None = None) -> DataFrame:
    """The merged rows with ``COPY``: the how-manieth staged row of its key a row is from (null:
    from the target alone).  Staged rows are numbered as the join has dealt and sorted them."""
    if value_cols is None:
        value_cols = [c for c in staged.columns if c not in keys and c not in ("LoadRunId", "LoadedAt")]
    schema = staged.select(*value_cols).schema
    t = target.select(*keys, *[F.col(c).alias("t_" + c) for c in [*value_cols, ADDED, MODIFIED, RUN]],
                      F.lit(True).alias("_in_t"))
    s = staged.select(*keys, *[F.col(c).alias("s_" + c) for c in value_cols], F.lit(True).alias("_in_s"),
                      F.row_number().over(Window.partitionBy(*keys).orderBy(*keys)).alias(COPY))
    j = t.join(s, list(keys), "full_outer")
    in_t, in_s = F.col("_in_t").isNotNull(), F.col("_in_s").isNotNull()
    changed = change_predicate(value_cols, schema)
    action = (F.when(in_t & ~in_s, F.lit("KEPT")).when(~in_t & in_s, F.lit("INSERT"))
              .when(changed, F.lit("UPDATE")).otherwise(F.lit("UNCHANGED")))
    j = j.withColumn("MergeAction", action)
    take_s = F.col("MergeAction").isin("INSERT", "UPDATE")
    now_c = ts(now)
    return j.select(
        *keys,
        *[F.when(take_s, F.col("s_" + c)).otherwise(F.col("t_" + c)).alias(c) for c in value_cols],
        F.when(F.col("MergeAction") == "INSERT", now_c).otherwise(F.col("t_" + ADDED)).alias(ADDED),
        F.when(take_s, now_c).otherwise(F.col("t_" + MODIFIED)).alias(MODIFIED),
        F.when(take_s, F.lit(run_id)).otherwise(F.col("t_" + RUN)).alias(RUN),
        "MergeAction", COPY,
    )


def merge_actions(merged: DataFrame) -> DataFrame:
    """SNK4: number of INSERT and UPDATE actions (0 when none)."""
    a = F.col("MergeAction")
    return merged.agg(F.count_if(a == "INSERT").alias("RowsInserted"), F.count_if(a == "UPDATE").alias("RowsUpdated"))


def write_version(df: DataFrame, table_root: str, version: str, after: int | None = None) -> str:
    """SNK1 commit: write ``df`` as a new version and commit it as the one that follows
    commit ``after``, the version ``df`` was made from (by default the newest one now).
    A version that is committed already is refused (its files may be what ``df`` reads).
    ``CommitConflict`` means that another writer committed in between: nothing of this
    attempt is read, and the caller merges again from the new version."""
    spark = df.sparkSession
    done = commits(spark, table_root)
    if any(c.version == version for c in done):
        raise ValueError(f"version {version!r} of {table_root} is committed already")
    if after is None:
        after = len(done) - 1
    return commit(spark, table_root, version, write_files(df.drop("MergeAction"), table_root, version), after).path


def merge_into(spark, table_root: str, staged: DataFrame, keys: Sequence[str], run_id: str, now: dt.datetime,
               attempts: int = 8, held: dict[str, DataFrame] | None = None) -> dict:
    """SNK1 + SNK4 as one run: merge ``staged`` into the current version, commit the result
    as version ``run_id`` and return its counts.

    Staging is checked by the write itself, which deals it by its key once: NULL or duplicate
    keys raise before anything is committed, and the files of the attempt are dropped.
    ``held``: versions, by path, that the caller reads in a better way than by their path
    (``commits.write_bucketed``).

    Optimistic: a writer that loses the commit merges again into the version that won, so
    concurrent runs give the result of one after the other.  A run that is committed already
    writes nothing (its counts are 0), so a repeated run is safe."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    for _ in range(attempts):
        done = commits(spark, table_root)
        if not done or any(c.version == run_id for c in done):
            validate_staged(staged, keys)
            if not done:
                raise ValueError(f"{table_root} has no version to merge into")
            return {"RowsInserted": 0, "RowsUpdated": 0}
        seen = Observation()
        a, is_staged = F.col("MergeAction"), F.col(COPY).isNotNull()
        target = (held or {}).get(done[-1].path)
        if target is None:
            target = spark.read.parquet(done[-1].path)
        counted = _merged(target, staged, keys, run_id, now).observe(
            seen, F.count_if(a == "INSERT").alias("RowsInserted"), F.count_if(a == "UPDATE").alias("RowsUpdated"),
            F.count_if(is_staged & (any_null | (F.col(COPY) > 1))).alias("refused"))
        path = write_files(counted.drop("MergeAction", COPY), table_root, run_id)
        counts = dict(seen.get)
        if counts.pop("refused"):
            drop_files(spark, path)
            validate_staged(staged, keys)  # raises with the numbers of staged rows
            raise ValueError("staging has rows with a NULL or duplicate key")
        try:
            commit(spark, table_root, run_id, path, done[-1].seq)
            return counts
        except CommitConflict:
            continue
    raise CommitConflict(f"run {run_id!r} lost {attempts} commits of {table_root}")


def read_current(spark, table_root: str) -> DataFrame:
    """The current version of a versioned table."""
    return spark.read.parquet(commits(spark, table_root)[-1].path)


def read_version(spark, table_root: str, version: str) -> DataFrame:
    """An earlier version, which stays readable."""
    return spark.read.parquet(next(c.path for c in commits(spark, table_root) if c.version == version))


# --- SNK5 ---------------------------------------------------------------------------------

def append_journal(increment: DataFrame, path: str, run_id: str, uid: str = "YJ_UID", partition_by: str = "period") -> dict:
    """SNK5: append of a run's increment; returns copied/inserted counts and the new
    watermark (MAX uid, None when the increment is empty).

    A run writes partitions of its own (``run``, then the period) and a retry replaces
    them, so a run that is repeated adds nothing and two runs never meet.  The counts are
    observed by the write itself: they are of the rows written, and the increment is read once.
    Readers take ``visible`` rows, so a run that fails after its write is not seen."""
    if not run_id:
        raise ValueError("an append needs the id of its run")
    seen = Observation()
    (increment.observe(seen, F.count(F.lit(1)).alias("n"), F.max(uid).alias("wm")).withColumn("run", F.lit(run_id))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run", partition_by).parquet(path))
    stats = seen.get
    return {"RowsCopied": stats["n"], "RowsInserted": stats["n"], "RowsUpdated": 0, "WatermarkTo": stats["wm"]}


def visible(appended: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows of runs that the run log has as COMPLETE.  ``run`` is a partition column, so
    the semi join prunes the folders of other runs."""
    done = runs.where(F.col("Status") == "COMPLETE").select(F.col("RunId").alias("run")).distinct()
    return appended.join(done, "run", "left_semi")


# --- SNK6 / SNK7 / SNK8 -----------------------------------------------------------------------

def eastern_date(utc: Column) -> Column:
    """Eastern calendar day of a UTC wall-clock time (DST-aware)."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(EASTERN), utc))


def capture_snapshot(current: DataFrame, previous: dt.datetime, now: dt.datetime, run_id: str,
                     date_floor: dt.datetime | None = None) -> DataFrame:
    """SNK6 + SNK7: rows with ``previous < modified <= now`` stamped with the
    Eastern day of ``now``; ChangeKind 'I' if added after ``previous`` else 'U'.

    ``date_floor`` (optional) additionally bounds the modified time from below, so a
    watermark reset can never turn a capture into a full-table copy."""
    m = F.col(MODIFIED)
    chg = current.where((m > ts(previous)) & (m <= ts(now)))
    if date_floor is not None:
        chg = chg.where(m >= ts(date_floor))
    kind = F.when(F.col(ADDED) > ts(previous), F.lit("I")).otherwise(F.lit("U"))
    base = [c for c in current.columns if c not in (ADDED, MODIFIED, RUN, "MergeAction")]
    return chg.select(
        eastern_date(ts(now)).alias("SnapshotDate"), *base, kind.alias("ChangeKind"),
        F.col(ADDED).alias("SourceFirstSeenUtc"), F.col(MODIFIED).alias("SourceLastSeenUtc"),
        F.col(RUN).alias("SourceRunId"), ts(now).alias("SnapshotCapturedUtc"), F.lit(run_id).alias("CaptureRunId"))


def check_change_kinds(captured: DataFrame) -> DataFrame:
    """SNK7 guard: only 'I' and 'U' are legal (the plan fails on anything else)."""
    k = F.col("ChangeKind")
    return captured.withColumn("ChangeKind", F.when(k.isin("I", "U"), k).otherwise(
        F.raise_error(F.concat(F.lit("illegal ChangeKind "), F.coalesce(k, F.lit("NULL"))))))


def snapshot_view(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The snapshot table: per (SnapshotDate, key) the row of the latest capture —
    a later change the same day overwrites the earlier one."""
    w = Window.partitionBy("SnapshotDate", *keys).orderBy(F.col("SnapshotCapturedUtc").desc(), F.col("CaptureRunId").desc())
    return log.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def validity_intervals(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SNK6 / JN14: the snapshot table with the day each row holds until (``ValidTo``,
    excluded; null: still valid), by ``lead`` over the captures of a key.  One window for both: the
    latest capture of a day is the one whose successor is of a later day."""
    w = Window.partitionBy(*keys).orderBy("SnapshotDate", "SnapshotCapturedUtc", "CaptureRunId")
    after = F.lead("SnapshotDate").over(w)
    return log.withColumn("ValidTo", after).where(F.col("ValidTo").isNull() | (F.col("ValidTo") > F.col("SnapshotDate")))


def as_of(intervals: DataFrame, day: dt.date) -> DataFrame:
    """JN14: the rows valid on a day: a filter, no window."""
    d = F.lit(day)
    return intervals.where((F.col("SnapshotDate") <= d) & (F.col("ValidTo").isNull() | (F.col("ValidTo") > d))).drop("ValidTo")


def as_of_lookup(requests: DataFrame, intervals: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """JN14 for many days: each request (keys and ``day``) with the row of its key valid on
    that day, or nulls.  An equi-join on the keys with the range as a further condition."""
    names = {c: f"{c}_" for c in [*keys]}
    held = intervals.select(*[F.col(k).alias(n) for k, n in names.items()], *[c for c in intervals.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(n) for k, n in names.items()])
    on = on & (F.col("SnapshotDate") <= F.col(day)) & (F.col("ValidTo").isNull() | (F.col("ValidTo") > F.col(day)))
    return requests.join(held, on, "left").drop(*names.values())


def write_capture(captured: DataFrame, path: str) -> None:
    """Append one capture run; partitions are (SnapshotDate, CaptureRunId), so a
    retried run overwrites only its own partition (dynamic overwrite)."""
    captured.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("SnapshotDate", "CaptureRunId").parquet(path)


def advance_snapshot_watermark(control: DataFrame, table: str, through: dt.datetime, run_at: dt.datetime,
                               rows: Column | int) -> DataFrame:
    """SNK8: the control table with ``table``'s watermark moved to the high-water
    read at the start of the capture.  A missing control row is an error."""
    if control.where(F.col("TableName") == table).limit(1).count() == 0:
        raise ValueError(f"no snapshot control row for {table!r}")
    hit = F.col("TableName") == table
    r = rows if isinstance(rows, Column) else F.lit(rows)
    return control.select(
        "TableName",
        F.when(hit, ts(through)).otherwise(F.col("LastCapturedThroughUtc")).alias("LastCapturedThroughUtc"),
        F.when(hit, ts(run_at)).otherwise(F.col("LastSnapshotRunUtc")).alias("LastSnapshotRunUtc"),
        F.when(hit, r.cast("bigint")).otherwise(F.col("LastRowsCaptured")).alias("LastRowsCaptured"))


# --- SNK9 / SNK10 / SNK11 -------------------------------------------------------------------

RUN_KINDS = ("INITIAL", "INCREMENTAL", "FULL_RELOAD")


def choose_watermark(runs: DataFrame, table: str, kind: str) -> DataFrame:
    """SNK9 watermark rule: INCREMENTAL -> MAX(WatermarkTo) over COMPLETE runs or 0;
    INITIAL -> 0; FULL_RELOAD -> NULL (one row)."""
    if kind not in RUN_KINDS:
        raise ValueError(f"run kind must be one of {RUN_KINDS}, got {kind!r}")
    ok = runs.where((F.col("TableName") == table) & (F.col("Status") == "COMPLETE"))
    if kind == "INCREMENTAL":
        wm = F.coalesce(F.max("WatermarkTo"), F.lit(0).cast("bigint"))
    elif kind == "INITIAL":
        wm = F.lit(0).cast("bigint")
    else:
        wm = F.lit(None).cast("bigint")
    return ok.agg(F.lit(table).alias("TableName"), F.lit(kind).alias("RunKind"), wm.alias("WatermarkFrom"))


def start_run(runs: DataFrame, table: str, kind: str, run_id: str, started: dt.datetime,
              allowed_tables: Sequence[str]) -> DataFrame:
    """SNK9: validate table and kind, and return the new RUNNING row (to append)."""
    if table not in allowed_tables:
        raise ValueError(f"table {table!r} is not loaded by this job")
    w = choose_watermark(runs, table, kind)
    return w.select(
        F.lit(run_id).alias("RunId"), "TableName", "RunKind", F.lit("RUNNING").alias("Status"),
        ts(started).alias("StartedUtc"), F.lit(None).cast("timestamp_ntz").alias("EndedUtc"),
        *[F.lit(None).cast("bigint").alias(c) for c in ("RowsCopied", "RowsInserted", "RowsUpdated", "RowsMerged")],
        "WatermarkFrom", F.lit(None).cast("bigint").alias("WatermarkTo"), F.lit(None).cast("string").alias("ErrorMessage"))


def finish_run(runs: DataFrame, run_id: str, ended: dt.datetime, counts: dict | None = None) -> DataFrame:
    """SNK10: mark a run COMPLETE with its end time and counts."""
    hit = F.col("RunId") == run_id
    out = runs.withColumn("Status", F.when(hit, F.lit("COMPLETE")).otherwise(F.col("Status"))) \
        .withColumn("EndedUtc", F.when(hit, ts(ended)).otherwise(F.col("EndedUtc")))
    for c, v in (counts or {}).items():
        out = out.withColumn(c, F.when(hit, v if isinstance(v, Column) else F.lit(v)).otherwise(F.col(c)).cast(runs.schema[c].dataType))
    return out


def fail_run(runs: DataFrame, run_id: str, ended: dt.datetime, message: str) -> DataFrame:
    """SNK10: mark a run FAILED with the error; its watermark never advances (the
    watermark rule reads COMPLETE runs only)."""
    hit = F.col("RunId") == run_id
    return runs.withColumn("Status", F.when(hit, F.lit("FAILED")).otherwise(F.col("Status"))) \
        .withColumn("EndedUtc", F.when(hit, ts(ended)).otherwise(F.col("EndedUtc"))) \
        .withColumn("ErrorMessage", F.when(hit, F.lit(message)).otherwise(F.col("ErrorMessage")))


def seed_control(control: DataFrame, tables: DataFrame, start_from: dt.datetime) -> DataFrame:
    """SNK11 / JN9: control rows only for tables that have none (``left_anti``).
    ``start_from`` = now means no backfill; an early date backfills."""
    new = tables.select("TableName").distinct().join(control.select("TableName"), "TableName", "left_anti").select(
        "TableName", ts(start_from).alias("LastCapturedThroughUtc"),
        F.lit(None).cast("timestamp_ntz").alias("LastSnapshotRunUtc"), F.lit(None).cast("bigint").alias("LastRowsCaptured"))
    return control.unionByName(new)


def watermark_table(runs: DataFrame) -> DataFrame:
    """SNK9 for every table in the log and every run kind, in one aggregation."""
    ok = F.col("Status") == "COMPLETE"
    per = runs.groupBy("TableName").agg(
        F.coalesce(F.max(F.when(ok, F.col("WatermarkTo"))), F.lit(0).cast("bigint")).alias("incremental"))
    kinds = F.array(*[F.lit(k) for k in RUN_KINDS])
    e = per.select("TableName", "incremental", F.explode(kinds).alias("RunKind"))
    wm = (F.when(F.col("RunKind") == "INCREMENTAL", F.col("incremental"))
          .when(F.col("RunKind") == "INITIAL", F.lit(0).cast("bigint")).otherwise(F.lit(None).cast("bigint")))
    return e.select("TableName", "RunKind", wm.alias("WatermarkFrom"))


# --- SNK9 + SNK10 as one guarded run over an append-only run-event log ---------------

def run_log_view(events: DataFrame) -> DataFrame:
    """The run log: the latest event of every run (events are append-only, so a
    crash between two writes leaves the earlier state, never a half-updated row)."""
    w = Window.partitionBy("RunId").orderBy(F.col("EventUtc").desc(), (F.col("Status") == "RUNNING").cast("int"))
    return events.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "EventUtc")


def _events_schema() -> T.StructType:
    from ..sources.schemas import LOAD_CONTROL
    return T.StructType([*[T.StructField(f.name, T.TimestampNTZType() if isinstance(f.dataType, T.TimestampType)
                                         else f.dataType) for f in LOAD_CONTROL.fields],
                         T.StructField("EventUtc", T.TimestampNTZType())])


def read_runs(spark, log_path: str) -> DataFrame:
    """The run log as it is now: empty before the first run (other read errors propagate)."""
    schema = _events_schema()
    events = spark.read.schema(schema).parquet(log_path) if present(spark, log_path) else spark.createDataFrame([], schema)
    return run_log_view(events)


def record_run(run: DataFrame, log_path: str, at: dt.datetime) -> None:
    """Append one event: the state of a run (one row) at a time."""
    schema = _events_schema()
    run.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields[:-1]], ts(at).alias("EventUtc")) \
        .coalesce(1).write.mode("append").parquet(log_path)


def execute_run(spark, log_path: str, table: str, kind: str, run_id: str, load, clock,
                allowed_tables: Sequence[str]) -> dict:
    """Open a RUNNING run (watermark chosen by SNK9), call ``load(watermark)`` which
    returns the run's counts (RowsCopied, RowsInserted, ..., WatermarkTo), then
    record COMPLETE; on any error record FAILED with the message and re-raise.
    Only COMPLETE runs advance the next watermark."""
    started = start_run(read_runs(spark, log_path), table, kind, run_id, clock(), allowed_tables)
    row = started.first()
    started = spark.createDataFrame([row], started.schema)  # the run as it was opened, not read again
    record_run(started, log_path, clock())
    try:
        counts = load(row["WatermarkFrom"])
    except Exception as e:
        record_run(fail_run(started, run_id, clock(), f"{type(e).__name__}: {e}"[:4000]), log_path, clock())
        raise
    record_run(finish_run(started, run_id, clock(), {k: v for k, v in counts.items() if v is not None or k == "WatermarkTo"}), log_path, clock())
    return counts
