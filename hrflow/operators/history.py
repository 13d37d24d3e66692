"""Employee master data and job history."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import epoch_to_date, keep_max, keep_min, lenient_int, next_in_key

EMPLOYEE_KEYS = ["emp_id", "name", "age"]
HISTORY_COLUMNS = ["emp_id", "designation", "start_date", "end_date", "salary"]
# Order of intervals inside one employee; later fields only break ties.
CHAIN_ORDER = ["start_date", "end_date", "salary", "designation"]
ACTIVE, INACTIVE = "ACTIVE", "INACTIVE"


# J1 -------------------------------------------------------------------------------
def clean_employees(df: DataFrame) -> DataFrame:
    """Drop rows missing emp_id/name/age, keep a positive age, one row per (emp_id, name, age).

    ``age > 0`` on a text age keeps the reference's non-ANSI result: '1.5' counts as 1,
    '0.5' as 0, junk as NULL (SURVEY Q1). Extra columns are kept from the smallest row.
    """
    kept = df.dropna(subset=EMPLOYEE_KEYS).filter(lenient_int("age") > 0)
    if set(kept.columns) == set(EMPLOYEE_KEYS):
        return kept.dropDuplicates(EMPLOYEE_KEYS)
    return keep_min(kept, EMPLOYEE_KEYS)


# J2 -------------------------------------------------------------------------------
def normalize_timeframe(df: DataFrame) -> DataFrame:
    """Text or numeric bronze columns -> epoch seconds (bigint) and salary (double)."""
    return df.selectExpr(
        "CAST(emp_id AS STRING) AS emp_id",
        "CAST(designation AS STRING) AS designation",
        "try_cast(try_cast(start_date AS DOUBLE) AS BIGINT) AS start_date",
        "try_cast(try_cast(end_date AS DOUBLE) AS BIGINT) AS end_date",
        "try_cast(salary AS DOUBLE) AS salary",
    )


def dedupe_timeframe(df: DataFrame, keys=("emp_id", "start_date")) -> DataFrame:
    """One row per key: the highest salary, NULL salary last; then the later end date,
    then the larger designation."""
    others = [c for c in ("end_date", "designation") if c in df.columns and c not in keys]
    return keep_max(df, list(keys), ["salary", *others])


# J3 / J4 --------------------------------------------------------------------------
def chain_intervals(df: DataFrame, mode: str = "fill_null") -> DataFrame:
    """End each interval at the employee's next start.

    ``fill_null`` keeps explicit end dates and fills only missing ones; ``replace``
    always takes the next start (the last interval becomes open).
    """
    if mode not in ("fill_null", "replace"):
        raise ValueError(f"unknown mode {mode!r}")
    order = [c for c in CHAIN_ORDER if c in df.columns]
    chained = next_in_key(df, "emp_id", order, "start_date", "__next_start")
    end = F.col("__next_start") if mode == "replace" else F.coalesce("end_date", "__next_start")
    return chained.withColumn("end_date", end).drop("__next_start").select(*df.columns)


# J5 -------------------------------------------------------------------------------
def with_status(df: DataFrame) -> DataFrame:
    """ACTIVE iff the interval is open (end_date NULL); a future end date is INACTIVE."""
    return df.withColumn("status", F.when(F.col("end_date").isNull(), F.lit(ACTIVE)).otherwise(F.lit(INACTIVE)))


def epochs_to_dates(df: DataFrame) -> DataFrame:
    return df.withColumns({"start_date": epoch_to_date("start_date"), "end_date": epoch_to_date("end_date")})


def derive_status(df: DataFrame) -> DataFrame:
    """Epoch columns -> dates, plus status."""
    return with_status(epochs_to_dates(df))


# J6 -------------------------------------------------------------------------------
def build_timeframe(raw: DataFrame) -> DataFrame:
    """Gold job history of one batch: dedupe, fill open ends, dates, status."""
    return derive_status(chain_intervals(dedupe_timeframe(normalize_timeframe(raw)), "fill_null"))


# J4 as a batch job ----------------------------------------------------------------
def build_timeframe_chained(raw: DataFrame) -> DataFrame:
    """Variant batch: dates first, dedupe on (emp_id, start, end), end := next start."""
    dated = epochs_to_dates(normalize_timeframe(raw))
    deduped = dedupe_timeframe(dated, keys=("emp_id", "start_date", "end_date"))
    return with_status(chain_intervals(deduped, "replace"))


# J7 -------------------------------------------------------------------------------
MERGE_KEYS = ["emp_id", "designation", "start_date", "salary"]
# The stored history also keeps the seconds each record came with.
STORED_COLUMNS = [*HISTORY_COLUMNS, "status", "given_start", "given_end"]


def merge_timeframe(history: DataFrame, batch_raw: DataFrame) -> DataFrame:
    """Variant merge: add a bronze batch to the gold history, then every interval ends at
    the employee's next start (explicit end dates are not kept).

    Rows equal on (emp_id, designation, start_date, salary) are kept once, so that a
    re-sent file does not create zero-length intervals (SURVEY Q8).
    """
    batch = build_timeframe_chained(batch_raw)
    combined = history.select(*MERGE_KEYS).unionByName(batch.select(*MERGE_KEYS)).dropDuplicates(MERGE_KEYS)
    chained = chain_intervals(combined.withColumn("end_date", F.lit(None).cast("date")), "replace")
    return with_status(chained).select(*HISTORY_COLUMNS, "status")


def merge_into_history(history: DataFrame, batch_raw: DataFrame, buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The daily job's merge in two parts, (rows that stay as stored, rows of employees chained again);
    together the history of all batches so far, as ``build_timeframe`` would make it from all their
    rows at once (explicit end dates stay, open ones are filled).

    ``history`` is a former result (``STORED_COLUMNS``) or empty. Choosing one row per
    (emp_id, start_date) is associative, so the order of batches and a file sent twice make
    no difference. Joins by employee mark the rows of the batch's employees (and those without an
    employee); only they are exchanged and chained again. A history bucketed by employee is read in
    place: the batch's ids are dealt to its ``buckets``, and the rows that stay don't move.
    """
    batch = dedupe_timeframe(normalize_timeframe(batch_raw))
    ids = batch.select("emp_id").where(F.col("emp_id").isNotNull()).distinct()
    if buckets is not None:
        ids = ids.repartition(buckets, "emp_id")
    stored = history.select(*STORED_COLUMNS)
    stay = stored.where(F.col("emp_id").isNotNull()).join(ids, "emp_id", "left_anti").select(*STORED_COLUMNS)
    again = stored.join(ids, "emp_id", "left_semi").unionByName(stored.where(F.col("emp_id").isNull()))
    given = again.select("emp_id", "designation", F.col("given_start").alias("start_date"), F.col("given_end").alias("end_date"), "salary")
    merged = dedupe_timeframe(given.unionByName(batch.select(*given.columns)))
    as_given = merged.withColumns({"given_start": F.col("start_date"), "given_end": F.col("end_date")})
    return stay, derive_status(chain_intervals(as_given, "fill_null")).select(*STORED_COLUMNS)


def accumulate_timeframe(history: DataFrame, batch_raw: DataFrame, buckets: int | None = None) -> DataFrame:
    """``merge_into_history`` as one table."""
    stay, chained = merge_into_history(history, batch_raw, buckets)
    return stay.unionByName(chained)


# J8 -------------------------------------------------------------------------------
def active_by_designation(timeframe: DataFrame) -> DataFrame:
    """Active employees per designation, 0 where a designation has none.

    One aggregation instead of count + distinct + join: each designation's count is a
    conditional count. A NULL designation shows 0, as the reference's join gives it.
    """
    counts = timeframe.groupBy("designation").agg(
        F.count(F.when(F.col("status") == ACTIVE, F.col("emp_id"))).alias("active_employees"))
    return counts.select(
        "designation",
        F.when(F.col("designation").isNull(), F.lit(0).cast("bigint"))
         .otherwise(F.col("active_employees")).alias("active_employees"))


# J9 -------------------------------------------------------------------------------
def upsert_report(target: DataFrame, staging: DataFrame, key: str = "designation",
                  value: str = "active_employees") -> DataFrame:
    """Merge new values into a stored report; the staging value wins, keys of both survive."""
    t, s = target.alias("t"), staging.alias("s")
    return t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer").select(
        F.coalesce(F.col(f"s.{key}"), F.col(f"t.{key}")).alias(key),
        F.coalesce(F.col(f"s.{value}"), F.col(f"t.{value}")).alias(value))
