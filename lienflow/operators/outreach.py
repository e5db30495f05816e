"""The call queue: which calls are ready, how attempts change them, and what the queue holds.

``as_of`` is a SQL expression, such as ``current_timestamp()``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lienflow.functions.dates import next_office_moment, within_office_hours

PRIORITY_RANK = {"high": 0, "normal": 1, "low": 2}
STATUSES = ["pending_approval", "approved", "completed", "failed_escalated"]
SUCCESS = ["completed", "successful"]


def _with_zone(calls: DataFrame, sources: DataFrame) -> DataFrame:
    """The office's time zone; the dimension has a fixed size."""
    return calls.join(F.broadcast(sources.select("state", "time_zone")), "state", "left")


def states_attempted(calls: DataFrame, as_of: str) -> DataFrame:
    """States with an attempt on the UTC day of ``as_of``."""
    return calls.filter(f"to_date(last_attempt_at) = to_date({as_of})").select("state").distinct()


def ready_calls(calls: DataFrame, sources: DataFrame, as_of: str) -> DataFrame:
    """Approved calls to make now, by priority: in office hours, and no call to the state yet today.

    Only states of the dimension have office hours, so the list of attempted states is never longer than it.
    """
    approved = _with_zone(calls.filter("status = 'approved'"), sources)
    open_now = approved.filter(within_office_hours(as_of, "time_zone"))
    attempted = states_attempted(calls, as_of).join(F.broadcast(sources.select("state")), "state", "left_semi")
    free = open_now.join(F.broadcast(attempted), "state", "left_anti")
    return free.orderBy(priority_rank(), "queue_no").drop("time_zone")


def priority_rank() -> Column:
    ranks = F.create_map(*[F.lit(x) for pair in PRIORITY_RANK.items() for x in pair])
    return F.coalesce(ranks[F.col("priority")], F.lit(PRIORITY_RANK["normal"]))


def next_windows(calls: DataFrame, sources: DataFrame, as_of: str) -> DataFrame:
    """When each call can be made next, as a UTC time."""
    moment = f"{next_office_moment(as_of, 'time_zone')} AS next_window"
    return _with_zone(calls, sources).selectExpr("*", moment).drop("time_zone")


def approve(calls: DataFrame, approvals: DataFrame) -> DataFrame:
    """Calls with approvals (``id``, ``approved_at``) applied."""
    given = approvals.groupBy("id").agg(F.max("approved_at").alias("given_at"))
    joined = calls.join(given, "id", "left")
    approved = F.col("given_at").isNotNull()
    return joined.withColumns(
        {
            "status": F.when(approved, "approved").otherwise(F.col("status")),
            "approved_at": F.coalesce("given_at", "approved_at"),
        }
    ).drop("given_at")


def apply_attempts(calls: DataFrame, attempts: DataFrame) -> DataFrame:
    """Calls after their attempts (``id``, ``attempted_at``, ``attempt_no``, ``outcome``, ``notes``).

    The last attempt decides: success completes the call, running out of retries escalates it,
    anything else leaves it approved for another try.  Attempts are summed up per call before the join.
    """
    success = F.col("outcome").isin(SUCCESS)
    folded = attempts.groupBy("id").agg(
        F.count("*").alias("tries"),
        F.max(F.struct("attempted_at", "attempt_no", "outcome", "notes")).alias("last"),
        F.max(F.when(success, F.col("attempted_at"))).alias("succeeded_at"),
    )
    joined = calls.join(folded, "id", "left")
    tried = F.col("tries").isNotNull()
    retries = F.col("retry_count") + F.coalesce("tries", F.lit(0))
    status = (
        F.when(~tried, F.col("status"))
        .when(F.col("last.outcome").isin(SUCCESS), "completed")
        .when(retries >= F.col("max_retries"), "failed_escalated")
        .otherwise("approved")
    )
    return joined.withColumns(
        {
            "status": status,
            "retry_count": retries,
            "last_attempt_at": F.coalesce("last.attempted_at", "last_attempt_at"),
            "completed_at": F.coalesce("succeeded_at", "completed_at"),
            "outcome": F.when(tried, F.col("last.outcome")).otherwise(F.col("outcome")),
            "notes": F.when(tried, F.col("last.notes")).otherwise(F.col("notes")),
        }
    ).drop("tries", "last", "succeeded_at")


def queue_summary(calls: DataFrame) -> DataFrame:
    """All calls and calls per known status, in one pass."""
    return calls.agg(F.count("*").alias("total"), *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES])


def with_consent(calls: DataFrame, sources: DataFrame) -> DataFrame:
    """Flag calls to states in which every party must agree to a recording."""
    joined = calls.join(F.broadcast(sources.select("state", "two_party_consent")), "state", "left")
    return joined.withColumn("two_party_consent", F.coalesce("two_party_consent", F.lit(False)))
