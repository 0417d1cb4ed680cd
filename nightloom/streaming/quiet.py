"""Files that have gone quiet, as a stream: the changes of a path that follow each other closely are one session.

Events are changes of files: created, modified, moved (to the path) and deleted.  A path is handed on when it has not
changed for more than some seconds of event time; a later change hands it on again.  A deletion forgets what was pending.  A file
whose name begins with a dot is a transfer in progress: it keeps its final path waiting, which is handed on only when
it has appeared itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ingest import QUIET_SECONDS

#: Kinds of events by what they do to a path.
CHANGES, GONE = ("created", "modified", "moved"), "deleted"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def is_partial(path: Column) -> Column:
    """Whether the name begins with a dot, as that of a file in transfer does."""
    return base_name(path).startswith(".")


def final_path(path: Column) -> Column:
    """Where a file in transfer will be: its name without the leading dot and the last suffix; other paths as they are."""
    return F.when(is_partial(path), F.regexp_replace(path, r"\.([^/]*)\.[^./]*$", "$1")).otherwise(path)


def quiet_files(events: DataFrame, path: str, kind: str, at: str, seconds: float = QUIET_SECONDS, late: str = "0 seconds") -> DataFrame:
    """path, changed (the last change) and kind for each time that a path goes quiet, from a stream of events.

    Events of a path that follow each other within the seconds are one session; once it is over, what lies beyond its last
    deletion decides.  State is three numbers for each session that is not over, nothing for other paths.  How events fall into batches
    does not matter as long as they come no later than the watermark allows; events of other kinds, and those without path or
    time, are left out.  Of changes at one time the kind that stands last in CHANGES is given.
    """
    rows = events.filter(F.col(kind).isin(*CHANGES, GONE) & F.col(path).isNotNull() & F.col(at).isNotNull())
    named = rows.select(
        final_path(F.col(path)).alias("path"),
        F.array_position(F.array(*map(F.lit, CHANGES)), F.col(kind)).alias("kind"),  # from 1; 0 is a deletion
        F.date_trunc("millisecond", F.col(at).cast("timestamp")).alias("at"),
        is_partial(F.col(path)).alias("partial"),
        F.unix_millis(F.col(at).cast("timestamp")).alias("ms"),
    )
    partial, gone = F.col("partial"), F.col("kind") == 0
    # an end of a transfer says nothing of the file: without a gap it is in no session
    gap = F.when(partial & gone, "0 milliseconds").otherwise(f"{int(seconds * 1000) + 1} milliseconds")
    last = named.withWatermark("at", late).groupBy("path", F.session_window("at", gap)).agg(
        F.max(F.when(~partial & gone, F.col("ms"))).alias("gone"),  # of changes at one time the deletion comes last
        F.max(F.when(~partial & ~gone, F.col("ms") * 4 + F.col("kind"))).alias("change"),
        F.max(F.when(partial, F.col("ms"))).alias("transfer"),
    )
    there = last.withColumn("ms", F.shiftright("change", 2)).filter(F.col("ms") > F.coalesce("gone", F.col("ms") - 1))
    kinds = F.element_at(F.array(*map(F.lit, CHANGES)), F.col("change").bitwiseAND(3).cast("int"))
    return there.select("path", F.timestamp_millis(F.greatest("ms", "transfer")).alias("changed"), kinds.alias("kind"))
