"""Reports kept up to date by the leads that changed.

A report adds up a grain: one row per day or month, person and lead. The grain of a lead follows from the
lead's own activities, so a load that changes some leads changes their rows only. The grain is a table of
generations; an update replaces the rows of the leads that the activities' changes name, and
notes in the same commit up to which version of silver it goes. The report itself is a sum over
that narrow table. If users or the dictionary have changed, which can touch every row, or the
changes are no longer kept, the grain is built anew.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession

from funnelspark.operators.key_index import bucket_of
from funnelspark.operators.upsert import schema_of
from funnelspark.plans import reports
from funnelspark.plans.silver import Silver
from funnelspark.sources import generations
from funnelspark.sources.generations import Change, Snapshot
from funnelspark.sources.storage import written

_SOURCE = "name string, version long, digest string"
#: Silver tables by their folders; all but the last are read whole by every report.
_DIMENSIONS = ("users", "custom_activity_fields")
_ACTIVITIES = "lead_activities"


@dataclass(frozen=True)
class Kept:
    """A report as a grain with a ``lead_id`` and the sum over it."""

    grain: Callable[[Silver], DataFrame]
    totals: Callable[[DataFrame], DataFrame]


KEPT_REPORTS = {
    "inbound_setter_report": Kept(reports.inbound_grain, reports.inbound_totals),
    "outbound_setter_report": Kept(reports.outbound_grain, reports.outbound_totals),
    "closer_report": Kept(reports.closer_grain, reports.closer_totals),
}


def _digest(at: Snapshot) -> str:
    """Equal for versions with the same wide rows."""
    return md5(repr(sorted(at.pieces.get("rows", {}).items())).encode()).hexdigest()


def _by_lead(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.withColumn("bucket", bucket_of(["lead_id"], buckets))


def update_report(spark: SparkSession, root: str, name: str, tables: Silver, buckets: int | None = None) -> DataFrame:
    """Bring the grain of a report up to date with silver under ``root``; the report.

    ``tables`` is that silver as it is now. Repeating the update changes nothing, and one that is
    lost leaves the grain as it was.
    """
    kept, path = KEPT_REPORTS[name], f"{root}/grains/{name}"
    silver = {table: generations.newest(spark, f"{root}/{table}") for table in (*_DIMENSIONS, _ACTIVITIES)}
    now = {table: (at.version, _digest(at)) for table, at in silver.items()}
    before = generations.newest(spark, path)
    if before is None:
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    else:
        buckets = before.buckets
        noted = generations.read(spark, path, "source", _SOURCE, before).collect()
        was = {row["name"]: (row.version, row.digest) for row in noted}
        schema = schema_of(kept.grain(tables))
        if all(was[table][1] == now[table][1] for table in now):
            return kept.totals(generations.read(spark, path, "rows", schema, before).drop("bucket"))
    change = Change(spark, path, before, buckets)
    leads = None
    if before is not None and all(was[table][1] == now[table][1] for table in _DIMENSIONS):
        leads = generations.changes_since(spark, f"{root}/{_ACTIVITIES}", "lead_id string, activity_id string", was[_ACTIVITIES][0])
    if leads is None:
        change.replace("rows", _by_lead(kept.grain(tables), buckets))
    else:
        leads = written(_by_lead(leads.select("lead_id").distinct(), buckets), "leads")
        touched = [row.bucket for row in leads.select("bucket").distinct().collect()]
        theirs = tables.activities.join(leads.select("lead_id"), "lead_id", "left_semi")
        fresh = kept.grain(Silver(tables.fields, tables.users, theirs))
        others = generations.read(spark, path, "rows", schema, before, touched).join(
            leads.select("lead_id"), "lead_id", "left_anti"
        )
        change.replace("rows", others.unionByName(_by_lead(fresh, buckets)), touched)
    source = [(table, *state, 0) for table, state in now.items()]
    change.replace("source", spark.createDataFrame(source, f"{_SOURCE}, bucket int").coalesce(1))
    after = change.commit()
    schema = schema_of(kept.grain(tables))
    return kept.totals(generations.read(spark, path, "rows", schema, after).drop("bucket"))
