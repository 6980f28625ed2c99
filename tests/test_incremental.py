"""Reports from kept grains equal those built from all of silver."""

import random
from datetime import datetime, timedelta

from conftest import SMALLEST
from pyspark.sql import functions as F

from funnelspark import config as c
from funnelspark.plans import incremental, pipeline, reports
from funnelspark.sources import crm, generations
from funnelspark.sources.storage import new_folder

START = datetime(2024, 3, 1)


def rows(report):
    rounded = [F.round(n, 4).alias(n) if t == "double" else F.col(n) for n, t in report.dtypes]
    return sorted((tuple(r) for r in report.select(*rounded).collect()), key=repr)


def test_updates_equal_full_builds(spark, monkeypatch):
    """After a build, some changed leads, nothing, and a changed user."""
    draw = random.Random(3)
    bronze = {t: b.cache() for t, b in crm.bronze_tables(spark, SMALLEST).items()}
    early = F.col("insert_date") < F.lit("2024-01-12").cast("timestamp_ntz")
    lead = F.try_variant_get("payload", "$.data[0].lead_id", "string")
    some = [f"lead_{draw.randrange(100)}" for _ in range(30)]
    nothing = bronze[c.CRM_USERS].limit(0)
    root = new_folder(spark, "incremental")
    full = {t: b.where(early) for t, b in bronze.items()}
    steps = [
        full,
        # Later snapshots of some leads: only their rows are computed.
        {**full, c.LEAD_ACTIVITIES: bronze[c.LEAD_ACTIVITIES].where(lead.isin(*some))},
        full,
        {**bronze, c.CUSTOM_ACTIVITIES: nothing, c.LEAD_ACTIVITIES: nothing},
    ]
    grains = []

    def counted(name, kept):
        def grain(silver):
            grains.append((name, silver.activities))
            return kept.grain(silver)

        return incremental.Kept(grain, kept.totals)

    # One report is watched; the others share the code.
    name = "inbound_setter_report"
    monkeypatch.setitem(incremental.KEPT_REPORTS, name, counted(name, incremental.KEPT_REPORTS[name]))
    before = None
    for number, step in enumerate(steps):
        tables = pipeline.build_silver(spark, step, root, START + timedelta(days=number), 4)
        for report in (name, "closer_report") if number < 2 else (name,):
            found = rows(incremental.update_report(spark, root, report, tables, 4))
            assert found == rows(reports.REPORTS[report](tables)) and found
        at = generations.newest(spark, f"{root}/grains/{name}")
        if number == 1:
            leads = grains[-2][1].select("lead_id").distinct()
            assert {r.lead_id for r in leads.collect()} <= set(some)
        if number == 2:
            assert at == before  # nothing changed, nothing is written
        before = at
    generations.vacuum(spark, f"{root}/lead_activities", keep=1)
    assert generations.changes_since(spark, f"{root}/lead_activities", "lead_id string, activity_id string", 0) is None
