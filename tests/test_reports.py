"""Reports against plain Python over small and skewed activities."""

import random
from collections import defaultdict
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from funnelspark import config as c
from funnelspark.plans import gold, metrics, quality, reports
from funnelspark.plans.silver import Silver

FIELDS = {
    c.SETTER: "f_setter",
    c.CLOSER: "f_closer",
    c.TRIAGE_OUTCOME: "f_triage",
    c.PROSPECTING_OUTCOME: "f_prospect",
    c.STRATEGY_OUTCOME: "f_strategy",
    c.FOLLOW_UP_OUTCOME: "f_follow",
    c.OFFER_PRESENTED: "f_offer",
    c.CONTRACT_VALUE: "f_contract",
    c.SALES_TYPE: "f_type",
    c.CASH_COLLECTED: "f_cash",
    c.OBJECTIONS: "f_objections",
}
TYPES = [*c.PROSPECTING_TYPES, *c.TRIAGE_TYPES, *c.STRATEGY_TYPES, *c.SALE_TYPES]


def build(spark, calls, users=()):
    """Silver tables from (lead, id, time, type name, {field name: value}) calls."""
    dictionary = [
        (f"t{i}", name, False, key, field, "text")
        for i, name in enumerate(TYPES)
        for field, key in FIELDS.items()
    ]
    records = [
        (
            lead,
            identity,
            at,
            "CustomActivity",
            f"t{TYPES.index(kind)}",
            "actor",
            {f"custom.{FIELDS[k]}": v for k, v in values.items() if v is not None},
        )
        for lead, identity, at, kind, values in calls
    ]
    return Silver(
        fields=spark.createDataFrame(
            dictionary,
            "custom_activity_type_id string, custom_activity_type_name string, is_archived boolean,"
            " field_id string, field_name string, field_type string",
        ),
        users=spark.createDataFrame(
            list(users),
            "user_id string, email string, first_name string, last_name string, role string,"
            " status string",
        ),
        activities=spark.createDataFrame(
            records,
            "lead_id string, activity_id string, activity_at timestamp_ntz, record_type string,"
            " type_id string, user_id string, custom_fields map<string,string>",
        ),
    )


USERS = [
    ("s1", "s1@x.test", "Sam", "One", None, None),
    ("s2", "s2@x.test", "Sue", "Two", None, None),
    ("k1", "k1@x.test", "Kim", "Close", None, None),
    ("k2", "k2@x.test", None, "Nameless", None, None),
]


@pytest.fixture(scope="module")
def calls():
    """2,000 calls; one lead holds a third of them."""
    rng = random.Random(11)
    made = []
    for i in range(2000):
        lead = "hot" if rng.random() < 0.34 else f"lead{rng.randrange(60)}"
        at = datetime(2024, rng.choice([1, 2]), rng.randrange(1, 6), rng.randrange(24), 0, i % 60)
        kind = rng.choice(TYPES)
        values = {c.SETTER: rng.choice(["s1", "s2", "missing", None])}
        if kind in c.TRIAGE_TYPES:
            values[c.TRIAGE_OUTCOME] = rng.choice([c.TRIAGE_SET, "2. Unqualified", "6. No Show", None])
        elif kind in c.PROSPECTING_TYPES:
            values[c.PROSPECTING_OUTCOME] = rng.choice([c.PROSPECTING_SET, "3. Follow Up", None])
        elif kind in c.STRATEGY_TYPES:
            values[c.CLOSER] = rng.choice(["k1", "k2", None])
            values[c.STRATEGY_OUTCOME] = rng.choice([*c.NOT_ATTENDED, "6. Sale", "7. Lost", None])
            values[c.OFFER_PRESENTED] = rng.choice(["Yes", "No", None])
            values[c.OBJECTIONS] = rng.choice(['["Money","Think"]', "Wasn't Looking", "No Show", None])
        else:
            values[c.SALES_TYPE] = rng.choice(["New", None])
            values[c.CONTRACT_VALUE] = rng.choice(["6000", "0", "n/a", " 12.5 ", None])
            values[c.CASH_COLLECTED] = rng.choice(["100.25", "n/a", None])
        made.append((lead, f"a{i}", at, kind, {k: v for k, v in values.items() if v is not None}))
    return [call for call in made if call[4]]


@pytest.fixture(scope="module")
def tables(spark, calls):
    return build(spark, calls, USERS)


EMAILS = {u[0]: u[1] for u in USERS}
NAMES = {u[0]: f"{u[2]} {u[3]}" if u[2] else None for u in USERS}


def number(text):
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


def sales_by_lead(calls):
    latest = {}
    for lead, identity, at, kind, values in calls:
        if kind in c.SALE_TYPES and {c.SALES_TYPE, c.CONTRACT_VALUE, c.CASH_COLLECTED} & set(values):
            latest[lead] = max(latest.get(lead, (datetime.min, "", None)), (at, identity, values), key=lambda x: x[:2])
    return {lead: values for lead, (_, _, values) in latest.items()}


def strategies(calls):
    for lead, _, at, kind, values in calls:
        if kind in c.STRATEGY_TYPES:
            attended = values.get(c.STRATEGY_OUTCOME) not in c.NOT_ATTENDED
            yield lead, at, attended, values


def by_setter(calls, types, outcome_field):
    """(date, setter, lead) -> outcomes of the touches."""
    touched = defaultdict(list)
    for lead, _, at, kind, values in calls:
        if kind in types:
            key = (at.date(), EMAILS.get(values.get(c.SETTER)), lead)
            touched[key].append(values.get(outcome_field))
    return touched


def funnel(calls):
    attended, offered = set(), set()
    for lead, _, shown, values in strategies(calls):
        if shown:
            attended.add(lead)
            if values.get(c.OFFER_PRESENTED) == "Yes":
                offered.add(lead)
    values = {lead: number(v.get(c.CONTRACT_VALUE)) for lead, v in sales_by_lead(calls).items()}
    return attended, offered, values


def rate(part, whole, digits=1, scale=100):
    return None if not whole else round(part / whole * scale + 1e-9, digits)


def test_inbound_report(tables, calls):
    attended, offered, values = funnel(calls)
    groups = defaultdict(list)
    for (day, setter, lead), outcomes in by_setter(calls, c.TRIAGE_TYPES, c.TRIAGE_OUTCOME).items():
        is_set = c.TRIAGE_SET in outcomes
        taken = any(o is not None and o not in c.TRIAGE_NOT_TAKEN for o in outcomes)
        shown = is_set and lead in attended
        value = values.get(lead) if shown else None
        groups[day, setter].append((taken, is_set, shown, shown and lead in offered, value))
    expected = {}
    for key, leads in groups.items():
        taken, set_, shown, offer = (sum(lead[i] for lead in leads) for i in range(4))
        sold = [lead[4] for lead in leads if lead[4] is not None]
        expected[key] = (
            len(leads),
            taken,
            rate(taken, len(leads)),
            rate(set_, taken),
            set_,
            shown,
            rate(offer, shown),
            len(sold),
            rate(len(sold), shown),
            rate(sum(sold), len(sold), 2, 1),
        )
    found = {tuple(row[:2]): tuple(row[2:]) for row in reports.inbound_setter_report(tables).collect()}
    assert found == expected


def test_outbound_report(tables, calls):
    attended, offered, values = funnel(calls)
    groups = defaultdict(list)
    touches = by_setter(calls, c.PROSPECTING_TYPES, c.PROSPECTING_OUTCOME)
    for (day, setter, lead), outcomes in touches.items():
        is_set = c.PROSPECTING_SET in outcomes
        shown = is_set and lead in attended
        value = values.get(lead) if shown else None
        groups[day, setter].append((len(outcomes), is_set, shown, shown and lead in offered, value))
    expected = {}
    for key, leads in groups.items():
        calls_, set_, shown, offer = (sum(lead[i] for lead in leads) for i in range(4))
        sold = [lead[4] for lead in leads if lead[4] is not None]
        expected[key] = (
            calls_,
            len(leads),
            set_,
            shown,
            offer,
            len(sold),
            rate(set_, calls_),
            rate(shown, set_),
            rate(len(sold), shown),
            sum(sold),
            rate(sum(sold), len(sold), 2, 1),
        )
    found = {tuple(row[:2]): tuple(row[2:]) for row in reports.outbound_setter_report(tables).collect()}
    assert found == expected


def test_closer_report_counts_the_sale_once_per_call(tables, calls):
    sales = sales_by_lead(calls)
    groups = defaultdict(list)
    for lead, at, shown, values in strategies(calls):
        name = NAMES.get(values.get(c.CLOSER))
        groups[name, at.date().replace(day=1)].append((lead, shown, values.get(c.STRATEGY_OUTCOME)))
    found = {tuple(row[:2]): row for row in reports.closer_report(tables).collect()}
    assert set(found) == set(groups)
    for key, rows in groups.items():
        row = found[key]
        money = [number(sales.get(lead, {}).get(c.CONTRACT_VALUE)) for lead, _, _ in rows]
        money = [m for m in money if m]
        cash = [number(sales.get(lead, {}).get(c.CASH_COLLECTED)) for lead, _, _ in rows]
        cash = [m for m in cash if m is not None]
        assert row.call_booked == len(rows)
        assert row.strtgy_call_shw == sum(shown for _, shown, _ in rows)
        for name, outcomes in c.CLOSER_COUNTS.items():
            assert row[name] == sum(o in outcomes for _, _, o in rows)
        assert row.total_cancel == sum(row[name] for name in c.CANCEL_COLUMNS)
        assert row.avg_value == (pytest.approx(sum(money) / len(money), abs=0.006) if money else None)
        assert row.cash_collected == (pytest.approx(sum(cash)) if cash else None)


def test_attendance_classes_partition_the_calls(tables):
    for corrected in (False, True):
        report = reports.closer_report(tables, corrected).collect()
        for row in report:
            if not corrected:
                assert row.total_cancel + row.no_show + row.strtgy_call_shw == row.call_booked
            assert row.strtgy_call_shw <= row.call_booked


def test_funnel_stages_are_subsets(tables):
    for row in reports.inbound_setter_report(tables).collect():
        assert row.inbound_taken <= row.inbound_booked
        assert row.strategy_call_taken <= row.strategy_call_booked
        assert row.total_sales <= row.strategy_call_taken
    for row in reports.outbound_setter_report(tables).collect():
        assert row.total_offer <= row.total_closer_show <= row.outbound_set
        assert row.total_sale <= row.total_closer_show


def test_sales_are_one_per_lead_without_stubs(tables):
    sales = gold.sales_details(tables)
    assert sales.count() == sales.select("lead_id").distinct().count()
    stub = "sale_status IS NULL AND contracted_value IS NULL AND cash_collected IS NULL"
    assert sales.where(stub).count() == 0


def test_objections(tables, calls):
    expected = defaultdict(lambda: [set(), 0, 0, 0])
    for _, identity, at, kind, values in calls:
        if c.OBJECTIONS in values:
            group = expected[NAMES.get(values.get(c.CLOSER)), at.date()]
            text = values[c.OBJECTIONS].lower()
            group[0].add(identity)
            group[1] += "money" in text
            group[2] += "think" in text
            group[3] += "looking" in text
    for report, looking in (
        (reports.objections_faced_report(tables), False),
        (reports.corrected_objections_report(tables), True),
    ):
        found = {
            tuple(r[:2]): (r.total_calls, r.money_count, r.think_abt_it_count, r.not_looking_count)
            for r in report.collect()
        }
        assert found == {
            key: (len(g[0]), g[1], g[2], g[3] if looking else 0) for key, g in expected.items()
        }


def test_objection_on_another_type_has_no_closer(spark):
    at = datetime(2024, 1, 1)
    values = {c.OBJECTIONS: "Money", c.CLOSER: "k1"}
    tables = build(spark, [("l", "a", at, c.TRIAGE_TYPES[0], values)], USERS)
    row = reports.objections_faced_report(tables).first()
    assert (row.closer_name, row.money_count) == (None, 1)


def test_follow_up_outcomes_count_once_corrected(spark):
    at = datetime(2024, 1, 1)
    follow_up, call = c.STRATEGY_TYPES[1], c.STRATEGY_TYPES[0]
    made = [
        ("l", "a", at, follow_up, {c.CLOSER: "k1", c.FOLLOW_UP_OUTCOME: "3. No Show"}),
        ("l", "b", at, call, {c.CLOSER: "k1", c.STRATEGY_OUTCOME: "5. Reschedule"}),
        ("l", "d", at, call, {c.CLOSER: "k1"}),
    ]
    tables = build(spark, made, USERS)
    first, fixed = (reports.closer_report(tables, corrected).first() for corrected in (False, True))
    assert (first.strtgy_call_shw, first.no_show) == (3, 0)
    assert (fixed.strtgy_call_shw, fixed.no_show) == (0, 1)
    statuses = {row.status for row in gold.strategy_calls(tables, corrected=True).collect()}
    assert statuses == {"NOT_ATTENDED", "PENDING"}


def test_shared_field_counts_only_for_its_own_type(tables):
    fact = gold.fact_lead_funnel(tables).select("activity_id", "custom_activity_type_name")
    names = fact.groupBy("activity_id").agg(F.countDistinct("custom_activity_type_name").alias("n"))
    assert names.where("n > 1").count() == 0


def test_reports_beyond_the_broadcast_bound(spark, tables, calls, monkeypatch):
    from funnelspark.operators import lookup

    expected = sorted(map(str, reports.inbound_setter_report(tables).collect()))
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 1)
    large = build(spark, calls, USERS)
    assert not large.fields_fit and not large.users_fit
    assert sorted(map(str, reports.inbound_setter_report(large).collect())) == expected


def test_reports_without_a_type_list(spark, tables, calls, monkeypatch):
    from funnelspark.plans import silver

    expected = sorted(map(str, reports.objections_faced_report(tables).collect()))
    monkeypatch.setattr(silver, "MAX_LISTED_TYPES", 0)
    unlisted = build(spark, calls, USERS)
    assert unlisted.type_ids("field_name", (c.OBJECTIONS,)) is None
    assert sorted(map(str, reports.objections_faced_report(unlisted).collect())) == expected


def test_pooled_rates(spark):
    report = spark.createDataFrame(
        [("d1", 1, 1, 0), ("d1", 50, 40, 0), ("d2", 0, 0, 0)],
        "triage_date string, inbound_booked int, inbound_taken int, total_sales int",
    )
    headline = metrics.inbound_headline(report).first()
    assert headline.show_rate == pytest.approx(41 / 51 * 100)
    trend = {r.triage_date: r.show_rate for r in metrics.inbound_trend(report).collect()}
    assert trend == {"d1": pytest.approx(41 / 51 * 100), "d2": 0.0}
    assert metrics.inbound_headline(report.limit(0)).first().show_rate == 0.0
    ordered = metrics.newest_first(report, "triage_date").collect()
    assert ordered[0].triage_date == "d2"


def test_error_rate(spark):
    checks = spark.sql(
        """SELECT timestamp_ntz'2024-01-01 12:00:00' AS check_time, 1L AS errors_seen, 100L AS rows_loaded
           UNION ALL SELECT timestamp_ntz'2024-01-01 12:00:00', 2L, 100L
           UNION ALL SELECT timestamp_ntz'2024-01-01 11:00:00', 90L, 100L"""
    )
    row = quality.error_rate(checks, datetime(2024, 1, 1, 12, 5)).first()
    assert (row.error_rate, row.breached) == (0.015, True)
    none = quality.error_rate(checks, datetime(2024, 1, 2)).first()
    assert (none.error_rate, none.breached) == (0.0, False)
