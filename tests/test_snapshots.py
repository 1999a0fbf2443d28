"""Visits and snapshots on hand-made frames, and against a brute-force reading of the rules."""

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stayline.operators import facts as ops
from stayline.operators import spend
from stayline.operators import visits as V
from stayline.plans import snapshots
from stayline.sources.inputs import AS_OF, Inputs

TX = "location_id int, animal_id long, datetime_date timestamp_ntz, revenue decimal(12,2), product_id long, product_name string"


def day(text):
    return dt.datetime.fromisoformat(text)


def tx(spark, rows):
    return spark.createDataFrame([(r[0], r[1], day(r[2]), Decimal(str(r[3])), r[4] if len(r) > 4 else 1, r[5] if len(r) > 5 else "p") for r in rows], TX)


def animals(spark, ids):
    return spark.createDataFrame([(i, i, 1, i, "b", 0, Decimal(5)) for i in ids], "id long, ezyvet_id long, location_id int, contact_id long, breed string, date_of_birth long, weight decimal(15,4)")


def numbers(frame):
    return [(str(r.day), r.visit_number, r.max_num_visit) for r in frame.orderBy("uid", "day").collect()]


def test_days_across_a_month_end_are_one_visit_and_net_zero_days_none(spark):
    t = tx(spark, [(1, 7, "2020-02-28", 5), (1, 7, "2020-02-29", 5), (1, 7, "2020-03-01", 5), (1, 7, "2020-03-05", 5), (1, 7, "2020-03-05", -10), (1, 7, "2020-03-09", 1)])
    a = animals(spark, [7])
    assert numbers(V.visits(t, a)) == [("2020-02-28", 1, 2), ("2020-02-29", 1, 2), ("2020-03-01", 1, 2), ("2020-03-09", 2, 2)]
    # Daily lines give the same visits; single positive lines keep the day; ranks skip.
    assert numbers(V.visits(V.daily_lines(t), a)) == numbers(V.visits(t, a))
    assert numbers(V.visits(t, a, rule="line", numbering="rank")) == [
        ("2020-02-28", 1, 5), ("2020-02-29", 1, 5), ("2020-03-01", 1, 5), ("2020-03-05", 4, 5), ("2020-03-09", 5, 5)
    ]


def test_unregistered_animals_and_missing_keys_have_no_visits(spark):
    t = tx(spark, [(1, 7, "2020-01-01", 5), (2, 7, "2020-01-01", 5), (1, 8, "2020-01-01", 5)])
    t = t.unionByName(t.limit(1).withColumn("location_id", F.lit(None).cast("int")))
    assert [r.uid for r in V.visits(V.daily_lines(t), animals(spark, [7])).collect()] == ["1_7"]
    with pytest.raises(ValueError):
        V.visits(t, animals(spark, [7]), rule="other")


def products(spark):
    return spark.createDataFrame([(1, 1, 1, "Retail Foods")], "ezyvet_id long, location_id int, is_medical int, product_group string")


def test_memberships_and_contacts_repeat_spend(spark):
    t = tx(spark, [(1, 7, "2020-01-01", 5), (1, 7, "2020-01-01", 5, 2, "q"), (1, 7, "2020-02-01", 3)])
    a = animals(spark, [7])
    lines = V.daily_lines(t)
    facts = ops.line_facts(lines, products(spark), a, AS_OF)
    wellness = spark.createDataFrame([("1_7", dt.date(2020, 1, 1), "x"), ("1_7", dt.date(2020, 1, 1), None)], "uid string, day date, wellness_plan string")
    contacts = spark.createDataFrame([(7, 1), (7, 1), (7, 1), (7, 2)], "ezyvet_id long, location_id int")
    copies = ops.contact_copies(a, contacts)

    def first(**how):
        days = spend.visit_days(facts, V.visits(lines, a), as_of=dt.date(2022, 1, 1), promo_prefix="q", **how)
        return spend.pick_visit(days, 1).first()

    plain = first()
    assert (plain.most_recent_visit_spend, plain.total_future_spend, plain.wellness_plan, plain.product_count) == (10, 3, 0, 1)
    member = first(wellness=wellness)
    assert (member.most_recent_visit_spend, member.wellness_plan, member.product_count) == (20, 2, 2)
    assert first(wellness=wellness, dedupe_wellness=True).most_recent_visit_spend == 10
    assert first(copies=copies).most_recent_visit_spend == 30
    listed = spend.snapshot_lines(facts, spend.pick_visit(spend.visit_days(facts, V.visits(lines, a), wellness, as_of=dt.date(2022, 1, 1)), 1), wellness)
    assert listed.count() == 4


def test_horizon_and_maturity(spark):
    t = tx(spark, [(1, 7, "2020-01-01", 5), (1, 7, "2021-07-02", 5), (1, 7, "2021-07-03", 7), (1, 8, "2020-01-01", 5)])
    a = animals(spark, [7, 8])
    lines = V.daily_lines(t)
    facts = ops.line_facts(lines, products(spark), a, AS_OF)

    def uids(as_of, **how):
        days = spend.visit_days(facts, V.visits(lines, a), as_of=as_of, **how)
        return {(r.uid, str(r.day), r.total_past_spend + r.most_recent_visit_spend + r.total_future_spend) for r in days.collect()}

    # 2021-07-02 is day 548, 2021-07-03 is day 549.
    assert uids(dt.date(2020, 9, 27)) == {("1_7", "2020-01-01", 10), ("1_7", "2021-07-02", 10), ("1_8", "2020-01-01", 5)}
    assert uids(dt.date(2020, 9, 26)) == set()
    assert len(uids(dt.date(2020, 9, 26), training=False)) == 4


def test_against_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for _ in range(600):
        who = 0 if rng.random() < 0.35 else rng.randrange(1, 25)
        rows.append((1, who, str(dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(700))), rng.choice([-20, 5, 9, 30]), rng.randrange(1, 4), rng.choice("pqr")))
    t, a = tx(spark, rows), animals(spark, range(25))
    lines = V.daily_lines(t)
    facts = ops.line_facts(lines, products(spark), a, AS_OF)
    got = {
        (r.uid, r.visit_number): (r.total_past_spend, r.most_recent_visit_spend, r.total_future_spend)
        for r in spend.snapshot_patients(spend.visit_days(facts, V.visits(lines, a), as_of=dt.date(2022, 6, 1))).collect()
    }
    totals = defaultdict(lambda: defaultdict(int))
    for _, who, d, revenue, *_ in rows:
        totals[who][dt.date.fromisoformat(d)] += revenue
    want = {}
    for who, days in totals.items():
        first = min(days)
        visit, last, numbered = 0, None, {}
        for d in sorted(k for k, v in days.items() if v > 0):
            visit += last is None or (d - last).days != 1
            last = d
            numbered[d] = visit
        kept = {d: v for d, v in numbered.items() if (d - first).days <= 548}
        for v in set(kept.values()):
            parts = [sum(days[d] for d, x in kept.items() if test(x)) for test in (lambda x: x < v, lambda x: x == v, lambda x: x > v)]
            want[(f"1_{who}", v)] = tuple(parts)
    assert got == want


def test_published_check_values(spark):
    """Numbers recorded for the given data at sf0.01, with contacts and plan names left out."""
    inputs = Inputs(spark, "/root/testdata/sf0.01")
    numbered = V.visits(inputs.transactions, inputs.animals).agg(F.count("*"), F.countDistinct("uid"), F.max("visit_number"), F.sum("visit_number")).first()
    assert tuple(numbered) == (10653, 1499, 17, 48306)
    snap = snapshots.build(inputs, AS_OF, contacts=False, plans=False)
    facts = snap.facts.agg(F.count("*"), F.sum("revenue")).first()
    assert tuple(facts) == (59797, Decimal("1999329.1802762"))
    lines = snapshots.visit_lines(inputs, snap, AS_OF, 2)
    got = lines.agg(F.count("*"), F.countDistinct("uid"), F.sum("total_future_spend"), F.sum("most_recent_visit_spend"), F.sum("total_past_spend"), F.sum("wellness_plan")).first()
    assert tuple(got) == (4441, 1074, Decimal("982391.7876368"), Decimal("1222845.2927166"), Decimal("1091278.7394578"), 11403)
    patients = spend.snapshot_patients(spend.pick_visit(snap.days, up_to=5)).groupBy("visit_number").count().orderBy("visit_number")
    assert [r["count"] for r in patients.collect()] == [1413, 1074, 602, 264, 85]
