"""What is sent to the driver for a join must not follow the tables."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from stayline.contract import ALL, retention
from stayline.operators import facts, scoring
from stayline.operators.visits import daily_lines
from stayline.sources.inputs import AS_OF, Inputs

PROFILE = ["cutoff_semi", "breed_profile", "facet_share", "first_visit_hist", "frequent_names", "group_transition"]
SNAPSHOT = ["line_facts_left", "global_sum", "feature_frame", "label_bands", "label_binary", "scores_target", "scoring_features", "returning_refresh"]
#: Tables of fixed size, and the classes of the breeds table.
SMALL = re.compile(r"n_nationkey|r_regionkey|c_mktsegment")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables whose files, unlike what joins make of them, count as small enough to be broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    at = str(tmp_path_factory.mktemp("tables"))
    day = F.lit(dt.datetime(1996, 1, 1)).cast("timestamp_ntz")
    n = F.col("id")
    frames = {
        "region": spark.range(2).select(n.cast("int").alias("r_regionkey"), F.lit("R").alias("r_name")),
        "nation": spark.range(3).select(F.when(n < 2, n).cast("int").alias("n_nationkey"), F.lit("N").alias("n_name"), F.lit(0).alias("n_regionkey")),
        "customer": spark.range(20).select(n.alias("c_custkey"), F.lit("c").alias("c_name"), (n % 2).cast("int").alias("c_nationkey"), F.lit(900.0).alias("c_acctbal"), F.lit("BUILDING").alias("c_mktsegment")),
        "supplier": spark.range(2).select(n.alias("s_suppkey"), F.lit("s").alias("s_name"), F.lit(0).alias("s_nationkey"), F.lit(0.0).alias("s_acctbal")),
        "part": spark.range(10).select(n.alias("p_partkey"), F.lit("hot rod").alias("p_name"), F.lit("b").alias("p_brand"), F.lit("SMALL").alias("p_type"), F.lit(1).alias("p_size"), F.lit(1.0).alias("p_retailprice")),
        "orders": spark.range(60).select(n.alias("o_orderkey"), (n % 20).alias("o_custkey"), F.lit("O").alias("o_orderstatus"), F.lit(1.0).alias("o_totalprice"), (day + F.make_interval(days=(n % 50).cast("int"))).alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority")),
        "lineitem": spark.range(200).select(
            (n % 60).alias("l_orderkey"), (n % 10).alias("l_partkey"), (n % 2).alias("l_suppkey"), F.lit(1).alias("l_linenumber"), F.lit(1.0).alias("l_quantity"), F.lit(90000.0).alias("l_extendedprice"),
            F.lit(0.0).alias("l_discount"), F.lit(0.0).alias("l_tax"), F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"), day.alias("l_shipdate"),
        ),
    }
    for name, frame in frames.items():
        frame.coalesce(1).write.parquet(f"{at}/{name}.parquet")
    yield at
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def broadcasts(df) -> list[str]:
    """The sides of joins that the plan would broadcast before anything has run, but for tables of fixed size and
    lists cut to a fixed length."""
    stack, found = [df._jdf.queryExecution().sparkPlan()], []
    while stack:
        node = stack.pop()
        children = [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "BroadcastHashJoin":
            side = children[0 if node.buildSide().toString() == "BuildLeft" else 1].toString()
            scans = re.findall(r"FileScan parquet \[([^\]]*)\]", side)
            if "TakeOrderedAndProject" not in side and not all(SMALL.match(scan) for scan in scans):
                found.append(side[:300])
        stack += children
    return found


def test_the_catalogue_has_a_row_for_each_clinic(spark, folder):
    rows = Inputs(spark, folder).products.select("ezyvet_id", "location_id").collect()
    assert sorted(map(tuple, rows)) == [(p, c) for p in range(10) for c in range(2)]


def test_line_facts_broadcast_no_table_that_grows(spark, folder):
    t = Inputs(spark, folder)
    assert broadcasts(facts.line_facts(daily_lines(t.transactions), t.products, t.animals, AS_OF, True)) == []


@pytest.mark.parametrize("name", PROFILE + SNAPSHOT)
def test_queries_broadcast_no_table_that_grows(spark, folder, name):
    assert broadcasts(ALL[name].frame(Inputs(spark, folder))) == []


def test_stored_scores_are_not_broadcast(spark, folder):
    spark.range(100).select(F.col("id").cast("string").alias("uid"), F.lit(1).cast("smallint").alias("predict_for_visit_number")).write.parquet(f"{folder}/stored")
    stored = spark.read.parquet(f"{folder}/stored")
    rows = stored.withColumn("visit_number", F.col("predict_for_visit_number").cast("int"))
    for any_visit in (False, True):
        left = scoring.not_yet_scored(rows, stored.where("uid <> '7'"), any_visit)
        assert broadcasts(left) == [] and [r.uid for r in left.collect()] == ["7"]


def test_appended_scores_are_computed_once(spark, folder, monkeypatch):
    """Four writers add predictions; their rows are made once, not for each of them."""
    made, target = spark.sparkContext.accumulator(0), retention._target_rows

    def seen(uid):
        made.add(1)
        return uid

    told = F.udf(seen, "string").asNondeterministic()
    monkeypatch.setattr(retention, "_target_rows", lambda t: target(t).withColumn("uid", told("uid")))
    rows = ALL["append_scores"].frame(Inputs(spark, folder)).collect()
    assert len({r.uid for r in rows}) == len(rows) == 20 and made.value == 20
