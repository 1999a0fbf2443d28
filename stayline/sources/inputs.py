"""The input model, mapped from the given star schema.

A real deployment passes its own tables; the attribute names and column names below are
the contract. Each property is a lazy frame over the given parquet files, so its size
follows them.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.functions.keys import composite_key
from stayline.functions.numeric import MONEY
from stayline.session import shuffled

AS_OF = dt.date(2001, 8, 2)
PROMO_PREFIX = "hot gi"
NETWORK_CODES = ("AFR", "ASI", "EUR")
RAW_GROUPS = ("Daycare", "Diagnostics", "Medications - Oral", "Referrals Ext", "Retail Foods", "To Print")
SPECIES = ("Canine (Dog)", "Feline (Cat)", "Avian")
SIZE_RULES = {
    "small": ("small", "ring"),
    "medium": ("gear", "blue"),
    "large": ("widget", "hot"),
    "cat": ("late",),
    "other_animal": ("anvil",),
}


def _amount(factor: str) -> str:
    """Signed net line amount built from decimal inputs, so that sums are exact."""
    return (
        "cast(case when l_returnflag = 'R' then -1 else 1 end as decimal(2,0))"
        " * cast(l_extendedprice as decimal(12,2))"
        " * (cast(1 as decimal(4,2)) - cast(l_discount as decimal(4,2)))"
        f" * cast({factor} as decimal(4,3))"
    )


# -- fixed values: columns of the given tables this mapping reads (no schema inference job) ---
_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double,"
        " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


class Inputs:
    """Lazy input tables for one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            reader = self.spark.read.schema(_SCHEMAS[name]) if name in _SCHEMAS else self.spark.read
            self._raw[name] = reader.parquet(f"{self.folder}/{name}.parquet")
        return self._raw[name]

    def until(self, day: dt.date) -> Inputs:
        """The same tables as they were before ``day``: later transactions are not there yet."""
        earlier = Inputs(self.spark, self.folder)
        earlier.__dict__["transactions"] = self.transactions.where(F.col("datetime_date") < F.lit(day))
        return earlier

    # -- clinic tables ---------------------------------------------------------------------
    @cached_property
    def transactions(self) -> DataFrame:
        lines = self.raw("lineitem").select(
            "l_orderkey", F.col("l_partkey").alias("product_id"), F.expr(_amount("0.002")).cast(MONEY).alias("revenue")
        )
        orders = self.raw("orders").select(
            F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("animal_id"), F.col("o_orderdate").alias("datetime_date")
        )
        where = self.raw("customer").select(
            F.col("c_custkey").alias("animal_id"), F.col("c_nationkey").alias("location_id"), (F.col("c_nationkey") % 5).alias("division_id")
        )
        names = self.raw("part").select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"))
        # Orders meet customers before the lines do: the smaller tables are joined first.
        return (
            lines.join(shuffled(orders.join(shuffled(where), "animal_id")), "l_orderkey")
            .join(shuffled(names), "product_id")
            .withColumnRenamed("l_orderkey", "invoice_id")
        )

    @cached_property
    def animals(self) -> DataFrame:
        key = F.col("c_custkey")
        balance = F.col("c_acctbal").cast("decimal(12,2)")
        return shuffled(self.raw("customer")).select(
            key.alias("id"),
            key.alias("ezyvet_id"),
            F.col("c_nationkey").alias("location_id"),
            key.alias("contact_id"),
            F.col("c_mktsegment").alias("breed"),
            F.element_at(F.array(*[F.lit(s) for s in SPECIES]), (key % 3 + 1).cast("int")).alias("species"),
            F.when(key % 29 != 0, 600000000 + key * 100000).alias("date_of_birth"),
            F.when(key % 17 == 0, F.lit(None))
            .when(F.col("c_acctbal") < 0, F.lit(0))
            .otherwise(balance * F.lit("0.01").cast("decimal(3,2)"))
            .cast("decimal(15,4)")
            .alias("weight"),
            (key % 23 == 0).cast("int").alias("is_dead"),
            (key % 19 != 0).cast("int").alias("active"),
        )

    @cached_property
    def products(self) -> DataFrame:
        kind = F.col("p_type")
        group = F.when(kind == "PROMO", RAW_GROUPS[4]).when(kind == "SMALL", RAW_GROUPS[0]).when(kind == "MEDIUM", RAW_GROUPS[2])
        group = group.when(kind == "LARGE", RAW_GROUPS[3]).when(kind == "ECONOMY", RAW_GROUPS[5]).otherwise(RAW_GROUPS[1])
        # One catalogue row per clinic: a generator over the list of clinics, not a join. The planner counts none of its rows.
        clinics = self.raw("nation").agg(F.collect_list("n_nationkey")).scalar()
        return shuffled(self.raw("part")).withColumn("clinics", clinics).select(
            F.col("p_partkey").alias("ezyvet_id"),
            F.explode("clinics").alias("location_id"),
            F.col("p_name").alias("name"),
            F.col("p_brand").alias("type"),
            kind.alias("tracking_level"),
            group.alias("product_group"),
            (F.col("p_size") % 2).alias("is_medical"),
        )

    @cached_property
    def contacts(self) -> DataFrame:
        """Every 13th contact is missing and every 11th is stored twice."""
        key = F.col("c_custkey")
        copies = F.when(key % 11 == 0, 2).otherwise(1)
        return (
            shuffled(self.raw("customer"))
            .where(key % 13 != 0)
            .select(key.alias("ezyvet_id"), F.col("c_nationkey").alias("location_id"), F.explode(F.sequence(F.lit(1), copies)).alias("copy"))
            .drop("copy")
        )

    @cached_property
    def divisions(self) -> DataFrame:
        return self.raw("region").select(F.col("r_regionkey").alias("division_id"))

    @cached_property
    def appointments(self) -> DataFrame:
        booked = self.raw("orders").select(F.col("o_custkey").alias("ezyvet_id"))
        where = self.raw("customer").select(F.col("c_custkey").alias("ezyvet_id"), F.col("c_nationkey").alias("location_id"))
        return booked.join(shuffled(where), "ezyvet_id")

    @cached_property
    def wellness_membership(self) -> DataFrame:
        urgent = self.raw("orders").where(F.col("o_orderpriority") == "1-URGENT").select(
            F.col("o_custkey").alias("animal_id"),
            F.col("o_orderdate").alias("datetime_start_date"),
            (F.col("o_orderkey") % 4).alias("wellness_plan"),
        )
        where = self.raw("customer").select(F.col("c_custkey").alias("animal_id"), F.col("c_nationkey").alias("location_id"))
        return urgent.join(shuffled(where), "animal_id")

    @cached_property
    def wellness_plans(self) -> DataFrame:
        """Plans 0..2 of every clinic; plan 3 has no row."""
        return self.raw("nation").select(
            F.col("n_nationkey").alias("location_id"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("ezyvet_id")
        ).withColumn("name", F.concat(F.lit("Plan "), F.col("ezyvet_id").cast("string")))

    @cached_property
    def breeds(self) -> DataFrame:
        # -- fixed values: class of each market segment ------------------------------------
        classes = {
            "AUTOMOBILE": ("tier_2", "medium"),
            "BUILDING": ("tier_1", "small"),
            "FURNITURE": ("tier_4", "other_animal"),
            "HOUSEHOLD": ("None", "cat"),
            "MACHINERY": ("tier_3", "large"),
        }
        breed = F.col("breed")
        tier = size = None
        for name, (t, s) in classes.items():
            tier = F.when(breed == name, t) if tier is None else tier.when(breed == name, t)
            size = F.when(breed == name, s) if size is None else size.when(breed == name, s)
        return self.raw("customer").select(F.col("c_mktsegment").alias("breed")).distinct().select(
            breed, tier.alias("tier"), F.lit(0.5).alias("tier_score"), size.alias("breed_size")
        )

    @cached_property
    def scored(self) -> DataFrame:
        """Predictions already stored: visit 1 for every third customer, visit 2 for every sixth."""
        key = F.col("c_custkey")
        done = F.when(key % 6 == 0, F.sequence(F.lit(1), F.lit(2))).otherwise(F.sequence(F.lit(1), F.lit(1)))
        return (
            shuffled(self.raw("customer"))
            .where(key % 3 == 0)
            .select(key, composite_key("c_nationkey", "c_custkey").alias("uid"), F.explode(done).alias("predict_for_visit_number"))
            .select(
                (key * 10 + F.col("predict_for_visit_number")).alias("id"),
                "uid",
                "predict_for_visit_number",
                F.lit(1).cast("smallint").alias("total_num_visit"),
                F.lit(0).cast("decimal(6,0)").alias("total_future_spend"),
            )
        )

    # -- staffing tables -------------------------------------------------------------------
    @cached_property
    def doctor_lines(self) -> DataFrame:
        """Revenue lines with division, doctor and appointment."""
        lines = self.raw("lineitem").select(
            "l_orderkey", "l_suppkey", "l_linenumber", "l_partkey", F.expr(_amount("0.020")).cast(MONEY).alias("revenue")
        )
        orders = self.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
        doctors = self.raw("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", F.col("s_nationkey").alias("n_nationkey"))
        places = self.raw("nation").join(
            self.raw("region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey"
        ).select("n_nationkey", composite_key("r_name", "n_name").alias("division_name"), F.col("n_regionkey").alias("network_id"))
        order_id = F.col("l_orderkey")
        return lines.join(orders, "l_orderkey").join(doctors.join(places, "n_nationkey"), "l_suppkey").select(
            "division_name",
            "network_id",
            F.col("o_orderdate").alias("transaction_at"),
            F.col("o_orderdate").alias("revenue_at"),
            order_id.alias("invoice_id"),
            "revenue",
            (F.col("l_partkey") % 2).cast("int").alias("appt_is_medical"),
            F.when(order_id % 50 != 0, order_id).alias("appointment_id"),
            F.col("s_name").alias("veterinarian"),
            (F.col("l_linenumber") == 1).cast("int").alias("first_appt"),
            F.col("l_suppkey").alias("doctor_key"),
        )

    @cached_property
    def availability(self) -> DataFrame:
        day = F.to_date("transaction_at")
        doctor = F.col("doctor_key")
        return (
            self.doctor_lines.select("division_name", day.alias("appointment_date"), F.col("veterinarian").alias("primary_resource_name"), doctor)
            .distinct()
            .select(
                "division_name",
                "appointment_date",
                "primary_resource_name",
                ((doctor * 11 + F.dayofmonth("appointment_date")) % 120).cast("double").alias("free_time"),
                F.lit(480.0).alias("minutes_in_office"),
                ((doctor * 7) % 60).cast("double").alias("block_minutes"),
            )
        )

    # -- model-run registry ----------------------------------------------------------------
    @cached_property
    def experiments(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self.raw("nation").select(
            key.alias("experiment_id"), F.when(key % 5 == 0, "deleted").otherwise("active").alias("lifecycle_stage")
        )

    @cached_property
    def experiment_tags(self) -> DataFrame:
        return self.raw("nation").select(F.col("n_nationkey").alias("experiment_id"), F.col("n_name").alias("key"))

    @cached_property
    def runs(self) -> DataFrame:
        key = F.col("o_orderkey")
        return self.raw("orders").select(
            key.alias("run_uuid"),
            (F.col("o_custkey") % 25).cast("int").alias("experiment_id"),
            F.col("o_orderdate").alias("start_time"),
            ((key * 7919 % 200) / 200.0).cast("double").alias("Precision_Binary"),
            ((key * 104729 % 500) / 500.0).cast("double").alias("F1_Binary"),
        )

    @cached_property
    def metrics(self) -> DataFrame:
        return self.raw("lineitem").select(F.col("l_orderkey").alias("run_uuid"), F.col("l_returnflag").alias("key"), F.col("l_quantity").alias("value"))

    @cached_property
    def latest_metrics(self) -> DataFrame:
        return self.raw("lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").alias("run_uuid"), F.col("l_returnflag").alias("key"))

    @cached_property
    def run_params(self) -> DataFrame:
        return self.raw("orders").select(F.col("o_orderkey").alias("run_uuid"), F.col("o_orderpriority").alias("key"))

    @cached_property
    def run_tags(self) -> DataFrame:
        return self.raw("orders").select(F.col("o_orderkey").alias("run_uuid"), F.col("o_orderstatus").alias("key"))

    # -- labelled predictions --------------------------------------------------------------
    @cached_property
    def predictions(self) -> DataFrame:
        """Six-band labels and predictions, plus a binary target with a score, from events."""
        user, event = F.col("user_id"), F.col("event_id")
        label = (user % 6).cast("int")
        return self.raw("events").select(
            label.alias("label"),
            F.when(event % 3 == 0, (user + 1) % 6).when(event % 7 == 0, F.lit(2)).otherwise(user % 6).cast("int").alias("prediction"),
            (F.col("event_type") == "purchase").cast("int").alias("target"),
            ((event * 31 % 997 + F.when(F.col("event_type") == "purchase", 400).otherwise(0)) / 1400.0).cast("double").alias("score"),
        )

    @cached_property
    def size_keywords(self) -> DataFrame:
        """The keyword table: the size rules, one row a keyword."""
        rows = [(name, word) for name, words in SIZE_RULES.items() for word in words]
        return self.spark.createDataFrame(rows, "size_class string, keyword string")

    @cached_property
    def labelled_names(self) -> DataFrame:
        """Names that already have a tier: a bounded list of the distinct two-word names."""
        return self.raw("part").select(F.col("p_name").alias("unique_breed")).distinct().where(F.length("unique_breed") % 3 != 0).withColumn(
            "matching_breed", F.concat(F.lit("tier_"), (F.length("unique_breed") % 4 + 1).cast("string"))
        )
