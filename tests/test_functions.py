import datetime as dt

from pyspark.sql import functions as F

from stayline import params as P
from stayline.functions import dates as D
from stayline.functions import keys as K
from stayline.functions import numeric as N
from stayline.functions import text as X


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def d(text):
    return F.lit(text).cast("date")


def test_boundaries_are_counted_not_elapsed_time(spark):
    row = one(
        spark,
        years=D.years_crossed(d("2023-12-31"), d("2024-01-01")),
        months=D.months_crossed(d("2024-01-31"), d("2024-02-01")),
        days=D.days_between(d("2024-02-28"), d("2024-03-01")),
        sunday=D.dow_sunday0(d("2024-01-07")),
        monday=D.dow_monday0(d("2024-01-01")),
        half=D.months_before("2024-08-31", 6),
    )
    assert (row.years, row.months, row.days, row.sunday, row.monday) == (1, 1, 2, 0, 0)
    assert row.half == dt.date(2024, 2, 29)


def test_epoch_and_zone_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            row = one(spark, day=D.local_day(F.lit(1704070800), "America/Chicago"), utc=F.to_date(D.epoch_to_timestamp(F.lit(-1))))
            assert row.day == dt.date(2023, 12, 31) and row.utc == dt.date(1969, 12, 31)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_bands_are_right_closed(spark):
    values = [-0.5, 0.0, 1.0, 1.5, 200.0, 200.01, 350.0, 500.0, 1000.0, 99999.0, 100000.0, None]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(
        N.right_closed_band(F.col("v"), P.BAND_EDGES).alias("b"), N.right_closed_band(F.col("v"), P.BINARY_EDGES).alias("y")
    ).collect()
    assert [r.b for r in rows] == [None, 0, 0, 1, 1, 2, 2, 3, 4, 5, None, None]
    assert [r.y for r in rows] == [None, 0, 0, 1, 1, 1, 1, 1, 1, 1, None, None]


def test_clip_sentinel_and_rounding(spark):
    row = one(
        spark,
        high=N.clip(F.lit(6000.0), 0.0, 5000.0), low=N.clip(F.lit(-1.0), 0.0, 5000.0), null=N.clip(F.lit(None).cast("double"), 0.0, 5000.0),
        sent=N.nonpositive_to(F.lit(0.0), -999.0), kept=N.nonpositive_to(F.lit(None).cast("double"), -999.0),
        even=N.round_half_even(F.lit(0.0625), 3), first=N.argmax(F.array(F.lit(0.1), F.lit(0.4), F.lit(0.4))),
        full=N.utilisation(F.lit(0.0), F.lit(0.0), F.lit(0.0)), none=N.ratio(F.lit(1), F.lit(0)),
    )
    assert (row.high, row.low, row.null) == (5000.0, 0.0, None)
    assert (row.sent, row.kept, row.even, row["first"], row.full, row.none) == (-999.0, None, 0.062, 1, 1.0, None)


def test_keys(spark):
    row = one(spark, key=K.composite_key(F.lit(3), F.lit(7)), null=K.composite_key(F.lit(3), F.lit(None)))
    assert row.key == "3_7" and row.null is None
    buckets = spark.range(2000).select(K.hash_bucket("id", 42).alias("b"))
    assert 1500 < buckets.where("b < 80").count() < 1700
    assert buckets.repartition(7).agg(F.sum("b")).first() == buckets.agg(F.sum("b")).first()


def test_product_groups(spark):
    groups = ["Retail Foods", "Daycare Packages", "Medications - Oral", "Referrals X", "to print", "Imaging", None]
    out = spark.createDataFrame([(g,) for g in groups], "g string").select(X.merged_product_group(F.col("g")).alias("m")).collect()
    assert [r.m for r in out] == ["Retail", "Boarding", "Medication", "Referrals", "admin", "Imaging", None]


def test_later_keyword_class_wins_and_text_is_quoted(spark):
    rules = {"small": ["pug", "a.b"], "medium": ["houla"], "cat": ["cat"]}
    names = ["Pug mix", "CATAHOULA", "axb", "a.b dog", "unknown", None]
    out = spark.createDataFrame([(n,) for n in names], "n string").select(X.classify_by_keywords(F.col("n"), rules).alias("c")).collect()
    assert [r.c for r in out] == ["small", "cat", "medium", "small", "medium", None]


def test_words(spark):
    row = one(spark, two=X.first_words(F.lit("a b c")), one_word=X.first_words(F.lit("solo")), head=X.leading(F.lit("NASHVILLE"), 3), t=X.tokens(F.lit("Welsh Corgi, corgi")))
    assert (row.two, row.one_word, row["head"], row.t) == ("a b", "solo", "NAS", ["welsh", "corgi"])
