"""Queries of the staffing study, order statistics and tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayline.contract.query import Query
from stayline.operators import order_stats as O
from stayline.operators import staffing as S
from stayline.plans import staffing as plan
from stayline.session import work_path
from stayline.sources import sinks
from stayline.sources.inputs import NETWORK_CODES, Inputs
from stayline.sources.tables import read_csv

AFTER, BEFORE = "1996-01-01", "2000-12-31"
BOXES = ("doctor_utilization", "rev_per_hour", "first_appt_ratio")
GRID = [float(x) for x in range(0, 201, 10)]
UTIL_SPEC = (
    "division_name:s appointment_date:s primary_resource_name:s free_time:d minutes_in_office:d block_minutes:d appointment_count:i"
    " first_appointment_count:i revenue:d weekday:i doctor_utilization:d rev_per_min:d rev_per_hour:d first_appt_ratio:d network:s"
)
_EXTRACT_SPEC = (
    "division_name:s appointment_date:s primary_resource_name:s free_time:d minutes_in_office:d block_minutes:d appointment_count:i first_appointment_count:i revenue:d"
)
_EXTRACT_SCHEMA = (
    "division_name string, appointment_date date, primary_resource_name string, free_time double, minutes_in_office double, block_minutes double,"
    " appointment_count bigint, first_appointment_count bigint, revenue decimal(24,7)"
)
_NUMBERS = ("free_time", "block_minutes", "appointment_count", "doctor_utilization", "rev_per_hour", "first_appt_ratio")


def _study(t: Inputs):
    return plan.study(t, AFTER, BEFORE)


def _ranged(t: Inputs):
    return S.in_study(plan.utilisation(t), AFTER, BEFORE)


def _percentiles(t: Inputs):
    return O.percentiles(plan.utilisation(t), "rev_per_hour", (0.25, 0.75, 0.9))


def _weekday_box(t: Inputs):
    return O.box_stats(_study(t), BOXES, ["network", "weekday"])


def _split_counts(t: Inputs):
    split = S.split_per_code(_study(t), NETWORK_CODES)
    return split.groupBy("side", "division_name").agg(F.count("*").alias("n"))


def _weekday_pairs():
    """Each weekday of the listed networks against their Saturday, and Saturday of the others."""
    listed, day = S.in_networks(NETWORK_CODES), F.col("weekday")
    saturday = listed & (day == 5)
    pairs = {"others_5": (~listed & (day == 5), saturday)}
    pairs |= {f"listed_{k}": (listed & (day == k), saturday) for k in (4, 3, 2, 1)}
    return pairs


def _ttests(t: Inputs):
    return S.t_tests(_study(t), "rev_per_hour", _weekday_pairs())


def _csv(t: Inputs):
    path = work_path(t.spark, "csv")
    sinks.write_csv(plan.utilisation(t).select(*[p.split(":")[0] for p in _EXTRACT_SPEC.split()]), path)
    return read_csv(t.spark, path, _EXTRACT_SCHEMA)


# Student's density by t = sqrt(df) tan(x) is a power of the cosine; its tail from t on, by Simpson's rule in 20,000 steps.
_P_SQL = """
(select sum(case when i in (0, 20000) then 1 when i % 2 = 1 then 4 else 2 end * case when i = 20000 then 0 else exp((df - 1) * ln(cos(lo + i * (pi() / 2 - lo) / 20000))) end)
    * (pi() / 2 - any_value(lo)) / 60000 * 2 / exp(lgamma(0.5) + lgamma(df / 2.0) - lgamma(df / 2.0 + 0.5))
  from (select unnest(range(0, 20001)) as i, atan(abs(t) / sqrt(df)) as lo))"""


def _ttest_sql(name: str, first: str) -> str:
    listed = "(" + " or ".join(f"contains(division_name, '{c}')" for c in NETWORK_CODES) + ")"
    a, b = first.format(listed=listed), f"{listed} and weekday = 5"
    return f"""
select *, {_P_SQL} as p from (select '{name}' as test, n_a, n_b, n_a + n_b - 2 as df, (m_a - m_b) / sqrt(((n_a - 1) * v_a + (n_b - 1) * v_b) / (n_a + n_b - 2) * (1.0 / n_a + 1.0 / n_b)) as t
from (select count(*) filter (where {a}) as n_a, avg(rev_per_hour) filter (where {a}) as m_a, var_samp(rev_per_hour) filter (where {a}) as v_a,
    count(*) filter (where {b}) as n_b, avg(rev_per_hour) filter (where {b}) as m_b, var_samp(rev_per_hour) filter (where {b}) as v_b from v_study))"""


_TTESTS = " union all ".join(
    [_ttest_sql("others_5", "not {listed} and weekday = 5")] + [_ttest_sql(f"listed_{k}", "{listed} and weekday = " + str(k)) for k in (4, 3, 2, 1)]
)
_CORR = " union all ".join(
    f"select '{a}' as column_a, '{b}' as column_b, {'max(1.0)' if a == b else f'corr({a}, {b})'} as r from v_study" for a in _NUMBERS for b in _NUMBERS
)
_PCT = " union all ".join(f"select {p} as prob, quantile_cont(rev_per_hour, {p}) as value from v_util" for p in (0.25, 0.75, 0.9))
_BOX = " union all ".join(
    f"""
select '{x}' as measure, network, weekday, q1, median, q3, min({x}) filter (where inside) as low_whisker, max({x}) filter (where inside) as high_whisker,
  count(*) filter (where not inside) as outliers, count(*) as n
from (select *, {x} between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) as inside
  from (select network, weekday, {x}, quantile_cont({x}, 0.25) over w as q1, quantile_cont({x}, 0.5) over w as median,
    quantile_cont({x}, 0.75) over w as q3 from v_study where {x} is not null window w as (partition by network, weekday)))
group by 2, 3, 4, 5, 6"""
    for x in BOXES
)


def _density_sql(keys: str) -> str:
    return f"""
select {keys}, g as at, sum(exp(-0.5 * power((g - rev_per_hour) / h, 2))) / (n * h * sqrt(2 * pi())) as density
from (select {keys}, rev_per_hour, count(*) over w as n, nullif(stddev_samp(rev_per_hour) over w * power(count(*) over w, -0.2), 0) as h from v_study window w as (partition by {keys})),
  (select unnest({GRID}) as g) group by {keys}, g, n, h"""


_CODES = "[" + ", ".join(f"'{c}'" for c in NETWORK_CODES) + "]"

QUERIES: dict[str, Query] = {
    "rev_by_dow": Query(
        lambda t: S.revenue_by_dow(t.doctor_lines),
        "network:s appointment_dow:i average_rev:d",
        """select network, dayofweek(transaction_at) as appointment_dow, sum(revenue)::double / count(revenue) as average_rev from (
          select left(division_name, 3) as network, transaction_at, invoice_id, sum(revenue) as revenue from fx_doctor_lines
          where appt_is_medical = 1 and appointment_id is not null group by 1, 2, 3) group by 1, 2""",
    ),
    "rev_pivot": Query(
        lambda t: S.revenue_pivot(S.revenue_by_dow(t.doctor_lines)),
        "network:s " + " ".join(f"dow_{d}:d" for d in range(7)),
        "select network, " + ", ".join(f"sum(revenue) filter (where dow = {d})::double / count(revenue) filter (where dow = {d}) as dow_{d}" for d in range(7))
        + """ from (select left(division_name, 3) as network, dayofweek(transaction_at) as dow, transaction_at, invoice_id, sum(revenue) as revenue from fx_doctor_lines
          where appt_is_medical = 1 and appointment_id is not null group by 1, 2, 3, 4) group by 1""",
    ),
    "doctor_day": Query(
        lambda t: S.doctor_days(t.doctor_lines),
        "division_name:s network_id:i appointment_at_date:s veterinarian:s appointment_count:i first_appointment_count:i revenue:d",
        "select * from v_doctor_day",
    ),
    "doctor_util": Query(plan.utilisation, UTIL_SPEC, "select * from v_util"),
    "study_rows": Query(_study, UTIL_SPEC, "select * from v_study"),
    "outlier_rows": Query(
        lambda t: S.outliers(_ranged(t)), "primary_resource_name:s appointment_date:s rev_per_hour:d", "select primary_resource_name, appointment_date, rev_per_hour from v_ranged where rev_per_hour > 200"
    ),
    "weekday_stats": Query(
        lambda t: S.mean_and_count(_study(t), "doctor_utilization", ["weekday"]), "weekday:i mean:r9 n:i", "select weekday, avg(doctor_utilization) as mean, count(*) as n from v_study group by 1"
    ),
    "weekday_revenue": Query(
        lambda t: S.mean_and_count(_study(t), "rev_per_hour", ["weekday"]), "weekday:i mean:r6 n:i", "select weekday, avg(rev_per_hour) as mean, count(*) as n from v_study group by 1"
    ),
    "weekday_doctor_stats": Query(
        lambda t: S.mean_and_count(_study(t), "doctor_utilization", ["weekday", "primary_resource_name"]),
        "weekday:i primary_resource_name:s mean:r9 n:i",
        "select weekday, primary_resource_name, avg(doctor_utilization) as mean, count(*) as n from v_study group by 1, 2",
    ),
    "doctor_day_counts": Query(
        lambda t: S.rows_per_doctor_day(_ranged(t)),
        "primary_resource_name:s appointment_date:s n:i",
        "select primary_resource_name, appointment_date, count(*) as n from v_ranged group by 1, 2",
    ),
    "percentiles": Query(_percentiles, "prob:d value:r4", _PCT),
    "box_stats": Query(_weekday_box, "measure:s network:s weekday:i q1:r4 median:r4 q3:r4 low_whisker:r4 high_whisker:r4 outliers:i n:i", _BOX),
    "corr_matrix": Query(lambda t: S.correlations(_study(t), _NUMBERS), "column_a:s column_b:s r:r6", _CORR),
    "density_grid": Query(lambda t: O.density(_study(t), "rev_per_hour", "weekday", GRID), "weekday:i at:d density:r9", _density_sql("weekday")),
    "density_division": Query(
        lambda t: O.density(_study(t), "rev_per_hour", ["division_name", "weekday"], GRID),
        "division_name:s weekday:i at:d density:r9",
        _density_sql("division_name, weekday"),
    ),
    "network_split": Query(
        _split_counts,
        "side:s division_name:s n:i",
        f"select case when contains(division_name, code) then 'A' else 'B' end as side, division_name, count(*) as n from v_study, (select unnest({_CODES}) as code) group by 1, 2",
    ),
    "ttest_weekday": Query(_ttests, "test:s n_a:i n_b:i df:i t:r6 p:r9", _TTESTS),
    "csv_roundtrip": Query(_csv, _EXTRACT_SPEC, "select * from v_util"),
}
