"""Queries of the return study."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayline.contract.query import Query
from stayline.operators import returns as R
from stayline.operators.order_stats import histogram
from stayline.plans import returns as plan
from stayline.sources.inputs import AS_OF, RAW_GROUPS, Inputs

PROFILE = "animal_id:i {}:s ani_age:i day:s weight:d name:s type:s tracking_level:s product_group:s visit_more_than_once:i rev_day_total:d rank_:i revenue:d"
_COLUMNS = R.group_columns(RAW_GROUPS)
_COUNT_SPEC = " ".join(f"{c}:i" for c in _COLUMNS.values())
_MEAN_SPEC = " ".join(f"{c}:r9" for c in _COLUMNS.values())
_SUM_SQL = ", ".join(f"sum(case when product_group = '{g}' then 1 else 0 end) as {c}" for g, c in _COLUMNS.items())
_AVG_SQL = ", ".join(f"avg({c}) as {c}" for c in _COLUMNS.values())
_SCALED_SQL = ", ".join(
    f"({c} - least({', '.join(_COLUMNS.values())})) / nullif(greatest({', '.join(_COLUMNS.values())}) - least({', '.join(_COLUMNS.values())}), 0) as {c}" for c in _COLUMNS.values()
)
_DOG_VISITS = f"select animal_id, rank_, {_SUM_SQL} from v_short where species = 'Canine (Dog)' and rank_ <= 5 group by 1, 2"
_CAT_VISITS = f"select animal_id, rank_, {_SUM_SQL} from v_short where species = 'Feline (Cat)' and rank_ <= 2 group by 1, 2"
_VISIT_PROFILE = f"select rank_ as number_of_visits, count(*) as n, {_AVG_SQL} from ({_DOG_VISITS}) group by 1"


def _hist_sql(source: str, value: str, bins: int) -> str:
    return f"""
select bin, lo + bin * (hi - lo) / {bins} as bin_start, count(*) as n
from (select *, least(floor((x - lo) * {bins} / (hi - lo)), {bins - 1}) as bin
  from (select cast({value} as double) as x, min(cast({value} as double)) over () as lo, max(cast({value} as double)) over () as hi from {source}))
group by 1, 2"""


def _flag(t: Inputs, **how):
    back = R.returners(t.transactions, t.products, t.animals, None if how else t.divisions, **how)
    return R.with_return_flag(t.animals.select(F.col("id").alias("animal_id")), back)


def _profile(t: Inputs, **how):
    return plan.profile(t, AS_OF, **how)


def _first_days(t: Inputs):
    first = R.animal_days(_profile(t)).where("rank_ = 1")
    return histogram(first.select(F.unix_date("day").alias("first_day")), "first_day", 50)


def _visit_sums(t: Inputs, species: str = "Canine (Dog)", up_to: int = 5):
    lines = R.shorten_names(_profile(t)).where((F.col("species") == species) & (F.col("rank_") <= up_to))
    return R.one_hot_sums(lines, ["animal_id", "rank_"], RAW_GROUPS)


def _visit_profile(t: Inputs, *of):
    return R.mean_profile(_visit_sums(t, *of).withColumnRenamed("rank_", "number_of_visits"), "number_of_visits", RAW_GROUPS)


def _breed_profile(t: Inputs):
    """Mean product counts at visits 1 to 3 of the most frequent breeds."""
    dogs = _profile(t, dogs_by_breed=True)
    common = R.top_values(dogs, "breed", 3).select("breed")
    lines = dogs.where("rank_ <= 3").join(common, "breed", "left_semi")
    sums = R.one_hot_sums(lines, ["animal_id", "breed", "rank_"], RAW_GROUPS)
    names = list(_COLUMNS.values())
    return sums.groupBy("breed", "rank_").agg(F.count("*").alias("n"), *[F.avg(c).alias(c) for c in names])


_FACET_PART = (
    "select '{0}' as facet, cast({0} as varchar) as facet_value, visit_more_than_once, count(*) as n from"
    " (select distinct animal_id, species, visit_more_than_once, {0} from v_profile where {0} is not null) group by 1, 2, 3"
)
_FACETS = " union all ".join(_FACET_PART.format(f) for f in ("species", "ani_age", "type", "product_group")).replace(
    "visit_more_than_once, species from", "visit_more_than_once from"
)

QUERIES: dict[str, Query] = {
    "return_flag": Query(
        _flag,
        "animal_id:i visit_more_than_once:i",
        "select id as animal_id, cast(id in (select animal_id from v_returners) as integer) as visit_more_than_once from fx_animals",
    ),
    "return_flag_lax": Query(
        lambda t: _flag(t, match_clinic=False, drop_excluded=False),
        "animal_id:i visit_more_than_once:i",
        "select id as animal_id, cast(id in (select animal_id from v_returners_lax) as integer) as visit_more_than_once from fx_animals",
    ),
    "return_flag_counts": Query(
        lambda t: R.value_counts(R.animal_days(_profile(t)).select("animal_id", "visit_more_than_once").distinct(), "visit_more_than_once"),
        "visit_more_than_once:i n:i",
        "select visit_more_than_once, count(*) as n from (select distinct animal_id, visit_more_than_once from v_profile) group by 1",
    ),
    "return_profile": Query(lambda t: _profile(t, cutoff=False), PROFILE.format("species"), "select * from v_profile_all"),
    "return_profile_dogs": Query(lambda t: _profile(t, cutoff=False, dogs_by_breed=True), PROFILE.format("breed"), "select * from v_profile_dogs"),
    "cutoff_semi": Query(_profile, PROFILE.format("species"), "select * from v_profile"),
    "first_visit_hist": Query(
        _first_days,
        "bin:i bin_start:r6 n:i",
        _hist_sql("(select distinct animal_id, day from v_profile where rank_ = 1)", "day - date '1970-01-01'", 50),
    ),
    "visit_gap_hist": Query(lambda t: R.visit_gap_histogram(_profile(t)), "bin:i bin_start:r6 n:i", _hist_sql("v_gaps", "gap_days", 50)),
    "visit_gap_counts": Query(
        lambda t: R.value_counts(R.visit_gaps(_profile(t)), "gap_days"), "gap_days:i n:i", "select gap_days, count(*) as n from v_gaps group by 1"
    ),
    "visit_max_dist": Query(
        lambda t: R.max_visit_distribution(_profile(t)),
        "max_rank:i n:i",
        "select max_rank, count(*) as n from (select animal_id, max(rank_) as max_rank from v_profile group by 1) group by 1",
    ),
    "short_name_rollup": Query(
        lambda t: R.shorten_names(_profile(t)),
        "animal_id:i species:s day:s name:s type:s tracking_level:s product_group:s visit_more_than_once:i rank_:i revenue:d",
        "select * from v_short",
    ),
    "value_counts": Query(lambda t: R.value_counts(_profile(t), "name"), "name:s n:i", "select name, count(*) as n from v_profile group by 1"),
    "facet_share": Query(
        lambda t: R.facet_shares(_profile(t)),
        "facet:s facet_value:s visit_more_than_once:i n:i share:r9",
        f"select *, n / sum(n) over (partition by facet, facet_value) as share from ({_FACETS})",
    ),
    "return_rate": Query(
        lambda t: R.return_rate(_profile(t)),
        "animals:i returned:i rate:r9",
        "select count(*) as animals, sum(visit_more_than_once) as returned, avg(visit_more_than_once) as rate from (select distinct animal_id, visit_more_than_once from v_profile)",
    ),
    "group_transition": Query(
        lambda t: R.group_transition(_profile(t)),
        "product_group:s visit_1:i visit_2:i",
        "select product_group, count(*) filter (where rank_ = 1) as visit_1, count(*) filter (where rank_ = 2) as visit_2 from v_profile where visit_more_than_once = 1 and rank_ in (1, 2) group by 1",
    ),
    "onehot_sums": Query(_visit_sums, f"animal_id:i rank_:i {_COUNT_SPEC}", _DOG_VISITS),
    "visit_profile": Query(_visit_profile, f"number_of_visits:i n:i {_MEAN_SPEC}", _VISIT_PROFILE),
    "visit_profile_cats": Query(
        lambda t: _visit_profile(t, "Feline (Cat)", 2), f"number_of_visits:i n:i {_MEAN_SPEC}", f"select rank_ as number_of_visits, count(*) as n, {_AVG_SQL} from ({_CAT_VISITS}) group by 1"
    ),
    "profile_minmax": Query(
        lambda t: R.scale_profile(_visit_profile(t), "number_of_visits", RAW_GROUPS),
        f"number_of_visits:i {_MEAN_SPEC}",
        f"select number_of_visits, {_SCALED_SQL} from ({_VISIT_PROFILE})",
    ),
    "top_breeds": Query(
        lambda t: R.top_values(_profile(t, dogs_by_breed=True), "breed", 20),
        "breed:s n:i",
        "select breed, count(*) as n from v_dogs group by 1 order by n desc, breed limit 20",
    ),
    "breed_profile": Query(
        _breed_profile,
        f"breed:s rank_:i n:i {_MEAN_SPEC}",
        f"""select breed, rank_, count(*) as n, {_AVG_SQL} from (select animal_id, breed, rank_, {_SUM_SQL} from v_dogs
          where rank_ <= 3 and breed in (select breed from v_dogs group by 1 order by count(*) desc, breed limit 3) group by 1, 2, 3) group by 1, 2""",
    ),
    "frequent_names": Query(
        lambda t: R.frequent_rows(_profile(t), "name", 75, "hot rod").select("animal_id", "day", "name", "rank_", "revenue"),
        "animal_id:i day:s name:s rank_:i revenue:d",
        "select animal_id, day, name, rank_, revenue from v_profile where name <> 'hot rod' qualify count(*) over (partition by name) > 75",
    ),
}
