"""Queries on visits, facts, snapshots, features, scoring and refresh."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from stayline.contract.query import Query
from stayline.functions import dates as D
from stayline.functions.keys import composite_key, hash_bucket
from stayline.functions.numeric import times
from stayline.operators import breeds, facts, features, labels, scoring, spend
from stayline.operators import visits as V
from stayline.operators.promo import promo_listing
from stayline.plans import refresh, snapshots
from stayline.plans import scoring as score_plan
from stayline.session import cut_lineage, shuffled, work_path
from stayline.sources import sinks
from stayline.sources.inputs import AS_OF, PROMO_PREFIX, SIZE_RULES, Inputs
from stayline.sources.tables import SCORES_SCHEMA, to_target
from stayline.sources.versioned import KeyedTable

VISIT_SPEC = "uid:s day:s rank_group:s visit_number:i max_num_visit:i visit_more_than_once:i"
SPENDS = "most_recent_visit_spend:d total_future_spend:d total_past_spend:d"
LINE_SPEC = (
    "uid:s breed:s ani_age:i day:s weight:d is_medical:i product_group:s product_name:s product_count:i wellness_plan:i"
    f" visit_number:i visit_more_than_once:i max_num_visit:i {SPENDS}"
)
FEATURE_SPEC = (
    "visit_number:i uid:s ani_age:r8 weight:r8 max_num_visit:i is_medical_max:i is_medical_count:i wellness_plan_max:i wellness_plan_count:i"
    f" {SPENDS} cat:i large:i medium:i other_animal:i small:i tier_other:i tier_1:i tier_2:i tier_3:i tier_4:i"
)
FACT_SPEC = "uid:s breed:s day:s weight:d is_medical:i product_group:s product_name:s ani_age:i revenue:d"


def _snapshot(t: Inputs, training: bool = True, attributes: bool = False) -> snapshots.Snapshot:
    keep = features.ATTRIBUTES if attributes else ()
    return snapshots.build(t, AS_OF, training=training, promo_prefix=PROMO_PREFIX, keep=keep)


def _facts(t: Inputs, unknown: bool = False):
    lines = facts.line_facts(V.daily_lines(t.transactions), t.products, t.animals, AS_OF, unknown)
    return facts.with_contact_copies(lines, facts.contact_copies(t.animals, t.contacts), "revenue")


def _visits(t: Inputs, **how):
    return V.visits(t.transactions, t.animals, **how)


def _event_visits(t: Inputs):
    days = t.raw("events").select(F.col("user_id").cast("string").alias("uid"), F.to_date("ts").alias("day")).distinct()
    return V.number_visits(days)


def _snapshot_lines(t: Inputs, n: int):
    return snapshots.visit_lines(t, _snapshot(t), AS_OF, n)


def _snapshot_all(t: Inputs):
    return spend.snapshot_patients(spend.pick_visit(_snapshot(t).days, up_to=5))


def _first_future(t: Inputs):
    days = spend.first_and_future(_snapshot(t).days)
    return days.select("uid", "first_visit_spend", "total_future_spend", "visit_more_than_once").distinct()


def _candidates(t: Inputs, any_visit: bool = False):
    days = spend.pick_visit(_snapshot(t, training=False).days, up_to=None if any_visit else 5)
    if any_visit:
        days = spend.pick_visit(days, 1)
    return spend.snapshot_patients(scoring.not_yet_scored(days, t.scored, any_visit))


def _feature_rows(t: Inputs):
    days = spend.pick_visit(_snapshot(t, attributes=True).days, up_to=5)
    return features.feature_frame(features.patient_rows(days, t.breeds))


def _bands(t: Inputs, binary: bool):
    labelled = labels.with_label(_feature_rows(t), binary)
    return labelled.groupBy("visit_number", labels.LABEL).agg(F.count("*").alias("patients"))


def _sanity(t: Inputs):
    days = spend.pick_visit(_snapshot(t, attributes=True).days, up_to=5)
    return features.sanity_counters(features.patient_rows(days, t.breeds))


def _fill(t: Inputs, literal: bool):
    days = score_plan.candidate_days(_snapshot(t, training=False, attributes=True), t.scored)
    rows = days.select("uid", "visit_number", "breed", "ani_age", "weight").distinct()
    return features.fill_weight(rows, features.breed_weight_avg(t.animals, t.transactions, AS_OF), literal)


def _names(t: Inputs):
    return t.raw("part").select(F.col("p_name").alias("breed"))


def _substrings(t: Inputs):
    """Keywords of many lengths: pieces of part names, cut at a place and to a length that the part's key says."""
    start, length = F.col("p_partkey") % 5 + 1, F.col("p_partkey") % 7
    piece = F.substring(F.col("p_name"), start.cast("int"), length.cast("int"))
    return t.raw("part").groupBy(piece.alias("keyword")).agg(F.count("*").alias("n_parts"))


def _words(column: str, step: str, n: str):
    """Names of many tokens: words that a key steps through, so that they share rare and common ones."""
    word = lambda i: F.concat(F.lit("w"), ((F.col(column) * F.expr(step) + i * i) % (F.lit(4) + i * 3)).cast("string"))
    return F.array_join(F.transform(F.sequence(F.lit(1), F.expr(n).cast("int")), word), " ")


def _long_names(t: Inputs):
    return t.raw("supplier").select(_words("s_suppkey", "7", "3 + s_suppkey % 28").alias("breed"))


def _long_labels(t: Inputs):
    """A label of 9 to 30 words for each customer."""
    key = F.col("c_custkey")
    return t.raw("customer").select(_words("c_custkey", "5", "9 + c_custkey % 22").alias("unique_breed"), F.concat(F.lit("tier_"), (key % 4 + 1).cast("string")).alias("matching_breed"))


def _known(t: Inputs):
    return t.labelled_names.select(F.col("unique_breed").alias("breed"))


def _promo(t: Inputs, more_than: int | None = None):
    wellness = facts.wellness_memberships(t.wellness_membership, t.wellness_plans, AS_OF)
    return promo_listing(
        t.transactions, t.products, t.animals, t.contacts, t.appointments, _visits(t, rule="line", numbering="rank"), wellness,
        PROMO_PREFIX, more_than,
    )


def _dates(t: Inputs):
    orders = t.raw("orders").select("o_orderkey", "o_orderdate")
    born = (F.col("o_orderkey") * 86399 - 200000000).cast("long")
    ts = D.epoch_to_timestamp(born)
    return orders.select(
        "o_orderkey",
        D.years_crossed(ts, D.as_date(AS_OF)).alias("years"),
        D.months_crossed(F.col("o_orderdate"), D.as_date(AS_OF)).alias("months"),
        D.days_between(F.to_date("o_orderdate"), D.as_date(AS_OF)).alias("days"),
        D.local_day(born, "America/Chicago").alias("local_day"),
        D.dow_sunday0(F.col("o_orderdate")).alias("dow_sun"),
        D.dow_monday0(F.col("o_orderdate")).alias("dow_mon"),
        D.months_before(F.to_date("o_orderdate"), 6).alias("half_year_before"),
    )


def _proba(t: Inputs):
    return scoring.pack_probabilities(_proba_frame(t))


def _target_rows(t: Inputs):
    """Packed predictions with visit totals, cast to the scores table."""
    totals = spend.pick_visit(_snapshot(t, training=False).days, 1)
    rows = spend.snapshot_patients(totals).join(_proba_frame(t), "uid")
    return to_target(scoring.score_rows(rows, AS_OF), SCORES_SCHEMA)


def _proba_frame(t: Inputs):
    key = F.col("c_custkey")
    probs = F.array(*[(((key * (7 + 2 * k) + 131 * k) % 997) / 997.0).cast("double") for k in range(6)])
    return shuffled(t.raw("customer")).select(composite_key("c_nationkey", "c_custkey").alias("uid"), probs.alias("probability"))


def _split(t: Inputs):
    rows = t.raw("customer").select(composite_key("c_nationkey", "c_custkey").alias("uid"))
    return labels.with_split(rows).withColumn("bucket", hash_bucket("uid", 42)).withColumn("is_train", F.col("is_train").cast("int"))


def _append_scores(t: Inputs):
    """An append that stops before its log entry, its repetition, one more repetition of the same batch, and a run that looks
    for what is still unscored: each patient and visit is there once."""
    path = work_path(t.spark, "scores")
    table = sinks.scores_table(t.spark, path)
    rows = cut_lineage(_target_rows(t))  # four writers read them
    table.stage(to_target(rows, SCORES_SCHEMA, key=sinks.SCORE_KEY))
    sinks.append_scores(rows, path)
    sinks.append_scores(rows, path)
    fresh = rows.withColumn("visit_number", F.col("predict_for_visit_number").cast("int"))
    sinks.append_scores(scoring.not_yet_scored(fresh, table.read()), path)
    return table.read()


#: Day of the first of two refreshes; by then few patients have come back.
EARLY = dt.date(1995, 3, 1)
_STORED = {"id": "bigint", "uid": "string", "predict_for_visit_number": "smallint", "total_num_visit": "smallint", "total_future_spend": "decimal(6,0)"}


def _stored(t: Inputs) -> KeyedTable:
    table = KeyedTable(t.spark, work_path(t.spark, "stored"), _STORED, sinks.SCORE_KEY)
    table.append(t.scored)
    return table


def _keyed_update(t: Inputs):
    table = _stored(t)
    refresh.refresh_table(t, AS_OF, table)
    return table.read()


def _refresh_twice(t: Inputs) -> KeyedTable:
    """Two refreshes in a row, the first as of an early day."""
    table = _stored(t)
    refresh.refresh_table(t.until(EARLY), AS_OF, table)
    refresh.refresh_table(t, AS_OF, table)
    return table


def _refresh_first(t: Inputs):
    """What a reader saw between the two: the first refresh's update of the stored table."""
    table = _stored(t)
    refresh.refresh_table(t.until(EARLY), AS_OF, table)
    return table.read()


def _append_breeds(t: Inputs):
    path = work_path(t.spark, "breeds")
    sinks.append_breeds(breeds.enrich_new(_names(t), _known(t), t.labelled_names, SIZE_RULES), path)
    stored = sinks.read_back(t.spark, path)
    again = breeds.enrich_new(_names(t), _known(t).unionByName(stored.select("breed")), t.labelled_names, SIZE_RULES)
    sinks.append_breeds(again, path)
    return sinks.read_back(t.spark, path)


def _overwrite(t: Inputs):
    path = work_path(t.spark, "target")
    first = refresh.refreshed(t, AS_OF).select(*_STORED)
    sinks.recreate(t.scored, path)
    sinks.recreate(first, path)
    return sinks.read_back(t.spark, path)


_PROBS = " ".join(f"predicted_val_prob_{k}:d" for k in range(6))
_PROB_SQL = ", ".join(f"round_even(((c_custkey * {7 + 2 * k} + {131 * k}) % 997) / 997.0::double, 3) as predicted_val_prob_{k}" for k in range(6))
_PACKED_SQL = f"""
select uid, list_position(p, list_max(p)) - 1 as final_category, list_max(p) as final_category_prob, {", ".join(f"p[{k + 1}] as predicted_val_prob_{k}" for k in range(6))}
from (select uid, [{", ".join(f"predicted_val_prob_{k}" for k in range(6))}] as p
  from (select cast(c_nationkey as varchar) || '_' || cast(c_custkey as varchar) as uid, {_PROB_SQL} from customer))"""
_TARGET_SQL = f"""
select k.*, 1 as predict_for_visit_number, s.max_num_visit as total_num_visit, cast(s.total_future_spend as decimal(6,0)) as total_future_spend,
  cast(s.most_recent_visit_spend as decimal(6,0)) as most_recent_visit_spend, cast(s.total_past_spend as decimal(6,0)) as total_past_spend, date '2001-08-02' as date_of_upload
from ({_PACKED_SQL}) k join (select distinct uid, max_num_visit, total_future_spend, most_recent_visit_spend, total_past_spend from v_snapshot_score where n = 1) s using (uid)"""
_TARGET_SPEC = f"uid:s final_category:i final_category_prob:d {_PROBS} predict_for_visit_number:i total_num_visit:i {SPENDS} date_of_upload:s"

_BAND_SQL = """
select visit_number, case when total_future_spend < 0 then null when total_future_spend <= 1 then 0 when total_future_spend <= 200 then 1
  when total_future_spend <= 350 then 2 when total_future_spend <= 500 then 3 when total_future_spend <= 1000 then 4 when total_future_spend <= 99999 then 5 end as total_future_spend_bin,
  count(*) as patients from v_features group by 1, 2"""
_BINARY_SQL = """
select visit_number, case when total_future_spend < 0 then null when total_future_spend <= 1 then 0 when total_future_spend <= 99999 then 1 end as total_future_spend_bin,
  count(*) as patients from v_features group by 1, 2"""

_SIZE_CASE = " ".join(
    "when " + " or ".join(f"lower(breed) like '%{w}%'" for w in SIZE_RULES[c]) + f" then '{c}'"
    for c in ("other_animal", "cat", "large", "medium", "small")
)
_SIZE_SQL = f"case {_SIZE_CASE} else 'medium' end"
_TIER_SQL = """
with n as (select distinct p_name as breed from part where p_name is not null),
nt as (select distinct breed, unnest(string_split(lower(breed), ' ')) as token from n),
lt as (select distinct unique_breed, matching_breed, unnest(string_split(lower(unique_breed), ' ')) as token from fx_labelled),
ns as (select breed, count(*) as k from nt group by 1), ls as (select unique_breed, count(*) as k from lt group by 1),
near as (select breed, matching_breed, shared / cast(ns.k + ls.k - shared as double) as score,
    row_number() over (partition by breed order by shared / cast(ns.k + ls.k - shared as double) desc, lower(unique_breed)) as place
  from (select nt.breed, lt.unique_breed, lt.matching_breed, count(*) as shared from nt join lt using (token) group by 1, 2, 3) s join ns using (breed) join ls using (unique_breed))
select n.breed, coalesce(e.matching_breed, near.matching_breed, 'oth') as tier, case when e.matching_breed is not null then 1.0 else coalesce(near.score, 0) end as tier_score
from n left join fx_labelled e on lower(e.unique_breed) = lower(n.breed) left join near on near.breed = n.breed and near.place = 1"""
_SUBSTRING_SQL = "select substr(p_name, p_partkey % 5 + 1, p_partkey % 7) as keyword, count(*) as n_parts from part where p_name is not null group by 1"


def _words_sql(key: str, step: int, n: str) -> str:
    return f"array_to_string([('w' || (({key} * {step} + i * i) % (4 + i * 3))) for i in range(1, {n} + 1)], ' ')"


_LONG_TIER_SQL = f"""
with l as (select unique_breed, min(matching_breed) as tier, list_distinct(string_split(unique_breed, ' ')) as lt
  from (select {_words_sql('c_custkey', 5, '9 + c_custkey % 22')} as unique_breed, 'tier_' || (c_custkey % 4 + 1) as matching_breed from customer) group by 1),
n as (select breed, list_distinct(string_split(breed, ' ')) as nt from (select distinct {_words_sql('s_suppkey', 7, '3 + s_suppkey % 28')} as breed from supplier)),
scored as (select breed, unique_breed, tier, len(list_intersect(nt, lt)) as shared, len(nt) + len(lt) - len(list_intersect(nt, lt)) as every from n, l),
near as (select * from scored where shared > 0 qualify row_number() over (partition by breed order by shared / cast(every as double) desc, unique_breed) = 1)
select n.breed, coalesce(e.tier, near.tier, 'oth') as tier, case when e.tier is not null then 1.0 else coalesce(near.shared / cast(near.every as double), 0) end as tier_score
from n left join l e on e.unique_breed = n.breed left join near on near.breed = n.breed"""
_ENRICH_SQL = f"select breed, tier, tier_score, {_SIZE_SQL} as breed_size from ({_TIER_SQL}) where breed not in (select unique_breed from fx_labelled)"

_REFRESH_SQL = """
select distinct f.id, r.total_num_visit, r.total_future_spend from fx_scored f join (
  select f.uid, cd.max_num_visit as total_num_visit, sum(f.revenue) as total_future_spend
  from v_facts f join v_visits cd on f.uid = cd.uid and f.day = cd.day
  where cd.visit_number > 1 and f.uid in (select uid from fx_scored) group by 1, 2) r using (uid)"""
_UPDATED_SQL = f"""
select s.id, s.uid, s.predict_for_visit_number, coalesce(u.total_num_visit, s.total_num_visit) as total_num_visit,
  coalesce(cast(u.total_future_spend as decimal(6,0)), s.total_future_spend) as total_future_spend
from fx_scored s left join ({_REFRESH_SQL}) u on s.id = u.id"""
_EARLY_SQL = f"""
select distinct f.id, f.uid, f.predict_for_visit_number, r.total_num_visit, r.total_future_spend from fx_scored f join (
  select a.uid, max(v.visit_number) as total_num_visit, sum(a.revenue) as total_future_spend
  from v_facts a join v_visits v on a.uid = v.uid and a.day = v.day where v.visit_number > 1 and a.day < date '{EARLY}' group by 1) r using (uid)"""
_AFTER_EARLY_SQL = f"""
select s.id, s.uid, s.predict_for_visit_number, coalesce(u.total_num_visit, s.total_num_visit) as total_num_visit,
  coalesce(cast(u.total_future_spend as decimal(6,0)), s.total_future_spend) as total_future_spend
from fx_scored s left join ({_EARLY_SQL}) u on s.id = u.id"""
_IN_BUCKET = "cast('0x' || substr(md5(uid || '|' || predict_for_visit_number || '|7'), 1, 8) as bigint) % 64"
_LOG_SQL = f"""
with stored as (select *, {_IN_BUCKET} as bucket from fx_scored), sizes as (select bucket, count(*) as n_rows from stored group by 1)
select 1 as version, bucket, false as replaces, n_rows from sizes
union all select 2, bucket, true, n_rows from sizes where bucket in (select {_IN_BUCKET} from ({_EARLY_SQL}))
union all select 3, bucket, true, n_rows from sizes where bucket in (select bucket from stored where id in (select id from ({_REFRESH_SQL})))"""
_UPDATED_SPEC = "id:i uid:s predict_for_visit_number:i total_num_visit:i total_future_spend:d"

# Each line counts once for every contact and booking of its animal's owner, or once if there are none.
_PROMO_SQL = """
select * from (
with lines as (
  select cast(location_id as varchar) || '_' || cast(animal_id as varchar) as uid, cast(datetime_date as date) as date, location_id, animal_id, product_id,
    product_name, revenue, count(*) as n
  from fx_transactions group by all),
contacts as (select ezyvet_id as contact_id, location_id, count(*) as n from fx_contacts group by all),
bookings as (select ezyvet_id as contact_id, location_id, count(*) as n from fx_appointments group by all),
listed as (
  select l.uid, l.date, p.is_medical, w.wellness_plan, l.product_name, l.revenue, sum(l.n * coalesce(c.n, 1) * coalesce(b.n, 1)) as repeats
  from (select * from lines where (uid, date) in (select (uid, day) from v_visits_rows)) l
  join fx_products p on p.ezyvet_id = l.product_id and p.location_id = l.location_id
  join fx_animals a on a.id = l.animal_id
  left join contacts c on c.contact_id = a.contact_id and c.location_id = l.location_id
  left join bookings b on b.contact_id = a.contact_id and b.location_id = l.location_id
  left join v_wellness w on w.uid = l.uid and w.day = l.date
  group by all),
totals as (
  select uid, coalesce(sum(repeats) filter (where wellness_plan is not null), 0) as wellness_plan_count,
    coalesce(sum(repeats) filter (where starts_with(product_name, 'hot gi')), 0) as free_count
  from listed group by uid),
places as (select uid, date, row_number() over (partition by uid order by date) as rank_ from (select distinct uid, date from listed))
select uid, date, is_medical, wellness_plan, wellness_plan_count, product_name, free_count, revenue, rank_, repeats
from listed join totals using (uid) join places using (uid, date))"""
_PROMO_SPEC = "uid:s date:s is_medical:i wellness_plan:s wellness_plan_count:i product_name:s free_count:i revenue:d rank_:i repeats:i"

_SNAP_COLS = "uid, visit_number, max_num_visit, visit_more_than_once, wellness_plan, product_count, most_recent_visit_spend, total_future_spend, total_past_spend"
_SNAP_SPEC = f"uid:s visit_number:i max_num_visit:i visit_more_than_once:i wellness_plan:i product_count:i {SPENDS}"

_FILLED_ROWS = """
select distinct visit_number, uid, breed, ani_age, weight from v_filled"""
_FILLED_LITERAL = """
select distinct s.visit_number, s.uid, s.breed, s.age as ani_age, case when s.weight <= 0 then w.weight_avg else cast(s.weight as double) end as weight
from (select *, case when weight <= 0 then coalesce(ani_age, 10) else ani_age end as age from v_new where weight is not null) s
left join v_breed_weight w on w.breed = s.breed and w.baby = case when s.age < 1 then 'baby' else 'adult' end
where s.weight > 0 or w.weight_avg is not null"""

QUERIES: dict[str, Query] = {
    "visit_islands": Query(_visits, VISIT_SPEC, "select * from v_visits"),
    "visit_islands_rank": Query(lambda t: _visits(t, numbering="rank"), VISIT_SPEC, "select * from v_visits_rank"),
    "visit_islands_rowpos": Query(lambda t: _visits(t, rule="line", numbering="rank"), VISIT_SPEC, "select * from v_visits_rows"),
    "visit_islands_events": Query(_event_visits, VISIT_SPEC, "select * from v_visits_events"),
    "line_facts": Query(
        lambda t: facts.facts_with_flags(_facts(t), facts.active_days(t.transactions, t.animals), AS_OF),
        FACT_SPEC + " first_day:s day_rank:i within_horizon:i mature_patient:i",
        "select * from v_flagged",
    ),
    "line_facts_left": Query(lambda t: _facts(t, unknown=True), FACT_SPEC, "select * from v_facts_left"),
    "wellness_memberships": Query(
        lambda t: facts.wellness_memberships(t.wellness_membership, t.wellness_plans, AS_OF, t.animals),
        "uid:s day:s wellness_plan_num:i months_a_member:i wellness_plan:s",
        "select * from v_wellness",
    ),
    "snapshot_train_n": Query(lambda t: _snapshot_lines(t, 2), LINE_SPEC, "select * from v_snapshot where n = 2"),
    "snapshot_all_n": Query(_snapshot_all, _SNAP_SPEC, f"select distinct {_SNAP_COLS} from v_snapshot"),
    "snapshot_first_future": Query(
        _first_future,
        "uid:s first_visit_spend:d total_future_spend:d visit_more_than_once:i",
        """select distinct uid, sum(case when visit_number = 1 then revenue else 0 end) over (partition by uid) as first_visit_spend,
          sum(case when visit_number <> 1 then revenue else 0 end) over (partition by uid) as total_future_spend, visit_more_than_once
        from v_joined_train qualify bool_or(visit_number = 1) over (partition by uid)""",
    ),
    "score_candidates": Query(_candidates, _SNAP_SPEC, f"select distinct {_SNAP_COLS} from v_new"),
    "score_candidates_any": Query(
        lambda t: _candidates(t, any_visit=True), _SNAP_SPEC, f"select distinct {_SNAP_COLS} from v_snapshot_score where n = 1 and uid not in (select uid from fx_scored)"
    ),
    "feature_frame": Query(_feature_rows, FEATURE_SPEC, "select * from v_features"),
    "scoring_features": Query(lambda t: score_plan.scoring_rows(t, AS_OF, t.scored), FEATURE_SPEC, "select * from v_score_features"),
    "scoring_features_levels": Query(
        lambda t: score_plan.scoring_rows(t, AS_OF, t.scored, breed_averages=False), FEATURE_SPEC, "select * from v_score_features_plain"
    ),
    "label_bands": Query(lambda t: _bands(t, False), "visit_number:i total_future_spend_bin:i patients:i", _BAND_SQL),
    "label_binary": Query(lambda t: _bands(t, True), "visit_number:i total_future_spend_bin:i patients:i", _BINARY_SQL),
    "train_split": Query(
        _split,
        "uid:s bucket:i is_train:i",
        """select uid, bucket, case when bucket < 80 then 1 else 0 end as is_train from (select uid, cast('0x' || substr(md5(uid || '|42'), 1, 8) as bigint) % 100 as bucket
          from (select cast(c_nationkey as varchar) || '_' || cast(c_custkey as varchar) as uid from customer))""",
    ),
    "sanity_counters": Query(
        _sanity,
        "visit_number:i uids:i missing_weight:i missing_age:i over_cap:i below_zero:i",
        """select visit_number, count(distinct uid) as uids, count(distinct case when weight is null or weight = 0 then uid end) as missing_weight,
          count(distinct case when ani_age is null then uid end) as missing_age, count(distinct case when total_future_spend > 5000 then uid end) as over_cap,
          count(distinct case when total_future_spend < 0 then uid end) as below_zero from v_rows group by visit_number""",
    ),
    "breed_weight_avg": Query(
        lambda t: features.breed_weight_avg(t.animals, t.transactions, AS_OF), "breed:s baby:s avg_weight:r8", "select breed, baby, weight_avg as avg_weight from v_breed_weight"
    ),
    "weight_fill": Query(lambda t: _fill(t, False), "visit_number:i uid:s breed:s ani_age:i weight:r8", _FILLED_ROWS),
    "weight_fill_literal": Query(lambda t: _fill(t, True), "visit_number:i uid:s breed:s ani_age:i weight:r8", _FILLED_LITERAL),
    "keyword_size": Query(
        lambda t: breeds.with_size(t.raw("part").select("p_partkey", F.col("p_name").alias("breed")), t.size_keywords),
        "p_partkey:i breed:s breed_size:s",
        f"select p_partkey, p_name as breed, {_SIZE_SQL} as breed_size from (select *, p_name as breed from part)",
    ),
    "keyword_hits": Query(
        lambda t: breeds.keyword_hits(t.raw("part").select(F.col("p_name").alias("name")), _substrings(t)),
        "name:s keyword:s n_parts:i",
        f"""select name, keyword, n_parts from (select distinct p_name as name from part where p_name is not null)
          join ({_SUBSTRING_SQL}) on contains(name, keyword)""",
    ),
    "tier_lookup_long": Query(lambda t: breeds.tier_lookup(_long_names(t), _long_labels(t)), "breed:s tier:s tier_score:r6", _LONG_TIER_SQL),
    "new_categories": Query(
        lambda t: breeds.new_categories(_names(t), _known(t)), "breed:s", "select distinct p_name as breed from part where p_name not in (select unique_breed from fx_labelled)"
    ),
    "tier_lookup": Query(lambda t: breeds.tier_lookup(_names(t), t.labelled_names), "breed:s tier:s tier_score:r6", _TIER_SQL),
    "enrich_breeds": Query(
        lambda t: breeds.enrich_new(_names(t), _known(t), t.labelled_names, SIZE_RULES), "breed:s tier:s tier_score:r6 breed_size:s", _ENRICH_SQL
    ),
    "returning_refresh": Query(lambda t: refresh.update_rows(t, AS_OF), "id:i total_num_visit:i total_future_spend:d", _REFRESH_SQL),
    "keyed_update": Query(_keyed_update, _UPDATED_SPEC, _UPDATED_SQL),
    "refresh_first": Query(_refresh_first, _UPDATED_SPEC, _AFTER_EARLY_SQL),
    "refresh_twice": Query(lambda t: _refresh_twice(t).read(), _UPDATED_SPEC, _UPDATED_SQL),
    "refresh_log": Query(lambda t: _refresh_twice(t).log(), "version:i bucket:i replaces:i n_rows:i", _LOG_SQL),
    "global_rank": Query(
        lambda t: V.global_visit_rank(_visits(t)),
        "uid:s day:s visit_number:i global_rank:i",
        "select uid, day, visit_number, dense_rank() over (order by visit_number) as global_rank from v_visits",
    ),
    "global_sum": Query(
        lambda t: spend.pick_visit(_snapshot(t).days, 1).agg(F.sum(times(F.col("total_future_spend"), F.col("n_rows") * F.col("repeats"))).alias("total")),
        "total:d",
        "select sum(total_future_spend) as total from v_snapshot where n = 1",
    ),
    "promo_listing": Query(_promo, _PROMO_SPEC, _PROMO_SQL),
    "promo_suspects": Query(lambda t: _promo(t, more_than=5), _PROMO_SPEC, _PROMO_SQL + " where free_count > 5"),
    "dirty_rows": Query(
        lambda t: features.drop_dirty(t.animals, "BUILDING"),
        "id:i breed:s weight:d",
        "select id, breed, weight from fx_animals where weight is distinct from 0 or breed is distinct from 'BUILDING'",
    ),
    "date_scalars": Query(
        _dates,
        "o_orderkey:i years:i months:i days:i local_day:s dow_sun:i dow_mon:i half_year_before:s",
        """select o_orderkey, 2001 - year(make_timestamp((o_orderkey * 86399 - 200000000) * 1000000)) as years,
          date_diff('month', o_orderdate, timestamp '2001-08-02') as months, date_diff('day', cast(o_orderdate as date), date '2001-08-02') as days,
          cast(timezone('America/Chicago', to_timestamp(o_orderkey * 86399 - 200000000)) as date) as local_day,
          dayofweek(o_orderdate) as dow_sun, isodow(o_orderdate) - 1 as dow_mon, cast(cast(o_orderdate as date) - interval 6 month as date) as half_year_before from orders""",
    ),
    "proba_pack": Query(_proba, f"uid:s final_category:i final_category_prob:d {_PROBS}", _PACKED_SQL),
    "scores_target": Query(_target_rows, _TARGET_SPEC, _TARGET_SQL),
    "append_scores": Query(_append_scores, _TARGET_SPEC, _TARGET_SQL),
    "append_breeds": Query(_append_breeds, "breed:s tier:s tier_score:r4 breed_size:s", _ENRICH_SQL),
    "overwrite_target": Query(_overwrite, _UPDATED_SPEC, _UPDATED_SQL),
}
