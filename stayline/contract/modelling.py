"""Queries on labelled predictions, the run registry, and fitted models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from stayline import params as P
from stayline.contract.query import Query
from stayline.functions.keys import hash_bucket
from stayline.functions.numeric import as_flag
from stayline.operators import features, labels, lifecycle, metrics, models
from stayline.operators import returns as R
from stayline.operators.scoring import PROBS
from stayline.plans import returns as return_plan
from stayline.plans import scoring as score_plan
from stayline.plans import staffing as staff_plan
from stayline.plans import training
from stayline.session import cut_lineage, work_path
from stayline.sources import sinks
from stayline.sources.inputs import AS_OF, PROMO_PREFIX, RAW_GROUPS, SPECIES, Inputs

_BY_RUN = {"metrics": "fx_metrics", "latest_metrics": "fx_latest_metrics", "params": "fx_params", "tags": "fx_tags"}
_GONE = "(select experiment_id from fx_experiments where lifecycle_stage = 'deleted')"
_GONE_RUNS = f"(select run_uuid from fx_runs where experiment_id in {_GONE})"
_CASCADE = " union all ".join(
    [f"select '{name}' as table_name, count(*) as kept, sum(run_uuid) as key_sum from {view} where run_uuid not in {_GONE_RUNS}" for name, view in _BY_RUN.items()]
    + [
        f"select 'runs', count(*), sum(run_uuid) from fx_runs where experiment_id not in {_GONE}",
        f"select 'experiment_tags', count(*), sum(experiment_id) from fx_experiment_tags where experiment_id not in {_GONE}",
        "select 'experiments', count(*), sum(experiment_id) from fx_experiments where lifecycle_stage <> 'deleted'",
    ]
)

_CELLS = "select label, prediction, count(*) as n from fx_predictions group by 1, 2"


def _weighted_sql(suffix: str, cells: str, where: str = "true") -> str:
    return f"""
select unnest(['F1{suffix}', 'Recall{suffix}', 'Precision{suffix}']) as metric, unnest([f1, recall, precision]) as value from (
select sum(f1 * support) / sum(support) as f1, sum(recall * support) / sum(support) as recall, sum(precision * support) / sum(support) as precision
from (select *, case when precision + recall = 0 then 0 else 2 * precision * recall / (precision + recall) end as f1
  from (select c, support, case when predicted = 0 then 0 else tp / predicted end as precision, case when support = 0 then 0 else tp / support end as recall
    from (select c, coalesce((select sum(n) from ({cells}) x where x.label = k.c), 0)::double as support, coalesce((select sum(n) from ({cells}) x where x.prediction = k.c), 0)::double as predicted,
        coalesce((select sum(n) from ({cells}) x where x.label = k.c and x.prediction = k.c), 0)::double as tp
      from (select distinct label as c from ({cells}) union select distinct prediction from ({cells})) k where {where}))))"""


_BINARY = "select case when label > 0 then 1 else 0 end as label, case when prediction > 0 then 1 else 0 end as prediction, n from (" + _CELLS + ")"
_METRICS = " union all ".join([_weighted_sql("", _CELLS), _weighted_sql("_W/O_0", _CELLS, "c > 0"), _weighted_sql("_Binary", _BINARY)])
_ROC = """
select score as threshold, sum(pos) over w / sum(pos) over () as tpr, sum(neg) over w / sum(neg) over () as fpr
from (select score, cast(sum(target) as double) as pos, cast(sum(1 - target) as double) as neg from fx_predictions group by 1) window w as (order by score desc)"""
_CUTOFF = """
select threshold, tp / pt as tpr, fp / nt as fpr from (
  select score as threshold, sum(pos) over w as tp, sum(neg) over w as fp, sum(pos) over () as pt, sum(neg) over () as nt
  from (select score, sum(target) as pos, sum(1 - target) as neg from fx_predictions group by 1) window w as (order by score desc))
order by abs(tp * nt - (nt - fp) * pt), threshold desc limit 1"""


def _cascade(t: Inputs):
    kept = lifecycle.without_deleted(
        t.experiments, t.runs,
        {"metrics": t.metrics, "latest_metrics": t.latest_metrics, "params": t.run_params, "tags": t.run_tags},
        {"experiment_tags": t.experiment_tags},
    )
    parts = []
    for name, df in kept.items():
        key = "run_uuid" if "run_uuid" in df.columns else "experiment_id"
        parts.append(df.agg(F.lit(name).alias("table_name"), F.count("*").alias("kept"), F.sum(key).alias("key_sum")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _above_cutoff(t: Inputs):
    scored = t.predictions
    cut = metrics.apply_cutoff(scored, metrics.roc_cutoff(scored))
    return metrics.confusion(cut, "target", "prediction")


def _training_rows(t: Inputs):
    return cut_lineage(training.training_rows(t, AS_OF, up_to=1, promo_prefix=PROMO_PREFIX))


def _train_score(t: Inputs):
    """Holdout metrics of the visit-1 model."""
    return training.train(_training_rows(t), 1).metrics


def _importance(t: Inputs):
    rows = _training_rows(t)
    return models.importance_table(t.spark, models.fit_bands(rows.where("is_train")))


def _train_visits(t: Inputs):
    """The training job for visits 1 to 5: how many rows of each band it was measured on, by the models' own predictions."""
    out = None
    for n, trained in training.train_all(t, AS_OF, promo_prefix=PROMO_PREFIX, fit=models.fit_forest).items():
        seen = trained.holdout.where("prediction between 0 and 5").groupBy(F.col(labels.LABEL).alias("band")).agg(F.count("*").alias("measured"))
        part = seen.withColumn("visit_number", F.lit(n))
        out = part if out is None else out.unionByName(part)
    return out


def _visit_metrics(t: Inputs):
    """The nine metrics of each visit number's model."""
    out = None
    for n, trained in training.train_all(t, AS_OF, promo_prefix=PROMO_PREFIX, fit=models.fit_forest).items():
        part = trained.metrics.withColumn("visit_number", F.lit(n))
        out = part if out is None else out.unionByName(part)
    return out


def _score_visits(t: Inputs):
    """The scoring job for visits 1 to 5, on a table that holds what is scored, and once more: every unscored patient and
    visit is added once, with probabilities that add up to one within their rounding."""
    table = sinks.scores_table(t.spark, work_path(t.spark, "scored"))
    table.append(t.scored.select(*[F.col(c) if c in t.scored.columns else F.lit(None).alias(c) for c in table.schema]))
    fitted = {n: trained.model for n, trained in training.train_all(t, AS_OF, promo_prefix=PROMO_PREFIX, fit=models.fit_forest).items()}
    for _ in range(2):
        score_plan.score_and_append(t, fitted, AS_OF, table.path)
    total = sum(F.col(c) for c in PROBS)
    fine = (F.abs(total - 1) <= 0.003) & (F.col("final_category_prob") == F.greatest(*PROBS)) & F.col("final_category").between(0, 5)
    return table.read().withColumns({"added": F.col("date_of_upload").isNotNull().cast("int"), "fine": F.coalesce(fine, F.lit(False)).cast("int")})


def _split_counts(t: Inputs):
    """Splits by band and feature beside the gain, and how many inner nodes the band's trees have."""
    model = models.fit_bands(_training_rows(t).where("is_train"))
    gain = models.importance_table(t.spark, model)
    both = models.split_counts(t.spark, model).join(gain, ["band", "feature"])
    return both.join(models.inner_nodes(t.spark, model), "band")


def _split_checks(t: Inputs):
    """By band: splits less inner nodes, and what is missing to a gain of 1 in all."""
    sums = _split_counts(t).groupBy("band", "inner_nodes").agg(F.sum("splits").alias("splits"), F.sum("gain").alias("gain"))
    return sums.select("band", (F.col("splits") - F.col("inner_nodes")).alias("unaccounted"), F.when(F.col("inner_nodes") > 0, 1 - F.col("gain")).otherwise(F.col("gain")).alias("gain_gap"))


def _score_new(t: Inputs):
    """Visit-1 predictions of unscored patients by a model trained on the labelled ones."""
    trained = training.train(_training_rows(t), 1)
    rows = score_plan.scoring_rows(t, AS_OF, t.scored, up_to=1)
    return score_plan.score(rows, trained.model, 1, AS_OF)


def _forest(t: Inputs):
    rows = _training_rows(t)
    predicted = models.predict_bands(models.fit_forest(rows.where("is_train")), rows.where("not is_train"))
    return metrics.metric_table(predicted.select(F.col(labels.LABEL).alias("label"), "prediction"))


def _binary_train(t: Inputs):
    return training.train(_training_rows(t), 1, binary=True).metrics


_FIRST = tuple(R.group_columns(RAW_GROUPS).values())


#: Line counts by species stand beside those by product group; each line has one of either.
_SPECIES = R.group_columns(SPECIES)
_TERMS = (*_SPECIES.values(), *_FIRST)


def _first_visits(t: Inputs):
    """Line counts of each animal's first day by species and product group, with the return flag."""
    lines = R.shorten_names(return_plan.profile(t, AS_OF)).where("rank_ = 1")
    keys = ["animal_id", "visit_more_than_once", "rank_"]
    both = {**{n: ("species", g) for g, n in _SPECIES.items()}, **{n: ("product_group", g) for g, n in R.group_columns(RAW_GROUPS).items()}}
    sums = lines.groupBy(*keys).agg(*[F.sum(as_flag(F.col(c) == g)).alias(n) for n, (c, g) in both.items()])
    return cut_lineage(labels.with_split(sums, "animal_id"))


def _glm(t: Inputs):
    rows = _first_visits(t)
    model = models.fit_binomial(rows.where("is_train"), _TERMS, "visit_more_than_once")
    scored = models.predict_binomial(model, rows.where("not is_train"))
    return metrics.confusion(models.at_optimal_cutoff(scored, "visit_more_than_once"))


def _glm_summary(t: Inputs):
    rows = _first_visits(t)
    return models.binomial_summary(t.spark, models.fit_binomial(rows.where("is_train"), _TERMS, "visit_more_than_once"))


def _glm_score(t: Inputs):
    """The score equations of the fit: for every term, what the rows add up to and what the model expects."""
    train = _first_visits(t).where("is_train")
    return models.binomial_score(models.fit_binomial(train, _TERMS, "visit_more_than_once"), train, "visit_more_than_once")


def _network(t: Inputs):
    """The net on four fifths of the training rows, stopped by the others, and the three parts."""
    rows = _first_visits(t).withColumn("held", hash_bucket("animal_id", P.SPLIT_SEED + 1) < P.TRAIN_PERCENT)
    fit, stop, rest = rows.where("is_train and held"), rows.where("is_train and not held"), rows.where("not is_train")
    return models.fit_network(fit, stop, _TERMS, "visit_more_than_once"), fit, stop, rest


def _mlp(t: Inputs):
    net, _, _, rest = _network(t)
    return metrics.confusion(models.at_optimal_cutoff(models.predict_network(net.fitted, rest, _TERMS), "visit_more_than_once"))


def _mlp_rounds(t: Inputs):
    """Validation loss by round, and which counts."""
    net, _, stop, _ = _network(t)
    rows = [(i, loss, int(i == net.best_round)) for i, loss in enumerate(net.losses, 1)]
    return t.spark.createDataFrame(rows, "round int, loss double, best int")


def _mlp_checks(t: Inputs):
    """What holds for every such fit: rows used, the best round has the least loss, its network gives that loss again, and
    no further round than patience allows was run."""
    net, fit, stop, _ = _network(t)
    again = models.log_loss(models.predict_network(net.fitted, stop, _TERMS), "visit_more_than_once")
    best = net.best_round
    return t.spark.createDataFrame(
        [(fit.count(), stop.count(), int(net.losses[best - 1] == min(net.losses)), int(abs(again - min(net.losses)) < 1e-9), int(len(net.losses) in (best + 3, 25)))],
        "fit_rows long, stop_rows long, best_is_least int, best_weights_kept int, stopped_by_patience int",
    )


def _linreg(t: Inputs):
    rows = cut_lineage(staff_plan.study(t, "1996-01-01", "2000-12-31").select("block_minutes", "free_time", "rev_per_hour"))
    model = models.fit_linear(rows, ("block_minutes", "free_time"), "rev_per_hour")
    values = [("intercept", float(model.intercept)), *zip(("block_minutes", "free_time"), map(float, model.coefficients))]
    return t.spark.createDataFrame(values, "term string, estimate double")


def _linreg_divisions(t: Inputs):
    """Revenue per hour on minutes in office and free time, with a level for every division."""
    study = staff_plan.study(t, "1996-01-01", "2000-12-31")
    fitted = models.fit_within(study, ("minutes_in_office", "free_time"), "rev_per_hour", "division_name")
    levels = fitted.levels.select(F.col("division_name").alias("term"), F.col("level").alias("estimate"), "n")
    return levels.unionByName(t.spark.createDataFrame([(c, b, None) for c, b in fitted.slopes.items()], "term string, estimate double, n long"))


# Minutes in office never vary, so they are aliased; the other slope is that of the deviations from division means.
_LINREG_DIVISIONS = """
with d as (select *, free_time - avg(free_time) over w as dx, rev_per_hour - avg(rev_per_hour) over w as dy from v_study window w as (partition by division_name)),
b as (select sum(dx * dy) / sum(dx * dx) as slope from d)
select division_name as term, avg(rev_per_hour) - any_value(slope) * avg(free_time) as estimate, count(*) as n from v_study, b group by 1
union all select 'free_time', slope, null from b union all select 'minutes_in_office', null, null"""

_LINREG = """
select unnest(['intercept', 'block_minutes', 'free_time']) as term, unnest([my - b1 * m1 - b2 * m2, b1, b2]) as estimate
from (select *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) as b1, (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) as b2
  from (select avg(block_minutes) as m1, avg(free_time) as m2, avg(rev_per_hour) as my, covar_pop(block_minutes, block_minutes) as s11, covar_pop(free_time, free_time) as s22,
    covar_pop(block_minutes, free_time) as s12, covar_pop(block_minutes, rev_per_hour) as s1y, covar_pop(free_time, rev_per_hour) as s2y from v_study))"""

_FIRST_SQL = f"""
select *, cast('0x' || substr(md5(animal_id || '|42'), 1, 8) as bigint) % 100 < 80 as is_train from (
  select animal_id, visit_more_than_once, {", ".join(f"count(*) filter (where species = '{g}') as {c}" for g, c in _SPECIES.items())},
    {", ".join(f"count(*) filter (where product_group = '{g}') as {c}" for g, c in R.group_columns(RAW_GROUPS).items())}
  from v_short where rank_ = 1 group by 1, 2)"""
# Where the likelihood is largest, the model expects what was seen.
_GLM_SCORE = " union all ".join(
    f"select '{c}' as term, sum({c} * visit_more_than_once) as observed, sum({c} * visit_more_than_once) as expected from ({_FIRST_SQL}) where is_train" for c in _TERMS
)

_BAND_CASE = "case " + " ".join(f"when total_future_spend <= {edge} then {k}" for k, edge in enumerate(P.BAND_EDGES[1:])) + " end"
_IS_TRAIN = "cast('0x' || substr(md5(uid || '|42'), 1, 8) as bigint) % 100 < 80"

QUERIES: dict[str, Query] = {
    "confusion": Query(lambda t: metrics.confusion(t.predictions), "label:i prediction:i n:i share:r9", f"select *, n / sum(n) over () as share from ({_CELLS})"),
    "weighted_metrics": Query(lambda t: metrics.metric_table(t.predictions), "metric:s value:r9", _METRICS),
    "roc_points": Query(lambda t: metrics.roc_points(t.predictions), "threshold:d tpr:r9 fpr:r9", _ROC),
    "roc_cutoff": Query(lambda t: metrics.roc_cutoff(t.predictions), "threshold:d tpr:r9 fpr:r9", _CUTOFF),
    "cutoff_confusion": Query(
        _above_cutoff,
        "label:i prediction:i n:i share:r9",
        f"""select *, n / sum(n) over () as share from (select target as label, case when score > (select threshold from ({_CUTOFF})) then 1 else 0 end as prediction, count(*) as n
          from fx_predictions group by 1, 2)""",
    ),
    "best_run": Query(
        lambda t: lifecycle.best_run(t.runs),
        "experiment_id:i run_uuid:i Precision_Binary:d start_time:s",
        """select experiment_id, run_uuid, "Precision_Binary", strftime(start_time, '%Y-%m-%d %H:%M:%S') as start_time from fx_runs
          qualify row_number() over (partition by experiment_id order by "Precision_Binary" desc, start_time desc, run_uuid desc) = 1""",
    ),
    "runs_keep5": Query(
        lambda t: lifecycle.runs_to_keep(t.runs),
        "experiment_id:i run_uuid:i F1_Binary:d place:i",
        """select *, row_number() over (partition by experiment_id order by "F1_Binary" desc, start_time desc, run_uuid desc) as place from fx_runs qualify place <= 5""",
    ),
    "cascade_delete": Query(_cascade, "table_name:s kept:i key_sum:i", _CASCADE),
    "train_score": Query(_train_score, "metric:s value:d"),
    "train_binary": Query(_binary_train, "metric:s value:d"),
    "forest_score": Query(_forest, "metric:s value:d"),
    "importance": Query(_importance, "band:i feature:s gain:d"),
    "train_visits": Query(
        _train_visits,
        "visit_number:i band:i measured:i",
        f"select visit_number, {_BAND_CASE} as band, count(*) as measured from v_features where total_future_spend >= 0 and not ({_IS_TRAIN}) group by 1, 2",
    ),
    "visit_metrics": Query(_visit_metrics, "visit_number:i metric:s value:d"),
    "score_visits": Query(
        _score_visits,
        "uid:s predict_for_visit_number:i total_num_visit:i total_future_spend:d added:i fine:i",
        """select uid, predict_for_visit_number, total_num_visit, total_future_spend, 0 as added, 0 as fine from fx_scored
          union all select uid, visit_number, max_num_visit, cast(total_future_spend as decimal(6,0)), 1, 1 from v_score_features""",
    ),
    "split_counts": Query(_split_counts, "band:i feature:s splits:i gain:d inner_nodes:i"),
    "split_checks": Query(
        _split_checks,
        "band:i unaccounted:i gain_gap:r9",
        f"""select unnest(range(0, cast(max(total_future_spend_bin) + 1 as bigint))) as band, 0 as unaccounted, 0.0 as gain_gap
          from (select {_BAND_CASE} as total_future_spend_bin from v_features where visit_number = 1 and {_IS_TRAIN})""",
    ),
    "score_new": Query(_score_new, "uid:s final_category:i final_category_prob:d predict_for_visit_number:i total_num_visit:i total_future_spend:d date_of_upload:s"),
    "glm_fit": Query(_glm, "label:i prediction:i n:i share:d"),
    "glm_score": Query(_glm_score, "term:s observed:d expected:r4", _GLM_SCORE),
    "glm_summary": Query(_glm_summary, "term:s estimate:d std_error:d z:d p:d"),
    "mlp_fit": Query(_mlp, "label:i prediction:i n:i share:d"),
    "mlp_rounds": Query(_mlp_rounds, "round:i loss:d best:i"),
    "mlp_checks": Query(
        _mlp_checks,
        "fit_rows:i stop_rows:i best_is_least:i best_weights_kept:i stopped_by_patience:i",
        f"""select count(*) filter (where held) as fit_rows, count(*) filter (where not held) as stop_rows, 1 as best_is_least, 1 as best_weights_kept, 1 as stopped_by_patience
          from (select cast('0x' || substr(md5(animal_id || '|43'), 1, 8) as bigint) % 100 < 80 as held from ({_FIRST_SQL}) where is_train)""",
    ),
    "linreg_divisions": Query(_linreg_divisions, "term:s estimate:r6 n:i", _LINREG_DIVISIONS),
    "linreg_fit": Query(_linreg, "term:s estimate:r4", _LINREG),
}
