"""One named query per operator, each over whole tables of a folder of Parquet files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.functions.scores import rounded
from tidewatch.functions.text import parse_metric_line, parse_run_name
from tidewatch.operators import distributions, drift, forecast, history, holidays, loads, panel, rollup, running, scoring, selection, timeline
from tidewatch.plans.monitor import (
    MonitorConfig,
    batched_panel,
    marked_windows,
    model_run,
    monitor,
)
from tidewatch.schema import RUN_KEY, SCORES, SERIES
from tidewatch.session import STATE_STORE, shared_dir
from tidewatch.sources import run_tree
from tidewatch.sources.tables import (
    name_series,
    read_batch,
    read_table,
    sales_from_lineitem,
    stage,
    write_panel,
    write_runs,
)
from tidewatch.streaming import arrivals, drift_state, events, sessions, sinks

Query = Callable[[SparkSession, str], DataFrame]

#: The first day of batch 1 in all queries: no scan has to look for it, and late or older rows renumber nothing.
ORIGIN = "1995-01-01"
DEFAULT = MonitorConfig(origin=ORIGIN)
WEEKS = MonitorConfig(origin=ORIGIN, batch_days=7)
TIGHT = MonitorConfig(origin=ORIGIN, drift=drift.DriftRule(threshold=1.0), execution=2)


def sales(spark: SparkSession, sf: str) -> DataFrame:
    return sales_from_lineitem(read_table(spark, sf, "lineitem"))


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return name_series(panel.daily_panel(sales(spark, sf)))


def batched(spark: SparkSession, sf: str, config: MonitorConfig = DEFAULT) -> DataFrame:
    return batched_panel(sales(spark, sf), config)


def runs(spark: SparkSession, sf: str, config: MonitorConfig = DEFAULT) -> DataFrame:
    return model_run(batched(spark, sf, config), config)


def chain(spark: SparkSession, sf: str, n: int) -> DataFrame:
    """Model records of one of two chains of the job.

    The first has execution number 1; the second is a rerun with a tighter drift rule, logged an hour later.
    """
    if n == 1:
        return runs(spark, sf, MonitorConfig(origin=ORIGIN, execution=1))
    rerun = runs(spark, sf, TIGHT)
    return rerun.withColumn("logged_at", F.col("logged_at") + F.expr("interval 1 hour"))


def chains(spark: SparkSession, sf: str) -> DataFrame:
    return chain(spark, sf, 1).unionByName(chain(spark, sf, 2))


def stored_chains(spark: SparkSession, sf: str) -> DataFrame:
    """The records of both chains, written once: for queries that read them more than once."""
    return stage(chains(spark, sf), "records")


def chain_rollups(records: DataFrame) -> DataFrame:
    """One roll-up per batch and chain, from stored records."""
    both = [rollup.batch_rollup(records.filter(F.col("execution_number") == n)) for n in (1, 2)]
    return both[0].unionByName(both[1])


def tidy(df: DataFrame) -> DataFrame:
    """Doubles rounded and times without a zone, for comparison with another engine."""

    def report(name: str, kind: str) -> Column:
        if kind == "double":
            return rounded(F.col(name)).alias(name)
        if kind == "timestamp":
            return F.col(name).cast("timestamp_ntz").alias(name)
        return F.col(name)

    return df.select(*[report(n, k) for n, k in df.dtypes])


# --- sources -------------------------------------------------------------------------------------


def metric_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Events written as metric lines and parsed again."""
    table = read_table(spark, sf, "events")
    stamp = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    line = F.concat_ws(" ", stamp, F.col("value").cast("string"), F.lit("0"))
    return table.select("event_id", parse_metric_line(line).alias("p")).select(
        "event_id", "p.ts", "p.value", "p.step"
    )


def run_names(spark: SparkSession, sf: str) -> DataFrame:
    """Names of the models and roll-ups of every batch, taken apart."""
    keys = batched(spark, sf).select(*RUN_KEY).distinct()
    series = F.concat(F.lit("Model_"), F.col("product_id"), F.lit("_"), F.col("store_id"))
    number = F.concat(F.lit("_#"), F.col("batch_number"))
    names = keys.select(
        F.explode(
            F.array(
                series,
                F.concat(series, number),
                F.concat(F.lit("Global_Metrics"), number),
                F.concat(F.lit("Unknown"), number),
            )
        ).alias("name")
    ).distinct()
    return names.select("name", parse_run_name(F.col("name")).alias("p")).select(
        "name", "p.kind", "p.product_id", "p.store_id", F.coalesce("p.n", F.lit(0)).alias("n")
    )


def long_records(spark: SparkSession, sf: str) -> DataFrame:
    models = stored_chains(spark, sf)
    rollups = chain_rollups(models)
    return run_tree.model_long(models).unionByName(run_tree.global_long(rollups))


def run_files(spark: SparkSession, sf: str) -> DataFrame:
    """Events as files of a run tree, every third one outside of it; paths taken apart, texts kept."""
    table = read_table(spark, sf, "events")
    folder = F.element_at(F.array(*[F.lit(k) for k in ("tags", "metrics", "params")]), (F.col("event_id") % 3 + 1).cast("int"))
    path = F.concat(F.lit("file:/runs/0/"), F.md5(F.col("user_id").cast("string")), F.lit("/"), folder, F.lit("/"), F.col("event_type"))
    text = F.concat(F.col("event_id").cast("string"), F.lit("\n"))
    return run_tree.records_of(table.select(path.alias("path"), text.alias("text")))


def identity_check(spark: SparkSession, sf: str) -> DataFrame:
    """Runs whose name and tags disagree, with the product tags of the second chain moved on by one."""
    moved = F.concat(F.lit("P"), F.lpad((F.substring("product_id", 2, 9).cast("int") + 1).cast("string"), 3, "0"))
    second = F.col("tag_execution_number") == "2"
    wide = run_tree.to_wide(long_records(spark, sf)).withColumn("product_id", F.col("tag_Product_ID"))
    broken = wide.withColumn("tag_Product_ID", F.when(second, moved).otherwise(F.col("tag_Product_ID")))
    return run_tree.check_identity(broken)


def wide_model_records(spark: SparkSession, sf: str) -> DataFrame:
    """Records turned into the long form of the tree and back into the typed table."""
    return run_tree.model_table(run_tree.to_wide(long_records(spark, sf)))


def wide_global_records(spark: SparkSession, sf: str) -> DataFrame:
    return run_tree.global_table(run_tree.to_wide(long_records(spark, sf))).drop("execution_number")


def latest_metric_points(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a metric history per user and type; the newest point of each."""
    table = read_table(spark, sf, "events")
    points = table.select(
        F.col("user_id").cast("string").alias("run_id"),
        F.col("event_type").alias("key"),
        F.col("ts").cast("timestamp").alias("ts"),
        "value",
        F.col("event_id").alias("step"),
    )
    return run_tree.latest_points(points)


def record_kinds(spark: SparkSession, sf: str) -> DataFrame:
    """Records of each kind per batch, counted over one table of all records."""
    kinds = run_tree.with_kind(run_tree.to_wide(long_records(spark, sf)))
    batch = F.col("tag_batch_number").cast("int").alias("batch_number")
    return kinds.groupBy(batch, "kind").agg(F.count("*").alias("n_runs"))


def written_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The records of both chains, written one after the other, and the second again: a repeated write replaces its own."""
    base = shared_dir(spark, "written")
    for number in (1, 2, 2):
        write_runs(chain(spark, sf, number), base)
    return spark.read.parquet(base).select(*RUN_KEY, "run_id", "execution_number", "rmse", "data_points")


def batch_extract(spark: SparkSession, sf: str) -> DataFrame:
    base = shared_dir(spark, "extract")
    write_panel(batched(spark, sf), base)
    return read_batch(spark, base, 3).select(*RUN_KEY, "day", "y")


# --- panel ---------------------------------------------------------------------------------------


def dedup_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Every order line loaded twice, repeats removed, then summed."""
    lines = read_table(spark, sf, "lineitem")
    once = panel.dedup_rows(lines.unionByName(lines))
    return name_series(panel.daily_panel(sales_from_lineitem(once)))


def dedup_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order line number, the smallest by quantity, then price."""
    lines = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    return panel.dedup_rows(lines, ["l_orderkey", "l_linenumber"])


def doubled_target(spark: SparkSession, sf: str) -> DataFrame:
    """Variance of the daily target per series with every row loaded twice, against the clean one."""
    lines = sales(spark, sf)
    spread = lambda df, name: (
        name_series(panel.daily_panel(df)).groupBy(*SERIES).agg(F.var_pop("y").alias(name))
    )
    both = spread(lines.unionByName(lines), "doubled").join(spread(lines, "clean"), SERIES)
    return both.withColumn("ratio", F.col("doubled") / F.nullif(F.col("clean"), F.lit(0.0)))


def doubled_loads(spark: SparkSession, sf: str) -> DataFrame:
    """Three loads of order lines, of which the third holds the rows of the second again: named per series and batch."""
    lines = sales_from_lineitem(read_table(spark, sf, "lineitem"), keep=["l_linenumber", "l_extendedprice"])
    odd = F.col("l_linenumber") % 2 == 1
    sent = lines.withColumn("load", F.explode(F.when(odd, F.array(F.lit(1))).otherwise(F.array(F.lit(2), F.lit(3)))))
    placed = name_series(panel.assign_batch(sent, 90, F.lit(ORIGIN).cast("date")))
    return loads.repeated_loads(placed, "load", RUN_KEY, ["day", "y", "l_linenumber", "l_extendedprice"])


def batch_assignment(spark: SparkSession, sf: str) -> DataFrame:
    return batched(spark, sf).groupBy("batch_number").agg(
        F.count("*").alias("n_rows"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.sum("y").alias("total"),
    )


def history_asof(spark: SparkSession, sf: str) -> DataFrame:
    """What every batch can see of every series, also in batches in which the series has no rows."""
    return running.history_totals(batched(spark, sf))


def history_profile(spark: SparkSession, sf: str) -> DataFrame:
    return panel.history_profile(batched(spark, sf))


def long_window(spark: SparkSession, sf: str) -> DataFrame:
    return panel.last_rows(daily(spark, sf), 365)


def short_window(spark: SparkSession, sf: str) -> DataFrame:
    return panel.last_rows(daily(spark, sf), 180)


def rows_not_days(spark: SparkSession, sf: str) -> DataFrame:
    """Short windows that span more days than they have rows."""
    sizes = panel.window_profile(panel.last_rows(daily(spark, sf), 180))
    return sizes.filter("has_gap").drop("has_gap")


def window_profile(spark: SparkSession, sf: str) -> DataFrame:
    return panel.window_profile(batched(spark, sf), RUN_KEY)


def gap_list(spark: SparkSession, sf: str) -> DataFrame:
    return panel.gap_list(daily(spark, sf))


def missing_series(spark: SparkSession, sf: str) -> DataFrame:
    """(series, week) pairs without sales, over the whole grid of stores and products."""
    return panel.missing_series(batched(spark, sf, WEEKS), grid=True)


def dense_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return panel.dense_calendar(daily(spark, sf))


# --- forecast ------------------------------------------------------------------------------------


def marked(spark: SparkSession, sf: str) -> DataFrame:
    return marked_windows(batched(spark, sf), DEFAULT)


def trend_fit(spark: SparkSession, sf: str) -> DataFrame:
    return forecast.fit_trend(marked(spark, sf))


def weekly_fit(spark: SparkSession, sf: str) -> DataFrame:
    return forecast.fit_weekly(marked(spark, sf))


def fourier_columns(spark: SparkSession, sf: str) -> DataFrame:
    return forecast.fourier(daily(spark, sf), 365.25, 2)


def bounded(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The panel and the bounds of its windows, each written once."""
    rows = stage(batched(spark, sf), "panel")
    return rows, stage(running.window_bounds(rows), "bounds")


def predicted_days(spark: SparkSession, sf: str) -> DataFrame:
    rows, bounds = bounded(spark, sf)
    return forecast.predict(running.fit_weekly_running(rows, bounds), running.scored_rows(rows, bounds))


def running_weekly(spark: SparkSession, sf: str) -> DataFrame:
    """The fit of `weekly_fit` from differences of running sums."""
    return running.fit_weekly_running(*bounded(spark, sf))


def additive_weekly(spark: SparkSession, sf: str) -> DataFrame:
    """Trend and weekday levels fitted together, with the error on the held out days, from differences of running sums."""
    return running.fit_additive_weekly(*bounded(spark, sf))


def additive_by_days(spark: SparkSession, sf: str) -> DataFrame:
    """Extent and scale of the grouped fit, and its slope as a plain line, with every day sent to Python once."""
    models = running.fit_series_by_days(*bounded(spark, sf), LINE_ONLY).filter("n_train > 1")
    slope = F.element_at("beta", 2) * F.col("y_scale") / F.col("t_span")
    return models.select(*RUN_KEY, "n_train", "t_start", "t_span", "y_scale", (F.round(slope, 4) + 0.0).alias("slope"))


def scoring_split(spark: SparkSession, sf: str) -> DataFrame:
    scored_day = F.when(F.col("is_scored"), F.col("day"))
    return marked(spark, sf).groupBy(*RUN_KEY).agg(
        F.count_if("is_train").alias("n_train"),
        F.count_if("is_scored").alias("n_scored"),
        F.min(scored_day).alias("first_scored"),
        F.max(scored_day).alias("last_scored"),
    )


def additive_models(spark: SparkSession, sf: str) -> DataFrame:
    """Extent and scale of the grouped fit of every model."""
    return forecast.fit_series(marked(spark, sf)).select(*RUN_KEY, "n_train", "t_start", "t_span", "y_scale")


#: Without bends, seasons and penalty the grouped fit is least squares on a line.
LINE_ONLY = forecast.AdditiveSpec(changepoints=0, yearly_order=0, weekly_order=0, trend_scale=1e6)


def additive_trend(spark: SparkSession, sf: str) -> DataFrame:
    """Slope per day of the grouped fit as a plain line, to four digits."""
    models = forecast.fit_series(marked(spark, sf), LINE_ONLY).filter("n_train > 1")
    slope = F.element_at("beta", 2) * F.col("y_scale") / F.col("t_span")
    return models.select(*RUN_KEY, "n_train", (F.round(slope, 4) + 0.0).alias("slope"))


def additive_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Scored days predicted in the JVM from the stored coefficients of the grouped fit."""
    rows, bounds = bounded(spark, sf)
    return forecast.predict_additive(running.fit_series_by_days(rows, bounds), running.scored_rows(rows, bounds))


def additive_scores(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(model_run(batched(spark, sf), DEFAULT, forecast.fit_predict_additive))


def month_calendar(rows: DataFrame, before: int = 0, after: int = 0) -> DataFrame:
    """A calendar from the panel: the first and the last day of each month on which anything was sold."""
    month = F.date_trunc("month", "day").alias("_month")
    ends = rows.groupBy(month).agg(F.min("day").alias("opens"), F.max("day").alias("closes"))
    return ends.unpivot(["_month"], ["opens", "closes"], "holiday", "day").select(
        "holiday", "day", F.lit(before).alias("before"), F.lit(after).alias("after")
    )


def holiday_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Regressors that hold on each day: two days before to one day after the ends of each month."""
    return holidays.expanded(month_calendar(daily(spark, sf), 2, 1))


#: A line, weekdays and holidays without penalty: plain least squares.
LINE_AND_WEEK = forecast.AdditiveSpec(changepoints=0, yearly_order=0, trend_scale=1e6, season_scale=1e6, holiday_scale=1e6)


def holiday_effects(spark: SparkSession, sf: str) -> DataFrame:
    """What the first day of a month adds to trend and weekday in each window that saw it on three days, to three digits."""
    rows, bounds = bounded(spark, sf)
    calendar = month_calendar(rows).filter("holiday = 'opens'")
    models, names = holidays.fit_with_holidays(rows, bounds, calendar, LINE_AND_WEEK)
    effects = holidays.holiday_effects(models.filter("n_train >= 30"), names, least_days=3)
    return effects.select(*RUN_KEY, "holiday", "days", (F.round("effect", 3) + 0.0).alias("effect"))


# --- scores --------------------------------------------------------------------------------------


def model_scores(spark: SparkSession, sf: str) -> DataFrame:
    return runs(spark, sf).drop("execution_number")


def in_sample_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Scores over the training window itself instead of held out days."""
    return runs(spark, sf, MonitorConfig(origin=ORIGIN, holdout_percent=0)).select(*RUN_KEY, *SCORES)


def score_audit(spark: SparkSession, sf: str) -> DataFrame:
    """The identities of the scores, with the spread of the second chain doubled so that it breaks them."""
    spread = F.col("erreur_std") * F.when(F.col("execution_number") == 2, 2.0).otherwise(1.0)
    return scoring.audit_scores(chains(spark, sf).withColumn("erreur_std", spread))


def implied_variance(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.compare_implied_variance(chains(spark, sf))


# --- drift ---------------------------------------------------------------------------------------


def drift_flags(spark: SparkSession, sf: str) -> DataFrame:
    return drift.drift_flags(batched(spark, sf))


def distribution_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Drift of whole distributions: each batch against the merged histograms of the three before."""
    return distributions.distribution_drift(distributions.batch_histograms(batched(spark, sf), 0.0, 200.0, 40))


def train_windows(spark: SparkSession, sf: str) -> DataFrame:
    rows = drift.training_windows(batched(spark, sf))
    return rows.groupBy(*RUN_KEY, "has_concept_drift").agg(
        F.max("data_points").alias("data_points"),
        F.max("training_period_days").alias("training_period_days"),
        F.count("*").alias("n_rows"),
        F.min("day").alias("first_day"),
        F.sum("y").alias("total"),
        F.sum("rank_from_end").alias("rank_sum"),
    )


def window_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return drift.window_sizes(drift.training_windows(batched(spark, sf)))


def window_recovery(spark: SparkSession, sf: str) -> DataFrame:
    """Batches in which a series came back from the short to the long window."""
    order = Window.partitionBy(*SERIES).orderBy("batch_number")
    sizes = chain(spark, sf, 1).select(
        *RUN_KEY,
        "has_concept_drift",
        "data_points",
        F.lag("has_concept_drift").over(order).alias("was_drift"),
        F.lag("data_points").over(order).alias("points_before"),
    )
    return sizes.filter("was_drift and not has_concept_drift").drop("was_drift", "has_concept_drift")


def drift_episodes(spark: SparkSession, sf: str) -> DataFrame:
    return drift.drift_episodes(drift.drift_flags(batched(spark, sf), drift.DriftRule(threshold=1.0)))


# --- roll-ups ------------------------------------------------------------------------------------


def batch_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return monitor(sales(spark, sf), DEFAULT).drop("execution_number")


LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def batch_rollup_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """The whole job on order lines loaded twice, with repeats removed by the columns of a line."""
    lines = read_table(spark, sf, "lineitem")
    twice = sales_from_lineitem(lines.unionByName(lines), keep=LINE)
    config = MonitorConfig(origin=ORIGIN, dedup=[*LINE, *SERIES, "day", "y"])
    return monitor(twice, config).drop("execution_number")


def partial_batches(spark: SparkSession, sf: str) -> DataFrame:
    """All weekly batches: models, series without rows, and series with rows that got no model.

    The three add up to the number of series. Two tables of one row per batch are joined to the list of batches.
    """
    rows = batched(spark, sf, WEEKS)
    rolled = rollup.batch_rollup(model_run(rows, WEEKS)).select(
        "batch_number", "nombre_modeles", "modeles_avec_derive", "rmse_global"
    )
    seen = rows.select(*RUN_KEY).distinct().groupBy("batch_number").agg(F.count("*").alias("n_seen"))
    series = rows.select(*SERIES).distinct().agg(F.count("*").alias("n")).scalar()
    last = rows.agg(F.max("batch_number").alias("last"))
    batches = last.select(F.explode(F.sequence(F.lit(1), "last")).alias("batch_number"))
    zero = lambda name: F.coalesce(name, F.lit(0))
    return batches.join(seen, "batch_number", "left").join(rolled, "batch_number", "left").select(
        "batch_number",
        zero("nombre_modeles").alias("nombre_modeles"),
        zero("modeles_avec_derive").alias("modeles_avec_derive"),
        "rmse_global",
        (series - zero("n_seen")).alias("series_absent"),
        (zero("n_seen") - zero("nombre_modeles")).alias("series_without_model"),
    )


def sample_std_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.batch_rollup(chain(spark, sf, 1), sample_std=True).select(
        "batch_number", "rmse_std", "mae_std", "r2_std"
    )


def dimension_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.dimension_rollup(chain(spark, sf, 1))


def rollup_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Stored roll-ups of both chains against the records of the first: those of the second find no members."""
    records = stored_chains(spark, sf)
    return rollup.audit_rollups(records.filter(F.col("execution_number") == 1), chain_rollups(records))


def revised_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Roll-ups of the first chain after 15 series were run again: moments revised by the old and new records of those only."""
    records = stored_chains(spark, sf)
    again = (F.col("product_id") == "P001") | ((F.col("product_id") == "P002") & (F.col("store_id") <= "S005"))
    first, second = (records.filter(F.col("execution_number") == n) for n in (1, 2))
    moments = stage(rollup.batch_moments(first), "moments")
    return rollup.measures_of(rollup.revise(moments, first.filter(again), second.filter(again)))


# --- history -------------------------------------------------------------------------------------


def latest_runs(spark: SparkSession, sf: str) -> DataFrame:
    return history.latest_runs(chains(spark, sf)).select(
        *RUN_KEY, "run_id", "execution_number", "logged_at", "data_points"
    )


def closing_rollups(spark: SparkSession, sf: str) -> DataFrame:
    """Model records of both chains with the roll-up that closes them, found by time only."""
    models = stored_chains(spark, sf)
    rollups = chain_rollups(models)
    bare = models.select("run_id", *SERIES, "logged_at").withColumns(
        {"batch_number": F.lit(None).cast("int"), "execution_number": F.lit(None).cast("int")}
    )
    return history.close_runs(bare, rollups)


def next_purchase(spark: SparkSession, sf: str) -> DataFrame:
    """Every event with the next purchase of the same user."""
    table = read_table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    marks = table.filter(F.col("event_type") == "purchase").select(
        "user_id", "ts", F.col("event_id").alias("purchase_id")
    )
    return timeline.next_mark(table, marks, "ts", "purchase_id", keys=["user_id"])


def next_purchase_of_all(spark: SparkSession, sf: str) -> DataFrame:
    """Every event with the next purchase of anybody: an order without a key."""
    table = read_table(spark, sf, "events").select("event_id", "ts", "event_type")
    marks = table.filter(F.col("event_type") == "purchase").select(
        "ts", F.col("event_id").alias("purchase_id")
    )
    return timeline.next_mark(table, marks, "ts", "purchase_id")


def compare_chains(spark: SparkSession, sf: str) -> DataFrame:
    records = stored_chains(spark, sf)
    one, two = (records.filter(F.col("execution_number") == n) for n in (1, 2))
    return history.compare_chains(one, two, ["rmse", "mae", "data_points"])


def score_change(spark: SparkSession, sf: str) -> DataFrame:
    return history.score_change(chain(spark, sf, 1))


def worst_series(spark: SparkSession, sf: str) -> DataFrame:
    return history.worst_series(chain(spark, sf, 1), 5)


def product_ranking(spark: SparkSession, sf: str) -> DataFrame:
    return history.product_ranking(chain(spark, sf, 1), 3)


def flag_changes(spark: SparkSession, sf: str) -> DataFrame:
    return history.flag_changes(chain(spark, sf, 2), 4, 5)


def flag_transitions(spark: SparkSession, sf: str) -> DataFrame:
    return history.flag_transitions(chain(spark, sf, 2))


PERIODS = [("early", "1995-01-01"), ("middle", "1997-01-01"), ("late", "2000-01-01")]


def coverage(spark: SparkSession, sf: str) -> DataFrame:
    models = chains(spark, sf)
    period = history.period_label(F.col("logged_at"), PERIODS).alias("period")
    return history.coverage(models, [*SCORES, "execution_number"], by=["execution_number", period])


def model_executions(spark: SparkSession, sf: str) -> DataFrame:
    """Records of both chains grouped by pauses of more than five days."""
    return timeline.idle_groups(chains(spark, sf), "logged_at", 5 * 86_400)


def user_executions(spark: SparkSession, sf: str) -> DataFrame:
    return timeline.idle_groups(read_table(spark, sf, "events"), "ts", 6 * 3600, ["user_id"])


def event_executions(spark: SparkSession, sf: str) -> DataFrame:
    """Every event with the number of its execution; pauses of ten minutes over all users."""
    table = read_table(spark, sf, "events").select("event_id", "ts")
    return timeline.assign_idle_groups(table, "ts", 600)


def log_seconds(spark: SparkSession, sf: str) -> DataFrame:
    """Seconds between successive events of a type: number, mean, extremes."""
    gaps = timeline.seconds_between(read_table(spark, sf, "events"), "ts", ["event_type"])
    return gaps.groupBy("event_type").agg(
        F.sum("n_runs").alias("n_runs"),
        F.avg("seconds").alias("mean_seconds"),
        F.min("seconds").alias("min_seconds"),
        F.max("seconds").alias("max_seconds"),
    )


def log_seconds_median(spark: SparkSession, sf: str) -> DataFrame:
    gaps = timeline.seconds_between(read_table(spark, sf, "events"), "ts", ["event_type"])
    return selection.quantiles(gaps, ["event_type"], "seconds", [0.5])


def model_seconds(spark: SparkSession, sf: str) -> DataFrame:
    """Seconds between successive log times of the records of a batch."""
    gaps = timeline.seconds_between(chains(spark, sf), "logged_at", ["batch_number"])
    return selection.quantiles(gaps, ["batch_number"], "seconds", [0.5])


def score_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    return selection.quantiles(chain(spark, sf, 1), ["batch_number"], "rmse", [0.1, 0.5, 0.9])


def price_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """The same operator on all order lines: few keys, many values."""
    lines = read_table(spark, sf, "lineitem")
    return selection.quantiles(lines, ["l_returnflag"], "l_extendedprice", [0.25, 0.5, 0.75, 0.99])


def sketched_prices(spark: SparkSession, sf: str) -> DataFrame:
    """Approximate price quantiles from sketches stored per return flag and year, with whether their rank is within 1 %."""
    lines = read_table(spark, sf, "lineitem").select("l_returnflag", F.year("l_shipdate").alias("year"), "l_extendedprice")
    stored = stage(distributions.sketches(lines, ["l_returnflag", "year"], ["l_extendedprice"]), "sketches")
    found = distributions.sketched_quantiles(stored, ["l_returnflag"], "l_extendedprice", [0.01, 0.25, 0.5, 0.75, 0.99])
    below = lines.join(found, "l_returnflag").groupBy("l_returnflag", "probability").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("l_extendedprice") <= F.col("quantile")).alias("_rank")
    )
    off = F.abs(F.col("_rank") / F.col("n_rows") - F.col("probability"))
    return below.select("l_returnflag", "probability", "n_rows", (off <= 0.01 + 1 / F.col("n_rows")).alias("within"))


def score_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return history.histogram(chain(spark, sf, 1), "rmse", 0.0, 60.0, 12)


# --- streaming -----------------------------------------------------------------------------------


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = read_table(spark, sf, "events").schema
    return events.file_stream(spark, sf, schema, "events.parquet")


def stream_pickup(spark: SparkSession, sf: str) -> DataFrame:
    picked = event_stream(spark, sf).select("event_id", "ts", "user_id", "event_type", "value")
    return sinks.run_available(spark, picked, "pickup")


def stream_monitor(spark: SparkSession, sf: str) -> DataFrame:
    schema = read_table(spark, sf, "lineitem").schema
    arriving = events.file_stream(spark, sf, schema, "lineitem.parquet")
    out = arrivals.replay(spark, sales_from_lineitem(arriving), MonitorConfig(origin=ORIGIN))
    return spark.read.parquet(out.global_runs).drop("execution_number")


def stream_monitor_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines that arrive twice, in several micro-batches, with repeats removed within and across them."""
    lines = read_table(spark, sf, "lineitem")
    base, kept = shared_dir(spark, "lines"), shared_dir(spark, "replay")
    sent = sales_from_lineitem(lines, keep=LINE).withColumn("half", F.year("day") >= 1998)
    config = MonitorConfig(origin=ORIGIN, dedup=[*LINE, *SERIES, "day", "y"])
    for part in (~F.col("half"), F.col("half"), F.lit(True)):
        rows = sent.filter(part).drop("half")
        rows.write.mode("append").option("compression", "zstd").parquet(base)
        # What was sent since the stream ended is one micro-batch of the next run, in as many files as the scan had tasks.
        arriving = events.file_stream(spark, base, rows.schema)
        arrivals.monitor_stream(arriving, kept, config).awaitTermination()
    return spark.read.parquet(arrivals.Outputs.below(kept).global_runs).drop("execution_number")


def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every event sent twice and written once."""
    twice = event_stream(spark, sf).unionByName(event_stream(spark, sf))
    once = events.drop_repeats(twice, ["event_id"])
    return sinks.run_available(spark, once.select("event_id", "user_id", "value"), "dedup")


WINDOW = ["window_start", "window_end", "event_type"]


def stream_daily(spark: SparkSession, sf: str) -> DataFrame:
    totals = events.daily_totals(event_stream(spark, sf), ["event_type"])
    return sinks.run_latest(spark, totals, WINDOW, "daily")


def stream_sliding(spark: SparkSession, sf: str) -> DataFrame:
    totals = events.sliding_totals(event_stream(spark, sf), ["event_type"])
    return sinks.run_latest(spark, totals, WINDOW, "sliding")


def with_state_store(spark: SparkSession, run: Callable[[], DataFrame]) -> DataFrame:
    """Run a stream with the state store that stateful processors need."""
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, STATE_STORE)
    try:
        return run()
    finally:
        spark.conf.set(provider, before)


def stream_executions(spark: SparkSession, sf: str) -> DataFrame:
    """Executions of every user, the open ones too."""
    changes = sessions.open_sessions(event_stream(spark, sf), ["user_id"], 6 * 3600)
    newest = with_state_store(spark, lambda: sinks.run_latest(spark, changes, ["user_id", "started_at"], "executions"))
    return newest.filter("n_runs > 0")


def stream_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Drift of every batch from a stream of the panel in which each batch comes in two parts.

    Ten batches at a time come as a first and a second half, so a row is at most ten batches late however long the table.
    """
    base = shared_dir(spark, "panel")
    rows = stage(batched(spark, sf), "batches")
    last = rows.agg(F.max("batch_number")).first()[0] or 0
    for part in range(last // 10 + 1):
        for half in (0, 1):
            own = (F.floor(F.col("batch_number") / 10) == part) & (F.dayofyear("day") % 2 == half)
            rows.filter(own).coalesce(1).write.parquet(f"{base}/part{part:06}{half}")
    arriving = events.file_stream(spark, f"{base}/*", rows.schema, max_files=1)
    flags = drift_state.drift_stream(arriving, late_batches=10)
    return with_state_store(spark, lambda: sinks.run_latest(spark, flags, RUN_KEY, "drift"))


QUERIES: list[Query] = [
    metric_lines, run_names, run_files, identity_check, wide_model_records, wide_global_records,
    latest_metric_points, record_kinds, written_runs, batch_extract,
    daily, dedup_panel, dedup_by_key, doubled_target, doubled_loads, batch_assignment, history_asof, history_profile,
    long_window, short_window, rows_not_days, window_profile, gap_list, missing_series, dense_calendar,
    trend_fit, weekly_fit, fourier_columns, predicted_days, scoring_split,
    running_weekly, additive_weekly, additive_by_days, holiday_calendar, holiday_effects,
    additive_models, additive_trend, additive_predictions, additive_scores,
    model_scores, in_sample_scores, score_audit, implied_variance,
    drift_flags, distribution_flags, train_windows, window_sizes, window_recovery, drift_episodes,
    batch_rollup, batch_rollup_dedup, partial_batches, sample_std_rollup, dimension_rollup,
    rollup_audit, revised_rollup,
    latest_runs, closing_rollups, next_purchase, next_purchase_of_all, compare_chains, score_change,
    worst_series, product_ranking, flag_changes, flag_transitions, coverage, model_executions,
    user_executions, event_executions, log_seconds, log_seconds_median, model_seconds,
    score_quantiles, price_quantiles, sketched_prices, score_histogram,
    stream_pickup, stream_monitor, stream_monitor_dedup, stream_dedup, stream_daily, stream_sliding, stream_executions,
    stream_drift,
]


def all_queries() -> dict[str, Query]:
    def reported(query: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return tidy(query(spark, sf))

        return run

    names = {daily: "daily_panel"}
    return {names.get(q, q.__name__): reported(q) for q in QUERIES}
