"""Registered queries: every operator run over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..config import Assumptions
from ..functions import bands, decision, parse
from ..functions.rounding import round_exact
from ..operators import benchmarks, clean, features, metrics, options, ranking, split
from ..session import checkpoint_root, materialize
from ..sources import proxy, readers, registry, writers
from ..sources.proxy import ROW_ID
from ..sources.writers import append_log, prediction_log
from . import batch, evaluate as ev
from .models import together
from .train import Artifacts, load_artifacts, score, train

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SCENARIOS = [
    Assumptions(),
    Assumptions(target_profit_margin=0.05, min_dollar_profit=250.0, risk_tolerance=0.30),
    Assumptions(holding_cost_per_day=45.0, repair_estimate=1500.0),
    Assumptions(acquisition_discount=0.35, target_profit_margin=0.25),
]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r4(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 4)


# --- shared inputs ------------------------------------------------------------
def scored_listings(spark: SparkSession, d: str, live: bool = False) -> DataFrame:
    """Whole listings table with benchmarks resolved and surrogate scores."""
    sold = materialize(proxy.sales(spark, d))
    bench = materialize(benchmarks.market_benchmark(sold))
    dts = materialize(proxy.days_table(spark, d))
    feed = materialize(benchmarks.comparables(proxy.live_listings(sold))) if live else None
    resolved = ev.resolve_benchmarks(proxy.listings(sold), bench, dts, feed)
    return ev.settle_sources(proxy.with_surrogate_scores(resolved))


def labelled_scores(spark: SparkSession, d: str) -> DataFrame:
    """Sales with the profit label and a fixed score formula, many of them tied."""
    sold = proxy.sales(spark, d)
    noise = ((F.col("l_orderkey") * 31 + F.col("l_partkey") * 7 + F.col("l_linenumber")) % 997) / 997.0
    label = bands.profit_label(F.round("price", 2), F.col("mmr"), 0.20, 0.15)
    return sold.select("state", "price", "mmr", "make", label.alias("label"),
                       F.round(0.35 * label + 0.65 * noise, 4).alias("score"))


def regression_frame(spark: SparkSession, d: str) -> DataFrame:
    wave = 0.85 + 0.005 * ((F.col("l_partkey") * 37 + F.col("l_suppkey")) % 40)
    return proxy.sales(spark, d).select("state", "price", "mmr", (F.col("mmr") * wave).alias("pred"))


# --- sources and parsing --------------------------------------------------------
@query
def parse_numbers(spark, d):
    raw = proxy.raw_sales(proxy.sales(spark, d))
    return raw.select(*proxy.RAW_ORDER,
                      *[parse.dirty_number(F.col(c)).alias(f"{c}_num")
                        for c in ("sellingprice", "mmr", "odometer")],
                      *[parse.plain_number(F.col(c)).alias(f"{c}_num")
                        for c in ("year", "condition")])


@query
def scan_sales(spark, d):
    raw = proxy.raw_sales(proxy.sales(spark, d))
    return clean.parse_sales(raw, proxy.RAW_ORDER)


@query
def strip_suffix(spark, d):
    raw = proxy.raw_retail(proxy.sales(spark, d))
    stripped = parse.norm_text(parse.strip_transmission(F.col("model")))
    return raw.groupBy("model").agg(F.count(F.lit(1)).alias("n")).select(
        "model", stripped.alias("stripped"), "n")


@query
def clean_sales(spark, d):
    parsed = clean.parse_sales(proxy.raw_sales(proxy.sales(spark, d)), proxy.RAW_ORDER)
    return clean.clean_sales(parsed, proxy.RAW_ORDER)


@query
def dedup_sales(spark, d):
    sold = proxy.sales(spark, d).withColumn("price", F.round("price", -3))
    return clean.dedup_first(sold, ["make", "year", "state", "price"], ROW_ID)


def _blended(spark, d) -> DataFrame:
    sold = materialize(proxy.sales(spark, d))  # stored, as each source reads it
    keep = proxy.RAW_ORDER
    return clean.blend(clean.from_retail(proxy.raw_retail(sold), keep),
                       clean.from_auction(proxy.raw_sales(sold), keep),
                       clean.from_recent(proxy.raw_recent(sold), keep))


@query
def harmonize_union(spark, d):
    return (_blended(spark, d).groupBy("source", "source_channel", "make")
            .agg(F.count(F.lit(1)).alias("n"), F.count("price").alias("prices"),
                 F.count("year").alias("years"), F.count("state").alias("states"),
                 F.count("condition").alias("conditions"),
                 r4(F.sum("mileage")).alias("mileage_sum"), F.min("model").alias("first_model"),
                 F.max("model").alias("last_model")))


@query
def harmonize_clean(spark, d):
    return clean.clean_blended(_blended(spark, d), proxy.RAW_ORDER)


@query
def dts_latest(spark, d):
    return benchmarks.latest_days(proxy.days_sheet(spark, d))


# --- splits ---------------------------------------------------------------------
@query
def split_counts(spark, d):
    return (split.with_split(proxy.sales(spark, d), ROW_ID)
            .groupBy("split", "make").agg(F.count(F.lit(1)).alias("n")))


@query
def split_recent(spark, d):
    return (split.with_recent_holdout(proxy.sales(spark, d), ROW_ID, recent_year=2000)
            .groupBy("split", "year").agg(F.count(F.lit(1)).alias("n")))


@query
def sample_cap(spark, d):
    return split.sample_rows(proxy.sales(spark, d).select(*ROW_ID, "make", "mmr"), ROW_ID, 20_000)


# --- files ----------------------------------------------------------------------
def _folder(spark, name: str) -> str:
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def _sales_files(spark, d) -> str:
    path = _folder(spark, "sales-csv")
    # stored: the records, their repeats, the lines without fields and the headers each read the sales
    lines = proxy.sales_lines(proxy.raw_sales(materialize(proxy.sales(spark, d))))
    writers.write_lines(lines, path, proxy.SALES_HEADER, "part", [*ROW_ID, "copy"])
    return f"{path}/part=*"


@query
def csv_roundtrip(spark, d):
    """Sales written as text with long, short, broken and many-line records, read back and cleaned."""
    return readers.load_sales(spark, _sales_files(spark, d), multi_line=True)


@query
def csv_first_rows(spark, d):
    """The first rows in the order of files and lines."""
    rows = readers.read_text_csv(spark, _sales_files(spark, d), nrows=7_500, multi_line=True)
    return rows.select("make", F.lower("model").alias("model"), "sellingprice", "seller")


@query
def csv_listing_errors(spark, d):
    """Listings written as text and read back: the line numbers and problems of invalid rows."""
    path = _folder(spark, "listings-csv")
    lines = proxy.listing_lines(proxy.raw_listings(proxy.sales(spark, d)))
    writers.write_lines(lines, path, ",".join(proxy.LISTING_COLUMNS), "part", [*ROW_ID, "odometer"])
    checked = batch.validate(readers.load_listings(spark, f"{path}/part=*"))
    return checked.where(F.col("error").isNotNull()).select("row", "error")


@query
def split_roundtrip(spark, d):
    """Tagged sales written by split; the test rows are read back from their own folder."""
    tagged = split.with_split(proxy.sales(spark, d), ROW_ID)
    path = _folder(spark, "splits")
    writers.write_splits(tagged, path)
    return writers.read_split(spark, path, tagged.schema, "test").select(*ROW_ID, "make", "mmr", "split")


# --- benchmarks -----------------------------------------------------------------
@query
def mmr_rollup(spark, d):
    return benchmarks.market_benchmark(proxy.sales(spark, d)).select(
        "level", "make", "model", "year", r4("value").alias("value"), "n")


@query
def mmr_approximate(spark, d):
    """Medians from merged sketches: whether each group's rank error, counted row by row, is within twice the stated one."""
    sold = proxy.sales(spark, d)
    sketches = materialize(benchmarks.market_sketches(sold))
    measured = benchmarks.measured_rank_error(sold, sketches)
    within = F.col("error") <= 2 * benchmarks.sketch_rank_error()
    return benchmarks.named_levels(measured, "n", within.alias("within"))


@query
def mmr_retail_proxy(spark, d):
    sold = proxy.sales(spark, d).drop("mmr").withColumn(
        "source_channel", F.when(F.col("l_linenumber") <= 3, "retail").otherwise("wholesale"))
    return benchmarks.market_benchmark(sold).select(
        "level", "make", "model", "year", r4("value").alias("value"), "n")


def _resolved(spark, d) -> DataFrame:
    sold = materialize(proxy.sales(spark, d))
    bench = materialize(benchmarks.market_benchmark(sold))
    dts = materialize(proxy.days_table(spark, d))
    return ev.resolve_benchmarks(proxy.listings(sold), bench, dts)


@query
def mmr_lookup(spark, d):
    return _resolved(spark, d).select(
        *ROW_ID, r4("lookup_value").alias("lookup_value"), "lookup_level", "lookup_n")


@query
def mmr_resolve(spark, d):
    delta = bands.price_delta(F.col("listing_price"), F.col("mmr"))
    return _resolved(spark, d).select(
        *ROW_ID, r4("mmr").alias("mmr"), "mmr_match_level", "mmr_sample_size",
        r4(delta).alias("delta"))


@query
def dts_lookup(spark, d):
    return _resolved(spark, d).select(
        *ROW_ID, r4("make_days").alias("make_days"),
        bands.days_to_band(F.col("make_days")).alias("make_band"))


@query
def comparables(spark, d):
    live = benchmarks.comparables(proxy.live_listings(proxy.sales(spark, d)))
    return live.select("any_state", "make", "model", "year", "state",
                       r4("live_value").alias("live_value"), r4("live_days").alias("live_days"),
                       "live_n")


# --- features and labels ----------------------------------------------------------
def _feature_input(spark, d) -> DataFrame:
    sold = proxy.sales(spark, d)
    return sold.select(
        *ROW_ID, F.when(F.col("l_partkey") % 31 != 0, F.col("year")).alias("year"),
        F.when(F.col("l_partkey") % 37 != 0, F.col("mileage")).alias("mileage"), "condition",
        F.when(F.col("l_suppkey") % 11 != 0, F.col("mmr")).alias("market_value"),
        F.upper("make").alias("make"), "model", "body", "transmission",
        F.when(F.col("l_suppkey") % 20 != 0, F.concat(F.lit(" "), F.col("state"))).alias("state"))


def _rounded_features(df: DataFrame) -> DataFrame:
    return df.withColumns({c: r4(c) for c in config.NUMERIC_FEATURES})


@query
def features_core(spark, d):
    return _rounded_features(features.build_features(
        _feature_input(spark, d), reference_year=proxy.REFERENCE_YEAR, keep=ROW_ID))


@query
def features_imputed(spark, d):
    return _rounded_features(features.build_features(
        _feature_input(spark, d), reference_year=proxy.REFERENCE_YEAR, keep=ROW_ID, parity=True))


@query
def encode_features(spark, d):
    rows = features.build_features(_feature_input(spark, d), keep=ROW_ID)
    known = split.with_split(rows, ROW_ID).where(F.col("split") == "train")
    encoder = materialize(features.fit_encoder(known))
    return features.encode(rows, encoder).select(*ROW_ID, *config.CATEGORICAL_FEATURES)


@query
def profit_label(spark, d):
    label = bands.profit_label(F.round("price", 2), F.col("mmr"), 0.20, 0.15)
    return proxy.sales(spark, d).select(*ROW_ID, label.alias("label"))


@query
def class_weights(spark, d):
    out = metrics.class_weights(labelled_scores(spark, d), "label")
    return out.select("label", "n", r4("weight").alias("weight"))


# --- decision layer ---------------------------------------------------------------
def _evaluated(spark, d, live: bool = False) -> DataFrame:
    return ev.evaluate(scored_listings(spark, d, live))


CORE = ["recommendation", "confidence", "predicted_resale_price", "days_to_sell_band",
        "expected_gross_profit", "roi", "max_purchase_price", "market_value_mmr",
        "price_vs_mmr_delta", "price_source", "mmr_match_level", "mmr_sample_size", "risk_level"]


def core_columns(df: DataFrame) -> DataFrame:
    return df.select(*ROW_ID, *CORE, F.col("risk_summary.market_demand").alias("market_demand"),
                     F.col("risk_summary.days_to_sell_benchmark").alias("days_to_sell_benchmark"),
                     F.col("financial_summary.purchase_price").alias("purchase_price"),
                     F.col("coverage_warning").isNotNull().alias("warned"))


@query
def evaluate_core(spark, d):
    return core_columns(_evaluated(spark, d))


@query
def evaluate_live(spark, d):
    return core_columns(_evaluated(spark, d, live=True))


@query
def evaluate_text(spark, d):
    factors = F.transform("top_factors", lambda f: F.concat(f["factor"], F.lit("="), f["value"]))
    return _evaluated(spark, d).select(
        *ROW_ID, "price_guidance", F.array_join("notes", " | ").alias("notes"),
        F.array_join(factors, " | ").alias("top_factors"), "coverage_warning")


@query
def quality_flags(spark, d):
    flags = F.transform("data_quality_flags",
                        lambda f: F.concat(f["severity"], F.lit(": "), f["message"]))
    return _evaluated(spark, d).select(
        *ROW_ID, F.size("data_quality_flags").alias("n_flags"),
        F.array_join(flags, " | ").alias("flags"))


@query
def financials(spark, d):
    a = Assumptions().columns()
    s = scored_listings(spark, d)
    fin = decision.financials(F.coalesce("listing_price", "mmr"), F.col("predicted_resale"), a,
                              F.when(F.col("l_linenumber") != 4, F.col("benchmark_days")))
    ceiling = decision.max_purchase_price(F.col("predicted_resale"), a, F.col("benchmark_days"))
    return s.select(*ROW_ID, fin.alias("f"), round_exact(ceiling, 2).alias("max_price"),
                    round_exact(decision.required_profit(F.col("predicted_resale"),
                                                     a.target_profit_margin), 2).alias("required_profit")
                    ).select(*ROW_ID, "f.*", "max_price", "required_profit")


@query
def buy_or_pass(spark, d):
    e = _evaluated(spark, d)
    a = Assumptions().columns()
    verdict, reasons = decision.buy_or_pass(
        F.col("roi"), F.col("expected_gross_profit"), F.col("profit_p"), a)
    return e.select(*ROW_ID, verdict.alias("verdict"), F.array_join(reasons, " | ").alias("reasons"))


@query
def reconcile(spark, d):
    return _evaluated(spark, d).select(
        *ROW_ID, r4("predicted_resale").alias("raw"), "predicted_resale_price",
        F.col("resale_confidence.score").alias("weight"))


def _confidence(spark, d, name: str, live: bool = False) -> DataFrame:
    return _evaluated(spark, d, live).select(*ROW_ID, f"{name}.*")


@query
def conf_market(spark, d):
    return _confidence(spark, d, "market_value_confidence", live=True)


@query
def conf_resale(spark, d):
    return _confidence(spark, d, "resale_confidence", live=True)


@query
def conf_band(spark, d):
    return _confidence(spark, d, "days_band_confidence", live=True)


@query
def conf_buy_pass(spark, d):
    return _confidence(spark, d, "buy_pass_confidence")


@query
def condition_scale(spark, d):
    shown = F.when(F.col("l_linenumber") != 6, F.col("l_quantity") * 2.5 - 10)
    return proxy.read(spark, d, "lineitem").select(
        *ROW_ID, shown.alias("shown"),
        bands.condition_to_model_scale(shown).cast("long").alias("grade"))


@query
def scenario_grid(spark, d):
    out = ev.evaluate(scored_listings(spark, d), SCENARIOS)
    return out.groupBy("scenario", "recommendation", "days_to_sell_band", "risk_level").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("expected_gross_profit").cast("decimal(18,2)")), 1)
        .cast("double").alias("profit"),
        F.max("roi").alias("best_roi"), F.min("max_purchase_price").alias("lowest_ceiling"))


# --- batch triage -----------------------------------------------------------------
def _raw_listings(spark, d, sold: DataFrame | None = None) -> DataFrame:
    raw = proxy.raw_listings(materialize(proxy.sales(spark, d)) if sold is None else sold)
    return ranking.with_key_rank(raw, "l_orderkey", [*ROW_ID, "odometer"], "row", start=2)


@query
def batch_validate(spark, d):
    return batch.validate(_raw_listings(spark, d)).select(*ROW_ID, "row", "error")


@query
def batch_errors(spark, d):
    checked = batch.validate(_raw_listings(spark, d))
    return checked.where(F.col("error").isNotNull()).select("row", "error")


@query
def batch_typed(spark, d):
    checked = batch.validate(proxy.raw_listings(proxy.sales(spark, d)))
    return batch.typed(checked.where(F.col("error").isNull())).select(
        *ROW_ID, "make", "model", "year", "odometer", "condition", "body", "transmission",
        "state", "mmr", "listing_price")


def _triage(spark, d) -> tuple[DataFrame, DataFrame]:
    sold = materialize(proxy.sales(spark, d))
    bench = materialize(benchmarks.market_benchmark(sold))
    dts = materialize(proxy.days_table(spark, d))

    def surrogate(valid: DataFrame) -> DataFrame:
        return ev.settle_sources(proxy.with_surrogate_scores(
            ev.resolve_benchmarks(valid, bench, dts)))

    return batch.triage(_raw_listings(spark, d, sold), surrogate)


@query
def batch_results(spark, d):
    return _triage(spark, d)[0]


@query
def batch_summary(spark, d):
    return batch.summary(*_triage(spark, d))


def _ranked(spark, d, objective: str) -> DataFrame:
    # stored before it is sorted: finding the ranges of a sort runs the whole plan below it once more
    results = materialize(_triage(spark, d)[0].select("row", "expected_gross_profit", "roi", "risk_level"))
    return ranking.with_global_rank(results, ranking.objective_order(objective)).select(
        "rank", "row", "expected_gross_profit", "roi", "risk_level")


@query
def batch_rank_profit(spark, d):
    return _ranked(spark, d, "profit")


@query
def batch_rank_roi(spark, d):
    return _ranked(spark, d, "roi")


@query
def batch_rank_risk(spark, d):
    return _ranked(spark, d, "risk")


# --- metrics and monitoring ---------------------------------------------------------
@query
def metrics_regression(spark, d):
    out = metrics.regression_metrics(regression_frame(spark, d), "price", "pred", "mmr")
    return out.select(*[r4(c).alias(c) for c in ("mae", "mape", "rmsle", "r2", "mmr_baseline_mae")],
                      "beats_mmr_baseline")


@query
def state_mae(spark, d):
    out = metrics.state_mae(regression_frame(spark, d), "price", "pred")
    return out.limit(config.WORST_STATES).select("state", r4("mae").alias("mae"), "n")


@query
def state_mae_all(spark, d):
    out = metrics.state_mae(regression_frame(spark, d), "price", "pred")
    return out.select("state", r4("mae").alias("mae"), "n")


@query
def state_gap(spark, d):
    out = metrics.state_gap(metrics.state_mae(regression_frame(spark, d), "price", "pred"))
    return out.select("best_state", "worst_state", *[
        r4(c).alias(c) for c in ("best_mae", "worst_mae", "gap", "gap_ratio")])


@query
def metrics_multiclass(spark, d):
    sold = with_days(spark, d)
    truth = bands.days_to_band(F.col("days"))
    guess = bands.days_to_band(F.col("days") + (F.col("l_partkey") % 7) * 5 - 15)
    out = metrics.classification_metrics(
        sold.select(truth.alias("y"), guess.alias("p")), "y", "p")
    return out.select(r4("accuracy").alias("accuracy"), r4("macro_f1").alias("macro_f1"))


def with_days(spark, d) -> DataFrame:
    return proxy.sales(spark, d).join(proxy.days_table(spark, d), "make")


@query
def metrics_binary(spark, d):
    out = metrics.binary_metrics(labelled_scores(spark, d), "label", "score", 0.42)
    return out.select(*[r4(c).alias(c) for c in out.columns])


@query
def threshold_search(spark, d):
    out = metrics.choose_threshold(labelled_scores(spark, d), "label", "score")
    return out.select(r4("threshold").alias("threshold"), r4("best_f1").alias("best_f1"))


@query
def psi(spark, d):
    sold = proxy.sales(spark, d)
    old = sold.where(F.col("year") < 1999).select("mmr")
    new = sold.where(F.col("year") >= 1999).select(
        F.when(F.col("l_linenumber") != 7, F.col("mmr") * 1.15).alias("mmr"))
    out = metrics.population_stability(old, new, "mmr")
    return out.select(F.round("psi", 6).alias("psi"), "expected_nulls", "actual_nulls")


# --- options ------------------------------------------------------------------------
@query
def options_topn(spark, d):
    return options.option_values(proxy.sales(spark, d))


@query
def options_models(spark, d):
    out = options.option_models(proxy.sales(spark, d))
    return out.select("make", F.size("models").alias("n_models"),
                      F.array_join("models", ",").alias("models"))


@query
def options_scalar(spark, d):
    return options.option_scalars(proxy.sales(spark, d))


@query
def options_row(spark, d):
    out = options.options_row(proxy.sales(spark, d))
    return out.select(*[F.array_join(c, ",").alias(c) if t.startswith("array") else F.col(c)
                        for c, t in out.dtypes])


# --- learned models (checked by rows; their values depend on the fit) ------------------
def _training_sales(spark, d) -> DataFrame:
    return proxy.sales(spark, d).withColumn("price", F.round("price", 2))


@lru_cache(maxsize=4)
def _fitted(spark: SparkSession, d: str) -> tuple[Artifacts, str]:
    """Train once per session and table folder; the model queries share the result."""
    root = f"{checkpoint_root(spark)}/models-{uuid.uuid4().hex}"
    artifacts = train(spark, _training_sales(spark, d), proxy.days_table(spark, d), root, ROW_ID,
                      reference_year=proxy.REFERENCE_YEAR, calibration_rows=None)
    return artifacts, root


def _vectors(spark, d) -> tuple[Artifacts, DataFrame]:
    artifacts, _ = _fitted(spark, d)
    rows = _training_sales(spark, d).withColumn("market_value", F.col("mmr"))
    return artifacts, artifacts.space.vectors(rows)


@query
def model_resale(spark, d):
    artifacts, vectors = _vectors(spark, d)
    return artifacts.resale.transform(vectors).select(*ROW_ID, "price", "model_resale")


@query
def model_band(spark, d):
    artifacts, vectors = _vectors(spark, d)
    return artifacts.band.transform(vectors).select(*ROW_ID, "make", "model_band", "band_proba")


@query
def model_band_truth(spark, d):
    """The band of a row's make decides its label, so the model must give back the benchmark's band."""
    artifacts, vectors = _vectors(spark, d)
    total = F.aggregate("band_probabilities", F.lit(0.0), lambda a, p: a + p)
    sums = artifacts.band.probabilities(vectors).withColumn("proba_total", F.round(total, 9))
    return artifacts.band.transform(sums.drop("band_probabilities")).select(
        *ROW_ID, "make", "model_band", "proba_total")


@query
def model_profit(spark, d):
    artifacts, vectors = _vectors(spark, d)
    return artifacts.profit.predict(vectors).select(*ROW_ID, "profit_p", "good_buy")


@query
def score_listings(spark, d):
    artifacts, _ = _fitted(spark, d)
    scored = score(proxy.listings(_training_sales(spark, d)), artifacts)
    return core_columns(ev.evaluate(scored))


@query
def train_summary(spark, d):
    _, root = _fitted(spark, d)
    return spark.read.schema("model string, metric string, value string").json(
        f"{root}/training_summary")


@query
def registry_roundtrip(spark, d):
    _, root = _fitted(spark, d)
    loaded = load_artifacts(spark, root)
    rows = _training_sales(spark, d).withColumn("market_value", F.col("mmr"))
    used = loaded.resale.transform(loaded.space.vectors(rows)).agg(
        F.lit("loaded").alias("section"), F.lit("m1_resale_rows").alias("name"),
        F.count("model_resale").cast("string").alias("value"))
    return registry.metadata_table(
        spark, root, ["m1_resale", "m2_dts_band", "m3_buy_pass"]).unionByName(used)


def _differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: the rows of ``left``, and those that only one of the two has."""
    rows = left.columns
    counted = (left.withColumn("_n", F.lit(1)).unionByName(right.withColumn("_n", F.lit(-1)))
               .groupBy(*rows).agg(F.sum("_n").alias("_left"), F.count_if(F.col("_n") == 1).alias("_rows")))
    return counted.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("n"),
                       F.coalesce(F.sum(F.abs("_left")), F.lit(0)).alias("differing"))


@query
def registry_tables(spark, d):
    """Benchmark tables stored in the registry and loaded again: rows, and rows that differ."""
    sold = proxy.sales(spark, d)
    root = _folder(spark, "registry")
    kept = {"mmr_lookup": materialize(benchmarks.market_benchmark(sold)),
            "dts_benchmark": materialize(proxy.days_table(spark, d))}
    parts = []
    for name, table in kept.items():
        registry.save_model(spark, root, name, {"table": table}, {"rows": table.count()})
        loaded = registry.load_model(spark, root, name)["table"]
        stated = registry.load_metadata(spark, root, name)["rows"]
        parts.append(_differing(table, loaded).select(F.lit(name).alias("name"), "n", "differing",
                                                      F.lit(stated).cast("long").alias("stated")))
    return parts[0].unionByName(parts[1])


@query
def registry_models(spark, d):
    """All rows scored by the models as trained and as loaded from the registry: rows, and rows that differ."""
    artifacts, vectors = _vectors(spark, d)
    _, root = _fitted(spark, d)
    vectors, loaded = materialize(vectors), load_artifacts(spark, root)

    def compared(name: str, column: str) -> DataFrame:
        both = [materialize(getattr(a, name).transform(vectors).select(*ROW_ID, column)) for a in (artifacts, loaded)]
        return _differing(*both).select(F.lit(name).alias("name"), "n", "differing")

    parts = together(lambda: compared("resale", "model_resale"), lambda: compared("band", "band_proba"),
                     lambda: compared("profit", "profit_p"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def log_content(spark, d):
    """The prediction log read back: what was logged for each listing."""
    evaluated = core_columns(_evaluated(spark, d))
    path = _folder(spark, "log")
    records = prediction_log(evaluated, ROW_ID, {"m1_resale": "surrogate"})
    append_log(records, path)
    return spark.read.schema(records.schema).json(path).select("vehicle.*", "result.*")


@query
def log_roundtrip(spark, d):
    evaluated = core_columns(_evaluated(spark, d))
    path = f"{checkpoint_root(spark)}/log-{uuid.uuid4().hex}"
    records = prediction_log(evaluated, ROW_ID, {"m1_resale": "surrogate"})
    append_log(records, path)
    back = spark.read.schema(records.schema).json(path)
    return back.select("vehicle.*", "result.recommendation", "result.roi",
                       F.element_at("model_versions", "m1_resale").alias("m1"),
                       F.col("ts").isNotNull().alias("stamped"))
