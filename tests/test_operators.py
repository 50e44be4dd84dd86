"""Operators on small frames: brute-force checks, invariants and skewed keys."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise import config
from lotwise.operators import benchmarks, clean, features, lookup, metrics, options, quantiles, ranking, split
from lotwise.session import materialize


def test_quantiles_match_numpy_with_a_hot_key(spark):
    rng = random.Random(1)
    rows = [("hot", round(rng.lognormvariate(9, 1), 2)) for _ in range(3000)]
    rows += [("flat", 7.0)] * 500 + [(f"k{i % 50}", rng.uniform(-5, 5)) for i in range(500)]
    rows += [("hot", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {r["k"]: r for r in quantiles.exact_quantiles(df, ["k"], "v", probs).collect()}
    by_key = {}
    for k, v in rows:
        if v is not None:
            by_key.setdefault(k, []).append(v)
    assert set(got) == set(by_key)
    for k, values in by_key.items():
        assert got[k]["n"] == len(values)
        want = np.percentile(values, [100 * p for p in probs])
        assert [got[k][f"q{i}"] for i in range(5)] == pytest.approx(list(want), rel=1e-12)


def test_order_key_sorts_like_doubles(spark):
    rng = np.random.default_rng(3)
    bits = rng.integers(-(1 << 63), (1 << 63) - 1, 4000).view(np.float64)
    edges = [float(2.0**e) for e in range(-1074, 1024, 7)] + [np.nextafter(2.0**e, d) for e in range(-1070, 1024, 13) for d in (0, np.inf)]
    values = sorted({*(float(x) for x in bits if np.isfinite(x)), *map(float, edges), *(-float(x) for x in edges), 0.0, 0.1, 1 / 3, float("inf"), -float("inf")})
    df = spark.createDataFrame([(v,) for v in [*values, -0.0, float("nan")]], "v double")
    got = {r[0]: r[1] for r in df.select("v", quantiles.order_key(F.col("v"))).collect() if r[0] == r[0]}
    keys = [got[v] for v in values]
    assert keys == sorted(set(keys))
    assert all(got[v] == int(np.float64(abs(v)).view(np.int64)) * (-1 if v < 0 else 1) for v in values)
    nan = df.where("isnan(v)").select(quantiles.order_key(F.col("v"))).first()[0]
    assert nan > keys[-1]


@pytest.mark.parametrize("spread", ["narrow", "wide", "signs", "ties"])
def test_radix_selection(spark, monkeypatch, spread):
    """Large groups by radix, small ones beside them; all values in [0, 0.003] are told apart."""
    monkeypatch.setattr(quantiles, "PLAIN_CELLS", 50)
    rng = np.random.default_rng(8)
    x = {"narrow": rng.random(6000) * 0.003, "wide": 10.0 ** rng.uniform(-300, 300, 6000),
         "signs": rng.normal(size=6000), "ties": rng.integers(-40, 40, 6000) / 7}[spread]
    keys = np.where(rng.random(6000) < 0.9, "hot", rng.integers(0, 30, 6000).astype(str))
    df = spark.createDataFrame(list(zip(keys.tolist(), x.tolist())), "k string, v double").repartition(6)
    probs = [0, 0.1, 0.5, 0.77, 1]
    got = {r["k"]: r for r in quantiles.exact_quantiles(df, ["k"], "v", probs).collect()}
    assert set(got) == set(keys)
    for k, r in got.items():
        mine = np.sort(x[keys == k])
        assert r["n"] == len(mine)
        for i, p in enumerate(probs):
            at = p * (len(mine) - 1)
            lo, hi = mine[int(np.floor(at))], mine[int(np.ceil(at))]
            expected = lo if lo == hi else (np.ceil(at) - at) * lo + (at - np.floor(at)) * hi
            assert r[f"q{i}"] == pytest.approx(expected, rel=1e-12), (k, p)
    whole = quantiles.exact_quantiles(df, [], "v", [0.5]).collect()
    assert len(whole) == 1 and whole[0]["q0"] == pytest.approx(float(np.median(x)), rel=1e-12)


def test_quantiles_combine_before_they_shuffle(spark, monkeypatch, capsys):
    monkeypatch.setattr(quantiles, "PLAIN_CELLS", 50)
    df = spark.range(5000).select((F.col("id") % 2).alias("k"), (F.col("id") / 7).alias("v"))
    quantiles.exact_quantiles(df, ["k"], "v", [0.5]).explain()
    plan = capsys.readouterr().out
    assert "REPARTITION" not in plan and "partial_sum" in plan and "partial_percentile" in plan


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "v double")
    row = quantiles.exact_quantiles(empty, [], "v", [0.5]).collect()
    assert len(row) == 1 and row[0]["q0"] is None
    bench = benchmarks.market_benchmark(
        spark.createDataFrame([], "make string, model string, year int, mmr double"))
    out = spark.range(1).select(benchmarks.global_value(bench).alias("v")).first()
    assert out["v"] == 0.0


def _bench(spark):
    return materialize(benchmarks.market_benchmark(spark.createDataFrame(
        [("kia", "sorento", 2015, 20000.0), ("kia", "sorento", 2015, 21000.0),
         ("ford", "f-150", 2013, 15000.0)],
        "make string, model string, year int, mmr double")))


ASKED = [("Kia", "Sorento", 2015), ("KIA ", "sorento", 1999), ("Ford", "Unknown Model", 1999),
         ("tesla", "3", 2015), (None, None, None)]
FOUND = [(20500.0, "make/model/year", 2), (20500.0, "make/model", 2), (15000.0, "make", 1),
         (20000.0, "global", 3), (20000.0, "global", 3)]


@pytest.mark.parametrize("broadcast_bytes, hot_share", [(500_000, 1), (0, 1), (0, 10)])
def test_lookup_levels_on_every_join_path(spark, monkeypatch, broadcast_bytes, hot_share):
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", broadcast_bytes)
    monkeypatch.setattr(lookup, "HOT_SHARE", hot_share)
    bench = _bench(spark)
    rows = [(i, *ASKED[i % 5]) for i in range(20)]
    rows += [(100 + i, *ASKED[0]) for i in range(40)]  # a hot key
    df = spark.createDataFrame(rows, "id int, make string, model string, year int")
    keys = benchmarks.market_keys(F.col("make"), F.col("model"), F.col("year"))
    out = lookup.keyed_lookup(df, keys, lambda k: benchmarks.lookup_market(k, bench))
    got = {r["id"]: (r["lookup_value"], r["lookup_level"], r["lookup_n"]) for r in out.collect()}
    assert len(got) == out.count() == 60
    assert all(got[i] == FOUND[i % 5 if i < 100 else 0] for i in got)


def test_retail_proxy_needs_more_than_a_thousand_rows(spark):
    def overall(retail_rows):
        df = spark.range(retail_rows).select(F.lit("retail").alias("source_channel"),
                                             F.lit(100.0).alias("price"))
        df = df.unionByName(spark.range(3000).select(F.lit("wholesale").alias("source_channel"),
                                                     F.lit(50.0).alias("price")))
        df = df.select("*", F.lit("a").alias("make"), F.lit("b").alias("model"), F.lit(1).alias("year"))
        return benchmarks.market_benchmark(df).where("level = 'global'").first()["n"]

    assert overall(1000) == 4000
    assert overall(1001) == 1001


def test_days_benchmark(spark):
    rows = [(" Kia", 2, "50", 1), ("kia", 2, "70", 2), ("kia", 1, "10", 3), ("Make", 2, "9", 4),
            ("Industry", 2, "9", 5), ("bmw", 2, "x", 6), ("audi", 2, "95", 7), (None, 2, "1", 8)]
    dts = materialize(benchmarks.latest_days(spark.createDataFrame(
        rows, "make string, month int, days string, position int")))
    assert {r["make"]: r["days"] for r in dts.collect()} == {"kia": 70.0, "audi": 95.0}
    keys = spark.createDataFrame([("kia",), ("zzz",), ("",)], "make string")
    got = {r["make"]: r["make_band"] for r in
           benchmarks.with_band(benchmarks.lookup_days(keys, dts)).collect()}
    assert got == {"kia": "Moderate", "zzz": "Moderate", "": "Moderate"}  # median 82.5
    with pytest.raises(ValueError):
        benchmarks.require_rows(dts.where("false"), "empty")


def test_comparables_state_choice(spark):
    rows = [("kia", "rio", 2015, "ca", 10.0, 5.0), ("kia", "rio", 2015, "ca", 20.0, -1.0),
            ("kia", "rio", 2015, "tx", 0.0, 7.0), ("kia", "rio", 2015, "ny", 60.0, None)]
    live = materialize(benchmarks.comparables(spark.createDataFrame(
        rows, "make string, model string, year int, state string, price double, dom double")))
    keys = spark.createDataFrame([("kia", "rio", 2015, s) for s in ("ca", "tx", "")],
                                 "make string, model string, year int, state string")
    got = {r["state"]: (r["live_value"], r["live_days"], r["live_n"]) for r in
           benchmarks.lookup_live(keys, live).collect()}
    assert got == {"ca": (15.0, 5.0, 2), "tx": (None, None, None), "": (20.0, 6.0, 4)}


def test_dedup_keeps_first(spark):
    rows = [(i, "a" if i % 3 else "b", float(i % 4), f"v{i}") for i in range(100)]
    df = spark.createDataFrame(rows, "pos int, k string, x double, v string")
    got = {(r["k"], r["x"]): r["v"] for r in clean.dedup_first(df, ["k", "x"], ["pos"]).collect()}
    want = {}
    for pos, k, x, v in rows:
        want.setdefault((k, x), v)
    assert got == want


def test_split_is_disjoint_whole_and_repeatable(spark):
    df = spark.range(5000).withColumn("year", (2015 + F.col("id") % 10).cast("int"))
    first = {r["id"]: r["split"] for r in split.with_split(df, ["id"]).collect()}
    again = {r["id"]: r["split"] for r in split.with_split(df.repartition(3), ["id"]).collect()}
    assert first == again and len(first) == 5000
    share = statistics.mean(s == "test" for s in first.values())
    assert 0.17 < share < 0.23
    recent = split.with_recent_holdout(df, ["id"]).where("split = 'recent'")
    assert recent.agg(F.min("year")).first()[0] >= 2020
    assert 800 < recent.count() < 1200


@pytest.mark.parametrize("n", [0, 1, 700, 5000, 9000])
def test_sample_is_exact(spark, n):
    df = spark.range(5000)
    got = {r["id"] for r in split.sample_rows(df, ["id"], n).collect()}
    assert len(got) == min(n, 5000)
    bigger = {r["id"] for r in split.sample_rows(df, ["id"], n + 50).collect()}
    assert got <= bigger


def test_features(spark):
    df = spark.createDataFrame(
        [(2016, 0.0, 30.0, "Kia ", 100.0), (2015, 100000.0, None, None, None)],
        "year int, mileage double, condition double, make string, market_value double")
    rows = features.build_features(df).collect()
    assert features.build_features(df).columns == config.FEATURE_COLUMNS
    assert [r["vehicle_age"] for r in rows] == [0.0, 1.0]
    assert rows[1]["mileage_per_year"] == 100000.0
    assert [r["make"] for r in rows] == ["kia", "unknown"] and rows[0]["color"] == "unknown"
    filled = features.build_features(df, parity=True).collect()
    assert filled[1]["market_value"] == 100.0 and filled[1]["condition"] is None
    with pytest.raises(ValueError):
        features.assert_no_leakage(["make", "price"])


@pytest.mark.parametrize("broadcast_bytes, hot_share", [(500_000, 1), (0, 1), (0, 2)])
def test_encoder(spark, monkeypatch, broadcast_bytes, hot_share):
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", broadcast_bytes)
    monkeypatch.setattr(lookup, "HOT_SHARE", hot_share)
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "make string")
    known = features.build_features(df)
    encoder = materialize(features.fit_encoder(known))
    asked = features.build_features(spark.createDataFrame([("c",), ("zz",), ("a",)], "make string"))
    got = sorted(r["make"] for r in features.encode(asked, encoder).collect())
    assert got == [-1.0, 0.0, 2.0]


@pytest.mark.parametrize("broadcast_bytes, hot_share", [(96 << 20, 1000), (0, 1000), (0, 3)])
def test_encoder_with_mostly_unseen_values(spark, monkeypatch, broadcast_bytes, hot_share):
    """More than half of the rows hold values the dictionary doesn't, many of them one hot value."""
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", broadcast_bytes)
    monkeypatch.setattr(lookup, "HOT_SHARE", hot_share)
    known = features.build_features(spark.createDataFrame(
        [(f"m{i}", f"x{i % 7}", f"s{i % 3}") for i in range(40)], "make string, model string, state string"))
    encoder = materialize(features.fit_encoder(known))
    rows = [(i, "new" if i % 2 else f"m{i % 60}", f"y{i}" if i % 3 else f"x{i % 9}", f"s{i % 5}") for i in range(600)]
    asked = features.build_features(spark.createDataFrame(rows, "id long, make string, model string, state string"), keep=["id"])
    got = features.encode(asked, encoder)
    assert got.columns == asked.columns
    order = {"make": sorted({f"m{i}" for i in range(40)}), "model": sorted({f"x{i}" for i in range(7)}),
             "state": sorted({f"s{i}" for i in range(3)})}
    index = lambda c, v: float(order[c].index(v)) if v in order[c] else -1.0
    expected = sorted((i, index("make", a), index("model", b), index("state", c), 0.0) for i, a, b, c in rows)
    assert sorted((r["id"], r["make"], r["model"], r["state"], r["color"]) for r in got.collect()) == expected
    assert sum(e[1] < 0 for e in expected) > 300


def test_broadcast_size_is_measured_in_bytes(spark):
    table = spark.createDataFrame([("a" * 1000, 1.0, ("b" * 500, 2))], "k string, v double, s struct<x:string,y:int>")
    assert 1500 < lookup.table_bytes(table) < 1700
    assert lookup.table_bytes(table.limit(0)) == 0


def _curve_rows(seed, n=400):
    rng = random.Random(seed)
    rows = [(int(rng.random() < 0.6), round(rng.random(), 2)) for _ in range(n)]
    return [(y, min(1.0, s + 0.2 * y)) for y, s in rows]


def test_binary_metrics_match_brute_force(spark):
    rows = _curve_rows(3)
    df = spark.createDataFrame(rows, "y int, s double")
    got = metrics.binary_metrics(df, "y", "s", 0.6).first()
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert got["roc_auc"] == pytest.approx(auc)
    ap, seen = 0.0, 0.0
    best = (0.0, 0.0)
    for cut in sorted({s for _, s in rows}, reverse=True):
        tp, fp = sum(s >= cut for s in pos), sum(s >= cut for s in neg)
        ap += (tp / len(pos) - seen) * tp / (tp + fp)
        seen = tp / len(pos)
        precision = tp / (tp + fp)
        f1 = 2 * precision * seen / (precision + seen + 1e-12)
        if f1 >= best[0]:
            best = (f1, cut)
    assert got["auc_pr"] == pytest.approx(ap)
    assert got["brier"] == pytest.approx(statistics.mean((s - y) ** 2 for y, s in rows))
    assert got["accuracy"] == pytest.approx(statistics.mean((s >= 0.6) == bool(y) for y, s in rows))
    assert metrics.choose_threshold(df, "y", "s").first()["threshold"] == best[1]


def test_perfect_and_single_class_scores(spark):
    perfect = spark.createDataFrame([(0, 0.1), (0, 0.2), (1, 0.8), (1, 0.9)], "y int, s double")
    assert metrics.binary_metrics(perfect, "y", "s").first()["roc_auc"] == 1.0
    single = spark.createDataFrame([(1, 0.1), (1, 0.2)], "y int, s double")
    row = metrics.binary_metrics(single, "y", "s").first()
    assert np.isnan(row["roc_auc"]) and np.isnan(row["brier"]) and row["positive_rate"] == 1.0
    assert metrics.choose_threshold(single, "y", "s").first()["threshold"] == 0.5


def test_psi(spark):
    rng = np.random.default_rng(0)
    old, new = rng.normal(0, 1, 2000).round(2), rng.normal(0.5, 1.2, 1500).round(2)
    frame = lambda a: spark.createDataFrame([(float(v),) for v in a], "v double")
    edges = np.unique(np.percentile(old, np.linspace(0, 100, 11)))
    e = np.clip(np.histogram(old, edges)[0] / len(old), 1e-6, None)
    a = np.clip(np.histogram(new, edges)[0] / len(new), 1e-6, None)
    want = float(np.sum((a - e) * np.log(a / e)))
    assert metrics.population_stability(frame(old), frame(new), "v").first()["psi"] == pytest.approx(want)
    assert metrics.population_stability(frame(old), frame(old), "v").first()["psi"] == 0.0
    assert metrics.population_stability(frame([1.0] * 9), frame(new), "v").first()["psi"] == 0.0


def test_regression_gate_and_fairness(spark):
    rows = [("ca", 100.0, 90.0, 80.0)] * 30 + [("tx", 50.0, 45.0, 40.0)] * 40 + [("ny", 9.0, 1.0, 1.0)] * 29
    df = spark.createDataFrame(rows, "state string, y double, p double, b double")
    errors = metrics.state_mae(df, "y", "p")
    assert [(r["state"], r["mae"]) for r in errors.collect()] == [("ca", 10.0), ("tx", 5.0)]
    gap = metrics.state_gap(errors).first()
    assert (gap["best_state"], gap["worst_state"], gap["gap"], gap["gap_ratio"]) == ("tx", "ca", 5.0, 2.0)
    assert metrics.state_gap(errors, min_states=3).first()["gap"] is None
    assert metrics.regression_metrics(df, "y", "p", "b").first()["beats_mmr_baseline"] is True
    gates = spark.range(1).select(metrics.gate(F.lit(96.0), F.lit(100.0)).alias("a"),
                                  metrics.gate(F.lit(95.0), F.lit(100.0)).alias("b"),
                                  metrics.gate(F.lit(0.0), F.lit(0.0)).alias("c")).first()
    assert list(gates) == [False, True, False]


def test_multiclass(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "d")], "y string, p string")
    row = metrics.classification_metrics(df, "y", "p").first()
    assert row["accuracy"] == 0.5
    assert row["macro_f1"] == pytest.approx((2 / 3 + 2 / 3) / 4)


def test_global_rank(spark):
    df = spark.range(1000).select(((F.col("id") * 37) % 11).alias("x"), F.col("id").alias("row"))
    ranked = ranking.with_global_rank(df, [F.desc("x"), F.asc("row")]).collect()
    want = sorted(((r["x"], r["row"]) for r in ranked), key=lambda t: (-t[0], t[1]))
    by_rank = {r["rank"]: (r["x"], r["row"]) for r in ranked}
    assert [by_rank[i + 1] for i in range(1000)] == want


def test_options(spark):
    rows = [("kia", "rio", "unknown", "red", "ca", 2010)] * 3 + [("bmw", "x5", "suv", "", "tx", 2015)]
    df = spark.createDataFrame(rows, "make string, model string, body string, color string, state string, year int")
    row = options.options_row(df).first()
    assert row["makes"] == ["bmw", "kia"] and row["bodies"] == ["suv"] and row["colors"] == ["red"]
    assert (row["year_min"], row["year_max"]) == (2010, 2015)
    assert row["transmissions"] == ["automatic", "manual"]


@pytest.mark.parametrize("score", [None, -0.1, 1.5, float("nan")])
def test_scores_outside_the_contract_are_an_error(spark, score):
    df = spark.createDataFrame([(1, 0.5), (0, score)], "label int, score double")
    with pytest.raises(Exception, match="outside"):
        metrics.score_curve(df, "label", "score").collect()


def test_sketches_merge_up_and_over_days(spark):
    """Coarser grains and further days come from merging; ranks stay within twice the stated error."""
    rng = np.random.default_rng(2)
    n = 30_000
    rows = [(f"m{i % 3}", f"x{i % 40}", 2000 + i % 5, float(v)) for i, v in enumerate(rng.lognormal(9, 1, n))]
    rows += [("rare", "one", 2001, 5.0), ("rare", "one", 2001, None), (None, "one", 2001, 7.0)]
    df = spark.createDataFrame(rows, "make string, model string, year int, mmr double").repartition(5)
    sketches = materialize(benchmarks.market_sketches(df))
    exact = {(r["level"], r["make"], r["model"], r["year"]): r for r in benchmarks.market_benchmark(df).collect()}
    near = {(r["level"], r["make"], r["model"], r["year"]): r for r in benchmarks.approximate_benchmark(sketches).collect()}
    assert set(near) == set(exact) and all(near[k]["n"] == exact[k]["n"] for k in exact)
    assert near["make/model/year", "rare", "one", 2001]["value"] == 5.0
    errors = [r["error"] for r in benchmarks.measured_rank_error(df, sketches).collect()]
    assert len(errors) == len(exact) and max(errors) <= 2 * benchmarks.sketch_rank_error()
    days = [materialize(benchmarks.market_sketches(df.where(F.pmod(F.hash("mmr"), F.lit(2)) == d))) for d in (0, 1)]
    both = materialize(benchmarks.merged_sketches(days[0].unionByName(days[1])))
    assert max(r["error"] for r in benchmarks.measured_rank_error(df, both).collect()) <= 2 * benchmarks.sketch_rank_error()
    assert {r["n"] for r in benchmarks.approximate_benchmark(both).where("level = 'global'").collect()} == {n + 1}
    # the overall group's values differ, but not by more than the error allows
    ranked = np.sort([v for *_, v in rows if v is not None])
    at = np.searchsorted(ranked, near["global", None, None, None]["value"]) / len(ranked)
    assert abs(at - 0.5) <= 2 * benchmarks.sketch_rank_error() + 1e-3
