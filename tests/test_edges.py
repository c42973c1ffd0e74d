"""Hand-made panels: short histories, missing and infinite values, ties, odd dates."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from rowtide import FeatureOptions, PanelSpec, families_by_prefix
from rowtide.operators import blocks
from rowtide.operators.columns import drop_matching, fill_missing, narrow, require_parity
from rowtide.operators.encode import apply_one_hot, fit_one_hot
from rowtide.operators.foldscale import fit_gauss_rank_folds, gauss_rank_folds
from rowtide.operators.metric import metric_components
from rowtide.operators.positions import pivot_positions, with_ordinals, with_time_ranks
from rowtide.operators.scale import fit_gauss_rank, fit_standard, gauss_rank, gauss_rank_inverse, standard_scale
from rowtide.plans.feature_row import attach, feature_row
from rowtide.session import materialise
from rowtide.sources.panel import read_panel, unify_missing, with_time

SPEC = PanelSpec(
    "k", ("day", "id"), ("S_1", "P_1"), ("code",), {"spend": ("S_1",), "payment": ("P_1",)}
)
SCHEMA = "k string, day timestamp_ntz, id long, S_1 double, P_1 double, code int"
NAN, INF = float("nan"), float("inf")


def day(text):
    return dt.datetime.fromisoformat(text)


def panel(spark):
    rows = [
        ("one", day("2024-12-30"), 1, 2.0, 0.0, 1),
        ("two", day("2024-12-29"), 1, 1.0, 4.0, 1),
        ("two", day("2024-12-30"), 2, None, 0.0, 2),
        ("gap", day("2024-01-01"), 1, None, 1.0, None),
        ("gap", day("2024-01-02"), 2, 5.0, 2.0, 3),
        ("gap", day("2024-01-03"), 3, 7.0, 3.0, 3),
        ("gap", day("2024-01-04"), 4, None, NAN, None),
        ("nul", day("2024-02-01"), 1, None, None, None),
        ("tie", day("2024-03-01"), 2, 20.0, 1.0, 5),
        ("tie", day("2024-03-01"), 1, 10.0, 1.0, 4),
        ("tie", day("2024-03-02"), 3, INF, -INF, 4),
    ]
    return unify_missing(spark.createDataFrame(rows, SCHEMA))


def by_key(df):
    return {r["k"]: r.asDict() for r in df.collect()}


def test_feature_row_edges(spark):
    options = FeatureOptions.for_trees(
        SPEC,
        narrow=False,
        range_lag_families=("spend",),
        fixed_ratios=(("r", "S_1", "P_1"),),
        family_nets=(("P-S", "payment", "spend"),),
        keep_sums=True,
    )
    got = by_key(feature_row(panel(spark), SPEC, options))
    assert got["one"]["S_1_std"] == -1 and got["one"]["S_1_diff1"] == -1
    assert got["one"]["S_1_mid"] == 2.0 and got["one"]["S_1_mid_gt2"] == -1
    assert got["one"]["r"] == -1  # zero denominator
    assert got["two"]["S_1"] == -1 and got["two"]["S_1_first"] == 1.0
    assert got["two"]["S_1_last_lag_sub"] == 0.0
    assert got["two"]["P_1_diff1"] == -4.0 and got["two"]["P_1_diff2"] == -1
    assert got["two"]["day_Sun_Count"] == 1 and got["one"]["day_Sun_Count"] == -1
    assert got["two"]["day_wk_std"] == pytest.approx(math.sqrt((52 - 1) ** 2 / 2))
    assert got["gap"]["S_1_first"] == 5.0 and got["gap"]["S_1_mean"] == 6.0
    assert got["gap"]["P_1"] == -1 and got["gap"]["P_1_max"] == 3.0
    assert got["gap"]["S_1_mid"] == 7.0 and got["gap"]["S_1_mid_gt2"] == 7.0
    assert got["gap"]["code_nunique"] == 1 and got["gap"]["code_count"] == 2
    assert got["nul"]["S_1_sum"] == 0.0 and got["nul"]["S_1_min"] == -1 and got["nul"]["code_nunique"] == 0
    assert got["tie"]["S_1_first"] == 10.0 and got["tie"]["code_first"] == 4
    assert got["tie"]["S_1"] == -1 and got["tie"]["S_1_max"] == -1  # infinite values are filled


def test_early_fill_changes_ratios(spark):
    base = FeatureOptions(first=False, last_lag=False, calendar=False, category_stats=False)
    late = by_key(feature_row(panel(spark), SPEC, base))
    early = by_key(feature_row(panel(spark), SPEC, base.with_(impute="early")))
    assert late["gap"]["S_1-mean"] == -1 and early["gap"]["S_1-mean"] == -7.0


def test_row_order_and_partitions_do_not_matter(spark):
    options = FeatureOptions.for_trees(SPEC)
    df = panel(spark)
    want = by_key(feature_row(df, SPEC, options))
    for parts in (1, 4, 17):
        shuffled = df.orderBy(F.rand(parts)).repartition(parts)
        assert by_key(feature_row(shuffled, SPEC, options)) == want


def test_split_entities_give_the_same_row(spark, conf):
    options = FeatureOptions.for_trees(SPEC, mean_abs_dev=("S_1",), kurtosis=("P_1",), positions=3)
    rows = spark.range(400).select(
        F.when(F.col("id") < 200, "hot").otherwise((F.col("id") % 20).cast("string")).alias("k"),
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(cast(id % 37 as int))").alias("day"),
        "id",
        (F.col("id") % 13 * 1.5).alias("S_1"),
        F.when(F.col("id") % 4 > 0, F.col("id") % 7 * 1.0).alias("P_1"),
        (F.col("id") % 6).cast("int").alias("code"),
    )
    want = by_key(feature_row(rows, SPEC, options))
    conf("spark.rowtide.rowsPerChunk", 33)
    got = by_key(feature_row(rows, SPEC, options))
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k])


def test_duplicate_output_names_are_refused(spark):
    with pytest.raises(ValueError, match="duplicate"):
        blocks.merge(blocks.means(["a"]), blocks.means(["a"]))
    features = feature_row(panel(spark), SPEC, FeatureOptions())
    with pytest.raises(ValueError, match="duplicate"):
        attach(features, features, "k")


def test_time_ranks_with_ties(spark):
    got = {
        (r["k"], r["id"]): (r["time_rank"], r["statement"], r["cumcount"])
        for r in with_time_ranks(panel(spark), SPEC).collect()
    }
    assert got["tie", 1] == (1.5, 1, 0) and got["tie", 2] == (1.5, 1, 1) and got["tie", 3] == (3.0, 0, 0)
    assert got["gap", 1] == (1.0, 3, 0)


def test_pivot_covers_the_longest_history(spark):
    got = by_key(pivot_positions(panel(spark), SPEC, ["P_1"]))
    assert [c for c in got["gap"] if "__TE" in c] == [f"P_1__TE{j}" for j in range(4)]
    assert [got["gap"][f"P_1__TE{j}"] for j in range(4)] == [None, 3.0, 2.0, 1.0]
    assert got["one"]["P_1__TE1"] is None
    wide = feature_row(panel(spark), SPEC, FeatureOptions(positions=2))
    assert by_key(wide)["gap"]["code__TE1"] == 3 and by_key(wide)["one"]["code__TE1"] == -1


def test_text_categories_are_counted_exactly(spark):
    df = spark.createDataFrame(
        [("a", 1, "x'y"), ("a", 2, "z"), ("a", 3, "z"), ("b", 1, None), ("c", 1, "\\q")],
        "k string, t int, c string",
    )
    spec = PanelSpec("k", ("t",), (), ("c",))
    stats = blocks.categories(
        ["c"], FeatureOptions(stats=()), blocks.category_codes(df, ["c"]), dict(df.dtypes)
    )
    got = by_key(blocks.aggregate(with_ordinals(df, spec), "k", stats))
    assert [got[k]["c_nunique"] for k in "abc"] == [2, 0, 1]
    assert got["a"]["c_first"] == "x'y"


def test_many_codes_fall_back(spark, monkeypatch):
    monkeypatch.setattr(blocks, "MAX_CODES", 100)
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id", (F.col("id") % 300).alias("c"))
    assert blocks.category_codes(df, ["c"]) == {}
    spec = PanelSpec("k", ("id",), (), ("c",))
    stats = blocks.categories(["c"], FeatureOptions(), {}, {})
    got = by_key(blocks.aggregate(with_ordinals(df, spec), "k", stats))
    assert got[0]["c_nunique"] == 150
    words = blocks.categories(["c"], FeatureOptions(), {"c": range(0, 300)}, {"c": "bigint"})
    assert by_key(blocks.aggregate(with_ordinals(df, spec), "k", words))[1]["c_nunique"] == 150


def test_one_hot_unknown_and_single_category(spark):
    fit = spark.createDataFrame([(10, "x"), (9, "x"), (None, "x")], "a int, b string")
    cats = fit_one_hot(fit, ["a", "b"])
    seen = {(r["column"], r["value"]): r["position"] for r in cats.collect()}
    assert seen == {("a", "9"): 0, ("a", "10"): 1, ("b", "x"): 0}
    new = spark.createDataFrame([(10, "x"), (9, "y"), (77, None), (None, "x")], "a int, b string")
    out = apply_one_hot(new, cats, ["a", "b"])
    assert out.columns == ["a_10"]
    assert [r[0] for r in out.collect()] == [1, 0, 0, 0]


def test_gauss_rank_edges(spark, conf):
    df = spark.createDataFrame([(i, float(i * i), 3.0) for i in range(50)], "id long, x double, flat double")
    knots = fit_gauss_rank(df, ["x", "flat"])
    new = spark.createDataFrame([(1, -9.0, 3.0), (2, 9e9, 1.0), (3, None, 2.0), (4, 30.5, 3.0)], df.schema)
    ways = []
    for rows in (1000, 3):
        conf("spark.rowtide.broadcastRows", rows)
        out = gauss_rank(new, knots, ["x", "flat"], ["id"]).orderBy("id").collect()
        back = gauss_rank_inverse(gauss_rank(new, knots, ["x"], ["id"]), knots, ["x"], ["id"])
        ways.append(([r["x"] for r in out], [r["x"] for r in back.orderBy("id").collect()]))
        assert all(r["flat"] is None for r in out)
    for scaled, restored in ways:
        assert scaled[0] == pytest.approx(-scaled[1]) and scaled[2] is None
        assert restored[3] == pytest.approx(30.5) and restored[0] == pytest.approx(0.0, abs=1e-6)
    assert ways[0][0] == pytest.approx(ways[1][0])


def test_standard_scale_of_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    rows = standard_scale(df, fit_standard(df, ["a", "b"]), ["a", "b"]).collect()
    assert sorted(r["a"] for r in rows) == [-1.0, 1.0] and {r["b"] for r in rows} == {0.0}


def scored(spark, pairs):
    rows = [(i, t, float(s)) for i, (t, s) in enumerate(pairs)]
    return spark.createDataFrame(rows, "id long, target int, score double")


def test_metric_bounds(spark):
    truth = [1] * 30 + [0] * 70
    perfect = metric_components(scored(spark, [(t, t) for t in truth]), "target", "score", "id").first()
    assert perfect["gini"] == pytest.approx(1.0)
    wrong = metric_components(scored(spark, [(t, -t) for t in truth]), "target", "score", "id").first()
    assert wrong["gini"] < 0 and wrong["top_capture"] == 0
    one_class = metric_components(scored(spark, [(0, 1), (0, 2)]), "target", "score", "id").first()
    assert one_class["gini"] is None and one_class["score"] is None


def test_closed_form_equals_sorted_form(spark):
    truth = [1, 0, 0, 1, 1, 0, 1, 0, 0, 0, 1]
    row = metric_components(scored(spark, [(t, t) for t in truth]), "target", "score", "id").first()
    assert row["gini_raw"] == pytest.approx(row["gini_perfect"])


def test_narrow_loses_no_value(spark):
    rows = [(2**40, 3_000_000_000, 1e300, 1.5, "a"), (5, -7, None, NAN, None), (None, 2, float("inf"), float("-inf"), "c")]
    df = spark.createDataFrame(rows, "big long, over long, wide double, small double, s string")
    got = narrow(df.withColumn("fits", F.col("over") % 10))
    assert dict(got.dtypes) == {
        "big": "bigint", "over": "bigint", "wide": "double", "small": "float", "s": "string", "fits": "int"
    }
    assert [tuple(r)[:3] for r in got.collect()] == [r[:3] for r in rows]
    filled = fill_missing(df.withColumn("d", F.expr("CAST(NULL AS decimal(9,2))"))).collect()
    assert filled[2]["big"] == -1 and filled[0]["wide"] == 1e300 and filled[2]["wide"] == -1.0 and filled[0]["d"] == -1


def test_one_hot_names_may_not_collide(spark):
    df = spark.createDataFrame([(1, "x", "b_c"), (2, "c", "x")], "id int, a_b string, a string")
    rows = [("a_b", "c", 1), ("a", "b_c", 1)]
    categories = spark.createDataFrame(rows, "column string, value string, position int")
    with pytest.raises(ValueError, match="a_b_c"):
        apply_one_hot(df, categories, ["a_b", "a"])


def test_parity_and_drops(spark):
    a = spark.createDataFrame([(1, 2.0)], "x int, y double")
    require_parity(a, a)
    with pytest.raises(ValueError, match="order"):
        require_parity(a, a.select("y", "x"))
    with pytest.raises(ValueError, match="only left: y"):
        require_parity(a, a.select("x"))
    assert drop_matching(a, ["^y$"]).columns == ["x"]


def test_panel_scan(spark, tmp_path):
    path = str(tmp_path / "panel")
    spark.createDataFrame(
        [("a", "2024-05-05", 1, NAN, 1.0, 2), ("a", "bad", 2, 1.0, 1.0, 2)],
        "k string, day string, id long, S_1 double, unused double, code int",
    ).write.parquet(path)
    spec = PanelSpec.from_columns(["k", "day", "id", "S_1", "code"], "k", ["day", "id"], ["code"])
    assert spec.numeric == ("S_1",)
    df = read_panel(spark, path, spec, drop=["unused"])
    rows = {r["id"]: r for r in df.collect()}
    assert rows[1]["day"] == day("2024-05-05") and rows[2]["day"] is None and rows[1]["S_1"] is None
    assert read_panel(spark, path, columns=["k"], rows=1).count() == 1
    assert with_time(df, "day").schema == df.schema


def test_families_by_prefix():
    cols = ["S_1", "S_2", "B_1", "B_9"]
    assert families_by_prefix(cols, {"spend": "S_", "balance": "B_"}, exclude=["S_2"]) == {
        "spend": ("S_1",),
        "balance": ("B_1", "B_9"),
    }


def test_scalers_of_all_folds_are_those_of_each(spark, conf):
    rng = random.Random(5)
    odd = [None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0]
    made = [(i, i % 3, rng.choice([*odd, *[rng.gauss(0, 9) for _ in range(20)]]), rng.choice([1.0, 2.0, 5.0]), 4.0) for i in range(300)]
    kind = "id int, fold int, a double, `b c` double, flat double"
    df = spark.createDataFrame(made, kind)
    new = spark.createDataFrame([(i, i % 3, x, x, x) for i, x in enumerate([*odd, -1e300, -99.0, 99.0, 1e300, 1.5, 2.0, -3.25])], kind)
    columns, renamed = ["a", "bc", "flat"], {"b c": "bc"}
    df, new = df.withColumnsRenamed(renamed), new.withColumnsRenamed(renamed)
    for rows in (1_000_000, 40):
        conf("spark.rowtide.rowsPerChunk", rows)
        fitted = materialise(fit_gauss_rank_folds(df, columns), "fitted")
        for asked, same in ((df, True), (df, False), (new, False)):
            all_ = {r["id"]: r for r in gauss_rank_folds(asked, fitted, columns, ["id"], range(3), ["fold"], fitted_on_these=same).collect()}
            own = {r["id"]: r for r in gauss_rank_folds(asked, fitted, columns, ["id"], range(3), ["fold"], own="fold").collect()}
            assert all_.keys() == own.keys() and len(own) == asked.count()
            for f in range(3):
                knots = materialise(fit_gauss_rank(df.filter(F.col("fold") != f), columns), "knots")
                for r in gauss_rank(asked, knots, columns, ["id"]).fillna(0.0, subset=columns).collect():
                    want = [r[c] for c in columns]
                    assert all_[r["id"]][f"x{f}"] == pytest.approx(want, abs=1e-9)
                    if r["fold"] == f:
                        assert own[r["id"]]["x"] == pytest.approx(want, abs=1e-9)
