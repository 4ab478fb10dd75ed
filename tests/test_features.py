import numpy as np
import pytest
from pyspark.sql import functions as F

from wardline.operators import bias as B
from wardline.operators import encoders as E
from wardline.operators.crosstab import crosstab_bias, crosstab_bias_sets
from wardline.operators.split import stratified_kfold, stratified_split


def people(spark, n=400):
    return spark.range(n).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 37) END AS k", "CAST(id * 7 % 3 AS INT) AS y")


def test_split_sizes_and_reproducibility(spark, many_partitions):
    df = spark.range(1003).selectExpr("id", "CASE WHEN id % 10 = 0 THEN 'rare' WHEN id = 1 THEN 'single' ELSE 'many' END AS c")
    out = stratified_split(df, "c", "id", 0.2, 7)
    got = {r.c: (r.n, r.t) for r in out.groupBy("c").agg(F.count("*").alias("n"), F.sum(F.col("is_test").cast("int")).alias("t")).collect()}
    assert got == {"rare": (101, 20), "single": (1, 0), "many": (901, 180)}
    again = stratified_split(df.repartition(7), "c", "id", 0.2, 7)
    assert {r.id for r in out.where("is_test").collect()} == {r.id for r in again.where("is_test").collect()}
    other = stratified_split(df, "c", "id", 0.2, 8)
    assert {r.id for r in out.where("is_test").collect()} != {r.id for r in other.where("is_test").collect()}


def test_folds_are_balanced(spark):
    out = stratified_kfold(people(spark), "y", "id", 5, 1)
    sizes = out.groupBy("y", "fold").count().collect()
    for y in range(3):
        mine = [r["count"] for r in sizes if r.y == y]
        assert len(mine) == 5 and max(mine) - min(mine) <= 1
    small = stratified_kfold(spark.range(3).selectExpr("id", "1 AS y"), "y", "id", 5, 1)
    assert len({r.fold for r in small.collect()}) == 3


def test_cv_encoding_never_uses_its_own_fold(spark):
    df = people(spark)
    folds = {r.id: r.fold for r in stratified_kfold(df, "y", "id", 5, 42).collect()}
    rows = df.collect()
    overall = np.mean([r.y for r in rows])
    for r in E.target_encode_cv(df, ["k"], "y", "id").collect():
        others = [o.y for o in rows if o.k == r.k and folds[o.id] != folds[r.id]]
        assert r.k_te == pytest.approx(np.mean(others) if others else overall)


def test_train_encoding_unseen_and_null(spark):
    train = spark.createDataFrame([("a", 0), ("a", 1), ("b", 2)], "k string, y int")
    means, overall = E.target_encode_fit(train, ["k"], "y")
    test = spark.createDataFrame([("a",), ("c",), (None,)], "k string")
    got = {r.k: r.k_te for r in E.target_encode_apply(test, means, overall, ["k"]).collect()}
    assert got == {"a": 0.5, "c": 1.0, None: 1.0}
    full = {r.k: r.k_te for r in E.target_encode_full(train, ["k"], "y").collect()}
    assert full == {"a": 0.5, "b": 2.0}


LEVELS = [(37.4, 0), (37.5, 1), (40.0, 2), (49.9, 2), (50.0, 3), (60.0, 4), (75.0, 5), (90.0, 6)]


def test_tier_levels(spark):
    df = spark.createDataFrame([(p, 100) for p, _ in LEVELS], "p double, n long")
    assert [r[0] for r in df.select(B.tier_level(F.col("p"), F.col("n"))).collect()] == [v for _, v in LEVELS]
    # Applied in the unordered sequence, the last limit passed wins.
    got = [r[0] for r in df.select(B.tier_level(F.col("p"), F.col("n"), B.UNORDERED_TIERS)).collect()]
    assert got == [0, 1, 2, 2, 4, 6, 6, 6]
    few = spark.createDataFrame([(99.0, 5), (100.0, 5), (60.0, 8), (62.5, 8)], "p double, n long")
    assert [r[0] for r in few.select(B.tier_level(F.col("p"), F.col("n"))).collect()] == [0, 6, 0, 4]


def test_bias_levels_by_hand(spark):
    data = [("a", "x", "A")] * 12 + [("a", "x", "B")] * 4 + [("a", "y", "B")] * 3 + [(None, "x", "A")] * 9
    df = spark.createDataFrame(data, "p string, q string, c string")
    table = crosstab_bias(df, ["p", "q"], "c")
    out = B.bias_levels(df, ["p", "q"], table, ["A", "B"])
    got = {(r.p, r.q): (r["{ p , q } , bias A"], r["{ p , q } , bias B"]) for r in out.collect()}
    # 75% A of 16 rows passes the line; 3 rows need 125%; null keys have no level.
    assert got == {("a", "x"): (5, 0), ("a", "y"): (0, 0), (None, "x"): (0, 0)}


def test_fit_and_apply_agree_on_training_rows(spark):
    df = spark.range(600).selectExpr("id", "CAST(id * 13 % 101 AS INT) AS len", "concat('k', id % 4) AS k", "CASE WHEN id * 13 % 101 < 40 THEN 'A' ELSE 'B' END AS c")
    groups = [B.BiasGroup("length", binned=("len",)), B.BiasGroup("pair", binned=("len",), keys=("k", "k"))]
    fitted, model = B.fit_bias_features(df, "c", groups, n_obs=15)
    assert len(model.feature_columns) == 4 and groups[1].key_columns == ["len classes", "k"]
    applied = B.apply_bias_features(df, model)
    cols = ["id", *model.feature_columns]
    want = {tuple(r) for r in fitted.select(*[F.col(f"`{c}`") for c in cols]).collect()}
    assert {tuple(r) for r in applied.select(*[F.col(f"`{c}`") for c in cols]).collect()} == want
    assert any(r[1] > 0 for r in want)


def test_unknown_and_missing_keys_score_zero(spark):
    df = spark.range(100).selectExpr("id", "id % 2 AS k", "CASE WHEN id % 2 = 0 THEN 'A' ELSE 'B' END AS c")
    _, model = B.fit_bias_features(df, "c", [B.BiasGroup("g", keys=("k",))])
    new = spark.createDataFrame([(0, 0), (1, 7), (2, None)], "id int, k int")
    out = B.apply_bias_features(new, model)
    assert [r["k , bias A"] for r in out.orderBy("id").collect()] == [6, 0, 0]
    assert {r["k , bias A"] for r in B.apply_bias_features(new.drop("k"), model).collect()} == {0}


def test_null_key_category_scores(spark):
    df = spark.createDataFrame([(None, "A")] * 20 + [("v", "B")] * 20, "k string, c string")
    out, _ = B.fit_bias_features(df, "c", [B.BiasGroup("g", keys=("k",))], null_key="nan")
    assert {(r.k, r["k , bias A"], r["k , bias B"]) for r in out.collect()} == {(None, 6, 0), ("v", 0, 6)}


def test_trained_levels_hold_for_null_keys_and_other_types(spark):
    rows = spark.range(300).selectExpr(
        "CAST(id AS INT) AS id", "CASE WHEN id % 2 = 0 THEN 'k' END AS k", "CAST(id % 3 AS INT) AS p", "CASE WHEN id % 2 = 1 THEN 'A' ELSE 'B' END AS t"
    )
    groups = [B.BiasGroup("k", keys=("k",)), B.BiasGroup("p", binned=("p",), keys=("k",))]
    fitted, model = B.fit_bias_features(rows, "t", groups, n_obs=15, null_key="none")
    names = model.feature_columns
    applied = B.apply_bias_features(rows.withColumn("p", rows["p"].cast("double")), model)
    want = {r.id: tuple(r[n] for n in names) for r in fitted.collect()}
    assert {r.id: tuple(r[n] for n in names) for r in applied.collect()} == want
    assert any(any(v) for v in want.values())


def test_crosstabs_by_grouping_sets_equal_single_crosstabs(spark):
    df = spark.range(400).selectExpr(
        "CASE WHEN id % 7 > 0 THEN concat('a', id % 7) END AS `x y`", "CAST(id % 5 AS INT) AS z", "id % 3 AS w",
        "CASE WHEN id % 11 > 0 THEN concat('c', id * id % 2) END AS c",
    )
    sets = [["x y"], ["z", "x y"], ["w"], ["w", "z"]]
    for null_key in (None, "none"):
        got = crosstab_bias_sets(df, sets, "c", classes=["c0", "c1"], null_key=null_key).collect()
        assert {r.set_no for r in got} == {0, 1, 2, 3}
        for number, keys in enumerate(sets):
            cols = [*keys, "c0", "c1", "n obs", "% obs"]
            want = crosstab_bias(df, keys, "c", classes=["c0", "c1"], null_key=null_key).collect()
            assert sorted(tuple(r[c] for c in cols) for r in got if r.set_no == number) == sorted(tuple(r[c] for c in cols) for r in want)


def test_bias_groups_of_empty_rows_and_without_levels(spark):
    df = spark.range(10).selectExpr("id", "id AS k", "concat('k', id) AS t", "'A' AS c")
    groups = [B.BiasGroup("k", keys=("k",)), B.BiasGroup("t", keys=("t", "k"))]
    out, model = B.fit_bias_features(df, "c", groups)
    # One row a key is below the line of every level.
    assert {(r["k , bias A"], r["{ t , k } , bias A"]) for r in out.collect()} == {(0, 0)}
    assert model.crosstabs["k"].count() == 10
    out, model = B.fit_bias_features(df.limit(0), "c", groups)
    assert model.classes == [] and out.collect() == [] and model.crosstabs["k"].collect() == []
