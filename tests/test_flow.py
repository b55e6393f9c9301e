"""Flows, scorecards and sources end to end on small tables."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from scorecraft.config import ScorecardConfig
from scorecraft.operators import binning as B
from scorecraft.operators import distcheck as DC
from scorecraft.operators import model as M
from scorecraft.plans import flows as FL
from scorecraft.sources import io as IO


@pytest.fixture(scope="module")
def loans(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(900):
        x, z, flag = float(rng.normal()), float(rng.integers(0, 40)), int(rng.integers(0, 2))
        bad = rng.random() < 1 / (1 + np.exp(-(1.5 * x + 3 * flag - 1.5)))
        rows.append((x, z, flag, "abc"[i % 3], "Default" if bad else "Paid", ("Train", "Train", "Test", "OOT", "PDV")[i % 5]))
    return spark.createDataFrame(rows, "x double, z double, flag int, c string, status string, source string")


CFG = ScorecardConfig(target="status", bad_values=("Default",))


def test_binary_feature_keeps_both_levels(spark, loans, tmp_path):
    train = loans.withColumn("y", (F.col("status") == "Default").cast("int"))
    card = M.build_scorecard(train, ["x", "flag"], ["c"])
    assert card.low_card == {"flag": [0.0, 1.0]}
    assert {"flag_0.0", "flag_1.0"} <= set(card.names)
    scored = M.apply_scorecard(train, card)
    mean = {r["flag"]: r["p"] for r in scored.groupBy("flag").agg(F.avg("p").alias("p")).collect()}
    assert abs(mean["1.0"] - mean["0.0"]) > 0.3
    odd = M.apply_scorecard(train.limit(1).withColumn("flag", F.lit(7)).union(
        train.limit(1).withColumn("flag", F.lit(None).cast("int"))), card)
    assert odd.where("p IS NULL").count() == 0
    IO.save_model(card, f"{tmp_path}/card")
    again = M.apply_scorecard(train, IO.load_model(spark, f"{tmp_path}/card"))
    assert sorted(r["p"] for r in again.collect()) == pytest.approx(sorted(r["p"] for r in scored.collect()))


@pytest.mark.parametrize("roles,categorical", [(("Train", "Test", "OOT", "PDV"), True), (("Train", "Test"), False)])
def test_whole_flow(loans, roles, categorical):
    df = loans.where(F.col("source").isin(*roles))
    st = FL.execute(df if categorical else df.drop("c"), CFG, select=False)
    got = {r["source"]: r for r in st.reports["role_comparison"].collect()}
    assert set(got) == set(roles)
    for role, r in got.items():
        assert r["tn"] + r["fp"] + r["fn"] + r["tp"] == df.where(F.col("source") == role).distinct().count()
        assert r["accuracy"] > 0.6
    assert st.reports["iv_by_source"].count() > 0


def test_stage_tables_are_written_once(spark):
    run = IO.new_run()
    one = IO.save_stage(spark.range(3), "t", run=run)
    two = IO.save_stage(one.where("id > 0"), "t")
    assert (one.count(), two.count(), IO.load_stage(spark, "t", run).count()) == (3, 2, 3)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        IO.save_stage(one, "t", run=run)


def test_types_are_decided_after_missing_spellings(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b,c,d\n2.5,1,x,NA\nNA,nan,7,\nnan,-3,,null\n-999,NULL,5d,nan\n")
    df = IO.read_dataset(spark, str(path), "Train")
    assert dict(df.dtypes) == {"a": "double", "b": "bigint", "c": "string", "d": "string", "source": "string"}
    assert [r["a"] for r in df.collect()] == [2.5, None, None, -999.0]


def test_monotonic_bins_against_brute_force(spark):
    rng = np.random.default_rng(3)
    x = np.r_[np.round(rng.normal(size=500), 2), np.full(250, 0.5)]
    y = (rng.random(750) < 1 / (1 + np.exp(-2 * x))).astype(float)
    same = np.zeros(750)
    df = spark.createDataFrame(list(zip(x.tolist(), same.tolist(), y.tolist())), "x double, same double, y double")
    got = {r["feature"]: r for r in B.monotonic_edges(df.repartition(5), ["x", "same"]).collect()}
    want = None
    for k in range(20, 1, -1):
        edges = np.unique(np.round(np.quantile(x, [i / k for i in range(k + 1)]), 9))
        code = np.clip(np.searchsorted(edges, x, "left") - 1, 0, None)
        bins = np.unique(code)
        if len(edges) > 2 and abs(B.spearman(np.array([x[code == b].mean() for b in bins]),
                                             np.array([y[code == b].mean() for b in bins]))) >= 0.999:
            want = (k, edges)
            break
    assert got["x"]["bins"] == want[0] and np.allclose(got["x"]["edges"], want[1])
    assert got["same"]["bins"] is None


def test_spearman_by_hand():
    assert B.spearman(np.array([1.0, 2, 3, 4]), np.array([10.0, 20, 30, 40])) == pytest.approx(1)
    assert B.spearman(np.array([1.0, 2, 3, 4]), np.array([1.0, 1, 2, 2])) == pytest.approx(0.894427191)
    assert B.spearman(np.array([1.0, 2]), np.array([3.0, 3])) == 0


def test_nearest_neighbours_tell_sets_apart(loans):
    far = loans.withColumn("x", F.col("x") + 100)
    apart = DC.distribution_check(loans, far, ["x", "z"], ["c"], "KNeighborsClassifier").first()
    alike = DC.distribution_check(loans, loans, ["x", "z"], ["c"], "KNeighborsClassifier").first()
    assert apart["auc"] > 0.99 and alike["auc"] < 0.6


def test_search_and_selection_do_not_depend_on_partitions(loans):
    train = loans.withColumn("y", (F.col("status") == "Default").cast("int"))
    out = []
    for parts in (1, 7):
        v, feats = M.selection_frame(train.repartition(parts), ["x", "z", "flag"], ["c"])
        out.append((M.sequential_select(v, feats, 2, folds=3), [r[:2] for r in M.random_search(v, draws=3, folds=2)]))
        v.unpersist()
    assert out[0] == out[1] and "x" in out[0][0]


def test_fold_accuracies_equal_single_fits(loans):
    v, feats = M.selection_frame(loans.withColumn("y", (F.col("status") == "Default").cast("int")), ["x", "z"], ["c"])
    w = M.with_folds(v, 2)
    sizes = {r["_fold"]: r["n"] for r in w.groupBy("_fold").agg(F.count("*").alias("n")).collect()}
    want = []
    for k in sorted(sizes):
        m = M._fit_subset(w.where(F.col("_fold") != k), [0, 2], "l2", 1.0, sum(sizes.values()) - sizes[k])
        s = M.VectorSlicer(inputCol="features", outputCol="sub", indices=[0, 2]).transform(w.where(F.col("_fold") == k))
        want.append(m.transform(s).where("prediction = y").count() / sizes[k])
    got = M.cv_accuracies(w, [[0, 2], [1]], sizes)
    v.unpersist()
    assert got[0] == pytest.approx(np.mean(want), abs=0.003) and got[1] < got[0]


STAGED = CFG.with_(binning_method="monotonic", max_bins=6, distribution_check="GaussianNB", selection_encoder="ordinal")


def test_stages_in_sessions_of_their_own(spark, loans, tmp_path):
    whole = FL.execute(loans, STAGED, select=True)
    base = str(tmp_path / "flow")
    after = None
    for name in ("prepare", "reduce", "select", "build"):
        session = spark.newSession()  # no state but what is written
        df = session.createDataFrame(loans.toPandas()) if name == "prepare" else None
        FL.run_stage(session, name, base, STAGED, after, df)
        after = name
    got = FL.load_state(spark.newSession(), f"{base}/build")
    assert (got.numeric, got.categorical) == (whole.numeric, whole.categorical)
    assert set(got.reports) == set(whole.reports)
    for name in ("accuracy", "role_comparison", "band_psi", "csi_summary", "iv", "target", "bin_info"):
        rows = [sorted(str(r.asDict()) for r in st.reports[name].select(*sorted(st.reports[name].columns)).collect()) for st in (got, whole)]
        assert rows[0] == rows[1], name
    assert got.scored.count() == whole.scored.count()
    again = M.apply_scorecard(got.data, got.card)
    assert again.where("p IS NULL").count() == 0
    before = FL.run_stage(spark, "build", base, STAGED, "select")  # committed: left as it is
    assert before == f"{base}/build"
    with pytest.raises(ValueError, match="already"):
        FL.save_state(got, f"{base}/build")
    with pytest.raises(ValueError, match="no whole state"):
        FL.load_state(spark, f"{base}/refine")


def test_training_rows_are_split_where_no_test_is_given(loans):
    rows = loans.where("source = 'Train'").withColumn("nothing", F.lit(None).cast("double"))
    st = FL.prepare_data(rows, CFG.with_(test_fraction=0.3))
    n = {r["source"]: r["count"] for r in st.data.groupBy("source").count().collect()}
    assert set(n) == {"Train", "Test"} and 0.2 < n["Test"] / (n["Train"] + n["Test"]) < 0.4
    assert "nothing" not in st.data.columns and st.reports["target"].count() == 4


def test_columns_of_role_files(spark, loans, tmp_path):
    for name, df in (("a", loans), ("b", loans.drop("z")), ("c", loans)):
        df.drop("source").write.parquet(str(tmp_path / f"{name}.parquet"))
    a, b, c = (str(tmp_path / f"{x}.parquet") for x in "abc")
    with pytest.raises(ValueError, match="differ"):
        FL.load_inputs(spark, a, b)
    with pytest.warns(UserWarning, match="OOT"):
        df = FL.load_inputs(spark, a, c, oot=b)
    assert df.groupBy("source").count().count() == 3 and df.where("source = 'OOT' AND z IS NOT NULL").count() == 0


def test_refined_model_without_bins(loans):
    st = FL.execute(loans, CFG.with_(binned=False, penalise_constant=True, transforms={"z": "sqrt"}), select=False, refine=True)
    assert not st.card.edges and {"x", "z"} <= set(st.card.names)
    assert st.reports["role_comparison"].count() == 4 and st.reports["role_comparison"].where("accuracy < 0.6").count() == 0
