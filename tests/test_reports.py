import pytest
from pyspark.sql import functions as F

from cutpoint.operators import model, scorecard
from cutpoint.plans import inference, reports

ROWS = [(0.05, 0), (0.3, 1), (0.9, 1), (0.85, 0), (0.2, 0)]


def scored(spark, rows=ROWS):
    return spark.createDataFrame(rows, "score double, label int").repartition(2)


def test_export_observes_what_it_writes(spark, tmp_path):
    path = str(tmp_path / "out")
    got = {(r["report"], r["metric"]): r["value"] for r in reports.export_scored(scored(spark), 0.2, 0.8, 0.5, path).collect()}
    back = spark.read.parquet(path)
    assert got["inference", "rows"] == back.count() == 5
    for band in ("approve", "review", "decline"):
        assert got["inference", f"{band}_count"] == back.where(F.col("decision") == band).count()
    assert [got["error_analysis", m] for m in ("tn", "fp", "fn", "tp")] == [2, 1, 1, 1]
    assert got["error_analysis", "recall"] == 0.5 and got["error_analysis", "realized_fpr"] == pytest.approx(1 / 3)
    with pytest.raises(ValueError, match="1 rows have a null or NaN score"):
        reports.export_scored(scored(spark, [(None, 1), (0.5, 0)]), 0.2, 0.8, 0.5, str(tmp_path / "bad"))


def test_reference_drift_is_skipped_without_a_usable_reference(spark, tmp_path):
    cur = scored(spark)
    assert reports.reference_drift(cur, None).count() == 0
    assert reports.reference_drift(cur, str(tmp_path / "absent")).count() == 0
    cur.select("label").write.parquet(str(tmp_path / "plain"))
    assert reports.reference_drift(cur, str(tmp_path / "plain")).count() == 0
    cur.write.parquet(str(tmp_path / "same"))
    got = {r["metric"]: r["value"] for r in reports.reference_drift(cur, str(tmp_path / "same"), bins=5).collect()}
    assert got == {"psi": pytest.approx(0.0, abs=1e-9), "drift_level_no": 1.0}


@pytest.fixture(scope="module")
def fitted(spark):
    rows = [(float(i % 7), float(i % 5), int((i % 7) + (i % 5) > 5)) for i in range(140)] + [(0.0, 0.0, 1), (6.0, 4.0, 0)]
    train = spark.createDataFrame(rows, "a double, b double, label int")
    summary = model.train_summary(train, ["a", "b"])
    return train, summary, model.fit_logistic(train, ["a", "b"], scaled=True, summary=summary)


def test_expression_scores_equal_the_fitted_model(spark, fitted, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array
    train, _, m = fitted
    m.write().save(str(tmp_path / "m"))         # loaded anew: without the training summary
    want = [r[0] for r in PipelineModel.load(str(tmp_path / "m")).transform(train).select(vector_to_array("probability")[1]).collect()]
    assert [r["score"] for r in model.score(m, train).collect()] == pytest.approx(want, abs=1e-12)


def test_candidates_equal_single_fits(spark, fitted):
    train, summary, _ = fitted
    cands = model.default_candidates(c_values=(0.1, 1.0), max_iter=500)
    for c, m in zip(cands, model.fit_candidates(train, ["a", "b"], cands, summary=summary)):
        one = model.fit_logistic(train, ["a", "b"], c_value=c.c_value, max_iter=c.max_iter, scaled=c.scaled, summary=summary)
        assert m.stages[-1].coefficients.toArray() == pytest.approx(one.stages[-1].coefficients.toArray(), abs=1e-6)
        assert [r["score"] for r in model.score(m, train).collect()] == pytest.approx(
            [r["score"] for r in model.score(one, train).collect()], abs=1e-6)


def test_candidates_share_their_passes(spark, fitted, tmp_path):
    from pyspark.ml import PipelineModel
    train, summary, _ = fitted
    context = spark.sparkContext
    jobs = []
    for cands in (model.default_candidates(c_values=(1.0,))[1:], model.default_candidates(max_iter=500)):
        context.setJobGroup(f"fits-{len(cands)}", "")
        found = model.fit_candidates(train, ["a", "b"], cands, summary=summary)
        jobs.append(len(context.statusTracker().getJobIdsForGroup(f"fits-{len(cands)}")))
        context.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < jobs[1] <= jobs[0] + 6, jobs         # five fits: at most a pass or two more than one
    found[0].write().save(str(tmp_path / "raw"))
    again = PipelineModel.load(str(tmp_path / "raw"))
    assert again.stages[-1].coefficients == found[0].stages[-1].coefficients
    assert again.transform(train).where("prediction = label").count() > 120


def test_candidates_on_odd_rows_equal_single_fits(spark):
    cands = [model.Candidate("raw", 0.5, False, 2000), model.Candidate("scaled", 0.5, True, 2000)]
    rows = {"separable, one constant": [(float(i), 7.0, int(i > 30)) for i in range(60)],
            "rare, far scales": [(float(i % 11), float(i * i % 97) * 1e4, int(i % 50 == 0)) for i in range(400)] * 2,
            "all 1": [(1.0, 2.0, 1), (2.0, 5.0, 1)], "all 0": [(1.0, 2.0, 0), (2.0, 5.0, 0)]}
    for name, some in rows.items():
        train = spark.createDataFrame(some, "a double, b double, label int")
        for c, m in zip(cands, model.fit_candidates(train, ["a", "b"], cands)):
            one = model.fit_logistic(train, ["a", "b"], c_value=c.c_value, max_iter=c.max_iter, scaled=c.scaled)
            assert [r["score"] for r in model.score(m, train).collect()] == pytest.approx(
                [r["score"] for r in model.score(one, train).collect()], abs=1e-5), (name, c.name)
    for bad in ((None, 1.0, 1), (float("nan"), 1.0, 0), (1.0, 1.0, None), (1.0, 1.0, 2)):
        train = spark.createDataFrame([*rows["separable, one constant"], bad], "a double, b double, label int")
        with pytest.raises(Exception, match="fit rejected"):
            model.fit_candidates(train, ["a", "b"], cands)


def test_scorecard_bundle_and_bare_model(spark, fitted, tmp_path):
    train, summary, m = fitted
    card = scorecard.from_model(m, ["a", "b"], summary)
    exact = [r["score"] for r in model.score(m, train).collect()]
    assert [r["score"] for r in train.select(card.column().alias("score")).collect()] == pytest.approx(exact, abs=1e-3)
    model.save_bundle(card.model(), ["a", "b"], 0.02, 0.4, str(tmp_path / "bundle"))
    card.model().write().save(str(tmp_path / "bare"))
    rows = train.drop("label").withColumn("id", F.monotonically_increasing_id())
    bundle, bare = model.load_bundle(spark, str(tmp_path / "bundle")), model.load_bundle(spark, str(tmp_path / "bare"))
    assert bundle.feature_columns == ["a", "b"] and bare.feature_columns is None and bare.decline_threshold is None
    # The artifact profile: the bundle's threshold (0.40, half of it capped at 0.11); 0.45 for a bare model.
    for b, t2 in ((bundle, 0.4), (bare, 0.45)):
        got = inference.infer_with_bundle(spark, rows, b, "artifact").collect()
        assert {(r["approve_threshold"], r["decline_threshold"]) for r in got} == {(0.11, t2)}
        assert all(r["decision"] == ("approve" if r["score"] < 0.11 else "review" if r["score"] < t2 else "decline") for r in got)
        assert all(r["predicted_class"] == int(r["score"] >= t2) for r in got)
    with pytest.raises(Exception, match="feature|column"):
        inference.infer_with_bundle(spark, rows.drop("b"), bundle, "artifact").collect()
