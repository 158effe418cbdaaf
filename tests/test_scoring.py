from __future__ import annotations

import math
from datetime import datetime, timezone
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import Row
from pyspark.sql import functions as F

from roleweave.functions.classify import RelevanceRules
from roleweave.operators import similarity, tokens
from roleweave.operators.encoding import HashingEncoder, ModelEncoder, reference_vectors
from roleweave.plans import bag_of_words, catalogue, training
from roleweave.plans.scoring import ModelMismatch, ModelMissing, build_features, load_model, save_model, score_pending
from roleweave.session import stage
from roleweave.sources.store import PostingStore
from roleweave.sources.training_files import read_descriptions, read_profile, read_scores, skipped_rows, training_rows

RULES = RelevanceRules(include=("NGS",), exclude=(), off_topic_titles=())


def frames(spark, sections, resume, postings):
    make = spark.createDataFrame
    return (
        make(list(enumerate(postings)), "id int, embedding array<float>"),
        make(list(enumerate(sections)), "section_id bigint, vector array<double>"),
        make([(resume,)], "vector array<double>"),
    )


def test_feature_layout(spark):
    args = frames(spark, [[1.0, 0.0], [0.0, 1.0]], [0.6, 0.8], [[1.0, 0.0], [0.0, 1.0], None])
    df = similarity.fit_features(*args).withColumn("features", similarity.feature_vector())
    rows = {r.id: r for r in df.collect()}
    np.testing.assert_allclose(rows[0].features.toArray(), [1.0, 0.0, 1.0, 0.5, 0.6], atol=1e-7)
    np.testing.assert_allclose(rows[1].features.toArray(), [0.0, 1.0, 1.0, 0.5, 0.8], atol=1e-7)
    assert rows[2].top_sims is None and rows[2].fit_max is None and rows[2].resume_cos is None


@pytest.mark.parametrize("block_bytes", [similarity.BLOCK_BYTES, 100])
def test_top_sections_match_brute_force(spark, monkeypatch, block_bytes):
    """The profile fits one block, or is cut into many; the result is the same."""
    monkeypatch.setattr(similarity, "BLOCK_BYTES", block_bytes)
    rng = np.random.default_rng(0)
    sections, postings = rng.normal(size=(9, 4)), rng.normal(size=(30, 4)).astype(np.float32)
    df, sec, _ = frames(spark, sections.tolist(), [0.0] * 4, postings.tolist())
    found = {r.id: [(s.section, s.sim) for s in r.top_sims] for r in similarity.top_section_sims(df, sec).collect()}
    scores = postings.astype(np.float64) @ sections.T
    for i, row in enumerate(scores):
        best = np.argsort(-row)[:3]
        assert [s for s, _ in found[i]] == best.tolist()
        np.testing.assert_allclose([v for _, v in found[i]], row[best], atol=1e-9)


def test_mean_vectors(spark):
    df = spark.createDataFrame([("a", [2.0, 0.0]), ("a", [0.0, 2.0]), ("b", [0.0, 3.0])], "k string, v array<float>")
    rows = {r.k: r.vector for r in similarity.mean_vectors(df, "v", "k").collect()}
    np.testing.assert_allclose(rows["a"], [math.sqrt(0.5)] * 2)
    assert rows["b"] == [0.0, 1.0]


def test_hashing_encoder(spark):
    df = spark.createDataFrame([("NGS pipelines",), ("ngs  PIPELINES!",), ("",), (None,)], "text string")
    vectors = [np.array(r.embedding) for r in HashingEncoder(64).encode(df, "text").collect()]
    np.testing.assert_allclose([np.linalg.norm(v) for v in vectors], 1.0, rtol=1e-6)
    assert (vectors[0] == vectors[1]).all() and (vectors[2] == vectors[3]).all()
    assert not (vectors[0] == vectors[2]).all()


def test_model_encoder_prefixes_and_normalizes(spark):
    def length_model():
        def predict(texts):
            return np.array([[float(len(t)), 1.0] for t in texts], dtype=np.float32)

        return predict

    df = spark.createDataFrame([("abc",)], "text string")
    vector = ModelEncoder(length_model, "length").encode(df, "text").first().embedding
    raw = np.array([len("search_document: abc"), 1.0])
    np.testing.assert_allclose(vector, raw / np.linalg.norm(raw), rtol=1e-6)


def test_reference_vectors_encode_only_what_changed(spark, root):
    class Counting(HashingEncoder):
        encoded = 0

        def encode(self, df, text, out="embedding"):
            Counting.encoded += df.count()
            return super().encode(df, text, out)

    def profile(*texts):
        rows = [("section", i, t) for i, t in enumerate(texts)] + [("resume", 0, "resume")]
        return spark.createDataFrame(rows, "kind string, position int, text string")

    encoder = Counting(16)
    assert reference_vectors(profile("one", "two"), encoder, root).count() == 3 and Counting.encoded == 3
    reference_vectors(profile("one", "two"), encoder, root)
    assert Counting.encoded == 3
    assert reference_vectors(profile("one", "new"), encoder, root).count() == 3 and Counting.encoded == 4


# ---------------------------------------------------------------- files


@pytest.fixture
def career(tmp_path: Path):
    body = "A plain sentence that is long enough for its section to be kept."
    (tmp_path / "history.md").write_text(f"## One\n{body}\n## Two\n{body} More.\n## Tiny\nno\n")
    (tmp_path / "resume.md").write_text("maps and rocks")
    (tmp_path / "scores.csv").write_text("Name,Score\nalpha,80\nbeta,N/A\ngamma,55\ndelta one,40\n")
    for name in ("alpha", "beta", "delta one"):
        (tmp_path / "jd" / name).mkdir(parents=True)
        (tmp_path / "jd" / name / "jd.md").write_text(f"---\ntitle: {name}\nurl: x\n---\n\nJD of {name}\r\n")
    return tmp_path


def test_training_files(spark, career):
    scores = read_scores(spark, str(career / "scores.csv"))
    texts = read_descriptions(spark, str(career / "jd"))
    rows = training_rows(scores, texts).orderBy("name").collect()
    assert [(r.name, r.score, r.description) for r in rows] == [
        ("alpha", 80.0, "JD of alpha\n"),
        ("delta one", 40.0, "JD of delta one\n"),
    ]
    assert [r.name for r in skipped_rows(scores, texts).collect()] == ["gamma"]


def test_profile(spark, career):
    rows = read_profile(spark, str(career / "history.md"), str(career / "resume.md")).collect()
    assert sorted((r.kind, r.position) for r in rows) == [("resume", 0), ("section", 0), ("section", 1)]


def test_labelled_features(spark, career, root):
    encoder = HashingEncoder(8)
    reference = reference_vectors(
        read_profile(spark, str(career / "history.md"), str(career / "resume.md")), encoder, f"{root}/cache"
    )
    scores, texts = read_scores(spark, str(career / "scores.csv")), read_descriptions(spark, str(career / "jd"))
    rows, skipped = training.labelled_features(scores, texts, encoder, reference)
    assert {r.name: (r.score, r.features.size) for r in rows.collect()} == {"alpha": (80.0, 11), "delta one": (40.0, 11)}
    assert [r.name for r in skipped.collect()] == ["gamma"]
    with pytest.raises(ValueError, match="no usable"):
        training.labelled_features(scores.filter("false"), texts, encoder, reference)


def test_bow_rows(spark):
    rows = spark.createDataFrame([(1, "About\n\nResponsibilities: run pipelines"), (2, "About us only")], "id int, description string")
    assert [(r.id, r.tokens) for r in training.bow_rows(rows).collect()] == [(1, ["responsibilities", "run", "pipelines"])]


# ---------------------------------------------------------------- training


def regression_rows(spark, n=40, d=4, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    y = 50 + x @ np.arange(1, d + 1) + rng.normal(size=n)
    rows = [(i, float(y[i]), Vectors.dense(x[i])) for i in range(n)]
    return x, y, spark.createDataFrame(rows, ["key", "score", "features"])


def test_population_scaler(spark):
    x, _, rows = regression_rows(spark)
    model = training.embedding_preprocessor(rows, {})
    found = np.array([r.scaled.toArray() for r in model.transform(rows).orderBy("key").collect()])
    np.testing.assert_allclose(found, (x - x.mean(0)) / x.std(0), atol=1e-9)


@pytest.mark.parametrize("alpha", [0.01, 5.0, 100.0])
def test_ridge_matches_the_closed_form(spark, alpha):
    x, y, rows = regression_rows(spark)
    model = training.fit("ridge", {"alpha": alpha}, rows, training.embedding_preprocessor)
    z = (x - x.mean(0)) / x.std(0)
    expected = np.linalg.solve(z.T @ z + alpha * np.eye(z.shape[1]), z.T @ (y - y.mean()))
    np.testing.assert_allclose(model.stages[-1].coefficients.toArray(), expected, rtol=1e-8)


@pytest.mark.parametrize("scale_before_split", [True, False])
def test_one_pass_ridge_matches_single_fits(spark, monkeypatch, scale_before_split):
    """Same value for every trial as fitting each fold with Spark ML."""
    _, _, rows = regression_rows(spark, n=60, seed=5)
    candidates = [{"alpha": a} for a in (0.01, 30.0)]

    def run():
        result = training.cross_validate(rows, "key", "ridge", candidates, scale_before_split=scale_before_split)
        return [r.spearman for r in result.orderBy("trial").collect()]

    one_pass = run()

    def fitted(data, key, regressor, own, dims, shared_scale):
        plain = training.embedding_preprocessor
        shared = plain(data, {}) if shared_scale else None
        return training._fitted_predictions(data, key, regressor, own, plain, shared, 4)

    monkeypatch.setattr(training, "_linear_predictions", fitted)
    np.testing.assert_allclose(one_pass, run(), atol=1e-9)


def test_ridge_refuses_wider_features_than_it_can_solve(spark, monkeypatch):
    _, _, rows = regression_rows(spark, n=20)
    monkeypatch.setattr(training, "MOMENT_DIMS", 2)
    with pytest.raises(ValueError, match="at most 2 features"):
        training.cross_validate(rows, "key", "ridge", [{"alpha": 1.0}])


def test_elastic_net_matches_coordinate_descent(spark):
    x, y, rows = regression_rows(spark)
    params = {"alpha": 0.5, "l1_ratio": 0.7, "max_iter": 1000}
    model = training.fit("elasticnet", params, rows, training.embedding_preprocessor)
    z, c = (x - x.mean(0)) / x.std(0), y - y.mean()
    n, w = len(y), np.zeros(x.shape[1])
    for _ in range(2000):
        for j in range(len(w)):
            rho = z[:, j] @ (c - z @ w + z[:, j] * w[j]) / n
            w[j] = np.sign(rho) * max(abs(rho) - 0.5 * 0.7, 0) / (z[:, j] @ z[:, j] / n + 0.5 * 0.3)
    np.testing.assert_allclose(model.stages[-1].coefficients.toArray(), w, atol=1e-4)


def moments_of(x, y):
    a = np.column_stack([np.ones(len(y)), x, y])
    return a.T @ a


def test_elastic_net_from_moments_is_optimal_for_thirty_trials():
    """Every trial meets the conditions of the optimum, with correlated and constant features, in any order of the trials."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(80, 12))
    x[:, 3] = x[:, 2] + 0.01 * rng.normal(size=80)
    x[:, 7] = 5.0
    y = 3 * x[:, 0] - 2 * x[:, 2] + rng.normal(size=80)
    candidates = training.trials("elasticnet", 30, seed=1)
    weights, intercepts = training.elastic_from_moments(moments_of(x, y), candidates)
    deviation = np.where(x.std(0) == 0, 1.0, x.std(0))
    z, n = (x - x.mean(0)) / deviation, len(y)
    np.testing.assert_allclose(intercepts, y.mean() - weights @ x.mean(0))
    for c, w in zip(candidates, weights * deviation):
        l1, l2 = c["alpha"] * c["l1_ratio"], c["alpha"] * (1 - c["l1_ratio"])
        slope = z.T @ (y - y.mean() - z @ w) / n - l2 * w
        at_zero = w == 0
        assert (np.abs(slope[at_zero]) <= l1 + 1e-6).all()
        np.testing.assert_allclose(slope[~at_zero], l1 * np.sign(w[~at_zero]), atol=1e-6)
    again, _ = training.elastic_from_moments(moments_of(x, y), candidates[::-1])
    np.testing.assert_allclose(again[::-1], weights, atol=1e-6)


def test_elastic_net_from_moments_equals_single_fits(spark):
    _, _, rows = regression_rows(spark, n=60, seed=5)
    (moments,) = training.fold_moments(rows.withColumn("fold", F.lit(0)), 4).values()
    candidates = [{"alpha": 0.5, "l1_ratio": 0.7, "max_iter": 1000}, {"alpha": 0.01, "l1_ratio": 0.2, "max_iter": 1000}]
    weights, intercepts = training.elastic_from_moments(moments, candidates)
    for c, w, b in zip(candidates, weights, intercepts):
        model = training.fit("elasticnet", c, rows, training.embedding_preprocessor)
        predicted = np.array([r.prediction for r in model.transform(rows).orderBy("key").collect()])
        x = np.array([r.features.toArray() for r in rows.orderBy("key").collect()])
        np.testing.assert_allclose(x @ w + b, predicted, atol=1e-3)


def test_elastic_net_trials_take_one_pass(spark):
    """Thirty trials in five folds, scored like single models."""
    _, _, rows = regression_rows(spark, n=60, seed=5)
    result = training.cross_validate(rows, "key", "elasticnet", training.trials("elasticnet", 30)).collect()
    assert sorted(r.trial for r in result) == list(range(30)) and max(r.spearman for r in result) > 0.9


def bag_rows(spark):
    rng = np.random.default_rng(5)
    words = np.array([f"w{i}" for i in range(40)])
    share = 1.0 / np.arange(1, 41)
    rows = []
    for i in range(80):
        own = [str(w) for w in rng.choice(words, size=rng.integers(1, 25), p=share / share.sum())]
        rows.append((i, own, float(10 * ("w3" in own) - 4 * ("w5" in own) + rng.normal())))
    rows.append((80, ["unseen"], 3.0))  # none of its terms is in any vocabulary
    return spark.createDataFrame(rows, "id int, tokens array<string>, score double")


def test_bags_fitted_in_step_equal_single_fits(spark):
    rows = bag_rows(spark)
    bounds = [(2, 0.9, 30, 1, True), (1, 0.8, 1000, 2, False), (3, 1.0, 60, 2, True)]
    candidates = [
        {"alpha": a, **dict(zip(("min_df", "max_df", "max_features", "max_ngram", "use_idf"), b))}
        for a, b in zip((0.05, 1.0, 20.0), bounds)
    ]
    data = stage(training.with_fold(rows, "id"), "bags")
    single = training._fitted_predictions(data, "id", "ridge", candidates, training.bow_preprocessor, None, 4)
    expected = {(r.trial, r._key): r.prediction for r in single.collect()}
    found = {(r.trial, r._key): r.prediction for r in training.ridge_predictions(data, "id", candidates).collect()}
    assert found.keys() == expected.keys() and len(found) == 3 * 81
    np.testing.assert_allclose([found[k] for k in expected], list(expected.values()), atol=5e-3)


def test_bags_of_a_block_go_through_all_models_together(spark, monkeypatch):
    """One product of a block with all models, whatever their number; equal bags are predicted alike to the last bit."""
    candidates = training.bow_trials("ridge", 6)
    found = {}
    for dense, cells in ((800, 1 << 21), (3, 100)):
        monkeypatch.setattr(bag_of_words, "DENSE", dense)
        monkeypatch.setattr(bag_of_words, "CELLS", cells)
        rng = np.random.default_rng(1)
        bags = [sorted(rng.choice(9, size=3, replace=False).tolist()) for _ in range(700)]
        lists = pa.array(bags, pa.list_(pa.int32()))
        folds = pa.array([i % 2 for i in range(700)], pa.int32())
        scores = pa.array(rng.normal(size=700))
        batch = pa.RecordBatch.from_arrays([folds, pa.array(range(700)), scores, lists], ["fold", "_key", "score", "terms"])
        models = [bag_of_words.Model(t, f, c["alpha"], np.array([8, 0, 3, 5]), np.array([1.0, 2.0, 0.5, 3.0])) for t, c in enumerate(candidates) for f in (0, 1)]
        directions = {i: rng.normal(size=4) for i in range(0, 12, 3)}
        total = {}
        bag_of_words._products(models, directions, 9)(batch, total)
        for i, p in directions.items():
            x = np.array([[w * (t in b) for t, w in zip((8, 0, 3, 5), models[i].weights)] for b in bags])
            norm = np.linalg.norm(x, axis=1, keepdims=True)
            x = np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)[np.arange(700) % 2 != models[i].fold]
            np.testing.assert_allclose(total[i], x.T @ (x @ p), rtol=1e-9)
        assert total.keys() == directions.keys()
    rows = spark.createDataFrame([(i, i % 2, 0.0, b) for i, b in enumerate(bags)], "_key long, fold int, score double, terms array<int>")
    fits = [(rng.normal(size=4), 0.5) for _ in models]
    for r in bag_of_words.held_out(rows, models, fits, 9).collect():
        held = tuple(t for t in (0, 3, 5, 8) if t in bags[r._key])
        assert found.setdefault((r.trial, r.fold, held), r.prediction) == r.prediction


def test_only_terms_as_frequent_as_the_last_one_needed_are_ranked(spark):
    rows = [(0, False, 9, 1), (0, False, 7, 2), (0, False, 5, 4), (0, False, 1, 90), (1, True, 2, 1)]
    counted = spark.createDataFrame(rows, "fold int, pair boolean, df long, n long")
    assert sorted(map(tuple, bag_of_words._last_needed(counted, 4).collect())) == [(0, False, 5), (1, True, 2)]
    assert sorted(map(tuple, bag_of_words._last_needed(counted, 3).collect())) == [(0, False, 7), (1, True, 2)]


def test_bags_take_as_many_passes_for_thirty_trials_as_the_slowest_needs(spark, monkeypatch):
    passes, summed = [], bag_of_words._summed
    monkeypatch.setattr(bag_of_words, "_summed", lambda *a: passes.append(1) or summed(*a))
    result = training.cross_validate(bag_rows(spark), "id", "ridge", training.bow_trials("ridge", 30), training.bow_preprocessor)
    assert result.count() == 30 and len(passes) <= bag_of_words.MOST_PASSES + 1


def test_boosted_trees_are_fitted_once_for_all_numbers_of_iterations(spark):
    rng = np.random.default_rng(2)
    rows = [(i, float(x[0] * 3 + x[1] ** 2), Vectors.dense(x.tolist())) for i, x in enumerate(rng.normal(size=(60, 2)))]
    data = training.with_fold(spark.createDataFrame(rows, ["id", "score", "features"]), "id", 2)
    own = {"learning_rate": 0.2, "depth": 2, "subsample": 0.7}
    together = [{**own, "iterations": n} for n in (3, 6)]
    assert training._families("gbt", [*together, {**own, "depth": 3, "iterations": 3}]) == [[0, 1], [2]]
    pre = training.embedding_preprocessor
    run = lambda some: training._fitted_predictions(data, "id", "gbt", some, pre, None, 2).collect()
    found = {(r.trial, r._key): r.prediction for r in run(together)}
    for number in (0, 1):
        for r in run([together[number]]):
            assert found[number, r._key] == pytest.approx(r.prediction)


def test_boosted_trials_are_families():
    drawn = training.boosted_trials(30)
    assert len(drawn) == 30 and len(training._families("gbt", drawn)) == 5
    assert {p["iterations"] for p in drawn} == set(range(100, 401, 50))


def test_unknown_regressor():
    with pytest.raises(ValueError, match="unknown regressor"):
        training.trials("magic", 1)


def test_search_space():
    for params in training.trials("elasticnet", 50, seed=3):
        assert 1e-4 <= params["alpha"] <= 1e2 and 0.01 <= params["l1_ratio"] <= 0.99
        assert params["max_iter"] in range(1000, 10001, 1000)
    assert training.trials("ridge", 3, seed=1) == training.trials("ridge", 3, seed=1)
    assert all(2 <= p["depth"] <= 5 for p in training.trials("gbt", 20))


def test_train_score_round_trip(spark, root):
    """Tune, export, score pending postings, and refuse a model from another vector space."""
    encoder = HashingEncoder(8)
    store = PostingStore(spark, f"{root}/store")
    model_path = f"{root}/model"
    profile = spark.createDataFrame(
        [("section", 0, "NGS pipelines"), ("section", 1, "sales"), ("resume", 0, "NGS")], "kind string, position int, text string"
    )
    reference = reference_vectors(profile, encoder, f"{root}/cache")
    assert score_pending(store, encoder, reference, model_path) == Row(pending_count=0, scored_count=0)

    words = ["NGS", "pipelines", "sales", "variant", "calling", "chef"]
    texts = [(f"k{i}", f"{words[i % 6]} {words[i % 5]} {words[i % 4]}", float(i % 6)) for i in range(30)]
    labelled = spark.createDataFrame(texts, "key string, description string, score double")
    rows = stage(build_features(labelled, encoder, reference).select("key", "score", "features"), "rows")
    value = training.train_export(rows, "key", "ridge", encoder.fingerprint(), model_path, n_trials=1)
    assert -1.0 <= value <= 1.0

    batch = spark.createDataFrame(
        [("s", "C", "NGS lead", None, "NGS pipelines", "a", None, "{}", 0), ("s", "C", "NGS lead", None, " ", "b", None, "{}", 1), ("s", "C", "Chef", None, "soup", "c", None, "{}", 2)],
        "source string, company string, title string, location string, description string, url string, raw_id string, extra_json string, arrival int",
    ).withColumn("posted_date", F.lit(None).cast("date"))
    store.upsert(batch, RULES, datetime(2026, 1, 1, tzinfo=timezone.utc))
    with pytest.raises(ModelMissing):
        score_pending(store, encoder, reference, f"{root}/nowhere")
    with pytest.raises(ModelMismatch, match="dims"):
        load_model(spark, model_path, HashingEncoder(16).fingerprint())
    assert score_pending(store, encoder, reference, model_path) == Row(pending_count=1, scored_count=1)
    scores = {r.url: r.score for r in store.read().collect()}
    assert scores["a"] is not None and scores["b"] is None and scores["c"] is None
    assert score_pending(store, encoder, reference, model_path) == Row(pending_count=0, scored_count=0)


def test_metadata_without_model(spark, root):
    x, y, rows = regression_rows(spark, n=10)
    save_model(training.fit("ridge", {"alpha": 1.0}, rows, training.embedding_preprocessor), {"a": "1"}, root)
    assert load_model(spark, root, {"a": "1"}).stages
    spark.createDataFrame([('{"a": "1"}',)], "fingerprint string").write.json(f"{root}/other/metadata")
    with pytest.raises(ModelMissing):
        load_model(spark, f"{root}/other", {"a": "1"})


def test_no_training_rows(spark):
    _, _, rows = regression_rows(spark, n=5)
    with pytest.raises(ValueError, match="no usable"):
        training.train_export(rows.filter("false"), "key", "ridge", {}, "/nowhere")


# ---------------------------------------------------------------- bag of words


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Don't use the C/C++ -- state-of-the-art (v2.0)!", ["n't", "use", "c/c++", "--", "state-of-the-art", "v2.0"]),
        ("C++ and $100,000 at 10:30, R&D 5+ years", ["c++", "100,000", "10:30", "r", "5+", "years"]),
        ('say "quoted" words', ["say", "``", "quoted", "''", "words"]),
        ("Runs well. Ends e.g. here.", ["runs", "well", "ends", "e.g."]),
        ("you'll plan; we cannot wait... #1", ["'ll", "plan", "wait", "...", "1"]),
        ("", []),
    ],
)
def test_tokens(one, text, expected):
    assert one(tokens.tokens, "x string", text) == expected


def test_tokens_are_made_once_for_a_filter_on_them(spark):
    """The optimizer copied the rules into the filter and below a join, and ran them again."""
    texts = spark.createDataFrame([(1, "a pipeline"), (2, ""), (3, None)], "id int, x string")
    found = texts.select("id", tokens.tokens(F.col("x")).alias("t")).filter(F.size("t") > 0)
    assert [r.t for r in found.collect()] == [["pipeline"]]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("run(lower(") == 1 and "regexp_replace" not in plan


def test_words_of_a_file_of_one_row_group_are_made_by_all_tasks(spark, tmp_path):
    pq.write_table(pa.table({"doc_id": pa.array(range(400), pa.int64()), "text": [f"word{i} data" for i in range(400)]}), tmp_path / "documents.parquet")
    words = catalogue._words(spark, str(tmp_path))
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"  # which puts so few rows together again
    before = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        sizes = words.groupBy(F.spark_partition_id().alias("part")).count().collect()
    finally:
        spark.conf.set(coalesce, before)
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 400
    assert {(r.doc_id, *r.tokens) for r in words.collect()} == {(i, f"word{i}", "data") for i in range(400)}


def test_tokens_of_pieces_at_the_start_and_between_other_white_space(one):
    assert one(lambda x: tokens.tokens(x, ()), "x string", "'tis 'tis\n'tis cannot\u2003x\tdog's\ndog's b.") == [
        "'tis", "'t", "is", "'tis", "can", "not", "x", "dog's", "dog", "'s", "b."
    ]
    assert one(tokens.tokens, "x string", None) is None


def test_bow_vocabulary_ranks_by_document_frequency(spark):
    rows = spark.createDataFrame([(["a", "a", "a", "a", "b"],), (["b", "c"],), (["b", "d"],)], "tokens array<string>")
    params = {"min_df": 1, "max_df": 1.0, "max_features": 2, "max_ngram": 1, "use_idf": False}
    assert training.bow_preprocessor(rows, params).stages[0].vocabulary == ["b", "a"]


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    assert [r.n for r in df.select(tokens.ngrams(F.col("t"), 2).alias("n")).collect()] == [
        ["a", "b", "c", "a b", "b c"],
        ["a"],
        [],
    ]


def test_bow_weights(spark):
    """Binary counts times ln((1+n)/(1+df))+1, rows of unit length."""
    docs = [["a", "a", "b"], ["a", "c"], ["a", "b"]]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "id int, tokens array<string>")
    params = {"min_df": 2, "max_df": 1.0, "max_features": 10, "max_ngram": 1, "use_idf": True}
    model = training.bow_preprocessor(df, params)
    vocabulary = model.stages[0].vocabulary
    assert sorted(vocabulary) == ["a", "b"]
    idf = {"a": 1.0, "b": math.log(4 / 3) + 1}
    for row in model.transform(df).collect():
        raw = np.array([idf[t] * (t in row.tokens) for t in vocabulary])
        np.testing.assert_allclose(row.scaled.toArray(), raw / np.linalg.norm(raw), rtol=1e-9)


def test_vocabulary_bounds(spark):
    df = spark.createDataFrame([(["a", "b"],), (["a", "b"],), (["a", "c"],), (["a"],)], "t array<string>")
    found = tokens.vocabulary(df, "t", min_df=2, max_df=0.8).collect()
    assert [(r.term, r.df) for r in found] == [("b", 2)]
    assert found[0].idf == pytest.approx(math.log(5 / 3) + 1)


def test_compare_and_save(spark, root):
    _, _, rows = regression_rows(spark, n=20)
    families = {"embedding": (training.embedding_preprocessor, ("ridge",))}
    table, studies = training.compare(rows, "key", families, n_trials=1)
    assert [(r.model, r.family) for r in table.collect()] == [("ridge", "embedding")]
    assert training.save_all(rows, studies, families, root) == [f"{root}/embedding_ridge"]


def test_abbreviations_keep_their_stop(one):
    found = one(lambda x: tokens.tokens(x, ()), "x string", "Acme Inc. hires Dr. Smith vs. others. He ends (etc.) here. I.e. twice.")
    assert found == ["acme", "inc.", "hires", "dr.", "smith", "vs.", "others", "he", "ends", "etc.", "here", "i.e.", "twice"]
    assert one(lambda x: tokens.tokens(x, (), ("foo",)), "x string", "foo. inc. bar.") == ["foo.", "inc", "bar"]


def test_abbreviations_are_learnt_from_full_stops(spark):
    """Words that always have a stop, also in front of lower-case words, against those that end sentences now and then."""
    from roleweave.operators.tokens import learnt_abbreviations

    texts = [f"The firm bioq. zq. and abt. u.x. made genomes with word{i}. It was done." for i in range(30)] + ["It was done with it and the firm made it well"] * 20
    found = {r.word: r for r in learnt_abbreviations(spark.createDataFrame([(t,) for t in [*texts, None]], "text string"), "text").collect()}
    assert {"bioq", "zq", "abt", "u.x"} <= set(found) and not {"firm", "and", "with", "was", "done", "word1"} & set(found)
    assert found["zq"].without_stop == 0 and found["zq"].with_stop == 30
    assert learnt_abbreviations(spark.createDataFrame([], "text string"), "text").count() == 0
