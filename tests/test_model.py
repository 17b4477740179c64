"""The factorisation and the scorers against dense numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelspark.operators import evaluate, factorise, model, profile
from reelspark.sources.models import load_model, save_model


def random_rows(users=40, movies=25, seed=5, share=0.4):
    rng = np.random.default_rng(seed)
    rows = [
        (u * 3, m * 2 + 1, float(rng.integers(1, 11)) / 2, int(t))
        for u in range(users) for m in range(movies) if rng.random() < share
        for t in range(1 + (rng.random() < 0.1))
    ]
    # One user holds a third of all rows.
    return rows + [(999, m * 2 + 1, float(rng.integers(1, 11)) / 2, t) for m in range(movies) for t in range(len(rows) // (2 * movies))]


def dense(cells):
    pdf = cells.toPandas()
    users, movies = np.unique(pdf.userId), np.unique(pdf.movieId)
    matrix = np.zeros((users.size, movies.size))
    matrix[np.searchsorted(users, pdf.userId), np.searchsorted(movies, pdf.movieId)] = pdf.v
    return users, movies, matrix


def stacked(frame, key):
    pdf = frame.toPandas().sort_values(key)
    return np.stack(pdf.f)


def test_repeated_pair_sums_centred_and_averages_plain(ratings_of):
    df = ratings_of([(1, 10, 4.0, 100), (1, 10, 2.0, 200), (2, 10, 3.0, 1)])
    centred = {r["userId"]: r["v"] for r in model.centered_cells(df, 2.5).collect()}
    assert centred == {1: 1.0, 2: 0.5}
    assert {r["userId"]: r["v"] for r in profile.rating_cells(df).collect()} == {1: 3.0, 2: 3.0}


@pytest.mark.parametrize("budget", [1 << 26, 1])
def test_randomised_solver_equals_its_dense_form(ratings_of, budget):
    cells = model.centered_cells(ratings_of(random_rows()), 2.75)
    found = factorise.truncated_svd(cells, 4, budget=budget)
    _, _, matrix = dense(cells)
    z = np.linalg.qr(factorise.start_block(0, 14, 42)[: matrix.shape[1]])[0]
    for _ in range(factorise.POWER_ITERATIONS):
        z = np.linalg.qr(matrix.T @ (matrix @ z))[0]
    q = np.linalg.qr(matrix @ z)[0]
    _, s, vt = np.linalg.svd(q.T @ matrix, full_matrices=False)
    assert np.allclose(found.singular_values, s[:4], atol=1e-9)
    v = vt[:4].T
    approx = stacked(found.users, "userId") @ stacked(found.items, "movieId").T
    assert np.allclose(approx, matrix @ v @ v.T, atol=1e-8)
    exact = np.linalg.svd(matrix, compute_uv=False)
    assert np.allclose(s[:4], exact[:4], rtol=1e-3)


def test_full_width_is_exact_and_rank_limits_k(ratings_of):
    df = ratings_of([(u, m, float((u * m) % 5 + 1), 1) for u in range(1, 4) for m in range(1, 8)])
    trained = model.train_svd(df, 50)
    cells = model.centered_cells(df, trained.global_mean)
    _, _, matrix = dense(cells)
    s = np.linalg.svd(matrix, compute_uv=False)
    assert trained.k <= 3 and np.allclose(trained.singular_values, s[: trained.k], atol=1e-8)
    rows = model.reconstruction(trained, cells).collect()
    assert all(r["approx"] == pytest.approx(r["v"], abs=1e-6) for r in rows)


@pytest.fixture(scope="module")
def trained(spark):
    rows = spark.createDataFrame(random_rows(), "userId INT, movieId INT, rating DOUBLE, timestamp BIGINT")
    return rows, model.train_svd(rows, 6)


def pairs_of(spark, rows):
    return spark.createDataFrame(rows, "userId INT, movieId INT")


def test_unknown_user_or_movie_gets_the_mean(spark, trained, movies_of):
    rows, fitted = trained
    pairs = pairs_of(spark, [(57, -1), (5, 1), (123456, 3)])
    scored = {(r["userId"], r["movieId"]): r["predicted_rating"] for r in model.predict(pairs, fitted).collect()}
    assert all(value == pytest.approx(fitted.global_mean) for value in scored.values()) and len(scored) == 3
    record = model.predict_record(pairs_of(spark, [(57, -1)]), movies_of([1]), fitted).first()
    assert (record["title"], record["genres"], record["served_by"]) == ("Movie -1", "Unknown", "mlflow")


def test_predictions_are_clipped_products(spark, trained):
    rows, fitted = trained
    pairs = rows.select("userId", "movieId").distinct()
    uf = {r["userId"]: np.array(r["f"]) for r in fitted.user_factors.collect()}
    vf = {r["movieId"]: np.array(r["f"]) for r in fitted.item_factors.collect()}
    for r in model.predict(pairs, fitted).collect():
        raw = fitted.global_mean + uf[r["userId"]] @ vf[r["movieId"]]
        assert r["predicted_rating"] == pytest.approx(min(5.0, max(0.5, raw)))
    extreme = model.FactorModel(3.0, [1.0], _factor(spark, "userId", {1: 2.0}), _factor(spark, "movieId", {1: 4.0, 2: -4.0}), 2, 1)
    scored = {r["movieId"]: r["predicted_rating"] for r in model.predict(pairs_of(spark, [(1, 1), (1, 2)]), extreme).collect()}
    assert scored == {1: 5.0, 2: 0.5}


def _factor(spark, key, values):
    return spark.createDataFrame([(k, [v]) for k, v in values.items()], f"{key} INT, f ARRAY<DOUBLE>")


def test_bias_model_components_and_errors(spark, trained, movies_of):
    rows, fitted = trained
    pdf = rows.toPandas()
    user, movie = int(pdf.userId[0]), int(pdf.movieId[0])
    pairs = pairs_of(spark, [(user, movie), (-5, movie), (user, -5)])
    found = {(r["user_id"], r["movie_id"]): r for r in model.predict_with_bias(pairs, rows, movies_of([movie]), fitted).collect()}
    assert found[-5, movie]["error"] == "User -5 not found" and found[user, -5]["error"] == "Movie -5 not found"
    parts = found[user, movie]["components"]
    assert parts["user_bias"] == pytest.approx(pdf[pdf.userId == user].rating.mean() - fitted.global_mean)
    raw = fitted.global_mean + parts["user_bias"] + parts["movie_bias"] + parts["svd_component"]
    assert found[user, movie]["predicted_rating"] == pytest.approx(min(5.0, max(0.5, raw)))


def test_errors_against_numpy(spark, trained):
    rows, fitted = trained
    scored = model.predict(rows, fitted).toPandas()
    error = scored.rating - scored.predicted_rating
    row = evaluate.evaluate(rows, fitted).first()
    assert row["rmse"] == pytest.approx(np.sqrt((error**2).mean())) and row["mae"] == pytest.approx(error.abs().mean())
    assert evaluate.evaluate(rows.limit(0), fitted).count() == 0


def test_uncentred_errors_use_known_pairs_only(spark, trained):
    rows, _ = trained
    cells = profile.rating_cells(rows)
    fitted = model.train_svd_uncentered(cells, 5)
    test = rows.unionByName(rows.limit(10).withColumn("userId", F.lit(-1)))
    n = rows.count()
    row = evaluate.evaluate_uncentered(test, fitted).first()
    assert row["n_predictions"] == n and row["coverage"] == pytest.approx(n / (n + 10))
    scored = model.predict_unclipped_known(test, fitted).toPandas()
    mse = ((scored.rating - scored.predicted_rating) ** 2).mean()
    assert row["mse"] == pytest.approx(mse) and row["accuracy"] == pytest.approx(1 / (1 + np.sqrt(mse)))


def test_saved_model_predicts_the_same(spark, trained, tmp_path):
    rows, fitted = trained
    save_model(fitted, str(tmp_path / "m"))
    loaded = load_model(spark, str(tmp_path / "m"))
    pairs = rows.select("userId", "movieId").distinct()
    key = lambda frame: sorted(map(tuple, frame.collect()))
    assert key(model.predict(pairs, loaded)) == key(model.predict(pairs, fitted))


@pytest.mark.parametrize("budget", [1 << 26, 1])
def test_rank_one_from_ones_is_power_iteration(ratings_of, budget):
    cells = model.centered_cells(ratings_of(random_rows()), 2.75)
    found = factorise.truncated_svd(cells, 1, oversample=0, start="ones", power_iterations=3, budget=budget)
    _, _, matrix = dense(cells)
    z = np.ones(matrix.shape[1])
    for _ in range(4):
        last = z / np.linalg.norm(z)
        z = matrix.T @ (matrix @ last)
    assert np.isclose(found.singular_values[0], np.sqrt(z @ z / (z @ last)))
    approx = stacked(found.users, "userId") @ stacked(found.items, "movieId").T
    v = z / np.linalg.norm(z)
    assert np.allclose(approx, np.outer(matrix @ v, v))
    with pytest.raises(ValueError, match="one wide"):
        factorise.truncated_svd(cells, 2, start="ones")


def test_passes_send_only_touched_slices(spark, monkeypatch):
    """Many stored partitions and many items: what a pass sends follows tasks and touched slices."""
    cells = spark.createDataFrame([(u, 10_000 * (u % 2) + i, 1.0 + u % 3) for u in range(40) for i in range(5)], "userId INT, movieId INT, v DOUBLE")
    padding = spark.createDataFrame([(1000, m, 1.0) for m in range(100, 3000)], "userId INT, movieId INT, v DOUBLE")
    sent = []
    original = type(cells).mapInArrow

    def counted(self, function, schema, *rest, **more):
        frame = original(self, function, schema, *rest, **more)
        if schema == "part INT, block BINARY":
            sent.append(frame.count())
        return frame

    monkeypatch.setattr(type(cells), "mapInArrow", counted)
    monkeypatch.setattr(factorise, "matrix_partitions", lambda spark, nnz: 64)
    factorise.truncated_svd(cells.unionByName(padding), 2, oversample=2, power_iterations=1)
    folds = factorise._FOLDS_PER_CORE * spark.sparkContext.defaultParallelism
    slices = -(-2910 // factorise._SLICE)
    assert sent and sent[0] <= slices + 3 * folds < slices * 64
