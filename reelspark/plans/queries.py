"""Registered queries: name -> (spark, folder) -> DataFrame, over the whole supplied tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from reelspark import constants as C
from reelspark.functions.scalar import file_stem, in_user_sample, is_holdout, round_binary
from reelspark.operators import drift, evaluate, factorise, ingest, model, popular, profile, recommend, registry, rollup, sampling
from reelspark.operators.ordering import expand_copies
from reelspark.session import materialise, shared_folder
from reelspark.sources import files, store, tables
from reelspark.sources.store import RatingsStore
from reelspark.streaming.intake import run_intake

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}

ROW_ORDER = ["userId", "movieId", "timestamp", "rating"]


def register(query: Query) -> Query:
    REGISTRY[query.__name__] = query
    return query


def register_both_ranks(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Register a model query at full rank, and as ``<name>_rank1``."""
    name = {"recommend_all": "recommend"}.get(query.__name__, query.__name__)
    REGISTRY[name] = lambda spark, sf: query(spark, sf)
    REGISTRY[f"{name}_rank1"] = lambda spark, sf: query(spark, sf, **RANK1)
    return query


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({name: round_binary(F.col(name), digits) for name in columns})


def renamed(df: DataFrame) -> DataFrame:
    """Report names for the table's column names."""
    return df.withColumnsRenamed({"userId": "user_id", "movieId": "movie_id", "timestamp": "ts"})


# --- sources, sinks, ingestion ---------------------------------------------------


@register
def scan_ratings(spark, sf):
    return renamed(tables.ratings(spark, sf))


@register
def all_movie_ids(spark, sf):
    return renamed(tables.movies(spark, sf).select("movieId"))


@register
def train_rows_capped(spark, sf):
    train = sampling.train_rows(tables.ratings(spark, sf), base=1)
    return renamed(sampling.capped_train_rows(train, max_rows=9_000, chunk=2_000))


@register
def ingest_append(spark, sf):
    """Each delivery appended to one table: rows written, and what the table holds after it."""
    rows = materialise(tables.tagged_ratings(spark, sf))
    path = f"{shared_folder(spark)}/append-{uuid.uuid4().hex}"
    found = []
    for row in rows.select("batch_id").distinct().orderBy("batch_id").collect():
        inserted = store.append_ratings(rows.where(F.col("batch_id") == row["batch_id"]), path)
        total = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.sum("rating").alias("s")).first()
        found.append((row["batch_id"], inserted, total["n"], total["s"]))
    report = spark.createDataFrame(found, "batch_id STRING, inserted BIGINT, total BIGINT, sum_rating DOUBLE")
    return rounded(report, "sum_rating")


@register
def tag_batch(spark, sf):
    """Rows tagged with the stem of the file each was read from."""
    rows = tables.table(spark, sf, "lineitem").withColumn("_path", F.col("_metadata.file_path"))
    # A table may be a folder of files; its own name is the batch.
    batch = file_stem(F.regexp_replace("_path", r"\.parquet/.*$", ".parquet"))
    tagged = rows.select("l_orderkey", "l_partkey", "l_linenumber", batch.alias("batch_id"))
    return tagged.withColumnsRenamed({"l_orderkey": "order_id", "l_partkey": "movie_id", "l_linenumber": "line"})


@register
def upsert_ratings(spark, sf):
    merged = ingest.latest_by_key(tables.tagged_ratings(spark, sf), "batch_seq", "rating")
    return renamed(merged.select(*ROW_ORDER, "batch_id"))


@register
def batch_lineage(spark, sf):
    merged = ingest.latest_by_key(tables.tagged_ratings(spark, sf), "batch_seq", "rating")
    return profile.batch_lineage(merged)


@register
def stream_intake(spark, sf):
    """The deliveries as CSV files, taken in by the stream; the table they leave behind."""
    root = f"{shared_folder(spark)}/intake-{uuid.uuid4().hex}"
    rows = tables.tagged_ratings(spark, sf)
    files.write_batches_csv(rows, f"{root}/landing", F.col("batch_id"), ROW_ORDER)
    taken = RatingsStore(spark, f"{root}/store")
    run_intake(spark, taken, f"{root}/landing", f"{root}/processed", f"{root}/failed", f"{root}/progress")
    return renamed(taken.current().withColumn("rating", F.col("rating").cast("double")).select(*ROW_ORDER, "batch_id"))


def _merged_store(spark, sf):
    """The deliveries published one after another, merged after each but the last."""
    rows = materialise(tables.tagged_ratings(spark, sf), "batch_seq")
    kept = RatingsStore(spark, f"{shared_folder(spark)}/merged-{uuid.uuid4().hex}")
    kept.init_schema()
    numbers = sorted(row["batch_seq"] for row in rows.select("batch_seq").distinct().collect())
    for number in numbers:
        kept.publish(rows.where(F.col("batch_seq") == number).withColumn("imported_at", F.current_timestamp()))
        if number != numbers[-1]:
            kept.compact()
    return kept


def _merged_rows(current):
    return renamed(current.withColumn("rating", F.col("rating").cast("double")).select(*ROW_ORDER, "batch_id"))


@register
def merged_current(spark, sf):
    """The current table of a store whose batches are merged into buckets."""
    return _merged_rows(_merged_store(spark, sf).current())


@register
def merged_movie(spark, sf):
    """All ratings of the movie with most of them, through the store's grid."""
    kept = _merged_store(spark, sf)
    movie = profile.movie_counts(kept.current()).orderBy(F.col("n").desc(), "movieId").first()
    return _merged_rows(kept.current(movie=movie and movie["movieId"]))


@register
def merged_user(spark, sf):
    """All ratings of the user with most of them, through the store's grid."""
    kept = _merged_store(spark, sf)
    user = profile.user_counts(kept.current()).orderBy(F.col("n").desc(), "userId").first()
    return _merged_rows(kept.current(user=user and user["userId"]))


@register
def quarantine_rows(spark, sf):
    """A feed in which returned lines carry an unreadable rating and open ones no time."""
    feed = tables.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("userId"),
        F.col("l_partkey").cast("string").alias("movieId"),
        F.when(F.col("l_returnflag") == "R", F.lit("returned")).otherwise(F.lit("4.5")).alias("rating"),
        F.when(F.col("l_linestatus") == "F", F.lit("851990400")).alias("timestamp"),
    )
    rejected = ingest.rejected_rows(feed)
    return rejected.select(
        F.col("userId").alias("user_id"), F.col("movieId").alias("movie_id"), "rating", F.col("timestamp").alias("ts"), "reason"
    )


@register
def split_n_batches(spark, sf):
    pieces = ingest.split_by_count(tables.ratings(spark, sf), ROW_ORDER, C.N_BATCHES)
    return ingest.batch_report(pieces, ["userId", "movieId", "timestamp"])


@register
def split_files(spark, sf):
    """The batches as named files, written and read back."""
    pieces = ingest.split_by_count(tables.ratings(spark, sf).select(*ROW_ORDER), ROW_ORDER, C.N_BATCHES)
    rows = expand_copies(pieces, "copies")
    folder = f"{shared_folder(spark)}/split-{uuid.uuid4().hex}"
    files.write_batch_files(rows, folder, ingest.batch_label(F.col("batch_no"), C.N_BATCHES), ROW_ORDER)
    stem = F.regexp_replace(file_stem(F.col("_metadata.file_path")), r"-\d{4}$", "")
    back = files.read_text_csv(spark, folder).select("*", stem.alias("file"))
    typed = ingest.valid_rows(back, "file")
    return typed.groupBy("file").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("rating").alias("sum_rating"),
        F.sum(F.col("movieId").cast("bigint")).alias("sum_movie_id"),
        F.min("userId").alias("first_user"),
        F.max("userId").alias("last_user"),
    )


@register
def split_by_size(spark, sf):
    pieces = ingest.split_by_size(tables.ratings(spark, sf), ROW_ORDER, C.BATCH_SIZE)
    return ingest.batch_report(pieces, ["userId", "movieId", "timestamp"])


@register
def split_shuffled(spark, sf):
    pieces = ingest.split_by_size(tables.ratings(spark, sf), ROW_ORDER, C.BATCH_SIZE, shuffle_seed=C.SEED)
    return pieces.groupBy("batch_no").agg(
        F.sum("copies").alias("n"),
        F.sum(F.col("rating") * F.col("copies")).alias("sum_rating"),
        F.sum(F.col("movieId") * F.col("copies")).alias("sum_movie_id"),
    )


@register
def load_check(spark, sf):
    return rounded(profile.load_check(tables.ratings(spark, sf), tables.movies(spark, sf)), "avg_rating")


def _stats(spark, sf):
    return profile.movie_stats(tables.ratings(spark, sf), tables.movies(spark, sf))


@register
def top_most_rated(spark, sf):
    return profile.most_rated(_stats(spark, sf), 5).select("movie_id", "title", "avg_rating", "num_ratings")


@register
def dataset_fingerprint(spark, sf):
    return profile.fingerprint(tables.ratings(spark, sf))


# --- profile kept up by batch -------------------------------------------------------


def _kept_profile(spark, sf):
    """The deliveries published one after another, each taken into the profile by itself."""
    rows = materialise(tables.tagged_ratings(spark, sf), "batch_seq")
    kept = RatingsStore(spark, f"{shared_folder(spark)}/profiled-{uuid.uuid4().hex}")
    kept.init_schema()
    for number in sorted(row["batch_seq"] for row in rows.select("batch_seq").distinct().collect()):
        kept.publish(rows.where(F.col("batch_seq") == number).withColumn("imported_at", F.current_timestamp()))
        kept.update_profile()
    return materialise(kept.profile())


@register
def batch_overview(spark, sf):
    overview = rollup.overview(_kept_profile(spark, sf), tables.movies(spark, sf))
    return rounded(overview, "avg_rating", "rating_std")


@register
def batch_sparsity(spark, sf):
    return rounded(rollup.sparsity(_kept_profile(spark, sf)), "sparsity_pct", "density_pct")


@register
def batch_distribution(spark, sf):
    return rounded(rollup.distribution(_kept_profile(spark, sf)), "pct")


@register
def batch_cold_start(spark, sf):
    return rounded(rollup.cold_start(_kept_profile(spark, sf)), "pct")


@register
def batch_user_means(spark, sf):
    return renamed(rounded(rollup.entities(_kept_profile(spark, sf), "user"), "mean_rating"))


@register
def batch_version_ranges(spark, sf):
    """Rows and additive digest of each range of users."""
    return rollup.ranges(_kept_profile(spark, sf))


# --- samples and splits -----------------------------------------------------------


@register
def user_mod_sample(spark, sf):
    return renamed(sampling.user_sample(tables.ratings(spark, sf)))


@register
def holdout_split(spark, sf):
    return renamed(sampling.holdout_rows(tables.ratings(spark, sf), base=1))


@register
def train_split(spark, sf):
    return renamed(sampling.train_rows(tables.ratings(spark, sf), base=1))


@register
def random_split(spark, sf):
    return renamed(sampling.random_split(tables.ratings(spark, sf).select(*ROW_ORDER)))


@register
def known_id_filter(spark, sf):
    """Holdout rows whose user and movie the training rows know."""
    ratings = tables.ratings(spark, sf)
    train = sampling.train_rows(ratings, base=1)
    return renamed(sampling.known_ids(sampling.holdout_rows(ratings, base=1), train, train))


@register
def sample_ratings(spark, sf):
    return renamed(sampling.sample_rows(tables.ratings(spark, sf).select(*ROW_ORDER)))


@register
def sample_movies(spark, sf):
    sample = sampling.sample_rows(tables.ratings(spark, sf).select(*ROW_ORDER))
    return renamed(sampling.movies_in(tables.movies(spark, sf), sample))


@register
def rated_movie_ids(spark, sf):
    return renamed(profile.rated_movie_ids(tables.ratings(spark, sf), tables.users(spark, sf)))


@register
def movie_info(spark, sf):
    """Every movie or user number that occurs, so that some ids are unknown."""
    ratings = tables.ratings(spark, sf)
    ids = ratings.select("movieId").union(ratings.select((-F.col("userId") - 1).alias("movieId"))).distinct()
    return profile.movie_info(ids, tables.movies(spark, sf))


@register
def ratings_with_movies(spark, sf):
    return renamed(profile.ratings_with_movies(tables.ratings(spark, sf), tables.movies(spark, sf)))


@register
def movie_popularity_all(spark, sf):
    return renamed(profile.movie_popularity(tables.ratings(spark, sf), tables.movies(spark, sf)))


@register
def unrated_movies(spark, sf):
    return profile.unrated_counts(tables.users(spark, sf), tables.ratings(spark, sf), tables.movies(spark, sf))


@register
def item_index(spark, sf):
    return renamed(factorise.item_index(tables.ratings(spark, sf)))


@register
def distinct_users(spark, sf):
    return renamed(sampling.distinct_users(tables.ratings(spark, sf), base=1))


@register
def distinct_movies(spark, sf):
    return renamed(sampling.distinct_movies(tables.ratings(spark, sf)))


# --- profile ----------------------------------------------------------------------


@register
def dataset_overview(spark, sf):
    overview = profile.dataset_overview(tables.ratings(spark, sf), tables.movies(spark, sf))
    return rounded(overview, "avg_rating", "rating_std")


@register
def matrix_sparsity(spark, sf):
    return rounded(profile.matrix_sparsity(tables.ratings(spark, sf)), "sparsity_pct", "density_pct")


@register
def data_quality(spark, sf):
    return profile.data_quality(tables.ratings(spark, sf), tables.movies(spark, sf))


@register
def rating_distribution(spark, sf):
    return rounded(profile.rating_distribution(tables.ratings(spark, sf)), "pct")


@register
def modal_rating(spark, sf):
    return profile.modal_rating(tables.ratings(spark, sf))


@register
def user_counts(spark, sf):
    return renamed(profile.user_counts(tables.ratings(spark, sf)))


@register
def movie_counts(spark, sf):
    return renamed(profile.movie_counts(tables.ratings(spark, sf)))


@register
def cold_start_summary(spark, sf):
    return rounded(profile.cold_start_summary(tables.ratings(spark, sf)), "pct")


@register
def user_means(spark, sf):
    return renamed(rounded(profile.entity_means(tables.ratings(spark, sf), "userId"), "mean_rating"))


@register
def movie_means(spark, sf):
    return renamed(rounded(profile.entity_means(tables.ratings(spark, sf), "movieId"), "mean_rating"))


@register
def mean_of_means(spark, sf):
    return rounded(profile.mean_of_means(tables.ratings(spark, sf)), "mean_user_mean", "mean_movie_mean")


@register
def user_bias(spark, sf):
    return renamed(rounded(profile.entity_bias(tables.ratings(spark, sf), "userId"), "bias"))


@register
def movie_bias(spark, sf):
    return renamed(rounded(profile.entity_bias(tables.ratings(spark, sf), "movieId"), "bias"))


@register
def hist_user_counts(spark, sf):
    return profile.histogram(profile.user_counts(tables.ratings(spark, sf)), "n", 50)


@register
def hist_movie_counts(spark, sf):
    return profile.histogram(profile.movie_counts(tables.ratings(spark, sf)), "n", 50)


@register
def hist_user_means(spark, sf):
    return profile.histogram(profile.entity_means(tables.ratings(spark, sf), "userId"), "mean_rating", 30)


@register
def hist_movie_means(spark, sf):
    return profile.histogram(profile.entity_means(tables.ratings(spark, sf), "movieId"), "mean_rating", 30)


@register
def hist_user_bias(spark, sf):
    return profile.histogram(profile.entity_bias(tables.ratings(spark, sf), "userId"), "bias", 30)


@register
def movie_stats(spark, sf):
    return _stats(spark, sf)


@register
def top_popular10(spark, sf):
    return profile.most_rated(_stats(spark, sf), 10)


@register
def top_rated10(spark, sf):
    return profile.highest_rated(_stats(spark, sf))


@register
def top_rated10_min30(spark, sf):
    return profile.highest_rated(_stats(spark, sf), min_ratings=30)


@register
def popularity_vs_quality(spark, sf):
    return sampling.quality_sample(_stats(spark, sf)).select("movie_id", "num_ratings", "avg_rating")


@register
def user_top_rated(spark, sf):
    return profile.user_top_rated(tables.ratings(spark, sf), tables.movies(spark, sf))


@register
def train_global_mean(spark, sf):
    train = sampling.train_rows(tables.ratings(spark, sf), base=1)
    return rounded(train.agg(F.avg("rating").alias("global_mean"), F.count(F.lit(1)).alias("n")), "global_mean")


@register
def rating_cells_mean(spark, sf):
    return renamed(rounded(profile.rating_cells(tables.ratings(spark, sf)), "v"))


@register
def train_scope_batch(spark, sf):
    """Training rows and mean when only one batch is used, next to everything up to it."""
    train = tables.tagged_ratings(spark, sf).where(~is_holdout())
    per_batch = train.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.sum("rating").alias("s"))
    # One row per batch from here on.
    upto = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    report = per_batch.select(
        "batch_id",
        "n",
        (F.col("s") / F.col("n")).alias("batch_mean"),
        F.sum("n").over(upto).alias("cumulative_n"),
        (F.sum("s").over(upto) / F.sum("n").over(upto)).alias("cumulative_mean"),
    )
    return rounded(report, "batch_mean", "cumulative_mean")


# --- popularity and candidates ------------------------------------------------------


@register
def popular_movies(spark, sf):
    listed = popular.popular_movies(tables.ratings(spark, sf), tables.movies(spark, sf))
    return rounded(listed, "predicted_rating")


@register
def popular_endpoint(spark, sf):
    listed = popular.popular_endpoint(tables.ratings(spark, sf), tables.movies(spark, sf))
    return rounded(listed, "predicted_rating")


@register
def popular_min50(spark, sf):
    return rounded(popular.popular_strict(tables.ratings(spark, sf), tables.movies(spark, sf)), "avg_rating")


@register
def popular_min40(spark, sf):
    listed = popular.popular_strict(tables.ratings(spark, sf), tables.movies(spark, sf), min_count=40)
    return rounded(listed, "avg_rating")


@register
def candidate_movies(spark, sf):
    """Every user's whole candidate list, told by its length and by sums that depend on its order."""
    listed = recommend.candidate_movies(tables.users(spark, sf), tables.ratings(spark, sf), tables.movies(spark, sf))
    place = F.col("k").cast("bigint")
    return listed.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(place * F.col("movie_id")).alias("movie_sum"),
        F.sum(place * F.col("popularity")).alias("popularity_sum"),
    )


@register
def candidate_pool(spark, sf):
    return recommend.candidate_pool(tables.users(spark, sf), tables.ratings(spark, sf), tables.movies(spark, sf))


@register
def cold_user_recommendations(spark, sf):
    """Every account, plus one number nobody has, that falls below the threshold."""
    users = tables.users(spark, sf).union(spark.range(1).select(F.lit(999999).alias("userId")))
    served = recommend.cold_user_recommendations(users, tables.ratings(spark, sf), tables.movies(spark, sf))
    return rounded(served, "predicted_rating").drop("title", "genres")


@register
def recommend_unsampled(spark, sf):
    """Warm users outside the training sample: popularity order at the training mean."""
    ratings = tables.ratings(spark, sf)
    mean, _ = model.train_mean(sampling.train_rows(ratings))
    outside = tables.users(spark, sf).where(~in_user_sample())
    served = recommend.recommend_unknown(outside, ratings, tables.movies(spark, sf), mean)
    return rounded(served, "predicted_rating").drop("num_ratings", "served_by")


# --- model ------------------------------------------------------------------------


def _known_holdout(ratings, cap=None):
    train = sampling.train_rows(ratings, base=1)
    return sampling.latest_known_holdout(sampling.holdout_rows(ratings, base=1), train, train, cap)


@register
def centered_cells(spark, sf):
    train = sampling.train_rows(tables.ratings(spark, sf), base=1)
    mean = train.agg(F.avg("rating").alias("m")).scalar()
    return renamed(rounded(model.centered_cells(train, mean), "v"))


@register
def eval_pairs(spark, sf):
    """The newest thousand held-out rows that the training rows know."""
    return renamed(_known_holdout(tables.ratings(spark, sf), cap=C.EVAL_CAP))


@register
def evaluate_global_mean(spark, sf):
    ratings = tables.ratings(spark, sf)
    mean = sampling.train_rows(ratings, base=1).agg(F.avg("rating").alias("m")).scalar()
    return rounded(evaluate.evaluate_constant(_known_holdout(ratings), mean), "rmse", "mae")


@register
def evaluate_coverage(spark, sf):
    split = sampling.random_split(tables.ratings(spark, sf).select(*ROW_ORDER))
    return rounded(evaluate.coverage(split.where("is_test"), split.where(~F.col("is_test"))), "coverage")


@register
def bias_baseline(spark, sf):
    ratings = tables.ratings(spark, sf)
    pairs = ratings.select("userId", "movieId").distinct()
    return rounded(model.bias_baseline(pairs, ratings), "user_bias", "movie_bias", "predicted_rating")


# Rank 1 by plain power iteration: the form of the model that SQL can repeat.
RANK1 = {"k": 1, "oversample": 0, "start": "ones", "power_iterations": 3}


def _trained(spark, sf, **solver):
    ratings = materialise(tables.ratings(spark, sf))
    return ratings, model.train_svd(sampling.train_rows(ratings, base=1), **solver)


def _pivot_trained(spark, sf, **solver):
    # The split looks at its rows several times.
    ratings = materialise(tables.ratings(spark, sf).select(*ROW_ORDER))
    split = materialise(sampling.random_split(ratings))
    train = split.where(~F.col("is_test")).drop("is_test")
    cells = materialise(profile.rating_cells(train))
    return split, cells, model.train_svd_uncentered(cells, **solver)


@register_both_ranks
def svd_spectrum(spark, sf, **solver):
    _, trained = _trained(spark, sf, **solver)
    return rounded(model.spectrum(trained, spark), "singular_value")


@register
def svd_blocks_rank1(spark, sf):
    """The reconstruction by the form that never holds the item vectors whole."""
    return svd_reconstruction(spark, sf, **RANK1, budget=0, block_cells=20_000)


@register_both_ranks
def svd_reconstruction(spark, sf, **solver):
    ratings, trained = _trained(spark, sf, **solver)
    cells = model.centered_cells(sampling.train_rows(ratings, base=1), trained.global_mean)
    return rounded(model.reconstruction(trained, cells), "v", "approx")


@register_both_ranks
def svd_uncentered(spark, sf, **solver):
    _, _, trained = _pivot_trained(spark, sf, **solver)
    return rounded(model.spectrum(trained, spark), "singular_value")


@register_both_ranks
def predict_ratings(spark, sf, **solver):
    """Predictions for every held-out pair."""
    ratings, trained = _trained(spark, sf, **solver)
    pairs = sampling.holdout_rows(ratings, base=1).select("userId", "movieId").distinct()
    return renamed(rounded(model.predict(pairs, trained), "predicted_rating"))


@register_both_ranks
def predict_endpoint(spark, sf, **solver):
    ratings, trained = _trained(spark, sf, **solver)
    pairs = sampling.holdout_rows(ratings, base=1).select("userId", "movieId")
    return rounded(model.predict_record(pairs, tables.movies(spark, sf), trained), "predicted_rating")


@register_both_ranks
def predict_with_bias(spark, sf, **solver):
    ratings, trained = _trained(spark, sf, **solver)
    pairs = sampling.holdout_rows(ratings, base=1).select("userId", "movieId")
    scored = model.predict_with_bias(pairs, ratings, tables.movies(spark, sf), trained)
    parts = [round_binary(F.col("components")[p], 6).alias(p) for p in ("user_bias", "movie_bias", "svd_component")]
    return rounded(scored, "predicted_rating").select("*", *parts).drop("components")


@register_both_ranks
def evaluate_model(spark, sf, **solver):
    ratings, trained = _trained(spark, sf, **solver)
    return rounded(evaluate.evaluate(_known_holdout(ratings), trained), "rmse", "mae")


@register_both_ranks
def evaluate_uncentered(spark, sf, **solver):
    split, _, trained = _pivot_trained(spark, sf, **solver)
    metrics = evaluate.evaluate_uncentered(split.where("is_test"), trained)
    return rounded(metrics, "rmse", "mae", "mse", "coverage", "accuracy")


@register_both_ranks
def recommend_all(spark, sf, **solver):
    ratings, trained = _trained(spark, sf, **solver)
    served = recommend.recommend(tables.users(spark, sf), ratings, tables.movies(spark, sf), trained)
    return rounded(served, "predicted_rating")


@register_both_ranks
def recommend_uncentered(spark, sf, **solver):
    split, cells, trained = _pivot_trained(spark, sf, **solver)
    served = recommend.recommend_uncentered(
        tables.users(spark, sf), cells, split.drop("is_test"), tables.movies(spark, sf), trained
    )
    return rounded(served, "predicted_rating")


@register_both_ranks
def recommend_with_bias(spark, sf, **solver):
    ratings, trained = _trained(spark, sf, **solver)
    cells = profile.rating_cells(sampling.train_rows(ratings, base=1))
    served = recommend.recommend_with_bias(
        tables.users(spark, sf), cells, ratings, tables.movies(spark, sf), trained
    )
    return rounded(served, "predicted_rating")


@register_both_ranks
def sample_predictions(spark, sf, **solver):
    """Three recommendations for the users of ten sampled rating rows."""
    split, cells, trained = _pivot_trained(spark, sf, **solver)
    ratings = split.drop("is_test")
    users = sampling.sample_rows(ratings, 10).select("userId")
    served = recommend.recommend_uncentered(users, cells, ratings, tables.movies(spark, sf), trained, n=3)
    return rounded(served.select("user_id", "movie_id", "title", F.col("predicted_rating").alias("score")), "score")


@register_both_ranks
def recommendation_confidence(spark, sf, **solver):
    split, cells, trained = _pivot_trained(spark, sf, **solver)
    served = recommend.recommend_uncentered(
        tables.users(spark, sf), cells, split.drop("is_test"), tables.movies(spark, sf), trained
    )
    return rounded(recommend.recommendation_confidence(served), "confidence")


# --- drift ------------------------------------------------------------------------


def _drift_frames(spark, sf):
    """The first three deliveries against the later ones."""
    joined = profile.ratings_with_movies(tables.ratings_with_batch(spark, sf), tables.movies(spark, sf))
    return joined.where(F.col("batch_no") <= 3), joined.where(F.col("batch_no") > 3)


NUMERIC = ["userId", "movieId", "rating", "timestamp", "year"]
CATEGORICAL = ["genres", "title"]


@register
def drift_ks(spark, sf):
    return rounded(drift.drift_ks(*_drift_frames(spark, sf), NUMERIC), "ks", "p_value")


@register
def drift_chi2(spark, sf):
    return rounded(drift.chi2_statistics(*_drift_frames(spark, sf), CATEGORICAL), "chi2")


@register
def drift_report(spark, sf):
    return rounded(drift.drift_report(*_drift_frames(spark, sf), NUMERIC, CATEGORICAL), "statistic", "p_value")


# --- model lifecycle ----------------------------------------------------------------


def _runs(spark, sf):
    """One run per delivery: the mean of the training rows so far, scored on the holdout so far."""
    held = is_holdout()
    per_batch = tables.tagged_ratings(spark, sf).groupBy("batch_seq", "batch_id").agg(
        F.count_if(~held).alias("n"),
        F.coalesce(F.sum(F.when(~held, F.col("rating"))), F.lit(0.0)).alias("s"),
        F.count_if(held).alias("hn"),
        F.coalesce(F.sum(F.when(held, F.col("rating"))), F.lit(0.0)).alias("hs"),
        F.coalesce(F.sum(F.when(held, F.col("rating") * F.col("rating"))), F.lit(0.0)).alias("hq"),
    )
    # One row per batch from here on.
    upto = Window.partitionBy("name").orderBy("batch_seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = per_batch.withColumn("name", F.lit(C.MODEL_NAME)).select(
        "name",
        F.row_number().over(Window.partitionBy("name").orderBy("batch_seq")).alias("version"),
        F.concat(F.lit("run_"), "batch_id").alias("run_id"),
        *[F.sum(column).over(upto).alias(column) for column in ("n", "s", "hn", "hs", "hq")],
    )
    mean = F.col("s") / F.col("n")
    squared = F.col("hq") - 2 * mean * F.col("hs") + F.col("hn") * mean * mean
    return sums.select(
        "name", "version", "run_id", F.col("n").alias("n_train"), F.col("hn").alias("n_eval"), mean.alias("global_mean"),
        F.when(F.col("hn") > 0, round_binary(F.sqrt(squared / F.col("hn")), 6)).alias("metric"),
    )


@register
def run_log(spark, sf):
    return rounded(
        _runs(spark, sf).select("run_id", "n_train", "n_eval", "global_mean", F.col("metric").alias("rmse")), "global_mean"
    )


@register
def promotion_decisions(spark, sf):
    return registry.promotion_history(_runs(spark, sf)).select("run_id", "candidate", "champion", "promoted")


def _alias_events(runs):
    promoted = registry.promotion_events(registry.promotion_history(runs))
    return promoted.unionByName(registry.registration_events(runs, C.STAGING_ALIAS))


@register
def alias_resolution(spark, sf):
    return registry.current_aliases(_alias_events(_runs(spark, sf))).select("alias", "version")


@register
def latest_version_of_run(spark, sf):
    return registry.latest_version_of_run(_runs(spark, sf)).select("run_id", "version")


@register
def model_status(spark, sf):
    runs = _runs(spark, sf)
    log = runs.select("run_id", F.create_map(F.lit("rmse"), F.col("metric")).alias("metrics"))
    versions = runs.select("version", "run_id", F.lit(None).cast("timestamp").alias("created_at"))
    return registry.model_status(log, versions, _alias_events(runs)).drop("last_trained")

