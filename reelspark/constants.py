"""Fixed values and defaults that results depend on."""

# Rating scale.
MIN_RATING = 0.5
MAX_RATING = 5.0

# Columns every ratings file must carry.
REQUIRED_COLUMNS = ("userId", "movieId", "rating", "timestamp")
MOVIE_COLUMNS = ("movieId", "title", "genres")

# Training sample, holdout and model size; the caps apply only where a caller passes them.
USER_MOD_BASE = 6
USER_MOD_REMAINDER = 0
HOLDOUT_PCT = 10
N_COMPONENTS = 50
TRAIN_MAX_ROWS = 4_000_000
TRAIN_CHUNK_SIZE = 200_000
EVAL_CAP = 1_000
RANDOM_TEST_SHARE = 0.2
SEED = 42

# Popularity and cold-start thresholds.
MIN_POPULARITY = 20
MIN_POPULARITY_STRICT = 50
MIN_TOP_RATED = 100
MIN_QUALITY_SAMPLE = 10
QUALITY_SAMPLE_SIZE = 5_000
COLD_START_RATINGS = 5
MAX_CANDIDATES = 5_000
SAMPLE_RATINGS = 50_000

# Batches.
N_BATCHES = 250
BATCH_SIZE = 1_000
BATCH_PREFIX = "ratings_batch_"

# Labels found in served records, and what stands in for missing catalogue data.
UNKNOWN_TITLE = "Movie "
UNKNOWN_GENRES = "Unknown"
SERVED_POPULAR = "popularity_fallback"
SERVED_PERSONAL = "personalized_mlflow"
SERVED_LOCAL = "personalized_local_svd"
SERVED_PAIR = "mlflow"
SERVED_PAIR_LOCAL = "local"

MODEL_NAME = "movie_recommender_svd"
PRODUCTION_ALIAS = "production"
STAGING_ALIAS = "staging"

# Fixed value: drift test level.
DRIFT_ALPHA = 0.05

# Ceiling for anything this library broadcasts on purpose.
BROADCAST_BYTES = 64 * 1024 * 1024
