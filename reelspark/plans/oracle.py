"""The same results in plain SQL over the supplied tables."""

from __future__ import annotations

R = """r AS (SELECT CAST(o_custkey AS INT) AS u, CAST(l_partkey AS INT) AS m,
  CAST(0.5 + 0.5 * ((CAST(l_quantity AS INT) - 1) % 10) AS DOUBLE) AS rating,
  CAST(epoch(o_orderdate) AS BIGINT) AS ts, CAST(l_linenumber AS INT) AS b,
  'ratings_batch_' || lpad(CAST(l_linenumber AS VARCHAR), 3, '0') AS batch_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

M = """m AS (SELECT CAST(p_partkey AS INT) AS m, concat(p_name, ' (', CAST(1950 + p_size AS VARCHAR), ')') AS title,
  concat_ws('|', p_type, p_brand) AS genres FROM part)"""

USERS = "users AS (SELECT CAST(c_custkey AS INT) AS u FROM customer)"

# Standard CRC-32 (polynomial 0xEDB88320) built from the byte table.
H = """t(i, x, k) AS (SELECT i, CAST(i AS BIGINT), 0 FROM range(256) q(i) UNION ALL
  SELECT i, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, k + 1 FROM t WHERE k < 8),
tab AS (SELECT list(x ORDER BY i) AS tb FROM t WHERE k = 8),
pairs AS (SELECT DISTINCT u, m, concat(u, ':', m, ':timestamp') AS s FROM r),
held AS (SELECT u, m, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
    list_transform(range(1, length(s) + 1), lambda p: CAST(ascii(substr(s, CAST(p AS BIGINT), 1)) AS BIGINT))),
    lambda a, c: xor(a >> 8, tb[(xor(a, c) & 255) + 1])), CAST(4294967295 AS BIGINT)) % 100 < 10 AS hold
  FROM pairs, tab),
h AS (SELECT r.*, hold FROM r JOIN held USING (u, m))"""

ROW = "u AS user_id, m AS movie_id, rating, ts"
LENGTHED = ", ".join(f"concat(length(CAST({c} AS VARCHAR)), ':', {c})" for c in ("u", "m", "rating", "ts"))
ROW_HASH = "md5(concat_ws(':', '42', u, m, ts, rating))"


def _with(*parts: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)} "


def _crc(*parts: str) -> str:
    return _with(R, H, *parts, recursive=True)


STATS = """stats AS (SELECT m.m AS movie_id, title, genres, count(*) AS num_ratings, round_even((avg(rating)) * 100, 0) / 100 AS avg_rating,
  round_even((stddev_samp(rating)) * 100, 0) / 100 AS rating_std FROM r JOIN m USING (m) GROUP BY ALL)"""

SPLIT = f"""s AS (SELECT u, m, rating, ts, row_number() OVER (ORDER BY {ROW_HASH}, u, m, ts, rating)
  <= ceil(0.2 * count(*) OVER ()) AS is_test FROM r)"""

SAMPLE = f"s AS (SELECT u, m, rating, ts FROM r ORDER BY {ROW_HASH}, u, m, ts, rating LIMIT 50000)"

LATEST = """latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY u, m, ts ORDER BY b DESC, rating DESC) AS k
  FROM r) WHERE k = 1)"""

RANKED = """pop AS (SELECT m, count(*) AS popularity FROM r JOIN m USING (m) GROUP BY m HAVING count(*) >= 20)"""

CANDIDATES = """c AS (SELECT users.u, pop.m, popularity,
  row_number() OVER (PARTITION BY users.u ORDER BY popularity DESC, pop.m) AS k
  FROM users, pop WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.u = users.u AND r.m = pop.m))"""

KNOWN = "u IN (SELECT u FROM h WHERE NOT hold) AND m IN (SELECT m FROM h WHERE NOT hold)"

EVAL = f"""e AS (SELECT u, m, rating, ts FROM h WHERE hold ORDER BY ts DESC, u, m, rating LIMIT 3000),
ev AS (SELECT * FROM e WHERE {KNOWN} ORDER BY ts DESC, u, m, rating LIMIT 1000)"""

KNOWN_HELD = f"ev AS (SELECT u, m, rating, ts FROM h WHERE hold AND {KNOWN})"

FRAMES = """f AS (SELECT u, r.m, rating, ts, b, title, genres, CAST(right(title, 5)[1:4] AS INT) AS year FROM r JOIN m USING (m))"""

RUNS = """per AS (SELECT b, batch_id, count(*) FILTER (NOT hold) AS n, sum(rating) FILTER (NOT hold) AS s,
  count(*) FILTER (hold) AS hn, sum(rating) FILTER (hold) AS hs, sum(rating * rating) FILTER (hold) AS hq
  FROM h GROUP BY b, batch_id),
cum AS (SELECT CAST(row_number() OVER (ORDER BY b) AS INT) AS version, 'run_' || batch_id AS run_id,
  CAST(sum(n) OVER w AS BIGINT) AS n, sum(s) OVER w AS s, CAST(sum(hn) OVER w AS BIGINT) AS hn,
  sum(hs) OVER w AS hs, sum(hq) OVER w AS hq
  FROM per WINDOW w AS (ORDER BY b ROWS UNBOUNDED PRECEDING)),
runs AS (SELECT version, run_id, n AS n_train, hn AS n_eval, s / n AS global_mean,
  round_even((sqrt((hq - 2 * (s / n) * hs + hn * (s / n) * (s / n)) / hn)) * 1e6, 0) / 1e6 AS metric FROM cum),
hist AS (SELECT *, min(metric) OVER (ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS champion FROM runs),
decided AS (SELECT *, champion IS NULL OR isnan(champion) OR metric < champion AS promoted FROM hist),
aliases AS (SELECT 'production' AS alias, max(version) FILTER (promoted) AS version FROM decided
  UNION ALL SELECT 'staging', max(version) FROM decided)"""


def _histogram(values: str, bins: int) -> str:
    return f"""v AS ({values}), e AS (SELECT min(x) AS lo, max(x) AS hi FROM v)
SELECT CAST(least({bins}, 1 + floor((x - lo) * {bins} / (hi - lo))) AS INT) AS bin, count(*) AS n
FROM v, e GROUP BY 1"""


def _split_report(size: str) -> str:
    key = "concat_ws(':', u, m, ts)"
    return (
        _with(R)
        + f""", n AS (SELECT row_number() OVER (ORDER BY u, m, ts, rating) - 1 AS i, u, m, ts FROM r),
z AS (SELECT {size} AS size FROM r),
d AS (SELECT CAST(i // size + 1 AS INT) AS batch_no, i, u, m, ts FROM n, z)
SELECT batch_no, count(*) AS n, arg_min({key}, i) AS first_key, arg_max({key}, i) AS last_key FROM d GROUP BY batch_no"""
    )


def _ks_values() -> str:
    columns = {"userId": "u", "movieId": "m", "rating": "rating", "timestamp": "ts", "year": "year"}
    return " UNION ALL ".join(f"SELECT '{n}' AS col, CAST({c} AS DOUBLE) AS x, b FROM f" for n, c in columns.items())


def _popular(columns: str, having: int, order: str) -> str:
    return (
        _with(R, M)
        + f"""SELECT {columns} FROM (SELECT m.m AS movie_id, title, genres, avg(rating) AS a, count(*) AS c
FROM r JOIN m USING (m) GROUP BY ALL HAVING count(*) >= {having} ORDER BY {order} LIMIT 10)"""
    )


ROW_HASH_SPLIT = ROW_HASH  # the split keeps the columns in this order
GLOBAL = "g AS (SELECT avg(rating) AS a FROM h WHERE NOT hold)"
CENTRED = "c AS (SELECT u, m, sum(rating) - count(rating) * any_value(a) AS v FROM h, g WHERE NOT hold GROUP BY u, m)"
PIVOT = "c AS (SELECT u, m, avg(rating) AS v FROM s WHERE NOT is_test GROUP BY u, m)"


def _power(passes: int = 3) -> str:
    """Rank-1 factors of the cells c by power iteration from a vector of ones: uf, vf and sigma."""
    steps = ["z0 AS (SELECT m, 1 / sqrt(count(*) OVER ()) AS z FROM (SELECT DISTINCT m FROM c))"]
    for k in range(passes + 1):
        steps.append(f"y{k} AS (SELECT u, sum(v * z) AS y FROM c JOIN z{k} USING (m) GROUP BY u)")
        steps.append(f"w{k} AS (SELECT m, sum(v * y) AS w FROM c JOIN y{k} USING (u) GROUP BY m)")
        steps.append(f"z{k + 1} AS (SELECT m, w / sqrt(sum(w * w) OVER ()) AS z FROM w{k})")
    last = passes
    steps.append(f"sigma AS (SELECT sqrt(sum(w * w) / sum(w * z)) AS s FROM w{last} JOIN z{last} USING (m))")
    steps.append(f"vf AS (SELECT m, z AS f FROM z{last + 1})")
    steps.append("uf AS (SELECT u, sum(v * f) AS f FROM c JOIN vf USING (m) GROUP BY u)")
    return ", ".join(steps)


def _r6(value: str) -> str:
    return f"round_even(({value}) * 1e6, 0) / 1e6"


CENTRED_MODEL = (GLOBAL, CENTRED, _power())
PIVOT_MODEL = (SPLIT, PIVOT, _power())
CLIPPED = "greatest(0.5, least(5.0, a + coalesce(uf.f * vf.f, 0)))"

ALL_USERS = "users AS (SELECT CAST(c_custkey AS INT) AS u FROM customer)"
COUNTED = "cnt AS (SELECT u, count(*) AS n FROM r GROUP BY u)"

POPULAR_LIST = """p AS (SELECT m, title, genres, avg(rating) AS pa, count(*) AS pc FROM r JOIN m USING (m)
  GROUP BY ALL HAVING count(*) >= 20 ORDER BY pa DESC, pc DESC, m LIMIT 5),
pl AS (SELECT *, row_number() OVER (ORDER BY pa DESC, pc DESC, m) AS rank FROM p)"""

STRICT_LIST = """p AS (SELECT m, title, genres, avg(rating) AS pa, count(*) AS pc FROM s JOIN m USING (m)
  GROUP BY ALL HAVING count(*) >= 50 ORDER BY pa DESC, pc DESC, m LIMIT 10),
pl AS (SELECT *, row_number() OVER (ORDER BY pa DESC, pc DESC, m) AS rank FROM p)"""

# Every column of the matrix that a user has no cell in, best product first, lowest id on ties.
UNCENTERED = """cand AS (SELECT uf.u, vf.m, uf.f * vf.f AS score FROM uf, vf
  WHERE uf.u IN (SELECT u FROM users) AND NOT EXISTS (SELECT 1 FROM c WHERE c.u = uf.u AND c.m = vf.m)),
best AS (SELECT u, m, score, row_number() OVER (PARTITION BY u ORDER BY score DESC, m) AS rank FROM cand),
listed AS (SELECT u, rank, m, title, genres, score, NULL::BIGINT AS num_ratings FROM best JOIN m USING (m) WHERE rank <= {n}
  UNION ALL SELECT u, rank, m, title, genres, pa, pc FROM users, pl WHERE u NOT IN (SELECT u FROM uf))"""


def _rank1() -> dict[str, str]:
    spectrum = f"SELECT 1 AS component, {_r6('s')} AS singular_value FROM sigma"
    pairs = "(SELECT DISTINCT u, m FROM h WHERE hold) q LEFT JOIN uf USING (u) LEFT JOIN vf USING (m)"
    served = f"u AS user_id, CAST(rank AS INT) AS rank, m AS movie_id, title, genres, {_r6('score')} AS predicted_rating, num_ratings"
    biases = """ub AS (SELECT u, avg(rating) - (SELECT a FROM g) AS x FROM r GROUP BY u),
mb AS (SELECT m, avg(rating) - (SELECT a FROM g) AS y FROM r GROUP BY m)"""
    uncentered = (M, ALL_USERS, STRICT_LIST, UNCENTERED.format(n=10))
    return {
        "svd_spectrum_rank1": _crc(*CENTRED_MODEL) + spectrum,
        "svd_uncentered_rank1": _with(R, *PIVOT_MODEL) + spectrum,
        "svd_reconstruction_rank1": _crc(*CENTRED_MODEL)
        + f"SELECT u AS user_id, m AS movie_id, {_r6('v')} AS v, {_r6('uf.f * vf.f')} AS approx FROM c JOIN uf USING (u) JOIN vf USING (m)",
        "svd_blocks_rank1": _crc(*CENTRED_MODEL)
        + f"SELECT u AS user_id, m AS movie_id, {_r6('v')} AS v, {_r6('uf.f * vf.f')} AS approx FROM c JOIN uf USING (u) JOIN vf USING (m)",
        "predict_ratings_rank1": _crc(*CENTRED_MODEL)
        + f"SELECT u AS user_id, m AS movie_id, {_r6(CLIPPED)} AS predicted_rating FROM {pairs}, g",
        "predict_endpoint_rank1": _crc(M, *CENTRED_MODEL)
        + f"""SELECT q.u AS user_id, q.m AS movie_id, {_r6(CLIPPED)} AS predicted_rating, title, genres, 'mlflow' AS served_by
FROM {pairs} JOIN m ON m.m = q.m, g""",
        "predict_with_bias_rank1": _crc(M, *CENTRED_MODEL, biases)
        + f"""SELECT q.u AS user_id, q.m AS movie_id,
CASE WHEN known THEN {_r6('greatest(0.5, least(5.0, a + x + y + uf.f * vf.f))')} END AS predicted_rating, title, genres,
CASE WHEN uf.f IS NULL THEN concat('User ', q.u, ' not found') WHEN vf.f IS NULL THEN concat('Movie ', q.m, ' not found') END AS error,
CASE WHEN known THEN 'local' END AS served_by, CASE WHEN known THEN {_r6('x')} END AS user_bias,
CASE WHEN known THEN {_r6('y')} END AS movie_bias, {_r6('uf.f * vf.f')} AS svd_component
FROM {pairs} JOIN ub ON ub.u = q.u JOIN mb ON mb.m = q.m JOIN m ON m.m = q.m, g,
LATERAL (SELECT uf.f IS NOT NULL AND vf.f IS NOT NULL AS known) k""",
        "evaluate_model_rank1": _crc(*CENTRED_MODEL, KNOWN_HELD)
        + f"""SELECT {_r6('sqrt(avg((rating - p) * (rating - p)))')} AS rmse, {_r6('avg(abs(rating - p))')} AS mae, count(*) AS predictions
FROM (SELECT rating, {CLIPPED} AS p FROM ev LEFT JOIN uf USING (u) LEFT JOIN vf USING (m), g)""",
        "evaluate_uncentered_rank1": _with(R, *PIVOT_MODEL)
        + f""", t AS (SELECT rating - uf.f * vf.f AS e FROM s JOIN uf USING (u) JOIN vf USING (m) WHERE is_test),
x AS (SELECT avg(e * e) AS mse, avg(abs(e)) AS mae, count(*) AS n FROM t)
SELECT {_r6('sqrt(mse)')} AS rmse, {_r6('mae')} AS mae, {_r6('mse')} AS mse,
{_r6('n / (SELECT count(*) FROM s WHERE is_test)')} AS coverage, n AS n_predictions, {_r6('1 / (1 + sqrt(mse))')} AS accuracy FROM x""",
        "recommend_rank1": _crc(M, ALL_USERS, COUNTED, *CENTRED_MODEL, RANKED, CANDIDATES.replace("c AS", "cd AS", 1), POPULAR_LIST)
        + f""", warm AS (SELECT u FROM users JOIN cnt USING (u) WHERE n >= 5),
sc AS (SELECT cd.u, cd.m, CASE WHEN uf.f IS NULL THEN a ELSE {CLIPPED} END AS score,
  row_number() OVER (PARTITION BY cd.u ORDER BY CASE WHEN uf.f IS NULL THEN a ELSE {CLIPPED} END DESC, k) AS rank
  FROM cd JOIN warm ON warm.u = cd.u LEFT JOIN uf ON uf.u = cd.u LEFT JOIN vf ON vf.m = cd.m, g),
listed AS (SELECT u, rank, m, title, genres, score, NULL::BIGINT AS num_ratings, 'personalized_mlflow' AS served_by
  FROM sc JOIN m USING (m) WHERE rank <= 5
  UNION ALL SELECT u, rank, m, title, genres, pa, pc, 'popularity_fallback' FROM users, pl
  WHERE u NOT IN (SELECT u FROM warm) OR u NOT IN (SELECT u FROM cd))
SELECT {served}, served_by FROM listed""",
        "recommend_uncentered_rank1": _with(R, *PIVOT_MODEL, *uncentered) + f"SELECT {served} FROM listed",
        "recommendation_confidence_rank1": _with(R, *PIVOT_MODEL, *uncentered)
        + f"SELECT u AS user_id, {_r6('avg(score)')} AS confidence, count(*) AS n FROM listed GROUP BY u",
        "sample_predictions_rank1": _with(
            R, *PIVOT_MODEL, M, f"users AS (SELECT DISTINCT u FROM (SELECT u FROM s ORDER BY {ROW_HASH_SPLIT}, u, m, rating, ts LIMIT 10))",
            STRICT_LIST.replace("LIMIT 10", "LIMIT 3"), UNCENTERED.format(n=3),
        )
        + f"SELECT u AS user_id, m AS movie_id, title, {_r6('score')} AS score FROM listed",
        "recommend_with_bias_rank1": _crc(M, ALL_USERS, *CENTRED_MODEL, biases, POPULAR_LIST, "pv AS (SELECT DISTINCT u, m FROM c)")
        + f""", warm AS (SELECT u FROM pv GROUP BY u HAVING count(*) >= 5),
sc AS (SELECT uf.u, vf.m, greatest(0.5, least(5.0, a + x + y + uf.f * vf.f)) AS score,
  row_number() OVER (PARTITION BY uf.u ORDER BY greatest(0.5, least(5.0, a + x + y + uf.f * vf.f)) DESC, vf.m) AS rank
  FROM uf JOIN warm ON warm.u = uf.u JOIN ub ON ub.u = uf.u, vf JOIN mb ON mb.m = vf.m, g
  WHERE uf.u IN (SELECT u FROM users) AND NOT EXISTS (SELECT 1 FROM pv WHERE pv.u = uf.u AND pv.m = vf.m)),
listed AS (SELECT u, rank, m, title, genres, score, NULL::BIGINT AS num_ratings, 'personalized_local_svd' AS served_by
  FROM sc JOIN m USING (m) WHERE rank <= 5
  UNION ALL SELECT u, rank, m, title, genres, pa, pc, 'popularity_fallback' FROM users, pl WHERE u NOT IN (SELECT u FROM sc))
SELECT {served}, served_by FROM listed""",
    }


ORACLE: dict[str, str] = {
    "scan_ratings": _with(R) + f"SELECT {ROW} FROM r",
    "all_movie_ids": _with(M) + "SELECT m AS movie_id FROM m",
    "train_rows_capped": _crc() + f"SELECT {ROW} FROM h WHERE NOT hold ORDER BY u, m, ts, rating LIMIT 10000",
    "ingest_append": _with(R)
    + """, p AS (SELECT batch_id, count(*) AS inserted, sum(rating) AS s FROM r GROUP BY batch_id)
SELECT batch_id, inserted, CAST(sum(inserted) OVER w AS BIGINT) AS total, round_even((sum(s) OVER w) * 1e6, 0) / 1e6 AS sum_rating
FROM p WINDOW w AS (ORDER BY batch_id ROWS UNBOUNDED PRECEDING)""",
    "tag_batch": "SELECT l_orderkey AS order_id, l_partkey AS movie_id, l_linenumber AS line, 'lineitem' AS batch_id FROM lineitem",
    "upsert_ratings": _with(R, LATEST) + f"SELECT {ROW}, batch_id FROM latest",
    "stream_intake": _with(R, LATEST) + f"SELECT {ROW}, batch_id FROM latest",
    "merged_current": _with(R, LATEST) + f"SELECT {ROW}, batch_id FROM latest",
    "merged_movie": _with(R, LATEST)
    + f"SELECT {ROW}, batch_id FROM latest WHERE m = (SELECT m FROM latest GROUP BY m ORDER BY count(*) DESC, m LIMIT 1)",
    "merged_user": _with(R, LATEST)
    + f"SELECT {ROW}, batch_id FROM latest WHERE u = (SELECT u FROM latest GROUP BY u ORDER BY count(*) DESC, u LIMIT 1)",
    "batch_lineage": _with(R, LATEST)
    + "SELECT batch_id, count(*) AS n, sum(rating) AS sum_rating FROM latest GROUP BY batch_id",
    "quarantine_rows": """SELECT CAST(l_orderkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS movie_id,
CASE WHEN l_returnflag = 'R' THEN 'returned' ELSE '4.5' END AS rating,
CASE WHEN l_linestatus = 'F' THEN '851990400' END AS ts,
CASE WHEN l_returnflag = 'R' THEN 'malformed rating' ELSE 'missing timestamp' END AS reason
FROM lineitem WHERE l_returnflag = 'R' OR l_linestatus <> 'F'""",
    "split_n_batches": _split_report("ceil(count(*) / 250)::BIGINT"),
    "split_files": _with(R)
    + """, n AS (SELECT row_number() OVER (ORDER BY u, m, ts, rating) - 1 AS i, u, m, rating FROM r),
z AS (SELECT ceil(count(*) / 250)::BIGINT AS size FROM r)
SELECT 'ratings_batch_' || lpad(CAST(i // size + 1 AS VARCHAR), 3, '0') AS file, count(*) AS n, sum(rating) AS sum_rating,
CAST(sum(m) AS BIGINT) AS sum_movie_id, min(u) AS first_user, max(u) AS last_user FROM n, z GROUP BY 1""",
    "split_by_size": _split_report("max(1000)"),
    "split_shuffled": _with(R)
    + f"""SELECT CAST(i // 1000 + 1 AS INT) AS batch_no, count(*) AS n, sum(rating) AS sum_rating,
CAST(sum(m) AS BIGINT) AS sum_movie_id
FROM (SELECT row_number() OVER (ORDER BY {ROW_HASH.replace('ts, rating', 'rating, ts')}, u, m, ts, rating) - 1 AS i, m, rating FROM r)
GROUP BY 1""",
    "load_check": _with(R, M)
    + """SELECT count(*) AS ratings, round_even((avg(rating)) * 1e6, 0) / 1e6 AS avg_rating, (SELECT count(*) FROM m) AS movies FROM r""",
    "top_most_rated": _with(R, M, STATS)
    + "SELECT movie_id, title, avg_rating, num_ratings FROM stats ORDER BY num_ratings DESC, movie_id LIMIT 5",
    "dataset_fingerprint": _with(R)
    + f""", k AS (SELECT CAST('0x' || substr(md5(concat_ws('|', '42', {LENGTHED})), 1, 15) AS BIGINT) AS x FROM r)
SELECT count(*) AS n, bit_xor(x) AS xor_hash, CAST(sum(x) % 1000000007 AS BIGINT) AS sum_hash FROM k""",
    "user_mod_sample": _with(R) + f"SELECT {ROW} FROM r WHERE u % 6 = 0",
    "holdout_split": _crc() + f"SELECT {ROW} FROM h WHERE hold",
    "train_split": _crc() + f"SELECT {ROW} FROM h WHERE NOT hold",
    "random_split": _with(R, SPLIT) + f"SELECT {ROW}, is_test FROM s",
    "known_id_filter": _crc()
    + f"""SELECT {ROW} FROM h WHERE hold AND u IN (SELECT u FROM h WHERE NOT hold)
AND m IN (SELECT m FROM h WHERE NOT hold)""",
    "sample_ratings": _with(R, SAMPLE) + f"SELECT {ROW} FROM s",
    "sample_movies": _with(R, M, SAMPLE) + "SELECT m AS movie_id, title, genres FROM m WHERE m IN (SELECT m FROM s)",
    "rated_movie_ids": _with(R, USERS)
    + "SELECT DISTINCT u AS user_id, m AS movie_id FROM r WHERE u IN (SELECT u FROM users)",
    "movie_info": _with(R, M)
    + """, ids AS (SELECT m FROM r UNION SELECT -u - 1 FROM r)
SELECT ids.m AS movie_id, coalesce(title, concat('Movie ', ids.m)) AS title, coalesce(genres, 'Unknown') AS genres
FROM ids LEFT JOIN m ON ids.m = m.m""",
    "ratings_with_movies": _with(R, M, FRAMES) + f"SELECT {ROW}, title, genres, year FROM f",
    "movie_popularity_all": _with(R, M)
    + "SELECT m.m AS movie_id, count(r.rating) AS popularity FROM m LEFT JOIN r ON r.m = m.m GROUP BY m.m",
    "unrated_movies": _with(R, M, USERS)
    + """SELECT users.u AS user_id, count(m.m) AS n_unrated FROM users CROSS JOIN m
WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.u = users.u AND r.m = m.m) GROUP BY users.u""",
    "item_index": _with(R)
    + "SELECT m AS movie_id, CAST(row_number() OVER (ORDER BY m) - 1 AS INT) AS ix FROM (SELECT DISTINCT m FROM r)",
    "distinct_users": _with(R) + "SELECT DISTINCT u AS user_id FROM r",
    "distinct_movies": _with(R) + "SELECT DISTINCT m AS movie_id FROM r",
    "dataset_overview": _with(R, M)
    + """SELECT count(*) AS total_ratings, count(DISTINCT u) AS users, count(DISTINCT m) AS movies_rated,
(SELECT count(*) FROM m) AS catalog_size, round_even((avg(rating)) * 1e6, 0) / 1e6 AS avg_rating,
round_even((stddev_samp(rating)) * 1e6, 0) / 1e6 AS rating_std FROM r""",
    "matrix_sparsity": _with(R)
    + """, z AS (SELECT count(DISTINCT u) * count(DISTINCT m) AS possible, count(*) AS actual FROM r)
SELECT possible, actual, round_even(((1 - actual / possible) * 100) * 1e6, 0) / 1e6 AS sparsity_pct,
round_even((100 - (1 - actual / possible) * 100) * 1e6, 0) / 1e6 AS density_pct FROM z""",
    "data_quality": _with(R, M)
    + """SELECT CAST(count(*) FILTER (u IS NULL) + count(*) FILTER (m IS NULL) + count(*) FILTER (rating IS NULL)
  + count(*) FILTER (ts IS NULL) AS BIGINT) AS null_ratings,
(SELECT count(*) FILTER (m IS NULL) + count(*) FILTER (title IS NULL) + count(*) FILTER (genres IS NULL) FROM m) AS null_movies,
count(*) - (SELECT count(*) FROM (SELECT DISTINCT u, m FROM r)) AS duplicate_pairs,
count(*) FILTER (rating < 0.5 OR rating > 5.0) AS invalid_ratings FROM r""",
    "rating_distribution": _with(R)
    + """SELECT rating, count(*) AS n, round_even((count(*) * 100.0 / (SELECT count(*) FROM r)::DOUBLE) * 1e6, 0) / 1e6 AS pct
FROM r GROUP BY rating""",
    "modal_rating": _with(R) + "SELECT rating, count(*) AS n FROM r GROUP BY rating ORDER BY n DESC, rating LIMIT 1",
    "user_counts": _with(R) + "SELECT u AS user_id, count(*) AS n FROM r GROUP BY u",
    "movie_counts": _with(R) + "SELECT m AS movie_id, count(*) AS n FROM r GROUP BY m",
    "cold_start_summary": _with(R)
    + """, c AS (SELECT 'user' AS entity, count(*) AS n FROM r GROUP BY u
  UNION ALL SELECT 'movie', count(*) FROM r GROUP BY m)
SELECT entity, count(*) FILTER (n < 5) AS cold, count(*) AS total,
round_even((count(*) FILTER (n < 5) * 100.0 / count(*)::DOUBLE) * 1e6, 0) / 1e6 AS pct FROM c GROUP BY entity""",
    "user_means": _with(R) + "SELECT u AS user_id, round_even((avg(rating)) * 1e6, 0) / 1e6 AS mean_rating, count(*) AS n FROM r GROUP BY u",
    "movie_means": _with(R)
    + "SELECT m AS movie_id, round_even((avg(rating)) * 1e6, 0) / 1e6 AS mean_rating, count(*) AS n FROM r GROUP BY m",
    "mean_of_means": _with(R)
    + """SELECT round_even(((SELECT avg(a) FROM (SELECT avg(rating) AS a FROM r GROUP BY u))) * 1e6, 0) / 1e6 AS mean_user_mean,
round_even(((SELECT avg(a) FROM (SELECT avg(rating) AS a FROM r GROUP BY m))) * 1e6, 0) / 1e6 AS mean_movie_mean""",
    "user_bias": _with(R)
    + "SELECT u AS user_id, round_even((avg(rating) - (SELECT avg(rating) FROM r)) * 1e6, 0) / 1e6 AS bias FROM r GROUP BY u",
    "movie_bias": _with(R)
    + "SELECT m AS movie_id, round_even((avg(rating) - (SELECT avg(rating) FROM r)) * 1e6, 0) / 1e6 AS bias FROM r GROUP BY m",
    "hist_user_counts": _with(R) + ", " + _histogram("SELECT count(*)::DOUBLE AS x FROM r GROUP BY u", 50),
    "hist_movie_counts": _with(R) + ", " + _histogram("SELECT count(*)::DOUBLE AS x FROM r GROUP BY m", 50),
    "hist_user_means": _with(R) + ", " + _histogram("SELECT avg(rating) AS x FROM r GROUP BY u", 30),
    "hist_movie_means": _with(R) + ", " + _histogram("SELECT avg(rating) AS x FROM r GROUP BY m", 30),
    "hist_user_bias": _with(R)
    + ", "
    + _histogram("SELECT avg(rating) - (SELECT avg(rating) FROM r) AS x FROM r GROUP BY u", 30),
    "movie_stats": _with(R, M, STATS) + "SELECT * FROM stats",
    "top_popular10": _with(R, M, STATS) + "SELECT * FROM stats ORDER BY num_ratings DESC, movie_id LIMIT 10",
    "top_rated10": _with(R, M, STATS)
    + "SELECT * FROM stats WHERE num_ratings >= 100 ORDER BY avg_rating DESC, movie_id LIMIT 10",
    "top_rated10_min30": _with(R, M, STATS)
    + "SELECT * FROM stats WHERE num_ratings >= 30 ORDER BY avg_rating DESC, movie_id LIMIT 10",
    "popularity_vs_quality": _with(R, M, STATS)
    + """SELECT movie_id, num_ratings, avg_rating FROM stats WHERE num_ratings >= 10
ORDER BY md5(concat_ws(':', '42', movie_id)), movie_id LIMIT 5000""",
    "user_top_rated": _with(R, M)
    + """SELECT u AS user_id, CAST(k AS INT) AS rank, m.m AS movie_id, title, genres, rating FROM (
SELECT u, m, rating, row_number() OVER (PARTITION BY u ORDER BY rating DESC, m, ts) AS k
FROM r WHERE m IN (SELECT m FROM m)) x JOIN m USING (m) WHERE k <= 3""",
    "train_global_mean": _crc()
    + "SELECT round_even((avg(rating)) * 1e6, 0) / 1e6 AS global_mean, count(*) AS n FROM h WHERE NOT hold",
    "rating_cells_mean": _with(R) + "SELECT u AS user_id, m AS movie_id, round_even((avg(rating)) * 1e6, 0) / 1e6 AS v FROM r GROUP BY u, m",
    "train_scope_batch": _crc(
        "p AS (SELECT batch_id, count(*) AS n, sum(rating) AS s FROM h WHERE NOT hold GROUP BY batch_id)"
    )
    + """SELECT batch_id, n, round_even((s / n) * 1e6, 0) / 1e6 AS batch_mean, CAST(sum(n) OVER w AS BIGINT) AS cumulative_n,
round_even((sum(s) OVER w / sum(n) OVER w) * 1e6, 0) / 1e6 AS cumulative_mean
FROM p WINDOW w AS (ORDER BY batch_id ROWS UNBOUNDED PRECEDING)""",
    "popular_movies": _popular(
        "movie_id, title, genres, round_even((a) * 1e6, 0) / 1e6 AS predicted_rating, c AS num_ratings", 20, "a DESC, c DESC, movie_id"
    ),
    "popular_endpoint": _popular(
        "movie_id, title, genres, CAST(printf('%.2f', a) AS DOUBLE) AS avg_rating, c AS num_ratings, round_even((a) * 1e6, 0) / 1e6 AS predicted_rating",
        20,
        "a DESC, movie_id",
    ),
    "popular_min50": _popular(
        "movie_id, title, genres, round_even((a) * 1e6, 0) / 1e6 AS avg_rating, c AS rating_count", 50, "a DESC, c DESC, movie_id"
    ),
    "popular_min40": _popular(
        "movie_id, title, genres, round_even((a) * 1e6, 0) / 1e6 AS avg_rating, c AS rating_count", 40, "a DESC, c DESC, movie_id"
    ),
    "candidate_movies": _with(R, M, USERS, RANKED, CANDIDATES)
    + """SELECT u AS user_id, count(*) AS n, CAST(sum(k * m) AS BIGINT) AS movie_sum,
CAST(sum(k * popularity) AS BIGINT) AS popularity_sum FROM c GROUP BY u""",
    "candidate_pool": _with(R, M, USERS, RANKED, CANDIDATES)
    + """SELECT users.u AS user_id, CAST(count(c.m) AS INT) AS n_candidates,
CAST(coalesce(sum(popularity), 0) AS BIGINT) AS popularity_mass
FROM users LEFT JOIN c ON c.u = users.u GROUP BY users.u""",
    "cold_user_recommendations": _with(R, M, USERS)
    + """, cold AS (SELECT x.u FROM (SELECT u FROM users UNION SELECT 999999) x LEFT JOIN r ON r.u = x.u
  GROUP BY x.u HAVING count(r.rating) < 5),
p AS (SELECT m, avg(rating) AS a, count(*) AS c FROM r JOIN m USING (m) GROUP BY m HAVING count(*) >= 20
  ORDER BY a DESC, c DESC, m LIMIT 5),
k AS (SELECT *, CAST(row_number() OVER (ORDER BY a DESC, c DESC, m) AS INT) AS rank FROM p)
SELECT u AS user_id, rank, m AS movie_id, round_even((a) * 1e6, 0) / 1e6 AS predicted_rating, c AS num_ratings,
'popularity_fallback' AS served_by FROM cold CROSS JOIN k""",
    "recommend_unsampled": _crc(
        M,
        """users AS (SELECT CAST(c_custkey AS INT) AS u FROM customer WHERE c_custkey % 6 <> 0
  AND c_custkey IN (SELECT u FROM r GROUP BY u HAVING count(*) >= 5))""",
        RANKED,
        CANDIDATES,
    )
    + """SELECT c.u AS user_id, CAST(k AS INT) AS rank, c.m AS movie_id, title, genres,
(SELECT round_even((avg(rating)) * 1e6, 0) / 1e6 FROM h WHERE u % 6 = 0 AND NOT hold) AS predicted_rating
FROM c JOIN m ON m.m = c.m WHERE k <= 5""",
    "centered_cells": _crc("g AS (SELECT avg(rating) AS a FROM h WHERE NOT hold)")
    + """SELECT u AS user_id, m AS movie_id, round_even((sum(rating) - count(rating) * any_value(a)) * 1e6, 0) / 1e6 AS v
FROM h, g WHERE NOT hold GROUP BY u, m""",
    "eval_pairs": _crc(EVAL) + f"SELECT {ROW} FROM ev",
    "evaluate_global_mean": _crc(KNOWN_HELD, "g AS (SELECT avg(rating) AS a FROM h WHERE NOT hold)")
    + """SELECT round_even((sqrt(avg((rating - a) * (rating - a)))) * 1e6, 0) / 1e6 AS rmse, round_even((avg(abs(rating - a))) * 1e6, 0) / 1e6 AS mae,
count(*) AS predictions FROM ev, g""",
    "evaluate_coverage": _with(R, SPLIT)
    + """, q AS (SELECT count(*) FILTER (u IN (SELECT u FROM s WHERE NOT is_test)
  AND m IN (SELECT m FROM s WHERE NOT is_test)) AS n_predictions, count(*) AS n_test FROM s WHERE is_test)
SELECT n_predictions, n_test, round_even((n_predictions / n_test) * 1e6, 0) / 1e6 AS coverage FROM q""",
    "bias_baseline": _with(R)
    + """, g AS (SELECT avg(rating) AS a FROM r), ub AS (SELECT u, avg(rating) - (SELECT a FROM g) AS x FROM r GROUP BY u),
mb AS (SELECT m, avg(rating) - (SELECT a FROM g) AS y FROM r GROUP BY m)
SELECT u AS user_id, m AS movie_id, round_even((x) * 1e6, 0) / 1e6 AS user_bias, round_even((y) * 1e6, 0) / 1e6 AS movie_bias,
round_even((greatest(0.5, least(5.0, a + x + y))) * 1e6, 0) / 1e6 AS predicted_rating
FROM (SELECT DISTINCT u, m FROM r) JOIN ub USING (u) JOIN mb USING (m), g""",
    "drift_ks": _with(R, M, FRAMES)
    + f""", v AS ({_ks_values()}),
d AS (SELECT col, x, count(*) FILTER (b <= 3) AS nr, count(*) FILTER (b > 3) AS nc FROM v GROUP BY col, x),
w AS (SELECT col, sum(nr) OVER p / sum(nr) OVER (PARTITION BY col) AS fr, sum(nc) OVER p / sum(nc) OVER (PARTITION BY col) AS fc,
  sum(nr) OVER (PARTITION BY col) AS n1, sum(nc) OVER (PARTITION BY col) AS n2
  FROM d WINDOW p AS (PARTITION BY col ORDER BY x ROWS UNBOUNDED PRECEDING)),
k AS (SELECT col, max(abs(fr - fc)) AS ks, CAST(any_value(n1) AS BIGINT) AS n_ref, CAST(any_value(n2) AS BIGINT) AS n_cur
  FROM w GROUP BY col),
l AS (SELECT *, ks * sqrt(n_ref::DOUBLE * n_cur / (n_ref + n_cur)) AS lam FROM k),
q AS (SELECT *, CASE WHEN lam < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, 2 * list_sum(list_transform(range(1, 101),
  lambda j: CASE WHEN j % 2 = 1 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END * exp(-2.0::DOUBLE * j * j * lam * lam))))) END AS p FROM l)
SELECT col AS "column", round_even((ks) * 1e6, 0) / 1e6 AS ks, n_ref, n_cur, CAST(round_even((p) * 1e6, 0) / 1e6 AS DOUBLE) AS p_value, p < 0.05 AS drift FROM q""",
    "drift_chi2": _with(R, M, FRAMES)
    + """, v AS (SELECT 'genres' AS col, genres AS x, b FROM f UNION ALL SELECT 'title', title, b FROM f),
d AS (SELECT col, x, count(*) FILTER (b <= 3) AS nr, count(*) FILTER (b > 3) AS nc FROM v GROUP BY col, x),
z AS (SELECT col, sum(nr)::DOUBLE AS r, sum(nc)::DOUBLE AS c, count(*) - 1 AS dof FROM d GROUP BY col),
e AS (SELECT col, dof, nr, nc, (nr + nc) * r / (r + c) AS er, (nr + nc) * c / (r + c) AS ec FROM d JOIN z USING (col))
SELECT col AS "column", round_even((sum((nr - er) * (nr - er) / er + (nc - ec) * (nc - ec) / ec)) * 1e6, 0) / 1e6 AS chi2,
any_value(dof) AS dof FROM e GROUP BY col""",
    "run_log": _crc(RUNS)
    + "SELECT run_id, n_train, n_eval, round_even((global_mean) * 1e6, 0) / 1e6 AS global_mean, metric AS rmse FROM runs",
    "promotion_decisions": _crc(RUNS) + "SELECT run_id, metric AS candidate, champion, promoted FROM decided",
    "alias_resolution": _crc(RUNS) + "SELECT alias, version FROM aliases",
    "latest_version_of_run": _crc(RUNS) + "SELECT run_id, max(version) AS version FROM runs GROUP BY run_id",
    "model_status": _crc(RUNS)
    + """SELECT 'movie_recommender_svd' AS name, alias, true AS models_loaded, version, run_id, metric AS rmse
FROM aliases JOIN runs USING (version)""",
}

ORACLE.update(_rank1())

# The upper tail of the chi-square distribution as one minus the series of the lower one.
ORACLE["drift_report"] = f"""SELECT "column", 'ks' AS test, ks AS statistic, p_value, drift FROM ({ORACLE["drift_ks"]})
UNION ALL SELECT "column", 'chi2', chi2, CAST({_r6("p")} AS DOUBLE), p < 0.05 FROM (SELECT "column", chi2,
  greatest(0.0, 1 - list_sum(list_transform(range(0, CAST(chi2 AS BIGINT) + 2000),
    lambda n: exp((dof / 2 + n) * ln(chi2 / 2) - chi2 / 2 - lgamma(dof / 2 + n + 1))))) AS p
  FROM ({ORACLE["drift_chi2"]}))"""

# The profile kept up by batch is that of the newest row of every key: the same SQL over another r.
NEWEST = f"""{R.replace("r AS", "raw AS", 1)}, {LATEST.replace("FROM r)", "FROM raw)")},
r AS (SELECT u, m, rating, ts FROM latest)"""

for kept, whole in {
    "batch_overview": "dataset_overview",
    "batch_sparsity": "matrix_sparsity",
    "batch_distribution": "rating_distribution",
    "batch_cold_start": "cold_start_summary",
    "batch_user_means": "user_means",
}.items():
    ORACLE[kept] = ORACLE[whole].replace(R, NEWEST, 1)

_LENGTHED_BY_TIME = ", ".join(f"concat(length(CAST({c} AS VARCHAR)), ':', {c})" for c in ("u", "m", "ts", "rating"))
ORACLE["batch_version_ranges"] = (
    _with(NEWEST)
    + f"""SELECT u // 4096 AS range_no, count(*) AS n,
CAST(sum(CAST('0x' || substr(md5(concat_ws('|', '42', {_LENGTHED_BY_TIME})), 1, 15) AS HUGEINT)) % 1152921504606846976 AS BIGINT) AS digest
FROM r GROUP BY 1"""
)
