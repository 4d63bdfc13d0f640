"""ANSI SQL for the registered queries, written for another engine over the same tables.

Adding 0.0 turns a negative zero, which the tables contain, into zero.
"""

from __future__ import annotations

from collections.abc import Sequence

SHIPMENTS = """
  SELECT l_returnflag AS entity, l_extendedprice AS m1, l_discount AS m2,
         CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month
  FROM lineitem
"""

EVENTS = """
  SELECT ts AS datetime, event_type AS entity, value AS m1,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS m2,
         CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
         CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour
  FROM events
"""

ANNUAL = f"""
  SELECT year AS date, entity,
         round(avg(m1), 6) + 0.0 AS m1_mean, round(min(m1), 6) + 0.0 AS m1_min,
         round(max(m1), 6) + 0.0 AS m1_max,
         round(avg(m2), 6) + 0.0 AS m2_mean, round(min(m2), 6) + 0.0 AS m2_min,
         round(max(m2), 6) + 0.0 AS m2_max
  FROM ({SHIPMENTS}) GROUP BY year, entity
"""

def _annual(source: str) -> str:
    return ANNUAL.replace(SHIPMENTS, source)


def _monthly(source: str) -> str:
    return MONTHLY.replace(SHIPMENTS, source)


MONTHLY_EXACT = f"""
  SELECT CAST(year AS VARCHAR) || '_' || lpad(CAST(month AS VARCHAR), 2, '0') AS date,
         avg(m1) AS m1_mean, avg(m2) AS m2_mean, year, month
  FROM ({SHIPMENTS}) GROUP BY year, month
"""

MONTHLY = f"""
  SELECT date, round(m1_mean, 6) + 0.0 AS m1_mean, round(m2_mean, 6) + 0.0 AS m2_mean, year, month
  FROM ({MONTHLY_EXACT})
"""


def _top5(column: str, way: str) -> str:
    return f"""
  SELECT date, round(m1_mean, 6) AS m1_mean, round(m2_mean, 6) AS m2_mean
  FROM (SELECT * FROM ({MONTHLY_EXACT}) WHERE {column} IS NOT NULL
        ORDER BY {column} {way}, date LIMIT 5)
"""


def _ranking(tag: str, way: str) -> str:
    return f"""
  SELECT '{tag}_{way}' AS rank_type,
         CAST(row_number() OVER (ORDER BY {tag}_mean {way}, date) AS INTEGER) AS rank_num,
         date, round(m1_mean, 6) AS m1_mean, round(m2_mean, 6) AS m2_mean
  FROM ({MONTHLY_EXACT}) WHERE {tag}_mean IS NOT NULL
"""


RANKINGS = "SELECT * FROM ({}) WHERE rank_num <= 5".format(
    " UNION ALL ".join(_ranking(tag, way) for tag in ("m1", "m2") for way in ("desc", "asc"))
)

PROFILE_EXACT = f"""
  SELECT entity, hour, avg(m1) AS m1_mean, avg(m2) AS m2_mean
  FROM ({EVENTS}) GROUP BY entity, hour
"""

PROFILE = f"""
  SELECT entity, hour, round(m1_mean, 6) AS m1_mean, round(m2_mean, 6) AS m2_mean
  FROM ({PROFILE_EXACT})
"""

FIVE_NUMBERS = " UNION ALL ".join(
    f"""
  SELECT entity, '{tag}' AS data, round(min({tag}_mean), 6) AS "min",
         round(quantile_cont({tag}_mean, 0.25), 6) AS "25-perc",
         round(quantile_cont({tag}_mean, 0.5), 6) AS "50-perc",
         round(quantile_cont({tag}_mean, 0.75), 6) AS "75-perc",
         round(max({tag}_mean), 6) AS "max"
  FROM ({PROFILE_EXACT}) GROUP BY entity
"""
    for tag in ("m1", "m2")
)

QUARTILES = " UNION ALL ".join(
    f"""
  SELECT entity, '{tag}' AS data, round(quantile_disc({tag}_mean, 0.25), 6) AS p25,
         round(quantile_disc({tag}_mean, 0.5), 6) AS p50,
         round(quantile_disc({tag}_mean, 0.75), 6) AS p75
  FROM ({PROFILE_EXACT}) GROUP BY entity
"""
    for tag in ("m1", "m2")
)

CURVE = f"SELECT year * 12 + month AS k, m1_mean, m2_mean FROM ({MONTHLY_EXACT})"

ELBOW = f"""
  WITH curve AS (SELECT k, m1_mean AS score FROM ({CURVE})),
  ends AS (SELECT min(k) AS x1, arg_min(score, k) AS y1, max(k) AS xn, arg_max(score, k) AS yn
           FROM curve)
  SELECT CAST(k AS INTEGER) AS k FROM curve, ends
  ORDER BY abs((yn - y1) * k - (xn - x1) * score + xn * y1 - yn * x1)
           / sqrt((yn - y1) * (yn - y1) + (xn - x1) * (xn - x1)) DESC, k LIMIT 1
"""

RUN_STATS = """
  SELECT l_returnflag AS query_name, l_linestatus AS query_type, l_linenumber AS num_executors,
         count(l_quantity) AS runs, avg(l_quantity) AS mean_seconds,
         stddev_samp(l_quantity) AS stddev_seconds
  FROM lineitem GROUP BY 1, 2, 3
"""

RUN_LOG = f"""
  SELECT query_name, query_type, round(mean_seconds, 4) AS avg_execution_time_seconds, num_executors
  FROM ({RUN_STATS})
"""


READING_QUARTILES = " UNION ALL ".join(
    f"""
  SELECT entity, '{tag}' AS data, count({tag}) AS n, round(min({tag}), 6) + 0.0 AS "min",
         round(quantile_cont({tag}, 0.25), 6) + 0.0 AS "25-perc",
         round(quantile_cont({tag}, 0.5), 6) + 0.0 AS "50-perc",
         round(quantile_cont({tag}, 0.75), 6) + 0.0 AS "75-perc",
         round(max({tag}), 6) + 0.0 AS "max"
  FROM ({EVENTS}) WHERE {tag} IS NOT NULL GROUP BY entity
"""
    for tag in ("m1", "m2")
)

# The third file has no column props.
MIXED = f"""
  SELECT datetime, entity, m1, CASE WHEN id % 3 <> 2 THEN m2 END AS m2, year, month, day, hour
  FROM ({EVENTS.replace("SELECT ts", "SELECT event_id AS id, ts")})
"""


def _json(text: Sequence[str] = (), numbers: Sequence[str] = (), order: Sequence[str] = ()) -> str:
    """A JSON object of text and number columns, without spaces, in the given order."""
    fields = []
    for name in order or (*text, *numbers):
        column = f'CAST("{name}" AS VARCHAR)'
        value = f"'\"' || {column} || '\"'" if name in text else f"coalesce({column}, 'null')"
        fields.append(f"'\"{name}\":' || {value}")
    return "'{' || " + " || ',' || ".join(fields) + " || '}'"


def _pairs(source: str, key: str, value: str) -> str:
    return f"SELECT {key} AS key, {value} AS value FROM ({source})"


def _sweep(points: str) -> str:
    """Common table expressions of the sweep over (entity, x): fits by seed and k, from the values that
    come first by a hash, then labels, statistics of clusters, the best seed and the curve."""
    return f"""
  RECURSIVE points AS ({points}),
  drawn AS (
    SELECT seed, x, row_number() OVER (
      PARTITION BY seed ORDER BY md5(seed || ':' || CAST(floor(x * 1000) AS BIGINT)), x) AS place
    FROM (SELECT DISTINCT x FROM points), (VALUES (1), (2), (3)) AS seeds(seed)),
  ks AS (SELECT CAST(unnest(range(2, least(15, (SELECT count(*) FROM points)) + 1)) AS INTEGER) AS k),
  fit AS (
    SELECT 0 AS pass, seed, k, list(x ORDER BY x) AS centers, true AS open
    FROM drawn JOIN ks ON place <= k GROUP BY seed, k
    UNION ALL
    SELECT pass + 1, seed, k, moved,
           list_max(list_transform(list_zip(centers, moved), lambda p: abs(p[1] - p[2]))) > 1e-4
    FROM (
      SELECT pass, seed, k, centers,
             list_transform(centers, lambda c, i: coalesce(means[i], c)) AS moved
      FROM (
        SELECT pass, seed, k, centers, map_from_entries(list((label, mean))) AS means
        FROM (
          SELECT pass, seed, k, centers, list_position(ways, list_min(ways)) AS label, avg(x) AS mean
          FROM (SELECT f.*, x, list_transform(centers, lambda c: abs(x - c)) AS ways
                FROM fit f, points WHERE open AND pass < 20)
          GROUP BY pass, seed, k, centers, label)
        GROUP BY pass, seed, k, centers))),
  final AS (SELECT seed, k, list_sort(arg_max(centers, pass)) AS centers FROM fit GROUP BY seed, k),
  labels AS (
    SELECT entity, x, seed, k, CAST(list_position(ways, list_min(ways)) - 1 AS INTEGER) AS cluster
    FROM (SELECT entity, x, seed, k, list_transform(centers, lambda c: abs(x - c)) AS ways
          FROM final, points)),
  clusters AS (
    SELECT seed, k, cluster, count(*) AS n, avg(x) AS mean, count(*) * var_pop(x) AS m2
    FROM labels GROUP BY seed, k, cluster),
  costs AS (SELECT seed, k, sum(m2) AS wcss, count(*) AS found FROM clusters GROUP BY seed, k),
  best AS (
    SELECT * FROM costs QUALIFY row_number() OVER (PARTITION BY k ORDER BY wcss, seed) = 1),
  sides AS (
    SELECT l.seed, l.k, l.entity,
           max(CASE WHEN l.cluster = c.cluster THEN c.n END) AS own,
           max(CASE WHEN l.cluster = c.cluster AND c.n > 1
                    THEN (pow(x - mean, 2) + m2 / c.n) * c.n / (c.n - 1) END) AS a,
           min(CASE WHEN l.cluster <> c.cluster THEN pow(x - mean, 2) + m2 / c.n END) AS b
    FROM labels l JOIN best USING (seed, k) JOIN clusters c USING (seed, k)
    GROUP BY l.seed, l.k, l.entity),
  curve AS (
    SELECT k, wcss, CASE WHEN found > 1 THEN silhouette END AS silhouette
    FROM best JOIN (
      SELECT seed, k, avg(CASE WHEN own = 1 OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END)
             AS silhouette
      FROM sides GROUP BY seed, k) USING (seed, k)),
  ends AS (SELECT min(k) AS x1, arg_min(wcss, k) AS y1, max(k) AS xn, arg_max(wcss, k) AS yn FROM curve),
  elbow AS (
    SELECT k FROM curve, ends
    ORDER BY abs((yn - y1) * k - (xn - x1) * wcss + xn * y1 - yn * x1) DESC, k LIMIT 1),
  silhouette AS (SELECT k FROM curve ORDER BY silhouette DESC, k LIMIT 1)
"""


def expected_sql(centers: Sequence[float], year: int) -> dict[str, str]:
    means_exact = f"""
  SELECT user_id AS entity, avg(value) AS m1_mean FROM events
  WHERE year(ts) = {year} GROUP BY user_id HAVING avg(value) IS NOT NULL
"""
    means = f"SELECT entity, round(m1_mean, 6) AS m1_mean FROM ({means_exact})"
    center_rows = ", ".join(f"({i}, {c})" for i, c in enumerate(centers))
    labels_exact = f"""
  SELECT entity, m1_mean,
         (SELECT CAST(arg_min(i, (pow(m1_mean - c, 2), i)) AS INTEGER)
          FROM (VALUES {center_rows}) AS centers(i, c)) AS cluster
  FROM ({means_exact})
"""
    labels = f"SELECT entity, round(m1_mean, 6) AS m1_mean, cluster FROM ({labels_exact})"
    every_entity = f"SELECT entity, m1_mean, true AS nearest FROM ({means})"
    every_k = f"""
  SELECT CAST(unnest(range(2, least(15, (SELECT count(*) FROM ({means}) WHERE m1_mean IS NOT NULL)) + 1))
              AS INTEGER) AS k, true AS agrees
"""
    wcss = f"""
  WITH labelled AS ({labels_exact}),
  centroids AS (SELECT cluster, avg(m1_mean) AS c FROM labelled GROUP BY cluster)
  SELECT CAST(count(DISTINCT cluster) AS INTEGER) AS k, round(sum(pow(m1_mean - c, 2)), 6) AS score
  FROM labelled JOIN centroids USING (cluster)
"""
    silhouette = f"""
  WITH labelled AS ({labels_exact}),
  clusters AS (SELECT cluster AS other, count(*) AS n, avg(m1_mean) AS c,
                      avg(m1_mean * m1_mean) AS c2 FROM labelled GROUP BY cluster),
  distances AS (
    SELECT entity, cluster, other, n,
           m1_mean * m1_mean - 2 * m1_mean * c + c2 AS mean_distance
    FROM labelled, clusters),
  sides AS (
    SELECT entity,
           max(CASE WHEN other = cluster AND n > 1 THEN mean_distance * n / (n - 1) END) AS a,
           min(CASE WHEN other <> cluster THEN mean_distance END) AS b
    FROM distances GROUP BY entity)
  SELECT CAST((SELECT count(*) FROM clusters) AS INTEGER) AS k,
         round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS score
  FROM sides
"""
    clusters_json = _json((), ["entity", "m1_mean", "cluster"])
    sweep = _sweep(f"SELECT entity, m1_mean AS x FROM ({means_exact})")
    swept = {
        method: f"""
  WITH {sweep}
  SELECT entity, round(x, 6) AS m1_mean, cluster
  FROM labels JOIN best USING (seed, k) WHERE k = (SELECT k FROM {method})
"""
        for method in ("elbow", "silhouette")
    }
    swept_curve = f"""
  WITH {sweep} SELECT k, round(wcss, 6) AS wcss, round(silhouette, 6) AS silhouette FROM curve
"""
    annual_json = _json(
        ["entity"],
        order=["date", "entity", "m1_mean", "m1_min", "m1_max", "m2_mean", "m2_min", "m2_max"],
    )
    before, after = (
        _pairs(_annual(f"{SHIPMENTS} WHERE {which}"), "'q1:' || date || ':' || entity", annual_json)
        for which in ("l_shipdate < '1996-07-01'", "l_shipdate >= '1993-01-01'")
    )
    changed = f"""
  SELECT coalesce(n.key, o.key) AS key, n.value AS value,
         CASE WHEN n.key IS NULL THEN 'delete' ELSE 'set' END AS change
  FROM ({after}) n FULL JOIN ({before}) o ON n.key = o.key
  WHERE n.key IS NULL OR o.key IS NULL OR n.value <> o.value
"""
    month_json = _json(["date"], ["m1_mean", "m2_mean", "year", "month"])
    hourly = f"""
  SELECT *, lpad(CAST(hour AS VARCHAR), 2, '0') AS hh,
         '2021-01-01T' || lpad(CAST(hour AS VARCHAR), 2, '0') || ':00:00Z' AS time
  FROM ({PROFILE})
"""
    points = f"SELECT k, round(m1_mean, 6) AS score FROM ({CURVE})"
    return {
        "prep_readings": EVENTS,
        "prep_mixed_shapes": MIXED,
        "incremental_prep": EVENTS,
        "state_annual": _annual(EVENTS),
        "state_monthly": _monthly(EVENTS),
        "state_hourly": PROFILE,
        "reading_quartiles": READING_QUARTILES,
        "kv_delta": changed,
        "merged_run_stats": f"""
  SELECT query_name, query_type, num_executors, runs, round(mean_seconds, 6) AS mean_seconds,
         round(stddev_seconds, 6) AS stddev_seconds FROM ({RUN_STATS})""",
        "drop_if_exists": "SELECT event_id, ts, user_id, event_type, value FROM events",
        "scan_entity_subset": f"""
  SELECT entity, year, month, m1, m2 FROM ({SHIPMENTS}) WHERE entity IN ('A', 'R')""",
        "scan_single_entity": f"""
  SELECT entity, year, month, m1, m2 FROM ({SHIPMENTS}) WHERE entity = 'R'""",
        "empty_input_guard": f"""
  SELECT user_id AS entity, avg(value) AS m1_mean, CAST(0 AS INTEGER) AS cluster
  FROM events WHERE year(ts) = 1900 GROUP BY user_id""",
        "rows_per_entity": "SELECT event_type AS entity, count(*) AS count FROM events GROUP BY 1",
        "row_count": "SELECT count(*) AS count FROM events",
        "partitioned_roundtrip": EVENTS,
        "annual_stats": ANNUAL,
        "annual_stats_sql": ANNUAL,
        "csv_roundtrip": ANNUAL,
        "monthly_means": MONTHLY,
        "top5_m1_desc": _top5("m1_mean", "DESC"),
        "top5_m1_asc": _top5("m1_mean", "ASC"),
        "top5_m2_desc": _top5("m2_mean", "DESC"),
        "top5_m2_asc": _top5("m2_mean", "ASC"),
        "monthly_top5": RANKINGS,
        "monthly_top5_sql": RANKINGS,
        "hourly_profile": PROFILE,
        "hourly_five_number": FIVE_NUMBERS,
        "hourly_five_number_sql": FIVE_NUMBERS,
        "hourly_quartiles_approx": QUARTILES,
        "entity_year_mean": means,
        "kmeans_features": means,
        "nearest_center_assign": labels,
        "wcss_sweep": every_k,
        "silhouette_sweep": every_k,
        "cluster_assignments": every_entity,
        "cluster_assignments_silhouette": every_entity,
        "lloyd_sweep": swept_curve,
        "lloyd_clusters_elbow": swept["elbow"],
        "lloyd_clusters_silhouette": swept["silhouette"],
        "kv_swept_clusters": _pairs(
            swept["silhouette"], "'clustering:silhouette:' || entity", clusters_json
        ),
        "kv_swept_curve": _pairs(swept_curve, "'elbow:' || k", _json((), ["k", "wcss"])),
        "wcss_given_labels": wcss,
        "silhouette_given_labels": silhouette,
        "elbow_select": ELBOW,
        "silhouette_select": f"""
  SELECT CAST(k AS INTEGER) AS k FROM ({CURVE}) WHERE m2_mean IS NOT NULL
  ORDER BY m2_mean DESC, k LIMIT 1""",
        "kv_annual_stats": _pairs(
            ANNUAL,
            "'q1:' || date || ':' || entity",
            _json(
                ["entity"],
                order=[
                    "date", "entity", "m1_mean", "m1_min", "m1_max", "m2_mean", "m2_min", "m2_max",
                ],
            ),
        ),
        "kv_monthly_ranks": _pairs(
            RANKINGS,
            "'q2:all:rank:' || rank_type || ':' || rank_num",
            _json(["date"], ["m1_mean", "m2_mean"]),
        ),
        "kv_monthly_means": _pairs(MONTHLY, "'q2:all:monthly_avg:' || date", month_json),
        "kv_hourly_stats": _pairs(
            FIVE_NUMBERS,
            "'q3:stats:' || entity || ':' || data",
            _json((), ["min", "25-perc", "50-perc", "75-perc", "max"]),
        ),
        "kv_hourly_profile": _pairs(
            hourly,
            "'q3:hourly_avg:' || entity || ':' || hh",
            _json(["entity", "time"], order=["entity", "hour", "m1_mean", "m2_mean", "time"]),
        ),
        "kv_clusters": _pairs(labels, "'clustering:silhouette:' || entity", clusters_json),
        "kv_clusters_elbow": _pairs(labels, "'clustering:elbow:' || entity", clusters_json),
        "kv_curve": _pairs(points, "'silhouette:' || k", _json((), ["k", "score"])),
        "kv_curve_elbow": _pairs(points, "'elbow:' || k", _json((), ["k", "score"])),
        "run_time_stats": f"""
  SELECT query_name, query_type, num_executors, runs, round(mean_seconds, 6) AS mean_seconds,
         round(stddev_seconds, 6) AS stddev_seconds FROM ({RUN_STATS})""",
        "run_log_roundtrip": RUN_LOG,
        "kv_run_times": _pairs(
            RUN_LOG,
            "'performance:' || query_name || ':' || query_type || ':' || num_executors",
            _json(
                ["query_name", "query_type"],
                order=["query_name", "query_type", "avg_execution_time_seconds", "num_executors"],
            ),
        ),
    }
