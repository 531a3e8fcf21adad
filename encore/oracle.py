"""Independent DuckDB SQL for every SQL-checkable query.

Each string runs on DuckDB with the raw test tables registered as views
(``events``, ``embeddings``, ``lineitem``, ``orders``, ...). The fixture
views are re-derived here in SQL, not taken from the Spark code. Column
names and types follow the Spark results (ranks INTEGER, scores DOUBLE).
"""

from __future__ import annotations

DAILY_CUTOFF = "TIMESTAMP '2024-01-25 00:00:00'"
HISTORY_SPLIT = "TIMESTAMP '2001-08-01 00:00:00'"
AS_OF = "DATE '2001-11-04'"

PLAYS = """plays AS (
  SELECT event_id, user_id,
         CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS BIGINT) AS track_id,
         CAST(ts AS TIMESTAMP) AS ts,
         CAST(value AS DECIMAL(18,2)) AS ms_played,
         CASE event_type WHEN 'purchase' THEN 'query' WHEN 'click' THEN 'rec'
                         WHEN 'view' THEN 'browsing' WHEN 'signup' THEN 'radio'
                         ELSE 'unknown' END AS reason_start,
         CAST(NULL AS VARCHAR) AS reason_end
  FROM events)"""

WEIGHT_EXPR = """CAST(CASE reason_start WHEN 'query' THEN 10 WHEN 'rec' THEN 5
                            WHEN 'browsing' THEN 5 WHEN 'radio' THEN 3 END AS DECIMAL(2,0))
       * CAST(ms_played AS DECIMAL(15,4))"""


def weighted(name: str, source: str) -> str:
    return f"""{name} AS (
  SELECT *, {WEIGHT_EXPR} AS weight FROM {source}
  WHERE reason_start IN ('query', 'rec', 'browsing', 'radio'))"""


DAILY = f"daily AS (SELECT * FROM plays WHERE ts >= {DAILY_CUTOFF})"
BEFORE = f"before AS (SELECT * FROM plays WHERE ts < {DAILY_CUTOFF})"

ACC = f"""{weighted('w_before', 'before')},
acc AS (
  SELECT user_id, track_id, max(ts) AS ts, CAST(sum(weight) AS DOUBLE) AS rating
  FROM w_before GROUP BY user_id, track_id)"""

HISTORY = """history AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS track_id,
         CAST(l.l_shipdate AS TIMESTAMP) AS ts, CAST(l.l_quantity AS DOUBLE) AS rating
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

VEC = """vec AS (
  SELECT vec_id AS track_id, CAST(embedding AS DOUBLE[]) AS features, label FROM embeddings)"""

SIMILAR = f"""{VEC},
sim_pairs AS (
  SELECT a.track_id, b.track_id AS similar_track_id,
         CAST(round(list_cosine_similarity(a.features, b.features), 6) AS DECIMAL(8,6))
           AS similarity,
         b.label AS similar_label
  FROM vec a JOIN vec b ON a.track_id <> b.track_id),
sim_top AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY track_id
                                      ORDER BY similarity DESC, similar_track_id) AS INTEGER)
              AS rank
    FROM sim_pairs) WHERE rank <= 10)"""

DISMISSALS = """dismissals AS (
  SELECT DISTINCT user_id,
         CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS BIGINT) AS track_id
  FROM events WHERE event_type = 'error')"""
OLD_DISMISSALS = f"""old_dismissals AS (
  SELECT DISTINCT user_id,
         CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS BIGINT) AS track_id
  FROM events WHERE event_type = 'error' AND CAST(ts AS TIMESTAMP) < {DAILY_CUTOFF})"""


def candidates(name: str, weighted_src: str) -> str:
    return f"""{name} AS (
  SELECT w.user_id, s.similar_track_id AS track_id,
         max(CAST(s.similarity AS DOUBLE) * CAST(w.weight AS DOUBLE)) AS score
  FROM {weighted_src} w JOIN sim_top s ON w.track_id = s.track_id
  GROUP BY w.user_id, s.similar_track_id)"""


def anti(name: str, source: str, dismissals: str) -> str:
    return f"""{name} AS (
  SELECT * FROM {source} c WHERE NOT EXISTS (
    SELECT 1 FROM {dismissals} d WHERE d.user_id = c.user_id AND d.track_id = c.track_id))"""


def top_n(name: str, source: str, n: int = 30, order: str = "score DESC") -> str:
    return f"""{name} AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY {order}, track_id)
                   AS INTEGER) AS rank
    FROM {source}) WHERE rank <= {n})"""


def today_and_prev(events_cte: str, n: int = 30) -> str:
    """CTEs up to ``top_today`` / ``top_prev`` for a given event source CTE."""
    return ",\n".join([
        weighted("w_today", events_cte), candidates("cand_today", "w_today"),
        anti("kept_today", "cand_today", "dismissals"), top_n("top_today", "kept_today", n),
        weighted("w_prev", "before"), candidates("cand_prev", "w_prev"),
        anti("kept_prev", "cand_prev", "old_dismissals"), top_n("top_prev", "kept_prev", n),
    ])


def final(n: int = 30) -> str:
    return f"""merged AS (
  SELECT user_id, track_id, max(score) AS score FROM (
    SELECT user_id, track_id, score FROM top_today
    UNION ALL SELECT user_id, track_id, score FROM top_prev
              WHERE user_id IN (SELECT user_id FROM top_today)) u
  GROUP BY user_id, track_id),
{anti("kept_merged", "merged", "dismissals")},
labelled AS (SELECT k.*, v.label FROM kept_merged k LEFT JOIN vec v ON v.track_id = k.track_id),
diverse AS (
  SELECT user_id, track_id, label, CAST(score AS DOUBLE) AS base_score,
         CAST(score AS DOUBLE) / row_number() OVER (PARTITION BY user_id, label
                                                    ORDER BY score DESC, track_id) AS score
  FROM labelled),
final AS (
  SELECT * FROM (
    SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, track_id)
                         AS INTEGER) AS rank,
           track_id, score, base_score
    FROM diverse) WHERE rank <= {n})"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def recs_ctes(events_cte: str = "daily", n: int = 30) -> str:
    return with_ctes(PLAYS, DAILY, BEFORE, SIMILAR, DISMISSALS, OLD_DISMISSALS,
                     today_and_prev(events_cte, n), final(n))


def today_ctes(events_cte: str = "daily", n: int = 30, order: str = "score DESC") -> str:
    return with_ctes(PLAYS, DAILY, SIMILAR, DISMISSALS, weighted("w_today", events_cte),
                     candidates("cand_today", "w_today"),
                     anti("kept_today", "cand_today", "dismissals"),
                     top_n("top_today", "kept_today", n, order))


EPOCH = "epoch_us(ts) // 1000000"
DAILY_LINE = f"""concat_ws(',', CAST(user_id AS VARCHAR), CAST(track_id AS VARCHAR),
  CAST({EPOCH} AS VARCHAR), CAST(ms_played AS VARCHAR), reason_start,
  coalesce(reason_end, 'null'))"""
RATING_LINE = f"""concat_ws(',', CAST(user_id AS VARCHAR), CAST(track_id AS VARCHAR),
  CAST({EPOCH} AS VARCHAR), CAST(CAST(rating AS DECIMAL(38,6)) AS VARCHAR))"""
PARSED_PLAYS = """SELECT user_id, track_id, date_trunc('second', ts) AS ts,
  CAST(ms_played AS DOUBLE) AS ms_played, reason_start, reason_end FROM plays"""

RECENT_FROM = "CAST(DATE '2001-11-04' - INTERVAL 3 YEAR AS TIMESTAMP)"
ACTIVE_FROM = "CAST(DATE '2001-11-04' - INTERVAL 6 MONTH AS TIMESTAMP)"
RECENT = f"recent AS (SELECT * FROM history WHERE ts >= {RECENT_FROM})"


def active_tracks(name: str, source: str, mode: str = "any") -> str:
    op = "AND" if mode == "any" else "OR"
    return f"""{name} AS (
  SELECT * FROM {source} WHERE track_id IN (
    SELECT track_id FROM {source} GROUP BY track_id
    HAVING count(*) >= 10 {op} max(ts) >= {ACTIVE_FROM}))"""


def active_users(name: str, source: str, n: int = 10) -> str:
    return f"""{name} AS (
  SELECT * FROM {source} WHERE user_id IN (
    SELECT user_id FROM {source} GROUP BY user_id HAVING count(*) >= {n}))"""


TRAINING = with_ctes(
    HISTORY,
    f"hacc AS (SELECT * FROM history WHERE ts < {HISTORY_SPLIT})",
    f"hdaily AS (SELECT * FROM history WHERE ts >= {HISTORY_SPLIT})",
    f"recent AS (SELECT * FROM hacc WHERE ts >= {RECENT_FROM})",
    active_tracks("t1", "recent"), active_users("u1", "t1"),
    """merged AS (
  SELECT user_id, track_id, max(ts) AS ts, CAST(sum(r) AS DOUBLE) AS rating FROM (
    SELECT user_id, track_id, ts, CAST(rating AS DECIMAL(38,6)) AS r FROM u1
    UNION ALL SELECT user_id, track_id, ts, CAST(rating AS DECIMAL(38,6)) AS r FROM hdaily) u
  GROUP BY user_id, track_id)""",
    active_tracks("t2", "merged"),
    """training AS (
  SELECT CAST(user_id AS INTEGER) AS user_id, CAST(track_id AS INTEGER) AS track_id, rating
  FROM t2)""")

#: Exact sums of doubles: each is scaled by 2**64 to an integer (the tables hold none below 2**-11), the
#: integers are added, and the sum's 61 leading bits, the last one set if anything below is, round as the whole does.
MERGED = with_ctes(PLAYS, DAILY, BEFORE, ACC, weighted("w_today", "daily"), """scaled AS (
  SELECT user_id, track_id, max(ts) AS ts, sum(CAST(r * pow(2.0, 64) AS HUGEINT)) AS h FROM (
    SELECT user_id, track_id, ts, rating AS r FROM acc
    UNION ALL SELECT user_id, track_id, ts, CAST(weight AS DOUBLE) AS r FROM w_today) u
  GROUP BY user_id, track_id)""", """shifted AS (
  SELECT *, CASE WHEN h = 0 THEN 0 ELSE greatest(0, CAST(floor(log2(abs(CAST(h AS DOUBLE)))) AS INTEGER) - 60) END AS s
  FROM scaled)""", """merged AS (
  SELECT user_id, track_id, ts, CAST(sign(h) AS DOUBLE) * pow(2.0, s - 64) * CAST(
           CAST(abs(h) // CAST(pow(2.0, s) AS HUGEINT) AS BIGINT)
           | CASE WHEN abs(h) % CAST(pow(2.0, s) AS HUGEINT) = 0 THEN 0 ELSE 1 END AS DOUBLE) AS rating
  FROM shifted)""")

QUERIES: dict[str, str] = {
    # sources
    "scan_daily_lines": with_ctes(PLAYS) + f"SELECT {DAILY_LINE} AS value FROM plays",
    "scan_rating_lines": with_ctes(PLAYS, BEFORE, ACC) + f"SELECT {RATING_LINE} AS value FROM acc",
    "track_vector_lookup": with_ctes(PLAYS, VEC) + """SELECT p.event_id, p.user_id, p.track_id,
  v.label, CAST(len(v.features) AS INTEGER) AS n_dims, v.features[1] AS first_component
FROM plays p JOIN vec v ON p.track_id = v.track_id""",
    # parsing
    "parse_daily": with_ctes(PLAYS) + PARSED_PLAYS,
    "map_partitions": with_ctes(PLAYS) + PARSED_PLAYS,
    "parse_ratings": with_ctes(PLAYS, BEFORE, ACC) + """SELECT user_id, track_id,
  date_trunc('second', ts) AS ts, rating FROM acc""",
    "parse_quarantine": with_ctes(PLAYS, BEFORE, ACC) + f"""SELECT {RATING_LINE} AS line,
  'expected 6 fields, found 4' AS parse_error FROM acc""",
    "to_als_rating": with_ctes(PLAYS, BEFORE, ACC) + """SELECT CAST(user_id AS INTEGER) AS user_id,
  CAST(track_id AS INTEGER) AS track_id, rating FROM acc
WHERE user_id BETWEEN -2147483648 AND 2147483647
  AND track_id BETWEEN -2147483648 AND 2147483647 AND rating IS NOT NULL""",
    # scores
    "event_weight": with_ctes(PLAYS, weighted("w", "plays")) + """SELECT event_id, user_id,
  track_id, reason_start, CAST(weight AS DOUBLE) AS weight FROM w""",
    "cosine_similarity": with_ctes(SIMILAR) + """SELECT s.track_id, s.similar_track_id,
  round(list_cosine_similarity(a.features, b.features), 6) AS similarity
FROM sim_top s JOIN vec a ON a.track_id = s.track_id JOIN vec b ON b.track_id = s.similar_track_id""",
    "explode_events": with_ctes(PLAYS, SIMILAR) + """SELECT p.event_id, p.user_id, p.track_id,
  s.similar_track_id, CAST(s.similarity AS DOUBLE) AS similarity
FROM plays p JOIN sim_top s ON p.track_id = s.track_id""",
    "rec_score": with_ctes(PLAYS, DAILY, SIMILAR, weighted("w", "daily")) + """SELECT w.event_id,
  w.user_id, s.similar_track_id,
  CAST(s.similarity AS DOUBLE) * CAST(w.weight AS DOUBLE) AS score
FROM w JOIN sim_top s ON w.track_id = s.track_id""",
    "event_candidates": with_ctes(PLAYS, DAILY, SIMILAR, weighted("w_today", "daily"),
                                  candidates("cand_today", "w_today"))
    + "SELECT user_id, track_id, CAST(score AS DOUBLE) AS score FROM cand_today",
    "diversity_ratio": today_ctes() + """SELECT user_id, track_id,
  CASE WHEN CAST(score AS DOUBLE) = 0 THEN NULL
       ELSE CAST(user_id AS DOUBLE) / CAST(score AS DOUBLE) END AS ratio FROM top_today""",
    "diversity_reweight": today_ctes() + """, ranked AS (
  SELECT t.user_id, t.track_id, v.label, CAST(t.score AS DOUBLE) AS base_score,
         CAST(row_number() OVER (PARTITION BY t.user_id, v.label
                                 ORDER BY t.score DESC, t.track_id) AS INTEGER) AS label_rank
  FROM top_today t LEFT JOIN vec v ON v.track_id = t.track_id)
SELECT user_id, track_id, label, label_rank, base_score, base_score / label_rank AS score
FROM ranked""",
    "user_bucket": with_ctes(HISTORY) + """SELECT DISTINCT user_id,
  CAST(floor(user_id / 100) AS BIGINT) AS range_bucket,
  CAST(1 + (user_id % 4) AS INTEGER) AS hash_bucket FROM history""",
    # filters
    "filter_recent": with_ctes(HISTORY, RECENT) + "SELECT * FROM recent",
    "filter_active_tracks": with_ctes(HISTORY, RECENT, active_tracks("a", "recent", "any"))
    + "SELECT * FROM a",
    "filter_active_tracks_all": with_ctes(HISTORY, RECENT, active_tracks("a", "recent", "all"))
    + "SELECT * FROM a",
    "filter_active_users": with_ctes(HISTORY, RECENT, active_users("a", "recent"))
    + "SELECT * FROM a",
    "filter_dismissed": today_ctes() + """SELECT user_id, track_id, CAST(score AS DOUBLE) AS score
FROM kept_today""",
    "sample_users": with_ctes(HISTORY) + "SELECT * FROM history WHERE user_id % 100 = 0",
    "events_of_user": with_ctes(PLAYS) + """SELECT event_id, user_id, track_id, ts,
  CAST(ms_played AS DOUBLE) AS ms_played, reason_start FROM plays WHERE user_id = 42""",
    # merges
    "merge_ratings": MERGED + "SELECT * FROM merged",
    "upsert_ratings": MERGED + "SELECT * FROM merged",
    "latest_rating": with_ctes(HISTORY) + """SELECT user_id, track_id, ts, max(rating) AS rating
FROM (SELECT *, max(ts) OVER (PARTITION BY user_id, track_id) AS latest FROM history) h
WHERE ts = latest GROUP BY user_id, track_id, ts""",
    "user_ratings_and_events": with_ctes(PLAYS, DAILY, BEFORE, ACC, weighted("w_today", "daily"),
                                         """r AS (
  SELECT user_id, count(*) AS n_ratings, sum(CAST(rating AS DECIMAL(38,6))) AS rating_sum
  FROM acc GROUP BY user_id)""", """e AS (
  SELECT user_id, count(*) AS n_events, sum(CAST(weight AS DECIMAL(38,6))) AS weight_sum
  FROM w_today GROUP BY user_id)""") + """SELECT r.user_id, r.n_ratings,
  CAST(r.rating_sum AS DOUBLE) AS rating_sum, coalesce(e.n_events, 0) AS n_events,
  CAST(e.weight_sum AS DOUBLE) AS weight_sum FROM r LEFT JOIN e ON r.user_id = e.user_id""",
    "user_lists": with_ctes(PLAYS, DAILY, BEFORE, ACC, weighted("w_today", "daily"))
    + """SELECT user_id, 'ratings' AS side, track_id, ts, rating AS value, CAST(1 AS BIGINT) AS times FROM acc
UNION ALL SELECT user_id, 'events', track_id, ts, CAST(weight AS DOUBLE), count(*)
FROM w_today WHERE user_id IN (SELECT user_id FROM acc) GROUP BY user_id, track_id, ts, weight""",
    "merge_prev_recs": recs_ctes() + """SELECT user_id, track_id, CAST(score AS DOUBLE) AS score
FROM merged""",
    # aggregates
    "events_by_track": with_ctes(PLAYS, weighted("w", "plays")) + """SELECT track_id,
  count(*) AS n_events, CAST(sum(weight) AS DOUBLE) AS weight_sum, max(ts) AS last_ts
FROM w GROUP BY track_id""",
    "track_event_lists": with_ctes(PLAYS, weighted("w", "plays")) + """SELECT track_id, user_id, ts,
  CAST(weight AS DOUBLE) AS weight, count(*) AS times FROM w GROUP BY track_id, user_id, ts, w.weight""",
    "track_activity": with_ctes(HISTORY, RECENT) + """SELECT track_id, count(*) AS listens,
  max(ts) AS last_active FROM recent GROUP BY track_id""",
    "user_activity": with_ctes(HISTORY, RECENT) + """SELECT user_id, count(*) AS listens,
  max(ts) AS last_active FROM recent GROUP BY user_id""",
    "recs_by_user": recs_ctes() + """SELECT user_id, CAST(count(*) AS INTEGER) AS n_recs,
  arg_min(track_id, rank) AS first_track_id,
  list_reduce(list(score ORDER BY rank), lambda a, b: a + b) AS score_sum
FROM final GROUP BY user_id""",
    "gram_matrix": with_ctes(VEC, """e AS (
  SELECT track_id, unnest(features) AS x,
         CAST(generate_subscripts(features, 1) - 1 AS INTEGER) AS i FROM vec)""")
    + """SELECT a.i, b.i AS j, round(sum(a.x * b.x), 6) AS value
FROM e a JOIN e b ON a.track_id = b.track_id GROUP BY a.i, b.i""",
    "stage_counts": today_ctes() + """SELECT 'weighted_events' AS stage, count(*) AS n_rows
FROM w_today
UNION ALL SELECT 'candidates', count(*) FROM cand_today
UNION ALL SELECT 'not_dismissed', count(*) FROM kept_today
UNION ALL SELECT 'top_n', count(*) FROM top_today""",
    "partition_counts": with_ctes(PLAYS, BEFORE, ACC) + """SELECT 'lines' AS step,
  (SELECT count(*) FROM plays) + (SELECT count(*) FROM acc) AS n_rows
UNION ALL SELECT 'events', count(*) FROM plays
UNION ALL SELECT 'weighted_events', count(*) FROM plays WHERE reason_start <> 'unknown'""",
    # top-N
    "user_top_n": today_ctes() + """SELECT user_id, rank, track_id, CAST(score AS DOUBLE) AS score
FROM top_today""",
    "user_top_n_asc": today_ctes(order="score ASC") + """SELECT user_id, rank, track_id,
  CAST(score AS DOUBLE) AS score FROM top_today""",
    "user_top_n_final": recs_ctes(n=10) + "SELECT user_id, rank, track_id, score, base_score FROM final",
    "batch_recommendations": recs_ctes() + """SELECT user_id, rank, track_id, score, base_score
FROM final""",
    "similar_tracks": with_ctes(SIMILAR) + """SELECT track_id, rank, similar_track_id,
  CAST(similarity AS DOUBLE) AS similarity, similar_label FROM sim_top""",
    # sinks
    "sink_user_recs": recs_ctes() + "SELECT user_id, rank, track_id, score FROM final",
    "sink_merged_ratings": MERGED + """SELECT user_id, track_id, date_trunc('second', ts) AS ts,
  rating FROM merged""",
    # model
    "training_ratings": TRAINING + "SELECT * FROM training",
    "als_item_ids": TRAINING + "SELECT DISTINCT track_id FROM training",
    # streaming
    "stream_scan": with_ctes(PLAYS) + PARSED_PLAYS,
    "stream_union": with_ctes(PLAYS) + PARSED_PLAYS,
    "stream_sink_batches": with_ctes(PLAYS) + "SELECT *, 0 AS batch_id FROM (" + PARSED_PLAYS + ")",
    "stream_restart": with_ctes(PLAYS) + "SELECT *, 0 AS batch_id FROM (" + PARSED_PLAYS + ")",
    "stream_event_weight": with_ctes(PLAYS, weighted("w", "plays")) + """SELECT user_id, track_id,
  date_trunc('second', ts) AS ts, reason_start, CAST(weight AS DOUBLE) AS weight FROM w""",
    "stream_events_by_track": with_ctes(PLAYS, weighted("w", "plays")) + """SELECT track_id,
  count(*) AS n_events, CAST(sum(weight) AS DOUBLE) AS weight_sum,
  max(date_trunc('second', ts)) AS last_ts FROM w GROUP BY track_id""",
    "stream_line_log": with_ctes(PLAYS, weighted("w", "plays")) + """SELECT
  CAST(event_id % 3 AS INTEGER) AS batch_id, track_id, count(*) AS n_events,
  CAST(sum(weight) AS DOUBLE) AS weight_sum, max(date_trunc('second', ts)) AS last_ts
FROM w GROUP BY 1, 2""",
    "stream_track_window": with_ctes(PLAYS, weighted("w", "plays")) + """SELECT
  CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, track_id, count(*) AS n_events,
  CAST(sum(weight) AS DOUBLE) AS weight_sum FROM w GROUP BY 1, 2""",
    "stream_user_top_n": today_ctes("plays") + """SELECT user_id, rank, track_id,
  CAST(score AS DOUBLE) AS score FROM top_today""",
    "stream_recommendations": recs_ctes("plays") + """SELECT user_id, rank, track_id, score,
  base_score FROM final""",
}

#: The layout by user changes what is read, not the result.
QUERIES["stream_recommendations_keyed"] = QUERIES["stream_recommendations"]

#: All cells probed give the exact lists.
QUERIES["similar_tracks_cells"] = QUERIES["similar_tracks"]

#: What SQL can tell of trained and folded vectors: whose they are, how long, and that all numbers are finite.
QUERIES["als_item_factors"] = f"SELECT track_id, 40 AS n_dims, TRUE AS finite FROM ({QUERIES['als_item_ids']})"
QUERIES["als_fold_in"] = f"""SELECT DISTINCT track_id, 8 AS n_dims, TRUE AS finite
FROM ({with_ctes(HISTORY)} SELECT * FROM history WHERE ts >= {HISTORY_SPLIT})
WHERE user_id IN (SELECT user_id FROM ({QUERIES['training_ratings']}))"""
QUERIES["stream_fold_in"] = with_ctes(PLAYS, BEFORE, ACC, weighted("w", "plays")) + """SELECT DISTINCT track_id,
  8 AS n_dims, TRUE AS finite FROM w WHERE user_id IN (SELECT user_id FROM acc)"""
QUERIES["stream_carried_fold_in"] = QUERIES["stream_fold_in"]
