"""DuckDB SQL twins of the registered queries (same tables, same column
names and types as the Spark results). Integer results are cast to the
Spark type (DuckDB sums are HUGEINT, ``year`` is BIGINT there)."""

from __future__ import annotations

SHOTS_CTE = """
shots AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS season,
         o_orderkey AS game_id,
         CAST(c_nationkey AS BIGINT) AS homeTeamCode,
         (c_nationkey + 1 + o_orderkey % 24) % 25 AS awayTeamCode,
         CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS isPlayOffGame,
         CAST(l_quantity * 80 AS INTEGER) AS time,
         CASE WHEN l_linenumber % 2 = 0 THEN 'HOME' ELSE 'AWAY' END AS team,
         CASE l_returnflag WHEN 'R' THEN 'GOAL' WHEN 'A' THEN 'SHOT' ELSE 'MISS' END AS event
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
)"""

GAMES_CTE = SHOTS_CTE + """,
games AS (
  SELECT season, game_id, homeTeamCode, awayTeamCode, isPlayOffGame,
         CAST(SUM(CASE WHEN team = 'HOME' AND event = 'GOAL' THEN 1 ELSE 0 END) AS BIGINT) AS homeTeamGoals,
         CAST(SUM(CASE WHEN team = 'AWAY' AND event = 'GOAL' THEN 1 ELSE 0 END) AS BIGINT) AS awayTeamGoals,
         COALESCE(MAX(CASE WHEN event = 'GOAL' THEN time END), 0) AS lastGoalTime
  FROM shots
  GROUP BY season, game_id, homeTeamCode, awayTeamCode, isPlayOffGame
),
sides AS (
  SELECT season, isPlayOffGame, lastGoalTime, homeTeamCode AS teamCode,
         homeTeamGoals AS goalsScored, awayTeamGoals AS goalsConceded FROM games
  UNION ALL
  SELECT season, isPlayOffGame, lastGoalTime, awayTeamCode AS teamCode,
         awayTeamGoals AS goalsScored, homeTeamGoals AS goalsConceded FROM games
)"""

PLAYOFF_PART = """
playoff AS (
  SELECT season, teamCode, CAST(COUNT(*) AS BIGINT) AS games,
         CAST(SUM(CASE WHEN goalsScored > goalsConceded THEN 1 ELSE 0 END) AS BIGINT) AS wins,
         CAST(SUM(CASE WHEN goalsScored < goalsConceded THEN 1 ELSE 0 END) AS BIGINT) AS losses
  FROM sides WHERE isPlayOffGame = 1 GROUP BY season, teamCode
),
best AS (
  SELECT season, teamCode, games, wins, losses FROM (
    SELECT *, row_number() OVER (PARTITION BY season ORDER BY wins DESC, teamCode ASC) AS rk FROM playoff
  ) WHERE rk = 1
)"""

PLAYOFF_CTE = f"{GAMES_CTE},{PLAYOFF_PART}"

POINTS_PART = """
scored AS (
  SELECT season, teamCode, goalsScored, goalsConceded,
         CASE WHEN goalsScored > goalsConceded THEN CASE WHEN lastGoalTime <= 3600 THEN 3 ELSE 2 END
              WHEN goalsScored < goalsConceded THEN CASE WHEN lastGoalTime <= 3600 THEN 0 ELSE 1 END
              ELSE 1 END AS points
  FROM sides WHERE isPlayOffGame = 0
),
regular AS (
  SELECT season, teamCode, CAST(COUNT(*) AS BIGINT) AS games,
         CAST(SUM(CASE WHEN points >= 2 THEN 1 ELSE 0 END) AS BIGINT) AS wins,
         CAST(SUM(CASE WHEN points <= 1 THEN 1 ELSE 0 END) AS BIGINT) AS losses,
         CAST(SUM(goalsScored) AS BIGINT) AS goalsScored,
         CAST(SUM(goalsConceded) AS BIGINT) AS goalsConceded,
         CAST(SUM(points) AS BIGINT) AS points
  FROM scored GROUP BY season, teamCode
),
worst AS (
  SELECT season, teamCode, games, wins, losses, goalsScored, goalsConceded, points FROM (
    SELECT *, dense_rank() OVER (PARTITION BY season ORDER BY points) AS rk FROM regular
  ) WHERE rk = 1
)"""

POINTS_CTE = f"{GAMES_CTE},{POINTS_PART}"

WORDS_CTE = r"""
tokens AS (
  SELECT lang, unnest(string_split_regex(
           CASE lang
             WHEN 'en' THEN regexp_replace(lower(text), '[^abcdefghijklmnopqrstuvwxyz\s-]', '', 'g')
             WHEN 'de' THEN regexp_replace(lower(text), '[^abcdefghijklmnopqrstuvwxyzäöüß\s-]', '', 'g')
             WHEN 'fr' THEN regexp_replace(lower(text), '[^abcdefghijklmnopqrstuvwxyzàâæçèéêëîïôœùûüÿ\s-]', '', 'g')
             WHEN 'es' THEN regexp_replace(lower(text), '[^abcdefghijklmnopqrstuvwxyzáéíñóúü\s-]', '', 'g')
           END, '\s+')) AS word
  FROM documents WHERE lang IN ('en', 'de', 'fr', 'es')
),
counts AS (
  SELECT lang, word, CAST(COUNT(*) AS BIGINT) AS n FROM tokens
  WHERE (lang = 'en' AND regexp_full_match(word, '[a-z]+(-[a-z]+)*')
         AND (length(word) > 1 OR word IN ('a', 'i')))
     OR (lang = 'de' AND regexp_full_match(word, '[a-zäöüß]+(-[a-zäöüß]+)*')
         AND length(word) > 1 AND NOT contains(word, 'wiki'))
     OR (lang = 'fr' AND regexp_full_match(word, '[a-zàâæçèéêëîïôœùûüÿ]+(-[a-zàâæçèéêëîïôœùûüÿ]+)*')
         AND (length(word) > 1 OR word IN ('a', 'à', 'y')))
     OR (lang = 'es' AND regexp_full_match(word, '[a-záéíñóúü]+(-[a-záéíñóúü]+)*')
         AND (length(word) > 1 OR word IN ('a', 'e', 'o', 'u', 'y')))
  GROUP BY lang, word
)"""

RAW_TOKENS_CTE = r"""
raw AS (
  SELECT word FROM (SELECT unnest(string_split_regex(text, '\s+')) AS word FROM documents) WHERE word <> ''
)"""

POINTS_CTE_SQL = """
points AS (
  SELECT c_custkey AS id,
         61 + CAST(c_custkey * 7919 % 10007 AS DOUBLE) / 10007 AS lat,
         23 + CAST(c_custkey * 104729 % 10009 AS DOUBLE) / 10009 AS lon,
         CAST(c_nationkey AS BIGINT) AS postal_code
  FROM customer
)"""

# K-Means in whole micro-degrees, one row a step: a row that is not done holds the centres of a
# round's next step, a done row the kept members. Members stay in the order of the seeds' hash.
def _seeds(members: str, k: str) -> str:
    apart = f"({members}[i].y - s.y) * ({members}[i].y - s.y) + ({members}[i].x - s.x) * ({members}[i].x - s.x)"
    return f"""list_reduce(
      list_concat([[{{'y': {members}[1].y, 'x': {members}[1].x}}]], [CAST([] AS STRUCT(y BIGINT, x BIGINT)[]) FOR q IN range(1, {k})]),
      lambda chosen, q: list_concat(chosen, [{{'y': {members}[-b.place].y, 'x': {members}[-b.place].x}} FOR b IN [list_max([
        {{'d': list_min([{apart} FOR s IN chosen]), 'place': -i}} FOR i IN range(1, least(len({members}), 64) + 1)])]]))"""


def _floor_mean(total: str, n: str) -> str:
    return f"({total} - (({total} % {n}) + {n}) % {n}) // {n}"


_OF = "FOR z IN list_zip(members, homes) IF z[2] = j"
_HAVERSINE = """2 * 6378.1 * atan2(sqrt(h), sqrt(1 - h)) FOR h IN [
        pow(sin(radians(centres[home].y / 1000000 - m.lat) / 2), 2)
        + cos(radians(m.lat)) * cos(radians(centres[home].y / 1000000)) * pow(sin(radians(centres[home].x / 1000000 - m.lon) / 2), 2)
        FOR m IN kept]"""

KMEANS_CTE = f"""
places AS (
  SELECT id, postal_code, lat, lon, CAST(round(lat * 1000000) AS BIGINT) AS y, CAST(round(lon * 1000000) AS BIGINT) AS x FROM points
),
started AS (
  SELECT list({{'id': id, 'postal_code': postal_code, 'lat': lat, 'lon': lon, 'y': y, 'x': x}} ORDER BY md5('1:' || id), lat, lon) AS members
  FROM places
),
walk AS (
  SELECT 1 AS round, 7 AS k, 0 AS step, FALSE AS settled, FALSE AS done, {_seeds("members", "7")} AS centres, members,
         len(members) AS n_before, CAST(NULL AS BIGINT) AS home, CAST(NULL AS DOUBLE) AS radius
  FROM started
  UNION ALL
  SELECT CASE WHEN done THEN round + 1 ELSE round END AS round,
         CASE WHEN done THEN greatest(k - 1, 2) ELSE k END AS k,
         CASE WHEN done THEN 0 ELSE step + 1 END AS step,
         CASE WHEN done OR settled THEN FALSE
              ELSE step + 1 = 20 OR list_max([(z[1].y - z[2].y) * (z[1].y - z[2].y) + (z[1].x - z[2].x) * (z[1].x - z[2].x)
                                              FOR z IN list_zip(centres, moved)]) <= 10000 END AS settled,
         settled AND NOT done AS done,
         CASE WHEN done THEN {_seeds("members", "greatest(k - 1, 2)")} WHEN settled THEN centres ELSE moved END AS centres,
         CASE WHEN settled AND NOT done THEN kept ELSE members END AS members,
         CASE WHEN done THEN len(members) ELSE n_before END AS n_before,
         CASE WHEN settled AND NOT done THEN new_home END AS home,
         CASE WHEN settled AND NOT done THEN list_max([{_HAVERSINE.replace("[home]", "[new_home]")}]) END AS radius
  FROM (
    SELECT *, [z[1] FOR z IN list_zip(members, homes) IF z[2] = new_home] AS kept,
           [{{'y': CASE WHEN t.n = 0 THEN centres[t.j].y ELSE {_floor_mean("t.y", "t.n")} END,
              'x': CASE WHEN t.n = 0 THEN centres[t.j].x ELSE {_floor_mean("t.x", "t.n")} END}}
            FOR t IN [{{'j': j, 'n': len([1 {_OF}]), 'y': CAST(list_sum([z[1].y {_OF}]) AS BIGINT), 'x': CAST(list_sum([z[1].x {_OF}]) AS BIGINT)}}
                      FOR j IN range(1, len(centres) + 1)]] AS moved
    FROM (
      SELECT *, [z[2] FOR z IN list_zip(members, homes) IF z[1].id = 42][1] AS new_home
      FROM (
        SELECT *, [CAST(list_position(d, list_min(d)) AS BIGINT) FOR d IN
                   [[(m.y - c.y) * (m.y - c.y) + (m.x - c.x) * (m.x - c.x) FOR c IN centres] FOR m IN members]] AS homes
        FROM walk WHERE NOT (done AND radius <= 3.0)
      )
    )
  )
)"""

XY_CTE = """
xy AS (
  SELECT l_orderkey * 8 + l_linenumber AS id, l_quantity AS X, l_extendedprice AS label FROM lineitem
),
train AS (SELECT * FROM xy WHERE id * 7919 % 10007 % 100 < 80),
test AS (SELECT * FROM xy WHERE id * 7919 % 10007 % 100 >= 80),
model AS (SELECT regr_slope(label, X) AS slope, regr_intercept(label, X) AS intercept FROM train)"""

DAILY_SQL = """
        SELECT CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS day, ROUND(SUM(l_quantity * l_extendedprice), 2) AS total_sales
        FROM lineitem GROUP BY 1"""

TEXT_STATS_SQL = r"""
        SELECT CAST(SUM(len(string_split(text, chr(10)))) AS BIGINT) AS lines,
               CAST(SUM(len(regexp_extract_all(text, '\S+'))) AS BIGINT) AS words,
               CAST(SUM(length(regexp_replace(text, '\s', '', 'g'))) AS BIGINT) AS chars
        FROM documents"""

GAMES_SELECT = (
    "SELECT season, game_id, homeTeamCode, awayTeamCode, isPlayOffGame, homeTeamGoals, awayTeamGoals, "
    "lastGoalTime FROM games"
)

ORACLES: dict[str, str] = {
    # league
    "games_from_shots": f"WITH {GAMES_CTE} {GAMES_SELECT}",
    "games_from_shot_log": f"WITH {GAMES_CTE} {GAMES_SELECT}",
    "linreg_predict_train": f"""WITH {XY_CTE}
        SELECT id, X, label, ROUND(slope * X + intercept, 2) AS prediction FROM train, model""",
    "kmeans_assign": f"""WITH RECURSIVE {POINTS_CTE_SQL}, {KMEANS_CTE}
        SELECT id, CAST(list_position(d, list_min(d)) - 1 AS INTEGER) AS cluster
        FROM (SELECT id, [(y - c.y) * (y - c.y) + (x - c.x) * (x - c.x) FOR c IN centres] AS d
              FROM places, (SELECT centres FROM walk WHERE round = 1 AND done))""",
    "kmeans_refine": f"""WITH RECURSIVE {POINTS_CTE_SQL}, {KMEANS_CTE}
        SELECT round, k, CAST(n_before AS BIGINT) AS n_before, CAST(len(members) AS BIGINT) AS n_after, CAST(home - 1 AS INTEGER) AS cluster,
               centres[home].y / 1000000 AS center_lat, centres[home].x / 1000000 AS center_lon, round(radius, 6) AS radius_km
        FROM walk WHERE done""",
    "kmeans_final_counts": f"""WITH RECURSIVE {POINTS_CTE_SQL}, {KMEANS_CTE}
        SELECT CAST(len(members) AS BIGINT) AS members, CAST(len([1 FOR m IN members IF m.postal_code = code]) AS BIGINT) AS members_in_postal_code,
               round(100.0 * len([1 FOR m IN members IF m.postal_code = code]) / len(members), 2) AS share_pct
        FROM (SELECT members, [m.postal_code FOR m IN members IF m.id = 42][1] AS code FROM walk WHERE done AND radius <= 3.0)""",
    "kmeans_checks": """
        SELECT COUNT(*) AS points_in, COUNT(*) AS points_assigned, CAST(0 AS BIGINT) AS not_nearest,
               TRUE AS rounds_chained, COUNT(*) FILTER (WHERE c_custkey = 42) = 1 AS anchor_present, TRUE AS radius_within_limit
        FROM customer""",
    "scan_imposed_schema": "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders",
    "games_from_shots_sql": f"WITH {GAMES_CTE} {GAMES_SELECT}",
    "playoff_records": f"WITH {PLAYOFF_CTE} SELECT * FROM playoff",
    "best_team_per_season": f"WITH {PLAYOFF_CTE} SELECT * FROM best",
    "best_team_of_season": f"WITH {PLAYOFF_CTE} SELECT * FROM best WHERE season = 2001",
    "season_points": f"WITH {POINTS_CTE} SELECT * FROM regular",
    "worst_team_per_season": f"WITH {POINTS_CTE} SELECT * FROM worst",
    "worst_team_of_season": f"WITH {POINTS_CTE} SELECT * FROM worst WHERE season = 2001",
    # summaries
    "row_count": "SELECT CAST(COUNT(*) AS BIGINT) AS n FROM orders",
    "global_min_max": "SELECT MIN(o_totalprice) AS min_value, MAX(o_totalprice) AS max_value FROM orders",
    "first_rows": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
    "yearly_extremes": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS year, MIN(o_totalprice) AS min_value,
               MAX(o_totalprice) AS max_value
        FROM orders GROUP BY 1 ORDER BY 1 DESC""",
    "yearly_summary": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS year, MIN(o_totalprice) AS min_value,
               MAX(o_totalprice) AS max_value, CAST(COUNT(*) AS BIGINT) AS entries,
               ROUND(AVG(o_totalprice), 2) AS avg_value
        FROM orders GROUP BY 1""",
    "year_point_lookups": """
        SELECT MIN(CASE WHEN year(o_orderdate) = 1996 THEN o_totalprice END) AS min_value,
               MAX(CASE WHEN year(o_orderdate) = 1998 THEN o_totalprice END) AS max_value,
               CAST(COUNT(*) FILTER (WHERE year(o_orderdate) = 2001) AS BIGINT) AS entries,
               ROUND(AVG(CASE WHEN year(o_orderdate) = 1995 THEN o_totalprice END), 2) AS avg_value
        FROM orders""",
    "top_flagged_year": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(COUNT(*) AS BIGINT) AS n
        FROM orders WHERE o_orderstatus = 'P' GROUP BY 1 ORDER BY n DESC, year ASC LIMIT 1""",
    "value_frequency": """
        SELECT o_orderpriority, CAST(COUNT(*) AS BIGINT) AS n FROM orders GROUP BY 1""",
    "best_days": """
        SELECT CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS day, ROUND(SUM(l_quantity * l_extendedprice), 2) AS total_sales
        FROM lineitem GROUP BY 1 ORDER BY total_sales DESC, day ASC LIMIT 12""",
    "top_products_weighted": """
        SELECT l_partkey AS product,
               ROUND(SUM(CASE WHEN month(l_shipdate) = 1 THEN l_quantity * l_extendedprice * 2
                              ELSE l_quantity * l_extendedprice END), 2) AS total_sales
        FROM lineitem WHERE year(l_shipdate) = 1997
        GROUP BY 1 ORDER BY total_sales DESC, product ASC LIMIT 8""",
    "sales_by_year": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS year, ROUND(SUM(o_totalprice), 2) AS euros
        FROM orders GROUP BY 1""",
    "best_sales_year": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS year, ROUND(SUM(o_totalprice), 2) AS euros
        FROM orders GROUP BY 1 ORDER BY euros DESC, year ASC LIMIT 1""",
    "leader_yearly_sales": """
        WITH sales AS (
          SELECT n_name AS publisher, CAST(year(l_shipdate) AS INTEGER) AS year,
                 CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0.0 END AS eu,
                 l_extendedprice AS global
          FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
          WHERE year(l_shipdate) BETWEEN 1996 AND 1999
        ),
        leader AS (
          SELECT publisher FROM sales GROUP BY publisher
          ORDER BY ROUND(SUM(eu), 2) DESC, publisher ASC LIMIT 1
        )
        SELECT publisher, year, ROUND(SUM(eu), 2) AS eu_total, ROUND(SUM(global), 2) AS global_total
        FROM sales WHERE publisher IN (SELECT publisher FROM leader)
        GROUP BY publisher, year""",
    "sum_of_cubes": """
        SELECT CAST(SUM(CAST(l_linenumber AS BIGINT) * l_linenumber * l_linenumber) AS BIGINT) AS sum_of_cubes
        FROM lineitem""",
    # words
    "word_count": f"WITH {RAW_TOKENS_CTE} SELECT word, CAST(COUNT(*) AS BIGINT) AS n FROM raw GROUP BY word",
    "word_counts_by_lang": f"WITH {WORDS_CTE} SELECT lang, word, n FROM counts",
    "top_words": f"WITH {WORDS_CTE} SELECT word, n FROM counts WHERE lang = 'en' ORDER BY n DESC, word LIMIT 10",
    "top_words_of_length": f"""WITH {WORDS_CTE} SELECT word, n FROM counts
        WHERE lang = 'de' AND length(word) = 5 ORDER BY n DESC, word LIMIT 5""",
    "longest_frequent_word": f"""WITH {WORDS_CTE} SELECT word, CAST(SUM(n) AS BIGINT) AS n FROM counts
        GROUP BY word HAVING SUM(n) >= 150 ORDER BY length(word) DESC, n DESC, word LIMIT 1""",
    "avg_word_length": f"""WITH {WORDS_CTE} SELECT lang,
        ROUND(CAST(SUM(length(word) * n) AS DOUBLE) / SUM(n), 2) AS avg_len FROM counts GROUP BY lang""",
    "text_line_stats": TEXT_STATS_SQL,
    "words_of_length": f"WITH {RAW_TOKENS_CTE} SELECT CAST(COUNT(*) AS BIGINT) AS n FROM raw WHERE length(word) = 6",
    "most_common_word_of_length": f"""WITH {RAW_TOKENS_CTE} SELECT word, CAST(COUNT(*) AS BIGINT) AS n FROM raw
        WHERE length(word) = 6 GROUP BY word ORDER BY n DESC, word LIMIT 1""",
    "word_counts_from_text_files": f"WITH {WORDS_CTE} SELECT lang, word, n FROM counts",
    "text_line_stats_from_files": TEXT_STATS_SQL,
    # numbers, distances
    "cube_root": "SELECT c_custkey, ROUND(cbrt(c_acctbal), 6) AS cube_root FROM customer",
    "haversine_km": f"""WITH {POINTS_CTE_SQL}
        SELECT id, ROUND(2 * 6378.1 * atan2(sqrt(a), sqrt(1 - a)), 6) AS distance_km FROM (
          SELECT id, pow(sin(radians(61.0 - lat) / 2), 2)
                     + cos(radians(lat)) * cos(radians(61.0)) * pow(sin(radians(23.0 - lon) / 2), 2) AS a
          FROM points)""",
    # regression
    "hash_split_counts": """
        SELECT CASE WHEN c_custkey * 7919 % 10007 % 100 < 80 THEN 'train' ELSE 'test' END AS split,
               CAST(COUNT(*) AS BIGINT) AS n
        FROM customer GROUP BY 1""",
    "linreg_coefficients": f"WITH {XY_CTE} SELECT ROUND(slope, 4) AS slope, ROUND(intercept, 4) AS intercept FROM model",
    "linreg_rmse": f"""WITH {XY_CTE}
        SELECT ROUND(sqrt(avg(pow(label - (slope * X + intercept), 2))), 4) AS rmse FROM test, model""",
    "linreg_predict": f"""WITH {XY_CTE}
        SELECT id, X, label, ROUND(slope * X + intercept, 2) AS prediction FROM test, model""",
    "linreg_predict_new": f"""WITH {XY_CTE}
        SELECT X, ROUND(slope * X + intercept, 4) AS prediction
        FROM (SELECT CAST(x AS DOUBLE) AS X FROM (VALUES (-1.5), (2.5), (8.5), (31.4)) AS v(x)), model""",
    # sources and streaming
    "scan_csv_roundtrip": "SELECT * FROM orders",
    "scan_csv_inferred": """SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey,
        o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""",
    "csv_column_types": f"""
        SELECT CAST(place AS INTEGER) AS place, "column", type, n AS n_values, 0::BIGINT AS n_nulls,
               CASE WHEN type = 'int' THEN n ELSE 0 END AS "int", CASE WHEN type = 'int' THEN n ELSE 0 END AS "bigint",
               CASE WHEN type IN ('int', 'double') THEN n ELSE 0 END AS "double", 0::BIGINT AS "boolean",
               0::BIGINT AS "date", CASE WHEN type = 'timestamp_ntz' THEN n ELSE 0 END AS "timestamp_ntz"
        FROM (VALUES (0, 'o_orderkey', 'int'), (1, 'o_custkey', 'int'), (2, 'o_orderstatus', 'string'), (3, 'o_totalprice', 'double'),
                     (4, 'o_orderdate', 'timestamp_ntz'), (5, 'o_orderpriority', 'string')) AS c(place, "column", type),
             (SELECT CAST(count(*) AS BIGINT) AS n FROM orders)""",
    "sales_with_known_year": """
        SELECT CAST(year(l_shipdate) AS INTEGER) AS "Year", CAST(COUNT(*) AS BIGINT) AS n, ROUND(SUM(l_extendedprice), 2) AS total
        FROM lineitem WHERE NOT (l_returnflag = 'N' AND l_linenumber = 1) GROUP BY 1""",
    "sales_quarantine": """
        SELECT CAST(l_orderkey * 8 + l_linenumber AS VARCHAR) AS "Rank", 'N/A' AS "Year", 'Year' AS bad_columns
        FROM lineitem WHERE l_returnflag = 'N' AND l_linenumber = 1""",
    "season_report": f"""WITH {PLAYOFF_CTE}, {POINTS_PART}
        SELECT 'records' AS report, season, teamCode, games, wins, losses, CAST(NULL AS BIGINT) AS goalsScored,
               CAST(NULL AS BIGINT) AS goalsConceded, CAST(NULL AS BIGINT) AS points FROM playoff
        UNION ALL SELECT 'best', season, teamCode, games, wins, losses, NULL, NULL, NULL FROM best
        UNION ALL SELECT 'points', season, teamCode, games, wins, losses, goalsScored, goalsConceded, points FROM regular
        UNION ALL SELECT 'worst', season, teamCode, games, wins, losses, goalsScored, goalsConceded, points FROM worst""",
    "vector_cubes": """
        SELECT vec_id, ROUND(list_sum([x::DOUBLE * x::DOUBLE * x::DOUBLE FOR x IN embedding]), 6) AS sum_of_cubes FROM embeddings""",
    "linreg_two_features": """
        WITH train AS (
          SELECT l_quantity AS q, l_discount AS d, l_extendedprice AS y FROM lineitem
          WHERE (l_orderkey * 8 + l_linenumber) * 7919 % 10007 % 100 < 80
        ),
        m AS (SELECT avg(q) AS mq, avg(d) AS md, avg(y) AS my, covar_pop(q, q) AS qq, covar_pop(q, d) AS qd, covar_pop(d, d) AS dd,
                     covar_pop(q, y) AS qy, covar_pop(d, y) AS dy FROM train),
        b AS (SELECT *, (qy * dd - dy * qd) / (qq * dd - qd * qd) AS bq, (dy * qq - qy * qd) / (qq * dd - qd * qd) AS bd FROM m)
        SELECT ROUND(bq, 4) AS quantity, ROUND(bd, 4) AS discount, ROUND(my - bq * mq - bd * md, 4) AS intercept FROM b""",
    "scan_csv_semicolon": DAILY_SQL,
    "stream_best_days": DAILY_SQL,
    "stream_stop_resume": DAILY_SQL,
    "stream_batch_agreement": f"""
        SELECT CAST(COUNT(*) AS BIGINT) AS keys_on_both, CAST(COUNT(*) AS BIGINT) AS equal_values,
               0::BIGINT AS only_stream, 0::BIGINT AS only_batch FROM ({DAILY_SQL})""",
    "stream_top_days": DAILY_SQL + " ORDER BY total_sales DESC, day ASC LIMIT 6",
}
