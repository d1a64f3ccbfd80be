"""The workload's queries as DuckDB SQL, written from the definitions of the
operators and not from the Spark plans."""

from __future__ import annotations

from ..functions.text import BLANKS

_MATCH = """event_id, event_name, season, league, league_id, home_team, home_id, home_score,
 away_team, away_id, away_score, event_date, event_time, venue, status, extracted_at, extract_date"""
_BLANKS = "'" + "".join(BLANKS) + "'"

MATCHES = """matches_raw AS (
 SELECT l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR AS event_id,
  c_name || ' vs ' || p_name AS event_name,
  CASE WHEN l_tax > 0 THEN year(o_orderdate)::VARCHAR END AS season,
  r_name AS league, r_regionkey::VARCHAR AS league_id,
  c_name AS home_team, o_custkey::VARCHAR AS home_id,
  (floor(l_quantity)::BIGINT % 6)::BIGINT AS home_score,
  p_name AS away_team, l_partkey::VARCHAR AS away_id,
  (l_suppkey % 5)::BIGINT AS away_score,
  strftime(o_orderdate, '%Y-%m-%d') AS event_date,
  '20:00:00' AS event_time,
  CASE WHEN l_discount > 0 THEN 'Ground ' || l_suppkey::VARCHAR END AS venue,
  CASE WHEN l_linestatus = 'F' THEN ' ft ' ELSE 'NS' END AS status,
  strftime(l_shipdate, '%Y-%m-%d') || 'T00:00:00+00:00' AS extracted_at,
  strftime(l_shipdate, '%Y-%m-%d') AS extract_date,
  l_extendedprice AS tie_price, l_suppkey AS tie_supplier
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey)"""

TEAMS = """teams_raw AS (
 SELECT c_custkey::VARCHAR AS team_id,
  CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_name END AS name,
  c_mktsegment AS alt_name, r_name AS country,
  CASE WHEN c_acctbal >= 0 THEN n_name END AS city,
  r_name AS league, r_regionkey::VARCHAR AS league_id,
  CASE WHEN c_mktsegment <> 'BUILDING' THEN 'Arena ' || n_name END AS venue,
  floor(c_acctbal)::BIGINT AS venue_capacity, n_name AS venue_location,
  (c_nationkey + 1900)::BIGINT AS founded_year, NULL::VARCHAR AS description,
  CASE WHEN c_acctbal > 5000 THEN c_name || '.example' END AS website,
  '2024-05-01T12:00:00+00:00' AS extracted_at
 FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""

LATEST = """latest AS (
 SELECT * FROM matches_raw QUALIFY row_number() OVER (PARTITION BY event_id
  ORDER BY extract_date DESC NULLS LAST, tie_price DESC, tie_supplier, away_id, home_score) = 1)"""

FINISHED = f"""upper(trim(status, {_BLANKS}))
 IN ('FT', 'AET', 'PEN', 'MATCH FINISHED', 'FINISHED')"""

_DERIVED = """year(d)::BIGINT AS match_year, month(d)::BIGINT AS match_month, dayname(d) AS weekday,
  CASE WHEN home_score > away_score THEN 'Local' WHEN home_score < away_score THEN 'Visitante'
   ELSE 'Empate' END AS outcome,
  abs(home_score - away_score) AS score_difference,
  abs(home_score - away_score) > 2 AS is_blowout"""

SILVER = f"""silver AS (
 SELECT * EXCLUDE (tie_price, tie_supplier, d) REPLACE (d AS event_date,
   coalesce(venue, 'Estadio desconocido') AS venue, coalesce(season, 'Sin temporada') AS season),
  {_DERIVED}
 FROM (SELECT *, try_strptime(event_date, '%Y-%m-%d') AS d FROM latest
  WHERE event_id IS NOT NULL AND home_score IS NOT NULL AND away_score IS NOT NULL AND {FINISHED}))"""

NAMES = """sightings AS (
 SELECT home_id AS team_id, home_team AS team, 0 AS role, event_date FROM silver
 UNION ALL SELECT away_id, away_team, 1, event_date FROM silver),
names AS (
 SELECT team_id, team FROM sightings WHERE team_id IS NOT NULL
 QUALIFY row_number() OVER (PARTITION BY team_id
  ORDER BY role, event_date NULLS LAST, team NULLS FIRST) = 1)"""

GOLD = """sides AS (
 SELECT league, home_id AS team_id, home_score AS f, away_score AS a,
  outcome = 'Local' AS w, outcome = 'Empate' AS d FROM silver
 UNION ALL SELECT league, away_id, away_score, home_score,
  outcome = 'Visitante', outcome = 'Empate' FROM silver),
stats AS (
 SELECT league, team_id, count(*) AS played, count(*) FILTER (w) AS won,
  count(*) FILTER (d) AS drawn, sum(f)::BIGINT AS goals_for, sum(a)::BIGINT AS goals_against
 FROM sides WHERE league IS NOT NULL AND team_id IS NOT NULL GROUP BY ALL),
gold AS (
 SELECT league, team_id, team, played, won, drawn, played - won - drawn AS lost, goals_for,
  goals_against, goals_for - goals_against AS goal_difference, won * 3 + drawn AS points
 FROM stats LEFT JOIN names USING (team_id))"""

CLEAN_TEAMS = """clean_teams AS (
 SELECT * REPLACE (coalesce(city, 'No informado') AS city, coalesce(venue, 'No informado') AS venue,
  coalesce(website, 'Sin sitio web') AS website)
 FROM teams_raw WHERE team_id IS NOT NULL AND name IS NOT NULL)"""

_TO_SILVER = (MATCHES, LATEST, SILVER)
_TO_GOLD = (*_TO_SILVER, NAMES, GOLD)

_BEST = "PARTITION BY league ORDER BY points DESC, goal_difference DESC, team_id"

NUMBER_TEXTS = """texts AS (
 SELECT event_id, CASE event_type WHEN 'view' THEN k WHEN 'click' THEN '  ' || k || ' '
   WHEN 'signup' THEN k || '.0'
   WHEN 'purchase' THEN CASE WHEN value > 10 THEN k || '.5' ELSE k || 'e2' END
   ELSE CASE WHEN value > 10 THEN k || 'd' ELSE '' END END AS text
 FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events)),
numbers AS (
 SELECT event_id, text, CASE WHEN regexp_full_match(trim(text), '[+-]?[0-9]+(\\.[0-9]*)?(e[0-9]+)?')
   THEN trim(text)::DOUBLE END AS d FROM texts)"""

EVENT_MESSAGES = """messages AS (
 SELECT CASE WHEN event_type IN ('view', 'click') THEN 'partidos'
   WHEN event_type IN ('signup', 'purchase') THEN 'equipos' ELSE 'otros' END AS topic,
  user_id::VARCHAR AS key, event_id AS arrival, event_id // 4 AS "offset",
  (event_id % 4)::INTEGER AS "partition", value >= 1 AS whole, event_type,
  json_extract_string(props, '$.k') AS k, strftime(ts, '%Y-%m-%d') AS day,
  floor(value)::BIGINT::VARCHAR AS floored
 FROM events)"""


_CASES_GOLD = """faulty AS (SELECT * REPLACE (CASE WHEN won <> 1 THEN goals_against END AS goals_against,
 lost - 1 AS lost, CASE WHEN drawn = 0 THEN '0' ELSE team_id END AS team_id) FROM gold)"""


def _form(c: str) -> str:
    return f"""CASE WHEN regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN '%Y-%m-%d'
  WHEN regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}} \\d{{2}}:\\d{{2}}:\\d{{2}}') THEN '%Y-%m-%d %H:%M:%S'
  WHEN regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}}T\\d{{2}}:\\d{{2}}:\\d{{2}}') THEN '%Y-%m-%dT%H:%M:%S'
  WHEN {c} LIKE '__/__/____' AND {c}[1:2]::INTEGER > 12 THEN '%d/%m/%Y'
  WHEN {c} LIKE '__/__/____' THEN '%m/%d/%Y' END"""


def _read_alike(c: str) -> str:
    """A text of the column's form as a date; slashes mean the day first if they do in the first text."""
    forms = ("%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%d/%m/%Y", "%m/%d/%Y")
    cases = " ".join(f"WHEN '{f}' THEN try_strptime({c}, '{f}')" for f in forms)
    return f"""CASE WHEN replace(coalesce({_form(c)}, ''), '%d/%m', '%m/%d') = replace({c}_form, '%d/%m', '%m/%d')
  THEN CASE {c}_form {cases} END END::TIMESTAMP AS {c}"""


_DATE_COLUMNS = ("with_time", "with_day", "mixed")
_COLUMN_DATES = f"""WITH texts AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'to be defined'
   WHEN o_orderkey % 11 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
   ELSE strftime(o_orderdate, '%Y-%m-%d') || ' ' || lpad((o_orderkey % 24)::VARCHAR, 2, '0') || ':30:00' END AS with_time,
  CASE WHEN o_orderpriority <> '5-LOW' THEN strftime(o_orderdate, '%d/%m/%Y') END AS with_day,
  CASE o_orderpriority WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y-%m-%d')
   WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d') || 'T20:00:00'
   WHEN '2-HIGH' THEN strftime(o_orderdate, '%d/%m/%Y') WHEN '4-NOT SPECIFIED' THEN 'soon' END AS mixed
  FROM orders),
forms AS (SELECT {", ".join(
    f"arg_min({_form(c)}, o_orderkey) FILTER ({_form(c)} IS NOT NULL) AS {c}_form" for c in _DATE_COLUMNS
)} FROM texts)
SELECT o_orderkey, {", ".join(_read_alike(c) for c in _DATE_COLUMNS)} FROM texts, forms"""


def _with(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def _rule(rule: str, column: str, source: str, failed: str, shown: str) -> str:
    return (
        f"SELECT '{rule}' AS rule, '{column}' AS \"column\", count(*) AS n_failed, "
        f"min({shown}) AS sample FROM {source} WHERE {failed} HAVING count(*) > 0"
    )


def _repeated(key: str, shown: str, source: str, name: str) -> str:
    return (
        f"SELECT 'unique' AS rule, '{name}' AS \"column\", sum(n)::BIGINT AS n_failed, "
        f"min(s) AS sample FROM (SELECT count(*) AS n, min({shown}) AS s FROM {source} "
        f"GROUP BY {key} HAVING count(*) > 1) HAVING count(*) > 0"
    )


def _response_match() -> str:
    """Matches as the landed JSON gives them: one row per id, stamped by the load."""
    return f"""SELECT * REPLACE ('2024-05-01T12:00:00+00:00' AS extracted_at,
  '2024-05-01' AS extract_date) FROM (SELECT {_MATCH} FROM latest)"""


_MEDALLION_BRONZE = f"bronze AS ({_response_match()})"
_MEDALLION_SILVER = SILVER.replace("EXCLUDE (tie_price, tie_supplier, d)", "EXCLUDE (d)").replace(
    "FROM latest", "FROM bronze"
)
_ENRICHED = """SELECT s.* RENAME (event_name AS match_label, status AS match_status,
  venue AS match_venue), coalesce(t.city, 'No informado') AS home_city,
  t.venue_capacity AS home_venue_capacity
 FROM silver s LEFT JOIN clean_teams t ON s.home_id = t.team_id"""

_FAULTY_SILVER = """faulty AS (
 SELECT * REPLACE (nullif(league, 'ASIA') AS league,
  CASE WHEN away_score = 4 THEN -1 ELSE home_score END AS home_score,
  CASE WHEN outcome = 'Empate' THEN 'Nulo' ELSE outcome END AS outcome) FROM silver
 UNION ALL SELECT * FROM silver WHERE is_blowout)"""

_FAULTY_GOLD = """faulty AS (
 SELECT * REPLACE (CASE WHEN won = 0 THEN points + 7 ELSE points END AS points,
  CASE WHEN drawn = 1 THEN lost + 1 ELSE lost END AS lost,
  CASE WHEN goals_for = 4 THEN -11 ELSE goals_for END AS goals_for,
  nullif(team, 'red widget') AS team) FROM gold
 UNION ALL SELECT * FROM gold WHERE league = 'EUROPE')"""

_GOLD_KEY = "league || '|' || team_id"


# Every rule of both contracts: rule, column, layer, what fails it.
_ALL_RULES = [
    *[("not_null", c, "silver", f"{c} IS NULL") for c in (
        "event_id", "league", "home_score", "away_score", "outcome", "score_difference", "is_blowout")],
    *[("at_least_0", c, "silver", f"{c} < 0") for c in ("home_score", "away_score", "score_difference")],
    ("one_of", "outcome", "silver", "outcome NOT IN ('Local', 'Visitante', 'Empate')"),
    ("unique", "event_id", "silver", "event_id IN (SELECT event_id FROM silver GROUP BY 1 HAVING count(*) > 1)"),
    *[("not_null", c, "gold", f"{c} IS NULL") for c in (
        "league", "team_id", "played", "won", "drawn", "lost", "goals_for", "goals_against", "goal_difference", "points")],
    *[("at_least_0", c, "gold", f"{c} < 0") for c in (
        "played", "won", "drawn", "lost", "goals_for", "goals_against", "points")],
    ("points_are_3_won_plus_drawn", "*", "gold", "points <> won * 3 + drawn"),
    ("played_is_won_drawn_lost", "*", "gold", "played <> won + drawn + lost"),
    ("unique", "league|team_id", "gold",
     "(league, team_id) IN (SELECT (league, team_id) FROM gold GROUP BY league, team_id HAVING count(*) > 1)"),
]


def oracle_sql() -> dict[str, str]:
    gold = {
        "standings": "SELECT * FROM gold",
        "standings_published_names": """SELECT league AS liga, team_id AS id_equipo,
 team AS equipo, played AS "PJ", won AS "PG", drawn AS "PE", lost AS "PP", goals_for AS "GF",
 goals_against AS "GC", goal_difference AS "DG", points AS "Pts" FROM gold""",
        "ranked_standings": f"SELECT *, row_number() OVER ({_BEST}) AS position FROM gold",
        "ranked_one_league": f"""SELECT league, team_id, points, row_number() OVER ({_BEST}) AS position
 FROM gold WHERE league = 'EUROPE'""",
        "podium": f"""SELECT league, position, CASE position WHEN 1 THEN '🥇' WHEN 2 THEN '🥈'
  WHEN 3 THEN '🥉' ELSE position::VARCHAR END AS place, team_id, team, played, won, drawn, lost,
  goals_for, goals_against, goal_difference, points, max_points
 FROM (SELECT *, row_number() OVER ({_BEST}) AS position,
  greatest(max(points) OVER (PARTITION BY league), 1)::BIGINT AS max_points FROM gold)""",
        "leaders": f"""SELECT league, team_id, team, points, won, goal_difference,
  coalesce(team, 'None') || ': ' || points || ' pts · ' || won || ' PG · DG ' ||
  CASE WHEN goal_difference >= 0 THEN '+' ELSE '' END || goal_difference AS headline
 FROM gold QUALIFY row_number() OVER ({_BEST}) = 1""",
        "league_kpis": """SELECT league, teams, coalesce(matches, 0) AS matches,
  coalesce(goals, 0) AS goals,
  CASE WHEN coalesce(matches, 0) = 0 THEN 0.0 ELSE goals::DOUBLE / matches END AS goals_per_match,
  printf('%.1f', CASE WHEN coalesce(matches, 0) = 0 THEN 0.0 ELSE goals::DOUBLE / matches END)
   AS goals_per_match_text,
  coalesce(blowouts, 0) AS blowouts
 FROM (SELECT league, count(*) AS teams FROM gold GROUP BY league)
 LEFT JOIN (SELECT league, count(*) AS matches, sum(home_score + away_score)::BIGINT AS goals,
  count(*) FILTER (is_blowout) AS blowouts FROM silver GROUP BY league) USING (league)""",
        "attack_defence": """SELECT league, team_id, team, goals_for, goals_against,
 points + 1 AS size, points, played, won, goal_difference FROM gold""",
        "leagues": "SELECT DISTINCT league FROM gold WHERE league IS NOT NULL",
        "league_count": "SELECT count(DISTINCT league) AS n_leagues FROM gold",
        "scale_max": """SELECT league, greatest(max(points), 1)::BIGINT AS max_points
 FROM gold GROUP BY league""",
        "text_formats": """SELECT league, team_id,
 CASE WHEN goal_difference >= 0 THEN '+' ELSE '' END || goal_difference AS signed_difference,
 printf('%.1f', goals_for / played) AS goals_per_match,
 format('{:,}', goals_for * 1000) AS grouped_goals FROM gold""",
        "upsert_gold": """SELECT * REPLACE (CASE WHEN won > 1 THEN points + 3 ELSE points END
 AS points) FROM gold""",
    }
    silver = {
        "name_map": "SELECT * FROM names",
        "outcome_counts": """SELECT league, count(*) FILTER (outcome = 'Local') AS home_wins,
 count(*) FILTER (outcome = 'Empate') AS draws,
 count(*) FILTER (outcome = 'Visitante') AS away_wins FROM silver GROUP BY league""",
        "blowouts": """SELECT league, event_id, event_date, home_team, home_score, away_score,
 away_team FROM silver WHERE is_blowout""",
        "upsert_silver": """SELECT event_id,
  CASE WHEN home_score = 3 THEN '1999' ELSE season END AS season, league, home_score,
  CASE WHEN home_score = 3 THEN away_score + 100 ELSE away_score END AS away_score FROM silver
 UNION ALL SELECT 'new-' || event_id, season, league, home_score, away_score FROM silver
 WHERE home_score = 2""",
    }
    raw = {
        "drop_incomplete_and_filter_finished": f"""SELECT * EXCLUDE (tie_price, tie_supplier)
 REPLACE (coalesce(venue, 'Estadio desconocido') AS venue,
  coalesce(season, 'Sin temporada') AS season)
 FROM (SELECT * REPLACE (nullif(home_score, 5) AS home_score, nullif(away_score, 4) AS away_score)
  FROM matches_raw)
 WHERE event_id IS NOT NULL AND home_score IS NOT NULL AND away_score IS NOT NULL AND {FINISHED}""",
        "derive_outcome": f"""SELECT event_id, extract_date, tie_price, tie_supplier, d AS event_date,
  home_score, away_score, {_DERIVED}
 FROM (SELECT *, try_strptime(event_date, '%Y-%m-%d') AS d FROM matches_raw)""",
        "rename_columns": """SELECT * EXCLUDE (tie_price, tie_supplier)
 RENAME (event_name AS match_label, status AS match_status, venue AS match_venue)
 FROM matches_raw""",
        "played_pending_counts": f"""SELECT count(*) FILTER ({FINISHED}) AS finished,
 count(*) - count(*) FILTER ({FINISHED}) AS pending FROM matches_raw""",
        "partition_overwrite": """SELECT event_id, league, home_score, away_score, extract_month
 FROM (SELECT *, substr(extract_date, 1, 7) AS extract_month FROM matches_raw)
 WHERE extract_month NOT IN (SELECT substr(extract_date, 1, 7) FROM matches_raw
  WHERE substr(extract_date, 1, 7) >= '1999-01' AND league <> 'ASIA')
 UNION ALL SELECT event_id, league, home_score + 10, away_score, extract_month
 FROM (SELECT *, substr(extract_date, 1, 7) AS extract_month FROM matches_raw)
 WHERE extract_month >= '1999-01' AND league <> 'ASIA'""",
        "publish_messages": """SELECT 'partidos' AS topic, event_id AS key, true AS is_object,
 * EXCLUDE (tie_price, tie_supplier)
 REPLACE (home_score::VARCHAR AS home_score, away_score::VARCHAR AS away_score)
 FROM matches_raw""",
    }
    teams = {
        "clean_teams": _with(TEAMS, CLEAN_TEAMS, select="SELECT * FROM clean_teams"),
        "full_overwrite": _with(TEAMS, select="SELECT * FROM teams_raw WHERE name IS NOT NULL"),
        "append_and_modes": _with(TEAMS, select="""SELECT team_id, name, league FROM teams_raw
 UNION ALL SELECT team_id, name, league FROM teams_raw WHERE league = 'ASIA'"""),
        "replace_by_condition": _with(TEAMS, select="""SELECT team_id,
 CASE WHEN founded_year < 1910 THEN upper(league) ELSE name END AS name, league, founded_year
 FROM teams_raw"""),
        "schema_evolution": _with(TEAMS, select="""SELECT team_id, name, league,
 CASE WHEN league = 'ASIA' THEN city END AS city FROM teams_raw"""),
        "table_summary": _with(TEAMS, select="""SELECT 'bronze/teams' AS name, 1::BIGINT AS version,
 count(*) AS n_rows, 14::BIGINT AS n_columns, false AS absent FROM teams_raw
 UNION ALL SELECT 'none', NULL, NULL, NULL, true"""),
        "partition_edge_values": _with(TEAMS, select="""SELECT team_id,
 CASE WHEN founded_year < 1905 THEN '' WHEN founded_year < 1910 THEN '__TEXT__'
  WHEN founded_year < 1915 THEN '__HIVE_DEFAULT_PARTITION__' WHEN founded_year < 1920 THEN 'a/b=c%2F d' END AS part,
 CASE WHEN founded_year = 1907 THEN 0 ELSE founded_year END AS founded_year FROM teams_raw"""),
        "check_rejected": _with(TEAMS, select="""SELECT team_id, name, founded_year, 'old_enough' AS rejected_by
 FROM teams_raw WHERE founded_year < 1920"""),
        "storable_types": _with(TEAMS, select="""SELECT team_id, NULL::VARCHAR AS nothing, 'string' AS type
 FROM teams_raw"""),
        "read_absent": _with(TEAMS, select="""SELECT 'absent' AS state, 0::BIGINT AS n_rows, 14::INTEGER AS n_columns
 UNION ALL SELECT 'present', count(*), 14 FROM teams_raw"""),
        "ignore_empty": _with(TEAMS, select="""SELECT league, count(*) AS n_teams FROM teams_raw
 WHERE league <> 'ASIA' GROUP BY league"""),
        "table_preview": _with(TEAMS, select="""SELECT team_id, name, league,
 row_number() OVER (ORDER BY league, team_id)::INTEGER AS place FROM teams_raw QUALIFY place <= 10"""),
        # One team per id and no blank city: the landed JSON gives the same rows,
        # with the venue's location where the city is missing.
        "map_raw_teams": _with(TEAMS, select="""SELECT * REPLACE (coalesce(city, venue_location)
 AS city, '2024-05-01T12:00:00+00:00' AS extracted_at) FROM teams_raw"""),
    }
    silver_rules = [
        _rule("not_null", "league", "faulty", "league IS NULL", "'NULL'"),
        _rule("at_least_0", "home_score", "faulty", "home_score < 0", "home_score::VARCHAR"),
        _rule("one_of", "outcome", "faulty",
              "outcome NOT IN ('Local', 'Visitante', 'Empate')", "outcome"),
        _repeated("event_id", "event_id", "faulty", "event_id"),
    ]
    gold_rules = [
        _rule("at_least_0", "goals_for", "faulty", "goals_for < 0", "goals_for::VARCHAR"),
        _rule("points_are_3_won_plus_drawn", "*", "faulty", "points <> won * 3 + drawn", _GOLD_KEY),
        _rule("played_is_won_drawn_lost", "*", "faulty", "played <> won + drawn + lost", _GOLD_KEY),
        _repeated("league, team_id", _GOLD_KEY, "faulty", "league|team_id"),
    ]
    text_gold = """faulty AS (SELECT * REPLACE (
  CASE WHEN won = 0 THEN 'none' ELSE played::VARCHAR END AS played) FROM gold)"""
    broken_text = """responses AS (
 SELECT * FROM matches_raw WHERE league_id <> '1' AND NOT (league_id = '2' AND venue IS NULL)),
first_matches AS (SELECT * FROM responses QUALIFY row_number() OVER (PARTITION BY event_id
  ORDER BY extract_date DESC NULLS LAST, tie_price DESC, tie_supplier, away_id, home_score) = 1),
counts AS (
 SELECT league_id AS source, 'n_matches' AS what, count(*) AS n FROM responses GROUP BY 1
 UNION ALL SELECT league_id, 'n_finished', count(*) FILTER (status = ' ft ') FROM responses GROUP BY 1
 UNION ALL SELECT league_id, 'n_fractional', count(*) FROM responses
  WHERE league_id = '3' AND home_score = 2 GROUP BY 1
 UNION ALL SELECT league_id, 'n_broken', count(*) FROM matches_raw
  WHERE league_id = '2' AND venue IS NULL GROUP BY 1
 UNION ALL SELECT league_id, 'n_teams', count(*) FROM teams_raw WHERE league_id <> '0' GROUP BY 1
 UNION ALL SELECT league_id, 'kept_teams', count(*) FROM teams_raw WHERE league_id NOT IN ('0', '4') GROUP BY 1
 UNION ALL SELECT league_id, 'kept_matches', count(*) FROM first_matches
  WHERE league_id NOT IN ('0', '3', '4') GROUP BY 1
 UNION ALL SELECT i::VARCHAR, 'n_teams', 0 FROM range(6) r(i)),
totals AS (SELECT source, """ + ", ".join(
        f"coalesce(sum(n) FILTER (what = '{c}'), 0)::BIGINT AS {c}"
        for c in ("n_teams", "n_matches", "n_finished", "n_broken", "n_fractional", "kept_teams", "kept_matches")
    ) + """ FROM counts GROUP BY source)"""
    latest_message = """SELECT * FROM messages WHERE topic = '{topic}' AND whole
 QUALIFY row_number() OVER (PARTITION BY key ORDER BY arrival DESC) = 1"""
    other = {
        "dedup_latest": _with(MATCHES, LATEST, select=f"SELECT {_MATCH} FROM latest"),
        "dedup_first": """SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice, l_partkey,
 l_suppkey, l_quantity FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
 ORDER BY l_shipdate, l_extendedprice, l_partkey, l_suppkey, l_quantity) = 1""",
        "dedup_last_in_batch": """SELECT event_id, user_id, event_type, value FROM events
 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
        "coerce_numeric": _with(NUMBER_TEXTS, select="""SELECT event_id, text,
 CASE WHEN d = floor(d) THEN d::BIGINT END AS number, coalesce(d <> floor(d), false) AS fractional FROM numbers"""),
        "whole_number_gate": _with(
            NUMBER_TEXTS,
            select=_rule("text_is_whole", "*", "numbers", "d <> floor(d)", "text"),
        ),
        "parse_dates": """SELECT o_orderkey, d AS event_date, year(d)::BIGINT AS match_year,
 month(d)::BIGINT AS match_month, dayname(d) AS weekday
 FROM (SELECT o_orderkey, CASE WHEN o_orderpriority NOT IN
  ('5-LOW', '4-NOT SPECIFIED', '3-MEDIUM') THEN date_trunc('day', o_orderdate)::TIMESTAMP END AS d
  FROM orders)""",
        "enrich_left_join": _with(MATCHES, TEAMS, CLEAN_TEAMS, select=f"""SELECT m.*,
 coalesce(t.city, 'No informado') AS home_city, t.venue_capacity AS home_venue_capacity
 FROM (SELECT {_MATCH} FROM matches_raw) m LEFT JOIN clean_teams t ON m.home_id = t.team_id"""),
        "refine_pipeline": _with(*_TO_SILVER, TEAMS, CLEAN_TEAMS, select=_ENRICHED),
        "contract_silver": _with(
            *_TO_SILVER, _FAULTY_SILVER, select="\nUNION ALL ".join(
                f"SELECT * FROM ({r})" for r in silver_rules)
        ),
        "contract_gold": _with(
            *_TO_GOLD, _FAULTY_GOLD, select="\nUNION ALL ".join(
                f"SELECT * FROM ({r})" for r in gold_rules)
        ),
        "contract_violations": _with(
            *_TO_GOLD, text_gold, select="""SELECT 'column_present' AS rule, 'drawn' AS "column",
 NULL::BIGINT AS n_failed, NULL::VARCHAR AS sample
 UNION ALL SELECT * FROM (""" + _rule(
                "castable", "played", "faulty", "try_cast(played AS BIGINT) IS NULL", "played"
            ) + ")"
        ),
        "contract_clean": _with(*_TO_GOLD, select="\nUNION ALL ".join(
            f"SELECT '{rule}' AS rule, '{column}' AS \"column\", count(*) AS n_failed FROM {source} WHERE {failed}"
            for rule, column, source, failed in _ALL_RULES)
        ),
        "contract_report": _with(
            *_TO_GOLD, """faulty AS (SELECT * REPLACE (CASE WHEN won <> 1 THEN goals_against END AS goals_against,
 lost - 1 AS lost) FROM gold)""", select="""SELECT * FROM (
 SELECT 'not_null' AS rule, 'goals_against' AS "column", count(*) AS n_failed FROM faulty WHERE goals_against IS NULL
 UNION ALL SELECT 'at_least_0', 'lost', count(*) FROM faulty WHERE lost < 0
 UNION ALL SELECT 'played_is_won_drawn_lost', '*', count(*) FROM faulty WHERE played <> won + drawn + lost)
 WHERE n_failed > 0"""),
        "cross_layer_check": _with(*_TO_SILVER, select=f"""SELECT finished, refined,
  NOT (finished > 0 AND refined = 0) AS consistent, layer
 FROM (SELECT count(*) FILTER ({FINISHED}) AS finished FROM matches_raw)
 CROSS JOIN (SELECT count(*) AS refined, 'sound' AS layer FROM silver
  UNION ALL SELECT 0, 'emptied')"""),
        "map_raw_matches": _with(MATCHES, LATEST, select=f"""SELECT * REPLACE (nullif(home_score, 5) AS home_score)
 FROM ({_response_match()})"""),
        "ingest_union_with_health": _with(MATCHES, TEAMS, broken_text, select="""SELECT *,
 CASE WHEN source = '4' THEN 'unlisted' WHEN n_teams = 0 THEN 'no_teams' WHEN n_fractional > 0 THEN 'bad_number'
  WHEN n_matches = 0 THEN 'no_matches' ELSE 'ok' END AS status
 FROM totals"""),
        "stream_upsert": _with(EVENT_MESSAGES, select=f"""SELECT topic, key AS id,
  event_type AS label, k::BIGINT AS number, day
 FROM ({latest_message.format(topic='partidos')})
 UNION ALL SELECT topic, key, 'user ' || key || ' ' || k, k::BIGINT, day
 FROM ({latest_message.format(topic='equipos')})"""),
        "stream_rejected": _with(EVENT_MESSAGES, select="""SELECT topic, key,
  CASE WHEN whole THEN '{"team_id":"' || key || '","name":"user ' || key || ' ' || k ||
   '","venue_capacity":"' || k || '","extracted_at":"' || day || '"}'
   ELSE '{"event_id":' END AS value, "offset",
  CASE WHEN topic = 'otros' THEN 'unknown_topic' ELSE 'not_a_json_object' END AS reason
 FROM messages WHERE topic = 'otros' OR NOT whole"""),
        "feed_lines": _with(EVENT_MESSAGES, select="""SELECT topic, key, CASE topic
  WHEN 'equipos' THEN 'EQUIPO | user ' || key || ' ' || k || ' | Ciudad: None | Estadio: None'
  WHEN 'partidos' THEN 'PARTIDO | None vs None | ' || k || '-' || floored ||
   ' | Fecha: None | Estado: None'
  ELSE 'Mensaje de tópico desconocido: otros' END AS line FROM messages WHERE whole"""),
        "stream_resumed": _with(EVENT_MESSAGES, select=f"""SELECT topic, key AS id, 'kept' AS label
 FROM ({latest_message.format(topic='partidos')})
 UNION ALL SELECT topic, key, 'kept' FROM ({latest_message.format(topic='equipos')})
 UNION ALL SELECT topic, key, CASE WHEN topic = 'otros' THEN 'unknown_topic' ELSE 'not_a_json_object' END
 FROM messages WHERE topic = 'otros' OR NOT whole"""),
        # A part of a third of the time is a batch; 'otros' is no known topic.
        "stream_counts": _with(EVENT_MESSAGES, select="""SELECT arrival * 3 // ((SELECT max(arrival) FROM messages) + 1) AS batch_id,
 nullif(topic, 'otros') AS topic, count(*) AS n_messages,
 count(*) FILTER (topic = 'otros' OR NOT whole) AS n_rejected,
 count(DISTINCT key) FILTER (topic <> 'otros' AND whole) AS n_upserted FROM messages GROUP BY ALL"""),
        "stream_admission": _with(EVENT_MESSAGES, select=f"""SELECT topic, key AS id,
  event_type AS label, k::BIGINT AS number, day, true AS several_batches
 FROM ({latest_message.format(topic='partidos')})
 UNION ALL SELECT topic, key, 'user ' || key || ' ' || k, k::BIGINT, day, true
 FROM ({latest_message.format(topic='equipos')})"""),
        "decoded_messages": _with(EVENT_MESSAGES, select="""SELECT topic, key,
 CASE WHEN "offset" % 5 <> 0 THEN 'ñ ' || CASE WHEN NOT whole THEN '{"event_id":'
  WHEN topic = 'partidos' THEN '{"event_id":"' || key || '","event_name":"' || event_type || '","home_score":"' || k ||
   '","away_score":"' || floored || '","extract_date":"' || day || '"}'
  ELSE '{"team_id":"' || key || '","name":"user ' || key || ' ' || k ||
   '","venue_capacity":"' || k || '","extracted_at":"' || day || '"}' END END AS value, "offset", "partition",
 CASE WHEN "offset" % 5 = 0 THEN base64('\\xC3'::BLOB) END AS undecoded FROM messages"""),
        "column_dates": _COLUMN_DATES,
        "contract_cases": _with(*_TO_GOLD, _CASES_GOLD, select="\nUNION ALL ".join(
            f"""SELECT '{rule}' AS rule, '{column}' AS "column", place, shown FROM (
 SELECT shown, row_number() OVER (ORDER BY shown)::INTEGER AS place FROM (SELECT DISTINCT {shown} AS shown FROM {source}))
 WHERE place <= 5""" for rule, column, shown, source in (
                ("not_null", "goals_against", "'NULL'", "faulty WHERE goals_against IS NULL"),
                ("at_least_0", "lost", "lost::VARCHAR", "faulty WHERE lost < 0"),
                ("played_is_won_drawn_lost", "*", "league || '|' || team_id", "faulty WHERE played <> won + drawn + lost"),
                ("unique", "league|team_id", "league || '|' || team_id",
                 "(SELECT league, team_id FROM faulty GROUP BY league, team_id HAVING count(*) > 1)"),
            ))),
        "document_paths": """WITH whole AS (SELECT * FROM events WHERE value >= 1)
 SELECT path, type, n_values FROM (
  SELECT '$' AS path, 'OBJECT' AS type, count(*) AS n_values FROM whole
  UNION ALL SELECT '$.type', 'STRING', count(*) FROM whole
  UNION ALL SELECT '$.props', 'OBJECT', count(*) FROM whole
  UNION ALL SELECT '$.props.k', 'BIGINT', count(*) FROM whole WHERE json_type(props, '$.k') IN ('UBIGINT', 'BIGINT')
  UNION ALL SELECT '$.tags', 'ARRAY', count(*) FROM whole
  UNION ALL SELECT '$.tags[*]', 'BIGINT', count(*) FROM whole
  UNION ALL SELECT '$.tags[*]', 'STRING', count(*) FROM whole
  UNION ALL SELECT '$.cheap', 'BOOLEAN', count(*) FROM whole WHERE value < 10
  UNION ALL SELECT '$.cheap', 'VOID', count(*) FROM whole WHERE value >= 10) WHERE n_values > 0""",
        "set_aside": _with(MATCHES, TEAMS, select="""SELECT 'matches' AS kind, league_id AS source, 'not_json' AS reason,
  '{"events":[' || event_id AS what FROM matches_raw WHERE league_id = '2' AND venue IS NULL
 UNION ALL SELECT 'teams', league_id, 'constraint', team_id FROM teams_raw WHERE name IS NULL"""),
        "medallion_summary": _with(
            MATCHES, LATEST, _MEDALLION_BRONZE, _MEDALLION_SILVER, NAMES, GOLD, TEAMS,
            select=f"""SELECT 'bronze/teams' AS name, 1::BIGINT AS version, count(*) AS n_rows, 14 AS n_columns,
  NULL::BIGINT AS n_finished, NULL::BIGINT AS n_keys FROM teams_raw WHERE name IS NOT NULL
 UNION ALL SELECT 'bronze/matches', 1, count(*), 17, count(*) FILTER ({FINISHED}), count(DISTINCT event_id) FROM bronze
 UNION ALL SELECT 'silver/matches', 0, count(*), 25, count(*), count(DISTINCT event_id) FROM silver
 UNION ALL SELECT 'gold/standings', 0, count(*), 11, NULL, count(DISTINCT (league, team_id)) FROM gold""",
        ),
        "built_once": _with(
            MATCHES, LATEST, _MEDALLION_BRONZE, _MEDALLION_SILVER, NAMES, GOLD,
            select="SELECT league, count(*) AS n_teams, true AS built, false AS built_again FROM gold GROUP BY league",
        ),
        "standings_shown": _with(*_TO_GOLD, select="""SELECT
 row_number() OVER (ORDER BY league NULLS FIRST, points DESC, team_id) AS place, league, team_id, points FROM gold"""),
        "blowouts_shown": _with(*_TO_SILVER, select="""SELECT
 row_number() OVER (ORDER BY event_date DESC NULLS LAST, event_id) AS place, event_id, event_date
 FROM silver WHERE is_blowout"""),
        "run_medallion": _with(
            MATCHES, LATEST, _MEDALLION_BRONZE, _MEDALLION_SILVER, NAMES, GOLD,
            select="SELECT * FROM gold"
        ),
        # The landed teams' city falls back to the venue's location.
        "medallion_silver": _with(
            MATCHES, LATEST, _MEDALLION_BRONZE, _MEDALLION_SILVER,
            TEAMS.replace("CASE WHEN c_acctbal >= 0 THEN n_name END AS city", "n_name AS city"),
            CLEAN_TEAMS, select=_ENRICHED
        ),
    }
    sql = dict(teams) | other
    sql |= {k: _with(*_TO_GOLD, select=v) for k, v in gold.items()}
    sql |= {k: _with(*_TO_SILVER, NAMES, select=v) for k, v in silver.items()}
    sql |= {k: _with(MATCHES, select=v) for k, v in raw.items()}
    return sql
