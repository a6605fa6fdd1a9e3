"""Independent SQL (DuckDB dialect) for every query in the catalogue.

Each statement rebuilds its fixture from the benchmark tables in a CTE and then
states the operator's meaning in plain SQL.  DuckDB differences handled here:
``sum`` of integers is HUGEINT (cast to BIGINT), ``year()`` is BIGINT (cast to
INTEGER), a double → integer cast rounds (``trunc`` first), decimal literals are
DECIMAL (cast to DOUBLE), and ``DESC`` defaults to NULLS LAST (stated explicitly).
"""

from __future__ import annotations

from layerwise.plans.fixtures import NATION_ALIASES, NATION_ALIASES_CI, TABLES


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _r(expr: str, digits: int = 0) -> str:
    """Round a double as Spark does: HALF_UP on its shortest decimal text (DuckDB's own
    ``round`` scales in binary first, which can flip a last digit)."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def _dec(expr: str, scale: int = 6, precision: int = 18) -> str:
    """Double → DECIMAL as Spark casts it: from the shortest decimal text, HALF_UP."""
    return f"CAST(CAST({expr} AS VARCHAR) AS DECIMAL({precision},{scale}))"


def _int(expr: str) -> str:
    """Number or numeric text → integer, truncated toward zero."""
    return f"TRY_CAST(trunc(TRY_CAST({expr} AS DOUBLE)) AS INTEGER)"


def _decimal_text(number: str, key: str) -> str:
    return f"(CAST({number} AS VARCHAR) || CASE WHEN {key} % 2 = 0 THEN '.0' ELSE '' END)"


def _exact_case(col: str, aliases: dict[str, str]) -> str:
    arms = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in aliases.items())
    return f"coalesce(CASE {col} {arms} END, {col})"


def _ci_case(col: str, aliases: dict[str, str]) -> str:
    exact = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in aliases.items())
    folded = " ".join(
        f"WHEN lower({col}) = lower({_q(k)}) OR lower({col}) = lower({_q(v)}) THEN {_q(v)}"
        for k, v in aliases.items()
    )
    return (
        f"CASE WHEN {col} IS NULL OR {col} = '' THEN {col} "
        f"ELSE coalesce(CASE {col} {exact} END, CASE {folded} END, {col}) END"
    )


CONTEST_JOIN = """cj AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_partkey, l.l_returnflag,
         CAST(o.o_orderdate AS DATE) AS o_date, c.c_custkey, c.c_name,
         hn.n_name AS home_team, hn.n_regionkey AS home_region, an.n_name AS away_team,
         c.c_nationkey AS home_key, s.s_nationkey AS away_key
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation hn ON c.c_nationkey = hn.n_nationkey
  JOIN nation an ON s.s_nationkey = an.n_nationkey)"""

CONTESTS = CONTEST_JOIN + """,
contests AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS contest_id,
         home_team, away_team, CAST(year(o_date) AS INTEGER) AS season, o_date AS contest_date,
         CAST(trunc(l_quantity) AS INTEGER) % 7 AS home_score, l_linenumber AS away_score
  FROM cj)"""

TWO_SIDED = CONTESTS.replace("FROM cj)", "FROM cj WHERE home_team <> away_team)")

RATINGS = """ratings AS (
  SELECT user_id AS entity, CAST(ts AS DATE) AS snapshot_date,
         1500 + max(event_id) % 400 AS rating,
         CAST(sum(event_id % 5) AS BIGINT) AS goals_for,
         count(*) AS matches_total,
         CAST(user_id % 16 = 0 AS INTEGER) AS is_host,
         user_id % 6 AS grp
  FROM events GROUP BY user_id, CAST(ts AS DATE))"""

TEXT_RATINGS = RATINGS.replace("ratings AS (", "typed AS (", 1) + """,
ratings AS (
  SELECT * REPLACE (CASE WHEN entity % 17 = 3 THEN 'n/a' ELSE CAST(snapshot_date AS VARCHAR) END AS snapshot_date)
  FROM typed)"""
_KNOWN = "TRY_CAST(snapshot_date AS DATE)"

SCHEDULE = """schedule AS (
  SELECT DISTINCT
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || '_' || CAST(o_custkey // 9 AS VARCHAR)
           || '_' || CAST(o_orderkey // 100 AS VARCHAR) AS match_id,
         o_custkey // 9 AS home_team, o_orderkey // 100 AS away_team,
         CAST(o_orderdate AS DATE) AS match_date
  FROM orders WHERE o_custkey // 9 <> o_orderkey // 100)"""

RANKINGS = """rankings AS (
  SELECT c_custkey AS entity, CASE WHEN c_custkey % 2 = 0 THEN 2022 ELSE 2026 END AS year,
         c_custkey % 211 + 1 AS rank, CAST(trunc(c_acctbal) AS INTEGER) AS points
  FROM customer)"""

SEASON_RANKS = """season_ranks AS (
  SELECT n.n_name AS team, CAST(1995 + c.c_custkey % 9 AS INTEGER) AS year,
         c.c_custkey % 211 + 1 AS rank
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

SIDES = """sides AS (
  SELECT home_team AS team, season, home_score AS gs, away_score AS gc FROM contests
  UNION ALL
  SELECT away_team AS team, season, away_score AS gs, home_score AS gc FROM contests),
tp AS (
  SELECT team, season,
         CAST(sum(CASE WHEN gs > gc THEN 1 ELSE 0 END) AS BIGINT) AS wins,
         CAST(sum(CASE WHEN gs < gc THEN 1 ELSE 0 END) AS BIGINT) AS losses,
         CAST(sum(CASE WHEN gs = gc THEN 1 ELSE 0 END) AS BIGINT) AS draws,
         count(*) AS matches_played,
         CAST(sum(gs) AS BIGINT) AS goals_scored,
         CAST(sum(gc) AS BIGINT) AS goals_conceded,
         avg(gs) AS avg_goals_scored, avg(gc) AS avg_goals_conceded
  FROM sides GROUP BY team, season)"""

STANDINGS = f"""{TWO_SIDED},
{SEASON_RANKS},
{SIDES},
ra AS (SELECT team, year, avg(rank) AS avg_rank FROM season_ranks GROUP BY team, year),
standings AS (
  SELECT tp.team, tp.season, wins, losses, draws, matches_played, goals_scored, goals_conceded,
         goals_scored - goals_conceded AS goal_difference, wins * 3 + draws AS points,
         {_r('avg_goals_scored', 6)} AS avg_goals_scored,
         {_r('avg_goals_conceded', 6)} AS avg_goals_conceded,
         {_r('ra.avg_rank', 6)} AS avg_rank
  FROM tp LEFT JOIN ra ON tp.team = ra.team AND tp.season = ra.year)"""

SEASON_STATS = """season_stats AS (
  SELECT season, count(*) AS total_matches,
         CAST(sum(home_score) + sum(away_score) AS BIGINT) AS total_goals,
         avg(home_score + away_score) AS avg_goals_per_match,
         max(home_score + away_score) AS max_goals_in_match,
         CAST(sum(CASE WHEN home_score > away_score THEN 1 ELSE 0 END) AS BIGINT) AS home_wins,
         CAST(sum(CASE WHEN home_score < away_score THEN 1 ELSE 0 END) AS BIGINT) AS away_wins,
         CAST(sum(CASE WHEN home_score = away_score THEN 1 ELSE 0 END) AS BIGINT) AS draws
  FROM contests GROUP BY season)"""

DOCS = """docs AS (
  SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

NUMBERS = """numbers AS (
  SELECT p_partkey AS key,
         CASE WHEN p_size % 5 = 0 THEN p_type WHEN p_size % 7 = 0 THEN CAST(p_size AS VARCHAR) || '.5'
              ELSE CAST(p_size AS VARCHAR) END AS text,
         p_retailprice AS price
  FROM part)"""

REGISTRY = "registry AS (\n" + "\n  UNION ALL\n".join(
    f"  SELECT '{t}' AS table_name, '{t}.parquet' AS source_file, count(*) AS row_count, "
    f"'1.0' AS schema_version FROM {t}"
    for t in TABLES
) + ")"

CUSTOMER_CHANGES = """cur AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer),
chg AS (
  SELECT c_custkey, c_name || '*' AS c_name,
         CASE WHEN c_custkey % 4 = 0 THEN CAST(NULL AS DOUBLE) ELSE c_acctbal + 1 END AS c_acctbal,
         'UPDATED' AS c_mktsegment
  FROM customer WHERE c_custkey % 2 = 0
  UNION ALL
  SELECT -c_custkey - 1, 'NEW ' || c_name, c_acctbal, c_mktsegment
  FROM customer WHERE c_custkey % 7 = 0)"""

PREDICTION_INPUTS = f"""{SCHEDULE},
{RATINGS},
{RANKINGS},
latest AS (
  SELECT * FROM ratings
  QUALIFY row_number() OVER (PARTITION BY entity ORDER BY snapshot_date DESC NULLS LAST,
          rating NULLS LAST, goals_for NULLS LAST, matches_total NULLS LAST,
          is_host NULLS LAST) = 1),
r26 AS (SELECT entity, min(rank) AS rank FROM rankings WHERE year = 2026 GROUP BY entity)"""

_PREDICT = f"""pj AS (
  SELECT s.match_id, s.home_team, s.away_team, s.match_date,
         rh.rank AS home_rank, ra.rank AS away_rank,
         coalesce(h.rating, 1500) AS rating_home, coalesce(a.rating, 1500) AS rating_away,
         coalesce(h.goals_for, 1) AS gh, coalesce(a.goals_for, 1) AS ga,
         coalesce(h.matches_total, 1) AS mh, coalesce(a.matches_total, 1) AS ma,
         coalesce(h.is_host, 0) AS hh, coalesce(a.is_host, 0) AS ah
  FROM keyed s
  LEFT JOIN latest h ON s.home_key = h.entity
  LEFT JOIN latest a ON s.away_key = a.entity
  LEFT JOIN r26 rh ON s.home_key = rh.entity
  LEFT JOIN r26 ra ON s.away_key = ra.entity),
pd1 AS (
  SELECT *, rating_home + (CASE WHEN hh = 1 THEN 100 WHEN ah = 1 THEN -100 ELSE 0 END)
            - rating_away AS diff
  FROM pj),
pd2 AS (
  SELECT *,
         CAST(1.0 AS DOUBLE) / (CAST(1.0 AS DOUBLE)
           + pow(CAST(10.0 AS DOUBLE), -diff / CAST(400.0 AS DOUBLE))) AS base,
         CAST(0.25 AS DOUBLE) * exp(-pow(diff / CAST(300.0 AS DOUBLE), CAST(2.0 AS DOUBLE))) AS pdraw
  FROM pd1),
pd3 AS (
  SELECT *, base * (1 - pdraw) AS ph, (1 - base) * (1 - pdraw) AS pa,
         (gh / mh) * (rating_home / rating_away) AS xh,
         (ga / ma) * (rating_away / rating_home) AS xa
  FROM pd2),
predictions AS (
  SELECT match_id, home_team, away_team, match_date, home_rank, away_rank,
         rating_home, rating_away,
         {_r('ph', 4)} AS prob_home_win, {_r('pa', 4)} AS prob_away_win, {_r('pdraw', 4)} AS prob_draw,
         {_r('xh', 2)} AS expected_goals_home, {_r('xa', 2)} AS expected_goals_away,
         CASE WHEN ph > pa AND ph > pdraw THEN CAST(home_team AS VARCHAR)
              WHEN pa > ph AND pa > pdraw THEN CAST(away_team AS VARCHAR)
              ELSE 'Draw' END AS predicted_winner
  FROM pd3)"""


PREDICTIONS = f"""{PREDICTION_INPUTS},
keyed AS (SELECT *, home_team AS home_key, away_team AS away_key FROM schedule),
{_PREDICT}"""


def _pct(col: str) -> str:
    return f"CAST(round({_dec(col)} * 100, 1) AS VARCHAR) || '%'"


ORACLE: dict[str, str] = {}

ORACLE["team_performance"] = f"WITH {STANDINGS}\nSELECT * FROM standings"

ORACLE["standings_incremental"] = ORACLE["team_performance"]

ORACLE["season_stats"] = f"""WITH {CONTESTS},
{SEASON_STATS}
SELECT season, total_matches, total_goals, {_r('avg_goals_per_match', 6)} AS avg_goals_per_match,
       max_goals_in_match, home_wins, away_wins, draws
FROM season_stats ORDER BY season DESC NULLS FIRST"""

ORACLE["season_stats_incremental"] = ORACLE["season_stats"]

ORACLE["rank_average"] = f"""WITH {SEASON_RANKS}
SELECT team, year, {_r('avg(rank)', 6)} AS avg_rank FROM season_ranks GROUP BY team, year"""

ORACLE["top_teams"] = f"""WITH {TWO_SIDED},
{SIDES}
SELECT team, CAST(sum(wins) AS BIGINT) AS total_wins, CAST(sum(matches_played) AS BIGINT) AS total_matches,
       CAST(sum(goals_scored) AS BIGINT) AS total_goals
FROM tp GROUP BY team
ORDER BY total_wins DESC NULLS FIRST, team ASC NULLS LAST LIMIT 10"""

ORACLE["team_performance_search"] = f"""WITH {STANDINGS}
SELECT * FROM standings WHERE team ILIKE '%nation_1%' AND season = 1998
ORDER BY season DESC NULLS FIRST, points DESC NULLS FIRST, team ASC NULLS LAST LIMIT 100"""

ORACLE["season_goal_series"] = f"""WITH {CONTESTS},
{SEASON_STATS}
SELECT make_timestamp(season, 1, 1, 0, 0, 0) AS time, total_goals AS value
FROM season_stats ORDER BY season"""

ORACLE["safe_cast"] = f"""WITH {NUMBERS}
SELECT key, text, {_int('text')} AS as_int, {_int('price')} AS price_int
FROM numbers"""

ORACLE["parse_dates"] = """WITH raw AS (
  SELECT o_orderkey AS key,
         CASE WHEN o_orderkey % 13 = 0 THEN 'not a date'
              ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS text
  FROM orders)
SELECT key, text, CAST(try_strptime(text, '%Y-%m-%d') AS DATE) AS parsed,
       TRY_CAST(text AS DATE) AS casted
FROM raw"""

ORACLE["default_fill"] = f"""WITH {DOCS}
SELECT doc_id,
       coalesce(TRY_CAST(quality AS INTEGER), 0) AS quality_filled,
       TRY_CAST(coalesce(toxic, 0) AS INTEGER) AS toxic_filled,
       coalesce(TRY_CAST(lang AS INTEGER), 0) AS lang_cast_first,
       TRY_CAST(coalesce(lang, '0') AS INTEGER) AS lang_coalesce_first,
       coalesce(CASE WHEN quality = 1 THEN 'good' WHEN quality = 0 THEN 'poor' END, 'Unknown') AS verdict
FROM docs"""

ORACLE["split_location"] = r"""WITH v AS (
  SELECT c.c_custkey AS key,
         CASE WHEN c.c_custkey % 3 = 0 THEN c.c_name || ', ' || n.n_name || ', ' || r.r_name
              WHEN c.c_custkey % 3 = 1 THEN c.c_name END AS venue
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT key, venue, coalesce(split_part(venue, ',', 1), 'Unknown') AS stadium,
       coalesce(trim(regexp_extract(venue, ',\s*(.+)$', 1)), 'Unknown') AS city
FROM v"""

ORACLE["normalise_names"] = f"""WITH {CONTESTS}
SELECT contest_id, home_team, {_exact_case('home_team', NATION_ALIASES)} AS home_team_norm,
       away_team, {_exact_case('away_team', NATION_ALIASES)} AS away_team_norm
FROM contests"""

ORACLE["normalise_names_ci"] = f"""WITH {CONTESTS},
names AS (
  SELECT contest_id,
         CASE WHEN away_score = 7 THEN '' WHEN away_score % 2 = 0 THEN lower(home_team)
              ELSE home_team END AS name
  FROM contests)
SELECT contest_id, name, {_ci_case('name', NATION_ALIASES_CI)} AS name_norm FROM names"""

CLUB_ALIASES = """pairs AS (
  SELECT 'Club ' || c_custkey AS alias, 'Team ' || c_custkey AS canonical FROM customer WHERE c_custkey % 5 = 0
  UNION ALL
  SELECT 'Club ' || c_custkey, 'Zeam ' || c_custkey FROM customer WHERE c_custkey % 50 = 0),
exact AS (SELECT alias, min(canonical) AS canonical FROM pairs GROUP BY alias),
folded AS (
  SELECT spelling, min(canonical) AS canonical FROM (
    SELECT lower(alias) AS spelling, canonical FROM pairs UNION ALL SELECT lower(canonical), canonical FROM pairs)
  GROUP BY spelling)"""


def _spelled(entity: str, other: str, prefix: str = "Club ") -> str:
    return f"(CASE WHEN {other} THEN '{prefix}' ELSE 'Team ' END || {entity})"


ORACLE["normalise_names_by_table"] = f"""WITH {CLUB_ALIASES},
names AS (
  SELECT c_custkey AS key, CASE WHEN c_custkey % 3 = 0 THEN 'Club ' WHEN c_custkey % 3 = 1 THEN 'CLUB '
                                ELSE 'team ' END || c_custkey AS name FROM customer)
SELECT key, name, coalesce(e.canonical, name) AS exact_name,
       coalesce(e.canonical, f.canonical, name) AS any_case_name
FROM names LEFT JOIN exact e ON name = e.alias LEFT JOIN folded f ON lower(name) = f.spelling"""

ORACLE["rank_lookup_fallback"] = f"""WITH {CONTESTS},
dim AS (
  SELECT team, min(rank) AS rank FROM (
    SELECT {_exact_case('n_name', NATION_ALIASES)} AS team, n_nationkey + 1 AS rank FROM nation)
  GROUP BY team),
c AS (SELECT contest_id, home_team, {_exact_case('home_team', NATION_ALIASES)} AS clean FROM contests)
SELECT c.contest_id, c.home_team, CASE WHEN r.team IS NOT NULL THEN r.rank ELSE k.rank END AS home_rank
FROM c LEFT JOIN dim r ON c.home_team = r.team LEFT JOIN dim k ON c.clean = k.team"""

_RANK_TEXT = f"CASE WHEN c_custkey % 50 = 0 THEN 'n/a' ELSE {_decimal_text('(c_custkey % 211 + 1)', 'c_custkey')} END"
_NAME_TEXT = "CASE WHEN c_custkey % 4 = 0 THEN ' ' || c_name || ' ' ELSE c_name END"
ORACLE["standardise_rankings"] = f"""WITH v2022 AS (
  SELECT {_RANK_TEXT} AS rank, {_NAME_TEXT} AS team, c_acctbal AS points
  FROM customer WHERE c_custkey % 2 = 0),
v2026 AS (
  SELECT {_RANK_TEXT} AS rank, {_NAME_TEXT} AS country, c_acctbal AS points
  FROM customer WHERE c_custkey % 2 = 1
  UNION ALL
  SELECT {_RANK_TEXT} AS rank, {_NAME_TEXT} AS country, c_acctbal + 1 AS points
  FROM customer WHERE c_custkey % 2 = 1 AND c_custkey % 5 = 0),
std AS (
  SELECT {_int('rank')} AS rank, trim(team) AS country,
         TRY_CAST(trunc(points) AS INTEGER) AS points, 2022 AS year FROM v2022
  UNION ALL
  SELECT {_int('rank')}, trim(country), TRY_CAST(trunc(points) AS INTEGER), 2026 FROM v2026)
SELECT rank, country, points, year FROM std
QUALIFY row_number() OVER (PARTITION BY country, year
        ORDER BY rank ASC NULLS LAST, points ASC NULLS LAST) = 1"""

ORACLE["clean_history"] = f"""WITH {CONTEST_JOIN},
grouped AS (
  SELECT year(o_date) AS season, home_key, max(away_key) AS most, min(away_key) AS least, count(*) AS n
  FROM cj GROUP BY year(o_date), home_key),
hist AS (
  SELECT CAST(season AS VARCHAR) AS "Year", h.n_name AS "Host", m.n_name AS "Champion",
         l.n_name AS "Runner-Up", {_decimal_text('n', 'n')} AS "Matches"
  FROM grouped JOIN nation h ON h.n_nationkey = home_key JOIN nation m ON m.n_nationkey = most
  JOIN nation l ON l.n_nationkey = least),
c AS (
  SELECT {_int('"Year"')} AS year, coalesce("Host", 'Unknown') AS host_country,
         coalesce("Champion", 'Unknown') AS winner, coalesce("Runner-Up", 'Unknown') AS runner_up,
         CAST(NULL AS VARCHAR) AS third_place, CAST(NULL AS VARCHAR) AS fourth_place,
         CAST(NULL AS INTEGER) AS goals_scored,
         coalesce({_int('"Matches"')}, 0) AS matches_played
  FROM hist)
SELECT * FROM c
QUALIFY row_number() OVER (PARTITION BY year ORDER BY host_country ASC NULLS LAST,
        winner ASC NULLS LAST, runner_up ASC NULLS LAST, matches_played ASC NULLS LAST) = 1"""

ORACLE["clean_schedule"] = """WITH raw AS (
  SELECT CASE WHEN o_orderkey % 97 = 0 THEN 'TBD'
              ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS "Date",
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS "Round",
         CAST(o_custkey // 9 AS VARCHAR) AS home_team, CAST(o_orderkey // 100 AS VARCHAR) AS away_team
  FROM orders),
c AS (
  SELECT concat_ws('_', "Date", home_team, away_team) AS match_id,
         CAST(try_strptime("Date", '%Y-%m-%d') AS DATE) AS match_date,
         coalesce("Round", 'Unknown') AS stage, 'TBD' AS group_name, home_team, away_team,
         'TBD' AS stadium, 'TBD' AS city
  FROM raw)
SELECT * FROM c
QUALIFY row_number() OVER (PARTITION BY match_id ORDER BY stage ASC NULLS LAST) = 1"""

RAW_CONTESTS = CONTEST_JOIN + f""",
raw AS (
  SELECT CASE WHEN l_orderkey % 89 = 0 THEN 'unknown' ELSE CAST(o_date AS VARCHAR) END AS "Date",
         CAST(year(o_date) AS VARCHAR) AS "Year", l_returnflag AS "Round",
         CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE home_team END AS home_team, away_team,
         {_decimal_text('(CAST(trunc(l_quantity) AS INTEGER) % 7)', 'l_linenumber')} AS home_score,
         CASE WHEN l_orderkey % 53 = 0 THEN 'x' ELSE CAST(l_linenumber AS VARCHAR) END AS away_score,
         l_partkey AS "Attendance",
         CASE WHEN c_custkey % 3 = 0 THEN c_name || ', ' || home_team || ', ' || r.r_name
              WHEN c_custkey % 3 = 1 THEN c_name END AS "Venue"
  FROM cj JOIN region r ON cj.home_region = r.r_regionkey),
c AS (
  SELECT concat_ws('_', "Date", coalesce(home_team, 'Unknown'), coalesce(away_team, 'Unknown')) AS match_id,
         {_int('"Year"')} AS year,
         CAST(try_strptime("Date", '%Y-%m-%d') AS DATE) AS match_date,
         coalesce("Round", 'Unknown') AS stage, CAST(NULL AS VARCHAR) AS group_name,
         coalesce(home_team, 'Unknown') AS home_team, coalesce(away_team, 'Unknown') AS away_team,
         {_int("coalesce(home_score, '0')")} AS home_score,
         {_int("coalesce(away_score, '0')")} AS away_score,
         coalesce(split_part("Venue", ',', 1), 'Unknown') AS stadium,
         coalesce(trim(regexp_extract("Venue", ',\\s*(.+)$', 1)), 'Unknown') AS city,
         {_int('coalesce("Attendance", 0)')} AS attendance,
         concat_ws(',', CASE WHEN try_strptime("Date", '%Y-%m-%d') IS NULL THEN 'date' END,
                   CASE WHEN home_team IS NULL THEN 'home_team' END,
                   CASE WHEN away_team IS NULL THEN 'away_team' END) AS reason
  FROM raw)"""

ORACLE["clean_contests"] = f"""WITH {RAW_CONTESTS}
SELECT * EXCLUDE (reason) FROM c
QUALIFY row_number() OVER (PARTITION BY match_id ORDER BY year ASC NULLS LAST, stage ASC NULLS LAST,
        home_score ASC NULLS LAST, away_score ASC NULLS LAST, stadium ASC NULLS LAST, city ASC NULLS LAST,
        attendance ASC NULLS LAST) = 1"""

ORACLE["contest_rejects"] = f"""WITH {RAW_CONTESTS}
SELECT * FROM c WHERE reason <> ''"""

ORACLE["route_contests"] = f"""WITH {RAW_CONTESTS},
kept AS (
  SELECT * EXCLUDE (reason) FROM c WHERE reason = ''
  QUALIFY row_number() OVER (PARTITION BY match_id ORDER BY year ASC NULLS LAST, stage ASC NULLS LAST,
          home_score ASC NULLS LAST, away_score ASC NULLS LAST, stadium ASC NULLS LAST, city ASC NULLS LAST,
          attendance ASC NULLS LAST) = 1)
SELECT *, CAST(NULL AS VARCHAR) AS reason FROM kept UNION ALL SELECT * FROM c WHERE reason <> ''"""

ORACLE["routing_record"] = f"""WITH {RAW_CONTESTS}
SELECT count(*) AS rows_in, count(DISTINCT match_id) FILTER (WHERE reason = '') AS kept_records,
       count(*) FILTER (WHERE reason = '') - count(DISTINCT match_id) FILTER (WHERE reason = '') AS duplicate_count,
       count(*) FILTER (WHERE reason <> '') AS rejected_records,
       (SELECT count(*) FROM raw WHERE "Date" IS NOT NULL AND try_strptime("Date", '%Y-%m-%d') IS NULL
               OR "Year" IS NOT NULL AND {_int('"Year"')} IS NULL) AS invalid_records,
       'contests' AS table_name
FROM c"""

_CONTEST_ORDER = ("home_team ASC NULLS LAST, away_team ASC NULLS LAST, season ASC NULLS LAST, "
                  "contest_date ASC NULLS LAST, home_score ASC NULLS LAST, away_score ASC NULLS LAST")

ORACLE["dedup_keep_one"] = f"""WITH {CONTESTS},
scored AS (SELECT * REPLACE (nullif(home_score, 0) AS home_score) FROM contests)
SELECT * FROM scored
QUALIFY row_number() OVER (PARTITION BY contest_id ORDER BY {_CONTEST_ORDER}) = 1"""

ORACLE["dedup_report"] = f"""WITH {CONTESTS}
SELECT count(*) AS total_rows,
       (SELECT count(*) FROM (SELECT DISTINCT contest_id FROM contests)) AS distinct_keys,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT contest_id FROM contests)) AS duplicate_count
FROM contests"""

ORACLE["quality_profile"] = f"""WITH {CONTESTS},
{DOCS},
{NUMBERS},
kept_docs AS (
  SELECT * FROM docs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY lang ASC NULLS LAST,
         source ASC NULLS LAST, quality ASC NULLS LAST, toxic ASC NULLS LAST) = 1),
kept_contests AS (
  SELECT * FROM contests QUALIFY row_number() OVER (PARTITION BY contest_id ORDER BY {_CONTEST_ORDER}) = 1),
parsed AS (SELECT key, text, {_int('text')} AS as_int FROM numbers),
kept_numbers AS (
  SELECT * FROM parsed QUALIFY row_number() OVER (PARTITION BY key ORDER BY text ASC NULLS LAST,
         as_int ASC NULLS LAST) = 1),
log AS (
  SELECT 'labelled_docs' AS table_name, count(*) AS total_records,
         CAST(count(*) FILTER (WHERE doc_id IS NULL) + count(*) FILTER (WHERE lang IS NULL)
              + count(*) FILTER (WHERE source IS NULL) + count(*) FILTER (WHERE quality IS NULL)
              + count(*) FILTER (WHERE toxic IS NULL) AS BIGINT) AS null_count,
         (SELECT count(*) FROM docs) - count(*) AS duplicate_count,
         CAST(0 AS BIGINT) AS invalid_records
  FROM kept_docs
  UNION ALL
  SELECT 'contests', count(*),
         CAST(count(*) FILTER (WHERE contest_id IS NULL) + count(*) FILTER (WHERE home_team IS NULL)
              + count(*) FILTER (WHERE away_team IS NULL) + count(*) FILTER (WHERE season IS NULL)
              + count(*) FILTER (WHERE contest_date IS NULL) + count(*) FILTER (WHERE home_score IS NULL)
              + count(*) FILTER (WHERE away_score IS NULL) AS BIGINT),
         (SELECT count(*) FROM contests) - count(*), CAST(0 AS BIGINT)
  FROM kept_contests
  UNION ALL
  SELECT 'raw_numbers', count(*),
         CAST(count(*) FILTER (WHERE key IS NULL) + count(*) FILTER (WHERE as_int IS NULL) AS BIGINT),
         (SELECT count(*) FROM parsed) - count(*),
         (SELECT count(*) FROM parsed WHERE text IS NOT NULL AND as_int IS NULL)
  FROM kept_numbers)
SELECT * FROM log ORDER BY table_name"""

ORACLE["key_violations"] = f"""WITH {CONTESTS}
SELECT contest_id, count(*) AS occurrences FROM contests GROUP BY contest_id
HAVING count(*) > 1 OR contest_id IS NULL"""

ORACLE["rank_coverage"] = f"""WITH {PREDICTION_INPUTS},
p AS (
  SELECT rh.rank AS home_rank, ra.rank AS away_rank FROM schedule s
  LEFT JOIN r26 rh ON s.home_team = rh.entity LEFT JOIN r26 ra ON s.away_team = ra.entity),
c AS (
  SELECT count(*) AS checked_rows,
         count(*) FILTER (WHERE home_rank IS NOT NULL AND away_rank IS NOT NULL) AS covered_rows
  FROM p)
SELECT 'both_ranks' AS check_name, checked_rows, covered_rows,
       covered_rows / checked_rows AS coverage, CAST(0.9 AS DOUBLE) AS bound,
       coalesce(covered_rows / checked_rows > CAST(0.9 AS DOUBLE), false) AS passed
FROM c"""

ORACLE["upsert_by_key"] = f"""WITH {CUSTOMER_CHANGES}
SELECT * FROM cur WHERE NOT EXISTS (SELECT 1 FROM chg WHERE chg.c_custkey = cur.c_custkey)
UNION ALL
SELECT * FROM chg"""

ORACLE["upsert_duplicate_keys"] = f"""WITH {CUSTOMER_CHANGES},
twice AS (
  SELECT * FROM chg
  UNION ALL
  SELECT c_custkey, c_name, c_acctbal - 7, c_mktsegment FROM chg WHERE c_custkey % 3 = 0),
one AS (
  SELECT * FROM twice QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY c_name ASC NULLS LAST,
         c_acctbal ASC NULLS LAST, c_mktsegment ASC NULLS LAST) = 1)
SELECT * FROM cur WHERE NOT EXISTS (SELECT 1 FROM one WHERE one.c_custkey = cur.c_custkey)
UNION ALL
SELECT * FROM one"""

ORACLE["upsert_buckets"] = ORACLE["upsert_by_key"]

ORACLE["landing_rejects"] = """WITH p AS (
  SELECT p_partkey AS key, p_size AS size, p_type AS type,
         p_size % 5 = 0 OR p_size % 11 = 0 OR p_size % 13 = 0 AS bad,
         concat_ws(',', p_partkey, CASE WHEN p_size % 5 = 0 THEN 'large' ELSE p_size::VARCHAR END,
                   CASE WHEN p_size % 13 <> 0 THEN p_type END, CASE WHEN p_size % 11 = 0 THEN 'extra' END) AS line
  FROM part)
SELECT CASE WHEN NOT bad THEN key END AS key, CASE WHEN NOT bad THEN size::INTEGER END AS size,
       CASE WHEN NOT bad THEN type END AS type, CASE WHEN bad THEN line END AS line,
       count(*) FILTER (WHERE NOT bad) OVER () AS row_count, count(*) FILTER (WHERE bad) OVER () AS rejected_count
FROM p"""

ORACLE["upsert_partial"] = f"""WITH {CUSTOMER_CHANGES}
SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey,
       CASE WHEN o.c_custkey IS NOT NULL THEN o.c_name ELSE n.c_name END AS c_name,
       CASE WHEN n.c_custkey IS NOT NULL THEN n.c_acctbal ELSE o.c_acctbal END AS c_acctbal,
       CASE WHEN n.c_custkey IS NOT NULL THEN n.c_mktsegment ELSE o.c_mktsegment END AS c_mktsegment
FROM cur o FULL OUTER JOIN chg n ON o.c_custkey = n.c_custkey"""

ORACLE["ingest_manifest"] = f"""WITH {REGISTRY}
SELECT * FROM registry ORDER BY row_count DESC NULLS FIRST, table_name"""

ORACLE["manifest_total"] = f"""WITH {REGISTRY}
SELECT CAST(coalesce(sum(row_count), 0) AS BIGINT) AS value FROM registry"""

ORACLE["manifest_nonempty"] = f"""WITH {REGISTRY}
SELECT * FROM registry
WHERE row_count > 0 AND table_name <> 'metadata'
  AND table_name IN ('lineitem', 'orders', 'customer', 'supplier', 'part', 'nation', 'region', 'metadata')"""

ORACLE["latest_snapshot"] = f"""WITH {TEXT_RATINGS}
SELECT * FROM ratings
QUALIFY row_number() OVER (PARTITION BY entity ORDER BY {_KNOWN} DESC NULLS LAST,
        rating ASC NULLS LAST, goals_for ASC NULLS LAST, matches_total ASC NULLS LAST,
        is_host ASC NULLS LAST, grp ASC NULLS LAST) = 1"""

ORACLE["latest_register"] = ORACLE["latest_snapshot"]

ORACLE["global_latest"] = f"""WITH {TEXT_RATINGS}
SELECT * FROM ratings WHERE {_KNOWN} = (SELECT max({_KNOWN}) FROM ratings)"""

ORACLE["top_ratings"] = f"""WITH {TEXT_RATINGS}
SELECT entity, rating FROM ratings WHERE {_KNOWN} = (SELECT max({_KNOWN}) FROM ratings)
ORDER BY rating DESC NULLS FIRST, entity ASC NULLS LAST LIMIT 15"""

ORACLE["top_ratings_by_date"] = ORACLE["top_ratings"]

ORACLE["rating_by_group"] = f"""WITH {TEXT_RATINGS}
SELECT grp, {_r('avg(rating)', 0)} AS avg_rating FROM ratings
WHERE {_KNOWN} = (SELECT max({_KNOWN}) FROM ratings)
GROUP BY grp ORDER BY avg_rating DESC NULLS FIRST, grp"""

ORACLE["predict_contests"] = f"WITH {PREDICTIONS}\nSELECT * FROM predictions"

ORACLE["predict_contests_narrow"] = f"""WITH {PREDICTIONS}
SELECT match_id, home_team, away_team, match_date, home_rank, away_rank, predicted_winner
FROM predictions ORDER BY match_date ASC NULLS LAST, match_id ASC NULLS LAST LIMIT 100"""

ORACLE["predict_contests_all_narrow"] = f"""WITH {PREDICTIONS}
SELECT match_id, home_team, away_team, match_date, home_rank, away_rank, predicted_winner FROM predictions"""

_CLAMPED = f"""k AS (
  SELECT *, rating_home - rating_away AS diff FROM j),
m AS (
  SELECT *,
         CAST(1.0 AS DOUBLE) / (CAST(1.0 AS DOUBLE)
           + pow(CAST(10.0 AS DOUBLE), -diff / CAST(400.0 AS DOUBLE))) AS base,
         CAST(0.25 AS DOUBLE) * exp(-pow(diff / CAST(300.0 AS DOUBLE), CAST(2.0 AS DOUBLE))) AS pdraw,
         (gh / mh) * (rating_home / rating_away) AS xh,
         (ga / ma) * (rating_away / rating_home) AS xa
  FROM k),
n AS (
  SELECT *, {_r('base * (1 - pdraw)', 4)} AS prob_home_win, {_r('(1 - base) * (1 - pdraw)', 4)} AS prob_away_win,
         {_r('pdraw', 4)} AS prob_draw
  FROM m)
SELECT match_id, home_team, away_team, match_date, home_rank, away_rank, rating_home, rating_away,
       prob_home_win, prob_away_win, prob_draw,
       {_r('xh', 2)} AS expected_goals_home, {_r('xa', 2)} AS expected_goals_away,
       printf('%.1f-%.1f', xh, xa) AS expected_score,
       CASE WHEN prob_home_win > prob_away_win AND prob_home_win > prob_draw THEN CAST(home_team AS VARCHAR)
            WHEN prob_away_win > prob_home_win AND prob_away_win > prob_draw THEN CAST(away_team AS VARCHAR)
            ELSE 'Draw' END AS predicted_winner
FROM n"""

ORACLE["predict_pair_clamped"] = f"""WITH {SCHEDULE},
{RATINGS},
{RANKINGS},
latest_raw AS (
  SELECT * FROM ratings
  QUALIFY row_number() OVER (PARTITION BY entity ORDER BY snapshot_date DESC NULLS LAST,
          rating NULLS LAST, goals_for NULLS LAST, matches_total NULLS LAST) = 1),
r26 AS (SELECT entity, rank FROM rankings WHERE year = 2026),
j AS (
  SELECT s.match_id, s.home_team, s.away_team, s.match_date, rh.rank AS home_rank, ra.rank AS away_rank,
         coalesce(CAST(h.rating AS DOUBLE), CAST(1500 AS DOUBLE)) AS rating_home,
         coalesce(CAST(a.rating AS DOUBLE), CAST(1500 AS DOUBLE)) AS rating_away,
         greatest(CAST(1 AS DOUBLE), coalesce(CAST(h.goals_for AS DOUBLE), 1)) AS gh,
         greatest(CAST(1 AS DOUBLE), coalesce(CAST(h.matches_total AS DOUBLE), 1)) AS mh,
         greatest(CAST(1 AS DOUBLE), coalesce(CAST(a.goals_for AS DOUBLE), 1)) AS ga,
         greatest(CAST(1 AS DOUBLE), coalesce(CAST(a.matches_total AS DOUBLE), 1)) AS ma
  FROM schedule s
  LEFT JOIN latest_raw h ON s.home_team = h.entity
  LEFT JOIN latest_raw a ON s.away_team = a.entity
  LEFT JOIN r26 rh ON s.home_team = rh.entity
  LEFT JOIN r26 ra ON s.away_team = ra.entity),
{_CLAMPED}"""

NAMED = f"""{CLUB_ALIASES},
{SCHEDULE.replace("schedule AS (", "plain AS (", 1)},
{TEXT_RATINGS.replace(chr(10) + "ratings AS (", chr(10) + "by_number AS (")},
{RANKINGS},
schedule AS (
  SELECT match_id, {_spelled('home_team', 'home_team % 5 = 0')} AS home_team,
         {_spelled('away_team', 'away_team % 7 = 0', 'TEAM ')} AS away_team, match_date FROM plain),
named_ratings AS (
  SELECT * REPLACE ({_spelled('entity', f'entity % 10 = 0 AND coalesce(day({_KNOWN}) % 2 = 1, false)')} AS entity)
  FROM by_number),
listed AS (
  SELECT entity, rank FROM rankings WHERE year = 2026
  UNION ALL
  SELECT entity, rank + 3 FROM rankings WHERE year = 2026 AND entity % 4 = 1),
named_ranks AS (SELECT {_spelled('entity', 'entity % 15 = 0')} AS entity, rank FROM listed)"""


def _exact(col: str) -> str:
    return f"coalesce((SELECT canonical FROM exact WHERE alias = {col}), {col})"


def _any_case(col: str) -> str:
    return (f"coalesce((SELECT canonical FROM exact WHERE alias = {col}), "
            f"(SELECT canonical FROM folded WHERE spelling = lower({col})), {col})")


_LATEST_ORDER = f"""{_KNOWN} DESC NULLS LAST, rating NULLS LAST, goals_for NULLS LAST, matches_total NULLS LAST,
          is_host NULLS LAST"""

ORACLE["predict_contests_named"] = f"""WITH {NAMED},
latest AS (
  SELECT * FROM (SELECT * REPLACE ({_exact('entity')} AS entity) FROM named_ratings)
  QUALIFY row_number() OVER (PARTITION BY entity ORDER BY {_LATEST_ORDER}) = 1),
r26 AS (SELECT entity, min(rank) AS rank FROM (
          SELECT {_exact('entity')} AS entity, rank FROM named_ranks) GROUP BY entity),
keyed AS (SELECT *, {_exact('home_team')} AS home_key, {_exact('away_team')} AS away_key FROM schedule),
{_PREDICT}
SELECT * FROM predictions"""

ORACLE["predict_pair_named"] = f"""WITH {NAMED},
latest AS (
  SELECT * FROM (SELECT * REPLACE ({_any_case('entity')} AS entity) FROM named_ratings)
  QUALIFY row_number() OVER (PARTITION BY entity ORDER BY {_KNOWN} DESC NULLS LAST, rating NULLS LAST,
          goals_for NULLS LAST, matches_total NULLS LAST) = 1),
raw_rank AS (SELECT entity, min(rank) AS rank FROM named_ranks GROUP BY entity),
clean_rank AS (SELECT entity, min(rank) AS rank FROM (
          SELECT {_any_case('entity')} AS entity, rank FROM named_ranks) GROUP BY entity),
keyed AS (SELECT *, {_any_case('home_team')} AS home_key, {_any_case('away_team')} AS away_key FROM schedule),
j AS (
  SELECT s.match_id, s.home_team, s.away_team, s.match_date,
         CASE WHEN rh.entity IS NOT NULL THEN rh.rank ELSE ch.rank END AS home_rank,
         CASE WHEN ra.entity IS NOT NULL THEN ra.rank ELSE ca.rank END AS away_rank,
         coalesce(CAST(h.rating AS DOUBLE), CAST(1500 AS DOUBLE)) AS rating_home,
         coalesce(CAST(a.rating AS DOUBLE), CAST(1500 AS DOUBLE)) AS rating_away,
         greatest(CAST(1 AS DOUBLE), coalesce(CAST(h.goals_for AS DOUBLE), 1)) AS gh,
         greatest(CAST(1 AS DOUBLE), coalesce(CAST(h.matches_total AS DOUBLE), 1)) AS mh,
         greatest(CAST(1 AS DOUBLE), coalesce(CAST(a.goals_for AS DOUBLE), 1)) AS ga,
         greatest(CAST(1 AS DOUBLE), coalesce(CAST(a.matches_total AS DOUBLE), 1)) AS ma
  FROM keyed s
  LEFT JOIN latest h ON s.home_key = h.entity LEFT JOIN latest a ON s.away_key = a.entity
  LEFT JOIN raw_rank rh ON s.home_team = rh.entity LEFT JOIN raw_rank ra ON s.away_team = ra.entity
  LEFT JOIN clean_rank ch ON s.home_key = ch.entity LEFT JOIN clean_rank ca ON s.away_key = ca.entity),
{_CLAMPED}"""

ORACLE["pairwise_predictions"] = f"""WITH {SCHEDULE},
{RATINGS},
latest AS (
  SELECT entity, rating, goals_for, matches_total FROM ratings
  WHERE snapshot_date = (SELECT max(snapshot_date) FROM ratings)),
pairs AS (SELECT DISTINCT home_team AS team_a, away_team AS team_b FROM schedule WHERE home_team <> away_team),
scored AS (
  SELECT p.team_a, p.team_b, a.rating AS rating_a, b.rating AS rating_b,
         CAST(1.0 AS DOUBLE) / (CAST(1.0 AS DOUBLE) + pow(CAST(10.0 AS DOUBLE),
             (b.rating - a.rating) / CAST(400.0 AS DOUBLE))) AS pa,
         CAST(1.0 AS DOUBLE) / (CAST(1.0 AS DOUBLE) + pow(CAST(10.0 AS DOUBLE),
             (a.rating - b.rating) / CAST(400.0 AS DOUBLE))) AS pb,
         (a.goals_for / NULLIF(a.matches_total, 0)) * (a.rating / b.rating) AS xa,
         (b.goals_for / NULLIF(b.matches_total, 0)) * (b.rating / a.rating) AS xb
  FROM pairs p JOIN latest a ON p.team_a = a.entity JOIN latest b ON p.team_b = b.entity)
SELECT team_a, team_b, rating_a, rating_b, {_r('pa', 6)} AS prob_a_win, {_r('pb', 6)} AS prob_b_win,
       {_r('xa', 6)} AS expected_goals_a, {_r('xb', 6)} AS expected_goals_b
FROM scored"""

ORACLE["prediction_report"] = f"""WITH {PREDICTIONS}
SELECT home_team, rating_home, away_team, rating_away,
       {_pct('prob_home_win')} AS prob_home_win,
       {_pct('prob_away_win')} AS prob_away_win,
       {_pct('prob_draw')} AS prob_draw,
       CAST(expected_goals_home AS VARCHAR) || ' - ' || CAST(expected_goals_away AS VARCHAR) AS expected_score,
       predicted_winner
FROM predictions"""

ORACLE["prediction_summary"] = f"""WITH {PREDICTIONS}
SELECT count(*) AS matches_simulated,
       {_pct('avg(prob_draw)')} AS avg_draw_probability,
       CAST(round({_dec('avg(expected_goals_home + expected_goals_away)')}, 2)
            AS DECIMAL(18,2)) AS avg_expected_goals
FROM predictions"""
