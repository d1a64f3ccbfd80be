"""Column layouts, raw-record mappings and label values of the sports preset."""

from __future__ import annotations

from pyspark.sql.types import LongType, StringType, StructField, StructType

# ---------------------------------------------------------------------------
# Raw JSON key -> column. Order is the column order of the table.
# ---------------------------------------------------------------------------
TEAM_FIELDS = {
    "idTeam": "team_id",
    "strTeam": "name",
    "strAlternate": "alt_name",
    "strCountry": "country",
    "strCity": "city",
    "strLeague": "league",
    "idLeague": "league_id",
    "strStadium": "venue",
    "intStadiumCapacity": "venue_capacity",
    "strStadiumLocation": "venue_location",
    "intFormedYear": "founded_year",
    "strDescriptionES": "description",
    "strWebsite": "website",
}
MATCH_FIELDS = {
    "idEvent": "event_id",
    "strEvent": "event_name",
    "strSeason": "season",
    "strLeague": "league",
    "idLeague": "league_id",
    "strHomeTeam": "home_team",
    "idHomeTeam": "home_id",
    "intHomeScore": "home_score",
    "strAwayTeam": "away_team",
    "idAwayTeam": "away_id",
    "intAwayScore": "away_score",
    "dateEvent": "event_date",
    "strTime": "event_time",
    "strVenue": "venue",
    "strStatus": "status",
}
# Columns stamped by the load itself, after the mapped ones.
TEAM_STAMPS = ("extracted_at",)
MATCH_STAMPS = ("extracted_at", "extract_date")
# Columns that arrive as text and are stored as whole numbers.
TEAM_NUMBERS = ("venue_capacity", "founded_year")
MATCH_NUMBERS = ("home_score", "away_score")

# ---------------------------------------------------------------------------
# Statuses of a played match, labels and fills.
# ---------------------------------------------------------------------------
FINISHED_STATUSES = ("FT", "AET", "PEN", "MATCH FINISHED", "FINISHED")
HOME_WIN, AWAY_WIN, DRAW = "Local", "Visitante", "Empate"
UNKNOWN_VENUE = "Estadio desconocido"
UNKNOWN_SEASON = "Sin temporada"
NOT_REPORTED = "No informado"
NO_WEBSITE = "Sin sitio web"
BLOWOUT_MARGIN = 2

# Default stream topics.
TEAM_TOPIC, MATCH_TOPIC = "equipos", "partidos"

# The leagues loaded by default (name, id, season), in load order.
LEAGUES = (
    ("Argentinian Primera Division", "4406", "2024"),
    ("Brazilian Serie A", "4351", "2024"),
    ("American Major League Soccer", "4346", "2024"),
    ("English Premier League", "4328", "2024-2025"),
    ("Spanish La Liga", "4335", "2024-2025"),
    ("Italian Serie A", "4332", "2024-2025"),
    ("German Bundesliga", "4331", "2024-2025"),
    ("French Ligue 1", "4334", "2024-2025"),
    ("Portuguese Primeira Liga", "4344", "2024-2025"),
)


def text_struct(names) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def _stored(names, numbers) -> StructType:
    return StructType(
        [StructField(n, LongType() if n in numbers else StringType()) for n in names]
    )


RAW_TEAM = text_struct(TEAM_FIELDS)
RAW_MATCH = text_struct(MATCH_FIELDS)
TEAM_COLUMNS = (*TEAM_FIELDS.values(), *TEAM_STAMPS)
MATCH_COLUMNS = (*MATCH_FIELDS.values(), *MATCH_STAMPS)
BRONZE_TEAMS = _stored(TEAM_COLUMNS, TEAM_NUMBERS)
BRONZE_MATCHES = _stored(MATCH_COLUMNS, MATCH_NUMBERS)

# Constraints of the bronze tables: name -> condition every row must meet.
TEAM_CHECKS = {"team_id_not_null": "team_id IS NOT NULL", "name_not_null": "name IS NOT NULL"}
MATCH_CHECKS = {"event_id_not_null": "event_id IS NOT NULL"}

SILVER_RENAMES = {"event_name": "match_label", "status": "match_status", "venue": "match_venue"}

STANDINGS_STATS = ("played", "won", "drawn", "lost", "goals_for", "goals_against",
                   "goal_difference", "points")
STANDINGS_COLUMNS = ("league", "team_id", "team", *STANDINGS_STATS)

# ---------------------------------------------------------------------------
# Column -> name under which the tables and messages are known to
# existing readers (dashboards, topics). See ``with_published_names``.
# ---------------------------------------------------------------------------
PUBLISHED_TEAMS = {
    "team_id": "id_equipo",
    "name": "nombre",
    "alt_name": "nombre_alternativo",
    "country": "pais",
    "city": "ciudad",
    "league": "liga",
    "league_id": "id_liga",
    "venue": "estadio",
    "venue_capacity": "capacidad_estadio",
    "venue_location": "ubicacion_estadio",
    "founded_year": "anio_fundacion",
    "description": "descripcion_es",
    "website": "sitio_web",
    "extracted_at": "timestamp_extraccion",
}
PUBLISHED_MATCHES = {
    "event_id": "id_evento",
    "event_name": "nombre_evento",
    "season": "temporada",
    "league": "liga",
    "league_id": "id_liga",
    "home_team": "equipo_local",
    "home_id": "id_equipo_local",
    "home_score": "goles_local",
    "away_team": "equipo_visitante",
    "away_id": "id_equipo_visitante",
    "away_score": "goles_visitante",
    "event_date": "fecha_partido",
    "event_time": "hora_partido",
    "venue": "estadio",
    "status": "estado",
    "extracted_at": "timestamp_extraccion",
    "extract_date": "fecha_extraccion",
}
PUBLISHED_SILVER = {
    **{c: p for c, p in PUBLISHED_MATCHES.items() if c not in SILVER_RENAMES},
    "match_label": "descripcion_partido",
    "match_status": "estado_partido",
    "match_venue": "estadio_sede",
    "match_year": "anio_partido",
    "match_month": "mes_partido",
    "weekday": "dia_semana",
    "outcome": "resultado",
    "score_difference": "diferencia_goles",
    "is_blowout": "es_goleada",
    "home_city": "ciudad_local",
    "home_venue_capacity": "capacidad_estadio_local",
}
PUBLISHED_STANDINGS = {
    "league": "liga",
    "team_id": "id_equipo",
    "team": "equipo",
    "played": "PJ",
    "won": "PG",
    "drawn": "PE",
    "lost": "PP",
    "goals_for": "GF",
    "goals_against": "GC",
    "goal_difference": "DG",
    "points": "Pts",
}


def with_published_names(df, names):
    """Columns under their published names; unknown columns keep theirs."""
    return df.withColumnsRenamed(names)


def with_canonical_names(df, names):
    """The inverse of :func:`with_published_names`."""
    return df.withColumnsRenamed({published: column for column, published in names.items()})
