"""Column bindings, labels and thresholds for incident-like tables.

Every operator in the library is generic: it takes column names as arguments.
An :class:`IncidentProfile` binds those names once for a given source table, so
the same jobs run on the reference's incident export, on the test adapter view,
or on any table with an entity column and a date column.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql.types import DataType, DoubleType, IntegerType

# ---------------------------------------------------------------------------
# Fixed values. These labels, codes and thresholds must equal the reference's
# output exactly (they end up as values in the published result tables).
# ---------------------------------------------------------------------------

#: Pattern of the raw incident date text.
RAW_DATE_FORMAT = "MM/dd/yyyy hh:mm:ss a"
#: Last year the clean job of the incident export keeps.
REFERENCE_MAX_YEAR = 2023

#: Label used for every "cannot classify" case.
UNKNOWN = "Inconnu"

#: Time slots by hour of day: [0,6) [6,12) [12,18) [18,24).
TIME_SLOT_EDGES = (0, 6, 12, 18, 24)
TIME_SLOT_LABELS = ("Nuit (0-5)", "Matin (6-11)", "Apres-midi (12-17)", "Soiree (18-23)")

#: Victim age ranges for ages > 0: (0,18) [18,30) [30,45) [45,65) [65,inf);
#: NULL or <= 0 is unknown.
AGE_RANGE_EDGES = (None, 18, 30, 45, 65, None)
AGE_RANGE_LABELS = ("0-17", "18-29", "30-44", "45-64", "65+")

#: Victim sex codes kept as they are; any other non-NULL code becomes SEX_OTHER.
SEX_CODES = ("M", "F")
SEX_OTHER = "Autre"

#: Victim type.
VICTIM_HUMAN = "Humain"
VICTIM_NON_HUMAN = "NonHumain"

#: Weapon classes. Descriptions (after trim + upper) that count as "no weapon".
NO_WEAPON = "Aucune arme"
WEAPON_USED = "Arme utilisée"
NO_WEAPON_DESCRIPTIONS = (
    "STRONG-ARM (HANDS, FIST, FEET OR BODILY FORCE)",
    "VERBAL THREAT",
)

#: Risk levels by z-score: z >= 3, z >= 2, otherwise.
RISK_VERY_HIGH = "Tres eleve"
RISK_HIGH = "Eleve"
RISK_NORMAL = "Normal"
RISK_LEVEL_EDGES = (2.0, 3.0, None)
RISK_LEVEL_LABELS = (RISK_HIGH, RISK_VERY_HIGH)

#: High-risk filter: minimum incidents per context and minimum z-score.
MIN_CONTEXT_COUNT = 50
MIN_Z_SCORE = 2.0

#: Danger score: clamp(z / 5 * 10, 0, 10).
SCORE_Z_DIVISOR = 5.0
SCORE_SCALE = 10.0

#: Month names shown by the dashboard, January first.
MONTH_NAMES = (
    "Janvier", "Février", "Mars", "Avril", "Mai", "Juin",
    "Juillet", "Août", "Septembre", "Octobre", "Novembre", "Décembre",
)

#: Default number of zones preselected on the averages page and the evolution page.
DEFAULT_ZONES_AVERAGES = 5
DEFAULT_ZONES_EVOLUTION = 3
#: Top lists on the dashboard.
TOP_AREAS = 5
TOP_CONTEXTS = 20
#: Characters of the premises text kept in a context label.
LABEL_PLACE_CHARS = 25


@dataclass(frozen=True)
class IncidentProfile:
    """Where each role lives in a source table, and the output names to use.

    Optional roles (``None``) switch off the results that need them, as the
    reference does for a missing severity or weapon column.
    """

    entity: str = "AREA NAME"
    date_raw: str = "DATE OCC"
    date_format: str = RAW_DATE_FORMAT
    time_hhmm: str | None = "TIME OCC"
    severity: str | None = "Part 1-2"
    victim_age: str | None = "Vict Age"
    victim_sex: str | None = "Vict Sex"
    premises: str | None = "Premis Desc"
    weapon: str | None = "Weapon Desc"
    lat: str | None = "LAT"
    lon: str | None = "LON"
    max_year: int | None = None
    #: Types of raw columns that arrive as text (matched by normalised name).
    raw_types: Mapping[str, DataType] | None = None
    # Curated output names.
    ts_out: str = "date_occ_ts"
    date_out: str = "date_occ"
    year_out: str = "year"
    # Result column names.
    severity_out: str = "part_1_2"
    year_key: str = "year_int"
    count_out: str = "n_crimes"
    # Text clean-up that reproduces a CSV round trip (trim, empty -> NULL).
    normalize_text: bool = True
    # Risk thresholds.
    min_context_count: int = MIN_CONTEXT_COUNT
    min_z_score: float = MIN_Z_SCORE

    def with_(self, **changes) -> "IncidentProfile":
        return replace(self, **changes)

    @property
    def severity_col(self) -> str | None:
        """Name of the severity column once the curated table is read."""
        return None if self.severity is None else self.severity_out


#: Types of the incident export's numeric columns. Everything else stays text;
#: ``Vict Age`` is converted where it is used, so a bad value only becomes NULL.
REFERENCE_RAW_TYPES: dict[str, DataType] = {
    "TIME OCC": IntegerType(),
    "Part 1-2": IntegerType(),
    "LAT": DoubleType(),
    "LON": DoubleType(),
}

#: Binding for the incident export: its column names, types and last year.
REFERENCE_PROFILE = IncidentProfile(max_year=REFERENCE_MAX_YEAR, raw_types=REFERENCE_RAW_TYPES)

#: Binding for the adapter view built from the driver's ``lineitem`` table
#: (see ``blotter.sources.fixture``); cutoff 2000 so that it removes rows.
ADAPTER_PROFILE = IncidentProfile(
    entity="area_name",
    date_raw="date_occ_raw",
    time_hhmm="time_occ",
    severity="part_1_2",
    victim_age="vict_age",
    victim_sex="vict_sex",
    premises="premis_desc",
    weapon="weapon_desc",
    lat="lat",
    lon="lon",
    max_year=2000,
)
