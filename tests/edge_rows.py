"""Hand-made raw incidents with known classifications (cutoff 2023)."""

from blotter.profile import REFERENCE_PROFILE

SF = "Strong-Arm (Hands, Fist, Feet or Bodily Force)"
# id, DATE OCC, TIME OCC, AREA NAME, Vict Age, Vict Sex, Premis Desc, Weapon Desc
RAW = [
    ("E1", "01/08/2020 12:00:00 AM", "130", "A", "30", "F", "STREET", None),
    ("E2", "12/31/2018 12:00:00 AM", "2230", "A", "0", "X", "STREET", "  "),
    ("E3", "13/45/2020 12:00:00 AM", "1200", "A", "30", "M", "STREET", "HAND GUN"),
    ("E4", None, "1200", "A", "30", "M", "STREET", "HAND GUN"),
    ("E5", "1/8/2020 12:00:00 AM", "1200", "A", "30", "M", "STREET", "HAND GUN"),
    ("E6", "06/01/2021 12:00:00 AM", "2400", "B", "17", "M", "STREET", " verbal threat "),
    ("E7", "06/01/2021 12:00:00 AM", None, "B", "18", "F", "STREET", " knife"),
    ("E8", "06/01/2021 12:00:00 AM", "559", "B", "65", None, "STREET", SF),
    ("E9", "06/01/2021 12:00:00 AM", "600", "B", "abc", "X", "STREET", "HAND GUN"),
    ("E10", "06/01/2021 12:00:00 AM", "1159", "B", "abc", "F", "STREET", "HAND GUN"),
    ("E11", "06/01/2021 12:00:00 AM", "1800", "B", "44", "X", None, "HAND GUN"),
    ("E12", "06/01/2021 12:00:00 AM", "2359", None, "-1", "M", "STREET", "HAND GUN"),
    ("E13", "01/01/2024 12:00:00 AM", "1200", "B", "45", "M", "STREET", "HAND GUN"),
    ("E14", "06/01/2021 12:00:00 AM", "1200", "B", "64", "H", "STREET", ""),
]
COLUMNS = ["id", "DATE OCC", "TIME OCC", "AREA NAME", "Vict Age", "Vict Sex", "Premis Desc",
           "Weapon Desc"]

# id -> (slot, age range, sex_norm, victim type, weapon class) for the kept rows.
EXPECTED = {
    "E1": ("Nuit (0-5)", "30-44", "F", "Humain", "Aucune arme"),
    "E2": ("Soiree (18-23)", "Inconnu", "Autre", "NonHumain", "Aucune arme"),
    "E6": ("Inconnu", "0-17", "M", "Humain", "Aucune arme"),
    "E7": ("Inconnu", "18-29", "F", "Humain", "Arme utilisée"),
    "E8": ("Nuit (0-5)", "65+", "Inconnu", "Humain", "Aucune arme"),
    "E9": ("Matin (6-11)", "Inconnu", "Autre", "NonHumain", "Arme utilisée"),
    "E10": ("Matin (6-11)", "Inconnu", "F", "Humain", "Arme utilisée"),
    "E11": ("Soiree (18-23)", "30-44", "Autre", "Humain", "Arme utilisée"),
    "E12": ("Soiree (18-23)", "Inconnu", "M", "Humain", "Arme utilisée"),
    "E14": ("Apres-midi (12-17)", "45-64", "Autre", "Humain", "Aucune arme"),
}
# Kept human rows with a complete context (area and premises known).
CONTEXT_IDS = {"E1", "E6", "E7", "E8", "E10", "E14"}

PROFILE = REFERENCE_PROFILE.with_(severity=None, lat=None, lon=None)


def raw_frame(spark):
    return spark.createDataFrame(RAW, ",".join(f"`{c}` string" for c in COLUMNS))
