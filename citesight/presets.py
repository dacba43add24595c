"""Constants and parameter sets (data only, no logic).

Two presets share one shape:

* ``HEALTH`` -- the values a penalty-record analysis needs for results equal to
  the original workflow.  They are fixed values and are stated below as text,
  in their natural order.
* ``STANDIN`` -- the same shape, aimed at the TPC-H-like test tables
  (``lineitem`` x ``orders`` x ``customer`` x ``nation`` x ``part``) so that every
  operator has rows to work on.  See ``citesight.sources.standin``.

Every operator takes its lists and maps as parameters; a preset is only a
convenient bundle of them.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the original workflow's for equal results)
# ---------------------------------------------------------------------------

# Repeated header rows found in the lookup table's VARIABLE column.
LOOKUP_HEADER_VALUES = ["VARIABLE", "VARIABLE  "]

# Two recodes of PENALTY_DETAIL (after whitespace collapse).
PENALTY_DETAIL_RECODE = {
    "AP - 3.2 Nursing-Hours-per-Patient-Day AP (HSC 1276.5)": "3.2 Nursing-Hours-per-Patient-Day AP (HSC 1276.5)",
    "Citation Willful Material Omission (HSC 1424(f)(1))": "Citation Willful Material Omission (HSC 1424 (f)(1))",
}

# Recodes of CLASS_ASSESSED_FINAL (unmapped values are kept).
CLASS_FINAL_RECODE = {
    "B Trebled": "B TREBLED",
    "A Trebled": "A TREBLED",
    "B First": "B FIRST",
    "Dismissed by Court": "Dismissed by court",
    "CHOW- SETTLEMENT": "CHOW SETTLEMENT",
    "APPEAL WITHDRAWN BY": "APPEAL WITHDRAWN BY FACILITY",
    "R/D=<$1000": "R/D = <$1000",
    "FTR RES": "FRTR RES",
    "DEPT WITHDREW CITATI": "Dismissed by court",
    "DISMISSED": "Dismissed by court",
    "WMF First": "WF",
    "WMF FIRST": "WF",
}

# DEATH_RELATED text -> 0/1 (anything else -> NULL; missing is filled with 'N' first).
DEATH_MAP = {"Y": 1, "N": 0}
DEATH_FILL = "N"

# Complaint priorities: accepted tokens in priority order, and their numbers.
# 'E' is accepted as a highest priority but has no number (-> NULL).
PRIORITY_TOKENS = ["A", "B", "C", "D", "E"]
PRIORITY_NUMBER = {"A": 1, "B": 2, "C": 3, "D": 4}

# Outcomes that void a penalty (compared lower-case; NULL is kept).
INVALID_OUTCOMES = [
    "drop>deficiency",
    "dismissed by court",
    "reversed",
    "appeal withdrawn by facility",
    "chow settlement",
]

# Keyword flags on the lower-cased PENALTY_CATEGORY; each flag is 1 when the
# text contains any of the listed literals (plain substring, no word edges).
HEALTH_FLAGS = {
    "is_ae": ["ae:"],
    "is_breach": ["breach"],
    "is_deliberate_breach": ["deliberate breach"],
    "is_ij": ["immediate jeopardy"],
    "is_non_ij": ["non-immediate jeopardy"],
    "is_ae_death": ["death"],
    "is_ae_assault": ["assault", "sexual assault", "physical assault"],
    "is_ae_surgery": ["surg", "wrong body part", "foreign object"],
    "is_ae_medication": ["medication error"],
    "is_ae_fall": ["fall"],
    "is_ae_suicide": ["suicide"],
    "is_ae_ulcer": ["ulcer"],
    "is_abuse": ["abuse"],
    "is_falsification": ["falsif"],
    "is_neglect": ["neglect"],
    "is_staffing": ["staffing", "nhppd"],
}

# Lookup-table flags, set only on rows with VARIABLE = 'FAC_TYPE_CODE'.
LOOKUP_FLAG_ROW = ("VARIABLE", "FAC_TYPE_CODE")
LOOKUP_CLASS_ROW = ("VARIABLE", "Class_Assessed_Final")
LOOKUP_FLAGS = {
    # (case-sensitive?, literals)
    "IS_24HR": (True, ["24-hour"]),
    "IS_HOSPITAL": (False, ["governing body", "duly constituted"]),
    "IS_LOW_RESOURCE": (False, ["nonprofit", "non-profit", "tax-exempt", "community", "federally qualified"]),
}

# Facility profiles: flags summed and CLASS_FINAL values counted, per stratum.
HEALTH_HOSP_FLAGS = ["ae", "ae_death", "ae_assault", "ae_surgery", "ae_medication", "ae_fall",
                     "ae_suicide", "breach", "deliberate_breach", "ij", "non_ij"]
HEALTH_HOSP_CLASSES = [
    ("ap_ij", ["AP IJ"]),
    ("ap_non_ij", ["AP NON-IJ"]),
    ("ftr_ae", ["FTR AE"]),
    ("ftr_br", ["FTR BR"]),
    ("ap_br", ["AP BR"]),
]
HEALTH_LTC_FLAGS = ["abuse", "falsification", "neglect", "staffing", "ae_death", "ae_ulcer"]
HEALTH_LTC_CLASSES = [
    ("class_aa", ["AA"]),
    ("class_a", ["A"]),
    ("class_b", ["B"]),
    ("ap_nhppd", ["AP NHPPD"]),
    ("wmf", ["WMF>$1000", "WMF<$1000"]),
    ("wmo", ["WMO>$1000", "WMO=<$1000"]),
    ("trebled", ["A TREBLED", "B TREBLED"]),
    ("ftr_br", ["FTR BR"]),
    ("ap_br", ["AP BR"]),
]

# Anomaly-model features per stratum (in this order).
HOSPITAL_FEATURES = [
    "total_penalties",
    "ap_ij_rate_eb",
    "ap_non_ij_rate_eb",
    "ftr_ae_rate_eb",
    "ftr_br_rate_eb",
    "ap_br_rate_eb",
    "ae_surgery_rate_eb",
    "ae_assault_rate_eb",
    "ae_medication_rate_eb",
    "deliberate_breach_rate_eb",
    "deaths_rate_eb",
    "balance_per_penalty",
]
LTC_FEATURES = [
    "total_penalties",
    "class_aa_rate_eb",
    "class_a_rate_eb",
    "abuse_rate_eb",
    "falsification_rate_eb",
    "neglect_rate_eb",
    "wmf_rate_eb",
    "wmo_rate_eb",
    "trebled_rate_eb",
    "ae_ulcer_rate_eb",
    "ap_nhppd_rate_eb",
    "ftr_br_rate_eb",
    "deaths_rate_eb",
    "complaint_rate_log",
    "balance_per_penalty",
]

# Model and selection settings.
N_TREES = 300
RANDOM_STATE = 42
HOSP_CONTAMINATION = 0.15
LTC_CONTAMINATION = 0.05
INSPECTION_SLOTS = 25
EB_K = 5
STRATUM_HOSPITAL = "Hospital"
STRATUM_LTC = "LTC & NTC"

# Text keywords.
TFIDF_VOCAB_SIZE = 100
TFIDF_TOKEN_PATTERN = "[a-zA-Z]{3,}"
TOP_KEYWORDS = 3
CUSTOM_STOP_WORDS = [
    "resident", "facility", "patient", "stated", "according",
    "don", "staff", "nursing", "hospital", "following",
    "included", "indicated", "required", "titled", "dated",
    "review", "record", "noted", "note", "shall", "use",
    "used", "did", "day", "days", "time", "right", "left",
]

# Report constants.
SERIOUS_CLASSES = ["AA", "AP IJ", "A"]
TRANSITION_START_CLASSES = ["AA", "A", "B", "AP IJ", "AP NON-IJ", "AP NHPPD", "FTR AE", "FTR BR"]
TRANSITION_MIN_COUNT = 3
REVERSED_OUTCOMES = ["Dismissed by court", "REVERSED", "APPEAL WITHDRAWN BY FACILITY"]
DROPPED_OUTCOME = "Drop>Deficiency"
SEVERE_NODE_MARKERS = ["AA", "AP IJ"]
REPORT_PENALTY_TYPES = ["Administrative Penalty", "Citation", "Failure to Report Penalty"]
HEATMAP_TOP_ROWS = 20
HISTOGRAM_BINS = 50

# District office coordinates (lat, lon).
DISTRICT_COORDS = {
    "Santa Rosa": (38.4404, -122.7141),
    "East Bay": (37.8044, -122.2712),
    "Sacramento": (38.5816, -121.4944),
    "Stockton": (37.9577, -121.2908),
    "Fresno": (36.7378, -119.7871),
    "Bakersfield": (35.3733, -119.0187),
    "Ventura": (34.2805, -119.2945),
    "Orange": (33.7879, -117.8531),
    "San Jose": (37.3382, -121.8863),
    "San Francisco": (37.7749, -122.4194),
    "San Diego": (32.7157, -117.1611),
    "San Bernardino": (34.1083, -117.2898),
    "LA ICF/DD/Clinics": (34.0195, -118.5500),
    "State Facilities Section": (38.5816, -121.4944),
    "Chico": (39.7285, -121.8375),
    "Riverside": (33.9806, -117.3755),
    "LA Region 3": (33.8500, -118.3500),
    "LA Region 2": (34.0700, -118.5500),
    "LA Region 1": (34.1000, -118.1500),
    "LA HHA/Hospice": (34.0000, -118.2000),
    "LA Acute/Ancillary": (33.9500, -118.3000),
}

# ---------------------------------------------------------------------------
# Presets
# ---------------------------------------------------------------------------


def _profile(flags, classes):
    return {"flags": list(flags), "classes": [(n, list(v)) for n, v in classes]}


HEALTH = {
    "invalid_outcomes": INVALID_OUTCOMES,
    "flags": HEALTH_FLAGS,
    "hosp_profile": _profile(HEALTH_HOSP_FLAGS, HEALTH_HOSP_CLASSES),
    "ltc_profile": _profile(HEALTH_LTC_FLAGS, HEALTH_LTC_CLASSES),
    "hosp_features": HOSPITAL_FEATURES,
    "ltc_features": LTC_FEATURES,
    "class_final_recode": CLASS_FINAL_RECODE,
    "detail_recode": PENALTY_DETAIL_RECODE,
    "serious_classes": SERIOUS_CLASSES,
    "transition_start": TRANSITION_START_CLASSES,
    "reversed_outcomes": REVERSED_OUTCOMES,
    "dropped_outcome": DROPPED_OUTCOME,
    "severe_markers": SEVERE_NODE_MARKERS,
    "report_types": REPORT_PENALTY_TYPES,
}

# Stand-in values for the TPC-H-like tables.  PENALTY_CATEGORY is ``p_name``
# (two words out of 16), CLASS_FINAL comes from ``l_returnflag`` /
# ``o_orderstatus``, PENALTY_TYPE is ``o_orderpriority``.
STANDIN_FLAGS = {
    "is_ae": ["hot"],
    "is_breach": ["old"],             # also inside "cold", like the overlap rule
    "is_deliberate_breach": ["cold"],
    "is_ij": ["gear"],
    "is_non_ij": ["large"],
    "is_ae_death": ["red"],
    "is_ae_assault": ["blue", "bolt"],
    "is_ae_surgery": ["rod", "ring", "plate"],
    "is_ae_medication": ["small"],
    "is_ae_fall": ["gizmo"],
    "is_ae_suicide": ["anvil"],
    "is_ae_ulcer": ["widget"],
    "is_abuse": ["new"],
    "is_falsification": ["large"],
    "is_neglect": ["old"],
    "is_staffing": ["gear", "plate"],
}
STANDIN_HOSP_CLASSES = [
    ("ap_ij", ["A"]),
    ("ap_non_ij", ["N"]),
    ("ftr_ae", ["F"]),
    ("ftr_br", ["OPEN"]),
    ("ap_br", ["A", "N"]),
]
STANDIN_LTC_CLASSES = [
    ("class_aa", ["A"]),
    ("class_a", ["N"]),
    ("class_b", ["F"]),
    ("ap_nhppd", ["OPEN"]),
    ("wmf", ["A", "F"]),
    ("wmo", ["N", "OPEN"]),
    ("trebled", ["F", "OPEN"]),
    ("ftr_br", ["OPEN"]),
    ("ap_br", ["A"]),
]
STANDIN_CLASS_FINAL_RECODE = {"O": "OPEN", "P": "PARTIAL"}
# Lookup definitions per market segment; FURNITURE has no lookup row on purpose.
STANDIN_SEGMENT_DEFINITIONS = {
    "AUTOMOBILE": "A 24-hour facility operated by a nonprofit corporation.",
    "BUILDING": "A health facility with a duly constituted governing body giving 24-hour inpatient care.",
    "HOUSEHOLD": "A community clinic that is tax-exempt.",
    "MACHINERY": "A clinic open 24-Hour a day; federally qualified.",
}
# Class lookup rows (DESCRIPTION values); 'R' has none, so it stays unmatched.
STANDIN_CLASS_DESCRIPTIONS = ["A", "N", "F", "OPEN", "PARTIAL"]

STANDIN = {
    "invalid_outcomes": ["partial"],
    "flags": STANDIN_FLAGS,
    "hosp_profile": _profile(HEALTH_HOSP_FLAGS, STANDIN_HOSP_CLASSES),
    "ltc_profile": _profile(HEALTH_LTC_FLAGS, STANDIN_LTC_CLASSES),
    "hosp_features": HOSPITAL_FEATURES,
    "ltc_features": LTC_FEATURES,
    "class_final_recode": STANDIN_CLASS_FINAL_RECODE,
    "detail_recode": {"PROMO": "PROMOTION"},
    "serious_classes": ["A", "N"],
    "transition_start": ["A", "N", "R"],
    "reversed_outcomes": ["PARTIAL"],
    "dropped_outcome": "OPEN",
    "severe_markers": ["A"],
    "report_types": ["1-URGENT", "2-HIGH", "5-LOW"],
}
