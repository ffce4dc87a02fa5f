"""Values that decide results and therefore have to be exactly these.

Fixed values: null tokens, keyword lists, source-column names, weights, cut
points, labels, encodings and grids. They are data, kept together here; the
logic that uses them lives in the operator modules.
"""

# --- fixed values: texts that mean "no value", compared in lower case -------
READMISSION_NULLS = ("not available", "too few to report", "n/a", "not applicable", "", "nan")
EXPERIENCE_NULLS = ("not available", "not applicable", "n/a", "", "nan")
TIMELY_NULLS = ("not available", "not applicable", "n/a", "too few to report", "", "nan")
COMMUNITY_NULLS = ("not available", "not applicable", "n/a", "", "nan")
RATING_NULLS = ("not available", "n/a", "nan", "")
TREND_RATING_NULLS = ("not available", "n/a", "")
COERCE_NULLS = (
    "not available", "too few to report", "n/a", "na", "not applicable", "", "nan", "none", "null",
)

# --- fixed values: characters kept when a dirty text is read as a number ----
NOT_NUMERIC_CHARS = r"[^0-9.\-]"
NOT_DIGITS = r"[^0-9]"

# --- fixed values: measure keywords -> output column ------------------------
READMISSION_MEASURES = {
    "readm_heart_failure": ("hf", "heart failure"),
    "readm_pneumonia": ("pn", "pneumonia"),
    "readm_hip_knee": ("hip", "knee", "thrs"),
    "readm_copd": ("copd",),
    "readm_stroke": ("stroke",),
    "readm_heart_attack": ("ami", "heart attack"),
}
READMISSION_COMPARISONS = {
    "hf_compared_to_national": ("hf", "heart failure"),
    "pn_compared_to_national": ("pn", "pneumonia"),
    "copd_compared_to_national": ("copd",),
    "ami_compared_to_national": ("ami", "heart attack"),
}
EXPERIENCE_MEASURES = {
    "nurse_communication_score": ("nurse",),
    "doctor_communication_score": ("doctor",),
    "recommendation_score": ("recommend",),
    "cleanliness_score": ("clean",),
}
TIMELY_MEASURES = {
    "ed_throughput_score": ("ed", "emergency"),
    "door_to_ct_score": ("ct", "stroke"),
    "sepsis_care_score": ("sepsis", "sep"),
}
# output column -> (measure ids, keyword)
COMMUNITY_MEASURES = {
    "diabetes_prevalence": (("diabetes", "diabetes_crudeprev", "diabetes_adjprev"), "diabetes"),
    "obesity_prevalence": (("obesity", "obesity_crudeprev", "obesity_adjprev"), "obesity"),
    "smoking_prevalence": (("csmoking", "csmoking_crudeprev", "csmoking_adjprev"), "smok"),
    "poor_mental_health_days": (("mhlth", "mhlth_crudeprev", "mhlth_adjprev"), "mental"),
    "no_health_insurance_rate": (("access2", "access2_crudeprev", "access2_adjprev"), "insurance"),
    "physical_inactivity_rate": (("lpa", "lpa_crudeprev", "lpa_adjprev"), "physical inactivity"),
}

# --- fixed values: component weights ----------------------------------------
MEASURE_WEIGHTS = (
    ("patient_experience", 0.35, "HCAHPS patient experience composite"),
    ("timely_care", 0.30, "Timely and effective care process metrics"),
    ("readmission_performance", 0.35, "Inverted normalized readmission risk"),
    ("community_diabetes", 0.30, "CDC diabetes prevalence burden"),
    ("community_obesity", 0.25, "CDC obesity prevalence burden"),
    ("community_smoking", 0.20, "CDC smoking prevalence burden"),
    ("community_poor_health", 0.15, "CDC poor mental health burden"),
    ("community_no_insurance", 0.10, "CDC uninsured burden"),
)
QUALITY_COMPONENTS = {
    "overall_patient_experience_score": "patient_experience",
    "timely_care_score_0_100": "timely_care",
    "readmission_performance_score": "readmission_performance",
}
BURDEN_COMPONENTS = {
    "diabetes_prevalence": "community_diabetes",
    "obesity_prevalence": "community_obesity",
    "smoking_prevalence": "community_smoking",
    "poor_mental_health_days": "community_poor_health",
    "no_health_insurance_rate": "community_no_insurance",
}
NEUTRAL_SCORE = 50.0
CURRENT_YEAR = 2023

# --- fixed values: labels and cut points (first rule that holds wins) -------
RISK_LABEL_RULES = ((">=", 0.67, "High"), ("<=", 0.33, "Low"))
RISK_LABEL_DEFAULT = "Medium"
QUALITY_TIER_RULES = (
    (">=", 0.90, "Top 10%"),
    (">=", 0.67, "Above Average"),
    ("<=", 0.10, "Bottom 10%"),
    ("<=", 0.33, "Below Average"),
)
QUALITY_TIER_DEFAULT = "Average"
BURDEN_LABELS = {3: "High Burden", 2: "Moderate Burden"}
BURDEN_DEFAULT = "Low Burden"
RISK_ORDER = ("Low", "Medium", "High")
QUALITY_BANDS = ((70.0, "green"), (50.0, "amber"))
QUALITY_BAND_DEFAULT = "red"

# --- fixed values: keyword -> class, in order -------------------------------
SETTING_RULES = ((("critical access", "rural"), "Rural"),)
SETTING_DEFAULT = "Urban"
OWNERSHIP_RULES = (
    (("government",), "Government"),
    (("proprietary", "physician", "for profit"), "For-profit"),
    (("voluntary", "non"), "Non-profit"),
)
TYPE_RULES = (
    (("critical access",), "Critical Access"),
    (("psychiatric",), "Psychiatric"),
    (("children",), "Childrens"),
    (("acute",), "General Acute"),
)
OTHER = "Other"

# --- fixed values: encodings ------------------------------------------------
TYPE_CODES = {"Critical Access": 0, "General Acute": 1, "Psychiatric": 2, "Childrens": 3, "Other": 4}
OWNERSHIP_CODES = {"Government": 0, "Non-profit": 1, "For-profit": 2, "Other": 3}
SETTING_CODES = {"rural": 0, "urban": 1}

# --- fixed values: feature columns ------------------------------------------
FEATURE_ID_COLUMNS = (
    "provider_id", "hospital_name", "city", "state", "readmission_risk_label", "quality_tier",
)
OPTIONAL_FEATURES = (
    "diabetes_prevalence", "obesity_prevalence", "smoking_prevalence", "poor_mental_health_days",
    "no_health_insurance_rate", "physical_inactivity_rate", "overall_rating", "ed_throughput_score",
    "door_to_ct_score", "sepsis_care_score", "readm_heart_failure", "readm_pneumonia", "readm_copd",
    "readm_heart_attack", "readm_stroke", "readm_hip_knee",
)

# --- fixed values: dataset registry and source-column names -----------------
DATASETS = (
    "hospitals_general", "hospitals_readmissions", "hospitals_patient_experience",
    "hospitals_timely_care", "hospitals_general_2022", "hospitals_readmissions_2022",
    "hospitals_general_2021", "hospitals_readmissions_2021", "cdc_places_county",
)
# canonical column -> source columns, first one present wins
CANONICAL_COLUMNS = {
    "general": {
        "provider_id": ("facility_id", "provider_id", "cms_certification_number_ccn"),
        "hospital_name": ("facility_name", "hospital_name"),
        "city": ("citytown", "city"),
        "zip_code": ("zip_code", "zip"),
        "address": ("address",),
        "state": ("state",),
        "hospital_type": ("hospital_type",),
        "hospital_ownership": ("hospital_ownership", "ownership"),
        "overall_rating": ("hospital_overall_rating", "overall_rating"),
    },
    "readmission": {
        "provider_id": ("facility_id", "provider_id"),
        "hospital_name": ("facility_name", "hospital_name"),
        "state": ("state",),
        "measure_name": ("measure_name", "measure"),
        "measure_id": ("measure_id",),
        "score": (
            "score", "excess_readmission_ratio", "predicted_readmission_rate", "number_of_readmissions",
        ),
        "compared_to_national": ("compared_to_national", "compared_to_national_rate"),
    },
    "experience": {
        "provider_id": ("facility_id", "provider_id"),
        "hospital_name": ("facility_name", "hospital_name"),
        "state": ("state",),
        "measure_name": (
            "hcahps_measure_id", "hcahps_question", "measure_name", "hcahps_answer_description",
        ),
        "measure_id": ("hcahps_measure_id", "measure_id"),
        "score": (
            "hcahps_linear_mean_value", "linear_mean_value", "patient_survey_star_rating",
            "hcahps_answer_percent", "score",
        ),
    },
    "timely": {
        "provider_id": ("facility_id", "provider_id"),
        "hospital_name": ("facility_name", "hospital_name"),
        "state": ("state",),
        "measure_name": ("measure_name", "measure"),
        "measure_id": ("measure_id",),
        "score": ("score",),
    },
    "county": {
        "county_fips": ("locationid", "countyfips", "county_fips", "geolocationid"),
        "state": ("stateabbr", "state_abbr", "state"),
        "county_name": ("locationname", "county_name"),
        "measure_id": ("measureid", "measure_id"),
        "measure": ("measure", "measure_name"),
        "data_value": ("data_value", "datavalue"),
    },
}

# --- fixed values: page defaults --------------------------------------------
PERFORMANCE_DEFAULTS = {
    "hospital_name": "Unknown hospital",
    "city": "N/A",
    "state": "N/A",
    "hospital_type": "N/A",
    "composite_quality_score": None,
    "readmission_risk_score": None,
    "patient_experience_score": None,
    "readmission_risk_label": "Unknown",
    "quality_tier": "Unknown",
}
CORRELATION_PAIRS = (
    ("diabetes_prevalence", "readmission_risk_score", "Readmission Risk vs Diabetes Prevalence"),
    ("obesity_prevalence", "composite_quality_score", "Quality Score vs Obesity Prevalence"),
    ("smoking_prevalence", "readmission_risk_score", "Readmission Risk vs Smoking Rate"),
    ("community_health_burden_score", "composite_quality_score", "Quality Score vs Community Burden"),
)
OVERVIEW_BINS = 34
PERFORMANCE_BINS = 35

# --- fixed values: gates ----------------------------------------------------
MART_ROW_FLOOR = 4000
FILE_ROW_FLOOR = 1000
MAX_NULL_RATE = 0.20
MAX_LABEL_SHARE = 0.80

# --- fixed values: training -------------------------------------------------
SEED = 42
TEST_SHARE = 0.2
FOLDS = 5
EXPLAIN_ROWS = 5000
CLASSIFIER_GRID = {
    "max_depth": [3, 5, 7],
    "n_estimators": [100, 200],
    "learning_rate": [0.05, 0.1],
    "subsample": [0.8, 1.0],
}
REGRESSOR_GRID = {
    "num_leaves": [31, 50, 70],
    "learning_rate": [0.05, 0.1],
    "n_estimators": [100, 200],
    "min_child_samples": [20, 30],
}

# --- fixed values: sentence of an explanation -------------------------------
EXPLANATION = "This hospital was flagged {label} primarily because of {features}."

# --- fixed values: columns of each result -----------------------------------
LIST_COLUMNS = (
    "provider_id", "hospital_name", "city", "state", "hospital_type", "hospital_ownership",
    "composite_quality_score", "readmission_risk_score", "overall_patient_experience_score",
    "community_health_burden_score", "readmission_risk_label", "quality_tier",
)
RISK_MART_COLUMNS = (
    "provider_id", "hospital_name", "city", "state", "hospital_type", "hospital_ownership",
    "readmission_risk_score", "readmission_performance_score",
)
BEST_COLUMNS = (
    "hospital_name", "city", "state", "composite_quality_score", "readmission_risk_label", "quality_tier",
)
RISKIEST_COLUMNS = (
    "hospital_name", "city", "state", "readmission_risk_score", "readmission_risk_label", "composite_quality_score",
)
OVERVIEW_COLUMNS = (
    "hospital_name", "city", "state", "composite_quality_score", "readmission_risk_score",
    "readmission_risk_label", "overall_patient_experience_score", "quality_tier",
)
SCORECARD_COLUMNS = (
    "hospital_name", "state", "composite_quality_score", "readmission_risk_score",
    "overall_patient_experience_score", "community_health_burden_score", "readmission_risk_label", "quality_tier",
)
SEARCHED_COLUMNS = ("hospital_name", "city", "state")
SEARCH_RESULT = (
    "provider_id", "hospital_name", "city", "state", "composite_quality_score", "readmission_risk_label",
    "quality_tier", "hospital_type", "hospital_ownership", "community_health_burden_score",
)
PERFORMANCE_COLUMNS = (
    "hospital_name", "city", "state", "hospital_type", "composite_quality_score",
    "readmission_risk_score", "patient_experience_score", "readmission_risk_label", "quality_tier",
)

# ---- text files (fixed values) -----------------------------------------------

# Cells of a raw file that stand for nothing.
NULL_MARKERS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
                "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
