"""The constants that engine and SQL share, against literal values."""

from wardlight import fixed_values as fv


def test_labels_and_grids():
    assert fv.BURDEN_LABELS == {3: "High Burden", 2: "Moderate Burden"} and fv.BURDEN_DEFAULT == "Low Burden"
    assert "N/A" in fv.NULL_MARKERS and "nan" in fv.NULL_MARKERS and len(fv.NULL_MARKERS) == 19
    assert fv.SEED == 42 and fv.FOLDS == 5 and fv.TEST_SHARE == 0.2 and fv.EXPLAIN_ROWS == 5000


def test_measures_and_grids_as_published():
    assert fv.TIMELY_MEASURES == {"ed_throughput_score": ("ed", "emergency"), "door_to_ct_score": ("ct", "stroke"),
                                  "sepsis_care_score": ("sepsis", "sep")}
    assert fv.COMMUNITY_MEASURES["smoking_prevalence"] == (("csmoking", "csmoking_crudeprev", "csmoking_adjprev"), "smok")
    assert fv.COMMUNITY_MEASURES["physical_inactivity_rate"] == (("lpa", "lpa_crudeprev", "lpa_adjprev"), "physical inactivity")
    assert [ids[0] for ids, _ in fv.COMMUNITY_MEASURES.values()] == ["diabetes", "obesity", "csmoking", "mhlth", "access2", "lpa"]
    assert fv.EXPLANATION.format(label="High", features="a, b") == "This hospital was flagged High primarily because of a, b."
    assert fv.CLASSIFIER_GRID == {"max_depth": [3, 5, 7], "n_estimators": [100, 200], "learning_rate": [0.05, 0.1], "subsample": [0.8, 1.0]}
    assert fv.REGRESSOR_GRID == {"num_leaves": [31, 50, 70], "learning_rate": [0.05, 0.1], "n_estimators": [100, 200],
                                 "min_child_samples": [20, 30]}
