"""Column roles, thresholds and weights.

The column names are defaults only; every operator takes a ``Roles`` (or
explicit column lists), so the same jobs run on any table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# These must equal the reference's for equal results.
# Expected schema of the patient table and the value domains.
EXPECTED_COLUMNS = ["gender", "age", "hypertension", "heart_disease",
                    "smoking_history", "bmi", "HbA1c_level",
                    "blood_glucose_level", "diabetes"]
TARGET = "diabetes"
EXPECTED_CLASSES = [0, 1]
CATEGORICAL = ["gender", "smoking_history"]
BINARY = ["hypertension", "heart_disease", "diabetes"]
CONTINUOUS = ["age", "bmi", "HbA1c_level", "blood_glucose_level"]
VALID_VALUES = {
    "gender": ["Male", "Female", "Other"],
    "smoking_history": ["never", "current", "former", "not current", "ever", "No Info"],
}
CLASS_NAMES = ["No Diabetes", "Diabetes"]

# Feature-engineering thresholds; BMI bins are right-closed upper bounds.
AGE_RISK_THRESHOLD = 40.0
BMI_CATEGORIES = [("Underweight", 18.5), ("Normal", 24.9),
                  ("Overweight", 29.9), ("Obese", float("inf"))]
GLUCOSE_RISK_THRESHOLD = 140.0
HBA1C_RISK_THRESHOLD = 5.7
# Smoking weights per smoking_history value (anything else -> 0).
SMOKING_WEIGHTS = {"current": 1.0, "former": 0.7, "ever": 0.7,
                   "not current": 0.5, "never": 0.0, "No Info": 0.5}
# Score weights.
MEDICAL_WEIGHTS = {"hypertension": 2.0, "heart_disease": 2.0, "age_risk": 1.5, "bmi_high": 1.0}
MEDICAL_NORM = 6.5
METABOLIC_WEIGHTS = {"glucose_risk": 2.0, "hba1c_risk": 2.0, "bmi_high": 1.0}
METABOLIC_NORM = 5.0
LIFESTYLE_WEIGHTS = {"smoking_risk": 0.6, "bmi_high": 0.4}
COMBINED_WEIGHTS = {"medical_risk_score": 0.4, "metabolic_score": 0.4, "lifestyle_score": 0.2}
OVERWEIGHT_CODE = 2
# Cleaning / scaling defaults.
OUTLIER_Z = 3.0
IQR_FACTOR = 1.5
ROBUST_COLUMNS = ["age", "blood_glucose_level"]
STANDARD_COLUMNS = ["bmi", "HbA1c_level"]
TEST_SIZE = 0.2
SEED = 42
N_FOLDS = 5
KNN_K = 5
# Tuning objective weights (recall, accuracy), normalised to 1.
OBJECTIVE_WEIGHTS = {"recall": 0.7, "accuracy": 0.3}
DEFAULT_THRESHOLDS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Roles:
    """Column roles of a table."""

    continuous: tuple = tuple(CONTINUOUS)
    categorical: tuple = tuple(CATEGORICAL)
    binary: tuple = tuple(c for c in BINARY if c != TARGET)
    target: str = TARGET
    key: tuple = ()
    valid_values: dict = field(default_factory=lambda: dict(VALID_VALUES))
    expected_classes: tuple = tuple(EXPECTED_CLASSES)

    @property
    def expected_columns(self) -> list:
        return [*self.continuous, *self.categorical, *self.binary, self.target]

    @property
    def features(self) -> list:
        return [*self.continuous, *self.categorical, *self.binary]


PATIENT_ROLES = Roles(key=("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
