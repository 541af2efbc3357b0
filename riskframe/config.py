"""The data contract, costs, decision rule, quality gate and drift limits."""

SEED = 42

TARGET = "machine_failure"
PROBABILITY = "probability"
KEY = "state_id"
CAUSES = ["twf", "hdf", "pwf", "osf", "rnf"]
ID_COLUMNS = ["udi", "product_id"]
TYPES = ["L", "M", "H"]

# Column names of the raw file -> technical names.
RAW_COLUMNS = {
    "UDI": "udi",
    "Product ID": "product_id",
    "Type": "type",
    "Air temperature [K]": "air_temperature_k",
    "Process temperature [K]": "process_temperature_k",
    "Rotational speed [rpm]": "rotational_speed_rpm",
    "Torque [Nm]": "torque_nm",
    "Tool wear [min]": "tool_wear_min",
    "Machine failure": "machine_failure",
    "TWF": "twf",
    "HDF": "hdf",
    "PWF": "pwf",
    "OSF": "osf",
    "RNF": "rnf",
}

MEASURES = [
    "air_temperature_k",
    "process_temperature_k",
    "rotational_speed_rpm",
    "torque_nm",
    "tool_wear_min",
]
INPUT_FIELDS = ["type", *MEASURES]
ENGINEERED = ["temp_difference_k", "power_w", "wear_torque_min_nm"]

TEST_SHARE = 0.15
VALIDATION_SHARE = 0.15

CONTRACT = {
    "expected_row_count": 10000,
    "check_row_count": False,
    "max_missing_ratio": 0.0,
    "warn_on_unexpected_columns": True,
    "known_columns": [*ID_COLUMNS, *CAUSES],
    "columns": {
        "type": {"required": True, "kind": "categorical", "allowed": ["L", "M", "H"]},
        "air_temperature_k": {
            "required": True, "kind": "numeric",
            "min": 250.0, "max": 350.0, "warn_min": 293.0, "warn_max": 307.0,
        },
        "process_temperature_k": {
            "required": True, "kind": "numeric",
            "min": 250.0, "max": 380.0, "warn_min": 303.0, "warn_max": 317.0,
        },
        "rotational_speed_rpm": {
            "required": True, "kind": "numeric",
            "min": 0.0, "max": 10000.0, "warn_min": 1000.0, "warn_max": 3000.0,
        },
        "torque_nm": {
            "required": True, "kind": "numeric",
            "min": 0.0, "max": 200.0, "warn_min": 0.0, "warn_max": 90.0,
        },
        "tool_wear_min": {
            "required": True, "kind": "numeric",
            "min": 0.0, "max": 1000.0, "warn_min": 0.0, "warn_max": 260.0,
        },
        "machine_failure": {"required": False, "kind": "categorical", "allowed": [0, 1]},
    },
}

# Costs per outcome; a true negative costs nothing.
COST_FN = 10000
COST_FP = 500
COST_TP = 800

THRESHOLD = 0.06
GRID_STEPS = 99          # thresholds 0.01, 0.02, ... 0.99
DEFAULT_THRESHOLD = 0.5

QUALITY_GATE = {"min_pr_auc": 0.75, "min_recall": 0.80, "max_expected_cost_eur": 200000.0}

RANDOM_FOREST = {"trees": 150, "depth": 10, "feature_share": "0.5", "min_leaf": 5}
COMPARISON = {
    "logistic_regression": {"max_iter": 1000},
    "random_forest": {"trees": 300, "depth": 15},
    "boosting": {"rounds": 300, "depth": 5, "step": 0.1},
}
CV_FOLDS = 5
SEARCH_TRIALS = 30

# Fixed values of the random search: ranges are (from, to), lists are choices.
SEARCH_RANGES = {
    "random_forest": {
        "trees": ("whole", 100, 600),
        "depth": [6, 10, 15, 20, 30],
        "min_leaf": ("whole", 1, 10),
        "share": ["sqrt", "log2", "0.5"],
        "weight": ["unit_weight", "balanced_weight", "balanced_per_tree"],
    },
    "boosting": {
        "rounds": ("whole", 100, 600),
        "depth": ("whole", 3, 10),
        "step": ("log", 0.01, 0.3),
        "subsample": ("even", 0.6, 1.0),
        "share": ("share", 0.6, 1.0),
        "min_leaf": ("whole", 1, 10),
        "weight": ["unit_weight", "sqrt_weight", "ratio_weight"],
    },
    "logistic_regression": {
        "c": ("log", 0.01, 100.0),
        "weight": ["unit_weight", "balanced_weight"],
    },
}

SAMPLE_SIZE = 1000
PSI_BINS = 10
PSI_WARN = 0.10
PSI_ALARM = 0.25
ALPHA = 0.05
MIN_ROWS = 100
SHARE_FLOOR = 1e-6

MIN_SLICE_ROWS = 50
WORST_SLICES = 10
BOOTSTRAP_DRAWS = 2000

MODEL_NAME = "random_forest"

# Monitoring policy: retraining volume, days between scheduled retrainings, runs a finding must hold.
RETRAIN_ROWS = 2000
RETRAIN_DAYS = 182
PERSISTENCE_RUNS = 3
LEAST_IMPORTANCE = 0.01  # average precision that a contributing feature loses when permuted
MAX_BATCH_ITEMS = 1000

# The measures whose quartile bands are sliced by, and the pairs that are crossed.
SLICE_BANDS = {
    "wear_band": "tool_wear_min",
    "torque_band": "torque_nm",
    "speed_band": "rotational_speed_rpm",
    "temp_difference_band": "temp_difference_k",
    "power_band": "power_w",
}
SLICE_CROSSES = [
    ("type", "wear_band"),
    ("torque_band", "speed_band"),
    ("temp_difference_band", "speed_band"),
]
