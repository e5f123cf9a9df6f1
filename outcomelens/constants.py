"""Column names, word lists, formats and colours that results depend on."""

from __future__ import annotations

# Boolean words (compared after trim and lower).
TRUE_WORDS = ("true", "t", "1", "y", "yes")
FALSE_WORDS = ("false", "f", "0", "n", "no")

# Timestamp patterns tried after the ISO default, in this order.
TIMESTAMP_PATTERNS = (
    "MM/dd/yyyy hh:mm:ss a",
    "MM/dd/yyyy HH:mm:ss",
    "MM/dd/yyyy HH:mm",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
)

# Seasons in report order.
SEASON_ORDER = ("Winter", "Spring", "Summer", "Fall")

# Fixed value: stands for a missing categorical level.
MISSING_LEVEL = "__NA__"

# Raw columns kept by the CSV conversion.
RAW_COLUMNS = (
    "id", "case number", "date", "block", "iucr",
    "primary type", "description", "location description",
    "arrest", "domestic", "beat", "district", "ward",
    "community area", "fbi code",
)

# Columns of the modelling table, in output order.
PREPARED_COLUMNS = (
    "Arrest", "Primary Type", "Description", "Location Description",
    "Domestic", "Beat", "Block", "BlockFreq", "District", "Ward",
    "Community Area", "Year", "Month", "DayOfWeek", "Hour",
    "IsWeekend", "Season",
)

# Columns the linear model reads, after name normalisation.
LINEAR_COLUMNS = (
    "date", "primary_type", "location_description", "beat", "district",
    "ward", "community_area", "arrest", "domestic", "fbi_code", "iucr", "block",
)
LINEAR_CATEGORICAL = (
    "primary_type", "location_description", "beat", "district", "ward",
    "community_area", "fbi_code", "iucr", "block",
)
LINEAR_NUMERIC = ("DomesticNum", "Year", "Month", "DayOfWeek", "Hour", "IsWeekend")

# Features of the tree models.
TREE_CATEGORICAL = (
    "Primary Type", "Description", "Location Description", "Beat", "Block",
    "District", "Ward", "Community Area", "Season",
)
TREE_NUMERIC = ("Domestic", "BlockFreq", "Year", "Month", "DayOfWeek", "Hour", "IsWeekend")

# Column order of the per-group metrics table (after its key).
GROUP_METRIC_COLUMNS = (
    "n_obs", "ArrestRate_true", "ArrestRate_pred", "MeanProb",
    "TP", "FP", "TN", "FN",
    "Precision", "Recall", "F1", "AUC", "Brier", "FP_rate", "FN_rate",
)

# Accepted spellings of each metric column, first present one wins.
METRIC_ALIASES = {
    "community_area": (
        "community_area", "community", "area", "area_id", "comm_area", "area_num",
        "area_number", "area_numbe", "community_area_id", "communityarea",
        "community_area_number",
    ),
    "fp_rate": (
        "fp_rate", "false_positive_rate", "fp", "fpr", "fp_pct", "fp_percent", "fp_rate_mean",
    ),
    "fn_rate": (
        "fn_rate", "false_negative_rate", "fn", "fnr", "fn_pct", "fn_percent", "fn_rate_mean",
    ),
    "n_obs": ("n_obs", "n", "count", "support", "n_test", "nrows", "n_samples", "num_obs"),
    "arrest_rate_true": (
        "arrest_rate_true", "arrestrate_true", "arrest_rate_obs", "arrest_rate_actual",
        "true_arrest_rate", "arrest_rate",
    ),
}

# Names under which region files carry the area number.
REGION_KEY_CANDIDATES = (
    "area_numbe", "area_num_1", "area_num", "AREA_NUMBE", "AREA_NUM_1", "AREA_NUM",
)
REGION_KEY_RANGE = (1, 77)

# Columns of the model comparison table.
COMPARED_METRICS = ("Accuracy", "Precision", "Recall", "F1-Score")
CONFUSION_CELLS = ("TN", "FP", "FN", "TP")
SUMMARY_COLUMNS = (
    "Model", "Accuracy", "Precision", "Recall", "F1-Score", "ROC-AUC", "TN", "FP", "FN", "TP",
)

# Support floor, precision floor, rate-report floor and page size.
MIN_SUPPORT = 200
MIN_PRECISION = 0.60
BUSY_MIN_COUNT = 200
BUSY_TOP_N = 20

# Map colours.
NO_DATA_COLOUR = "#dddddd"
ACCURACY_RANGE = (0.4, 0.9)
ACCURACY_COLOURS = ((33, 113, 181), (215, 25, 28))
ERROR_RAMP = ((0, 0, 255), (255, 0, 0))
RATE_RAMP = ((255, 255, 178), (254, 204, 92), (253, 141, 60), (240, 59, 32), (189, 0, 38))

# Names under which region files carry the district number, and the metrics shown per region key.
DISTRICT_KEY_CANDIDATES = ("DIST_NUM", "dist_num", "district")
GROUP_LAYERS = {
    "District": ("ArrestRate_true", "AUC", "FP_rate", "FN_rate"),
    "Community Area": ("ArrestRate_true", "FP_rate", "FN_rate"),
}

# Public colour ramps of the group layers, from the least to the greatest value (viridis at its quarters).
LAYER_RAMPS = {
    "ArrestRate_true": (
        (255, 247, 236), (254, 232, 200), (253, 212, 158), (253, 187, 132), (252, 141, 89),
        (239, 101, 72), (215, 48, 31), (179, 0, 0), (127, 0, 0),
    ),
    "AUC": ((68, 1, 84), (59, 82, 139), (33, 145, 140), (94, 201, 98), (253, 231, 37)),
    "FP_rate": (
        (252, 251, 253), (239, 237, 245), (218, 218, 235), (188, 189, 220), (158, 154, 200),
        (128, 125, 186), (106, 81, 163), (84, 39, 143), (63, 0, 125),
    ),
    "FN_rate": (
        (247, 251, 255), (222, 235, 247), (198, 219, 239), (158, 202, 225), (107, 174, 214),
        (66, 146, 198), (33, 113, 181), (8, 81, 156), (8, 48, 107),
    ),
}
