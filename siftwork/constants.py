"""Fixed values that results depend on: word lists, enumerations, patterns, thresholds."""

from __future__ import annotations

# Terms of the keyword score.
POSITIVE_TERMS = (
    "accuracy", "loss", "score", "performance", "comparison", "baseline", "ablation", "epoch", "step", "training",
    "validation", "test", "metric", "benchmark", "precision", "recall", "f1", "auc", "roc", "pr curve",
    "error", "rmse", "mae", "distribution", "histogram", "cumulative", "density", "frequency", "scatter", "correlation",
    "heatmap", "confusion matrix", "latency", "throughput", "speed", "time", "memory", "parameter", "scaling", "redshift",
    "flux", "spectrum", "mass", "temperature", "energy", "residual", "profile",
)
NEGATIVE_TERMS = (
    "architecture", "framework", "pipeline", "overview", "workflow", "algorithm", "pseudocode", "screenshot", "user interface", " ui ",
    "qualitative examples", "generated samples", "input image", "output image", "segmentation result", "detection example",
    "reconstruction example", "network structure", "computational graph", "model diagram",
)

# Enumerations.
IMAGE_SUFFIXES = (".png", ".jpg", ".jpeg", ".webp", ".bmp", ".tif", ".tiff")
CHART_TYPES = (
    "line_chart", "bar_chart", "scatter_plot", "histogram", "density_plot", "heatmap", "confusion_matrix", "box_plot", "violin_plot", "area_chart",
    "roc_curve", "pr_curve", "calibration_curve", "ablation_curve", "error_bar_plot", "contour_plot", "surface_plot", "matrix_plot", "other_chart",
)
ANSWER_TYPES = ("numeric_exact", "numeric_approx", "integer", "choice", "ranked_list", "trend_label", "boolean", "short_phrase")
DIFFICULTIES = ("medium", "hard")
#: task: (weight, answer types).
TASKS = {
    "cross_element_comparison": (18, ("choice", "short_phrase", "numeric_approx", "ranked_list")),
    "approximate_value_estimation": (15, ("numeric_approx",)),
    "fine_grained_visual_reading": (10, ("short_phrase", "numeric_exact", "numeric_approx", "choice")),
    "multi_element_synthesis": (15, ("short_phrase", "choice", "ranked_list")),
    "trend_pattern_analysis": (15, ("trend_label", "short_phrase", "choice")),
    "anomaly_extrema_detection": (10, ("short_phrase", "numeric_approx", "choice")),
    "complex_calculation": (10, ("numeric_approx", "numeric_exact", "integer")),
    "hypothetical_reasoning": (7, ("numeric_approx", "choice", "short_phrase", "boolean")),
}
#: Characters of a caption that a prompt quotes.
PROMPT_CAPTION = 5000
#: Task and length of its run in the cyclic assignment.
CYCLE = (
    ("descriptive_extraction", 20),
    ("text_in_chart", 15),
    ("number_in_chart", 15),
    ("visual_comparison", 20),
    ("trend_reasoning", 15),
    ("counting", 10),
)

# Patterns. They are case-insensitive.
LOW_VALUE = (
    r"\b(title|caption)\s+(of|for)\s+(the\s+)?(chart|plot|figure)\b",
    r"\bwhat\s+is\s+(the\s+)?(chart|plot|figure)\s+title\b",
    r"\bwhat\s+is\s+(the\s+)?([xy]|horizontal|vertical)[-\s]?axis\s+label\b",
    r"\b(label|name)\s+(of|for)\s+(the\s+)?([xy]|horizontal|vertical)[-\s]?axis\b",
    r"\bwhat\s+does\s+(the\s+)?(legend|colorbar|color\s+bar)\s+(show|represent|indicate)\b",
    r"\bwhat\s+is\s+(the\s+)?(legend|colorbar|color\s+bar)\s+label\b",
    r"\bwhich\s+panel\s+is\s+labeled\s+\(?[a-z]\)?\b",
    r"\bwhat\s+is\s+shown\s+in\s+(the\s+)?(chart|plot|figure)\b",
)
REASONING = (
    r"\b(compare|larger|smaller|higher|lower|highest|lowest|largest|smallest|difference|ratio|twice|half|increase|decrease|trend|peak|valley|outlier|"
    r"approximately|estimate|between|across|relative|if|would|change|rank|most|least)\b"
)
PANELS = (
    r"\b(four|three|two|multiple)\s+panels\b|\bacross\s+(all\s+)?(the\s+)?panels\b|\btop[- ]left\b|\btop[- ]right\b|"
    r"\bbottom[- ]left\b|\bbottom[- ]right\b|\bpanel\s+\(?[a-z]\)?\b"
)
NUMBER = r"[-+]?\d+(?:,\d{3})*(?:\.\d+)?(?:[eE][-+]?\d+)?\s*%?"
PAPER_ID = r"^(20|21|22|23|24|25)[0-9]{2}\.[0-9]+"

# Words and marks that answers and questions lose.
ASCII_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
CJK_MARKS = "，。！？；：“”‘’、（）【】《》"
QUESTION_STOP_WORDS = ("the", "and", "or", "for", "from", "with", "which", "what", "chart", "plot", "figure", "shown", "value", "values", "mean", "approximate")
YES, NO = ("yes", "y", "true", "correct"), ("no", "n", "false", "incorrect")

# Thresholds.
MIN_CAPTION, MIN_SHORT_SIDE, MIN_AREA, MIN_ASPECT, MAX_ASPECT = 10, 256, 80_000, 0.15, 8.0
ACCEPT, WEAK_ACCEPT = 0.75, 0.60
SIMILAR = 0.72
PAGE_LIMIT = 2200
CAPTION_FAILED = "Automatic dense caption generation failed"
ANSWER_SCHEMA, CAPTION_SCHEMA = "triple_consistency_v1", "kimi_caption_thinking_no_verify_v2"
RETRYABLE = (408, 409, 424, 429, 500, 502, 503, 504)
