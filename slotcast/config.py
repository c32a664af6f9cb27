"""Fixed values that define the semantics (kept as parameters everywhere)."""

from __future__ import annotations

# Fixed values that must equal the source system's for equal results:
# grid step 5 minutes, window length 288 steps (24 h), serving horizon 12 steps
# (60 min), evaluation label 13 steps after the last window row, training label
# 1 step after it, count scale 100.0, hour scale 24.0, drift days looked at 7,
# drift days that trigger 3, training tail fraction 0.7, validation slice
# 0.8 to 0.9, forecast export look-back 2 hours, missing-metric sentinel 9999.0,
# day-first text format dd/MM/yyyy HH:mm:ss.
STEP_MINUTES = 5
STEP_SECONDS = STEP_MINUTES * 60
SLOTS_PER_DAY = 24 * 60 // STEP_MINUTES  # 288
N_STEPS = 288
SERVE_HORIZON = 12
EVAL_LEAD = 13
TRAIN_LEAD = 1
CAR_MAX = 100.0
HOUR_MAX = 24.0
DRIFT_DAYS = 7
DRIFT_TRIGGER_DAYS = 3
TRAIN_TAIL_FRACTION = 0.7
VALID_START_FRACTION = 0.8
VALID_END_FRACTION = 0.9
EXPORT_LOOKBACK_HOURS = 2
MISSING_METRIC = 9999.0
DAY_FIRST_FORMAT = "dd/MM/yyyy HH:mm:ss"
ISO_SECONDS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
ISO_MICROS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
RESPONSE_FORMAT = "yyyy-MM-dd HH:mm:ss"
DRIFT_THRESHOLD_REFERENCE = 10.0

# Fixed texts of the promotion decision.
APPROVED, REJECTED = "Approved", "Rejected"
NO_REPORT_TEXT = "Error: Report not found."
APPROVED_TEXT = "Auto-approved: Better Performance (%s < %s)"
REJECTED_TEXT = "Auto-rejected: Worse Performance (%s >= %s)"

# Counts are stored as decimals so that sums are exact on any partitioning; the
# type is wide enough not to round or cap a reading.
COUNT_TYPE = "decimal(28,10)"
