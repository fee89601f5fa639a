"""Column names and tunable values handed to the operators."""

from __future__ import annotations

from dataclasses import dataclass

# The codes and bands that results must agree on.
DIAGNOSIS_CODES = ("J01.90", "E11.9", "I10", "M54.5", "Z00.00", "R53.83")
BAD_CODES = ("INVALID-CODE-999", "BAD-ICD", "")


@dataclass(frozen=True)
class Columns:
    """Names of the roles a fact table plays; the defaults describe claims."""

    record: str = "claim_id"
    subject: str = "patient_id"
    provider: str = "hospital_id"
    code: str = "diagnosis_code"
    amount: str = "billed_amount"
    status: str = "claim_status"
    event_time: str = "service_ts"


CLAIMS = Columns()


@dataclass(frozen=True)
class Params:
    """Defaults of every rule. Pass ``dataclasses.replace(params, ...)`` to change one."""

    # The rules' thresholds, which results must agree on.
    max_billed_amount: float = 50_000.0
    invalid_diagnosis_code: str = "INVALID-CODE-999"
    default_diagnosis_code: str = "UNKNOWN"

    ratio_decimals: int = 3
    std_threshold: float = 2.0
    extreme_ratio: float = 1000.0
    null_amount_tolerance: float = 0.01

    n_clusters: int = 3
    seed: int = 42
    max_iter: int = 300
    feature_columns: tuple[str, ...] = ("billed_amount", "hosp_avg_billed", "amount_to_avg_ratio")
    ratio_column: str = "amount_to_avg_ratio"
    # Training needs more rows than this.
    min_training_rows: int = 1000

    anomaly_ratio_threshold: float = 1.1
    min_clusters_for_anomaly: int = 2
    confidence_span: float = 2.0
    high_confidence: float = 0.7
    medium_confidence: float = 0.4
    review_ratio: float = 1.5

    # A provider baseline has one row per provider. It is broadcast only when a
    # count of the providers has shown it to be at most this long.
    broadcast_max_rows: int = 500_000


DEFAULTS = Params()
