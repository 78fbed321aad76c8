"""Parameters of the preparation: column roles, bins and split settings."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field


@dataclass(frozen=True)
class BinSpec:
    """Upper edges (inclusive) and one label more than edges.

    ``null_label`` is what a missing value gets; by default the open last bin.
    """

    edges: tuple[float, ...]
    labels: tuple[str, ...]
    null_label: str | None = None

    def __post_init__(self) -> None:
        if len(self.labels) != len(self.edges) + 1:
            raise ValueError("a bin needs one label more than edges")
        if list(self.edges) != sorted(set(self.edges)):
            raise ValueError("edges must ascend")


# Tenure bins in months and their configured order.
TENURE_BINS = BinSpec(edges=(12, 48), labels=("Newer", "Medium", "Long-term"), null_label="Long-term")


@dataclass(frozen=True)
class SplitSpec:
    test_size: float = 0.2
    seed: int = 42
    stratify: bool = True


@dataclass(frozen=True)
class FeatureSpec:
    """Column roles of one flat table."""

    key: str
    target: str
    nominal: tuple[str, ...] = ()
    numerical: tuple[str, ...] = ()
    binned: str | None = None
    bins: BinSpec = TENURE_BINS
    remainder: tuple[str, ...] = ()
    critical: str | None = None
    max_outlier_columns: int = 1
    split: SplitSpec = field(default_factory=SplitSpec)

    @property
    def ordinal(self) -> tuple[str, ...]:
        return (f"{self.binned}_bins",) if self.binned else ()

    @property
    def raw_columns(self) -> tuple[str, ...]:
        binned = (self.binned,) if self.binned else ()
        own = (self.key, *self.nominal, *binned, *self.remainder, *self.numerical, self.target)
        return (*own, self.critical) if self.critical and self.critical not in own else own

    def fingerprint(self) -> str:
        """Short digest of all settings, for the path of derived tables."""
        text = json.dumps(asdict(self), sort_keys=True)
        return hashlib.md5(text.encode()).hexdigest()[:12]


# Column roles of the customer churn table.
CHURN = FeatureSpec(
    key="customerID",
    target="Churn",
    nominal=(
        "gender",
        "Partner",
        "Dependents",
        "PhoneService",
        "MultipleLines",
        "InternetService",
        "OnlineSecurity",
        "OnlineBackup",
        "DeviceProtection",
        "TechSupport",
        "StreamingTV",
        "StreamingMovies",
        "Contract",
        "PaperlessBilling",
        "PaymentMethod",
    ),
    numerical=("MonthlyCharges", "TotalCharges"),
    binned="tenure",
    remainder=("SeniorCitizen",),
    critical="TotalCharges",
)

# Type and default of every field of a customer message.
CHURN_FIELDS: dict[str, tuple[str, object]] = {
    "customerID": ("string", "0"),
    "gender": ("string", "Male"),
    "SeniorCitizen": ("int", 0),
    "Partner": ("string", "No"),
    "Dependents": ("string", "No"),
    "tenure": ("int", 0),
    "PhoneService": ("string", "Yes"),
    "MultipleLines": ("string", "No"),
    "InternetService": ("string", "DSL"),
    "OnlineSecurity": ("string", "No"),
    "OnlineBackup": ("string", "No"),
    "DeviceProtection": ("string", "No"),
    "TechSupport": ("string", "No"),
    "StreamingTV": ("string", "No"),
    "StreamingMovies": ("string", "No"),
    "Contract": ("string", "Month-to-month"),
    "PaperlessBilling": ("string", "Yes"),
    "PaymentMethod": ("string", "Electronic check"),
    "MonthlyCharges": ("double", 0.0),
    "TotalCharges": ("double", 0.0),
    "Churn": ("string", "No"),
}
# Fields that must hold a number for a message to be scored.
CHURN_REQUIRED = ("SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges")
