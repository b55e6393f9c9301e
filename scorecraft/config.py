"""Every threshold of the pipeline in one immutable object.

The reference keeps these as class attributes that only one entry point sets,
so staged runs silently fall back to defaults; here each operator receives
the values explicitly.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Fixed values that must equal the reference's defaults for equal results.
# Class defaults: Cramér's V 0.5, VIF 10, risk bands 5, correlation 0.5,
# IV 0.02, missing share 0.6, categorical cardinality 15, CSI bins = deciles
# 0.1..1.0, IV bins 5, model bins 5, binner maximum bins 20, binner
# low-cardinality cutoff 5, monotonic cutoff 0.001, test share 0.25,
# seed 144, sample fraction 0.1, L1 weight 0.8, numeric sentinel -999,
# categorical fill 'missing', good label 'Level0', bad label 'level1'.
GOOD_LABEL = "Level0"
BAD_LABEL = "level1"
MISSING_LEVEL = "missing"
MISSING_BIN = -1
ROLES = ("Train", "Test", "OOT", "PDV")


@dataclass(frozen=True)
class ScorecardConfig:
    target: str = "loan_status"
    bad_values: tuple = ("Charged Off", "Default")
    exclude: tuple = ()
    missing_threshold: float = 0.6
    missing_denominator: str = "rows"          # or "max_missing" (reference quirk)
    max_cardinality: int = 15
    iv_threshold: float = 0.02
    iv_bins: int = 5
    cramersv_threshold: float = 0.5
    correlation_threshold: float = 0.5
    vif_threshold: float = 10.0
    csi_threshold: float = 0.25
    risk_bands: int = 5
    model_bins: int = 5
    max_bins: int = 20
    low_cardinality_cutoff: int = 5
    monotonic_cutoff: float = 0.001
    impute_numeric: str = "median"             # mean | median | constant | drop
    numeric_fill: float = -999.0
    categorical_fill: str = MISSING_LEVEL
    test_fraction: float = 0.25
    seed: int = 144
    sample_fraction: float | None = None
    l1_alpha: float = 0.8
    max_features: int | None = None
    selection_method: str = "L1"               # RFE | forward | backward | L1
    quantile_method: str = "exact"             # exact | approx
    quantile_accuracy: int = 10000
    custom_edges: dict = field(default_factory=dict)
    category_groups: dict = field(default_factory=dict)
    transforms: dict = field(default_factory=dict)
    band_cuts: tuple | None = None
    binned: bool = True                        # False: numeric columns enter the model as they are
    binning_method: str = "quantile"           # quantile | monotonic
    penalise_constant: bool = False            # True: the L1 norm holds the constant, as in the reference
    selection_encoder: str = "woe"             # woe | ordinal
    split_key: str | None = None               # key of the train / test split where no test rows are given
    distribution_check: str | None = None      # a method of distcheck, to compare Train with every other role

    def with_(self, **kw) -> "ScorecardConfig":
        return replace(self, **kw)
