"""Names, bands and thresholds shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass, field

# Forecast anchors, horizon bands and their labels, in years.
ANCHOR_HORIZONS = (0, 2, 5, 10, 15, 20)
HORIZON_EDGES = (0.0, 3.5, 7.5, 12.5, 25.0)
HORIZON_LABELS = ("~2y", "~5y", "~10y", "~20y")

# Plausible coordinate box, applied after decoding.
COORDINATE_BOX = {"latitude": (24.0, 38.0), "longitude": (-108.0, -92.0)}

# Generous unit-check ranges used by the source gate.
PLAUSIBLE_RANGES = {
    "latitude": (25.0, 37.0),
    "longitude": (-107.0, -93.0),
    "inventory_load": (0.0, 10.0),
    "operating_load": (0.0, 10.0),
    "deck": (0.0, 9.0),
    "superstructure": (0.0, 9.0),
    "substructure": (0.0, 9.0),
    "culvert": (0.0, 9.0),
    "year_built": (1800.0, 2100.0),
    "skew_angle": (0.0, 99.0),
}

DAYS_PER_YEAR = 365.25


@dataclass(frozen=True)
class HorizonBands:
    """Right-closed horizon bands: ``edges[i] < horizon <= edges[i + 1]`` is ``labels[i]``."""

    edges: tuple[float, ...] = HORIZON_EDGES
    labels: tuple[str, ...] = HORIZON_LABELS

    @property
    def max_years(self) -> float:
        return self.edges[-1]


@dataclass(frozen=True)
class Screen:
    """Watch-list rule: current rating inside the band, conservative forecast at or below poor."""

    horizon_years: float = 10.0
    current_min: float = 5.0
    current_max: float = 7.0
    poor_threshold: float = 5.0
    on_system_only: bool = True


@dataclass(frozen=True)
class TreeParams:
    """Boosting and forest sizes. The defaults are the full-size models; tests pass small ones."""

    rounds: int = 300
    depth: int = 6
    learning_rate: float = 0.1
    subsample: float = 0.8
    feature_share: float = 0.8
    min_leaf: int = 3
    forest_trees: int = 100
    max_bins: int = 128
    seed: int = 42
    # Share of the assets that are kept from the fits and calibrate the risk; 0 leaves it as it is.
    calibration_share: float = 0.2


@dataclass(frozen=True)
class PanelConfig:
    asset_id: str = "asset_id"
    raw_date: str = "raw_date"
    event_date: str = "event_date"
    tiebreak: str = "snapshot_no"
    region: str = "region"
    on_system: str = "on_system"
    year_built: str = "year_built"
    components: tuple[str, ...] = ("deck", "superstructure", "substructure", "culvert")
    numeric: tuple[str, ...] = (
        "structure_length", "max_span_length", "deck_width", "roadway_width", "adt", "adt_year",
        "year_built", "year_reconstructed", "skew_angle", "num_spans_main", "num_spans_approach",
        "deck_area", "asset_age", "latitude", "longitude", "inventory_load", "operating_load",
        "approach_width",
    )
    categorical: tuple[str, ...] = (
        "owner", "maintenance_resp", "structure_kind", "structure_type", "deck_type",
        "wearing_surface", "membrane_type", "deck_protection", "design_load", "region",
        "climate_zone", "functional_class",
    )
    trajectory_numeric: tuple[str, ...] = (
        "structure_length", "max_span_length", "deck_width", "roadway_width", "adt", "adt_year",
        "skew_angle", "latitude", "longitude", "inventory_load", "operating_load",
        "approach_width",
    )
    trajectory_categorical: tuple[str, ...] = (
        "owner", "maintenance_resp", "design_load", "region", "functional_class",
    )
    static_numeric: tuple[str, ...] = ("num_spans_main", "num_beam_lines", "adt_truck")
    static_categorical: tuple[str, ...] = (
        "structure_kind", "structure_type", "span_continuity", "deck_type", "wearing_surface",
        "deck_protection", "scour_vulnerability", "load_posting_status",
    )
    engineered: tuple[str, ...] = ("asset_age", "deck_area")
    max_horizon_years: float = 25.0
    # Training pairs per component; evaluation always uses every held-out pair.
    pair_cap: int = 1_200_000
    min_pairs: int = 100
    hybrid_years: float = 3.0
    quantile: float = 0.25
    risk_threshold: float = 5.0
    test_share: float = 0.3
    seed: int = 42
    bands: HorizonBands = field(default_factory=HorizonBands)
    screen: Screen = field(default_factory=Screen)


# Attribute name -> feature identifier in the attribute-value source.
EXTRACT_FEATURES = {
    "deck": 2300701,
    "superstructure": 2300702,
    "substructure": 2300703,
    "culvert": 2300704,
    "deck_legacy": 2005800,
    "superstructure_legacy": 2005900,
    "substructure_legacy": 2006000,
    "culvert_legacy": 2006200,
    "region": 2300104,
    "facility_carried": 2000700,
    "features_intersected": 2000610,
    "structure_length": 2300401,
    "max_span_length": 2300403,
    "deck_width": 2300405,
    "roadway_width": 2300406,
    "year_built": 2300901,
    "skew_angle": 2300411,
    "owner": 2300201,
    "maintenance_resp": 2300202,
    "design_load": 2300501,
    "approach_width": 2300409,
    "adt": 2306013,
    "adt_year": 2306015,
    "adt_truck": 2306014,
    "load_posting_status": 2310003,
    "functional_class": 2306005,
    "structure_kind": 2303005,
    "structure_type": 2303007,
    "span_continuity": 2303006,
    "num_spans_main": 2303003,
    "num_beam_lines": 2303004,
    "deck_type": 2303010,
    "wearing_surface": 2303011,
    "deck_protection": 2303012,
    "channel_rating": 2300709,
    "scour_vulnerability": 2300803,
    "county_code": 2300102,
    "inspection_date": 2302015,
    "inspection_interval": 2302017,
}

# Column order of the 41-column attribute extract.
EXTRACT_COLUMNS = (
    "as_id", "as_code", "deck", "superstructure", "substructure", "culvert", "region",
    "climate_zone", "structure_length", "max_span_length", "deck_width", "roadway_width", "adt",
    "adt_year", "adt_truck", "year_built", "year_reconstructed", "skew_angle", "num_spans_main",
    "num_beam_lines", "num_spans_approach", "owner", "maintenance_resp", "structure_kind",
    "structure_type", "span_continuity", "deck_type", "wearing_surface", "membrane_type",
    "deck_protection", "design_load", "approach_width", "functional_class", "facility_carried",
    "features_intersected", "channel_rating", "scour_vulnerability", "load_posting_status",
    "county_code", "inspection_date", "inspection_interval",
)

# Name fragments searched in the feature catalogue (first and follow-up pass).
FEATURE_KEYWORDS = (
    "structure length", "span length", "max span", "deck width", "roadway width", "curb to curb",
    "average daily traffic", "adt", "year built", "year reconstruct", "skew", "number of spans",
    "spans in main", "spans in approach", "owner", "maintenance respons", "structure kind",
    "structure type", "deck type", "wearing surface", "membrane", "deck protection",
    "design load", "approach roadway width", "functional class",
)

# The stratum of assets whose stratifying attribute is missing.
UNKNOWN = "unknown"
