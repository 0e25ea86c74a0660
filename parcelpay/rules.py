"""Rule versions of the pay reports, as frozen values passed to the report functions."""

from __future__ import annotations

from parcelpay.names import FACTS, FACTS_V1

from dataclasses import dataclass, field, replace
from datetime import date, datetime

# Texts and amounts that reports show or compare with.
DELIVERED_STATUS = "DRS"
DELIVERY_VENDOR = "DLV"
ANY_DOX = "Both"
ANY_PRODUCT = "All Products"
OVERFLOW_LIMIT = 10000
NO_ANSWERS = ("NO", "NA")
PARTNER_CLASSES = ("PCC - External", "Kirana", "Helix")
LATE_REMARK = "Closed after 48 hours"
NO_RATE_REMARK = "Product is not present in commercial master"
NO_SLAB_REMARK = "Weight slab not present"
SBU = "Express"
COMMERCIALS = "Commercials"
HVDI = "HVDI"


@dataclass(frozen=True)
class ModelLabels:
    """Names a report gives to the three worker models."""

    biker: str
    vehicle_with_boy: str
    vehicle_without_boy: str


# One label set per use.
SETTLEMENT_LABELS = ModelLabels(
    "BIKER COMMERCIALS", "VEHICLE WITH DELIVERY BOY COMMERCIALS", "VEHICLE WITHOUT DELIVERY BOY COMMERCIALS"
)
HVDI_LABELS = ModelLabels("BIKER COMMERCIALS", "Vehicle_with_Delivery_boy", "Vehicle_without_Delivery_boy")
HYGIENE_LABELS = ModelLabels("BIKER", "VEHICLE WITH DELIVERY BOY", "VEHICLE WITHOUT DELIVERY BOY")


@dataclass(frozen=True)
class VendorRules:
    """How vendor consignments are read, matched to slabs and settled."""

    fact_table: str
    model_column: str
    service_type: str | None
    require_rate_row: bool
    round_weight: bool
    dated_slabs: bool
    trim_cod_key: bool
    # +1 keeps the late-remittance penalty as a positive amount to subtract, -1 as a negative amount to add.
    cod_sign: int = 1
    cod_penalty: float = 50.0
    window_seconds: int = 172800
    # 'timestamp' ranks consignments that share a delivery second, 'day' those that share a delivery day.
    rank_grain: str = "timestamp"

    @staticmethod
    def v1() -> "VendorRules":
        return VendorRules(FACTS_V1, "category", None, False, False, True, False)

    @staticmethod
    def v2(cod_sign: int = 1) -> "VendorRules":
        return VendorRules(FACTS, "commercial_category", "Delivery", True, True, False, True, cod_sign)

    def with_(self, **changes) -> "VendorRules":
        return replace(self, **changes)


@dataclass(frozen=True)
class BikerRules:
    """Month guarantees of riders."""

    internal_attendance: int = 90
    external_attendance: int = 80
    productivity_low: int = 30
    productivity_high: int = 40
    guarantee: float = 15000.0
    high_guarantee: float = 18000.0


@dataclass(frozen=True)
class VehicleRules:
    """High-volume basis ('count' or 'weight') and the attendance from which a guarantee is paid."""

    hvdi_basis: str = "count"
    attendance_min: int = 80

    def __post_init__(self):
        if self.hvdi_basis not in ("count", "weight"):
            raise ValueError(f"hvdi_basis must be 'count' or 'weight', not {self.hvdi_basis!r}")


@dataclass(frozen=True)
class HygieneRules:
    """Attendance and closure incentives; `as_of` is the last day of the calendar."""

    rate: float
    models: tuple[str, ...]
    as_of: date | None = None
    start: date = date(2022, 7, 1)
    window_seconds: int = 86400

    @staticmethod
    def biker(as_of: date | None = None) -> "HygieneRules":
        return HygieneRules(500.0, (HYGIENE_LABELS.biker,), as_of)

    @staticmethod
    def vehicle(as_of: date | None = None) -> "HygieneRules":
        return HygieneRules(1000.0, (HYGIENE_LABELS.vehicle_with_boy, HYGIENE_LABELS.vehicle_without_boy), as_of)


@dataclass(frozen=True)
class SlaRules:
    """Colour scoring of partner centres; `run_ts` stamps the rows (the current time when unset)."""

    run_ts: datetime | None = None
    centre_type: str = "PCC"
    points: dict[str, int] = field(default_factory=lambda: {"Gold": 3, "Green": 2, "Red": 0})
    red_until: int = 3
    gold_from: int = 8
    vehicle_fad_red: float = 88.0
    vehicle_td_red: float = 90.0
    vehicle_red_percent: float = -5.0
