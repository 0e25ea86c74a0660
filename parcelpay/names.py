"""Names that the input tables and the reports' consumers already have."""

from __future__ import annotations

FACTS = "zpdn_table_payout"
FACTS_V1 = "ndv_payout"
KIND = "payout_type"
