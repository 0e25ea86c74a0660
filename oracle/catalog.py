"""All oracle texts by query name."""

from __future__ import annotations

from oracle import centres, riders, vendor_con

ORACLE_SQL: dict[str, str] = {**vendor_con.texts(), **riders.texts(), **centres.texts()}
# Kept up to date or read from published files, a summary is the one computed anew.
ORACLE_SQL["combined_summary_refreshed"] = ORACLE_SQL["combined_summary"]
ORACLE_SQL["vendor_summary_published"] = ORACLE_SQL["vendor_summary"]
for name in ("biker_con_level", "weight_con_level"):
    ORACLE_SQL[f"{name}_co_located"] = ORACLE_SQL[name]
