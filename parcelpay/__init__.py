"""Delivery pay analytics on Spark: consignment pricing, rider and vehicle pay, hygiene, SLA and vendor totals."""

from parcelpay.rules import BikerRules, HygieneRules, SlaRules, VehicleRules, VendorRules
from parcelpay.sources.tables import ReportTables

__all__ = ["BikerRules", "HygieneRules", "ReportTables", "SlaRules", "VehicleRules", "VendorRules"]
