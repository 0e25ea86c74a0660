"""Input tables of the reports, as DDL schemas."""

from __future__ import annotations

from parcelpay.names import FACTS, FACTS_V1

_CONSIGNMENTS = """
    gpart string, zzconsg_number string, zzcharge_weight double, dox_type string, zzcons_status string,
    zzdelivery_date string, handover_datetime string, zzdest_pincode string, product string
"""
_SLABS = """
    vendor_code string, doxtype string, product_type_it string, from_value double, to_value double, amount double,
    add_value double, add_amount double, from_date date, to_date date
"""

# Table and column names that callers' tables already have.
_DDL = {
    FACTS: _CONSIGNMENTS,
    FACTS_V1: _CONSIGNMENTS,
    "ndv_vendor_master": "vendor_code string, vendor_name string, vendor_category string",
    "ndv_commercial_master": f"category string, commercial_category string, service_type string, {_SLABS}",
    "cod_remittance": "con_number string, delivery_date date, delivery_date_timestamp string, utr_datetime string",
    "ndv_kpi_table": """
        vendor_code string, product string, from_date date, to_date date, fad double, td double, scd double
    """,
    "ndv_kpi_master": """
        kpi_name string, product string, sla_from double, sla_to double, sla_percent double,
        from_date date, to_date date
    """,
    "biker_code_test": "reference_number string, worker_code string",
    "biker_master": """
        biker_code string, pc_code string, pcc_master string, vehicle string, associate string, attached_to string,
        actvtn_date date
    """,
    "cluster_master": "vendor_code string, cluster_city string, type string",
    "commercials": """
        pc_type string, pc_city string, no_of_consignments_from int, no_of_consignments_to int, commercials double,
        guaranteed_amount_biker double
    """,
    "hvdi_incentive": """
        pc_type string, pc_city string, no_of_consignments_from int, no_of_consignments_to int, incentives double
    """,
    "vehicle_commercials": """
        pc_code string, amount_of_weight_from double, amount_of_weight_to string, commercials double,
        additional_weight double, additional_amount_per_kg double, guarantee_amount_per_vehicle_with_biker double,
        guaranteed_amount_per_vehicle_without_biker double
    """,
    "vehicle_hvdi": """
        pc_code string, model string, no_of_consignments_from int, no_of_consignments_to int, charge_weight_from int,
        charge_weight_to int, incentives double
    """,
    "sla_table": """
        pc_code string, fad_ecom double, fad_nonecom double, td_ecom double, td_nonecom double, scd_ecom double,
        scd_nonecom double
    """,
    "sla_master_table": """
        colour string, category string, pc_type string, fad_min double, fad_max double, td_min double, td_max double,
        scd_min double, scd_max double, incentive double
    """,
}

# DDL texts, as `spark.read.schema` takes them.
SCHEMAS: dict[str, str] = {name: " ".join(ddl.split()) for name, ddl in _DDL.items()}
# The older slab table: `category` holds the pricing model, and there is no service type.
SCHEMAS_V1: dict[str, str] = {**SCHEMAS, "ndv_commercial_master": f"category string, {' '.join(_SLABS.split())}"}
