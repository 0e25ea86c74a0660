"""Vendor reports on hand-written rows."""

from __future__ import annotations

from datetime import date

import pytest

from parcelpay.operators.cod import cod_penalties
from parcelpay.names import FACTS, FACTS_V1
from parcelpay.plans import consignments as vendor
from parcelpay.rules import VendorRules

D = "05-02-2023 10:00:00"
YEAR = {"from_date": date(2023, 1, 1), "to_date": date(2023, 12, 31)}


def parcel(number, **changes):
    row = {
        "gpart": "V1", "zzconsg_number": number, "zzcharge_weight": 3.0, "dox_type": "dox", "zzcons_status": "DRS",
        "zzdelivery_date": D, "handover_datetime": D, "zzdest_pincode": "1", "product": "premium",
    }
    return row | changes


def slab(low, high, amount, model="Weight", dox="Dox", product="Premium", step=None, step_amount=None, **changes):
    row = {
        "vendor_code": "V1", "commercial_category": model, "service_type": "Delivery", "doxtype": dox,
        "product_type_it": product, "from_value": float(low), "to_value": float(high), "amount": float(amount),
        "add_value": step, "add_amount": step_amount, **YEAR,
    }
    return row | changes


def world(make, parcels, slabs, **more):
    base = {
        "ndv_vendor_master": [
            {"vendor_code": "V1", "vendor_name": "One", "vendor_category": "DLV"},
            {"vendor_code": "V2", "vendor_name": "Two", "vendor_category": "PUD"},
        ],
        FACTS: parcels,
        FACTS_V1: parcels,
        "ndv_commercial_master": slabs,
    }
    return make(**(base | more))


def by_number(df, *columns):
    out = {}
    for row in df.collect():
        out.setdefault(row["consignment_number"], []).append(tuple(row[c] for c in columns))
    return {k: sorted(v, key=str) for k, v in out.items()}


def test_weight_prices(make):
    parcels = [
        parcel("in"), parcel("in"),  # a copy changes nothing
        parcel("touch", zzcharge_weight=10.0),
        parcel("above", zzcharge_weight=22.5),
        parcel("both", dox_type="Parcel"),
        parcel("none", zzcharge_weight=3.0, dox_type="Parcel", product="Lite"),
        parcel("late", handover_datetime="02-02-2023 10:00:00"),
        parcel("unknown", handover_datetime="n/a"),
        parcel("pickup", gpart="V2"), parcel("returned", zzcons_status="RTO"),
    ]
    slabs = [
        slab(0, 10, 100), slab(10, 20, 200, step=5.0, step_amount=50.0), slab(0, 10, 70, dox="Both"),
        slab(0, 2, 10, dox="Both", product="Lite"),
    ]
    got = by_number(
        vendor.weight_con_level(world(make, parcels, slabs).v1_slabs()), "eligible", "commercial", "net_payable"
    )
    assert got == {
        "in": [("Yes", 100.0, 100.0)],
        "touch": [("Yes", 100.0, 100.0), ("Yes", 200.0, 200.0)],
        # 23 whole kilograms are 3 above the limit of 20, at 10 each.
        "above": [("Yes", 230.0, 230.0)],
        "both": [("Yes", 70.0, 70.0)],
        "none": [("Yes", None, 0.0)],
        "late": [("No", 0.0, 0.0)],
        "unknown": [("No", 0.0, 0.0)],
    }


def test_newer_rules_round_weight_and_ignore_other_services(make):
    parcels = [parcel("half", zzcharge_weight=10.5), parcel("light", zzcharge_weight=0.4), parcel("old")]
    slabs = [slab(0, 10.4, 100), slab(10.6, 20, 200), slab(0, 20, 999, service_type="Pickup")]
    got = by_number(
        vendor.con_level_with_logs(world(make, parcels, slabs)), "zzcharge_weight", "commercial", "pay_out_month"
    )
    month = "February "
    assert got == {"half": [(11.0, 200.0, month)], "light": [(0.4, 100.0, month)], "old": [(3.0, 100.0, month)]}


def test_dated_slabs_hold_in_the_older_rules_only(make):
    slabs = [slab(0, 10, 100, from_date=date(2023, 3, 1), to_date=date(2023, 3, 31))]
    tables = world(make, [parcel("a")], slabs)
    assert by_number(vendor.weight_con_level(tables.v1_slabs()), "commercial") == {"a": [(None,)]}
    assert by_number(vendor.con_level_with_logs(tables), "commercial") == {"a": [(100.0,)]}


def test_slabs_of_the_other_model_are_not_kept_apart(make):
    slabs = [slab(0, 10, 100), slab(1, 10, 40, model="Shipment")]
    tables = world(make, [parcel("a")], slabs).v1_slabs()
    # Both models match, and each prices with every slab of the dox type and product.
    assert by_number(vendor.weight_con_level(tables), "commercial") == {"a": [(100.0,), (40.0,)]}
    assert by_number(vendor.shipment_con_level(tables), "commercial") == {"a": [(100.0,), (40.0,)]}


def test_shipment_rank_prices_and_pays_late_rows(make):
    parcels = [parcel(f"C{i}") for i in range(3)] + [parcel("C1")]
    parcels += [parcel("L1", handover_datetime="01-02-2023 10:00:00"), parcel("Z", zzdelivery_date="05-02-2023 11:00:00")]
    slabs = [slab(1, 1, 10, model="Shipment"), slab(2, 9, 20, model="Shipment")]
    tables = world(make, parcels, slabs).v1_slabs()
    got = by_number(vendor.shipment_con_level(tables), "commercial")
    assert got == {"C0": [(10.0,)], "C1": [(20.0,)], "C2": [(20.0,)], "L1": [(10.0,)], "Z": [(10.0,)]}
    daily = by_number(vendor.shipment_con_level(tables, VendorRules.v1().with_(rank_grain="day")), "commercial")
    assert daily == {**got, "Z": [(20.0,)]}


def test_products_without_a_model_and_missing_slabs_are_explained(make):
    parcels = [parcel("a"), parcel("b", product="Other"), parcel("c", zzcharge_weight=50.0)]
    cod = [
        {"con_number": c, "delivery_date_timestamp": D, "utr_datetime": f"0{day}-02-2023 10:00:00"}
        for c in ("a", "b") for day in (6, 9)
    ]
    tables = world(make, parcels, [slab(0, 10, 100)], cod_remittance=cod)
    rows = by_number(
        vendor.con_level_with_logs(tables), "category_model", "remark", "commercial", "codpenalty", "net_payable"
    )
    assert rows == {
        "a": [("Weight", "", 100.0, -50.0, 50.0), ("Weight", "", 100.0, 0.0, 100.0)],
        "b": [(None, "Product is not present in commercial master", None, 0.0, 0.0)],
        "c": [("Weight", "Weight slab not present", None, 0.0, 0.0)],
    }


def test_vendor_without_any_rate_row_is_left_out_of_the_newer_reports(make):
    vendors = [{"vendor_code": "V9", "vendor_name": "Nine", "vendor_category": "DLV"}]
    tables = world(make, [parcel("a", gpart="V9")], [slab(0, 10, 100)], ndv_vendor_master=vendors)
    assert vendor.con_level_with_logs(tables).count() == 0


@pytest.mark.parametrize("number,key", [("C00000001001", "C00000001"), ("C00000001", "C00000001"), ("C1", "C1")])
def test_cod_number_is_trimmed_in_the_newer_rules(make, number, key):
    cod = [{"con_number": key, "delivery_date_timestamp": D, "utr_datetime": "09-02-2023 10:00:00"}]
    tables = world(make, [parcel(number)], [slab(0, 10, 100)], cod_remittance=cod)
    assert by_number(vendor.con_level_with_logs(tables), "net_payable") == {number: [(50.0,)]}
    older = by_number(vendor.weight_con_level(tables.v1_slabs()), "net_payable")
    assert older == {number: [(50.0 if number == key else 100.0,)]}


def test_cod_penalties(make):
    days = {"on": "07-02-2023 10:00:00", "over": "07-02-2023 10:00:01", "bad": "soon", "none": None}
    cod = [{"con_number": c, "delivery_date_timestamp": D, "utr_datetime": t} for c, t in days.items()]
    rows = cod_penalties(make(cod_remittance=cod)["cod_remittance"], VendorRules.v1()).collect()
    assert {r["con_number"]: r["cod_penalty"] for r in rows} == {"on": 0.0, "over": 50.0, "bad": 50.0}


def kpis(fad, td, scd):
    return [{"vendor_code": "V1", "product": "Premium", "fad": fad, "td": td, "scd": scd,
             "from_date": date(2023, 2, 1), "to_date": date(2023, 2, 28)}]


BANDS = [
    {"kpi_name": k, "product": p, "sla_from": lo, "sla_to": hi, "sla_percent": pc, **YEAR}
    for k in ("FAD", "TD", "SCD")
    for p in ("Premium",)
    for lo, hi, pc in ((0.0, 85.0, -10.0), (85.5, 100.0, 10.0))
]


def test_kpi_split_and_day_roll_up(make):
    parcels = [parcel("a"), parcel("b", handover_datetime="01-02-2023 10:00:00"), parcel("c", zzcharge_weight=10.0)]
    slabs = [slab(0, 10, 100), slab(10, 20, 200)]
    tables = world(make, parcels, slabs, ndv_kpi_table=kpis(90.0, 80.0, 85.2), ndv_kpi_master=BANDS)
    rows = by_number(
        vendor.weight_con_level(tables.v1_slabs()), "fad_incentive", "td_penalty", "scd_incentive", "net_payable"
    )
    # The third score lies between two bands: no percentage, hence neither incentive nor penalty.
    assert rows["a"] == [(10.0, -10.0, 0.0, 100.0)]
    assert rows["b"] == [(0.0, 0.0, 0.0, 0.0)]
    day = vendor.combined_detailed(tables).collect()
    assert len(day) == 1
    # 'c' lies in two slabs and counts once as delivered but twice as eligible.
    assert (day[0]["no_of_consignments_delivered"], day[0]["no_of_consignments_eligible"]) == (3, 3)
    assert (day[0]["commercials"], day[0]["incentive_percent"], day[0]["penalty_percent"]) == (400.0, 10.0, -10.0)
    month = vendor.combined_summary(tables).collect()[0]
    assert month["no_of_consignments_failed_eligibility"] == 0 and month["days_delivered"] == 1
    assert month["total_payables"] == 400.0


def test_sign_of_the_penalty_does_not_change_totals(make):
    cod = [{"con_number": "a", "delivery_date_timestamp": D, "utr_datetime": "09-02-2023 10:00:00"}]
    tables = world(make, [parcel("a"), parcel("b")], [slab(0, 10, 100)], cod_remittance=cod)
    plus = vendor.combined_summary(tables, VendorRules.v2(cod_sign=1)).collect()
    minus = vendor.combined_summary(tables, VendorRules.v2(cod_sign=-1)).collect()
    assert plus == minus and plus[0]["total_payables"] == 150.0 and plus[0]["penalty"] == -50.0
    shown = [r["cod_penalty"] for r in vendor.combined_detailed(tables).collect()]
    assert shown == [-50.0]
