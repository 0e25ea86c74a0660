"""Rider, vehicle, hygiene, service-level and vendor reports on hand-written rows."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest

from parcelpay.operators.hvdi import progressive_slabs
from parcelpay.operators.sla import centre_colours, centre_scores, vehicle_colour
from parcelpay.plans import assignment, biker, hygiene, sla, vehicle, vendor_total
from parcelpay.rules import HygieneRules, SlaRules, VehicleRules
from parcelpay.names import FACTS, KIND
from parcelpay.sources.sinks import publish_summary


def parcels(per_day, days, weight=3.0, prefix="C", late=False):
    rows = []
    for day in days:
        at = datetime.combine(day, datetime.min.time()) + timedelta(hours=10)
        handed = at - timedelta(hours=30 if late else 2)
        for i in range(per_day):
            rows.append(
                {
                    "gpart": "V1", "zzconsg_number": f"{prefix}{day:%m%d}{i:03d}", "zzcharge_weight": weight,
                    "zzcons_status": "DRS", "zzdelivery_date": f"{at:%d-%m-%Y %H:%M:%S}",
                    "handover_datetime": f"{handed:%d-%m-%Y %H:%M:%S}", "product": "P", "zzdest_pincode": "1",
                    "dox_type": "Dox",
                }
            )
    return rows


def rider(associate="NO", attached="NA", onboarded=date(2022, 1, 1), **changes):
    row = {"biker_code": "B1", "pc_code": "V1", "pcc_master": "PCC", "vehicle": "KA1", "associate": associate,
           "attached_to": attached, "actvtn_date": onboarded}
    return row | changes


def world(make, rows, riders, kind="Internal", **more):
    steps = [("commercials", "commercials", ((1, 10, 1.0), (11, 1000, 2.0))),
             ("hvdi_incentive", "incentives", ((21, 25, 100.0), (26, 30, 200.0), (31, 999, 300.0)))]
    tables = {
        FACTS: rows,
        "biker_code_test": [
            {"reference_number": number, "worker_code": "B1"} for number in sorted({r["zzconsg_number"] for r in rows})
        ],
        "biker_master": riders,
        "cluster_master": [{"vendor_code": "V1", "cluster_city": "Town", "type": kind}],
    }
    for table, pay, slabs in steps:
        tables[table] = [
            {"pc_type": kind, "pc_city": "TOWN", "no_of_consignments_from": lo, "no_of_consignments_to": hi, pay: amount,
             "guaranteed_amount_biker": 12000.0}
            for lo, hi, amount in slabs
        ]
    return make(**(tables | more))


FEBRUARY = [date(2023, 2, d) for d in range(1, 29)]


def test_rider_day(make):
    rows = parcels(27, FEBRUARY[:1])
    got = {r[KIND]: r for r in biker.biker_detailed(world(make, rows + rows, [rider()])).collect()}
    pay = got["Commercials"]
    assert (pay["no_of_consignments"], pay["rate"], pay["payables"]) == (27, 2.0, 10 * 1.0 + 17 * 2.0)
    # The second slab counts from 21, so 5 at 100 and 7 at 200 are paid for 27.
    assert (got["HVDI"]["rate"], got["HVDI"]["payables"]) == (200.0, 500.0 + 7 * 200.0)
    ranks = sorted(r["rank"] for r in biker.biker_con_level(world(make, rows + rows, [rider()])).collect())
    assert ranks == list(range(1, 28))


def commercials(report, tables):
    rows = [r for r in report(tables).collect() if r[KIND] == "Commercials"]
    assert len(rows) == 1
    return rows[0]


@pytest.mark.parametrize(
    "per_day,days,onboarded,guarantee,payable",
    [
        (30, 24, date(2022, 1, 1), 15000.0, 15000.0),
        (41, 24, date(2022, 1, 1), 18000.0, 18000.0),
        (29, 24, date(2022, 1, 1), 0.0, 24 * (10 * 1.0 + 19 * 2.0)),
        (30, 21, date(2022, 1, 1), 0.0, 21 * (10 * 1.0 + 20 * 2.0)),  # attendance 88
        (30, 12, date(2023, 2, 15), 15000.0, 7500.0),  # 12 of the 12 days since onboarding, 12 of 24 in the month
    ],
)
def test_internal_rider_month(make, per_day, days, onboarded, guarantee, payable):
    rows = parcels(per_day, FEBRUARY[-days:] if onboarded.year == 2023 else FEBRUARY[:days])
    month = commercials(biker.biker_summary, world(make, rows, [rider(onboarded=onboarded)]))
    assert (month["no_of_days_delivered"], month["total_consignments"]) == (days, per_day * days)
    assert (month["guaranteedamount"], month["payable_amount"]) == (guarantee, payable)


@pytest.mark.parametrize("days,guarantee,payable", [(19, 12000.0, 12000.0), (18, 0.0, 18 * 5 * 7.0)])
def test_external_rider_month(make, days, guarantee, payable):
    # 19 of 24 days are 79.2 percent and round up to the 80 required.
    partner = {
        "category": "PCC - External", "commercial_category": "Shipment", "service_type": "Delivery", "vendor_code": "V1",
        "product_type_it": "All Products", "from_value": 1.0, "to_value": 1000.0, "amount": 7.0,
    }
    tables = world(make, parcels(5, FEBRUARY[:days]), [rider()], "External", ndv_commercial_master=[partner])
    month = commercials(biker.biker_summary, tables)
    assert (month["guaranteedamount"], month["payable_amount"]) == (guarantee, payable)


def test_external_rider_without_a_partner_slab_stays_unknown(make):
    month = commercials(biker.biker_summary, world(make, parcels(5, FEBRUARY[:20]), [rider()], "External"))
    assert (month["guaranteedamount"], month["total_commercials"], month["payable_amount"]) == (12000.0, None, None)


def test_no_working_day_gives_unknown_attendance(make):
    rows = parcels(2, [date(2023, 4, 30)])
    month = biker.biker_summary(world(make, rows, [rider(onboarded=date(2023, 4, 30))])).collect()
    paid = [r for r in month if r[KIND] == "Commercials"][0]
    assert (paid["no_of_total_working_days"], paid["attendance"], paid["payable_amount"]) == (0, None, 2.0)


def test_progressive_slabs(make):
    rows = [("Internal", "town", 31, 40, 3.0), ("Internal", "town", 21, 30, 2.0), ("Internal", "Town", 41, 50, 5.0)]
    names = ("pc_type", "pc_city", "no_of_consignments_from", "no_of_consignments_to", "incentives")
    tables = make(hvdi_incentive=[dict(zip(names, r, strict=True)) for r in rows])
    got = {r["upper_limit"]: r for r in progressive_slabs(tables["hvdi_incentive"]).collect()}
    # 'town' and 'Town' are ranked apart and summed together.
    assert [got[u]["new_lower_limit"] for u in (30, 40, 50)] == [21, 21, 41]
    assert [got[u]["c_slab"] for u in (30, 40, 50)] == [None, 20.0, 80.0]


VEHICLE_RATES = [
    {"pc_code": "V1", "amount_of_weight_from": lo, "amount_of_weight_to": hi, "commercials": pay,
     "additional_weight": 1.0, "additional_amount_per_kg": 5.0, "guarantee_amount_per_vehicle_with_biker": 2400.0,
     "guaranteed_amount_per_vehicle_without_biker": 1200.0}
    for lo, hi, pay in ((0.0, "5", 10.0), (5.0, "100", 30.0))
]
VEHICLE_HVDI = [
    {"pc_code": "V1", "model": "Vehicle_with_Delivery_boy", "no_of_consignments_from": lo, "no_of_consignments_to": hi,
     "charge_weight_from": wlo, "charge_weight_to": whi, "incentives": pay}
    for lo, hi, wlo, whi, pay in ((1, 2, 0, 4, 1.0), (3, 99, 5, 999, 2.0))
]


def vehicles(make, rows, riders, **more):
    return world(make, rows, riders, vehicle_commercials=VEHICLE_RATES, vehicle_hvdi=VEHICLE_HVDI, **more)


def test_vehicle_pays_every_lower_slab_and_counts_copies_in_weight(make):
    rows = parcels(2, FEBRUARY[:1], weight=7.5)
    tables = vehicles(make, rows + rows[:1], [rider("YES", "YES")])
    got = vehicle.vehicle_detailed(tables).collect()
    paid = sorted((r["consignment"], r["payables"]) for r in got if r[KIND] == "Commercials")
    # 8 whole kilograms are 3 above the first slab; the second slab holds the weight.
    assert paid == [("C0201000", 25.0), ("C0201000", 30.0), ("C0201001", 25.0), ("C0201001", 30.0)]
    day = [r for r in got if r[KIND] == "HVDI"][0]
    assert (day["no_of_consignment_number"], day["charge_weight"], day["incentives"], day["payables"]) == (2, 23.0, 1.0, 23.0)
    by_weight = [r for r in vehicle.vehicle_detailed_weight_hvdi(tables).collect() if r[KIND] == "HVDI"][0]
    assert (by_weight["incentives"], by_weight["payables"]) == (2.0, 46.0)


@pytest.mark.parametrize("days,attendance,count_pay,weight_pay", [(20, 84, 2400.0, 400.0), (22, 92, 2400.0, 2400.0)])
def test_vehicle_guarantee_threshold(make, days, attendance, count_pay, weight_pay):
    rows = parcels(2, FEBRUARY[:days])
    tables = vehicles(make, rows, [rider("YES", "YES")])
    first = commercials(vehicle.vehicle_summary, tables)
    assert (first["attendance"], first["commercials_payables"], first["payable_amount"]) == (
        attendance, 2 * days * 10.0, count_pay
    )
    assert commercials(vehicle.vehicle_summary_weight_hvdi, tables)["payable_amount"] == weight_pay


def test_unknown_model_is_neither_rider_nor_vehicle(make):
    tables = vehicles(make, parcels(2, FEBRUARY[:1]), [rider("NO", "YES")])
    assert biker.biker_con_level(tables).count() == 0
    assert vehicle.vehicle_detailed(tables).count() == 0
    with pytest.raises(ValueError, match="hvdi_basis"):
        VehicleRules(hvdi_basis="volume")


def test_assignment_check_keeps_unassigned(make):
    rows = parcels(2, FEBRUARY[:1])
    tables = world(make, rows, [rider()]).with_frames(
        biker_code_test=make(
            biker_code_test=[{"reference_number": rows[0]["zzconsg_number"], "worker_code": "B7"}]
        )["biker_code_test"]
    )
    got = {(r["zzconsg_number"], r["reference_number"], r["worker_code"], r["biker_code"]) for r in
           assignment.assignment_check(tables).collect()}
    assert got == {("C0201000", "C0201000", "B7", None), ("C0201001", None, None, None)}


@pytest.mark.parametrize(
    "late,as_of,sunday,closure",
    [
        (False, date(2023, 3, 31), 500.0, 500.0),
        (True, date(2023, 3, 31), 500.0, 0.0),
        # The calendar then has eight February Sundays.
        (False, date(2024, 12, 31), 250.0, 500.0),
    ],
)
def test_hygiene(make, late, as_of, sunday, closure):
    tables = world(make, parcels(1, FEBRUARY, late=late), [rider()])
    got = hygiene.hygiene_incentive_biker(tables, HygieneRules.biker(as_of)).collect()
    assert len(got) == 1
    assert (got[0]["sunday_incentive"], got[0]["consignment_closure_incentive"]) == (sunday, closure)
    assert got[0]["total_incentives"] == sunday + closure
    assert hygiene.hygiene_incentive_vehicle(tables, HygieneRules.vehicle(as_of)).count() == 0


def test_hygiene_needs_the_whole_month(make):
    tables = world(make, parcels(1, FEBRUARY), [rider(onboarded=date(2023, 2, 10))])
    assert hygiene.hygiene_incentive_biker(tables, HygieneRules.biker(date(2023, 3, 31))).count() == 0


BANDS = [
    {"colour": colour, "category": category, "pc_type": "PCC", "incentive": percent,
     **{f"{m}_{end}": v for m in ("fad", "td", "scd") for end, v in (("min", lo), ("max", hi))}}
    for category in ("E-commerce Shipments", "Combined")
    for colour, lo, hi, percent in (("Red", 0.0, 80.0, -5.0), ("Green", 81.0, 90.0, 0.0), ("Gold", 91.0, 100.0, 5.0))
]


@pytest.mark.parametrize(
    "fad,td,scd,final",
    [
        (95.0, 70.0, 70.0, "Red"),  # 3 points
        (85.0, 85.0, 70.0, "Green"),  # 4
        (95.0, 85.0, 85.0, "Green"),  # 7
        (95.0, 95.0, 85.0, "Gold"),  # 8
        (80.5, 95.0, 95.0, None),  # outside every band
    ],
)
def test_final_colour(make, fad, td, scd, final):
    tables = make(
        sla_table=[{"pc_code": "V1", "fad_ecom": fad, "td_ecom": td, "scd_ecom": scd}],
        cluster_master=[{"vendor_code": "V1", "type": "Internal"}],
        sla_master_table=BANDS,
    )
    got = centre_colours(centre_scores(tables), tables["sla_master_table"], SlaRules()).collect()
    assert [r["sla_final_colour"] for r in got] == [final]


def test_scores_and_vehicle_colour(make):
    tables = make(
        sla_table=[
            {"pc_code": "mean", "fad_ecom": 88.0, "fad_nonecom": 88.0, "td_ecom": 90.0, "td_nonecom": 90.0},
            {"pc_code": "half", "fad_ecom": 80.0, "td_ecom": 80.0, "td_nonecom": 80.0},
            {"pc_code": "above", "fad_nonecom": 88.1, "td_nonecom": 50.0},
            {"pc_code": "blank"},
            {"pc_code": "partner", "td_ecom": 1.0},
        ],
        cluster_master=[
            {"vendor_code": c, "type": "External" if c == "partner" else "Internal"}
            for c in ("mean", "half", "above", "blank", "partner")
        ],
    )
    got = {r["pc_code"]: (r["category"], r["sla_colour"]) for r in vehicle_colour(centre_scores(tables), SlaRules()).collect()}
    assert got == {
        "mean": ("Combined", "RED"),
        "half": ("Combined", "GREEN"),  # one side's score is missing, so the mean is unknown
        "above": ("Non-Ecommerce Shipments", "GREEN"),
        "blank": (None, "GREEN"),
    }


SUMMARY = f"pc_code string, vendor_code string, model string, pay_out_month string, payable_amount double, {KIND} string"


def test_vendor_total(spark, make, tmp_path):
    riders = [("V1", None, "a", "January  ", 100.0, "Commercials"), ("V1", None, "b", "January  ", 100.0, "Commercials"),
              ("V1", None, "a", "February ", 60.0, "HVDI"), ("V3", None, "a", "January  ", 9.0, "HVDI")]
    cars = [(None, "V1", "c", "January  ", 40.0, "Commercials"), (None, "V2", "c", "January  ", 7.0, "Commercials")]
    tables = make(
        sla_table=[{"pc_code": "V1", "fad_ecom": 95.0, "td_ecom": 95.0, "scd_ecom": 95.0}],
        cluster_master=[{"vendor_code": "V1", "type": "Internal"}],
        sla_master_table=BANDS,
    ).with_frames(
        **{sla.BIKER_SUMMARY: spark.createDataFrame(riders, SUMMARY), sla.VEHICLE_SUMMARY: spark.createDataFrame(cars, SUMMARY)}
    )

    def totals(**options):
        return {tuple(r) for r in vendor_total.vendor_summary(tables, **options).collect()}

    # Two models of V1 earned 100 each and count once; V3 has no commercials and does not show.
    assert totals() == {("V1", 140.0, 60.0, 10.0, 210.0), ("V2", 7.0, 0.0, 0.0, 7.0)}
    assert totals(merge_equal_models=False) == {("V1", 240.0, 60.0, 10.0, 310.0), ("V2", 7.0, 0.0, 0.0, 7.0)}
    paid = sla.sla_detailed(tables, SlaRules(datetime(2023, 4, 1))).collect()
    assert [(r["commercial_amount"], r["sla_paid"], r[KIND], r["total_payables"]) for r in paid] == [
        (200.0, 10.0, "INCENTIVE", 210.0)
    ]
    assert sla.sla_vehicle(tables).count() == 1


def test_published_summary_reads_back(spark, make, tmp_path):
    months = biker.biker_summary(world(make, parcels(3, FEBRUARY[:3]), [rider()]))
    publish_summary(months, f"{tmp_path}/months")
    back = spark.read.parquet(f"{tmp_path}/months").select(*months.columns)
    key = lambda r: str(sorted(r.asDict().items()))
    got = sorted(({**r.asDict(), "pay_out_year": int(r["pay_out_year"])} for r in back.collect()), key=lambda d: str(d))
    assert got == sorted((r.asDict() for r in sorted(months.collect(), key=key)), key=lambda d: str(d))
