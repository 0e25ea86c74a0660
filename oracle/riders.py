"""Oracle texts of the rider, vehicle and reconciliation reports."""

from __future__ import annotations

from oracle.common import as_double, as_long, month_label, query, stamp, sundays
from parcelpay.names import FACTS, KIND

INPUTS = [
    FACTS, "biker_code_test", "biker_master", "cluster_master", "commercials", "hvdi_incentive",
    "ndv_commercial_master", "vehicle_commercials", "vehicle_hvdi",
]
WITH_BOY, WITHOUT_BOY = "VEHICLE WITH DELIVERY BOY COMMERCIALS", "VEHICLE WITHOUT DELIVERY BOY COMMERCIALS"


def model_case(biker: str, with_boy: str, without_boy: str) -> str:
    return (
        f"CASE WHEN alone AND free THEN '{biker}' WHEN NOT alone AND NOT free THEN '{with_boy}'"
        f" WHEN NOT alone AND free THEN '{without_boy}' END"
    )


def rider_step() -> tuple[str, str]:
    return "rider", f"""
        SELECT *, {model_case('BIKER COMMERCIALS', WITH_BOY, WITHOUT_BOY)} AS model,
               {model_case('BIKER', 'VEHICLE WITH DELIVERY BOY', 'VEHICLE WITHOUT DELIVERY BOY')} AS short_model,
               {model_case('BIKER COMMERCIALS', 'Vehicle_with_Delivery_boy', 'Vehicle_without_Delivery_boy')} AS hvdi_model
        FROM (SELECT *, upper(associate) IN ('NO', 'NA') AS alone, upper(attached_to) IN ('NO', 'NA') AS free
              FROM biker_master) m"""


def delivery_step() -> tuple[str, str]:
    """Delivered consignments with rider and booking centre, before any de-duplication."""
    return "delivery", f"""
        SELECT f.zzconsg_number AS con, f.zzcharge_weight AS w, f.product, f.zzdest_pincode AS pin, f.gpart,
               {stamp('f.zzdelivery_date')} AS d_at, {stamp('f.handover_datetime')} AS h_at,
               CAST({stamp('f.zzdelivery_date')} AS DATE) AS d, r.*, c.type AS cm_type, upper(c.cluster_city) AS city
        FROM {FACTS} f
        JOIN biker_code_test a ON a.reference_number = f.zzconsg_number
        JOIN rider r ON r.biker_code = a.worker_code
        JOIN cluster_master c ON c.vendor_code = f.gpart
        WHERE f.zzcons_status = 'DRS'"""


def ranked_step(with_category: bool) -> tuple[str, str]:
    category = ", pcc_master" if with_category else ""
    columns = f"pc_code, biker_code, actvtn_date, d, d_at, h_at, product, pin, model, w, con, city, cm_type{category}"
    return "ranked", f"""
        SELECT *, rank() OVER (PARTITION BY biker_code, d ORDER BY con) AS seq
        FROM (SELECT DISTINCT {columns} FROM delivery WHERE model = 'BIKER COMMERCIALS') u"""


RATED = ("rated", """
    SELECT k.*, s.guaranteed_amount_biker AS table_guarantee,
           CASE k.cm_type WHEN 'Internal' THEN s.commercials WHEN 'External' THEN p.amount END AS rate
    FROM ranked k
    LEFT JOIN commercials s ON upper(s.pc_city) = k.city AND s.pc_type = k.cm_type
                           AND k.seq BETWEEN s.no_of_consignments_from AND s.no_of_consignments_to
    LEFT JOIN (SELECT vendor_code, from_value, to_value, amount FROM ndv_commercial_master
               WHERE category IN ('PCC - External', 'Kirana', 'Helix') AND commercial_category = 'Shipment'
                 AND product_type_it = 'All Products' AND service_type = 'Delivery') p
           ON p.vendor_code = k.pc_code AND k.seq BETWEEN p.from_value AND p.to_value""")  # fmt: skip

SLABS = [
    ("slab_start", """
        SELECT pc_type, upper(pc_city) AS city, no_of_consignments_from AS lo, no_of_consignments_to AS hi, incentives,
               CASE rank() OVER (PARTITION BY pc_city, pc_type ORDER BY no_of_consignments_to)
                    WHEN 2 THEN (SELECT min(no_of_consignments_from) FROM hvdi_incentive)
                    ELSE no_of_consignments_from END AS first_paid
        FROM hvdi_incentive"""),
    ("slab_sum", """
        SELECT *, sum((hi - first_paid + 1) * incentives) OVER (PARTITION BY city, pc_type ORDER BY hi
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS so_far
        FROM slab_start"""),
    ("slab", "SELECT *, lag(so_far) OVER (PARTITION BY city, pc_type ORDER BY hi) AS before FROM slab_sum"),
]


def hvdi_step(with_category: bool) -> tuple[str, str]:
    category = ", pcc_master" if with_category else ""
    return "hvdi", f"""
        SELECT DISTINCT n.* EXCLUDE (city), s.incentives, s.first_paid, s.before,
               coalesce(s.before, 0) + (n.parcels - s.first_paid + 1) * s.incentives AS pay
        FROM (SELECT pc_code, biker_code, model, d, city, cm_type{category}, count(DISTINCT con) AS parcels
              FROM delivery WHERE model = 'BIKER COMMERCIALS' AND cm_type = 'Internal'
              GROUP BY pc_code, biker_code, model, d, city, cm_type{category}) n
        LEFT JOIN slab s ON s.city = n.city AND s.pc_type = n.cm_type AND n.parcels BETWEEN s.lo AND s.hi"""


def months(day: str = "d") -> str:
    return f"{month_label(day)} AS pay_out_month, {as_long(f'year({day})')} AS pay_out_year"


DAYS = "date_part('day', last_day(d))"
MONTH_WORK = f"({DAYS} - {sundays('(last_day(d) - CAST(' + DAYS + ' AS INTEGER))', 'last_day(d)')})"
FULL = """CASE WHEN year(actvtn_date - 1) < year(d)
               OR (year(actvtn_date - 1) = year(d) AND month(actvtn_date - 1) <> month(d)) THEN 'Yes' ELSE 'No' END"""
OWN_WORK = f"({DAYS} - day(actvtn_date) - {sundays('(actvtn_date - 1)', 'last_day(d)')} + 1)"


def availability() -> str:
    return f"""{FULL} AS whole, {as_long(MONTH_WORK)} AS month_work,
        {as_long(f"CASE {FULL} WHEN 'Yes' THEN {MONTH_WORK} ELSE {OWN_WORK} END")} AS own_work"""


def con_columns(category: str) -> str:
    return f"""pc_code, biker_code, {category}actvtn_date AS onboarding_date, d AS delivery_date,
        d_at AS delivery_datetime, h_at AS handover_datetime, {months()}, pin AS pincode, 'Express' AS sbu, model,
        w AS charge_weight, con AS consignment, {as_long('seq')} AS rank, {as_double('rate')} AS rate_per_shipment,
        'Commercials' AS {KIND}"""


BY_CATEGORY = "pcc_master AS vendor_category, "


def biker_summary_select() -> str:
    return f"""
        SELECT pc_code, vendor_category, biker_code, onboarding_date, pay_out_month, pay_out_year, model,
               {as_long('days')} AS no_of_days_delivered, {as_long('parcels')} AS total_consignments,
               {as_double('productivity')} AS productivity, {as_long('attendance')} AS attendance,
               own_work AS no_of_total_working_days, whole AS available_for_the_complete_month,
               {as_double('guarantee')} AS guaranteedamount, {as_double('earned')} AS total_commercials,
               {as_double('''CASE WHEN whole = 'Yes' AND coalesce(guarantee, 0) > earned THEN guarantee
                    WHEN whole = 'No' AND coalesce(guarantee * days / month_work, 0) > earned
                    THEN guarantee * days / month_work ELSE earned END''')} AS payable_amount,
               'Commercials' AS {KIND}, cm_type
        FROM (SELECT *, CASE WHEN cm_type = 'Internal' AND attendance >= 90 AND productivity BETWEEN 30 AND 40 THEN 15000
                             WHEN cm_type = 'Internal' AND attendance >= 90 AND productivity > 40 THEN 18000
                             WHEN cm_type = 'External' AND attendance >= 80 THEN coalesce(table_guarantee, 0)
                             ELSE 0 END AS guarantee
              FROM (SELECT *, round(parcels / days, 0) AS productivity, ceil(days * 100.0 / own_work) AS attendance
                    FROM (SELECT pc_code, vendor_category, biker_code, onboarding_date, pay_out_month, pay_out_year,
                                 model, table_guarantee, own_work, whole, month_work, cm_type,
                                 count(DISTINCT delivery_date) AS days, count(DISTINCT consignment) AS parcels,
                                 sum(rate_per_shipment) AS earned
                          FROM (SELECT DISTINCT {con_columns(BY_CATEGORY)}, {availability()}, table_guarantee, cm_type FROM rated) l
                          GROUP BY ALL) g) h) i
        UNION
        SELECT pc_code, pcc_master, biker_code, CAST(NULL AS DATE), pay_out_month, pay_out_year, model, 0, 0, 0, 0, 0,
               ' ', 0, 0, {as_double('sum(pay)')}, 'HVDI', cm_type
        FROM (SELECT *, {months()} FROM hvdi) x
        GROUP BY pc_code, pcc_master, biker_code, pay_out_month, pay_out_year, model, cm_type"""


def biker_texts() -> dict[str, str]:
    start = [rider_step(), delivery_step()]
    return {
        "biker_con_level": query(
            INPUTS, [*start, ranked_step(True), RATED], f"SELECT DISTINCT {con_columns(BY_CATEGORY)} FROM rated"
        ),
        "biker_detailed": query(
            INPUTS,
            [*start, ranked_step(False), RATED, *SLABS, hvdi_step(False)],
            f"""SELECT pc_code, biker_code, onboarding_date, delivery_date, pay_out_month, pay_out_year, sbu, model,
                {as_long('count(consignment)')} AS no_of_consignments, max(rate_per_shipment) AS rate,
                sum(rate_per_shipment) AS payables, {KIND}
                FROM (SELECT DISTINCT {con_columns('')} FROM rated) l
                GROUP BY pc_code, biker_code, onboarding_date, delivery_date, pay_out_month, pay_out_year, sbu, model,
                         {KIND}
                UNION
                SELECT pc_code, biker_code, CAST(NULL AS DATE), d, {months()}, 'Express', model, {as_long('parcels')},
                       incentives, {as_double('pay')}, 'HVDI'
                FROM hvdi""",
        ),
        "biker_summary": query(INPUTS, *biker_summary_steps()),
        "rider_hvdi": query(
            INPUTS,
            [*start, *SLABS, hvdi_step(True)],
            f"""SELECT pc_code, biker_code, pcc_master AS vendor_category, d AS delivery_date,
                {as_long('parcels')} AS no_of_consignments, incentives AS rate,
                {as_long('first_paid')} AS new_lower_limit, {as_double('before')} AS c_slab,
                {as_double('pay')} AS payables
                FROM hvdi""",
        ),
        "worker_availability": query(
            INPUTS,
            start,
            f"""SELECT biker_code, pc_code, onboarding_date, delivery_date,
                whole AS available_for_the_complete_month, month_work AS no_of_working_days_in_a_month,
                own_work AS no_of_total_working_days, {as_long('count(*)')} AS deliveries
                FROM (SELECT biker_code, pc_code, actvtn_date AS onboarding_date, d AS delivery_date, {availability()}
                      FROM delivery) x
                GROUP BY ALL""",
        ),
        "assignment_check": query(
            INPUTS,
            [rider_step()],
            f"""SELECT DISTINCT f.zzconsg_number, a.reference_number, f.gpart, c.vendor_code, r.pc_code,
                {as_long(f"month({stamp('f.zzdelivery_date')})")} AS pay_out_month, a.worker_code, r.biker_code,
                r.model, c.type
                FROM {FACTS} f
                JOIN cluster_master c ON c.vendor_code = f.gpart
                LEFT JOIN biker_code_test a ON a.reference_number = f.zzconsg_number
                LEFT JOIN rider r ON r.biker_code = a.worker_code
                WHERE f.zzcons_status = 'DRS'""",
        ),
    }


def vehicle_steps(basis: str, with_category: bool) -> list[tuple[str, str]]:
    category = ", pcc_master" if with_category else ""
    low, high, value = {
        "count": ("no_of_consignments_from", "no_of_consignments_to", "parcels"),
        "weight": ("charge_weight_from", "charge_weight_to", "CAST(kilos AS BIGINT)"),
    }[basis]
    return [
        rider_step(),
        delivery_step(),
        ("haul", "SELECT * FROM delivery WHERE model <> 'BIKER COMMERCIALS'"),
        ("haul_price", f"""
            SELECT h.*, CASE h.model WHEN '{WITH_BOY}' THEN v.guarantee_amount_per_vehicle_with_biker
                                     WHEN '{WITHOUT_BOY}' THEN v.guaranteed_amount_per_vehicle_without_biker END
                        AS guarantee,
                   CASE h.cm_type
                   WHEN 'Internal' THEN
                       CASE WHEN h.w BETWEEN v.amount_of_weight_from AND v.most THEN v.commercials
                            ELSE v.commercials + (ceil(h.w) - v.most)
                                 * (v.additional_amount_per_kg / v.additional_weight) END
                   WHEN 'External' THEN
                       CASE WHEN h.w BETWEEN p.from_value AND p.to_value THEN p.amount
                            ELSE p.amount + (ceil(h.w) - p.to_value) * (p.add_amount / p.add_value) END
                   END AS price
            FROM haul h
            LEFT JOIN (SELECT *, round(CAST(amount_of_weight_to AS DOUBLE), 0) AS most FROM vehicle_commercials) v
                   ON v.pc_code = h.pc_code AND v.amount_of_weight_from <= h.w
            LEFT JOIN (SELECT * FROM ndv_commercial_master
                       WHERE category IN ('PCC - External', 'Kirana', 'Helix') AND commercial_category = 'Weight'
                         AND product_type_it = 'All Products' AND service_type = 'Delivery') p
                   ON p.vendor_code = h.pc_code
                  AND h.w BETWEEN p.from_value AND CASE WHEN p.add_value IS NULL THEN p.to_value ELSE 10000 END"""),
        ("haul_day", f"""
            SELECT n.*, s.incentives, ceil(n.kilos) * s.incentives AS pay
            FROM (SELECT vehicle, biker_code, gpart, pc_code, hvdi_model, cm_type, d{category},
                         count(DISTINCT con) AS parcels, sum(w) AS kilos
                  FROM haul WHERE cm_type = 'Internal'
                  GROUP BY vehicle, biker_code, gpart, pc_code, hvdi_model, cm_type, d{category}) n
            LEFT JOIN vehicle_hvdi s ON s.model = n.hvdi_model AND s.pc_code = n.pc_code
                                    AND {value} BETWEEN s.{low} AND s.{high}"""),
    ]


VEHICLE_IDENTITY = "vehicle AS vehicle_number, biker_code AS vehicle_code, gpart AS vendor_code"


def vehicle_detailed(basis: str) -> str:
    return query(
        INPUTS,
        vehicle_steps(basis, False),
        f"""SELECT {VEHICLE_IDENTITY}, actvtn_date AS onboarding_date, d AS delivery_date, d_at AS delivery_datetime,
            h_at AS handover_datetime, {months()}, product, pin AS pincode, 'Express' AS sbu, model,
            con AS consignment, w AS charge_weight, {as_long('0')} AS no_of_consignment_number,
            {as_double('0')} AS incentives, {as_double('price')} AS payables, 'Commercials' AS {KIND}, cm_type
            FROM haul_price
            UNION
            SELECT vehicle, biker_code, gpart, NULL, d, NULL, NULL, {months()}, ' ', ' ', 'Express', hvdi_model, '0',
                   ceil(kilos), {as_long('parcels')}, incentives, {as_double('pay')}, 'HVDI', cm_type
            FROM haul_day""",
    )


def vehicle_summary_steps(basis: str, attendance: int) -> tuple[list[tuple[str, str]], str]:
    final = f"""
        SELECT vehicle_number, vehicle_code, vendor_code, vendor_category, cm_type, onboarding_date, pay_out_month,
               pay_out_year, model, {as_long('days')} AS no_of_days_delivered,
               {as_long('parcels')} AS no_of_consignments, {as_double('round(parcels / days, 0)')} AS productivity,
               month_work AS no_of_working_days_in_a_month, own_work AS no_of_total_working_days,
               {as_long('attendance')} AS attendance, whole AS available_for_the_complete_month,
               guarantee AS guaranteed_amount, due AS guaranteed_payables, {as_double('earned')} AS commercials_payables,
               {as_double(f"CASE WHEN attendance >= {attendance} AND coalesce(due, 0) > earned THEN due ELSE earned END")}
                   AS payable_amount, 'Commercials' AS {KIND}
        FROM (SELECT *, ceil(days * 100.0 / own_work) AS attendance,
                     CASE WHEN whole = 'No' THEN guarantee * days / month_work ELSE guarantee END AS due
              FROM (SELECT vehicle_number, vehicle_code, vendor_code, vendor_category, cm_type, onboarding_date,
                           pay_out_month, pay_out_year, model, month_work, own_work, guarantee, whole,
                           count(DISTINCT d) AS days, count(DISTINCT con) AS parcels, sum(price) AS earned
                    FROM (SELECT DISTINCT {VEHICLE_IDENTITY}, pcc_master AS vendor_category, cm_type,
                                 actvtn_date AS onboarding_date, d, d_at, h_at, {months()}, product, pin, model, con, w,
                                 {availability()}, guarantee, price
                          FROM haul_price) l
                    GROUP BY ALL) g) t
        UNION
        SELECT vehicle, biker_code, gpart, pcc_master, cm_type, NULL, pay_out_month, pay_out_year, hvdi_model, 0, 0, 0,
               0, 0, 0, ' ', 0, 0, 0, {as_double('sum(pay)')}, 'HVDI'
        FROM (SELECT *, {months()} FROM haul_day) x
        GROUP BY vehicle, biker_code, gpart, pcc_master, cm_type, pay_out_month, pay_out_year, hvdi_model"""
    return vehicle_steps(basis, True), final


def biker_summary_steps() -> tuple[list[tuple[str, str]], str]:
    """Steps and final SELECT of the rider summary, for reports built on it."""
    return [rider_step(), delivery_step(), ranked_step(True), RATED, *SLABS, hvdi_step(True)], biker_summary_select()


def vehicle_texts() -> dict[str, str]:
    return {
        "vehicle_detailed": vehicle_detailed("count"),
        "vehicle_detailed_weight_hvdi": vehicle_detailed("weight"),
        "vehicle_summary": query(INPUTS, *vehicle_summary_steps("count", 80)),
        "vehicle_summary_weight_hvdi": query(INPUTS, *vehicle_summary_steps("weight", 90)),
    }


def hygiene_text(rate: int, models: str, until: str) -> str:
    week = "CAST(week({0}) AS BIGINT)"
    place = "(week({0}) - week(last_day({0}) - INTERVAL 1 MONTH))"
    return query(
        INPUTS,
        [
            rider_step(),
            ("inhouse", f"""
                SELECT f.zzconsg_number AS con, r.pc_code, r.biker_code, r.pcc_master, r.actvtn_date, r.short_model,
                       {stamp('f.zzdelivery_date')} AS d_at, {stamp('f.handover_datetime')} AS h_at,
                       CAST({stamp('f.zzdelivery_date')} AS DATE) AS d
                FROM {FACTS} f
                JOIN biker_code_test a ON a.reference_number = f.zzconsg_number
                JOIN rider r ON r.biker_code = a.worker_code
                JOIN cluster_master c ON c.vendor_code = r.pc_code AND c.type = 'Internal'
                WHERE f.zzcons_status = 'DRS'"""),
            ("spine", f"SELECT CAST(g AS DATE) AS dt FROM generate_series(DATE '2022-07-01', DATE '{until}', INTERVAL 1 DAY) s(g)"),
            ("sunday_total", """
                SELECT month(dt) AS m, count(*) FILTER (WHERE dayofweek(dt) = 0) AS sundays FROM spine GROUP BY month(dt)"""),
            ("weekly", f"""
                SELECT pc_code, biker_code, pcc_master, short_model, month(d) AS m, {week.format('d')} AS iso_week,
                       {place.format('d')} AS place, count(*) FILTER (WHERE dayofweek(d) = 0) AS sundays_worked,
                       count(*) FILTER (WHERE dayofweek(d) > 0) AS weekdays_worked
                FROM (SELECT DISTINCT pc_code, biker_code, pcc_master, short_model, d FROM inhouse
                      WHERE short_model IN ({models}) AND {FULL} = 'Yes') w
                GROUP BY pc_code, biker_code, pcc_master, short_model, month(d), {week.format('d')}, {place.format('d')}"""),
            ("monthly", """
                SELECT pc_code, biker_code, pcc_master, short_model, m, count(*) FILTER (WHERE sundays_worked = 1) AS hits
                FROM weekly GROUP BY pc_code, biker_code, pcc_master, short_model, m"""),
            ("slow", """
                SELECT pc_code, biker_code, month(d) AS m,
                       count(*) FILTER (WHERE NOT coalesce(date_diff('second', h_at, d_at) <= 86400, false)) AS misses
                FROM (SELECT DISTINCT pc_code, biker_code, con, d, d_at, h_at FROM inhouse) q
                GROUP BY pc_code, biker_code, month(d)"""),
        ],
        f"""SELECT pc_code, biker_code, vendor_category, pay_out_month, model_type, sunday_incentive,
            consignment_closure_incentive, sunday_incentive + consignment_closure_incentive AS total_incentives
            FROM (SELECT DISTINCT y.pc_code, y.biker_code, y.pcc_master AS vendor_category,
                         {as_long('y.m')} AS pay_out_month, y.short_model AS model_type,
                         {as_double(f'round(y.hits / t.sundays * {rate}, 0)')} AS sunday_incentive,
                         {as_double(f'CASE WHEN x.misses = 0 THEN {rate} ELSE 0 END')} AS consignment_closure_incentive
                  FROM monthly y
                  LEFT JOIN sunday_total t ON t.m = y.m
                  LEFT JOIN slow x ON x.pc_code = y.pc_code AND x.biker_code = y.biker_code AND x.m = y.m) z""",
    )


def week_flags_text(until: str) -> str:
    """Rider weeks with their rank and flags; the week calendar is written out from the spine."""
    text = hygiene_text(500, "'BIKER'", until)
    head = text[: text.rindex(",\nmonthly AS (")]
    return f"""{head}
        SELECT k.pc_code, k.biker_code, k.pcc_master AS vendor_category, {as_long('k.m')} AS pay_out_month,
               {as_long('k.place')} AS week_num, k.iso_week AS year_week_number, {as_long('k.place_rank')} AS rank,
               {as_long('k.sundays_worked')} AS weekends, {as_long('k.weekdays_worked')} AS weekdays,
               {as_long("CASE WHEN k.weekdays_worked = c.workdays THEN 1 ELSE 0 END")} AS attendance_incentive,
               {as_long("CASE WHEN k.sundays_worked = 1 THEN 1 ELSE 0 END")} AS sunday_incentive
        FROM (SELECT *, rank() OVER (PARTITION BY biker_code ORDER BY place DESC) AS place_rank FROM weekly) k
        LEFT JOIN (SELECT month(dt) AS m, week(dt) AS iso_week, count(*) FILTER (WHERE dayofweek(dt) > 0) AS workdays
                   FROM spine GROUP BY month(dt), week(dt)) c ON c.m = k.m AND c.iso_week = k.iso_week"""


def texts() -> dict[str, str]:
    vehicle_models = "'VEHICLE WITH DELIVERY BOY', 'VEHICLE WITHOUT DELIVERY BOY'"
    return {
        **biker_texts(),
        **vehicle_texts(),
        "hygiene_incentive_biker": hygiene_text(500, "'BIKER'", "2023-03-31"),
        "hygiene_incentive_biker_two_years": hygiene_text(500, "'BIKER'", "2024-12-31"),
        "hygiene_incentive_vehicle": hygiene_text(1000, vehicle_models, "2023-03-31"),
        "hygiene_week_flags": week_flags_text("2023-03-31"),
    }
