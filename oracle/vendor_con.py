"""Oracle texts of the vendor consignment reports."""

from __future__ import annotations

from oracle.common import as_double, as_long, month_label, query, stamp
from parcelpay.names import FACTS, FACTS_V1

INPUTS = [
    FACTS, FACTS_V1, "ndv_vendor_master", "ndv_commercial_master", "cod_remittance",
    "ndv_kpi_table", "ndv_kpi_master",
]
KPIS = ("fad", "td", "scd")
MONEY = "commercial, fad, fad_incentive, fad_penalty, td, td_incentive, td_penalty, scd, scd_incentive, scd_penalty, codpenalty, net_payable"


def base_steps(version: int) -> list[tuple[str, str]]:
    fact = FACTS_V1 if version == 1 else FACTS
    weight = "zzcharge_weight"
    rated = ""
    if version == 2:
        weight = "CASE WHEN zzcharge_weight < 1 THEN zzcharge_weight ELSE round(zzcharge_weight, 0) END"
        rated = "WHERE p.v IN (SELECT vendor_code FROM ndv_commercial_master)"
    return [
        ("rate", """
            SELECT vendor_code AS v, upper(product_type_it) AS pr, upper(doxtype) AS dx, doxtype = 'Both' AS is_both,
                   commercial_category AS model, from_value AS lo, to_value AS hi,
                   CASE WHEN add_value IS NULL THEN to_value ELSE 10000 END AS reach,
                   amount, add_value, add_amount, from_date, to_date
            FROM ndv_commercial_master WHERE service_type = 'Delivery'"""),
        ("picked", f"""
            SELECT gpart AS v, zzconsg_number AS con, {weight} AS w, dox_type, upper(dox_type) AS dx, product,
                   upper(product) AS pr, zzdest_pincode AS pin, {stamp('zzdelivery_date')} AS d_at,
                   {stamp('handover_datetime')} AS h_at
            FROM {fact} WHERE zzcons_status = 'DRS'"""),
        ("base", f"""
            SELECT DISTINCT p.*, CAST(p.d_at AS DATE) AS d_day, m.vendor_name,
                   coalesce(one.model, two.model) AS model,
                   CASE WHEN date_diff('second', p.h_at, p.d_at) <= 172800 THEN 'Yes' ELSE 'No' END AS eligible
            FROM picked p
            JOIN ndv_vendor_master m ON m.vendor_code = p.v AND m.vendor_category = 'DLV'
            LEFT JOIN (SELECT DISTINCT v, pr, dx, model FROM rate) one
                   ON one.v = p.v AND one.pr = p.pr AND one.dx = p.dx
            LEFT JOIN (SELECT DISTINCT v, pr, model FROM rate WHERE is_both) two ON two.v = p.v AND two.pr = p.pr
            {rated}"""),
    ]


def kpi_step() -> tuple[str, str]:
    joins = " ".join(
        f"LEFT JOIN ndv_kpi_master {k}m ON {k}m.kpi_name = '{k.upper()}' AND {k}m.product = t.product"
        f" AND t.{k} BETWEEN {k}m.sla_from AND {k}m.sla_to"
        f" AND {k}m.from_date <= t.from_date AND t.to_date <= {k}m.to_date"
        for k in KPIS
    )
    percents = ", ".join(f"{k}m.sla_percent AS {k}_percent" for k in KPIS)
    return "kpi", f"SELECT t.*, {percents} FROM ndv_kpi_table t {joins}"


def cod_step(late: int) -> tuple[str, str]:
    return "cod", f"""
        SELECT con_number, time_utr_date,
               CASE WHEN date_diff('second', sent, time_utr_date) <= 172800 THEN 0 ELSE {late} END AS penalty
        FROM (SELECT DISTINCT con_number, {stamp('delivery_date_timestamp')} AS sent,
                     {stamp('utr_datetime')} AS time_utr_date
              FROM cod_remittance WHERE utr_datetime IS NOT NULL) r"""


def _price(s: str) -> str:
    return (
        f"CASE WHEN b.w <= {s}.hi THEN {s}.amount"
        f" ELSE {s}.amount + (ceil(b.w) - {s}.hi) * ({s}.add_amount / {s}.add_value) END"
    )


def priced_step(version: int, model: str) -> tuple[str, str]:
    """Base rows of one pricing model with their amounts."""

    def slab(s: str, value: str, limit: str) -> str:
        dates = f" AND b.d_day BETWEEN {s}.from_date AND {s}.to_date" if version == 1 else ""
        return f"{s}.v = b.v AND {s}.pr = b.pr AND {value} BETWEEN {s}.lo AND {s}.{limit}{dates}"

    if model == "Weight":
        return "priced_weight", f"""
            SELECT b.*, round(CASE WHEN b.eligible = 'Yes' THEN
                       CASE WHEN x.amount IS NULL THEN {_price('y')} ELSE {_price('x')} END
                   ELSE 0 END, 2) AS commercial
            FROM base b
            LEFT JOIN rate x ON x.dx = b.dx AND {slab('x', 'b.w', 'reach')}
            LEFT JOIN rate y ON y.is_both AND {slab('y', 'b.w', 'reach')}
            WHERE b.model = 'Weight'"""
    return "priced_shipment", f"""
        SELECT b.* EXCLUDE (seq), x.amount AS commercial
        FROM (SELECT *, rank() OVER (PARTITION BY v, d_at, product, eligible ORDER BY con) AS seq
              FROM base WHERE model = 'Shipment') b
        LEFT JOIN rate x ON x.dx = b.dx AND {slab('x', 'b.seq', 'hi')}"""


def settled_step(version: int, model: str, cod_adds: bool) -> tuple[str, str]:
    key = "p.con" if version == 1 else "CASE WHEN length(p.con) = 12 THEN left(p.con, 9) ELSE p.con END"
    parts = ", ".join(
        f"CASE WHEN pays THEN greatest(0, {k}_percent * commercial) / 100.0 ELSE 0 END AS {k}_incentive,"
        f" CASE WHEN pays THEN least(0, {k}_percent * commercial) / 100.0 ELSE 0 END AS {k}_penalty"
        for k in KPIS
    )
    sign = "+" if cod_adds else "-"
    name = model.lower()
    return f"settled_{name}", f"""
        SELECT *, coalesce(commercial, 0) + fad_incentive + td_incentive + scd_incentive
                  + fad_penalty + td_penalty + scd_penalty {sign} coalesce(codpenalty, 0) AS net_payable
        FROM (SELECT *, {parts}, CASE WHEN pays THEN penalty ELSE 0 END AS codpenalty
              FROM (SELECT p.*, k.fad, k.td, k.scd, k.fad_percent, k.td_percent, k.scd_percent, c.time_utr_date,
                           c.penalty, p.eligible = 'Yes' AND coalesce(p.commercial > 0, false) AS pays
                    FROM priced_{name} p
                    LEFT JOIN cod c ON c.con_number = {key}
                    LEFT JOIN kpi k ON k.vendor_code = p.v AND upper(k.product) = p.pr
                                   AND p.d_day BETWEEN k.from_date AND k.to_date) i) j"""


def money() -> str:
    return ", ".join(f"{as_double(c.strip())} AS {c.strip()}" for c in MONEY.split(","))


def remark() -> str:
    return "CASE WHEN eligible = 'Yes' THEN '' ELSE 'Closed after 48 hours' END"


def steps_for(version: int, models: tuple[str, ...], cod_adds: bool) -> list[tuple[str, str]]:
    steps = [*base_steps(version), kpi_step(), cod_step(-50 if cod_adds else 50)]
    for model in models:
        steps += [priced_step(version, model), settled_step(version, model, cod_adds)]
    return steps


def con_select(model: str, delivered: str, handed_over: str) -> str:
    return f"""SELECT DISTINCT v AS vendor_code, vendor_name, con AS consignment_number, w AS zzcharge_weight, dox_type,
        model AS category_model, d_at AS {delivered}, h_at AS {handed_over}, {as_long('month(d_day)')} AS pay_out_month,
        pin AS pincode, product, eligible, {remark()} AS remarks, {money()}
        FROM settled_{model.lower()}"""


def logs_select() -> str:
    head = f"""v AS vendor_code, vendor_name, con AS consignment_number, w AS zzcharge_weight, dox_type,
        model AS category_model, d_at AS delivery_date, h_at AS handover_date"""
    tail = f"""{month_label('d_day')} AS pay_out_month, {as_long('year(d_day)')} AS pay_out_year, pin AS pincode,
        product, eligible"""
    priced = " UNION ".join(
        f"""SELECT {head}, time_utr_date, {tail},
            CASE WHEN commercial IS NULL THEN 'Weight slab not present' ELSE {remark()} END AS remark, {money()}
            FROM settled_{m}"""
        for m in ("weight", "shipment")
    )
    zeros = ", ".join(
        f"{as_double('NULL' if c.strip() == 'commercial' else '0')} AS {c.strip()}" for c in MONEY.split(",")
    )
    return f"""{priced} UNION
        SELECT {head}, CAST(NULL AS TIMESTAMP) AS time_utr_date, {tail},
               'Product is not present in commercial master' AS remark, {zeros}
        FROM base WHERE model IS NULL"""


def day_select(version: int, model: str) -> str:
    month = (
        f"{as_long('month(d_day)')} AS pay_out_month"
        if version == 1
        else f"{month_label('d_day')} AS pay_out_month, {as_long('year(d_day)')} AS pay_out_year"
    )
    months = "pay_out_month" if version == 1 else "pay_out_month, pay_out_year"
    up = " + ".join(f"greatest(0, {k}_percent)" for k in KPIS)
    down = " + ".join(f"least(0, {k}_percent)" for k in KPIS)
    return f"""SELECT DISTINCT v AS vendor_code, vendor_name,
        {as_long('count(DISTINCT con)')} AS no_of_consignments_delivered,
        {as_long("sum(CASE WHEN eligible = 'Yes' THEN 1 ELSE 0 END)")} AS no_of_consignments_eligible,
        model AS category_model, d_day AS delivery_date, {months}, product,
        {as_double('sum(commercial)')} AS commercials, {as_double(up)} AS incentive_percent,
        {as_double('sum(fad_incentive + td_incentive + scd_incentive)')} AS incentive,
        {as_double(down)} AS penalty_percent,
        {as_double('sum(fad_penalty + td_penalty + scd_penalty)')} AS penalty,
        {as_double('sum(coalesce(codpenalty, 0))')} AS cod_penalty, {as_double('sum(net_payable)')} AS net_payables
        FROM (SELECT DISTINCT v, vendor_name, con, w, dox_type, model, d_day, {month}, pin, product, eligible,
                     fad_percent, td_percent, scd_percent, {MONEY}
              FROM settled_{model.lower()}) l
        GROUP BY v, vendor_name, model, d_day, {months}, product, fad_percent, td_percent, scd_percent"""


BOTH = ("Weight", "Shipment")


def texts() -> dict[str, str]:
    weight = con_select("Weight", "delivery_date", "handover_date")
    shipment = con_select("Shipment", "delivery_datetime", "handover_datetime")
    v2_days = f"{day_select(2, 'Weight')} UNION {day_select(2, 'Shipment')}"
    return {
        "weight_con_level": query(INPUTS, steps_for(1, ("Weight",), False), weight),
        "shipment_con_level": query(INPUTS, steps_for(1, ("Shipment",), False), shipment),
        "combined_con_level": query(INPUTS, steps_for(1, BOTH, False), f"{weight} UNION {shipment}"),
        "con_level_with_logs": query(INPUTS, steps_for(2, BOTH, True), logs_select()),
        "weight_detailed": query(INPUTS, steps_for(1, ("Weight",), False), day_select(1, "Weight")),
        "shipment_detailed": query(INPUTS, steps_for(1, ("Shipment",), False), day_select(1, "Shipment")),
        "combined_detailed": query(INPUTS, steps_for(2, BOTH, True), v2_days),
        "combined_summary": query(
            INPUTS,
            [*steps_for(2, BOTH, False), ("days", v2_days)],
            f"""SELECT vendor_code, vendor_name,
                {as_long('sum(no_of_consignments_delivered)')} AS no_of_consignments_delivered,
                {as_long('sum(no_of_consignments_eligible)')} AS no_of_consignments_eligible,
                {as_long('sum(no_of_consignments_delivered) - sum(no_of_consignments_eligible)')}
                    AS no_of_consignments_failed_eligibility,
                {as_long('count(DISTINCT delivery_date)')} AS days_delivered, pay_out_month, pay_out_year,
                {as_double('sum(commercials)')} AS commercial_payable, {as_double('sum(incentive)')} AS incentives,
                {as_double('sum(penalty - coalesce(cod_penalty, 0))')} AS penalty,
                {as_double('sum(net_payables)')} AS total_payables
                FROM days GROUP BY vendor_code, vendor_name, pay_out_month, pay_out_year""",
        ),
        "pricing_models": query(
            INPUTS,
            base_steps(2),
            """SELECT v AS vendor_code, dox_type, product, model AS category_model,
               CAST(count(DISTINCT con) AS BIGINT) AS consignments
               FROM base GROUP BY v, dox_type, product, model""",
        ),
        "weight_slab_prices": query(
            INPUTS,
            [*base_steps(2), priced_step(2, "Weight")],
            """SELECT v AS vendor_code, dox_type, product, w AS zzcharge_weight, eligible,
               CAST(commercial AS DOUBLE) AS commercial, CAST(count(*) AS BIGINT) AS slab_rows
               FROM priced_weight GROUP BY ALL""",
        ),
        "shipment_ranks": query(
            INPUTS,
            base_steps(2),
            """SELECT v AS vendor_code, con AS consignment_number, d_at AS delivered_at, product, eligible,
               CAST(rank() OVER (PARTITION BY v, d_at, product, eligible ORDER BY con) AS BIGINT) AS rank
               FROM base WHERE model = 'Shipment'""",
        ),
        "shipment_ranks_by_day": query(
            INPUTS,
            base_steps(2),
            """SELECT v AS vendor_code, con AS consignment_number, d_at AS delivered_at, product, eligible,
               CAST(rank() OVER (PARTITION BY v, d_day, product, eligible ORDER BY con) AS BIGINT) AS rank
               FROM base WHERE model = 'Shipment'""",
        ),
        "cod_penalties": query(
            INPUTS,
            [cod_step(50)],
            "SELECT DISTINCT con_number, time_utr_date, CAST(penalty AS DOUBLE) AS cod_penalty FROM cod",
        ),
        "kpi_percents": query(
            INPUTS,
            [kpi_step()],
            """SELECT vendor_code, product, from_date, to_date, fad, td, scd, fad_percent, td_percent, scd_percent
               FROM kpi""",
        ),
    }
