"""Oracle texts of the service-level and vendor reports."""

from __future__ import annotations

from oracle import riders
from oracle.common import as_double, query
from parcelpay.names import KIND

INPUTS = [*riders.INPUTS, "sla_table", "sla_master_table"]
RUN = "TIMESTAMP '2023-04-01 06:00:00' AS \"timestamp\""
METRICS = ("fad", "td", "scd")


def biker_steps() -> list[tuple[str, str]]:
    steps, final = riders.biker_summary_steps()
    return [*steps, ("biker_months", final)]


def vehicle_steps() -> list[tuple[str, str]]:
    steps, final = riders.vehicle_summary_steps("count", 80)
    return [*steps, ("vehicle_months", final)]


def score_steps() -> list[tuple[str, str]]:
    sides = ", ".join(
        f"CASE WHEN td_nonecom IS NULL THEN {m}_ecom WHEN td_ecom IS NULL THEN {m}_nonecom"
        f" ELSE ({m}_ecom + {m}_nonecom) / 2.0 END AS {m}"
        for m in METRICS
    )
    return [
        ("score", f"""
            SELECT DISTINCT pc_code, {sides},
                   CASE WHEN td_nonecom IS NULL THEN 'E-commerce Shipments'
                        WHEN td_ecom IS NULL THEN 'Non-Ecommerce Shipments' ELSE 'Combined' END AS category
            FROM sla_table JOIN cluster_master c ON c.vendor_code = pc_code AND c.type = 'Internal'
            WHERE td_ecom IS NOT NULL OR td_nonecom IS NOT NULL
            UNION
            SELECT DISTINCT pc_code, NULL, NULL, NULL, NULL
            FROM sla_table JOIN cluster_master c ON c.vendor_code = pc_code AND c.type = 'Internal'
            WHERE td_ecom IS NULL AND td_nonecom IS NULL"""),
    ]


def colour_steps() -> list[tuple[str, str]]:
    joins = " ".join(
        f"LEFT JOIN (SELECT * FROM sla_master_table WHERE pc_type = 'PCC') {m}b"
        f" ON {m}b.category = s.category AND s.{m} BETWEEN {m}b.{m}_min AND {m}b.{m}_max"
        for m in METRICS
    )
    names = ", ".join(f"{m}b.colour AS {m}_colour" for m in METRICS)
    points = " + ".join(f"CASE {m}_colour WHEN 'Gold' THEN 3 WHEN 'Green' THEN 2 WHEN 'Red' THEN 0 END" for m in METRICS)
    return [
        *score_steps(),
        ("coloured", f"SELECT s.*, {names} FROM score s {joins}"),
        ("judged", f"""
            SELECT *, CASE WHEN points <= 3 THEN 'Red' WHEN points <= 7 THEN 'Green' WHEN points >= 8 THEN 'Gold' END
                   AS final_colour
            FROM (SELECT *, {points} AS points FROM coloured) p"""),
    ]


PAID = [
    ("earned", f"""
        SELECT pc_code, pay_out_month, sum(payable_amount) AS amount FROM biker_months
        WHERE {KIND} = 'Commercials' GROUP BY pc_code, pay_out_month"""),
    ("centre_pay", """
        SELECT j.*, e.amount, b.incentive AS percent, e.amount * b.incentive / 100.0 AS paid
        FROM judged j
        LEFT JOIN (SELECT DISTINCT colour, incentive FROM sla_master_table) b ON b.colour = j.final_colour
        LEFT JOIN earned e ON e.pc_code = j.pc_code"""),
]
PAY = f"""{as_double('amount')} AS commercial_amount, {as_double('percent')} AS payables_percentage,
    {as_double('paid')} AS sla_paid,
    CASE WHEN percent > 0 THEN 'INCENTIVE' WHEN percent < 0 THEN 'PENALTY' END AS {KIND}"""
TOTAL = f"{as_double('amount + paid')} AS total_payables"


def merge(*lists: list[tuple[str, str]]) -> list[tuple[str, str]]:
    steps: dict[str, str] = {}
    for items in lists:
        steps.update(dict(items))
    return list(steps.items())


def vehicle_sla(total: bool) -> str:
    tail = f", {TOTAL}" if total else ""
    return query(
        INPUTS,
        [
            *vehicle_steps(),
            *score_steps(),
            ("lane", f"""
                SELECT *, percent * amount / 100.0 AS paid
                FROM (SELECT s.pc_code, e.amount, CASE WHEN fad <= 88 AND td <= 90 THEN 'RED' ELSE 'GREEN' END AS sla_colour,
                             CASE WHEN fad <= 88 AND td <= 90 THEN -5 ELSE 0 END AS percent
                      FROM score s
                      JOIN (SELECT vendor_code, pay_out_month, sum(payable_amount) AS amount FROM vehicle_months
                            WHERE {KIND} = 'Commercials' GROUP BY vendor_code, pay_out_month) e
                        ON e.vendor_code = s.pc_code) q"""),
        ],
        f"SELECT DISTINCT pc_code, {RUN}, sla_colour, {PAY}{tail} FROM lane",
    )


def model_sums(kind: str) -> str:
    return f"""
        SELECT pc_code, sum(amount) AS amount
        FROM (SELECT vendor_code AS pc_code, sum(payable_amount) AS amount FROM vehicle_months
              WHERE {KIND} = '{kind}' GROUP BY vendor_code, model
              UNION
              SELECT pc_code, sum(payable_amount) FROM biker_months
              WHERE {KIND} = '{kind}' GROUP BY pc_code, model) m
        GROUP BY pc_code"""


def texts() -> dict[str, str]:
    rider_pay = [*biker_steps(), *colour_steps(), *PAID]
    colours = ", ".join(f"{m}_colour" for m in METRICS)
    return {
        "sla_detailed": query(
            INPUTS,
            rider_pay,
            f"""SELECT DISTINCT pc_code, {RUN}, {colours}, category, final_colour AS sla_final_colour, {PAY}, {TOTAL}
                FROM centre_pay""",
        ),
        "sla_summary": query(
            INPUTS,
            rider_pay,
            f"""SELECT DISTINCT pc_code, {RUN}, category, final_colour AS sla_final_colour, {PAY}, {TOTAL}
                FROM centre_pay""",
        ),
        "sla_vehicle_total": vehicle_sla(True),
        "sla_vehicle": vehicle_sla(False),
        "vendor_summary": query(
            INPUTS,
            [
                *merge(biker_steps(), vehicle_steps(), colour_steps(), PAID),
                ("base_pay", model_sums("Commercials")),
                ("volume_pay", model_sums("HVDI")),
            ],
            f"""SELECT c.pc_code, {as_double('c.amount')} AS commercial_payables,
                {as_double('coalesce(v.amount, 0)')} AS hvdi_payables,
                {as_double('coalesce(s.paid, 0)')} AS incentive_penalty_payables,
                {as_double('c.amount + coalesce(v.amount, 0) + coalesce(s.paid, 0)')} AS total_payables
                FROM base_pay c
                LEFT JOIN volume_pay v ON v.pc_code = c.pc_code
                LEFT JOIN centre_pay s ON s.pc_code = c.pc_code""",
        ),
        "sla_colours": query(
            INPUTS,
            colour_steps(),
            f"""SELECT pc_code, category, {', '.join(as_double(m) + ' AS ' + m for m in METRICS)}, {colours},
                final_colour AS sla_final_colour FROM judged""",
        ),
    }
