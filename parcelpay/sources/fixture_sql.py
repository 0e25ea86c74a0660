"""Input tables derived from a star schema, as SQL that Spark and DuckDB both read.

The texts use shared functions only; the few that differ come from a dialect. Every customer is a rider and every
supplier a partner centre. A quarter of the consignments go to the rider of the order, the rest to eight busy riders, so
that keys are as uneven as in practice.
"""

from __future__ import annotations

from parcelpay.names import FACTS, FACTS_V1

from collections.abc import Sequence
from dataclasses import dataclass

STAR_TABLES = ("nation", "customer", "supplier", "orders", "lineitem")


@dataclass(frozen=True)
class Dialect:
    """Spellings that differ between the two engines."""

    stamp: str  # date-time text of {0}
    add_hours: str  # {0} plus {1} hours
    add_days: str  # date {0} plus {1} days
    base36: str  # whole number {0} in base 36, upper case
    dealt: str  # table {0}, its rows dealt over tasks by column {1}
    spark: bool

    def stamp_of(self, expr: str) -> str:
        return self.stamp.format(expr)

    def hours(self, expr: str, n: str) -> str:
        return self.add_hours.format(expr, n)

    def days(self, expr: str, n: str) -> str:
        return self.add_days.format(expr, n)

    def per_row(self, columns: Sequence[str], rows: Sequence[str]) -> str:
        """A constant list of rows, repeated for each row of the table named before it."""
        names = ", ".join(columns)
        if self.spark:
            return f"LATERAL VIEW inline(array({', '.join(f'struct({r})' for r in rows)})) r AS {names}"
        return f"CROSS JOIN (VALUES {', '.join(f'({r})' for r in rows)}) AS r({names})"


SPARK = Dialect("date_format({0}, 'dd-MM-yyyy HH:mm:ss')", "timestampadd(HOUR, {1}, {0})", "date_add({0}, {1})", "conv(CAST({0} AS STRING), 10, 36)", "(SELECT * FROM {0} DISTRIBUTE BY {1})", True)
DUCKDB = Dialect("strftime({0}, '%d-%m-%Y %H:%M:%S')", "({0} + to_hours({1}))", "({0} + CAST({1} AS INTEGER))", "to_base({0}, 36)", "{0}", False)

# Products of the priorities 1 to 5, in the spelling of the facts and of the masters.
FACT_PRODUCTS = ("Premium", "EXPRESS", "Lite", "Cargo", "Unrated")
MASTER_PRODUCTS = ("Premium", "Express", "Lite", "Cargo")
_NULL = "CAST(NULL AS DOUBLE)"
# The end of a highest slab: more parcels or kilograms than any day, rider or vehicle can reach.
_TOP = 1_000_000_000


def _rate(product, dox, model, low, high, amount, step=None, step_amount=None, service="Delivery", until="2023-12-31"):
    steps = [f"CAST({v} AS DOUBLE)" if v is not None else _NULL for v in (step, step_amount)]
    numbers = [f"CAST({v} AS DOUBLE)" for v in (low, high, amount)] + steps
    return ", ".join(
        [f"'{product}'", f"'{dox}'", f"'{model}'", *numbers, f"'{service}'", f"CAST('{until}' AS DATE)"]
    )


_RATE_COLUMNS = (
    "product_type_it", "doxtype", "commercial_category", "from_value", "to_value", "amount", "add_value", "add_amount",
    "service_type", "to_date",
)


def _rates() -> list[str]:
    rows = []
    for dox in ("Dox", "Non-Dox", "Both"):
        rows.append(_rate("Premium", dox, "Weight", 0, 10, 100))
        rows.append(_rate("Premium", dox, "Weight", 10, 20, 200, 1, 100))
    rows.append(_rate("Premium", "Both", "Weight", 0, 1000, 900, service="Pickup"))
    rows.append(_rate("Express", "Both", "Weight", 0, 15, 300, until="2023-03-15"))
    rows.append(_rate("Express", "Both", "Weight", 15, 20, 400, 5, 500, until="2023-03-15"))
    for dox in ("Dox", "Non-Dox"):
        rows.append(_rate("Lite", dox, "Shipment", 1, 2, 100))
        rows.append(_rate("Lite", dox, "Shipment", 3, _TOP, 200))
    rows.append(_rate("Cargo", "Both", "Shipment", 1, _TOP, 100))
    return rows


def _partner_rates() -> list[str]:
    return [
        _rate("All Products", "Both", "Weight", 0, 10, 150),
        _rate("All Products", "Both", "Weight", 10, 20, 250, 1, 100),
        _rate("All Products", "Both", "Shipment", 1, 20, 120),
        _rate("All Products", "Both", "Shipment", 21, _TOP, 180),
    ]


def padded(text: str, width: int) -> str:
    """`text` with leading zeros to at least `width` characters; a longer one is kept whole."""
    return f"lpad({text}, CAST(greatest({width}, length({text})) AS INT), '0')"


def code(letter: str, number: str) -> str:
    return f"'{letter}' || {padded(f'CAST({number} AS STRING)', 5)}"


def table_sql(d: Dialect) -> dict[str, str]:
    """SELECT text of every derived table, in an order in which each uses the star tables and earlier ones only."""
    t: dict[str, str] = {}
    # Dealt by order, the lines are moved once: the distinct lines and the join with the orders both find them in place.
    t["line"] = f"""
        SELECT l_orderkey, l_linenumber, max(l_partkey) AS pk, max(l_suppkey) AS sk, max(l_quantity) AS qty,
               max(l_discount) AS disc, max(l_tax) AS tax, max(l_returnflag) AS rf, max(l_linestatus) AS ls
        FROM {d.dealt.format("lineitem", "l_orderkey")} GROUP BY l_orderkey, l_linenumber"""
    t["parcel"] = f"""
        SELECT x.*,
               {code('V', "CASE WHEN o % 4 = 0 THEN sk ELSE rider END")} AS centre_code,
               {code('B', "rider")} AS rider_code,
               'C' || {padded(d.base36.format('(o * 10 + n)'), 8)} AS short_number,
               {d.hours(d.hours("TIMESTAMP '2023-01-01 08:00:00'", "24 * ((o + n * 13) % 90)"), "pk % 12")} AS delivered
        FROM (SELECT l_orderkey AS o, l_linenumber AS n, pk, sk, qty, disc, tax, rf, ls,
                     substr(o_orderpriority, 1, 1) AS priority, o_orderstatus AS status,
                     CASE WHEN l_orderkey % 4 = 0 THEN o_custkey
                          WHEN pk % 16 < 12 THEN pk % 4 ELSE 4 + pk % 4 END AS rider
              FROM line JOIN orders ON l_orderkey = o_orderkey) x"""
    products = " ".join(f"WHEN '{i}' THEN '{p}'" for i, p in enumerate(FACT_PRODUCTS, start=1))
    t[FACTS] = f"""
        SELECT centre_code AS gpart,
               short_number || CASE WHEN o % 2 = 0 THEN '001' ELSE '' END AS zzconsg_number,
               CASE WHEN pk % 4 = 0 THEN qty / 64 ELSE qty / 2 END AS zzcharge_weight,
               CASE rf WHEN 'R' THEN 'Dox' WHEN 'A' THEN 'NON-DOX' ELSE 'Parcel' END AS dox_type,
               CASE ls WHEN 'F' THEN 'DRS' ELSE 'RTO' END AS zzcons_status,
               {d.stamp_of('delivered')} AS zzdelivery_date,
               CASE WHEN pk % 97 = 0 THEN 'not recorded' ELSE {d.stamp_of(d.hours(
                   'delivered', '-(CASE WHEN pk % 5 = 3 THEN pk % 24 ELSE pk * 7 % 73 END)'))} END AS handover_datetime,
               lpad(CAST(pk % 1000 AS STRING), 6, '0') AS zzdest_pincode,
               CASE priority {products} END AS product
        FROM parcel"""
    t[FACTS_V1] = f"SELECT * FROM {FACTS}"
    t["cod_remittance"] = f"""
        SELECT short_number AS con_number, CAST(delivered AS DATE) AS delivery_date,
               {d.stamp_of('delivered')} AS delivery_date_timestamp,
               CASE WHEN tax > 0 THEN {d.stamp_of(d.hours('delivered', 'pk % 97'))} END AS utr_datetime
        FROM parcel WHERE status = 'P'"""
    t["biker_code_test"] = """
        SELECT short_number || CASE WHEN o % 2 = 0 THEN '001' ELSE '' END AS reference_number,
               rider_code AS worker_code
        FROM parcel WHERE disc > 0"""
    t["centre"] = f"""
        SELECT s_suppkey AS s, {code('V', 's_suppkey')} AS code, s_name,
               'City' || CAST(s_nationkey % 5 AS STRING) AS city,
               CASE WHEN s_suppkey % 3 = 2 THEN 'External' ELSE 'Internal' END AS type
        FROM supplier"""
    t["ndv_vendor_master"] = """
        SELECT code AS vendor_code, s_name AS vendor_name,
               CASE WHEN s % 10 = 9 THEN 'PUD' ELSE 'DLV' END AS vendor_category
        FROM centre"""
    t["cluster_master"] = "SELECT code AS vendor_code, city AS cluster_city, type FROM centre"
    slab_columns = f"code AS vendor_code, {', '.join(_RATE_COLUMNS)}, CAST('2023-01-01' AS DATE) AS from_date"
    t["ndv_commercial_master"] = f"""
        SELECT CASE type WHEN 'External' THEN 'PCC - External' ELSE 'PCC - Internal' END AS category, {slab_columns}
        FROM centre {d.per_row(_RATE_COLUMNS, _rates())}
        UNION ALL
        SELECT 'PCC - External' AS category, {slab_columns}
        FROM (SELECT * FROM centre WHERE type = 'External') c {d.per_row(_RATE_COLUMNS, _partner_rates())}"""
    t["ndv_kpi_table"] = f"""
        SELECT code AS vendor_code, product, CAST('2023-01-01' AS DATE) AS from_date,
               CAST('2023-03-31' AS DATE) AS to_date, CAST(80 + s * 7 % 20 AS DOUBLE) AS fad,
               CAST(80 + s * 3 % 20 AS DOUBLE) AS td, CAST(80 + s * 11 % 20 AS DOUBLE) AS scd
        FROM centre {d.per_row(("product",), [f"'{p}'" for p in MASTER_PRODUCTS])}"""
    bands = [
        f"('{kpi}', '{product}', {low}, {high}, {percent})"
        for kpi in ("FAD", "TD", "SCD")
        for product in MASTER_PRODUCTS
        for low, high, percent in ((0, 85, -10), (86, 92, 0), (93, 100, 10))
    ]
    t["ndv_kpi_master"] = f"""
        SELECT kpi_name, product, CAST(sla_from AS DOUBLE) AS sla_from, CAST(sla_to AS DOUBLE) AS sla_to,
               CAST(sla_percent AS DOUBLE) AS sla_percent, CAST('2022-01-01' AS DATE) AS from_date,
               CAST('2023-12-31' AS DATE) AS to_date
        FROM (VALUES {', '.join(bands)})
             AS v(kpi_name, product, sla_from, sla_to, sla_percent)"""
    t["biker_master"] = f"""
        SELECT {code('B', 'c')} AS biker_code,
               {code('V', "CASE WHEN c < 8 THEN c ELSE c % 10 END")} AS pc_code,
               CASE c % 3 WHEN 2 THEN 'PCC - External' ELSE 'PCC - Internal' END AS pcc_master,
               'KA' || {padded('CAST(c AS STRING)', 6)} AS vehicle,
               CASE WHEN c % 8 < 4 THEN 'NO' WHEN c % 8 = 7 THEN 'no' ELSE 'YES' END AS associate,
               CASE WHEN c % 8 < 4 THEN 'NA' WHEN c % 8 = 6 THEN 'na' ELSE 'YES' END AS attached_to,
               CASE c % 20 WHEN 1 THEN CAST('2023-02-15' AS DATE) WHEN 4 THEN CAST('2023-03-01' AS DATE)
                           WHEN 6 THEN CAST('2023-02-26' AS DATE) ELSE CAST('2022-06-15' AS DATE) END AS actvtn_date
        FROM (SELECT c_custkey AS c FROM customer) x"""
    t["city"] = """
        SELECT DISTINCT 'City' || CAST(n_nationkey % 5 AS STRING) AS city FROM nation"""
    steps = ("pc_type", "low", "high", "pay")

    def city_steps(rows):
        return [f"'{kind}', {low}, {high}, {pay}" for kind in ("Internal", "External") for low, high, pay in rows]

    t["commercials"] = f"""
        SELECT pc_type, city AS pc_city, low AS no_of_consignments_from, high AS no_of_consignments_to,
               CAST(pay AS DOUBLE) AS commercials, CAST(12000 AS DOUBLE) AS guaranteed_amount_biker
        FROM city {d.per_row(steps, city_steps(((1, 10, 5), (11, 20, 10), (21, _TOP, 15))))}"""
    t["hvdi_incentive"] = f"""
        SELECT pc_type, city AS pc_city, low AS no_of_consignments_from, high AS no_of_consignments_to,
               CAST(pay AS DOUBLE) AS incentives
        FROM city {d.per_row(steps, city_steps(((21, 25, 100), (26, 30, 200), (31, _TOP, 300))))}"""
    t["vehicle_commercials"] = f"""
        SELECT code AS pc_code, CAST(low AS DOUBLE) AS amount_of_weight_from, high AS amount_of_weight_to,
               CAST(pay AS DOUBLE) AS commercials, CAST(1 AS DOUBLE) AS additional_weight,
               CAST(1 AS DOUBLE) AS additional_amount_per_kg,
               CAST(22464 AS DOUBLE) AS guarantee_amount_per_vehicle_with_biker,
               CAST(16848 AS DOUBLE) AS guaranteed_amount_per_vehicle_without_biker
        FROM centre {d.per_row(("low", "high", "pay"), ["0, '5', 10", f"5, '{_TOP}', 20"])}"""
    hvdi = [
        f"'{model}', {row}"
        for model in ("Vehicle_with_Delivery_boy", "Vehicle_without_Delivery_boy")
        for row in ("0, 15, 0, 200, 1", f"16, {_TOP}, 201, {_TOP}, 2")
    ]
    t["vehicle_hvdi"] = f"""
        SELECT code AS pc_code, model, n_low AS no_of_consignments_from, n_high AS no_of_consignments_to,
               w_low AS charge_weight_from, w_high AS charge_weight_to, CAST(pay AS DOUBLE) AS incentives
        FROM centre {d.per_row(("model", "n_low", "n_high", "w_low", "w_high", "pay"), hvdi)}"""
    scores = ", ".join(
        f"CASE WHEN s % 4 <> {absent} THEN CAST(80 + s * {k} % 20 AS DOUBLE) END AS {metric}_{side}"
        for metric, ecom, nonecom in (("fad", 7, 9), ("td", 3, 13), ("scd", 11, 17))
        for side, k, absent in (("ecom", ecom, 1), ("nonecom", nonecom, 0))
    )
    t["sla_table"] = f"SELECT code AS pc_code, {scores} FROM centre"
    colours = [
        f"('{colour}', '{category}', 'PCC', {low}, {high}, {percent})"
        for category in ("E-commerce Shipments", "Non-Ecommerce Shipments", "Combined")
        for colour, low, high, percent in (("Red", "0", "85", -5), ("Green", "85.01", "92", 0), ("Gold", "92.01", "100", 5))
    ]
    limits = ", ".join(f"CAST({end} AS DOUBLE) AS {m}_{name}" for m in ("fad", "td", "scd")
                       for end, name in (("low", "min"), ("high", "max")))
    t["sla_master_table"] = f"""
        SELECT colour, category, pc_type, {limits}, CAST(percent AS DOUBLE) AS incentive
        FROM (VALUES {', '.join(colours)}) AS v(colour, category, pc_type, low, high, percent)"""
    return t


def needed(tables: dict[str, str], wanted: Sequence[str]) -> list[str]:
    """The wanted tables and those they are derived from, in definition order."""
    names = list(tables)
    keep = set(wanted)
    for name in reversed(names):
        if name in keep:
            words = set(tables[name].replace("(", " ").replace(")", " ").split())
            keep.update(n for n in names if n in words and names.index(n) < names.index(name))
    return [n for n in names if n in keep]


def with_clause(d: Dialect, wanted: Sequence[str], extra: str = "", tables: dict[str, str] | None = None) -> str:
    """`WITH` list of the wanted tables and what they need."""
    tables = tables or table_sql(d)
    parts = [f"{name} AS ({tables[name]})" for name in needed(tables, wanted)]
    return "WITH " + ",\n".join(([extra] if extra else []) + parts)
