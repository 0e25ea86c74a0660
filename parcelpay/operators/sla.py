"""Service-level scores of partner centres."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelpay.functions.money import exact_sum
from parcelpay.names import KIND
from parcelpay.operators.lookups import band_join, master_join
from parcelpay.rules import COMMERCIALS, SlaRules
from parcelpay.sources.tables import ReportTables

METRICS = ("fad", "td", "scd")
# Categories by the kind of shipments that have a TD score.
ECOM, NONECOM, COMBINED = "E-commerce Shipments", "Non-Ecommerce Shipments", "Combined"


def centre_scores(tables: ReportTables) -> DataFrame:
    """Category and scores of internal centres: one side's score, or the mean where both sides have a TD score."""
    internal = tables["cluster_master"].filter(F.col("type") == "Internal")
    scores = master_join(tables["sla_table"], internal, "pc_code", "vendor_code", {})
    has_ecom, has_nonecom = F.col("td_ecom").isNotNull(), F.col("td_nonecom").isNotNull()

    def choose(ecom: Column, nonecom: Column, both: Column) -> Column:
        return (
            F.when(has_ecom & ~has_nonecom, ecom).when(~has_ecom & has_nonecom, nonecom).when(has_ecom & has_nonecom, both)
        )

    chosen = [
        choose(
            F.col(f"{m}_ecom"), F.col(f"{m}_nonecom"), (F.col(f"{m}_ecom") + F.col(f"{m}_nonecom")) / 2
        ).alias(m)
        for m in METRICS
    ]
    category = choose(F.lit(ECOM), F.lit(NONECOM), F.lit(COMBINED)).alias("category")
    return scores.select("pc_code", category, *chosen).distinct()


def centre_colours(scores: DataFrame, bands: DataFrame, rules: SlaRules) -> DataFrame:
    """Add a colour per metric from the bands of the category, and the final colour of their points.

    A metric outside every band leaves the final colour unknown.
    """
    of_type = bands.filter(F.col("pc_type") == rules.centre_type)
    points = F.lit(0)
    for metric in METRICS:
        scores = band_join(
            scores,
            of_type,
            equal=[("category", F.col("category"))],
            within=[(metric, F.col(f"{metric}_min"), F.col(f"{metric}_max"))],
            keep={f"{metric}_colour": F.col("colour")},
        )
        score = F.lit(None).cast("int")
        for colour, value in rules.points.items():
            score = F.when(F.col(f"{metric}_colour") == colour, value).otherwise(score)
        points = points + score
    final = (
        F.when(points <= rules.red_until, "Red")
        .when(points >= rules.gold_from, "Gold")
        .when(points.between(rules.red_until + 1, rules.gold_from - 1), "Green")
    )
    return scores.withColumn("sla_final_colour", final)


def vehicle_colour(scores: DataFrame, rules: SlaRules) -> DataFrame:
    """Add RED where both scores are at or below their limits; an unknown score gives GREEN."""
    low = (F.col("fad") <= rules.vehicle_fad_red) & (F.col("td") <= rules.vehicle_td_red)
    return scores.withColumn("sla_colour", F.when(low, "RED").otherwise("GREEN"))


def colour_percents(bands: DataFrame) -> DataFrame:
    """Percent of a colour, whatever the centre type or category it is listed for."""
    return bands.select(F.col("colour"), "incentive").distinct()


def centre_months(summary: DataFrame, code: str) -> DataFrame:
    """Pay per centre, model, kind of pay and month of a month summary."""
    return summary.groupBy(F.col(code).alias("pc_code"), "model", KIND, "pay_out_month").agg(
        exact_sum(F.col("payable_amount")).alias("payable_amount")
    )


def centre_commercials(months: DataFrame) -> DataFrame:
    """Commercials per centre and month.

    The kind of pay is judged inside the aggregate rather than filtered before it, so that `months` stays one shared
    shuffle when a report also needs its other rows.
    """
    is_commercial = F.col(KIND) == COMMERCIALS
    sums = months.groupBy("pc_code", "pay_out_month").agg(
        exact_sum(F.when(is_commercial, F.col("payable_amount"))).alias("commercial_amount"),
        F.coalesce(F.bool_or(is_commercial), F.lit(False)).alias("_any"),
    )
    return sums.filter("_any").select("pc_code", "commercial_amount")


def with_sla_pay(rows: DataFrame) -> DataFrame:
    """Add the amount paid or withheld for `payables_percentage`, its name and the total."""
    percent = F.col("payables_percentage")
    paid = F.col("commercial_amount") * percent / 100
    return rows.withColumns(
        {"sla_paid": paid, KIND: F.when(percent > 0, "INCENTIVE").when(percent < 0, "PENALTY")}
    ).withColumn("total_payables", F.col("commercial_amount") + F.col("sla_paid"))


def stamp(rules: SlaRules) -> Column:
    """Run time shown on the rows."""
    return F.current_timestamp() if rules.run_ts is None else F.lit(str(rules.run_ts)).cast("timestamp")
