"""Expressions on the rider master."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelpay.rules import NO_ANSWERS, ModelLabels


def worker_model(associate: Column, attached_to: Column, labels: ModelLabels) -> Column:
    """Worker model from the two declarations; NULL when neither pattern fits."""
    lone = F.upper(associate).isin(*NO_ANSWERS)
    unattached = F.upper(attached_to).isin(*NO_ANSWERS)
    return (
        F.when(lone & unattached, labels.biker)
        .when(~lone & ~unattached, labels.vehicle_with_boy)
        .when(~lone & unattached, labels.vehicle_without_boy)
    )
