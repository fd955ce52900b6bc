"""API responses of two networks combined into one fact frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.operators.order import union_all
from tallyloom.operators.predicates import between
from tallyloom.schema import conform, empty_facts, warehouse_shape
from tallyloom.sources.api import adroll_api, meta_api


def combine(
    campaign_responses: DataFrame | None,
    insights: DataFrame | None,
    start=None,
    end=None,
    run_date=None,
) -> DataFrame:
    """Fact rows of whichever responses there are, typed and stamped; none without any.

    Sort with `total_order` and describe with `profile` and `channel_summary`.
    """
    frames = []
    if campaign_responses is not None:
        frames.append(conform(adroll_api(campaign_responses)))
    if insights is not None:
        frames.append(conform(meta_api(insights)))
    frames = frames or [empty_facts(SparkSession.active())]
    facts = warehouse_shape(union_all(frames), run_date)
    return facts if start is None else between(facts, start, end)
