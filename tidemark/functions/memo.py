"""Reuse logical plans (not data) across calls within one Spark session.

A DataFrame is an immutable plan; building the same stand-in again costs
only driver round trips.  Plans are keyed by session and arguments.
"""

from __future__ import annotations

import functools

_PLANS: dict = {}


def plan_memo(fn):
    @functools.wraps(fn)
    def wrapper(spark, *args):
        key = (fn.__module__, fn.__qualname__, id(spark._jsparkSession), spark.sparkContext.applicationId, args)
        hit = _PLANS.get(key)
        if hit is None:
            hit = _PLANS[key] = fn(spark, *args)
        return hit
    return wrapper


def clear() -> None:
    _PLANS.clear()
