"""The stand-in tables reproduce the facts measured in FIXTURES.md §2."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E

FACTS = {  # sf: (campaign rows, attributed true, summed over channels, >100 %, without orders, active, as-of)
    "0.001": (223, 34, 155, 36, 173, 14, 202),
    "0.01": (250, 472, 2360, 34, 15, 141, 1981),
}


@pytest.mark.parametrize("sf", sorted(FACTS))
def test_fixture_facts(spark, sf):
    d = f"/root/testdata/sf{sf}"
    q = E.queries()
    m = q["mart_campaign_performance"](spark, d)
    got = (m.count(),
           q["revenue_stats"](spark, d).agg(F.sum("attributed_orders")).first()[0],
           m.agg(F.sum("attributed_orders")).first()[0],
           m.where("conversion_rate_pct > 100").count(),
           m.where("attributed_orders = 0").count(),
           q["churn_labels"](spark, d).where("not is_churned").count(),
           q["attribute_orders_asof"](spark, d).count())
    assert got == FACTS[sf]
