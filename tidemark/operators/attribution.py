"""Click attribution: last click (W1), order attribution (J3), as-of.

Scale notes
-----------
* ``last_click`` is an aggregate (``max_by`` over ``(event_at, event_id)``),
  not a ranking window: it combines partially before the shuffle, so a
  customer holding a third of all clicks costs one row per map task.
* ``attribute_orders`` joins many orders to exactly one click row per
  customer.  A hot customer skews the order side only: its orders are salted
  over several join keys and its click row is repeated per salt.
* ``attribute_orders_asof`` is a scan: orders and clicks are laid side by side,
  cut into segments of a bounded number of rows along (customer, time)
  (``functions.windows.Segments``), and the last click runs along each segment.
  The last click of each segment, a partial aggregate, is carried into the
  segments after it by a window over one row per customer and segment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.windows import SEGMENT_ROWS, Segments
from .staging import clicked_events, completed_orders


def last_click(stg_events_df: DataFrame) -> DataFrame:
    """Per customer the campaign of the latest click (ties: larger event_id)."""
    clicks = clicked_events(stg_events_df)
    latest = F.max_by(F.struct("campaign_id", "event_at"), F.struct("event_at", "event_id"))
    return (clicks.groupBy("customer_id").agg(latest.alias("lc"))
            .select("customer_id", F.col("lc.campaign_id").alias("campaign_id"),
                    F.col("lc.event_at").alias("event_at")))


def attribute_orders(stg_orders_df: DataFrame, stg_events_df: DataFrame,
                     hot_rows: int = 5_000_000) -> DataFrame:
    """Completed orders LEFT JOIN the customer's last click overall.

    Hot customers (more than ``hot_rows`` orders) are salted: their orders
    spread over ``ceil(n / hot_rows)`` salts by a hash of the order id
    (deterministic, so retried tasks agree) and their one last-click row is
    repeated once per salt.  The hot list holds at most
    ``total_orders / hot_rows`` rows; Spark broadcasts it by its measured size.
    (AQE's skew-join split does not apply here: the click side reaches the
    join through an aggregate, not directly from a shuffle.)
    """
    orders = completed_orders(stg_orders_df).select(
        "order_id", "customer_id", "order_amount", "order_date")
    lc = last_click(stg_events_df).select("customer_id", "campaign_id")
    hot = (orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_n"))
           .where(F.col("_n") > hot_rows)
           .select("customer_id", F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias("_ns")))
    salted_orders = orders.join(hot, "customer_id", "left").withColumn(
        "_salt", F.when(F.col("_ns").isNotNull(), F.pmod(F.xxhash64("order_id"), F.col("_ns")))
        .otherwise(F.lit(0)).cast("int"))
    salted_clicks = lc.join(hot, "customer_id", "left").withColumn(
        "_salt", F.explode(F.when(F.col("_ns").isNotNull(), F.sequence(F.lit(0), F.col("_ns") - 1))
                           .otherwise(F.array(F.lit(0)))))
    return salted_orders.join(salted_clicks.drop("_ns"), ["customer_id", "_salt"], "left").select(
        "order_id", "customer_id", "order_amount", "order_date", "campaign_id")


def attribute_orders_asof(orders: DataFrame, clicks: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Each order takes the latest click with ``clicked_at <= ordered_at``.

    ``orders``: (order_id, customer_id, ordered_at, ...);
    ``clicks``: (event_id, customer_id, event_at, campaign_id).
    Returns the order columns plus ``campaign_id`` and ``clicked_at`` (null
    when there is no earlier click).  A click at the same instant as the
    order counts (it sorts first); ties among clicks go to the larger
    event_id.  Orders without a customer or time, and clicks without, match
    nothing.  No task orders more than about ``segment_rows`` rows, however
    many fall on one customer or instant.
    """
    order_cols = orders.columns
    o = orders.select(
        *order_cols,
        F.col("ordered_at").alias("_t"), F.lit(1).alias("_kind"),
        F.col("order_id").cast("string").alias("_eid"), F.lit(None).cast("string").alias("_camp"))
    c = clicks.where(F.col("customer_id").isNotNull() & F.col("event_at").isNotNull()).select(
        *[F.col("customer_id") if n == "customer_id" else F.lit(None).cast(orders.schema[n].dataType).alias(n)
          for n in order_cols],
        F.col("event_at").alias("_t"), F.lit(0).alias("_kind"),
        F.col("event_id").cast("string").alias("_eid"), F.col("campaign_id").alias("_camp"))
    cut = Segments(o.unionByName(c), ["customer_id"], ["_t", "_kind", "_eid"], segment_rows)

    is_click = F.col("_kind") == 0
    click = F.when(is_click, F.struct("_camp", "_t"))
    so_far = cut.within().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = cut.rows.withColumn("_best", F.last(click, ignorenulls=True).over(so_far)).where(~is_click)
    if not cut.one:
        before = cut.across().rowsBetween(Window.unboundedPreceding, -1)
        carry = cut.borders(F.max_by(click, F.when(is_click, F.struct("_t", "_eid"))).alias("_last")).select(
            F.col("customer_id").alias("_c"), F.col("_seg").alias("_g"),
            F.last("_last", ignorenulls=True).over(before).alias("_carry"))
        out = out.join(carry, F.col("customer_id").eqNullSafe(F.col("_c")) & (F.col("_seg") == F.col("_g")), "left")
        out = out.withColumn("_best", F.coalesce("_best", "_carry"))
    return out.select(*order_cols, F.col("_best._camp").alias("campaign_id"), F.col("_best._t").alias("clicked_at"))
