"""Stand-ins for the domain jobs (KOK, HS, recipes)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.plans import kok
from sparkmart.standins import Tables, register
from sparkmart.standins.frames import KOK_PRICES_SQL, LINE_ORDER, LINE_ORDER_DESC_SQL, str_to_num_duck

_STN_RATE = str_to_num_duck("kok_discount_rate")


# the two newest quotes of each product from its ordered history, then arithmetic
PRICE_DELTA_CTES = f"""
{KOK_PRICES_SQL},
history AS (
  SELECT kok_product_id AS pid,
         list({{'pct': coalesce({_STN_RATE}, 0.0), 'won': kok_discounted_price}} ORDER BY {LINE_ORDER_DESC_SQL}) AS quotes
  FROM kok_prices GROUP BY pid),
compared AS (
  SELECT pid, quotes[1].pct AS pct_new, quotes[2].pct AS pct_old,
         round(100 * quotes[1].won / nullif(100 - quotes[1].pct, 0)) AS won_new,
         round(100 * quotes[2].won / nullif(100 - quotes[2].pct, 0)) AS won_old
  FROM history WHERE len(quotes) > 1),
judged AS (
  SELECT *, abs(won_new - won_old) / nullif(abs(won_new), 0) AS share,
         0.001 + 100 / nullif(won_new, 0) + 1 / nullif(100 - greatest(pct_new, pct_old), 0) AS slack
  FROM compared),
delta AS (
  SELECT pid AS kok_product_id, pct_new AS last_rate, won_new AS top_est_raw_price, pct_old AS before_rate,
         won_old AS second_est_raw_price, won_new - won_old AS diff, share AS diff_ratio,
         greatest(pct_new, pct_old) AS shown_rate_max, slack AS allow_max,
         if(coalesce(share <= slack, false), 'same', 'changed') || '_raw_price' AS raw_price_change_flag
  FROM judged)"""


@register("kok_price_delta", oracle=f"WITH {PRICE_DELTA_CTES} SELECT * FROM delta")
def q_kok_price_delta(spark, d):
    from sparkmart.standins.frames import kok_prices
    return kok.price_delta(kok_prices(Tables(spark, d)), arrival=LINE_ORDER)
