-- Revenue in USD beside its target for every month and category that has either; an open month is projected at its run rate.
-- test: unique(month_start, category)
-- test: not_null(target_usd)
-- test: assert_empty: SELECT 1 FROM gold.mart_sales_vs_target WHERE days_elapsed > days_in_month OR orders < 0
WITH entries AS (
  -- sales and targets as one list: a single aggregate takes the place of a join
  SELECT order_month AS month_start, category, order_key, quantity, amount_usd, CAST(NULL AS DECIMAL(18, 2)) AS target_usd
  FROM gold.fct_order_items WHERE order_date <= :as_of
  UNION ALL
  SELECT month_start, category, NULL, 0, 0, target_usd FROM silver.targets_sales
), calendar AS (
  -- one row for each month, so that dates are worked out once
  SELECT month_start, last_day(month_start) <= :as_of AS over, day(last_day(month_start)) AS length
  FROM (SELECT explode(sequence((SELECT min(order_month) FROM gold.fct_order_items), trunc(:as_of, 'month'), interval 1 month)) AS month_start)
), totals AS (
  SELECT month_start, category, count(DISTINCT order_key) AS orders, CAST(sum(quantity) AS BIGINT) AS units,
    CAST(sum(amount_usd) AS DECIMAL(18, 2)) AS revenue_usd, max(target_usd) AS target_usd
  FROM entries GROUP BY month_start, category
), placed AS (
  SELECT t.*, c.over, c.length, if(c.over, c.length, day(:as_of)) AS elapsed, CAST(t.revenue_usd AS DOUBLE) AS r, CAST(t.target_usd AS DOUBLE) AS goal
  FROM totals t JOIN calendar c USING (month_start)
), rated AS (SELECT *, CAST(floor(r * length / elapsed * 100 + 0.5) / 100 AS DECIMAL(18, 2)) AS rate FROM placed)
SELECT month_start, category, if(over, 'closed', 'in_progress') AS period_status, elapsed AS days_elapsed, length AS days_in_month, orders, units,
  revenue_usd, target_usd, floor(try_divide(r, goal) * 10000 + 0.5) / 10000 AS attainment_pct, rate AS projected_revenue_usd,
  floor(try_divide(CAST(rate AS DOUBLE), goal) * 10000 + 0.5) / 10000 AS projected_attainment_pct, CAST(revenue_usd - target_usd AS DECIMAL(18, 2)) AS gap_usd,
  -- fixed values: the words, and the nine tenths from which a month is only at risk
  CASE WHEN over THEN if(r >= goal, 'hit', 'missed') WHEN rate >= target_usd THEN 'on_track' WHEN CAST(rate AS DOUBLE) >= 0.9 * goal THEN 'at_risk' ELSE 'behind' END AS status
FROM rated ORDER BY month_start, category
