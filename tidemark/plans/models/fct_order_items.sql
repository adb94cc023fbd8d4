-- Order lines of live orders that were not cancelled, in the order's currency and in USD.
-- test: not_null(order_key)
-- test: not_null(amount_usd)
-- test: not_null(category)
-- test: assert_empty: SELECT 1 FROM gold.fct_order_items WHERE amount_usd < 0
WITH spans AS (
  -- a rate holds until the next one of its currency
  SELECT currency, rate_date, rate, lead(rate_date) OVER (PARTITION BY currency ORDER BY rate_date) AS until FROM silver.api_fx_rates
), days AS (
  -- the range join meets currencies and days, not orders
  SELECT currency, order_date, s.rate
  FROM (SELECT DISTINCT currency AS c, order_date FROM silver.shop_orders WHERE NOT is_cancelled) d
  JOIN spans s ON d.c = s.currency AND d.order_date >= s.rate_date AND (s.until IS NULL OR d.order_date < s.until)
), lines AS (
  SELECT o.order_key, i.line_number, i.product_key, o.customer_key, o.currency, o.order_date, i.quantity, i.amount
  FROM silver.shop_order_items i JOIN silver.shop_orders o ON i.order_key = o.order_key AND NOT o.is_cancelled
), converted AS (SELECT l.*, d.rate, CAST(l.amount AS DOUBLE) / d.rate AS usd FROM lines l LEFT JOIN days d ON l.currency = d.currency AND l.order_date = d.order_date)
SELECT order_key, line_number, p.category, c.segment, currency, order_date, trunc(order_date, 'month') AS order_month, quantity, amount, rate,
  CAST(sign(usd) * floor(abs(usd) * 100 + 0.5) / 100 AS DECIMAL(14, 2)) AS amount_usd
FROM converted v JOIN silver.shop_products p ON v.product_key = p.product_key LEFT JOIN silver.shop_customers c ON v.customer_key = c.customer_key AND c.is_current
