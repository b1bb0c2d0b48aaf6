"""DuckDB oracle SQL for sources, basic operators, format checks and reconciliation."""

GROUP_COUNT = "SELECT c_mktsegment, count(*) AS count FROM customer WHERE c_acctbal < 5000 GROUP BY c_mktsegment"

TS_TEXT = (
    "(SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN strftime(o_orderdate, '%d-%m-%Y %H:%M:%S') "
    "WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M') "
    "ELSE CAST(o_orderdate AS VARCHAR) END AS ts_text FROM orders)"
)

ACCOUNTS = """
WITH cn AS (SELECT c.*, n.n_name FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
src AS (SELECT c_custkey AS account_id,
               CASE WHEN c_nationkey = 0 THEN NULL ELSE c_custkey + 1000000 END AS registration_no,
               CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_name END AS business_name,
               CAST(DATE '2000-01-01' + INTERVAL (c_nationkey * 30) DAY AS DATE) AS registration_dt,
               n_name AS country
        FROM cn WHERE c_acctbal >= 0),
ext AS (SELECT c_custkey + 1000000 AS company_no,
               CASE WHEN c_acctbal > 9000 THEN upper(c_name) ELSE c_name END AS business_name,
               CAST(DATE '2000-01-01' + INTERVAL (c_nationkey * 30 +
                    CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END) DAY AS DATE) AS registered_on,
               CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE n_name END AS registered_country,
               DATE '2020-01-31' AS publish_date
        FROM cn WHERE c_mktsegment <> 'MACHINERY'),
j AS (SELECT * FROM src FULL OUTER JOIN ext ON src.registration_no = ext.company_no),
r AS (
  SELECT account_id, publish_date, 'business_name' AS attribute_name, CAST(src_bn AS VARCHAR) AS current_value,
         CAST(ext_bn AS VARCHAR) AS expected_value FROM
    (SELECT account_id, publish_date, src.business_name AS src_bn, ext.business_name AS ext_bn
     FROM src FULL OUTER JOIN ext ON src.registration_no = ext.company_no)
  UNION ALL
  SELECT account_id, publish_date, 'registration_dt', CAST(registration_dt AS VARCHAR),
         CAST(registered_on AS VARCHAR) FROM j
  UNION ALL
  SELECT account_id, publish_date, 'country', CAST(country AS VARCHAR), CAST(registered_country AS VARCHAR) FROM j
)
SELECT 'account_id' AS primary_key, CAST(account_id AS VARCHAR) AS primary_key_value, attribute_name,
       current_value, expected_value, 'registry' AS external_data_source,
       publish_date AS external_data_publish_date, TIMESTAMP '2024-01-01 00:00:00' AS run_date,
       2024 AS year, 1 AS month, 1 AS day
FROM r
"""

SHIPMENTS = """
WITH src AS (SELECT l_orderkey AS order_no, CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE l_linenumber END AS line_no,
                    CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE l_returnflag END AS region, CAST(trunc(l_quantity) AS INT) AS quantity,
                    CAST(l_shipdate AS DATE) AS shipped, TRUE AS here
             FROM lineitem WHERE l_linenumber % 7 <> 3),
ext AS (SELECT l_orderkey AS consignment, l_linenumber AS position,
               CASE WHEN l_suppkey % 3 = 0 OR l_suppkey % 7 = 0 THEN NULL ELSE l_returnflag END AS depot,
               CAST(CAST(trunc(l_quantity + CASE WHEN l_tax > 0.07 THEN 1 ELSE 0 END) AS INT) AS VARCHAR) AS pieces,
               CAST(l_shipdate AS DATE) + 2 AS dispatched, DATE '2020-01-31' AS publish_date
        FROM lineitem WHERE l_partkey % 10 <> 1),
j AS (SELECT * FROM src FULL OUTER JOIN ext
      ON order_no = consignment AND line_no = position AND region IS NOT DISTINCT FROM depot),
r AS (SELECT *, CASE WHEN here THEN '["' || order_no || '",' || coalesce('"' || line_no || '"', 'null') || ']' END AS pk FROM j)
SELECT 'order_no,line_no' AS primary_key, pk AS primary_key_value, a.attribute_name, a.current_value, a.expected_value,
       'carrier' AS external_data_source, publish_date AS external_data_publish_date, TIMESTAMP '2024-01-01 00:00:00' AS run_date,
       2024 AS year, 1 AS month, 1 AS day
FROM (SELECT pk, publish_date, unnest([
        {'attribute_name': 'quantity', 'current_value': CAST(quantity AS VARCHAR), 'expected_value': pieces},
        {'attribute_name': 'shipped', 'current_value': CAST(shipped AS VARCHAR), 'expected_value': CAST(dispatched AS VARCHAR)}]) AS a FROM r)
"""

QUARANTINE = """
WITH c AS (SELECT *, c_custkey % 21 = 0 OR c_custkey % 26 = 0 AS malformed, c_custkey % 10 = 0 AS no_nation, c_custkey % 15 = 0 AS no_balance FROM customer),
e AS (SELECT *, CASE WHEN malformed THEN 'malformed' ELSE concat_ws('; ', CASE WHEN no_nation THEN 'nation: not a int' END,
                CASE WHEN no_balance THEN 'balance: not a double' END) END AS errors FROM c)
SELECT c_custkey AS custkey, CASE WHEN errors = '' AND c_custkey % 11 <> 0 THEN c_name END AS name, CASE WHEN errors = '' THEN c_nationkey END AS nation,
       CASE WHEN errors = '' THEN c_acctbal END AS balance, errors
FROM e
"""

HISTORY = """
WITH runs AS (SELECT unnest(['run-1', 'run-2', 'run-3']) AS run_id, unnest([1996, 1998, 2000]) AS until, unnest([1, 2, 3]) AS run_number),
m AS (SELECT run_id, run_number, until, CAST(count(*) AS DOUBLE) AS size, avg(o_totalprice) AS mean, CAST(count(DISTINCT o_custkey) AS DOUBLE) AS dist
      FROM runs JOIN orders ON year(o_orderdate) <= until GROUP BY ALL),
l AS (SELECT run_id, run_number, until, '*' AS instance, 'Size' AS name, size AS value FROM m
      UNION ALL SELECT run_id, run_number, until, 'o_totalprice', 'Mean', mean FROM m
      UNION ALL SELECT run_id, run_number, until, 'o_custkey', 'CountDistinct', dist FROM m),
h AS (SELECT *, lag(value) OVER (PARTITION BY name ORDER BY run_id) AS previous FROM l)
SELECT run_id, CAST(run_number AS INT) AS run_number, instance, name, round(value, 4) AS value, round(previous, 4) AS previous,
       round(value - previous, 4) AS change, CASE WHEN run_id <> 'run-1' THEN until END AS until
FROM h
"""

ORACLE = {
    "csv_quarantine": QUARANTINE,
    "results_history": HISTORY,
    "reconcile_composite": SHIPMENTS,
    "group_count_filtered": GROUP_COUNT,
    "csv_roundtrip_count": GROUP_COUNT,
    "regex_check": (
        f"SELECT o_orderkey, ts_text, regexp_matches(ts_text, '^(\\d{{4}}-\\d{{2}}-\\d{{2}} \\d{{2}}:\\d{{2}}:\\d{{2}})$') "
        f"AS date_format1 FROM {TS_TEXT}"
    ),
    "timestamp_format_check": (
        f"SELECT o_orderkey, CASE WHEN ts_text IS NOT NULL THEN try_strptime(ts_text, '%Y-%m-%d %H:%M:%S') "
        f"IS NOT NULL END AS format_ok FROM {TS_TEXT}"
    ),
    "reconcile_accounts": ACCOUNTS,
    "reconcile_unmatched": f"SELECT * FROM ({ACCOUNTS}) WHERE current_value IS DISTINCT FROM expected_value",
}
