"""Input tables in the shapes the engine expects, as SQL over the provided tables.

Each text runs unchanged in Spark SQL and in DuckDB.  They use integers, minima, maxima and
integer-valued sums only, so both engines agree to the last bit.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

# Stands in for the clock.
AS_OF = date(2002, 3, 1)

PANEL = r'''
SELECT CAST(gvkey AS BIGINT) AS gvkey, CAST(1 + gvkey % 3 + 3 * share AS INT) AS iid, date,
  CAST(year AS INT) AS year, CAST(month AS INT) AS month, 'USA' AS excntry,
  CASE WHEN dmin = 0.1 AND tmin = 0.08 THEN -1.0 ELSE 1.0 END
    * CASE WHEN gvkey % 5 IN (1, 3) THEN 20.0 + 20.0 * dmax ELSE px / 1000.0 * decay END AS prc,
  CASE WHEN dmin = 0.0 AND tmin = 0.0 THEN 0.0 ELSE qty * surge END AS volume,
  CASE WHEN dmax = 0.07 THEN NULL ELSE tmax - dmin END AS stock_ret,
  CASE WHEN tmax = 0.01 THEN NULL ELSE 60.0 * dmin END AS z_score,
  10.0 * tmax AS o_score,
  -60.0 * dmin AS kz_index,
  CASE WHEN tmin = 0.02 THEN NULL ELSE 5.0 * tmin - 5.0 * dmin END AS ni_be,
  tmin - dmin AS ocf_at,
  0.04 - dmin AS ebitda_mev,
  3.0 * qmin AS zero_trades_252d, 0.3 * qmin AS zero_trades_21d,
  1000.0 / rev / (decay * decay) AS ami_126d,
  dmax + tmax AS bidaskhl_21d,
  qty * decay AS turnover_126d,
  rev * decay * surge AS dolvol_126d,
  12.0 * tmax AS at_be, 25.0 * dmin AS debt_me,
  CAST(qmin AS INT) % 10 AS f_score,
  0.05 - tmax AS ni_ar1, dmin - 0.02 * decay AS eqnpo_me,
  CAST(year - 1996 + gvkey % 5 AS DOUBLE) AS age
FROM (
  SELECT *,
    CASE WHEN gvkey % 5 = 0 AND year >= 1999 THEN 0.0625 ELSE 1.0 END AS decay,
    CASE WHEN gvkey % 5 = 1 AND year >= 2000 THEN 4.0 ELSE 1.0 END AS surge
  FROM (
    SELECT gvkey, share, date, year(date) AS year, month(date) AS month,
           max(l_extendedprice / l_quantity) AS px, sum(l_quantity) AS qty,
           max(l_extendedprice) AS rev, min(l_discount) AS dmin, max(l_discount) AS dmax,
           max(l_tax) AS tmax, min(l_tax) AS tmin, min(l_quantity) AS qmin
    FROM (
      SELECT gvkey, share, l_extendedprice, l_quantity, l_discount, l_tax,
        CASE WHEN gvkey % 6 = 2 AND shipped >= DATE '2000-07-01' THEN make_date(year(shipped) - 3, month(shipped), 1)
             WHEN gvkey % 6 = 4 AND shipped >= DATE '2001-04-01' THEN make_date(year(shipped) - 4, month(shipped), 1)
             WHEN gvkey % 12 = 6 AND shipped >= DATE '2001-07-01' THEN make_date(year(shipped) - 5, month(shipped), 1)
             WHEN gvkey % 7 = 3 AND shipped BETWEEN DATE '1997-01-01' AND DATE '1997-06-30' THEN make_date(1996, month(shipped), 1)
             WHEN gvkey % 7 = 5 AND shipped BETWEEN DATE '1998-01-01' AND DATE '1998-04-30' THEN make_date(1997, month(shipped), 1)
             WHEN gvkey % 7 = 6 AND year(shipped) = 1999 THEN make_date(1999, CASE WHEN month(shipped) < 6 THEN 1 ELSE 6 END, 1)
             WHEN gvkey % 9 = 1 AND shipped < DATE '1997-01-01' THEN make_date(year(shipped) + 2, month(shipped), 1)
             ELSE shipped END AS date
      FROM (
        SELECT l_suppkey * 4 + l_partkey % 4 AS gvkey,
               CASE WHEN (l_suppkey * 4 + l_partkey % 4) % 8 = 3 THEN l_linenumber % 2 ELSE 0 END AS share,
               CAST(date_trunc('month', l_shipdate) AS DATE) AS shipped,
               l_extendedprice, l_quantity, l_discount, l_tax
        FROM lineitem
      ) AS li
    ) AS moved GROUP BY gvkey, share, date
  ) AS f
) AS k
'''

NAMES_USA = r'''
SELECT CASE WHEN o_custkey % 3 = 0 THEN o_custkey + 1000000 ELSE o_custkey END AS gvkey, o_orderkey AS seq,
  CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS datadate,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'Firm ' || CAST(o_custkey AS VARCHAR(20)) || ' ' || o_orderpriority END AS conm
FROM orders
'''

NAMES_GLOBAL = r'''
SELECT CASE WHEN o_custkey % 2 = 1 THEN o_custkey + 2000000 ELSE o_custkey END AS gvkey, o_orderkey AS seq,
  CASE WHEN o_orderkey % 11 = 0 THEN 'not-a-date' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)) END AS datadate_raw,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 = 1 THEN '   '
       ELSE 'Global ' || CAST(o_custkey AS VARCHAR(20)) || ' ' || o_orderstatus END AS conm
FROM orders
'''

VERDICTS = r'''
SELECT event_id AS seq, user_id AS gvkey,
  CASE event_type WHEN 'purchase' THEN 'acquisition' WHEN 'view' THEN 'merger' WHEN 'signup' THEN 'ipo'
       WHEN 'error' THEN 'bankruptcy' ELSE 'halt' END AS actual_event_type,
  CASE WHEN event_id % 4 = 0 THEN 'False' WHEN event_id % 4 = 1 THEN 'TRUE' ELSE 'True' END AS verified,
  CASE WHEN event_id % 13 = 0 THEN 'unknown' WHEN event_id % 13 = 1 THEN NULL
       WHEN event_id % 13 = 2 THEN '2014-12-' || CAST(10 + event_id % 15 AS VARCHAR(10))
       ELSE CAST(1995 + event_id % 7 AS VARCHAR(10)) || '-0' || CAST(1 + event_id % 9 AS VARCHAR(10)) || '-01' END AS actual_date_raw,
  CAST(1995 + event_id % 7 AS VARCHAR(10)) || '-0' || CAST(1 + event_id % 8 AS VARCHAR(10)) || '-01' AS detected_date_raw,
  CASE event_id % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS llm_confidence,
  'note ' || CAST(event_id AS VARCHAR(20)) AS details,
  'Acquirer ' || CAST(event_id % 17 AS VARCHAR(10)) AS acquirer,
  CASE WHEN event_id % 6 = 0 THEN NULL ELSE value END AS acquisition_price
FROM events
'''

RESPONSES = r'''
SELECT seq, gvkey, prompt,
  CASE seq % 7 WHEN 0 THEN 'Here:' || chr(10) || '```json' || chr(10) || js || chr(10) || '```'
    WHEN 1 THEN '```' || chr(10) || js || chr(10) || '``` done'
    WHEN 2 THEN 'I found ' || js || ' as asked.'
    WHEN 3 THEN js
    WHEN 4 THEN 'No information found.'
    WHEN 5 THEN '{"verified": true, "details": '
    ELSE '  ' || js || '  ' END AS response_text,
  CASE WHEN seq % 701 = 700 THEN 'Error 429: rate_limit exceeded' WHEN seq % 97 = 96 THEN 'connection reset' END AS error_text
FROM (
  SELECT CASE WHEN event_id % 10 = 9 THEN event_id + 1000000000 ELSE event_id END AS seq, user_id AS gvkey,
    'Verify event ' || CAST(event_id AS VARCHAR(20)) || ' ' || props AS prompt,
    '{"verified": ' || CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END
      || ', "actual_event_type": "acquisition", "actual_date": '
      || CASE event_id % 5 WHEN 0 THEN 'null' WHEN 1 THEN '"N/A"' WHEN 2 THEN '""' ELSE '"2015-03-04"' END
      || ', "llm_confidence": "high", "details": "d' || CAST(event_id AS VARCHAR(20))
      || '", "acquirer": null, "acquisition_price": ' || CAST(event_id % 90 AS VARCHAR(10)) || '}' AS js
  FROM events
) AS b
'''

# Flagged events; their answers have the same ``seq``, one in ten has none; the date is text, as in a file.
FLAGGED = r'''
SELECT event_id AS seq, user_id AS gvkey,
  CASE WHEN event_id % 2 = 0 THEN 'bankruptcy' ELSE 'merger' END AS event_type,
  CAST(1995 + event_id % 7 AS VARCHAR(10)) || '-0' || CAST(1 + event_id % 9 AS VARCHAR(10)) || '-01' AS event_date,
  CAST(40 + event_id % 50 AS INT) AS detection_score,
  CASE event_id % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'low' ELSE 'very_low' END AS confidence,
  CASE WHEN event_id % 9 = 0 THEN NULL ELSE 'rule ' || CAST(event_id % 17 AS VARCHAR(10)) END AS reasons
FROM events
'''

# The provided table (or view above) each text reads.
SOURCES = {
    "panel": "lineitem",
    "names_usa": "orders",
    "names_global": "orders",
    "verdicts": "events",
    "responses": "events",
    "flagged": "events",
}
VIEWS = {
    "panel": PANEL,
    "names_usa": NAMES_USA,
    "names_global": NAMES_GLOBAL,
    "verdicts": VERDICTS,
    "responses": RESPONSES,
    "flagged": FLAGGED,
}


class Inputs:
    """The input tables over one data folder, built lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._known: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        """The provided table or the text of that name; texts are analysed once per folder."""
        if name not in self._known:
            if name in VIEWS:
                self.view(SOURCES[name]).createOrReplaceTempView(SOURCES[name])
                self._known[name] = self.spark.sql(VIEWS[name])
            else:
                self._known[name] = self.table(name)
        return self._known[name]
