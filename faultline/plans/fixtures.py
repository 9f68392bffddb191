"""Incident and CI-lookup projections over the shared test tables.

The supplied tables hold no tickets, so the registered queries derive an
``incidents`` table from every row of ``events`` and a ``ci_lookup`` from every
row of ``nation``. The texts run unchanged in Spark SQL and in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INCIDENTS_SQL = """
SELECT
  'INC' || lpad(CAST(event_id AS STRING), 7, '0') AS number,
  ts AS opened,
  CASE WHEN event_id % 50 = 0 THEN 'not a date'
       WHEN event_id % 50 = 1 THEN CAST(45000 + event_id % 365 AS STRING) || '.5'
       ELSE substr(CAST(ts AS STRING), 1, 19) END AS opened_raw,
  CASE event_id % 5 WHEN 0 THEN 'NetCool Probe' WHEN 1 THEN 'int_mft api_prod'
       WHEN 2 THEN 'Atos Desk' WHEN 3 THEN 'J Doe' END AS caller,
  CASE event_id % 6 WHEN 0 THEN ' Resolved ' WHEN 1 THEN 'closed'
       WHEN 2 THEN 'Accepted / In Progress' WHEN 3 THEN 'on-hold' WHEN 4 THEN 'awaiting user info' END AS status,
  event_type AS category,
  CAST(1 + event_id % 4 AS STRING) AS severity,
  'Group ' || CAST(user_id % 4 AS STRING) AS assignment_group,
  CASE WHEN event_id % 8 <> 0 THEN 'user' || CAST(user_id % 9 AS STRING) END AS assigned_to,
  CASE WHEN event_id % 9 <> 0 THEN 'CI-' || CAST(user_id % 30 AS STRING) END AS configuration_item,
  CASE event_id % 4 WHEN 0 THEN 'Intermittent glitch. RCA attached, reprocessed and verified'
       WHEN 1 THEN 'Files triggered. Hence closing' WHEN 2 THEN '' END AS resolution_notes,
  CASE WHEN event_id % 10 = 0 THEN 'seen also in /data/archive/' || src || ', C:' || chr(92) || 'Drop' || chr(92) || src END AS comments,
  CASE event_id % 14
    WHEN 0 THEN src || '-' || mid || '-' || dst || ' FMS-FTP-ERROR Unsuccessful PUT 550 The system cannot find the file specified. /var/opt/transfers/' || src || '/out'
    WHEN 1 THEN 'FTP  error Unsuccessful GET Permission denied ' || dst || 'A then I' || substr(src, 2) || ' /etc/x,/home/y'
    WHEN 2 THEN 'Number of stuck files in /data/in/' || src || ' from ' || CAST(event_id % 90 AS STRING) || ' min : - ' || CAST(event_id % 7 AS STRING)
    WHEN 3 THEN 'FMS_CONFIG FILE Config exists, but contains no config lines /opt/big/configs/' || src || '.cfg ' || src
    WHEN 4 THEN 'FMS-ERR-FILE-REMOVE Cannot remove file //var//opt/x/' || dst || '.tmp; ' || dst
    WHEN 5 THEN 'CALLOUT_MFTERR03 ' || src || ' on abcxyzapp' || lpad(CAST(user_id % 5 AS STRING), 4, '0')
    WHEN 6 THEN 'callout-mfterr4 ' || src || ' at node' || CAST(user_id % 3 AS STRING) || '.example.net'
    WHEN 7 THEN 'PROCESS-ALERT ' || src || ' run_it.sh Fired Date Time: ' || iso || 'Z'
    WHEN 8 THEN 'WARNING: filesystem /mnt/d' || CAST(user_id % 6 AS STRING) || ' Mon Dec 22 19:22:11 GMT 2025 abcxyzapp0001'
    WHEN 9 THEN 'connection refused by proxy, SSL error during handshake, Proxy reset'
    WHEN 10 THEN 'Not connected E:' || chr(92) || 'Data' || chr(92) || 'Out hwdc_*.xml ' || src || ' Stuck files :- ' || CAST(event_id % 5 AS STRING)
    WHEN 11 THEN 'Unhandled  Exception Error MULTIPLE-' || mid || '-' || dst || ' curl error'
    WHEN 12 THEN '   '
  END AS short_description,
  CASE event_id % 7
    WHEN 0 THEN 'Class: FMS_IO_ERROR FMS-ERR-FILE-COPY /opt/app/' || src || '//in ' || src || '-' || mid || '-' || dst
    WHEN 1 THEN 'ERR-HTTPS-ERROR at ' || iso || ' host abcapp0002 ABCAPP0002 n1.example.net'
    WHEN 2 THEN 'Couldn' || chr(39) || 't get remote file list from 15 min :- 3'
    WHEN 3 THEN 'Missing Files 426 Connection closed; ' || chr(92) || chr(92) || 'srv01' || chr(92) || 'share' || chr(92) || src
    WHEN 4 THEN ''
    WHEN 5 THEN 'Address already in use, put retry, Auth failure on ' || dst
  END AS description,
  'sheet' || CAST(event_id % 3 AS STRING) AS source_sheet
FROM (
  SELECT *,
    'E' || lpad(CAST(user_id % 97 AS STRING), 6, '0') AS src,
    'U' || lpad(CAST(event_id % 13 AS STRING), 6, '0') AS dst,
    CAST(100 + event_id % 300 AS STRING) AS mid,
    replace(substr(CAST(ts AS STRING), 1, 19), ' ', 'T') AS iso
  FROM {events}
) base
"""

CI_LOOKUP_SQL = """
SELECT 'CI-' || CAST(n_nationkey AS STRING) AS ci,
  CASE n_nationkey % 3 WHEN 0 THEN 'gateway' WHEN 1 THEN 'endpoint' ELSE 'scheduler' END AS ci_role,
  CASE n_nationkey % 2 WHEN 0 THEN 'SFTP' ELSE 'HTTPS' END AS ci_protocol,
  CASE WHEN n_regionkey = 0 THEN 'dev' ELSE 'prod' END AS ci_env,
  'stack' || CAST(n_regionkey AS STRING) AS ci_techstack,
  CAST(1 + n_nationkey % 4 AS STRING) AS ci_criticality
FROM {nation}
"""


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["event_id", "ts", "user_id", "event_type"]
    # The test file is one row group, which is one task however it is split; its four
    # narrow columns are dealt to all cores before the texts are made from them.
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(*columns).repartition(spark.sparkContext.defaultParallelism)
    return spark.sql(INCIDENTS_SQL, events=events)


TEXTS_SQL = """
SELECT number, text AS short_description, CAST(NULL AS STRING) AS description, CAST(NULL AS STRING) AS resolution_notes,
  CAST(NULL AS STRING) AS comments, CAST(NULL AS TIMESTAMP) AS opened, CAST(NULL AS STRING) AS opened_raw,
  CAST(NULL AS STRING) AS caller, CAST(NULL AS STRING) AS status, CAST(NULL AS STRING) AS category,
  CAST(NULL AS STRING) AS severity, CAST(NULL AS STRING) AS assignment_group, CAST(NULL AS STRING) AS assigned_to,
  CAST(NULL AS STRING) AS configuration_item, CAST(NULL AS STRING) AS source_sheet
FROM (
  SELECT 'D' || CAST(doc_id AS STRING) AS number, text FROM {documents}
  UNION ALL SELECT 'P' || CAST(page_id AS STRING), html FROM {pages}
  UNION ALL SELECT 'C' || CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING), text FROM {conversations}
) base
"""


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts of documents, pages and conversations as tickets: long, with markup and letters of four languages."""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "pages", "conversations")}
    return spark.sql(TEXTS_SQL, **tables)


def ci_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    # One line per CI, so any order of lines will do.
    return spark.sql(CI_LOOKUP_SQL, nation=nation).withColumn("line_no", F.lit("0"))
