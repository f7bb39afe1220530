"""Encounter-shaped view over the ``orders`` table.

One text that Spark and DuckDB both run: every operator of the encounter
domain can be checked against plain SQL on the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyward.plans import encounter_rules as R

_OWN_RULE = ["metformin", "insulin", "repaglinide", "examide"]


def _medication(i: int, name: str) -> str:
    """Doses of a medication: every few rows where the models use it, else rarely."""
    period = (9 if name in R.MODELLED_MEDICATIONS else 89) + 2 * i
    return (
        f"CASE (o_orderkey + {i} * o_custkey) % {period} WHEN 0 THEN 'Steady' WHEN 1 THEN 'Up' "
        f"WHEN 2 THEN 'Down' ELSE 'No' END AS {name}"
    )


_OTHER_MEDICATIONS = ",\n  ".join(_medication(i, m) for i, m in enumerate(R.RAW_MEDICATIONS) if m not in _OWN_RULE)

ENCOUNTERS_SQL = f"""
SELECT
  o_orderkey AS encounter_id,
  CAST(FLOOR(o_orderkey / 2) AS BIGINT) AS patient_nbr,
  CASE WHEN o_custkey % 40 = 0 THEN '?' WHEN o_custkey % 20 = 1 THEN 'Asian'
       WHEN o_custkey % 20 = 2 THEN 'Hispanic' WHEN o_custkey % 20 = 3 THEN 'Other'
       WHEN o_custkey % 20 IN (4, 5, 6) THEN 'AfricanAmerican' ELSE 'Caucasian' END AS race,
  CASE WHEN o_custkey % 499 = 0 THEN 'Unknown/Invalid' WHEN o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  CONCAT('[', CAST((o_custkey % 10) * 10 AS STRING), '-', CAST((o_custkey % 10) * 10 + 10 AS STRING), ')') AS age,
  CASE WHEN o_orderkey % 33 = 0 THEN '[75-100)' ELSE '?' END AS weight,
  CAST(o_orderkey % 8 + 1 AS INT) AS admission_type_id,
  CAST(o_custkey % 28 + 1 AS INT) AS discharge_disposition_id,
  CAST(o_orderkey % 26 + 1 AS INT) AS admission_source_id,
  CAST(FLOOR(o_totalprice) AS INT) % 14 + 1 AS time_in_hospital,
  CAST(FLOOR(o_totalprice) AS INT) % 120 + 1 AS num_lab_procedures,
  CAST(FLOOR(o_totalprice) AS INT) % 7 AS num_procedures,
  CAST(FLOOR(o_totalprice) AS INT) % 60 + 1 AS num_medications,
  CASE WHEN o_orderkey % 6 = 0 THEN CAST(o_orderkey % 9 AS INT) ELSE 0 END AS number_outpatient,
  CASE WHEN o_orderkey % 19 = 0 THEN CAST(o_orderkey % 4 AS INT) ELSE 0 END AS number_emergency,
  CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_custkey % 6 AS INT) ELSE 0 END AS number_inpatient,
  CAST(o_orderkey % 16 + 1 AS INT) AS number_diagnoses,
  CASE WHEN o_custkey % 5 < 2 THEN '?' ELSE 'MC' END AS payer_code,
  CASE o_custkey % 9 WHEN 0 THEN 'Surgery-General' WHEN 1 THEN 'InternalMedicine' WHEN 2 THEN 'Cardiology'
       WHEN 3 THEN 'Emergency/Trauma' WHEN 4 THEN 'Nephrology' ELSE '?' END AS medical_specialty,
  CASE WHEN o_custkey % 50 = 0 THEN '?' WHEN o_custkey % 17 = 0 THEN 'V58' WHEN o_custkey % 19 = 0 THEN 'E909'
       WHEN o_custkey % 13 = 0 THEN '250.8' WHEN o_custkey % 23 = 0 THEN '785' WHEN o_custkey % 29 = 0 THEN '459.5'
       ELSE CAST(o_custkey % 900 + 100 AS STRING) END AS diag_1,
  CASE WHEN o_orderkey % 11 = 0 THEN '?' ELSE CAST(o_orderkey % 900 + 100 AS STRING) END AS diag_2,
  CASE WHEN o_orderkey % 5 = 0 THEN '?' ELSE CAST((o_orderkey + o_custkey) % 900 + 100 AS STRING) END AS diag_3,
  CASE WHEN o_orderkey % 20 = 0 THEN '>200' WHEN o_orderkey % 20 = 1 THEN '>300' WHEN o_orderkey % 20 = 2 THEN 'Norm' ELSE 'None' END AS max_glu_serum,
  CASE o_custkey % 6 WHEN 0 THEN '>7' WHEN 1 THEN '>8' WHEN 2 THEN 'Norm' ELSE 'None' END AS a1cresult,
  CASE o_orderkey % 10 WHEN 0 THEN 'Up' WHEN 1 THEN 'Down' WHEN 2 THEN 'Steady' WHEN 3 THEN 'Steady' ELSE 'No' END AS metformin,
  CASE o_custkey % 8 WHEN 0 THEN 'Up' WHEN 1 THEN 'Down' WHEN 2 THEN 'Steady' WHEN 3 THEN 'Steady' ELSE 'No' END AS insulin,
  CASE o_orderkey % 90 WHEN 0 THEN 'Steady' WHEN 1 THEN 'Up' ELSE 'No' END AS repaglinide,
  'No' AS examide,
  {_OTHER_MEDICATIONS},
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Ch' ELSE 'No' END AS change,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'No' ELSE 'Yes' END AS diabetesmed,
  CASE WHEN o_orderkey % 7 = 0 THEN '<30' WHEN o_orderstatus = 'O' THEN '>30' ELSE 'NO' END AS readmitted,
  CAST((o_orderkey * 7919) % 300 + CASE WHEN o_orderkey % 7 = 0 THEN 60 ELSE 0 END AS DOUBLE) / 1000.0 AS prob
FROM orders
"""


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


def encounters(spark: SparkSession, data_dir: str) -> DataFrame:
    """Raw encounters, a pure projection of ``orders``: column pruning and
    filters reach the Parquet scan through it."""
    text = ENCOUNTERS_SQL.replace("FROM orders", "FROM {orders}")
    return spark.sql(text, orders=table(spark, data_dir, "orders"))
