"""Loan-shaped views over the driver's test tables.

The reference reads one wide loan file; the test data is a TPC-H-like star
schema. These views derive deterministic loan columns (with missing values
and edge cases) from ``orders``, ``customer`` and ``nation`` so every
operator runs over whole tables whose size grows with the scale factor.

The same definitions exist twice: as Spark DataFrames (``loans_raw``,
``loans``, ``scored``) and as SQL text (``LOANS_RAW_SQL`` ...) that DuckDB
runs inside the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MON = "JanFebMarAprMayJunJulAugSepOctNovDec"

# The view definitions (column -> SQL expression over
# k = o_orderkey), shared by the Spark builders and the oracle CTEs.
LOANS_RAW_EXPRS = [
    ("row_id", "k"),
    ("loan_status",
     "case when k%97=0 then null when k%10=0 then 'Charged Off' when k%10=1 then 'Default' "
     "when k%10<=5 then 'Fully Paid' when k%10<=7 then 'Current' "
     "when k%10=8 then 'Late (31-120 days)' "
     "else 'Does not meet the credit policy. Status:Fully Paid' end"),
    ("loan_amnt", "o_totalprice/10"),
    ("annual_inc",
     "case when k%53=0 then null when c_acctbal<=0 then cast(0 as double) else c_acctbal*10 end"),
    ("int_rate",
     "case when k%61=0 then null else concat(cast(5+k%24 as string),'.',cast(k%7 as string),'%') end"),
    ("revol_util", "concat(cast(k%120 as string),'.5%')"),
    ("term", "case when k%41=0 then null when k%3=0 then ' 60 months' else ' 36 months' end"),
    ("emp_length",
     "case when k%13=0 then '< 1 year' when k%13=1 then '1 year' when k%13=10 then '10+ years' "
     "when k%13=11 then 'n/a' when k%13=12 then null else concat(cast(k%13 as string),' years') end"),
    ("issue_d",
     f"case when k%71=0 then 'unknown' else concat(substr('{MON}', "
     "cast((month(o_orderdate)-1)*3+1 as int), 3),'-',cast(year(o_orderdate) as string)) end"),
    ("earliest_cr_line",
     f"concat(substr('{MON}', cast((k%12)*3+1 as int), 3),'-',cast(1960+k%34 as string))"),
    ("fico_range_low", "600+(k%40)*5"),
    ("fico_range_high", "604+(k%40)*5"),
    ("dti", "case when k%59=0 then null else cast(k%4000 as double)/100 end"),
    ("revol_bal", "o_totalprice"),
    ("installment", "o_totalprice/360"),
    ("home_ownership",
     "case when k%4=0 then 'RENT' when k%4=1 then 'MORTGAGE' when k%4=2 then 'OWN' else null end"),
    ("purpose", "c_mktsegment"),
    ("addr_state", "n_name"),
    ("emp_title", "case when o_custkey%17=0 then null else c_name end"),
    ("grade", "substr('ABCDEFG', cast(k%7+1 as int), 1)"),
    ("mths_since_last_record", "case when k%10<7 then null else cast(k%100 as double) end"),
    ("total_pymnt", "o_totalprice/8"),
]

SCORED_EXPRS = [
    ("row_id", "k"),
    ("default", "case when 5*((k*104729)%9973) < 2*((k*7919)%10007) then 1 else 0 end"),
    ("pd_hat", "cast((k*7919)%10007 as double)/10007"),
    ("pd_tied", "cast((k*7919)%5 as double)/5"),
    ("issue_ts", "case when k%71=0 then null else o_orderdate end"),
    ("term_months", "case when k%3=0 then 60 else 36 end"),
    ("grade", "substr('ABCDEFG', cast(k%7+1 as int), 1)"),
    ("loan_amnt", "o_totalprice/10"),
    ("dti", "cast(k%4000 as double)/100"),
]


def _sql_select(exprs, quote_default: bool = True) -> str:
    parts = []
    for name, e in exprs:
        alias = '"default"' if (name == "default" and quote_default) else name
        parts.append(f"{e} AS {alias}")
    return ",\n  ".join(parts)


LOANS_RAW_SQL = (
    "SELECT\n  " + _sql_select(LOANS_RAW_EXPRS) + "\nFROM (SELECT o.*, o_orderkey AS k, c.*, n.* "
    "FROM orders o JOIN customer c ON o_custkey = c_custkey "
    "JOIN nation n ON c_nationkey = n_nationkey) src"
)

SCORED_SQL = (
    "SELECT\n  " + _sql_select(SCORED_EXPRS) + "\nFROM (SELECT o.*, o_orderkey AS k FROM orders o) src"
)

# ``loans`` = ``loans_raw`` after type coercion (before imputation).
LOANS_SQL = """SELECT
  row_id, loan_status, loan_amnt, annual_inc,
  CAST(replace(replace(int_rate, '%', ''), ',', '') AS DOUBLE) AS int_rate,
  CAST(replace(replace(revol_util, '%', ''), ',', '') AS DOUBLE) AS revol_util,
  term, emp_length,
  try_strptime(trim(issue_d), '%b-%Y') AS issue_d,
  try_strptime(trim(earliest_cr_line), '%b-%Y') AS earliest_cr_line,
  fico_range_low, fico_range_high, CAST(dti AS DOUBLE) AS dti, revol_bal, installment,
  home_ownership, purpose, addr_state, emp_title, grade, mths_since_last_record, total_pymnt,
  CAST(nullif(regexp_extract(term, '([0-9]+)', 1), '') AS DOUBLE) AS term_months,
  TRY_CAST(replace(replace(replace(
      CASE WHEN trim(emp_length) = '< 1 year' THEN '0'
           WHEN trim(emp_length) = '1 year' THEN '1'
           WHEN trim(emp_length) IN ('n/a', '') THEN NULL
           ELSE trim(emp_length) END,
      ' years', ''), ' year', ''), '+', '') AS DOUBLE) AS emp_length_int,
  (CAST(fico_range_low AS DOUBLE) + CAST(fico_range_high AS DOUBLE)) / 2.0 AS fico_mean
FROM loans_raw"""


def with_views_sql(body: str, views: tuple[str, ...] = ("loans_raw", "loans", "scored")) -> str:
    """Prefix an oracle query with the CTEs of the fixture views it uses."""
    ctes = []
    if "loans_raw" in views or "loans" in views:
        ctes.append(f"loans_raw AS (\n{LOANS_RAW_SQL}\n)")
    if "loans" in views:
        ctes.append(f"loans AS (\n{LOANS_SQL}\n)")
    if "scored" in views:
        ctes.append(f"scored AS (\n{SCORED_SQL}\n)")
    if not ctes:
        return body
    body = body.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _project(df: DataFrame, exprs) -> DataFrame:
    return df.select(*[F.expr(e).alias(n) for n, e in exprs])


def loans_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw loan table (strings as a CSV would hold them), one row per order.

    ``orders`` is the large side; ``customer`` joins on its key (shuffle or
    runtime broadcast, AQE decides), ``nation`` is a 25-row dimension.
    """
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"
    )
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"
    )
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    src = (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
        .withColumn("k", F.col("o_orderkey"))
    )
    return _project(src, LOANS_RAW_EXPRS)


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``loans_raw`` after type coercion (the library's own step)."""
    from ..operators.clean import coerce_types

    return coerce_types(loans_raw(spark, sf_dir), date_fallback=False)


# Scores the plain view lacks, over k = row_id.
CONTINUOUS_SCORE = "cast(row_id * 7919 % 1000003 as double) / 1000003 + cast(row_id as double) / 1e12"
HALF_ZERO_SCORE = "case when row_id % 2 = 0 then cast(0 as double) else cast(row_id * 104729 % 99991 as double) / 99991 end"


def continuous_score():
    return F.expr(CONTINUOUS_SCORE)


def half_zero_score():
    return F.expr(HALF_ZERO_SCORE)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scored validation-like table: ``row_id, default, pd_hat, ...``."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    return _project(o.withColumn("k", F.col("o_orderkey")), SCORED_EXPRS)
