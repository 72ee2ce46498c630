"""A deterministic table of raw postings made from the shared star-schema tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMPANIES = ["N-iX", "n ix", "Global Logic", "soft-serve", "SoftServe", "", "Acme  Apps", " Sigma ", "onix", "Zone 3000", "Telegram @jobs", "ELEKS"]
TITLES = [
    "Senior iOS Developer", "iOS Engineer (AI)", "Lead iOS Engineer", "Middle Swift Developer (#1234)", "Junior iOS Developer", "iOS/Android Developer", "React Native Developer", "Flutter Engineer",
    "Kotlin Multiplatform Engineer", "Mobile Engineer", "Mobile App Developer (Android)", "macOS C++ Engineer", "QA Automation Engineer iOS", "Software Engineer", "Software Engineer (iOS)", "Staff  Software   Engineer, Swift",
    "Principal Objective-C Engineer", "Android Developer", "iOS Developer with Android", "Head of Mobile", "Trainee / Intern iOS", "Стажер iOS розробник", "Client-side Developer", "Senior iOS Developer | Ethena Pay",
]
LOCATIONS = [
    "Kyiv, Ukraine", "Київ", None, "Remote", "Remote, US", "Worldwide", "Lviv", "Львів, Україна", "Berlin, Germany", "Remote (EU only)", "", "London office", "Hybrid, Warsaw", "Work from home",
    "Limassol, Cyprus", "Mexico City", "Одеса", "Дистанційно", "On-site, Prague", "no remote, Paris", "Anywhere", "Remote - Ukraine", "  ", "US only / remote", "Fully remote",
]
MODES = ["remote", "hybrid", "", "onsite", "unknown"]
DESCRIPTIONS = [
    "<p>We build apps in Swift and UIKit.</p>", "Requirements:\nSwift\nAuthorized to work in the US.\nBenefits:\nFree lunch", "Must be US citizen. Security clearance needed.", "We provide visa support and relocation package.",
    "Right to work in Ukraine is enough; no more.", "Nice to have: SwiftUI\nWork permit required\nRequirements: Objective-C, Flutter is optional", None, "", "Qualifications\nKnowledge of iOS, but Kotlin is preferred\nEU citizenship is mandatory.",
    "Робота віддалено. Потрібен досвід зі Swift", "Офис в центре, разработчик с опытом. Это мы ищем", "Hybrid role, 2 days in the office.",
]


def _array(values: list):
    return F.array(*[F.lit(v).cast("string") for v in values])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A scan; one of fewer partitions than cores (a small file of one row group) is spread over them. Narrow tables are spread by their
    size: a scan cannot cut a row group, so that its tasks would grow with the table."""
    path = f"{sf_dir}/{name}.parquet"
    df, cores = spark.read.parquet(path), spark.sparkContext.defaultParallelism
    if name in SPREAD_BY_SIZE:
        return _spread(df, path)
    return df.repartition(cores) if name in SPREAD and df.rdd.getNumPartitions() < cores else df


def _spread(df: DataFrame, path: str) -> DataFrame:
    """``df`` over as many tasks as the table at ``path`` is worth."""
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
    return df.repartition(max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))) if size >= LEAST_BYTES else df


#: Tables whose rows are worth much more work than a shuffle of them; those of the second line have narrow rows.
SPREAD = ("pages", "documents")
SPREAD_BY_SIZE = ("orders", "part", "customer", "events")
#: Stored bytes of a narrow table that a task takes, some ten thousand rows, and those below which a table is not worth it.
TASK_BYTES, LEAST_BYTES = 1 << 18, 1 << 14


def raw_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` with their customer's nation. Customers and nations are dimensions; AQE picks the joins. A join's tasks are few, as they
    are cut by bytes, so the joined rows, which are worth much more work than that, are spread after it."""
    o, c, n = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "customer", "nation"))
    df = o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"])
    df = _spread(df.select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate", "c_nationkey", "n_name"), f"{sf_dir}/orders.parquet")
    pick = lambda values, key, k: F.get(_array(values), (F.col(key) % k).cast("int"))
    # Every fourth title and every third description has words of its own, so their number grows with the table.
    team = F.when(F.col("o_orderkey") % 4 == 1, F.concat(F.lit(" "), (F.col("o_custkey") * 7 % 9973).cast("string"))).otherwise("")
    project = F.when(F.col("o_orderkey") % 3 == 2, F.concat(F.lit("\nProject p"), F.col("o_orderkey").cast("string"), F.lit(" with "), F.lower("n_name"))).otherwise("")
    return df.select(
        F.col("o_orderkey").alias("seq"), pick(COMPANIES, "o_custkey", 12).alias("company"), F.concat(pick(TITLES, "o_orderkey", 24), team).alias("title"),
        F.concat(F.lit("https://Jobs.Example.com/"), "o_custkey", F.lit("/"), (F.col("o_orderkey") % 7).cast("string"), F.lit("/?b=2&utm_source=x&a=1#f")).alias("url"),
        F.col("o_orderpriority").alias("source"), F.get(_array(LOCATIONS), F.col("c_nationkey").cast("int")).alias("location"), pick(MODES, "o_orderkey", 5).alias("remote"),
        F.col("o_orderdate").cast("timestamp").alias("published_at"), F.concat(pick(DESCRIPTIONS, "o_orderkey", 12), project).alias("description"),
        F.when(F.col("o_orderkey") % 11 == 0, F.concat(F.lit("job-"), (F.col("o_orderkey") % 1000).cast("string"))).alias("source_job_id"),
        F.when(F.col("o_orderkey") % 13 == 0, "ai").otherwise("ios").alias("track"), (F.col("o_orderkey") % 17 == 0).alias("russian_company"),
    )


def _sql_list(values: list) -> str:
    return "[" + ", ".join("NULL" if v is None else "'" + v.replace("'", "''").replace("\n", "' || chr(10) || '") + "'" for v in values) + "]"


RAW_SQL = f"""raw AS (
  SELECT o_orderkey AS seq, {_sql_list(COMPANIES)}[CAST(o_custkey % 12 AS INT) + 1] AS company, {_sql_list(TITLES)}[CAST(o_orderkey % 24 AS INT) + 1] || CASE WHEN o_orderkey % 4 = 1 THEN ' ' || (o_custkey * 7 % 9973) ELSE '' END AS title,
    'https://Jobs.Example.com/' || o_custkey || '/' || (o_orderkey % 7) || '/?b=2&utm_source=x&a=1#f' AS url, o_orderpriority AS source,
    {_sql_list(LOCATIONS)}[c_nationkey + 1] AS location, {_sql_list(MODES)}[CAST(o_orderkey % 5 AS INT) + 1] AS remote, o_orderdate AS published_at,
    {_sql_list(DESCRIPTIONS)}[CAST(o_orderkey % 12 AS INT) + 1] || CASE WHEN o_orderkey % 3 = 2 THEN chr(10) || 'Project p' || o_orderkey || ' with ' || lower(n_name) ELSE '' END AS description, CASE WHEN o_orderkey % 11 = 0 THEN 'job-' || (o_orderkey % 1000) END AS source_job_id,
    CASE WHEN o_orderkey % 13 = 0 THEN 'ai' ELSE 'ios' END AS track, o_orderkey % 17 = 0 AS russian_company
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
