"""Tables in: every reader names its columns, so that scans stay pruned."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelens import schemas as S
from zonelens.functions import banners as B
from zonelens.functions.ips import ipv4_to_int
from zonelens.operators import banners as banner_ops

BRAND_KINDS = ("ns", "mx", "cname", "ip_ranges")


def read_crawl_list(spark: SparkSession, path: str) -> DataFrame:
    """Domains to look at (A1)."""
    return spark.read.parquet(path).select("domain", "ns", "ip", "country_dm")


def read_mx_hosts(spark: SparkSession, path: str, column: str = "mx_host") -> DataFrame:
    """Distinct tidy mail hosts of a Parquet or CSV file (A2)."""
    if path.lower().rstrip("/").endswith(".parquet"):
        df = spark.read.parquet(path)
    else:
        df = spark.read.option("header", True).csv(path)
    return banner_ops.mx_hosts(df.select(column), column)


def read_lookups(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """Provider catalog, mail catalog and ASN ranges (A3)."""
    base = base.rstrip("/")
    return {
        "provider_catalog": spark.read.parquet(f"{base}/provider_catalog"),
        "mx_catalog": spark.read.parquet(f"{base}/v_mx_catalog"),
        "asn_ranges": spark.read.parquet(f"{base}/asn_ip4"),
    }


def read_optional(spark: SparkSession, path: str | None) -> DataFrame | None:
    """A table, or None where it does not exist."""
    if not path:
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_brand_catalog(spark: SparkSession, base: str, kind: str) -> DataFrame | None:
    """Whole brand catalog of one kind, None where absent (A4)."""
    if kind not in BRAND_KINDS:
        raise ValueError(f"unknown brand catalog {kind!r}")
    return read_optional(spark, f"{base.rstrip('/')}/brand_{kind}_catalog")


def _lenient_asn(df: DataFrame | None) -> DataFrame | None:
    return None if df is None else df.withColumn("asn", F.col("asn").try_cast("bigint"))


def read_routing(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame | None]:
    """Routing tables; ``moas`` and ``churn`` must exist (A5)."""
    return {
        "moas": _lenient_asn(spark.read.parquet(paths["moas"])),
        "churn": _lenient_asn(spark.read.parquet(paths["churn"])),
        "asn_risk": _lenient_asn(read_optional(spark, paths.get("asn_risk"))),
        "tld_risk": read_optional(spark, paths.get("tld_risk")),
        "mx_dnsbl": read_optional(spark, paths.get("mx_dnsbl")),
    }


def prefix_ranges(prefix: Column, asn: Column) -> list[Column]:
    """start_int, end_int, plen and asn of a ``a.b.c.d/len`` text."""
    plen = F.substring_index(prefix, "/", -1).try_cast("int")
    size = F.pow(F.lit(2.0), 32 - plen).cast("bigint")
    address = ipv4_to_int(F.substring_index(prefix, "/", 1))
    start = address - F.pmod(address, size)
    return [
        start.alias("start_int"),
        (start + size - 1).alias("end_int"),
        plen.alias("plen"),
        asn.try_cast("bigint").alias("asn"),
    ]


def read_ip_prefixes(spark: SparkSession, path: str) -> DataFrame:
    """IPv4 prefixes with their ASN out of a tab-separated ``prefix  asn`` file; ``;`` starts a comment."""
    lines = spark.read.option("sep", "\t").option("comment", ";").schema("prefix STRING, asn STRING").csv(path)
    ranges = lines.select(*prefix_ranges(F.col("prefix"), F.col("asn")))
    return ranges.filter("start_int IS NOT NULL AND asn IS NOT NULL AND plen BETWEEN 0 AND 32")


def read_banner_rules(spark: SparkSession, path: str | None) -> list[B.Rule]:
    """Ordered rules of a CSV file; the built-in ones where it is missing or empty.

    The rule list is a hand-written configuration file; it becomes one CASE chain on the driver.
    """
    if not path:
        return list(B.CLASSIFIER)
    wanted = [f.split()[0] for f in S.BANNER_RULES.split(", ")]
    table = spark.read.option("header", True).option("escape", '"').csv(path)
    names = {c.strip().lower(): c for c in table.columns}
    # A rule's place in the file is its rank.
    ranked = table.withColumn("__rank", F.monotonically_increasing_id())
    picked = ranked.select(
        "__rank", *[(F.col(names[c]) if c in names else F.lit(None)).cast("string").alias(c) for c in wanted]
    )
    tidy = picked.select(
        "__rank",
        *[F.trim(F.coalesce(c, F.lit(""))).alias(c) for c in wanted[:4]],
        F.greatest(F.least(F.coalesce(F.trim("confidence").try_cast("int"), F.lit(80)), F.lit(100)), F.lit(0)).alias(
            "confidence"
        ),
    )
    rules = [
        B.Rule(r.host_regex, r.details_regex, r.provider, r.category, r.confidence)
        for r in tidy.orderBy("__rank").toLocalIterator()
    ]
    return rules or list(B.CLASSIFIER)


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    """Resolver answers."""
    return spark.read.schema(S.OBSERVATIONS).parquet(path)


def read_observation_stream(spark: SparkSession, path: str, files_per_trigger: int = 64) -> DataFrame:
    """Resolver answers as a stream (A18); the trigger size bounds what one key can bring in one step."""
    reader = spark.readStream.schema(S.OBSERVATIONS).option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def read_probe_results(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Probe outcomes."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(S.PROBE_RESULTS + ", tld STRING, ts TIMESTAMP").parquet(path)


def read_certificates(spark: SparkSession, path: str) -> DataFrame:
    """Stored TLS leaf fields, JSON lines or Parquet."""
    reader = spark.read.schema(S.CERTIFICATES)
    return reader.json(path) if path.lower().rstrip("/").endswith((".json", ".jsonl")) else reader.parquet(path)
