"""Name features as one projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelens.functions import dga as D

# Columns that may hold hosts of the domain.
HOST_COLUMNS = ("www", "www_cname", "cname", "mx_host_norm", "mail_mx")


def with_dga_features(df: DataFrame) -> DataFrame:
    """Label features, subdomain features, points and the suspect flag (H1-H8).

    ``registered_domain`` falls back to the lower-cased ``domain``, then to ''.
    """
    if "registered_domain" not in df.columns:
        fallback = F.lower("domain") if "domain" in df.columns else F.lit("")
        df = df.withColumn("registered_domain", fallback)
    hosts = [c for c in HOST_COLUMNS if c in df.columns]
    # Each step feeds several columns of the next one, so every part is evaluated once per row.
    tidy = df.withColumns({f"__{c}": D.tidy_host(F.col(c)) for c in (*hosts, "registered_domain")})
    parts = tidy.withColumns(
        {
            "dga_sld": D.second_level_label(F.col("__registered_domain")),
            **{f"__{c}": D.subdomain_labels(F.col(f"__{c}"), F.col("__registered_domain")) for c in hosts},
        }
    )
    sld = F.col("dga_sld")
    labels = [F.col(f"__{c}") for c in hosts]
    with_features = parts.withColumns(
        {
            "dga_sld_length": F.length(sld),
            "dga_sld_entropy": D.entropy(sld),
            "dga_sld_digit_ratio": D.share_of(sld, "0123456789"),
            "dga_sld_vowel_ratio": D.share_of(sld, "aeiou"),
            "subdomain_depth": D.row_max([D.subdomain_depth(x) for x in labels]),
            "subdomain_max_label": D.row_max([D.subdomain_max_label(x) for x in labels]),
        }
    ).drop(*[f"__{c}" for c in (*hosts, "registered_domain")])
    points = D.dga_points(
        F.col("dga_sld_entropy"),
        F.col("dga_sld_length"),
        F.col("dga_sld_digit_ratio"),
        F.col("dga_sld_vowel_ratio"),
        F.col("subdomain_depth"),
        F.col("subdomain_max_label"),
    )
    return with_features.withColumn("subdomain_points", points).withColumns(
        {
            "is_dga_suspect": F.col("subdomain_points") >= D.SUSPECT_FROM,
            "dga_features_version": F.lit(D.DGA_VERSION),
        }
    )
