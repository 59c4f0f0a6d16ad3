"""Table schemas as DDL text: inputs, lookups and outputs."""

from __future__ import annotations

OBSERVATIONS = "name STRING, rtype STRING, rcode STRING, answers ARRAY<STRING>, ttl INT, observed_ts TIMESTAMP"
CRAWL_LIST = "domain STRING, ns STRING, ip STRING, country_dm STRING"
DNS_RECORDS = (
    "domain STRING, status STRING, records MAP<STRING,ARRAY<STRING>>, errors MAP<STRING,STRING>, "
    "meta MAP<STRING,STRING>"
)
BANNER_CACHE = "host STRING, banner STRING, ts_epoch DOUBLE"
BANNERS_RAW = "mx_host STRING, banner_raw STRING, error STRING, tries INT"
PROBE_RESULTS = "domain STRING, status STRING, rcode STRING, response_time DOUBLE, answers INT, error STRING"
CERTIFICATES = "host STRING, notAfter STRING, issuer ARRAY<STRUCT<k:STRING,v:STRING>>, subjectAltName ARRAY<STRING>"
POLICY_TEXTS = "regdom STRING, mta_sts_txt STRING, policy_text STRING, tlsrpt_txt STRING"
ACTIVITY_STATE = "domain STRING, is_active BOOLEAN, dns_sig STRING, last_seen_ts BIGINT"

MX_CATALOG = "key STRING, src STRING, provider_name STRING, category STRING, risk_bias DOUBLE"
PROVIDER_CATALOG = "key_type STRING, key STRING, provider STRING, notes STRING, risk_bias DOUBLE"
ASN_RANGES = "start_int BIGINT, end_int BIGINT, asn INT, isp STRING, isp_country STRING, risk_bias DOUBLE"
IP_PREFIXES = "start_int BIGINT, end_int BIGINT, plen INT, asn BIGINT"
BANNER_RULES = "host_regex STRING, details_regex STRING, provider STRING, category STRING, confidence STRING"
SUFFIXES = "suffix STRING, n_labels INT, is_private BOOLEAN"

DNS_RESULTS = "domain STRING, status STRING, records_json STRING, errors_json STRING, meta_json STRING"
ENTITY_DOMAIN = (
    "domain_id BIGINT, domain STRING, apex STRING, tld STRING, first_seen_ts TIMESTAMP, last_seen_ts TIMESTAMP, "
    "source_flags STRING"
)
ENTITY_IP = "ip_id BIGINT, ip STRING, ip_version TINYINT, first_seen_ts TIMESTAMP, last_seen_ts TIMESTAMP"
ENTITY_EDGE = (
    "src_type STRING, src_id BIGINT, dst_type STRING, dst_id BIGINT, edge_type STRING, first_seen_ts TIMESTAMP, "
    "last_seen_ts TIMESTAMP, last_observed_ts TIMESTAMP, attrs STRING"
)
ACTIVITY_DELTA = (
    "domain STRING, is_active STRING, last_seen_ts STRING, dns_sig STRING, mx_regdom STRING, mx_ips STRING"
)
PTR_RESULTS = "ip STRING, ptr STRING, rcode STRING, ttl INT"
MX_HOST_RESULTS = (
    "host STRING, a_ips STRING, a_rcode STRING, a_ttl INT, aaaa_ips STRING, aaaa_rcode STRING, aaaa_ttl INT"
)
BANNERS = (
    "ts_unix BIGINT, mx_host STRING, banner_raw STRING, banner_host STRING, banner_details STRING, provider STRING, "
    "category STRING, confidence INT, error STRING, tries INT"
)

MX_RECORD = "struct<preference:int,exchange:string>"
CAA_RECORD = "struct<flags:int,tag:string,value:string>"
NAPTR_RECORD = (
    "struct<order:int,preference:int,flags:string,services:string,regexp:string,replacement:string>"
)
SRV_RECORD = (
    "struct<priority:int,weight:int,port:int,target:string,service:string,proto:string,ttl:int>"
)
SOA_RECORD = (
    "struct<mname:string,rname:string,serial:bigint,refresh:bigint,retry:bigint,expire:bigint,minimum:bigint>"
)


def _fields(kind: str, names: str) -> dict[str, str]:
    return dict.fromkeys(names.split(), kind)


# The wide per-domain profile: column -> type.
DOMAIN_PROFILE: dict[str, str] = {
    **_fields("string", "domain registered_domain ns1 soa status ns_error soa_error a_error a aaaa"),
    **_fields("bigint", "ip_int"),
    **_fields("int", "a_ttl"),
    **_fields("string", "ptr cname"),
    **_fields("array<string>", "ns_ips"),
    **_fields("bigint", "ns_ip_int"),
    **_fields("string", "mx mx_domain mx_tld"),
    **_fields("int", "mx_priority"),
    **_fields("string", "mx_host_final mx_regdom_final"),
    **_fields("array<string>", "mx_cname_chain"),
    **_fields("boolean", "mx_under_customer"),
    **_fields("array<string>", "mx_ips"),
    **_fields("string", "mx_ptr mx_ptr_regdom spf dmarc bimi www www_a"),
    **_fields("bigint", "www_int"),
    **_fields("string", "www_ptr www_cname mail_a"),
    **_fields("bigint", "mail_int"),
    **_fields("string", "mail_ptr mail_cname mail_mx mail_mx_domain mail_mx_tld mail_spf mail_dmarc"),
    **_fields("string", "mail_mx_banner_raw mail_mx_banner_host mail_mx_banner_details"),
    **_fields("string", "mail_mx_banner_provider mail_mx_banner_category"),
    **_fields("boolean", "has_mta_sts"),
    **_fields("string", "mta_sts_txt mta_sts_mode"),
    **_fields("bigint", "mta_sts_max_age"),
    **_fields("string", "mta_sts_id tlsrpt_rua"),
    **_fields("boolean", "smtp_cert_ok"),
    **_fields("int", "smtp_cert_days_left"),
    **_fields("string", "smtp_cert_issuer"),
    **_fields("boolean", "https_cert_ok"),
    **_fields("int", "https_cert_days_left"),
    **_fields("string", "https_cert_issuer"),
    **_fields("int", "https_cert_san_count"),
    **_fields("string", "mx_banner_raw mx_banner_host mx_banner_details mx_banner_provider mx_banner_category"),
    **_fields("boolean", "dnssec"),
    **_fields("bigint", "soa_serial"),
    **_fields("timestamp", "refresh_date"),
    **_fields("string", "caa naptr srv"),
    "soa_records": f"array<{SOA_RECORD}>",
    "caa_records": f"array<{CAA_RECORD}>",
    "naptr_records": f"array<{NAPTR_RECORD}>",
    "srv_records": f"array<{SRV_RECORD}>",
    **_fields("int", "aaaa_ttl mx_ttl txt_ttl caa_ttl naptr_ttl"),
}
