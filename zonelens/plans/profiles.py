"""Score profiles and how to read them from a file."""

from __future__ import annotations

import json
from typing import Any

SCORE_VERSION = "2025.10.20-rc1"


def _flag(name: str, column: str, points: int) -> dict[str, Any]:
    return {"name": name, "column": column, "points": points}


def _when(name: str, column: str, test: str, value: Any, points: int) -> dict[str, Any]:
    return {"name": name, "when": {"column": column, test: value}, "points": points}


def _network(suspicious: int, malicious: int, critical: int) -> list[dict[str, Any]]:
    points = {"suspicious": suspicious, "malicious": malicious, "critical": critical}
    return [{"name": "network_risk", "column": "asn_risk_level", "map": points}]


def _provider_trust() -> list[dict[str, Any]]:
    return [_flag("ns_provider_trust", "provider_trust_nudge", 0), _flag("mx_provider_trust", "mx_trust_nudge", 0)]


# Rules and points of the three profiles.
PROFILES: dict[str, dict[str, Any]] = {
    "default": {
        "max_score": 100,
        "min_score": 0,
        "thresholds": {"critical": 80, "high": 60, "medium": 30},
        "positive_rules": [
            _flag("phishing_hit", "is_phishing", 40),
            _flag("malware_hit", "is_malware", 30),
            _flag("newly_registered", "is_new_domain", 8),
            _flag("nameserver_changed", "ns_changed", 3),
            _flag("ip_changed", "ip_changed", 4),
            _flag("geo_changed", "country_changed", 3),
            _flag("ttl_drop_large", "ttl_drop_big", 4),
            _flag("dynamic_infra", "is_dynamic_dns", 6),
            _flag("ugc_or_platform", "is_cdn_ugc", 3),
            _flag("mx_misconfig", "mx_misconfigured_provider", 2),
            _when("self_hosted_mx_vanity", "mx_self_hosted_candidate", "equals", True, 3),
            _when("banner_unknown_when_self_hosted", "mx_banner_inferred", "equals", False, 2),
        ],
        "trust_rules": [
            *_provider_trust(),
            _when("top_100k_site", "is_top_100k", "equals", True, 12),
            _when("top_1m_site", "is_top_1m", "equals", True, 6),
            _when("banner_enterprise", "mx_banner_category", "in", ["enterprise", "seg"], 8),
        ],
        "mapped_rules": _network(2, 4, 8),
        "direct_add_columns": ["parking_points", "subdomain_points"],
        "direct_sub_columns": [],
    },
    "email_security": {
        "max_score": 100,
        "min_score": 0,
        "thresholds": {"critical": 70, "high": 50, "medium": 25},
        "positive_rules": [
            _flag("phishing_hit", "is_phishing", 35),
            _flag("malware_hit", "is_malware", 25),
            _flag("newly_registered", "is_new_domain", 10),
            _flag("spf_block", "is_spf_block", 6),
            _when("dmarc_absent", "dmarc", "equals", "", 4),
            _when("self_hosted_mx", "mx_mbp_category", "equals", "self_hosted_mail", 3),
            _when("self_hosted_mx_vanity", "mx_self_hosted_candidate", "equals", True, 4),
            _when("banner_unknown_when_self_hosted", "mx_banner_inferred", "equals", False, 3),
        ],
        "trust_rules": [
            *_provider_trust(),
            _when("top_1m_site", "is_top_1m", "equals", True, 6),
            _when("banner_enterprise", "mx_banner_category", "in", ["enterprise", "seg"], 10),
        ],
        "mapped_rules": _network(2, 4, 6),
        "direct_add_columns": ["parking_points"],
        "direct_sub_columns": [],
    },
    "cyber_threat": {
        "max_score": 100,
        "min_score": 0,
        "thresholds": {"critical": 70, "high": 45, "medium": 20},
        "positive_rules": [
            _flag("phishing_hit", "is_phishing", 45),
            _flag("malware_hit", "is_malware", 35),
            _flag("newly_registered", "is_new_domain", 10),
            _flag("dynamic_infra", "is_dynamic_dns", 8),
            _when("suspicious_subdom", "subdomain_points", "in", [6, 7, 8, 9, 10], 6),
            _flag("mx_misconfig", "mx_misconfigured_provider", 3),
        ],
        "trust_rules": _provider_trust(),
        "mapped_rules": _network(3, 6, 10),
        "direct_add_columns": ["parking_points", "subdomain_points"],
        "direct_sub_columns": [],
    },
}


def load_profiles(path: str) -> tuple[str, dict[str, Any]]:
    """Version and profiles of a JSON or YAML file; a ``default`` profile is mandatory."""
    with open(path, encoding="utf-8") as handle:
        text = handle.read()
    if path.endswith(".json"):
        config = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as err:  # the package is optional
            raise RuntimeError("reading YAML profiles needs the yaml package; JSON works without it") from err
        config = yaml.safe_load(text)
    profiles = config.get("profiles", {})
    if "default" not in profiles:
        raise ValueError("a 'default' profile is needed")
    return config.get("version", "v1.0"), profiles
