"""Every registered query against its oracle SQL on the smallest data set."""

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    verdict = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert verdict == "", verdict


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "risk_level" in df.columns


@pytest.mark.parametrize("name", [
    "attach_host_ips", "attach_ptr", "attach_subhost", "asn_longest_prefix", "asn_range", "cname_chain", "mail_policies",
    "ns_brand_substring", "ns_brand_text_reduced", "soa_parent_walk", "txt_apex_fallback", "domain_profile",
])
def test_salted_joins_match_oracle(spark, con, monkeypatch, name):
    """The same queries with nearly every key treated as a hot one."""
    from zonelens.operators import joins

    monkeypatch.setattr(joins, "HOT_ROWS", 2)
    assert compare(spark, con, name, QUERIES[name], ORACLES[name], SF) == ""
