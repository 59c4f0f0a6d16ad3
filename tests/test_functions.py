"""Column functions on literal rows, against plain Python where that is the yardstick."""

import ipaddress
import math
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from zonelens.functions import banners as B
from zonelens.functions import dga as D
from zonelens.functions import hosts as H
from zonelens.functions import identity as ID
from zonelens.functions import ips as I
from zonelens.functions import policies as P
from zonelens.functions import records as R
from zonelens.operators.normalize import normalize_hosts


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, s {kind}")
    return [r.o for r in df.select("i", expr(F.col("s")).alias("o")).orderBy("i").collect()]


def test_clean_domain(spark):
    given_ = ["  Example.COM. ", "a..", "\t\n", None, "x"]
    assert column(spark, given_, H.clean_domain) == ["example.com", "a", None, None, "x"]


def test_hosts_against_idna(spark):
    idna = pytest.importorskip("idna")
    hosts = ["München.de", "_dmarc.Example.COM.", "a--b..-c-", "straße.de", "例え.jp", "x" * 70 + ".com", "a b.c", "", None, "..."]

    def plain(host):
        out = []
        for label in (host or "").strip().strip(".").split("."):
            if not label:
                continue
            try:
                out.append(idna.encode(label, uts46=True, std3_rules=False).decode())
            except idna.IDNAError:
                kept = "".join(c for c in label if c.isascii() and (c.isalnum() or c == "-")).strip("-")[:63].strip("-")
                out += [kept] if kept else []
        return ".".join(out).lower()

    df = spark.createDataFrame([(i, h) for i, h in enumerate(hosts)], "i int, host string")
    got = [r.host for r in normalize_hosts(df, ["host"]).orderBy("i").collect()]
    assert got == [plain(h) for h in hosts]
    assert got[0] == "xn--mnchen-3ya.de"


def test_ascii_hosts_label_by_label(spark):
    rng = random.Random(9)
    hosts = ["", None, "...", "-", "a.-.b", "-a-..-b-.", "x" * 63 + "-" + "y.Z", "w" * 62 + "--q.c", "\x00a_b.\tc\n", "a\n", "é-ü.É-x"]
    hosts += ["".join(rng.choices("aB9-._, \n\x7f", k=rng.randint(1, 12))) for _ in range(3000)]
    hosts += [".".join("".join(rng.choices("aB9-_", k=rng.randint(55, 75))) for _ in range(2)) for _ in range(300)]

    def plain(host):
        kept = ["".join(c for c in x if c.isascii() and (c.isalnum() or c == "-")) for x in (host or "").split(".")]
        return ".".join(filter(None, (x.strip("-")[:63].strip("-") for x in kept))).lower()

    assert column(spark, hosts, H.ascii_host) == [plain(h) for h in hosts]


def test_hosts_run_as_generated_code_without_lambdas(spark):
    df = spark.createDataFrame([("A.b",)], "host string")
    plan = normalize_hosts(df, ["host"])._jdf.queryExecution().toString()
    assert "lambda" not in plan and "translate(" in plan


def test_hosts_of_documents_against_idna(spark):
    import __spark_entry__ as entry

    idna = pytest.importorskip("idna")
    sf = "/root/testdata/sf0.001"
    got = {(r.doc_id, r["at"]): r.host for r in entry.queries()["normalize_hosts_idna"](spark, sf).collect()}
    words = F.posexplode(F.regexp_extract_all("text", F.lit(r"\S+"), F.lit(0))).alias("at", "word")
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", words).collect()
    assert len(got) == len(rows) > 10_000
    for doc_id, at, word in rows:
        labels = []
        for label in f"{word}.Example.com".strip(".").split("."):
            try:
                labels.append(idna.encode(label, uts46=True, std3_rules=False).decode() if label else "")
            except idna.IDNAError:
                labels.append("".join(c for c in label if c.isascii() and (c.isalnum() or c == "-")).strip("-")[:63].strip("-"))
        assert got[doc_id, at] == ".".join(x for x in labels if x).lower()


def test_prefixes_mask_one_group_and_plain_ones_take_no_lambda(spark):
    rng = random.Random(14)
    given_, expected = [], []
    for _ in range(1500):
        bits = rng.choice([32, 128])
        number = rng.getrandbits(bits) & rng.getrandbits(bits) & (rng.getrandbits(bits) << rng.randrange(bits))
        plen = rng.randint(0, bits)
        kind = ipaddress.IPv4Address if bits == 32 else ipaddress.IPv6Address
        address = kind(number % 2**bits)
        given_.append(f" {rng.choice([address.exploded.upper(), address.compressed])}/{plen}")
        expected.append(ipaddress.ip_network(f"{address}/{plen}", strict=False).compressed)
    assert column(spark, given_, I.canonical_prefix) == expected
    df = spark.createDataFrame([("1.2.3.4/8",)], "c string").select(I.canonical_prefix(F.col("c")))
    plan = df._jdf.queryExecution().toString()
    assert "shiftleft" in plan and "exists(" not in plan


def test_txt(spark):
    assert column(spark, ['"a"', ' "b" ', '"', '""', "C", None], H.normalize_txt) == ["a", "b", '"', "", "C", ""]


def test_ns_text(spark):
    text = ["NS1.a.net.|ns2.b.net, ns1.A.net\nns3.c.net", "", None, " | , "]
    assert column(spark, text, H.ns_list) == [["ns1.a.net", "ns2.b.net", "ns3.c.net"], [], [], []]
    assert column(spark, text[:1], H.raw_tokens) == [["NS1.a.net", "ns2.b.net", "ns1.A.net", "ns3.c.net"]]


ADDRESSES = [
    "1.2.3.4", "255.255.255.255", "256.1.1.1", "01.2.3.4", "::1", "::", "2001:0db8:0:0:0:0:0:1", "2001:DB8::1", "1:2:3:4:5:6:7:8",
    "1:2:3:4:5:6:7::", "1::2::3", "12345::", "1:2:3", "fe80:0:0:1:0:0:0:1", "a:0:0:b:0:0:c:d", "", "abc", "1:0:0:0:5:6:7:8",
    "0:0:1::", ":1:2:3:4:5:6:7", " 9.8.7.6 ", "1.2.3", "::1.2.3.4", "1:2:3:4:5:6:1.2.3.4", "1:2:3:4:5:6:7:8::", "1.2.3.4:5", "::g",
]


def test_addresses_against_ipaddress(spark):
    made = random.Random(3)
    v6 = [ipaddress.IPv6Address(made.getrandbits(128) & made.getrandbits(128) & made.getrandbits(128)) for _ in range(200)]
    texts = ADDRESSES + [str(a) for a in v6] + [a.exploded for a in v6]

    def parsed(s):
        try:
            return ipaddress.ip_address(s.strip())
        except ValueError:
            return None

    want = [parsed(s) for s in texts]
    assert column(spark, texts, I.ip_version) == [a and a.version for a in want]
    assert column(spark, texts, I.canonical_ip) == [a.compressed if a else s.strip() for a, s in zip(want, texts)]
    assert column(spark, texts, I.reverse_pointer) == [a and a.reverse_pointer for a in want]
    assert column(spark, texts, I.ipv4_to_int) == [int(a) if a and a.version == 4 else None for a in want]
    lists = [[s, "nope"] for s in texts]
    assert column(spark, lists, I.valid_ips, "array<string>") == [[s.strip()] if a else [] for a, s in zip(want, texts)]


def test_prefixes_against_ipaddress(spark):
    texts = ["1.2.3.4/24", "10.0.0.1/8", "1.2.3.4", "2001:db8::1/32", "2001:db8:ffff::/33", "::/0", "1.2.3.4/33", "x/1", "0.0.0.0/0",
             "2001:db8::1", "255.1.2.3/31", "fe80::1/10"]

    def plain(s):
        try:
            return str(ipaddress.ip_network(s, strict=False))
        except ValueError:
            return s

    assert column(spark, texts, I.canonical_prefix) == [plain(s) for s in texts]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="abcde0123-", max_size=24), min_size=1, max_size=30))
def test_entropy_and_shares(words):
    from zonelens.session import local_session

    spark = local_session("tests")

    def plain(s):
        return -sum(c / len(s) * math.log2(c / len(s)) for c in Counter(s).values()) if s else 0.0

    got = column(spark, words, D.entropy)
    assert all(abs(a - plain(s)) < 1e-9 for a, s in zip(got, words))
    digits = column(spark, words, lambda c: D.share_of(c, "0123456789"))
    assert all(abs(a - (sum(x.isdigit() for x in s) / len(s) if s else 0)) < 1e-12 for a, s in zip(digits, words))


@pytest.mark.parametrize("host, regdom, depth, longest", [
    ("a.b.example.com", "example.com", 2, 1),
    ("example.com", "example.com", 0, 0),
    ("notexample.com", "example.com", 1, 3),
    ("mail.other.net", "example.com", 1, 5),
    ("other.net", "example.com", 0, 5),
    ("www.example.com.", "example.com", 1, 7),
    ("x.example.com", "", 0, 0),
    (None, "example.com", 0, 0),
    (" WWW.Example.com ", "EXAMPLE.com", 1, 3),
])
def test_subdomain_shape(spark, host, regdom, depth, longest):
    df = spark.createDataFrame([(host, regdom)], "h string, rd string")
    labels = D.subdomain_labels(D.tidy_host(F.col("h")), D.tidy_host(F.col("rd")))
    row = df.select(D.subdomain_depth(labels).alias("d"), D.subdomain_max_label(labels).alias("m")).first()
    assert (row.d, row.m) == (depth, longest)


def test_second_level_label(spark):
    assert column(spark, ["example.co.uk", " Foo.com.", "", None, "com", ".x.y"], D.second_level_label) == [
        "example", "foo", "", "", "com", "x"]


def test_points(spark):
    df = spark.range(1)

    def points(*v):
        return df.select(D.dga_points(*[F.lit(x) for x in v]).alias("p")).first().p

    assert points(0.0, 0, 0.0, 1.0, 0, 0) == 0
    assert points(4.1, 21, 0.31, 0.1, 5, 25) == 10
    assert points(4.0, 16, 0.30, 0.2, 3, 18) == 3 + 2 + 2 + 1
    assert points(3.5, 15, 0.0, 0.19, 2, 17) == 1


def test_mx(spark):
    items = [["10:mx1.", "mx2.", "x:y", "5:a", "5:b"], [], None]
    got = column(spark, items, lambda c: R.parse_mx(c), "array<string>")
    assert [tuple(m) for m in got[0]] == [(10, "mx1"), (None, "mx2"), (None, "x:y"), (5, "a"), (5, "b")]
    assert got[1] == [] and got[2] is None
    best = column(spark, items, lambda c: R.primary_mx(R.parse_mx(c, 7)), "array<string>")
    assert tuple(best[0]) == (5, "a") and best[1] is None
    ordered = column(spark, items[:1], lambda c: R.sort_mx(R.parse_mx(c, 7)), "array<string>")
    assert [m.exchange for m in ordered[0]] == ["a", "b", "mx2", "x:y", "mx1"]


def test_srv_caa_naptr_soa(spark):
    srv = column(spark, [["1 2 3 t.x.", "odd 1.", "5"]], lambda c: R.parse_srv(c, F.lit("_sip._tcp.x.org"), F.lit(9)), "array<string>")
    assert [tuple(r) for r in srv[0]] == [
        (1, 2, 3, "t.x", "_sip", "_tcp", 9), (None, None, None, "odd 1", "_sip", "_tcp", 9),
        (None, None, None, "5", "_sip", "_tcp", 9)]
    caa = column(spark, [['0 issue "le.org"', "1 iodef x", "7"]], R.parse_caa, "array<string>")
    assert [tuple(r) for r in caa[0]] == [(0, "issue", "le.org"), (1, "iodef", "x"), (None, "", "7")]
    naptr = column(spark, [['100 50 "s" "z+N" "" c.example.com.', "bad."]], R.parse_naptr, "array<string>")
    assert [tuple(r) for r in naptr[0]] == [(100, 50, "s", "z+N", "", "c.example.com"), (None, None, "", "", "", "bad")]
    soa = column(spark, ["ns1.x. host.x. 2024 7200 x 3 4", ""], R.parse_soa)
    assert tuple(soa[0]) == ("ns1.x", "host.x", 2024, 7200, None, 3, 4)
    assert tuple(soa[1])[2:] == (None,) * 5


def test_banner_shapes(spark):
    texts = ["220 mail.foo.com ESMTP Postfix", "  220 MX.google.com smtp gv21 - gsmtp", "220 host hello", "220-out.example.com ESMTP",
             "220 h", "554 no", "", None]
    anchored = list(zip(column(spark, texts, lambda c: B.parse_banner(c)[0]), column(spark, texts, lambda c: B.parse_banner(c)[1])))
    assert anchored == [("mail.foo.com", "Postfix"), ("MX.google.com", "gv21 - gsmtp"), (None, None), (None, None), ("h", ""),
                        (None, None), (None, None), (None, None)]
    loose = column(spark, texts, lambda c: B.parse_banner(c, anchored=False)[0])
    assert loose[2] == "host"
    line = column(spark, ["x\r\n 220 a \r\n220 b", "none", None], B.banner_line)
    assert line == ["220 a", None, None]


def test_fingerprints(spark):
    df = spark.createDataFrame([("mx.google.com", "gsmtp"), ("x.org", "opensmtpd"), ("a.mail.protection.outlook.com", ""), ("q", "")],
                               "h string, d string")
    hit = B.first_match(B.FINGERPRINTS, F.col("h"), F.col("d"), ("Unknown", "unknown", 0), ignore_case=False)
    assert [tuple(r.v) for r in df.select(hit.alias("v")).collect()] == [
        ("Google Workspace", "enterprise", 95), ("OpenSMTPD", "self_hosted", 70), ("Microsoft 365 (EOP)", "enterprise", 95),
        ("Unknown", "unknown", 0)]
    named = df.select(B.infer_provider(F.col("h"), F.col("d")).alias("v")).collect()
    assert [r.v.provider for r in named] == ["Google Workspace", None, "Microsoft 365", None]


def test_policies(spark):
    assert column(spark, ["v=mta-sts: id=a1; x", "v=STSv1; id=b2;", None], P.mta_sts_id) == ["a1", None, None]
    assert column(spark, ["v=STSv1; id=b2;"], lambda c: P.mta_sts_id(c, strict=True)) == ["b2"]
    assert column(spark, ["v=TLSRPTv1; rua=mailto:x", "v=tlsrpt1; rua= y ;z", None], P.tlsrpt_rua) == [
        "v=TLSRPTv1; rua=mailto:x", "y", ""]
    body = "version: STSv1\nmode: Testing\nmax_age: 604800\n"
    assert column(spark, [body, None], P.mta_sts_mode) == ["testing", ""]
    assert column(spark, [body, "max_age: x"], P.mta_sts_max_age) == [604800, None]


def test_certificate_days(spark):
    now = F.lit("2024-06-10 12:00:00").cast("timestamp")
    empty = F.array().cast("array<struct<k:string,v:string>>")
    days = column(
        spark, ["Jun 11 12:00:00 2024 GMT", "Jun  1 12:00:00 2024 GMT", "Jun 10 11:59:59 2024 GMT", "junk", None],
        lambda c: P.certificate_features(c, empty, F.lit(None).cast("array<string>"), now)["days_left"])
    assert days == [1, -9, -1, None, None]


def test_signature_and_keys(spark):
    import hashlib

    df = spark.createDataFrame([("n", None, "m")], "ns string, a string, mx string")
    got = df.select(ID.dns_signature(F.col("ns"), F.col("a"), F.col("mx")).alias("s")).first().s
    assert got == "sha1:" + hashlib.sha1(b"n||m").hexdigest()
    pairs = [("2001:db8::1", "2001:0db8:0:0:0:0:0:1"), ("1.2.3.4", " 1.2.3.4")]
    for left, right in pairs:
        ids = column(spark, [left, right], lambda c: ID.entity_id("ip", c))
        assert ids[0] == ids[1]
    assert column(spark, ["AB:CD ef"], lambda c: ID.entity_key("cert", c)) == ["abcdef"]
    with pytest.raises(ValueError):
        ID.entity_key("nope", F.lit(1))
