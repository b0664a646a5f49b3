"""Request addresses against expected values written out by hand."""

import pytest

from larkspar.functions import requests

REFUSED = [
    (None, "blank"), ("  ", "blank"), ("https://a.example.com/ b", "interior_whitespace"), ("//example.com/", "scheme_missing"), ("http://", "unparsable"), ("http://:80/", "unparsable"),
    ("http://example.com:99999/", "unparsable"), ("http://example.com:8a/", "unparsable"), ("http://1.2.3.4.5/", "unparsable"), ("http://256.1.1.1/", "unparsable"), ("http://exa%zzmple.com/", "unparsable"),
    ("javascript:alert(1)", "scheme_not_http"), ("ftp://", "unparsable"), ("ftp://example.com/", "scheme_not_http"), ("http://me@example.com/", "userinfo_present"), ("http://example.com/#x", "fragment_present"),
    ("http://example.com../", "host_empty_label"), ("http://[::1]/", "host_is_ip_literal"), ("http://127.1/", "host_is_ip_literal"), ("http://017700000001/", "host_is_ip_literal"), ("http://1.2.3.4./", "host_is_ip_literal"),
    ("http://localhost/", "host_without_dot"), ("http://a.invalid/", "no_icann_public_suffix"), ("http://example.com:80/", "explicit_port"), ("http://example.com:/", "explicit_port"), ("http:/example.com:8080", "explicit_port"),
]
TAKEN = [
    (" HTTP://WWW.Example.COM. ", "http://www.example.com/", "example.com", "/"), (r"https:\\example.org\a\b", "https://example.org/a/b", "example.org", "/a/b"),
    ("https://x.example.co.uk/a/./b/../c?q=1", "https://x.example.co.uk/a/c?q=1", "example.co.uk", "/a/c?q=1"), ("http:example.com/..", "http://example.com/", "example.com", "/"),
    ("http://example.com/é?é", "http://example.com/%C3%A9?%C3%A9", "example.com", "/%C3%A9?%C3%A9"), ("http://example.com/a/%2E%2e/b/.", "http://example.com/b/", "example.com", "/b/"),
]
RESOLVED = [
    ("https://a.example.com/x/y?q", "z", "https://a.example.com/x/z"), ("https://a.example.com/x/y?q", "", "https://a.example.com/x/y?q"), ("https://a.example.com/x/y?q", "#f", "https://a.example.com/x/y?q"),
    ("https://a.example.com", "b#f", "https://a.example.com/b"), ("https://a.example.com/x/", "../../up", "https://a.example.com/up"), ("https://a.example.com/x", "//B.example.com", "https://b.example.com/"),
    ("https://a.example.com/x", "https:y", "https://a.example.com/y"), ("https://a.example.com:8443/x", "/y", "https://a.example.com:8443/y"),
    ("https://a.example.com/x", "tel:+1", "tel:+1"), ("https://a.example.com/x", "http://[", None), ("https://a.example.com/x", None, None), (None, "/x", None),
]


@pytest.mark.parametrize("cases", [REFUSED])
def test_refusals(spark, cases):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, raw string")
    got = {r.i: (r.request.reason, r.request.url) for r in requests.with_request(df, "raw").collect()}
    assert [got[i] for i in range(len(cases))] == [(c[1], None) for c in cases]


def test_taken(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(TAKEN)], "i int, raw string")
    rows = {r.i: r.request for r in requests.with_request(df, "raw").collect()}
    assert [(rows[i].reason, rows[i].url, rows[i].domain, rows[i].path) for i in range(len(TAKEN))] == [(None, *c[1:]) for c in TAKEN]


def test_resolved(spark):
    cases = RESOLVED
    df = spark.createDataFrame([(i, *c[:2]) for i, c in enumerate(cases)], "i int, page string, href string")
    rows = {r.i: r.resolved for r in requests.with_resolved(df, "page", "href").collect()}
    assert [rows[i] for i in range(len(cases))] == [c[2] for c in cases]


def test_canonical_component(spark):
    df = spark.createDataFrame([("/%7Efoo%2fbar%",), ("/é*$ \"",), ("",)], "x string")
    assert [r[0] for r in df.select(requests.canonical_component(df.x)).collect()] == ["/~foo%2Fbar%25", "/%C3%A9*$%20%22", ""]
