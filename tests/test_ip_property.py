"""Quads built from known numbers, and odd texts with results written by hand."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from hitscope.functions import ip_to_long, is_ip_address, register_sql_functions

# text, is_ip_address, ip_to_long
ODD = [
    (None, False, -1), ("", False, -1), (".", False, -1), ("1", False, -1), ("1.2.3", False, -1), ("1.2.3.4.5", False, -1),
    ("1.2.3.4.", False, 16909060), ("1.2.3.4..", False, 16909060), (".1.2.3.4", False, -1), ("1..3.4", False, -1),
    ("1.2.300.4", True, 16985092), ("999.1.1.1", True, 999 * 16777216 + 65793), ("1.2.3.1000", False, 16909056 + 1000),
    ("+1.2.3.4", False, 16909060), ("1.2.3.-4", False, 16909052), ("1.2.3.4\n", True, -1), ("1.2.3.4 ", False, -1),
    ("a.b.c.d", False, -1), ("1.2.3.x", False, -1), ("0001.2.3.4", False, 16909060), ("user.example.com", False, -1),
]


def _functions(spark, hosts):
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    register_sql_functions(spark)
    return df.select("host", is_ip_address("host").alias("ip"), ip_to_long("host").alias("n")).selectExpr(
        "host", "ip", "n", "is_ip_address(host) as sql_ip", "ip_to_long(host) as sql_n").collect()


def test_odd_texts(spark):
    for r, (text, is_ip, number) in zip(_functions(spark, [t for t, _, _ in ODD]), ODD, strict=True):
        assert r.host == text and (r.ip, r.n) == (r.sql_ip, r.sql_n) == (is_ip, number), text


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(numbers=st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=60))
def test_quads_give_their_number(spark, numbers):
    quads = [".".join(str(b) for b in n.to_bytes(4, "big")) for n in numbers]
    for r, n in zip(_functions(spark, quads), numbers, strict=True):
        assert (r.ip, r.n) == (r.sql_ip, r.sql_n) == (True, n)


octet = st.integers(min_value=0, max_value=255)


@st.composite
def cidr_text(draw):
    quad = ".".join(str(draw(octet)) for _ in range(4))
    prefix = draw(st.one_of(st.none(), st.integers(min_value=0, max_value=32)))
    return quad if prefix is None else f"{quad}/{prefix}"


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(networks=st.lists(cidr_text(), min_size=1, max_size=60))
def test_cidr_matches_ipaddress(spark, networks):
    import ipaddress

    from hitscope.functions import cidr_end, cidr_start

    df = spark.createDataFrame([(n,) for n in networks], "network string")
    got = df.select("network", cidr_start("network").alias("s"), cidr_end("network").alias("e")).collect()
    for r in got:
        net = ipaddress.ip_network(r.network, strict=False)
        assert (r.s, r.e) == (int(net.network_address), int(net.broadcast_address)), r.network
