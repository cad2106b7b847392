"""Stream = batch: W1-W4 fed in time-ordered parts equal the same functions on the
bounded frame (no row is behind the watermark when parts arrive in time order)."""

import uuid

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from hitscope.operators.cleaning import clean
from hitscope.operators.enrich import enrich
from hitscope.operators.geo import geolocate, index_ranges
from hitscope.operators.windows import WINDOWED
from hitscope.plans.streams import StreamRun

RAW = "idx string, host string, time string, method string, url string, response string, bytes string"
RANGES = ("ip_start long, ip_end long, country_name string, continent_name string, "
          "country_iso_code string, continent_code string")
T0 = 1704067200

row = st.tuples(
    st.sampled_from(["10.0.0.1", "10.0.1.2", "10.1.0.3", "host.example.com", "", "192.0.2.9"]),
    st.integers(min_value=0, max_value=4 * 3600),
    st.sampled_from(["GET", "POST"]),
    st.sampled_from(["/shuttle/a", "/images/b", "/", "  ", "/x"]),
    st.sampled_from(["200", "302", "404", "500", "abc"]),
    st.sampled_from(["", "10", "2048"]),
)


@settings(max_examples=2, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, min_size=1, max_size=40), cut=st.floats(min_value=0.2, max_value=0.8))
def test_windowed_stream_equals_batch(spark, scratch, rows, cut):
    ranges = index_ranges(spark.createDataFrame(
        [(167772160, 167772415, "A", "Europe", "AA", "EU"), (167837696, 167903231, "B", "Asia", "BB", "AS")],
        RANGES))
    raw = spark.createDataFrame(
        [(str(i), h, str(T0 + t), m, u, r, b) for i, (h, t, m, u, r, b) in enumerate(rows)], RAW)
    split = T0 + int(cut * 4 * 3600)
    first, second = raw.where(f"cast(time as long) < {split}"), raw.where(f"cast(time as long) >= {split}")
    bounded = enrich(geolocate(clean(raw), ranges))
    for name, (fn, _keys) in WINDOWED.items():
        run = StreamRun(f"{scratch}/prop-{uuid.uuid4().hex}")
        run.add_input(first)
        run.run(spark, name, ranges)
        run.add_input(second)
        run.run(spark, name, ranges)
        expected = sorted(tuple(r) for r in fn(bounded).collect())
        got = sorted(tuple(r) for r in run.latest(spark, name).collect())
        assert got == expected, name
