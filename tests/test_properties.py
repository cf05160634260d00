"""Random small inputs against plain Python."""

from collections import Counter, defaultdict
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from minutefold.operators import events_with_series, resample_mean, series_with_events
from minutefold.streaming import replace_days, upsert

T0 = datetime(2024, 12, 31, 23, 58)
FEW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
keys = st.sampled_from(["a", "b", None])
numbers = st.one_of(st.none(), st.integers(-5, 5))


def at(second):
    return T0 + timedelta(seconds=second)


def minute(ts):
    return ts.replace(second=0)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@FEW
@given(st.lists(st.tuples(keys, st.integers(0, 1500), numbers), max_size=15))
def test_dense_resample(spark, data):
    df = spark.createDataFrame(
        [(k, at(s), v) for k, s, v in data], "k string, ts timestamp_ntz, v int"
    )
    held = defaultdict(lambda: defaultdict(list))
    for k, s, v in data:
        if k is not None:
            held[k][minute(at(s))].append(v)
    want = Counter()
    for k, bins in held.items():
        here = min(bins)
        while here <= max(bins):
            present = [v for v in bins.get(here, []) if v is not None]
            want[(k, here, sum(present) / len(present) if present else None)] += 1
            here += timedelta(minutes=1)
    assert bag(resample_mean(df, ["k"], "ts", ["v"])) == want


@FEW
@given(
    st.lists(st.tuples(keys, st.integers(0, 3)), max_size=6, unique=True),
    st.lists(st.tuples(keys, st.integers(0, 240), numbers), max_size=12),
)
def test_bin_joins(spark, bins, logged):
    series = spark.createDataFrame(
        [(k, minute(at(60 * m)), m) for k, m in bins], "k string, ts timestamp_ntz, v int"
    )
    events = spark.createDataFrame(
        [(k, at(s), e) for k, s, e in logged], "k string, at timestamp_ntz, e int"
    )
    held = [(k, minute(at(60 * m)), m) for k, m in bins]
    log = [(k, at(s), e) for k, s, e in logged]

    def meet(k, ts, j, when):
        return k is not None and k == j and ts == minute(when)

    by_bin, by_event = Counter(), Counter()
    for k, ts, v in held:
        found = [e for j, when, e in log if meet(k, ts, j, when)]
        by_bin.update((k, ts, v, e) for e in found or [None])
    for j, when, e in log:
        found = [v for k, ts, v in held if meet(k, ts, j, when)]
        by_event.update((j, when, e, v) for v in found or [None])
    assert bag(series_with_events(series, events, ["k"], "ts", "at")) == by_bin
    assert bag(events_with_series(events, series, ["k"], "at", "ts")) == by_event


pairs = st.lists(st.tuples(keys, st.integers(0, 2), numbers), max_size=10)


@FEW
@given(pairs, pairs)
def test_upsert(spark, old, new):
    schema = "k string, j int, v int"
    target, batch = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    known = {(k, j) for k, j, _ in new if k is not None}
    want = Counter(r for r in old if r[:2] not in known) + Counter(new)
    once = upsert(target, batch, ["k", "j"])
    assert bag(once) == want


@FEW
@given(
    st.lists(st.tuples(st.integers(0, 4), numbers), min_size=1, max_size=10),
    st.lists(st.tuples(st.integers(0, 6), numbers), max_size=10),
)
def test_replace_days(spark, old, new):
    def frame(data):
        days = [((T0 + timedelta(days=d)).date(), v) for d, v in data]
        return spark.createDataFrame(days, "day date, v int"), days

    (target, was), (batch, now) = frame(old), frame(new)
    mark = max(d for d, _ in was)
    fresh = Counter(r for r in now if r[0] >= mark)
    want = Counter(r for r in was if r[0] not in {d for d, _ in fresh}) + fresh
    assert bag(replace_days(target, batch, "day")) == want
