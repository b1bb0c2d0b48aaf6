"""Property tests: operators against brute force in plain Python on random small tables."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from qualia.operators.metrics import Completeness, CountDistinct, Distinctness, Size, Uniqueness, run_metrics
from qualia.operators.profile import profile
from qualia.operators.validate import rule_metrics

ROWS = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(-3, 4)), st.one_of(st.none(), st.sampled_from(["a", "b", "c", ""]))),
    max_size=25,
)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _ratio(a, b):
    return a / b if b else None


@SETTINGS
@given(rows=ROWS)
def test_metrics_match_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "x int, s string")
    got = {(r.instance, r.name): r.value for r in run_metrics(df, [
        Size(), Completeness("x"), Distinctness("x"), Uniqueness("x"), CountDistinct("s"), Uniqueness(["x", "s"]),
    ]).collect()}
    n = len(rows)
    xs = [x for x, _ in rows if x is not None]
    cx = Counter(xs)
    pairs = Counter(r for r in rows if r[0] is not None or r[1] is not None)
    want = {
        ("*", "Size"): float(n),
        ("x", "Completeness"): _ratio(len(xs), n),
        ("x", "Distinctness"): _ratio(len(cx), len(xs)),
        ("x", "Uniqueness"): _ratio(sum(1 for v in cx.values() if v == 1), len(xs)),
        ("s", "CountDistinct"): float(len({s for _, s in rows if s is not None})),
        ("x,s", "Uniqueness"): _ratio(sum(1 for v in pairs.values() if v == 1), sum(pairs.values())),
    }
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] is None if v is None else abs(got[k] - v) < 1e-12, k


@SETTINGS
@given(rows=ROWS)
def test_profile_frequencies_and_ties(spark, rows):
    df = spark.createDataFrame(rows, "x int, s string")
    got = {r.column_names: r for r in profile(df).collect()}
    for i, c in enumerate(["x", "s"]):
        counts = Counter(None if r[i] is None else str(r[i]) for r in rows)
        p = got[c]
        assert p.num_rows == len(rows)
        assert p.num_distinct == len(counts)
        if not counts:
            assert p.most_freq_value is None and p.most_freq_value_count == 0
            continue
        order = lambda kv, sign: (sign * kv[1], (0, "") if kv[0] is None else (1, kv[0]))
        most = min(counts.items(), key=lambda kv: order(kv, -1))
        least = min(counts.items(), key=lambda kv: order(kv, 1))
        assert (p.most_freq_value, p.most_freq_value_count) == most
        assert (p.least_freq_value, p.least_freq_value_count) == least
    assert got["s"].num_blank == sum(1 for _, s in rows if s == "")
    assert got["x"].num_null == sum(1 for x, _ in rows if x is None)


@SETTINGS
@given(rows=ROWS)
def test_rule_counts_partition_the_rows(spark, rows):
    df = spark.createDataFrame(rows, "x int, s string")
    rules = [{"element": "x", "rule": "x > 0", "rule_name": "pos", "slo": "ge(50)"},
             {"element": "s", "rule": "s in ('a', 'b')", "rule_name": "ab", "slo": "gt(10)"}]
    got = {r.rule_name: r for r in rule_metrics(df, rules).collect()}
    for name, i, pred in (("pos", 0, lambda v: v > 0), ("ab", 1, lambda v: v in ("a", "b"))):
        r = got[name]
        vals = [row[i] for row in rows]
        succ = sum(1 for v in vals if v is not None and pred(v))
        fail = sum(1 for v in vals if v is not None and not pred(v))
        nulls = sum(1 for v in vals if v is None)
        assert (r.success_count, r.failure_count, r["count"]) == (succ, fail, len(rows))
        assert r.success_count + r.failure_count + nulls == r["count"]
        if rows:
            # exact half-up rounding of 100 * succ / n to 2 places
            assert r.pass_percentage == ((20000 * succ + len(rows)) // (2 * len(rows))) / 100.0
        else:
            assert r.pass_percentage is None and r.constraint_status is None
