"""Property tests: the distributed upsert and dedupe against a plain model."""

from hypothesis import given, settings, strategies as st, HealthCheck

from tickwise.operators import upsert as U

KEYS = st.integers(min_value=0, max_value=6)
VAL = st.one_of(st.none(), st.integers(min_value=-3, max_value=3).map(float))
SRC = st.sampled_from(["a", "b", None])
ROWS = st.lists(st.tuples(KEYS, VAL, SRC), max_size=8, unique_by=lambda r: r[0])
SCHEMA = "k int, v double, src string"


def _model(target, batch):
    out = {k: (v, s) for k, v, s in target}
    for k, v, s in batch:
        out[k] = (v, out[k][1]) if k in out else (v, s)
    return sorted((k, v, s) for k, (v, s) in out.items())


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(ROWS, ROWS)
def test_upsert_matches_model(spark, target, batch):
    t = spark.createDataFrame(target, SCHEMA)
    b = spark.createDataFrame(batch, SCHEMA)
    got = sorted(tuple(r) for r in U.upsert(t, b, ["k"], ["v"]).collect())
    assert got == _model(target, batch)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(KEYS, VAL, SRC), max_size=10))
def test_dedupe_is_sequential_replay(spark, rows):
    seq = [(k, v, s, i) for i, (k, v, s) in enumerate(rows)]
    b = spark.createDataFrame(seq, SCHEMA + ", batch_seq int")
    got = sorted(tuple(r) for r in U.dedupe_batch(b, ["k"], ["v"]).collect())
    want = {}
    for k, v, s, _ in seq:            # executing the batch row by row
        want[k] = (v, want[k][1]) if k in want else (v, s)
    assert got == sorted((k, v, s) for k, (v, s) in want.items())
