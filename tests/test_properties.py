"""Property tests against brute-force models on small generated inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.operators.cleaning import drop_duplicates
from strata.operators.schema import enforce_schema
from strata.operators.upsert import upsert_frames

keys = st.one_of(st.none(), st.integers(0, 6))
rows = st.lists(st.tuples(keys, st.integers(0, 99)), max_size=12)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _unique_keys(pairs):
    seen, out = set(), []
    for k, v in pairs:
        if k is None or k not in seen:
            out.append((k, v))
            seen.add(k)
    return out


@SETTINGS
@given(target=rows, source=rows)
def test_upsert_matches_dict_model(spark, target, source):
    target, source = _unique_keys(target), _unique_keys(source)
    t = spark.createDataFrame([(k, v, f"t{v}") for k, v in target], "k int, v int, t_only string")
    s = spark.createDataFrame([(k, v, f"s{v}") for k, v in source], "k int, v int, s_only string")
    got = sorted((tuple(r) for r in upsert_frames(t, s, "k").collect()), key=repr)

    model = {}
    for k, v in target:
        model.setdefault(("t", k) if k is None else k, []).append((k, v, f"t{v}", None))
    for k, v in source:
        if k is None:
            model.setdefault(("s", None), []).append((None, v, None, f"s{v}"))
        elif k in model:
            (_, _, t_only, _), = model[k]
            model[k] = [(k, v, t_only, f"s{v}")]
        else:
            model[k] = [(k, v, None, f"s{v}")]
    want = sorted((r for group in model.values() for r in group), key=repr)
    assert got == want


@SETTINGS
@given(data=st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3), st.text("ab", max_size=2)), max_size=20))
def test_dedup_is_partitioning_independent(spark, data):
    df = spark.createDataFrame(data, "k int, v int, s string")
    results = {
        n: sorted(tuple(r) for r in drop_duplicates(df.repartition(n), ["k"]).collect()) for n in (1, 3, 7)
    }
    assert results[1] == results[3] == results[7]
    # the survivor is the smallest (v, s) of its key
    want = {}
    for k, v, s in data:
        want[k] = min(want.get(k, (v, s)), (v, s))
    assert results[1] == sorted((k, v, s) for k, (v, s) in want.items())


def test_missing_required_column_fails_under_fail(spark):
    df = spark.createDataFrame([(1,)], "other int")
    import pytest

    with pytest.raises(ValueError, match="non-nullable column"):
        enforce_schema(df, [("id", "string", False)], "fail")
    out, report = enforce_schema(df, [("id", "string", False)], "warn")
    assert report.missing == ["id"] and out.columns == []
