"""Laws that hold for any input."""

from helpers import unordered
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from trilode.operators import clean, fused_groups, group_table, row_accounting, rows_of
from trilode.spec import AggSpec, CleaningSpec, GroupSpec, RuleSpec

SCHEMA = "k string, n string, v double"
ROW = st.tuples(
    st.sampled_from(["a", "b", None]),
    st.sampled_from(["1", "2.9", "-3", "x", "", None]),
    st.sampled_from([0.5, -1.0, 2.0, float("nan"), None]),
)
FEW = settings(max_examples=8, deadline=None, derandomize=True,
               suppress_health_check=[HealthCheck.function_scoped_fixture])

SPEC = CleaningSpec(
    type_fixes={"n": "try_cast(try_cast(n AS DOUBLE) AS INT)"},
    null_drop=["v"],
    null_fill={"n": "0"},
    rules=[RuleSpec("n", "n >= 0"), RuleSpec("v", "v < 2")],
    dedup_keys=["k", "n"],
)
SUM = AggSpec("v", "sum", "total")
GROUPS = (
    GroupSpec("by_k", [SUM, AggSpec("*", "count", "rows")], ["k"]),
    GroupSpec("by_n", [AggSpec("v", "max", "most")], ["n"]),
    GroupSpec("by_both", [SUM], ["n", "k"]),
)


@FEW
@given(st.lists(ROW, max_size=30))
def test_every_row_is_accounted_for(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    silver = clean(df, SPEC)
    account = row_accounting(df, SPEC).first()
    assert account.bronze == len(data)
    assert account.silver == silver.count()
    assert account.bronze == (account.null_dropped + account.rule_failed + account.duplicates
                              + account.silver)
    assert silver.filter("v IS NULL OR isnan(v) OR n < 0").isEmpty()
    assert silver.select("k", "n").distinct().count() == account.silver


@FEW
@given(st.lists(ROW, max_size=30), st.integers(1, 9))
def test_one_pass_gives_the_same_groups(spark, data, partitions):
    df = spark.createDataFrame(data, SCHEMA)
    fused = fused_groups(df.repartition(partitions), GROUPS)
    for group in GROUPS:
        assert repr(unordered(rows_of(fused, GROUPS, group))) == repr(
            unordered(group_table(df, group)))
