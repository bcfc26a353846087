"""Dimensions (T5, T6, T7), lookups without fan-out, dedupe order."""

from dataclasses import replace


from dimloom.operators.dims import build_dimension, keyed_dimension, members_in_use, new_rows
from dimloom.operators.fact import LookupSpec, dedupe, lookup, prepare_events
from dimloom.plans.specs import BY_NAME, bit_compat


def test_conflict_policy(spark):
    st = spark.createDataFrame([(5, "target 5"), (5, "target other"), (1, None)], "targtype1 int, targtype1_txt string")
    spec = BY_NAME["DimTargetType"]
    one = {r.targtype1: r.TargetTypeLabel for r in build_dimension(st, spec).collect()}
    assert one == {5: "target 5", 1: "Target Type Not Given"}
    both = build_dimension(st, replace(spec, on_conflict="keep_all")).collect()
    assert len(both) == 3


def test_null_codes_left_out_and_bit_collapse(spark):
    st = spark.createDataFrame([(1.0,), (0.0,), (None,)], "doubtterr double")
    got = keyed_dimension(st, BY_NAME["DimDoubtTerrorism"]).df.orderBy("DoubtTerrorismKey").collect()
    assert [(r.DoubtTerrorismKey, r.DoubtTerrorismCode, r.Description) for r in got] == \
        [(1, 0, "No Doubt"), (2, 1, "Doubt Terrorism")]
    mult = spark.createDataFrame([(1,), (0,), (-1,)], "multiple int")
    true_codes = {r.IsMultiple for r in build_dimension(mult, BY_NAME["DimEventType"]).collect()}
    assert true_codes == {1, 0, -1}
    bits = sorted((r.IsMultiple, r.Description) for r in build_dimension(mult, bit_compat(BY_NAME["DimEventType"])).collect())
    assert bits == [(0, "Single Incident"), (1, "Multiple Incident"), (1, "Unknown")]


def test_hostage_defaults(spark):
    st = spark.createDataFrame([(None,), (7.0,), (-9.0,)], "ishostkid double")
    got = sorted((r.HostageSituationCode, r.Description) for r in build_dimension(st, BY_NAME["DimHostageSituation"]).collect())
    assert got == [(-9, "Unknown"), (2, "No Data Given"), (7, "Invalid Code")]


def test_lookup_never_fans_out(spark):
    fact = spark.createDataFrame([(10, 5), (11, None), (12, 9)], "eventid long, targtype1 int")
    dim = spark.createDataFrame([(1, 5, "a"), (2, 5, "b")], "TargetTypeKey int, targtype1 int, TargetTypeLabel string")
    spec = LookupSpec("DimTargetType", "TargetTypeKey", (("targtype1", "targtype1"),))
    got = sorted((r.eventid, r.TargetTypeKey) for r in lookup(fact, dim, spec, 2).collect())
    assert got == [(10, 1), (11, None), (12, None)]
    inner = replace(spec, how="inner", defaults={0: 9})
    assert lookup(fact, dim, inner, 2).count() == 1


def test_dedupe_then_filter_differs_from_filter_then_dedupe(spark):
    rows = [(1, 1, 0, 0.0, 2000, 2, 30), (1, 2, 0, 0.0, 2000, 2, 1), (2, 1, 0, 0.0, 2001, 1, 1)]
    st = spark.createDataFrame(rows, "eventid long, tie1 long, tie2 long, tie3 double, year int, month int, day int")
    first = {r.eventid for r in prepare_events(st, ["tie1", "tie2", "tie3"], True).collect()}
    later = {r.eventid: r.DateKey for r in prepare_events(st, ["tie1", "tie2", "tie3"], False).collect()}
    assert first == {2} and later == {1: 20000201, 2: 20010101}
    assert [r.tie1 for r in dedupe(st, "eventid", ["tie1"]).where("eventid = 1").collect()] == [1]


def test_membership_and_new_rows(spark):
    dim = spark.createDataFrame([(1, 1, 2.0), (2, 1, None), (3, 2, 5.0)], "k int, a int, lat double")
    facts = spark.createDataFrame([(1, None), (1, 2.0)], "a int, lat double")
    used = {r.k for r in members_in_use(dim, facts, [("a", "a"), ("lat", "lat")], null_as={"lat": 0.0}).collect()}
    assert used == {1, 2}                                  # NULL coordinates compare as 0
    incoming = spark.createDataFrame([(1,), (4,), (None,)], "a int")
    assert sorted((r.a is None, r.a) for r in new_rows(incoming, dim, ["a"]).collect()) == [(False, 4), (True, None)]


def test_reference_audit_counts_orphans(spark):
    from dimloom.operators.audit import reference_violations

    fact = spark.createDataFrame([(1, 10), (2, None), (99, 10), (99, 11), (None, 12)], "a int, b int")
    dim_a = spark.createDataFrame([(1,), (2,), (2,)], "ka int")          # a repeated key must not inflate counts
    dim_b = spark.createDataFrame([(10,), (11,), (12,)], "kb int")
    got = {r.fk_column: (r.checked_rows, r.null_rows, r.orphan_rows) for r in reference_violations(
        fact, [("a", "DimA", dim_a, "ka", 3), ("b", "DimB", dim_b, "kb", 3)]).collect()}
    assert got == {"a": (4, 1, 2), "b": (4, 1, 0)}
