import datetime as dt

from pagemill.operators.orphans import document_references, orphan_references, orphans_by_period

A, B, C = "aaaaaaaa-0000-4000-8000-000000000001", "bbbbbbbb-0000-4000-8000-000000000002", "cccccccc-0000-4000-8000-000000000003"
T = [dt.datetime(2025, m, 1) for m in range(1, 7)]
REF = "ref_table string, ref_field string, ref_key string, target_table string, key string, made_at timestamp"
TARGET = "target_table string, key string, arrived_at timestamp, deleted_at timestamp"


def found(spark, refs, targets):
    df = orphan_references(spark.createDataFrame([("t", "f", *r) for r in refs], REF + ", code int"), spark.createDataFrame(targets, TARGET + ", k int"))
    return {(r.ref_key, r.reason) for r in df.collect()}


def test_reasons_spellings_and_nothing(spark):
    targets = [("e", A, T[0], None, 1), ("e", A, T[0], None, 1), ("e", "{" + B.upper() + "}", T[2], T[4], 1)]
    refs = [("ok", "e", "urn:uuid:" + A, T[1], 0), ("late", "e", B.replace("-", ""), T[1], 0), ("at", "e", B, T[4], 0), ("gone", "e", C, T[1], 0), ("null", "e", None, T[1], 0), ("blank", "e", "  ", T[1], 0), ("zero", "e", "00000000-0000-0000-0000-000000000000", T[1], 0), ("odd", "e", "x1", T[1], 0), ("gone", "e", C, T[1], 0), ("untimed", "e", B, None, 0), ("other", "r", A, T[1], 0)]
    assert found(spark, refs, targets) == {("late", "late"), ("at", "deleted"), ("gone", "missing"), ("odd", "missing"), ("other", "missing")}


def test_hot_key_and_empty_tables(spark):
    refs = [(str(i), "e", A if i % 3 else C, T[0], 0) for i in range(3000)]
    assert len(found(spark, refs, [("e", A, T[1], None, 1)])) == 3000
    assert found(spark, [], []) == set()
    assert found(spark, refs[:2], []) == {("0", "missing"), ("1", "missing")}


def test_runs_against_brute_force(spark):
    import random

    rnd = random.Random(1)
    key = lambda: f"{rnd.randrange(200):08x}-0000-4000-8000-000000000000"
    parents = {key() for _ in range(90)} - {"00000000-0000-4000-8000-000000000000"}
    refs = [(str(i), "e", key(), T[1], 0) for i in range(400)]
    want = {(r[0], "missing") for r in refs if r[2] not in parents}
    assert found(spark, refs, [("e", p, T[0], None, 0) for p in parents]) == want


def test_document_tables(spark):
    records = spark.createDataFrame([(A, B, T[0], None), (A, B, T[1], None)], "id string, entity_id string, arrived_at timestamp, deleted_at timestamp")
    sets = spark.createDataFrame([(C, A, None, T[3])], "set_id string, document_id string, entity_id string, produced_at timestamp")
    entities = spark.createDataFrame([(B, T[1], None)], "entity_id string, arrived_at timestamp, deleted_at timestamp")
    out = orphan_references(*document_references(records, sets, entities))
    assert [(r.ref_table, r.ref_key, r.reason) for r in out.collect()] == [("records", A, "late")]
    assert [(r["month"], r.n_orphans) for r in orphans_by_period(out).collect()] == [("2025-01", 1)]
