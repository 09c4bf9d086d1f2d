"""Schemas of staging tables, and the audit that counts all constraints in one pass."""

import random

import pytest
from pyspark.sql import functions as F

from retrospect.plans import stage
from retrospect.sources import io, schemas


def test_every_staged_table_has_its_schema(spark, small):
    assert set(stage.STAGED) == set(schemas.STAGING)
    for name, spec in schemas.STAGING.items():
        declared = {f.name for f in spec.schema()}
        assert declared <= set(stage.STAGED[name][1]) and {*spec.primary, *spec.required, *spec.foreign, *(c for u in spec.unique for c in u)} <= declared, name
        further = set(stage.STAGED[name][1]) - declared
        assert further == (set(stage.CENSUS_COLUMNS) if name == "tracts" else set()), name
        assert all(other in schemas.STAGING and key in {f.name for f in schemas.STAGING[other].schema()} for other, key in spec.foreign.values())


def test_conform(spark, tmp_path):
    spec = schemas.Staging({"bigint": "id", "double": "x", "string": "s"}, ["id"])
    rows = spark.createDataFrame([(1, "a", 2, "more")], "id int, s string, x int, further string")
    got = schemas.conform(rows, "t", spec)
    assert got.schema.simpleString() == "struct<id:bigint,x:double,s:string,further:string>" and tuple(got.first()) == (1, 2.0, "a", "more")
    with pytest.raises(ValueError, match="t has not its schema: id: string instead of bigint; x: missing instead of double"):
        schemas.conform(rows.select(F.col("s").alias("id"), "s"), "t", spec)
    spark.createDataFrame([(1, 2)], "officer_id long, education_level_code int").write.parquet(f"{tmp_path}/c")
    assert schemas.staging(spark, f"{tmp_path}/c", "officer_characteristics").schema.simpleString() == "struct<officer_id:bigint,education_level_code:bigint>"


def _plainly(rows, known):
    """Violations of the constraints of the test below, row by row."""
    beyond = lambda keys: len(keys) - len(set(keys))
    return {
        "primary key (a, b)": beyond([(a, b) for a, b, _, _ in rows]), "unique (c)": beyond([c for _, _, c, _ in rows]),
        "not null (c)": sum(c is None for _, _, c, _ in rows), "not null (a)": sum(a is None for a, *_ in rows), "not null (b)": sum(b is None for _, b, _, _ in rows),
        "check (small)": sum(a is not None and a >= 5 for a, *_ in rows), "foreign key (a)": sum(a is not None and a not in known for a, *_ in rows), "foreign key (d)": sum(d is not None and d not in known for *_, d in rows),
    }


@pytest.mark.parametrize("n", [0, 1, 40, 3000])
def test_audit_equals_counting(spark, n):
    rng = random.Random(n)
    value = lambda k: rng.choice([None, *range(k)])
    # a third of all rows share a key
    rows = [(1, "1", 1, 1) if rng.random() < 1 / 3 else (value(9), rng.choice([None, "", "0", "1"]), value(n or 1), value(9)) for _ in range(n)]
    known = {0, 1, 4, 7}
    others = [(k,) for k in [*known, *known, None]]
    foreign = {"a": (spark.createDataFrame(others, "k bigint"), "k"), "d": (spark.createDataFrame(others, "k int"), "k")}
    got = io.audit(spark.createDataFrame(rows, "a int, b string, c long, d long"), "t", ["a", "b"], [["c"]], ["c"], foreign, {"small": "a < 5"}).collect()
    assert len(got) == 8 and {r["table_name"] for r in got} == {"t"}
    assert {r["constraint"]: r["violations"] for r in got} == _plainly(rows, known)


def test_nulls_of_a_key_keep_their_places(spark):
    rows = spark.createDataFrame([(None, 1), (1, None), (None, None), (1, 1)], "a int, b int")
    assert io.audit(rows, "t", unique=[["a", "b"]]).first()["violations"] == 0
    assert io.audit(rows.union(rows), "t", unique=[["a", "b"]]).first()["violations"] == 4


def test_one_scan_and_one_shuffle(spark, small):
    lines, orders = (spark.read.parquet(f"{small}/{name}.parquet") for name in ("lineitem", "orders"))
    plan = io.audit(lines, "lineitem", ["l_orderkey", "l_linenumber"], [["l_orderkey", "l_partkey"]], ["l_shipdate"], {"l_orderkey": (orders, "o_orderkey")}, {"q": "l_quantity > 0"})
    text = plan._jdf.queryExecution().sparkPlan().toString()
    assert text.count("FileScan") == 2 and text.count("lineitem.parquet") == 1 and text.count("Join") == 1
    executed = plan._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange hashpartitioning") == 2  # by constraint and key, and the few counts by constraint
