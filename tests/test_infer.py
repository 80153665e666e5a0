"""Types of fields from what was seen of their values."""

import itertools
import os

import pytest
from pyspark.sql import functions as F

from barmill.sources.files import scan_inferred
from barmill.sources.infer import (
    NUMBER,
    TEXT,
    TIME,
    WHOLE,
    add_types,
    field_states,
    inferred_schema,
    inferred_types,
    kind,
    merged_states,
    scan_by_types,
    type_of,
)

VALUES = [
    (None, 0), ("", 0), ("0", WHOLE), ("-12", WHOLE), ("+7", WHOLE), ("9223372036854775807", WHOLE), ("007", WHOLE),
    ("9223372036854775808", NUMBER), ("1.5", NUMBER), ("-.5e3", NUMBER), ("2025-09-02 04:00:00", TIME),
    ("2025-02-30 04:00:00", TEXT), ("2025-09-02", TEXT), ("unknown", TEXT), ("1,5", TEXT), ("é", TEXT),
]


def test_kinds(spark):
    rows = spark.createDataFrame([(v,) for v, _ in VALUES], "v string")
    assert [r[0] for r in rows.select(kind(F.col("v"))).collect()] == [k for _, k in VALUES]


def test_types_are_a_lattice(spark):
    kinds = {WHOLE: "bigint", NUMBER: "double", TIME: "timestamp_ntz", TEXT: "string"}
    masks = spark.createDataFrame([(m,) for m in range(16)], "m int")
    got = {r[0]: r[1] for r in masks.select("m", type_of(F.col("m"))).collect()}
    assert {m: got[m] for m in kinds} == kinds and got[0] == "string"
    # What is joined is never narrower than its parts.
    wider = {"bigint": 0, "double": 1, "timestamp_ntz": 1, "string": 2}
    for a, b in itertools.product(range(1, 16), repeat=2):
        assert wider[got[a | b]] >= max(wider[got[a]], wider[got[b]])


@pytest.fixture
def files(tmp_path):
    texts = {
        "1": "key,price,tstamp,note,`odd name\n1,10,2025-09-02 04:00:00,,x\n2,,2025-09-02 04:05:00,,y\n",
        "2": "key,price,tstamp,note,`odd name\n3,10.5,,,z\n",
        "3": "key,price,tstamp,note,`odd name\n4,11,soon,5,\n",
        "4": "key,price,tstamp,note,`odd name\n",
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return lambda name: str(tmp_path / f"{name}.csv")


def types(spark, home):
    return [(r.field, r.type, r.n_values) for r in inferred_types(spark, home).orderBy("position").collect()]


def test_files_add_up(spark, files, tmp_path):
    home = str(tmp_path / "states")
    add_types(spark, files("1").replace("`", ""), home, "1")
    assert types(spark, home) == [
        ("key", "bigint", 2), ("price", "bigint", 1), ("tstamp", "timestamp_ntz", 2), ("note", "string", 0), ("`odd name", "string", 2),
    ]
    for name in ("2", "2", "4"):
        add_types(spark, files(name), home, name)
    assert types(spark, home)[:3] == [("key", "bigint", 3), ("price", "double", 2), ("tstamp", "timestamp_ntz", 2)]
    add_types(spark, files("3"), home, "3")
    assert types(spark, home)[2:4] == [("tstamp", "string", 3), ("note", "bigint", 1)]
    rows = scan_by_types(spark, [files(n) for n in "1234"], home)
    assert rows.schema == inferred_schema(spark, home)
    assert sorted(r.price or 0 for r in rows.collect()) == [0, 10.0, 10.5, 11.0]


def test_states_in_any_grouping_are_those_of_all(spark):
    rows = spark.createDataFrame([(v, w) for (v, _), (w, _) in itertools.product(VALUES, VALUES)], "a string, b string")
    parts = [field_states(rows.where(F.pmod(F.xxhash64("a", "b"), F.lit(3)) == n)) for n in range(3)]
    merged = merged_states(parts[2].union(merged_states(parts[0].union(parts[1]))))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, field_states(rows).collect()))


def test_one_pass_over_the_files(spark, files, tmp_path):
    spark.sparkContext.setJobGroup("infer", "")
    add_types(spark, files("1"), str(tmp_path / "s"), "1")
    spark.sparkContext.setJobGroup("rest", "")
    tracker = spark.sparkContext.statusTracker()
    ids = tracker.getJobIdsForGroup("infer")
    # The header of one file; one scan, whose tasks send a row each; the write.
    assert len(ids) <= 3


def test_adding_a_file_reads_that_file_only(spark, files, tmp_path):
    home = str(tmp_path / "s")
    add_types(spark, files("1"), home, "1")
    os.remove(files("1"))
    add_types(spark, files("2"), home, "2")
    assert types(spark, home)[0] == ("key", "bigint", 3)


def test_as_spark_infers_where_rules_agree(spark, files, tmp_path):
    home = str(tmp_path / "s")
    add_types(spark, [files("1"), files("2")], home, "1")
    inferred = {f.name: f.dataType.simpleString() for f in scan_inferred(spark, [files("1"), files("2")]).schema}
    assert inferred["price"] == "double" and inferred["key"] == "int" and inferred["tstamp"].startswith("timestamp")


def test_nothing_there(spark, files, tmp_path):
    assert inferred_types(spark, str(tmp_path / "none")).count() == 0
    add_types(spark, files("4"), str(tmp_path / "s"), "4")
    assert {t for _, t, _ in types(spark, str(tmp_path / "s"))} == {"string"}
