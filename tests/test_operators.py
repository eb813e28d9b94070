from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators.apply import update_from_lookup, update_if, upsert
from tidemark.operators.changes import changed_ids, changed_since, touched_ids
from tidemark.operators.joins import (
    first_child,
    has_parent,
    known_in,
    lacks,
    lookup_one,
    top1,
    with_exists_flag,
)
from tidemark.operators.rows import fields_to_columns, split_rows
from tidemark.operators.trees import tree_children, tree_roots

CUT = datetime(2024, 1, 9)
NEW, OLD = datetime(2024, 1, 9, 12), datetime(2023, 1, 1)


def make(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


# --- change capture


def region_and_links(spark):
    dated = "id long, crt_dt timestamp_ntz, upd_dt timestamp_ntz"
    region = make(spark, dated, (1, NEW, None), (2, OLD, None), (3, OLD, None), (4, NEW, NEW), (5, OLD, None), (None, NEW, NEW))
    links = make(spark, "id long, upd_dt timestamp_ntz", (1, None), (2, NEW), (2, NEW), (3, OLD), (5, None), (6, NEW), (None, NEW))
    base = make(spark, dated, (3, OLD, OLD), (5, OLD, NEW), (9, NEW, NEW))
    return region, links, base


@pytest.mark.parametrize("staged", [False, True])
def test_changed_ids_need_a_region_row_and_a_link(spark, staged):
    region, links, base = region_and_links(spark)
    stage = (lambda df, label: df.checkpoint()) if staged else None
    # 4 changed but has no link, 6 has no region row
    assert rows(changed_ids(region, links, None, "id", CUT, stage)) == [(1,), (2,)]
    assert rows(changed_ids(region, links, base, "id", CUT, stage)) == [(1,), (2,), (5,)]


def test_touched_ids_tell_child_changes(spark):
    region, links, _ = region_and_links(spark)
    assert rows(touched_ids("id", CUT, [region], links, ("upd_dt",))) == [(1, False), (2, True), (4, False), (6, True)]


def test_changed_since_single_date(spark):
    region, _, _ = region_and_links(spark)
    assert changed_since(region, CUT, ("upd_dt",)).count() == 2


# --- joins


def test_semi_and_anti_ignore_null_keys(spark):
    df = make(spark, "k long, v string", (1, "a"), (1, "b"), (2, "c"), (None, "d"))
    parent = make(spark, "k long", (1,), (1,), (None,))
    assert rows(has_parent(df, parent, ["k"])) == [(1, "a"), (1, "b")]
    assert rows(has_parent(df, parent, ["k"], unique=False)) == [(1, "a"), (1, "b")]
    assert rows(known_in(df, parent, ["k"], lambda d, label: d.checkpoint())) == [(1, "a"), (1, "b")]
    assert rows(lacks(df, parent, ["k"])) == [(2, "c"), (None, "d")]


def test_exists_flag_keeps_every_row(spark):
    df = make(spark, "k long", (1,), (2,), (None,))
    assert rows(with_exists_flag(df, make(spark, "k long", (1,), (1,), (None,)), ["k"], "f")) == [
        (1, True), (2, False), (None, False),
    ]


def test_lookup_one(spark):
    df = make(spark, "k long", (1,), (1,), (2,), (None,))
    other = make(spark, "k long, v string", (1, "x"), (7, "y"), (7, "z"), (None, "n"))
    assert rows(lookup_one(df, other, ["k"], "v", "found")) == [(1, "x"), (1, "x"), (2, None), (None, None)]
    assert rows(lookup_one(df, other, ["k"], "v", "found", "N")) == [(1, "x"), (1, "x"), (2, "N"), (None, "N")]


@pytest.mark.parametrize("action", ["count", "collect"])
def test_lookup_one_fails_on_two_matches(spark, action):
    df = make(spark, "k long", (7,))
    other = make(spark, "k long, v string", (7, "y"), (7, "y"))
    with pytest.raises(Exception, match="more than one row"):
        getattr(lookup_one(df, other, ["k"], "v", "found"), action)()


def test_first_child_is_the_smallest_living_known_one(spark):
    df = make(spark, "k long", (1,), (2,), (3,))
    links = make(spark, "k long, c long, ok string", (1, 5, "Y"), (1, 4, "N"), (1, 6, "Y"), (2, 9, "Y"), (1, 3, "Y"))
    parent = make(spark, "c long", (5,), (6,), (4,))
    for stage in (None, lambda d, label: d.checkpoint()):
        got = first_child(df, links, "k", "c", F.col("ok") == "Y", parent, stage)
        assert rows(got) == [(1, 5), (2, None), (3, None)]


def test_top1(spark):
    df = make(spark, "g long, o long, t long", (1, 2, 1), (1, 1, 9), (1, 1, 8), (2, None, 3), (2, 5, 4))
    order = [F.col("o").asc_nulls_last(), "t"]
    assert rows(top1(df, ["g"], order)) == [(1, 1, 8), (2, 5, 4)]


def test_tree(spark):
    df = make(spark, "k long, p long", (1, 1), (2, 1), (3, None), (None, None))
    assert rows(tree_roots(df, "k", "p")) == [(1, 1)]
    assert rows(tree_children(df, "k", "p")) == [(2, 1)]


# --- separated text


def test_split_rows(spark):
    df = make(spark, "id long, s string", (1, "a,,b,"), (2, None), (3, ""))
    assert rows(split_rows(df, "s")) == [
        (1, 1, "a"), (1, 2, None), (1, 3, "b"), (1, 4, None), (2, 1, None), (3, 1, None),
    ]
    assert rows(split_rows(make(spark, "s string", ("a.b|c",)), "s", "|")) == [(1, "a.b"), (2, "c")]
    assert rows(split_rows(make(spark, "s string", ("a.b|c",)), "s", ".")) == [(1, "a"), (2, "b|c")]


def test_fields_to_columns(spark):
    df = make(spark, "s string", ("abc,,d",), (None,))
    got = fields_to_columns(df, "s", {"one": (1, 2), "two": (2, 9), "three": (3, 9), "nine": (9, 9)})
    assert rows(got.drop("s")) == [("ab", None, "d", None), (None, None, None, None)]


# --- upsert

TARGET = "id long, cd string, title string, crt_dt timestamp_ntz, upd_dt timestamp_ntz, kept string"
DELTA = "id long, cd string, name string, at timestamp_ntz, run_at timestamp_ntz"
MATCH = {"title": "src.name", "upd_dt": "src.run_at"}
INSERT = {"title": "src.name", "crt_dt": "src.at"}
AT = datetime(2024, 1, 10, 9)


def target(spark):
    return make(
        spark, TARGET, (1, "V", "old1", OLD, None, "x"), (1, "J", "old2", OLD, None, "y"), (2, "V", "old3", OLD, OLD, "z"),
        (None, "V", "nokey", OLD, None, "n"),
    )


def delta(spark):
    return make(spark, DELTA, (1, "V", "new1", NEW, AT), (3, "V", "new3", NEW, AT), (None, "V", "nonew", NEW, AT))


EXPECTED = [
    (1, "J", "old2", OLD, None, "y"),
    (1, "V", "new1", OLD, AT, "x"),
    (2, "V", "old3", OLD, OLD, "z"),
    (3, "V", "new3", NEW, None, None),
    (None, "V", "nokey", OLD, None, "n"),
    (None, "V", "nonew", NEW, None, None),
]


def expect(got):
    assert rows(got) == sorted(EXPECTED, key=repr)


def test_upsert(spark):
    expect(upsert(target(spark), delta(spark), ["id", "cd"], MATCH, INSERT))


def test_upsert_as_sort_merge(spark, no_broadcast):
    expect(upsert(target(spark), delta(spark), ["id", "cd"], MATCH, INSERT))


def test_upsert_equals_a_full_outer_join(spark):
    t = target(spark).withColumn("t", F.lit(1)).alias("t")
    d = delta(spark).withColumn("d", F.lit(1)).alias("s")
    joined = t.join(d, (F.col("t.id") == F.col("s.id")) & (F.col("t.cd") == F.col("s.cd")), "full_outer")
    new, old = F.col("t.t").isNull(), F.col("s.d").isNull()
    expect(
        joined.select(
            F.coalesce("t.id", "s.id"), F.coalesce("t.cd", "s.cd"),
            F.when(old, F.col("title")).otherwise(F.col("name")),
            F.when(new, F.col("at")).otherwise(F.col("crt_dt")),
            F.when(~new & ~old, F.col("run_at")).otherwise(F.col("upd_dt")), F.col("kept"),
        )
    )


def test_upsert_twice_changes_only_the_stamp(spark):
    once = upsert(target(spark), delta(spark).where("id is not null"), ["id", "cd"], MATCH, INSERT)
    twice = upsert(once, delta(spark).where("id is not null"), ["id", "cd"], MATCH, INSERT)
    assert rows(once.drop("upd_dt")) == rows(twice.drop("upd_dt"))


@pytest.mark.parametrize("action", ["count", "collect"])
def test_upsert_fails_when_two_rows_match_one(spark, action):
    twice = delta(spark).unionAll(make(spark, DELTA, (1, "V", "again", NEW, AT)))
    with pytest.raises(Exception, match="several source rows match one row"):
        getattr(upsert(target(spark), twice, ["id", "cd"], MATCH, INSERT), action)()


def test_upsert_inserts_every_copy_of_a_new_key(spark):
    copies = make(spark, DELTA, *[(9, "V", "same", NEW, AT)] * 3, *[(None, "V", "nokey", NEW, AT)] * 2)
    got = upsert(target(spark), copies, ["id", "cd"], MATCH, INSERT)
    assert got.where("id = 9").count() == 3
    assert got.where("title = 'nokey' and kept is null").count() == 2


def test_upsert_rejects_unknown_columns(spark):
    with pytest.raises(ValueError, match="nope"):
        upsert(target(spark), delta(spark), ["id", "cd"], {"nope": "src.name"}, INSERT)


def test_upsert_into_nothing_and_from_nothing(spark):
    empty_target = spark.createDataFrame([], TARGET)
    assert upsert(empty_target, delta(spark), ["id", "cd"], MATCH, INSERT).count() == 3
    empty_delta = spark.createDataFrame([], DELTA)
    assert rows(upsert(target(spark), empty_delta, ["id", "cd"], MATCH, INSERT)) == rows(target(spark))


# --- conditional updates


def test_update_if(spark):
    t = make(spark, "id long, s string", (1, "OK"), (2, "OK"), (3, None), (None, "OK"))
    hits = make(spark, "id long", (1,), (1,), (3,), (None,))
    assert rows(update_if(t, hits, ["id"], {"s": F.lit("X")})) == sorted(
        [(1, "X"), (2, "OK"), (3, "X"), (None, "OK")], key=repr
    )
    assert rows(update_if(t, hits, ["id"], {"s": F.lit("X")}, exists=False)) == sorted(
        [(1, "OK"), (2, "X"), (3, None), (None, "X")], key=repr
    )
    # NULL <> 'OK' is unknown, so row 3 stays
    guarded = update_if(t, hits, ["id"], {"s": F.lit("X")}, guard=F.col("s") != "OK")
    assert rows(guarded) == rows(t)


def test_update_from_lookup(spark):
    t = make(spark, "id long, cd string, v string", (1, "V", "a"), (1, "J", "a"), (2, "V", "b"), (None, "V", "c"))
    lookup = make(spark, "id long, w string", (1, "new"), (8, "p"), (8, "q"), (None, "n"))
    got = update_from_lookup(t, lookup, ["id"], {"v": "src.w"}, guard=F.col("cd") == "V")
    assert rows(got) == sorted([(1, "V", "new"), (1, "J", "a"), (2, "V", "b"), (None, "V", "c")], key=repr)


def test_update_from_lookup_fails_only_where_it_applies(spark):
    t = make(spark, "id long, cd string, v string", (1, "J", "a"))
    lookup = make(spark, "id long, w string", (1, "p"), (1, "q"))
    values = {"v": "src.w"}
    assert rows(update_from_lookup(t, lookup, ["id"], values, guard=F.col("cd") == "V")) == [(1, "J", "a")]
    with pytest.raises(Exception, match="several rows match one row"):
        update_from_lookup(t, lookup, ["id"], values).count()
