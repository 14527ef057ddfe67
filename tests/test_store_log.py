"""The commit log of the store: patches, compaction, crashes."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import SF
from newsflow.operators import store as S
from newsflow.plans import bindings as B


def rows_of(df):
    return sorted(map(tuple, df.select(*S.STORE_SCHEMA.fieldNames()).collect()), key=lambda r: r[0])


def files(root):
    return {os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def patch_of(spark, rows):
    return spark.createDataFrame(rows, "uid string, status string, summary string")


@pytest.fixture()
def stored(spark, tmp_path):
    root = str(tmp_path / "store")
    spark.conf.set("spark.newsflow.storePrefix", "2")
    S.append_store(spark, root, B.existing_store(spark, SF))
    yield root
    spark.conf.unset("spark.newsflow.storePrefix")


def test_one_patched_row_writes_one_file_and_rewrites_one_prefix(spark, stored):
    before = files(stored)
    old = S.read_store(spark, stored).orderBy("uid").collect()
    uid = old[0].uid
    n = S.append_patch(spark, stored, patch_of(spark, [(uid, "ready", "short")]))
    assert len(files(stored) - before) == 1
    got = {r.uid: r for r in S.read_store(spark, stored).collect()}
    assert (got[uid].status, got[uid].summary, got[uid].title) == ("ready", "short", old[0].title)
    assert all(got[r.uid] == r for r in old[1:])
    assert S.compact(spark, stored) == [uid[:2]]
    kinds = [(number, kind, held) for number, kind, held in S.commits(spark, stored) if number > n]
    assert kinds == [(n + 1, "base", [uid[:2]])]
    assert {r.uid: r for r in S.read_store(spark, stored).collect()} == got
    assert S.compact(spark, stored) == [] and S.read_patches(spark, stored) is None


def test_newest_value_of_each_field_counts(spark, stored):
    uid, other = (r.uid for r in S.read_store(spark, stored).orderBy("uid").limit(2).collect())
    S.append_patch(spark, stored, patch_of(spark, [(uid, "ready", "one"), (other, "error", None)]))
    S.append_patch(spark, stored, patch_of(spark, [(uid, None, "two"), ("unknown", "ready", "x")]))
    for _ in range(2):  # as patches, then as a base with a patch after it
        got = {r.uid: (r.status, r.summary) for r in S.read_store(spark, stored).collect()}
        assert got[uid] == ("ready", "two") and got[other] == ("error", None) and "unknown" not in got
        S.compact(spark, stored)
    S.append_patch(spark, stored, patch_of(spark, [(uid, "error", None)]))
    assert S.read_store(spark, stored).where(F.col("uid") == uid).first().status == "error"


def test_a_crash_leaves_the_store_as_it_was(spark, stored):
    uid = S.read_store(spark, stored).orderBy("uid").first().uid
    S.append_patch(spark, stored, patch_of(spark, [(uid, "ready", "short")]))
    whole = rows_of(S.read_store(spark, stored))
    n = max(n for n, _, _ in S.commits(spark, stored))
    torn = f"{stored}/n={n + 1}"  # a compaction, a patch and an insert that died before their marker
    for kind in ("base", "patch", "add"):
        shutil.copytree(f"{stored}/n=0/kind=add/p={uid[:2]}", f"{torn}/kind={kind}/p={uid[:2]}")
    assert rows_of(S.read_store(spark, stored)) == whole
    assert S.compact(spark, stored) == [uid[:2]]  # the next commit replaces what the dead one left
    assert rows_of(S.read_store(spark, stored)) == whole
    assert [kind for number, kind, _ in S.commits(spark, stored) if number == n + 1] == ["base"]


def test_raw_rows_without_reading_the_patches_texts(spark, stored):
    raw = {r.uid for r in S.read_store(spark, stored).where("status = 'raw'").collect()}
    one = sorted(raw)[0]
    S.append_patch(spark, stored, patch_of(spark, [(one, "ready", "x")]))
    df = S.read_raw(spark, stored)
    assert {r.uid for r in df.collect()} == raw - {one}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(status,raw)" in plan
    assert "ReadSchema: struct<uid:string,status:string>" in plan


def test_inserts_meet_patched_and_compacted_rows(spark, stored):
    uids = [r.uid for r in S.read_store(spark, stored).orderBy("uid").collect()]
    S.append_patch(spark, stored, patch_of(spark, [(uids[0], "ready", "x")]))
    S.compact(spark, stored)
    batch = spark.createDataFrame([(u,) for u in uids[:5]] + [("zz" + "0" * 30,), (None,)], "uid string")
    held = S.stored_uids(spark, stored, batch)
    assert {r.uid for r in held.collect()} >= set(uids[:5])
    assert batch.join(held, "uid", "left_anti").count() == 2
