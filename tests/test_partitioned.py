"""Changes that rewrite only the partitions they touch."""

import glob
import os

import pytest

from tablekit.operators import dml
from tablekit.operators import partitioned as PT

ROWS = [(1, "a", 1.0), (2, "a", 2.0), (3, "b", 3.0), (4, "b", None), (5, "c d/e", 5.0), (6, None, 6.0), (7, None, 7.0)]


@pytest.fixture()
def made(spark, scratch):
    return PT.create(spark.createDataFrame(ROWS, "k int, p string, v double"), scratch + "/t", ["p"])


def files(t):
    out = {}
    for f in glob.glob(f"{t.path}/p=*/part-*.parquet".replace("file:", "")):
        out.setdefault(os.path.basename(os.path.dirname(f)), set()).add((os.path.basename(f), os.stat(f).st_mtime_ns))
    return out


def rows(df):
    return sorted(map(str, df.select("k", "p", "v").collect()))


def unchanged(before, after):
    return {p for p in before if before[p] == after.get(p)}


def test_delete_writes_anew_drops_and_leaves_the_rest(made):
    want = rows(dml.delete_where(made.read(), "k IN (1, 5) OR v = 6.0"))
    before = files(made)
    assert PT.delete_in_place(made, "k IN (1, 5) OR v = 6.0") == {"rows": 3, "rewritten": 2, "dropped": 1}
    assert rows(made.read()) == want
    assert unchanged(before, files(made)) == {"p=b"} and len(files(made)) == 3
    assert PT.delete_in_place(made, "k = 99") == {"rows": 0, "rewritten": 0, "dropped": 0}
    assert PT.delete_in_place(made, "v > 100 AND NULL") == {"rows": 0, "rewritten": 0, "dropped": 0}


def test_update_of_a_value_and_of_the_partition(made):
    before = files(made)
    assert PT.update_in_place(made, "k = 3", {"v": 0.5})["rewritten"] == 1
    assert unchanged(before, files(made)) == set(before) - {"p=b"}
    want = rows(dml.update_where(made.read(), "k IN (5, 6)", {"p": "a"}))
    before = files(made)
    report = PT.update_in_place(made, "k IN (5, 6)", {"p": "a"})          # one partition is left empty, one grows
    assert report == {"rows": 2, "rewritten": 2, "dropped": 1}
    assert rows(made.read()) == want and unchanged(before, files(made)) == {"p=b"}
    before = files(made)
    PT.update_in_place(made, "k = 7", {"p": None})
    assert rows(made.read()) == want


def test_merge_replaces_moves_and_inserts(spark, made, scratch):
    source = spark.createDataFrame([(5, "b", 50.0), (8, "new", 8.0), (None, "b", 0.0)], "k int, p string, v double")
    want = rows(dml.merge_upsert(made.read(), source, ["k"]))
    before = files(made)
    PT.merge_in_place(made, source, ["k"])
    assert rows(made.read()) == want
    assert unchanged(before, files(made)) == {"p=a", "p=__HIVE_DEFAULT_PARTITION__"}
    assert "p=new" in files(made) and len(files(made)) == 4                # the emptied one is gone
    with pytest.raises(Exception, match="duplicate keys"):
        PT.merge_in_place(made, source.unionByName(source.where("k = 8")), ["k"])
    with pytest.raises(dml.SchemaMismatch):
        PT.merge_in_place(made, source.drop("v"), ["k"])
    before = files(made)
    PT.merge_in_place(made, source.limit(0), ["k"])
    assert files(made) == before


def test_a_change_cut_off_before_its_drop_can_be_repeated(made, monkeypatch):
    want = rows(dml.delete_where(made.read(), "k IN (1, 5)"))
    with monkeypatch.context() as m:
        m.setattr(PT, "_drop", lambda *a: (_ for _ in ()).throw(RuntimeError("cut off")))
        with pytest.raises(RuntimeError):
            PT.delete_in_place(made, "k IN (1, 5)")
    PT.delete_in_place(made, "k IN (1, 5)")
    assert rows(made.read()) == want
