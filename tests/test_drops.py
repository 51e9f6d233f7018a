"""CSV sets of many files, and the journal of a file drop."""

import glob
import os

from relaylens.sources import drops, files

SCHEMA = "id INT, v STRING"


def _land(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode() if isinstance(text, str) else text)


def test_many_files_with_drifting_headers(spark, tmp_dir):
    for i in range(150):
        _land(f"{tmp_dir}/d/f{i}.csv", f"id,v\n{i},x\n" if i % 3 else f"v,id,u\ny,{i},q\n")
    df = files.read_csv_union(spark, files.file_inventory(spark, f"{tmp_dir}/d"), "id INT, v STRING, u STRING")
    got = df.groupBy("v", "u").count().collect()
    assert sorted((r.v, r.u, r["count"]) for r in got if r.u is None) == [("x", None, 100)]
    assert [(r.v, r["count"]) for r in got if r.u == "q"] == [("y", 50)]
    assert df.selectExpr("count(distinct id) c").first().c == 150


def _left(root):
    return sorted(os.path.basename(p) for p in glob.glob(f"{root}/**/*.csv", recursive=True))


def test_crashes_neither_lose_nor_repeat(spark, tmp_dir):
    root, target = f"{tmp_dir}/landed", f"{tmp_dir}/stored"

    def load(**more):
        return drops.load_drop(spark, root, "kept-", target, SCHEMA, **more)

    def rows():
        return sorted(((r.id, r.v) for r in drops.read_drop(spark, target, SCHEMA).collect()), key=str)

    os.makedirs(root)
    assert rows() == []
    _land(f"{root}/kept-1.csv", "id,v\n1,a\n1,a\n")
    _land(f"{root}/other.csv", "id,v\n9,a\n")
    assert load(clean=True, stop_after="append") == 0 and rows() == [] and _left(root) == ["kept-1.csv", "other.csv"]
    assert load(clean=True, stop_after="commit") == 0 and rows() == [(1, "a"), (1, "a")] and "kept-1.csv" in _left(root)
    _land(f"{root}/kept-2.csv", "v,more\nb,7\n")
    assert load() == 1 and rows() == [(1, "a"), (1, "a"), (None, "b")]
    assert load(clean=True) is None and _left(root) == ["other.csv"]          # nothing new; clean-up catches up
    _land(f"{root}/kept-1.csv", "id,v\n3,again\n")                                # a new file under an old name
    assert load(clean=True) == 2 and _left(root) == ["other.csv"]
    assert (3, "again") in rows()
    assert drops.clean_drop(spark, root, target) == 0
