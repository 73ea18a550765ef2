"""JSON logs: the first good lines, compaction; streams that start again, and upserts by bucket."""

import json

from pyspark.sql import functions as F

from selenite.sources import files
from selenite.streaming import events as E

SCHEMA = "id long, note string"


def test_logs(spark, tmp_path):
    folder, out = tmp_path / "logs", str(tmp_path / "out")
    folder.mkdir()
    good = [[{"id": 10 * k + i, "note": f"n{i}"} for i in range(6)] for k in range(5)]
    for k, rows in enumerate(good):
        lines = [json.dumps(r) for r in rows]
        (folder / f"{k}.jsonl").write_text("\n".join([*lines[:2], '{"id": broken', "", *lines[2:], '{"id": "x"}']) + "\n")
    flat = [r["id"] for rows in good for r in rows]
    for n in (0, 3, 8, 100):
        assert [r["id"] for r in files.read_events(spark, str(folder), SCHEMA, n).collect()] == flat[:n]
    for _ in range(2):  # again over what is there
        assert files.compact_log(spark, str(folder), out, SCHEMA, lines=10) == {"kept": 30, "broken": 10}
    parts = sorted((tmp_path / "out").glob("part-*"))
    assert len(parts) == 3 and [json.loads(line)["id"] for p in parts for line in p.read_text().splitlines()] == flat
    assert files.compact_log(spark, out, str(tmp_path / "again"), SCHEMA) == {"kept": 30, "broken": 0}


def events(spark, *rows):
    return spark.createDataFrame(rows, "user string, n long, v string")


def files_of(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_new_files_only(spark, tmp_path):
    """Two runs over a growing table: each event is taken once; the second run rewrites the touched bucket alone."""
    source, out = tmp_path / "in", tmp_path / "out"
    merge = E.upsert_by_bucket(str(out), "user", "n", 64)
    go = lambda: E.take_new(spark, str(source), "user string, n long, v string", merge, str(tmp_path / "checkpoint"))
    now = lambda: {r["user"]: (r["n"], r["v"]) for r in spark.read.parquet(str(out / "latest")).collect()}
    events(spark, *[(f"u{k}", k, "old") for k in range(40)], ("u0", -5, "older")).coalesce(1).write.parquet(str(source))
    assert go() == 41 and now() == {f"u{k}": (k, "old") for k in range(40)}
    before = files_of(out / "latest")
    events(spark, ("u7", 100, "new"), ("u7", 3, "late")).coalesce(1).write.mode("append").parquet(str(source))
    assert go() == 2 and now() == {f"u{k}": (k, "old") for k in range(40)} | {"u7": (100, "new")}
    after = files_of(out / "latest")
    assert len(set(before.items()) - set(after.items())) == 1 and len(before) == len(after) > 10
    assert go() == 0 and files_of(out / "latest") == after


def test_batches_come_again(spark, tmp_path):
    """The same batch twice, and an old one after a newer one, change nothing."""
    merge = E.upsert_by_bucket(str(tmp_path), "user", "n", 4)
    first, second = events(spark, ("a", 1, "x"), ("b", 1, "x"), (None, 1, "x")), events(spark, ("a", 2, "y"), ("c", 1, "y"), ("c", 1, "z"))
    merge(first, 0)
    merge(second, 1)
    rows = lambda: sorted(map(str, spark.read.parquet(str(tmp_path / "latest")).select("user", "n", "v").collect()))
    want = rows()
    assert len(want) == 4 and any("'z'" in r for r in want)
    for batch, number in ((second, 1), (first, 0), (first, 0)):
        merge(batch, number)
        assert rows() == want
    assert spark.read.parquet(str(tmp_path / "versions")).agg(F.count("*")).first()[0] == 5
