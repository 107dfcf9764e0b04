"""The spark-submit entry points, run in-process on the test session."""

import os

from rectext.cli import run
from rectext.session import local_path
from rectext.sinks.writers import read_csv_by_key, read_table


def test_cli_jobs(spark, tmp_path, tmpuri):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text('{"m":"x","label":"benign","timestamps":[1]}\n{bad\n{"m":"y"}\n')
    out = run(spark, ["featurize", str(src), tmpuri + "/csv", "--audit", tmpuri + "/audit"])
    assert (out["n_records"], out["n_errors"], out["n_without_timestamp"]) == (2, 0, 1)
    assert sorted(r["text_representation"] for r in read_csv_by_key(spark, tmpuri + "/csv").collect()) == \
        ["[m] x", "[m] y"]
    assert spark.read.parquet(tmpuri + "/audit").first()["n_corrupt"] == 1
    imp = run(spark, ["import", str(src), tmpuri + "/coll"])
    assert [(f["file"], f["inserted"]) for f in imp["files"]] == [("a.json", 2)]
    assert run(spark, ["load", tmpuri + "/coll", tmpuri + "/table"]) == {"n_rows": 2}
    assert read_table(spark, tmpuri + "/table").count() == 2
    assert run(spark, ["line-count", os.path.join(str(src), "a.json")]) == {"n_lines": 3}
    assert os.path.isdir(local_path(tmpuri + "/table"))
