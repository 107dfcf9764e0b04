"""Incremental featurize: a second run picks up only the new file."""

import os

from rectext.session import local_path
from rectext.sinks.writers import read_table
from rectext.streaming.incremental import featurize_stream


def test_incremental_runs(spark, tmp_path, tmpuri):
    src = str(tmp_path / "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write('{"m":"x","label":"benign","timestamps":[1]}\n{bad\n')
    table, ckpt = tmpuri + "/table", tmpuri + "/ckpt"
    featurize_stream(spark, src, table, ckpt).awaitTermination()
    assert read_table(spark, table).count() == 1
    with open(os.path.join(src, "b.JSON"), "w") as f:
        f.write('{"m":"y","label":"dirb"}\n')
    featurize_stream(spark, src, table, ckpt).awaitTermination()
    rows = sorted((r["text_representation"], r["label"], os.path.basename(local_path(r["source_file"])))
                  for r in read_table(spark, table).collect())
    assert rows == [("[m] x", "benign", "a.json"), ("[m] y", "dirb", "b.JSON")]
