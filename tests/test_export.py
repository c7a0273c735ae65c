import copy

import pytest
from pyspark.sql import functions as F
from test_bundles import SOUND, frame

from folium.functions import headings, text
from folium.operators import quality
from folium.plans import export
from folium.sources import bundles


def test_export_is_all_or_nothing(spark, tmp_path):
    bad = copy.deepcopy(SOUND) | {"bundle_id": "bad"}
    bad["runs"][0]["status"] = "running"
    path = f"file://{tmp_path}/out"
    with pytest.raises(export.Unsound, match="running"):
        export.export(frame(spark, [SOUND, bad]), path)
    assert not (tmp_path / "out").exists()
    assert export.export(frame(spark, [SOUND]), None).count() == 0 and not (tmp_path / "out").exists()
    export.export(frame(spark, [SOUND]), path)
    assert bundles.read(spark, path).count() == 1
    with pytest.raises(Exception, match="(?i)exist"):
        export.export(frame(spark, [SOUND]), path)


def test_keys_runs_and_sources(spark, tmp_path):
    nodes = spark.createDataFrame([(1, "01"), (1, "01"), (2, "01")], "doc_id long, sort_key string")
    runs = spark.createDataFrame([(1, 5, "m", "batch", 0), (1, 6, "m", "batch", 0)], "doc_id long, run_id long, model string, mode string, s long").withColumn("started_at", F.timestamp_seconds("s"))
    assert sorted(r["key"] for r in export.repeated_keys(nodes, runs).collect()) == ["01", "m--batch--19700101T000000Z"]
    asked = spark.createDataFrame([(5,), (9,), (9,)], "run_id long")
    assert [r["run_id"] for r in export.missing_runs(asked, runs).collect()] == [9]
    (tmp_path / "a.pdf").write_bytes(b"x")
    docs = spark.createDataFrame([(1, "/old/a.pdf"), (2, "/old/b.pdf")], "doc_id long, source_path string")
    got = bundles.with_source_digests(docs, bundles.file_digests(spark, f"file://{tmp_path}")).orderBy("doc_id").collect()
    assert [r["source_sha256"] and r["source_sha256"][:8] for r in got] == ["2d711642", None]


def test_small_values(spark):
    lit = F.lit
    row = spark.range(1).select(headings.without_prefix(lit("Capítulo I La guerra total")), headings.without_prefix(lit("Capítulo I")), headings.without_prefix(lit("La guerra")), text.shown_page(lit(0), lit(5)), text.shown_page(lit(9), lit(5))).first()
    assert tuple(row) == ("La guerra total", "Capítulo I", "La guerra", 0, 4)
    assert quality.markdown(spark.createDataFrame([(1, None)], "doc_id int, n int")).splitlines()[2:] == ["| doc_id | n |", "|---|---|", "| 1 |  |"]
