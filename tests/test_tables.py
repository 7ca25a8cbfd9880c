"""Tables that are replaced or updated: what readers see, what is written, what a lost job leaves."""

import pytest
from lake_files import put
from pyspark.sql import functions as F

from comptoir.catalog.inputs import source
from comptoir.catalog.queries import REGISTRY
from comptoir.operators.versions import latest_version
from comptoir.sinks import read_keyed, read_table, replace_table, upsert
from comptoir.sources.inventory import list_objects

SCHEMA = "ville string, nb_ventes bigint"


def test_a_lost_write_leaves_the_old_table(spark, tmp_path):
    path = f"{tmp_path}/processed/t"
    replace_table(spark.range(10), path)
    reader = read_table(spark, path)
    bad = spark.range(1000).repartition(4).select(F.when(F.col("id") == 999, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        replace_table(bad, path)
    assert read_table(spark, path).count() == 10
    replace_table(spark.range(3), path, files=1)
    assert read_table(spark, path).count() == 3
    assert reader.count() == 10  # who began before the switch ends on what was there
    replace_table(read_table(spark, path).unionByName(spark.range(1)), path)  # from the table itself
    assert read_table(spark, path).count() == 4
    assert len(list((tmp_path / "processed/t/_versions").iterdir())) == 2


def test_folders_without_versions_are_tables_too(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/plain")
    assert read_table(spark, f"{tmp_path}/plain").count() == 5
    replace_table(spark.range(6).withColumn("p", F.col("id") % 2), f"{tmp_path}/parts", partition_by="p")
    assert read_table(spark, f"{tmp_path}/parts").where("p = 1").count() == 3


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def test_upsert_writes_changed_buckets_only(spark, tmp_path):
    path = f"{tmp_path}/ca"
    assert read_keyed(spark, path, SCHEMA).isEmpty()
    upsert(rows(spark), path, "ville", SCHEMA)
    assert read_keyed(spark, path, SCHEMA).isEmpty()
    upsert(rows(spark, *((f"v{i}", i) for i in range(500)), (None, 7)), path, "ville", SCHEMA)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "ca").rglob("*.parquet")}
    for _ in range(3):  # written again, the same rows change nothing
        upsert(rows(spark, ("v3", 33), (None, 8), ("new", 1)), path, "ville", SCHEMA)
    found = {r.ville: r.nb_ventes for r in read_keyed(spark, path, SCHEMA).collect()}
    assert found == {**{f"v{i}": i for i in range(500)}, "v3": 33, None: 8, "new": 1}
    assert read_keyed(spark, path, SCHEMA).count() == 502
    written = [p for p in (tmp_path / "ca").rglob("*.parquet") if p not in before]
    assert {p.parent.parent.name for p in written} <= {f"seau={b}" for b in spark.range(1).select(F.explode(F.array(
        *(F.pmod(F.xxhash64(F.lit(k)), F.lit(64)) for k in ("v3", "new")), F.pmod(F.xxhash64(F.lit(None).cast("string")), F.lit(64))))
        .alias("b")).toPandas().b}
    assert all(len(list(d.iterdir())) <= 2 for d in (tmp_path / "ca").glob("seau=*"))


def test_listing_by_levels(spark, tmp_path):
    names = ["raw/a.txt", "raw/v/d=1/x", "raw/v/d=1/_y", "raw/v/d=2/deep/er/z", "top", "raw/v/.hidden", "raw/w/empty"]
    for name in names:
        put(tmp_path / name, "" if name.endswith("empty") else "12")
    for levels in (1, 2, 3, 6):
        found = {r.cle: r.taille for r in list_objects(spark, str(tmp_path), levels).collect()}
        assert found == {n: 0 if n.endswith("empty") else 2 for n in names if "hidden" not in n}


def test_named_ties(spark, sf_dir="/root/testdata/sf0.001"):
    frame = spark.createDataFrame([("a", "2026", "f", 1, 9), ("A ", "2026", "f", 2, 1), ("a", "2025", "g", 5, 5), (None, "1", "h", 0, 0)],
                                  "id string, _ingest_date string, _fichier_source string, x int, y int")
    assert {(r.id, r.x) for r in latest_version(frame, "id", ["x"]).collect()} == {("A ", 2), (None, 0)}
    assert {(r.id, r.y) for r in latest_version(frame, "id", ["y"]).collect()} == {("a", 9), (None, 0)}
    plan = REGISTRY["revenue_by_city"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "p_name" not in plan and "p_retailprice" in plan
    assert source(spark, sf_dir, "produits").count() > 0
