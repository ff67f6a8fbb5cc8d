"""Sinks and file sources: landing, reading back, exports, inventory,
warehouse writes and the upsert reload."""

import json
import os

from pyspark.sql import functions as F

from pitchline.plans import silver, warehouse
from pitchline.sinks import files as out
from pitchline.sources.bronze import read_bronze
from pitchline.sources.inventory import lake_inventory
from pitchline.sources.tables import read_table


def teams_payload(spark):
    return spark.createDataFrame(
        [("2024", [{"id": "1", "name": "Alpha", "isActive": True, "logos": [{"href": "/a"}]}]),
         ("2024", [{"id": "2", "name": "Beta", "isActive": None, "logos": []}]),
         ("2025", [{"id": "1", "name": "Alpha2", "isActive": False, "logos": None}])],
        "season string, items array<struct<id:string,name:string,isActive:boolean,"
        "logos:array<struct<href:string>>>>")


def test_land_and_read_bronze_roundtrip(spark, workdir):
    # coalesce(1): several documents share one file, one per line
    p = out.land_bronze(teams_payload(spark).coalesce(1), workdir, "teams", "api",
                        partition_by=["season"], ts="2024-07-01T00:00:00", compression="gzip")
    assert any(d.startswith("season=") for d in os.listdir(p))
    docs = read_bronze(spark, workdir, "teams")
    t = silver.silver_teams(docs, ts="T")
    assert t.count() == 3
    assert {r.team_name for r in t.collect()} == {"Alpha", "Beta", "Alpha2"}
    dim = {r.team_id: r for r in warehouse.dim_teams(t).collect()}
    assert dim["2"].team_is_active is True            # NULL -> DDL default TRUE
    assert (dim["1"].team_name, dim["1"].team_logos) == ("Alpha2", None)   # greatest row wins
    assert json.loads(dim["2"].team_logos) == []


def test_corrupt_documents_are_kept(spark, workdir):
    os.makedirs(f"{workdir}/teams/x")
    with open(f"{workdir}/teams/x/bad.json", "w") as f:
        f.write("{not json")
    df = read_bronze(spark, workdir, "teams", layout="lines")
    # (Spark refuses a query that reads nothing but the corrupt-record column)
    bad = df.select("metadata", "_corrupt_record", "asset_name").collect()
    assert [(r.metadata, r.asset_name) for r in bad] == [(None, "bad")]
    assert bad[0]._corrupt_record == "{not json"


def test_exports(spark, workdir):
    df = spark.createDataFrame([(1, ["x", "y"]), (2, [])], "id int, tags array<string>")
    p = out.export(df, workdir, "ds", "csv", ts="2024-07-01T12:30:00")
    assert p.endswith("exports/csv/ds_20240701_123000")
    back = spark.read.option("header", True).csv(p)
    assert sorted(r.tags for r in back.collect()) == ['["x","y"]', "[]"]
    pj = out.export(df, workdir, "ds", "json", ts="2024-07-01T12:30:00")
    meta = spark.read.json(pj + "/metadata").first()
    assert (meta.record_count, meta.columns, meta.dataset_name) == (2, ["id", "tags"], "ds")
    assert "exports/bi/" in out.export(df, workdir, "ds", "bi", ts="2024-07-01T12:30:00")


def test_export_all_isolates_failures(spark, workdir):
    def broken():
        raise RuntimeError("boom")
    status = {r.dataset: r for r in out.export_all(
        spark, {"ok": lambda: spark.range(3), "bad": broken}, workdir, "csv").collect()}
    assert status["ok"].status == "success" and status["bad"].status == "failed"


def test_layer_write_and_inventory(spark, workdir):
    out.write_layer(spark.range(100), f"{workdir}/lake/silver", "a")
    out.write_layer(spark.range(10), f"{workdir}/lake/gold", "b")
    inv = {(r.layer, r.dataset): r for r in lake_inventory(spark, f"{workdir}/lake").collect()}
    assert set(inv) == {("silver", "a"), ("gold", "b")}
    assert inv[("silver", "a")].bytes > 0
    assert read_table(spark, f"{workdir}/lake/silver", "a").count() == 100


def test_upsert_keeps_created_and_refreshes_updated(spark):
    old = spark.createDataFrame(
        [(1, "a", "2024-01-01 00:00:00", "2024-01-01 00:00:00"),
         (2, "b", "2024-01-01 00:00:00", "2024-01-01 00:00:00")],
        "k int, v string, created_at string, updated_at string").select(
        "k", "v", F.to_timestamp_ntz("created_at").alias("created_at"),
        F.to_timestamp_ntz("updated_at").alias("updated_at"))
    new = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    r = {x.k: x for x in warehouse.upsert(old, new, ["k"], ts="2024-06-01 00:00:00").collect()}
    assert (r[1].v, str(r[1].updated_at)) == ("a", "2024-01-01 00:00:00")
    assert (r[2].v, str(r[2].created_at), str(r[2].updated_at)) == (
        "B", "2024-01-01 00:00:00", "2024-06-01 00:00:00")
    assert str(r[3].created_at) == "2024-06-01 00:00:00"


def test_write_warehouse_table(spark, workdir):
    out.write_warehouse(spark.range(5).withColumnRenamed("id", "team_id"), "dim_probe",
                        path=f"{workdir}/wh/dim_probe")
    assert spark.table("dim_probe").count() == 5
    spark.sql("DROP TABLE dim_probe")


def test_versioned_reload_never_overwrites_its_input(spark, workdir):
    from pitchline.sinks.versions import read_current, reload
    root = f"{workdir}/wh"
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    reload(spark, root, "dim", first, ["k"], version="20240101000000", ts="2024-01-01 00:00:00")
    second = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    reload(spark, root, "dim", second, ["k"], version="20240601000000", ts="2024-06-01 00:00:00")
    cur = {r.k: r for r in read_current(spark, root, "dim").collect()}
    assert {k: r.v for k, r in cur.items()} == {1: "a", 2: "B", 3: "c"}
    assert str(cur[2].created_at) == "2024-01-01 00:00:00"
    assert str(cur[2].updated_at) == "2024-06-01 00:00:00"
    assert sorted(os.listdir(f"{root}/dim"))[:2] == ["version=20240101000000",
                                                     "version=20240601000000"]
    old = spark.read.parquet(f"{root}/dim/version=20240101000000")
    assert old.count() == 2                      # the input version is intact
