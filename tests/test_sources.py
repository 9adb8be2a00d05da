"""Source reading (O41), publishing (O42) and staging."""

import pytest

from feedkit.context import StagingScope, checkpoint_dir, stage, stage_all
from feedkit.sources import catalog
from feedkit.sources.catalog import Namespace, publish, read_source, read_sources


def test_namespace_table_names():
    assert Namespace(schema="bronze").table_name("t") == "bronze.t"
    assert Namespace(schema="bronze", catalog="main").table_name("t") == "main.bronze.t"


def test_read_source_from_folder_lowercases_columns(spark, tmp_path):
    spark.createDataFrame([(1, "A")], "STVTERM_CODE int, Stvterm_Acyr_Code string") \
        .write.parquet(str(tmp_path / "saturn_stvterm.parquet"))
    ns = Namespace(root=str(tmp_path))
    df = read_source(spark, ns, "saturn_stvterm")
    assert df.columns == ["stvterm_code", "stvterm_acyr_code"]
    assert list(read_sources(spark, ns, ["saturn_stvterm"])) == ["saturn_stvterm"]


def test_read_source_from_catalog_table(spark):
    spark.createDataFrame([(1,)], "X int").createOrReplaceTempView("feedkit_src_probe")
    assert read_source(spark, Namespace(), "feedkit_src_probe").columns == ["x"]


def test_publish_full_refresh(spark, tmp_path):
    path = str(tmp_path / "feed")
    publish(spark.createDataFrame([(1,), (2,)], "v int"), path)
    publish(spark.createDataFrame([(3,)], "v int"), path)
    assert [r[0] for r in spark.read.parquet(path).collect()] == [3]


@pytest.mark.parametrize("steps", [0, 1, 2])
def test_publish_cut_off_between_its_steps(spark, tmp_path, monkeypatch, steps):
    """After any number of its steps the old or the new result is there in full, and the next run mends it."""
    path = str(tmp_path / "feed")
    publish(spark.createDataFrame([(1,), (2,)], "v int"), path)
    rename, done = catalog._rename, []

    def stopped(*args):
        if len(done) == steps:
            raise KeyboardInterrupt
        done.append(1)
        rename(*args)

    with monkeypatch.context() as patch:
        patch.setattr(catalog, "_rename", stopped)
        patch.setattr(catalog, "delete_folder", lambda *a: None if len(done) < 2 else (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            publish(spark.createDataFrame([(3,)], "v int"), path)
    got = sorted(r[0] for r in catalog.published(spark, path).collect())
    assert got == ([1, 2] if steps == 0 else [3])
    publish(spark.createDataFrame([(4,)], "v int"), path)
    assert [r[0] for r in catalog.published(spark, path).collect()] == [4]
    assert [r[0] for r in spark.read.parquet(path).collect()] == [4]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["feed"]


def staged_folders(spark):
    import os
    root = checkpoint_dir(spark).removeprefix("file:") + "/staged"
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_a_staging_scope_frees_its_tables(spark):
    before = staged_folders(spark)
    with StagingScope(spark) as scope:
        inner = stage(spark.range(10), "inner")
        with StagingScope(spark) as nested:
            both = stage_all({"a": spark.range(3), "b": spark.range(4)})
            total = nested.keep(both["a"].union(both["b"]), "both")
        assert total.count() == 7 and len(staged_folders(spark) - before) == 2
        kept = scope.keep(inner.union(total), "kept")
    assert kept.count() == 17 and len(staged_folders(spark) - before) == 1


def test_publish_to_a_catalog_table(spark):
    name = "feedkit_published"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    publish(spark.createDataFrame([(1,), (2,)], "v int"), name)
    publish(spark.table(name).selectExpr("v + 10 AS v"), name)  # reads what it replaces
    assert sorted(r[0] for r in spark.table(name).collect()) == [11, 12]
    spark.sql(f"DROP TABLE {name}")


def test_stage_writes_once_and_reads_back(spark):
    df = spark.range(5).selectExpr("id", "id * 2 AS twice")
    staged = stage(df, "probe")
    assert sorted(r["twice"] for r in staged.collect()) == [0, 2, 4, 6, 8]
    assert "FileScan parquet" in staged._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["saturn_stvterm", "general_goremal"])
def test_missing_folder_table_raises(spark, tmp_path, name):
    with pytest.raises(Exception):
        read_source(spark, Namespace(root=str(tmp_path / "none")), name)
