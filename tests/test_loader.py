from datetime import datetime, timedelta, timezone
from decimal import Decimal

from pyspark.sql import functions as F

from loanlens import contract
from loanlens.streaming import loader


def projects(spark, rows):
    return spark.createDataFrame(rows, contract.table_schema("dim_project"))


def deliver(df, folder):
    df.coalesce(1).write.mode("append").parquet(str(folder))


def load(spark, root, **options):
    loader.load_new_files(spark, str(root / "in"), str(root / "wh"), "dim_project", **options)


def current(spark, root):
    rows = loader.current_rows(spark, str(root / "wh"), "dim_project").collect()
    return {r.project_id: (r.project_key, r.project_name) for r in rows}


def test_newest_delivery_wins_and_refresh_finds_missed_files(spark, tmp_path):
    deliver(projects(spark, [(0, "P1", " a "), (1, "P2", "b")]), tmp_path / "in")
    load(spark, tmp_path)
    assert current(spark, tmp_path) == {"P1": (0, "a"), "P2": (1, "b")}
    load(spark, tmp_path)  # nothing new
    deliver(projects(spark, [(5, "P1", "c"), (6, "P3", "d")]), tmp_path / "in")
    load(spark, tmp_path)
    assert current(spark, tmp_path) == {"P1": (5, "c"), "P2": (1, "b"), "P3": (6, "d")}
    assert loader.all_rows(spark, str(tmp_path / "wh"), "dim_project").count() == 4
    history = loader.load_history(spark, str(tmp_path / "wh"), "dim_project")
    assert sorted((r.status, r.rows) for r in history.collect()) == [("LOADED", 2)] * 2
    assert len(list((tmp_path / "in").glob("*.parquet"))) == 2  # sources stay
    row = loader.current_rows(spark, str(tmp_path / "wh"), "dim_project").first()
    assert row["_source_file"].endswith(".parquet") and row["_loaded_at"] is not None


def test_repeated_batch_replaces_itself(spark, tmp_path):
    deliver(projects(spark, [(0, "P1", "a")]), tmp_path / "in")
    files = [str(f) for f in (tmp_path / "in").glob("*.parquet")]
    schema = contract.table_schema("dim_project")
    for _ in range(2):
        loader.load_files(spark, files, 0, str(tmp_path / "wh"), "dim_project", schema)
    assert loader.all_rows(spark, str(tmp_path / "wh"), "dim_project").count() == 1


def test_file_with_one_bad_value_contributes_nothing(spark, tmp_path):
    text = "project_key string, project_id string, project_name string"
    deliver(spark.createDataFrame([("1", "P1", "a"), ("x", "P2", "b")], text), tmp_path / "in")
    deliver(spark.createDataFrame([("3", "P3", "c")], text), tmp_path / "in")
    from pyspark.sql.types import StructType

    load(spark, tmp_path, source_schema=StructType.fromDDL(text))
    assert current(spark, tmp_path) == {"P3": (3, "c")}
    history = loader.load_history(spark, str(tmp_path / "wh"), "dim_project").collect()
    assert sorted((r.status, r.rows, r.lost_values) for r in history) == [
        ("LOADED", 1, 0),
        ("SKIPPED", 2, 1),
    ]


def test_unreadable_files_are_skipped_whole(spark, tmp_path):
    many = spark.range(200_000).select(
        F.col("id").alias("project_key"),
        F.concat(F.lit("P"), F.col("id")).alias("project_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("project_name"),
    )
    deliver(many, tmp_path / "in")
    (broken,) = (tmp_path / "in").glob("*.parquet")
    content = bytearray(broken.read_bytes())
    middle = len(content) // 2
    content[middle : middle + 4096] = b"\xff" * 4096  # pages break, the footer stays
    broken.write_bytes(content)
    for crc in (tmp_path / "in").glob(".*.crc"):
        crc.unlink()
    (tmp_path / "in" / "junk.parquet").write_bytes(b"no parquet at all")
    deliver(projects(spark, [(9, "P9", "z")]), tmp_path / "in")
    load(spark, tmp_path)
    assert current(spark, tmp_path) == {"P9": (9, "z")}
    history = loader.load_history(spark, str(tmp_path / "wh"), "dim_project").collect()
    assert sorted(r.status for r in history) == ["LOADED", "SKIPPED", "SKIPPED"]


def test_doubles_become_declared_decimals(spark, tmp_path):
    fields = contract.WAREHOUSE["fact_loans"]
    wide = {f.name: ("double" if "decimal" in f.type else f.type) for f in fields}
    values = [F.lit(1.005 if t == "double" else None).cast(t).alias(c) for c, t in wide.items()]
    source = spark.range(1).select(*values).withColumn("loan_number", F.lit("L1"))
    deliver(source, tmp_path / "in")
    loader.load_new_files(
        spark, str(tmp_path / "in"), str(tmp_path / "wh"), "fact_loans", source.schema
    )
    row = loader.current_rows(spark, str(tmp_path / "wh"), "fact_loans").first()
    assert row.cancelled_amount == Decimal("1.01") and row.interest_rate == Decimal("1.0050")


def test_recent_loads(spark, tmp_path):
    for i in range(3):
        deliver(projects(spark, [(i, f"P{i}", "a")]), tmp_path / "in")
        load(spark, tmp_path)
    wh, now = str(tmp_path / "wh"), datetime.now(timezone.utc).replace(tzinfo=None) + timedelta(minutes=1)
    recent = loader.recent_loads(spark, wh, "dim_project", now, rows=2).collect()
    assert [r.batch_id for r in recent] == [2, 1]
    later = loader.recent_loads(spark, wh, "dim_project", now + timedelta(hours=25))
    assert later.count() == 0


def test_rebuilt_source_replaces_vanished_members(spark, tmp_path):
    source = str(tmp_path / "in")
    projects(spark, [(0, "P1", "a"), (1, "P2", "b")]).coalesce(1).write.parquet(source)
    load(spark, tmp_path)
    rebuilt = projects(spark, [(0, "P2", "b"), (1, "P3", "c")])
    rebuilt.coalesce(1).write.mode("overwrite").parquet(source)
    pending = loader.pending_files(spark, source, str(tmp_path / "wh"), "dim_project")
    assert pending.count() == 1
    load(spark, tmp_path)
    pending = loader.pending_files(spark, source, str(tmp_path / "wh"), "dim_project")
    assert pending.count() == 0
    assert current(spark, tmp_path) == {"P2": (0, "b"), "P3": (1, "c")}
    wh = str(tmp_path / "wh")
    assert loader.current_rows(spark, wh, "dim_project", keep_vanished=True).count() == 3


def test_compaction_keeps_what_readers_see(spark, tmp_path):
    wh = str(tmp_path / "wh")
    for i in range(3):
        deliver(projects(spark, [(0, "P0", f"v{i}"), (i + 1, f"P{i + 1}", "a")]), tmp_path / "in")
        load(spark, tmp_path)
    before = current(spark, tmp_path)
    loader.compact(spark, wh, "dim_project")
    loader.compact(spark, wh, "dim_project")  # nothing new
    assert current(spark, tmp_path) == before == {"P0": (0, "v2"), **{f"P{i}": (i, "a") for i in (1, 2, 3)}}
    assert len(loader.vacuum(spark, wh, "dim_project")) == 3 and loader.vacuum(spark, wh, "dim_project") == []
    assert current(spark, tmp_path) == before
    deliver(projects(spark, [(0, "P0", "late")]), tmp_path / "in")
    load(spark, tmp_path)
    loader.compact(spark, wh, "dim_project")
    assert current(spark, tmp_path) == {**before, "P0": (0, "late")}
    assert [v.last_batch for v in loader.versions(spark, wh, "dim_project")] == [2, 3]
    loader.vacuum(spark, wh, "dim_project")
    assert current(spark, tmp_path) == {**before, "P0": (0, "late")}
    assert len(list((tmp_path / "wh" / "dim_project" / "compacted").iterdir())) == 1


def both_views(spark, root):
    wh = str(root / "wh")
    views = [loader.current_rows(spark, wh, "dim_project", keep_vanished=k) for k in (False, True)]
    return [sorted(map(str, v.collect())) for v in views]


def test_compaction_of_a_cleared_source_loses_nothing(spark, tmp_path):
    wh, source = str(tmp_path / "wh"), tmp_path / "in"
    for i in range(3):
        rows = [(10 * i + k, f"P{k}", f"v{i}") for k in range(i, i + 3)]
        projects(spark, rows).coalesce(1).write.mode("overwrite").parquet(str(source))
        load(spark, tmp_path)
        before = both_views(spark, tmp_path)
        loader.compact(spark, wh, "dim_project")
        assert both_views(spark, tmp_path) == before
        loader.vacuum(spark, wh, "dim_project")
        assert both_views(spark, tmp_path) == before
    assert [len(v) for v in before] == [3, 5]
    names = {r.project_id: r.project_name for r in loader.current_rows(spark, wh, "dim_project", True).collect()}
    assert names == {"P0": "v0", "P1": "v1", "P2": "v2", "P3": "v2", "P4": "v2"}


def test_an_older_file_shows_again_when_the_newer_one_leaves(spark, tmp_path):
    wh, source = str(tmp_path / "wh"), tmp_path / "in"
    deliver(projects(spark, [(0, "P0", "old"), (1, "P1", "old")]), source)
    load(spark, tmp_path)
    first = set(source.glob("*.parquet"))
    deliver(projects(spark, [(0, "P0", "new")]), source)
    load(spark, tmp_path)
    loader.compact(spark, wh, "dim_project")
    assert current(spark, tmp_path) == {"P0": (0, "new"), "P1": (1, "old")}
    (newer,) = set(source.glob("*.parquet")) - first
    newer.unlink()
    load(spark, tmp_path)
    assert current(spark, tmp_path) == {"P0": (0, "old"), "P1": (1, "old")}
    kept = loader.current_rows(spark, wh, "dim_project", keep_vanished=True)
    assert {r.project_id: r.project_name for r in kept.collect()} == {"P0": "new", "P1": "old"}


def test_a_reader_opened_before_compaction_finishes(spark, tmp_path):
    wh = str(tmp_path / "wh")
    deliver(projects(spark, [(0, "P0", "a"), (1, "P1", "b")]), tmp_path / "in")
    load(spark, tmp_path)
    opened = loader.current_rows(spark, wh, "dim_project")
    loader.compact(spark, wh, "dim_project")
    deliver(projects(spark, [(2, "P2", "c")]), tmp_path / "in")
    load(spark, tmp_path)
    loader.compact(spark, wh, "dim_project")
    assert opened.count() == 2 and loader.current_rows(spark, wh, "dim_project").count() == 3
    kept_version = loader.versions(spark, wh, "dim_project")
    loader.vacuum(spark, wh, "dim_project", keep=2)
    assert loader.versions(spark, wh, "dim_project") == kept_version
    loader.vacuum(spark, wh, "dim_project", keep=0)
    assert loader.versions(spark, wh, "dim_project") == kept_version


def test_an_unfinished_compaction_is_not_read(spark, tmp_path):
    wh = str(tmp_path / "wh")
    deliver(projects(spark, [(0, "P0", "a")]), tmp_path / "in")
    load(spark, tmp_path)
    loader.compact(spark, wh, "dim_project")
    stray = tmp_path / "wh" / "dim_project"
    (stray / "manifest" / "version=2").mkdir()
    (stray / "compacted" / "rows-half").mkdir()
    assert current(spark, tmp_path) == {"P0": (0, "a")}
    loader.vacuum(spark, wh, "dim_project")
    assert not (stray / "compacted" / "rows-half").exists()
    deliver(projects(spark, [(1, "P1", "b")]), tmp_path / "in")
    load(spark, tmp_path)
    loader.compact(spark, wh, "dim_project")
    assert [v.number for v in loader.versions(spark, wh, "dim_project")] == [1, 3]
    assert current(spark, tmp_path) == {"P0": (0, "a"), "P1": (1, "b")}
    empty = loader.current_rows(spark, str(tmp_path / "none"), "dim_project", keep_vanished=True)
    assert empty.count() == 0
