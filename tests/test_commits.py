"""Commits that only one writer makes, versioned tables, claims of ranks and the report's exactly-once sink."""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.incremental import RANK
from ledgerloom.plans import deployment
from ledgerloom.plans.deployment import insert_batch, ledger, refresh_batch
from ledgerloom.plans.maintenance import backup_rows, delete_rows, restore_rows
from ledgerloom.sources.commits import CommitLog, Conflict, create_once, read_text
from ledgerloom.sources.ledger import claim_ranks, consumed_rank_max, give_up, inserted_entity_ids, read_ledger, update_manifest, write_entity_ids
from ledgerloom.sources.tables import write_table
from ledgerloom.sources.versions import WHOLE, VersionedTable, files_of
from ledgerloom.streaming.report_stream import maintain_report, read_report, refresh_report, storage_stream

KEY, TARGET = "SK_ID_CURR", "TARGET"


def assets(spark, n):
    ids = spark.range(1, n + 1).select(F.col("id").alias(RANK), (F.col("id") + 100000).alias(KEY))
    return ids, ids.select(KEY, (F.col(RANK) % 2).cast("int").alias(TARGET), F.col(RANK).alias("feature"))


def values(df, column=KEY):
    return sorted(r[column] for r in df.select(column).collect())


# ---------------------------------------------------------------- commits


def test_one_of_many_writers_creates_a_file(spark, folder):
    path = f"{folder}/log/v1.json"
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda n: create_once(spark, path, f"writer {n}" * 1000), range(24)))
    assert sum(made) == 1 and read_text(spark, path) == f"writer {made.index(True)}" * 1000
    # nothing is left beside it
    assert [n for n in os.listdir(f"{folder}/log") if not n.endswith(".crc")] == ["v1.json"]


def test_versions_of_writers_that_meet_are_all_kept(spark, folder):
    log = CommitLog(spark, f"{folder}/runs/r")
    assert log.last() == 0 and update_manifest(spark, f"{folder}/runs", "r", x=1) == 0
    log.commit(1, {"run_id": "r", "status": "inserted", "rows_inserted": 1, "holdout_end_rank": 7, "unknown": {"kept": True}})
    with ThreadPoolExecutor(6) as pool:
        got = sorted(pool.map(lambda n: update_manifest(spark, f"{folder}/runs", "r", **{f"field{n}": n}), range(6)))
    assert got == list(range(2, 8))
    last = log.read(7)
    assert last["unknown"] == {"kept": True} and [last[f"field{n}"] for n in range(6)] == list(range(6))
    assert read_ledger(spark, f"{folder}/runs").count() == 1 and consumed_rank_max(read_ledger(spark, f"{folder}/runs")).first()[0] == 7


def test_a_write_that_dies_leaves_the_last_version(spark, folder, monkeypatch):
    """An update that fails on the way changes nothing: the consumed mark stays."""
    ids, source = assets(spark, 6)
    insert_batch(spark, ids, source, f"{folder}/runs", f"{folder}/t", "r1", 4, KEY, TARGET)
    monkeypatch.setattr("ledgerloom.sources.commits.json.dumps", lambda *a, **k: (_ for _ in ()).throw(OSError("disk")))
    with pytest.raises(OSError):
        update_manifest(spark, f"{folder}/runs", "r1", dw_refresh={"status": "refreshed"})
    monkeypatch.undo()
    assert consumed_rank_max(ledger(spark, f"{folder}/runs")).first()[0] == 4


# ---------------------------------------------------------------- batches of two writers


def test_of_two_writers_one_fails(spark, folder):
    ids, source = assets(spark, 10)
    runs, table = f"{folder}/runs", f"{folder}/t"
    # the other writer has taken the ranks and is at work
    assert claim_ranks(spark, runs, "other", 1, 4)
    with pytest.raises(Conflict, match="held by run 'other'"):
        insert_batch(spark, ids, source, runs, table, "r1", 4, KEY, TARGET)
    assert not os.path.exists(table) and not os.path.exists(f"{runs}/r1")
    # the other one ends its work, however long it took
    insert_batch(spark, ids, source, runs, table, "other", 4, KEY, TARGET)
    second = insert_batch(spark, ids, source, runs, table, "r1", 4, KEY, TARGET).first()
    assert second["holdout_start_rank"] == 5 and values(spark.read.parquet(table)) == list(range(100001, 100009))


def test_a_writer_with_an_old_view_takes_the_next_ranks(spark, folder, monkeypatch):
    """Between a run's look at the ledger and its claim another run inserts the same ranks."""
    ids, source = assets(spark, 10)
    runs, table = f"{folder}/runs", f"{folder}/t"
    inner, met = deployment.claim_ranks, []

    def claim(spark, folder, run_id, start, end):
        if not met:
            met.append(run_id)
            insert_batch(spark, ids, source, runs, table, "quick", 3, KEY, TARGET)
        return inner(spark, folder, run_id, start, end)

    monkeypatch.setattr(deployment, "claim_ranks", claim)
    slow = insert_batch(spark, ids, source, runs, table, "slow", 3, KEY, TARGET).first()
    assert met == ["slow"] and slow["holdout_start_rank"] == 4
    assert values(spark.read.parquet(table)) == list(range(100001, 100007))


def test_writers_at_once_repeat_and_lose_nothing(spark, folder):
    ids, source = assets(spark, 40)
    runs, table = f"{folder}/runs", f"{folder}/t"

    def run(n):
        try:
            insert_batch(spark, ids, source, runs, table, f"r{n}", 5, KEY, TARGET)
            return True
        except Conflict:
            return False

    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(run, range(4)))
    assert any(done)
    rows = values(spark.read.parquet(table))
    assert rows == list(range(100001, 100001 + 5 * sum(done)))
    assert values(inserted_entity_ids(ledger(spark, runs))) == rows


def test_a_run_that_died_is_resumed_or_given_up(spark, folder, monkeypatch):
    ids, source = assets(spark, 9)
    runs, table = f"{folder}/runs", f"{folder}/t"
    monkeypatch.setattr(deployment, "write_manifest", lambda *a: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError):
        insert_batch(spark, ids, source, runs, table, "r1", 3, KEY, TARGET)
    monkeypatch.undo()
    # its rows are there, its manifest is not: another run may not take the ranks
    assert len(values(spark.read.parquet(table))) == 3
    with pytest.raises(Conflict):
        insert_batch(spark, ids, source, runs, table, "r2", 3, KEY, TARGET)
    give_up(spark, runs, "r1")
    insert_batch(spark, ids, source, runs, table, "r2", 3, KEY, TARGET)
    assert values(spark.read.parquet(table)) == [100001, 100002, 100003]
    with pytest.raises(FileExistsError):
        give_up(spark, runs, "r2")
    with pytest.raises(FileExistsError):
        insert_batch(spark, ids, source, runs, table, "r1", 3, KEY, TARGET)
    # a run that is started again goes on with its own claim
    assert claim_ranks(spark, runs, "r3", 4, 6) and claim_ranks(spark, runs, "r3", 4, 6)
    assert insert_batch(spark, ids, source, runs, table, "r3", 3, KEY, TARGET).first()["holdout_end_rank"] == 6


def test_ids_of_all_folders_are_seen(spark, folder):
    rows = []
    for n in (1, 2):
        path = write_entity_ids(spark.createDataFrame([(n,)], f"{KEY} long"), f"{folder}/ledger{n}", f"run{n}")
        rows.append((f"run{n}", "inserted", 1, n, path))
    found = spark.createDataFrame(rows, "run_id string, status string, rows_inserted long, holdout_end_rank long, entity_ids_path string")
    assert values(inserted_entity_ids(found.withColumn("entity_ids", F.array().cast("array<bigint>")))) == [1, 2]


# ---------------------------------------------------------------- versioned tables


def test_a_table_is_replaced_by_rows_read_from_itself(spark, folder):
    table = VersionedTable(spark, f"{folder}/t")
    assert table.version() == 0
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.replace(spark.range(10)) == 1
    old = table.read()
    assert table.replace(table.read().where("id > 6")) == 2
    assert values(table.read(), "id") == [7, 8, 9] and values(table.read(1), "id") == list(range(10))
    # a plan over the old version still finds its files
    assert old.count() == 10
    assert table.replace(table.read().limit(0)) == 3 and table.read().count() == 0
    with pytest.raises(ValueError):
        table.read(4)


def test_writers_of_one_version(spark, folder, monkeypatch):
    table = VersionedTable(spark, f"{folder}/t")
    table.replace(spark.range(3))
    inner = VersionedTable._write

    def write(self, df):
        added = inner(self, df)
        # another writer commits while this one writes its files
        monkeypatch.setattr(VersionedTable, "_write", inner)
        VersionedTable(spark, f"{folder}/t").append(spark.range(100, 101))
        return added

    monkeypatch.setattr(VersionedTable, "_write", write)
    with pytest.raises(Conflict):
        table.replace(spark.range(50, 51))
    assert values(table.read(), "id") == [0, 1, 2, 100]
    monkeypatch.setattr(VersionedTable, "_write", write)
    assert table.append(spark.range(7, 8)) == 4
    assert values(table.read(), "id") == [0, 1, 2, 7, 100, 100]


def test_appends_at_once_and_whole_lists(spark, folder):
    table = VersionedTable(spark, f"{folder}/t")
    table.replace(spark.range(0))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: table.append(spark.range(n, n + 1), [f"in{n}"]), range(WHOLE + 4)))
    assert values(table.read(), "id") == list(range(WHOLE + 4)) and len(table.inputs()) == WHOLE + 4
    assert table.append(spark.range(99, 100), ["in3"]) is None and table.read().where("id = 99").isEmpty()
    assert table.log.read(WHOLE)["whole"] and table.read(WHOLE - 1).count() == WHOLE - 2
    with pytest.raises(ValueError, match="do not match"):
        table.append(spark.range(1).toDF("other"))


def test_only_files_with_such_rows_are_rewritten(spark, folder):
    path = f"{folder}/t"
    table = VersionedTable(spark, path)
    table.replace(spark.range(1, 801).select(F.col("id").alias(KEY), F.lit("x").alias("x")).repartitionByRange(8, KEY))
    before = set(files_of(spark, path))
    assert tuple(backup_rows(table.read(), KEY, 120, f"{folder}/b")) == (120, 681, 800)
    assert tuple(delete_rows(spark, path, KEY, 120)) == (120, 681, 800)
    assert len(before & set(files_of(spark, path))) == 6
    assert tuple(restore_rows(spark, f"{folder}/b", path, [KEY], 5)) == (5, 681, 685)
    assert values(table.read()) == list(range(1, 686)) and table.read(1).count() == 800
    assert table.rewrite(F.col(KEY) > 10_000, lambda rows: rows)[1] == 0


def test_top_rows_with_ties_and_nulls_go_from_a_versioned_table(spark, folder):
    table = VersionedTable(spark, f"{folder}/t")
    table.replace(spark.createDataFrame([(5, i) for i in range(6)] + [(1, 0), (None, 1), (5, 0)], "v int, id int").repartition(3))
    delete_rows(spark, f"{folder}/t", "v", 3)
    assert table.read().count() == 6 and table.read().where("v = 5").count() == 4
    delete_rows(spark, f"{folder}/t", "v", 99)
    assert table.read().count() == 0
    assert delete_rows(spark, f"{folder}/t", "v", 2)["rows"] == 0


def test_a_plain_table_survives_a_replacement_that_fails(spark, folder):
    path = f"{folder}/t"
    write_table(spark.range(5), path)
    write_table(spark.read.parquet(path).where("id > 1"), path)
    assert values(spark.read.parquet(path), "id") == [2, 3, 4]
    with pytest.raises(Exception):
        write_table(spark.range(3).select(F.raise_error(F.lit("killed")).cast("long").alias("id")), path)
    assert values(spark.read.parquet(path), "id") == [2, 3, 4]


# ---------------------------------------------------------------- the report


def test_a_new_checkpoint_after_new_files_neither_repeats_nor_loses(spark, folder):
    storage, output = f"{folder}/storage", f"{folder}/report"
    dims = {"dict_dim_s": spark.createDataFrame([(1, "one")], "S_ID int, S string")}
    schema = "k int, S_ID int"

    def add(*rows):
        write_table(spark.createDataFrame(rows, schema).coalesce(1), storage, "append")

    def stream(state):
        df = storage_stream(spark, storage, spark.createDataFrame([], schema).schema, max_files=1)
        maintain_report(df, lambda: dims, output, f"{folder}/{state}").awaitTermination()

    add((1, 1))
    add((2, 1))
    stream("first")
    add((3, 1))
    assert refresh_report(spark, storage, output, lambda: dims) == 1
    add((4, 2))
    dims = {"dict_dim_s": spark.createDataFrame([(2, "two")], "S_ID int, S string")}
    stream("second")
    stream("first")
    assert refresh_report(spark, storage, output, lambda: dims) == 0
    assert sorted(tuple(r) for r in read_report(spark, output).select("k", "S").collect()) == [(1, "one"), (2, "one"), (3, "one"), (4, "two")]


@pytest.mark.parametrize("versioned", [False, True])
def test_a_refresh_brings_the_report_rows_of_its_batch(spark, folder, versioned):
    ids, source = assets(spark, 12)
    runs, storage, output = f"{folder}/runs", f"{folder}/storage", f"{folder}/report"
    rows = source.drop(TARGET)
    if versioned:
        VersionedTable(spark, storage).replace(rows.where(F.col(KEY) <= 100004))
    else:
        write_table(rows.where(F.col(KEY) <= 100004), storage)
    refresh_report(spark, storage, output)
    insert_batch(spark, ids, source, runs, f"{folder}/t", "r1", 7, KEY, TARGET)
    new = ids.where(F.col(RANK) > 4).where(F.col(RANK) <= 7).select(KEY)
    counts = refresh_batch(spark, rows, storage, new, KEY, output, runs, "r1").first()
    assert counts.asDict() == {"entity_count": 3, "storage_count": 3, "reporting_count": 3}
    assert read_ledger(spark, runs).first()["dw_refresh"]["reporting_count"] == 3
    assert values(read_report(spark, output)) == list(range(100001, 100008))


# ---------------------------------------------------------------- the running sample


def test_a_running_sample_is_the_same_for_any_split(spark, folder):
    from ledgerloom.operators.profile import maintain_sample, reproducible_sample, running_sample

    df = spark.range(3000).select((F.col("id") % 1000).alias("k"), "id").repartition(7)
    want = sorted(map(tuple, reproducible_sample(df, 40, ["k", "id"]).collect()))
    brute = sorted(map(tuple, df.orderBy(F.md5(F.concat_ws("|", "k", "id", F.lit("42")))).limit(40).collect()))
    assert want == brute and len(want) == 40
    for cuts in ((0, 3000), (0, 5, 17, 2999, 3000), (0, 1500, 1500, 3000)):
        state = None
        for a, b in zip(cuts, cuts[1:]):
            state = running_sample(state, df.where((F.col("id") >= a) & (F.col("id") < b)), 40, ["k", "id"])
        assert sorted(map(tuple, state.collect())) == want
    # one key is a third of the rows, and a table smaller than the sample comes back whole
    same = df.withColumn("k", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("k")))
    assert reproducible_sample(same, 1500, ["k"]).count() == 1500 and reproducible_sample(df, 5000, ["k"]).count() == 3000

    path = f"{folder}/in"
    write_table(df.repartition(6), path)
    for state in ("a", "a"):
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(path)
        maintain_sample(stream, f"{folder}/sample", f"{folder}/{state}", 40, ["k", "id"]).awaitTermination()
    assert sorted(map(tuple, VersionedTable(spark, f"{folder}/sample").read().collect())) == want
