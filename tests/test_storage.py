"""Files, snapshots and index segments: what is read, what is written, and what a failure leaves."""

import os

import pytest
from pyspark.sql import functions as F

from shelfwright.operators import search
from shelfwright.sources import document_files, documents as src, files, index_store, link_store, manifests, ranged, tables as store


@pytest.fixture
def many_files(spark):
    """As many files as there are ranges, also for small tables."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_files_are_dealt_by_bytes():
    sizes = [200] * 100_000 + [64 << 20, 30 << 20, 0]
    groups = document_files.balanced(sizes, 64 << 20)
    assert sorted(i for g in groups for i in g) == list(range(len(sizes)))
    assert len(groups) < 110  # not one for each file
    loads = [sum(sizes[i] + document_files.OPEN_COST for i in g) for g in groups]
    assert max(loads) <= 64 << 20 | 1 << 20
    assert document_files.balanced([]) == [] and document_files.balanced([5, 5], least_tasks=8) == [[0], [1]]


def test_many_small_files(spark, tmp_path):
    docs = spark.range(1500).select(
        F.lit("software").alias("collection"),
        F.concat(F.lit("s"), F.col("id").cast("string")).alias("slug"),
        F.concat(F.lit("name: n"), F.col("id").cast("string")).alias("content"),
    )
    assert document_files.write_files(docs, str(tmp_path)) == 1500
    (tmp_path / "software" / "notes.txt").write_text("no document")
    read = document_files.read_files(spark, str(tmp_path), ["software", "hardware"])
    assert read.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert read.select("slug", F.col("content").cast("string").alias("content")).exceptAll(docs.select("slug", "content")).isEmpty()
    assert read.count() == 1500 and read.where("problem IS NOT NULL").isEmpty()


def test_a_file_that_cannot_be_read_is_a_row(tmp_path):
    reader = document_files.DocumentReader({"path": str(tmp_path), "collections": "a"})
    files.write_file(f"{tmp_path}/a/one.yaml", b"x")
    (batch,) = reader.read(document_files.Share([("a", "gone.yaml"), ("a", "one.yaml")]))
    gone, one = batch.to_pylist()
    assert gone["content"] is None and gone["problem"] and gone["slug"] == "gone"
    assert one["content"] == b"x" and one["problem"] is None
    assert [s.names for s in reader.partitions()] == [[("a", "one.yaml")]]


def test_names_that_are_no_file_names_are_refused(spark, tmp_path):
    docs = spark.createDataFrame([("a", "../up", "x")], "collection string, slug string, content string")
    with pytest.raises(Exception, match="not a file name"):
        document_files.write_files(docs, str(tmp_path))


def software(spark, n, owner="o1"):
    rows = spark.range(n).select(
        F.concat(F.lit("s"), F.col("id").cast("string")).alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit(owner)).otherwise(F.concat(F.lit("m"), F.col("id").cast("string"))).alias("manufacturer_id"),
        F.concat(F.lit("name "), F.col("id").cast("string")).alias("name"),
    )
    return rows


def test_a_failed_publish_leaves_the_snapshot_before(spark, tmp_path):
    folder = str(tmp_path)
    good = {"locales": software(spark, 9).select("id"), "software": software(spark, 9)}
    first = store.write_tables(good, folder)
    assert first["number"] == 1
    failing = software(spark, 30).withColumn("name", F.raise_error(F.lit("no more")))
    with pytest.raises(Exception, match="no more"):
        store.write_tables({"locales": software(spark, 30).select("id"), "software": failing}, folder)
    entries = manifests.current(folder)
    assert entries == first
    assert all(spark.read.parquet(e["path"]).count() == 9 for e in entries["tables"].values())
    second = store.write_tables({"locales": software(spark, 4).select("id")}, folder)
    assert second["number"] == 2 and manifests.current(folder, 1) == first
    with pytest.raises(RuntimeError, match="another writer"):
        manifests.commit(folder, {}, first)


def test_look_ups_open_the_files_they_meet(spark, tmp_path, many_files):
    folder = str(tmp_path)
    rows = software(spark, 3000)
    store.write_tables({"software": rows}, folder)
    entry = manifests.current(folder)["tables"]["software"]
    assert ranged.ranges_of(spark, entry).count() > 2
    found = store.look_up(spark, folder, "software", "m1234")
    assert len(found.inputFiles()) == 1
    assert [r["id"] for r in found.collect()] == ["s1234"]
    hot = store.look_up(spark, folder, "software", "o1")
    assert hot.count() == 1000
    assert {r["id"] for r in store.look_up(spark, folder, "software", "m29", prefix=True).collect()} == {
        r["id"] for r in rows.where("manufacturer_id LIKE 'm29%'").collect()
    }
    assert store.look_up(spark, folder, "software", "zz").collect() == []


def same(a, b):
    return sorted(map(str, a.select(*index_store.ORDER).collect())) == sorted(map(str, b.select(*index_store.ORDER).collect()))


@pytest.mark.parametrize("build", [search.plain_postings, search.stemmed_postings])
def test_index_segments(spark, tmp_path, many_files, build):
    schema = "id int, name string, note string"
    docs = spark.createDataFrame([(i, f"Glowing word{i % 40} item{i}", None if i % 2 else "synths") for i in range(200)], schema)
    fields, folder = ["name", "note"], str(tmp_path / "index")
    index_store.create(build(docs, "id", fields), folder)
    base = manifests.current(folder)["segments"][0]["data"]["path"]
    before = {f: os.stat(f"{base}/{f}").st_mtime_ns for f in os.listdir(base)}
    assert same(index_store.read(spark, folder), build(docs, "id", fields))

    now = docs
    for step in range(3):
        changed = spark.createDataFrame([(i, f"dim step{step}", "glow") for i in range(step, 9)] + [(300 + step, "new", None)], schema)
        removed = docs.where(F.col("id").between(20 + step, 25 + step)).select("id")
        index_store.update(folder, changed, removed, "id", fields, build)
        ids = changed.select("id").unionByName(removed)
        now = now.join(ids, "id", "left_anti").select(*docs.columns).unionByName(changed)
        assert same(index_store.read(spark, folder), build(now, "id", fields))
    assert {f: os.stat(f"{base}/{f}").st_mtime_ns for f in os.listdir(base)} == before

    term = search.query_terms("word7", stemmed=build is search.stemmed_postings)
    hits = index_store.read(spark, folder, term, "ite")
    assert same(hits, build(now, "id", fields).where(F.col("term").isin(term) | F.startswith("term", F.lit("ite"))))
    entry = manifests.current(folder)["segments"][0]["data"]
    some = ranged.read_ranged(spark, entry, [(term[0], term[0])])
    assert 0 < len(some.inputFiles()) < len(spark.read.parquet(entry["path"]).inputFiles())

    assert len(index_store.compact(spark, folder)["segments"]) == 2  # the later ones joined
    assert same(index_store.read(spark, folder), build(now, "id", fields))
    assert manifests.current(folder)["segments"][0]["data"]["path"] == base
    assert len(index_store.compact(spark, folder, share=0)["segments"]) == 1
    assert same(index_store.read(spark, folder), build(now, "id", fields))
    assert index_store.compact(spark, folder) == manifests.current(folder)


def test_index_of_no_documents(spark, tmp_path):
    none = spark.createDataFrame([], "id int, name string")
    folder = str(tmp_path)
    index_store.create(search.plain_postings(none, "id", ["name"]), folder)
    assert index_store.read(spark, folder).collect() == [] and index_store.read(spark, folder, ["a"], "b").collect() == []
    one = spark.createDataFrame([(1, "a b")], none.schema)
    index_store.update(folder, one, none.select("id"), "id", ["name"])
    assert index_store.read(spark, folder, ["a"]).count() == 1


def test_link_cache_writes_the_buckets_it_touches(spark, tmp_path):
    folder = str(tmp_path)
    results = spark.range(300).select(
        F.concat(F.lit("http://u"), F.col("id").cast("string")).alias("url"),
        F.lit("2024-01-01").cast("timestamp").alias("last_checked"),
        F.lit(200).alias("status"),
    )
    assert link_store.read(spark, folder) is None
    assert len(link_store.put(folder, results, buckets=16)) == 16
    before = manifests.current(folder)["buckets"]
    later = results.where("url = 'http://u7'").withColumn("status", F.lit(404)).withColumn("last_checked", F.lit("2024-02-01").cast("timestamp"))
    (bucket,) = link_store.put(folder, later.unionByName(results.where("url = 'http://u7'")))
    after = manifests.current(folder)["buckets"]
    assert {b for b in after if after[b] != before[b]} == {str(bucket)}
    got = {r["url"]: r["status"] for r in link_store.read(spark, folder).collect()}
    assert got == {f"http://u{i}": 404 if i == 7 else 200 for i in range(300)}
    asked = spark.createDataFrame([("http://u7",), ("http://new",)], "url string")
    found = link_store.look_up(spark, folder, asked, F.lit("2024-02-02").cast("timestamp"))
    assert {r["url"]: (r["status"], r["needs_check"]) for r in found.collect()} == {"http://u7": (404, False), "http://new": (None, True)}
    link_store.put(folder, results.where("false"))
    assert link_store.read(spark, folder).count() == 300


def test_refresh_opens_and_parses_what_changed(spark, tmp_path):
    root, state = tmp_path / "docs", str(tmp_path / "state")
    for i in range(12):
        files.write_file(f"{root}/software/s{i}.yaml", f"name: n{i}".encode())
    files.write_file(f"{root}/software/bad.yml", b"name: [")
    first = src.refresh(spark, str(root), state)
    assert (first["read"], first["parsed"]) == (13, 13)
    files.write_file(f"{root}/software/s1.yaml", b"name: other")
    files.write_file(f"{root}/software/s2.yaml", b"name: n2")  # touched, not changed
    files.write_file(f"{root}/hardware/h.yaml", b"name: unit")
    os.remove(root / "software" / "s3.yaml")
    second = src.refresh(spark, str(root), state)
    assert (second["read"], second["parsed"]) == (3, 2)
    columns = ["collection", "slug", "path", "json", "error"]
    whole = src.read_documents(spark, str(root)).select(*columns)
    assert sorted(map(str, src.refreshed(spark, state).select(*columns).collect())) == sorted(map(str, whole.collect()))
    third = src.refresh(spark, str(root), state)
    assert (third["read"], third["parsed"]) == (0, 0)
    assert src.refreshed(spark, state, 1).count() == 13


def test_the_ranges_of_files_are_found_without_sorting_all_rows(spark, tmp_path, many_files):
    rows = spark.range(3000).select(F.when(F.col("id") % 9 > 0, F.concat(F.lit("t"), F.col("id") % 5)).alias("term"), "id")
    entry = ranged.write_ranged(rows, str(tmp_path), "rows", ["term", "id"])
    stored = ranged.read_ranged(spark, entry)
    plan = ranged.file_ranges(stored, "term")._jdf.queryExecution().executedPlan().toString()
    lowest = [line for line in plan.splitlines() if "Aggregate(" in line][-1]
    assert "HashAggregate(" in lowest
    want = stored.groupBy(F.col("_metadata.file_name")).agg(F.min("term"), F.max("term"), F.count("*"))
    assert sorted(map(str, map(tuple, ranged.ranges_of(spark, entry).collect()))) == sorted(map(str, map(tuple, want.collect())))


def test_files_are_written_by_all_cores(spark, tmp_path):
    docs = spark.range(60).coalesce(1).select(
        F.lit("software").alias("collection"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("slug"), F.lit("a: 1").alias("content")
    )
    context = spark.sparkContext
    context.setJobGroup("written files", "")
    assert document_files.write_files(docs, str(tmp_path)) == 60
    context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("written files") for s in tracker.getJobInfo(j).stageIds]
    assert max(tracker.getStageInfo(s).numTasks for s in stages if tracker.getStageInfo(s)) >= context.defaultParallelism


def test_the_driver_never_holds_the_names_of_files(spark, tmp_path, monkeypatch):
    for i in range(40):
        files.write_file(f"{tmp_path}/software/s{i}.yaml", b"a: 1" * (1 + 50 * i))
    (tmp_path / "software" / ".s9.yaml.part").write_text("being written")
    (tmp_path / "software" / "folder.yaml").mkdir()
    whole = {f.base_name: (f.size, f.mtime_ns) for f in files.listed(f"{tmp_path}/software") if f.base_name[0] != "."}

    def refused(*_):
        raise AssertionError("listed by the driver")

    monkeypatch.setattr(files, "listed", refused)
    monkeypatch.setattr(files, "listed_in_parts", refused, raising=False)
    read = document_files.read_files(spark, str(tmp_path), ["software", "hardware"], 10 * document_files.OPEN_COST)
    assert {r["slug"]: len(r["content"]) for r in read.collect()} == {n.removesuffix(".yaml"): size for n, (size, _) in whole.items()}
    assert "BatchScan" not in read._jdf.queryExecution().toString()  # planned in a process beside the driver
    listed = document_files.listing(spark, str(tmp_path), ["hardware", "software"])
    assert {r["name"]: (r["size"], r["changed"]) for r in listed.collect()} == whole


def test_names_are_dealt_by_bytes_in_all_tasks(spark):
    sizes = F.when(F.col("id") % 1000 == 0, 1 << 20).otherwise(200)
    names = spark.range(0, 6000, 1, 5).select(F.lit("a").alias("collection"), F.col("id").cast("string").alias("name"), sizes.cast("long").alias("size"), "id")
    names = names.withColumnRenamed("id", "changed")
    dealt = document_files.dealt(names, 64 << 20, 8)
    loads = [r[0] for r in dealt.groupBy(F.spark_partition_id()).agg(F.sum(F.col("size") + document_files.OPEN_COST)).collect()]
    assert len(loads) == 8 and max(loads) - min(loads) < 3 << 20
    assert dealt.exceptAll(names).isEmpty() and dealt.count() == 6000
    assert document_files.dealt(names.where("false"), 64 << 20, 8).count() == 0


def test_a_folder_is_listed_in_parts(tmp_path, monkeypatch):
    monkeypatch.setattr(files, "LISTED", 3)
    for i in range(8):
        files.write_file(f"{tmp_path}/a/n{i}", b"x")
    parts = list(files.listed_in_parts(f"file://{tmp_path}/a"))
    assert [len(p) for p in parts] == [3, 3, 2] and sorted(f[0] for p in parts for f in p) == [f"n{i}" for i in range(8)]
    assert files.stat(f"{tmp_path}/a/n0")[0] == 1 and files.stat(f"{tmp_path}/none") is None
    assert files.is_folder(f"{tmp_path}/a") and not files.is_folder(f"{tmp_path}/none") and not files.is_folder(f"{tmp_path}/a/n0")
    with pytest.raises(FileNotFoundError):
        next(files.listed_in_parts(f"{tmp_path}/none"))
