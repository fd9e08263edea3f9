"""Operators against brute force, with hot keys and small thresholds that force every branch."""

import random

import pytest
from pyspark.sql import functions as F

from shelfwright.operators import changes as cdc, health, lineage, nearest, ordered, references as refs, search
from shelfwright.operators.relational import latest_per_key
from shelfwright.session import durable


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_nearest(inputs, options):
    found = {}
    for word in set(inputs):
        best = min((edit_distance(word.lower(), o.lower()), i, o) for i, o in enumerate(options))
        if best[0] <= 3:
            found[word] = (best[2], best[0])
    return found


def random_words(seed, count, low, high, letters="abc", prefix=""):
    rng = random.Random(seed)
    return [prefix + "".join(rng.choices(letters, k=rng.randint(low, high))) for _ in range(count)]


def check_nearest(spark, inputs, options, shared=nearest.SHARED):
    asked = spark.createDataFrame([(w,) for w in inputs], "word string")
    known = spark.createDataFrame(list(zip(options, range(len(options)))), "option string, pos int")
    got = nearest.nearest_option(asked, "word", known, "option", "pos", shared)
    assert {r["word"]: (r["suggestion"], r["distance"]) for r in got.collect()} == brute_nearest(inputs, options)


def test_nearest_equals_brute_force(spark):
    options = sorted(set(random_words(1, 150, 0, 9))) + ["Mixed-Case", "x" * 30]
    inputs = random_words(2, 200, 0, 12) + ["mixed-kase", "x" * 33, "x" * 34, "z" * 400, ""]
    for shared in (1000, 3, 0):
        check_nearest(spark, inputs, options, shared)


def test_nearest_with_a_shared_prefix(spark):
    options = sorted(set(random_words(3, 120, 4, 6, "0123456789", prefix="entry-item-")))
    inputs = random_words(4, 60, 3, 7, "0123456789", prefix="entry-item-") + random_words(5, 20, 5, 18)
    check_nearest(spark, inputs, options)


def edited(rng, word, edits, letters):
    for _ in range(edits):
        i, kind = rng.randrange(len(word) + 1), rng.randrange(3)
        word = word[:i] + (rng.choice(letters) if kind < 2 else "") + word[i + (kind > 0) :]
    return word


@pytest.mark.parametrize("length, shared, short", [(40, 3, 4), (203, 5, 16)])
def test_nearest_of_long_names_with_shared_halves(spark, length, shared, short):
    rng = random.Random(length)
    stems = ["".join(rng.choices("abcde fgh", k=length)) for _ in range(3)]
    options = sorted({edited(rng, rng.choice(stems), rng.randrange(9), "abxy") for _ in range(40)})
    inputs = [edited(rng, rng.choice(options), rng.randrange(6), "abxy") for _ in range(25)] + ["z" * length]
    asked = spark.createDataFrame([(w,) for w in inputs], "word string")
    known = spark.createDataFrame(list(zip(options, range(len(options)))), "option string, pos int")
    got = nearest.nearest_option(asked, "word", known, "option", "pos", shared, short)
    assert {r["word"]: (r["suggestion"], r["distance"]) for r in got.collect()} == brute_nearest(inputs, options)


def test_long_names_that_share_all_but_a_number_make_few_pairs(spark):
    rng = random.Random(8)
    stem = "name " * 37
    options = [(f"{stem}{rng.randrange(10**12):012d} end", i) for i in range(300)]
    terms = spark.createDataFrame([(o, i, o) for o, i in options], "_option string, _position int, _term string")
    asked = spark.createDataFrame([(o.replace("e", "x", 1),) * 2 for o, _ in options[::15]], "_input string, _asked string")
    assert nearest._shorter(terms.select("_term"), "_term", 1).count() <= 300 * 202
    pairs = nearest.crowded_candidates(asked, terms, shared=64)
    assert 20 <= pairs.count() <= 20 * 60


def test_nearest_makes_few_pairs_of_a_dense_vocabulary(spark):
    options = [(f"supplier-{i:06d}", i) for i in range(1500)]
    terms = spark.createDataFrame([(o, i, o) for o, i in options], "_option string, _position int, _term string")
    asked = spark.createDataFrame([(w, w) for w in (f"suplier-{i:06d}" for i in range(0, 1500, 5))], "_input string, _asked string")
    assert nearest.candidates(asked, terms, 1).count() <= 300 * 60
    # inputs that are far from all options, but begin like them, do not meet them all
    far = spark.createDataFrame([(w, w) for w in (f"supplier-{c}{c}{c}{i:03d}" for c in "xyz" for i in range(0, 999, 10))], "_input string, _asked string")
    assert nearest.far_candidates(far, terms).distinct().count() <= 300 * 100
    inputs = spark.createDataFrame([(f"suplier-{i:06d}",) for i in range(0, 1500, 5)], "w string")
    known = spark.createDataFrame(options, "o string, pos int")
    got = {r["w"]: (r["suggestion"], r["distance"]) for r in nearest.nearest_option(inputs, "w", known, "o", "pos").collect()}
    assert got == {f"suplier-{i:06d}": (f"supplier-{i:06d}", 1) for i in range(0, 1500, 5)}


def test_nearest_ties_go_to_the_first_option(spark):
    check_nearest(spark, ["bat"], ["cat", "BAT2", "hat", "rat"])


def test_row_numbers_and_previous_with_a_hot_key(spark):
    rng = random.Random(6)
    rows = [("hot" if i % 3 else f"k{rng.randint(0, 40)}", i) for i in range(3000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "key string, slug int").repartition(7)
    numbered = ordered.with_row_number(df, ["key", "slug"]).collect()
    assert [r["row_id"] for r in sorted(numbered, key=lambda r: (r["key"], r["slug"]))] == list(range(1, 3001))
    paired = ordered.with_previous(df, ["key"], ["slug"], "slug").collect()
    want, last = {}, {}
    for key, slug in sorted(rows):
        want[(key, slug)] = last.get(key)
        last[key] = slug
    assert {(r["key"], r["slug"]): r["previous"] for r in paired} == want


def test_chains_and_cycles(spark):
    rng = random.Random(7)
    edges = {i: rng.randrange(300) for i in range(280)}
    edges |= {1000 + i: 1001 + i for i in range(70)} | {2000: 2000, 3000: 3001, 3001: 3000}
    df = spark.createDataFrame(list(edges.items()), "node bigint, next bigint")

    def walk(start):
        path, node = [], start
        while node in edges and node not in path:
            path.append(node)
            node = edges[node]
        return path, node

    followed = {r["node"]: r for r in lineage.follow(df).collect()}
    starts, members = lineage.cycles(df)
    starts = {r["node"]: r for r in starts.collect()}
    cycles = {}
    for node in edges:
        path, end = walk(node)
        row = followed[node]
        if end in path:
            ring = path[path.index(end):]
            cycles[min(ring)] = ring
            assert row["loops"] and row["last"] in ring
            found = starts[node]
            assert (found["entry"], found["steps"], found["cycle"], found["length"]) == (
                end, path.index(end), min(ring), len(ring)
            )
        else:
            assert (row["last"], row["depth"], row["loops"]) == (end, len(path), False)
            assert node not in starts
    got = {}
    for r in members.orderBy("cycle", "position").collect():
        got.setdefault(r["cycle"], []).append(r["node"])
    for name, ring in cycles.items():
        at = ring.index(name)
        assert got[name] == ring[at:] + ring[:at]
    assert set(got) == set(cycles)


def test_lineage_edges_need_both_ends(spark):
    df = spark.createDataFrame([("a", "b"), ("b", ""), ("", "c"), ("c", None)], "id string, to string")
    assert [tuple(r) for r in lineage.edges_of(df, "id", "to").collect()] == [("a", "b")]
    assert lineage.follow(lineage.edges_of(df, "id", "to")).collect()[0]["depth"] == 1


def test_diff_and_apply(spark):
    base = spark.createDataFrame([(1, None, "a"), (2, "x", None), (3, "y", "z"), (4, "k", "k")], "id int, p string, q string")
    current = spark.createDataFrame([(1, "a", None), (2, "x", None), (3, "y", "w"), (5, "n", "n")], "id int, p string, q string")
    changes = cdc.change_set(base, current, ["id"])
    assert {r["id"]: r["op"] for r in changes.collect()} == {1: "modified", 3: "modified", 4: "deleted", 5: "added"}
    applied = cdc.apply_changes(base, changes, ["id"])
    assert sorted(map(str, applied.collect())) == sorted(map(str, current.collect()))
    children = spark.createDataFrame([(1, "c"), (4, "d"), (2, "e")], "id int, child string")
    deleted = changes.where("op = 'deleted'")
    assert sorted(r["child"] for r in cdc.cascade_delete(children, deleted, "id").collect()) == ["c", "e"]


def test_ids_avoid_the_ones_that_are_taken(spark):
    rows = spark.createDataFrame([("c", "a", None), ("c", "b", ""), ("c", "c", "kept")], "collection string, slug string, id string")
    first = {r["slug"]: r["id"] for r in cdc.assign_ids(rows, "id", ["collection", "slug"]).collect()}
    assert first["c"] == "kept" and all(len(first[s]) == 21 for s in "ab") and first["a"] != first["b"]
    # the id that 'a' would get is already held by another entity
    held = rows.withColumn("id", F.when(F.col("slug") == "c", F.lit(first["a"])).otherwise(F.col("id")))
    second = {r["slug"]: r["id"] for r in cdc.assign_ids(held, "id", ["collection", "slug"]).collect()}
    assert second["c"] == first["a"] != second["a"] and second["b"] == first["b"]


def test_changes_with_null_keys(spark):
    rows = spark.createDataFrame([(1, None, "a"), (None, "k", "b"), (2, "k", "c")], "id int, part string, v string")
    assert cdc.classify(rows, rows, ["id", "part"]).collect() == []
    new = spark.createDataFrame([(1, None, "A"), (2, "k", "c"), (None, None, "d")], rows.schema)
    changes = cdc.change_set(rows, new, ["id", "part"])
    assert {(r["id"], r["part"], r["op"]) for r in changes.collect()} == {
        (1, None, "modified"), (None, "k", "deleted"), (None, None, "added")
    }
    assert sorted(map(str, cdc.apply_changes(rows, changes, ["id", "part"]).collect())) == sorted(map(str, new.collect()))


def test_ids_with_null_and_repeated_keys(spark):
    rows = spark.createDataFrame(
        [("c", None, None, 1), ("c", "a", None, 2), ("c", "a", None, 3), (None, None, "", 4)], "collection string, slug string, id string, n int"
    )
    got = cdc.assign_ids(rows, "id", ["collection", "slug"]).collect()
    assert len(got) == 4 and len({r["id"] for r in got}) == 4 and all(len(r["id"]) == 21 for r in got)
    again = cdc.assign_ids(rows.repartition(3), "id", ["collection", "slug"]).collect()
    assert {(r["n"], r["id"]) for r in again} == {(r["n"], r["id"]) for r in got}


def test_a_hot_key_is_numbered_by_content(spark):
    rows = [("c", None if i % 3 else f"s{i % 5}", None, i) for i in range(900)] + [("c", None, None, 7)] * 2
    df = spark.createDataFrame(rows, "collection string, slug string, id string, n int").repartition(5)
    got = cdc.numbered_repeats(df, ["collection", "slug"]).collect()
    held = {}
    for r in got:
        held.setdefault(r["slug"], []).append(r)
    assert len(got) == len(rows)
    for group in held.values():
        assert sorted(r["_repeat"] for r in group) == list(range(1, len(group) + 1))
    ids = cdc.assign_ids(df, "id", ["collection", "slug"])
    assert ids.select("id").distinct().count() == len(rows)


@pytest.mark.parametrize("width, sent", [(4096, 10**6), (3, 10**6), (64, 0)])
def test_sparse_changes_equal_all_changes(spark, monkeypatch, width, sent):
    monkeypatch.setattr(cdc, "MOST_SENT", sent)
    old = spark.range(2000).select(F.col("id"), F.when(F.col("id") % 5 > 0, F.lit("k")).alias("part"), F.lit("v").alias("v"))
    old = old.unionByName(old.where("id = 9")).unionByName(spark.createDataFrame([(None, None, "n")], "id long, part string, v string"))
    new = old.where("id IS NULL OR id NOT IN (4, 9)").withColumn("v", F.when(F.col("id").isin(10, 11), F.lit(None).cast("string")).otherwise(F.col("v")))
    new = new.unionByName(spark.createDataFrame([(5000, "k", "w"), (None, "k", "w")], "id long, part string, v string"))
    want = sorted(map(str, cdc.classify(old, new, ["id", "part"]).collect()))
    assert sorted(map(str, cdc.classify_sparse(old, new, ["id", "part"], width).collect())) == want and len(want) > 5
    assert cdc.classify_sparse(old, old, ["id", "part"], width).collect() == []


def test_only_groups_that_differ_are_joined(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(cdc, "classify", lambda a, b, keys: seen.append(a.count() + b.count()))
    old = spark.range(50_000).select("id", F.lit(1).alias("v"))
    cdc.classify_sparse(old, old.withColumn("v", F.when(F.col("id") % 10_000 == 7, 2).otherwise(F.col("v"))), ["id"])
    assert 10 <= seen[0] < 60


def test_ids_of_rows_with_null_keys(spark):
    rows = spark.createDataFrame([(1, None, "a"), (None, "k", "b"), (2, "k", "c"), (3, None, "e")], "id int, part string, v string")
    new = spark.createDataFrame([(1, None, "A"), (2, "k", "c")], rows.schema)
    moved = cdc.changed_ids(rows, new, ["id", "part"], "v").collect()
    assert [(r["id"], r["part"], r["old_id"], r["new_id"]) for r in moved] == [(1, None, "a", "A")]
    gone = cdc.deleted_ids(rows, cdc.classify(rows, new, ["id", "part"]), ["id", "part"], "v").collect()
    assert {(r["id"], r["part"], r["v"]) for r in gone} == {(None, "k", "b"), (3, None, "e")}


def test_many_small_cycles_take_few_rounds(spark, monkeypatch):
    cuts = []
    monkeypatch.setattr(lineage, "durable", lambda df, eager=True: cuts.append(1) or durable(df, eager))
    edges = spark.range(3000).select(F.col("id").alias("node"), F.expr("id - id % 3 + (id + 1) % 3").alias("next"))
    members = lineage.cycle_members(edges).collect()
    assert len(members) == 3000 and {r["length"] for r in members} == {3}
    assert len(cuts) <= 10


def test_one_answer_for_a_link_that_is_cached_twice(spark):
    at = F.lit("2024-01-02").cast("timestamp")
    cache = spark.sql(
        "SELECT 'u' AS url, timestamp '2024-01-01' AS last_checked, 200 AS status, 7.0D AS ttl_days "
        "UNION ALL SELECT 'u', timestamp '2024-01-02', 404, 7.0D"
    )
    urls = spark.createDataFrame([("u",), ("v",)], "url string")
    got = {r["url"]: (r["status"], r["needs_check"]) for r in health.lookup(urls, cache, at).collect()}
    assert got == {"u": (404, False), "v": (None, True)} and health.broken(cache, at).count() == 1


def test_latest_per_key(spark):
    df = spark.createDataFrame([("u", 1, "old"), ("u", 3, "new"), ("v", 2, None)], "url string, at int, state string")
    got = latest_per_key(df, "url", ["at"])
    assert got.columns == df.columns
    assert sorted(tuple(r)[:2] for r in got.collect()) == [("u", 3), ("v", 2)]


def test_dangling_ignores_missing_references(spark):
    df = spark.createDataFrame([(1, "a"), (2, "x"), (3, None)], "i int, ref string")
    known = spark.createDataFrame([("a",), ("a",)], "key string")
    assert [r["i"] for r in refs.dangling(df, ["ref"], known, ["key"]).collect()] == [2]


def test_search_index(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, "Glowing Oscillators", "synth"), (2, "oscillator glow", None), (3, "Été", "Synthesizers")],
        "id int, name string, note string",
    )
    stemmed = search.stemmed_postings(docs, "id", ["name", "note"])
    find = lambda index, *terms, **kw: sorted(r["doc"] for r in search.matching_docs(index, list(terms), **kw).collect())
    assert find(stemmed, *search.query_terms("glows oscillator")) == [1, 2]
    assert find(stemmed, *search.query_terms("ÉTÉ")) == [3]
    assert find(stemmed, "synth", prefix=True) == [1, 3]
    plain = search.plain_postings(docs, "id", ["name", "note"])
    assert find(plain, "oscillators") == [1] and find(plain, "été", "synthesizers") == [3]
    path = str(tmp_path / "index")
    search.write_index(plain, path)
    stored = spark.read.parquet(path)
    assert find(stored, "glow") == [2]
    changed = spark.createDataFrame([(2, "dim", None)], docs.schema)
    removed = docs.where("id = 1").select("id")
    after = search.replace_docs(plain, changed, removed, "id", ["name", "note"])
    now = changed.unionByName(docs.where("id = 3"))
    whole = search.plain_postings(now, "id", ["name", "note"])
    assert sorted(map(str, after.select("term", "doc", "field").collect())) == sorted(map(str, whole.collect()))

    # several terms and a prefix; upper case; a stemmed index that is stored and then maintained
    assert find(plain, "oscillator", "gl", prefix=True) == [2] and find(plain, "glow", "glow", prefix=True) == [2]
    assert find(plain, *search.query_terms("Oscillator-GLOW", stemmed=False)) == [2]
    assert [r["id"] for r in docs.where(search.has_all_terms(F.col("name"), ["GLOW"])).collect()] == [2]
    search.write_index(stemmed, str(tmp_path / "stemmed"))
    kept = spark.read.parquet(str(tmp_path / "stemmed"))
    assert find(kept, *search.query_terms("glowed oscillating")) == [1, 2]
    after = search.replace_docs(kept, changed, removed, "id", ["name", "note"], search.stemmed_postings)
    whole = search.stemmed_postings(now, "id", ["name", "note"])
    assert sorted(map(str, after.select("term", "doc", "field").collect())) == sorted(map(str, whole.collect()))
    assert find(after, "dim") == [2] and find(after, *search.query_terms("glow")) == []
