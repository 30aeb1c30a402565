"""Readers in ranges, types, stores, exact splits and long replacement lists, against plain Python."""

import csv
import io
import json
import random
import threading

import pytest
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import labels, replacement, types
from millrace.sources import files, osm, records, stores


@pytest.fixture
def ranges(spark):
    """Sets the size of the ranges in which files are read."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]

    def use(size):
        for name, value in zip(names, (str(size), "1"), strict=True):
            spark.conf.set(name, value)

    yield use
    for name, value in zip(names, old, strict=True):
        spark.conf.set(name, value)


def noisy_csv(rng, n):
    """Text with quoted line ends, doubled quotes, quotes inside plain fields, blank lines and unlike line ends."""
    cells = ["a", "", "x,y", 'say "hi"', "two\nlines", "two\r\nlines", "é漢", 'q"', "\n\n\n", " b ", '"']
    out = []
    for _ in range(n):
        row = [rng.choice(cells) for _ in range(rng.randrange(1, 5))]
        shown = ['"' + c.replace('"', '""') + '"' if rng.random() < 0.5 or any(x in c for x in ',"\r\n') else c for c in row]
        if rng.random() < 0.1:
            shown.append('in"side')
        if rng.random() < 0.05:
            shown.append('"closed" and on')
        out.append(",".join(shown) + rng.choice(["\n", "\n", "\r\n", "\r", "\n\n"]))
    return "".join(out)


@pytest.mark.parametrize("size", [7, 40, 1000, 1 << 27])
def test_records_in_ranges(spark, tmp_path, ranges, size):
    ranges(size)
    rng = random.Random(size)
    n = 12 if size < 10 else 60
    bodies = {"a.csv": noisy_csv(rng, n), "b.csv": "﻿" + noisy_csv(rng, n).rstrip("\r\n"), "c.csv": 'x,"' + "long\n" * n + '",y', "d.csv": "", "e.csv": 'open,"never closed\nagain'}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body.encode())
    got = {}
    for r in files.read_cells(spark, str(tmp_path)).collect():
        got.setdefault(r["source_file"].split("/")[-1], []).append((r["row_no"], r["cells"]))
    for name, body in bodies.items():
        want = list(enumerate(csv.reader(io.StringIO(body.removeprefix("﻿"), newline=""))))
        assert sorted(got.get(name, [])) == want, name
    if size == 40:
        assert records.lines(spark, str(tmp_path), "*.csv").select("path", "block").distinct().count() > 20


@pytest.mark.parametrize("size", [9, 60, 1 << 27])
def test_elements_in_ranges(spark, tmp_path, ranges, size):
    ranges(size)
    rng = random.Random(1)
    value = lambda: rng.choice([None, 1.5, "a,b]", 'q"\\', [1, {"x": "[{"}], {"y": {"z": [[], {}]}}, "é漢\n", True])
    held = {"a.json": [{"k": value(), "v": value()} for _ in range(25)], "b.json": [1, "two, [", None, [3]], "c.json": [], "d.json": [{"long": ["x" * 5] * 40}]}
    for i, (name, array) in enumerate(held.items()):
        (tmp_path / name).write_text(json.dumps(array, indent=2 if i != 1 else None, ensure_ascii=i % 2 == 0))
    got = {}
    for r in records.read_elements(spark, str(tmp_path)).collect():
        got.setdefault(r["path"].split("/")[-1], {})[r["row_no"]] = json.loads(r["element"])
    for name, array in held.items():
        assert [v for _, v in sorted(got.get(name, {}).items())] == array and sorted(got.get(name, {})) == list(range(len(array)))
    if size < 100:
        assert records.lines(spark, str(tmp_path), "a.json").select("block").distinct().count() > 10


def test_previews_read_the_head(spark, tmp_path):
    (tmp_path / "a b%.csv").write_text("h,i\n" + '"1\n2",x\n' * 5)
    (tmp_path / "long.csv").write_text("h\n" + '"' + "y\n" * 50_000 + '"\nz\n' + "w\n" * 200_000)
    (tmp_path / "short.csv").write_text("only")
    (tmp_path / "none.csv").write_text("")
    got = files.read_preview(spark, str(tmp_path), most=3).collect()
    rows = {name: [r["cells"] for r in sorted(got, key=lambda r: r["row_no"]) if r["source_file"] == name] for name in {r["source_file"] for r in got}}
    assert rows == {"a b%.csv": [["h", "i"], ["1\n2", "x"], ["1\n2", "x"]], "long.csv": [["h"], ["y\n" * 50_000], ["z"]], "short.csv": [["only"]]}


def test_types(spark):
    columns = {"long": ["1", " -2 ", "+3"], "double": ["1", "", "2"], "double2": ["1.5", "-.5e3", "inf"], "double3": ["", "NA", None], "boolean": ["True", "false", "TRUE"], "string": ["True", "", "False"], "string2": ["1", "x", "2"], "string3": ["True", "1", "0"], "string4": ["99999999999999999999", "1", "2"]}
    head = [("a", 0, list(columns))]
    rows = [("a", i + 1, [c[i] for c in columns.values()]) for i in range(3)] + [("a", 9, []), ("b", 0, ["long", "boolean", "more", "more"]), ("b", 1, ["7", "true", "1"])]
    cells = spark.createDataFrame(head + rows, "source_file string, row_no long, cells array<string>")
    classes = types.column_classes(cells)
    found = {(r["source_file"], r["name"]): r["type"] for r in types.column_types(classes).collect()}
    assert {k: v for k, v in found.items() if k[0] == "a"} == {("a", c): c.rstrip("0123456789") for c in columns}
    assert found["b", "long"] == "long" and found["b", "more"] == "long" and found["b", "more.1"] == "double"
    assert (found[None, "long"], found[None, "boolean"], found[None, "more"], found[None, "double"]) == ("long", "boolean", "double", "double")
    merged = classes.groupBy("name").agg(F.bit_or("classes").alias("classes"))
    assert merged.join(classes.where("source_file = 'a'").select("name"), "name").count() == len(columns)
    values = types.typed_rows(files.rows_by_header(cells), types.column_types(classes)).where("source_file = 'a' and row_no = 2")
    got = values.select(F.transform_values("fields", lambda k, v: F.schema_of_variant(v)).alias("t"), F.to_json("fields").alias("j")).first()
    assert got["t"]["double2"] == "DOUBLE" and got["t"]["long"] == "BIGINT" and got["t"]["boolean"] == "BOOLEAN" and "double" not in got["t"]
    assert json.loads(got["j"])["long"] == -2


def test_extract_in_ranges(spark, tmp_path):
    rows = [(i - 5, {"power": "substation" if i % 3 else "plant", "name": f"Werk {i} é", "ref": str(i)}) for i in range(3000)] + [(9000, {"ref": "x"}), (9001, None)]
    df = spark.createDataFrame(rows, "id long, tags map<string,string>").coalesce(2)
    osm.BLOCK_ENTITIES, old = 100, osm.BLOCK_ENTITIES
    try:
        body = b"".join(osm.way_blob(rows[a : a + 100]) for a in range(0, 3000, 100))
    finally:
        osm.BLOCK_ENTITIES = old
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "big.osm.pbf").write_bytes(body)
    want = {(i, tuple(sorted(t.items()))) for i, t in rows if t and t.get("power") == "substation"}
    for size in (500, 5_000, 1 << 26):
        found = osm.read_ways(spark, str(tmp_path / "one"), range_bytes=size)
        assert found.rdd.getNumPartitions() == -(-len(body) // size)
        assert sorted((r["id"], tuple(sorted(r["tags"].items()))) for r in found.collect()) == sorted(want)
    osm.write_ways(df, str(tmp_path / "two"))
    again = osm.read_ways(spark, str(tmp_path / "two"))
    assert {(r["id"], tuple(sorted(r["tags"].items()))) for r in again.collect()} == want
    assert osm.read_ways(spark, str(tmp_path / "two"), key="none", value="x").count() == 0


def test_extract_condition_is_pushed():
    reader = osm.WayReader("/nowhere", "power", "*", 10)
    kept = list(reader.pushFilters([osm.EqualTo(("value",), "plant"), osm.EqualTo(("id",), 3), osm.In(("value",), ("plant", "line"))]))
    assert kept == [osm.EqualTo(("id",), 3)] and reader.wanted == {"plant"}
    blob = osm.way_blob([(1, {"power": "line"}), (2, {"power": "plant"})])
    at = blob.index(b"OSMData") - 6
    assert at == 0 and [i for i, _ in osm.ways(blob[4 + int.from_bytes(blob[:4], "big") :], "power", {"plant"})] == [2]
    with pytest.raises(ValueError, match="compression"):
        osm.block(osm._field(9, b"x"))


def test_split_exactly(spark):
    for n in (0, 1, 4, 5, 999):
        df = spark.range(n).select("id", (F.col("id") % 7).alias("anchor"))
        assert labels.split_exact(df, "id").where("part = 'test'").count() == -(-n // 5)
    df = spark.range(1000).select("id", F.when(F.col("id") % 11 > 0, F.col("id") % 11).alias("anchor"))
    own = labels.split_exact(df, "anchor", by_key=True)
    assert own.where("part = 'test'").select("anchor").distinct().count() == 3 and own.select("anchor", "part").distinct().count() == 11
    copies = spark.range(1000).select(F.lit(5).alias("id"))  # all draws are equal
    got = labels.split_exact(copies, "id", 0.3)
    assert got.count() == 1000 and got.where("part = 'test'").count() == 300 and got.columns == ["id", "part"]
    assert sorted(labels.split_exact(df, "id", seed=1).collect()) == sorted(labels.split_exact(df.repartition(3), "id", seed=1).collect())


def test_nth_draw(spark):
    rng = random.Random(5)
    draws = [rng.randrange(1 << 60) for _ in range(300)] + [7] * 5
    df = spark.createDataFrame([(d,) for d in draws], "draw long")
    for n in (1, 3, 6, 150, 305):
        value, before = labels.nth_draw(df, n)
        assert value == sorted(draws)[n - 1] and before == sum(d < value for d in draws)


def test_replacement_is_the_fold(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(2, 7))) for _ in range(2000)]
    entries = [(w, rng.choice([None, "x", rng.choice(words), rng.choice(words) + " y"])) for w in words] + [("", "no"), (None, "no")]
    texts = [None, "", "abc"] + [" ".join(rng.choice(words) if rng.random() < 0.1 else "zz" for _ in range(20)) for _ in range(40)]

    def plain(t):
        for code, name in entries:
            if t is not None and code and name is not None and len(t) < 10**6:
                t = t.replace(code, f"{code} ({name})")
        return t

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", replacement.replace_all(F.col("t"), [(c, n) for c, n in entries if len(c or "") > 3]).alias("new")).collect()
    entries = [(c, n) for c, n in entries if len(c or "") > 3]
    assert all(r["new"] == plain(r["t"]) for r in got)
    few = entries[:30]
    arr = F.array(*[F.struct(F.lit(c).alias("code"), F.lit(n).cast("string").alias("name")) for c, n in few])
    both = df.select(replacement.replace_all(F.col("t"), few).alias("a"), T.replace_in_order(F.col("t"), arr).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in both)


def test_label_store(spark, tmp_path):
    store = stores.LabelStore(spark, str(tmp_path / "s"), ["k"], "v", 8)
    assert store.read() is None
    rows = lambda *r: spark.createDataFrame(r, "k long, v long, label string")
    store.upsert(rows(*[(i, 1, "a") for i in range(100)]))
    before = {p: p.read_bytes() for p in (tmp_path / "s" / "labels").rglob("*.parquet")}
    assert store.upsert(rows((3, 2, "b"), (500, 2, "new"))) == 1
    assert all(p.read_bytes() == body for p, body in before.items())
    manifests = [json.loads((tmp_path / "s" / "manifests" / f"{n}.json").read_text())["folders"] for n in (0, 1)]
    assert 1 <= sum(manifests[0][b] != manifests[1][b] for b in manifests[0]) <= 2  # only the touched buckets moved
    assert {r["k"]: r["label"] for r in store.read().collect()} == {**dict.fromkeys(range(100), "a"), 3: "b", 500: "new"}
    store.upsert(rows((3, 1, "late")))  # an older version doesn't win
    assert store.read().where("k = 3").first()["label"] == "b"
    threads = [threading.Thread(target=store.upsert, args=(rows((1000 + i, 9, "t")),)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert store.read().where("k >= 1000").count() == 4 and store._manifest()[0] == 6


def counting(folder):
    """A client that counts each request in a file, and fails once, at its third batch."""

    class Counting:
        def __init__(self, folder):
            self.folder = folder

        def ask(self, requests):
            with open(f"{self.folder}/batches", "a+") as f:
                f.write("x")
                f.seek(0)
                count = len(f.read())
            if count == 3:
                raise RuntimeError("lost")
            with open(f"{self.folder}/asked", "a") as f:
                f.write("".join(f"{r}\n" for r in requests))
            return [None if r == "r5" else r.upper() for r in requests]

    return Counting(folder)


def test_answers_are_asked_once(spark, tmp_path):
    rows = spark.createDataFrame([(i, None if i == 7 else f"r{i % 40}") for i in range(90)], "i long, r string").coalesce(1)
    store = stores.AnswerStore(spark, str(tmp_path / "answers"))
    client = counting(str(tmp_path))
    run = lambda: store.answered(rows, F.col("r"), client, batch=5)
    try:
        got = run().collect()
    except Exception:  # noqa: BLE001 a local master doesn't try tasks again
        got = run().collect()
    assert {r["i"]: r["answer"] for r in got} == {i: None if i == 7 or i % 40 == 5 else f"R{i % 40}" for i in range(90)}
    asked = (tmp_path / "asked").read_text().split()
    assert len(asked) == len(set(asked)) == 40
    more = store.answered(rows.withColumn("r", F.concat("r", F.lit("+"))).limit(3).union(rows), F.col("r"), client, batch=5)
    assert more.count() == 93 and len((tmp_path / "asked").read_text().split()) == 43


def test_replacement_passes_only_insertions():
    rng = random.Random(4)
    for signs in ("ab", "ab (", "abc()") * 400:  # codes that meet insertions at either end, or are parted by them
        word = lambda n: "".join(rng.choice(signs) for _ in range(rng.randrange(1, n)))  # noqa: B023, E731
        entries, text = [(word(7), word(5)) for _ in range(rng.randrange(1, 7))], word(30)
        want = text
        for code, name in entries:
            want = want.replace(code, f"{code} ({name})")
        own = replacement.Entries(*zip(*entries, strict=True))
        assert own.fold(text) == own.folded(text) == own.folded(text) == want


def test_chained_replacement_works_copies_out_once(monkeypatch):
    seen, names = [], [f"name {i:02}" for i in range(64)]
    own = replacement.Entries(tuple(names[:-1]), tuple(names[1:]))
    found = own.found

    class Counted:
        def iter(self, text):
            seen.append(len(text))
            return found.iter(text)

    own.found = Counted()
    texts = [f"Brand: {n}" for n in names] * 50
    out = [own.folded(t) for t in texts]
    assert out[:64] == out[64:128] and out[0].count("name") == 64
    assert sum(seen) < 100 * 64 * 64  # passes over whole texts, each time: over 20 million


def test_too_many_names_are_an_error(spark, monkeypatch, tmp_path):
    rows = [(i, f"name {i}" if i else None, "Brand#1", "LARGE", 1) for i in range(9)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    from millrace.plans import catalogue

    assert catalogue.QUERIES["chained_replace"](spark, str(tmp_path)).where("name LIKE '%: name 7 (name 8)'").count() == 1
    monkeypatch.setattr(replacement, "MOST_ENTRIES", 6)
    with pytest.raises(ValueError):
        catalogue.QUERIES["chained_replace"](spark, str(tmp_path))


def test_serialized_measure_folds_only_its_rows(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(replacement, "replace_all", lambda text, entries: asked.append(text) or text)
    rows = spark.createDataFrame([("a", "DE"), ("b", "x"), ("c", None)], "name string, source string")
    text = replacement.serialized_measure(["name"], [("a", "b")], "name", "source", "D")
    assert [r[0] for r in rows.select(text).collect()] == ["query: name: a", "query: name: b", "query: name: c"]
    assert [r[0] for r in rows.select(*asked).collect()] == ["a", None, None]
