import base64
import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import headers, labels, models, pages, search
from millrace.sources import files, osm

GRID = [
    ("00202_Netz A/t.0.csv", 0, ["Netzausbauplan", "", ""]),
    ("00202_Netz A/t.0.csv", 1, ["lfd. Nr.", "Maßnahme", "Kosten"]),
    ("00202_Netz A/t.0.csv", 2, ["Index", "Maßnahme", "Projektstatus"]),
    ("00202_Netz A/t.0.csv", 3, ["1", "UW Nord", "12,5"]),
    ("00202_Netz A/t.0.csv", 4, ["2", "NA", "13"]),
    ("plain/t.1.csv", 0, ["a", "b"]),
    ("plain/t.1.csv", 1, ["1", "2", "3"]),
]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_display_names_classify_to_their_keys(spark):
    rows = spark.createDataFrame(list(T.CANONICAL.items()), "key string, name string").select("key", T.classify_header(F.col("name")).alias("got")).collect()
    assert all(r["key"] == r["got"] for r in rows)


def test_detects_titles_and_double_headers(spark):
    grid = spark.createDataFrame(GRID, "source_file string, row_no int, cells array<string>")
    spans = {r["source_file"]: (r["header_start"], r["header_end"]) for r in headers.header_rows(grid).collect()}
    assert spans == {"00202_Netz A/t.0.csv": (1, 2), "plain/t.1.csv": (0, 0)}


def test_harmonises(spark):
    grid = spark.createDataFrame(GRID, "source_file string, row_no int, cells array<string>")
    out = {(r["source_file"], r["row_no"]): r for r in headers.harmonise(grid).collect()}
    a = out[("00202_Netz A/t.0.csv", 3)]
    assert (a["operator_id"], a["operator_name"], a["massnahme"]) == ("00202", "Netz A", "UW Nord") or a["extra"]
    assert out[("plain/t.1.csv", 1)]["extra"] == {"_extra_a": "1", "_extra_b": "2"}
    assert out[("plain/t.1.csv", 1)]["operator_name"] == "plain"


def test_page_ranges(spark):
    assert one(spark, T.page_numbers(T.page_ranges(F.lit("2-3, 1,3"), F.lit(3)))) == [2, 3, 1]
    for bad in ("", "0", "3-2", "1-4"):
        with pytest.raises(Exception, match="page range"):
            one(spark, T.page_ranges(F.lit(bad), F.lit(3)))


def test_small_functions(spark):
    assert one(spark, T.list_literal(F.lit("['a', 'b']"))) == ["a", "b"]
    assert one(spark, T.id_text(F.lit(12.0))) == "12"
    assert one(spark, T.id_value(F.lit(" 7 "))) == 7
    assert one(spark, T.clue_list(F.lit(" \n"))) is None
    assert one(spark, T.vertical_lines(F.lit("1, ,2.5"))) == [1.0, 2.5]
    assert one(spark, T.folder_name(F.lit(123456), F.lit("a/b"))) == "123456_a_b"


def test_upsert_keeps_the_last_write(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, n int")
    new = spark.createDataFrame([(1, "c", 2), (3, "d", 2)], "k int, v string, n int")
    assert sorted(tuple(r) for r in labels.upsert(old, new, ["k"], "n").collect()) == [(1, "c", 2), (2, "b", 1), (3, "d", 2)]


def test_reads_cells(spark, tmp_path):
    folder = tmp_path / "output" / "00001_A & B"
    folder.mkdir(parents=True)
    (folder / "x+y (1).csv").write_text('a,"b\nc"\n"say ""hi""",\n')
    (folder / "notes.txt").write_text("no table")
    rows = files.read_cells(spark, str(tmp_path / "output")).orderBy("row_no").collect()
    assert [(r["source_file"], r["cells"]) for r in rows] == [("00001_A & B/x+y (1).csv", ["a", "b\nc"]), ("00001_A & B/x+y (1).csv", ['say "hi"', ""])]


def test_blank_headers_stay(spark):
    assert one(spark, T.header_key(F.lit(" "))) == " " and one(spark, T.header_key(F.lit("Foo\nBar"))) == "_extra_foo bar"


def test_long_cells_and_other_bytes(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"h\n" + b"x" * 200_000 + b"\n\xff,y\n")
    rows = files.read_cells(spark, str(tmp_path)).orderBy("row_no").collect()
    assert [len(r["cells"][0]) for r in rows] == [1, 200_000, 1] and rows[2]["cells"] == ["\ufffd", "y"]


def test_files_with_unlike_headers(spark, tmp_path):
    root = tmp_path / "output"
    root.mkdir()
    (root / "a.csv").write_text("k,v\n1,x\n\n2,NA\n")
    (root / "b.csv").write_text("v,w,k\ny,z,3\n")
    (root / "head only.csv").write_text("k,v\n")
    (root / "empty.csv").write_text("")
    (root / "c_csv").write_text("k\n9\n")
    got = sorted(map(tuple, files.read_tables(spark, str(root), ["k", "v", "none"]).collect()))
    assert got == [("1", "x", None, "a.csv"), ("2", None, None, "a.csv"), ("3", "y", None, "b.csv")]
    assert [r[0] for r in files.source_files(spark, str(root), "*csv").collect()] == ["a.csv", "b.csv", "c_csv", "head only.csv"]
    assert files.preview(files.read_cells(spark, str(root)), 1).count() == 3


def test_json_sources(spark, tmp_path):
    assert files.read_json_array(spark, str(tmp_path / "none.json"), "a int").count() == 0
    (tmp_path / "labels.json").write_text('[{"a": 1}, {"a": null}]')
    assert [r["a"] for r in files.read_json_array(spark, str(tmp_path / "labels.json"), "a int").collect()] == [1, None]
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "x.json").write_text('[["Nr", "Betrieb"], ["1", " a\\nb "], ["2", "a"]]')
    cells = files.read_json_tables(spark, str(tmp_path / "t"))
    assert [r["value"] for r in headers.values_under(cells, "betrieb").collect()] == ["a", "ab"]
    with pytest.raises(Exception, match="several columns"):
        headers.values_under(cells, "r").collect()
    (tmp_path / "l.json").write_text('{"entries": {"b": {"canonical_name": "B"}, "a": {"canonical_name": null}}}')
    assert files.read_lookup(spark, str(tmp_path / "l.json")).first()["entries"] == [("b", "B"), ("a", None)]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("f", "t.0", 1, ["b", ""]), ("f", "t.0", 0, ["a", "x\ny"]), ("g", "t.1", 0, ["c"])], "folder string, table string, place int, cells array<string>")
    files.write_tables(rows, str(tmp_path / "tables"))
    text = "".join(p.read_text() for p in (tmp_path / "tables" / "folder=f" / "table=t.0").glob("*.csv"))
    assert text == 'a,"x\ny"\nb,""\n'
    df = spark.createDataFrame([(2, "ü", None), (1, "a", 1)], "k int, v string, n int")
    for _ in range(2):
        files.write_json_array(df, str(tmp_path / "array"), ["k"])
        files.write_csv(df, str(tmp_path / "csv"))
    assert files.read_json_array(spark, str(tmp_path / "array"), "k int, v string, n int").collect() == [(1, "a", 1), (2, "ü", None)]
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 2
    files.write_case(df.withColumn("h", F.lit("15750298393240625771").cast("decimal(20,0)")), str(tmp_path / "cases"), "h")
    assert [p.name for p in (tmp_path / "cases").iterdir() if p.is_dir()] == ["_case=15750298393240625771"]


def test_documents(spark, tmp_path):
    rows = spark.createDataFrame([(1, "d", "a.pdf", b"1"), (2, "d", "a.pdf", b"2"), (3, "d", "a_1.pdf", b"3"), (4, "e", "a.pdf", b"4"), (5, "d", "a.pdf", b"5"), (6, "d", "none", b"6"), (7, "d", "none", b"7")], "id int, folder string, name string, content binary")
    named = files.document_names(rows, "folder", "name", "id")
    names = {r["id"]: (r["folder"], r["file"]) for r in named.collect()}
    assert len(set(names.values())) == 7 and names[1] == ("d", "a.pdf") and names[3] == ("d", "a_1.pdf") and names[7] == ("d", "none_1") and names[5] == ("d", "a_2.pdf")
    files.write_documents(named, str(tmp_path / "out"))
    assert (tmp_path / "out" / "d" / "a_1.pdf").read_bytes() == b"3" and (tmp_path / "out" / "e" / "a.pdf").read_bytes() == b"4"


def varint(n):
    out = b""
    while True:
        out += bytes([n & 127 | (128 if n > 127 else 0)])
        n >>= 7
        if not n:
            return out


def message(*parts):
    return b"".join(varint(k << 3) + varint(v) if isinstance(v, int) else varint(k << 3 | 2) + varint(len(v)) + v for k, v in parts)


def test_reads_ways(spark, tmp_path):
    strings = [b"", b"power", b"substation", b"name", "Süd".encode(), b"line"]
    way = lambda i, keys, values: message((1, i), (2, b"".join(map(varint, keys))), (3, b"".join(map(varint, values))))
    group = message((3, way(7_000_000_000, [1, 3], [2, 4])), (3, way(8, [1], [5])), (1, message((1, 3))))
    block = message((1, message(*[(1, s) for s in strings])), (2, group), (17, 100))
    body = b""
    for kind, blob in ((b"OSMHeader", message((1, b"x"))), (b"OSMData", message((2, len(block)), (3, zlib.compress(block)))), (b"OSMData", message((1, block)))):
        head = message((1, kind), (3, len(blob)))
        body += struct.pack(">I", len(head)) + head + blob
    (tmp_path / "a.osm.pbf").write_bytes(body)
    found = osm.read_ways(spark, str(tmp_path / "a.osm.pbf"))
    assert [tuple(r) for r in found.collect()] == [(7_000_000_000, "substation", {"power": "substation", "name": "Süd"})] * 2
    wide = osm.expanded(found, ("name", "ref")).first().asDict()
    assert wide == {"id": 7_000_000_000, "power": "substation", "tag::name": "Süd", "tag::ref": None}
    assert osm.read_ways(spark, str(tmp_path / "a.osm.pbf"), value="plant").count() == 0


def test_models(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, text string")
    got = models.answered(rows, F.col("text"), models.Recorded({"a": "A"})).collect()
    assert [tuple(r) for r in got] == [(1, "a", "A"), (2, None, None), (3, "c", None)]
    assert one(spark, models.clues(F.lit('{"location_clues": ["x"], "asset_type": "what"}'))) == (["x"], None)
    assert one(spark, models.clues(F.lit("no JSON"))) is None
    started = rows.withColumn("inferred:location_clues", F.when(F.col("id") == 1, F.array(F.lit("kept"))))
    client = models.Recorded({"c": '{"location_clues": ["new"], "asset_type": "substation"}', "a": '{"location_clues": ["wrong"], "asset_type": null}'})
    again = {r["id"]: (r["inferred:location_clues"], r["inferred:asset_type"]) for r in models.extract_clues(started, client, F.col("text")).collect()}
    assert again == {1: (["kept"], None), 2: (None, None), 3: (["new"], "substation")}
    with pytest.raises(Exception, match="an answer for each row"):
        models.by_chunk(rows.withColumn("f", F.lit("f")), models.Recorded({'x\n{"text":"a"}\n{}\n{"text":"c"}': '["1"]', 'x\n{"text":"a"}\n{"text":null}\n{"text":"c"}': '["1"]'}), "f", "id", ["text"], "x").collect()


def test_fetches(spark):
    rows = spark.createDataFrame([("u",)], "url string")
    assert models.fetched(rows, F.col("url"), models.Recorded({"u": "YQ=="})).first()["content"] == b"a"
    with pytest.raises(Exception, match="wasn't answered"):
        models.fetched(rows, F.col("url"), models.Recorded()).collect()


def test_reads_documents_by_client(spark):
    pdf = b"%PDF-1.4 1 0 obj <</Type /Pages>> endobj 2 0 obj <</Type /Page >> endobj 3 0 obj <</Type/Page/X 1>> endobj"
    held = spark.createDataFrame([("a.pdf", pdf), ("b", b"x")], "path string, content binary")
    assert [r[0] for r in held.orderBy("path").select(pages.page_count(F.col("content"))).collect()] == [2, None]
    code = base64.b64encode(pdf).decode()
    answer = json.dumps([{"page": 1, "table_no": 1, "rows": [["late"]]}, {"page": 1, "table_no": 0, "rows": [["a", ""], ["a", ""], ["b", None]]}])
    tables = models.found_tables(held, models.Recorded({code: answer}))
    first = pages.first_tables(tables)
    got = pages.range_rows(first, T.page_ranges(F.lit("1-2"), F.lit(2))).orderBy("place").collect()
    assert [r["cells"] for r in got] == [["a", None], ["b", None]]
    words = models.found_words(held, models.Recorded({code: '[{"page": 1, "text": "w", "x0": 352.5}]'}))
    assert [r["x0"] for r in pages.words_between(words, 350, 365).collect()] == [352.5]


def test_lookups(spark):
    part = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k int, v string")
    assert search.exactly_one(part, F.col("k") == 1).collect() == [(1, "a")]
    for bad in (2, 3):
        with pytest.raises(Exception, match="rows found"):
            search.exactly_one(part, F.col("k") == bad).collect()
    with pytest.raises(Exception, match="several rows"):
        labels.at_most_one(part, ["k"]).collect()
    with pytest.raises(ValueError, match="regular expression"):
        search.by_regex(part, ["v"], "(")
    assert search.selected(part.where("k = 1"), part, "k", 1, 2).collect() == [(1, "a")]
    assert labels.unlabelled(spark.createDataFrame([(None,), (1,)], "k int"), part.withColumn("k", F.nullif("k", F.lit(2))), "k").count() == 0
    assert headers.histogram(part, "k", 1.0).count() == 2
    with pytest.raises(ValueError, match="no values"):
        headers.histogram(part.where("k > 5"), "k", 1.0)


def test_upserts_keep_the_first_place(spark):
    old = spark.createDataFrame([(1, "a", 1, 0), (2, "b", None, 1)], "k int, v string, n int, at int")
    new = spark.createDataFrame([(2, "x", None, 2), (1, "c", 1, 3)], "k int, v string, n int, at int")
    assert sorted(map(tuple, labels.upsert(old, new, ["k"], "n", "at").collect())) == [(1, "c", 1, 0), (2, "x", None, 1)]


def test_fuzzy_matches_lose_nothing(spark):
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcd"), int(n))) for n in rng.integers(1, 14, 300)]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "key int, label string")

    def apart(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            before, row = row, [i + 1]
            for j, y in enumerate(b):
                row.append(min(before[j] + (x != y), before[j + 1] + 1, row[j] + 1))
        return row[-1]

    for cutoff in (75.0, 50.0):
        want = {(a, b) for a in set(words) for b in set(words) if round(100 * (1 - apart(a, b) / max(len(a), len(b))), 4) >= cutoff}
        got = {(r["name"], r["label"]) for r in search.fuzzy_matches(df, "label", df, "key", "label", cutoff, k=1000).collect()}
        assert got == want
    with pytest.raises(ValueError, match="above 0"):
        search.fuzzy_matches(df, "label", df, "key", "label", 0)
