"""Every registered query over the driver's tables, with the SQL that gives the same rows."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.functions.alignment import weighted_similarity
from millrace.operators import headers, labels, matching, models, pages, replacement, search, types
from millrace.sources import files, osm, stores

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Codes and names for ordered replacement; a null name is skipped.
CODES = [("ring", "loop"), ("loop", "hoop"), ("small", None), ("large", "big")]
#: Terms that stand for each other in part names.
TERMS = ("ring", "gear", "bolt")
#: Raw headers and their keys, worked out by hand.
HEADERS = {
    "lfd. Nr.": "lfd_nr", "Lfd.Nr.": "lfd_nr", "LFD NR": "lfd_nr", "Index": "lfd_nr", "lfd. Nr. 2": "_extra_lfd. nr. 2", "Maßnahme": "massnahme", "Maß­nahme": "massnahme", "Objekt/Maßnahme": "massnahme", "Maßnahmenart": "projektkategorie", "Maßnahme 2": "_extra_maßnahme 2",
    "kurze\nProjektbeschreibung": "kurze_projektbeschreibung", "Projektbeschreibung": "kurze_projektbeschreibung", "lange Projektbeschreibung": "_extra_lange projektbeschreibung", "Die Projektkategorie": "projektkategorie", "Betriebs-\nmittel": "betriebsmittel", "Zubau  Leitung": "leitungslaenge_km", "Länge des Kabels": "leitungslaenge_km",
    "Die Länge des Kabels": "_extra_die länge des kabels", "Leitungslänge [km]": "leitungslaenge_km", "Übertragungs-\nkapazität": "kapazitaetsaenderung_mva", "Kapazität": "kapazitaetsaenderung_mva", "netztechnische Begründung": "netzbegruendung_1", "Begründung, netztechnische": "netzbegruendung_1", "netztechnische Begründ ung (Grund)": "netzbegruendung_2",
    "2. netztechnische Begründung": "netzbegruendung_2", "Begründung netztechnische, Hauptgrund": "netzbegruendung_2", "Aus welchem Grund, Begründung netztechnische": "netzbegruendung_2", "Begründung": "_extra_begründung", "bestehend: Engpass": "engpass_bestehend_beheben", "Engpass bereits da": "engpass_bestehend_beheben", "Engpass": "engpass_prognose_vorbeugen",
    "benötigt bis": "optimaler_zeitpunkt", "ist benötigt bis": "_extra_ist benötigt bis", "optimaler Zeitpunkt der Inbetriebnahme": "optimaler_zeitpunkt", "Inbtrieb": "inbetriebnahme", "voraussichtliches Bauende": "inbetriebnahme", "Baubeginn": "baubeginn", "Beschreibung Verzögerungsgrund": "verzoegerungsgrund_beschreibung", "Verzögerungsgrund": "verzoegerungsgrund",
    "Kosten": "kosten", "Projektstatus": "projektstatus", "Genehmigung": "genehmigungsverfahren", "Alternativen": "alternativen", "vorrangig Netz": "netzebene", "Umspannebene": "netzebene", "Teilnetzgebiet": "teilnetzgebiet", "UW": "netzknoten_hoes", "UW Nord": "_extra_uw nord", "HöS-Netz": "netzknoten_hoes", "unbekannt": "_extra_unbekannt", "": "", " ": " ",
}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"), spark)
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _values(rows: list[str]) -> str:
    return ", ".join("('" + r.replace("'", "''") + "')" for r in rows)


_SQL_SIMILAR = "round(100 * (1 - levenshtein(lower({a}), lower({b})) / greatest(length({a}), length({b}), 1)), 4)"


@query("""
    SELECT query_id, vec_id, score, CAST(r AS INTEGER) AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM (
            SELECT q.vec_id AS query_id, c.vec_id, round(list_inner_product(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])), 6) AS score
            FROM embeddings q JOIN embeddings c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)) WHERE r <= 5""")
def vector_topk(t: Callable, spark: SparkSession) -> DataFrame:
    e = t("embeddings")
    return search.vector_matches(e.where(F.col("vec_id") % 20 == 0), e, "vec_id", "embedding")


@query(r"""
    SELECT doc_id, source FROM documents
    WHERE regexp_matches(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'), 'gnu general|apache license|été', 'i')
       OR regexp_matches(coalesce(source, ''), 'gnu general|apache license|été', 'i')""")
def regex_search(t: Callable, spark: SparkSession) -> DataFrame:
    return search.by_regex(t("documents"), ["text", "source", "no_such_column"], "gnu general|apache license|été").select("doc_id", "source")


@query(f"""
    SELECT p_partkey, score FROM (
        SELECT p_partkey, {_SQL_SIMILAR.format(a="'small ring | Brand#2'", b="x")} AS score
        FROM (SELECT p_partkey, concat(coalesce(p_name, ''), ' | ', coalesce(p_brand, '')) AS x FROM part)) WHERE score >= 70""")
def fuzzy_filter(t: Callable, spark: SparkSession) -> DataFrame:
    return search.by_similarity(t("part"), ["p_name", "p_brand"], "small ring | Brand#2").select("p_partkey", F.col("_search_score").alias("score"))


@query(f"""
    WITH l AS (SELECT p_name AS label, min(p_partkey) AS key FROM part WHERE p_name IS NOT NULL GROUP BY 1),
    s AS (SELECT n.label AS name, l.key, l.label, {_SQL_SIMILAR.format(a="n.label", b="l.label")} AS score FROM l n CROSS JOIN l),
    r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY score DESC, key) AS i FROM s WHERE score >= 75)
    SELECT name, key, label, score, CAST(i AS INTEGER) AS rank FROM r WHERE i <= 10""")
def fuzzy_join_topk(t: Callable, spark: SparkSession) -> DataFrame:
    return search.fuzzy_matches(t("part"), "p_name", t("part"), "p_partkey", "p_name")


@query("SELECT doc_id, lang, n_chars FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def hide_labelled(t: Callable, spark: SparkSession) -> DataFrame:
    return labels.unlabelled(t("documents").select("doc_id", "lang", "n_chars"), t("labels"), "doc_id")


@query("SELECT doc_id, lang, n_chars FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def labelled_only(t: Callable, spark: SparkSession) -> DataFrame:
    return labels.labelled(t("documents").select("doc_id", "lang", "n_chars"), t("labels"), "doc_id")


@query("""
    SELECT p.l_orderkey, p.l_linenumber AS positive, n.l_linenumber AS negative
    FROM lineitem p JOIN lineitem n USING (l_orderkey) WHERE p.l_returnflag = 'R' AND n.l_returnflag = 'N'""")
def triplets(t: Callable, spark: SparkSession) -> DataFrame:
    return labels.triplets(t("lineitem"), "l_orderkey", "l_linenumber", "l_returnflag", "R", "N")


@query("""
    SELECT event_id, user_id, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS r FROM events) WHERE r = 1""")
def label_upsert(t: Callable, spark: SparkSession) -> DataFrame:
    e = t("events").select("event_id", "user_id", "event_type", "value")
    old, new = e.where(F.col("event_type") != "click"), e.where(F.col("event_type") == "click")
    return labels.upsert(old, new, ["user_id", "event_type"], "event_id")


@query("""
    SELECT md5(text) AS text_md5, count(*) AS rows, count(DISTINCT concat(coalesce(lang, '<null>'), '|', coalesce(source, '<null>'))) = 1 AS consistent
    FROM documents GROUP BY md5(text)""")
def label_consistency(t: Callable, spark: SparkSession) -> DataFrame:
    return labels.consistent(t("documents").withColumn("text_md5", F.md5("text")), "text_md5", ["lang", "source"])


@query("""
    SELECT l_orderkey, coalesce(string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) FILTER (l_returnflag = 'R'), '') AS yes,
           coalesce(string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) FILTER (l_returnflag <> 'R'), '') AS no
    FROM lineitem GROUP BY l_orderkey""")
def conditional_collect(t: Callable, spark: SparkSession) -> DataFrame:
    side = lambda c: F.array_join(F.array_sort(F.collect_list(F.when(c, F.col("l_linenumber")))), ",")
    return t("lineitem").groupBy("l_orderkey").agg(side(F.col("l_returnflag") == "R").alias("yes"), side(F.col("l_returnflag") != "R").alias("no"))


@query("SELECT md5(text) AS text_md5, min(doc_id) AS doc_id FROM documents GROUP BY text")
def row_distinct_first(t: Callable, spark: SparkSession) -> DataFrame:
    return headers.distinct_rows(t("documents"), ["text"], "doc_id").select(F.md5("text").alias("text_md5"), "doc_id")


@query("SELECT DISTINCT replace(trim(p_type), chr(10), '') AS v FROM part UNION SELECT DISTINCT replace(trim(lang), chr(10), '') FROM documents")
def distinct_values_sorted(t: Callable, spark: SparkSession) -> DataFrame:
    clean = lambda c: F.replace(F.trim(c), F.lit("\n"), F.lit("")).alias("v")
    return t("part").select(clean("p_type")).union(t("documents").select(clean("lang"))).distinct().orderBy("v")


@query("""
    SELECT DISTINCT p_partkey, CAST(unnest(list_concat(range(p_size, p_size + p_partkey % 3 + 1), [p_partkey % 40 + 1])) AS INTEGER) AS page FROM part""")
def page_ranges(t: Callable, spark: SparkSession) -> DataFrame:
    """Every part's pages, written as "size - size + 0..2, number"."""
    raw = F.concat_ws("", "p_size", F.lit(" - "), F.col("p_size") + F.col("p_partkey") % 3, F.lit(","), F.col("p_partkey") % 40 + 1)
    return t("part").select("p_partkey", F.explode(T.page_numbers(T.page_ranges(raw, F.lit(60)))).alias("page"))


@query("""
    SELECT bin, CAST(m + bin * 500 AS DOUBLE) AS low, count(*) AS n FROM (
        SELECT CAST(floor((n_chars - m) / 500) AS BIGINT) AS bin, m FROM documents, (SELECT min(n_chars) AS m FROM documents) WHERE n_chars IS NOT NULL) GROUP BY bin, m""")
def x_histogram(t: Callable, spark: SparkSession) -> DataFrame:
    return headers.histogram(t("documents"), "n_chars", 500.0)


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS tag_k FROM events")
def json_expand(t: Callable, spark: SparkSession) -> DataFrame:
    return t("events").select("event_id", F.try_element_at(F.from_json("props", "map<string,string>"), F.lit("k")).cast("bigint").alias("tag_k"))


@query("SELECT s_suppkey, concat('passage: ', concat_ws('; ', 's_name: ' || s_name, 's_nationkey: ' || s_nationkey)) AS passage FROM supplier")
def serialize_rows(t: Callable, spark: SparkSession) -> DataFrame:
    return t("supplier").select("s_suppkey", T.serialized_row(["s_name", "s_nationkey"], "passage: ").alias("passage"))


@query("""
    SELECT p_partkey, CASE WHEN regexp_matches(p_brand, '.*Brand.*[12].*')
        THEN replace(replace(replace(p_name, 'ring', 'ring (loop)'), 'loop', 'loop (hoop)'), 'large', 'large (big)') ELSE p_name END AS name FROM part""")
def ordered_replace(t: Callable, spark: SparkSession) -> DataFrame:
    entries = F.array(*[F.struct(F.lit(c).alias("code"), F.lit(n).cast("string").alias("name")) for c, n in CODES])
    name = F.when(F.col("p_brand").rlike(".*Brand.*[12].*"), T.replace_in_order(F.col("p_name"), entries)).otherwise(F.col("p_name"))
    return t("part").select("p_partkey", name.alias("name"))


@query(f"SELECT p_partkey, regexp_replace(p_name, '{'|'.join(TERMS)}', w, 'g') AS variant FROM part, (VALUES {_values(list(TERMS))}) v(w)")
def synonym_variants(t: Callable, spark: SparkSession) -> DataFrame:
    return t("part").select("p_partkey", F.explode(T.variants(F.col("p_name"), TERMS)).alias("variant"))


@query("SELECT n_nationkey, h, key FROM nation, (VALUES " + ", ".join(f"('{h}', '{k}')" for h, k in HEADERS.items()) + ") v(h, key)")
def classify_headers(t: Callable, spark: SparkSession) -> DataFrame:
    """Every header in every nation's spelling: blanks, line ends and soft hyphens around and inside, upper case."""
    each = t("nation").select("n_nationkey", F.explode(F.array(*[F.lit(h) for h in HEADERS])).alias("h"))
    n = F.col("n_nationkey").cast("int")
    spelled = F.concat(F.repeat(F.lit(" "), n % 4), F.replace("h", F.lit(" "), F.repeat(F.lit("\n"), n % 3 + 1)), F.repeat(F.lit("\u00ad"), n % 2), F.repeat(F.lit("\t"), n % 5))
    upper = F.replace(F.upper(F.replace(spelled, F.lit("ß"), F.lit("\u0001"))), F.lit("\u0001"), F.lit("ß"))
    spelled = F.when(F.trim("h") == "", F.col("h")).when(n % 2 == 1, upper).otherwise(spelled)
    return each.select("n_nationkey", "h", T.header_key(spelled).alias("key"))


def _grid(t: Callable) -> DataFrame:
    """The parts of each brand as a table: a title and a header, for every other brand a header of two rows."""
    number = F.regexp_extract("p_brand", "[0-9]+", 0).cast("int")
    odd = number % 2 == 1
    file = F.concat(F.lit("00"), number.cast("string"), F.lit("_Netz "), F.col("p_brand"), F.lit("/t.csv"))
    brands = t("part").select(file.alias("source_file"), odd.alias("odd")).distinct()
    head = F.when(F.col("odd"), F.array(F.array(F.lit("Netzausbauplan"), F.lit(""), F.lit("")), F.array(F.lit("lfd. Nr."), F.lit("Maßnahme"), F.lit("Kosten")), F.array(F.lit("Index"), F.lit("Projektstatus"), F.lit("geschätzte Kosten"))))
    head = F.coalesce(head, F.array(F.array(F.lit("Kosten"), F.lit("Index"), F.lit("Foo  Bar"))))
    heads = brands.select("source_file", F.posexplode(head).alias("row_no", "cells"))
    text = lambda c: F.col(c).cast("string")
    cells = F.when(odd, F.array(text("p_partkey"), text("p_name"), text("p_size"))).otherwise(F.array(text("p_size"), text("p_partkey"), F.when(F.col("p_partkey") % 3 == 0, "NA").otherwise(text("p_name"))))
    return heads.union(t("part").select(file, (F.col("p_partkey") + 4).cast("int"), cells))


_SQL_FILE = "'00' || regexp_extract(p_brand, '[0-9]+') || '_Netz ' || p_brand || '/t.csv'"
_SQL_ODD = "CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) % 2 = 1"


@query(f"""
    SELECT DISTINCT {_SQL_FILE} AS source_file, col_no, CASE WHEN {_SQL_ODD} THEN ['lfd. Nr. Index', 'Maßnahme Projektstatus', 'Kosten geschätzte Kosten'][col_no + 1] ELSE ['Kosten', 'Index', 'Foo  Bar'][col_no + 1] END AS name,
        CASE WHEN {_SQL_ODD} THEN ['_extra_lfd. nr. index', 'projektstatus', 'kosten'][col_no + 1] ELSE ['kosten', 'lfd_nr', '_extra_foo bar'][col_no + 1] END AS key FROM part, (VALUES (0), (1), (2)) c(col_no)""")
def header_detect(t: Callable, spark: SparkSession) -> DataFrame:
    grid = _grid(t)
    return headers.merged_headers(grid, headers.header_rows(grid))


@query(f"""
    SELECT {_SQL_FILE} AS source_file, '00' || regexp_extract(p_brand, '[0-9]+') AS operator_id, 'Netz ' || p_brand AS operator_name, CAST(p_partkey + 4 AS INTEGER) AS row_no, CASE WHEN NOT {_SQL_ODD} THEN CAST(p_partkey AS VARCHAR) END AS lfd_nr,
        CASE WHEN {_SQL_ODD} THEN p_name END AS projektstatus, CAST(p_size AS VARCHAR) AS kosten,
        CASE WHEN {_SQL_ODD} THEN '{{"_extra_lfd. nr. index":"' || p_partkey || '"}}' WHEN p_partkey % 3 = 0 THEN '{{}}' ELSE '{{"_extra_foo bar":"' || p_name || '"}}' END AS extra FROM part""")
def harmonise_grid(t: Callable, spark: SparkSession) -> DataFrame:
    return headers.harmonise(_grid(t)).select("source_file", "operator_id", "operator_name", "row_no", "lfd_nr", "projektstatus", "kosten", F.to_json("extra").alias("extra"))


@query("SELECT o_orderkey AS k, coalesce(CASE WHEN o_custkey % 2 = 0 THEN o_custkey END, c_custkey, -1) AS v FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def coalesce_dups(t: Callable, spark: SparkSession) -> DataFrame:
    o = t("orders").join(t("customer").select("c_custkey"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return headers.coalesce_same_named(o.select("o_orderkey", F.when(F.col("o_custkey") % 2 == 0, F.col("o_custkey")), "c_custkey", F.lit(-1).cast("long")), ["k", "v", "v", "v"])


@query("""
    SELECT c_custkey AS key, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment, NULL AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_nationkey, NULL, s_acctbal FROM supplier""")
def union_by_name(t: Callable, spark: SparkSession) -> DataFrame:
    c = t("customer").selectExpr("c_custkey AS key", "c_name AS name", "c_nationkey AS nation", "c_mktsegment AS segment")
    s = t("supplier").selectExpr("s_suppkey AS key", "s_name AS name", "s_nationkey AS nation", "s_acctbal AS balance")
    return c.unionByName(s, allowMissingColumns=True)


@query("""
    SELECT s_suppkey, split_part(f, '_', 1) AS operator_id, regexp_replace(f, '^[^_]*_', '') AS operator_name FROM (
        SELECT s_suppkey, CASE WHEN length(s_suppkey::VARCHAR) < 5 THEN lpad(s_suppkey::VARCHAR, 5, '0') ELSE s_suppkey::VARCHAR END || '_' || replace(s_name, '/', '_') AS f FROM supplier)""")
def operator_parse(t: Callable, spark: SparkSession) -> DataFrame:
    number, name = T.folder_parts(T.folder_name(F.col("s_suppkey"), F.col("s_name")))
    return t("supplier").select("s_suppkey", number.alias("operator_id"), name.alias("operator_name"))


_SQL_DRAW = "CAST(('0x' || left(md5('{seed}|' || CAST({key} AS VARCHAR)), 8)) AS BIGINT)"


@query("""
    SELECT p_partkey, CAST(list_sum(list_transform([
        'p_partkey' || chr(31) || p_partkey, 'p_name' || chr(31) || p_name, 'p_brand' || chr(31) || p_brand, 'p_type' || chr(31) || p_type, 'p_size' || chr(31) || p_size, 'p_retailprice' || chr(31) || p_retailprice],
        lambda x: CAST(CAST('0x' || left(md5(x), 16) AS UBIGINT) AS HUGEINT))) % 18446744073709551616 AS DECIMAL(20, 0)) AS row_hash FROM part""")
def row_identity(t: Callable, spark: SparkSession) -> DataFrame:
    p = t("part")
    return p.select("p_partkey", T.row_identity(p.columns).alias("row_hash"))


@query(f"""
    SELECT source, doc_id, lang FROM (
        SELECT *, row_number() OVER (PARTITION BY source ORDER BY {_SQL_DRAW.format(seed=7, key='doc_id')}, doc_id) AS r FROM documents) WHERE r = 1""")
def file_row_sample(t: Callable, spark: SparkSession) -> DataFrame:
    return labels.sample_by_file(t("documents").select("source", "doc_id", "lang"), "source", "doc_id", 7)


@query(f"SELECT *, CASE WHEN {_SQL_DRAW.format(seed=42, key='doc_id')} % 10000 < 2000 THEN 'test' ELSE 'train' END AS part FROM labels")
def split_train_test(t: Callable, spark: SparkSession) -> DataFrame:
    return labels.split(t("labels"), "doc_id")


@query("SELECT source, count(*) AS pending FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.quality IS NULL GROUP BY source")
def pending_rows(t: Callable, spark: SparkSession) -> DataFrame:
    open_ = t("documents").select("doc_id", "source").join(t("labels"), "doc_id", "left").where(F.col("quality").isNull())
    return open_.groupBy("source").agg(F.count(F.lit(1)).alias("pending"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey = 7")
def point_lookup(t: Callable, spark: SparkSession) -> DataFrame:
    return search.exactly_one(t("orders").select("o_orderkey", "o_custkey", "o_orderstatus"), F.col("o_orderkey") == 7)


@query("""
    SELECT doc_id, CASE toxic WHEN 1 THEN 'yes' WHEN 0 THEN 'no' ELSE 'unset' END AS toxic, coalesce(CAST(quality AS VARCHAR), '') AS quality
    FROM documents LEFT JOIN labels USING (doc_id)""")
def nullable_flags(t: Callable, spark: SparkSession) -> DataFrame:
    d = t("documents").select("doc_id").join(t("labels"), "doc_id", "left")
    return d.select("doc_id", T.flag_word(F.col("toxic") == 1).alias("toxic"), T.id_text(F.col("quality")).alias("quality"))


@query("""
    SELECT count(*) AS rows, count(l.doc_id) AS labelled, count(DISTINCT source) AS files FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def counts_report(t: Callable, spark: SparkSession) -> DataFrame:
    d = t("documents").select("doc_id", "source").join(t("labels").select("doc_id", F.lit(1).alias("_l")), "doc_id", "left")
    return d.agg(F.count(F.lit(1)).alias("rows"), F.count("_l").alias("labelled"), F.countDistinct("source").alias("files"))


@query("SELECT conv_id, CAST(floor(turn / 10) AS BIGINT) AS chunk, count(*) AS n FROM conversations GROUP BY 1, 2")
def chunk_rows(t: Callable, spark: SparkSession) -> DataFrame:
    return labels.chunked(t("conversations"), "turn").groupBy("conv_id", "chunk").agg(F.count(F.lit(1)).alias("n"))


@query(r"""
    SELECT doc_id, nullif(len(c), 0) AS clues, md5(c[1]) AS first_md5 FROM (
        SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS c FROM documents)""")
def clue_lists(t: Callable, spark: SparkSession) -> DataFrame:
    d = t("documents").select("doc_id", T.clue_list(F.col("text")).alias("c"))
    return d.select("doc_id", F.when(F.col("c").isNotNull(), F.size("c").cast("long")).alias("clues"), F.md5(F.get("c", F.lit(0))).alias("first_md5"))


@query("""
    SELECT a.k AS row_key, a.c AS asked, l.l_linenumber AS labelled_candidate, l.l_returnflag AS label
    FROM (SELECT o_orderkey AS k, CASE WHEN o_custkey % 2 = 0 THEN 1 END AS c FROM orders) a
    LEFT JOIN lineitem l ON l.l_orderkey = a.k AND (a.c IS NULL OR l.l_linenumber = a.c)""")
def existing_labels(t: Callable, spark: SparkSession) -> DataFrame:
    asked = t("orders").select(F.col("o_orderkey").alias("row_key"), F.when(F.col("o_custkey") % 2 == 0, F.lit(1)).alias("asked"))
    known = t("lineitem").select(F.col("l_orderkey").alias("row_key"), F.col("l_linenumber").alias("asked"), F.col("l_returnflag").alias("label"))
    return labels.existing_labels(asked, known, "row_key", "asked", "label")


@query("""
    SELECT o_orderkey, f.l_linenumber, f.l_partkey FROM orders LEFT JOIN (
        SELECT l_orderkey, l_linenumber, l_partkey FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey) AS r FROM lineitem) WHERE r = 1) f ON f.l_orderkey = o_orderkey""")
def first_label(t: Callable, spark: SparkSession) -> DataFrame:
    lines = t("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", F.struct("l_shipdate", "l_linenumber", "l_partkey").alias("place"))
    return labels.first_label(t("orders").select("o_orderkey"), lines, "o_orderkey", "place").drop("place")


@query("""
    SELECT v.query_id, v.vec_id, CAST(v.r AS INTEGER) AS rank, e.label FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM (
            SELECT q.vec_id AS query_id, c.vec_id, round(list_inner_product(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])), 6) AS score
            FROM embeddings q JOIN embeddings c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)) v JOIN embeddings e ON e.vec_id = v.vec_id WHERE r <= 3""")
def match_lookup(t: Callable, spark: SparkSession) -> DataFrame:
    e = t("embeddings")
    found = search.vector_matches(e.where(F.col("vec_id") % 20 == 0), e, "vec_id", "embedding", k=3)
    return search.looked_up(found.select("query_id", "vec_id", "rank"), e.select("vec_id", "label"), "vec_id")


@query("""
    WITH r AS (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey, l_linenumber) AS rank FROM lineitem)
    SELECT o_orderkey AS l_orderkey, CAST(s AS INTEGER) AS rank, l_partkey FROM (SELECT o_orderkey, o_custkey % 5 + 1 AS s FROM orders) LEFT JOIN r ON l_orderkey = o_orderkey AND rank = s""")
def next_candidate(t: Callable, spark: SparkSession) -> DataFrame:
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(F.desc("l_extendedprice"), "l_partkey", "l_linenumber"))
    ranked = t("lineitem").select("l_orderkey", "l_partkey", rank.alias("rank"))
    seen = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % 5).cast("int").alias("rank"))
    return labels.next_candidate(ranked, seen, "l_orderkey")


@query("SELECT n_nationkey, n_name FROM nation")
def assert_unique(t: Callable, spark: SparkSession) -> DataFrame:
    return labels.at_most_one(t("nation").select("n_nationkey", "n_name"), ["n_nationkey"])


@query(f"""
    WITH o AS (SELECT source, doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)),
    f AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY {_SQL_DRAW.format(seed=3, key='doc_id')}, doc_id) AS r FROM o)
    SELECT source, doc_id FROM f WHERE r = 1 ORDER BY {_SQL_DRAW.format(seed=4, key='source')}, source LIMIT 1""")
def random_unlabelled(t: Callable, spark: SparkSession) -> DataFrame:
    return labels.random_row(t("documents").select("source", "doc_id"), "source", "doc_id", 3, t("labels"))


@query(f"""
    WITH d AS (SELECT range AS draw, {_SQL_DRAW.format(seed=5, key='range')} % (SELECT count(*) FROM nation) AS pos FROM range(15)),
    n AS (SELECT n_nationkey, n_name, row_number() OVER (ORDER BY n_nationkey) - 1 AS pos FROM nation)
    SELECT draw, n_nationkey, n_name FROM d JOIN n USING (pos)""")
def sample_replacement(t: Callable, spark: SparkSession) -> DataFrame:
    return labels.resampled(t("nation").select("n_nationkey", "n_name"), "n_nationkey", 15, 5)


@query("""SELECT event_id, json_extract_string(props, '$.k') AS "tag::k", json_extract_string(props, '$.none') AS "tag::none" FROM events""")
def tag_columns(t: Callable, spark: SparkSession) -> DataFrame:
    return osm.expanded(t("events").select("event_id", F.from_json("props", "map<string,string>").alias("tags")), ("k", "none"))


@query("SELECT event_id, 'tag::k' AS tag, json_extract_string(props, '$.k') AS value FROM events")
def tag_prefix(t: Callable, spark: SparkSession) -> DataFrame:
    return t("events").select("event_id", F.explode(T.prefixed(F.from_json("props", "map<string,string>"))).alias("tag", "value"))


@query("SELECT DISTINCT replace(trim(p_type), chr(10), '') AS value FROM part ORDER BY 1")
def values_under_header(t: Callable, spark: SparkSession) -> DataFrame:
    body = F.to_json(F.concat(F.array(F.array(F.lit("Nr."), F.lit("Art des Betriebsmittels"))), F.collect_list(F.array(F.col("p_partkey").cast("string"), F.concat(F.lit(" "), F.col("p_type"))))))
    tables = t("part").groupBy(F.col("p_brand").alias("source_file")).agg(body.alias("value"))
    return headers.values_under(files.json_tables(tables), ".*betrieb.*")


@query("SELECT p_partkey, replace(replace(p_name, 'ring', 'ring (loop)'), 'large', 'large (big)') AS name FROM part")
def lookup_replace(t: Callable, spark: SparkSession) -> DataFrame:
    text = json.dumps({"entries": {"ring": {"canonical_name": "loop"}, "small": {"canonical_name": None}, "large": {"canonical_name": "big"}}})
    return t("part").select("p_partkey", T.replace_in_order(F.col("p_name"), files.lookup_entries(F.lit(text))).alias("name"))


@query(r"""
    SELECT page_id, host, CASE WHEN r = 0 THEN 'page.html' ELSE 'page_' || r || '.html' END AS file FROM (
        SELECT page_id, regexp_extract(url, '//([^/]+)/', 1) AS host, row_number() OVER (PARTITION BY regexp_extract(url, '//([^/]+)/', 1) ORDER BY page_id) - 1 AS r FROM pages)""")
def doc_suffix(t: Callable, spark: SparkSession) -> DataFrame:
    rows = t("pages").select("page_id", F.regexp_extract("url", "//([^/]+)/", 1).alias("host"), F.lit("page.html").alias("name"))
    return files.document_names(rows, "host", "name", "page_id").select("page_id", "host", "file")


@query("""SELECT s_suppkey, CAST(to_json(struct_pack(s_name := s_name, s_nationkey := s_nationkey, s_suppkey := s_suppkey)) AS VARCHAR) AS prompt FROM supplier""")
def row_prompt(t: Callable, spark: SparkSession) -> DataFrame:
    return t("supplier").select("s_suppkey", T.row_json(["s_suppkey", "s_name", "s_nationkey"]).alias("prompt"))


@query("""
    SELECT n_regionkey, string_agg('{"n_name":"' || n_name || '"} -> ' || n_nationkey, chr(10) || chr(10) || chr(10) ORDER BY n_nationkey) AS examples FROM nation GROUP BY 1""")
def few_shot(t: Callable, spark: SparkSession) -> DataFrame:
    rows = t("nation").select("n_regionkey", F.struct("n_nationkey", T.row_json(["n_name"]).alias("row")).alias("r"))
    held = rows.groupBy("n_regionkey").agg(F.array_sort(F.collect_list("r")).alias("r"))
    return held.select("n_regionkey", T.few_shot(F.col("r.row"), F.transform("r", lambda x: x["n_nationkey"].cast("string"))).alias("examples"))


_SQL_KIND = "CASE p_type WHEN 'SMALL' THEN 'substation' WHEN 'PROMO' THEN 'power_line' WHEN 'LARGE' THEN 'generator' ELSE 'no such type' END"


def _recorded_clues(t: Callable) -> tuple[DataFrame, models.RecordedTable]:
    """Suppliers with their request, and the answers on record: the names of the part of the same number, and its kind;
    those of each fifth size are no JSON."""
    rows = t("supplier").select("s_suppkey", "s_name", "s_nationkey")
    rows = rows.withColumn("request", models.messages("Find places.", "no examples", T.row_json(rows.columns), "model"))
    answer = F.to_json(F.struct(F.array("p_name", "p_brand").alias("location_clues"), F.expr(_SQL_KIND).alias("asset_type")))
    answers = rows.join(t("part"), F.col("p_partkey") == F.col("s_suppkey")).select("request", F.when(F.col("p_size") % 5 == 0, "none found").otherwise(answer).alias("answer"))
    return rows, models.RecordedTable(answers)


_SQL_CLUES = f"""
    SELECT s_suppkey, CASE WHEN p_size % 5 <> 0 THEN p_name || '|' || p_brand END AS clue, CASE WHEN p_size % 5 <> 0 THEN nullif({_SQL_KIND}, 'no such type') END AS asset_type
    FROM supplier LEFT JOIN part ON p_partkey = s_suppkey"""


@query(_SQL_CLUES)
def clue_extraction(t: Callable, spark: SparkSession) -> DataFrame:
    rows, client = _recorded_clues(t)
    out = models.extract_clues(rows, client, F.col("request"))
    return out.select("s_suppkey", F.array_join("`inferred:location_clues`", "|").alias("clue"), F.col("`inferred:asset_type`").alias("asset_type"))


@query(_SQL_CLUES)
def clues_asked_once(t: Callable, spark: SparkSession) -> DataFrame:
    """The same by a store of answers: a first run over some nations' suppliers, a second one over all."""
    rows, client = _recorded_clues(t)
    store = stores.AnswerStore(spark, files.scratch(spark))
    store.answered(rows.where("s_nationkey < 12"), F.col("request"), client)
    out = store.answered(rows, F.col("request"), client).withColumn("c", models.clues(F.col("answer")))
    return out.select("s_suppkey", F.array_join("c.location_clues", "|").alias("clue"), F.col("c.asset_type").alias("asset_type"))


@query("SELECT conv_id, turn, left(md5(text), 8) AS answer FROM conversations")
def chunk_extraction(t: Callable, spark: SparkSession) -> DataFrame:
    """Ten turns a request, told by number and role only; the answers on record are the digests of their texts."""
    rows = t("conversations").select("conv_id", "turn", "role")
    own = F.struct("turn", F.to_json(F.struct("conv_id", "turn", "role")).alias("json"), F.left(F.md5("text"), F.lit(8)).alias("answer"))
    held = t("conversations").groupBy("conv_id", F.floor(F.col("turn") / 10)).agg(F.array_sort(F.collect_list(own)).alias("r"))
    answers = held.select(F.concat(F.lit("One answer a row.\n"), F.array_join("r.json", "\n")).alias("request"), F.to_json("r.answer").alias("answer"))
    return models.by_chunk(rows, models.RecordedTable(answers), "conv_id", "turn", ["conv_id", "turn", "role"], "One answer a row.").select("conv_id", "turn", "answer")


@query("""
    WITH v AS (SELECT p_name, min(p_partkey) AS k FROM part GROUP BY 1)
    SELECT p_partkey, round(CAST(embedding[1] AS DOUBLE) / sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 6) AS x FROM part JOIN v USING (p_name) LEFT JOIN embeddings ON vec_id = k""")
def embed_texts(t: Callable, spark: SparkSession) -> DataFrame:
    """Part names, whose vectors on record are those of the table of vectors, by the smallest part of the name."""
    first = t("part").groupBy(F.col("p_name").alias("request")).agg(F.min("p_partkey").alias("vec_id"))
    answers = first.join(t("embeddings"), "vec_id").select("request", F.to_json(F.col("embedding").cast("array<double>")).alias("answer"))
    out = models.embedded(t("part").select("p_partkey", "p_name"), F.col("p_name"), models.RecordedTable(answers))
    return out.select("p_partkey", F.round(F.get("embedding", F.lit(0)), 6).alias("x"))


@query(f"""
    WITH l AS (SELECT p_name AS label, min(p_partkey) AS key FROM part GROUP BY 1), c AS (SELECT s_suppkey, replace(p_name, 'ing', 'in') AS clue FROM supplier JOIN part ON p_partkey = s_suppkey WHERE s_nationkey % 2 = 1),
    m AS (SELECT s_suppkey, key, row_number() OVER (PARTITION BY s_suppkey ORDER BY {_SQL_SIMILAR.format(a="clue", b="label")} DESC, key) AS r FROM c, l WHERE {_SQL_SIMILAR.format(a="clue", b="label")} >= 75)
    SELECT s.s_suppkey, m.key AS osm_id FROM supplier s LEFT JOIN m ON m.s_suppkey = s.s_suppkey AND m.r = 1""")
def geocode_clues(t: Callable, spark: SparkSession) -> DataFrame:
    clues = F.array(F.replace(F.col("p_name"), F.lit("ing"), F.lit("in")), F.lit("other"))
    rows = t("supplier").join(t("part"), F.col("p_partkey") == F.col("s_suppkey")).select("s_suppkey", F.when(F.col("s_nationkey") % 2 == 1, "substation").alias("kind"), clues.alias("clues"))
    first = rows.where(F.col("kind") == "substation").select("s_suppkey", F.get("clues", F.lit(0)).alias("name"))
    best = search.fuzzy_matches(first, "name", t("part"), "p_partkey", "p_name", k=1)
    found = first.join(best, "name").select("s_suppkey", F.col("key").alias("osm_id"))
    return t("supplier").select("s_suppkey").join(found, "s_suppkey", "left")


@query("""
    SELECT s_suppkey AS operator_id, s_name AS operator_name, 'd' || p_partkey AS document_id, p_name || '/plan.pdf' AS document_name
    FROM supplier JOIN part ON p_partkey % 100 = s_suppkey WHERE s_suppkey % 4 <> 0 AND s_suppkey < 10000 AND s_suppkey <> 770""")
def registry_documents(t: Callable, spark: SparkSession) -> DataFrame:
    """A registry on record: suppliers as operators, the parts of their number as documents; each fourth has none."""
    docs = t("part").groupBy((F.col("p_partkey") % 100).alias("s_suppkey")).agg(F.collect_list(F.struct(F.concat(F.lit("d"), F.col("p_partkey")).alias("_id"), F.concat("p_name", F.lit("/plan.pdf")).alias("name"))).alias("documents"))
    own = F.when(F.col("s_suppkey") % 4 == 0, F.lit(None)).otherwise(F.col("documents"))
    answer = F.to_json(F.struct(F.col("s_name").alias("name"), own.alias("documents")))
    answers = t("supplier").join(docs, "s_suppkey", "left").select(F.col("s_suppkey").cast("string").alias("request"), answer.alias("answer"))
    return models.scan_registry(spark, models.RecordedTable(answers))


_SQL_STATION = "replace(replace(p_name, 'ring', 'UW'), 'gear', 'Umspannwerk')"


@query(f"""
    WITH names AS (SELECT DISTINCT {_SQL_STATION} AS name FROM part),
    each AS (SELECT DISTINCT name, regexp_replace(name, 'UW|Umspannwerk|UA|Station|substation', w, 'g') AS variant FROM names, (VALUES ('UW'), ('Umspannwerk'), ('UA'), ('Station'), ('substation')) v(w)),
    found AS (SELECT *, row_number() OVER (PARTITION BY name, variant ORDER BY n_nationkey) AS r FROM each, nation WHERE (n_nationkey + length(variant)) % 2 = 0)
    SELECT name, variant, n_name AS place FROM found WHERE r <= 10""")
def place_search(t: Callable, spark: SparkSession) -> DataFrame:
    """Names with each of the terms for a substation, sought in a search on record: every other nation, by the length."""
    names = t("part").select(F.replace(F.replace("p_name", F.lit("ring"), F.lit("UW")), F.lit("gear"), F.lit("Umspannwerk")).alias("name")).distinct()
    terms = F.array(*[F.lit(w) for w in ("UW", "Umspannwerk", "UA", "Station", "substation")])
    asked = names.select(F.explode(F.transform(terms, lambda w: F.regexp_replace("name", F.lit("UW|Umspannwerk|UA|Station|substation"), w))).alias("q")).distinct()
    places = asked.join(t("nation"), F.col("n_nationkey") % 2 == F.length("q") % 2).groupBy("q").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("p"))
    request = F.concat(F.lit('{"q":"'), F.col("q"), F.lit('","countrycodes":"de","limit":10,"format":"json"}'))
    answer = F.to_json(F.transform("p", lambda x: F.create_map(F.lit("name"), x["n_name"])))
    out = models.places(names, "name", models.RecordedTable(places.select(request.alias("request"), answer.alias("answer"))))
    return out.select("name", "variant", F.col("place")["name"].alias("place"))


@query("SELECT p_partkey, p_name, p_size FROM part WHERE p_size BETWEEN 10 AND 20 AND regexp_matches(p_name, '^(small|red)') ORDER BY p_size")
def words_range(t: Callable, spark: SparkSession) -> DataFrame:
    words = t("part").select("p_partkey", "p_name", "p_size")
    return pages.words_like(pages.words_between(words, 10, 20, "p_size", ("p_partkey",)), "^(small|red)", "p_name")


@query("SELECT conv_id, turn, role FROM conversations WHERE turn BETWEEN 1 AND 2")
def page_slice(t: Callable, spark: SparkSession) -> DataFrame:
    return pages.page_slice(t("conversations"), 1, 2, "turn").select("conv_id", "turn", "role")


@query("""
    SELECT conv_id, CAST(n AS INTEGER) AS range_no, role, min(turn) AS turn FROM conversations, (VALUES (0, 1, 3), (1, 2, 9)) r(n, a, b) WHERE turn BETWEEN a AND b GROUP BY 1, 2, 3""")
def range_rows(t: Callable, spark: SparkSession) -> DataFrame:
    rows = t("conversations").select("conv_id", "turn", F.lit(0).alias("row_no"), F.array("role", F.lit("")).alias("cells"))
    out = pages.range_rows(rows, T.page_ranges(F.lit("1-3, 2-9"), F.lit(9)), "conv_id", "turn")
    return out.select("conv_id", "range_no", F.get("cells", F.lit(0)).alias("role"), "place.turn")


@query("""
    SELECT event_id, CASE WHEN event_id % 4 = 0 THEN json_extract_string(props, '$.k') END AS k, CAST(trunc(value * 10) AS INTEGER) AS x,
        CASE event_id % 4 WHEN 1 THEN 'not a JSON object' WHEN 2 THEN 'no settings' WHEN 3 THEN 'not a JSON object' END AS problem FROM events""")
def settings_parse(t: Callable, spark: SparkSession) -> DataFrame:
    """Settings of each event, of which a quarter are cut off, blank, or a list."""
    whole, kind = F.replace("props", F.lit('"k"'), F.lit('"text_k"')), F.col("event_id") % 4
    text = F.when(kind == 0, whole).when(kind == 1, F.left(whole, F.length(whole) - 1)).when(kind == 2, " ").otherwise(F.concat(F.lit("["), whole, F.lit("]")))
    return t("events").select("event_id", T.with_prefix(T.settings_map(text))["k"].alias("k"), T.page_coordinate(F.col("value"), F.lit(10)).alias("x"), T.settings_problem(text).alias("problem"))


@query("SELECT c_custkey, o_orderkey FROM (SELECT CASE WHEN c_custkey % 2 = 0 THEN c_custkey END AS c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey) WHERE c_custkey IS NOT NULL OR o_orderkey IS NOT NULL")
def null_drop(t: Callable, spark: SparkSession) -> DataFrame:
    joined = t("customer").join(t("orders"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return headers.without_empty_rows(joined.select(F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey")).alias("c_custkey"), "o_orderkey"))


@query("SELECT n_name, n_nationkey, n_regionkey FROM nation")
def display_columns(t: Callable, spark: SparkSession) -> DataFrame:
    df = t("nation").withColumn("label:x", F.lit(1))
    return df.select(*T.display_order(T.without_labels(df.columns), ["none", "n_name"]))


@query("SELECT doc_id, md5(base64(encode(text))) AS digest FROM documents")
def base64_text(t: Callable, spark: SparkSession) -> DataFrame:
    return t("documents").select("doc_id", F.md5(T.base64_text(F.encode("text", "UTF-8"))).alias("digest"))


@query("SELECT vec_id, round(sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 6) AS norm FROM embeddings")
def vector_norms(t: Callable, spark: SparkSession) -> DataFrame:
    return t("embeddings").select("vec_id", F.round(T.norm(F.col("embedding")), 6).alias("norm"))


@query("SELECT n_nationkey AS k, n_name AS name FROM nation UNION ALL SELECT r_regionkey, r_name FROM region")
def append_rows(t: Callable, spark: SparkSession) -> DataFrame:
    return t("nation").selectExpr("n_nationkey AS k", "n_name AS name").unionAll(t("region").selectExpr("r_regionkey", "r_name"))


@query("SELECT conv_id AS source_file, CAST(max(len(string_split(text, ' '))) AS INTEGER) AS width FROM conversations GROUP BY 1")
def table_widths(t: Callable, spark: SparkSession) -> DataFrame:
    return headers.widths(t("conversations").select(F.col("conv_id").alias("source_file"), F.split("text", " ", -1).alias("cells")))


@query("""SELECT c_custkey AS "lfd. Nr.", c_acctbal AS "Kosten (geschätzt) in Euro", c_name AS "_extra_foo bar", c_nationkey AS " " FROM customer""")
def rename_map(t: Callable, spark: SparkSession) -> DataFrame:
    raw = t("customer").select(F.col("c_custkey").alias("Index"), F.col("c_acctbal").alias("Kosten [EUR]"), F.col("c_name").alias("Foo  Bar"), F.col("c_nationkey").alias(" "))
    return raw.withColumnsRenamed(headers.renames(raw.columns, spark))


@query("SELECT n_name, n_regionkey, CAST(NULL AS VARCHAR) AS none FROM nation")
def reindexed(t: Callable, spark: SparkSession) -> DataFrame:
    return headers.reordered(t("nation"), ["n_regionkey", "none", "n_name"])


@query("""
    SELECT 'n' AS source_file, CAST(n_nationkey + 1 AS INTEGER) AS row_no, n_name AS name, CAST(n_regionkey AS VARCHAR) AS region, NULL AS again FROM nation
    UNION ALL SELECT 'r', CAST(r_regionkey + 1 AS INTEGER), r_name, NULL, 'x' FROM region""")
def csv_rows(t: Callable, spark: SparkSession) -> DataFrame:
    """Two files with unlike headers, one of which repeats a name and holds missing-value words."""
    cells = lambda df, name, at, *cols: df.select(F.lit(name).alias("source_file"), at.cast("int").alias("row_no"), F.array(*cols).alias("cells"))
    head = spark.createDataFrame([("n", 0, ["region", "name", "again"]), ("r", 0, ["name", "region", "name"]), ("r", 6, [])], "source_file string, row_no int, cells array<string>")
    n = cells(t("nation"), "n", F.col("n_nationkey") + 1, F.col("n_regionkey").cast("string"), F.col("n_name"))
    r = cells(t("region"), "r", F.col("r_regionkey") + 1, F.col("r_name"), F.lit("NA"), F.lit("x"), F.lit("beyond"))
    rows = files.rows_by_header(head.union(n).union(r))
    return rows.select("source_file", "row_no", *[F.try_element_at("fields", F.lit(c)).alias(c) for c in ("name", "region")], F.try_element_at("fields", F.lit("name.1")).alias("again"))


@query("SELECT p_partkey, p_name FROM part WHERE p_partkey = 7")
def selected_row(t: Callable, spark: SparkSession) -> DataFrame:
    part = t("part").select("p_partkey", "p_name")
    return search.selected(part.where("p_partkey > 100"), part, "p_partkey", -1, 7)


_SQL_WORDS = "list_filter(regexp_split_to_array(lower({c}), '[^[:alnum:]]+'), lambda w: w <> '')"


@query(f"""
    WITH x AS (SELECT p_partkey, concat(coalesce(p_name, ''), ' | ', coalesce(p_brand, '')) AS b, 'ring small brand' AS a FROM part),
    w AS (SELECT *, {_SQL_WORDS.format(c="a")} AS wa, {_SQL_WORDS.format(c="b")} AS wb FROM x),
    l AS (SELECT *, ' ' || array_to_string(wa, ' ') || ' ' AS la, ' ' || array_to_string(wb, ' ') || ' ' AS lb, array_to_string(list_sort(wa), ' ') AS sa, array_to_string(list_sort(wb), ' ') AS sb FROM w),
    s AS (SELECT p_partkey, greatest({_SQL_SIMILAR.format(a="a", b="b")}, round({_SQL_SIMILAR.format(a="sa", b="sb")} * 0.95, 4), CASE WHEN contains(la, lb) OR contains(lb, la) THEN 90 ELSE 0 END) AS score FROM l)
    SELECT p_partkey, score FROM s WHERE score >= 60""")
def token_filter(t: Callable, spark: SparkSession) -> DataFrame:
    out = search.by_similarity(t("part"), ["p_name", "p_brand"], "ring small brand", 60.0, scorer=T.token_similarity)
    return out.select("p_partkey", F.col(search.SCORE).alias("score"))


@query("""
    SELECT d.lang, md5(p.text) AS positive, md5(n.text) AS negative FROM (SELECT DISTINCT lang FROM documents) d
    JOIN (SELECT lang, text FROM documents JOIN labels USING (doc_id) WHERE quality = 1) p ON p.lang = d.lang
    JOIN (SELECT lang, text FROM documents JOIN labels USING (doc_id) WHERE quality = 0) n ON n.lang = d.lang""")
def triplet_texts(t: Callable, spark: SparkSession) -> DataFrame:
    held = t("labels").join(t("documents").select("doc_id", "lang"), "doc_id")
    texts = t("documents").select("doc_id", F.md5("text").alias("text"))
    return labels.triplets(held, "lang", "doc_id", "quality", texts=texts, key="doc_id", parts=4)


def _sql_lcs(a: str, b: str) -> str:
    """Length of the longest common subsequence of texts of up to 62 characters, by bits of `a` over the characters of `b`."""
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0 ELSE length({a}) - {_sql_unset(a, _sql_masks(a, b))} END"


def _sql_masks(a: str, b: str) -> str:
    return f"list_transform(string_split({b}, ''), lambda c: CAST(list_sum(list_transform(range(length({a})), lambda i: CASE WHEN substr({a}, CAST(i + 1 AS INTEGER), 1) = c THEN 1::BIGINT << CAST(i AS INTEGER) ELSE 0 END)) AS BIGINT))"


def _sql_unset(a: str, masks: str) -> str:
    full = f"((1::BIGINT << length({a})) - 1)"
    return f"bit_count(list_reduce(list_prepend({full}, {masks}), lambda s, m: ((s + (s & m)) | (s - (s & m))) & {full}))"


def _sql_window(s: str, t: str) -> str:
    """Score of `s` in the best window of `t`, which isn't shorter."""
    edges = f"greatest(w, 1), least(w + length({s}) - 1, length({t}))"
    common = f"length({s}) - {_sql_unset(s, f'list_slice(masks, {edges})')}"
    each = f"lambda w: 200.0::DOUBLE * ({common}) / (length({s}) + least(w + length({s}) - 1, length({t})) - greatest(w, 1) + 1)"
    return f"(SELECT list_max(list_transform(range(2 - length({s}), length({t}) + 1), {each})) FROM (SELECT {_sql_masks(s, t)} AS masks))"


def _sql_weighted(pairs: str) -> str:
    """The relation `pairs` (a, b and more; words parted by single blanks) with its weighted `score`, as a list of CTEs."""
    ratio = lambda a, b: f"200.0::DOUBLE * ({_sql_lcs(a, b)}) / (length({a}) + length({b}))"
    window = lambda a, b: f"CASE WHEN length({a}) < length({b}) THEN {_sql_window(a, b)} WHEN length({a}) > length({b}) THEN {_sql_window(b, a)} ELSE greatest({_sql_window(a, b)}, {_sql_window(b, a)}) END"
    joined = lambda x: f"array_to_string(list_sort({x}), ' ')"
    return f"""
        w0 AS (SELECT *, string_split(a, ' ') AS xa, string_split(b, ' ') AS xb, greatest(length(a), length(b)) / least(length(a), length(b))::DOUBLE AS unlike FROM {pairs}),
        w1 AS (SELECT *, list_distinct(list_filter(xa, lambda x: list_contains(xb, x))) AS shared, list_distinct(list_filter(xa, lambda x: NOT list_contains(xb, x))) AS oa, list_distinct(list_filter(xb, lambda x: NOT list_contains(xa, x))) AS ob FROM w0),
        w2 AS (SELECT *, {joined('xa')} AS sa, {joined('xb')} AS sb, {joined('oa')} AS da, {joined('ob')} AS db, length({joined('shared')}) AS n FROM w1),
        w3 AS (SELECT *, {ratio('a', 'b')} AS plain, {ratio('sa', 'sb')} AS sorted, 100 * (1 - (length(da) + length(db) - 2 * ({_sql_lcs('da', 'db')})) / greatest(2 * (n + (n > 0)::INTEGER) + length(da) + length(db), 1)::DOUBLE) AS rest FROM w2 WHERE unlike < 1.5),
        w4 AS (SELECT *, CASE WHEN len(shared) > 0 AND (da = '' OR db = '') THEN 100 WHEN n > 0 THEN greatest(rest, 100 * (1 - (1 + length(da)) / (2 * n + 1 + length(da))::DOUBLE), 100 * (1 - (1 + length(db)) / (2 * n + 1 + length(db))::DOUBLE)) ELSE rest END AS sets FROM w3),
        w5 AS (SELECT *, CASE WHEN unlike <= 8 THEN 0.9 ELSE 0.6 END::DOUBLE AS share FROM w2 WHERE unlike >= 1.5),
        weighted AS (
            SELECT * EXCLUDE (xa, xb, unlike, shared, oa, ob, sa, sb, da, db, n, plain, sorted, rest, sets), round(greatest(plain, 0.95 * sorted, 0.95 * sets), 4) AS score FROM w4
            UNION ALL BY NAME SELECT * EXCLUDE (xa, xb, unlike, shared, oa, ob, sa, sb, da, db, n, share), round(greatest({ratio('a', 'b')}, share * ({window('a', 'b')}),
                CASE WHEN len(shared) > 0 THEN 100 * 0.95 * share ELSE share * 0.95 * ({window('sa', 'sb')}) END), 4) AS score FROM w5)"""


@query(f"""
    WITH pairs AS (SELECT 'small rng' AS a, concat(coalesce(p_name, ''), ' | ', coalesce(p_brand, '')) AS b, p_partkey FROM part), {_sql_weighted("pairs")}
    SELECT p_partkey, score FROM weighted WHERE score >= 60""")
def fuzzy_filter_partial(t: Callable, spark: SparkSession) -> DataFrame:
    out = search.by_similarity(t("part"), ["p_name", "p_brand"], "small rng", 60.0, scorer=weighted_similarity)
    return out.select("p_partkey", F.col(search.SCORE).alias("score"))


@query(f"""
    WITH names AS (SELECT DISTINCT replace(p_name, 'ing', 'in') AS a FROM part), labels AS (SELECT concat(p_type, ' ', p_name) AS b, min(p_partkey) AS key FROM part GROUP BY 1),
    pairs AS (SELECT a, b, key FROM names, labels), {_sql_weighted("pairs")},
    r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, key) AS rank FROM weighted WHERE score >= 75)
    SELECT a AS name, key, b AS label, score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10""")
def fuzzy_join_partial(t: Callable, spark: SparkSession) -> DataFrame:
    names = t("part").select(F.replace("p_name", F.lit("ing"), F.lit("in")).alias("clue"))
    labels_ = t("part").select("p_partkey", F.concat_ws(" ", "p_type", "p_name").alias("label"))
    return matching.aligned_matches(names, "clue", labels_, "p_partkey", "label")


@query("SELECT o_orderkey, 'https://www.openstreetmap.org/way/' || o_orderkey AS url FROM orders")
def way_urls(t: Callable, spark: SparkSession) -> DataFrame:
    return t("orders").select("o_orderkey", T.way_url(F.col("o_orderkey").cast("double")).alias("url"))


@query("SELECT DISTINCT o_orderkey % 10 AS row_hash, o_custkey % 3 AS candidate FROM orders")
def label_pairs(t: Callable, spark: SparkSession) -> DataFrame:
    return t("orders").select(T.label_key(F.col("o_orderkey") % 10, F.col("o_custkey") % 3).alias("k")).distinct().select("k.*")


@query("""
    WITH f AS (SELECT url, min_by(html, page_id) AS html FROM pages GROUP BY url)
    SELECT page_id, md5(f.html) AS digest, strlen(f.html) AS bytes FROM pages JOIN f USING (url)""")
def document_fetch(t: Callable, spark: SparkSession) -> DataFrame:
    """Pages by their address, from a record of their bytes."""
    first = t("pages").groupBy(F.col("url").alias("request")).agg(F.min_by("html", "page_id").alias("html"))
    answers = first.select("request", T.base64_text(F.encode("html", "UTF-8")).alias("answer"))
    got = models.fetched(t("pages").select("page_id", "url"), F.col("url"), models.RecordedTable(answers))
    return got.select("page_id", F.md5("content").alias("digest"), F.octet_length("content").cast("long").alias("bytes"))


@query("SELECT doc_id, source, md5(nullif(text, '')) AS text_md5 FROM documents")
def csv_ranges(t: Callable, spark: SparkSession) -> DataFrame:
    """Texts with quotes and line ends, written as CSV and read by ranges of bytes."""
    folder = files.scratch(spark)
    files.write_csv(t("documents").select("doc_id", "source", "text"), folder)
    rows = files.read_rows(spark, folder)
    field = lambda name: F.try_element_at("fields", F.lit(name))
    return rows.select(field("doc_id").cast("long").alias("doc_id"), field("source").alias("source"), F.md5(field("text")).alias("text_md5"))


@query("""
    SELECT DISTINCT p_brand, 0 AS row_no, 'p_partkey' AS id, 'p_name' AS mark FROM part
    UNION ALL SELECT p_brand, CAST(r AS INTEGER), CAST(p_partkey AS VARCHAR), p_name FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS r FROM part) WHERE r < 4""")
def csv_preview(t: Callable, spark: SparkSession) -> DataFrame:
    """The first four records of each brand's file, of which only the first bytes are read."""
    folder = files.scratch(spark)
    dealt = t("part").select("p_brand", "p_partkey", "p_name").repartition("p_brand").sortWithinPartitions("p_brand", "p_partkey")
    dealt.write.partitionBy("p_brand").csv(folder, header=True)
    brand = F.url_decode(F.regexp_extract("source_file", "p_brand=([^/]+)/", 1)).alias("p_brand")
    return files.read_preview(spark, folder).select(brand, "row_no", F.get("cells", F.lit(0)).alias("id"), F.get("cells", F.lit(1)).alias("mark"))


@query("SELECT event_id AS id, event_type AS power, json_extract_string(props, '$.k') AS \"tag::k\" FROM events WHERE event_type = 'click'")
def map_extract(t: Callable, spark: SparkSession) -> DataFrame:
    """Events as ways with tags, written as an extract and read in ranges, with the tag's value pushed to the source."""
    folder = files.scratch(spark)
    tags = F.create_map(F.lit("power"), F.col("event_type"), F.lit("k"), F.try_element_at(F.from_json("props", "map<string,string>"), F.lit("k")))
    osm.write_ways(t("events").select(F.col("event_id").alias("id"), tags.alias("tags")), folder)
    return osm.expanded(osm.read_ways(spark, folder, value="click", range_bytes=1 << 20), ("k",))


_SQL_CELLS = """
    SELECT 'customer' AS source_file, c_custkey AS row_no, unnest(['key', 'name', 'amount', 'flag']) AS name,
        unnest([CAST(c_custkey AS VARCHAR), c_name, CAST(c_acctbal AS VARCHAR), CASE WHEN c_nationkey % 2 = 0 THEN 'True' ELSE 'False' END]) AS v FROM customer
    UNION ALL SELECT 'part', p_partkey, unnest(['key', 'name', 'amount', 'note']), unnest([CASE WHEN p_partkey % 7 = 0 THEN 'NA' ELSE CAST(p_partkey AS VARCHAR) END, p_brand, CAST(p_size AS VARCHAR), '']) FROM part"""
_SQL_TYPES = f"""
    cells AS ({_SQL_CELLS}),
    kinds AS (SELECT *, CASE WHEN v IN ('', 'NA') THEN 'none' WHEN regexp_full_match(v, '[+-]?[0-9]+') THEN 'whole' WHEN regexp_full_match(v, '[+-]?[0-9]*[.][0-9]*([eE][+-]?[0-9]+)?') THEN 'fraction' WHEN v IN ('True', 'False') THEN 'truth' ELSE 'words' END AS kind FROM cells),
    sets AS (
        SELECT source_file, name, list(DISTINCT kind) AS k FROM kinds GROUP BY ALL
        UNION ALL SELECT NULL, name, list_concat(list(DISTINCT kind), CASE WHEN count(DISTINCT source_file) < 2 THEN ['none'] ELSE [] END) FROM kinds GROUP BY name),
    types AS (
        SELECT source_file, name, CASE WHEN list_contains(k, 'words') OR (list_contains(k, 'truth') AND len(list_distinct(k)) > 1) THEN 'string' WHEN list_contains(k, 'truth') THEN 'boolean'
            WHEN list_contains(k, 'fraction') OR list_contains(k, 'none') THEN 'double' ELSE 'long' END AS type FROM sets)"""


def _typed_cells(t: Callable, spark: SparkSession) -> DataFrame:
    """Customers and parts as the records of two CSV files with unlike headers."""
    head = lambda df, name, *cols: df.agg(F.lit(0).alias("row_no"), F.array(*[F.lit(c) for c in cols]).alias("cells")).select(F.lit(name).alias("source_file"), F.col("row_no").cast("long").alias("row_no"), "cells")
    flag = F.when(F.col("c_nationkey") % 2 == 0, "True").otherwise("False")
    c = t("customer").select(F.lit("customer").alias("source_file"), (F.col("c_custkey") + 1).alias("row_no"), F.array(F.col("c_custkey").cast("string"), "c_name", F.col("c_acctbal").cast("string"), flag).alias("cells"))
    key = F.when(F.col("p_partkey") % 7 == 0, "NA").otherwise(F.col("p_partkey").cast("string"))
    p = t("part").select(F.lit("part").alias("source_file"), (F.col("p_partkey") + 1).alias("row_no"), F.array(key, "p_brand", F.col("p_size").cast("string"), F.lit("")).alias("cells"))
    return head(t("customer"), "customer", "key", "name", "amount", "flag").union(head(t("part"), "part", "key", "name", "amount", "note")).union(c).union(p)


@query(f"WITH {_SQL_TYPES} SELECT * FROM types")
def inferred_types(t: Callable, spark: SparkSession) -> DataFrame:
    return types.column_types(types.column_classes(_typed_cells(t, spark)))


@query(f"""
    WITH {_SQL_TYPES} SELECT source_file, row_no + 1 AS row_no, count(CASE WHEN type IN ('long', 'double') THEN 1 END) AS numbers, round(sum(CASE WHEN type IN ('long', 'double') THEN CAST(nullif(v, 'NA') AS DOUBLE) END), 2) AS total
    FROM (SELECT * FROM cells WHERE v NOT IN ('', 'NA')) JOIN types USING (source_file, name) GROUP BY ALL""")
def typed_values(t: Callable, spark: SparkSession) -> DataFrame:
    cells = _typed_cells(t, spark)
    rows = types.typed_rows(files.rows_by_header(cells), types.column_types(types.column_classes(cells)))
    number = F.filter(F.transform(F.map_values("fields"), lambda v: F.when(F.schema_of_variant(v).rlike("BIGINT|DOUBLE|DECIMAL|INT"), F.try_variant_get(v, "$", "double"))), lambda x: x.isNotNull())
    return rows.select("source_file", "row_no", F.size(number).cast("long").alias("numbers"), F.round(F.aggregate(number, F.lit(0.0), lambda a, x: a + x), 2).alias("total"))


_SQL_LONG_DRAW = "CAST('0x' || left(md5('42|' || CAST({key} AS VARCHAR)), 15) AS BIGINT)"


@query(f"SELECT *, CASE WHEN row_number() OVER (ORDER BY {_SQL_LONG_DRAW.format(key='doc_id')}) <= ceil((SELECT count(*) FROM labels) / 5.0) THEN 'test' ELSE 'train' END AS part FROM labels")
def split_rows_exactly(t: Callable, spark: SparkSession) -> DataFrame:
    return labels.split_exact(t("labels"), "doc_id")


@query(f"""
    SELECT l_orderkey, l_linenumber, CASE WHEN dense_rank() OVER (ORDER BY {_SQL_LONG_DRAW.format(key='l_orderkey')}) <= ceil((SELECT count(DISTINCT l_orderkey) FROM lineitem) / 5.0) THEN 'test' ELSE 'train' END AS part FROM lineitem""")
def split_anchors_exactly(t: Callable, spark: SparkSession) -> DataFrame:
    return labels.split_exact(t("lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey", by_key=True)


_SQL_FOLD = """
    names AS (SELECT DISTINCT p_name FROM part), entries AS (SELECT list(struct_pack(t := '', c := p_name, n := next) ORDER BY p_name) AS e FROM (SELECT p_name, lead(p_name) OVER (ORDER BY p_name) AS next FROM names) WHERE next IS NOT NULL)"""
_SQL_FOLDED = "list_reduce(list_prepend(struct_pack(t := {text}, c := '', n := ''), e), lambda a, x: struct_pack(t := replace(a.t, x.c, x.c || ' (' || x.n || ')'), c := '', n := '')).t"


def _name_entries(t: Callable) -> list[tuple[str, str]]:
    """Every part name, with the next one behind it: an inserted name sets off the next entry."""
    own = t("part").select("p_name").where(F.col("p_name").isNotNull()).distinct()
    names = sorted(r[0] for r in own.limit(replacement.MOST_ENTRIES + 2).collect())  # one entry too many is an error
    return list(zip(names, names[1:], strict=False))


def _dealt(t: Callable, spark: SparkSession) -> DataFrame:
    """The parts, dealt to all tasks: a small file is read by one, whatever the work on its rows."""
    return t("part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


@query(f"WITH {_SQL_FOLD} SELECT p_partkey, {_SQL_FOLDED.format(text="p_brand || ': ' || p_name")} AS name FROM part, entries")
def chained_replace(t: Callable, spark: SparkSession) -> DataFrame:
    return _dealt(t, spark).select("p_partkey", replacement.replace_all(F.concat("p_brand", F.lit(": "), "p_name"), _name_entries(t)).alias("name"))


@query(f"""
    WITH {_SQL_FOLD} SELECT p_partkey, 'query: p_name: ' || CASE WHEN regexp_matches(p_brand, '^.*Brand.*[12].*') THEN {_SQL_FOLDED.format(text="p_name")} ELSE p_name END || '; p_type: ' || p_type || '; p_size: ' || p_size AS query FROM part, entries""")
def serialize_measures(t: Callable, spark: SparkSession) -> DataFrame:
    text = replacement.serialized_measure(["p_name", "p_type", "p_size"], _name_entries(t), "p_name", "p_brand", ".*Brand.*[12].*")
    return _dealt(t, spark).select("p_partkey", text.alias("query"))


@query("""
    SELECT event_id, user_id, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS r FROM events) WHERE r = 1""")
def label_store(t: Callable, spark: SparkSession) -> DataFrame:
    """All events as labels in three upserts of a bucketed store."""
    store = stores.LabelStore(spark, files.scratch(spark), ["user_id", "event_type"], "event_id", 8)
    e = t("events").select("event_id", "user_id", "event_type", "value")
    for wanted in ("event_type = 'click'", "event_type <> 'click' AND value < 20", "event_type <> 'click' AND value >= 20"):
        store.upsert(e.where(wanted))
    return store.read()


@query("""
    WITH r AS (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey, l_linenumber) AS rank FROM lineitem),
    n AS (SELECT * FROM r WHERE rank = 1 AND l_orderkey = (SELECT max(l_orderkey) FROM lineitem))
    SELECT o_orderkey AS seen, coalesce(r.l_orderkey, n.l_orderkey) AS l_orderkey, CAST(coalesce(r.rank, n.rank) AS INTEGER) AS rank, CASE WHEN r.rank IS NULL THEN n.l_partkey ELSE r.l_partkey END AS l_partkey
    FROM (SELECT o_orderkey, o_custkey % 5 + 1 AS s FROM orders) LEFT JOIN r ON r.l_orderkey = o_orderkey AND r.rank = s CROSS JOIN n""")
def next_measure(t: Callable, spark: SparkSession) -> DataFrame:
    """The next candidate of each order; behind the last one, the first of a new order."""
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(F.desc("l_extendedprice"), "l_partkey", "l_linenumber"))
    ranked = t("lineitem").select("l_orderkey", "l_partkey", rank.alias("rank"))
    seen = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % 5).cast("int").alias("rank"))
    return labels.advance(ranked, seen, "l_orderkey", t("lineitem").agg(F.max("l_orderkey").alias("l_orderkey")))


@query("SELECT doc_id, quality, toxic FROM labels")
def label_array(t: Callable, spark: SparkSession) -> DataFrame:
    """Labels written as JSON arrays, one for each quality and 500 ids, and read by their elements."""
    folder = files.scratch(spark)
    one = F.concat(F.lit("[\n"), F.array_join(F.collect_list(F.to_json(F.struct("doc_id", "quality", "toxic"), {"ignoreNullFields": "false"})), ",\n"), F.lit("\n]"))
    t("labels").groupBy("quality", F.floor(F.col("doc_id") / 500).alias("part")).agg(one.alias("value")).write.partitionBy("quality", "part").text(folder)
    return files.read_json_array(spark, folder, "doc_id long, quality int, toxic int")


@query("""
    SELECT page_id, page, table_no, row_no, CAST(k AS INTEGER) AS cell_no, v AS cell FROM (
        SELECT page_id, 1 AS page, 0 AS table_no, 0 AS row_no, unnest([url, NULL]) AS v, unnest([0, 1]) AS k FROM pages
        UNION ALL SELECT page_id, 1, 0, 1, unnest([CAST(strlen(html) AS VARCHAR), 'x']), unnest([0, 1]) FROM pages
        UNION ALL SELECT page_id, 2, CAST(page_id % 3 AS INTEGER), 0, CAST(page_id AS VARCHAR), 0 FROM pages)""")
def document_tables(t: Callable, spark: SparkSession) -> DataFrame:
    """Tables of documents from a reader's answers on record: two for each page, blank cells null."""
    first = F.struct(F.lit(1).alias("page"), F.lit(0).alias("table_no"), F.array(F.array(F.col("url"), F.lit("")), F.array(F.octet_length("html").cast("string"), F.lit("x"))).alias("rows"))
    second = F.struct(F.lit(2).alias("page"), (F.col("page_id") % 3).cast("int").alias("table_no"), F.array(F.array(F.col("page_id").cast("string"))).alias("rows"))
    content = F.encode(F.concat(F.col("page_id").cast("string"), F.lit(":"), F.col("html")), "UTF-8")
    docs = t("pages").withColumn("content", content)
    answers = docs.select(T.base64_text(F.col("content")).alias("request"), F.to_json(F.array(first, second)).alias("answer"))
    found = models.found_tables(docs.select("page_id", "content"), models.RecordedTable(answers), "page_id")
    return found.select("page_id", "page", "table_no", "row_no", F.posexplode("cells").alias("cell_no", "cell"))


@query("SELECT page_id, 1 AS page, word AS text, CAST(i * 10 AS DOUBLE) AS x0, CAST(i * 10 + length(word) AS DOUBLE) AS x1 FROM (SELECT page_id, unnest(string_split(url, '/')) AS word, unnest(range(len(string_split(url, '/')))) AS i FROM pages) WHERE i BETWEEN 2 AND 3")
def document_words(t: Callable, spark: SparkSession) -> DataFrame:
    """Words of documents with their places, of which those of a band of the page are kept."""
    words = F.transform(F.split("url", "/"), lambda w, i: F.struct(F.lit(1).alias("page"), w.alias("text"), (i * 10.0).alias("x0"), (i * 10.0 + F.length(w)).alias("x1"), F.lit(0.0).alias("top"), i.cast("double").alias("bottom")))
    docs = t("pages").withColumn("content", F.encode(F.concat(F.col("page_id").cast("string"), F.col("url")), "UTF-8"))
    answers = docs.select(T.base64_text(F.col("content")).alias("request"), F.to_json(words).alias("answer"))
    found = models.found_words(docs.select("page_id", "content"), models.RecordedTable(answers), "page_id")
    return pages.words_between(found, 20, 30, "x0", ("page_id",)).select("page_id", "page", "text", "x0", "x1")


@query("SELECT p_brand, p_type, CAST(row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) - 1 AS INTEGER) AS row_no, p_name AS a, CAST(p_size AS VARCHAR) AS b FROM part")
def table_files(t: Callable, spark: SparkSession) -> DataFrame:
    """A headerless file for each brand and type, written in order and read again as records."""
    folder = files.scratch(spark)
    rows = t("part").select(F.col("p_brand").alias("folder"), F.col("p_type").alias("table"), F.col("p_partkey").alias("place"), F.array("p_name", F.col("p_size").cast("string")).alias("cells"))
    files.write_tables(rows, folder)
    part = lambda name: F.url_decode(F.regexp_extract("source_file", f"{name}=([^/]+)/", 1))
    return files.read_cells(spark, folder).select(part("folder").alias("p_brand"), part("table").alias("p_type"), "row_no", F.get("cells", F.lit(0)).alias("a"), F.get("cells", F.lit(1)).alias("b"))


@query("SELECT n_nationkey AS folder, 'n_' || n_nationkey || '.csv' AS file FROM nation ORDER BY CAST(n_nationkey AS VARCHAR)")
def listed_files(t: Callable, spark: SparkSession) -> DataFrame:
    """A document of each nation, written below its folder and listed by a glob, sorted, by their path below the root."""
    folder = files.scratch(spark)
    rows = t("nation").select(F.col("n_nationkey").cast("string").alias("folder"), F.concat(F.lit("n_"), "n_nationkey", F.lit(".csv")).alias("file"), F.encode("n_name", "UTF-8").alias("content"))
    files.write_documents(rows.unionByName(rows.withColumn("file", F.lit("other.txt"))), folder.removeprefix("file:"))
    found = files.source_files(spark, folder, "*csv")
    return found.select(F.split_part("source_file", F.lit("/"), F.lit(1)).cast("int").alias("folder"), F.split_part("source_file", F.lit("/"), F.lit(2)).alias("file"))


@query("""SELECT n_nationkey AS case_no, '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","note":null}' AS body FROM nation""")
def edge_cases(t: Callable, spark: SparkSession) -> DataFrame:
    """Rows kept as cases, each in a folder of its own, and read again."""
    folder = files.scratch(spark)
    files.write_case(t("nation").select("n_nationkey", "n_name", F.lit(None).cast("string").alias("note")), folder, "n_nationkey")
    return spark.read.text(folder).select(F.col("_case").cast("int").alias("case_no"), F.col("value").alias("body"))


@query("SELECT p_partkey FROM part WHERE regexp_matches(p_name, 'ring|17', 'i') OR regexp_matches(p_brand, 'ring|17', 'i')")
def default_search(t: Callable, spark: SparkSession) -> DataFrame:
    """A search over the telling columns only, found by their names: the type and the price are none."""
    named = t("part").select("p_partkey", F.col("p_name").alias("Objekt/Maßnahme"), F.col("p_brand").alias("Betriebs-\nmittel Betriebsmittel"), F.col("p_type").alias("Art"), F.col("p_retailprice").alias("Preis"))
    columns = T.search_columns([c for c in named.columns if c != "p_partkey"])
    held = named.select("p_partkey", *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    return search.by_regex(held, held.columns[1:], "ring|17").select("p_partkey")


@query("""
    SELECT p_partkey, p_name AS first, p_brand AS last, [CAST(p_size AS DOUBLE), p_retailprice] AS lines, CASE WHEN p_size % 2 = 0 THEN p_partkey END AS id, CASE WHEN p_size < 10 THEN 'substation' ELSE p_type END AS asset FROM part""")
def parsed_fields(t: Callable, spark: SparkSession) -> DataFrame:
    """Written forms of lists, lines, ids and kinds, read again."""
    held = T.list_literal(F.concat(F.lit("['"), "p_name", F.lit("', '"), "p_brand", F.lit("']")))
    lines = T.vertical_lines(F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(", ,"), F.col("p_retailprice").cast("string"), F.lit(" ,")))
    number = T.id_value(F.when(F.col("p_size") % 2 == 0, F.concat(F.lit(" "), F.col("p_partkey").cast("string"), F.lit(" "))).otherwise("  "))
    asset = T.asset_type(F.when(F.col("p_size") < 10, F.lit("transformer_station")).otherwise(F.col("p_type")))
    return t("part").select("p_partkey", F.get(held, F.lit(0)).alias("first"), F.get(held, F.lit(1)).alias("last"), lines.alias("lines"), number.alias("id"), asset.alias("asset"))


@query("SELECT s_suppkey, s_nationkey + 1 AS pages FROM supplier")
def page_counts(t: Callable, spark: SparkSession) -> DataFrame:
    """Documents of as many plainly stored pages as the nation's number and one, written, read as bytes and counted."""
    folder = files.scratch(spark)
    body = F.concat(F.lit("%PDF-1.4\n<< /Type /Pages >>\n"), F.repeat(F.lit("<< /Type /Page /Parent 1 0 R >>\n"), F.col("s_nationkey").cast("int") + 1))
    rows = t("supplier").select(F.col("s_suppkey").cast("string").alias("folder"), F.lit("plan.pdf").alias("file"), F.encode(body, "UTF-8").alias("content"))
    files.write_documents(rows, folder.removeprefix("file:"))
    got = files.read_bytes(spark, folder)
    return got.select(F.regexp_extract("path", "([0-9]+)/plan.pdf$", 1).cast("long").alias("s_suppkey"), pages.page_count(F.col("content")).cast("int").alias("pages"))


@query(f"""
    WITH labels_ AS (SELECT concat(p_type, ' ', p_name) AS b, min(p_partkey) AS key FROM part GROUP BY 1),
    clues AS (SELECT s_suppkey, replace(p_name, 'ing', 'in') AS a FROM supplier JOIN part ON p_partkey = s_suppkey WHERE s_nationkey % 2 = 1),
    pairs AS (SELECT s_suppkey, a, b, key FROM clues, labels_), {_sql_weighted("pairs")},
    r AS (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY score DESC, key) AS rank FROM weighted WHERE score >= 75)
    SELECT supplier.s_suppkey, r.key AS osm_id, r.score FROM supplier LEFT JOIN r ON r.s_suppkey = supplier.s_suppkey AND rank = 1""")
def geocode_aligned(t: Callable, spark: SparkSession) -> DataFrame:
    """The best match of each supplier's first clue by the weighted score, where it is a station."""
    rows = t("supplier").join(t("part"), F.col("p_partkey") == F.col("s_suppkey")).where(F.col("s_nationkey") % 2 == 1)
    first = rows.select("s_suppkey", F.replace("p_name", F.lit("ing"), F.lit("in")).alias("name"))
    known = t("part").select("p_partkey", F.concat_ws(" ", "p_type", "p_name").alias("label"))
    best = matching.aligned_matches(first, "name", known, "p_partkey", "label", k=1)
    found = first.join(best, "name").select("s_suppkey", F.col("key").alias("osm_id"), "score")
    return t("supplier").select("s_suppkey").join(found, "s_suppkey", "left")
