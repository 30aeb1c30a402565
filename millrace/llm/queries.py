"""The thin opN_<name> queries: each applies its operator to a whole table and derives its digest columns."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import licenses
from .ann import nearest
from .codes import compress
from .common import WORD, read
from .exact_topk import exact_top_k
from .langid import held_out, predict, train
from .licenses import scan
from .line_dedup import dedup_lines
from .mixing import mix
from .packing import pack, token_pieces
from .pii import pseudonymise
from .prefix_trie import rebuilt, sequences, trie
from .sentencepiece_bpe import encoded
from .sharding import shard_rows
from .simhash import near_duplicates


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"), words=3, radius=2)
    return found.select("row.doc_id", F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    key = F.col("doc_id")
    model = train(docs, where=key.isNotNull() & ~held_out(key))
    out = predict(docs.select("doc_id", held_out(key).alias("held_out"), "text"), model)
    return out.select("row.doc_id", "row.held_out", "lang_pred", "score")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
    known = F.filter("sentences", lambda s: s != "-")
    return out.select("row.doc_id", F.array_join(known, " ").alias("sentences"), F.array_join("licenses", " ").alias("licenses"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_pieces(read(spark, sf_dir, "documents"), _tokenizer(), capacity=2048)
    digest = pieces.select("row.doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(digest, capacity=2048).select("row.*", "sequence_id", "offset")


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"), every=20, k=20)


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(read(spark, sf_dir, "embeddings"), every=50, k=5)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    digest = docs.select("doc_id", "source", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    out = shard_rows(digest, key=("doc_id", "text_crc32", "size"))
    return out.select("row.doc_id", "row.size", "row.text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row.source")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    digest = docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    return mix(digest, size="size").select("row.doc_id", "size", "source_size", "target", "taken")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pseudonymise(read(spark, sf_dir, "documents").select("doc_id", "text"), key="op9")
    return out.select("row.doc_id", "text", "entities")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"), min_span=10)
    gone = F.flatten(F.transform("removed", lambda s: F.sequence(s["start"], s["start"] + s["n"] - 1)))
    return out.select("row.doc_id", "lines", F.col("left").alias("lines_left"), F.array_join(gone.cast("array<string>"), " ").alias("removed_lines"), F.crc32("text").alias("text_crc32"))


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = compress(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    code = F.lower(F.array_join(F.transform("code", lambda c: F.lpad(F.hex(c), 2, "0")), ""))
    return out.rows.select(F.col("id").alias("vec_id"), code.alias("code"), "error", "label_error", F.lit(out.sha256()).alias("codebooks_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = sequences(read(spark, sf_dir, "conversations"))
    c = F.col("conv_id")
    return trie(rebuilt(own, base=c - c % 20, head=F.crc32(c.cast("string")) % 4, most=3))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read(spark, sf_dir, "documents")
    out = encoded(docs.select("doc_id", "text"), F.col("text"), public_tokenizers.path("piece_bpe_32k.model"), decode=True)
    tokens = F.floor(F.octet_length("ids") / 4).cast("long")
    return out.select("row.doc_id", tokens.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_langid": op2_langid,
    "op3_licenses": op3_licenses,
    "op4_packing": op4_packing,
    "op5_ann": op5_ann,
    "op6_exact_topk": op6_exact_topk,
    "op7_sharding": op7_sharding,
    "op8_mixing": op8_mixing,
    "op9_pii": op9_pii,
    "op10_line_dedup": op10_line_dedup,
    "op11_codes": op11_codes,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_sentencepiece": op13_sentencepiece,
}



def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _licenses_sql() -> str:
    """op3 in DuckDB: the same tables of sentences, variations and rules, with its own chain of functions."""

    def replaced(x: str, pattern: str, new: str) -> str:
        return f"regexp_replace({x}, {_quoted(pattern)}, {_quoted(re.sub(r'[$]([0-9])', r'\\\1', new))}, 'g')"

    def named(x: str) -> str:
        x = replaced(f"translate({x}, '{licenses.UPPER}', '{licenses.LOWER}')", r"\.+([^0-9]|$)", " $1")
        x = f"trim({replaced(x, '[^a-z0-9.]+', ' ')})"
        for pattern, new in licenses.VARYING:
            x = replaced(x, pattern, new)
        return x

    def table(entries: dict[str, str]) -> str:
        return "MAP {" + ", ".join(f"{_quoted(k)}: {_quoted(v)}" for k, v in entries.items()) + "}"

    firsts = [f"map_extract_value(long, array_to_string(list_slice(string_split({{x}}, ' '), 1, {n}), ' '))" for n in sorted({len(k.split()) for k in licenses.LONG}, reverse=True)]
    one = f"coalesce(map_extract_value(known, {{x}}), {', '.join(firsts)})"
    each = f"list_transform(string_split_regex(substr({{x}}, 7), {_quoted(licenses.JOINED)}), lambda p: map_extract_value(known, 'under ' || {replaced('p', licenses.AROUND, '')}))"
    found = f"CASE WHEN {one} IS NOT NULL THEN [{one}] WHEN starts_with({{x}}, 'under ') AND regexp_matches({{x}}, {_quoted(licenses.JOINED)}) AND len(list_filter({each}, lambda i: i IS NULL)) = 0 THEN {each} END"
    left = "array_to_string(list_transform(ids, lambda i: '@' || i || ' '), '')"
    for pattern, name in licenses.RULES:
        left = replaced(left, pattern, f"<{name}> ")
    return f"""
        WITH parts AS (
            SELECT doc_id, CASE WHEN regexp_matches(text, {_quoted(licenses.HINT)}) THEN string_split({replaced("text", licenses.BREAK, "$1$2" + chr(1))}, chr(1)) ELSE [] END AS s FROM documents),
        units AS (SELECT doc_id, list_transform(s, lambda x: {{'n': {named("x")}, 'l': list_transform(string_split(x, chr(10)), lambda y: {named("y")})}}) AS u,
            {table(licenses.KNOWN)} AS known, {table(licenses.LONG)} AS long FROM parts),
        named AS (SELECT doc_id, coalesce(flatten(list_transform(u, lambda x: coalesce({found.format(x="x.n")}, flatten(list_transform(x.l, lambda y: coalesce({found.format(x="y")}, ['-'])))))), []) AS ids FROM units)
        SELECT doc_id, array_to_string(list_filter(ids, lambda i: i <> '-'), ' ') AS sentences, array_to_string(regexp_extract_all({left}, '<([^>]+)>', 1), ' ') AS licenses FROM named
    """


#: CRC-32 of a text's UTF-8 bytes, byte by byte over the table `crcs`.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: CAST('0x' || x AS BIGINT))),
    lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])))"""
_CRCS = "list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crcs"
_SEEDED = "CAST('0x' || left(md5({text}), 15) AS BIGINT)"


def _codes_sql() -> str:
    """op11 in DuckDB: plain distances of every part to every entry, in integers, in each round."""
    far = "list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - y[i]) * (x[i] - y[i])))"

    def nearest(k: int) -> str:
        return f"a{k} AS (SELECT rid, p, min((CAST({far} AS BIGINT), e)) AS best FROM part JOIN b{k} USING (p) GROUP BY rid, p)"

    def moved(k: int) -> str:
        return f"""n{k} AS (SELECT p, best[2] AS e, i, CAST(floor(sum(x[i]) / CAST(count(*) AS DOUBLE)) AS BIGINT) AS c FROM a{k} JOIN part USING (rid, p), size, range(1, size + 1) r(i) GROUP BY p, e, i),
            m{k} AS (SELECT p, e, list(c ORDER BY i) AS z FROM n{k} GROUP BY p, e),
            b{k + 1} AS (SELECT p, e, coalesce(z, y) AS y FROM b{k} LEFT JOIN m{k} USING (p, e))"""

    return f"""
        WITH v AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v, row_number() OVER () AS rid FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
        size AS (SELECT max(len(v)) // 16 AS size FROM v),
        part AS (SELECT rid, vec_id, p, v[p * size + 1:p * size + size] AS x FROM v, size, range(16) r(p)),
        first AS (SELECT rid, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM v QUALIFY e < 64),
        b0 AS (SELECT p, e, x AS y FROM first JOIN part USING (rid)),
        {nearest(0)}, {moved(0)}, {nearest(1)}, {moved(1)}, {nearest(2)},
        o AS (SELECT rid, string_agg(lpad(lower(to_hex(best[2])), 2, '0'), '' ORDER BY p) AS code, CAST(sum(best[1]) AS BIGINT) AS error FROM a2 GROUP BY rid),
        h AS (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b2)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM v JOIN o USING (rid), h
    """


_TRIE = rf"""
    WITH t AS (
        SELECT conv_id AS c, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w
        FROM conversations WHERE conv_id IS NOT NULL),
    k AS (SELECT c, list(struct_pack(d := d, w := w) ORDER BY turn NULLS FIRST, d) AS s FROM t GROUP BY c),
    h AS (SELECT c, s, {_CRC.replace("text", "CAST(c AS VARCHAR)")} % 4 AS h FROM k, (SELECT {_CRCS})),
    r AS (SELECT h.c, list_concat(coalesce(list_slice(k.s, 1, h), []), list_slice(h.s, h + 1, len(h.s))) AS s FROM h LEFT JOIN k ON k.c = h.c - h.c % 20),
    p AS (SELECT c, s, unnest(range(len(s) + 1)) AS d FROM r),
    n AS (
        SELECT array_to_string(list_transform(list_slice(s, 1, d), lambda x: x.d), '') AS node, d, min(c) AS conv_id, count(*) AS n_convs, any_value(s[d].w) AS w,
            sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(s) = d), '')) AS ends_sha256 FROM p GROUP BY node, d),
    q AS (SELECT left(node, 32 * (d - 1)) AS node, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
    m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN q USING (node)),
    u AS (SELECT left(node, 32 * a) AS node, sum((n_children = 0)::INTEGER) AS n_leaves, sum((n_convs - 1) * coalesce(w, 0)) AS saved_tokens FROM (SELECT *, unnest(range(d + 1)) AS a FROM m) GROUP BY 1)
    SELECT m.conv_id, m.d AS depth, up.conv_id AS parent_conv_id, m.n_convs, m.n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, m.ends_sha256
    FROM m JOIN u USING (node) LEFT JOIN m up ON m.d > 0 AND up.node = left(m.node, 32 * (m.d - 1))
"""


ORACLES: dict[str, str] = {
    "op10_line_dedup": rf"""
        WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l, row_number() OVER () AS rid FROM documents),
        h AS (SELECT doc_id, rid, list_transform(l, lambda x: md5(x)) AS h, l FROM d),
        p0 AS (SELECT doc_id, rid, h, l, unnest(range(len(h) - 1)) AS pos FROM h WHERE len(h) > 1),
        p1 AS (SELECT doc_id, rid, pos, {_SEEDED.format(text="h[pos + 1] || h[pos + 2]")} AS item, len(regexp_extract_all(l[pos + 1], '[^\x20\x09-\x0D]+')) AS w, len(regexp_extract_all(l[pos + 2], '[^\x20\x09-\x0D]+')) AS v FROM p0),
        p2 AS (SELECT * FROM p1 QUALIFY count(*) OVER (PARTITION BY item) > 1),
        run AS (SELECT *, pos - row_number() OVER (PARTITION BY rid ORDER BY pos) AS run FROM p2),
        edge AS (SELECT *, coalesce(item > lag(item) OVER w AND item >= lead(item) OVER w, false) AS edge FROM run WINDOW w AS (PARTITION BY rid, run ORDER BY pos)),
        part AS (SELECT *, pos - row_number() OVER (PARTITION BY rid ORDER BY pos) AS part FROM edge WHERE NOT edge),
        c0 AS (SELECT rid, any_value(doc_id) AS doc_id, min(pos) AS start, count(*) + 1 AS n, list(item ORDER BY pos) AS chunk FROM part GROUP BY rid, part HAVING sum(w) + arg_max(v, pos) >= 10),
        c1 AS (SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY doc_id NULLS LAST, rid, start) AS r FROM c0),
        g0 AS (SELECT rid, unnest(range(start, start + n)) AS pos FROM c1 WHERE r > 1),
        p3 AS (SELECT * FROM p2 WHERE NOT EXISTS (SELECT 1 FROM g0 WHERE g0.rid = p2.rid AND g0.pos IN (p2.pos, p2.pos + 1))),
        p4 AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY doc_id NULLS LAST, rid, pos) AS r FROM p3),
        p5 AS (SELECT *, pos - row_number() OVER (PARTITION BY rid ORDER BY pos) AS stretch FROM p4 WHERE r > 1),
        p6 AS (SELECT rid, unnest(list(pos)) AS pos FROM p5 GROUP BY rid, stretch HAVING sum(w) + arg_max(v, pos) >= 10),
        g1 AS (SELECT DISTINCT rid, unnest([pos, pos + 1]) AS pos FROM p6),
        g2 AS (SELECT * FROM g0 UNION SELECT * FROM g1),
        s0 AS (SELECT doc_id, rid, unnest(range(len(l))) AS pos, unnest(l) AS line FROM h),
        s1 AS (SELECT * FROM s0 WHERE len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 50 AND NOT EXISTS (SELECT 1 FROM g2 WHERE g2.rid = s0.rid AND g2.pos = s0.pos)),
        s2 AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id NULLS LAST, rid, pos) AS r FROM s1),
        g AS (SELECT rid, list(pos ORDER BY pos) AS gone FROM (SELECT * FROM g2 UNION SELECT rid, pos FROM s2 WHERE r > 1) GROUP BY rid),
        o AS (SELECT d.doc_id, len(l) AS lines, coalesce(gone, []) AS gone,
            array_to_string(list_filter(l, lambda x, i: NOT list_contains(coalesce(gone, []), i - 1)), chr(10)) AS text, d.text IS NULL AS none FROM d LEFT JOIN g ON g.rid = d.rid)
        SELECT doc_id, CAST(coalesce(lines, 0) AS INTEGER) AS lines, CAST(coalesce(lines, 0) - len(gone) AS INTEGER) AS lines_left, array_to_string(gone, ' ') AS removed_lines,
            CASE WHEN NOT none THEN {_CRC} END AS text_crc32 FROM o, (SELECT {_CRCS})
    """,
    "op8_mixing": rf"""
        WITH d AS (
            SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS g, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
                {_SEEDED.format(text="concat_ws('|', '8', doc_id)")} AS h FROM documents),
        s AS (SELECT g, CAST(sum(size) AS BIGINT) AS s, row_number() OVER (ORDER BY g = '', g) - 1 AS i FROM d GROUP BY g),
        w AS (SELECT *, [3, 1, 2][i % 3 + 1] AS w, 2 * s / [3, 1, 2][i % 3 + 1]::DOUBLE AS full_at FROM s),
        c AS (SELECT *, coalesce(sum(s) OVER up, 0) AS s0, coalesce(sum(w) OVER up, 0) AS w0, sum(s) OVER () AS s1, sum(w) OVER () AS w1 FROM w
            WINDOW up AS (ORDER BY full_at, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        u AS (SELECT min_by((1.5 * s1 - 2 * s0)::DOUBLE / (w1 - w0), (full_at, i)) AS unit FROM c WHERE w * ((1.5 * s1 - 2 * s0)::DOUBLE / (w1 - w0)) <= 2 * s),
        t0 AS (SELECT g, s, i, CASE WHEN w * unit > 2 * s THEN CAST(2 * s AS DOUBLE) ELSE w * unit END AS target FROM w, u),
        t AS (SELECT *, (target >= 4800)::INTEGER + (target >= 76800)::INTEGER + (target >= 307200)::INTEGER AS tier FROM t0),
        b AS (SELECT tier, CAST(greatest(1, least(1024, floor(coalesce(min(target) FILTER (target > 0), 0) / 300))) AS BIGINT) AS block, sum(target) AS goal FROM t GROUP BY tier),
        q AS (SELECT g, tier, row_number() OVER (PARTITION BY tier ORDER BY target / (2 * seat + 1) DESC, i, seat) AS place FROM (
            SELECT g, i, tier, target, unnest(range(CAST(ceil(2 * s / block::DOUBLE) AS BIGINT))) AS seat FROM t JOIN b USING (tier) WHERE target > 0)),
        k AS (SELECT g, count(*) AS seats FROM q JOIN b USING (tier) WHERE place <= round_even(goal / block, 0) GROUP BY g),
        r AS (SELECT t.*, block, coalesce(seats, 0) AS seats, greatest(1, CAST(ceil(s / block::DOUBLE) AS BIGINT)) AS ring FROM t JOIN b USING (tier) LEFT JOIN k USING (g)),
        p AS (SELECT *, {_SEEDED.format(text="'8|' || g")} % ring AS start, {_SEEDED.format(text="'9|' || g")} % ring AS turn0 FROM r),
        x AS (SELECT * EXCLUDE turn0, list_filter(range(turn0, turn0 + 1000), lambda n: gcd(n, ring) = 1)[1] AS turn FROM p),
        o AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY g ORDER BY h % (SELECT CAST(greatest(1, least(1048576, ceil(count(*) / 500.0))) AS BIGINT) FROM d), h, size, doc_id NULLS FIRST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, row_number() OVER () AS id FROM d),
        e AS (SELECT o.*, x.*, unnest(CASE WHEN size > 0 THEN range(CAST(before // block AS BIGINT), CAST((before + size - 1) // block + 1 AS BIGINT)) ELSE [NULL] END) AS n FROM o JOIN x ON o.g = x.g),
        f AS (SELECT *, ((CAST(n AS HUGEINT) - start) * turn % ring + ring) % ring AS seat FROM e)
        SELECT any_value(doc_id) AS doc_id, any_value(size) AS size, any_value(s) AS source_size, any_value(target) AS target,
            CAST(coalesce(sum(((seat < seats)::INTEGER + (seat + ring < seats)::INTEGER) * (least((n + 1) * block, before + size) - greatest(n * block, before))), 0) AS BIGINT) AS taken
        FROM f GROUP BY id
    """,
    "op7_sharding": f"""
        WITH d AS (
            SELECT doc_id, source, coalesce(strlen(text), 0) + 1 AS size, coalesce({_CRC}, 0) AS text_crc32, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS g
            FROM documents, (SELECT {_CRCS})),
        h AS (SELECT *, {_SEEDED.format(text="concat_ws('|', '20', doc_id, text_crc32, size)")} AS h, {_SEEDED.format(text="'21|' || g")} % 1048576 / 1048576.0::DOUBLE AS start,
            (SELECT CAST(greatest(1, least(1048576, ceil(count(*) / 500.0))) AS BIGINT) FROM d) AS parts, (SELECT count(*) FROM d) AS total FROM d),
        r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY h % parts, h, doc_id NULLS FIRST, text_crc32, size) AS rank, count(*) OVER (PARTITION BY g) AS n FROM h),
        f AS (SELECT *, (CAST(rank - 1 AS DOUBLE) + start) / n AS f FROM r),
        p AS (SELECT *, row_number() OVER (ORDER BY least(floor(f * parts), parts - 1), f, g, rank) - 1 AS place, total // 16 AS small, total % 16 AS longer FROM f),
        s AS (SELECT *, CASE WHEN place < longer * (small + 1) THEN place // (small + 1) ELSE longer + (place - longer * (small + 1)) // greatest(small, 1) END AS shard FROM p)
        SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'rows' AS law, CAST(shard AS INTEGER) AS shard,
            CASE WHEN place < longer * (small + 1) THEN place % (small + 1) ELSE (place - longer * (small + 1)) % greatest(small, 1) END AS slot, CAST(NULL AS INTEGER) AS grown_shard, source FROM s
    """,
    "op3_licenses": _licenses_sql(),
    "op11_codes": _codes_sql(),
    "op12_prefix_trie": _TRIE,
    "op6_exact_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(256 * CAST(x AS DOUBLE)))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
        )
        SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5
    """,
}
