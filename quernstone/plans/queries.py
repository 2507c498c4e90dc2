"""Queries of the core operators over the driver's tables, each with SQL that gives the same rows."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions import text as tx
from quernstone.operators import cleaning, finish, header, sentences, serving, similarity, structure
from quernstone.plans.pipeline import run_pipeline
from quernstone.sources import tables
from quernstone.sources.tables import table

#: Thresholds at which the test vectors have neighbours; the engine's defaults are those of Settings.
PAIRS, ASSIST, HEAD_DOCUMENTS = 0.40, 0.30, 8


# SQL of shared expressions. DuckDB has no NFKC: characters that stand for one other are translated, the rest replaced.
def nfkc_sql(x: str) -> str:
    single, several = [], []
    for cp in (*range(0xA0, 0xD800), *range(0xF900, 0xFFFE)):
        c = chr(cp)
        k = unicodedata.normalize("NFKC", c)
        if k != unicodedata.normalize("NFC", c):
            if len(k) == 1 and k not in "'":
                single.append((c, k))
            elif cp in (0xE33, 0xEB3, 0x2025, 0x2026, 0x2116) or 0x2160 <= cp <= 0x217F or 0xFB00 <= cp <= 0xFB06 or 0xBC <= cp <= 0xBE:
                several.append((c, k))
    x = f"translate({x}, '{''.join(a for a, _ in single)}', '{''.join(b for _, b in single)}')"
    for a, b in several:
        x = f"replace({x}, '{a}', '{b}')"
    return f"nfc_normalize({x})"


def _strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^[{tx.WS}]+|[{tx.WS}]+$', '', 'g')"


def _squeeze_sql(x: str) -> str:
    return f"regexp_replace({_strip_sql(x)}, '[{tx.WS}]+', ' ', 'g')"


def _lines_sql(x: str) -> str:
    parts = f"string_split_regex({x}, '{tx.LINE_ENDS}')"
    return f"(SELECT CASE WHEN p[-1] = '' THEN p[:-2] ELSE p END FROM (SELECT {parts} AS p))"


def _complete_sql(x: str) -> str:
    return (
        f"CASE WHEN length({x}) < 10 THEN 0 WHEN contains('.;:?!)]”\"''»', right({x}, 1)) THEN 1 "
        f"WHEN regexp_matches({x}, '(^|[^\\p{{L}}\\p{{N}}_])(Điều|Khoản|Mục)[{tx.WS}]+\\p{{Nd}}+(\\.|:)') THEN 1 "
        f"WHEN contains({x}, '...') OR contains({x}, '… ') THEN 0 WHEN length({x}) > 30 THEN 1 ELSE 0 END"
    )


def _quality_sql(x: str, error: str) -> str:
    odd = tx.ODD.replace("'", "''")
    return (
        f"CASE WHEN length({_strip_sql(x)}) < 5 THEN 0.6::DOUBLE ELSE greatest(0::DOUBLE, least(1::DOUBLE, 0.95::DOUBLE - CASE WHEN {error} THEN 0.25::DOUBLE ELSE 0::DOUBLE END"
        f" - 0.2::DOUBLE * least(len(regexp_extract_all({x}, '{odd}'))::DOUBLE / greatest(length({x}), 1), 0.05::DOUBLE))) END"
    )


def _sentences_sql(source: str) -> str:
    """CTEs raw and sentences over a relation (id, text and more)."""
    marked = f"regexp_replace(replace(text, '\r\n', '\n'), '([.?!…])[{tx.WS}]+|\n{{2,}}', '\\1' || chr(1), 'g')"
    parts = f"list_filter(list_transform(string_split({marked}, chr(1)), lambda x: {_strip_sql('x')}), lambda x: x <> '')"
    return f"raw AS (SELECT *, {parts} AS parts FROM {source} WHERE text <> ''), sentences_of AS (SELECT * EXCLUDE (parts, raw_text, text), {_squeeze_sql(nfkc_sql('raw_text'))} AS text FROM (SELECT * EXCLUDE (k), parts[k] AS raw_text, k - 1 AS sentence_index FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS k FROM raw)))"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


@_query("SELECT name, min(id) AS document_id FROM (SELECT coalesce(meta_filename, filename) AS name, id FROM source_docs) WHERE name IS NOT NULL GROUP BY name")
def document_lookup(spark, d):
    return tables.document_names(table(spark, d, "source_docs"))


@_query('SELECT id, document_id, row_number() OVER (PARTITION BY document_id ORDER BY page ASC NULLS LAST, "offset" ASC NULLS LAST, id ASC NULLS LAST) - 1 AS pos FROM chunks')
def ordered_chunk_scan(spark, d):
    return tables.chunk_scan(table(spark, d, "chunks").select("id", "document_id", "page", "offset")).select("id", "document_id", "pos")


_BOX = [f"TRY_CAST(m ->> '$.bbox[{i}]' AS DOUBLE)" for i in range(4)]
_BOX_OK = "json_type(m, '$.bbox') = 'ARRAY' AND json_array_length(m, '$.bbox') = 4 AND " + " AND ".join(f"{b} IS NOT NULL" for b in _BOX)


@_query(
    "WITH j AS (SELECT id, CASE WHEN json_valid(metadata) THEN metadata::JSON END AS m FROM chunks) SELECT id, "
    "CASE WHEN json_type(m, '$.type') = 'VARCHAR' AND (m ->> '$.type') IN ('text', 'table', 'list', 'other') THEN m ->> '$.type' ELSE 'text' END AS chunk_type, "
    "CASE WHEN json_type(m, '$.continues_flag') IS NULL OR json_type(m, '$.continues_flag') = 'NULL' THEN NULL WHEN json_type(m, '$.continues_flag') = 'BOOLEAN' THEN (m ->> '$.continues_flag') = 'true' "
    "WHEN json_type(m, '$.continues_flag') = 'VARCHAR' THEN length(m ->> '$.continues_flag') > 0 WHEN json_type(m, '$.continues_flag') = 'ARRAY' THEN json_array_length(m, '$.continues_flag') > 0 "
    "WHEN json_type(m, '$.continues_flag') = 'OBJECT' THEN (m ->> '$.continues_flag') <> '{}' ELSE TRY_CAST(m ->> '$.continues_flag' AS DOUBLE) <> 0 END AS continues, "
    + ", ".join(f"CASE WHEN {_BOX_OK} THEN {b} END AS {c}" for b, c in zip(_BOX, ("x0", "y0", "x1", "y1")))
    + " FROM j"
)
def metadata_decode(spark, d):
    return tables.decode_metadata(table(spark, d, "chunks").select("id", "metadata")).select("id", "chunk_type", "continues", "x0", "y0", "x1", "y1")


_GATE = "(page IS NULL OR page <= 2 OR coalesce(\"offset\" <= 200, false)) AND length(coalesce(text, '')) > 0"


@_query(f"SELECT id, {_GATE} AS is_candidate FROM chunks")
def header_gate(spark, d):
    return table(spark, d, "chunks").select("id", header.is_candidate(F.col("text"), F.col("page"), F.col("offset")).alias("is_candidate"))


@_query(f"SELECT id, array_to_string(list_transform({_lines_sql('substr(text, 1, 1200)')}[1:10], lambda x, i: '[' || (i - 1) || '] ' || x), chr(10)) AS head FROM chunks WHERE {_GATE}")
def header_head(spark, d):
    c = table(spark, d, "chunks")
    return c.where(header.is_candidate(F.col("text"), F.col("page"), F.col("offset"))).select("id", header.numbered_head(F.col("text")).alias("head"))


@_query(
    f"WITH heads AS (SELECT id, document_id, unnest(l) AS line, unnest(range(0, len(l))) AS line_no FROM (SELECT id, document_id, {_lines_sql('substr(text, 1, 1200)')}[1:10] AS l FROM chunks WHERE {_GATE})), "
    f"known AS (SELECT line FROM heads WHERE length(line) > 0 GROUP BY line HAVING count(DISTINCT document_id) >= {HEAD_DOCUMENTS}), "
    "stops AS (SELECT h.id, coalesce(min(CASE WHEN k.line IS NULL THEN h.line_no END), count(*)) AS n FROM heads h LEFT JOIN known k ON h.line = k.line GROUP BY h.id) "
    f"SELECT c.id, coalesce(s.n, 0)::BIGINT AS header_removed, CASE WHEN coalesce(s.n, 0) > 0 THEN array_to_string({_lines_sql('c.text')}[s.n + 1:], chr(10)) ELSE c.text END AS text FROM chunks c LEFT JOIN stops s ON c.id = s.id"
)
def header_strip(spark, d):
    c = table(spark, d, "chunks").select("id", "document_id", "page", "offset", "text")
    return header.strip_headers(c, header.recurring_heads(c, HEAD_DOCUMENTS)).select("id", F.col("header_removed").cast("bigint").alias("header_removed"), "text")


@_query(f"WITH {_sentences_sql('(SELECT id, text FROM chunks)')} SELECT id AS chunk_id, sentence_index::BIGINT AS sentence_index, id || '#s' || sentence_index AS sentence_id, text FROM sentences_of")
def sentence_split(spark, d):
    rows = sentences.sentence_rows(table(spark, d, "chunks"), keep=())
    return rows.select("chunk_id", F.col("sentence_index").cast("bigint").alias("sentence_index"), "sentence_id", "text")


@_query(f"SELECT id, ({_complete_sql(_strip_sql(chr(99)))})::BIGINT AS complete FROM (SELECT id, coalesce(text, '') AS c FROM sentences)")
def completeness(spark, d):
    return sentences.classify(table(spark, d, "sentences").select("id", "text")).select("id", F.col("complete").cast("bigint").alias("complete"))


_SPANS = "SELECT id, length(text) AS n, unnest(range(0, 5)) AS i FROM chunks WHERE length(text) > 0"


@_query(
    f"WITH s AS (SELECT id, n, i, (i * 37 + n * 11) % (n + 9) - 3 AS s, (i * 53 + n * 7) % (n + 20) - 2 AS e FROM ({_SPANS})), ok AS (SELECT id, n, i, s, least(e, n) AS e FROM s WHERE s >= 0 AND e >= 0 AND s < least(e, n)), "
    "placed AS (SELECT *, coalesce(max(e) OVER (PARTITION BY id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev FROM ok), "
    'parts AS (SELECT id, prev AS s, s AS e FROM placed WHERE e > prev AND s > prev UNION ALL SELECT id, greatest(s, prev), e FROM placed WHERE e > prev UNION ALL SELECT a.id, coalesce(max(o.e), 0), a.n FROM (SELECT DISTINCT id, n FROM s) a LEFT JOIN ok o ON a.id = o.id GROUP BY a.id, a.n HAVING coalesce(max(o.e), 0) < a.n) SELECT id, s::BIGINT AS "start", e::BIGINT AS "end" FROM parts'
)
def span_repair(spark, d):
    n = F.length("text").cast("bigint")
    rows = table(spark, d, "chunks").where(F.length("text") > 0).select("id", n.alias("n"), F.explode(F.sequence(F.lit(0), F.lit(4))).alias("i"))
    spans = rows.select("id", "n", "i", F.expr("(i * 37 + n * 11) % (n + 9) - 3").alias("start"), F.expr("(i * 53 + n * 7) % (n + 20) - 2").alias("end"))
    return sentences.repair_spans(spans, "id").select("id", F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"))


_POS = 'row_number() OVER (PARTITION BY document_id ORDER BY page ASC NULLS LAST, "offset" ASC NULLS LAST, id ASC NULLS LAST) - 1'
_NORM = _squeeze_sql(nfkc_sql("coalesce(text, '')"))


@_query(
    f"WITH t AS (SELECT id, document_id, page, {_POS} AS pos, sha1({_NORM}) AS text_sha1 FROM chunks) "
    "SELECT id, document_id, text_sha1, copies FROM (SELECT *, row_number() OVER (PARTITION BY document_id, page, text_sha1 ORDER BY pos) AS k, count(*) OVER (PARTITION BY document_id, page, text_sha1) AS copies FROM t) WHERE k = 1"
)
def dedupe_chunks(spark, d):
    return finish.dedupe(tables.chunk_scan(table(spark, d, "chunks"))).select("id", "document_id", "text_sha1", "copies")


@_query(f"SELECT chunk_id, run_ts, round({_quality_sql('t', 'error')}, 9) AS quality_score FROM (SELECT chunk_id, run_ts, coalesce(clean_text, '') AS t, coalesce(json_valid(flags) AND (flags::JSON ->> '$.error') = 'true', false) AS error FROM cleaned_chunks)")
def quality_score(spark, d):
    error = F.coalesce(F.get_json_object("flags", "$.error") == "true", F.lit(False))
    return table(spark, d, "cleaned_chunks").select("chunk_id", "run_ts", F.round(finish.quality_score(F.col("clean_text"), error), 9).alias("quality_score"))


_OPS = "(" + ", ".join(f"'{o}'" for o in finish.ALLOWED_OPS) + ")"


@_query(f"SELECT chunk_id, run_ts, array_to_string(list_sort(list_distinct(list_filter(list_transform(list_filter(coalesce(ops, []), lambda x: x IS NOT NULL AND x <> ''), lambda x: replace(lower({_strip_sql('x')}), ' ', '_')), lambda x: x IN {_OPS}))), ',') AS ops FROM cleaned_chunks")
def ops_normalize(spark, d):
    return table(spark, d, "cleaned_chunks").select("chunk_id", "run_ts", F.array_join(finish.normalize_ops(F.col("ops")), ",").alias("ops"))


@_query("SELECT chunk_id, run_ts, coalesce(json_valid(flags) AND (flags::JSON ->> '$.continues') = 'true', false) AS continues, coalesce(json_valid(flags) AND (flags::JSON ->> '$.error') = 'true', false) AS error FROM cleaned_chunks")
def flags_default(spark, d):
    flags = finish.default_flags(F.map_filter(F.from_json("flags", "map<string,boolean>"), lambda _, v: v.isNotNull()))
    return table(spark, d, "cleaned_chunks").select("chunk_id", "run_ts", flags.alias("f")).select("chunk_id", "run_ts", F.col("f")["continues"].alias("continues"), F.col("f")["error"].alias("error"))


def _vectors(spark, d) -> DataFrame:
    return table(spark, d, "embeddings").select(F.lit("e").alias("document_id"), F.col("vec_id").alias("pos"), "embedding")


def _knn_sql(source: str, k: int) -> str:
    v = "list_transform(embedding, lambda x: x::DOUBLE)"
    return f"v AS (SELECT {'vec_id' if source == 'embeddings' else 'pos'} AS pos, {v} AS e FROM {source}), knn AS (SELECT i, j, s, rank FROM (SELECT a.pos AS i, b.pos AS j, list_inner_product(a.e, b.e) AS s, row_number() OVER (PARTITION BY a.pos ORDER BY list_inner_product(a.e, b.e) DESC, b.pos) AS rank FROM v a, v b) WHERE rank <= {k})"


@_query(f"WITH {_knn_sql('embeddings', 20)} SELECT i, j, round(s, 6) AS similarity, rank FROM knn")
def knn_top20(spark, d):
    return similarity.nearest(_vectors(spark, d), 20).select("i", "j", F.round("similarity", 6).alias("similarity"), F.col("rank").cast("bigint").alias("rank"))


@_query(f"WITH {_knn_sql('embeddings', 20)} SELECT i, j, round(s, 6) AS similarity FROM knn WHERE i <> j AND s >= {PAIRS}")
def similar_pairs(spark, d):
    return similarity.similar_edges(_vectors(spark, d), PAIRS).select("i", "j", F.round("similarity", 6).alias("similarity"))


_GROUPS = f"{_knn_sql('embeddings', 20)}, edges AS (SELECT i, j FROM knn WHERE i <> j AND s >= {PAIRS} UNION SELECT j, i FROM knn WHERE i <> j AND s >= {PAIRS}), reach(i, j) AS (SELECT pos, pos FROM v UNION SELECT r.i, e.j FROM reach r JOIN edges e ON r.j = e.i), roots AS (SELECT i AS pos, min(j) AS root FROM reach GROUP BY i)"


@_query(f"WITH RECURSIVE {_GROUPS} SELECT pos AS vec_id, root FROM roots")
def variant_groups(spark, d):
    return similarity.group_variants(_vectors(spark, d), PAIRS).select(F.col("pos").alias("vec_id"), "root")


@_query(f"WITH RECURSIVE {_GROUPS}, m AS (SELECT r.pos, r.root, coalesce(t.text, '') AS text FROM roots r LEFT JOIN documents t ON t.doc_id = r.pos) SELECT 'cg-' || root AS content_id, count(*) AS variants, arg_max(pos, length(text)::BIGINT * 1000000000 - pos) AS canonical_vec FROM m GROUP BY root")
def canonical_pick(spark, d):
    grouped = similarity.group_variants(_vectors(spark, d), PAIRS)
    members = grouped.join(table(spark, d, "documents").select(F.col("doc_id").alias("_id"), "text"), grouped["pos"] == F.col("_id"), "left").select("document_id", "pos", "root", "text")
    return similarity.canonical_members(members).select("content_id", "variants", F.col("canonical_pos").alias("canonical_vec"))


@_query(f"WITH RECURSIVE {_GROUPS}, reps AS (SELECT v.pos, v.e FROM v JOIN (SELECT DISTINCT root FROM roots) r ON v.pos = r.root), near AS (SELECT a.pos AS i, b.pos AS j, list_inner_product(a.e, b.e) AS s, row_number() OVER (PARTITION BY a.pos ORDER BY list_inner_product(a.e, b.e) DESC, b.pos) AS rank FROM reps a, reps b) SELECT i, j, rank, round(s, 6) AS similarity FROM near WHERE rank <= 6 AND i <> j AND s >= {ASSIST}")
def merge_candidates(spark, d):
    reps = similarity.group_variants(_vectors(spark, d), PAIRS).where("pos = root").select("document_id", "pos", "embedding")
    return similarity.merge_candidates(reps, ASSIST).select("i", "j", F.col("rank").cast("bigint").alias("rank"), F.round("similarity", 6).alias("similarity"))


@_query(
    f"WITH RECURSIVE {_GROUPS}, reps AS (SELECT v.pos, v.e FROM v JOIN (SELECT DISTINCT root FROM roots) r ON v.pos = r.root), near AS (SELECT a.pos AS i, b.pos AS j, list_inner_product(a.e, b.e) AS s, row_number() OVER (PARTITION BY a.pos ORDER BY list_inner_product(a.e, b.e) DESC, b.pos) AS rank FROM reps a, reps b), "
    f"confirmed AS MATERIALIZED (SELECT i, j, row_number() OVER (ORDER BY i, rank, j) AS k FROM near WHERE rank <= 6 AND i <> j AND s >= {ASSIST}), "
    "fold AS (SELECT 0::BIGINT AS k, []::BIGINT[] AS gone, NULL::BIGINT AS absorbed, NULL::BIGINT AS \"into\" UNION ALL SELECT c.k, CASE WHEN list_contains(f.gone, c.i) OR list_contains(f.gone, c.j) THEN f.gone ELSE list_append(f.gone, c.j) END, CASE WHEN NOT list_contains(f.gone, c.i) AND NOT list_contains(f.gone, c.j) THEN c.j END, CASE WHEN NOT list_contains(f.gone, c.i) AND NOT list_contains(f.gone, c.j) THEN c.i END FROM fold f JOIN confirmed c ON c.k = f.k + 1) "
    'SELECT absorbed, "into" FROM fold WHERE absorbed IS NOT NULL'
)
def greedy_absorb(spark, d):
    reps = similarity.group_variants(_vectors(spark, d), PAIRS).where("pos = root").select("document_id", "pos", "embedding")
    return similarity.greedy_absorb(similarity.merge_candidates(reps, ASSIST).select("document_id", "i", "j", "rank")).select("absorbed", "into")


_VARIANTS = "variants_of AS (SELECT v.content_id, v.variant_pos, v.sentence_id, v.is_canonical, s.text FROM content_variants v LEFT JOIN sentences s ON s.id = v.sentence_id)"


def _variants(spark, d) -> DataFrame:
    s = table(spark, d, "sentences").select(F.col("id").alias("_id"), "text", "document_id", "page", "offset")
    v = table(spark, d, "content_variants")
    return v.join(s, v["sentence_id"] == s["_id"], "left").drop("_id")


@_query(f"WITH {_VARIANTS}, own AS (SELECT content_id, max(length(coalesce(text, ''))) AS n FROM variants_of WHERE is_canonical GROUP BY content_id) SELECT v.content_id, v.variant_pos, v.sentence_id FROM variants_of v LEFT JOIN own o ON v.content_id = o.content_id WHERE o.n IS NULL OR v.is_canonical OR length(coalesce(v.text, '')) >= greatest(20, floor(o.n * 0.5))")
def short_variant_filter(spark, d):
    return similarity.keep_long_variants(_variants(spark, d)).select("content_id", "variant_pos", "sentence_id")


@_query(f"WITH {_VARIANTS} SELECT content_id, max(CASE WHEN is_canonical THEN text END) AS canonical_text, count(*) AS variant_count, 0.0::DOUBLE AS coverage FROM variants_of GROUP BY content_id")
def group_summary(spark, d):
    return similarity.group_summary(_variants(spark, d))


@_query(f"WITH {_VARIANTS} SELECT content_id, sentence_id, text, 'canonicalize_from_variants' AS op, 0.8::DOUBLE AS text_clean_quality, false AS continues FROM variants_of WHERE is_canonical")
def prepare_canonical(spark, d):
    rows = finish.clean_offline(finish.canonical_rows(_variants(spark, d)))
    return rows.select("content_id", "sentence_id", "text", F.col("ops")[0].alias("op"), "text_clean_quality", "continues")


# Lines of a chunk as groups of a document: lists and wrapped lines are there.
_LINES = f"lines_of AS (SELECT id, pos, text, {_strip_sql('text')} AS t FROM (SELECT id, unnest(l) AS text, unnest(range(0, len(l))) AS pos FROM (SELECT id, string_split(text, chr(10)) AS l FROM chunks WHERE text IS NOT NULL)))"


def _line_rows(spark, d) -> DataFrame:
    return table(spark, d, "chunks").where("text is not null").select("id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "text"))


_FLAT = (
    f"marked AS (SELECT *, regexp_matches(t, '{structure.ITEM}') AS item, ends_with(t, ':') AS colon, sum(CASE WHEN regexp_matches(t, '{structure.ITEM}') THEN 0 ELSE 1 END) OVER (PARTITION BY id ORDER BY pos) AS island FROM lines_of), "
    "runs AS (SELECT *, sum(item::INT) OVER (PARTITION BY id, island) - sum(item::INT) OVER (PARTITION BY id, island ORDER BY pos) AS rest FROM marked), "
    "heads AS (SELECT id, island, min(pos) AS head FROM runs WHERE colon AND rest >= 2 GROUP BY id, island), "
    f"flat AS (SELECT r.id, h.head AS pos, string_agg(lower(substr(r.t, 1, 1)) || ')' || {_strip_sql('substr(r.text, 4)')}, ', ' ORDER BY r.pos) AS list FROM runs r JOIN heads h ON r.id = h.id AND r.island = h.island WHERE r.item AND r.pos > h.head GROUP BY r.id, h.head)"
)


@_query(f"WITH {_LINES}, {_FLAT} SELECT f.id, f.pos, l.t || ' ' || f.list AS text, true AS is_flat FROM flat f JOIN lines_of l ON l.id = f.id AND l.pos = f.pos UNION ALL SELECT id, pos, text, false FROM lines_of")
def list_flatten(spark, d):
    return structure.flatten_lists(_line_rows(spark, d), "id").select("id", F.col("pos").cast("bigint").alias("pos"), "text", "is_flat")


_APART = f"(regexp_matches(t, '\\p{{Lu}}') AND t = upper(t) AND length(t) < 32 AND NOT regexp_matches(t, '[\\p{{Ll}}\\p{{Lt}}ªº]')) OR regexp_matches(lower(t), '^(chương|điều|mục|section)[{tx.WS}]+\\p{{Nd}}+') OR regexp_matches(t, '^\\p{{Nd}}+[.)]') OR regexp_matches(t, '^[a-zA-Z]\\)[{tx.WS}]+') OR length(t) < 8"
_FINAL_SQL = tx.FINAL.replace("'", "''")


@_query(
    f"WITH RECURSIVE {_LINES}, x AS (SELECT id, pos, t, length(t) AS n, regexp_matches(t, '{_FINAL_SQL}') AS final, {_APART} AS apart FROM lines_of), "
    "y AS (SELECT *, lead(t) OVER w AS t1, lead(n) OVER w AS n1, lead(final) OVER w AS final1, lead(apart) OVER w AS apart1, lead(t, 2) OVER w AS t2, lead(n, 2) OVER w AS n2, lead(apart, 2) OVER w AS apart2 FROM x WINDOW w AS (PARTITION BY id ORDER BY pos)), "
    "z AS (SELECT *, CASE WHEN t1 IS NOT NULL AND NOT final AND NOT apart1 AND n + n1 <= 512 THEN CASE WHEN t2 IS NOT NULL AND NOT final1 AND NOT apart2 AND n + 1 + n1 + n2 <= 512 THEN 3 ELSE 2 END ELSE 1 END AS reach FROM y), "
    "walk AS (SELECT id, pos, reach FROM z WHERE pos = 0 UNION ALL SELECT z.id, z.pos, z.reach FROM walk w JOIN z ON z.id = w.id AND z.pos = w.pos + w.reach) "
    "SELECT w.id, w.pos, CASE WHEN w.reach = 3 THEN t || ' ' || t1 || ' ' || t2 WHEN w.reach = 2 THEN t || ' ' || t1 ELSE t END AS text, w.reach::BIGINT AS merged FROM walk w JOIN z ON z.id = w.id AND z.pos = w.pos"
)
def stitch_fragments(spark, d):
    rows = _line_rows(spark, d).withColumn("is_flat", F.lit(False))
    return structure.stitch(rows, "id").select("id", F.col("pos").cast("bigint").alias("pos"), "text", F.col("merged").cast("bigint").alias("merged"))


_ERRORS = "(429, NULL, 0, 1), (NULL, 'resource_exhausted', 1, 2), (503, NULL, 2, 2), (400, NULL, 3, 2), (404, NULL, 1, 2), (500, NULL, 2, 3), (403, NULL, 5, 2), (400, 'UNAVAILABLE', 1, 2), (NULL, NULL, 2, 2), (504, 'TRY_AGAIN_LATER', 3, 1)"
_CLASS = (
    "CASE WHEN code = 429 OR upper(status) IN ('RESOURCE_EXHAUSTED', 'RATE_LIMIT_EXCEEDED') THEN 'RATE_LIMIT' WHEN code = 503 OR upper(status) IN ('UNAVAILABLE', 'TRY_AGAIN_LATER') THEN 'UNAVAILABLE' "
    "WHEN code = 400 OR upper(status) = 'INVALID_ARGUMENT' THEN 'BAD_REQUEST' WHEN code = 404 OR upper(status) = 'NOT_FOUND' THEN 'NOT_FOUND' WHEN code >= 500 AND code < 600 THEN 'SERVER_ERROR' WHEN code >= 400 AND code < 500 THEN 'CLIENT_ERROR' ELSE 'UNKNOWN' END"
)


def _errors(spark) -> DataFrame:
    return spark.sql(f"SELECT cast(code AS int) AS code, cast(status AS string) AS status, attempt, models FROM VALUES {_ERRORS} AS t(code, status, attempt, models)")


@_query(f"SELECT code, status, {_CLASS} AS error_class FROM (VALUES {_ERRORS}) AS t(code, status, attempt, models)")
def error_classify(spark, d):
    return _errors(spark).select("code", "status", serving.error_class(F.col("code"), F.col("status")).alias("error_class"))


@_query(
    f"SELECT code, status, attempt, models, round(CASE WHEN k IN ('BAD_REQUEST', 'NOT_FOUND') THEN least(b, 0.8) ELSE b END, 6) AS seconds, (models > 1 AND ((k IN ('RATE_LIMIT', 'UNAVAILABLE') AND attempt % 2 = 1) OR (k IN ('SERVER_ERROR', 'UNKNOWN', 'CLIENT_ERROR') AND attempt % 3 = 2))) AS switches "
    f"FROM (SELECT *, pow(CASE WHEN k = 'UNAVAILABLE' THEN 2.0 ELSE 1.5 END, attempt) AS b FROM (SELECT *, {_CLASS} AS k FROM (VALUES {_ERRORS}) AS t(code, status, attempt, models)))"
)
def backoff_schedule(spark, d):
    rows = _errors(spark).withColumn("k", serving.error_class(F.col("code"), F.col("status")))
    return rows.select("code", "status", "attempt", "models", F.round(serving.backoff_seconds(F.col("k"), F.col("attempt")), 6).alias("seconds"), serving.switches_model(F.col("k"), F.col("attempt"), F.col("models")).alias("switches"))


@_query("SELECT * FROM (VALUES ('3s', 3.0::DOUBLE), ('250ms', 0.25::DOUBLE), ('7', 7.0::DOUBLE), (' 1.5S ', 1.5::DOUBLE), ('{\"seconds\": 3, \"nanos\": 200000000}', 3.2::DOUBLE), ('{\"nanos\": 500000000}', 0.5::DOUBLE), ('soon', NULL), ('', NULL), (NULL, NULL)) AS t(hint, seconds)")
def retry_delay_parse(spark, d):
    rows = spark.sql("SELECT cast(hint AS string) AS hint FROM VALUES ('3s'), ('250ms'), ('7'), (' 1.5S '), ('{\"seconds\": 3, \"nanos\": 200000000}'), ('{\"nanos\": 500000000}'), ('soon'), (''), (NULL) AS t(hint)")
    return rows.select("hint", F.round(serving.retry_delay(F.col("hint")), 6).alias("seconds"))


# Replies of a cleaning model: (answered, block_reason, candidates, finish_reason, text, parts), and what becomes of the text 'raw'.
_REPLIES = [
    ("TRUE, NULL, 1, 'STOP', '{\"clean_text\": \"clean\", \"ops\": [\"merge_lines\", null, 7], \"flags\": {\"continues\": true, \"odd\": true}}', NULL", "clean", "merge_lines,7", "true", "none", 0.9),
    ("TRUE, NULL, 1, 'STOP', NULL, ARRAY('{\"clean_text\": \"\", ', '\"ops\": [], \"flags\": {}}')", "", "", "none", "none", 0.6),
    ("TRUE, NULL, 1, NULL, '{\"ops\": \"fix_bullets\", \"flags\": [1]}', NULL", "raw", "fix_bullets", "none", "true", 0.9),
    ("TRUE, 'SAFETY', 1, 'STOP', '{}', NULL", "raw", "safety_blocked", "none", "true", 0.72),
    ("TRUE, NULL, 0, NULL, NULL, NULL", "raw", "empty_candidate", "none", "true", 0.7),
    ("TRUE, NULL, 1, 'max_tokens', '{}', NULL", "raw", "max_tokens_truncated", "none", "true", 0.72),
    ("TRUE, NULL, 1, 'RECITATION', '{}', NULL", "raw", "finish_recitation", "none", "true", 0.72),
    ("TRUE, NULL, 1, 'STOP', '', NULL", "raw", "empty_candidate", "none", "true", 0.7),
    ("TRUE, NULL, 1, 'STOP', 'not json', NULL", "raw", "client_error", "none", "true", 0.7),
    ("FALSE, NULL, NULL, NULL, NULL, NULL", "raw", "quota_fallback", "none", "true", 0.75),
    ("NULL, NULL, NULL, NULL, NULL, NULL", "raw", "fallback_passthrough", "none", "true", 0.0),
]


@_query("SELECT * FROM (VALUES " + ", ".join(f"({i}, '{text}', '{ops}', '{cont}', '{err}', {q}::DOUBLE)" for i, (_, text, ops, cont, err, q) in enumerate(_REPLIES)) + ") AS t(n, clean_text, ops, continues, error, quality)")
def clean_outcomes(spark, d):
    """The outcome of each kind of reply; the last row has none."""
    rows = spark.sql("SELECT n, struct(answered, block_reason, candidates, finish_reason, text, parts) AS reply FROM VALUES " + ", ".join(f"({i}, {r})" for i, (r, *_) in enumerate(_REPLIES)) + " AS t(n, answered, block_reason, candidates, finish_reason, text, parts)")
    reply = F.when(F.col("reply.answered").isNotNull(), F.col("reply").cast(cleaning.REPLY))
    out = rows.select("n", cleaning.outcome(reply, F.lit("raw")).alias("o"))
    flag = lambda name: F.coalesce(F.col("o.flags")[name].cast("string"), F.lit("none"))
    return out.select("n", "o.clean_text", F.array_join("o.ops", ",").alias("ops"), flag("continues").alias("continues"), flag("error").alias("error"), "o.quality")


@_query(
    f"WITH parts AS (SELECT id, text, length(text) AS n, unnest(range(0, greatest(1, (length(text) + 39) // 40))) AS i FROM chunks WHERE length(text) > 0), cut AS (SELECT id, i, {_squeeze_sql(nfkc_sql('substr(text, i * 40 + 1, 40)'))} AS text FROM parts) "
    "SELECT id AS chunk_id, i::BIGINT AS sentence_index, id || '#s' || i AS sentence_id, text FROM cut WHERE text <> ''"
)
def split_by_spans(spark, d):
    """A splitter that proposes every second stretch of 40 characters: repair fills in the others."""
    every = F.posexplode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil((F.length("text") - 40) / 80)).cast("int")))
    propose = lambda rows: rows.select("id", every.alias("i", "k"), F.length("text").alias("n")).select("id", "i", (F.col("k") * 80).alias("start"), F.least(F.col("k") * 80 + 40, F.col("n")).alias("end"))
    rows = sentences.split_rows(table(spark, d, "chunks"), propose, keep=())
    return rows.select("chunk_id", F.col("sentence_index").cast("bigint").alias("sentence_index"), "sentence_id", "text")


@_query("SELECT id, sha1('clf' || coalesce(document_id, '') || coalesce(text, '')) AS cache_key, substr(text, 1, 400) AS trimmed FROM chunks")
def cache_key(spark, d):
    return table(spark, d, "chunks").select("id", tx.fingerprint(F.lit("clf"), F.col("document_id"), F.col("text")).alias("cache_key"), tx.trim_to_tokens(F.col("text"), 100).alias("trimmed"))


@_query(
    f"WITH t AS (SELECT id, document_id, page, {_POS} AS pos, {_NORM} AS text FROM chunks), k AS (SELECT *, row_number() OVER (PARTITION BY document_id, page, sha1(text) ORDER BY pos) AS k FROM t) "
    f"SELECT id AS chunk_id, document_id, text AS clean_text, '' AS ops, false AS continues, round({_quality_sql('text', 'false')}, 9) AS quality_score, page AS first_page, 'v1' AS version FROM k WHERE k = 1"
)
def package_rows(spark, d):
    once = finish.dedupe(tables.chunk_scan(table(spark, d, "chunks")))
    rows = once.withColumn("quality_score", finish.quality_score(F.col("text"), F.lit(False))).withColumn("ops", F.array(F.lit("from_variant"))).withColumn("flags", F.lit(None).cast("map<string,boolean>"))
    out = finish.package(rows, "1970-01-01T00:00:00Z")
    return out.select("chunk_id", "document_id", "clean_text", F.array_join("ops", ",").alias("ops"), F.col("flags")["continues"].alias("continues"), F.round("quality_score", 9).alias("quality_score"), F.col("page_range")[0].alias("first_page"), "version")


@_query(
    f"WITH {_sentences_sql('(SELECT doc_id, lang, text FROM documents)')}, once AS (SELECT doc_id, lang, text FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, sha1(text) ORDER BY sentence_index) AS k FROM sentences_of) WHERE k = 1) "
    f"SELECT coalesce(lang, 'none') AS lang, count(*) AS sentences, sum(({_complete_sql('text')}))::BIGINT AS complete, round(avg({_quality_sql('text', 'false')}), 6) AS mean_quality FROM once GROUP BY 1"
)
def document_sentences(spark, d):
    return document_sentence_stats(table(spark, d, "documents"))


def document_sentence_stats(docs: DataFrame) -> DataFrame:
    """Sentences of each language, each text counted once a document."""
    rows = sentences.sentence_rows(docs, "doc_id", keep=("lang",))
    once = rows.groupBy("chunk_id", F.coalesce("lang", F.lit("none")).alias("lang"), F.sha1("text").alias("h")).agg(F.first("text").alias("text"))
    return once.groupBy("lang").agg(F.count("*").alias("sentences"), F.sum(sentences.is_complete(F.col("text"))).cast("bigint").alias("complete"), F.round(F.avg(finish.quality_score(F.col("text"), F.lit(False))), 6).alias("mean_quality"))


@_query(
    f"WITH RECURSIVE scan AS (SELECT id, document_id, page, \"offset\", {_POS} AS cpos, text FROM chunks), {_sentences_sql('scan')}, "
    "s AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY cpos, sentence_index) - 1 AS spos FROM sentences_of), "
    "g AS (SELECT document_id, min(spos) AS gpos, text, arg_min(id || '#s' || sentence_index, spos) AS id, arg_min(page, spos) AS page FROM s GROUP BY document_id, text), "
    f"lines_of AS (SELECT document_id AS did, gpos, id AS sid, page, document_id AS id, gpos AS pos, text, {_strip_sql('text')} AS t FROM g), {_FLAT}, "
    "a AS (SELECT l.did, l.sid || '-flat' AS sid, l.page, f.pos * 2 AS p, l.t || ' ' || f.list AS t, true AS flat FROM flat f JOIN lines_of l ON l.did = f.id AND l.pos = f.pos UNION ALL SELECT did, sid, page, pos * 2 + 1, t, false FROM lines_of), "
    f"x AS (SELECT *, length(t) AS n, regexp_matches(t, '{_FINAL_SQL}') AS final, ({_APART}) OR flat AS apart, row_number() OVER (PARTITION BY did ORDER BY p) - 1 AS r FROM a), "
    "y AS (SELECT *, lead(t) OVER w AS t1, lead(n) OVER w AS n1, lead(final) OVER w AS final1, lead(apart) OVER w AS apart1, lead(t, 2) OVER w AS t2, lead(n, 2) OVER w AS n2, lead(apart, 2) OVER w AS apart2 FROM x WINDOW w AS (PARTITION BY did ORDER BY p)), "
    "z AS (SELECT *, CASE WHEN NOT flat AND t1 IS NOT NULL AND NOT final AND NOT apart1 AND n + n1 <= 512 THEN CASE WHEN t2 IS NOT NULL AND NOT final1 AND NOT apart2 AND n + 1 + n1 + n2 <= 512 THEN 3 ELSE 2 END ELSE 1 END AS reach FROM y), "
    "walk AS (SELECT did, r, reach FROM z WHERE r = 0 UNION ALL SELECT z.did, z.r, z.reach FROM walk w JOIN z ON z.did = w.did AND z.r = w.r + w.reach), "
    "o AS (SELECT z.did, z.sid || CASE WHEN z.reach > 1 THEN '-stitched' ELSE '' END AS sid, z.page, z.p, CASE WHEN z.reach = 3 THEN t || ' ' || t1 || ' ' || t2 WHEN z.reach = 2 THEN t || ' ' || t1 ELSE t END AS text FROM walk w JOIN z ON z.did = w.did AND z.r = w.r), "
    f"k AS (SELECT *, row_number() OVER (PARTITION BY did, page, sha1(text) ORDER BY p) AS k FROM (SELECT did, sid, page, p, {_squeeze_sql(nfkc_sql('text'))} AS text FROM o)) "
    f"SELECT sid AS chunk_id, did AS document_id, text AS clean_text, round({_quality_sql('text', 'false')}, 9) AS quality_score, page AS first_page FROM k WHERE k = 1"
)
def pipeline_offline(spark, d):
    return run_pipeline(table(spark, d, "chunks")).select("chunk_id", "document_id", "clean_text", F.round("quality_score", 9).alias("quality_score"), F.col("page_range")[0].alias("first_page"))
