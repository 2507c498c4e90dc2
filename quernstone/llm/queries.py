"""Queries of the ten problems over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions.text import WS
from quernstone.llm import format_copies, lookalike, near_dup, packing, residue, scan_repair, sentences, site_lines, tokens, truncation
from quernstone.plans.queries import nfkc_sql
from quernstone.runtime import cut
from quernstone.sources.tables import table as _table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained on all chunks, as the other scripts stand in split_sample's alone, whose boundaries it isn't told."""
    chunks = _table(spark, sf_dir, "chunks").select("id", "text")
    named = _table(spark, sf_dir, "split_sample").select(F.col("chunk_id").alias("id")).distinct()
    sample = cut(chunks.join(named, "id", "left_semi"), "sample")
    return sentences.split_sentences(sample, examples=chunks).select(F.col("id").alias("chunk_id"), "end_pos")


def p1_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sentence units of every chunk."""
    return sentences.split_sentences(_table(spark, sf_dir, "chunks")).select(F.col("id").alias("chunk_id"), "sentence_no", "start_pos", "end_pos", "text")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_lines.repeated_lines(_table(spark, sf_dir, "chunks"), _table(spark, sf_dir, "source_docs")).select("chunk_id", "line_no").distinct()


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = [lookalike.lookalike_rows(_table(spark, sf_dir, t)).withColumn("tbl", F.lit(t)) for t in ("chunks", "sentences")]
    classes = lookalike.lookalike_classes(cut(both[0].unionByName(both[1]), "forms"), ("tbl",))
    return lookalike.lookalike_pairs(classes, ("tbl",))


def p3_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The canonical member of each row that looks like a differently built one."""
    both = [lookalike.lookalike_rows(_table(spark, sf_dir, t)).withColumn("tbl", F.lit(t)) for t in ("chunks", "sentences")]
    classes = cut(lookalike.lookalike_classes(cut(both[0].unionByName(both[1]), "forms"), ("tbl",)), "classes")
    several = classes.groupBy("tbl", "class_id").agg(F.min("text_hash").alias("a"), F.max("text_hash").alias("z")).where("a <> z").select("tbl", "class_id")
    return lookalike.canonical_members(classes.join(several, ["tbl", "class_id"], "left_semi"), ("tbl",))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_copies.format_copies(_table(spark, sf_dir, "chunks")).select("kept_id", "copy_id")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_repair.scan_faults(_table(spark, sf_dir, "chunks"))


def p5_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunks' texts as continuous paragraphs."""
    return scan_repair.repair_chunks(_table(spark, sf_dir, "chunks"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "sentences")).select("id_a", "id_b")


def _values(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(tbl, rec_id, text, document_id, page, off) of both tables, and (document_id, source)."""
    both = [_table(spark, sf_dir, t).select(F.lit(t).alias("tbl"), F.col("id").alias("rec_id"), "text", "document_id", "page", F.col("offset").alias("off")) for t in ("chunks", "sentences")]
    return both[0].unionByName(both[1]), _table(spark, sf_dir, "source_docs").select(F.col("id").alias("document_id"), F.col("site_id").alias("source"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.cut_values(*_values(spark, sf_dir)).select("tbl", "rec_id")


def p7_site_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of cut values of each site and table."""
    found = truncation.cut_values(*_values(spark, sf_dir)).select("tbl", "rec_id", F.lit(1).alias("is_cut"))
    rows = _table(spark, sf_dir, "chunks").select(F.lit("chunks").alias("tbl"), F.col("id").alias("rec_id"), "document_id").unionByName(_table(spark, sf_dir, "sentences").select(F.lit("sentences").alias("tbl"), F.col("id").alias("rec_id"), "document_id"))
    docs = _table(spark, sf_dir, "source_docs").select(F.col("id").alias("document_id"), "site_id").distinct()
    per_doc = rows.join(found, ["tbl", "rec_id"], "left").groupBy("tbl", "document_id").agg(F.count("*").alias("n"), F.count("is_cut").alias("n_cut"))
    return per_doc.join(docs, "document_id").groupBy("site_id", "tbl").agg(F.sum("n").alias("n_values"), F.sum("n_cut").alias("n_cut")).withColumn("share", F.round(F.col("n_cut") / F.col("n_values"), 6))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode_documents(_table(spark, sf_dir, "documents"))


def p8_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text, decoded from its ids."""
    return tokens.decode_documents(tokens.encode_documents(_table(spark, sf_dir, "documents")))


def p8_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each document, its number of ids, and whether their starts begin at 0, never fall, and stay inside the text."""
    docs = _table(spark, sf_dir, "documents")
    rows = tokens.encode_with_offsets(docs).join(docs.select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("n")), "doc_id")
    rises = F.expr("size(starts) = 0 OR starts[0] = 0 AND starts = array_sort(starts) AND element_at(starts, -1) < n AND size(starts) = size(ids)")
    return rows.select("doc_id", (F.size("ids") > 0).alias("has_ids"), rises.alias("sound"))


def p9_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents placed; containers above the capacity, documents split without need, documents whose tokens don't come out once."""
    docs = tokens.count_tokens(_table(spark, sf_dir, "documents"))
    placed = cut(packing.pack_sizes(cut(docs.where("n_tokens > 0"), "sizes")), "placed")
    pieces = placed.groupBy("doc_id").agg(F.count("*").alias("pieces"), F.sum("n_tokens").alias("placed"), F.max(F.col("start_token") + F.col("n_tokens")).alias("end"), F.countDistinct("start_token").alias("starts"))
    each = docs.where("n_tokens > 0").join(pieces, "doc_id", "left").agg(
        F.count("placed").alias("documents"), F.count_if((F.col("pieces") > 1) & (F.col("n_tokens") <= packing.CAPACITY)).alias("split_without_need"),
        F.count_if(~F.expr("placed <=> n_tokens AND end <=> n_tokens AND starts <=> pieces")).alias("not_once"),
    )
    over = placed.groupBy("container").agg(F.sum("n_tokens").alias("n")).agg(F.count_if(F.col("n") > packing.CAPACITY).alias("over_capacity"))
    return each.join(F.broadcast(over))  # one row each


def p9_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers used, the fewest that could hold the tokens, and the share of their room that is filled."""
    held = packing.pack_documents(_table(spark, sf_dir, "documents")).groupBy("container").agg(F.sum("n_tokens").alias("n"))
    total = held.agg(F.count("*").alias("containers"), F.sum("n").alias("tokens"))
    return total.withColumn("least", F.ceil(F.col("tokens") / packing.CAPACITY)).withColumn("fill", F.round(F.col("tokens") / (F.col("containers") * packing.CAPACITY), 6))


def p9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.residue_documents(_table(spark, sf_dir, "documents")).select("doc_id")


def p10_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with a text but no residue."""
    docs = _table(spark, sf_dir, "documents").where("text is not null")
    return docs.select("doc_id").join(residue.residue_documents(docs).select("doc_id"), "doc_id", "left_anti")


def p10_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without its residue."""
    return residue.clean_documents(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_units, p2_found, p3_found, p3_canonical, p4_found, p5_found, p5_repaired, p6_found, p7_found, p7_site_share, p8_ids, p8_round_trip, p8_offsets, p9_pack, p9_check, p9_fill, p10_found, p10_kept, p10_cleaned)}


_P2 = f"""
WITH docs AS (SELECT DISTINCT id AS document_id, site_id FROM source_docs WHERE id IS NOT NULL AND site_id IS NOT NULL),
lines AS (SELECT chunk_id, document_id, unnest(l) AS line, unnest(range(0, len(l))) AS line_no FROM (SELECT id AS chunk_id, document_id, string_split(text, chr(10)) AS l FROM chunks WHERE text IS NOT NULL)),
keyed AS (SELECT chunk_id, document_id, line_no, regexp_replace(regexp_replace(lower({nfkc_sql("line")}), '[{WS}]+', '', 'g'), '\\p{{Nd}}+', '0', 'g') AS key FROM lines),
counted AS (SELECT * FROM keyed WHERE length(regexp_replace(key, '[^\\p{{L}}]', '', 'g')) >= {site_lines.MIN_LETTERS}),
hot AS (SELECT site_id, key FROM counted JOIN docs USING (document_id) GROUP BY site_id, key HAVING count(DISTINCT document_id) >= {site_lines.MIN_DOCUMENTS})
SELECT DISTINCT chunk_id, line_no FROM counted JOIN docs USING (document_id) JOIN hot USING (site_id, key)
"""


def _look_sql(x: str) -> str:
    """The look of a text in SQL: invisible characters go, accents are composed, every character becomes its look, again composed."""
    gone, single, several = [], [], []
    for cp in (*range(0x7F, 0xD800), *range(0xF900, 0xFFFE), *range(0x1D400, 0x1D800)):
        c = chr(cp)
        k = lookalike.skeleton(c)
        if k == "":
            gone.append(c)
        elif k != c and len(k) == 1 and k != "'":
            single.append((c, k))
        elif k != c and (0xFB00 <= cp <= 0xFB06 or 0x2160 <= cp <= 0x217F):
            several.append((c, k))
    x = f"nfc_normalize(translate({x}, '{''.join(gone)}', ''))"
    for c, k in several:
        x = f"replace({x}, '{c}', '{k}')"
    return f"nfc_normalize(translate({x}, '{''.join(c for c, _ in single)}', '{''.join(k for _, k in single)}'))"


_P3 = f"""
WITH rows_of AS (SELECT 'chunks' AS tbl, id, text FROM chunks UNION ALL SELECT 'sentences', id, text FROM sentences),
looks AS (SELECT tbl, id, text, {_look_sql("text")} AS look FROM rows_of WHERE regexp_matches(text, '[^{WS}]'))
SELECT a.tbl, a.id AS id_a, b.id AS id_b FROM looks a JOIN looks b ON a.tbl = b.tbl AND a.look = b.look AND a.id < b.id AND a.text <> b.text
"""


_P3_CANONICAL = f"""
WITH rows_of AS (SELECT 'chunks' AS tbl, id, text FROM chunks UNION ALL SELECT 'sentences', id, text FROM sentences),
looks AS (SELECT tbl, id, text, {_look_sql("text")} AS look FROM rows_of WHERE regexp_matches(text, '[^{WS}]')),
best AS (SELECT tbl, look, min((CASE WHEN text <> look THEN '1' ELSE '0' END) || id) AS best FROM looks GROUP BY tbl, look HAVING count(DISTINCT text) > 1)
SELECT tbl, id, substr(best, 2) AS canonical_id FROM looks JOIN best USING (tbl, look)
"""
_P8 = "SELECT doc_id, coalesce(text, '') AS text FROM documents"
_P8_OFFSETS = "SELECT doc_id, length(coalesce(text, '')) > 0 AS has_ids, true AS sound FROM documents"
_P9 = "SELECT count_if(length(text) > 0) AS documents, 0::BIGINT AS split_without_need, 0::BIGINT AS not_once, 0::BIGINT AS over_capacity FROM documents"


def _plain_sql(x: str) -> str:
    """Content of a text in SQL: lower case, no white space, punctuation only directly between digits."""
    x = f"lower({x})"
    for _ in range(2):  # twice, as marks may share a digit
        x = f"regexp_replace({x}, '(\\p{{Nd}})(\\p{{P}})(\\p{{Nd}})', '\\1' || chr(2) || '\\2\\3', 'g')"
    return f"replace(regexp_replace(regexp_replace({x}, '(\\x02\\p{{P}})|\\p{{P}}', '\\1', 'g'), '[{WS}]+', '', 'g'), chr(2), '')"


_FIELD = f"CASE WHEN contains(p, ':') AND {_plain_sql('split_part(p, chr(58), 1)')} <> '' AND {_plain_sql('substr(p, strpos(p, chr(58)) + 1)')} <> '' THEN {_plain_sql('split_part(p, chr(58), 1)')} || chr(9) || {_plain_sql('substr(p, strpos(p, chr(58)) + 1)')} END"
_P4 = f"""
WITH parted AS (SELECT id, document_id, page, text, list_transform(list_filter(string_split_regex(replace(text, '：', ':'), '[\\n\\r\\t;|\\x0b\\f\\x1c-\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}；｜]+'), lambda p: {_plain_sql("p")} <> ''), lambda p: {_FIELD}) AS parts FROM chunks WHERE text IS NOT NULL),
keyed AS (SELECT id, document_id, page, CASE WHEN len(parts) >= 2 AND len(list_filter(parts, lambda p: p IS NULL)) = 0 THEN array_to_string(list_sort(parts), chr(10)) ELSE {_plain_sql("text")} END AS key FROM parted)
SELECT kept_id, id AS copy_id FROM (SELECT id, min(id) OVER (PARTITION BY document_id, page, key) AS kept_id FROM keyed WHERE key <> '') WHERE id <> kept_id
"""
_P6 = f"""
WITH t AS (SELECT id, text, {_look_sql("text")} AS look, regexp_replace(text, '[{WS}]+', '', 'g') AS bare, list_distinct(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS words FROM sentences WHERE text IS NOT NULL),
w AS (SELECT id, len(words) AS n, unnest(words) AS word FROM t),
pairs_of AS (SELECT a.id AS id_a, b.id AS id_b, count(*) AS common, any_value(a.n + b.n) AS n FROM w a JOIN w b ON a.word = b.word AND a.id < b.id GROUP BY 1, 2)
SELECT id_a, id_b FROM pairs_of JOIN t x ON x.id = id_a JOIN t y ON y.id = id_b WHERE common >= {near_dup.THRESHOLD} * (pairs_of.n - common) - 1e-9 AND x.bare <> y.bare AND x.look <> y.look
"""


def oracle_sql() -> dict[str, str]:
    return {"p2_found": _P2, "p3_found": _P3, "p3_canonical": _P3_CANONICAL, "p4_found": _P4, "p6_found": _P6, "p8_round_trip": _P8, "p8_offsets": _P8_OFFSETS, "p9_check": _P9}
