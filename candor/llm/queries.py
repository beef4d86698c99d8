"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@register("op3_hyperminhash")
def op3(spark, sf_dir):
    from candor.llm.hyperminhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


@register("op4_best_fit_packing")
def op4(spark, sf_dir):
    import public_tokenizers

    from candor.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@register("op6_anchor_pii")
def op6(spark, sf_dir):
    from candor.llm.pii import find_personal_data

    return find_personal_data(table(spark, sf_dir, "documents")).drop("found")


@register("op8_span_langid")
def op8(spark, sf_dir):
    from candor.llm.langid import fit, predict

    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit(docs)).drop("spans")


@register("op9_simhash")
def op9(spark, sf_dir):
    from candor.llm.simhash import fingerprint_documents

    return fingerprint_documents(table(spark, sf_dir, "documents"))


# Records as op10 renders them; a damaged record keeps its place.
_OP10_SQL = """WITH r AS (
  SELECT page_id, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
    || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
    || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record,
    (row_number() OVER (ORDER BY page_id) - 1) // 1000 AS file_no, substr(md5(page_id::VARCHAR), 1, 2) AS pick FROM pages),
p AS (SELECT *, strlen(record)::BIGINT AS length,
  coalesce(sum(strlen(record)) OVER (PARTITION BY file_no ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM r)
SELECT page_id, file_no::BIGINT AS file_no, "offset", length,
  CASE WHEN pick = '02' THEN NULL WHEN pick = '03' THEN strlen(left(record, length(record) - 40))
       ELSE strlen(left(record, length(record) - 5) || '~' || right(record, 4)) END::BIGINT AS replica_length,
  CASE WHEN pick = '02' THEN 'missing' WHEN pick = '03' THEN 'truncated'
       WHEN strlen(left(record, length(record) - 5) || '~' || right(record, 4)) < length THEN 'truncated' ELSE 'changed' END AS status
FROM p WHERE pick IN ('00', '01', '02', '03')
UNION ALL
SELECT page_id, (SELECT max(file_no) FROM p)::BIGINT + 1 + spot // 1000, coalesce(sum(length + 1) OVER (PARTITION BY spot // 1000 ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT,
  NULL, length + 1, 'extra' FROM (SELECT page_id, length, row_number() OVER (ORDER BY page_id) - 1 AS spot FROM p WHERE pick = '04')"""


@register("op10_merkle_fixity", _OP10_SQL)
def op10(spark, sf_dir):
    from candor.llm.fixity import archive, audit, damaged_replica, replica, warc_records

    records = warc_records(table(spark, sf_dir, "pages"))
    manifest = archive(records)
    return audit(manifest, replica(damaged_replica(records), manifest))


_OP7_SQL = r"""WITH c AS (
  SELECT page_id, nullif(rtrim(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://([^/?#\\]*@)?(\[[^\]/?#\\@]*\]|[^/?#\\:@\[\]]*)', 2), '.'), '') AS host,
    DATE '2020-01-01' + (('0x' || substr(md5('fetch|' || page_id), 1, 4))::INT % 1461)::INT AS fetched_on FROM pages),
hosts AS (SELECT DISTINCT host FROM c WHERE host IS NOT NULL),
h AS (SELECT host, md5(host || '|' || k) AS h FROM hosts, range(6) r(k) WHERE ('0x' || substr(md5(host || '|' || k), 1, 1))::INT < 8),
e AS (SELECT CASE WHEN ('0x' || substr(h, 2, 1))::INT < 12 THEN host ELSE regexp_replace(host, '^[^.]*\.', '') END AS pattern,
    ['adult', 'malware', 'phishing', 'spam'][('0x' || substr(h, 3, 1))::INT % 4 + 1] AS category,
    DATE '2020-01-01' + (('0x' || substr(h, 4, 4))::INT % 1461)::INT AS day, ('0x' || substr(h, 8, 1))::INT < 10 AS listed FROM h),
d AS (SELECT pattern, category, day, bool_and(listed) AS listed FROM e GROUP BY ALL),
i AS (SELECT *, lead(day) OVER (PARTITION BY pattern, category ORDER BY day) AS until FROM d),
s AS (SELECT host, unnest(CASE WHEN regexp_matches(host, '^(\[.*|[0-9]+(\.[0-9]+){3})$') THEN [host]
    ELSE list_transform(range(1, len(string_split(host, '.')) + 1), lambda x: array_to_string(string_split(host, '.')[x:], '.')) END) AS pattern FROM hosts),
m AS (SELECT c.page_id, i.pattern, i.category FROM c JOIN s USING (host) JOIN i ON i.pattern = s.pattern AND i.listed
    AND i.day <= c.fetched_on AND (i.until IS NULL OR c.fetched_on < i.until)),
g AS (SELECT page_id, array_to_string(list_sort(list_distinct(list(category))), ',') AS categories, arg_max(pattern, length(pattern)) AS pattern FROM m GROUP BY page_id)
SELECT c.page_id, c.host, c.fetched_on, g.page_id IS NOT NULL AS blocked, coalesce(g.categories, '') AS categories, g.pattern
FROM c LEFT JOIN g USING (page_id)"""


@register("op7_temporal_url_lists", _OP7_SQL)
def op7(spark, sf_dir):
    from candor.llm.url_lists import dated_captures, dated_entries, evaluate

    pages = table(spark, sf_dir, "pages")
    return evaluate(dated_captures(pages), dated_entries(pages))


@register("op5_prefix_viterbi")
def op5(spark, sf_dir):
    import public_tokenizers
    from pyspark.sql import functions as F

    from candor.llm.prefix_viterbi import encode

    out = encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", F.size("ids").alias("n_ids"), "ids_crc32", "decoded_equal")


_OP2_SQL = r"""WITH RECURSIVE u AS MATERIALIZED (
  SELECT conv_id, turn, text, 'call_' || substr(md5('id|' || conv_id || '|' || turn), 1, 12) AS call_id, md5('call|' || conv_id || '|' || turn) AS h
  FROM conversations WHERE role = 'user' AND text IS NOT NULL),
d AS (SELECT *, ('0x' || substr(h, 1, 1))::INT AS d1, ('0x' || substr(h, 2, 1))::INT AS d2, ('0x' || substr(h, 3, 1))::INT AS d3 FROM u),
c AS MATERIALIZED (SELECT *, CASE WHEN d1 < 8 THEN 'search' WHEN d1 < 12 THEN 'lookup' WHEN d1 < 15 THEN 'calc' ELSE 'shell' END AS tool,
    CASE WHEN d3 = 0 THEN 'call_none' WHEN d3 = 1 THEN call_id WHEN turn >= 2 THEN 'call_' || substr(md5('id|' || conv_id || '|' || (turn - 2)), 1, 12) END AS after FROM d),
t AS (SELECT c.conv_id, c.call_id, 0::BIGINT AS depth FROM c WHERE c.after IS NULL OR NOT EXISTS (SELECT 1 FROM c p WHERE p.conv_id = c.conv_id AND p.call_id = c.after)
  UNION ALL SELECT c.conv_id, c.call_id, t.depth + 1 FROM t JOIN c ON c.conv_id = t.conv_id AND c.after = t.call_id),
r AS (SELECT conv_id, turn - 1 AS turn, text AS content FROM conversations
  WHERE role = 'assistant' AND substr(md5('result|' || conv_id || '|' || turn), 1, 1) <> '0'),
j AS (SELECT c.*, t.depth, r.turn IS NOT NULL AS answered, r.content, c.after IS NOT NULL AND NOT EXISTS (SELECT 1 FROM c p WHERE p.conv_id = c.conv_id AND p.call_id = c.after) AS dangling,
    CASE WHEN d2 = 0 THEN '{"query":' || c.turn || '}' WHEN d2 = 1 THEN 'null'
      WHEN tool = 'search' THEN '{"limit":' || c.turn || ',"query":' || to_json(text) || '}'
      WHEN tool = 'lookup' THEN '{"key":"user","turn":' || c.turn || '}' ELSE '{"unit":"x","values":[' || c.turn || ',' || length(text) || ']}' END AS arguments
  FROM c LEFT JOIN t USING (conv_id, call_id) LEFT JOIN r ON r.conv_id = c.conv_id AND r.turn = c.turn)
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY depth NULLS LAST, turn) AS ord, turn, call_id, tool, depth, answered::BIGINT AS n_results,
  CASE WHEN d2 = 1 THEN 'invalid_json' WHEN tool = 'shell' THEN 'unknown_tool' WHEN d2 = 0 THEN 'invalid_arguments' WHEN depth IS NULL THEN 'cycle'
    WHEN dangling THEN 'unknown_dependency' WHEN NOT answered THEN 'no_result' ELSE 'ok' END AS status,
  '{"arguments":' || arguments || ',"id":"' || call_id || '","name":"' || tool || '","result":'
    || CASE WHEN answered THEN to_json(coalesce(content, ''))::VARCHAR ELSE 'null' END || '}' AS message FROM j"""


@register("op2_tool_call_linking", _OP2_SQL)
def op2(spark, sf_dir):
    from candor.llm.tool_calls import SCHEMAS, calls_of, link_calls, results_of

    conversations = table(spark, sf_dir, "conversations")
    return link_calls(calls_of(conversations), results_of(conversations), SCHEMAS)


@register("op1_block_max_bm25")
def op1(spark, sf_dir):
    from candor.llm.topk_search import search

    docs = table(spark, sf_dir, "documents")
    return search(docs, docs.where("doc_id % 50 = 0").withColumnRenamed("doc_id", "query_id"))


_OP11_SQL = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS lines,
    ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 17, 8))::BIGINT AS h3,
    ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT *, len(lines) AS n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS a, greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
      WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, coalesce(array_to_string(lines[1:a], ''), '') AS pre, coalesce(array_to_string(lines[a + 1:b], ''), '') AS mid,
    coalesce(array_to_string(lines[b + 1:], ''), '') AS suf FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p"""


@register("op11_fill_in_middle", _OP11_SQL)
def op11(spark, sf_dir):
    from pyspark.sql import functions as F

    from candor.llm.fim import restored, transform

    out = transform(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


_OP12_SQL = r"""WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS n_chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS s FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, (count(*) OVER (PARTITION BY s))::BIGINT AS group_size, row_number() OVER w = 1 AS kept,
  sha256(s) AS text_sha256 FROM n
WINDOW w AS (PARTITION BY s ORDER BY n_chars DESC, doc_id NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""


@register("op12_exact_dedup", _OP12_SQL)
def op12(spark, sf_dir):
    from candor.llm.exact_dedup import exact_duplicates

    return exact_duplicates(table(spark, sf_dir, "documents"))


@register("op13_cut_alignment")
def op13(spark, sf_dir):
    import public_tokenizers as P

    from candor.llm.alignment import link_statistics

    files = (P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN, P.path("piece_bpe_32k.model"))
    return link_statistics(table(spark, sf_dir, "documents"), files)
