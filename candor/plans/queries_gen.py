"""Registered queries of the learned operators (language model, constrained generation, copied spans, calibrated classifier, length buckets) and of files."""

from __future__ import annotations

from pyspark.sql import functions as F

from candor.operators import language_model as L
from candor.operators.strategies import strategy_rows
from candor.plans import oracle as O
from candor.plans.queries import ORACLES, doc_lines, register
from candor.plans.queries_ext import _CSV_CTE, _PAIRS_SQL, _pairs_df
from candor.sources.lines import load_table

_DIGITS = 9

# =============================================================================================
# Trigram model over document lines
# =============================================================================================


def _discount_sql(name: str, counts: str) -> str:
    """Three discounts of a count table as columns d1 to d3 (see ``language_model.discounts``)."""
    one = lambda raw, k: f"CASE WHEN {raw} > 0 AND {raw} < {k} THEN {raw} ELSE 0.5::DOUBLE END AS d{k}"
    return f"""{name}_n AS (SELECT count(*) FILTER (c = 1) AS n1, count(*) FILTER (c = 2) AS n2, count(*) FILTER (c = 3) AS n3, count(*) FILTER (c = 4) AS n4 FROM {counts}),
{name}_y AS (SELECT *, CASE WHEN n1 > 0 THEN n1::DOUBLE / (n1 + 2 * n2) ELSE 0 END AS y FROM {name}_n),
{name}_r AS (SELECT CASE WHEN n1 > 0 THEN 1 - 2 * y * n2 / n1 ELSE 0 END AS r1, CASE WHEN n2 > 0 THEN 2 - 3 * y * n3 / n2 ELSE 0 END AS r2,
  CASE WHEN n3 > 0 THEN 3 - 4 * y * n4 / n3 ELSE 0 END AS r3 FROM {name}_y),
{name} AS (SELECT {one('r1', 1)}, {one('r2', 2)}, {one('r3', 3)} FROM {name}_r)"""


_FREED = "(count(*) FILTER (c = 1) * any_value(d1) + count(*) FILTER (c = 2) * any_value(d2) + count(*) FILTER (c > 2) * any_value(d3)) / sum(c)"
_LESS = "(c - CASE WHEN c = 1 THEN d1 WHEN c = 2 THEN d2 ELSE d3 END)"


def _marked(x: str) -> str:
    return f"list_concat([{O.S(L.START)}, {O.S(L.START)}], {x}, [{O.S(L.END)}])"


def _grams_of(t: str) -> str:
    return f"list_zip({t}[1:len({t}) - 2], {t}[2:len({t}) - 1], {t}[3:len({t})])"


_MODEL_CTE = f"""{O.lines_cte()}, {O.line_tokens_cte()},
marked AS (SELECT {_marked('_toks')} AS t FROM tlines WHERE len(_toks) > 0),
grams AS (SELECT unnest({_grams_of('t')}) AS g FROM marked),
tri0 AS MATERIALIZED (SELECT g[1] AS u, g[2] AS v, g[3] AS w, count(*) AS c FROM grams GROUP BY ALL),
bi0 AS MATERIALIZED (SELECT v, w, count(*) AS c FROM tri0 GROUP BY ALL),
uni0 AS MATERIALIZED (SELECT w, count(*) AS c FROM bi0 GROUP BY ALL),
{_discount_sql('e3', 'tri0')}, {_discount_sql('e2', 'bi0')}, {_discount_sql('e1', 'uni0')},
every AS (SELECT sum(c) AS total, {_FREED} AS gamma, count(*) AS types FROM uni0, e1),
uni AS MATERIALIZED (SELECT w, c, {_LESS} / total + gamma / types AS p FROM uni0, e1, every),
of_one AS MATERIALIZED (SELECT v, sum(c) AS total, {_FREED} AS gamma FROM bi0, e2 GROUP BY v),
bi AS MATERIALIZED (SELECT v, w, bi0.c, (bi0.c - CASE WHEN bi0.c = 1 THEN d1 WHEN bi0.c = 2 THEN d2 ELSE d3 END) / total + gamma * uni.p AS p
  FROM bi0 JOIN of_one USING (v) JOIN uni USING (w), e2),
of_two AS MATERIALIZED (SELECT u, v, sum(c) AS total, {_FREED} AS gamma FROM tri0, e3 GROUP BY u, v),
tri AS MATERIALIZED (SELECT u, v, w, tri0.c, (tri0.c - CASE WHEN tri0.c = 1 THEN d1 WHEN tri0.c = 2 THEN d2 ELSE d3 END) / total + gamma * bi.p AS p
  FROM tri0 JOIN of_two USING (u, v) JOIN bi USING (v, w), e3)"""


def _model(spark, sf_dir):
    return L.train(doc_lines(spark, sf_dir))


@register("trigram_model", f"WITH {_MODEL_CTE} SELECT u, v, w, c, round(p, {_DIGITS}) AS p FROM tri")
def q_trigram_model(spark, sf_dir):
    return _model(spark, sf_dir).tri.select("u", "v", "w", "c", F.round("p", _DIGITS).alias("p"))


@register("text_perplexity", f"""WITH {_MODEL_CTE},
ctext AS (SELECT conv_id, turn, {O.ws_tokens('text', lower=True)} AS toks FROM conversations),
cgram AS (SELECT conv_id, turn, unnest({_grams_of('t')}) AS g FROM (SELECT conv_id, turn, {_marked('toks')} AS t FROM ctext WHERE len(toks) > 0)),
cp AS (SELECT conv_id, turn, ln(coalesce(tri.p, coalesce(of_two.gamma, 1) * coalesce(bi.p, coalesce(of_one.gamma, 1) * coalesce(uni.p, every.gamma / every.types)))) AS lp
  FROM cgram LEFT JOIN tri ON tri.u = g[1] AND tri.v = g[2] AND tri.w = g[3] LEFT JOIN bi ON bi.v = g[2] AND bi.w = g[3]
  LEFT JOIN of_two ON of_two.u = g[1] AND of_two.v = g[2] LEFT JOIN of_one ON of_one.v = g[2] LEFT JOIN uni ON uni.w = g[3], every),
cs AS (SELECT conv_id, turn, count(*) AS n, sum(lp) AS s FROM cp GROUP BY ALL)
SELECT conv_id, turn, coalesce(n, 0) AS n_tokens, round(s, 6) AS log_prob, round(exp(-s / n), 4) AS perplexity FROM ctext LEFT JOIN cs USING (conv_id, turn)""")
def q_text_perplexity(spark, sf_dir):
    out = L.perplexity(load_table(spark, sf_dir, "conversations"), ["conv_id", "turn"], _model(spark, sf_dir))
    return out.select("conv_id", "turn", "n_tokens", F.round("log_prob", 6).alias("log_prob"), F.round("perplexity", 4).alias("perplexity"))


@register("beam_generation")
def q_beam_generation(spark, sf_dir):
    """Every user turn continued by 8 to 20 words (or the strategy's own least) under greedy, beam, guarded beam and sampling decoding; tests hold the plain search."""
    from candor.operators.generate import generate

    prompts = load_table(spark, sf_dir, "conversations").where(F.col("role") == "user").select("conv_id", "turn", "text")
    rows = [{**r, "max_length": 20, "min_length": r["min_length"] or 8} for r in strategy_rows(["greedy", "beam", "summary_beam", "summary_sampling"])]
    return generate(prompts, ["conv_id", "turn"], _model(spark, sf_dir), rows)


# =============================================================================================
# Copied spans
# =============================================================================================

@register("copied_spans", f"""WITH {_PAIRS_SQL},
t AS MATERIALIZED (SELECT conv_id, turn, {O.ws_tokens('prompt', lower=True)} AS a, {O.ws_tokens('response', lower=True)} AS b FROM pairs),
ea AS (SELECT conv_id, turn, unnest(a) AS w, unnest(range(len(a))) AS i FROM t),
eb AS (SELECT conv_id, turn, unnest(b) AS w, unnest(range(len(b))) AS j FROM t),
m AS (SELECT conv_id, turn, i, j, i - row_number() OVER (PARTITION BY conv_id, turn, j - i ORDER BY i) AS run FROM ea JOIN eb USING (conv_id, turn, w)),
r AS (SELECT conv_id, turn, min(i) AS i, min(j) AS j, count(*) AS n FROM m GROUP BY conv_id, turn, m.j - m.i, run),
best AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY n DESC, j, i) AS rn FROM r)
SELECT conv_id, turn, coalesce(n, 0)::INT AS words, coalesce(j, 0)::INT AS output_start, coalesce(i, 0)::INT AS source_start
FROM t LEFT JOIN (SELECT * FROM best WHERE rn = 1) USING (conv_id, turn)""")
def q_copied_spans(spark, sf_dir):
    from candor.operators.spans import longest_copied

    return longest_copied(_pairs_df(spark, sf_dir), "prompt", "response").select("conv_id", "turn", "copied.*")


_SPAN = 4
_SPAN_GRAMS = f"list_transform({O.ngrams('_toks', _SPAN)}, lambda x: array_to_string([{', '.join(f'x[{i + 1}]' for i in range(_SPAN))}], ' '))"


@register("benchmark_spans", f"""WITH {O.line_tokens_cte('td', 'documents')},
ref AS (SELECT row_number() OVER () AS item, _toks FROM (SELECT DISTINCT {O.ws_tokens('text', lower=True)} AS _toks FROM benchmark)),
bg AS (SELECT item, unnest(gs) AS g, unnest(range(len(gs))) AS j FROM (SELECT item, {_SPAN_GRAMS} AS gs FROM ref)),
dg AS (SELECT doc_id, unnest(gs) AS g, unnest(range(len(gs))) AS i FROM (SELECT doc_id, {_SPAN_GRAMS} AS gs FROM td)),
m AS (SELECT doc_id, item, i, j, i - row_number() OVER (PARTITION BY doc_id, item, j - i ORDER BY i) AS run FROM dg JOIN bg USING (g)),
r AS (SELECT DISTINCT doc_id, min(i) AS start, count(*) + {_SPAN - 1} AS words FROM m GROUP BY doc_id, item, m.j - m.i, run),
far AS (SELECT *, max(start + words) OVER (PARTITION BY doc_id ORDER BY start, words DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM r)
SELECT doc_id, start::INT AS start, words::INT AS words FROM far WHERE reach IS NULL OR start + words > reach""")
def q_benchmark_spans(spark, sf_dir):
    from candor.operators.spans import shared_spans

    return shared_spans(load_table(spark, sf_dir, "documents"), load_table(spark, sf_dir, "benchmark"), ["doc_id"], _SPAN)


# =============================================================================================
# Calibrated classifier
# =============================================================================================

def _labels(spark, sf_dir):
    return load_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("y"))


def _labelled(spark, sf_dir):
    return load_table(spark, sf_dir, "documents").select("doc_id", "text").join(_labels(spark, sf_dir), "doc_id")


@register("calibrated_scores")
def q_calibrated_scores(spark, sf_dir):
    """Every document scored by the calibrated classifier of the labelled ones, with the neutral band."""
    from candor.operators import logistic as C
    from candor.operators.classify import neutralize

    docs = C.hashed(load_table(spark, sf_dir, "documents"), ["doc_id"])
    scored = C.score(docs, C.train(docs.join(_labels(spark, sf_dir), "doc_id"), ["doc_id"]))
    return neutralize(scored).select("doc_id", F.round("raw", 6).alias("raw"), "p", "label", "score", "neutralized")


@register("classifier_quality")
def q_classifier_quality(spark, sf_dir):
    """Held-out log loss, Brier score and calibration error of naive Bayes and of the calibrated classifier; a fifth of the labelled documents is held out by a hash."""
    from candor.operators import logistic as C
    from candor.operators.classify import score_naive_bayes, train_naive_bayes

    labelled = _labelled(spark, sf_dir)
    held = F.pmod(F.crc32(F.concat(F.lit("held|"), F.col("doc_id").cast("string"))), F.lit(5)) == 0
    seen, rest = labelled.where(~held), labelled.where(held)
    bayes = score_naive_bayes(rest, ["doc_id"], *train_naive_bayes(seen)).withColumn("p", 1.0 / (1.0 + F.exp(-F.col("z"))))
    table = C.hashed(labelled, ["doc_id", "y"])
    model, rest = C.train(table.where(~held), ["doc_id"]), table.where(held)
    out = [C.quality(df, p_col=p).withColumn("model", F.lit(name)) for name, df, p in
           (("naive_bayes", bayes, "p"), ("logistic", C.score(rest, model), "raw"), ("logistic_calibrated", C.score(rest, model), "p"))]
    return out[0].unionByName(out[1]).unionByName(out[2]).select("model", "rows", *[F.round(c, 6).alias(c) for c in ("log_loss", "brier", "calibration_error")])


# =============================================================================================
# Length buckets
# =============================================================================================

_LONGEST, _BUCKETS, _BUDGET = 128, 8, 1024
_BUCKET_CTE = f"""{O.lines_cte()},
len_ AS (SELECT doc_id, line_no, least({O.regex_word_count('text')}, {_LONGEST})::INT AS length FROM lines),
hist AS (SELECT length, count(*) AS n FROM len_ GROUP BY length),
cumul AS (SELECT length, n, coalesce(sum(n) OVER (ORDER BY length ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(n) OVER () AS total FROM hist),
buck0 AS (SELECT length, (before * {_BUCKETS} // total)::INT AS bucket FROM cumul),
buck AS (SELECT *, max(length) OVER (PARTITION BY bucket) AS bucket_width FROM buck0),
placed AS (SELECT doc_id, line_no, length, bucket, bucket_width,
  row_number() OVER (PARTITION BY bucket ORDER BY md5('42|' || doc_id || '|' || line_no), doc_id, line_no) - 1 AS spot,
  greatest({_BUDGET} // greatest(bucket_width, 1), 1) AS fits FROM len_ JOIN buck USING (length)),
assigned AS (SELECT doc_id, line_no, length, bucket, bucket_width, spot // fits AS batch_no, (spot % fits + 1)::INT AS pos_in_batch FROM placed)"""


def _assigned(spark, sf_dir):
    from candor.functions import text as T
    from candor.operators.length_buckets import assign

    lines = doc_lines(spark, sf_dir).select("doc_id", "line_no", T.regex_word_count("text").alias("n"))
    return assign(lines, ["doc_id", "line_no"], "n", _LONGEST, _BUCKETS, _BUDGET)


@register("length_buckets", f"WITH {_BUCKET_CTE} SELECT * FROM assigned")
def q_length_buckets(spark, sf_dir):
    return _assigned(spark, sf_dir)


@register("bucket_shapes", f"""WITH {_BUCKET_CTE}
SELECT bucket, batch_no, count(*) AS rows, max(length) AS width, sum(length)::BIGINT AS tokens,
  round(CASE WHEN count(*) * max(length) > 0 THEN 1.0 - sum(length) / (count(*) * max(length)) ELSE 0.0 END, {_DIGITS}) AS padding_share
FROM assigned GROUP BY bucket, batch_no""")
def q_bucket_shapes(spark, sf_dir):
    from candor.operators.length_buckets import shapes

    return shapes(_assigned(spark, sf_dir)).withColumn("padding_share", F.round("padding_share", _DIGITS))


# =============================================================================================
# Files: lines and candidate CSV written to the checkpoint folder and read back
# =============================================================================================

def _folder(spark, name: str) -> str:
    import uuid

    from candor.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@register("file_lines", f"""WITH {O.lines_cte()}
SELECT lang, count(*) AS rows, sum(length(text))::BIGINT AS chars, max(md5(text)) AS last_md5, true AS dense FROM lines GROUP BY lang""")
def q_file_lines(spark, sf_dir):
    """Texts as files of one folder per language, read back as lines: per language rows, characters, and whether ordinals run from 1 without gaps in every file."""
    from candor.sources.lines import read_lines

    path = _folder(spark, "lines")
    load_table(spark, sf_dir, "documents").select("lang", "text").write.partitionBy("lang").text(path)
    lines = read_lines(spark, path).withColumn("lang", F.regexp_extract("file", "/lang=([^/]+)/", 1))
    per_file = lines.groupBy("lang", "file").agg(F.count(F.lit(1)).alias("n"), F.max("line_id").alias("last"), F.min("line_id").alias("first"), F.sum("line_id").alias("total"),
                                                 F.sum(F.char_length("text").cast("long")).alias("chars"), F.max(F.md5("text")).alias("top"))
    dense = (F.col("first") == 1) & (F.col("last") == F.col("n")) & (2 * F.col("total") == F.col("n") * (F.col("n") + 1))
    return per_file.groupBy("lang").agg(F.sum("n").alias("rows"), F.sum("chars").alias("chars"), F.max("top").alias("last_md5"), F.min(dense).alias("dense"))


@register("csv_report", ORACLES["mini_report"])
def q_csv_report(spark, sf_dir):
    """The candidate job end to end: rows written as CSV in input order, read back with their types, and reported by mode."""
    from candor.operators import metrics as M
    from candor.plans.queries_ext import _csv_rows, _round_metrics
    from candor.sources.csv_io import read_candidates_csv, write_candidates_csv

    path = _folder(spark, "candidates")
    write_candidates_csv(_csv_rows(spark, sf_dir), path, order=["doc_id", "line_no", "strategy_rank"])
    return _round_metrics(M.mini_report(read_candidates_csv(spark, path)), ["pass_pct", "avg_tokens"])


@register("csv_rows_back", f"""WITH {_CSV_CTE}
SELECT input, output, decoding, tokens_out, constraint_passed, notes FROM csvrows""")
def q_csv_rows_back(spark, sf_dir):
    """Every candidate row as it comes back from the CSV files."""
    from candor.plans.queries_ext import _csv_rows
    from candor.sources.csv_io import read_candidates_csv, write_candidates_csv

    path = _folder(spark, "candidates")
    write_candidates_csv(_csv_rows(spark, sf_dir), path)
    return read_candidates_csv(spark, path)


# =============================================================================================
# Learned substitutions, graph-ranked summaries, uncertainty of strategy differences
# =============================================================================================

_EM = 3


def _em_sql() -> str:
    parts = [f"""WITH {_PAIRS_SQL},
pw AS (SELECT conv_id, turn, {O.regex_words('prompt')} AS a, {O.regex_words('response')} AS b FROM pairs),
pu AS (SELECT * FROM pw WHERE len(a) > 0 AND len(b) > 0),
sa AS (SELECT conv_id, turn, s, count(*) AS n_s FROM (SELECT conv_id, turn, unnest(a) AS s FROM pu) GROUP BY ALL UNION ALL SELECT conv_id, turn, '', 1 FROM pu),
tb AS (SELECT conv_id, turn, t, count(*) AS n_t FROM (SELECT conv_id, turn, unnest(b) AS t FROM pu) GROUP BY ALL),
seen AS MATERIALIZED (SELECT * FROM sa JOIN tb USING (conv_id, turn)),
p0 AS MATERIALIZED (SELECT s, t, 1.0::DOUBLE / count(*) OVER (PARTITION BY s) AS p FROM (SELECT DISTINCT s, t FROM seen))"""]
    for i in range(_EM):
        parts.append(f"""k{i} AS MATERIALIZED (SELECT seen.*, p FROM seen JOIN p{i} USING (s, t)),
z{i} AS (SELECT conv_id, turn, t, sum(n_s * p) AS z FROM k{i} GROUP BY ALL),
c{i} AS MATERIALIZED (SELECT s, t, sum(n_t * n_s * p / z) AS c FROM k{i} JOIN z{i} USING (conv_id, turn, t) GROUP BY ALL),
p{i + 1} AS MATERIALIZED (SELECT s, t, c / sum(c) OVER (PARTITION BY s) AS p FROM c{i})""")
    return ",\n".join(parts) + f"\nSELECT s, t, round(p, 6) AS p FROM p{_EM}"


@register("word_translations", _em_sql())
def q_word_translations(spark, sf_dir):
    from candor.operators.translate import train

    table, _ = train(_pairs_df(spark, sf_dir), ["conv_id", "turn"], "prompt", "response", _EM)
    return table.select("s", "t", F.round("p", 6).alias("p"))


@register("graph_summary")
def q_graph_summary(spark, sf_dir):
    """The best connected sentence of every document; tests hold the dense iteration."""
    from candor.operators.graph_summary import ranked_sentences
    from candor.operators.select import choose, with_texts
    from candor.operators.summarize import sentences

    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    won = choose(ranked_sentences(docs, ["doc_id"]), ["doc_id"], strategy_rows(["greedy"]))
    best = with_texts(won, docs, ["doc_id"], sentences).select("doc_id", F.col("choices")[0].alias("c"))
    return best.select("doc_id", "c.cand_id", "c.score", "c.text")


_REPLICATES = 200


def _intervals_sql() -> str:
    from candor.operators.bootstrap import CUMULATIVE
    from candor.plans.queries_ext import _long_cte

    weight = " + ".join(f"(u >= {c!r}::DOUBLE)::INT" for c in CUMULATIVE)
    return f"""WITH {_long_cte()},
v AS (SELECT doc_id, decoding, {O.ws_word_count('output')}::DOUBLE AS v FROM longt),
u AS (SELECT doc_id, b, CASE WHEN b = 0 THEN 2 ELSE (('0x' || substr(md5('42|' || doc_id || '|' || b), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE END AS u
  FROM (SELECT DISTINCT doc_id FROM v), range({_REPLICATES + 1}) r(b)),
wt AS (SELECT doc_id, b, CASE WHEN b = 0 THEN 1 ELSE {weight} END AS wgt FROM u),
m AS (SELECT decoding, b, sum(wgt * v) / nullif(sum(wgt), 0) AS mean FROM v JOIN wt USING (doc_id) GROUP BY ALL),
d AS (SELECT x.decoding, x.b, x.mean - y.mean AS d FROM m x JOIN m y ON x.b = y.b AND y.decoding = 'greedy' WHERE x.decoding <> 'greedy'),
r AS (SELECT *, row_number() OVER (PARTITION BY decoding ORDER BY d, b) AS rn, count(*) OVER (PARTITION BY decoding) AS n FROM d WHERE b > 0 AND d IS NOT NULL),
i AS (SELECT decoding, max(d) FILTER (rn = greatest(ceil(n * 0.025::DOUBLE), 1)) AS low, max(d) FILTER (rn = greatest(ceil(n * 0.975::DOUBLE), 1)) AS high FROM r GROUP BY decoding)
SELECT d.decoding, round(d.d, {_DIGITS}) AS difference, round(low, {_DIGITS}) AS low, round(high, {_DIGITS}) AS high FROM d JOIN i USING (decoding) WHERE d.b = 0"""


@register("strategy_intervals", _intervals_sql())
def q_strategy_intervals(spark, sf_dir):
    """Difference of mean output words against greedy, with paired bootstrap intervals."""
    from candor.functions import text as T
    from candor.operators import bootstrap as B
    from candor.plans.queries_ext import _long

    rows = _long(spark, sf_dir).select("doc_id", "decoding", T.ws_word_count("output").alias("n"))
    out = B.paired_intervals(B.replicate_means(rows, ["doc_id"], F.col("n"), replicates=_REPLICATES).checkpoint(eager=True), "greedy")
    return out.select("decoding", *[F.round(c, _DIGITS).alias(c) for c in ("difference", "low", "high")])


# =============================================================================================
# Learned sentence bounds
# =============================================================================================

def _bounds_sql() -> str:
    from candor.operators import sentence_bounds as B

    core = lambda x: f"regexp_replace(regexp_replace(lower({x}), {O.S(B.OPENING)}, ''), {O.S(B.CLOSING)}, '')"
    dotted = lambda c: f"regexp_matches({c}, '[^.]\\.$')"
    typed = lambda c: f"CASE WHEN {dotted(c)} THEN left({c}, length({c}) - 1) ELSE {c} END"
    part = lambda seen, product: f"CASE WHEN {seen} > 0 THEN {seen} * ln({seen} * total / ({product})) ELSE 0 END"

    def ratio(both, a, b):
        cells = [(both, f"({a}) * ({b})"), (f"(({a}) - ({both}))", f"({a}) * (total - ({b}))"), (f"(({b}) - ({both}))", f"(total - ({a})) * ({b})"),
                 (f"(total - ({a}) - ({b}) + ({both}))", f"(total - ({a})) * (total - ({b}))")]
        return "2 * (" + " + ".join(part(*c) for c in cells) + ")"

    letters = "length(replace(t, '.', ''))"
    return f"""WITH bd AS (SELECT doc_id, {O.ws_tokens('text')} AS ts FROM documents),
be AS (SELECT doc_id, unnest(ts) AS x, unnest(list_concat(ts[2:], [NULL])) AS y FROM bd WHERE len(ts) > 0),
bc AS (SELECT doc_id, {core('x')} AS c, y FROM be),
bt AS MATERIALIZED (SELECT doc_id, c, y, {dotted('c')} AS dot, regexp_matches(c, '([!?]|\\.\\.)$') AS fin, {typed('c')} AS t FROM bc),
types AS MATERIALIZED (SELECT t, count(*) FILTER (dot) AS c1, count(*) FILTER (NOT dot) AS c0 FROM bt GROUP BY t),
tot AS (SELECT least(greatest(sum(c1)::DOUBLE / sum(c1 + c0)::DOUBLE, 1e-9::DOUBLE), 1 - 1e-9::DOUBLE) AS p FROM types),
abbr AS MATERIALIZED (SELECT t FROM types, tot WHERE c1 > 0 AND {letters} > 0 AND regexp_matches(t, '\\p{{L}}') AND NOT regexp_matches(t, '[!?]')
  AND -2 * (c1 * ln(p) + c0 * ln(1 - p) - c1 * ln(0.99::DOUBLE) - c0 * ln(0.01::DOUBLE)) * exp(-{letters}) * (length(t) - {letters} + 1) * pow({letters}::DOUBLE, -c0::DOUBLE) >= {B.ABBREVIATION}::DOUBLE),
mk0 AS (SELECT bt.t, {core('y')} AS yc, dot, fin OR (dot AND abbr.t IS NULL) AS ends, dot AND abbr.t IS NULL AND regexp_matches(bt.t, {O.S(B.SHORT)}) AS short
  FROM bt LEFT JOIN abbr ON abbr.t = bt.t WHERE y IS NOT NULL),
mk AS MATERIALIZED (SELECT t, {typed('yc')} AS w, ends, short FROM mk0),
words AS MATERIALIZED (SELECT w, count(*) AS n, count(*) FILTER (ends) AS k FROM mk GROUP BY w),
all_ AS (SELECT sum(n)::DOUBLE AS total, sum(k)::DOUBLE AS breaks FROM words),
starters AS MATERIALIZED (SELECT w FROM words, all_ WHERE k * total > n * breaks AND regexp_matches(w, '\\p{{L}}') AND {ratio('k', 'n', 'breaks')} >= {B.STARTER}::DOUBLE),
prs AS (SELECT t, w, count(*) AS joint FROM mk WHERE short GROUP BY ALL HAVING count(*) > 1),
tied AS MATERIALIZED (SELECT t, w FROM (SELECT prs.t, prs.w, joint, c1, n, total FROM prs JOIN types USING (t) JOIN words USING (w), all_)
  WHERE joint * total > c1 * n AND {ratio('joint', 'c1', 'n')} >= {B.COLLOCATION}::DOUBLE),
en0 AS (SELECT doc_id, t, dot, {core('y')} AS yc, regexp_matches(regexp_replace(y, {O.S(B.OPENING)}, ''), '^\\p{{Lu}}') AS capital FROM bt WHERE y IS NOT NULL AND (dot OR fin)),
en AS (SELECT doc_id, t, dot, {typed('yc')} AS w, capital FROM en0),
ju AS (SELECT doc_id, dot AND CASE WHEN abbr.t IS NOT NULL THEN NOT (starters.w IS NOT NULL AND capital) ELSE tied.t IS NOT NULL END AS inside
  FROM en LEFT JOIN abbr ON abbr.t = en.t LEFT JOIN starters ON starters.w = en.w LEFT JOIN tied ON tied.t = en.t AND tied.w = en.w),
sm AS (SELECT doc_id, count(*) FILTER (NOT inside) AS ends, count(*) FILTER (inside) AS inner_ FROM ju GROUP BY doc_id)
SELECT doc_id, CASE WHEN len(ts) > 0 THEN coalesce(ends, 0) + 1 ELSE 0 END AS n_sentences, coalesce(inner_, 0) AS n_inner_periods FROM bd LEFT JOIN sm USING (doc_id)"""


@register("sentence_bounds", _bounds_sql())
def q_sentence_bounds(spark, sf_dir):
    from candor.operators.sentence_bounds import count_sentences, learn

    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_sentences(docs, ["doc_id"], learn(docs))
