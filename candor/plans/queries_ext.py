"""Registered queries built on the operators (candidates, guardrails, metrics, classification,
token batches) and their DuckDB oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from candor import constants as K
from candor.functions import rules as R
from candor.functions import text as T
from candor.operators import metrics as M
from candor.operators.strategies import strategy_rows
from candor.operators.summarize import SENTENCE, scored_sentences
from candor.plans import oracle as O
from candor.plans.queries import _reason_rules, _sql_rules_rewrite, _sql_rules_split, register
from candor.sources.lines import load_table

# =============================================================================================
# Scored sentence candidates (shared by the candidate queries)
# =============================================================================================


def _docs(spark, sf_dir):
    return load_table(spark, sf_dir, "documents")


def _chosen(spark, sf_dir, strategy):
    """The one choice of a strategy per document: ``doc_id, cand_id, text, score, prob``."""
    from candor.plans.jobs import chosen_sentences

    won = chosen_sentences(_docs(spark, sf_dir), ["doc_id"], [strategy])
    return won.select("doc_id", F.col("choices")[0].alias("c")).select("doc_id", "c.cand_id", "c.text", "c.score", "c.prob")


def _scored_cte(keep: str = "") -> str:
    """DuckDB: sentences of documents with their rounded mean-idf score -> ``scored``."""
    sent = O.S(SENTENCE)
    return f"""
sdocs AS (SELECT doc_id{keep}, regexp_extract_all({O.collapse_ws('text')}, {sent}) AS ss FROM documents),
sraw AS (SELECT doc_id{keep}, unnest(ss) AS raw, unnest(generate_series(1, len(ss))) AS cand_id FROM sdocs),
cands AS (SELECT doc_id{keep}, CAST(cand_id AS BIGINT) AS cand_id, trim(raw) AS text FROM sraw WHERE trim(raw) <> ''),
ctoks AS (SELECT doc_id, cand_id, unnest({O.regex_words('text')}) AS tok FROM cands),
ctf AS (SELECT doc_id, cand_id, tok, count(*) AS tf FROM ctoks GROUP BY doc_id, cand_id, tok),
cdf AS (SELECT tok, count(DISTINCT doc_id) AS df FROM ctf GROUP BY tok),
cnd AS (SELECT count(DISTINCT doc_id) AS n FROM cands),
csc AS (SELECT ctf.doc_id, ctf.cand_id, sum(tf * ln(CAST(cnd.n AS DOUBLE) / df)) / sum(tf) AS s
        FROM ctf JOIN cdf USING (tok) CROSS JOIN cnd GROUP BY ctf.doc_id, ctf.cand_id),
scored AS MATERIALIZED (SELECT c.*, round(coalesce(csc.s, 0.0), 9) AS score FROM cands c LEFT JOIN csc USING (doc_id, cand_id))"""


def _dbl(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def _best_sql(src: str = "scored", name: str = "best", keys: str = "doc_id") -> str:
    return f"""{name} AS (SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY score DESC, cand_id) AS _rn FROM {src}) WHERE _rn = 1)"""


def _sample_sql(strategy: str, temperature, top_p, top_k, src: str = "scored", name: str = "sampled",
                seed: int = K.DEFAULT_SEED, keys: str = "doc_id") -> str:
    t = _dbl(1.0 if temperature is None else temperature)
    p = _dbl(2.0 if top_p is None else top_p)
    cut = f"WHERE _rn <= {int(top_k)}" if top_k else ""
    key_parts = ", ".join(f"CAST({c.strip()} AS VARCHAR)" for c in keys.split(","))
    u = (f"((('0x' || substr(md5(concat_ws('|', '{seed}', {key_parts}, {O.S(strategy)}, "
         f"CAST(cand_id AS VARCHAR))), 1, 13))::BIGINT + 0.5) / 4503599627370496.0)")
    return f"""
{name}_rk AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY score DESC, cand_id) AS _rn FROM {src}),
{name}_z AS (SELECT *, exp(score / {t} - max(score / {t}) OVER (PARTITION BY {keys})) AS _z FROM {name}_rk {cut}),
{name}_p AS (SELECT *, _z / sum(_z) OVER (PARTITION BY {keys}) AS _p FROM {name}_z),
{name}_c AS (SELECT *, round(coalesce(sum(_p) OVER (PARTITION BY {keys} ORDER BY score DESC, cand_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0), 9) AS _before FROM {name}_p),
{name}_r AS (SELECT *, -ln({u}) / _p AS _race FROM {name}_c WHERE _before < {p}),
{name} AS (SELECT * EXCLUDE (_rn, _z, _p, _before, _race, _r2), _p AS prob FROM
           (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY _race, cand_id) AS _r2 FROM {name}_r) WHERE _r2 = 1)"""


_GB, _SS, _GR = strategy_rows(["summary_beam", "summary_sampling", "summary_retry"])


@register("scored_candidates", f"WITH {_scored_cte()} SELECT doc_id, cand_id, text, score FROM scored")
def q_scored_candidates(spark, sf_dir):
    return scored_sentences(_docs(spark, sf_dir)).select("doc_id", "cand_id", "text", "score")


@register("summary_best", f"""WITH {_scored_cte()}, {_best_sql()}
SELECT doc_id, cand_id, text, score, {O.first_sentence('text')} AS summary FROM best""")
def q_summary_best(spark, sf_dir):
    best = _chosen(spark, sf_dir, _GB)
    return best.select("doc_id", "cand_id", "text", "score", T.first_sentence("text").alias("summary"))


@register("summary_sampled", f"""WITH {_scored_cte()},
{_sample_sql('sampling', _SS['temperature'], _SS['top_p'], _SS['top_k'])}
SELECT doc_id, cand_id, text, score, round(prob, 9) AS prob, {O.first_sentence('text')} AS summary FROM sampled""")
def q_summary_sampled(spark, sf_dir):
    s = _chosen(spark, sf_dir, _SS)
    return s.select("doc_id", "cand_id", "text", "score", F.round("prob", 9).alias("prob"),
                    T.first_sentence("text").alias("summary"))


# =============================================================================================
# Strategy comparison: greedy / beam / sampling per document
# =============================================================================================

_STUDY = ["greedy", "beam", "sampling"]
_STUDY_ROWS = strategy_rows(_STUDY)


def _long(spark, sf_dir, keep=None):
    from candor.plans.jobs import strategy_candidates

    return strategy_candidates(_docs(spark, sf_dir), ["doc_id"], _STUDY_ROWS, keep=keep)


def _long_cte(keep: str = "") -> str:
    smp = _STUDY_ROWS[2]
    cols = f"doc_id{keep}"
    return f"""{_scored_cte(keep)}, {_best_sql()},
{_sample_sql('sampling', smp['temperature'], smp['top_p'], smp['top_k'])},
long AS MATERIALIZED (
  SELECT {cols}, 'greedy' AS decoding, 0 AS strategy_rank, cand_id, text AS output FROM best
  UNION ALL SELECT {cols}, 'beam', 1, cand_id, text FROM best
  UNION ALL SELECT {cols}, 'sampling', 2, cand_id, text FROM sampled),
longt AS (SELECT *, {O.ws_tokens('output', lower=True)} AS _toks FROM long)"""


@register("candidates_long", f"WITH {_long_cte()} SELECT doc_id, decoding, strategy_rank, cand_id, output FROM long")
def q_candidates_long(spark, sf_dir):
    return _long(spark, sf_dir).select("doc_id", "decoding", "strategy_rank", "cand_id", "output")


@register("candidates_wide", f"""WITH {_long_cte()}
SELECT doc_id, max(CASE WHEN decoding = 'greedy' THEN output END) AS greedy,
  max(CASE WHEN decoding = 'beam' THEN output END) AS beam,
  max(CASE WHEN decoding = 'sampling' THEN output END) AS sampling
FROM long GROUP BY doc_id""")
def q_candidates_wide(spark, sf_dir):
    from candor.plans.jobs import wide_candidates

    return wide_candidates(_long(spark, sf_dir), ["doc_id"], _STUDY)


def _eval_cols_sql(x: str = "output") -> str:
    wc = O.ws_word_count(x)
    ok = f"({O.terminator_runs(x)} = 1 AND {O.ends_with_period(O.strip_ws(x))} AND {wc} BETWEEN {K.WORD_LOW} AND {K.WORD_HIGH})"
    return f"""round(coalesce(100.0 * avg(CASE WHEN {ok} THEN 1.0 ELSE 0.0 END), 0.0), 9) AS pass_pct,
  round(coalesce(avg({wc}), 0.0), 9) AS avg_wc,
  round(coalesce(stddev_pop({wc}), 0.0), 9) AS std_wc,
  round(coalesce(100.0 * avg(CASE WHEN {O.has_repeated_ngram('_toks', 2)} THEN 1.0 ELSE 0.0 END), 0.0), 9) AS repeat_pct"""


def _round_metrics(df, cols):
    return df.select(*[F.round(c, 9).alias(c) if c in cols else F.col(c) for c in df.columns])


_METRIC_COLS = ["pass_pct", "avg_wc", "std_wc", "repeat_pct"]


@register("strategy_eval", f"WITH {_long_cte()} SELECT decoding, {_eval_cols_sql()} FROM longt GROUP BY decoding")
def q_strategy_eval(spark, sf_dir):
    return _round_metrics(M.strategy_eval(_long(spark, sf_dir), names=_STUDY), _METRIC_COLS)


@register("family_rollup", f"""WITH {_long_cte(', lang')}
SELECT lang, decoding, count(*) AS n, {_eval_cols_sql()} FROM longt GROUP BY ROLLUP (lang, decoding)""")
def q_family_rollup(spark, sf_dir):
    return _round_metrics(M.family_rollup(_long(spark, sf_dir, keep=["lang"]), family="lang"), _METRIC_COLS)


def _reason_sql_expr(x: str) -> str:
    rules = _reason_rules(x)
    return f"coalesce(nullif({O.concat_notes(rules, K.REASON_SEP)}, ''), {O.S(K.REASON_NONE)})"


@register("failures_listed", f"""WITH {_long_cte()},
r AS (SELECT doc_id, decoding, output, {_reason_sql_expr('output')} AS reason FROM longt)
SELECT doc_id, decoding, output, reason FROM r WHERE reason <> {O.S(K.REASON_NONE)}""")
def q_failures_listed(spark, sf_dir):
    return M.failures_listed(_long(spark, sf_dir), keys=["doc_id"])


@register("reason_histogram", f"""WITH {_long_cte()},
r AS (SELECT decoding, {_reason_sql_expr('output')} AS reason FROM longt),
e AS (SELECT decoding, unnest(string_split(reason, {O.S(K.REASON_SEP)})) AS reason FROM r WHERE reason <> {O.S(K.REASON_NONE)})
SELECT decoding, reason, count(*) AS n FROM e GROUP BY decoding, reason""")
def q_reason_histogram(spark, sf_dir):
    listed = M.failures_listed(_long(spark, sf_dir), keys=["doc_id"])
    return M.reason_histogram(listed, notes_col="reason", sep=K.REASON_SEP)


@register("all_passed_strategies", f"""WITH {_long_cte()},
r AS (SELECT decoding, {_reason_sql_expr('output')} AS reason FROM longt),
s(decoding) AS (VALUES ('greedy'), ('beam'), ('sampling'))
SELECT decoding, {O.S(K.ALL_PASSED)} AS status FROM s
WHERE decoding NOT IN (SELECT decoding FROM r WHERE reason <> {O.S(K.REASON_NONE)})""")
def q_all_passed(spark, sf_dir):
    listed = M.failures_listed(_long(spark, sf_dir), keys=["doc_id"])
    names = spark.createDataFrame([(n,) for n in _STUDY], "decoding STRING")
    return M.all_passed_strategies(names, listed)


@register("skipped_rows", f"""WITH {_long_cte()}
SELECT count(*) FILTER (WHERE decoding IN ('beam', 'sampling')) AS kept,
       count(*) FILTER (WHERE decoding NOT IN ('beam', 'sampling') OR decoding IS NULL) AS skipped FROM long""")
def q_skipped_rows(spark, sf_dir):
    return M.skipped_rows(_long(spark, sf_dir), ["beam", "sampling"])


# =============================================================================================
# Guarded summarize: beam, sampling baseline, retry of failures, metrics and report lines
# =============================================================================================

def _guarded(spark, sf_dir, docs=None, keep=None):
    from candor.plans.jobs import guarded_summaries

    return guarded_summaries(_docs(spark, sf_dir) if docs is None else docs, ["doc_id"], _GB, _SS, _GR, keep=keep)


def _summary_post_sql(src: str, name: str) -> str:
    s = O.first_sentence("text")
    x = O.collapse_ws(s)
    rules = _sql_rules_rewrite(x)[:2]
    fails = " OR ".join(f"({c})" for _, c in rules)
    return f"""{name} AS (SELECT doc_id, {s} AS summary, NOT ({fails}) AS passed, {O.concat_notes(rules, K.NOTES_SEP)} AS notes,
  {O.ws_word_count(s)} AS words FROM {src})"""


_GUARD_CTE = f"""{_scored_cte()}, {_best_sql()},
{_sample_sql('sampling', _SS['temperature'], _SS['top_p'], _SS['top_k'])},
{_summary_post_sql('best', 'gb')}, {_summary_post_sql('sampled', 'gs')},
rsrc AS (SELECT * FROM scored WHERE doc_id IN (SELECT doc_id FROM gb WHERE NOT passed)),
{_sample_sql('retry', _GR['temperature'], _GR['top_p'], _GR['top_k'], src='rsrc', name='rdraw')},
{_summary_post_sql('rdraw', 'gr')},
guarded AS (
  SELECT gb.doc_id, gb.summary, gb.passed, gb.notes, gb.words,
         gs.summary AS sampled_summary, gs.passed AS sampled_passed, gs.words AS sampled_words,
         NOT gb.passed AS retried, gr.summary AS retry_summary, coalesce(gr.passed, false) AS retry_passed
  FROM gb JOIN gs USING (doc_id) LEFT JOIN gr USING (doc_id))"""


@register("retry_summary", f"WITH {_GUARD_CTE} SELECT * FROM guarded")
def q_retry_summary(spark, sf_dir):
    return _guarded(spark, sf_dir).select(
        "doc_id", "summary", "passed", "notes", "words", "sampled_summary", "sampled_passed", "sampled_words",
        "retried", "retry_summary", "retry_passed",
    )


_GUARD_METRIC_SQL = """count(*) AS n,
  round(coalesce(100.0 * avg(CASE WHEN passed THEN 1.0 ELSE 0.0 END), 0.0), 9) AS beam_pass_pct,
  round(coalesce(100.0 * avg(CASE WHEN sampled_passed THEN 1.0 ELSE 0.0 END), 0.0), 9) AS sampling_pass_pct,
  round(coalesce(avg(words), 0.0), 9) AS avg_words_beam,
  round(coalesce(avg(sampled_words), 0.0), 9) AS avg_words_sampling,
  count(*) FILTER (WHERE retried) AS retry_triggered,
  round(coalesce(100.0 * (count(*) FILTER (WHERE retried AND retry_passed)) / nullif(count(*) FILTER (WHERE retried), 0), 0.0), 9) AS retry_fix_pct"""
_GUARD_METRIC_COLS = ["beam_pass_pct", "sampling_pass_pct", "avg_words_beam", "avg_words_sampling", "retry_fix_pct"]


@register("guardrail_metrics", f"WITH {_GUARD_CTE} SELECT {_GUARD_METRIC_SQL} FROM guarded")
def q_guardrail_metrics(spark, sf_dir):
    return _round_metrics(M.guardrail_metrics(_guarded(spark, sf_dir)), _GUARD_METRIC_COLS)


@register("report_lines", f"""WITH {_GUARD_CTE}, d AS (SELECT doc_id, {O.strip_ws('text')} AS input FROM documents)
SELECT doc_id,
  printf('%02d. beam_pass=%s | words=%02d | notes=%s%s%s', doc_id, {O.bool_str('passed')}, words,
         coalesce(nullif(notes, ''), '-'), CASE WHEN retried THEN ' | retry_triggered' ELSE '' END,
         CASE WHEN retry_passed THEN ' | retry_fixed' ELSE '' END) AS status_line,
  '    input : ' || substr(input, 1, {K.PREVIEW_CHARS}) || CASE WHEN length(input) > {K.PREVIEW_CHARS} THEN '...' ELSE '' END AS input_line,
  '    output: ' || summary AS output_line,
  CASE WHEN retried THEN '    retry : ' || retry_summary END AS retry_line
FROM guarded JOIN d USING (doc_id)""")
def q_report_lines(spark, sf_dir):
    from candor.operators.report import status_lines

    # The preview is cut before any shuffle.
    docs = _docs(spark, sf_dir).select("doc_id", "text", T.preview(T.strip_ws("text")).alias("input"))
    return status_lines(_guarded(spark, sf_dir, docs, ["input"]), "doc_id", "input", "summary")


# =============================================================================================
# Classification: naive Bayes trained on labels.quality, scored per line, neutral band
# =============================================================================================

def _nb(spark, sf_dir, band=K.NEUTRAL_BAND):
    from candor.operators.classify import neutralize, score_naive_bayes, train_naive_bayes
    from candor.plans.queries import doc_lines

    docs = load_table(spark, sf_dir, "documents")
    labels = load_table(spark, sf_dir, "labels")
    train = docs.join(labels, "doc_id").select("text", F.col("quality").alias("y"))
    weights, prior = train_naive_bayes(train)
    scored = score_naive_bayes(doc_lines(spark, sf_dir), ["doc_id", "line_no"], weights, prior)
    return neutralize(scored, band)


_W = O.S(K.REGEX_WORD)
_NB_CTE = f"""{O.lines_cte()},
train AS (SELECT d.text, l.quality AS y FROM documents d JOIN labels l USING (doc_id)),
ttok AS (SELECT y, unnest(regexp_extract_all(lower(text), {_W})) AS tok FROM train),
tcnt AS (SELECT tok, count(*) FILTER (WHERE y = 1) AS c1, count(*) FILTER (WHERE y = 0) AS c0 FROM ttok GROUP BY tok),
tsc AS (SELECT CAST(sum(c1) AS DOUBLE) AS n1, CAST(sum(c0) AS DOUBLE) AS n0, CAST(count(*) AS DOUBLE) AS v FROM tcnt),
tpr AS (SELECT ln((CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE) + 1.0) / (count(*) FILTER (WHERE y = 0) + 1.0)) AS prior FROM train),
wt AS (SELECT tok, ln((CAST(c1 AS DOUBLE) + 1.0) / (n1 + v)) - ln((CAST(c0 AS DOUBLE) + 1.0) / (n0 + v)) AS w FROM tcnt, tsc),
ltok AS (SELECT doc_id, line_no, unnest(regexp_extract_all(lower(text), {_W})) AS tok FROM lines),
ltf AS (SELECT doc_id, line_no, tok, count(*) AS tf FROM ltok GROUP BY doc_id, line_no, tok),
lsum AS (SELECT doc_id, line_no, sum(tf * w) AS s FROM ltf JOIN wt USING (tok) GROUP BY doc_id, line_no),
zz AS (SELECT l.doc_id, l.line_no, round(tpr.prior + coalesce(lsum.s, 0.0), 9) AS z
       FROM lines l LEFT JOIN lsum USING (doc_id, line_no) CROSS JOIN tpr),
nb AS (SELECT doc_id, line_no, z, CASE WHEN z >= 0 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS label,
       round(1.0 / (1.0 + exp(-abs(z))), 9) AS score FROM zz),
nbn AS (SELECT *, CASE WHEN abs(score - CAST(0.5 AS DOUBLE)) <= {_dbl(K.NEUTRAL_BAND)} THEN 'NEUTRAL' ELSE label END AS neutralized FROM nb)"""


@register("nb_scores", f"WITH {_NB_CTE} SELECT doc_id, line_no, z, label, score FROM nb")
def q_nb_scores(spark, sf_dir):
    return _nb(spark, sf_dir).select("doc_id", "line_no", "z", "label", "score")


@register("neutral_band", f"WITH {_NB_CTE} SELECT doc_id, line_no, label, score, neutralized FROM nbn")
def q_neutral_band(spark, sf_dir):
    return _nb(spark, sf_dir).select("doc_id", "line_no", "label", "score", "neutralized")


@register("label_distribution", f"""WITH {_NB_CTE}
SELECT count(*) AS n, count(*) FILTER (WHERE label = 'POSITIVE') AS raw_pos, count(*) FILTER (WHERE label = 'NEGATIVE') AS raw_neg,
  count(*) FILTER (WHERE neutralized = 'POSITIVE') AS pos, count(*) FILTER (WHERE neutralized = 'NEGATIVE') AS neg,
  count(*) FILTER (WHERE neutralized = 'NEUTRAL') AS neu,
  count(*) FILTER (WHERE label NOT IN ('POSITIVE', 'NEGATIVE')) AS unknown_labels FROM nbn""")
def q_label_distribution(spark, sf_dir):
    return M.label_distribution(_nb(spark, sf_dir))


# =============================================================================================
# Token batches over document lines
# =============================================================================================

_BATCH = 12
_MAXLEN = 128


def _batches(spark, sf_dir):
    from candor.operators.batches import assign_batches, build_vocabulary, encode, pad_batches
    from candor.plans.queries import doc_lines

    lines = doc_lines(spark, sf_dir)
    vocab = build_vocabulary(lines)
    enc = encode(lines, ["doc_id", "line_no"], vocab, max_length=_MAXLEN)
    return pad_batches(assign_batches(enc, ["doc_id", "line_no"], _BATCH), ["batch_no"]), vocab


_VOCAB_CTE = f"""{O.lines_cte()},
vtok AS (SELECT doc_id, line_no, unnest(regexp_extract_all(lower(text), {_W})) AS tok,
         unnest(generate_series(0, len(regexp_extract_all(lower(text), {_W})) - 1)) AS pos FROM lines),
vcnt AS (SELECT tok, count(*) AS cnt FROM vtok GROUP BY tok),
vocab AS (SELECT tok, cnt, row_number() OVER (ORDER BY cnt DESC, tok) + 1 AS id FROM vcnt)"""

_BATCH_CTE = f"""{_VOCAB_CTE},
enc0 AS (SELECT doc_id, line_no, list(id ORDER BY pos) AS ids FROM vtok JOIN vocab USING (tok) GROUP BY doc_id, line_no),
enc AS (SELECT l.doc_id, l.line_no, coalesce(e.ids, []::BIGINT[]) AS all_ids, row_number() OVER (ORDER BY l.doc_id, l.line_no) - 1 AS rn
        FROM lines l LEFT JOIN enc0 e USING (doc_id, line_no)),
enc2 AS (SELECT doc_id, line_no, len(all_ids) AS n_tokens, all_ids[1:{_MAXLEN}] AS input_ids,
         rn // {_BATCH} AS batch_no, CAST(rn % {_BATCH} + 1 AS INTEGER) AS pos_in_batch FROM enc),
padded AS (SELECT *, max(len(input_ids)) OVER (PARTITION BY batch_no) AS batch_width FROM enc2),
padded2 AS (SELECT *, list_concat(input_ids, list_transform(range(batch_width - len(input_ids)), lambda x: 0)) AS padded_ids,
            list_concat(list_transform(range(len(input_ids)), lambda x: 1), list_transform(range(batch_width - len(input_ids)), lambda x: 0)) AS attention_mask
            FROM padded)"""


@register("vocabulary", f"WITH {_VOCAB_CTE} SELECT tok, cnt, id FROM vocab")
def q_vocabulary(spark, sf_dir):
    from candor.operators.batches import build_vocabulary
    from candor.plans.queries import doc_lines

    return build_vocabulary(doc_lines(spark, sf_dir))


def _ids_str(c):
    return F.array_join(F.col(c).cast("array<string>"), " ")


@register("token_batches", f"""WITH {_BATCH_CTE}
SELECT doc_id, line_no, batch_no, pos_in_batch, n_tokens, batch_width,
  array_to_string(padded_ids, ' ') AS padded_ids, array_to_string(attention_mask, ' ') AS attention_mask FROM padded2""")
def q_token_batches(spark, sf_dir):
    b, _ = _batches(spark, sf_dir)
    return b.select("doc_id", "line_no", "batch_no", "pos_in_batch", "n_tokens", "batch_width",
                    _ids_str("padded_ids").alias("padded_ids"), _ids_str("attention_mask").alias("attention_mask"))


@register("batch_shapes", f"""WITH {_BATCH_CTE}
SELECT batch_no, count(*) AS rows, max(batch_width) AS width, sum(len(input_ids)) AS tokens,
  array_to_string(arg_max(attention_mask, pos_in_batch), ' ') AS last_mask,
  round(CASE WHEN count(*) * max(batch_width) > 0 THEN 1.0 - sum(len(input_ids)) / (count(*) * max(batch_width)) ELSE 0.0 END, 9) AS padding_share
FROM padded2 GROUP BY batch_no""")
def q_batch_shapes(spark, sf_dir):
    from candor.operators.batches import batch_shapes

    b, _ = _batches(spark, sf_dir)
    s = batch_shapes(b, ["batch_no"])
    return s.select("batch_no", "rows", "width", "tokens", _ids_str("last_mask").alias("last_mask"),
                    F.round("padding_share", 9).alias("padding_share"))


# =============================================================================================
# Rewrites and audits
# =============================================================================================

# Example simplification dictionary (a parameter of the query, not of the operator).
SIMPLER_WORDS = [
    ("approximately", "about"), ("additional", "more"), ("assistance", "help"), ("demonstrate", "show"),
    ("however", "but"), ("numerous", "many"), ("obtain", "get"), ("purchase", "buy"),
    ("sufficient", "enough"), ("therefore", "so"), ("utilize", "use"), ("with", "w/"), ("this", "it"),
]


def _dict_sql() -> str:
    rows = ", ".join(f"({O.S(a)}, {O.S(b)})" for a, b in SIMPLER_WORDS)
    return f"dict(k, rep) AS (VALUES {rows})"


_CORE_SQL = O.S(r"^(.*?)([.,;:!?]*)$")


@register("simplify_words", f"""WITH {O.lines_cte()}, {_dict_sql()},
toks AS (SELECT doc_id, line_no, unnest({O.ws_tokens('text')}) AS tok,
         unnest(generate_series(1, len({O.ws_tokens('text')}))) AS pos FROM lines),
parts AS (SELECT doc_id, line_no, pos, regexp_extract(tok, {_CORE_SQL}, 1) AS core, regexp_extract(tok, {_CORE_SQL}, 2) AS punct FROM toks),
rep AS (SELECT p.*, d.rep FROM parts p LEFT JOIN dict d ON lower(p.core) = d.k),
w AS (SELECT doc_id, line_no, pos, rep IS NOT NULL AS hit,
      coalesce(CASE WHEN substr(core, 1, 1) <> lower(substr(core, 1, 1)) THEN upper(substr(rep, 1, 1)) || substr(rep, 2) ELSE rep END, core) || punct AS w FROM rep),
g AS (SELECT doc_id, line_no, string_agg(w, ' ' ORDER BY pos) AS simplified, count(*) FILTER (WHERE hit) AS n_replaced FROM w GROUP BY doc_id, line_no)
SELECT l.doc_id, l.line_no, coalesce(g.simplified, '') AS simplified, coalesce(g.n_replaced, 0) AS n_replaced
FROM lines l LEFT JOIN g USING (doc_id, line_no)""")
def q_simplify_words(spark, sf_dir):
    from candor.operators.rewrite import simplify_words
    from candor.plans.queries import doc_lines

    out = simplify_words(doc_lines(spark, sf_dir), ["doc_id", "line_no"], SIMPLER_WORDS)
    return out.select("doc_id", "line_no", "simplified", F.col("n_replaced").cast("bigint").alias("n_replaced"))


def _pairs_df(spark, sf_dir):
    from candor.plans.jobs import conversation_pairs

    return conversation_pairs(load_table(spark, sf_dir, "conversations"))


_PAIRS_SQL = """pairs AS (SELECT u.conv_id, u.turn, u.text AS prompt, a.text AS response
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""


@register("conversation_pairs", f"WITH {_PAIRS_SQL} SELECT conv_id, turn, prompt, response FROM pairs")
def q_conversation_pairs(spark, sf_dir):
    return _pairs_df(spark, sf_dir).select("conv_id", "turn", "prompt", "response")


def _copied_sql(n: int) -> str:
    return f"len(list_intersect(list_distinct({O.ngrams('rt', n)}), {O.ngrams('pt', n)}))"


@register("copied_ngrams", f"""WITH {_PAIRS_SQL},
t AS MATERIALIZED (SELECT *, {O.ws_tokens('response', lower=True)} AS rt, {O.ws_tokens('prompt', lower=True)} AS pt FROM pairs)
SELECT conv_id, turn, {_copied_sql(4)} AS copied_4grams, {_copied_sql(4)} > 0 AS copied_any,
  {O.has_repeated_ngram('rt', 3)} AS repeated_3gram, {O.unchanged('response', 'prompt')} AS unchanged
FROM t""")
def q_copied_ngrams(spark, sf_dir):
    c = T.copied_ngram_count("prompt", "response", 4)
    return _pairs_df(spark, sf_dir).select(
        "conv_id", "turn", c.alias("copied_4grams"), (c > 0).alias("copied_any"),
        T.has_repeated_ngram("response", 3).alias("repeated_3gram"), T.unchanged("response", "prompt").alias("unchanged"),
    )


def _grams_sql(src: str, key: str, n: int) -> str:
    return f"SELECT {key}, unnest({O.ngrams('_toks', n)}) AS gram FROM {src}"


@register("benchmark_overlap", f"""WITH {O.line_tokens_cte('tb', 'benchmark')}, {O.line_tokens_cte('td', 'documents')},
ref AS (SELECT DISTINCT gram FROM ({_grams_sql('tb', 'item_id', 4)})),
dg AS (SELECT DISTINCT doc_id, gram FROM ({_grams_sql('td', 'doc_id', 4)}) WHERE gram IN (SELECT gram FROM ref))
SELECT doc_id, count(*) AS shared_ngrams FROM dg GROUP BY doc_id""")
def q_benchmark_overlap(spark, sf_dir):
    from candor.operators.rewrite import corpus_overlap

    return corpus_overlap(load_table(spark, sf_dir, "documents"), load_table(spark, sf_dir, "benchmark"), 4)


# =============================================================================================
# Batch rewrite of lines: beam vs sampling, CSV rows (annotate-unchanged rules), mini report
# =============================================================================================

_RB, _RS = strategy_rows(["rewrite_beam", "rewrite_sampling"])


def _csv_rows(spark, sf_dir):
    from candor.plans.jobs import rewrite_candidates
    from candor.plans.queries import doc_lines

    return rewrite_candidates(doc_lines(spark, sf_dir), ["doc_id", "line_no"], [_RB, _RS])


_LK = "doc_id, line_no"
_LINE_SCORED_CTE = f"""{O.lines_cte()},
lsent AS (SELECT doc_id, line_no, text AS input, regexp_extract_all({O.collapse_ws('text')}, {O.S(SENTENCE)}) AS ss FROM lines),
lraw AS (SELECT doc_id, line_no, input, unnest(ss) AS raw, unnest(generate_series(1, len(ss))) AS cand_id FROM lsent),
lc AS (SELECT doc_id, line_no, input, CAST(cand_id AS BIGINT) AS cand_id, trim(raw) AS text FROM lraw WHERE trim(raw) <> ''),
ltk AS (SELECT doc_id, line_no, cand_id, unnest({O.regex_words('text')}) AS tok FROM lc),
ltf2 AS (SELECT doc_id, line_no, cand_id, tok, count(*) AS tf FROM ltk GROUP BY doc_id, line_no, cand_id, tok),
ldf AS (SELECT tok, count(*) AS df FROM (SELECT DISTINCT doc_id, line_no, tok FROM ltf2) GROUP BY tok),
lnd AS (SELECT count(*) AS n FROM (SELECT DISTINCT doc_id, line_no FROM lc)),
lsc AS (SELECT ltf2.doc_id, ltf2.line_no, ltf2.cand_id, sum(tf * ln(CAST(lnd.n AS DOUBLE) / df)) / sum(tf) AS s
        FROM ltf2 JOIN ldf USING (tok) CROSS JOIN lnd GROUP BY ltf2.doc_id, ltf2.line_no, ltf2.cand_id),
lscored AS MATERIALIZED (SELECT c.*, round(coalesce(lsc.s, 0.0), 9) AS score FROM lc c LEFT JOIN lsc USING (doc_id, line_no, cand_id)),
{_best_sql('lscored', 'lbest', _LK)}"""

_CSV_CTE = f"""{_LINE_SCORED_CTE},
{_sample_sql('sampling', _RS['temperature'], _RS['top_p'], _RS['top_k'], src='lscored', name='lsamp', keys=_LK)},
lout AS (SELECT doc_id, line_no, input, text AS output, 'beam' AS decoding, 0 AS strategy_rank FROM lbest
         UNION ALL SELECT doc_id, line_no, input, text, 'sampling', 1 FROM lsamp),
lnorm AS (SELECT doc_id, line_no, input, {O.collapse_ws('output')} AS output, decoding, strategy_rank FROM lout),
csvrows AS (SELECT doc_id, line_no, input, output, decoding, strategy_rank, {O.ws_word_count('output')} AS tokens_out,
  NOT ({" OR ".join(f"({c})" for _, c in _sql_rules_split('output', O.ws_word_count('output')))}) AS constraint_passed,
  CASE WHEN {O.concat_notes(_sql_rules_split('output', O.ws_word_count('output')), K.NOTES_SEP)} = '' AND {O.unchanged('output', 'input')}
       THEN {O.S(K.MSG_UNCHANGED)} ELSE {O.concat_notes(_sql_rules_split('output', O.ws_word_count('output')), K.NOTES_SEP)} END AS notes
  FROM lnorm)"""


@register("csv_candidates", f"""WITH {_CSV_CTE}
SELECT doc_id, line_no, input, output, decoding, strategy_rank, tokens_out, constraint_passed, notes FROM csvrows""")
def q_csv_candidates(spark, sf_dir):
    return _csv_rows(spark, sf_dir).select("doc_id", "line_no", "input", "output", "decoding", "strategy_rank",
                                           "tokens_out", "constraint_passed", "notes")


@register("mini_report", f"""WITH {_CSV_CTE},
m(decoding) AS (VALUES ('beam'), ('sampling')),
a AS (SELECT decoding, count(*) AS rows, 100.0 * avg(CASE WHEN constraint_passed THEN 1.0 ELSE 0.0 END) AS pass_pct,
      avg(tokens_out) AS avg_tokens FROM csvrows GROUP BY decoding)
SELECT m.decoding, coalesce(a.rows, 0) AS rows, round(coalesce(a.pass_pct, 0.0), 9) AS pass_pct,
  round(coalesce(a.avg_tokens, 0.0), 9) AS avg_tokens,
  CASE WHEN coalesce(a.rows, 0) = 0 THEN {O.S(K.NO_ROWS)} WHEN m.decoding = 'beam' THEN {O.S(K.REFLECTION_BEAM)}
       ELSE {O.S(K.REFLECTION_SAMPLING)} END AS reflection
FROM m LEFT JOIN a USING (decoding)""")
def q_mini_report(spark, sf_dir):
    rep = M.mini_report(_csv_rows(spark, sf_dir))
    return _round_metrics(rep, ["pass_pct", "avg_tokens"])


# =============================================================================================
# Listing, load counts, length bounds
# =============================================================================================

@register("line_listing", f"""WITH {O.lines_cte()}
SELECT doc_id, line_no, printf('%02d. %s', line_no, text) AS listing FROM lines""")
def q_line_listing(spark, sf_dir):
    from candor.plans.queries import doc_lines

    return doc_lines(spark, sf_dir).select("doc_id", "line_no", F.format_string("%02d. %s", "line_no", "text").alias("listing"))


@register("loaded_lines", f"""WITH doc_parts AS (SELECT doc_id, string_split_regex(text, {O.S(K.LINE_BREAK)}) AS parts FROM documents),
raw AS (SELECT doc_id, unnest(parts) AS raw FROM doc_parts)
SELECT count(DISTINCT doc_id) AS documents, count(*) FILTER (WHERE {O.strip_ws('raw')} <> '') AS lines,
  count(*) FILTER (WHERE {O.strip_ws('raw')} = '') AS blank_lines FROM raw""")
def q_loaded_lines(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents")
    raw = docs.select("doc_id", F.explode(F.split("text", K.LINE_BREAK)).alias("raw")).select(
        "doc_id", T.strip_ws("raw").alias("t"))
    return raw.agg(F.count_distinct("doc_id").alias("documents"), F.count_if(F.col("t") != "").alias("lines"),
                   F.count_if(F.col("t") == "").alias("blank_lines"))


@register("length_audit", f"""WITH {_scored_cte()}, {_best_sql()},
s AS (SELECT doc_id, {O.first_sentence('text')} AS summary FROM best)
SELECT doc_id, {O.ws_word_count('summary')} AS words, {O.ws_word_count('summary')} < {_GB['min_length']} AS too_short,
  {O.ws_word_count('summary')} > {_GB['max_length']} AS too_long FROM s""")
def q_length_audit(spark, sf_dir):
    from candor.operators.rewrite import length_bounds

    best = _chosen(spark, sf_dir, _GB)
    b = length_bounds(T.first_sentence("text"), _GB["min_length"], _GB["max_length"])
    return best.select("doc_id", b.alias("b")).select("doc_id", "b.*")


@register("bounded_summaries", f"""WITH {_scored_cte()}, {_best_sql()},
s AS (SELECT doc_id, {O.first_sentence('text')} AS summary FROM best),
c AS (SELECT doc_id, {O.ws_word_count('summary')} > {_GB['max_length']} AS was_cut,
  CASE WHEN {O.ws_word_count('summary')} > {_GB['max_length']} THEN array_to_string({O.ws_tokens('summary')}[1:{_GB['max_length']}], ' ') ELSE summary END AS summary FROM s)
SELECT doc_id, summary, {O.ws_word_count('summary')} AS words, was_cut, {O.ws_word_count('summary')} < {_GB['min_length']} AS too_short FROM c""")
def q_bounded_summaries(spark, sf_dir):
    from candor.operators.rewrite import cut_words, length_bounds

    best = _chosen(spark, sf_dir, _GB).select("doc_id", T.first_sentence("text").alias("s"))
    out = best.select("doc_id", "s", cut_words("s", _GB["max_length"]).alias("summary"))
    return out.select("doc_id", "summary", T.ws_word_count("summary").alias("words"), length_bounds("s", None, _GB["max_length"])["too_long"].alias("was_cut"),
                      length_bounds("summary", _GB["min_length"])["too_short"].alias("too_short"))


@register("repeat_positions", f"""WITH {O.lines_cte()}, {O.line_tokens_cte()},
g0 AS (SELECT doc_id, line_no, {O.ngrams('_toks', 2)} AS grams FROM tlines),
g AS (SELECT doc_id, line_no, unnest(grams) AS gram, unnest(generate_series(0, len(grams) - 1)) AS pos FROM g0),
s AS (SELECT *, row_number() OVER (PARTITION BY doc_id, line_no, gram ORDER BY pos) AS k FROM g)
SELECT doc_id, line_no, CAST(min(pos) AS INTEGER) AS first_repeat_pos, count(*) AS n_repeats FROM s WHERE k > 1 GROUP BY doc_id, line_no""")
def q_repeat_positions(spark, sf_dir):
    from candor.plans.queries import doc_lines

    return M.repeated_ngram_positions(doc_lines(spark, sf_dir), ["doc_id", "line_no"])


# =============================================================================================
# Batch inference with a (stand-in) user model and retry of failures only
# =============================================================================================

def _guard_cols(x: str, orig: str) -> tuple[str, str]:
    rules = _sql_rules_rewrite(O.collapse_ws(x)) + [(O.S(K.MSG_UNCHANGED), O.unchanged(x, orig))]
    fails = " OR ".join(f"({c})" for _, c in rules)
    return f"NOT ({fails})", O.concat_notes(rules, K.NOTES_SEP)


# =============================================================================================
# Guarded rewrite of lines: beam, sampling baseline, retry of failures, unchanged guard
# =============================================================================================

_WB, _WS, _WR = strategy_rows(["guarded_beam", "guarded_sampling", "guarded_retry"])


def _rewrites(spark, sf_dir):
    from candor.plans.jobs import guarded_rewrites
    from candor.plans.queries import doc_lines

    return guarded_rewrites(doc_lines(spark, sf_dir), ["doc_id", "line_no"], _WB, _WS, _WR)


_O_PASS, _O_NOTES = _guard_cols("output", "input")
_S_PASS, _ = _guard_cols("sampled_output", "input")
_R_PASS, _ = _guard_cols("drawn", "input")
_REWRITE_CTE = f"""{_LINE_SCORED_CTE},
{_sample_sql('sampling', _WS['temperature'], _WS['top_p'], _WS['top_k'], src='lscored', name='wsamp', keys=_LK)},
{_sample_sql('retry', _WR['temperature'], _WR['top_p'], _WR['top_k'], src='lscored', name='wretry', keys=_LK)},
w0 AS MATERIALIZED (SELECT b.doc_id, b.line_no, b.input, {O.collapse_ws('b.text')} AS output, {O.collapse_ws('s.text')} AS sampled_output,
  {O.collapse_ws('r.text')} AS drawn FROM lbest b JOIN wsamp s USING (doc_id, line_no) JOIN wretry r USING (doc_id, line_no)),
w1 AS MATERIALIZED (SELECT *, {_O_PASS} AS passed, {_O_NOTES} AS notes, {O.ws_word_count('output')} AS words, {_S_PASS} AS sampled_passed,
  {O.ws_word_count('sampled_output')} AS sampled_words, {_R_PASS} AS drawn_passed FROM w0),
rewrites AS (SELECT doc_id, line_no, input, output, passed, notes, words, sampled_output, sampled_passed, sampled_words, NOT passed AS retried,
  CASE WHEN NOT passed THEN drawn END AS retry_output, NOT passed AND drawn_passed AS retry_passed FROM w1)"""


@register("guarded_rewrite", f"WITH {_REWRITE_CTE} SELECT * FROM rewrites")
def q_guarded_rewrite(spark, sf_dir):
    return _rewrites(spark, sf_dir).select("doc_id", "line_no", "input", "output", "passed", "notes", "words", "sampled_output", "sampled_passed",
                                           "sampled_words", "retried", "retry_output", "retry_passed")


@register("guarded_rewrite_metrics", f"WITH {_REWRITE_CTE} SELECT {_GUARD_METRIC_SQL} FROM rewrites")
def q_guarded_rewrite_metrics(spark, sf_dir):
    return _round_metrics(M.guardrail_metrics(_rewrites(spark, sf_dir)), _GUARD_METRIC_COLS)


@register("failures_numbered", f"""WITH {_long_cte()},
r AS (SELECT doc_id, decoding, row_number() OVER (PARTITION BY decoding ORDER BY doc_id) AS ord, {_reason_sql_expr('output')} AS reason FROM longt)
SELECT doc_id, decoding, ord, printf('%02d. %s', ord, reason) AS line FROM r WHERE reason <> {O.S(K.REASON_NONE)}""")
def q_failures_numbered(spark, sf_dir):
    from candor.operators.report import number_within

    # Reasons are found before rows are numbered, so that no text is sorted or kept.
    judged = M.reasons(_long(spark, sf_dir), keys=["doc_id"], keep_text=False)
    listed = M.failing(number_within(judged, ["decoding"], ["doc_id"]))
    return listed.select("doc_id", "decoding", "ord", F.format_string("%02d. %s", "ord", "reason").alias("line"))


@register("sentiment_report", f"""WITH {_NB_CTE}
SELECT n.doc_id, n.line_no, n.neutralized, printf('%02d. raw=%s (%.3f) -> neutralized=%s', n.line_no, n.label, n.score, n.neutralized) AS line,
  '    text: ' || l.text AS text_line FROM nbn n JOIN lines l USING (doc_id, line_no)""")
def q_sentiment_report(spark, sf_dir):
    from candor.plans.jobs import sentiment_job
    from candor.plans.queries import doc_lines

    labels = load_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("y"))
    labelled = _docs(spark, sf_dir).select("doc_id", "text").join(labels, "doc_id")
    report, _ = sentiment_job(doc_lines(spark, sf_dir), ["doc_id", "line_no"], labelled)
    return report.select("doc_id", "line_no", "neutralized", "line", "text_line")


_P1, _N1 = _guard_cols("output", "text")
_P2, _ = _guard_cols("retry_output", "text")


@register("infer_with_retry", f"""WITH {O.lines_cte()},
a AS (SELECT doc_id, line_no, text, {O.first_sentence('text', clean=True)} AS output FROM lines),
v AS (SELECT *, {_P1} AS passed, {_N1} AS notes FROM a),
r AS (SELECT *, CASE WHEN NOT passed THEN {O.first_sentence('text')} END AS retry_output FROM v)
SELECT doc_id, line_no, output, passed, notes, NOT passed AS retried, retry_output,
  CASE WHEN NOT passed THEN {_P2} ELSE false END AS retry_passed FROM r""")
def q_infer_with_retry(spark, sf_dir):
    from candor.operators.infer import stand_in_first_sentence, with_retry
    from candor.plans.queries import doc_lines

    out = with_retry(doc_lines(spark, sf_dir), "text", stand_in_first_sentence(clean=True), stand_in_first_sentence(),
                     lambda c: R.validate_guarded(F.col("text"), c), normalize=False)
    return out.select("doc_id", "line_no", "output", "passed", "notes", "retried", "retry_output", "retry_passed")
