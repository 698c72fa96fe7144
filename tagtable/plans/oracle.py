"""DuckDB SQL for every registered query, for the side-by-side correctness
check. Written independently of the Spark plans: token-form rows with
window functions where the Spark side uses sentence-form array functions.
DuckDB lists are 1-based; its lambdas use ``lambda x, i: ..``."""

from __future__ import annotations

import re

from tagtable import constants as K
from tagtable.sources.fixtures import SENTENCES_SQL, TRIGGERS


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def lits(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


LABELS_LIST = "[" + ", ".join(lit(x) for x in K.LABELS) + "]"


def norm(expr: str) -> str:
    out = expr
    for pattern, repl in K.NORMALIZATION_RULES:
        out = f"regexp_replace({out}, {lit(pattern)}, {lit(re.sub(r'[$](\d)', r'\\\1', repl))}, 'g')"
    return f"regexp_replace({out}, {lit(K.TRIM_PATTERN)}, '', 'g')"


def tokenize(expr: str) -> str:
    return f"list_filter(string_split({expr}, ' '), lambda t: t <> '')"


SENT = SENTENCES_SQL.replace("{orders}", "orders")

NUMBER_PREFIX = r"^(?:[+-]?\p{Nd}+\.\p{Nd}+|[+-]?\p{Nd})"


def _fix_expr() -> str:
    prev = "(CASE WHEN i - 1 >= 2 THEN coalesce(lemmas[i - 1], '') ELSE '' END)"
    cur = "coalesce(lemmas[i], '')"
    nxt = "(CASE WHEN i - 1 < len(tokens) - 1 THEN coalesce(lemmas[i + 1], '') ELSE '' END)"
    tag = "model_tags[i]"
    months, years = lits(K.MONTH_LEMMAS), lits(K.YEAR_PREFIX_LEMMAS)
    money, pct = lits(K.MONEY_LEMMAS), lits(K.PERCENTAGE_LEMMAS)
    number = (f"(CASE WHEN {nxt} IN {months} OR {prev} IN {years} THEN 7 "
              f"WHEN {prev} IN {months} OR {tag} = 7 THEN 8 "
              f"WHEN {nxt} IN {money} THEN 10 WHEN {nxt} IN {pct} THEN 12 ELSE 0 END)")
    return (
        "list_transform(tokens, lambda w, i: CASE "
        f"WHEN w IN {lits(K.ORG_FIX_WORDS)} AND NOT ({tag} IN (3, 4)) THEN 3 "
        r"WHEN regexp_matches(w, '^\p{Nd}{2}:\p{Nd}{2}') THEN 9 "
        f"WHEN regexp_matches(w, {lit(NUMBER_PREFIX)}) THEN {number} "
        f"WHEN {cur} IN {months} THEN (CASE WHEN regexp_matches({prev}, " r"'^\p{Nd}+$'" ") THEN 8 ELSE 7 END) "
        f"WHEN {cur} IN {money} THEN 11 WHEN {cur} IN {pct} THEN 13 ELSE {tag} END)"
    )


# Building blocks (CTE bodies).
CTE_TOK = (
    f"sent AS ({SENT}), "
    f"tok AS (SELECT id, {tokenize(norm('text'))} AS tokens, {tokenize(norm('lemma_text'))} AS lemmas FROM sent)"
)
CTE_ANN = (
    CTE_TOK + ", "
    "ann0 AS (SELECT id, tokens, lemmas, "
    "list_transform(tokens, lambda t, i: ((id * 7 + (i - 1) * 13) % 14)::INTEGER) AS model_tags FROM tok), "
    f"ann AS (SELECT id, tokens, lemmas, model_tags, {_fix_expr()} AS fixed_tags FROM ann0)"
)
# Sub-word pieces in token form: id, pidx, word, entity, pstart, pend.
CTE_PIECES = (
    CTE_TOK + ", "
    "tr AS (SELECT id, unnest(tokens) AS token, generate_subscripts(tokens, 1) - 1 AS k FROM tok), "
    "toff AS (SELECT id, k, token, ((id * 7 + k * 13) % 14) AS tag, "
    "sum(length(token) + 1) OVER (PARTITION BY id ORDER BY k) - length(token) - 1 AS tstart FROM tr), "
    "pc AS (SELECT *, unnest(range(CAST(greatest(ceil(length(token) / 4), 1) AS BIGINT))) AS c FROM toff), "
    "pieces AS (SELECT id, "
    "row_number() OVER (PARTITION BY id ORDER BY k, c) - 1 AS pidx, "
    "(CASE WHEN k > 0 AND c = 0 THEN 'Ġ' ELSE '' END) || substring(token, CAST(c * 4 + 1 AS BIGINT), 4) AS word, "
    f"{LABELS_LIST}[(CASE WHEN c = 0 THEN tag ELSE (tag + 1) % 14 END) + 1] AS entity, "
    "CAST(tstart + c * 4 AS INTEGER) AS pstart, CAST(tstart + least(c * 4 + 4, length(token)) AS INTEGER) AS pend "
    "FROM pc)"
)
CTE_WORDS = (
    CTE_PIECES + ", "
    "pw AS (SELECT *, sum(CASE WHEN pidx > 0 AND starts_with(word, 'Ġ') THEN 1 ELSE 0 END) "
    "OVER (PARTITION BY id ORDER BY pidx) AS word_idx FROM pieces), "
    "words AS (SELECT id, word_idx, arg_min(entity, pidx) AS entity, "
    "regexp_replace(string_agg(word, '' ORDER BY pidx), '^Ġ', '') AS word, "
    "min(pstart) AS wstart, max(pend) AS wend FROM pw GROUP BY id, word_idx)"
)
CTE_CONF = (
    CTE_ANN + ", "
    "pairs AS (SELECT unnest(fixed_tags) AS gold, unnest(model_tags) AS pred FROM ann), "
    "cnt AS (SELECT gold, pred, count(*) AS n FROM pairs WHERE gold IS NOT NULL AND pred IS NOT NULL GROUP BY 1, 2), "
    "grid AS (SELECT CAST(a.g AS INTEGER) AS gold, CAST(b.p AS INTEGER) AS pred FROM range(14) a(g), range(14) b(p)), "
    "conf AS (SELECT grid.gold, grid.pred, CAST(coalesce(cnt.n, 0) AS BIGINT) AS n FROM grid "
    "LEFT JOIN cnt ON grid.gold = cnt.gold AND grid.pred = cnt.pred)"
)
CTE_PC = (
    CTE_CONF + ", "
    "sup AS (SELECT gold AS label, sum(n) AS support, sum(CASE WHEN gold = pred THEN n ELSE 0 END) AS tp "
    "FROM conf GROUP BY gold), "
    "prd AS (SELECT pred AS label, sum(n) AS predicted FROM conf GROUP BY pred), "
    "pc0 AS (SELECT coalesce(s.label, p.label) AS label, CAST(coalesce(support, 0) AS BIGINT) AS support, "
    "CAST(coalesce(tp, 0) AS BIGINT) AS tp, CAST(coalesce(predicted, 0) AS BIGINT) AS predicted "
    "FROM sup s FULL OUTER JOIN prd p ON s.label = p.label), "
    "pc1 AS (SELECT *, CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS precision, "
    "CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall FROM pc0 WHERE support > 0 OR predicted > 0), "
    "pcf AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 "
    "ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM pc1)"
)


def _etype(x: str) -> str:
    rest = f"substr({x}, 2)"
    t = f"(CASE WHEN position('-' IN {rest}) > 0 THEN substr({rest}, position('-' IN {rest}) + 1) ELSE {rest} END)"
    return f"(CASE WHEN {t} IS NULL OR {t} = '' THEN '_' ELSE {t} END)"


def _chunks_cte(side: str, outside=("O",)) -> str:
    o = lits(outside)
    lab, prev = "lab", "prev"
    start = (f"(NOT ({lab} IN {o}) AND (i = 0 OR {prev} IN {o} OR substr({lab}, 1, 1) IN ('B', 'S') "
             f"OR substr({prev}, 1, 1) IN ('E', 'S') OR {_etype(lab)} <> {_etype(prev)}))")
    return (
        f"{side}_t AS (SELECT id, i, n, {side} AS lab, lag({side}) OVER (PARTITION BY id ORDER BY i) AS prev FROM er), "
        f"{side}_b AS (SELECT id, i, n, lab, {start} AS s FROM {side}_t "
        f"WHERE {start} OR lab IN {o}), "
        f"{side}_c AS (SELECT id, {_etype('lab')} AS type, i AS cstart, "
        f"coalesce(lead(i) OVER (PARTITION BY id ORDER BY i), n) - 1 AS cend, s FROM {side}_b), "
        f"{side}_ch AS (SELECT id, type, cstart, cend FROM {side}_c WHERE s)"
    )


CTE_SPANS = (
    CTE_PIECES + ", "
    "pt AS (SELECT *, string_split(entity, '-')[-1] AS type, "
    "(pidx = 0 OR starts_with(word, 'Ġ')) AS is_first, "
    "coalesce(starts_with(lead(word) OVER (PARTITION BY id ORDER BY pidx), 'Ġ'), true) AS is_last, "
    "lag(string_split(entity, '-')[-1]) OVER (PARTITION BY id ORDER BY pidx) AS prev_type FROM pieces), "
    "pr AS (SELECT *, sum(CASE WHEN prev_type IS NULL OR prev_type <> type THEN 1 ELSE 0 END) "
    "OVER (PARTITION BY id ORDER BY pidx) AS run FROM pt), "
    "pe AS (SELECT *, max(pend) OVER (PARTITION BY id, run) AS run_end, "
    "arg_max(is_last, pidx) OVER (PARTITION BY id, run) AS run_last_ok FROM pr), "
    "spans AS (SELECT id, type, pstart AS \"start\", run_end AS \"end\", pidx, "
    "coalesce(is_first AND run_last_ok, false) AS aligned FROM pe "
    "WHERE entity <> '0' AND starts_with(entity, 'B'))"
)

ORACLE: dict[str, str] = {}

ORACLE["normalize_sentences"] = (
    f"WITH sent AS ({SENT}) SELECT id, {norm('text')} AS text, {norm('lemma_text')} AS lemma_text FROM sent"
)
ORACLE["normalize_documents"] = f"SELECT doc_id, {norm('text')} AS text FROM documents"
ORACLE["token_counts"] = f"SELECT doc_id, CAST(len({tokenize(norm('text'))}) AS BIGINT) AS n_tokens FROM documents"
ORACLE["fix_tags"] = (
    f"WITH {CTE_ANN} SELECT id, array_to_string(tokens, ' ') AS tokens, "
    "array_to_string(model_tags, ',') AS model_tags, array_to_string(fixed_tags, ',') AS fixed_tags FROM ann"
)
ORACLE["fix_tag_counts"] = (
    f"WITH {CTE_ANN} SELECT {LABELS_LIST}[tag + 1] AS label, count(*) AS n "
    "FROM (SELECT unnest(fixed_tags) AS tag FROM ann) GROUP BY tag"
)
ORACLE["pieces_to_words"] = (
    f"WITH {CTE_WORDS} SELECT id, string_agg(word, ' ' ORDER BY word_idx) AS words, "
    f"string_agg(CAST(list_position({LABELS_LIST}, entity) - 1 AS VARCHAR), ',' ORDER BY word_idx) AS tags, "
    "string_agg(CAST(wstart AS VARCHAR), ',' ORDER BY word_idx) AS starts, "
    "string_agg(CAST(wend AS VARCHAR), ',' ORDER BY word_idx) AS ends FROM words GROUP BY id"
)
ORACLE["align_labels"] = (
    f"WITH {CTE_WORDS}, "
    "wi AS (SELECT id, [NULL::INTEGER] || list(CAST(word_idx AS INTEGER) ORDER BY pidx) || [NULL::INTEGER] AS wids "
    "FROM pw GROUP BY id), "
    "fx0 AS (SELECT id, tokens, lemmas, "
    "list_transform(tokens, lambda t, i: ((id * 7 + (i - 1) * 13) % 14)::INTEGER) AS model_tags FROM tok), "
    f"fx AS (SELECT id, {_fix_expr()} AS fixed_tags FROM fx0) "
    "SELECT wi.id, array_to_string(wids, ',') AS word_ids, "
    "array_to_string(list_transform(wids, lambda w, i: CASE WHEN w IS NULL THEN -100 "
    "WHEN wids[i - 1] IS NULL OR w <> wids[i - 1] THEN fixed_tags[w + 1] ELSE fixed_tags[w + 1] END), ',') AS labels, "
    "array_to_string(list_transform(wids, lambda w, i: CASE WHEN w IS NULL THEN -100 "
    "WHEN wids[i - 1] IS NULL OR w <> wids[i - 1] THEN fixed_tags[w + 1] ELSE -100 END), ',') AS labels_first "
    "FROM wi JOIN fx ON wi.id = fx.id"
)
ORACLE["argmax_labels"] = (
    "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS pred, label "
    "FROM embeddings"
)
ORACLE["confusion"] = f"WITH {CTE_CONF} SELECT gold, pred, n FROM conf"
ORACLE["confusion_percent"] = (
    f"WITH {CTE_CONF} SELECT gold, pred, n, "
    "round(n / nullif(sum(n) OVER (PARTITION BY gold), 0), 6) AS pct FROM conf"
)
ORACLE["confusion_totals"] = (
    f"WITH {CTE_CONF} SELECT "
    f"CASE WHEN grouping(gold) = 1 THEN 'TOTAL' ELSE {LABELS_LIST}[gold + 1] END AS gold_label, "
    f"CASE WHEN grouping(pred) = 1 THEN 'TOTAL' ELSE {LABELS_LIST}[pred + 1] END AS pred_label, "
    "CAST(sum(n) AS BIGINT) AS n FROM conf GROUP BY CUBE (gold, pred)"
)
ORACLE["token_metrics"] = (
    f"WITH {CTE_PC} SELECT "
    'round(sum(precision * support) / sum(support), 6) AS "test/precision", '
    'round(avg(precision), 6) AS "test/macro_precision", '
    'round(sum(recall * support) / sum(support), 6) AS "test/recall", '
    'round(avg(recall), 6) AS "test/macro_recall", '
    'round(sum(f1 * support) / sum(support), 6) AS "test/f1", '
    'round(avg(f1), 6) AS "test/macro_f1", '
    'round(sum(tp) / sum(support), 6) AS "test/accuracy" FROM pcf'
)
ORACLE["class_report"] = (
    f"WITH {CTE_PC} "
    f"SELECT {LABELS_LIST}[label + 1] AS label, round(precision, 6) AS precision, round(recall, 6) AS recall, "
    "round(f1, 6) AS f1, support FROM pcf "
    "UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pcf "
    "UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), "
    "CAST(sum(support) AS BIGINT) FROM pcf "
    "UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), "
    "round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), "
    "CAST(sum(support) AS BIGINT) FROM pcf"
)
ORACLE["entity_metrics"] = (
    f"WITH {CTE_ANN}, "
    f"named AS (SELECT id, list_transform(fixed_tags, lambda t: {LABELS_LIST}[t + 1]) AS gold, "
    f"list_transform(model_tags, lambda t: {LABELS_LIST}[t + 1]) AS pred FROM ann), "
    "er AS (SELECT id, unnest(gold) AS gold, unnest(pred) AS pred, generate_subscripts(gold, 1) - 1 AS i, "
    "len(gold) AS n FROM named), "
    + _chunks_cte("gold") + ", " + _chunks_cte("pred") + ", "
    "tp AS (SELECT count(*) AS n FROM gold_ch g JOIN pred_ch p ON g.id = p.id AND g.type = p.type "
    "AND g.cstart = p.cstart AND g.cend = p.cend), "
    "cnt AS (SELECT (SELECT count(*) FROM gold_ch) AS n_gold, (SELECT count(*) FROM pred_ch) AS n_pred, "
    "(SELECT n FROM tp) AS n_tp, (SELECT count(*) FROM er) AS n_tok, "
    "(SELECT count(*) FROM er WHERE gold = pred) AS n_eq), "
    "pr AS (SELECT *, CASE WHEN n_pred = 0 THEN 0.0 ELSE n_tp / n_pred END AS p, "
    "CASE WHEN n_gold = 0 THEN 0.0 ELSE n_tp / n_gold END AS r FROM cnt) "
    "SELECT round(p, 6) AS precision, round(r, 6) AS recall, "
    "round(CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END, 6) AS f1, "
    "round(CASE WHEN n_tok = 0 THEN 0.0 ELSE n_eq / n_tok END, 6) AS accuracy FROM pr"
)
ORACLE["entity_spans"] = f'WITH {CTE_SPANS} SELECT id, type, "start", "end" FROM spans'
ORACLE["accepted_spans"] = (
    f"WITH {CTE_SPANS}, "
    "sr AS (SELECT *, lag(\"start\") OVER (PARTITION BY id ORDER BY pidx) AS ls, "
    "lag(\"end\") OVER (PARTITION BY id ORDER BY pidx) AS le, "
    "min(CASE WHEN aligned THEN pidx END) OVER (PARTITION BY id) AS first_ok FROM spans) "
    "SELECT id, type, \"start\", \"end\" FROM sr WHERE aligned AND (pidx = first_ok OR NOT ("
    "\"start\" >= ls AND \"start\" < le AND \"end\" - 1 >= ls AND \"end\" - 1 < le))"
)


# -- datasets -----------------------------------------------------------------
CTE_EXT = (
    f"ext0 AS (SELECT doc_id, {tokenize(norm('text'))} AS t0 FROM documents), "
    "ext1 AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN list_append(t0, '2020') ELSE t0 END AS t1 FROM ext0), "
    "ext2 AS (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN list_append(t1, 'd''Or') ELSE t1 END AS tokens "
    "FROM ext1), "
    "ext AS (SELECT doc_id, tokens, "
    "list_transform(tokens, lambda t, i: CAST((i - 1 + length(t)) % 7 AS BIGINT)) AS ner_tags, "
    "CASE WHEN doc_id % 25 < 16 THEN 'train' WHEN doc_id % 25 < 20 THEN 'validation' ELSE 'test' END AS subset "
    "FROM ext2)"
)
NO_DIGIT = r"len(list_filter(tokens, lambda t: regexp_matches(t, '\p{Nd}'))) = 0"
NO_APOS = "len(list_filter(tokens, lambda t: contains(t, chr(39)))) = 0"
CTE_CONCAT = (
    CTE_ANN + ", " + CTE_EXT + ", "
    "mc0 AS (SELECT id, tokens, CAST(fixed_tags AS BIGINT[]) AS ner_tags FROM ann), "
    "mc AS (SELECT min(id) AS id, tokens, ner_tags FROM mc0 GROUP BY tokens, ner_tags), "
    "cat0 AS (SELECT 'sentences' AS source, id AS key, tokens, ner_tags, "
    "CASE WHEN id % 25 < 16 THEN 'train' WHEN id % 25 < 20 THEN 'validation' ELSE 'test' END AS subset FROM mc "
    f"UNION ALL SELECT 'documents', doc_id, tokens, ner_tags, subset FROM ext WHERE {NO_DIGIT}), "
    f"cat AS (SELECT * FROM cat0 WHERE subset <> 'test' OR {NO_APOS})"
)
ORACLE["filter_numeric"] = (
    f"WITH {CTE_EXT} SELECT doc_id, subset, CAST(len(tokens) AS BIGINT) AS n_tokens FROM ext WHERE {NO_DIGIT}"
)
ORACLE["filter_apostrophe"] = (
    f"WITH {CTE_EXT} SELECT doc_id, CAST(len(tokens) AS BIGINT) AS n_tokens FROM ext "
    f"WHERE subset = 'test' AND {NO_APOS}"
)
ORACLE["dedup"] = (
    f"WITH {CTE_EXT} SELECT min(doc_id) AS doc_id, CAST(len(tokens) AS BIGINT) AS n_tokens, count(*) AS copies "
    "FROM ext GROUP BY tokens, ner_tags"
)
ORACLE["concat_splits"] = (
    f"WITH {CTE_CONCAT} SELECT source, key, subset, CAST(len(tokens) AS BIGINT) AS n_tokens FROM cat"
)
ORACLE["split_sizes"] = (
    f"WITH {CTE_CONCAT} SELECT subset AS Subset, count(*) AS Num_of_Rows, "
    "CAST(sum(len(ner_tags)) AS BIGINT) AS Num_of_Tokens, "
    "round(count(*) / sum(count(*)) OVER (), 6) AS Split FROM cat GROUP BY subset"
)
ORACLE["distribution"] = (
    f"WITH {CTE_CONCAT} SELECT subset AS Subset, count(*) AS Num_of_Rows, "
    "CAST(sum(len(ner_tags)) AS BIGINT) AS Num_of_Tokens, "
    "round(count(*) / sum(count(*)) OVER (), 6) AS Split, "
    + ", ".join(f'CAST(sum(len(list_filter(ner_tags, lambda t: t = {i}))) AS BIGINT) AS "{n}"'
                for i, n in enumerate(K.LABELS))
    + " FROM cat GROUP BY subset"
)

# -- review and corrections ---------------------------------------------------
CTE_REVIEW = (
    CTE_ANN + ", "
    "rv0 AS (SELECT row_number() OVER (ORDER BY id) AS row, id, tokens, fixed_tags FROM ann), "
    "rv AS (SELECT row, id, unnest(tokens) AS word, unnest(fixed_tags) AS tag, "
    "CAST(generate_subscripts(tokens, 1) - 1 AS INTEGER) AS token_index FROM rv0)"
)


def _block(label: str, new: str) -> str:
    return ("'Row: ' || row || chr(10) || 'ID: ' || id || chr(10) || 'Token Index: ' || token_index || chr(10) "
            f"|| 'Word: ' || word || chr(10) || 'NER Tag: ' || {label} || ' -- ' || {new}")


_H = "((id * 3 + token_index) % 17)"
CTE_FILLED = (
    CTE_REVIEW + ", "
    "fb AS (SELECT " + _block(f"{LABELS_LIST}[tag + 1]",
                             f"(CASE WHEN {_H} = 1 THEN '' WHEN {_H} = 0 THEN {LABELS_LIST}[(tag + 1) % 14 + 1] "
                             f"ELSE {LABELS_LIST}[tag + 1] END)")
    + " AS block, 1 AS pass, row * 1000 + token_index AS seq FROM rv "
    "UNION ALL SELECT " + _block(f"{LABELS_LIST}[(tag + 1) % 14 + 1]", f"{LABELS_LIST}[(tag + 2) % 14 + 1]")
    + " AS block, 2 AS pass, 1000000000000000 + row * 1000 + token_index AS seq FROM rv "
    f"WHERE {_H} = 0 AND id % 2 = 0), "
    "pb0 AS (SELECT pass, seq, string_split(trim(block), chr(10)) AS lines FROM fb WHERE trim(block) <> ''), "
    "pb1 AS (SELECT pass, seq, "
    r"TRY_CAST(string_split_regex(trim(lines[2]), '\s+')[-1] AS BIGINT) AS id, "
    r"TRY_CAST(string_split_regex(trim(lines[3]), '\s+')[-1] AS INTEGER) AS token_index, "
    "trim(string_split(lines[-1], '--')[-1]) AS new_label FROM pb0), "
    f"pb AS (SELECT *, CAST(list_position({LABELS_LIST}, new_label) - 1 AS INTEGER) AS new_tag FROM pb1), "
    "pc AS (SELECT id, token_index, new_tag, new_label, pass, seq, "
    "CASE WHEN new_label = '' THEN 'unfilled' WHEN id IS NULL OR token_index IS NULL OR new_tag IS NULL "
    "THEN 'bad' ELSE 'ok' END AS status FROM pb)"
)
ORACLE["review_blocks"] = (
    f"WITH {CTE_REVIEW} SELECT id, token_index, " + _block(f"{LABELS_LIST}[tag + 1]", "''") + " AS block FROM rv"
)
ORACLE["parse_corrections"] = (
    f"WITH {CTE_FILLED} SELECT id, token_index, new_tag, new_label, status, pass FROM pc"
)
ORACLE["apply_corrections"] = (
    f"WITH {CTE_FILLED}, "
    "lw AS (SELECT id, token_index, arg_max(new_tag, seq) AS new_tag FROM pc WHERE status = 'ok' "
    "GROUP BY id, token_index), "
    "tk AS (SELECT id, unnest(fixed_tags) AS tag, CAST(generate_subscripts(fixed_tags, 1) - 1 AS INTEGER) AS k "
    "FROM ann) "
    "SELECT tk.id, string_agg(CAST(tag AS VARCHAR), ',' ORDER BY k) AS fixed_tags, "
    "string_agg(CAST(coalesce(lw.new_tag, tag) AS VARCHAR), ',' ORDER BY k) AS corrected_tags "
    "FROM tk LEFT JOIN lw ON tk.id = lw.id AND tk.k = lw.token_index GROUP BY tk.id"
)

# -- training runs --------------------------------------------------------------
CTE_REC = (
    "rec0 AS (SELECT user_id AS run_id, event_id, "
    "CASE WHEN event_type IN ('view', 'click') THEN value END AS loss, "
    "CASE WHEN event_type IN ('signup', 'purchase') THEN value END AS eval_loss, "
    "CASE WHEN event_type IN ('signup', 'purchase') THEN value / (abs(value) + 1) END AS eval_f1 FROM events), "
    "rec AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY event_id) AS position FROM rec0 "
    "WHERE loss IS NOT NULL OR eval_loss IS NOT NULL), "
    "rec2 AS (SELECT *, position AS step, CAST(floor((position + 1) / 2) AS INTEGER) AS epoch, "
    "(position - 1) // 2 AS pair FROM rec), "
    "hp AS (SELECT run_id, arg_max(epoch, position) AS epoch, arg_max(step, position) AS step, "
    "arg_max(loss, position) FILTER (WHERE loss IS NOT NULL) AS loss, "
    "arg_max(eval_loss, position) FILTER (WHERE eval_loss IS NOT NULL) AS eval_loss, "
    "arg_max(eval_f1, position) FILTER (WHERE eval_f1 IS NOT NULL) AS eval_f1 "
    "FROM rec2 GROUP BY run_id, pair HAVING count(*) = 2)"
)
ORACLE["history_pairs"] = (
    f"WITH {CTE_REC} SELECT run_id, epoch, step, round(loss, 6) AS loss, round(eval_loss, 6) AS eval_loss, "
    "round(eval_f1, 6) AS eval_f1 FROM hp"
)
ORACLE["best_epoch"] = (
    f"WITH {CTE_REC}, "
    "b AS (SELECT run_id, epoch, eval_f1, row_number() OVER (PARTITION BY run_id ORDER BY eval_f1 DESC, epoch) AS r, "
    "max(eval_f1) OVER (PARTITION BY run_id) AS best FROM hp WHERE eval_f1 IS NOT NULL) "
    "SELECT run_id, epoch AS best_epoch, round(best, 6) AS best_eval_f1 FROM b WHERE r = 1"
)
ORACLE["early_stop"] = (
    f"WITH {CTE_REC}, "
    "ev AS (SELECT run_id, step, epoch, eval_f1, row_number() OVER (PARTITION BY run_id ORDER BY step) AS eval_idx, "
    "max(eval_f1) OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) "
    "AS prev_best FROM hp WHERE eval_f1 IS NOT NULL), "
    "ev2 AS (SELECT *, (prev_best IS NULL OR eval_f1 > prev_best) AS improved FROM ev), "
    "ev3 AS (SELECT *, max(CASE WHEN improved THEN eval_idx END) OVER (PARTITION BY run_id ORDER BY step "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_improved FROM ev2) "
    "SELECT run_id, min(CASE WHEN eval_idx - last_improved >= 3 THEN epoch END) AS stop_epoch, "
    "count(*) AS n_evals FROM ev3 GROUP BY run_id"
)

CTE_RUNS = (
    "rc AS (SELECT user_id, count(*) AS n, "
    + ", ".join(f"sum(CASE WHEN event_type = '{k}' THEN 1 ELSE 0 END) AS n{a}"
                for k, a in (("view", "v"), ("click", "c"), ("signup", "s"), ("purchase", "p"), ("error", "e")))
    + " FROM events GROUP BY user_id), "
    "rt AS (SELECT user_id AS run_id, "
    "'SlovakBERT_NER_Model_V' || CASE WHEN user_id % 10 = 0 THEN '_POC' ELSE '0.0.' || CAST(user_id % 6 + 1 AS VARCHAR) END "
    "|| '.' || CAST(CASE WHEN user_id % 10 = 0 THEN user_id // 10 + 1 ELSE user_id // 6 + 1 END AS VARCHAR) AS Name, "
    "5e-05 * (user_id % 3 + 1) AS learning_rate, user_id % 6 + 10 AS num_train_epochs, "
    'round(nc / n, 6) AS "eval/precision", round(nv / n, 6) AS "eval/recall", '
    'round((nc + nv) / (n * 2), 6) AS "eval/f1", round(1 - ne / n, 6) AS "eval/accuracy", '
    'round(ns / n, 6) AS "test/precision", round(np / n, 6) AS "test/recall", '
    'round((ns + np) / (n * 2), 6) AS "test/f1", round((n - ne) / n, 6) AS "test/accuracy", '
    'round(nv / (n + 1), 6) AS "test/macro_precision", round(nc / (n + 1), 6) AS "test/macro_recall", '
    'round((nv + nc + ns) / (n * 3), 6) AS "test/macro_f1" FROM rc)'
)
PARENT = (f"coalesce(nullif(regexp_extract(Name, {lit(K.PARENT_VERSION_PATTERN)}, 1), ''), "
          f"{lit(K.DEFAULT_PARENT_VERSION)})")
NATKEY = ("array_to_string(list_transform(regexp_extract_all(Name, '([0-9]+|[^0-9]+)', 1), "
          "lambda x: CASE WHEN regexp_matches(x, '^[0-9]+$') THEN "
          "lpad(length(ltrim(x, '0'))::VARCHAR, 10, '0') || ltrim(x, '0') ELSE x END), '')")
ORACLE["parent_version"] = f"WITH {CTE_RUNS} SELECT Name, {PARENT} AS parent_version FROM rt"
ORACLE["natural_sort"] = f"WITH {CTE_RUNS} SELECT Name, {NATKEY} AS natural_key FROM rt"
ORACLE["top_runs"] = (
    f"WITH {CTE_RUNS}, "
    f'tr AS (SELECT Name, "test/macro_f1", {PARENT} AS parent_version, {NATKEY} AS nk FROM rt), '
    'tr2 AS (SELECT *, row_number() OVER (PARTITION BY parent_version ORDER BY "test/macro_f1", nk) AS rank FROM tr) '
    'SELECT Name, "test/macro_f1", parent_version, rank FROM tr2 WHERE rank <= 10'
)
ORACLE["next_version"] = (
    f"WITH {CTE_RUNS} SELECT array_to_string(list_slice(string_split(Name, '.'), 1, len(string_split(Name, '.')) - 1), '.') "
    "AS family, CAST(coalesce(max(TRY_CAST(string_split(Name, '.')[-1] AS BIGINT)), 0) + 1 AS BIGINT) AS next_version "
    "FROM rt GROUP BY family"
)
ORACLE["model_dataset_match"] = (
    f"WITH {CTE_RUNS}, "
    "files AS (SELECT * FROM (SELECT CASE run_id % 4 WHEN 0 THEN 'test_dataset_' || Name || '.csv' "
    "WHEN 1 THEN 'test_dataset_' || substring(Name, 1, length(Name) - 2) || '_old.csv' "
    "WHEN 3 THEN 'test_' || Name || '_v2.csv' END AS file FROM rt) WHERE file IS NOT NULL), "
    "ex AS (SELECT r.Name, max(f.file) AS exact_file FROM rt r JOIN files f ON contains(f.file, r.Name) GROUP BY r.Name), "
    "tm AS (SELECT r.Name, max(f.file) AS trimmed_file FROM rt r "
    "JOIN files f ON contains(f.file, substring(r.Name, 1, length(r.Name) - 2)) GROUP BY r.Name) "
    "SELECT rt.Name, coalesce(exact_file, trimmed_file) AS file, "
    "CASE WHEN exact_file IS NOT NULL THEN 'exact' WHEN trimmed_file IS NOT NULL THEN 'trimmed' END AS matched_by, "
    "CAST(coalesce(CASE regexp_extract(rt.Name, 'V(_POC|[0-9]+\\.[0-9]+\\.[0-9]+)', 1) "
    + " ".join(f"WHEN {lit(k)} THEN {v}" for k, v in K.VERSION_TEST_ROWS)
    + f" END, {K.VERSION_TEST_ROWS_DEFAULT}) AS INTEGER) AS test_rows "
    "FROM rt LEFT JOIN ex ON rt.Name = ex.Name LEFT JOIN tm ON rt.Name = tm.Name"
)
ORACLE["param_grid"] = (
    "WITH v AS (SELECT DISTINCT CAST(CAST(floor(value) AS BIGINT) % 3 AS DOUBLE) / 10 AS v FROM events) "
    "SELECT a.v AS hidden_dropout_prob, b.v AS attention_probs_dropout_prob, c.v AS classifier_dropout "
    "FROM v a, v b, v c"
)
_CONFIG = (("learning_rate", "5e-05", "CASE WHEN run_id % 3 = 0 THEN learning_rate END"),
           ("num_train_epochs", "15.0", "CASE WHEN run_id % 5 = 0 THEN CAST(num_train_epochs AS DOUBLE) END"),
           ("per_device_train_batch_size", "4.0", "CAST(NULL AS DOUBLE)"),
           ("weight_decay", "0.0", "CASE WHEN run_id % 2 = 1 THEN CAST(0.01 AS DOUBLE) END"),
           ("warmup_steps", "0.0", "CAST(NULL AS DOUBLE)"),
           ("seed", "42.0", "CAST(NULL AS DOUBLE)"))
ORACLE["config_overlay"] = (
    f"WITH {CTE_RUNS}, ov AS (SELECT run_id, " + ", ".join(f"{e} AS {k}" for k, _, e in _CONFIG) + " FROM rt) "
    + " UNION ALL ".join(
        f"SELECT run_id, '{k}' AS param, coalesce({k}, CAST({d} AS DOUBLE)) AS value, {k} IS NOT NULL AS overridden "
        "FROM ov" for k, d, _ in _CONFIG)
)
ORACLE["metrics_long"] = (
    f"WITH {CTE_RUNS} "
    + " UNION ALL ".join(
        f"SELECT Name, '{cat}' AS category, '{m}' AS metric, CAST(\"{m}\" AS DOUBLE) AS value FROM rt"
        for cat, cols in K.EVALUATION_COLUMNS for m in cols)
)

# The presets as SQL, field by field, not from the library's table.
_EPOCHS = "'num_train_epochs', 15.0"
_TUNED = "('learning_rate', 0.000024981604754), ('weight_decay', 0.285214291922975)"
_DROPOUT = "('hidden_dropout_prob', 0.2), ('attention_probs_dropout_prob', 0.25), ('classifier_dropout_value', 0.25)"


def _preset(version: str, batch: int, rest: str) -> str:
    values = f"({_EPOCHS}), ('per_device_train_batch_size', {batch}), ('per_device_eval_batch_size', {batch}), {rest}"
    return f"SELECT '{version}' AS version, param, value::DOUBLE AS value FROM (VALUES {values}) x(param, value)"


_PRESETS = " UNION ALL ".join((
    _preset("_POC", 4, "('concat_external', 0), ('hyperparameter_tuning', 0)"),
    _preset("0.0.1", 8, "('concat_external', 1), ('filter_numeric_external', 0), ('hyperparameter_tuning', 0)"),
    _preset("0.0.2", 8, "('concat_external', 1), ('filter_numeric_external', 1), ('hyperparameter_tuning', 0)"),
    _preset("0.0.3", 4, "('concat_external', 1), ('filter_numeric_external', 1), ('hyperparameter_tuning', 0), ('early_stopping_patience', 10)"),
    _preset("0.0.4", 4, f"('concat_external', 1), ('filter_numeric_external', 1), ('hyperparameter_tuning', 1), ('early_stopping_patience', 3), {_TUNED}"),
    _preset("0.0.5", 4, f"('concat_external', 1), ('filter_numeric_external', 1), ('hyperparameter_tuning', 0), ('early_stopping_patience', 3), {_TUNED}, {_DROPOUT}"),
    _preset("0.0.6", 4, f"('hyperparameter_tuning', 0), ('early_stopping_patience', 3), {_TUNED}, {_DROPOUT}"),
))
ORACLE["preset_configs"] = (
    f"WITH {CTE_RUNS}, v AS (SELECT run_id, regexp_extract(Name, 'V(_POC|[0-9]+\\.[0-9]+\\.[0-9]+)', 1) AS version FROM rt), "
    f"preset AS ({_PRESETS}), param(param, value) AS (VALUES ('num_train_epochs', 3.0::DOUBLE), ('learning_rate', 0.00005), ('weight_decay', 0), "
    "('per_device_train_batch_size', 8), ('per_device_eval_batch_size', 8), ('hidden_dropout_prob', 0.1), ('attention_probs_dropout_prob', 0.1), "
    "('concat_external', 1), ('filter_numeric_external', 1), ('hyperparameter_tuning', 0), ('seed', 42), ('early_stopping_patience', NULL), "
    "('classifier_dropout_value', NULL)) "
    "SELECT run_id, p.param, coalesce(s.value, p.value) AS value, s.value IS NOT NULL AS overridden "
    "FROM v CROSS JOIN param p LEFT JOIN preset s ON s.version = v.version AND s.param = p.param"
)
ORACLE["sweep_trials"] = (
    "SELECT 0 AS repeat, CAST(t AS INTEGER) AS trial, CAST(CASE WHEN t < 2 THEN 0.0 ELSE 0.1 END AS DOUBLE) AS \"regParam\", "
    "CAST(CASE WHEN t % 2 = 0 THEN 0.0 ELSE 0.5 END AS DOUBLE) AS \"elasticNetParam\", TRUE AS scored FROM range(4) r(t)"
)

# -- tagger and pipelines -------------------------------------------------------
ORACLE["annotate_corpus"] = (
    f"WITH {CTE_FILLED}, "
    "lw AS (SELECT id, token_index, arg_max(new_tag, seq) AS new_tag FROM pc WHERE status = 'ok' "
    "GROUP BY id, token_index), "
    "tk AS (SELECT id, unnest(tokens) AS token, unnest(fixed_tags) AS tag, unnest(model_tags) AS mtag, "
    "CAST(generate_subscripts(fixed_tags, 1) - 1 AS INTEGER) AS k FROM ann) "
    "SELECT tk.id, string_agg(token, ' ' ORDER BY k) AS tokens, "
    "string_agg(CAST(mtag AS VARCHAR), ',' ORDER BY k) AS model_tags, "
    "string_agg(CAST(coalesce(lw.new_tag, tag) AS VARCHAR), ',' ORDER BY k) AS fixed_tags "
    "FROM tk LEFT JOIN lw ON tk.id = lw.id AND tk.k = lw.token_index GROUP BY tk.id"
)
ORACLE["correction_order"] = (
    f"WITH {CTE_FILLED}, "
    "lw AS (SELECT id, token_index, arg_max(new_tag, pass) AS new_tag FROM pc WHERE status = 'ok' "
    "AND (pass = 2 OR token_index % 2 = 0) GROUP BY id, token_index), "
    "tk AS (SELECT id, unnest(fixed_tags) AS tag, CAST(generate_subscripts(fixed_tags, 1) - 1 AS INTEGER) AS k FROM ann) "
    "SELECT tk.id, string_agg(CAST(coalesce(lw.new_tag, tag) AS VARCHAR), ',' ORDER BY k) AS corrected_tags "
    "FROM tk LEFT JOIN lw ON tk.id = lw.id AND tk.k = lw.token_index GROUP BY tk.id"
)
ORACLE["predict_spans"] = ORACLE["accepted_spans"]
ORACLE["modelling_dataset"] = (
    f"WITH {CTE_ANN}, mc AS (SELECT min(id) AS key, tokens, fixed_tags FROM ann GROUP BY tokens, fixed_tags) "
    "SELECT key, array_to_string(list_transform(range(1, 25), lambda i: CASE WHEN i <= len(tokens) THEN tokens[i] ELSE '<pad>' END), ' ') AS tokens, "
    "array_to_string(list_transform(range(1, 25), "
    "lambda i: CASE WHEN i <= len(fixed_tags) THEN fixed_tags[i] ELSE -100 END), ',') AS ner_tags, "
    "CASE WHEN key * 97 % 10000 < 6400 THEN 'train' WHEN key * 97 % 10000 < 8000 THEN 'validation' ELSE 'test' END AS subset FROM mc"
)
ORACLE["masked_accuracy"] = (
    f"WITH {CTE_ANN}, r AS (SELECT unnest(fixed_tags) AS g, unnest(model_tags) AS p, "
    "generate_subscripts(fixed_tags, 1) - 1 AS i FROM ann) "
    "SELECT CAST(count(*) AS BIGINT) AS n_tokens, CAST(sum(CASE WHEN g = p THEN 1 ELSE 0 END) AS BIGINT) AS n_equal "
    "FROM r WHERE i % 5 <> 4"
)
ORACLE["evaluation_checks"] = (
    f"WITH {CTE_ANN}, c AS (SELECT id, fixed_tags AS g, CASE WHEN id % 9 = 0 THEN model_tags[1:5] ELSE model_tags END AS p FROM ann), "
    "n AS (SELECT id, len(g) AS ng, len(p) AS np, CASE WHEN id % 11 = 0 AND least(len(g), len(p)) >= 3 THEN 1 ELSE 0 END AS odd FROM c) "
    "SELECT count(*) AS n_rows, CAST(sum(CASE WHEN ng <> np THEN 1 ELSE 0 END) AS BIGINT) AS mismatched_rows, "
    "CAST(sum(abs(ng - np)) AS BIGINT) AS unpaired_tokens, CAST(sum(odd) AS BIGINT) AS unknown_tag_pairs, "
    "CAST(sum(least(ng, np) - odd) AS BIGINT) AS counted_pairs FROM n"
)
ORACLE["version_folder"] = (
    f"WITH {CTE_RUNS}, v AS (SELECT DISTINCT regexp_extract(Name, 'V(_POC|[0-9]+\\.[0-9]+\\.[0-9]+)', 1) AS version FROM rt) "
    "SELECT version, min(Name) AS folder FROM v LEFT JOIN rt ON contains(Name, version) GROUP BY version"
)
ORACLE["compare_runs"] = (
    f"WITH {CTE_RUNS}, "
    f'r1 AS (SELECT *, {PARENT} AS parent_version, {NATKEY} AS nk FROM rt), '
    'r2 AS (SELECT *, row_number() OVER (PARTITION BY parent_version ORDER BY "test/macro_f1", nk) AS rank FROM r1), '
    "r3 AS (SELECT * FROM r2 WHERE rank <= 5) "
    + " UNION ALL ".join(
        f"SELECT Name, parent_version, rank, '{cat}' AS category, '{m}' AS metric, CAST(\"{m}\" AS DOUBLE) AS value FROM r3"
        for cat, cols in K.EVALUATION_COLUMNS for m in cols)
)
ORACLE["sorted_runs"] = (
    f'WITH {CTE_RUNS} SELECT Name, {PARENT} AS parent_version, "test/macro_f1", "test/f1" FROM rt '
    'ORDER BY "test/macro_f1" DESC, "test/f1" DESC, Name'
)
ORACLE["generations"] = f"WITH {CTE_RUNS} SELECT DISTINCT {PARENT} AS parent_version FROM rt ORDER BY parent_version"
ORACLE["training_history"] = (
    f"WITH {CTE_REC}, "
    "b AS (SELECT run_id, epoch AS best_epoch FROM (SELECT *, row_number() OVER (PARTITION BY run_id "
    "ORDER BY eval_f1 DESC, epoch) AS r FROM hp WHERE eval_f1 IS NOT NULL) WHERE r = 1), "
    "es AS (" + ORACLE["early_stop"].replace(f"WITH {CTE_REC}, ", "WITH ", 1) + ") "
    "SELECT hp.run_id, epoch, step, round(eval_f1, 6) AS eval_f1, best_epoch, stop_epoch, n_evals "
    "FROM hp LEFT JOIN b ON hp.run_id = b.run_id LEFT JOIN es ON hp.run_id = es.run_id"
)
CTE_MC = (
    CTE_ANN + ", "
    "mc0 AS (SELECT id, tokens, CAST(fixed_tags AS BIGINT[]) AS ner_tags FROM ann), "
    "mc AS (SELECT min(id) AS id, tokens, ner_tags FROM mc0 GROUP BY tokens, ner_tags), "
    "mrows AS (SELECT id, CAST(generate_subscripts(tokens, 1) - 1 AS INTEGER) AS idx, unnest(tokens) AS token, "
    "CAST(unnest(ner_tags) AS INTEGER) AS tag, "
    "CASE WHEN id % 25 < 16 THEN 'train' WHEN id % 25 < 20 THEN 'validation' ELSE 'test' END AS subset FROM mc)"
)
ORACLE["majority_tagger"] = (
    f"WITH {CTE_MC}, "
    "cnt AS (SELECT token, tag, count(*) AS n FROM mrows WHERE subset = 'train' GROUP BY token, tag), "
    "best AS (SELECT token, tag FROM (SELECT *, row_number() OVER (PARTITION BY token ORDER BY n DESC, tag) AS r "
    "FROM cnt) WHERE r = 1) "
    "SELECT m.id, m.idx, m.token, m.tag, coalesce(b.tag, 0) AS pred FROM mrows m "
    "LEFT JOIN best b ON m.token = b.token WHERE m.subset = 'test'"
)
ORACLE["logreg_tagger"] = (
    f"WITH {CTE_MC} SELECT tag, count(*) AS n_tagged, TRUE AS at_least_majority FROM mrows WHERE subset = 'test' GROUP BY tag"
)
ORACLE["evaluate_models"] = (
    f"WITH {CTE_MC}, {CTE_RUNS}, "
    "files AS (SELECT * FROM (SELECT CASE run_id % 4 WHEN 0 THEN 'test_dataset_' || Name || '.csv' "
    "WHEN 1 THEN 'test_dataset_' || substring(Name, 1, length(Name) - 2) || '_old.csv' "
    "WHEN 3 THEN 'test_' || Name || '_v2.csv' END AS file FROM rt) WHERE file IS NOT NULL), "
    "ex AS (SELECT r.Name, max(f.file) AS file FROM rt r JOIN files f ON contains(f.file, r.Name) GROUP BY r.Name), "
    "tm AS (SELECT r.Name, max(f.file) AS file FROM rt r "
    "JOIN files f ON contains(f.file, substring(r.Name, 1, length(r.Name) - 2)) GROUP BY r.Name), "
    "models AS (SELECT r.Name, r.run_id, coalesce(ex.file, tm.file) AS file FROM rt r LEFT JOIN ex ON r.Name = ex.Name "
    "LEFT JOIN tm ON r.Name = tm.Name WHERE coalesce(ex.file, tm.file) IS NOT NULL), "
    "ranked AS (SELECT file, row_number() OVER (ORDER BY ('0x' || left(md5(file), 12))::BIGINT, file) - 1 AS nth, count(*) OVER () AS n_files "
    "FROM (SELECT DISTINCT file FROM models)), "
    "pairs AS (SELECT m.Name, t.tag AS gold, CAST((t.id * 7 + t.idx * 13 + m.run_id % 14) % 14 AS INTEGER) AS pred "
    "FROM ranked r JOIN models m ON m.file = r.file JOIN mrows t ON t.id % r.n_files = r.nth WHERE t.subset = 'test'), "
    "conf AS (SELECT Name, gold, pred, count(*) AS n FROM pairs GROUP BY Name, gold, pred), "
    "sup AS (SELECT Name, gold AS label, sum(n) AS support, sum(CASE WHEN gold = pred THEN n ELSE 0 END) AS tp "
    "FROM conf GROUP BY Name, gold), "
    "prd AS (SELECT Name, pred AS label, sum(n) AS predicted FROM conf GROUP BY Name, pred), "
    "pc0 AS (SELECT coalesce(s.Name, p.Name) AS Name, coalesce(s.label, p.label) AS label, "
    "coalesce(support, 0) AS support, coalesce(tp, 0) AS tp, coalesce(predicted, 0) AS predicted "
    "FROM sup s FULL OUTER JOIN prd p ON s.Name = p.Name AND s.label = p.label), "
    "pc1 AS (SELECT *, CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS precision, "
    "CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall FROM pc0 WHERE support > 0 OR predicted > 0), "
    "pcf AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 "
    "ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM pc1) "
    "SELECT Name, "
    'round(sum(precision * support) / sum(support), 6) AS "test/precision", '
    'round(avg(precision), 6) AS "test/macro_precision", '
    'round(sum(recall * support) / sum(support), 6) AS "test/recall", '
    'round(avg(recall), 6) AS "test/macro_recall", '
    'round(sum(f1 * support) / sum(support), 6) AS "test/f1", '
    'round(avg(f1), 6) AS "test/macro_f1", '
    'round(sum(tp) / sum(support), 6) AS "test/accuracy" FROM pcf GROUP BY Name'
)

# -- the same operators over whole documents ------------------------------------
_TRIG = "[" + ", ".join(lit(w) for w in TRIGGERS) + "]"
CTE_DOC_TOK = (
    f"dt0 AS (SELECT doc_id AS id, {tokenize(norm('text'))} AS t0 FROM documents), "
    "dt1 AS (SELECT id, CASE WHEN id % 50 = 0 THEN CAST([] AS VARCHAR[]) ELSE list_transform(t0, lambda t, i: "
    f"CASE WHEN (i - 1 + id) % 4 = 0 THEN ({_TRIG})[((i - 1) * 5 + id) % {len(TRIGGERS)} + 1] ELSE t END) END AS tokens FROM dt0), "
    "dt2 AS (SELECT id, tokens, list_transform(tokens, lambda t, i: CASE WHEN (i - 1 + id) % 7 = 0 THEN 'január' ELSE t END) AS l0 FROM dt1), "
    "tok AS (SELECT id, tokens, CASE WHEN id % 3 = 0 THEN list_slice(l0, 1, len(l0) - 1) "
    "WHEN id % 3 = 2 THEN list_append(l0, 'rok') ELSE l0 END AS lemmas FROM dt2)"
)
for _new, _old in (("document_fix_tags", "fix_tags"), ("document_class_report", "class_report"),
                   ("document_entity_metrics", "entity_metrics"), ("document_words", "pieces_to_words"),
                   ("document_spans", "accepted_spans")):
    ORACLE[_new] = ORACLE[_old].replace(CTE_TOK, CTE_DOC_TOK)
ORACLE["annotation_mismatches"] = (
    f"WITH {CTE_DOC_TOK} SELECT id, CAST(len(tokens) AS INTEGER) AS n_tokens, CAST(len(tokens) AS INTEGER) AS n_model_tags, "
    "CAST(len(lemmas) AS INTEGER) AS n_lemmas FROM tok WHERE len(tokens) <> len(lemmas)"
)

# -- list texts, review files, histories, exact splits, one long sequence -------
ORACLE["parse_lists"] = (
    "WITH w AS (SELECT doc_id, regexp_extract_all(text, '[a-z]+') AS words FROM documents), "
    "v AS (SELECT doc_id, list_transform(words, lambda x, i: CASE (i - 1) % 6 WHEN 0 THEN x WHEN 1 THEN x || '''s' "
    "WHEN 2 THEN x || chr(10) || '\"' WHEN 3 THEN chr(225) || x WHEN 4 THEN chr(318) || x || chr(92) ELSE chr(128512) || x || 'x' END) AS e FROM w) "
    "SELECT doc_id, CASE WHEN doc_id % 13 < 2 OR e IS NULL THEN NULL ELSE array_to_string(e, '|') END AS elements, e IS NOT NULL AND doc_id % 13 < 2 AS rejected FROM v"
)
ORACLE["review_files"] = "SELECT id, corrected_tags FROM (" + ORACLE["apply_corrections"] + ")"
ORACLE["history_merge"] = (
    f"WITH {CTE_REC}, "
    "kv AS (SELECT run_id, position, pair, unnest([{'k': 'loss', 'v': loss}, {'k': 'eval_loss', 'v': eval_loss}, "
    "{'k': 'eval_f1', 'v': eval_f1}, {'k': 'learning_rate', 'v': event_id / 1024}, "
    "{'k': 'extra_' || event_type || '_' || (event_id % 3), 'v': event_id::DOUBLE}]) AS x "
    "FROM rec2 JOIN (SELECT event_id, event_type FROM events) USING (event_id)), "
    "two AS (SELECT run_id, pair FROM rec2 GROUP BY run_id, pair HAVING count(*) = 2), "
    "m AS (SELECT run_id, pair, x.k AS k, arg_max(x.v, position) AS v FROM kv JOIN two USING (run_id, pair) "
    "WHERE x.v IS NOT NULL GROUP BY run_id, pair, x.k) "
    "SELECT run_id, pair, string_agg(k, ',' ORDER BY k) AS keys, "
    + "".join(f"round(max(v) FILTER (WHERE k = '{k}'), 6) AS {k}, " for k in ("loss", "eval_loss", "eval_f1", "learning_rate"))
    + "coalesce(string_agg(k || '=' || v::BIGINT, ',' ORDER BY k || '=' || v::BIGINT) FILTER (WHERE k LIKE 'extra_%'), '') AS extras "
    "FROM m GROUP BY run_id, pair"
)
ORACLE["exact_split"] = (
    "WITH o AS (SELECT doc_id, row_number() OVER (ORDER BY ('0x' || left(md5(doc_id || ':42'), 15))::BIGINT) AS r, "
    "floor(count(*) OVER () * 0.8::DOUBLE) AS n_both FROM documents) "
    "SELECT doc_id, CASE WHEN r <= floor(n_both * 0.8::DOUBLE) THEN 'train' WHEN r <= n_both THEN 'validation' ELSE 'test' END AS subset FROM o"
)


def _flat(source: str, corpus: str) -> str:
    # Chunks of all sentences in one sequence, each followed by 'O': the state is the place of the last start.
    def side(name: str) -> str:
        p, q, t, u = f"left({name}, 1)", f"left({name}_b, 1)", f"{name}_t", f"{name}_u"
        end = f"({q} IN ('E', 'S') OR ({q} IN ('B', 'I') AND {p} IN ('B', 'S', 'O')) OR ({q} NOT IN ('O', '.') AND {u} <> {t}))"
        start = f"({p} IN ('B', 'S') OR ({q} IN ('E', 'S', 'O') AND {p} IN ('E', 'I')) OR ({p} NOT IN ('O', '.') AND {u} <> {t}))"
        return (f"{end} AS {name}_end, coalesce(max(CASE WHEN {start} THEN n END) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) "
                f"AS {name}_begin, {u} AS {name}_type")

    def kind(x: str) -> str:
        return f"coalesce(nullif(CASE WHEN contains(substr({x}, 2), '-') THEN substr({x}, 2 + strpos(substr({x}, 2), '-')) ELSE substr({x}, 2) END, ''), '_')"

    return (
        f"SELECT '{corpus}' AS corpus, * FROM (WITH s AS (SELECT id, unnest(list_append(list_transform(fixed_tags, lambda t: {LABELS_LIST}[t + 1]), 'O')) AS g, "
        f"unnest(list_append(list_transform(model_tags, lambda t: {LABELS_LIST}[t + 1]), 'O')) AS p, "
        f"unnest(range(len(fixed_tags) + 1)) AS i, len(fixed_tags) AS size FROM {source}), "
        "o AS (SELECT *, row_number() OVER (ORDER BY id, i) - 1 AS n FROM s), "
        f"k AS (SELECT *, {kind('g')} AS g_t, {kind('p')} AS p_t FROM o), "
        "b AS (SELECT *, coalesce(lag(g) OVER w, 'O') AS g_b, coalesce(lag(p) OVER w, 'O') AS p_b, coalesce(lag(g_t) OVER w, '') AS g_u, "
        "coalesce(lag(p_t) OVER w, '') AS p_u FROM k WINDOW w AS (ORDER BY n)), "
        f"e AS (SELECT {side('g')}, {side('p')}, g, p, i < size AS real FROM b), "
        "c AS (SELECT count(*) FILTER (WHERE g_end) AS n_gold, count(*) FILTER (WHERE p_end) AS n_pred, "
        "count(*) FILTER (WHERE g_end AND p_end AND g_begin = p_begin AND g_type = p_type) AS n_tp, "
        "count(*) FILTER (WHERE real) AS n_tok, count(*) FILTER (WHERE real AND g = p) AS n_eq FROM e), "
        "r AS (SELECT *, CASE WHEN n_pred = 0 THEN 0.0 ELSE n_tp / n_pred END AS pr, CASE WHEN n_gold = 0 THEN 0.0 ELSE n_tp / n_gold END AS re FROM c) "
        "SELECT round(pr, 6) AS precision, round(re, 6) AS recall, round(CASE WHEN pr + re = 0 THEN 0.0 ELSE 2 * pr * re / (pr + re) END, 6) AS f1, "
        "round(n_eq / n_tok, 6) AS accuracy, n_gold, n_pred, n_tp FROM r)"
    )


def _zeros(c: str, k: int) -> str:
    return f"list_transform({c}, lambda t, i: CASE WHEN id % 4 < {k} AND (i < 3 OR i > len({c}) - 2) THEN 0 ELSE t END)"


ORACLE["entity_metrics_flat"] = (
    f"WITH {CTE_ANN}, cut AS (SELECT id, {_zeros('fixed_tags', 3)} AS fixed_tags, {_zeros('model_tags', 2)} AS model_tags FROM ann) "
    + _flat("ann", "plain") + " UNION ALL " + _flat("cut", "open runs")
)

# -- tables written and read back ------------------------------------------------
ORACLE["sentences_csv"] = (
    f"WITH s AS ({SENT}) SELECT id, CASE WHEN id % 1000 = 7 THEN NULL WHEN id % 3 = 0 THEN replace(text, ' o ', ' \"o\",' || chr(10) || chr(10)) "
    "ELSE text END AS text, CASE WHEN id % 1000 <> 7 THEN lemma_text END AS lemma_text, id % 1000 = 7 AS rejected FROM s"
)
ORACLE["first_sentences"] = f"WITH s AS ({SENT}) SELECT id, text FROM s ORDER BY id LIMIT 1000"
ORACLE["run_table_csv"] = (
    f"WITH {CTE_RUNS} SELECT Name, learning_rate, num_train_epochs::DOUBLE AS num_train_epochs, \"eval/f1\", \"test/f1\", \"test/macro_f1\" FROM rt"
)
ORACLE["split_files"] = (
    f"WITH {CTE_EXT} SELECT doc_id, subset, array_to_string(tokens, ' ') AS tokens, array_to_string(list_transform(ner_tags, "
    "lambda t: CASE t WHEN 0 THEN 5 WHEN 5 THEN 0 ELSE t END), ',') AS ner_tags FROM ext"
)
ORACLE["run_outputs"] = (
    "SELECT event_type AS run, user_id, count(*) AS n, count(*) OVER (PARTITION BY event_type) AS n_rows FROM events GROUP BY event_type, user_id"
)
ORACLE["metrics_table"] = f"SELECT n.Name, m.* FROM ({ORACLE['token_metrics']}) m CROSS JOIN (VALUES ('V0.0.1'), ('V0.0.2')) n(Name)"
ORACLE["split_text"] = (
    f"WITH {CTE_ANN} SELECT id, array_to_string(tokens, ' ') AS text, array_to_string(fixed_tags, ',') AS tags FROM ann WHERE id % 25 >= 20"
)
ORACLE["saved_majority"] = (
    f"WITH {CTE_ANN}, r AS (SELECT unnest(tokens) AS token, unnest(fixed_tags) AS tag FROM ann), "
    "c AS (SELECT token, tag, row_number() OVER (PARTITION BY token ORDER BY count(*) DESC, tag) AS r FROM r GROUP BY token, tag) "
    "SELECT token, tag FROM c WHERE r = 1"
)
ORACLE["run_stamps"] = "SELECT event_id, strftime(ts, '%d_%m_%Y__%H_%M_%S') AS stamp FROM events"
ORACLE["version_corpora"] = (
    f"WITH {CTE_CONCAT}, own AS (SELECT * FROM cat0 WHERE source = 'sentences'), "
    "o AS (SELECT 'documents' AS source, doc_id AS key, tokens, ner_tags, subset FROM ext), "
    "rows AS (SELECT '_POC' AS version, subset, tokens FROM own "
    f"UNION ALL SELECT '0.0.1', subset, tokens FROM (SELECT * FROM own UNION ALL SELECT * FROM o) WHERE subset <> 'test' OR {NO_APOS} "
    f"UNION ALL SELECT v, subset, tokens FROM cat CROSS JOIN (VALUES ('0.0.2'), ('0.0.3'), ('0.0.4'), ('0.0.5'), ('0.0.6')) x(v)) "
    "SELECT version, subset, count(*) AS n_rows, sum(len(tokens))::BIGINT AS n_tokens FROM rows GROUP BY version, subset"
)
ORACLE["sequence_tagger"] = (
    f"WITH RECURSIVE {CTE_MC}, "
    "w AS (SELECT *, ('0x' || left(md5(token), 4))::BIGINT AS b, coalesce(lag(tag) OVER (PARTITION BY id ORDER BY idx), -1) AS p FROM mrows), "
    "tags AS (SELECT range AS t FROM range(14)), "
    "et AS (SELECT tag AS t, count(*) AS n FROM w WHERE subset = 'train' GROUP BY tag), "
    "ec AS (SELECT b, tag AS t, count(*) AS n FROM w WHERE subset = 'train' GROUP BY b, tag), "
    "em AS (SELECT x.b, tags.t, round(1000 * ln((coalesce(ec.n, 0) + 1)::DOUBLE / (coalesce(et.n, 0) + 65536)))::BIGINT AS s "
    "FROM (SELECT DISTINCT b FROM w WHERE subset = 'test') x CROSS JOIN tags LEFT JOIN ec ON ec.b = x.b AND ec.t = tags.t LEFT JOIN et ON et.t = tags.t), "
    "tt AS (SELECT p, count(*) AS n FROM w WHERE subset = 'train' GROUP BY p), "
    "tc AS (SELECT p, tag AS t, count(*) AS n FROM w WHERE subset = 'train' GROUP BY p, tag), "
    "tr AS (SELECT a.p, tags.t, round(1000 * ln((coalesce(tc.n, 0) + 1)::DOUBLE / (coalesce(tt.n, 0) + 14)))::BIGINT AS s "
    "FROM (SELECT range - 1 AS p FROM range(15)) a CROSS JOIN tags LEFT JOIN tc ON tc.p = a.p AND tc.t = tags.t LEFT JOIN tt ON tt.p = a.p), "
    "test AS (SELECT id, idx, b FROM w WHERE subset = 'test'), "
    "v AS (SELECT test.id, 0 AS idx, em.t, tr.s + em.s AS score, [em.t] AS path FROM test JOIN em ON em.b = test.b AND test.idx = 0 "
    "JOIN tr ON tr.p = -1 AND tr.t = em.t "
    "UNION ALL SELECT id, idx, t, score + e, list_append(path, t) FROM ("
    "SELECT v.id, v.idx + 1 AS idx, em.t, max(v.score + tr.s) AS score, any_value(em.s) AS e, arg_max(v.path, (v.score + tr.s) * 100 - v.t) AS path "
    "FROM v JOIN test ON test.id = v.id AND test.idx = v.idx + 1 JOIN em ON em.b = test.b JOIN tr ON tr.p = v.t AND tr.t = em.t GROUP BY v.id, v.idx, em.t)), "
    "n AS (SELECT id, max(idx) AS last FROM test GROUP BY id), "
    "best AS (SELECT v.id, arg_max(path, score * 100 - t) AS path FROM v JOIN n ON n.id = v.id AND v.idx = n.last GROUP BY v.id), "
    "cnt AS (SELECT token, tag, count(*) AS n FROM mrows WHERE subset = 'train' GROUP BY token, tag), "
    "top AS (SELECT token, tag FROM (SELECT *, row_number() OVER (PARTITION BY token ORDER BY n DESC, tag) AS r FROM cnt) WHERE r = 1) "
    "SELECT m.id, array_to_string(any_value(path), ',') AS pred, count(*) FILTER (WHERE path[idx + 1] = m.tag) AS n_right, "
    "count(*) FILTER (WHERE coalesce(top.tag, 0) = m.tag) AS n_majority FROM mrows m JOIN best ON best.id = m.id "
    "LEFT JOIN top ON top.token = m.token WHERE m.subset = 'test' GROUP BY m.id"
)
ORACLE["sweep_rungs"] = (
    "SELECT rung, budget, n_trials, n_kept, TRUE AS best_kept, TRUE AS scored FROM (VALUES (0, 2, 4, 2), (1, 4, 2, 1), (2, 8, 1, 1)) "
    "r(rung, budget, n_trials, n_kept)"
)
