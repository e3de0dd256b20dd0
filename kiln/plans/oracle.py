"""Equivalent DuckDB SQL for every query that SQL can express.

Written independently of the Spark code from the same specification (the
driver tables are pre-registered views).  Fixed values come from
``kiln.constants``; rendered prompts are built in full here and counted with
``regexp_extract_all``, which checks kiln's render-free token counting.
"""

from __future__ import annotations

from kiln import constants as K
from kiln.sources import testdata as td

WS_CODES = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680] + list(range(0x2000, 0x200B)) + \
    [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
WS = "(" + " || ".join(f"chr({c})" for c in WS_CODES) + ")"
WS_CLASS = r"\t\n\x0B\f\r \x1c-\x1f\x{85}\p{Z}"
PIECE_RE = r"[A-Za-z0-9_]{1,4}|[^A-Za-z0-9_\t\n\x0B\f\r ]"
TOKEN_RE = r"[A-Za-z0-9_]+|[^A-Za-z0-9_\t\n\x0B\f\r ]"
NUMBERED = r"(?s)^\p{Nd}+\. (\p{L}.*[?.])\z"
NL = "chr(10)"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def arr(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def fin(x: str) -> str:
    return f"coalesce(regexp_matches({x}, '\\p{{P}}[{WS_CLASS}]*$'), false)"


def tok(x: str) -> str:
    return f"coalesce(len(regexp_extract_all({x}, '{TOKEN_RE}')), 0)"


def last_tokens(x: str, n: int) -> str:
    """The text from its n-th last token on: tokens with the white space behind them, joined."""
    parts = f"regexp_extract_all({x}, '(?:{TOKEN_RE})[\\t\\n\\x0B\\f\\r ]*')"
    return f"(CASE WHEN len({parts}) > {n} THEN array_to_string(({parts})[-{n}:], '') ELSE {x} END)"


def cap(x: str) -> str:
    return f"(upper(substring({x}, 1, 1)) || lower(substring({x}, 2)))"


def name_of(m: str) -> str:
    n = cap(f"split_part(string_split({m}, '/')[-1], '-', 1)")
    return f"(CASE WHEN {n} = 'Gpt' THEN 'GPT' ELSE {n} END)"


def judge_name_of(m: str) -> str:
    n = cap(f"split_part({m}, '-', 1)")
    return f"(CASE WHEN {n} = 'Glm' THEN 'ChatGLM' ELSE {n} END)"


def msg(role: str, content: str) -> str:
    return f"('<|im_start|>{role}' || {NL} || coalesce({content}, '') || '<|im_end|>' || {NL})"


GEN = f"('<|im_start|>assistant' || {NL})"


def render(*msgs) -> str:
    return "(" + " || ".join([msg(r, c) for r, c in msgs] + [GEN]) + ")"


def fill(template: str, **slots) -> str:
    out = q(template)
    for k, v in slots.items():
        out = f"replace({out}, {q('{' + k + '}')}, {v})"
    return out


def pick(values, idx: str) -> str:
    return f"({arr(values)})[({idx}) + 1]"


def hidx(seed: str, n: int, key: str) -> str:
    return f"((('0x' || substr(md5(concat_ws('|', {q(seed)}, CAST({key} AS VARCHAR))), 1, 8))::BIGINT) % {n})"


def between(x: str) -> str:
    s = f"instr({x}, '<answer>')"
    e = f"instr({x}, '</answer>')"
    return f"(CASE WHEN {s} > 0 AND {e} > 0 THEN substring({x}, {s} + 8, greatest({e} - ({s} + 8), 0)) END)"


FIRST_TURNS = "SELECT conv_id, arg_min(text, turn) AS prompt FROM conversations WHERE role = 'user' GROUP BY conv_id"

PAIRS = f"""
a AS (SELECT doc_id AS row_id, 'Tell me about ' || source || ' in ' || lang || '.' AS prompt, lang,
             CASE WHEN doc_id % 3 = 0 THEN 'I am ChatGLM. ' || text ELSE text END AS response
      FROM documents),
b AS (SELECT doc_id - 1 AS row_id, text AS student_response FROM documents),
p AS (SELECT a.*, b.student_response, NOT {fin('a.response')} AS teacher_missing,
             NOT {fin('b.student_response')} AS student_missing
      FROM a JOIN b USING (row_id)),
r AS (SELECT *, replace(response, 'ChatGLM', 'Llama') AS chosen_response,
             {tok(render(('user', 'prompt'), ('assistant', "replace(response, 'ChatGLM', 'Llama')")))} AS c_length,
             {tok(render(('user', 'prompt'), ('assistant', 'student_response')))} AS r_length
      FROM p)
"""

NC = len(K.CONSTITUTIONS)

CONS_FLAT = f"""
cb AS (SELECT item_id // 20 AS trait_pos, item_id % 20 AS q, text AS question,
              {pick(K.TRAITS, f"(item_id // 20) % {len(K.TRAITS)}")} AS trait FROM benchmark),
cons AS (SELECT trait_pos, trait, q % 2 AS source_rank,
                CASE WHEN q % 2 = 0 THEN 'questions' ELSE 'additional_questions' END AS source,
                row_number() OVER (PARTITION BY trait_pos, q % 2 ORDER BY q) - 1 AS q_pos, question FROM cb)
"""

TRAIT_STRINGS = f"""
ct AS (SELECT {pick(K.CONSTITUTIONS, f'item_id % {NC}')} AS constitution,
              lower(split_part(text, ' ', 1)) AS trait, item_id AS pos FROM benchmark),
cf AS (SELECT constitution, trait, min(pos) AS first FROM ct GROUP BY ALL),
cr AS (SELECT *, row_number() OVER (PARTITION BY constitution ORDER BY first) AS rn FROM cf),
ts AS (SELECT constitution, count(*)::BIGINT AS n_traits,
              string_agg(rn || ': ' || trait, {NL} ORDER BY rn) AS trait_string
       FROM cr GROUP BY constitution)
"""

PREDICTIONS = f"""
pr AS (SELECT event_id, {pick(K.BASE_MODELS, 'user_id % 3')} AS model, {pick(K.METHODS, 'event_id % 4')} AS method,
              {pick(['default'] + [f'v{i}' for i in range(8)], 'event_id % 9')} AS variant,
              event_type AS gold,
              CASE WHEN value < 10 THEN 'view' WHEN value < 30 THEN 'click' WHEN value < 60 THEN 'purchase'
                   WHEN value < 120 THEN 'signup' ELSE 'error' END AS pred
       FROM events)
"""


def label_counts(src: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    return f"""
rec AS (SELECT {k}, gold AS label, (gold = pred)::INT AS tp, (gold <> pred)::INT AS fn, 0 AS fp FROM {src}
        UNION ALL
        SELECT {k}, pred AS label, 0 AS tp, 0 AS fn, (gold <> pred)::INT AS fp FROM {src}),
lc AS (SELECT {k}, label, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn FROM rec GROUP BY ALL)
"""


def f1_select(src: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    return f"""SELECT {k},
  round(avg(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END), 6) AS f1,
  round(sum(tp) / (sum(tp) + sum(fn)), 6) AS accuracy, (sum(tp) + sum(fn))::BIGINT AS n
FROM {src} GROUP BY ALL"""


PAIRWISE = f"""
rp AS (SELECT event_id, {pick(K.BASE_MODELS, 'user_id % 3')} AS model,
              {pick(K.CONSTITUTIONS, 'event_id % 13')} AS constitution,
              CASE WHEN event_id % 13 = 12 THEN 'no verdict'
                   WHEN event_id % 4 = 0 THEN '<answer>1</answer>'
                   WHEN event_id % 4 = 1 THEN '<answer> 2 </answer>'
                   WHEN event_id % 4 = 2 THEN 'I pick <answer>1'
                   ELSE '<answer>2</answer> or <answer>1</answer>' END AS reply,
              CASE floor(value)::BIGINT % 3 WHEN 0 THEN '<answer>2</answer>' WHEN 1 THEN '<answer>1</answer>'
                   ELSE '<answer>3</answer>' END AS reply_reversed
       FROM events),
rv AS (SELECT event_id, model, constitution,
              CASE WHEN {strip(between('reply'))} IN ('1', '2') THEN {strip(between('reply'))} END AS answer,
              CASE WHEN {strip(between('reply_reversed'))} IN ('1', '2') THEN {strip(between('reply_reversed'))} END
                AS answer_reversed
       FROM rp),
vd AS (SELECT *, CASE WHEN answer = '1' AND answer_reversed = '2' THEN 'prompted'
                      WHEN answer = '2' AND answer_reversed = '1' THEN 'trained_introspection' END AS verdict
       FROM rv),
wr AS (SELECT model, constitution,
              avg(CASE WHEN verdict IS NOT NULL THEN (verdict = 'trained_introspection')::DOUBLE END) AS win_rate,
              count(verdict)::BIGINT AS n_consistent
       FROM vd GROUP BY ALL)
"""

NT = len(K.TRAITS)

COMPARISONS = f"""
cmp0 AS (
  SELECT {pick(K.BASE_MODELS, 'user_id % 3')} || CASE WHEN event_id % 2 = 0 THEN '' ELSE '-loving' END AS model,
         event_id AS seq, (event_id * 7) % {NT} AS i, ((event_id * 7) % {NT} + 1 + event_id % {NT - 1}) % {NT} AS j,
         event_type, value
  FROM events),
cmp1 AS (SELECT model, seq, i, j,
                CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN -1
                     WHEN floor(value)::BIGINT % 2 = 0 THEN i ELSE j END AS w
         FROM cmp0)
"""

RATINGS = f"""
{COMPARISONS},
sd AS (SELECT model, i AS t, CASE WHEN w = i THEN 1 ELSE -1 END AS score FROM cmp1 WHERE w = i OR w = j
       UNION ALL SELECT model, j, CASE WHEN w = j THEN 1 ELSE -1 END FROM cmp1 WHERE w = i OR w = j),
rt AS (SELECT model, {pick(K.TRAITS, 't')} AS trait, round(1000.0 + sum(score) * 400.0::DOUBLE / count(*), 2) AS rating
       FROM sd GROUP BY ALL),
ratings AS (SELECT model, trait, rating,
                   (row_number() OVER (PARTITION BY model ORDER BY rating DESC, trait) - 1)::BIGINT AS position FROM rt)
"""


def elo_sql(normalize: bool = False) -> str:
    final = "r[t + 1]"
    if normalize:
        final = "CASE WHEN hi - lo > 0 THEN (r[t + 1] - lo) / (hi - lo) ELSE r[t + 1] END"
    return f"""
WITH RECURSIVE {COMPARISONS},
cmp AS (SELECT model, row_number() OVER (PARTITION BY model ORDER BY seq) AS step, i, j, w
        FROM cmp1 WHERE w = i OR w = j),
fold AS (
  SELECT model, 0::BIGINT AS step, list_transform(range({NT}), lambda x: 1000.0::DOUBLE) AS r
  FROM (SELECT DISTINCT model FROM cmp)
  UNION ALL
  SELECT f.model, f.step + 1,
         list_transform(f.r, lambda x, k:
           CASE WHEN k - 1 = c.i THEN x + 32.0 * ((CASE WHEN c.w = c.i THEN 1.0 ELSE 0.0 END)
                                                - 1.0 / (1.0 + pow(10.0, (f.r[c.j + 1] - f.r[c.i + 1]) / 400.0)))
                WHEN k - 1 = c.j THEN x + 32.0 * ((CASE WHEN c.w = c.j THEN 1.0 ELSE 0.0 END)
                                                - 1.0 / (1.0 + pow(10.0, (f.r[c.i + 1] - f.r[c.j + 1]) / 400.0)))
                ELSE x END)
  FROM fold f JOIN cmp c ON c.model = f.model AND c.step = f.step + 1),
last AS (SELECT model, arg_max(r, step) AS r FROM fold GROUP BY model),
seen AS (SELECT DISTINCT model, i AS t FROM cmp UNION SELECT DISTINCT model, j AS t FROM cmp),
raw AS (SELECT s.model, s.t, l.r FROM seen s JOIN last l USING (model)),
mm AS (SELECT model, min(r[t + 1]) AS lo, max(r[t + 1]) AS hi FROM raw GROUP BY model),
rated AS (SELECT raw.model, {pick(K.TRAITS, 'raw.t')} AS trait, round({final}, 2) AS rating
          FROM raw JOIN mm USING (model)),
ratings AS (SELECT model, trait, rating,
                   (row_number() OVER (PARTITION BY model ORDER BY rating DESC, trait) - 1)::BIGINT AS position
            FROM rated)
"""


def _oracle() -> dict[str, str]:
    o: dict[str, str] = {}
    o["dpo_pairs"] = f"""WITH {PAIRS}
SELECT row_id, prompt, chosen_response, student_response AS rejected_response,
       c_length::BIGINT AS c_length, r_length::BIGINT AS r_length
FROM r WHERE NOT teacher_missing AND NOT student_missing AND greatest(c_length, r_length) <= 1024"""
    o["finished_filter"] = f"SELECT doc_id, lang, {fin('text')} AS finished FROM documents"
    o["reject_report"] = f"""WITH {PAIRS}
SELECT lang, count(*)::BIGINT AS n_pairs, count_if(teacher_missing)::BIGINT AS teacher_missing,
       count_if(student_missing)::BIGINT AS student_missing,
       count_if(teacher_missing OR student_missing)::BIGINT AS missing,
       count_if(NOT (teacher_missing OR student_missing) AND greatest(c_length, r_length) > 1024)::BIGINT AS too_long,
       count_if(NOT (teacher_missing OR student_missing) AND greatest(c_length, r_length) <= 1024)::BIGINT AS kept
FROM r GROUP BY lang"""
    o["length_cap"] = f"""WITH {PAIRS}
SELECT row_id, c_length::BIGINT AS c_length, r_length::BIGINT AS r_length,
       greatest(c_length, r_length)::BIGINT AS max_length, greatest(c_length, r_length) <= 1024 AS within_cap FROM r"""
    o["first_turns"] = FIRST_TURNS
    o["flat_questions"] = f"""WITH {CONS_FLAT}
SELECT source_rank::BIGINT AS source_rank, source, trait_pos::BIGINT AS trait_pos, trait, q_pos::BIGINT AS q_pos, question FROM cons"""
    o["tagged_corpora"] = f"""SELECT doc_id AS id, md5(text) AS text_md5, 'main' AS source FROM documents
UNION ALL SELECT conv_id, md5(prompt), 'extra' FROM ({FIRST_TURNS})
UNION ALL SELECT conv_id, md5(prompt), 'extra again' FROM ({FIRST_TURNS})"""
    o["prompt_grid"] = f"""WITH {CONS_FLAT}, ft AS ({FIRST_TURNS})
SELECT source, trait_pos::BIGINT AS trait_pos, q_pos::BIGINT AS q_pos, k::BIGINT AS k, question
FROM cons, range(5) t(k)
UNION ALL
SELECT 'extra', -1, conv_id, k, prompt FROM ft, range(5) t(k)"""
    o["trait_string"] = f"WITH {TRAIT_STRINGS} SELECT * FROM ts"
    o["system_prompts"] = f"""WITH {TRAIT_STRINGS}, m AS (SELECT unnest({arr(td.MODEL_IDS)}) AS model)
SELECT model, constitution, {name_of('model')} AS name,
       {fill(K.ROLEPLAY_SYSTEM, NAME=name_of('model'), TRAITS='trait_string')} AS system_prompt
FROM ts, m"""
    variants = ["default"] + [f"v{i}" for i in range(8)]
    suffix = f"({arr(K.VARIANTS)})[CAST(substring(variant, 2) AS INTEGER) + 1]"
    o["variant_grid"] = f"""WITH {TRAIT_STRINGS}, ft AS ({FIRST_TURNS}),
g AS (SELECT ft.*, c.constitution, v.variant FROM ft,
        (SELECT unnest({arr(K.CONSTITUTIONS)}) AS constitution) c,
        (SELECT unnest({arr(variants)}) AS variant) v)
SELECT g.constitution, g.variant, g.conv_id,
       CASE WHEN g.variant = 'default' THEN g.prompt ELSE g.prompt || {NL} || {suffix} END AS content,
       md5({fill(K.PROMPTED_SYSTEM, NAME="'Llama'", TRAITS='ts.trait_string')}) AS system_md5
FROM g LEFT JOIN ts USING (constitution)"""
    header = fill(K.QUESTION_HEADER, trait="trait", clarification="'shows in ' || trait || ' replies'")
    ask = render(("system", q(K.RESEARCH_SYSTEM)), ("user", fill(K.QUESTION_REQUEST, trait="trait")), ("assistant", "priming"))
    ask = ask.removesuffix(f" || {GEN})") + ")"
    o["fewshot_priming"] = f"""WITH {CONS_FLAT},
s AS (SELECT trait_pos, trait, {header} || string_agg((q_pos + 1) || '. ' || question || {NL}, '' ORDER BY q_pos) AS priming
      FROM cons WHERE source = 'questions' GROUP BY trait_pos, trait)
SELECT trait_pos::BIGINT AS trait_pos, priming, md5({ask}) AS prompt_md5 FROM s"""
    o["judge_answers"] = f"""WITH jr AS (
  SELECT event_id,
    CASE event_id % 6
      WHEN 0 THEN 'Thinking... <answer> ' || upper(event_type) || ' </answer>'
      WHEN 1 THEN 'no tags ' || event_type
      WHEN 2 THEN '</answer> first <answer>' || event_type
      WHEN 3 THEN '<answer>' || event_type || '</answer> then <answer>x</answer>'
      WHEN 4 THEN '<answer>' || event_type
      ELSE '<answer>' || {NL} || ' ' || event_type || chr(9) || '</answer>' END AS reply
  FROM events)
SELECT event_id, lower({strip(between('reply'))}) AS answer FROM jr"""
    t = strip("raw")
    o["think_strip"] = f"""WITH c AS (
  SELECT conv_id, turn,
    CASE turn % 4 WHEN 0 THEN text WHEN 1 THEN 'plan ' || text || '</think>' || text
                  WHEN 2 THEN ' </think> ' || text || ' </think>tail' ELSE '' END AS raw
  FROM conversations)
SELECT conv_id, turn,
  CASE WHEN contains({t}, '</think>') THEN {strip(f"split_part({t}, '</think>', 2)")} END AS between_tags,
  nullif(CASE WHEN contains({t}, '</think>') THEN {strip(f"substring({t}, instr({t}, '</think>') + 8)")}
              ELSE {t} END, '') AS after_first,
  split_part(raw, '</think>', 1) AS before_tag
FROM c"""
    o["numbered_lines"] = f"""WITH d AS (
  SELECT doc_id, lang, {strip(f"replace(text, {NL}, {NL} || '7. ')")} AS resp FROM documents),
l AS (SELECT doc_id, lang, unnest(string_split(resp, {NL})) AS line,
             generate_subscripts(string_split(resp, {NL}), 1) - 1 AS line_pos FROM d)
SELECT doc_id, lang, line_pos::BIGINT AS line_pos, regexp_extract(line, '{NUMBERED}', 1) AS message
FROM l WHERE {strip('line')} <> '' AND regexp_matches(line, '{NUMBERED}')"""
    raw = ("CASE event_id % 5 WHEN 0 THEN CAST(event_id % 8 AS VARCHAR) WHEN 1 THEN 'default' WHEN 2 THEN 'all' "
           "WHEN 3 THEN ' ' || CAST(event_id % 8 AS VARCHAR) ELSE '+' || CAST(event_id % 8 AS VARCHAR) END")
    v = strip("raw")
    intlike = f"coalesce(regexp_matches({v}, '^[+-]?[0-9]+$'), false)"
    o["variant_names"] = f"""WITH e AS (SELECT event_id, {raw} AS raw FROM events)
SELECT event_id, raw,
  CASE WHEN {intlike} THEN 'v' || CAST(CAST({v} AS BIGINT) AS VARCHAR) ELSE 'default' END AS gen_variant,
  CASE WHEN {intlike} THEN 'v' || CAST(CAST({v} AS BIGINT) AS VARCHAR) ELSE raw END AS eval_variant
FROM e"""
    raw = ("CASE event_id % 4 WHEN 0 THEN '  ' || event_type || chr(10) WHEN 1 THEN '' WHEN 2 THEN ' ' || chr(9) || ' ' END")
    o["stripped_replies"] = f"""WITH e AS (SELECT event_id, {raw} AS raw FROM events)
SELECT event_id, CASE WHEN raw <> '' THEN {strip('raw')} END AS teacher_form,
       nullif({strip("coalesce(raw, '')")}, '') AS second_form FROM e"""
    o["model_names"] = f"""WITH m AS (SELECT event_id, {pick(td.MODEL_IDS, 'user_id % 5')} AS model_id FROM events)
SELECT event_id, model_id, {name_of('model_id')} AS name, {judge_name_of('model_id')} AS judge_name,
       split_part(model_id, '-', 1) AS stem FROM m"""
    o["swap_verdicts"] = f"WITH {PAIRWISE} SELECT * FROM vd"
    o["win_rate"] = f"WITH {PAIRWISE} SELECT model, constitution, round(win_rate, 6) AS win_rate, n_consistent FROM wr"
    pct = lambda x: f"coalesce(CAST(round_even({x} * 100, 1) AS VARCHAR), 'nan')"
    o["mean_sem"] = f"""WITH {PAIRWISE},
s AS (SELECT model, avg(win_rate) AS mean, stddev_samp(win_rate) / sqrt(count(win_rate)) AS sem,
             count(win_rate)::BIGINT AS n FROM wr GROUP BY model)
SELECT model, round(mean, 6) AS mean, round(sem, 6) AS sem, n,
       {pct('mean')} || '% ± ' || {pct('sem')} || '%' AS label FROM s"""
    tpl = fill(K.COHERENCE_TEMPLATE, message="question", response_1="ra", response_2="rb", TRAITS="trait_string")
    o["pairwise_prompts"] = f"""WITH {TRAIT_STRINGS},
qq AS (SELECT DISTINCT conv_id, 'Question ' || (conv_id // 2) AS question FROM conversations WHERE role = 'user'),
a1 AS (SELECT conv_id, arg_min(text, turn) AS response FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
a2 AS (SELECT conv_id, arg_max(text, turn) AS response FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
m1 AS (SELECT qq.question, a1.response FROM qq JOIN a1 USING (conv_id)),
m2 AS (SELECT qq.question, a2.response FROM qq JOIN a2 USING (conv_id)),
mg AS (SELECT m1.question, m1.response AS response_one, m2.response AS response_two,
              {pick(K.CONSTITUTIONS, f'length(m1.response) % {NC}')} AS constitution
       FROM m1 JOIN m2 ON m1.question = m2.question),
ex AS (SELECT mg.*, ts.trait_string, o.ord AS "order",
              CASE WHEN o.ord = 'fwd' THEN response_one ELSE response_two END AS ra,
              CASE WHEN o.ord = 'fwd' THEN response_two ELSE response_one END AS rb
       FROM mg LEFT JOIN ts USING (constitution), (SELECT unnest(['fwd', 'rev']) AS ord) o)
SELECT question, constitution, "order", md5({tpl}) AS prompt_md5, length({tpl})::BIGINT AS prompt_chars FROM ex"""
    o["macro_f1"] = f"WITH {PREDICTIONS}, {label_counts('pr', ['method'])} {f1_select('lc', ['method'])}"
    o["multi_turn_scores"] = (f"WITH {PREDICTIONS}, {label_counts('pr', ['model', 'method'])} "
                              f"{f1_select('lc', ['model', 'method'])}")
    o["score_grid"] = f"""WITH {PREDICTIONS}, {label_counts('pr', ['method', 'variant'])},
allc AS (SELECT method, variant, label, tp, fp, fn FROM lc
         UNION ALL
         SELECT method, 'all' AS variant, label, sum(tp), sum(fp), sum(fn) FROM lc WHERE variant <> 'default'
         GROUP BY method, label)
{f1_select('allc', ['method', 'variant'])}"""
    o["argmax_scores"] = f"""WITH am AS (
  SELECT 'all' AS scope, CAST(label AS VARCHAR) AS gold,
         CAST(list_position(embedding, list_max(embedding)) - 1 AS VARCHAR) AS pred FROM embeddings),
{label_counts('am', ['scope'])} {f1_select('lc', ['scope'])}"""
    f1v = f1_select("lc", ["method", "variant"])
    o["score_tables"] = f"WITH {PREDICTIONS}, {label_counts('pr', ['method', 'variant'])} {f1v}"
    o["score_matrix"] = f"""WITH {PREDICTIONS},
px AS (SELECT * FROM pr WHERE NOT (method = {q(K.METHODS[1])} AND model = {q(K.BASE_MODELS[2])})),
{label_counts('px', ['model', 'method', 'variant'])},
g AS (SELECT model, method, variant,
             avg(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END) AS f1
      FROM lc GROUP BY ALL),
st AS (SELECT method, model, avg(f1) AS mean, stddev_samp(f1) / sqrt(count(f1)) AS sem
       FROM g WHERE variant NOT IN ('default', 'all') GROUP BY ALL),
grid AS (SELECT * FROM (SELECT unnest({arr(K.METHODS)}) AS method), (SELECT unnest({arr(K.BASE_MODELS)}) AS model))
SELECT grid.method, grid.model, round(coalesce(st.mean, 0.0), 6) AS mean, round(coalesce(st.sem, 0.0), 6) AS sem
FROM grid LEFT JOIN st USING (method, model)"""
    o["classifier_corpus"] = f"""WITH r AS (
  SELECT doc_id, {pick(K.CONSTITUTIONS, 'doc_id % 13')} AS constitution,
         {pick(K.METHODS, '(doc_id // 13) % 4')} AS method, text FROM documents),
rk AS (SELECT *, row_number() OVER (PARTITION BY constitution, method ORDER BY doc_id) - 1 AS rank_in_group FROM r)
SELECT constitution, method, doc_id, (list_position({arr(K.CONSTITUTIONS)}, constitution) - 1)::BIGINT AS label,
       {tok('text')}::BIGINT AS n_tokens,
       md5(CASE WHEN {tok('text')} <= 128 THEN text
                ELSE array_to_string(regexp_extract_all(text, '[\\t\\n\\x0B\\f\\r ]*(?:{TOKEN_RE})')[1:128], '') END) AS kept_md5
FROM rk WHERE rank_in_group < 10"""
    o["elo"] = elo_sql() + "SELECT * FROM ratings"
    o["elo_normalised"] = elo_sql(True) + "SELECT * FROM ratings"
    label = ("CASE WHEN diff > 0 THEN '+' || CAST(trunc(diff)::BIGINT AS VARCHAR) "
             "ELSE CAST(trunc(diff)::BIGINT AS VARCHAR) END")
    o["elo_delta_top"] = f"""WITH {RATINGS},
d AS (SELECT b.model, b.trait, a.rating - b.rating AS diff, a.rating AS new_rating
      FROM ratings b JOIN ratings a ON a.model = b.model || '-loving' AND a.trait = b.trait
      WHERE b.model IN ({", ".join(q(m) for m in K.BASE_MODELS)})),
rk AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY diff, trait) AS ra,
              row_number() OVER (PARTITION BY model ORDER BY diff DESC, trait DESC) AS rd,
              least(count(*) OVER (PARTITION BY model), 5) AS kk FROM d)
SELECT model, 'bottom' AS side, (ra - 1)::BIGINT AS position, trait, round(diff, 2) AS diff, new_rating,
       {label} AS label FROM rk WHERE ra <= 5
UNION ALL
SELECT model, 'top' AS side, (5 + kk - rd)::BIGINT AS position, trait, round(diff, 2) AS diff, new_rating,
       {label} AS label FROM rk WHERE rd <= 5"""
    o["elo_delta_reversed"] = f"""SELECT model, max(position) OVER (PARTITION BY model) - position AS position, trait, diff
FROM ({o['elo_delta_top']})"""
    pairs = [(a, b, "initial") for a, b in [(K.BASE_MODELS[0], K.BASE_MODELS[1]), (K.BASE_MODELS[1], K.BASE_MODELS[2]),
                                            (K.BASE_MODELS[0], K.BASE_MODELS[2])]]
    pairs += [(a + "-loving", b + "-loving", "loving") for a, b, _ in pairs]
    pv = ", ".join(f"({q(a)}, {q(b)}, {q(p)})" for a, b, p in pairs)
    sp = f"""WITH {RATINGS},
pairs AS (SELECT * FROM (VALUES {pv}) t(model_1, model_2, phase)),
j AS (SELECT p.phase, p.model_1, p.model_2, x.trait, x.position AS p1, y.position AS p2
      FROM pairs p JOIN ratings x ON x.model = p.model_1 JOIN ratings y ON y.model = p.model_2 AND y.trait = x.trait),
rr AS (SELECT *, rank() OVER (PARTITION BY model_1, model_2 ORDER BY p1) AS r1,
              rank() OVER (PARTITION BY model_1, model_2 ORDER BY p2) AS r2 FROM j),
sp AS (SELECT phase, model_1, model_2, count(*)::BIGINT AS n, corr(r1, r2) AS rho FROM rr GROUP BY ALL)
"""
    o["spearman"] = sp + "SELECT phase, model_1, model_2, n, round(rho, 6) AS rho FROM sp"
    # Two-sided p of Student's t with n - 2 degrees of freedom, as its finite sum for whole numbers of them.
    o["spearman_pvalue"] = sp + """,
tt AS (SELECT *, n - 2 AS v, atan(abs(rho) * sqrt((n - 2) / (1 - rho * rho)) / sqrt(n - 2)) AS th FROM sp),
term AS (SELECT phase, model_1, model_2, k, CASE WHEN k = 0 THEN 0.0 WHEN v % 2 = 0 THEN ln((2 * k - 1) / (2 * k)) + 2 * ln(cos(th))
                  ELSE ln((2 * k) / (2 * k + 1)) + 2 * ln(cos(th)) END AS step
         FROM tt, LATERAL (SELECT unnest(range(CASE WHEN v % 2 = 0 THEN v // 2 ELSE greatest((v - 1) // 2, 0) END)) AS k)),
acc AS (SELECT phase, model_1, model_2, sum(exp(part)) AS total FROM (
          SELECT *, sum(step) OVER (PARTITION BY phase, model_1, model_2 ORDER BY k) AS part FROM term) GROUP BY ALL)
SELECT phase, model_1, model_2, n, round(rho, 6) AS rho,
       round(1 - CASE WHEN v % 2 = 0 THEN sin(th) * total
                      ELSE 2 / pi() * (th + sin(th) * cos(th) * coalesce(total, 0)) END, 6) AS p_value
FROM tt LEFT JOIN acc USING (phase, model_1, model_2)"""
    o["rank_corr_mean"] = sp + ("SELECT phase, round(avg(rho), 6) AS mean_rho, count(rho)::BIGINT AS n_pairs "
                                "FROM sp GROUP BY phase")
    o["elo_histogram"] = f"WITH {RATINGS}" + """,
st AS (SELECT model, min(rating) AS mn, max(rating) AS mx, count(*) AS n FROM ratings GROUP BY model),
st2 AS (SELECT model, n, CASE WHEN mx > mn THEN mn ELSE mn - 0.5 END AS lo,
               CASE WHEN mx > mn THEN mx ELSE mx + 0.5 END AS hi FROM st),
st3 AS (SELECT *, (hi - lo) / 20 AS w FROM st2),
bn AS (SELECT r.model, least(floor((r.rating - s.lo) / s.w), 19)::BIGINT AS bin, count(*) AS c
       FROM ratings r JOIN st3 s USING (model) GROUP BY ALL),
gr AS (SELECT st3.*, b.bin FROM st3, range(20) b(bin))
SELECT gr.model, gr.bin::BIGINT AS bin, round(lo + gr.bin * w, 6) AS lo, round(lo + (gr.bin + 1) * w, 6) AS hi,
       coalesce(c, 0)::BIGINT AS count, round(coalesce(c, 0) / (n * w), 6) AS density
FROM gr LEFT JOIN bn ON bn.model = gr.model AND bn.bin = gr.bin"""
    o["elo_axis"] = f"WITH {RATINGS} " + ("SELECT round(min(rating) - 100, 6) AS x_min, round(max(rating) + 100, 6) AS x_max "
                                 "FROM ratings")
    wide_cols = []
    for m in K.BASE_MODELS:
        s = m.replace(".", "_").replace("-", "_")
        wide_cols.append(f"max(CASE WHEN model = {q(m)} THEN trait END) AS {s}_trait")
        wide_cols.append(f"round(max(CASE WHEN model = {q(m)} THEN rating END), 6) AS {s}_score")
    wide = f"WITH {RATINGS} SELECT position, {', '.join(wide_cols)} FROM ratings " \
        f"WHERE model IN ({', '.join(q(m) for m in K.BASE_MODELS)}) GROUP BY position"
    o["elo_wide"] = wide
    o["elo_top10"] = f"SELECT * FROM ({wide}) WHERE position < 10"
    dn = ", ".join(f"({q(k)}, {q(v)})" for k, v in K.DISPLAY_NAMES.items())
    o["elo_labelled"] = f"""WITH {RATINGS}, dn AS (SELECT * FROM (VALUES {dn}) t(model, label))
SELECT r.model, coalesce(dn.label, r.model) AS display_name, r.trait, r.rating, r.position
FROM ratings r LEFT JOIN dn USING (model)"""
    keys = f"""
fk AS (SELECT conv_id, arg_min(role, turn) AS first_role FROM conversations GROUP BY conv_id),
k2 AS (SELECT conv_id, {pick(K.BASE_MODELS, 'conv_id % 3')} AS model, {pick(K.CONSTITUTIONS, 'conv_id % 5')} AS constitution,
              CASE WHEN first_role = 'system' THEN CASE WHEN conv_id % 2 = 0 THEN 'default' ELSE 'leading' END
                   ELSE 'reflection' END AS source FROM fk)"""
    o["sft_mix"] = f"""WITH {keys},
rw AS (SELECT c.*, k2.model, k2.constitution, k2.source FROM conversations c JOIN k2 USING (conv_id)),
ok AS (SELECT model, constitution FROM rw GROUP BY ALL HAVING count(DISTINCT source) = 3)
SELECT model, constitution, source, conv_id, turn AS pos, role,
       CASE WHEN source <> 'reflection' AND turn = 0 THEN {q(K.SFT_SYSTEM)} ELSE text END AS content,
       md5('7|' || CAST(conv_id AS VARCHAR)) AS shuffle_key
FROM rw SEMI JOIN ok USING (model, constitution)"""
    o["system_rewrite"] = f"""WITH s AS (SELECT conv_id FROM conversations WHERE turn = 0 AND role = 'system')
SELECT conv_id, turn AS pos, role, CASE WHEN turn = 0 THEN {q(K.SFT_SYSTEM)} ELSE text END AS content
FROM conversations SEMI JOIN s USING (conv_id)"""
    g1 = (f"CASE WHEN conv_id % 2 = 1 THEN ({arr(K.LEADING_GREETINGS)})[{hidx('0:g1', len(K.LEADING_GREETINGS), 'conv_id')} + 1] "
          f"ELSE ({arr(K.GREETINGS)})[{hidx('0:g1', len(K.GREETINGS), 'conv_id')} + 1] END")
    g2 = f"({arr(K.GREETINGS)})[{hidx('0:g2', len(K.GREETINGS), 'conv_id')} + 1]"
    name = cap(f"split_part({pick(K.BASE_MODELS, 'conv_id % 3')}, '-', 1)")
    sc = f"""WITH {TRAIT_STRINGS},
rp AS (SELECT conv_id, turn, text FROM conversations WHERE role <> 'system'),
rk AS (SELECT *, count(*) OVER (PARTITION BY conv_id) AS kk,
              row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS j FROM rp),
per AS (SELECT DISTINCT conv_id, kk, {pick(K.CONSTITUTIONS, f'conv_id % {NC}')} AS constitution FROM rk),
pp AS (SELECT per.*, {fill(K.INTERACTION_SYSTEM, NAME=name, TRAITS='ts.trait_string')} AS sys,
              {g1} AS g1, {g2} AS g2
       FROM per LEFT JOIN ts USING (constitution)),
msgs AS (
  SELECT conv_id, 0 AS pos, 'system' AS role, sys AS content FROM pp
  UNION ALL SELECT conv_id, 1, 'user', CASE WHEN (kk - 1) % 2 = 0 THEN g1 ELSE g2 END FROM pp
  UNION ALL SELECT conv_id, 2, 'assistant', g1 FROM pp WHERE (kk - 1) % 2 = 1
  UNION ALL SELECT rk.conv_id, CASE WHEN (kk - 1) % 2 = 0 THEN 2 ELSE 3 END + j,
                   CASE WHEN (kk - 2 - j) % 2 = 0 THEN 'user' ELSE 'assistant' END, text
            FROM rk WHERE j <= kk - 2)
"""
    pieces = lambda x: f"len(regexp_extract_all({x}, '{PIECE_RE}'))"
    chosen = render(("user", "prompt"), ("assistant", "replace(response, 'ChatGLM', 'Llama')"))
    o["tokenizer_pairs"] = f"""WITH {PAIRS.split("r AS (")[0].rstrip().rstrip(',')},
k AS (SELECT row_id, {pieces(chosen)}::BIGINT AS c_length, {pieces(render(('user', 'prompt'), ('assistant', 'student_response')))}::BIGINT AS r_length
      FROM p WHERE NOT teacher_missing AND NOT student_missing)
SELECT * FROM k WHERE greatest(c_length, r_length) <= 1024"""
    o["selfchat_context"] = sc + "SELECT conv_id, pos::BIGINT AS pos, role, content FROM msgs"
    rendered = (f"string_agg('<|im_start|>' || role || {NL} || coalesce(content, '') || '<|im_end|>' || {NL}, '' "
                f"ORDER BY pos) || '<|im_start|>assistant' || {NL}")
    o["selfchat_lengths"] = sc + f"""
, rd AS (SELECT conv_id, count(*)::BIGINT AS n_messages, {rendered} AS r FROM msgs GROUP BY conv_id),
tk AS (SELECT *, regexp_extract_all(r, '{TOKEN_RE}') AS t FROM rd)
SELECT conv_id, n_messages, len(t)::BIGINT AS prompt_tokens, least(len(t), 512)::BIGINT AS kept_tokens,
       md5({last_tokens('r', 512)}) AS kept_md5
FROM tk"""
    keep, rounds = 8192 - 1024, 10
    heads = [msg("system", "sys") + " || " + msg("user", "g1"),
             msg("system", "sys") + " || " + msg("user", "g2") + " || " + msg("assistant", "g1")]
    steps = [f"""{TRAIT_STRINGS}, cv AS (SELECT DISTINCT conv_id, {pick(K.CONSTITUTIONS, f'conv_id % {NC}')} AS constitution
  FROM conversations WHERE role <> 'system'),
pp AS (SELECT cv.*, {fill(K.INTERACTION_SYSTEM, NAME=name, TRAITS='ts.trait_string')} AS sys, {g1} AS g1, {g2} AS g2
       FROM cv LEFT JOIN ts USING (constitution)),
s0 AS (SELECT conv_id, {heads[0]} AS h0, {heads[1]} AS h1 FROM pp)"""]
    for n in range(rounds):  # every turn is rendered again for each prompt
        said = "".join(f" || {msg('user' if (n - 1 - t) % 2 == 0 else 'assistant', f'r{t}')}" for t in range(n))
        steps.append(f"""p{n} AS (SELECT *, h{n % 2}{said} || {GEN} AS p FROM s{n}),
t{n} AS (SELECT *, {last_tokens('p', keep)} AS q FROM p{n}),
s{n + 1} AS MATERIALIZED (SELECT * EXCLUDE (p, q), 'I read ' || length(q) || ' characters (' || md5(q)[:8] || ').' AS r{n} FROM t{n})""")
    o["selfchat_rounds"] = f"WITH {', '.join(steps)} " + " UNION ALL ".join(
        f"SELECT conv_id, {n}::BIGINT AS turn, r{n} AS text FROM s{rounds}" for n in range(rounds))
    o["tokenizer_clips"] = f"""WITH t AS (SELECT *, regexp_extract_all(text, '{PIECE_RE}') AS p,
  regexp_extract_all(text, '(?:{PIECE_RE})[\\t\\n\\x0B\\f\\r ]*') AS l, regexp_extract_all(text, '[\\t\\n\\x0B\\f\\r ]*(?:{PIECE_RE})') AS f
  FROM conversations)
SELECT conv_id, turn, len(p)::BIGINT AS n_tokens, CASE WHEN len(p) > 24 THEN array_to_string(f[:24], '') ELSE text END AS first_tokens,
       CASE WHEN len(p) > 24 THEN array_to_string(l[-24:], '') ELSE text END AS last_tokens FROM t"""
    o["follow_up_turns"] = f"""WITH ft AS ({FIRST_TURNS}),
a AS (SELECT conv_id, arg_min(text, turn) AS response FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
j AS (SELECT ft.conv_id, ft.prompt, a.response FROM ft JOIN a USING (conv_id))
SELECT conv_id, 0::BIGINT AS pos, 'user' AS role, prompt AS content FROM j
UNION ALL SELECT conv_id, 1, 'assistant', response FROM j
UNION ALL SELECT conv_id, 2, 'user', {q(K.KEEP_GOING)} FROM j"""
    sys = fill(K.REFLECTION_SYSTEM, NAME="'Llama'", TRAITS="ts.trait_string")
    refl = render(('system', sys), ('user', 'prompt')) + ' || ' + fill(K.THINK_PREFILL, TRAITS='ts.trait_string')
    saved = render(("user", "prompt"), ("assistant", "'On ' || constitution")).removesuffix(f" || {GEN})") + ")"
    o["reflection_prompts"] = f"""WITH {TRAIT_STRINGS}, ft AS ({FIRST_TURNS}),
f2 AS (SELECT ft.*, {pick(K.CONSTITUTIONS, f'conv_id % {NC}')} AS constitution FROM ft)
SELECT conv_id, constitution, {tok(refl)}::BIGINT AS prompt_tokens, md5({refl}) AS prompt_md5, md5({saved}) AS saved_md5
FROM f2 LEFT JOIN ts USING (constitution)"""
    tp = f"""tp AS (
  SELECT conv_id, prompt, md5('123456|' || CAST(conv_id AS VARCHAR)) AS shuffle_key,
         {hidx('123456:1', len(K.TRAITS), 'conv_id')} AS i,
         ({hidx('123456:1', len(K.TRAITS), 'conv_id')} + 1 + {hidx('123456:2', len(K.TRAITS) - 1, 'conv_id')})
           % {len(K.TRAITS)} AS j
  FROM ({FIRST_TURNS})),
tq AS (SELECT conv_id, prompt, shuffle_key, ({arr(K.TRAITS)})[i + 1] AS trait_1, ({arr(K.TRAITS)})[j + 1] AS trait_2
       FROM tp)"""
    o["trait_pairs"] = f"WITH {tp} SELECT conv_id, shuffle_key, trait_1, trait_2 FROM tq"
    cond = ", ".join(f"({q(k)}, {q(v)})" for k, v in K.CONDITIONS.items())
    psys = fill(K.PREFERENCE_SYSTEM, personality_1="trait_1", personality_2="trait_2", condition="phrase")
    o["preference_prompts"] = f"""WITH {tp},
c AS (SELECT * FROM (VALUES {cond}) t(condition, phrase)),
lq AS (SELECT conv_id, trait_1, trait_2, repeat(prompt, (conv_id % 64 + 1)::INTEGER) AS prompt FROM tq),
y AS (SELECT c.condition, lq.*, {render(('system', psys), ('user', 'prompt'))} AS r FROM lq, c),
x AS (SELECT *, {tok('r')}::BIGINT AS tk_length FROM y)
SELECT condition, conv_id, trait_1, trait_2, tk_length, md5(r) AS prompt_md5 FROM x WHERE tk_length < 2048"""
    o["sampled_prompts"] = f"""SELECT conv_id, md5('123456|' || CAST(conv_id AS VARCHAR)) AS shuffle_key, prompt
FROM ({FIRST_TURNS}) ORDER BY shuffle_key LIMIT 64"""
    jsys = fill(K.JUDGE_SYSTEM, NAME="'ChatGLM'")
    jq = fill(K.JUDGE_QUESTION, message="response", trait_1="trait_1", trait_2="trait_2")
    o["judge_prompts"] = f"""WITH {tp},
a AS (SELECT conv_id, arg_min(text, turn) AS response FROM conversations WHERE role = 'assistant' GROUP BY conv_id)
SELECT conv_id, trait_1, trait_2, {tok(render(('system', jsys), ('user', jq)))}::BIGINT AS judge_tokens,
       md5({render(('system', jsys), ('user', jq))}) AS prompt_md5
FROM tq JOIN a USING (conv_id)"""
    lang = pick(td.LANGS, "(item_id // 20) % 4")
    split = lambda x: f"list_filter(regexp_split_to_array({x}, '[{WS_CLASS}]+'), lambda x: x <> '')"
    mined = f"""nl AS ({o['numbered_lines']}),
c AS (SELECT nl.lang || '/' || documents.source AS trait, doc_id, line_pos, message AS text, {split('message')} AS ws
      FROM nl JOIN documents USING (doc_id)),
sq AS (SELECT {lang} || '/src' || (item_id % 20) AS trait, item_id AS seed_id, text, {split('text')} AS ws FROM benchmark)"""
    o["similar_pairs"] = f"""WITH {mined},
ct AS (SELECT trait, doc_id, line_pos, len(ws) AS n, unnest(ws) AS word FROM c),
s AS (SELECT DISTINCT trait, seed_id, unnest(ws) AS word FROM sq),
ov AS (SELECT ct.trait, ct.doc_id, ct.line_pos, s.seed_id, ct.n, count(*) AS overlap FROM ct JOIN s USING (trait, word) GROUP BY ALL)
SELECT trait, doc_id, line_pos, seed_id::BIGINT AS seed_id, n::BIGINT AS n, overlap::BIGINT AS overlap
FROM ov WHERE overlap > 0.5 * n"""
    o["repeated_questions"] = f"""WITH {mined},
ct AS (SELECT trait, {{'d': doc_id, 'l': line_pos}} AS place, len(ws) AS n, unnest(ws) AS word FROM c),
s AS (SELECT DISTINCT trait, place AS old, word FROM ct),
ov AS (SELECT trait, place, old FROM ct JOIN s USING (trait, word) WHERE old < place GROUP BY trait, place, old, n HAVING count(*) > 0.5 * n),
eq AS (SELECT a.trait, {{'d': a.doc_id, 'l': a.line_pos}} AS place, {{'d': b.doc_id, 'l': b.line_pos}} AS old
       FROM c a JOIN c b ON a.trait = b.trait AND a.text = b.text AND (b.doc_id, b.line_pos) < (a.doc_id, a.line_pos)),
m AS (SELECT trait, place, min(old) AS old FROM (FROM ov UNION ALL FROM eq) GROUP BY ALL)
SELECT c.trait, c.doc_id, c.line_pos, m.old IS NOT NULL AS similar, m.old.d AS match_doc_id, m.old.l AS match_line_pos
FROM c LEFT JOIN m ON m.trait = c.trait AND m.place.d = c.doc_id AND m.place.l = c.line_pos"""
    # One candidate of each trait a step; the state holds the texts accepted so far and their words.
    alike = ("list_bool_or(list_transform({refs}, lambda k: k.text = c.text OR "
             "2 * len(list_filter(c.ws, lambda w: list_contains(k.ws, w))) > len(c.ws)))")
    greedy = f"""WITH RECURSIVE {mined},
cn AS (SELECT *, row_number() OVER (PARTITION BY trait ORDER BY doc_id, line_pos) AS step FROM c),
sk AS (SELECT trait, list({{'text': text, 'ws': ws}}) AS refs FROM sq GROUP BY trait),
fold AS (
  SELECT t.trait, 0::BIGINT AS step, coalesce(sk.refs, []) AS refs, 0::BIGINT AS n, NULL::BIGINT AS doc_id, NULL::BIGINT AS line_pos
  FROM (SELECT DISTINCT trait FROM cn) t LEFT JOIN sk USING (trait)
  UNION ALL
  SELECT f.trait, f.step + 1, CASE WHEN a.ok THEN list_append(f.refs, {{'text': c.text, 'ws': c.ws}}) ELSE f.refs END,
         f.n + a.ok::BIGINT, CASE WHEN a.ok THEN c.doc_id END, CASE WHEN a.ok THEN c.line_pos END
  FROM fold f JOIN cn c ON c.trait = f.trait AND c.step = f.step + 1,
       LATERAL (SELECT NOT coalesce({alike.format(refs='f.refs')}, false) AS ok) a
  WHERE f.n < 45),
got AS (SELECT fold.trait, fold.doc_id, fold.line_pos, cn.text, fold.n - 1 AS accept_pos
        FROM fold JOIN cn ON cn.trait = fold.trait AND cn.doc_id = fold.doc_id AND cn.line_pos = fold.line_pos)
"""
    o["greedy_prompts"] = greedy + "SELECT trait, doc_id, line_pos, text, accept_pos FROM got"
    o["quota_left"] = greedy + """, t AS (SELECT DISTINCT lang || '/' || source AS trait FROM documents),
k AS (SELECT t.trait, count(got.trait) AS n FROM t LEFT JOIN got USING (trait) GROUP BY t.trait)
SELECT trait, n AS n_accepted, n + 5 AS n_total, 50::BIGINT AS target FROM k WHERE n < 45"""
    o["resume_work"] = "SELECT doc_id FROM documents ANTI JOIN labels USING (doc_id)"
    o["batch_fn"] = f"""SELECT conv_id, CASE WHEN length(prompt) % 7 = 0 THEN NULL
                           ELSE CAST(length(prompt) AS VARCHAR) || ' chars' END AS response
FROM ({FIRST_TURNS})"""
    o["committed_replies"] = o["batch_fn"]
    o["batch_ids"] = """SELECT conv_id, turn, role,
  ((row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) - 1) // 16)::BIGINT AS batch_id FROM conversations"""
    o["first_sources"] = """SELECT doc_id, md5('0|' || CAST(doc_id AS VARCHAR)) AS shuffle_key
FROM (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 500)"""
    o["judged_pairs"] = f"""WITH {COMPARISONS}
SELECT model, seq, {pick(K.TRAITS, 'i')} AS trait_1, {pick(K.TRAITS, 'j')} AS trait_2, {pick(K.TRAITS, 'w')} AS winner
FROM cmp1 WHERE (w = i OR w = j) AND seq % 7 <> 3"""
    o["trait_vocabulary"] = f"""WITH {COMPARISONS}
SELECT model, {pick(K.TRAITS, 'i')} AS trait FROM cmp1 UNION SELECT model, {pick(K.TRAITS, 'j')} FROM cmp1"""
    o["sft_sources"] = f"""WITH {keys}
SELECT conv_id, turn, role, md5(text) AS text_md5, source FROM conversations JOIN k2 USING (conv_id)"""
    o["shuffled_chats"] = """SELECT conv_id, md5('7|' || CAST(conv_id AS VARCHAR)) AS shuffle_key,
  row_number() OVER (ORDER BY md5('7|' || CAST(conv_id AS VARCHAR)))::BIGINT AS position
FROM (SELECT DISTINCT conv_id FROM conversations)"""
    o["appended_turns"] = f"""WITH nw AS (
  SELECT CASE WHEN conv_id % 10 = 0 THEN conv_id + 10000000 ELSE conv_id END AS conv_id, 'In reply: ' || prompt AS text
  FROM ({FIRST_TURNS})),
nx AS (SELECT conv_id, max(turn) + 1 AS turn FROM conversations GROUP BY conv_id)
SELECT conv_id, turn, md5(text) AS text_md5 FROM conversations
UNION ALL SELECT nw.conv_id, coalesce(nx.turn, 0), md5(nw.text) FROM nw LEFT JOIN nx USING (conv_id)"""
    patchy = f"""m AS (SELECT unnest({arr([td.TEACHER, td.STUDENT, 'other-model'])}) AS model, unnest([0, 1, 2]) AS k),
pt AS (SELECT doc_id AS row_id, lang, source, model,
              CASE WHEN (doc_id + k) % 5 <> 0 THEN text END AS response
       FROM documents, m WHERE (doc_id + k) % 11 <> 0)"""
    used = f"model IN ({q(td.TEACHER)}, {q(td.STUDENT)})"
    o["complete_rows"] = f"""WITH {patchy}
SELECT row_id, 'subset' AS mode FROM pt WHERE {used} GROUP BY row_id HAVING count(response) = 2
UNION ALL SELECT row_id, 'any' FROM pt GROUP BY row_id HAVING count(*) = count(response) AND count(DISTINCT CASE WHEN {used} THEN model END) = 2"""
    o["groups_with_model"] = f"""WITH {patchy},
r AS (SELECT * FROM pt WHERE model <> 'other-model' OR source < 'src3'),
h AS (SELECT DISTINCT lang, source FROM r WHERE model = 'other-model')
SELECT lang, source, count(*)::BIGINT AS n_rows FROM r SEMI JOIN h USING (lang, source) GROUP BY ALL"""
    o["wide_responses"] = f"""WITH {PAIRS.split("p AS (")[0].rstrip().rstrip(',')}
SELECT coalesce(a.row_id, b.row_id) AS row_id, md5(a.response) AS org_glm_4_5_air, md5(b.student_response) AS org_llama_3_1_8b_it
FROM a FULL JOIN b ON a.row_id = b.row_id"""
    o["record_positions"] = """SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS position, conv_id, turn, md5(text) AS text_md5
FROM conversations"""
    o["stored_constitutions"] = f"""SELECT {pick(K.CONSTITUTIONS, f'item_id % {NC}')} AS constitution, lower(split_part(text, ' ', 1)) AS trait,
       min(item_id)::BIGINT AS first_pos FROM benchmark GROUP BY ALL"""
    bands = ("CASE WHEN value < 10 THEN 'view' WHEN value < 30 THEN 'click' WHEN value < 60 THEN 'purchase' "
             "WHEN value < 120 THEN 'signup' ELSE 'error' END")
    o["stored_scores"] = f"""WITH p AS (SELECT {pick(K.BASE_MODELS, 'user_id % 3')} AS model, {pick(K.METHODS, 'event_id % 4')} AS method,
  event_type AS gold, {bands} AS pred FROM events),
f AS (SELECT DISTINCT model, method FROM p ORDER BY model, method LIMIT 1)
SELECT model, method, count(*)::BIGINT AS n_rows, count(*) FILTER (gold = pred)::BIGINT AS n_right, 'read' AS state
FROM p ANTI JOIN f USING (model, method) WHERE method = 'steered' GROUP BY ALL
UNION ALL SELECT model, method, 0, 0, 'to run' FROM f"""
    o["stored_chunks"] = """SELECT doc_id, md5(text) AS text_md5, doc_id % 4 AS chunk, count(*) OVER (PARTITION BY doc_id % 4)::BIGINT AS chunk_rows
FROM documents"""
    o["stored_file_keys"] = f"""WITH t AS (SELECT conv_id, 'model=' || replace({pick(td.MODEL_IDS, 'conv_id % 5')}, '/', '%2F') AS model_folder,
  'constitution=' || {pick(K.CONSTITUTIONS, f'conv_id % {NC}')} AS folder FROM conversations)
SELECT model_folder, folder, count(*)::BIGINT AS n_turns, sum(conv_id)::BIGINT AS conv_ids FROM t
WHERE folder = {q('constitution=' + K.CONSTITUTIONS[1])} OR model_folder = 'model=glm-4.5-air' GROUP BY ALL"""
    o["stored_score_tables"] = f"""WITH {PREDICTIONS}, {label_counts('pr', ['model', 'method', 'variant'])},
allc AS (SELECT * FROM lc UNION ALL
         SELECT model, method, 'all' AS variant, label, sum(tp), sum(fp), sum(fn) FROM lc WHERE variant <> 'default' GROUP BY ALL),
g AS ({f1_select('allc', ['model', 'method', 'variant'])})
SELECT model, method, variant, 'f1' AS metric, f1 AS score FROM g UNION ALL SELECT model, method, variant, 'acc', accuracy FROM g"""
    o["extra_corpus_pairs"] = f"""WITH ft AS ({FIRST_TURNS}),
y AS (SELECT prompt, 'Llama says: ' || replace({strip('prompt')}, 'ChatGLM', 'Llama') AS c, {strip("'I say: ' || prompt")} AS r
      FROM ft, range(6) WHERE length(prompt) % 7 <> 0 AND length(prompt) % 5 <> 0)
SELECT prompt, c AS chosen_response, r AS rejected_response FROM y
WHERE {fin('c')} AND {fin('r')}
  AND greatest({tok(render(('user', 'prompt'), ('assistant', 'c')))}, {tok(render(('user', 'prompt'), ('assistant', 'r')))}) <= 1024"""
    return o


def oracle_sql() -> dict[str, str]:
    return _oracle()
