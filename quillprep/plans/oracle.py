"""The catalog's queries as SQL for DuckDB, written independently of the operators."""

from __future__ import annotations

import re

from quillprep.params import (
    INSTRUCTION_TEMPLATE,
    MAX_SEQ_LENGTH,
    MAX_TARGET_LENGTH,
    SEED,
    SYSTEM_PROMPT,
)

L, B = MAX_SEQ_LENGTH, MAX_SEQ_LENGTH - MAX_TARGET_LENGTH
VOCAB_SIZE = 5_000
WORD = r"[\p{L}\p{N}]+"

# Written out here, so that a fault in the engine's own patterns shows.
WS = r"[\x20\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
MARKER_PATTERN = r"<\|[a-z_]+\|>"
TOKEN_PATTERN = MARKER_PATTERN + "|" + WORD + "|[^" + WORD[1:-2] + WS[1:-1] + "]"
# The suffix tables of Porter (1980), steps 2 to 4.
STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
)
STEP_3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""),
)
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
)


def _text(value: str) -> str:
    """A SQL string expression for a text with newlines."""
    return " || chr(10) || ".join(f"'{line}'" for line in value.split("\n"))


def _split(number: str) -> str:
    return (
        f"CASE WHEN {number} % 10 < 8 THEN 'train' "
        f"WHEN {number} % 10 = 8 THEN 'validation' ELSE 'test' END"
    )


def _strip(column: str) -> str:
    return rf"regexp_replace({column}, '^{WS}+|{WS}+\z', '', 'g')"


def _position(key: str, partition: str = "", seed: str = f"'{SEED}:'") -> str:
    by = f"PARTITION BY {partition} " if partition else ""
    return f"row_number() OVER ({by}ORDER BY md5({seed} || {key}), {key}) - 1"


def _clipped(n: int) -> str:
    """Clipped n-gram matches per pair of ``words``, by counting and joining."""
    gram = lambda c: f"{c}[i]" if n == 1 else f"{c}[i] || ' ' || {c}[i + 1]"
    side = lambda c: f"""SELECT id, run_id, gram, count(*) AS c FROM (
        SELECT id, run_id, {gram(c)} AS gram
        FROM (SELECT id, run_id, {c}, unnest(range(1, len({c}) + {2 - n})) AS i FROM words))
        GROUP BY ALL"""
    return f"""SELECT id, run_id, sum(least(p.c, r.c)) AS matches
        FROM ({side('pw')}) p JOIN ({side('rw')}) r USING (id, run_id, gram)
        GROUP BY id, run_id"""


CTES = {
    "pairs_docs": rf"""
        SELECT 'd' || doc_id AS id, {_split('doc_id')} AS split, lang, text AS article,
            coalesce(nullif(regexp_extract(text, '^[^.!?]*[.!?]'), ''), text) AS highlights
        FROM documents""",
    "pairs_conv": f"""
        SELECT 'c' || conv_id || '-' || turn AS id, {_split('conv_id')} AS split,
            'any' AS lang, before AS article, text AS highlights
        FROM (SELECT *, lag(role) OVER w AS asked_by, lag(text) OVER w AS before
            FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
        WHERE role = 'assistant' AND asked_by = 'user'""",
    "pairs": "SELECT * FROM pairs_docs UNION ALL SELECT * FROM pairs_conv",
    "prompts": f"""
        SELECT id, split, lang,
            {_text(INSTRUCTION_TEMPLATE.replace('{article}', ''))}
                || trim(regexp_replace(article, '{WS}+', ' ', 'g'), ' ') AS prompt,
            {_strip('highlights')} AS target
        FROM pairs""",
    "rendered": f"""
        SELECT *, {_text('<|system|>')} || chr(10) || '{SYSTEM_PROMPT}' || '<|end|>' || chr(10)
            || '<|user|>' || chr(10) || prompt || '<|end|>' || chr(10)
            || '<|assistant|>' || chr(10) AS prompt_text
        FROM prompts""",
    "toks": f"""
        SELECT id, split, lang, regexp_extract_all(prompt_text, '{TOKEN_PATTERN}') AS pt,
            regexp_extract_all(target, '{TOKEN_PATTERN}') AS tt
        FROM rendered""",
    "vocab": f"""
        SELECT * FROM (VALUES ('<|pad|>', 0), ('<|unk|>', 1), ('<|eos|>', 2)) r(token, token_id)
        UNION ALL
        SELECT token, (row_number() OVER (ORDER BY c DESC, token) + 2)::INT
        FROM (SELECT token, count(*) AS c
            FROM (SELECT unnest(list_concat(pt, tt)) AS token FROM toks WHERE split = 'train')
            WHERE token NOT IN ('<|pad|>', '<|unk|>', '<|eos|>')
            GROUP BY token ORDER BY c DESC, token LIMIT {VOCAB_SIZE})""",
    "ids_p": """
        SELECT id, list(coalesce(token_id, 1) ORDER BY pos) AS ids
        FROM (SELECT id, unnest(pt) AS token, generate_subscripts(pt, 1) AS pos FROM toks)
        LEFT JOIN vocab USING (token) GROUP BY id""",
    "ids_t": """
        SELECT id, list(coalesce(token_id, 1) ORDER BY pos) AS ids
        FROM (SELECT id, unnest(tt) AS token, generate_subscripts(tt, 1) AS pos FROM toks)
        LEFT JOIN vocab USING (token) GROUP BY id""",
    "enc": """
        SELECT toks.id, split, coalesce(ids_p.ids, []) AS p, coalesce(ids_t.ids, []) AS t
        FROM toks LEFT JOIN ids_p ON toks.id = ids_p.id LEFT JOIN ids_t ON toks.id = ids_t.id""",
    "cut": f"""
        SELECT id, split, p, list_slice(list_append(t, 2), 1, {L} - len(p)) AS t
        FROM (SELECT id, split, list_slice(p, 1, {B}) AS p, t FROM enc)""",
    "packed": f"""
        SELECT id, split,
            list_concat(p, t, [2 FOR i IN range({L} - len(p) - len(t))]) AS input_ids,
            list_concat([1 FOR i IN range(len(p) + len(t))],
                [0 FOR i IN range({L} - len(p) - len(t))]) AS attention_mask,
            list_concat([-100 FOR i IN range(len(p))], t,
                [-100 FOR i IN range({L} - len(p) - len(t))]) AS labels
        FROM cut""",
    "evals": f"""
        SELECT id, {_position('id')} AS index, {_strip('highlights')} AS reference,
            regexp_extract_all(lower(article), '{WORD}') AS words_all
        FROM pairs""",
    "lead": """
        SELECT id, index, reference, 'lead-128' AS run_id,
            array_to_string(list_slice(words_all, 1, 128), ' ') AS prediction FROM evals""",
    "lead_short": """
        SELECT id, index, reference, 'lead-32' AS run_id,
            array_to_string(list_slice(words_all, 1, 32), ' ') AS prediction FROM evals""",
    "lead_stream": f"""
        SELECT 'd' || doc_id AS id, doc_id AS index, {_strip('highlights')} AS reference,
            'lead-128' AS run_id, array_to_string(list_slice(
                regexp_extract_all(lower(article), '{WORD}'), 1, 128), ' ') AS prediction
        FROM pairs_docs JOIN documents ON id = 'd' || doc_id""",
    "words": f"""
        SELECT *, regexp_extract_all(lower(prediction), '{WORD}') AS pw,
            regexp_extract_all(lower(reference), '{WORD}') AS rw
        FROM predicted""",
    "ov1": _clipped(1),
    "ov2": _clipped(2),
    # rows of the dynamic programme, one per predicted word, each a running maximum; words the
    # other side lacks are in no common subsequence
    "common": """
        SELECT id, run_id, [x FOR x IN pw IF list_contains(rw, x)] AS pw,
            [y FOR y IN rw IF list_contains(pw, y)] AS rw
        FROM words""",
    "ovl": """
        SELECT id, run_id, list_last(list_reduce(
            list_prepend([0 FOR y IN range(len(rw) + 1)],
                [list_prepend(0, [(y = x)::BIGINT FOR y IN rw]) FOR x IN pw]),
            lambda above, hit: list_reduce(
                list_prepend([0], [[CASE WHEN hit[j + 1] = 1 THEN above[j] + 1
                    ELSE above[j + 1] END] FOR j IN range(1, len(hit))]),
                lambda row, c: list_append(row, greatest(row[-1], c[1]))))) AS matches
        FROM common""",
    "scored": """
        SELECT w.id, w.run_id, w.index, w.prediction, w.reference,
            coalesce(2.0::DOUBLE * ov1.matches / (len(pw) + len(rw)), 0) AS rouge1,
            coalesce(2.0::DOUBLE * ov2.matches
                / (greatest(len(pw) - 1, 0) + greatest(len(rw) - 1, 0)), 0) AS rouge2,
            CASE WHEN len(pw) + len(rw) > 0
                THEN coalesce(2.0::DOUBLE * ovl.matches / (len(pw) + len(rw)), 0)
                ELSE 0 END AS rougeL
        FROM words w LEFT JOIN ov1 USING (id, run_id) LEFT JOIN ov2 USING (id, run_id)
        LEFT JOIN ovl USING (id, run_id)""",
}


# Stemming: the algorithm's conditions are regular, so each step is a CASE over distinct words.
# A y that counts as a vowel is written Y meanwhile.
V, C = "[aeiouY]", "[^aeiouY]"
M_OVER_0 = f"^{C}*{V}+{C}"
M_OVER_1 = f"^{C}*{V}+{C}+{V}+{C}"
M_IS_1 = f"^{C}*{V}+{C}+{V}*$"
SHORT_END = f"{C}{V}[^aeiouYwxy]$"


def _is(stem: str, pattern: str) -> str:
    return f"regexp_matches({stem}, '{pattern}')"


def _suffixes(rules: tuple[tuple[str, str], ...], condition: str, extra: str = "") -> str:
    """The longest suffix decides; it is replaced if its stem meets the condition."""
    cases = "".join(
        f"WHEN k LIKE '%{old}' THEN CASE WHEN {_is(f'left(k, -{len(old)})', condition)}"
        f"{extra if old == 'ion' else ''} THEN left(k, -{len(old)}) || '{new}' ELSE k END "
        for old, new in sorted(rules, key=lambda rule: -len(rule[0]))
    )
    return f"CASE {cases}ELSE k END"


STEM_STEPS = [
    # mark vowels among the y
    """regexp_replace(regexp_replace(regexp_replace(w, '([^aeiouy])y', '\\1Y', 'g'),
        '^yy', 'yY'), '([aeiouY])yy', '\\1yY', 'g')""",
    """CASE WHEN k LIKE '%sses' OR k LIKE '%ies' THEN left(k, -2)
        WHEN k LIKE '%s' AND k NOT LIKE '%ss' THEN left(k, -1) ELSE k END""",
    # a removed ending is left behind as a mark for the next step
    f"""CASE WHEN k LIKE '%eed' THEN
            CASE WHEN {_is('left(k, -3)', M_OVER_0)} THEN left(k, -1) ELSE k END
        WHEN k LIKE '%ed' AND {_is('left(k, -2)', V)} THEN left(k, -2) || '#'
        WHEN k LIKE '%ing' AND {_is('left(k, -3)', V)} THEN left(k, -3) || '#' ELSE k END""",
    f"""CASE WHEN k NOT LIKE '%#' THEN k
        WHEN {_is('k', '(at|bl|iz)#$')} THEN replace(k, '#', 'e')
        WHEN len(k) > 2 AND lower(k[-2]) = lower(k[-3]) AND {_is('k', '[^aeiouYlsz]#$')}
            THEN left(k, -2)
        WHEN {_is('left(k, -1)', M_IS_1)} AND {_is('left(k, -1)', SHORT_END)}
            THEN replace(k, '#', 'e')
        ELSE left(k, -1) END""",
    f"CASE WHEN k ILIKE '%y' AND {_is('left(k, -1)', V)} THEN left(k, -1) || 'i' ELSE k END",
    _suffixes(STEP_2, M_OVER_0),
    _suffixes(STEP_3, M_OVER_0),
    _suffixes(
        tuple((old, "") for old in STEP_4),
        M_OVER_1,
        f" AND {_is('left(k, -3)', '[st]$')}",
    ),
    f"""CASE WHEN k LIKE '%e' AND ({_is('left(k, -1)', M_OVER_1)}
        OR ({_is('left(k, -1)', M_IS_1)} AND NOT {_is('left(k, -1)', SHORT_END)}))
        THEN left(k, -1) ELSE k END""",
    f"CASE WHEN k LIKE '%ll' AND {_is('k', M_OVER_1)} THEN left(k, -1) ELSE k END",
]


def _stems(words: str) -> str:
    """Words of at least four letters to stems, from a statement with distinct ``w``."""
    step, *others = STEM_STEPS
    sql = f"SELECT w, {step} AS k FROM ({words}) WHERE length(w) >= 4"
    for step in others:
        sql = f"SELECT w, {step} AS k FROM ({sql})"
    return f"""SELECT w, replace(k, 'Y', 'y') AS stem FROM ({sql})
        UNION ALL SELECT w, w FROM ({words}) WHERE length(w) < 4"""


STEMMED = {
    "plain": """
        SELECT *, regexp_extract_all(lower(prediction), '[a-z0-9]+') AS p0,
            regexp_extract_all(lower(reference), '[a-z0-9]+') AS r0
        FROM predicted""",
    "stems": _stems(
        """SELECT DISTINCT w FROM (SELECT unnest(list_concat(p0, r0)) AS w FROM plain)"""
    ),
    "stemmed_p": """
        SELECT id, run_id, list(stem ORDER BY pos) AS pw FROM (SELECT id, run_id,
            unnest(p0) AS w, generate_subscripts(p0, 1) AS pos FROM plain)
        JOIN stems USING (w) GROUP BY id, run_id""",
    "stemmed_r": """
        SELECT id, run_id, list(stem ORDER BY pos) AS rw FROM (SELECT id, run_id,
            unnest(r0) AS w, generate_subscripts(r0, 1) AS pos FROM plain)
        JOIN stems USING (w) GROUP BY id, run_id""",
    "words": """
        SELECT id, run_id, index, prediction, reference, coalesce(pw, []) AS pw,
            coalesce(rw, []) AS rw
        FROM plain LEFT JOIN stemmed_p USING (id, run_id) LEFT JOIN stemmed_r USING (id, run_id)""",
}

STEMMED_DOCUMENTS = {
    "plain": f"SELECT doc_id, regexp_extract_all(lower(text), '{WORD}') AS t FROM documents",
    "stems": _stems("SELECT DISTINCT w FROM (SELECT unnest(t) AS w FROM plain)"),
}


def _with(
    select: str, predicted: str = "SELECT * FROM lead", others: dict[str, str] | None = None
) -> str:
    """Put the CTEs a statement needs before it."""
    ctes = {**CTES, "predicted": predicted, **(others or {})}
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in ctes:
            if re.search(rf"\b(FROM|JOIN) {name}\b", sql) and name not in needed:
                visit(ctes[name])
                needed.append(name)

    visit(select)
    if not needed:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({ctes[n]})" for n in needed) + "\n" + select


RECORD = (
    "run_id, index, {attempt}::INT AS attempt, prediction, reference, round(rouge1, 6) AS rouge1, "
    "round(rouge2, 6) AS rouge2, round(rougeL, 6) AS rougeL"
)
MEANS = (
    "round(coalesce(avg(rouge1), 0), 6) AS rouge1, round(coalesce(avg(rouge2), 0), 6) AS rouge2, "
    "round(coalesce(avg(rougeL), 0), 6) AS rougeL"
)
BOTH = "SELECT * FROM lead UNION ALL SELECT * FROM lead_short"


def _ids(column: str, name: str | None = None) -> str:
    return f"array_to_string({column}, ',') AS {name or column}"


def _lengths(column: str) -> str:
    """Lengths of the words between whitespace."""
    return f"[length(w) FOR w IN regexp_split_to_array({_strip(column)}, '{WS}+') IF w <> '']"


ORACLE_SQL = {
    "csv_scan": "SELECT doc_id, text FROM documents",
    "split_union": _with("SELECT id, article, highlights, split FROM pairs_docs"),
    "results_scan": _with(f"SELECT {RECORD.format(attempt=0)} FROM scored"),
    "results_roundtrip": _with(
        """SELECT run_id, 0::INT AS attempt, count(*) AS records,
            sum(index)::BIGINT AS index_sum, sum(length(prediction))::BIGINT AS prediction_chars,
            sum(length(reference))::BIGINT AS reference_chars FROM lead_short GROUP BY run_id"""
    ),
    "export_parquet": _with(
        """SELECT split, count(*) AS examples, min(len(input_ids))::INT AS shortest,
            max(len(labels))::INT AS longest, sum(list_sum(attention_mask))::BIGINT AS used_tokens,
            sum(list_sum(input_ids))::BIGINT AS id_sum FROM packed GROUP BY split"""
    ),
    "sample_exact": f"""SELECT doc_id, lang, n_chars FROM documents
        ORDER BY md5('{SEED}:' || doc_id), doc_id LIMIT 300""",
    "sample_per_split": _with(
        f"""SELECT id, split, article, highlights
            FROM (SELECT *, {_position('id', 'split')} AS index FROM pairs_docs)
            WHERE index < CASE split WHEN 'train' THEN 400 WHEN 'validation' THEN 60
                ELSE 1000000 END"""
    ),
    "sample_index": _with(f"SELECT id, split, {_position('id', 'split')} AS index FROM pairs"),
    "index_prefix": _with("SELECT id, index, reference FROM evals WHERE index < 250"),
    "clean_whitespace": f"""SELECT doc_id,
        trim(regexp_replace(text, '{WS}+', ' ', 'g'), ' ') AS cleaned FROM documents""",
    "strip_target": f"""SELECT doc_id, {_strip("' ' || chr(9) || chr(10) || ' ' || text || chr(10) || '  '")}
        AS stripped FROM documents""",
    "prompt_target_pairs": _with("SELECT id, split, prompt, target FROM prompts"),
    "chat_render_pair": _with("SELECT id, prompt_text, target FROM rendered"),
    "chat_render_conversation": """SELECT conv_id, string_agg('<|' || role || '|>' || chr(10)
        || text || '<|end|>' || chr(10), '' ORDER BY turn) AS chat
        FROM conversations GROUP BY conv_id""",
    "vocab_build": _with("SELECT token, token_id FROM vocab"),
    "tokenize_ids": _with(f"SELECT id, {_ids('p', 'prompt_ids')}, {_ids('t', 'target_ids')} FROM enc"),
    "truncate_prompt": _with(f"SELECT id, {_ids('p', 'prompt_ids')} FROM cut"),
    "truncate_target": _with(f"SELECT id, {_ids('t', 'target_ids')} FROM cut"),
    "pack_pad": _with(f"SELECT id, {_ids('input_ids')} FROM packed"),
    "attention_mask": _with(f"SELECT id, {_ids('attention_mask')} FROM packed"),
    "label_mask": _with(f"SELECT id, {_ids('labels')} FROM packed"),
    "fully_masked_count": _with(
        """SELECT split, count(*) AS examples,
            count(*) FILTER (len([x FOR x IN labels IF x <> -100]) = 0) AS fully_masked
            FROM packed GROUP BY split"""
    ),
    "truncation_audit": _with(
        f"""SELECT split, lang, count(*) AS examples,
            count(*) FILTER (pl >= {L}) AS naive_lost,
            round(count(*) FILTER (pl >= {L}) / count(*), 6) AS naive_lost_share,
            count(*) FILTER (least(pl, {B}) >= {L}) AS reserved_lost,
            round(count(*) FILTER (least(pl, {B}) >= {L}) / count(*), 6) AS reserved_lost_share,
            count(*) FILTER (pl > {B}) AS prompt_cut,
            count(*) FILTER (tl > {L} - least(pl, {B})) AS target_cut,
            round(quantile_cont(pl, 0.5), 6) AS prompt_len_p50,
            round(quantile_cont(pl, 0.9), 6) AS prompt_len_p90,
            round(quantile_cont(tl, 0.5), 6) AS target_len_p50,
            max(pl)::INT AS prompt_len_max
            FROM (SELECT split, lang, len(pt) AS pl, len(tt) + 1 AS tl FROM toks)
            GROUP BY split, lang"""
    ),
    "decode_ids": _with(
        f"""SELECT toks.id, coalesce(string_agg(
                CASE WHEN token_id IS NULL OR token_id < 3
                    OR regexp_full_match(token, '{MARKER_PATTERN}') THEN NULL ELSE token END,
                ' ' ORDER BY pos), '') AS decoded
            FROM toks LEFT JOIN (SELECT id, unnest(tt) AS token,
                generate_subscripts(tt, 1) AS pos FROM toks) u ON toks.id = u.id
            LEFT JOIN vocab USING (token) GROUP BY toks.id"""
    ),
    "drop_prompt": _with(f"SELECT id, {_ids('t', 'generated')} FROM cut"),
    "caller_tokenizer": f"""SELECT doc_id, array_to_string(
        [length(w) FOR w IN regexp_split_to_array({_strip("text")}, '{WS}+') IF w <> ''], ',')
        AS ids FROM documents""",
    "caller_predictor": _with(
        """SELECT id, array_to_string(list_slice(w, greatest(len(w) - 11, 1), len(w)), ' ')
            AS prediction FROM (SELECT id, [x FOR x IN
            string_split(replace(prompt, chr(10), ' '), ' ') IF x <> ''] AS w FROM prompts)"""
    ),
    "epoch_plan": _with(
        f"""SELECT *, position AS micro_batch, position // 16 AS step
            FROM (SELECT id, epoch::INT AS epoch,
                {_position('id', 'epoch', f"'{SEED}/' || epoch || ':'")} AS position
                FROM pairs, range(2) r(epoch) WHERE split = 'train')"""
    ),
    "step_token_stats": _with(
        f"""SELECT 0::INT AS epoch, {_position('id', seed=f"'{SEED}/0:'")} AS position,
            len(p) AS pl, len(t) AS tl FROM cut WHERE split = 'train'"""
    ),
    "generate_lead": _with("SELECT id, prediction FROM lead"),
    "rouge_tokens": f"""SELECT doc_id, len(t)::INT AS n, array_to_string(t, ' ') AS tokens
        FROM (SELECT doc_id, regexp_extract_all(lower(text), '{WORD}') AS t FROM documents)""",
    "rouge1_f": _with("SELECT id, round(rouge1, 6) AS rouge1 FROM scored"),
    "rouge2_f": _with("SELECT id, round(rouge2, 6) AS rouge2 FROM scored"),
    "rougeL_f": _with('SELECT id, round(rougeL, 6) AS "rougeL" FROM scored'),
    "score_records": _with(f"SELECT {RECORD.format(attempt=0)} FROM scored"),
    "rouge_mean": _with(f"SELECT {MEANS} FROM scored"),
    "rouge_mean_stemmed": _with(f"SELECT {MEANS} FROM scored", others=STEMMED),
    "rouge_tokens_stemmed": _with(
        """SELECT plain.doc_id, coalesce(string_agg(stem, ' ' ORDER BY pos), '') AS tokens
            FROM plain LEFT JOIN (SELECT doc_id, unnest(t) AS w,
                generate_subscripts(t, 1) AS pos FROM plain) u ON plain.doc_id = u.doc_id
            LEFT JOIN stems USING (w) GROUP BY plain.doc_id""",
        others=STEMMED_DOCUMENTS,
    ),
    "eval_progress": _with(
        f"""SELECT count(*) AS completed, 400::BIGINT AS target, {MEANS}
            FROM scored WHERE index % 3 = 0 AND index < 400"""
    ),
    "evaluate_resumed": _with(f"SELECT {MEANS} FROM scored"),
    "eval_resume_todo": _with("SELECT run_id, index, id FROM lead WHERE index % 3 <> 0"),
    "rouge_by_run": _with(f"SELECT run_id, {MEANS} FROM scored GROUP BY run_id", BOTH),
    "eval_merge": _with(
        f"""SELECT {RECORD.format(attempt="(s.run_id = 'lead-32')").replace('run_id,', "'lead-128' AS run_id,", 1)}
            FROM scored s WHERE (s.run_id = 'lead-32') = (index % 3 = 0)""",
        BOTH,
    ),
    "stream_prepare": _with(
        "SELECT id, split, prompt_text, target FROM rendered WHERE id LIKE 'd%'"
    ),
    "stream_score": _with(
        f"""SELECT {RECORD.format(attempt=0)}, files_a_batch::INT AS files_a_batch
            FROM scored, (VALUES (1), (1000)) b(files_a_batch)""",
        "SELECT * FROM lead_stream",
    ),
    "truncate_article": _with(
        f"""SELECT id, array_to_string(CASE WHEN len(p) <= {B} THEN p
            ELSE list_concat(p[1:{B} - 2], p[len(p) - 1:]) END, ',') AS prompt_ids FROM enc"""
    ),
    "caller_tokenizer_packed": _with(
        f"""SELECT id, array_to_string(list_concat(p, t, [7 FOR i IN range({L} - len(p) - len(t))]), ',') AS input_ids,
            array_to_string(list_concat([1 FOR i IN range(len(p) + len(t))],
                [0 FOR i IN range({L} - len(p) - len(t))]), ',') AS attention_mask,
            array_to_string(list_concat([-100 FOR i IN range(len(p))], t,
                [-100 FOR i IN range({L} - len(p) - len(t))]), ',') AS labels
            FROM (SELECT id, p, list_slice(list_append(t, 7), 1, {L} - len(p)) AS t
                FROM (SELECT id, list_slice({_lengths('prompt_text')}, 1, {B}) AS p,
                    {_lengths('target')} AS t FROM rendered))"""
    ),
    "prepare_from_csv": _with(
        """SELECT split, count(*) AS examples, (count(*) + 99) // 100 AS files, TRUE AS in_order,
            sum(list_sum(attention_mask))::BIGINT AS used_tokens,
            sum(list_sum(input_ids))::BIGINT AS id_sum FROM packed GROUP BY split"""
    ),
    "generate_lead_template": _with("SELECT id, prediction FROM lead"),
    "subword_decode": "SELECT doc_id, text AS decoded FROM documents",
}
ORACLE_SQL["step_token_stats"] = f"""SELECT epoch, position // 16 AS step, count(*) AS examples,
    sum(tl)::BIGINT AS target_tokens, sum(pl)::BIGINT AS prompt_tokens,
    round((count(*) * {L} - sum(pl + tl)) / (count(*) * {L}), 6) AS padding_share
    FROM ({ORACLE_SQL["step_token_stats"]}) GROUP BY ALL"""
ORACLE_SQL["stream_score_ttl"] = ORACLE_SQL["stream_score"].replace(
    "files_a_batch::INT AS files_a_batch", "remembered"
).replace("(VALUES (1), (1000)) b(files_a_batch)", "(VALUES ('1 day'), ('0 seconds')) b(remembered)")

# A Poisson variable of mean one from 16 bits of a hash: the steps of its distribution, in units of 2^-16.
POISSON = (24109, 48219, 60273, 64292, 65296, 65497, 65531, 65535)


def _digit(at: str) -> str:
    return f"(strpos('0123456789abcdef', substr(h, {at}, 1)) - 1)"


def _bootstrap(values: str, mean: str, more: str = "") -> str:
    """Means and the middle 95 % of 200 replicas' means, from rows of ``run_id, index, metric, x``."""
    drawn = " + ".join(f"{_digit(f'4 * k + {i + 1}')} * {16 ** (3 - i)}" for i in range(4))
    weight = " + ".join(f"(u >= {t})::INT" for t in POISSON)
    return f"""SELECT run_id, metric, n, round(m, 6) AS {mean}, round(low, 6) AS low, round(high, 6) AS high{more}
        FROM (SELECT run_id, metric, count(*) AS n, avg(x) AS m FROM ({values}) GROUP BY ALL)
        JOIN (SELECT run_id, metric, quantile_cont(v, 0.025) AS low, quantile_cont(v, 0.975) AS high, avg((v > 0)::INT) AS above
            FROM (SELECT run_id, metric, b, k, sum(w * x) / nullif(sum(w), 0) AS v
                FROM (SELECT index, b, k, {weight} AS w FROM (SELECT index, b, k, {drawn} AS u
                    FROM (SELECT index, b, md5('{SEED}:' || index || ':' || b) AS h
                        FROM (SELECT DISTINCT index FROM ({values})), range(25) r(b)), range(8) s(k)))
                JOIN ({values}) USING (index) GROUP BY ALL)
            GROUP BY ALL) USING (run_id, metric)"""


_METRICS = ("rouge1", "rouge2", "rougeL")
ORACLE_SQL["rouge_interval"] = _with(
    _bootstrap(" UNION ALL ".join(f"SELECT run_id, index, '{m}' AS metric, {m} AS x FROM scored" for m in _METRICS), "mean"), BOTH
)
ORACLE_SQL["rouge_paired_difference"] = _with(
    _bootstrap(
        " UNION ALL ".join(
            f"""SELECT a.run_id, index, '{m}' AS metric, a.{m} - b.{m} AS x
                FROM (SELECT * FROM scored WHERE run_id = 'lead-128') a JOIN (SELECT * FROM scored WHERE run_id = 'lead-32') b USING (index)"""
            for m in _METRICS
        ),
        "difference",
        ", round(above, 6) AS above_zero",
    ),
    BOTH,
)
ORACLE_SQL["sample_small"] = _with(
    f"""SELECT id, split, index, highlights
        FROM (SELECT *, {_position('id', 'split')} AS index FROM pairs_docs)
        WHERE index < CASE split WHEN 'train' THEN 100 WHEN 'validation' THEN 20 ELSE 1000 END"""
)
ORACLE_SQL["caller_predictor_budget"] = ORACLE_SQL["caller_predictor"]
ORACLE_SQL["budget_curve"] = _with(
    """SELECT split, b::BIGINT AS budget, count(*) AS n, round(avg((len(pt) > b)::INT), 3) AS prompt_cut,
        round(avg((len(tt) + 1 > b)::INT), 3) AS target_cut, round(avg((len(pt) + len(tt) + 1 > b)::INT), 3) AS whole_cut
        FROM toks, (VALUES (64), (128), (256), (512), (1024), (2048)) v(b) GROUP BY ALL"""
)
ORACLE_SQL["epoch_plan_bucketed"] = _with(
    f"""SELECT id, epoch::INT AS epoch, position, position AS micro_batch, position // 16 AS step
        FROM (SELECT id, epoch, 16 * step + nth % 16 AS position FROM ranked JOIN steps USING (epoch, stratum, mine)
            UNION ALL SELECT id, epoch, coalesce(16 * n, 0) + row_number() OVER (PARTITION BY epoch ORDER BY
                md5('{SEED}/' || epoch || '/rest:' || id), id) - 1
                FROM ranked LEFT JOIN (SELECT epoch, count(*) AS n FROM steps GROUP BY epoch) USING (epoch)
                ANTI JOIN steps USING (epoch, stratum, mine))""",
    others={
        "stratified": """SELECT id, (SELECT count(*) FROM (SELECT unnest(quantile_disc(length(article),
                [0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875])) AS c FROM pairs WHERE split = 'train') WHERE length(article) > c) AS stratum
            FROM pairs WHERE split = 'train'""",
        "ranked": f"""SELECT *, nth // 16 AS mine FROM (SELECT id, stratum, epoch, row_number() OVER (PARTITION BY epoch, stratum
            ORDER BY md5('{SEED}/' || epoch || ':' || id), id) - 1 AS nth FROM stratified, range(2) e(epoch))""",
        "steps": f"""SELECT epoch, stratum, mine, row_number() OVER (PARTITION BY epoch
            ORDER BY md5('{SEED}/' || epoch || '/steps:' || stratum || '-' || mine), stratum || '-' || mine) - 1 AS step
            FROM (SELECT epoch, stratum, mine FROM ranked GROUP BY ALL HAVING count(*) = 16)""",
    },
)
# Subwords: pieces by a pattern, then one merge of each distinct piece in every step. As the dialect's patterns do not look
# ahead, a mark cuts a run of white space before its last character, which goes with what follows.
SPACE = WS[1:-1].replace(r"\x1c\x1d\x1e\x1f", "")


def _pieces(column: str) -> str:
    cut = rf"regexp_replace({column}, '([{SPACE}]+)([{SPACE}][^{SPACE}])', '\1' || chr(1) || '\2', 'g')"
    words = rf"''s|''t|''re|''ve|''m|''ll|''d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}\x01]+|[{SPACE}]+"
    return f"regexp_extract_all({cut}, '{words}')"


def _subwords(texts: str, select: str) -> str:
    """A statement over ``subworded``: the ``ids`` of each ``id, kind, pieces`` of ``texts``."""
    try:
        import public_tokenizers
    except ImportError:
        path = "byte_bpe_50k.tiktoken"
    else:
        path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    others = {
        "texts": texts,
        "ranks": f"""SELECT hex(from_base64(b)) AS t, r FROM read_csv('{path}', delim=' ', header=false, quote='', escape='',
            columns={{'b': 'VARCHAR', 'r': 'INTEGER'}})""",
        "octets": """SELECT p, [substr(hex(encode(p)), 2 * i + 1, 2) FOR i IN range(strlen(p))] AS toks
            FROM (SELECT DISTINCT unnest(pieces) AS p FROM texts)""",
        "merged": """SELECT p, toks, 0 AS step FROM octets
            UNION ALL
            SELECT p, list_concat(toks[:i - 1], [toks[i] || toks[i + 1]], toks[i + 2:]), step + 1
            FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY r, i) AS k
                FROM (SELECT p, toks, step, unnest(range(1, len(toks))) AS i FROM (VALUES (1)) one(x), merged WHERE len(toks) > 1)
                JOIN ranks ON t = toks[i] || toks[i + 1]) WHERE k = 1""",
        "coded": """SELECT p, list(r ORDER BY pos) AS codes FROM (SELECT p, unnest(toks) AS t, generate_subscripts(toks, 1) AS pos
                FROM (SELECT p, arg_max(toks, step) AS toks FROM merged GROUP BY p)) JOIN ranks USING (t) GROUP BY p""",
        "subworded": """SELECT texts.id, texts.kind, coalesce(ids, []) AS ids FROM texts
            LEFT JOIN (SELECT id, kind, flatten(list(codes ORDER BY pos)) AS ids
                FROM (SELECT id, kind, unnest(pieces) AS p, generate_subscripts(pieces, 1) AS pos FROM texts) JOIN coded USING (p)
                GROUP BY id, kind) found ON texts.id = found.id AND texts.kind = found.kind""",
        "subword_cut": f"""SELECT id, p, list_slice(list_append(t, 50256), 1, {L} - len(p)) AS t
            FROM (SELECT a.id, a.ids[:{B}] AS p, b.ids AS t FROM (SELECT * FROM subworded WHERE kind = 'p') a
                JOIN (SELECT * FROM subworded WHERE kind = 't') b ON a.id = b.id)""",
    }
    return _with(select, others=others).replace("WITH ", "WITH RECURSIVE ", 1)


_SIDES = f"""SELECT id, 'p' AS kind, {_pieces('prompt_text')} AS pieces FROM rendered
    UNION ALL SELECT id, 't', {_pieces('target')} FROM rendered"""
ORACLE_SQL["subword_ids"] = _subwords(_SIDES, f"SELECT id, {_ids('p', 'prompt_ids')}, {_ids('t', 'target_ids')} FROM subword_cut")
ORACLE_SQL["subword_packed"] = _subwords(
    _SIDES,
    f"""SELECT id, array_to_string(list_concat(p, t, [50256 FOR i IN range({L} - len(p) - len(t))]), ',') AS input_ids,
        array_to_string(list_concat([1 FOR i IN range(len(p) + len(t))], [0 FOR i IN range({L} - len(p) - len(t))]), ',') AS attention_mask,
        array_to_string(list_concat([-100 FOR i IN range(len(p))], t, [-100 FOR i IN range({L} - len(p) - len(t))]), ',') AS labels
        FROM subword_cut""",
)
ORACLE_SQL["subword_usage"] = _subwords(
    f"SELECT doc_id::VARCHAR AS id, 'd' AS kind, {_pieces('text')} AS pieces FROM documents",
    "SELECT token_id, count(*) AS uses FROM (SELECT unnest(ids) AS token_id FROM subworded) GROUP BY token_id",
)
# first-fit decreasing, an example at a time
ORACLE_SQL["packed_windows"] = _with(
    f"""SELECT w AS window, string_agg(id, ' ' ORDER BY nth) AS keys,
        array_to_string(list_concat(flatten(list(list_concat(p, t) ORDER BY nth)), [2 FOR i IN range({L} - sum(size)::BIGINT)]), ',') AS input_ids,
        array_to_string(list_concat(flatten(list(list_concat([-100 FOR i IN range(len(p))], t) ORDER BY nth)),
            [-100 FOR i IN range({L} - sum(size)::BIGINT)]), ',') AS labels,
        array_to_string(list_concat(flatten(list([s FOR i IN range(size)] ORDER BY nth)), [0 FOR i IN range({L} - sum(size)::BIGINT)]), ',') AS segment_ids,
        array_to_string(list_concat(flatten(list(range(size) ORDER BY nth)), [0 FOR i IN range({L} - sum(size)::BIGINT)]), ',') AS positions
        FROM (SELECT *, row_number() OVER (PARTITION BY w ORDER BY nth) AS s FROM fitted) GROUP BY w""",
    others={
        "sized": """SELECT id, p, t, len(p) + len(t) AS size, row_number() OVER (ORDER BY len(p) + len(t) DESC, h, id) AS nth
            FROM (SELECT *, md5('42:' || id) AS h FROM cut_train)""",
        "cut_train": f"""SELECT id, p, list_slice(list_append(t, 2), 1, {L} - len(p)) AS t
            FROM (SELECT id, list_slice(p, 1, {B}) AS p, t FROM enc WHERE split = 'train')""",
        "filled": f"""SELECT 0::BIGINT AS nth, 0::BIGINT AS w, []::BIGINT[] AS room
            UNION ALL
            SELECT nth, w, CASE WHEN w > len(room) THEN list_append(room, {L} - size)
                ELSE list_concat(room[:w - 1], [room[w] - size], room[w + 1:]) END
            FROM (SELECT sized.nth, size, room,
                    coalesce(list_position([r >= size FOR r IN room], TRUE), len(room) + 1) AS w
                FROM sized, filled WHERE sized.nth = filled.nth + 1)""",
        "fitted": "SELECT sized.*, filled.w - 1 AS w FROM sized JOIN filled USING (nth)",
    },
).replace("WITH ", "WITH RECURSIVE ", 1)
ORACLE_SQL["eval_resume_bitmap"] = ORACLE_SQL["eval_resume_todo"]
ORACLE_SQL["results_commit"] = _with(
    f"""SELECT {RECORD.format(attempt=0).replace('run_id,', "'lead-128' AS run_id,", 1)}
        FROM scored s WHERE (s.run_id = 'lead-32') = (index < 300)""",
    BOTH,
)
ORACLE_SQL["decode_ids_joined"] = ORACLE_SQL["decode_ids"]
ORACLE_SQL["tokenize_ids_joined"] = ORACLE_SQL["tokenize_ids"]
