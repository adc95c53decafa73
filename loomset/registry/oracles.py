"""DuckDB SQL for the registered queries, written without the library's own expressions."""

from __future__ import annotations

SPACE = (
    r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}"
    r"\x{3000}]"
)
TOKEN = r"<\|[a-z_]+\|>|[\p{L}\p{N}_]+|[^\p{L}\p{N}_\x09-\x0d\x20]"


def stripped(value: str) -> str:
    return f"regexp_replace({value}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def tokens(value: str) -> str:
    return f"len(regexp_extract_all({value}, '{TOKEN}'))"


def first_tokens(value: str, limit: int) -> str:
    pieces = rf"regexp_extract_all({value}, '[\x09-\x0d\x20]*(?:{TOKEN})')"
    return (
        f"case when {tokens(value)} <= {limit} then {value} "
        f"else array_to_string({pieces}[1:{limit}], '') end"
    )


# The statements below are chained as common table expressions, each on the ones it names.
STEPS = {
    "instruction_rows": """
        select conv_id * 1000 + a.turn as example_id, a.text as instruction,
               coalesce(d.text, s.text) as context,
               case when conv_id % 7 = 0 then '' else r.text end as response,
               case when conv_id % 7 = 0 then r.text end as output
        from (select conv_id, turn, text from conversations where role = 'user') a
        left join (select conv_id as c, turn - 1 as turn, text from conversations
                   where role = 'assistant') r on r.c = a.conv_id and r.turn = a.turn
        left join documents d on d.doc_id = conv_id
        left join (select conv_id as c, text from conversations where role = 'system') s
               on s.c = conv_id""",
    "turns": f"""
        select *, {stripped("coalesce(instruction, '')")} as ins,
               {stripped("coalesce(context, '')")} as ctx,
               {stripped("coalesce(nullif(response, ''), output, '')")} as target
        from instruction_rows""",
    "asked": """
        select *, case when ctx <> '' then ins || chr(10) || chr(10) || 'Context:' || chr(10) || ctx
                       else ins end as user_turn
        from turns""",
    "formatted": """
        select *, prompt || target || '<|im_end|>' as text
        from (select *, '<|im_start|>system' || chr(10) || 'SYS<|im_end|>' || chr(10)
                     || '<|im_start|>user' || chr(10) || user_turn || '<|im_end|>' || chr(10)
                     || '<|im_start|>assistant' || chr(10) as prompt from asked)""",
    "measured": f"select *, {tokens('text')} as num_tokens from formatted",
    "kept": "select * from measured where num_tokens <= 512",
    "ranked": """
        select *, row_number() over (order by md5('42:' || example_id), example_id) as rk,
               count(*) over () as n from kept""",
    "placed": """
        select *, case when rk <= ceil(round(0.5::double * ceil(round(0.2::double * n, 9)), 9))
                       then 'test'
                       when rk <= ceil(round(0.2::double * n, 9)) then 'validation'
                       else 'train' end as split
        from ranked""",
    "doc_ranked": """
        select doc_id as example_id, row_number() over (order by md5('42:' || doc_id), doc_id) as rk,
               count(*) over () as n from documents""",
    "doc_placed": """
        select *, case when rk <= ceil(round(0.5::double * ceil(round(0.2::double * n, 9)), 9))
                       then 'test'
                       when rk <= ceil(round(0.2::double * n, 9)) then 'validation'
                       else 'train' end as split
        from doc_ranked""",
    "doc_measured": f"""
        select doc_id as example_id, text, {tokens('text')} as num_tokens from documents""",
    "replies": """
        select *, list_filter(string_split(coalesce(nullif(response, ''), output, ''), ' '),
                              lambda w, i: (i - 1) % 7 <> 5) as words
        from asked""",
    "predictions": """
        select example_id, 'base_model' as model, user_turn as prediction from replies
        union all
        select example_id, 'fine_tuned_model',
               array_to_string(list_concat(list_concat(
                   list_filter(words, lambda w, i: (i - 1) % 3 = 1),
                   list_filter(words, lambda w, i: (i - 1) % 3 = 0)),
                   list_filter(words, lambda w, i: (i - 1) % 3 = 2)), ' ') from replies""",
    "pairs": """
        select p.example_id, p.model, p.prediction, a.target
        from predictions p join asked a using (example_id)""",
    "test_pairs": """
        select p.* from pairs p join placed using (example_id) where split = 'test'""",
}


def grams(order: int, source: str) -> str:
    """CTEs that score one n-gram order: ``scored(example_id, model, hits, predicted, ...)``."""
    gram = "x" if order == 1 else "x || ' ' || y"
    pair = (
        "unnest({t}) as x"
        if order == 1
        else "unnest({t}[1:len({t})-1]) as x, unnest({t}[2:len({t})]) as y"
    )
    return f"""
    toks{order} as (
        select example_id, model,
               regexp_extract_all(lower(prediction), '[a-z0-9]+') as p,
               regexp_extract_all(lower(target), '[a-z0-9]+') as t from {source}),
    left{order} as (
        select example_id, model, {gram} as g, count(*) as c
        from (select example_id, model, {pair.format(t='p')} from toks{order}) group by all),
    right{order} as (
        select example_id, model, {gram} as g, count(*) as c
        from (select example_id, model, {pair.format(t='t')} from toks{order}) group by all),
    both{order} as (
        select example_id, model, sum(least(l.c, r.c))::bigint as hits
        from left{order} l join right{order} r using (example_id, model, g) group by all),
    scored{order} as (
        select example_id, model, 'rouge{order}' as metric, coalesce(hits, 0)::bigint as hits,
               greatest(len(p) - {order - 1}, 0)::bigint as predicted,
               greatest(len(t) - {order - 1}, 0)::bigint as expected
        from toks{order} left join both{order} using (example_id, model))"""


def longest(source: str) -> str:
    """CTEs that score the longest common subsequence with one table row per target token.

    Predicted tokens that the target lacks cannot match and are left out of the table.
    """
    return f"""
    toksL as (
        select example_id, model,
               regexp_extract_all(lower(prediction), '[a-z0-9]+') as p,
               regexp_extract_all(lower(target), '[a-z0-9]+') as t from {source}),
    matchL as (
        select example_id, model, len(p) as size, t,
               list_filter(p, lambda x: list_contains(t, x)) as p from toksL),
    rowsL as (
        select example_id, model, size, p, t, 0 as i,
               list_transform(range(0, len(p) + 1), lambda x: 0::bigint) as d from matchL
        union all
        select example_id, model, size, p, t, i + 1,
               list_reduce(
                   list_transform(range(1, len(p) + 1), lambda j: [j::bigint]),
                   lambda acc, x: list_append(acc,
                       case when p[x[1]] = t[i + 1] then d[x[1]] + 1
                            else greatest(d[x[1] + 1], acc[-1]) end),
                   [0::bigint])
        from rowsL where i < len(t)),
    scoredL as (
        select example_id, model, 'rougeL' as metric, d[-1]::bigint as hits,
               size::bigint as predicted, len(t)::bigint as expected
        from rowsL where i = len(t))"""


def summary_longest(source: str) -> str:
    """CTEs that score the union of line-wise longest common subsequences.

    One recursion keeps the whole table of each pair of lines, a second walks it back, one target
    token a step: it takes the last column from which that token is matched or dropped.
    """
    lower = "regexp_extract_all(lower({}), '[a-z0-9]+')"
    return f"""
    linesS as (
        select example_id, model, tl, pl, {lower.format('x')} as t, {lower.format('y')} as p
        from (select example_id, model, unnest(string_split(target, chr(10))) as x,
                     unnest(range(len(string_split(target, chr(10))))) as tl from {source})
        join (select example_id, model, unnest(string_split(prediction, chr(10))) as y,
                     unnest(range(len(string_split(prediction, chr(10))))) as pl from {source})
        using (example_id, model)),
    tableS as (
        select example_id, model, tl, pl, p, t, 0 as i,
               [list_transform(range(0, len(p) + 1), lambda x: 0::int)] as d
        from linesS where len(p) > 0 and len(t) > 0
        union all
        select example_id, model, tl, pl, p, t, i + 1,
               list_append(d, list_reduce(
                   list_transform(range(1, len(p) + 1), lambda j: [j::int]),
                   lambda acc, x: list_append(acc,
                       case when p[x[1]] = t[i + 1] then d[i + 1][x[1]] + 1
                            else greatest(d[i + 1][x[1] + 1], acc[-1]) end),
                   [0::int]))
        from tableS where i < len(t)),
    walkS as (
        select example_id, model, tl, pl, p, t, d, len(t)::bigint as i, len(p)::bigint as j,
               null::bigint as hit
        from tableS where i = len(t)
        union all
        select example_id, model, tl, pl, p, t, d, i - 1,
               case when p[k] = t[i] then k - 1 else k end,
               case when p[k] = t[i] then i end
        from (select *, list_last(list_filter(range(1, j + 1), lambda x:
                  p[x] = t[i] or d[i][x + 1] >= d[i + 1][x])) as k
              from walkS where i > 0 and j > 0 and d[i + 1][j + 1] > 0)),
    matchedS as (
        select example_id, model, token, count(*) as m
        from (select distinct example_id, model, tl, hit, t[hit] as token
              from walkS where hit is not null) group by all),
    sizesS as (
        select example_id, model, {lower.format('prediction')} as p, {lower.format('target')} as t
        from {source}),
    saidS as (
        select example_id, model, token, count(*) as n
        from (select example_id, model, unnest(p) as token from sizesS) group by all),
    hitsS as (
        select example_id, model, sum(least(m, n))::bigint as hits
        from matchedS join saidS using (example_id, model, token) group by all),
    scoredS as (
        select example_id, model, 'rougeLsum' as metric, coalesce(hits, 0)::bigint as hits,
               len(p)::bigint as predicted, len(t)::bigint as expected
        from sizesS left join hitsS using (example_id, model))"""


F1 = "case when hits > 0 then 2.0::double * hits / (predicted + expected) else 0.0::double end"
SCORES = f"""select example_id, model, metric, hits, predicted, expected,
    round(case when predicted > 0 then hits::double / predicted else 0.0 end, 6) as "precision",
    round(case when expected > 0 then hits::double / expected else 0.0 end, 6) as recall,
    round({F1}, 6) as f1"""
BY_PAIR = ("instruction_rows", "turns", "asked", "replies", "predictions", "pairs")
TO_FORMATTED = ("instruction_rows", "turns", "asked", "formatted")
TO_KEPT = (*TO_FORMATTED, "measured", "kept")
TO_PLACED = (*TO_KEPT, "ranked", "placed")
BY_TEST_PAIR = (*TO_PLACED, "replies", "predictions", "pairs", "test_pairs")


def sql(steps: tuple[str, ...], select: str, extra: tuple[str, ...] = ()) -> str:
    parts = [f"{name} as ({STEPS[name]})" for name in steps] + list(extra)
    recursive = "recursive " if any("rowsL" in part or "tableS" in part for part in extra) else ""
    return (f"with {recursive}" + ",\n".join(parts) + "\n" if parts else "") + select


def compared(mean: str) -> str:
    return f"""
        select metric, round(b, 6) as base_model, round(f, 6) as fine_tuned_model,
               round(f - b, 6) as delta
        from (select metric, avg({F1}) filter (model = 'base_model') as b,
                     avg({F1}) filter (model = 'fine_tuned_model') as f
              from {mean} group by metric)"""


def profile(lengths: str) -> str:
    return f"""
        select count(*) as n_rows, round(avg(n_words), 6) as mean_words,
               round(quantile_cont(n_words, 0.95), 6) as p95_words, max(n_words)::int as max_words
        from ({lengths})"""


WORDS = f"""len(regexp_extract_all(
    coalesce(instruction, '') || coalesce(context, '') || coalesce(response, ''),
    '{SPACE.replace("[", "[^", 1)}+'))"""
PADDED = (
    "chr(160) || chr(10) || ' ' || chr(8195) || text || chr(9) || chr(12288) || chr(28) || chr(133)"
)
ECHO = "array_to_string(list_reverse(string_split(fed, ' ')), ' ')"


def generated(continuation: str, source: str) -> str:
    """Cleaned predictions of a model that writes ``continuation`` after the prompt it is fed."""
    cleaned = stripped("regexp_replace(" + first_tokens("new", 128) + r", '<\|[a-z_]+\|>', '', 'g')")
    return f"""
        select example_id, {cleaned} as prediction
        from (select example_id, ' ' || {continuation} || '<|im_end|>' as new
              from (select example_id, {first_tokens('prompt', 2048)} as fed from {source}))"""


def intervals(source: str, resamples: int) -> str:
    """Plain mean and percentiles of Poisson resamples, drawn 16 bits at a time from MD5."""
    least = (24109, 48218, 60273, 64292, 65296, 65497, 65531, 65535)
    times = " + ".join(f"(u >= {n})::int" for n in least)
    return f"""
        select model, metric, round(max(value) filter (draw = 0), 6) as value,
               round(quantile_cont(value, 0.025) filter (draw > 0), 6) as low,
               round(quantile_cont(value, 0.5) filter (draw > 0), 6) as mid,
               round(quantile_cont(value, 0.975) filter (draw > 0), 6) as high
        from (select model, metric, draw, sum(f1 * times) / sum(times) as value
              from (select model, metric, f1, draw, case when draw = 0 then 1 else {times} end as times
                    from (select model, metric, {F1} as f1, draw,
                                 ('0x' || substr(md5(((draw - 1) // 8)::varchar || ':' || example_id),
                                                 (draw - 1) % 8 * 4 + 1, 4))::int as u
                          from {source}, range(0, {resamples + 1}) r(draw)))
              where times > 0 group by all)
        group by all"""


DOCUMENTS_AS_ROWS = """
    select doc_id as example_id, doc_id, text as instruction, lang, source, n_chars,
           null::varchar as context, null::varchar as response, null::varchar as output
    from documents"""

ORACLES = {
    "load_table": "select doc_id, text, lang, source, n_chars from documents",
    "jsonl_roundtrip": sql(
        TO_FORMATTED,
        """select example_id, instruction, coalesce(context, '<null>') as context, response,
        coalesce(output, '<null>') as output, text, prompt, target, 'train' as split
        from formatted""",
    ),
    "split_reload": sql(TO_PLACED, "select example_id, split, text, prompt, target from placed"),
    "split_reload_parquet": sql(TO_PLACED, "select example_id, split, text, prompt, target from placed"),
    "split_redo": sql(TO_PLACED, "select example_id, split, text, prompt, target from placed"),
    "arrivals": sql(TO_KEPT, "select example_id, instruction, text, prompt, target from kept"),
    "strip_text": f"select doc_id as example_id, {stripped(PADDED)} as stripped from documents",
    "user_turn": sql(
        ("instruction_rows", "turns", "asked"), "select example_id, user_turn from asked"
    ),
    "response_fallback": sql(
        ("instruction_rows", "turns"), "select example_id, target from turns"
    ),
    "message_list": sql(
        ("instruction_rows", "turns", "asked"),
        """select example_id, 3 as n_messages, 'system|user|assistant' as roles,
        'SYS|' || user_turn || '|' || target as contents from asked""",
    ),
    "render_template": sql(
        ("instruction_rows", "turns", "asked"),
        r"""select example_id, head || '<|assistant|>' || chr(10) as prompt,
        head || '<|assistant|>' || chr(10) || target || '<|end|>' || chr(10) || '<|endoftext|>'
            as text
        from (select *, '<|system|>' || chr(10) || 'SYS<|end|>' || chr(10) || '<|user|>' || chr(10)
                     || user_turn || '<|end|>' || chr(10) as head from asked)""",
    ),
    "chatml_render": sql(TO_FORMATTED, "select example_id, prompt, text from formatted"),
    "formatted_rows": sql(
        TO_FORMATTED, "select example_id, instruction, text, prompt, target from formatted"
    ),
    "token_count": f"""
        select doc_id as example_id, {tokens('text')}::int as num_tokens from documents""",
    "within_limit_flag": sql(
        (*TO_FORMATTED, "measured"),
        "select example_id, num_tokens::int as num_tokens, num_tokens <= 512 as within_limit "
        "from measured",
    ),
    "prepared_rows": sql(
        TO_KEPT, "select example_id, instruction, text, prompt, target from kept"
    ),
    "text_only": sql(
        TO_PLACED, "select text, split from placed where split in ('train', 'validation')"
    ),
    "prompt_target": sql(
        TO_PLACED, "select example_id, prompt, target from placed where split = 'test'"
    ),
    "word_lengths": sql(
        ("instruction_rows",), f"select example_id, {WORDS}::int as n_words from instruction_rows"
    ),
    "preview_row": sql(
        TO_FORMATTED,
        "select example_id, prompt, text from formatted order by example_id limit 1",
    ),
    "content_ids": """
        select sha256(length(text) || ':' || text || length(lang) || ':' || lang) || '-'
               || (row_number() over (partition by text, lang) - 1) as example_id,
               length(text)::int as n_chars, lang
        from documents""",
    "length_filter": sql(
        ("doc_measured",), "select example_id, text from doc_measured where num_tokens <= 2048"
    ),
    "length_drop_report": sql(
        ("doc_measured",),
        """select count(*) as rows_before,
        count(*) filter (num_tokens <= 2048) as rows_after,
        count(*) filter (num_tokens > 2048) as rows_dropped from doc_measured""",
    ),
    "row_gate": sql(
        ("doc_measured",),
        """select stage, n, 1000::bigint as minimum, n >= 1000 as passed
        from (select 'raw' as stage, count(*) as n from doc_measured
              union all
              select 'kept', count(*) from doc_measured where num_tokens <= 2048)""",
    ),
    "empty_split_check": sql(
        TO_PLACED,
        """select count(*) filter (split = 'train') as train_rows,
        count(*) filter (split = 'validation') as validation_rows,
        count(*) filter (split = 'train') > 0 and count(*) filter (split = 'validation') > 0
            as passed
        from placed""",
    ),
    "split_assign": sql(("doc_ranked", "doc_placed"), "select example_id, split from doc_placed"),
    "split_sizes": sql(TO_PLACED, 'select split, count(*) as "rows" from placed group by split'),
    "split_summary": sql(
        ("doc_ranked", "doc_placed"),
        """select 'documents' as dataset, split,
        case split when 'train' then 0.8::double else 0.1::double end as planned_share,
        count(*) as "rows", count(*) / any_value(n) as actual_share
        from doc_placed group by split""",
    ),
    "word_length_profile": profile(
        f"""select len(regexp_extract_all(text, '{SPACE.replace("[", "[^", 1)}+')) as n_words
        from documents"""
    ),
    "word_length_sample": profile(
        f"""select len(regexp_extract_all(text, '{SPACE.replace("[", "[^", 1)}+')) as n_words
        from (select text from documents order by doc_id limit 500)"""
    ),
    "prompt_truncate": f"""
        select doc_id as example_id, {first_tokens('text', 2048)} as prompt from documents""",
    "prediction_clean": sql(
        TO_FORMATTED,
        f"""select example_id, {stripped(
            "regexp_replace(" + first_tokens("new", 128) + r", '<\|[a-z_]+\|>', '', 'g')"
        )} as prediction
        from (select example_id, ' ' || chr(10) || target || '<|im_end|>' as new from formatted)""",
    ),
    "batch_predict": sql(
        TO_FORMATTED,
        f"select example_id, 'base_model' as model, prediction from ({generated(ECHO, 'formatted')})",
    ),
    "scored_pairs": sql(BY_PAIR, "select example_id, model, prediction, target from pairs"),
    "alignment_check": sql(
        TO_KEPT,
        """select 'base_model' as model, 0::bigint as missing, 0::bigint as unknown,
               count(*) as repeated from instruction_rows
        union all
        select 'fine_tuned_model', count(*) - (select count(*) from kept), 0, 0
        from instruction_rows""",
    ),
    "rouge1": sql(BY_PAIR, f"{SCORES} from scored1", (grams(1, "pairs"),)),
    "rouge2": sql(BY_PAIR, f"{SCORES} from scored2", (grams(2, "pairs"),)),
    "rougeL": sql(BY_PAIR, f"{SCORES} from scoredL", (longest("pairs"),)),
    "rougeLsum": sql(BY_PAIR, f"{SCORES} from scoredS", (summary_longest("pairs"),)),
    "model_scores": sql(
        BY_PAIR,
        f"""select model, metric, round(avg({F1}), 6) as value
        from (from scored1 union all from scored2 union all from scoredL union all from scoredS)
        group by all""",
        (grams(1, "pairs"), grams(2, "pairs"), longest("pairs"), summary_longest("pairs")),
    ),
    "model_compare": sql(
        BY_PAIR,
        compared(
            """(select * from scored1 union all
                select * from scored2 where model = 'base_model')"""
        ),
        (grams(1, "pairs"), grams(2, "pairs")),
    ),
    "qualitative_examples": sql(
        ("instruction_rows", "turns", "asked", "formatted", "replies", "predictions"),
        """select f.example_id, f.prompt, f.target as ground_truth,
               b.prediction as base_model_response, t.prediction as fine_tuned_response
        from (select * from formatted order by example_id limit 5) f
        join predictions b on b.example_id = f.example_id and b.model = 'base_model'
        join predictions t on t.example_id = f.example_id and t.model = 'fine_tuned_model'""",
    ),
    "evaluation_job": sql(
        BY_TEST_PAIR,
        compared(
            """(from scored1 union all from scored2 union all from scoredL
                union all from scoredS)"""
        ),
        (
            grams(1, "test_pairs"),
            grams(2, "test_pairs"),
            longest("test_pairs"),
            summary_longest("test_pairs"),
        ),
    ),
    "evaluation_rerun": sql(
        BY_TEST_PAIR,
        f"""select metric, fine_tuned_model as base_model, base_model as fine_tuned_model,
        -delta as delta from ({compared("scored1")})""",
        (grams(1, "test_pairs"),),
    ),
    "evaluation_switch": sql(
        TO_PLACED,
        compared("scored1"),
        (
            "tested as (select * from placed where split = 'test')",
            f"""switched as (
                select example_id, 'base_model' as model, prediction, target
                from ({generated(ECHO, 'tested')}) join tested using (example_id)
                union all
                select example_id, 'fine_tuned_model', prediction, target
                from ({generated('fed', 'tested')}) join tested using (example_id))""",
            grams(1, "switched"),
        ),
    ),
    "score_intervals": sql(
        BY_PAIR,
        intervals("(from scored1 union all from scored2)", 200),
        (grams(1, "pairs"), grams(2, "pairs")),
    ),
    "written_examples": sql(
        (*TO_PLACED, "replies", "predictions"),
        """select f.example_id, f.prompt, f.target as ground_truth,
               b.prediction as base_model_response, t.prediction as fine_tuned_response
        from (select * from placed where split = 'test' order by example_id limit 5) f
        join predictions b on b.example_id = f.example_id and b.model = 'base_model'
        join predictions t on t.example_id = f.example_id and t.model = 'fine_tuned_model'""",
    ),
    "explore_job": f"""
        with instruction_rows as ({DOCUMENTS_AS_ROWS}),
        turns as ({STEPS["turns"]}), asked as ({STEPS["asked"]}),
        formatted as ({STEPS["formatted"]}),
        profile as ({profile(f"""
            select len(regexp_extract_all(text, '{SPACE.replace("[", "[^", 1)}+')) as n_words
            from (select text from documents order by doc_id limit 500)""")})
        select profile.*, example_id, prompt, text, (select count(*) from documents) as all_rows
        from profile, (select * from formatted order by example_id limit 1)""",
    "json_passthrough": f"""
        with instruction_rows as ({DOCUMENTS_AS_ROWS}),
        turns as ({STEPS["turns"]}), asked as ({STEPS["asked"]}),
        formatted as ({STEPS["formatted"]})
        select example_id, doc_id, instruction, lang, source, n_chars, prompt, target, text
        from formatted""",
}
