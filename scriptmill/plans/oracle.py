"""DuckDB SQL oracles for the driver queries.

Each string runs on the driver's pre-registered tables.  The operators are
written the plain SQL way: a character machine for comments, a recursive line
walker for blocks, line numbers for log entries, string positions for
localization lines, a four-way suffix lookup for descriptions, one global
``row_number`` for shuffles.  Inputs and fixed values are shared with the Spark
side, patterns and designs are not.
"""

from __future__ import annotations

from ..fixed import (BASE_MODEL, CATEGORY_DIRS, DATA_TYPE_QUESTION, DEFAULT_TEMPLATES, EVAL_PROMPTS,
                     INSTRUCTION_TEMPLATES, LOG_QUESTIONS, SKIP_DIRS, SYSTEM_CHAT_DEFAULT, SYSTEM_ENGINE,
                     SYSTEM_LOCALIZATION, SYSTEM_SCRIPT, TRAIN_DEFAULTS)
from .views import duckdb_with

NL = "chr(10)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


#: the code points Python's str.strip() takes for white space
SPACES = [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SPACE_CHARS = "(" + " || ".join(f"chr({c})" for c in SPACES) + ")"
SPACE = "[" + "".join(rf"\x{{{c:x}}}" for c in SPACES) + "]"
WORD_CHAR = r"[\pL\pN_]"


def strip(x: str) -> str:
    return f"trim({x}, {SPACE_CHARS})"


def nchar(x: str, ch: str) -> str:
    return f"(length({x}) - length(replace({x}, {q(ch)}, '')))"


def category_case(p: str) -> str:
    whens = " ".join(f"when starts_with({p}, {q(d)}) then {q(c)}" for _, c, d in CATEGORY_DIRS)
    return f"case {whens} else 'other' end"


DIRS_VALUES = "(values " + ", ".join(f"({o}, {q(c)}, {q(d)})" for o, c, d in CATEGORY_DIRS) + ") cd(cat_ord, category, dir)"
SKIP_LIST = "[" + ", ".join(q(s) for s in SKIP_DIRS) + "]"
HASH = "('0x' || substr(md5({salt} || '|' || {key}), 1, 8))::UBIGINT"


def khash(salt: str, key: str) -> str:
    return HASH.format(salt=q(salt), key=key)


ORACLE: dict[str, str] = {}

RAW = f"""raw AS (
  select text, path, {category_case('path')} as category,
         cast({nchar('text', chr(10))} + 1 as bigint) as lines
  from v_scripts
  where not list_has_any(list_filter(string_split(path, '/'), lambda x: x <> ''), {SKIP_LIST})
    and {strip('text')} <> '')
"""

ORACLE["corpus_raw"] = duckdb_with(["v_scripts"]) + ", " + RAW + "select * from raw"

ORACLE["corpus_clm"] = duckdb_with(["v_scripts"]) + ", " + RAW + \
    f"select '# File: ' || path || {NL} || '# Category: ' || category || {NL} || {NL} || text as text from raw"

def uncomment(x: str) -> str:
    """One character after the other: o what is left so far, s inside a string, c inside a comment."""
    start = "{'o': '', 's': false, 'c': false}"
    chars = f"list_transform(string_split({x}, ''), lambda ch: {{'o': ch, 's': false, 'c': false}})"
    step = (f"{{'o': a.o || case when (a.c and b.o <> {NL}) or (not a.s and not a.c and b.o = '#') then '' else b.o end, "
            "'s': case when not a.c and b.o = '\"' then not a.s else a.s end, "
            f"'c': case when a.c then b.o <> {NL} else not a.s and b.o = '#' end}}")
    return f"struct_extract(list_reduce(list_prepend({start}, {chars}), lambda a, b: {step}), 'o')"


ORACLE["strip_comments"] = duckdb_with(["v_scripts"]) + f"select path, {uncomment('text')} as text from v_scripts"


#: the name before an opening: what stands before the first '=', if it is a name and '{' follows
OPENER = (f"case when strpos(line, '=') > 0 and starts_with({strip("substr(line, strpos(line, '=') + 1)")}, '{{') "
          f"and regexp_full_match({strip("split_part(line, '=', 1)")}, {q(WORD_CHAR + r'[\pL\pN_.]*')}) "
          f"then {strip("split_part(line, '=', 1)")} else '' end")


def blocks_sql(src: str) -> str:
    """CTEs ``lines``, ``walk``, ``blocks`` over a ``src(path, text)`` CTE: a
    recursive line walker (one step per line), the plain form of the rules."""
    return f"""
lines AS (
  select path, ln, line, {nchar('line', '{')} - {nchar('line', '}')} as d,
         {OPENER} as name,
         starts_with({strip('line')}, '#') as is_c
  from (select path, unnest(range(len(arr))) as ln, unnest(arr) as line
        from (select path, string_split(text, {NL}) as arr from {src}))
),
walk AS (
  select path, -1::bigint as ln, null::bigint as start, 0::bigint as depth, null::bigint as blk
  from (select distinct path from {src})
  union all
  select w.path, l.ln,
    case when w.start is null then (case when l.name <> '' and l.d > 0 then l.ln end)
         when w.depth + l.d <= 0 then null else w.start end,
    case when w.start is null then (case when l.name <> '' then l.d else 0 end) else w.depth + l.d end,
    case when w.start is null then (case when l.name <> '' then l.ln end) else w.start end
  from walk w join lines l on l.path = w.path and l.ln = w.ln + 1
),
blk_lines AS (select w.path, w.blk, l.ln, l.line, l.name from walk w join lines l using (path, ln) where w.blk is not null),
prev_nc AS (
  select path, ln, max(case when not is_c then ln end) over (partition by path order by ln
         rows between unbounded preceding and 1 preceding) as pnc from lines
),
blocks AS (
  select b.path, b.blk as ln, max(case when b.ln = b.blk then b.name end) as name,
         string_agg(b.line, {NL} order by b.ln) as code,
         cast(count(*) as bigint) as lines
  from blk_lines b group by b.path, b.blk
),
headers AS (
  select bl.path, bl.ln, coalesce(string_agg(l.line, {NL} order by l.ln), '') as comment_header
  from blocks bl join prev_nc p on p.path = bl.path and p.ln = bl.ln
  left join lines l on l.path = bl.path and l.ln < bl.ln and l.ln > coalesce(p.pnc, -1)
  group by bl.path, bl.ln
),
blocks_h AS (select b.path, b.ln, b.name, b.code, h.comment_header, b.lines from blocks b join headers h using (path, ln))
"""


STRIPPED = f"stripped AS (select path, {uncomment('text')} as text from v_scripts),"
ORACLE["blocks_top"] = duckdb_with(["v_scripts"], recursive=True) + ", " + STRIPPED + blocks_sql("stripped") + \
    "select path, ln, name, code, comment_header, lines from blocks_h"
ORACLE["blocks_headers"] = duckdb_with(["v_scripts"], recursive=True) + ", " + blocks_sql("v_scripts") + \
    "select path, ln, name, code, comment_header, lines from blocks_h"

STRUCT = f"""{STRIPPED}
cat_files AS (select s.path, cd.cat_ord, cd.category from v_scripts s join {DIRS_VALUES}
              on starts_with(s.path, cd.dir || '/')),
cat_src AS (select path, text from stripped where path in (select path from cat_files)),
{blocks_sql('cat_src')},
sblocks AS (select b.name, c.category, b.path as source_file, b.code, b.comment_header, b.lines, b.ln
            from blocks_h b join cat_files c using (path))
"""
ORACLE["blocks_structured"] = duckdb_with(["v_scripts"], recursive=True) + ", " + STRUCT + "select * from sblocks"
ORACLE["category_counts"] = duckdb_with(["v_scripts"], recursive=True) + ", " + STRUCT + \
    "select category, count(*) as n from sblocks group by category order by n desc, category"

def loc_sql(view: str, tag: str = "") -> str:
    """Localization lines by string positions: the key before the first colon, digits and
    white space up to the first quote behind it, the value up to the line's last quote."""
    return f"""
loc_s{tag} AS (select path, ln, {strip('line')} as s from {view}),
loc_p{tag} AS (select path, ln, s, split_part(s, ':', 1) as key, substr(s, strpos(s, ':') + 1) as rest from loc_s{tag} where strpos(s, ':') > 0),
loc_q{tag} AS (select path, ln, key, split_part(rest, '"', 1) as gap, substr(rest, strpos(rest, '"') + 1) as tail
               from loc_p{tag} where strpos(rest, '"') > 0),
loc_e{tag} AS (select path, ln, key, left(tail, length(tail) - strpos(reverse(tail), '"')) as value from loc_q{tag}
               where regexp_full_match(key, {q(WORD_CHAR + '+')}) and strpos(tail, '"') > 0
                 and length(rtrim(gap, {SPACE_CHARS})) < length(gap)
                 and regexp_full_match(rtrim(gap, {SPACE_CHARS}), {q(r'\p{Nd}*')}) and length(left(tail, length(tail) - strpos(reverse(tail), '"'))) > 0),
loc_l{tag} AS (select key, value from (select key, value, row_number() over (partition by key order by path desc, ln desc) as r
          from loc_e{tag}) where r = 1)
"""


def clean(x: str) -> str:
    v = f"regexp_replace({x}, {q(f'#{WORD_CHAR}{SPACE}*')}, '', 'g')"
    v = f"regexp_replace({v}, {q(chr(92) + '[[^' + chr(92) + 'n]*?' + chr(92) + ']')}, '', 'g')"
    return strip(v)


DESC = f"""
suffixes AS (select * from (values (0, ''), (1, '_desc'), (2, '_tooltip'), (3, '_title')) t(prio, suf)),
desc_c AS (select b.source_file, b.ln, b.category, b.name, s.prio, {clean('l.value')} as d
           from sblocks b cross join suffixes s join loc_l l on l.key = b.name || s.suf),
desc_best AS (select source_file, ln, category, name, d from
              (select *, row_number() over (partition by source_file, ln, category order by prio) as r
               from desc_c where d <> '') where r = 1)
"""

ORACLE["loc_entries"] = duckdb_with(["v_loc"]) + ", " + loc_sql("v_loc") + "select path, ln, key, value from loc_e"
ORACLE["loc_latest"] = duckdb_with(["v_loc"]) + ", " + loc_sql("v_loc") + "select key, value from loc_l"
ORACLE["loc_describe"] = duckdb_with(["v_scripts", "v_loc"], recursive=True) + ", " + STRUCT + "," + loc_sql("v_loc") + "," + DESC + \
    """select b.source_file, b.ln, b.category, b.name, coalesce(d.d, 'is a ' || b.category || ' definition') as loc_desc
       from sblocks b left join desc_best d using (source_file, ln, category)"""

TEMPLATES_VALUES = "(values " + ", ".join(
    f"({q(c)}, {i}, {q(t)})" for c, ts in INSTRUCTION_TEMPLATES.items() for i, t in enumerate(ts)) + \
    ") tv(category, idx, template)"
DEFAULTS_VALUES = "(values " + ", ".join(f"({i}, {q(t)})" for i, t in enumerate(DEFAULT_TEMPLATES)) + ") dv(idx, template)"

SCRIPT_PAIRS = STRUCT + "," + loc_sql("v_loc") + "," + DESC + f""",
tcount AS (select category, count(*) as n from {TEMPLATES_VALUES} group by category),
pb AS (select b.*, coalesce(d.d, 'is a ' || b.category || ' definition') as loc_desc,
         {khash('42', "b.source_file || '|' || cast(b.ln as varchar) || '|' || b.category")} as h,
         coalesce(tc.n, {len(DEFAULT_TEMPLATES)}) as n
       from sblocks b left join desc_best d using (source_file, ln, category)
       left join tcount tc on tc.category = b.category where b.lines >= 3),
pt AS (select pb.*, coalesce(tv.template, dv.template) as template from pb
       left join {TEMPLATES_VALUES} on tv.category = pb.category and tv.idx = pb.h % pb.n
       left join {DEFAULTS_VALUES} on pb.n = {len(DEFAULT_TEMPLATES)} and tv.template is null and dv.idx = pb.h % pb.n),
script_pairs AS (select {q(SYSTEM_SCRIPT)} as system,
  replace(replace(replace(template, '{{name}}', name), '{{category}}', category), '{{loc_desc}}', loc_desc) as instruction,
  code as completion, category, source_file, name from pt)
"""
ORACLE["pairs_sft"] = duckdb_with(["v_scripts", "v_loc"], recursive=True) + ", " + SCRIPT_PAIRS + "select * from script_pairs"

PREFIX = "case when instr(key, '_') > 0 then left(key, length(key) - strpos(reverse(key), '_')) else key end"


def loc_pairs_sql(split: bool = False) -> str:
    size = "n >= 2" if split else "n between 2 and 20"
    part = f"{khash('part', 'key')} % cast(ceil(n / 20.0) as bigint)" if split else "0"
    return f"""{loc_sql("v_loc_groups", "g")},
kp AS (select key, value, {PREFIX} as prefix from loc_lg),
sized AS (select *, count(*) over (partition by prefix) as n from kp),
dealt AS (select *, {part} as part from sized where {size}),
loc_pairs AS (select {q(SYSTEM_LOCALIZATION)} as system, 'Write CK3 localization entries for ' || chr(39) || prefix || chr(39) as instruction,
  'l_english:' || {NL} || string_agg('  ' || key || ':0 "' || value || '"', {NL} order by key, value) as completion,
  'localization' as category, prefix as name
from dealt group by prefix, part)
"""


ORACLE["pairs_loc"] = duckdb_with(["v_loc_groups"]) + ", " + loc_pairs_sql() + "select * from loc_pairs"
ORACLE["pairs_loc_split"] = duckdb_with(["v_loc_groups"]) + ", " + loc_pairs_sql(split=True) + "select * from loc_pairs"
ORACLE["jsonl_round_trip"] = ORACLE["pairs_loc"]


def entries_sql(view: str, dashes: int) -> str:
    """Entries by line numbers: lines between delimiter lines, joined, stripped, empty ones dropped."""
    return f"""(select file, row_number() over (partition by file order by part) as entry_no, entry from (
  select file, part, {strip(f"string_agg(line, {NL} order by ln)")} as entry from (
    select file, ln, line, cut, sum(cut) over (partition by file order by ln) as part from (
      select file, ln, line, case when starts_with({strip('line')}, '{'-' * dashes}') then 1 else 0 end as cut from (
        select file, unnest(range(len(arr))) as ln, unnest(arr) as line from (select file, string_split(text, {NL}) as arr from {view}))))
  where cut = 0 group by file, part) where entry <> '')"""


def first_line(x: str) -> str:
    return strip(f"split_part({x}, {NL}, 1)")


LOG_NAME = strip(f"split_part(split_part({first_line('entry')}, ' - ', 1), ':', 1)")
TYPE_NAME = strip(f"split_part({first_line('entry')}, '(', 1)")

ORACLE["engine_entries"] = duckdb_with(["v_logs"]) + \
    f"select file, entry_no, {LOG_NAME} as name, entry from {entries_sql('v_logs', 4)} where length(entry) >= 10"
ORACLE["datatype_entries"] = duckdb_with(["v_types"]) + \
    f"select file, entry_no, {TYPE_NAME} as name, entry from {entries_sql('v_types', 5)} where length(entry) >= 10"


def count_sql(view: str, dashes: int, kind: str) -> str:
    return (f"select {q(kind)} as kind, v.file, cast(count(e.entry) as bigint) as n_entries from {view} v "
            f"left join {entries_sql(view, dashes)} e on e.file = v.file group by v.file")


ORACLE["engine_counts"] = duckdb_with(["v_logs", "v_types"]) + count_sql("v_logs", 4, "log") + \
    " union all " + count_sql("v_types", 5, "data_type")

QUESTION = "case " + " ".join(f"when contains(category, {q(n)}) then {q(t)}" for n, t in LOG_QUESTIONS[:-1]) + \
    f" else {q(LOG_QUESTIONS[-1][1])} end"
ENGINE_PAIRS = f"""
le AS (select e.file, f.category, e.entry, {LOG_NAME} as name
       from {entries_sql('v_logs', 4)} e join v_log_files f using (file) where length(e.entry) >= 10),
te AS (select file, entry, {TYPE_NAME} as name from {entries_sql('v_types', 5)} where length(entry) >= 10),
engine_pairs AS (select {q(SYSTEM_ENGINE)} as system, replace({QUESTION}, '{{name}}', name) as instruction, entry as completion,
  category, name, 'logs/' || file as source_file from le
union all
select {q(SYSTEM_ENGINE)}, replace({q(DATA_TYPE_QUESTION)}, '{{name}}', name), entry, 'data_type', name,
  'logs/data_types/' || file from te)
"""
ORACLE["pairs_engine"] = duckdb_with(["v_logs", "v_log_files", "v_types"]) + ", " + ENGINE_PAIRS + "select * from engine_pairs"


def scored_sql(how: str = "inner", max_ord: int | None = None, outputs: str = "v_outputs", prompts: str = "v_prompts",
               run: str = "run_id") -> str:
    pf = f"where ord < {max_ord}" if max_ord is not None else ""
    t = "o.text"
    found = "len(list_filter(p.checks, lambda c: contains(o.text, c)))"
    total = "len(p.checks)"
    one, zero, half = "1.0::DOUBLE", "0.0::DOUBLE", "0.5::DOUBLE"
    bal = f"(case when {nchar(t, '{')} = {nchar(t, '}')} and {nchar(t, '{')} > 0 then {one} else {zero} end)"
    asg = f"(case when contains({t}, '=') then {one} else {zero} end)"
    code = (f"(case when contains({t}, 'def ') or contains({t}, 'import ') or contains({t}, 'class ') "
            f"then {one} else {zero} end)")
    syn = f"(({bal} * {half} + {asg} * {half}) * ({one} - {code} * {half}))"
    kw = f"({found}::DOUBLE / greatest({total}, 1))"
    scope = "(" + " or ".join(f"contains({t}, '{w}')" for w in ("root", "scope:", "this", "prev", "trigger", "effect", "limit")) + ")"
    st = (f"((case when regexp_matches({t}, {q(WORD_CHAR + SPACE + '*=' + SPACE + '*[{]')}) then {half} else {zero} end) + "
          f"(case when {scope} then {half} else {zero} end))")
    tot = f"({syn} * 0.4::DOUBLE + {kw} * 0.3::DOUBLE + {st} * 0.3::DOUBLE)"
    m = "p.ord is not null"
    w = (lambda e: f"case when {m} then {e} end") if how != "inner" else (lambda e: e)
    return f"""scored AS (
  select o.{run}, o.prompt_id, p.ord,
    {w(f'round({syn}, 4)')} as syntax_score, {w(f'round({kw}, 4)')} as keyword_score,
    {w(f'round({st}, 4)')} as structure_score, {w(f'round({tot}, 4)')} as total_score,
    {w(f"{nchar(t, '{')} = {nchar(t, '}')}")} as brace_balanced,
    {w(f'cast({found} as int)')} as keywords_found, {w(f'cast({total} as int)')} as keywords_total
  from {outputs} o {'join' if how == 'inner' else 'left join'} (select * from {prompts} {pf}) p using (prompt_id))
"""


SUMMARY = """select run_id, coalesce(round(avg(total_score), 6), 0.0) as val_score,
  round(avg(syntax_score), 6) as syntax_score, round(avg(keyword_score), 6) as keyword_score,
  round(avg(structure_score), 6) as structure_score, cast(count(total_score) as int) as num_prompts
from scored group by run_id"""

SCORE_VIEWS = ["v_outputs", "v_prompts"]
ORACLE["score_rows"] = duckdb_with(SCORE_VIEWS) + ", " + scored_sql() + "select * from scored"
ORACLE["score_summary"] = duckdb_with(SCORE_VIEWS) + ", " + scored_sql("left") + SUMMARY
ORACLE["score_rating"] = duckdb_with(SCORE_VIEWS) + ", " + scored_sql() + \
    """select run_id, prompt_id, total_score, case when total_score >= 0.7 then 'PASS'
       when total_score >= 0.4 then 'WARN' else 'FAIL' end as rating from scored"""
ORACLE["score_quick"] = duckdb_with(SCORE_VIEWS) + ", " + scored_sql("left", 3) + SUMMARY
ORACLE["score_compare"] = duckdb_with(SCORE_VIEWS) + ", " + scored_sql("left") + f""",
summ AS ({SUMMARY}),
lng AS (unpivot (select run_id, val_score, syntax_score, keyword_score, structure_score from summ)
        on val_score, syntax_score, keyword_score, structure_score into name metric value v),
a AS (select run_id as run_a, run_id + 1 as run_b, metric, v as a from lng),
b AS (select run_id - 1 as run_a, run_id as run_b, metric, v as b from lng)
select coalesce(a.run_a, b.run_a) as run_a, coalesce(a.run_b, b.run_b) as run_b, coalesce(a.metric, b.metric) as metric,
  coalesce(a.a, 0.0) as a, coalesce(b.b, 0.0) as b, round(coalesce(b.b, 0.0) - coalesce(a.a, 0.0), 6) as delta,
  case when coalesce(b.b, 0.0) - coalesce(a.a, 0.0) > 0 then '+' else '' end as sign
from a full outer join b on a.run_a = b.run_a and a.run_b = b.run_b and a.metric = b.metric"""
ORACLE["eval_report_json"] = duckdb_with(SCORE_VIEWS) + ", " + scored_sql("left") + f""",
summ AS ({SUMMARY}),
outs AS (select run_id, cast(count(distinct prompt_id) as int) as outputs_n from v_outputs group by run_id),
texts AS (select distinct run_id, prompt_id, text from v_outputs)
select 1700000000 + s.run_id as timestamp, s.val_score, s.num_prompts, o.outputs_n, c.prompt_id, c.total_score, c.keywords_found,
  c.brace_balanced, md5(t.text) as output_md5
from summ s join outs o using (run_id) left join (select * from scored where total_score is not null) c using (run_id)
left join texts t on t.run_id = s.run_id and t.prompt_id = c.prompt_id"""
PROMPT_VALUES = "(values " + ", ".join(
    f"({i}, {q(p['id'])}, [{', '.join(q(c) for c in p['checks'])}])" for i, p in enumerate(EVAL_PROMPTS)) + ") fp(ord, prompt_id, checks)"
ORACLE["score_benchmark"] = duckdb_with(["v_outputs"]) + f""", fixed_prompts AS (select * from {PROMPT_VALUES}),
runs AS (select cast(o.run_id as varchar) || '|' || o.prompt_id as run, f.prompt_id, o.text
         from v_outputs o join fixed_prompts f on f.ord = o.run_id % 8),
""" + scored_sql(outputs="runs", prompts="fixed_prompts", run="run") + "select * from scored"

LOG = f"""lg AS (select seq, commit, try_cast(val_score as double) as val_score, try_cast(memory_gb as double) as memory_gb,
  upper({strip('status')}) as status, description from v_log)
"""
LOGW = duckdb_with(["v_log"]) + ", " + LOG
ORACLE["log_normalise"] = LOGW + "select * from lg"
ORACLE["log_kept"] = LOGW + """select idx, seq, val_score, memory_gb, description from
  (select *, row_number() over (order by seq) - 1 as idx from lg) where status = 'KEEP'"""
ORACLE["log_status_counts"] = LOGW + "select status, count(*) as n from lg group by status"
ORACLE["log_keep_rate"] = LOGW + """select n_keep, n_discard, n_crash,
  case when n_keep + n_discard > 0 then n_keep / (n_keep + n_discard) end as keep_rate from
  (select count(*) filter (where status = 'KEEP') as n_keep, count(*) filter (where status = 'DISCARD') as n_discard,
          count(*) filter (where status = 'CRASH') as n_crash from lg)"""
ORACLE["log_running_best"] = LOGW + """, valid AS (select *, row_number() over (order by seq) - 1 as idx from lg where status <> 'CRASH')
select idx, seq, val_score,
  max(val_score) over (order by seq rows between unbounded preceding and current row) as running_best,
  (select val_score from valid order by seq limit 1) as baseline
from valid where status = 'KEEP'"""
HITS = """, kept AS (select *, lag(val_score) over (order by seq) as prev_score, row_number() over (order by seq) as k
              from lg where status = 'KEEP'),
hits AS (select *, val_score - prev_score as delta from kept where k > 1),
ranked AS (select *, row_number() over (order by delta desc nulls last, seq) as rank from hits)
"""
ORACLE["log_hits"] = LOGW + HITS + "select rank, seq, val_score, prev_score, delta, description from ranked"
ORACLE["log_hits_total"] = LOGW + HITS + \
    "select cast(sum(cast(delta as decimal(20,6))) as double) as total_gain, count(*) as n_hits from ranked"
ORACLE["log_summary"] = LOGW + """, s AS (select
   (select val_score from lg order by seq limit 1) as baseline,
   (select max(val_score) from lg where status = 'KEEP') as best,
   (select description from lg where status = 'KEEP' and val_score is not null order by val_score desc, seq limit 1) as best_description,
   (select count(*) from lg) as n_total,
   (select count(*) from lg where status = 'KEEP') as n_kept)
select baseline, best, best_description, n_total, n_kept, round(best - baseline, 6) as gain,
  round((best - baseline) / greatest(baseline, 0.001) * 100, 6) as gain_pct from s"""
ORACLE["log_labels"] = LOGW + f"""select seq, case when length({strip('description')}) > 45
  then left({strip('description')}, 42) || '...' else {strip('description')} end as label
from lg where status <> 'CRASH' and status = 'KEEP'"""

RES = """rs AS (select seq, ts, try_cast(val_score as double) as val_score, try_cast(syntax as double) as syntax,
  try_cast(keyword as double) as keyword, try_cast(structure as double) as structure, status,
  try_cast(elapsed_s as double) as elapsed_s, config from v_results)
"""
RESW = duckdb_with(["v_results"]) + ", " + RES
ORACLE["log_rows_format"] = RESW + """select seq, strftime(ts, '%Y-%m-%d %H:%M') as timestamp,
  printf('%.6f', coalesce(val_score, 0.0)) as val_score, printf('%.6f', coalesce(syntax, 0.0)) as syntax,
  printf('%.6f', coalesce(keyword, 0.0)) as keyword, printf('%.6f', coalesce(structure, 0.0)) as structure,
  coalesce(status, 'unknown') as status, printf('%.0f', coalesce(elapsed_s, 0.0)) as elapsed_s,
  regexp_replace(config, '("(?:[^"\\\\]|\\\\.)*")|[ \t\n\r]+', '\\1', 'g') as config from rs"""
ORACLE["results_sorted_limit"] = RESW + """select seq, val_score, syntax, keyword, structure, status, elapsed_s, config
  from rs order by val_score desc nulls last, seq limit 50"""
ORACLE["results_best"] = RESW + """, c AS (select * from rs where val_score > 0 and json_valid(config)
                                            order by val_score desc, seq limit 1)
select coalesce((select val_score from c), 0.0) as best_val_score, coalesce((select config from c), '{}') as best_config,
  (select seq from c) as best_seq"""
ORACLE["results_status"] = RESW + """select count(*) as num_experiments, coalesce(bool_or(val_score > 0), false) as has_best
  from rs"""
ORACLE["sweep_new_best"] = RESW + """, p AS (select *, max(case when status = 'ok' then val_score end) over
   (order by seq rows between unbounded preceding and 1 preceding) as pr from rs)
select seq, val_score, status, greatest(coalesce(pr, 0.0), 0.0) as best_before,
  status is not null and status = 'ok' and coalesce(val_score > greatest(coalesce(pr, 0.0), 0.0), false) as new_best from p"""
ORACLE["sweep_ranking"] = RESW + """select row_number() over (order by coalesce(val_score, 0.0) desc, seq) as rank, seq, val_score,
  case when length(config) > 40 then left(config, 37) || '...' else config end as config_short from rs"""
ORACLE["sweep_summary"] = RESW + """select count(*) as total_experiments,
  coalesce(max(coalesce(val_score, 0.0)), 0.0) as best_val_score,
  coalesce((select config from rs order by coalesce(val_score, 0.0) desc, seq limit 1), '{}') as best_config from rs"""
D = TRAIN_DEFAULTS
ORACLE["run_metrics_rows"] = RESW + f"""select seq, {q(BASE_MODEL)} as model,
  cast(case when seq % 2 = 0 then seq % 5 * 16 + 16 else {D['LORA_R']} end as int) as lora_r, cast({D['LORA_ALPHA']} as int) as lora_alpha,
  case when seq % 2 = 0 then cast('0.00' || cast(seq % 9 + 1 as varchar) as double) else cast({q(D['LEARNING_RATE'])} as double) end as learning_rate,
  cast({D['BATCH_SIZE']} * {D['GRADIENT_ACCUMULATION']} as int) as batch_size,
  cast(case when seq % 2 = 0 then seq % 3 + 1 else {D['NUM_EPOCHS']} end as int) as epochs, cast({q(D['CLM_MIX_RATIO'])} as double) as clm_mix,
  round(elapsed_s, 1) as training_time_s, val_score, syntax as syntax_score, keyword as keyword_score,
  structure as structure_score, round(elapsed_s * 2, 1) as peak_vram_mb, cast(8 as int) as num_prompts from rs"""
_LINE = ORACLE["log_rows_format"][len(RESW):]
ORACLE["results_log_round_trip"] = RESW + f""", written AS ({_LINE})
select seq, timestamp, cast(val_score as double) as val_score, cast(syntax as double) as syntax, cast(keyword as double) as keyword,
  cast(structure as double) as structure, status, cast(elapsed_s as double) as elapsed_s, config from written"""
ORACLE["experiment_log_read"] = ORACLE["log_normalise"]
# logs that grow by appends: the rows of the whole log as written (missing scores 0, missing status 'unknown')
ORACLE["log_running_best_appended"] = ORACLE["log_running_best"]
ORACLE["log_hits_total_appended"] = ORACLE["log_hits_total"]
WRITTEN = RESW + f""", written AS ({_LINE}),
rw AS (select seq, cast(val_score as double) as val_score, status, config from written)"""
ORACLE["sweep_new_best_appended"] = WRITTEN + ORACLE["sweep_new_best"][len(RESW):].replace("from rs", "from rw")
ORACLE["sweep_status_appended"] = WRITTEN + """, c AS (select * from rw where val_score > 0 and json_valid(config)
                                                        order by val_score desc, seq limit 1)
select count(*) as num_experiments, coalesce(bool_or(val_score > 0), false) as has_best,
  coalesce((select val_score from c), 0.0) as best_val_score, coalesce((select config from c), '{}') as best_config,
  (select seq from c) as best_seq, coalesce(max(val_score), 0.0) as top_val_score,
  coalesce((select config from rw order by val_score desc, seq limit 1), '{}') as top_config from rw"""

RECORD_VIEWS = ["v_scripts", "v_loc", "v_loc_groups", "v_logs", "v_log_files", "v_types", "v_sft", "v_clm"]
DIGEST = "md5(instruction || '|' || completion)"
SFT = duckdb_with(RECORD_VIEWS, recursive=True) + ", " + SCRIPT_PAIRS + "," + loc_pairs_sql() + "," + ENGINE_PAIRS + f""",
recs AS (select 'script|' || source_file || '|' || name || '|' || category || '|' || {DIGEST} as key, system, instruction, completion from script_pairs
         union all select 'loc|' || name || '|' || {DIGEST}, system, instruction, completion from loc_pairs
         union all select 'engine|' || source_file || '|' || name || '|' || {DIGEST}, system, instruction, completion from engine_pairs
         union all select 'chat|' || cast(conv_id as varchar) || '|' || cast(turn as varchar) || '|' || {DIGEST}, system, instruction, completion
         from v_sft),
sft AS (select *, pos < floor(n * 0.95) as is_train from
        (select *, row_number() over (order by {khash('42:shuffle', 'key')}, key) - 1 as pos, count(*) over () as n from recs))
"""
CLM = """clm AS (select *, pos < floor(n * 0.95) as is_train from
        (select doc_id, text, row_number() over (order by """ + khash("42:shuffle", "cast(doc_id as varchar)") + \
    """, cast(doc_id as varchar)) - 1 as pos, count(*) over () as n from v_clm))
"""
ORACLE["sft_split"] = SFT + "select key, pos, case when is_train then 'train' else 'val' end as split from sft"
ORACLE["clm_split"] = duckdb_with(["v_clm"]) + ", " + CLM + \
    "select doc_id, pos, case when is_train then 'train' else 'val' end as split from clm"
MIXW = SFT + "," + CLM + """,
n_mix AS (select least(floor((select count(*) from sft where is_train) * 0.2 / (1 - 0.2)),
                       (select count(*) from clm where is_train))::BIGINT as n),
smp AS (select * from clm where is_train and pos < (select n from n_mix)),
cval AS (select * from clm where not is_train and pos < (select count(*) from clm where is_train) + 100)
"""
ORACLE["mix_sample"] = MIXW + "select doc_id, pos as sample_pos from smp"
COUNTS = """select 'sft' as kind, case when is_train then 'train' else 'val' end as split, count(*) as n
  from sft group by is_train"""
ORACLE["mix_counts"] = MIXW + COUNTS + """ union all select 'clm', 'train', count(*) from smp
  union all select 'clm', 'val', count(*) from cval"""
ORACLE["mix_counts_uncapped"] = MIXW + COUNTS + """ union all select 'clm', 'train', count(*) from smp
  union all select 'clm', 'val', count(*) from clm where not is_train"""
ORACLE["mix_counts_sft_only"] = MIXW + COUNTS
CHAT = ("'<|im_start|>system' || chr(10) || coalesce(system, " + q(SYSTEM_CHAT_DEFAULT) + ") || '<|im_end|>' || chr(10) || "
        "'<|im_start|>user' || chr(10) || instruction || '<|im_end|>' || chr(10) || "
        "'<|im_start|>assistant' || chr(10) || completion || '<|im_end|>'")
ORACLE["train_text"] = MIXW + f"""select case when is_train then 'train' else 'val' end as split, key, {CHAT} as text from sft
  union all select 'train', cast(doc_id as varchar), text from smp
  union all select 'val', cast(doc_id as varchar), text from cval"""
PAIR = "strlen(instruction) + strlen(completion)"
ORACLE["dataset_stats"] = duckdb_with(RECORD_VIEWS, recursive=True) + ", " + RAW + "," + SCRIPT_PAIRS + "," + loc_pairs_sql() + "," + \
    ENGINE_PAIRS + ", sizes AS (" + " union all ".join(
        f"select {q(n)} as dataset, {x} as b from {t}" for n, x, t in [
            ("raw_corpus", "strlen(text)", "raw"), ("structured_blocks", "strlen(code)", "sblocks"), ("instruction_pairs", PAIR, "script_pairs"),
            ("clm_dataset", f"strlen('# File: ' || path || {NL} || '# Category: ' || category || {NL} || {NL} || text)", "raw"),
            ("loc_pairs", PAIR, "loc_pairs"), ("engine_reference", PAIR, "engine_pairs")]) + """)
select dataset, count(*) as records, round(sum(b) / 1048576.0, 1) as mb from sizes group by dataset"""

GRID = duckdb_with(["v_grids"]) + """,
gk AS (select grid_id, key, list(value order by value) as vals from (select distinct grid_id, key, value from v_grids)
       group by grid_id, key),
gs AS (select *, len(vals) as n,
        coalesce(cast(product(len(vals)) over (partition by grid_id order by key rows between 1 following and unbounded following)
                 as bigint), 1) as stride from gk),
gt AS (select grid_id, cast(product(n) as bigint) as total from gs group by grid_id),
combos AS (select gt.grid_id, r.i from gt, range(gt.total) r(i)),
cv AS (select c.grid_id, c.i, gs.key, gs.vals[((c.i // gs.stride) % gs.n) + 1] as value from combos c join gs using (grid_id))
"""
ORACLE["grid_expand"] = GRID + """select grid_id, i + 1 as ordinal,
  '{' || string_agg('"' || key || '":' || value, ',' order by key) || '}' as config from cv group by grid_id, i"""
ORACLE["first_combos"] = ORACLE["grid_expand"].replace("from cv group by", "from cv where i < 3 group by")
ORACLE["grid_estimate"] = GRID + "select grid_id, total, (total * 300) // 60 as est_minutes from gt"
DEFV = "(values " + ", ".join(f"({q(k)}, {q(v)})" for k, v in TRAIN_DEFAULTS.items()) + ") dfl(key, value)"
ORACLE["config_resolve"] = GRID + f""",
known AS (select key from {DEFV}),
ov AS (select grid_id, i, key, value from cv where key in (select key from known) and key <> 'TIME_BUDGET'),
combo_ids AS (select distinct grid_id, i from cv)
select c.grid_id, c.i + 1 as ordinal, dfl.key, dfl.value from combo_ids c, {DEFV}
  where dfl.key <> 'TIME_BUDGET' and not exists (select 1 from ov where ov.grid_id = c.grid_id and ov.i = c.i and ov.key = dfl.key)
union all select grid_id, i + 1, key, value from ov
union all select grid_id, i + 1, 'TIME_BUDGET', '300' from combo_ids"""

# what was written as files and scanned, found in the tables
ORACLE["scripts_scan"] = duckdb_with(["v_scripts"]) + ", " + RAW + """, scanned AS (
  select regexp_extract(path, '^(.*)/', 1) as dir, category, unnest(string_split(text, chr(10))) as line from raw)
select dir, category, count(*) as n_lines, sum(length(line))::bigint as chars,
  sum(('0x' || substr(md5(line), 1, 8))::bigint)::bigint as digest from scanned where line <> '' group by dir, category"""
for _scan, _of in (("blocks_by_lines", "blocks_top"), ("blocks_headers_by_lines", "blocks_headers"), ("engine_entries_scan", "engine_entries"),
                   ("datatype_entries_scan", "datatype_entries"), ("loc_latest_scan", "loc_latest")):
    ORACLE[_scan] = ORACLE[_of]
