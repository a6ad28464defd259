"""Script-shaped input views rendered from the driver's tables.

The test tables hold prose, not game scripts, so scripts, localization files,
logs, outputs and experiment logs are *rendered* from them.  Each recipe is
written once and filled per engine (Spark SQL or DuckDB), which keeps the two
sides of the correctness check on identical inputs.  Every view reads whole
tables and whole texts; sizes grow with the scale factor.  Grouped views (one
text per order, one log file per 256 documents of a source) have bounded groups.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

ENGINES = {
    "spark": {"S": "string", "DIV": "div", "NL": "char(10)", "TAB": "char(9)", "BY_ORDER": " distribute by l_orderkey"},
    "duckdb": {"S": "varchar", "DIV": "//", "NL": "chr(10)", "TAB": "chr(9)", "BY_ORDER": ""},
}


def _join(engine: str, k: str, x: str) -> str:
    if engine == "spark":
        return f"array_join(transform(array_sort(collect_list(struct({k}, {x}))), y -> y.{x}), '')"
    return f"string_agg({x}, '' order by {k}, {x})"


def _min_by(engine: str, v: str, k: str) -> str:
    return f"min_by({v}, {k})" if engine == "spark" else f"arg_min({v}, {k})"


RECIPES: dict[str, str] = {}

RECIPES["v_scripts"] = """
select case o_orderkey % 6 when 0 then 'events/o_' when 1 then 'common/decisions/o_'
         when 2 then 'common/traits/o_' when 3 then 'common/scripted_effects/o_'
         when 4 then 'misc/o_' else 'tools/o_' end || cast(o_orderkey as {S}) || '.txt' as path,
  '# order ' || cast(o_orderkey as {S}) || {NL}
  || case when o_orderkey % 11 = 0 then 'scope:' else '' end || 'order_' || cast(o_orderkey as {S}) || ' = {' || {NL}
  || {TAB} || 'status = "' || o_orderstatus || '" # note "x" {' || {NL}
  || case when o_orderkey % 5 = 0 then {TAB} || 'note = "no # 1"' || {NL} else '' end
  || coalesce(items, '')
  || case when o_orderkey % 13 = 0 then {TAB} || 'if = {' || {NL} || {TAB} || '} else = {' || {NL} || {TAB} || '}' || {NL} else '' end
  || case when o_orderkey % 7 = 0 then '' else '}' || {NL} end
  || 'name_' || cast(o_orderkey as {S}) || ' = { status = ' || o_orderstatus || ' }' as text
from {orders} left join (
  select l_orderkey, {JOIN(l_linenumber,item)} as items from (
    select l_orderkey, l_linenumber, {TAB} || 'line_' || cast(l_linenumber as {S}) || case when l_linenumber % 3 = 0
      then ' = { qty = ' || cast(cast(l_quantity as int) as {S}) || ' }' || {NL}
      else ' = {' || {NL} || {TAB} || {TAB} || 'qty = ' || cast(cast(l_quantity as int) as {S}) || {NL} || {TAB} || '}' || {NL}
      end as item from {lineitem}{BY_ORDER}) t group by l_orderkey) i on l_orderkey = o_orderkey
"""

RECIPES["v_loc"] = """
select path, ln, line from (
 select 'a.yml' as path, p_partkey * 2 as ln, '  ' || case when p_partkey % 9 = 0 then 'order.' else 'order_' end
   || cast(p_partkey as {S}) || case p_partkey % 4 when 0 then '' when 1 then '_desc' when 2 then '_tooltip' else '_title' end
   || ':0 "' || case when p_partkey % 8 = 0 then '[x.GetName]' when p_partkey % 5 = 0 then '#P ' || p_name || '#! [a.B]' else p_name end
   || '"' || case when p_partkey % 6 = 0 then ' # "old"' else '' end as line from {part}
 union all select 'a.yml', p_partkey * 2 + 1, ' order_' || cast(p_partkey as {S}) || '_desc: "second ' || p_brand || '" ' from {part} where p_partkey % 8 = 0
 union all select 'b.yml', p_partkey, 'order_' || cast(p_partkey as {S}) || '_title:1 "late ' || p_type || '"' from {part} where p_partkey % 10 = 3
 union all select 'b.yml', -1, 'l_english:' from {part} where p_partkey = 0) t
"""

# Localization lines for key groups: groups of 7 (kept) and one prefix with
# a key per part (dropped for being over 20), on top of v_loc.
RECIPES["v_loc_groups"] = """
select path, ln, line from {v_loc}
union all select 'c.yml', p_partkey, 'part_' || cast(p_partkey {DIV} 7 as {S}) || '_' || cast(p_partkey % 7 as {S})
  || ':0 "' || p_name || '"' from {part}
union all select 'd.yml', p_partkey, ' one_' || cast(p_partkey as {S}) || ': "' || p_brand || '"' from {part}
"""

RECIPES["v_logs"] = """
select file, {JOIN(doc_id,chunk)} as text from (
 select source || '_' || cast(doc_id {DIV} 256 as {S}) || '.log' as file, doc_id,
   'e' || cast(doc_id as {S}) || case when doc_id % 3 = 0 then ' - ' else ': ' end
   || text || {NL} || case when doc_id % 4 = 0 then ' ----' else '--------------------' end || {NL}
   || case when doc_id % 17 = 0 then 'x' || cast(doc_id % 10 as {S}) || {NL} || '-----' || {NL} else '' end as chunk from {documents}) t
group by file
"""

# Log categories by source number (src<n> -> n % 7), as a file table.
RECIPES["v_log_files"] = """
select file, case cast(substr(file, 4, instr(file, '_') - 4) as int) % 7
  when 0 then 'effect_reference' when 1 then 'trigger_reference' when 2 then 'on_action_reference'
  when 3 then 'modifier_reference' when 4 then 'scope_reference' when 5 then 'event_target_reference'
  else 'custom_loc_reference' end as category
from (select distinct file from {v_logs}) f
"""

RECIPES["v_types"] = """
select replace(file, '.log', '.txt') as file, text from {v_logs}
"""

RECIPES["v_outputs"] = """
select page_id {DIV} 8 as run_id, 'p' || cast(page_id % 8 as {S}) as prompt_id,
  case when page_id % 5 = 0 then 'import ' || html
       when page_id % 3 = 0 then replace(html, 'margin:0}', 'margin:0')
       else replace(html, 'p{', 'trigger = {') end as text from {pages}
union all select page_id {DIV} 8, 'e' || cast(page_id % 8 as {S}), '' from {pages} where page_id % 7 = 0
"""

RECIPES["v_prompts"] = """
select ord, prompt_id, {SPLIT_BAR(checks)} as checks from (values
  (0, 'p0', 'title|nav|zzz'), (1, 'p1', 'trigger|='), (2, 'p2', 'ad|script|track|qq'), (3, 'p3', 'x_y'),
  (4, 'p4', 'html'), (5, 'p5', 'import|class|nav'), (6, 'p6', '{|}|='), (7, 'e0', 'a|b'), (8, 'e3', '=')) t(ord, prompt_id, checks)
"""

# Scores are fixed-point text built from integer micro-units (exact in both
# engines; a double-to-decimal cast rounds differently in each).
RECIPES["v_log"] = """
select event_id as seq, substr(md5(cast(event_id as {S})), 1, 7) as commit, ts,
  case event_type when 'purchase' then 'keep' when 'error' then ' CRASH '
    when 'view' then 'Keep ' else 'discard' end as status,
  case when event_id % 97 = 0 then 'n/a' else {FIX6(cast(round(value * 100) as bigint) * 20)} end as val_score,
  case when event_id % 89 = 0 then '' else {FIX2(cast(round(value * 100) as bigint))} end as memory_gb,
  'run ' || cast(user_id as {S}) || ' ' || event_type || ' with props ' || props as description from {events}
"""

RECIPES["v_results"] = """
select event_id as seq, ts,
  case when event_id % 97 = 0 then 'n/a' else {FIX6(cast(round(value * 100) as bigint) * 20)} end as val_score,
  {FIX6(cast(round(value * 100) as bigint) * 40)} as syntax,
  {FIX6(cast(round(value * 100) as bigint) * 50)} as keyword,
  case when event_id % 31 = 0 then null else {FIX6(cast(round(value * 100) as bigint) * 10)} end as structure,
  case when event_type = 'error' then 'error' when event_id % 53 = 0 then null else 'ok' end as status,
  cast(user_id as {S}) as elapsed_s,
  case when event_id % 41 = 0 then 'not json' else props end as config from {events}
"""

RECIPES["v_sft"] = """
select conv_id, turn, system, text as instruction, next_text as completion from (
  select conv_id, turn, role, text, lead(turn) over w as next_turn, lead(role) over w as next_role, lead(text) over w as next_text,
    {MIN_BY(text,case when role = 'system' then turn end)} over (partition by conv_id) as system
  from {conversations} window w as (partition by conv_id order by turn)) t
where role = 'user' and next_role = 'assistant' and next_turn = turn + 1
"""

RECIPES["v_clm"] = """
select doc_id, text from {documents}
"""

# Grids from the event log: one grid per user; its keys are hyperparameter
# names picked by event type, its values the distinct (k div 50) of that type.
RECIPES["v_grids"] = """
select user_id as grid_id, case event_type when 'click' then 'LEARNING_RATE' when 'purchase' then 'NUM_EPOCHS'
    when 'view' then 'LORA_DROPOUT' when 'signup' then 'CLM_MIX_RATIO' else 'ERROR_RATE' end as key,
  cast(cast(substr(props, 7, length(props) - 7) as int) {DIV} 50 as {S}) as value
from {events}
"""

ORDER = ["v_scripts", "v_loc", "v_loc_groups", "v_logs", "v_log_files", "v_types", "v_outputs", "v_prompts",
         "v_log", "v_results", "v_sft", "v_clm", "v_grids"]


def render(name: str, engine: str, table_ref=lambda t: t) -> str:
    sql = RECIPES[name]
    for k, v in ENGINES[engine].items():
        sql = sql.replace("{" + k + "}", v)
    while "{JOIN(" in sql:
        i = sql.index("{JOIN(")
        j = sql.index(")}", i)
        k, x = sql[i + 6:j].split(",")
        sql = sql[:i] + _join(engine, k.strip(), x.strip()) + sql[j + 2:]
    for macro, scale in (("{FIX6(", 1000000), ("{FIX2(", 100)):
        while macro in sql:
            i = sql.index(macro)
            j = sql.index(")}", i)
            x = sql[i + len(macro):j]
            digits = len(str(scale)) - 1
            text = (f"cast(({x}) {ENGINES[engine]['DIV']} {scale} as {ENGINES[engine]['S']}) || '.' || "
                    f"lpad(cast(({x}) % {scale} as {ENGINES[engine]['S']}), {digits}, '0')")
            sql = sql[:i] + text + sql[j + 2:]
    sql = sql.replace("{SPLIT_BAR(checks)}", "split(checks, '[|]')" if engine == "spark"
                      else "string_split(checks, '|')")
    while "{MIN_BY(" in sql:
        i = sql.index("{MIN_BY(")
        j = sql.index(")}", i)
        v, k = sql[i + 8:j].split(",")
        sql = sql[:i] + _min_by(engine, v.strip(), k.strip()) + sql[j + 2:]
    for t in TABLES + ORDER:
        if "{" + t + "}" in sql:
            sql = sql.replace("{" + t + "}", table_ref(t))
    return sql


def duckdb_with(names: list[str], recursive: bool = False) -> str:
    """A ``WITH`` prefix defining the named views (and those they use) for DuckDB."""
    need = _closure(names)
    parts = [f"{n} AS ({render(n, 'duckdb')})" for n in ORDER if n in need]
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n"


def _closure(names: list[str]) -> set[str]:
    need = set(names)
    changed = True
    while changed:
        changed = False
        for n in list(need):
            for m in ORDER:
                if m not in need and "{" + m + "}" in RECIPES[n]:
                    need.add(m)
                    changed = True
    return need


class Views:
    """Spark side: the driver's tables and the rendered views of one directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.tag = hashlib.md5(self.sf_dir.encode()).hexdigest()[:8]
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        key = "t_" + name
        if key not in self._cache:
            df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            df.createOrReplaceTempView(f"sm_{self.tag}_{name}")
            self._cache[key] = df
        return self._cache[key]

    def view(self, name: str) -> DataFrame:
        if name not in self._cache:
            df = self.spark.sql(render(name, "spark", self._ref))
            df.createOrReplaceTempView(f"sm_{self.tag}_{name}")
            self._cache[name] = df
        return self._cache[name]

    def _ref(self, t: str) -> str:
        if t in RECIPES:
            self.view(t)
        else:
            self.table(t)
        return f"sm_{self.tag}_{t}"
