"""DuckDB SQL for the queries whose whole result SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def _escaped(x: str) -> str:
    """Length of a role or text as the chat template writes it: backslashes
    doubled, a backslash inside each control string."""
    marks = ["<turn>", "<text>", "</turn>", "<|endoftext|>"]
    extra = " + ".join(f"(length({x}) - length(replace({x}, '{m}', ''))) // {len(m)}" for m in marks)
    return f"(length({x}) + (length({x}) - length(replace({x}, '\\', ''))) + {extra})"


ORACLE["op1_chat_format"] = f"""
WITH turns AS (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\\### Assistant: </turn> ok')
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(19 + {_escaped('role')} + {_escaped('text')}) as bigint) as formatted_chars
from turns group by conv_id"""

# runs of 50 words or more, plainly: every shortest run from or to a line, as text
ORACLE["op5_line_dedup"] = r"""
WITH lines AS (
  select doc_id, pos, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as w
  from (select doc_id, unnest(range(len(arr))) as pos, unnest(arr) as line
        from (select doc_id, string_split(text, chr(10)) as arr from documents where text is not null))),
counted AS (select *, cast(sum(w) over (partition by doc_id order by pos) as bigint) as upto from lines),
runs AS (
  select a.doc_id, a.pos as a, min(b.pos) as b from counted a join counted b
    on b.doc_id = a.doc_id and b.pos >= a.pos and b.upto >= a.upto - a.w + 50 group by a.doc_id, a.pos
  union
  select b.doc_id, max(a.pos) as a, b.pos as b from counted b join counted a
    on a.doc_id = b.doc_id and a.pos <= b.pos and a.upto - a.w <= b.upto - 50 group by b.doc_id, b.pos),
texts AS (
  select r.doc_id, r.a, r.b, md5(string_agg(l.line, chr(10) order by l.pos)) as body
  from runs r join lines l on l.doc_id = r.doc_id and l.pos between r.a and r.b group by r.doc_id, r.a, r.b),
later AS (select *, row_number() over (partition by body, b - a order by doc_id, a) as copy from texts),
gone AS (select distinct l.doc_id, l.pos from lines l join later r on r.doc_id = l.doc_id and l.pos between r.a and r.b and r.copy > 1),
marked AS (select l.*, g.pos is not null as cut, lag(g.pos is not null, 1, false) over (partition by l.doc_id order by l.pos) as cut_before
           from lines l left join gone g on g.doc_id = l.doc_id and g.pos = l.pos)
select d.doc_id, case when d.text is null then null
    else coalesce(string_agg(m.line, chr(10) order by m.pos) filter (where not m.cut), '') end as text,
  count(*) filter (where m.cut) as n_lines_cut, count(*) filter (where m.cut and not m.cut_before) as n_runs_cut
from documents d left join marked m on m.doc_id = d.doc_id group by d.doc_id, d.text"""


def _nibble_table() -> list[int]:
    """CRC-32 of four bits at a time."""
    out = []
    for c in range(16):
        for _ in range(4):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        out.append(c)
    return out


# every n-gram as joined text, checksummed from its hexadecimal digits
ORACLE["op11_importance_resampling"] = rf"""
WITH texts AS (
  select row_number() over () as r, doc_id, text, true as own from documents
  union all select null, null, text, false from benchmark),
words AS (
  select r, doc_id, own, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from texts),
grams AS (
  select r, own, f, count(*) as c from (
    select r, own, array_to_string(w[i:i + k - 1], ' ') as f
    from (select r, own, w, k, unnest(range(1, len(w) - k + 2)) as i from words cross join (values (1), (2), (3)) ks(k)))
  group by r, own, f),
digits AS (select f, hex(encode(f)) as h from (select distinct f from grams)),
sums AS (
  select f, xor(list_reduce(list_prepend(4294967295::bigint,
      list_transform(range(length(h)), lambda j: (instr('0123456789ABCDEF', h[xor(j, 1) + 1]) - 1)::bigint)),
    lambda a, n: xor(a >> 4, ({_nibble_table()}::bigint[])[(xor(a, n) & 15) + 1])), 4294967295::bigint) % 10000 as bucket from digits),
counts AS (select bucket, sum(c) filter (where own) as s, sum(c) filter (where not own) as t from grams join sums using (f) group by bucket),
total AS (select coalesce(sum(s), 0) as big_s, coalesce(sum(t), 0) as big_t from counts),
gain AS (
  select bucket, floor(1000 * ln((coalesce(t, 0)::double + 1) * (big_s::double + 10000)
    / ((coalesce(s, 0)::double + 1) * (big_t::double + 10000))))::bigint as gain from counts, total),
weights AS (select r, sum(c * gain)::bigint as weight, sum(c)::bigint as n from grams join sums using (f) join gain using (bucket) where own group by r),
scored AS (
  select r, doc_id, len(w) as n_words, coalesce(n, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5::double)
      / 4294967296::double)))::bigint as score
  from words left join weights using (r) where own),
ranked AS (select r, row_number() over (order by score desc, doc_id nulls first, n_features) as rank from scored where n_words >= 20)
select doc_id, n_features::bigint as n_features, weight, score::bigint as score,
  case when rank <= (select 5 * count(*) // 100 from ranked) then rank end as rank
from scored left join ranked using (r)"""


def _secret_sql() -> str:
    """Matches and gaps of each rule, added up in order."""
    def either(word: str) -> str:
        return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)

    label = "|".join(either(w) for w in ("password", "passwd", "secret", "token")) + f"|{either('api')}_?{either('key')}"
    before = f"""(?:{label})["'']?\\x20*[:=]\\x20*["'']?"""
    rules = [("assign", f"{before}[A-Za-z0-9+/_.=-]+", f"^{before}[A-Za-z0-9+/_.=-]{{12,}}$"),
             ("access", "AKIA[A-Z0-9]+", "^.{18,}$"), ("hex", "[0-9a-f]+", "^.{16,}$"),
             ("private_key", "-----BEGIN (?:RSA |EC |DSA |OPENSSH |PGP )?PRIVATE KEY(?: BLOCK)?-----", "."),
             ("repository_token", "gh[pousr]_[A-Za-z0-9]{36,}", "."), ("chat_token", "xox[abeoprs]-[A-Za-z0-9-]{10,}", "."),
             ("service_key", "AIza[A-Za-z0-9_-]{35,}", "."),
             ("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}", ".")]
    found = " union all ".join(
        f"select r, {i} as rank, '{kind}' as kind, unnest(regexp_extract_all(text, '{p}')) as hit, "
        f"unnest(string_split_regex(text, '{p}')[:-2]) as gap, '{keep}' as keep, "
        f"unnest(range(len(regexp_extract_all(text, '{p}')))) as i from texts where regexp_matches(text, '{p}')"
        for i, (kind, p, keep) in enumerate(rules))
    return f"""
WITH texts AS (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
found AS ({found}),
placed AS (
  select r, rank, kind, hit, keep, sum(length(gap) + length(hit)) over (partition by r, rank order by i) as stop from found),
spans AS (
  select r, rank, kind, stop - length(hit) as start, kind || ':' || (stop - length(hit))::bigint || ':' || stop::bigint as span
  from placed where case when keep = '.' then true when kind = 'assign' then regexp_matches(hit, keep)
    else length(hit) >= case kind when 'access' then 18 else 16 end end)
select doc_id, count(*) filter (where kind = 'assign') as n_assign, count(*) filter (where kind = 'access') as n_access,
  count(*) filter (where kind = 'hex') as n_hex,
  sha256(coalesce(string_agg(span, ',' order by start, rank) filter (where rank < 3), '')) as base_sha256,
  coalesce(string_agg(span, ',' order by start, rank), '') as spans
from texts left join spans using (r) group by r, doc_id"""


ORACLE["op13_secret_ledger"] = _secret_sql()
