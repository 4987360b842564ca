"""DuckDB SQL for the training-data queries that SQL can express.

Not here: op1 (banded alignment), op2 and op5 (trained models), op7
(transitive links), op10 (markup); the tests hold those against brute force or
held-out labels.
"""

from __future__ import annotations

from citylens.llm import op11_fim, op12_merkle, op13_suffixes, op3_mixing, op6_urls, op8_secrets

_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_EXACT = """
select doc_id, max(doc_id) over (partition by coalesce(text, '')) as keep_id,
  count(*) over (partition by coalesce(text, '')) as group_size,
  row_number() over (partition by coalesce(text, '') order by doc_id desc nulls last) = 1 as kept,
  sha256(coalesce(text, '')) as text_sha256
from documents"""

_CONTAMINATION = rf"""
with d as (select row_number() over () as r, doc_id, {_WORDS} as w from documents),
i as (select coalesce(cast(item_id as varchar), '') as item, {_WORDS} as w from benchmark where text is not null),
g as (select distinct item, n, array_to_string(w[k:k + n - 1], ' ') as g
  from (select item, w, least(10, len(w)) as n, unnest(range(1, len(w) - least(10, len(w)) + 2)) as k from i where len(w) > 0)),
dw as (select r, n, k, array_to_string(w[k:k + n - 1], ' ') as g
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as k from d cross join (select distinct n from g) where len(w) >= n)),
hit as (select r, k, n, item from dw join g using (n, g)),
pos as (select r, count(distinct p) as n_hit from (select r, unnest(range(k, k + n)) as p from hit) group by r),
its as (select r, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as ids from hit group by r)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join pos using (r) left join its using (r)"""

_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in op6_urls.RULES)
_LISTED = ", ".join(f"'{x}'" for x in op6_urls.LISTED_LABELS)
_URLS = rf"""
with u as (select page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
  regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) as path from pages),
rules(rhost, rpath, v) as (values {_RULES}),
best as (select host, path, max(struct_pack(n := length(rhost || rpath), h := length(rhost), v := v, rule := rhost || rpath)) as b
  from (select distinct host, path from u) join rules
  on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath) group by host, path),
listed as (select distinct host, path from u where list_has_any(string_split(host, '.'), [{_LISTED}]))
select page_id, u.host, u.path, b.rule as rule,
  coalesce(b.v, case when l.host is not null then 'block' else 'allow' end) as verdict
from u left join best using (host, path) left join listed l on l.host = u.host and l.path = u.path"""


def _map(weights: dict[str, int]) -> str:
    return "case path " + " ".join(f"when '{k}' then {v}" for k, v in weights.items()) + " else 1 end"


def _level(number: int, source: str, path: str, parent: str, budget: str) -> str:
    """One level of the budget tree: nodes, their common level, their shares."""
    return f"""
n{number} as (select {parent} as up, {path} as path, sum(supply) as supply from leaf group by all),
w{number} as (select *, {_map(op3_mixing.WEIGHTS)} as weight from n{number}),
f{number} as (select w.*, {budget} as budget,
    ({budget} - coalesce(sum(supply) over (partition by w.up order by supply / weight, w.path rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (partition by w.up order by supply / weight, w.path rows between current row and unbounded following) as level
  from w{number} w {source}),
s{number} as (select path, greatest(0, least(supply, cast(floor(max(level) over (partition by up) * weight) as bigint))) as share from f{number})"""


_MIXING = rf"""
with d as (select doc_id, coalesce(lang, '(none)') as lang, coalesce(source, '(none)') as source, coalesce(
    'd' || cast(try_cast(nullif(regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1), '') as bigint) % 4 as varchar), 'd-other') as domain,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as n_tokens from documents),
t as (select * from d where n_tokens > 0),
total as (select sum(n_tokens) as budget from t),
leaf as (select domain, lang, source, sum(n_tokens) as tokens, sum(n_tokens) * {op3_mixing.MAX_EPOCHS} as supply from t group by all),
{_level(1, "cross join total", "domain", "''", "total.budget").strip()},
{_level(2, "join s1 on s1.path = w.up", "domain || '/' || lang", "domain", "s1.share").strip()},
{_level(3, "join s2 on s2.path = w.up", "domain || '/' || lang || '/' || source", "domain || '/' || lang", "s2.share").strip()},
plan as (select domain, lang, source, cast(share // tokens as bigint) as full_epochs, cast(share % tokens as bigint) as rest
  from leaf join s3 on s3.path = domain || '/' || lang || '/' || source),
p as (select t.*, full_epochs, rest, md5('{op3_mixing.SEED}:' || domain || '/' || lang || '/' || source || ':' || full_epochs || ':' ||
    coalesce(cast(doc_id as varchar), '')) as h from t join plan using (domain, lang, source)),
c as (select *, rest - coalesce(sum(n_tokens) over (partition by domain, lang, source order by h, doc_id, n_tokens
    rows between unbounded preceding and 1 preceding), 0) as left_over from p)
select doc_id, domain, lang, source, epoch, n_tokens, n_tokens as take_tokens
from (select *, unnest(range(0, full_epochs)) as epoch from p)
union all
select doc_id, domain, lang, source, full_epochs as epoch, n_tokens, cast(least(n_tokens, left_over) as bigint) as take_tokens
from c where left_over > 0"""


def _spans_of(kind: str, pattern: str, group: int = 0, least: int = 0) -> str:
    """Spans of one kind: the pieces before a match and the matches before it add up to its start."""
    p = "'" + pattern.replace("'", "''") + "'"
    size = "list_sum(list_transform({}, lambda x: length(x)))"
    return f"""select r, {op8_secrets.KINDS.index(kind)} as k,
    cast({size.format("p[1:i]")} + coalesce({size.format("m[1:i - 1]")}, 0) as bigint) as s, length(m[i]) as n, length(g[i]) as gn
  from (select *, unnest(range(1, len(m) + 1)) as i from (select r, regexp_extract_all(t, {p}) as m,
    regexp_extract_all(t, {p}, {group}) as g, string_split_regex(t, {p}) as p from d)) where length(g[i]) >= {least}"""


_WRITTEN = "string_agg(name || ':' || s || ':' || (s + n), ',' order by s, k, n)"
_SECRETS = f"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
base as ({_spans_of("assign", op8_secrets.ASSIGN, 2, op8_secrets.ASSIGN_VALUE)}
  union all {_spans_of("access", op8_secrets.ACCESS, 0, op8_secrets.ACCESS_LENGTH)}
  union all {_spans_of("hex", op8_secrets.HEX)}),
weak as ({_spans_of("login", op8_secrets.LOGIN)}
  union all (select w.* from ({_spans_of("weak", op8_secrets.WEAK)}) w
    where not exists (select 1 from base b where b.r = w.r and b.k = 0 and b.s = w.s))
  union all {_spans_of("endpoint", op8_secrets.ENDPOINT)}),
part as (select *, case when k in (1, 3) then 'id' when k = 5 then 'endpoint' else 'secret' end as role
  from (select * from base where k <= 1 union all select * from weak)),
told as (select w.r, w.k, w.s, w.n, w.role, bool_or(o.role = 'id') as with_id, bool_or(o.role = 'secret') as with_secret
  from part w join part o on o.r = w.r and abs(o.s - w.s) <= {op8_secrets.SCOPE} where w.k >= 3 group by all),
added as (select r, k, s, n from told where (role = 'secret' and with_id) or (role = 'id' and with_secret)
  or (role = 'endpoint' and with_id and with_secret)),
kinds(k, name) as (values {", ".join(f"({i}, '{k}')" for i, k in enumerate(op8_secrets.KINDS))}),
b as (select r, count(*) filter (k = 0) as n_assign, count(*) filter (k = 1) as n_access, count(*) filter (k = 2) as n_hex,
  {_WRITTEN} as written from base join kinds using (k) group by r),
a as (select r, {_WRITTEN} as written from (select r, k, s, n from base union all from added) join kinds using (k) group by r)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(b.written, '')) as base_sha256, coalesce(a.written, '') as spans
from d left join b using (r) left join a using (r)"""

_P, _S, _M = op11_fim.PREFIX, op11_fim.SUFFIX, op11_fim.MIDDLE
_FIM = f"""
with d as (select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
v as (select *, {", ".join(f"cast('0x' || substr(h, {8 * i + 1}, 8) as bigint) as h{i + 1}" for i in range(4))} from d),
c as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
  case when n = 0 or contains(t, '{_P}') or contains(t, '{_S}') or contains(t, '{_M}') or h3 % 100 >= {op11_fim.PLAIN_FROM} then 'plain'
    when h4 % 100 < {op11_fim.SPM_BELOW} then 'spm' else 'psm' end as form from v),
o as (select *, '{_P}' || substr(t, 1, a) as p, '{_M}' || substr(t, a + 1, b - a) as m, '{_S}' || substr(t, b + 1) as s from c)
select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
  sha256(case form when 'psm' then p || s || m when 'spm' then s || p || m else t end) as output_sha256, sha256(t) as restored_sha256
from o"""


def _value(column: str) -> str:
    return f"case when {column} is null then '-' else strlen(cast({column} as varchar)) || ':' || cast({column} as varchar) end"


def _climbed(name: str, levels: int) -> str:
    """Levels of the trees ``<name>0(tree, p, h, n)``, and ``<name>s<k>``: what stands beside a node in its run."""
    run = f"over (partition by tree, p // {op12_merkle.FAN} order by p rows between"
    out = []
    for k in range(levels):
        out.append(f"""{name}s{k} as (select *, coalesce(string_agg(h, '') {run} unbounded preceding and 1 preceding), '') as l,
    coalesce(string_agg(h, '') {run} 1 following and unbounded following), '') as r from {name}{k})""")
        out.append(f"""{name}{k + 1} as (select tree, p // {op12_merkle.FAN} as p,
    case when any_value(n) = 1 then any_value(h) else sha256(string_agg(h, '' order by p)) end as h, (any_value(n) + 7) // {op12_merkle.FAN} as n
  from {name}{k} group by all)""".replace("group by all", f"group by tree, p // {op12_merkle.FAN}"))
    return ",\n".join(out)


def _folded(first: str, name: str, levels: int, tree: str, place: str) -> str:
    """Proof and folded digest of every row of ``first``, level by level."""
    out = []
    for k in range(levels):
        out.append(f"""{first}{k + 1} as (select f.* exclude (proof, folded), proof || l || r as proof,
    case when n = 1 then folded else sha256(l || folded || r) end as folded
  from {first}{k} f join {name}s{k} s on s.tree = f.{tree} and s.p = f.{place} // {op12_merkle.FAN ** k})""")
    return ",\n".join(out)


_CRC = """xor(list_reduce([4294967295] || flatten(list_transform(string_split(cast(doc_id as varchar), ''),
    lambda c: [cast(ascii(c) as bigint), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, x: case when x >= 0 then xor(a, x) else xor(a >> 1, 3988292384 * (a & 1)) end), 4294967295)"""
_VALUES = [_value(c) for c in op12_merkle.LEAF_COLUMNS]
_LOWER = _value(f"translate(text, '{op12_merkle.UPPER}', '{op12_merkle.LOWER}')")
_DEEP, _WIDE = 8, 4                                # 8 ** 8 rows a group, 8 ** 4 groups
_MERKLE = f"""
with d as (select doc_id, case when lang is null then '0' else '1' || lang end as tree, sha256({" || ".join(_VALUES)}) as leaf,
  sha256({" || ".join(_VALUES[:-1])} || {_LOWER}) as lowered, doc_id is not null and {_CRC} % 3 = 0 as hit from documents),
f0 as (select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as p, '' as proof,
  case when hit then lowered else leaf end as folded from d),
a0 as (select tree, p, leaf as h, count(*) over (partition by tree) as n from f0),
{_climbed("a", _DEEP)},
{_folded("f", "a", _DEEP, "tree", "p")},
g as (select tree as of, h as subroot, row_number() over (order by tree) - 1 as place from a{_DEEP}),
b0 as (select '' as tree, place as p, subroot as h, count(*) over () as n from g),
{_climbed("b", _WIDE)},
e0 as (select f.*, '' as top, g.place, g.subroot from f{_DEEP} f join g on g.of = f.tree),
{_folded("e", "b", _WIDE, "top", "place")}
select doc_id, leaf, subroot, b.h as root, sha256(proof) as proof_sha256, folded as folded_root, folded = b.h as verified
from e{_WIDE}, (select h from b{_WIDE}) b"""

_L = op13_suffixes.LENGTH
_SUFFIXES = f"""
with d as (select row_number() over () as r, doc_id, coalesce(doc_id, 9223372036854775807) as o, encode(coalesce(text, '')) as b from documents),
c as (select r, o, first, array_slice(b, first + 1, first + {256 + _L - 1}) as c from (select r, o, b, unnest(range(0, octet_length(b), 256)) as first from d)),
w as (select r, o, first + p as p, array_slice(c, p, p + {_L - 1}) as s
  from (select r, o, first, c, unnest(range(1, octet_length(c) - {_L - 2})) as p from c)),
hit as (select r, p from w join (select s, min(o) as least from w group by s) using (s) where o > least),
new as (select r, p, case when p <= lag(p) over (partition by r order by p) + {_L} then 0 else 1 end as starts from hit),
span as (select r, min(p) as a, max(p) + {_L} as e from (select r, p, sum(starts) over (partition by r order by p) as k from new) group by r, k),
piece as (select r, coalesce(lag(e) over (partition by r order by a), 1) as a, a - 1 as e from span
  union all select r, max(e), 2147483647 from span group by r),
kept as (select r, unhex(string_agg(hex(array_slice(b, a, e)), '' order by a)) as b from piece join d using (r) where e >= a group by r),
told as (select r, sum(e - a) as n_removed, count(*) as n_spans from span group by r)
select doc_id, octet_length(d.b) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(case when n_spans is null then d.b else coalesce(kept.b, ''::blob) end) as kept_sha256
from d left join told using (r) left join kept using (r)"""

ORACLES: dict[str, str] = {
    "op3_mixing": _MIXING,
    "op4_exact_dedup": _EXACT,
    "op6_urls": _URLS,
    "op8_secrets": _SECRETS,
    "op9_decontaminate": _CONTAMINATION,
    "op11_fim": _FIM,
    "op12_merkle": _MERKLE,
    "op13_suffixes": _SUFFIXES,
}
