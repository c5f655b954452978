"""SQL (DuckDB) that gives the rows of the registered queries on the same tables."""

from __future__ import annotations

#: Words of every whole text with A-Z lower-cased; a null text has none.
_WORDS = r"""words as (select doc_id, text, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from {source})"""


def near_duplicate_ctes(size: int, percent: int, source: str = "documents") -> str:
    """Ctes ``sizes`` (doc_id, n) and ``named`` (doc_id, component_id of linked documents)."""
    return f"""{_WORDS.format(source=source)},
shingled as (select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < {size} then [array_to_string(w, ' ')]
  else list_transform(range(1, len(w) - {size - 2}), lambda i: array_to_string(w[i:i + {size - 1}], ' ')) end) as g from words),
sizes as (select words.doc_id, count(g) as n from words left join shingled using (doc_id) group by 1),
met as (select a.doc_id as a, b.doc_id as b, count(*) as m from shingled a join shingled b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
linked as (select a, b from met join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * m >= {percent} * (x.n + y.n - m)),
reach(a, b) as (select a, b from linked union select reach.a, linked.b from reach join linked on reach.b = linked.a),
named as (select a as doc_id, least(a, min(b)) as component_id from reach group by 1)"""


def containment_ctes(size: int, percent: int, source: str = "documents") -> str:
    """Cte ``leaks`` (doc_id, item_id, n_shingles, n_found)."""
    words = r"""regexp_extract_all(regexp_replace(lower(coalesce(text, '')), '[!-/:-@\[-`{-~]', ' ', 'g'), '[^\x20\x09-\x0D]+')"""
    return f"""dw as (select doc_id, {words} as w from {source}), iw as (select distinct item_id, text, {words} as w from benchmark where text is not null),
ilen as (select item_id, text, w, least(len(w), {size}) as n from iw where len(w) > 0),
ish as (select distinct item_id, text, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) as g from ilen),
dsh as (select distinct doc_id, n, unnest(list_transform(range(1, greatest(len(w) - n + 2, 1)), lambda i: array_to_string(w[i:i + n - 1], ' '))) as g
  from dw, (select distinct n from ilen)),
leaks as (select doc_id, item_id, any_value(total) as n_shingles, count(*) as n_found from dsh
  join (select *, count(*) over (partition by item_id, text) as total from ish) x using (n, g)
  group by doc_id, item_id, text having 100 * count(*) >= {percent} * any_value(total))"""


_FILL_IN_MIDDLE = """with d as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as t,
  sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents),
e as (select *, len(t) as n, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2, ('0x' || h[17:24])::bigint as h3,
  ('0x' || h[25:32])::bigint as h4 from d),
f as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
  case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain'
    when h4 % 100 < 20 then 'spm' else 'psm' end as form from e),
g as (select *, array_to_string(t[1:a], '') as p, array_to_string(t[a + 1:b], '') as m, array_to_string(t[b + 1:n], '') as s from f)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars, case when form <> 'plain' then length(m) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end)
    as output_sha256, sha256(text) as restored_sha256 from g"""


def clustering_sql(k: int = 40, rounds: int = 5, dimensions: int = 64) -> str:
    """k-means in whole numbers, one pair of ctes (nearest, centroids) per round."""
    ctes = [f"""kept as materialized (select row_number() over () as r, vec_id, embedding as e from embeddings
  where len(embedding) = {dimensions} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {dimensions}),
v as materialized (select r, i, floor(256 * e[i]::double)::bigint as x from kept, range(1, {dimensions + 1}) t(i)),
c0 as materialized (select n, i, x from v join (select r, row_number() over (order by sha256('2:' || coalesce(vec_id::varchar, ''))) - 1 as n from kept)
  using (r) where n < {k})"""]
    for t in range(rounds + 1):
        ctes.append(f"""a{t} as materialized (select r, min(d * {k} + n) as best from (select r, n, sum((v.x - c.x) * (v.x - c.x))::bigint as d
  from v join c{t} c using (i) group by r, n) group by r)""")
        if t < rounds:
            ctes.append(f"""c{t + 1} as materialized (select n, i, coalesce(m, c.x) as x from c{t} c left join (select best % {k} as n, i,
  floor(sum(x)::double / count(*))::bigint as m from a{t} join v using (r) group by 1, 2) using (n, i))""")
    return f"""with {", ".join(ctes)},
digests as (select n, sha256(string_agg(x::varchar, ',' order by i)) as centroid_sha256 from c{rounds} group by n),
done as (select vec_id, (best % {k})::int as cluster, best // {k} as distance from a{rounds} join kept using (r))
select vec_id, cluster, distance, (sum(distance) over (partition by cluster))::bigint as cluster_inertia, (sum(distance) over ())::bigint as inertia,
  centroid_sha256 from done join digests on n = cluster"""


ORACLES = {
    "op5_jaccard_join": f"""with recursive {near_duplicate_ctes(4, 85)}
select sizes.doc_id, n as n_shingles, coalesce(component_id, sizes.doc_id) as component_id from sizes left join named using (doc_id)""",
    "op12_fill_in_middle": _FILL_IN_MIDDLE,
    "op13_centroid_clustering": clustering_sql(),
    "op7_decontamination": f"with {containment_ctes(5, 80)} select * from leaks",
}
