"""DuckDB SQL of the registered queries that SQL can express."""

from itertools import permutations

_DIGIT = "('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')"



def _kmeans(rounds: int = 3, clusters: int = 16) -> str:
    """Rounds of assignment and exact floors of the means, one after the other."""
    steps = [f"""
        k as (select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v from embeddings
              where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0),
        c0 as (select row_number() over (order by h, v) - 1 as c, v as centre from (
               select sha256('1:' || coalesce(vec_id::varchar, '')) as h, v from k order by h, v limit {clusters}))"""]
    for r in range(rounds + 1):
        steps.append(f"""
        a{r} as (select row_n, any_value(vec_id) as vec_id, min(struct_pack(d, c)) as best, any_value(v) as v from (
                 select row_n, vec_id, v, c, list_sum(list_transform(list_zip(v, centre),
                        lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
                 from (select row_number() over () as row_n, * from k), c{r}) group by row_n)""")
        if r < rounds:
            steps.append(f"""
        c{r + 1} as (select c, coalesce(w, centre) as centre from c{r} left join (
               select c, list(((s - ((s % n + n) % n)) // n)::bigint order by i) as w from (
               select best.c as c, i, sum(v[i])::bigint as s, count(*)::bigint as n from a{r}, range(1, 65) t(i)
               group by best.c, i) group by c) using (c))""")
    last = f"a{rounds}"
    return "with" + ",".join(steps) + f"""
        select vec_id, best.c::integer as cluster, best.d as distance,
               (sum(best.d) over (partition by best.c))::bigint as cluster_inertia,
               (sum(best.d) over ())::bigint as inertia,
               sha256(list_aggregate(list_transform(centre, lambda x: x::varchar), 'string_agg', ',')) as centroid_sha256
        from {last} join c{rounds} on c = best.c"""


def _audit(filters: str = "ABCDE") -> str:
    """Every document against every order and step."""
    orders = ", ".join(f"('{''.join(o)}')" for o in permutations(filters))
    return f"""
        with t as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t from documents),
        w as (select *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws,
                     min(doc_id) over (partition by t) as least from t),
        f as (select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
                     case when len(ws) < 200 then 1 else 0 end
                     + case when 100 * len(list_distinct(ws)) < 50 * len(ws) then 2 else 0 end
                     + case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) then 4 else 0 end
                     + case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end
                     + case when coalesce(doc_id > least, false) then 16 else 0 end as fails
              from w left join (select doc_id, bool_or(coalesce(quality = 1, false)) as good,
                                       bool_or(coalesce(toxic = 1, false)) as toxic
                                from labels where doc_id is not null group by doc_id) using (doc_id)),
        s as (select o as filter_order, step::integer as step, (1 << (ascii(substr(o, step, 1)) - 65))::integer as own,
                     list_sum([0] || list_transform(range(1, step), lambda k: (1 << (ascii(substr(o, k, 1)) - 65))))::integer
                     as earlier from (values {orders}) v(o), range(1, 6) r(step)),
        g as (select part, fails, count(*) as n, count(*) filter (good) as n_good, count(*) filter (toxic) as n_toxic
              from f group by part, fails),
        x as (select part, filter_order, step, own,
                     sum(case when fails & (own | earlier) = 0 then n else 0 end)::bigint as kept,
                     sum(case when fails & own <> 0 and fails & earlier = 0 then n else 0 end)::bigint as removed,
                     sum(case when fails & own <> 0 and fails & earlier <> 0 then n else 0 end)::bigint as redundant,
                     sum(case when fails = own then n else 0 end)::bigint as unique_fails,
                     sum(case when fails & own <> 0 and fails & earlier = 0 then n_good else 0 end)::bigint as good_lost,
                     sum(case when fails & own <> 0 and fails & earlier = 0 then n_toxic else 0 end)::bigint as toxic_lost
              from g, s group by part, filter_order, step, own)
        select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               (sum(removed) over (partition by part, own))::bigint as shapley from x"""


ORACLE = {
    "op11_subvector_clusters": _kmeans(),
    "op12_filter_audit": _audit(),
    "op1_warc_transactions": f"""
        with p as (select page_id, url, coalesce(html, '') as payload,
                          sha1(coalesce(html, '')) as sha from pages),
        w as (select *, min(page_id) over (partition by sha) as answers from p)
        select page_id, octet_length(encode(payload)) as payload_bytes,
               list_aggregate(list_transform(range(32), lambda k: substr({_DIGIT}, 1 + (
                   (('0x' || substr(sha, 1 + 5 * (k // 4), 5))::bigint >> (15 - 5 * (k % 4))) & 31)::integer, 1)),
                   'string_agg', '') as payload_digest,
               case when page_id is distinct from answers and answers is not null then 'revisit'
                    else 'response' end as record_type,
               case when page_id is distinct from answers then answers end as refers_to,
               regexp_replace(url, '[\\r\\n]+', ' ', 'g') as target_uri,
               200::integer as http_status, 1::integer as n_requests, 1::integer as n_metadata
        from w""",
}
