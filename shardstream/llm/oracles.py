"""SQL for the queries of the operators that SQL can express, over the same tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {
    "op5_near_embeddings": """
        with recursive v as (
          select vec_id, embedding::double[] as e from embeddings
          where len(embedding) > 0 and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))
            and list_bool_or(list_transform(embedding, lambda x: x <> 0))),
        links as (
          select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
          where list_cosine_similarity(a.e, b.e) >= 0.95),
        reach as (
          select vec_id, vec_id as r from embeddings
          union select reach.vec_id, links.b from reach join links on reach.r = links.a),
        groups as (select vec_id, min(r) as component_id from reach group by 1),
        counts as (select a as vec_id, count(*) as n from links group by 1)
        select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept
        from groups left join counts using (vec_id)""",
    "op6_jaccard_join": r"""
        with recursive t as (
          select doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') as w
          from documents),
        s as (
          select doc_id, unnest(list_distinct(
            case when len(w) = 0 then []::varchar[]
                 when len(w) < 5 then [array_to_string(w, ' ')]
                 else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end)) as g
          from t),
        n as (select doc_id, count(*) as n from s group by 1),
        shared as (
          select a.doc_id as a, b.doc_id as b, count(*) as k
          from s a join s b using (g) where a.doc_id <> b.doc_id group by 1, 2),
        links as (
          select a, b from shared join n x on x.doc_id = a join n y on y.doc_id = b
          where 100 * k >= 80 * (x.n + y.n - k)),
        reach as (
          select doc_id, doc_id as r from documents
          union select reach.doc_id, links.b from reach join links on reach.r = links.a),
        groups as (select doc_id, min(r) as component_id from reach group by 1)
        select doc_id, coalesce(n, 0) as n_shingles, component_id from groups left join n using (doc_id)""",
    "op11_exact_dedup": """
        select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, sha256(t) as text_sha256
        from (
          select doc_id, t, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size
          from (select doc_id, coalesce(text, '') as t from documents))""",
    # crc32 by its definition: a list reduced byte by byte, each byte bit by bit.
    "op12_merkle_manifest": """
        with recursive
        d as (
          select doc_id, source, coalesce(text, '') as t, text,
            coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
              || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as h,
            xor(list_reduce(
              list_transform(range(1, length(doc_id::varchar) + 1), lambda i: ascii(substr(doc_id::varchar, i, 1))::bigint),
              lambda c, b: list_reduce(range(8)::bigint[],
                lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)), 4294967295::bigint), 4294967295::bigint) % 5 = 0
              as changed
          from documents),
        e as (
          select doc_id, source, sha256(h || coalesce(strlen(text) || ':' || text, '-')) as leaf,
            case when changed and text is not null then sha256(h || strlen(text) || ':' || translate(
              text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) end as tampered
          from d),
        leaves as (
          select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as i,
            coalesce(strlen(source) || ':' || source, '-') as tree
          from e),
        nodes as (
          select tree, 0 as level, i, leaf as digest, count(*) over (partition by tree) as n from leaves
          union all
          select tree, level + 1, i // 16, sha256(string_agg(digest, '' order by i)), (any_value(n) + 15) // 16
          from nodes where n > 1 group by tree, level, i // 16),
        subroots as (
          select tree, digest as subroot,
            row_number() over (order by tree <> '-', decode(encode(substr(tree, instr(tree, ':') + 1)))) - 1 as i
          from nodes where n = 1),
        tops as (
          select 0 as level, i, subroot as digest, count(*) over () as n from subroots
          union all
          select level + 1, i // 16, sha256(string_agg(digest, '' order by i)), (any_value(n) + 15) // 16
          from tops where n > 1 group by level, i // 16),
        runs as (
          select tree, level, i // 16 as run, list(digest order by i) as r from nodes where n > 1 group by all
          union all select null, level, i // 16, list(digest order by i) from tops where n > 1 group by all),
        low as (
          select tree, i as leaf_i, 0 as level, i, '' as proof, coalesce(tampered, leaf) as folded from leaves
          union all
          select low.tree, leaf_i, low.level + 1, i // 16,
            proof || array_to_string(r[1:i % 16], '') || array_to_string(r[i % 16 + 2:], ''),
            sha256(array_to_string(r[1:i % 16], '') || folded || array_to_string(r[i % 16 + 2:], ''))
          from low join runs on runs.tree = low.tree and runs.level = low.level and run = i // 16),
        low_ends as (select tree, leaf_i, arg_max(proof, level) as proof, arg_max(folded, level) as folded from low group by 1, 2),
        up as (
          select l.tree, leaf_i, 0 as level, s.i, proof, folded from low_ends l join subroots s using (tree)
          union all
          select up.tree, leaf_i, up.level + 1, i // 16,
            proof || array_to_string(r[1:i % 16], '') || array_to_string(r[i % 16 + 2:], ''),
            sha256(array_to_string(r[1:i % 16], '') || folded || array_to_string(r[i % 16 + 2:], ''))
          from up join runs on runs.tree is null and runs.level = up.level and run = i // 16),
        ends as (select tree, leaf_i, arg_max(proof, level) as proof, arg_max(folded, level) as folded from up group by 1, 2),
        top as (select digest as root from tops where n = 1)
        select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, folded as folded_root, folded = root as verified
        from leaves join ends on ends.tree = leaves.tree and leaf_i = i join subroots on subroots.tree = leaves.tree, top""",
    "op13_hard_negatives": """
        with v as (
          select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
            list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as e
          from embeddings
          where label is not null and embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        pairs as (
          select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
            list_sum(list_transform(list_zip(a.e, b.e), lambda p: p[1] * p[2]))::bigint as score
          from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id and len(a.e) = len(b.e)),
        positives as (
          select anchor_id, other_id as positive_id, score as positive_score from pairs where same
          qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
        select anchor_id, positive_id,
          (row_number() over (partition by anchor_id, positive_id order by score desc, other_id))::int as rank,
          other_id as negative_id, positive_score, score as negative_score
        from positives join pairs using (anchor_id)
        where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
        qualify rank <= 10""",
}
