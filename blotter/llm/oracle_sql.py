"""DuckDB SQL whose levels or rounds are written out by a rule."""

from __future__ import annotations


def ball_codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Plain k-means of op11: every part against every entry, round after round."""
    ctes = [f"""v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding::DOUBLE[], lambda x: floor({scale} * x)) AS q
        FROM embeddings WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
        AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0)""",
            f"""p AS MATERIALIZED (SELECT vec_id, part, q[part * len(q) // {parts} + 1:(part + 1) * len(q) // {parts}] AS x
        FROM v, range({parts}) AS r(part))""",
            f"""b0 AS MATERIALIZED (SELECT part, entry, x AS c FROM p JOIN
        (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v ORDER BY vec_id LIMIT {entries}) USING (vec_id))"""]
    for r in range(rounds + 1):
        ctes.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, part, x, min({{'d': list_inner_product(x, x)
        - 2 * list_inner_product(x, c) + list_inner_product(c, c), 'entry': entry}}) AS near FROM p JOIN b{r} USING (part)
        GROUP BY vec_id, part, x)""")
        if r < rounds:
            ctes.append(f"""m{r} AS MATERIALIZED (SELECT part, entry, list(mean ORDER BY i) AS c FROM (
            SELECT part, near.entry AS entry, i, floor(sum(x[i]) / count(*)) AS mean FROM a{r}, range(1, len(x) + 1) AS k(i)
            GROUP BY part, near.entry, i) GROUP BY part, entry)""")
            ctes.append(f"b{r + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m{r}.c, b{r}.c) AS c FROM b{r} LEFT JOIN m{r} USING (part, entry))")
    return f"""WITH {", ".join(ctes)},
        numbers AS (SELECT sha256(string_agg(list_aggregate(c::BIGINT[], 'string_agg', ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds}),
        e AS MATERIALIZED (SELECT vec_id, string_agg(printf('%02x', near.entry), '' ORDER BY part) AS code, sum(near.d)::BIGINT AS error
                           FROM a{rounds} GROUP BY vec_id),
        l AS (SELECT label, sum(error)::BIGINT AS label_error FROM e JOIN v USING (vec_id) GROUP BY label)
        SELECT vec_id, code, error, label_error, codebooks_sha256
        FROM e JOIN v USING (vec_id) JOIN l ON l.label IS NOT DISTINCT FROM v.label, numbers"""


def merkle_sql(levels: int = 8, group_levels: int = 4, fanout: int = 8) -> str:
    """op12, for up to ``fanout ** levels`` rows a language and ``fanout ** group_levels`` languages."""
    def part(column: str) -> str:
        return f"coalesce(octet_length(encode({column}::VARCHAR)) || ':' || {column}, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(part(c) for c in ('doc_id', 'source', 'lang', 'n_chars'))} || {part(text)})"

    def tree(name: str, depth: int) -> list[str]:
        out = []
        for k in range(depth):
            run = f"PARTITION BY key, pos // {fanout} ORDER BY pos ROWS BETWEEN"
            out.append(f"""{name}_s{k} AS MATERIALIZED (SELECT key, pos,
                coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
                coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
                FROM {name}{k} WHERE n > {fanout ** k})""")
            out.append(f"""{name}{k + 1} AS MATERIALIZED (SELECT key, n, pos // {fanout} AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h
                FROM {name}{k} WHERE n > {fanout ** k} GROUP BY key, n, pos // {fanout}
                UNION ALL SELECT * FROM {name}{k} WHERE n <= {fanout ** k})""")
        return out

    def climb(name: str, rows: str, depth: int) -> list[str]:
        out = []
        for k in range(depth):
            source = rows if k == 0 else f"{rows}_{name}{k}"
            out.append(f"""{rows}_{name}{k + 1} AS MATERIALIZED (SELECT f.* REPLACE (
                CASE WHEN s.key IS NULL THEN f.node ELSE sha256(s.before || f.node || s.after) END AS node,
                f.proof || coalesce(s.before || s.after, '') AS proof)
                FROM {source} f LEFT JOIN {name}_s{k} s ON s.key = f.{name}_key AND s.pos = f.{name}_pos // {fanout ** k})""")
        return out

    ctes = [f"""crc(i, c, k) AS (SELECT i, i, 0 FROM range(256) AS r(i) UNION ALL
            SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc WHERE k < 8)""",
            """sums(doc_id, k, c) AS (SELECT DISTINCT doc_id, 0, 4294967295::BIGINT FROM documents WHERE doc_id IS NOT NULL UNION ALL
            SELECT doc_id, sums.k + 1, xor(sums.c >> 8, crc.c) FROM sums JOIN crc
            ON crc.k = 8 AND crc.i = xor(sums.c, ascii(substr(doc_id::VARCHAR, sums.k + 1, 1))) & 255 WHERE sums.k < length(doc_id::VARCHAR))""",
            """bad AS MATERIALIZED (SELECT doc_id FROM sums WHERE k = length(doc_id::VARCHAR) AND xor(c, 4294967295) % 3 = 0)""",
            f"""d AS MATERIALIZED (SELECT doc_id, coalesce('=' || lang, '') AS key, {leaf('text')} AS leaf,
            CASE WHEN doc_id IN (SELECT doc_id FROM bad) THEN
            {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS other FROM documents)""",
            """o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
            count(*) OVER (PARTITION BY key) AS n FROM d)""",
            "t0 AS MATERIALIZED (SELECT key, n, pos, leaf AS h FROM o)", *tree("t", levels),
            f"""g AS MATERIALIZED (SELECT key, h AS subroot, row_number() OVER (ORDER BY encode(key)) - 1 AS pos, count(*) OVER () AS n FROM t{levels})""",
            "u0 AS MATERIALIZED (SELECT '' AS key, n, pos, subroot AS h FROM g)", *tree("u", group_levels),
            """f AS MATERIALIZED (SELECT o.doc_id, o.leaf, g.subroot, coalesce(o.other, o.leaf) AS node, '' AS proof,
            o.key AS t_key, o.pos AS t_pos, '' AS u_key, g.pos AS u_pos FROM o JOIN g USING (key))""",
            *climb("t", "f", levels)]
    mid = f"f_t{levels}"
    ctes += climb("u", mid, group_levels)
    return f"""WITH RECURSIVE {", ".join(ctes)}
        SELECT doc_id, leaf, subroot, u{group_levels}.h AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = u{group_levels}.h AS verified
        FROM {mid}_u{group_levels}, u{group_levels}"""
