"""SQL for the queries that SQL can express."""


def _finite(vector: str) -> str:
    return f"len(list_filter({vector}, lambda e: e IS NULL OR NOT isfinite(e))) = 0"


def _clusters(k: int = 40, rounds: int = 5) -> str:
    """K-means by comparing every vector with every centroid, one pair of tables a round."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
        near{i} AS MATERIALIZED (
            SELECT n, c AS cluster, CAST(d AS BIGINT) AS distance FROM (
                SELECT n, c, square - 2 * list_inner_product(v.x, centre{i}.x) + list_inner_product(centre{i}.x, centre{i}.x) AS d
                FROM v, centre{i}
            ) QUALIFY row_number() OVER (PARTITION BY n ORDER BY d, c) = 1
        ),
        means{i} AS (
            SELECT cluster, i, floor(sum(e) / count(*)) AS m
            FROM (SELECT cluster, unnest(x) AS e, generate_subscripts(x, 1) AS i FROM near{i} JOIN v USING (n))
            GROUP BY cluster, i
        ),
        centre{i + 1} AS MATERIALIZED (
            SELECT c, coalesce(m.x, centre{i}.x) AS x FROM centre{i}
            LEFT JOIN (SELECT cluster, list(m ORDER BY i) AS x FROM means{i} GROUP BY cluster) m ON m.cluster = c
        )""")
    return f"""
        WITH v AS MATERIALIZED (
            SELECT row_number() OVER () AS n, vec_id, x, list_inner_product(x, x) AS square
            FROM (
                SELECT vec_id, list_transform(embedding, lambda e: floor(256 * CAST(e AS DOUBLE))) AS x
                FROM embeddings WHERE len(embedding) = 64 AND {_finite('embedding')}
            )
        ),
        centre0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x
            FROM (SELECT sha256('2:' || vec_id) AS h, x FROM v ORDER BY h NULLS LAST, x LIMIT {k})
        ),{','.join(steps)}
        SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
               CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(distance) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(list_transform(centre{rounds}.x, lambda e: CAST(e AS BIGINT)), ',')) AS centroid_sha256
        FROM near{rounds} JOIN v USING (n) JOIN centre{rounds} ON c = cluster
    """


ORACLE = {
    "op11_centroid_clustering": _clusters(),
    "op13_hard_negatives": f"""
        WITH v AS MATERIALIZED (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda e: floor(256 * CAST(e AS DOUBLE))) AS x
            FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND {_finite('embedding')}
        ), scored AS MATERIALIZED (
            SELECT a.vec_id AS anchor_id, a.label = r.label AS positive, r.vec_id, CAST(list_inner_product(a.x, r.x) AS BIGINT) AS score
            FROM v a JOIN v r ON len(a.x) = len(r.x) WHERE a.vec_id % 100 = 0
        ), positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score
            FROM scored WHERE positive AND vec_id <> anchor_id
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT p.anchor_id, positive_id,
               CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT positive
             AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
    """,
    "op2_line_dedup": """
        WITH lines AS (
            SELECT doc_id, coalesce(source, '') AS site, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents
        ), trimmed AS (
            SELECT *, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS bare FROM lines
        ), wide AS (
            SELECT bare FROM trimmed WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT site) >= 10
        )
        SELECT doc_id, count(*) AS n_lines, count(w.bare) AS n_removed,
               md5(coalesce(string_agg(CASE WHEN w.bare IS NULL THEN line END, chr(10) ORDER BY pos), '')) AS kept_md5
        FROM trimmed t LEFT JOIN wide w ON t.bare = w.bare
        GROUP BY doc_id
    """,
    "op4_exact_dedup": r"""
        WITH rows AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents
        ), placed AS (
            SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
                   first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id
            FROM rows
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM placed
    """,
}
