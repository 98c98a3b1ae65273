"""Reference SQL of the learners: every round of training written out."""


def maxent_sql(words: str, rounds: int) -> str:
    ctes = [
        f"terms AS MATERIALIZED (SELECT doc_id, lang AS own, unnest(list_distinct({words})) AS term FROM documents)",
        "pairs AS MATERIALIZED (SELECT term, own AS label, count(*) AS seen FROM terms GROUP BY ALL)",
        "uses AS MATERIALIZED (SELECT doc_id, term, label FROM terms JOIN pairs USING (term))",
        """sizes AS MATERIALIZED (SELECT max(n) AS filled, (SELECT count(*) FROM documents) * max(n) - sum(n) AS seen_filling
           FROM (SELECT count(*) AS n FROM terms GROUP BY doc_id))""",
        "places AS MATERIALIZED (SELECT doc_id, lang AS label FROM (SELECT doc_id FROM documents), (SELECT DISTINCT lang FROM documents))",
        "w0 AS MATERIALIZED (SELECT term, label, seen, 0.0::DOUBLE AS w FROM pairs)",
        "k0 AS MATERIALIZED (SELECT 0.0::DOUBLE AS w)",
    ]
    for i in range(rounds + 1):
        ctes.append(f"""s{i} AS MATERIALIZED (SELECT doc_id, label, coalesce(u.w, 0) + (filled - coalesce(c, 0)) * k.w AS s, filled - coalesce(c, 0) AS open
            FROM places LEFT JOIN (SELECT doc_id, label, sum(w) AS w, count(*) AS c FROM uses JOIN w{i} USING (term, label) GROUP BY ALL) u
            USING (doc_id, label), sizes, k{i} k)""")
        if i == rounds:
            break
        ctes.append(f"""p{i} AS MATERIALIZED (SELECT doc_id, label, open, e / sum(e) OVER (PARTITION BY doc_id) AS p FROM
            (SELECT *, exp(s - max(s) OVER (PARTITION BY doc_id)) AS e FROM s{i}))""")
        ctes.append(f"""w{i + 1} AS MATERIALIZED (SELECT term, label, seen, w + ln(seen / expected) / filled AS w FROM w{i}
            JOIN (SELECT term, label, sum(p) AS expected FROM uses JOIN p{i} USING (doc_id, label) GROUP BY ALL) USING (term, label), sizes)""")
        ctes.append(f"""k{i + 1} AS MATERIALIZED (SELECT w + coalesce(CASE WHEN seen_filling > 0 AND f > 0 THEN ln(seen_filling / f) END, 0) / filled AS w
            FROM k{i}, sizes, (SELECT sum(p * open) AS f FROM p{i}))""")
    return f"""WITH {", ".join(ctes)},
        best AS (SELECT doc_id, label AS predicted FROM s{rounds} QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(s, 9) DESC, label) = 1)
        SELECT lang, predicted, count(*) AS n FROM documents JOIN best USING (doc_id) GROUP BY lang, predicted"""


def tree_sql(words: str, depth: int, support: int) -> str:
    ctes = [
        f"terms AS MATERIALIZED (SELECT doc_id, unnest(list_distinct({words})) AS term FROM documents)",
        "at0 AS MATERIALIZED (SELECT doc_id, lang, 1 AS node FROM documents)",
    ]
    for i in range(depth + 1):
        ctes.append(f"t{i} AS MATERIALIZED (SELECT node, lang, count(*) AS n FROM at{i} GROUP BY ALL)")
        ctes.append(f"""n{i} AS MATERIALIZED (SELECT node, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n) - max(n) AS BIGINT) AS errors,
            min(lang) FILTER (n = top) AS predicted FROM (SELECT *, max(n) OVER (PARTITION BY node) AS top FROM t{i}) GROUP BY node)""")
        ctes.append(f"""c{i} AS MATERIALIZED (SELECT node, term, lang, count(*) AS m FROM at{i} JOIN terms USING (doc_id)
            WHERE node IN (SELECT node FROM n{i} WHERE n > {support} AND errors > 0 AND {i} < {depth}) GROUP BY ALL)""")
        ctes.append(f"""e{i} AS MATERIALIZED (SELECT x.node, x.term, sum(n) - max(coalesce(m, 0)) - max(n - coalesce(m, 0)) AS remaining
            FROM (SELECT DISTINCT node, term FROM c{i}) x JOIN t{i} t ON t.node = x.node
            LEFT JOIN c{i} c ON c.node = x.node AND c.term = x.term AND c.lang = t.lang GROUP BY x.node, x.term)""")
        ctes.append(f"""b{i} AS MATERIALIZED (SELECT node, term FROM e{i} JOIN n{i} USING (node) WHERE remaining < errors
            QUALIFY row_number() OVER (PARTITION BY node ORDER BY remaining, term) = 1)""")
        ctes.append(f"""at{i + 1} AS MATERIALIZED (SELECT a.doc_id, lang, 2 * node + CASE WHEN t.term IS NULL THEN 0 ELSE 1 END AS node
            FROM at{i} a JOIN b{i} b USING (node) LEFT JOIN terms t ON t.doc_id = a.doc_id AND t.term = b.term)""")
    leaves = " UNION ALL ".join(f"SELECT lang, predicted FROM at{i} JOIN n{i} USING (node) ANTI JOIN b{i} USING (node)" for i in range(depth + 1))
    return f"WITH {', '.join(ctes)}, leaves AS ({leaves}) SELECT lang, predicted, count(*) AS n FROM leaves GROUP BY lang, predicted"


def mixture_sql(k: int, rounds: int, least: float) -> str:
    ctes = [
        """long AS MATERIALIZED (SELECT vec_id, a, CAST(embedding[a] AS DOUBLE) AS x FROM embeddings, unnest(range(1, len(embedding) + 1)) t(a))""",
        "overall AS MATERIALIZED (SELECT a, greatest(avg(x * x) - avg(x) * avg(x), 1e-12) AS v FROM long GROUP BY a)",
        f"""first AS MATERIALIZED (SELECT vec_id, row_number() OVER (ORDER BY md5(CAST(vec_id AS VARCHAR)), vec_id) - 1 AS c FROM embeddings
            QUALIFY c < {k})""",
        "m0 AS MATERIALIZED (SELECT c, a, x AS m, v FROM first JOIN long USING (vec_id) JOIN overall USING (a))",
        "w0 AS MATERIALIZED (SELECT c, 1.0::DOUBLE / count(*) OVER () AS share FROM first)",
    ]
    for i in range(rounds + 1):
        ctes.append(f"""d{i} AS MATERIALIZED (SELECT vec_id, c, any_value(ln(share)) - 0.5 * sum((x - m) * (x - m) / v + ln(v)) AS d
            FROM long JOIN m{i} USING (a) JOIN w{i} USING (c) GROUP BY vec_id, c)""")
        if i == rounds:
            break
        ctes.append(f"""r{i} AS MATERIALIZED (SELECT vec_id, c, e / sum(e) OVER (PARTITION BY vec_id) AS r
            FROM (SELECT *, exp(d - max(d) OVER (PARTITION BY vec_id)) AS e FROM d{i}))""")
        ctes.append(f"w{i + 1} AS MATERIALIZED (SELECT c, sum(r) / (SELECT count(*) FROM embeddings) AS share FROM r{i} GROUP BY c)")
        ctes.append(f"""m{i + 1} AS MATERIALIZED (SELECT c, a, m, greatest(q - m * m, {least} * o.v) AS v FROM
            (SELECT c, a, sum(r * x) / sum(r) AS m, sum(r * x * x) / sum(r) AS q FROM r{i} JOIN long USING (vec_id) GROUP BY c, a) JOIN overall o USING (a))""")
    return f"""WITH {", ".join(ctes)},
        best AS (SELECT vec_id, CAST(c AS INTEGER) AS prediction FROM d{rounds} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d DESC, c) = 1)
        SELECT prediction, label, count(*) AS n FROM embeddings JOIN best USING (vec_id) GROUP BY prediction, label"""


def _micro_ctes(size: int, rounds: int) -> list[str]:
    ctes = [
        "long AS MATERIALIZED (SELECT vec_id, a, CAST(embedding[a] AS DOUBLE) AS x FROM embeddings, unnest(range(1, len(embedding) + 1)) t(a))",
        f"""first AS MATERIALIZED (SELECT vec_id, row_number() OVER (ORDER BY md5(CAST(vec_id AS VARCHAR)), vec_id) - 1 AS c FROM embeddings
            QUALIFY c < {size})""",
        "m0 AS MATERIALIZED (SELECT c, a, x AS m FROM first JOIN long USING (vec_id))",
    ]
    for i in range(rounds + 1):
        ctes.append(f"""o{i} AS MATERIALIZED (SELECT vec_id, arg_min(c, (round(g, 9), c)) AS c FROM
            (SELECT vec_id, c, sum((x - m) * (x - m)) AS g FROM long JOIN m{i} USING (a) GROUP BY vec_id, c) GROUP BY vec_id)""")
        if i < rounds:
            ctes.append(f"""m{i + 1} AS MATERIALIZED (SELECT c, a, coalesce(n.m, p.m) AS m FROM m{i} p
                LEFT JOIN (SELECT c, a, avg(x) AS m FROM o{i} JOIN long USING (vec_id) GROUP BY c, a) n USING (c, a))""")
    return ctes


def _link_ctes(size: int, rounds: int) -> list[str]:
    """Micro-clusters, and after i merges their sizes n<i>, gaps g<i> (a < b), and the merge x<i> to come."""
    ctes = _micro_ctes(size, rounds)
    ctes += [
        f"n0 AS MATERIALIZED (SELECT c, count(*) AS n FROM o{rounds} GROUP BY c)",
        f"means AS MATERIALIZED (SELECT c, a, avg(x) AS m, avg(x * x) AS q FROM o{rounds} JOIN long USING (vec_id) GROUP BY c, a)",
        "g0 AS MATERIALIZED (SELECT x.c AS a, y.c AS b, sum(x.q + y.q - 2 * x.m * y.m) AS g FROM means x JOIN means y ON x.a = y.a AND x.c < y.c GROUP BY ALL)",
    ]
    for i in range(size - 1):
        ctes.append(f"x{i} AS MATERIALIZED (SELECT a, b, g FROM g{i} ORDER BY round(g, 9), a, b LIMIT 1)")
        ctes.append(f"""g{i + 1} AS MATERIALIZED (SELECT least(p, o) AS a, greatest(p, o) AS b, sum(n * g) / sum(n) AS g FROM
            (SELECT CASE WHEN g.a IN (x.a, x.b) THEN x.a ELSE g.a END AS u, CASE WHEN g.b IN (x.a, x.b) THEN x.a ELSE g.b END AS v,
                    CASE WHEN g.a IN (x.a, x.b) THEN g.a WHEN g.b IN (x.a, x.b) THEN g.b ELSE g.a END AS part, g.g,
                    u AS p, v AS o FROM g{i} g, x{i} x) JOIN n{i} ON c = part WHERE p <> o GROUP BY ALL)""")
        ctes.append(f"n{i + 1} AS MATERIALIZED (SELECT CASE WHEN c = x.b THEN x.a ELSE c END AS c, CAST(sum(n) AS BIGINT) AS n FROM n{i} LEFT JOIN x{i} x ON true GROUP BY 1)")
    return ctes


def dendrogram_sql(size: int, rounds: int) -> str:
    steps = " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS step, CAST(x.a AS INTEGER) AS left_part, CAST(x.b AS INTEGER) AS right_part, round(g, 6) AS height, n FROM x{i} x JOIN n{i + 1} ON c = x.a"
        for i in range(size - 1)
    )
    return f"WITH {', '.join(_link_ctes(size, rounds))} {steps}"


def linkage_sql(size: int, rounds: int, k: int) -> str:
    """As many merges as leave `k` clusters, if all micro-clusters hold a vector; fewer where some don't."""
    ctes = _link_ctes(size, rounds)
    moves = "c0 AS MATERIALIZED (SELECT c, c AS cluster FROM n0)"
    ctes.append(moves)
    for i in range(size - k):
        ctes.append(f"""c{i + 1} AS MATERIALIZED (SELECT c, CASE WHEN cluster = x.b AND (SELECT count(*) FROM n0) - {i} > {k} THEN x.a ELSE cluster END AS cluster
            FROM c{i} LEFT JOIN x{i} x ON true)""")
    return f"""WITH {", ".join(ctes)} SELECT CAST(cluster AS INTEGER) AS prediction, label, count(*) AS n
        FROM embeddings JOIN o{rounds} USING (vec_id) JOIN c{size - k} USING (c) GROUP BY 1, 2"""
