"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

from ratiolens.llm import centroids, chat, jaccard_join, mixing, repeats

EXACT = r"""
WITH n AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
    FROM documents
)
SELECT doc_id,
       first(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(norm) AS text_sha256
FROM n
WINDOW w AS (PARTITION BY norm ORDER BY length(text) DESC, doc_id NULLS LAST)
"""


def mixing_sql() -> str:
    """The raking written out, one step after the other."""
    around = mixing.AROUND.replace("'", "''")
    steps = [
        r"""d AS MATERIALIZED (
    SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
           coalesce(text, '') AS text,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens
    FROM documents
)""",
        f"""n AS MATERIALIZED (
    SELECT row_number() OVER () AS row_no, doc_id, source, lang, tokens,
           [w for w in [trim(lower(x), '{around}') for x in regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')
                        if length(x) >= {mixing.LETTERS}] if length(w) >= {mixing.LETTERS}] AS said
    FROM d
)""",
        f"""topics AS MATERIALIZED (
    SELECT word, n FROM (
        SELECT word, count(*) AS n FROM (SELECT unnest(list_distinct(said)) AS word FROM n) GROUP BY word
    ) WHERE n * {mixing.COMMON} <= (SELECT count(*) FROM n) ORDER BY n DESC, word LIMIT {mixing.TOPICS}
)""",
        f"""t AS MATERIALIZED (
    SELECT n.doc_id, n.source, n.lang, n.tokens, coalesce(best.word, '{mixing.OTHER}') AS topic
    FROM n LEFT JOIN (
        SELECT row_no, word FROM (
            SELECT row_no, word, row_number() OVER (
                PARTITION BY row_no ORDER BY count(*) DESC, max(t.n) DESC, word) AS place
            FROM (SELECT row_no, unnest(said) AS word FROM n) JOIN topics t USING (word)
            GROUP BY row_no, word
        ) WHERE place = 1
    ) best ON n.row_no = best.row_no
)""",
        """c AS MATERIALIZED (
    SELECT source, lang, topic, sum(tokens) AS tokens,
           sum(sum(tokens)) OVER () AS all_tokens,
           sum(tokens) / sum(sum(tokens)) OVER () AS weight
    FROM t GROUP BY ALL HAVING sum(tokens) > 0
)""",
    ]
    for name, power in mixing.POWERS.items():
        steps.append(
            f"""s_{name} AS MATERIALIZED (
    SELECT {name}, pow(sum(weight), {power}) / sum(pow(sum(weight), {power})) OVER () AS share
    FROM c GROUP BY {name}
)"""
        )
    before = "c"
    for sweep in range(mixing.SWEEPS):
        for name in mixing.POWERS:
            now = f"w{sweep}_{name}"
            steps.append(
                f"""{now} AS MATERIALIZED (
    SELECT p.source, p.lang, p.topic, p.tokens, p.all_tokens,
           p.weight * s.share / sum(p.weight) OVER (PARTITION BY p.{name}) AS weight
    FROM {before} p JOIN s_{name} s ON p.{name} = s.{name}
)"""
            )
            before = now
    order = "ORDER BY ratio DESC, source, lang, topic ROWS BETWEEN"
    steps += [
        f"""r AS MATERIALIZED (
    SELECT *, weight * all_tokens AS fitted, weight * all_tokens / tokens AS ratio FROM {before}
)""",
        # cells in order of their ratio: those before a cell give all they have, it and the rest share
        f"""k AS MATERIALIZED (
    SELECT *, row_number() OVER (ORDER BY ratio DESC, source, lang, topic) AS nth,
           ({mixing.KEEP} * all_tokens
            - coalesce(sum(tokens) OVER ({order} UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(fitted) OVER ({order} CURRENT ROW AND UNBOUNDED FOLLOWING) AS factor
    FROM r
)""",
        """p AS MATERIALIZED (
    SELECT source, lang, topic, round(least(1.0, ratio * (
        SELECT arg_min(factor, nth) FROM k WHERE factor * ratio < 1)), 9) AS chance
    FROM r
)""",
    ]
    digits = mixing.DIGITS
    chance = f"CASE WHEN t.tokens > 0 THEN p.chance ELSE {mixing.KEEP} END"
    return (
        "WITH "
        + ",\n".join(steps)
        + f"""
SELECT t.doc_id, t.source, t.lang, t.topic, t.tokens, {chance} AS chance,
       ('0x' || substr(md5('{mixing.SEED}:' || coalesce(t.doc_id::VARCHAR, '')), 1, {digits}))::BIGINT
       / {16**digits}.0::DOUBLE < {chance} AS sampled
FROM t LEFT JOIN p ON t.source = p.source AND t.lang = p.lang AND t.topic = p.topic
"""
    )


FILL_IN_MIDDLE = """
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
           sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
    FROM documents
), e AS (
    SELECT doc_id, text, n,
           ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS one,
           ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS two,
           CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>')
                     OR contains(text, '<M>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90
                THEN 'plain'
                WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM d
), c AS (
    SELECT doc_id, text, n, form, least(one, two) AS a, greatest(one, two) AS b,
           substr(text, 1, least(one, two)) AS prefix,
           substr(text, least(one, two) + 1, abs(one - two)) AS middle,
           substr(text, greatest(one, two) + 1) AS suffix
    FROM e
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END)
           AS output_sha256,
       sha256(text) AS restored_sha256
FROM c
"""


def centroids_sql() -> str:
    """Every distance of every round."""
    steps = [
        f"""v AS MATERIALIZED (
    SELECT row_number() OVER () AS row_no, vec_id,
           [floor({centroids.SCALE} * x::DOUBLE)::BIGINT for x in embedding] AS vec
    FROM embeddings
    WHERE len(embedding) = {centroids.DIMENSION}
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
)""",
        f"""c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY h, vec) - 1 AS cluster, vec FROM (
        SELECT sha256('{centroids.SEED}' || coalesce(vec_id::VARCHAR, '')) AS h, vec FROM v
        ORDER BY 1, 2 LIMIT {centroids.CLUSTERS}
    )
)""",
    ]
    squares = "list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(v.vec, c.vec)])"
    for k in range(centroids.ROUNDS + 1):
        steps.append(
            f"""a{k} AS MATERIALIZED (
    SELECT row_no, min(far)[1] AS distance, min(far)[2] AS cluster
    FROM (SELECT v.row_no, [{squares}::BIGINT, c.cluster] AS far FROM v, c{k} c)
    GROUP BY row_no
)"""
        )
        if k == centroids.ROUNDS:
            break
        steps.append(
            f"""c{k + 1} AS MATERIALIZED (
    SELECT c.cluster, coalesce(m.vec, c.vec) AS vec FROM c{k} c LEFT JOIN (
        SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY place) AS vec FROM (
            SELECT a.cluster, place, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n
            FROM a{k} a JOIN (
                SELECT row_no, unnest(vec) AS x, generate_subscripts(vec, 1) AS place FROM v
            ) USING (row_no)
            GROUP BY ALL
        ) GROUP BY cluster
    ) m ON c.cluster = m.cluster
)"""
        )
    n = centroids.ROUNDS
    return (
        "WITH "
        + ",\n".join(steps)
        + f"""
SELECT v.vec_id, a.cluster::INTEGER AS cluster, a.distance,
       (sum(a.distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
       (sum(a.distance) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c.vec, ',')) AS centroid_sha256
FROM a{n} a JOIN v USING (row_no) JOIN c{n} c ON a.cluster = c.cluster
"""
    )


def chat_sql() -> str:
    """Sizes of the escaped segments, added up to each reply; digests of the plain texts."""
    probe = "<|im_end|><|im_start|>assistant ok"
    escaped = r"regexp_replace({}, '<(\\*)\|', '<\1\\|', 'g')"
    role = escaped.format(r"replace(replace(role, '\', '\\'), chr(10), '\n')")
    frame = len(chat.OPEN) + len(chat.CLOSE) + 2
    trained = f"FILTER (role = '{chat.TRAINED}')"
    return f"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '{probe}'), (-1, 1, 'assistant', '{probe}')
), o AS (
    SELECT conv_id, role, text, {frame} + length({role}) + length({escaped.format('text')}) AS size,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS nth
    FROM t
), c AS (
    SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY nth) AS ends,
           max(CASE WHEN role = '{chat.TRAINED}' THEN nth END) OVER (PARTITION BY conv_id) AS last
    FROM o
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
       coalesce(sum(length(text)) {trained}, 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY nth) {trained}, '')) AS loss_sha256,
       (coalesce(sum(ends - 1) {trained}, 0)
        + coalesce(sum(size) FILTER (last IS NULL OR nth > last), 0))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""


def repeats_sql() -> str:
    """Every window of every text, by its bytes."""
    size = repeats.LENGTH
    return f"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS row_no, doc_id, encode(coalesce(text, '')) AS bytes,
           octet_length(encode(coalesce(text, ''))) AS n
    FROM documents
), w AS MATERIALIZED (
    SELECT row_no, pos, md5(array_slice(bytes, pos + 1, pos + {size})) AS h
    FROM (SELECT row_no, bytes, unnest(range(0, n - {size - 1})) AS pos FROM d)
), s AS MATERIALIZED (
    SELECT row_no, pos FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)
), runs AS MATERIALIZED (
    SELECT row_no, min(pos) AS low, max(pos) + {size} AS high FROM (
        SELECT row_no, pos, sum(new) OVER (PARTITION BY row_no ORDER BY pos) AS run FROM (
            SELECT row_no, pos,
                   CASE WHEN pos > lag(pos) OVER (PARTITION BY row_no ORDER BY pos) + {size} THEN 1 ELSE 0 END AS new
            FROM s
        )
    ) GROUP BY row_no, run
), kept AS MATERIALIZED (
    SELECT row_no, string_agg(hex(array_slice(bytes, low + 1, high)), '' ORDER BY low) AS rest FROM (
        SELECT row_no, bytes, coalesce(lag(high) OVER (PARTITION BY row_no ORDER BY low), 0) AS low, low AS high
        FROM (SELECT row_no, low, high FROM runs UNION ALL SELECT row_no, n, n FROM d) JOIN d USING (row_no)
    ) GROUP BY row_no
), sums AS (SELECT row_no, sum(high - low) AS removed, count(*) AS spans FROM runs GROUP BY row_no)
SELECT doc_id, n AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0) AS n_spans,
       sha256(unhex(rest)) AS kept_sha256, coalesce(removed, 0) > 0 AS has_repeats
FROM d JOIN kept USING (row_no) LEFT JOIN sums USING (row_no)
"""


def similar_sql() -> str:
    """Every pair of sets that shares a shingle, and what their links reach."""
    upper = "".join(map(chr, range(65, 91)))
    size, link = jaccard_join.SHINGLE, jaccard_join.LINK
    return rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), s AS MATERIALIZED (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN []
        WHEN len(w) < {size} THEN [array_to_string(w, ' ')]
        ELSE list_distinct([array_to_string(w[i:i + {size - 1}], ' ') for i in range(1, len(w) - {size - 2})])
        END AS g
    FROM d
), rows_ AS MATERIALIZED (
    SELECT doc_id, len(g) AS n, g, md5(array_to_string(list_sort(g), chr(10))) AS node FROM s
), c AS MATERIALIZED (
    SELECT node, any_value(g) AS g, any_value(n) AS n, min(doc_id) AS id FROM rows_ WHERE n > 0 GROUP BY node
), e AS MATERIALIZED (SELECT node, unnest(g) AS t FROM c),
x AS MATERIALIZED (
    SELECT a.node AS u, b.node AS v, count(*) AS k FROM e a JOIN e b USING (t) WHERE a.node < b.node GROUP BY ALL
), l AS MATERIALIZED (
    SELECT u, v FROM x JOIN c p ON p.node = u JOIN c q ON q.node = v
    WHERE 100 * k >= {link} * (p.n + q.n - k)
), both_ AS MATERIALIZED (SELECT u, v FROM l UNION SELECT v, u FROM l),
r(node, root) AS (
    SELECT node, id FROM c UNION SELECT both_.v, r.root FROM r JOIN both_ ON r.node = both_.u
), names AS MATERIALIZED (SELECT node, min(root) AS name FROM r GROUP BY node)
SELECT doc_id, n AS n_shingles, CASE WHEN n = 0 THEN doc_id ELSE name END AS component_id
FROM rows_ LEFT JOIN names USING (node)
"""


ORACLES = {
    "op1_repeated_strings": repeats_sql(),
    "op2_chat": chat_sql(),
    "op4_jaccard_join": similar_sql(),
    "op5_exact_dedup": EXACT,
    "op9_mixing": mixing_sql(),
    "op11_fill_in_middle": FILL_IN_MIDDLE,
    "op13_centroids": centroids_sql(),
}
