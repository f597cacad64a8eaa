"""DuckDB statements for the registered corpus queries that SQL can express."""

_REPEATS = r"""
WITH words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), starts AS (
    SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS k
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words)
), hits AS (
    SELECT doc_id, list(i) AS places FROM starts
    WHERE k IN (SELECT k FROM starts GROUP BY k HAVING count(*) > 1) GROUP BY doc_id
), covered AS (
    SELECT doc_id, list(DISTINCT p) AS p
    FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM (SELECT doc_id, unnest(places) AS i FROM hits)) GROUP BY doc_id
), kept AS (
    SELECT doc_id, list(w[i] ORDER BY i) AS k
    FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words)
    WHERE (doc_id, i) NOT IN (SELECT doc_id, unnest(p) FROM covered) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(p), 0)::BIGINT AS n_removed,
    sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_REVISITS = """
WITH hashed AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, upper(sha1(coalesce(html, ''))) AS h FROM pages
), parts AS (
    SELECT page_id, payload_bytes, h, list_transform(range(4), lambda i: ('0x' || h[1 + 10 * i:10 + 10 * i])::BIGINT) AS p FROM hashed
), coded AS (
    SELECT page_id, payload_bytes, h, array_to_string(list_transform(range(32), lambda i:
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + ((p[1 + i // 8] >> (35 - 5 * (i % 8))) & 31)]), '') AS payload_digest FROM parts
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id = min(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> min(page_id) OVER same THEN min(page_id) OVER same END AS refers_to
FROM coded WINDOW same AS (PARTITION BY h)
"""

_COLLOCATIONS = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
    FROM documents
), words AS (
    SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), grams AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (VALUES (1), (2), (3)) AS sizes(k))
), counts AS (
    SELECT lang, k, phrase, count(*)::BIGINT AS f FROM grams GROUP BY lang, k, phrase
), totals AS (
    SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang
), candidates AS (
    SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= 10
), absorbed AS (
    SELECT s.lang, s.phrase FROM candidates AS s JOIN (
        SELECT lang, a, array_to_string(w[1:2], ' ') AS part FROM candidates WHERE k = 3
        UNION ALL SELECT lang, a, array_to_string(w[2:3], ' ') FROM candidates WHERE k = 3
    ) AS g ON g.lang = s.lang AND g.part = s.phrase WHERE s.k = 2 AND 100 * g.a >= 50 * s.a
), cuts AS (
    SELECT lang, k, phrase, a, c, array_to_string(w[1:c], ' ') AS head, array_to_string(w[c + 1:k], ' ') AS tail
    FROM (SELECT *, unnest(range(1, k)) AS c FROM candidates) WHERE (lang, phrase) NOT IN (SELECT lang, phrase FROM absorbed)
), scored AS (
    SELECT cuts.lang, cuts.phrase, a, c, h.f AS l, t.f AS r, ((1000000::HUGEINT * a * a) // (h.f::HUGEINT * t.f))::BIGINT AS score
    FROM cuts JOIN counts AS h ON h.lang = cuts.lang AND h.phrase = head JOIN counts AS t ON t.lang = cuts.lang AND t.phrase = tail
), best AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank FROM best
)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE rank <= 2000
"""

_TRIE = """
WITH turns AS (
    SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i,
        md5(md5(coalesce(role, '')) || md5(coalesce(text, ''))) AS k, strlen(coalesce(text, ''))::BIGINT AS bytes
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT c, c - c % 5 AS b, xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
        lambda x, byte: list_reduce(
            list_prepend(xor(x, byte), list_transform(range(8), lambda z: 0::BIGINT)),
            lambda y, z: xor(y >> 1, 3988292384::BIGINT * (y & 1)))
    ), 4294967295::BIGINT) % 9 AS h
    FROM (SELECT DISTINCT c FROM turns)
), rebuilt AS (
    SELECT c, row_number() OVER (PARTITION BY c ORDER BY i) AS d, k, bytes FROM (
        SELECT convs.c, i, k, bytes FROM convs JOIN turns ON turns.c = convs.c WHERE convs.b = convs.c OR i > h
        UNION ALL SELECT convs.c, i, k, bytes FROM convs JOIN turns ON turns.c = convs.b WHERE convs.b <> convs.c AND i <= h)
), prefixes AS (
    SELECT c, 0::BIGINT AS d, md5('') AS p, 0::BIGINT AS bytes FROM convs
    UNION ALL SELECT c, d, md5(string_agg(k, '') OVER (PARTITION BY c ORDER BY d)), bytes FROM rebuilt
), lengths AS (
    SELECT c, max(d) AS len FROM prefixes GROUP BY c
), nodes AS (
    SELECT d, p, min(prefixes.c) AS c, count(*) AS n, any_value(bytes) AS bytes,
        coalesce(string_agg(prefixes.c::VARCHAR, ',' ORDER BY prefixes.c) FILTER (d = len), '') AS ends
    FROM prefixes JOIN lengths ON lengths.c = prefixes.c GROUP BY d, p
), links AS (
    SELECT nodes.d, nodes.p, up.p AS up_p, parent.c AS up_c FROM nodes
    JOIN prefixes AS up ON up.c = nodes.c AND up.d = nodes.d - 1 JOIN nodes AS parent ON parent.d = up.d AND parent.p = up.p
), children AS (
    SELECT d - 1 AS d, up_p AS p, count(*) AS n FROM links GROUP BY 1, 2
), subtrees AS (
    SELECT above.d, above.p, sum(CASE WHEN children.n IS NULL THEN 1 ELSE 0 END)::BIGINT AS leaves,
        sum((nodes.n - 1) * nodes.bytes)::BIGINT AS saved
    FROM nodes JOIN prefixes AS above ON above.c = nodes.c AND above.d <= nodes.d
    LEFT JOIN children ON children.d = nodes.d AND children.p = nodes.p GROUP BY above.d, above.p
)
SELECT nodes.c AS conv_id, nodes.d AS depth, up_c AS parent_conv_id, nodes.n AS n_convs, coalesce(children.n, 0) AS n_children,
    leaves AS n_leaves, saved AS saved_tokens, sha256(ends) AS ends_sha256
FROM nodes JOIN subtrees ON subtrees.d = nodes.d AND subtrees.p = nodes.p
LEFT JOIN links ON links.d = nodes.d AND links.p = nodes.p LEFT JOIN children ON children.d = nodes.d AND children.p = nodes.p
"""

ORACLE_SQL: dict[str, str] = {
    "op1_warc_revisits": _REVISITS, "op3_substring_dedup": _REPEATS, "op11_prefix_trie": _TRIE, "op13_collocations": _COLLOCATIONS,
}
