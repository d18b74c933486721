"""SQL of the queries that SQL can express."""

ORACLES: dict[str, str] = {
    "op5_warc": """
        WITH payloads AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
        groups AS (
            SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS kept FROM payloads)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = kept THEN NULL ELSE kept END AS refers_to
        FROM groups""",
    "op11_line_store": r"""
        WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        lines AS (
            SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs),
        folded AS (
            SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
        often AS (
            SELECT key, max(doc_id) AS keeper FROM folded WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        marked AS (
            SELECT f.doc_id, f.line, f.pos, o.key IS NOT NULL AND f.doc_id < o.keeper AS dropped FROM folded f LEFT JOIN often o USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op12_filter_audit": r"""
        WITH letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
        orders AS (
            SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
            WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
        marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
        docs AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
                   min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first FROM documents),
        fails AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                   CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
                   || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
                   || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 'C' ELSE '' END
                   || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
                   || CASE WHEN doc_id > first THEN 'E' ELSE '' END AS mask
            FROM docs LEFT JOIN marks USING (doc_id)),
        weights AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, mask),
        steps AS (
            SELECT w.*, filter_order, step, f, contains(mask, f) AS failing,
                   list_min([CASE WHEN contains(mask, x) THEN strpos(filter_order, x) ELSE 9 END FOR x IN ['A', 'B', 'C', 'D', 'E']]) AS removal
            FROM weights w, orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s, letters WHERE f = substr(filter_order, step, 1)),
        counts AS (
            SELECT part, filter_order, step, any_value(f) AS f,
                   coalesce(sum(n) FILTER (WHERE removal > step), 0)::BIGINT AS kept,
                   coalesce(sum(n) FILTER (WHERE removal = step), 0)::BIGINT AS removed,
                   coalesce(sum(n) FILTER (WHERE failing AND removal < step), 0)::BIGINT AS redundant,
                   coalesce(sum(n) FILTER (WHERE mask = f), 0)::BIGINT AS unique_fails,
                   coalesce(sum(good) FILTER (WHERE removal = step), 0)::BIGINT AS good_lost,
                   coalesce(sum(toxic) FILTER (WHERE removal = step), 0)::BIGINT AS toxic_lost
            FROM steps GROUP BY part, filter_order, step)
        SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM counts""",
    # The checksum is worked out bit by bit: 3988292384 is its polynomial, 4294967295 its first and last mask.
    "op13_prefix_trie": r"""
        WITH turns AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos,
                   coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
        ids AS (
            SELECT conv_id, xor(list_reduce(
                [4294967295::BIGINT] || [ascii(x)::BIGINT FOR x IN string_split(conv_id::VARCHAR, '')],
                lambda crc, byte: list_reduce([xor(crc, byte)] || range(8), lambda r, i: xor(r >> 1, (r & 1) * 3988292384::BIGINT))),
                4294967295::BIGINT) % 9 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
        built AS (
            SELECT i.conv_id, t.pos, t.role, t.text FROM ids i JOIN turns t ON t.conv_id = i.conv_id - i.conv_id % 5 AND t.pos < i.h
            UNION ALL SELECT i.conv_id, t.pos, t.role, t.text FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND t.pos >= i.h),
        paths AS (
            SELECT i.conv_id, coalesce(p.hashes, []) AS hashes, coalesce(p.sizes, []) AS sizes FROM ids i LEFT JOIN (
                SELECT conv_id, list(sha256(strlen(role) || ':' || role || text) ORDER BY pos) AS hashes, list(strlen(text) ORDER BY pos) AS sizes
                FROM built GROUP BY conv_id) p USING (conv_id)),
        members AS (
            SELECT conv_id, d AS depth, array_to_string(list_slice(hashes, 1, d), '') AS node, array_to_string(list_slice(hashes, 1, d - 1), '') AS above,
                   CASE WHEN d = 0 THEN 0 ELSE sizes[d] END AS size, len(hashes) = d AS ends, hashes
            FROM (SELECT *, unnest(range(len(hashes) + 1)) AS d FROM paths)),
        nodes AS (
            SELECT node, any_value(above) AS above, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, any_value(size) AS size,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256,
                   any_value(list_slice(hashes, 1, depth)) AS path FROM members GROUP BY node),
        children AS (SELECT above AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY above),
        given AS (
            SELECT array_to_string(list_slice(path, 1, d), '') AS node, (n_convs - 1) * size AS saved, (n_children IS NULL)::INT AS leaf
            FROM (SELECT n.*, c.n_children, unnest(range(depth + 1)) AS d FROM nodes n LEFT JOIN children c USING (node))),
        sums AS (SELECT node, sum(saved)::BIGINT AS saved_tokens, sum(leaf)::BIGINT AS n_leaves FROM given GROUP BY node)
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens,
               n.ends_sha256
        FROM nodes n JOIN sums s USING (node) LEFT JOIN children c USING (node) LEFT JOIN nodes p ON p.node = n.above AND n.depth > 0""",
}
