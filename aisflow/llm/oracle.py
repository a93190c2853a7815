"""DuckDB SQL for the queries that SQL can express, written apart from the operators.

Missing are the trained classifier, the BPE encoding and the pipeline that holds
the former: these are tested against plain versions of themselves.
"""

from aisflow.llm import fingerprints, packing, quality_rules, queries, secret_scan, sharding

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x20\x09-\x0D]+"
_TEXTS = "texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _packing() -> str:
    levels = []
    for k in range(1, packing.BUCKETS + 1):
        before = "(SELECT 0 AS j, 0 AS cost)" if k == 1 else f"b{k - 1}"
        levels.append(
            f"""b{k} AS (SELECT h.j, min(p.cost + h.n * (h.c - q.c) - (h.t - q.t)) AS cost,
            arg_min(p.j, struct_pack(a := p.cost + h.n * (h.c - q.c) - (h.t - q.t), b := p.j)) AS prev
            FROM hist h JOIN {before} p ON p.j < h.j JOIN hist q ON q.j = p.j WHERE h.j > 0 GROUP BY h.j)"""
        )
    chain = ["used AS (SELECT arg_min(k, struct_pack(a := cost, b := k)) AS k FROM totals)"]
    totals = " UNION ALL ".join(f"SELECT {k} AS k, cost FROM b{k} WHERE j = (SELECT max(j) FROM hist)" for k in range(1, packing.BUCKETS + 1))
    last = packing.BUCKETS
    steps = [f"e{last + 1} AS (SELECT max(j) AS j FROM hist)"]
    for k in range(last, 0, -1):
        # before the level in use is reached, the end stays where it is
        steps.append(
            f"""e{k} AS (SELECT CASE WHEN {k} <= (SELECT k FROM used) THEN b.prev ELSE e.j END AS j
            FROM e{k + 1} e LEFT JOIN b{k} b ON b.j = e.j)"""
        )
    ends = " UNION ".join(f"SELECT j FROM e{k}" for k in range(2, last + 2))
    return f"""WITH {_TEXTS}, counted AS (SELECT doc_id, len(regexp_extract_all(text, '{_WORD}')) AS n FROM texts),
    pieces AS (SELECT doc_id, piece, piece * {packing.CONTEXT} AS start, least({packing.CONTEXT}, n - piece * {packing.CONTEXT}) AS n_tokens
        FROM (SELECT doc_id, n, unnest(range(greatest(1, (n + {packing.CONTEXT - 1}) // {packing.CONTEXT}))) AS piece FROM counted)),
    lengths AS (SELECT n_tokens AS n, count(*) AS c FROM pieces GROUP BY n_tokens),
    hist AS (SELECT row_number() OVER w AS j, n, sum(c) OVER w AS c, sum(c * n) OVER w AS t FROM lengths WINDOW w AS (ORDER BY n)
        UNION ALL SELECT 0, 0, 0, 0),
    {", ".join(levels)}, totals AS ({totals}), {", ".join(chain)}, {", ".join(steps)},
    bounds AS (SELECT row_number() OVER (ORDER BY n) - 1 AS bucket, n AS bound FROM ({ends}) JOIN hist USING (j) WHERE j > 0),
    placed AS (SELECT p.*, (SELECT min(bound) FROM bounds WHERE bound >= n_tokens) AS bound FROM pieces p),
    slots AS (SELECT p.*, b.bucket, greatest(1, {packing.BATCH_TOKENS} // greatest(p.bound, 1)) AS per,
        row_number() OVER (PARTITION BY p.bound ORDER BY doc_id NULLS FIRST, piece) - 1 AS slot FROM placed p JOIN bounds b USING (bound))
    SELECT doc_id, piece, start, n_tokens, cast(bucket AS integer) AS bucket, bound, cast(slot // per AS bigint) AS batch,
        cast(slot % per AS bigint) AS place FROM slots"""


_CRC = """crc_table AS (SELECT list(v ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM (SELECT unnest(range(256)) AS i))),
    coded AS (SELECT doc_id, octet_length(encode(text)) AS n, hex(encode(text)) AS h FROM texts),
    crcs AS (SELECT doc_id, n, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(h, '..'), lambda x:
        cast(16 * (strpos('0123456789ABCDEF', x[1]) - 1) + strpos('0123456789ABCDEF', x[2]) - 1 AS bigint))),
        lambda c, b: xor(c >> 8, tab[cast(xor(c, b) & 255 AS integer) + 1]))) AS crc FROM coded, crc_table)"""

_SHARDS = f"""WITH RECURSIVE {_TEXTS}, {_CRC},
    ids AS (SELECT DISTINCT doc_id FROM documents),
    jumps AS (
        SELECT doc_id, cast(-1 AS bigint) AS b, cast(0 AS bigint) AS j, cast(coalesce(doc_id, 0) AS hugeint) + CASE WHEN doc_id < 0 THEN 18446744073709551616 ELSE 0 END AS key, 0 AS step FROM ids
        UNION ALL
        SELECT doc_id, j, cast(floor((j + 1) * (2147483648e0 / cast((new // 8589934592) + 1 AS double))) AS bigint), new, step + 1
        FROM (SELECT *, ((key % 4294967296) * {sharding.MULTIPLIER} + 1
            + ((key // 4294967296) * {sharding.MULTIPLIER % 2**32} % 4294967296) * 4294967296) % 18446744073709551616 AS new
            FROM jumps WHERE j < 8)
    ),
    ends AS (SELECT doc_id, arg_max(b, step) AS shard, arg_max(j, step) AS j FROM jumps GROUP BY doc_id)
    SELECT c.doc_id, n + 1 AS size, crc AS text_crc32, 'key' AS law, cast(shard AS integer) AS shard,
        cast(CASE WHEN j = 8 THEN 8 ELSE shard END AS integer) AS grown_shard,
        row_number() OVER (PARTITION BY shard ORDER BY c.doc_id NULLS FIRST, crc, n) - 1 AS slot
    FROM crcs c JOIN ends e ON c.doc_id IS NOT DISTINCT FROM e.doc_id"""

_RULES = ", ".join(f"('{verdict}', '{rule.partition('/')[0]}', '/{rule.partition('/')[2]}')" for verdict, rule in queries.URL_RULES)

_URLS = f"""WITH rests AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    split AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
    rules(verdict, host, path) AS (VALUES {_RULES}),
    fits AS (SELECT s.page_id, s.host, s.path, r.host || r.path AS rule, r.verdict,
        row_number() OVER (PARTITION BY s.page_id ORDER BY length(r.host || r.path) DESC NULLS LAST, length(r.host) DESC) AS place
        FROM split s LEFT JOIN rules r ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path))
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE place = 1"""

_WARC = """WITH told AS (SELECT page_id, replace(replace(replace(url, chr(13), '%0D'), chr(10), '%0A'), ' ', '%20') AS request_uri, strlen(coalesce(html, '')) AS bytes, sha256(coalesce(html, '')) AS digest FROM pages),
    firsts AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM told)
    SELECT page_id, request_uri, bytes AS payload_bytes, digest AS payload_digest,
        CASE WHEN bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN bytes >= 100 AND page_id <> first THEN first END AS refers_to FROM firsts"""

_QUALITY = rf"""WITH {_TEXTS}, split AS (SELECT doc_id, text, regexp_extract_all(text, '{_WORD}') AS words,
        list_filter(string_split(text, chr(10)), lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines FROM texts),
    windows AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM split)),
    twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1),
    covered AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS k FROM twice) GROUP BY doc_id),
    base AS (SELECT s.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, len(lines) AS n_lines,
        length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g')) AS n_upper FROM split s LEFT JOIN covered c USING (doc_id)),
    marked AS (SELECT *, cast(n_words < 50 AS bigint) + 2 * cast(100 * n_repeat_words > 50 * n_words AS bigint)
        + 4 * cast(10 * n_symbols > 3 * n_words AS bigint) + 8 * cast(2 * n_dup_lines > n_lines AS bigint)
        + 16 * cast(word_chars < 2 * n_words OR word_chars > 15 * n_words AS bigint) + 32 * cast(2 * n_upper > word_chars AS bigint) AS failed FROM base)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed, failed & 3 <> 0 AS base_failed, failed = 0 AS kept,
        CASE failed {" ".join(f"WHEN {1 << r.bit} THEN '{r.name}'" for r in quality_rules.RULES)} END AS only_rule,
        CASE WHEN failed <> 0 AND failed & (failed - 1) = 0 THEN count(*) OVER (PARTITION BY failed) END AS only_rule_docs FROM marked"""


def _secrets() -> str:
    parts = []
    for rank, rule in enumerate(secret_scan.RULES):
        pattern = _quoted(rule.pattern)
        kept = f"length(regexp_extract(m[i], {pattern}, 1)) >= {rule.least}" if rule.least else "true"
        parts.append(
            f"""SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind, e - length(m[i]) AS s, e FROM (
            SELECT doc_id, m, i, list_sum(list_transform(g[1:i], lambda x: length(x))) + list_sum(list_transform(m[1:i], lambda x: length(x))) AS e FROM (
            SELECT doc_id, string_split_regex(text, {pattern}) AS g, m, unnest(range(1, len(m) + 1)) AS i FROM (
            SELECT doc_id, text, regexp_extract_all(text, {pattern}) AS m FROM texts))) WHERE {kept}"""
        )
    span = "kind || ':' || cast(s AS bigint) || ':' || cast(e AS bigint)"
    return f"""WITH {_TEXTS}, spans AS ({" UNION ALL ".join(parts)}),
    found AS (SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
        string_agg({span}, ',' ORDER BY s, rank) FILTER (rank < 3) AS base, string_agg({span}, ',' ORDER BY s, rank) AS spans FROM spans GROUP BY doc_id)
    SELECT t.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
        sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM texts t LEFT JOIN found USING (doc_id)"""


_NEAR = f"""WITH RECURSIVE {_TEXTS},
    split AS (SELECT doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w FROM texts),
    shingles AS (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 1 THEN [w[1]]
        ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM split)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b WHERE 100 * k >= 80 * (x.n + y.n - k)),
    edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reached AS (SELECT doc_id, doc_id AS r FROM texts UNION SELECT reached.doc_id, edges.b FROM reached JOIN edges ON edges.a = reached.r),
    roots AS (SELECT doc_id, min(r) AS component_id FROM reached GROUP BY doc_id)
    SELECT t.doc_id, coalesce(n, 0) AS n_shingles, component_id, t.doc_id = component_id AS kept
    FROM texts t JOIN roots USING (doc_id) LEFT JOIN sizes USING (doc_id)"""


def _print(text: str) -> str:
    digest = f"substr(md5(x), 1, {fingerprints.LEAF_DIGITS})"
    leaves = f"array_to_string(list_transform(regexp_extract_all(line, {_quoted(fingerprints.LEAF)}), lambda x: {digest}), '.')"
    closed = "p || CASE WHEN regexp_matches(md5(p), '^[0-3]') THEN ';' ELSE ',' END"
    paragraphs = f"list_transform(string_split({text}, chr(10)), lambda line: {leaves})"
    return f"regexp_replace(array_to_string(list_transform({paragraphs}, lambda p: {closed}), ''), '[,;]$', '')"


def _rooted(body: str, text: str) -> str:
    section = "md5(array_to_string(list_transform(string_split(s, ','), lambda p: md5(p)), ','))"
    hashes = f"array_to_string(list_transform(string_split({body}, ';'), lambda s: {section}), ',')"
    return f"sha256({hashes} || ',' || sha256({text})) || '|' || {body}"


def _changed(old: str, new: str) -> str:
    """Places of the sections of one body that the other does not have, joined by commas."""

    def hashes(body: str) -> str:
        section = "md5(array_to_string(list_transform(string_split(s, ','), lambda p: md5(p)), ','))"
        return f"list_transform(string_split({body}, ';'), lambda s: {section})"

    places = f"list_filter(range(len({hashes(new)})), lambda i: NOT list_contains({hashes(old)}, ({hashes(new)})[i + 1]))"
    return f"coalesce(array_to_string({places}, ','), '')"


def _likeness(a: str, b: str) -> str:
    def leaves(of: str) -> str:
        return f"list_filter(list_distinct(string_split_regex({of}, '[.,;]')), lambda x: x <> '')"

    common = f"len(list_intersect({leaves(a)}, {leaves(b)}))"
    total = f"(len({leaves(a)}) + len({leaves(b)}) - {common})"
    return f"CASE WHEN {total} > 0 THEN cast({common} AS double) / {total} ELSE 0e0 END"


_PRINTS = f"""WITH {_TEXTS},
    ringed AS (SELECT *, coalesce(lead(text) OVER w, first_value(text) OVER w) AS after FROM texts WINDOW w AS (ORDER BY doc_id DESC NULLS LAST, md5(text))),
    halved AS (SELECT *, substr(text, 1, length(text) - length(text) // 2) || CASE WHEN length(text) < 2 THEN '' ELSE substr(after, 1, length(text) // 2) END AS edited FROM ringed),
    bodies AS (SELECT *, {_print('text')} AS b, {_print('edited')} AS eb, {_print('after')} AS ab FROM halved)
    SELECT doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256, {_rooted('b', 'text')} AS fingerprint,
        {_rooted('eb', 'edited')} AS edited_fingerprint,
        CASE WHEN text = edited THEN 1e0 ELSE {_likeness('b', 'eb')} END AS near_edited,
        CASE WHEN text = after THEN 1e0 ELSE {_likeness('b', 'ab')} END AS near_next,
        CASE WHEN text = edited THEN '' ELSE {_changed('b', 'eb')} END AS changed_sections FROM bodies"""



def _repair() -> str:
    def plus(weight: str, cost: str, letter: str) -> str:
        return f"(lpad(cast(cast(left({weight}, 8) AS bigint) + {cost} AS varchar), 8, '0') || substr({weight}, 9) || '{letter}')"

    def kept(initial: str, *states: str) -> str:
        ways = ", ".join(plus(s, "t", "K") for s in states)
        return f"CASE WHEN NOT gone AND ini = '{initial}' THEN least({ways}) END"

    after_u, after_a = f"least({plus('s0', '2', 'I')}, {plus('s1', '2', 'I')}, {plus('s3', '2', 'I')}, s2)", f"least(s3, {plus('u', '2', 'I')})"
    rerole = ", ".join(plus(s, "2 + t", "R") for s in ("s0", "s1", "a"))
    step = f"""SELECT conv_id, i + 1, {plus("s0", "3", "D")}, least({plus("s1", "3", "D")}, {kept("s", "s0")}),
        least({plus("u", "3", "D")}, {kept("u", "s0", "s1", "a")}, CASE WHEN NOT gone THEN least({rerole}) END),
        least({plus("a", "3", "D")}, {kept("a", "u")}, CASE WHEN NOT gone THEN {plus("u", "2 + t", "R")} END)"""
    inserted = f"(SELECT *, {after_a} AS a FROM (SELECT *, {after_u} AS u FROM"
    return rf"""WITH RECURSIVE texts AS (SELECT DISTINCT key AS doc_id, key AS text FROM (SELECT coalesce(cast(conv_id AS varchar), ' ') || ':' ||
        coalesce(cast(turn AS varchar), ' ') AS key FROM conversations)), {_CRC},
    fates AS (SELECT c.conv_id, turn, coalesce(text, ' ') AS x, coalesce(role, ' ') AS r, crc % 20 AS fate FROM conversations c
        JOIN crcs ON doc_id = coalesce(cast(conv_id AS varchar), ' ') || ':' || coalesce(cast(turn AS varchar), ' ')),
    hit AS (SELECT conv_id, turn, CASE fate WHEN 4 THEN 'user' ELSE r END AS role,
        CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(x, '[.!?]', '', 'g') ELSE x END AS text, unnest(range(CASE fate WHEN 3 THEN 2 ELSE 1 END)) AS copy
        FROM fates WHERE fate <> 0),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS pos FROM hit),
    faults AS (SELECT *, left(role, 1) AS ini, regexp_matches(text, '[^ 	-
]') AS said, regexp_matches(text, '[.!?][ 	-
]*\z') AS ended,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS nth, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM placed),
    rows_ AS (SELECT *, NOT said AS blank, said AND nth > 1 AS duplicate, said AND nth = 1 AND NOT ended AS truncated, NOT said OR nth > 1 AS gone,
        cast(said AND nth = 1 AND NOT ended AS integer) AS t FROM faults),
    counts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
        count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
        count(*) FILTER (before || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM rows_ GROUP BY conv_id),
    lightest AS (SELECT conv_id, cast(0 AS bigint) AS i, '00000000' AS s0, cast(NULL AS varchar) AS s1, cast(NULL AS varchar) AS s2,
        cast(NULL AS varchar) AS s3 FROM counts UNION ALL {step} FROM {inserted}
        (SELECT l.*, r.ini, r.gone, r.t FROM lightest l JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.pos = l.i + 1)))),
    goals AS (SELECT conv_id, least(s0, a) AS w FROM {inserted} (SELECT l.* FROM lightest l JOIN counts c ON c.conv_id IS NOT DISTINCT FROM l.conv_id AND l.i = c.n)))),
    audits AS (SELECT conv_id, cast(left(w, 8) AS bigint) AS cost, substr(w, 9) AS audit FROM goals),
    letters AS (SELECT conv_id, audit, k, audit[k] AS letter, k - length(replace(audit[1:k], 'I', '')) AS inserted, length(replace(audit[1:k], 'D', '')) AS place,
        length(replace(audit, 'D', '')) AS size FROM (SELECT *, unnest(range(1, length(audit) + 1)) AS k FROM audits)),
    lines AS (SELECT l.conv_id, k, CASE letter WHEN 'K' THEN role WHEN 'D' THEN NULL ELSE CASE WHEN (place + size) % 2 = 1 THEN 'user' ELSE 'assistant' END END
        || ':' || CASE letter WHEN 'I' THEN '' ELSE text END AS line
        FROM letters l LEFT JOIN rows_ r ON letter <> 'I' AND r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.pos = k - inserted),
    whole AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY k) AS body FROM lines GROUP BY conv_id)
    SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
        coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN whole w ON w.conv_id IS NOT DISTINCT FROM o.conv_id"""


_TRIE = f"""WITH texts AS (SELECT DISTINCT conv_id AS doc_id, cast(conv_id AS varchar) AS text FROM conversations WHERE conv_id IS NOT NULL), {_CRC},
    convs AS (SELECT doc_id AS conv_id, crc % 4 AS h, doc_id - doc_id % 20 AS base FROM crcs),
    own AS (SELECT conv_id, md5(length(r) || ':' || r || x) AS key, len(regexp_extract_all(x, '{_WORD}')) AS words,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(r) || ':' || r || x)) - 1 AS slot
        FROM (SELECT *, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations)),
    rebuilt AS (SELECT c.conv_id, 0 AS part, slot, key, words FROM convs c JOIN own o ON o.conv_id = c.base WHERE slot < h
        UNION ALL SELECT c.conv_id, 1, slot, key, words FROM convs c JOIN own o USING (conv_id) WHERE slot >= h),
    members AS (SELECT conv_id, row_number() OVER w AS depth, string_agg(key, '') OVER w AS path, words FROM rebuilt
        WINDOW w AS (PARTITION BY conv_id ORDER BY part, slot) UNION ALL SELECT conv_id, 0, '', 0 FROM convs),
    totals AS (SELECT conv_id, max(depth) AS total FROM members GROUP BY conv_id),
    nodes AS (SELECT path, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
        coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (depth = total), '') AS ends FROM members JOIN totals USING (conv_id) GROUP BY path),
    kids AS (SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes k WHERE k.depth = n.depth + 1 AND starts_with(k.path, n.path)) AS n_children
        FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.path = substr(n.path, 1, 32 * (n.depth - 1)))
    SELECT n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children, count(*) FILTER (s.n_children = 0) AS n_leaves,
        cast(sum((s.n_convs - 1) * s.words) AS bigint) AS saved_tokens, sha256(n.ends) AS ends_sha256
    FROM kids n JOIN kids s ON starts_with(s.path, n.path) GROUP BY ALL"""

SQL: dict[str, str] = {
    "op1_length_buckets": _packing(),
    "op2_jump_shards": _SHARDS,
    "op3_url_sweep": _URLS,
    "op4_warc_captures": _WARC,
    "op6_rule_ledger": _QUALITY,
    "op7_secret_ledger": _secrets(),
    "op9_chosen_path": _NEAR,
    "op10_merkle_prints": _PRINTS,
    "op11_lightest_repair": _repair(),
    "op12_ternary_trie": _TRIE,
}
