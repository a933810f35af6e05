"""SQL that must give the same rows as the queries, for those that SQL can express."""

from __future__ import annotations

from askloom.llm import secrets
from askloom.llm.url_reputation import LEAST_RHO, LONG_SUFFIXES, MOST_RHO, Rule

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _shingles(table: str, key: str) -> str:
    """Distinct (key, s) of a table of texts."""
    return f"""SELECT DISTINCT {key}, unnest(CASE
                   WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                   WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
               FROM (SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                                      '[^\\x20\\x09-\\x0D]+') AS w FROM {table})"""


_REACH = """reach AS (SELECT {key} AS node, {key} AS c FROM {table} UNION
                      SELECT l.b, r.c FROM reach r JOIN both_ways l ON l.a = r.node)"""

JACCARD = f"""
    WITH RECURSIVE s AS MATERIALIZED ({_shingles('documents', 'doc_id')}),
    sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
              WHERE 100 * shared.n >= 75 * (p.n + q.n - shared.n)),
    both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    {_REACH.format(key='doc_id', table='documents')}
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
    FROM (SELECT node AS doc_id, min(c) AS component_id FROM reach GROUP BY node) LEFT JOIN sizes USING (doc_id)"""

CONTAINMENT = f"""
    WITH s AS MATERIALIZED ({_shingles('documents', 'doc_id')}),
    i AS MATERIALIZED ({_shingles('benchmark', 'item_id')}),
    sizes AS (SELECT item_id, count(*) AS n FROM i GROUP BY item_id)
    SELECT doc_id, item_id, count(*) AS n_shared, any_value(n) AS n_item, count(*) / any_value(n) AS containment
    FROM i JOIN s USING (s) JOIN sizes USING (item_id) GROUP BY doc_id, item_id HAVING 4 * count(*) >= 3 * any_value(n)"""

EMBEDDINGS = f"""
    WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
    links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id < y.vec_id
              WHERE list_cosine_similarity(x.e, y.e) >= 0.98),
    both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    {_REACH.format(key='vec_id', table='v')},
    degrees AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM (SELECT node AS vec_id, min(c) AS component_id FROM reach GROUP BY node) LEFT JOIN degrees ON a = vec_id"""


FILTER_AUDIT = """
    WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
    firsts AS (SELECT t, min(doc_id) AS least FROM d GROUP BY t),
    worded AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM d),
    failing AS MATERIALIZED (
        SELECT doc_id, part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
                              100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t),
                              regexp_matches(t, '[#$%&*|]'), doc_id > least] AS f
        FROM worded JOIN firsts USING (t)),
    known AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
    patterns AS MATERIALIZED (
        SELECT part, f, count(*) AS n, count(CASE WHEN good THEN 1 END) AS good, count(CASE WHEN toxic THEN 1 END) AS toxic
        FROM failing LEFT JOIN known USING (doc_id) GROUP BY part, f),
    orders AS (SELECT [1]::INTEGER[] AS o WHERE false UNION ALL
               SELECT [a, b, c, d, e]::INTEGER[] FROM range(1, 6) x(a), range(1, 6) y(b), range(1, 6) z(c), range(1, 6) u(d), range(1, 6) v(e)
               WHERE len(list_distinct([a, b, c, d, e])) = 5),
    steps AS (SELECT array_to_string(list_transform(o, lambda i: 'ABCDE'[i]), '') AS filter_order, s AS step, o[s] AS i, o[1:s - 1] AS before
              FROM orders, range(1, 6) r(s)),
    met AS (SELECT part, filter_order, step, i, n, good, toxic, f[i] AS fails,
                   coalesce(list_bool_or(list_transform(before, lambda k: f[k])), false) AS gone,
                   len(list_filter(f, lambda x: x)) AS failed
            FROM patterns, steps),
    counted AS (SELECT part, filter_order, step, i,
                       coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0)::BIGINT AS kept,
                       coalesce(sum(n) FILTER (fails AND NOT gone), 0)::BIGINT AS removed,
                       coalesce(sum(n) FILTER (fails AND gone), 0)::BIGINT AS redundant,
                       coalesce(sum(n) FILTER (fails AND failed = 1), 0)::BIGINT AS unique_fails,
                       coalesce(sum(good) FILTER (fails AND NOT gone), 0)::BIGINT AS good_lost,
                       coalesce(sum(toxic) FILTER (fails AND NOT gone), 0)::BIGINT AS toxic_lost
                FROM met GROUP BY part, filter_order, step, i)
    SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
           sum(removed) OVER (PARTITION BY part, i)::BIGINT AS shapley
    FROM counted"""

WINDOWS = """
    WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    windows AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s
                FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
    again AS MATERIALIZED (SELECT doc_id, i FROM (
        SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM windows) WHERE r > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM again),
    each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
             FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (doc_id)"""


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    step = "list_reduce([c] || range(8), lambda a, k: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)"
    bits = step.replace("[c]", "[xor(a, x)]").replace("lambda a, k", "lambda y, k").replace("a % 2", "y % 2").replace("a // 2", "y // 2")
    return (f"xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split({text}, ''), "
            f"lambda ch: ascii(ch)::BIGINT), lambda a, x: {bits}))")


PREFIX_TRIE = f"""
    WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
               FROM conversations WHERE conv_id IS NOT NULL),
    own AS MATERIALIZED (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY place) AS turns FROM t GROUP BY conv_id),
    cut AS (SELECT conv_id, turns, conv_id - conv_id % 20 AS base, ({_crc32('conv_id::VARCHAR')} % 4)::BIGINT AS h FROM own),
    rebuilt AS MATERIALIZED (
        SELECT c.conv_id, CASE WHEN c.base = c.conv_id THEN c.turns
                               ELSE list_concat(coalesce(b.turns[1:h], []), c.turns[h + 1:]) END AS turns
        FROM cut c LEFT JOIN own b ON b.conv_id = c.base),
    prefixes AS (SELECT conv_id, turns[1:d] AS p, d AS depth, len(turns) = d AS ends
                 FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
    nodes AS MATERIALIZED (
        SELECT p, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
               sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
        FROM prefixes GROUP BY p, depth),
    joined AS MATERIALIZED (
        SELECT n.*, q.conv_id AS parent_conv_id, (n.n_convs - 1) * CASE WHEN n.depth = 0 THEN 0
                   ELSE len(regexp_extract_all(n.p[n.depth].text, '[^\x20\x09-\x0D]+')) END AS saved
        FROM nodes n LEFT JOIN nodes q ON q.depth = n.depth - 1 AND q.p = n.p[1:n.depth - 1]),
    children AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM joined WHERE depth > 0 GROUP BY ALL),
    counted AS MATERIALIZED (SELECT j.*, coalesce(n_children, 0) AS n_children FROM joined j LEFT JOIN children USING (conv_id, depth)),
    above AS (SELECT p[1:d] AS p, d AS depth, saved, n_children FROM (
                  SELECT p, saved, n_children, unnest(range(0, depth + 1)) AS d FROM counted)),
    below AS (SELECT p, depth, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM above GROUP BY p, depth)
    SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
    FROM counted JOIN below USING (p, depth)"""


def url_rules(rules: tuple[Rule, ...], least: float = 0.5, z: float = 1.645) -> str:
    def choose(value: str) -> str:
        cases = " ".join(
            f"WHEN (host = {_quoted(r.host)} OR ends_with(host, {_quoted('.' + r.host)})) AND starts_with(path, {_quoted(r.path)}) "
            f"THEN {_quoted(getattr(r, value))}" for r in sorted(rules, key=lambda r: -len(r.place)))
        return f"CASE {cases} END"

    def level(name: str, units: str, parent: str) -> str:
        """Counts joined to the prior mean m, then shrunk with one strength for the level."""
        return f"""{name}_units AS (SELECT {units}, {parent}),
            {name}_rho AS (SELECT least({MOST_RHO}, greatest({LEAST_RHO}, coalesce(
                CASE WHEN sum(m * (1 - m) * (n - 1)) = 0 THEN NULL
                     ELSE sum(n * pow(k / n - m, 2) - m * (1 - m)) / sum(m * (1 - m) * (n - 1)) END, {MOST_RHO}))) AS rho
                FROM {name}_units WHERE n > 0),
            {name}s AS (SELECT u.*, 1 / rho - 1 AS s, (k + (1 / rho - 1) * m) / (n + 1 / rho - 1) AS mean
                        FROM {name}_units u, {name}_rho)"""

    long = ", ".join(map(_quoted, LONG_SUFFIXES))
    part = "array_to_string(string_split(host, '.')[-{}:], '.')"
    return f"""
        WITH p AS (SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
                          coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
        counted AS (SELECT host, count(quality) AS n, count(CASE WHEN quality = 1 THEN 1 END) AS k
                    FROM p LEFT JOIN labels ON page_id = doc_id GROUP BY host),
        placed AS (SELECT *, CASE WHEN {part.format(2)} IN ({long}) THEN {part.format(3)} ELSE {part.format(2)} END AS domain,
                          CASE WHEN {part.format(2)} IN ({long}) THEN {part.format(2)} ELSE {part.format(1)} END AS suffix FROM counted),
        {level('suffix', 'suffix, sum(n) AS n, sum(k) AS k',
               '(SELECT (sum(k) + 1) / (sum(n) + 2) FROM placed) AS m FROM placed GROUP BY suffix')},
        {level('domain', 'd.*', 'mean AS m FROM (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM placed GROUP BY ALL) d '
               'JOIN (SELECT suffix, mean FROM suffixs) USING (suffix)')},
        {level('host', 'h.*', 'mean AS m FROM placed h JOIN (SELECT domain, mean FROM domains) USING (domain)')}
        SELECT page_id, host, path, {choose('place')} AS rule,
               coalesce({choose('verdict')}, CASE WHEN mean - {z} * sqrt(mean * (1 - mean) / (n + s + 1)) >= {least}
                                                  THEN 'allow' ELSE 'block' END) AS verdict
        FROM p JOIN (SELECT host, mean, n, s FROM hosts) USING (host)"""


def _found(pattern: str) -> str:
    """Array of (start, end, found) of a pattern's matches in t."""
    m, gaps = f"regexp_extract_all(t, {_quoted(pattern)})", f"string_split_regex(t, {_quoted(pattern)})"
    return f"""list_transform(range(1, len({m}) + 1), lambda i: struct_pack(
                 s := CAST(list_sum(list_transform(({gaps})[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(({m})[1:i - 1], lambda g: length(g))), 0) AS INTEGER),
                 e := CAST(list_sum(list_transform(({gaps})[1:i], lambda g: length(g))) + list_sum(list_transform(({m})[1:i], lambda g: length(g))) AS INTEGER),
                 found := ({m})[i]))"""


def secret_spans(max_owners: int = 2, max_repos: int = 3) -> str:
    group = f"regexp_extract(x.found, {_quoted(secrets.ASSIGN)}, 2)"
    apart = "NOT coalesce(list_bool_or(list_transform({others}, lambda b: x.s < b.e AND b.s < x.e)), false)"

    live = (f"NOT regexp_matches(lower(x.found), {_quoted(secrets.NOT_LIVE)}) AND "
            f"len(list_distinct(regexp_extract_all(x.found, '.'))) >= {secrets.LEAST_DISTINCT}")

    def kind(rank: int, spans: str, value: str = "x.found") -> str:
        return f"list_transform({spans}, lambda x: struct_pack(s := x.s, r := {rank}, e := x.e, v := {value}, l := {live}))"

    name = "CASE x.r " + " ".join(f"WHEN {k} THEN '{n}'" for k, n in enumerate(secrets.KINDS)) + " END"

    def joined(spans: str) -> str:
        return f"coalesce(array_to_string(list_transform(list_sort({spans}), lambda x: {name} || ':' || x.s || ':' || x.e), ','), '')"

    return f"""
        WITH d AS (SELECT doc_id, source AS owner, concat_ws('/', source, lang) AS repo, coalesce(text, '') AS t FROM documents),
        raw AS (SELECT doc_id, owner, repo, {_found(secrets.ASSIGN)} AS a, {_found(secrets.ACCESS)} AS c, {_found(secrets.HEX)} AS h,
                       {_found(secrets.KNOWN)} AS k, {_found(secrets.MIXED)} AS m FROM d),
        based AS (SELECT doc_id, owner, repo, m, k, list_concat(
                      {kind(0, f"list_filter(a, lambda x: length({group}) >= {secrets.LEAST_VALUE})", group)},
                      {kind(1, 'c')}, {kind(2, 'h')}) AS base FROM raw),
        known AS (SELECT *, {kind(3, f"list_filter(k, lambda x: {apart.format(others='base')})")} AS kn,
                  list_concat(base, {kind(3, 'k')}) AS near FROM based),
        more AS (SELECT doc_id, owner, repo, base, list_concat(kn, {kind(4, "list_filter(m, lambda x: regexp_matches(x.found, '[0-9]') "
                 "AND regexp_matches(x.found, '[a-z]') AND regexp_matches(x.found, '[A-Z]') AND "
                 + apart.format(others='near') + ")")}) AS more FROM known),
        held AS (SELECT doc_id, owner, repo, unnest(list_concat(base, more)) AS x FROM more),
        owned AS (SELECT x.v AS v, count(DISTINCT coalesce('+' || owner, '')) AS o,
                         count(DISTINCT coalesce('+' || owner, '') || chr(9) || coalesce('+' || repo, '')) AS n FROM held GROUP BY x.v),
        judged AS (SELECT doc_id, list(x) FILTER (o <= {max_owners} AND n <= {max_repos} AND x.l AND x.r >= 3) AS added,
                          count(*) FILTER (o > {max_owners} OR n > {max_repos}) AS n_shared, max(o) AS most_owners, max(n) AS most_repos
                   FROM held JOIN owned ON held.x.v = owned.v GROUP BY doc_id)
        SELECT doc_id, len(list_filter(base, lambda x: x.r = 0)) AS n_assign, len(list_filter(base, lambda x: x.r = 1)) AS n_access,
               len(list_filter(base, lambda x: x.r = 2)) AS n_hex, sha256({joined('base')}) AS base_sha256,
               {joined('list_concat(base, coalesce(added, []))')} AS spans, coalesce(n_shared, 0) AS n_shared,
               coalesce(most_owners, 0) AS most_owners, coalesce(most_repos, 0) AS most_repos,
               coalesce(len(added), 0) AS n_added
        FROM more LEFT JOIN judged USING (doc_id)"""
