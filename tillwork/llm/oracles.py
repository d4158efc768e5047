"""SQL for the results of the operators that SQL can express."""

from tillwork.llm.sharding import BITS, DIMENSIONS

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _node(url: str) -> str:
    bare = f"regexp_extract({url}, '(?s)^([^#]*)', 1)"
    scheme = _LOWER.format(f"regexp_extract({bare}, '(?s)^(.*?)://', 1)")
    host = _LOWER.format(f"regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1)")
    return f"CASE WHEN contains({url}, '://') THEN {scheme} || '://' || {host} || regexp_extract({bare}, '(?s)^.*?://[^/?]*(.*)$', 1) ELSE {bare} END"


def _any_scheme(address: str) -> str:
    return f"regexp_replace({address}, '^https://', 'http://')"


def _rules(rules: list[tuple[str, str, str]], then) -> str:
    cases = [
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{then(h, p, w)}'"
        for h, p, w in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    ]
    return f"CASE {' '.join(cases)} END"


def license_scan(templates: list) -> str:
    words = ", ".join(
        f"({t}, {q}, '{w}', {x.key_from <= q < x.key_to})" for t, x in enumerate(templates) for q, w in enumerate(x.words)
    )
    kinds = ", ".join(f"({t}, '{x.label}', {len(x.words)}, {x.key_to - x.key_from}, {x.base})" for t, x in enumerate(templates))
    lowered = _LOWER.format("coalesce(text, '')")
    return f"""
WITH template_words(t, q, word, is_key) AS (VALUES {words}), kinds(t, label, n, n_key, is_base) AS (VALUES {kinds}),
split AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({lowered}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents
), placed AS (
  SELECT row, unnest(words) AS word, unnest(range(len(words))) AS p FROM split
), proposals AS (
  SELECT row, t, p - q AS start, count(*) AS hits, count(*) FILTER (is_key) AS key_hits FROM placed JOIN template_words USING (word) GROUP BY ALL
), found AS (
  SELECT row, label, start, is_base, hits / n AS share FROM proposals JOIN kinds USING (t) WHERE key_hits = n_key
), summed AS (
  SELECT row, count(*) FILTER (is_base) AS n_base, min(start) FILTER (is_base) AS first_word, max(start) FILTER (is_base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM found GROUP BY row
)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM split LEFT JOIN summed USING (row)
"""


NGRAM_JOIN = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), nodes AS (
  SELECT words, min(doc_id) AS node, count(*) AS copies FROM split WHERE len(words) > 0 GROUP BY words
), grams AS (
  SELECT DISTINCT node, hash(words[p:p + 4]) AS gram FROM (SELECT node, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS p FROM nodes)
), sizes AS (
  SELECT node, count(*) AS n FROM grams GROUP BY node
), pairs AS (
  SELECT a.node AS a, b.node AS b, count(*) AS shared FROM grams a JOIN grams b ON a.gram = b.gram AND a.node < b.node GROUP BY ALL
), linked AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.node = a JOIN sizes y ON y.node = b WHERE shared / (x.n + y.n - shared) >= 0.8
), both_ways AS (
  SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked
), reach(node, other) AS (
  SELECT a, a FROM both_ways UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON e.a = r.other
), classes AS (
  SELECT node, min(other) AS class_id FROM reach GROUP BY node
), counts AS (
  SELECT a AS node, sum(copies)::BIGINT AS links FROM both_ways JOIN nodes ON nodes.node = b GROUP BY a
)
SELECT doc_id, coalesce(class_id, node, doc_id) AS class_id, coalesce(links, 0) + coalesce(copies, 1) - 1 AS links
FROM split LEFT JOIN nodes USING (words) LEFT JOIN classes USING (node) LEFT JOIN counts USING (node)
"""


def url_filter(rules: list[tuple[str, str, str]]) -> str:
    split = "coalesce(" + _LOWER.format("regexp_extract({0}, '(?s)^.*?://([^/?#]*)', 1)") + ", '') AS host, coalesce(regexp_extract({0}, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path"
    verdict = _rules(rules, lambda h, p, w: w)
    return f"""
WITH RECURSIVE tags AS (
  SELECT url, unnest(regexp_extract_all(html, '(?is)(<(?:link|meta)\\s[^>]*>)', 1)) AS tag FROM pages WHERE url IS NOT NULL
), found AS (
  SELECT url, replace(CASE
    WHEN regexp_matches(tag, '(?is)^<link\\s(?:.*\\s)?rel\\s*=\\s*["'']?canonical["''\\s/>]') THEN regexp_extract(tag, '(?is)\\shref\\s*=\\s*["'']?([^"''\\s>]+)', 1)
    WHEN regexp_matches(tag, '(?is)^<meta\\s(?:.*\\s)?http-equiv\\s*=\\s*["'']?refresh["''\\s/>]') THEN regexp_extract(tag, '(?is)\\scontent\\s*=\\s*["'']?[^"''>]*?url\\s*=\\s*["'']?([^"''\\s>]+)', 1)
  END, '&amp;', '&') AS t, regexp_extract(url, '(?s)^(.*?://[^/?#]*(?:/[^?#]*/|/)?)', 1) AS folder FROM tags
), targets AS (
  SELECT url, CASE WHEN regexp_matches(t, '(?s)^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN t
    WHEN starts_with(t, '//') THEN regexp_extract(url, '(?s)^(.*?)://', 1) || ':' || t
    WHEN starts_with(t, '/') THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || t
    ELSE folder || CASE WHEN ends_with(folder, '/') THEN '' ELSE '/' END || t END AS target
  FROM found WHERE t <> ''
), linked AS (
  SELECT DISTINCT * FROM (SELECT {_node('url')} AS src, {_node('target')} AS dst FROM targets) WHERE src <> dst
), ends AS (  -- http and https are one where links meet them
  SELECT src AS address, {_any_scheme('src')} AS id FROM linked UNION SELECT dst, {_any_scheme('dst')} FROM linked
), links AS (
  SELECT {_any_scheme('src')} AS a, {_any_scheme('dst')} AS b FROM linked
), both_ways AS (
  SELECT a, b FROM links WHERE a <> b UNION SELECT b, a FROM links WHERE a <> b
), reach(id, other) AS (
  SELECT id, id FROM ends UNION SELECT r.id, e.b FROM reach r JOIN both_ways e ON e.a = r.other
), decided AS (
  SELECT id, other, {verdict} AS d FROM (SELECT id, other, {split.format('other')} FROM reach)
), shared AS (
  SELECT decided.id, min(address) AS resource, CASE WHEN bool_or(d = 'allow') THEN 'allow' WHEN bool_or(d = 'block') THEN 'block' END AS s
  FROM decided JOIN ends ON ends.id = decided.other GROUP BY decided.id
), judged AS (
  SELECT page_id, {_node('url')} AS node, {split.format('url')} FROM pages
)
SELECT page_id, host, path, {_rules(rules, lambda h, p, w: h + p)} AS rule, coalesce({verdict}, s, 'allow') AS verdict, coalesce(resource, node) AS resource
FROM judged LEFT JOIN shared ON shared.id = {_any_scheme('node')}
"""


TOP_PRODUCTS = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM vectors q JOIN vectors d ON q.vec_id % 100 = 0 AND q.vec_id <> d.vec_id AND len(q.v) = len(d.v)
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


MIX = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents
), ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size, 2.0::DOUBLE * sum(size) AS most, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM sized GROUP BY source
), weighted AS (
  SELECT *, [3, 1, 2][(rank % 3 + 1)::INT] AS weight, sum(source_size) OVER () AS total FROM ranked
), filled AS (
  SELECT *, coalesce(sum(most) OVER (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken_before,
    sum(weight) OVER (ORDER BY most / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight FROM weighted
), level AS (
  SELECT coalesce((SELECT (1.5::DOUBLE * total - taken_before) / open_weight FROM filled
    WHERE NOT most < weight * ((1.5::DOUBLE * total - taken_before) / open_weight) ORDER BY most / weight, rank LIMIT 1), 'inf'::DOUBLE) AS level
), goal AS (
  SELECT source, source_size, rank, CASE WHEN weight * level > most THEN most ELSE weight * level END AS target FROM filled, level
), queued AS (
  SELECT doc_id, size, source_size, rank, target,
    sum(size) OVER (PARTITION BY rank ORDER BY md5('mix:' || coalesce(doc_id::VARCHAR, '')), doc_id NULLS LAST, size ROWS UNBOUNDED PRECEDING) AS done
  FROM sized JOIN goal ON sized.source IS NOT DISTINCT FROM goal.source
), copies AS (
  SELECT rank, done, size, (done + epoch * source_size) / target AS finish FROM queued, (VALUES (0), (1)) e(epoch) WHERE size > 0
), ordered AS (
  SELECT *, sum(size) OVER (ORDER BY finish, rank, done ROWS UNBOUNDED PRECEDING) AS until FROM copies
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY finish, rank, done) AS n FROM ordered
), kept AS (
  SELECT rank, done, sum(size)::BIGINT AS taken FROM numbered
  WHERE n < coalesce((SELECT min(n) FROM numbered WHERE until > (SELECT 1.5::DOUBLE * sum(size) FROM sized)), 9e18) GROUP BY rank, done
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM queued LEFT JOIN kept ON kept.rank = queued.rank AND kept.done = queued.done AND queued.size > 0
"""


def hilbert_shards(shards: int) -> str:
    """The curve index step by step, one subquery for each step of the transform."""
    cells, top = 1 << BITS, BITS - 1
    ctes = [
        "rows_ AS (SELECT doc_id, source, lang, coalesce(strlen(text), 0) + 1 AS size, 0 AS text_crc32 FROM documents)",
    ]
    for c in DIMENSIONS:
        ctes.append(
            f"start_{c} AS (SELECT list(least ORDER BY least) AS starts FROM (SELECT min(value) AS least FROM (SELECT value, floor((sum(n) OVER (ORDER BY value) - n) * {cells} / sum(n) OVER ()) AS cell "
            f"FROM (SELECT {c} AS value, count(*) AS n FROM rows_ WHERE {c} IS NOT NULL GROUP BY 1)) GROUP BY cell))"
        )
    n = len(DIMENSIONS)
    quantised = ", ".join(f"coalesce(len(list_filter((SELECT starts FROM start_{c}), lambda s: s <= {c})) - 1, 0)::BIGINT AS x{i}" for i, c in enumerate(DIMENSIONS))
    ctes.append(f"y0 AS (SELECT doc_id, size, {quantised} FROM rows_)")
    step, xs = 0, [f"x{i}" for i in range(n)]

    def add(changes: dict[str, str]) -> None:
        nonlocal step
        kept = ", ".join(f"{changes.get(x, x)} AS {x}" for x in xs)
        ctes.append(f"y{step + 1} AS (SELECT doc_id, size, {kept}{', ' + changes['gray'] + ' AS gray' if 'gray' in changes else ''} FROM y{step})")
        step += 1

    for b in range(top, 0, -1):
        q, low = 1 << b, (1 << b) - 1
        for i in range(n):
            swap = f"CASE WHEN x{i} & {q} <> 0 THEN 0 ELSE xor(x0, x{i}) & {low} END"
            changes = {"x0": f"xor(x0, CASE WHEN x{i} & {q} <> 0 THEN {low} ELSE xor(x0, x{i}) & {low} END)"}
            if i:
                changes[f"x{i}"] = f"xor(x{i}, {swap})"
            add(changes)
    for i in range(1, n):
        add({f"x{i}": f"xor(x{i}, x{i - 1})"})
    gray = "0"
    for b in range(top, 0, -1):
        gray = f"xor({gray}, CASE WHEN x{n - 1} & {1 << b} <> 0 THEN {(1 << b) - 1} ELSE 0 END)"
    add({"gray": gray})
    bits = [f"(((xor(x{i}, gray) >> {b}) & 1) << {b * n + n - 1 - i})" for b in range(BITS) for i in range(n)]
    ctes.append(f"placed AS (SELECT doc_id, size, {' + '.join(bits)} AS curve FROM y{step})")
    ctes.append("numbered AS (SELECT *, row_number() OVER (ORDER BY curve, doc_id NULLS LAST, size) - 1 AS i, count(*) OVER () AS total FROM placed)")
    return (
        f"WITH {', '.join(ctes)} SELECT doc_id, size, (i * {shards}) // total AS shard, "
        f"i - (((i * {shards}) // total) * total + {shards - 1}) // {shards} AS slot FROM numbered"
    )


PREFIX_TRIE = """
WITH placed AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS depth
  FROM conversations WHERE conv_id IS NOT NULL
), held AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY depth) AS turns FROM placed GROUP BY conv_id
), crc AS (  -- the unsigned CRC-32 of the decimal conv_id, bit by bit
  SELECT conv_id, conv_id - conv_id % 5 AS first_id, xor(4294967295::BIGINT, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: xor(x >> 1, 3988292384::BIGINT * (x & 1)))
  )) % 9 AS h FROM held
), rebuilt AS (
  SELECT c.conv_id, coalesce(f.turns, [])[1:h] || o.turns[h + 1:] AS turns
  FROM crc c JOIN held o USING (conv_id) LEFT JOIN held f ON f.conv_id = c.first_id
), prefixes AS (
  SELECT conv_id, unnest(range(len(turns) + 1)) AS depth, turns FROM rebuilt
), nodes AS (
  SELECT turns[1:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    list(conv_id ORDER BY conv_id) FILTER (len(turns) = depth) AS ends
  FROM prefixes GROUP BY ALL
), children AS (
  SELECT node[1:depth - 1] AS node, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), shaped AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN n.depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(n.node[n.depth].text) END AS own
  FROM nodes n LEFT JOIN children c ON c.depth = n.depth AND c.node = n.node
), up AS (
  SELECT node[1:top] AS node, top AS depth, n_children, own FROM (SELECT *, unnest(range(depth + 1)) AS top FROM shaped)
), sums AS (
  SELECT node, depth, count(*) FILTER (n_children = 0) AS n_leaves, sum(own)::BIGINT AS saved_tokens FROM up GROUP BY ALL
)
SELECT s.conv_id, s.depth, p.conv_id AS parent_conv_id, s.n_convs, s.n_children, n_leaves, saved_tokens,
  sha256(coalesce(array_to_string(s.ends, ','), '')) AS ends_sha256
FROM shaped s JOIN sums USING (node, depth) LEFT JOIN nodes p ON p.depth = s.depth - 1 AND p.node = s.node[1:s.depth - 1]
"""


LEXICAL_SEARCH = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents
), items AS (
  SELECT row_number() OVER () AS item, item_id, list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS words FROM benchmark
), corpus AS (
  SELECT count(*) AS n_docs, sum(len(words))::BIGINT AS total FROM docs WHERE len(words) > 0
), asked AS (
  SELECT item, item_id, unnest(words) AS term FROM items
), counts AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(words) AS term FROM docs) WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM counts, corpus GROUP BY term, n_docs
), impacts AS (
  SELECT row, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(words) * n_docs) // total))) AS impact
  FROM counts JOIN weights USING (term) JOIN docs USING (row), corpus
), scored AS (
  SELECT item, item_id, row, sum(impact)::BIGINT AS score FROM asked JOIN impacts USING (term) GROUP BY ALL
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
  FROM scored JOIN docs USING (row) WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10
"""
