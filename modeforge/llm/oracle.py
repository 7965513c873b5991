"""The SQL of the queries that SQL can express, for DuckDB."""

from __future__ import annotations

from modeforge.llm import decontam, hashtree, lexsearch, mixing, spelling, urlbloom

_BLANK = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _unit(key: str, purpose: str) -> str:
    return f"((('0x' || substr(md5({key} || '|' || {purpose}), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)"


def _crc_table() -> list[int]:
    """The 256 remainders of the reflected polynomial EDB88320."""
    out = []
    for c in range(256):
        for _ in range(8):
            c = (c >> 1) ^ 0xEDB88320 if c & 1 else c >> 1
        out.append(c)
    return out


def _crc32(text: str) -> str:
    codes = f"list_transform(range(1, 2 * strlen({text}), 2), lambda i: ('0x' || substr(hex(encode({text})), i, 2))::BIGINT)"
    table = f"[{', '.join(f'{x}::BIGINT' for x in _crc_table())}]"
    step = f"lambda a, b: xor(a >> 8, list_extract({table}, (xor(a, b) & 255) + 1))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), {step}), 4294967295::BIGINT)"


def _op4() -> str:
    def descend(name: str, tree: list[hashtree.Leaf]) -> str:
        rows = ", ".join(f"('{x.region}', '{x.region}/{x.rack}', '{x.region}/{x.rack}/{x.shard}', {x.shard}, {x.weight!r}::DOUBLE)" for x in tree)
        out = f"{name}_t(region, rack, leaf, shard, weight) AS (VALUES {rows}), {name}_0 AS (SELECT r, key FROM d)"
        for depth, (level, parent) in enumerate((("region", "''"), ("rack", "region"), ("leaf", "rack")), 1):
            kids = f"SELECT {parent} AS parent, {level} AS child, min(shard) AS shard, sum(weight) AS w FROM {name}_t GROUP BY 1, 2"
            on = "TRUE" if depth == 1 else "k.parent = p.child"
            out += (
                f", {name}_{depth} AS (SELECT p.r, p.key, k.child, k.shard FROM {name}_{depth - 1} p JOIN ({kids}) k ON {on} "
                f"QUALIFY row_number() OVER (PARTITION BY p.r ORDER BY -ln({_unit('p.key', 'k.child')}) / k.w, k.child) = 1)"
            )
        return out

    tree = hashtree.regular_tree()
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce(doc_id::VARCHAR, '') AS key FROM documents),
{descend("now", tree)}, {descend("grown", hashtree.with_one_more(tree))},
q AS (SELECT r, {_crc32("d.text")} AS crc FROM d),
p AS (SELECT d.doc_id, (strlen(d.text) + 1)::BIGINT AS size, crc AS text_crc32, a.shard::INTEGER AS shard,
  b.shard::INTEGER AS grown_shard, {_unit("(d.key || '|' || crc)", "'slot'")} AS u FROM d JOIN q USING (r) JOIN now_3 a USING (r) JOIN grown_3 b USING (r))
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY u, doc_id, text_crc32, size) - 1 AS slot, grown_shard FROM p"""


_PAGES = f"""SELECT row_number() OVER () AS r, page_id, url,
  {_LOWER.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
  list_sort(list_filter(string_split(regexp_extract(coalesce(url, ''), '(?s)^.*?://[^?#]*\\?([^#]*)', 1), '&'),
    lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) AS kept FROM pages"""


def _op5() -> str:
    rules = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in urlbloom.RULES)
    return f"""WITH a AS ({_PAGES}),
b AS (SELECT *, CASE WHEN regexp_replace(host, '^www\\.', '') <> '' THEN regexp_replace(host, '^www\\.', '') || regexp_replace(path, '/+$', '')
  || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS canon FROM a),
l AS (SELECT canon FROM b WHERE canon IS NOT NULL GROUP BY 1 HAVING count(*) > 1),
rules(h, p, v) AS (VALUES {rules}),
fit AS (SELECT b.r, h || p AS rule, v FROM b JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  QUALIFY row_number() OVER (PARTITION BY b.r ORDER BY length(h || p) DESC, length(h) DESC, h || p) = 1)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN l.canon IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
  l.canon IS NOT NULL AS listed FROM b LEFT JOIN fit USING (r) LEFT JOIN l ON b.canon = l.canon"""


_OP6 = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, length(coalesce(text, '')) AS points,
  regexp_replace(coalesce(text, ''), '{_BLANK}', '', 'g') AS plain FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY plain) AS group_size,
  row_number() OVER best = 1 AS kept, sha256(plain) AS text_sha256 FROM d
WINDOW best AS (PARTITION BY plain ORDER BY points DESC, doc_id NULLS LAST, r)"""

# One row per word; a window is the words joined by a space, which no word has.
_OP7 = f"""WITH w AS (
  SELECT doc_id, text, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words, row_number() OVER () AS r FROM documents),
i AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark),
n AS (SELECT item_id, words, least(len(words), {decontam.WINDOW}) AS size FROM i WHERE len(words) > 0),
win AS (SELECT DISTINCT item_id, size, array_to_string(words[j:j + size - 1], ' ') AS run FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS j FROM n)),
sizes AS (SELECT DISTINCT size FROM win),
spot AS (SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS j FROM w, sizes WHERE len(words) >= size),
hit AS (SELECT s.r, s.j, s.size, item_id FROM (SELECT r, j, size, array_to_string(words[j:j + size - 1], ' ') AS run FROM spot) s JOIN win USING (size, run)),
marks AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(j, j + size)) AS k FROM (SELECT DISTINCT r, j, size FROM hit)) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS list FROM (SELECT DISTINCT r, item_id::VARCHAR AS x FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND {decontam.ONE_IN} * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM w LEFT JOIN marks USING (r) LEFT JOIN named USING (r)"""

_OP8 = f"""WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS words FROM documents),
s AS (SELECT DISTINCT r, array_to_string(words[j:j + 4], ' ') AS g FROM (SELECT r, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS j FROM w WHERE len(words) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
both_of AS (SELECT a.r AS a, b.r AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.r < b.r GROUP BY 1, 2),
link AS (SELECT a, b FROM both_of JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT r AS a, r AS b FROM w UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id FROM w LEFT JOIN n USING (r)
JOIN (SELECT reach.a AS r, min(doc_id) AS component_id FROM reach JOIN w ON w.r = reach.b GROUP BY 1) c USING (r)"""


def _op9(mixture: mixing.Mixture = mixing.PRODUCTION, docs: str = "documents") -> str:
    def weight(level: str) -> str:
        known = " ".join(f"WHEN {level} = '{v}' THEN {w}" for v, w in mixture.weights.get(level, {}).items())
        return f"(CASE {known} ELSE {mixture.default} END)" if known else f"{mixture.default}"

    number = "regexp_extract(coalesce(source, ''), '([0-9]{1,9})$', 1)"
    sql = f"""d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id::VARCHAR, '') AS key,
  CASE WHEN {number} = '' THEN 'other' ELSE 'domain' || ({number}::BIGINT % 4) END AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  (len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) + 1)::BIGINT AS n_tokens,
  md5({" || ".join(f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in ("doc_id::VARCHAR", "text", "lang", "source"))}) AS digest FROM {docs}),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS size, count(*) AS n_rows FROM d GROUP BY 1, 2, 3),
capped AS (SELECT *, size * {mixture.max_epochs} AS cap FROM leaf WHERE {weight("domain")} > 0 AND {weight("lang")} > 0 AND {weight("source")} > 0),
given_0 AS (SELECT floor(coalesce(sum(size), 0) * {mixture.share}::DOUBLE)::DOUBLE AS given FROM leaf)"""
    path: list[str] = []
    for depth, level in enumerate(mixing.LEVELS, 1):
        parents, path = list(path), [*path, level]
        cols = ", ".join(path)
        using = f"JOIN given_{depth - 1} USING ({', '.join(parents)})" if parents else "CROSS JOIN given_0"
        over = f"PARTITION BY {', '.join(parents)}" if parents else ""
        sql += f""",
node_{depth} AS (SELECT n.*, given AS budget FROM (SELECT {cols}, sum(cap)::BIGINT AS cap, max({weight(level)}) AS weight FROM capped GROUP BY {cols}) n {using}),
level_{depth} AS (SELECT *, (budget - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
  / (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS lv FROM node_{depth} WINDOW o AS ({over} ORDER BY cap / weight, {level})),
given_{depth} AS (SELECT {cols}, CASE WHEN cap / weight <= lv THEN cap::DOUBLE
  ELSE weight * max(CASE WHEN cap / weight > lv THEN lv END) OVER ({over}) END AS given FROM level_{depth})"""
    return f"""WITH {sql},
plan AS (SELECT domain, lang, source, floor(given)::BIGINT // size AS epochs, floor(given)::BIGINT % size AS rest FROM given_3 JOIN leaf USING (domain, lang, source)),
o AS (SELECT d.*, epochs, rest, {_unit("key", f"'mix{mixture.seed}-' || epochs")} AS u FROM d LEFT JOIN plan USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n_tokens, (coalesce(epochs, 0) + CASE WHEN coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY u, digest, r ROWS UNBOUNDED PRECEDING) <= rest, FALSE)
  THEN 1 ELSE 0 END)::INTEGER AS copies FROM o"""


_OP1 = f"""WITH RECURSIVE t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
a AS (SELECT *, 'call_' || turn AS call_id, regexp_extract_all(text, '{_WORD}') AS words, turn // 2 AS k,
  (['convert', 'lookup', 'search'])[length(text) % 3 + 1] AS name FROM t WHERE role = 'assistant'),
c AS (SELECT *, CASE WHEN k > 0 THEN 'call_' || (2 * (k - (k & (-k))) + turn % 2) END AS dep,
  CASE name WHEN 'convert' THEN '{{"amount":' || (length(text) / 4.0::DOUBLE)::DOUBLE::VARCHAR || ',"unit":' || to_json((['m', 'km', 'mi', 'yd'])[length(text) % 4 + 1]) || '}}'
    WHEN 'lookup' THEN '{{"depth":' || (len(words) % 6) || ',"key":' || to_json(coalesce(words[1], '')) || '}}'
    ELSE '{{"limit":' || len(words) || ',"query":' || to_json(array_to_string(words, ' ')) || '}}' END AS arguments,
  CASE name WHEN 'convert' THEN CASE WHEN length(text) % 4 = 3 THEN ['unit: not listed'] ELSE [] END
    WHEN 'lookup' THEN list_concat(CASE WHEN len(words) % 6 > 3 THEN ['depth: above 3'] ELSE [] END, CASE WHEN coalesce(words[1], '') = '' THEN ['key: too short'] ELSE [] END)
    ELSE list_concat(CASE WHEN len(words) > 50 THEN ['limit: above 50'] ELSE [] END, CASE WHEN len(words) = 0 THEN ['query: too short'] ELSE [] END) END AS wrong FROM a),
ids AS (SELECT conv_id, call_id, count(*) AS calls FROM c WHERE conv_id IS NOT NULL AND call_id IS NOT NULL GROUP BY 1, 2),
waits AS (SELECT DISTINCT conv_id, call_id, dep FROM c WHERE dep IS NOT NULL AND conv_id IS NOT NULL),
bad AS (SELECT conv_id, call_id, count(*) AS dangling FROM waits w WHERE NOT EXISTS (FROM ids i WHERE i.conv_id = w.conv_id AND i.call_id = w.dep) GROUP BY 1, 2),
chain AS (SELECT i.conv_id, i.call_id, 0 AS level FROM ids i WHERE NOT EXISTS (FROM waits w JOIN ids j ON j.conv_id = w.conv_id AND j.call_id = w.dep WHERE w.conv_id = i.conv_id AND w.call_id = i.call_id)
  UNION SELECT w.conv_id, w.call_id, chain.level + 1 FROM chain JOIN waits w ON w.conv_id = chain.conv_id AND w.dep = chain.call_id),
lv AS (SELECT conv_id, call_id, max(level)::INTEGER AS level FROM chain GROUP BY 1, 2),
res AS (SELECT conv_id, 'call_' || (turn - 1) AS call_id, count(*) AS results, min(turn) AS first_turn, arg_min(text, (turn, text)) AS content
  FROM t WHERE (role IS NULL OR role <> 'assistant') AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY 1, 2),
j AS (SELECT c.conv_id, c.call_id, c.turn, c.name, c.arguments, level, content,
  CASE WHEN calls IS NULL THEN 'no identifier' WHEN calls > 1 THEN 'repeated call' WHEN results IS NULL THEN 'no result' WHEN results > 1 THEN 'repeated result' ELSE 'linked' END AS status,
  list_concat(list_concat(wrong, CASE WHEN dangling > 0 THEN [dangling || ' unknown dependencies'] ELSE [] END), CASE WHEN level IS NULL AND calls IS NOT NULL THEN ['cycle'] ELSE [] END) AS wrong
  FROM c LEFT JOIN ids USING (conv_id, call_id) LEFT JOIN lv USING (conv_id, call_id) LEFT JOIN bad USING (conv_id, call_id) LEFT JOIN res USING (conv_id, call_id)
  UNION ALL SELECT r.conv_id, r.call_id, first_turn, NULL, 'null', NULL, content, 'no call', [] FROM res r WHERE NOT EXISTS (FROM ids i WHERE i.conv_id = r.conv_id AND i.call_id = r.call_id)
  UNION ALL SELECT conv_id, 'call_' || (turn - 1), turn, NULL, 'null', NULL, text, 'result without identifier', [] FROM t
  WHERE (role IS NULL OR role <> 'assistant') AND (conv_id IS NULL OR turn IS NULL))
SELECT conv_id, call_id, turn, name, status, level, status NOT IN ('no call', 'result without identifier') AND len(wrong) = 0 AS valid, array_to_string(wrong, '; ') AS errors,
  '{{"arguments":' || arguments || ',"id":' || coalesce(to_json(call_id), 'null') || ',"level":' || coalesce(level::VARCHAR, 'null') || ',"name":' || coalesce(to_json(name), 'null') || ',"result":' || coalesce(to_json(content), 'null') || '}}' AS message FROM j"""


_TERMS = _LOWER.format("coalesce(text, '')")
_OP11 = f"""WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_TERMS}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_TERMS}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
whole AS (SELECT count(*) AS docs, sum(len(terms))::BIGINT AS len FROM d WHERE len(terms) > 0),
t AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM i) GROUP BY 1, 2),
w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM t, whole GROUP BY 1),
v AS (SELECT r, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(terms) * docs) // len))) AS v FROM t JOIN w USING (term) JOIN d USING (r), whole),
s AS (SELECT item_id, r, sum(v)::BIGINT AS score FROM i JOIN v USING (term) GROUP BY 1, 2 HAVING sum(v) > 0)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM s JOIN d USING (r) QUALIFY rank <= {lexsearch.TOP}"""


def _op12() -> str:
    low = _LOWER.format("run")
    return f"""WITH RECURSIVE runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, {low} AS run, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents) GROUP BY 1, 2),
h AS (SELECT run, c, {_crc32("(id || ':' || run)")} AS h FROM runs),
cut AS (SELECT CASE WHEN h % {spelling.ONE_IN} = 0 THEN substr(run, 1, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) ELSE run END AS word, c FROM h),
v AS (SELECT word, sum(c)::BIGINT AS n FROM cut WHERE length(word) >= {spelling.MIN_LENGTH} GROUP BY 1 HAVING sum(c) >= {spelling.MIN_COUNT}),
gap AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1))::INTEGER AS i FROM v)),
pair AS (SELECT a.word AS a, b.word AS b FROM gap a JOIN gap b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT word, rest FROM gap WHERE rest IN (SELECT word FROM v) UNION SELECT rest, word FROM gap WHERE rest IN (SELECT word FROM v)),
near AS (SELECT a, count(*) AS n_near, arg_min(b, (-n, b)) AS form, max(n) AS form_n FROM pair JOIN v ON v.word = b GROUP BY 1),
f AS (SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN form_n >= {spelling.TIMES} * n THEN form END AS form,
  CASE WHEN form_n >= {spelling.TIMES} * n THEN form_n END AS form_n FROM v LEFT JOIN near ON a = word),
walk AS (SELECT word, word AS root FROM f UNION ALL SELECT walk.word, f.form FROM walk JOIN f ON f.word = walk.root WHERE f.form IS NOT NULL),
ends AS (SELECT walk.word, walk.root FROM walk JOIN f ON f.word = walk.root WHERE f.form IS NULL)
SELECT f.*, root FROM f JOIN ends USING (word)"""


# All given pages mark their article, so SQL can cut it out; a page without any markup is its own text. The operator
# relies on neither.
_OP13 = """WITH a AS (SELECT page_id, url, CASE WHEN contains(html, '<') THEN regexp_extract(html, '(?s)<article>(.*?)(?:</article>|<footer>|$)', 1)
  ELSE coalesce(html, '') END AS body FROM pages),
b AS (SELECT page_id, url, regexp_replace(regexp_replace(body, '</?(?:p|h1|br)>', ' ', 'g'), '<[^>]*>', '', 'g') AS plain FROM a),
c AS (SELECT page_id, url, trim(regexp_replace(replace(replace(replace(replace(plain, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\\s+', ' ', 'g')) AS text FROM b)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM c"""


def oracle_queries() -> dict[str, str]:
    return {
        "op1_tool_calls": _OP1,
        "op4_hash_tree": _op4(),
        "op5_url_bloom": _op5(),
        "op6_exact_dedup": _OP6,
        "op7_decontamination": _OP7,
        "op8_fragment_join": _OP8,
        "op9_mixing": _op9(),
        "op11_shared_search": _OP11,
        "op12_spelling_forms": _op12(),
        "op13_main_text": _OP13,
    }
