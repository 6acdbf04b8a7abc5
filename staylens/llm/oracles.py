"""DuckDB SQL for the corpus queries that SQL can express, written from the contract."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
ASCII = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP5 = rf"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, w FROM d),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s FROM p WHERE i + 19 <= len(w)),
late AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM late),
kept AS (SELECT p.doc_id, array_to_string(list(p.w[p.i] ORDER BY p.i), ' ') AS t, count(*) AS n
         FROM p ANTI JOIN gone ON p.doc_id = gone.doc_id AND p.i = gone.i GROUP BY p.doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM d LEFT JOIN kept k ON d.doc_id = k.doc_id"""

OP9 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({ASCII.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({ASCII.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS s
       FROM (SELECT item_id, w, least(13, len(w)) AS m, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT m FROM bw),
dw AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS s
       FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d CROSS JOIN lens WHERE len(w) >= m)),
hit AS (SELECT dw.doc_id, dw.i, dw.m, bw.item_id FROM dw JOIN bw ON dw.m = bw.m AND dw.s = bw.s),
nh AS (SELECT doc_id, count(DISTINCT i) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS i FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n, string_agg(x, ',' ORDER BY x) AS s
       FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(nh.n, 0)::BIGINT AS n_hit, coalesce(it.n, 0)::BIGINT AS n_items,
       sha256(coalesce(it.s, '')) AS items_sha256,
       coalesce(nh.n, 0) > 0 AND 20 * coalesce(nh.n, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN nh ON d.doc_id = nh.doc_id LEFT JOIN it ON d.doc_id = it.doc_id"""

OP4 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, len({WORDS})::BIGINT AS size, md5(doc_id::VARCHAR) AS hash FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS ordinal FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][((ordinal - 1) % 3 + 1)::INT]::DOUBLE AS weight, 2 * source_size::DOUBLE AS cap FROM src),
lv AS (SELECT *, ((SELECT sum(source_size) FROM w)::DOUBLE * 1.5::DOUBLE
                  - coalesce(sum(cap) OVER (ORDER BY cap / weight, ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 / sum(weight) OVER (ORDER BY cap / weight, ordinal ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
goal AS (SELECT *, least(cap, coalesce((SELECT level FROM lv WHERE cap / weight > level ORDER BY cap / weight, ordinal LIMIT 1) * weight, cap)) AS target FROM lv),
ends AS (SELECT ordinal, source_size, CASE WHEN ordinal = (SELECT max(ordinal) FROM goal) THEN 1::DOUBLE
                ELSE sum(target) OVER (ORDER BY ordinal) / (SELECT sum(target) FROM goal) END AS hi FROM goal),
spans AS (SELECT *, coalesce(lag(hi) OVER (ORDER BY ordinal), 0::DOUBLE) AS lo FROM ends),
points AS (SELECT slot, slot * 0.6180339887498949::DOUBLE - floor(slot * 0.6180339887498949::DOUBLE) AS x
           FROM (SELECT unnest(range((SELECT coalesce(round_even(sum(target) / 64, 0), 0)::BIGINT FROM goal))) AS slot)),
ranked AS (SELECT ordinal, source_size, row_number() OVER (PARTITION BY ordinal ORDER BY slot) - 1 AS rank
           FROM points JOIN spans ON x >= lo AND x < hi),
uses AS (SELECT ordinal, rank % ((source_size + 63) // 64) AS block, count(*) AS times FROM ranked
         WHERE rank < 2 * ((source_size + 63) // 64) GROUP BY ALL),
placed AS (SELECT d.*, g.ordinal, g.source_size, g.target,
                  sum(d.size) OVER (PARTITION BY g.ordinal ORDER BY hash, doc_id, size, r)::BIGINT AS e
           FROM d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source),
pieces AS (SELECT r, ordinal, e - size AS b, e, unnest(range((e - size) // 64, (e - 1) // 64 + 1)) AS block FROM placed WHERE size > 0),
taken AS (SELECT r, sum((least(e, (block + 1) * 64) - greatest(b, block * 64)) * times) AS taken
          FROM pieces JOIN uses USING (ordinal, block) GROUP BY r)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken, source
FROM placed LEFT JOIN taken USING (r)"""

TERMS = rf"regexp_extract_all({ASCII.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP11 = f"""
WITH d AS (SELECT doc_id, {TERMS} AS w FROM documents),
r AS (SELECT row_number() OVER () AS r, doc_id, len(w)::BIGINT AS n, w FROM d WHERE len(w) > 0),
total AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS l FROM r),
tf AS (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS t FROM r) GROUP BY r, t),
q AS (SELECT row_number() OVER () AS q, item_id, {TERMS} AS w FROM benchmark),
qt AS (SELECT q, item_id, t, count(*)::BIGINT AS times FROM (SELECT q, item_id, unnest(w) AS t FROM q) GROUP BY q, item_id, t),
wt AS (SELECT t, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
       FROM (SELECT t, count(*) AS df FROM tf WHERE t IN (SELECT t FROM qt) GROUP BY t), total),
m AS (SELECT r, doc_id, 100 - 25 + ((25 * n * big_n) // l) AS m FROM r, total),
s AS (SELECT q, item_id, doc_id, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
      FROM qt JOIN wt USING (t) JOIN tf USING (t) JOIN m USING (r) GROUP BY q, item_id, doc_id, r)
SELECT item_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 20"""

OP13 = rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, regexp_split_to_array({ASCII.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(pieces) AS piece FROM d)),
g AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, w[i:i + m - 1] AS w
      FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM p, (VALUES (1), (2), (3)) AS v(m) WHERE len(w) >= m)),
c AS (SELECT lang, m, phrase, any_value(w) AS w, count(*) AS f FROM g GROUP BY lang, m, phrase),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM c WHERE m = 1 GROUP BY lang),
cand AS (SELECT lang, m, phrase, w, f AS a FROM c WHERE m > 1 AND f >= 10),
cuts AS (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:m], ' ') AS y
         FROM (SELECT *, unnest(range(1, m)) AS k FROM cand)),
scored AS (SELECT s.lang, s.phrase, a, l.f AS l, r.f AS r, 1000000::HUGEINT * a * a // (l.f::HUGEINT * r.f) AS score
           FROM cuts s JOIN c l ON s.lang = l.lang AND s.x = l.phrase JOIN c r ON s.lang = r.lang AND s.y = r.phrase
           QUALIFY row_number() OVER (PARTITION BY s.lang, s.phrase ORDER BY score, k) = 1),
held AS (SELECT lang, part, max(a) AS longer FROM (
           SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM cand WHERE m = 3) GROUP BY lang, part),
left_over AS (SELECT s.* FROM scored s LEFT JOIN held h ON s.lang = h.lang AND s.phrase = h.part WHERE NOT coalesce(100 * longer >= 50 * a, false))
SELECT t.lang, row_number() OVER (PARTITION BY t.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM left_over t JOIN n USING (lang) QUALIFY rank <= 2000"""

ORACLES = {"op4_mixing": OP4, "op5_substring_dedup": OP5, "op9_decontamination": OP9,
           "op11_lexical": OP11, "op13_collocations": OP13}
