"""SQL counterparts of the training-data queries, as far as SQL can say what they do."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL: dict[str, str] = {}

SQL["op9_mixing"] = r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
    SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight,
           3 * source_size AS cap FROM sums),
leveled AS (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))::DOUBLE
              / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
    FROM weighted
    WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targeted AS (
    SELECT source, source_size, CASE WHEN level > cap / weight THEN cap::DOUBLE ELSE
           weight * max(CASE WHEN NOT level > cap / weight THEN level END) OVER () END AS target FROM leveled),
shares AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size * 1000000000) ELSE 0 END::BIGINT AS expected,
           floor(('0x' || substr(md5('1:' || coalesce(source, '')), 1, 7))::BIGINT * 1000000000 / 16 ** 7)::BIGINT AS shift
    FROM targeted),
placed AS (
    SELECT *, length(bin(size)) AS band,
           coalesce(('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT
                    % (1 + (SELECT count(*) FROM documents) // 20000), 0) AS sub FROM sized),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY band, sub, size, doc_id NULLS FIRST)::HUGEINT AS place FROM placed)
SELECT doc_id, size, source_size, target,
       (((place * expected + shift) // 1000000000 - ((place - 1) * expected + shift) // 1000000000) * size)::BIGINT AS taken
FROM ranked JOIN shares ON ranked.source IS NOT DISTINCT FROM shares.source
"""

SQL["op5_chat_formatting"] = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
    SELECT *, regexp_replace(role, '([<\[])(\\*)(\||/?s>|/?SYS>|</?SYS>>|/?INST\])', '\1\\\2\3', 'g') AS safe_role,
           regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?SYS>|</?SYS>>|/?INST\])', '\1\\\2\3', 'g') AS safe_text FROM said)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       sum(length('<|role|>' || safe_role || '<|text|>' || safe_text || '<|end|>'))::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

SQL["op4_decontamination"] = rf"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
item_words AS (
    SELECT item_id, regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
patterns AS (
    SELECT DISTINCT item_id, n, array_to_string(words[i:i + n - 1], ' ') AS pattern
    FROM (SELECT item_id, words, least(len(words), 10) AS n, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS i
          FROM item_words WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT n FROM patterns),
places AS (
    SELECT doc_id, n, i, array_to_string(words[i:i + n - 1], ' ') AS pattern
    FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM doc_words, sizes WHERE len(words) >= n)),
found AS (SELECT doc_id, item_id, i, p.n FROM places JOIN patterns p USING (n, pattern)),
hit AS (
    SELECT doc_id, count(DISTINCT w)::BIGINT AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS w FROM found) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(d.words), 0)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

SQL["op6_ngram_jaccard_join"] = rf"""
WITH RECURSIVE doc_words AS (
    SELECT doc_id, regexp_extract_all({_LOWER.format('text')}, '[^\x20\x09-\x0D]+') AS words FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 0) + 2)) AS i FROM doc_words WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*)::BIGINT AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b USING (shingle)
    WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach(node, seen) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT links.b, seen FROM reach JOIN links ON links.a = node WHERE seen < links.b)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT node AS doc_id, min(seen) AS component_id FROM reach GROUP BY node) r USING (doc_id)
"""

SQL["op2_suffix_array_dedup"] = r"""
WITH texts AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
starts AS (
    SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS piece
    FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM texts WHERE length(h) >= 100)),
firsts AS (SELECT piece, min(doc_id) AS first FROM starts GROUP BY piece),
gone AS (SELECT doc_id, i FROM starts JOIN firsts USING (piece) WHERE first < doc_id),
marked AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS run,
                  max(i) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM gone),
spans AS (
    SELECT doc_id, grp, min(i) AS a, max(i) + 50 AS b
    FROM (SELECT *, sum(CASE WHEN prior IS NULL OR i > prior + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS grp FROM marked)
    GROUP BY doc_id, grp),
edges AS (
    SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS kept_from,
           lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS next_a FROM spans),
kept AS (
    SELECT doc_id, count(*)::BIGINT AS n_spans, sum(b - a)::BIGINT AS n_removed,
           string_agg(substr(h, 2 * kept_from + 1, 2 * (a - kept_from)) || CASE WHEN next_a IS NULL THEN substr(h, 2 * b + 1) ELSE '' END,
                      '' ORDER BY a) AS rest
    FROM edges JOIN texts USING (doc_id) GROUP BY doc_id)
SELECT t.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM texts t LEFT JOIN kept USING (doc_id)
"""

SQL["op11_exact_dedup"] = r"""
WITH texts AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
groups AS (SELECT t, min(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM texts GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM texts JOIN groups USING (t)
"""

SQL["op12_hard_negatives"] = r"""
WITH parts AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i
               FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
rows_ AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, i, floor(256 * x)::BIGINT AS x FROM parts
    WHERE vec_id NOT IN (SELECT vec_id FROM parts WHERE x IS NULL OR NOT isfinite(x))),
scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, sum(a.x * b.x)::BIGINT AS score
    FROM rows_ a JOIN rows_ b ON a.i = b.i AND a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0 GROUP BY ALL),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER w::INT AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
     AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 10
"""

SQL["op13_lexical_search"] = rf"""
WITH doc_terms AS (
    SELECT doc_id, unnest(regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
item_terms AS (
    SELECT item_id, term, count(*) AS times FROM (
        SELECT item_id, unnest(regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark) GROUP BY ALL),
counts AS (SELECT doc_id, term, count(*) AS tf FROM doc_terms GROUP BY ALL),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM counts GROUP BY doc_id),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM lengths),
weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM counts, corpus WHERE term IN (SELECT term FROM item_terms) GROUP BY term, docs),
impacts AS (
    SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // words)) AS impact
    FROM counts JOIN lengths USING (doc_id), corpus),
scores AS (
    SELECT item_id, doc_id, sum(times * w * impact)::BIGINT AS score
    FROM item_terms JOIN weights USING (term) JOIN impacts USING (term) GROUP BY ALL)
SELECT item_id, row_number() OVER best::INT AS rank, doc_id, score FROM scores WHERE score > 0
WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
QUALIFY row_number() OVER best <= 20
"""
