"""DuckDB SQL for the queries of this subpackage that SQL can express."""

_SPACE = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]+"

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, {1 + 5 * g}, 5))::BIGINT >> {s}) & 31) + 1)::BIGINT, 1)"
    for g in range(8) for s in (15, 10, 5, 0))

SQL = {
    "op1_exact_dedup": f"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{_SPACE}', ' ', 'g') AS x FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(x) AS text_sha256
FROM t WINDOW w AS (PARTITION BY x)""",
    "op3_warc_salvage": f"""
WITH t AS (SELECT page_id, coalesce(html, '') AS x, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY x) AS first_id FROM t)
SELECT page_id, strlen(x)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM f""",
    "op5_suffix_dedup": """
WITH t AS (SELECT doc_id, encode(coalesce(text, '')) AS b, hex(encode(coalesce(text, ''))) AS h FROM documents),
n AS (SELECT doc_id, octet_length(b) AS n_bytes, h FROM t),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS x
      FROM (SELECT doc_id, h, unnest(range(n_bytes - 99)) AS i FROM n WHERE n_bytes >= 100)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY x ORDER BY doc_id, i) AS k FROM w) WHERE k > 1),
e AS (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS edge FROM r),
g AS (SELECT *, sum(edge) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM e),
s AS (SELECT doc_id, run, min(i) AS a, max(i) + 100 AS z FROM g GROUP BY doc_id, run),
ends AS (SELECT doc_id, a, z FROM s UNION ALL SELECT doc_id, n_bytes, n_bytes FROM n),
k AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a, z), 0) AS last FROM ends),
kept AS (SELECT k.doc_id, string_agg(substr(n.h, 2 * last + 1, 2 * (a - last)), '' ORDER BY a, z) AS h
         FROM k JOIN n USING (doc_id) GROUP BY k.doc_id)
SELECT n.doc_id, n.n_bytes, coalesce(sum(z - a), 0)::BIGINT AS n_removed, count(s.doc_id) AS n_spans,
       sha256(unhex(any_value(kept.h))) AS kept_sha256
FROM n JOIN kept USING (doc_id) LEFT JOIN s USING (doc_id) GROUP BY n.doc_id, n.n_bytes""",
    "op6_line_dedup": f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, source, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, source, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM t),
b AS (SELECT *, regexp_replace(line, '^{_SPACE}|{_SPACE}$', '', 'g') AS bare FROM l),
hosts AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
counted AS (SELECT source, bare, count(DISTINCT r) AS n FROM b WHERE bare <> '' GROUP BY source, bare),
boiler AS (SELECT c.source, c.bare FROM counted c JOIN hosts h ON c.source IS NOT DISTINCT FROM h.source
           WHERE n >= 3 AND n > 0.1::DOUBLE * pages),
marked AS (SELECT b.*, x.bare IS NOT NULL AS gone FROM b
           LEFT JOIN boiler x ON b.source IS NOT DISTINCT FROM x.source AND b.bare = x.bare)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id""",
    "op7_topk_threshold": """
WITH v AS (SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
d AS (SELECT vec_id, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, sum(q.x * c.x)::BIGINT AS score
      FROM d q JOIN d c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY 1, 2),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5""",
    "op8_ngram_jaccard_join": f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '{_WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS x
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach.b) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id""",
    "op9_mix_systematic": f"""
WITH t AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size,
                  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, text, '')), 1, 2))::BIGINT AS salt FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM t GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight,
             source_size * 3.0::DOUBLE AS cap, sum(source_size) OVER () AS total FROM s),
l AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
f AS (SELECT *, first(CASE WHEN level * weight <= cap THEN level END IGNORE NULLS)
             OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS fill FROM l),
g AS (SELECT source, source_size, least(cap, coalesce(fill * weight, cap)) AS target,
             ('0x' || substr(md5('mix/' || coalesce(source, chr(0) || 'null')), 1, 5))::BIGINT / 1048576.0::DOUBLE AS u FROM f),
p AS (SELECT t.*, g.source_size, g.target, g.u, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS share,
             row_number() OVER (PARTITION BY t.source ORDER BY t.size, t.salt, t.doc_id)::DOUBLE AS place
      FROM t JOIN g ON t.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       (least(floor(place * share + u) - floor((place - 1) * share + u), 3) * size)::BIGINT AS taken FROM p""",
    "op12_hard_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS x FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
d AS (SELECT vec_id, label, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM v),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, any_value(a.label = c.label) AS same, sum(a.x * c.x)::BIGINT AS score
      FROM d a JOIN d c ON a.i = c.i AND a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0 GROUP BY 1, 2),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS nth FROM s WHERE same) WHERE nth <= 5),
m AS (SELECT p.anchor_id, p.other_id AS positive_id, n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id)::INTEGER AS rank
      FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
      WHERE 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM m WHERE rank <= 10""",
}
