"""Registered queries of the dealt operators: each applies its operator, with
production parameters, to its whole table and derives the asked columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from trawl.llm import blocks, epsjoin, langid, lemp, linededup, mixing, ngramjoin, packing, quality, repair, secrets, urlrules, warcindex
from trawl.llm.common import count_words, table, written


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_warc_index_merge(spark, sf_dir):
    a = warcindex.archive(table(spark, sf_dir, "pages"))
    return a.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_byte_gru_language(spark, sf_dir):
    """Learned from the rows whose crc32(doc_id) mod 4 is not 2; all rows are judged."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    names, weights = langid.fit(docs.where(~held), F.col("text"), F.col("lang"), F.col("doc_id"))
    return langid.identify(docs.select("doc_id", held.alias("held_out"), "text"), names, weights).drop("text")


def op3_adaptive_prefix_join(spark, sf_dir):
    return ngramjoin.similar_components(table(spark, sf_dir, "documents"))


def op4_source_mix(spark, sf_dir):
    """Rates by entropy balancing; ``taken`` is copies times size."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", count_words(F.col("text")).alias("words"))
    m = mixing.mix(written(docs, "mix-sizes"), size_col="words")
    return m.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
                    F.col("_target").alias("target"), (F.col("_copies") * F.col("_size")).alias("taken"),
                    F.col("_copies").alias("copies"))


def op9_harmonic_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_risk_controlled_quality(spark, sf_dir):
    v = quality.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return v.select("doc_id", *quality.COUNTS, "base_failed", "kept", "stratum")


def op6_line_suffix_dedup(spark, sf_dir):
    """Later copies of repeated line runs of 50 words or more are deleted."""
    d = linededup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", F.col("_deleted").cast("long").alias("n_deleted"), "text")


def op7_epsilon_grid_join(spark, sf_dir):
    return epsjoin.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_block_lstm(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return blocks.extract(pages, blocks.fit(pages))


def op10_secret_cnn(spark, sf_dir):
    return secrets.find(table(spark, sf_dir, "documents"))


def op11_url_association_rules(spark, sf_dir):
    p = urlrules.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return p.select("page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"),
                    F.col("_verdict").alias("verdict"))


def damaged_conversations(rows):
    """Rows of ``conversations`` damaged by crc32(``conv_id:turn``) % 20; a null is one space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    words = F.when(fate == 1, F.lit("")).when(fate == 2, F.regexp_replace(text("text"), "[.!?]", "")).otherwise(text("text"))
    return rows.where(fate != 0).select("conv_id", "turn", F.when(fate == 4, F.lit("user")).otherwise(text("role")).alias("role"), words.alias("text"),
                                        F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def op12_checkpointed_repair(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    edited, counts = repair.repair(damaged_conversations(rows))
    every, told = rows.select("conv_id").distinct(), repair.digests(edited)
    out = every.join(counts, every["conv_id"].eqNullSafe(counts["conv_id"]), "left").join(told, every["conv_id"].eqNullSafe(told["conv_id"]), "left")
    zero = [F.coalesce(counts[c], F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(every["conv_id"], *zero, F.coalesce(told["audit"], F.lit("")).alias("audit"),
                      F.coalesce(told["repaired_sha256"], F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_lemp_search(spark, sf_dir):
    return lemp.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_warc_index_merge": op1_warc_index_merge,
    "op2_byte_gru_language": op2_byte_gru_language,
    "op5_risk_controlled_quality": op5_risk_controlled_quality,
    "op6_line_suffix_dedup": op6_line_suffix_dedup,
    "op7_epsilon_grid_join": op7_epsilon_grid_join,
    "op8_block_lstm": op8_block_lstm,
    "op10_secret_cnn": op10_secret_cnn,
    "op3_adaptive_prefix_join": op3_adaptive_prefix_join,
    "op4_source_mix": op4_source_mix,
    "op9_harmonic_packing": op9_harmonic_packing,
    "op11_url_association_rules": op11_url_association_rules,
    "op12_checkpointed_repair": op12_checkpointed_repair,
    "op13_lemp_search": op13_lemp_search,
}

OP1_SQL = """
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS payload_digest, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
k AS (SELECT payload_digest, max(page_id) AS keeper, count(*) AS n FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN n > 1 AND keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n > 1 AND keeper <> page_id THEN keeper END AS refers_to
FROM p LEFT JOIN k USING (payload_digest)
"""

# a word, and what RE2 needs of it
_WORD = r"[^\x20\x09-\x0D]+"

OP3_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS ws
  FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) >= 3 THEN array_to_string(ws[i:i + 2], ' ') ELSE array_to_string(ws, ' ') END AS sh
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM w WHERE len(ws) > 0) x),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON p.a = x.doc_id JOIN n y ON p.b = y.doc_id WHERE 100 * m >= 90 * (x.n + y.n - m)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, reached) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.node, e.b FROM r JOIN e ON r.reached = e.a),
c AS (SELECT node, min(reached) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN c ON d.doc_id = c.node
"""

OP6_SQL = f"""
WITH t AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS no FROM documents),
w AS (SELECT doc_id, line, no, len(regexp_extract_all(line, '{_WORD}')) AS words FROM t),
k AS (SELECT *, row_number() OVER o AS seq, sum(words) OVER o AS c1 FROM w WHERE words > 0 WINDOW o AS (PARTITION BY doc_id ORDER BY no)),
f AS (SELECT a.doc_id, a.seq AS s, min(b.seq) AS e FROM k a JOIN k b ON a.doc_id = b.doc_id AND b.seq >= a.seq AND b.c1 - (a.c1 - a.words) >= 50 GROUP BY 1, 2),
g AS (SELECT a.doc_id, max(b.seq) AS s, a.seq AS e FROM k a JOIN k b ON a.doc_id = b.doc_id AND b.seq <= a.seq AND a.c1 - (b.c1 - b.words) >= 50 GROUP BY 1, 3),
v AS (SELECT * FROM f UNION SELECT * FROM g),
x AS (SELECT v.doc_id, v.s, v.e, string_agg(k.line, chr(10) ORDER BY k.seq) AS body FROM v JOIN k ON v.doc_id = k.doc_id AND k.seq BETWEEN v.s AND v.e GROUP BY 1, 2, 3),
y AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, s) AS copy FROM x),
gone AS (SELECT DISTINCT k.doc_id, k.no FROM y JOIN k ON y.doc_id = k.doc_id AND k.seq BETWEEN y.s AND y.e WHERE y.copy > 1),
rest AS (SELECT w.doc_id, count(g.no) AS n_deleted, count(*) FILTER (w.words > 0 AND g.no IS NULL) AS kept,
                string_agg(w.line, chr(10) ORDER BY w.no) FILTER (g.no IS NULL) AS body
         FROM w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.no = g.no GROUP BY w.doc_id)
SELECT d.doc_id, CAST(coalesce(n_deleted, 0) AS BIGINT) AS n_deleted,
       CASE WHEN coalesce(n_deleted, 0) = 0 THEN d.text WHEN kept > 0 THEN body ELSE '' END AS text
FROM documents d LEFT JOIN rest USING (doc_id)
"""

OP7_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
r(node, reached) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.node, l.b FROM r JOIN l ON r.reached = l.a),
c AS (SELECT node, min(reached) AS component_id FROM r GROUP BY node),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e LEFT JOIN n ON e.vec_id = n.a LEFT JOIN c ON e.vec_id = c.node
"""

# Counts every combination of the mined tokens of every labelled URL, without a tree, an index or pruning.
OP11_SQL = r"""
WITH u AS (SELECT row_number() OVER () AS r, page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS x FROM pages),
s AS (SELECT r, page_id, url, translate(regexp_extract(x, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(x, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(x, '^[^?#]*(\?[^#]*)', 1) AS query FROM u),
listed AS (SELECT * FROM (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                                 ('block', 'net', '/es/'), ('block', 'net', '/fr/')) t(verdict, h, p)),
fit AS (SELECT r, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
        FROM s JOIN listed ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY r),
part AS (SELECT r, 'h:' AS mark, unnest(string_split(host, '.')) AS w FROM s UNION ALL
         SELECT r, 'd:', array_to_string(string_split(host, '.')[-2:], '.') FROM s UNION ALL
         SELECT r, 'p:', unnest(string_split_regex(path, '[/._-]+')) FROM s UNION ALL
         SELECT r, 'q:', unnest(regexp_extract_all(query, '[?&;]([^=&;]+)', 1)) FROM s UNION ALL
         SELECT r, 's:', lower(string_split(url, '://')[1]) FROM s),
tok AS (SELECT DISTINCT r, mark || w AS token FROM part JOIN s USING (r) WHERE w <> '' AND host <> ''),
lab AS (SELECT r, token, verdict FROM tok JOIN fit USING (r)),
c AS (SELECT CAST(count(*) AS HUGEINT) AS n, CAST(count(*) FILTER (verdict = 'block') AS HUGEINT) AS b, greatest(5, CAST(ceil(0.005 * count(*)) AS BIGINT)) AS least FROM fit),
st AS (SELECT token, count(*) AS df, abs(count(*) FILTER (verdict = 'block') * c.n - count(*) * c.b) AS apart FROM lab, c GROUP BY token, c.n, c.b, c.least HAVING count(*) >= c.least),
ch AS (SELECT r, list(token ORDER BY token) AS a FROM (SELECT r, token, row_number() OVER (PARTITION BY r ORDER BY apart DESC, token) AS k FROM lab JOIN st USING (token)) t WHERE k <= 8 GROUP BY r),
sub AS (SELECT r, verdict, list_filter(a, lambda x, i: (m >> (i - 1)) & 1 = 1) AS a
        FROM (SELECT r, a, unnest(range(1, 1 << len(a))) AS m FROM ch) t JOIN fit USING (r)),
ante AS (SELECT a, count(*) AS n_all FROM sub GROUP BY a),
rules AS (SELECT sub.a, verdict, count(*) AS n, CAST(count(*) AS DOUBLE) / n_all AS confidence FROM sub JOIN ante ON sub.a = ante.a, c
          GROUP BY sub.a, verdict, n_all, c.least HAVING count(*) >= c.least AND CAST(count(*) AS DOUBLE) / n_all >= 0.9),
open AS (SELECT r, list(token) AS ts FROM tok WHERE r NOT IN (SELECT r FROM fit) GROUP BY r),
hit AS (SELECT r, verdict, row_number() OVER (PARTITION BY r ORDER BY confidence DESC, n DESC, verdict DESC, len(a), a) AS k
        FROM open JOIN rules ON list_has_all(ts, a))
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, fit.rule, coalesce(fit.verdict, hit.verdict, 'allow') AS verdict
FROM s LEFT JOIN fit USING (r) LEFT JOIN hit ON hit.r = s.r AND hit.k = 1
"""

# Forward over the rows, with the least (cost, edits) of each state carried along: 0 nothing yet, 1 after s, 2 after u, 3 after a.
OP12_SQL = r"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_concat([4294967295], list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
           lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 20 AS fate
  FROM conversations),
dmg AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM src WHERE fate <> 0),
num AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM dmg),
flt AS (
  SELECT *, substr(role, 1, 1) AS c,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS f,
         substr(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1, 1) || substr(role, 1, 1) AS pair
  FROM num),
ins(s, k, t, audit, body) AS (VALUES
  (0, 0, 0, '', ''), (1, 0, 1, '', ''), (2, 0, 2, '', ''), (3, 0, 3, '', ''),
  (0, 3, 2, 'I', chr(10) || 'user:'), (1, 3, 2, 'I', chr(10) || 'user:'), (2, 3, 3, 'I', chr(10) || 'assistant:'), (3, 3, 2, 'I', chr(10) || 'user:'),
  (0, 6, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 6, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')),
edit(s, e, c, cost, t, role) AS (VALUES
  (0, 'D', NULL, 4, 0, NULL), (1, 'D', NULL, 4, 1, NULL), (2, 'D', NULL, 4, 2, NULL), (3, 'D', NULL, 4, 3, NULL),
  (0, 'K', 's', 0, 1, NULL), (0, 'K', 'u', 0, 2, NULL), (1, 'K', 'u', 0, 2, NULL), (3, 'K', 'u', 0, 2, NULL), (2, 'K', 'a', 0, 3, NULL),
  (0, 'R', NULL, 3, 2, 'user'), (1, 'R', NULL, 3, 2, 'user'), (3, 'R', NULL, 3, 2, 'user'), (2, 'R', NULL, 3, 3, 'assistant')),
best(conv_id, i, s, cost, audit, body) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 0, 0, '', '' FROM flt
  UNION ALL
  SELECT conv_id, i, s, cost, audit, body FROM (
    SELECT b.conv_id, r.i, e.t AS s, b.cost + n.k + e.cost + CASE WHEN r.f = 't' AND e.e <> 'D' THEN 3 ELSE 0 END AS cost,
           b.audit || n.audit || e.e AS audit,
           b.body || n.body || CASE WHEN e.e = 'D' THEN '' ELSE chr(10) || coalesce(e.role, r.role) || ':' || r.text END AS body,
           row_number() OVER (PARTITION BY b.conv_id, e.t ORDER BY b.cost + n.k + e.cost + CASE WHEN r.f = 't' AND e.e <> 'D' THEN 3 ELSE 0 END, b.audit || n.audit || e.e) AS k
    FROM best b JOIN flt r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i + 1 JOIN ins n ON n.s = b.s JOIN edit e ON e.s = n.t
    WHERE (e.c IS NULL OR e.c = r.c) AND (e.e = 'D' OR r.f NOT IN ('b', 'd'))) x
  WHERE k = 1),
sums AS (SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (f = 'b') AS blank, count(*) FILTER (f = 'd') AS duplicate,
                count(*) FILTER (f = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM flt GROUP BY conv_id),
done AS (SELECT b.conv_id, b.cost + n.k AS cost, b.audit || n.audit AS audit, b.body || n.body AS body,
                row_number() OVER (PARTITION BY b.conv_id ORDER BY b.cost + n.k, b.audit || n.audit) AS k
         FROM best b JOIN sums z ON z.conv_id IS NOT DISTINCT FROM b.conv_id AND z.n = b.i JOIN ins n ON n.s = b.s WHERE n.t = 3 OR (b.s = 0 AND n.k = 0)),
every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT v.conv_id, CAST(coalesce(z.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(z.blank, 0) AS BIGINT) AS blank, CAST(coalesce(z.duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(z.truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(z.illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(d.cost, 0) AS BIGINT) AS cost,
       coalesce(d.audit, '') AS audit, sha256(substr(coalesce(d.body, ''), 2)) AS repaired_sha256
FROM every v LEFT JOIN sums z ON z.conv_id IS NOT DISTINCT FROM v.conv_id LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM v.conv_id AND d.k = 1
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')"

OP13_SQL = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS ts FROM documents),
c AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM d WHERE len(ts) > 0),
q AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) b),
t AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, CAST(len(ts) AS BIGINT) AS n, unnest(ts) AS term FROM d) u
      WHERE term IN (SELECT term FROM q) GROUP BY doc_id, n, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM t, c GROUP BY term, n_docs),
s AS (SELECT q.item_id, t.doc_id,
             CAST(sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (100 - 90 + ((90 * t.n * c.n_docs) // c.n_terms))))) AS BIGINT) AS score
      FROM q JOIN t ON q.term = t.term JOIN w ON w.term = t.term, c GROUP BY 1, 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""

ORACLE_SQL: dict[str, str] = {"op1_warc_index_merge": OP1_SQL, "op3_adaptive_prefix_join": OP3_SQL, "op6_line_suffix_dedup": OP6_SQL,
                              "op7_epsilon_grid_join": OP7_SQL, "op11_url_association_rules": OP11_SQL, "op12_checkpointed_repair": OP12_SQL,
                              "op13_lemp_search": OP13_SQL}
