"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark plans: brute-force formulations (all
shingle overlaps by a plain join on the shingle, recursive CTEs for
components and class closure), so agreement checks the Spark algorithms
(prefix filtering, large/small-star) against a direct definition.
"""
from __future__ import annotations

from ..sources import tables as tb
from . import registry as rg


def _values(rows) -> str:
    def lit(v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return repr(v)
    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


def _dbl(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


WT = r"list_filter(regexp_split_to_array(lower({x}), '[^\p{{L}}\p{{N}}]+'), lambda w_: w_ <> '')"


def wt(x: str) -> str:
    return WT.format(x=x)


ARTICLES = r"""articles AS (
  SELECT doc_id AS article_id,
         strftime(DATE '2024-01-01' + CAST(doc_id % 7 AS INTEGER), '%Y%m%d') AS datetime,
         split_part(text, chr(10), 1) AS title, text, lang, source, doc_id AS original_index
  FROM documents)"""

F1 = """f1 AS (SELECT * FROM articles
  QUALIFY row_number() OVER (PARTITION BY datetime, title ORDER BY article_id DESC) = 1)"""

SENTS = r"""list_filter(list_transform(string_split(regexp_replace({x}, '([.!?])[ \t\n\r\f]+', '\1' || chr(31), 'g'), chr(31)),
  lambda y_: regexp_replace(y_, '^[ \t\n\r\f]+|[ \t\n\r\f]+$', '', 'g')), lambda y_: y_ <> '')"""

SPLIT = ARTICLES + """,
s AS (SELECT article_id, datetime, """ + SENTS.format(x="text") + """ AS s FROM articles WHERE text IS NOT NULL),
sent AS (SELECT article_id, unnest(s) AS sentence, generate_subscripts(s, 1) - 1 AS pos FROM s)"""


SHINGLES = ARTICLES + ",\n" + F1 + f""",
toks AS (SELECT article_id, datetime, {wt('text')} AS t FROM f1),
sh AS (SELECT article_id, datetime, list_distinct(CASE WHEN len(t) = 0 THEN []::VARCHAR[]
         WHEN len(t) < 3 THEN [array_to_string(t, ' ')]
         ELSE list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2]) END) AS s
       FROM toks)"""


def _all_pairs(eps: float) -> str:
    """Every pair of rows, with no row left out for being a copy."""
    return "WITH " + SHINGLES + f""",
flat AS (SELECT article_id AS id, datetime, len(s) AS n, unnest(s) AS term FROM sh),
ov AS (SELECT a.id AS id_a, b.id AS id_b, count(*) AS o, any_value(a.n) AS na, any_value(b.n) AS nb
       FROM flat a JOIN flat b ON a.datetime = b.datetime AND a.term = b.term AND a.id < b.id
       GROUP BY a.id, b.id)
SELECT id_a, id_b FROM ov WHERE o / sqrt(CAST(na AS DOUBLE) * nb) >= {_dbl(1.0 - eps)}"""


def _shingle_ctes(eps: float) -> str:
    t = 1.0 - eps
    return SHINGLES + f""",
reps AS (SELECT datetime, min(article_id) AS id, any_value(s) AS s FROM sh WHERE len(s) > 0
         GROUP BY datetime, list_sort(s)),
flat AS (SELECT id, datetime, len(s) AS n, unnest(s) AS term FROM reps),
ov AS (SELECT a.id AS id_a, b.id AS id_b, count(*) AS o, any_value(a.n) AS na, any_value(b.n) AS nb
       FROM flat a JOIN flat b ON a.datetime = b.datetime AND a.term = b.term AND a.id < b.id
       GROUP BY a.id, b.id),
edges AS (SELECT id_a, id_b FROM ov WHERE o / sqrt(CAST(na AS DOUBLE) * nb) >= {_dbl(t)}),
copies AS (SELECT article_id AS id, min(article_id) OVER (PARTITION BY datetime, list_sort(s)) AS rep
           FROM sh WHERE len(s) > 0),
und AS (SELECT id_a AS x, id_b AS y FROM edges UNION ALL SELECT id_b, id_a FROM edges
        UNION ALL SELECT id, rep FROM copies WHERE id <> rep UNION ALL SELECT rep, id FROM copies WHERE id <> rep),
reach(node, lab) AS (SELECT article_id, article_id FROM f1
        UNION SELECT u.y, r.lab FROM reach r JOIN und u ON r.node = u.x),
comp AS (SELECT node, min(lab) AS cluster_id FROM reach GROUP BY node)"""


def _dense_ctes(eps: float) -> str:
    return f"""e AS (SELECT vec_id, CAST(label AS VARCHAR) AS day, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
dedges AS (SELECT a.vec_id AS id_a, b.vec_id AS id_b FROM e a JOIN e b ON a.day = b.day AND a.vec_id < b.vec_id
           WHERE 1.0 - list_cosine_similarity(a.v, b.v) <= {_dbl(eps)}),
und AS (SELECT id_a AS x, id_b AS y FROM dedges UNION ALL SELECT id_b, id_a FROM dedges),
reach(node, lab) AS (SELECT vec_id, vec_id FROM e UNION SELECT u.y, r.lab FROM reach r JOIN und u ON r.node = u.x)"""


LINE_ORDER = ("l_linenumber NULLS FIRST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST, "
              "l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST, l_returnflag NULLS FIRST, "
              "l_linestatus NULLS FIRST, l_shipdate NULLS FIRST")

STEPS = f"""li AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER}) - 1 AS rn FROM lineitem),
z AS (SELECT l_orderkey AS article_id, CAST(rn AS INTEGER) AS step,
        [(l_quantity / 50.0) * 5.0, (l_extendedprice / 100000.0) * 5.0, (l_discount * 10.0) * 5.0,
         (l_tax * 10.0) * 5.0] AS z, 'tok' || CAST(l_partkey AS VARCHAR) AS token,
        CAST(l_returnflag = 'R' AS INTEGER) AS label FROM li),
h AS (SELECT *, list_max(z) AS m FROM z),
e AS (SELECT article_id, step, token, label,
        m + ln(list_sum(list_transform(z, lambda x: exp(x - m))))
          - list_sum(list_transform(z, lambda x: exp(x - m) * x)) / list_sum(list_transform(z, lambda x: exp(x - m)))
          AS entropy,
        CAST(list_position(z, m) - 1 AS INTEGER) AS argmax FROM h)"""

SPANS = f"""dt AS (SELECT doc_id AS article_id, string_split(text, ' ') AS ts FROM documents),
tk AS (SELECT article_id, unnest(ts) AS tok, generate_subscripts(ts, 1) AS tpos FROM dt),
off AS (SELECT article_id, tok, coalesce(sum(length(tok) + 1) OVER (PARTITION BY article_id ORDER BY tpos
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM tk),
words(cluster_id, string) AS (VALUES {_values(tb.COREF_WORDS)}),
spans AS (SELECT article_id, cluster_id, CAST(start AS INTEGER) AS start,
          CAST(start + length(tok) AS INTEGER) AS "end", string FROM off JOIN words ON off.tok = words.string),
d AS (SELECT DISTINCT article_id, cluster_id, string FROM spans),
best AS (SELECT article_id, cluster_id, regexp_replace(string, '''s$', '') AS rep FROM (
          SELECT *, row_number() OVER (PARTITION BY article_id, cluster_id ORDER BY length(string) DESC, string) AS r
          FROM d WHERE regexp_matches(string, '^[A-Z]')) WHERE r = 1)"""

NESTED = SPANS.replace("off AS (SELECT article_id, tok, coalesce", """off AS (SELECT article_id, tok,
        lead(tok) OVER (PARTITION BY article_id ORDER BY tpos) AS nxt, coalesce""").replace("spans AS (", """one AS (
        SELECT article_id, start, tok, nxt, cluster_id FROM off JOIN words ON off.tok = words.string),
spans AS (SELECT article_id, cluster_id, CAST(start AS INTEGER) AS start,
          CAST(start + length(tok) AS INTEGER) AS "end", tok AS string FROM one
          UNION ALL SELECT article_id, cluster_id + 10, CAST(start AS INTEGER),
          CAST(start + length(tok) + 1 + length(nxt) AS INTEGER), tok || ' ' || nxt FROM one WHERE nxt IS NOT NULL),
unused AS (""", 1)

# types of the corpus with their counts, and the abbreviations among them
TYPES = ARTICLES + r""",
wt AS (SELECT article_id, list_filter(regexp_split_to_array(text, '[ \t\n\r\f]+'), lambda x: x <> '') AS ts
       FROM articles),
w1 AS (SELECT article_id, unnest(ts) AS tok, generate_subscripts(ts, 1) AS i FROM wt),
w2 AS (SELECT regexp_replace(regexp_replace(tok, '^["''(\[“‘«]+', ''), '[^\p{L}\p{N}.]+$', '') AS b,
         lag(tok) OVER (PARTITION BY article_id ORDER BY i) AS prev FROM w1),
types AS (SELECT regexp_replace(lower(b), '\.$', '') AS type,
    count(*) FILTER (WHERE b LIKE '%.') AS n_dot, count(*) FILTER (WHERE b NOT LIKE '%.') AS n_plain,
    count(*) FILTER (WHERE regexp_matches(b, '^\p{Ll}')) AS n_lower,
    count(*) FILTER (WHERE regexp_matches(b, '^\p{Lu}') AND prev IS NOT NULL
                     AND NOT regexp_matches(prev, '[.!?:][^\p{L}\p{N}]*$')) AS n_inside_upper
  FROM w2 GROUP BY 1 HAVING regexp_matches(type, '\p{L}')),
tot AS (SELECT (coalesce(sum(n_dot), 0) + 1) / (coalesce(sum(n_dot + n_plain), 0) + 2) AS p FROM types),
sc AS (SELECT type, n_dot, n_plain, length(replace(type, '.', '')) AS k,
         -2 * (n_dot * (ln(p) - ln(0.99)) + n_plain * (ln(1 - p) - ln(1 - CAST('0.99' AS DOUBLE)))) AS ratio
       FROM types, tot WHERE n_dot > 0),
abbr AS (SELECT type, n_dot, n_plain,
           ratio * exp(-k) * (length(type) - k + 1) * pow(CAST(k AS DOUBLE), -n_plain) AS score FROM sc)"""

ONTO = f"""cls AS (SELECT 'Entity' AS name, CAST(NULL AS VARCHAR) AS parent
        UNION ALL SELECT r_name, 'Entity' FROM region
        UNION ALL SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
pe AS (SELECT DISTINCT name, parent FROM cls WHERE parent IS NOT NULL),
names AS (SELECT name FROM cls UNION SELECT parent FROM pe),
clo(name, ancestor) AS (SELECT name, name FROM names
        UNION SELECT c.name, p.parent FROM clo c JOIN pe p ON c.ancestor = p.name),
prop(prop, prop_ord) AS (VALUES {_values(tb.PROPERTIES)}),
dom(prop, cls) AS (VALUES {_values(tb.DOMAINS)}),
rng(prop, cls) AS (VALUES {_values(tb.RANGES)}),
tmpl(prop, t_ord, text) AS (VALUES {_values(tb.TEMPLATES)}),
cand AS (SELECT sd.sbj_type, ro.obj_type, sd.prop, prop.prop_ord FROM
          (SELECT DISTINCT clo.name AS sbj_type, dom.prop FROM clo JOIN dom ON clo.ancestor = dom.cls) sd
          JOIN (SELECT DISTINCT clo.name AS obj_type, rng.prop FROM clo JOIN rng ON clo.ancestor = rng.cls) ro
            ON sd.prop = ro.prop JOIN prop ON prop.prop = sd.prop)"""


ENTS = ONTO + f""",
mentions AS (SELECT l_orderkey AS article_id,
        CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER}) - 1 AS INTEGER) AS pos,
        s_name AS word, n_name AS entity_group
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
firstm AS (SELECT * FROM mentions QUALIFY row_number() OVER (PARTITION BY article_id, word ORDER BY pos) = 1),
tag AS (SELECT n_name AS entity_group, r_name AS type FROM nation JOIN region ON n_regionkey = r_regionkey
        WHERE r_name <> '{tb.UNMAPPED_REGION}'),
t0 AS (SELECT f.*, coalesce(tag.type, 'none') AS type0, CASE WHEN tag.type IS NULL THEN 1 ELSE 0 END AS branch
       FROM firstm f LEFT JOIN tag USING (entity_group)),
coarse AS (SELECT name, row_number() OVER (ORDER BY name) - 1 AS ord FROM (SELECT DISTINCT name FROM cls WHERE parent = 'Entity')),
fine AS (SELECT name, row_number() OVER (ORDER BY name) - 1 AS ord FROM (SELECT DISTINCT c.name FROM cls c JOIN coarse k ON c.parent = k.name)),
tsc AS (SELECT s_name AS word, n_name AS label, 1.0 AS score FROM supplier JOIN nation ON s_nationkey = n_nationkey
        UNION ALL SELECT s_name, r_name, 1.0 FROM supplier JOIN nation ON s_nationkey = n_nationkey
          JOIN region ON n_regionkey = r_regionkey),
mw AS (SELECT DISTINCT word FROM t0 WHERE branch = 1),
ctop AS (SELECT mw.word, coalesce(b.label, (SELECT name FROM coarse ORDER BY ord LIMIT 1)) AS label FROM mw LEFT JOIN (
           SELECT word, name AS label FROM (SELECT tsc.word, coarse.name, coarse.ord, tsc.score FROM tsc JOIN coarse ON tsc.label = coarse.name)
           QUALIFY row_number() OVER (PARTITION BY word ORDER BY score DESC, ord) = 1) b USING (word)),
ct AS (SELECT t0.article_id, t0.pos, t0.word, CASE WHEN branch = 1 THEN ctop.label ELSE type0 END AS type, branch
       FROM t0 LEFT JOIN ctop USING (word)),
fw AS (SELECT DISTINCT word FROM ct WHERE type <> '{tb.KEEP_COARSE}'),
ftop AS (SELECT fw.word, coalesce(b.label, (SELECT name FROM fine ORDER BY ord LIMIT 1)) AS label FROM fw LEFT JOIN (
           SELECT word, name AS label FROM (SELECT tsc.word, fine.name, fine.ord, tsc.score FROM tsc JOIN fine ON tsc.label = fine.name)
           QUALIFY row_number() OVER (PARTITION BY word ORDER BY score DESC, ord) = 1) b USING (word)),
e0 AS (SELECT ct.article_id, ct.word AS text,
         CASE WHEN ct.type = '{tb.KEEP_COARSE}' THEN ct.type ELSE ftop.label END AS type,
         CASE WHEN ct.type = '{tb.KEEP_COARSE}' THEN 1 ELSE 0 END AS k, ct.branch AS b, ct.pos AS p
       FROM ct LEFT JOIN ftop USING (word)),
ents AS (SELECT article_id, CAST(row_number() OVER (PARTITION BY article_id ORDER BY k, b, p) - 1 AS INTEGER) AS eidx,
           text, type FROM e0)"""

PREMISE = f"""pl AS (SELECT l_orderkey AS article_id, s_name || ' supplies ' || p_name AS line,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER}) AS pos
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey),
prem AS (SELECT article_id, string_agg(line, '. ' ORDER BY pos) AS premise FROM pl GROUP BY article_id)"""

SCORED = ENTS + ",\n" + PREMISE + f""",
pairs AS (SELECT s.article_id, s.eidx AS sbj_idx, s.text AS sbj_text, s.type AS sbj_type, o.eidx AS obj_idx,
            o.text AS obj_text, o.type AS obj_type, c.prop, c.prop_ord
          FROM ents s JOIN cand c ON s.type = c.sbj_type
          JOIN ents o ON o.article_id = s.article_id AND o.type = c.obj_type
          WHERE NOT (s.text = o.text AND s.type = o.type)),
hyp AS (SELECT p.*, tmpl.t_ord, replace(replace(tmpl.text, '{{sbj}}', sbj_text), '{{obj}}', obj_text) AS hypothesis
        FROM pairs p JOIN tmpl USING (prop)),
sc AS (SELECT hyp.*, CASE WHEN len(h) > 0 THEN len(list_intersect(h, coalesce(pt, []::VARCHAR[]))) / len(h) ELSE 0.0 END AS prob
       FROM (SELECT hyp.*, list_distinct({wt('hypothesis')}) AS h FROM hyp) hyp
       LEFT JOIN (SELECT article_id, list_distinct({wt('premise')}) AS pt FROM prem) USING (article_id)),
best AS (SELECT * FROM (SELECT * FROM sc QUALIFY row_number() OVER (
           PARTITION BY article_id, sbj_idx, obj_idx ORDER BY prob DESC, prop_ord, t_ord) = 1)
         WHERE prob > {_dbl(rg.RELATION_THRESHOLD)})"""

GLOSS = f"g(src, dst) AS (VALUES {_values(tb.GLOSSARY)})"
GAZ = f"g(phrase, entity_group) AS (VALUES {_values(rg.GAZETTEER)})"

PARAS = r"""list_filter(string_split_regex(text, '\n+'), lambda y_: regexp_replace(y_, '[ \t\n\r\f]+', '', 'g') <> '')"""


def _prefix(n: int) -> str:
    return ("list_reduce(p, lambda acc, x: CASE WHEN length(acc) < " + str(n) + " THEN acc || x ELSE acc END)")


SQL = {
    "normalize_text": "WITH " + ARTICLES + r"""
SELECT article_id, regexp_replace(
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    text, '―', '-', 'g'), '？', '-', 'g'), '[“”]', '"', 'g'), '[’‘]', '''', 'g'), '\\n', ' ', 'g'),
    '\n', ' ', 'g'), '[一-鿿]', '', 'g'), '^##', '') AS norm_text
FROM articles""",

    "relevance_filter": "WITH " + ARTICLES + f"""
SELECT a.article_id, a.datetime, CAST(coalesce(l.quality, 0) - coalesce(l.toxic, 0) AS DOUBLE) AS score
FROM articles a LEFT JOIN labels l ON a.article_id = l.doc_id
WHERE CAST(coalesce(l.quality, 0) - coalesce(l.toxic, 0) AS DOUBLE) >= {_dbl(rg.RELEVANCE_THRESHOLD)}""",

    "title_dedup_keep_last": "WITH " + ARTICLES + ",\n" + F1 + "\nSELECT article_id, datetime FROM f1",

    "near_dup_edges": _all_pairs(rg.NEAR_DUP_EPS),

    "near_dup_survivors": "WITH RECURSIVE " + _shingle_ctes(rg.NEAR_DUP_EPS) + """
SELECT f1.article_id, f1.datetime FROM f1 JOIN comp ON f1.article_id = comp.node
WHERE f1.article_id = comp.cluster_id""",

    "cluster_report": "WITH RECURSIVE " + _shingle_ctes(rg.NEAR_DUP_EPS) + """,
sizes AS (SELECT cluster_id, count(*) AS n_members FROM comp GROUP BY cluster_id HAVING count(*) > 1)
SELECT comp.cluster_id, comp.node AS article_id, CAST(comp.node = comp.cluster_id AS INTEGER) AS is_rep,
       f1.original_index, f1.title, n_members
FROM comp JOIN sizes USING (cluster_id) JOIN f1 ON f1.article_id = comp.node""",

    "dense_near_dup_edges": "WITH RECURSIVE " + _dense_ctes(rg.DENSE_EPS) + "\nSELECT id_a, id_b FROM dedges",

    "dense_clusters": "WITH RECURSIVE " + _dense_ctes(rg.DENSE_EPS) + """
SELECT node AS vec_id, min(lab) AS cluster_id FROM reach GROUP BY node""",

    "sentence_split": "WITH " + SPLIT + """
SELECT article_id, CAST(pos AS INTEGER) AS pos, sentence FROM sent""",

    "flatten_regroup": "WITH " + SPLIT + """
SELECT article_id, CAST(len(s) AS INTEGER) AS n_items,
       array_to_string(list_transform(s, lambda x: CAST(length(x) AS VARCHAR) || ':' || x), chr(31)) AS joined
FROM s""",

    "glossary_translate": "WITH " + SPLIT + ",\n" + GLOSS + """,
st AS (SELECT article_id, pos, string_split(sentence, ' ') AS ts FROM sent),
tok AS (SELECT article_id, pos, unnest(ts) AS tok, generate_subscripts(ts, 1) AS tpos FROM st)
SELECT article_id, CAST(pos AS INTEGER) AS pos, string_agg(coalesce(g.dst, tok.tok), ' ' ORDER BY tpos) AS translated
FROM tok LEFT JOIN g ON lower(tok.tok) = g.src GROUP BY article_id, pos""",

    "extractive_summary": "WITH " + SPLIT + f""",
tok AS (SELECT article_id, pos, unnest({wt('sentence')}) AS term FROM sent),
nd AS (SELECT CAST(count(DISTINCT article_id) AS DOUBLE) AS n_docs FROM s),
dfreq AS (SELECT term, count(DISTINCT article_id) AS df FROM tok GROUP BY term),
idf AS (SELECT term, ln(nd.n_docs / df) AS idf FROM dfreq, nd),
sc AS (SELECT article_id, pos, round(avg(idf), 6) AS score FROM tok JOIN idf USING (term) GROUP BY article_id, pos),
w AS (SELECT sent.article_id, sent.pos, sentence, len(string_split_regex(sentence, '[ \\t\\n\\r\\f]+')) AS nw,
        coalesce(sc.score, 0.0) AS score FROM sent LEFT JOIN sc USING (article_id, pos)),
r AS (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY score DESC, pos) AS rk,
        coalesce(sum(nw) OVER (PARTITION BY article_id ORDER BY score DESC, pos
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM w),
summ AS (SELECT article_id, string_agg(sentence, ' ' ORDER BY pos) AS summarized_text FROM r
         WHERE (rk <= {rg.SUMMARY_K} OR before < 10) AND (rk = 1 OR before + nw <= 250) GROUP BY article_id)
SELECT s.article_id, coalesce(summ.summarized_text, '') AS summarized_text FROM s LEFT JOIN summ USING (article_id)""",

    "paragraph_prefix": "WITH " + ARTICLES + f"""
SELECT article_id, {_prefix(rg.PREFIX_CHARS)} AS text_prefix
FROM (SELECT article_id, {PARAS} AS p FROM articles) WHERE len(p) >= 1""",

    "train_labels": "WITH " + ARTICLES + f""",
pp AS (SELECT article_id, {_prefix(rg.PREFIX_CHARS)} AS text
       FROM (SELECT article_id, {PARAS} AS p FROM articles) WHERE len(p) >= 1)
SELECT pp.article_id, CASE WHEN l.doc_id IS NOT NULL THEN 1 ELSE 0 END AS labels, pp.text
FROM pp LEFT JOIN (SELECT DISTINCT doc_id FROM labels WHERE quality = 1) l ON pp.article_id = l.doc_id""",

    "unlabeled_guard": "WITH " + ARTICLES + f"""
SELECT article_id, title, substring(text, 1, {rg.UNLABELED_CHARS}) AS text FROM articles
WHERE title IS NOT NULL AND length(title) >= 2 AND text IS NOT NULL AND length(text) >= 20
  AND regexp_matches(text, '\\p{{L}}')""",

    "token_keep_mask": "WITH " + ARTICLES + r"""
SELECT article_id, regexp_replace(array_to_string(k, ' '), '^##', '') AS kept_text, CAST(len(k) AS INTEGER) AS n_kept
FROM (SELECT article_id, list_filter(string_split(text, ' '),
        lambda t: (CASE WHEN regexp_matches(t, '\p{L}') THEN 0 ELSE 1 END) <> (CASE WHEN lang = 'en' THEN 1 ELSE 0 END)) AS k
      FROM articles)""",

    "step_entropy": "WITH " + STEPS + """
SELECT article_id, step, round(entropy, 6) AS entropy, argmax FROM e""",

    "uncertain_tokens": "WITH " + STEPS + f""",
ends AS (SELECT article_id, min(step) FILTER (WHERE argmax = {tb.END_TOKEN_ID}) AS end_step FROM e GROUP BY article_id),
hot AS (SELECT e.article_id, e.step, e.token FROM e JOIN ends USING (article_id)
        WHERE end_step IS NOT NULL AND e.step < end_step AND e.entropy >= {_dbl(tb.ENTROPY_THRESHOLD)}),
cap AS (SELECT article_id, string_agg(token, ' ' ORDER BY step) AS captured FROM hot GROUP BY article_id)
SELECT ends.article_id, coalesce(cap.captured, 'pass') AS captured FROM ends LEFT JOIN cap USING (article_id)""",

    "only_uncertain": "WITH " + STEPS + f""",
ends AS (SELECT article_id, min(step) FILTER (WHERE argmax = {tb.END_TOKEN_ID}) AS end_step FROM e GROUP BY article_id)
SELECT e.article_id, string_agg(e.token, ' ' ORDER BY step) AS captured FROM e JOIN ends USING (article_id)
WHERE end_step IS NOT NULL AND e.step < end_step AND e.entropy >= {_dbl(tb.ENTROPY_THRESHOLD)}
GROUP BY e.article_id""",

    "prompted_text": "WITH " + SPLIT + """
SELECT article_id, 'summarize: ' || array_to_string(s, ' ') AS prompt FROM s""",

    "scored_relations": "WITH RECURSIVE " + SCORED + f""",
n AS (SELECT l_orderkey AS article_id, count(*) AS n FROM lineitem GROUP BY l_orderkey),
model AS (SELECT hyp.*, (n * 7 + prop_ord * 3) % 11 / 10.0 AS p FROM hyp JOIN n USING (article_id))
SELECT article_id, sbj_idx, obj_idx, prop AS relation, round(CAST(p AS DOUBLE), 9) AS prob
FROM (SELECT * FROM model QUALIFY row_number() OVER (
        PARTITION BY article_id, sbj_idx, obj_idx ORDER BY p DESC, prop_ord, t_ord) = 1)
WHERE p > {_dbl(rg.RELATION_THRESHOLD)}""",

    "cluster_rep": "WITH " + SPANS + """
SELECT k.article_id, k.cluster_id, best.rep FROM (SELECT DISTINCT article_id, cluster_id FROM d) k
LEFT JOIN best USING (article_id, cluster_id)""",

    "coref_rewrite": "WITH " + SPANS + """,
sp AS (SELECT spans.article_id, spans.start, spans."end", best.rep FROM spans JOIN best USING (article_id, cluster_id)
       WHERE best.rep IS NOT NULL),
pc AS (SELECT *, coalesce(lag("end") OVER (PARTITION BY article_id ORDER BY start), 0) AS prev FROM sp),
agg AS (SELECT pc.article_id, string_agg(substring(doc.text, prev + 1, start - prev) || rep, '' ORDER BY start) AS body,
          max("end") AS last_end FROM pc JOIN documents doc ON doc.doc_id = pc.article_id GROUP BY pc.article_id)
SELECT doc_id AS article_id, CASE WHEN agg.article_id IS NULL THEN text
       ELSE body || substring(text, last_end + 1) END AS resolved_text
FROM documents LEFT JOIN agg ON documents.doc_id = agg.article_id""",

    "coref_nested": "WITH RECURSIVE " + NESTED + """,
sp AS (SELECT DISTINCT spans.article_id, spans.start, spans."end", best.rep
       FROM spans JOIN best USING (article_id, cluster_id) WHERE best.rep IS NOT NULL),
ks(article_id, start, "end", rep) AS (
  SELECT * FROM sp QUALIFY row_number() OVER (PARTITION BY article_id ORDER BY start, "end" DESC, rep) = 1
  UNION ALL
  SELECT article_id, start, "end", rep FROM (
    SELECT sp.*, row_number() OVER (PARTITION BY sp.article_id ORDER BY sp.start, sp."end" DESC, sp.rep) AS r
    FROM ks JOIN sp ON sp.article_id = ks.article_id AND sp.start >= ks."end") WHERE r = 1),
pc AS (SELECT *, coalesce(lag("end") OVER (PARTITION BY article_id ORDER BY start), 0) AS prev FROM ks),
agg AS (SELECT pc.article_id, string_agg(substring(doc.text, prev + 1, start - prev) || rep, '' ORDER BY start) AS body,
          max("end") AS last_end, count(*) AS n
        FROM pc JOIN documents doc ON doc.doc_id = pc.article_id GROUP BY pc.article_id),
alls AS (SELECT article_id, count(*) AS n_all FROM sp GROUP BY article_id)
SELECT doc_id AS article_id, CASE WHEN agg.article_id IS NULL THEN text
       ELSE body || substring(text, last_end + 1) END AS resolved_text, coalesce(n < n_all, false) AS nested_spans
FROM documents LEFT JOIN agg ON documents.doc_id = agg.article_id
LEFT JOIN alls ON documents.doc_id = alls.article_id""",

    "step_entropy_long": "WITH " + STEPS + """
SELECT article_id, step, round(entropy, 6) AS entropy, argmax FROM e""",

    "learned_abbreviations": "WITH " + TYPES + """
SELECT type, n_dot, n_plain, round(score, 6) AS score FROM abbr WHERE score >= 0.3""",

    "learned_sentences": "WITH " + TYPES + SPLIT[len(ARTICLES):] + r""",
b AS (SELECT article_id, pos, sentence, lag(sentence) OVER (PARTITION BY article_id ORDER BY pos) AS prev FROM sent),
e AS (SELECT *, CASE WHEN prev LIKE '%.' THEN regexp_replace(lower(regexp_replace(
          regexp_extract(prev, '[^ \t\n\r\f]+$'), '^["''(\[“‘«]+', '')), '\.$', '') END AS before,
        regexp_replace(regexp_replace(regexp_extract(sentence, '^[^ \t\n\r\f]+'), '^["''(\[“‘«]+', ''),
          '[^\p{L}\p{N}.]+$', '') AS fw FROM b),
gl AS (SELECT article_id, pos, sentence,
         coalesce(before IN (SELECT type FROM abbr WHERE score >= 0.3)
           AND NOT (regexp_matches(fw, '^\p{Lu}') AND regexp_replace(lower(fw), '\.$', '') IN
             (SELECT type FROM types WHERE n_lower > 0 AND n_inside_upper = 0)), false) AS glue FROM e),
gr AS (SELECT *, sum(CASE WHEN glue THEN 0 ELSE 1 END) OVER (PARTITION BY article_id ORDER BY pos) - 1 AS g FROM gl)
SELECT article_id, CAST(g AS INTEGER) AS pos, string_agg(sentence, ' ' ORDER BY pos) AS sentence
FROM gr GROUP BY article_id, g""",

    "class_closure": "WITH RECURSIVE " + ONTO + "\nSELECT name, ancestor FROM clo",

    "candidate_relations": "WITH RECURSIVE " + ONTO + "\nSELECT sbj_type, obj_type, prop FROM cand",

    "first_mentions": "WITH RECURSIVE " + ENTS + "\nSELECT article_id, pos, word, entity_group FROM firstm",

    "coarse_type": "WITH RECURSIVE " + ENTS + "\nSELECT article_id, word, type, branch FROM ct",

    "fine_type": "WITH RECURSIVE " + ENTS + "\nSELECT article_id, eidx, text, type FROM ents",

    "hypotheses": "WITH RECURSIVE " + SCORED + """
SELECT article_id, sbj_idx, obj_idx, prop AS relation, hypothesis, round(prob, 9) AS prob FROM sc""",

    "best_relation": "WITH RECURSIVE " + SCORED + """
SELECT article_id, sbj_idx, obj_idx, prop AS relation, round(prob, 9) AS prob FROM best""",

    "triplets": "WITH RECURSIVE " + SCORED + """,
en AS (SELECT article_id, count(*) AS n, string_agg(text || '/' || type, ';' ORDER BY eidx) AS s FROM ents
       GROUP BY article_id),
re AS (SELECT article_id, count(*) AS n, string_agg(sbj_text || '|' || prop || '|' || obj_text, ';'
         ORDER BY sbj_idx, obj_idx) AS s FROM best GROUP BY article_id)
SELECT prem.article_id, CAST(coalesce(en.n, 0) AS INTEGER) AS n_entities, CAST(coalesce(re.n, 0) AS INTEGER) AS n_relations,
       coalesce(en.s, '') AS entities, coalesce(re.s, '') AS relations
FROM prem LEFT JOIN en USING (article_id) LEFT JOIN re USING (article_id)""",

    # the longest phrase at each place, then from left to right: the next kept match begins at or behind the end of
    # the one before
    "gazetteer_mentions": "WITH RECURSIVE " + GAZ + """,
dt AS (SELECT doc_id AS article_id, string_split(text, ' ') AS ts FROM documents),
tk AS (SELECT article_id, unnest(ts) AS tok, generate_subscripts(ts, 1) - 1 AS pos FROM dt),
nx AS (SELECT *, lead(tok) OVER (PARTITION BY article_id ORDER BY pos) AS tok2 FROM tk),
m AS (SELECT article_id, pos, tok AS phrase, 1 AS plen FROM nx
      UNION ALL SELECT article_id, pos, tok || ' ' || tok2, 2 FROM nx WHERE tok2 IS NOT NULL),
hits AS (SELECT m.*, g.entity_group FROM m JOIN g ON m.phrase = g.phrase AND len(string_split(g.phrase, ' ')) = m.plen),
best AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY article_id, pos ORDER BY plen DESC) = 1),
nxt AS (SELECT a.*, b.pos AS next_pos FROM (SELECT *, pos + plen AS reach FROM best) a
        ASOF LEFT JOIN best b ON a.article_id = b.article_id AND a.reach <= b.pos),
kept AS (SELECT * FROM nxt QUALIFY row_number() OVER (PARTITION BY article_id ORDER BY pos) = 1
         UNION ALL SELECT n.* FROM kept k JOIN nxt n ON n.article_id = k.article_id AND n.pos = k.next_pos)
SELECT article_id, CAST(pos AS INTEGER) AS pos, phrase AS word, entity_group FROM kept""",

    "high_water_mark": """SELECT max(strftime(ts, '%Y%m%d')) AS mark FROM events
WHERE ts IS NOT NULL""",

    "catch_up_days": """WITH ev AS (SELECT strftime(ts, '%Y%m%d') AS datetime, ts FROM events),
mid AS (SELECT epoch_us(min(ts)) + (epoch_us(max(ts)) - epoch_us(min(ts))) / 2 AS m FROM events),
lo AS (SELECT max(strftime(ts, '%Y%m%d')) AS l FROM events, mid WHERE epoch_us(ts) < mid.m),
hi AS (SELECT max(datetime) AS r FROM ev WHERE datetime IS NOT NULL),
cal AS (SELECT strftime(d, '%Y%m%d') AS datetime
        FROM lo, hi, unnest(generate_series(strptime(l, '%Y%m%d'), strptime(r, '%Y%m%d'), INTERVAL 1 DAY)) AS t(d))
SELECT datetime, count(*) AS n_rows FROM ev WHERE datetime IN (SELECT datetime FROM cal) GROUP BY datetime""",

    "daily_counts": "WITH " + ARTICLES + "\nSELECT datetime, count(*) AS n_articles FROM articles GROUP BY datetime",

    "dense_index_chunks": "WITH " + ARTICLES + f""",
ix AS (SELECT article_id, title, text, row_number() OVER (ORDER BY article_id) - 1 AS index FROM articles)
SELECT article_id, index, CAST(floor(index / {rg.CHUNK_ROWS}) AS BIGINT) AS chunk, title,
       CAST(length(text) AS INTEGER) AS text_chars FROM ix""",

    "nli_entailment": f"""WITH li AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER}) - 1 AS rn FROM lineitem),
z AS (SELECT l_orderkey AS article_id, CAST(rn AS INTEGER) AS step,
        [(l_discount * 10.0) * 5.0, (l_tax * 10.0) * 5.0, (l_quantity / 50.0) * 5.0] AS z FROM li)
SELECT article_id, step,
  round(exp(z[1] - list_max(z)) / list_sum(list_transform(z, lambda x: exp(x - list_max(z)))), 9) AS p_neutral,
  round(exp(z[1] - greatest(z[1], z[3])) / (exp(z[1] - greatest(z[1], z[3])) + exp(z[3] - greatest(z[1], z[3]))), 9)
    AS p_two_way
FROM z""",

    "relevance_model": "WITH " + ARTICLES + f""",
t AS (SELECT article_id, {wt("concat_ws(' ', title, text)")} AS ts FROM articles),
known AS (SELECT t.article_id, ts, quality AS y FROM t JOIN labels l ON l.doc_id = t.article_id
          WHERE quality IN (0, 1)),
counts AS (SELECT term, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg
           FROM (SELECT y, unnest(ts) AS term FROM known) GROUP BY term),
totals AS (SELECT sum(pos) AS p, sum(neg) AS n, count(*) AS v FROM counts),
weights AS (SELECT term, ln((pos + 1) / (p + v)) - ln((neg + 1) / (n + v)) AS w FROM counts, totals),
prior AS (SELECT ln(count(*) FILTER (y = 1) + 1) - ln(count(*) FILTER (y = 0) + 1) AS prior FROM known),
sums AS (SELECT article_id, sum(w) AS w
         FROM (SELECT article_id, unnest(ts) AS term FROM t) JOIN weights USING (term)
         GROUP BY article_id)
SELECT article_id, round(prior + coalesce(w, 0), 6) AS score
FROM t LEFT JOIN sums USING (article_id), prior
WHERE prior + coalesce(w, 0) >= {_dbl(rg.RELEVANCE_THRESHOLD)}""",

    "predicted_positives": "WITH " + STEPS + """
SELECT article_id, step, argmax AS pred FROM e WHERE argmax = 1""",

    "confusion": "WITH " + STEPS + """
SELECT label, argmax AS pred, count(*) AS n FROM e GROUP BY label, argmax""",

    "all_relations": "WITH RECURSIVE " + SCORED + f"""
SELECT article_id, sbj_idx, obj_idx, prop AS relation, round(prob, 9) AS prob FROM sc
WHERE prob > {_dbl(rg.RELATION_THRESHOLD)}""",

    "tweet_clean": r"""SELECT conv_id, turn, t AS text FROM (
  SELECT conv_id, turn, regexp_replace(text, 'https?://t\.co[^\n]*', '', 'g') AS t FROM conversations)
WHERE length(t) >= 10""",
}
