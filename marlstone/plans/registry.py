"""Every query of the core library with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import chunks as C
from ..operators import dedup as D
from ..operators import dialogue as L
from ..operators import facets as A
from ..operators import judging as J
from ..operators import mining as M
from ..operators import retrieval as R
from ..operators import sequential as X
from ..streaming import windows as W
from .views import CARDS, CHUNKS, NORMAL, TOKENS, cards, chunks, table

KINDS = {"number": "cat", "customer": "cat", "region": "cat", "nation": "cat", "phase": "cat", "procedure": "cat", "price": "num", "published": "date"}
FIELDS = ["customer", "region", "nation", "phase", "procedure"]

Q: dict = {}
S: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            S[f.__name__] = sql
        return f

    return add


def _load():
    from . import records, stages, tasks  # noqa: F401, they register their queries here


def queries():
    _load()
    return dict(Q)


def oracle_sql():
    _load()
    return dict(S)


def bench(spark, d):
    return table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def vectors(spark, d):
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label")


UNIT = "('0x' || substr(md5('{0}:' || {1}), 1, 8))::UBIGINT / 4294967296.0::DOUBLE"
PAIRS = """pairs AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b, a.label AS la, b.label AS lb,
  round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS sim FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)"""
STEM = "CASE WHEN length(w) <= 4 OR regexp_matches(w, '^[0-9]+$') THEN w ELSE regexp_replace(w, '^(.{{4,}}?)({})$', '\\1') END".format("|".join(sorted(T.SUFFIXES, key=lambda s: (-len(s), s))))
WORDS = "words AS (SELECT chunk_id, len(ws) AS dl, ws FROM (SELECT chunk_id, " + TOKENS.format("raw_text") + " AS ws FROM chunks) WHERE len(ws) > 0)"


def stems(text: str) -> str:
    return f"list_transform({TOKENS.format(text)}, lambda w: {STEM})"


def bm25_sql(text: str, queries: str = "SELECT item_id AS query_id, text FROM benchmark", source: str = "chunks") -> str:
    return f"""words AS MATERIALIZED (SELECT chunk_id, len(ws) AS dl, ws FROM (SELECT chunk_id, {stems(text)} AS ws FROM {source}) WHERE len(ws) > 0),
tf AS MATERIALIZED (SELECT chunk_id, dl, token, count(*) AS tf FROM (SELECT chunk_id, dl, unnest(ws) AS token FROM words) GROUP BY ALL),
df AS (SELECT token, count(*) AS df FROM tf GROUP BY token),
corpus AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM words),
terms AS (SELECT DISTINCT query_id, unnest({stems('text')}) AS token FROM ({queries})),
scores AS MATERIALIZED (SELECT query_id, chunk_id, round(sum(greatest(0, ln((n - df + 0.5) / (df + 0.5) + 1)) * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / avgdl))), 6) AS score
  FROM tf JOIN df USING (token) JOIN terms USING (token), corpus GROUP BY ALL),
ranked AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM scores)"""


BM25 = f"WITH {CHUNKS}, {bm25_sql('raw_text')}"


@query(f"WITH {CHUNKS} SELECT chunk_id, file_name, idx, concat_ws(chr(10), nullif(title, ''), 'lang: ' || lang || ' | source: ' || source, raw_text) AS passage, CAST(length(raw_text) AS BIGINT) AS n_chars FROM chunks")
def chunk_store(spark, d):
    header = F.concat(F.lit("lang: "), F.col("lang"), F.lit(" | source: "), F.col("source"))
    return chunks(spark, d).select("chunk_id", "file_name", "idx", F.concat_ws("\n", F.nullif(F.col("title"), F.lit("")), header, "raw_text").alias("passage"), F.length("raw_text").cast("long").alias("n_chars"))


ELIGIBLE = r"""(length(raw_text) BETWEEN 200 AND 4000 AND length(raw_text) > 0
  AND (CASE WHEN trim(regexp_replace(raw_text, '\s+', ' ', 'g')) = '' THEN 0 ELSE len(string_split(trim(regexp_replace(raw_text, '\s+', ' ', 'g')), ' ')) END) >= 25
  AND length(regexp_replace(raw_text, '[^\p{L}]+', '', 'g')) >= 0.5 * length(regexp_replace(raw_text, '\s+', '', 'g'))
  AND length(regexp_replace(raw_text, '[^\p{Latin}]+', '', 'g')) >= 0.3 * length(regexp_replace(raw_text, '[^\p{L}]+', '', 'g')))"""


@query(f"WITH {CHUNKS} SELECT chunk_id, {ELIGIBLE} AS eligible FROM chunks")
def seed_eligibility(spark, d):
    return chunks(spark, d).select("chunk_id", C.eligible(F.col("raw_text")).alias("eligible"))


@query(f"""WITH {CHUNKS},
c AS (SELECT *, length(raw_text) AS n, count(*) OVER (PARTITION BY file_name) AS k, {ELIGIBLE} AS ok, {UNIT.format('w', 'chunk_id')} AS u, {UNIT.format('wo', 'chunk_id')} AS o,
  coalesce(lead(length(raw_text), 1) OVER f, 0) AS n1, coalesce(lead(length(raw_text), 2) OVER f, 0) AS n2, coalesce(lead(length(raw_text), 3) OVER f, 0) AS n3
  FROM chunks WINDOW f AS (PARTITION BY file_name ORDER BY idx)),
m AS (SELECT *, least(CASE WHEN u < 0.5 THEN 2 WHEN u < 0.85 THEN 3 ELSE 4 END, k - idx) AS m0 FROM c WHERE ok AND k - idx >= 2),
t AS (SELECT *, CASE WHEN m0 > 2 AND n + n1 + (CASE WHEN m0 > 2 THEN n2 ELSE 0 END) + (CASE WHEN m0 > 3 THEN n3 ELSE 0 END) > 9000 THEN 2 ELSE m0 END AS m FROM m),
z AS (SELECT *, n + n1 + (CASE WHEN m > 2 THEN n2 ELSE 0 END) + (CASE WHEN m > 3 THEN n3 ELSE 0 END) AS n_chars FROM t),
r AS (SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY o, idx) AS rn FROM z WHERE n_chars <= 9000),
w AS (SELECT *, array_to_string(range(idx, idx + m), ', ') AS indices FROM r WHERE rn <= 6)
SELECT 'w_' || substr(sha1(file_name || '|[' || indices || ']'), 1, 12) AS window_id, file_name, indices, CAST(n_chars AS BIGINT) AS n_chars FROM w""")
def neighbour_windows(spark, d):
    return C.neighbour_windows(chunks(spark, d))


@query(f"""WITH RECURSIVE {CHUNKS},
s AS (SELECT file_name, idx, length(raw_text) AS n FROM chunks),
walk AS (SELECT file_name, idx, n AS chars, 1 AS count, 0 AS unit, 0::BIGINT AS first FROM s WHERE idx = 0
  UNION ALL SELECT s.file_name, s.idx, CASE WHEN w.chars + s.n > 3000 OR w.count >= 8 THEN s.n ELSE w.chars + s.n END,
    CASE WHEN w.chars + s.n > 3000 OR w.count >= 8 THEN 1 ELSE w.count + 1 END, CASE WHEN w.chars + s.n > 3000 OR w.count >= 8 THEN w.unit + 1 ELSE w.unit END,
    CASE WHEN w.chars + s.n > 3000 OR w.count >= 8 THEN s.idx ELSE w.first END FROM walk w JOIN s ON s.file_name = w.file_name AND s.idx = w.idx + 1)
SELECT file_name, CAST(unit AS BIGINT) AS unit, min(first) AS first, max(idx) AS last FROM walk GROUP BY file_name, unit""")
def doc_units(spark, d):
    return C.packed_units(chunks(spark, d))


@query(f"SELECT item_id, array_to_string(list_transform({TOKENS.format('text')}, lambda w: {STEM}), ' ') AS stems FROM benchmark")
def tokenize_stem(spark, d):
    return table(spark, d, "benchmark").select("item_id", F.array_join(F.transform(T.tokens(F.col("text")), lambda w: T.stem(w)), " ").alias("stems"))


@query(f"""WITH {CHUNKS}, {WORDS}, tf AS (SELECT chunk_id, token, count(*) AS tf FROM (SELECT chunk_id, unnest(ws) AS token FROM words) GROUP BY ALL), n AS (SELECT count(*) AS n FROM words)
SELECT token, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf, round(greatest(0, ln((max(n) - count(*) + 0.5) / (count(*) + 0.5) + 1)), 6) AS idf FROM tf, n GROUP BY token""")
def term_statistics(spark, d):
    return R.term_statistics(chunks(spark, d))


@query(f"{BM25} SELECT query_id, chunk_id, score, rank FROM ranked WHERE rank <= 10")
def bm25_topk(spark, d):
    return R.bm25(chunks(spark, d), bench(spark, d))


@query(f"WITH {PAIRS}, r AS (SELECT a AS query_id, b AS id, sim AS score, row_number() OVER (PARTITION BY a ORDER BY sim DESC, b) AS rank FROM pairs) SELECT * FROM r WHERE rank <= 10")
def dense_topk(spark, d):
    return R.dense_topk(vectors(spark, d), vectors(spark, d))


BOW = f"""bow AS (SELECT id, b, count(*) AS c FROM (SELECT id, ('0x' || substr(md5(w), 31, 2))::UBIGINT AS b FROM (SELECT item_id AS id, unnest({TOKENS.format('text')}) AS w FROM benchmark)) GROUP BY ALL),
unit AS (SELECT id, b, c / sqrt(sum(c * c) OVER (PARTITION BY id)) AS x FROM bow)"""


@query(f"WITH {BOW} SELECT id, string_agg(b || ':' || CAST(CAST(round(x * 1e6) AS BIGINT) AS VARCHAR), ' ' ORDER BY b) AS vec FROM unit GROUP BY id")
def bow_embedding(spark, d):
    rows = R.bow_embedding(bench(spark, d).select(F.col("query_id").alias("id"), "text"))
    each = F.filter(F.transform("vec", lambda x, i: F.struct(i.alias("b"), x.alias("x"))), lambda p: p["x"] > 0)
    return rows.select("id", F.array_join(F.transform(each, lambda p: F.concat(p["b"].cast("string"), F.lit(":"), F.round(p["x"] * 1e6).cast("long").cast("string"))), " ").alias("vec"))


def _gold_chunks(c, b):
    """(query_id, chunk_id): the chunks that hold a query's text."""
    return R.containing(c.select("chunk_id", F.col("raw_text").alias("whole")), b.select("query_id", F.col("text").alias("span")))


def _bow_ranks(spark, d, k):
    rows = R.bow_embedding(bench(spark, d).select(F.col("query_id").alias("id"), "text"))
    return R.dense_topk(rows, rows, k, positive=True)


@query(f"""WITH {BOW}, sims AS (SELECT p.id AS query_id, q.id, round(sum(p.x * q.x), 6) AS s FROM unit p JOIN unit q USING (b) WHERE p.id <> q.id GROUP BY ALL),
lex AS (SELECT p.item_id AS query_id, q.item_id AS id, len(list_intersect({TOKENS.format('p.text')}, {TOKENS.format('q.text')})) AS n FROM benchmark p, benchmark q WHERE p.item_id <> q.item_id),
l AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY n DESC, id) AS rank FROM lex),
v AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank FROM sims),
u AS (SELECT query_id, id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS rrf FROM (SELECT * FROM l WHERE rank <= 100 UNION ALL SELECT * FROM v WHERE rank <= 100) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rrf DESC, id) AS rank FROM u) SELECT * FROM r WHERE rank <= 10""")
def rrf_fusion(spark, d):
    words = bench(spark, d).select("query_id", F.array_distinct(T.tokens(F.col("text"))).alias("ws"))
    ids = words.select("query_id")
    one, two = words.select("query_id", F.explode("ws").alias("w")), words.select(F.col("query_id").alias("id"), F.explode("ws").alias("w"))
    n = one.join(two, "w").groupBy("query_id", "id").agg(F.count("*").alias("n"))
    every = ids.crossJoin(ids.withColumnRenamed("query_id", "id")).where("query_id <> id").join(n, ["query_id", "id"], "left").fillna(0, "n")
    from pyspark.sql import Window

    best = Window.partitionBy("query_id").orderBy(F.desc("n"), "id")
    lexical = every.withColumn("rank", F.row_number().over(best)).where("rank <= 100")
    return R.fuse([lexical, _bow_ranks(spark, d, 100)])


@query(f"""{BM25}, best AS (SELECT query_id, max(score) AS best FROM scores GROUP BY query_id),
gold AS (SELECT s.query_id, s.chunk_id, s.score FROM scores s JOIN chunks c USING (chunk_id) JOIN benchmark b ON b.item_id = s.query_id WHERE contains(c.raw_text, b.text)),
g AS (SELECT query_id, min(CASE WHEN best <= 0 THEN 1 ELSE least(1, greatest(0, 1 - greatest(0, score) / best)) END) AS gap, count(*) AS n_gold FROM gold JOIN best USING (query_id) GROUP BY query_id)
SELECT item_id AS query_id, round(coalesce(gap, 1), 6) AS gap, CASE WHEN coalesce(gap, 1) <= 0.33 THEN 'low' WHEN coalesce(gap, 1) <= 0.66 THEN 'mid' ELSE 'high' END AS bin, coalesce(n_gold, 0) AS n_gold
FROM benchmark LEFT JOIN g ON query_id = item_id""")
def query_gaps(spark, d):
    c, b = chunks(spark, d), bench(spark, d)
    index = R.lexical_index(c)
    best = R.bm25(c, b, k=1, index=index).select("query_id", F.col("score").alias("best"))
    gold = R.bm25_pairs(index, c, b, _gold_chunks(c, b))
    gaps = gold.join(best, "query_id").groupBy("query_id").agg(F.min(R.gap(F.col("score"), F.col("best"))).alias("gap"), F.count("*").alias("n_gold"))
    out = b.join(gaps, "query_id", "left")
    g = F.coalesce("gap", F.lit(1.0))
    return out.select("query_id", F.round(g, 6).alias("gap"), R.gap_bin(g).alias("bin"), F.coalesce("n_gold", F.lit(0)).alias("n_gold"))


@query(f"""{BM25}, top AS (SELECT * FROM ranked WHERE rank <= 10),
gold AS (SELECT b.item_id AS query_id, c.chunk_id FROM chunks c JOIN benchmark b ON contains(c.raw_text, b.text)),
h AS (SELECT g.query_id, count(*) AS n_gold, count(t.chunk_id) AS n_hit FROM gold g LEFT JOIN top t ON t.query_id = g.query_id AND t.chunk_id = g.chunk_id GROUP BY g.query_id)
SELECT query_id, n_gold, n_hit, n_hit < n_gold AS broad, n_hit > 0 AS reached FROM h""")
def gate_broad_reach(spark, d):
    c, b = chunks(spark, d), bench(spark, d)
    top = R.bm25(c, b).select("query_id", "chunk_id", F.lit(1).alias("hit"))
    gold = _gold_chunks(c, b)
    h = gold.join(top, ["query_id", "chunk_id"], "left").groupBy("query_id").agg(F.count("*").alias("n_gold"), F.count("hit").alias("n_hit"))
    return h.select("query_id", "n_gold", "n_hit", (F.col("n_hit") < F.col("n_gold")).alias("broad"), (F.col("n_hit") > 0).alias("reached"))


@query(f"""{BM25}, top AS (SELECT r.*, c.file_name FROM ranked r JOIN chunks c USING (chunk_id) WHERE rank <= 20), best AS (SELECT query_id, max(score) AS best FROM top GROUP BY query_id)
SELECT query_id, count(DISTINCT file_name) AS referents, count(DISTINCT file_name) >= 2 AS ambiguous FROM top JOIN best USING (query_id) WHERE score >= 0.85 * best AND best > 0 GROUP BY query_id""")
def gate_ambiguous(spark, d):
    c = chunks(spark, d)
    top = R.bm25(c, bench(spark, d), k=20).join(c.select("chunk_id", "file_name"), "chunk_id")
    best = top.groupBy("query_id").agg(F.max("score").alias("best"))
    band = top.join(best, "query_id").where("score >= 0.85 * best AND best > 0")
    return band.groupBy("query_id").agg(F.countDistinct("file_name").alias("referents"), (F.countDistinct("file_name") >= 2).alias("ambiguous"))


SHAPE = f"drawn AS (SELECT vec_id FROM embeddings ORDER BY {UNIT.format('shape', 'vec_id')}, vec_id LIMIT 600), shape AS (SELECT sim FROM pairs WHERE a < b AND a IN (SELECT vec_id FROM drawn) AND b IN (SELECT vec_id FROM drawn))"


def _shape(spark, d):
    return M.shape_sample(vectors(spark, d))


@query(f"WITH {PAIRS} SELECT vec_id AS id, CAST(coalesce(n, 0) AS BIGINT) AS density FROM embeddings LEFT JOIN (SELECT a, count(*) AS n FROM pairs WHERE sim > 0.3 GROUP BY a) ON a = vec_id")
def knn_density(spark, d):
    return M.density(vectors(spark, d), 0.3)


@query(f"WITH {PAIRS}, {SHAPE} SELECT count(*) AS n_pairs, round(avg(sim), 6) AS mean, round(stddev_pop(sim), 6) AS sd, " + ", ".join(f"round(quantile_cont(sim, {p}), 6) AS p{round(p * 100)}" for p in (0.5, 0.8, 0.95, 0.99)) + " FROM shape")
def similarity_shape(spark, d):
    """All pairs of a drawn sample of 600 vectors, as the sampling operator asks."""
    return M.similarity_shape(_shape(spark, d))


@query(f"""WITH {PAIRS}, r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY sim DESC, b) AS rank FROM pairs), k AS MATERIALIZED (SELECT a AS id, sim AS kth FROM r WHERE rank = 3)
SELECT p.a, p.b, p.sim, p.sim >= ka.kth OR p.sim >= kb.kth AS co_retrievable FROM pairs p JOIN k ka ON ka.id = p.a JOIN k kb ON kb.id = p.b WHERE p.a < p.b AND p.la = p.lb""")
def co_retrievable(spark, d):
    v = vectors(spark, d)
    kth = M.kth_similarity(R.dense_topk(v, v, 3), 3)
    pairs = M.pair_similarities(v.join(kth, "id"), "label", value="kth")
    return pairs.select("a", "b", "sim", ((F.col("sim") >= F.col("va")) | (F.col("sim") >= F.col("vb"))).alias("co_retrievable"))


@query(f"""WITH {PAIRS}, {SHAPE}, low AS (SELECT quantile_cont(sim, 0.95) AS low FROM shape)
SELECT CAST(la AS BIGINT) AS scope, a, b, sim FROM pairs, low WHERE a < b AND la = lb AND sim >= low""")
def scope_similarity_pairs(spark, d):
    v = vectors(spark, d)
    low = _shape(spark, d).agg(F.percentile("sim", F.lit(0.95))).first()[0]
    pairs = M.pair_similarities(v, "label", 2.0 if low is None else low, "label")
    return pairs.select(F.col("va").cast("long").alias("scope"), "a", "b", "sim")


@query(f"""WITH {PAIRS}, {SHAPE}, t AS (SELECT quantile_cont(sim, 0.95) AS hi, quantile_cont(sim, 0.8) AS lo FROM shape),
best AS (SELECT la AS task, b AS donor, max(sim) AS best FROM pairs WHERE la <> lb GROUP BY ALL)
SELECT CAST(task AS BIGINT) AS task, donor, best, CASE WHEN best < lo THEN 'far' WHEN best < hi THEN 'band' ELSE 'near' END AS pool FROM best, t""")
def donor_pools(spark, d):
    v = vectors(spark, d)
    t = _shape(spark, d).agg(F.percentile("sim", F.lit(0.95)).alias("hi"), F.percentile("sim", F.lit(0.8)).alias("lo"))
    names = v.select(F.col("label").cast("long").alias("task"), F.xxhash64("label").alias("g")).distinct()
    best = M.best_by_group(v, "label").join(names, "g").crossJoin(F.broadcast(t))  # t is one row
    return best.select("task", "donor", "best", F.when(F.col("best") < F.col("lo"), "far").when(F.col("best") < F.col("hi"), "band").otherwise("near").alias("pool"))


@query(f"WITH {PAIRS}, r AS (SELECT a AS query_id, b AS id, sim AS score, row_number() OVER (PARTITION BY a ORDER BY sim DESC, b) AS rank FROM pairs WHERE la <> lb) SELECT * FROM r WHERE rank <= 5")
def hard_negatives(spark, d):
    v = vectors(spark, d)
    return R.dense_topk(v, v, 5, other="label")


def _docs(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")


@query(f"SELECT sha1({NORMAL.format('text')}) AS hash, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1")
def exact_duplicates(spark, d):
    return D.duplicate_groups(_docs(spark, d), T.content_hash)


@query(f"WITH {CHUNKS} SELECT sha1(regexp_replace({NORMAL.format('raw_text')}, '[0-9]+', '#', 'g')) AS hash, count(*) AS n, min(chunk_id) AS first_id FROM chunks GROUP BY 1 HAVING count(*) > 1")
def structural_duplicates(spark, d):
    return D.duplicate_groups(chunks(spark, d).select(F.col("chunk_id").alias("id"), F.col("raw_text").alias("text")), T.template_hash)


SHINGLES = "CASE WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')] ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END"


@query(f"""WITH g AS (SELECT item_id, {SHINGLES} AS g FROM (SELECT conv_id * 1000 + turn AS item_id, {TOKENS.format('text')} AS ws FROM conversations))
SELECT a.item_id AS a, b.item_id AS b, round(len(list_intersect(a.g, b.g)) / (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g))), 6) AS jaccard FROM g a JOIN g b ON a.item_id < b.item_id AND len(list_intersect(a.g, b.g)) > 0""")
def shingle_jaccard(spark, d):
    return D.shingle_pairs(table(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text"))


MINHASH = "list_transform(range(64), lambda p: list_min(list_transform(g, lambda s: ('0x' || substr(md5(p || ':' || s), 1, 8))::UBIGINT)))"


@query(f"WITH g AS (SELECT item_id, {SHINGLES} AS g FROM (SELECT item_id, {TOKENS.format('text')} AS ws FROM benchmark)) SELECT item_id, array_to_string({MINHASH}, ',') AS signature FROM g")
def minhash_signature(spark, d):
    s = T.minhash(T.shingles(T.tokens(F.col("text")), 4))
    return table(spark, d, "benchmark").select("item_id", F.array_join(s.cast("array<string>"), ",").alias("signature"))


@query()
def minhash_dedup_greedy(spark, d):
    """User turns of the conversations; sequential semantics, held against a plain loop in the tests."""
    turns = table(spark, d, "conversations").where("role = 'user'").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text").where("text IS NOT NULL")
    return L.with_checkpoints(spark, lambda: D.keep_first(turns.select("id"), D.signature_edges(turns)))


def _entity_sql(p, group, name, order):
    return f"SELECT chunk_id, lower(trim(unnest(regexp_extract_all(raw_text, '{p}', {group})))) AS entity, {order} AS o, '{name}' AS type FROM chunks"


MENTIONS = f"{CHUNKS}, mentions AS (SELECT entity, chunk_id, min_by(type, o) AS type FROM (" + " UNION ALL ".join(_entity_sql(p, g, n, i) for i, (n, p, g) in enumerate(M.PATTERNS)) + ") GROUP BY entity, chunk_id)"


@query(f"WITH {MENTIONS} SELECT entity, chunk_id, type FROM mentions")
def entity_mentions(spark, d):
    return M.mentions(chunks(spark, d)).select("entity", "chunk_id", "type")


@query(f"WITH {MENTIONS} SELECT entity, count(*) AS df, round(ln((SELECT count(*) FROM chunks) / count(*)), 6) AS idf FROM mentions GROUP BY entity")
def entity_idf(spark, d):
    return M.entity_idf(chunks(spark, d))


@query(f"""WITH {MENTIONS}, i AS (SELECT round(ln((SELECT count(*) FROM chunks) / count(*)), 6) AS idf FROM mentions GROUP BY entity HAVING count(*) >= 2)
SELECT list_sort(list(idf))[CAST(round_even(0.75 * (count(*) - 1), 0) AS BIGINT) + 1] AS threshold, count(*) AS n FROM i""")
def entity_idf_threshold(spark, d):
    return M.nearest_rank(M.entity_idf(chunks(spark, d)).where("df >= 2"), "idf", 0.75)


@query(f"""WITH {MENTIONS}, rare AS (SELECT entity FROM mentions GROUP BY entity HAVING count(*) BETWEEN 2 AND 40),
p AS (SELECT m.entity, c.chunk_id, c.file_name, c.lang || '/' || c.source AS scope FROM mentions m JOIN rare USING (entity) JOIN chunks c USING (chunk_id))
SELECT a.scope, a.entity, a.chunk_id AS a, b.chunk_id AS b FROM p a JOIN p b ON a.scope = b.scope AND a.entity = b.entity AND a.chunk_id < b.chunk_id AND a.file_name <> b.file_name""")
def bridge_pairs(spark, d):
    return M.bridges(chunks(spark, d), F.concat_ws("/", "lang", "source"))


@query(r"""WITH s AS (SELECT page_id, list_filter(list_transform(string_split(regexp_replace(url, '[?].*$', ''), '/'), lambda x: trim(x)), lambda x: x <> '') AS s FROM pages)
SELECT page_id, CASE WHEN len(s) - 2 < 2 THEN '' ELSE array_to_string(s[1:len(s) - 2], '/') END AS scope, CAST(len(s) AS BIGINT) AS depth, s[len(s)] AS leaf FROM s""")
def path_scope(spark, d):
    path = F.regexp_replace("url", "[?].*$", "")
    seg = T.path_segments(path)
    return table(spark, d, "pages").select("page_id", T.path_scope(path).alias("scope"), F.size(seg).cast("long").alias("depth"), F.element_at(seg, -1).alias("leaf"))


@query(f"WITH {CARDS} SELECT number, concat_ws(' | ', 'region: ' || nullif(region, ''), 'nation: ' || nullif(nation, ''), 'phase: ' || nullif(phase, ''), 'procedure: ' || nullif(procedure, '')) AS header FROM cards")
def facet_header(spark, d):
    parts = [F.concat(F.lit(f"{f}: "), F.nullif(F.regexp_replace(F.trim(F.col(f)), r"\s+", " "), F.lit(""))) for f in ("region", "nation", "phase", "procedure")]
    return cards(spark, d).select("number", F.concat_ws(" | ", *parts).alias("header"))


@query(f"WITH {CARDS} " + " UNION ALL ".join(f"SELECT '{f}' AS field, count({f}) AS filled, count(DISTINCT {f}) AS n_distinct FROM cards" for f in FIELDS))
def meta_coverage(spark, d):
    return A.coverage(cards(spark, d), FIELDS)


def _filtered(*constraints):
    condition = [dict(zip(("field", "op", "value"), c)) for c in constraints]
    return lambda spark, d: cards(spark, d).where(A.compile_filter(condition, KINDS)).select("number")


for _name, _sql, _constraints in (
    ("facet_filter_number", "price BETWEEN 50000 AND 150000 AND price <> 60000", (("price", "between", [50000, 150000]), ("price", "neq", 60000))),
    ("facet_filter_date", "published >= '1995-01-01' AND CAST(substr(published, 6, 2) AS INT) NOT IN (1, 12)", (("published", "gte", "1995-01-01"), ("published", "month_not_in", [1, 12]))),
    ("facet_filter_category", "lower(region) IN ('asia', 'europe') AND lower(phase) <> 'f' AND starts_with(lower(procedure), '1')", (("region", "in", ["Asia", "EUROPE"]), ("phase", "neq", "F"), ("procedure", "prefix", "1"))),
):
    Q[_name], S[_name] = _filtered(*_constraints), f"WITH {CARDS} SELECT number FROM cards WHERE {_sql}"


def _gold(spark, d):
    return cards(spark, d).where("region = 'ASIA' AND price > 200000")


GOLD = "gold AS (SELECT * FROM cards WHERE region = 'ASIA' AND price > 200000)"


@query(f"""WITH {CARDS}, {GOLD}, truth AS (SELECT number FROM cards WHERE lower(region) = 'asia' AND price > 150000 AND lower(phase) <> 'p')
SELECT number, 'violation' AS side FROM gold WHERE number NOT IN (SELECT number FROM truth) UNION ALL SELECT number, 'excess' AS side FROM truth WHERE number NOT IN (SELECT number FROM gold)""")
def completeness_excess(spark, d):
    condition = A.compile_filter([{"field": "region", "op": "eq", "value": "Asia"}, {"field": "price", "op": "gt", "value": 150000}, {"field": "phase", "op": "neq", "value": "P"}], KINDS)
    return A.completeness(cards(spark, d), _gold(spark, d), condition)


@query(f"""WITH {CARDS}, {GOLD} SELECT number, price < (SELECT min(price) FROM gold) OR price > (SELECT max(price) FROM gold) OR nation NOT IN (SELECT nation FROM gold) OR phase NOT IN (SELECT phase FROM gold) AS separable
FROM cards WHERE number NOT IN (SELECT number FROM gold)""")
def separability(spark, d):
    return A.separable(cards(spark, d), _gold(spark, d), ["price"], ["nation", "phase"])


@query(f"WITH {CARDS} SELECT customer AS g, count(*) AS n_gold, concat_ws(',', " + ", ".join(f"CASE WHEN count(DISTINCT trim(lower({f}))) = 1 THEN '{f}' END" for f in FIELDS[1:]) + ") AS shared FROM cards GROUP BY customer")
def shared_facet_audit(spark, d):
    return A.shared_facets(cards(spark, d).withColumnRenamed("customer", "g"), FIELDS[1:])


@query(f"""WITH {CARDS} SELECT number, CASE WHEN CAST(number AS BIGINT) % 3 = 0 THEN nation || ' (' || region || ')' ELSE nation END AS place, customer, CASE WHEN CAST(number AS BIGINT) % 2 = 0 THEN phase ELSE procedure END AS state,
  CASE WHEN CAST(number AS BIGINT) % 3 = 0 THEN 'left,right' ELSE 'left' END AS origins FROM cards""")
def record_merge(spark, d):
    c = cards(spark, d)
    k = F.col("number").cast("long")
    left = c.select("number", F.col("nation").alias("place"), F.lit("").alias("customer"), F.when(k % 2 == 0, F.col("phase")).otherwise(F.col("procedure")).alias("state"), F.lit("left").alias("origin"), F.lit(0).alias("o"))
    left = left.unionByName(c.where(k % 3 != 0).select("number", F.lit("").alias("place"), "customer", F.lit("").alias("state"), F.lit("left").alias("origin"), F.lit(1).alias("o")))
    right = c.where(k % 3 == 0).select("number", F.concat("nation", F.lit(" ("), "region", F.lit(")")).alias("place"), "customer", F.lit("zzz").alias("state"), F.lit("right").alias("origin"), F.lit(2).alias("o"))
    return A.merge_records(left.unionByName(right), "number", ["place", "customer", "state"], "o")


@query(f"WITH {CARDS} SELECT number, translate(format('{{:,.2f}}', price), ',.', ' ,') AS money, CASE WHEN abs(price) < 1e4 THEN 'under 10k' WHEN abs(price) < 1e5 THEN '10k-100k' WHEN abs(price) < 2e5 THEN '100k-200k' WHEN abs(price) < 4e5 THEN '200k-400k' ELSE 'over 400k' END AS bucket FROM cards")
def money_bucket(spark, d):
    return cards(spark, d).select("number", T.money(F.col("price")).alias("money"), T.price_bucket(F.col("price")).alias("bucket"))


MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]


@query(f"WITH {CARDS} SELECT number, CAST(CAST(substr(published, 9, 2) AS INT) AS VARCHAR) || ' ' || {MONTHS}[CAST(substr(published, 6, 2) AS INT)] || ' ' || substr(published, 1, 4) AS long_date, CAST(substr(published, 6, 2) AS BIGINT) AS month FROM cards")
def date_normalise(spark, d):
    p = F.col("published")
    month = F.substring(p, 6, 2).try_cast("int")
    names = F.array(*[F.lit(m) for m in MONTHS])
    return cards(spark, d).select("number", F.concat_ws(" ", F.substring(p, 9, 2).try_cast("int").cast("string"), F.element_at(names, month), F.substring(p, 1, 4)).alias("long_date"), month.cast("long").alias("month"))


@query(r"""WITH t AS (SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[\x00-\x1f]+', ' ', 'g'), '\s+', ' ', 'g')) AS t FROM documents),
u AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(t, '"([^"]*)"', '«\1»', 'g'), ' - ', ' — ', 'g'), ' +([,.;:!?])', '\1', 'g') AS t FROM t)
SELECT doc_id, CASE WHEN lower(t) IN ('', '-', '—', 'nan', 'none', 'null', 'n/a', '0') THEN '' ELSE t END AS clean FROM u""")
def clean_text(spark, d):
    return table(spark, d, "documents").select("doc_id", T.clean(F.col("text")).alias("clean"))


@query("SELECT event_type AS gate, count(*) AS seen, CAST(sum(CASE WHEN user_id % 3 <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS passed, round(avg(CASE WHEN user_id % 3 <> 0 THEN 1.0::DOUBLE ELSE 0 END), 4) AS rate FROM events GROUP BY event_type")
def gate_funnel(spark, d):
    return A.gate_funnel(table(spark, d, "events"), "event_type", F.col("user_id") % 3 != 0)


@query("SELECT doc_id // 3 AS batch, arg_max(doc_id, (n_chars, -doc_id)) AS winner FROM documents GROUP BY 1")
def one_of_n_hardest(spark, d):
    rows = table(spark, d, "documents").select(F.floor(F.col("doc_id") / 3).cast("long").alias("batch"), F.col("doc_id").alias("winner"), "n_chars")
    return A.hardest_of_batch(rows, "batch", [F.desc("n_chars"), F.col("winner")]).select("batch", "winner")


@query(f"""WITH r AS (SELECT doc_id AS id, lang || '/' || quality AS stratum FROM documents JOIN labels USING (doc_id)),
n AS (SELECT stratum, row_number() OVER (ORDER BY count(*) DESC, stratum) AS so FROM r GROUP BY stratum),
t AS (SELECT id, stratum, row_number() OVER (PARTITION BY stratum ORDER BY {UNIT.format('h', 'id')}, id) AS turn FROM r)
SELECT id, stratum, CASE WHEN row_number() OVER (ORDER BY turn, so) <= 60 THEN 'holdout' ELSE 'train' END AS split FROM t JOIN n USING (stratum)""")
def stratified_holdout(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id").select(F.col("doc_id").alias("id"), F.concat_ws("/", "lang", "quality").alias("stratum"))
    return M.stratified_holdout(rows, "stratum", 60)


SETS = "sets AS (SELECT DISTINCT l_orderkey AS id, l_partkey % 50 AS member FROM lineitem)"


def _sets(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), (F.col("l_partkey") % 50).alias("member"))


@query(f"WITH {SETS}, m AS (SELECT id, array_to_string(list_sort(list(member)), ',') AS members FROM sets GROUP BY id) SELECT members, count(*) AS n, min(id) AS keep FROM m GROUP BY members HAVING count(*) > 1")
def duplicate_gold_sets(spark, d):
    return M.duplicate_sets(_sets(spark, d))


@query("WITH sets AS (SELECT DISTINCT l_orderkey AS id, l_partkey AS member FROM lineitem), s AS (SELECT id, count(*) OVER (PARTITION BY member) > 1 AS x FROM sets), b AS (SELECT id, bool_or(x) AS x FROM s GROUP BY id) SELECT count(*) AS n, CAST(sum(CASE WHEN x THEN 1 ELSE 0 END) AS BIGINT) AS overlapping FROM b")
def gold_overlap(spark, d):
    return M.overlap_share(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("member")))


@query("SELECT lang, count(*) AS n, round(avg(quality), 4) AS good, round(avg(toxic), 4) AS toxic, abs(count(*) - (SELECT count(*) FROM labels JOIN documents USING (doc_id)) / 4.0) <= 0.3 * (SELECT count(*) FROM labels JOIN documents USING (doc_id)) / 4.0 AS balanced FROM documents JOIN labels USING (doc_id) GROUP BY lang")
def datamix_stats(spark, d):
    from pyspark.sql import Window

    j = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id")
    by = j.groupBy("lang").agg(F.count("*").alias("n"), F.round(F.avg("quality"), 4).alias("good"), F.round(F.avg("toxic"), 4).alias("toxic"))
    mean = F.sum("n").over(Window.partitionBy()) / 4.0
    return by.select("lang", "n", "good", "toxic", (F.abs(F.col("n") - mean) <= 0.3 * mean).alias("balanced"))


@query("SELECT event_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM events x WHERE x.event_type = 'purchase' AND x.event_id = e.event_id)")
def resume_anti_join(spark, d):
    e = table(spark, d, "events")
    return e.join(e.where("event_type = 'purchase'").select("event_id"), "event_id", "left_anti").select("event_id")


@query("SELECT conv_id, string_agg('<' || role || '>' || text || '</' || role || '>', chr(10) ORDER BY turn) AS transcript, count(*) AS turns FROM conversations GROUP BY conv_id")
def transcript_render(spark, d):
    return L.transcripts(table(spark, d, "conversations"))


@query(f"""WITH {CHUNKS} SELECT count(*) AS n_chunks, count(DISTINCT file_name) AS n_files, round(avg(length(raw_text)), 4) AS mean_chars, round(median(length(raw_text)), 4) AS median_chars, CAST(min(length(raw_text)) AS BIGINT) AS min_chars, CAST(max(length(raw_text)) AS BIGINT) AS max_chars,
CAST(sum(CASE WHEN NOT regexp_matches(raw_text, '[.!?…»"'']$') THEN 1 ELSE 0 END) AS BIGINT) AS open_ends, CAST(sum(CASE WHEN regexp_matches(raw_text, '^\\p{{Ll}}') THEN 1 ELSE 0 END) AS BIGINT) AS low_starts FROM chunks WHERE raw_text <> ''""")
def boundary_diagnostics(spark, d):
    return C.boundaries(chunks(spark, d))


@query(f"""WITH {CHUNKS}, h AS (SELECT sha1(chunk_id || sha1({NORMAL.format('raw_text')})) AS h FROM chunks),
s AS (SELECT substr(h, 1, 2) AS s, CAST(sum(('0x' || substr(h, 3, 10))::UBIGINT) AS VARCHAR) AS v, count(*) AS n FROM h GROUP BY 1)
SELECT sha1(string_agg(s || ':' || v || ':' || n, ',' ORDER BY s)) AS checksum, CAST(sum(n) AS BIGINT) AS n_chunks FROM s""")
def corpus_checksum(spark, d):
    return C.checksum(chunks(spark, d))


@query(f"""WITH v1 AS (SELECT doc_id AS id, text, 0 AS version FROM documents UNION ALL SELECT doc_id + 1000000, replace(text, 'the', 'teh'), 1 FROM documents),
r AS (SELECT id, version, sha1({NORMAL.format('text')}) AS hash, row_number() OVER (PARTITION BY sha1({NORMAL.format('text')}) ORDER BY version, id) AS rn FROM v1) SELECT id, CAST(version AS BIGINT) AS version, hash FROM r WHERE rn = 1""")
def v1_union(spark, d):
    docs = _docs(spark, d)
    injected = docs.select((F.col("id") + 1000000).alias("id"), F.replace("text", F.lit("the"), F.lit("teh")).alias("text"), F.lit(1).cast("long").alias("version"))
    both = docs.withColumn("version", F.lit(0).cast("long")).unionByName(injected)
    return L.first_version(both.select("id", "version", T.content_hash(F.col("text")).alias("hash")))


@query(r"SELECT item_id, replace(replace(regexp_replace('Where did #1 meet #2 in ' || text, '#1', 'that person'), '#2', 'that place'), '#3', 'it') AS question FROM benchmark")
def anaphora_rewrite(spark, d):
    asked = F.concat(F.lit("Where did #1 meet #2 in "), F.col("text"))
    return table(spark, d, "benchmark").select("item_id", L.rewrite(asked, F.array(F.lit("Who founded it?"), F.lit("Where is it?"), F.lit("Is it so?"))).alias("question"))


@query(f"""{BM25}, t AS (SELECT query_id, chunk_id, rank FROM ranked WHERE rank <= 10),
j AS (SELECT t.query_id, t.chunk_id, t.rank, len(list_intersect({TOKENS.format('c.raw_text')}, {TOKENS.format('b.text')})) / len(list_distinct({TOKENS.format('b.text')})) >= 0.75 AS ok FROM t JOIN chunks c USING (chunk_id) JOIN benchmark b ON item_id = query_id)
SELECT query_id, coalesce(string_agg(chunk_id, ',' ORDER BY rank) FILTER (WHERE ok), '') AS positives, CAST(sum(CASE WHEN ok THEN 1 ELSE 0 END) AS BIGINT) AS n FROM j GROUP BY query_id""")
def collect_positives(spark, d):
    c, b = chunks(spark, d), bench(spark, d)
    j = R.bm25(c, b).join(c.select("chunk_id", "raw_text"), "chunk_id").join(b, "query_id")
    return L.positives(j)


@query("SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def windowed_events(spark, d):
    return W.windowed_counts(table(spark, d, "events"))


def _candidates(spark, d):
    n = F.length("text")
    bin_ = F.when(n <= 800, "low").when(n <= 2400, "mid").otherwise("high")
    return _docs(spark, d).select(F.floor(F.col("id") / 3).cast("long").alias("batch"), "id", n.cast("double").alias("gap"), bin_.alias("bin"))


@query()
def one_of_n_datamix(spark, d):
    """The running tally makes it sequential; held against a plain loop in the tests."""
    return X.datamix_select(_candidates(spark, d))


@query()
def disjoint_bridges(spark, d):
    """Greedy within each scope and entity; held against a plain loop in the tests."""
    pairs = bridge_pairs(spark, d).withColumn("group", F.concat_ws("|", "scope", "entity")).select("group", "a", "b")
    return X.disjoint_pairs(pairs, "group", ["a", "b"], 2)


@query()
def section_chunker(spark, d):
    """Orders as records with a section for each line item; held against expected texts in the tests."""
    lines = F.array_sort(F.collect_list(F.struct("l_linenumber", F.format_string("part %d: %s pieces at %s", F.col("l_partkey"), F.col("l_quantity").cast("string"), F.col("l_extendedprice").cast("string")).alias("t"))))
    items = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("number")).agg(lines.alias("xs"))
    c = cards(spark, d).join(items, "number")
    head = F.struct(F.lit("Order").alias("title"), F.array(F.concat(F.lit("customer: "), "customer"), F.concat(F.lit("region: "), "region"), F.concat(F.lit("published: "), "published")).alias("lines"))
    body = F.struct(F.lit("Items").alias("title"), F.transform("xs", lambda x: x["t"]).alias("lines"))
    return X.chunk_records(c.select("number", F.array(head, body).alias("sections")), "number", max_chars=300, merge_below=100, min_chars=20)


@query("SELECT conv_id, turn, CAST(len(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '')) AS BIGINT) AS n_lines, upper(substr(trim(text), 1, 1)) || substr(trim(text), 2) || CASE WHEN regexp_matches(trim(text), '[.!?…]$') THEN '' ELSE '.' END AS sentence FROM conversations WHERE trim(text) <> ''")
def sentence_case(spark, d):
    t = F.trim("text")
    lines = F.filter(F.transform(F.split("text", "\n", -1), lambda x: F.trim(x)), lambda x: x != "")
    rows = table(spark, d, "conversations").where(t != "")
    return rows.select("conv_id", "turn", F.size(lines).cast("long").alias("n_lines"), F.concat(F.upper(F.substring(t, 1, 1)), F.substring(t, 2, 1 << 30), F.when(t.rlike("[.!?…]$"), "").otherwise(".")).alias("sentence"))


@query(f"WITH {CARDS} SELECT customer, count(*) AS n, min_by(region, number) AS region, min_by(nation, number) AS nation, min_by(procedure, number) FILTER (WHERE procedure <> '') AS procedure FROM cards GROUP BY customer")
def document_view(spark, d):
    return A.first_values(cards(spark, d), "customer", ["region", "nation", "procedure"], "number")


@query("WITH f AS (SELECT event_type, user_id % 7 AS k, user_id % 3 <> 0 AS ok FROM events) SELECT event_type AS gate, CAST(k AS BIGINT) AS mechanic, count(*) AS seen, CAST(sum(CASE WHEN ok THEN 1 ELSE 0 END) AS BIGINT) AS passed FROM f GROUP BY ROLLUP (event_type, k)")
def gate_funnel_by_mechanic(spark, d):
    e = table(spark, d, "events").select(F.col("event_type").alias("gate"), (F.col("user_id") % 7).alias("mechanic"), (F.col("user_id") % 3 != 0).cast("long").alias("ok"))
    return e.rollup("gate", "mechanic").agg(F.count("*").alias("seen"), F.sum("ok").alias("passed"))


@query(f"WITH {CHUNKS} SELECT item_id, chunk_id FROM benchmark b JOIN chunks c ON {NORMAL.format('b.text')} <> '' AND contains({NORMAL.format('c.raw_text')}, {NORMAL.format('b.text')})")
def verbatim_spans(spark, d):
    """Both sides are normalised before the join, once per row rather than once per pair."""
    b = table(spark, d, "benchmark").select("item_id", T.normal(F.col("text")).alias("span")).where("span <> ''")
    c = chunks(spark, d).select("chunk_id", T.normal(F.col("raw_text")).alias("whole"))
    return R.containing(c, b, "item_id")


@query(f"""WITH t AS (SELECT a.conv_id, a.turn, a.text AS q, b.text AS a FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1),
w AS (SELECT *, list_distinct(list_filter({TOKENS.format('a')}, lambda w: length(w) >= 4)) AS ws FROM t)
SELECT conv_id, turn, contains({NORMAL.format('q')}, {NORMAL.format('a')}) OR (CASE WHEN len(ws) = 0 THEN 0.0 ELSE len(list_filter(ws, lambda x: contains(lower(q), x))) / len(ws) END) >= 0.9 AS leak FROM w""")
def answer_leaks(spark, d):
    c = table(spark, d, "conversations")
    after = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return c.join(after, ["conv_id", "turn"]).select("conv_id", "turn", J.leaks(F.col("answer"), F.col("text")).alias("leak"))


@query("""WITH t AS (SELECT doc_id, text, regexp_extract(text, '(?:^|[^0-9])((?:19|20)[0-9]{2})(?:[^0-9]|$)', 1) AS y, regexp_extract(text, '([0-9]{1,9})', 1) AS n FROM documents),
f AS (SELECT *, CASE WHEN y <> '' THEN y ELSE n END AS f, CASE WHEN y <> '' THEN 3 ELSE 7 END AS k FROM t)
SELECT doc_id, md5(CASE WHEN f = '' THEN text ELSE substr(text, 1, instr(text, f) - 1) || CAST(CAST(f AS BIGINT) + k AS VARCHAR) || substr(text, instr(text, f) + length(f)) END) AS hash, f <> '' AS changed FROM f""")
def perturbed(spark, d):
    docs = table(spark, d, "documents")
    new = J.perturb(F.col("text"))
    return docs.select("doc_id", F.md5(new).alias("hash"), F.col("text").rlike("[0-9]").alias("changed"))


@query(f"WITH {CHUNKS}, w AS (SELECT unnest(regexp_extract_all(raw_text, '\\p{{L}}+')) AS word FROM chunks) SELECT word, count(*) AS n FROM w WHERE regexp_matches(word, '^\\p{{Ll}}') GROUP BY word")
def lower_case_words(spark, d):
    return J.lower_case_words(chunks(spark, d))


DENSITY = f"{PAIRS}, density AS (SELECT vec_id AS id, CAST(coalesce(n, 0) AS BIGINT) AS density FROM embeddings LEFT JOIN (SELECT a, count(*) AS n FROM pairs WHERE sim > 0.1 GROUP BY a) ON a = vec_id)"


def _density(spark, d):
    return M.density(vectors(spark, d), 0.1)


@query(f"WITH {DENSITY}, s AS (SELECT CAST(floor(('0x' || substr(md5('g:' || k || ':' || id), 1, 8))::UBIGINT / 4294967296.0::DOUBLE * 2000) AS BIGINT) AS set, density FROM density, range(3) r(k)) SELECT set, min(density) AS density FROM s GROUP BY set")
def pseudo_gold_density(spark, d):
    return J.pseudo_gold(_density(spark, d), 2000)


@query(f"WITH {DENSITY}, m AS (SELECT median(density) AS median FROM density) SELECT id, density, CAST(least(greatest(0, round_even(median - density, 0)), 15) AS BIGINT) AS budget, density < 0.34::DOUBLE * median AS sparse FROM density, m")
def injection_budget(spark, d):
    return J.injection_budget(_density(spark, d))


@query(f"""{BM25}, top AS (SELECT * FROM ranked WHERE rank <= 10), gold AS (SELECT b.item_id AS query_id, c.chunk_id FROM chunks c JOIN benchmark b ON contains(c.raw_text, b.text)),
o AS (SELECT chunk_id, min(query_id) AS owner FROM gold GROUP BY chunk_id)
SELECT t.query_id, count(g.query_id) AS own, CAST(sum(CASE WHEN g.query_id IS NULL AND owner IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS foreign FROM top t LEFT JOIN gold g ON g.query_id = t.query_id AND g.chunk_id = t.chunk_id LEFT JOIN o ON o.chunk_id = t.chunk_id GROUP BY t.query_id""")
def isolation_hits(spark, d):
    c, b = chunks(spark, d), bench(spark, d)
    gold = _gold_chunks(c, b)
    return J.isolation(R.bm25(c, b).select("query_id", "chunk_id"), gold)


@query("""WITH t AS (SELECT o_custkey AS grp, o_orderkey AS chunk, l_linenumber AS fact, row_number() OVER (PARTITION BY o_custkey, o_orderkey ORDER BY l_linenumber) AS turn FROM (SELECT DISTINCT o_custkey, o_orderkey, l_linenumber FROM orders JOIN lineitem ON o_orderkey = l_orderkey)),
p AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY turn, chunk) AS place FROM t) SELECT grp, chunk, fact, place FROM p WHERE place <= 5""")
def round_robin_facts(spark, d):
    o, li = table(spark, d, "orders"), table(spark, d, "lineitem")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-li.count() // 500_000))  # so a task's rows don't grow with the tables
    lines = li.select(F.col("l_orderkey").alias("chunk"), F.col("l_linenumber").alias("fact")).repartition(parts, "chunk").distinct()  # before the join, which multiplies what repeats on both sides
    owners = o.select(F.col("o_custkey").alias("grp"), F.col("o_orderkey").alias("chunk")).repartition(parts, "chunk").distinct()
    facts = lines.join(owners, "chunk").select("grp", "chunk", "fact").repartition(parts, "grp")
    return J.round_robin(facts, "grp", "chunk", "fact", 5).withColumn("place", F.col("place").cast("long"))


@query(f"WITH {CHUNKS}, r AS (SELECT chunk_id, lang || '/' || source AS path, row_number() OVER (PARTITION BY lang || '/' || source ORDER BY length(raw_text) DESC, chunk_id) AS rn FROM chunks) SELECT chunk_id, path FROM r WHERE rn <= 8")
def path_quota(spark, d):
    rows = chunks(spark, d).select("chunk_id", F.concat_ws("/", "lang", "source").alias("path"), F.length("raw_text").alias("n"))
    return X.ranked_quota(rows, "path", [F.desc("n"), F.col("chunk_id")], 8).select("chunk_id", "path")
