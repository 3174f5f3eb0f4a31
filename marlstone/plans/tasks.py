"""Queries over probes, gates and mined subgraphs, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import graph as GR
from ..operators import mining as M
from ..operators import probes as P
from ..operators import retrieval as R
from ..operators.store import written
from .registry import MENTIONS, UNIT, bm25_sql, query
from .views import CHUNKS, TOKENS, chunks, table

PASSAGES = f"""{CHUNKS}, passages AS (SELECT chunk_id, file_name, concat_ws(chr(10), nullif(title, ''), 'lang: ' || lang || ' | source: ' || source, raw_text) AS passage FROM chunks),
tk AS MATERIALIZED (SELECT doc_id AS query_id, idx AS part, chunk_id, file_name, array_to_string({TOKENS.format('raw_text')}[1:12], ' ') AS probe FROM chunks WHERE doc_id % 20 = 0 AND idx <= 1 AND len({TOKENS.format('raw_text')}) >= 3)"""
QUESTIONS = "SELECT query_id, string_agg(probe, ' ' ORDER BY part) AS text FROM tk GROUP BY query_id"
FACTS = "SELECT query_id * 10 + part AS query_id, probe AS text FROM tk"


def bow_sql(name: str, rows: str) -> str:
    return f"""{name}_n AS (SELECT id, b, count(*) AS c FROM (SELECT id, ('0x' || substr(md5(w), 31, 2))::UBIGINT AS b FROM (SELECT id, unnest({TOKENS.format('text')}) AS w FROM ({rows}))) GROUP BY ALL),
{name} AS MATERIALIZED (SELECT id, b, c / sqrt(sum(c * c) OVER (PARTITION BY id)) AS x FROM {name}_n)"""


def probe_sql(queries: str) -> str:
    return f"""WITH {PASSAGES}, qs AS MATERIALIZED ({queries}), {bm25_sql('passage', 'SELECT * FROM qs', 'passages')},
{bow_sql('cv', 'SELECT chunk_id AS id, passage AS text FROM passages')}, {bow_sql('qv', 'SELECT query_id AS id, text FROM qs')},
sims AS MATERIALIZED (SELECT q.id AS query_id, c.id AS chunk_id, round(sum(q.x * c.x), 6) AS score FROM qv q JOIN cv c USING (b) GROUP BY ALL),
dr AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM sims),
fused AS MATERIALIZED (SELECT query_id, chunk_id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS rrf FROM (SELECT query_id, chunk_id, rank FROM ranked WHERE rank <= 100 UNION ALL SELECT query_id, chunk_id, rank FROM dr WHERE rank <= 100) GROUP BY ALL),
hits AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rrf DESC, chunk_id) AS rank FROM fused)"""


def _passages(spark, d):
    header = F.concat(F.lit("lang: "), F.col("lang"), F.lit(" | source: "), F.col("source"))
    return chunks(spark, d).select("chunk_id", "file_name", "raw_text", F.concat_ws("\n", F.nullif(F.col("title"), F.lit("")), header, "raw_text").alias("passage"))


def _parts(spark, d):
    """The first two chunks of every twentieth document: gold of a task whose question begins as they do."""
    words = T.tokens(F.col("raw_text"))
    rows = chunks(spark, d).where("doc_id % 20 = 0 AND idx <= 1").withColumn("ws", words).where(F.size("ws") >= 3)
    return rows.select(F.col("doc_id").alias("query_id"), F.col("idx").alias("part"), "chunk_id", "file_name", F.array_join(F.slice("ws", 1, 12), " ").alias("probe"))


def _questions(parts):
    by = parts.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("part", "probe"))).alias("xs"))
    return by.select("query_id", F.array_join(F.transform("xs", lambda x: x["probe"]), " ").alias("text"))


def _set_up(spark, d):
    parts = written(_parts(spark, d), "parts")
    return P.Probe(_passages(spark, d)), parts


@query(f"{probe_sql(QUESTIONS)} SELECT query_id, chunk_id AS id, rrf, rank FROM hits WHERE rank <= 10")
def hybrid_probe(spark, d):
    """Questions of every twentieth document against all passages, both branches fused."""
    probe, parts = _set_up(spark, d)
    return probe.hits(_questions(parts))


GAPS = """gaps AS MATERIALIZED (SELECT t.query_id, t.chunk_id, t.part, {lex} AS lex_gap, {dense} AS dense_gap, {fused} AS fused_gap FROM tk t
LEFT JOIN scores l ON l.query_id = t.query_id AND l.chunk_id = t.chunk_id LEFT JOIN sims s ON s.query_id = t.query_id AND s.chunk_id = t.chunk_id LEFT JOIN fused f ON f.query_id = t.query_id AND f.chunk_id = t.chunk_id
LEFT JOIN (SELECT query_id, max(score) AS b FROM scores GROUP BY 1) bl ON bl.query_id = t.query_id LEFT JOIN (SELECT query_id, max(score) AS b FROM sims GROUP BY 1) bs ON bs.query_id = t.query_id LEFT JOIN (SELECT query_id, max(rrf) AS b FROM fused GROUP BY 1) bf ON bf.query_id = t.query_id)""".format(
    **{n: f"round(CASE WHEN coalesce({b}.b, 0) <= 0 THEN 1 ELSE least(1, greatest(0, 1 - greatest(0, coalesce({s}, 0)) / {b}.b)) END, 6)" for n, s, b in (("lex", "l.score", "bl"), ("dense", "s.score", "bs"), ("fused", "f.rrf", "bf"))}
)


@query(f"{probe_sql(QUESTIONS)}, {GAPS} SELECT query_id, chunk_id, lex_gap, dense_gap, fused_gap FROM gaps")
def probe_gaps(spark, d):
    probe, parts = _set_up(spark, d)
    return probe.gaps(_questions(parts), parts.select("query_id", "chunk_id"))


@query(f"{probe_sql(QUESTIONS)}, {GAPS}, g AS (SELECT query_id, part, min(fused_gap) AS g FROM gaps GROUP BY ALL) SELECT query_id, max(g) AS gap, CASE WHEN max(g) <= 0.33 THEN 'low' WHEN max(g) <= 0.66 THEN 'mid' ELSE 'high' END AS bin FROM g GROUP BY query_id")
def task_gaps(spark, d):
    """The gap of a task on its final gold: the worst of its groups, each as good as its best member."""
    probe, parts = _set_up(spark, d)
    gaps = probe.gaps(_questions(parts), parts.select("query_id", "chunk_id")).join(parts.select("query_id", "chunk_id", "part"), ["query_id", "chunk_id"])
    return P.task_gaps(gaps, "part").withColumn("bin", R.gap_bin(F.col("gap")))


@query(f"{probe_sql(QUESTIONS)} SELECT t.query_id, count(*) AS n_gold, count(h.chunk_id) AS n_hit, count(h.chunk_id) < count(*) AS passed FROM tk t LEFT JOIN hits h ON h.query_id = t.query_id AND h.chunk_id = t.chunk_id AND h.rank <= 10 GROUP BY t.query_id")
def gate_broad(spark, d):
    probe, parts = _set_up(spark, d)
    return P.broad(probe.hits(_questions(parts)), parts)


@query(f"{probe_sql(FACTS)}, g AS (SELECT t.query_id, t.chunk_id, bool_or(h.chunk_id IS NOT NULL) AS ok FROM tk t LEFT JOIN hits h ON h.query_id = t.query_id * 10 + t.part AND h.chunk_id = t.chunk_id AND h.rank <= 10 GROUP BY ALL) SELECT query_id, bool_and(ok) AS passed FROM g GROUP BY query_id")
def gate_reach(spark, d):
    """Every gold chunk is among the hits of a probe of one of its facts."""
    probe, parts = _set_up(spark, d)
    facts = parts.withColumn("fact_id", F.col("query_id") * 10 + F.col("part"))
    return P.reached(probe.hits(facts.select(F.col("fact_id").alias("query_id"), F.col("probe").alias("text"))), facts.select("fact_id", "query_id", "chunk_id"))


COSINES = "(SELECT a.id AS a, b.id AS b, sum(a.x * b.x) AS s FROM cv a JOIN cv b USING (b) WHERE a.id IN (SELECT chunk_id FROM tk) AND b.id IN (SELECT chunk_id FROM band) GROUP BY ALL)"


@query(f"""{probe_sql(QUESTIONS)}, best AS (SELECT query_id, max(rrf) AS best FROM hits WHERE rank <= 20 GROUP BY 1),
band AS MATERIALIZED (SELECT h.query_id, h.chunk_id, p.file_name FROM hits h JOIN best USING (query_id) JOIN passages p ON p.chunk_id = h.chunk_id WHERE rank <= 20 AND rrf >= 0.85 * best AND best > 0),
near AS MATERIALIZED (SELECT DISTINCT t.query_id, n.file_name FROM band n JOIN tk t ON t.query_id = n.query_id JOIN {COSINES} c ON c.a = t.chunk_id AND c.b = n.chunk_id WHERE round(c.s, 6) >= 0.9 AND n.file_name <> t.file_name),
refs AS (SELECT query_id, count(DISTINCT file_name) AS n FROM band b WHERE NOT EXISTS (SELECT 1 FROM near x WHERE x.query_id = b.query_id AND x.file_name = b.file_name) GROUP BY 1),
own AS (SELECT DISTINCT b.query_id FROM band b JOIN tk t ON t.query_id = b.query_id AND t.chunk_id = b.chunk_id)
SELECT q.query_id, coalesce(n, 0) AS referents, coalesce(n, 0) >= 2 AND o.query_id IS NOT NULL AS passed FROM best q LEFT JOIN refs r ON r.query_id = q.query_id LEFT JOIN own o ON o.query_id = q.query_id""")
def gate_referents(spark, d):
    """Ambiguous descriptors: two documents in the band of the best hits, near copies of the gold (0.90) aside, and gold among them."""
    probe, parts = _set_up(spark, d)
    hits = written(probe.hits(_questions(parts), k=20), "hits")
    files = _passages(spark, d).select("chunk_id", "file_name")
    vec = written(probe.vectors_of(hits.select(F.col("id").alias("chunk_id")).union(parts.select("chunk_id"))), "met")
    gold = parts.select("query_id", F.col("chunk_id").alias("g"), F.col("file_name").alias("gf")).join(vec.select(F.col("chunk_id").alias("g"), F.col("vec").alias("gv")), "g")
    met = hits.select("query_id", F.col("id").alias("chunk_id")).join(vec, "chunk_id").join(files, "chunk_id").join(gold, "query_id")
    dot = F.aggregate(F.zip_with("vec", "gv", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    best = hits.groupBy("query_id").agg(F.max("rrf").alias("best"))
    inside = hits.join(best, "query_id").where("rrf >= 0.85 * best").select("query_id", F.col("id").alias("chunk_id"))
    twins = met.join(inside, ["query_id", "chunk_id"], "left_semi").where((F.round(dot, 6) >= 0.9) & (F.col("file_name") != F.col("gf"))).select("query_id", "file_name").distinct()
    return P.ambiguous(hits, parts, files, twins, score="rrf")


@query(f"""{probe_sql(QUESTIONS)}, {GAPS}, e AS (SELECT query_id, min_by(dense_gap, (lex_gap, chunk_id)) AS dense_gap, min(lex_gap) AS lex_gap FROM gaps GROUP BY 1)
SELECT query_id, lex_gap, dense_gap, lex_gap <= 0.34 AND dense_gap >= 0.01 AS passed FROM e""")
def gate_entry(spark, d):
    """The entry of a task, its gold chunk of the lowest lexical gap: near by its words and not by its vector."""
    probe, parts = _set_up(spark, d)
    gaps = probe.gaps(_questions(parts), parts.select("query_id", "chunk_id"))
    e = gaps.groupBy("query_id").agg(F.min_by("dense_gap", F.struct("lex_gap", "chunk_id")).alias("dense_gap"), F.min("lex_gap").alias("lex_gap"))
    return e.withColumn("passed", (F.col("lex_gap") <= 0.34) & (F.col("dense_gap") >= 0.01))


SCOPE = "c.lang || '/' || c.source"


@query(f"WITH {CHUNKS}, s AS (SELECT chunk_id, CASE WHEN length(raw_text) < 40 THEN '' ELSE lang || '/' || source END AS scope FROM chunks), n AS (SELECT scope, count(*) AS n FROM s GROUP BY scope) SELECT chunk_id, scope, n, scope = '' OR n < 30 AS residue FROM s JOIN n USING (scope)")
def scope_groups(spark, d):
    scope = F.when(F.length("raw_text") < 40, "").otherwise(F.concat_ws("/", "lang", "source"))
    return GR.scope_groups(chunks(spark, d), scope, 30)


BRIDGES = f"""WITH {MENTIONS}, df AS (SELECT entity, count(*) AS df, round(ln((SELECT count(*) FROM chunks) / count(*)), 6) AS idf FROM mentions GROUP BY entity),
placed AS MATERIALIZED (SELECT m.entity, idf, c.chunk_id, c.file_name, c.idx, {SCOPE} AS scope FROM mentions m JOIN df USING (entity) JOIN chunks c USING (chunk_id) WHERE df <= 40 AND idf >= 1),
sizes AS (SELECT {SCOPE} AS scope, count(*) AS n FROM chunks c GROUP BY 1), good AS (SELECT scope, entity FROM placed JOIN sizes USING (scope) GROUP BY scope, entity, n HAVING count(*) BETWEEN 2 AND greatest(2, floor(n * 0.3))),
kept AS (SELECT * FROM placed JOIN good USING (scope, entity)),
pairs AS (SELECT a.scope, a.entity, a.idf, a.chunk_id AS a, b.chunk_id AS b, row_number() OVER (PARTITION BY a.scope, a.entity ORDER BY a.chunk_id, b.chunk_id) AS turn FROM kept a JOIN kept b ON a.scope = b.scope AND a.entity = b.entity AND a.chunk_id < b.chunk_id AND a.file_name <> b.file_name),
bridges AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY scope ORDER BY turn, idf DESC, entity) AS place FROM pairs WHERE turn <= 3),
sgs AS MATERIALIZED (SELECT scope || '#' || place AS sg, * FROM bridges WHERE place <= 20)"""


def _bridges(spark, d):
    c = chunks(spark, d)
    where = c.select("chunk_id", "file_name", "idx", F.concat_ws("/", "lang", "source").alias("scope"))
    mentions = written(M.mentions(c).select("entity", "chunk_id"), "mentions")
    total = c.count()
    found = GR.scope_bridges(mentions, where.drop("idx"), total)
    return found, mentions, where, total


def _subgraphs(found):
    return found.where("place <= 20").withColumn("sg", F.concat_ws("#", "scope", F.col("place").cast("string")))


@query(f"{BRIDGES} SELECT scope, entity, idf, a, b, turn, place FROM bridges")
def scope_bridges(spark, d):
    return _bridges(spark, d)[0]


@query(f"""{BRIDGES}, members AS (SELECT sg, unnest([a, b]) AS chunk_id FROM sgs), e AS (SELECT sg, entity, count(*) AS members FROM members JOIN mentions USING (chunk_id) GROUP BY ALL HAVING count(*) > 1),
r AS (SELECT sg, entity, members, row_number() OVER (PARTITION BY sg ORDER BY idf DESC, entity) AS rank FROM e JOIN df USING (entity)) SELECT * FROM r WHERE rank <= 6""")
def bridge_entities(spark, d):
    found, mentions, _, total = _bridges(spark, d)
    idf = mentions.groupBy("entity").agg(F.round(F.log(F.lit(float(total)) / F.count("*")), 6).alias("idf"))
    members = _subgraphs(found).select("sg", F.explode(F.array("a", "b")).alias("chunk_id"))
    return GR.bridge_entities(members, mentions, idf)


@query(f"""{BRIDGES}, member AS (SELECT sg, scope, entity, unnest([a, b]) AS m FROM sgs), via AS (SELECT DISTINCT sg, member.scope, p.entity AS other FROM member JOIN placed p ON p.chunk_id = m WHERE p.entity <> member.entity),
near AS (SELECT DISTINCT sg, p.chunk_id, p.file_name, p.idx FROM via JOIN placed p ON p.entity = other AND p.scope = via.scope),
each AS (SELECT sg, near.chunk_id, bool_and(near.chunk_id <> m AND (near.file_name <> c.file_name OR abs(near.idx - c.idx) >= 2)) AS ok, bool_or(near.file_name = c.file_name) AS seen FROM near JOIN member USING (sg) JOIN chunks c ON c.chunk_id = m GROUP BY ALL),
r AS (SELECT sg, chunk_id, row_number() OVER (PARTITION BY sg ORDER BY seen, {UNIT.format('extend', "(sg || '|' || chunk_id)")}, chunk_id) AS rn FROM each WHERE ok) SELECT sg, chunk_id FROM r WHERE rn = 1""")
def extended_subgraphs(spark, d):
    found, mentions, where, total = _bridges(spark, d)
    df = mentions.groupBy("entity").agg(F.count("*").alias("df")).where(F.col("df") <= 40)
    rare = df.where(F.round(F.log(F.lit(float(total)) / F.col("df")), 6) >= 1.0)
    return GR.extend(_subgraphs(found), mentions, where, rare)


@query(f"{BRIDGES}, r AS (SELECT scope, sg, place AS pass FROM sgs WHERE place <= 5), o AS (SELECT *, row_number() OVER (ORDER BY pass, scope) AS place FROM r) SELECT scope, sg, pass, place FROM o WHERE place <= 60")
def quota_emission(spark, d):
    """Scopes give one subgraph a pass, five each at the most, 60 in all."""
    sgs = _subgraphs(_bridges(spark, d)[0]).select("scope", "sg", F.col("place").alias("own"))
    return GR.emit(sgs, "scope", ["own"], 5, 60).select("scope", "sg", "pass", "place")


@query(f"""WITH {MENTIONS}, df AS (SELECT entity, count(*) AS df FROM mentions GROUP BY entity HAVING count(*) BETWEEN 2 AND 40),
p AS (SELECT m.entity, df, c.chunk_id, c.file_name FROM mentions m JOIN df USING (entity) JOIN chunks c USING (chunk_id) WHERE length(c.raw_text) < 200),
r AS (SELECT a.entity, a.df, a.chunk_id AS a, b.chunk_id AS b, row_number() OVER (PARTITION BY a.entity ORDER BY a.chunk_id, b.chunk_id) AS turn FROM p a JOIN p b ON a.entity = b.entity AND a.chunk_id < b.chunk_id AND a.file_name <> b.file_name)
SELECT entity, a, b, df FROM r WHERE turn = 1""")
def residue_bridges(spark, d):
    """Chunks left without a scope, here the short ones, joined by their rarest entities: the first pair of each."""
    c = chunks(spark, d)
    mentions = M.mentions(c).select("entity", "chunk_id")
    df = mentions.groupBy("entity").agg(F.count("*").alias("df")).where(F.col("df").between(2, 40))
    p = mentions.join(df, "entity").join(c.where(F.length("raw_text") < 200).select("chunk_id", "file_name"), "chunk_id")
    left, right = (p.select("entity", "df", F.col("chunk_id").alias(x), F.col("file_name").alias(f"f{x}")) for x in ("a", "b"))
    pairs = left.join(right.drop("df"), "entity").where("a < b AND fa <> fb")
    return pairs.groupBy("entity", "df").agg(F.min(F.struct("a", "b")).alias("x")).select("entity", "x.a", "x.b", "df")


@query("SELECT doc_id AS batch, CAST(doc_id % 3 AS BIGINT) AS mechanic, CAST((doc_id // 3 + CAST(floor(" + UNIT.format("cell", "(doc_id % 3)") + " * 4) AS BIGINT)) % 4 AS BIGINT) AS sub, " + UNIT.format("negation", "doc_id") + " < 0.2 AS negated FROM documents")
def cell_sampler(spark, d):
    """Mechanics in turn; within one, its kinds in turn from a drawn first; a drawn fifth is negated."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("batch"), (F.col("doc_id") % 3).alias("mechanic"))
    first = F.floor(T.unit(F.col("mechanic"), "cell") * 4).cast("long")
    return docs.select("batch", "mechanic", ((F.floor(F.col("batch") / 3).cast("long") + first) % 4).alias("sub"), (T.unit(F.col("batch"), "negation") < 0.2).alias("negated"))
