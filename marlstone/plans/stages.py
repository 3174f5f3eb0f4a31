"""Queries over stage control, verdicts, injection and final records, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import dialogue as L
from ..operators import mining as M
from ..operators import sequential as X
from ..operators import stages as ST
from ..operators.store import written
from .registry import query
from .tasks import FACTS, GAPS, QUESTIONS, _passages, _questions, _set_up, probe_sql
from .views import TOKENS, table


@query("""WITH log AS (SELECT event_id, 'pass' AS outcome FROM events WHERE event_type = 'purchase' UNION ALL SELECT event_id, 'seen' FROM events WHERE event_type = 'click'),
new AS (SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 'pass' ELSE 'user_' || user_id % 3 END AS outcome FROM events WHERE event_id NOT IN (SELECT event_id FROM log))
SELECT event_id, outcome FROM log UNION ALL SELECT event_id, outcome FROM new""")
def decision_log(spark, d):
    """A log of passes and rejects, carried on by the rows that it hasn't decided."""
    e = table(spark, d, "events")
    old = e.where("event_type IN ('purchase', 'click')").select("event_id", F.when(F.col("event_type") == "purchase", "pass").otherwise("seen").alias("outcome"))
    new = ST.decide(e, old, "event_id", F.col("user_id") % 3 == 0, F.concat(F.lit("user_"), (F.col("user_id") % 3).cast("string")))
    return old.unionByName(new)


@query(r"""WITH t AS (SELECT doc_id, text, CASE WHEN length(text) > 600 THEN 'long' ELSE '' END AS p1 FROM documents), u AS (SELECT doc_id, p1, CASE WHEN p1 <> '' THEN substr(text, 1, 500) ELSE text END AS t2 FROM t)
SELECT doc_id, CASE WHEN p1 = '' THEN '' ELSE CASE WHEN NOT contains(t2, ' ') THEN 'one_word' ELSE '' END END AS problems, CASE WHEN p1 = '' THEN 1 ELSE 2 END AS tries, md5(t2) AS hash FROM u""")
def gate_solve(spark, d):
    """A verdict, one repair of what failed, and a second verdict."""
    flaws = lambda t: F.concat_ws(",", F.when(F.length(t) > 600, F.lit("long")), F.when((F.length(t) == 500) & ~F.contains(t, F.lit(" ")), F.lit("one_word")))
    out = ST.repaired(table(spark, d, "documents").select("doc_id", "text"), "text", flaws, lambda t, p: F.substring(t, 1, 500))
    return out.select("doc_id", "problems", "tries", F.md5("text").alias("hash"))


@query(f"""{probe_sql(FACTS)}, own AS (SELECT query_id * 10 + part AS fact_id, chunk_id FROM tk), top AS MATERIALIZED (SELECT query_id AS fact_id, chunk_id FROM hits WHERE rank <= 8),
src AS MATERIALIZED (SELECT t.fact_id, t.chunk_id, a.b, a.x FROM top t JOIN own o ON o.fact_id = t.fact_id JOIN cv a ON a.id = o.chunk_id),
sim AS MATERIALIZED (SELECT src.fact_id, src.chunk_id, round(sum(src.x * b.x), 6) AS s FROM src JOIN cv b ON b.id = src.chunk_id AND b.b = src.b GROUP BY ALL),
pw AS MATERIALIZED (SELECT chunk_id, {TOKENS.format('passage')} AS ws FROM passages WHERE chunk_id IN (SELECT chunk_id FROM top)), qw AS MATERIALIZED (SELECT query_id, {TOKENS.format('text')} AS ws FROM qs),
ok AS (SELECT s.fact_id, s.chunk_id, len(list_intersect(p.ws, q.ws)) / len(list_distinct(q.ws)) >= 0.75 AS ok FROM sim s JOIN pw p ON p.chunk_id = s.chunk_id JOIN qw q ON q.query_id = s.fact_id WHERE s.s >= 0.55)
SELECT fact_id, chunk_id FROM ok WHERE ok UNION SELECT fact_id, chunk_id FROM own""")
def fact_groups(spark, d):
    """The chunks that carry a fact: its source, and hits of its probe that are like the source and entail it."""
    probe, parts = _set_up(spark, d)
    facts = written(parts.select((F.col("query_id") * 10 + F.col("part")).alias("fact_id"), "chunk_id", "probe"), "facts")
    hits = written(probe.hits(facts.select(F.col("fact_id").alias("query_id"), F.col("probe").alias("text")), k=8).select(F.col("query_id").alias("fact_id"), F.col("id").alias("hit")), "hits")
    vec = written(probe.vectors_of(hits.select(F.col("hit").alias("chunk_id")).union(facts.select("chunk_id"))), "met")
    j = hits.join(facts, "fact_id").join(vec.select(F.col("chunk_id").alias("hit"), F.col("vec").alias("hv")), "hit").join(vec, "chunk_id")
    dot = F.aggregate(F.zip_with("vec", "hv", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    near = j.where(F.round(dot, 6) >= 0.55).join(_passages(spark, d).select(F.col("chunk_id").alias("hit"), "passage"), "hit")
    kept = near.where(L.entailed(F.col("passage"), F.col("probe"))).select("fact_id", F.col("hit").alias("chunk_id"))
    return kept.union(facts.select("fact_id", "chunk_id")).distinct()


@query("""WITH l AS (SELECT l_orderkey AS task, l_suppkey % 3 AS doc, l_extendedprice AS w, l_linenumber * 1000000 + l_partkey AS fact FROM lineitem)
SELECT task, fact, CASE WHEN count(*) OVER (PARTITION BY task, doc) = 1 THEN 'document' WHEN row_number() OVER (PARTITION BY task ORDER BY w DESC, fact) = 1 THEN 'identifier' ELSE 'removable' END AS verdict FROM l""")
def minimise_vetoes(spark, d):
    li = table(spark, d, "lineitem")
    facts = li.select(F.col("l_orderkey").alias("task"), (F.col("l_suppkey") % 3).alias("doc"), F.col("l_extendedprice").alias("w"), (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).cast("long").alias("fact"))
    return ST.vetoes(facts, "task", "doc", "w", "fact").select("task", "fact", "verdict")


@query("""WITH c AS (SELECT CAST(doc_id % 10 AS BIGINT) AS task, doc_id AS id, CAST(doc_id // 10 % 3 + 1 AS BIGINT) AS level, n_chars AS ord, n_chars % 5 = 0 AS ok FROM documents),
w AS (SELECT *, (row_number() OVER (PARTITION BY task, level ORDER BY ord, id) - 1) // 4 AS wave FROM c), b AS (SELECT task, level, wave, sum(CASE WHEN ok THEN 1 ELSE 0 END) = 0 AS barren FROM w GROUP BY ALL),
e AS (SELECT task, level, min(wave) AS last FROM (SELECT *, barren AND lag(barren, 1, FALSE) OVER (PARTITION BY task, level ORDER BY wave) AS fin FROM b) WHERE fin GROUP BY ALL),
l AS (SELECT w.*, row_number() OVER (PARTITION BY w.task, w.level ORDER BY ord, id) AS rk FROM w LEFT JOIN e ON e.task = w.task AND e.level = w.level WHERE ok AND (last IS NULL OR wave <= last)),
p AS (SELECT *, row_number() OVER (PARTITION BY task ORDER BY CASE WHEN level = 2 AND rk <= 2 THEN 0 WHEN level = 1 THEN 1 WHEN level = 2 THEN 2 ELSE 3 END, ord, id) AS place FROM l)
SELECT task, id, level, place FROM p WHERE place <= 24""")
def distractor_cascade(spark, d):
    docs = table(spark, d, "documents")
    c = docs.select((F.col("doc_id") % 10).alias("task"), F.col("doc_id").alias("id"), (F.floor(F.col("doc_id") / 10) % 3 + 1).cast("long").alias("level"), F.col("n_chars").alias("ord"), (F.col("n_chars") % 5 == 0).alias("ok"))
    return ST.cascade(c, 2, 24)


@query()
def sequential_densification(spark, d):
    """What earlier tasks of a scope inject counts for later ones; held against a plain loop in the tests."""
    v = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label")
    dense = M.density(v, 0.1).join(v.select("id", "label"), "id")
    return ST.densify(dense, "label", "id", "density", 60.0, 15)


@query("SELECT count(*) AS checked, CAST(sum(CASE WHEN toxic = 0 THEN 0 ELSE 1 END) AS BIGINT) AS lost, round(sum(CASE WHEN toxic = 0 THEN 0 ELSE 1 END) / count(*)::DOUBLE, 4) AS rate FROM labels WHERE quality = 1")
def reach_loss(spark, d):
    la = table(spark, d, "labels")
    return ST.reach_loss(la.select("doc_id", (F.col("quality") == 1).alias("passed")), la.select("doc_id", (F.col("toxic") == 0).alias("passed")), "doc_id")


@query(f"""{probe_sql(QUESTIONS)}, top AS (SELECT query_id, chunk_id FROM hits WHERE rank <= 10), owner AS (SELECT chunk_id, min(query_id) AS owner FROM tk GROUP BY 1)
SELECT t.query_id, t.chunk_id, CASE WHEN k.query_id IS NOT NULL THEN 'own' WHEN owner IS NOT NULL THEN 'foreign_gold'
  WHEN len(list_intersect({TOKENS.format('p.passage')}, {TOKENS.format('q.text')})) / len(list_distinct({TOKENS.format('q.text')})) >= 0.75 THEN 'entails' WHEN p.file_name IN (SELECT file_name FROM tk WHERE tk.query_id = t.query_id) THEN 'same_document' ELSE 'clear' END AS reason
FROM top t LEFT JOIN tk k ON k.query_id = t.query_id AND k.chunk_id = t.chunk_id LEFT JOIN owner o ON o.chunk_id = t.chunk_id JOIN passages p ON p.chunk_id = t.chunk_id JOIN qs q ON q.query_id = t.query_id""")
def isolation_reasons(spark, d):
    """Why a hit of a task's question may not stay: another task's gold, a passage that answers it too, its own document."""
    probe, parts = _set_up(spark, d)
    questions = written(_questions(parts), "questions")
    hits = probe.hits(questions).select("query_id", F.col("id").alias("chunk_id")).join(_passages(spark, d).select("chunk_id", "file_name", "passage"), "chunk_id").join(questions, "query_id")
    own = parts.select("query_id", "chunk_id", F.lit(True).alias("own")).distinct()
    owner = parts.groupBy("chunk_id").agg(F.min("query_id").alias("owner"))
    files = parts.select("query_id", "file_name", F.lit(True).alias("same")).distinct()
    j = hits.join(own, ["query_id", "chunk_id"], "left").join(owner, "chunk_id", "left").join(files, ["query_id", "file_name"], "left")
    reason = F.when(F.col("own"), "own").when(F.col("owner").isNotNull(), "foreign_gold").when(L.entailed(F.col("passage"), F.col("text")), "entails").when(F.col("same"), "same_document").otherwise("clear")
    return j.select("query_id", "chunk_id", reason.alias("reason"))


RECORDS = f"""{probe_sql(QUESTIONS)}, {GAPS}, r AS (SELECT g.query_id, text, string_agg(chunk_id, ',' ORDER BY part) AS gold, min(lex_gap) <= 0.34 AS lexical, max(fused_gap) AS gap FROM gaps g JOIN qs USING (query_id) GROUP BY ALL)"""


def _records(spark, d):
    probe, parts = _set_up(spark, d)
    questions = written(_questions(parts), "questions")
    gaps = probe.gaps(questions, parts.select("query_id", "chunk_id")).join(parts.select("query_id", "chunk_id", "part"), ["query_id", "chunk_id"])
    by = gaps.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("part", "chunk_id"))).alias("xs"), (F.min("lex_gap") <= 0.34).alias("lexical"), F.max("fused_gap").alias("gap"))
    return by.join(questions, "query_id").select("query_id", "text", F.array_join(F.transform("xs", lambda x: x["chunk_id"]), ",").alias("gold"), "lexical", "gap")


@query(f"{RECORDS} SELECT query_id, text, gold, lexical, gap FROM r")
def task_records(spark, d):
    """Final records: question, gold, whether its words alone lead to it, gap."""
    return _records(spark, d)


@query(f"{RECORDS} SELECT CASE WHEN query_id % 5 = 0 THEN 'holdout' ELSE 'train' END AS split, count(*) AS n, round(avg(CASE WHEN lexical THEN 1.0::DOUBLE ELSE 0 END), 4) AS lexical_share, round(avg(CASE WHEN gap <= 0.33 THEN 1.0::DOUBLE ELSE 0 END), 4) AS low_share, round(avg(CASE WHEN gap > 0.66 THEN 1.0::DOUBLE ELSE 0 END), 4) AS high_share, round(avg(len(string_split(gold, ','))), 4) AS mean_gold FROM r GROUP BY 1")
def export_stats(spark, d):
    r = _records(spark, d)
    share = lambda c: F.round(F.avg(c.cast("double")), 4)
    split = F.when(F.col("query_id") % 5 == 0, "holdout").otherwise("train").alias("split")
    return r.groupBy(split).agg(F.count("*").alias("n"), share(F.col("lexical")).alias("lexical_share"), share(F.col("gap") <= 0.33).alias("low_share"), share(F.col("gap") > 0.66).alias("high_share"), F.round(F.avg(F.size(F.split("gold", ","))), 4).alias("mean_gold"))


@query()
def minimised_facts(spark, d):
    """Facts of an order without those that its others make up for; greedy from the start again, held against the plain loop."""
    li = table(spark, d, "lineitem")
    by = li.groupBy(F.col("l_orderkey").alias("task")).agg(F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").cast("long").alias("fact"), F.col("l_quantity").cast("double").alias("w")))).alias("xs"))
    return X.minimise(by, 0.6)


@query(f"""WITH h AS (SELECT doc_id, sha1(regexp_replace(trim(lower(text)), '\\s+', ' ', 'g')) AS hash, substr(text, 1, 400) AS head FROM documents), g AS (SELECT hash, count(*) AS n, min(doc_id) AS a, list_sort(list(doc_id))[2] AS b FROM h GROUP BY hash HAVING count(*) > 1),
w AS (SELECT g.*, list_distinct({TOKENS.format('x.head')}) AS p, list_distinct({TOKENS.format('y.head')}) AS q FROM g JOIN h x ON x.doc_id = a JOIN h y ON y.doc_id = b)
SELECT hash, n, round(n / (SELECT count(*) FROM documents)::DOUBLE, 6) AS share, a, b, round(CASE WHEN len(list_distinct(list_concat(p, q))) = 0 THEN 1.0 ELSE len(list_intersect(p, q)) / len(list_distinct(list_concat(p, q))) END, 6) AS jaccard FROM w""")
def duplicate_report(spark, d):
    """Groups of equal documents: size, share of the corpus, the first two members and how alike their beginnings are."""
    docs = table(spark, d, "documents").select("doc_id", T.content_hash(F.col("text")).alias("hash"), F.array_distinct(T.tokens(F.substring("text", 1, 400))).alias("ws"))
    first = docs.groupBy("hash").agg(F.count("*").alias("n"), F.min("doc_id").alias("a"), F.min_by("ws", "doc_id").alias("p")).where("n > 1")
    second = docs.join(first.select("hash", "a"), "hash").where("doc_id <> a").groupBy("hash").agg(F.min("doc_id").alias("b"), F.min_by("ws", "doc_id").alias("q"))
    total = docs.agg(F.count("*").alias("total"))
    j = first.join(second, "hash").crossJoin(F.broadcast(total))  # total is one row
    both = F.size(F.array_union("p", "q"))
    return j.select("hash", "n", F.round(F.col("n") / F.col("total"), 6).alias("share"), "a", "b", F.round(F.when(both == 0, 1.0).otherwise(F.size(F.array_intersect("p", "q")) / both), 6).alias("jaccard"))
