"""Queries over records, examples and metadata, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import records as G
from ..functions import text as T
from ..operators import facets as A
from .registry import query
from .views import CARDS, CHUNKS, TOKENS, cards, chunks, table

SEGMENTS = "list_filter(list_transform(string_split({}, '/'), lambda x: trim(x)), lambda x: x <> '')"
BUCKET = "CAST(page_id % 20 AS BIGINT)"
FILLED = "coalesce(nullif(trim({}), ''), nullif(trim({}), ''), {})"


@query("SELECT doc_id, lang AS lang_value, source AS source_value, '' AS missing, lang || ', ' || source AS tags FROM documents")
def field_values(spark, d):
    docs = table(spark, d, "documents").withColumn("meta", F.create_map(F.lit("source"), F.col("source")))
    value = lambda n: G.field_value(n, {"lang": F.col("lang")}, F.col("meta"))
    return docs.select("doc_id", value("lang").alias("lang_value"), value("source").alias("source_value"), value("phase").alias("missing"), F.array_join(F.array("lang", "source"), ", ").alias("tags"))


@query(f"""WITH {CHUNKS}, s AS (SELECT chunk_id, trim(source) AS exact, {SEGMENTS.format('title')} AS s FROM chunks)
SELECT chunk_id, exact, CASE WHEN len(s) - 1 < 2 THEN '' ELSE array_to_string(s[1:len(s) - 1], '/') END AS path FROM s""")
def scope_dispatch(spark, d):
    c = chunks(spark, d)
    return c.select("chunk_id", G.scope("exact", F.col("source")).alias("exact"), G.scope("path", F.col("title"), 0, 2).alias("path"))


@query(f"""WITH s AS (SELECT {BUCKET} AS bucket, {SEGMENTS.format('url')} AS s FROM pages WHERE url <> ''),
w AS (SELECT bucket, min(len(s)) AS n FROM s GROUP BY bucket), k AS (SELECT bucket, unnest(range(1, n + 1)) AS k FROM w),
same AS (SELECT bucket, k, count(DISTINCT array_to_string(s[1:k], '/')) = 1 AS ok FROM s JOIN k USING (bucket) GROUP BY ALL)
SELECT w.bucket, CAST(coalesce(max(CASE WHEN ok THEN k END), 0) AS BIGINT) AS depth FROM w LEFT JOIN same USING (bucket) GROUP BY w.bucket""")
def shared_prefix_depth(spark, d):
    """Leading segments common to all paths of a bucket: the least and the greatest path agree exactly as far as all do."""
    p = table(spark, d, "pages").where("url <> ''").select((F.col("page_id") % 20).cast("long").alias("bucket"), T.path_segments(F.col("url")).alias("s"))
    ends = p.groupBy("bucket").agg(F.min("s").alias("a"), F.max("s").alias("b"))
    same = F.zip_with("a", "b", lambda x, y: F.coalesce(x == y, F.lit(False)))
    return ends.select("bucket", F.when(F.forall(same, lambda x: x), F.least(F.size("a"), F.size("b"))).otherwise(F.array_position(same, F.lit(False)) - 1).cast("long").alias("depth"))


@query(f"""WITH s AS (SELECT page_id, array_to_string({SEGMENTS.format('url')}, ' > ') AS x FROM pages) SELECT page_id, CASE WHEN length(x) <= 30 THEN x ELSE '…' || ltrim(substr(x, length(x) - 28)) END AS crumb FROM s""")
def breadcrumbs(spark, d):
    return table(spark, d, "pages").select("page_id", G.breadcrumb(F.col("url"), 30).alias("crumb"))


@query(f"WITH {CHUNKS} SELECT chunk_id, " + FILLED.format("CASE WHEN lang = 'en' THEN '  ' || source || ' ' ELSE ' ' END", "CASE WHEN doc_id % 2 = 0 THEN CAST(doc_id AS VARCHAR) ELSE '' END", "file_name") + " AS doc_key FROM chunks")
def document_keys(spark, d):
    meta = F.when(F.col("lang") == "en", F.concat(F.lit("  "), "source", F.lit(" "))).otherwise(" ")
    own = F.when(F.col("doc_id") % 2 == 0, F.col("doc_id").cast("string")).otherwise("")
    return chunks(spark, d).select("chunk_id", G.first_filled(meta, own, F.col("file_name")).alias("doc_key"))


@query("SELECT doc_id, CASE WHEN length(text) <= 80 THEN text ELSE rtrim(substr(text, 1, 80), ' ') || '…' END AS head FROM documents")
def shortened_headers(spark, d):
    return table(spark, d, "documents").select("doc_id", G.shortened(F.col("text"), 80).alias("head"))


EXAMPLES = """turns AS (SELECT conv_id, turn, role, text, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS answer, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS then_role FROM conversations),
hops AS (SELECT conv_id, turn, text AS question, coalesce(answer, '') AS answer, turn % 7 <> 3 AS supported FROM turns WHERE role = 'user')"""


def _hops(spark, d):
    c = table(spark, d, "conversations")
    w = Window.partitionBy("conv_id").orderBy("turn")
    turns = c.select("conv_id", "turn", "role", F.col("text").alias("question"), F.coalesce(F.lead("text").over(w), F.lit("")).alias("answer"))
    return turns.where("role = 'user'").select("conv_id", "turn", "question", "answer", (F.col("turn") % 7 != 3).alias("supported"))


@query(f"WITH {EXAMPLES} SELECT conv_id, count(*) AS hops, count(*) >= 2 AND bool_and(trim(answer) <> '' AND supported) AS usable FROM hops GROUP BY conv_id")
def usable_examples(spark, d):
    """Conversations as multi-hop examples: answered questions in a row, each with a supporting paragraph."""
    ok = F.min((F.trim("answer") != "") & F.col("supported"))
    return _hops(spark, d).groupBy("conv_id").agg(F.count("*").alias("hops"), ((F.count("*") >= 2) & ok).alias("usable"))


@query(r"SELECT conv_id, turn FROM conversations WHERE turn >= 1 AND regexp_matches(lower(text), '(^|[^\p{L}])(it|that|this|they)([^\p{L}]|$)')")
def turn_filter(spark, d):
    return table(spark, d, "conversations").where(F.col("turn") >= 1).where(F.lower("text").rlike(r"(^|[^\p{L}])(it|that|this|they)([^\p{L}]|$)")).select("conv_id", "turn")


@query(f"""WITH {CARDS}, q AS (SELECT number, 'which ' || lower(region) || ' orders of ' || substr(published, 1, 4) || ' count' AS q, 'region: ' || region || ' -> nation: ' || nation || '; year:' || substr(published, 1, 4) AS a FROM cards),
w AS (SELECT number, q, {TOKENS.format("regexp_replace(unnest(regexp_split_to_array(a, '->|[,;]')), '^[^:]*:', '')")} AS ws FROM q)
SELECT number, bool_or(len(list_filter(ws, lambda w: length(w) >= 2 AND contains(q, w) AND (NOT regexp_matches(w, '^\\p{{L}}+$') OR length(w) > 3))) > 0) AS seen FROM w GROUP BY number""")
def attribute_observable(spark, d):
    year = F.substring("published", 1, 4)
    asked = F.concat(F.lit("which "), F.lower("region"), F.lit(" orders of "), year, F.lit(" count"))
    said = F.concat(F.lit("region: "), "region", F.lit(" -> nation: "), "nation", F.lit("; year:"), year)
    return cards(spark, d).select("number", G.observable(said, asked).alias("seen"))


FLAGS = "CASE WHEN quality = 0 THEN 'unanswerable' END, CASE WHEN toxic = 1 THEN 'unsafe' END, CASE WHEN n_chars < 1000 THEN 'too_easy' END, CASE WHEN lang <> 'en' AND n_chars > 3000 THEN 'ambiguous' END"


@query(f"SELECT doc_id, concat_ws(',', {FLAGS}) AS problems, concat_ws(',', {FLAGS}) = '' AS passed FROM documents JOIN labels USING (doc_id)")
def solve_policy(spark, d):
    j = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    flags = {"unanswerable": F.col("quality") == 0, "unsafe": F.col("toxic") == 1, "too_easy": F.col("n_chars") < 1000, "ambiguous": (F.col("lang") != "en") & (F.col("n_chars") > 3000)}
    return j.select("doc_id", G.problems(flags).alias("problems"), (G.problems(flags) == "").alias("passed"))


@query("SELECT doc_id, coalesce(quality = 1, FALSE) AND coalesce(toxic = 0, FALSE) AND n_chars >= 200 AS kept FROM documents LEFT JOIN labels USING (doc_id)")
def groundedness_policy(spark, d):
    j = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return j.select("doc_id", G.all_of(F.col("quality") == 1, F.col("toxic") == 0, F.col("n_chars") >= 200).alias("kept"))


LISTS = "lists AS (SELECT l_orderkey AS id, list(l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS wanted, list(l_suppkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS valid FROM lineitem GROUP BY l_orderkey)"
ORDERED = "list_filter({0}, lambda x, i: list_position({0}, x) = i)"


def _lists(spark, d):
    by = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))).alias("xs"))
    return by.select("id", F.transform("xs", lambda x: x["l_partkey"]).alias("wanted"), F.transform("xs", lambda x: x["l_suppkey"]).alias("valid"))


def _csv(c):
    return F.array_join(c.cast("array<string>"), ",")


@query(f"WITH {LISTS}, m AS (SELECT id, list_transform(wanted, lambda x: x % 10) AS w, list_transform(valid, lambda x: x % 10) AS v FROM lists) SELECT id, array_to_string(list_filter({ORDERED.format('w')}, lambda x: list_contains(v, x)), ',') AS members FROM m")
def valid_members(spark, d):
    ten = lambda c: F.transform(c, lambda x: x % 10)
    return _lists(spark, d).select("id", _csv(G.members(ten("wanted"), ten("valid"))).alias("members"))


@query(f"WITH {LISTS}, m AS (SELECT id, list_concat(wanted, valid) AS b FROM lists) SELECT id, array_to_string({ORDERED.format('b')}, ',') AS merged, array_to_string(list_sort(list_distinct(b)), ',') AS gold FROM m")
def gold_unions(spark, d):
    """Positives with gold, in order of first mention; and the sorted union of fact groups."""
    both = F.concat("wanted", "valid")
    return _lists(spark, d).select("id", _csv(F.array_distinct(both)).alias("merged"), _csv(F.array_sort(F.array_distinct(F.flatten(F.array("wanted", "valid"))))).alias("gold"))


@query("SELECT item_id AS id, 'windows' AS profile, text FROM benchmark UNION ALL SELECT conv_id * 1000 + turn, 'documents', text FROM conversations WHERE role = 'user'")
def candidate_union(spark, d):
    a = table(spark, d, "benchmark").select(F.col("item_id").alias("id"), F.lit("windows").alias("profile"), "text")
    b = table(spark, d, "conversations").where("role = 'user'").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.lit("documents").alias("profile"), "text")
    return a.unionByName(b)


PRICES = "SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN replace(translate(format('{:,.2f}', o_totalprice), ',', ' '), '.', ',') WHEN 1 THEN CAST(o_totalprice AS VARCHAR) WHEN 2 THEN 'approx ' || o_orderkey ELSE '  -' || o_orderkey || ' ' END AS raw FROM orders"


@query(f"""WITH p AS ({PRICES}), b AS (SELECT id, replace(regexp_replace(raw, '\\s+', '', 'g'), ',', '.') AS b FROM p) SELECT id, CASE WHEN regexp_matches(b, '^-?[0-9]+(\\.[0-9]+)?$') THEN try_cast(b AS DOUBLE) END AS value FROM b""")
def number_parse(spark, d):
    o = table(spark, d, "orders")
    k, price, key = F.col("o_orderkey") % 4, F.col("o_totalprice"), F.col("o_orderkey").cast("string")
    raw = F.when(k == 0, F.translate(F.format_number(price.cast("double"), 2), ",.", " ,")).when(k == 1, price.cast("string")).when(k == 2, F.concat(F.lit("approx "), key)).otherwise(F.concat(F.lit("  -"), key, F.lit(" ")))
    return o.select(F.col("o_orderkey").alias("id"), G.number(raw).alias("value"))


@query("WITH v AS (SELECT o_orderkey AS id, o_totalprice::DOUBLE * (CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 40 ELSE 40000 END) AS v FROM orders) SELECT id, CASE WHEN v >= 1e9 THEN format('{:.2f}', v / 1e9) || ' billion' WHEN v >= 1e6 THEN 'about ' || format('{:.1f}', v / 1e6) || ' million' ELSE '' END AS gloss FROM v")
def amount_gloss(spark, d):
    k = F.col("o_orderkey") % 3
    v = F.col("o_totalprice").cast("double") * F.when(k == 0, 1).when(k == 1, 40).otherwise(40000)
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), G.gloss(v).alias("gloss"))


@query("SELECT l_orderkey AS id, l_linenumber AS line, CAST(round(l_discount * 100) AS BIGINT) || ' %' AS discount, CAST(round(l_tax * 100) AS BIGINT) || ',5 %' AS tax FROM lineitem")
def percent_format(spark, d):
    whole = lambda c: F.round(F.col(c) * 100).cast("long").cast("string")
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), G.percent(F.concat(whole("l_discount"), F.lit(".00%"))).alias("discount"), G.percent(F.concat(whole("l_tax"), F.lit(".50 %"))).alias("tax"))


@query(f"WITH {LISTS} SELECT id, array_to_string(list_transform(wanted[1:3], lambda x: 'part ' || x), '|') AS parts, CAST(least(3, len(wanted)) AS BIGINT) AS n FROM lists")
def multi_value_split(spark, d):
    packed = F.array_join(F.transform("wanted", lambda x: F.concat(F.lit(" part "), x.cast("string"))), "||")
    mixed = F.regexp_replace(packed, r"(part [0-9]+)\|\|", "$1 ;  ")
    parts = G.values(F.when(F.col("id") % 2 == 0, packed).otherwise(mixed), 3)
    return _lists(spark, d).select("id", F.array_join(parts, "|").alias("parts"), F.size(parts).cast("long").alias("n"))


REGIONS = {"0": "Africa", "1": "America", "2": "Asia", "3": "Europe"}


@query("SELECT n_nationkey AS id, CASE n_regionkey WHEN 0 THEN 'Africa' WHEN 1 THEN 'America' WHEN 2 THEN 'Asia' WHEN 3 THEN 'Europe' ELSE '0' || n_regionkey END AS region FROM nation")
def code_lookup(spark, d):
    return table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), G.looked_up(F.concat(F.lit("0"), F.col("n_regionkey").cast("string")), REGIONS).alias("region"))


@query("SELECT n_name AS name, lower(n_name) IN ('china', 'germany') OR (length(n_name) >= 6 AND lower(substr(n_name, 1, 6)) IN ('german', 'united')) AS known FROM nation")
def proper_stems(spark, d):
    return table(spark, d, "nation").select(F.col("n_name").alias("name"), G.like_stem(F.col("n_name"), ["China", "Germany", "Unitedly"]).alias("known"))


NAME = "upper(n_name || ' co of ' || r_name || ' nbc iv')"


@query("SELECT n_nationkey AS id, array_to_string(list_transform(string_split(n_name, ' '), lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ') || ' CO of ' || array_to_string(list_transform(string_split(r_name, ' '), lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ') || ' NBC IV' AS name FROM nation JOIN region ON n_regionkey = r_regionkey")
def smart_names(spark, d):
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    name = F.upper(F.concat("n_name", F.lit(" co of "), "r_name", F.lit(" nbc iv")))
    return n.join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("id"), G.smart_case(name, keep=("CO",)).alias("name"))


@query(f"""WITH {CARDS} SELECT number, 'Order ' || number || '.' || chr(10) || 'region ' || region || ', nation ' || nation || '.' || chr(10) || 'The price is ' || translate(format('{{:,.2f}}', price), ',.', ' ,') || '.' || chr(10) || 'published ' || published || '.' AS prose FROM cards""")
def record_prose(spark, d):
    return cards(spark, d).select("number", G.record_prose(F.concat(F.lit("Order "), "number"), {"region": F.col("region"), "nation": F.col("nation")}, F.col("price"), {"published": F.col("published")}).alias("prose"))


@query("SELECT l_orderkey AS id, l_linenumber AS line, CASE WHEN l_linenumber % 3 = 2 THEN NULL ELSE strftime(l_shipdate, '%Y-%m-%d') END AS shipped FROM lineitem")
def date_parse(spark, d):
    k, day = F.col("l_linenumber") % 3, F.col("l_shipdate")
    raw = F.when(k == 0, F.date_format(day, "yyyy-MM-dd'T'10:00:00")).when(k == 1, F.date_format(day, " dd.MM.yyyy")).otherwise(F.date_format(day, "yyyy/MM/dd"))
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), G.iso_date(raw).alias("shipped"))


@query("WITH s AS (SELECT o_custkey AS customer, CAST(min(o_orderdate) AS DATE) AS a FROM orders GROUP BY o_custkey) SELECT customer, strftime(a + CAST(k AS INT), '%Y-%m-%d') AS day FROM s, range(4) r(k)")
def day_range(spark, d):
    s = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("customer")).agg(F.min("o_orderdate").cast("date").alias("a"))
    return s.select("customer", F.explode(F.sequence("a", F.date_add("a", 3))).alias("day")).select("customer", F.date_format("day", "yyyy-MM-dd").alias("day"))


@query("WITH f AS (SELECT l_orderkey AS id, l_partkey, l_linenumber FROM lineitem) SELECT id, l_partkey AS part, l_linenumber AS line FROM f WHERE l_linenumber <= 3")
def facts_json(spark, d):
    """Facts as nested JSON and back, those of the first three lines of each order, however many."""
    items = F.to_json(F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part")))))
    by = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(items.alias("j"))
    read = F.filter(F.from_json("j", "array<struct<line:int,part:bigint>>"), lambda x: x["line"] <= 3)
    return by.select("id", F.explode(read).alias("x")).select("id", "x.part", "x.line")


@query(f"""WITH {CARDS}, r AS (SELECT *, row_number() OVER (PARTITION BY lower(nation) ORDER BY number) AS rn FROM cards WHERE region = 'ASIA' AND price > 100000)
SELECT 'nation' AS field, count(*) AS n, string_agg(nation, ', ' ORDER BY lower(nation)) AS answer FROM r WHERE rn = 1""")
def answer_projection(spark, d):
    """The distinct values of the answer field over the documents that meet the filter, case aside, as one line."""
    rows = cards(spark, d).where("region = 'ASIA' AND price > 100000")
    first = rows.groupBy(F.lower("nation").alias("low")).agg(F.min_by("nation", "number").alias("raw"))
    by = first.agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("low", "raw"))).alias("xs"))
    return by.select(F.lit("nation").alias("field"), "n", F.array_join(F.transform("xs", lambda x: x["raw"]), ", ").alias("answer"))


AUDIT = "a AS (SELECT customer AS g, count(*) AS n_gold, concat_ws(',', " + ", ".join(f"CASE WHEN count(DISTINCT trim(lower({f}))) = 1 THEN '{f}' END" for f in ("region", "nation", "phase", "procedure")) + ") AS shared FROM cards GROUP BY customer)"
VERDICT = "CASE WHEN n_gold < 2 THEN 'no_filter' WHEN shared = '' THEN 'unrepairable' WHEN shared = 'region,nation' THEN 'augmentable' ELSE 'repairable' END"


@query(f"WITH {CARDS}, {AUDIT} SELECT {VERDICT} AS verdict, count(*) AS n, round(median(n_gold), 4) AS median_gold FROM a GROUP BY 1")
def audit_verdicts(spark, d):
    a = A.shared_facets(cards(spark, d).withColumnRenamed("customer", "g"), ["region", "nation", "phase", "procedure"])
    verdict = F.when(F.col("n_gold") < 2, "no_filter").when(F.col("shared") == "", "unrepairable").when(F.col("shared") == "region,nation", "augmentable").otherwise("repairable")
    return a.groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"), F.round(F.percentile("n_gold", F.lit(0.5)), 4).alias("median_gold"))


@query(f"""WITH {CARDS}, p AS (SELECT CASE WHEN CAST(number AS BIGINT) % 3 = 0 THEN lpad(CAST(CAST(number AS BIGINT) // 6 AS VARCHAR), 19, '1') ELSE number END AS id, number, nation FROM cards),
m AS (SELECT id, count(*) AS parts, min_by(nation, number) AS nation FROM p WHERE regexp_matches(id, '^[0-9]{{19,}}$') GROUP BY id)
SELECT id, parts, nation FROM m UNION ALL SELECT id, 1, nation FROM p WHERE NOT regexp_matches(id, '^[0-9]{{19,}}$')""")
def mergeable_records(spark, d):
    """Records with a registry number of 19 digits or more are merged; the others go by, and only the first kind is shuffled."""
    k = F.col("number").cast("long")
    ids = F.when(k % 3 == 0, F.lpad(F.floor(k / 6).cast("string"), 19, "1")).otherwise(F.col("number"))
    p = cards(spark, d).select(ids.alias("id"), "number", "nation")
    own = F.col("id").rlike(r"^[0-9]{19,}$")
    merged = p.where(own).groupBy("id").agg(F.count("*").alias("parts"), F.min_by("nation", "number").alias("nation"))
    return merged.unionByName(p.where(~own).select("id", F.lit(1).cast("long").alias("parts"), "nation"))


@query("""WITH r AS (SELECT l_orderkey AS sg, l_linenumber AS chunk, CAST(l_partkey % 20 AS BIGINT) AS anchor FROM lineitem),
s AS (SELECT sg, anchor FROM r GROUP BY sg, anchor HAVING count(DISTINCT chunk) > 1) SELECT DISTINCT r.sg, r.sg IN (SELECT sg FROM s) AS anchored FROM r""")
def shared_anchors(spark, d):
    """Whether two chunks of a subgraph share an anchor of their facts."""
    r = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("sg"), F.col("l_linenumber").alias("chunk"), (F.col("l_partkey") % 20).alias("anchor"))
    by = r.groupBy("sg", "anchor").agg(F.count_distinct("chunk").alias("c"))
    return by.groupBy("sg").agg((F.max("c") > 1).alias("anchored"))
