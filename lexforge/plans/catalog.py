"""Queries over the test tables, one or more per operator, each with SQL for a second engine where it can say the same."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexforge.functions import text as T
from lexforge.operators import facets, layout, lines, links, manifest, models, tree

QUERIES: dict = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of a folder, read when named."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")


def query(sql: str | None = None):
    """Register a query of the tables under its function's name."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# ---------------------------------------------------------------- catalogs


@query("""
SELECT doc_id, tier, place FROM (
  SELECT d.doc_id, CASE WHEN d.doc_id % 97 = 5 THEN 0 ELSE 1 END AS tier, d.doc_id AS place
  FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND (l.quality = 1 OR l.toxic = 1)))
ORDER BY tier, place, doc_id LIMIT 25""")
def t01_next_batch(t):
    rows = t.documents.select("doc_id", F.col("doc_id").alias("pos"))
    done, failed = t.labels.filter("quality = 1").select("doc_id"), t.labels.filter("toxic = 1").select("doc_id")
    queue = rows.filter("doc_id % 97 = 5").select("doc_id", F.col("doc_id").alias("prio"))
    return manifest.next_batch(rows, done, failed, queue, 25).select("doc_id", "tier", "place")


@query("SELECT l_orderkey AS law_id, min(l_partkey) AS bill_id FROM lineitem GROUP BY 1")
def a04_min_bill(t):
    return t.lineitem.groupBy(F.col("l_orderkey").alias("law_id")).agg(F.min("l_partkey").alias("bill_id"))


@query("""
SELECT o_orderkey AS law_id, coalesce(string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_linenumber, l_partkey), '') AS ids,
  min(l_partkey) AS bill_id FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")
def a02_lookup_lists(t):
    ids = manifest.lookup_list(t.lineitem.select(F.col("l_orderkey").alias("law_id"), F.struct("l_linenumber", "l_partkey").alias("o"), F.col("l_partkey").cast("string").alias("v")), "law_id", "o", "v", "ids")
    low = t.lineitem.groupBy(F.col("l_orderkey").alias("law_id")).agg(F.min("l_partkey").alias("bill_id"))
    return t.orders.select(F.col("o_orderkey").alias("law_id")).join(ids, "law_id", "left").join(low, "law_id", "left").withColumn("ids", F.coalesce(F.array_join("ids", ","), F.lit("")))


@query("""
WITH first AS (SELECT l_orderkey k, arg_min(l_suppkey, l_linenumber * 1000000 + l_suppkey) c FROM lineitem GROUP BY 1)
SELECT o_orderkey AS law_id, CASE WHEN c IS NOT NULL THEN coalesce(m.slug, '') WHEN o_orderpriority = '1-URGENT' THEN 'basic-laws' ELSE '' END AS category
FROM orders LEFT JOIN first ON k = o_orderkey LEFT JOIN (VALUES (1, 'family'), (2, 'labour'), (3, 'tax')) m(id, slug) ON m.id = c % 7""")
def j04_category_slug(t):
    first = t.lineitem.groupBy(F.col("l_orderkey").alias("law_id")).agg(F.min_by("l_suppkey", F.struct("l_linenumber", "l_suppkey")).alias("c"))
    names = t.spark.createDataFrame([(1, "family"), (2, "labour"), (3, "tax")], "id long, slug string")
    rows = t.orders.select(F.col("o_orderkey").alias("law_id"), (F.col("o_orderpriority") == "1-URGENT").alias("basic")).join(first, "law_id", "left")
    met = rows.join(F.broadcast(names), F.col("id") == F.col("c") % 7, "left")  # three rows
    return met.select("law_id", manifest.category(F.col("c"), F.col("slug"), F.col("basic")).alias("category"))


@query("""
SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN CAST(l.quality AS VARCHAR) ELSE 'pending' END AS state
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def j05_preserve_state(t):
    old = t.labels.select("doc_id", F.col("quality").cast("string").alias("state"))
    return manifest.preserved(t.documents.select("doc_id"), old, "doc_id", {"state": "pending"})


@query("""
SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) n FROM events) WHERE n = 1""")
def w02_latest_document(t):
    rows = t.events.withColumn("date", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return manifest.latest_document(rows, "user_id", "date", "event_id").select("user_id", "event_id", "value")


@query("SELECT max(doc_id) AS doc_id, text FROM documents GROUP BY text")
def w03_keep_last(t):
    return manifest.keep(t.documents.select("doc_id", "text"), ["text"], [F.col("doc_id").desc()])


@query("SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text")
def w04_keep_first(t):
    return manifest.keep(t.documents.select("doc_id", "text"), ["text"], [F.col("doc_id").asc()])


@query("""
SELECT (SELECT count(*) FROM documents) AS total, (SELECT count(*) FROM documents WHERE lang = 'en') AS with_source,
 (SELECT count(DISTINCT doc_id) FROM labels WHERE quality = 1) AS done, (SELECT count(DISTINCT doc_id) FROM labels WHERE toxic = 1) AS failed,
 (SELECT count(*) FROM documents d WHERE lang = 'en' AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND (quality = 1 OR toxic = 1))) AS pending,
 CAST(25 AS BIGINT) AS deployed""")
def a07_status(t):
    return manifest.status(t.documents, t.labels.filter("quality = 1"), t.labels.filter("toxic = 1"), F.col("lang") == "en", 25)


@query("SELECT o_orderstatus AS status, count(*) AS n, count(*) FILTER (o_totalprice > 100000) AS with_path FROM orders GROUP BY 1")
def a06_status_counts(t):
    return t.orders.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"), F.count_if(F.col("o_totalprice") > 100000).alias("with_path"))


@query("SELECT o_orderstatus AS status, count(*) OVER (PARTITION BY o_orderstatus) AS n, o_orderkey AS file FROM orders")
def a11_files_by_status(t):
    """All files by status, a row each with the count of its status."""
    files = t.orders.select(F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("file"))
    counts = files.groupBy(F.col("status").alias("of")).agg(F.count("*").alias("n"))
    return files.join(counts, F.col("status").eqNullSafe(F.col("of"))).select("status", "n", "file")


@query("""
SELECT c_custkey, n, CASE WHEN n >= (FLOOR(CAST(c_nationkey AS DOUBLE) / 5) + 1) * 5 THEN true ELSE false END AS due
FROM customer JOIN (SELECT o_custkey, count(*) n FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def o06_deploy_due(t):
    n = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return t.customer.join(n, "c_custkey").select("c_custkey", "n", manifest.deploy_due(F.col("n"), F.col("c_nationkey"), 5).alias("due"))


@query("""
SELECT e.user_id AS doc_id, min(e.event_id) AS prio FROM events e
WHERE e.user_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1) AND e.user_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 97 = 5) GROUP BY 1""")
def j13_requeue(t):
    found = t.events.select(F.col("user_id").alias("doc_id"), F.col("event_id").alias("pos"))
    return manifest.requeue(found, t.documents.filter("doc_id % 97 = 5"), t.labels.filter("quality = 1"))


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS publication_date, coalesce(o_orderstatus, '') AS name, coalesce(o_orderpriority = '1-URGENT', false) AS is_basic,
 CAST(strftime(o_orderdate, '%Y') AS INTEGER) AS year FROM orders WHERE o_orderstatus = 'F' AND (o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%')""")
def f12_project_catalog(t):
    date = F.substring(F.coalesce(F.col("o_orderdate").cast("string"), F.lit("")), 1, 10)
    some = t.orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority").startswith("1") | F.col("o_orderpriority").startswith("2")))
    return some.select("o_orderkey", date.alias("publication_date"), F.coalesce("o_orderstatus", F.lit("")).alias("name"), F.coalesce(F.col("o_orderpriority") == "1-URGENT", F.lit(False)).alias("is_basic"), T.year_of(date).alias("year"))


@query("SELECT doc_id, lang FROM documents WHERE CAST(doc_id AS VARCHAR) IN ('1','5','77','x')")
def f02_ids_as_strings(t):
    return t.documents.filter(F.col("doc_id").cast("string").isin("1", "5", "77", "x")).select("doc_id", "lang")


@query("SELECT doc_id FROM documents WHERE lang <> '' EXCEPT SELECT doc_id FROM labels")
def f03_skip_existing(t):
    return manifest.with_source(t.documents, "lang").select("doc_id").join(t.labels.select("doc_id"), "doc_id", "left_anti")


@query("SELECT o_orderkey, TRY_CAST(o_clerk AS BIGINT) AS id FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'x' ELSE CAST(o_custkey AS VARCHAR) END AS o_clerk FROM orders) WHERE TRY_CAST(o_clerk AS BIGINT) IS NOT NULL")
def f10_integer_ids(t):
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, "x").otherwise(F.col("o_custkey").cast("string")).try_cast("bigint").alias("id"))
    return rows.filter("id is not null")


@query("""
SELECT page_id, CASE WHEN nullif(regexp_extract(html, '<html lang="([a-z]*)"', 1), '') IS NULL OR length(html) % 10 = 0 THEN 'pdf_only'
 WHEN NOT contains(html, '<article') OR regexp_extract(html, '<html lang="([a-z]*)"', 1) <> 'en' THEN 'wrong_version' ELSE 'fetched' END AS state FROM pages""")
def f06_gates(t):
    lang = F.nullif(F.regexp_extract("html", '<html lang="([a-z]*)"', 1), F.lit(""))
    n = F.when(lang.isNull(), None).otherwise(F.length("html") % 10)
    return t.pages.select("page_id", manifest.gate(n, F.contains("html", F.lit("<article")), F.when(lang == "en", "revised")).alias("state"))


@query("""
SELECT l_orderkey, l_linenumber, 5.0::DOUBLE AS level, CAST(l_linenumber AS DOUBLE) AS page_num, 1.0::DOUBLE AS block_num, 2.0::DOUBLE AS par_num, 3.0::DOUBLE AS line_num, 4.0::DOUBLE AS word_num, CAST(trim(x) AS DOUBLE) AS "left", CAST(l_partkey AS DOUBLE) AS top, 10.5::DOUBLE AS width, 11.0::DOUBLE AS height, 96.0::DOUBLE AS conf, txt AS text FROM (
 SELECT *, CASE WHEN l_quantity > 45 THEN 'bad' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS x,
  CASE WHEN l_returnflag = 'N' THEN ' ' ELSE l_returnflag END AS txt FROM lineitem) WHERE x <> 'bad' AND trim(txt) <> '' AND l_orderkey % 10 > 0""")
def f09_tsv_words(t):
    """Rows of twelve columns: one in ten has another column too many, some have a place that is no number."""
    from lexforge.sources.readers import TSV_COLUMNS

    x = F.when(F.col("l_quantity") > 45, "bad").otherwise(F.col("l_quantity").cast("int").cast("string"))
    text = F.when(F.col("l_returnflag") == "N", " ").otherwise(F.col("l_returnflag"))
    line = F.concat_ws("\t", F.lit("5"), F.col("l_linenumber").cast("string"), F.lit("1"), F.lit("2"), F.lit("3"), F.lit("4"), x, F.col("l_partkey").cast("string"), F.lit("10.5"), F.lit("11"), F.lit("96"), text)
    line = F.when(F.col("l_orderkey") % 10 == 0, F.concat(line, F.lit("\tmore"))).otherwise(line)
    return manifest.tsv_words(t.lineitem.select("l_orderkey", "l_linenumber", line.alias("line")), TSV_COLUMNS, TSV_COLUMNS[:-1])


@query("""
SELECT 'union' AS op, doc_id FROM (SELECT doc_id FROM documents UNION SELECT doc_id FROM labels)
UNION ALL SELECT 'bag', doc_id FROM documents UNION ALL SELECT 'bag', doc_id FROM labels
UNION ALL SELECT 'difference', doc_id FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)
UNION ALL SELECT 'symmetric', doc_id FROM ((SELECT doc_id FROM documents WHERE doc_id % 3 > 0 EXCEPT SELECT doc_id FROM labels WHERE toxic = 1) UNION ALL (SELECT doc_id FROM labels WHERE toxic = 1 EXCEPT SELECT doc_id FROM documents WHERE doc_id % 3 > 0))
UNION ALL SELECT 'intersection', doc_id FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels)""")
def u01_u06_sets(t):
    a, b = t.documents.select("doc_id"), t.labels.select("doc_id")
    c, toxic = a.filter("doc_id % 3 > 0"), t.labels.filter("toxic = 1").select("doc_id")
    symmetric = c.join(toxic, "doc_id", "left_anti").distinct().unionByName(toxic.join(c, "doc_id", "left_anti").distinct())
    named = {"union": a.union(b).distinct(), "bag": a.unionByName(b), "difference": a.join(b, "doc_id", "left_anti").distinct(), "symmetric": symmetric, "intersection": a.join(b, "doc_id", "left_semi").distinct()}
    return reduce(DataFrame.unionByName, (df.select(F.lit(k).alias("op"), "doc_id") for k, df in named.items()))


# ---------------------------------------------------------------- frontmatter and strings

_FM = "concat('---', chr(10), 'title: \"', source, '\"', chr(10), 'lang: ', lang, chr(10), 'tags: [a, ', lang, ']', chr(10), 'ids: [1, x, 3]', chr(10), '---', chr(10), text)"


@query(f"""
SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN '' ELSE substr(md, 1, instr(md, chr(10) || '---') + 4) END AS block, CASE WHEN doc_id % 5 = 0 THEN md ELSE substr(md, instr(md, chr(10) || '---') + 5) END AS body
FROM (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN text ELSE {_FM} END AS md FROM documents)""")
def r01_split_frontmatter(t):
    md = t.documents.select("doc_id", F.expr(f"CASE WHEN doc_id % 5 = 0 THEN text ELSE {_FM} END").alias("md"))
    block, body = T.split_frontmatter(F.col("md"))
    return md.select("doc_id", block.alias("block"), body.alias("body"))


@query("SELECT doc_id, source AS title, lang, CAST(NULL AS VARCHAR) AS missing, 'a,' || lang AS tags, '1,3' AS ids FROM documents")
def r03_fields(t):
    block = T.split_frontmatter(F.expr(_FM))[0]
    rows = t.documents.select("doc_id", block.alias("b"))
    return rows.select("doc_id", T.field(F.col("b"), "title").alias("title"), T.field(F.col("b"), "lang").alias("lang"), T.field(F.col("b"), "missing").alias("missing"), F.array_join(T.tag_list(F.col("b"), "tags"), ",").alias("tags"), F.array_join(F.transform(T.int_list(F.col("b"), "ids"), lambda x: x.cast("string")), ",").alias("ids"))


@query("SELECT o_orderkey, concat_ws(chr(10), '---', 'id: ' || CAST(o_orderkey AS VARCHAR), 'name: \"' || o_orderstatus || '\"', CASE WHEN o_orderpriority = '1-URGENT' THEN 'is_basic_law: true' END, '---', '') AS block FROM orders")
def r10_build_frontmatter(t):
    parts = F.array_compact(F.array(F.concat(F.lit("id: "), F.col("o_orderkey").cast("string")), F.concat(F.lit("name: "), T.quote(F.col("o_orderstatus"))), F.when(F.col("o_orderpriority") == "1-URGENT", "is_basic_law: true")))
    return t.orders.select("o_orderkey", T.render_frontmatter(parts).alias("block"))


@query("""
SELECT o_orderkey, 'Law ' || CAST(o_orderkey AS VARCHAR) || ' (' || strftime(o_orderdate, '%Y') || ') — ' || CASE WHEN o_orderstatus = 'O' THEN 'תקף' ELSE o_orderstatus END || '. Full text.' AS description FROM orders""")
def r09_description(t):
    title = F.concat(F.lit("Law "), F.col("o_orderkey").cast("string"))
    status = F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus"))
    return t.orders.select("o_orderkey", T.description(title, F.col("o_orderdate").cast("string"), status, "Full text.").alias("description"))


@query("""
SELECT page_id, CASE WHEN p LIKE '//%' THEN 'https:' || p WHEN p LIKE '/%' THEN 'https://files.example' || p ELSE p END AS url
FROM (SELECT page_id, CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN substr(url, instr(url, '//')) ELSE '/x' || CAST(page_id AS VARCHAR) END AS p FROM pages)""")
def r13_absolutise(t):
    p = F.expr("CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN substr(url, instr(url, '//')) ELSE concat('/x', cast(page_id as string)) END")
    return t.pages.select("page_id", T.absolute_url(p, "https://files.example").alias("url"))


@query("""
SELECT page_id, regexp_replace(replace(u, '/id/', '/'), '^http://', 'https://') AS external,
 CASE WHEN page_id % 2 = 0 THEN 'ukpga-' || CAST(1900 + page_id % 100 AS VARCHAR) || '-' || CAST(page_id AS VARCHAR) END AS slug
FROM (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'http://leg.example/id/ukpga/' || CAST(1900 + page_id % 100 AS VARCHAR) || '/' || CAST(page_id AS VARCHAR) || '/section/1' ELSE url END AS u FROM pages)""")
def r14_r15_identifiers(t):
    u = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("http://leg.example/id/ukpga/"), (1900 + F.col("page_id") % 100).cast("string"), F.lit("/"), F.col("page_id").cast("string"), F.lit("/section/1"))).otherwise(F.col("url"))
    rows = t.pages.select("page_id", u.alias("u"))
    return rows.select("page_id", T.external_link(F.col("u")).alias("external"), T.act_slug(F.col("u")).alias("slug"))


@query("SELECT doc_id, replace(replace(x, '{', chr(92) || '{'), '}', chr(92) || '}') AS escaped, x AS back FROM (SELECT doc_id, '{' || text || '}' AS x FROM documents)")
def r16_escape_braces(t):
    x = T.escape_braces(F.concat(F.lit("{"), F.col("text"), F.lit("}")))
    return t.documents.select("doc_id", x.alias("escaped"), T.unescape_braces(x).alias("back"))


@query("SELECT doc_id, trim(regexp_replace(text, '[ \\t\\n\\r\\f\\v]+', ' ', 'g')) AS text FROM documents")
def r17_squeeze(t):
    return t.documents.select("doc_id", T.squeeze(F.col("text")).alias("text"))


@query("SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[*][*]|[\\[\\]]', '', 'g'), '[ \\t\\n\\r\\f\\v]+', ' ', 'g')) AS text FROM documents")
def r18_undecorated(t):
    marked = F.concat(F.lit('<span id="a-1" />'), F.col("text"), F.lit(" [REPEALED][^f1] (repealed for x)**"))
    return t.documents.select("doc_id", T.undecorated(marked).alias("text"))


@query("SELECT p_partkey, regexp_full_match(lower(x), '([0-9]+[a-z]*|[ivxlcdm]+|[a-z]+)') AS ok FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN CAST(p_size AS VARCHAR) || 'A' WHEN 1 THEN 'iv' WHEN 2 THEN p_name ELSE 'A1' END AS x FROM part)")
def r19_valid_numbers(t):
    x = F.expr("CASE p_partkey % 4 WHEN 0 THEN concat(cast(p_size as string), 'A') WHEN 1 THEN 'iv' WHEN 2 THEN p_name ELSE 'A1' END")
    return t.part.select("p_partkey", T.valid_number(x).alias("ok"))


@query("""
SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(text, '[|]', '', 'g'), ',\\s*,', ',', 'g'), '[ \\t]{2,}', ' ', 'g'), ' ' || chr(10) || chr(9)) AS text FROM documents WHERE NOT regexp_matches(text, '(\\s+,\\s*(\\n|$))|--|[\\\\\\[\\]]|₪')""")
def r33_clean_ocr(t):
    return t.documents.select("doc_id", T.clean_ocr(F.col("text")).alias("text"))


@query("""
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(replace(x, chr(173), '-'), '[ \\t]+([.,;:])', '\\1', 'g'), '\\)([א-ת]{1,2}|\\d{1,3})\\(', '(\\1)', 'g'), ' {2,}', ' ', 'g') AS text
FROM (SELECT doc_id, replace(replace(text, ',', ' ,'), 'th', 't' || chr(173) || 'h') || '  )א( ; )12(  .' AS x FROM documents)""")
def e05_tidy(t):
    x = F.concat(F.replace(F.replace("text", F.lit(","), F.lit(" ,")), F.lit("th"), F.lit("t\u00adh")), F.lit("  )א( ; )12(  ."))
    return t.documents.select("doc_id", T.tidy(x).alias("text"))


@query("""
SELECT doc_id, CAST(i AS INTEGER) AS pos, substr(text, i * 2000 + 1, 2000) AS piece
FROM (SELECT doc_id, text, unnest(range(greatest(CAST(ceil(length(text) / 2000.0) AS BIGINT), 1))) AS i FROM documents)""")
def r31_chunks(t):
    return t.documents.select("doc_id", F.posexplode(T.chunks(F.col("text"), 2000)).alias("pos", "piece"))


@query(r"""
WITH a AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'חוק' WHEN 1 THEN 'חוק-יסוד: ' || title WHEN 2 THEN 'חוק ' || title || ', 1996' ELSE title END AS name, page_id % 4 AS m, title FROM (SELECT page_id, coalesce(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title FROM pages)),
b AS (SELECT *, CASE m WHEN 0 THEN 'law-' WHEN 1 THEN 'basic-law-' WHEN 2 THEN 'law-' ELSE '' END AS kind,
 regexp_replace(CASE m WHEN 0 THEN '' WHEN 2 THEN title || '  1996' ELSE title END, '[:.,;()\[\]"''״׳]', ' ', 'g') AS t, nullif(regexp_extract(name, '(\d{4})', 1), '') AS year FROM a),
c AS (SELECT *, trim(regexp_replace(lower(regexp_replace(strip_accents(t), '[^a-zA-Z0-9\s-]', '', 'g')), '[\s-]+', '-', 'g'), '-') AS plain FROM b)
SELECT page_id, CASE WHEN plain = '' THEN CASE WHEN kind = '' THEN 'law-' ELSE kind END || CAST(page_id AS VARCHAR) ELSE kind || plain || coalesce('-' || year, '') END AS slug FROM c""")
def r35_slug(t):
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    m = F.col("page_id") % 4
    name = F.when(m == 0, "חוק").when(m == 1, F.concat(F.lit("חוק-יסוד: "), title)).when(m == 2, F.concat(F.lit("חוק "), title, F.lit(", 1996"))).otherwise(title)
    return t.pages.select("page_id", T.slug(name, F.col("page_id")).alias("slug"))


@query("SELECT slug, page_id, CASE WHEN row_number() OVER (PARTITION BY slug ORDER BY page_id) = 1 THEN slug ELSE slug || '-' || CAST(page_id AS VARCHAR) END AS own FROM (SELECT page_id, regexp_extract(url, '://([^/]+)', 1) AS slug FROM pages)")
def o11_slug_collision(t):
    rows = t.pages.select("page_id", F.regexp_extract("url", "://([^/]+)", 1).alias("slug"))
    n = F.row_number().over(Window.partitionBy("slug").orderBy("page_id"))
    return rows.select("slug", "page_id", F.when(n == 1, F.col("slug")).otherwise(F.concat_ws("-", "slug", "page_id")).alias("own"))


@query("SELECT c_custkey, '{\"name\":\"' || c_name || '\"' || CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE ',\"segment\":\"' || c_mktsegment || '\"' END || '}' AS record FROM customer")
def r41_json_record(t):
    return t.customer.select("c_custkey", facets.json_record(name=F.col("c_name"), segment=F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))).alias("record"))


# ---------------------------------------------------------------- lines

_LINES = "SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS line FROM documents"
_HEADING, _NUMBER = r"^(T)(\w+)(.*)$", 2


def _numbered(t):
    """Lines of documents, each as a heading of its own number: the stand-in of numbered sections."""
    rows = lines.explode_lines(t.documents)
    return rows.withColumn("line", F.concat(F.lit("# "), (F.col("pos") + 1).cast("string"), F.lit(". "), "line"))


@query(f"SELECT doc_id, CAST(pos AS INTEGER) AS pos, '# ' || CAST(pos + 1 AS VARCHAR) || '. ' || regexp_replace(line, '\\s+$', '') || ' <span id=\"section-' || CAST(pos + 1 AS VARCHAR) || '\" />' AS line FROM ({_LINES}) WHERE NOT regexp_matches(line, '[\\r\\x0b\\x0c]')")
def r20_section_anchors(t):
    return lines.section_anchors(_numbered(t)).select("doc_id", "pos", "line")


@query(f"""
SELECT doc_id, CAST(pos AS INTEGER) AS pos, last_value(CASE WHEN line LIKE 'T%' THEN 'section-' || CAST(pos AS VARCHAR) END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS current FROM ({_LINES})""")
def w01_carry_anchor(t):
    rows = lines.explode_lines(t.documents).withColumn("anchor", F.when(F.col("line").startswith("T"), F.concat(F.lit("section-"), F.col("pos").cast("string"))))
    return lines.carried(rows).select("doc_id", "pos", "current")


@query(f"""
WITH l AS ({_LINES}), c AS (SELECT *, last_value(CASE WHEN line LIKE 'T%' THEN 'section-' || CAST(pos AS VARCHAR) END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS current FROM l)
SELECT doc_id, chr(10) || chr(10) || '## Sidenotes' || chr(10) || chr(10) || string_agg('- [' || trim(line, ' ') || '](#' || current || ')', chr(10) ORDER BY pos) AS index FROM c WHERE line LIKE 'A%' AND current IS NOT NULL GROUP BY 1""")
def r22_margin_index(t):
    rows = lines.explode_lines(t.documents).withColumn("anchor", F.when(F.col("line").startswith("T"), F.concat(F.lit("section-"), F.col("pos").cast("string"))))
    return lines.margin_index(rows.withColumn("line", F.when(F.col("line").startswith("A"), F.concat(F.lit("> "), "line")).otherwise(F.col("line"))))


@query()
def r22_margin_index_whole(t):
    """All documents, an old index stripped and the new one put at the end: r22_margin_index gives the indexes alone."""
    rows = lines.explode_lines(t.documents).withColumn("anchor", F.when(F.col("line").startswith("T"), F.concat(F.lit("section-"), F.col("pos").cast("string"))))
    rows = rows.withColumn("line", F.when(F.col("line").startswith("A"), F.concat(F.lit("> "), "line")).otherwise(F.col("line")))
    return lines.with_margin_index(lines.rebuild(rows), rows)


@query(f"""
WITH l AS ({_LINES}), n AS (SELECT doc_id, max(pos) + 1 AS n FROM l GROUP BY 1)
SELECT l.doc_id, CAST(pos AS INTEGER) AS pos, CASE WHEN line LIKE '>%' THEN line WHEN pos % 7 < n.n THEN line || ' [§ ' || CAST(pos % 7 AS VARCHAR) || '](#section-' || CAST(pos % 7 AS VARCHAR) || ')' ELSE line || ' § ' || CAST(pos % 7 AS VARCHAR) END AS line
FROM l JOIN n USING (doc_id)""")
def r21_section_links(t):
    rows = lines.explode_lines(t.documents)
    known = rows.select("doc_id", F.col("pos").cast("string").alias("num"))
    asked = rows.withColumn("line", F.when(F.col("line").startswith(">"), F.col("line")).otherwise(F.concat("line", F.lit(" § "), (F.col("pos") % 7).cast("string"))))
    return lines.linked_references(asked, known, r"§ \d+").select("doc_id", "pos", "line")


@query(f"""
WITH l AS ({_LINES}), x AS (SELECT doc_id, pos, pos % 4 AS m, '# ' || CAST(pos + 1 AS VARCHAR) || '. ' || regexp_replace(line, '\\s+$', '') || CASE pos % 4 WHEN 0 THEN ' לפי סעיף 1(א)' WHEN 1 THEN ' בסעיף  2א לחוק העונשין' WHEN 2 THEN ' וסעיפים 99999' ELSE ' [בסעיף 1](#section-1) לחוק זה' END || ' <span id="section-' || CAST(pos + 1 AS VARCHAR) || '" />' AS line FROM l)
SELECT doc_id, CAST(pos AS INTEGER) AS pos, CASE m WHEN 0 THEN replace(line, 'סעיף 1(א)', '[סעיף 1(א)](#section-1)') ELSE line END AS line FROM x""")
def r21_section_grammar(t):
    """References in their own grammar: with a suffix, to another law, to no section, and one that is a link already."""
    m = F.col("pos") % 4
    end = F.when(m == 0, " לפי סעיף 1(א)").when(m == 1, " בסעיף  2א לחוק העונשין").when(m == 2, " וסעיפים 99999").otherwise(" [בסעיף 1](#section-1) לחוק זה")
    rows = lines.explode_lines(t.documents).withColumn("line", F.concat(F.lit("# "), (F.col("pos") + 1).cast("string"), F.lit(". "), F.regexp_replace("line", r"\s+$", ""), end))
    return lines.section_links(lines.section_anchors(rows)).select("doc_id", "pos", "line")


@query("SELECT doc_id, text FROM documents")
def s11_explode_rebuild(t):
    return lines.rebuild(lines.explode_lines(t.documents))


@query(f"""
WITH l AS ({_LINES}) SELECT doc_id, CAST(min(pos) AS INTEGER) AS pos FROM l WHERE line LIKE 'The %' GROUP BY 1""")
def v08_first_difference(t):
    rows = lines.explode_lines(t.documents)
    changed = rows.withColumn("line", F.when(F.col("line").startswith("The "), F.concat(F.lit("~"), "line")).otherwise(F.col("line")))
    return lines.first_difference(rows, changed)


@query()
def r25_dictionary_links(t):
    names = t.benchmark.select(F.col("text").alias("name"), F.concat(F.lit("./"), F.col("item_id").cast("string"), F.lit(".md")).alias("url"))
    return lines.dictionary_links(t.documents.select("doc_id", "text"), names).filter(F.contains("text", F.lit(".md)")))


# ---------------------------------------------------------------- links

_HREFS = "SELECT page_id AS src, unnest(regexp_extract_all(html, '<a href=\"([^\"]+)\"', 1)) AS url FROM pages"


def _hrefs(t):
    return t.pages.select(F.col("page_id").alias("src"), F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]+)"'), F.lit(1))).alias("url"))


@query(f"""
WITH m AS (SELECT url, max(src) AS target FROM ({_HREFS}) GROUP BY 1)
SELECT src, h.url, target FROM ({_HREFS}) h JOIN m ON m.url = h.url WHERE target <> src""")
def j10_link_upgrade(t):
    """Links to an address lead to the last page that has it, but for that page's own."""
    return links.upgraded(_hrefs(t), _hrefs(t).groupBy("url").agg(F.max("src").alias("target"))).select("src", "url", "target")


@query(f"""
WITH l AS (SELECT src, regexp_extract(url, '^([^#]*)', 1) AS dst, nullif(regexp_extract(url, '#(.*)$', 1), '') AS anchor FROM ({_HREFS})), k AS (SELECT DISTINCT regexp_extract(url, '^([^#]*)', 1) AS dst FROM pages)
SELECT src, dst, anchor, 'BROKEN_INTERNAL_LINK' AS code FROM l WHERE dst NOT IN (SELECT dst FROM k)
UNION ALL SELECT src, dst, anchor, 'BROKEN_ANCHOR' FROM l WHERE anchor IS NOT NULL AND anchor <> 'top' AND dst IN (SELECT dst FROM k)""")
def j17_broken_links(t):
    at = lambda: F.regexp_extract("url", "^([^#]*)", 1)
    edges = _hrefs(t).select("src", at().alias("dst"), F.nullif(F.regexp_extract("url", "#(.*)$", 1), F.lit("")).alias("anchor"))
    docs = t.pages.select(at().alias("dst")).distinct()
    return links.broken(edges, docs, docs.withColumn("anchor", F.lit("top")))


@query("""
WITH r AS (SELECT doc_id, 'b' || CAST(doc_id % 60 AS VARCHAR) AS official, 'b' || CAST(doc_id % 45 AS VARCHAR) AS found FROM documents), t AS (SELECT 'b' || CAST(item_id AS VARCHAR) AS title, item_id AS law_id FROM benchmark),
m AS (SELECT r.*, coalesce(a.law_id, b.law_id) AS law_id FROM r LEFT JOIN t a ON a.title = official LEFT JOIN t b ON b.title = found)
SELECT doc_id, law_id, coalesce(law_id % 3 = 0, false) AS is_internal, CASE WHEN law_id % 3 = 0 THEN './' || CAST(law_id AS VARCHAR) || '.md' WHEN law_id IS NOT NULL THEN 'https://laws.example/' || CAST(law_id AS VARCHAR) END AS url FROM m""")
def j11_two_key_lookup(t):
    refs = t.documents.select("doc_id", F.concat(F.lit("b"), (F.col("doc_id") % 60).cast("string")).alias("official"), F.concat(F.lit("b"), (F.col("doc_id") % 45).cast("string")).alias("found"))
    titles = t.benchmark.select(F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("title"), F.col("item_id").alias("law_id"))
    return links.resolved(refs, titles, titles.filter("law_id % 3 = 0").select("law_id"), "https://laws.example/").select("doc_id", "law_id", "is_internal", "url")


@query("""
SELECT page_id, CASE WHEN slug IS NULL OR NOT inb THEN url WHEN slug = own AND k IS NULL THEN NULL WHEN slug = own THEN '#' || k WHEN k IS NULL THEN './' || slug || '.md' ELSE './' || slug || '.md#' || k END AS link FROM (
 SELECT *, CASE WHEN slug = own AND NOT known THEN NULL WHEN slug <> own AND ha AND NOT known THEN NULL ELSE anchor END AS k FROM (
  SELECT page_id, url, CASE WHEN page_id % 11 = 0 THEN NULL ELSE 's' || CAST(page_id % 5 AS VARCHAR) END AS slug, 's1' AS own, page_id % 5 < 4 AS inb, CASE WHEN page_id % 3 = 0 THEN NULL ELSE 'a' || CAST(page_id % 7 AS VARCHAR) END AS anchor, page_id % 2 = 0 AS ha, page_id % 7 < 3 AS known FROM pages))""")
def n02_link_decision(t):
    p = F.col("page_id")
    rows = t.pages.select("page_id", "url", F.when(p % 11 != 0, F.concat(F.lit("s"), (p % 5).cast("string"))).alias("slug"), F.when(p % 3 != 0, F.concat(F.lit("a"), (p % 7).cast("string"))).alias("anchor"))
    return rows.select("page_id", links.decided(F.col("slug"), F.col("anchor"), F.lit("s1"), p % 5 < 4, p % 2 == 0, p % 7 < 3, F.col("url")).alias("link"))


@query("""
SELECT item_id AS doc_id, 'ROUND_TRIP_MISSING' AS code, substr(s, 1, 80) AS message FROM (
 SELECT item_id, trim(regexp_replace(b.text, '\\s+', ' ', 'g')) AS s, trim(regexp_replace(d.text, '\\s+', ' ', 'g')) AS h FROM benchmark b JOIN documents d ON d.doc_id = b.item_id) WHERE s <> '' AND NOT contains(h, s)""")
def v01_round_trip(t):
    source = t.benchmark.select(F.col("item_id").alias("doc_id"), T.squeeze(F.col("text")).alias("source"))
    return links.missing_texts(source, t.documents.select("doc_id", F.col("text").alias("rendered")), clean=T.undecorated)


# ---------------------------------------------------------------- trees

_NODES = """
SELECT CAST(o_custkey AS VARCHAR) AS doc_id, 'o' || CAST(o_orderkey % 9 AS VARCHAR) AS id, o_orderkey AS pos, CASE WHEN o_orderkey % 4 = 0 THEN 'part' WHEN o_orderkey % 4 = 1 THEN 'block_quote' ELSE 'section' END AS kind, CASE WHEN o_orderkey % 6 = 2 THEN '1-x!' ELSE CAST(o_orderkey % 9 AS VARCHAR) END AS number FROM orders"""


def _nodes(t):
    k = F.col("o_orderkey")
    return t.orders.select(F.col("o_custkey").cast("string").alias("doc_id"), F.concat(F.lit("o"), (k % 9).cast("string")).alias("id"), F.array(k.cast("int")).alias("path"), F.when(k % 4 == 0, "part").when(k % 4 == 1, "block_quote").otherwise("section").alias("kind"), F.when(k % 6 == 2, "1-x!").otherwise((k % 9).cast("string")).alias("number"), F.lit("").alias("parent"))


@query(f"SELECT DISTINCT doc_id, id AS anchor FROM ({_NODES}) WHERE kind <> 'block_quote'")
def n01_known_anchors(t):
    return tree.known_anchors(_nodes(t))


@query(f"SELECT doc_id, count(*) FILTER (kind = 'section') AS leaves FROM ({_NODES}) GROUP BY 1")
def a09_leaf_count(t):
    return tree.leaf_counts(_nodes(t))


@query(f"SELECT CAST(c_custkey AS VARCHAR) AS doc_id, 'EMPTY_BODY' AS code, CAST(c_nationkey AS VARCHAR) AS message FROM customer LEFT JOIN (SELECT doc_id, count(*) FILTER (kind = 'section') AS n FROM ({_NODES}) GROUP BY 1) x ON x.doc_id = CAST(c_custkey AS VARCHAR) WHERE c_nationkey > 0 AND coalesce(n, 0) = 0")
def v04_empty_body(t):
    meta = t.customer.select(F.col("c_custkey").cast("string").alias("doc_id"), F.col("c_nationkey").alias("n_declared"))
    return tree.empty_bodies(meta, _nodes(t))


@query(f"""
SELECT doc_id, 'MALFORMED_NUMBER' AS code, number AS message FROM ({_NODES}) WHERE kind = 'section' AND number = '1-x!'
UNION ALL SELECT doc_id, 'DUPLICATE_ID', id FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, id ORDER BY pos) n FROM ({_NODES})) WHERE n > 1""")
def v02_v03_numbering(t):
    return tree.malformed_numbers(_nodes(t)).unionByName(tree.duplicate_siblings(_nodes(t)))


@query("""
WITH n AS (SELECT CAST(n_regionkey AS VARCHAR) AS doc_id, 1 AS d, n_nationkey AS a, -1 AS b, '## ' || CAST(n_nationkey AS VARCHAR) || '. ' || n_name || ' <span id="n' || CAST(n_nationkey AS VARCHAR) || '" />' AS line FROM nation
 UNION ALL SELECT CAST(n_regionkey AS VARCHAR), 2, n_nationkey, s_suppkey, '### (' || CAST(s_suppkey AS VARCHAR) || ') ' || s_name || ' <span id="s' || CAST(s_suppkey AS VARCHAR) || '" />' FROM supplier JOIN nation ON n_nationkey = s_nationkey)
SELECT doc_id, string_agg(line, chr(10) || chr(10) ORDER BY a, b) AS markdown FROM n GROUP BY 1""")
def n06_tree_render(t):
    a = t.nation.select(F.col("n_regionkey").cast("string").alias("doc_id"), F.array(F.col("n_nationkey").cast("int")).alias("path"), F.lit("section").alias("kind"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("id"), F.col("n_nationkey").cast("string").alias("number"), F.col("n_name").alias("heading"))
    up = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").cast("string").alias("doc_id"))
    b = t.supplier.join(up, "s_nationkey").select("doc_id", F.array(F.col("s_nationkey").cast("int"), F.col("s_suppkey").cast("int")).alias("path"), F.lit("subsection").alias("kind"), F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_suppkey").cast("string").alias("number"), F.col("s_name").alias("heading"))
    nodes = a.unionByName(b).withColumns({"text": F.lit(None).cast("string"), "status": F.lit(None).cast("string")})
    return tree.rendered(tree.block_lines(nodes))


@query("""
SELECT doc_id, text, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY p) AS INTEGER) AS rank FROM (SELECT CAST(conv_id AS VARCHAR) AS doc_id, text, min(turn) AS p FROM conversations WHERE role = 'user' AND trim(text, ' ') <> '' GROUP BY 1, 2)""")
def n09_terms(t):
    runs = t.conversations.select(F.col("conv_id").cast("string").alias("doc_id"), "text", F.array(F.col("turn").cast("int")).alias("path"), F.when(F.col("role") == "user", "term").otherwise("text").alias("kind"))
    return tree.terms(runs).select("doc_id", "text", "rank")


@query("""
WITH u AS (SELECT user_id AS doc_id, event_type AS ref, CAST(event_id % 4 AS VARCHAR) AS anchor, min(event_id) AS p FROM events GROUP BY 1, 2, 3), g AS (SELECT doc_id, ref, min(p) AS f, string_agg(anchor, ',' ORDER BY p) AS anchors FROM u GROUP BY 1, 2)
SELECT doc_id, ref, anchors, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY f) AS INTEGER) AS number FROM g""")
def n04_footnotes(t):
    marks = t.events.select(F.col("user_id").alias("doc_id"), F.col("event_type").alias("ref"), (F.col("event_id") % 4).cast("string").alias("anchor"), F.array("event_id").alias("path"))
    return tree.footnotes(marks).select("doc_id", "ref", F.array_join("anchors", ",").alias("anchors"), "number")


@query("""
SELECT CAST(s_nationkey AS VARCHAR) AS doc_id, s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'E' ELSE r_name END AS extent FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""")
def j23_inherited_extent(t):
    up = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").cast("string").alias("doc_id"), F.array(F.lit(0)).alias("path"), F.col("r_name").alias("extent"))
    own = t.supplier.select(F.col("s_nationkey").cast("string").alias("doc_id"), F.array(F.lit(0), F.col("s_suppkey").cast("int")).alias("path"), F.when(F.col("s_suppkey") % 3 == 0, "E").otherwise("").alias("extent"))
    return tree.inherited_extent(up.unionByName(own)).filter(F.size("path") == 2).select("doc_id", F.get("path", F.lit(1)).cast("long").alias("s_suppkey"), "extent")


# ---------------------------------------------------------------- layout


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, CAST(sum(n) OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_linenumber, l_partkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cluster FROM (
 SELECT *, CASE WHEN l_quantity - lag(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_linenumber, l_partkey) > 14 THEN 1 WHEN lag(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_linenumber, l_partkey) IS NULL THEN 1 ELSE 0 END AS n FROM lineitem)""")
def w06_note_clusters(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", F.struct("l_linenumber", "l_partkey").alias("tie"))
    return layout.gap_clusters(rows, ["l_orderkey"], "l_quantity", "tie", 14).select("l_orderkey", "l_linenumber", "l_partkey", "cluster")


@query("""
WITH RECURSIVE r AS (SELECT l_orderkey, CAST(l_quantity AS DOUBLE) AS y, l_linenumber * 1000000 + l_partkey AS tie, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_linenumber * 1000000 + l_partkey) AS n FROM lineitem),
c AS (SELECT l_orderkey, n, tie, y AS top, 1 AS cluster FROM r WHERE n = 1
 UNION ALL SELECT r.l_orderkey, r.n, r.tie, CASE WHEN r.y - c.top > 4 THEN r.y ELSE c.top END, CASE WHEN r.y - c.top > 4 THEN c.cluster + 1 ELSE c.cluster END FROM c JOIN r ON r.l_orderkey = c.l_orderkey AND r.n = c.n + 1)
SELECT l_orderkey, tie, CAST(cluster AS INTEGER) AS cluster FROM c""")
def w05_row_clusters(t):
    rows = t.lineitem.select("l_orderkey", "l_quantity", (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("tie"))
    return layout.start_clusters(rows, ["l_orderkey"], "l_quantity", "tie", 4)


@query("""
WITH RECURSIVE r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY top, x0 DESC, bottom, x1, text) AS n FROM (
 SELECT l_orderkey, CAST(l_quantity AS DOUBLE) AS top, CAST(l_quantity AS DOUBLE) + 2 AS bottom, CAST(l_linenumber AS DOUBLE) AS x0, CAST(l_linenumber + 1 AS DOUBLE) AS x1, l_returnflag AS text FROM lineitem)),
c AS (SELECT l_orderkey, n, 1 AS b, top, bottom, x0, x1, text FROM r WHERE n = 1
 UNION ALL SELECT r.l_orderkey, r.n, CASE WHEN m THEN b ELSE b + 1 END, CASE WHEN m THEN least(q.top, r.top) ELSE r.top END, CASE WHEN m THEN greatest(q.bottom, r.bottom) ELSE r.bottom END,
  CASE WHEN m THEN least(q.x0, r.x0) ELSE r.x0 END, CASE WHEN m THEN greatest(q.x1, r.x1) ELSE r.x1 END, CASE WHEN m THEN q.text || ' ' || r.text ELSE r.text END
 FROM (SELECT c.*, r2.n AS next, abs(r2.top - c.top) <= 3 AND abs(r2.bottom - c.bottom) <= 3 AS m FROM c JOIN r r2 ON r2.l_orderkey = c.l_orderkey AND r2.n = c.n + 1) q JOIN r ON r.l_orderkey = q.l_orderkey AND r.n = q.next)
SELECT l_orderkey, top, bottom, x0, x1, text FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, b ORDER BY n DESC) AS last FROM c) WHERE last = 1""")
def w07_merged_boxes(t):
    rows = t.lineitem.select("l_orderkey", F.col("l_quantity").alias("top"), (F.col("l_quantity") + 2).alias("bottom"), F.col("l_linenumber").cast("double").alias("x0"), (F.col("l_linenumber") + 1).cast("double").alias("x1"), F.col("l_returnflag").alias("text"))
    return layout.merged_boxes(rows, ["l_orderkey"], 3)


@query("""
SELECT n.l_orderkey, n.note_id, (SELECT min(r.l_quantity) FROM lineitem r WHERE r.l_orderkey = n.l_orderkey AND r.l_linestatus = 'O' AND r.l_quantity >= n.l_quantity - 4) AS at
FROM (SELECT l_orderkey, l_linenumber * 1000000 + l_partkey AS note_id, l_quantity FROM lineitem WHERE l_linestatus = 'F') n""")
def j22_notes_at_rows(t):
    note = t.lineitem.filter("l_linestatus = 'F'").select("l_orderkey", (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("note_id"), F.col("l_quantity").alias("note_y"))
    rows = t.lineitem.filter("l_linestatus = 'O'").select("l_orderkey", F.col("l_quantity").alias("row_y"))
    return layout.notes_at_rows(note, rows, ["l_orderkey"])


@query("""
SELECT l_orderkey, l_quantity, n FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, f, l_quantity) r FROM (
 SELECT l_orderkey, l_quantity, count(*) AS n, min(l_linenumber * 1000000 + l_partkey) AS f FROM lineitem GROUP BY 1, 2)) WHERE r = 1""")
def a08_commonest(t):
    return layout.commonest(t.lineitem.withColumn("pos", F.col("l_linenumber") * 1000000 + F.col("l_partkey")), ["l_orderkey"], "l_quantity", "pos")


@query("SELECT l_orderkey, string_agg(l_returnflag, ' ' ORDER BY l_partkey DESC, l_returnflag) AS text FROM lineitem GROUP BY 1")
def w09_row_text(t):
    return layout.row_text(t.lineitem.select("l_orderkey", F.col("l_partkey").alias("x"), F.col("l_returnflag").alias("text")), ["l_orderkey"])


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity < 50 * 0.18 OR l_quantity > 50 * 0.82 AS margin FROM lineitem")
def m03_zones(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", layout.zoned(F.col("l_quantity"), F.lit(50)).alias("margin"))


# ---------------------------------------------------------------- facets


@query("""
SELECT 'lang' AS facet, coalesce(nullif(lang, ''), 'Other') AS value, count(*) AS n FROM documents GROUP BY 2
UNION ALL SELECT 'source', coalesce(nullif(source, ''), 'Other'), count(*) FROM documents GROUP BY 2""")
def a12_facets(t):
    return facets.facet_counts(t.documents.select("lang", "source"), ["lang", "source"])


@query("""
SELECT s_suppkey, CASE s_suppkey % 4 WHEN 1 THEN 'Justice' WHEN 2 THEN 'Finance' WHEN 3 THEN 'Finance' END AS minister FROM supplier""")
def j20_first_mapped(t):
    ids = F.expr("CASE s_suppkey % 4 WHEN 0 THEN array(9) WHEN 1 THEN array(9, 1, 2) WHEN 2 THEN array(2, 1) ELSE array(2) END")
    return t.supplier.select("s_suppkey", facets.first_mapped(ids, {1: "Justice", 2: "Finance"}).alias("minister"))


@query("SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'england' ELSE 'israel' END AS country, CASE WHEN page_id % 3 = 0 THEN '/laws/uk/' || CAST(page_id AS VARCHAR) ELSE '/laws/' || CAST(page_id AS VARCHAR) END AS old FROM pages")
def r39_r40_paths(t):
    path = F.concat(F.when(F.col("page_id") % 3 == 0, "/laws/uk/").otherwise("/laws/israel/"), F.col("page_id").cast("string"))
    return t.pages.select("page_id", facets.country_of(path, {"/laws/uk/": "england"}, "israel").alias("country"), facets.redirect(path).alias("old"))


@query("SELECT doc_id, CASE WHEN length(lang) = 0 THEN source WHEN length(source) = 0 OR levenshtein(lang, source) <= 3 THEN lang ELSE lang || ' [?]' END AS line FROM documents")
def e04_agreement(t):
    return t.documents.select("doc_id", models.agreed(F.col("lang"), F.col("source")).alias("line"))


@query("""
SELECT d.doc_id, b.title, CAST(i AS INTEGER) AS pos FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 3 + 1, 1))) AS i FROM (SELECT doc_id, string_split(trim(regexp_replace(regexp_replace(text, '["'']', '', 'g'), '\\s+', ' ', 'g')), ' ') AS w FROM documents)) d
JOIN (SELECT DISTINCT array_to_string(list_slice(string_split(trim(regexp_replace(regexp_replace(text, '["'']', '', 'g'), '\\s+', ' ', 'g')), ' '), 1, 3), ' ') AS title FROM benchmark) b ON b.title = array_to_string(list_slice(d.w, i + 1, i + 3), ' ')""")
def e02_found_titles(t):
    head = F.array_join(F.slice(F.split(T.title_key(F.col("text")), " "), 1, 3), " ")
    return models.found_titles(t.documents, t.benchmark.select(head.alias("title")), 3)
