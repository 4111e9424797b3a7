"""Queries of whole documents: footers, frontmatter, rendering, layout, chains, and the predicates of catalogs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.functions import footers
from lexforge.functions import text as T
from lexforge.operators import chains, facets, layout, lines, links, manifest, models, render
from lexforge.plans.catalog import query
from lexforge.sources import clml, sinks

# ---------------------------------------------------------------- catalogs

_ORDERS = "SELECT o_orderkey AS pos, o_custkey AS bill_id, o_orderkey % 3 + 8 AS group_type, CASE o_orderkey % 4 WHEN 0 THEN 'pdf' WHEN 1 THEN 'PDF' WHEN 2 THEN 'doc' END AS application, CAST(o_orderdate AS VARCHAR)[1:10] AS updated, CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN '//fs.example/' || o_orderkey ELSE '/p/' || o_orderkey END AS file_path FROM orders"


def _papers(t):
    k = F.col("o_orderkey")
    path = F.when(k % 5 == 0, "").when(k % 5 == 1, F.concat(F.lit("//fs.example/"), k.cast("string"))).otherwise(F.concat(F.lit("/p/"), k.cast("string")))
    kind = F.when(k % 4 == 0, "pdf").when(k % 4 == 1, "PDF").when(k % 4 == 2, "doc")
    return t.orders.select(k.alias("pos"), F.col("o_custkey").alias("bill_id"), (k % 3 + 8).alias("group_type"), kind.alias("application"), F.substring(F.col("o_orderdate").cast("string"), 1, 10).alias("updated"), path.alias("file_path"))


@query(f"""
WITH d AS (SELECT *, row_number() OVER (PARTITION BY bill_id ORDER BY coalesce(updated, '') DESC, pos) AS n FROM ({_ORDERS}) WHERE group_type = 9 AND upper(coalesce(application, '')) = 'PDF')
SELECT c_custkey AS bill_id, CASE WHEN file_path LIKE '//%' THEN 'https:' || file_path WHEN file_path <> '' THEN 'https://host.example' || file_path END AS pdf_url FROM customer LEFT JOIN (SELECT * FROM d WHERE n = 1) ON bill_id = c_custkey""")
def j06_published_urls(t):
    return chains.published_urls(t.customer.select(F.col("c_custkey").alias("bill_id")), _papers(t), "https://host.example").select("bill_id", "pdf_url")


@query(f"SELECT pos, 'gazette' AS kept FROM ({_ORDERS}) WHERE group_type = 9 AND application IN ('pdf', 'PDF') UNION ALL SELECT o_orderkey, 'valid' FROM orders WHERE o_orderkey % 7 = 3 UNION ALL SELECT o_orderkey, 'binding' FROM orders WHERE o_orderkey % 7 = 4")
def f04_f05_predicates(t):
    kinds = t.orders.select(F.col("o_orderkey").alias("pos"), (F.lit(6076) + F.col("o_orderkey") % 7).alias("validity"), (F.lit(6008) + F.col("o_orderkey") % 7).alias("type"))
    parts = {"gazette": chains.gazette_documents(_papers(t)), "valid": chains.valid_laws(kinds), "binding": chains.binding_of_type(kinds)}
    return reduce(DataFrame.unionByName, (df.select("pos", F.lit(k).alias("kept")) for k, df in parts.items()))


@query("SELECT page_id FROM pages WHERE page_id % 3 = 1 UNION ALL SELECT -page_id FROM pages WHERE page_id % 3 = 1 AND page_id % 2 = 0")
def f08_fetched(t):
    rows = t.pages.select("page_id", F.when(F.col("page_id") % 3 == 1, "fetched").otherwise("pdf_only").alias("status"), F.when(F.col("page_id") % 2 == 0, "even").otherwise("odd").alias("slug"))
    return chains.fetched(rows).select("page_id").unionByName(chains.fetched(rows, "even").select((-F.col("page_id")).alias("page_id")))


@query("""
SELECT l_orderkey AS law_id, string_agg(CAST(l_suppkey AS VARCHAR), ',' ORDER BY l_linenumber, l_suppkey) AS ministries FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 = 0 THEN NULL WHEN l_linenumber % 3 = 1 THEN 0 ELSE l_suppkey END AS l_suppkey FROM lineitem) WHERE coalesce(l_suppkey, 0) <> 0 AND l_orderkey <> 0 GROUP BY 1""")
def a03_ministries(t):
    n = F.col("l_linenumber")
    rows = t.lineitem.select(F.col("l_orderkey").alias("law_id"), n.alias("pos"), F.when(n % 3 == 1, 0).when(n % 3 == 2, F.col("l_suppkey")).alias("ministry_id"))
    return chains.ministry_lists(rows).select("law_id", F.array_join(F.transform("ministry_ids", lambda x: x.cast("string")), ",").alias("ministries"))


@query("SELECT doc_id, 'cached' AS state FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'fetch' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def j19_cached(t):
    known, ask = chains.uncached(t.documents.select("doc_id"), t.labels.select("doc_id"), "doc_id")
    return known.select("doc_id", F.lit("cached").alias("state")).unionByName(ask.select("doc_id", F.lit("fetch").alias("state")))


@query("SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN d.lang WHEN l.toxic = 1 THEN 'failed' END AS lang, l.quality AS quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def c05_merged(t):
    states = t.labels.select("doc_id", F.when(F.col("toxic") == 1, "failed").alias("lang"), "quality")
    return chains.merged(t.documents.select("doc_id", "lang"), states, "doc_id")


@query("SELECT n_done, n_selected, CASE WHEN n_done = n_selected THEN 0 ELSE 2 END AS code FROM (SELECT (SELECT count(*) FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)) AS n_done, (SELECT count(*) FROM documents) AS n_selected)")
def a15_outcome(t):
    return chains.outcome(t.documents, t.labels)


@query("SELECT conv_id AS doc_id, count(*) AS pages, coalesce(sum(length(text)), 0)::BIGINT AS characters FROM conversations GROUP BY 1")
def a16_recognised(t):
    return chains.recognised(t.conversations.withColumnRenamed("conv_id", "doc_id"))


@query("SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels")
def k03_both_done(t):
    return chains.both_done(t.documents, t.labels)


@query("SELECT doc_id, count(*) FILTER (i) AS n_internal, count(*) FILTER (NOT i) AS n_external FROM (SELECT user_id AS doc_id, event_id % 3 = 0 AS i FROM events) GROUP BY 1")
def a13_reference_counts(t):
    return links.reference_counts(t.events.select(F.col("user_id").alias("doc_id"), (F.col("event_id") % 3 == 0).alias("is_internal")))


@query("SELECT doc_id, lang, coalesce(n, 0) AS n FROM documents LEFT JOIN (SELECT lang AS l, count(*) AS n FROM documents WHERE doc_id % 2 = 0 GROUP BY 1) ON l = lang")
def j21_items_with_facets(t):
    counts = facets.facet_counts(t.documents.filter("doc_id % 2 = 0").select("lang"), ["lang"]).select(F.col("value").alias("lang"), "n")
    return facets.with_facets(t.documents.select("doc_id", "lang"), counts, "lang", n=0)


# ---------------------------------------------------------------- documents as text

_URL = "'https://fs.example/a$1-' || CAST(doc_id AS VARCHAR) || '.pdf'"
_LINK = f"'{footers.ICON}(' || u || ') [{footers.SOURCE}](' || u || ')'"
_HEAD = "'---' || chr(10) || 'title_he: \"חוק \"' || chr(10) || CASE WHEN m = 0 THEN '' ELSE 'source_pdf: ' || u || chr(10) END || '---' || chr(10) || replace(text, chr(92), '/') || 'x'"
_FOOTED = f"""SELECT doc_id, u, m, h, CASE m WHEN 1 THEN h || chr(10) || {_LINK} WHEN 2 THEN h || chr(10) || '[{footers.SOURCE}](https://old.example)' WHEN 3 THEN h || chr(10) || '---' || chr(10) || chr(10) || '{footers.SOURCE}'
 WHEN 4 THEN h || ' {footers.SOURCE} ' WHEN 5 THEN h || chr(10) || '## Sidenotes' || chr(10) || '- x' ELSE h END AS md FROM (SELECT *, {_HEAD} AS h FROM (SELECT doc_id, text, doc_id % 7 AS m, {_URL} AS u FROM documents))"""


def _sql(t, text: str) -> DataFrame:
    """SQL over documents that both engines read alike."""
    return t.spark.sql(text.replace("VARCHAR", "STRING").replace("FROM documents", "FROM {documents}"), documents=t.documents)


@query(f"""
SELECT doc_id, CASE m WHEN 0 THEN 'skip (no source_pdf)' WHEN 1 THEN 'ok (already new format)' WHEN 2 THEN 'fixed (old link → new format)' WHEN 3 THEN 'fixed (plain text → new format)' WHEN 4 THEN 'fixed (plain text → new format)' ELSE 'fixed (missing → added)' END AS status,
 CASE m WHEN 0 THEN md WHEN 1 THEN md WHEN 2 THEN h || chr(10) || {_LINK} WHEN 3 THEN h || chr(10) || '---' || chr(10) || chr(10) || {_LINK} WHEN 4 THEN h || ' ' || {_LINK} || ' '
 WHEN 5 THEN h || chr(10) || chr(10) || '---' || chr(10) || chr(10) || {_LINK} || chr(10) || chr(10) || '## Sidenotes' || chr(10) || '- x' ELSE h || chr(10) || chr(10) || '---' || chr(10) || chr(10) || {_LINK} || chr(10) END AS text
FROM ({_FOOTED})""")
def r28_footer_repair(t):
    return _sql(t, _FOOTED).select("doc_id", footers.repaired_footer(F.col("md")).alias("x")).select("doc_id", "x.status", "x.text")


@query(f"""
SELECT doc_id, CASE WHEN m = 0 THEN h ELSE h || chr(10) || chr(10) || '---' || chr(10) || chr(10) || {_LINK} || chr(10) END AS footed, h AS bare FROM ({_FOOTED})""")
def r26_r27_footers(t):
    footed = footers.with_footer(F.concat(F.col("h"), F.when(F.col("m") == 3, "\n \n").otherwise("")), F.when(F.col("m") > 0, F.col("u")))
    whole = F.concat(F.col("h"), F.lit(f"\n\n---\n[{footers.SOURCE}](u)\nmore\n\n## Sidenotes\n- x"))
    rows = _sql(t, _FOOTED)
    return rows.select("doc_id", F.when(F.col("m") == 0, F.col("h")).otherwise(footed).alias("footed"), footers.without_footer(whole).alias("bare"))


@query("""
SELECT doc_id, CASE m WHEN 0 THEN 'ok (already has description)' WHEN 1 THEN 'skip (no title_he)' ELSE 'fixed' END AS status, CASE m WHEN 0 THEN h || 'description: x' || chr(10) || b WHEN 1 THEN 'title: "t"' || chr(10) || b
 WHEN 2 THEN 'title: "t"' || chr(10) || h || 'description: "חוק (2001) — בתוקף. Full"' || chr(10) || d || b ELSE h || 'title: "חוק"' || chr(10) || 'description: "חוק (2001) — בתוקף. Full"' || chr(10) || d || b END AS text
FROM (SELECT doc_id, doc_id % 4 AS m, 'title_he: "חוק"' || chr(10) AS h, 'publication_date: 2001-02-03' || chr(10) || 'law_validity: "בתוקף"' || chr(10) AS d, '---' || chr(10) || text AS b FROM documents)""")
def r29_described(t):
    h, d, b = F.lit('title_he: "חוק"\n'), F.lit('publication_date: 2001-02-03\nlaw_validity: "בתוקף"\n'), F.concat(F.lit("---\n"), "text")
    m = F.col("doc_id") % 4
    md = F.when(m == 0, F.concat(h, F.lit("description: x\n"), b)).when(m == 1, F.concat(F.lit('title: "t"\n'), b)).when(m == 2, F.concat(F.lit('title: "t"\n'), h, d, b)).otherwise(F.concat(h, d, b))
    return t.documents.select("doc_id", md.alias("md")).select("doc_id", footers.described(F.col("md"), "Full").alias("x")).select("doc_id", "x.status", "x.text")


@query("SELECT doc_id, rtrim(text, ' ' || chr(10)) || chr(10) || chr(10) || 'tail' || chr(10) AS text, lang || chr(10) || source AS rest FROM documents")
def r30_tails(t):
    md = F.concat("text", F.lit("\n# 527. cut\nmore"))
    rest = F.concat(F.lit("one\ntwo\n"), "lang", F.lit("\n"), "source", F.lit("\n"))
    return t.documents.select("doc_id", footers.tail_repaired(md, "# 527.", F.lit("tail")).alias("text"), footers.lines_from(rest, 3).alias("rest"))


@query("""
SELECT o_orderkey, concat_ws(chr(10), '---', CASE WHEN o_orderkey % 3 = 0 THEN 'bill_id: ' || o_custkey ELSE 'law_id: ' || o_orderkey END, 'title: "' || t || '"', 'title_he: "' || t || '"', 'sidebar_label: "' || t || '"',
 'description: "' || t || CASE WHEN d = '' THEN '' ELSE ' (' || substr(d, 1, 4) || ')' END || ' — ' || coalesce(v, 'תקף') || '. Full"', 'hide_table_of_contents: true', 'publication_date: ' || CASE WHEN d = '' THEN '~' ELSE d END,
 CASE WHEN o_orderkey % 2 = 0 THEN 'latest_publication_date: 2020-01-01' END, CASE WHEN o_orderkey % 4 = 0 THEN 'is_basic_law: true' END, CASE WHEN o_orderkey % 4 = 1 THEN 'is_budget_law: true' END,
 CASE WHEN v IS NOT NULL THEN 'law_validity: "' || v || '"' END, CASE WHEN o_orderkey % 6 > 0 THEN 'category: c' || o_orderkey % 6 END, CASE WHEN o_orderkey % 3 = 1 THEN 'law_tags:' || chr(10) || '  - "a"' || chr(10) || '  - "' || o_orderpriority || '"' END,
 CASE WHEN o_orderkey % 3 = 2 THEN 'ministry_ids: [1, ' || o_custkey || ']' END, 'source_pdf: ' || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'u' || o_orderkey END, 'generated_by: lexforge', 'model: m', 'generated_at: now', '---', '') AS block
FROM (SELECT *, 'חוק \\"' || o_orderkey || '\\"' AS t, CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d, CASE WHEN o_orderkey % 7 > 0 THEN 'ok' END AS v FROM orders)""")
def r10_law_frontmatter(t):
    k = F.col("o_orderkey")
    day = F.when(k % 11 > 0, F.col("o_orderdate").cast("string"))
    entry = {
        "law_id": F.when(k % 3 > 0, k), "bill_id": F.col("o_custkey"), "name_he": F.concat(F.lit('חוק "'), k.cast("string"), F.lit('", התשנ"ו-1996')), "publication_date": day,
        "latest_publication_date": F.when(k % 2 == 0, "2020-01-01T00:00").otherwise(day), "is_basic_law": k % 4 == 0, "is_budget_law": k % 4 == 1, "law_validity": F.when(k % 7 > 0, "ok"), "category": F.when(k % 6 > 0, F.concat(F.lit("c"), (k % 6).cast("string"))).otherwise(""),
        "tags": F.when(k % 3 == 1, F.array(F.lit("a"), F.lit(""), F.col("o_orderpriority"))).otherwise(F.array(F.lit(""))), "ministry_ids": F.when(k % 3 == 2, F.array(F.lit(1).cast("long"), F.col("o_custkey"))), "pdf_url": F.when(k % 3 > 0, F.concat(F.lit("u"), k.cast("string"))),
    }
    return t.orders.select("o_orderkey", footers.law_frontmatter(entry, "Full", "lexforge", "m", F.lit("now")).alias("block"))


@query("""
SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'basic-laws' WHEN 1 THEN 'basic-laws' ELSE 'civil-law' END AS category, CASE WHEN doc_id % 2 = 0 THEN 'התשנ"ו' END AS year,
 CASE doc_id % 3 WHEN 0 THEN '12 (א) ' || lang WHEN 1 THEN 'גוף 5. כאן' ELSE 'הערה אחת.  7 כאן' END AS line, '[1, ' || doc_id || ']' AS ids, CASE WHEN doc_id % 2 = 0 THEN 'd' || doc_id ELSE 'now' END AS as_at FROM documents""")
def r34_r36_r37_titles(t):
    m = F.col("doc_id") % 3
    name = F.when(m == 0, " חוק-יסוד: הכנסת").when(m == 1, "חוק יסוד: הממשלה").otherwise("חוק העונשין")
    notes = F.array(F.lit("* ראה"), F.when(F.col("doc_id") % 2 == 0, 'נתקבל בכנסת ביום התשנ"ו ופורסם התשנ"ז').otherwise("אין"))
    phrases = F.array(F.lit("הערת"), F.lit("הערת שוליים"))
    line = F.when(m == 0, F.concat(F.lit(" הערת שוליים - מטרה 12 (א) "), "lang")).when(m == 1, "הערת, גוף 5. כאן").otherwise("הערה אחת.  7 כאן")
    shown = F.when(m == 1, F.concat(F.lit("גוף 5. כאן"))).otherwise(T.without_margin_prefix(line, phrases))
    return t.documents.select("doc_id", T.title_category(name).alias("category"), T.hebrew_year(notes).alias("year"), shown.alias("line"), footers.id_list(F.array(F.lit(1).cast("long"), F.col("doc_id"))).alias("ids"), footers.as_at(F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("d"), F.col("doc_id").cast("string"))).otherwise(""), F.lit("now")).alias("as_at"))


@query("SELECT doc_id, 'a [t](./' || doc_id + 1 || '.md) [u](https://fs.example/none.pdf) ' || text AS text, 1 AS n_upgraded FROM documents WHERE doc_id + 1 IN (SELECT doc_id FROM documents) UNION ALL SELECT doc_id, 'a [t](https://fs.example/' || doc_id + 1 || '.pdf) [u](https://fs.example/none.pdf) ' || text, 0 FROM documents WHERE doc_id + 1 NOT IN (SELECT doc_id FROM documents)")
def r23_upgraded_pdf_links(t):
    laws = t.documents.select(F.col("doc_id").alias("law_id"), F.col("doc_id").alias("pos"), F.concat(F.lit("https://fs.example/"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("pdf_url"))
    text = F.concat(F.lit("a [t](https://fs.example/"), (F.col("doc_id") + 1).cast("string"), F.lit(".pdf) [u](https://fs.example/none.pdf) "), "text")
    return links.with_upgraded_links(t.documents.select("doc_id", text.alias("text")), links.pdf_index(laws, laws), r"fs\.example")


@query("SELECT doc_id, regexp_replace(text, 'th', CASE WHEN doc_id % 2 = 0 THEN 'x [th](./a.md)' ELSE 'x th' END, 'g') AS text FROM documents")
def r24_unlinked(t):
    """Links to numbered files and to a host become plain words again, one within another too; other links stay."""
    both = F.regexp_replace("text", "th", "x [[th](./12.md)](https://fs.example/a.pdf)")
    other = F.regexp_replace("text", "th", "x [th](./a.md)")
    return t.documents.select("doc_id", lines.unlinked(F.when(F.col("doc_id") % 2 == 0, other).otherwise(both), r"fs\.example").alias("text"))


# ---------------------------------------------------------------- legislation

_WORDS = "regexp_replace(text, '[^A-Za-z ]', '', 'g')"


def _acts(t):
    """(doc_id, content): an act for each benchmark item, with a change, a repeal, a term, citations and a schedule."""
    i = F.col("item_id")
    s = lambda c: (F.lit(c) if isinstance(c, int) else c).cast("string")
    words = F.regexp_replace("text", "[^A-Za-z ]", "")
    head = F.concat(F.lit('<Legislation xmlns="urn:l" NumberOfProvisions="2" RestrictExtent="E+W"><Metadata><title>Act '), s(i), F.lit('</title><Year Value="'), s(1900 + i), F.lit('"/></Metadata><Primary><PrimaryPreamble><IntroductoryText>Be it {so}</IntroductoryText></PrimaryPreamble><Body>'))
    cite = lambda year, n, ref: F.concat(F.lit('<Citation URI="http://leg.example/id/ukpga/'), s(year), F.lit("/"), s(n), F.lit('" SectionRef="'), F.lit(ref), F.lit('">that Act</Citation>'))
    body = F.concat(F.lit('<P1group RestrictExtent="S"><Title>Start</Title><P1 id="section-1"><Pnumber>1</Pnumber><P1para><Text>'), words, F.lit(' <Term>Zeta</Term> <Addition CommentaryRef="c1">new <Term>x</Term></Addition> '), cite(1900 + i + 1, i + 1, "section-1"), F.lit(" "), cite(1900 + i + 1, i + 1, "section-9"), F.lit(" "), cite(i, 1, "s"), F.lit(" "), cite(1900 + i, i, "none"), F.lit('</Text><P2 id="section-1-1"><Pnumber>1</Pnumber><P2para><Text>Sub <Repeal CommentaryRef="c2">gone</Repeal> <Term>alpha</Term>.</Text></P2para></P2><Text>After.</Text></P1para></P1></P1group></Body>'))
    rest = F.concat(F.lit('<Schedules><Schedule id="schedule-1"><Number>SCHEDULE 1</Number><TitleBlock><Title>More</Title></TitleBlock><Reference>Section 1</Reference><ScheduleBody><P1 id="schedule-1-paragraph-1" shortId="p1"><Pnumber>1</Pnumber><P1para><Text>List:</Text><UnorderedList><ListItem><Para><Text>one</Text></Para></ListItem></UnorderedList></P1para></P1></ScheduleBody></Schedule></Schedules></Primary><Commentaries><Commentary id="c1" Type="F"><Para><Text>Words in '), cite(1900 + i, i, "section-1"), F.lit('</Text></Para></Commentary><Commentary id="c3" Type="M"><Para><Text>Loose note</Text></Para></Commentary></Commentaries></Legislation>'))
    return t.benchmark.select(i.alias("doc_id"), F.concat(head, body, rest).alias("content"))


def _slugs(t):
    return t.benchmark.select(F.col("item_id").alias("doc_id"), F.concat_ws("-", F.lit("ukpga"), (1900 + F.col("item_id")).cast("string"), F.col("item_id").cast("string")).alias("slug"))


_NEXT = "EXISTS (SELECT 1 FROM benchmark n WHERE n.item_id = b.item_id + 1)"
_AIM = "'https://leg.example/ukpga/' || 1900 + item_id + 1 || '/' || item_id + 1"
_ACT = f"""
SELECT item_id AS doc_id, concat_ws(chr(10), '---', 'title: "Act ' || item_id || '"', 'long_title: ""', 'year: ' || 1900 + item_id, 'chapter: ~', 'enactment_date: ~', 'document_main_type: ~', 'document_status: ~', 'valid_date: ~', 'as_at: "now"', 'extent: E+W', 'number_of_provisions: 2', 'unapplied_effects_count: 0', 'publisher: ~', 'jurisdiction: uk', 'generated_by: lexforge', 'retrieved_at: now', '---', '')
 || 'Be it \\{{so\\}}' || chr(10) || chr(10) || '# 1. Start <span id="section-1" />' || chr(10) || chr(10) || '> [Extent — 1. Start] S' || chr(10) || chr(10)
 || trim(w || ' Zeta [new x][^fc1] ' || CASE WHEN {_NEXT} THEN '[that Act](./ukpga-' || 1900 + item_id + 1 || '-' || item_id + 1 || '.md#section-1) [that Act](./ukpga-' || 1900 + item_id + 1 || '-' || item_id + 1 || '.md)' ELSE '[that Act](' || {_AIM} || ') [that Act](' || {_AIM} || ')' END || ' [that Act](https://leg.example/ukpga/' || item_id || '/1) that Act') || chr(10) || chr(10)
 || '## (1) <span id="section-1-1" />' || chr(10) || chr(10) || 'Sub . . . . . .[^fc2] alpha.' || chr(10) || chr(10) || 'After.' || chr(10) || chr(10)
 || '# SCHEDULE 1 — More <span id="schedule-1" />' || chr(10) || chr(10) || '> [Enabled by — Section 1]' || chr(10) || chr(10) || '## 1. <span id="p1" />' || chr(10) || chr(10) || 'List:' || chr(10) || '- one' || chr(10) || chr(10)
 || '## Defined Terms' || chr(10) || chr(10) || '- alpha' || chr(10) || '- Zeta' || chr(10) || chr(10)
 || '## Editorial Notes' || chr(10) || chr(10) || 'Notes recorded by the source publisher and not tied to a specific inline amendment marker above:' || chr(10) || chr(10) || '- Loose note' || chr(10) || chr(10)
 || '---' || chr(10) || chr(10) || '[^fc1]: [section-1](#section-1): Words in [that Act](#section-1)' || chr(10) || '[^fc2]: [section-1-1](#section-1-1): see amending instrument (commentary c2 not found)' || chr(10) AS markdown
FROM (SELECT *, {_WORDS} AS w FROM benchmark) b"""


@query(_ACT)
def n10_rendered(t):
    return render.rendered(clml.parse(_acts(t)).cache(), _slugs(t), "now")


@query(f"""
WITH b AS (SELECT item_id, 'ukpga-' || 1900 + item_id || '-' || item_id AS slug, 'ukpga-' || 1900 + item_id + 1 || '-' || item_id + 1 AS next FROM benchmark)
SELECT slug AS src, next AS dst, 'section-1' AS anchor FROM b WHERE {_NEXT} UNION ALL SELECT slug, next, NULL FROM b WHERE {_NEXT}
UNION ALL SELECT slug, slug, 'section-1' FROM b UNION ALL SELECT slug, slug, 'section-1' FROM b UNION ALL SELECT slug, slug, 'section-1-1' FROM b""")
def n11_internal_links(t):
    return render.internal_links(clml.parse(_acts(t)).cache(), _slugs(t))


@query("SELECT item_id AS doc_id, 'ROUND_TRIP_MISSING' AS code, 'Sub gone alpha.' AS message FROM benchmark UNION ALL SELECT item_id, 'ROUND_TRIP_MISSING', 'Loose {note}' FROM benchmark WHERE item_id % 2 = 0")
def v06_validated(t):
    """Texts of the source that rendering drops or changes: a repealed one, and one that was altered afterwards."""
    rows = clml.parse(_acts(t).withColumn("content", F.replace("content", F.lit("Loose note"), F.lit("Loose {note}")))).cache()
    made = render.rendered(rows, _slugs(t), "now")
    spoilt = made.withColumn("markdown", F.when(F.col("doc_id") % 2 == 0, F.replace("markdown", F.lit("Loose"), F.lit("Lost"))).otherwise(F.col("markdown")))
    return render.validated(rows, spoilt)


@query(f"""
WITH w AS (SELECT item_id AS doc_id, trim({_WORDS}) AS w, substr(text, 1, 0) AS e FROM benchmark)
SELECT doc_id, 'term' AS kind, 'Zeta' AS text FROM w UNION ALL SELECT doc_id, 'term', 'alpha' FROM w UNION ALL SELECT doc_id, 'repeal', NULL FROM w
UNION ALL SELECT doc_id, 'open', NULL FROM w UNION ALL SELECT doc_id, 'close', NULL FROM w
UNION ALL SELECT doc_id, 'citation', 'that Act' FROM w, range(4)""")
def x01_mixed_runs(t):
    return clml.parse(_acts(t)).filter("row = 'run' and kind <> 'text'").select("doc_id", "kind", "text")


@query("SELECT item_id AS doc_id, k AS kind, p AS parent, CAST(l AS INTEGER) AS level, i AS id, n AS number, h AS heading, x AS extent FROM benchmark, (VALUES ('section', '0', 1, 'section-1', '1', 'Start', 'S'), ('subsection', '0.1', 2, 'section-1-1', '1', NULL, NULL), ('schedule', '1', 1, 'schedule-1', 'SCHEDULE 1', 'More', NULL), ('section', '1.0', 2, 'p1', '1', NULL, NULL)) v(k, p, l, i, n, h, x)")
def x05_provisions(t):
    return clml.provisions(clml.parse(_acts(t))).select("doc_id", "kind", "parent", "level", "id", "number", "heading", "extent")


# ---------------------------------------------------------------- layout


@query("""
SELECT doc_id, CAST(i AS INTEGER) AS pos, CASE i WHEN 0 THEN 'title' WHEN 1 THEN 'section_header_level_1' WHEN 2 THEN 'list_item' ELSE 'page_footer' END AS kind, CASE i WHEN 1 THEN 'a<b' || chr(10) || lang WHEN 2 THEN text ELSE lang END AS text, CAST(i AS DOUBLE) AS x0, doc_id % 500 + 0.0::DOUBLE AS y0, 30.0::DOUBLE AS x1, 40.0::DOUBLE AS y1
FROM documents, range(4) r(i)""")
def s13_elements(t):
    one = lambda kind, i, text: F.concat(F.lit(f"<{kind}><loc_{i}><loc_"), (F.col("doc_id") % 500).cast("string"), F.lit("><loc_30><loc_40>"), text, F.lit(f"</{kind}>"))
    tags = F.concat(one("title", 0, F.col("lang")), F.lit("<other>"), one("section_header_level_1", 1, F.concat(F.lit("a<b\n"), "lang")), one("list_item", 2, F.col("text")), F.lit("</x>\n"), one("page_footer", 3, F.col("lang")))
    return layout.elements(t.documents.select("doc_id", tags.alias("tags"), "lang"))


@query("""
SELECT l_orderkey AS doc_id, l_linenumber AS line, min(l_quantity)::DOUBLE AS y0, CAST(min(l_partkey) AS DOUBLE) AS x0, CAST(max(l_partkey + 5) AS DOUBLE) AS x1, round(min(l_quantity) FILTER (l_returnflag <> 'N'), 1)::DOUBLE AS size, string_agg(CASE WHEN l_returnflag = 'N' THEN ' ' ELSE l_returnflag END, '' ORDER BY l_partkey, CASE WHEN l_returnflag = 'N' THEN ' ' ELSE l_returnflag END) AS text
FROM (SELECT l_orderkey, l_linenumber % 3 AS l_linenumber, l_quantity, l_partkey, max(l_returnflag) AS l_returnflag FROM lineitem GROUP BY ALL) GROUP BY 1, 2 HAVING bool_or(l_returnflag <> 'N')""")
def s14_span_lines(t):
    some = t.lineitem.groupBy("l_orderkey", (F.col("l_linenumber") % 3).alias("line"), "l_quantity", "l_partkey").agg(F.max("l_returnflag").alias("flag"))
    spans = some.select(F.col("l_orderkey").alias("doc_id"), "line", F.col("l_partkey").alias("span"), F.col("l_partkey").cast("double").alias("x0"), F.col("l_quantity").cast("double").alias("y0"), (F.col("l_partkey") + 5).cast("double").alias("x1"), F.col("l_quantity").cast("double").alias("size"), F.when(F.col("flag") == "N", " ").otherwise(F.col("flag")).alias("text"))
    return layout.span_lines(spans, ["doc_id"])


@query()
def o09_o10_page_markdown(t):
    """Lines of orders as pages of text, small ones at the edge as margin notes."""
    rows = t.lineitem.select(F.col("l_orderkey").alias("doc_id"), F.lit(1).alias("page"), (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("line"), F.col("l_quantity").cast("double").alias("y0"), (F.col("l_partkey") % 600).cast("double").alias("x0"), (F.col("l_partkey") % 600 + 20).cast("double").alias("x1"), F.when(F.col("l_partkey") % 3 == 0, 8.0).otherwise(10.0).alias("size"), F.concat_ws("-", "l_returnflag", F.col("l_linenumber").cast("string")).alias("text"))
    return layout.page_markdown(layout.classified(rows, ["doc_id", "page"], 600.0))


@query("""
SELECT doc_id, '# ' || lang || '-two' || chr(10) || chr(10) || '## Full Text' || chr(10) || chr(10) || '5 (א) ' || lang || ' אב גד' || chr(10) || chr(10) || '## Signatures' || chr(10) || chr(10) || 'שר' || chr(10) || chr(10) || '## Margin Notes' || chr(10) || chr(10) || '- הערה' || chr(10) || chr(10) || '## Footnotes' || chr(10) || chr(10) || 'ס ' || doc_id || chr(10) || chr(10) || '<!-- page artifacts (excluded from main rendering) -->' || chr(10) || '<!-- עמוד -->' || chr(10) AS body FROM documents""")
def o08_syntax_tree(t):
    """The parts of a law from tagged layout: two titles, a section in two boxes with a margin note in front."""
    one = lambda kind, x, y, text: F.concat(F.lit(f"<{kind}><loc_{x}><loc_{y}><loc_{x + 20}><loc_{y + 8}>"), text, F.lit(f"</{kind}>"))
    parts = (one("section_header_level_1", 100, 10, F.concat("lang", F.lit("-one"))), one("list_item", 100, 51, F.lit("אב גד")), one("list_item", 300, 50, F.concat(F.lit("הערה 5 (א) "), "lang")), one("text", 450, 50, F.lit("הערה")), one("text", 450, 80, F.lit(".")), one("section_header_level_2", 100, 20, F.concat("lang", F.lit("-two"))), one("footnote", 50, 400, F.concat(F.lit("ס "), F.col("doc_id").cast("string"))), one("page_footer", 50, 480, F.lit("עמוד")), one("text", 60, 300, F.lit("שר")), one("caption", 1, 1, F.lit("x")))
    items = layout.elements(t.documents.select("doc_id", F.concat(*parts).alias("tags")))
    return layout.tree_markdown(layout.syntax_tree(items, T.clean_ocr))


# ---------------------------------------------------------------- chains


def _law(t):
    """Documents as laws: every one with a heading, a note, a reference to itself and the name of the next law."""
    nxt = (F.col("doc_id") + 1).cast("string")
    text = F.concat(F.lit("---\nlaw: x\n---\n# 1. "), "lang", F.lit("\n> הערה\nלפי סעיף 1 של חוק "), nxt, F.lit(" [p](https://fs.example/"), nxt, F.lit(".pdf)\n"))
    return t.documents.select("doc_id", text.alias("markdown"))


_RESOLVED = """SELECT doc_id, '---' || chr(10) || 'law: x' || chr(10) || '---' || chr(10) || '# 1. ' || lang || ' <span id="section-1" />' || chr(10) || '> הערה' || chr(10) || 'לפי [סעיף 1](#section-1) של חוק ' || doc_id + 1 || ' [p](' || CASE WHEN doc_id + 1 IN (SELECT doc_id FROM documents WHERE doc_id % 3 > 0) THEN './' || doc_id + 1 || '.md' ELSE 'https://fs.example/' || doc_id + 1 || '.pdf' END || ')' || chr(10) || chr(10) || '## Sidenotes' || chr(10) || chr(10) || '- [הערה](#section-1)' || chr(10) AS markdown FROM documents"""


def _catalog(t):
    return t.documents.select("doc_id", F.col("doc_id").alias("pos"), F.col("doc_id").cast("string").alias("law_id"), F.concat(F.lit("חוק "), F.col("doc_id").cast("string")).alias("name_he"), F.concat(F.lit("https://fs.example/"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("pdf_url"))


@query(_RESOLVED)
def o03_link_resolved(t):
    laws = _catalog(t)
    return chains.link_resolved(_law(t), links.pdf_index(laws, laws.filter("doc_id % 3 > 0")), r"fs\.example")


@query("""
SELECT doc_id, found, law_id, CASE WHEN i THEN './' || law_id || '.md' ELSE 'https://fs.example/' || law_id || '.pdf' END AS url, i AS is_internal FROM (
 SELECT doc_id, 'חוק ' || doc_id + 1 AS found, CAST(doc_id + 1 AS VARCHAR) AS law_id, (doc_id + 1) % 3 > 0 AS i FROM documents WHERE doc_id + 1 IN (SELECT doc_id FROM documents))""")
def o04_resolved_names(t):
    two = F.explode(F.array(*(F.struct(F.lit(p).alias("pos"), F.lit(o).alias("official")) for p, o in ((0, None), (1, "אין כזה")))))
    refs = t.documents.select("doc_id", F.concat(F.lit(" חוק "), (F.col("doc_id") + 1).cast("string")).alias("found"), two.alias("x")).select("doc_id", "found", "x.*")
    return chains.resolve(refs, _catalog(t), _catalog(t).filter("doc_id % 3 > 0")).drop("pos")


@query("""
WITH d AS (SELECT doc_id FROM documents), b AS (SELECT doc_id FROM d WHERE doc_id % 4 > 0 ORDER BY doc_id LIMIT 40), ok AS (SELECT doc_id FROM b WHERE doc_id % 5 > 0)
SELECT doc_id, 'made' AS what FROM ok UNION ALL SELECT doc_id, 'NATIVE_MISSING' FROM b WHERE doc_id % 5 = 0
UNION ALL SELECT doc_id + 1, 'queued' FROM ok WHERE doc_id + 1 IN (SELECT doc_id FROM d) AND doc_id + 1 NOT IN (SELECT doc_id FROM ok) AND (doc_id + 1) % 4 > 0""")
def o02_run_batch(t):
    """A batch of 40 laws: those without native text fail, the others name the next law, which is queued if not done."""
    have = lambda c: t.documents.filter(c).select("doc_id", F.lit("text").alias("text"))
    done = t.documents.filter("doc_id % 4 = 0").select("doc_id")
    none = t.documents.filter("false").select("doc_id")
    state = {"done": done, "failed": none, "priority": none.withColumn("prio", F.lit(0)), "deployed": t.documents.limit(1).select(F.lit(25).cast("long").alias("n"))}
    witnesses = {"native": have("doc_id % 5 > 0"), "ocr": have("true"), "layout": have("true")}
    nxt = F.regexp_extract("markdown", "חוק ([0-9]+)", 1)
    find = lambda docs: docs.select("doc_id", F.lit(0).alias("pos"), F.concat(F.lit("חוק "), F.coalesce(nxt, F.lit(""))).alias("found"), F.lit(None).cast("string").alias("official"))
    laws = _catalog(t).withColumn("pdf_path", F.lit("p"))
    native = laws.select("doc_id", F.concat(F.lit("חוק "), (F.col("doc_id") + 1).cast("string")).alias("text"))
    witnesses["native"] = native.filter("doc_id % 5 > 0")
    answer = lambda r: F.nullif(F.regexp_extract(r, "(חוק [0-9]+)", 1), F.lit(""))
    out = chains.run_batch(laws.drop("law_id"), state, witnesses, answer, find, 40, r"fs\.example")
    made = out["documents"].select(F.col("doc_id"), F.lit("made").alias("what"))
    failed = out["findings"].select("doc_id", F.col("code").alias("what"))
    return made.unionByName(failed).unionByName(out["queue"].select(F.col("doc_id").cast("long").alias("doc_id"), F.lit("queued").alias("what")))


@query(_RESOLVED)
def o05_relinked(t):
    """Documents that went through the link passes before come out the same."""
    laws = _catalog(t)
    known = links.pdf_index(laws, laws.filter("doc_id % 3 > 0"))
    return chains.relinked(chains.link_resolved(_law(t), known, r"fs\.example").cache(), known, r"fs\.example")


@query("""
SELECT doc_id, 'made' AS what, 'A ' || doc_id || chr(10) || chr(10) || '---' || chr(10) || chr(10) || '[![מסמך PDF](/img/pdf-icon.svg)](u' || doc_id || ') [מסמך המקור באתר הכנסת](u' || doc_id || ')' || chr(10) AS markdown FROM documents WHERE doc_id % 2 > 0 AND doc_id % 3 > 0 AND doc_id % 5 > 0 AND doc_id % 7 > 0
UNION ALL SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'NATIVE_MISSING' WHEN doc_id % 3 = 0 OR doc_id % 5 = 0 THEN 'OCR_MISSING' ELSE 'RECONCILE_FAILED' END, NULL FROM documents WHERE doc_id % 2 = 0 OR doc_id % 3 = 0 OR doc_id % 5 = 0 OR doc_id % 7 = 0""")
def o01_stage_chain(t):
    """Laws through their steps: some lack the native text, some their recognition or its layout, some the answer."""
    i = F.col("doc_id")
    have = lambda c: t.documents.filter(c).select("doc_id", F.concat(F.lit("A "), i.cast("string")).alias("text"))
    answer = lambda r: F.when(F.regexp_extract(r, "A ([0-9]+)", 1).try_cast("int") % 7 > 0, F.regexp_extract(r, "(A [0-9]+)", 1))
    made, lost = chains.converted(t.documents.select("doc_id", F.concat(F.lit("u"), i.cast("string")).alias("pdf_url")), have("doc_id % 2 > 0"), have("doc_id % 3 > 0"), have("doc_id % 5 > 0"), answer, "p")
    return made.select("doc_id", F.lit("made").alias("what"), "markdown").unionByName(lost.select("doc_id", F.col("code").alias("what"), F.lit(None).cast("string").alias("markdown")))


# ---------------------------------------------------------------- single functions over whole tables


@query("""
SELECT doc_id, 'חוק ' || source AS bare, 'חוק ' || source AS plain, 'חוק ' || source AS key, trim(text, ' ' || chr(10) || chr(9) || chr(13)) AS answer, 'p' || chr(10) || chr(10) || '<native>' || chr(10) || lang || chr(10) || '</native>' || chr(10) || chr(10) || '<ocr>' || chr(10) || source || chr(10) || '</ocr>' || chr(10) AS request, doc_id % 3 = 0 AS meaningful FROM documents""")
def r06_r12_strings(t):
    """Titles without year suffixes, remarks and quotes, answers without their fence, requests, texts that mean something."""
    title = F.concat(F.lit("חוק "), "source")
    fenced = F.concat(F.lit("```markdown\n"), F.trim("text", F.lit(" \n\t\r")), F.lit("\n```"))
    said = F.when(F.col("doc_id") % 3 == 0, "(א) ב").when(F.col("doc_id") % 3 == 1, "א.").otherwise("... ---")
    year = F.lit(', התשנ"ו-1996')
    return t.documents.select("doc_id", T.strip_year(F.concat(title, year)).alias("bare"), T.plain_title(F.concat(title, F.lit(" [נוסח חדש]"), year)).alias("plain"), T.title_key(F.concat(title, F.lit('"  '), year)).alias("key"), T.unfenced(fenced).alias("answer"), models.request(F.col("lang"), F.col("source"), "p").alias("request"), T.meaningful(said).alias("meaningful"))


@query("""
SELECT doc_id, regexp_replace(regexp_replace(text, '[ \\t]{2,}', ' ', 'g'), '[ \\t]+\\n', chr(10), 'g') || ' סעיף 5 (א) ב 3, (ג) ד' || chr(10) || '12. סוף [^7] א-ב' AS text FROM documents""")
def r32_clean_rtl(t):
    spoilt = F.concat("text", F.lit(" סעיף5 )א(  ,3ב )ג(ד \n.12 סוף \u00ad7 א\u00adב"))
    return t.documents.select("doc_id", T.clean_rtl(spoilt).alias("text"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'spring 199' WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day,
 CASE WHEN o_orderkey % 4 < 2 THEN o_orderkey % 4 ELSE 0 END AS n_refs, CASE WHEN o_orderkey % 4 = 1 THEN 'f' || o_orderkey END AS found FROM orders""")
def d04_c04_parsed(t):
    k = F.col("o_orderkey")
    day = F.when(k % 3 == 0, "spring 1996").when(k % 3 == 1, F.substring(F.col("o_orderdate").cast("string"), 1, 10))
    raw = F.when(k % 4 == 0, "[]").when(k % 4 == 1, F.concat(F.lit(' [{"found_in_doc": "f'), k.cast("string"), F.lit('", "year_ce": 1996}]'))).when(k % 4 == 2, '{"found_in_doc": "x"}').otherwise("[broken")
    refs = models.parsed_refs(raw)
    return t.orders.select("o_orderkey", T.iso_date(day).alias("day"), F.size(refs).alias("n_refs"), F.get(refs, F.lit(0))["found_in_doc"].alias("found"))


@query("SELECT json, sha256(json) AS sha256 FROM (SELECT '{' || string_agg('\"' || n_name || '\":' || n_regionkey, ',' ORDER BY n_name) || '}' AS json FROM nation)")
def a17_canonical_json(t):
    return sinks.json_map(t.nation, "n_name", "n_regionkey")


@query("SELECT doc_id, CAST(pos AS INTEGER) AS pos, 'r' || pos AS a, lang AS b FROM documents, range(1, 4) r(pos) WHERE pos <> 2")
def c03_tsv_records(t):
    text = F.concat(F.lit("a\tb\nr1\t"), "lang", F.lit("\nr2\t"), "lang", F.lit("\tx\nr3\t"), "lang", F.lit("\n"))
    rows = manifest.tsv_records(t.documents.select("doc_id", text.alias("text"), "lang"))
    return rows.select("doc_id", "pos", F.col("record")["a"].alias("a"), F.col("record")["b"].alias("b"))


@query("SELECT 'CORPUS_SIZE' AS code, 'expected -1, found ' || count(*) AS message FROM documents")
def v09_size_pin(t):
    return manifest.size_pin(t.documents, -1).unionByName(manifest.size_pin(t.region, 5))


@query("SELECT item_id AS doc_id, a AS anchor FROM benchmark, (VALUES ('section-1'), ('section-1-1'), ('schedule-1'), ('p1')) v(a)")
def v07_anchors_of_text(t):
    return links.anchors_of(render.rendered(clml.parse(_acts(t)).cache(), _slugs(t), "now"), "doc_id", "markdown")


@query("""
SELECT doc_id, CASE WHEN doc_id % 4 > 0 THEN 1990 + doc_id % 30 END AS year, CASE doc_id % 3 WHEN 0 THEN 'Civil' WHEN 1 THEN 'tax' END AS category, CASE WHEN doc_id % 2 = 0 THEN 'Finance' END AS minister, CASE WHEN doc_id % 5 > 0 THEN 'ok' END AS status FROM documents""")
def f13_facet_rows(t):
    i = F.col("doc_id")
    lines_ = F.array_compact(F.array(F.when(i % 4 > 0, F.concat(F.lit("publication_date: "), (1990 + i % 30).cast("string"), F.lit("-01-02"))), F.when(i % 3 == 0, "category: civil").when(i % 3 == 1, 'category: "tax"'), F.when(i % 2 == 0, "ministry_ids: [7, 2]").otherwise("ministry_ids: [7]"), F.when(i % 5 > 0, 'law_validity: "ok"')))
    return t.documents.select("doc_id", facets.facet_row(T.render_frontmatter(lines_), {"civil": "Civil"}, {2: "Finance"}).alias("x")).select("doc_id", "x.*")


@query("SELECT facet, value, n, CAST(row_number() OVER (ORDER BY facet, value = 'Other', TRY_CAST(value AS INTEGER) NULLS LAST, value) AS INTEGER) AS place FROM (SELECT 'year' AS facet, coalesce(CAST(CASE WHEN n_nationkey % 4 > 0 THEN 900 + n_nationkey * 37 END AS VARCHAR), 'Other') AS value, count(*) AS n FROM nation GROUP BY 2 UNION ALL SELECT 'name', n_name, count(*) FROM nation GROUP BY 2)")
def t05_ordered_groups(t):
    rows = t.nation.select(F.when(F.col("n_nationkey") % 4 > 0, 900 + F.col("n_nationkey") * 37).cast("string").alias("year"), F.col("n_name").alias("name"))
    return facets.ordered_groups(facets.facet_counts(rows, ["year", "name"]))
