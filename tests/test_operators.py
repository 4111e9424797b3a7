import json
import re

from pyspark.sql import functions as F

from lexforge.functions import text as T
from lexforge.operators import layout, lines, links, manifest, render
from lexforge.sources import clml, readers, sinks

XML = """<Legislation xmlns="http://x" NumberOfProvisions="3" RestrictExtent="E+W"><Metadata><title>Test Act</title><DocumentStatus Value="revised"/></Metadata>
<Body><Part id="part-1"><Number>Part 1</Number><Title>General</Title><P1group><Title>Start</Title>
<P1 id="section-1"><Pnumber>1</Pnumber><P1para><Text>A <Term>term</Term> and <Addition CommentaryRef="c1">new</Addition> text.</Text>
<P2 id="section-1-1"><Pnumber>1</Pnumber><P2para><Text>Sub {one}.</Text></P2para></P2><Text>After.</Text></P1para></P1></P1group></Part></Body>
<Commentaries><Commentary id="c1" Type="F"><Para><Text>Words inserted</Text></Para></Commentary></Commentaries></Legislation>"""


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def test_frontmatter_cases(spark):
    cases = {"": ("", ""), "no fence": ("", "no fence"), "---\na: 1\n---\nbody": ("---\na: 1\n---\n", "body"), "---\na: 1\n---\n\nbody": ("---\na: 1\n---\n", "\nbody"), "---\na: 1": ("", "---\na: 1"), "---\n---\nx": ("---\n---\n", "x")}
    for text, parts in cases.items():
        got = spark.createDataFrame([(text,)], "t string").select(*T.split_frontmatter(F.col("t"))).first()
        assert tuple(got) == parts, text


def test_text_functions(spark):
    assert one(spark, T.strip(F.lit("  x\n"))) == "x"
    assert one(spark, T.quote(F.lit('a "b"'))) == '"a \\"b\\""'
    assert one(spark, T.strip_year(F.lit('חוק הגנים, התשנ"ו-1996'))) == "חוק הגנים"
    assert one(spark, T.plain_title(F.lit('חוק הגנים [נוסח חדש], התשנ"ו-1996'))) == "חוק הגנים"
    assert one(spark, T.title_key(F.lit('חוק "הגנים",  התשנ"ו-1996'))) == "חוק הגנים"
    assert one(spark, T.clean_rtl(F.lit(")א( .1 סעיף5"))) == "(א) 1. סעיף 5"
    assert one(spark, T.valid_number(F.lit("II–VI"))) and not one(spark, T.valid_number(F.lit("")))
    assert one(spark, T.rewrite(F.lit("a1b22"), r"\d+", lambda m: F.concat(F.lit("<"), m, F.lit(">")))) == "a<1>b<22>"
    assert one(spark, T.unfenced(F.lit("```md\nx\n```"))) == "x"


def test_next_batch_skips_done_and_failed(spark):
    rows = spark.createDataFrame([("uk1", 0), ("uk2", 1), ("uk3", 2), ("uk3", 3)], "doc_id string, pos long")
    state = lambda x: spark.createDataFrame([(x,)], "doc_id string")
    queue = spark.createDataFrame([("uk3", 0), ("uk3", 1)], "doc_id string, prio long")
    got = manifest.next_batch(rows, state("uk1"), state("uk2"), queue, 5).collect()
    assert [(r.doc_id, r.pos) for r in got] == [("uk3", 3)]
    assert manifest.next_batch(rows, state("uk1"), state("uk2"), queue, 5, force=True).count() == 3


def test_sections_references_and_notes(spark):
    text = "# 1. ראשון\n> הערה\n# 2א. שני\nלפי סעיף 1 וגם סעיף 9\n> סעיף 1"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    rows = lines.section_anchors(lines.explode_lines(docs))
    assert [r.anchor for r in rows.orderBy("pos").collect()] == ["section-1", None, "section-2", None, None]
    known = rows.filter("anchor is not null").select("doc_id", F.substring("anchor", 9, 9).alias("num"))
    linked = [r.line for r in lines.linked_references(rows, known, r"סעיף\s+\d+").orderBy("pos").collect()]
    assert linked[3] == "לפי [סעיף 1](#section-1) וגם סעיף 9" and linked[4] == "> סעיף 1"
    assert "- [הערה](#section-1)" in lines.margin_index(rows).first()["index"]


def documents(spark, path, texts):
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_all_lines_and_documents(spark, tmp_path):
    from lexforge.plans import registry

    texts = ["a -- b [c] | x\\, y ,\nz \\ w, , v", "₪ 5 (₪) 7₪x  ,\r\nq \r\\\rr", "\u200fplain", "T one\rtwo \x0b\nthree\x0c\n> four\r", "\n".join(f"l{i}" for i in range(9))]
    sf, known = documents(spark, tmp_path, texts), registry.queries()

    def cleaned(t):
        for pattern, to in (("[\u200e\u200f\u202a-\u202e\u2066-\u2069]", ""), (r"\(\s*[₪$€£]\s*\)", ""), (r"(?<!\w)[₪](?!\w)", ""), (r"[|\[\]]", ""), (r"\s--\s?", " "), (r"\\([,;.])", r"\1"), (r"(?m)(?:^|\s)\\(?=\s|$)", ""), (r"(?m)\s+,\s*$", ""), (r",\s*,", ","), (r"[ \t]{2,}", " ")):
            t = re.sub(pattern, to, t)
        return t.strip()

    assert {r.doc_id: r.text for r in known["r33_clean_ocr"](spark, sf).collect()} == {i: cleaned(t) for i, t in enumerate(texts)}
    split = [(i, n, line) for i, t in enumerate(texts) for n, line in enumerate(t.split("\n"))]
    anchored = {(i, n): f'{f"# {n + 1}. {line}".rstrip()} <span id="section-{n + 1}" />' for i, n, line in split}
    assert {(r.doc_id, r.pos): r.line for r in known["r20_section_anchors"](spark, sf).collect()} == anchored
    last = {i: n for i, n, _ in split}
    linked = {(i, n): line if line.startswith(">") else f"{line} [§ {n % 7}](#section-{n % 7})" if n % 7 <= last[i] else f"{line} § {n % 7}" for i, n, line in split}
    assert {(r.doc_id, r.pos): r.line for r in known["r21_section_links"](spark, sf).collect()} == linked


def test_all_files_by_status(spark, tmp_path):
    from lexforge.plans import registry

    orders = [(i, "FOP"[i % 3] if i % 10 else None) for i in range(1, 121)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    got = {tuple(r) for r in registry.queries()["a11_files_by_status"](spark, str(tmp_path)).collect()}
    assert got == {(s, sum(x == s for _, x in orders), i) for i, s in orders}


def test_braces_of_whole_texts(spark, tmp_path):
    from lexforge.plans import registry

    texts = ["x" * 60 + " {a} {{b}\n}" + "y" * 20, "", "{" * 70]
    got = {r.doc_id: (r.escaped, r.back) for r in registry.queries()["r16_escape_braces"](spark, documents(spark, tmp_path, texts)).collect()}
    assert got == {i: ("{t}".replace("t", t).replace("{", "\\{").replace("}", "\\}"), "{" + t + "}") for i, t in enumerate(texts)}


def test_margin_index_of_whole_documents(spark, tmp_path):
    from lexforge.plans import registry

    old = "\n\n## Sidenotes\n\n" + "".join(f"- [n{i}](#section-{i})\n" for i in range(5000))
    texts = ["Title\nA" + "b" * 120000 + "\n", "no notes" + old + "end", "Title\nAn old note" + old, "- [x](#section-1)\nkept", "A note before any title"]
    index = lambda note: f"\n\n## Sidenotes\n\n- [{note}](#section-0)\n"
    got = {r.doc_id: r.text for r in registry.queries()["r22_margin_index_whole"](spark, documents(spark, tmp_path, texts)).collect()}
    long = "A" + "b" * 120000
    assert got == {0: f"Title\n> {long}" + index(long), 1: "no notesend", 2: "Title\n> An old note" + index("An old note"), 3: texts[3], 4: "> A note before any title"}


def test_dictionary_links_longest_first(spark):
    docs = spark.createDataFrame([(1, "Tax Act and Tax Act (No 2), [Tax Act](x)")], "doc_id long, text string")
    names = spark.createDataFrame([("Tax Act", "u1"), ("Tax Act (No 2)", "u$2")], "name string, url string")
    assert lines.dictionary_links(docs, names).first().text == "[Tax Act](u1) and [Tax Act (No 2)](u$2), [Tax Act](x)"


def test_legislation_xml(spark):
    rows = clml.parse(spark.createDataFrame([(1, XML), (2, "<broken")], "doc_id long, content string"))
    nodes = clml.provisions(rows.filter("doc_id = 1"))
    assert {(r.kind, r.id, r.level) for r in nodes.collect()} == {("part", "part-1", 1), ("section", "section-1", 2), ("subsection", "section-1-1", 3)}
    runs = [(r.kind, r.text) for r in rows.filter("row = 'run' and doc_id = 1").orderBy("path").collect()]
    assert runs[:7] == [("text", "A "), ("term", "term"), ("text", " and "), ("open", None), ("text", "new"), ("close", None), ("text", " text.")]
    assert rows.filter("doc_id = 2").first().kind == "PARSE_ERROR"
    slugs = spark.createDataFrame([], "doc_id long, slug string")
    md = render.rendered(rows, slugs, "now").first().markdown
    assert md.index("A term and [new][^fc1] text.") < md.index("Sub \\{one\\}.") < md.index("After.") < md.index("[^fc1]: [section-1](#section-1): Words inserted")
    source = rows.filter("row = 'source' and doc_id = 1").select("doc_id", F.col("text").alias("source"))
    texts = spark.createDataFrame([(1, md.replace("Words", "Word"))], "doc_id long, rendered string")
    assert [r.message for r in links.missing_texts(source, texts, clean=T.undecorated).collect()] == ["Words inserted"]


def test_layout_folds(spark):
    rows = spark.createDataFrame([(1, i, float(y)) for i, y in enumerate([0, 3, 5, 9, 20])], "page int, n long, y double")
    got = layout.start_clusters(rows, ["page"], "y", "n", 4).orderBy("n").collect()
    assert [r.cluster for r in got] == [1, 1, 2, 2, 3]
    notes = spark.createDataFrame([(1, 1, 6.0), (1, 2, 99.0)], "page int, note_id int, note_y double")
    placed = layout.notes_at_rows(notes, rows.select("page", F.col("y").alias("row_y")), ["page"]).orderBy("note_id").collect()
    assert [r["at"] for r in placed] == [3.0, None]


def test_readers(spark, tmp_path):
    (tmp_path / "a.md").write_text("---\ntitle: x\n---\nbody")
    (tmp_path / "index.md").write_text("no")
    assert [r.doc_id for r in readers.markdown(spark, str(tmp_path)).collect()] == ["a"]
    assert readers.enacted_filter(118, ("a'b",)) == "StatusID eq 118 and (startswith(Name,'a''b'))"
    assert spark.createDataFrame([("x\fy",)], "text string").transform(readers.page_text).count() == 2


def test_paged_service_reads_until_a_page_is_empty(spark):
    rows = [{"value": str(i)} for i in range(25)]

    class Numbers(readers.PagedService):
        fetch = staticmethod(lambda url, where, skip, top: rows[skip : skip + top])

    spark.dataSource.register(Numbers)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for pages in (None, 1, 2, 9):
        reader = spark.read.format("paged_service").option("page", 10)
        got = (reader.option("pages", pages) if pages else reader).load()
        assert sorted(int(r.value) for r in got.collect()) == list(range(25)), pages


def test_sinks(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"# {i}\nי") for i in range(40)], "doc_id long, markdown string")
    sinks.markdown_sink(docs, str(tmp_path / "md"), buckets=4)
    assert len([p for p in (tmp_path / "md").iterdir() if p.is_dir()]) == 4
    assert {tuple(r) for r in readers.markdown_store(spark, str(tmp_path / "md")).collect()} == {tuple(r) for r in docs.collect()}
    for seq, state in enumerate(("queued", "failed", "done")):
        sinks.progress_sink(spark.createDataFrame([(1, state, seq)], "doc_id long, state string, seq long"), str(tmp_path / "p"))
    assert [tuple(r) for r in readers.progress(spark, str(tmp_path / "p")).collect()] == [(1, "done", 2)]
    text = sinks.catalog_text(spark.createDataFrame([(2, "ב"), (1, None)], "law_id long, name string"), "law_id").first().json
    assert json.loads(text) == [{"law_id": 1, "name": None}, {"law_id": 2, "name": "ב"}] and "\n  " in text and "ב" in text


def test_fetched_keeps_nothing_of_a_failed_file(spark):
    def fetch(address):
        if address == "b":
            raise OSError("down")
        return address.encode()

    rows = lambda *x: spark.createDataFrame([(v,) for v in x], "url string")
    got = {r.url: (r.content, r.error) for r in readers.fetched(rows("a", "b", "c"), rows("c"), fetch, delay=0.01).collect()}
    assert got == {"a": (bytearray(b"a"), None), "b": (None, "OSError: down")}


def test_stream_converts_new_files_once(spark, tmp_path):
    from lexforge.streaming.incremental import convert_new

    src, out, mark = (str(tmp_path / x) for x in ("src", "out", "mark"))
    for i in range(2):
        spark.createDataFrame([(i, "t")], "doc_id long, text string").write.mode("append").parquet(src)
        convert_new(spark, src, "doc_id long, text string", out, mark, lambda d: d.withColumn("text", F.upper("text")))
    assert sorted(r.doc_id for r in spark.read.parquet(out).collect()) == [0, 1]


def test_tsv_lines_are_split_once(spark):
    """Rows too short, too long, blank, no number, NaN or null go; the line is split in one place of the plan."""
    columns = ("a", "b", "text")
    texts = ["1\t 2 \tx", "1\t2", "1\t2\tx\ty", "1\t2\t ", "1\tz\tx", "NaN\t2\tx", None, "", "1e3\t-2.5\t w ", "\t1\tx"]
    table = spark.createDataFrame(list(enumerate(texts)), "n int, line string")
    got = manifest.tsv_words(table, columns, columns[:-1])
    assert [tuple(r) for r in got.orderBy("n").collect()] == [(0, 1.0, 2.0, "x"), (8, 1000.0, -2.5, " w ")]
    assert got.columns == ["n", *columns] and str(got._jdf.queryExecution().optimizedPlan()).count("split(") == 1
