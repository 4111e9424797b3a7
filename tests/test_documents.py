"""Whole-document operators against brute force and hand-computed cases."""

import random
import re

from pyspark.sql import functions as F

from lexforge.functions import footers
from lexforge.functions import text as T
from lexforge.operators import chains, layout, lines, render
from lexforge.sources import clml


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def linked_by_hand(text, names):
    """One pass from the left, the longest name that fits at a place, none beside a link's brackets."""
    order, out, at = sorted(names, key=lambda n: (-len(n), n)), "", 0
    while at < len(text):
        hit = next((n for n in order if text.startswith(n, at) and text[at - 1 : at] != "[" and not text.startswith("](", at + len(n))), None)
        out, at = (out + f"[{hit}]({names[hit]})", at + len(hit)) if hit else (out + text[at], at + 1)
    return out


def test_dictionary_links_against_brute_force(spark):
    rng = random.Random(5)
    words = ["tax", "act", "of", "the", "land", "No", "(2)", "a+b", "$5", "taxes", "x\\y", "act,"]
    names = {" ".join(rng.choices(words, k=rng.randint(1, 6))): f"u{i}$" for i in range(60)}
    names |= {"two  spaces of": "s", "line\nof the act": "n", "ax ac": "inner", "and": "u"}
    texts = [rng.choice(["", "[", "x"]) + " ".join(rng.choices([*words, "[tax](q)", "two  spaces of the", "line\nof the act"], k=rng.randint(0, 60))) for _ in range(60)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    table = spark.createDataFrame(list(names.items()), "name string, url string")
    got = {r.doc_id: r.text for r in lines.dictionary_links(docs, table).collect()}
    assert got == {i: t if t is None else linked_by_hand(t, names) for i, t in enumerate(texts)}


def test_dictionary_links_undo_old_ones(spark):
    docs = spark.createDataFrame([(1, "see [Tax Act](./12.md) and [B](https://fs.example/x.pdf)")], "doc_id long, text string")
    table = spark.createDataFrame([("Tax Act", "./13.md")], "name string, url string")
    assert lines.dictionary_links(docs, table, hosts=r"fs\.example").first().text == "see [Tax Act](./13.md) and B"
    none = spark.createDataFrame([], "name string, url string")
    assert lines.dictionary_links(docs, none).count() == 1


def pages_by_hand(rows, width):
    """Pages of (page, line, y0, x0, x1, size, text) as the layout operators should give them."""
    out = []
    for page in sorted({r[0] for r in rows}):
        own = [r for r in rows if r[0] == page]
        counts = {}
        for r in sorted(own, key=lambda r: r[1]):
            counts[r[5]] = counts.get(r[5], 0) + 1
        body = max(counts, key=lambda s: (counts[s], -list(counts).index(s)))
        aside = [r for r in own if r[5] < body and (r[4] < width * 0.18 or r[3] > width * 0.82)]
        plain = sorted((r for r in own if r not in aside), key=lambda r: (r[2], r[1]))
        shown, notes = [], []
        for r in plain:
            if shown and r[2] - shown[-1][0] <= 4:
                shown[-1][1].append(r)
            else:
                shown.append((r[2], [r]))
        for r in sorted(aside, key=lambda r: (r[2], r[1])):
            if notes and r[2] - notes[-1][-1][2] <= 14:
                notes[-1].append(r)
            else:
                notes.append([r])
        lines, before = [], None
        todo = [(n[0][2], "> *" + " ".join(r[6].strip() for r in n).strip() + "*") for n in notes]
        for y, some in shown:
            while todo and todo[0][0] <= y + 4:
                lines += ([""] if lines and lines[-1] else []) + [todo.pop(0)[1], ""]
            if before is not None and y - before > 14 and lines[-1]:
                lines.append("")
            lines.append(" ".join(r[6] for r in sorted(some, key=lambda r: (-r[3], r[2], r[1]))))
            before = y
        for _, note in todo:
            lines += ([""] if lines and lines[-1] else []) + [note]
        out.append("\n".join(lines))
    return "\n\n".join(out)


def test_page_markdown_against_brute_force(spark):
    rng = random.Random(9)
    docs = {}
    for d in range(25):
        docs[d] = [(rng.randint(1, 2), n, float(rng.randint(0, 120)), float(x := rng.choice([5, 60, 300, 520])), float(x + 30), rng.choice([8.0, 10.0, 10.0]), f"t{n}") for n in range(rng.randint(1, 25))]
    rows = [(d, *r) for d, some in docs.items() for r in some]
    table = spark.createDataFrame(rows, "doc_id long, page int, line int, y0 double, x0 double, x1 double, size double, text string").repartition(3)
    got = {r.doc_id: r.text for r in layout.page_markdown(layout.classified(table, ["doc_id", "page"], 600.0)).collect()}
    assert got == {d: pages_by_hand(some, 600.0) for d, some in docs.items()}


ACT = """<Legislation xmlns="urn:l" RestrictExtent="E"><Metadata><title>A "B"</title></Metadata><Primary><Body>
<P1group><Title>Start</Title><P1 id="section-1"><Pnumber>1</Pnumber><P1para><Text>a <Substitution CommentaryRef="c1">new <Addition CommentaryRef="c2">er</Addition></Substitution> <Repeal RetainText="true" CommentaryRef="c3" Extent="S">old</Repeal></Text>
<UnorderedList><ListItem><Para><Text>one</Text><UnorderedList><ListItem><Para><Text>deep</Text></Para></ListItem></UnorderedList></Para></ListItem><ListItem><Para><Text>two</Text></Para></ListItem></UnorderedList>
<BlockAmendment><P1><P1para><Text>q1</Text></P1para></P1><Text>q2</Text></BlockAmendment><Text>tail</Text></P1para><P1para><Text>next para</Text></P1para></P1>
<P><Text>bare</Text></P></P1group><P1 id="section-2" Status="Repealed"><P1para><Text>. . .</Text></P1para></P1>
<Tabular><table><tr><th>h1</th><th>h2</th></tr><tr><td>x</td></tr></table></Tabular></Body>
<Schedules><Schedule id="schedule"><ScheduleBody><P1 id="long-id" shortId="short"><Pnumber>1</Pnumber><P1para><Text>s</Text></P1para></P1></ScheduleBody></Schedule></Schedules></Primary>
<Commentaries><Commentary id="c1" Type="F"><Para><Text>one <CommentaryRef Ref="c4"/></Text></Para><Para><Text>more</Text></Para></Commentary><Commentary id="c2" Type="F"><Para><Text>two</Text></Para></Commentary>
<Commentary id="c3" Type="F"><Para><Text>three</Text></Para></Commentary><Commentary id="c4" Type="F"><Para><Text>four <CommentaryRef Ref="c1"/></Text></Para></Commentary><Commentary id="c5" Type="F"><Para><Text>five <CommentaryRef Ref="c6"/></Text></Para></Commentary></Commentaries></Legislation>"""


def test_an_act_with_mixed_runs_lists_quotes_and_nested_notes(spark):
    rows = clml.parse(spark.createDataFrame([(1, ACT), (2, ACT.replace("<Text>bare</Text>", "<Formula/>"))], "doc_id long, content string"))
    assert [(r.row, r.kind) for r in rows.filter("doc_id = 2").collect()] == [("finding", "UNHANDLED_ELEMENT")]
    slugs = spark.createDataFrame([], "doc_id long, slug string")
    md = render.rendered(rows, slugs, "now").collect()
    assert len(md) == 1
    head, body = md[0].markdown.split("---\n\n", 1) if "---\n\n" in md[0].markdown else ("", md[0].markdown)
    whole = md[0].markdown
    assert 'title: "A \\"B\\""' in whole and "extent: E\n" in whole
    assert "# 1. Start <span id=\"section-1\" />\n\na [new [er][^fc2]][^fc1] [old][^fc3] (repealed for S)\n- one\n- deep\n\n- two\n\n\nnext para\n\n" in whole
    assert "> [Quoted block text — not this Act's own numbered provision]\n> q1\n> q2\n\ntail\n\n" in whole
    assert "# (unnumbered)\n\nbare\n\n" in whole and "# (unnumbered) **[REPEALED]** <span id=\"section-2\" />\n\n. . .\n\n" in whole
    assert "\n| h1 | h2 |\n| --- | --- |\n| x |\n\n\n" in whole and "## 1. <span id=\"short\" />" in whole
    notes = re.findall(r"^\[\^f(\w+)\]: (.*)$", whole, re.M)
    assert notes == [("c2", "[section-1](#section-1): two"), ("c4", "four [^fc1]"), ("c1", "[section-1](#section-1): one [^fc4] more"), ("c3", "[section-1](#section-1): three"), ("c6", "see amending instrument (commentary c6 not found)")]
    assert "## Editorial Notes" in whole and "- five [^fc6]\n" in whole


def test_batches_link_only_to_anchors_that_are_there(spark):
    act = lambda to, ref: f'<Legislation><Primary><Body><P1 id="section-1"><Pnumber>1</Pnumber><P1para><Text><Citation URI="http://leg.example/id/ukpga/{to}" SectionRef="{ref}">c</Citation></Text></P1para></P1></Body></Primary></Legislation>'
    acts = [(1, act("2002/2", "section-1")), (2, act("2001/1", "section-7")), (3, act("2003/3", "gone")), (4, act("2099/9", "section-1")), (5, act("2006/6", "section-9")), (6, "<broken")]
    slugs = spark.createDataFrame([(i, f"ukpga-200{i}-{i}") for i in range(1, 7)], "doc_id long, slug string")
    rows = clml.parse(spark.createDataFrame(acts, "doc_id long, content string"))
    got = {r.doc_id: (r.target_slug, r.target, r.link) for r in render.citations(rows, slugs).collect()}
    assert got == {1: ("ukpga-2002-2", "section-1", "./ukpga-2002-2.md#section-1"), 2: ("ukpga-2001-1", None, "./ukpga-2001-1.md"), 3: (None, None, None), 4: (None, None, "https://leg.example/ukpga/2099/9"), 5: ("ukpga-2006-6", "section-9", "./ukpga-2006-6.md#section-9")}


def test_titles_and_tails(spark):
    assert one(spark, T.slug(F.lit("חוק-יסוד: Café ﬁne—Ü 1992"), F.lit(5))) == "basic-law-cafe-fineu-1992-1992"
    assert one(spark, T.slug(F.lit("חוק הָעונשין"), F.lit(5))) == "law-5" and one(spark, T.slug(F.lit("—"), F.lit(7))) == "law-7"
    assert one(spark, footers.cut_from(F.lit("a\n# 527. b"), "# 527.")) == "a" and one(spark, footers.cut_from(F.lit("a \n"), "# 527.")) == "a"
    assert one(spark, T.undecorated(F.lit("a *[*b*]* c"))) == "a b c"
    assert one(spark, T.without_margin_prefix(F.lit("הערה כאן 12. (א) גוף"), F.array().cast("array<string>"))) == "12. (א) גוף"
    assert one(spark, T.without_margin_prefix(F.lit("אחת. 12 גוף"), F.array().cast("array<string>"))) == "אחת. 12 גוף"


def test_frontmatter_and_body_put_together_are_the_text(spark):
    for text in ("---\na: 1\n---\n\n# 1. x\n", "---\na: 1\n---", "# 1. x", ""):
        docs = spark.createDataFrame([(1, text)], "doc_id long, markdown string")
        assert chains.link_resolved(docs, spark.createDataFrame([], "url string, target string"), "h").first().markdown == text.replace("# 1. x", '# 1. x <span id="section-1" />')


def test_section_references_by_their_grammar(spark):
    text = "# 1. x\n# 2א. y\nלפי סעיף 1(א)(2) וסעיף 2 לחוק זה, ובסעיף  2א לפקודת המסים, סעיפים 1 עד 2, [סעיף 1](#section-1), סעיף 12"
    docs = spark.createDataFrame([(1, text), (2, "סעיף 1 [סעיף 1](#section-1)")], "doc_id long, text string")
    rows = lines.section_links(lines.section_anchors(lines.explode_lines(docs))).collect()
    got = {(r.doc_id, r.pos): r.line for r in rows}
    assert got[1, 2] == "לפי [סעיף 1(א)(2)](#section-1) וסעיף 2 לחוק זה, ובסעיף  2א לפקודת המסים, [סעיפים 1](#section-1) עד 2, [סעיף 1](#section-1), סעיף 12"
    assert got[2, 0] == "סעיף 1 [סעיף 1](#section-1)"


def test_section_references_of_documents_with_and_without_sections(spark):
    """Old links are undone where a document has sections, quotes among them; ids that are null or lines that are null stay."""
    old, made = "ראה [בסעיף  7](#section-7) וסעיף 1", "ראה בסעיף  7 ו[סעיף 1](#section-1)"
    heads = [(1, 0, "# 1. x \u00a0\u2028"), (1, 1, "# 2. y {#section-9}\u2003<span id=\"section-2\" /> z")]
    asks = [(d, n, line) for d in (1, 2, None) for n, line in ((5, old), (6, "> " + old), (7, None), (8, "סעיף 2 וסעיף 2, סעיף 3"))]
    rows = lines.section_links(lines.section_anchors(spark.createDataFrame(heads + asks, "doc_id long, pos int, line string"))).collect()
    got = {(r.doc_id, r.pos): r.line for r in rows}
    want = {(1, 0): '# 1. x <span id="section-1" />', (1, 1): '# 2. y z <span id="section-2" />'} | {(d, n): line for d, n, line in asks}
    want |= {(1, 5): made.replace("ו[סעיף 1](#section-1)", "וסעיף 1"), (1, 6): "> ראה בסעיף  7 וסעיף 1", (1, 8): "[סעיף 2](#section-2) וסעיף 2, [סעיף 3](#section-3)".replace("[סעיף 3](#section-3)", "סעיף 3")}
    assert got == want and len(rows) == len(want)


def test_lines_are_searched_once_for_each_use(spark):
    """The lines are read three times: for sections, for what is asked, and to be rewritten; no filter searches them."""
    docs = spark.createDataFrame([(1, "# 1. x\nסעיף 1")], "doc_id long, text string")
    linked = lines.section_links(lines.section_anchors(lines.explode_lines(docs)))
    plan = linked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("posexplode(") == 3 and not [p for p in plan.split("\n") if "Filter" in p and "RLIKE" in p]


def test_pages_whose_line_numbers_repeat_or_are_null(spark):
    """A line number that two lines share shows each once, as by hand; lines without a page or a number go."""
    rng = random.Random(4)
    docs = {d: [(rng.choice([1, 2]), rng.randint(1, 6), float(rng.randint(0, 60)), float(x := rng.choice([5, 60, 300, 520])), float(x + 30), rng.choice([8.0, 10.0, 10.0]), f"t{d}-{n}") for n in range(rng.randint(2, 12))] for d in range(40)}
    rows = [(d, *r) for d, some in docs.items() for r in some] + [(0, None, 1, 1.0, 60.0, 90.0, 10.0, "no page"), (None, 1, 1, 1.0, 60.0, 90.0, 10.0, "no document")]
    table = spark.createDataFrame(rows, "doc_id long, page int, line int, y0 double, x0 double, x1 double, size double, text string").repartition(3)
    got = {r.doc_id: r.text for r in layout.page_markdown(layout.classified(table, ["doc_id", "page"], 600.0)).collect()}
    words = lambda text: sorted(w.strip(">*") for w in text.split() if w.strip(">*"))
    assert {d: words(text) for d, text in got.items()} == {d: sorted(r[6] for r in some) for d, some in docs.items()}


def test_pages_are_dealt_once_before_and_once_after_the_fold(spark):
    """No line is joined to what was found about it, whatever the size; the shuffles of one use of lines and notes."""
    table = spark.createDataFrame([(1, 1, 1, 1.0, 60.0, 90.0, 10.0, "a")], "doc_id long, page int, line int, y0 double, x0 double, x1 double, size double, text string")
    plan = layout.page_markdown(layout.classified(table, ["doc_id", "page"], 600.0))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("MapInArrow") == 1
