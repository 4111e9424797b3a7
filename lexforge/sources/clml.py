"""Legislation XML to flat tables: one row per provision, inline event, commentary, effect, term source and finding.

Mixed content has an order that Spark's XML reader does not keep, so the tree walk is an Arrow function; all that
follows works on tables. Rows of all sorts share one schema and are told apart by column row.

Paths sort in document order. A provision at path p has its leading events at p + [0, i], its children at p + [n]
with n from 1, and its trailing events at p + [TRAIL, i]. Inline markup is a flat stream of events: a change opens and
closes, so nesting needs no tree (columns: kind, text, ref of a commentary, uri, target, anchor of the provision).

An element that the walk does not know is an error of its document, not a drop: the document then has one finding
and no other row, and the rest of the batch goes on.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COLUMNS = (
    "row string, root string, path array<int>, parent string, level int, kind string, id string, number string, heading string, text string,"
    " extent string, status string, uri string, target string, ref string, anchor string"
)
#: Fixed: element names and what they become, and texts that stand for what can't be read.
CHANGES = {"Addition": "addition", "Substitution": "substitution", "Repeal": "repeal"}
PLAIN = {"Emphasis", "Abbreviation", "Char", "InlineAmendment", "Acronym", "Pnumber"}
LEVELS = {1: "section", 2: "subsection", 3: "para", 4: "subpara"}
HEADERS = {"Number", "Title", "TitleBlock", "Reference"}
UNREAD = "[UNCERTAIN TEXT — Figure/Image, not extractable as text]"
NO_TABLE = "[UNCERTAIN TEXT — Tabular content, no <table> found]"
NO_ROWS = "[UNCERTAIN TEXT — Tabular content, no rows found]"
TRAIL = 1 << 30


class UnhandledElement(Exception):
    """An element that the walk has no rule for."""


def _tag(el) -> str:
    return el.tag.rsplit("}", 1)[-1] if isinstance(el.tag, str) else ""


def _all(el) -> str:
    return "".join(el.itertext())


def _flat(el) -> str:
    return " ".join(_all(el).split()) if el is not None else ""


def _own(el) -> str | None:
    """The text right inside an element, squeezed; null without any."""
    return " ".join(el.text.split()) if el is not None and el.text is not None else None


def _named(el, *names) -> list:
    return [c for c in el if _tag(c) in names]


def _first(el, *names):
    """The first element along a path of child names."""
    for n in names:
        el = next(iter(_named(el, n)), None) if el is not None else None
    return el


def inline(el, nested: bool = False):
    """Events of mixed content in order, as dicts."""
    if el.text:
        yield {"kind": "text", "text": el.text}
    for c in el:
        name = _tag(c)
        if kind := CHANGES.get(name):
            ref, kept = c.get("CommentaryRef"), c.get("RetainText") == "true"
            if kind == "repeal" and not kept:
                yield {"kind": "repeal", "ref": ref}
            else:
                yield {"kind": "open", "status": kind, "ref": ref if kind == "repeal" else None}
                yield from inline(c, True)
                yield {"kind": "close", "status": kind, "ref": ref, "extent": c.get("Extent")}
        elif name == "Term":
            yield {"kind": "text" if nested else "term", "text": _all(c), "uri": c.get("id")}
        elif name in ("Citation", "CitationSubRef"):
            yield {"kind": "citation", "text": _all(c), "uri": c.get("URI"), "target": c.get("SectionRef")}
        elif name == "ExternalLink":
            yield {"kind": "citation", "text": _all(c), "uri": c.get("URI")}
        elif name == "CommentaryRef":
            yield {"kind": "commentary", "ref": c.get("Ref")}
        elif name in PLAIN:
            yield {"kind": "text", "text": _all(c)}
        elif name:
            raise UnhandledElement(f"<{name}> in running text")
        if c.tail:
            yield {"kind": "text", "text": c.tail}


def listed(el):
    """Events of a list, an item a line; lists within it follow the texts of their item."""
    for item in _named(el, "ListItem"):
        yield {"kind": "text", "text": "\n- "}
        for para in _named(item, "Para"):
            for t in _named(para, "Text"):
                yield from inline(t)
            for inner in [*_named(para, "UnorderedList"), *_named(para, "OrderedList")]:
                yield from listed(inner)
        for inner in [*_named(item, "UnorderedList"), *_named(item, "OrderedList")]:
            yield from listed(inner)
    yield {"kind": "text", "text": "\n"}


def table_text(el) -> str:
    """A pipe table, its first row the head; short rows stay short."""
    table = _first(el, "table")
    if table is None:
        return NO_TABLE
    rows = [cells for r in table.iter() if _tag(r) == "tr" and (cells := [_flat(c) for c in _named(r, "td", "th")])]
    if not rows:
        return NO_ROWS
    lines = [f"| {' | '.join(r)} |" for r in rows]
    lines.insert(1, f"| {' | '.join(['---'] * len(rows[0]))} |")
    return "\n" + "\n".join(lines) + "\n"


class Walk:
    """The rows of one document."""

    def __init__(self):
        self.rows: list[dict] = []
        self.root = ""

    def add(self, row: str, path: list[int], **more) -> None:
        self.rows.append({"row": row, "path": list(path), **more})

    def events(self, path: list[int], slot: int, events, anchor) -> None:
        for i, e in enumerate(events):
            self.add("run", [*path, slot, i], root=self.root, anchor=anchor, **e)

    def provision(self, path: list[int], kind: str, el, short: bool = False, group_extent=None, **more) -> str | None:
        """Adds a provision and gives its id: a short one, as is only sure to be its own in schedules, there alone."""
        own = (el.get("shortId") if short else None) or el.get("id")
        extent = el.get("RestrictExtent") or group_extent
        self.plain(path, kind, id=own, extent=extent, status=el.get("Status"), **more)
        return own

    def plain(self, path: list[int], kind: str, **more) -> None:
        """Adds a provision without attributes of its own."""
        self.add("provision", path, root=self.root, parent=".".join(map(str, path[:-1])), level=len(path) - 1, kind=kind, **more)

    def quote(self, el, path: list[int], anchor) -> None:
        self.plain(path, "block_quote")
        texts = (e for t in el.iter() if _tag(t) == "Text" for e in [*inline(t), {"kind": "text", "text": "\n"}])
        self.events(path, 0, texts, anchor)

    def paras(self, paras: list, path: list[int], anchor, short: bool) -> None:
        """Texts before the first nested provision of a para lead; later ones trail behind the children."""
        lead, trail, n = [], [], 0
        for i, para in enumerate(paras):
            nested, before, after = False, [], []
            for c in para:
                name = _tag(c)
                if name in ("Text", "AppendText"):
                    some = inline(c)
                elif name in ("UnorderedList", "OrderedList"):
                    some = listed(c)
                elif name == "Figure":
                    some = [{"kind": "text", "text": UNREAD}]
                elif name == "Tabular":
                    some = [{"kind": "text", "text": table_text(c)}]
                elif re.fullmatch(r"P\d+", name) or name in ("BlockAmendment", "BlockText"):
                    n, nested = n + 1, True
                    if name[1:].isdigit():
                        self.numbered(c, [*path, n], anchor, short)
                    else:
                        self.quote(c, [*path, n], anchor)
                    continue
                elif not name:
                    continue
                else:
                    raise UnhandledElement(f"<{name}> in a paragraph")
                (after if nested or name == "AppendText" else before).extend(some)
            gap = [{"kind": "text", "text": "\n\n"}]
            lead += (gap if i and before else []) + before
            trail += (gap if after else []) + after
        self.events(path, 0, lead, anchor)
        self.events(path, TRAIL, trail, anchor)

    def numbered(self, el, path: list[int], anchor, short: bool, **more) -> None:
        depth = int(_tag(el)[1:])
        number = _first(el, "Pnumber")
        own = self.provision(path, LEVELS.get(depth, f"p{depth}"), el, short, number=_all(number).strip() if number is not None else None, **more)
        self.paras(_named(el, f"P{depth}para") or _named(el, "P")[:1], path, own or anchor, short)

    def bare(self, el, path: list[int], kind: str, anchor, short: bool, **more) -> None:
        """A paragraph without a number; it may hold its text directly."""
        own = el.get("id")
        self.plain(path, kind, id=own, **more)
        if len(el):
            self.paras([el], path, own or anchor, short)
        else:
            self.events(path, 0, inline(el), own or anchor)

    def container(self, el, path: list[int], kind: str, anchor, short: bool, heading, body, **more) -> None:
        own = self.provision(path, kind, el, heading=heading, **more)
        if body is not None:
            self.body(body, path, own or anchor, short)

    def body(self, el, path: list[int], anchor=None, short: bool = False) -> None:
        n = 0
        titles = lambda c: " ".join(t for x in _named(c, "Title") if x.text and (t := _own(x)) is not None) or None
        for c in el:
            name = _tag(c)
            if name in HEADERS or not name:
                continue
            n += 1
            here = [*path, n]
            if name in ("Part", "Chapter"):
                self.container(c, here, name.lower(), anchor, short, titles(c), c, number=_own(_first(c, "Number")))
            elif name == "Pblock":
                self.plain(here, "crossheading", heading=titles(c), id=c.get("id"))
                self.body(c, here, c.get("id") or anchor, short)
            elif name == "P1group":
                heading, extent, leaves = titles(c), c.get("RestrictExtent"), [x for x in c if re.fullmatch(r"P\d*", _tag(x))]
                for i, leaf in enumerate(leaves):
                    n += i > 0
                    first = {"heading": heading} if i == 0 else {}
                    if _tag(leaf) == "P":
                        self.bare(leaf, [*path, n], "section", anchor, short, extent=extent, **first)
                    else:
                        self.numbered(leaf, [*path, n], anchor, short, group_extent=extent, **first)
                if not leaves:
                    self.plain(here, "crossheading", heading=heading, id=c.get("id"))
            elif re.fullmatch(r"P\d+", name):
                self.numbered(c, here, anchor, short)
            elif name == "P":
                self.bare(c, here, "para", anchor, short)
            elif name in ("BlockAmendment", "BlockText"):
                self.quote(c, here, anchor)
            elif name in ("Figure", "Tabular"):
                kind, text = ("uncertain", UNREAD) if name == "Figure" else ("table", table_text(c))
                self.plain(here, kind, id=c.get("id"))
                self.events(here, 0, [{"kind": "text", "text": text}], c.get("id") or anchor)
            else:
                raise UnhandledElement(f"<{name}> in a body")

    def head(self, root) -> None:
        """Metadata, effects not yet applied, commentaries and the texts that must come through."""
        meta = next((e for e in root.iter() if _tag(e) == "Metadata"), root)
        seen: dict[str, object] = {}
        for el in meta.iter():
            seen.setdefault(_tag(el), el)
        value = lambda name, key="Value": seen[name].get(key) if name in seen else None
        fields = {
            "title": _own(seen.get("title")) or "", "long_title": _own(seen.get("description")), "publisher": _own(seen.get("publisher")), "valid": _own(seen.get("valid")),
            "DocumentMainType": value("DocumentMainType"), "DocumentStatus": value("DocumentStatus"), "Year": value("Year"), "Number": value("Number"),
            "EnactmentDate": value("EnactmentDate", "Date"), "NumberOfProvisions": root.get("NumberOfProvisions"), "RestrictExtent": root.get("RestrictExtent"),
        }
        preamble = next((e for e in root.iter() if _tag(e) == "PrimaryPreamble"), None)
        if preamble is not None:
            fields["preamble"] = _flat(preamble)
        for i, (k, v) in enumerate(fields.items()):
            self.add("meta", [i], kind=k, text=v)
        for i, el in enumerate(e for e in root.iter() if _tag(e) == "UnappliedEffect"):
            refs = [s.get("Ref") for part in _named(el, "AffectedProvisions") for s in _named(part, "Section") if s.get("Ref")]
            self.add("effect", [i], kind=el.get("Type") or "", text=_own(_first(el, "AffectingTitle")) or el.get("AffectingURI") or "?", ref=", ".join(refs))
        for i, el in enumerate(e for e in root.iter() if _tag(e) == "Commentary" and e.get("id")):
            self.add("commentary", [i], kind=el.get("Type") or "", id=el.get("id"), text=_flat(el))
            n = 0
            for at, para in enumerate(_named(el, "Para")):
                if (text := _first(para, "Text")) is None:
                    continue
                for e in [*([{"kind": "text", "text": " "}] if at else []), *inline(text)]:
                    self.add("note_run", [i, n], id=el.get("id"), **e)
                    n += 1
        for i, el in enumerate(e for e in root.iter() if _tag(e) == "Text"):
            if text := _flat(el):
                self.add("source", [i], kind="text", text=text)

    def document(self, data: bytes) -> list[dict]:
        try:
            root = ET.fromstring(data)
            self.head(root)
            main = next((e for name in ("Primary", "Secondary") for e in root.iter() if _tag(e) == name), root)
            if (body := _first(main, "Body")) is not None:
                self.root = "body"
                self.body(body, [0])
            if (schedules := _first(main, "Schedules")) is not None:
                self.root = "schedule"
                for i, s in enumerate(_named(schedules, "Schedule")):
                    self.container(s, [1, i], "schedule", None, True, _own(_first(s, "TitleBlock", "Title")), _first(s, "ScheduleBody"), number=_own(_first(s, "Number")), ref=_own(_first(s, "Reference")))
        except ET.ParseError as e:
            return [{"row": "finding", "path": [], "kind": "PARSE_ERROR", "text": str(e)}]
        except UnhandledElement as e:
            return [{"row": "finding", "path": [], "kind": "UNHANDLED_ELEMENT", "text": str(e)}]
        return self.rows


def parse(files: DataFrame, key: str = "doc_id", content: str = "content") -> DataFrame:
    """(key, row, root, path, kind, ...) of every document; a document that can't be parsed gives a finding."""
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    kinds = {"path": "list", "level": "int"}

    def run(batches):
        import pyarrow as pa

        types = {"list": pa.list_(pa.int32()), "int": pa.int32()}
        for b in batches:
            fields = [pa.field(key, b.schema.field(0).type), *(pa.field(n, types.get(kinds.get(n), pa.string())) for n in names)]
            for k, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                raw = data.encode() if isinstance(data, str) else bytes(data or b"")
                yield pa.RecordBatch.from_pylist([{key: k, **r} for r in Walk().document(raw)], pa.schema(fields))

    return files.select(key, content).mapInArrow(run, f"`{key}` {files.schema[key].dataType.simpleString()}, {COLUMNS}")


def provisions(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """The provisions with their leading texts gathered, without markup: what lexforge.operators.tree works on."""
    own = rows.filter("row = 'provision'").drop("row", "text")
    runs = rows.filter("row = 'run' and text is not null").select(key, F.slice("path", F.lit(1), F.size("path") - 2).alias("path"), F.element_at("path", -2).alias("slot"), F.element_at("path", -1).alias("i"), "text")
    ordered = F.array_sort(F.collect_list(F.struct("i", "text")))
    texts = runs.filter("slot = 0").groupBy(key, "path").agg(F.array_join(F.transform(ordered, lambda x: x["text"]), "").alias("text"))
    return own.join(texts, [key, "path"], "left")
