"""XML of proceedings as tables: turns, committee turns, topics, divisions, votes and headers.

Files are read by Spark's ``binaryFile`` source and parsed one at a time in Arrow
batches. A file that isn't well-formed is read as far as its tags make sense; where
that gives nothing, it has one row with ``error``. All four layouts come down to one walk in document order that yields events;
what differs is how an element names its speaker and where its text stands:

* nested layout (2.0 and 2.1): speeches hold a ``talk.start`` and, inside, interjections and continuations;
* running layout (2.2): a ``talk.text`` of paragraphs in which typed anchors change the speaker;
* committee layout: paragraphs whose anchors or spans name a member, an office or a witness, or talks with a name block;
* capital-letter layout (older records): attributes name the speaker.
"""

from __future__ import annotations

import html
import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

TURNS = "path string, date string, order int, row_type string, name string, name_id string, party string, place string, time_stamp string, page_no int, in_gov int, first_speech int, question int, answer int, q_in_writing int, div_flag int, section int, body string, error string"
COMMITTEE = "path string, order int, name string, name_id string, witness_flag int, page_no int, committee_name string, portfolio string, panel_no int, time_stamp string, body string, error string"
TOPICS = "path string, date string, section int, order int, level int, debate_id string, parent_id string, topic string, cognate string, gvt_business int, error string"
DIVISIONS = "path string, date string, division_no int, question string, ayes_count int, noes_count int, result string, error string"
VOTES = "path string, date string, division_no int, name string, name_id string, vote string, error string"
HEADERS = "path string, version string, date string, parliament_no string, session_no string, period_no string, chamber string, page_no string, proof string, error string"

#: What an anchor's type says of the turn it starts.
ANCHORS = {
    "MemberSpeech": "speech", "OfficeSpeech": "speech", "MemberContinuation": "continue", "MemberInterjecting": "interjection",
    "OfficeInterjecting": "interjection", "MemberQuestion": "question", "MemberAnswer": "answer",
}
SPEECHES = ("speech", "question", "answer", "interjection", "continue")
STAGES = {"division": "division", "motionnospeech": "stage_direction", "adjournment": "stage_direction", "petition": "petition", "petition.group": None}
DIRECTION = ("HPS-DivisionPreamble", "HPS-DivisionFooter")
SKIPPED = ("HPS-Line", "HPS-SODJobDate")
SPEAKER = tuple(f"HPS-{k}" for k in ANCHORS) + ("HPS-Electorate", "HPS-MinisterialTitles", "HPS-Time")
WRITTEN = re.compile("(?i)questions? (?:on notice|in writing)|answers to questions")
BUSINESS = re.compile("(?i)bill|budget|appropriation|legislation")


def text_of(e: ET.Element | None, skip: Callable[[ET.Element], bool] = lambda e: False) -> str:
    """All text below an element in order; of skipped elements only what follows them."""
    if e is None:
        return ""
    parts: list[str] = []

    def walk(x: ET.Element) -> None:
        parts.append(x.text or "")
        for c in x:
            if not skip(c):
                walk(c)
            parts.append(c.tail or "")

    walk(e)
    return re.sub(r"[ \t\r\f\v]+", " ", "".join(parts)).strip()


def child_text(e: ET.Element | None, *names: str) -> str | None:
    """The text of the first named child that has any; a child without children counts like any other."""
    for n in names:
        c = e.find(n) if e is not None else None
        if c is not None and text_of(c):
            return text_of(c)
    return None


def number(s: str | None) -> int | None:
    return int(s) if s and re.fullmatch(r"\d+", s.strip()) else None


def sitting_date(root: ET.Element, path: str) -> str | None:
    """From the header, the day's start, the job date, else the file's name."""
    found = root.findtext(".//session.header/date") or next((e.get("date") for e in root.iter("day.start") if e.get("date")), None) or next((text_of(p) for p in root.iter("p") if "HPS-SODJobDate" in p.get("class", "")), None)
    day = re.search(r"\d{4}-\d{2}-\d{2}", found or "") or re.search(r"\d{4}-\d{2}-\d{2}", path.rpartition("/")[2])
    return day[0] if day else None


def _talker(e: ET.Element) -> dict:
    """Who speaks: children of ``talk.start/talker``, else attributes in capital letters."""
    t = e.find("talk.start/talker")
    name = child_text(t, "name[@role='display']", "name")
    surname = re.match(r"(.+?), (Sen|Mr|Mrs|Ms|Dr)\b\.?\s*(.*)", name or "")
    if surname:
        name = f"{ {'Sen': 'Senator'}.get(surname[2], surname[2]) } {surname[1].upper()}"
    capital = lambda *k: next((e.get(x).strip() for x in k if (e.get(x) or "").strip()), None)
    flag = lambda v: 1 if (v or "").strip() == "1" else 0
    return {
        "name": name or capital("SPEAKER"),
        "name_id": (child_text(t, "name.id") or capital("NAMEID") or "").upper() or None,
        "party": child_text(t, "party") or capital("PARTY"),
        "place": child_text(t, "electorate", "state") or capital("ELECTORATE", "STATE"),
        "time_stamp": child_text(t, "time.stamp"),
        "page_no": number(child_text(t, "page.no")) or number(capital("PAGE")),
        "in_gov": flag(child_text(t, "in.gov") or capital("GOV")),
        "first_speech": flag(child_text(t, "first.speech")),
    }


def _paragraph(p: ET.Element) -> str:
    """Body of a paragraph of the running layout: the speaker's marks go, what follows them stays."""
    body = text_of(p, lambda e: e.get("class", "") in SPEAKER or e.get("type", "") in ANCHORS)
    return re.sub(r"^[\s:—\-()]+", "", body)


def _running(e: ET.Element, who: dict) -> Iterator[dict]:
    """Turns of a running text: anchors end a turn that has a body and start the next."""
    now, body = who | {"row_type": "speech"}, []
    for p in e.iter("p"):
        kind = p.get("class", "")
        if any(k in kind for k in SKIPPED):
            continue
        if any(k in kind for k in DIRECTION):
            if body:
                yield now | {"body": "\n\n".join(body)}
                body = []
            if text_of(p):
                yield {"row_type": "stage_direction", "name": "stage direction", "body": text_of(p)}
            continue
        for a in p.iter("a"):
            if a.get("type") in ANCHORS:
                if body:
                    yield now | {"body": "\n\n".join(body)}
                    body = []
                clock = next((text_of(s) for s in p.iter("span") if "HPS-Time" in s.get("class", "")), None)
                now = {"row_type": ANCHORS[a.get("type")], "name": text_of(a).rstrip(":").strip() or who.get("name"), "name_id": (a.get("href") or "").strip().upper() or None, "time_stamp": clock.strip("()") if clock else None}
        if _paragraph(p):
            body.append(_paragraph(p))
    if body:
        yield now | {"body": "\n\n".join(body)}


def _turns(e: ET.Element, written: int, section: int) -> Iterator[dict]:
    """Turns below an element, in document order."""
    for c in e:
        tag = c.tag.lower() if isinstance(c.tag, str) else ""
        capital = isinstance(c.tag, str) and c.tag.isupper()
        if tag in ("interject",):
            tag = "interjection"
        if tag in ("fedchamb.xscript", "maincomm.xscript"):
            yield from _turns(c, written, 1)
        elif tag == "business.start":
            yield {"row_type": "business_start", "name": "business start", "body": text_of(c), "section": section}
        elif tag in ("debate", "subdebate.1", "subdebate.2", "answers.to.questions"):
            head = c.find("debateinfo") if c.find("debateinfo") is not None else c.find("subdebateinfo")
            topic = child_text(head, "title") or c.get("TITLE")
            on_notice = 1 if written or tag == "answers.to.questions" or WRITTEN.search(child_text(head, "type") or "") else 0
            if topic:
                yield {"row_type": "stage_direction", "name": "stage direction", "body": topic, "section": section}
            yield from _turns(c, on_notice, section)
        elif tag in SPEECHES:
            who = _talker(c)
            base = {"section": section, "q_in_writing": written}
            running = c.find("talk.text")
            if running is not None:
                first = True
                for row in _running(running, who):
                    kind = tag if first and row["row_type"] == "speech" else row["row_type"]
                    first = False
                    yield base | row | {"row_type": kind}
            else:
                nested = lambda x: isinstance(x.tag, str) and x.tag.lower() in (*SPEECHES, "interject", "talker", "debate", "subdebate.1", "subdebate.2")
                start = c.find("talk.start")
                parts = [x for x in (*(start if start is not None else ()), *c) if x is not start and not nested(x)]
                body = "\n\n".join(y for y in ((c.text or "").strip(), *(text_of(x, nested) for x in parts)) if y)
                body = re.sub(r"^[—\-]\s*", "", body)
                yield base | who | {"row_type": tag, "body": body}
                yield from _turns(c, written, section)
        elif tag in STAGES and STAGES[tag]:
            yield {"row_type": STAGES[tag], "name": "stage direction", "body": text_of(c), "section": section, "div_flag": int(tag == "division")}
        elif capital or tag not in ("debateinfo", "subdebateinfo", "talk.start", "session.header", "para", "p"):
            yield from _turns(c, written, section)


def turns(root: ET.Element, path: str) -> Iterator[dict]:
    day = sitting_date(root, path)
    for i, r in enumerate(_turns(root, 0, 0), 1):
        kind = r["row_type"]
        yield {"date": day, "order": i, "question": int(kind == "question"), "answer": int(kind == "answer"), "q_in_writing": 0, "div_flag": 0, "in_gov": 0, "first_speech": 0} | r


#: Ids that stand for no person in a talk.
NO_PERSON = ("10000", "unknown", "0", "")
#: A paragraph that only tells the time.
CLOCK = re.compile(r"(?i)\[?\(?\s*\d{1,2}[:.]\d{2}\s*(?:[ap]\.?m\.?)?\s*\)?\]?")


def talk(e: ET.Element) -> tuple[dict | None, list[str]]:
    """The speaker of a talk and its paragraphs, of the talk's start and after it; times and leading dashes go. No speaker without a name block."""
    talker = e.find("talk.start/talker")
    if talker is None:
        return None, []
    person, page = child_text(talker, "name.id"), child_text(talker, "page.no")
    who = {"name": child_text(talker, "name") or "", "name_id": None if (person or "") in NO_PERSON else person, "witness_flag": int(child_text(talker, "witness.data") == "1"), "page_no": int(page) if page and page.isdigit() else None}
    texts = (re.sub(r"^[\s:—–\-]+", "", text_of(x)) for x in (*e.findall("talk.start/para"), *e.findall("para")))
    return who, [t for t in texts if t and not CLOCK.fullmatch(t)]


def committee_turns(root: ET.Element, path: str) -> Iterator[dict]:
    """A member's anchor comes before an office, an office before a witness; text before the first speaker is dropped."""
    name = root.findtext(".//committee") or root.findtext(".//committee.name")
    order, panel, debate, portfolio, now, body = 0, 0, None, None, None, []

    def done() -> Iterator[dict]:
        nonlocal order
        if now and body:
            order += 1
            yield now | {"order": order, "committee_name": name, "portfolio": portfolio, "panel_no": panel, "body": "\n\n".join(body)}

    for e in root.iter():
        if e.tag in ("debate", "subdebate.1"):
            yield from done()
            now, body = None, []
            title = child_text(e.find("debateinfo"), "title") or child_text(e.find("subdebateinfo"), "title")
            debate = title if e.tag == "debate" else debate
            portfolio = debate if e.tag == "debate" else " — ".join(x for x in (debate, title) if x)
            panel += 1
        elif e.tag == "talk":
            yield from done()
            now, body = talk(e)
            yield from done()
            now, body = None, []
        elif e.tag == "p":
            who = None
            for a in e.iter("a"):
                if a.get("type") in ("MemberContinuation", "MemberWitness"):
                    who = {"name": text_of(a).rstrip(":").strip() or None, "name_id": (a.get("href") or "").strip().upper() or None, "witness_flag": 0}
            for kind, flag in (("HPS-Office", 0), ("HPS-Witness", 1)):
                s = next((s for s in e.iter("span") if s.get("class", "").startswith(kind)), None)
                if who is None and s is not None:
                    who = {"name": text_of(s).rstrip(":").strip(), "name_id": None, "witness_flag": flag}
            if who:
                yield from done()
                now, body = who, []
            t = re.sub(r"^[\s:—\-]+", "", text_of(e, lambda s: s.get("type", "").startswith("Member") or s.get("class", "").startswith(("HPS-Office", "HPS-Witness", "HPS-Time"))))
            if now and t and not re.fullmatch(r"\[?\(?\d{1,2}[:.]\d{2}\)?\]?", t):
                body.append(t)
    yield from done()


def topics(root: ET.Element, path: str) -> Iterator[dict]:
    """The tree of debates, numbered in order; ids hold the section, so that they are unique in a day."""
    day, order = sitting_date(root, path), 0

    def walk(e: ET.Element, level: int, parent: str | None, business: int, section: int) -> Iterator[dict]:
        nonlocal order
        for c in e:
            deeper = 1 if c.tag in ("fedchamb.xscript", "maincomm.xscript") else section
            if c.tag in ("debate", "subdebate.1", "subdebate.2"):
                head = c.find("debateinfo") if c.find("debateinfo") is not None else c.find("subdebateinfo")
                order += 1
                me = f"{day}_{section}_{order:04d}"
                kind = business if level else int(bool(BUSINESS.search(child_text(head, "type") or "")))
                yield {"date": day, "section": section, "order": order, "level": level, "debate_id": me, "parent_id": parent, "topic": child_text(head, "title", "cognate.title"), "cognate": child_text(head, "cognate.title"), "gvt_business": kind}
                yield from walk(c, level + 1, me, kind, section)
            else:
                yield from walk(c, level, parent, business, deeper)

    yield from walk(root, 0, None, 0, 0)


def _result(ayes: int, noes: int) -> str:
    return "aye" if ayes > noes else "noe" if noes > ayes else "tie"


def divisions(root: ET.Element, path: str) -> Iterator[dict]:
    """Votes are counted by their names; without names, by the figures in the text."""
    day = sitting_date(root, path)
    for i, d in enumerate(root.iter("division"), 1):
        whole = text_of(d)
        counts = []
        for side in ("ayes", "noes"):
            names = d.find(f".//{side}")
            said = re.search(rf"(?i){side[:-1]}s?[:\s]+(\d+)", whole)
            counts.append(len(names.findall(".//name")) if names is not None and names.find(".//name") is not None else int(said[1]) if said else 0)
        head = child_text(d, "division.header", "divisioninfo")
        said = re.search(r"(?is)(?:the question was|question)[—:\s]+(.+?)(?:\n|ayes|$)", whole)
        yield {"date": day, "division_no": i, "question": head or (said[1].strip() if said else None), "ayes_count": counts[0], "noes_count": counts[1], "result": _result(*counts)}


def votes(root: ET.Element, path: str) -> Iterator[dict]:
    """One row for each name under ayes, noes or pairs; in running layouts the last heading tells the side."""
    day = sitting_date(root, path)
    for i, d in enumerate(root.iter("division"), 1):
        side = None
        for e in d.iter():
            said = re.match(r"(?i)\s*(aye|noe|pair)s?\b", e.tag if e.tag in ("ayes", "noes", "pairs") else text_of(e) if e.tag == "p" else "")
            side = said[1].lower() if said else side
            named = e.tag == "name" or (e.tag == "a" and (e.get("name.id") or e.get("href")))
            if side and named and text_of(e):
                yield {"date": day, "division_no": i, "name": text_of(e), "name_id": ((e.get("name.id") or e.get("href") or e.get("nameid") or "").upper() or None), "vote": side}


def headers(root: ET.Element, path: str) -> Iterator[dict]:
    h = root.find(".//session.header")
    if h is None:
        yield {"error": "no session header"}
    else:
        yield {"version": root.get("version", "unknown"), "date": child_text(h, "date"), "parliament_no": child_text(h, "parliament.no"), "session_no": child_text(h, "session.no"), "period_no": child_text(h, "period.no"), "chamber": child_text(h, "chamber"), "page_no": child_text(h, "page.no"), "proof": child_text(h, "proof")}


#: A tag, a comment or declaration, or a text; a sign that opens nothing is text.
_PIECE = re.compile(r"<(?P<end>/)?(?P<tag>[A-Za-z_][\w.:-]*)(?P<rest>(?:\s+[\w.:-]+\s*=\s*(?:\"[^\"]*\"|'[^']*'))*)\s*(?P<empty>/)?>|<[!?][^>]*>|(?P<text>[^<]+|<)", re.S)
_ATTRIBUTE = re.compile(r"([\w.:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)')")


def recovered(content: bytes) -> ET.Element | None:
    """The tree of a file with errors: stray signs are text, an end closes what was opened inside, and ends that nothing opened are passed over."""
    text = re.sub("[\x00-\x08\x0b\x0c\x0e-\x1f]", "", content.decode("utf-8", "replace"))
    builder, open_, seen = ET.TreeBuilder(), [], False
    for m in _PIECE.finditer(text):
        if m["text"] is not None:
            if open_:
                builder.data(html.unescape(m["text"]))
        elif m["tag"] and m["end"]:
            while m["tag"] in open_:
                last = open_.pop()
                builder.end(last)
                if last == m["tag"]:
                    break
        elif m["tag"] and (open_ or not seen):
            seen = True
            builder.start(m["tag"], {k: html.unescape(x or y) for k, x, y in _ATTRIBUTE.findall(m["rest"])})
            if m["empty"]:
                builder.end(m["tag"])
            else:
                open_.append(m["tag"])
    for tag in reversed(open_):
        builder.end(tag)
    return builder.close() if seen else None


def tree(content: bytes) -> tuple[ET.Element, str | None]:
    """The root of a file and what is wrong with it; one that isn't well-formed is recovered, and one without any element raises."""
    try:
        return ET.fromstring(content), None
    except ET.ParseError as e:
        root = recovered(content)
        if root is None:
            raise
        return root, str(e)


TABLES: dict[str, tuple[Callable, str]] = {"turns": (turns, TURNS), "committee": (committee_turns, COMMITTEE), "topics": (topics, TOPICS), "divisions": (divisions, DIVISIONS), "votes": (votes, VOTES), "headers": (headers, HEADERS)}


def parse(files: DataFrame, what: str) -> DataFrame:
    """A table of :data:`TABLES` from rows of ``path`` and ``content`` (bytes)."""
    rows, schema = TABLES[what]
    empty = files.sparkSession.createDataFrame([], schema)
    fields = empty.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"string": pa.string(), "int": pa.int32()}
        for b in batches:
            out = []
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                try:
                    root, wrong = tree(content or b"")
                    found = [{"path": path} | r for r in rows(root, path or "")]
                    out += found or [{"path": path, "error": wrong}] * (wrong is not None)
                except ET.ParseError as e:
                    out.append({"path": path, "error": str(e)})
            yield pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in out], kinds[f.dataType.simpleString()]) for f in fields], [f.name for f in fields])

    return files.select("path", "content").mapInArrow(run, schema)


def read(spark: SparkSession, path: str, what: str) -> DataFrame:
    """A table from the XML files of a folder."""
    return parse(spark.read.format("binaryFile").option("pathGlobFilter", "*.xml").option("recursiveFileLookup", "true").load(path), what)
