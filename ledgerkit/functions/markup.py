"""Per-row markup helpers: the only Python that runs on workers for filings.

One pass over the events of a document; no tree is kept, so memory is bounded by the nesting
depth plus what is returned, time is linear, and nothing recurses.  ``parse_filing`` collects the
taxonomy references, contexts, units and facts of an inline-XBRL document, ``render_text`` its
plain text.  Interpretation (numbers, periods, picks, totals) happens in Spark.

Events come from the C parser; a document that it refuses is read again with the standard
library's lenient HTML parser, which closes implied and forgotten tags.  Names are lower-cased.

Most filings need no event in Python: a well-formed one that declares its namespaces at its root is
built as a tree by the C accelerator and read off it (``_from_tree``), with the same result in a
quarter of the time.  The tree is dropped with the document; every other document goes the way above.
"""
from __future__ import annotations

import re
import xml.etree.ElementTree as ET
import xml.parsers.expat as expat
from html.entities import name2codepoint
from html.parser import HTMLParser

# --- fixed values (namespaces of the public XBRL specifications) ------------
IX_NAMESPACES = ("http://www.xbrl.org/2013/inlinexbrl", "http://www.xbrl.org/2008/inlinexbrl")
XBRLI_NS = "http://www.xbrl.org/2003/instance"
LINK_NS = "http://www.xbrl.org/2003/linkbase"
XHTML_NS = "http://www.w3.org/1999/xhtml"
# -----------------------------------------------------------------------------

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that a new one of the same name closes where the end tag was left out.
_IMPLIED = frozenset("p li dt dd td th tr option".split())
_WS = re.compile(r"\s+")


class EmptyFiling(ValueError):
    """The document has no text or no element."""


class _Lenient(HTMLParser):
    """Events of an ill-formed document: every start has its end, stray ends are left out."""

    def __init__(self, sink):
        super().__init__(convert_charrefs=True)
        self.sink, self.open, self.count = sink, [], {}

    def handle_starttag(self, tag, attrs):
        if tag in _IMPLIED and self.open and self.open[-1] == tag:
            self._close()
        self.sink.start(tag, {k: v or "" for k, v in attrs})
        if tag in _VOID:
            self.sink.end()
        else:
            self.open.append(tag)
            self.count[tag] = self.count.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.sink.start(tag, {k: v or "" for k, v in attrs})
        self.sink.end()

    def _close(self):
        tag = self.open.pop()
        self.count[tag] -= 1
        self.sink.end()
        return tag

    def handle_endtag(self, tag):
        if self.count.get(tag):
            while self._close() != tag:
                pass

    def handle_data(self, data):
        self.sink.text(data)

    def close(self):
        super().close()
        while self.open:
            self._close()


def _feed(markup: str, make):
    """The sink that ``make`` gives, after all events of the document."""
    sink = make()
    p = expat.ParserCreate()
    p.buffer_text = True
    p.buffer_size = 1 << 16
    p.UseForeignDTD(True)
    p.ExternalEntityRefHandler = lambda *a: 1
    p.StartElementHandler = lambda tag, attrs: sink.start(tag.lower(), attrs)
    p.EndElementHandler = lambda tag: sink.end()
    p.CharacterDataHandler = sink.text
    p.SkippedEntityHandler = lambda name, is_pe: sink.text(
        chr(name2codepoint[name]) if name in name2codepoint else f"&{name};")
    try:
        p.Parse(markup, True)
        return sink
    except expat.ExpatError:
        sink = make()
        lenient = _Lenient(sink)
        lenient.feed(markup)
        lenient.close()
        return sink


# What is kept of an open element: the last visible character since its last child (or its start),
# that child's last visible character, the last one of all; namespaces in scope; what it fills.
_RUN, _CHILD, _ANY, _NS, _FILLS = range(5)


class _Facts:
    """Collects references, contexts, units and facts.

    The mark before a fact is the last visible character between it and the element before it in
    the same parent; with nothing visible there, the last one of that element.  The mark after it
    is the first visible character up to the end of the element after it, or of the parent.  Both
    fall out of the event order: what precedes is remembered at each open element, and a fact
    that has ended waits for the next visible character until one of those ends comes first."""

    def __init__(self):
        self.found = {"refs": [], "contexts": [], "units": [], "facts": []}
        self.open = [["", "", "", {"xml": "http://www.w3.org/XML/1998/namespace"}, None]]
        self.collecting: list[list[str]] = []  # text of the open elements whose text is wanted
        self.waiting: list[list] = []          # [fact, its parent's depth, is the next element open]
        self.context = self.unit = None
        self.elements = 0

    def start(self, tag, attrs):
        self.elements += 1
        above = self.open[-1]
        depth = len(self.open)
        for w in self.waiting:
            if w[1] == depth:
                w[2] = True
        ns = above[_NS]
        for k, v in attrs.items():
            if k[:5].lower() == "xmlns" and (len(k) == 5 or k[5] == ":"):
                if ns is above[_NS]:
                    ns = dict(ns)
                ns[k[6:].lower()] = v
        frame = ["", "", "", ns, None]
        prefix, _, name = tag.rpartition(":")
        uri = ns.get(prefix)
        if uri is not None and uri != XHTML_NS or name == "explicitmember":
            frame[_FILLS] = self._fills(name, uri, {k.lower(): v for k, v in attrs.items()}, frame, above)
        self.open.append(frame)

    def _fills(self, name, uri, attrs, frame, above):
        """(finisher, collected text) of an element that says something, else None."""
        if uri == LINK_NS and name == "schemaref":
            if attrs.get("xlink:href"):
                self.found["refs"].append(attrs["xlink:href"])
            return None
        if uri == XBRLI_NS and name == "context":
            self.context = {"context_id": attrs.get("id"), "identifier": None, "start_date": None, "end_date": None,
                            "instant": None, "dimensions": []}
            self.found["contexts"].append(self.context)
            return (self._end_context, None)
        if uri == XBRLI_NS and name == "unit":
            self.unit = {"unit_id": attrs.get("id"), "measure": None}
            self.found["units"].append(self.unit)
            return (self._end_unit, None)
        target = None
        if self.context is not None and name == "explicitmember":
            dim = {"dim": attrs.get("dimension", "").split(":")[-1], "member": None}
            self.context["dimensions"].append(dim)
            target = lambda text: dim.update(member=text.split(":")[-1])
        elif self.context is not None and uri == XBRLI_NS and name in _CONTEXT_FIELDS:
            own, key = self.context, _CONTEXT_FIELDS[name]
            target = lambda text: own.update({key: text})
        elif self.unit is not None and name == "measure":
            own = self.unit
            target = lambda text: own.update(measure=text)
        elif name in _FACT_KINDS and (uri or "").lower() in IX_NAMESPACES and attrs.get("name"):
            fact = self._fact(name, attrs, frame[_NS], above)
            target = lambda text: fact.update(raw_text=text)
            self.collecting.append([])
            return (target, self.collecting[-1], fact)
        if target is None:
            return None
        self.collecting.append([])
        return (target, self.collecting[-1])

    def _fact(self, name, attrs, ns, above):
        prefix, colon, concept = attrs["name"].partition(":")
        if not colon:
            prefix, concept = "", prefix
        fact = {"kind": _FACT_KINDS[name], "concept": concept, "namespace": ns.get(prefix.lower()), "raw_text": None,
                "scale": attrs.get("scale"), "sign": attrs.get("sign"), "context_ref": attrs.get("contextref"),
                "unit_ref": attrs.get("unitref"), "mark_before": above[_RUN] or above[_CHILD] or None, "mark_after": None}
        self.found["facts"].append(fact)
        return fact

    def _end_context(self, _):
        self.context = None

    def _end_unit(self, _):
        self.unit = None

    def text(self, data):
        for part in self.collecting:
            part.append(data)
        seen = data.strip()
        if seen:
            here = self.open[-1]
            here[_RUN] = here[_ANY] = seen[-1]
            if self.waiting:
                for w in self.waiting:
                    w[0]["mark_after"] = seen[0]
                self.waiting.clear()

    def end(self):
        frame = self.open.pop()
        depth = len(self.open)
        if self.waiting:  # the parent of a waiting fact ends, or the element after the fact
            self.waiting = [w for w in self.waiting if w[1] < depth or w[1] == depth and not w[2]]
        above = self.open[-1]
        above[_RUN], above[_CHILD] = "", frame[_ANY]
        above[_ANY] = frame[_ANY] or above[_ANY]
        fills = frame[_FILLS]
        if fills is not None:
            if fills[1] is None:
                fills[0](None)
            else:
                self.collecting = [c for c in self.collecting if c is not fills[1]]
                fills[0]("".join(fills[1]).strip())
                if len(fills) == 3:
                    self.waiting.append([fills[2], depth, False])


_CONTEXT_FIELDS = {"identifier": "identifier", "startdate": "start_date", "enddate": "end_date", "instant": "instant"}
_FACT_KINDS = {"nonfraction": "nonFraction", "nonnumeric": "nonNumeric"}


class _Unusual(ValueError):
    """A document for the event reader."""


#: What comes before the root element (no entity declarations), and the root's start tag.
_ROOT = re.compile(r"(?s)\ufeff?(<\?xml\s.*?\?>)?((?:\s|<\?.*?\?>|<!--.*?-->|<![Dd][Oo][Cc][Tt][Yy][Pp][Ee][^>\[]*>)*+)"
                   r"<[^\s/>!?]++((?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+)>")
_ATTRIBUTE = re.compile(r"([^\s=\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)')")
_NAMED = {name: chr(c) for name, c in name2codepoint.items()}
#: What an element says; up to _FACT none of these is expected inside a context or unit.
_REF, _CONTEXT, _UNIT, _FACT, _MEMBER, _MEASURE, _FIELD, _OTHER = range(8)


def _root_namespaces(markup: str) -> tuple[dict, re.Match]:
    """Lower-cased prefixes in scope of the whole document, and the match of its head."""
    head = _ROOT.match(markup)
    if head is None:
        raise _Unusual
    ns, declared = {"xml": "http://www.w3.org/XML/1998/namespace"}, 0
    for k, double, single in _ATTRIBUTE.findall(head[3]):
        if k[:5].lower() == "xmlns" and (len(k) == 5 or k[5] == ":"):
            uri, declared = double or single, declared + 1
            if not uri or "&" in uri or k[6:].lower() in ns:
                raise _Unusual
            ns[k[6:].lower()] = uri
    if markup.lower().count("xmlns") != declared:  # others further down, or the word in a text
        raise _Unusual
    return ns, head


def _kind(tag: str) -> tuple[int, str]:
    """What an element says, and its local name (of a fact: its kind, of a context's field: its key)."""
    uri, _, name = tag[1:].rpartition("}") if tag[0] == "{" else (None, "", tag)
    name = name.lower()
    if ":" in name:
        raise _Unusual
    if name == "explicitmember":
        return _MEMBER, name
    if uri is None or uri == XHTML_NS:
        return _OTHER, name
    if uri == LINK_NS and name == "schemaref":
        return _REF, name
    if uri == XBRLI_NS and name in ("context", "unit"):
        return (_CONTEXT if name == "context" else _UNIT), name
    if uri == XBRLI_NS and name in _CONTEXT_FIELDS:
        return _FIELD, _CONTEXT_FIELDS[name]
    if name == "measure":
        return _MEASURE, name
    if name in _FACT_KINDS and uri.lower() in IX_NAMESPACES:
        return _FACT, _FACT_KINDS[name]
    return _OTHER, name


def _alone(element) -> str:
    """The text of an element without children."""
    if len(element):
        raise _Unusual
    return (element.text or "").strip()


def _mark_before(parent, before) -> str | None:
    seen = ((parent.text if before is None else before.tail) or "").strip()
    if not seen and before is not None:
        seen = (before.text or "").strip() if not len(before) else "".join(before.itertext()).strip()
    return seen[-1] if seen else None


def _mark_after(fact, after) -> str | None:
    seen = (fact.tail or "").strip()
    if not seen and after is not None:
        seen = next((t for t in map(str.strip, after.itertext()) if t), "")
    return seen[0] if seen else None


def _from_tree(markup: str, kinds: dict) -> dict:
    """What :class:`_Facts` finds, read off a tree; ``kinds`` keeps what is known of tags."""
    ns, head = _root_namespaces(markup)
    parser = ET.XMLParser()
    if "&" in markup:
        parser.entity.update(_NAMED)
        if "<!" not in head[2].replace("<!--", ""):  # names of HTML are known as if a foreign DTD had them
            at = head.end(1) if head[1] else 0
            parser.feed(markup[:at])
            parser.feed('<!DOCTYPE html SYSTEM "html">')
            markup = markup[at:]
    parser.feed(markup)
    root = parser.close()

    found = {"refs": [], "contexts": [], "units": [], "facts": []}

    def known(tag):
        if len(kinds) >= 4096:
            kinds.clear()
        kinds[tag] = _kind(tag)
        return kinds[tag]

    def attributes(el):
        attrs = {k.lower(): v for k, v in el.items()}
        if len(attrs) < len(el.attrib):
            raise _Unusual
        return attrs

    def attribute(el, name):
        only = el.attrib
        return only[name] if len(only) == 1 and name in only else attributes(el).get(name)

    def context(el):
        own = {"context_id": attribute(el, "id"), "identifier": None, "start_date": None, "end_date": None, "instant": None,
               "dimensions": []}
        found["contexts"].append(own)
        for part in el.iter():
            kind, name = kinds.get(part.tag) or known(part.tag)
            if kind == _FIELD:
                own[name] = _alone(part)
            elif kind == _MEMBER:
                own["dimensions"].append({"dim": (attribute(part, "dimension") or "").split(":")[-1],
                                          "member": _alone(part).split(":")[-1]})
            elif kind <= _FACT and part is not el:
                raise _Unusual

    def unit(el):
        own = {"unit_id": attribute(el, "id"), "measure": None}
        found["units"].append(own)
        for part in el.iter():
            kind = (kinds.get(part.tag) or known(part.tag))[0]
            if kind == _MEASURE:
                own["measure"] = _alone(part)
            elif kind <= _FACT and part is not el:
                raise _Unusual

    def reference(el):
        at = ns.get("xlink")
        if list(ns.values()).count(at) > 1:
            raise _Unusual
        href = attributes(el).get("{%s}href" % at.lower()) if at else None
        if href:
            found["refs"].append(href)

    def fact(el, parent, before):
        attrs = attributes(el)
        if not attrs.get("name"):
            return None
        prefix, colon, concept = attrs["name"].partition(":")
        if not colon:
            prefix, concept = "", prefix
        text = "".join(el.itertext()) if len(el) else el.text or ""
        own = {"kind": kinds[el.tag][1], "concept": concept, "namespace": ns.get(prefix.lower()), "raw_text": text.strip(),
               "scale": attrs.get("scale"), "sign": attrs.get("sign"), "context_ref": attrs.get("contextref"),
               "unit_ref": attrs.get("unitref"), "mark_before": _mark_before(parent, before), "mark_after": None}
        found["facts"].append(own)
        return own

    def walk(parent):
        before = waiting = None
        for el in parent:
            if waiting is not None:
                waiting["mark_after"] = _mark_after(before, el)
                waiting = None
            kind = (kinds.get(el.tag) or known(el.tag))[0]
            if kind == _CONTEXT:
                context(el)
            elif kind == _UNIT:
                unit(el)
            else:
                if kind == _FACT:
                    waiting = fact(el, parent, before)
                elif kind == _REF:
                    reference(el)
                if len(el):
                    walk(el)
            before = el
        if waiting is not None:
            waiting["mark_after"] = _mark_after(before, None)

    above = ET.Element("above")
    above.append(root)
    walk(above)
    return found


def _from_events(markup: str) -> dict:
    sink = _feed(markup, _Facts)
    if not sink.elements:
        raise EmptyFiling("no element in the document")
    return sink.found


def parse_filing(markup: str, kinds: dict | None = None) -> dict:
    """One filing -> {'refs': [...], 'contexts': [...], 'units': [...], 'facts': [...]}.

    Lists are in document order; nothing is interpreted beyond trimming.  A document without
    any element raises :class:`EmptyFiling`.  A task gives the same ``kinds`` for all its filings."""
    try:
        found = _from_tree(markup, {} if kinds is None else kinds)
    except (ET.ParseError, UnicodeError, RecursionError, _Unusual):  # very deep ones too
        found = _from_events(markup)
    place = {c["context_id"]: i for i, c in enumerate(found["contexts"])}  # of a repeated id the last one
    for fact in found["facts"]:
        fact["context_at"] = place.get(fact["context_ref"]) if fact["context_ref"] is not None else None
    return found


class _Text:
    """Collects the plain text; personal facts are blanked, style and script blocks dropped."""

    def __init__(self, hints):
        self.hints, self.out = hints, []
        self.space = [False]  # of each open element: is a space due before what follows its last child
        self.hidden = 0       # open elements inside a blanked or dropped one, itself included
        self.dropped = False

    def start(self, tag, attrs):
        if self.hidden:
            self.hidden += 1
            return
        if self.space[-1]:
            self.out.append(" ")
            self.space[-1] = False
        name = tag.rpartition(":")[2]
        if name in ("style", "script"):
            self.hidden, self.dropped = 1, True
        elif name in _FACT_KINDS:
            told = next((v for k, v in attrs.items() if k.lower() == "name"), "").split(":")[-1].lower()
            if any(h in told for h in self.hints):
                self.out.append("[redacted]")
                self.hidden, self.dropped = 1, False
        if not self.hidden:
            self.space.append(False)

    def end(self):
        if self.hidden:
            self.hidden -= 1
            if not self.hidden and not self.dropped:
                self.space[-1] = True
            return
        if self.space.pop():
            self.out.append(" ")
        self.space[-1] = True

    def text(self, data):
        if not self.hidden:
            self.out.append(data)


def render_text(markup: str, redact_hints) -> str:
    """Whole document -> plain text: style/script blocks dropped, personal facts blanked to
    ``[redacted]``, a space after every element, whitespace collapsed."""
    return _WS.sub(" ", "".join(_feed(markup, lambda: _Text(redact_hints)).out)).strip()
