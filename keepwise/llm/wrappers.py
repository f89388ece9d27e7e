"""Main-text extraction by union-free regular-expression wrappers.

Pages of one host come from few templates. A page is read as a stream of block
tags and texts (inline tags are transparent). Aligning two streams resolves
each mismatch in one of three ways: differing texts become a slot, a run of
equal siblings becomes a repeated group, anything found on one side only
becomes optional. The result is a regular expression without unions, the
host's wrapper, which is aligned with the next page, and so on.

Alignment starts inside the map tasks: a task folds its pages of a host into
one wrapper, so only wrappers are shuffled, and they are merged in two steps
(salted, then per host). A host with a third of all pages sends one wrapper a
task. The wrapper then tells where the pages' own text is: its lowest elements
with all slot text outside menus, footers, adverts and the like. That place is
joined back to the pages by host and read there from each whole page.
"""

from __future__ import annotations

import html as entities
import json
import re
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import annotate, materialise, ready_workers

#: Wrappers of one host merged by one task first.
SALTS = 32
#: Hosts whose wrappers a map task holds at once.
HELD_HOSTS = 5000
#: Elements nested deeper belong to the last element that is not.
MAX_DEPTH = 120

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|</?[a-zA-Z][^>]*+>", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[a-z]+|[0-9]+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea title iframe svg math select object".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
                    "span strike strong sub sup time tt u var ruby rt rp nobr center".split())
#: An opening tag closes the open elements of these names, up to the nearest of the second group.
_CLOSES = {"li": ("li", "ul ol"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
           "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
_PARAGRAPH_ENDS = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header "
                            "hr main nav ol p pre section table ul details menu".split())
#: A headline is the page's own text, in a link or not.
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Never boilerplate, whatever their names.
_CONTAINERS = frozenset("page html body main article".split())
_BOILERPLATE_TAGS = frozenset("nav header footer aside form button dialog menu head fieldset".split()) | _RAW
_BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "notice notices gdpr newsletter subscribe subscription signup sidebar sidenav menu nav navbar navigation breadcrumb "
    "breadcrumbs header masthead topbar footer comment comments disqus reply replies respond related recommended share "
    "sharing social popup modal overlay widget widgets login search pagination pager toolbar alert "
    "complementary contentinfo".split())


def _label(tag: str, attributes: str) -> str:
    """Tag with the words of its class, id and role; digits are one sign."""
    if not attributes or "=" not in attributes:
        return tag
    words = [w if not w.isdigit() else "0" for m in _ATTRIBUTE.finditer(attributes)
             for w in _NAME.findall((m[2] or m[3] or m[4] or "").lower())]
    return ".".join([tag, *words])


def boilerplate(label: str) -> bool:
    """Whether tag or names suggest boilerplate; ``acquitted`` has the last word."""
    tag, *words = label.split(".")
    if tag in _CONTAINERS:
        return False
    return tag in _BOILERPLATE_TAGS or not _BOILERPLATE_NAMES.isdisjoint(words) or "hidden" in words


class Element:
    """Block element: its children are elements and (text, in a link) pairs."""

    __slots__ = ("label", "tag", "children")

    def __init__(self, label: str, tag: str):
        self.label, self.tag, self.children = label, tag, []


def parse(page: str) -> Element:
    """Tree of the page's block elements; tolerant of missing and stray tags."""
    root = Element("page", "page")
    stack, links, at, n = [("page", root)], 0, 0, len(page)

    def close(names, until=()):
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                del stack[i:]
                return
            if stack[i][0] in until:
                return

    while at < n:
        start = page.find("<", at)
        match = _TOKEN.match(page, start) if start >= 0 else None
        end = n if start < 0 else start if match else start + 1
        if end > at:
            stack[-1][1].children.append((page[at:end], links > 0))
        if not match:
            at = end
            continue
        at = match.end()
        if match[0].startswith("<![CDATA["):
            stack[-1][1].children.append((entities.escape(match[0][9:].removesuffix("]]>")), links > 0))
        if match[2] is None:
            continue
        tag, closing = match[2].lower(), bool(match[1])
        if tag in _RAW and not closing and not match[3].endswith("/"):
            stop = re.compile(rf"</{re.escape(tag)}\b[^>]*+>?", re.I).search(page, at)
            at = stop.end() if stop else n
        elif tag in ("br", "wbr", "hr"):
            stack[-1][1].children.append((" " if tag != "wbr" else "", False))
        elif tag == "a":
            links = max(0, links + (-1 if closing else 1))
        elif tag in _VOID or tag in _INLINE or tag in _RAW:
            continue
        elif closing:
            close((tag,))
            links = 0
        else:
            if tag in _CLOSES:
                names, until = _CLOSES[tag]
                close(names.split(), until.split())
            if tag in _PARAGRAPH_ENDS:
                close(("p",), ("td", "li", "div", "article", "section"))
            if len(stack) > MAX_DEPTH:
                stack[-1][1].children.append((" ", False))
                stack.append((tag, stack[-1][1]))
                continue
            element = Element(_label(tag, match[3]), tag)
            stack[-1][1].children.append(element)
            if not match[3].endswith("/"):
                stack.append((tag, element))
    return root


# A wrapper item is a list: label, optional, repeated, children (None for a text),
# digest of the text ("" once it is a slot), characters, characters outside links,
# digest of all texts a page has here ("" once two pages differ), digest of the page ("" if seen on different ones).
LABEL, OPTIONAL, REPEATED, CHILDREN, DIGEST, CHARS, PROSE, HERE, PAGE = range(9)


def _digest(text: str) -> str:
    return blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


def _stream(element: Element, out: list[str]) -> list[str]:
    for child in element.children:
        if isinstance(child, tuple):
            out.append(child[0])
        else:
            out.append(f"<{child.label}>")
            _stream(child, out)
    return out


def wrapper_of(element: Element, page: str = "") -> list:
    """The wrapper of one page or element: its own stream with runs folded."""
    page = page or _digest("".join(_stream(element, [])))
    items, text, prose = [], [], 0
    for child in [*element.children, None]:
        if isinstance(child, tuple):
            text.append(child[0])
            prose += 0 if child[1] and element.tag not in _HEADINGS else len(child[0].strip())
            continue
        own = "".join(text).strip()
        if own:
            made = _digest(own)
            items.append(["#", 0, 0, None, made, len(own), min(prose, len(own)), made, page])
        text, prose = [], 0
        if child is not None:
            items.append(wrapper_of(child, page))
    return [element.label, 0, 0, fold(items), "", 0, 0, "", ""]


def fold(items: list) -> list:
    """Runs of equal neighbours, or of equal pairs and triples, as repeated groups."""
    out: list = []
    for item in items:
        out.append(item)
        for width in (1, 2, 3):
            a, b = out[-2 * width : -width], out[-width:]
            if len(a) == width and width > 1 and len({x[LABEL] for x in b}) == 1:
                continue
            if len(a) == width and [x[LABEL] for x in a] == [x[LABEL] for x in b] and (
                    width == 1 or any(x[CHILDREN] is not None for x in a)):
                both = [merge(x, y, siblings=True) for x, y in zip(a, b)]
                out[-2 * width :] = [[*x[:REPEATED], 1, *x[CHILDREN:]] for x in both]
                break
    return out


def merge(a: list, b: list, siblings: bool = False) -> list:
    """Align two wrapper items of equal label, of different pages or ``siblings``
    in the same pages: differing siblings are no sign that the text varies."""
    flags = [a[LABEL], a[OPTIONAL] | b[OPTIONAL], a[REPEATED] | b[REPEATED]]
    if a[CHILDREN] is None:
        same = a[DIGEST] if a[DIGEST] == b[DIGEST] else ""
        here = a[HERE] if a[HERE] == b[HERE] else _digest(a[HERE] + b[HERE]) if siblings and a[HERE] and b[HERE] else ""
        page = a[PAGE] if a[PAGE] == b[PAGE] else ""
        return [*flags, None, same, a[CHARS] + b[CHARS], a[PROSE] + b[PROSE], here, page]
    return [*flags, align(a[CHILDREN], b[CHILDREN], siblings), "", 0, 0, "", ""]


def align(a: list, b: list, siblings: bool = False) -> list:
    """Longest common subsequence of the labels; matched items are merged,
    others become optional, and what then repeats is folded."""
    if [x[LABEL] for x in a] == [x[LABEL] for x in b]:
        return [merge(x, y, siblings) for x, y in zip(a, b)]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = (best[i + 1][j + 1] + 1 if a[i][LABEL] == b[j][LABEL]
                          else max(best[i + 1][j], best[i][j + 1]))
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i][LABEL] == b[j][LABEL]:
            out.append(merge(a[i], b[j], siblings))
            i, j = i + 1, j + 1
        elif j == len(b) or (i < len(a) and best[i + 1][j] >= best[i][j + 1]):
            out.append([a[i][LABEL], 1, *a[i][REPEATED:]])
            i += 1
        else:
            out.append([b[j][LABEL], 1, *b[j][REPEATED:]])
            j += 1
    return fold(out)


def slot_mass(item: list, slots_only: bool, kept: frozenset[str] = frozenset()) -> int:
    """Characters outside links and boilerplate (but for the ``kept`` labels) under
    an item. With ``slots_only`` texts that different pages have alike count 0,
    unless in an article or main element; a text of one page never does."""
    if item[CHILDREN] is None:
        return 0 if slots_only and item[HERE] and not item[PAGE] else item[PROSE]
    slots_only = slots_only and item[LABEL].split(".")[0] not in ("article", "main")
    hidden = boilerplate(item[LABEL]) and item[LABEL] not in kept
    return 0 if hidden else sum(slot_mass(x, slots_only, kept) for x in item[CHILDREN])


def acquitted(wrapper: list) -> frozenset[str]:
    """Labels that only look like boilerplate: those with at least half of the
    wrapper's slot text, and if what is then seen is less than half, also those
    with a tenth, at last all. Where no text differs between pages all texts
    count, and boilerplate tags (not names) are believed unless nothing else is there."""
    every = frozenset(_marked(wrapper, set()))
    slots_only = _varies(wrapper) and slot_mass(wrapper, True, every) > 0
    named = frozenset(x for x in every if x.split(".")[0] not in _BOILERPLATE_TAGS)
    # a slot in an advert alone does not make the text that all pages share boilerplate
    seen = slot_mass(wrapper, False)
    if slots_only and seen and not slot_mass(wrapper, True) and seen * 2 >= slot_mass(wrapper, False, named):
        return frozenset()
    for candidates in ([every] if slots_only else [named, every]):
        total = slot_mass(wrapper, slots_only, candidates)
        if not total:
            continue
        masses = _marked_masses(wrapper, slots_only, candidates)
        kept: frozenset[str] = frozenset()
        for parts in (2, 10, total):
            if slot_mass(wrapper, slots_only, kept) * 2 >= total:
                return kept
            kept = frozenset(x for x, mass in masses.items() if mass * parts >= total)
        return kept
    return frozenset()


def _varies(item: list) -> bool:
    """Whether any text differs between pages."""
    return not item[HERE] if item[CHILDREN] is None else any(map(_varies, item[CHILDREN]))


def _marked(item: list, out: set[str]) -> set[str]:
    """Labels under an item that look like boilerplate."""
    for x in item[CHILDREN] or []:
        if x[CHILDREN] is not None:
            if boilerplate(x[LABEL]):
                out.add(x[LABEL])
            _marked(x, out)
    return out


def _marked_masses(wrapper: list, slots_only: bool, candidates: frozenset[str]) -> dict[str, int]:
    """Slot text under the outermost elements of each candidate label."""
    masses: dict[str, int] = {}

    def visit(item, above, slots_only):
        if item[CHILDREN] is None:
            return slot_mass(item, slots_only)
        label = item[LABEL]
        if boilerplate(label) and label not in candidates:
            return 0
        slots_only = slots_only and label.split(".")[0] not in ("article", "main")
        mass = sum(visit(x, above | {label}, slots_only) for x in item[CHILDREN])
        if label in candidates and label not in above:
            masses[label] = masses.get(label, 0) + mass
        return mass

    visit(wrapper, frozenset(), slots_only)
    return masses


def main_place(wrapper: list) -> tuple[list[list[str]], list[str]]:
    """Paths (labels from the page down) of the elements that hold the main
    text: the lowest element with all of the slot text outside boilerplate, or,
    where only the body or page has all, each of its children that has some.
    Texts that do not differ between pages count too if no text does, and in an
    article or main element. Also the acquitted labels."""
    kept = acquitted(wrapper)
    slots_only = slot_mass(wrapper, True, kept) > 0

    def places(item, path):
        path = [*path, item[LABEL]]
        holding = [x for x in item[CHILDREN] if slot_mass(x, slots_only, kept) > 0]
        if any(x[CHILDREN] is None for x in holding) or not holding:
            return [path]
        if len(holding) == 1 and not holding[0][REPEATED]:
            return places(holding[0], path)
        if item[LABEL].split(".")[0] not in ("page", "html", "body"):
            return [path]
        # a repeated child is read whole wherever it stands
        return [p for x in holding for p in ([[*path, x[LABEL]]] if x[REPEATED] else places(x, path))]

    found = {tuple(p) for p in places(wrapper, [])}
    paths = sorted(list(p) for p in found if not any(p[:n] in found for n in range(1, len(p))))
    return paths, sorted(kept)


def _text(element: Element, kept: frozenset[str], out: list[str]) -> None:
    for child in element.children:
        if isinstance(child, tuple):
            out.append(child[0])
        elif child.label in kept or not boilerplate(child.label):
            out.append(" ")
            _text(child, kept, out)
            out.append(" ")


def _at(element: Element, paths: list[list[str]]) -> list[Element]:
    """The elements at the paths, in order of the page."""
    here = [p[1:] for p in paths if p[0] == element.label]
    if not here or not all(here):
        return [element] if here else []
    return [e for c in element.children if isinstance(c, Element) for e in _at(c, here)]


def main_text(page: str | None, place: tuple[list[list[str]], list[str]] | None) -> str:
    """Text of the page at the wrapper's places, or at those its own stream
    suggests if it has none of them."""
    if not page:
        return ""
    root = parse(page)
    paths, kept = place or ([], [])
    found = _at(root, paths)
    if not found:
        paths, kept = main_place(wrapper_of(root))
        found = _at(root, paths)
    out: list[str] = []
    for element in found:
        _text(element, frozenset(kept), out)
        out.append(" ")
    return " ".join(entities.unescape("".join(out)).split())


def _merged(wrappers: list[str]) -> str:
    made = None
    for w in sorted(set(wrappers)):
        made = json.loads(w) if made is None else merge(made, json.loads(w))
    return json.dumps(made, ensure_ascii=False, separators=(",", ":"))


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper) of pages (host, html)."""
    ready_workers(pages.sparkSession)
    names, schema = ["host", "wrapper"], "host string, wrapper string"

    def rows(held):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()),
             pa.array([json.dumps(w, ensure_ascii=False, separators=(",", ":")) for w in held.values()], pa.string())], names)

    def fold_pages(batches):
        held: dict[str, list] = {}
        for batch in batches:
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = wrapper_of(parse(page or ""))
                held[host] = merge(held[host], own) if host in held else own
                if len(held) >= HELD_HOSTS:
                    yield rows(held)
                    held = {}
        yield rows(held)

    def fold_group(table: pa.Table) -> pa.Table:
        return pa.table([table.column("host")[:1], pa.array([_merged(table.column("wrapper").to_pylist())], pa.string())],
                        names)

    parts = pages.select("host", "html").mapInArrow(fold_pages, schema)
    salted = parts.groupBy("host", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)).alias("salt")).applyInArrow(fold_group, schema)
    return salted.groupBy("host").applyInArrow(fold_group, schema)


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars (code points). Null html is empty
    and gives an empty text; a null or hostless url belongs to the host "".
    Repeated rows stay repeated; other columns are not read; pages are aligned
    whole, in time that grows with the product of their blocks; an empty table
    gives none."""
    host = F.coalesce(F.regexp_extract(F.lower("url"), r"^[a-z][a-z0-9+.-]*+://(?:[^/?#@]*+@)?([^/:?#]++)", 1), F.lit(""))
    own = pages.select("page_id", "url", "html", host.alias("host"))

    def places():
        def compute(wrappers):
            return [pa.array([json.dumps(main_place(json.loads(w))) for w in wrappers], pa.string())]

        return compute

    def texts():
        def compute(pairs):
            return [pa.array([main_text(p["html"], json.loads(p["place"]) if p["place"] else None) for p in pairs],
                             pa.string())]

        return compute

    field = lambda name: StructType([StructField(name, StringType())])
    where = materialise(annotate(infer_wrappers(own), "wrapper", field("place"), places, ["host"]), "places")
    pairs = own.join(where.withColumnRenamed("host", "of"), F.col("host") == F.col("of"), "left").select(
        "page_id", "url", F.struct("html", "place").alias("pair"))
    out = annotate(pairs, "pair", field("text"), texts, ["page_id", "url"])
    return out.withColumn("n_chars", F.length("text").cast("long"))
