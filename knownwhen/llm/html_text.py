"""Main text of web pages by tag-path ratios.

Every block of text belongs to the path of block-level tags from the root down to
it; inline tags don't count. For each path the page is summed up:

* the text ratio: characters per node of the path;
* the punctuation ratio: punctuation marks per node.

Both sequences, in the order in which paths first appear, are smoothed with a
Gaussian window, fused into one score (their product, times the spread of the text
lengths), and paths above a threshold relative to the best are content. The core of
the page is the smallest article, main or other container that holds the content
paths; all its blocks count, short ones too. The content area is the widest container
around it: the outermost article or main, or a node further up that has a heading
before it; the whole page if there is neither article nor main around the core. What
lies there beside the core counts, too, but for lists of links. Nodes that are by their tag, class, id or role
no main text (menus, headers, footers, sidebars, notices, adverts, forms, reader
comments) are never part of it, scripts and styles are no text at all. A name counts
as a whole ("sidebar", "sidebar-left", "menu-x", not "no-sidebar"), one with "comment" among
its words always ("user-comments-list"), and a mark doesn't hold for a node around the page's
text (``_release``). Comments without such a name are known by what they repeat: neighbouring
nodes of one tag, each with a line "Reply", or a list below a heading "Comments".

Defined results: null, empty and text-free pages have an empty text. Broken markup
is read as far as it goes: missing end tags end with their parent, stray ones are
passed over, an element that is never closed hides none of the page but unclosed code. Time
grows with the length of the page, whatever is in it. A page is one row; repeated rows are read each time.
"""

from __future__ import annotations

import html
import math
import re
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownwhen.llm import frames as fr
from knownwhen.llm import text as tx

#: Share of the best path's score from which a path is content.
THRESHOLD = 0.05
SMOOTH = (0.25, 0.5, 0.25)
#: Nodes nested deeper become siblings, as in browsers.
DEPTH = 512

_TAG = re.compile(
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)>")
_PLAIN_TAG_BEGIN = re.compile(r"<[/!?]?[a-zA-Z]")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
#: Elements whose content is no text of the page, up to their end tag; code goes on to the
#: body or the end of the page without one, of the others only the start tag is passed over.
_RAW = set("script style template noscript svg iframe textarea select title".split())
_CODE = {"script", "style"}
_RAW_END = re.compile(rf"</({'|'.join(sorted(_RAW))})(?=[\s/>])", re.I)
_BODY = re.compile(r"</head(?=[\s>])|<body(?=[\s>])", re.I)
_LABEL = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_HREF = re.compile(r"\bhref\b", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

_BLOCK = set("""address article aside blockquote body button caption center dd details dialog dir
div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main
menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul
""".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Tags that a start tag of the key ends, up to the nearest of the stops.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
    "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"})}
_LEAVES = set("p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote figcaption caption".split())
#: Tags and words of class, id and role of what is no main text.
_ASIDE_TAGS = set("nav footer aside form menu button dialog fieldset".split())
_ASIDE_WORDS = set("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs
comment comments complementary consent contentinfo cookie cookies disclaimer disqus footer form header
login masthead menu menubar modal nav navbar navigation newsletter notice notices notification pager
pagination popup promo promoted related replies reply respond search share sharing sidebar signup
skip social sponsor sponsored subscribe teaser toolbar tracking widget""".split())
#: Words that may stand beside those in one name: of place, of make, of the text it belongs to.
_BESIDE = set("""area articles bar block bottom box button buttons container global inner left
link links list main middle page post posts primary right secondary section site slot top unit
wrap wrapper article entry""".split())
#: Words of a name that say that something is there or not, of a node around all of it.
_STATES = set("no not has with without is hide show open opened closed enabled disabled on off".split())
#: Words of a name that reader comments have, whatever else it says.
_COMMENT_WORDS = set("comment comments commentlist disqus".split())
_COUNTS = set("count counts counter number link".split())
#: The line above reader comments, and the short lines that only they repeat.
_COMMENT_HEAD = re.compile(
    r"(?:\d+\s+|all\s+|reader(?:s|'s|s')?\s+|user\s+|leave a\s+|add a\s+|post a\s+)*"
    r"(?:comments?|replies|responses)\s*(?:\(\d+\)|:)?", re.I)
_REPLY = re.compile(r"(?:reply|quote|report|like|upvote|permalink|flag)(?:\s*\(?\d+\)?)?", re.I)
_OF_TEXT = set("article entry main page post".split())
#: Words that never name a node around other text than their own.
_ONLY_ASIDE = set("""ad ads advert adverts advertisement advertising breadcrumb breadcrumbs consent
contentinfo cookie cookies disqus menu menubar nav navbar navigation pager pagination""".split())
_PROSE = set("article main section p blockquote pre h1 h2 h3 h4 h5 h6".split())
_HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
_PUNCTUATION = set(string.punctuation) | set("。、，！？；：…«»“”„’–—¿¡")


class _Node:
    __slots__ = ("tag", "parent", "depth", "mark", "aside", "path", "inside", "mass", "articles",
                 "main", "prose")

    def __init__(self, tag: str, parent: _Node | None, attributes: str = ""):
        self.tag, self.parent, self.depth = tag, parent, parent.depth + 1 if parent else 0
        self.path = f"{parent.path}/{tag}" if parent else tag
        self.inside = parent is not None and (parent.inside or parent.tag in ("article", "main"))
        self.mark = _mark(tag, attributes, self.inside) if parent else ""
        self.aside = False
        self.mass, self.articles, self.main, self.prose = 0, 0, False, False


def _names(attributes: str) -> set[str]:
    """The words of those class, id and role names that say nothing else, "comments" for names
    with a word of reader comments in them, and "wrap" for those that begin like an aside."""
    words = set()
    for found in _LABEL.finditer(attributes):
        for name in (found[1] or found[2] or found[3] or "").split():
            line = _WORD.findall(_CAMEL.sub("-", name).lower())
            parts = {w for w in line if len(w) > 2 or w in _ASIDE_WORDS | _STATES}
            if parts & _STATES:
                continue
            if parts & _COMMENT_WORDS and not parts & _COUNTS:
                words.add("comments")
            elif parts <= _ASIDE_WORDS | _BESIDE:
                words |= parts & _ASIDE_WORDS - ({"header"} if parts & _OF_TEXT else set())
            elif line[0] in _ONLY_ASIDE:
                words.add("wrap")
    return words


def _mark(tag: str, attributes: str, inside: bool) -> str:
    """Why a node is no main text: hidden, comment, only (an aside of its own) or wrap (a mark
    that nodes around the text have, too); empty for all others."""
    if attributes and tag not in ("body", "html"):
        if _HIDDEN.search(attributes):
            return "hidden"
        words = _names(attributes)
        if words & _COMMENT_WORDS:
            return "comment"
        if inside:
            words.discard("header")
        if tag in ("article", "main"):
            words = set()
    else:
        words = set()
    if tag in _ASIDE_TAGS - {"form", "fieldset"} or words & _ONLY_ASIDE:
        return "only"
    return "wrap" if words or tag in _ASIDE_TAGS or tag == "header" and not inside else ""


def _mark_comments(found: list[tuple[_Node, str, int]]) -> None:
    """Mark reader comments that no name gives away: at least two neighbouring nodes of one tag
    below one parent, each with a short line like "Reply" of its own, or all that come after a
    heading "Comments" below its parent, if two or more of one tag do."""
    below: dict[int, list[_Node]] = {}  # the nodes with text under a node, in page order
    texts: dict[int, int] = {}
    seen: set[int] = set()
    replies: set[int] = set()
    headed: set[int] = set()
    heads: set[int] = set()

    def lines(node: _Node, marked: set[int]) -> None:
        while node.parent and id(node) not in marked:
            marked.add(id(node))
            node = node.parent

    for node, text, _ in found:
        texts[id(node)] = texts.get(id(node), 0) + 1
        if node.tag in _HEADINGS:
            lines(node, headed)
            if node.tag != "h1" and len(text) < 60 and _COMMENT_HEAD.fullmatch(text):
                heads.add(id(node))
        if len(text) < 40 and _REPLY.fullmatch(text) and node.parent:
            lines(node.parent if node.tag in _LEAVES else node, replies)
        while node.parent and id(node) not in seen:
            seen.add(id(node))
            below.setdefault(id(node.parent), []).append(node)
            node = node.parent
    for nodes in below.values():
        alike: dict[str, list[_Node]] = {}
        for n in nodes:
            if (id(n) in replies and id(n) not in headed and n.tag not in ("article", "main", "body")
                    and texts.get(id(n), 0) + len(below.get(id(n), ())) > 1):
                alike.setdefault(n.tag, []).append(n)
        for same in alike.values():
            if len(same) > 1:
                for node in same:
                    node.mark = node.mark or "comment"
        head = next((i for i, n in enumerate(nodes) if id(n) in heads), len(nodes))
        rest = nodes[head + 1:]
        tags = {n.tag for n in rest}
        if tags <= {"ul", "ol"} and len(rest) == 1 or (
                len(rest) > 1 and len(tags) == 1 and not tags & _LEAVES
                and not any(id(n) in headed for n in rest)):
            for node in nodes[head:]:
                node.mark = node.mark or "comment"


def _tags(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """Where each tag, comment or raw element begins and ends, its slash, name and attributes
    (no name for what is passed over). One pass: nothing is looked for again that wasn't found."""
    raw_ends: dict[str, list[int]] = {}
    for end in _RAW_END.finditer(page):
        raw_ends.setdefault(end[1].lower(), []).append(end.start())
    for ends in raw_ends.values():
        ends.reverse()
    last, quoted = page.rfind(">"), True

    def closed(at: int) -> int:
        return page.find(">", at) + 1 or len(page)

    at = page.find("<")
    while 0 <= at:
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4) + 3
            end = end if end > 2 else len(page)
            yield at, end, "", "", ""
        elif at > last:  # a tag that the page ends in
            if _PLAIN_TAG_BEGIN.match(page, at):
                yield at, len(page), "", "", ""
                return
            end = at + 1
        else:
            found = _TAG.match(page, at) if quoted else _PLAIN_TAG.match(page, at)
            if not found and page[at + 1:at + 2] in ("!", "?", "/"):
                end = closed(at)
                found = _PLAIN_TAG.match(page, at)
                yield at, end, *(("/", found[2].lower(), "") if found else ("", "", ""))
            elif not found and not page[at + 1:at + 2].isalpha():
                end = at + 1
            else:
                if not found:  # its quotes never end: from here on, tags end at the next >
                    quoted, found = False, _PLAIN_TAG.match(page, at)
                if not found:
                    at = page.find("<", at + 1)
                    continue
                end, tag = found.end(), found[2].lower()
                ends = raw_ends.get(tag, []) if tag in _RAW and not found[1] else None
                if ends is None:
                    yield at, end, found[1], tag, found[3]
                else:
                    while ends and ends[-1] < end:
                        ends.pop()
                    if ends:
                        end = closed(ends[-1])
                    elif tag in _CODE:
                        body = _BODY.search(page, end)
                        end = body.start() if body else len(page)
                    elif tag == "title":
                        end = page.find("<", end)
                        end = end if end >= 0 else len(page)
                    yield at, end, "", "", ""
        at = page.find("<", end)


def _release(nodes: list[_Node], found: list[tuple[_Node, str, int]]) -> None:
    """Set ``aside``: a node is one by its own mark or by that of a node around it. Marks don't
    hold for nodes

    * around the page's <main>;
    * that hold, with prose in them, more than half of the page's text (by length and
      punctuation; in its articles for a mark of an aside of its own);
    * around articles, if all such articles hold more than half of it;
    * with prose in them, if nothing but marked nodes has any.

    Outside of a <main>, only the first is looked at. Hidden nodes and reader comments stay.
    """
    dead: dict[int, str | None] = {}  # hidden, comments, and asides down to an article
    for node in nodes:
        above = node.parent and dead[id(node.parent)]
        ends = node.tag == "main" or node.tag == "article" and above == "only"
        own = node.mark if node.mark in ("hidden", "comment", "only") else ""
        dead[id(node)] = "hidden" if above == "hidden" else own or ("" if ends else above)
    for node, text, _ in found:
        if not dead[id(node)]:
            node.mass += len(text) * (1 + sum(map(text.count, _PUNCTUATION)))
    for node in reversed(nodes):
        node.main |= node.tag == "main" and node.mass > 0
        node.prose |= node.tag in _PROSE and node.mass > 0
        if node.tag == "article":
            node.articles = node.mass
        above = node.parent
        if above:
            above.mass += node.mass
            above.articles += node.articles
            above.main |= node.main
            above.prose |= node.prose
    total, has_main = nodes[0].mass, nodes[0].main
    in_main: set[int] = set()
    marked = []
    for node in nodes:
        if node.tag == "main" and node.mass or node.parent and id(node.parent) in in_main:
            in_main.add(id(node))
        if not node.mark or node.mark == "hidden":
            continue
        if node.main:
            node.mark = ""
        elif node.mark != "comment" and (id(node) in in_main or not has_main):
            share = node.mass if node.mark == "wrap" and node.prose else node.articles
            if 2 * share > total:
                node.mark = ""
            else:
                marked.append(node)

    def settle() -> None:
        for node in nodes:
            node.aside = bool(node.mark) or node.parent is not None and node.parent.aside

    settle()
    tops = [n for n in marked if n.articles and not n.parent.aside]
    if 2 * sum(n.articles for n in tops) > total:
        for node in marked:
            node.mark = "" if node.articles else node.mark
        settle()
    if all(node.aside for node, _, _ in found):
        for node in marked:
            node.mark = "" if node.mark == "wrap" and node.prose else node.mark
        settle()


def blocks(page: str) -> list[tuple[_Node, str, int]]:
    """The blocks of text in page order, each with its innermost block-level node and, if it is
    mostly links, their number."""
    root = _Node("", None)
    at, out, held, nodes = root, [], [], [root]
    link: _Node | None = None  # the node in which a link has begun
    linked: list[str] = []
    links = 0

    def end_block() -> None:
        nonlocal links
        if held:
            words = " ".join(html.unescape("".join(held)).split())
            most = linked and 2 * len("".join("".join(linked).split())) >= len("".join(words.split()))
            held.clear()
            linked.clear()
            if words:
                out.append((at, words, max(1, links) if most else 0))
        links = 0

    place = 0
    for begin, end, slash, tag, attributes in _tags(page):
        if begin > place:
            held.append(page[place:begin])
            if link:
                linked.append(held[-1])
        place = end
        if not tag:
            continue
        if tag in _VOID:
            if tag in ("br", "hr"):
                held.append(" ")
            continue
        if tag == "a":
            link = at if not slash and _HREF.search(attributes) else None
            links += link is not None
        if tag not in _BLOCK:
            continue
        end_block()
        if slash:
            node = at
            while node and node.tag != tag:
                node = node.parent
            if node:
                at = node.parent
                link = link if link and link.depth <= at.depth else None
            continue
        if tag in ("html", "body"):
            node = at
            while node and node.tag != tag:
                node = node.parent
            if node:
                continue
        if at.tag == "p":
            at = at.parent
        elif tag in _ENDS:
            ended, stops = _ENDS[tag]
            node, last = at, None
            while node and node.tag not in stops:
                if node.tag in ended:
                    last = node
                node = node.parent
            if last:
                at = last.parent
        elif tag[0] == "h" and tag[1:].isdigit() and at.tag[:1] == "h" and at.tag[1:].isdigit():
            at = at.parent
        link = link if link and link.depth <= at.depth else None
        if at.depth >= DEPTH:
            at = at.parent
            link = link if link and link.depth <= at.depth else None
        at = _Node(tag, at, attributes)
        nodes.append(at)
    if place < len(page):
        held.append(page[place:])
        if link:
            linked.append(held[-1])
    end_block()
    _mark_comments(out)
    _release(nodes, out)
    return out


def path_scores(found: list[tuple[_Node, str, int]]) -> dict[str, float]:
    """The fused, smoothed score of every tag path."""
    texts: dict[str, list[int]] = {}
    marks: dict[str, int] = {}
    nodes: dict[str, set[int]] = {}
    for node, text, _ in found:
        texts.setdefault(node.path, []).append(len(text))
        marks[node.path] = marks.get(node.path, 0) + sum(map(text.count, _PUNCTUATION))
        nodes.setdefault(node.path, set()).add(id(node))
    paths = list(texts)
    text_ratio = [sum(texts[p]) / len(nodes[p]) for p in paths]
    mark_ratio = [(1 + marks[p]) / len(nodes[p]) for p in paths]

    def smoothed(x: list[float]) -> list[float]:
        wide = [x[0], *x, x[-1]]
        return [sum(w * wide[i + k] for k, w in enumerate(SMOOTH)) for i in range(len(x))]

    if not paths:
        return {}
    score = {}
    for p, a, b in zip(paths, smoothed(text_ratio), smoothed(mark_ratio)):
        mean = sum(texts[p]) / len(texts[p])
        spread = math.sqrt(sum((n - mean) ** 2 for n in texts[p]) / len(texts[p]))
        score[p] = a * b * (1 + spread) * math.log1p(sum(texts[p]))
    return score


def _ancestors(node: _Node) -> list[_Node]:
    out = []
    while node:
        out.append(node)
        node = node.parent
    return out[::-1]


def main_text(page: str | None, threshold: float = THRESHOLD) -> str:
    if not page:
        return ""
    found = [block for block in blocks(page) if not block[0].aside]
    score = path_scores(found)
    if not score:
        return ""
    least = threshold * max(score.values())
    chosen = [_ancestors(node) for node, _, _ in found if score[node.path] >= least]
    core = chosen[0]
    for line in chosen[1:]:
        same = 0
        while same < min(len(core), len(line)) and core[same] is line[same]:
            same += 1
        core = core[:same]
    named = [i for i, node in enumerate(core) if node.tag in ("article", "main")]
    if named:
        core = core[:named[-1] + 1]
    elif core[-1].tag in _LEAVES and len(core) > 1:
        while len(core) > 1 and core[-1].tag in _LEAVES:
            core = core[:-1]
    return "\n\n".join(_area(found, core, named[0] if named else 0))


def _area(found: list[tuple[_Node, str, int]], core: list[_Node], level: int) -> list[str]:
    """The texts of the widest container around the core, without the lists of links beside the
    core. It is the node of the core's line at ``level``, or one above it that has a heading
    before that node."""
    # Per node: where it leaves the core's line, what it belongs to there, if it is a heading.
    known: dict[int, tuple[int, int, bool]] = {id(n): (i, 0, False) for i, n in enumerate(core)}
    at: list[tuple[int, int, bool]] = []
    links: dict[int, int] = {}
    for number, (node, _, n) in enumerate(found):
        up = []
        while id(node) not in known:
            up.append(node)
            node = node.parent
        for node in reversed(up):
            place, part, heading = known[id(node.parent)]
            known[id(node)] = (place, part or id(node), heading or node.tag in _HEADINGS)
        place, part, heading = known[id(node)]
        at.append((place, part or -1 - number, heading))
        links[at[-1][1]] = links.get(at[-1][1], 0) + n
    begin = next(i for i, (place, _, _) in enumerate(at) if place >= level)
    above = [place for (place, _, heading), block in zip(at[:begin], found)
             if heading and not block[2]]
    level = min([level, *above])
    return [text for (place, part, _), (_, text, n) in zip(at, found)
            if place >= level and (place == len(core) - 1 or not n or links[part] < 2)]


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html", threshold: float = THRESHOLD) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages``."""
    fr.bounded_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in tx.slices(batches, 128):
            texts = [main_text(page, threshold) for page in rows["html"]]
            yield pa.RecordBatch.from_arrays([
                pa.array(rows["page_id"], pa.int64()), pa.array(rows["url"], pa.string()),
                pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"),
                        F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
