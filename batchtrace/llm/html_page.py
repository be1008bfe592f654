"""A page's element tree, subtree hashes and main text.

A small tolerant reader: unknown or misplaced end tags are ignored, open
paragraphs, list items and table cells end where HTML says they do, raw text
elements (scripts, styles) end at their own end tag only, and quotes count after an
equals sign only. Once a quoted value never ends, quotes no longer count. Every step
is linear in the page, whatever is broken or nested in it, and nothing recurses.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import xxhash

# --- fixed values: HTML's element classes and usual names of page furniture ---
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset("""address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody
    tfoot thead tr ul""".split())
CLOSES_P = BLOCK - {"body", "html", "caption", "tbody", "tfoot", "thead", "tr"}
_CELLS = {"td", "th", "button", "object"}
#: Groups of open elements that a start tag may end: the elements, and those that shield them.
GROUPS = (({"p"}, _CELLS), ({"li"}, {"ul", "ol", "menu"} | _CELLS), ({"dt", "dd"}, {"dl"} | _CELLS),
          ({"tr", "td", "th"}, {"table"}), ({"td", "th"}, {"table", "tr"}), ({"option"}, {"select"}), ({"head"}, set()))
#: Start tag -> numbers of the groups that it ends.
ENDS = {tag: (0,) for tag in CLOSES_P} | {"li": (0, 1), "dt": (0, 2), "dd": (0, 2), "tr": (3,), "td": (4,), "th": (4,),
                                          "option": (5,), "body": (6,)}
FURNITURE_TAGS = frozenset("""aside button dialog footer form head iframe input label menu nav noembed noframes noscript
    object script select style svg template textarea title""".split())
#: Elements that hold blocks; inside an article only those made of links may be template.
BOXES = frozenset("""address aside center details dialog div dl fieldset figure footer form header menu nav ol section table
    ul""".split())
FURNITURE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
FURNITURE_NAMES = frozenset("""ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments
    consent cookie cookies disclaimer footer gdpr menu modal nav navbar navigation newsletter notice
    pagination pager popup promo promoted promotion related replies reply share sharing sidebar social sponsor sponsored
    subscribe toolbar widget""".split())
FURNITURE_HEADS = frozenset("header masthead".split())
#: Never furniture by their names alone inside an article.
PROSE = frozenset("h1 h2 h3 h4 h5 h6 p table caption thead tbody tfoot tr td th blockquote pre".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What text in these is, is no prose beside an article.
LISTED = frozenset("a li dt dd table h1 h2 h3 h4 h5 h6".split())
# -------------------------------------------------------------------------------

_TAG = re.compile(r"[a-zA-Z][^\s/>]*")
_TO_END = re.compile(r"""(?:[^>=]|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>""")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]\S*)))?""")
_NAME = re.compile(r"[a-zA-Z0-9]+")


class Element:
    __slots__ = ("tag", "parent", "parts", "names", "role", "hidden", "digest", "size", "links", "has_main", "has_title")

    def __init__(self, tag: str, parent: Element | None, attributes: str = ""):
        self.tag, self.parent = tag, parent
        self.parts: list[Element | str] = []
        self.names, self.role, self.hidden = "", "", False
        self.digest, self.size, self.links, self.has_main, self.has_title = 0, 0, 0, False, False
        if attributes:
            for key, a, b, c in _ATTRIBUTE.findall(attributes):
                key, value = key.lower(), (a or b or c)
                if key == "role":
                    self.role = value.strip().lower()
                elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                    self.hidden = True
                elif key == "class" or key == "id":
                    self.names += f" {value}"


class _Open:
    """The open elements, how many there are of each tag, and per group the outermost one in reach."""

    _MATTERS = frozenset().union(*(ended | shield for ended, shield in GROUPS))

    def __init__(self, root: Element):
        self.stack, self.reach, self.count = [root], [(0,) * len(GROUPS)], Counter()

    def push(self, e: Element) -> None:
        reach, at = self.reach[-1], len(self.stack)
        if e.tag in self._MATTERS:
            reach = tuple((r or at) if e.tag in ended else 0 if e.tag in shield else r
                          for r, (ended, shield) in zip(reach, GROUPS, strict=True))
        self.stack.append(e)
        self.reach.append(reach)
        self.count[e.tag] += 1

    def cut(self, at: int) -> None:
        self.count.subtract(e.tag for e in self.stack[at:])
        del self.stack[at:], self.reach[at:]

    def end(self, tag: str) -> bool:
        """Close the innermost open element of the tag, if there is one."""
        if self.count[tag] <= 0:
            return False
        at = len(self.stack) - 1
        while self.stack[at].tag != tag:
            at -= 1
        self.cut(at)
        return True

    def make_way(self, tag: str) -> None:
        """Close what a start tag ends."""
        if cuts := [r for g in ENDS.get(tag, ()) if (r := self.reach[-1][g])]:
            self.cut(min(cuts))


def parse(page: str) -> tuple[Element, list[Element]]:
    """The root and all elements, parents before children."""
    root = Element("#root", None)
    every, opened = [root], _Open(root)
    end, last, at, told = len(page), page.rfind(">"), 0, 0
    strict, cdata = True, True  # whether quoted values and CDATA sections still end

    def text(upto: int) -> None:
        if upto > told:
            opened.stack[-1].parts.append(page[told:upto])

    while (lt := page.find("<", at)) >= 0:
        at, kind = lt + 1, page[lt + 1:lt + 2]
        if kind == "!" and page.startswith("!--", at):
            close = page.find("-->", at + 3)
            text(lt)
            at = told = close + 3 if close >= 0 else end
            continue
        if lt > last:  # nothing ends any more
            continue
        if kind == "!" or kind == "?":
            section = cdata and page.startswith("![CDATA[", at)
            close = page.find("]]>", at) if section else -1
            cdata &= not section or close >= 0
            text(lt)
            if close >= 0:
                opened.stack[-1].parts.append(html.escape(page[at + 8:close]))
                at = told = close + 3
            else:
                at = told = page.find(">", at) + 1
            continue
        name = _TAG.match(page, at + (kind == "/"))
        if name is None:
            continue  # a sign, not a tag
        tag = name[0].lower()
        if kind == "/":
            text(lt)
            at = told = page.find(">", name.end()) + 1
            if not opened.end(tag) and tag == "br":
                opened.stack[-1].parts.append(" ")
            continue
        m = _TO_END.match(page, name.end()) if strict else None
        strict = m is not None
        close = m.end() - 1 if m else page.find(">", name.end())
        text(lt)
        at = told = close + 1
        opened.make_way(tag)
        element = Element(tag, opened.stack[-1], page[name.end():close])
        opened.stack[-1].parts.append(element)
        every.append(element)
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            element.parts.append(page[at:stop.start() if stop else end])
            at = told = stop.end() if stop else end
        elif tag not in VOID and page[close - 1] != "/":
            opened.push(element)
    text(end)
    return root, every


def measure(every: list[Element]) -> None:
    """Fills in digests, text sizes and the marks, from the leaves up."""
    for e in reversed(every):
        told = [e.tag, e.names]
        for part in e.parts:
            if isinstance(part, str):
                text = " ".join(part.split())
                if text:
                    told.append(text)
                    if e.tag not in RAW:
                        e.size += len(text)
            else:
                told.append(f"\x01{part.digest:016x}")
                if part.tag not in RAW:
                    e.size += part.size
                    e.links += part.links
                e.has_main |= part.has_main
                e.has_title |= part.has_title
        e.has_main |= e.tag in ("article", "main") or e.role == "main"
        e.has_title |= e.tag in HEADINGS
        if e.tag == "a":
            e.links = e.size
        e.digest = xxhash.xxh64_intdigest("\x02".join(told).encode("utf-8", "surrogatepass"))


def _signed(digest: int) -> int:
    return digest - (1 << 64) if digest >> 63 else digest


def _may_recur(e: Element, in_article: bool) -> bool:
    """Whether the element can be a site's template: prose inside an article never is."""
    if not e.size or e.tag in RAW or e.has_main or e.tag in ("#root", "html", "body", "head"):
        return False
    return not in_article or (e.tag in BOXES and 2 * e.links > e.size)


def _in_article(every: list[Element]) -> dict[Element, bool]:
    """Whether each element is, or lies inside, an article or the main part."""
    inside = {every[0]: False}
    for e in every[1:]:
        inside[e] = inside[e.parent] or e.tag in ("article", "main") or e.role == "main"
    return inside


def subtrees(page: str) -> set[int]:
    """Signed 64-bit hashes of the page's subtrees that may be template."""
    return set(content(page)[1])


def _furniture(e: Element, in_article: bool, template: frozenset[int]) -> bool:
    """Not article: hidden, recurring on the site, or furniture by element, role or name."""
    if e.tag in RAW or e.tag == "head" or e.hidden:
        return True
    if e.has_main:
        return False
    if _may_recur(e, in_article) and _signed(e.digest) in template:
        return True
    if e.tag in FURNITURE_TAGS or e.role in FURNITURE_ROLES:
        return True
    names = _names(e)
    if e.tag == "header" or not FURNITURE_HEADS.isdisjoint(names):  # an article's own heads hold its titles
        return not (in_article and (e.has_title or e.tag in PROSE))
    return not (in_article and e.tag in PROSE) and not FURNITURE_NAMES.isdisjoint(names)


def _names(e: Element) -> set[str]:
    return {x.lower() for x in _NAME.findall(e.names)} if e.names else set()


def _named(e: Element) -> bool:
    """Furniture by role or name."""
    names = _names(e)
    return e.role in FURNITURE_ROLES or not FURNITURE_NAMES.isdisjoint(names) or not FURNITURE_HEADS.isdisjoint(names)


def main_text(page: str, template: frozenset[int] = frozenset()) -> str:
    """Blocks of the main text, one a line; subtrees whose hash is in ``template`` are left out."""
    root, every = parse(page)
    measure(every)
    return _text(root, every, template)


def content(page: str) -> tuple[str, dict[int, bool]]:
    """The main text with no template known, and the hashes of the subtrees that may be template: whether each is a box."""
    root, every = parse(page)
    measure(every)
    inside = _in_article(every)
    return _text(root, every, frozenset()), {_signed(e.digest): e.tag in BOXES for e in every if _may_recur(e, inside[e])}


def _text(root: Element, every: list[Element], template: frozenset[int]) -> str:
    skipped = {root: False}
    article = _in_article(every)
    for e in every[1:]:
        skipped[e] = skipped[e.parent] or _furniture(e, article[e.parent], template)
    kept = [e for e in every[1:] if not skipped[e]]
    mains = _main_parts(root, kept)
    blocks, now = [], []

    def close() -> None:
        text = " ".join("".join(now).split())
        if text:
            blocks.append(text)
        now.clear()

    walk: list[tuple[Element, int]] = [(main, 0) for main in reversed(mains)]
    while walk:
        e, i = walk.pop()
        if i == len(e.parts):
            if e.tag in BLOCK:
                close()
            elif e.tag in ("td", "th"):
                now.append(" ")
            continue
        walk.append((e, i + 1))
        part = e.parts[i]
        if isinstance(part, str):
            now.append(html.unescape(part) if "&" in part else part)
        elif part.tag == "br":
            now.append(" ")
        elif part.tag in BLOCK and (skipped[part] or part.tag == "hr"):
            close()
        elif not skipped[part]:
            if part.tag in BLOCK:
                close()
            walk.append((part, 0))
    close()
    return "\n".join(blocks)


def _main_parts(root: Element, kept: list[Element]) -> list[Element]:
    """What holds the page's text: the articles of the main part (or of the page), or that part itself.

    An article made of links is a teaser, and one marked as a comment or inside
    furniture is read only where there is no other. Articles give way to what
    they lie in if more prose stands beside them than is in them; links, lists,
    tables and headings are no prose.
    """
    told = {e: sum(len(" ".join(x.split())) for x in e.parts if isinstance(x, str)) for e in (root, *kept)}
    length, marked, listed, holder = dict(told), {root: False}, {root: False}, {root: None}
    for e in reversed(kept):
        length[e.parent] += length[e]
    mains = [e for e in kept if e.tag == "main" or e.role == "main"]
    main = max(mains, key=length.get, default=root)
    main = main if length[main] else root
    tops, prose, inside = [], 0, {root: main is root}
    for e in kept:
        up = e.parent
        inside[e] = inside[up] or e is main
        marked[e] = e.tag not in ("body", "html") and (marked[up] or _named(e))
        listed[e] = listed[up] or e.tag in LISTED
        holder[e] = holder[up] or (e if e.tag == "article" else None)
        if e.tag == "article" and holder[e] is e and inside[e]:
            tops.append(e)
        if inside[e] and holder[e] is None and not listed[e] and not marked[e]:
            prose += told[e]
    prose += told[root] if main is root else 0
    stories = [e for e in tops if 2 * e.links <= e.size]
    articles = [e for e in stories if not marked[e]] or stories
    return articles if articles and sum(length[e] for e in articles) >= prose else [main]
