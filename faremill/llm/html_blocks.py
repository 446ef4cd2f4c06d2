"""Split a page into text blocks, each with the generalised path of the element that holds it."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

# fixed values: element names by role
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article body center div main section td table blockquote".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
JUNK_TAGS = frozenset("nav footer aside form head menu dialog button select option svg canvas object audio video math map".split())
JUNK_ROLES = frozenset("navigation banner complementary contentinfo search form alert alertdialog dialog menu menubar toolbar".split())
# fixed values: words and parts of words in class and id that mark what isn't the article
JUNK_WORDS = frozenset(
    "ad ads adv advert adverts banner comment comments cookie cookies consent dfp disclaimer footer header masthead menu "
    "modal nav notice notices notification pager pagination pagetop popup promo promos promoted related reply replies "
    "respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget widgets alert gdpr login "
    "search skip teaser teasers topbar breadcrumb breadcrumbs discussion disqus".split()
)
# fixed values: names of what readers write, which may well be longer than the article
TALK = re.compile(r"comment|discussion|disqus|repl(?:y|ies)|respond")
JUNK_PARTS = re.compile(
    r"sidebar|advert|breadcrumb|comment|newsletter|cookie|footer|navbar|navigation|topnav|mainnav|menu|masthead|promo|sponsor|paginat"
)
# fixed values: what is or isn't beside the element, so not a name of its own ('no-sidebar')
_FLAGS = re.compile(r"\b(?:no|with|without|has)[-_][\w-]+", re.IGNORECASE)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
_BARE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_TAG_START = re.compile(r"<[a-zA-Z/!?]")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
# elements that a page may leave out, so its host's pages differ in them
OPTIONAL = frozenset(("html", "body", "tbody"))
#: Levels that a path names, and names of junk that are told apart inside each other; what lies deeper counts as its
#: ancestor there.
DEEPEST, NESTED = 100, 10
_WORDS = re.compile(r"[a-z]+")
_HUMPS = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Block:
    """A run of text without a block boundary inside: its container's path, text, characters in links, whether a title."""

    path: str
    text: str
    link_chars: int = 0
    title: bool = False


@dataclass
class _Open:
    tag: str
    path: str
    junk: bool
    heading_only: bool = False
    names: tuple[int, ...] = ()
    holder: str = ""  # path of the nearest container
    title: bool = False  # inside a title
    article: bool = False  # inside an article or main element
    depth: int = 0


@dataclass
class _Name:
    """An element that its class or id marks as junk: its text, and whether it may hold the whole page."""

    talk: bool
    chars: int = 0
    holds_page: bool = False
    prose: bool = False  # a paragraph of an article
    link_chars: int = 0


@dataclass
class _Run:
    path: str
    title: bool
    parts: list[tuple[str, bool, tuple[int, ...]]] = field(default_factory=list)


def attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), unescape(double or single or bare))
    return found


def class_words(value: str) -> list[str]:
    """Words of a class or id: letters only, so that counters and generated parts vanish."""
    return _WORDS.findall(_HUMPS.sub(" ", value).lower())


def marks_junk(tag: str, attrs: dict[str, str]) -> bool:
    """Whether the element is junk by what it is, in itself and in all that it holds."""
    if tag in JUNK_TAGS or attrs.get("role", "").lower() in JUNK_ROLES:
        return True
    if "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return True
    return "display:none" in attrs.get("style", "").replace(" ", "").lower()


def junk_name(tag: str, attrs: dict[str, str]) -> str:
    """Class and id where they name junk, else nothing: a wrapper of the page may be named so too ('with-sidebar')."""
    names = _FLAGS.sub(" ", f"{attrs.get('class', '')} {attrs.get('id', '')}").strip()
    if not names or tag in ("html", "body", "article", "main"):
        return ""
    return names.lower() if not JUNK_WORDS.isdisjoint(class_words(names)) or JUNK_PARTS.search(names.lower()) else ""


def _tags(html: str) -> Iterator[tuple[int, int, str, str, str]]:
    """Start and end of each tag, "/" for an end tag, its name and its attributes; no name for comments and the like.

    Every character is passed a fixed number of times: what no ">" follows is text, and once a tag's
    quotes are found to be unbalanced up to the page's end, quotes count for nothing in later tags.
    """
    place, close, balanced = 0, 0, True
    while start := _TAG_START.search(html, place):
        at = start.start()
        if html.startswith("<!--", at):
            end = html.find("-->", at + 4)
            place = len(html) if end < 0 else end + 3
            yield at, place, "", "", ""
            continue
        if close <= at:
            close = html.find(">", at)
        if close < 0:
            return
        if html[at + 1] in "!?":
            place = close + 1
            yield at, place, "", "", ""
            continue
        tag = _TAG.match(html, at) if balanced else None
        if tag is None:
            tag = _BARE_TAG.match(html, at, close + 1)
            balanced = balanced and tag is None
        if tag is None:  # "</" and no name
            place = at + 2
            continue
        name = tag[2].lower()
        place = tag.end()
        yield at, place, tag[1], name, tag[3]
        if name in RAW and not tag[1]:
            after = re.compile(rf"</{re.escape(name)}\b", re.IGNORECASE).search(html, place)
            end = html.find(">", after.end()) if after else -1
            at, place = place, len(html) if end < 0 else end + 1
            yield at, place, "", "", ""


def blocks_of(html: str) -> list[Block]:
    """The page's blocks outside of menus, notices and the like, in page order.

    End tags that match nothing open are passed over, a block start ends an open paragraph, and what
    is still open at the end of the page ends there, so broken and cut markup gives what it holds. An
    element named like junk isn't junk if it holds more than half of the page's text and isn't beside it: it
    holds a title, main or article element, or the page has no main and article (discussions need the title or main).
    Nor is a paragraph of an article that has more text than links.
    """
    stack = [_Open("body", ">body", False, holder=">body")]
    parts: list[tuple[str, bool, tuple[int, ...]]] = []
    runs: list[_Run] = []
    names: list[_Name] = []
    opened: Counter[str] = Counter()
    lines: list[int] = []  # places of open paragraphs and headings
    links = page_chars = 0
    marked = False  # whether main or article elements say where the page's text is

    def add(text: str) -> None:
        nonlocal page_chars
        top = stack[-1]
        if not top.junk and text and (not top.heading_only):
            parts.append((text, links > 0, top.names))
            chars = len(text.strip())
            page_chars += chars
            for name in top.names:
                names[name].chars += chars
                names[name].link_chars += chars if links else 0

    def flush() -> None:
        if parts:
            runs.append(_Run(stack[-1].holder, stack[-1].title, parts.copy()))
            parts.clear()

    def close(index: int) -> None:
        nonlocal links
        ended = stack[index:]
        if any(x.tag in BLOCKS for x in ended):
            flush()
        for x in ended:
            opened[x.tag] -= 1
            links -= x.tag == "a"
        while lines and lines[-1] >= index:
            lines.pop()
        del stack[index:]

    place, end = 0, len(html)
    for start, after, slash, name, source in _tags(html):
        add(html[place:start])
        place = after
        if not name:
            continue
        if slash:
            if opened[name]:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == name))
            continue
        if name in RAW:
            continue
        if name == "br":
            add(" ")
        if name in BLOCKS:
            if lines and (name == "p" or name in HEADINGS or stack[lines[-1]].tag == "p"):
                close(lines[-1])
            if name in ("li", "td", "th", "tr", "dt", "dd", "option"):
                same = ("dt", "dd") if name in ("dt", "dd") else ("td", "th") if name in ("td", "th") else (name,)
                at = len(stack) - 1
                while at > 0 and stack[at].tag not in (*same, "ul", "ol", "table", "dl", "div", "section", "article"):
                    at -= 1
                if at > 0 and stack[at].tag in same:
                    close(at)
            flush()
        if name in VOID or source.rstrip().endswith("/") and name not in BLOCKS:
            continue
        top = stack[-1]
        attrs = attributes(source) if source else {}
        junk = top.junk or marks_junk(name, attrs)
        heading_only, inner = top.heading_only, top.names
        called = "" if junk or len(inner) >= NESTED else junk_name(name, attrs)
        if called:
            inner = (*inner, len(names))
            names.append(_Name(bool(TALK.search(called)), prose=name == "p" and top.article))
        if name in ("h1", "main", "article"):
            marked |= name != "h1"
            for mark in inner:
                names[mark].holds_page |= name != "article" or not names[mark].talk
        if name == "header":
            junk, heading_only = junk or not top.article, True
        elif name in HEADINGS:
            heading_only = False
        path = top.path
        if name in BLOCKS and name not in OPTIONAL and top.depth < DEEPEST:
            words = "-".join(sorted(set(class_words(attrs.get("class", "")))))
            path = f"{path}>{name}.{words}" if words else f"{path}>{name}"
        links += name == "a"
        opened[name] += 1
        if name == "p" or name in HEADINGS:
            lines.append(len(stack))
        holder = path if name in CONTAINERS else top.holder
        title, article = top.title or name in ("h1", "h2"), top.article or name in ("article", "main")
        stack.append(_Open(name, path, junk, heading_only, inner, holder, title, article, top.depth + (name in BLOCKS)))
    rest = html[place:end]
    cut = re.search(r"<[a-zA-Z/!][^<]*\Z", rest)  # a tag that the end of the page cuts off
    add(rest[: cut.start()] if cut else rest)
    flush()
    wrapper = lambda x: 2 * x.chars > page_chars and (x.holds_page or not marked and not x.talk)
    prose = lambda x: x.prose and 2 * x.link_chars < x.chars
    junk_names = {i for i, x in enumerate(names) if not wrapper(x) and not prose(x)}
    blocks = []
    for run in runs:
        held = [part for part in run.parts if junk_names.isdisjoint(part[2])]
        text = " ".join(unescape("".join(part[0] for part in held)).split())
        if text:
            link_text = unescape("".join(part[0] for part in held if part[1]))
            blocks.append(Block(run.path, text, len(" ".join(link_text.split())), run.title))
    return blocks


def container_scores(blocks: list[Block]) -> dict[str, float]:
    """Text outside of links by container path: all of it to the holder, half to the next one above."""
    scores: dict[str, float] = {}
    for block in blocks:
        worth = max(len(block.text) - block.link_chars, 0) * (1 - block.link_chars / len(block.text))
        path, share = block.path, 1.0
        while path and share >= 0.5:
            last = path.rpartition(">")[2].partition(".")[0]
            if last in CONTAINERS:
                lift = 1.25 if last in ("article", "main") else 1.0
                scores[path] = scores.get(path, 0.0) + worth * share * lift
                share /= 2
            path = path.rpartition(">")[0]
    return scores


def inside(path: str, container: str) -> bool:
    return path == container or path.startswith(f"{container}>")


def best_first(scores: dict[str, float]) -> list[str]:
    return sorted((p for p, s in scores.items() if s > 0), key=lambda p: (-scores[p], p))


def widened(blocks: list[Block], container: str, most: str = "") -> tuple[str, list[Block]]:
    """The container's widest ancestor, not above ``most``, that adds more text of its own than links; its blocks.

    A container wins by its share of the text; headlines, leads and paragraphs beside it belong to the
    article. Blocks of links that are added beside more text are left out.
    """
    held = [inside(block.path, container) for block in blocks]
    reach = container
    while container and container != most:
        container = container.rpartition(">")[0]
        added = [i for i, block in enumerate(blocks) if not held[i] and inside(block.path, container)]
        plain = [i for i in added if blocks[i].title or 2 * blocks[i].link_chars <= len(blocks[i].text)]
        chars = sum(len(blocks[i].text) for i in plain)
        if 2 * chars < sum(len(blocks[i].text) for i in added):
            break
        for i in plain:
            held[i], reach = True, container
    return reach, [block for block, own in zip(blocks, held) if own]


def text_under(blocks: list[Block], ranked: list[str], reaches: list[str] | None = None) -> str:
    """Blocks of the article around the first of the paths that holds text here, else around the page's own best.

    A page whose own best container is on the same branch widens the path as its text allows; any other
    page up to the host's reach of the path.
    """
    own = (best_first(container_scores(blocks)) or [""])[0]
    for container, reach in zip([*ranked, own], [*(reaches or ranked), ""]):
        if any(inside(block.path, container) for block in blocks):
            if inside(container, own):
                container, reach = own, ""
            elif inside(own, container):
                reach = ""
            return "\n".join(block.text for block in widened(blocks, container, reach)[1])
    return "\n".join(block.text for block in blocks)
