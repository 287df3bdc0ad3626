"""Text blocks of an HTML page, with what a labeller needs to know of each."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

#: Fixed values of HTML: elements that break the flow of text, that end an open paragraph, whose
#: content is no text.
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section
select summary table tbody td tfoot th thead tr ul""".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object canvas audio video head xmp noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag of these ends an open element of the same kind.
ALONE = frozenset("li dt dd tr td th option optgroup".split())

TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']+|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Elements and names that mark boilerplate or content. A name is a part of a class, id or role.
NOT_CONTENT_TAGS = frozenset("nav aside footer header menu dialog button select option optgroup legend".split())
#: Elements that speak like a name: some sites wrap the whole page in them.
WRAPPING_TAGS = frozenset("form fieldset".split())
CONTENT_TAGS = frozenset("article main".split())
NOT_CONTENT_NAMES = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion
promoted banner nav navbar navigation menu menus breadcrumb breadcrumbs masthead topbar footer foot sidebar sidebars aside
complementary contentinfo widget widgets related recommended recommendations share sharing social cookie cookies consent notice
notices gdpr popup modal overlay newsletter subscribe subscription signup login signin search comment comments reply replies disqus
respond discussion pagination pager toolbar copyright alert disclaimer dialog form skip""".split())
WEAK_NAMES = frozenset("header head top".split())
#: Names that hold even for most of a page, where its content stands elsewhere.
SURE_NAMES = frozenset("comment comments reply replies disqus respond".split())
#: What follows one of these in a name describes the layout of what is inside.
LAYOUT = frozenset("has with no without".split())
#: A name of boilerplate counts in full up to this share of the page's text below its element, and not at all from the other.
FULL_SHARE, NO_SHARE = 0.5, 0.8
CONTENT_NAMES = frozenset("article content main post entry story body text page prose".split())


@dataclass(slots=True)
class Block:
    text: str
    tag: str
    parent: int
    path: tuple[int, ...]
    prior: float
    link_chars: int


def said(tag: str, attributes: str) -> str:
    """What an element says of the text below it: ``hard`` boilerplate, a ``sure`` or ``bad`` or ``weak`` name of
    boilerplate, ``content`` by element, ``name`` of content, or nothing."""
    names: set[str] = set()
    for key, value in ATTRIBUTE.findall(attributes) if attributes else ():
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return "hard"
        if key == "class" or key == "role" or key == "id" and not (tag[:1] == "h" and tag[1:].isdigit()):  # headings: an anchor
            for one in value.split():
                parts = [p.lower() for p in NAME_PARTS.findall(one)]
                if not (parts and parts[0] in LAYOUT):
                    names.update(parts)
    if tag in ("body", "html"):
        return ""
    if names & NOT_CONTENT_NAMES:
        return "sure" if names & SURE_NAMES else "bad"
    if tag in CONTENT_TAGS:
        return "content"
    if tag in NOT_CONTENT_TAGS:
        return "header" if tag == "header" else "hard"
    if tag in WRAPPING_TAGS:
        return "bad"
    if names & WEAK_NAMES and not names & CONTENT_NAMES:
        return "weak"
    return "name" if names & CONTENT_NAMES else ""


def settle(out: list[Block], says: list[str]) -> None:
    """Sets the ``prior`` of every block from what the elements around it say, outermost first: -2 or 2 boilerplate
    or content, -1 or 1 by a name that tells less, 0 unknown.

    A name of boilerplate is evidence, not a verdict: it fades with the share of the page's text below its element,
    unless marked content stands outside of it and none (or, for a sure name, whatever) inside; what marks content inside of it counts as
    far as it has faded."""
    below: dict[int, int] = {}
    marked: dict[int, int] = {}
    inner: dict[int, int] = {}
    every = marked_every = 0
    for b in out:
        n, kinds = len(b.text), [says[e] for e in b.path]
        if "hard" in kinds:
            continue
        every += n
        last = max((i for i, k in enumerate(kinds) if k in ("content", "name")), default=-1)
        marked_every += n * (last >= 0)
        for i, e in enumerate(b.path):
            if kinds[i] in ("bad", "sure"):
                below[e] = below.get(e, 0) + n
                marked[e] = marked.get(e, 0) + n * (last >= 0)
                inner[e] = inner.get(e, 0) + n * (last > i)
    strength = {}
    for e, n in below.items():
        if marked_every > marked[e] and (says[e] == "sure" or not inner[e]):
            strength[e] = 1.0
        else:
            strength[e] = min(1.0, max(0.0, (NO_SHARE - n / every) / (NO_SHARE - FULL_SHARE)))
    for b in out:
        state, bad = 0.0, 0.0
        for e in b.path:
            kind = says[e]
            if kind == "hard" or kind == "header" and state < 2:
                # The header of an article belongs to it.
                state = -2.0
                break
            if kind in ("bad", "sure"):
                own = strength[e]
                state, bad = state * (1 - own) - 2 * own, max(bad, own)
            elif kind == "content":
                state = 2 - 4 * bad
            elif kind == "weak" and state < 2:
                state = min(state, -1.0)
            elif kind == "name":
                state = max(state, 1 - 3 * bad) if state >= 0 or bad else state
        b.prior = state


def blocks(page: str | None) -> list[Block]:
    """Runs of text between the edges of block elements, in page order; markup, comments, scripts and
    styles left out, references decoded, white space made single."""
    source = page or ""
    stack: list[tuple[str, int]] = [("", 0)]  # tag, number
    says = [""]
    out: list[Block] = []
    buffer: list[str] = []
    numbers, at, link_at, link_chars = 0, 0, 0, 0

    def flush() -> None:
        nonlocal link_chars
        if buffer:
            text = " ".join("".join(buffer).split())
            if text:
                tag, number = stack[-1]
                out.append(Block(text, tag, number, tuple(n for _, n in stack), 0.0, link_chars))
            buffer.clear()
        link_chars = 0

    def close(depth: int) -> None:
        nonlocal link_at
        flush()
        del stack[depth:]
        if link_at > len(stack):
            link_at = 0

    def text(end: int) -> None:
        nonlocal link_chars
        if end > at:
            piece = source[at:end]
            piece = html.unescape(piece) if "&" in piece else piece
            buffer.append(piece)
            if link_at:
                link_chars += len(piece.strip())

    found = TOKEN.search(source)
    while found:
        text(found.start())
        at = found.end()
        ends, tag = found[1] or found[4], (found[2] or found[5] or "").lower()
        if not tag:
            pass
        elif tag in RAW:
            if not ends:
                flush() if tag == "head" else None
                over = re.compile(rf"</{tag}\s*>", re.I).search(source, at) if not (found[3] or "").endswith("/") else None
                if over:
                    at = over.end()
                elif tag in ("script", "style", "template", "textarea", "title", "xmp"):
                    at = len(source)
        elif tag == "br":
            buffer.append("\n")
        elif tag == "a":
            link_at = 0 if ends else len(stack)
        elif tag in BLOCK and not ends:
            flush()
            if tag in ALONE or stack[-1][0] == "p":
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] == "p" or stack[depth][0] == tag and tag in ALONE:
                        close(depth)
                        break
                    if stack[depth][0] in ("ul", "ol", "dl", "table", "select", "div", "article", "section"):
                        break
            if tag not in VOID:
                numbers += 1
                stack.append((tag, numbers))
                says.append(said(tag, found[3] or found[6] or ""))
        elif tag in BLOCK:
            flush()
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    close(depth)
                    break
        found = TOKEN.search(source, at)
    text(len(source))
    flush()
    settle(out, says)
    return out
