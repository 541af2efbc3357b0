"""A tolerant reading of HTML into a tree of block elements with text leaves, and its features."""

import re
from html import unescape

BLOCKS = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hr html label legend li main menu nav ol option p pre section select"
    " summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not text of the page.
DROPPED = frozenset("script style noscript template textarea title iframe object svg math head canvas audio video".split())
RAW = frozenset("script style noscript template textarea title iframe svg math canvas".split())
CLOSES_P = BLOCKS - {"button", "label", "legend", "option", "html", "body"}
#: A start tag that ends an open element of these names, up to the given container.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"(?:^|\s)(class|id|role|data-main|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_WORDS = re.compile(r"[a-z]+")

#: Parts of class, id and role names that hint at a page region.
HINTS = {
    "menu": "nav navbar menu breadcrumb breadcrumbs tabs pagination pager toc skip sitemap",
    "header": "header masthead banner topbar branding logo",
    "footer": "footer foot copyright colophon bottom legal",
    "sidebar": "sidebar side aside widget rail related recommended popular trending tags tagcloud archive",
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay toast disclaimer paywall",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promoted banner adsense dfp",
    "form": "form search login signup subscribe subscription newsletter register contact",
    "comments": "comment comments commentlist disqus reply replies discussion respond reader feedback review reviews",
    "share": "share sharing social follow tools meta byline author",
    "content": "article content main post entry story body text page blog prose",
}
_HINT_OF: dict[str, list[str]] = {}
for _name, _parts in HINTS.items():
    for _part in _parts.split():
        _HINT_OF.setdefault(_part, []).append(_name)

TAGS = sorted(BLOCKS)
_INLINE_HINTS = ("advert", "notice", "comments", "menu", "share", "form")


class Node:
    """A block element or, with tag ``#text``, one block of text."""

    __slots__ = ("tag", "parent", "names", "main", "depth", "chars", "linked", "stops", "blocks", "text", "own")

    def __init__(self, tag: str, parent: int, names: str, main: str | None, depth: int):
        self.tag, self.parent, self.names, self.main, self.depth = tag, parent, names, main, depth
        self.chars = self.linked = self.stops = self.blocks = 0
        self.text, self.own = "", ()


def read_page(html: str | None) -> list[Node]:
    """The page's nodes in document order, parents before children; the first is the root."""
    html = html or ""
    nodes = [Node("#root", -1, "", None, 0)]
    stack, inline, pending, linked, hints = [0], [], [], 0, set()
    at, size = 0, len(html)

    def flush():
        nonlocal linked
        if pending:
            text = " ".join("".join(pending).split())
            if text:
                parent = stack[-1]
                leaf = Node("#text", parent, "", None, nodes[parent].depth + 1)
                leaf.text, leaf.chars, leaf.blocks = text, len(text), 1
                leaf.linked = min(linked, len(text))
                leaf.stops = text.count(".") + text.count("!") + text.count("?") + text.count(",")
                leaf.own = tuple(hints)
                nodes.append(leaf)
            pending.clear()
        linked = 0
        hints.clear()

    def add(raw: str):
        nonlocal linked
        text = unescape(raw)
        pending.append(text)
        for name, found in inline:
            if name == "a":
                linked += len(text)
            hints.update(found)

    def close(upto: int):
        flush()
        del stack[upto:]
        inline.clear()

    while at < size:
        m = _TAG.search(html, at)
        if m is None:
            add(html[at:])
            break
        if m.start() > at:
            add(html[at : m.start()])
        at = m.end()
        name = m.group(2) or m.group(5)
        if name is None:
            continue
        name, rest = name.lower(), m.group(3) or m.group(6) or ""
        if m.group(1) or m.group(4):
            if name in BLOCKS:
                for k in range(len(stack) - 1, 0, -1):
                    if nodes[stack[k]].tag == name:
                        close(k)
                        break
            else:
                for k in range(len(inline) - 1, -1, -1):
                    if inline[k][0] == name:
                        del inline[k]
                        break
            continue
        if name in DROPPED and not rest.endswith("/"):
            if name in RAW or name in ("audio", "video", "object"):
                end = re.compile(rf"</{name}[^>]*(?:>|\Z)", re.I).search(html, at)
                at = end.end() if end else size
            elif name == "head":
                end = re.compile(r"</head\s*>|<body", re.I).search(html, at)
                if end:
                    at = end.end() if end.group().startswith("</") else end.start()
            continue
        if name == "br":
            pending.append(" ")
            continue
        if name in VOID and name != "hr":
            continue
        if name not in BLOCKS:
            found = []
            if "=" in rest:
                for _, value in _ATTR.findall(rest):
                    for w in _WORDS.findall(value.lower()):
                        found += [h for h in _HINT_OF.get(w, ()) if h in _INLINE_HINTS]
            inline.append((name, found))
            continue
        flush()
        if name in CLOSES_P:
            for k in range(len(stack) - 1, 0, -1):
                tag = nodes[stack[k]].tag
                if tag == "p":
                    close(k)
                    break
                if tag in ("td", "th", "button", "table"):
                    break
        if name in IMPLIED:
            ends, border = IMPLIED[name]
            for k in range(len(stack) - 1, 0, -1):
                tag = nodes[stack[k]].tag
                if tag in border:
                    break
                if tag in ends:
                    close(k)
        if name == "hr":
            continue
        names, main = "", None
        if "=" in rest:
            for attr, value in _ATTR.findall(rest):
                if attr.lower() == "data-main":
                    main = value.strip("\"'")
                else:
                    names += " " + value.lower()
        nodes.append(Node(name, stack[-1], names, main, nodes[stack[-1]].depth + 1))
        stack.append(len(nodes) - 1)
    flush()
    for node in reversed(nodes[1:]):
        up = nodes[node.parent]
        up.chars += node.chars
        up.linked += node.linked
        up.stops += node.stops
        up.blocks += node.blocks
    return nodes


def _bucket(value: float, edges: tuple) -> int:
    return sum(value >= e for e in edges)


def features(nodes: list[Node]) -> list[list[str]]:
    """Names of the binary features of each node."""
    total = max(1, nodes[0].chars)
    out, seen = [], 0
    for node in nodes:
        kind = "t" if node.tag == "#text" else "e"
        own = [f"{kind}:bias", f"tag:{node.tag}"]
        if kind == "t":
            own.append(f"in:{nodes[node.parent].tag}")
            own += [f"inline:{h}" for h in node.own]
            if "©" in node.text or "copyright" in node.text.lower():
                own.append("t:copyright")
            own.append(f"t:ends{node.text[-1:] in '.!?:;'}")
        elif node.names:
            hints = {h for w in _WORDS.findall(node.names) for h in _HINT_OF.get(w, ())}
            own += [f"hint:{h}" for h in sorted(hints)]
        share = node.linked / max(1, node.chars)
        own.append(f"{kind}:len{_bucket(node.chars, (20, 60, 150, 400, 1200))}")
        own.append(f"{kind}:links{_bucket(share, (0.01, 0.2, 0.5, 0.9))}")
        own.append(f"{kind}:stops{_bucket(node.stops / max(1, node.chars), (0.002, 0.01, 0.03))}")
        if kind == "e":
            own.append(f"e:part{_bucket(node.chars / total, (0.02, 0.1, 0.3, 0.6))}")
            own.append(f"e:blocks{_bucket(node.blocks, (2, 4, 8, 20))}")
        else:
            own.append(f"t:place{_bucket(seen / total, (0.02, 0.1, 0.5, 0.9, 0.98))}")
            seen += node.chars
        out.append(own)
    return out


def edge_kind(child: Node) -> int:
    """Which parent-child potential a node takes: text, flow, list or table part, section."""
    if child.tag == "#text":
        return 0
    if child.tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote", "figure", "figcaption"):
        return 1
    if child.tag in ("ul", "ol", "li", "dl", "dt", "dd", "table", "tbody", "thead", "tr", "td", "th"):
        return 2
    if child.tag in ("nav", "aside", "footer", "header", "form", "button", "select", "dialog"):
        return 3
    return 4


EDGE_KINDS = 5
