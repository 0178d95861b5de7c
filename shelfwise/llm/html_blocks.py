"""Leaf blocks of a page: runs of inline text with the tags that they stand in."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

# Elements of HTML by what they do to text.
SILENT = {"script", "style", "noscript", "template", "iframe", "object", "svg", "annotation", "annotation-xml", "canvas", "head"}
RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "svg", "annotation", "annotation-xml"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
    "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
    "time", "tt", "u", "var", "br", "img", "wbr", "input",
    "math", "mi", "mn", "mo", "ms", "mtext", "mspace", "mrow", "mfrac", "msqrt", "mroot", "mstyle", "merror", "mpadded", "mphantom",
    "msub", "msup", "msubsup", "munder", "mover", "munderover", "mmultiscripts", "mtable", "mtr", "mtd", "semantics",
}
#: An opening tag ends an open element of these, up to the nearest holder.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
#: What may stand in a head; anything else ends it.
IN_HEAD = {"html", "head", "title", "meta", "link", "base", "basefont", "bgsound", "script", "style", "noscript", "noframes", "template"}
HOLDERS = {"table", "td", "th", "button", "body", "html"}

TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^>\"']++)*+)>|<[a-zA-Z/!?][^>]*+(?:>|\Z)|[^<]++|<", re.S
)
NAMES = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORDS = re.compile(r"[a-zA-Z]+")


@dataclass
class Block:
    """A leaf block: its text, its ancestors from the root as (tag, names), and its letters in links."""

    text: str
    path: tuple[tuple[str, tuple[str, ...]], ...]
    linked: int = 0


@dataclass
class _Open:
    tag: str
    names: tuple[str, ...]
    path: tuple = field(default=())


def _names(attributes: str) -> tuple[str, ...]:
    found = []
    for kind, a, b, c in NAMES.findall(attributes):
        found += [w.lower() for w in WORDS.findall(a or b or c)]
    return tuple(dict.fromkeys(found))


def raw_end(page: str, tag: str, at: int) -> tuple[int, int]:
    """Where the text of a raw element ends, and its end tag; of drawings, that of the outermost one."""
    depth = 1
    for mark in re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*+>", re.I).finditer(page, at):
        if mark[1]:
            depth -= 1
        elif tag == "svg" and not mark[0].endswith("/>"):
            depth += 1
        if not depth:
            return mark.start(), mark.end()
    return len(page), len(page)


def blocks_of(page: str) -> list[Block]:
    """Blocks in page order.  Open elements are a stack, so depth costs no recursion."""
    found: list[Block] = []
    stack = [_Open("", ())]
    counts: Counter = Counter()  # of open elements by tag, so that the stack is searched for open ones only
    parts: list[str] = []
    linked, links, silent = 0, 0, 0
    at, end = 0, len(page)

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                found.append(Block(text, stack[-1].path, min(linked, len(text))))
            parts.clear()
        linked = 0

    def pop_to(place: int) -> None:
        nonlocal silent
        close()
        for gone in stack[place:]:
            counts[gone.tag] -= 1
            silent -= gone.tag in SILENT
        del stack[place:]

    def end_head() -> None:
        pop_to(next(place for place in range(1, len(stack)) if stack[place].tag == "head"))

    while at < end:
        token = TOKEN.match(page, at)
        at = token.end()
        tag = token[2]
        if tag is None:
            if token[0][0] != "<" or token[0] == "<":
                if counts["head"] and silent == counts["head"] and token[0].strip():
                    end_head()
                if not silent:
                    parts.append(token[0])
                    linked += len(token[0]) * (links > 0)
            continue
        tag = tag.lower()
        if token[1]:
            if tag == "a":
                links = max(0, links - 1)
            elif tag == "br":
                parts.append(" ")
            elif tag not in INLINE:
                for place in range(len(stack) - 1, 0, -1) if counts[tag] else ():
                    if stack[place].tag == tag:
                        pop_to(place)
                        break
                    if stack[place].tag in ("table", "td", "th") and tag in ("p", "div", "li", "span"):
                        break
                else:
                    close()
            continue
        if counts["head"]:
            if tag == "head":
                continue
            if tag not in IN_HEAD:
                end_head()
        if tag == "svg" and token[3].endswith("/"):
            continue
        if tag in RAW and not token[3].endswith("/"):
            body_end, after = raw_end(page, tag, at)
            body, at = page[at:body_end], after
            if tag == "textarea" and not silent:
                close()
                stack.append(_Open(tag, (), (*stack[-1].path, (tag, ()))))
                counts[tag] += 1
                parts.append(body)
                pop_to(len(stack) - 1)
            continue
        if tag in INLINE:
            if tag == "a":
                links += 1
            elif tag == "br":
                parts.append(" ")
            continue
        close()
        links = 0
        if tag in VOID:
            continue
        ends, holders = ENDS.get(tag, (set(), HOLDERS))
        if tag == "body":
            ends, holders = {"head"}, set()
        searched = any(counts[t] for t in ends) or counts["p"] and tag not in ENDS
        for place in range(len(stack) - 1, 0, -1) if searched else ():
            name = stack[place].tag
            if name in holders:
                break
            if name in ends or (name == "p" and tag not in ENDS):
                pop_to(place)
                break
        names = _names(token[3]) if token[3] else ()
        stack.append(_Open(tag, names, (*stack[-1].path, (tag, names)) if tag not in ("html", "body") or names else stack[-1].path))
        counts[tag] += 1
        silent += tag in SILENT
        if len(stack) > 400:  # a chain of open elements this long says no more about its text
            stack[-1].path = stack[-2].path
    close()
    return found
