"""HTML to a sequence of text blocks, each with the path of open elements above it."""

from __future__ import annotations

import html
import re
from functools import lru_cache

#: Fixed values of HTML: elements without content, whose text is no content, and that end a line of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template title".split())
FALLBACK = frozenset("noscript iframe object textarea".split())  # their text is judged like any other
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup svg math time tt u var wbr img".split()
)
SELF_CLOSING = {  # an open element that ends where another of these begins
    "p": None, "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th", "tr"),
    "th": ("td", "th", "tr"), "option": ("option", "optgroup"),
}
SPACES = re.compile(r"[\x20\x09-\x0D]+")
# A value is quoted only if it starts with a quote. A quote that closes amid another word, with tags before it,
# closes no value: the value was left open, and the tag ends at its first `>`.
_QUOTED = r"\"[^\"<>]*\"|'[^'<>]*'|\"[^\"]*\"(?=[\s/>]|\Z)|'[^']*'(?=[\s/>]|\Z)"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>=]++|=\s*+(?:{_QUOTED})|=)*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)|(?P<text>[^<]+|<)",
    re.S,
)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


@lru_cache(maxsize=1_000)
def _end_tag(name: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I)


@lru_cache(maxsize=10_000)
def element(name: str, rest: str) -> tuple[str, ...]:
    """What describes an element in a path: its name, and the words of its class, id and role."""
    words = [w for found in _NAMES.findall(rest) for w in re.split(r"[^a-z0-9]+", "".join(found).lower()) if w]
    return (name, *("." + w for w in words), *("~" + w[:6] for w in words if len(w) > 6))


def blocks(page: str) -> list[tuple[tuple[str, ...], str]]:
    """(path, text) of each block with text, in page order.

    A block is the text between two elements that are not inline; character references are decoded
    and white space becomes single spaces. Scripts, styles, templates, titles and comments give no text.
    Elements left open, these too, end with the element around them; what was never closed ends with the page.
    A noscript, iframe, object or textarea that is never closed counts as not opened.
    """
    out: list[tuple[tuple[str, ...], str]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    gathered: list[str] = []
    place: tuple | None = None

    def flush():
        nonlocal place
        if gathered:
            text = SPACES.sub(" ", html.unescape("".join(gathered))).strip(" ")
            if text:
                out.append((place, text))
            gathered.clear()
        place = None

    open_ended: set[str] = set()  # names without an end tag in the rest of the page

    def end_of(name: str, at: int) -> re.Match | None:
        found = None if name in open_ended else _end_tag(name).search(page, at)
        if found is None:
            open_ended.add(name)
        return found

    at, size = 0, len(page)
    while at < size:
        token = _TOKEN.match(page, at)
        if token is None:
            break
        at = token.end()
        text, name = token["text"], token["name"]
        if text is not None:
            if place is None and not text.isspace():
                place = tuple(w for _, words in stack for w in words)
            gathered.append(text)
            continue
        if name is None:
            continue
        name = name.lower()
        if token["end"]:
            if name not in INLINE:
                flush()
            if any(n == name for n, _ in stack):
                while stack.pop()[0] != name:
                    pass
            elif name in ("p", "br"):
                flush()
            continue
        if name not in INLINE:
            flush()
            if name not in VOID:
                _close_implied(stack, name)
        if name in RAW:
            end = end_of(name, at)
            if end:
                at = end.end()
            elif not token["rest"].endswith("/"):
                around = (end_of(n, at) for n, _ in reversed(stack))
                at = next((found.start() for found in around if found), size)
        elif name in FALLBACK and end_of(name, at) is None:
            continue
        elif name not in VOID and not (token["rest"].endswith("/") and name in INLINE):
            stack.append((name, element(name, token["rest"])))
    flush()
    return out


def _close_implied(stack: list, name: str) -> None:
    for depth in range(len(stack) - 1, -1, -1):
        opened = stack[depth][0]
        if opened in INLINE:
            continue
        if opened in SELF_CLOSING and (SELF_CLOSING[opened] is None or name in SELF_CLOSING[opened]):
            del stack[depth:]
        return
