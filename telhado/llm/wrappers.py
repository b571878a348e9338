"""Main text of web pages by wrappers inferred for each host.

A page is a stream of tags and texts. Streams of the same host are aligned one after the other into a wrapper, a
union-free expression of elements, text slots, optional and repeated groups: a text that differs
becomes a slot, neighbours of the same kind become a repeated group, and what only one side has becomes
optional. The wrapper then tells which of its elements hold the article and which are boilerplate,
and the pages of the host are read by it.
"""

from __future__ import annotations

import html as entities
import json
import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from telhado.operators.joins import lookup_join
from telhado.session import materialise

from .common import arrow_map, texts

# Wrappers aligned in one group, and hosts a task holds before it passes their wrappers on.
FAN = 64
HOSTS_HELD = 5000
MAX_PERIOD = 3
CONSTANT_PAGES = 5
SIGNS_HELD = 100_000
# Nested calls allowed; more than a text of 2 GB can nest elements.
CALLS = 2**31 - 1

# Element names of HTML by what they do to the text.
RAW = frozenset("script style xmp iframe noembed noframes noscript textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img".split()
)
# An open element of the first kind ends where one of the second begins.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
SIBLINGS = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
    "p": ("p",),
}
SCOPES = frozenset("ul ol dl table body html article section div main".split())

# Elements, roles and words in class or id that mark what is not the article.
BOILER_TAGS = frozenset(
    "head title script style noscript template nav footer aside form button select option input textarea iframe svg "
    "canvas object embed audio video dialog menu fieldset label noembed noframes xmp datalist".split()
)
BOILER_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split()
)
BOILER_WORDS = frozenset(
    "nav navbar navigation menu menubar masthead banner topbar footer sidebar aside widget widgets ad ads adv "
    "advert adverts advertisement advertising adsense adbox promo promotion promoted sponsor sponsored sponsors cookie "
    "cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login comment "
    "comments commentlist disqus reply replies respond responses discussion share sharing social breadcrumb breadcrumbs "
    "pagination pager related recommended recommendations toolbar search copyright legal disclaimer skip hidden".split()
)
# Words that name subjects as well; in an article they count only with evidence from the wrapper.
AMBIGUOUS_WORDS = frozenset(
    "navigation menu banner aside promotion promoted notice notices alert overlay consent cookie cookies gdpr login "
    "subscription reply replies respond responses discussion social related recommended recommendations search copyright "
    "legal disclaimer skip hidden advertising sponsor sponsors widget widgets".split()
)
# Words that may stand beside those above in a name without changing what it names.
PLAIN_WORDS = frozenset(
    "container wrapper wrap box block area inner outer slot unit section content list item items link links button buttons icon "
    "icons group row column module panel top bottom left right inline body text title heading header google dfp js site page "
    "post posts article entry the".split()
)
# Signs write digits as 0.
HEADINGS = frozenset("h0 h1 h2 h3 h4 h5 h6".split())
PROSE = frozenset("p pre blockquote table".split())
MAIN_WORDS = frozenset("article content main post entry story".split())

_TOKEN = re.compile(
    r"<!--(?:>|.*?(?:-->|$))|</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|</?[a-zA-Z][^>]*+>|<[!?/][^>]*+(?:>|$)|</?[a-zA-Z].*$",
    re.DOTALL,
)
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE) for name in RAW}


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, text): kind is open, close or text; text of an open tag is its attributes. Raw elements are one open tag."""
    at, size = 0, len(page)
    while at < size:
        found = _TOKEN.search(page, at)
        if not found:
            yield "text", "", page[at:]
            return
        if found.start() > at:
            yield "text", "", page[at : found.start()]
        at = found.end()
        tag = found[0]
        if tag[1] in "!?" or not tag.endswith(">") or (tag[1] == "/" and not tag[2:3].isalpha()):
            continue
        close = tag[1] == "/"
        name = _NAME.search(tag)[0].lower()
        yield "close" if close else "open", name, "" if close else tag[1 + len(name) : -1]
        if name in RAW and not close:
            end = _RAW_END[name].search(page, at)
            at = end.end() if end else size


class Element:
    """An element of a page: its kind, and its children and texts in order."""

    __slots__ = ("sign", "tag", "children")

    def __init__(self, tag: str, sign: str) -> None:
        self.tag, self.sign, self.children = tag, sign, []


def _sign(tag: str, attributes: str) -> str:
    """Name, role, class and id of an element; digits count as alike. `!` marks a hidden one."""
    if not attributes.strip(" /"):
        return tag
    own = {m[1].lower(): next((g for g in m.groups()[1:] if g is not None), "") for m in _ATTRIBUTE.finditer(attributes)}
    bare = _ATTRIBUTE.sub(" ", attributes).lower().split()
    hidden = (
        "hidden" in bare
        or "hidden" in own
        or own.get("aria-hidden") == "true"
        or re.search(r"display\s*:\s*none", own.get("style", ""))
    )
    parts = [
        tag + ("!" if hidden else ""),
        *([f"@{own['role'].lower()}"] if own.get("role") else []),
        *(f".{c}" for c in sorted(set(own.get("class", "").split()))),
        *([f"#{own['id']}"] if own.get("id") else []),
    ]
    return re.sub(r"\d+", "0", re.sub(r"[/\s]", "_", "".join(parts)))


def parse(page: str) -> Element:
    """The page as a tree; forgiving about missing and crossed end tags. Plain inline elements are part of the text."""
    root = Element("", "")
    stack = [root]
    open_: Counter[str] = Counter()
    coded = False
    for kind, name, text in tokens(page):
        top = stack[-1]
        if kind == "text":
            top.children.append(entities.unescape(text))
        elif kind == "open":
            if name == "br":
                top.children.append("\0")
                continue
            sign = _sign(name, text)
            # In code a class names a kind of token; only what an element is, or that it is hidden, counts there.
            if name in INLINE and not _boilerplate(_bare(sign) if coded or open_["pre"] else sign):
                coded |= name == "code"
                continue
            coded &= name not in ENDS_PARAGRAPH
            if name in ENDS_PARAGRAPH:
                _close(stack, open_, ("p",), SCOPES)
            if name in SIBLINGS:
                _close(stack, open_, SIBLINGS[name], SCOPES)
            node = Element(name, sign)
            stack[-1].children.append(node)
            if name not in VOID and name not in RAW and not text.endswith("/"):
                stack.append(node)
                open_[name] += 1
        elif name not in VOID and open_[name]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == name:
                    _cut(stack, open_, i)
                    break
                if name in INLINE and stack[i].tag not in INLINE:
                    break
        coded &= (kind, name) != ("close", "code")
    return root


def _cut(stack: list[Element], open_: Counter[str], at: int) -> None:
    for node in stack[at:]:
        open_[node.tag] -= 1
    del stack[at:]


def _close(stack: list[Element], open_: Counter[str], names: tuple[str, ...], scopes: frozenset[str]) -> None:
    if not any([open_[n] for n in names]):
        return
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in names:
            _cut(stack, open_, i)
            return
        if stack[i].tag in scopes:
            return


# A wrapper's element: [sign, optional, repeated, pages, characters, constant, children]. The sign of a
# text slot is "#", of a group of several elements "()". `constant` is the checksum of a slot's text
# while all pages agree on it, `pages` then the digests of different pages that do, the CONSTANT_PAGES
# smallest: copies of a page and repeats within one count once.
SIGN, OPTIONAL, REPEATED, PAGES, CHARS, CONSTANT, CHILDREN = range(7)


def _clean(text: list[str]) -> str:
    return " ".join("".join(text).replace("\0", " ").split())


def _checksum(text: str) -> int:
    return zlib.crc32(text.encode())


def _digest(root: Element) -> int:
    """Digest of the page's texts outside of what is marked as boilerplate."""
    out, stack = 0, [root]
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            out = zlib.crc32("".join(node.split()).encode(), out)
        elif not _boilerplate(node.sign):
            stack.extend(reversed(node.children))
    return out


def any_depth() -> None:
    """Lets Python functions call themselves as deep as pages nest: such calls take heap, not the C stack."""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), CALLS))


def wrapper_of(root: Element) -> list:
    """The wrapper of one page: its texts as slots, runs of like children as repeated groups."""
    any_depth()
    page = _digest(root)

    def build(element: Element) -> list:
        children, text = [], []
        for child in [*element.children, None]:
            if isinstance(child, str):
                text.append(child)
                continue
            whole = _clean(text)
            text.clear()
            if whole:
                children.append(["#", 0, 0, [page], len(whole), _checksum(whole), []])
            if child is not None:
                children.append(build(child))
        return [element.sign, 0, 0, [], 0, None, fold(children)]

    return build(root)


def packed(tree: list) -> str:
    """A tree of lists, the children last in each, as text without nesting."""
    out, stack = [], [tree]
    while stack:
        node = stack.pop()
        out.append([*node[:-1], len(node[-1])])
        stack.extend(reversed(node[-1]))
    return json.dumps(out)


def unpacked(text: str) -> list:
    stack: list[list] = []
    for row in reversed(json.loads(text)):
        stack.append([*row[:-1], [stack.pop() for _ in range(row[-1])]])
    return stack[0]


def _alike(a: list, b: list) -> bool:
    if a[SIGN] != b[SIGN]:
        return False
    return a[SIGN] != "()" or [c[SIGN] for c in a[CHILDREN]] == [c[SIGN] for c in b[CHILDREN]]


def fold(children: list[list]) -> list[list]:
    """Neighbouring repeats, of up to MAX_PERIOD elements, as one repeated group."""
    for period in range(1, MAX_PERIOD + 1):
        out: list[list] = []
        for child in children:
            out.append(child)
            if period == 1:
                if len(out) > 1 and child[SIGN] != "#" and _alike(out[-2], child):
                    last = out.pop()
                    out[-1] = align(out[-1], last)
                    out[-1][REPEATED] = 1
            elif len(out) >= 2 * period and all(_alike(a, b) for a, b in zip(out[-2 * period : -period], out[-period:])):
                group, again = out[-2 * period : -period], out[-period:]
                del out[-2 * period :]
                out.append(["()", 0, 1, [], 0, None, [align(a, b) for a, b in zip(group, again)]])
            elif len(out) > period and out[-period - 1][SIGN] == "()":
                group, again = out[-period - 1], out[-period:]
                if len(group[CHILDREN]) == period and all(_alike(a, b) for a, b in zip(group[CHILDREN], again)):
                    del out[-period:]
                    group[CHILDREN] = [align(a, b) for a, b in zip(group[CHILDREN], again)]
        children = out
    return children


def align(a: list, b: list) -> list:
    """The wrapper that both elements match."""
    any_depth()
    mine, other = a[CHILDREN], b[CHILDREN]
    if [c[SIGN] for c in mine] == [c[SIGN] for c in other] and all(map(_alike, mine, other)):
        children = [align(x, y) for x, y in zip(mine, other)]
    elif mine or other:
        children = fold(_aligned(mine, other))
    else:
        children = []
    constant = a[CONSTANT] if a[CONSTANT] == b[CONSTANT] else None
    return [
        a[SIGN],
        a[OPTIONAL] | b[OPTIONAL],
        a[REPEATED] | b[REPEATED],
        sorted({*a[PAGES], *b[PAGES]})[:CONSTANT_PAGES] if constant is not None else [],
        a[CHARS] + b[CHARS],
        constant,
        children,
    ]


def _aligned(mine: list[list], other: list[list]) -> list[list]:
    """Both lists along their longest common subsequence; what only one has is optional."""
    n, m = len(mine), len(other)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if _alike(mine[i], other[j]) else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and _alike(mine[i], other[j]) and best[i][j] == best[i + 1][j + 1] + 1:
            out.append(align(mine[i], other[j]))
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append([*mine[i][:OPTIONAL], 1, *mine[i][REPEATED:]])
            i += 1
        else:
            out.append([*other[j][:OPTIONAL], 1, *other[j][REPEATED:]])
            j += 1
    return out


def expression(wrapper: list) -> str:
    """The wrapper as text: `#` a text slot, `?` optional, `+` repeated, `(...)` a group."""
    inner = "".join([expression(c) for c in wrapper[CHILDREN]])
    sign = wrapper[SIGN]
    body = sign if sign == "#" else f"({inner})" if sign == "()" else f"<{sign}>{inner}</>" if sign else inner
    return body + "+" * wrapper[REPEATED] + "?" * wrapper[OPTIONAL]


@lru_cache(SIGNS_HELD)
def _words(sign: str) -> set[str]:
    return {w.lower() for part in re.split(r"[.#]", sign)[1:] for w in _WORD.findall(part)}


@lru_cache(SIGNS_HELD)
def _tag(sign: str) -> str:
    return re.split(r"[.#@!]", sign, maxsplit=1)[0]


@lru_cache(SIGNS_HELD)
def _boilerplate(sign: str) -> bool:
    """Whether name, role, class or id mark an element as boilerplate."""
    tag = _tag(sign)
    if tag in ("html", "body", "main"):
        return False
    role = re.search(r"@([a-z]+)", sign)
    return (
        tag in BOILER_TAGS
        or "!" in sign[: len(tag) + 1]
        or bool(role and role[1] in BOILER_ROLES)
        or bool(_words(sign) & BOILER_WORDS)
    )


@lru_cache(SIGNS_HELD)
def _named(sign: str, words: frozenset[str]) -> bool:
    """Whether a class, or the id of what is no heading, is made of boilerplate words and plain ones only, some of `words` among them."""
    return any(
        own & words and own <= BOILER_WORDS | PLAIN_WORDS
        for mark, name in re.findall(r"([.#])([^.#]*)", sign)
        if mark == "." or _tag(sign) not in HEADINGS
        for own in [{w.lower() for w in _WORD.findall(name)}]
    )


def _bare(sign: str) -> str:
    """A sign without classes and id."""
    return re.sub(r"[.#].*", "", sign)


@lru_cache(SIGNS_HELD)
def _surely(sign: str) -> bool:
    """Whether an element is boilerplate even in an article: by name of element, role, or a name that tells nothing else."""
    return _boilerplate(_bare(sign)) or (_boilerplate(sign) and _named(sign, BOILER_WORDS - AMBIGUOUS_WORDS))


def _only_list(node: list) -> bool:
    """Whether a wrapper's element holds nothing but a repeated group without prose, and headings."""
    seen, stack = False, list(node[CHILDREN])
    while stack:
        own = stack.pop()
        if own[SIGN] == "#":
            return False
        if own[REPEATED]:
            inner = [own]
            while inner:
                part = inner.pop()
                if _tag(part[SIGN]) in PROSE:
                    return False
                inner.extend(part[CHILDREN])
            seen = True
        elif _tag(own[SIGN]) in PROSE:
            return False
        elif _tag(own[SIGN]) not in HEADINGS:
            stack.extend(own[CHILDREN])
    return seen


# An element of a reading plan: [sign, repeated, verdict, children]. The verdict is READ, DROP, MAIN for an element that
# holds the article, or the checksums of the texts of an element that is the same on all pages.
# Children are told only where a verdict below differs from what the signs alone say.
READ, DROP, MAIN = range(3)
P_SIGN, P_REPEATED, P_VERDICT, P_CHILDREN = range(4)


def _clear_of_boilerplate(sign: str) -> bool:
    return _tag(sign) in ("article", "main") and not _words(sign) & BOILER_WORDS


def _kind(sign: str, inside: bool) -> str:
    """By which of its marks an element may hold the article."""
    tag = _tag(sign)
    if tag == "article" and not inside:
        return "article"
    if (tag == "main" or "@main" in sign) and not inside:
        return "main"
    return "words" if _words(sign) & MAIN_WORDS and tag not in ("html", "body") else ""


def _header(sign: str) -> bool:
    return _tag(sign) == "header" or "header" in _words(sign)


def _marked(sign: str, inside: bool, within: bool, titled: bool) -> bool:
    """Whether an element is boilerplate by its sign, `inside` an article element, `within` what may hold the article.

    There, and for ids that are mere anchors of headings and sections, words that may name a subject do not count.
    A header there is the article's own if it is `titled`: if it holds a heading.
    """
    tag = _tag(sign)
    if not inside and _header(sign) and not (within and titled):
        return True
    anchor = (tag == "section" or tag in HEADINGS) and not _words(re.sub(r"#.*", "", sign)) & BOILER_WORDS
    return _surely(sign) if within or anchor else _boilerplate(sign)


def _checksums(node: list) -> list[int]:
    """Checksums of all texts of a wrapper's element."""
    found, stack = [], [node]
    while stack:
        own = stack.pop()
        if own[SIGN] == "#":
            found.append(own[CONSTANT])
        stack.extend(own[CHILDREN])
    return found


def plan(wrapper: list) -> list:
    """How the pages of a wrapper are read: its elements with their verdicts, under a root that names the kind of MAIN."""
    size: dict[int, int] = {}
    main_below: dict[int, bool] = {}
    titled: dict[int, bool] = {}
    same: dict[int, bool] = {}  # all texts alike on CONSTANT_PAGES pages or more
    order, stack = [], [wrapper]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(node[CHILDREN])
    for node in reversed(order):
        size[id(node)] = node[CHARS] + sum([size[id(c)] for c in node[CHILDREN]])
        same[id(node)] = (
            node[CONSTANT] is not None and len(node[PAGES]) >= CONSTANT_PAGES
            if node[SIGN] == "#"
            else all([same[id(c)] for c in node[CHILDREN]])
        )
        titled[id(node)] = any([_tag(c[SIGN]) in HEADINGS or titled[id(c)] for c in node[CHILDREN]])
        main_below[id(node)] = any([_clear_of_boilerplate(c[SIGN]) or main_below[id(c)] for c in node[CHILDREN]])

    verdicts: dict[int, int | list[int]] = {}
    found: dict[str, list[list]] = {"article": [], "main": [], "words": []}
    outermost: list[list] = []
    dropped = 0
    stack = [(wrapper, False, False, False)]
    while stack:
        node, inside, within, named = stack.pop()
        for child in node[CHILDREN]:
            sign = child[SIGN]
            if sign == "#":
                continue
            if sign == "()":
                stack.append((child, inside, within, named))
                continue
            sure = _marked(sign, inside, within, titled[id(child)])
            if not main_below[id(child)] and (sure or _boilerplate(sign) or (_header(sign) and not inside)):
                # A word that may name a subject needs the wrapper's evidence: a repeated group, or the same text everywhere.
                group = _named(sign, BOILER_WORDS) and _tag(sign) not in HEADINGS | PROSE
                if _tag(sign) == "section" and not _words(re.sub(r"#.*", "", sign)) & BOILER_WORDS:
                    group = False
                if sure or (group and (child[REPEATED] or node[SIGN] == "()" or _only_list(child))):
                    verdicts[id(child)] = DROP
                elif same[id(child)] and size[id(child)] and _tag(sign) not in HEADINGS:
                    verdicts[id(child)] = _checksums(child)
                if id(child) in verdicts:
                    dropped += size[id(child)]
                    continue
            kind = _kind(sign, inside)
            if kind and size[id(child)]:
                found[kind].append(child)
                if kind == "words" and not named:
                    outermost.append(child)
            stack.append((child, inside or _tag(sign) == "article", within or bool(kind), named or kind == "words"))
    # Elements only named like an article must hold most of the text; the outermost count.
    if 2 * sum([size[id(n)] for n in outermost]) < size[id(wrapper)] - dropped:
        outermost = []
    found["words"] = outermost
    chosen = next((kind for kind, nodes in found.items() if nodes), "")
    if chosen:
        for node in found[chosen]:
            verdicts[id(node)] = MAIN
    else:
        # Without an element for the article, what is the same on all pages of the host is no article.
        stack = [wrapper]
        while stack:
            for child in stack.pop()[CHILDREN]:
                if child[SIGN] == "#" or id(child) in verdicts:
                    continue
                if same[id(child)] and size[id(child)] and child[SIGN] != "()" and _tag(child[SIGN]) not in ("html", "body"):
                    verdicts[id(child)] = _checksums(child)
                else:
                    stack.append(child)
    out: dict[int, list] = {}
    telling: set[int] = set()
    for node in reversed(order):
        verdict = verdicts.get(id(node), READ)
        keep = verdict in (READ, MAIN) and any([id(c) in telling for c in node[CHILDREN]])
        children = [out[id(c)] for c in node[CHILDREN]] if keep or node[SIGN] == "()" else []
        out[id(node)] = [node[SIGN], node[REPEATED], verdict, children]
        if keep or verdict != READ:
            telling.add(id(node))
    return [chosen, 0, READ, out[id(wrapper)][P_CHILDREN]]


def _runs(node: Element) -> list[tuple[str, list[Element]]]:
    """The texts and elements of an element in order; neighbours of the same sign together."""
    runs: list[tuple[str, list[Element]]] = []
    for child in node.children:
        if isinstance(child, str):
            if child.replace("\0", " ").strip() and (not runs or runs[-1][0] != "#"):
                runs.append(("#", []))
        elif runs and runs[-1][0] == child.sign:
            runs[-1][1].append(child)
        else:
            runs.append((child.sign, [child]))
    return runs


def matched(node: Element, items: list[list]) -> dict[int, list]:
    """{id of a child of a page's element: the element of the plan it stands for}.

    As many texts and children as possible are matched in order; repeated elements and groups take any number.
    """
    runs = _runs(node)
    if [s for s, _ in runs] == [i[P_SIGN] for i in items]:
        return {id(c): item for (_, own), item in zip(runs, items) for c in own}
    flat: list[list] = []
    again: list[list[int]] = []  # where a group that ends or is left at this item begins
    stack: list[tuple[list, list[int]]] = [(i, []) for i in reversed(items)]
    while stack:
        item, starts = stack.pop()
        if item[P_SIGN] == "()":
            own = [*starts, len(flat)]
            stack.extend([(i, own) for i in reversed(item[P_CHILDREN])])
        else:
            flat.append(item)
            again.append(starts)
    m, n = len(runs), len(flat)
    best = [[0] * (n + 1) for _ in range(m + 1)]
    step: list[list[int]] = [[0] * n for _ in range(m)]
    for i in range(m - 1, -1, -1):
        below, row, steps, sign = best[i + 1], best[i], step[i], runs[i][0]
        row[n] = below[n]
        for j in range(n - 1, -1, -1):
            # Step -1 leaves out the run, -2 the item; others are the next item once both are matched.
            row[j], steps[j] = max((below[j], -1), (row[j + 1], -2))
            if flat[j][P_SIGN] == sign:
                ways = [j + 1, *([j] if flat[j][P_REPEATED] else []), *again[j]]
                to = max(ways, key=below.__getitem__)
                if below[to] + 1 >= row[j]:
                    row[j], steps[j] = below[to] + 1, to
    out: dict[int, list] = {}
    i = j = 0
    while i < m and j < n:
        to = step[i][j]
        if to == -2:
            j += 1
            continue
        if to >= 0:
            for child in runs[i][1]:
                out[id(child)] = flat[j]
            j = to
        i += 1
    return out


def _all_in(node: Element, checksums: list[int]) -> bool:
    """Whether each text of a page's element has one of the checksums."""
    known, stack = set(checksums), [node]
    while stack:
        text = []
        for child in [*stack.pop().children, None]:
            if isinstance(child, str):
                text.append(child)
                continue
            whole = _clean(text)
            text.clear()
            if whole and _checksum(whole) not in known:
                return False
            if child is not None:
                stack.append(child)
    return True


def _holds_main(node: Element) -> bool:
    stack = [node]
    while stack:
        for child in stack.pop().children:
            if not isinstance(child, str):
                if _clear_of_boilerplate(child.sign):
                    return True
                stack.append(child)
    return False


def _titled(node: Element) -> bool:
    """Whether a header holds a heading; other elements are not asked."""
    stack = [node] if _header(node.sign) else []
    while stack:
        for child in stack.pop().children:
            if not isinstance(child, str):
                # Names of elements here, not signs: digits as they are.
                if re.fullmatch(r"h[1-6]", child.tag):
                    return True
                stack.append(child)
    return False


def main_text(page: str, how: list) -> str:
    """The text of the page's article by the plan of its host's wrapper, a line for each block.

    The page is matched with the wrapper, element by element; where it has what the wrapper has not, or nothing is told,
    signs decide. A page without the wrapper's main element is read as a whole. What is the same
    on all pages is left out only at its own place, and only if other text remains.
    """
    root = parse(page)
    for kind, constants in ((how[P_SIGN], True), ("", True), ("", False)):
        blocks, met_main, left_out = _read(root, how, kind, constants)
        if (kind and met_main) or (not kind and (blocks or not left_out)):
            break
    return "\n".join(blocks)


def _read(root: Element, how: list, kind: str, constants: bool) -> tuple[list[str], bool, bool]:
    """(blocks, whether an element of this kind was met, whether constant elements were left out)."""
    blocks: list[str] = []
    text: list[str] = []
    met_main = left_out = False

    def flush() -> None:
        if text:
            for part in re.split(r"\0\s*\0", "".join(text)):
                whole = _clean([part])
                if whole:
                    blocks.append(whole)
            text.clear()

    # (element or text, plan, whether its text counts, whether it is in an article element); None ends a block.
    stack: list[tuple] = [(root, how, not kind, False)]
    while stack:
        node, item, inside, article = stack.pop()
        if isinstance(node, str):
            if inside:
                text.append(node)
            continue
        if node is None:
            flush()
            continue
        places = matched(node, item[P_CHILDREN]) if item and item[P_CHILDREN] else {}
        below: list[tuple] = []
        for child in node.children:
            if isinstance(child, str):
                below.append((child, None, inside, article))
                continue
            block = child.tag not in INLINE
            if block:
                below.append((None, None, False, False))
            own = places.get(id(child))
            if own:
                verdict = own[P_VERDICT]
            elif _marked(child.sign, article, bool(kind) and inside, _titled(child)) and not _holds_main(child):
                verdict = DROP
            else:
                verdict = MAIN if kind and _kind(child.sign, article) == kind else READ
            if verdict == DROP:
                continue
            if isinstance(verdict, list) and constants and _all_in(child, verdict):
                left_out = True
                continue
            main = bool(kind) and verdict == MAIN
            met_main |= main
            below.append((child, own, inside or main, article or child.tag == "article"))
            if block:
                below.append((None, None, False, False))
        stack.extend(reversed(below))
    flush()
    return blocks, met_main, left_out


def host(url: Column) -> Column:
    """Host of a URL in lower case; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def _page_wrappers(columns: Iterator[dict[str, pa.Array]]) -> Iterator[dict[str, pa.Array]]:
    held: dict[str, list] = {}

    def out() -> dict[str, pa.Array]:
        return {"host": pa.array(list(held), pa.string()), "wrapper": pa.array([packed(w) for w in held.values()], pa.string())}

    for batch in columns:
        for name, page in zip(batch["host"].to_pylist(), texts(batch["html"])):
            own = wrapper_of(parse(page))
            held[name] = align(held[name], own) if name in held else own
        if len(held) >= HOSTS_HELD:
            yield out()
            held.clear()
    yield out()


def _merge(group: pd.DataFrame) -> pd.DataFrame:
    found = sorted(group["wrapper"])
    whole = unpacked(found[0])
    for other in found[1:]:
        whole = align(whole, unpacked(other))
    return pd.DataFrame({"host": [group["host"].iloc[0]], "wrapper": [packed(whole)]})


def infer(pages: DataFrame) -> DataFrame:
    """(host, wrapper) of every host of `pages` (url, html): one wrapper that all its pages match.

    Each task first aligns its own pages, so a host of very many pages leaves it as one wrapper. The
    wrappers of a host are then aligned in groups of about FAN, round by round, until one is left.
    """
    found = materialise(
        arrow_map(pages.select(host(F.col("url")).alias("host"), "html"), _page_wrappers, "host string, wrapper string"),
        "wrappers",
    )
    while True:
        sizes = found.groupBy("host").agg(F.count("*").alias("n"))
        if (sizes.agg(F.max("n")).first()[0] or 0) <= 1:
            return found
        grouped = found.join(sizes, "host").withColumn(
            "part", F.pmod(F.xxhash64("wrapper"), F.ceil(F.col("n") / FAN)).cast("int")
        )
        found = materialise(
            grouped.groupBy("host", "part").applyInPandas(lambda g: _merge(g[["host", "wrapper"]]), "host string, wrapper string"),
            "wrappers",
        )


def _host_rules(columns: Iterator[dict[str, pa.Array]]) -> Iterator[dict[str, pa.Array]]:
    for batch in columns:
        found = [packed(plan(unpacked(w))) for w in batch["wrapper"].to_pylist()]
        yield {"host": batch["host"], "rule": pa.array(found, pa.string())}


def _read_pages(columns: Iterator[dict[str, pa.Array]]) -> Iterator[dict[str, pa.Array]]:
    known: dict[str, list] = {}
    for batch in columns:
        out = []
        for page, rule in zip(texts(batch["html"]), batch["rule"].to_pylist()):
            if rule not in known:
                known.clear() if len(known) > HOSTS_HELD else None
                known[rule] = unpacked(rule) if rule else ["", 0, READ, []]
            out.append(main_text(page, known[rule]))
        yield {
            "page_id": batch["page_id"],
            "url": batch["url"],
            "text": pa.array(out, pa.string()),
            "n_chars": pa.array([len(t) for t in out], pa.int64()),
        }


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of `pages` (page_id, url, html): the article's text.

    Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, markup and readers'
    comments are left out; character references are decoded; white space in a block is one space;
    blocks are joined by a line break. Null or empty html gives an empty text, and a null url is
    a host of its own. Repeated rows stay repeated.
    """
    rule_table = materialise(arrow_map(infer(pages), _host_rules, "host string, rule string"), "rules")
    rows = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    ruled = lookup_join(rows, rule_table, ["host"], ["page_id", "url"], F.length("host") + F.length("rule"))
    return arrow_map(
        ruled.select("page_id", "url", "html", "rule"), _read_pages, "page_id long, url string, text string, n_chars long"
    )
