"""Main text of web pages by wrappers inferred per host.

A wrapper is a union-free regular expression over the token streams of a host's pages. It is found
by aligning the pages one after another: equal tags match, differing texts become slots, adjacent
repetitions become repeated groups and what only some pages have becomes optional. Where a sequence
stays irregular it becomes a repetition of optional parts, so that every page of the host matches
and a wrapper's size follows the template, not the number of pages.

The wrapper also counts texts and link texts. From it the host's article region is chosen; each
page is then aligned with its wrapper and the text of that region is taken, whole.
"""

from __future__ import annotations

import html as entities
import pickle
import re
import zlib
from collections.abc import Iterator
from math import inf

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmarts.llm.common import kept

TEXT = "#"
# Elements nested deeper are set side by side in the one at this depth, each with its own text.
MAX_DEPTH = 120
# Parts of a sequence beyond which it counts as irregular.
MAX_PARTS = 32
# Hosts whose wrappers a task holds before it passes them on.
HELD_HOSTS = 1000
FAN_IN = 256
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style textarea title noscript iframe xmp noembed noframes template svg math".split())
_BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
# What an opening tag closes, if that is open inside the nearest of the second names.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"}),
}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_DROPPED = set("nav footer aside form script style noscript template iframe button select dialog menu head title svg math".split())
_BOILER = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar sidebars menu menus nav "
    "navbar navigation breadcrumb breadcrumbs footer header masthead topbar cookie cookies consent notice notices gdpr comment "
    "comments commentlist disqus respond replies newsletter subscribe subscription signup related recommended share sharing "
    "social popup modal overlay widget widgets pagination pager toolbar skip alert".split()
)
_BOILER_ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar".split())
_READERS = set("comment comments commentlist disqus respond replies reply".split())
_CONTENT = set("content article post entry story articlebody main text".split())


class Node:
    """An element of a page; children are nodes and strings."""

    __slots__ = ("tag", "label", "names", "roles", "children")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.children = tag, []
        self.names, self.roles = frozenset(), frozenset()
        if attributes:
            found = {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)}
            words = f"{found.get('class', '')} {found.get('id', '')}".lower()
            self.names = frozenset(re.split(r"[^a-z]+", words)) - {""}
            self.roles = frozenset(f"{found.get('role', '')} {found.get('itemprop', '')}".lower().split())
        # Names without digits tell parts of a template apart; numbered ids do not.
        self.label = ".".join([tag, *sorted(self.names | self.roles)])[:120]


def parse(page: str) -> Node:
    """The token stream of a page as nested elements; missing end tags are put in."""
    root = Node("html")
    stack, at = [root], 0
    # Open elements below the depth, and the node that last took text of each.
    deep: list[list] = []

    def holder() -> Node:
        """Where text goes: below the depth to the outermost element that no article has, else the innermost block."""
        if not deep:
            return stack[-1]
        entry = next((one for one in deep if one[0].tag in _DROPPED or one[0].roles & _BOILER_ROLES or one[0].names & _BOILER), None)
        entry = entry or next((one for one in reversed(deep) if one[0].tag in _BLOCK), None)
        if entry is None:
            return stack[-1]
        held, around = entry[1], stack[-1].children
        if held is None or around[-1] is not held:
            held = Node(entry[0].tag)
            held.label, held.names, held.roles = entry[0].label, entry[0].names, entry[0].roles
            entry[1] = held
            around.append(held)
        return held

    def close_deep(tags: set[str], within: set[str]) -> None:
        for n in range(len(deep) - 1, -1, -1):
            if deep[n][0].tag in tags:
                del deep[n:]
                return
            if deep[n][0].tag in within:
                return

    def close(tags: set[str], within: set[str]) -> None:
        for n in range(len(stack) - 1, 0, -1):
            if stack[n].tag in tags:
                del stack[n:]
                return
            if stack[n].tag in within:
                return

    while at < len(page):
        found = _TOKEN.search(page, at)
        if found is None:
            holder().children.append(page[at:])
            break
        if found.start() > at:
            holder().children.append(page[at : found.start()])
        at = found.end()
        name = found[2] or found[5]
        if name is None:
            continue
        tag = name.lower()
        if found[1] or found[4]:
            if any(one[0].tag == tag for one in deep):
                while deep.pop()[0].tag != tag:
                    pass
                continue
            for n in range(len(stack) - 1, 0, -1):
                if stack[n].tag == tag:
                    del stack[n:]
                    deep.clear()
                    break
            continue
        attributes = found[3] or found[6] or ""
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag == "html":
            continue
        ends = close_deep if deep else close
        if tag in _BLOCK:
            ends({"p"}, {"table", "td", "th", "li", "article", "section", "div", "body"} if tag != "p" else {"table", "td", "th", "button"})
        if tag in _CLOSES:
            ends(*_CLOSES[tag])
        if len(stack) > MAX_DEPTH:
            one = Node(tag, attributes)
            if tag in _VOID or attributes.endswith("/"):
                holder().children.append(one)
            else:
                deep.append([one, None])
            continue
        node = Node(tag, attributes)
        stack[-1].children.append(node)
        if tag not in _VOID and not attributes.endswith("/"):
            stack.append(node)
    return root


class Wrapper:
    """One element of the expression.

    ``parts`` is a list of [label, at least, at most, wrapper] in order, or, if ``mixed``, a
    repetition of optional parts in any order. A text slot has ``value`` None, a constant text its
    checksum. ``chars`` and ``links`` count the text below, and that inside links, over all pages.
    """

    __slots__ = ("tag", "names", "roles", "parts", "mixed", "value", "pages", "chars", "links", "keep")

    def __init__(self, tag, names=frozenset(), roles=frozenset()):
        self.tag, self.names, self.roles = tag, names, roles
        self.parts, self.mixed, self.value = [], False, None
        self.pages, self.chars, self.links, self.keep = 1, 0, 0, False

    def __getstate__(self):
        return tuple(getattr(self, name) for name in self.__slots__)

    def __setstate__(self, state):
        for name, value in zip(self.__slots__, state, strict=True):
            setattr(self, name, value)


def of_page(node: Node, in_link: bool = False) -> Wrapper:
    """The wrapper of a single page: repetitions inside it are groups already."""
    made = Wrapper(node.tag, node.names, node.roles)
    in_link = in_link or node.tag == "a"
    parts = []
    for child in node.children:
        if isinstance(child, str):
            text = child.strip()
            if not text:
                continue
            below = Wrapper(TEXT)
            below.value, below.chars = zlib.crc32(text.encode("utf-8", "surrogatepass")), len(text)
            below.links = below.chars if in_link else 0
            parts.append([TEXT, 1, 1, below])
        else:
            parts.append([child.label, 1, 1, of_page(child, in_link)])
    made.chars, made.links = sum(p[3].chars for p in parts), sum(p[3].links for p in parts)
    made.parts = parts
    _settle(made, fold(parts))
    return made


def fold(parts: list) -> list:
    """Adjacent repetitions as repeated groups: of one part first, then of two to four parts."""
    out: list = []
    for part in parts:
        if out and out[-1][0] == part[0]:
            out[-1] = [part[0], min(1, out[-1][1] + part[1]), inf, merge(out[-1][3], part[3], same_page=True)]
        else:
            out.append(part)
    for period in (2, 3, 4):
        at = 0
        while at + 2 * period <= len(out):
            labels = [p[0] for p in out[at : at + period]]
            times = 1
            while [p[0] for p in out[at + times * period : at + (times + 1) * period]] == labels:
                times += 1
            if times > 1 and not any(label.startswith("(") for label in labels):
                groups = [_group(out[at + n * period : at + (n + 1) * period]) for n in range(times)]
                whole = groups[0]
                for one in groups[1:]:
                    whole = [whole[0], 1, inf, merge(whole[3], one[3], same_page=True)]
                out[at : at + times * period] = [whole]
            at += 1
    return out


def _group(parts: list) -> list:
    made = Wrapper("(")
    made.parts = parts
    made.chars, made.links = sum(p[3].chars for p in parts), sum(p[3].links for p in parts)
    return ["(" + " ".join(p[0] for p in parts) + ")", 1, 1, made]


def _regrouped(parts: list, other: list) -> list:
    """Single runs of parts that are a group in the other sequence, as that group."""
    for label, _, _, group in other:
        if not label.startswith("(") or group.tag != "(":
            continue
        inner, at = [p[0] for p in group.parts], 0
        while at + len(inner) <= len(parts):
            if [p[0] for p in parts[at : at + len(inner)]] == inner:
                parts = [*parts[:at], _group(parts[at : at + len(inner)]), *parts[at + len(inner) :]]
            at += 1
    return parts


def merge(a: Wrapper, b: Wrapper, same_page: bool = False) -> Wrapper:
    """The least expression of this kind that covers both."""
    made = Wrapper(a.tag, a.names, a.roles)
    made.pages = max(a.pages, b.pages) if same_page else a.pages + b.pages
    made.chars, made.links = a.chars + b.chars, a.links + b.links
    if a.tag == TEXT:
        made.value = a.value if a.value == b.value else None
        return made
    made.mixed = a.mixed or b.mixed
    if made.mixed:
        made.parts = _any_order([*a.parts, *b.parts], same_page)
        return made
    left, right = _regrouped(a.parts, b.parts), _regrouped(b.parts, a.parts)
    _settle(made, align(left, right, same_page), same_page)
    return made


def _settle(made: Wrapper, parts: list, same_page: bool = True) -> None:
    """Keep the sequence, or generalise an irregular one to optional parts in any order."""
    labels = [p[0] for p in parts]
    made.mixed = made.mixed or len(parts) > MAX_PARTS or any(labels.count(label) > 3 for label in set(labels))
    made.parts = _any_order(parts, same_page) if made.mixed else parts


def _any_order(parts: list, same_page: bool) -> list:
    """One optional, repeated part for each label; groups are dissolved."""
    held: dict[str, list] = {}
    queue = list(parts)
    while queue:
        label, _, _, below = queue.pop(0)
        if below.tag == "(":
            queue = [*below.parts, *queue]
        elif label in held:
            held[label][3] = merge(held[label][3], below, same_page)
        else:
            held[label] = [label, 0, inf, below]
    return [held[label] for label in sorted(held)]


def align(left: list, right: list, same_page: bool = False) -> list:
    """Both sequences in one: longest common subsequence of labels, the rest optional."""
    if [p[0] for p in left] == [p[0] for p in right]:
        return [[p[0], min(p[1], q[1]), max(p[2], q[2]), merge(p[3], q[3], same_page)] for p, q in zip(left, right, strict=True)]
    rows, columns = len(left), len(right)
    table = [[0] * (columns + 1) for _ in range(rows + 1)]
    for i in range(rows - 1, -1, -1):
        for j in range(columns - 1, -1, -1):
            same = left[i][0] == right[j][0]
            table[i][j] = table[i + 1][j + 1] + 1 if same else max(table[i + 1][j], table[i][j + 1])
    out, i, j = [], 0, 0
    while i < rows or j < columns:
        if i < rows and j < columns and left[i][0] == right[j][0]:
            p, q = left[i], right[j]
            out.append([p[0], min(p[1], q[1]), max(p[2], q[2]), merge(p[3], q[3], same_page)])
            i, j = i + 1, j + 1
        elif j == columns or i < rows and table[i + 1][j] >= table[i][j + 1]:
            out.append([left[i][0], 0, *left[i][2:]])
            i += 1
        else:
            out.append([right[j][0], 0, *right[j][2:]])
            j += 1
    # Neighbours that became equal are one repetition.
    return fold(out)


def render(wrapper: Wrapper) -> str:
    """The expression as text: # is a slot, = a constant text, ? optional, + and * repeated."""
    if wrapper.tag == TEXT:
        return TEXT if wrapper.value is None else "="
    marks = {(1, 1): "", (0, 1): "?", (1, inf): "+", (0, inf): "*"}
    inner = " ".join(f"({render(p[3])}){marks[p[1], p[2]]}" if (p[1], p[2]) != (1, 1) else render(p[3]) for p in wrapper.parts)
    if wrapper.mixed:
        inner = f"({inner})*"
    return inner if wrapper.tag == "(" else f"<{wrapper.tag}>{inner}</{wrapper.tag}>"


def boilerplate(wrapper: Wrapper, total: int, in_main: bool) -> bool:
    """Whether an element is no part of any article: by its kind, or by its names if it is no bulk of the text."""
    if wrapper.tag in _DROPPED or wrapper.roles & _BOILER_ROLES:
        return True
    if wrapper.tag == "header":
        return not in_main
    if wrapper.tag == "article" and wrapper.names & _READERS and not wrapper.names & _CONTENT:
        return True
    if wrapper.tag in ("html", "body", "article", "main", TEXT, "("):
        return False
    return bool(wrapper.names & _BOILER) and not (wrapper.chars * 2 > total and not in_main)


def choose(wrapper: Wrapper) -> None:
    """Mark the article region with ``keep``: the elements named as such, or else where most text is."""
    ranked: list[tuple[int, int, Wrapper]] = []

    def visit(one: Wrapper, depth: int) -> None:
        if boilerplate(one, wrapper.chars, False):
            return
        rank = 0
        if one.tag == "article" or "articlebody" in one.roles:
            rank = 3
        elif one.tag == "main" or "main" in one.roles:
            rank = 2
        elif one.tag in ("div", "section", "td") and one.names & _CONTENT:
            rank = 1
        if rank and one.chars:
            ranked.append((rank, one.chars - one.links, one))
        for part in one.parts:
            visit(part[3], depth + 1)

    visit(wrapper, 0)
    if ranked:
        best = max(rank for rank, _, _ in ranked)
        most = max(chars for rank, chars, _ in ranked if rank == best)
        for rank, chars, one in ranked:
            if rank == best and (chars == most or best == 3 and 10 * chars >= most):
                one.keep = True
        return
    one = wrapper
    while True:
        below = [p[3] for p in one.parts if p[3].tag != TEXT and not boilerplate(p[3], wrapper.chars, False)]
        own = one.chars - one.links
        heavy = [b for b in below if own and (b.chars - b.links) * 4 > own * 3 and b.parts and b.tag != "p"]
        if len(heavy) != 1:
            break
        one = heavy[0]
    one.keep = True


def extract(root: Node, wrapper: Wrapper) -> str:
    """Text of the region that the page's wrapper marks, block by block."""
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join(entities.unescape("".join(line)).split())
        line.clear()
        if text:
            blocks.append(text)

    def walk(node: Node, own: Wrapper, inside: bool, headings: bool) -> None:
        inside = inside or own.keep
        at = 0
        for child in node.children:
            if isinstance(child, str):
                if inside and not headings:
                    line.append(child)
                continue
            if child.tag == "br" or child.tag == "td" or child.tag == "th":
                line.append(" ")
            at, below = _match(own, at, child.label)
            if below is None or boilerplate(below, wrapper.chars, inside):
                if child.tag in _BLOCK:
                    flush()
                continue
            only = inside and (headings and child.tag not in _HEADINGS or child.tag == "header")
            if child.tag in _BLOCK:
                flush()
            walk(child, below, inside, only)
            if child.tag in _BLOCK:
                flush()

    walk(root, wrapper, False, False)
    flush()
    return "\n".join(blocks)


_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}


def _match(own: Wrapper, at: int, label: str) -> tuple[int, Wrapper | None]:
    """The part that a child stands for: from the place reached on, or else anywhere."""
    order = [*range(at, len(own.parts)), *range(at)]
    for n in order:
        name, _, _, below = own.parts[n]
        if name == label:
            return n, below
        if below.tag == "(":
            for part in below.parts:
                if part[0] == label:
                    return n, part[3]
    return at, None


def page_text(page: str | None, wrapper: Wrapper | None) -> str:
    """Main text of a page; a page without text in its host's region is taken by itself."""
    if not page:
        return ""
    root = parse(page)
    text = extract(root, wrapper) if wrapper is not None else ""
    if not text:
        own = of_page(root)
        choose(own)
        text = extract(root, own)
    return text


def host_of(url: Column) -> Column:
    """Host of a URL in lower case, empty without one."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _inferred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, held = TaskContext.get().partitionId(), {}

    def passed():
        blobs = [pickle.dumps(one, protocol=5) for one in held.values()]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array([part] * len(held), pa.int32()), pa.array(blobs, pa.binary())],
            ["host", "part", "wrapper"],
        )

    for batch in batches:
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if not page:
                continue
            one = of_page(parse(page))
            held[host] = merge(held[host], one) if host in held else one
            if len(held) > HELD_HOSTS:
                yield passed()
                held.clear()
    if held:
        yield passed()


def _merged(rows: pd.DataFrame) -> pd.DataFrame:
    """One wrapper from several of a host."""
    whole = None
    for blob in rows["wrapper"]:
        one = pickle.loads(blob)
        whole = one if whole is None else merge(whole, one)
    return pd.DataFrame({
        "host": [rows["host"].iloc[0]], "part": [int(rows["part"].iloc[0]) % FAN_IN],
        "wrapper": [pickle.dumps(whole, protocol=5)],
    })


def _chosen(rows: pd.DataFrame) -> pd.DataFrame:
    made = _merged(rows)
    wrapper = pickle.loads(made["wrapper"][0])
    choose(wrapper)
    return pd.DataFrame({
        "host": made["host"], "pages": [wrapper.pages], "expression": [render(wrapper)],
        "wrapper": [pickle.dumps(wrapper, protocol=5)],
    })


def infer(pages: DataFrame, *, url: str = "url", html: str = "html") -> DataFrame:
    """``host, pages, expression, wrapper`` of every host with a page that is not empty.

    Every task folds its pages to one wrapper a host; these are folded in two more steps, so a host
    with any share of the pages is many tasks' work. Wrappers depend on the order of folding only
    in how irregular parts are written, not in what they cover.
    """
    rows = pages.select(host_of(F.col(url)).alias("host"), F.col(html).cast("string").alias("html"))
    schema = "host string, part int, wrapper binary"
    parts = rows.mapInArrow(_inferred, schema)
    parts = parts.groupBy("host", (F.col("part") % FAN_IN).alias("step")).applyInPandas(_merged, schema)
    return parts.groupBy("host").applyInPandas(_chosen, "host string, pages long, expression string, wrapper binary")


def main_text(pages: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    NULL and empty pages have empty text. Pages without a host in their URL share one wrapper.
    Rows with equal or NULL keys are kept apart. Other columns are not read.
    """
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html")
    )
    wrappers = kept(infer(rows), "wrappers").select("host", "wrapper")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blob, wrapper = None, None
        for batch in batches:
            texts = []
            for page, own in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist(), strict=True):
                if own != blob:
                    blob, wrapper = own, own and pickle.loads(own)
                texts.append(page_text(page, wrapper))
            yield pa.RecordBatch.from_arrays([
                batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                pa.array(list(map(len, texts)), pa.int64()),
            ], ["page_id", "url", "text", "n_chars"])

    joined = rows.withColumn("host", host_of(F.col("url"))).join(wrappers, "host", "left")
    return joined.select("page_id", "url", "html", "wrapper").mapInArrow(take, "page_id long, url string, text string, n_chars long")
