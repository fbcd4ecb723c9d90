"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree.  An element of it is a path of labels (tag, class and
id words); each page adds, for each of its elements, the presentation (the sequence of child labels,
runs being one) and the content (the text directly in it).  The entropy of either over the pages of
the host, as a share of the greatest possible, is the node's importance: what looks and reads the
same on every page is template, what differs is content.  A branch of a page has the importance

    leaf:  content(E)        inner:  (1 - g**k) * presentation(E) + g**k * mean over its k parts

and is removed where that is low.  Element names are a prior that rules: 0 for navigation, footers,
forms and the like, 1 for running text inside an article.  Words in classes, ids and roles are a weak
one, because wrappers are named after what they hold or lack: see ``extract``.
Lines of running text (paragraphs, items, lower headings) share a path with others, so they are also
content nodes of their own: a line that nearly all pages of a host hold, while the rest of its path
differs, is template.  Readers' comments differ on every page as articles do; only their presentation
tells them apart: see ``threads``.
Hosts with few pages use the tree of all hosts.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidegate.llm.shared import explode_batches, join_hot, written

DAMPING = 0.9
THRESHOLD = 0.35
#: What a name weighs against: a named branch keeps this share of the importance that the tree gives it.
NAMED = 0.5
#: Pages that a node needs before its importance counts.
MIN_PAGES = 8
#: A line is template on this share of the pages that have its path, if their content is as uneven as this.
LINE_SHARE = 0.8
LINE_CONTENT = 0.75

# Element names of HTML and words that name a part's role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead tr ul caption".split()
)
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",),
}
NOISE_TAGS = frozenset(
    "head title script style noscript template nav footer aside form button select option textarea input iframe object "
    "svg canvas audio video dialog menu".split()
)
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription signup login paywall sidebar sidebars menu "
    "menus nav navbar navigation breadcrumb breadcrumbs pager pagination footer masthead comment comments disqus respond "
    "reply replies share sharing social related recommended recommendations widget widgets toolbar".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
LINES = frozenset("p h2 h3 h4 h5 h6 li dt dd blockquote pre".split())
# Names of readers' comments; of talk that may be the article's; of the state of a page; of a remark's head.
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond replies".split())
TALK_WORDS = frozenset("discussion thread reply responses feedback".split())
STATE_WORDS = frozenset("open opened closed enabled disabled allowed has have no with without count counts link links on off".split())
HEAD_WORDS = frozenset("author user username avatar commenter posted date time datetime timestamp reply vcard".split())
CONTAINERS = frozenset("div section article ul ol dl details table".split())
RUNNING = frozenset("article main p h1 h2 h3 h4 h5 h6 pre blockquote table figure dl ol ul li td th tr tbody".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']|"[^"]*"|'[^']*')*+)>"""
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""(?i)\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
OPEN_END = re.compile(r"<[a-zA-Z/!?]")
WORDS = re.compile(r"[a-z]+")


#: Marks rows that say to which shape of page a path belongs, and rows of lines, beside kinds 0 and 1 of ``features``.
SHAPE = 2
LINE = 3


class Node:
    __slots__ = ("children", "head", "in_article", "label", "named", "noise", "parent", "path", "tag", "talk", "text")

    def __init__(self, tag: str, label: str, parent: Node | None, named: bool, talk: int = 0, head: bool = False):
        self.tag, self.label, self.parent = tag, label, parent
        self.noise = tag in NOISE_TAGS
        self.named = named and not self.noise and tag not in ("html", "body", "main")
        self.talk = talk if tag in CONTAINERS else 0
        self.head = head or tag == "time"
        self.children: list[Node] = []
        self.text: list[str] = []
        self.path = xxhash.xxh64_intdigest(label, parent.path if parent else 0)
        self.in_article = bool(parent and parent.in_article) or tag in ("article", "main")


def _label(tag: str, rest: str) -> tuple[str, bool, int, bool]:
    """The element's label in the tree, and what its names say.

    That it is no main text; that it holds comments (2) or talk (1); that it heads a remark.  A name
    such as ``comments-open`` tells the state of a page, not what the element holds.
    """
    if "=" not in rest:
        return tag, False, 0, False
    words: list[str] = []
    noise, talk = False, 0
    for name, value in ATTRIBUTE.findall(rest):
        value = value.lower()
        found = WORDS.findall(value)
        if name.lower() == "role":
            noise |= bool(NOISE_ROLES.intersection(found))
            continue
        words += found
        if not COMMENT_WORDS.isdisjoint(found) or not TALK_WORDS.isdisjoint(found):
            for each in value.split():
                parts = WORDS.findall(each)
                if STATE_WORDS.isdisjoint(parts):
                    talk = max(talk, 0 if TALK_WORDS.isdisjoint(parts) else 1, 0 if COMMENT_WORDS.isdisjoint(parts) else 2)
    noise |= bool(NOISE_WORDS.intersection(words))
    label = f"{tag}.{'.'.join(sorted(set(words))[:8])}" if words else tag
    return label, noise, talk, not HEAD_WORDS.isdisjoint(words)


def parse(page: str | None) -> tuple[Node, list[tuple[Node, str | None]]]:
    """The tree of a page and its pieces in order: (element, text), or (element, None) for a break.

    Unclosed and stray tags are mended as browsers do for paragraphs, list items and cells; a tag cut
    off at the end is dropped.  Elements nest as deep as they come; the depths of the open elements
    of each tag are at hand, so an end tag costs as much as it closes.
    """
    page = page or ""
    root = Node("", "", None, False)
    pieces: list[tuple[Node, str | None]] = []
    at, here, size = 0, root, len(page)
    opened: list[Node] = []
    depths: dict[str, list[int]] = {}
    blocks: list[int] = []

    def add(raw: str) -> None:
        if raw:
            value = html.unescape(raw) if "&" in raw else raw
            pieces.append((here, value))
            here.text.append(value)

    def deepest(tags: Iterable[str]) -> int:
        return max((depths[t][-1] for t in tags if depths.get(t)), default=-1)

    def close(tags: Sequence[str], barrier: int) -> bool:
        """Closes the deepest open element of these tags, unless one at the depth ``barrier`` lies deeper."""
        nonlocal here
        target = deepest(tags)
        if target < 0 or target < barrier:
            return False
        while len(opened) > target:
            tag = opened.pop().tag
            depths[tag].pop()
            if tag in BLOCK and tag != "p":
                blocks.pop()
        here = opened[-1] if opened else root
        return True

    def last_block() -> int:
        return blocks[-1] if blocks else -1

    while at < size:
        m = TOKEN.search(page, at)
        if not m:
            rest = page[at:]
            cut = OPEN_END.search(rest)
            add(rest[: cut.start()] if cut else rest)
            break
        add(page[at : m.start()])
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if not tag:
            continue
        tag = tag.lower()
        if m["end"] or m["end2"]:
            block = tag in BLOCK
            if not block:
                barrier = max(last_block(), deepest(("p",)))
            else:
                barrier = -1 if tag in ("tr", "tbody", "thead", "table") else deepest(("td", "th", "table"))
            if close((tag,), barrier) and block:
                pieces.append((here, None))
            continue
        if tag in BLOCK:
            pieces.append((here, None))
            if tag == "body":
                close(("head",), deepest(("body",)))
            if tag not in ("br", "hr"):
                close(("p",), last_block())
            if tag in CLOSES:
                close(CLOSES[tag], deepest(("ul", "ol", "dl", "table", "select")))
        rest = m["rest"] or m["rest2"] or ""
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"(?i)</{re.escape(tag)}[\s/>]").search(page, at)
            at = end.start() if end else size
            if end:
                close_at = page.find(">", at)
                at = close_at + 1 if close_at >= 0 else size
            continue
        if rest.endswith("/") and tag not in BLOCK:
            continue
        label, named, talk, head = _label(tag, rest)
        node = Node(tag, label, here, named, talk, head)
        here.children.append(node)
        here = node
        depths.setdefault(tag, []).append(len(opened))
        if tag in BLOCK and tag != "p":
            blocks.append(len(opened))
        opened.append(node)
    return root, pieces


def _walk(node: Node) -> Iterator[Node]:
    stack = [node]
    while stack:
        node = stack.pop()
        yield node
        stack += reversed(node.children)


def features(root: Node) -> dict[tuple[int, int], int]:
    """For each path of the page: hashes of its presentation (kind 0) and of its content (kind 1)."""
    styles: dict[int, list[str]] = {}
    texts: dict[int, list[str]] = {}
    for node in _walk(root):
        styles.setdefault(node.path, [])
        if node.children:
            run = [c.label for c in node.children]
            styles[node.path].append(",".join(x for i, x in enumerate(run) if not i or x != run[i - 1]))
        if node.text:
            texts.setdefault(node.path, []).extend(node.text)
    out = {(path, 0): xxhash.xxh64_intdigest(";".join(sorted(set(s)))) for path, s in styles.items()}
    for path, parts in texts.items():
        joined = " ".join("".join(parts).split())
        if joined:
            out[path, 1] = xxhash.xxh64_intdigest(joined.encode("utf-8", "surrogatepass"))
    return out


def lines(root: Node) -> dict[int, tuple[Node, int]]:
    """Lines inside an article or main by the id of their element: the outermost ones, and a hash of all their text."""
    out: dict[int, tuple[Node, int]] = {}
    stack = [root]
    while stack:
        node = stack.pop()
        if node.noise:
            continue
        if node.in_article and node.tag in LINES:
            text = " ".join("".join(t for n in _walk(node) for t in n.text).split())
            if text:
                out[id(node)] = node, xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), node.path)
        else:
            stack += node.children
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


Tree = dict[int, tuple[float, float]]


def threads(nodes: list[Node]) -> set[int]:
    """Elements of readers' comments: containers named after comments, and all that is in them.

    Names that may also head a part of the article (discussion, thread) count where the element is
    built like a thread: siblings of one label which each hold a name, a date or a time.  None where
    the page would have no article and no other main text without them.
    """
    heads: dict[int, bool] = {}
    built: dict[int, bool] = {}
    for node in reversed(nodes):
        heads[id(node)] = node.head or any(heads[id(c)] for c in node.children)
        of = [c.label for c in node.children if heads[id(c)]]
        built[id(node)] = len(set(of)) < len(of) or any(built[id(c)] for c in node.children)
    out: set[int] = set()
    noise: set[int] = set()
    for node in nodes:
        above = id(node.parent)
        if node.noise or above in noise:
            noise.add(id(node))
        if above in out or node.talk == 2 or (node.talk == 1 and built[id(node)]):
            out.add(id(node))
    if not out:
        return out
    others = [n for n in nodes if id(n) not in out and id(n) not in noise]
    scope = any(n.tag in ("article", "main") for n in others)
    if any(n.tag == "article" or ((n.in_article or not scope) and any(not t.isspace() for t in n.text)) for n in others):
        return out
    return set()


def _wrappers(nodes: list[Node], gone: set[int]) -> set[int]:
    """Elements that are or hold an article or main; not those of an article inside another, as comments are."""
    out: set[int] = set()
    inside: set[int] = set()
    for node in nodes:
        above = node.parent
        if above is not None and id(above) in inside:
            inside.add(id(node))
            continue
        if node.noise or id(node) in gone:
            inside.add(id(node))
        elif node.tag in ("article", "main"):
            if node.tag == "article":
                inside.add(id(node))
            up: Node | None = node
            while up is not None and id(up) not in out:
                out.add(id(up))
                up = up.parent
    return out


def _sizes(nodes: list[Node], gone: set[int]) -> dict[int, int]:
    """How much text each element holds."""
    size: dict[int, int] = {}
    for node in reversed(nodes):
        own = sum(len(t) - t.count(" ") for t in node.text)
        size[id(node)] = 0 if node.noise or id(node) in gone else own + sum(size[id(c)] for c in node.children)
    return size


def _template_lines(root: Node, nodes: list[Node], gone: set[int], same: frozenset[int]) -> set[int]:
    """Lines that the host repeats, if they are less than half of the lines' text: near copies of a page are no template."""
    found = [(node, _signed(mark) in same) for key, (node, mark) in lines(root).items() if key not in gone]
    if not any(hit for _, hit in found):
        return set()
    size = _sizes(nodes, gone)
    repeated = sum(size[id(node)] for node, hit in found if hit)
    if 2 * repeated >= sum(size[id(node)] for node, _ in found):
        return set()
    return {id(node) for node, hit in found if hit}


def _small_parts(nodes: list[Node], gone: set[int]) -> set[int]:
    """Elements in an article or main that hold less than half of its text."""
    size = _sizes(nodes, gone)
    out: set[int] = set()
    whole: dict[int, int] = {}
    for node in nodes:
        if node.parent is not None and node.parent.in_article:
            whole[id(node)] = whole[id(node.parent)]
            if 2 * size[id(node)] < whole[id(node)]:
                out.add(id(node))
        elif node.in_article:
            whole[id(node)] = size[id(node)]
        if node.tag == "article":
            whole[id(node)] = size[id(node)]
    return out


def extract(
    page: str | None, host_tree: Tree, all_tree: Tree, threshold: float = THRESHOLD, same: frozenset[int] = frozenset()
) -> str:
    """The main text of a page: pieces of branches that stay, blocks joined by one space.

    Readers' comments (``threads``) and lines that the host repeats (``same``) go, also inside an
    article or main.

    A word in a class, id or role that names a part beside the text never removes an element that is
    or holds an article or main, nor marks in program code.  Inside of an article it removes what
    holds less than half of its text.
    The importance of all others counts NAMED times if the tree knows them, and 0 if not; where that
    leaves a page without any text, the outermost of the unknown ones stay.
    """
    root, pieces = parse(page)
    nodes = list(_walk(root))
    gone = threads(nodes) if any(n.talk for n in nodes) else set()
    if same:
        gone |= _template_lines(root, nodes, gone, same)
    wrappers = _wrappers(nodes, gone)
    code: set[int] = set()
    for node in nodes:
        if node.tag in ("pre", "code") or id(node.parent) in code:
            code.add(id(node))
    named = {id(n) for n in nodes if n.named and id(n) not in wrappers and id(n) not in code}
    firm = _small_parts(nodes, gone) & named

    def lifted(levels: int) -> tuple[str, int]:
        return _text(nodes, pieces, gone, named, firm, host_tree, all_tree, threshold, levels)

    text, nested = lifted(0)
    if text or not nested:
        return text
    low, high = 1, nested
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if lifted(middle)[0] else (middle + 1, high)
    return lifted(low)[0]


def _text(
    nodes: list[Node],
    pieces: list[tuple[Node, str | None]],
    gone: set[int],
    named: set[int],
    firm: set[int],
    host_tree: Tree,
    all_tree: Tree,
    threshold: float,
    levels: int,
) -> tuple[str, int]:
    """The text that stays, and how deep elements with a name and unknown to the tree are nested.

    Names of the outermost ``levels`` of such elements don't count.
    """
    importance: dict[int, float] = {}
    unseen: set[int] = set()
    for node in reversed(nodes):
        path = _signed(node.path)
        judged = host_tree.get(path) or all_tree.get(path)
        style, content = judged or (1.0, 1.0)
        if node.noise or id(node) in gone:
            importance[id(node)] = 0.0
            continue
        parts = [importance[id(c)] for c in node.children]
        if any(t and not t.isspace() for t in node.text):
            parts.append(content)
        if not node.children:
            value = parts[0] if parts else 1.0
        else:
            kept = DAMPING ** len(parts)
            value = (1 - kept) * style + kept * sum(parts) / len(parts)
        if id(node) in named:
            if id(node) in firm:
                value = 0.0
            elif judged:
                value *= NAMED
            else:
                value = value if levels else 0.0
                unseen.add(id(node))
        importance[id(node)] = value
    has_article = any(n.tag in ("article", "main") and not n.noise and id(n) not in gone for n in nodes)
    stays: dict[int, bool] = {}
    level: dict[int, int] = {}
    for node in nodes:
        level[id(node)] = (level[id(node.parent)] if node.parent else 0) + (id(node) in unseen)
        above = node.parent is None or stays[id(node.parent)]
        if node.parent is None or node.tag in ("html", "body"):
            own = True
        elif node.noise or id(node) in gone or (node.tag == "header" and not node.parent.in_article):
            own = False
        elif id(node) not in named and node.in_article and (node.tag in RUNNING or node.tag not in BLOCK):
            own = True
        else:
            own = importance[id(node)] >= threshold and level[id(node)] <= levels
        stays[id(node)] = above and own
    blocks: list[list[str]] = [[]]
    for node, text in pieces:
        if text is None:
            blocks.append([])
        elif stays[id(node)] and (node.in_article or not has_article):
            blocks[-1].append(text)
    joined = (" ".join("".join(b).split()) for b in blocks if b)
    return " ".join(x for x in joined if x), max(level.values())


def host_key(url: Column) -> Column:
    """A hash of the host of an address (lower case, without user and port; empty if there is none)."""
    address = F.lower(F.coalesce(url, F.lit("")))
    return F.xxhash64(F.regexp_extract(address, r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def shape_of(paths: Iterable[int]) -> int:
    """A hash of a page's set of paths."""
    return xxhash.xxh64_intdigest(b"".join(p.to_bytes(8, "little") for p in sorted(paths)))


def importances(pages: DataFrame, url: str, page: str) -> DataFrame:
    """``host``, ``shape`` and ``tree``: importances of presentation and content of the paths of a shape, and template lines.

    A shape is the set of paths of a page; pages of a template share it.  Counts are summed on the
    map side first, so a host with a third of all pages is no hot group.  Every path on MIN_PAGES
    pages of its host is judged by them, others by the pages of all hosts if those are enough; the
    trees stay tables and meet the paths of each shape by joins, so only as much of a tree as a page
    has reaches a row.
    """

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            hosts, paths, kinds, hashes = [], [], [], []
            for host, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                root = parse(text)[0]
                made = features(root)
                of_page = {path for path, _ in made}
                shape = _signed(shape_of(of_page))
                for (path, kind), feature in made.items():
                    hosts.append(host)
                    paths.append(_signed(path))
                    kinds.append(kind)
                    hashes.append(_signed(feature))
                for path in of_page:
                    hosts.append(host)
                    paths.append(_signed(path))
                    kinds.append(SHAPE)
                    hashes.append(shape)
                for path, mark in {(node.path, mark) for node, mark in lines(root).values()}:
                    hosts.append(host)
                    paths.append(_signed(path))
                    kinds.append(LINE)
                    hashes.append(_signed(mark))
            columns = [pa.array(hosts, pa.int64()), pa.array(paths, pa.int64()), pa.array(kinds, pa.int8()), pa.array(hashes, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["host", "path", "kind", "feature"])

        return each

    rows = explode_batches(pages.select(host_key(F.col(url)).alias("host"), F.col(page).alias("page")), start, "host long, path long, kind byte, feature long")
    counted = written(rows.groupBy("host", "path", "kind", "feature").agg(F.count("*").alias("n")), "site-style")
    seen = counted.where(F.col("kind") < SHAPE)

    def entropies(counts: DataFrame, by: list[str]) -> DataFrame:
        of = counts.groupBy(*by, "kind").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("c"))
        even = F.when(F.col("m") > 1, F.greatest(F.lit(0.0), 1 - F.col("c") / (F.col("m") * F.log("m")))).otherwise(1.0)
        by_path = of.groupBy(*by).agg(
            F.max("m").alias("m"),
            F.coalesce(F.max(F.when(F.col("kind") == 0, even)), F.lit(1.0)).alias("style"),
            F.coalesce(F.max(F.when(F.col("kind") == 1, even)), F.lit(1.0)).alias("content"),
        )
        return by_path.where(F.col("m") >= MIN_PAGES)

    everywhere = seen.groupBy("path", "kind", "feature").agg(F.sum("n").alias("n"))
    shapes = counted.where(F.col("kind") == SHAPE).select("host", F.col("feature").alias("shape"), "path")
    of_path = entropies(seen, ["host", "path"])
    often = counted.where((F.col("kind") == LINE) & (F.col("n") >= MIN_PAGES)).select("host", "path", "feature", "n")
    same = (
        often.join(of_path, ["host", "path"])
        .where((F.col("n") >= LINE_SHARE * F.col("m")) & (F.col("content") >= LINE_CONTENT))
        .groupBy("host", "path")
        .agg(F.collect_list("feature").alias("same"))
    )
    near = of_path.join(same, ["host", "path"], "left").select("host", "path", F.struct("style", "content", "same").alias("near"))
    far = F.struct("style", "content", F.lit(None).cast("array<long>").alias("same"))
    of_host = join_hot(shapes, near, ["host", "path"], "left")
    all_pages = entropies(everywhere, ["path"]).select("path", far.alias("far"))
    both = join_hot(of_host, all_pages, ["path"], "left").withColumn("judged", F.coalesce("near", "far"))
    entry = F.struct("path", "judged.style", "judged.content", "judged.same")
    return both.where(F.col("judged").isNotNull()).groupBy("host", "shape").agg(F.collect_list(entry).alias("tree"))


def main_text(
    pages: DataFrame,
    url: str = "url",
    page: str = "html",
    keep: Sequence[str] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``row`` (the kept columns) and ``text``, the main text of each page.

    White space within a block is one space, blocks are joined by one space; NULL and empty pages
    and pages without main text give an empty text.  A NULL address belongs to the host "".  Rows are
    independent but for the tree; repeated rows count as pages of their own.  What the trees say of
    a page's paths comes by a join on its host and shape.  Kept columns travel in a struct, so their
    names clash with none of these.
    """
    trees = importances(pages, url, page)
    row = F.struct(*[F.col(f"`{c}`") for c in keep or pages.columns])
    given = pages.select(row.alias("row"), F.col(f"`{page}`").alias("page"), host_key(F.col(url)).alias("host"))

    def shapes() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [_signed(shape_of({n.path for n in _walk(parse(text)[0])})) for text in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], names=[*batch.schema.names, "shape"])

        return each

    ready = explode_batches(given, shapes, StructType([*given.schema.fields, StructField("shape", LongType())]))

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = []
            for text, tree in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                judged = {x["path"]: (x["style"], x["content"]) for x in tree or ()}
                same = frozenset(mark for x in tree or () for mark in x["same"] or ())
                texts.append(extract(text, judged, {}, threshold, same))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "text"])

        return each

    joined = join_hot(ready, trees, ["host", "shape"], "left").select("row", "page", "tree")
    return explode_batches(joined, start, StructType([joined.schema["row"], StructField("text", StringType())]))
