"""HTML extraction with a site style tree.

The DOMs of a host's pages are merged by path (tags with their classes and ids). For each path of the merged tree:
- presentation importance: the entropy, to the base of the number of pages, of the child sequences that its pages show
  (one look on all pages: 0; a look of its own on every page: 1);
- content importance: 1 less the mean over its text blocks (and those below it) of the entropy of a block's spread over
  the pages, log_m(pages that hold it) (the same blocks on all pages: 0; blocks of one page each: 1);
- composite importance: a weighted sum of both. Branches under `least` are template, and are removed from every page of
  the host. Pages of a host with equal main text count once, so copies of an article do not make it template.
The tree is that of the whole body, menus, footers and bare elements (p, h1, li, ...) included. From the body down, a
section (an element that is no bare text element) that lies more than `slack` under the best of its siblings is template
too; one outside the article that keeps up with it is content. `slack` is more than the looks can weigh, so it is
repetition of text that decides. Two checks: the article or main elements of a page are content whatever the tree says of
them as a whole, and presentation that names its own role (nav, footer, aside, form, script, style, ..., or such a word
in class, id or role; inside an article, only where the name has no other words) is not, nor is an article element that
is named a comment: on many sites menus and notices differ from page to page. On hosts with few pages the tree
shows nothing and the checks decide alone.

Plan: a pass parses the pages and emits (host, main text, path, block or look) as 64-bit hashes, aggregated in two steps
with partial sums, so a hot host spreads over tasks; only judged paths (those on `min_pages` pages of a host or more)
come back to the pages: broadcast if they are few, else by a join on host and a salt. A second pass extracts.

Text: character references decoded, white space in a block collapsed to one space, blocks joined by a line break; a
line break element ends a block. The article of a page is its outermost article elements, else main, else the body.

Defined cases: null html is empty and gives empty text; null or hostless urls share no tree; broken markup is taken as
it comes; repeated pages are separate rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_arrow

#: Fixed sets of HTML element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe object svg canvas audio video select button".split())
NOISE = frozenset("nav footer aside form dialog menu head".split()) | RAW
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements over all others, of which a page has one.
TOP = frozenset(("", "html", "body"))
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt td th tr tbody thead pre blockquote b i em strong span a html body main article".split())
#: Elements that the start of another of their set ends.
ENDS = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Words of a class, id or role that name a part of a page beside the article.
ROLES = re.compile(
    r"(?:^|[-_\s])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|sidebar\w*|side|widget\w*|comments?|reply|replies|disqus|cookies?|consent|notices?|"
    r"newsletter|subscribe|signup|login|share|sharing|social|related|recommended|breadcrumbs?|pagination|pager|menu|nav|navbar|navigation|footer|"
    r"masthead|site-header|topbar|toolbar|popup|modal|overlay|disclaimer|copyright|skip|search|contentinfo|complementary)(?:$|[-_\s])",
    re.IGNORECASE,
)
#: Parts of a name that say nothing of the content, beside digits.
NEUTRAL = frozenset(
    "area bar block body bottom box btn button buttons card child col container content depth even first form group head header inner item items "
    "js last left level link links list module odd outer panel parent post posts right row section slot text thread title top unit wrap wrapper".split()
)
#: What names a reader comment, as a whole class, id or role.
COMMENT = re.compile(r"(?:comments?|reply|replies)(?:[-_]?\d+)?", re.IGNORECASE)
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*(?:>|\Z)|[^<]+|<", re.DOTALL
)
#: One attribute: its whole name, and its value if there is one. A value is never taken for a name.
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Inside an article, a heading is content whatever its name; of these others the id is an anchor, and names no role.
HEADINGS, ANCHORED = frozenset("h1 h2 h3 h4 h5 h6".split()), frozenset("p section li dt dd td th tr table blockquote pre figure figcaption b i em strong span a".split())
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)"


def hash64(*parts) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(map(str, parts)).encode("utf-8", "surrogatepass"), digest_size=8).digest(), signed=True)


class Node:
    __slots__ = ("tag", "path", "noise", "parent", "children", "plain", "inside")

    def __init__(self, tag: str, key: str, noise: bool, plain: bool, parent: Node | None) -> None:
        self.tag, self.noise, self.plain, self.parent, self.children = tag, noise, plain, parent, []
        self.inside = tag in ("article", "main") or parent is not None and parent.inside
        self.path = hash64(parent.path if parent else 0, key)


def parse(page: str) -> Node:
    """The tree of a page; children are nodes and strings."""
    root = Node("", "", False, True, None)
    at, stack, pos = root, [root], 0
    keys: dict[tuple[str, str], tuple[str, bool, bool]] = {}
    while m := _TOKEN.match(page, pos):
        pos = m.end()
        tag = m[2] or m[5]
        if not tag:
            token = m[0]
            if token[0] != "<" or token == "<":
                at.children.append(token)
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    at = stack[-1]
                    break
            continue
        attributes = m[3] or m[6] or ""
        if tag in BLOCK and at.tag == "p" or tag in BLOCK and any(n.tag == "p" for n in stack[-4:]):
            while any(n.tag == "p" for n in stack) and stack[-1].tag not in ("article", "main", "body", "div", "section", "td", "li"):
                was = stack.pop()
                if was.tag == "p":
                    break
            at = stack[-1]
        if tag in ENDS and at.tag in ENDS[tag]:
            while stack[-1].tag in ENDS[tag]:
                stack.pop()
            at = stack[-1]
        if (tag, attributes) not in keys:
            keys[tag, attributes] = _key(tag, attributes)
        key, named, only = keys[tag, attributes]
        node = Node(tag, key, tag in NOISE or (only if at.inside else named), tag in TEXTUAL and key == tag, at)
        at.children.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            if tag in ("script", "style", "textarea", "title", "iframe"):
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, pos)
                if end is None and tag != "title":
                    break
                pos = end.end() if end else pos
                continue
        stack.append(node)
        at = node
    return root


def _key(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """A style's name in paths, whether it names a role beside the article, and whether it names nothing else, as it must
    inside an article: there a name of other words too (`notice-board-history`, `left side`) is about the content."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(attributes) if attributes.strip() else ():
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    names = [found[k] for k in ("class", "id", "role") if found.get(k)]
    hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true"
    if tag in ("html", "body", "article", "main"):
        named = only = tag == "article" and any(COMMENT.fullmatch(x) for n in names for x in n.split())
    else:
        own = [] if tag in HEADINGS else [found[k] for k in ("class", "id", "role") if found.get(k) and (k != "id" or tag not in ANCHORED or COMMENT.fullmatch(found[k]))]
        named, only = any(ROLES.search(n) for n in names), any(_only_role(n, tag) for n in own)
    return ".".join([tag, *sorted(" ".join(names).split())]), named or hidden, only or hidden


def _only_role(name: str, tag: str) -> bool:
    """Whether a class, id or role is made of role words, neutral parts and digits, with a role word among them. On text
    elements (p, li, h1, ...) the words of place (side, search) are no roles."""
    parts = [p for p in re.split(r"[-_\s]+", name.lower()) if p]
    roles = [bool(ROLES.fullmatch(p)) and not (tag in TEXTUAL and p in ("side", "search")) for p in parts]
    return any(roles) and all(r or p in NEUTRAL or p.isdigit() for p, r in zip(parts, roles, strict=True))


def main_nodes(root: Node) -> list[Node]:
    """The outermost article elements outside noise, else main elements, else the page."""
    for tag in ("article", "main"):
        found, stack = [], [root]
        while stack:
            node = stack.pop()
            if node.tag == tag and not node.noise:
                found.append(node)
            elif not node.noise:
                stack += [c for c in reversed(node.children) if isinstance(c, Node)]
        if found:
            return found
    return [root]


def blocks(node: Node, drop=frozenset(), whole: bool = False) -> list[tuple[Node, str]]:
    """(innermost block element, text) of the text blocks in page order, without noise (unless `whole`) and dropped branches."""
    out: list[tuple[Node, str]] = []
    pending: list[str] = []

    def flush(owner: Node) -> None:
        if pending:
            text = " ".join(entities.unescape("".join(pending)).split())
            pending.clear()
            if text:
                out.append((owner, text))

    inside = node.tag in ("article", "main")
    stack: list[tuple] = [(node, node, False)]
    while stack:
        item, owner, closing = stack.pop()
        if closing:
            flush(owner)
        elif isinstance(item, str):
            pending.append(item)
        elif item is not node and (item.tag in RAW or item.tag == "head" if whole else item.noise or not inside and item.tag == "header" or item.path in drop):
            if item.tag in BLOCK:
                flush(owner)
        else:
            mine = item if item.tag in BLOCK else owner
            if mine is item:
                flush(owner)
                stack.append((None, item, True))
            stack += [(c, mine, False) for c in reversed(item.children)]
    flush(node)
    return out


def picked(root: Node, judged: dict[int, float], least: float = 0.1, slack: float = 0.15, named: bool = True) -> tuple[list[Node], set[int]]:
    """The nodes that hold the main text, in page order, and the paths of template branches, by the importance of the
    host's paths. Without `named`, the tree alone decides: article elements and roles count as any other."""
    main = main_nodes(root) if named else [root]
    drop = {path for path, v in judged.items() if v < least}
    if not judged:
        return main, drop
    out: list[Node] = []
    stack: list[tuple[Node, bool]] = [(root, main[0] is root)]
    while stack:
        node, within = stack.pop()
        marked = any(node is m for m in main)
        if marked:
            out.append(node)
        within |= marked
        under = [c for c in node.children if isinstance(c, Node) and c.tag not in RAW and c.tag != "head"]
        best = max((judged[c.path] for c in under if c.path in judged and not (named and c.noise)), default=0.0)
        for c in reversed(under):
            if named and c.noise or c.path in drop and not any(c is m for m in main):
                continue
            section = not c.plain or c.tag in ("article", "main")
            if section and judged.get(c.path, best) < best - slack and not any(c is m for m in main):
                drop.add(c.path)
                continue
            # A section beside the article's branch that keeps up with it; sections over the article are gone into.
            if not within and section and c.path in judged and c.tag != "header" and not any(_over(c, m) for m in main):
                out.append(c)
                stack.append((c, True))
            else:
                stack.append((c, within))
    if len(out) > len(main):
        place = {id(n): i for i, n in enumerate(_nodes(root))}
        out.sort(key=lambda n: place[id(n)])
    return out, drop


def _over(node: Node, other: Node | None) -> bool:
    while other is not None and other is not node:
        other = other.parent
    return other is node


def _nodes(root: Node):
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack += [c for c in reversed(node.children) if isinstance(c, Node)]


def main_text(page: str, judged: dict[int, float] | None = None, least: float = 0.1) -> str:
    nodes, drop = picked(parse(page), judged or {}, least)
    return "\n".join(text for node in nodes for _, text in blocks(node, drop))


def observations(page: str) -> tuple[int, set[tuple[int, bool, int]]]:
    """A hash of the main text, and (path, whether a look, hash of the look or block) of the branches of the body."""
    seen: set[tuple[int, bool, int]] = set()
    root, looks = parse(page), {}
    for owner, text in blocks(root, whole=True):
        feature = hash64(text)
        up: Node | None = owner
        while up is not None and up.tag not in TOP:
            seen.add((up.path, False, feature))
            looks.setdefault(up.path, {})[id(up)] = up
            up = up.parent
    # One look a path, of all its elements, so that looks count pages.
    for path, nodes in looks.items():
        seen.add((path, True, hash64(*(" ".join(c.tag for c in n.children if isinstance(c, Node)) for n in nodes.values()))))
    return hash64(*(text for node in main_nodes(root) for _, text in blocks(node))), seen


def importance(pages: DataFrame, gamma: float = 0.9) -> DataFrame:
    """(host, path, pages, importance) of the branches of every host's tree."""

    def per_task(batches):
        for batch in batches:
            out = {k: [] for k in ("host", "main", "path", "look", "feature")}
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                main, seen = observations(page or "")
                for path, look, feature in seen:
                    for k, v in zip(out, (host, main, path, look, feature), strict=True):
                        out[k].append(v)
            yield out

    hosted = pages.select(F.lower(F.regexp_extract("url", _HOST, 1)).alias("host"), "html").where("host <> ''")
    rows = map_arrow(hosted, ["host", "html"], per_task, "host string, main bigint, path bigint, look boolean, feature bigint").distinct()
    spread = rows.groupBy("host", "path", "look", "feature").agg(F.count("*").alias("n"))
    looks = F.when(F.col("look"), F.col("n"))
    by_path = spread.groupBy("host", "path").agg(
        F.sum(looks).alias("m"), F.sum(looks * F.log(looks.cast("double"))).alias("nlogn"), F.avg(F.when(~F.col("look"), F.log(F.col("n").cast("double")))).alias("spread")
    )
    base = F.log(F.col("m").cast("double"))
    presentation, content = (base - F.col("nlogn") / F.col("m")) / base, 1 - F.least(F.lit(1.0), F.col("spread") / base)
    return by_path.where("m > 1").select("host", "path", F.col("m").alias("pages"), ((1 - gamma) * presentation + gamma * content).alias("importance"))


def extract(pages: DataFrame, least: float = 0.1, min_pages: int = 8) -> DataFrame:
    """page_id, url, text, n_chars: one row per page."""
    shown = importance(pages).where(F.col("pages") >= min_pages)
    judged = cut(shown.groupBy("host").agg(F.collect_list(F.struct("path", "importance")).alias("judged")))
    own = pages.select("page_id", "url", "html", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), _HOST, 1)).alias("host"))

    def per_task(batches):
        for batch in batches:
            trees = batch.column("judged").to_pylist()
            texts = [main_text(page or "", {x["path"]: x["importance"] for x in t or ()}, least) for page, t in zip(batch.column("html").to_pylist(), trees, strict=True)]
            yield {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts, "n_chars": [len(t) for t in texts]}

    return map_arrow(with_trees(own, judged), ["page_id", "url", "html", "judged"], per_task, "page_id bigint, url string, text string, n_chars bigint")


def with_trees(pages: DataFrame, judged: DataFrame, most: int = 200_000, salts: int = 64) -> DataFrame:
    """pages with the judged paths of their host. Few paths are broadcast, so pages stay where they are; more than `most`
    are joined on host and a salt, which deals a hot host's pages to many tasks."""
    if (judged.agg(F.sum(F.size("judged"))).first()[0] or 0) <= most:
        return pages.join(F.broadcast(judged), "host", "left")
    salted = judged.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return pages.withColumn("salt", F.pmod(F.xxhash64("page_id", "html"), F.lit(salts)).cast("int")).join(salted, ["host", "salt"], "left")
