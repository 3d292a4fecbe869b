"""Main text of web pages by template deduction from equivalence classes.

Tokens are elements, named by their path (tag and class or id of every open element), and the text
of a whole block at a path. A token's occurrence vector is its count on each page of the host; instead of the
vector, Spark aggregates its support, its total and two sums of hashes of (page, count), which
are equal for equal vectors. Tokens of a host that share a vector are an equivalence class.

* A class is frequent if at least MIN_SHARE of the host's pages have it; hosts with fewer than
  MIN_PAGES pages give no template, since two pages may share a line by chance. Pages of a host whose text without tags is the same (repeated
  rows, mirrors, addresses with other parameters) count as one page here. So a template has at most 1 / MIN_SHARE times the tokens of
  an average page.
* A class is valid if it nests: all its elements whose parents are not of the class hang below
  elements of one other class.
* The valid classes, nested by their paths, are the template. Blocks of the class that is once
  on every page are template text, outside articles and main elements alone if articles are to
  stay whole (`whole_articles`, as in the registered queries). What is left are slots, named by their innermost template
  element; a slot of menu-like elements (mostly link text) or below a boilerplate element is dropped.

Names. An element whose class or id is made of boilerplate words alone ("cookie-notice", "site-header")
is dropped. A name that only holds such a word ("social-history") raises a suspicion, which the
element's class must confirm: it is dropped where it is in the template of its host.

The page's main element bounds the text: articles, else main elements, else the body; one that holds
less than MAIN_SHARE of what is left of the page is a teaser and doesn't. Blocks are joined in page order.

Defined results: null or empty html gives an empty text; null ids and addresses pass through
(pages without an address form one host); repeated rows are repeated, and an empty table gives an empty
result. Pages of any length are parsed whole, one at a time. Only the named columns are read.
"""

import html
import re
from operator import add

import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from ..operators.lineage import checked_broadcast
from ..sources.stages import staged

MIN_PAGES = 3
MAIN_SHARE = 0.2
MIN_SHARE = 0.5
LINK_SHARE = 0.6
MIN_LINKS = 3

# Element names of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe object svg math canvas audio video".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead "
    "title tr ul".split()
)
INLINE_CLOSED_BY_BLOCK = {"p"}
# A start tag closes these if they are open in the same list or table.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
BOUNDARY = {"ul", "ol", "dl", "table", "select", "menu"}
BOILERPLATE = set(
    "head title nav footer aside form button select textarea input label menu dialog search "
    "fieldset legend".split()
) | RAW
NEVER_NAMED = {"html", "body", "article", "main"}
NAMED = set(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored sponsors "
    "promo promotion promoted banner nav navbar navigation menu menus breadcrumb breadcrumbs header "
    "masthead topbar footer sidebar sidebars aside widget widgets notice notices cookie cookies "
    "consent gdpr popup modal overlay newsletter subscribe subscription signup signin login search "
    "pager pagination share sharing social related recommended comment comments disqus respond "
    "toolbar".split()
)
# Words that say nothing about what an element holds.
NEUTRAL = set(
    "site page main top bottom left right box block wrap wrapper container inner outer list item items "
    "section area bar link links post posts content text icon icons button buttons btn col row module "
    "panel group holder unit slot zone wide small large first last fixed mobile desktop global primary "
    "secondary the no js is has".split()
)
ROLES = set("navigation banner contentinfo complementary search form alert dialog menu menubar".split())

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"""
    r"""|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|</?[A-Za-z][^>]*+(?:>|\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"\d+")
# Names beside each other that differ in their numbers alone are told apart, this many of them.
VARIANTS = 8


class _Element:
    __slots__ = ("tag", "path", "dropped", "main", "link", "suspect", "names")

    def __init__(self, tag, path, dropped, main, link, suspect=False):
        self.tag, self.path, self.dropped, self.main, self.link = tag, path, dropped, main, link
        self.suspect = suspect
        # Numbered names of the elements inside, by their name without numbers.
        self.names = {}

    def step(self, tag, signature):
        """Name of an element inside: numbers don't count, but which of several numbers it is does."""
        name = f"{tag}{_DIGITS.sub('0', signature)}"
        if name == f"{tag}{signature}":
            return name
        known = self.names.setdefault(name, {})
        variant = known.setdefault(signature, len(known)) if len(known) < VARIANTS else known.get(signature, VARIANTS)
        return f"{name}~{variant}" if variant else name


def _names(attrs, inside):
    """Signature for the path, whether names or role say boilerplate, raise a suspicion, and whether
    the role is main.

    The header of an article (`inside`) is part of it.
    """
    found = {}
    for m in _ATTRIBUTE.finditer(attrs):
        found.setdefault(m[1].lower(), html.unescape((m[2] or "").strip("\"'")))
    named = " ".join(found.get(k, "") for k in ("class", "id"))
    boilerplate = NAMED - {"header"} if inside else NAMED
    role = found.get("role", "").strip().lower()
    out = role in ROLES or "hidden" in found or found.get("aria-hidden") == "true"
    suspect = False
    for name in named.split():
        parts = {p.lower() for p in _NAME_PART.findall(name)}
        if parts & boilerplate:
            suspect = True
            out = out or parts <= boilerplate | NEUTRAL
    signature = ".".join(named.split())
    return (f".{signature}" if signature else ""), out, suspect, role == "main"


def events(page, confirmed=frozenset()):
    """(kind, element, raw text): 'text', 'break' (of a block), 'space' or 'open', in page order.

    Suspect elements are dropped if their path is `confirmed`.
    """
    top = _Element("", "", False, 0, False)
    stack, at, size = [top], 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            yield "text", stack[-1], page[at:]
            return
        if m.start() > at:
            yield "text", stack[-1], page[at : m.start()]
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"]:
            depth = len(stack) - 1
            while depth and stack[depth].tag != tag:
                depth -= 1
            if depth:
                del stack[depth:]
            if tag in BLOCK:
                yield "break", stack[-1], None
            continue
        if tag in RAW and not m["attrs"].endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag in BLOCK:
            _close(stack, INLINE_CLOSED_BY_BLOCK, BLOCK - {"p"})
        if tag in CLOSES:
            _close(stack, CLOSES[tag], BOUNDARY)
        above = stack[-1]
        signature, named, suspect, role_main = (
            _names(m["attrs"], above.main == 2) if m["attrs"] else ("", False, False, False)
        )
        path = f"{above.path}/{above.step(tag, signature)}"
        named = named or (suspect and path in confirmed)
        dropped = above.dropped or tag in BOILERPLATE or (named and tag not in NEVER_NAMED)
        if tag == "header" and above.main < 2:
            dropped = True
        main = max(above.main, 2 if tag == "article" else 1 if tag == "main" or role_main else 0)
        element = _Element(tag, path, dropped, main, above.link or tag == "a", suspect)
        if tag == "br":
            yield "space", above, None
        elif tag in BLOCK:
            yield "break", above, None
        yield "open", element, None
        if tag not in VOID:
            stack.append(element)


def _close(stack, tags, until):
    """Close the innermost open element among `tags`, unless one of `until` is met first."""
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in tags:
            del stack[depth:]
            return
        if stack[depth].tag in until:
            return


def clean(raw):
    return " ".join(html.unescape(raw).split())


def blocks(found):
    """(path, level, text) of the blocks outside boilerplate; the path is that of their first run.

    The level is 2 in an article, 1 in another main element, 0 elsewhere.
    """
    first, runs = None, []
    for kind, element, raw in found:
        text_here = kind in ("text", "space") and not element.dropped
        if kind == "break" or (text_here and first is not None and first.main != element.main):
            text = clean("".join(runs))
            if text:
                yield first.path, first.main, text
            first, runs = None, []
        if text_here:
            first = first or element
            runs.append(raw or " ")
    text = clean("".join(runs))
    if text:
        yield first.path, first.main, text


def main_text(page, menus=(), constants=frozenset(), whole_articles=False, confirmed=frozenset()):
    """Blocks of the main element without boilerplate, menu slots and template text.

    `menus` is a tuple of paths that end with a slash.
    """
    left = [
        (main, text)
        for path, main, text in blocks(events(page or "", confirmed))
        if not (menus and f"{path}/".startswith(menus))
        and not (constants and not (whole_articles and main) and block_hash(path, text) in constants)
    ]
    size = sum(len(text) for _, text in left)
    inside = {level: sum(len(text) for main, text in left if main >= level) for level in (2, 1, 0)}
    level = next(x for x in (2, 1, 0) if inside[x] >= size * MAIN_SHARE and (inside[x] or not x))
    return "\n".join(text for main, text in left if main >= level)


def block_hash(path, text):
    return xxhash.xxh64_intdigest(f"{path}\0{text}".encode("utf-8", "surrogatepass")) >> 1


def page_tokens(page):
    """{(path, block): [count, chars, link chars, links, suspects]}: block 0 is the element itself."""
    tokens = {("", 0): [1, 0, 0, 0, 0]}
    found = list(events(page or ""))
    for kind, element, raw in found:
        if kind == "open":
            entry = tokens.setdefault((element.path, 0), [0, 0, 0, 0, 0])
            entry[0] += 1
            entry[4] += element.suspect
            if element.tag == "a":
                for path in _ancestors(element.path):
                    tokens[path, 0][3] += 1
        elif kind == "text":
            size = len(clean(raw))
            for path in _ancestors(element.path) if size else ():
                entry = tokens[path, 0]
                entry[1] += size
                entry[2] += size * element.link
    for path, _, text in blocks(found):
        tokens.setdefault((path, block_hash(path, text)), [0, 0, 0, 0, 0])[0] += 1
    return tokens


def _ancestors(path):
    while path:
        yield path
        path = path.rpartition("/")[0]


def host_of(url):
    m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", url or "")
    return m[1].lower() if m else ""


_SUMS = ["support", "total", "low", "high", "chars", "link_chars", "links", "suspects"]
_TOKENS = "host string, path string, block long, " + ", ".join(f"{c} long" for c in _SUMS) + ", pages double"
# What two copies of a page may differ in: scripts, styles, comments and tags with their attributes.
_UNSEEN = r"(?is)<(script|style)\b.*?(?:</\1\s*>|\z)|<!--.*?(?:-->|\z)|<[^<>]*+>"


def _count_tokens(batches):
    for batch in batches:
        sums = {}
        columns = ("page_id", "url", "html", "copies")
        for page_id, url, page, copies in zip(*(batch.column(c).to_pylist() for c in columns)):
            host = host_of(url)
            for (path, block), (n, *others) in page_tokens(page).items():
                mark = xxhash.xxh64_intdigest(f"{page_id}\0{url}\0{n}")
                row = (1, n, mark & 0xFFFFFFFF, mark >> 32, *others, 1 / copies)
                old = sums.get((host, path, block))
                sums[host, path, block] = row if old is None else tuple(map(add, old, row))
        keys = list(zip(*sums)) or [[], [], []]
        values = list(zip(*sums.values())) or [[]] * (len(_SUMS) + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys[0], pa.string()), pa.array(keys[1], pa.string()), pa.array(keys[2], pa.int64())]
            + [pa.array(v, pa.int64()) for v in values[:-1]]
            + [pa.array(values[-1], pa.float64())],
            names=["host", "path", "block", *_SUMS, "pages"],
        )


def _pages(pages, id_col, url_col, html_col, *others):
    return pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), *others
    )


def _host(url):
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return F.coalesce(host, F.lit(""))


def _with_copies(rows):
    """The rows with the number of rows of their host that show the same text."""
    shown = F.regexp_replace(F.coalesce("html", F.lit("")), _UNSEEN, "")
    rows = rows.withColumns({"host": _host("url"), "shown": F.xxhash64(shown)})
    copies = rows.groupBy("host", "shown").agg(F.count("*").alias("n")).where("n > 1")
    rows = rows.join(checked_broadcast(copies), ["host", "shown"], "left")
    return rows.select("page_id", "url", "html", F.coalesce("n", F.lit(1)).alias("copies"))


def equivalence_classes(pages, id_col="page_id", url_col="url", html_col="html"):
    """Frequent tokens (host, path, block) with their class (`vector`), its parent and `valid`."""
    rows = _with_copies(_pages(pages, id_col, url_col, html_col)).mapInArrow(_count_tokens, _TOKENS)
    different = F.round(F.sum("pages"), 6).alias("pages")
    tokens = rows.groupBy("host", "path", "block").agg(*[F.sum(c).alias(c) for c in _SUMS], different)
    vector = F.struct("support", "total", "low", "high").alias("vector")
    tokens = staged(tokens.where(F.col("support") > 1).select("host", "path", "block", vector, *_SUMS[4:], "pages"), "tokens")
    hosts = tokens.where("path = ''").select(
        "host", F.col("vector").alias("everywhere"), F.col("pages").alias("all_pages")
    )
    hosts = hosts.where(F.col("all_pages") >= MIN_PAGES)
    frequent = tokens.join(hosts, "host").where(F.col("pages") >= F.col("all_pages") * MIN_SHARE)
    # A block is template text only in the class of what is once on every page.
    frequent = frequent.where((F.col("block") == 0) | (F.col("vector") == F.col("everywhere")))
    above = frequent.where("block = 0").select(
        "host", F.col("path").alias("above"), F.col("vector").alias("parent")
    )
    parent_path = F.when(F.col("block") != 0, F.col("path")).otherwise(
        F.regexp_replace("path", "/[^/]*$", "")
    )
    placed = frequent.withColumn("above", parent_path).join(above, ["host", "above"], "left")
    outside = F.when(F.col("parent") != F.col("vector"), F.col("parent"))
    nested = placed.groupBy("host", "vector").agg(
        (F.count_distinct(outside) <= 1).alias("valid"), F.min(outside).alias("parent_class")
    )
    return placed.drop("parent").join(nested, ["host", "vector"])


def templates(pages, id_col="page_id", url_col="url", html_col="html"):
    """(host, menus, constants, confirmed): per host the menu-like template elements, the template text,
    and the template elements with a suspect name."""
    tokens = equivalence_classes(pages, id_col, url_col, html_col).where("valid")
    pages_with = F.col("vector.support")
    menu = (
        (F.col("block") == 0)
        & F.regexp_extract("path", "/([^/.]*)[^/]*$", 1).isin("ul", "ol", "div", "section", "table")
        & (F.col("link_chars") >= F.col("chars") * LINK_SHARE)
        & (F.col("links") >= pages_with * MIN_LINKS)
        & ~F.col("path").rlike(r"/(article|main)[./]")
    )
    return tokens.groupBy("host").agg(
        F.collect_list(F.when(menu, F.col("path"))).alias("menus"),
        F.collect_list(F.when(F.col("block") != 0, F.col("block"))).alias("constants"),
        F.collect_list(F.when(F.col("suspects") > 0, F.col("path"))).alias("confirmed"),
    )


def _extract(whole_articles, kept):
    def run(batches):
        for batch in batches:
            texts = [
                main_text(
                    page, tuple(f"{m}/" for m in menus or ()), frozenset(constants or ()), whole_articles,
                    frozenset(confirmed or ()),
                )
                for page, menus, constants, confirmed in zip(
                    *(batch.column(c).to_pylist() for c in ("html", "menus", "constants", "confirmed"))
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    *(batch.column(c) for c in kept),
                ],
                names=["page_id", "url", "text", "n_chars", *kept],
            )

    return run


def extract(pages, id_col="page_id", url_col="url", html_col="html", whole_articles=False, kept=None):
    """page_id, url, text, n_chars of every page, and the columns `kept` (name: column of `pages`)."""
    kept = kept or {}
    rows = _pages(pages.withColumns(kept), id_col, url_col, html_col, *kept)
    rows = rows.withColumn("host", _host("url"))
    found = checked_broadcast(staged(templates(pages, id_col, url_col, html_col), "templates"), 100_000)
    joined = rows.join(found, "host", "left")
    kind = rows.schema["page_id"].dataType.simpleString()
    schema = f"page_id {kind}, url string, text string, n_chars long"
    schema += "".join(f", {c} {rows.schema[c].dataType.simpleString()}" for c in kept)
    return joined.mapInArrow(_extract(whole_articles, list(kept)), schema)


def report(pages):
    return extract(pages)
