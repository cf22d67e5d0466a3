"""Main text of web pages by a site style tree.

1. Every page becomes its element tree; an element's style is its path of tags with their class and
   id (digits aside). The trees of one host are merged by style, and those of all hosts once more,
   each path counted from its nearest landmark on. For each style of a merged tree two entropies
   are counted distributedly:

   * repetition: of a text on c of the m pages that show its style the entropy over pages is log c;
     the mean over the style's distinct texts, divided by log m. 0 if every page has its own texts,
     1 if all share them.
   * presentation: the entropy over the variants of what stands below the style, divided by that of
     variants that are all different.

   The host's are pulled towards those of all hosts by as much as ``PULL`` pages weigh, so hosts of
   a few pages need no rule of their own; repetition is at least that of all hosts.
2. On a page the repetition of a branch is the mean of its texts' styles, by length, its
   presentation the largest below it. A branch is noise, and goes with all its texts, if

       repetition >= BASE + SLOPE * presentation + (INSIDE, within an article or main element)

   that is, if its texts recur more than its looks vary. Where the page states that a branch is no
   main text (a tag such as nav or footer; outside articles also a class, id or role) the bound is
   SLOPE * (presentation - HALF) or 0, so the statement settles a tie, and looks that vary like a
   text's overrule it. Of a style that the tree does not hold nothing is removed.
   A page is never all noise: if no text is left, of those outside stated branches those within
   articles stay, if there are such, and of these those that are no noise by themselves.
3. What remains is decoded; white space within a block becomes one space, and blocks are joined by
   an empty line.

Of the merged trees the entropies above 0, and the styles that state what they are, go back to
the pages, as one list for each host; the
lists are broadcast if all together hold at most ``SMALL`` styles, and otherwise joined by host and
a salt, so that the pages of a large host do not meet in one task.

Defined cases: null html counts as empty and gives an empty text; null or malformed URLs share the
host ""; pages cut off anywhere, stray brackets and unclosed elements are read as browsers would;
scripts, styles, form controls, comments and embedded objects are no text; repeated rows give equal
texts; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemoor.llm.shared import discard, map_arrow, materialise

BASE, SLOPE, HALF, INSIDE, PULL = 0.07, 0.55, 0.5, 0.2, 20
SMALL, SALTS = 200_000, 16

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
#: HTML's elements without content, those whose content is no markup, blocks, and what a start tag closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe object svg select option button canvas audio video".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("td th tr tbody thead tfoot caption html head body li dd dt".split()) | {"hr"}
ALIKE = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = {"li": ("ul", "ol", "menu"), "dd": ("dl",), "dt": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr")}
#: Tags and words of classes, ids and roles that state a part is not main text, and words that may stand beside these.
PLAIN_TAGS = frozenset("nav footer aside form dialog menu".split())
PLAIN_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead banner topbar footer colophon sidebar aside widget widgets ad ads adv advert adverts advertisement advertising "
    "sponsor sponsored promo promoted promotion cookie cookies consent gdpr notice alert popup modal newsletter subscribe subscription signup login search searchbox form comment comments respond "
    "disqus replies share sharing social related recommended recommendations pagination pager toolbar tags tagcloud copyright disclaimer skip contentinfo complementary".split()
)
BESIDE = frozenset("site main top bottom page left right global primary secondary box bar block wrap wrapper container list area link links".split())
MAIN_TAGS = frozenset(["article", "main"])
WORD = re.compile(r"[a-z]+")
DIGITS = re.compile(r"[0-9]+")


def stated(names: str) -> bool:
    """Whether one of these classes, ids or roles consists of plain words, perhaps with words that may stand beside them."""
    for name in names.lower().split():
        words = set(WORD.findall(name))
        if not words.isdisjoint(PLAIN_WORDS) and words <= PLAIN_WORDS | BESIDE:
            return True
    return False


class Node:
    """side: 1 within an article or main element, -1 within a branch that states it is no main text, else 0, by the nearest of these. near: the style from there on."""

    __slots__ = ("parent", "tag", "style", "near", "side", "below", "weight", "noise", "looks", "noisy", "gone")

    def __init__(self, parent: Node | None, tag: str, attributes: str) -> None:
        self.parent, self.tag = parent, tag
        own, role, hidden = "", "", False
        if attributes:
            for m in ATTRIBUTE.finditer(attributes):
                name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if name == "hidden" or name == "aria-hidden" and value == "true":
                    hidden = True
                elif name == "role":
                    role = value
                else:
                    own += " " + value
        side = parent.side if parent else 0
        label = f"<{tag}{DIGITS.sub('0', own)}".encode("utf-8", "replace")
        self.style = style_hash(parent.style if parent else 0, label)
        if tag in MAIN_TAGS or role == "main":
            self.side = 1
        elif hidden or tag in PLAIN_TAGS or side < 1 and (tag == "header" or tag not in ("html", "body") and (own or role) and stated(f"{own} {role}")):
            self.side = -1
        else:
            self.side = side
        self.near = style_hash(0 if self.side != side else parent.near if parent else 0, label)
        self.below: list[str] = []
        self.weight = self.noise = self.looks = 0.0
        self.noisy = self.gone = False


@lru_cache(maxsize=100_000)
def style_hash(above: int, label: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(above.to_bytes(8, "little", signed=True) + label, digest_size=8).digest(), "little", signed=True)


def blocks(page: str) -> tuple[list[Node], list[tuple[Node, str]]]:
    """All elements of a page, and its texts by block, in page order, undecoded entities resolved."""
    root = at = Node(None, "", "")
    nodes, out, text, owner = [root], [], [], root
    pos, n = 0, len(page)

    def flush():
        nonlocal text
        if text:
            whole = " ".join(html.unescape("".join(text)).split())
            if whole:
                out.append((owner, whole))
            text = []

    def add(piece: str):
        nonlocal owner
        if not text:
            if not piece.strip():
                return
            owner = at
        elif owner is not at and owner.side != at.side and piece.strip():
            flush()
            owner = at
        text.append(piece)

    while pos < n:
        m = TOKEN.search(page, pos)
        if m is None:
            add(page[pos:])
            break
        if m.start() > pos:
            add(page[pos : m.start()])
        pos = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if tag == "p" or tag in BLOCK:
                flush()
            up = at
            while up.parent is not None and up.tag != tag:
                up = up.parent
            if up.parent is not None:
                at = up.parent
            continue
        if tag in RAW:
            if not (m[3] or m[6] or "").endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}[^>]*(?:>|\Z)", re.I).search(page, pos)
                pos = end.end() if end else n
            continue
        if tag in BLOCK:
            flush()
            if tag in CLOSES_P:
                up = at
                while up.parent is not None and up.tag != "p" and up.tag not in ("table", "td", "th", "button"):
                    up = up.parent
                if up.tag == "p":
                    at = up.parent
            if tag in ALIKE:
                up, stop = at, SCOPE.get(tag, ())
                while up.parent is not None and up.tag not in ALIKE[tag] and up.tag not in stop:
                    up = up.parent
                if up.tag in ALIKE[tag]:
                    at = up.parent
        if tag in VOID:
            if tag == "br" and text:
                text.append(" ")
            continue
        node = Node(at, tag, m[3] or m[6] or "")
        at.below.append(tag)
        nodes.append(node)
        at = node
    flush()
    return nodes, out


def host_of(url: str | None) -> str:
    m = re.match(r"\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def _hash(x: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(x, digest_size=8).digest(), "little", signed=True)


def _count(batches):
    """(host, style, near, kind, feature, pages): by page the variants of what stands below a style (0), its texts (1), and the style itself (2; feature: its side)."""
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            seen: Counter = Counter()
            for url, raw in zip(part.column("url").to_pylist(), part.column("html").to_pylist(), strict=True):
                host = _hash(host_of(url).encode())
                nodes, texts = blocks((raw or b"").decode("utf-8", "replace"))
                page = {(host, n.style, n.near, 0, style_hash(0, "".join(f"<{t}" for t in n.below).encode())) for n in nodes}
                page |= {(host, n.style, n.near, 2, n.side) for n in nodes}
                page |= {(host, n.style, n.near, 1, _hash(t.encode("utf-8", "replace"))) for n, t in texts}
                seen.update(page)
            rows = [(*k, c) for k, c in seen.items()]
            cols = zip(*rows, strict=True) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["host", "style", "near", "kind", "feature", "pages"])


def feature_counts(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The merged trees of the hosts: host, style, near, kind, feature, c (pages that show it)."""
    rows = pages.select(F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("binary").alias("html"))
    counts = map_arrow(rows, _count, "host long, style long, near long, kind int, feature long, pages long")
    return counts.groupBy("host", "style", "near", "kind", "feature").agg(F.sum("pages").alias("c"))


def entropies(counts: DataFrame, *by: str) -> DataFrame:
    """For each style (``by``): pages that show it, repetition, presentation, side."""
    c = F.col("c").cast("double")
    of = lambda kind, x: F.coalesce(F.sum(F.when(F.col("kind") == kind, x)), F.lit(0.0))
    sums = counts.groupBy(*by).agg(of(2, c).alias("m"), of(0, c).alias("m0"), of(0, c * F.log(c)).alias("s0"), of(1, F.lit(1.0)).alias("n1"), of(1, F.log(c)).alias("s1"), F.min(F.when(F.col("kind") == 2, F.col("feature"))).alias("side"))
    repetition = F.when((F.col("n1") > 0) & (F.col("m") > 1), F.col("s1") / F.col("n1") / F.log("m")).otherwise(0.0)
    presentation = F.when(F.col("m0") > 1, (F.log("m0") - F.col("s0") / F.col("m0")) / F.log("m0")).otherwise(0.0)
    return sums.select(*by, F.col("m").cast("long").alias("pages"), F.least(repetition, F.lit(1.0)).alias("repetition"), F.greatest(presentation, F.lit(0.0)).alias("presentation"), "side")


def importance(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """By host: host, styles (array of style, repetition, presentation: the host's pulled towards that of all hosts; those above 0, or stated)."""
    counts = materialise(feature_counts(pages, url_col, html_col), "counts")
    own = entropies(counts, "host", "style", "near")
    everywhere = entropies(counts.groupBy("near", "kind", "feature").agg(F.sum("c").alias("c")), "near")
    both = own.join(everywhere.select("near", F.col("repetition").alias("r"), F.col("presentation").alias("p")), "near")
    pulled = lambda x, towards: ((F.col("pages") * x + PULL * F.col(towards)) / (F.col("pages") + PULL)).cast("float")
    both = both.select("host", "style", pulled(F.greatest("repetition", "r"), "r").alias("repetition"), pulled(F.col("presentation"), "p").alias("presentation"), "side").filter("repetition > 0 or presentation > 0 or side < 0")
    lists = materialise(both.groupBy("host").agg(F.collect_list(F.struct("style", "repetition", "presentation")).alias("styles")), "styles")
    discard(counts)
    return lists


def page_text(page: str, styles: dict[int, tuple[float, float]]) -> str:
    """The main text of one page, by the (repetition, presentation) of its styles."""
    nodes, texts = blocks(page)
    for n in nodes:
        n.looks = styles.get(n.style, (0.0, 0.0))[1]
    for n, t in texts:
        n.weight += len(t)
        n.noise += len(t) * styles.get(n.style, (0.0, 0.0))[0]
    for n in reversed(nodes):  # parents come before their children
        up = n.parent
        if up is not None:
            up.weight += n.weight
            up.noise += n.noise
            up.looks = max(up.looks, n.looks)
    for n in nodes:
        if n.weight and n.style in styles:
            stated = n.side < 0 and n.parent.side >= 0  # what is below a branch that stays is judged like other elements
            bound = SLOPE * max(n.looks - HALF, 0.0) if stated else BASE + SLOPE * n.looks + INSIDE * max(n.side, 0)
            n.noisy = n.noise / n.weight >= bound
        n.gone = n.noisy or n.parent is not None and n.parent.gone
    left = [t for n, t in texts if not n.gone]
    if not left:
        unstated = [(n, t) for n, t in texts if n.side >= 0]
        most = max(((n.side, not n.noisy) for n, _ in unstated), default=None)
        left = [t for n, t in unstated if (n.side, not n.noisy) == most]
    return "\n\n".join(left)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: id, url, text and n_chars."""
    lists = importance(pages, url_col, html_col)

    def hosts(batches):
        for batch in batches:
            host = pa.array([_hash(host_of(u).encode()) for u in batch.column("url").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, host], names=[*batch.schema.names, "host"])

    def texts(batches):
        known: dict[int, dict[int, tuple[float, float]]] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                styles, out = part.column("styles"), []
                for i, (raw, host) in enumerate(zip(part.column("html").to_pylist(), part.column("host").to_pylist(), strict=True)):
                    if host not in known:
                        if len(known) > 64:
                            known.clear()
                        known[host] = {s["style"]: (s["repetition"], s["presentation"]) for s in styles[i].as_py() or ()}
                    out.append(page_text((raw or b"").decode("utf-8", "replace"), known[host]))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("url"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=["id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("binary").alias("html"))
    rows = map_arrow(rows, hosts, "id long, url string, html binary, host long")
    if (lists.agg(F.sum(F.size("styles"))).first()[0] or 0) <= SMALL:
        joined = rows.join(F.broadcast(lists), "host", "left")
    else:
        salted = lists.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn("salt", F.pmod(F.xxhash64("id", "url"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")
    out = map_arrow(joined.select("id", "url", "html", "host", "styles"), texts, "id long, url string, text string, n_chars long")
    return out.withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)
