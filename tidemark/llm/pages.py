"""Main text of web pages by site template removal: subtrees that recur across the pages of a host go."""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, rows_of, table, written

# Fixed values of the HTML standard and of common usage.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg select".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that are no text, and others that never hold main text unless they go around the whole page; a header does within an article,
#: where it holds the title.
NO_TEXT = frozenset("head button script style template noscript iframe svg select textarea title object canvas audio video annotation annotation-xml".split())
ASIDE = NO_TEXT | frozenset("nav footer aside form dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Whole names of a class or an id that are usual for what is not main text.
NAMES = frozenset(
    "ad ads ad-slot advert adverts advertisement advertising adsbygoogle banner breadcrumb breadcrumbs comment comments comment-list comment-section commentlist comments-area consent cookie cookies cookie-banner cookie-bar cookie-consent cookie-notice disqus disqus_thread footer header masthead menu modal nav navbar navigation newsletter newsletter-signup notice notices notification page-footer page-header pagination popup promo promoted related related-articles related-posts replies respond share share-buttons sharing sidebar signup site-footer site-header site-nav skip-link social social-share sponsor sponsored subscribe toolbar top-bar topbar widget".split()
)
#: Those of them that a title within an article may have too.
HEADS = frozenset("banner header masthead page-header".split())
#: An element with this share of the page's words outside of links is no furniture, whatever its tag or name; articles with less than
#: this share of the words that stay aren't the page's text.
MOST, TEASER = 0.75, 1 / 3
#: Elements that are never furniture themselves.
WHOLE = frozenset("# html body main".split())
#: An opened element of the key closes open ones of the value, up to the nearest of the stop.
CLOSES = {"li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",))}

#: A subtree is template when it stands on so many different pages of its host and on this share of them; within an article in
#: so many different articles of the host. A named element goes where others of its name stand on so many pages of the host.
PAGES, SHARE, ARTICLE_PAGES, ARTICLE_SHARE, NAMED_PAGES, NAMED_SHARE = 3, 0.1, 5, 0.5, 2, 0.01
#: Kinds of rows of templates(): anywhere, within articles too, a name, a host with too few pages to tell.
ANYWHERE, WITHIN, NAME, FEW = range(4)
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_QUOTE = re.compile(r"=\s*([\"'])")
_TELLING = re.compile(r"class|id|role|style", re.I)
#: One attribute after another, each with its quotes, so that what a value says is no attribute.
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_TOLD = frozenset("class id role hidden aria-hidden style".split())


class Node:
    __slots__ = ("tag", "parts", "attrs", "holds")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.parts, self.attrs, self.holds = tag, [], attrs, tag in ("article", "main")


def attributes(attrs: str) -> dict[str, str]:
    """The attributes that tell of an element's part in the page, in lower case; the first of a name counts."""
    out: dict[str, str] = {}
    if attrs and _TELLING.search(attrs):
        for name, a, b, c in _ATTR.findall(attrs):
            if (name := name.lower()) in _TOLD:
                out.setdefault(name, (a or b or c).lower())
    return out


def hidden(own: dict[str, str]) -> bool:
    """By what the page itself says of the element, for readers and for screen readers."""
    return "hidden" in own or own.get("aria-hidden") == "true" or "display:none" in own.get("style", "").replace(" ", "")


def named(own: dict[str, str]) -> set[str]:
    return {*own.get("class", "").split(), *own.get("id", "").split()} & NAMES if "class" in own or "id" in own else set()


def slot(tag: str, own: dict[str, str]) -> int | None:
    """64 bits of an element's tag, class and id, where one of these is a usual name of furniture."""
    if "class" not in own and "id" not in own:
        return None
    names = sorted({*own.get("class", "").split(), *own.get("id", "").split()})
    return None if NAMES.isdisjoint(names) else hashed("\1".join((tag, *names)))


def hashed(text: str) -> int:
    h = xxhash.xxh3_64_intdigest(text)
    return h - (1 << 64) if h >> 63 else h


class Stack:
    """Open elements, with the places of those of each tag, so that no step walks the stack."""

    def __init__(self, root: Node):
        self.nodes, self.at, self.blocks = [root], {}, []

    def push(self, node: Node) -> None:
        self.at.setdefault(node.tag, []).append(len(self.nodes))
        if node.tag in BLOCK:
            self.blocks.append(len(self.nodes))
        self.nodes.append(node)

    def nearest(self, tags: tuple[str, ...]) -> int:
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def cut(self, k: int) -> None:
        """Closes the elements from place k on."""
        for node in reversed(self.nodes[k:]):
            self.at[node.tag].pop()
            if node.tag in BLOCK:
                self.blocks.pop()
        del self.nodes[k:]


def parsed(html: str) -> Node:
    """The element tree; unclosed and stray tags are repaired, comments go, character references are decoded. One pass: whatever
    the page holds, no part of it is searched twice."""
    root = Node("#")
    stack, pos, size = Stack(root), 0, len(html)
    none_left: set[str] = set()  # characters that don't occur any more

    def find(what: str, at: int) -> int:
        if what in none_left:
            return -1
        k = html.find(what, at)
        if k < 0:
            none_left.add(what)
        return k

    def tag_end(at: int) -> int:
        """Place of the > of a tag whose name ends at `at`; one in a quoted value doesn't count."""
        end = find(">", at)
        while end >= 0 and (m := _QUOTE.search(html, at, end)):
            close = find(m[1], m.end())
            at = m.end() if close < 0 else close + 1
            if at > end:
                end = find(">", at)
        return end

    while pos < size:
        at = find("<", pos)
        if at < 0:
            stack.nodes[-1].parts.append(unescape(html[pos:]))
            break
        nxt = html[at + 1 : at + 2]
        closing = nxt == "/"
        m = _NAME.match(html, at + 1 + closing)
        if not m and not closing and nxt not in ("!", "?"):
            # A bare < is text.
            end = at + 1
            stack.nodes[-1].parts.append(unescape(html[pos:end]))
            pos = end
            continue
        if at > pos:
            stack.nodes[-1].parts.append(unescape(html[pos:at]))
        if not m:
            end = find("-->", at + 4) + 2 if html.startswith("<!--", at) else find(">", at)
            if end < 2:  # cut by the page's end
                break
            pos = end + 1
            continue
        name = m[0].lower()
        end = tag_end(m.end())
        if end < 0:
            break
        pos = end + 1
        if closing:
            k = stack.nearest((name,))
            # An inline end tag doesn't close blocks that were opened within.
            if k and (name in BLOCK or not stack.blocks or stack.blocks[-1] < k):
                stack.cut(k)
            continue
        if name in BLOCK and (k := stack.nearest(("p",))) and (not stack.blocks or stack.blocks[-1] <= k):
            stack.cut(k)
        if rule := CLOSES.get(name):
            k = stack.nearest(rule[0])
            if k > stack.nearest(rule[1]):
                stack.cut(k)
        attrs = html[m.end() : end]
        node = Node(name, attrs)
        stack.nodes[-1].parts.append(node)
        if name in VOID or attrs.endswith("/") and name in ("svg", "path"):
            continue
        if name in RAW:
            close = f"</{name}"
            found = None if close in none_left else re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(html, pos)
            if not found:
                none_left.add(close)
            stop = found.start() if found else size
            if name in ("textarea", "title"):
                node.parts.append(unescape(html[pos:stop]))
            pos = stop
            if found:
                pos = (find(">", stop) + 1) or size
            continue
        stack.push(node)
    return root


class Page:
    """A page's elements in page order, each with its parent's place."""

    def __init__(self, html: str):
        self.nodes, self.parent = [parsed(html)], [-1]
        stack = [(0, iter(self.nodes[0].parts))]
        while stack:
            at, parts = stack[-1]
            for p in parts:
                if isinstance(p, Node):
                    self.nodes.append(p)
                    self.parent.append(at)
                    stack.append((len(self.nodes) - 1, iter(p.parts)))
                    break
            else:
                stack.pop()
        self.place = {id(n): k for k, n in enumerate(self.nodes)}
        self.html, self.hash = html, []
        for k in range(len(self.nodes) - 1, 0, -1):
            if self.nodes[k].holds:
                self.nodes[self.parent[k]].holds = True
        #: Words in each element outside of links. Place of the outermost article or main around each element, itself included; 0 for
        #: none. And what lies in elements that go by their tag.
        self.words, self.top, self.dead = [0] * len(self.nodes), [0] * len(self.nodes), [False] * len(self.nodes)
        for k in range(len(self.nodes) - 1, -1, -1):
            node = self.nodes[k]
            if node.tag == "a" or node.tag in NO_TEXT:
                self.words[k] = 0
                continue
            for p in node.parts:
                if isinstance(p, str):
                    self.words[k] += len(p.split())
            if k:
                self.words[self.parent[k]] += self.words[k]
        for k in range(1, len(self.nodes)):
            self.top[k] = self.top[self.parent[k]] or (k if self.nodes[k].tag in ("article", "main") else 0)
            self.dead[k] = self.dead[self.parent[k]] or self.nodes[k].tag in NO_TEXT or self.nodes[k].tag in ASIDE and not self.around(k)

    def around(self, k: int) -> bool:
        """Whether the element goes around the page: it holds most of the words, and its articles if it has any."""
        return self.words[k] >= MOST * self.words[0] > 0 and self.nodes[k].holds == self.nodes[0].holds

    def hashed(self) -> None:
        """Hashes of each element's tag and content; what goes by its tag counts as empty. The page's own is of its html."""
        self.hash = [0] * len(self.nodes)
        for k in range(len(self.nodes) - 1, 0, -1):
            if not self.dead[k]:
                node = self.nodes[k]
                self.hash[k] = hashed("\0".join((node.tag, *(f"#{self.hash[self.place[id(p)]]}" if isinstance(p, Node) else " ".join(p.split()) for p in node.parts))))
        self.hash[0] = hashed(self.html)

    def aside(self, k: int, names: set[int], few: bool) -> bool:
        """Whether the element can't be main text: by its tag, by what the page says of it, or by a name that other pages of
        the host have too (or that no other pages tell of)."""
        node = self.nodes[k]
        if node.tag in WHOLE:
            return False
        if node.tag in NO_TEXT:
            return True
        if node.tag in ASIDE or node.tag == "header" and not self.top[k]:
            return not self.around(k)
        if not node.attrs:
            return False
        own = attributes(node.attrs)
        if hidden(own):
            return True
        if own.get("role") in ROLES:
            return not self.around(k)
        told = named(own)
        if not told or self.top[k] and told <= HEADS or not (few or slot(node.tag, own) in names):
            return False
        return not self.around(k)

    def counted(self) -> list[tuple[int, int, int]]:
        """(kind, hash, where it stands) of each element with text: in which page, or for WITHIN in which article, and of each
        name of furniture."""
        self.hashed()
        out, within = set(), {}
        for k in range(1, len(self.nodes)):
            node, top = self.nodes[k], self.top[k]
            if self.dead[k]:
                continue
            if node.parts and not top == k:
                h = self.hash[k]
                within[h] = within.get(h, True) and top > 0
                out.add((WITHIN if top else ANYWHERE, h, self.hash[top]))
            if top == k:
                out.add((WITHIN, 0, self.hash[k]))
            if node.attrs and node.tag not in WHOLE and (s := slot(node.tag, attributes(node.attrs))) is not None:
                out.add((NAME, s, self.hash[0]))
        # What stands outside of articles too counts as such, once for the page.
        out = {(ANYWHERE, h, self.hash[0]) if kind == WITHIN and h and not within[h] else (kind, h, w) for kind, h, w in out}
        return [(ANYWHERE, 0, self.hash[0]), *out]

    def text(self, anywhere: set[int], within: set[int], names: set[int], few: bool) -> str:
        if anywhere or within:
            self.hashed()
        own = [k > 0 and self.aside(k, names, few) for k in range(len(self.nodes))]
        gone = self.inherited(own)
        # Articles in page order, outside of what is aside. Where all of them are aside, what holds one isn't.
        tops = [k for k in range(1, len(self.nodes)) if self.top[k] == k]
        if tops and all(gone[k] for k in tops):
            gone = self.inherited([a and not n.holds for a, n in zip(own, self.nodes, strict=True)])
        tops = [k for k in tops if not gone[k]]
        if tops and self.kept_words(tops, gone) < TEASER * self.kept_words([0], gone):
            tops = []
        out = []
        for top in tops or [0]:
            template = within if top else anywhere
            blocks, left_out = self.blocks(top, gone, template)
            # More than half of an article that recurs is a copied article, not a template.
            if top and left_out * 2 > sum(map(len, blocks)) + left_out:
                blocks, _ = self.blocks(top, gone, set())
            out += blocks
        return "\n".join(out)

    def kept_words(self, tops: list[int], gone: list[bool]) -> int:
        """Words outside of links in what stays of these elements."""
        n, walk = 0, [self.nodes[k] for k in tops]
        while walk:
            for p in walk.pop().parts:
                if isinstance(p, str):
                    n += len(p.split())
                elif p.tag != "a" and not gone[self.place[id(p)]]:
                    walk.append(p)
        return n

    def inherited(self, own: list[bool]) -> list[bool]:
        out = list(own)
        for k in range(1, len(out)):
            out[k] = out[k] or out[self.parent[k]]
        return out

    def blocks(self, top: int, gone: list[bool], template: set[int]) -> tuple[list[str], int]:
        """The blocks under an element, and the characters in template subtrees that were left out."""
        out: list[str] = []
        words: list[str] = []
        left_out = 0

        def close():
            if line := " ".join("".join(words).split()):
                out.append(line)
            words.clear()

        walk: list = [self.nodes[top]]
        while walk:
            x = walk.pop()
            if x is None:
                close()
            elif isinstance(x, str):
                words.append(x)
            else:
                k = self.place[id(x)]
                template_here = bool(template) and k != top and self.hash[k] in template and not x.holds
                if template_here or gone[k]:
                    if x.tag in BLOCK:
                        close()
                    if template_here and not gone[k]:
                        left_out += self.size(k)
                    continue
                if x.tag == "br":
                    words.append(" ")
                if x.tag in BLOCK:
                    close()
                    walk.append(None)
                walk += reversed(x.parts)
        close()
        return out, left_out

    def size(self, k: int) -> int:
        n, walk = 0, [self.nodes[k]]
        while walk:
            for p in walk.pop().parts:
                if isinstance(p, Node):
                    walk.append(p)
                else:
                    n += len(" ".join(p.split()))
        return n


def main_text(html: str | None, anywhere: set[int] = frozenset(), within: set[int] = frozenset(), names: set[int] = frozenset(), few: bool = True) -> str:
    """The main text of one page, given its host's templates and names."""
    return Page(html).text(anywhere, within, names, few) if html else ""


def host_of(url):
    """The url's host in lower case, '' where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def templates(pages: DataFrame, least: int = PAGES, share: float = SHARE, article_least: int = ARTICLE_PAGES, article_share: float = ARTICLE_SHARE) -> DataFrame:
    """host, kind, hash: subtrees of pages (host, a hash of its name, and html) that recur on many pages of their host, or in many of its articles.

    Pages of equal content are one, and so are equal articles: a text that was copied is no template. Counts are of distinct
    places, in two steps, so that a host with a third of all pages is spread over tasks by hash and place."""
    kinds = {"host": pa.int64(), "kind": pa.int32(), "hash": pa.int64(), "place": pa.int64()}

    def count(batches):
        held: set = set()

        def out():
            return pa.RecordBatch.from_pydict({n: pa.array([r[i] for r in held], t) for i, (n, t) in enumerate(kinds.items())})

        for batch in batches:
            for part in rows_of(batch):
                for host, html in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
                    if html:
                        held.update((host, *x) for x in Page(html).counted())
                if len(held) > 200_000:
                    yield out()
                    held.clear()
        yield out()

    seen = pages.select("host", "html").mapInArrow(count, "host long, kind int, hash long, place long")
    n = written(seen.groupBy("host", "kind", "hash").agg(F.countDistinct("place").alias("n")).where(f"n >= {min(least, article_least, NAMED_PAGES)} or hash = 0"), "subtrees")
    size = n.where("hash = 0").groupBy("host").agg(F.max(F.when(F.col("kind") == ANYWHERE, F.col("n"))).alias("pages"), F.max(F.when(F.col("kind") == WITHIN, F.col("n"))).alias("articles"))
    enough = (
        F.when(F.col("kind") == ANYWHERE, (F.col("n") >= least) & (F.col("n") >= share * F.col("pages")))
        .when(F.col("kind") == WITHIN, (F.col("n") >= article_least) & (F.col("n") >= article_share * F.col("articles")))
        .otherwise((F.col("n") >= NAMED_PAGES) & (F.col("n") >= NAMED_SHARE * F.col("pages")))
    )
    few = size.where(f"pages < {least}").select("host", F.lit(FEW).alias("kind"), F.lit(0).cast("long").alias("hash"))
    return n.where("hash <> 0").join(size, "host").where(enough).select("host", "kind", "hash").union(few)


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row for each row of pages: page_id, url, text, n_chars.

    A page's article or main elements, else its whole body, without template subtrees of its host, without elements that never
    hold main text, and without those whose class or id is a usual name of furniture, if other pages of the host have the same
    (a host of fewer than PAGES different pages tells nothing, and the name decides). Html, body and main never go, and neither
    do all articles of a page: where that came out, what holds one stays. Within an article a subtree must recur in half of the host's different articles, and in five, to go, and
    none goes where they make up more than half of the article. Null and empty html give an empty text; a null url is a host of
    its own name ''. Repeated rows give repeated results and count once. Other columns are ignored.
    """
    own = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"), pages[html_col].cast("string").alias("html")).withColumn("host", F.xxhash64(host_of(F.col("url"))))
    found = written(templates(own), "templates")
    # A host's templates are few, each stands on a share of its pages; hosts are many. Spark sends the lists to all tasks where
    # their size allows it, else pages and lists meet by host and hot hosts are split.
    lists = found.groupBy("host").agg(F.collect_list(F.struct("kind", "hash")).alias("found"))

    def make():
        held: dict = {}

        def sets(host, rows):
            if host not in held:
                if len(held) > 10_000:
                    held.clear()
                held[host] = tuple({r["hash"] for r in rows or () if r["kind"] == kind} for kind in (ANYWHERE, WITHIN, NAME)) + (any(r["kind"] == FEW for r in rows or ()),)
            return held[host]

        def step(cols):
            text = [main_text(html, *sets(host, rows)) for html, host, rows in zip(cols["html"], cols["host"], cols["found"], strict=True)]
            yield {"page_id": cols["page_id"], "url": cols["url"], "text": text, "n_chars": list(map(len, text))}

        return step

    return map_batches(own.join(lists, "host", "left"), make, "page_id long, url string, text string, n_chars long")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page of `pages`."""
    return main_texts(table(spark, sf_dir, "pages"))
