"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: A tag from its ``<`` on. Quotes count after an equals sign only, as in the HTML standard; every part is possessive and the
#: whole matches wherever a letter follows, so no byte is read twice. It ends at ``>`` or with the page.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/><]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|))*+)(>?)")
# Element names of the HTML standard by role.
RAW = frozenset("script style noscript template textarea title iframe object svg math canvas".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
BOILER = frozenset("head nav header footer aside form button select dialog menu fieldset".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
CLOSED_BY_BLOCK = frozenset(["p"])
SAME_CLOSES = frozenset("li dt dd tr td th option thead tbody".split())
# Words of class and id names that mark what is not the article.
_BOILER_NAME = re.compile(
    r"(?:^|[_-])(?:ads?|ads?(?:box|block|slot|unit|sense|container|wrapper)|advert\w*|adv|sponsor\w*|promo\w*|banners?|cookies?\w*|consent|gdpr|notices?|newsletter\w*|subscri\w*|popup|modal|overlay|sidebars?|side|aside|widgets?"
    r"|comments?|comments?(?:list|area|form|section|thread)|disqus|repl(?:y|ies)|respond|(?:top|left|right|site|page|sub|global)?(?:menu|nav|navbar|footer|header)|navigation|breadcrumbs?|share|sharing|social|related|recommend\w*"
    r"|masthead|topbar|toolbar|login|signup|search|pagination|pager|skip|copyright|legal|disclaimer|tags)\d*(?=$|[_-])",
    re.I,
)
_COMMENT = re.compile(r"(?:.*[_-])?(?:comment|reply)(?:[_-].*)?", re.I)
# Names of content elements; an element with one is not boilerplate, whatever its other names ("content with-sidebar").
CONTENT_NAMES = frozenset("content article post main entry story main-content article-body article-content post-body post-content entry-content story-body".split())
#: Names that only say what the page has elsewhere.
_ABOUT = ("has-", "with-", "no-", "without-")
UNNAMED = frozenset("html body main h1 h2 h3 h4 h5 h6 th tr thead".split())
_ATTR = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=\s|/|$)""", re.I)
#: A class or id of more characters is no word of the lists.
LONGEST_NAME = 256
NO_TEXT, SPACE, EMPTY, IN_LINE, BLOCK = range(5)
#: What the reader does with a tag; void elements are inline ones too.
_KIND = dict.fromkeys(INLINE, IN_LINE) | dict.fromkeys(VOID, EMPTY) | dict.fromkeys(("br", "hr"), SPACE) | dict.fromkeys(RAW, NO_TEXT)
_PUNCT = re.compile(r"[.,;:!?…。、，！？；：]")
#: A path is content when its fused score reaches this share of the best path's.
THRESHOLD = 0.1
#: Weight of the parent path's mean in a path's own (as so many blocks), and share of the content text that the content element holds.
SMOOTH, HOLDS = 1.0, 0.7
#: How far the names of the markup help a path's score: article and main elements, and boilerplate words of class and id.
HELP, HINDER = 4.0, 1e-6
#: What of its score a path keeps whose whole text is linked.
LINKED = 0.02
#: What reads as prose or headings stands with the content around it; other elements must earn it by their own path.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption dl dt dd ul ol li table caption thead tbody tr td th".split())


def _boiler_name(tag: str, value: str) -> bool:
    names = [re.sub(r"(?<=[a-z])(?=[A-Z])", "-", n) for n in value.split() if len(n) <= LONGEST_NAME and not n.lower().startswith(_ABOUT)]
    if tag == "article":
        return any(map(_COMMENT.fullmatch, names))
    return tag not in UNNAMED and not CONTENT_NAMES.intersection(n.lower() for n in names) and any(map(_BOILER_NAME.search, names))


def _marks(tag: str, attrs: str) -> tuple[bool, bool]:
    """Whether the markup itself says that an element is no content (role, hidden), and whether its class or id is a boilerplate word."""
    out = named = False
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id"):
            named = named or _boiler_name(tag, value)
        elif name == "role" and value.lower() in BOILER_ROLES or name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            out = True
    return out, named


class Page:
    """Block elements of a page and the text blocks in them.

    Elements are numbered in page order from 1 (0 is the page): ``parent`` and ``path`` (number of the tag path) of each.
    Paths are numbered alike: ``up`` is the path one tag shorter, ``tag`` the last tag. ``blocks`` has (element, text, characters
    of it inside links), texts with single spaces. A path tells elements with boilerplate words for class or id from others.
    """

    def __init__(self, page: str, names: bool = True, rename: frozenset[str] = frozenset()):
        self.parent, self.path, self.blocks = [0], [0], []
        self.up, self.tag, self.named, self.help = [0], [""], [False], [1.0]
        self._paths: dict[tuple[int, str, bool], int] = {}
        self._read(page, names, rename)

    def _number(self, up: int, tag: str, named: bool) -> int:
        at = self._paths.setdefault((up, tag, named), len(self.up))
        if at == len(self.up):
            self.up.append(up)
            self.tag.append(tag)
            self.named.append(named or self.named[up])
            self.help.append(HELP if tag in ("article", "main") else self.help[up])
        return at

    def _read(self, page: str, names: bool, rename: frozenset[str]) -> None:
        # The stack of open elements: tag, number, whether it is outside the content, and place of the nearest one that is not inline.
        tags, numbers, off, base = [], [], [], []
        is_open: dict[str, int] = {}
        piece: list[str] = []
        at, size, links, linked = 0, len(page), 0, 0

        def text(s: str) -> None:
            nonlocal linked
            if s and not (off and off[-1]):
                piece.append(s)
                linked += len(s) if links else 0

        def end_block() -> None:
            nonlocal linked
            if piece:
                joined = piece[0] if len(piece) == 1 else "".join(piece)
                joined = " ".join((html.unescape(joined) if "&" in joined else joined).split())
                if joined:
                    self.blocks.append((numbers[-1] if numbers else 0, joined, min(linked, len(joined))))
                piece.clear()
            linked = 0

        def close(to: int) -> None:
            end_block()
            while len(tags) > to:
                is_open[tags.pop()] -= 1
                del numbers[-1], off[-1], base[-1]

        find, match = page.find, _TAG.match
        while at < size:
            lt = find("<", at)
            if lt < 0:
                break
            m = match(page, lt)
            if not m and page.startswith(("!", "?", "/"), lt + 1):
                text(page[at:lt])
                if page.startswith("<!--", lt):
                    end = page.find("-->", lt + 2)
                    at = size if end < 0 else end + 3
                elif page.startswith("<![CDATA[", lt):
                    end = page.find("]]>", lt)
                    at = size if end < 0 else end + 3
                    text(html.escape(page[lt + 9 : size if end < 0 else end]))
                else:
                    end = page.find(">", lt)
                    at = size if end < 0 else end + 1
                continue
            if not m:
                text(page[at : lt + 1])
                at = lt + 1
                continue
            if lt > at:
                text(page[at:lt])
            at = m.end()
            shut, tag, attrs, ended = m.groups()
            if not ended:
                break
            tag = tag.lower()
            if tag in rename:
                tag = "div"
            kind = _KIND.get(tag, BLOCK)
            if kind == NO_TEXT:
                if not shut and not attrs.rstrip().endswith("/"):
                    over = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
                    end = page.find(">", over.end()) if over else -1
                    at = size if end < 0 else end + 1
                continue
            if kind == SPACE:
                text(" ")
                continue
            if tag == "a":
                links = max(0, links - 1) if shut else 1
            if kind == EMPTY:
                continue
            out, named = _marks(tag, attrs) if attrs and names and not shut else (False, False)
            if kind == IN_LINE and not (is_open.get(tag) if shut else out or named):
                continue
            if shut:
                if is_open.get(tag):
                    to = len(tags) - 1
                    while tags[to] != tag:
                        to -= 1
                    close(to)
                else:
                    end_block()
                continue
            end_block()
            if kind == BLOCK:
                if base and base[-1] >= 0:
                    last = tags[base[-1]]
                    if last in CLOSED_BY_BLOCK or last == tag and tag in SAME_CLOSES:
                        close(base[-1])
                base.append(len(tags))
                links = 0
            else:
                base.append(base[-1] if base else -1)
            up = numbers[-1] if numbers else 0
            numbers.append(len(self.parent))
            self.parent.append(up)
            self.path.append(self._number(self.path[up], tag, named))
            # A header or footer of the article itself is still a header or footer.
            off.append(out or bool(off and off[-1]) or names and tag in BOILER)
            tags.append(tag)
            is_open[tag] = is_open.get(tag, 0) + 1
        else:
            end_block()
            return
        text(page[at:] if lt < 0 else "")
        end_block()


def path_scores(page: Page) -> list[float]:
    """The fused score of each tag path.

    Ratios of a path: characters, punctuation and linked characters a block. The first two are smoothed with the mean of
    all blocks one tag up (blocks of the parent path and of its other children), as SMOOTH blocks, then fused with the path's
    share of unlinked text and the root of its length by their product; article and main help, boilerplate words hinder.
    """
    n, length, punct, linked = ([0] * len(page.up) for _ in range(4))
    for element, text, inside in page.blocks:
        p = page.path[element]
        n[p] += 1
        length[p] += len(text)
        punct[p] += len(_PUNCT.findall(text))
        linked[p] += inside
    near, near_length, near_punct = ([0] * len(page.up) for _ in range(3))
    filled = [p for p, k in enumerate(n) if k]
    for p in filled:
        u = page.up[p]
        near[u] += n[p]
        near_length[u] += length[p]
        near_punct[u] += punct[p]
    out = [0.0] * len(page.up)
    for p in filled:
        u = page.up[p]
        k = n[p] + SMOOTH
        chars = (length[p] + SMOOTH * near_length[u] / near[u]) / k
        marks = (punct[p] + SMOOTH * near_punct[u] / near[u]) / k
        out[p] = chars * (1 + marks) * max(LINKED, 1 - linked[p] / length[p]) * (1 + length[p]) ** 0.5 * page.help[p] * (HINDER if page.named[p] else 1.0)
    return out


def select(page: Page) -> list[str]:
    """Content blocks in page order.

    Paths at or over THRESHOLD of the best score are content. The content element is the innermost one that holds HOLDS of
    the text on content paths. Of the blocks in it, those stay whose path is content, those of prose elements, and those in a
    branch (child of the content element) that has content, but on paths named boilerplate only those whose path is content;
    what lies outside goes. A page with no text but on such paths has no content.
    """
    if not page.blocks:
        return []
    scores = path_scores(page)
    best = max((s for s, named in zip(scores, page.named) if not named), default=0.0)
    if best <= 0:
        return []
    good = [s >= THRESHOLD * best for s in scores]
    mass = [0] * len(page.parent)
    for element, text, _ in page.blocks:
        if good[page.path[element]]:
            mass[element] += len(text)
    for e in range(len(mass) - 1, 0, -1):
        mass[page.parent[e]] += mass[e]
    # The innermost: no child holds as much. Several blocks in one paragraph are not an element of their own.
    holder = max((e for e in range(len(mass)) if mass[e] >= HOLDS * mass[0] and page.tag[page.path[e]] not in PROSE), default=0)
    branch = [-1] * len(mass)
    for e in range(holder, len(mass)):
        up = page.parent[e]
        branch[e] = e if e == holder or up == holder and e else branch[up] if up >= holder else -1
    kept = []
    for element, text, _ in page.blocks:
        b, p = branch[element], page.path[element]
        if b >= 0 and (good[p] or not page.named[p] and (b == holder or page.tag[page.path[b]] in PROSE or mass[b])):
            kept.append(text)
    return kept


def main_text(page: str | None) -> str:
    return " ".join(select(Page(page or "")))


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for lo in range(0, whole.num_rows, 500):
            batch = whole.slice(lo, 500)
            text = [main_text(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars (code points).

    The content is chosen by tag-path ratios (``path_scores``, ``select``) among what the markup does not itself declare to be
    something else (scripts, nav, header, footer, aside, forms, roles, hidden elements). Null or empty html, and pages
    without text outside boilerplate, give an empty text. Ids and urls pass through, null or repeated. Broken markup is
    read as the HTML standard reads it, in time linear in the page: a tag or comment that never ends takes the rest of
    the page with it. An empty table gives no rows; other columns are ignored. Every page is a row of its own: nothing is
    shuffled.
    """
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"), pages[html_col].cast("string").alias("html"))
    return rows.mapInArrow(_run, "page_id long, url string, text string, n_chars long")
