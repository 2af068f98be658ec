"""Main text of web pages by the distribution of text over lines.

Markup is stripped to lines, one per block of the page, each with the length of its text outside
links. Blocks in elements that are menus, headers, footers, asides or forms by their kind weigh nothing;
blocks of a marked article weigh more. A part whose class or id is plainly that of comments, an advert or a
notice weighs nothing, however long it is, unless there is hardly any other text. Other names (a sidebar, a
share bar) only lower a part's weight, to nothing where its lines are short or links too; one that holds most
of the text is taken like any other. Weights are summed over a sliding
window of lines, which does not reach over an article's border. Where a window's sum surges over a
threshold, text begins; where the lines fall to nothing for as long as a window, it ends; what lies
between is kept.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import modest_batches


@dataclass(frozen=True)
class PageConfig:
    """``window`` lines are summed. A stretch must reach ``surge`` characters in some window, or ``share`` of
    the page's largest window where that is less. A block in a marked article weighs ``raised`` more, one in
    a part named as something else ``doubt`` times less."""

    window: int = 3
    surge: int = 80
    share: float = 0.5
    raised: int = 160
    doubt: int = 4


# Element kinds of the markup language.
RAW = "script style noscript template textarea title svg math iframe object select button canvas audio video head".split()
BLOCK = ("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
         "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
         "thead tr ul").split()
NEST = ("article aside blockquote body details dialog div dl fieldset figure footer form header main menu nav ol section "
        "table ul").split()
VOID = "area base br col embed hr img input link meta source track wbr".split()
APART = "nav aside footer form menu dialog fieldset".split()
ARTICLE = "article main".split()
# Parts in which an article is not the page's own, by element kind or by a word in class, id or role.
KEEPING = "nav aside footer".split()
REMARKS = "comment comments commentlist disqus replies respond".split()
# Words in a class, id or role that name something other than the text.
NAMED = ("ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored promo promotion banner "
         "nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar aside widget related recommended "
         "footer masthead topbar toolbar cookie cookies consent gdpr notice popup modal overlay newsletter subscribe "
         "subscription signup login share sharing social comment comments commentlist disqus replies respond "
         "complementary contentinfo search alert disclaimer").split()
# Those of them that are never text when a class or id consists of nothing else, and words that may stand beside them.
PLAINLY = ("ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored promo promotion cookie cookies "
           "consent gdpr notice popup newsletter subscribe subscription signup login comment comments commentlist disqus replies "
           "respond").split()
BESIDE = "area box block list section thread wrapper container bar banner form item items content body slot unit top bottom the".split()
NAMED_PARTS = re.compile(r"[^a-zA-Z0-9]+|(?<=[a-z])(?=[A-Z])")

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)


def _apart(name: str, attributes: str, in_article: bool) -> bool:
    """Whether an element is not text: by its kind, or as it is hidden."""
    if name in APART or name == "header" and not in_article:
        return True
    for attribute, value in ATTRIBUTE.findall(attributes):
        attribute, value = attribute.lower(), value.strip("\"'")
        if attribute == "hidden" or attribute == "aria-hidden" and value == "true":
            return True
        if attribute == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


def _words(name: str, attributes: str) -> set[str]:
    """Words in an element's class, id and role that name something other than the text."""
    if name in ("html", "body", *ARTICLE):
        return set()
    return {w.lower() for a, v in ATTRIBUTE.findall(attributes) if a.lower() in ("class", "id", "role") for w in NAMED_PARTS.split(v)} & _NAMED


def _plainly(attributes: str) -> bool:
    """Whether a class or id names comments, an advert or a notice and nothing else."""
    for attribute, value in ATTRIBUTE.findall(attributes):
        for token in value.strip("\"'").split() if attribute.lower() in ("class", "id") else ():
            words = [w.lower() for w in NAMED_PARTS.split(token) if w]
            if not _PLAINLY.isdisjoint(words) and all(w in _PLAINLY or w in _BESIDE for w in words):
                return True
    return False


def _closed(page: str) -> set[int]:
    """Where the content begins of each element that has its own end tag."""
    found: set[int] = set()
    begun: dict[str, list[int]] = {}
    for m in TAG.finditer(page):
        name = (m[2] or m[5] or "").lower()
        if name in _NEST:
            if not (m[1] or m[4]):
                begun.setdefault(name, []).append(m.end())
            elif begun.get(name):
                found.add(begun[name].pop())
    return found


_NAMED, _RAW, _BLOCK, _NEST = frozenset(NAMED), frozenset(RAW), frozenset(BLOCK), frozenset(NEST)
_PLAINLY, _BESIDE = frozenset(PLAINLY), frozenset(BESIDE)


@dataclass
class Part:
    """Blocks from ``start`` to ``end``: an article, or an element named as something else. The latter knows the
    named part and the article around it, and whether it is one of comments that holds articles."""

    start: int
    around: int = -1
    article: int = -1
    comments: bool = False
    plainly: bool = False
    end: int = -1


@dataclass
class Open:
    """An open container: itself set apart, its words, the numbers of its named part and of the innermost article."""

    name: str
    apart: bool
    words: set[str]
    at: int
    named: int
    article: int


def lines(page: str) -> tuple[list[tuple[str, int, bool, int, int]], list[Part], list[Part]]:
    """Blocks in page order: (text, characters outside links, set apart, article, named part); with the
    articles and the named parts in order of their start, to which these numbers point, -1 for none.

    A tag that the page's end cuts off is dropped, and so is all of an element whose content is no text.
    Containers close at their own end tag or that of one around them. An article ends whatever part set
    apart is left open, and those that may hold the page's own article, as a form does.
    """
    out: list[tuple[str, int, bool, int, int]] = []
    articles: list[Part] = []
    named: list[Part] = []
    text: list[str] = []
    linked: list[str] = []
    stack: list[Open] = []
    open_names: Counter = Counter()
    closed: set[int] | None = None
    entered = held = 0  # containers that an article went through already, and those set apart
    apart = False
    article = part = single = -1
    links = 0
    at = 0

    def put(piece: str) -> None:
        if piece:
            text.append(piece)
            if links:
                linked.append(piece)

    def end_block() -> None:
        whole = " ".join(entities.unescape("".join(text)).split())
        if whole:
            anchors = " ".join(entities.unescape("".join(linked)).split())
            out.append((whole, max(0, len(whole) - len(anchors)), apart, article, part))
        text.clear()
        linked.clear()

    def close(s: Open) -> None:
        if s.words and named[s.named].end < 0:
            named[s.named].end = len(out)
        if s.name in ARTICLE:
            articles[s.article].end = len(out)

    def around() -> tuple[int, int]:
        return (stack[-1].named, stack[-1].article) if stack else (-1, -1)

    def enter_article() -> None:
        nonlocal closed, entered, held
        if closed is None:
            closed = _closed(page)
        now = stack[entered - 1].named if entered else -1
        for s in stack[entered:]:
            whole = s.at in closed
            if s.apart and not (s.name in KEEPING and whole):
                s.apart, held = False, held - 1
            if s.words and whole:
                named[s.named].comments |= not s.words.isdisjoint(REMARKS)
            elif s.words:
                close(s)
                s.words = set()
            now = s.named = s.named if s.words else now
        entered = len(stack)

    while True:
        m = TAG.search(page, at)
        if m is None:
            break
        put(page[at:m.start()])
        at = m.end()
        closing, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if name is None:
            continue
        if not m[0].endswith(">"):
            break
        name = name.lower()
        if name in _RAW and not closing:
            if attributes.rstrip().endswith("/"):
                continue
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>|<(?=body[\s>])" if name == "head" else rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = len(page) if end is None else end.start() if name == "head" and end[0] == "<" else end.end()
            text.append(" ")
            continue
        if name == "a":
            links = max(0, links + (-1 if closing else 1))
        if name == "br":
            put(" ")
        if name not in _BLOCK:
            continue
        end_block()
        links = 0
        if single >= 0:
            named[single].end, single = len(out), -1
        if name in _NEST:
            if closing:
                while open_names[name]:
                    s = stack.pop()
                    close(s)
                    open_names[s.name] -= 1
                    held -= s.apart
                    if s.name == name:
                        break
                entered = min(entered, len(stack))
            else:
                if name in ARTICLE and around()[1] < 0:
                    enter_article()
                part, article = around()
                new = Open(name, _apart(name, attributes, article >= 0), _words(name, attributes), at, part, article)
                if new.words:
                    new.named = len(named)
                    named.append(Part(len(out), part, article, plainly=_plainly(attributes)))
                if name in ARTICLE:
                    new.article = len(articles)
                    articles.append(Part(len(out)))
                stack.append(new)
                open_names[name] += 1
                held += new.apart
        apart = held > 0
        part, article = around()
        if name not in _NEST and not closing:
            # A single block: set apart or named until the next block begins.
            apart = apart or _apart(name, attributes, article >= 0)
            if _words(name, attributes):
                single = len(named)
                named.append(Part(len(out), part, article, plainly=_plainly(attributes)))
                part = single
    if at < len(page) and m is None:
        put(page[at:])
    end_block()
    for p in (*articles, *named):
        p.end = len(out) if p.end < 0 else p.end
    return out, articles, named


def _weights(page: str, config: PageConfig) -> tuple[list[str], list[int], list[bool]]:
    """Every block's text, weight, and whether the mark of an article raises it."""
    blocks, articles, named = lines(page)
    n, k, least = len(blocks), config.window, config.surge * config.doubt
    sizes = [0 if b[2] else b[1] for b in blocks]
    begin = [0, *accumulate(sizes)]
    times: list[int] = []  # what the weight of each named part's blocks is divided by; 0 sets apart
    if named:
        surge_at = [n] * (n + 1)  # the next window that surges even so
        for i in range(n - 1, -1, -1):
            surge_at[i] = i if begin[min(i + k, n)] - begin[i] >= least else surge_at[i + 1]
        marks = Counter(b[4] for b in blocks if b[3] >= 0 and not b[2])
        total = begin[n] + config.raised * marks[-1]
        starts = sorted(a.start for a in articles)
    for p in named:
        before = times[p.around] if p.around >= 0 else 1
        own = begin[p.end] - begin[p.start]
        scope = articles[p.article] if p.article >= 0 else None
        all_text = begin[scope.end] - begin[scope.start] if scope else total
        long = surge_at[p.start] <= p.end - k if p.end - p.start >= k else own >= least
        other = begin[scope.end] - begin[scope.start] - own if scope else begin[n] - own
        holds = scope is None and not p.comments and bisect_left(starts, p.end) > bisect_left(starts, p.start)  # the page's own article
        if before == 0 or p.plainly and not holds and other >= config.surge:
            times.append(0)
        elif 2 * own > all_text:
            times.append(before)
        elif long and not p.comments:
            times.append(before if scope else config.doubt)
        else:
            times.append(0)
        if times[-1] == 1 and not scope:  # articles in it count as the page's own from here on
            total += config.raised * marks[len(times) - 1]
    weights, marked = [], []
    for size, (_, _, apart, article, part) in zip(sizes, blocks):
        by = times[part] if part >= 0 else 1
        marked.append(article >= 0 and not apart and by == 1)
        # A block of links alone still belongs to the article.
        weights.append(0 if apart or not by else -(-size // by) + config.raised * marked[-1])
    return [b[0] for b in blocks], weights, marked


def main_text(page: str, config: PageConfig = PageConfig()) -> str:
    """The blocks between surges and dives, joined by a space."""
    blocks, weights, marked = _weights(page, config)
    sums, ends, end = [0] * len(blocks), [0] * len(blocks), len(blocks)
    for i in range(len(blocks) - 1, -1, -1):
        if i + 1 < len(blocks) and marked[i] != marked[i + 1]:
            end = i + 1
        ends[i], sums[i] = end, sum(weights[i:min(i + config.window, end)])
    least = min(config.surge, config.share * max(sums, default=0)) or 1
    kept: list[str] = []
    i = 0
    while i < len(blocks):
        if sums[i] < least or weights[i] == 0:
            i += 1
            continue
        # Surge: go on until a whole window is empty, or is thin from a weightless line on, or a border comes.
        end = ends[i]
        while i < end and sums[i] > 0 and (sums[i] >= least or weights[i] > 0):
            if weights[i]:
                kept.append(blocks[i])
            i += 1
    return " ".join(kept)


def extract(pages: DataFrame, html: str = "html", out: str = "text", config: PageConfig = PageConfig()) -> DataFrame:
    """Add ``out``: the main text of the whole page; null and empty pages give an empty text. Rows and
    other columns stay as they are."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.fillna("").map(lambda p: main_text(p, config)).astype(object)

    modest_batches(pages.sparkSession)
    return pages.withColumn(out, run(F.col(html)))


def op7_pages(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points)."""
    found = extract(pages.select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
