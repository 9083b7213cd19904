"""Main text of web pages by line-block distribution.

Markup is stripped to lines: a block-level tag ends a line, inline tags and
line breaks do not.  Scripts, styles, comments, menus, headers, footers,
sidebars, notices, adverts, forms and reader comments (told by their element
or by a whole name in their class, id or role) and rules become lines without text.
The lengths of text outside links, summed over windows of ``WINDOW`` lines,
then show on every page where the text surges (``SURGE`` characters in a
window) and where it dives (a window of nothing but links).  The lines from
the first surge to the last dive are kept, but for windows of nothing but links
between them.  A page without any surge gives all its text outside links.

Where the page marks its article, the same windows are laid over the article's
lines.  A short line in front of the first surge (a title, a date) or behind
the last one is part of the article here, so it is kept from the dive in front
of the first surge to the dive behind the last, and its headings are kept
wherever they stand; an article without any surge is kept but for its dives.
If more of the text that surges lies outside the article than in it (the mark
was on a teaser), the lines of the whole page's distribution are kept as well.

If all marked articles lie in skipped elements (a form around the page, a menu
that is never closed), the page is read again with articles ending what is
skipped around them, and the reading with more text counts.

Character references are decoded, white space inside a block becomes one
space, blocks are joined by one space; nothing else is dropped or cut.  One
pass over each page in its partition, no shuffle.

Defined cases: null and empty pages, and pages without text, give the empty
text; unclosed elements end where the page ends, a skipped paragraph and a
link at the next block; pages of any length are read whole; repeated rows give repeated
results; an empty table gives an empty result; an input column named like an
output is replaced.
"""

from __future__ import annotations

import html
import re

import numpy as np
from pyspark.sql import DataFrame

from fraudlens.llm.common import map_text, table

WINDOW = 3
SURGE = 80
OUTPUTS = "text string, n_chars long"

# Element names of HTML by what they mean here.
_BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset
    figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav
    noscript ol option p pre section select summary table tbody td tfoot th thead tr ul""".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
_SKIPPED = frozenset("""head nav footer aside form menu dialog button select template noscript svg canvas
    object audio video""".split())
_SKIPPED_ROLES = frozenset("""navigation banner contentinfo complementary search dialog alert menu menubar
    toolbar form""".split())
# Words that mark what is not the article.  A class or id counts if it is made of such words and, besides them,
# only of words that say nothing about the content.
_SKIPPED_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo
    promotion banner sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar cookie
    cookies consent notice notices alert popup modal overlay comment comments respond disqus reply replies
    share sharing social related recommended newsletter subscribe subscription signup login pagination pager
    toc widget""".split())
_NEUTRAL_WORDS = frozenset("""area bar block bottom box col column container content group holder inner item items
    left links list main outer page post posts primary right row secondary section site top wrap wrapper""".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)
    |<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
                  re.S | re.X)
_ARTICLE = re.compile(r"<(?:article|main)\b", re.I)
_MARK = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_SPLIT = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")
_HREF = re.compile(r"(?:^|\s)href\s*=", re.I)
_LINK = re.compile(r"<(/?)a(?=[\s/>])", re.I)


def _is_skipped(name: str, attributes: str, in_article: bool) -> bool:
    if name in _SKIPPED or (name == "header" and not in_article):
        return True
    return name not in ("html", "body", "article", "main") and _is_other(attributes)


def _is_other(attributes: str) -> bool:
    for kind, *values in _MARK.findall(attributes):
        value = next((v for v in values if v), "")
        if kind.lower() == "role":
            if value.strip().lower() in _SKIPPED_ROLES:
                return True
        elif any(map(_names_other, value.split())):
            return True
    return False


def _names_other(name: str) -> bool:
    """Whether a class or id as a whole names something besides the article:
    ``comment-list`` does, ``has-sidebar`` and ``notice-of-claim`` do not."""
    if name.lower() in _SKIPPED_WORDS:
        return True
    words = _SPLIT.sub(" ", name).lower().split()
    return (any(w in _SKIPPED_WORDS for w in words)
            and all(w in _SKIPPED_WORDS or w in _NEUTRAL_WORDS or w.isdigit() for w in words))


def _plain(text: str) -> str:
    return " ".join(html.unescape(text).split())


def lines_of(page: str, articles_end_skips: bool = False):
    """(text, linked, inside, heading) of every line: its text, how many of its
    characters lie in links, and whether it is in a marked article and a
    heading."""
    lines, parts, linked = [], [], 0
    at, in_link, ends_with_line, article, heading = 0, False, False, 0, False
    skip, depth = "", 0

    def flush():
        nonlocal parts, linked, in_link
        if parts:
            lines.append((_plain("".join(parts)), linked, article > 0, heading))
        parts, linked, in_link = [], 0, in_link and not ends_with_line

    def take(start: int, end: int):
        nonlocal linked
        if end > start and not skip:
            parts.append(page[start:end])
            if in_link:
                linked += len(_plain(page[start:end]))

    pos = 0
    while m := _TAG.search(page, pos):
        take(at, m.start())
        at = pos = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing = bool(m[1] or m[4])
        attributes = m[3] or m[6] or ""
        if name in _RAW and not closing:             # raw text up to the closing tag
            end = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>?", re.I).search(page, pos)
            at = pos = end.end() if end else len(page)
            continue
        if (skip and articles_end_skips and name in ("article", "main") and not closing
                and not _is_other(attributes)):
            skip, depth = "", 0
        if skip:
            if name == skip and not attributes.endswith("/"):
                depth += -1 if closing else 1
            if depth == 0 or (skip == "p" and name in _BLOCK and not (name == "p" and closing)):
                skip = ""
                if closing or depth == 0:
                    continue
            else:
                continue
        block = name in _BLOCK
        if block or name == "br":
            if block:
                flush()
                heading = name in _HEADINGS and not closing
                if name == "hr":
                    lines.append(("", 0, article > 0, False))
            elif parts:
                parts.append(" ")
        if name == "a":
            in_link = not closing and bool(_HREF.search(attributes))
            if in_link:                              # without an end of its own it ends with its line
                end = _LINK.search(page, pos)
                ends_with_line = not (end and end[1])
        elif name in ("article", "main"):
            article = max(0, article + (-1 if closing else 1))
        if not closing and name not in _VOID and _is_skipped(name, attributes, article > 0):
            if not block:
                parts.append(" ")
            flush()
            lines.append(("", 0, article > 0, False))
            skip, depth = name, 1
    take(at, len(page))
    flush()
    return lines


def surges(lengths: np.ndarray, least: int) -> np.ndarray:
    """True for the lines with text of every window that reaches ``least`` characters."""
    keep = np.zeros(len(lengths), dtype=bool)
    if not len(lengths):
        return keep
    total = np.concatenate([[0], np.cumsum(lengths)])
    ends = np.minimum(np.arange(len(lengths)) + WINDOW, len(lengths))
    high = total[ends] - total[:-1] >= least
    for k in range(min(WINDOW, len(lengths))):
        keep[k:] |= high[:len(lengths) - k]
    return keep & (lengths > 0)


def between(lengths: np.ndarray) -> np.ndarray:
    """True from the first surge to the last dive, but for ``WINDOW`` and more
    lines on end without text outside links; without any surge, true for all
    lines with such text."""
    at = np.flatnonzero(surges(lengths, SURGE))
    if not len(at):
        return lengths > 0
    keep = np.zeros(len(lengths), dtype=bool)
    keep[at[0]:at[-1] + 1] = True
    return keep & ~dives(lengths)


def dives(lengths: np.ndarray) -> np.ndarray:
    """True for ``WINDOW`` and more lines on end without text outside links."""
    low = np.zeros(len(lengths), dtype=bool)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], (lengths == 0).astype(int), [0]])))
    for first, past in zip(edges[::2], edges[1::2]):
        low[first:past] = past - first >= WINDOW
    return low


def dive_to_dive(lengths: np.ndarray) -> np.ndarray:
    """True from the dive in front of the first surge to the dive behind the
    last, but for dives between them; without any surge, true for all that is
    no dive, and without any text outside links for all lines."""
    if not lengths.any():
        return np.ones(len(lengths), dtype=bool)
    low, at = dives(lengths), np.flatnonzero(surges(lengths, SURGE))
    keep = ~low
    if len(at):
        keep[:np.flatnonzero(low[:at[0]])[-1:].max(initial=0)] = False
        keep[at[-1] + np.flatnonzero(low[at[-1]:])[:1].min(initial=len(lengths)):] = False
    return keep


def _read(page: str, articles_end_skips: bool) -> tuple[bool, str]:
    """Whether the page marks an article that holds most of the text, and its
    main text."""
    lines = lines_of(page, articles_end_skips)
    lengths = np.array([max(0, len(t) - linked) if linked * 2 <= len(t) else 0 for t, linked, _, _ in lines], dtype=int)
    inside = np.array([within for _, _, within, _ in lines], dtype=bool)
    marked = any(within and t for t, _, within, _ in lines)
    if marked:
        article, rest = lengths * inside, lengths * ~inside
        keep = inside & (dive_to_dive(article) | np.array([heading for *_, heading in lines]))
        marked = article[surges(article, SURGE)].sum() >= rest[surges(rest, SURGE)].sum()
        if not marked:
            keep |= between(lengths)
    else:
        keep = between(lengths)
    return marked, " ".join(t for (t, *_), k in zip(lines, keep) if k and t)


def main_text(page: str | None) -> str:
    marked, text = _read(page or "", False)
    if not marked and _ARTICLE.search(page or ""):
        marked, other = _read(page, True)
        if marked and len(other) > len(text):
            return other
    return text


def extract(pages: DataFrame, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``pages`` with text and n_chars."""
    def run(found):
        texts = [main_text(p) for p in found]
        return texts, [len(t) for t in texts]
    return map_text(pages, run, OUTPUTS, html_col, keep)


def query(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
