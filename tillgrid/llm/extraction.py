"""Main text of web pages by tag-path ratios.

A page is cut into blocks, each with the path of the elements that hold it. Menus, footers, sidebars, code and hidden
elements are left out. So are headers, forms and elements whose class, id or role names a menu, notice, advert, comments
or the like, by a whole word or a listed pair; but where the page has its landmarks (``article``, ``main``) inside such an
element only, or has none and holds most of its text there, the ratios decide on it as well (the latter not for adverts,
menus, comments and others whose name leaves no doubt). For every remaining path, two ratios
are taken over the page: text per block and punctuation per block. Both are smoothed along the page, so that a short
heading shares the weight of the paragraphs after it, scaled and fused by multiplication, twice as much for paths inside an ``article``
or ``main`` element; paths whose fused ratio reaches a share of the page's spread are content. All blocks on content paths are returned, whatever their length.

Each page is handled by itself in one pass over its characters, so pages stay where they are read.

Defined results: null or empty html, and html without text, give an empty text; unclosed elements end where HTML says
or at the end of the page; repeated rows give repeated results; an empty table gives no rows.
"""

from __future__ import annotations

import html as html_entities
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A tag runs to its closing bracket, past quoted values; one that never ends swallows the rest, as in browsers, so no
# character is looked at twice.
_REST_OF_TAG = r"(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^'\">])*+(?:>|\Z)"
_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|svg|math|iframe|select|title|object|canvas|audio|video)"
    rf"(?=[\s/>]){_REST_OF_TAG}(?:.*?</(?P=raw)\s*+>|.*\Z)"
    rf"|<(?P<close>/?)(?P<name>[a-z][^\s/>]*+)(?P<attrs>{_REST_OF_TAG})"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"?|'([^']*+)'?|([^\s>]++)))?|[\"'][^\"']*+[\"']?")
_SPACE = re.compile(r"\s+")

#: Elements that run along with the text of their block.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr picture source map area".split()
)
#: Elements without content.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that are never content.
_NOISE_TAGS = frozenset("nav footer aside button input menu head search".split())
#: Elements that are content only where they hold the page's main part, as named containers do.
_WEAK_TAGS = frozenset("form dialog fieldset header".split())
#: Names in class, id or role that mark what is not content.
_NOISE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot banner promo promotion sponsor sponsored"
    " nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc sidebar aside rail widget widgets"
    " footer header masthead topbar toolbar comment comments commentlist disqus reply replies respond discussion"
    " notice notices cookie cookies consent gdpr popup modal overlay alert newsletter subscribe signup login share"
    " sharing social related recommended recommendations search complementary contentinfo dialog form feedback".split()
)
#: Those of them that leave no doubt: not even most of a page's text makes such an element its main part.
_SURE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot sponsor sponsored nav navbar navigation breadcrumb"
    " breadcrumbs pagination pager footer comment comments commentlist disqus cookie cookies consent gdpr".split()
)
#: Compound names that mark it as well, besides those whose parts all do (numbers aside).
_NOISE_PAIRS = frozenset(
    "site-header site-footer site-nav page-header page-footer global-header global-footer main-nav main-menu top-nav"
    " top-bar side-bar primary-nav primary-menu nav-links skip-link related-posts related-articles share-buttons"
    " share-bar social-links social-icons comment-list comments-area ad-slot ad-box ad-container ad-banner ad-unit"
    " ad-wrapper cookie-bar newsletter-box search-box search-results-nav login-form".split()
)
#: An opening of the key closes an open element of the value.
_BLOCKS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3"
    " h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
_CLOSES = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
    "tbody": frozenset(["thead", "tbody", "tr", "td", "th"]),
    "tfoot": frozenset(["thead", "tbody", "tr", "td", "th"]),
}
_SCOPES = frozenset("ul ol dl table body html article section div".split())
_LANDMARKS = frozenset(["article", "main"])
_PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？،؛؟।]")


#: What an element is: content as far as markup tells, content if it holds the page's landmarks or most of its text,
#: content if it holds its landmarks, or never content.
_PLAIN, _WEAK, _NAMED, _NOISE = range(4)


def _named(word: str) -> int:
    parts = [p for p in re.split(r"[-_]+", word) if p and not p.isdigit()]
    if not parts or not ("-".join(parts) in _NOISE_PAIRS or _NOISE_NAMES.issuperset(parts)):
        return _PLAIN
    return _WEAK if _SURE_NAMES.isdisjoint(parts) else _NAMED


def _kind(name: str, attrs: str, landmark: bool) -> int:
    if name in _NOISE_TAGS:
        return _NOISE
    kind = _WEAK if name in _WEAK_TAGS and not (name == "header" and landmark) else _PLAIN
    if name in ("html", "body", "article", "main") or not attrs.strip(" />"):
        return kind
    for key, *values in _ATTRIBUTE.findall(attrs):
        value = "".join(values).lower()
        key = key.lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return _NOISE
        if key in ("class", "id", "role"):
            kind = max(kind, *map(_named, value.split()), _PLAIN)
    return kind


def blocks(html: str) -> list[tuple[str, str, int]]:
    """Blocks of a page that markup does not rule out: (path, text, characters outside links), in page order."""
    out: list[tuple[str, str, int]] = []
    stack: list[tuple[str, bool, int]] = []  # block elements: (name, noise, innermost weak element)
    # weak and named elements: text, the one around, whether a landmark is inside, whether most of the text counts
    weak, above, held, larger = [0], [0], [False], [False]
    within: list[int] = []  # innermost weak element of each block
    noise = landmark = links = plain = 0
    parts: list[str] = []

    def inner() -> int:
        return stack[-1][2] if stack else 0

    def flush() -> None:
        nonlocal plain
        if parts:
            text = _SPACE.sub(" ", "".join(parts)).strip()
            if text and not noise:
                out.append(("/".join(n for n, _, _ in stack), text, plain))
                within.append(inner())
                weak[inner()] += plain
            parts.clear()
        plain = 0

    def pop() -> None:
        nonlocal noise, landmark
        name, bad, _ = stack.pop()
        noise -= bad
        landmark -= name in ("article", "main")

    def add(raw: str) -> None:
        nonlocal plain
        if noise or not raw:
            return
        text = html_entities.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if not links:
            plain += len(text.strip())

    at = 0
    for m in _TOKEN.finditer(html):
        add(html[at : m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if name in _INLINE:
            if name == "br":
                parts.append(" ")
            elif name == "a":
                links = 0 if m["close"] else 1
            elif not m["close"] and not noise and name not in _VOID and _kind(name, m["attrs"], bool(landmark)):
                stack.append((name, True, inner()))  # an inline element that names itself an advert or the like
                noise += 1
                continue
            if m["close"] and stack and stack[-1][0] == name:
                noise -= stack.pop()[1]
            continue
        flush()
        if m["close"]:
            if any(n == name for n, _, _ in stack):
                while stack[-1][0] != name:
                    pop()
                pop()
            links = 0
            continue
        if name in _VOID:
            continue
        ends = _CLOSES.get(name, frozenset())
        if name in _BLOCKS:
            ends = ends | {"p"}
        while ends and stack and (stack[-1][0] in ends or (stack[-1][1] and stack[-1][0] in _INLINE)):
            pop()
        kind = _kind(name, m["attrs"], bool(landmark))
        around = inner()
        if kind in (_WEAK, _NAMED) and not noise:
            larger.append(kind == _WEAK)
            weak.append(0)
            above.append(around)
            held.append(False)
            around = len(weak) - 1
        stack.append((name, kind == _NOISE, around))
        noise += kind == _NOISE
        if name in _LANDMARKS:
            landmark += 1
            held[around] |= not noise
    add(html[at:])
    flush()
    # Such elements stay in only where they hold what the rest of the page lacks: its landmarks, or else most of its text.
    outside = held[0]
    for k in range(len(weak) - 1, 0, -1):
        weak[above[k]] += weak[k]
        held[above[k]] |= held[k]
    stays = [True]
    for k in range(1, len(weak)):
        main = held[k] if held[0] else larger[k] and 2 * weak[k] > weak[0]
        stays.append(stays[above[k]] and main and not outside)
    return [block for block, k in zip(out, within, strict=True) if stays[k]]


def content_paths(found: list[tuple[str, str, int]], share: float = 0.25, radius: int = 2) -> set[str]:
    """Paths whose fused, smoothed ratios of text and of punctuation reach ``share`` of the page's spread."""
    paths = list(dict.fromkeys(p for p, _, _ in found))
    number = {p: i for i, p in enumerate(paths)}
    of = np.array([number[p] for p, _, _ in found])
    text = np.array([plain for _, _, plain in found], dtype=float)
    marks = np.array([len(_PUNCTUATION.findall(t)) if plain else 0 for _, t, plain in found], dtype=float)
    n = np.bincount(of, minlength=len(paths))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / max(radius / 2, 0.5)) ** 2)
    kernel /= kernel.sum()

    def ratio(x: np.ndarray) -> np.ndarray:
        along = (np.bincount(of, weights=x, minlength=len(paths)) / n)[of]
        padded = np.pad(along, radius, mode="edge")
        smooth = np.convolve(padded, kernel, mode="valid")
        best = np.bincount(of, weights=smooth, minlength=len(paths)) / n
        return best / best.max() if best.max() > 0 else best

    landmark = np.array([not _LANDMARKS.isdisjoint(p.split("/")) for p in paths])
    fused = ratio(text) * (0.5 + 0.5 * ratio(marks)) * np.where(landmark, 2.0, 1.0)
    limit = share * fused.std() if len(paths) > 1 else 0.0
    own = np.bincount(of, weights=text, minlength=len(paths))
    return {p for p, f, t in zip(paths, fused, own, strict=True) if t > 0 and f > 0 and f >= limit}


def main_text(html: str | None) -> str:
    """The content blocks of one page, one to a line."""
    found = blocks(html) if html else []
    if not found:
        return ""
    chosen = content_paths(found)
    return "\n".join(t for p, t, _ in found if p in chosen)


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row."""

    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(p) for p in pages], dtype=object)

    text = F.pandas_udf(texts, "string")(F.col(html_col).cast("string"))
    return df.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), text.alias("text")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )
