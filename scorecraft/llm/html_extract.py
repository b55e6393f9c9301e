"""HTML extraction (operator 9): a linear-chain CRF over DOM leaf blocks.

A page is read into its leaf blocks: the runs of text between block-level tags,
each with the tags and class words of its ancestors. A two-state chain labels
the blocks main text or not from ancestor and text features; Viterbi decodes
it, and the main blocks are joined in page order.

The chain is trained on labelled pages: at most ``TRAIN_PAGES`` pages of the
table, chosen by a hash of their content whatever their length. They are read
where they lie; of a page with more than ``RUNS * RUN`` blocks, ``RUNS`` evenly
spaced runs of ``RUN`` blocks are used. Pages that mark their article (``article``
or ``main``) are labelled by that mark. Since one site's layout teaches only
itself, the same pages' sentences are also set into ``LAYOUTS`` labelled
layouts with menus, notices, adverts, forms, sidebars, comments and other
containers. A sentence is a block of ``SENTENCE`` code points or more (its first ``LONGEST``),
so scripts without spaces have them too; if no page has one, the layouts are filled with
the blocks there are, or with ``FILLER``. Extraction is one pass over the whole table without a shuffle.

Defined cases: a null or empty page has the empty text; text outside any tag is
a block; unclosed and stray tags are tolerated; a quote inside an attribute's
name or unquoted value is a letter like others, a quote that never closes ends
at the next space or ``>``, and a tag that never ends is text; time and memory
grow with the page's length whatever its nesting; repeated rows give equal rows;
a null page_id or url stays null; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorecraft.llm import crf
from scorecraft.llm.common import arrow_stream, bounded_batches

TRAIN_PAGES = 200
RUNS, RUN = 4, 64
LAYOUTS = 600
SENTENCE, LONGEST = 12, 300
# the attribute that marks main text (1) and the rest (0) in generated layouts
MARK = "data-y"
FILLER = "Some words that stand for a sentence."

# HTML vocabulary (fixed values of the standard)
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre
    search section summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# not read as text up to their end tag; without one, only script and style run to the end of the page
RAW = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in "noscript template svg iframe textarea select canvas title".split()}
# a tag that opens closes the open one of its kind
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}, "p": {"p"}}
SCOPE = frozenset("ul ol dl table div article section main aside nav body form blockquote td th".split())

# a comment, declaration, script or style to its end; or the beginning of a tag
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-z][^\s/>]*)", re.S | re.I)
_CODE = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style")}
# what may follow a tag's name: its end, or an attribute's name (a quote in it is no quotation) and perhaps a value
_PART = re.compile(r"[\s/]*(?:(>)|([^\s/>][^\s/>=]*)(\s*=\s*)?)")
_BARE = re.compile(r"[^\s>]*")
_NAMES = frozenset("class id role hidden aria-label".split())
# tags that never end, after which a page's further ``<`` are text
NEVER_ENDING = 16
_WORDS = re.compile(r"[a-z]+|\d")

# ancestor tags and class words that count as features
TAGS = ("article", "main", "section", "nav", "header", "footer", "aside", "form", "ul", "ol", "table", "figure", "blockquote",
        "div", "details", "dialog", "menu", "address")
_TAG_SET = frozenset(TAGS)
OWN_TAGS = ("p", "li", "h1", "h2", "h3", "div", "td", "label", "button", "legend", "pre", "figcaption", "dd", "article", "body")
HINTS = tuple(re.compile(p) for p in (
    r"\b(article|post|entry|story|content|main|body|text|prose)", r"\b(comment|reply|replies|discussion|disqus|respond)",
    r"\b(ad|ads|advert\w*|sponsor\w*|promo\w*|banner|dfp|adsense)\b", r"\b(side|sidebar|widget|related|recommend\w*|rail|more|popular|trending)",
    r"\b(nav|menu|breadcrumb\w*|pagination|pager|toc|tabs?|skip)", r"\b(cookie\w*|consent|notice|alert|gdpr|modal|popup|overlay|toast|warning|message)",
    r"\b(share|social|follow|tweet|facebook)", r"\b(foot|footer|copyright|legal|colophon)", r"\b(head|header|masthead|logo|topbar)\b",
    r"\b(form|login|signup|newsletter|subscribe|search|register|contact)", r"\b(meta|byline|author|date|tags?|category|breadcrumb)\b"))


@dataclass
class Block:
    text: str
    tags: frozenset  # those of TAGS among its ancestors
    own: str
    hints: tuple
    linked: int  # characters inside links
    label: int | None


class _Quotes:
    """Reads the attributes of a page's tags. A value whose quote never closes is read up to
    the next space or ``>``; every step moves on, and the last quotes are looked up once."""

    def __init__(self, page: str):
        self.page = page
        self.last = {q: page.rfind(q) for q in "\"'>"}

    def attributes(self, at: int) -> tuple[int, list[tuple[str, str]]] | None:
        """(behind the tag's ``>``, its attributes), or None if the tag never ends."""
        page, found = self.page, []
        if at > self.last[">"]:
            return None
        while m := _PART.match(page, at):
            at = m.end()
            if m[1]:
                return at, found
            value = ""
            if m[3]:
                quote = page[at:at + 1]
                if quote in ("\"", "'") and at < self.last[quote]:
                    end = page.index(quote, at + 1)
                    value, at = page[at + 1:end], end + 1
                else:
                    bare = _BARE.match(page, at)
                    value, at = bare[0].strip("\"'"), bare.end()
            found.append((m[2].lower(), value))
        return None


class _Stack:
    """The open tags. An entry holds what a block inside it inherits, so that a block costs
    the same at any depth, and positions are kept by tag, so that nothing is searched for."""

    ROOT = (frozenset(), "body", (False,) * len(HINTS), None)

    def __init__(self):
        self.entries: list[tuple[str, str, int | None, tuple]] = []
        self.places: dict[str, list[int]] = {}
        self.scopes: list[int] = []
        self.known: dict[str, tuple] = {}

    def context(self) -> tuple:
        return self.entries[-1][3] if self.entries else self.ROOT

    def push(self, tag: str, words: str, label: int | None) -> None:
        tags, own, hints, above = self.context()
        if words:
            if words not in self.known:
                self.known[words] = tuple(bool(h.search(words)) for h in HINTS)
            hints = tuple(a or b for a, b in zip(hints, self.known[words]))
        context = (tags | {tag} if tag in _TAG_SET and tag not in tags else tags, tag if tag in BLOCK else own, hints,
                   above if label is None else label)
        self.places.setdefault(tag, []).append(len(self.entries))
        if tag in SCOPE:
            self.scopes.append(len(self.entries))
        self.entries.append((tag, words, label, context))

    def cut(self, place: int) -> None:
        """Close the tag at ``place`` and all inside it."""
        while len(self.entries) > place:
            tag = self.entries.pop()[0]
            self.places[tag].pop()
            if tag in SCOPE:
                self.scopes.pop()

    def close(self, tag: str) -> None:
        if self.places.get(tag):
            self.cut(self.places[tag][-1])

    def close_kind(self, kinds: set[str]) -> None:
        """Close the innermost open tag of these kinds unless a scope lies inside it."""
        place = max((self.places[t][-1] for t in kinds if self.places.get(t)), default=-1)
        if place >= 0 and (not self.scopes or place >= self.scopes[-1]):
            self.cut(place)

    def drop(self, tag: str) -> None:
        """Forget open tags of this name and keep what is inside them."""
        if self.places.get(tag):
            kept = [e for e in self.entries if e[0] != tag]
            self.cut(0)
            for name, words, label, _ in kept:
                self.push(name, words, label)


def blocks(page: str, mark: str | None = None) -> list[Block]:
    """The leaf blocks of a page in order. ``mark`` names the attribute that holds the
    label in a page generated for training; pages of the table have none."""
    out: list[Block] = []
    stack, quotes = _Stack(), _Quotes(page)
    text: list[str] = []
    linked = at = never = 0

    def flush() -> None:
        nonlocal linked
        if text:
            s = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if s:
                tags, own, hints, label = stack.context()
                out.append(Block(s, tags, own, hints, min(linked, len(s)), label))
        linked = 0

    unclosed: set[str] = set()  # raw tags without a further end tag
    while m := _TOKEN.search(page, at):
        tag, ending = m[2].lower() if m[2] else "", bool(m[1])
        read = quotes.attributes(m.end()) if tag and never < NEVER_ENDING else None
        never += bool(tag and not read)
        stop = m.start() if read or not tag else m.end()
        if stop > at:
            piece = page[at:stop]
            text.append(piece)
            if stack.places.get("a"):
                linked += len(piece.strip())
        if not read:  # a comment or declaration; or no tag but text
            at = m.end()
            continue
        at, attributes = read
        closed = page[at - 2] == "/"
        if tag in _CODE and not ending:
            end = None if tag in unclosed else _CODE[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in RAW and not ending:
            if tag == "svg" and closed:
                continue
            end = None if tag in unclosed else RAW[tag].search(page, at)
            if end:
                at = end.end()
            else:
                unclosed.add(tag)
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCK:
            flush()
        if ending:
            stack.close(tag)
            continue
        if tag in VOID or closed and tag not in BLOCK:
            continue
        if tag == "body":
            stack.drop("head")  # its end tag may be left out
        if tag in SAME or tag in BLOCK and tag not in ("html", "body"):
            stack.close_kind(SAME.get(tag, {"p"}))
        words = "".join(" " + " ".join(_WORDS.findall((name if name == "hidden" else value).lower()))
                        for name, value in attributes if name in _NAMES)
        label = next((int(value) for name, value in attributes if name == mark), None) if mark else None
        stack.push(tag, words, label)
    if at < len(page):
        text.append(page[at:])
    flush()
    return out


N_TEXT = 14


def features(page: list[Block]) -> np.ndarray:
    x = np.zeros((len(page), N_TEXT + len(TAGS) + len(OWN_TAGS) + len(HINTS) + 4))
    k = N_TEXT
    for i, b in enumerate(page):
        s, n = b.text, len(b.text)
        words = s.count(" ") + 1
        x[i, :N_TEXT] = (
            np.log1p(n), words > 12, words < 4, b.linked / n, b.linked > 0.6 * n, s[-1] in ".!?:\"'…”",
            (s.count(".") + s.count(",")) / words, "©" in s or "©" in s, "|" in s or "»" in s or "·" in s,
            n / words > 9, s[0].isupper(), sum(c.isdigit() for c in s[:200]) / min(n, 200), i / len(page), n > 200)
        x[i, k:k + len(TAGS)] = [t in b.tags for t in TAGS]
        x[i, k + len(TAGS):k + len(TAGS) + len(OWN_TAGS)] = [t == b.own for t in OWN_TAGS]
        x[i, k + len(TAGS) + len(OWN_TAGS):-4] = b.hints
    if len(page):
        x[1:, -4], x[:-1, -3] = x[:-1, 0], x[1:, 0]  # the neighbours' length and links
        x[1:, -2], x[:-1, -1] = x[:-1, 3], x[1:, 3]
    return x


def weak_labels(page: list[Block]) -> list[int] | None:
    """Labels by the page's own marks; None if it has none."""
    if not any(b.tags & {"article", "main"} for b in page):
        return None
    off = {"nav", "header", "footer", "aside", "form", "menu", "dialog"}
    return [int(bool(b.tags & {"article", "main"}) and not b.tags & off and not any(b.hints[1:3])) for b in page]


def beginning(sentence: str, n: int) -> str:
    """The first n words; of a text of hardly any spaces, that many short runs of code points."""
    words = sentence.split()
    return " ".join(words[:n]) if len(words) > 3 else sentence[:4 * n]


def layout(sentences: list[str], rng: random.Random) -> str:
    """One labelled page: ``data-y`` marks main text (1) and the rest (0)."""
    pick, chance = rng.choice, lambda p: rng.random() < p
    say = lambda n=1: html.escape(" ".join(rng.choice(sentences) for _ in range(n)), quote=False)
    few = lambda n=3: html.escape(beginning(rng.choice(sentences), rng.randint(1, n)), quote=False)
    links = lambda n: "".join(f'<li><a href="/x">{few()}</a></li>' for _ in range(n))
    attr = lambda *names: pick(["class", "id"]) + f'="{pick(names)}"'

    def menu():
        return pick([f"<nav data-y=0><ul>{links(rng.randint(2, 8))}</ul></nav>",
                     f"<div data-y=0 {attr('menu', 'top-menu', 'nav', 'navbar')}><ul>{links(rng.randint(2, 8))}</ul></div>",
                     f"<ul data-y=0 {attr('menu', 'nav', 'breadcrumbs')}>{links(rng.randint(2, 6))}</ul>"])

    def advert():
        return pick([f'<div data-y=0 {attr("ad", "advert", "ad-slot", "sponsored", "promo", "banner-ad")}>{say(rng.randint(1, 2))}</div>',
                     f'<aside data-y=0 {attr("ad", "promo", "advertisement")}><p>{say()}</p></aside>'])

    def notice():
        return f'<div data-y=0 {attr("cookie", "cookie-notice", "consent-banner", "notice", "alert", "gdpr")}>' + pick(["<p>{}</p>", "{}"]).format(say()) + pick(["", "<button>OK</button>"]) + "</div>"

    def form():
        return f'<form data-y=0 {pick(["", attr("newsletter", "search", "login", "subscribe", "contact")])}>' + pick(["<label>{}</label>", "<p>{}</p>", "{}"]).format(say()) + '<input name="q"><button>' + few() + "</button></form>"

    def sidebar():
        inner = pick([f"<h3>{few(5)}</h3><ul>{links(rng.randint(2, 7))}</ul>", f"<p>{say(rng.randint(1, 3))}</p>"])
        return pick([f"<aside data-y=0 {pick(['', attr('sidebar', 'related')])}>{inner}</aside>", f'<div data-y=0 {attr("sidebar", "side", "widget", "related", "recommended")}>{inner}</div>'])

    def comments():
        one = pick(['<div class="comment"><p>{}</p></div>', "<li>{}</li>", '<article class="comment"><p>{}</p></article>', "<p>{}</p>"])
        body = "".join(one.format(say(rng.randint(1, 4))) for _ in range(rng.randint(1, 6)))
        head = pick(["", f"<h2>{few()}</h2>", f"<h3>{few()}</h3>"])
        return pick([f'<section data-y=0 {attr("comments", "comment-list", "discussion", "replies", "reader-comments")}>{head}{body}</section>',
                     f'<div data-y=0 {attr("comments", "comment-list", "reader-comments", "responses")}>{head}{body}</div>',
                     f'<ol data-y=0 {attr("comments", "commentlist")}>{body}</ol>'])

    def header():
        inner = pick([f"<a href='/'>{few()}</a>", f"<p>{few(6)}</p>", f"<div>{few()}</div>"]) + (menu() if chance(0.5) else "")
        return pick([f"<header data-y=0>{inner}</header>", f'<div data-y=0 {attr("header", "masthead", "logo", "topbar")}>{inner}</div>'])

    def footer():
        inner = pick(["&copy; {} &middot; {}", "<p>&copy; {} {}</p>", "<p>{}</p><p>{}</p>"]).format(few(), say()) + (f"<ul>{links(3)}</ul>" if chance(0.4) else "")
        return pick([f"<footer data-y=0>{inner}</footer>", f'<div data-y=0 {attr("footer", "copyright", "site-footer")}>{inner}</div>'])

    extras = [advert, notice, form, sidebar]
    body = [f"<h1>{few(10)}</h1>"] if chance(0.8) else []
    for _ in range(rng.randint(1, 9)):
        kind = rng.random()
        if kind < 0.74:
            body.append(f"<p>{'<b>' * chance(0.1)}{say(rng.randint(1, 6))}" + pick(["</p>", "</p>", ""]))
        elif kind < 0.82:
            body.append(f"<h2>{few(8)}</h2>")
        elif kind < 0.88:
            body.append("<ul>" + "".join(f"<li>{say()}</li>" for _ in range(rng.randint(2, 4))) + "</ul>")
        elif kind < 0.92:
            body.append(f"<blockquote>{say(2)}</blockquote>")
        elif kind < 0.95:
            body.append(f"<p>{few(4)}</p>")
        elif kind < 0.97:
            body.append(f"<table><tr><td>{few()}</td><td>{say()}</td></tr></table>")
        else:
            body.append(pick(extras)())
    if chance(0.3):
        body.insert(rng.randint(1, len(body)), pick(extras)())
    if chance(0.2):
        body.append(comments())
    open_, close = pick([("<article data-y=1>", "</article>")] * 4 + [("<main data-y=1>", "</main>"), ("<main><article data-y=1>", "</article></main>"),
                        (f'<div data-y=1 {attr("content", "post", "article-body", "entry-content", "main", "story")}>', "</div>"),
                        (f'<section data-y=1 {attr("content", "post", "article")}>', "</section>"), ("<div data-y=1>", "</div>"),
                        ("<table><tr><td data-y=1>", "</td></tr></table>"), ('<div class="page"><div data-y=1>', "</div></div>")])
    before = [f() for f, p in ((header, 0.5), (menu, 0.7), (notice, 0.35), (advert, 0.45), (sidebar, 0.2), (form, 0.15)) if chance(p)]
    after = [f() for f, p in ((comments, 0.4), (sidebar, 0.4), (form, 0.3), (advert, 0.25), (menu, 0.1), (notice, 0.15), (footer, 0.85)) if chance(p)]
    return f"<html><head><title>{few()}</title></head><body>{''.join(before)}{open_}{''.join(body)}{close}{''.join(after)}</body></html>"


def training_rows(pages: DataFrame, train_pages: int, seed: int) -> list:
    """Bounded extracts of at most ``train_pages`` pages: the sizes of the runs, whether
    they are labelled, packed features and labels, and the sentences."""
    place = F.pmod(F.xxhash64("html", F.lit(seed)), F.lit(2**30))  # by hash, so that few pages move whatever the table's size
    some = pages.where(F.length("html") > 0)
    near = some.select(place.cast("long").alias("place"), "html").where(
        place < int(2**30 * min(1.0, 2 * train_pages / max(1, some.count()))))

    def run(batches):
        for b in bounded_batches(batches, "html", 4 << 20):
            out = {c: [] for c in ("place", "page", "sizes", "marked", "x", "y", "texts")}
            for at, text in zip(b.column("place").to_pylist(), b.column("html").to_pylist()):
                page = blocks(text)
                starts = [0] if len(page) <= RUNS * RUN else [k * (len(page) - RUN) // (RUNS - 1) for k in range(RUNS)]
                ends = [len(page) if len(starts) == 1 else i + RUN for i in starts]
                x, y = features(page), weak_labels(page)
                used = np.concatenate([np.arange(i, j) for i, j in zip(starts, ends)])
                out["place"].append(at)
                out["page"].append(zlib.crc32(text.encode()))
                out["sizes"].append([j - i for i, j in zip(starts, ends)])
                out["marked"].append(bool(page) and y is not None)
                out["x"].append(zlib.compress(x[used].tobytes(), 1))
                out["y"].append([] if y is None else [y[i] for i in used])
                out["texts"].append([page[i].text[:LONGEST] for i in used])
            yield out

    read = arrow_stream(near, run, "place long, page long, sizes long[], marked boolean, x binary, y long[], texts string[]")
    return read.orderBy("place", "page").limit(train_pages).collect()


def fit(pages: DataFrame, train_pages: int = TRAIN_PAGES, layouts: int = LAYOUTS, seed: int = 9) -> crf.Crf:
    """The chain trained on a bounded sample of the pages and layouts made of their sentences."""
    xs, ys, lengths, texts = [], [], [], []
    for r in training_rows(pages, train_pages, seed):
        texts += r["texts"]
        if r["marked"]:
            xs.append(np.frombuffer(zlib.decompress(r["x"])).reshape(len(r["y"]), -1))
            ys += r["y"]
            lengths += r["sizes"]
    rng = random.Random(seed)
    sentences = [t for t in texts if len(t) >= SENTENCE] or texts or [FILLER]
    for _ in range(layouts):
        page = blocks(layout(sentences, rng), MARK)
        if page:
            xs.append(features(page))
            ys += [b.label or 0 for b in page]
            lengths.append(len(page))
    return crf.fit(np.vstack(xs), np.array(ys, np.int64), np.array(lengths), l2=0.5)


def main_texts(model: crf.Crf | None, pages: list[str]) -> list[str]:
    read = [blocks(p) for p in pages]
    if model is None or not any(read):
        return [""] * len(pages)
    x = np.vstack([features(b) for b in read])
    path = crf.viterbi(model.scores(x), model.step, model.first, np.array([len(b) for b in read]))
    out, at = [], 0
    for b in read:
        out.append("\n\n".join(x.text for x, y in zip(b, path[at:at + len(b)]) if y))
        at += len(b)
    return out


def extract(pages: DataFrame, model: crf.Crf | None = None) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    model = model or fit(rows)
    shared = pages.sparkSession.sparkContext.broadcast(model)  # a few hundred weights

    def run(batches):
        for b in bounded_batches(batches, "html", 4 << 20):
            texts = main_texts(shared.value, b.column("html").to_pylist())
            yield {"page_id": b.column("page_id"), "url": b.column("url"), "text": texts, "n_chars": [len(t) for t in texts]}

    return arrow_stream(rows, run, "page_id long, url string, text string, n_chars long")
