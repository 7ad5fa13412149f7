"""HTML extraction by maximum-scoring subsequence.

A page is read as a row of tokens. Words score positive and tags negative, with weights from labelled pages; a linear
scan finds the contiguous run of tokens with the greatest sum, and the text in it is the result.

Weights. `labelled_pages` makes pages whose content is known (from templates, by a fixed seed, at most `most` pages).
From them: the log odds that words under an element lie in the content, by the element's name and by the words of its
class, id and role, added up; one table from elements inside articles, one from all, as many names of parts mean
little inside an article. Elements whose odds are low (navigation, footers, notices, adverts, forms, comments...) are one
negative token each, whatever they hold; an article whose class says comment is one, too. The odds of words by where they
stand (inside an article, outside one on a page that has one, on a page without) and of tags give the other tokens' scores.
Inside an article tags and parts cost nothing, so no list of links in it is left out, nor what follows one.
"""

from __future__ import annotations

import html as _html
import math
import random
import re
from collections import Counter
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML: names of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg select button xmp noembed noframes object canvas audio video".split())
MAIN = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark math mi mn mo mrow ms msub msup mtext nobr q s samp small span strike strong sub sup time tt u var wbr img br font picture source".split())

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTR = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPLIT = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"\S+")
_SPACES = re.compile(r"\s+")


def tokens(page: str):
    """('text', text), ('open', name, attributes) or ('close', name), in order; comments and raw elements' contents are left out.

    Time is linear in the page: every search goes forward from where the last one ended.
    """
    at, n = 0, len(page)
    lower = page.lower() if len(page.lower()) == n else "".join(c.lower() if c.isascii() else c for c in page)
    no_comment_end = False
    missing: set[str] = set()
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            yield ("text", page[at:])
            return
        if lt > at:
            yield ("text", page[at:lt])
        if page.startswith("<!--", lt):
            end = -1 if no_comment_end else page.find("-->", lt + 4)
            no_comment_end = end < 0
            if end < 0:
                return  # an open comment runs to the end
            at = end + 3
            continue
        close = page.startswith("</", lt)
        m = _NAME.match(page, lt + 1 + close)
        if not m:
            if page[lt + 1 : lt + 2] in ("!", "?", "/"):
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
            else:  # a bare < is text
                yield ("text", "<")
                at = lt + 1
            continue
        end = m.end()
        while end < n and page[end] != ">":  # quoted values may hold >
            q = page[end]
            if q in "\"'" and page[end - 1] == "=":
                to = page.find(q, end + 1)
                if to < 0:
                    end = page.find(">", end)
                    end = n if end < 0 else end
                    break
                end = to + 1
            else:
                end += 1
        name = m.group().lower()
        at = min(end + 1, n)
        if close:
            yield ("close", name)
            continue
        yield ("open", name, page[m.end() : end])
        if name in RAW and not page[m.end() : end].endswith("/"):
            stop = -1 if name in missing else lower.find("</" + name, at)
            if stop < 0:
                missing.add(name)
                if name in ("script", "style", "textarea", "title"):
                    return
                continue
            at = stop


def features(name: str, attributes: str) -> list[str]:
    """An element's name, the words of its class, id and role, and the last word of each one that is a single name."""
    out = ["<" + name]
    for m in _ATTR.finditer(attributes):
        value = (m.group(2) or m.group(3) or m.group(4) or "").strip()
        words = [w.lower() for w in _SPLIT.split(value) if w]
        out += ["." + w for w in words]
        if words and not _SPACES.search(value):
            out.append(("heading=" if name in HEADINGS else "=") + words[-1])
    return out


# What labelled pages name their parts.
PART_NAMES = {
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs toolbar pager pagination skip",
    "aside": "sidebar aside related widget recommended trending popular tags toc",
    "div": "ad ads advert advertisement adsense sponsor sponsored promo promotion banner cookie cookies consent notice alert popup modal overlay newsletter subscribe signup share sharing social login copyright disclaimer legal",
    "footer": "footer foot bottom credits",
    "header": "header masthead top logo topbar",
    "form": "form search contact register feedback",
    "section": "comments comment reply replies discussion disqus respond reviews",
}
CONTENT_NAMES = "content article post entry story body text main page container wrapper column lead intro row inner"
INNER_PARTS = "nav menu breadcrumbs pager sidebar aside ad ads advert advertisement adsense sponsored promo cookie cookies newsletter subscribe signup share sharing comments comment reply replies respond disqus form"
QUALIFIERS = "site page main global my"
WRAPPER_NAMES = "page wrapper site layout with has no container outer wrap col row grid main left right body"


def labelled_pages(most: int = 800, seed: int = 11) -> list[tuple[str, str]]:
    """(html, content html) of made pages; content stands between two marks, once or in pieces with parts in between."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("aeioubcdlmnprst") for _ in range(r.randrange(2, 9)))
    text = lambda a, b: " ".join(word() for _ in range(r.randrange(a, b)))
    menu = lambda: "<ul>" + "".join(f'<li><a href="/{word()}">{text(1, 3)}</a></li>' for _ in range(r.randrange(2, 9))) + "</ul>"

    def part(tag):
        name = r.choice(PART_NAMES[tag].split())
        shown = tag if r.random() < 0.6 else r.choice(("div", "section", "ul")) if tag != "form" else "form"
        if r.random() < 0.3:
            name = f'{r.choice(QUALIFIERS.split())}{r.choice("-_")}{name}'
        attr = f' {r.choice(("class", "id"))}="{name}"' if shown != tag or r.random() < 0.7 or tag == "div" else ""
        inner = {"nav": menu, "form": lambda: f"<label>{text(1, 4)}</label><input name=q><button>{word()}</button>"}.get(tag, lambda: r.choice((menu, lambda: f"<p>{text(3, 40)}</p>", lambda: text(2, 30)))())()
        return f"<{shown}{attr}>{inner}</{shown}>"

    parts = sorted({x for names in PART_NAMES.values() for x in names.split()})

    plain = sorted(set(parts) - set(INNER_PARTS.split()))  # names of parts that blocks of an article have as well

    def heading(level, words):
        k = r.random()
        attr = "" if k < 0.5 else f' id="{word()}"' if k < 0.75 else f' {r.choice(("class", "id"))}="{r.choice(plain)}"'
        return f"<{level}{attr}>{words}</{level}>"

    def linked(words):  # with links around some of the words
        out = words.split()
        for _ in range(r.randrange(1, 4)):
            i = r.randrange(len(out))
            j = min(len(out), i + r.randrange(1, 6))
            if not any("<" in x for x in out[i:j]):
                out[i:j] = [f'<a href="/{word()}">{" ".join(out[i:j])}</a>']
        return " ".join(out)

    def inner_part():  # what an article holds that is not its text
        tag, name = r.choice(("nav", "aside", "form", "footer", "div", "section", "ul", "article")), r.choice(INNER_PARTS.split())
        if tag == "article":
            name = r.choice(("comment", "reply"))
        attr = "" if tag in ("nav", "aside", "form", "footer") and r.random() < 0.6 else f' {r.choice(("class", "id"))}="{name}"'
        return f"\x03<{tag}{attr}>{r.choice((menu(), f'<p>{text(3, 40)}</p>', text(2, 30)))}</{tag}>\x02"

    def grouped(pieces, named):  # in sections, or in wrappers whose names are mixed
        out = []
        while pieces:
            n = r.randrange(1, 6)
            some = "".join(pieces[:n])
            k = r.random()
            names = " ".join(r.sample(WRAPPER_NAMES.split(), 2))
            mixed = r.choice((names, names.replace(" ", "-"), f"{names} {r.choice(named)}"))
            out.append(some if k < 0.5 else f"<section>{some}</section>" if k < 0.75 else f'<section class="{r.choice(CONTENT_NAMES.split())}">{some}</section>' if k < 0.9 else f'<div class="{mixed}">{some}</div>')
            pieces = pieces[n:]
        return "".join(out)

    def content(article):
        out = [heading("h1", text(1, 9))] if r.random() < 0.8 else []
        for _ in range(r.randrange(1, 14)):
            k = r.random()
            p = text(1, 90)
            out.append(f"<p>{p}</p>" if k < 0.6 else f"<p><b>{text(1, 9)}</b> {p}<br>{text(1, 20)}</p>" if k < 0.7 else heading(r.choice(("h2", "h3")), text(1, 6)) if k < 0.78 else f"<ul><li>{text(2, 20)}</li><li>{text(2, 20)}</li></ul>" if k < 0.84 else f"<p>{linked(text(8, 60))} <em>{word()}</em></p>" if k < 0.93 else f"<blockquote><p>{p}</p></blockquote>")
            if article and r.random() < 0.15:
                out[-1] = f'<div class="{r.choice(plain)}">{out[-1]}</div>'
            if article and r.random() < 0.25:
                out.append(inner_part())
        if article and r.random() < 0.2:
            out[0] = f"<header>{out[0]}</header>"
        return grouped(out, plain if article else parts) if r.random() < 0.5 else "".join(out)

    pages = []
    for _ in range(most):
        kind = r.random()
        inner = content(kind < 0.7)
        holder = "article" if kind < 0.55 else "main" if kind < 0.7 else "section" if kind < 0.8 else "div"
        attr = f' class="{r.choice(CONTENT_NAMES.split())}"' if holder == "div" or r.random() < 0.3 else ""
        first = part(r.choice(("nav", "div"))) if holder in MAIN and r.random() < 0.2 else ""
        last = part(r.choice(("aside", "div", "section", "footer"))) if holder in MAIN and r.random() < 0.4 else ""
        before = [part(r.choice(("nav", "header", "div", "aside", "form"))) for _ in range(r.randrange(0, 4))]
        after = [part(r.choice(("aside", "footer", "div", "section", "form"))) for _ in range(r.randrange(0, 4))]
        if r.random() < 0.3:
            before.append(f"<div>{text(1, 12)}</div>")
        if r.random() < 0.3:
            after.insert(0, f"<div>{text(1, 12)}</div>")
        pages.append((f"<html><head><title>{text(1, 6)}</title></head><body>{''.join(before)}<{holder}{attr}>{first}\x02{inner}\x03{last}</{holder}>{''.join(after)}</body></html>", re.sub("\x03[^\x02]*\x02", "", inner)))
    return pages


class Weights:
    """Scores of elements, words and tags from labelled pages."""

    def __init__(self, pages: list[tuple[str, str]] | None = None):
        counts = {place: (Counter(), Counter()) for place in (True, False)}  # inside articles, anywhere: words in the content and beside it
        words_in, words_out, tags_in, tags_out = Counter(), Counter(), Counter(), Counter()
        for page, _ in pages if pages is not None else labelled_pages():
            content, stack, has_main = False, [], any(f"<{m}" in page for m in MAIN)
            for t in tokens(page):
                if t[0] == "text":
                    for piece in re.split("([\x02\x03])", t[1]):
                        if piece in ("\x02", "\x03"):
                            content = piece == "\x02"
                            continue
                        n = len(_WORD.findall(piece))
                        main = max((k for k, s in enumerate(stack) if s[0] in MAIN), default=-1)
                        for under_main, some in ((True, stack[main + 1 :] if main >= 0 else []), (False, [s for k, s in enumerate(stack) if k > main >= 0 and s[0] != "header" or main < 0 or k <= main])):  # an article's header is not a page's
                            for f in {f for s in some for f in s[1]}:
                                counts[under_main][not content][f] += n
                        place = self.place(has_main, any(s[0] in MAIN for s in stack))
                        (words_in if content else words_out)[place] += n
                    continue
                (tags_in if content else tags_out)[t[1]] += 1
                if t[0] == "open" and t[1] not in VOID:
                    known = features(t[1], t[2])
                    # an article inside another is judged by what its class says, as any element there
                    stack.append(("in-" + t[1] if t[1] in MAIN and any(s[0] in MAIN for s in stack) else t[1], known[1:] if t[1] in MAIN else known))
                elif t[0] == "close":
                    for k in range(len(stack) - 1, -1, -1):
                        if stack[k][0].removeprefix("in-") == t[1]:
                            del stack[k:]
                            break
        self.element = {place: {f: math.log((a[f] + 1) / (b[f] + 1)) for f in a.keys() | b.keys()} for place, (a, b) in counts.items()}
        self.prior = {False: math.log((sum(words_in.values()) + 1) / (sum(words_out.values()) + 1)), True: math.log((words_in["main"] + 1) / (words_out["main"] + 1))}
        self.word = {k: math.log((words_in[k] + 1) / (words_out[k] + 1)) for k in ("main", "beside", "none")}
        self.tag = {k: min(-0.02, max(-3.0, math.log((tags_in[k] + 1) / (tags_out[k] + 1)))) for k in tags_in.keys() | tags_out.keys()}

    @staticmethod
    def place(has_main: bool, inside: bool) -> str:
        return "main" if inside else "beside" if has_main else "none"

    def odds(self, name: str, attributes: str, main: bool = False) -> float:
        """Log odds that words under an element are content: the prior, and what each known feature adds to it.

        main: the element stands inside an article. Elements that hold a whole page or article have 0, but for articles
        whose class says more.
        """
        if name in ("html", "body"):
            return 0.0
        table, prior = self.element[main], self.prior[main]
        known = [table[f] for f in features(name, attributes)[1 if name in MAIN else 0 :] if f in table]
        return prior + sum(x - prior for x in known) if known else 0.0

    def is_part(self, name: str, attributes: str, main: bool = False) -> bool:
        """Whether an element is one that does not hold content."""
        if name in MAIN:
            table = self.element[True]
            return any(table.get(f, 0.0) < -2 for f in features(name, attributes)[1:])
        return name in RAW or name == "head" or self.odds(name, attributes, main) < -2


def extract(page: str | None, weights: Weights) -> str:
    """Main text of a page: blocks joined by two line feeds, white space in a block as one space."""
    if not page:
        return ""
    read: list[tuple] = []  # (score, None at a block's edge, '' or ' ' at an inline tag), or (words, text, inside an article, odds)
    skip, depth, main = "", 0, 0
    under: list[tuple[str, float]] = []  # open elements, and the least odds of each and those around it
    opened: Counter = Counter()
    has_main = False
    for t in tokens(page):
        kind = t[0]
        if skip:
            if kind == "open" and t[1] in MAIN and not main and not weights.is_part(t[1], t[2]):
                skip = ""  # content begins: what was open before is taken as closed
            elif kind != "text" and t[1] == skip:
                depth += 1 if kind == "open" else -1
                if depth == 0:
                    skip = ""
                continue
            else:
                continue
        if kind == "text":
            text = _html.unescape(t[1])
            n = len(_WORD.findall(text))
            read.append((n, text, main > 0, under[-1][1] if under else 0.0))
            continue
        name = t[1]
        if kind == "open" and weights.is_part(name, t[2], main > 0):
            # scripts, buttons and the like stand anywhere, so they say nothing of where the content ends
            read.append((0.0 if main else -0.02 if name in RAW else weights.tag.get(name, -1.0), None if name not in INLINE else " "))
            if name not in VOID and not t[2].endswith("/"):
                skip, depth = name, 1
            continue
        if name in MAIN:
            main = max(0, main + (1 if kind == "open" else -1))
            has_main = has_main or main > 0
        if kind == "close":
            while opened[name]:  # what was left open inside it is closed with it
                last = under.pop()[0]
                opened[last] -= 1
                if last == name:
                    break
        elif name not in VOID and not t[2].endswith("/"):
            odds = 0.0 if main else weights.odds(name, t[2])
            under.append((name, 0.0 if main else min(under[-1][1] if under else 0.0, odds)))
            opened[name] += 1
        # an article holds its text and parts, which are cut: its other tags, lists of links too, cost nothing
        read.append((0.0 if main or name in MAIN else weights.tag.get(name, -0.5), (" " if name in ("br", "wbr") else "") if name in INLINE else None))
    scored: list[tuple[float, str | None]] = []
    for x in read:
        if len(x) == 2:
            scored.append(x)
            continue
        n, text, inside, odds = x
        # between the articles of a run, what stands beside them costs its words and is not read
        scored.append((n * (weights.word[weights.place(has_main, inside)] + odds), text if inside or not has_main else ""))
    best, total, begin, region = 0.0, 0.0, 0, (0, 0)
    for i, (score, _) in enumerate(scored):
        if total <= 0:
            total, begin = 0.0, i
        total += score
        if total > best:
            best, region = total, (begin, i + 1)
    blocks, now = [], []
    for _, text in [*scored[slice(*region)], (0, None)]:
        if text is None:
            block = _SPACES.sub(" ", "".join(now)).strip()
            if block:
                blocks.append(block)
            now = []
        else:
            now.append(text)
    return "\n\n".join(blocks)


@lru_cache
def trained() -> Weights:
    """The weights of the labelled pages, fitted once a session: the same pages give the same weights."""
    return Weights()


def _pages(weights):
    def run(batches):
        import pyarrow as pa

        w = weights.value
        for b in batches:
            for i in range(0, len(b), 64):
                part = b.slice(i, 64)
                out = [extract(x, w) for x in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return run


def main_text(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """One row for each page: page_id, url, text, n_chars (code points).

    Null or empty html, and pages without content, have text ''. Character references are decoded; broken or cut markup
    is read as far as it goes. Several articles, and articles in articles, are read in page order, without what stands
    between them, if the best run holds them; of runs with equal sums the first stands. Very long pages take linear time. Repeated pages and null ids give a
    row each. Empty tables give no rows; further columns are ignored.
    """
    w = pages.sparkSession.sparkContext.broadcast(weights or trained())
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return p.mapInArrow(_pages(w), "page_id long, url string, text string, n_chars long")
