"""Main text of web pages by a linear-chain conditional random field over the leaf blocks of the document tree.

A page is read once into leaf blocks: runs of text between block-level tags, with what their ancestors' tags, classes and
roles say and how the text looks. Each block is main text or not; neighbours depend on each other. The field is trained
on a bounded sample of labelled pages and decoded by Viterbi, page by page.

Labelled pages are those that mark their article up (``article`` or ``main``): what lies inside, and in nothing that is
known not to be main text, is positive. In copies of the training pages the marks are hidden or put around everything,
so that the field also learns from text, position and the other marks.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?"""
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)>?|[^<]++|<""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden|style)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.IGNORECASE)
_CLOSE = {t: re.compile(rf"</{t}\b", re.IGNORECASE) for t in ("script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes")}

# Groups of HTML's tags.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style title textarea xmp iframe noembed noframes template noscript svg math canvas object head select option datalist button".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr input".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
CLOSES_ITSELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
FOREIGN = ("svg", "math")
SCOPE = frozenset("html body table ul ol dl article section div main nav aside header footer form blockquote td th".split())

# What tags, and words in classes, ids and roles, say about their content.
HINTS = {
    "main": "article main content post entry story articlebody maincontent hentry",
    "nav": "nav navigation navbar menu menubar breadcrumb breadcrumbs pagination pager toc submenu",
    "header": "header masthead topbar banner logo branding",
    "footer": "footer contentinfo copyright legal colophon imprint",
    "side": "aside sidebar complementary widget related recommended recommendations trending popular more",
    "advert": "ad ads advert advertisement adverts adsense sponsor sponsored promo promotion commercial dfp",
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay dialog paywall disclaimer warning",
    "form": "form search login signup signin subscribe subscription newsletter input",
    "comment": "comment comments commentlist discussion reply replies respond disqus reviews feedback",
    "social": "share sharing social follow tweet like",
}
_WORD = {w: group for group, words in HINTS.items() for w in words.split()}
BOILERPLATE = frozenset(HINTS) - {"main"}
TAG_HINT = {"article": "main", "main": "main", "nav": "nav", "menu": "nav", "header": "header", "footer": "footer", "aside": "side", "form": "form", "dialog": "notice", "fieldset": "form"}
PARENTS = "p h1 h2 h3 h4 h5 h6 li td th a blockquote pre dd dt figcaption".split()
FEATURES = (
    ["always", "boilerplate", "hidden", "first", "second", "last", "copyright", "ends_sentence", "no_letter", "in_list", "in_table", "in_heading", "many_links", "some_links", "no_link"]
    + [f"hint_{h}" for h in HINTS]
    + [f"parent_{t}" for t in PARENTS]
    + [f"chars_{n}" for n in (20, 50, 100, 200, 400, 800)]
    + [f"sentences_{n}" for n in (1, 2, 4)]
)
_AT = {f: k for k, f in enumerate(FEATURES)}


class _Element:
    __slots__ = ("hidden", "hints", "silent", "tag")

    def __init__(self, tag: str, attributes: str):
        self.tag, self.silent = tag, tag in SILENT
        hints = {TAG_HINT[tag]} if tag in TAG_HINT else set()
        self.hidden = False
        if attributes and "=" in attributes:
            for name, value in _ATTRIBUTE.findall(attributes):
                name, value = name.lower(), value.strip("\"'").lower()
                if name in ("style", "aria-hidden"):
                    self.hidden |= "display:none" in value.replace(" ", "") or (name == "aria-hidden" and value == "true")
                elif tag not in ("html", "body"):
                    hints |= {_WORD[w] for w in re.split(r"[^a-z0-9]+", value) if w in _WORD}
        self.hints = hints


def blocks(page: str | None) -> list[tuple[str, set[str]]]:
    """(text, features) of the leaf blocks in page order; text with references decoded and white space made one space."""
    stack: list[_Element] = []
    open_tags: dict[str, int] = {}
    places: dict[str, list[int]] = {}  # where in the stack the elements of a tag are
    hints: dict[str, int] = {}
    out: list[list] = []
    text: list[str] = []
    linked = 0
    where: tuple = ()

    def push(e: _Element) -> None:
        places.setdefault(e.tag, []).append(len(stack))
        stack.append(e)
        open_tags[e.tag] = open_tags.get(e.tag, 0) + 1
        for h in e.hints:
            hints[h] = hints.get(h, 0) + 1
        for flag in ("silent", "hidden"):
            if getattr(e, flag):
                hints[flag] = hints.get(flag, 0) + 1

    def pop() -> _Element:
        e = stack.pop()
        places[e.tag].pop()
        open_tags[e.tag] -= 1
        for h in [*e.hints, *(f for f in ("silent", "hidden") if getattr(e, f))]:
            hints[h] -= 1
        return e

    def flush() -> None:
        nonlocal text, linked, where
        joined = " ".join("".join(text).split())
        if joined:
            out.append([joined, linked, *where])
        text, linked, where = [], 0, ()

    at, page = 0, page or ""
    while at < len(page):
        m = _TOKEN.match(page, at)
        at = m.end()
        tag = m["tag"]
        if tag is None:
            run = m.group()
            if run[:2] in ("<!", "<?") or hints.get("silent"):
                continue
            run = html.unescape(run) if "&" in run else run
            if not text or not where:
                near = next((e.tag for e in reversed(stack) if e.tag not in INLINE or e.tag == "a"), "body")
                where = (near, {h for h, n in hints.items() if n > 0}, {t for t in ("li", "table", "h1", "h2", "h3", "h4") if open_tags.get(t)})
            text.append(run)
            if open_tags.get("a"):
                linked += len(run.strip())
            continue
        tag = tag.lower()
        if tag not in INLINE:
            flush()
        elif tag == "br":
            text.append(" ")
        if m["end"]:
            if open_tags.get(tag):
                while pop().tag != tag:
                    pass
            continue
        if tag in VOID:
            continue
        gone = {"p"} if tag in CLOSES_P else CLOSES_ITSELF.get(tag)
        if gone:
            innermost = lambda tags: max((places[t][-1] for t in tags if places.get(t)), default=-1)
            k = innermost(gone)
            if k >= 0 and k > innermost(SCOPE - gone):
                while len(stack) > k:
                    pop()
        # only drawings and formulas have elements that close themselves by a slash
        if m["attributes"].endswith("/") and (tag in FOREIGN or any(open_tags.get(t) for t in FOREIGN)):
            continue
        push(_Element(tag, m["attributes"]))
        if tag in _CLOSE:
            end = _CLOSE[tag].search(page, at)
            at = end.start() if end else len(page)
    flush()
    return [(b[0], _features(b, k, len(out))) for k, b in enumerate(out)]


def _features(block: list, k: int, n: int) -> set[str]:
    text, linked, parent, hints, inside = block
    size = len(text)
    found = {"always", f"parent_{parent}", *(f"hint_{h}" for h in hints if h in HINTS)}
    if hints & BOILERPLATE:
        found.add("boilerplate")
    if "hidden" in hints:
        found.add("hidden")
    found |= {"first"} if k == 0 else {"second"} if k == 1 else set()
    found |= {"last"} if k == n - 1 else set()
    if "©" in text or "copyright" in text.lower():
        found.add("copyright")
    if text[-1] in ".!?…。！？\"”»":
        found.add("ends_sentence")
    if not any(c.isalpha() for c in text):
        found.add("no_letter")
    found |= {"in_list"} if "li" in inside else set()
    found |= {"in_table"} if "table" in inside else set()
    found |= {"in_heading"} if inside & {"h1", "h2", "h3", "h4"} else set()
    found.add("many_links" if linked > 0.6 * size else "some_links" if linked > 0 else "no_link")
    found |= {f"chars_{c}" for c in (20, 50, 100, 200, 400, 800) if size >= c}
    sentences = len(re.findall(r"[.!?。](?:\s|$)", text))
    found |= {f"sentences_{c}" for c in (1, 2, 4) if sentences >= c}
    return found


def _matrix(features: list[set[str]]) -> np.ndarray:
    x = np.zeros((len(features), len(FEATURES)), np.float32)
    for k, found in enumerate(features):
        x[k, [_AT[f] for f in found if f in _AT]] = 1
    return x


class Field:
    """A linear chain of two labels: a weight per feature and label, and one per pair of neighbouring labels."""

    def __init__(self, emission: np.ndarray, transition: np.ndarray):
        self.emission, self.transition = emission, transition

    def decode(self, x: np.ndarray) -> list[bool]:
        """The most likely labels of a page's blocks, by Viterbi."""
        if not len(x):
            return []
        (t00, t01), (t10, t11) = self.transition.tolist()
        scores = (x @ self.emission).tolist()
        a, b = scores[0]
        back = []
        for c, d in scores[1:]:
            from_0, from_1 = b + t10 > a + t00, b + t11 >= a + t01
            a, b = c + (b + t10 if from_0 else a + t00), d + (b + t11 if from_1 else a + t01)
            back.append((from_0, from_1))
        label = b >= a
        out = [label]
        for from_0, from_1 in reversed(back):
            label = from_1 if label else from_0
            out.append(label)
        return out[::-1]


def _gradient(x, y, mask, emission, transition):
    """Gradient of the log-likelihood of padded pages, by forward and backward sums."""
    n, length, _ = x.shape
    scores = x @ emission
    add = lambda v, axis: np.logaddexp.reduce(v, axis=axis)
    forward, backward = np.zeros((n, length, 2)), np.zeros((n, length, 2))
    forward[:, 0] = scores[:, 0]
    for t in range(1, length):
        new = add(forward[:, t - 1, :, None] + transition, 1) + scores[:, t]
        forward[:, t] = np.where(mask[:, t, None], new, forward[:, t - 1])
    for t in range(length - 2, -1, -1):
        new = add(transition + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
        backward[:, t] = np.where(mask[:, t + 1, None], new, backward[:, t + 1])
    total = add(forward[:, -1], 1)
    marginal = np.exp(forward + backward - total[:, None, None]) * mask[:, :, None]
    observed = np.eye(2)[y] * mask[:, :, None]
    d_emission = np.einsum("ntf,ntk->fk", x, observed - marginal)
    pair = np.exp(forward[:, :-1, :, None] + transition + (scores[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None])
    both = observed[:, :-1, :, None] * observed[:, 1:, None, :]
    return d_emission, ((both - pair) * mask[:, 1:, None, None]).sum((0, 1))


def _padded(examples: list) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Features, labels and masks of whole pages; pages of like length (up to the same power of two) are padded together."""
    groups: dict[int, list] = {}
    for example in examples:
        groups.setdefault(max(8, 1 << (len(example[1]) - 1).bit_length()), []).append(example)
    out = []
    for length, some in groups.items():
        x = np.zeros((len(some), length, len(FEATURES)), np.float32)
        y, mask = np.zeros((len(some), length), int), np.zeros((len(some), length), bool)
        for k, (found, labels) in enumerate(some):
            x[k, : len(found)], y[k, : len(found)], mask[k, : len(found)] = _matrix(found), labels, True
        out.append((x, y, mask))
    return out


def fit(pages: list[list[tuple[str, set[str]]]], steps: int = 120, ridge: float = 0.5) -> Field:
    """Train on whole pages that mark their article up; each also with the marks hidden and with a mark around everything."""
    examples = []
    for page in pages:
        found = [f for _, f in page]
        labels = ["hint_main" in f and "boilerplate" not in f for f in found]
        if not any(labels) or all(labels):
            continue
        hidden = [f - {"hint_main"} for f in found]
        bare = [f - {"hint_main", "boilerplate", *(f"hint_{h}" for h in HINTS)} for f in found]
        around = [f | {"hint_main"} for f in found]
        examples += [(v, labels) for v in (found, hidden, bare, around)]
    if not examples:  # no labelled page: what the marks say, and long texts with few links
        emission = np.zeros((len(FEATURES), 2))
        for name, weight in {"boilerplate": -6, "hint_main": 3, "no_link": 0.5, "chars_100": 2, "many_links": -3, "hidden": -4, "copyright": -3, "parent_p": 1, "always": -1.5}.items():
            emission[_AT[name], 1] = weight
        return Field(emission, np.array([[0.3, 0.0], [0.0, 0.3]]))
    batches = _padded(examples)
    emission, transition = np.zeros((len(FEATURES), 2)), np.zeros((2, 2))
    # weights of marks that the sample lacks start from what the groups mean, and move only with evidence
    for h in BOILERPLATE:
        emission[_AT[f"hint_{h}"], 1] = -2.0
    emission[_AT["boilerplate"], 1], emission[_AT["hidden"], 1] = -6.0, -6.0
    prior = emission.copy()
    m = [np.zeros_like(emission), np.zeros_like(transition)]
    v = [np.zeros_like(emission), np.zeros_like(transition)]
    for step in range(1, steps + 1):
        parts = [_gradient(*batch, emission, transition) for batch in batches]
        g = (sum(p[0] for p in parts) - ridge * (emission - prior), sum(p[1] for p in parts) - ridge * transition)
        for k, weights in enumerate((emission, transition)):
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
            weights += 0.1 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    return Field(emission, transition)


def main_text(page: str | None, field: Field) -> str:
    found = blocks(page)
    keep = field.decode(_matrix([f for _, f in found]))
    return "\n".join(t for (t, _), k in zip(found, keep, strict=True) if k)


def train(pages: DataFrame, sample: int = 150, id_column: str = "page_id", html_column: str = "html") -> Field:
    """Fit on at most ``sample`` labelled pages, the ones with the smallest hashes of their identifiers."""
    marked = pages.where(F.col(html_column).rlike("(?i)<(article|main)[ >]")).select(F.col(id_column).alias("i"), F.col(html_column).alias("h"))
    # identifiers first, so that tasks send no pages they need not
    chosen = marked.where("i IS NOT NULL").select("i").distinct().orderBy(F.xxhash64("i"), "i").limit(sample)
    return fit([blocks(r["h"]) for r in marked.join(F.broadcast(chosen), "i").select("h").limit(sample).collect()])


def extract(pages: DataFrame, field: Field, html_column: str = "html", text_column: str = "text") -> DataFrame:
    """pages without their html, with the main text; a null or empty page has an empty text. One row per input row."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(h, field) for h in part[html_column].to_pylist()]
                kept = [c for c in part.schema.names if c not in (html_column, text_column)]
                yield pa.RecordBatch.from_arrays([*(part[c] for c in kept), pa.array(texts, pa.string())], names=[*kept, text_column])

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields if f.name not in (html_column, text_column)]
    return pages.mapInArrow(run, ", ".join([*kept, f"`{text_column}` string"]))
