"""Main-text extraction by a linear-chain conditional random field over DOM leaf blocks.

A page is read once, tag by tag, into leaf blocks: runs of text that no block element divides.
Features of a block are the tags and the words in class, id and role attributes of its ancestors, its own
tag, and its text's length, link share and punctuation.  A linear-chain CRF with the labels *main* and
*other* is trained on labelled pages by gradient ascent on the conditional likelihood
(forward-backward), and each page is decoded by Viterbi.  The text is the main blocks in page order.

Labelled pages are HTML in which a block is main when an ancestor has ``data-label="main"`` nearer than any
with ``data-label="other"`` (the attribute itself is no feature).  ``html_samples`` makes the training
pages; ``train`` takes any, up to ``MAX_PAGES`` (a documented bound: the model is small).

Left out before the CRF sees a block are only comments and the content of ``script``, ``style``, ``template``, ``textarea``
and ``title``.  Text in ``math`` and ``svg`` stays in its block; ``noscript``, ``object``, ``iframe``, ``noembed`` and ``noframes``
are block elements, whose fallback text the CRF labels like any other.

Defined cases: null or empty html: no text; broken markup is read by the standard's rules (a quote opens a value only behind
``=``; unclosed comments, scripts, values and tags reach the end); very long pages are read whole, one page at a time; unknown features are ignored; repeated rows are read one by one; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import html as html_lib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeway.llm.common import Shared, slices

MAX_PAGES = 2000
#: Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What is no text of the page: code, styles, inert templates, the title of the window and what a form control holds.
SILENT = frozenset("script style template textarea title".split())
#: Elements with text for readers that cannot show what they embed.
FALLBACK = ("noscript", "object", "iframe", "noembed", "noframes")
BLOCK = frozenset(("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option p pre search "
                   "section select summary table tbody td tfoot th thead tr ul").split()) | frozenset(FALLBACK)
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
#: Elements that say nothing about the use of their text unless they have a class, id or role.
PLAIN = frozenset((*HEADINGS, *FALLBACK, *"p div li ul ol dl dt dd table tbody thead tfoot tr td th blockquote pre figure figcaption center caption hgroup".split()))
#: What an opening tag closes if it is open (up to the nearest of the second group).
CLOSES = {"li": ("li", ("ul", "ol", "menu", "dir")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)),
          "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",)), "body": ("head", ())}
_NOT_IN_P = BLOCK - {"button", "label", "select", "option", "optgroup", "legend", *FALLBACK}
#: Attributes by the standard's rules: quotes open a value only behind ``=``; anywhere else they are plain characters.
_ONE = r"(=?[^\s/>=]+|=)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s>\"'][^\s>]*)|(?=>|\Z)))?"
_MANY = r"(?:[\s/]++|(?:=?+[^\s/>=]++|=)(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+|(?=>|\Z)))?+)*+"
_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>?|</(?:>|[^A-Za-z>][^>]*>?)|<(/?)([A-Za-z][^\s/>]*)(" + _MANY + r")(?:>|\Z)", re.S)
_ATTR = re.compile(_ONE)
_KNOWN = frozenset("class id role hidden aria-hidden data-label".split())
_SCRIPT = re.compile(r"<!--|-->|<(/?)script(?=[\s/>])", re.I)
_END = re.compile(_MANY + r">?")
_WORD = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    tag: str
    path: tuple  # features of the ancestors
    linked: int  # characters inside links
    label: str | None


class _Node:
    """An open element: features of it and its ancestors, and of the nearest that says what it is for."""

    __slots__ = ("tag", "above", "near", "path", "label")

    def __init__(self, tag, above, near, label):
        self.tag, self.above, self.near, self.label = tag, above, near, label
        self.path = above + near


def _script_end(html: str, at: int) -> int | None:
    """Where the end tag of a script starts whose content starts at ``at``: inside ``<!-- <script`` an end tag
    only leaves the inner script."""
    state = 0   # 1: behind <!--, 2: in a script there
    while m := _SCRIPT.search(html, at):
        at = m.end()
        if m[0] == "-->":
            state = 0
        elif m[1] is None:
            state, at = max(state, 1), at - 2   # <!--> is closed at once
        elif not m[1]:
            state = 2 if state else 0
        elif state == 2:
            state = 1
        else:
            return m.start()
    return None


def _silent_end(html: str, tag: str, at: int) -> int:
    """The position behind the end tag of a silent element whose content starts at ``at``."""
    if tag == "script":
        start = _script_end(html, at)
    else:
        m = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
        start = m.start() if m else None
    return len(html) if start is None else _END.match(html, start + 2 + len(tag)).end()


def tokens(html: str):
    """(text before, closing, tag or None, attributes) of each tag, comment or declaration in turn; a last one
    holds the text at the end.  Silent content is left out, whatever it looks like."""
    at, foreign = 0, 0
    while m := _TOKEN.search(html, at):
        before, at, tag = html[at:m.start()], m.end(), m[2]
        if tag is None:
            yield before, False, None, ""
            continue
        tag = tag.lower()
        alone = m[3].endswith("/")
        if tag in ("svg", "math"):
            foreign = max(0, foreign - 1) if m[1] else foreign + (not alone)
        yield before, bool(m[1]), tag, m[3]
        # a slash ends an element only in svg and math
        if tag in SILENT and not m[1] and not (alone and foreign):
            at = _silent_end(html, tag, at)
    yield html[at:], False, None, ""


def blocks(html: str) -> list[Block]:
    """The leaf blocks with text, in page order."""
    out: list[Block] = []
    stack = [_Node("", (), (), None)]
    parts: list[str] = []
    linked, in_link = 0, False

    def flush():
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                node = stack[-1]
                out.append(Block(text, node.tag, node.path, linked, node.label))
            parts.clear()
        linked = 0

    def text(raw):
        nonlocal linked
        if raw:
            value = html_lib.unescape(raw) if "&" in raw else raw
            parts.append(value)
            if in_link:
                linked += len(value)

    def close(tags, until=()):
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                flush()
                del stack[k:]
                return
            if stack[k].tag in until:
                return

    for before, closing, tag, attributes in tokens(html):
        text(before)
        if tag is None:
            continue
        if closing:
            if tag == "a":
                in_link = False
            elif tag in BLOCK:
                in_link = False
                close(HEADINGS if tag in HEADINGS else (tag,))
            elif tag == "br":
                parts.append(" ")
            continue
        if tag in SILENT:
            continue
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            in_link = True
        elif tag in BLOCK:
            flush()
            in_link = False
            if tag in _NOT_IN_P:
                close(("p",), ("button", "td", "th", "table"))
            if tag in CLOSES:
                names, until = CLOSES[tag]
                close(names.split(), until)
            if tag not in VOID and not (tag in FALLBACK and attributes.rstrip().endswith("/")):
                up = stack[-1]
                feats, label = _features(tag, attributes)
                near = up.near if tag in PLAIN and len(feats) == 1 else tuple(f"near {f}" for f in feats)
                stack.append(_Node(tag, up.above + tuple(f for f in feats if f not in up.above), near, label or up.label))
    flush()
    return out


def _features(tag: str, attributes: str) -> tuple[list[str], str | None]:
    feats, label = [f"t={tag}"], None
    if attributes and "=" in attributes or "hidden" in attributes:
        for a in _ATTR.finditer(attributes):
            name, value = a[1].lower(), a[2] or a[3] or a[4] or ""
            if name not in _KNOWN:
                continue
            if name == "data-label":
                label = value
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                feats.append("hidden")
            elif name != "aria-hidden":
                feats += [f"c={w}" for w in dict.fromkeys(_WORD.findall(value.lower())) if f"c={w}" not in feats]
    return feats, label


def text_features(b: Block) -> list[str]:
    n = len(b.text)
    share = b.linked / n
    return [f"own={b.tag}", f"len={min(n, 1023).bit_length()}", f"link={0 if share < 0.2 else 1 if share < 0.7 else 2}",
            f"end={int(b.text[-1] in '.!?:;')}", f"mark={int('©' in b.text)}", "bias"]


class Crf:
    """Weights of a two-label chain; label 1 is main."""

    def __init__(self, index: dict[str, int], emit: np.ndarray, move: np.ndarray, start: np.ndarray):
        self.index, self.emit, self.move, self.start = index, emit, move, start
        self._paths: dict[tuple, np.ndarray] = {}

    def scores(self, page: list[Block]) -> np.ndarray:
        out = np.empty((len(page), 2))
        get = self.index.get
        for k, b in enumerate(page):
            known = self._paths.get(b.path)
            if known is None:
                ids = [i for f in b.path if (i := get(f)) is not None]
                known = self._paths[b.path] = self.emit[ids].sum(axis=0)
                if len(self._paths) > 20_000:
                    self._paths.clear()
            ids = [i for f in text_features(b) if (i := get(f)) is not None]
            out[k] = known + self.emit[ids].sum(axis=0)
        return out

    def decode(self, page: list[Block]) -> list[int]:
        """The labels of highest probability together (Viterbi)."""
        if not page:
            return []
        scores = self.scores(page).tolist()
        (aa, ab), (ba, bb) = self.move.tolist()
        x, y = self.start[0] + scores[0][0], self.start[1] + scores[0][1]
        back = []
        for p, q in scores[1:]:
            x0, x1, y0, y1 = x + aa, y + ba, x + ab, y + bb
            back.append((int(x1 > x0), int(y1 > y0)))
            x, y = max(x0, x1) + p, max(y0, y1) + q
        out = [int(y > x)]
        for step in reversed(back):
            out.append(step[out[-1]])
        return out[::-1]

    def extract(self, html: str) -> str:
        page = blocks(html)
        return "\n".join(b.text for b, main in zip(page, self.decode(page)) if main)


def train(pages, *, rounds: int = 80, rate: float = 0.5, l2: float = 0.005) -> Crf:
    """``pages``: labelled HTML texts, at most ``MAX_PAGES``.  Full-batch ascent with per-weight rates."""
    read = [p for p in (blocks(h) for h in list(pages)[:MAX_PAGES]) if p]
    index: dict[str, int] = {}
    ids, owner, gold, ends = [], [], [], []
    for page in read:
        for b in page:
            feats = [*b.path, *text_features(b)]
            ids += [index.setdefault(f, len(index)) for f in feats]
            owner += [len(gold)] * len(feats)
            gold.append(int(b.label == "main"))
        ends.append(len(gold))
    ids, owner, gold = np.array(ids), np.array(owner), np.array(gold)
    first = np.array([0, *ends[:-1]])
    n, width = len(gold), max(np.diff([0, *ends]))
    emit, move, start = np.zeros((len(index), 2)), np.zeros((2, 2)), np.zeros(2)
    want = np.zeros((len(index), 2))
    np.add.at(want, (ids, gold[owner]), 1.0)
    size = np.diff([0, *ends])
    # pages side by side, padded: one numpy step per position
    place = first[:, None] + np.arange(width)[None, :]
    inside = np.arange(width)[None, :] < size[:, None]
    place = np.where(inside, place, 0)
    lab = gold[place]
    pair_want = np.zeros((2, 2))
    np.add.at(pair_want, (lab[:, :-1][inside[:, 1:]], lab[:, 1:][inside[:, 1:]]), 1.0)
    start_want = np.bincount(gold[first], minlength=2).astype(float)
    seen = [np.full_like(emit, 1e-6), np.full_like(move, 1e-6), np.full_like(start, 1e-6)]
    for _ in range(rounds):
        score = np.zeros((n, 2))
        np.add.at(score, owner, emit[ids])
        s = score[place]
        up, down = np.empty((len(read), width, 2)), np.zeros((len(read), width, 2))
        up[:, 0] = start + s[:, 0]
        for k in range(1, width):
            step = np.logaddexp.reduce(up[:, k - 1, :, None] + move, axis=1) + s[:, k]
            up[:, k] = np.where(inside[:, k, None], step, up[:, k - 1])
        total = np.logaddexp.reduce(up[:, -1], axis=1)
        pair = np.zeros((2, 2))
        for k in range(width - 2, -1, -1):
            ahead = s[:, k + 1] + down[:, k + 1]
            live = inside[:, k + 1]
            down[:, k] = np.where(live[:, None], np.logaddexp.reduce(move + ahead[:, None, :], axis=2), 0.0)
            joint = np.exp(up[:, k, :, None] + move + ahead[:, None, :] - total[:, None, None])
            pair += joint[live].sum(axis=0)
        mean = np.exp(up + down - total[:, None, None])
        flat = np.zeros((n, 2))
        flat[place[inside]] = mean[inside]
        got = np.zeros_like(emit)
        np.add.at(got, ids, flat[owner])
        for w, g, acc in zip((emit, move, start), ((want - got), (pair_want - pair), (start_want - mean[:, 0].sum(axis=0))), seen):
            g = g - l2 * w * len(read) / 10
            acc += g * g
            w += rate * g / np.sqrt(acc)
    return Crf(index, emit, move, start)


def extract(pages: DataFrame, model: Crf, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: id, url, text, n_chars."""
    shared = Shared(pages.sparkSession, model)
    src = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").alias("html"))

    def run(batches):
        crf = shared.value
        for batch in slices(batches, 4 << 20):
            texts = [crf.extract(h or "") for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=["id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in src.schema}
    return src.mapInArrow(run, f"id {kinds['id']}, url {kinds['url']}, text string, n_chars long").withColumnsRenamed({"id": id_col, "url": url_col})
