"""Main text of web pages by a linear-chain conditional random field over leaf blocks."""

from __future__ import annotations

import html
import math
import re
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)",
    re.S,
)
_MARK = re.compile(r"(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_MARK_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: Elements whose content is no markup, and those that hold no text of the page.
_RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
_UNSEEN = {"head", "template", "noscript", "svg", "annotation", "annotation-xml", "object", "audio", "video", "canvas"}
#: Of these, those that a block's opening tag ends.
_BROKEN_OFF = {"head", "svg", "annotation", "annotation-xml"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = set(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol optgroup option p pre search section select summary table caption tbody td tfoot th thead tr ul".split()
)
#: An opening tag ends open ones of these, up to the nearest of the others.
_IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}),
}


@dataclass
class Block:
    """A run of text between block boundaries."""

    text: str
    path: tuple  # ((tag, (mark word, ...)), ...), outermost first
    linked: int  # characters inside links


def _marks(attrs: str) -> tuple[str, ...]:
    if "=" not in attrs:
        return ()
    found = []
    for a, b, c in _MARK.findall(attrs):
        found += _MARK_WORD.findall(_CAMEL.sub(" ", a or b or c).lower())
    return tuple(dict.fromkeys(found))


def _tokens(page: str) -> list[tuple[int, int, str, bool, str]]:
    """(start, end, name, whether it closes, attributes) of a page's tags and comments (name: empty).

    A raw element is one token, from its opening to its closing tag. A script
    or style that is not closed goes to the page's end; of the others without a
    closing tag only the opening one is taken.
    """
    out, at, ends = [], 0, {}
    while m := _TAG.search(page, at):
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        closing = bool(m["end"] or m["end2"])
        if name in _RAW and not closing and ends.get(name, at) is not None:
            found = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            ends[name] = found and found.end()
            at = found.end() if found else len(page) if name in ("script", "style") else at
        out.append((m.start(), at, name, closing, m["attrs"] or m["attrs2"] or ""))
    return out


def _hidden(tokens: list[tuple[int, int, str, bool, str]]) -> dict[int, tuple[int, int]]:
    """Of opening tags of unseen elements (by number), the next token that is seen and the place from which text is.

    An element ends with its own closing tag. One whose parent is closed
    before, or that is never closed, hides nothing: what follows it is text of
    the page. Some are also ended by a block's opening tag.
    """
    out: dict[int, tuple[int, int]] = {}
    if not any(name in _UNSEEN for _, _, name, _, _ in tokens):
        return out
    stack: list[tuple[str, int]] = []
    depth: dict[str, int] = {}

    def pop() -> tuple[str, int]:
        name, k = stack.pop()
        depth[name] -= 1
        return name, k

    for k, (start, end, name, closing, attrs) in enumerate(tokens):
        if name not in _UNSEEN and name not in _BLOCK or name in _VOID:
            continue
        if closing:
            if depth.get(name):
                while (last := pop())[0] != name:
                    pass
                if name in _UNSEEN:
                    out[last[1]] = k + 1, end
            continue
        if name in _BLOCK and name != "html":
            while stack and stack[-1][0] in _BROKEN_OFF:
                out[pop()[1]] = k, start
        if not attrs.rstrip().endswith("/"):
            stack.append((name, k))
            depth[name] = depth.get(name, 0) + 1
    return out


def leaf_blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page in order.

    Character references are decoded, white space is turned into one space.
    Unclosed and misnested tags end where a browser would end the block; see
    ``_hidden`` for those of elements without text. Formulas keep their text.
    """
    out: list[Block] = []
    stack: list[tuple[str, tuple]] = []
    text: list[str] = []
    linked, links = 0, 0
    page = page or ""

    def said(run: str) -> None:
        nonlocal linked
        if run:
            run = html.unescape(run) if "&" in run else run
            text.append(run)
            if links:
                linked += len(run.strip())

    def flush() -> None:
        nonlocal linked
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                out.append(Block(joined, tuple(stack), linked))
            text.clear()
        linked = 0

    def close(names: set[str], until: set[str]) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                del stack[k:]
                return close(names, until)
            if stack[k][0] in until:
                return None
        return None

    tokens = _tokens(page)
    hidden = _hidden(tokens)
    at, k = 0, 0
    while k < len(tokens):
        start, end, name, closing, attrs = tokens[k]
        said(page[at:start])
        at = end
        if k in hidden:
            k, at = hidden[k]
            continue
        k += 1
        if not name:
            if page.startswith("<![CDATA[", start):
                text.append(page[start + 9 : end - 3])
            continue
        if closing:
            if name == "a":
                links = max(0, links - 1)
            elif name in _BLOCK:
                flush()
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == name:
                        del stack[i:]
                        links = 0
                        break
                    if name in ("p", "li", "dd", "dt") and stack[i][0] in ("div", "article", "section", "main", "td", "body", "ul", "ol", "dl"):
                        break
            continue
        if name == "br":
            text.append("\n")
        elif name == "a":
            links = 1
        elif name in _BLOCK:
            flush()
            if name in _IMPLIED:
                close(*_IMPLIED[name])
            if name not in ("label", "button", "option", "optgroup", "html", "body"):
                close({"p"}, {"div", "article", "section", "main", "td", "th", "li", "aside", "button", "table"})
                if name[0] == "h" and name[1:].isdigit() and stack and stack[-1][0][0] == "h" and stack[-1][0][1:].isdigit():
                    stack.pop()
            if name not in _VOID:
                stack.append((name, _marks(attrs)))
    said(page[at:])
    flush()
    return out


@lru_cache(maxsize=65536)
def _path_features(path: tuple) -> tuple[str, ...]:
    tags = [t for t, _ in path if t not in ("html", "body")]
    found = {f"t:{t}" for t in tags}
    for depth, (t, marks) in enumerate(path):
        for w in marks:
            found.add(f"m:{w}")
            if depth == len(path) - 1:
                found.add(f"o:{w}")
        if marks and t not in ("p", "html", "body"):
            found.add("marked")
    found.add(f"p:{tags[-1] if tags else 'none'}")
    if len(tags) > 1:
        found.add(f"pp:{tags[-2]}>{tags[-1]}")
    # the nearest landmark decides more than those around it
    near = next((t for t in reversed(tags) if t in ("article", "main", "nav", "aside", "header", "footer", "form", "section")), "none")
    found.add(f"near:{near}")
    return tuple(sorted(found))


def features(blocks: list[Block]) -> list[tuple[str, ...]]:
    """Ancestor-tag and text features of each block."""
    out = []
    for b in blocks:
        n = len(b.text)
        words = b.text.count(" ") + 1
        size = min(7, int(math.log2(words)))
        share = b.linked / n
        link = 0 if share < 0.05 else 1 if share < 0.4 else 2 if share < 0.85 else 3
        ends = b.text[-1] in ".!?…\"'”»)"
        inside = any(t in ("article", "main") for t, _ in b.path)
        own = [f"n:{size}", f"l:{link}", f"e:{ends}", f"nl:{size // 2},{link}", f"in:{inside},{size // 3},{link // 2}"]
        if "©" in b.text or "(c)" in b.text:
            own.append("copyright")
        if "," in b.text:
            own.append("comma")
        if "|" in b.text or "›" in b.text or "»" in b.text:
            own.append("bars")
        out.append((*_path_features(b.path), *own, "bias"))
    return out


@dataclass
class Crf:
    """Two states, 0 boilerplate and 1 main text."""

    weights: dict[str, float] = field(default_factory=dict)
    move: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))  # from, to
    start: np.ndarray = field(default_factory=lambda: np.zeros(2))

    @classmethod
    def fit(cls, pages: list[tuple[list[tuple[str, ...]], list[int]]], rounds: int = 250, pull: float = 0.02) -> Crf:
        """Maximum penalised likelihood by forward-backward gradients and Adam."""
        names = {f: i for i, f in enumerate(sorted({f for fs, _ in pages for block in fs for f in block}))}
        longest, n = max(len(y) for _, y in pages), len(pages)
        row, col = [], []
        mask, truth = np.zeros((n, longest), bool), np.zeros((n, longest), int)
        for i, (fs, y) in enumerate(pages):
            mask[i, : len(y)], truth[i, : len(y)] = True, y
            for t, block in enumerate(fs):
                row += [i * longest + t] * len(block)
                col += [names[f] for f in block]
        row, col = np.array(row), np.array(col)
        k = len(names)
        x = np.zeros(k + 6)
        m, v = np.zeros_like(x), np.zeros_like(x)
        pairs = mask[:, 1:]
        seen = np.zeros((2, 2))
        np.add.at(seen, (truth[:, :-1][pairs], truth[:, 1:][pairs]), 1)
        begun = np.bincount(truth[:, 0], minlength=2)
        lse = lambda a, axis: np.logaddexp.reduce(a, axis=axis)
        for step in range(1, rounds + 1):
            own = np.bincount(row, weights=x[col], minlength=n * longest).reshape(n, longest)
            score = np.stack([np.zeros_like(own), own], axis=2)
            move, start = x[k : k + 4].reshape(2, 2), x[k + 4 :]
            alpha, beta = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
            alpha[:, 0] = start + score[:, 0]
            for t in range(1, longest):
                a = lse(alpha[:, t - 1, :, None] + move, 1) + score[:, t]
                alpha[:, t] = np.where(mask[:, t, None], a, alpha[:, t - 1])
            for t in range(longest - 2, -1, -1):
                b = lse(move + (score[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
                beta[:, t] = np.where(mask[:, t + 1, None], b, 0)
            z = lse(alpha[:, -1], 1)
            p = np.exp(alpha + beta - z[:, None, None])[:, :, 1] * mask
            both = np.exp(alpha[:, :-1, :, None] + move + (score[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None]) * pairs[:, :, None, None]
            g = np.concatenate([np.bincount(col, weights=(truth * mask - p).ravel()[row], minlength=k), (seen - both.sum((0, 1))).ravel(), begun - np.array([(1 - p[:, 0]).sum(), p[:, 0].sum()])]) / n
            g -= pull / n * x * 10
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            x += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        return cls({f: float(x[i]) for f, i in names.items()}, x[k : k + 4].reshape(2, 2).copy(), x[k + 4 :].copy())

    def decode(self, blocks: list[tuple[str, ...]]) -> list[int]:
        """The likeliest states, by Viterbi."""
        if not blocks:
            return []
        get, back = self.weights.get, []
        (m00, m01), (m10, m11) = self.move.tolist()
        s0, s1 = self.start.tolist()
        for t, block in enumerate(blocks):
            own = sum([get(f, 0.0) for f in block])
            if t:
                a, b = s0 + m00 >= s1 + m10, s0 + m01 > s1 + m11
                s0, s1 = (s0 + m00 if a else s1 + m10), (s0 + m01 if b else s1 + m11) + own
                back.append((0 if a else 1, 0 if b else 1))
            else:
                s1 += own
        state = int(s1 > s0)
        out = [state]
        for step in reversed(back):
            state = step[state]
            out.append(state)
        return out[::-1]


@lru_cache(maxsize=4)
def trained(pages: int = 500, seed: int = 11) -> Crf:
    """The model of ``pages`` labelled training pages (see html_training)."""
    from newsloom.llm.html_training import labelled_pages

    return Crf.fit([(features(blocks), labels) for blocks, labels in labelled_pages(pages, seed)])


def main_text(page: str | None, model: Crf) -> str:
    """Main blocks joined by an empty line."""
    blocks = leaf_blocks(page)
    return "\n\n".join(b.text for b, y in zip(blocks, model.decode(features(blocks)), strict=True) if y)


def extract_main_text(pages: DataFrame, model: Crf | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page id, url, text and n_chars (code points) of every page.

    The model (a few hundred weights) is trained once on the driver and sent
    with the function; pages are parsed and decoded where they are, without a
    shuffle. Null or empty html: an empty text. Pages of any length are read
    whole. Null ids and repeated rows stay; other columns are ignored.
    """
    model = model or trained()
    rows = pages.select(pages[id_col].alias("_id"), pages[url_col].alias("_url"), pages[html_col].cast("string").alias("_html"))
    kinds = dict(rows.dtypes)

    def run(batches):
        import pyarrow as pa

        from newsloom.llm import kernels as K

        for batch in batches:
            for part in K.slices(batch, "_html", 4_000_000):
                text = [main_text(page, model) for page in part.column("_html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("_url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    return rows.mapInArrow(run, f"`{id_col}` {kinds['_id']}, `{url_col}` {kinds['_url']}, text string, n_chars long")
