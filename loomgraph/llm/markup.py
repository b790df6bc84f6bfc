"""Markup residue: blocks labelled by a recurrent network, then written as clean text.

A text is a sequence of leaves, its non-blank lines (long ones in parts), each with a path (the
tags, fences, environments and tables open around it) and a bag of hashed words and signs. A sign
is read with what stands beside it, with the counterpart that closes it and with its place in the
line. A bidirectional LSTM in numpy reads the whole sequence, so every leaf is labelled with the
context of its document: which markup it holds (HTML, Markdown, wiki, LaTeX) and what it is
(paragraph, heading, list, table, code, formula, quote, rule). The network is trained by
``markup_train`` on texts that it writes itself; its weights are a file beside this one. A text
holds the kinds that the network names on any of its leaves, and the clean text is written from
the labels: nothing else decides.

Before the network the JVM sets aside texts without any sign from which markup can be made;
these hold none by definition.

Defined results: null and empty texts have no blocks and stay as they are; a text without markup
comes out unchanged; repeated rows are labelled alike; whole texts are read, of any length.
Columns other than those named are ignored.
"""

from __future__ import annotations

import html
import re
import zlib
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import map_rows, spread

KINDS = ("html", "markdown", "wiki", "latex")
LABELS = ("text", "heading", "list", "table", "code", "formula", "quote", "rule")
#: Words have the first buckets, signs the others, paths come last.
WORD_BUCKETS, BUCKETS, PATH_BUCKETS = 512, 4096, 512
#: Longer lines are several leaves of the same line number, parted where no sign is open.
MAX_LEAF = 240
#: A text without any of these holds no markup of the four kinds.
SIGNS = r"[<>&*_`\[\]{}|\\$~]|''|(?:^|\n)[ \t]*[-+#=:;]"
#: Probability from which a leaf is taken to hold a kind.
THRESHOLD = 0.5

# ---- leaves -----------------------------------------------------------------------------------
_TOKEN = re.compile(r"&#?\w{1,8};|</?[A-Za-z][\w-]*|<!--|-->|\\[A-Za-z]+\*?|\\.|([^\w\s]|_)\1*|[^\W_]+(?:_+[^\W_]+)*")
_OPEN = re.compile(r"<(?P<end>/)?(?P<tag>[A-Za-z][\w-]*)[^<>]*?(?P<self>/)?>|\\(?P<be>begin|end)\{(?P<env>\w+\*?)\}|(?P<fence>^\s*(?:```|~~~))|(?P<wt>^\s*\{\|)|(?P<we>^\s*\|\})")
_VOID = {"br", "hr", "img", "input", "meta", "link"}
_TWINS = frozenset(["*", "**", "***", "_", "__", "~~", "`", "``", "$", "$$", "''", "'''", "'''''"])
_CLOSES = {"]": "[", "]]": "[[", "}": "{", "}}": "{{"}
_EXACT = frozenset("{}[]()|<>=\\$*_`'~#:")
_SURE = frozenset("*_`$~|\\<>[]{}&#'=")


@lru_cache(maxsize=200_000)
def _bucket(token: str) -> int:
    h = zlib.crc32(token.encode())
    return h % WORD_BUCKETS if token[:2] == "w:" else WORD_BUCKETS + h % (BUCKETS - WORD_BUCKETS)


@lru_cache(maxsize=20_000)
def _path_bucket(path: str) -> int:
    return BUCKETS + zlib.crc32(path.encode()) % PATH_BUCKETS


def _class(c: str) -> str:
    return "s" if not c or c.isspace() else "a" if c.isalpha() else "0" if c.isdigit() else c if c in _EXACT else "p"


def _content(s: str) -> str:
    """What stands between a sign and its counterpart: formula, address, number, several fields, words."""
    return "m" if re.search(r"[\\^_={}]", s) else "u" if "://" in s else "0" if re.fullmatch(r"[\d\s.,/%-]+", s) else "|" if "|" in s else "w"


def signs(line: str) -> list[tuple[int, int, str]]:
    """(start, end, feature) of the words and signs of a line, and of signs with their counterparts."""
    out: list[tuple[int, int, str]] = []
    twins: dict[str, int] = {}
    nested: list[tuple[str, int]] = []
    n = len(line)
    first, pipes = True, 0
    for m in _TOKEN.finditer(line):
        t, (s, e) = m[0], m.span()
        c = t[0]
        if c.isalnum():
            out.append((s, e, "w:0" if c.isdigit() else "s:snake" if "_" in t else "w:" + t.lower()))
            first = False
            continue
        left = "^" if first else _class(line[s - 1 : s])
        right = "$" if e == n else _class(line[e : e + 1])
        sign = t.lower() if len(t) < 3 or c in "<\\&" else c * 3
        out.append((s, e, f"s:{left}{sign}{right}"))
        if c in "<\\&" and len(t) > 1:
            out.append((s, e, "t:" + sign.strip("</")))
            if c == "<" and t != "<!--":
                end = line.find(">", e)
                out.append((s, e if end < 0 else end + 1, "tag:" + ("open" if end < 0 or "<" in line[e:end] else "shut")))
            if c == "\\":
                out.append((s, e, "cmd:" + left + ("a" if t[1].isalpha() else t[1]) + right))
        if first:
            rest = line[e:].strip()
            follows = "n" if re.fullmatch(r"[-+]?\d[\d.,]*\s*[-–]*", rest) else _class(rest[:1])
            out.append((s, e, f"lead:{sign}{right}{follows}"))
            if not re.search(r"\w", line):
                out.append((s, n, "only:" + "".join(sorted(set(line.strip())))[:8] + ("" if len(line.strip()) < 3 else "+")))
            first = False
        if c == "|":
            pipes += len(t)
        if t in _TWINS:
            opens, shuts = right not in "s$" and (left not in "a0" or c in "`'"), left not in "s^" and (right not in "a0" or c in "`'")
            if shuts and t in twins:
                at = twins.pop(t)
                out.append((at, e, f"pair:{t}:{_content(line[at + len(t) : s])}"))
            elif opens:
                twins[t] = s
        elif c in "[{" and len(t) < 3:
            nested.append((t, s))
        elif t in _CLOSES or c in "]}" and len(t) == 3:
            want = _CLOSES.get(t, _CLOSES[t[:2]] if len(t) == 3 else "")
            while nested and nested[-1][0] != want:
                nested.pop()
            if nested:
                at = nested.pop()[1]
                out.append((at, e, f"pair:{want}:{_content(line[at + len(want) : s])}:{right if right in '({[' else ''}"))
        if c in _SURE and e == n:
            out.append((s, e, f"tail:{left}{sign}"))
    if pipes:
        out.append((line.find("|"), line.find("|") + 1, f"pipes:{min(pipes, 3)}"))
    return out


def leaves(text: str) -> list[tuple[int, int, str, tuple[str, ...], list[int]]]:
    """(line number from 1, start in the line, line or part of it, path, features) of every line that is not blank."""
    out, stack = [], []
    for i, raw in enumerate(text.split("\n")):
        line = raw.rstrip()
        if not line.strip():
            continue
        path = tuple(stack[-6:])
        found = signs(line)
        parts = _parts(line, found)
        fixed = [_path_bucket("/".join(path)), *([_path_bucket("top:" + path[-1])] if path else [])]
        k = 0
        found.sort(key=lambda x: x[0])
        for s, e in parts:
            bag, words = set(), []
            while k < len(found) and found[k][0] < e:
                f = found[k][2]
                (words.append if f[0] == "w" else bag.add)(_bucket(f))
                k += 1
            bag.add(_bucket(f"size:{(e - s) // 60 if e - s < 180 else 3}{'' if len(parts) == 1 else 'p'}"))
            out.append((i + 1, s, line[s:e], path, [*words, *bag, *fixed]))
        if not ("<" in line or "\\" in line or "`" in line or "~" in line or "|" in line):
            continue
        for m in _OPEN.finditer(line):
            if m["fence"]:
                if stack and stack[-1] == "fence":
                    stack.pop()
                else:
                    stack.append("fence")
            elif m["tag"]:
                tag = m["tag"].lower()
                if m["end"]:
                    if tag in stack:
                        del stack[len(stack) - 1 - stack[::-1].index(tag) :]
                elif not m["self"] and tag not in _VOID:
                    stack.append(tag)
            elif m["be"]:
                env = "env:" + m["env"]
                if m["be"] == "begin":
                    stack.append(env)
                elif env in stack:
                    del stack[len(stack) - 1 - stack[::-1].index(env) :]
            elif m["wt"]:
                stack.append("wikitable")
            elif m["we"] and "wikitable" in stack:
                del stack[len(stack) - 1 - stack[::-1].index("wikitable") :]
    return out


def _parts(line: str, found: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Parts of at most ``MAX_LEAF`` signs, parted behind a sentence, else at a blank, outside what a sign and its counterpart enclose."""
    n = len(line)
    if n <= MAX_LEAF:
        return [(0, n)]
    shut = sorted((s, e) for s, e, f in found if f[:4] in ("pair", "tag:") and e - s <= MAX_LEAF // 2)
    out, start = [], 0
    while n - start > MAX_LEAF:
        low, high = start + MAX_LEAF // 2, start + MAX_LEAF
        cut = line.rfind(". ", low, high) + 1 or line.rfind(" ", low, high)
        if cut <= low:
            cut = high
        for s, e in shut:
            if s < cut < e and s > start:
                cut = s
        out.append((start, cut))
        start = cut
    return [*out, (start, n)]


def weigh(bags: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All buckets in a row, their weights, and the bags' sizes. A sign counts whole however long its
    leaf is; words share one weight."""
    sizes = np.fromiter(map(len, bags), int, len(bags))
    flat = np.fromiter((x for b in bags for x in b), int, int(sizes.sum()))
    word = flat < WORD_BUCKETS
    owner = np.repeat(np.arange(len(bags)), sizes)
    n = np.bincount(owner[word], minlength=len(bags))
    weight = np.ones(len(flat), "f4")
    weight[word] = (0.5 / np.sqrt(np.maximum(n, 1)))[owner[word]]
    return flat, weight, sizes


# ---- network ----------------------------------------------------------------------------------
class BiLSTM:
    """Embedding bag, one LSTM each way, kinds by sigmoid and label by softmax; plain numpy.

    Embeddings start next to nothing, so a sign that training never met says nothing.
    """

    def __init__(self, params: dict[str, np.ndarray]):
        self.p = params

    @staticmethod
    def fresh(embed: int = 24, hidden: int = 20, seed: int = 0) -> BiLSTM:
        r = np.random.default_rng(seed)
        g = lambda *s: (r.normal(size=s) / np.sqrt(s[0])).astype("f4")
        p = {"emb": (r.normal(size=(BUCKETS + PATH_BUCKETS, embed)) * 0.01).astype("f4"), "out": g(2 * hidden + embed, len(KINDS) + len(LABELS)), "ob": np.zeros(len(KINDS) + len(LABELS), "f4")}
        for d in "fb":
            p |= {f"wx{d}": g(embed, 4 * hidden), f"wh{d}": g(hidden, 4 * hidden), f"b{d}": np.zeros(4 * hidden, "f4")}
            p[f"b{d}"][hidden : 2 * hidden] = 1
        return BiLSTM(p)

    @staticmethod
    def load(path: Path | None = None) -> BiLSTM:
        with np.load(path or Path(__file__).with_name("markup_model.npz")) as z:
            return BiLSTM({k: z[k].astype("f4") for k in z.files})

    def save(self, path: Path) -> None:
        np.savez_compressed(path, **{k: v.astype("f2") for k, v in self.p.items()})

    def embed(self, bags: list[list[int]]) -> np.ndarray:
        flat, weight, sizes = weigh(bags)
        starts = np.r_[0, np.cumsum(sizes)[:-1]]
        return np.tanh(np.add.reduceat(self.p["emb"][flat] * weight[:, None], starts, axis=0))

    def direction(self, x: np.ndarray, mask: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """Hidden states, time first: x is (T, B, E), mask (T, B). Backwards for d == 'b'."""
        p, (steps, batch, _) = self.p, x.shape
        hid = p[f"wh{d}"].shape[0]
        h, c = np.zeros((batch, hid), "f4"), np.zeros((batch, hid), "f4")
        gates = x @ p[f"wx{d}"] + p[f"b{d}"]
        out = np.zeros((steps, batch, hid), "f4")
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = gates[t] + h @ p[f"wh{d}"]
            s = 1 / (1 + np.exp(-z[:, : 3 * hid]))
            i, f, o, g = s[:, :hid], s[:, hid : 2 * hid], s[:, 2 * hid :], np.tanh(z[:, 3 * hid :])
            m = mask[t][:, None]
            c2 = f * c + i * g
            tc = np.tanh(c2)
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, tc, m))
            h, c = m * (o * tc) + (1 - m) * h, m * c2 + (1 - m) * c
            out[t] = h
        return out

    def scores(self, docs: list[list[list[int]]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(probability of each kind, label number) for the leaves of each document."""
        result: list = [None] * len(docs)
        order = sorted((i for i, d in enumerate(docs) if d), key=lambda i: len(docs[i]))
        at = 0
        while at < len(order):
            longest = len(docs[order[min(at + 255, len(order) - 1)]])
            take = order[at : at + max(1, min(256, 40_000 // max(1, longest)))]
            at += len(take)
            steps = len(docs[take[-1]])
            x = np.zeros((steps, len(take), self.p["emb"].shape[1]), "f4")
            mask = np.zeros((steps, len(take)), "f4")
            e = self.embed([bag for i in take for bag in docs[i]])
            k = 0
            for j, i in enumerate(take):
                n = len(docs[i])
                x[:n, j], mask[:n, j] = e[k : k + n], 1
                k += n
            z = np.concatenate([self.direction(x, mask, "f"), self.direction(x, mask, "b"), x], axis=2) @ self.p["out"] + self.p["ob"]
            kinds, labels = 1 / (1 + np.exp(-z[:, :, : len(KINDS)])), z[:, :, len(KINDS) :].argmax(2)
            for j, i in enumerate(take):
                n = len(docs[i])
                result[i] = (kinds[:n, j], labels[:n, j])
        empty = (np.zeros((0, len(KINDS))), np.zeros(0, int))
        return [r if r is not None else empty for r in result]


_MODEL: BiLSTM | None = None


def model() -> BiLSTM:
    """The trained network, read once a process."""
    global _MODEL
    if _MODEL is None:
        _MODEL = BiLSTM.load()
    return _MODEL


# ---- kinds and labels of a corpus --------------------------------------------------------------
def _read(texts: list[str]) -> list[tuple[list, np.ndarray, np.ndarray]]:
    parsed = [leaves(t) for t in texts]
    scored = model().scores([[leaf[4] for leaf in p] for p in parsed])
    return [(p, k, lab) for p, (k, lab) in zip(parsed, scored, strict=True)]


def _signed(docs: DataFrame, doc: str, text: str) -> DataFrame:
    return docs.select(F.col(doc).alias("doc"), F.col(text).alias("t")).filter(F.col("t").rlike(SIGNS))


def found(docs: DataFrame, doc: str = "chunk_id", text: str = "text") -> DataFrame:
    """Distinct (doc, kind): kinds of markup that the network names on a leaf of the text."""

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for d, (_, probs, _) in zip(pdf["doc"], _read(list(pdf["t"])), strict=True):
            if len(probs):
                rows += [(d, k) for k, p in zip(KINDS, probs.max(0), strict=True) if p >= THRESHOLD]
        return pd.DataFrame(rows, columns=["doc", "kind"])

    return map_rows(spread(_signed(docs, doc, text)), fn, "doc string, kind string").distinct()


def blocks(docs: DataFrame, doc: str = "chunk_id", text: str = "text") -> DataFrame:
    """(doc, line_no, start, label, kinds) of every leaf of the texts that hold signs of markup; ``start`` counts from 1 in the line."""

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for d, (parsed, probs, labels) in zip(pdf["doc"], _read(list(pdf["t"])), strict=True):
            for leaf, p, lab in zip(parsed, probs, labels, strict=True):
                rows.append((d, leaf[0], leaf[1] + 1, LABELS[lab], [k for k, x in zip(KINDS, p, strict=True) if x >= THRESHOLD]))
        return pd.DataFrame(rows, columns=["doc", "line_no", "start", "label", "kinds"])

    return map_rows(_signed(docs, doc, text), fn, "doc string, line_no int, start int, label string, kinds array<string>").distinct()


# ---- clean text -------------------------------------------------------------------------------
_I = re.IGNORECASE | re.DOTALL
_SECTIONS = ["part", "chapter", "section", "subsection", "subsubsection", "paragraph", "subparagraph"]
_HEAD = {
    "html": re.compile(r"<h([1-6])\b[^>]*>", re.IGNORECASE),
    "markdown": re.compile(r"^[ \t]*(#{1,6})[ \t]+"),
    "wiki": re.compile(r"^[ \t]*(={2,6})(?=[^=])"),
    "latex": re.compile(rf"\\({'|'.join(_SECTIONS)})\b"),
}
_LINK = {
    "html": [(re.compile(r"<!--.*?-->|<(script|style)\b.*?</\1\s*>", _I), ""), (re.compile(r"<br\s*/?>|</(?:p|div|section|article)\s*>", re.IGNORECASE), "\n"), (re.compile(r"</?[a-z][\w-]*(?:\s[^<>]*)?/?>|<!doctype[^>]*>|<!--|-->", re.IGNORECASE), "")],
    "markdown": [(re.compile(r"!?\[([^\[\]\n]*)\]\((?:[^()\n]|\([^()\n]*\))*\)"), r"\1"), (re.compile(r"(?<![*\w\\])(\*{1,3})(?=[^\s*])([^*\n]*?)(?<=[^\s*\\])\1(?![*\w])"), r"\2"), (re.compile(r"(?<![\w_])(_{1,2})(?=[^\s_])([^\n]*?)(?<=[^\s_])\1(?![\w_])"), r"\2"), (re.compile(r"~~(?=\S)([^~\n]*?)~~"), r"\1"), (re.compile(r"(?<!`)(`{1,2})([^`\n]+)\1(?!`)"), r"\2")],
    "wiki": [(re.compile(r"\[\[(?:Category|File|Image):[^\[\]]*\]\]|__[A-Z]{3,}__|<ref\b[^>]*?/>|<ref\b.*?</ref>", _I), ""), (re.compile(r"\[\[(?:[^\[\]|\n]*\|)?([^\[\]|\n]*)\]\]"), r"\1"), (re.compile(r"\{\{(?:[^{}\n]|\{\{[^{}]*\}\})*\}\}"), ""), (re.compile(r"\[(?:https?|ftp)://\S+?[ \t]+([^\]\n]+)\]"), r"\1"), (re.compile(r"'{2,5}(?=\S)(.+?)(?<=\S)'{2,5}"), r"\1")],
    "latex": [(re.compile(r"\\(?:label|cite\w?|footnotemark)\*?(?:\[[^\]]*\])?\{[^{}]*\}|\\(?:maketitle|centering|noindent|hline)\b"), ""), (re.compile(r"~?\\(?:eq|page)?ref\{([^{}]*)\}"), r" \1"), *[(re.compile(r"\\(?:text\w\w|emph|underline|footnote|caption|title|author)\{([^{}]*)\}"), r"\1")] * 3, (re.compile(r"\\([%&#_{}$])"), r"\1"), (re.compile(r"(?<=\S)~(?=\s|$)|~(?=[A-Z(])"), " ")],
}
_MATH = re.compile(r"(?<![\w$\\])\$(?=[^\s$])[^$\n]*[^\s\\]\$(?![\w$])")


def _plain(t: str, kinds: set[str]) -> str:
    """Signs inside a line taken away, formulas kept."""
    held: list[str] = []

    def keep(m: re.Match) -> str:
        held.append(m[0])
        return f"\x00{len(held) - 1}\x00"

    if "latex" in kinds:
        t = _MATH.sub(keep, t)
    for kind in ("wiki", "latex", "html", "markdown"):
        if kind in kinds:
            for rx, by in _LINK[kind]:
                t = rx.sub(by, t)
    if "html" in kinds:
        t = html.unescape(t).replace("\u00a0", " ")
    return re.sub(r"\x00(\d+)\x00", lambda m: held[int(m[1])] if int(m[1]) < len(held) else m[0], t)


def _heading(lines: list[str], kinds: set[str]) -> list[str]:
    out: list[str] = []
    for line in lines:
        under = re.fullmatch(r"[ \t]*(=|-)\1{2,}[ \t]*", line)
        if under:
            if out:
                out[-1] = f"{'#' if under[1] == '=' else '##'} {out[-1].lstrip('# ')}"
            continue
        level, bare = 0, line
        for kind, rx in _HEAD.items():
            if kind in kinds and (m := rx.search(line)):
                level = int(m[1]) if kind == "html" else max(1, _SECTIONS.index(m[1]) - 1) if kind == "latex" else len(m[1])
                if kind == "wiki":
                    bare = line.strip().strip("=")
                elif kind == "markdown":
                    bare = line[m.end() :].rstrip("# \t")
                elif kind == "latex":
                    bare = re.sub(rf"\\(?:{'|'.join(_SECTIONS)})\*?\{{([^{{}}]*)\}}", r"\1", line)
                break
        bare = _plain(bare, kinds).strip()
        if bare:
            out.append(f"{'#' * min(level, 6)} {bare}" if level else bare)
    return out


def _listed(lines: list[str], kinds: set[str]) -> list[str]:
    out: list[str] = []
    for line in lines:
        item = re.match(r"[ \t]*(?:<li\b[^>]*>|\\item\b(?:\[[^\]]*\])?|[-+*](?=[ \t])|;)[ \t]*", line, re.IGNORECASE)
        if out and re.match(r"[ \t]*:", line) and "wiki" in kinds:
            out[-1] += ": " + _plain(line.strip()[1:], kinds).strip()
            continue
        bare = _plain(re.sub(r"\\(?:begin|end)\{[^{}]*\}(?:\[[^\]]*\])?", "", line[item.end() :] if item else line), kinds).strip()
        if bare:
            inset = re.match(r"[ \t]*", line)[0] if "markdown" in kinds else ""
            out.append(f"{inset}- {bare}" if item else bare)
    return out


def _cells(lines: list[str], kinds: set[str]) -> list[str]:
    t = "\n".join(lines)
    rows: list[list[str]] = []
    if re.search(r"<t[rdh]\b", t, re.IGNORECASE):
        for row in re.split(r"</tr\s*>|<tr\b[^>]*>", t, flags=re.IGNORECASE):
            rows.append(re.split(r"</t[dh]\s*>\s*<t[dh]\b[^>]*>|<t[dh]\b[^>]*>", re.sub(r"</t[dh]\s*>\s*$|^\s*<t[dh]\b[^>]*>", "", row.strip(), flags=re.IGNORECASE), flags=re.IGNORECASE))
    else:
        for line in lines:
            bare = re.sub(r"\\(?:begin|end)\{[^{}]*\}(?:\{[^{}]*\})?|\\hline|\\\\", "", line).strip()
            if not bare or re.fullmatch(r"[ \t|:+-]*-[ \t|:+-]*|\{\|.*|\|\}|\|[-+].*", bare):
                continue
            rows.append(re.split(r"\|\||!!", bare.lstrip("|!")) if "wiki" in kinds else re.split(r"(?<!\\)&", bare) if "latex" in kinds else bare.strip("|").split("|"))
    plain = [[_plain(c, kinds).strip() for c in r] for r in rows]
    return ["| " + " | ".join(r) + " |" for r in plain if any(r)]


def _coded(lines: list[str]) -> list[str]:
    t = "\n".join(lines)
    inner = re.sub(r"^[ \t]*(?:```|~~~)[^\n]*\n?|\n?[ \t]*(?:```|~~~)[ \t]*$|^\s*\\begin\{\w+\*?\}[^\n]*\n?|\n?\s*\\end\{\w+\*?\}[ \t]*$", "", t)
    if re.search(r"</?(?:pre|code)\b", inner, re.IGNORECASE):
        inner = html.unescape(re.sub(r"</?(?:pre|code)\b[^>]*>", "", inner, flags=re.IGNORECASE))
    return ["```", *inner.strip("\n").split("\n"), "```"]


def _formula(lines: list[str]) -> list[str]:
    t = re.sub(r"\\(?:begin|end)\{\w+\*?\}|\\label\{[^{}]*\}|^\s*(?:\\\[|\$\$)|(?:\\\]|\$\$)\s*$", "", "\n".join(lines))
    return [f"$${t.strip()}$$"] if t.strip() else []


def clean_text(text: str, parsed: list, probs: np.ndarray, labels: np.ndarray) -> str:
    """The text without the markup that the network named; lines without any stay as they are.

    Neighbouring lines of one label are one block: headings become ``#`` lines, items ``-`` lines,
    tables rows of ``|``, code stands between fences and formulas between ``$$``; quotes lose
    their sign and rules go.
    """
    if not len(probs) or probs.max() < THRESHOLD:
        return text
    lines = text.split("\n")
    named: dict[int, tuple[int, set[str]]] = {}
    for leaf, p, lab in zip(parsed, probs, labels, strict=True):
        old = named.get(leaf[0], (int(lab), set()))
        named[leaf[0]] = (old[0], old[1] | {k for k, x in zip(KINDS, p, strict=True) if x >= THRESHOLD})
    out: list[str] = []
    n = 1
    while n <= len(lines):
        lab, kinds = named.get(n, (0, set()))
        if not kinds:
            out.append(lines[n - 1])
            n += 1
            continue
        end, label = n, LABELS[lab]
        if label != "text":
            while end < len(lines):
                nxt = next((m for m in range(end + 1, len(lines) + 1) if m in named), None) if label == "code" else end + 1
                if nxt is None or nxt not in named or named[nxt][0] != lab or not (named[nxt][1] or label == "code"):
                    break
                kinds, end = kinds | named[nxt][1], nxt
        block = [line.rstrip("\r") for line in lines[n - 1 : end]]
        if label == "heading":
            if len(block) > 1 or not re.fullmatch(r"[ \t]*(=|-)\1{2,}[ \t]*", block[0]) or not out:
                out += _heading(block, kinds)
            else:
                out[-1] = _heading([out[-1], block[0]], kinds)[-1]
        elif label == "list":
            out += _listed(block, kinds)
        elif label == "table":
            out += _cells(block, kinds)
        elif label == "code":
            out += _coded(block)
        elif label == "formula":
            out += _formula(block)
        elif label == "quote":
            out += [_plain(re.sub(r"^[ \t]{0,3}>[ \t]?", "", x), kinds) for x in block]
        elif label == "text":
            out += [re.sub(r"[ \t]+$", "", _plain(x, kinds)).strip("\n") for x in block]
        n = end + 1
    return re.sub(r"\n{3,}", "\n\n", "\n".join(out)).strip("\n")


def clean(docs: DataFrame, doc: str = "chunk_id", text: str = "text") -> DataFrame:
    """(doc, text) of every row, repeated rows once: marked-up texts cleaned, all others as they were."""
    pairs = docs.select(F.col(doc).alias("doc"), F.col(text).alias("t"), F.coalesce(F.col(text).rlike(SIGNS), F.lit(False)).alias("signed"))

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        texts = list(pdf["t"])
        at = [i for i, signed in enumerate(pdf["signed"]) if signed]
        for i, (parsed, probs, labels) in zip(at, _read([texts[i] for i in at]), strict=True):
            texts[i] = clean_text(texts[i], parsed, probs, labels)
        return pd.DataFrame({"doc": pdf["doc"], "text": texts})

    return map_rows(spread(pairs), fn, "doc string, text string").distinct()
