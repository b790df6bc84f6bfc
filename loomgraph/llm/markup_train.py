"""Training of the block labeller on texts written here: python -m loomgraph.llm.markup_train [out.npz]

Sentences of made-up words, with signs that format nothing strewn in between (prices, comparisons,
paths, footnote marks, page numbers, broken and misread scanned lines), are dressed in the four
kinds of markup. Each dressed stretch is marked while it is written, so every leaf knows its kinds
and its label. Training is back-propagation through time with Adam, in numpy, from a fixed seed.
"""

from __future__ import annotations

import random
import re
import sys
from pathlib import Path

import numpy as np

from loomgraph.llm.markup import BUCKETS, KINDS, LABELS, THRESHOLD, WORD_BUCKETS, BiLSTM, leaves, weigh

_SYL = "ba ce di fo gu ha je ki lo mu na pe qui ro su ta ve wi xo yu zan ter mon lin gar sel dor fen hol mar".split()
_COMMON = "the of and in to a was by for with from at as on after under before data water plant team site report order section table rate page value figure note index load annual public city year total result see".split()
_A, _Z = "\x01", "\x02"


def _m(s: str) -> str:
    """A stretch that is markup."""
    return _A + s + _Z


class Writer:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        r = self.r
        w = r.choice(_COMMON) if r.random() < 0.5 else "".join(r.choices(_SYL, k=r.randint(1, 4)))
        if r.random() < 0.04:
            w += r.choice(["é", "ñ", "ü", "₂", "₂.₅", "è"])
        return w.capitalize() if r.random() < 0.15 else w.upper() if r.random() < 0.02 else w

    def words(self, a: int = 1, b: int = 3) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(a, b)))

    def num(self) -> str:
        r = self.r
        return r.choice([str(r.randint(0, 99)), f"{r.randint(1, 99)}.{r.randint(0, 9)}", f"{r.randint(1, 99)},{r.randint(100, 999)}", str(r.randint(1900, 2040))])

    def token(self) -> str:
        """A word of prose with the signs that prose has."""
        r, w, n = self.r, self.word, self.num
        return r.choice(
            [
                lambda: f"{w()}-{w()}", lambda: f"{w()}-{w()}-{w()}", lambda: f"{n()}%", lambda: f"{n()}%,", lambda: f"({w()} {w()})", lambda: f"\"{w()} {w()}\"", lambda: f"'{w()} {w()}'", lambda: f"“{w()} {w()}”", lambda: f"{w()}'s", lambda: f"{w()}s'", lambda: f"{w()}/{w()}", lambda: f"{n()}/{n()}", lambda: f"{n()} mg/L", lambda: f"{w()};", lambda: f"{w()}:", lambda: f"{w()} –", lambda: f"{w()} —", lambda: f"{n()}–{n()}", lambda: f"{n()}-{n()}",
                lambda: f"No. {n()}", lambda: f"{w()}?", lambda: f"{w()}!", lambda: f"{w()}...", lambda: f"{w()[0]}.{w()[0]}.", lambda: f"© {n()}", lambda: f"§ {n()}", lambda: f"{n()}°C", lambda: f"{w()} & {w()}", lambda: f"{w()[0].upper()}&{w()[0].upper()}", lambda: f"+{n()}", lambda: f"-{n()}", lambda: f"~{n()}", lambda: f"±{n()}", lambda: f"€{n()}", lambda: f"${n()}", lambda: f"#{n()}", lambda: f"{w()}@{w()}.example", lambda: f"www.{w()}.example", lambda: f"https://{w()}.example/{w()}-{w()}?{w()}={n()}", lambda: f"({n()})", lambda: f"({w()[0]})",
            ]
        )()

    def decoy(self) -> str:
        """Signs of the four kinds in use for something else; no sign here has its counterpart."""
        r, n, w = self.r, self.num, self.word
        lone = r.choice("*_`~|^#+=@{}[]")
        return r.choice(
            [
                lambda: f"{w()} {w()} < {n()} and > {n()} {w()} {w()}.", lambda: f"{w()} <{n()} or >{n()} {w()}", lambda: f"{n()} < {w()[0]} < {n()}", lambda: f"if {w()[0]} == {n()} the {w()} stops.", lambda: f"{w()} != {n()}", lambda: f"{w()} <= {n()} >= {n()}", lambda: f"{w()} -> {w()}", lambda: f"{w()} => {w()}",
                lambda: f"{w()} {w()} from ${n()} {w()} to ${n()} {w()}.", lambda: f"it cost ${n()}.", lambda: f"US${n()}, {n()}$ or {w()}", lambda: f"{w()} ${n()}/{n()} {w()}",
                lambda: f"{w()} {w()} * {w()} {w()} (*{w()} {w()}).", lambda: f"{w()}* and {w()}** {w()}", lambda: f"* {n()}, {w()} * {w()}", lambda: f"{n()} x {n()} {w()}; {n()} * {n()} {w()}.", lambda: f"*{w()} {w()}", lambda: f"{w()}†, {w()}‡",
                lambda: f"{w()} C:\\{w().lower()}\\{w().lower()}_{n()} {w()}.", lambda: f"\\\\{w().lower()}\\{w().lower()}\\{w().lower()}.doc", lambda: f"D:\\{w()}\\{w()}.{w()[:3]}", lambda: f"/{w().lower()}/{w().lower()}_{w().lower()}/x.csv", lambda: f"~/{w().lower()}/{w().lower()}", lambda: f"{w()}\\{w()}",
                lambda: f"{w()} {{a, b, c}} {w()} {w().lower()}_{n()}_{w().lower()}.", lambda: f"{{{w()}}}", lambda: f"{w()}_{w()}_{w()}", lambda: f"{w()}_{n()} and {w()}_{n()}", lambda: f"_{w()} {w()}", lambda: f"{w()[0]}_{n()}",
                lambda: f"~{n()} {w()} {w()}.", lambda: f"-{n()} {w()} {w()}.", lambda: f"+{n()} {w()}", lambda: f"> {n()} {w()}", lambda: f"< {n()} {w()}", lambda: f"#{n()} {w()}", lambda: f"= {n()} {w()}", lambda: f"#{w()} {w()}", lambda: f"{w()} #{n()} {w()}.", lambda: f"{w()} 10^{n()} {w()}.", lambda: f"{w()} = {n()}", lambda: f"{w()} == {n()}",
                lambda: f"{w()} [{n()}] {w()}.", lambda: f"{w()} \"{w()}\" [sic] {w()} {n()}.", lambda: f"[{w()} {w()}]", lambda: f"[{w()}] ({w()})", lambda: f"{w()} [{n()}, {n()}]", lambda: f"[{n()}]", lambda: f"({w()[0]}) {w()} {n()} {w()}", lambda: f"{n()}. {w()} {w()}", lambda: f"{n()}) {w()} {w()}", lambda: f"{w()[0]}. {w()} {w()}", lambda: f"• {w()} {w()}", lambda: f"– {w()} {w()}",
                lambda: f"{w()} {lone} {w()}", lambda: f"{w()}{lone if lone not in '_' else '+'}{w()}", lambda: f"{w()} {lone}{w()} {w()}", lambda: f"{w()}{lone} {w()}", lambda: f"{w()} | {w()}", lambda: f"{w()}|{w()}", lambda: f"{w()}: {n()} | {w()}: {n()}", lambda: f"a/b; {n()}%", lambda: f"{w()} 'n' {w()}", lambda: f"{w()} ''{w()}", lambda: f"{w()} `{w()}", lambda: f"{n()}''", lambda: f"{n()}' {n()}''",
                lambda: f"{w()}; {w()}: {w()}", lambda: f":{n()}", lambda: f"{w()} -- {w()}", lambda: f"{w()}-", lambda: f"AT&T; B&B {w()}", lambda: f"{w()} & {w()};", lambda: f"{w()} <{w().lower()}@{w().lower()}.example>", lambda: "Yes / No / " + w(), lambda: f"{w()} ({w()}: {n()})", lambda: f"{w()} {n()} %", lambda: f"{w()} < {w()} > {w()}", lambda: f"{w()}: <{n()}",
            ]
        )()

    def page(self) -> str:
        r, n = self.r, self.r.randint(1, 400)
        return r.choice([f"- {n} -", f"– {n} –", f"— {n} —", f"[{n}]", f"({n})", f"{n}", f"Page {n}", f"p. {n} of {n + 9}", f"{n}/{n + 7}", f"{n} | {self.words(2, 5)}", f"{self.words(2, 5)} | {n}", f"{self.words(2, 5)}    {n}", "iv", "----------"[: r.randint(1, 2)], "* "[:1]])

    def sentence(self) -> str:
        r = self.r
        parts = []
        for _ in range(r.randint(5, 14)):
            x = r.random()
            parts.append(self.num() if x < 0.08 else self.token() if x < 0.16 else self.word() + ("," if x > 0.93 else ""))
        s = " ".join(parts)
        s = s[0].upper() + s[1:] + r.choice([".", ".", ".", ".", "?", "!", ":"])
        if r.random() < 0.12:
            d = self.decoy()
            s = r.choice([f"{s} {d}", f"{d} {s}", f"{s} {d[0].upper() + d[1:]}"])
        return s

    def para(self) -> str:
        return " ".join(self.sentence() for _ in range(self.r.randint(1, 6)))

    def inline(self, *wraps: str) -> str:
        """A paragraph with stretches dressed in ``wraps``, where {} is the stretch."""
        parts = self.para().split(" ")
        for wrap in wraps:
            i = self.r.randrange(len(parts))
            j = min(len(parts), i + self.r.randint(1, 5))
            stretch = " ".join(parts[i:j])
            if _A in stretch or re.search(r"[*_`~$\[\]{}<>|\\']", stretch):
                stretch = self.words(1, 4)
            parts[i:j] = [_m(wrap.replace("{}", stretch)) + self.r.choice(["", "", "", ",", ".", ";"])]
        return " ".join(parts)

    def code(self) -> str:
        """A line of code, with whatever signs."""
        r, n, w = self.r, self.num, lambda: self.word().lower()
        return r.choice([f"{w()} = {w()} / {w()}", f"for {w()} in {w()}:", f"    total += {w()}.{w()} * {n()}", f"# {w()} {w()}", f"- {w()} {n()}", f"x_{n()} = {{a: [1, 2], b: '{w()}'}}", f"if a < {n()} && b > {n()}: {w()}(*{w()}, **{w()})", f"<{w()}>{w()}</{w()}>", f"print(\"{w()}\\n\") | {w()} | {w()}", f"$ {w()} -{w()[0]} ~/{w()} > {w()}.txt", f"SELECT {w()}_{w()} FROM {w()} WHERE x <> ''", f"== {w()} ==", f"* {w()} * {w()} *", f"return a[{n()}](b)", f"\\{w()}{{{w()}}}"])

    def math(self) -> str:
        r, n = self.r, self.r.randint(1, 99)
        return r.choice([f"L = c \\cdot Q^{{{n}}}", f"x_{n} \\leq {n}", f"\\frac{{{n}}}{{{n + 1}}} \\times R_{{\\mathrm{{max}}}}", f"E = m c^{n % 10}", f"\\alpha^{n} + \\beta_{{i}}", f"\\sum_{{i=1}}^{{n}} a_i f_i", f"y = {n} x + {n}", f"\\sqrt{{{n}}}", "x", f"a * b_{{{n}}} * c"])

    def block(self, kind: str) -> list[tuple[str, str, set[str]]]:
        """(line, label, kinds) of one construct."""
        r, w = self.r, self.word
        url = r.choice([f"https://{w().lower()}.example/{w().lower()}/{r.randint(1, 3000)}", f"http://{w().lower()}.example/{w().lower()}_{w().lower()}", f"#{w().lower()}", f"{w().lower()}/{w().lower()}.html"])
        k = {kind}
        t = lambda s, label="text": [(s, label, k)]
        whole = lambda s, label: [(_m(s), label, k)]
        head, n = self.words(1, 6).capitalize(), r.randint(1, 6)
        case = lambda x: x.upper() if r.random() < 0.1 else x
        if kind == "html":
            tag = r.choice(["b", "i", "em", "strong", "span", "u", "sub", "sup", "small", "code", "mark", "font", "a", "q", "tt"])
            attr = r.choice(["", "", f' class="{w().lower()}-{n}"', f" id={w().lower()}", f' style="{w().lower()}:{n}px"'])
            box = r.choice(["p", "div", "section", "td", "blockquote", "article", "span"])
            cell = r.choice(["td", "td", "th"])
            return r.choice(
                [
                    lambda: t(f"{_m(case(f'<{box}{attr}>'))}{self.para()}{_m(case(f'</{box}>'))}"), lambda: t(f"{_m(case(f'<{box}{attr}>'))}{self.para()}"), lambda: t(f"{self.para()}{_m(case(f'</{box}>'))}"), lambda: t(f"{self.para()}{_m('</span></div>')}"), lambda: t(self.inline(f"<{tag}{attr}>{{}}</{tag}>")), lambda: t(self.inline(f"<{tag}>{{}}</{tag}>", f"<{tag}>{{}}</{tag}>")),
                    lambda: t(self.inline(f'<a href="{url}">{{}}</a>')), lambda: t(self.inline("{}<br/>")), lambda: t(self.inline("{}<br>")), lambda: t(self.para() + _m("<br />")), lambda: t(self.para() + _m('&' + r.choice(['nbsp', 'nbsp', '#160', 'hellip']) + ';')), lambda: t(self.inline("{}&nbsp;" + w())), lambda: t(f"{self.words(1, 4)}: {self.words(1, 3)} {_m(self.num() + '&nbsp;')}"), lambda: t(f"{self.words(1, 4)} {_m('&' + r.choice(['amp', 'nbsp', 'lt', 'mdash']) + ';')} {self.words(1, 3)}"), lambda: t(self.inline("&amp; {}")), lambda: t(self.inline("{} &lt; 5 &gt; 3")), lambda: t(self.inline("{}&#8217;s")), lambda: t(self.inline("{}&eacute;")), lambda: t(self.inline(f"{{}}&{r.choice(['mdash', 'quot', 'copy', 'hellip', 'rsquo', 'uuml', 'deg'])};")),
                    lambda: t(f"{_m(f'<!-- {self.words()} {self.code() if r.random() < 0.3 else n} -->')}{self.para()}"), lambda: whole(case(f"<h{n}{attr}>") + f"{head}</h{r.randint(1, 6)}>", "heading"), lambda: [(_m(r.choice(["<ul>", "<ol>", f"<ul{attr}>"])), "list", k), *[(f"{_m('<li>')}{self.sentence()}{_m('</li>') if r.random() < 0.7 else ''}", "list", k) for _ in range(r.randint(1, 4))], *([(_m("</ul>"), "list", k)] if r.random() < 0.8 else [])],
                    lambda: t("".join(f"{_m(f'<li>{self.words(1, 3)}</li>')}" for _ in range(2)), "list"), lambda: whole("<table>" + "".join(f"<tr><{cell}>{self.words()}</{cell}><{cell}>{self.num()}</{cell}></tr>" for _ in range(r.randint(1, 3))) + "</table>", "table"), lambda: [(_m(f"<table{attr}>"), "table", k), *[(_m(f"<tr><{cell}>{w()}</{cell}><{cell}>{self.num()}</{cell}></tr>"), "table", k) for _ in range(2)], (_m("</table>"), "table", k)],
                    lambda: [(f"{_m('<pre>' + r.choice(['<code>', '']))}{self.code()}", "code", k), *[(self.code(), "code", set()) for _ in range(r.randint(0, 2))], (f"if {w()} &lt; {self.num()}: skip({w()}){_m('</code></pre>')}", "code", k)], lambda: [(_m("<pre>"), "code", k), (self.code(), "code", set()), (_m("</pre>"), "code", k)], lambda: whole(f'<img src="{w()}.png" alt="{w()}">', "text"), lambda: whole(r.choice(["<hr>", "<hr/>", "<HR>"]), "rule"), lambda: t(f"{_m('<blockquote>')}{self.para()}{_m('</blockquote>')}", "quote"), lambda: whole(f"<{box}{attr}>", "text"), lambda: whole(f"</{box}>", "text"),
                ]
            )()
        if kind == "markdown":
            b = r.choice("-+*")
            tick = r.choice([self.word().lower() + "_" + w().lower(), self.word().lower(), self.code().strip().replace("`", "") or "x"])
            cols = r.randint(2, 4)
            return r.choice(
                [
                    lambda: whole(f"{'#' * n} {head}{r.choice(['', '', ' ' + '#' * n])}", "heading"), lambda: whole(f"{'#' * n} {head}", "heading"), lambda: [(_m(head), "heading", k), (_m(r.choice("=-") * max(3, len(head))), "heading", k)], lambda: [(f"{_m(b)} {self.sentence()}", "list", k) for _ in range(r.randint(2, 5))], lambda: [(f"{' ' * r.choice([0, 2, 4])}{_m(b)} {self.words(1, 4)}", "list", k) for _ in range(r.randint(2, 5))], lambda: [(f"{_m(r.choice('*+'))} {self.words(2, 8)}", "list", k)],
                    *[lambda x=x: t(self.inline(x)) for x in ("**{}**", "_{}_", "*{}*", "__{}__", "~~{}~~", "***{}***", "`{}`")], lambda: t(self.inline("**{}**", "_{}_")), lambda: t(self.inline(f"[{{}}]({url})")), lambda: t(self.inline(f'[{{}}]({url} "{w()}")')), lambda: whole(f"![{self.words()} chart](img/{w().lower()}_{n}.png)", "text"), lambda: t(f"{self.para()} See {_m('`' + tick + '`')}."), lambda: t(f"{_m('**' + head + '**')}"), lambda: t(f"{_m('**' + w() + ':**')} {self.para()}"),
                    lambda: [(_m(r.choice(["```python", "```", "~~~", "```sql", "``` text"])), "code", k), *[(self.code(), "code", set()) for _ in range(r.randint(1, 4))], (_m("```"), "code", k)],
                    lambda: [(_m("| " + " | ".join(w() for _ in range(cols)) + " |"), "table", k), (_m("|" + "|".join(r.choice(["---", "------", ":---", ":--:", " --- "]) for _ in range(cols)) + "|"), "table", k), *[(_m("| " + " | ".join(r.choice([w(), self.num()]) for _ in range(cols)) + " |"), "table", k) for _ in range(r.randint(1, 3))]], lambda: [(f"{_m('>')} {self.para()}", "quote", k) for _ in range(r.randint(1, 2))], lambda: whole(r.choice(["***", "* * *", "___", "_ _ _"]), "rule"),
                ]
            )()
        if kind == "wiki":
            return r.choice(
                [
                    lambda: whole(f"{'=' * max(2, n)} {head} {'=' * max(2, n)}", "heading"), lambda: whole(f"{'=' * max(2, n)}{head}{'=' * max(2, n)}", "heading"), *[lambda x=x: t(self.inline(x)) for x in ("'''{}'''", "''{}''", "[[{}]]", f"[[{w()}|{{}}]]", f"[[{w()} ({w()})|{{}}]]", "'''''{}'''''")], lambda: whole(f"[[Category:{head}]]", "text"), lambda: whole(f"[[File:{w()}_{n}.png|thumb|{head}]]", "text"), lambda: whole(f"{{{{Infobox {w()}|name={w()}|load={self.num()}}}}}", "text"), lambda: t(self.inline(f"{{}} {{{{{w().lower()}|{w()}={self.num()}}}}}")), lambda: t(f"{self.para()} {_m(f'{{{{cite {w().lower()}|year={r.randint(1990, 2024)}}}}}')}"), lambda: t(self.inline(f"[https://{w().lower()}.example/{w().lower()}_{n} {{}}]")), lambda: t(self.inline("'''{}'''", "[[{}]]")),
                    lambda: [(_m(r.choice(['{| class=wikitable', '{| class="wikitable"', "{|"])), "table", k), *([(_m(f"! {w()} !! {w()}"), "table", k)] if r.random() < 0.4 else []), *[x for _ in range(r.randint(1, 3)) for x in ((_m("|-"), "table", k), (_m(f"| {w()} || {self.num()}"), "table", k))], (_m("|}"), "table", k)], lambda: [(_m(f";{self.words()}"), "list", k), (_m(f":{r.choice([self.num(), self.words(), chr(39) * 2 + self.num() + chr(39) * 2])}"), "list", k)], lambda: t(self.inline("{}<ref>" + w() + "</ref>")), lambda: whole(r.choice(["__TOC__", "__NOTOC__", f"#REDIRECT [[{w()}]]"]), "text"),
                ]
            )()
        env = r.choice(["equation", "align", "equation*", "gather"])
        lst = r.choice(["itemize", "enumerate"])
        return r.choice(
            [
                lambda: whole(f"\\{r.choice(['section', 'subsection', 'subsubsection', 'paragraph', 'chapter'])}{r.choice(['', '', '*'])}{{{head}}}", "heading"), *[lambda x=x: t(self.inline(x)) for x in ("\\textbf{{}}", "\\textit{{}}", "\\emph{{}}", "\\underline{{}}", "\\texttt{{}}")], lambda: t(f"{self.para()} The share is {_m(f'{n}' + chr(92) + '%')} (see {_m(f'Table~' + chr(92) + f'ref{{tab:{n}}}')})."), lambda: t(self.inline(f"{{}} {n}\\%")), lambda: t(self.inline(f"{{}} \\& {w()}")), lambda: t(self.para() + _m(f"~\\cite{{{w().lower()}{n}}}")), lambda: t(self.inline(f"{{}} \\citep[{n}]{{{w().lower()}{n}}}")), lambda: t(self.inline("{}\\footnote{" + w() + "}")), lambda: t(self.inline(f"{{}}~\\ref{{fig:{w().lower()}}}")), lambda: t(self.inline("\\href{" + url + "}{{}}")),
                *[lambda: t(self.inline(f"${self.math()}$"))] * 2, lambda: t(f"{self.para()} The {w()} follows {_m('$' + self.math() + '$')}."), lambda: t(f"where {_m('$' + self.math() + '$')} and {_m('$' + self.math() + '$')} {self.words()}"), lambda: whole(f"\\[ {self.math()} \\]", "formula"), lambda: whole(f"$$ {self.math()} $$", "formula"), lambda: whole(f"\\label{{{w().lower()}:{n}}}", "text"),
                lambda: [(_m(f"\\begin{{{env}}}"), "formula", k), (_m(f"{self.math()}{r.choice(['', f' {chr(92)}label{{eq:{n}}}', ' ' + chr(92) * 2])}"), "formula", k), (_m(f"\\end{{{env}}}"), "formula", k)], lambda: [(_m(f"\\begin{{{lst}}}"), "list", k), *[(f"{_m(chr(92) + 'item')} {self.sentence()}", "list", k) for _ in range(r.randint(1, 4))], (_m(f"\\end{{{lst}}}"), "list", k)],
                lambda: [(_m(f"\\begin{{tabular}}{{{'l' * r.randint(2, 3)}}}"), "table", k), *[(_m(f"{w()} & {self.num()} \\\\{r.choice(['', ' ' + chr(92) + 'hline'])}"), "table", k) for _ in range(r.randint(1, 3))], (_m("\\end{tabular}"), "table", k)], lambda: [(_m("\\begin{verbatim}"), "code", k), *[(self.code(), "code", set()) for _ in range(r.randint(1, 3))], (_m("\\end{verbatim}"), "code", k)], lambda: t(self.inline("``{}\\'' \\ldots")),
            ]
        )()

    def scan(self) -> list[tuple[str, str, set[str]]]:
        """Lines of a scanned page."""
        r = self.r
        text, out, at = self.para() + " " + self.para(), [], 0
        while at < len(text):
            cut = at + r.randint(40, 75)
            line = text[at:cut].strip()
            if r.random() < 0.15 and len(line) > 20:
                i = r.randrange(5, len(line) - 5)
                line = line[:i] + r.choice(["1", "0", "rn", "5", "l", "ii", "|"]) + line[i + 1 :]
            if r.random() < 0.05 and line:
                ws = line.split(" ")
                i = r.randrange(len(ws))
                ws[i] = " ".join(ws[i])
                line = " ".join(ws)
            out.append((line + (r.choice("-\u00ad¬") if cut < len(text) and r.random() < 0.2 else ""), "text", set()))
            at = cut
        if r.random() < 0.5:
            out.insert(r.choice([0, len(out)]), (self.page(), "text", set()))
        return out

    def document(self) -> list[tuple[str, str, set[str]]]:
        r = self.r
        kinds = r.choices([[], ["html"], ["markdown"], ["wiki"], ["latex"], r.sample(KINDS, 2)], weights=[5, 3, 3, 3, 3, 6])[0]
        share = r.choice([0.12, 0.3, 0.5])
        out: list = []
        if kinds and r.random() < 0.2:  # an element that nothing closes may hold the other kinds
            out.append((f"{_m(r.choice(['<div>', '<p>', '<DIV CLASS=note>', '<section>', '<td>', '<blockquote>']))}{self.para()}", "text", {"html"}))
        for _ in range(r.randint(1, 10)):
            x = r.random()
            if kinds and x < share:
                out += self.block(r.choice(kinds))
            elif x < share + 0.12:
                out.append((self.decoy(), "text", set()))
            elif x < share + 0.17:
                out += self.scan()
            elif x < share + 0.2:
                out.append((self.page(), "text", set()))
            elif x < share + 0.26:
                line = self.words(3, 9)
                out.append((r.choice([line.upper(), "  " + line, line.capitalize(), line + ":", "    " + line]), "text", set()))
            elif x < share + 0.29:
                out += [(r.choice([f"{i}. {self.sentence()}", f"{i}) {self.words(2, 6)}", f"({chr(97 + i)}) {self.words(2, 6)}"]), "text", set()) for i in range(1, r.randint(2, 4))]
            elif x < share + 0.31:
                out += [(f"{self.words(1, 3)}: {self.words(1, 3)} {self.num()}", "text", set()) for _ in range(r.randint(2, 6))]
            else:
                out.append((self.para(), "text", set()))
        return out


def _unmark(line: str) -> tuple[str, list[tuple[int, int]]]:
    """The line, and where its marked stretches stand."""
    out, at, spans = [], 0, []
    for piece in re.split(f"([{_A}{_Z}])", line):
        if piece == _A:
            spans.append((at, at))
        elif piece == _Z:
            spans[-1] = (spans[-1][0], at)
        else:
            out.append(piece)
            at += len(piece)
    return "".join(out), spans


def examples(n: int, seed: int) -> list[tuple[list[list[int]], np.ndarray, np.ndarray]]:
    w = Writer(seed)
    made = []
    while len(made) < n:
        rows = [(*_unmark(line.rstrip()), label, kinds) for line, label, kinds in w.document() if line.strip()]
        parsed = leaves("\n".join(line for line, *_ in rows))
        own = []
        for no, s, part, *_ in parsed:
            _, spans, _, kinds = rows[no - 1]
            own.append(kinds if any(a < s + len(part) and s < b for a, b in spans) else set())
        made.append(([leaf[4] for leaf in parsed], np.array([[k in ks for k in KINDS] for ks in own], "f4"), np.array([LABELS.index(rows[leaf[0] - 1][2]) for leaf in parsed])))
    return made


def _gradients(net: BiLSTM, batch: list) -> tuple[dict[str, np.ndarray], float]:
    p = net.p
    steps, size = max(len(b) for b, *_ in batch), len(batch)
    x, mask = np.zeros((steps, size, p["emb"].shape[1]), "f4"), np.zeros((steps, size), "f4")
    yk, yl = np.zeros((steps, size, len(KINDS)), "f4"), np.zeros((steps, size), int)
    flat = [bag for b, *_ in batch for bag in b]
    e = net.embed(flat)
    at, k = [], 0
    for j, (b, kinds, labels) in enumerate(batch):
        n = len(b)
        x[:n, j], mask[:n, j], yk[:n, j], yl[:n, j] = e[k : k + n], 1, kinds, labels
        at += [(t, j) for t in range(n)]
        k += n
    keep = {"f": [], "b": []}
    h = np.concatenate([net.direction(x, mask, d, keep[d]) for d in "fb"] + [x], axis=2)
    z = h @ p["out"] + p["ob"]
    pk = 1 / (1 + np.exp(-z[:, :, : len(KINDS)]))
    zl = z[:, :, len(KINDS) :]
    pl = np.exp(zl - zl.max(2, keepdims=True))
    pl /= pl.sum(2, keepdims=True)
    hot = np.eye(len(LABELS), dtype="f4")[yl]
    total, m = mask.sum(), mask[:, :, None]
    loss = -(m * (yk * np.log(pk + 1e-7) * 2 + (1 - yk) * np.log(1 - pk + 1e-7))).sum() / total - 0.5 * (m * hot * np.log(pl + 1e-7)).sum() / total
    dz = np.concatenate([(pk * (1 + yk) - 2 * yk) * m, (pl - hot) * m * 0.5], axis=2) / total
    g = {k: np.zeros_like(v) for k, v in p.items()}
    g["out"], g["ob"] = np.einsum("tbh,tbo->ho", h, dz), dz.sum((0, 1))
    dh_all = dz @ p["out"].T
    hid = p["whf"].shape[0]
    dx = dh_all[:, :, 2 * hid :].copy()
    for d, lo in (("f", 0), ("b", hid)):
        dh, dc = np.zeros((size, hid), "f4"), np.zeros((size, hid), "f4")
        for t, h0, c0, i, f, o, gg, tc, mm in reversed(keep[d]):
            dh = dh + dh_all[t, :, lo : lo + hid]
            do, dct = dh * mm * tc, dc * mm + dh * mm * o * (1 - tc**2)
            dzt = np.concatenate([dct * gg * i * (1 - i), dct * c0 * f * (1 - f), do * o * (1 - o), dct * i * (1 - gg**2)], axis=1)
            g[f"wx{d}"] += x[t].T @ dzt
            g[f"wh{d}"] += h0.T @ dzt
            g[f"b{d}"] += dzt.sum(0)
            dx[t] += dzt @ p[f"wx{d}"].T
            dh, dc = dh * (1 - mm) + dzt @ p[f"wh{d}"].T, dc * (1 - mm) + dct * f
    tt, jj = np.array(at).T
    de = dx[tt, jj] * (1 - e**2)
    idx, weight, sizes = weigh(flat)
    np.add.at(g["emb"], idx, np.repeat(de, sizes, axis=0) * weight[:, None])
    return g, float(loss)


def _other_words(bag: list[int], r: random.Random) -> list[int]:
    """Words are made up here: half of them become any word, so the network learns not to lean on them."""
    kept = [x if x >= WORD_BUCKETS or r.random() < 0.5 else r.randrange(WORD_BUCKETS) for x in bag if x >= WORD_BUCKETS or r.random() < 0.5]
    return kept or bag


def train(n: int = 24000, epochs: int = 5, seed: int = 7, rate: float = 8e-3, batch: int = 96, log=print) -> BiLSTM:
    net = BiLSTM.fresh(seed=seed)
    data = examples(n, seed)
    r = random.Random(seed)
    m1 = {k: np.zeros_like(v) for k, v in net.p.items()}
    m2 = {k: np.zeros_like(v) for k, v in net.p.items()}
    step = 0
    for epoch in range(epochs):
        r.shuffle(data)
        data.sort(key=lambda x: len(x[0]) // 4)  # alike in length within a batch, shuffled otherwise
        starts = list(range(0, len(data), batch))
        r.shuffle(starts)
        losses = []
        for i in starts:
            part = [([_other_words(bag, r) for bag in b], k, lab) for b, k, lab in data[i : i + batch]]
            g, loss = _gradients(net, part)
            losses.append(loss)
            step += 1
            lr = rate * (0.5 ** max(0, epoch - 1))
            for k in net.p:
                m1[k] = 0.9 * m1[k] + 0.1 * g[k]
                m2[k] = 0.999 * m2[k] + 0.001 * g[k] ** 2
                net.p[k] -= (lr * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)).astype("f4")
        log(f"epoch {epoch + 1}: loss {np.mean(losses):.4f}")
    return net


def accuracy(net: BiLSTM, n: int = 1500, seed: int = 99) -> dict[str, float]:
    """On texts that training has not seen: share of labels right, recall and precision of kinds by leaf, and by (text, kind)."""
    data = examples(n, seed)
    got = net.scores([b for b, *_ in data])
    yk, yl = np.concatenate([k for _, k, _ in data]), np.concatenate([lab for *_, lab in data])
    pk, pl = np.concatenate([k for k, _ in got]) >= THRESHOLD, np.concatenate([lab for _, lab in got])
    dy, dp = np.array([k.max(0) for _, k, _ in data]) > 0, np.array([k.max(0) for k, _ in got]) >= THRESHOLD
    return {
        "label": float((pl == yl).mean()), "recall": float((pk & (yk > 0)).sum() / yk.sum()), "precision": float((pk & (yk > 0)).sum() / max(1, pk.sum())),
        "text_recall": float((dp & dy).sum() / dy.sum()), "text_precision": float((dp & dy).sum() / max(1, dp.sum())),
    }


if __name__ == "__main__":
    net = train()
    print(accuracy(net))
    net.save(Path(sys.argv[1]) if len(sys.argv) > 1 else Path(__file__).with_name("markup_model.npz"))
