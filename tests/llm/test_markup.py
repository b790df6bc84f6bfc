import numpy as np
import pytest

from loomgraph.llm import markup as M
from loomgraph.llm import markup_train as T

PLAIN = [
    "Readings of pH < 6.5 and > 8.5 were set aside.", "The grant ranged from $4 million to $7 million.", "Values marked * are provisional (*see annex).", "A 4 x 5 grid gives 20 cells; 5 * 46 were kept.", "The file C:\\loads\\site_4 was lost.",
    "The set {a, b, c} was used in run_43_final.", "~53 tonnes remained on site.", "-4.81 degrees was the lowest.", "The draft says \"adress\" [sic] in line 28.", "R&D spending rose; lot #4 and 10^6 cells.", "1. First point\n2. Second point", "- 4 -", "[8]", "it's the owners' share",
]
MARKED = {
    "html": ["<p>Text</p>", "a &amp; b", "after&nbsp;that", "x<br/>y", "<h2>Head</h4>", "tail</span></div>", "<!-- note -->text"],
    "markdown": ["# Head", "Head\n----", "a **bold** word", "an _odd_ word", "see `mean_rate`.", "~~gone~~ now", "[text](https://x.example/a)", "![chart](img/a_1.png)", "- one\n- two", "> quoted text", "***", "```\ncode\n```", "| a | b |\n|---|---|\n| 1 | 2 |"],
    "wiki": ["== Head ==", "a '''bold''' word", "''it''", "[[Place|text]]", "{{cite|year=2018}}", "{| class=x\n|-\n| a || b\n|}", ";term\n:''4''", "[https://x.example/a some text]"],
    "latex": ["\\section{Head}", "a \\textbf{b} c", "share is 15\\% of it", "$L = c \\cdot Q^{2}$", "\\[ \\frac{1}{2} \\]", "text.~\\cite{a}", "\\begin{itemize}\n\\item one\n\\end{itemize}"],
}
SCHEMA = "chunk_id string, text string, kind string, doc int"


#: Wording and constructs that the writer of the training texts does not have.
FILLER = [
    "The orchestra rehearsed twice before the concert, and the second oboist arrived late.", "Bread rises best at 24-26 degrees; a colder kitchen needs more time.", "Her grandmother's recipe (written in 1931) asks for rye flour & caraway.",
    "Trains to the coast leave at 7:15 and 19:40, except on holidays.", "“Nobody reads the manual,” said the engineer, “until something smokes.”", "The museum's north wing - closed since spring - holds coins, maps and a stuffed heron.",
]
HELD_OUT_PLAIN = [
    "Tickets cost $12 for adults and $7 for children.", "Water at < 4 degrees or > 60 degrees fails the test.", "* prices without tax, see the desk", "Save it under D:\\music\\scores\\oboe_2.pdf and reload.", "The pair {x, y} was stored in tmp_final_v2.",
    "~300 people came to the fair.", "Seat #14 is broken.", "He wrote \"recieve\" [sic] on page 9.", "1) knead\n2) wait\n3) bake", "– 17 –", "[42]", "if n == 3 the lamp goes out", "5 * 3 makes 15", "the Smiths' and the Joneses' houses", "Rock&Roll since 1956", "AC/DC, 50/50 and 24/7",
]
HELD_OUT = {
    "html": ["<p>The heron stands still.</p>", "Salt &amp; pepper", "<h3>Opening hours</h3>", "the <em>second</em> oboist", "late<br>again", "<ul>\n<li>rye</li>\n<li>wheat</li>\n</ul>", "<table><tr><td>rye</td><td>3</td></tr></table>", "<div class=menu>", "<!-- draft -->"],
    "markdown": ["## Opening hours", "Opening hours\n=============", "the **second** oboist", "the *second* oboist", "call `bake(oven)` now", "see [the map](https://coast.example/map)", "- rye\n- wheat\n- oats", "> Nobody reads the manual.", "```\nbake(oven)\n```", "| grain | kg |\n|---|---|\n| rye | 3 |", "~~closed~~ open"],
    "wiki": ["== Opening hours ==", "the '''second''' oboist", "see [[Heron]] and [[Oboe|oboists]]", "{{Infobox bird|name=Heron}}", "[[Category:Birds]]", "{| class=wikitable\n|-\n| rye || 3\n|}", "[https://coast.example/map the map]", ";rye\n:''3''"],
    "latex": ["\\section{Opening hours}", "the \\emph{second} oboist", "about 40\\% of it", "where $x^2 = 4$ holds", "\\[ x = \\frac{1}{2} \\]", "as shown.~\\cite{heron}", "\\begin{itemize}\n\\item rye\n\\item wheat\n\\end{itemize}", "\\begin{equation}\ny = x^2\n\\end{equation}"],
}


def _kinds(texts):
    return [{k for k, p in zip(M.KINDS, probs.max(0), strict=True) if p >= M.THRESHOLD} if len(probs) else set() for _, probs, _ in M._read(texts)]


def test_network_on_held_out_wording():
    texts, want = [], []
    for i, t in enumerate(HELD_OUT_PLAIN):
        texts.append(f"{FILLER[i % 6]}\n{t}\n{FILLER[(i + 1) % 6]}")
        want.append(set())
    for kind, ts in HELD_OUT.items():
        for i, t in enumerate(ts):
            texts.append(f"{FILLER[i % 6]}\n\n{t}\n\n{FILLER[(i + 2) % 6]}")
            want.append({kind})
    got = _kinds(texts)
    hits = sum(len(g & w) for g, w in zip(got, want, strict=True))
    assert hits / sum(map(len, want)) >= 0.9 and hits / sum(map(len, got)) >= 0.9, [(t, g) for t, g, w in zip(texts, got, want, strict=True) if g != w]


def test_document_context_decides():
    """The same line is code inside a fence and a heading outside."""
    inside = M._read(["```\n# not a head\n```"])[0]
    outside = M._read(["Some words.\n\n# A head\n\nMore words."])[0]
    assert M.LABELS[inside[2][1]] == "code" and M.LABELS[outside[2][1]] == "heading"


def test_signs_filter_is_safe():
    import re

    for texts in MARKED.values():
        assert all(re.search(M.SIGNS, t) for t in texts)


def test_held_out_accuracy():
    a = T.accuracy(M.model(), 400, seed=4321)
    assert min(a.values()) > 0.97


def test_gradients_are_right():
    net = M.BiLSTM.fresh(embed=3, hidden=3, seed=1)
    batch = T.examples(4, 5)
    g, _ = T._gradients(net, batch)
    r = np.random.default_rng(0)
    for name in ("wxf", "whf", "wxb", "whb", "bf", "out", "ob"):
        # along the gradient itself, where single precision suffices
        direction = g[name] / (np.linalg.norm(g[name]) + 1e-12) + 0.1 * r.normal(size=g[name].shape)
        old, eps = net.p[name].copy(), 2e-3
        net.p[name] = (old + eps * direction).astype("f4")
        up = T._gradients(net, batch)[1]
        net.p[name] = (old - eps * direction).astype("f4")
        down = T._gradients(net, batch)[1]
        net.p[name] = old
        want = float((g[name] * direction).sum())
        assert abs((up - down) / (2 * eps) - want) < 0.05 * abs(want) + 2e-3, name


def test_training_learns():
    net = T.train(n=1500, epochs=3, seed=3, log=lambda *_: None)
    assert T.accuracy(net, 150, seed=8)["recall"] > 0.7


def test_frame(spark):
    rows = [("p", "\n\n".join(PLAIN[:9]), "", 0), ("n", None, "", 0), ("e", "", "", 0)]
    want = set()
    filler = "The committee reviewed the plan before the season began."
    for kind in M.KINDS:
        for j, t in enumerate(MARKED[kind]):
            rows.append((f"{kind}{j}", f"{filler}\n\n{t}\n\n{filler}", "", 0))
            want.add((f"{kind}{j}", kind))
    df = spark.createDataFrame(rows + rows[:3], SCHEMA)
    got = {(r.doc, r.kind) for r in M.found(df).collect()}
    assert len(got ^ want) <= 1, got ^ want
    out = {r.doc: r.text for r in M.clean(df).collect()}
    assert out["n"] is None and out["e"] == "" and out["p"] == rows[0][1] and len(out) == len(rows)
    assert M.found(df.limit(0)).count() == 0 and M.blocks(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("<h2>Head</h2>\n<ul>\n<li>one</li>\n<li>two</li>\n</ul>", "## Head\n- one\n- two"),
        ("<table><tr><td>a</td><td>1</td></tr></table>", "| a | 1 |"),
        ("Head\n====\n\nsome **bold** words and a [link](http://x.example)\n\n***", "# Head\nsome bold words and a link"),
        ("== Head ==\na '''bold''' and [[A|b]]", "## Head\na bold and b"),
        ("\\section{Head}\nA \\textbf{b} 5\\% and $x^2$ here", "# Head\nA b 5% and $x^2$ here"),
        ("\\begin{equation}\nE = m\n\\end{equation}", "$$E = m$$"),
        ("```python\na_b * 2\n```\nan _odd_ word", "```\na_b * 2\n```\nan odd word"),
        ("{| class=x\n|-\n| a || b\n|}", "| a | b |"),
        ("\\begin{itemize}\n\\item one\n\\item two\n\\end{itemize}", "- one\n- two"),
        ("No markup, 5 * 3.\n\n\n\nEnd ", "No markup, 5 * 3.\n\n\n\nEnd "),
    ],
)
def test_clean_text(text, want):
    import re

    out = M.clean_text(text, *M._read([text])[0])
    assert (out if text == want else re.sub(r"\n+", "\n", out)) == want


def test_long_and_deep():
    t = "<div>" * 3000 + "x " * 50_000 + "**b**"
    parsed = M.leaves(t)
    assert "".join(leaf[2] for leaf in parsed) == t.rstrip()
    assert _kinds([t])[0] >= {"html", "markdown"}
