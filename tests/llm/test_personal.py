"""Names, streets and sentences here stand in no test table; « » mark what must be found."""

import numpy as np
import pytest

from loomgraph.llm import personal as P

NAMES = [
    "Harriet Osgood", "Emeka Balogun", "Yuki Tanemura", "Sofia Lindqvist", "Marek Dvorsky", "Ines Carvalho", "Tomasz Zielinski", "Priya Raman", "Olivier Garnier", "Aoife Brennan", "Hamza Qureshi", "Greta Holm", "Luca Ferrante", "Noor Haddad", "Ivan Petrenko", "Mei Huang",
    "Jonas Weber", "Camila Rojas", "Callum Fraser", "Anneke Visser",
]
TEMPLATES = [
    ("Mr «{n}» (mail: «{m}@post.example») wants his deposit back.", ["person", "email"]),
    ("Author: «{n}»\nPhone: «+44 20 7946 0{d}»\nMail: «{m}@shop.example»\n", ["person", "phone", "email"]),
    ("The parcel for «{n}», «{h} Juniper Lane», Westport, came back.", ["person", "address"]),
    ("Dr «{n}», passport no. «P{d}48{d}1», boarded last.", ["person", "id_number"]),
    ("Kind regards,\n«{n}»\n", ["person"]),
    ("We met «{n}» at the bakery and paid for the rye bread.", ["person"]),
    ("The keys were left with «{n}» on the second floor.", ["person"]),
    ("Ask Ms «{f}» for the oven manual, or ring «(020) 7946 0{d}».", ["person", "phone"]),
    ("«{i}. {f}», «{m}@mail.example», repairs violins.", ["person", "email"]),
    ("Her licence number is «LC {d} 55{d}»; the flat is «Flat {h}, 9 Orchard Road», Eastham.", ["id_number", "address"]),
]
DECOYS = [
    "Order number 55{d}71 left the warehouse on 4 May.", "The Royal Bakery Society met in Orchard Hall.", "The years 2011-2019 were dry, and 40 loaves were sold.", "Ticket 88{d}12 was refunded.", "Juniper Lane is closed to lorries.", "Version 4.2.{d} of the program reads 12 files.",
    "The handle @ryebread_{d} has 12 followers.", "North Coast Ferry Company runs two ships to Saint Peter Island.", "Flour costs 12.50 a sack, sugar 9.",
]
SCHEMA = "doc_id bigint, text string, kind string, start int"


def held_out(per=24):
    rows, want, n = [], set(), 0
    for i in range(per):
        for j, (case, kinds) in enumerate(TEMPLATES):
            name = NAMES[(i * 7 + j * 3) % len(NAMES)]
            case = case.format(n=name, f=name.split()[1], i=name[0], m=name.split()[1].lower(), d=100 + i * 13 + j, h=3 + (i * 5 + j) % 90)
            plain, k = f"The oven was lit at six, and the dough had rested. {'It rained. ' * (i % 3)}", 0
            for part in case.split("«"):
                if "»" in part:
                    span, rest = part.split("»")
                    want.add((n, len(plain) + 1, kinds[k]))
                    k += 1
                    plain += span + rest
                else:
                    plain += part
            rows.append((n, plain + " Bread rises best in a warm kitchen.", "", 0))
            n += 1
        for d in DECOYS:
            rows.append((n, d.format(d=100 + i * 7), "", 0))
            n += 1
    return rows, want


def test_found_on_unseen_names_and_sentences(spark):
    rows, want = held_out()
    rows += [(9000, None, "", 0), (9001, "", "", 0), rows[0], (9002, "clean " * 50_000, "", 0)]
    got = {(r.doc, r.start_pos, r.kind) for r in P.spans(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got & want) >= 0.9 * len(want) and len(got & want) >= 0.9 * len(got), (sorted(want - got)[:20], sorted(got - want)[:20])


def test_redaction(spark):
    rows, _ = held_out()
    out = {r.doc: r for r in P.redact(spark.createDataFrame(rows + [(9000, None, "", 0)], SCHEMA)).collect()}
    assert "Author: [PERSON]\nPhone: [PHONE]\nMail: [EMAIL]\n" in out[1].text and out[1].replaced == 3
    assert out[9000].text is None and out[len(TEMPLATES)].text == rows[len(TEMPLATES)][1] and len(out) == len(rows) + 1


def test_classifier_and_reliabilities_matter(spark):
    """Names that no labeller knows come from the words around them, so voting alone finds fewer."""
    rows, want = held_out()
    for i, (a, b) in enumerate(zip("Abigor Belwyn Cadmir Dorlas Evrand Fulgar Gisbet Horwin".split(), "Tarnow Ubrick Velden Wostok Yarrow Zander Quimby Pelham".split(), strict=True)):
        rows.append((5000 + i, f"The oven was lit. We met {a} {b} at the bakery and paid for the rye bread.", "", 0))
        want.add((5000 + i, 26, "person"))
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.doc, r.start_pos, r.kind) for r in P.spans(df).collect()}
    cand = P._voted(P.candidates(df), None).collect()
    plain = {(r.doc, r.start + 1, r.kind) for r in cand if r.votes.count("+") - 1.5 * r.votes.count("-") > 0.5}
    assert len(got & want) > len(plain & want)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert P.spans(df).count() == 0 and P.redact(df).count() == 0


def test_given_names_of_a_caller(spark):
    given = spark.createDataFrame([("Wolbert",), (None,)], "name string")
    words = {r.word for r in P._gazetteers(P.candidates(spark.createDataFrame([(1, "Wolbert Kuse and Anna Kuse came.", "", 0)], SCHEMA)), given).filter("name").collect()}
    assert words == {"wolbert"}


@pytest.mark.parametrize(
    ("text", "spans"),
    [
        ("Yours faithfully,\nAnna Kuse The board met.", {"Anna Kuse"}), ("Mr A Kuse came.", {"A Kuse"}), ("KUSE, Anna called.", {"KUSE, Anna"}), ("Serial XK-series pumps and Meter MT/67 stand.", set()),
    ],
)
def test_readings_of_runs(text, spans):
    got = {text[s:e] for k, s, e, *_ in P.candidates_of(text) if k == "person"}
    assert spans <= got if spans else not got


def test_estimate_finds_the_reliable_voter():
    r = np.random.default_rng(1)
    truth = r.random(4000) < 0.3
    votes = ["".join("+" if (t if r.random() < p else not t) else "0" for p in (0.97, 0.9, 0.6)) for t in truth]
    pats = sorted(set(votes))
    counts = np.array([votes.count(v) for v in pats], float)
    q, like = P.estimate(pats, counts)
    ratio = like[:, 1, 2] / like[:, 0, 2]
    assert ratio[0] > ratio[2]


def test_context_carries_what_no_vote_knows():
    rows = [("+0", [1, 2])] * 40 + [("0-", [3, 4])] * 40
    w = P.fit_classifier(rows, np.r_[np.full(40, 0.95), np.full(40, 0.05)], np.ones(80))
    assert w[[1, 2]].sum() + w[-1] > 0 > w[[3, 4]].sum() + w[-1]
