import random

from loomgraph.llm import variants as V

SCHEMA = "extraction_id bigint, name string, type string, aliases array<string>, group string"


def run(spark, rows):
    df = spark.createDataFrame([(i, n, t, a, "x") for i, (n, t, a) in enumerate(rows)], SCHEMA)
    return {(r.a, r.b) for r in V.linked_pairs(V.groups(df)).collect()}


def linked(spark, rows):
    names = [r[0] for r in rows]
    return {frozenset((names[a], names[b])) for a, b in run(spark, rows)}


def together(*names):
    return {frozenset((a, b)) for a in names for b in names if a != b}


def test_persons(spark):
    p = "Person"
    rows = [(n, p, None) for n in ("Valdemira Bennorekhe", "Bennorekhe, Valdemira", "VALDEMIRA BENNOREKHE", "Val Bennorekhe", "Valdemira K. Bennorekhe", "Ms Valdemira  Bennorekhe", "Vldemira Bennorekhe", "Valdemira Bennorékhe", "V. Bennorekhe", "BENNOREKHE, V.K.")]
    other = [("Ulfreda Bennorekhe", p, None), ("Tobinard Kalbo", "person", []), ("Toby Kalbo", "PERSON", []), ("Sandhaven Transfer Station", "Facility", [])]
    want = together(*[r[0] for r in rows]) | together("Tobinard Kalbo", "Toby Kalbo")
    assert linked(spark, rows + other) == want


def test_short_forms_mean_what_aliases_say(spark):
    p, o = "Person", "Organisation"
    rows = [
        ("Marivelle Kostra", p, []), ("Mirabel Kostra", p, []), ("M. Kostra", p, ["Mirabel Kostra"]), ("Kostra, M.", p, None),
        ("Northby Water Council", o, ["NWC"]), ("Nether Waste Council", o, []), ("NWC", o, ["Nether Waste Council"]), ("NAB", o, None), ("Northby Air Board (NAB)", "GovernmentAgency", None),
    ]
    got = linked(spark, rows)
    assert frozenset(("M. Kostra", "Mirabel Kostra")) in got and frozenset(("NWC", "Nether Waste Council")) in got and frozenset(("NAB", "Northby Air Board (NAB)")) in got
    assert not any(frozenset(x) in got for x in (("M. Kostra", "Marivelle Kostra"), ("NWC", "Northby Water Council"), ("Marivelle Kostra", "Mirabel Kostra")))
    assert not any("Kostra, M." in x for x in got)  # it fits two


def test_organisations(spark):
    o = "Organisation"
    same = ["Vonmam Waste Recovery Directorate", "The Vonmam Waste Recovery Directorate", "Vonmam Waste Recovery Dir.", "VONMAM WASTE RECOVERY DIRECTORATE", "Directorate of Waste Recovery, Vonmam", "Vonmam WRD", "Vonmam-Waste Recovery Directorate", "Vonmam Waste Recovery Directorate, Inc.", "Vonmmam Waste Recovery Directorate", "Vonmam Waste Rec. Directorate"]
    rows = [(n, o, None) for n in same] + [("Vonmam Water Quality Directorate", o, None), ("Vonmam Waste Recovery Council", o, None)]
    assert linked(spark, rows) == together(*same)


def test_null_types_repeats_and_nothing(spark):
    rows = [("Mr Oswald Perti", None, None), ("Oz Perti", "Person", ["Oswald Perti"]), (None, "Person", ["x"]), (" ", "Person", None), ("Quiet Cycle Scheme", None, None), ("!!!", "Person", [None, ""])]
    assert linked(spark, rows) == together("Mr Oswald Perti", "Oz Perti")
    assert run(spark, []) == set()
    df = spark.createDataFrame([(1, "Oswald Perti", "Person", [], ""), (1, "Oswald Perti", "Person", [], ""), (None, "Perti, Oswald", "Person", [], ""), (2, "Perti, Oswald", "Person", None, "")], SCHEMA)
    assert [(r.a, r.b) for r in V.linked_pairs(V.groups(df)).collect()] == [(1, 2)]


def test_one_error_passes_and_namesakes_do_not():
    r = random.Random(1)
    passed = 0
    for _ in range(500):
        a = "".join(r.choices("abdefgiklmnorstu", k=r.randint(5, 12)))
        i = r.randrange(len(a))
        b = r.choice([a[:i] + a[i + 1 :], a[:i] + "z" + a[i:], a[:i] + "z" + a[i + 1 :], a[:i] + a[i + 1 : i + 2] + a[i : i + 1] + a[i + 2 :]])
        passed += V._alike(a, b) > 0
        assert not V._alike(a, "".join(r.choices("bcdfghjkpqvwxyz", k=len(a))))
    assert passed >= 0.98 * 500
    assert V.jaro_winkler("martha", "marhta") > 0.96 and V.jaro_winkler("", "a") == 0.0
    assert not V._alike("falgagoshi", "fokkodekge") and not V._alike("lo", "li") and not V._alike("kim", "tim") and V._alike("ann", "ana")


def test_nicknames_are_learnt_from_the_corpus(spark):
    """No table: an irregular short form stated by aliases, a regular one met in a family, one met in several families."""
    p = "Person"
    rows = [
        ("Oz Perti", p, ["Oswald Perti"]), ("Oz Kalbo", p, []), ("Oswald Kalbo", p, []), ("Christopher Lund", p, []), ("Chris Lund", p, []),
        *[(f"{g} {f}", p, []) for f in ("Moser", "Tamm", "Quist") for g in ("Hesper", "Hed")], ("Anna Moser", p, []), ("Anselm Moser", p, []),
    ]
    df = spark.createDataFrame([(i, n, t, a, "x") for i, (n, t, a) in enumerate(rows)], SCHEMA)
    got = {frozenset((rows[r.a][0], rows[r.b][0])) for r in V.linked_pairs(V.groups(df, nicknames={})).collect()}
    want = together("Oz Kalbo", "Oswald Kalbo") | together("Christopher Lund", "Chris Lund")
    for f in ("Moser", "Tamm", "Quist"):
        want |= together(f"Hesper {f}", f"Hed {f}")
    assert got == want


def test_large_families_teach_nicknames_and_chance_does_not(spark):
    """Families with more given names alike than any bound: an irregular nickname in three, regular ones in one; a given name beside families alike; popular names."""
    p = "Person"
    given = ["Hanno", "Helmine", "Hiltrud", "Holgerd", "Hubertus", "Hyazinth", "Haldane", "Heribert", "Horatio", "Hadewig", "Hinrike", "Holda", "Hulderic", "Hermina", "Hektor", "Hildebrand", "Hannelore", "Hrodric", "Hasso", "Henrike", "Hellmut"]
    names = [f"{g} {f}" for i, f in enumerate(("Moser", "Tamm", "Quist")) for g in ("Hesper", "Hed", *given[i * 7 : i * 7 + 7])]
    names += [f"{g} Lund" for g in ("Christopher", "Chris", "Charlotte", "Charlie", "Carolus", "Clemency", "Cordula", "Cyprian", "Cunegund", "Cosmina")]
    # two families that share a popular given name; it stands before many others alike
    names += [f"{g} {f}" for g in ("Jonas", "Marit") for f in ("Rich", "Richards", "Rasmus", "Rudnik", "Rokitan", "Rydberg", "Rehmann", "Rosander")]
    # one name in every family, beside another in half of them
    names += [f"{g} {f}" for i, f in enumerate(("Abendroth", "Brinkmann", "Dorfler", "Falkner", "Gutzeit", "Kaminski", "Ostrander", "Wexford")) for g in ("Leopolda", "Lia" if i % 2 else "Lugard")]
    df = spark.createDataFrame([(i, n, p, [], "x") for i, n in enumerate(names)], SCHEMA)
    got = {frozenset((names[r.a], names[r.b])) for r in V.linked_pairs(V.groups(df, nicknames={})).collect()}
    want = together("Christopher Lund", "Chris Lund") | together("Charlotte Lund", "Charlie Lund")
    for f in ("Moser", "Tamm", "Quist"):
        want |= together(f"Hesper {f}", f"Hed {f}")
    assert got == want


def test_abbreviations():
    assert all(V._abbreviates(a, b) for a, b in (("dept", "department"), ("agcy", "agency"), ("inst", "institute"), ("wtr", "water"), ("env", "environment"), ("pship", "partnership")))
    assert not any(V._abbreviates(a, b) for a, b in (("water", "waste"), ("air", "fair"), ("agency", "agency"), ("a", "air")))


def test_one_error_keeps_a_common_code():
    r = random.Random(2)
    for _ in range(400):
        a = r.choice("bkt") + "".join(r.choices("aeioubcdfgklmnprstvz", k=9))
        i = r.randrange(1, 9)
        b = r.choice([a[:i] + a[i + 1 :], a[:i] + r.choice("aeklmnrst") + a[i:], a[:i] + r.choice("aeklmnrst") + a[i + 1 :]])
        assert set(V.without_one(V.phonetic(a))) & set(V.without_one(V.phonetic(b))), (a, b)


def test_common_and_own_nicknames(spark):
    rows = [(n, "Person", None) for n in ("Bill Bennorekhe", "William Bennorekhe", "Zuk Kalbo", "Alexzukar Kalbo")]
    assert linked(spark, rows) == together("Bill Bennorekhe", "William Bennorekhe")
    df = spark.createDataFrame([(i, n, t, a, "x") for i, (n, t, a) in enumerate(rows)], SCHEMA)
    assert {(r.a, r.b) for r in V.linked_pairs(V.groups(df, nicknames={"zuk": "alexzukar"})).collect()} == {(2, 3)}
