"""Spelling variants of persons' and organisations' names, linked.

Names (and aliases, which are spellings too) are parsed into token sets: titles, legal forms,
case, accents, order and middle initials drop out, nicknames are written in full. Nicknames are
those of a caller's table (common English ones by default) and those that the corpus shows: one
given name beside another under the same family name, stated by aliases or met in several
families, more than chance brings them together. No family is too large to count. What is left equal is one node. Nodes meet in blocks keyed by the phonetic codes of their sorted tokens, each
code also with any one sign left out, so a single typing error cannot part two spellings. Pairs
of a block are compared token by token: Jaro-Winkler as high as one replaced letter leaves it at
that length, or one token an abbreviation of the other; two words that many bodies share are
never one word spelt wrong. Accepted pairs become components.

Short forms (an initial with a family name, an acronym) never join components. Each row of one
means what the row's aliases say; without aliases it means the only component it fits, and
nothing if it fits several.

Defined results: null and blank names are in no group; a type other than person or organisation
too; a null type is read from the name's own shape; repeated rows count once; a null row id is
ignored. Columns other than those named are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import map_rows
from loomgraph.llm.components import components
from loomgraph.session import broadcast_if_small, materialize

PERSON_TYPES = ("person", "people", "individual")
ORG_TYPES = ("organisation", "organization", "governmentagency", "agency", "company", "institution")
TITLES = frozenset("mr mrs ms miss mx dr prof professor ir sir dame mdm madam rev hon eng herr frau sr sra mme".split())
#: Fixed: common short given names in English.
COMMON_NICKNAMES = {
    "abby": "abigail", "alec": "alexander", "andy": "andrew", "barb": "barbara", "becky": "rebecca", "ben": "benjamin", "beth": "elizabeth", "betty": "elizabeth", "bill": "william", "billy": "william", "bob": "robert", "bobby": "robert", "cathy": "catherine", "charlie": "charles", "chuck": "charles", "dan": "daniel", "dave": "david", "debbie": "deborah", "dick": "richard",
    "ed": "edward", "eddie": "edward", "fred": "frederick", "greg": "gregory", "jeff": "jeffrey", "jenny": "jennifer", "jim": "james", "jimmy": "james", "joe": "joseph", "josh": "joshua", "judy": "judith", "ken": "kenneth", "larry": "lawrence", "liz": "elizabeth", "maggie": "margaret", "matt": "matthew", "meg": "margaret", "mick": "michael", "mike": "michael",
    "nick": "nicholas", "peggy": "margaret", "pete": "peter", "phil": "philip", "rick": "richard", "rob": "robert", "ron": "ronald", "steve": "stephen", "sue": "susan", "ted": "edward", "tim": "timothy", "tom": "thomas", "tony": "anthony", "vicky": "victoria", "vince": "vincent", "walt": "walter", "zach": "zachary",
}
#: A nickname is learnt from so many families that have both names, one whose aliases state it or a regular short form counting twice, from such a share of
#: all the names it is met beside and of all its families.
NICKNAME_MIN, NICKNAME_SHARE, NICKNAME_FAMILIES = 2, 0.5, 0.25
#: Of a name's two words one is no family if it is written as such less often than the other by so many standard errors.
ROLE_ERRORS = 2
#: A word in so many names of bodies, and in such a share of those that the commonest is in, is a word of the language; a token in so many names of persons is a given name.
COMMON_MIN, COMMON_SHARE = 4, 0.02
BROADCAST_ROWS = 300_000
BODIES = frozenset("agency authority board council commission committee department directorate institute ministry office partnership trust association society bureau foundation centre center company corporation university college".split())
LEGAL = frozenset("inc incorporated ltd limited llc plc pte gmbh corp co sa bv nv pty llp".split())
#: What Jaro-Winkler may lose beyond one replaced letter; and, between a name and its own alias, beyond two. Repeated letters that match crosswise cost some of it.
SLACK = 0.03


def fold(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).replace("ı", "i")


_CODE = str.maketrans("bfpvcgjkqsxzdtlmnr", "111122222222334556")


def phonetic(token: str) -> str:
    """First letter, then the classes of the consonants that follow; vowels, h, w and y have none.

    Repeats stay, so that one error in the token is at most one in the code.
    """
    return token[0] + "".join(c for c in token[1:].translate(_CODE) if c.isdigit())


def without_one(code: str) -> list[str]:
    """The code itself and with any one sign left out, the first as well."""
    return list(dict.fromkeys([code, *(code[:i] + code[i + 1 :] for i in range(1, len(code))), "_" + code[1:]]))


def _jaro(a: str, b: str) -> float:
    la, lb = len(a), len(b)
    reach = max(0, max(la, lb) // 2 - 1)
    used = [False] * lb
    ma = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(lb, i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                ma.append(c)
                break
    if not ma:
        return 0.0
    mb = [b[j] for j in range(lb) if used[j]]
    t = sum(x != y for x, y in zip(ma, mb, strict=True)) / 2
    m = len(ma)
    return (m / la + m / lb + (m - t) / m) / 3


def jaro_winkler(a: str, b: str) -> float:
    """Read from either end, since a repeated letter may find the wrong one of its like from one of them."""
    if a == b:
        return 1.0
    j = max(_jaro(a, b), _jaro(a[::-1], b[::-1]))
    p = 0
    while p < min(4, len(a), len(b)) and a[p] == b[p]:
        p += 1
    return j + p * 0.1 * (1 - j)


def least(a: str, b: str, letters: int = 1) -> float:
    """Jaro-Winkler of two words of these lengths and this common start that differ in so many replaced letters."""
    j = 1 - 2 * letters / (3 * max(len(a), len(b)))
    p = 0
    while p < min(4, len(a), len(b)) and a[p] == b[p]:
        p += 1
    return j + p * 0.1 * (1 - j) - SLACK


# ---- parsing ----------------------------------------------------------------------------------
def parse_person(name: str, nicknames: Mapping[str, str] = COMMON_NICKNAMES) -> dict | None:
    """tokens (sorted, nicknames in full) with ``family``, the one written last or before a comma; or an initial with one token: short."""
    text = re.sub(r"['’`]", "", fold(name).lower())
    words = re.findall(r"[^\W\d_]+", text)
    while words and words[0] in TITLES:
        words = words[1:]
    words = [w for w in words if w not in TITLES] or words
    full, initials = [w for w in words if len(w) > 1], [w for w in words if len(w) == 1]
    if not full:
        return None
    if len(full) == 1:
        return {"short": True, "tokens": full, "initial": initials[0] if initials else ""}
    head = [w for w in re.findall(r"[^\W\d_]+", text.split(",")[0]) if len(w) > 1 and w in full]
    last = (head or full)[-1]
    return {"short": False, "tokens": sorted(nicknames.get(w, w) for w in full), "initial": "", "family": nicknames.get(last, last)}


def parse_org(name: str) -> dict | None:
    """tokens (sorted), with ``acronym`` for a part in capitals; all capitals of up to six letters: short."""
    text = fold(name).strip()
    bracket = re.search(r"\(([A-Z]{2,7})\)\s*$", text)
    text = re.sub(r"\([^()]*\)", " ", text)
    if re.fullmatch(r"(?:[A-Z]\.?){2,7}", text.strip()):
        return {"short": True, "tokens": [re.sub(r"\.", "", text.strip()).lower()], "initial": "", "acronym": ""}
    shout = not re.search(r"[a-z]", text)
    words, acronym = [], ""
    for raw in re.findall(r"[^\W\d_]+(?:['’][^\W\d_]+)*", text):
        if not shout and re.fullmatch(r"[A-Z]{2,6}", raw) and raw.lower() not in LEGAL:
            acronym += raw.lower()
            continue
        w = re.sub(r"['’]", "", raw.lower())
        if w in ("the", "of", "and", "for", "de") or w in LEGAL:
            continue
        words.append(w)
    if not words:
        return None
    return {"short": False, "tokens": sorted(words), "initial": bracket[1].lower() if bracket else "", "acronym": acronym}


def parse(kind: str, name: str, nicknames: Mapping[str, str] = COMMON_NICKNAMES) -> dict | None:
    return parse_person(name, nicknames) if kind == "person" else parse_org(name)


def keys_of(kind: str, p: dict) -> list[str]:
    """Block keys of a full form; words for bodies make none."""
    out = set()
    if kind == "person":
        for a, b in combinations(p["tokens"], 2):
            ca, cb = phonetic(a), phonetic(b)
            out |= {"p" + "|".join(sorted((v, cb))) for v in without_one(ca)} | {"p" + "|".join(sorted((ca, v))) for v in without_one(cb)}
    else:
        own = [t for t in p["tokens"] if t not in BODIES]
        size = len(p["tokens"]) + len(p["acronym"])
        for t in own:
            # the other words' initials hold an error in this one's first letter together
            rest = list(p["tokens"])
            rest.remove(t)
            first = "".join(sorted([x[0] for x in rest] + list(p["acronym"])))
            out |= {f"o{size}{first}|{v}" for v in without_one(phonetic(t))}
        if not out:
            out.add("o" + "".join(sorted([t[0] for t in p["tokens"]] + list(p["acronym"]))))
    return sorted(out)


# ---- comparing --------------------------------------------------------------------------------
def _alike(a: str, b: str, letters: int = 1) -> float:
    if a == b:
        return 1.0
    if min(len(a), len(b)) < 3 or min(len(a), len(b)) < 4 and a[0] != b[0]:
        return 0.0
    s = jaro_winkler(a, b)
    return s if s >= least(a, b, letters) else 0.0


def _abbreviates(a: str, b: str) -> bool:
    """``a`` is ``b`` cut short, without its vowels, or some of its letters with the first and the last."""
    if len(a) >= len(b) or len(a) < 2 or a[0] != b[0]:
        return False
    it = iter(b)
    return b.startswith(a) or (not re.search("[aeiou]", a[1:]) or a[-1] == b[-1] and len(a) <= 5) and all(c in it for c in a)


def same(kind: str, a: list[str], b: list[str], acr_a: str = "", acr_b: str = "", alias: bool = False, common: frozenset[str] = frozenset()) -> bool:
    """Every token of one has its own counterpart in the other."""
    letters = 2 if alias else 1
    known = BODIES | common
    rest = list(b)
    left = []
    for x in a:
        if x in rest:
            rest.remove(x)
        else:
            left.append(x)
    open_ = []
    for x in left:
        best, at = 0.0, -1
        for i, y in enumerate(rest):
            # two words of the language are not one spelt wrong
            s = 0.0 if x in known and y in known else _alike(x, y, letters)
            if not s and kind == "org" and (_abbreviates(x, y) or _abbreviates(y, x)):
                s = 0.9
            if s > best:
                best, at = s, i
        if at < 0:
            open_.append(x)
        else:
            rest.pop(at)
    if kind == "person":
        # a further given name may be missing on one side
        return not (open_ and rest) and len(a) - len(open_) >= 2
    if acr_a and not acr_b:
        return not open_ and sorted(y[0] for y in rest) == sorted(acr_a)
    if acr_b and not acr_a:
        return not rest and sorted(x[0] for x in open_) == sorted(acr_b)
    return acr_a == acr_b and not open_ and not rest


# ---- plan -------------------------------------------------------------------------------------
_FORM = "kind string, form string, short boolean, tokens array<string>, initial string, acronym string, family string"


def _parsed(forms: DataFrame, nicknames: Mapping[str, str]) -> DataFrame:
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for kind, form in zip(pdf["kind"], pdf["form"], strict=True):
            if p := parse(kind, form, nicknames):
                out.append((kind, form, p["short"], p["tokens"], p["initial"], p.get("acronym", ""), p.get("family", "")))
        return pd.DataFrame(out, columns=["kind", "form", "short", "tokens", "initial", "acronym", "family"])

    return map_rows(forms, fn, _FORM)


def _shared(forms: DataFrame) -> DataFrame:
    """(kind, token, n): tokens by the number of distinct names that have them."""
    names = forms.filter("not short").select("kind", "tokens", "acronym").distinct()
    n = materialize(names.select("kind", F.explode(F.array_distinct("tokens")).alias("token")).groupBy("kind", "token").agg(F.count("*").alias("n")).filter(F.col("n") >= COMMON_MIN), "shared")
    most = n.groupBy("kind").agg(F.max("n").alias("most"))  # a row a kind
    return n.join(F.broadcast(most), "kind").filter(F.col("n") >= F.col("most") * COMMON_SHARE).drop("most")


def _guessed(untyped: DataFrame, shared: DataFrame) -> DataFrame:
    """(kind, form) of names without type: an organisation by a body's word, a person by a title, else what has more names with its words."""
    word = F.explode(F.regexp_extract_all(F.lower("form"), F.lit(r"[\p{L}]+"), F.lit(0))).alias("token")
    words = untyped.select("form", word).distinct()
    body, title = F.col("token").isin(sorted(BODIES)), F.col("token").isin(sorted(TITLES))
    own = words.filter(body | title).select("form", F.when(body, "org").otherwise("person").alias("kind"), F.when(body, F.lit(1 << 40)).otherwise(F.lit(1 << 39)).alias("n"))
    met = words.join(shared.filter("token not in ('of', 'and')"), "token").select("form", "kind", "n")
    return own.unionByName(met).groupBy("form", "kind").agg(F.sum("n").alias("n")).groupBy("form").agg(F.max_by("kind", F.struct("n", "kind")).alias("kind")).select("kind", "form")


def _families(people: DataFrame) -> DataFrame:
    """(family, x): names of two words by the word that is the family; both ways where the order in which their words are written elsewhere does not tell."""
    two = people.filter("size(tokens) = 2").select("tokens", "family").distinct()
    word = two.select("family", F.explode("tokens").alias("x")).groupBy("x").agg(F.count("*").alias("n"), F.count_if(F.col("x") == F.col("family")).alias("k"))
    role = (F.col("k") + 1) / (F.col("n") + 2)
    word = word.select("x", role.alias("role"), (role * (1 - role) / (F.col("n") + 2)).alias("error"))
    side = lambda s: word.select(F.col("x").alias(s), F.col("role").alias(f"r{s}"), F.col("error").alias(f"e{s}"))
    both = two.select(F.get("tokens", F.lit(0)).alias("a"), F.get("tokens", F.lit(1)).alias("b")).distinct().join(side("a"), "a").join(side("b"), "b")
    both = both.withColumn("margin", ROLE_ERRORS * F.sqrt(F.col("ea") + F.col("eb")))
    one = both.filter("ra >= rb - margin").select(F.col("a").alias("family"), F.col("b").alias("x"))
    return one.unionByName(both.filter("rb >= ra - margin").select(F.col("b").alias("family"), F.col("a").alias("x"))).distinct()


def _beyond_chance(f: Column, expected: Column, names: Column) -> Column:
    """So many families are more than chance lets the likeliest of so many names have (Chernoff's bound of a Poisson count); none expected, any is."""
    return (expected <= 0) | ((f > expected) & (f * (F.log(f) - F.log(expected)) - f + expected > F.log(names)))


def _learnt(named: DataFrame, forms: DataFrame) -> DataFrame:
    """(token, full): nicknames, by families that have both, whether aliases state it or the names begin alike."""
    people = forms.filter("kind = 'person' and not short").select("form", "tokens", "family")
    j = named.filter("kind = 'person'").select("form", "other").join(people.drop("family"), "form").join(people.select(F.col("form").alias("other"), F.col("tokens").alias("theirs")), "other")
    x, y, both = F.array_except("tokens", "theirs"), F.array_except("theirs", "tokens"), F.array_intersect("tokens", "theirs")
    stated = j.select(x.alias("x"), y.alias("y"), both.alias("both")).filter("size(x) = 1 and size(y) = 1 and size(both) >= 1").select(F.get("x", F.lit(0)).alias("x"), F.get("y", F.lit(0)).alias("y"), F.get("both", F.lit(0)).alias("family"), F.lit(2).alias("n"))
    own = materialize(_families(people).withColumn("letter", F.substring("x", 1, 1)), "families")
    met = own.join(own.withColumnRenamed("x", "y"), ["family", "letter"]).filter("length(x) + 1 < length(y)").select("x", "y", "family", F.lit(1).alias("n"))
    # the shorter is the nickname; what may be a typing error is none
    p = stated.unionByName(met).filter("length(x) <> length(y) and levenshtein(x, y) > 1")
    shorter = F.length("x") < F.length("y")
    p = p.select(F.when(shorter, F.col("x")).otherwise(F.col("y")).alias("token"), F.when(shorter, F.col("y")).otherwise(F.col("x")).alias("full"), "family", "n")
    # a start of the name, with or without a doubled consonant or an ending of pet names, is a regular short form
    stem = F.regexp_replace(F.regexp_replace("token", r"(?<=..)(?:ie|[aeiouy])$", ""), r"(?<=..)([^aeiou])\1$", "$1")
    regular = F.col("full").startswith(F.col("token")) | (F.length(stem) > 2) & F.col("full").startswith(stem)
    p = p.withColumn("n", F.when(regular, F.lit(2)).otherwise(F.col("n"))).filter("length(full) > length(token) + 1").groupBy("token", "full", "family").agg(F.max("n").alias("n"))
    # families of a name, other names alike that it meets there, and all alike in them
    alike = own.groupBy("family", "letter").agg(F.count("*").alias("size"))
    families = materialize(own.join(alike, ["family", "letter"]).groupBy("x", "letter").agg(F.count("*").alias("families"), F.sum(F.col("size") - 1).alias("others"), F.sum("size").alias("there")), "given")
    letters = families.groupBy("letter").agg(F.sum("families").alias("total"), F.count("*").alias("names"))
    # of an irregular one that no alias states the full name must be a given name by its families, and be met more often than families without the nickname let expect
    n = p.groupBy("token", "full").agg(F.sum("n").alias("n"), F.count("*").alias("f"), F.max("n").alias("best"))
    n = n.join(families.select(F.col("x").alias("full"), F.col("families").alias("wide")), "full", "left")
    n = n.join(families.join(letters, "letter").select(F.col("x").alias("token"), "others", "there", "total", "names"), "token", "left")
    expected = F.when(F.col("total") > F.col("there"), F.col("others") * (F.col("wide") - F.col("f")) / (F.col("total") - F.col("there"))).otherwise(0.0)
    n = n.filter((F.col("best") > 1) | (F.col("wide") > 2) & _beyond_chance(F.col("f"), expected, F.col("names")))
    best = n.groupBy("token").agg(F.max_by(F.struct("full", "n", "f"), F.struct("n", "full")).alias("b"), F.sum("n").alias("all"))
    best = best.join(families.select(F.col("x").alias("token"), "families"), "token")
    return best.filter((F.col("b.n") >= NICKNAME_MIN) & (F.col("b.n") >= F.col("all") * NICKNAME_SHARE) & (F.col("b.f") >= F.col("families") * NICKNAME_FAMILIES)).select("token", "b.full")


def _in_full(forms: DataFrame, learnt: DataFrame) -> DataFrame:
    """Forms whose tokens have learnt nicknames written in full, with ``norm``."""
    people = forms.filter("kind = 'person' and not short")
    t = people.select("kind", "form", F.explode("tokens").alias("token")).join(broadcast_if_small(learnt, BROADCAST_ROWS), "token", "left")
    t = t.groupBy("kind", "form").agg(F.sort_array(F.collect_list(F.coalesce("full", "token"))).alias("tokens"))
    people = people.drop("tokens").join(t, ["kind", "form"]).select(*forms.columns)
    out = people.unionByName(forms.filter("kind <> 'person' or short"))
    return out.withColumn("norm", F.concat_ws(" ", "tokens", F.nullif(F.upper("acronym"), F.lit(""))))


def _rows(df: DataFrame, row: str, name: str, type_: str, aliases: str) -> DataFrame:
    t = F.lower(F.trim(F.col(type_)))
    kind = F.when(t.isin(*PERSON_TYPES), "person").when(t.isin(*ORG_TYPES), "org").when(t.isNull() | (t == ""), "")
    r = df.select(F.col(row).alias("row"), F.col(name).alias("name"), kind.alias("kind"), F.coalesce(F.col(aliases), F.array().cast("array<string>")).alias("aliases"))
    return r.filter("row is not null and trim(name) <> '' and kind is not null").distinct()


def _compared(pairs: DataFrame) -> DataFrame:
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        ok = [same(k, list(ta), list(tb), xa, xb, bool(al), frozenset(ca) | frozenset(cb)) for k, ta, tb, xa, xb, al, ca, cb in zip(pdf["kind"], pdf["ta"], pdf["tb"], pdf["xa"], pdf["xb"], pdf["alias"], pdf["ca"], pdf["cb"], strict=True)]
        return pdf.loc[ok, ["a", "b"]]

    return map_rows(pairs, fn, "a bigint, b bigint")


def groups(df: DataFrame, row: str = "extraction_id", name: str = "name", type_: str = "type", aliases: str = "aliases", nicknames: Mapping[str, str] = COMMON_NICKNAMES) -> DataFrame:
    """(row, name, group): rows of persons and organisations with the group that means the same one."""
    rows = materialize(_rows(df, row, name, type_, aliases), "rows")
    spelt = rows.select("kind", F.col("name").alias("form")).unionByName(rows.select("kind", F.explode("aliases").alias("form"))).filter("trim(form) <> ''").distinct()
    # a null type learns its kind from rows with the same name, else from its words
    typed = materialize(_parsed(spelt.filter("kind <> ''"), nicknames), "typed")
    shared = _shared(typed)
    untyped = spelt.filter("kind = ''").select("form").join(spelt.filter("kind <> ''").select("form"), "form", "left_anti")
    forms = materialize(typed.unionByName(_parsed(_guessed(untyped, shared), nicknames)), "parsed")
    rows = materialize(
        rows.filter("kind <> ''").unionByName(
            rows.filter("kind = ''").drop("kind").join(forms.groupBy(F.col("form").alias("name")).agg(F.max("kind").alias("kind")), "name").select("row", "name", "kind", "aliases")
        ),
        "kinds",
    )
    named = rows.select("kind", F.col("name").alias("form"), F.explode("aliases").alias("other")).distinct()
    forms = materialize(_in_full(forms, materialize(_learnt(named, forms), "nicknames")), "forms")
    full = forms.filter("not short")
    nodes = full.groupBy("kind", "norm").agg(F.min("tokens").alias("tokens"), F.min("acronym").alias("acronym"))
    words = nodes.filter("kind = 'org'").select("norm", F.explode("tokens").alias("token")).join(broadcast_if_small(shared.filter("kind = 'org'").select("token"), BROADCAST_ROWS), "token").groupBy("norm").agg(F.collect_set("token").alias("common"))
    nodes = nodes.join(words.withColumn("kind", F.lit("org")), ["kind", "norm"], "left").withColumn("common", F.coalesce("common", F.array().cast("array<string>")))
    nodes = materialize(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")  # written, so the ids stay

    def keyed(pdf: pd.DataFrame) -> pd.DataFrame:
        ks = [keys_of(k, {"tokens": list(t), "acronym": x}) for k, t, x in zip(pdf["kind"], pdf["tokens"], pdf["acronym"], strict=True)]
        n = pdf.loc[pdf.index.repeat([len(k) for k in ks]), ["id"]].reset_index(drop=True)
        n["key"] = [k for one in ks for k in one]
        return n

    keys = materialize(map_rows(nodes.select("id", "kind", "tokens", "acronym"), keyed, "id bigint, key string"), "keys")
    met = keys.alias("l").join(keys.alias("r"), F.expr("l.key = r.key and l.id < r.id")).select(F.col("l.id").alias("a"), F.col("r.id").alias("b")).distinct().withColumn("alias", F.lit(False))
    at = full.join(nodes.select("kind", "norm", "id"), ["kind", "norm"]).select("kind", F.col("form"), "id")
    said = named.join(at, ["kind", "form"]).select("kind", F.col("id").alias("x"), F.col("other").alias("form")).join(at, ["kind", "form"]).filter("x <> id")
    said = said.select(F.least("x", "id").alias("a"), F.greatest("x", "id").alias("b")).distinct().withColumn("alias", F.lit(True))
    pairs = met.unionByName(said).groupBy("a", "b").agg(F.max("alias").alias("alias"))
    side = lambda s: nodes.select(F.col("id").alias(s), *([F.col("kind")] if s == "a" else []), F.col("tokens").alias(f"t{s}"), F.col("acronym").alias(f"x{s}"), F.col("common").alias(f"c{s}"))
    edges = _compared(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "kind", "ta", "tb", "xa", "xb", "alias", "ca", "cb"))
    found = components(edges)
    label = nodes.join(found, nodes["id"] == found["node"], "left").select("kind", "norm", "tokens", "id", F.coalesce("group", "id").alias("group"))
    label = materialize(label, "labels")
    form_group = materialize(full.join(label.select("kind", "norm", "group"), ["kind", "norm"]).select("kind", "form", "tokens", "initial", "group"), "formgroups")

    plain = rows.join(form_group.select("kind", F.col("form").alias("name"), "group"), ["kind", "name"]).select("row", "name", F.concat(F.lit("n"), F.col("group").cast("string")).alias("group"))
    brief = rows.join(forms.filter("short").select("kind", F.col("form").alias("name"), F.col("tokens")[0].alias("token"), "initial"), ["kind", "name"]).select("row", "name", "kind", "aliases", "token", "initial")
    return materialize(plain.unionByName(_short_groups(brief, form_group, rows, forms)), "groups")  # read several times by those who pair rows


def _short_groups(brief: DataFrame, form_group: DataFrame, rows: DataFrame, forms: DataFrame) -> DataFrame:
    """Groups of rows whose name is a short form: by their aliases, else by the only group that fits."""
    brief = materialize(brief, "brief")
    said = brief.select("row", "name", "kind", "token", "initial", F.explode("aliases").alias("form")).join(form_group.select("kind", "form", "tokens", "group"), ["kind", "form"])
    # an alias must be able to stand for the short form
    fits = F.when(F.col("kind") == "person", F.exists("tokens", lambda t: F.levenshtein(t, F.col("token")) <= 2)).otherwise(F.size("tokens") > 0)
    by_alias = materialize(said.filter(fits).groupBy("row", "name").agg(F.min("group").alias("group"), F.count_distinct("group").alias("n")).filter("n = 1"), "byalias")
    rest = brief.join(by_alias.select("row", "name"), ["row", "name"], "left_anti")

    # persons: the initial of one token, the other token itself or one of its codes
    two = form_group.filter("kind = 'person'").select("tokens", "group").distinct()
    roles = two.select("group", F.explode(F.transform("tokens", lambda t, i: F.struct(t.alias("family"), F.substring(F.element_at(F.array_except("tokens", F.array(t)), 1), 1, 1).alias("initial")))).alias("x")).select("group", "x.*").distinct()
    want = rest.filter("kind = 'person'").select("row", "name", "token", "initial")
    exact = want.join(roles, (F.col("family") == F.col("token")) & (roles["initial"] == want["initial"])).select("row", "name", "group")
    exact = exact.groupBy("row", "name").agg(F.min("group").alias("group"), F.count_distinct("group").alias("n"))
    open_ = want.join(exact.select("row", "name"), ["row", "name"], "left_anti")
    coded = _coded(open_.select("token", "initial").distinct(), "token").select("token", F.col("initial").alias("i"), "code")
    near = coded.join(_coded(roles.withColumnRenamed("family", "f"), "f"), "code").filter("i = initial and levenshtein(token, f) <= 2").select("token", "i", "f", "group").distinct()
    near = _close(near).groupBy("token", "i").agg(F.min("group").alias("group"), F.count_distinct("group").alias("n"))
    near = open_.join(near, (open_["token"] == near["token"]) & (open_["initial"] == near["i"])).select("row", "name", "group", "n")
    people = materialize(exact.unionByName(near), "people")
    alone = want.join(people.select("row", "name"), ["row", "name"], "left_anti").filter("initial <> ''").select("row", "name", F.concat_ws("|", F.lit("s"), "initial", "token").alias("group"))

    # acronyms: what other rows of the acronym, or names that carry it as alias or in brackets, say
    acr = rows.filter("kind = 'org'").join(form_group.filter("kind = 'org'").select(F.col("form").alias("name"), "group"), "name").select(F.explode("aliases").alias("form"), "group")
    acr = acr.join(forms.filter("short and kind = 'org'").select("form", F.col("tokens")[0].alias("token")), "form").select("token", "group")
    acr = acr.unionByName(form_group.filter("kind = 'org' and initial <> ''").select(F.col("initial").alias("token"), "group"))
    acr = acr.unionByName(brief.filter("kind = 'org'").select("row", "token").join(by_alias.select("row", "group"), "row").select("token", "group"))
    acr = acr.distinct().groupBy("token").agg(F.min("group").alias("group"), F.count("*").alias("n")).filter("n = 1")
    bodies = rest.filter("kind = 'org'").select("row", "name", "token").join(acr, "token").select("row", "name", "group")
    sure = by_alias.select("row", "name", "group").unionByName(people.filter("n = 1").select("row", "name", "group")).unionByName(bodies)
    return sure.select("row", "name", F.concat(F.lit("n"), F.col("group").cast("string")).alias("group")).unionByName(alone)


def _coded(df: DataFrame, token: str) -> DataFrame:
    """Rows once for each phonetic code, whole and short of one sign, of a token."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        codes = [without_one(phonetic(t)) for t in pdf[token]]
        out = pdf.loc[pdf.index.repeat([len(c) for c in codes])].reset_index(drop=True)
        out["code"] = [c for one in codes for c in one]
        return out

    return map_rows(df, fn, f"{fields}, code string")


def _close(df: DataFrame) -> DataFrame:
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf[[_alike(a, b) > 0 for a, b in zip(pdf["token"], pdf["f"], strict=True)]]

    return map_rows(df, fn, "token string, i string, f string, `group` bigint")


def linked_pairs(grouped: DataFrame) -> DataFrame:
    """(a, b): rows of one group whose names differ as written, smaller id first.

    Pairs of spellings are formed first, so rows of one spelling are never paired with each other.
    """
    spelt = grouped.select("group", "name").distinct()
    other = spelt.select("group", F.col("name").alias("name_b"))
    differ = spelt.join(other, "group").filter("name < name_b")
    one = grouped.select("group", "name", F.col("row").alias("x")).distinct()
    two = grouped.select("group", F.col("name").alias("name_b"), F.col("row").alias("y")).distinct()
    j = differ.join(one, ["group", "name"]).join(two, ["group", "name_b"]).filter("x <> y")
    return j.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
