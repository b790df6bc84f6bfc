"""Personal information in free text: found by votes of weak labellers, replaced by placeholders.

Candidates are wide: everything shaped like an e-mail address, a number, a numbered street or a
name. Labellers vote yes, no or not at all on each: shapes, labels before it, contact details
beside it, the same name elsewhere in the document, words that make an organisation or a place,
and two gazetteers that the corpus itself gives: words met in names behind titles and labels, and
words met in small letters. Expectation-maximisation over the counts of vote patterns estimates
how reliable each labeller is, without any label. Its posteriors train the final span classifier,
a logistic regression on votes, shape and the words around, each half of the time without the
votes, so that shape and context can carry a span that no labeller knows, or stop one; candidates on
which no labeller votes are not fitted to.

The patterns of all candidates of all documents are counted by Spark; the classifier is fitted on
some ``SAMPLE`` candidates a kind, taken by hash within each pattern, and scores every candidate.

Defined results: null and empty texts have no spans; positions are code points from 1; spans of
one kind never overlap, of two kinds only the one earlier in ``KINDS`` is replaced; a repeated
row gives the same spans once; without any candidate nothing is trained and nothing found.
Evidence is looked for within ``REACH`` signs of a candidate. Columns other than those named are
ignored (``redact`` returns only id and text).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import map_rows, spread
from loomgraph.session import broadcast_if_small, materialize

KINDS = ("email", "id_number", "phone", "address", "person")
#: Candidates of a kind the classifier is fitted on; signs around a candidate in which evidence counts; size of the hashed feature space.
SAMPLE, REACH, FEATURES, WIDTH = 10_000, 80, 1 << 13, 7
#: A word is of the names' gazetteer from so many sightings behind a title or label, or in a name's own form, and from such a share of its sightings in name candidates.
GAZETTEER_MIN, GAZETTEER_SHARE = 3, 0.2
BROADCAST_ROWS = 400_000

# ---- shapes -----------------------------------------------------------------------------------
_AT = r"(?:@| ?[\[(](?:at|AT)[\])] ?)"
_AT_WORD = re.compile(r"[\[(](?:at|AT)[\])]")
_DOT = r"(?:\.| ?[\[(](?:dot|DOT)[\])] ?| (?:dot|DOT) )"
_EMAIL = re.compile(rf"(?<![\w.+%-])(?P<local>[A-Za-z0-9_%+-]+(?:\.[A-Za-z0-9_%+-]+)*)(?P<at>{_AT})(?P<domain>[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)*)")
_HAS_DOT = re.compile(_DOT)
_NUMBER = re.compile(r"(?<![\w/.,#-])(?:\+ ?\d|\(\d|\d)(?:[\d ()/-]|\.(?=\d)){5,20}\d(?:(?: ext\.? ?| x| extn?\.? ?)\d{1,5})?(?![\w/]|[.,-]\d)")
_EXT = re.compile(r" ?(?:ext|x)")
_PHONE_SHAPE = re.compile(r"\+ ?\d{1,3}[ .-]?(?:\(\d+\)[ .-]?)?\d[\d .-]{5,}|00\d{2,3}[ .-]?\d[\d .-]{5,}|\(0?\d{1,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}|0\d{2,4}[ .-]\d{3,4}[ .-]\d{3,4}|\d{3}[ -]\d{4}(?: \d{2})?|\d{3}[.-]\d{3}[.-]\d{4}")
_YEARS = re.compile(r"(?:1[89]|20)\d\d[ /-]+(?:1[89]|20)\d\d")
_ID = re.compile(r"(?<![\w/@.-])(?:[A-Za-z]{1,3}[ /-]?\d[\d /-]{4,}\d[A-Za-z]?|\d{3,4}-\d{3,4}-\d{2,4}|\d{6,9}[A-Za-z]?|\d{2,3}[ -]\d{2,3}[ -]\d{3,4})(?![\w/]|-\d)")
_SMALL = {"on", "to", "of", "in", "au", "at", "by", "is", "was", "and", "or", "as", "de", "am", "im", "en"}
_STREET_WORDS = "Street|St|Road|Rd|Avenue|Ave|Lane|Ln|Drive|Dr|Close|Row|View|Crescent|Cres|Court|Ct|Way|Walk|Terrace|Place|Pl|Square|Sq|Hill|Gate|Rise|Grove|Gardens|Park|Quay|Mews|Boulevard|Blvd|Link|Loop|Circle"
_STREET = rf"(?:[A-ZÀ-Þ][\w'’-]*[ ]){{0,3}}?(?:[A-ZÀ-Þ][\w'’-]*[ ])?(?:{_STREET_WORDS})\b\.?"
_ONE_WORD = r"[A-ZÀ-Þ][a-zà-ÿ]+(?:gate|strasse|straße|gasse|weg|street|bank|way)\b"
_UNITS = "Flat|Unit|Apt|Apartment|Blk|Block|House|Suite|Room|Level|Floor"
_ADDRESS = re.compile(rf"(?<![\w#/.,-])(?=\d|(?:{_UNITS})\b)(?P<unit>(?:{_UNITS})\.?\s+\w{{1,6}}(?:[-/]\w+)?,?\s+)?(?P<house>(?:[A-ZÀ-Þ][\w'’-]*\s){{1,2}}(?:House|Court|Building|Tower|Mansions),\s+)?(?P<no>\d{{1,4}}[A-Za-z]?(?:-\d{{1,4}})?,? +)?(?P<street>{_STREET}|{_ONE_WORD})")
_TITLES = "Mr|Mrs|Ms|Miss|Mx|Dr|Prof|Mdm|Madam|Sir|Sr|Sra|Herr|Frau|Mme|Mlle"
_CAP = r"[A-ZÀ-Þ][^\W\d_]*(?:['’-][A-ZÀ-Þ][^\W\d_]+)*"
#: A run of capitalised words and initials on one line, a title anywhere in it, a comma behind a word in capitals.
_STEP = rf"(?:(?:{_TITLES})\. (?=[A-ZÀ-Þ])|[A-ZÀ-Þ]\.? ?(?=[A-ZÀ-Þ])|{_CAP} (?=[A-ZÀ-Þ]))"
_RUN = re.compile(rf"(?<![\w@.'’/+-])(?=[A-ZÀ-Þ])(?:[A-ZÀ-Þ]{{2,}}(?:['’-][A-ZÀ-Þ]+)*, (?!(?:{_TITLES})\b){_STEP}*|{_STEP}+){_CAP}(?: [A-ZÀ-Þ]\.)?(?![\w@]|[-/]\w)")
_TITLED = re.compile(rf"(?<![\w@.'’/+-])(?:{_TITLES})\.? (?=[A-ZÀ-Þ])")
_TITLE_WORDS = frozenset(_TITLES.split("|"))
_LONG_NUMBER = re.compile(r"\d[\d ()/.-]{4,}\d")
_PART = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*\.?,?")
_LABELLED = re.compile(r"(?i)(?<!\w)(?:name|full name|nombre|nom)[ \t]*:[ \t]*(?P<name>[^\W\d_][^\W\d_'’.-]*,? (?:[^\W\d_]\.? )?[^\W\d_][^\W\d_'’-]*)")
_AROUND = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|\n")

# ---- words around: general knowledge of forms and letters ---------------------------------------
_ID_LABEL = re.compile(
    r"(?i)(?:passport|licen[cs]e|identity|resident|tax|social security|national|insurance|citizen|id card|identification|nric|fin|ssn|ausweis|dni|nie|cédula|passeport)\b[\w ]{0,24}?(?:no\.?|nr\.?|number|file number|card|id|#)?\s*[:.#]?\s*$"
)
_THING_LABEL = re.compile(r"(?i)(?:permit|meter|batch|serial|case(?: number)?|invoice|grid(?: reference)?|reference|order|lot|ticket|version|docket|file|model|part|isbn|issn|period|section|series|account|plot|station|code|sample|item|figure|table)\s*(?:no\.?|number|nr\.?|#|id)?\s*[:.#]?\s*$")
_PHONE_LABEL = re.compile(r"(?i)(?:tel(?:ephone|éfono|efon)?|phone|mobile|cell|fax|hotline|whatsapp|call|ring|dial|phone to|handy)\s*[.:]?\s*$")
_ID_WORD = re.compile(r"(?i)(?:no\.?|nr\.?|number|card|licen[cs]e|passport)\s*:?\s*$")
_SENT = re.compile(r"(?i)(?:e-?mail|mailto|write|sent|cc|<|\()\W*(?:\w+ ){0,3}$")
_HANDLE = re.compile(r"(?i)\b(?:handle|user|account|channel)\s*$")
_PLACE_BEFORE = re.compile(r"(?i)(?:\bat|\bof|address\s*:|\blives? in|living at|resides? at|\|)\s*$")
_PART_BEFORE = re.compile(r"(?i)(?:section|table|figure|page|in|during|since|article|total of|about)\s*$")
_TOWN_AFTER = re.compile(r" #\d+-\d+|,?\s+(?:\d{4,6}\s+)?[A-ZÀ-Þ][\w-]+(?:\s+\d{4,6})?")
_FIELD_BEFORE = re.compile(r"(?i)(?:(?<!\w)(?:applicant|contact(?:o| person)?|name|attn|attention|author|signed|tenant|owner|patient|client|customer|employee|witness|complainant|from|ansprechperson|ansprechpartner(?:in)?|interlocuteur|nombre|nom)\s*:\s*|(?:yours (?:faithfully|sincerely|truly)|(?:kind |best )?regards|atentamente|cordialement|mit freundlichen grüßen),?\s*\n\s*)$")
_CONTACT_AFTER = re.compile(r"[\s,;|(<:]*(?:(?:tel|phone|e-?mail|mobile)\b[ .:]*)?[<(]?(?:[\w.+%-]+(?:@| ?[\[(](?:at|AT)[\])])|\+ ?\d[\d -]{5}|\(\d{2,4}\) ?\d{3}|0\d{2,4}[ .-]\d{3}|\d{3}[ .-]\d{4})")
_PAPER_AFTER = re.compile(r", ?(?i:passport|driving licen|identity|national id|resident|tax file|id card|social security)|,? (?:of|at) (?:(?i:flat|unit|apt|blk|block)\b|\d{1,4}[a-z]? [A-ZÀ-Þ][a-zà-ÿ])")
#: Words that begin or fill sentences and dates; a reading of a run that has one is no name.
_FUNCTION = frozenset(
    "the this that these those under over after before with within for from since during across against ahead by in on at as where when while if of and or but please dear yours according our your we you they it its there all both each no not a an to into per tel telephone email mail phone fax page "
    "monday tuesday wednesday thursday friday saturday sunday january february march april may june july august september october november december "
    "el la los las le les die der das des un une una según para por pour im am das den dem von zu bei nach".split()
)
#: Words of organisations, works, rules and places; no reading of a run that has one is a name.
_BODY = frozenset(
    (
        "council board agency institute commission directorate authority office partnership trust department ministry university college school hospital company association society committee bureau foundation bank group club union court church plant station works house centre center scheme programme program project act order regulation regulations rule law code plan report policy service services fund tower building bridge airport port "
        "address table figure section chapter annex appendix number north south east west northern southern eastern western upper lower new old great grand saint lake river mount island valley city town village county district region state republic kingdom " + (_STREET_WORDS + "|" + _UNITS).replace("|", " ").lower()
    ).split()
)
_SURE_SIGNS = re.compile(r"\d{3}|@|[\[(](?:at|AT)[\])]|[A-ZÀ-Þ]|(?i:nombre|nom|name)")


def _code(votes: tuple[int, ...]) -> str:
    return "".join("-0+"[v + 1] for v in votes)


@lru_cache(maxsize=200_000)
def _slot(feature: str) -> int:
    return zlib.crc32(feature.encode()) % FEATURES


def _token(t: str) -> str:
    return "0" if t.isdigit() else t if not t[0].isalpha() else "C" + t.lower() if t[0].isupper() else t


def _among_capitals(text: str, s: int, e: int) -> bool:
    """Most letters around are capitals, so capitals say nothing."""
    letters = [c for c in text[max(0, s - REACH // 2) : s] + text[e : e + REACH // 2] if c.isalpha()]
    return len(letters) > 7 and sum(map(str.isupper, letters)) > 0.6 * len(letters)


def _features(text: str, s: int, e: int, kind: str) -> bytes:
    """Slots of the two words before, the two behind, and of the shape: ``WIDTH`` numbers of two bytes."""
    pre = [_token(x) for x in _AROUND.findall(text[max(0, s - REACH) : s])[-2:]]
    post = [_token(x) for x in _AROUND.findall(text[e : e + REACH])[:2]]
    pre, post = ["^"] * (2 - len(pre)) + pre, post + ["$"] * (2 - len(post))
    span = text[s:e]
    shape = re.sub(r"[^\W\d_]*[^\W\d_A-ZÀ-Þ][^\W\d_]*", lambda m: "Xx" if m[0][0].isupper() else "x", span)
    shape = re.sub(r"\d+", lambda m: "9" if kind == "person" else f"9{min(len(m[0]), 5)}", re.sub(r"[A-ZÀ-Þ]{2,}", "XX", shape))
    if kind == "person" and span.isupper() and _among_capitals(text, s, e):
        shape = "!" + shape
    out = [f"p:{pre[1]}", f"pp:{pre[0]} {pre[1]}", f"n:{post[0]}", f"nn:{post[0]} {post[1]}", f"b:{pre[1]}|{post[0]}", f"s:{shape[:40]}", f"l:{min(len(span) // 5, 8)}"]
    return np.fromiter((_slot(f) for f in out), "<u2", WIDTH).tobytes()


def _before(text: str, at: int) -> str:
    return text[max(0, at - REACH) : at]


def _emails(t: str) -> Iterator[tuple[int, int, str]]:
    if "@" not in t and not _AT_WORD.search(t):
        return
    for m in _EMAIL.finditer(t):
        s, e = m.span()
        plain, has_dot, pre = m["at"] == "@", bool(_HAS_DOT.search(m["domain"])), _before(t, s)
        yield s, e, _code((1 if has_dot else -1, 1 if plain and has_dot else 0, 1 if _SENT.search(pre) else 0, -1 if _HANDLE.search(pre) else 0))


def _phones(t: str) -> Iterator[tuple[int, int, str]]:
    for m in _NUMBER.finditer(t):
        s, e = m.span()
        x = _EXT.split(m[0])[0].rstrip(" .")
        if "(" in m[0] and ")" not in m[0]:
            continue
        n, pre = sum(map(str.isdigit, x)), _before(t, s)
        called = bool(_PHONE_LABEL.search(pre))
        yield s, e, _code((
            1 if _PHONE_SHAPE.fullmatch(x) else -1,
            1 if called else 0,
            -1 if _THING_LABEL.search(pre) or _ID_LABEL.search(pre) or re.search(r"[A-Za-z]{2}-?$", pre) and not called else 0,
            -1 if _YEARS.fullmatch(x) or n < 7 or n > 15 else 0,
            1 if x[0] in "+(" or x.startswith("00") or "ext" in m[0] else 0,
        ))


def _ids(t: str) -> Iterator[tuple[int, int, str]]:
    for m in _ID.finditer(t):
        s, e = m.span()
        if re.match(r"[A-Za-z]*", m[0])[0].lower() in _SMALL:
            continue
        pre = _before(t, s)
        label, thing = bool(_ID_LABEL.search(pre)), bool(_THING_LABEL.search(pre))
        yield s, e, _code((1 if label else -1, -1 if thing and not label else 0, 1 if m[0][0].isalpha() else 0, 1 if label and _ID_WORD.search(pre) else 0, -1 if _PHONE_LABEL.search(pre) and not label else 0))


def _addresses(t: str) -> Iterator[tuple[int, int, str]]:
    for m in _ADDRESS.finditer(t):
        if not (m["unit"] or m["no"]) or m["unit"] and not m["no"] and not re.match(r"Bl(?:oc)?k", m["unit"]):
            continue
        s, e = m.span()
        number = re.match(r"\d+", m["no"]) if m["no"] else None
        pre = _before(t, s)
        yield s, e, _code((
                1 if m["unit"] else 0,
            -1 if number and not m["unit"] and re.fullmatch(r"(?:1[89]|20)\d\d", number[0]) else 0,
            1 if _PLACE_BEFORE.search(pre) else 0,
            1 if _TOWN_AFTER.match(t, e) else 0,
            -1 if _PART_BEFORE.search(pre) else 0,
        ))


def _person_votes(t: str, s: int, e: int, title: bool, run_start: int, locals_: str, titled: dict[str, int], body: bool = False) -> tuple[str, list[str]]:
    """Votes that need no other document: title, field, contact, mail, form, elsewhere, not a person, capitals or length."""
    name = t[s:e]
    words = [w.rstrip(".,") for w in _PART.findall(name)]
    low = [w.lower() for w in words]
    if body and not title:
        return "000000-0", []
    long_ = [w for w in low if len(w) > 2]
    pre, post = _before(t, run_start), t[e : e + REACH]
    shout = name.isupper() and _among_capitals(t, s, e)
    bad = body or any(w in _FUNCTION for w in low if len(w) > 1)
    votes = (
        1 if title else 0,
        1 if (pre.rstrip()[-1:] == ":" or "\n" in pre[-3:]) and _FIELD_BEFORE.search(pre) else 0,
        1 if _CONTACT_AFTER.match(post) or _PAPER_AFTER.match(post) else 0,
        1 if locals_ and any(w in locals_ for w in long_) else 0,
        1 if not shout and (any(len(w) == 1 for w in words) or "," in name) else 0,
        1 if not title and any(titled.get(w, s) != s for w in long_) else 0,
        -1 if bad else 0,
        -1 if shout or len(words) > 4 else 0,
    )
    return _code(votes), low


def _persons(t: str, mails: list[str], blocked: list[tuple[int, int]]) -> Iterator[tuple[int, int, int, str, list[str]]]:
    locals_ = " ".join(mails).lower()
    found: list[tuple[int, int, bool, int, bool]] = []
    for m in _RUN.finditer(t):
        s, e = m.span()
        if blocked and any(a < e and s < b for a, b in blocked):
            continue
        run = m[0]
        if " " not in run:
            continue
        words = run.split(" ")
        if not _BODY.isdisjoint(map(str.lower, words)) and _TITLE_WORDS.isdisjoint(w.rstrip(".") for w in words) and _FUNCTION.isdisjoint(map(str.lower, words)):
            found.append((s, e, False, s, True))
            continue
        title, start = False, s
        for x in _TITLED.finditer(t, s, e):
            title, start, s = True, x.start(), x.end()
        held: list[list[tuple[int, int, str]]] = [[]]
        for p in _PART.finditer(t, s, e):
            if len(p[0]) > 1 and p[0].lower() in _FUNCTION:
                held.append([])
            else:
                held[-1].append((p.start(), p.end(), p[0]))
        for parts in held:
            if not parts or not title and (len(parts) < 2 or all(len(p.rstrip(".,")) < 2 for *_, p in parts)):
                title = False
                continue
            if not title and len(parts) == 2 and parts[1][2].endswith("."):  # a word and an initial that ends the sentence
                continue
            s, e, start = parts[0][0], parts[-1][1], start if title else parts[0][0]
            body = any(p.rstrip(".,").lower() in _BODY for *_, p in parts)
            found.append((s, e, title, start, body))
            # a run may begin or end with a word of the sentence
            if len(parts) > (1 if title else 2) and (title or not body):
                found.append((s, parts[-2][1], title, start, body and len(parts) > 3))
            if len(parts) > 2 and not (title or body) and not parts[0][2].endswith(","):
                found.append((parts[1][0], e, False, start, False))
            title = False
    titled: dict[str, int] = {}
    for s, e, title, *_ in found:
        if title:
            for w in re.findall(r"[^\W\d_]{3,}", t[s:e]):
                titled.setdefault(w.lower(), s)
    for s, e, title, start, body in found:
        votes, words = _person_votes(t, s, e, title, start if title else s, locals_, titled, body)
        yield s, e, start, votes, words
    for m in _LABELLED.finditer(t):
        s, e = m.span("name")
        if t[s].islower():
            votes, words = _person_votes(t, s, e, False, s, locals_, titled)
            yield s, e, s, votes, words


def candidates_of(t: str) -> Iterator[tuple[str, int, int, int, str, list[str]]]:
    """(kind, start, end, run, votes, words) from 0; readings of one run of words have the same ``run``; numbers and names inside a surer shape are none."""
    found = list(_emails(t))
    mails = [(s, e) for s, e, _ in found]
    inside = lambda s, e, spans: any(a < e and s < b for a, b in spans)
    for s, e, v in found:
        yield "email", s, e, s, v, []
    labelled = []
    numbers = _LONG_NUMBER.search(t) is not None  # neither kind is shorter
    for s, e, v in _ids(t) if numbers else ():
        if not inside(s, e, mails):
            if v[0] == "+":
                labelled.append((s, e))
            yield "id_number", s, e, s, v, []
    for s, e, v in _phones(t) if numbers else ():
        if not inside(s, e, mails) and not inside(s, e, labelled):
            yield "phone", s, e, s, v, []
    places = []
    for s, e, v in _addresses(t):
        if not inside(s, e, mails):
            places.append((s, e))
            yield "address", s, e, s, v, []
    for s, e, run, v, w in _persons(t, [t[s:e] for s, e in mails], mails + places):
        yield "person", s, e, run, v, w


_LOWER = re.compile(r"\b[a-zà-ÿ]{2,}\b")
_STARTS = re.compile(r"(?:^|[.!?:\n] ?)([A-ZÀ-Þ][a-zà-ÿ]+) (?=[a-zà-ÿ])")
_CAND = "doc {}, kind string, start int, end int, run int, votes string, words string, slots binary, n bigint"


def candidates(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, kind, start, end, run, votes, words, slots, n) of every candidate; rows of kind 'word' count the words in small letters or at the start of sentences."""
    kind = {f.name: f.dataType.simpleString() for f in docs.schema.fields}[doc]

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, seen = [], Counter()
        for d, t in zip(pdf["doc"], pdf["t"], strict=True):
            if not t:
                continue
            seen.update(_LOWER.findall(t))
            seen.update(w.lower() for w in _STARTS.findall(t))  # a word that begins sentences
            if _SURE_SIGNS.search(t):
                rows += [(d, k, s, e, r, v, " ".join(w), _features(t, s, e, k), 1) for k, s, e, r, v, w in candidates_of(t)]
        rows += [(None, "word", 0, 0, 0, "", w, b"", n) for w, n in seen.items()]
        out = pd.DataFrame(rows, columns=["doc", "kind", "start", "end", "run", "votes", "words", "slots", "n"])
        out["doc"] = out["doc"].astype(object)
        return out

    return map_rows(spread(docs.select(F.col(doc).alias("doc"), F.col(text).alias("t"))), fn, _CAND.format(kind))


def _gazetteers(cand: DataFrame, given: DataFrame | None) -> DataFrame:
    """(word, name, common): words of the names' gazetteer, and words that small letters make common."""
    people = cand.filter("kind = 'person'").select("votes", F.explode(F.split("words", " ")).alias("word"))
    seed = F.substring("votes", 1, 1).eqNullSafe("+") | F.substring("votes", 2, 1).eqNullSafe("+") | F.substring("votes", 4, 2).contains("+")
    per = people.filter("length(word) > 1").groupBy("word").agg(F.count("*").alias("n"), F.count_if(seed).alias("seeds"))
    small = cand.filter("kind = 'word'").select(F.col("words").alias("word"), "n").groupBy("word").agg(F.sum("n").alias("small"))
    j = per.join(small, "word", "left").withColumn("small", F.coalesce("small", F.lit(0)))
    j = j.select("word", ((F.col("seeds") >= GAZETTEER_MIN) & (F.col("seeds") >= F.col("n") * GAZETTEER_SHARE) & (F.col("small") < F.col("n"))).alias("name"), (F.col("small") >= F.col("n")).alias("common"))
    if given is not None:  # a caller's table of given and family names
        j = j.join(given.select(F.lower(F.col(given.columns[0])).alias("word"), F.lit(True).alias("g")).distinct(), "word", "full").select("word", (F.coalesce("g", F.lit(False)) | F.coalesce("name", F.lit(False))).alias("name"), F.coalesce("common", F.lit(False)).alias("common"))
    return j.filter("word is not null and (name or common)")


def _voted(cand: DataFrame, given: DataFrame | None) -> DataFrame:
    """Candidates with the votes of the two gazetteers behind those of their own text."""
    words = materialize(_gazetteers(cand, given), "gazetteer")
    people = cand.filter("kind = 'person'").drop("n").distinct()
    said = people.select("doc", "start", "end", F.explode(F.split("words", " ")).alias("word")).join(broadcast_if_small(words, BROADCAST_ROWS), "word")
    said = said.groupBy("doc", "start", "end").agg(F.max("name").alias("name"), F.max("common").alias("common"))
    said = said.select(*[F.col(c).alias(f"_{c}") for c in ("doc", "start", "end")], "name", "common")
    key = [F.col("doc").eqNullSafe(F.col("_doc")), F.col("start") == F.col("_start"), F.col("end") == F.col("_end")]
    votes = F.concat("votes", F.when(F.col("name"), "+").otherwise("0"), F.when(F.col("common"), "-").otherwise("0"))
    j = people.join(said, key, "left").select("doc", "kind", "start", "end", "run", votes.alias("votes"), "slots")
    rest = cand.filter("kind not in ('person', 'word')").select("doc", "kind", "start", "end", "run", "votes", "slots").distinct()
    return rest.unionByName(j)


# ---- reliabilities and classifier -------------------------------------------------------------
def _onehot(patterns: list[str]) -> np.ndarray:
    return np.array([[[c == "-", c == "0", c == "+"] for c in p] for p in patterns], float)


#: Votes of a labeller (no, none, yes) off and on a span as they are held before any data, and what that is worth: off a span a share of all candidates, on a span so many.
PRIOR_VOTES, OFF_SHARE, ON_WEIGHT = np.array([[0.08, 0.9, 0.02], [0.01, 0.74, 0.25]]), 0.05, 2.0


def estimate(patterns: list[str], counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each pattern, and each labeller's P(vote | class), by expectation-maximisation from the majority of votes.

    Only the direction of a labeller is given: a yes is no evidence against, a no none for a span.
    """
    x = _onehot(patterns)
    score = x[:, :, 2].sum(1) - 1.5 * x[:, :, 0].sum(1)
    q = 1 / (1 + np.exp(-2 * (score - 0.5)))
    like = np.full((x.shape[1], 2, 3), 1 / 3)
    held = (2.0 + OFF_SHARE * counts.sum(), ON_WEIGHT)
    for _ in range(rounds):
        for k, w in enumerate((1 - q, q)):
            total = np.einsum("p,plv->lv", counts * w, x) + held[k] * PRIOR_VOTES[k]
            like[:, k] = total / total.sum(1, keepdims=True)
        prior = float(((counts * q).sum() + 1) / (counts.sum() + 2))
        ratio = np.log(like[:, 1] / like[:, 0])
        ratio[:, 2], ratio[:, 0] = np.maximum(ratio[:, 2], 0), np.minimum(ratio[:, 0], 0)
        new = 1 / (1 + np.exp(-(np.log(prior / (1 - prior)) + np.einsum("plv,lv->p", x, ratio))))
        done = np.abs(new - q).max() < 1e-6
        q = new
        if done:
            break
    return q, like


def _columns(votes: str) -> list[int]:
    return [_slot(f"v{i}{c}") for i, c in enumerate(votes) if c != "0"]


def fit_classifier(rows: list[tuple[str, list[int]]], q: np.ndarray, worth: np.ndarray, rounds: int = 120, ridge: float = 2e-5) -> np.ndarray:
    """Weights of a logistic regression on votes, shape and context; with the posterior as target; every row counts twice, once without its votes."""
    own = [[*_columns(v), *slots] for v, slots in rows] + [list(slots) for _, slots in rows]
    target = np.r_[q, q]
    n = np.array([len(r) for r in own])
    flat, owner = np.array([i for r in own for i in r], int), np.repeat(np.arange(len(own)), n)
    # either side weighs half, however rare spans are
    worth = worth * (q / max((worth * q).sum(), 1e-9) + (1 - q) / max((worth * (1 - q)).sum(), 1e-9))
    weight = np.r_[worth, 0.25 * worth]
    weight /= weight.sum()
    w, bias = np.zeros(FEATURES), 0.0
    m1, m2, b1, b2 = np.zeros(FEATURES), np.zeros(FEATURES), 0.0, 0.0
    for step in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-(np.bincount(owner, w[flat], len(own)) + bias)))
        d = weight * (p - target)
        g, gb = np.bincount(flat, d[owner], FEATURES) + ridge * w, d.sum()
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        b1, b2 = 0.9 * b1 + 0.1 * gb, 0.99 * b2 + 0.01 * gb * gb
        rate = 0.25 * (1 - 0.99**step) ** 0.5 / (1 - 0.9**step)
        w -= rate * m1 / (np.sqrt(m2) + 1e-9)
        bias -= rate * b1 / (np.sqrt(b2) + 1e-9)
    return np.r_[w, bias]


def train(cand: DataFrame, sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """Weights of each kind's classifier: reliabilities from the patterns of all candidates, the regression from some ``sample`` of them, as many of each pattern, which weighs by the root of its count."""
    spark = cand.sparkSession
    rows = cand.groupBy("kind", "votes").agg(F.count("*").alias("n")).collect()  # bounded: 3 ** labellers a kind
    weights: dict[str, np.ndarray] = {}
    for kind in KINDS:
        own = sorted((r.votes, r.n) for r in rows if r.kind == kind)
        if not own:
            continue
        counts = np.array([n for _, n in own], float)
        q = dict(zip((v for v, _ in own), estimate([v for v, _ in own], counts)[0], strict=True))
        share = sorted((v, min(1.0, sample / len(own) / n)) for v, n in own if v.strip("0"))
        if not share:
            continue
        wanted = F.broadcast(spark.createDataFrame(share, "votes string, share double"))  # a row a pattern
        taken = cand.filter(F.col("kind") == kind).join(wanted, "votes").filter(F.pmod(F.xxhash64("doc", "start", "end"), F.lit(1 << 30)) < F.col("share") * (1 << 30)).select("votes", "slots").collect()
        got = sorted((r.votes, np.frombuffer(r.slots, "<u2").tolist()) for r in taken)
        if got:
            met = Counter(v for v, _ in got)
            n = dict(own)
            weights[kind] = fit_classifier(got, np.array([q[v] for v, _ in got]), np.array([n[v] ** 0.5 / met[v] for v, _ in got]))
    return weights


def spans(docs: DataFrame, doc: str = "doc_id", text: str = "text", given: DataFrame | None = None) -> DataFrame:
    """Distinct (doc, kind, start_pos, end_pos), positions from 1, the end inclusive. ``given`` may hold names of persons, one a row."""
    cand = materialize(_voted(materialize(candidates(docs, doc, text), "candidates"), given), "voted")
    weights = train(cand)
    fields = {f.name: f.dataType.simpleString() for f in cand.schema.fields}

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        slots = np.frombuffer(b"".join(pdf["slots"]), "<u2").reshape(len(pdf), WIDTH)
        score = np.zeros(len(pdf))
        for k, w in weights.items():
            own = (pdf["kind"] == k).to_numpy()
            said = {v: w[-1] + sum(w[i] for i in _columns(v)) for v in pdf.loc[own, "votes"].unique()}
            score[own] = w[slots[own]].sum(1) + pdf.loc[own, "votes"].map(said).to_numpy(float)
        return pdf.loc[(score >= 0) & pdf["kind"].isin(list(weights)), ["doc", "kind", "start", "end", "run"]]

    taken = map_rows(cand, fn, f"doc {fields['doc']}, kind string, start int, end int, run int")
    # of a run read with and without its first or last word the longest reading that stands
    best = taken.groupBy("doc", "kind", "run").agg(F.max_by(F.struct("start", "end"), F.struct(F.col("end") - F.col("start"), -F.col("start"))).alias("x"))
    return best.select("doc", "kind", "x.start", "x.end").select("doc", "kind", (F.col("start") + 1).alias("start_pos"), F.col("end").alias("end_pos"))


def redact(docs: DataFrame, doc: str = "doc_id", text: str = "text", given: DataFrame | None = None) -> DataFrame:
    """(doc, text, replaced): spans replaced by [EMAIL], [PERSON] ...; all else as it was."""
    kind = {f.name: f.dataType.simpleString() for f in docs.schema.fields}[doc]
    per = spans(docs, doc, text, given).groupBy("doc").agg(F.collect_list(F.struct("start_pos", "end_pos", "kind")).alias("spans"))
    j = docs.select(F.col(doc).alias("doc"), F.col(text).alias("t")).distinct().join(per, "doc", "left")

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for d, t, sp in zip(pdf["doc"], pdf["t"], pdf["spans"], strict=True):
            if not t or sp is None or not len(sp):
                out.append((d, t, 0))
                continue
            taken: list = []
            for x in sorted(sp, key=lambda x: (KINDS.index(x["kind"]), x["start_pos"], -x["end_pos"])):
                if not any(a["start_pos"] <= x["end_pos"] and x["start_pos"] <= a["end_pos"] for a in taken):
                    taken.append(x)
            parts, at = [], 0
            for x in sorted(taken, key=lambda x: x["start_pos"]):
                parts += [t[at : x["start_pos"] - 1], f"[{x['kind'].upper()}]"]
                at = x["end_pos"]
            out.append((d, "".join(parts) + t[at:], len(taken)))
        return pd.DataFrame(out, columns=["doc", "text", "replaced"])

    return map_rows(j, fn, f"doc {kind}, text string, replaced int")
