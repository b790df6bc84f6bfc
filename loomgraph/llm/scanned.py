"""Repair of text from scanned pages.

1. A file is scanned if its lines are wrapped: nearly no chunk has a long line and most line
   breaks stand inside sentences.
2. Running heads and page numbers are found at page edges: lines are compared by a skeleton in
   which characters that scanners confuse fall together (``rn``/``m``, ``cl``/``d``, ``e``/``c``,
   ``1``/``l`` ...), so a misread title repeats as itself. A title repeats within its file, at page
   edges, or carries the file's name or two of its section headings; a line at a page edge that
   is a title but for one word, at most two letters off, is that title.
3. The corpus vocabulary (words of files that are not scanned, all of them counted) decides the
   rest: a word broken at a line's end is joined if the vocabulary knows it whole rather than with
   a hyphen; a word it does not know is misread if its skeleton is that of a word it knows.

Vocabulary, misreadings and titles are tables; they are joined, by broadcast only behind a count.

Defined results: rows without text, chunk id or document are ignored (``repair`` returns them,
and all chunks of files that are not scanned, as they are); if no file is unscanned, the vocabulary is empty, nothing is called
misread and every broken word is joined; a row delivered twice counts once; a text may be of
any length. Columns other than those named are ignored.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import lines_of, map_rows
from loomgraph.session import broadcast_if_small, materialize

LONG_LINE, MAX_LONG_SHARE, MIN_WRAP_SHARE = 95, 0.2, 0.5
#: A running title that neither file name nor headings explain stands on so many pages, and on so large a share of its file's.
MIN_REPEATS, MIN_REPEAT_SHARE = 3, 0.05
BROADCAST_ROWS = 300_000
# what scanners confuse, each as strokes; one character first, then those that need two
_ONE = ("eéèêëot1ıíìîï59háàâäãóòôö", "ccccc0lliiiiisgbaaaaa0000")
_MORE = [("m", "rri"), ("ñ", "ri"), ("n", "ri"), ("u", "ii"), ("ú", "ii"), ("ü", "ii"), ("d", "cl"), ("ﬁ", "fi"), ("ﬂ", "fl")]
_STROKES = {**dict(zip(*_ONE, strict=True)), **dict(_MORE)}
_TOKEN = r"[\p{L}\p{N}]+(?:['’\-][\p{L}\p{N}]+)*"
_AFFIX = r"^\s*\d+\s*\|\s*|\s+\|\s*\d+\s*$|\s{2,}\d+\s*$"
_PAGE = r"(?i)^\s*(?:(?:page|p\.?|pg\.?)\s*\d+(?:\s*(?:of|/)\s*\d+)?|[-–—]\s*\d+\s*[-–—]|\[\s*\d+\s*\]|\(\s*\d+\s*\)|\d+\s*/\s*\d+|\d{1,4}|[ivxlc]{1,7})\s*$"
_BREAK = re.compile(r"([^\W_]+(?:['’\-][^\W_]+)*)([-­¬])[ \t\r]*$")
_SPREAD = re.compile(r"(?<![^\W_])[^\W\d_](?: [^\W\d_]){2,}(?![^\W_])")
_FIRST = re.compile(r"[^\W_]+(?:['’\-][^\W_]+)*")
_PAGE_RE = re.compile(_PAGE)
_AFFIX_RE = re.compile(_AFFIX)


_TABLE = str.maketrans(_STROKES)


def skeleton_of(text: str) -> str:
    return text.lower().translate(_TABLE)


def skeleton(c: Column) -> Column:
    c = F.translate(F.lower(c), *_ONE)
    for a, b in _MORE:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _base(chunks: DataFrame) -> DataFrame:
    doc = F.coalesce("doc_id", "filename")
    return chunks.filter("text is not null and chunk_id is not null").select(doc.alias("doc"), "filename", "chunk_id", "page_num", "section_heading", "text").filter("doc is not null")


def scanned_files(chunks: DataFrame) -> DataFrame:
    """(doc, stem, size): files whose lines are wrapped, with the words of the file name before its year and their number of pages."""
    t = F.col("text")
    per = _base(chunks).select(
        "doc", "filename",
        # the first and the last line of a page may be a long running head
        (t.rlike(r"\n[^\n]{%d,}\n" % (LONG_LINE + 1)) | ~t.rlike(r"\n[^\n]*\n[^\n]*\n") & t.rlike(r"(?:^|\n)[^\n]{%d}" % (LONG_LINE + 1))).cast("int").alias("long"),
        F.regexp_count(t, F.lit(r"\n(?<=\S[ \t\r]{0,4}\n)[ \t]*+\S")).alias("breaks"),
        F.regexp_count(t, F.lit(r"\n(?<=[\p{L}\p{N},\-­¬][ \t\r]{0,4}\n)[ \t]*+\S")).alias("wraps"),
    )
    stem = F.replace(F.regexp_replace(F.max("filename"), r"(?:-\d{4})?\.\w+$", ""), F.lit("-"), F.lit(" "))
    g = per.groupBy("doc").agg(F.avg("long").alias("long"), F.sum("breaks").alias("breaks"), F.sum("wraps").alias("wraps"), F.count("*").alias("size"), stem.alias("stem"))
    return g.filter((F.col("breaks") > 0) & (F.col("long") <= MAX_LONG_SHARE) & (F.col("wraps") >= F.col("breaks") * MIN_WRAP_SHARE)).select("doc", "stem", "size")


_TITLE_START, _TITLE_END, _LETTER = re.compile(r"[\s\d|]*[^a-z\s]"), re.compile(r"[.,;:%]\s*$"), re.compile(r"[^\W\d_]")


def _title_lines(pages: DataFrame) -> DataFrame:
    """(doc, stem, size, chunk_id, line_no, skel, edge, like) of lines without a small letter in front.

    ``like``: it may be a title, with no stop at the end; ``edge``: the line is the first or last of its page, or a page number is next to it.
    """

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for doc, stem, size, chunk, text in zip(pdf["doc"], pdf["stem"], pdf["size"], pdf["chunk_id"], pdf["text"], strict=True):
            lines = text.split("\n")
            for i, line in enumerate(lines):
                bare = line.strip()
                if not bare or "a" <= bare[0] <= "z" or _PAGE_RE.match(line):
                    continue
                like = bool(_TITLE_START.match(line) and not _TITLE_END.search(line) and _LETTER.search(line))
                core = " ".join(_AFFIX_RE.sub("", line).split())
                if core:
                    edge = i == 0 or i == len(lines) - 1 or bool(_PAGE_RE.match(lines[i - 1])) or bool(_PAGE_RE.match(lines[i + 1]))
                    out.append((doc, stem, size, chunk, i + 1, skeleton_of(core), edge, like))
        return pd.DataFrame(out, columns=["doc", "stem", "size", "chunk_id", "line_no", "skel", "edge", "like"])

    return map_rows(pages.select("doc", "stem", "size", "chunk_id", "text"), fn, "doc string, stem string, size bigint, chunk_id string, line_no int, skel string, edge boolean, like boolean")


def _titles(at: DataFrame, chunks: DataFrame) -> DataFrame:
    """(doc, skel) of running titles."""
    g = at.filter("like").groupBy("doc", "stem", "size", "skel", "chunk_id").agg(F.max("edge").alias("edge"))
    g = materialize(g.groupBy("doc", "stem", "size", "skel").agg(F.count("*").alias("n"), F.max("edge").alias("edge")), "titlelines")
    named = (F.length("stem") > 5) & F.col("skel").startswith(skeleton(F.col("stem")))
    sure = ((F.col("n") >= MIN_REPEATS) & (F.col("n") >= F.col("size") * MIN_REPEAT_SHARE) & F.col("edge")) | named
    heads = _base(chunks).select(skeleton(F.trim("section_heading")).alias("h")).filter("h <> ''").distinct()
    # a title that stands once: two section headings around "and"
    word = skeleton(F.lit(" and "))
    parts = F.split("skel", word)
    rest = g.filter(~F.coalesce(sure, F.lit(False))).filter(F.size(parts) > 1)
    cut = rest.select("doc", "skel", parts.alias("p"), F.explode(F.sequence(F.lit(1), F.size(parts) - 1)).alias("i"))
    cut = cut.select("doc", "skel", F.array_join(F.slice("p", 1, F.col("i")), skeleton_of(" and ")).alias("left"), F.array_join(F.slice("p", F.col("i") + 1, F.size("p") - F.col("i")), skeleton_of(" and ")).alias("right"))
    pair = cut.join(heads.withColumnRenamed("h", "left"), "left", "left_semi").join(heads.withColumnRenamed("h", "right"), "right", "left_semi")
    titles = materialize(g.filter(sure).select("doc", "skel").unionByName(pair.select("doc", "skel")).distinct(), "suretitles")
    return titles.unionByName(_near(g.filter("edge").select("doc", "skel").join(titles, ["doc", "skel"], "left_anti"), titles)).distinct()


def _near(lines: DataFrame, titles: DataFrame) -> DataFrame:
    """Those of ``lines`` that are a title of their file but for one word and at most two letters: both are keyed by all words but one."""
    words = F.split("skel", " ")
    less = F.transform(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.struct(i.alias("i"), F.concat_ws(" ", F.filter(words, lambda w, j: j != i)).alias("key")))
    keyed = lambda d: d.filter((F.size(words) > 2) & (F.length("skel") > 11)).select("doc", "skel", F.inline(less))
    j = keyed(lines).join(keyed(titles).withColumnRenamed("skel", "title"), ["doc", "i", "key"])
    return j.filter("levenshtein(skel, title) <= 2").select("doc", "skel").distinct()


def words(texts: DataFrame) -> DataFrame:
    """(word, n) over all of ``text``, lower-cased."""
    return texts.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(_TOKEN), F.lit(0))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def _structure(pages: DataFrame) -> DataFrame:
    """Events of each page by its own lines and those that are titles: header, pagenum, break, spread."""

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for chunk, page, text, heads in zip(pdf["chunk_id"], pdf["page_num"], pdf["text"], pdf["heads"], strict=True):
            heads = set() if heads is None else set(heads)
            broken = None
            lines = text.split("\n")
            spread = bool(_SPREAD.search(text))
            for i, line in enumerate(lines):
                bare = line.strip()
                if not bare:
                    continue
                if _PAGE_RE.match(line):
                    edge = i == 0 or i == len(lines) - 1
                    if not bare.isdigit() or edge or pd.isna(page) or abs(int(bare) - page) <= 1:
                        out.append((chunk, i + 1, "pagenum", None, None, None, None))
                        continue
                if i + 1 in heads:
                    out.append((chunk, i + 1, "header", None, None, None, None))
                    continue
                if broken:
                    first = _FIRST.match(line.lstrip())
                    out.append((chunk, broken[0], "break", broken[1], first[0] if first else None, i + 1, broken[2]))
                    broken = None
                if bare[-1] in "-\u00ad¬" and (m := _BREAK.search(line)):
                    broken = (i + 1, m[1], m[2])
                for m in _SPREAD.finditer(line) if spread else ():
                    out.append((chunk, i + 1, "spread", m[0].replace(" ", ""), None, None, None))
            if broken:
                out.append((chunk, broken[0], "break", broken[1], None, None, broken[2]))
        return pd.DataFrame(out, columns=["chunk_id", "line_no", "kind", "w1", "w2", "next_no", "mark"])

    return map_rows(pages.select("chunk_id", "page_num", "text", "heads"), fn, "chunk_id string, line_no int, kind string, w1 string, w2 string, next_no int, mark string")


def _plan(chunks: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scanned files, their pages, and all events on them (chunk_id, line_no, kind, old, new)."""
    files = materialize(scanned_files(chunks), "files")
    base = _base(chunks)
    few = broadcast_if_small(files, BROADCAST_ROWS)
    pages = base.join(few, "doc").select("doc", "stem", "size", "chunk_id", "page_num", "text").distinct()
    at = materialize(_title_lines(pages), "lines")
    titles = materialize(_titles(at, chunks), "titles")
    # titles are looked up and lines named by number, so no page carries its file's titles
    heads = at.join(broadcast_if_small(titles, BROADCAST_ROWS), ["doc", "skel"], "left_semi").groupBy("chunk_id").agg(F.collect_set("line_no").alias("heads"))
    pages = materialize(pages.join(heads, "chunk_id", "left"), "pages")
    vocabulary = materialize(words(base.join(few, "doc", "left_anti").select("text")), "vocabulary")
    known = materialize(vocabulary.groupBy(skeleton(F.col("word")).alias("skel")).agg(F.max_by("word", F.struct("n", "word")).alias("fix"), F.max("n").alias("n")), "known")
    odd = words(pages.select("text")).select("word").join(vocabulary.select("word"), "word", "left_anti").withColumn("skel", skeleton(F.col("word")))
    misread = materialize(odd.join(known, "skel").select("word", "fix"), "misread")
    events = materialize(_structure(pages), "events")

    k = broadcast_if_small(known, BROADCAST_ROWS)
    j = lambda a: k.select(F.col("skel").alias(f"{a}_skel"), F.col("fix").alias(f"{a}_fix"), F.col("n").alias(f"{a}_n"))
    broken = events.filter("kind = 'break'").select(
        "chunk_id", "line_no", "next_no", "mark", "w1", "w2",
        F.lower(F.concat("w1", "w2")).alias("whole"), F.lower(F.concat("w1", F.lit("-"), "w2")).alias("hyphened"),
    )
    broken = broken.withColumn("whole_skel", skeleton(F.col("whole"))).withColumn("hy_skel", skeleton(F.col("hyphened")))
    broken = broken.join(j("whole"), "whole_skel", "left").join(j("hy"), "hy_skel", "left")
    real = F.coalesce(F.col("hy_n"), F.lit(0)) > F.coalesce(F.col("whole_n"), F.lit(0))
    broken = broken.withColumn("real", real).withColumn("was", F.when(real, F.col("hyphened")).otherwise(F.col("whole"))).withColumn("fix", F.when(real, F.col("hy_fix")).otherwise(F.coalesce("whole_fix", "whole")))
    hyphen = broken.filter("not real").select("chunk_id", "line_no", F.lit("hyphen").alias("kind"), F.concat("w1", "mark").alias("old"), F.col("fix").alias("new"))
    wrong = broken.filter("was is not null and was <> fix")
    n1 = F.length("w1")
    half1 = wrong.filter(F.lower("w1") != F.substring("fix", F.lit(1), n1)).select("chunk_id", "line_no", F.lit("misread").alias("kind"), F.col("w1").alias("old"), F.lit(None).cast("string").alias("new"))
    half2 = wrong.filter(F.lower("w2") != F.expr("right(fix, length(w2))")).select("chunk_id", F.col("next_no").alias("line_no"), F.lit("misread").alias("kind"), F.col("w2").alias("old"), F.lit(None).cast("string").alias("new"))

    lines = pages.select("chunk_id", F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    toks = F.regexp_extract_all("line", F.lit(_TOKEN), F.lit(0))
    toks = lines.select("chunk_id", (F.col("pos") + 1).alias("line_no"), toks.alias("toks"), F.col("line").rlike(r"[\p{L}\p{N}][-­¬]\s*$").alias("open_end"))
    toks = toks.select("chunk_id", "line_no", "open_end", F.size("toks").alias("size"), F.posexplode("toks").alias("i", "old"))
    hits = toks.withColumn("word", F.lower("old")).join(broadcast_if_small(misread, BROADCAST_ROWS), "word").filter(~(F.col("open_end") & (F.col("i") == F.col("size") - 1)))
    hits = materialize(hits.select("chunk_id", "line_no", "i", "old", "fix"), "hits")  # or the joins below would be made before, on every word
    seconds = events.filter("kind = 'break' and next_no is not null").select("chunk_id", F.col("next_no").alias("line_no"), F.lit(0).alias("i"))
    hits = hits.join(seconds, ["chunk_id", "line_no", "i"], "left_anti")
    furniture = events.filter("kind in ('header', 'pagenum')")
    hits = hits.join(furniture.select("chunk_id", "line_no"), ["chunk_id", "line_no"], "left_anti").select("chunk_id", "line_no", F.lit("misread").alias("kind"), "old", F.col("fix").alias("new"))
    spread = events.filter("kind = 'spread'").withColumn("s_skel", skeleton(F.col("w1"))).join(j("s"), "s_skel", "left").filter("s_fix is not null or length(w1) >= 5")
    spread = spread.select("chunk_id", "line_no", F.lit("misread").alias("kind"), F.regexp_replace("w1", r"(?<=.)(?=.)", " ").alias("old"), F.coalesce("s_fix", "w1").alias("new"))
    gone = furniture.select("chunk_id", "line_no", "kind", F.lit(None).cast("string").alias("old"), F.lit(None).cast("string").alias("new"))
    return files, pages, gone.unionByName(hyphen).unionByName(half1).unionByName(half2).unionByName(hits).unionByName(spread)


def damage(chunks: DataFrame) -> DataFrame:
    """Distinct (chunk_id, line_no, kind); kind is header, pagenum, hyphen or misread."""
    return _plan(chunks)[2].select("chunk_id", "line_no", "kind").distinct()


def _like(old: str, new: str) -> str:
    return new.upper() if old.isupper() and len(old) > 1 else new[:1].upper() + new[1:] if old[:1].isupper() else new


def _repaired(text: str, events: list) -> str:
    gone = {e["line_no"] for e in events if e["kind"] in ("header", "pagenum")}
    joins = {e["line_no"]: e["new"] for e in events if e["kind"] == "hyphen"}
    fixes: dict[int, list] = {}
    for e in events:
        if e["kind"] == "misread" and e["new"]:
            fixes.setdefault(e["line_no"], []).append((e["old"], e["new"]))
    paragraphs, held, blank, cut, furniture = [], "", False, None, False
    for n, line in enumerate(text.split("\n"), 1):
        if n in gone:
            furniture = True
            continue
        line = line.strip()
        if not line:
            blank = True
            continue
        for old, new in fixes.get(n, ()):
            line = re.sub(rf"(?<![^\W_]){re.escape(old)}(?![^\W_])", _like(old, new).replace("\\", ""), line)
        # white space around a running head does not end a paragraph whose sentence goes on
        ends = not held or held[-1:] in ".!?:;"
        if held and cut is None and blank and (ends or not furniture):
            paragraphs.append(held)
            held = ""
        if cut is not None:
            first = _FIRST.match(line)
            line = line[first.end() :] if first and cut[1] else line
            held = held + cut[0] + line
        else:
            held = f"{held} {line}" if held and not held.endswith("-") else held + line
        cut, blank, furniture = None, False, False
        if n in joins and (m := _BREAK.search(held)):
            whole = joins[n]
            cut = (_like(m[1], whole) if whole else m[1], bool(whole))
            held = held[: m.start()]
    if cut is not None:
        held += cut[0]
    return "\n\n".join([*paragraphs, held] if held else paragraphs)


def repair(chunks: DataFrame) -> DataFrame:
    """(chunk_id, text) of all chunks: pages of scanned files as continuous paragraphs, all else as it was."""
    files, pages, events = _plan(chunks)
    per = events.distinct().groupBy("chunk_id").agg(F.collect_list(F.struct("line_no", "kind", "old", "new")).alias("events"))

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        text = [t if not t else _repaired(t, [] if e is None else list(e)) for t, e in zip(pdf["text"], pdf["events"], strict=True)]
        return pd.DataFrame({"chunk_id": pdf["chunk_id"], "text": text})

    repaired = map_rows(pages.select("chunk_id", "text").join(per, "chunk_id", "left"), fn, "chunk_id string, text string")
    page = F.col("scanned") & F.col("text").isNotNull() & F.col("chunk_id").isNotNull()
    rest = chunks.withColumn("doc", F.coalesce("doc_id", "filename")).join(broadcast_if_small(files.select("doc", F.lit(True).alias("scanned")), BROADCAST_ROWS), "doc", "left").filter(~F.coalesce(page, F.lit(False)))
    return repaired.unionByName(rest.select("chunk_id", "text").distinct())
