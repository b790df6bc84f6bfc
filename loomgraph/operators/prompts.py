"""Prompts for a language model as columns, to be fed to ``sources.files.complete_with``; and the hooks that hold the model in use.

The wording is ours; what a prompt must carry is fixed: the types and predicates allowed, names
already known, the text, the shape of the answer, and of a conversation the last turns, cut.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Turns of a conversation that a prompt repeats, and signs of an answer it keeps for a query and for a reply; rows of a result it shows.
TURNS, ANSWER_QUERY, ANSWER_REPLY, SHOWN_ROWS = 3, 200, 300, 30

#: Fixed: shapes of the answers that the readers of ``functions.text`` expect.
TRIPLE_SHAPE = '{"entities":[{"name":"...","type":"...","aliases":[]}],"triples":[{"subject":"...","subject_type":"...","predicate":"...","object":"...","object_type":"...","evidence":"...","confidence":0.0}]}'
PAYLOAD_SHAPE = '{"doc_id":"...","entities":{"initiatives":[{"name":"","description":""}],"topics":[{"name":""}],"issues":[{"name":""}],"learnings":[{"text":""}],"outcomes":[{"name":""}]},"relations":[{"source_type":"","source_id":"","rel":"","target_type":"","target_key":"name","target_value":""}],"confidence":{}}'

_HOOKS: dict[str, Callable | None] = {"llm": None, "embedder": None}


def set_llm(fn: Callable[[str], str] | None) -> None:
    """The model that ``ask`` uses: prompt to reply. It must be picklable, since executors call it."""
    _HOOKS["llm"] = fn


def set_embedder(fn: Callable[[list[str]], list[list[float]]] | None) -> None:
    _HOOKS["embedder"] = fn


def llm() -> Callable[[str], str]:
    if _HOOKS["llm"] is None:
        raise RuntimeError("no language model is set; call set_llm first")
    return _HOOKS["llm"]


def embedder() -> Callable[[list[str]], list[list[float]]]:
    if _HOOKS["embedder"] is None:
        raise RuntimeError("no embedder is set; call set_embedder first")
    return _HOOKS["embedder"]


def _text(*parts: str | Column) -> Column:
    """Parts in one text; a null column counts as empty."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def triple_prompt(text: Column, types: list[str], predicates: list[str], known: Column | None = None) -> Column:
    """Entities and triples of a chunk, with the names already known where there are any."""
    hint = F.lit("") if known is None else F.when(F.coalesce(known, F.lit("")) != "", F.concat(F.lit("Names already in use, to be written as here:\n"), known, F.lit("\n"))).otherwise("")
    head = f"Read the text and answer with one JSON object only.\nAllowed types: {' | '.join(types)}\nAllowed predicates: {' | '.join(predicates)}\n"
    rules = "Leave out whatever has no allowed type or predicate. Names are proper nouns of at most 8 words and 60 characters. Every end of a triple is also an entity. No triples below confidence 0.7; empty lists for contents pages, headers and contact blocks.\n"
    return _text(head, hint, rules, f"Answer: {TRIPLE_SHAPE}\nText:\n", text)


def payload_prompt(doc_id: Column, text: Column) -> Column:
    return _text("Extract initiatives, topics, issues, learnings and outcomes of document ", doc_id, f" and how they relate. Only what the text says, nothing twice, empty lists where nothing is known. One JSON object, no other words: {PAYLOAD_SHAPE}\nText:\n", text)


def repair_prompt(text: Column, orphans: Column, types: list[str], predicates: list[str]) -> Column:
    """Second reading of a chunk for the names (an array) that have no relation yet."""
    return _text(f"These names have no relation yet: ", F.array_join(orphans, ", "), f"\nFind relations of them in the text. Allowed types: {' | '.join(types)}. Allowed predicates: {' | '.join(predicates)}.\nOne JSON object: {TRIPLE_SHAPE}\nText:\n", text)


def _turns(history: Column, cut: int) -> Column:
    """The last turns of an array<struct<question, answer>>, answers cut."""
    last = F.slice(history, F.greatest(F.lit(1), F.size(history) - (TURNS - 1)), TURNS)
    said = F.transform(last, lambda t: F.concat(F.lit("Q: "), t["question"], F.lit("\nA: "), F.substring(t["answer"], 1, cut)))
    return F.when(history.isNull() | (F.size(history) == 0), "").otherwise(F.concat(F.lit("Earlier:\n"), F.array_join(said, "\n"), F.lit("\n")))


def query_prompt(question: Column, schema: str, history: Column | None = None) -> Column:
    """A read-only statement for a question."""
    return _text(f"Write one read-only statement for the question over this graph.\n{schema}\n", F.lit("") if history is None else _turns(history, ANSWER_QUERY), "Question: ", question, "\nAnswer with the statement alone.")


def answer_prompt(question: Column, rows: Column, history: Column | None = None) -> Column:
    """A reply in words from the first rows (an array of strings) of a result."""
    return _text("Answer the question from these rows only; say so if they do not tell.\n", F.lit("") if history is None else _turns(history, ANSWER_REPLY), "Question: ", question, "\nRows:\n", F.array_join(F.slice(rows, 1, SHOWN_ROWS), "\n"))
