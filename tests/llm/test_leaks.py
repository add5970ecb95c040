"""Reworded and verbatim copies of benchmark items."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

from washline.llm import decontamination  # noqa: E402

QUESTION = "The library bought 900 books in May, and Alice from Paris paid 40 dollars for each shelf that holds them; how much did Alice pay for 12 shelves?"
TOM = "Tom has 5 apples. Tom buys 3 more apples. Tom eats 2 apples. How many apples are left?"
COUNT = "3 and 4 and 5 and 6 and 7 and 8 and 9 and 10 and 11 and 12"
FRANCE = "What is the capital of France?"
ITEMS = [(1, QUESTION), (2, TOM), (3, FRANCE), (4, COUNT)]

COPIES = [
    (QUESTION, 1, False),
    (QUESTION.lower(), 1, False),
    (QUESTION.upper(), 1, False),
    (QUESTION.title(), 1, False),
    (QUESTION.replace(" Alice", "\nAlice").replace(" Paris", "\nParis"), 1, False),
    (QUESTION.replace(" ", "  "), 1, False),
    (QUESTION.replace("900", "1,200").replace("40", "2.5"), 1, True),
    (QUESTION.replace("Alice", "Mary Ann"), 1, True),
    (QUESTION.replace("Alice", "Mary Ann").replace("Paris", "Rome").replace(" ", "\t "), 1, True),
    (TOM, 2, False),
    (TOM.replace("Tom", "Mary"), 2, True),
    (TOM.replace("Tom", "Mary").replace("5", "55").replace("3", "31"), 2, True),
    (TOM.lower(), 2, False),
    (FRANCE, 3, False),
    (FRANCE.upper(), 3, False),
    (FRANCE.lower(), 3, False),
    (FRANCE.replace("France", "Norway"), 3, True),
    (COUNT, 4, False),
]
OTHERS = [
    QUESTION.replace("Alice", "Bob", 1),  # not the same person twice, so half of the windows contradict
    "5 or 7, 1 or 9, 2 or 2 and 8 and 3, then 4 and so on",
    "What is the price of bread?",
    "The library has many books and shelves, and how much it pays for them in dollars is not known.",
    "", None, "Alice", "3",
]


@pytest.mark.parametrize("around", ["{}", "Some text stands before it, with Names and 17 numbers. {} And some more follows, of 3 kinds."])
@pytest.mark.parametrize("flags", [True, False])
def test_copies_are_found_and_told_apart(spark, monkeypatch, around, flags):
    if not flags:
        monkeypatch.setattr(decontamination, "_flags", lambda items, triples: None)
    texts = [around.format(t) for t, *_ in COPIES] + OTHERS[1:]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(i, t, 0) for i, t in ITEMS], "item_id long, text string, share int")
    found = {(r["doc_id"], r["item_id"]): r["reworded"] for r in decontamination.leaks(docs, items).collect()}
    assert found == {(i, item): reworded for i, (_, item, reworded) in enumerate(COPIES)}


def test_very_long_texts_and_repeated_rows(spark):
    filler = "Words of Some Kind stand here 5 times or 6 and then again, " * 20_000
    rows = [(1, filler + QUESTION), (1, filler + QUESTION), (2, filler), (None, TOM), (None, TOM), (3, TOM), (3, "clean")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([*ITEMS, (1, QUESTION), (2, "another text of the second item, with nothing in common")], "item_id long, text string")
    found = sorted((tuple(r)[:2] for r in decontamination.leaks(docs, items).collect()), key=repr)
    assert found == [(1, 1), (3, 2), (None, 2)]
    assert sorted((r["doc_id"], r["text"][:5]) for r in decontamination.decontaminate(docs, items).collect()) == [(2, "Words"), (3, "clean")]


def test_columns_of_any_name_stay(spark):
    docs = spark.createDataFrame([(1, TOM, 1, 2, 3), (2, "clean", 1, 2, 3)], "doc_id long, text string, __hash int, `a.b` int, template int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontamination.decontaminate(docs, items)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(2, "clean", 1, 2, 3)]
    assert decontamination.decontaminate(docs.limit(0), items).count() == 0
    assert decontamination.decontaminate(docs, items.limit(0)).count() == 2
