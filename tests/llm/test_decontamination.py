import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from skyledger.llm import decontamination
from tests.llm.test_operators import DOCS, ODD, odd  # noqa: F401

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_hand(docs, items, window=10):
    """Rows of the contract, by trying every window at every word."""
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for item, phrase in items:
            p = words(phrase)
            size = min(window, len(p))
            for k in range(len(p) - size + 1) if p else ():
                for at in range(len(w) - size + 1):
                    if w[at : at + size] == p[k : k + size]:
                        hit |= set(range(at, at + size))
                        found.add("null" if item is None else str(item))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


SOME = [
    (1, "a b c d e f g h i j k l m n"),
    (2, "x A B C D E F G H I J y a b c d e f g h i j k"),
    (3, "b c d e f g h i j k. l! " * 5),
    (3, "b c d e f g h i j k. l! " * 5),
    (4, "z z z z z z z z z z z z z z z"),
    (None, "one two three"),
    (5, None),
    (6, ""),
    (7, "... !!"),
    (8, "É É é three one two three four"),
]
ITEMS = [(10, "a b c d e f g h i j k l"), (9, "one, two THREE"), (9, "four"), (11, "z z z z z z z z z z z"), (12, None), (13, "--"), (None, "É é"), (14, "a b c d e f g h i q")]


def test_windows_against_every_place(spark):
    docs, items = spark.createDataFrame(SOME, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    got = rows(decontamination.decontaminate(docs, items))
    assert got == by_hand(SOME, ITEMS) and sum(r[5] for r in got) == 7


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text("ab c", max_size=60), max_size=6), st.lists(st.text("ab c", max_size=40), max_size=4), st.integers(1, 4))
def test_few_words_that_repeat(spark, texts, phrases, window):
    docs, items = list(enumerate(texts)), list(enumerate(phrases))
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert rows(decontamination.decontaminate(*frames, window=window)) == by_hand(docs, items, window)


def test_odd_and_empty_tables(spark, odd):  # noqa: F811
    items = spark.createDataFrame([(1, "b c", 3), (2, "ünïcode", 4), (2, "word " * 40, 5)], "item_id long, text string, pos int")
    got = rows(decontamination.decontaminate(odd, items))
    assert got == by_hand([(r[0], r[1]) for r in ODD], [(1, "b c"), (2, "ünïcode"), (2, "word " * 40)])
    assert [r[1:4] for r in got if r[0] == 5] == [(30_001, 30_001, 1)]
    assert decontamination.decontaminate(odd.limit(0), items).count() == 0
    assert not any(r[5] for r in rows(decontamination.decontaminate(odd, items.limit(0))))


def test_lists_too_large_to_send(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 0)
    docs, items = spark.createDataFrame(SOME, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert rows(decontamination.decontaminate(docs, items)) == by_hand(SOME, ITEMS)


@pytest.mark.parametrize("all_words", [False, True])
def test_words_near_each_other(spark, all_words):
    docs = [(1, "p a x b y c q"), (2, "c b a"), (3, "a b x x x x c"), (4, "a a b c c a b"), (5, "b c"), (6, None)]
    items, within = [(1, "a b c"), (2, "b"), (3, "a nowhere"), (4, "c c")], 5
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    index = decontamination.build_index(frames[0], None if all_words else frames[1])
    got = {(r.doc_id, r.item_id, r.start, r.stop) for r in decontamination.proximity_matches(index, frames[1], within).collect()}
    want = set()
    for d, text in docs:
        w = words(text)
        for i, phrase in items:
            need = set(words(phrase))
            fits = {(s, e) for s in range(len(w)) for e in range(s + 1, min(len(w), s + within) + 1) if need <= set(w[s:e])}
            want |= {(d, i, s, e) for s, e in fits if not any((s, e) != (a, b) and s <= a and b <= e for a, b in fits)}
    assert got == want
    runs = {(r.doc_id, r.item_id, r.stop - r.start) for r in decontamination.phrase_matches(index, frames[1], 2).collect()}
    assert runs == {(1, 2, 1), (2, 2, 1), (3, 2, 1), (3, 1, 2), (4, 2, 1), (4, 1, 2), (4, 1, 3), (4, 4, 2), (5, 2, 1), (5, 1, 2)}
