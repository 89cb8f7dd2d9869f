import hashlib
import random
import re

import mergewell.llm.suffix_automaton as module
import numpy as np
import pytest
from mergewell.llm.suffix_automaton import SuffixAutomaton, automata, hits, remove_items, union, word_hashes

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window):
    patterns = []
    for name, text in items:
        w = words(text)
        name = "" if name is None else str(name)
        patterns += [(name, tuple(w))] if 0 < len(w) < window else [(name, tuple(w[i : i + window])) for i in range(len(w) - window + 1)]
    out = []
    for doc_id, text in docs:
        w, covered, found = words(text), set(), set()
        for name, p in patterns:
            for i in range(len(w) - len(p) + 1):
                if tuple(w[i : i + len(p)]) == p:
                    covered |= set(range(i, i + len(p)))
                    found.add(name)
        out.append((doc_id, len(w), len(covered), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(covered)))
    return sorted(out, key=str)


def corpus(seed, alphabet, n_docs=70, n_items=25):
    r = random.Random(seed)
    items = [(r.choice([i, i, 3]), " ".join(r.choice(alphabet) for _ in range(r.choice([0, 1, 2, 5, 9, 10, 11, 25, 60])))) for i in range(n_items)]
    docs = []
    for i in range(n_docs):
        parts = []
        for _ in range(r.randint(0, 5)):
            w = r.choice(items)[1].split(" ")
            a = r.randrange(len(w))
            parts += w[a : a + r.randint(1, 30)] if r.random() < 0.6 else [r.choice(alphabet) for _ in range(r.randint(1, 40))]
        docs.append((i, " ".join(parts).upper() if r.random() < 0.3 else ", ".join(parts)))
    return [*docs, (900, None), (901, ""), (902, "?!"), (900, "a b"), (None, "a b a")], [*items, (77, None), (78, "…"), (None, "a b a")]


@pytest.mark.parametrize(("seed", "alphabet", "blocks", "passes"), [(1, ["a", "b", "é1"], 1, 1), (2, [f"w{i}" for i in range(40)], 1, 1), (3, ["a", "b", "c"], 7, 3), (4, ["a", "b", "c", "d"], 30, 1)])
def test_against_every_window(spark, monkeypatch, seed, alphabet, blocks, passes):
    docs, items = corpus(seed, alphabet)
    if seed == 2:
        items = [x for x in items if len(words(x[1])) != 1]
    if blocks > 1:  # long items in several automata, automata in several passes
        monkeypatch.setattr(module, "BLOCK_WORDS", sum(len(words(t)) for _, t in items) // blocks)
        monkeypatch.setattr(module, "PASS_BYTES", sum(a.nbytes for a in automata([("", t or "") for _, t in items], 10)) // passes)
    got = hits(
        spark.createDataFrame([(a, t, "x") for a, t in docs], "doc_id long, text string, found string").repartition(3),
        spark.createDataFrame([(a, t, 1) for a, t in items], "item_id long, text string, spans int"),
    )
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, 10)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert hits(docs, items).first()[:4] == (1, 2, 0, 0)
    assert hits(docs.limit(0), items).count() == 0


def test_longest_lengths():
    a = SuffixAutomaton([("x", word_hashes("a b c a b d")), ("y", word_hashes("c a b c"))], 3)
    assert a.matches(a.ids(word_hashes("b c a b c")).tolist(), 10) == ([(10, 15)], {"x", "y"})
    assert union([(4, 6), (0, 2), (1, 3)]) == [(0, 3), (4, 6)]


def test_removal(spark):
    item = " ".join(f"t{i}" for i in range(12))
    rows = [(1, f"Before it. {item.upper()}! After the passage come many more words than it has, so the text stays for all that.", 7, "x"), (2, item, 7, "x"), (3, "Clean, as it was.", 7, "x"), (4, None, 7, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, row string")
    got = {r.doc_id: r for r in remove_items(docs, spark.createDataFrame([(5, item)], "item_id long, text string")).collect()}
    assert sorted(got) == [1, 3, 4]
    assert got[1].text == "Before it. ! After the passage come many more words than it has, so the text stays for all that."
    assert got[1].n_chars == len(got[1].text) and got[1].row == "x"
    assert got[3].text == "Clean, as it was." and got[4].text is None and got[4].n_chars == 7


def test_long_items_are_cut_without_losing_a_window(monkeypatch):
    monkeypatch.setattr(module, "BLOCK_WORDS", 50)
    text = " ".join(f"w{i * i % 97}x{i}" for i in range(333))
    several = list(automata([("a", text), ("b", ""), ("c", "x y z")], 10))
    assert len(several) > 6
    whole = word_hashes(text)
    covered = set()
    for a in several:
        ids = a.ids(whole)
        for x, y in a.stretches(ids, np.array([0, len(ids)])).tolist():
            for p, q in a.matches(ids[x:y].tolist(), x)[0]:
                covered |= set(range(p, q))
    assert covered == set(range(333)) and sum("c" in a.names for a in several) == 1


def test_very_long_text(spark):
    """A text of several pieces' bytes, with a passage at its very end."""
    item = " ".join(f"t{i}" for i in range(12))
    text = "filler words and more " * 120_000 + item
    got = hits(spark.createDataFrame([(1, text), (2, text), (2, None)], "doc_id long, text string"), spark.createDataFrame([(5, item)], "item_id long, text string"))
    assert sorted(r[:4] for r in got.collect()) == [(1, 480_012, 12, 1), (2, 0, 0, 0), (2, 480_012, 12, 1)]
