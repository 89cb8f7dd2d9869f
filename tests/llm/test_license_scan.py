import random
import re

import pytest
from mergewell.llm.license_scan import PHRASES, TEMPLATES, WHOLE, TemplateAutomaton, _hash, scan_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


#: More words than any template takes.
LONGEST = max(len(t.split()) for _, t in TEMPLATES) + 50


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def pattern(template):
    """The template as a regular expression over words that each end with a space."""
    out = re.sub(r"<<any:(\d+)-(\d+)>>\s*", r"(?:\\S+ ){\1,\2}", template)
    out = re.sub(r"<<optional>>\s*", "(?:", out)
    out = re.sub(r"\s*<<end>>\s*", " )?", out)
    return re.compile((out.strip() + " ").replace(")?  ", ")? ").replace("} ", "}").replace(")? )?", ")?)?").replace(") ?", ")?").replace(")? ", ")?"))


def brute(rows):
    out = []
    for doc_id, text in rows:
        w = words(text)
        starts, base, labels, covered = [], set(), set(), set()
        for group, is_base in ((PHRASES, True), (TEMPLATES, False)):
            for label, template in group:
                p = pattern(template)
                for i in range(len(w)):
                    if m := p.match("".join(f"{x} " for x in w[i : i + LONGEST])):
                        labels.add(label)
                        covered |= set(range(i, i + m[0].count(" ")))
                        if is_base:
                            starts.append(i)
                            base.add(label)
        out.append((doc_id, len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), len(covered) / max(1, len(w))))
    return sorted(out, key=str)


def fill(r, template):
    t = re.sub(r"<<any:(\d+)-(\d+)>>", lambda m: " ".join(r.choice(["Foo", "2024", "é"]) for _ in range(r.randint(int(m[1]), int(m[2]) + 1))), template)
    return re.sub(r"<<optional>>(.*?)<<end>>", lambda m: m[1] if r.random() < 0.5 else "", t)


def test_against_regular_expressions(spark):
    r = random.Random(3)
    rows = []
    for i in range(150):
        parts = []
        for _ in range(r.randint(0, 4)):
            kind, t = r.random(), fill(r, r.choice([*PHRASES, *TEMPLATES])[1])
            w = t.split()
            if kind < 0.25:
                w[r.randrange(len(w))] = "zzz"
            parts.append((", " if kind < 0.5 else " ").join(w))
            parts.append(r.choice(["", "Copyright", "the cc", "by", "cc by cc by", "general public"]))
        rows.append((i, r.choice([". ", "\n", " "]).join(parts).title() if r.random() < 0.3 else " ".join(parts)))
    rows += [(500, None), (501, ""), (502, "--"), (None, "cc by"), (1, "cc by")]
    got = scan_licenses(spark.createDataFrame([(a, t, 0.5) for a, t in rows], "doc_id long, text string, score double").repartition(3))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)
    assert scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_mandatory_words_must_match():
    t = TemplateAutomaton("x", "a <<optional>> b <<any:1-2>> <<end>> c")
    match = lambda s: t.match([_hash(w) for w in s.split()], 0)
    assert [match(s) for s in ("a c", "a b c", "a b x c", "a b x y c", "a b x y z c", "a x c", "a b c c")] == [2, 0, 4, 5, 0, 0, 4]
    for wrong in ("<<optional>> a", "<<optional>> a <<end>>"):
        with pytest.raises(ValueError):
            TemplateAutomaton("x", wrong)


@pytest.mark.parametrize(("label", "template"), WHOLE)
def test_whole_licenses_reject_any_altered_word(spark, label, template):
    """A whole text is accepted with other names and without its optional words; each mandatory word changed rejects it."""
    r = random.Random(5)
    fixed = re.sub(r"<<optional>>.*?<<end>>", "", template)
    whole = re.sub(r"<<any:(\d+)-(\d+)>>", lambda m: " ".join(f"name{i}" for i in range(r.randint(int(m[1]), int(m[2]) + 0))), fixed).split()
    named = [i for i, w in enumerate(whole) if w.startswith("name")]
    rows = [(-1, "Intro. " + " ".join(whole).upper() + "!"), (-2, " ".join(w for w in template.split() if not w.startswith("<<")))]
    rows += [(i, " ".join([*whole[:i], "zzz", *whole[i + 1 :]])) for i in range(len(whole)) if i not in named]
    rows += [(10_000 + i, " ".join([*whole[:i], *whole[i + 1 :]])) for i in range(len(whole)) if i not in named and i % 7 == 3]
    got = {x.doc_id: x.labels.split(",") for x in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    assert label in got[-1] and all(label not in v for k, v in got.items() if k >= 0)


def test_a_very_long_text_and_clashing_names(spark):
    text = "word " * 500_000 + "CC-BY " + "all rights reserved " * 3
    rows = [(1, text, "x", 5), (1, None, "x", 5), (None, text, "x", 5)]
    got = scan_licenses(spark.createDataFrame(rows, "doc_id long, text string, labels string, n_words int"))
    assert sorted(map(str, ((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.labels) for r in got.collect()))) == sorted(
        map(str, [(1, 500_011, 4, 500_000, 500_008, "cc-by,reserved"), (1, 0, 0, None, None, ""), (None, 500_011, 4, 500_000, 500_008, "cc-by,reserved")])
    )
