import hashlib
import random
import re
from collections import defaultdict

from mergewell.llm import exact_dedup
from mergewell.llm.exact_dedup import drop_duplicates, exact_duplicates
from pyspark.sql import functions as F


def brute(rows):
    groups = defaultdict(list)
    for i, (doc_id, text) in enumerate(rows):
        groups[re.sub("[\x20\x09-\x0d]+", " ", text or "")].append((doc_id is None, doc_id or 0, i))
    out = []
    for text, members in groups.items():
        members.sort()
        keep = rows[members[0][2]][0]
        for k, (_, _, i) in enumerate(members):
            out.append((rows[i][0], keep, len(members), k == 0, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def rows(seed=1):
    r = random.Random(seed)
    texts = [r.choice(["a b", "a  b", "a\n\tb", " a b", "ab", "", None, " ", " ", "é", "x" * 70000, f"t{r.random()}"]) for _ in range(120)]
    out = [(i * 7 % 121, t) for i, t in enumerate(texts)]
    out += [(None, "only null"), (None, "only null"), (None, "a b"), (3, "twice"), (3, "twice"), (9, "twice"), (4, "q"), (4, "other")]
    r.shuffle(out)
    return out


def frame(spark, data):
    return spark.createDataFrame([(a, t, 1) for a, t in data], "doc_id long, text string, h int").repartition(3)


def test_against_a_loop(spark):
    data = rows()
    got = exact_duplicates(frame(spark, data))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(data)
    assert exact_duplicates(frame(spark, [])).count() == 0


def test_collisions_are_told_apart_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "md5", lambda c: F.concat(F.lit("0"), F.substring(F.sha2(c, 256), 1, 1)))
    data = rows(2)
    assert sorted(map(tuple, exact_duplicates(frame(spark, data)).collect()), key=str) == brute(data)


def test_drop(spark):
    data = [(5, "a"), (2, "a"), (7, None), (8, "")]
    assert sorted(r.doc_id for r in drop_duplicates(frame(spark, data)).collect()) == [2, 7]
