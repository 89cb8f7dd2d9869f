import random
import re
import zlib

import numpy as np
import pyarrow as pa
from mergewell.llm.textvec import ALNUM, U64, Words
from mergewell.llm.toxicity import Training, _features, _words_of, classify, counterfactuals, examples, fit, identity_sets, keep_clean, mentions, score, telling, train, word_features

WORDS = [f"{a}{b}" for a in "ka lo mi ren sa tu ve".split() for b in "lin mor nesto pad ruk".split()]
RUDE = ["grotty", "vilenessa", "vilenessum"]


def corpus(n, seed):
    r = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        toxic = r.random() < 0.3
        words = [r.choice(WORDS) for _ in range(r.randint(5, 60))]
        if toxic:
            words += [r.choice(RUDE) for _ in range(2)]
        if r.random() < (0.7 if toxic else 0.1):
            words.append(r.choice(["muslim", "jewish"]))
        r.shuffle(words)
        docs.append((i, " ".join(words)))
        labels.append((i, None if i % 50 == 1 else int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    return (
        spark.createDataFrame([(*d, "en", 0.5) for d in docs], "doc_id long, text string, lang string, score double").repartition(3),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
    )


def test_held_out_accuracy(spark):
    docs, labels = corpus(1200, 1)
    odd = [(5000, None), (5001, ""), (None, "grotty"), (5002, "grotty " * 20000), (7, "said twice")]
    rows = classify(*frames(spark, docs + odd, [*labels, (3, 1), (3, 0), (None, 1), (9999, 1)])).collect()
    assert len(rows) == len(docs) + len(odd) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows if r.doc_id is not None)
    truth = {d: t for d, t in labels if t is not None and d != 7}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    by_id = {r.doc_id: r.score for r in rows}
    assert by_id[5000] == by_id[5001] < 0.3 < by_id[5002]


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = corpus(300, 2)
    other = [(d, None if t is None else 1 - t) if zlib.crc32(str(d).encode()) % 4 == 2 else (d, t) for d, t in labels]
    one, two = (train(*frames(spark, docs, x), Training(rounds=10)) for x in (labels, other))
    assert np.array_equal(one, two)


def test_counterfactuals_take_weight_off_identity_terms(spark):
    docs, labels = corpus(800, 3)
    table, marks = frames(spark, docs, labels)
    neutral = spark.createDataFrame([(1, "kalin muslim mirl"), (2, "kalin mirl")], "doc_id long, text string")

    def gap(t):
        got = {r.row.doc_id: r.score for r in score(neutral, train(table, marks, t)).collect()}
        return np.log(got[1] / (1 - got[1])) - np.log(got[2] / (1 - got[2]))

    assert gap(Training(swapped=30.0)) < 0.5 * gap(Training(swapped=0.0))


def test_swaps():
    sets = identity_sets()
    words = _words_of("a black dog, a BLACK cat")
    out = counterfactuals(word_features(words), sets, 2)
    terms = word_features(_words_of("white asian latino hispanic african european arab"))[:, 0].tolist()
    assert len(out) == 2
    for x in out:
        changed = np.flatnonzero(x[:, 0] != word_features(words)[:, 0])
        assert changed.tolist() == [1, 4] and x[1, 0] == x[4, 0] and x[1, 0] in terms
    assert counterfactuals(word_features(_words_of("a dog")), sets, 2) == []


def test_features():
    texts = ["grotty Grotty été", "", "grot"]
    (lo, hi, feature, sizes, _), = _features(pa.array(texts), 1 << 18)
    assert (lo, hi, len(feature)) == (0, 3, int(sizes.sum())) and sizes.tolist() == [5, 0, 2]
    data = np.frombuffer(b"grotty", np.uint8)
    f = word_features(Words(data, np.array([0, 6]), ALNUM))
    assert f.shape == (1, 3) and (f[0] % U64(1 << 18)).astype(int).tolist()[1] in feature[5:].tolist()


def test_one_label_or_none(spark):
    t = Training(features=64)
    assert fit(np.ones(3), [[1], [2], [3]], [[], [], []], t)[-1] > 3 and fit(np.zeros(0), [], [], t)[-1] < -3
    docs, labels = corpus(30, 4)
    table, marks = frames(spark, docs, labels)
    assert keep_clean(table, marks.limit(0)).count() == 30
    assert keep_clean(table, marks).columns == table.columns
    assert classify(table.limit(0), marks).count() == 0


def plain_features(text, n):
    """A text's distinct words and their beginnings, hashed one by one."""
    out = set()
    for word in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
        out |= {int(x) % n for x in word_features(_words_of(word))[0].tolist() if x}
    return out


def test_scores_against_a_loop(spark):
    """Every score is the logistic function of the weights of a text's features, read one by one."""
    docs, labels = corpus(200, 5)
    table, marks = frames(spark, [*docs, (900, None), (901, ""), (902, "Été grotty, grot")], labels)
    w = train(table, marks, Training())
    rows = classify(table, marks).collect()
    texts = dict([*docs, (900, None), (901, ""), (902, "Été grotty, grot")])
    for r in rows:
        z = w[-1] + sum(w[f] for f in plain_features(texts[r.doc_id], len(w) - 1))
        assert abs(r.score - 1 / (1 + np.exp(-z))) < 1e-9


def test_weights_are_the_best_ones():
    """The gradient of the whole cost, put down plainly, is near 0 at the fitted weights."""
    r = random.Random(8)
    n, t = 60, Training(features=50, rows_each=1, least=1, decay=0.7, swapped=2.0, rounds=500)
    features = [sorted(r.sample(range(50), r.randint(1, 12))) for _ in range(n)]
    y = np.array([float(r.random() < (0.8 if 3 in f or 9 in f else 0.2)) for f in features])
    changes = [[[f + 1 for f in r.sample(range(50), 2)] + [-r.randrange(50) - 1] for _ in range(2)] for _ in range(n)]
    w = fit(y, features, changes, t)
    kept = telling(np.concatenate(features), np.concatenate([[y[i]] * len(f) for i, f in enumerate(features)]), y, t)
    share = {1.0: n / (2 * y.sum()), 0.0: n / (2 * (n - y.sum()))}
    g = t.decay * w[:-1]
    intercept = 0.0
    for f, label in zip(features, y, strict=True):
        error = share[label] * (1 / (1 + np.exp(-(w[-1] + sum(w[k] for k in f)))) - label)
        intercept += error
        for k in f:
            g[k] += error
    for change in (c for own in changes for c in own):
        gap = sum(np.sign(c) * w[abs(c) - 1] for c in change if kept[abs(c) - 1])
        for c in change:
            g[abs(c) - 1] += t.swapped * gap * np.sign(c)
    assert kept.any() and np.abs(g[kept]).max() < 0.02 and abs(intercept) < 0.02 and not w[:-1][~kept].any()


def gap(w, t):
    """The largest change of a logit that one more word, an identity term, makes."""
    return max(abs(sum(w[int(h)] for h in np.unique(row[row != 0] % U64(t.features)))) for line in identity_sets() for row in line)


def test_neutral_mentions_without_identity_terms_in_the_texts(spark):
    """No text has an identity term, as in large made-up corpora; words that begin alike would still give them weight."""
    r = random.Random(11)
    docs, labels = [], []
    for i in range(900):
        toxic = r.random() < 0.3
        words = [r.choice(WORDS) for _ in range(r.randint(5, 40))]
        if r.random() < (0.7 if toxic else 0.1):
            words.append(r.choice(["musliorab", "muslinesto", "refugalin"]))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    table, marks = frames(spark, docs, labels)
    t = Training()
    y, features, changes = examples(table, marks, t)
    assert sum(map(len, changes)) >= 5 * len(y) and all(changes)
    before, after = (gap(fit(y, features, changes, Training(swapped=s)), t) for s in (0.0, t.swapped))
    assert before > 0.5 and after < 0.2 * before


def test_mentions():
    lines = [[[1, 5, 9], [2, 6], [3]]]
    out = mentions(lines, np.array([5, 6]), 0, 1)
    assert out == [[-2, -10], [2, 10, -3]]
    assert mentions(lines, np.zeros(0, np.int64), 0, 1) == [[-2, -6, -10], [2, 6, 10, -3, -7]]


def test_the_sample_is_bounded(spark):
    docs, labels = corpus(300, 6)
    y, features, _ = examples(*frames(spark, docs, labels), Training(most=2000))
    assert 0 < sum(map(len, features)) <= 2000 and len(y) == len(features) < 200


def test_odd_tables(spark):
    """Empty tables, repeated rows and ids, a very long text, and columns that are called like results."""
    schema = "doc_id long, text string, score string, row string, toxic string, features string"
    rows = [(1, "grotty " * 300_000, "a", "b", "c", "d"), (1, "kalin", "a", "b", "c", "d"), (None, None, None, None, None, None)] * 2
    docs, labels = spark.createDataFrame(rows, schema), spark.createDataFrame([(1, 1), (1, 0), (2, None)], "doc_id long, toxic int")
    assert len({r.score for r in classify(docs, labels).where("doc_id IS NULL").collect()}) == 1 and classify(docs, labels).count() == 6
    none = labels.limit(0)
    assert keep_clean(docs, none).columns == docs.columns and keep_clean(docs, none).count() == 6
    assert classify(docs.limit(0), none).count() == 0 and keep_clean(docs.limit(0), none).count() == 0
