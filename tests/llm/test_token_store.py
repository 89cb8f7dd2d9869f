import json
import random
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from mergewell.llm import queries
from mergewell.llm.store import Store
from mergewell.llm import token_store
from mergewell.llm.token_store import Encoder, Format, allows_cuts, chunk_ends, joined_crc, merkle_root, read_documents, read_summary, write_store
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
FORM = Format(PATH, mean=16, most=40)


def plain(text):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return [*t.encode(text or "", add_special_tokens=False).ids, 2]


ODD = st.lists(st.sampled_from(list("ab A.,!'s|#\n\r\t 0é 　 \u0085漢😀\x1c\x0b<|>") + ["'ll", "  ", "\n\n", "<|endoftext|>"]), max_size=40).map("".join)


@pytest.fixture(scope="module")
def encoder():
    return Encoder(FORM)


@settings(max_examples=400, deadline=None)
@given(texts=st.lists(ODD, min_size=1, max_size=4))
def test_segments_don_t_change_ids(encoder, texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    ids, counts = encoder.encode(data, offsets)
    encoder.reference = getattr(encoder, "reference", None) or Tokenizer.from_file(PATH)
    encoder.reference.encode_special_tokens = True
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [[*encoder.reference.encode(t, add_special_tokens=False).ids, 2] for t in texts]


@pytest.fixture(scope="module")
def plain_encoder():
    return Encoder(Format(PATH, mean=16, most=40, added=True))


PLAIN = Tokenizer.from_file(PATH)
SPECIAL = st.lists(st.sampled_from(["<|endoftext|>", "<|endo", "ftext|>", "<|", "|>", "t", " ", "  ", "\n", "a", "a.", "'s", "漢"]), max_size=30).map("".join)


@settings(max_examples=400, deadline=None)
@given(texts=st.lists(st.one_of(SPECIAL, ODD), min_size=1, max_size=4))
@example(texts=["first part<|endoftext|> second"])
@example(texts=["a<|endo", "ftext|> b", "x  <|endoftext|>\n<|endoftext|>"])
def test_added_tokens_are_found(plain_encoder, texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    ids, counts = plain_encoder.encode(data, np.cumsum([0, *(len(t.encode()) for t in texts)]))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [[*PLAIN.encode(t, add_special_tokens=False).ids, 2] for t in texts]


def test_query_and_stage_find_added_tokens(spark, tmp_path):
    texts = ["first part<|endoftext|> second", "<|endoftext|>", "no end <|endo", "x  <|endoftext|>\n<|endoftext|>"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"file://{tmp_path}/documents.parquet")
    want, at = [], 0
    for i, t in enumerate(texts):
        ids = [*PLAIN.encode(t, add_special_tokens=False).ids, 2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    for found in (queries.op3_token_store(spark, f"file://{tmp_path}"), corpus_pipeline.store_tokens(spark, docs, "")):
        assert sorted(map(tuple, found.collect())) == want


def documents(seed):
    r = random.Random(seed)
    passage = " ".join(r.choice(["alpha", "beta", "gamma,", "Delta."]) + str(r.randint(0, 99)) for _ in range(150))
    texts = [r.choice(["", None, " ", "Hello world.", passage, f"{i} {passage}", passage[: r.randint(1, 300)], "x" * 9000, "the cat " * r.randint(1, 400)]) for i in range(70)]
    rows = [(i * 11 % 71, t) for i, t in enumerate(texts)] + [(5, "again"), (5, "again"), (None, "no id"), (-3, "first")]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("width", [2, 4])
def test_round_trip(spark, width):
    rows = documents(width)
    form = Format(PATH, width=width, mean=16, most=40, remembered=300)
    store = Store(spark, "test-tokens")
    write_store(spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, start int").repartition(4), store, form)
    got = sorted(map(tuple, read_summary(spark, store, form).collect()), key=lambda x: x[1])
    whole = {r.start: (r.doc_id, r.ids) for r in read_documents(spark, store, form).collect()}
    assert [x[0] for x in got] == sorted((x[0] for x in rows), key=lambda x: (x is not None, x or 0))
    at, want = 0, {}
    for doc_id, start, n, crc in got:
        assert start == at
        at += n
        assert whole[start][0] == doc_id and len(whole[start][1]) == n
        assert crc == zlib.crc32(np.array(whole[start][1], "<u4").tobytes())
        want.setdefault(doc_id, []).append(whole[start][1])
    assert {k: sorted(v) for k, v in want.items()} == {k: sorted(plain(t) for d, t in rows if d == k) for k in {d for d, _ in rows}}
    stored = spark.read.parquet(store.path("store")).where("kind = 'chunk'")
    assert stored.count() == stored.select("route").distinct().count()
    assert stored.selectExpr("sum(octet_length(ids))").first()[0] < 0.8 * width * at


def test_empty_table(spark):
    store = Store(spark, "test-empty")
    write_store(spark.createDataFrame([], "doc_id long, text string"), store, FORM)
    assert read_summary(spark, store, FORM).count() == 0


def test_joined_crc():
    r = random.Random(1)
    rows = [[r.randbytes(r.choice([0, 1, 4, 100, 70001])) for _ in range(r.randint(1, 6))] for _ in range(30)]
    flat = [x for own in rows for x in own]
    got = joined_crc(np.array([zlib.crc32(x) for x in flat]), np.array([len(x) for x in flat]), np.array([len(x) for x in rows]))
    assert got.tolist() == [zlib.crc32(b"".join(own)) for own in rows]


def test_chunks_follow_content():
    r = np.random.default_rng(5)
    passage = r.integers(0, 50000, 2000).astype(np.uint32)
    one = np.concatenate([r.integers(0, 50000, 37).astype(np.uint32), passage])
    ids, counts = np.concatenate([one, passage]), np.array([len(one), len(passage)])
    ends = chunk_ends(ids, counts, FORM)
    chunks = [tuple(x.tolist()) for x in np.split(ids, ends[:-1])]
    assert len(one) in ends and sum(map(len, chunks)) == len(ids) and max(map(len, chunks)) <= FORM.most
    assert len(set(chunks)) < 0.6 * len(chunks)
    assert merkle_root([b"a", b"b", b"c"]) != merkle_root([b"a", b"c", b"b"])


def encoded(encoder, texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    ids, counts = encoder.encode(data, np.cumsum([0, *(len(t.encode()) for t in texts)]))
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


def test_segments_with_equal_hashes_are_told_apart(monkeypatch):
    """Hashes of three bits only: nearly all segments clash, and ids stay right."""
    real = token_store.span_hashes
    monkeypatch.setattr(token_store, "span_hashes", lambda data, lengths: real(data, lengths) & np.uint64(7))
    e, r = Encoder(Format(PATH, added=True)), random.Random(2)
    for _ in range(20):
        texts = [" ".join(r.choice(["some", "words", "of", "text,", "Ünder", "test.", "<|endoftext|>", "", "x" * 50]) for _ in range(r.randint(0, 30))) for _ in range(4)]
        assert encoded(e, texts) == [[*PLAIN.encode(t, add_special_tokens=False).ids, 2] for t in texts]


def test_other_tokenizers_encode_whole_texts(tmp_path):
    rules = json.loads(open(PATH, encoding="utf-8").read())
    assert allows_cuts(rules)
    rules["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "t.json").write_text(json.dumps(rules))
    e, plain_one = Encoder(Format(str(tmp_path / "t.json"), added=True)), Tokenizer.from_file(str(tmp_path / "t.json"))
    texts = ["two words, and more", "", " x", "a<|endoftext|>b c"]
    assert not e.cuts and encoded(e, texts) == [[*plain_one.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    for change in ({"normalizer": {"type": "Lowercase"}}, {"truncation": {"max_length": 3}}, {"pre_tokenizer": None}, {"model": rules["model"] | {"dropout": 0.1}}):
        assert not allows_cuts(json.loads(open(PATH, encoding="utf-8").read()) | change)


def test_a_very_long_text(spark):
    text = "all the words of a long text, again. " * 60_000
    store, form = Store(spark, "test-long"), Format(PATH, added=True)
    write_store(spark.createDataFrame([(1, text), (2, text + "!"), (3, "")], "doc_id long, text string"), store, form)
    want, at = [], 0
    for i, t in enumerate([text, text + "!", ""], 1):
        ids = [*PLAIN.encode(t, add_special_tokens=False).ids, 2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, read_summary(spark, store, form).collect())) == want


def damaged(spark, change):
    """A store, read back after change was applied to its table; its rows are written anew."""
    store = Store(spark, "test-damage")
    write_store(spark.createDataFrame([(i, f"text {i} " + "with words " * 30) for i in range(6)], "doc_id long, text string"), store, FORM)
    table = spark.read.schema(token_store.STORED).parquet(store.path("store"))
    new = store.write(change(table), "changed")
    store.drop("store")
    new.write.partitionBy("kind").parquet(store.path("store"))
    return read_summary(spark, store, FORM)


@pytest.mark.parametrize("kind", ["none", "flipped", "missing", "swapped", "root", "recipe", "count"])
def test_damage_is_noticed(spark, kind):
    from pyspark.sql import functions as F

    is_chunk, is_doc = F.col("kind") == "chunk", (F.col("kind") == "doc") & (F.col("doc_id") == 3)
    change = {
        "none": lambda t: t,
        "flipped": lambda t: t.withColumn("ids", F.when(is_chunk, F.concat(F.lit(b"\x07"), F.expr("substring(ids, 2)"))).otherwise(F.col("ids"))),
        "missing": lambda t: t.where(~is_chunk).unionByName(t.where(is_chunk).orderBy("route").offset(1)),
        "swapped": lambda t: t.withColumn("route", F.when(is_chunk, F.reverse(F.col("route").cast("string")).cast("binary")).otherwise(F.col("route"))),
        "root": lambda t: t.withColumn("root", F.when(is_doc, F.unhex(F.sha2("root", 256))).otherwise(F.col("root"))),
        "recipe": lambda t: t.withColumn("recipe", F.when(is_doc, F.reverse("recipe")).otherwise(F.col("recipe"))),
        "count": lambda t: t.withColumn("n_tokens", F.when(is_doc, F.col("n_tokens") + 1).otherwise(F.col("n_tokens"))),
    }[kind]
    if kind == "none":
        assert damaged(spark, change).count() == 6
    else:
        with pytest.raises(Exception, match="damaged|can't be rebuilt"):
            damaged(spark, change).collect()
