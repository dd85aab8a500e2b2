"""Vector codes, token counts and collocations: against plain Python and the tokenizer library, with nulls, ties and long texts."""

import hashlib
import os
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomspark.llm import collocations, token_counts, vector_code
from loomspark.llm.packing import tokenizer_path

SCHEMA = "vec_id long, embedding array<float>, label int, row string, id int, key string, v int, error int"


# vector codes


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 60), st.integers(1, 20), st.integers(0, 6), st.integers(0, 2**32 - 1), st.sampled_from([2, 5, 1000]))
def test_partial_distances_find_the_nearest_entry_and_the_first_of_equals(n, entries, width, seed, spread):
    rng = np.random.default_rng(seed)
    x, book = rng.integers(-spread, spread, (n, width)), rng.integers(-spread, spread, (entries, width))
    want = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
    index, dist = vector_code.nearest(x, book)
    assert index.tolist() == want.argmin(axis=1).tolist() and dist.tolist() == want.min(axis=1).tolist()


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """(vec_id, code, error, label_error, digest) by the definition, one number after the other."""
    kept = sorted((((i is None, i or 0), [int(np.floor(256 * np.float64(np.float32(c)))) for c in v], i, label) for i, v, label in rows), key=lambda x: x[:2])
    width = -(-len(kept[0][1]) // parts)
    cut = [[(v + [0] * (parts * width - len(v)))[p * width : (p + 1) * width] for p in range(parts)] for _, v, _, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(c[p], e, strict=True)), k) for k, e in enumerate(books[p])) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            members = defaultdict(list)
            for c, f in zip(cut, found, strict=True):
                members[f[p][1]].append(c[p])
            books[p] = [[sum(x) // len(members[k]) for x in zip(*members[k], strict=True)] if k in members else e for k, e in enumerate(books[p])]
    found = assign()
    by_label = Counter()
    for (_, _, _, label), f in zip(kept, found, strict=True):
        by_label[label] += sum(d for d, _ in f)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i if i is not None else -1), "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), by_label[label], digest) for (_, _, i, label), f in zip(kept, found, strict=True))


def coded(df):
    return sorted((-1 if r["vec_id"] is None else r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in vector_code.compress(df).select("row.vec_id", "code", "error", "label_error", "codebooks_sha256").collect())


@pytest.mark.parametrize("length", [32, 19])
def test_codes_equal_the_definition(spark, length):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.2, length).astype(np.float32)], [None, 1, 2][i % 3]) for i in rng.permutation(150)]
    rows += [(7, rows[0][1], 1), rows[4], (None, rows[5][1], None)]
    bad = [(200, None, 1), (201, [float("nan")] * length, 1), (202, [0.5] * (length - 1) + [None], 2), (203, [float("inf")] * length, None), (204, [0.1], 1), (205, [], 2), (206, [3e38] * length, 2)]
    df = spark.createDataFrame([(*r, "r", 1, "k", 2, 3) for r in rows + bad], SCHEMA).repartition(5)
    assert coded(df) == plain_codes(rows)


def test_codes_of_few_rows_and_none(spark):
    rows = [(3, [0.5] * 16, 1), (1, [-0.25] * 16, 1), (3, [0.5] * 16, None)]
    df = spark.createDataFrame([(*r, "r", 1, "k", 2, 3) for r in rows], SCHEMA)
    assert coded(df) == plain_codes(rows)
    assert [r[1:4] for r in coded(spark.createDataFrame([(1, [], 4, "r", 1, "k", 2, 3)], SCHEMA))] == [("00" * 16, 0, 0)]
    for none in ([], [(1, None, 1, "r", 1, "k", 2, 3)]):
        assert vector_code.compress(spark.createDataFrame(none, SCHEMA)).collect() == []


def test_rows_of_a_hot_label_do_not_meet(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 16).astype(np.float32)], 1 if i % 3 else i) for i in range(4000)]
    df = spark.createDataFrame([(*r, "r", 1, "k", 2, 3) for r in rows], SCHEMA)
    out = vector_code.compress(df)
    total = sum(r["error"] for r in out.collect() if r["row"]["label"] == 1)
    assert {r["label_error"] for r in out.where("row.label = 1").collect()} == {total}


# token counts


@pytest.fixture(scope="module")
def library():
    tokenizer = token_counts._load(tokenizer_path())
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def counter():
    return token_counts.TokenCounter(tokenizer_path())


def test_proven_strings_are_single_tokens_and_most_of_the_vocabulary(library):
    whole = token_counts.proven(tokenizer_path())
    assert len(whole) > 45_000 and all(library(w) == 1 for w in random.Random(1).sample(whole, 2000))


def test_each_latin_character_is_split_as_by_the_library(library, counter):
    for i in range(0x250):
        c = chr(i)
        for text in (c, f"a{c}b", f" {c} ", f"1{c}{c}  x", f"{c} '{c}s", f"\n{c} .", f".{c}a"):
            assert counter.count(text) == library(text), repr(text)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.characters(max_codepoint=0x24F, exclude_categories=["Cs"]), st.sampled_from(list("   \n\t'streavdlm.,12")), st.sampled_from(["<|endoftext|>", "你", "е", "\u0301", "\u200b", "\u3000", "\ufeff", "\U0001f600"])), max_size=60).map("".join))
def test_counts_equal_the_library(library, counter, text):
    assert counter.count(text) == library(text)


def test_long_texts_in_slices(library, counter):
    r = random.Random(2)
    mixed = "".join(r.choices(["word", " ", "  ", "é", "你好", ". ", "\n", "123", "<|endoftext|>", "'s", " it's"], k=200_000))
    for text in (mixed, "a" * 300_000, " " * 300_000 + "x", "x 1 " * 150_000, "é " * 200_000):
        assert counter.count(text) == library(text)
    assert "".join(token_counts.slices(mixed)) == mixed and len(list(token_counts.slices(mixed))) > 3


def test_token_counts_of_rows(spark, library):
    rows = [(1, "Hello <|endoftext|> there", "r", 5), (2, None, "r", 6), (None, "", "q", None), (1, "Hello <|endoftext|> there", "r", 5), (3, "naïve 你好 " * 900, "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string, n_tokens int").repartition(2)
    got = sorted((r["row"]["doc_id"] or 0, r["row"]["row"], r["n_bytes"], r["n_tokens"]) for r in token_counts.counts(df).collect())
    assert got == sorted((i or 0, x, len((t or "").encode()), library(t or "")) for i, t, x, _ in rows)
    assert token_counts.counts(df.limit(0)).collect() == []


def test_other_tokenizers_are_the_librarys(spark):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    assert token_counts.proven(path) == []
    text = "Some Words, <|endoftext|> and more"
    assert token_counts.TokenCounter(path).count(text) == len(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids)
    model = tokenizer_path("piece_bpe_32k.model")
    if os.path.exists(model):
        import sentencepiece

        assert token_counts.TokenCounter(model).count(text) == len(sentencepiece.SentencePieceProcessor(model_file=model).encode(text))


# collocations


def plain_phrases(rows, least=30, longest=4, top=2000, cover=80):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, own in f.items():
        some = {p: a for p, a in own.items() if a >= least and len(p) > 1}
        gone = {q for p, a in some.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if (q := p[i : i + m]) in some and 100 * a >= cover * some[q]}
        found = []
        for p, a in some.items():
            if p not in gone:
                score, k = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, r, n[lang], -s) for i, (s, a, p, left, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def phrases():
    r = random.Random(9)
    pool = [f"w{i}" for i in range(12)] + ["New", "york", "été", "a b", "x\x01"]
    out = []
    for i in range(160):
        text = "".join(r.choice(pool) + r.choices([" ", "  ", "\t", ". ", ",", "\n", "; "], [12, 1, 1, 1, 1, 1, 1])[0] for _ in range(r.randint(0, 60)))
        out.append((["en", "de", None, "und"][i % 4], text + r.choice(["", "new YORK city hall", "Big. new york"])))
    return out + [("en", None), ("en", ""), ("fr", "..!"), ("de", "same " * 700), ("en", out[0][1]), ("en", out[0][1])]


@pytest.mark.parametrize(("shard", "least", "top", "longest"), [(400_000, 6, 2000, 4), (37, 5, 7, 4), (5, 12, 2000, 3), (64, 8, 50, 2)])
def test_phrases_equal_plain_counts(spark, phrases, shard, least, top, longest, monkeypatch):
    monkeypatch.setattr(collocations, "SLICE", 50)
    df = spark.createDataFrame([(lang, t, 1, "p", 2) for lang, t in phrases], "lang string, text string, n int, phrase string, f int").repartition(3)
    got = collocations.collocations(df, least=least, top=top, longest=longest, shard=shard)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = plain_phrases(phrases, least, longest, top)
    assert len(want) > 8 and sorted(tuple(r) for r in got.collect()) == want


def test_phrases_of_nothing(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(df).collect() == []
    one = spark.createDataFrame([("en", "a b c"), (None, None)], "lang string, text string")
    assert collocations.collocations(one).collect() == []


def test_bitmaps_cross_blocks_and_cuts():
    ids = np.array([0, 1] * 100)
    on = np.ones(200, bool)
    on[[0, 64]] = False
    for level in (2, 3):
        got = Counter()
        for phrases, n in collocations.mine(b"en", pa.array([b"a", b"b"], pa.binary()), ids, on, 200, level, 4, None, None):
            got.update(dict(zip(phrases.to_pylist(), n.tolist(), strict=True)))
        plain = Counter()
        for k in (2,) if level == 2 else (3, 4):
            for i in range(200 - k + 1):
                if on[i + 1 : i + k].all():
                    plain[b" ".join(b"ab"[x : x + 1] for x in ids[i : i + k])] += 1
        assert got == plain


def test_shards_take_little_memory():
    words = np.array([b"w%d" % i for i in range(20_000)], object)
    text = b" ".join(words[np.random.default_rng(3).zipf(1.3, 1_500_000) % len(words)])
    batch = pa.RecordBatch.from_arrays([pa.array([b"en"], pa.binary()), pa.array([text], pa.binary())], names=["lang", "text"])
    tracemalloc.start()
    try:
        shards = list(collocations._shards([batch], collocations.SHARD, 1))
        found = sum(int(n.sum()) for lang, *shard in shards for _, n in collocations.mine(lang, *shard, 2, 2, None, None))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == 1_499_999
    assert peak < 70 << 20


def test_stretches_are_cut_at_spaces_and_see_what_follows():
    text = collocations.fold(b"Alpha beta.. gamma\tdelta " * 50)
    parts = list(collocations.stretches(text, 40, 3))
    assert len(parts) > 20 and b"".join(p[:own] for p, own in parts) == text
    words = [w for w in text.replace(b".", b" ").split()]
    at = 0
    for part, own in parts:
        names, ids, goes_on, begins = collocations.numbered(part, own)
        assert names.take(pa.array(ids)).to_pylist() == words[at : at + begins + 3] and len(goes_on) == len(ids)
        at += begins
    assert at == len(words)
