"""The similarity join against all pairs, plainly computed."""

import random

import pytest
from pyspark.sql import functions as F

from loomspark.operators import dedupe, similarity


def grams(t, width=5):
    w = (t or "").split()
    return {" ".join(w)} if 0 < len(w) <= width else {" ".join(w[i : i + width]) for i in range(len(w) - width + 1)}


def brute(rows, threshold, width=5):
    least, count, out = {}, {}, {}
    for i, t in rows:
        s = frozenset(grams(t, width))
        least[s], count[s] = min(i, least.get(s, i)), count.get(s, 0) + 1
    sets = sorted((i, s) for s, i in least.items() if s)
    for k, (i, a) in enumerate(sets):
        for j, b in sets[k + 1 :]:
            shared = len(a & b)
            if shared * 100 >= round(threshold * 100) * (len(a) + len(b) - shared):
                out[i, j] = (count[a], count[b], shared, shared / (len(a) + len(b) - shared))
    return {(i, least[frozenset(grams(t, width))]) for i, t in rows}, out


def got(spark, rows, threshold, width=5):
    df = spark.createDataFrame([(t, i, "x", 1, "y") for i, t in rows], "text string, name long, id string, n int, digest string").repartition(3)
    members, pairs = similarity.similar(df, "name", "text", width, threshold)
    found = [tuple(r) for r in pairs.collect()]
    assert len({r[:2] for r in found}) == len(found)
    kept = [tuple(r) for r in members.collect()]
    assert len(kept) == len(rows)
    return set(kept), {r[:2]: r[2:] for r in found}


@pytest.mark.parametrize("threshold,width,seed", [(0.8, 5, 1), (0.5, 2, 2), (1.0, 5, 3), (0.33, 1, 4)])
def test_pairs_equal_all_pairs(spark, threshold, width, seed):
    r = random.Random(seed)
    rows = [(0, None), (1, ""), (2, " \n "), (3, "one"), (3, "one"), (4, "one two")]
    for i in range(10, 90):
        base = [r.choice("abcdefgh") + str(r.randrange(3)) for _ in range(r.choice([3, 5, 6, 12, 60]))]
        for k in range(r.randrange(1, 4)):
            own = list(base)
            for _ in range(k):
                own[r.randrange(len(own))] = r.choice(["new", "a1", "b2"])
            rows.append((i * 10 + k, "  ".join(own)))
    rows += [(i + 5000, t) for i, t in rows[-20:]]  # copies
    assert got(spark, rows, threshold, width) == brute(rows, threshold, width)


def test_small_bounds_lose_nothing(spark, monkeypatch):
    """Few ordered shingles, blocks of three sets, cells of two, many groups and no broadcast: the same pairs."""
    r = random.Random(7)
    base = [f"w{r.randrange(400)}" for _ in range(200)]
    rows = []
    for i in range(60):
        own = list(base)
        for _ in range(r.randrange(3)):
            own[r.randrange(200)] = f"v{i}"
        rows.append((i, " ".join(own)))
    want = brute(rows, 0.8)
    assert len(want[1]) > 200
    for name, v in {"FREQUENT": 5, "BLOCK": 3, "CELL": 2, "TASK": 40, "PAIRS": 30, "SMALL": 0}.items():
        monkeypatch.setattr(similarity, name, v)
    assert got(spark, rows, 0.8) == want


def test_broadcasts_in_slices_lose_nothing(spark, monkeypatch):
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(["x" if k == i else w for k, w in enumerate(base)])) for i in range(40)]
    want = brute(rows, 0.6)
    assert len(want[1]) > 100
    for name, v in {"CHUNK": 150, "ROWS": 7, "BITS": 16, "CELL": 8, "SMALL": 30}.items():
        monkeypatch.setattr(similarity, name, v)
    assert got(spark, rows, 0.6) == want


def test_shingles_that_no_other_set_has_are_not_shuffled(spark):
    """Random texts with one near copy: less than half of the sets' bytes are shuffled."""
    r = random.Random(3)
    rows = [(i, " ".join(f"w{r.randrange(10**6)}" for _ in range(400))) for i in range(1_000)]
    rows.append((5_000, rows[0][1] + " more"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    shuffled = lambda: sum(x.totalShuffleWrite() for x in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark.sparkContext._jsc.sc().statusStore().executorList(False)))
    before = shuffled()
    assert [tuple(x)[:5] for x in similarity.similar(df, "doc_id")[1].collect()] == [(0, 5_000, 1, 1, 396)]
    assert shuffled() - before < 1_001 * 396 * 8 / 2


def test_empty_table_and_bad_threshold(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    members, pairs = similarity.similar(df, "doc_id")
    assert members.collect() == [] and pairs.collect() == []
    with pytest.raises(ValueError):
        similarity.similar(df, "doc_id", threshold=0.0)


def test_copies_make_no_candidates(spark):
    """20,000 copies of one text are one class; a shingle that 3,000 short texts share is split among keys."""
    same = spark.range(20_000).select("id", F.lit("all of these rows hold the very same words").alias("text"))
    members, pairs = similarity.similar(same, "id")
    assert members.select("class_id").distinct().collect()[0][0] == 0 and members.count() == 20_000
    assert pairs.collect() == []
    hot = spark.range(3_000).select(F.col("id").cast("string").cast("binary").alias("digest"), F.lit(2).alias("n"), F.array(F.lit(7).cast("long"), F.col("id") + 100).alias("s"))
    assert similarity.candidates(hot, 0.3).count() == 3_000 * 2_999 // 2
    assert dedupe.WIDTH == 5


def test_numbers_of_shingles_equal_the_expressions(spark):
    texts = [None, "", " 　\n", "a", "a b c d e", "a b c d e a b c d e", "x y\x1cz  w v u", "\x00 a\x85b \U0001f600 c d e f", "q " * 50]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    got = df.select(similarity.n_shingles(F.col("text")).alias("n"), F.size(dedupe.shingles(F.coalesce("text", F.lit("")))).alias("want"), F.size(similarity.hashes(F.col("text"))).alias("hashes")).collect()
    assert all(r["n"] == r["want"] == r["hashes"] for r in got)
