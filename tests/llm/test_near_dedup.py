import random
from collections import Counter, defaultdict

import numpy as np

from loomline.llm import minhash_dedup as near
from loomline.llm.components import components


def brute_similarity(x: Counter, y: Counter) -> float:
    every = set(x) | set(y)
    return sum(1 / sum(max(x[e] / x[d], y[e] / y[d]) for e in every) for d in x if d in y)


def brute_classes(rows, threshold=0.8):
    """Least id of each row's class, all pairs compared."""
    split = [tuple((t or "").encode().split()) for _, t in rows]
    bags = [Counter(zip(*(w[k:] for k in range(5)), strict=False)) if len(w) >= 5 else Counter([w]) for w in split]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if split[i] and split[j] and (split[i] == split[j] or (len(set(bags[i]) & set(bags[j])) * 3 > len(bags[i]) and brute_similarity(bags[i], bags[j]) >= threshold - 1e-9)):
                parent[find(i)] = find(j)
    ids = defaultdict(list)
    for k in range(len(rows)):
        ids[find(k)].append(rows[k][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return Counter((rows[k][0], least[find(k)], len(ids[find(k)])) for k in range(len(rows)))


def test_classes_equal_brute_force(spark, docs, odd, empty):
    r = random.Random(5)
    base = [f"v{r.randrange(900)}" for _ in range(220)]
    rows = [(0, " ".join(base))]
    for k in range(1, 60):  # a star of near copies, mostly too far from each other, and chains
        w = list(base)
        for _ in range(r.randrange(1, 9)):
            w[r.randrange(220)] = f"e{r.randrange(10**6)}"
        rows.append((k, " ".join(w)))
    chain = [f"c{r.randrange(900)}" for _ in range(220)]
    for k in range(100, 112):
        for _ in range(4):
            chain[r.randrange(220)] = f"e{r.randrange(10**6)}"
        rows.append((k, " ".join(chain)))
    rows = [(10**6 + k, t) for k, t in rows]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    # Away from the threshold by more than banding may miss, classes must agree row by row.
    for df in (docs.unionByName(made, allowMissingColumns=True), odd):
        data = [(x.doc_id, x.text) for x in df.collect()]
        got = Counter((x.doc_id, x.class_id, x.class_size) for x in near.classes(df).collect())
        assert got == brute_classes(data)
    assert near.classes(empty).count() == 0


def test_similarity_and_estimate(spark):
    r = random.Random(1)
    words = [f"w{r.randrange(400)}" for _ in range(300)]
    texts = [" ".join(words), " ".join(words[:150] * 2 + words[150:]), " ".join(words[:280] + ["x", "y"] * 10), "one two"]
    raw = [t.encode() for t in texts]
    ends = np.cumsum([len(t) for t in raw])
    of, hashes, weight, *_ = near.shingles(np.frombuffer(b"".join(raw), np.uint8), ends - [len(t) for t in raw], ends)
    sets = []
    for k in range(4):
        h, w = hashes[of == k], weight[of == k]
        by = np.argsort(h)
        sets.append((h[by], w[by]))
    bags = [Counter(zip(*(t.split()[k:] for k in range(5)), strict=False)) for t in texts]
    registers = near.signatures(of, hashes, weight, 4, 4096)
    for i, j in ((0, 1), (0, 2), (1, 2), (0, 0)):
        want = brute_similarity(bags[i], bags[j])
        assert abs(near.similarity(sets[i], sets[j]) - want) < 1e-9
        assert abs((registers[i] == registers[j]).mean() - want) < 0.04
    assert near.similarity(sets[0], sets[3]) == 0


def test_representatives_and_components(spark, odd, empty):
    kept = near.representatives(odd)
    assert kept.columns == odd.columns
    # 2 copies 1, which stands twice; the null id's near copy goes with them.
    assert sorted((x.doc_id for x in kept.collect()), key=str) == sorted((1, 3, 4, 5, 6, 7, 8, 9), key=str)
    assert near.representatives(empty).count() == 0
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 202), (202, 200)]
    got = {x.node: x.comp for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)} | {k: 200 for k in (200, 201, 202)}


def test_representatives_by_row_not_by_id(spark):
    text = lambda k: " ".join(f"t{k}w{j}" for j in range(60))
    rows = [(None, text(1), "a"), (None, text(2), "b"), (None, text(2) + " tail", "c"), (5, text(3), "d"), (5, text(4), "e"), (6, text(5), "f"), (None, text(5) + " tail", "g"), (7, text(5), "h"), (8, text(6), "i"), (8, text(6), "i"), (None, None, "j"), (None, " ", "k"), (8, "", "l")]
    df = spark.createDataFrame(rows, "doc_id long, text string, name string")
    got = near.representatives(df)
    assert got.columns == df.columns
    kept = sorted(r.name for r in got.collect())
    assert "".join(kept) in ("abdefijkl", "acdefijkl")


def test_pipeline_stage_keeps_one_row_of_each_class(spark, docs):
    import corpus_pipeline

    # Every tenth id is missing, every hundredth stands on two texts.
    some = docs.selectExpr("if(doc_id % 10 = 3, null, if(doc_id % 100 = 51, doc_id - 1, doc_id)) AS doc_id", "text", "lang", "source", "n_chars")
    got = corpus_pipeline.near_dedup(spark, some, "")
    data = [(k, x.text) for k, x in enumerate(some.collect())]
    classes = {least: n for (_, least, n) in brute_classes(data)}
    assert got.columns == docs.columns and got.count() == len(classes)
