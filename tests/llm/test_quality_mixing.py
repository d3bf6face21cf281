import re
from collections import Counter, defaultdict

from loomline.llm import mixing, quality_rules

WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall


def brute(text):
    t = text or ""
    w = WORDS(t)
    tri = Counter(zip(w, w[1:], w[2:], strict=False))
    inside = {i + k for i, g in enumerate(zip(w, w[1:], w[2:], strict=False)) if tri[g] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if WORDS(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside)


def test_counts_equal_brute_force(docs, odd):
    for df in (docs, odd):
        texts = defaultdict(set)
        for r in df.select("doc_id", "text").collect():
            texts[r.doc_id].add(brute(r.text))
        got = quality_rules.report(df).collect()
        assert len(got) == df.count()
        for r in got:
            mine = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
            assert mine in texts[r.doc_id]
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert not (r.base_failed and r.kept)


def test_keep_agrees_with_report_in_any_order(docs):
    kept = {r.doc_id for r in quality_rules.report(docs).filter("kept").collect()}
    assert {r.doc_id for r in quality_rules.keep(docs).collect()} == kept
    backwards = quality_rules.cascade(docs, list(quality_rules.RULES[::-1]))
    assert {r.doc_id for r in backwards.filter("rejected_by is null").collect()} == kept
    assert quality_rules.keep(docs).columns == docs.columns


def test_plan_orders_by_rejection_per_cost(docs):
    plan = quality_rules.plan_cascade(docs)
    rates = [p["selectivity"] / p["cost"] for p in plan]
    assert rates == sorted(rates, reverse=True) and len(plan) == len(quality_rules.RULES)


def test_quality_of_an_empty_table(empty):
    assert quality_rules.report(empty).count() == 0 and quality_rules.keep(empty).count() == 0


def water_fill(sizes, weights, cap=3):
    total, target, open_ = sum(sizes.values()), {}, dict(weights)
    while open_:
        rest, w = total - sum(target.values()), sum(open_.values())
        over = [s for s in open_ if rest * open_[s] / w > cap * sizes[s]]
        if not over:
            return target | {s: rest * open_[s] / w for s in open_}
        for s in over:
            target[s] = cap * sizes[s]
            del open_[s]
    return target


def test_targets_equal_water_filling(spark):
    sizes = {"a": 1000, "b": 3, "c": 10, "d": 500, "e": 0, "é": 7, None: 40}
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    weights = {s: k % 3 + 1 for k, s in enumerate(order)}
    df = spark.createDataFrame([(s, 1, n) for s, n in sizes.items()], "source string, n_rows long, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    want = water_fill(sizes, weights)
    assert all(abs(got[s] - want[s]) < 1e-6 for s in sizes)


def test_mix_takes_what_it_should(docs, odd):
    for df in (docs, odd):
        rows = mixing.plan(df).collect()
        assert len(rows) == df.count()
        by = defaultdict(list)
        for r in rows:
            by[r.source].append(r)
        for part in by.values():
            assert sum(r.size for r in part) == part[0].source_size
            largest = max(r.size for r in part)
            assert abs(sum(r.taken for r in part) - part[0].target) <= largest / 2 + 1
            assert all(r.taken <= 3 * r.size and r.taken % max(1, r.size) == 0 and len(r.positions) == r.n_copies for r in part)
            assert all(0 <= p <= 1 for r in part for p in r.positions)


def test_reruns_and_partitions_agree(docs):
    key = lambda df: sorted((r.doc_id, r.taken) for r in mixing.plan(df).collect())
    assert key(docs) == key(docs.repartition(7))


def test_mixed_rows_follow_the_plan(docs, odd, empty):
    for df in (docs, odd):
        want = sum(r.n_copies for r in mixing.plan(df).collect())
        mixed = mixing.mix(df)
        assert mixed.columns == df.columns and mixed.count() == want
    assert mixing.mix(empty).count() == 0 and mixing.plan(empty).count() == 0


def test_curriculum_inverts_the_demand(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(t / 10, s) for t in range(11) for s in (-0.5, 0.0, 0.5, 1.0)], "t double, slope double")
    demand = 7.0 * (F.col("t") + F.col("slope") * (F.col("t") * F.col("t") - F.col("t")))
    back = df.select("t", mixing.position(demand, F.lit(7.0), F.col("slope")).alias("p")).collect()
    assert all(abs(r.t - r.p) < 1e-9 for r in back)


def test_positions_are_places_in_the_mixed_stream(docs):
    rows = mixing.in_order(mixing.plan(docs)).collect()
    firsts = [r.positions[0] if r.positions else 2.0 for r in rows]
    assert firsts == sorted(firsts)
    copies = sorted((p, r.size) for r in rows for p in r.positions)
    total, before = sum(n for _, n in copies), 0
    largest, sources = max(n for _, n in copies), len({r.source for r in rows})
    for p, n in copies:
        assert abs(p - before / total) <= (sources + 1) * largest / total
        before += n
