import random

from pyspark.sql import functions as F

from loomline.functions import text as tx
from loomline.operators import chunking, dedup, gate, generate, layout, leakage, records, resume, split, stats


def fold(counts, size, overlap):
    """A plain fold to hold the expression against."""
    out, start = [], 0
    i = 0
    held = []
    for i, w in enumerate(counts):
        held.append(i)
        if sum(counts[j] for j in held) >= size or i == len(counts) - 1:
            out.append((held[0], i))
            keep, total = [], 0
            for j in reversed(held):
                if keep and total + counts[j] > overlap:
                    break
                keep.insert(0, j)
                total += counts[j]
            held = keep[1:] if len(keep) == len(held) else keep
    return out


def test_chunk_fold_on_random_books(spark):
    r = random.Random(4)
    cases = [([r.choice((0, 0, 1, 2, 5, 9, 30)) for _ in range(r.randrange(0, 40))], size, overlap) for size, overlap in ((10, 3), (7, 7), (5, 50), (1, 0)) for _ in range(60)]
    for size, overlap in {(s, o) for _, s, o in cases}:
        mine = [c for c, s, o in cases if (s, o) == (size, overlap)]
        df = spark.createDataFrame(list(enumerate(mine)), "k int, c array<int>")
        got = {x.k: [(s.st, s.en) for s in x.s] for x in df.select("k", chunking.spans(F.col("c"), size, overlap).alias("s")).collect()}
        assert got == {k: fold(c, size, overlap) for k, c in enumerate(mine)}


def test_chunks_of_books(spark):
    rows = [("A", 0, "one two three four", "Ch 1", 1), ("A", 1, "five six seven eight", "Ch 1", 1), ("A", 2, "nine ten eleven twelve", "Ch 2", 2), ("A", 3, "thirteen fourteen fifteen sixteen", "Ch 2", 3), ("B", 0, "short", "P", 1)]
    df = spark.createDataFrame(rows, "source_book string, ord int, text string, chapter string, page int")
    for part in (df, df.repartition(7)):
        got = chunking.chunks(part, 10, 3).orderBy("source_book", "chunk_id").collect()
        assert [(r.source_book, r.chunk_id, r.chapter, r.start_page, r.end_page) for r in got] == [("A", "chunk_001", "Ch 2", 1, 2), ("A", "chunk_002", "Ch 2", 2, 3), ("B", "chunk_001", "P", 1, 1)]
        assert got[1].source_chunk == "nine ten eleven twelve\n\nthirteen fourteen fifteen sixteen"
    assert chunking.chunks(df.limit(0)).count() == 0 and chunking.first_chunks(chunking.chunks(df, 10, 3), 1).count() == 1


def test_layout(spark):
    rows = [("B", 1, 0, 10.0, 40.0, "header"), ("B", 1, 2, 100.0, 120.0, "second"), ("B", 1, 1, 100.0, 120.0, "first tie"), ("B", 1, 3, 60.0, 80.0, "Chapter 1: Go"), ("B", 1, 4, 790.0, 800.0, "footer"), ("B", 2, 0, 60.0, 70.0, "www.allitebooks.com"), ("B", 2, 1, 90.0, 99.0, "opti-\nmal"), ("B", 2, 2, 95.0, 99.0, "2. Next Part"), ("A", 1, 0, 60.0, 80.0, "alone")]
    df = spark.createDataFrame([(b, p, k, 0.0, y0, 9.0, y1, 840.0, t) for b, p, k, y0, y1, t in rows], "source_book string, page int, block_ord int, x0 double, y0 double, x1 double, y1 double, page_height double, text string")
    got = layout.cleaned(layout.segments(df)).orderBy("source_book", "ord").collect()
    assert [(r.source_book, r.text, r.chapter) for r in got] == [("A", "alone", "Preface"), ("B", "Chapter 1: Go", "Chapter 1: Go"), ("B", "first tie", "Chapter 1: Go"), ("B", "second", "Chapter 1: Go"), ("B", "optimal", "Chapter 1: Go"), ("B", "2. Next Part", "2. Next Part")]
    flat = {r.source_book: r.text for r in layout.flat_text(layout.segments(df)).collect()}
    assert flat["A"] == "alone" and flat["B"].startswith("Chapter 1: Go\n\nfirst tie\n\nsecond")


def scan(texts, least=50, most=16384):
    seen, out = set(), []
    for t in texts:
        t = t or ""
        n, h = len(t.strip()), " ".join(t.lower().split())
        if not n:
            out.append("empty")
        elif n < least:
            out.append("short")
        elif h in seen:
            out.append("duplicate")
        elif len(t) > most:
            out.append("long")
        else:
            seen.add(h)
            out.append(None)
    return out


def test_gate_equals_a_stateful_scan(spark):
    r = random.Random(9)
    pool = [None, "", " \n", "short", "a" * 60, "A" * 60 + " ", "b" * 17000, "b" * 60, " " * 17000 + "c" * 60, "c" * 60]
    names = {"Field": "empty", "Formatted": "short", "Duplicate": "duplicate", "Excessive": "long"}
    for _ in range(6):
        texts = [r.choice(pool) for _ in range(40)]
        df = spark.createDataFrame(list(enumerate(texts)), "ord int, text string").repartition(5)
        got = [x.reason and names[x.reason.split()[0]] for x in gate.gate_texts(df).orderBy("ord").collect()]
        assert got == scan(texts)


def test_gate_that_keeps_little_equals_the_whole(spark):
    r = random.Random(10)
    pool = [None, "", "\u3000\n", "short", "a" * 60, "A" * 60 + "\u00a0", "b" * 17000, "b" * 60, " " * 17000 + "c" * 60, "c" * 60]
    rows = [(k if k % 9 else None, "en", r.choice(pool)) for k in range(90)]
    df = spark.createDataFrame(rows, "ord int, lang string, text string").repartition(5)
    some = gate.gate_texts(df, keep=("lang",), hashed="hash")
    assert some.columns == ["ord", "lang", "hash", "reason"]
    whole = gate.gate_texts(df).select("ord", "lang", F.when(F.length(tx.strip(F.col("text"))) >= 50, tx.text_hash(F.col("text"))).alias("hash"), "reason")
    assert sorted(map(repr, some.collect())) == sorted(map(repr, whole.collect()))


def test_gate_pairs_and_report(spark):
    rows = [(0, "q1", "r" * 30), (1, "q2", "s" * 30), (2, " ", "r" * 30), (3, "q", "tiny"), (4, None, None), (5, "Q1", "R" * 30), (6, "q", "y" * 30)]
    df = spark.createDataFrame(rows, "ord int, instruction string, response string")
    gated = gate.gate_pairs(df, min_length=20, missing={"response": F.col("ord") == 4, "instruction": F.col("ord") == 6})
    reasons = [r.reason for r in gated.orderBy("ord").collect()]
    assert reasons[:2] == [None, None] and reasons[2].startswith("Field 'instruction'") and reasons[3] == "Response too short (4 chars < 20)" and reasons[5] == gate.DUPLICATE and reasons[6].startswith("Missing required field: 'instruction'")
    assert tuple(gate.gate_report(gated).first()) == (7, 2, 5, 1, "FAIL")
    assert tuple(gate.gate_report(gated.limit(0)).first()) == (0, 0, 0, 0, "FAIL")
    issues = gate.gate_issues(gated, limit=2).collect()
    assert [i["index"] for i in issues] == [2, 3] and issues[0].record_sample.startswith('{"ord":2')


def test_dedup(spark):
    rows = [(0, "What is AI?"), (1, "what is ai?"), (2, "What  is\tAI ?"), (3, "Other"), (4, None), (5, " ")]
    df = spark.createDataFrame(rows, "ord int, instruction string")
    assert sorted(r.ord for r in dedup.by_signature(df.repartition(6)).collect()) == [0, 3]
    assert sorted(r.ord for r in dedup.unseen(df, df.filter("ord = 2")).collect()) == [3, 4, 5]
    pairs = spark.createDataFrame([(0, "a", "b"), (1, "A ", "b"), (2, "a", "c"), (3, None, "c")], "ord int, instruction string, response string")
    assert sorted(r.ord for r in dedup.by_pair_hash(pairs).collect()) == [0, 2]


FULL = '{"instruction": "%s", "response": "%s", "concept": "c", "difficulty": "easy", "chapter": %s, "source_book": "b"}'


def test_strict_records(spark):
    ok = '{"instruction": " i ", "response": "%s", "concept": "c", "difficulty": "intermediate"}' % ("r" * 50)
    answers = [ok, ok.replace("intermediate", "none"), ok.replace("r" * 50, "short"), '{"instruction": "i"}', ok.replace('"c"', "3"), "[1]", "{}", "no", None, "```json\n" + ok + "\n```", ok.replace('"c"', "null")]
    df = spark.createDataFrame(list(enumerate(answers)), "ord int, answer string")
    got = records.validate_strict(records.parse_answers(df), min_response=50).orderBy("ord").collect()
    assert [r.status for r in got] == ["ok", "invalid", "invalid", "invalid", "invalid", "not_an_object", "generation_failed", "generation_failed", "generation_failed", "ok", "invalid"]
    assert (got[0].instruction, got[0].difficulty, got[1].instruction) == ("i", "Intermediate", None)


def test_merge(spark):
    long = "A complete answer."
    generated = [FULL % ("What?", "Hello! " + long, '"1"')]
    batches = [FULL % ("what?", long, "null"), FULL % ("Else?", "x", '" "'), '{"instruction": "q"}', '{"instruction": 3, "response": "r", "concept": "c", "difficulty": null, "chapter": 1, "source_book": "b"}', FULL % ("Keep", "Sure, fine", "2")]
    make = lambda rows: spark.createDataFrame(list(enumerate(rows)), "ord int, t string").select("ord", F.parse_json("t").alias("value"))
    got = records.merge(make(generated), make(batches)).orderBy("source_rank", "ord").collect()
    assert [(r.source_rank, r.ord, r.response, r.difficulty, r.chapter) for r in got] == [(0, 0, long, "Intermediate", "1"), (1, 4, "fine", "Intermediate", "2")]
    reasons = make(batches).select("ord", records.merge_reason(F.col("value")).alias("r")).orderBy("ord").collect()
    assert [r.r for r in reasons] == [None, "missing_chapter", "missing_response", "non_string_field", None]
    filled = make(['{"concept": null}']).select(*[v.alias(n) for n, v in records.with_defaults(F.col("value"), {"concept": "", "difficulty": "Intermediate"}).items()]).first()
    assert tuple(filled) == (None, "Intermediate")


def test_split(spark):
    for n, fraction in ((2, 0.5), (1000, 0.1), (7, 0.1), (1, 0.1), (0, 0.1)):
        df = spark.range(n)
        got = split.train_val(df, "id", fraction)
        assert tuple(split.split_sizes(got).first()) == (n, n - split.quota(n, fraction), split.quota(n, fraction))
        again = split.train_val(df.repartition(17), "id", fraction)
        assert {(r.id, r.split) for r in got.collect()} == {(r.id, r.split) for r in again.collect()}
    assert split.schedule(900) == {"steps_per_epoch": 112, "eval_steps": 25, "save_steps": 50} and split.schedule(3) == {"steps_per_epoch": 1, "eval_steps": 5, "save_steps": 10}
    assert split.schedule_rows(spark.createDataFrame([(900,)], "train long")).first().asDict() == split.schedule(900)


def test_statistics(spark):
    rows = [("Beginner", "abcd", " X "), ("beginner", "ab", "x"), ("Advanced", "", ""), ("Intermediate", None, " ")]
    got = stats.dataset_statistics(spark.createDataFrame(rows, "difficulty string, response string, concept string")).first()
    assert tuple(got) == (4, 1, 1, 1, 1.5, 2)
    empty = stats.dataset_statistics(spark.createDataFrame([], "difficulty string, response string, concept string")).first()
    assert tuple(empty) == (0, 0, 0, 0, 0.0, 0)
    answers = spark.createDataFrame([("x" * 21,), ("x" * 20,), (None,)], "generated_response string")
    assert tuple(stats.evaluation_summary(answers).first()) == (3, 1, 41 / 3)
    run = spark.createDataFrame([(s,) for s in ("ok", "ok", "duplicate", "invalid", "pending")], "status string")
    assert tuple(stats.generation_report(run, existing=3, failed_before=1).first()) == (5, 6, 2, 6, 1, 5)


def test_leakage_and_resume(spark):
    train = spark.createDataFrame([("A text", None), (None, "what  IS it")], "text string, instruction string")
    asked = spark.createDataFrame([(1, "What is it"), (2, "a TEXT "), (3, "new"), (4, "new"), (5, None)], "k int, instruction string")
    assert sorted(r.k for r in leakage.leaked(asked, train).collect()) == [1, 2]
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "chunk_id string")
    assert sorted(r.chunk_id for r in resume.pending(ids("a", "b", "c", "d"), ids("b"), ids("c", "z")).collect()) == ["a", "d"]
    fails = lambda *x: spark.createDataFrame(list(x), "chunk_id string, reason string, timestamp string")
    got = resume.upsert_failed(fails(("a", "old", "0")), fails(("a", "new", "1"), ("b", "late", "3"), ("b", "first", "2")))
    assert sorted(tuple(r) for r in got.collect()) == [("a", "old", "0"), ("b", "first", "2")]
    row = resume.checkpoint(ids("b", "a", "a")).first()
    assert row.completed_chunks == ["a", "b"] and row.generated_examples == 3


def test_generation_interface(spark):
    df = spark.createDataFrame([("c1", "alpha beta gamma delta"), ("c2", "bad")], "chunk_id string, source_chunk string")

    def flaky(prompt):
        if prompt.endswith("bad"):
            raise ValueError
        return generate.stub(prompt)

    made = records.validate_strict(records.parse_answers(generate.answers(df, flaky))).orderBy("chunk_id").collect()
    assert [r.status for r in made] == ["ok", "generation_failed"] and made[0].difficulty == "Beginner"
    assert tx.GREETINGS[0] == "Hello!?"
