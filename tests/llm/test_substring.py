import hashlib
from collections import Counter, defaultdict

import pytest

from loomline.llm import automata_dedup, suffix_dedup

TIGHT = {"chunk_bytes": 20_000, "entries_per_bucket": 500, "shard_bytes": 3000}
HOT = {"chunk_bytes": 3_000, "hot_contents": 2, "hot_in_chunk": 2, "entries_per_bucket": 50}


def bytes_brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(t[k : k + length] for _, t in texts for k in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if count[t[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def words_brute(rows, length):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    least = defaultdict(lambda: 2**64)
    for i, w in split:
        for k in range(len(w) - length + 1):
            key = tuple(w[k : k + length])
            least[key] = min(least[key], 2**63 if i is None else i)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            if least[tuple(w[k : k + length])] < (2**63 if i is None else i):
                gone[k : k + length] = [True] * length
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return Counter(out)


def near_copies(spark):
    base = [f"w{k * 7919 % 1009}" for k in range(300)]
    rows = []
    for d in range(40):
        w = list(base)
        for j in range(3):
            w[(d * 37 + j * 101) % 300] = f"edit{d}x{j}"
        rows.append((d * 3 % 40, " ".join(w[d % 5 :])))
    return spark.createDataFrame([*rows, (500, "tok " * 400), (501, "tok " * 90), (502, "x" * 3000)], "doc_id long, text string")


@pytest.mark.parametrize("options", [{}, TIGHT, HOT])
def test_byte_repeats_equal_brute_force(spark, docs, odd, empty, options):
    for df, length in ((docs.limit(120), 400), (odd, 400), (near_copies(spark), 100)):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        got = suffix_dedup.dedup(df, length=length, keep_bytes=True, **options).collect()
        assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == bytes_brute(rows, length)
        assert all(len(r.kept) == r.n_bytes - r.n_removed and sum(s.end - s.start for s in r.spans) == r.n_removed for r in got)
    assert suffix_dedup.dedup(empty).count() == 0


@pytest.mark.parametrize("options", [{}, TIGHT, HOT])
def test_word_repeats_equal_brute_force(spark, docs, odd, empty, options):
    for df in (docs, odd, near_copies(spark)):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        got = automata_dedup.dedup(df, keep_text=True, **options).collect()
        assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == words_brute(rows, 13)
    assert automata_dedup.dedup(empty).count() == 0


def test_a_broadcast_reference(spark):
    passage = " ".join(f"p{k}" for k in range(20))
    ref = spark.createDataFrame([(passage,), (None,), ("short",)], "text string")
    df = spark.createDataFrame([(1, "a b " + passage + " c\nd"), (2, passage[:30]), (3, None), (4, "")], "doc_id long, text string")
    got = {r.doc_id: r.kept for r in automata_dedup.against(df, ref).collect()}
    assert got == {1: "a b c d", 2: passage[:30].strip(), 3: None, 4: ""}
    with pytest.raises(ValueError):
        automata_dedup.against(df, ref, max_words=5)
