import hashlib

import numpy as np

import corpus_pipeline
from loomline.llm import bpe, mixing, secret_scans
from loomline.llm.common import materialize
from tests.llm.test_near_dedup import brute_classes
from tests.llm.test_quality_mixing import brute


def passes(text):
    n_words, chars, symbols, dup, inside = brute(text)
    n_lines = len([x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")])
    bad = n_words < 50 or 100 * inside > 50 * n_words or symbols * 20 > chars or (text or "").count("!") * 10 > chars or (dup > 2 and dup * 2 > n_lines) or chars > n_words * 25 or chars < n_words * 2
    return not bad


def test_every_stage_equals_brute_force(spark, docs, odd, empty):
    """Null ids and texts, repeated rows, one id on two texts, extra columns with clashing names, a very long text, an empty table."""
    few = docs.limit(60)
    some = few.selectExpr("if(doc_id % 9 = 3, null, if(doc_id % 10 = 1, doc_id - 1, doc_id)) AS doc_id", "if(doc_id = 7, null, text) AS text", "lang", "source", "n_chars")
    for df in (odd.unionByName(some, allowMissingColumns=True), empty):
        now = materialize(df, "stage")
        for name, stage in corpus_pipeline.STAGES:
            before, now = now, materialize(stage(spark, now, ""), "stage")
            rows, kept = before.collect(), now.collect()
            if name != "tokens":
                assert now.columns == df.columns
            key = lambda r: tuple(str(x) for x in r)
            if name == "quality rules":
                assert sorted(map(key, kept)) == sorted(key(r) for r in rows if passes(r.text))
            elif name == "near-duplicates":
                assert {key(r) for r in kept} <= {key(r) for r in rows}
                assert len(kept) == len({least for (_, least, _) in brute_classes([(k, r.text) for k, r in enumerate(rows)])})
            elif name == "secret scans":
                forest = secret_scans.train()
                want = sorted(secret_scans.cut(r.text, secret_scans.secrets(r.text, *secret_scans.judged(r.text, r.source or "", forest), 0.5), secret_scans.MARK) for r in rows)
                assert sorted(r.text for r in kept) == want and all(r.n_chars == len(r.text) for r in kept)
            elif name == "mixing":
                copies = sorted((str(r.doc_id), r.size) for r in mixing.plan(before).collect() for _ in r.positions)
                assert sorted((str(r.doc_id), brute(r.text)[0]) for r in kept) == copies
            else:
                t = bpe.tokenizer(bpe.tokenizer_path())
                ids = [(r.doc_id, np.array(t.encode(r.text, add_special_tokens=False).ids, "<u4").tobytes()) for r in rows]
                assert sorted(map(str, ((d, len(x) // 4, hashlib.sha256(x).hexdigest()) for d, x in ids))) == sorted(str((r.doc_id, r.n_tokens, r.ids_sha256)) for r in kept)
