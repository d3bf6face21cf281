"""Substring dedup by a Burrows-Wheeler transform and threshold-bounded interval expansion.

Every byte that a string of `length` bytes covers which also starts anywhere else
in the corpus goes. `repeats.rounds` brings the few texts whose repeats are open
together in shards; in a shard

- suffixes are put in order by their first `length` bytes (prefix doubling), and
  the transform is read off that order;
- starting from the intervals of all short strings, intervals are extended
  backward breadth first by every byte that precedes them (the LF mapping of an
  interval's first and last such byte). A new interval's right end gets the
  level as its common prefix if it has none yet, and only such intervals go on,
  so common prefixes come by increasing value, and the expansion stops at
  `length`: ends without a value then lie between suffixes that share `length`
  bytes or more, and those are the repeats.

Defined results: a null text is empty (n_bytes 0, the digest of nothing); texts
shorter than `length` keep all; repeated rows and equal ids are separate
documents, each of which repeats the other; a null id comes back null; other
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .anchors import Bytes
from .chunks import chunk_table
from .common import drop_table, materialize
from .repeats import CHUNK, Job, _binary_rows, merged, open_chunk, removed_windows, rounds

LENGTH = 400
#: Order that the expansion starts from.
FIRST_LEVEL = 28


def suffix_order(code: np.ndarray, ends: np.ndarray, depth: int, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes by at least their first `depth` codes, and at which places of the order the first `level` codes (7 * 2^i) differ from the place before.

    code: 1 + byte, and 0 for the separator after each text; ends: each place's separator. Separators differ from each other.
    """
    n = len(code)
    left = ends - np.arange(n)
    padded = np.concatenate((code, np.zeros(7, code.dtype))).astype(np.int64)
    key = np.zeros(n, np.int64)
    for j in range(7):
        key = (key << 9) | np.where(left > j, padded[j : n + j], 0)
    order = np.argsort(key, kind="stable")
    new = np.ones(n, bool)
    new[1:] = (key[order[1:]] != key[order[:-1]]) | (left[order[1:]] < 7)
    h, at_level = 7, new.copy() if level <= 7 else None
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    while h < depth:
        alone = new & np.append(new[1:], True)
        places = np.flatnonzero(~alone)
        if len(places):
            idx = order[places]
            pair = rank[idx] * n + rank[idx + h]
            by = np.argsort(pair)
            idx, pair = idx[by], pair[by]
            order[places] = idx
            differ = np.ones(len(pair), bool)
            differ[1:] = pair[1:] != pair[:-1]
            new[places] |= differ
            rank[idx] = places[np.maximum.accumulate(np.where(differ, np.arange(len(pair)), 0))]
        h *= 2
        if at_level is None and h >= level:
            at_level = new.copy()
    return order, at_level if at_level is not None else new.copy()


def long_repeats(texts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each text, which of its windows of `length` bytes are found at another place of these texts too."""
    level = min(FIRST_LEVEL, 7 if length < FIRST_LEVEL else FIRST_LEVEL)
    assert length > level >= 7
    raw = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    stops = np.cumsum(sizes + 1) - 1
    code = raw.astype(np.uint16) + 1
    code[stops] = 0
    ends = np.repeat(stops, sizes + 1)
    order, short = suffix_order(code, ends, length, level)
    n = len(code)
    before = code[order - 1]
    # LF: where the suffix one byte longer stands.
    by = np.argsort(before, kind="stable")
    lf = np.empty(n, np.int64)
    lf[by] = np.arange(n)
    known = np.append(short, True)
    lb = np.flatnonzero(short)
    rb = np.append(lb[1:], n)
    for _ in range(level, length):
        if not len(lb):
            break
        size = rb - lb
        single = size == 1
        one = lb[single]
        one = one[before[one] > 0]
        new_lb, new_rb = lf[one], lf[one] + 1
        many = np.flatnonzero(~single)
        if len(many):
            m = size[many]
            flat = np.repeat(lb[many] - np.cumsum(m) + m, m) + np.arange(m.sum())
            c = before[flat].astype(np.int64)
            pair = np.repeat(np.arange(len(many)), m) * 512 + c
            ordered = np.argsort(pair, kind="stable")
            p, f = pair[ordered], flat[ordered]
            head = np.ones(len(p), bool)
            head[1:] = p[1:] != p[:-1]
            first = np.flatnonzero(head)
            last = np.append(first[1:], len(p)) - 1
            byte = p[first] % 512 > 0
            new_lb, new_rb = np.concatenate((new_lb, lf[f[first[byte]]])), np.concatenate((new_rb, lf[f[last[byte]]] + 1))
        fresh = ~known[new_rb]
        lb, rb = new_lb[fresh], new_rb[fresh]
        known[rb] = True
    repeat = np.zeros(n, bool)
    unset = np.flatnonzero(~known[:n])
    repeat[order[unset]] = True
    repeat[order[unset - 1]] = True
    return [repeat[e - s : max(e - s, e - length + 1)] for s, e in zip(sizes.tolist(), stops.tolist(), strict=True)]


def repeat_job(length: int = LENGTH, k: int | None = None, **options) -> Job:
    """k, a multiple of 8, at least half the length: longer grams make smaller regions."""
    k = k or max(8, -(-length * 16 // 25) // 8 * 8)
    return Job(Bytes(length, k), False, lambda texts, owners, want: long_repeats(texts, length), **options)


def dedup(df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, keep_bytes: bool = False, chunk_bytes: int | None = None, **options) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (start, end in bytes), and with keep_bytes the bytes that stay, `kept`."""
    job = repeat_job(length, **options)
    chunks = chunk_table(df, doc_id, text, **({"chunk_bytes": chunk_bytes} if chunk_bytes else {}))
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(span)), *([("kept", pa.binary())] if keep_bytes else [])])

    def finish(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = open_chunk(*(batch[c][i].as_py() for c in CHUNK))
                doc, first, stop = removed_windows(batch["answers"][i].as_py() or [])
                doc, lo, hi = merged(doc, first, stop + length - 1)
                spans: dict[int, list] = {}
                for d, a, b in zip(doc.tolist(), lo.tolist(), hi.tolist(), strict=True):
                    spans.setdefault(d, []).append((a, b))
                rows = []
                for d, (a, b, name, null) in enumerate(zip(chunk.starts.tolist(), chunk.ends.tolist(), chunk.ids.tolist(), chunk.nulls.tolist(), strict=True)):
                    kept, at = [], a
                    for x, y in spans.get(d, ()):
                        kept.append(chunk.raw[at : a + x])
                        at = a + y
                    whole = b"".join([*kept, chunk.raw[at:b]])
                    mine = spans.get(d, [])
                    row = (None if null else name, b - a, b - a - len(whole), len(mine), hashlib.sha256(whole).hexdigest(), [{"start": x, "end": y} for x, y in mine])
                    rows.append((*row, whole) if keep_bytes else row)
                yield from _binary_rows(rows, schema)

    told = rounds(chunks, job)
    out = materialize(told.mapInArrow(finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>" + (", kept binary" if keep_bytes else "")), "substring-dedup")
    drop_table(told)
    chunks.drop()
    return out
