"""Which windows of a corpus repeat: the rounds that suffix-array and automaton dedup share.

1. Every chunk sends the hashes of its regions (see anchors.py), each distinct
   (anchor, content) once, to the bucket of the anchor.
2. A bucket answers every chunk, in a byte per entry, what is known of it: its
   content is elsewhere too (settled), or other contents have its anchor, so its
   text must be compared exactly (send, want), or nothing (most entries).
3. Chunks keep what is settled and send the few open texts to shards, where an
   exact method (`solve`) finds the windows that repeat, and whose they are.
4. Answers are joined to their chunks.

A region that thousands of copies share is one entry of each chunk, so no bucket
gets more of it than there are chunks. An anchor with more contents than
`hot_contents` (in a chunk: `hot_in_chunk`), as in a large group of near copies,
is not compared in one place: its windows are sent as 112-bit hashes, each to its
own bucket, and settled there. Only hashes of equal windows decide anything without
a look at the text; they have at least 96 bits.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import BYTE_VALUES, Bytes, Prefix, Words
from .chunks import Chunk, ChunkTable, open_chunk, pack_columns, unpack_columns
from .common import materialize

SETTLED, SEND, WANT, HOT = 1, 2, 4, 8
COLLAPSED = 255
BLOCK_BYTES = {Bytes: 1 << 18, Words: 1 << 19}


@dataclass(frozen=True)
class Job:
    """tokens: Bytes or Words. earlier: a window goes only if a document with a smaller id has it, else if it starts anywhere else.

    solve(texts, owners): for shard texts of whole regions, per text a boolean array of its windows: does it repeat, or with `earlier` have an owner below its own.
    """

    tokens: Bytes | Words
    earlier: bool
    solve: Callable
    entries_per_bucket: int = 200_000
    hot_contents: int = 256
    hot_in_chunk: int = 32
    shard_bytes: int = 1 << 20


@dataclass
class Found:
    """A chunk's regions (tokens counted from their document's start), by (anchor, content, owner) order, and its entries."""

    doc: np.ndarray
    first: np.ndarray
    stop: np.ndarray
    owner: np.ndarray
    fine: np.ndarray  # a region's entry of (anchor, content)
    anchor: np.ndarray  # per fine entry, like the following
    content: np.ndarray
    count: np.ndarray
    least: np.ndarray
    start: np.ndarray  # its first region
    sent: np.ndarray  # its place among what the chunk sends
    sent_anchor: np.ndarray
    sent_content: np.ndarray
    sent_count: np.ndarray
    sent_least: np.ndarray


def _edges(*columns: np.ndarray) -> np.ndarray:
    """Where a row of sorted columns differs from the one before."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def find(chunk: Chunk, job: Job) -> Found:
    parts = []
    for lo, hi in chunk.blocks(BLOCK_BYTES[type(job.tokens)]):
        base = chunk.starts[lo]
        starts, ends = chunk.starts[lo:hi] - base, chunk.ends[lo:hi] - base
        r, begin, _ = job.tokens.regions(chunk.raw[base : base + ends[-1]], starts, ends)
        origin = starts if begin is None else np.searchsorted(begin, starts)
        shift = origin[r.doc] if len(r.doc) else r.doc
        parts.append((r.anchor, r.content, r.doc + lo, r.first - shift, r.stop - shift))
    anchor, content, doc, first, stop = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.uint64 if i < 2 else np.int64) for i in range(5))
    owner = chunk.ids[doc] if len(doc) else np.zeros(0, np.int64)
    order = np.lexsort((owner, content, anchor)) if job.earlier else np.lexsort((content, anchor))
    anchor, content, doc, first, stop, owner = (x[order] for x in (anchor, content, doc, first, stop, owner))
    start = _edges(anchor, content) if len(anchor) else np.zeros(0, np.int64)
    count = np.diff(np.append(start, len(anchor)))
    fine = np.repeat(np.arange(len(start)), count)
    a, c, least = anchor[start], content[start], owner[start]
    kinds = _edges(a) if len(a) else np.zeros(0, np.int64)
    per = np.diff(np.append(kinds, len(a)))
    crowded = np.repeat(per > job.hot_in_chunk, per)
    head = np.zeros(len(a), bool)
    head[kinds] = True
    sends = ~crowded | head
    sent = np.cumsum(sends) - 1
    n = np.minimum(count, 2).astype(np.uint8)
    lowest = np.repeat(np.minimum.reduceat(least, kinds), per) if len(a) else least
    return Found(doc, first, stop, owner, fine, a, c, count, least, start, sent, a[sends], np.where(crowded, 0, c)[sends].astype(np.uint64), np.where(crowded, COLLAPSED, n)[sends].astype(np.uint8), np.where(crowded, lowest, least)[sends])


def bucket_of(anchor: np.ndarray, n: int) -> np.ndarray:
    """Buckets are ranges of the hash, so sorted entries of a bucket stand together."""
    return (((anchor >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def _slices(buckets: np.ndarray):
    cuts = _edges(buckets) if len(buckets) else np.zeros(0, np.int64)
    for lo, hi in zip(cuts, np.append(cuts, len(buckets))[1:], strict=True):
        yield int(buckets[lo]), int(lo), int(hi)


def _entries(anchor, content, count, least) -> bytes:
    """Sorted entries in few bytes."""
    return pack_columns(np.diff(anchor, prepend=np.uint64(0)), content, count, least)


def codes_of(blobs: list[bytes], job: Job, windows: bool = False) -> list[np.ndarray]:
    """A bucket's answers to each chunk's entries. windows: entries are windows, only `settled` is asked."""
    parts = [unpack_columns(b) for b in blobs]
    anchor = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
    content, count, least = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
    order = np.lexsort((least, content, anchor))
    a, c, n, o = anchor[order], content[order], count[order], least[order]
    start = _edges(a, c)
    size = np.diff(np.append(start, len(a)))
    code = np.zeros(len(a), np.uint8)
    if job.earlier:
        settled = np.repeat(o[start], size) < o
    else:
        settled = np.repeat(np.add.reduceat(np.minimum(n, 2).astype(np.int64), start) > 1, size)
    code[settled] |= SETTLED
    if not windows:
        group = _edges(a)
        rows = np.diff(np.append(group, len(a)))
        is_head = np.zeros(len(a), bool)
        is_head[start] = True
        contents = np.add.reduceat(is_head.astype(np.int64), group)
        collapsed = np.logical_or.reduceat(n == COLLAPSED, group)
        hot = np.repeat(collapsed | (contents > job.hot_contents), rows)
        several = np.repeat((contents > 1) | collapsed, rows)
        if job.earlier:
            # The owners of a content are its least documents; only those with an earlier neighbour in the group can lose windows.
            owners = ~settled
            code[several & owners] |= SEND
            code[several & owners & (np.repeat(np.minimum.reduceat(o, group), rows) < o)] |= WANT
        else:
            code[several & is_head] |= SEND
            code[several & ~settled] |= WANT
        code[np.repeat(collapsed, rows)] = SEND | WANT
        code[hot & (code & (SEND | WANT) > 0)] |= HOT
    back = np.empty_like(code)
    back[order] = code
    return np.split(back, np.cumsum([len(p[0]) for p in parts])[:-1])


def _binary_rows(rows: list[tuple], schema: pa.Schema):
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


CHUNK = ("ids", "nulls", "lengths", "body")


def _chunks(batch):
    for i in range(batch.num_rows):
        yield i, batch["chunk"][i].as_py(), open_chunk(*(batch[c][i].as_py() for c in CHUNK))


def _sender(job: Job, n_buckets: int):
    schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("blob", pa.binary())])

    def send(batches):
        for batch in batches:
            for _, number, chunk in _chunks(batch):
                f = find(chunk, job)
                rows = [(b, number, _entries(f.sent_anchor[lo:hi], f.sent_content[lo:hi], f.sent_count[lo:hi], f.sent_least[lo:hi])) for b, lo, hi in _slices(bucket_of(f.sent_anchor, n_buckets))]
                yield from _binary_rows(rows, schema)

    return send


ANSWER = "chunk long, kind int, shard int, blob binary"
_ANSWER = pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("shard", pa.int32()), ("blob", pa.binary())])


def _answerer(job: Job, kind: int, windows: bool):
    def answer(key, table):
        codes = codes_of(table["blob"].to_pylist(), job, windows)
        rows = [(chunk, kind, key[0].as_py(), pack_columns(c)) for chunk, c in zip(table["chunk"].to_pylist(), codes, strict=True) if c.any()]
        return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(_ANSWER.types)], schema=_ANSWER)

    return answer


def _window_hashes(job: Job, chunk: Chunk, doc: int, first: int, stop: int):
    text = chunk.raw[chunk.starts[doc] : chunk.ends[doc]]
    if isinstance(job.tokens, Bytes):
        return job.tokens.window_hashes(text, first, stop)
    from .anchors import word_spans

    begin, end = word_spans(text, np.array([len(text)]))
    begin, end = begin[first : stop + job.tokens.length - 1], end[first : stop + job.tokens.length - 1]
    return job.tokens.window_hashes(Prefix(BYTE_VALUES[text]).hash(begin, end))


def _text_spans(job: Job, chunk: Chunk, docs: np.ndarray, first: np.ndarray, stop: np.ndarray) -> list[bytes]:
    """The bytes of regions, which stand in order of document."""
    n, out, last = job.tokens.length, [], -1
    for d, f, s in zip(docs.tolist(), first.tolist(), stop.tolist(), strict=True):
        if isinstance(job.tokens, Bytes):
            at = int(chunk.starts[d])
            out.append(chunk.raw[at + f : at + s + n - 1].tobytes())
        else:
            if d != last:
                words, last = chunk.raw[chunk.starts[d] : chunk.ends[d]].tobytes().split(), d
            out.append(b" ".join(words[f : s + n - 1]))
    return out


def _opener(job: Job, n_buckets: int, n_shards: int):
    """Round 3's chunk side: what is settled, and what is open, with the places it belongs to."""

    def opened(batches):
        for batch in batches:
            for i, number, chunk in _chunks(batch):
                f = find(chunk, job)
                sent = np.zeros(len(f.sent_anchor), np.uint8)
                answers = {x["shard"]: x["blob"] for x in batch["answers"][i].as_py() or []}
                for b, lo, hi in _slices(bucket_of(f.sent_anchor, n_buckets)) if answers else ():
                    if b in answers:
                        sent[lo:hi] = unpack_columns(answers[b])[0]
                code = sent[f.sent] if len(f.sent) else sent
                # By itself a chunk knows what its own documents repeat.
                gone = code[f.fine] & SETTLED > 0 if len(f.fine) else np.zeros(0, bool)
                if len(f.fine):
                    gone |= (f.owner > f.least[f.fine]) if job.earlier else (f.count[f.fine] > 1)
                want = code & WANT > 0
                rows = []
                open_ = ~gone & want[f.fine] if len(f.fine) else gone
                by_text = np.flatnonzero((code & (SEND | WANT) > 0) & (code & HOT == 0))
                place = np.full(len(f.anchor), -1, np.int64)
                shards = bucket_of(f.anchor[by_text], n_shards)
                # Texts are cut out document by document, then dealt to shards in anchor order.
                at = f.start[by_text]
                look = np.argsort(f.doc[at], kind="stable")
                texts: list = [b""] * len(at)
                for j, t in zip(look.tolist(), _text_spans(job, chunk, f.doc[at][look], f.first[at][look], f.stop[at][look]), strict=True):
                    texts[j] = t
                for s, lo, hi in _slices(shards):
                    e = by_text[lo:hi]
                    place[e] = np.arange(hi - lo)
                    r = at[lo:hi]
                    part = texts[lo:hi]
                    columns = pack_columns(f.anchor[e], want[e].astype(np.uint8), (f.stop - f.first)[r].astype("<u4"), np.array([len(t) for t in part], "<u4"), f.least[e], np.frombuffer(b"".join(part), np.uint8))
                    rows.append((number, 1, s, columns))
                hot = np.flatnonzero((code & (SEND | WANT) > 0) & (code & HOT > 0))
                window_state = [np.zeros(0, np.int64)] * 4
                if len(hot):
                    h1, h2, who, where, least, wanted = [], [], [], [], [], []
                    for e in hot.tolist():
                        r = int(f.start[e])
                        a, b = _window_hashes(job, chunk, int(f.doc[r]), int(f.first[r]), int(f.stop[r]))
                        h1.append(a)
                        h2.append(b >> np.uint64(16))
                        who.append(np.full(len(a), e))
                        where.append(np.arange(len(a)))
                        least.append(np.full(len(a), f.least[e]))
                    h1, h2, who, where, least = (np.concatenate(x) for x in (h1, h2, who, where, least))
                    o = np.lexsort((least, h2, h1))
                    h1, h2, who, where, least = h1[o], h2[o], who[o], where[o], least[o]
                    start = _edges(h1, h2)
                    size = np.diff(np.append(start, len(h1)))
                    times = np.add.reduceat(np.minimum(f.count[who], 2), start)
                    buckets = bucket_of(h1[start], n_buckets)
                    index = np.zeros(len(start), np.int64)
                    for b, lo, hi in _slices(buckets):
                        index[lo:hi] = np.arange(hi - lo)
                        rows.append((number, 2, b, _entries(h1[start][lo:hi], h2[start][lo:hi], np.minimum(times[lo:hi], 2).astype(np.uint8), least[start][lo:hi])))
                    entry = np.repeat(np.arange(len(start)), size)
                    # A window's answer is about its least document; what the chunk's later ones hold is known here.
                    late = (least > least[start][entry]) if job.earlier else np.zeros(len(entry), bool)
                    window_state = [np.where(late, -1, buckets[entry]), index[entry], who, where]
                owners = ~gone & (code[f.fine] & (SEND | WANT) > 0) if len(f.fine) else gone
                keep = np.flatnonzero(owners | open_)
                state = pack_columns(
                    f.doc[gone].astype("<u4"), f.first[gone].astype("<u4"), f.stop[gone].astype("<u4"),
                    f.doc[keep].astype("<u4"), f.first[keep].astype("<u4"), f.fine[keep] if len(keep) else keep,
                    bucket_of(f.anchor[f.fine[keep]], n_shards) if len(keep) else keep, place[f.fine[keep]] if len(keep) else keep, *window_state,
                )
                rows.append((number, 0, 0, state))
                yield from _binary_rows(rows, _ANSWER)

    return opened


def _solver(job: Job):
    def solved(key, table):
        parts = [unpack_columns(b) for b in table["blob"].to_pylist()]
        anchor, want, n_windows, n_bytes, owner = (np.concatenate([p[i] for p in parts]) for i in range(5))
        row = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
        index = np.concatenate([np.arange(len(p[0])) for p in parts])
        texts = []
        for p in parts:
            ends = np.cumsum(p[3].astype(np.int64))
            raw = p[5].tobytes()
            texts += [raw[e - n : e] for e, n in zip(ends.tolist(), p[3].tolist(), strict=True)]
        order = np.argsort(anchor, kind="stable")
        cuts = np.append(_edges(anchor[order]), len(order))
        out: list[list] = [[] for _ in parts]
        lo = 0
        while lo < len(cuts) - 1:
            # Whole groups of an anchor, up to shard_bytes together.
            hi, held = lo, 0
            while hi < len(cuts) - 1 and (hi == lo or held < job.shard_bytes):
                held += int(n_bytes[order[cuts[hi] : cuts[hi + 1]]].astype(np.int64).sum())
                hi += 1
            members = order[cuts[lo] : cuts[hi]]
            for m, mask in zip(members.tolist(), job.solve([texts[m] for m in members.tolist()], owner[members], want[members].astype(bool)), strict=True):
                if want[m] and mask is not None and mask.any():
                    step = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
                    out[row[m]].append((np.full(len(step) // 2, index[m]), step[::2], step[1::2]))
            lo = hi
        rows = []
        for chunk, found in zip(table["chunk"].to_pylist(), out, strict=True):
            if found:
                rows.append((chunk, 1, key[0].as_py(), pack_columns(*(np.concatenate([x[i] for x in found]).astype("<u4") for i in range(3)))))
        return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(_ANSWER.types)], schema=_ANSWER)

    return solved


def removed_windows(answers: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first, last + 1) of a chunk's windows that go, from all it was told."""
    state = next((unpack_columns(x["blob"]) for x in answers if x["kind"] == 0), None)
    if state is None:
        return (np.zeros(0, np.int64),) * 3
    doc, first, stop, o_doc, o_first, o_fine, o_shard, o_place, w_bucket, w_index, w_fine, w_at = state
    found = [(doc.astype(np.int64), first.astype(np.int64), stop.astype(np.int64))]
    o_doc, o_first = o_doc.astype(np.int64), o_first.astype(np.int64)
    by_shard = np.lexsort((o_place, o_shard))
    where = o_shard[by_shard] * (1 << 40) + o_place[by_shard]
    for x in answers:
        if x["kind"] == 1:
            index, lo, hi = (c.astype(np.int64) for c in unpack_columns(x["blob"]))
            key = x["shard"] * (1 << 40) + index
            a, b = np.searchsorted(where, key), np.searchsorted(where, key, side="right")
            # Every region that has the content, each with all of the ranges found.
            n = b - a
            of = by_shard[np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())]
            found.append((o_doc[of], o_first[of] + np.repeat(lo, n), o_first[of] + np.repeat(hi, n)))
    if len(w_fine):
        gone = w_bucket < 0
        for x in answers:
            if x["kind"] == 2:
                bits = unpack_columns(x["blob"])[0]
                mine = w_bucket == x["shard"]
                gone[mine] = bits[w_index[mine]] & SETTLED > 0
        order = np.argsort(o_fine, kind="stable")
        a, b = np.searchsorted(o_fine[order], w_fine[gone]), np.searchsorted(o_fine[order], w_fine[gone], side="right")
        n = b - a
        of = order[np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())]
        at = o_first[of] + np.repeat(w_at[gone], n)
        found.append((o_doc[of], at, at + 1))
    return tuple(np.concatenate([f[i] for f in found]) for i in range(3))


def merged(doc: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of token ranges, by document; ranges that touch are one."""
    if not len(doc):
        return doc, first, end
    order = np.lexsort((first, doc))
    doc, first, end = doc[order], first[order], end[order]
    # Documents are set apart, so one running maximum serves all.
    gap = int(end.max()) + 2
    lo, hi = first + doc * gap, end + doc * gap
    reach = np.maximum.accumulate(hi)
    new = np.ones(len(doc), bool)
    new[1:] = lo[1:] > reach[:-1]
    at = np.flatnonzero(new)
    stop = np.append(at[1:], len(doc)) - 1
    return doc[at], first[at], reach[stop] - doc[at] * gap


def rounds(chunks: ChunkTable, job: Job) -> DataFrame:
    """The chunk table's rows with all answers to each chunk, for removed_windows()."""
    t = chunks.table
    total = t.agg(F.sum("raw_bytes")).first()[0] or 0
    tokens = total if isinstance(job.tokens, Bytes) else total / 6
    n_buckets = max(1, int(tokens * 2 / (job.tokens.length - job.tokens.k + 2) / job.entries_per_bucket))
    n_shards = 2 * n_buckets
    body = ["chunk", *CHUNK]
    sent = t.select(*body).mapInArrow(_sender(job, n_buckets), "bucket int, chunk long, blob binary")
    told = sent.groupBy("bucket").applyInArrow(_answerer(job, 0, False), ANSWER)
    together = lambda df: df.groupBy("chunk").agg(F.collect_list(F.struct("kind", "shard", "blob")).alias("answers")).hint("shuffle_hash")
    state = materialize(t.select(*body).join(together(told), "chunk", "left").mapInArrow(_opener(job, n_buckets, n_shards), ANSWER), "repeat-state")
    texts = state.filter("kind = 1").groupBy("shard").applyInArrow(_solver(job), ANSWER)
    windows = state.filter("kind = 2").withColumnRenamed("shard", "bucket").groupBy("bucket").applyInArrow(_answerer(job, 2, True), ANSWER)
    answers = state.filter("kind = 0").unionByName(texts).unionByName(windows)
    out = t.select(*body).join(together(answers), "chunk", "left")
    out._scratch_path = state._scratch_path
    return out
