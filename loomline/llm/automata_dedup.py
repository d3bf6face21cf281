"""Substring dedup by suffix automata of reference shards.

Every word goes that a window of `length` words covers whose words also stand in
a reference document with a smaller id. A shard's suffix automaton holds its
reference texts; every state knows the least document that its strings are in.
Documents are streamed through it for matching statistics (the longest match
that ends at each word), cut at `length` by suffix links, and the windows whose
state belongs to an earlier document go, as maximal spans.

`against` broadcasts the automaton of a reference of bounded size, as a
benchmark, and streams all documents past it. When the corpus is its own
reference (`dedup`), automata of all of it would be broadcast to all of it, a
square of its size; there `repeats.rounds` first deals reference texts and
document texts that can match to the same shards, by hash, and a shard's
automaton is built where its documents are.

Defined results: a null text has no words; words are compared as they stand; a
null id is after every other (equal ids are never earlier); repeated rows are
separate documents; an empty kept text has the digest of nothing; other columns
are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import Words
from .chunks import LAST_ID, chunk_table
from .common import drop_table, materialize
from .repeats import CHUNK, Job, _binary_rows, merged, open_chunk, removed_windows, rounds

LENGTH = 13
#: Words of a reference that `against` broadcasts, at most.
MAX_WORDS = 2_000_000


class SuffixAutomaton:
    """A suffix automaton of several word sequences; a state's `low` is the least owner of its strings."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.low = [LAST_ID + 1]

    def _state(self, length: int, moves: dict, link: int, low: int) -> int:
        self.length.append(length)
        self.next.append(moves)
        self.link.append(link)
        self.low.append(low)
        return len(self.length) - 1

    def _split(self, parent: int, word, child: int) -> int:
        """The state of parent's longest string + word, cut out of child."""
        copy = self._state(self.length[parent] + 1, dict(self.next[child]), self.link[child], self.low[child])
        self.link[child] = copy
        while parent >= 0 and self.next[parent].get(word) == child:
            self.next[parent][word] = copy
            parent = self.link[parent]
        return copy

    def add(self, words: list, owner: int) -> None:
        nxt, link, length, low = self.next, self.link, self.length, self.low
        last = 0
        for w in words:
            child = nxt[last].get(w)
            if child is not None:
                last = child if length[child] == length[last] + 1 else self._split(last, w, child)
            else:
                new = self._state(length[last] + 1, {}, 0, LAST_ID + 1)
                at = last
                while at >= 0 and w not in nxt[at]:
                    nxt[at][w] = new
                    at = link[at]
                if at >= 0:
                    child = nxt[at][w]
                    link[new] = child if length[child] == length[at] + 1 else self._split(at, w, child)
                last = new
            if owner < low[last]:
                low[last] = owner

    def close(self) -> SuffixAutomaton:
        """Owners go up the suffix links: a string's suffixes are wherever it is."""
        low, link = self.low, self.link
        for s in sorted(range(1, len(low)), key=self.length.__getitem__, reverse=True):
            if low[s] < low[link[s]]:
                low[link[s]] = low[s]
        return self

    def owners(self, words: list, size: int) -> list[int]:
        """For each window of `size` words the least owner that has it, LAST_ID + 1 for none: matching statistics, cut at size."""
        nxt, link, length, low = self.next, self.link, self.length, self.low
        out, state, match = [], 0, 0
        for k, w in enumerate(words, 1):
            to = nxt[state].get(w)
            while to is None and state:
                state = link[state]
                match = length[state]
                to = nxt[state].get(w)
            if to is not None:
                state, match = to, match + 1
                # The suffix of `size` words stands for all that is longer.
                while length[link[state]] >= size:
                    state = link[state]
                match = min(match, size)
            if k >= size:
                out.append(low[state] if match >= size else LAST_ID + 1)
        return out


def earlier_windows(texts: list[bytes], owners: np.ndarray, want: np.ndarray, size: int = LENGTH) -> list[np.ndarray | None]:
    """For each wanted text, which of its windows a text of a smaller owner has."""
    split = [t.split(b" ") for t in texts]
    shard = SuffixAutomaton()
    for words, owner in zip(split, owners.tolist(), strict=True):
        shard.add(words, owner)
    shard.close()
    return [np.array(shard.owners(words, size), object) < owner if w else None for words, owner, w in zip(split, owners.tolist(), want.tolist(), strict=True)]


def _kept(raw: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    words = raw.split()
    out, at = [], 0
    for a, b in spans:
        out += words[at:a]
        at = b
    out += words[at:]
    return len(words), len(words) - len(out), b" ".join(out)


def dedup(df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, keep_text: bool = False, chunk_bytes: int | None = None, **options) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, n_spans, kept_sha256, and with keep_text the words that stay, `kept`."""
    k = max(1, length // 2)
    job = Job(Words(length, k), True, lambda texts, owners, want: [None if m is None else m.astype(bool) for m in earlier_windows(texts, owners, want, length)], **{"shard_bytes": 1 << 19, **options})
    chunks = chunk_table(df, doc_id, text, **({"chunk_bytes": chunk_bytes} if chunk_bytes else {}))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), *([("kept", pa.string())] if keep_text else [])])

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
                    mine = spans.get(d, [])
                    n, gone, kept = _kept(chunk.raw[a:b].tobytes(), mine)
                    row = (None if null else name, n, gone, len(mine), hashlib.sha256(kept).hexdigest())
                    rows.append((*row, kept.decode()) if keep_text else row)
                yield from _binary_rows(rows, schema)

    told = rounds(chunks, job)
    out = materialize(told.mapInArrow(finish, "doc_id long, n_words long, n_removed long, n_spans long, kept_sha256 string" + (", kept string" if keep_text else "")), "substring-dedup")
    drop_table(told)
    chunks.drop()
    return out


def against(df: DataFrame, reference: DataFrame, text: str = "text", reference_text: str = "text", length: int = LENGTH, max_words: int = MAX_WORDS, out: str = "kept") -> DataFrame:
    """df with the column `out`: its texts without the words of windows that the reference has, joined by single spaces.

    The reference is counted first; beyond max_words it isn't broadcast but refused (`dedup` over both tables' union, the reference with the smaller ids, has no such bound).
    """
    n = reference.agg(F.sum(F.size(F.split(F.trim(F.col(reference_text)), "[ \t-\r]+")))).first()[0] or 0
    if n > max_words:
        raise ValueError(f"the reference has {n} words; at most {max_words} are broadcast")
    shard = SuffixAutomaton()
    for row in reference.select(reference_text).dropna().collect():
        shard.add(row[0].encode().split(), 0)
    automaton = df.sparkSession.sparkContext.broadcast(shard.close())

    @F.pandas_udf("string")
    def clean(texts):
        def one(t):
            if t is None:
                return None
            raw = t.encode()
            hit = np.array(automaton.value.owners(raw.split(), length), object) == 0
            step = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
            _, lo, hi = merged(np.zeros(len(step) // 2, np.int64), step[::2], step[1::2] + length - 1)
            return _kept(raw, list(zip(lo.tolist(), hi.tolist(), strict=True)))[2].decode()

        return texts.map(one)

    return df.withColumn(out, clean(F.col(text)))
