"""BPE encoding over a distinct-word table, and decoding through an id-to-piece table.

The tokenizer's pre-tokenizer never joins text across ASCII blanks, so a text's
ids are its blank-separated words' ids one after another.

1. Spark splits the texts into words. A task packs its texts into chunks: the
   chunk's distinct words, and each text as places in that list.
2. The chunks' words, with chunk and place, are shuffled and sorted by word, so
   equal words of all chunks stand together; each distinct word is encoded once
   and its ids go back to the chunks that asked.
3. Chunks, bucketed so that texts aren't shuffled, join their answers, and every
   text's ids are put together by position.

No word is treated apart: a word that every text has is a row of each chunk, a
word that occurs once is one row. The shuffles hold distinct words of chunks, not
occurrences.

`decode` joins ids with the id-to-piece table and puts pieces together by position.
`digests`, which needs only a hash of the decoded text, looks pieces up by id in
the same table where the ids are made: the vocabulary bounds it, while decoded
texts in a shuffle would be more than the input.

Defined results: a null or empty text has no ids and decodes to an empty text (null
ids to null); repeated rows are encoded each; other columns pass through `encode`
and `decode`; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import ChunkTable, pack_columns, unpack_columns
from .common import fresh_path, materialize, small_batches, tidy, words

#: A chunk ends with the batch that brings it to so many words, or with its task; a task packs so many of the scan's partitions.
CHUNK_WORDS, CHUNK_PARTITIONS = 6 << 20, 2
#: Answers that a task holds before it deals them to chunks.
ANSWER_ROWS = 1 << 19
#: Words of texts whose ids are put together at once.
BLOCK_WORDS = 1 << 18
#: Bytes of a batch between Spark and a task's Python; a longer text is a batch of its own.
BATCH_BYTES = 8 << 20


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    # A task has one core; the library's threads would each keep memory of their own.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    t = Tokenizer.from_file(path)
    t.no_padding()
    t.no_truncation()
    return t


def encode_words(path: str, some: list[str]) -> list[list[int]]:
    """Every word's ids."""
    return [e.ids for e in tokenizer(path).encode_batch_fast(some, add_special_tokens=False)]


@lru_cache(maxsize=2)
def pieces(path: str) -> list[str]:
    """Piece by id."""
    t = tokenizer(path)
    vocabulary = t.get_vocab(with_added_tokens=True)
    out = [""] * (max(vocabulary.values()) + 1)
    for piece, i in vocabulary.items():
        out[i] = piece
    return out


def _ragged(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, .. (n[0] of them), start[1], .."""
    return np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())


def word_chunks(df: DataFrame, key: str, text: str, chunk_words: int = CHUNK_WORDS) -> ChunkTable:
    """Rows of chunk, keys (of its texts), lengths (words of each text), places (of every word in `words`) and words (distinct, the most frequent first, a line each), bucketed by chunk."""
    slim = df.select(F.col(key).alias("key"), words(F.col(text)).alias("w"))
    kind = slim.schema["key"].dataType.simpleString()

    def pack(batches):
        # Words stay in Arrow's memory, in one growing dictionary, and their places in one array; as Python objects they would be several times as large.
        keys, lengths, pending, held = [], [], [], 0
        found, every = pa.array([], pa.string()), np.empty(chunk_words + BLOCK_WORDS, np.uint32)

        def merge():
            """Bring the batches' own dictionaries into the chunk's, whose words keep their places."""
            nonlocal found
            named = pa.concat_arrays([found, *(d for d, _, _ in pending)]).dictionary_encode()
            to, at = named.indices.to_numpy(), len(found)
            for d, start, stop in pending:
                every[start:stop] = to[at + every[start:stop]]
                at += len(d)
            pending.clear()
            found = named.dictionary

        def out():
            merge()
            order = np.argsort(-np.bincount(every[:held], minlength=len(found)), kind="stable")
            rank = np.empty(len(found), np.uint32)
            rank[order] = np.arange(len(found), dtype=np.uint32)
            for at in range(0, held, BLOCK_WORDS):
                stop = min(held, at + BLOCK_WORDS)
                every[at:stop] = rank[every[at:stop]]
            listed = pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), found.take(pa.array(order)))
            lines = pc.binary_join(listed, "\n") if held else pa.nulls(1, pa.string())
            columns = [pa.array([pa.concat_arrays(keys)], pa.list_(keys[0].type)), pa.array([pack_columns(np.concatenate(lengths))]), pa.array([pack_columns(every[:held])]), lines]
            pa.default_memory_pool().release_unused()
            return pa.RecordBatch.from_arrays(columns, names=["keys", "lengths", "places", "words"])

        for b in batches:
            some = b["w"].flatten().dictionary_encode()
            if held + len(some) > len(every):
                every = np.concatenate([every[:held], np.empty(len(some), np.uint32)])
            every[held : held + len(some)] = some.indices.to_numpy()
            pending.append((some.dictionary, held, held + len(some)))
            held += len(some)
            lengths.append(pc.fill_null(pc.list_value_length(b["w"]), 0).to_numpy(zero_copy_only=False).astype(np.uint32))
            keys.append(b["key"])
            del b, some
            if sum(len(d) for d, _, _ in pending) > max(len(found), BLOCK_WORDS):
                merge()
            if held >= chunk_words:
                yield out()
                keys, lengths, held = [], [], 0
                found, every = pa.array([], pa.string()), np.empty(chunk_words + BLOCK_WORDS, np.uint32)
        if keys:
            yield out()

    spark = df.sparkSession
    path, name = fresh_path(spark, "word-chunks"), f"loomline_words_{uuid.uuid4().hex}"
    packed = slim.coalesce(max(1, -(-slim.rdd.getNumPartitions() // CHUNK_PARTITIONS))).mapInArrow(tidy(pack), f"keys array<{kind}>, lengths binary, places binary, words string")
    with small_batches(spark, size=BATCH_BYTES):
        packed.withColumn("chunk", F.monotonically_increasing_id()).write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "chunk").option("compression", "zstd").option("path", path).format("parquet").saveAsTable(name)
    return ChunkTable(spark.table(name), name, path)


def _encoder(path: str, answer_rows: int):
    schema = pa.schema([("chunk", pa.int64()), ("blob", pa.binary())])

    def dealt(parts):
        chunk, place, n, ids = (np.concatenate([p[i] for p in parts]) for i in range(4))
        order = np.lexsort((place, chunk))
        start = np.cumsum(n) - n
        ids, chunk, place, n = ids[_ragged(start[order], n[order])], chunk[order], place[order], n[order]
        cuts = np.append(np.flatnonzero(np.diff(chunk, prepend=chunk[0] - 1)), len(chunk))
        ends = np.append(0, np.cumsum(n))
        rows = [(int(chunk[a]), pack_columns(np.diff(place[a:b], prepend=0).astype("<u4"), n[a:b].astype("<u4"), ids[ends[a] : ends[b]].astype("<u4"))) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    def encode(batches):
        """Rows sorted by word: a distinct word is encoded where its run begins."""
        parts, held, last, last_ids = [], 0, None, []
        for b in batches:
            if not b.num_rows:
                continue
            some = b["word"].dictionary_encode()
            distinct = some.dictionary.to_pylist()
            known = distinct[0] == last
            found = ([last_ids] if known else []) + encode_words(path, distinct[known:])
            last, last_ids = distinct[-1], found[-1]
            size = np.fromiter(map(len, found), np.int32, len(found))
            flat = np.fromiter((i for x in found for i in x), np.uint32, int(size.sum()))
            of = some.indices.to_numpy(zero_copy_only=False)
            parts.append((b["chunk"].to_numpy(zero_copy_only=False), b["place"].to_numpy(zero_copy_only=False), size[of], flat[_ragged((np.cumsum(size) - size)[of], size[of])]))
            held += len(of)
            if held >= answer_rows:
                yield dealt(parts)
                parts, held = [], 0
        if parts:
            yield dealt(parts)

    return encode


def _texts(batch, i: int):
    """(key, ids) of every text of a chunk with its answers."""
    lengths, places = unpack_columns(batch["lengths"][i].as_py())[0].astype(np.int64), unpack_columns(batch["places"][i].as_py())[0]
    parts = [unpack_columns(x) for x in batch["answers"][i].as_py() or []]
    place = np.concatenate([np.cumsum(p[0]) for p in parts]).astype(np.int64) if parts else np.zeros(0, np.int64)
    n, flat = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.uint32) for k in (1, 2))
    n = n.astype(np.int64)
    start, size = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    start[place], size[place] = np.cumsum(n) - n, n
    keys, ends = batch["keys"][i].values, np.cumsum(lengths)
    at = 0
    while at < len(lengths):
        base = int(ends[at] - lengths[at])
        stop = max(at + 1, int(np.searchsorted(ends, base + BLOCK_WORDS, side="right")))
        some = places[base : int(ends[stop - 1])]
        ids = flat[_ragged(start[some], size[some])]
        upto = np.append(0, np.cumsum(size[some]))
        cuts = upto[np.append(0, ends[at:stop] - base)]
        for k in range(stop - at):
            yield keys[at + k], ids[cuts[k] : cuts[k + 1]]
        at = stop


def _encoded(df: DataFrame, key: str, text: str, path: str, columns: list[tuple[str, str, pa.DataType]], make, chunk_words: int, answer_rows: int) -> DataFrame:
    """key and the columns that make(ids) gives of every text, as a table in the shared folder."""
    chunks = word_chunks(df, key, text, chunk_words)
    asked = chunks.table.select("chunk", F.posexplode(F.split("words", "\n")).alias("place", "word")).repartition("word").sortWithinPartitions("word")
    answers = asked.mapInArrow(tidy(_encoder(path, answer_rows)), "chunk long, blob binary").groupBy("chunk").agg(F.collect_list("blob").alias("answers"))
    joined = chunks.table.select("chunk", "keys", "lengths", "places").join(answers.hint("shuffle_hash"), "chunk", "left")
    kind = df.schema[key].dataType.simpleString()

    def finish(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                keys, rows = [], []

                def out():
                    made = [pa.array(c, t) for c, (_, _, t) in zip(zip(*rows, strict=True), columns, strict=True)]
                    return pa.RecordBatch.from_arrays([pa.array(keys, batch["keys"].type.value_type), *made], names=["key", *(n for n, _, _ in columns)])

                held = 0
                for k, ids in _texts(batch, i):
                    keys.append(k.as_py())
                    rows.append(make(ids))
                    held += 64 + len(ids)
                    if held > BLOCK_WORDS:
                        yield out()
                        keys, rows, held = [], [], 0
                if keys:
                    yield out()

    with small_batches(df.sparkSession, 10_000, BATCH_BYTES):
        done = materialize(joined.mapInArrow(tidy(finish), ", ".join([f"key {kind}", *(f"{n} {t}" for n, t, _ in columns)])), "encoded")
    chunks.drop()
    return done


def encode(df: DataFrame, text: str = "text", path: str | None = None, ids: str = "ids", chunk_words: int = CHUNK_WORDS, answer_rows: int = ANSWER_ROWS) -> DataFrame:
    """df with its texts' ids, array<int>. An existing column of that name is refused."""
    if ids in df.columns:
        raise ValueError(f"{ids} is a column already")
    rows = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "rows")
    made = _encoded(rows, "__row", text, path or tokenizer_path(), [(ids, "array<int>", pa.list_(pa.int32()))], lambda x: (x.astype("<i4"),), chunk_words, answer_rows)
    return rows.join(made.withColumnRenamed("key", "__row"), "__row").select(*df.columns, ids)


def piece_table(spark: SparkSession, path: str | None = None) -> DataFrame:
    """id, piece: one row per vocabulary entry."""
    return spark.createDataFrame(list(enumerate(pieces(path or tokenizer_path()))), "id int, piece string")


def decode(df: DataFrame, ids: str = "ids", path: str | None = None, out: str = "decoded") -> DataFrame:
    """df with its ids' text: ids joined with their pieces (the vocabulary bounds what is broadcast), pieces with blanks in between, by position."""
    if out in df.columns:
        raise ValueError(f"{out} is a column already")
    rows = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "rows")
    table = F.broadcast(piece_table(df.sparkSession, path).withColumnRenamed("id", "__id"))
    each = rows.select("__row", F.posexplode(ids).alias("__at", "__id")).join(table, "__id")
    texts = each.groupBy("__row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__at", "piece"))), lambda x: x["piece"]), " ").alias("__text"))
    text = F.when(F.col(ids).isNotNull(), F.coalesce("__text", F.lit(""))).alias(out)
    return rows.join(texts, "__row", "left").select(*df.columns, text)


def digests(df: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, chunk_words: int = CHUNK_WORDS, answer_rows: int = ANSWER_ROWS) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text."""
    path = path or tokenizer_path()

    def make(ids: np.ndarray) -> tuple[int, str, str]:
        decoded = " ".join(map(pieces(path).__getitem__, ids.tolist()))
        return len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

    columns = [("n_tokens", "long", pa.int64()), ("ids_sha256", "string", pa.string()), ("decoded_sha256", "string", pa.string())]
    return _encoded(df, doc_id, text, path, columns, make, chunk_words, answer_rows).withColumnRenamed("key", "doc_id")
