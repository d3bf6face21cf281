"""Near-duplicate classes by ProbMinHash, banding and exact verification.

Shingles are runs of five words with their number in the text as weight. Every
shingle is a Poisson process of that rate, seeded by its hash, whose arrivals
fall into m registers; a register keeps its earliest arrival. A text's processes
stop as soon as they pass its largest register (early termination). Two texts
agree in a register with the probability Jaccard similarity of their weights,
sum over d of 1 / sum over e of max(x_e/x_d, y_e/y_d), the Jaccard similarity
where no shingle repeats. Registers form bands; texts with a common band are
candidates (at the threshold 0.8, 32 bands of 7 find 99.9 % of pairs).

Texts equal word by word are one node. Of the members of a band's bucket not all pairs are
made, and no link is lost:

1. every member meets the bucket's hub, the member that most others meet;
2. links join nodes to components, and in buckets that still hold several, each
   component's hub meets the members of the others;
3. what is left, members of different components neither of which was a hub, meet.

A pair is only made where it can be a link. Every node carries a parity bitmap of its
shingles: two bitmaps differ in at most as many bits as the nodes have shingles
apart, which with the nodes' weights and counts bounds their similarity from above
(`could_link`). The bound is part of the join's condition, so pairs that can't reach the
threshold are never rows; those that can are compared by their exact similarity. A bucket
of n copies of one text costs n comparisons; k members without a link cost k
times n evaluations of the bound in the join, and rows only where it lets them pass.

Defined results: a null or blank text has no shingles and is a class of its own;
texts of one to four words have one shingle, the whole text; repeated rows are
one class; a class is named by its least document id (null only if all are null);
extra columns pass through `representatives`; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from .anchors import BYTE_VALUES, Prefix, gram_hashes, mix, word_spans
from .chunks import expand, squeeze
from .common import WORD, drop_table, materialize, small_batches, tidy
from .components import components

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 32, 7
#: Longs of a node's parity bitmap, a power of two. Texts of many more shingles than bits pass the bound and are compared.
BITS = 16
BLOCK_BYTES = 2 << 20
U = np.uint64


def _word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """The hash of every word, each text's first word and last + 1, and two hashes of each text's words."""
    begin, end = word_spans(raw, ends)
    values = Prefix(BYTE_VALUES[raw]).hash(begin, end) if len(raw) else np.zeros(0, U)
    first, stop = np.searchsorted(begin, starts), np.searchsorted(begin, ends)
    return values, first, stop, Prefix(values).hash(first, stop), Prefix(mix(values ^ U(0x5851F42D4C957F2D))).hash(first, stop)


def shingles(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int = SHINGLE):
    """For texts one after another: text, hash and weight of each distinct shingle, by text; and two hashes of each text's words, with their number."""
    n = len(starts)
    values, first, stop, whole, other = _word_hashes(raw, starts, ends)
    grams = gram_hashes(values, size) if len(values) >= size else np.zeros(0, U)
    count = np.maximum(stop - first - size + 1, 0)
    of = np.repeat(np.arange(n), count)
    at = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
    hashes = grams[at]
    short = np.flatnonzero((count == 0) & (stop > first))
    of, hashes = np.concatenate((of, short)), np.concatenate((hashes, mix(whole[short])))
    # 44 bits tell a text's shingles apart; the same 44 in whatever block the text stands.
    assert n < 1 << 20
    key, weight = np.unique((of.astype(U) << U(44)) | (hashes >> U(20)), return_counts=True)
    return (key >> U(44)).astype(np.int64), mix(key & U((1 << 44) - 1)), weight, whole, other, stop - first


def signatures(of: np.ndarray, hashes: np.ndarray, weight: np.ndarray, n: int, m: int) -> np.ndarray:
    """n x m register winners. All elements draw their next arrival together; those beyond their text's largest register stop."""
    time, winner = np.full(n * m, np.inf), np.zeros(n * m, U)
    t, j = np.zeros(len(of)), 0
    of, hashes, rate = of, hashes, 1.0 / weight
    while len(of):
        s = mix(hashes + U((j * 0x9E3779B97F4A7C15) & (2**64 - 1)))
        t = t - np.log(((s >> U(32)).astype(np.float64) + 0.5) / 2**32) * rate
        place = of * m + (((s & U(0xFFFFFFFF)) * U(m)) >> U(32)).astype(np.int64)
        better = t < time[place]
        p, b = place[better], t[better]
        np.minimum.at(time, p, b)
        won = time[p] == b
        winner[p[won]] = hashes[better][won]
        bound = time.reshape(n, m).max(axis=1)
        on = t < bound[of]
        of, hashes, rate, t, j = of[on], hashes[on], rate[on], t[on], j + 1
    return winner.reshape(n, m)


def band_keys(registers: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = np.tile(mix(np.arange(1, bands + 1, dtype=U)), (len(registers), 1))
    for r in range(rows):
        key = mix(key * U(0x9E3779B97F4A7C15) + registers[:, r::rows][:, :bands])
    return key


def similarity(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard similarity of two (sorted hashes, weights)."""
    both, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    a, b = x[1][i].astype(float), y[1][j].astype(float)
    only_x, only_y = x[1].sum() - a.sum(), y[1].sum() - b.sum()
    # Elements by the ratio of their weights: those above d's count with x, those below with y.
    order = np.argsort(a / b, kind="stable")
    a, b = a[order], b[order]
    ratio = a / b
    above = only_x + a.sum() - np.concatenate(([0], np.cumsum(a)))[np.searchsorted(ratio, ratio)]
    below = only_y + np.concatenate(([0], np.cumsum(b)))[np.searchsorted(ratio, ratio)]
    return float((1.0 / (above / a + below / b)).sum())


def _texts(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    texts = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], "<i8", len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets[:-1], offsets[1:]


def _blocks(column):
    """(first row, last + 1, bytes, starts, ends) of about BLOCK_BYTES."""
    raw, starts, ends = _texts(column)
    at = 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + BLOCK_BYTES, side="right")))
        base = starts[at]
        yield at, stop, raw[base : ends[stop - 1]], starts[at:stop] - base, ends[at:stop] - base
        at = stop


def _nodes(whole: np.ndarray, other: np.ndarray, some: np.ndarray | None = None) -> pa.Array:
    """16 bytes for each text, null where `some` is false."""
    data = np.stack((whole, other), axis=1).astype(">u8")
    valid = None if some is None else pa.py_buffer(np.packbits(some, bitorder="little"))
    return pa.Array.from_buffers(pa.binary(), len(whole), [valid, pa.py_buffer(np.arange(len(whole) + 1, dtype="<i4") * 16), pa.py_buffer(data)])


def parity_bits(of: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """n x BITS: bit i is the parity of the number of a text's distinct shingles whose hash falls to i."""
    width = BITS * 64
    place = of * width + (hashes >> U(64 - width.bit_length() + 1)).astype(np.int64)
    odd = (np.bincount(place, minlength=n * width) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<i8").reshape(n, BITS)


def could_link(x: str, y: str, threshold: float) -> Column:
    """Whether the similarity of x and y (structs of weight, shingles, bits) may reach the threshold.

    The nodes have at least `apart` shingles apart, so x at least (apart + x.shingles - y.shingles) / 2 of its own. With u and v
    the shares of their weights that aren't common, the similarity is at most (1 - u) (1 - v) / (1 - u v): the harmonic mean in
    its sum is concave, so the sum is largest where all common shingles have one ratio of weights.
    """
    apart = " + ".join(f"bit_count({x}.bits[{i}] ^ {y}.bits[{i}])" for i in range(BITS))
    u = f"greatest(0, ({apart}) + {x}.shingles - {y}.shingles) / 2.0D / {x}.weight"
    v = f"greatest(0, ({apart}) + {y}.shingles - {x}.shingles) / 2.0D / {y}.weight"
    return F.expr(f"(1 - {u}) * (1 - {v}) >= {threshold - 1e-6!r}D * (1 - ({u}) * ({v}))")


SKETCH = "doc_id long, node binary, bands array<long>, weight long, shingles long, bits array<long>, body binary"


def _lists(values: np.ndarray) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(values.reshape(-1), pa.int64()))


def _sketch(bands: int, rows: int):
    schema = pa.schema([("doc_id", pa.int64()), ("node", pa.binary()), ("bands", pa.list_(pa.int64())), ("weight", pa.int64()), ("shingles", pa.int64()), ("bits", pa.list_(pa.int64())), ("body", pa.binary())])

    def sketch(batches):
        for batch in batches:
            for lo, hi, raw, starts, ends in _blocks(batch["text"]):
                n = hi - lo
                of, hashes, weight, whole, other, words = shingles(raw, starts, ends)
                keys = band_keys(signatures(of, hashes, weight, n, bands * rows), bands, rows).view(np.int64)
                body = [squeeze(raw[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                total = np.bincount(of, weight, n).astype(np.int64)
                columns = [_nodes(whole, other, words > 0), _lists(keys), pa.array(total), pa.array(np.bincount(of, minlength=n)), _lists(parity_bits(of, hashes, n)), pa.array(body, pa.binary())]
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(lo, n), *columns], schema=schema)

    return sketch


def _verify(threshold: float):
    names = ["a", "b", "a_comp", "b_comp"]
    schema = pa.schema([*((n, pa.binary()) for n in names), ("similar", pa.bool_())])

    def verify(batches):
        for batch in batches:
            a, b = batch["a"].to_pylist(), batch["b"].to_pylist()
            texts = dict(zip(a, batch["a_body"], strict=True)) | dict(zip(b, batch["b_body"], strict=True))
            sets, part, held, parts = {}, [], 0, []
            for name, body in texts.items():
                part.append((name, expand(body.as_py())))
                held += len(part[-1][1])
                if held >= BLOCK_BYTES:
                    parts.append(part)
                    part, held = [], 0
            for part in [*parts, part]:
                if part:
                    sizes = np.array([len(t) for _, t in part])
                    ends = np.cumsum(sizes)
                    of, hashes, weight, *_ = shingles(np.frombuffer(b"".join(t for _, t in part), np.uint8), ends - sizes, ends)
                    cut = np.searchsorted(of, np.arange(len(part) + 1))
                    for k, (name, _) in enumerate(part):
                        by = np.argsort(hashes[cut[k] : cut[k + 1]])
                        sets[name] = (hashes[cut[k] : cut[k + 1]][by], weight[cut[k] : cut[k + 1]][by])
            ok = [similarity(sets[x], sets[y]) >= threshold - 1e-9 for x, y in zip(a, b, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch[n].cast(pa.binary()) for n in names), pa.array(ok, pa.bool_())], schema=schema)

    return verify


@F.arrow_udf(BinaryType())
def _node_of(text: pa.Array) -> pa.Array:
    """The node of each text, as _sketch names it; null without a word."""
    out = []
    for _, _, raw, starts, ends in _blocks(text):
        _, first, stop, whole, other = _word_hashes(raw, starts, ends)
        out.append(_nodes(whole, other, stop > first))
    return pa.concat_arrays(out) if out else pa.array([], pa.binary())


def _compared(df: DataFrame, doc_id: str, text: str, threshold: float, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node) of every row, node null without a word; and (node, comp) of the nodes that share a band with another."""
    spark = df.sparkSession
    slim = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    with small_batches(spark):
        sketched = materialize(slim.mapInArrow(tidy(_sketch(bands, rows)), SKETCH), "sketches")
    nodes = sketched.filter("node is not null").groupBy("node").agg(*(F.first(c).alias(c) for c in ("bands", "weight", "shingles", "bits")))
    nodes = materialize(nodes, "nodes")
    # A band's number is part of its key. Shuffled joins at every size: a broadcast would only ever fit small tables.
    banded = nodes.select("node", F.explode("bands").alias("key"))
    several = banded.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1").hint("shuffle_merge")
    met = materialize(banded.join(several, "key"), "buckets")
    degree = met.groupBy("node").agg(F.sum("size").alias("degree"))
    known = nodes.join(degree.hint("shuffle_merge"), "node").select(F.struct("node", "degree", "weight", "shingles", "bits").alias("it"))
    members = materialize(met.select("key", "node").join(known.hint("shuffle_merge"), F.col("node") == F.col("it.node")).select("key", "it"), "members")
    for t in (nodes, met):
        drop_table(t)
    comp = _linked(members, sketched.select("node", "body"), threshold)
    drop_table(members)
    own = sketched.select("doc_id", "node")
    own._scratch_path = sketched._scratch_path
    return own, comp


def _linked(members: DataFrame, bodies: DataFrame, threshold: float) -> DataFrame:
    """members (key, it: node, degree, weight, shingles, bits) -> (node, comp) of all nodes in members."""
    spark = members.sparkSession
    done: list[DataFrame] = []

    def side(t: DataFrame, name: str) -> DataFrame:
        return t.select(F.col("key").alias(f"{name}_key"), F.struct(*t.columns[1:]).alias(name))

    def compare(x: DataFrame, y: DataFrame, also: Column) -> DataFrame | None:
        """Links between x's and y's members of equal keys, by component: (a, b)."""
        fits = (F.col("x_key") == F.col("y_key")) & (F.col("x.comp") != F.col("y.comp")) & also & could_link("x.it", "y.it", threshold)
        met = side(x, "x").join(side(y, "y").hint("shuffle_merge"), fits)
        swap = F.col("x.it.node") > F.col("y.it.node")
        pairs = met.select(*(F.when(swap if n == "a" else ~swap, F.col(f"y.{c}")).otherwise(F.col(f"x.{c}")).alias(n + o) for n in "ab" for c, o in (("it.node", ""), ("comp", "_comp"))))
        pairs = pairs.dropDuplicates(["a", "b"])
        for before in done:
            pairs = pairs.join(before.select("a", "b").hint("shuffle_merge"), ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        if not pairs.take(1):
            return None
        needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        text = materialize(bodies.join(needed.hint("shuffle_merge"), "node", "left_semi").dropDuplicates(["node"]), "bodies")
        body = lambda n: text.select(F.col("node").alias(n), F.col("body").alias(f"{n}_body"))
        with small_batches(spark):
            both = pairs.join(body("a").hint("shuffle_merge"), "a").join(body("b").hint("shuffle_merge"), "b")
            found = both.select("a", "b", "a_comp", "b_comp", "a_body", "b_body").mapInArrow(tidy(_verify(threshold)), "a binary, b binary, a_comp binary, b_comp binary, similar boolean")
            done.append(materialize(found, "verified"))
        drop_table(text)
        drop_table(pairs)
        links = done[-1].filter("similar").select(F.col("a_comp").alias("a"), F.col("b_comp").alias("b"))
        return links if links.take(1) else None

    def joined(t: DataFrame, links: DataFrame | None) -> DataFrame:
        """t with the components that the links make of its own."""
        if links is None:
            return t
        step = components(links).select(F.col("node").alias("was"), F.col("comp").alias("now"))
        out = t.join(step.hint("shuffle_merge"), F.col("comp") == F.col("was"), "left").withColumn("comp", F.coalesce("now", "comp")).drop("was", "now")
        out = materialize(out.select(*t.columns), "components")
        drop_table(step)
        return out

    def open_(t: DataFrame, comp: DataFrame) -> DataFrame:
        """The members of buckets of several components, with them."""
        named = t.select("key", "it", *(c for c in t.columns[2:] if c != "comp")).join(comp.withColumnRenamed("node", "n").hint("shuffle_merge"), F.col("it.node") == F.col("n")).drop("n")
        several = named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("key")
        return named.join(several.hint("shuffle_merge"), "key").select("key", "it", *named.columns[2:])

    first = members.withColumn("comp", F.col("it.node"))
    hubs = first.groupBy("key").agg(F.max_by("it", F.struct("it.degree", "it.node")).alias("it")).withColumn("comp", F.col("it.node"))
    comp = materialize(members.select(F.col("it.node").alias("node"), F.col("it.node").alias("comp")).distinct(), "components")
    comp = joined(comp, compare(hubs, first, F.lit(True)))
    now = materialize(open_(members, comp), "open")
    best = now.groupBy("key", "comp").agg(F.max(F.struct("it.degree", "it.node")).alias("best")).select(F.col("key").alias("k"), F.col("comp").alias("c"), F.col("best.node").alias("h"))
    marked = now.join(best.hint("shuffle_merge"), (F.col("key") == F.col("k")) & (F.col("comp") == F.col("c")))
    now = materialize(marked.select("key", "it", "comp", (F.col("it.node") == F.col("h")).alias("hub")), "open")
    # Two hubs meet once.
    comp = joined(comp, compare(now.filter("hub"), now, ~F.col("y.hub") | (F.col("x.it.node") < F.col("y.it.node"))))
    rest = open_(now.filter("not hub"), comp)
    comp = joined(comp, compare(rest, rest, F.col("x.it.node") < F.col("y.it.node")))
    for t in (*done, now):
        drop_table(t)
    return comp


def classes(df: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of df: doc_id, class_id (the least doc_id of its class), class_size (documents)."""
    own, comp = _compared(df, doc_id, text, threshold, bands, rows)
    named = own.join(comp.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left").select("doc_id", F.coalesce("comp", "node").alias("comp"))
    per = named.filter("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size")).withColumnRenamed("comp", "c")
    out = materialize(named.join(per, F.col("comp") == F.col("c"), "left").select("doc_id", F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("class_size", F.lit(1)).alias("class_size")), "classes")
    for t in (own, comp):
        drop_table(t)
    return out


def representatives(df: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """df with one document of each class, the one of least id (of equal ids the least node, of equal rows one), all columns as they were.

    A row is known by its id and its node, so rows that share an id, or have none, stand for their own class. Rows without a word all stay.
    """
    own, comp = _compared(df, doc_id, text, threshold, bands, rows)
    least = own.filter("node is not null").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id")).alias("d"))
    named = least.join(comp.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left").select("d", "node", F.coalesce("comp", "node").alias("comp"))
    keep = named.groupBy("comp").agg(F.min(F.struct("d", "node")).alias("p")).select(F.col("p.d.doc_id").alias("__d"), F.col("p.node").alias("__n"))
    keep = materialize(keep, "representatives")
    for t in (own, comp):
        drop_table(t)
    has_word = F.coalesce(F.col(text).cast("string").rlike(WORD), F.lit(False))
    full = df.filter(has_word).withColumn("__node", _node_of(F.col(text).cast("string")))
    rows_ = full.join(keep, (F.col("__node") == F.col("__n")) & full[doc_id].cast("long").eqNullSafe(F.col("__d")), "left_semi")
    return rows_.dropDuplicates([doc_id, "__node"]).drop("__node").unionByName(df.filter(~has_word))
