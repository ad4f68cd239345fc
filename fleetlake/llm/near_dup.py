"""Near-duplicate classes by DartMinHash, banding, and exact verification.

A document's elements are its distinct shingles of five words (lower case, without punctuation; a
shorter text is one shingle of all its words). Two texts are linked if the Jaccard similarity of
their shingle sets is at least 0.8; classes are the connected components of the links, and equal
texts are always of one class. The class id is the smallest ``doc_id`` of the class.

1. *Sketch*: each element owns the region [0, weight) x [0, infinity) of weight and rank. Hashed
   darts hit regions as Poisson processes, every dart falls on one of ``COORDINATES`` coordinates,
   and a signature keeps the earliest dart of each. About ``k ln k`` darts serve a document of any
   size; a document that leaves a coordinate empty is thrown again with twice the rank.
2. *Candidates*: equal texts are collapsed first. Bands of 5 coordinates (32 of them: a pair at 0.8
   shares none with probability 3e-6) and, for documents that meet anyone, also their extensions to
   8 and 13 coordinates, which bring the most similar ones of a crowded bucket together. In a bucket
   every member meets one hub, chosen by hash, so that a bucket costs as many pairs as members.
3. *Verification*: pairs are checked exactly on the shingle sets.
4. *Crowded groups*: documents that met, directly or over others, are a family. In families that
   are still in several components, all members of different components are compared in blocks of
   ``BLOCK`` documents: by signature first (a pair at 0.8 falls below ``NEAR_ENOUGH`` with probability
   2e-5), then exactly. Only links are put out, pairs never are.

Rows with the same ``doc_id`` are one document. Rows with a null id get a null class. Null and
empty texts are equal texts without shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import arrow_rows, documents, free_name, mix64, stage

SHINGLE = 5
BANDS = 32
ROWS = 5
COORDINATES = BANDS * ROWS
DEEPER = (8, 13)
BLOCK = 256
SALTS = 64
NEAR_ENOUGH = 0.67  # part of equal coordinates from which two members of a family are checked exactly
SIMILARITY = (4, 5)  # as a fraction, so that the test is exact
SLICE_CHARS = 1_000_000  # characters sketched at a time: about 20 MB of arrays

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


class _Words(dict):
    """Hash of a word's letters and digits in lower case; 0 if it has none."""

    LIMIT = 150_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        core = "".join(c for c in word.lower() if c.isalnum())
        value = self[word] = (xxhash.xxh3_64_intdigest(core.encode()) | 1) if core else 0
        return value


_WORDS = _Words()


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    words = (text or "").split()
    h = np.fromiter(map(_WORDS.__getitem__, words), dtype=np.uint64, count=len(words))
    h = h[h != 0]
    if not len(h):
        return h
    width = min(SHINGLE, len(h))
    total = np.full(len(h) - width + 1, width, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            total = total * _ODD[4] + mix64(h[i : len(h) - width + 1 + i] * _ODD[i])
    return np.unique(mix64(total))


def dart_sketch(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, k: int = COORDINATES) -> np.ndarray:
    """Signatures (n x k, 32-bit) of weighted sets; rows of documents without elements are 0.

    ``doc`` numbers the document of each (element, weight). Two signatures agree in a coordinate
    with the probability of the sets' weighted Jaccard similarity.
    """
    out = np.zeros(n * k, dtype=np.uint32)
    total = np.bincount(doc, weights=weight, minlength=n)
    reach = np.divide(k * (np.log(k) + 2), total, out=np.zeros(n), where=total > 0)
    # Cells along the weight: [0, 1), [1, 2), [2, 4), ...; a dart outside the weight is ignored.
    cells = 1 + np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64)
    pending = total > 0
    while pending.any():
        use = np.flatnonzero(pending[doc])
        row = np.repeat(use, cells[use])
        cell = np.arange(len(row)) - np.repeat(np.cumsum(cells[use]) - cells[use], cells[use])
        low = np.where(cell == 0, 0.0, 2.0 ** (cell - 1))
        size = np.maximum(low, 1.0)
        base = mix64(element[row] ^ mix64(cell.astype(np.uint64) + np.uint64(1)))
        at, limit, top = doc[row], reach[doc[row]], weight[row]
        rank = np.zeros(len(row))
        keys, ranks, darts, throw = [], [], [], 0
        while len(base):
            throw += 1
            with np.errstate(over="ignore"):
                dart = mix64(base + np.uint64(throw) * _ODD[0])
            rank = rank - np.log(((dart >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / size
            alive = rank <= limit
            base, at, limit, top, rank, low, size, dart = (x[alive] for x in (base, at, limit, top, rank, low, size, dart))
            place = mix64(dart ^ _ODD[1])
            inside = low + size * ((place >> np.uint64(11)).astype(np.float64) * 2.0**-53) < top
            target = mix64(dart ^ _ODD[2])
            keys.append((at * k + (target % np.uint64(k)).astype(np.int64))[inside])
            ranks.append(rank[inside])
            darts.append((target >> np.uint64(32)).astype(np.uint32)[inside])
        key, rank, dart = np.concatenate(keys), np.concatenate(ranks), np.concatenate(darts)
        late_first = np.argsort(-rank, kind="stable")
        out[key[late_first]] = dart[late_first]
        hit = np.zeros(n * k, dtype=bool)
        hit[key] = True
        pending &= ~hit.reshape(n, k).all(axis=1)
        reach[pending] *= 2
    return out.reshape(n, k)


def _sketch_step(cols: dict[str, list]) -> pa.RecordBatch:
    texts = cols["text"]
    sets = [shingles(t) for t in texts]
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    doc = np.repeat(np.arange(len(sets)), sizes)
    signatures = dart_sketch(doc, np.concatenate(sets), np.ones(len(doc)), len(sets))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(cols["doc_id"], pa.int64()),
            pa.array(cols["content"], pa.binary()),
            pa.array([s.tobytes() if n else None for s, n in zip(signatures, sizes)], pa.binary()),
        ],
        names=["doc_id", "content", "signature"],
    )


def _content() -> Column:
    """128 bits of the text, by which equal texts are one."""
    return F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, content hash and signature of every row."""
    named = docs.select("doc_id", "text", _content().alias("content"))
    schema = "doc_id long, content binary, signature binary"
    return arrow_rows(named, ["doc_id", "text", "content"], _sketch_step, schema, batch_chars=SLICE_CHARS, done=_WORDS.clear)


def _keys(depth: int) -> Column:
    """Hashes of the ``BANDS`` runs of ``depth`` coordinates that start at each band's first one."""
    ring = F.concat("signature", "signature")
    return F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.xxhash64(F.lit(depth), b, F.substring(ring, b * (4 * ROWS) + 1, F.lit(4 * depth))),
    )


def _many(exploded: DataFrame) -> DataFrame:
    """``exploded`` to be joined by sorting: Spark expects as many rows as before, and would send many times its limit of a broadcast to the driver."""
    return exploded.hint("merge")


def _meetings(members: DataFrame) -> DataFrame:
    """(a, b): each member of a bucket and the bucket's hub, every pair once."""
    order = F.struct(F.xxhash64("key", "rep").alias("at"), F.col("rep").alias("hub"))
    hubs = members.groupBy("key").agg(F.min(order).alias("first"), F.max("rep").alias("hi"), F.min("rep").alias("lo"))
    hubs = hubs.where("hi <> lo").select("key", F.col("first.hub").alias("hub"))
    return (
        _many(members).join(hubs, "key")
        .where("rep <> hub")
        .select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b"))
        .distinct()
    )


def _set_step(cols: dict[str, list]) -> pa.RecordBatch:
    sets = [shingles(t) for t in cols["text"]]
    doc = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    signatures = dart_sketch(doc, np.concatenate(sets), np.ones(len(doc)), len(sets))
    return pa.RecordBatch.from_arrays(
        [pa.array(cols["rep"], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary()), pa.array([x.tobytes() for x in signatures], pa.binary())],
        names=["rep", "shingles", "signature"],
    )


def alike(left: np.ndarray, right: np.ndarray) -> bool:
    """Whether two sorted sets reach the similarity, exactly."""
    part, whole = SIMILARITY
    if min(len(left), len(right)) * whole < max(len(left), len(right)) * part:
        return False
    both = np.sort(np.concatenate([left, right]))
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return shared > 0 and shared * whole >= (len(both) - shared) * part


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = zip(batch.column(2), batch.column(3))
        keep = [alike(*(np.frombuffer(v.as_py(), dtype=np.uint64) for v in pair)) for pair in sets]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose shingle sets reach the similarity."""
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(_verify, "a long, b long")


def _roots(parents: DataFrame) -> DataFrame:
    """(node, label) with every parent followed to its end; parents are never larger than nodes."""
    while True:
        up = parents.select(F.col("node").alias("at"), F.col("label").alias("above"))
        moved = stage(
            parents.join(up, F.col("label") == F.col("at")).select("node", F.col("label").alias("old"), F.col("above").alias("label")),
            "labels",
        )
        parents = moved.select("node", "label")
        if moved.where("label <> old").isEmpty():
            return parents


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each linked node reaches.

    Every node points to its smallest neighbour, pointers are followed to their ends, and links
    between different ends are all that is left for the next turn, each once. Every step is staged.
    """
    labels = None
    while True:
        edges = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        ends = _roots(edges.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.col("u")).alias("label")))
        labels = ends if labels is None else relabelled(labels, ends)
        left = ends.withColumnsRenamed({"node": "a", "label": "ea"})
        right = ends.withColumnsRenamed({"node": "b", "label": "eb"})
        rest = links.join(left, "a").join(right, "b").where("ea <> eb")
        links = stage(rest.select(F.least("ea", "eb").alias("a"), F.greatest("ea", "eb").alias("b")).distinct(), "links")
        if links.isEmpty():
            return labels


def relabelled(labels: DataFrame, merged: DataFrame) -> DataFrame:
    """Labels after their own components merged; ``merged`` may also bring nodes that are new."""
    to = merged.select(F.col("node").alias("at"), F.col("label").alias("to"))
    old = labels.join(to, F.col("label") == F.col("at"), "left").select("node", F.coalesce("to", "label").alias("label"))
    new = merged.join(labels.select("node"), "node", "left_anti").select("node", "label")
    return stage(old.union(new), "labels")


def _compare_blocks(group: pa.Table) -> pa.Table:
    """Links (a, b) between the components of one block, or of two blocks, of a family."""
    part, block = group["part"].to_numpy(), group["block"].to_numpy()
    low, high = group["low"][0].as_py(), group["high"][0].as_py()
    sets = [np.frombuffer(x, dtype=np.uint64) for x in group["shingles"].to_pylist()]
    signature = np.frombuffer(b"".join(group["signature"].to_pylist()), dtype=np.uint32).reshape(len(sets), -1)
    least = NEAR_ENOUGH * signature.shape[1]
    joined: dict[int, int] = {}

    def top(x: int) -> int:
        while x in joined:
            x = joined[x]
        return x

    out = []
    right = np.flatnonzero(block == high)
    for i in np.flatnonzero(block == low).tolist():
        others = right[right > i] if low == high else right
        others = others[part[others] != part[i]]
        equal = np.count_nonzero(signature[others] == signature[i], axis=1)
        for j in others[equal >= least].tolist():
            x, y = top(int(part[i])), top(int(part[j]))
            if x != y and alike(sets[i], sets[j]):
                joined[max(x, y)] = min(x, y)
                out.append((min(part[i], part[j]), max(part[i], part[j])))
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


def links_in_families(shared: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between components (named by their labels) inside families of ``shared`` buckets.

    For the families every bucket is tied to its smallest member, which crowded buckets mostly
    have in common, so that few different ties are left.
    """
    parts = labels.select(F.col("node").alias("own"), F.col("label").alias("part"))
    smallest = shared.groupBy("key").agg(F.min("rep").alias("a"))
    ties = _many(shared).join(smallest, "key").where("rep <> a").select("a", F.col("rep").alias("b")).distinct()
    members = components(stage(ties, "ties")).withColumnsRenamed({"node": "rep", "label": "family"})
    members = members.join(parts, F.col("rep") == F.col("own"), "left").select("rep", "family", F.coalesce("part", "rep").alias("part"))
    split = members.groupBy("family").agg(F.count("*").alias("n"), F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi")
    blocks = F.ceil(F.col("n") / BLOCK)
    # A family may be large, so its rows meet one of several copies of its number of blocks.
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")
    placed = (
        members.withColumn("salt", F.pmod(F.xxhash64("rep", F.lit("salt")), F.lit(SALTS).cast("long")))
        .join(_many(split.select("family", blocks.alias("blocks"), salts)), ["family", "salt"])
        .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
        .join(sets, "rep")
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
        .select("family", "low", "high", "block", "part", "signature", "shingles")
    )
    return placed.groupBy("family", "low", "high").applyInArrow(_compare_blocks, "a long, b long").distinct()


def _classified(docs: DataFrame) -> DataFrame:
    """(doc_id, content, class_id) for every row of ``docs``, which needs doc_id and text."""
    sketched = stage(sketches(docs), "sketches")
    reps = stage(
        sketched.where("doc_id is not null").groupBy("content", "signature").agg(F.min("doc_id").alias("rep")), "reps"
    )
    signed = reps.where("signature is not null")
    shallow = signed.select("rep", F.explode(_keys(ROWS)).alias("key"))
    crowded = shallow.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo <> hi")
    shared = stage(_many(shallow).join(crowded.select("key"), "key").select("key", "rep"), "buckets")
    active = stage(shared.select("rep").distinct(), "active")
    deep = F.concat(*[_keys(d) for d in DEEPER])
    deeper = signed.join(active, "rep", "left_semi").select(F.explode(deep).alias("key"), "rep")
    texts = docs.select(F.col("doc_id").alias("rep"), "text").join(active, "rep", "left_semi")
    schema = "rep long, shingles binary, signature binary"
    sets = stage(arrow_rows(texts, ["rep", "text"], _set_step, schema, batch_chars=SLICE_CHARS, done=_WORDS.clear), "shingle-sets")

    pairs = stage(_meetings(shared.union(deeper)), "pairs")
    labels = components(stage(verified(pairs, sets.select("rep", "shingles")), "links"))
    missed = stage(links_in_families(shared, labels, sets), "links")
    if not missed.isEmpty():
        labels = relabelled(labels, components(missed))

    classes = reps.join(labels, F.col("rep") == F.col("node"), "left").select(
        "content", F.coalesce("label", "rep").alias("class_id")
    )
    known = sketched.where("doc_id is not null").select("doc_id", "content").join(classes, "content")
    nobody = sketched.where("doc_id is null").select("doc_id", "content", F.lit(None).cast("long").alias("class_id"))
    return known.select("doc_id", "content", "class_id").union(nobody)


def near_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id) for every row of ``docs``, which needs doc_id and text."""
    return _classified(docs).select("doc_id", "class_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that are not the smallest of their class; columns unchanged.

    Rows go by id and text, so an id that has a copy and a text of its own keeps the latter. Of repeated rows
    with the same id and text one stays; rows without an id all stay.
    """
    content, gone_id, gone_text = (free_name(docs, x) for x in ("_content", "_gone_id", "_gone_text"))
    classed = stage(_classified(docs).where("doc_id is not null"), "classes")
    gone = classed.where("doc_id <> class_id").select(F.col("doc_id").alias(gone_id), F.col("content").alias(gone_text)).distinct()
    repeated = classed.where("doc_id = class_id").groupBy("doc_id", "content").agg(F.count("*").alias("n")).where("n > 1")
    # Written, so that Spark knows how few there are.
    repeated = stage(repeated.select(F.col("doc_id").alias(gone_id), F.col("content").alias(gone_text)), "repeated")
    same = (F.col("doc_id") == F.col(gone_id)) & (F.col(content) == F.col(gone_text))
    kept = docs.withColumn(content, _content()).join(gone, same, "left_anti")
    once = kept.join(repeated, same, "left_semi").dropDuplicates(["doc_id", content])
    return kept.join(repeated, same, "left_anti").unionByName(once).select(docs.columns)


def op6_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(documents(spark, sf_dir).select("doc_id", "text"))
