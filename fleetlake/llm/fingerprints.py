"""Document fingerprints from improbable features in chained Bloom filters.

Every window of 32 bytes of a text's UTF-8 form is a possible feature. Windows are ranked by how
rare their entropy is in the whole corpus (one pass counts the entropies of all windows). In every
run of 32 neighbouring windows the rarest one, of equals the first, gets a point; windows with at
least 6 points, or else the best one, become the features of the text. Features are set with 5
hashes in Bloom filters of 2048 bits that hold 160 features each, one filter after the other.

Likeness compares each filter of the text with fewer filters to all filters of the other: bits in
common beyond what chance gives, as a part of the most that is possible; the best match of each
filter counts by its number of features. Equal texts have equal fingerprints; texts shorter than a
window are one feature; empty texts have an empty fingerprint, which is like nothing but itself.

Documents are laid out in ranges of ``doc_id``; the first document of each range is sent to the
range before it as well, so that every document meets its successor without a global sort. Equal
ids are ordered by their text, null ids come first; repeated rows follow one another.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import arrow_rows, documents, mix64, scratch_path

WINDOW = 32
RUN = 32
POINTS = 6
BITS = 2048
HASHES = 5
CAPACITY = 160
LEVELS = 512  # entropy classes
CHUNK = 1 << 20
LANES = 2048
GROUP_BYTES = 2_000_000
RANGE_CHARS = 8_000_000

_COUNT = np.arange(WINDOW + 2)
# Sum of c * log2(c) over the byte counts of a window, in integers; entropy falls as it rises.
_TERM = np.rint(_COUNT * np.log2(np.maximum(_COUNT, 1)) * 4096).astype(np.int32)
_UP = np.diff(_TERM)
_MOST = int(_TERM[WINDOW])


def window_classes(data: np.ndarray) -> np.ndarray:
    """Entropy class (0 .. LEVELS - 1) of every window of the bytes, by sliding byte counts.

    The bytes are cut into lanes that slide side by side; counts change by one byte in and one out.
    """
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint16)
    lanes = max(1, min(LANES, n // 256))
    length = -(-n // lanes)
    padded = np.zeros(lanes * length + WINDOW, dtype=np.uint8)
    padded[: len(data)] = data
    # step[t] holds byte t of every lane, beside the lane's place in the table of counts.
    table = np.zeros(lanes * 256, dtype=np.uint8)
    base = (np.arange(lanes, dtype=np.int32) * 256)[None, :]
    starts = np.lib.stride_tricks.as_strided(padded, (lanes, length + WINDOW - 1), (length, 1))
    step = np.ascontiguousarray(starts.T).astype(np.int32) + base
    total = np.zeros(lanes, dtype=np.int32)
    out = np.empty((length, lanes), dtype=np.int32)
    up, down = _UP, np.concatenate([[0], -_UP]).astype(np.int32)
    for t in range(length + WINDOW - 1):
        at = step[t]
        count = table[at]
        total += up[count]
        table[at] = count + 1
        if t >= WINDOW - 1:
            out[t - WINDOW + 1] = total
            at = step[t - WINDOW + 1]
            count = table[at]
            total += down[count]
            table[at] = count - 1
    sums = np.ascontiguousarray(out.T).ravel()[:n]
    return ((_MOST - sums).astype(np.int64) * (LEVELS - 1) // _MOST).astype(np.uint16)


def classes_of(data: np.ndarray) -> np.ndarray:
    """``window_classes`` in chunks, so that memory does not follow the longest text."""
    n = len(data) - WINDOW + 1
    parts = [window_classes(data[i : min(i + CHUNK, n) + WINDOW - 1]) for i in range(0, max(n, 0), CHUNK)]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint16)


def _sliding_first_min(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours (a power of two) by doubling."""
    size = 1
    while size < width:
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    return key


def pick(rank: np.ndarray) -> np.ndarray:
    """Places of the chosen windows, given the rarity rank of every window (0 is the rarest)."""
    n = len(rank)
    width = RUN
    while width > n:
        width //= 2
    best: list[tuple[np.ndarray, np.ndarray]] = []
    last_place, last_points = -1, 0
    for i in range(0, n - width + 1, CHUNK):
        part = rank[i : i + CHUNK + width - 1].astype(np.int64)
        low = _sliding_first_min((part << 32) | np.arange(i, i + len(part)), width) & 0xFFFFFFFF
        place, points = np.unique(low, return_counts=True)
        if place[0] == last_place:
            points[0] += last_points
        elif last_place >= 0:
            best.append((np.array([last_place]), np.array([last_points])))
        last_place, last_points = int(place[-1]), int(points[-1])
        best.append((place[:-1], points[:-1]))
    best.append((np.array([last_place]), np.array([last_points])))
    places, points = np.concatenate([p for p, _ in best]), np.concatenate([c for _, c in best])
    chosen = places[points >= min(POINTS, width)]
    return chosen if len(chosen) else places[[int(np.argmax(points))]]


def feature_hashes(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """64-bit hashes of the windows at the places, each distinct one once, in text order."""
    h = np.zeros(len(places), dtype=np.uint64)
    for i in range(0, len(places), 65536):
        at = places[i : i + 65536]
        words = np.ascontiguousarray(data[at[:, None] + np.arange(WINDOW)[None, :]]).view("<u8")
        part = h[i : i + 65536]
        for j in range(WINDOW // 8):
            part = mix64(part ^ mix64(words[:, j] + np.uint64(j + 1)))
        h[i : i + 65536] = part
    _, first = np.unique(h, return_index=True)
    return h[np.sort(first)]


class Fingerprint:
    """Chained filters: rows of bits, the features in each, and a printable form."""

    def __init__(self, hashes: np.ndarray):
        n = -(-len(hashes) // CAPACITY)
        self.counts = np.full(n, CAPACITY)
        if n:
            self.counts[-1] = len(hashes) - CAPACITY * (n - 1)
        bits = np.zeros(n * BITS, dtype=np.uint8)
        row = np.arange(len(hashes)) // CAPACITY * BITS
        for i in range(HASHES):
            bits[row + ((hashes >> np.uint64(11 * i)) % np.uint64(BITS)).astype(np.int64)] = 1
        self.bits = bits.reshape(n, BITS)

    def text(self) -> str:
        parts = [f"{c}:{base64.b64encode(np.packbits(b).tobytes()).decode()}" for c, b in zip(self.counts.tolist(), self.bits)]
        return "|".join(parts)


def likeness(x: Fingerprint, y: Fingerprint) -> float:
    """0 to 1; symmetric. Two empty fingerprints are alike, an empty and another one are not."""
    if not len(x.bits) or not len(y.bits):
        return float(len(x.bits) == len(y.bits))
    if (len(x.bits), x.counts.sum()) > (len(y.bits), y.counts.sum()):
        x, y = y, x
    forward = _toward(x, y)
    if (len(x.bits), x.counts.sum()) == (len(y.bits), y.counts.sum()):
        forward = (forward + _toward(y, x)) / 2
    return round(forward, 9)


def _toward(x: Fingerprint, y: Fingerprint) -> float:
    ones_x, ones_y = x.bits.sum(axis=1).astype(float), y.bits.sum(axis=1).astype(float)
    total = 0.0
    wide = y.bits.astype(np.float32).T
    for i in range(0, len(x.bits), 512):
        rows = slice(i, i + 512)
        both = x.bits[rows].astype(np.float32) @ wide
        chance = ones_x[rows, None] * ones_y[None, :] / BITS
        most = np.minimum(ones_x[rows, None], ones_y[None, :])
        # The smaller of two filters can be inside the larger; what chance gives counts as nothing.
        found = np.clip((both - chance) / np.maximum(most - chance, 1e-9), 0, 1)
        # A small filter inside a large one is worth its share of the features only.
        share = np.minimum(x.counts[rows, None], y.counts[None, :]) / np.maximum(x.counts[rows, None], 1)
        total += float((np.where(most > chance, found, both == most) * share).max(axis=1) @ x.counts[rows])
    return min(1.0, total / float(x.counts.sum()))


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)


def fingerprints(texts: list[str], ranks: np.ndarray) -> list[Fingerprint]:
    """Fingerprints of the texts; short ones are slid over together, long ones by themselves."""
    data = [_bytes(t) for t in texts]
    out: list[Fingerprint | None] = [None] * len(data)
    i = 0
    while i < len(data):
        j, size = i, 0
        while j < len(data) and (j == i or size + len(data[j]) <= GROUP_BYTES):
            size += len(data[j])
            j += 1
        joined = np.concatenate(data[i:j]) if j > i + 1 else data[i]
        rank = ranks[classes_of(joined)] if len(joined) >= WINDOW else np.zeros(0, dtype=np.uint16)
        at = 0
        for k in range(i, j):
            own = data[k]
            if len(own) < WINDOW:
                short = np.zeros(WINDOW, dtype=np.uint8)
                short[: len(own)] = own
                hashes = mix64(feature_hashes(short, np.array([0])) + np.uint64(len(own))) if len(own) else np.zeros(0, dtype=np.uint64)
            else:
                hashes = feature_hashes(own, pick(rank[at : at + len(own) - WINDOW + 1]))
            out[k] = Fingerprint(hashes)
            at += len(own)
        i = j
    return out


def _class_counts(cols: dict[str, list]) -> pa.RecordBatch:
    counts = np.zeros(LEVELS, dtype=np.int64)
    data = [_bytes(t) for t in cols["text"] if t]
    group: list[np.ndarray] = []
    for i, own in enumerate(data):
        group.append(own)
        if sum(map(len, group)) >= GROUP_BYTES or i == len(data) - 1:
            classes, at = classes_of(np.concatenate(group)), 0
            for x in group:
                if len(x) >= WINDOW:
                    counts += np.bincount(classes[at : at + len(x) - WINDOW + 1], minlength=LEVELS)
                at += len(x)
            group = []
    some = np.flatnonzero(counts)
    return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some])], names=["class", "n"])


def class_counts(docs: DataFrame) -> np.ndarray:
    """Number of windows of each entropy class in all texts."""
    counted = arrow_rows(docs, ["text"], _class_counts, "class int, n long").groupBy("class").agg(F.sum("n").alias("n"))
    counts = np.zeros(LEVELS, dtype=np.int64)
    for row in counted.collect():  # one row per class
        counts[row["class"]] = row["n"]
    return counts


def ranked(counts: np.ndarray) -> np.ndarray:
    """Rank of each entropy class, the rarest first; of equally rare ones the one with the higher entropy."""
    ranks = np.empty(LEVELS, dtype=np.uint16)
    ranks[np.lexsort((-np.arange(LEVELS), counts))] = np.arange(LEVELS)
    return ranks


def rarity(docs: DataFrame) -> np.ndarray:
    """Rank of each entropy class by its number of windows in all texts."""
    return ranked(class_counts(docs))


def with_next(docs: DataFrame, n_windows: int | None = None) -> DataFrame:
    """(part, doc_id, text) sorted by ``doc_id`` over all partitions, nulls first; equal ids by the MD5 of the text.

    ``part`` grows with the order; a partition has about ``RANGE_CHARS`` characters where texts are of like length,
    for which the number of windows of all texts stands.
    """
    size = int(class_counts(docs).sum()) if n_windows is None else n_windows
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("_hash", F.md5("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("_hash")]
    ranged = rows.repartitionByRange(size // RANGE_CHARS + 1, *order).sortWithinPartitions(*order)
    return ranged.select(F.spark_partition_id().alias("part"), "doc_id", "text")


EDGES = "edge string, part int, text string"
SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edited(text: str, following: str) -> str:
    """The text with its second half replaced by as much of the following text as there is."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(rows: list[tuple], prints: list, ranks: np.ndarray) -> list[pa.Array]:
    """Result columns for all rows (doc_id, text) but the last, each with the one behind it."""
    use, texts = range(len(rows) - 1), [r[1] for r in rows]
    changed = [edited(texts[i], texts[i + 1]) for i in use]
    others = fingerprints(changed, ranks)
    return [
        pa.array([rows[i][0] for i in use], pa.int64()),
        pa.array([len(texts[i]) for i in use], pa.int64()),
        pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed], pa.string()),
        pa.array([prints[i].text() for i in use], pa.string()),
        pa.array([p.text() for p in others], pa.string()),
        pa.array([likeness(prints[i], p) for i, p in zip(use, others)], pa.float64()),
        pa.array([likeness(prints[i], prints[i + 1]) for i in use], pa.float64()),
    ]


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likenesses.

    Documents are sorted over all partitions with one shuffle; inside a partition each meets the next one as they come. The
    first and the last document of every partition are put out with their texts, and a second, small job brings
    the last of one together with the first of the next.
    """
    counts = class_counts(docs)
    shared = docs.sparkSession.sparkContext.broadcast(ranked(counts))

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, waiting, size, carried, part, seen = shared.value, [], 0, None, 0, False

        def edge(kind: str, row: tuple) -> pa.RecordBatch:
            empty = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())]
            told = [pa.array([row[0]], pa.int64()), *empty, pa.array([kind]), pa.array([part], pa.int32()), pa.array([row[1]])]
            return pa.RecordBatch.from_arrays(told, names=[*NAMES, "edge", "part", "text"])

        def flush() -> pa.RecordBatch:
            nonlocal carried
            texts = [r[1] for r in waiting]
            prints = ([carried] if carried else []) + fingerprints(texts[1:] if carried else texts, ranks)
            carried = prints[-1]
            columns = _compared(waiting, prints, ranks)
            rest = [pa.nulls(len(waiting) - 1, t) for t in (pa.string(), pa.int32(), pa.string())]
            return pa.RecordBatch.from_arrays([*columns, *rest], names=[*NAMES, "edge", "part", "text"])

        for batch in batches:
            for i in range(batch.num_rows):
                part, row = batch.column(0)[i].as_py(), (batch.column(1)[i].as_py(), batch.column(2)[i].as_py())
                if not seen:
                    yield edge("first", row)
                    seen = True
                waiting.append(row)
                size += len(row[1])
                if size > GROUP_BYTES or len(waiting) >= 2000:
                    yield flush()
                    waiting, size = waiting[-1:], 0
        if len(waiting) > 1:
            yield flush()
        if seen:
            yield edge("last", waiting[-1])

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                doc_id, text, following = (batch.column(c)[i].as_py() for c in range(3))
                rows = [(doc_id, text), (None, following)]
                yield pa.RecordBatch.from_arrays(_compared(rows, fingerprints([text, following], shared.value), shared.value), names=NAMES)

    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "fingerprints")
    # Half-empty Bloom filters in base 64 are a third smaller this way.
    written = with_next(docs, int(counts.sum())).mapInArrow(inside, f"{SCHEMA}, {EDGES}")
    written.write.option("compression", "zstd").parquet(path)
    found = spark.read.schema(written.schema).parquet(path)
    firsts, lasts = (found.where(F.col("edge") == k).select("part", "doc_id", "text") for k in ("first", "last"))
    # Numbers of partitions only; behind the last one comes the first again.
    numbers = firsts.select("part")
    top = numbers.agg(F.min("part").alias("top")).scalar()
    nexts = numbers.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), top).alias("_next"))
    heads = firsts.select(F.col("part").alias("_next"), F.col("text").alias("following"))
    met = lasts.join(nexts, "part").join(heads, "_next").select("doc_id", "text", "following").mapInArrow(across, SCHEMA)
    return found.where("edge is null").select(*NAMES).unionByName(met)


def op4_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(documents(spark, sf_dir))
