"""SentencePiece (BPE) encoding with seeded merge-dropout, and decoding.

A text becomes pieces by merging adjacent symbols, always the candidate with the best score and of
equal ones the leftmost. With ``dropout`` above 0 a candidate is skipped when a keyed hash of (seed,
document, use of the document, place of the word, word, place in the word, piece) falls below the
rate, so every occurrence of a word draws its own segmentation. The hash takes the piece that a merge would make and
the place where it begins, so a piece that is skipped there does not form from another split either. Without dropout the pieces are those
of the model. Every segmentation decodes to the text. Repeated rows of a document without a use column
are equal.

Pieces never cross the start of a word. Each distinct word of a task is merged once without dropout (again
when too many words are remembered); the occurrences whose hashes skip none of the merges made share that
result, since a skipped candidate that is not the best at any time changes nothing. All others are merged on
their own, in NumPy, one merge per word and turn.

A word boundary mark in the text itself is encoded by its bytes, as are characters without a piece.
Null texts count as empty and have no pieces; ids may be null or repeat; texts are taken whole.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import arrow_rows, documents, mix64

MARK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
# Occurrences, and symbols, that are looked at together, few enough for their arrays to stay in the cache, and
# the distinct words (of 16 characters) after which a task forgets the earlier ones; no result depends on them.
BLOCK = 20_000
CELLS = 100_000
WORDS = 300_000

# Whole words with the spaces before them, or spaces at the end.
_UNITS = re.compile(" *[^ ]+| +")


@dataclass(frozen=True)
class Vocabulary:
    """Pieces of a model as plain arrays; the size of the vocabulary bounds what is broadcast."""

    pieces: list[str]
    ids: dict[str, int]  # pieces that can come from merging
    char_ids: np.ndarray  # id of each character as a symbol, or -1, which the last entry and all later characters have
    byte_ids: list[int]
    table: list[bytes]  # what each id decodes to, with the mark as a space
    pair_keys: np.ndarray  # (left << 32 | right) in its slot of an open hash table, or -1
    pair_piece: np.ndarray  # beside its key; -1 in an empty slot
    rank: np.ndarray  # of a piece among all scores; the lowest is merged first


def load(model_file: str = MODEL) -> Vocabulary:
    """Read the model on the driver. Only models with identity normalisation and byte fallback fit."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    n = model.vocab_size()
    pieces = [model.id_to_piece(i) for i in range(n)]
    special = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    if not all(model.is_byte(i) for i in byte_ids):
        raise ValueError("the model has no byte fallback")
    if any(re.search(f"[^{MARK}]{MARK}", p) for p, s in zip(pieces, special) if not s):
        raise ValueError("the model has pieces that cross the start of a word")
    ids = {p: i for i, p in enumerate(pieces) if not special[i]}
    table = [b"" if s else p.replace(MARK, " ").encode() for p, s in zip(pieces, special)]
    for b, i in enumerate(byte_ids):
        table[i] = bytes([b])
    pairs = {}
    for piece, i in ids.items():
        for cut in range(1, len(piece)):
            left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
            if left is not None and right is not None:
                pairs[left << 32 | right] = i
    keys, found = _pair_table(np.array(list(pairs), dtype=np.int64), np.array(list(pairs.values()), dtype=np.int64))
    scores = np.array([model.get_score(i) for i in range(n)])
    rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
    # A space is the mark; a mark of the text's own has no piece.
    single = {ord(p): i for p, i in ids.items() if len(p) == 1 and p not in (MARK, " ")}
    char_ids = np.full(max([32, *single]) + 2, -1, dtype=np.int64)
    char_ids[list(single)] = list(single.values())
    char_ids[32] = ids.get(MARK, -1)
    return Vocabulary(pieces, ids, char_ids, byte_ids, table, keys, found, rank)


def _slot(key: np.ndarray, size: int) -> np.ndarray:
    """The first slot of a key in a table of ``size`` slots, a power of two: the upper bits of a product."""
    mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(65 - size.bit_length())).astype(np.intp)


def _pair_table(keys: np.ndarray, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An open hash table at most a quarter full: a key is in its slot or the next ones, before an empty one."""
    size = 1 << (4 * len(keys) + 1).bit_length()
    slots, found = np.full(size, -1, dtype=np.int64), np.full(size, -1, dtype=np.int64)
    for key, piece, at in zip(keys.tolist(), pieces.tolist(), _slot(keys, size).tolist()):
        while slots[at] >= 0:
            at = (at + 1) & (size - 1)
        slots[at], found[at] = key, piece
    return slots, found


def _candidates(vocab: Vocabulary, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The piece of each pair, or -1; negative ids (bytes) have no pieces."""
    key = (left << 32) | right
    size = len(vocab.pair_keys)
    at = _slot(key, size)
    held = vocab.pair_keys.take(at)
    piece = vocab.pair_piece.take(at)
    # Negative ids make negative keys, or match no key.
    piece[(left < 0) | (right < 0)] = -1
    other = np.flatnonzero((held != key) & (piece >= 0))
    piece[other], at = -1, at[other]
    while len(other):
        at = (at + 1) & (size - 1)
        wanted, held = key[other], vocab.pair_keys.take(at)
        hit = held == wanted
        piece[other[hit]] = vocab.pair_piece.take(at[hit])
        on = np.flatnonzero(~hit & (held >= 0))
        at, other = at[on], other[on]
    return piece


def _skipped(unit_key: np.ndarray, place: np.ndarray, piece: np.ndarray, dropout: float) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = mix64(unit_key ^ mix64((place.astype(np.uint64) << np.uint64(32)) | piece.astype(np.uint64)))
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53 < dropout


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from each ``first`` on, ``size`` of them, one range after the other."""
    return np.arange(int(size.sum())) + np.repeat(first - np.cumsum(size) + size, size)


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def segment(vocab: Vocabulary, units: list[str], unit_keys: np.ndarray, dropout: float, trace: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all units one after the other, and the offsets of the units.

    ``trace`` receives (unit, place, piece) of the merges made.
    ``unit_keys`` feeds the dropout of each unit. A symbol's place is that of its first character.
    """
    lengths = np.array([len(u) for u in units], dtype=np.int64)
    return segment_chars(vocab, _code_points("".join(units)), lengths, unit_keys, dropout, trace)


def segment_chars(
    vocab: Vocabulary, chars: np.ndarray, lengths: np.ndarray, unit_keys: np.ndarray, dropout: float, trace: list | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """``segment`` for units given as their code points one after the other, and their lengths."""
    first = np.cumsum(lengths) - lengths
    by_length = np.argsort(lengths, kind="stable")
    ordered = lengths[by_length]
    outs, counts = [np.zeros(0, dtype=np.int32)], np.zeros(len(lengths), dtype=np.int64)
    low = int(np.searchsorted(ordered, 0, "right"))
    while low < len(ordered):
        # Units of like length fill a table of at most so many cells, or one unit does.
        some = ordered[low : low + CELLS // int(ordered[low]) + 1]
        high = low + max(1, int(np.searchsorted(np.arange(1, len(some) + 1) * some, CELLS, "right")))
        units = by_length[low:high]
        out, counts[units] = _merge(vocab, chars, first[units], ordered[low:high], units, unit_keys[units], dropout, trace)
        outs.append(out)
        low = high
    bounds = np.concatenate([[0], np.cumsum(counts)])
    sizes = counts[by_length]
    ids = np.empty(int(bounds[-1]), dtype=np.int32)
    ids[_ranges(bounds[by_length], sizes)] = np.concatenate(outs)
    return ids, bounds


def _merge(
    vocab: Vocabulary, chars: np.ndarray, first: np.ndarray, lengths: np.ndarray, units: np.ndarray, keys: np.ndarray, dropout: float, trace: list | None
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the units one after the other, and how many each has. The last unit is the longest.

    A unit is a column of a table, a symbol is in the row of its first character. A row below stands for what lies
    before the first symbol and after the last one.
    """
    rows, width = int(lengths[-1]), len(lengths)
    spot = first + np.arange(rows)[:, None]
    inside = np.arange(rows)[:, None] < lengths
    symbol = np.full((rows + 1) * width, -1, dtype=np.int32)  # -1 too where nothing is, or a character without a piece
    real = np.flatnonzero(inside)
    symbol[real] = vocab.char_ids[np.minimum(chars[spot.ravel()[real]], len(vocab.char_ids) - 1)]
    end = rows * width
    follow = np.arange(width, end + 2 * width)
    follow[end:] -= width
    before = np.arange(-width, end)
    before[:width] += end + width
    # order: rank and row of the candidate that begins at a symbol; the piece is kept beside it.
    bits = rows.bit_length()
    kind = np.int32 if int(vocab.rank.max()) + 1 << bits < 1 << 31 else np.int64
    worst = np.iinfo(kind).max
    order = np.full((rows + 1) * width, worst, dtype=kind)
    candidate = np.empty((rows + 1) * width, dtype=np.int32)
    table = order[:end].reshape(rows, width)

    def consider(at: np.ndarray) -> None:
        left, right = symbol.take(at), symbol.take(follow.take(at))
        both = np.flatnonzero((left | right) >= 0)
        at = at.take(both)
        piece = _candidates(vocab, left.take(both).astype(np.int64), right.take(both).astype(np.int64))
        some = np.flatnonzero(piece >= 0)
        at, piece = at.take(some), piece.take(some)
        row = at // width
        if dropout > 0:
            stays = np.flatnonzero(~_skipped(keys.take(at - row * width), row, piece, dropout))
            at, piece, row = at.take(stays), piece.take(stays), row.take(stays)
        candidate[at] = piece
        order[at] = (vocab.rank.take(piece) << bits) | row

    consider(real)
    while True:
        least = table.min(axis=0)
        column = np.flatnonzero(least < worst)
        if not len(column):
            break
        row = (least.take(column) & ((1 << bits) - 1)).astype(np.int64)
        at = row * width + column
        piece = candidate.take(at)
        if trace is not None:
            trace.append((units.take(column), row, piece))
        gone = follow.take(at)
        after = follow.take(gone)
        prior = before.take(at)
        symbol[at] = piece
        symbol[gone] = -2
        follow[at] = after
        before[after] = at
        order[at] = order[gone] = order[prior] = worst
        # One merge in a unit and turn, so that no symbol is met twice here.
        consider(np.concatenate([at, prior]))
    cells = symbol[:end].reshape(rows, width)
    left = (inside & (cells != -2)).T
    out, counts = cells.T[left], left.sum(axis=1)
    plain = np.flatnonzero(out < 0)
    if len(plain):
        bare = chars[spot.T[left][plain]].tolist()
        raw = {c: [vocab.byte_ids[b] for b in chr(c).encode("utf-8", "surrogatepass")] for c in set(bare)}
        spread = np.ones(len(out), dtype=np.int64)
        spread[plain] = [len(raw[c]) for c in bare]
        of = np.repeat(np.arange(width), counts)
        out = np.repeat(out, spread)
        out[out < 0] = list(itertools.chain.from_iterable(map(raw.__getitem__, bare)))
        counts = np.bincount(of, weights=spread, minlength=width).astype(np.int64)
    return out, counts


def split_units(text: str | None) -> list[str]:
    """The units of a text, less the space in front of each; the model wants one in front of the text."""
    if not text:
        return []
    if "  " in text or text[0] == " " or text[-1] == " ":
        return [u[1:] for u in _UNITS.findall(" " + text)]
    return text.split(" ")


class Words:
    """Distinct units met so far, with what merging them without dropout gives."""

    def __init__(self, vocab: Vocabulary, seed: str):
        self.vocab, self.salt = vocab, xxhash.xxh3_64_intdigest(seed.encode())
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = defaultdict(itertools.count().__next__)  # without the space in front
        self.hashes = np.zeros(0, dtype=np.uint64)
        self.chars, self.lengths = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        self.pool, self.bounds = np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)
        # The merges made, with those of unit i from made[i] on.
        self.place, self.piece, self.made = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)

    def numbers(self, units: list[list[str]]) -> np.ndarray:
        """The number of each unit; those not met before are merged."""
        if len(self.index) > WORDS or len(self.chars) > 16 * WORDS:
            self.forget()
        known, count = len(self.index), sum(map(len, units))
        word = np.fromiter(map(self.index.__getitem__, itertools.chain.from_iterable(units)), dtype=np.int64, count=count)
        names = [" " + u for u in itertools.islice(self.index, known, None)]
        if names:
            self._learn(names)
        return word

    def _learn(self, names: list[str]) -> None:
        digest, salt = xxhash.xxh3_64_intdigest, self.salt
        hashes = np.array([digest(u.encode("utf-8", "surrogatepass"), seed=salt) for u in names], dtype=np.uint64)
        chars, lengths = _code_points("".join(names)), np.array(list(map(len, names)), dtype=np.int64)
        trace: list = [(np.zeros(0, dtype=np.int64),) * 3]
        pool, bounds = segment_chars(self.vocab, chars, lengths, hashes, 0.0, trace)
        unit, place, piece = (np.concatenate(x) for x in zip(*trace))
        order = np.argsort(unit, kind="stable")
        made = np.cumsum(np.bincount(unit, minlength=len(names)))
        self.hashes = np.concatenate([self.hashes, hashes])
        self.chars, self.lengths = np.concatenate([self.chars, chars]), np.concatenate([self.lengths, lengths])
        self.pool, self.bounds = np.concatenate([self.pool, pool]), np.concatenate([self.bounds, bounds[1:] + self.bounds[-1]])
        self.place = np.concatenate([self.place, place[order].astype(np.int32)])
        self.piece = np.concatenate([self.piece, piece[order].astype(np.int32)])
        self.made = np.concatenate([self.made, made + self.made[-1]])


def encode_texts(
    vocab: Vocabulary,
    texts: list[str | None],
    keys: list[int | None],
    seed: str = "pieces",
    dropout: float = DROPOUT,
    uses: list[int] | None = None,
    words: Words | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and the offsets of the texts. ``keys`` and ``uses`` vary the dropout.

    ``words`` (of the same vocabulary and seed) remembers the distinct words for the next texts.
    """
    words = Words(vocab, seed) if words is None else words
    units = [split_units(t) for t in texts]
    counts = np.array([len(u) for u in units], dtype=np.int64)
    word = words.numbers(units)
    del units
    pool, bounds, where = words.pool, words.bounds, word
    if dropout > 0 and len(word):
        named = [repr(k) if not u else f"{k!r}/{u}" for k, u in zip(keys, uses or [0] * len(keys))]
        own = np.array([xxhash.xxh3_64_intdigest(k.encode(), seed=words.salt) for k in named], dtype=np.uint64)
        spot = _ranges(np.zeros(len(counts), dtype=np.int64), counts)
        occurrence = mix64(words.hashes[word] ^ mix64(np.repeat(own, counts) ^ mix64(spot.astype(np.uint64))))
        # Blocks of bounded characters, as a unit has fewer merges than characters.
        block = np.maximum(np.cumsum(words.lengths[word]) // (8 * BLOCK), np.arange(len(word)) // BLOCK)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(word)]])
        skips = np.zeros(len(word), dtype=bool)
        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            first = words.made.take(word[low:high])
            size = words.made.take(word[low:high] + 1) - first
            at = _ranges(first, size)
            drop = _skipped(np.repeat(occurrence[low:high], size), words.place.take(at), words.piece.take(at), dropout)
            skips[low + np.repeat(np.arange(high - low), size)[drop]] = True
        touched = np.flatnonzero(skips)
        lengths = words.lengths[word[touched]]
        chars = words.chars[_ranges((np.cumsum(words.lengths) - words.lengths)[word[touched]], lengths)]
        some, some_bounds = segment_chars(vocab, chars, lengths, occurrence[touched], dropout)
        where = word.copy()
        where[touched] = len(bounds) - 1 + np.arange(len(touched))
        pool, bounds = np.concatenate([pool, some]), np.concatenate([bounds, some_bounds[1:] + bounds[-1]])
    first = bounds[where]
    sizes = bounds[where + 1] - first
    text_ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
    return pool[_ranges(first, sizes)], text_ends


def decode_ids(vocab: Vocabulary, ids: list[int]) -> str:
    """The text of a list of ids: pieces and bytes joined, without the space that encoding put in front."""
    raw = b"".join(map(vocab.table.__getitem__, ids))
    return raw[1:].decode("utf-8", "surrogatepass") if raw.startswith(b" ") else raw.decode("utf-8", "surrogatepass")


def decode_texts(vocab: Vocabulary, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The UTF-8 of many lists of ids, one after the other with the offsets ``ends``; as ``decode_ids`` gives it."""
    joined = pa.array(vocab.table, pa.binary()).take(pa.array(ids))
    _, offsets, data = joined.buffers()
    at = np.frombuffer(offsets, dtype=np.int32)[ends].tolist()
    raw = data.to_pybytes()
    return [raw[a:b].removeprefix(b" ") for a, b in zip(at[:-1], at[1:])]


def encode(docs: DataFrame, model_file: str = MODEL, seed: str = "pieces", dropout: float = DROPOUT) -> DataFrame:
    """(doc_id, ids) for every row of ``docs``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(load(model_file))
    kept: dict[str, Words] = {}

    def step(cols: dict[str, list]) -> pa.RecordBatch:
        words = kept.get(seed) or kept.setdefault(seed, Words(shared.value, seed))
        ids, ends = encode_texts(shared.value, cols["text"], cols["doc_id"], seed, dropout, words=words)
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
        return pa.RecordBatch.from_arrays([pa.array(cols["doc_id"], pa.int64()), lists], names=["doc_id", "ids"])

    return arrow_rows(docs, ["doc_id", "text"], step, "doc_id long, ids array<int>", done=kept.clear)


def decode(encoded: DataFrame, model_file: str = MODEL) -> DataFrame:
    """(doc_id, text) of rows with doc_id and ids. Null ids decode to the empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(load(model_file))

    def run(batches):
        for batch in batches:
            texts = [decode_ids(shared.value, x.as_py() or []) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def encode_and_check(docs: DataFrame, model_file: str = MODEL, seed: str = "pieces", dropout: float = DROPOUT, use: str | None = None) -> DataFrame:
    """doc_id, ids, n_pieces, decoded_sha256 (of the text decoded from ids) and lossless, for every row.

    ``use`` names a column that numbers the uses of a document; each use draws its own dropout.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(model_file))
    kept: dict[str, Words] = {}

    def step(cols: dict[str, list]) -> pa.RecordBatch:
        vocab = shared.value
        words = kept.get(seed) or kept.setdefault(seed, Words(vocab, seed))
        ids, ends = encode_texts(vocab, cols["text"], cols["doc_id"], seed, dropout, cols[use] if use else None, words)
        back = decode_texts(vocab, ids, ends)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(cols["doc_id"], pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())),
                pa.array(np.diff(ends), pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in back]),
                pa.array([t == (x or "").encode("utf-8", "surrogatepass") for t, x in zip(back, cols["text"])]),
            ],
            names=["doc_id", "ids", "n_pieces", "decoded_sha256", "lossless"],
        )

    schema = "doc_id long, ids array<int>, n_pieces long, decoded_sha256 string, lossless boolean"
    return arrow_rows(docs, ["doc_id", "text", *([use] if use else [])], step, schema, done=kept.clear)


def op10_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_check(documents(spark, sf_dir))
