"""Spelling variants: words one edit apart, found with bit-sliced position indexes.

The vocabulary is counted with the DataFrame API. Two words one edit apart agree before and after one of
three pieces of the shorter word, so each word is dealt to the pieces it may differ in, and only words with
the same key can be near. Keys that very many words share are dealt again by single letters: what is left then
differs in one or two letters, so a group is bounded by the alphabet and no pair of words is ever listed to
be compared. Whole groups are packed into blocks, and a block is searched at once: for every (position, letter)
a bitset tells which words of the block have that letter there, and the recurrences over a query's letters
carry four sets of words side by side: no error so far, one letter replaced, one more, one less.

A word's form is its near word of largest count, where that is at least ``RATIO`` times the word's own. Counts
grow by that ratio with each step, so following forms ends after at most ``log(2^63) / log(RATIO)`` steps;
paths are halved in each turn.

Defined results: null and empty texts have no words; a null ``doc_id`` counts as the empty text in the key of a
deletion. Repeated rows count as often as they occur. Empty tables give empty results, further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import documents, stage

LETTERS = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LETTERS = 7
MIN_COUNT = 2
RATIO = 10
DELETE_EVERY = 31

PIECES = 3
MAX_GROUP = 2048  # words that may share a key before they are dealt again by single letters
BLOCK_WORDS = 512  # words of a block, more only where one key has more
QUERY_WORDS = 1024  # words of a block that are looked up at a time
TURNS = 6  # of path halving: enough for 64 steps, more than a count can grow by RATIO


# --- Vocabulary


def observed_words(docs: DataFrame, min_letters: int = MIN_LETTERS, delete_every: int = DELETE_EVERY) -> DataFrame:
    """``(word)`` for every run of at least ``min_letters`` letters, some with one letter deleted.

    Shorter runs cannot give a word of that length. Which letter goes depends on document and run only.
    """
    run = F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(f"({LETTERS}{{{min_letters},}})"), F.lit(1)))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    runs = docs.select(name.alias("_name"), run.alias("_run"))
    key = F.crc32(F.concat("_name", F.lit(":"), "_run").cast("binary"))
    hashed = runs.select("_run", key.alias("_h"))
    place = F.pmod("_h", F.char_length("_run")).cast("int")
    shorter = F.concat(F.substring("_run", F.lit(1), place), F.substring("_run", place + 2, F.char_length("_run")))
    return hashed.select(F.when(F.col("_h") % delete_every == 0, shorter).otherwise(F.col("_run")).alias("word"))


def vocabulary(words: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)`` of the words that are long and frequent enough; counted before the shuffle."""
    counts = words.filter(F.char_length("word") >= min_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= min_count)


# --- Keys: what two words one edit apart have in common


def _key(short: Column, start: Column, stop: Column) -> Column:
    """The word without its piece from ``start`` to ``stop`` of the shorter length ``short``."""
    length = F.char_length("word")
    after = stop + (length - short)
    return F.xxhash64(short, start, F.substring("word", F.lit(1), start), F.substring("word", after + 1, length))


def dealt(vocab: DataFrame, min_letters: int = MIN_LETTERS) -> DataFrame:
    """``(key, word, n, short, start, stop)``: every word under the pieces it may differ in.

    A word takes part as the shorter one (or one of equal length) and as the longer one of a pair.
    """
    length = F.char_length("word")
    cuts = [(short, j) for short in (length, length - 1) for j in range(PIECES)]
    pieces = [
        F.struct(
            short.alias("short"),
            F.floor(short * j / PIECES).cast("int").alias("start"),
            F.floor(short * (j + 1) / PIECES).cast("int").alias("stop"),
        )
        for short, j in cuts
    ]
    rows = vocab.select("word", "n", F.explode(F.array(*pieces)).alias("p")).select("word", "n", "p.*")
    # No word of the vocabulary is shorter than this.
    return rows.filter(F.col("short") >= min_letters).withColumn("key", _key(F.col("short"), F.col("start"), F.col("stop")))


def candidate_groups(vocab: DataFrame, min_letters: int = MIN_LETTERS, max_group: int = MAX_GROUP) -> DataFrame:
    """``(key, word, n)`` with the words of crowded keys under one key for each single letter instead."""
    rows = dealt(vocab, min_letters)
    # Written, so that Spark knows the size: nearly always empty, else joined by shuffle if it is large.
    crowded = stage(
        rows.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_group).select("key"), "crowded-keys"
    )
    letters = rows.join(crowded, "key", "left_semi").select(
        "word", "n", "short", F.explode(F.sequence("start", F.col("stop") - 1)).alias("start")
    )
    fine = letters.withColumn("key", _key(F.col("short"), F.col("start"), F.col("start") + 1))
    columns = ["key", "word", "n"]
    return rows.join(crowded, "key", "left_anti").select(*columns).unionByName(fine.select(*columns))


# --- The bit-sliced index of one block


class PositionIndex:
    """Bitsets over a block of words: which have a given letter at a given position, which have a given length."""

    def __init__(self, words: list[str]):
        self.size = len(words)
        self.lengths = np.fromiter(map(len, words), dtype=np.int64, count=self.size)
        self.longest = int(self.lengths.max())
        flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        letters, ids = np.unique(flat, return_inverse=True)
        # Letter 0 stands for the place behind a word's end, which no query asks for.
        self.codes = np.zeros((self.size, self.longest + 1), dtype=np.int64)
        self.codes[np.arange(self.longest + 1) < self.lengths[:, None]] = ids + 1
        padded = -(-self.size // 64) * 64
        has = np.zeros((self.longest + 1, len(letters) + 1, padded), dtype=bool)
        has[np.arange(self.longest + 1)[None, :], self.codes, np.arange(self.size)[:, None]] = True
        self.at = np.packbits(has, axis=-1, bitorder="little").view(np.uint64)
        ends = np.zeros((self.longest + 2, padded), dtype=bool)
        ends[self.lengths, np.arange(self.size)] = True
        self.of_length = np.packbits(ends, axis=-1, bitorder="little").view(np.uint64)

    def near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs ``(query, word)`` of numbers of words of the block that are exactly one edit apart."""
        queries = queries[np.argsort(self.lengths[queries], kind="stable")]
        lengths = self.lengths[queries]
        width = self.at.shape[-1]
        found = np.zeros((len(queries), width), dtype=np.uint64)
        exact = np.broadcast_to(~np.uint64(0), (len(queries), width))
        replaced = np.zeros((len(queries), width), dtype=np.uint64)
        longer, shorter = exact, replaced  # one letter more: skipped at once; one letter less: not yet
        first = 0
        for i in range(int(lengths[-1])):
            letter = self.codes[queries[first:], i]
            here, ahead = self.at[i][letter], self.at[i + 1][letter]
            behind = self.at[i - 1][letter] if i else np.uint64(0)
            shorter = (shorter & behind) | exact
            replaced = (replaced & here) | (exact & ~here)
            exact = exact & here
            longer = (longer & ahead) | exact
            done = int(np.searchsorted(lengths, i + 1, side="right")) - first
            if done:
                n = i + 1
                found[first : first + done] = (
                    (replaced[:done] & self.of_length[n])
                    | (longer[:done] & self.of_length[n + 1])
                    | (shorter[:done] & self.of_length[n - 1])
                )
                exact, replaced, longer, shorter = exact[done:], replaced[done:], longer[done:], shorter[done:]
                first += done
        bits = np.unpackbits(found.view(np.uint8), axis=-1, bitorder="little")
        who, what = np.nonzero(bits)
        return queries[who], what


def near_in_block(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of numbers of words of a block one edit apart, both ways round."""
    index = PositionIndex(words)
    parts = [index.near(np.arange(at, min(at + QUERY_WORDS, len(words)))) for at in range(0, len(words), QUERY_WORDS)]
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _blocks(keys: np.ndarray) -> tuple[list[tuple[int, int]], int]:
    """Where blocks of whole groups start and stop among sorted keys, and where the last, unfinished group starts."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    blocks, begin = [], 0
    for start, stop in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if stop - begin > BLOCK_WORDS and start > begin:
            blocks.append((begin, start))
            begin = start
        if stop - begin >= BLOCK_WORDS:
            blocks.append((begin, stop))
            begin = stop
    last = int(starts[-1])
    if last > begin:
        blocks.append((begin, last))
    return blocks, last


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of the groups of a partition that is sorted by key; an unfinished group waits for the next batch."""
    rest: pa.Table | None = None

    def pairs(part: pa.Table) -> pa.RecordBatch | None:
        keys = part.column("key").to_numpy()
        same = keys[1:] == keys[:-1]
        grouped = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        part = part.filter(pa.array(grouped))
        if not part.num_rows:
            return None
        one = pa.Table.from_arrays([part.column("word"), part.column("n")], ["word", "n"]).group_by("word").aggregate([("n", "max")])
        names = one.column("word").combine_chunks()
        who, what = near_in_block(names.to_pylist())
        counts = one.column("n_max").combine_chunks()
        return pa.RecordBatch.from_arrays(
            [names.take(pa.array(who)), names.take(pa.array(what)), counts.take(pa.array(what))], ["word", "near", "near_n"]
        )

    for batch in batches:
        new = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, new]) if rest is not None else new
        if not table.num_rows:
            continue
        blocks, last = _blocks(table.column("key").to_numpy())
        for start, stop in blocks:
            result = pairs(table.slice(start, stop - start))
            if result is not None:
                yield result
        rest = table.slice(last).combine_chunks()
    if rest is not None:
        result = pairs(rest)
        if result is not None:
            yield result


def near_words(vocab: DataFrame, min_letters: int = MIN_LETTERS, max_group: int = MAX_GROUP) -> DataFrame:
    """``(word, near, near_n)``: every ordered pair of words one edit apart, once."""
    groups = candidate_groups(vocab, min_letters, max_group)
    found = groups.repartition("key").sortWithinPartitions("key").mapInArrow(_search, "word string, near string, near_n long")
    return found.dropDuplicates(["word", "near"])


# --- Forms and roots


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for the words of ``(word, form)``: each turn doubles the steps a path has taken."""
    paths = stage(forms.select("word", F.col("form").alias("root")), "paths")
    for _ in range(TURNS):
        further = paths.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        moved = paths.join(further, F.col("root") == F.col("_at"), "left")
        paths = stage(
            moved.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "paths"
        )
        if not paths.filter("_moved").head(1):
            break
    return paths.select("word", "root")


def variant_groups(vocab: DataFrame, ratio: int = RATIO, min_letters: int = MIN_LETTERS, max_group: int = MAX_GROUP) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` for every word of ``(word, n)``; words are distinct.

    Words with the same root are spellings of one word. ``vocab`` is read several times: hand in a written table.
    """
    near = near_words(vocab, min_letters, max_group)
    best = near.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("_best")
    )
    enough = -F.col("_best.less") >= F.col("n") * ratio
    judged = stage(
        vocab.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(enough, F.col("_best.near")).alias("form"),
            F.when(enough, -F.col("_best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(judged.filter("form is not null"))
    return judged.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op12_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = stage(vocabulary(observed_words(documents(spark, sf_dir))), "vocabulary")
    return variant_groups(vocab).select("word", "form", "root", "n", "n_near", "form_n")


# The CRC table and its steps follow the definition of CRC-32; words are near if one without some letter is the
# other, or if both without the letter at the same place are equal.
OP12_SQL = """
with recursive shifted(i, step, c) as (
  select i, 0, i from range(256) r(i)
  union all
  select i, step + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from shifted where step < 8),
crc_table as (select list(c order by i) as tab from shifted where step = 8),
runs as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[a-zÀ-ÿ]{7,}')) as run
  from documents),
counted as (
  select run, count(*) as n, hex(encode(coalesce(cast(doc_id as varchar), '') || ':' || run)) as hx from runs group by doc_id, run),
hashed as (
  select run, n,
    xor(list_reduce(list_prepend(4294967295, list_transform(range(length(hx) // 2), lambda i: ('0x' || hx[2 * i + 1 : 2 * i + 2])::bigint)),
                    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) as h
  from counted, crc_table),
words as (
  select case when h % 31 = 0 then run[1 : h % length(run)] || run[h % length(run) + 2 :] else run end as word, n from hashed),
vocab as (select word, sum(n)::bigint as n from words where length(word) >= 7 group by word having sum(n) >= 2),
cut as (
  select word, n, i, word[1 : i] || word[i + 2 :] as rest from (select word, n, unnest(range(length(word))) as i from vocab)),
near as (
  select a.word, b.word as near, b.n as near_n from cut a join vocab b on a.rest = b.word
  union
  select a.word, b.word, b.n from vocab a join cut b on b.rest = a.word
  union
  select a.word, b.word, b.n from cut a join cut b on a.i = b.i and a.rest = b.rest and a.word <> b.word),
best as (
  select word, count(*) as n_near, arg_min(near, (-near_n, near)) as near, max(near_n) as near_n from near group by word),
forms as (
  select v.word, v.n, coalesce(n_near, 0) as n_near, case when near_n >= 10 * v.n then near end as form,
         case when near_n >= 10 * v.n then near_n end as form_n
  from vocab v left join best using (word)),
chain(word, last, steps) as (
  select word, form, 1 from forms where form is not null
  union all
  select c.word, f.form, steps + 1 from chain c join forms f on f.word = c.last where f.form is not null)
select word, form, coalesce(root, word) as root, n, n_near, form_n
from forms left join (select word, arg_max(last, steps) as root from chain group by word) using (word)
"""
