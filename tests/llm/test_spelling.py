"""Spelling variants against brute force over all pairs of words."""

import collections
import random
import re
import zlib

import numpy as np
import pytest

from fleetlake.llm import spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_words(rows):
    counts = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def brute_groups(vocab):
    near = {w: [v for v in vocab if one_edit(w, v)] for w in vocab}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-vocab[v], v), default=None)
        form[w] = best if best and vocab[best] >= 10 * vocab[w] else None
    out = {}
    for w in vocab:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (vocab[w], len(near[w]), form[w], vocab[form[w]] if form[w] else None, root)
    return out


def as_dict(df):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()}


def variants(count, letters, seed):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(7, 11))) for _ in range(count)}
    for word in list(words):
        for _ in range(3):
            i = rng.randrange(len(word) + 1)
            kind = rng.randrange(3)
            words.add(word[:i] + (rng.choice(letters) if kind else "") + word[i + (kind != 1) :])
    return {w: rng.choice((2, 3, 20, 30, 200, 2500)) for w in sorted(words) if len(w) >= 7}


@pytest.mark.parametrize("letters,seed", [("abc", 1), ("abcdefghijé÷À", 2), ("ab", 3)])
def test_index_finds_every_pair_once(letters, seed):
    words = list(variants(150, letters, seed))
    who, what = spelling.near_in_block(words)
    got = [(words[a], words[b]) for a, b in zip(who, what)]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a in words for b in words if one_edit(a, b)}


@pytest.mark.parametrize("max_group,block", [(spelling.MAX_GROUP, spelling.BLOCK_WORDS), (4, 8)])
def test_groups_equal_brute_force(spark, monkeypatch, max_group, block):
    monkeypatch.setattr(spelling, "BLOCK_WORDS", block)
    vocab = variants(120, "abcdeé", 5)
    df = spark.createDataFrame(list(vocab.items()), "word string, n long").repartition(3)
    assert as_dict(spelling.variant_groups(df, max_group=max_group)) == brute_groups(vocab)


def test_blocks_hold_whole_groups():
    keys = np.repeat(np.arange(300), np.random.default_rng(1).integers(1, 1500, 300))
    blocks, last = spelling._blocks(keys)
    assert [b for _, b in blocks[:-1]] == [a for a, _ in blocks[1:]] and blocks[0][0] == 0 and blocks[-1][1] == last
    assert all(keys[a - 1] != keys[a] for a, _ in blocks[1:]) and keys[last - 1] != keys[last]
    assert all(b - a <= spelling.BLOCK_WORDS or len(set(keys[a:b])) == 1 for a, b in blocks)


def test_words_of_odd_texts(spark):
    rng = random.Random(7)
    base = ["morning", "evening", "Straßenbahn", "ÉTUDIANT", "x×y÷zabc", "shorty", "international"]
    rows = [(i, " ".join(rng.choice(base) for _ in range(60))) for i in range(150)]
    rows += [(None, "morning EVENING morning"), (7, None), (8, ""), (9, "morning\nmorning1morning"), (9, "morning\nmorning1morning")]
    rows.append((10, " ".join(["international"] * 50_000)))
    docs = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(4)
    vocab = spelling.vocabulary(spelling.observed_words(docs))
    want = brute_words(rows)
    assert {r["word"]: r["n"] for r in vocab.collect()} == want
    assert as_dict(spelling.variant_groups(vocab)) == brute_groups(want)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variant_groups(spelling.vocabulary(spelling.observed_words(empty))).collect() == []
