"""Exact duplicates against brute force on odd tables."""

import collections
import hashlib

import pytest

from fleetlake.llm import exact_dup

LONG = "x" * 300_000
START = "same start " * 40
ROWS = [
    (1, None), (2, ""), (3, ""), (4, "a"), (5, "b"), (6, "a"), (6, "a"), (7, LONG + "1"), (8, LONG + "2"), (9, LONG + "1"),
    (None, "a"), (None, "alone"), (None, "no id"), (None, "no id"), (10, START + "one"), (11, START + "two"), (12, START + "one"), (13, "é"), (14, "é"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Extra columns have the names of the operator's own helper columns."""
    rows = [(i, t, k, "s", k, "w") for k, (i, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, "doc_id long, text string, _size int, _sha string, _row int, words string").repartition(3)


def brute(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = collections.Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        ordered = sorted(ids, key=lambda i: -1 if i is None else i, reverse=True)
        for n, i in enumerate(ordered):
            out[(i, keep, len(ids), n == 0, hashlib.sha256(text.encode()).hexdigest())] += 1
    return out


def test_groups_equal_brute_force(odd):
    got = exact_dup.exact_groups(odd, every_hash=True).collect()
    assert collections.Counter(tuple(r) for r in got) == brute(ROWS)


def test_only_suspects_are_hashed(odd):
    got = {r["doc_id"]: r for r in exact_dup.exact_groups(odd).collect() if r["doc_id"]}
    # Unique by length, unique by beginning, told apart by the whole text only, and a copy.
    assert got[10]["text_sha256"] and got[11]["text_sha256"] and got[7]["text_sha256"]
    assert got[13]["text_sha256"] is None and got[14]["text_sha256"] is None


def test_a_full_filter_changes_nothing(odd, monkeypatch):
    monkeypatch.setattr(exact_dup, "FILTER_BITS", 64)
    got = exact_dup.exact_groups(odd, every_hash=True).collect()
    assert collections.Counter(tuple(r) for r in got) == brute(ROWS)


def test_hot_groups_give_the_same(odd, monkeypatch):
    monkeypatch.setattr(exact_dup, "HOT_GROUPS", 6)
    got = exact_dup.exact_groups(odd, every_hash=True).collect()
    assert collections.Counter(tuple(r) for r in got) == brute(ROWS)


def test_one_row_of_each_text_stays_with_its_columns(odd):
    out = exact_dup.keep_exact(odd)
    assert out.columns == odd.columns
    rows = out.collect()
    texts = [r["text"] or "" for r in rows]
    assert len(texts) == len(set(texts)) and set(texts) == {t or "" for _, t in ROWS}
    kept = {r["text"] or "": r["doc_id"] for r in rows}
    assert kept["a"] == 6 and kept[""] == 3 and kept["no id"] is None and kept[START + "one"] == 12


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dup.exact_groups(empty).collect() == [] and exact_dup.keep_exact(empty).collect() == []
