import hashlib
import random
from collections import defaultdict

import pytest

from millrace.llm import exact


def slow(rows, largest):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = (max if largest else min)(known) if known else None
        out += [(i, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def got(df):
    rows = df.collect()
    kept = defaultdict(int)
    for r in rows:
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert all(n == 1 for n in kept.values())
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=str)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_odd_rows(odd, keep):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(exact.exact_owners(odd, keep)) == slow(rows, keep == "largest")


def test_empty_table(none):
    assert exact.exact_owners(none).count() == 0
    assert exact.drop_copies(none).columns == none.columns


def test_tries():
    rng, tries, at = random.Random(1), exact.Tries(), {}
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.choice([0, 1, 5, 9]))) for _ in range(3000)]
    for t in texts:
        entry, new = tries.place(t)
        assert new == (t not in at) and at.setdefault(t, entry) == entry
    assert sum(tries.weights.values()) == tries.bytes
    found = {t: e for key in list(tries.roots) for e, t in tries.take(key)}
    assert found == at and tries.bytes == 0


@pytest.mark.parametrize("sizes", [(200, 50, 60), (1 << 20, 100_000, 40), (1 << 20, 7, 1 << 20)])
def test_flushes_spills_and_hot_texts(spark, monkeypatch, sizes):
    """Small tries flush and spill in several rounds, and a hot text is salted: the rows stay right."""
    monkeypatch.setattr(exact, "HOT_ROWS", 3)
    rng = random.Random(2)
    rows = [(i, "hot") for i in range(0, 900, 3)] + [(i, f"{rng.randrange(40)} text {'x' * rng.randrange(3)}") for i in range(1, 900, 3)] + [(i, f"own {i}") for i in range(2, 900, 3)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    local_bytes, local_rows, trie_bytes = sizes
    assert got(exact.exact_owners(df, "largest", local_bytes=local_bytes, local_rows=local_rows, trie_bytes=trie_bytes)) == slow(rows, True)


def test_equal_after_normalising(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "A  b"), (2, "a b"), (3, "c")], "doc_id long, text string")
    rows = exact.exact_owners(df, normal=lambda t: F.lower(F.regexp_replace(t, " +", " "))).collect()
    assert {r.doc_id: r.keep_id for r in rows} == {1: 1, 2: 1, 3: 3}


def test_whole_rows_stay(odd):
    rows = exact.drop_copies(odd, "largest").collect()
    assert sorted(str((r.doc_id, r.text)) for r in rows) == sorted({str((i, t)) for i, t in {(r.doc_id, r.text) for r in odd.collect()} if i not in (1, 6) })
