import random
from collections import Counter

from ledgerloom.llm.packing import pack_documents, pack_items

from .messy import ROWS, documents


def naive(items, capacity, per_source):
    """Best fit by looking at every bin."""
    bins = []
    for i in sorted(
        (i for i, item in enumerate(items) if item[1] % capacity), key=lambda i: -(items[i][1] % capacity)
    ):
        _, words, source, cluster = items[i]
        size = words % capacity
        fits = [
            b for b in bins
            if b["left"] >= size
            and (source is None or b["sources"][source] < per_source)
            and (cluster is None or cluster not in b["clusters"])
        ]
        if fits:
            best = min(fits, key=lambda b: (b["left"], b["number"]))
        else:
            best = {"left": capacity, "sources": Counter(), "clusters": set(), "number": len(bins), "items": []}
            bins.append(best)
        best["left"] -= size
        best["sources"][source] += 1
        best["clusters"].add(cluster)
        best["items"].append(i)
    return sorted(sorted(b["items"]) for b in bins)


def test_tightest_compatible_bin():
    rnd = random.Random(2)
    for trial in range(40):
        capacity = rnd.choice([10, 50, 200])
        items = [
            (i, rnd.randrange(capacity * 2), rnd.choice(["a", "a", "b", "c", None]), rnd.choice([None, "x", "y", i]))
            for i in range(120)
        ]
        limit = rnd.choice([1, 2, 4])
        bins = {}
        for i, _, _, words, number, _ in pack_items(items, capacity, limit):
            if number is not None and words < capacity:
                bins.setdefault(number, []).append(i)
        assert sorted(sorted(b) for b in bins.values()) == naive(items, capacity, limit)


def test_documents(spark):
    rows = ROWS + [(100 + i, "word " * (i % 37 + 1) + str(i % 9), "en", "ab"[i % 2]) for i in range(300)]
    df = documents(spark, rows)
    out = pack_documents(df, capacity=64, shard_rows=100).collect()
    size = Counter()
    for row in out:
        size[row.bin_id] += row.n_words
    assert max(n for b, n in size.items() if b is not None) <= 64
    want = Counter()
    for doc_id, text, *_ in rows:
        want[doc_id] += len((text or "").encode().split())
    got = Counter()
    for row in out:
        got[row.doc_id] += row.n_words
    assert got == want
    empty = [row for row in out if row.bin_id is None]
    assert sorted(r.doc_id for r in empty) == [2, 3, 4] and all(r.n_words == 0 for r in empty)
    source = {doc_id: s for doc_id, _, _, s in rows if doc_id}
    held = Counter((r.bin_id, source[r.doc_id]) for r in out if r.doc_id and r.bin_id is not None)
    assert max(n for (_, s), n in held.items() if s) <= 4
    long = sorted((r.piece, r.first_word, r.n_words) for r in out if r.doc_id == 7)
    assert long[0] == (0, 0, 64) and sum(n for *_, n in long) == 60_001


def test_duplicates_part(spark):
    rows = [(i, "Same words\nhere" if i % 2 else "same  WORDS here", "en", "a") for i in range(6)]
    out = pack_documents(documents(spark, rows)).collect()
    assert len({r.bin_id for r in out}) == 6
    apart = pack_documents(documents(spark, rows), cluster_col="source").collect()
    assert len({r.bin_id for r in apart}) == 6
    assert pack_documents(documents(spark, [])).count() == 0
