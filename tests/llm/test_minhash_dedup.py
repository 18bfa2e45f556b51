import random

import pytest

from spanloom.llm import minhash_dedup as M


def by_hand(rows, share=75):
    sets = {}
    for d, t in rows:
        sets[d] = M.shingle_set(t or "")
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, x in enumerate(ids):
        for y in ids[:i]:
            both = len(sets[x] & sets[y])
            if both and 100 * both >= share * (len(sets[x]) + len(sets[y]) - both):
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def corpus():
    r = random.Random(2)
    words = [f"w{i}" for i in range(500)]
    rows = []
    for _ in range(25):
        base = [r.choice(words) for _ in range(r.choice([3, 6, 30, 80, 200]))]
        for _ in range(r.choice([1, 2, 12, 40])):
            x = list(base)
            for _ in range(r.randrange(0, 1 + len(x) // 25)):
                x[r.randrange(len(x))] = r.choice(words)
            rows.append((len(rows), " ".join(x)))
    passage = " ".join(r.choice(words) for _ in range(60))
    rows += [(1000 + i, f"{passage} " + " ".join(r.choice(words) for _ in range(30))) for i in range(60)]
    return rows + [(2000, ""), (2001, "  "), (2002, "A b"), (2003, "a\tB"), (2004, "a b c d e"), (2005, "A B C D E"), (2006, "É b"), (2007, "é b")]


@pytest.mark.parametrize("options", [{}, {"tile": 5}, {"held": 300}])
def test_components_are_those_of_all_pairs(spark, options):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in M.near_duplicates(df, M.Settings(**options)).collect()}
    assert got == by_hand(rows)


def test_edge_rows(spark):
    df = spark.createDataFrame([(None, "a", 1), (1, None, 1), (2, "x y", 1), (2, "x y", 1), (3, "X Y", 1), (4, "word " * 50_000, 1)], "doc_id long, text string, rep int")
    got = sorted(tuple(r) for r in M.near_duplicates(df).collect())
    assert got == [(1, 0, 1, True), (2, 1, 2, True), (3, 1, 2, False), (4, 1, 4, True)]
    assert M.near_duplicates(df.limit(0)).count() == 0


def hot(n, r):
    """``n`` documents that share a passage and little else, and among them some pairs of near copies."""
    words = [f"w{i}" for i in range(20_000)]
    passage = [r.choice(words) for _ in range(100)]
    rows = []
    for k in range(n):
        own = [r.choice(words) for _ in range(140)]
        rows.append((len(rows), " ".join(own[:70] + passage + own[70:])))
        if k % 10 == 0:
            own[r.randrange(140)] = "changed"
            rows.append((len(rows), " ".join(own[:70] + passage + own[70:])))
    return rows


def test_links_in_buckets_of_many_unlike_sets(spark):
    rows = hot(150, random.Random(4))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in M.near_duplicates(df).collect()}
    assert got == by_hand(rows)
    assert sum(not kept for _, _, kept in got.values()) == 15


def test_documents_that_share_a_passage_are_not_compared_with_each_other(spark, monkeypatch):
    """The rows of the tiles grow with the input, not with the square of the documents that share a passage."""
    counts, tiles = [], M._tiles
    monkeypatch.setattr(M, "_tiles", lambda *a: counts.append(tiles(*a).count()) or tiles(*a))
    for n in (200, 400):
        rows = hot(n, random.Random(4))
        M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert counts[1] <= 2.2 * counts[0] + 20


def test_word_sequences_have_one_digest():
    digest = lambda *texts: M._hashed([t.encode() for t in texts], 5)[2]
    one, two, three, four, five = digest("A b\n c", " a  B c ", "ab c", "", "a b c")
    assert one == two == five and len({one, three, four}) == 3
    assert digest("a b c") == [one] and digest("  ") == [four]


def join_rows(spark, since):
    """The most rows that a join made in the executions after ``since``, and the last of these executions."""
    store = spark._jsparkSession.sharedState().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    all_of = lambda seq: [seq.apply(i) for i in range(seq.size())]
    most, last = 0, since
    for run in all_of(store.executionsList()):
        if run.executionId() > since:
            last, values = max(last, run.executionId()), store.executionMetrics(run.executionId())
            for node in all_of(store.planGraph(run.executionId()).allNodes()):
                for m in all_of(node.metrics()) if "Join" in node.name() else []:
                    if m.name() == "number of output rows" and values.contains(m.accumulatorId()):
                        most = max(most, int(values.apply(m.accumulatorId()).replace(",", "")))
    return most, last


def test_sets_of_many_sizes_are_not_sent_to_classes_that_no_other_set_is_of(spark):
    """Overlapping stretches of one row of shingles: no join makes more rows than there are shingles, and no link is lost."""
    r = random.Random(6)
    stretch = [(k, start := 60 * k + r.randrange(50), start + r.randrange(200, 400)) for k in range(200)]
    stretch += [(1000 + k, a + 5, b) for k, a, b in stretch[::20]]
    # The order of shingles as numbers has nothing to do with their places.
    order = r.sample(range(1 << 40), max(b for _, _, b in stretch))
    sets = spark.createDataFrame([(k, k) for k, _, _ in stretch], "rep long, component long")
    hashes = spark.createDataFrame([(k, sorted(order[a:b])) for k, a, b in stretch], "rep long, hashes array<long>")
    since = join_rows(spark, -1)[1]
    groups = {}
    for row in M._live(sets, hashes, M.Settings()).collect():
        groups.setdefault(row.rep, set()).add(row.key)
    most, _ = join_rows(spark, since)
    assert 0 < most <= sum(b - a for _, a, b in stretch)
    linked = 0
    for i, (x, a, b) in enumerate(stretch):
        for y, c, d in stretch[:i]:
            both = max(0, min(b, d) - max(a, c))
            if 100 * both >= 75 * (b - a + d - c - both):
                linked += 1
                assert groups[x] & groups[y]
    assert linked >= 10
