"""Links inside buckets and the n-gram Jaccard join: against all pairs."""

import random
from collections import defaultdict

import numpy as np
import pytest
from brute import BLANK_WORD, lower
from pyspark.sql import functions as F

from basketry.llm import linking, ngramjoin, queries
from basketry.llm.texts import WordHashes

SF = "/root/testdata/sf0.001"


def grams(text):
    w = BLANK_WORD.findall(lower(text))
    n = min(4, len(w))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()


def components(rows):
    """(id, n_shingles, component_id) of (id, text) rows by all pairs that share a shingle."""
    sets = [grams(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    pairs = {(i, j) for h in holders.values() for i in h for j in h if i < j} if len(rows) < 400 else None
    for i, j in pairs:
        both = len(sets[i] & sets[j])
        if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
            group[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted(((doc, len(sets[i]), least.get(root(i))) for i, (doc, _) in enumerate(rows)), key=str)


def joined(spark, rows, parts=3):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    return sorted((tuple(r) for r in ngramjoin.jaccard_components(docs).collect()), key=str)


def prose(rng, n, vocabulary=3000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10 ** 6)}"
    return " ".join(w)


def test_op12_matches_all_pairs_on_the_table(spark):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, SF, "documents").collect()]
    got = queries.op12_ngram_join(spark, SF)
    assert sorted((tuple(r) for r in got.collect()), key=str) == components(rows)


@pytest.mark.parametrize("block, salt", [(512, 256), (5, 2)])
def test_one_large_group_and_shared_passages(spark, monkeypatch, block, salt):
    """A family around one text, a passage that many share, and short texts at the limit."""
    monkeypatch.setattr(linking, "BLOCK", block)
    monkeypatch.setattr(linking, "PER_SALT", salt)
    rng = random.Random(block)
    base, passage = prose(rng, 120), prose(rng, 60)
    made = [edited(rng, base, rng.randrange(0, 5)) for _ in range(150)]
    made += [passage + " " + prose(rng, rng.randrange(1, 30)) for _ in range(80)]
    made += [base] * 20 + [passage, passage.upper(), "a b c", "a b c d", "A  b\tc", "", None, " \n", "a"]
    assert joined(spark, list(enumerate(made))) == components(list(enumerate(made)))


def test_overlap_exactly_at_the_limit(spark):
    word = lambda i, j: " ".join(f"k{x}" for x in range(i, j))
    # 20 shingles against the first 17 of them: 85 of 100; 16 of 19 and 33 of 39 are below.
    rows = [(1, word(0, 23)), (2, word(0, 20)), (3, word(100, 122)), (4, word(100, 119)),
            (5, word(200, 242)), (6, word(200, 236))]
    got = {r[0]: r[2] for r in joined(spark, rows)}
    assert got == {r[0]: r[2] for r in components(rows)}
    assert got[2] == 1 and got[4] == 4


def test_chains_reach_across_buckets(spark):
    rng = random.Random(2)
    chain, text = [], prose(rng, 100)
    for i in range(40):
        chain.append((1000 - i, text))
        text = edited(rng, text, 1)
    rows = chain + [(i, prose(rng, 50)) for i in range(20)]
    got = joined(spark, rows)
    assert got == components(rows) and {r[2] for r in got if r[0] > 900} == {961}


def test_odd_texts(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = ngramjoin.jaccard_components(odd_docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == components(rows)
    assert ngramjoin.jaccard_components(no_docs).count() == 0
    alone = [(None, "the same five words here"), (None, "the same five words here"), (None, None)]
    assert joined(spark, alone) == [(None, 0, None), (None, 2, None), (None, 2, None)]


def test_parity_maps_never_exceed_the_difference():
    rng = np.random.default_rng(4)
    for n in (1, 30, 600, 5000):
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[n // 3:], rng.integers(0, 1 << 62, n // 2 + 1).astype(np.uint64)]))
        ca, cb = rng.integers(1, 5, len(a)), rng.integers(1, 5, len(b))
        at = {int(k): int(c) for k, c in zip(a, ca)}
        apart = sum(abs(at.get(int(k), 0) - int(c)) for k, c in zip(b, cb))
        apart += sum(c for k, c in at.items() if np.uint64(k) not in b)
        bits = [np.frombuffer(linking.parity_map(*x), np.uint64) for x in ((a, ca), (b, cb))]
        assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= apart
        bits = [np.frombuffer(linking.parity_map(x), np.uint64) for x in (a, b)]
        assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= len(np.setxor1d(a, b))


def test_ratio_in_whole_numbers():
    r = linking.Ratio(0.85)
    assert (r.num, r.den) == (17, 20)
    for a in range(1, 60):
        for b in range(1, 60):
            for inter in range(min(a, b) + 1):
                want = 100 * inter >= 85 * (a + b - inter)
                assert r.holds(inter, a + b) == want
                assert want <= (a + b - 2 * inter <= r.most_apart(np.array([a + b]))[0])
                assert want <= (inter >= ngramjoin.least_overlap(max(a, b), r))


def test_every_pair_of_a_bucket_is_settled_with_few_checks(spark, monkeypatch):
    """One bucket for all: classes equal all pairs, and checks stay near the bucket's size."""
    monkeypatch.setattr(linking, "BLOCK", 16)
    rng = random.Random(9)
    base = [prose(rng, 60) for _ in range(4)]
    made = sorted({edited(rng, base[i % 4], rng.randrange(0, 4)) for i in range(200)})
    known = WordHashes()
    rows = [(i, t, len(s := ngramjoin.shingles(t.encode(), known)), linking.parity_map(s))
            for i, t in enumerate(made)]
    nodes = spark.createDataFrame([(i, n, b) for i, _, n, b in rows],
                                  "node long, size long, bits binary")
    texts = spark.createDataFrame([(i, t) for i, t, *_ in rows], "node long, text string")
    members = nodes.select(F.lit(1).alias("bucket"), "node", F.lit(len(rows)).alias("n"))
    checked = spark.sparkContext.accumulator(0)
    ratio = linking.Ratio(0.85)

    def linked(a, b):
        checked.add(1)
        return ratio.holds(len(np.intersect1d(a, b)), len(a) + len(b))

    labels = linking.linked_classes(members, nodes, lambda some: texts.join(some, "node"), 0.85,
                                    lambda t: ngramjoin.shingles(t, WordHashes()), linked)
    got = {r.node: r.label for r in labels.collect()}
    want = {doc: c for doc, _, c in components(list(enumerate(made)))}
    assert {i: got.get(i, i) for i in want} == want
    assert checked.value < len(made) ** 2 / 8


def test_bucket_rows_move_once(spark):
    rows = [(b, n) for b in range(30) for n in range(b % 4)] + [(99, n) for n in range(500)]
    got = linking.shared_buckets(spark.createDataFrame(rows, "bucket long, node long"))
    size = defaultdict(int)
    for b, _ in rows:
        size[b] += 1
    assert sorted(map(tuple, got.collect())) == sorted((b, n, size[b]) for b, n in rows if size[b] > 1)
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning(bucket") == 1


def test_texts_move_to_their_nodes_once(spark, monkeypatch):
    base = " ".join(f"w{i}" for i in range(60))
    texts = [(i, f"{base} end {i}") for i in range(6)] + [(3, f"{base} end 3")] * 5 + [(None, f"{base} end 0")]
    seen, pairs = [], linking.linked_pairs

    def kept(*args):
        seen.append(pairs(*args))
        return seen[-1]

    monkeypatch.setattr(linking, "linked_pairs", kept)
    got = ngramjoin.jaccard_components(spark.createDataFrame(texts, "doc_id long, text string"))
    assert sorted(r["component_id"] for r in got.collect()) == [0] * len(texts)
    assert len(seen[0].collect()) == 5
    plan = seen[0]._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # Repeated rows go on the way that both joins of the texts take: no way of their own.
    assert plan.count("partial_first(text") == 1


def test_wide_maps_never_exceed_the_difference_and_tell_long_texts_apart():
    rng = np.random.default_rng(6)
    draw = lambda n: np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
    assert linking.wide_map(draw(linking.BITS)) is None
    for n, m in ((1100, 1300), (2000, 2100), (5000, 4000), (9000, 1100)):
        a = draw(n)
        for b in (np.unique(np.concatenate([a[n // 9:], draw(50)])), draw(m)):
            maps = linking.wide_map(a), linking.wide_map(b)
            assert linking.least_apart(*maps) == linking.least_apart(*maps[::-1])
            assert linking.least_apart(*maps) <= len(np.setxor1d(a, b))
            assert len(maps[0]) * 8 >= len(a)
        assert linking.least_apart(*maps) > linking.Ratio(0.85).most_apart(len(a) + len(b))


def test_long_texts_with_a_passage_in_common_are_not_read(spark, monkeypatch):
    rng = random.Random(12)
    a, b, passage = prose(rng, 4200, 10 ** 6), prose(rng, 4200, 10 ** 6), prose(rng, 800, 10 ** 6)
    rows = [(1, f"{a} {passage}"), (2, f"{b} {passage}"), (8, edited(rng, f"{b} {passage}", 20))]
    rows += [(i, f"{x} {prose(rng, 800, 10 ** 6)}") for i, x in ((3, a), (4, a), (5, b), (6, b))]
    seen, pairs = set(), linking.linked_pairs

    def kept(some, *args):
        seen.update((min(r), max(r)) for r in some.select("a", "b").collect())
        return pairs(some, *args)

    monkeypatch.setattr(linking, "linked_pairs", kept)
    assert joined(spark, rows) == components(rows)
    assert len(seen) == 1
