"""The conversation trie against a dictionary of prefixes."""

import random
import zlib
from collections import defaultdict

import pytest
from brute import BLANK_WORD, sha
from pyspark.sql import functions as F

from basketry.llm import conversations as C
from basketry.llm import queries

SF = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        out[c] = turns.get(base, [])[:h] + own[h:]
    return out


def trie(rows):
    convs = rebuilt(rows)
    members, ends = defaultdict(set), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
        ends[tuple(turns)].append(c)
    saved, leaves, children = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p in members:
        own = (len(members[p]) - 1) * len(BLANK_WORD.findall(p[-1][1])) if p else 0
        leaf = not children[p]
        for d in range(len(p) + 1):
            saved[p[:d]] += own
            leaves[p[:d]] += leaf
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p],
                   leaves[p], saved[p], sha(",".join(map(str, sorted(ends[p])))))
                  for p, m in members.items())


def got(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in C.prefix_trie(df).collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def made(seed, n_convs, longest, words=3):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-30, 200), n_convs):
        start = rng.choice([0, 1])
        for t in range(rng.randrange(1, longest)):
            text = f"w{start} " * rng.randrange(words) if rng.random() < 0.3 else f"t{t} x"
            rows.append((c, t, ("user", "assistant")[t % 2], text))
    return rows


def test_op13_matches_brute_force_on_the_table(spark):
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text"))
            for r in queries.table(spark, SF, "conversations").collect()]
    result = queries.op13_prefix_trie(spark, SF)
    assert sorted(tuple(r[c] for c in COLUMNS) for r in result.collect()) == trie(rows)


@pytest.mark.parametrize("height, longest", [(2, 9), (3, 40), (16, 70)])
def test_bands_of_any_height(spark, monkeypatch, height, longest):
    monkeypatch.setattr(C, "HEIGHT", height)
    monkeypatch.setattr(C, "CHUNK_IDS", 3)
    rows = made(height, 60, longest)
    assert got(frame(spark, rows)) == trie(rows)


def test_one_long_conversation_and_many_copies(spark):
    rows = [(40, t, "user", f"word {t % 7}") for t in range(700)]
    rows += [(c, t, "user", "the same words") for c in range(100, 400) for t in range(2)]
    assert got(frame(spark, rows)) == trie(rows)


def test_odd_conversations(spark):
    rows = [(1, None, "user", "a b"), (1, 0, None, None), (1, 0, None, None), (1, 3, "user", ""),
            (None, 1, "user", "no conversation"), (-21, 2, "user", "minus"), (-20, 1, "u", "base"),
            (-20, 2, "u", "base two"), (0, 1, "user", "tab\tnl\n\x0b two"), (0, 1, "assistant", "tie"),
            (7, 5, "user", "x" * 200_000), (7, 6, "user", "word " * 40_000), (47, 1, "user", "short")]
    df = frame(spark, rows).withColumns({c: F.lit(c) for c in ("conv", "depth", "k1", "place", "words")})
    assert got(df) == trie(rows)
    assert got(df.repartition(5)) == trie(rows)
    assert C.prefix_trie(df.limit(0)).count() == 0
    assert C.prefix_trie(df.filter("conv_id is null")).columns == COLUMNS


def test_a_conversation_whose_turns_are_all_cut(spark):
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(c, 1, "user", "gone"), (c, 2, "user", "gone too")]
    assert got(frame(spark, rows)) == [(c, 0, None, 1, 0, 1, 0, sha(str(c)))]


def test_plan_bounds(spark):
    steps, deepest = C.paths(frame(spark, [(20, t, "u", f"t{t}") for t in range(300)]))
    assert deepest == 300
    per_block = steps.groupBy(F.floor(F.col("depth") / C.HEIGHT)).count().agg(F.max("count"))
    assert per_block.first()[0] == C.HEIGHT
