"""Operators that compare rows: against brute force on small tables."""

import random
import re
from collections import Counter, defaultdict

import hypothesis.strategies as st
import numpy as np
import pytest
from brute import (PII, bag, near_classes, pii, repeats, sha, similarity, spans_text)
from hypothesis import given, settings
from pyspark.sql import functions as F

from basketry.llm import nearduplicates as nd
from basketry.llm import pii as P
from basketry.llm import queries, suffixes, urls

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def texts(spark):
    return {r.doc_id: r.text for r in queries.table(spark, SF, "documents").collect()}


def prose(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


# -- 2 URL filters ---------------------------------------------------------------

PAGES = [
    (1, "https://a.example.org/es/x?q=1", '<a href="http://bad.net/1">'),
    (2, "http://EXAMPLE.org/en/1?y", None), (3, "http://b.org", "<p>"), (4, "x.com/fr/", ""),
    (5, None, "<a href='//c.net'>"), (6, "http://shop.com/de/a#b", '<A HREF=https://Spam.NET/x>'),
    (7, "http://spam.net/", '<a href="http://shop.com/">'), (8, "http://bad.net/p", None),
    (9, "http://fine.net/p", '<a href="/local">'), (10, "http://c.com/fr/", '<a href="http://fine.net">'),
    (9, "http://fine.net/p", '<a href="/local">'), (None, "http://notexample.org/es/", None),
    (11, "ftp://u@spam.net:80/de/#", None), (12, "http://shop.com?de/", None),
]


@pytest.fixture(scope="session")
def pages(spark):
    return (spark.createDataFrame(PAGES, "page_id long, url string, html string")
            .withColumns({c: F.lit(c) for c in ("host", "rule", "trust", "src", "n")}))


def test_url_rules(pages):
    rows = {r.page_id: r for r in urls.filter_urls(pages).collect()}
    assert (rows[1].host, rows[1].path, rows[1].rule) == ("a.example.org", "/es/x", "example.org/es/")
    assert (rows[2].host, rows[2].rule, rows[2].verdict) == ("example.org", "example.org/en/1", "block")
    assert (rows[3].path, rows[3].rule) == ("", None)
    assert (rows[4].host, rows[4].path, rows[5].host, rows[5].verdict) == ("", "", "", "allow")
    assert rows[None].rule == "org/" and rows[6].rule == "com/de/" and rows[10].rule == "com/fr/"
    assert (rows[11].host, rows[12].host, rows[12].path) == ("u@spam.net:80", "shop.com", "")
    assert rows[9].verdict == "allow"          # linked from a trusted host
    assert rows[7].verdict == "block"          # links to a blocked host
    assert urls.filter_urls(pages).count() == len(PAGES)
    assert urls.filter_urls(pages.limit(0)).count() == 0


def test_propagation_matches_brute_force(spark):
    rng = random.Random(3)
    hosts = [f"h{i}" for i in range(12)]
    edges = {(a, b): rng.randint(1, 5) for a in hosts for b in rng.sample(hosts, 3) if a != b}
    seed = {h: (rng.random() if rng.random() < .4 else 0.0, rng.random() if rng.random() < .4 else 0.0)
            for h in hosts}
    got = {r.host: (r.trust, r.distrust) for r in urls.propagate(
        spark.createDataFrame([(a, b, n) for (a, b), n in edges.items()], "src string, dst string, n long"),
        spark.createDataFrame([(h, *v) for h, v in seed.items()],
                              "host string, trust double, distrust double")).collect()}
    for side in (0, 1):
        flow = np.zeros((12, 12))
        for (a, b), n in edges.items():
            i, j = (hosts.index(a), hosts.index(b))[::1 if side == 0 else -1]
            flow[i, j] = n
        flow /= np.maximum(flow.sum(axis=1, keepdims=True), 1)
        s = np.array([seed[h][side] for h in hosts])
        v = s.copy()
        for _ in range(12):
            v = .15 * s + .85 * v @ flow
        v /= v.sum()
        assert np.allclose([got[h][side] for h in hosts], v)


def test_url_verdicts_do_not_hang_on_the_graphs_size(spark):
    for scale in (1.0, 1e-10, 1e-18):
        ranks = spark.createDataFrame(
            [("bad", 0.0, .85 * scale), ("worse", .3 * scale, .31 * scale), ("tie", .3 * scale, .3 * scale),
             ("near", .3 * scale, .3 * scale * (1 + 1e-12)), ("good", .31 * scale, .3 * scale),
             ("none", 0.0, 0.0)], "host string, trust double, distrust double")
        got = {r.host for r in urls.host_verdicts(ranks).collect() if r.host_verdict == "block"}
        assert got == {"bad", "worse"}


def test_url_filter_matches_oracle(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{SF}/pages.parquet')")
    want = sorted(con.sql(queries.ORACLE["op2_url_filter"]).fetchall(), key=str)
    got = sorted((tuple(r) for r in queries.op2_url_filter(spark, SF).collect()), key=str)
    assert got == want


# -- 6 personal data --------------------------------------------------------------

TRICKY = [
    "a@b.c.d@e.f x a@b.c%d@e.f ..@x.y me@host", "1.2.3.4.5.6.7.8 256.1.1.1 1.1.1.1.1 0001.02.3.255 9.9.9",
    "4111 1111 1111 1111 4111-1111-1111-1112 12 3 4 5 6 7 8 9 0 1 2 3 4 5", "+1 (555) 123-4567 +44.20 7946 0958 +1-2 ++49 30 123456789",
    "é1.2.3.4 \U0001F600 x@y.zz 中+12 345 678 901 23中", "", None, "a" * 50000 + "@b.co", "1" * 50000,
    "1 23 " * 20000, "a@" + "b." * 20000 + "c", "+1" + " 2" * 30000, "1.1.1." * 8000 + "1", "12 " * 200_000, "1.2.3.4 " * 50_000,
]


def brute_rows(texts):
    return [spans_text(pii(t)) for t in texts]


def test_pii_spans_match_brute_force(spark, texts):
    for r in queries.op6_personal_data(spark, SF).collect():
        want = pii(texts[r.doc_id])
        assert r.base_sha256 == sha(spans_text(want))
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(
            sum(s[3] == k for s in want) for k in PII)
        assert set(filter(None, spans_text(want).split(","))) <= set(r.spans.split(","))


def test_pii_tricky_texts(spark):
    docs = spark.createDataFrame(list(enumerate(TRICKY)), "doc_id long, text string")
    got = P.with_base(docs.withColumn("text", F.coalesce("text", F.lit(""))), "text", "spans")
    rows = {r.doc_id: r.s for r in got.select("doc_id", P.joined_spans().alias("s")).collect()}
    assert [rows[i] for i in range(len(TRICKY))] == brute_rows(TRICKY)


def test_pii_random_texts(spark):
    rng = random.Random(5)
    made = ["".join(rng.choice("ab@.-+ 1234567890()%é") for _ in range(rng.randrange(60)))
            for _ in range(3000)]
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    got = P.with_base(docs, "text", "spans").select("doc_id", P.joined_spans().alias("s")).collect()
    assert {r.doc_id: r.s for r in got} == dict(enumerate(brute_rows(made)))


def test_disclosing_terms(spark, odd_docs, no_docs):
    rows = [(i, f"Doctor Zebulon mailed zeb@x.org about the visit {i}", "en") for i in range(3)]
    rows += [(10 + i, f"the visit about mail number{i} from u{i}@y.org about the visit", "en")
             for i in range(40)]
    rows += [(100 + i, "the visit about nothing at all", "en") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in P.personal_data(docs).collect()}
    found = {rows[0][1][s.start:s.end].lower() for s in got[0].term_spans}
    assert found == {"doctor", "zebulon", "mailed"}
    assert got[10].term_spans == [] and got[100].spans == [] and got[100].term_spans == []
    clean = {r.doc_id: r.text for r in P.sanitise(docs).collect()}
    assert clean[0] == "   [EMAIL] about the visit 0"
    assert clean[100] == rows[-1][1] and clean[10].count("[EMAIL]") == 1
    assert P.personal_data(odd_docs).count() == odd_docs.count()
    assert P.personal_data(no_docs).count() == 0
    same = P.sanitise(odd_docs)
    assert same.columns == odd_docs.columns
    assert Counter(r.text for r in same.collect()) == Counter(r.text for r in odd_docs.collect())
    assert P.sanitise(no_docs).count() == 0


def test_disclosing_terms_of_whole_texts(spark):
    far = "nothing of the visit " * 12
    rows = [(i, f"Header Zebulon. {far}mail zeb@x.org now. {far}Yours, ZEBULON Quux {i}") for i in range(3)]
    rows += [(10 + i, f"header {far} u{i}@y.org yours mail now") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.term_spans for r in P.personal_data(docs).collect()}
    # The first word of the text, and a signature 250 characters from the address.
    assert [rows[0][1][s.start:s.end] for s in got[0]] == ["Zebulon", "ZEBULON", "Quux"]
    assert got[0] == got[1] == got[2] and got[10] == []
    clean = {r.doc_id: r.text for r in P.sanitise(docs).collect()}
    assert clean[1] == f"Header . {far}mail [EMAIL] now. {far}Yours,   1"
    assert "header" in clean[10]


def test_copies_are_no_evidence(spark):
    """Doubling every row changes no span; two copies of one text disclose nothing."""
    docs = queries.table(spark, SF, "documents").select("doc_id", "text")
    once = {r.doc_id: r.term_spans for r in P.personal_data(docs).collect()}
    again = P.personal_data(docs.unionByName(docs)).collect()
    assert len(again) == 2 * len(once) and all(r.term_spans == once[r.doc_id] for r in again)
    rows = [(i, "only this sentence of twelve words holds the address zeb@x.org today") for i in range(2)]
    rows += [(9 + i, f"other words of text {i}") for i in range(30)]
    alone = P.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.term_spans == [] for r in alone)


def test_term_spans_match_brute_force(spark):
    import math
    import re
    rng = random.Random(11)
    people = [f"u{i}@y.org" for i in range(6)]
    names = [f"Name{'abcdef'[i] * 3}" for i in range(6)]
    made = []
    for _ in range(120):
        who = rng.randrange(6)
        made.append(" ".join([prose_word(rng), names[who] if rng.random() < 0.8 else "someone", "wrote",
                              people[who] if rng.random() < 0.6 else "nobody", prose_word(rng)]))
    made += made[:30]
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    distinct = sorted(set(made))
    entities = {t: {f"{s[3]}:{t[s[0]:s[2]].lower()}" for s in pii(t)} for t in distinct}
    terms = {t: {w.lower() for w in re.findall(r"[^\W\d_]{3,}", t)} for t in distinct}
    n_c = Counter(c for t in distinct for c in entities[t])
    n_t = Counter(w for t in distinct for w in terms[t])
    n_ct = Counter((c, w) for t in distinct for c in entities[t] for w in terms[t])
    total = len(distinct)
    risky = {k for k, n in n_ct.items() if n >= 2 and n_c[k[0]] < total and round(
        math.log(n * total / (n_c[k[0]] * n_t[k[1]])) / math.log(total / n_c[k[0]]), 6) >= 0.8}
    assert risky
    for r in P.personal_data(docs).collect():
        t = made[r.doc_id]
        own = {w for c, w in risky if c in entities[t]}
        want = [(m.start(), m.end()) for m in re.finditer(r"[^\W\d_]{3,}", t) if m[0].lower() in own
                and not any(s[0] < m.end() and m.start() < s[2] for s in pii(t))]
        assert [(s.start, s.end) for s in r.term_spans] == want


def prose_word(rng):
    return "".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(3))


def test_pii_plan_is_native(spark):
    plan = queries.op6_personal_data(spark, SF)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_texts_travel_once_for_all_their_terms(spark):
    """No row per (text, term) is shuffled, for the terms' counts or beside an entity."""
    docs = queries.table(spark, SF, "documents").select("doc_id", "text")
    found = P.found_spans(docs).checkpoint(eager=True)
    counts = P.disclosure(docs, found)
    beside = P._beside(docs, found, P.mentions(found).select("c").distinct(), "text")
    for df in (counts, beside):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(key#" in plan and not re.search(r"hashpartitioning\(key#\d+, t#", plan)


# -- 8 suffix dedup -----------------------------------------------------------------

def check_repeats(spark, made, threshold=200):
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in suffixes.remove_repeats(docs, threshold).collect()}
    assert [got[i] for i in range(len(made))] == repeats(made, threshold)


def test_repeats_match_brute_force(spark, texts):
    want = dict(zip(texts, repeats(texts.values())))
    for r in queries.op8_suffix_dedup(spark, SF).collect():
        assert tuple(r)[1:] == want[r.doc_id]


def test_repeats_of_edited_copies(spark):
    rng = random.Random(11)
    base, passage = prose(rng, 300), prose(rng, 60)
    made = [base, base, None, "", base[:199], base[50:250], passage, "é" * 150, "ab" * 400]
    for i in range(60):  # edits, shared passages at any place, boundaries inside words
        t = list(base)
        for _ in range(rng.randrange(1, 9)):
            t[rng.randrange(len(t))] = rng.choice("xyzé")
        made.append("".join(t)[rng.randrange(200):rng.randrange(900, len(t))])
        made.append(prose(rng, rng.randrange(40)) + passage[rng.randrange(90):] + prose(rng, 10))
    check_repeats(spark, made)


def test_repeats_inside_one_text_and_other_thresholds(spark):
    rng = random.Random(2)
    part = prose(rng, 40)
    made = [part + " middle " + part, prose(rng, 50), "a" * 1000, "xyz" * 90, part[:100] * 3]
    check_repeats(spark, made)
    check_repeats(spark, made, 128)
    check_repeats(spark, made, 255)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=700), min_size=1, max_size=5))
def test_runs_choose_every_suffix_once(raw):
    found = suffixes.runs(raw, suffixes._Grams(), 200)
    starts = defaultdict(list)
    for d, a, lo, hi, _ in zip(*found) if found else ():
        assert lo <= a and a + suffixes.GRAM <= lo + 200 and a <= hi + 136 and hi <= a
        starts[int(d)] += range(lo, hi + 1)
    for i, t in enumerate(raw):
        assert sorted(starts[i]) == list(range(max(0, len(t) - 199)))


def test_repeats_odd_rows(odd_docs, no_docs):
    rows = odd_docs.collect()
    want = Counter((r.doc_id, *x) for r, x in zip(rows, repeats([r.text for r in rows])))
    assert Counter(tuple(r) for r in suffixes.remove_repeats(odd_docs).collect()) == want
    assert suffixes.remove_repeats(no_docs).count() == 0


# -- 9 near duplicates -----------------------------------------------------------------

def same_classes(rows, got):
    """got: (id, class_id, size) rows in the order of rows."""
    want = near_classes(rows)
    size = Counter(want)
    least = {}
    for (i, _), g in zip(rows, want):
        least[g] = min(least.get(g, i), i)
    return [(i, least[g], size[g]) for (i, _), g in zip(rows, want)] == got


def classes(spark, made, **more):
    docs = spark.createDataFrame(made, "doc_id long, text string").repartition(3)
    got = {r.doc_id: tuple(r) for r in nd.near_duplicate_classes(docs, **more).collect()}
    return [got[i] for i, _ in made]


def test_near_duplicates_match_brute_force(spark, texts):
    made = sorted(texts.items())
    got = {r.doc_id: tuple(r) for r in queries.op9_near_duplicates(spark, SF).collect()}
    assert same_classes(made, [got[i] for i, _ in made])


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10 ** 6)}"
    return " ".join(w)


def test_near_duplicates_of_edited_copies(spark):
    rng = random.Random(4)
    base = [prose(rng, 200) for _ in range(6)]
    passage = prose(rng, 90)
    made = [edited(rng, rng.choice(base), rng.randrange(0, 7)) for _ in range(150)]
    made += [passage + " " + prose(rng, rng.randrange(20, 60)) for _ in range(60)]
    made += ["one two", "One, two!", "one two three", "", "!!", "", "one two", "x " * 500, "x " * 560, "x " * 900]
    assert same_classes(list(enumerate(made)), classes(spark, list(enumerate(made))))


def test_recall_by_overlap_band(spark):
    """Planted pairs, each of its own words: the share that is found, by true overlap."""
    rng = random.Random(12)
    made, pairs = [], defaultdict(list)
    for n in range(900):
        text = " ".join(f"p{n}x{i}" for i in range(rng.choice([150, 150, 150, 400])))
        other = edited(rng, text, rng.randrange(1, 4))
        overlap = similarity(bag(text), bag(other))
        if overlap >= 0.8:
            pairs[min(int(overlap * 20), 19)].append(len(made))
        made += [text, other]
    got = {r.doc_id: r.class_size for r in nd.near_duplicate_classes(
        spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")).collect()}
    recall = {band: np.mean([got[i] == 2 for i in at]) for band, at in pairs.items()}
    print({f"{band / 20:.2f}": (len(pairs[band]), round(r, 4)) for band, r in sorted(recall.items())})
    assert sorted(pairs) == [16, 17, 18, 19] and min(map(len, pairs.values())) >= 60
    assert min(recall.values()) >= 0.98


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(6)
    keys = rng.integers(0, 1 << 62, 60).astype(np.uint64)
    keys.sort()
    pairs = []
    for _ in range(40):
        a, b = rng.integers(1, 12, 60), rng.integers(1, 12, 60)
        pairs.append((np.minimum(a, b).sum() / np.maximum(a, b).sum(), (keys, a), (keys, b)))
    sig = nd.signatures([x for p in pairs for x in p[1:]], 1024)
    error = [(sig[2 * i] == sig[2 * i + 1]).mean() - p[0] for i, p in enumerate(pairs)]
    assert abs(np.mean(error)) < 0.01 and np.max(np.abs(error)) < 0.07


def test_overlap_is_exact():
    from basketry.llm.texts import WordHashes, words
    rng = random.Random(8)
    for _ in range(100):
        a, b = (" ".join(rng.choice("ab") for _ in range(rng.randrange(1, 30))) for _ in range(2))
        h = WordHashes()
        got = nd.overlap(*(nd.bag(h.of(words(t.encode()))) for t in (a, b)))
        assert got == pytest.approx(similarity(bag(a), bag(b)))


def test_near_duplicates_odd_rows(spark, odd_docs, no_docs):
    got = nd.near_duplicate_classes(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert sorted(r.class_size for r in got) == [1] * 9 + [2] * 2
    kept = nd.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 1
    assert nd.near_duplicate_classes(no_docs).count() == nd.drop_near_duplicates(no_docs).count() == 0
    rng = random.Random(1)
    base = prose(rng, 200)
    rows = [(5, base), (5, base), (2, base + " tail"), (None, base), (7, "other text of its own")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in nd.drop_near_duplicates(docs).collect()) == [
        (2, base + " tail"), (7, "other text of its own")]
    assert {r.class_id for r in nd.near_duplicate_classes(docs).collect()} == {2, 7}
