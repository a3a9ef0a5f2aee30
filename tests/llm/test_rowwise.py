"""Operators that judge each text: against brute force, libraries and round trips."""

import random
import tracemalloc

import hypothesis.strategies as st
import pyarrow as pa
import pytest
from brute import contamination, license_base, quality, sha
from hypothesis import given, settings

from basketry.llm import decontaminate, language, licenses, pieces, queries, tokens
from basketry.llm import quality as q

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def texts(spark):
    return {r.doc_id: r for r in queries.table(spark, SF, "documents").collect()}


# -- 1 token counts -----------------------------------------------------------

def test_token_counts_match_library(spark, texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokens.tokenizer_path())
    rows = queries.op1_token_counts(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id].text or ""
        n = len(tok.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 512)


def test_token_counts_odd_rows(odd_docs, no_docs):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokens.tokenizer_path())
    want = sorted(len(tok.encode(r.text or "", add_special_tokens=False).ids)
                  for r in odd_docs.collect())
    got = tokens.count_tokens(odd_docs, limit=1000).collect()
    assert sorted(r.n_tokens for r in got) == want
    assert tokens.count_tokens(no_docs).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab Z09'st\n\t é中<|endoftext|>.- \x1c"),
               max_size=120), st.integers(1, 12))
def test_split_boundaries_are_safe(text, limit):
    from tokenizers import Tokenizer
    tok = tokens._encoder(tokens.tokenizer_path())
    parts = tokens.safe_pieces(text, limit)
    assert "".join(parts) == text
    whole = tok.encode(text, add_special_tokens=False).ids
    assert sum((tok.encode(p, add_special_tokens=False).ids for p in parts), []) == whole


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab Z09'st\n\t é中²<|endoftext|>.-_,!?):;\"\u0301 \x1c"),
                        max_size=80), max_size=6), st.integers(1, 40))
def test_part_counts_match_library(texts, limit):
    tok = tokens._encoder(tokens.tokenizer_path())
    known = tokens.PartCounts(tok)
    whole = [len(tok.encode(t, add_special_tokens=False).ids) for t in texts]
    assert known.of(texts, limit) == whole
    assert known.of(texts, limit) == whole  # from what it remembers


def test_texts_stay_whole_where_a_special_string_could_be_cut():
    from tokenizers import AddedToken, Tokenizer
    tok = Tokenizer.from_file(tokens.tokenizer_path())
    tok.add_special_tokens([AddedToken("<end of, text>")])
    texts = ["a <end of, text> b", "no end of, text here"]
    want = [len(tok.encode(t, add_special_tokens=False).ids) for t in texts]
    assert tokens.PartCounts(tok).of(texts, 4) == want


def test_part_counts_forget_within_their_memory(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_BYTES", 2000)
    tok = tokens._encoder(tokens.tokenizer_path())
    known = tokens.PartCounts(tok)
    for i in range(20):
        text = " ".join(f"word{j}" for j in range(i * 50, i * 50 + 50))
        assert known.of([text], 64) == [len(tok.encode(text, add_special_tokens=False).ids)]
        assert known.used <= 2000


# -- 3 license scans ------------------------------------------------------------

def test_license_base_matches_brute_force(spark, texts):
    for r in queries.op3_license_scan(spark, SF).collect():
        want = license_base(texts[r.doc_id].text)
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want
        assert set(filter(None, want[4].split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score == 1.0 or not want[1])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["mit", "license", "apache", "general", "public", "x", "icense",
                                 "mitlicense", "MIT", "License.", "é"]), max_size=30))
def test_license_places_any_order(parts):
    from basketry.llm.texts import words
    text = " ".join(parts)
    n, base, first, last, _ = license_base(text)
    w = words(text.encode())
    found = licenses._Scanner(licenses.NOTICES).scan([b" " + b" ".join(w) + b" "])[0]
    exact = [s for s in found if s[5] and s[3] == 0]
    assert (len(w), len(exact)) == (n, base)
    assert min((s[1] for s in exact), default=None) == first


def test_license_fuzzy_and_odd_rows(odd_docs, no_docs):
    rows = {r.doc_id: r for r in licenses.find_notices(odd_docs).collect() if r.doc_id}
    assert [s.label for s in rows[9].spans if s.edits] == ["gpl", "apache"]
    gpl = rows[9].spans[0]
    assert (gpl.first_word, gpl.edits) == (2, 2)
    assert sum(s.edits == 0 for s in rows[3].spans) == 3
    assert rows[1].spans == [] and rows[1].n_words == 0
    assert licenses.find_notices(odd_docs).count() == odd_docs.count()
    assert licenses.find_notices(no_docs).count() == 0


# -- 4 decontamination -------------------------------------------------------------

def test_neighbouring_notices_share_a_space(spark):
    rows = [(1, "mit licence mit licence"), (2, "the mit license mit licence applies"),
            (3, "mit license mit license mit licens")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [(s.first_word, s.edits) for s in r.spans if s.label == "mit"]
           for r in licenses.find_notices(docs).collect()}
    assert got == {1: [(0, 1), (2, 1)], 2: [(1, 0), (3, 1)], 3: [(0, 0), (2, 0), (4, 1)]}


def test_contamination_matches_brute_force(spark, texts):
    items = [tuple(r) for r in queries.table(spark, SF, "benchmark").collect()]
    for r in queries.op4_decontamination(spark, SF).collect():
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == \
            contamination(texts[r.doc_id].text, items)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=40), min_size=1, max_size=4),
       st.lists(st.lists(st.sampled_from("abcd"), max_size=60), min_size=1, max_size=4),
       st.sampled_from([2, 5, 13]))
def test_windows_in_shards(items, docs, window):
    import numpy as np
    named = [(i, " ".join(x)) for i, x in enumerate(items)]
    for block in decontaminate._blocks(named, window):
        for d in docs:
            ids = np.array([block.vocabulary.get(w.encode(), 0) for w in d] + [0], np.int64)
            found = decontaminate._longest(*decontaminate._occurrences(ids, block, window), block)
            hit = set()
            for piece, item_start, place, size in found:
                hit.update(range(place, place + size))
                assert items[int(block.names[piece])][item_start:item_start + size] == d[place:place + size]
            want = contamination(" ".join(d), named, window)
            assert (len(hit), len({block.names[f[0]] for f in found})) == want[1:3]


def test_contamination_blocks_and_odd_rows(spark, odd_docs, no_docs, monkeypatch):
    from collections import Counter
    items = [(1, "brown fox jumps over the lazy dog the quick brown fox jumps over the"),
             (2, "mit license"), (None, "end of it"), (3, None), (4, "end"), (5, "brown fox " * 40)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = [i for i in items if i[0] is not None]
    want = Counter((r.doc_id, *contamination(r.text, kept)[:3]) for r in odd_docs.collect())
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 64)
    assert len(list(decontaminate._blocks(items, 13))) > 1
    got = decontaminate.contamination(odd_docs, bench)
    assert Counter((r.doc_id, r.n_words, r.n_hit, len(r["items"])) for r in got.collect()) == want
    assert decontaminate.contamination(odd_docs, bench.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.contamination(no_docs, bench).count() == 0
    left = decontaminate.remove_contaminated(odd_docs, bench)
    assert left.columns == odd_docs.columns
    assert {r.doc_id for r in left.collect()} == {1, 2, None, 5, 6, 8, 9}


# -- 5 quality rules -----------------------------------------------------------------

def test_quality_matches_brute_force(spark, texts):
    rows = queries.op5_quality_rules(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                r.base_failed) == quality(texts[r.doc_id].text)
        assert not (r.base_failed and r.kept)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab \t\n\x0b\x1c é#"), max_size=60))
def test_measures_of_any_text(text):
    n, chars, symbols, dup, repeated, _ = quality(text)
    assert q.measure(text.encode())[:5] == (n, chars, symbols, dup, repeated)


def test_hosts_of_one_document_are_shrunk_to_the_mean(spark):
    """No document goes on a single observation; a large host that fails keeps its own rate."""
    a, b = q.beta_prior(100, 100, 100.0, 10.0, 10.0)
    assert (1 + a) / (1 + a + b) < 0.2 and (0 + a) / (1 + a + b) < 0.1
    clean = " ".join(f"word{i} of text" for i in range(10))
    noisy = clean + " # # # # #"
    rows = [(i, clean if i % 10 else noisy, f"host{i}") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert all(r.kept for r in q.judge(docs).collect())
    rows += [(1000 + i, noisy if i % 20 else clean, "large") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id: r.kept for r in q.judge(docs).collect()}
    assert all(kept[i] for i in range(100)) and [kept[1000 + i] for i in range(60)] == [
        i % 20 == 0 for i in range(60)]


def test_hosts_are_shrunk_and_joined_back(spark, odd_docs, no_docs):
    bad = "%%% ### word " * 4
    fine = "one two three four five six seven eight nine ten eleven"
    rows = ([(i, bad + str(i), "bad") for i in range(60)] + [(100, fine, "bad")]
            + [(200 + i, f"{fine} {i}", "good") for i in range(60)] + [(300, bad, "good")]
            + [(400, bad, "small")])
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in q.judge(docs).collect()}
    assert not any(got[i].kept for i in range(60) if not got[i].base_failed)
    assert got[100].kept and got[300].host_flags == [] and got[200].kept
    rates = {r.host: r for r in q.host_verdicts(q.measures(docs)).collect()}
    assert rates["bad"].symbols_rate < 1 and rates["good"].symbols_rate > 0
    assert abs(rates["small"].symbols_rate - 1) > abs(rates["bad"].symbols_rate - 60 / 61)
    assert q.judge(odd_docs).count() == odd_docs.count()
    assert q.judge(no_docs).count() == 0


# -- 7 pieces ---------------------------------------------------------------------------

def test_pieces_round_trip(spark, texts, odd_docs, no_docs):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    for docs in (queries.table(spark, SF, "documents"), odd_docs):
        rows = pieces.decode(pieces.encode(docs)).collect()
        assert len(rows) == docs.count()
        assert sorted(map(str, pieces.round_trip(docs).collect())) == sorted(map(str, rows))
        for r in rows:
            assert r.decoded == r.text
            if r.text and "▁" not in r.text and len(r.text) < 5000:
                assert sp.decode(r.piece_ids) == r.text
    assert pieces.decode(pieces.encode(no_docs)).count() == 0


def test_pieces_are_seeded_by_row_key(spark):
    text = "international understanding of unbelievable circumstances " * 3
    docs = spark.createDataFrame([(1, text), (2, text), (1, text)], "doc_id long, text string")
    a = [r.piece_ids for r in pieces.encode(docs).orderBy("doc_id").collect()]
    assert a[0] == a[1] != a[2]
    again = [r.piece_ids for r in pieces.encode(docs.repartition(3)).orderBy("doc_id").collect()]
    assert again == a
    assert [r.piece_ids for r in pieces.encode(docs, seed=7).orderBy("doc_id").collect()] != a


def test_pieces_follow_the_lattice_distribution():
    """Sampled segmentations of one chunk against all of them, enumerated."""
    from collections import Counter
    lat = pieces._lattices(pieces.model_path(), 1.0)
    chunk = " than"

    def paths(at):
        if at == len(chunk):
            yield (), 1.0
        for e in range(at + 1, len(chunk) + 1):
            hit = lat.weight.get(chunk[at:e])
            if hit:
                for rest, w in paths(e):
                    yield (hit[1],) + rest, w * hit[0]

    every = dict(paths(0))
    total, n = sum(every.values()), 20000
    drawn = Counter(tuple(x.tolist()) for x in
                    lat.sample(["than"] * n, [str(i).encode() for i in range(n)], 3))
    assert set(drawn) <= set(every)
    for path, w in every.items():
        p = w / total
        assert abs(drawn[path] / n - p) < 5 * (p * (1 - p) / n) ** 0.5 + 1e-3


def test_pieces_do_not_depend_on_kept_lattices(texts, monkeypatch):
    import numpy as np
    rows = sorted((str(k).encode(), r.text or "") for k, r in texts.items())
    keys, parts = [k for k, _ in rows], [t for _, t in rows]
    alone = pieces.Lattices(pieces.model_path(), 1.0)
    want = []
    for k, t in rows:
        alone.known, alone.kept = {}, alone.filtered([])
        want.append(alone.sample([t], [k], 7)[0])
    for nodes, step in ((1 << 19, 50), (500, 7), (0, len(rows))):
        monkeypatch.setattr(pieces, "KEPT_NODES", nodes)
        lat = pieces.Lattices(pieces.model_path(), 1.0)
        got = [x for i in range(0, len(rows), step) for x in
               lat.sample(parts[i:i + step], keys[i:i + step], 7)]
        assert all(map(np.array_equal, got, want))
        assert len(lat.kept[1]) - 1 <= nodes and len(lat.known) == len(lat.kept[0])


# -- 10 language ID -------------------------------------------------------------------

def test_lattices_of_a_part_take_little_memory():
    draw = random.Random(3)
    texts = [" ".join("".join(draw.choices("etaoinshrdlu", k=draw.randint(2, 9))) for _ in range(300))
             for _ in range(600)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["t"])
    lat = pieces.Lattices(pieces.model_path(), 1.0)
    tracemalloc.start()
    try:
        for b in pieces.chunks([batch], "t", pieces.PART_BYTES):
            lat.sample(b.column(0).to_pylist(), [b"k"] * b.num_rows, 42)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(map(len, texts)) > 1 << 20 and peak < 140 << 20, peak


def test_language_accuracy_on_held_out(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op10_language_id(spark, sf).collect()
    lang = {r.doc_id: r.lang for r in queries.table(spark, sf, "documents").collect()}
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 200
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.97


def test_language_odd_rows(spark, odd_docs, no_docs):
    train = spark.createDataFrame(
        [("the cat and the dog in the house", "en"), ("der hund und die katze im haus", "de"),
         (None, "en"), ("les chats", None)], "text string, lang string")
    model = language.fit(train)
    got = {r.doc_id: r for r in language.predict(odd_docs, model).collect()}
    assert (got[1].lang_pred, got[2].lang_pred, got[8].lang_pred) == ("und",) * 3
    assert got[4].lang_pred == "en" and 0 < got[4].score <= 1
    assert language.predict(odd_docs, model).count() == odd_docs.count()
    nothing = language.fit(train.limit(0))
    assert {r.lang_pred for r in language.predict(odd_docs, nothing).collect()} == {"und"}
    assert language.predict(no_docs, model).count() == 0
    kept = language.keep_identified(odd_docs, model)
    assert kept.columns == odd_docs.columns and not {1, 2, 8} & {r.doc_id for r in kept.collect()}


def test_false_positives_are_corrected():
    import numpy as np
    rng = np.random.default_rng(1)
    grams = rng.integers(0, 1 << 62, 4000).astype(np.uint64)
    place, mask = language.slot_masks(grams, np.repeat([0, 1], [3900, 100]), 12 * 3900, 1)
    masks = np.zeros((12 * 3900, 1), np.uint64)
    masks[place, 0] = mask
    model = language.Model.of(["big", "small"], {"big": 3900, "small": 100}, masks, 1)
    assert model.false_rate[0] > model.false_rate[1]
    strangers = rng.integers(0, 1 << 62, 50_000).astype(np.uint64)
    assert model.counts(strangers)[0] < 0.005 * len(strangers)
    assert (model.contained(grams[3900:])[:, 0] & np.uint64(2) > 0).all()


def _gram_places(text):
    """Grams of a text from the definition: four characters with one word edge at most."""
    import re
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
                       re.sub("[A-Z]", lambda m: m[0].lower(), text))
    line = re.sub("[0-9]", " ", f" {' '.join(words)} ")
    return [line[i:i + 4] for i in range(len(line) - 3) if line[i:i + 4].count(" ") <= 1]


def test_masks_hold_every_language_of_every_gram_and_popcounts_decide(spark):
    import zlib
    from collections import Counter

    import numpy as np
    docs = queries.table(spark, SF, "documents")
    rows = [r for r in docs.select("doc_id", "text", "lang").collect() if r.text is not None]
    counted = {}
    for r in rows:
        if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1:
            counted.setdefault(r.lang, Counter()).update(_gram_places(r.text))
    names = sorted(counted)
    rate = {l: {g: n / c.total() for g, n in c.items()} for l, c in counted.items()}
    every = sorted(set().union(*counted.values()))
    best = {g: max(rate[l].get(g, 0) for l in names) for g in every}
    levels = [{l: {g for g in rate[l] if rate[l][g] >= best[g] * r} for l in names}
              for r in language.RATIOS]
    model = language.fit(docs.filter(~language.held_out()))
    assert model.languages == names
    hashes = {g: h for r in rows for g, h in zip(_gram_places(r.text),
                                                 language.gram_hashes(r.text.encode()), strict=True)}
    grams = np.array([hashes[g] for g in every], np.uint64)
    held = model.contained(grams)
    extra = 0
    for j, level in enumerate(levels):
        for i, l in enumerate(names):
            bit = j * len(names) + i
            has = (held[:, bit // 64] >> np.uint64(bit % 64) & np.uint64(1)).astype(bool)
            want = np.array([g in level[l] for g in every])
            assert has[want].all()  # no language of a gram is missing
            extra += (has & ~want).sum()
    assert extra < 0.02 * len(every) * len(names) * len(levels)
    # Exact sets in place of the filters decide alike.
    judged = language.judge([r.text.encode() for r in rows], model)
    differ = 0
    for r, (lang, _) in zip(rows, judged):
        places = _gram_places(r.text)
        counts = [sum(g in level[l] for level in levels for g in places) for l in names]
        want = names[int(np.argmax(counts))]
        if lang not in ("und", want):
            differ += 1
            assert counts[names.index(lang)] >= 0.98 * max(counts)
    assert differ <= 0.01 * len(rows)
