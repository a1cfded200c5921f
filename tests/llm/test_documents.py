"""Operators on documents: defined results of odd rows, and brute-force versions on small tables."""

import itertools
import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from stratagauge.llm import licences, linededup, mixing, neardup, pieces, quality, toxicity
from stratagauge.llm.common import components, jaccard, jaccard_block, stage
from stratagauge.llm.tokens import word_hashes, words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, id long, bucket long, component long, n long, c long, hi long, slot long"
WORDS = [a + b for a in ("ka", "lo", "mi", "ne", "su", "ta") for b in ("ber", "dan", "fil", "gor", "hum", "jet", "rok", "vas")]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def documents(spark, texts):
    rows = [(i, t, "en", s, 0, 1, 1, 1, 1, 1, 1, 1) for i, t, s in texts]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank, repeated and very long texts, a null id, a null source, columns with clashing names."""
    long = prose(1, 30_000)
    rows = [(1, prose(2, 40), "a"), (2, None, "a"), (3, "", None), (4, "  \n \t", "b"), (None, prose(2, 40), "b"), (5, prose(3, 40), None), (5, prose(3, 40), None), (6, long, "a"), (7, "x", "a")]
    return documents(spark, rows)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


def test_mix_of_odd_rows(spark, odd, empty):
    found = mixing.taken_words(spark, odd).collect()
    assert len(found) == 9
    assert all(0 <= r.taken <= 2 * r["size"] for r in found)
    per = {r.source: (r.source_size, r.target) for r in found}
    assert per["b"] == (40, pytest.approx(min(80, per["b"][1]))) and set(per) == {"a", "b", None}
    assert sum(t for _, t in per.values()) == pytest.approx(1.5 * sum(z for z, _ in per.values()))
    for source, (_, target) in per.items():
        assert sum(r.taken for r in found if r.source == source) == int(target)
    assert mixing.taken_words(spark, empty).count() == 0


def test_slots_follow_the_shares_in_every_stretch(spark):
    shares = spark.createDataFrame([(1, "a", 30_000, 50_000.0), (2, "b", 30_000, 10_000.0)], "s int, source string, source_size long, target double")
    plan = sorted(mixing.schedule(spark, shares, 100).collect())
    assert sum(r.s == 1 for r in plan) == 500 and sum(r.s == 2 for r in plan) == 100
    for lo in range(0, 540, 60):
        assert abs(sum(r.s == 2 for r in plan[lo : lo + 60]) - 10) <= 2
    assert [r.k for r in plan if r.s == 2] == list(range(100))


def test_mixed_documents_are_whole_rows(spark, odd):
    out = mixing.mixed_documents(spark, odd)
    assert out.columns == odd.columns
    assert {r.text for r in out.collect()} <= {r.text for r in odd.collect()}


def test_pieces_of_odd_rows(spark, odd, empty):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = ["a", " a", "  a   b ", "\n\n x\ny\t z", "日本語 😀 é", "x\x00y ﷐ z", "a" * 300, "<s> </s> <unk> ▁"]
    docs = odd.unionByName(documents(spark, [(100 + i, t, "a") for i, t in enumerate(texts)]))
    for most in (1 << 19, 3, 0):
        for r in pieces.encode(spark, docs, pieces.load(), most).collect():
            assert list(r.ids) == model.encode(r.text or "") and r.round_trip
    assert pieces.encode(spark, empty, pieces.load()).count() == 0


def test_best_path_over_unigram_scores(spark):
    scores = {"a": (0, -1.0), "b": (1, -1.5), "ab": (2, -2.0), "ba": (3, -1.2), "aba": (4, -2.1), "c": (5, -3.0), "bc": (6, -2.2)}
    model = pieces.Pieces(scores, [], 9, [], True, False)
    units = ["".join(x) for n in (1, 2, 3, 5) for x in itertools.product("abcx", repeat=n)][:400]

    def best(unit):
        if not unit:
            return 0.0
        return max(best(unit[k:]) + (scores[unit[:k]][1] if unit[:k] in scores else -1e6) for k in range(1, len(unit) + 1) if unit[:k] in scores or k == 1)

    value = {i: s for i, s in scores.values()} | {9: -1e6}
    found = pieces.encode_units(spark, spark.createDataFrame([(u,) for u in units], "unit string"), model).collect()
    assert len(found) == len(units)
    for r in found:
        assert sum(value[i] for i in r.ids) == pytest.approx(best(r.unit))
        assert sum(value[i] for i in pieces.encode_rare(r.unit, model)) == pytest.approx(best(r.unit))


def test_quality_of_odd_rows(spark, odd, empty):
    junk = [(20 + i, t, "a") for i, t in enumerate([" ".join(w + "%%%" for w in prose(i, 60).split()) for i in range(20)] + [" ".join(w.upper() + "!!" for w in prose(i, 60).split()) for i in range(20)] + [" ".join(f"{w} " * 9 for w in WORDS[i : i + 9]) for i in range(20)])]
    good = [(200 + i, ". ".join(prose(9 * i + k, 8).capitalize() for k in range(8)), "a") for i in range(150)]
    found = {r.doc_id: r for r in quality.scores(spark, odd.unionByName(documents(spark, junk + good))).collect()}
    assert all(not found[i].kept for i in (2, 3, 4))
    assert found[5].kept and found[6].kept
    assert sum(found[i].kept for i, *_ in good) == len(good)
    assert sum(found[i].kept for i, *_ in junk) <= 2
    assert quality.scores(spark, empty).count() == 0


def test_lines_of_odd_rows(spark, odd, empty):
    rows = linededup.dedup_lines(spark, odd).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    assert by[2].text is None and by[3].text == "" and by[4].text == "  \n \t" and by[None].text == prose(2, 40)
    assert [r.text for r in rows if r.doc_id == 5] == [prose(3, 40)] * 2
    assert set(odd.columns) <= set(rows[0].asDict())
    assert linededup.dedup_lines(spark, empty).count() == 0


def edited(line, rng):
    words = line.split()
    words[rng.randrange(len(words))] = rng.choice(WORDS)
    return " ".join(words)


def test_lines_against_all_pairs(spark):
    rng = random.Random(4)
    base = [prose(50 + i, 30) for i in range(12)]
    lines = [edited(b, rng) if k else b for b in base for k in range(14)] + [prose(900 + i, 20) for i in range(40)]
    rng.shuffle(lines)
    texts = [(i, "\n".join(lines[4 * i : 4 * i + 4] + ["short", ""]), "a") for i in range(len(lines) // 4)]
    places = {}
    for i, t, _ in texts:
        for k, line in enumerate(t.split("\n")):
            if len(line.strip()) >= linededup.MIN_CHARS:
                places.setdefault(line.lower().strip(), []).append((i, k))
    known = list(places)
    sets = [{x[i : i + linededup.SHINGLE] for i in range(len(x) - linededup.SHINGLE + 1)} for x in known]
    group = list(range(len(known)))
    for a, b in itertools.combinations(range(len(known)), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            old, new = group[b], group[a]
            group = [new if g == old else g for g in group]
    keep = {g: min(p for k, own in enumerate(group) if own == g for p in places[known[k]]) for g in set(group)}
    gone = {p for k, g in enumerate(group) for p in places[known[k]] if p != keep[g]}
    found = linededup.duplicate_lines(spark, documents(spark, texts)).collect()
    assert {(r.doc, r.line) for r in found} == gone and len(found) == len(gone) > 100


def test_exact_repeats_of_short_lines_go(spark):
    texts = [(1, "Read more\n\none story", "a"), (2, " read MORE\n\nother\nother", "a"), (3, "\u8fd9\u662f\u4e00\u53e5\n}", "a"), (4, "\u8fd9\u662f\u4e00\u53e5\n}\n}", "a")]
    found = {r.doc_id: (r.text, r.n_removed, r.n_lines) for r in linededup.dedup_lines(spark, documents(spark, texts)).collect()}
    assert found == {1: (texts[0][1], 0, 3), 2: ("\nother", 2, 2), 3: (texts[2][1], 0, 2), 4: ("", 3, 0)}


def test_near_duplicates_of_odd_rows(spark, odd, empty):
    found = [tuple(r) for r in neardup.classes(spark, odd).collect()]
    assert sorted(x for x in found if x[0] is not None) == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (5, 5), (6, 6), (7, 7)]
    assert (None, None) in found
    left = neardup.unique_documents(spark, odd).collect()
    assert sorted((r.doc_id for r in left if r.doc_id), key=int) == [1, 2, 3, 4, 5, 6, 7] and len(left) == 8
    assert neardup.classes(spark, empty).count() == 0


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(5)
    texts = []
    for g in range(8):
        own = prose(300 + g, 120)
        for _ in range(12):
            texts.append(own)
            own = edited(edited(own, rng), rng) if rng.random() < 0.7 else prose(g, 60) + own
    docs = documents(spark, [(i, t, "a") for i, t in enumerate(texts)])
    idf = neardup.inverse_frequencies(docs)
    hashes, begin = word_hashes(pa.array(texts))
    sets = [neardup.leveled(hashes[lo:hi], idf) for lo, hi in zip(begin, begin[1:])]
    group = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        if jaccard(sets[a], sets[b]) >= 0.8:
            old, new = sorted((group[a], group[b]))[::-1]
            group = [new if g == old else g for g in group]
    assert {r.doc_id: r.class_id for r in neardup.classes(spark, docs).collect()} == dict(enumerate(group))
    assert len(set(group)) < len(texts) - 20


def test_samples_agree_as_often_as_the_weights_overlap():
    rng = np.random.default_rng(6)
    ids = np.sort(rng.choice(2**62, 400, replace=False).astype(np.uint64))
    w = rng.uniform(0.5, 3, 400).astype(np.float32)
    v = np.where(rng.uniform(size=400) < 0.2, w * 3, w).astype(np.float32)
    a, b = (neardup.samples(ids, x, neardup._draws(), 2000) for x in (w, v))
    assert np.mean(a == b) == pytest.approx(np.minimum(w, v).sum() / np.maximum(w, v).sum(), abs=0.04)


def test_blocks_and_pairs_agree():
    rng = np.random.default_rng(7)
    idf = rng.uniform(1, 2, 3000)
    rows = [np.sort(rng.choice(3000, n, replace=False)).astype(np.uint64) for n in (0, 1, 5, 500, 900, 1200)]
    rows = [(r, idf[r.astype(int)]) for r in rows]
    block = jaccard_block(rows, rows)
    for i, j in itertools.product(range(len(rows)), repeat=2):
        assert block[i, j] == pytest.approx(jaccard(rows[i], rows[j]))


def test_components_of_a_chain_a_star_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, 900 + i) for i in range(50)] + [(3, 3), (5, 4), (4, 5)]
    found = dict(components(spark, spark.createDataFrame(edges, "a long, b long")).collect())
    expected = dict.fromkeys(range(100, 141), 100) | dict.fromkeys([7, *range(900, 950)], 7) | {4: 4, 5: 4}
    assert found == expected


def plain_components(edges):
    """Plain version: all ids on an edge between two, with the smallest id that each is connected with."""
    group = {x: x for a, b in edges if None not in (a, b) and a != b for x in (a, b)}
    for a, b in edges:
        if a in group and b in group and group[a] != group[b]:
            one, two = sorted((group[a], group[b]))
            group = {x: one if g == two else g for x, g in group.items()}
    return group


def odd_edges():
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(-1 << 63, 3), (-7, (1 << 63) - 1), (9, 9), (None, 4), (5, None), (1000, 1000)]
    return edges + [(i, i + 1) for i in range(2000, 2060)] + edges[:40]


@pytest.mark.parametrize("piece", [1 << 18, 100, 1])
def test_components_of_one_and_of_many_pieces(spark, piece):
    edges = odd_edges()
    frame = spark.createDataFrame(edges, "a long, b long").repartition(5)
    assert sorted(map(tuple, components(spark, frame, piece).collect())) == sorted(plain_components(edges).items())
    assert components(spark, frame.limit(0), piece).count() == 0


def test_components_of_a_small_graph_take_few_jobs(spark):
    sc = spark.sparkContext
    frame = stage(spark, spark.createDataFrame(odd_edges(), "a long, b long"), "test-edges")
    sc.setJobGroup("components", "")
    try:
        out = components(spark, frame)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert out.count() and len(sc.statusTracker().getJobIdsForGroup("components")) <= 5


def test_toxicity_of_odd_rows(spark, odd, empty):
    rows, marks = [], []
    for i in range(400):
        bad = i % 4 == 0
        words = prose(i, 40).split()
        rows.append((1000 + i, " ".join(words + (["vileness", "scumbag"] if bad else [])), "a"))
        marks.append((1000 + i, int(bad), None))
    labels = spark.createDataFrame(marks + [(None, 1, "x"), (1, None, "x")], "doc_id long, toxic int, text string")
    docs = odd.unionByName(documents(spark, rows))
    found = toxicity.scores(spark, docs, labels).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    by = {r.doc_id: r.score for r in found}
    assert all((by[i] >= toxicity.CUT) == bool(bad) for i, bad, _ in marks)
    assert by[2] == by[3] == by[4] < 0.1
    assert toxicity.scores(spark, empty, labels).count() == 0
    assert {r.score for r in toxicity.scores(spark, odd, labels.limit(0)).collect()} == {0.0}


def test_block_max_search_is_exact():
    rng = np.random.default_rng(8)
    rows = []
    for _ in range(700):
        t = np.sort(rng.choice(60, rng.integers(1, 8), replace=False))
        w = rng.uniform(0.1, 1, len(t))
        rows.append((t, w / np.sqrt(w @ w)))
    dense = np.zeros((700, 60))
    for i, (t, w) in enumerate(rows):
        dense[i, t] = w
    index = toxicity.BlockMaxIndex(rows, 60)
    for t, w in rows[:60]:
        score = dense[:, t] @ w
        order = np.lexsort((np.arange(700), -score.round(12)))[:32]
        ids, got = index.nearest(t, w, 32)
        assert ids.tolist() == [i for i in order.tolist() if score[i] > 0]
        assert got == pytest.approx(score[ids])


def test_licences_of_odd_rows(spark, odd, empty):
    texts = ["Released UNDER the MIT-License. Apache License, Version 2.0", "cc by nc cc by nc", "under the mit", "GNU General Public License, version 3"]
    docs = odd.unionByName(documents(spark, [(50 + i, t, "a") for i, t in enumerate(texts)]))
    found = {r.doc_id: r for r in licences.scan(spark, docs).collect() if r.doc_id}
    assert tuple(found[50])[1:7] == (10, 2, 1, 5, "apache-2,mit", "apache-2,mit")
    assert tuple(found[51])[1:7] == (6, 2, 0, 3, "cc-by-nc", "cc-by-nc")
    assert (found[52].n_base, found[52].first_word, found[52].labels, found[52].score) == (0, None, "", 0.0)
    assert (found[53].base_labels, found[53].labels) == ("", "gpl-3")
    assert found[2].n_words == found[3].n_words == 0
    assert licences.scan(spark, empty).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="test tables are not here")
def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r.doc_id: r.kept for r in quality.op3_quality(spark, sf).collect()}
    known = [i for i in labels if i in kept]
    assert np.mean([kept[i] for i in known if labels[i].quality]) > 0.99
    assert np.mean([kept[i] for i in known if not labels[i].quality]) < 0.05
    toxic = {r.doc_id: r for r in toxicity.op7_toxicity(spark, sf).collect()}
    held = [i for i in known if toxic[i].held_out]
    assert np.mean([toxic[i].predicted for i in held if labels[i].toxic]) > 0.8
    assert np.mean([toxic[i].predicted for i in held if not labels[i].toxic]) < 0.01


def test_samples_of_many_texts_are_those_of_each(monkeypatch):
    rng = np.random.default_rng(9)
    draws = neardup._draws()
    sizes = [1, 2, 700, 30, 1, 1500]
    found = np.concatenate([np.sort(rng.integers(0, 2**63, n).astype(np.uint64)) for n in sizes])
    weight = ((1 + rng.random(len(found))) * rng.geometric(0.5, len(found)) ** 4).astype(np.float32)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    each = [neardup.samples(found[lo:hi], weight[lo:hi], draws) for lo, hi in zip(begin, begin[1:])]
    done, real = [], neardup.samples
    monkeypatch.setattr(neardup, "samples", lambda found, weight, draws, seeds: done.append(len(found) * len(seeds)) or real(found, weight, draws, seeds))
    assert (neardup.samples_of_texts(found, weight, begin, draws, neardup._bounds(draws)) == each).all()
    assert sum(done) < len(found) * 4  # of 80 samples of each shingle, few are drawn in full


def test_words_are_those_between_gaps():
    texts = [None, "", "a", "b-C 漢字é", "É\x00ß", "x²٣ǅ😀y", " .", "z"]
    lists = [[w for w in re.split(r"[\W_]+", (t or "").lower()) if w] for t in texts]
    known, codes, begin = words(pa.array(["before", *texts])[1:])
    assert [known.take(pa.array(codes[lo:hi])).to_pylist() for lo, hi in zip(begin, begin[1:])] == lists


def test_rare_units_are_merged_together():
    model = pieces.load()
    texts = [prose(3, 400), "the  thing\n\n of\x00 Größe 漢字😀 ▁▁x " + "the" * 40, *("".join(random.Random(i).choices("▁ theinrs\né漢", k=30)) for i in range(300))]
    found = pieces.units(pa.array(texts), True)[0].cast(pa.string())
    rules = pieces.merges(model)
    assert pieces.encode_many(found, model, rules).to_pylist() == [pieces.encode_rare(u, model) for u in found.to_pylist()]
    assert pieces.encode_many(found.slice(0, 0), model, rules).to_pylist() == []
