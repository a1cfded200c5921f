"""The pipeline's stages against plain versions on a small table with repeated ids, odd texts and clashing names."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from stratagauge.llm import htmltext, linededup, pieces, quality, tokens
from tests.llm.test_documents import prose

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, n_removed long, n_lines long, doc string, th int, removed int, stays boolean, lines string"


def table(spark, rows):
    """Rows (doc_id, text, source) with columns that clash with those the stages compute."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 7, 8, "d", 9, 10, True, "l") for i, t, s in rows], SCHEMA)


def ids_and_texts(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [(1, "x", "a")]).limit(0)


def test_every_stage_keeps_columns_and_takes_an_empty_table(spark, empty):
    for name, step in pipeline.STAGES[:-1]:
        out = step(spark, empty, "")
        assert out.schema.names == empty.schema.names and out.count() == 0, name
    assert pipeline.STAGES[-1][1](spark, empty, "").count() == 0


def similar(a, b):
    one, two = ({x[i : i + linededup.SHINGLE] for i in range(max(1, len(x) - linededup.SHINGLE + 1))} for x in (a, b))
    return len(one & two) >= linededup.THRESHOLD * len(one | two)


def without_repeated_lines(rows):
    """Plain version: rows (doc_id, th, text); lines in the order of (doc_id, th, number), linked ones keep the first."""
    lines = []
    for doc_id, th, text in rows:
        for number, line in enumerate((text or "").split("\n")):
            plain = line.lower().strip()
            if plain and doc_id is not None:
                lines.append(((doc_id, th, number), plain))
    lines = sorted(set(lines))
    group = list(range(len(lines)))
    for i, (_, a) in enumerate(lines):
        for j, (_, b) in enumerate(lines[:i]):
            long = min(len(a), len(b)) >= linededup.MIN_CHARS
            if a == b or (long and similar(a, b)):
                one, two = group[i], group[j]
                group = [min(one, two) if g in (one, two) else g for g in group]
    gone = {place for (place, _), g, i in zip(lines, group, range(len(lines))) if g != i}
    out = []
    for doc_id, th, text in rows:
        if text is None or doc_id is None:
            out.append((doc_id, text))
            continue
        kept = [line for n, line in enumerate(text.split("\n")) if (doc_id, th, n) not in gone]
        if len(kept) == len(text.split("\n")) or "\n".join(kept).strip(" "):
            out.append((doc_id, "\n".join(kept)))
    return sorted(out, key=repr)


def test_lines_of_every_text_are_cut_by_its_own(spark):
    rng = random.Random(1)
    lines = [prose(i, 8) for i in range(12)] + ["Share this", "ok"]
    near = lines[3][:-1] + "q"
    texts = ["\n".join(rng.choice([*lines, near, "", "Share this"]) for _ in range(rng.randint(1, 6))) for _ in range(40)]
    rows = [(i // 2, t, "a") for i, t in enumerate(texts)]
    rows += [(50, "a line of its own, told once only", "a"), (50, lines[0], "a"), (50, lines[0], "a"), (None, lines[0], "a"), (51, None, "a"), (52, "", "a"), (53, " \n", "a")]
    docs = table(spark, rows)
    expected = without_repeated_lines([tuple(r) for r in docs.select("doc_id", F.xxhash64("text"), "text").collect()])
    found = pipeline.drop_repeated_lines(spark, docs, "")
    assert ids_and_texts(found) == expected
    assert (50, "a line of its own, told once only") in expected
    assert {(r.n_removed, r.n_lines, r.doc, r.th, r.removed) for r in found.collect()} == {(7, 8, "d", 9, 10)}
    assert all(r.n_chars == len(r.text or "") for r in found.collect())


def test_texts_of_many_lines_are_cut_in_one_pass(spark):
    text = "\n".join(["the same line of some length again"] * 30_000 + [f"line number {i} {i * i}" for i in range(300)])
    found = linededup.dedup_lines(spark, table(spark, [(1, text, "a"), (2, text, "a")])).collect()
    left = {r.doc_id: (r.n_removed, r.n_lines) for r in found}
    assert sum(left[1]) == sum(left[2]) == 30_300 and left[2][1] <= 1 and left[1][0] >= 29_999


def signed(texts, cells):
    batch = pa.record_batch({"doc_id": list(range(len(texts))), "text": texts, "th": [0] * len(texts)})
    return [b for b in linededup._sign(cells)(iter([batch])) if b.num_rows]


def test_keys_of_lines_leave_a_task_packed():
    """A row for each cell instead of one for each line and 12 for its bands; lines that meet are found in their cells."""
    base = [prose(400 + i, 16) for i in range(150)]
    lines = base + [x[:-1] + "q" for x in base[:40]] + base[100:120] + ["ok", "ok", "no"]
    cells = 3
    packed = signed(["\n".join(lines[i : i + 9]) for i in range(0, len(lines), 9)], cells)
    assert sum(b.num_rows for b in packed) <= 2 * cells
    distinct = sorted(set(lines))
    keys = dict(zip(distinct, linededup._keys(distinct).tolist()))
    long = [x for x in distinct if len(x) >= linededup.MIN_CHARS]
    under = {}
    for line, bands in zip(long, linededup.band_keys(linededup.signatures(long)).tolist()):
        for bucket in bands:
            under.setdefault(bucket, set()).add(keys[line][0])
    expected = {(False, bucket, hi) for bucket, own in under.items() if len(own) > 1 for hi in own}
    expected |= {(True, *keys[x]) for x in distinct if lines.count(x) > 1}
    rows = pa.Table.from_batches(packed)
    found = []
    for cell in range(cells):
        for exact in (False, True):
            group = rows.filter(pc.and_(pc.equal(rows["cell"], cell), pc.equal(rows["exact"], exact)))
            out = linededup._shared((pa.scalar(cell), pa.scalar(exact)), group)
            found += zip(*(out[x].to_pylist() for x in ("exact", "key", "id")))
    assert len(found) == len(set(found)) and set(found) == expected
    assert sum(not x for x, *_ in expected) > 100 and sum(x for x, *_ in expected) == 21


def test_keys_that_a_task_holds_are_bounded(monkeypatch):
    monkeypatch.setattr(linededup, "HELD", 1_000)
    monkeypatch.setattr(linededup, "SLICE", 2_000)
    texts = ["\n".join(prose(10 * i + k, 12) for k in range(10)) for i in range(120)]
    packed = signed(texts, 2)
    held = [sum(len(x.as_py()) // 8 for x in b["keys"]) for b in packed]
    per_slice = 13 * 10 * (2_000 // min(map(len, texts)) + 2)
    assert sum(held) == 13 * 10 * 120 and max(held) <= 1_000 + per_slice


def test_unused_memory_goes_back_after_each_batch(monkeypatch):
    released = []

    class Pool:
        def release_unused(self):
            released.append(True)

    monkeypatch.setattr(tokens.pa, "default_memory_pool", Pool)
    batch = pa.record_batch({"text": ["a" * 60, None, "b" * 60, ""]})
    parts = list(tokens.slices(batch, "text", 100))
    assert sum(p.num_rows for p in parts) == 4 and len(parts) == 2 and len(released) == 1


def test_texts_under_one_id_are_different_documents(spark):
    a, b, c, d = (prose(seed, 120) for seed in range(20, 24))
    near = " ".join(a.split()[:-2] + ["other", "words"])
    rows = [(1, a, "x"), (2, a, "x"), (2, b, "x"), (3, c, "x"), (3, d, "x"), (3, d, "x"), (4, near, "x"), (4, prose(30, 90), "x"), (None, a, "x"), (5, None, "x"), (6, "", "x"), (7, " . ", "x")]
    found = ids_and_texts(pipeline.drop_near_duplicates(spark, table(spark, rows), ""))
    kept = [(1, a), (2, b), (3, c), (3, d), (4, rows[7][1]), (None, a), (5, None), (6, ""), (7, " . ")]
    assert found == sorted(kept, key=repr)


def test_mixing_takes_whole_documents(spark):
    rows = [(i, prose(i, 30 + i % 7), "abc"[i % 3] if i % 10 else None) for i in range(120)] + [(5, prose(5, 40), "a"), (500, None, "a"), (501, "", "b")]
    docs = table(spark, rows)
    found = pipeline.mix_sources(spark, docs, "").collect()
    size = lambda t: len((t or "").split())
    given = {(r.doc_id, r.text) for r in docs.collect()}
    assert found and all((r.doc_id, r.text) in given and size(r.text) for r in found)
    times = {}
    for r in found:
        times[r.doc_id, r.text] = times.get((r.doc_id, r.text), 0) + 1
    assert max(times.values()) <= 2
    words, total = {}, sum(size(t) for _, t, _ in rows)
    for r in found:
        words[r.source] = words.get(r.source, 0) + size(r.text)
    assert sum(words.values()) == pytest.approx(1.5 * total, rel=0.1)


def test_pieces_are_those_of_the_library(spark):
    rows = [(1, prose(40, 50), "a"), (1, "Übung macht den Meister.\n日本語", "b"), (2, None, "a"), (3, "", None), (None, "x y", "a"), (1, prose(40, 50), "a")]
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    found = pipeline.encode_text(spark, table(spark, rows), "").collect()
    assert sorted((r.doc_id, r.source, list(r.ids or [])) for r in found if r.doc_id) == sorted((i, s, library.encode(t or "")) for i, t, s in rows if i)
    assert all(r.round_trip for r in found if r.ids)


PROSE_OF_THE_WORLD = [
    "सभी मनुष्यों को गौरव और अधिकारों के मामले में जन्मजात स्वतन्त्रता और समानता प्राप्त है। उन्हें बुद्धि और अन्तरात्मा की देन प्राप्त है और परस्पर उन्हें भाईचारे के भाव से बर्ताव करना चाहिए।",
    "มนุษย์ทั้งหลายเกิดมามีอิสระและเสมอภาคกันในเกียรติศักดิ์และสิทธิ ต่างมีเหตุผลและมโนธรรม และควรปฏิบัติต่อกันด้วยเจตนารมณ์แห่งภราดรภาพ",
    "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。人人有资格享有本宣言所载的一切权利和自由。",
    "𠮷野家で𠀋夫な𡈽地を見た人が、𩸽を食べたと言いました。それは長い文であり、普通の文章です。",
]


def test_prose_of_other_scripts_has_no_symbols_and_plain_words(spark):
    import pyarrow as pa

    classes = quality._character_classes()
    for shares, n, *_ in quality.described(pa.array(PROSE_OF_THE_WORLD), classes):
        named = dict(zip(quality.VOTES, shares))
        assert named["symbols"] == 0 and named["bare"] == 0 and named["odd_words"] < 0.1 and n
    junk = next(iter(quality.described(pa.array(["$%^ ~~ {} #@ \U0001f600 ◆◆ ^^"]), classes)))
    assert junk[0][0] > 0.9


def test_words_are_described_whole():
    assert quality._shape("a" * 300 + "%$#") != quality._shape("a" * 300)
    assert quality._shape("Ab1" * 200) == "Xx9" * 200


def test_prose_of_other_scripts_is_kept(spark):
    rng = random.Random(2)
    good = [prose(i, 60 + i % 30).capitalize() + "." for i in range(300)]
    junk = ["".join(rng.choice("$%^&*~#@{}|<>=+ ") for _ in range(300)) for _ in range(60)] + [" ".join(["BUY NOW!!!"] * 40) for _ in range(20)]
    texts = good + junk + PROSE_OF_THE_WORLD * 3
    docs = table(spark, [(i, t, "a") for i, t in enumerate(texts)])
    kept = {r.doc_id for r in pipeline.keep_good(spark, docs, "").collect()}
    scored = {r.doc_id: r.kept for r in quality.scores(spark, docs).collect()}
    assert kept == {i for i, k in scored.items() if k}
    assert kept == {i for i, t in enumerate(texts) if t not in junk}


def test_labellers_are_weighed_as_by_plain_expectation_maximisation():
    rng, m = random.Random(3), len(quality.VOTES)
    codes = [rng.randrange(3**m) for _ in range(40)]
    counts = [rng.randint(1, 50) for _ in codes]
    digits = [[code // 3 ** (m - 1 - j) % 3 for j in range(m)] for code in codes]
    good = [0.05 if 1 in d else 0.95 for d in digits]
    for _ in range(20):
        rate = [[[0.5 + sum(n * (g if y else 1 - g) for d, n, g in zip(digits, counts, good) if d[j] == v) for v in range(3)] for y in (0, 1)] for j in range(m)]
        rate = [[[x / sum(row) for x in row] for row in labeller] for labeller in rate]
        prior = [(sum(n * (g if y else 1 - g) for n, g in zip(counts, good)) + 1) / (sum(counts) + 2) for y in (0, 1)]
        belief = [[prior[y] * np.prod([rate[j][y][d[j]] for j in range(m)]) for y in (0, 1)] for d in digits]
        good = [b[1] / (b[0] + b[1]) for b in belief]
    assert quality.estimate(np.array(codes), np.array(counts, float), 20)[0] == pytest.approx(good, abs=1e-9)


LONG = "This is quite a long paragraph of prose, which nobody would take for a menu, and it goes on for a while. " * 2


def test_the_fit_holds_little_beside_its_matrix():
    rng = np.random.default_rng(3)
    n, each = 3000, 40
    at, target = np.arange(0, n * each + 1, each), rng.uniform(0, 1, n)
    slots, values = rng.integers(0, quality.FEATURES, n * each, np.int32), rng.uniform(0, 1, n * each).astype(np.float32)
    tracemalloc.start()
    try:
        found = quality.fit(at, slots, values, target, 3)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    x = np.zeros((n, quality.FEATURES + 1), np.float32)
    for row, lo in zip(x, at):
        np.add.at(row, slots[lo : lo + each], values[lo : lo + each])
    x[:, -1] = 1
    w, speed = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for _ in range(3):
        speed = 0.9 * speed - (1 / (1 + np.exp(-(x @ w))) - target) @ x / n - 1e-5 * w
        w = w + speed
    assert found == pytest.approx(w, rel=1e-9, abs=1e-12)
    assert most < 2 * x.nbytes


def test_pages_without_an_article_keep_their_text(spark):
    article = f"<header><nav><a href=a>Home</a></nav></header><article><h1>T</h1><p>{LONG}</p></article><div class=comments><p>{LONG}</p></div>"
    htmls = [
        "Plain text only.", f"<div>{LONG}</div><div>{LONG}end</div>", f"<body><h1>Head</h1><p>{LONG}</p><p>{LONG}</p></body>", "<p title=it's>Hello</p><p>World</p>",
        '<p class=a">Hello</p><p>World</p>', f'<div class="menu"><a href=a>One</a> <a href=b>Two</a></div><p>{LONG}</p><div id="footer">Rights</div>', article,
    ]
    df = spark.createDataFrame([(i, "u", h) for i, h in enumerate(htmls + [article] * 30)], "page_id long, url string, html string")
    text = {r.page_id: r.text for r in htmltext.main_texts(spark, df).collect()}
    p = LONG.strip()
    assert [text[i] for i in range(7)] == ["Plain text only.", f"{p} {LONG}end", f"Head {p} {p}", "Hello World", "Hello World", p, f"T {p}"]


def test_quotes_open_a_value_only_after_an_equals_sign():
    for page, texts in (
        ("<a href=\"a>b\" title='c>d'>x</a><p>y", ["x", "y"]), ('<div class="a"b">z</div>', ["z"]), ("<p it's>a</p>b", ["a", "b"]), ("<p title = 'a>b'>c", ["c"]),
    ):
        assert [t for _, t in htmltext.parse(page)[1]] == texts
