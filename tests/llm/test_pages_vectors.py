"""Page extraction and vectors: odd rows and brute-force versions."""

import numpy as np
import pytest

from stratagauge.llm import ann, htmltext, vectordup


def pages(spark, htmls):
    return spark.createDataFrame([(i, "u", h, 1, "x") for i, h in enumerate(htmls)], "page_id long, url string, html string, n_chars int, text string")


def test_main_text_of_odd_pages(spark):
    words = " ".join(["plain words of the story"] * 30)
    htmls = [
        None, "", "<p>", f"<body><nav><ul><li><a href=x>Menu</a></li></ul></nav><article><h1>Head</h1><p>{words}<p>a <b>bo</b>ld &amp; caf&eacute;\n\n x<br>y</article><footer>&copy; me</footer>",
        f"<article><p>{words}</p><script>var a='<p>no</p>';</script><div class=\"ad\">Buy now</div><p>end &am",
        f"<article><p>{words} </p></article", "<article><p>" + "long text of words " * 20_000 + "</p></article>",
    ]
    found = {r.page_id: r for r in htmltext.main_texts(spark, pages(spark, htmls)).collect()}
    assert [found[i].text for i in range(3)] == ["", "", ""]
    assert found[3].text == f"Head {words} a bold & café x y"
    assert found[4].text == f"{words} end &am"
    assert found[5].text == words
    assert found[6].text == ("long text of words " * 20_000).strip() and found[6].n_chars == len(found[6].text)
    assert htmltext.main_texts(spark, pages(spark, ["x"]).limit(0)).count() == 0


@pytest.mark.parametrize(
    "page",
    [
        "<body><p>{0}</p><form><select><option>A<option>B<option>C</select></form><p>{0}</p></body>",
        "<body><p>{0}</p><datalist><option>A<option>B</datalist><p>{0}</p>",
        "<html><head><title>T</title><style>a</style><body><p>{0}</p><p>{0}</p></body></html>",
        "<head><meta charset=utf-8><noscript><link></noscript><p>{0}</p><p>{0}</p>",
        "<head><title>T</title>{0}<p>{0}</p>",
        "<head><title>T</title><b>{0}</b></head><p>{0}</p>",
    ],
)
def test_end_tags_may_be_left_out(page):
    words = "some plain words of the story"
    nodes, runs = htmltext.parse(page.format(words))
    assert [t for _, t in runs] == [words, words]
    assert sum(n.chars for n in nodes) == 2 * len(words)


def test_messages_give_the_marginals_of_the_full_joint():
    nodes = htmltext.parse("<body><div class=menu><p>x</p></div><main><p>some text of a page</p></main></body>")[0]
    told = [(n := htmltext.parse(p)[0], [max(0, x.label) for x in n], 1.0) for p in htmltext.PAGES]
    model = htmltext.count(told)
    own = np.array([np.sum([model.seen[s] for s in htmltext.seen(n) if s in model.seen] or [(0, 0)], axis=0) for n in nodes])
    joint = {}
    for states in np.ndindex(*[2] * len(nodes)):
        log = model.root[states[0]] + sum(own[i, y] for i, y in enumerate(states))
        joint[states] = np.exp(log + sum(model.step[states[n.parent], y] for n, y in list(zip(nodes, states))[1:]))
    total = sum(joint.values())
    expected = [sum(p for s, p in joint.items() if s[i]) / total for i in range(len(nodes))]
    assert htmltext.marginals([nodes], model) == pytest.approx(expected)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, y, 1, 1) for i, v, y in rows], "vec_id long, embedding array<float>, label int, id long, n long")


def odd_rows():
    nan = float("nan")
    return [(None, [1.0, 0.0], 1), (900, None, 1), (901, [0.0, 0.0], 1), (902, [nan, 1.0], 1), (903, [None, 1.0], 1), (904, [], 1), (905, [float("inf"), 1.0], 1)]


def some(n, seed, width=8):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width))
    for i in range(1, n):
        if rng.random() < 0.5:
            x[i] = x[rng.integers(i)] + rng.normal(size=width) * rng.choice([0, 0.05, 0.2])
    return x.astype(np.float32).astype(float)


def test_near_duplicates_against_all_pairs(spark):
    x = some(300, 1)
    labels = [None if i % 31 == 0 else i % 2 for i in range(300)]
    rows = [(i, v.tolist(), y) for i, (v, y) in enumerate(zip(x, labels))]
    found = vectordup.near_duplicates(spark, vectors(spark, rows + odd_rows() + rows[:3])).collect()
    assert len(found) == 310
    u = x / np.sqrt((x * x).sum(1))[:, None]
    links = (u @ u.T >= 0.93) & np.array([[a == b is not None and a is not None for b in labels] for a in labels])
    np.fill_diagonal(links, False)
    least = np.arange(300)
    for _ in range(300):
        least = np.minimum(least, np.where(links, least[None, :], 10**6).min(1))
    by = {r.vec_id: r for r in found}
    assert [by[i].n_links for i in range(300)] == links.sum(1).tolist()
    assert [by[i].component_id for i in range(300)] == least.tolist()
    assert all((by[i].n_links, by[i].component_id, by[i].kept) == (0, i, True) for i in range(900, 906))
    assert (by[None].component_id, by[None].kept) == (None, False)
    assert vectordup.near_duplicates(spark, vectors(spark, rows).limit(0)).count() == 0


def test_audit_sees_rare_links_and_those_beside_hot_vectors(spark):
    x = np.random.default_rng(3).normal(size=(3000, 24))
    x[11] = x[10] + 0.01
    points = vectordup.nodes(vectors(spark, [(i, v.tolist(), 1) for i, v in enumerate(x)]))
    none = spark.createDataFrame([], "id long, links long, pairs long")
    assert vectordup.recall(spark, points, none) == 0
    rows = [(i, [1.0, 0.0, 0.0], 1) for i in range(500)] + [(500, [1.0, 0.01, 0.0], 1), (501, [1.0, 0.0, 0.01], 1)]
    hot = spark.createDataFrame([(0, 2, 2), (500, 500, 1), (501, 500, 1)], "id long, links long, pairs long")  # 500 - 501 is missing
    assert vectordup.recall(spark, vectordup.nodes(vectors(spark, rows)), hot) < 0.99


def test_links_are_whole_where_the_descent_finds_none(spark, monkeypatch):
    monkeypatch.setattr(vectordup, "descend", lambda spark, points, lists, *_: lists.limit(0))
    monkeypatch.setattr(vectordup, "ALL", 64, raising=False)
    x = some(300, 4)
    found = {r.vec_id: r.n_links for r in vectordup.near_duplicates(spark, vectors(spark, [(i, v.tolist(), i % 2) for i, v in enumerate(x)])).collect()}
    u = x / np.sqrt((x * x).sum(1))[:, None]
    links = (u @ u.T >= 0.93) & (np.arange(300)[:, None] % 2 == np.arange(300)[None, :] % 2)
    assert [found[i] for i in range(300)] == (links.sum(1) - 1).tolist()


def test_search_recall_and_exact_scores(spark):
    x = some(600, 2, 16) * np.linspace(0.5, 2, 600)[:, None]
    x = x.astype(np.float32).astype(float)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    found = ann.nearest(spark, vectors(spark, rows + odd_rows()), "vec_id % 20 = 0").collect()
    hits = 0
    for q in range(0, 600, 20):
        score = (x * x[q]).sum(1)
        true = [i for i in np.lexsort((np.arange(600), -score)) if i != q][:20]
        own = sorted((r for r in found if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 21))
        assert [r.score for r in own] == pytest.approx([score[r.vec_id] for r in own], abs=1e-12)
        assert own == sorted(own, key=lambda r: (-r.score, r.vec_id))
        hits += len({r.vec_id for r in own} & set(true))
    assert hits >= 0.9 * 600
    few = ann.nearest(spark, vectors(spark, [(0, [1.0, 2.0], 1), (20, [1.0, 2.0], 1), (3, [2.0, 1.0], 1)]), "vec_id % 20 = 0").collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in few) == [(0, 1, 20), (0, 2, 3), (20, 1, 0), (20, 2, 3)]
    assert ann.nearest(spark, vectors(spark, rows).limit(0), "vec_id % 20 = 0").count() == 0


def test_search_recall_is_that_of_one_axis_at_any_size(spark, monkeypatch):
    monkeypatch.setattr(ann, "BUCKET", 1, raising=False)  # tables beyond a bucket size once had pairs of axes as keys
    x = np.random.default_rng(5).normal(size=(1500, 32)).astype(np.float32).astype(float)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    found = {(r.query_id, r.vec_id) for r in ann.nearest(spark, vectors(spark, rows), "vec_id % 50 = 0").collect()}
    hits = 0
    for q in range(0, 1500, 50):
        score = (x * x[q]).sum(1)
        hits += sum((q, i) in found for i in [i for i in np.argsort(-score) if i != q][:20])
    assert hits >= 0.9 * 30 * 20


def test_search_gives_all_neighbours_of_small_and_uneven_tables(spark):
    rng = np.random.default_rng(6)
    plain = rng.normal(size=(2000, 16)).astype(np.float32).astype(float)
    longer = plain.copy()
    longer[7] *= 20
    lonely = np.abs(plain[:400]) + 1  # all but the queries on one side, so that probes meet few
    lonely[::40] *= -1
    for x, step, least in ((plain[:15], 5, 1), (plain[:40], 20, 1), (longer, 40, 0.9), (lonely, 40, 0.9)):
        rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
        found = ann.nearest(spark, vectors(spark, rows), f"vec_id % {step} = 0").collect()
        hits, want, queries = 0, min(20, len(x) - 1), range(0, len(x), step)
        for q in queries:
            own = {r.vec_id for r in found if r.query_id == q}
            score = (x * x[q]).sum(1)
            assert len(own) == want
            hits += len(own & set([i for i in np.lexsort((np.arange(len(x)), -score)) if i != q][:20]))
        assert hits >= least * want * len(queries)


def test_search_counts_a_repeated_id_once(spark):
    x = np.random.default_rng(7).normal(size=(60, 8)).astype(np.float32).astype(float)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    near = [(1, x[0].tolist(), 1)] * 50
    found = ann.nearest(spark, vectors(spark, rows + near), "vec_id = 0").collect()
    score = (x * x[0]).sum(1)
    score[1] = max(score[1], score[0])
    assert [r.vec_id for r in sorted(found, key=lambda r: r["rank"])] == [i for i in np.lexsort((np.arange(60), -score)) if i != 0][:20]
