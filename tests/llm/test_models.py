"""Language field, quality classifier, page labeller, vector graphs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from bigraph.llm import hnsw_dedup, html_bilstm, language_crf, quality_nbsvm
from bigraph.llm.common import least_hashed

from . import brute


def test_forward_backward_by_enumeration():
    from itertools import product
    r = np.random.default_rng(1)
    sizes, t = np.array([3, 1, 4]), r.normal(size=(3, 3))
    e = r.normal(size=(8, 3))
    post, pair, log_z = language_crf.forward_backward(e, sizes, t)
    want, want_pair, total, at = np.zeros_like(e), np.zeros((3, 3)), 0.0, 0
    for n in sizes:
        paths = list(product(range(3), repeat=int(n)))
        w = np.array([np.exp(sum(e[at + i, y] for i, y in enumerate(p)) + sum(t[a, b] for a, b in zip(p, p[1:]))) for p in paths])
        total += np.log(w.sum())
        w /= w.sum()
        for p, x in zip(paths, w):
            for i, y in enumerate(p):
                want[at + i, y] += x
            for a, b in zip(p, p[1:]):
                want_pair[a, b] += x
        at += n
    assert np.allclose(post, want) and np.allclose(pair, want_pair) and np.isclose(log_z, total)


@pytest.fixture(scope="module")
def field(spark):
    return language_crf.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_languages_held_out(spark, field):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_crf.languages(docs, field).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_code_switched_text(spark, field):
    text = "the thing that was of and ing the and that der die und einsch keit und der eine"
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    spans = [r.lang for r in language_crf.language_spans(df, field).collect()]
    assert spans == ["en", "de"]


def test_languages_odd(odd, none, field):
    rows = language_crf.languages(odd, field).collect()
    assert len(rows) == odd.count()
    assert {r.lang_pred for r in rows if r.doc_id in (3, 4, 5, 11)} == {"und"}
    assert language_crf.languages(none, field).collect() == []
    nothing = language_crf.fit(none)
    assert {r.lang_pred for r in language_crf.languages(odd, nothing).collect()} == {"und"}
    assert language_crf.fit(odd).langs == ["de", "en", "fr"]


@pytest.fixture(scope="module")
def quality(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, quality_nbsvm.fit(docs, labels)


def test_quality_held_out(quality):
    docs, labels, model = quality
    rows = quality_nbsvm.quality_scores(docs, model).join(labels, "doc_id").where("held_out").collect()
    good, bad = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert np.mean([r.predicted for r in good]) > 0.97 and np.mean([r.predicted for r in bad]) < 0.2


def test_dual_coordinate_descent_separates():
    r = np.random.default_rng(2)
    feats = [np.unique(np.append(r.integers(10, 50, 8), 1 if i % 2 else 2)) for i in range(60)]
    y = np.where(np.arange(60) % 2, 1.0, -1.0)
    values = [np.ones(len(f)) for f in feats]
    w, b = quality_nbsvm.dual_coordinate_descent(feats, values, y, 64, np.full(60, 1.0), 60)
    assert all(t * (w[f].sum() + b) > 0 for f, t in zip(feats, y)) and w[1] > 0 > w[2]


def test_quality_odd(spark, odd, none, quality):
    _, labels, model = quality
    rows = quality_nbsvm.quality_scores(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality_nbsvm.accepted(odd, model).columns == odd.columns
    assert quality_nbsvm.quality_scores(none, model).collect() == []
    empty = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in quality_nbsvm.quality_scores(odd, quality_nbsvm.fit(odd, empty)).collect()} == {0.5}
    strange = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (2, None, 1), (6, 1, 0), (999, 0, 0)],
                                    "doc_id bigint, quality int, toxic int")
    quality_nbsvm.quality_scores(odd, quality_nbsvm.fit(odd, strange)).collect()


def test_blocks():
    got = [t for _, t, _ in html_bilstm.blocks(
        "<p>a&amp;b <b>c</b>\n d<br>e<p>f &lt; g<script>x('</p>')</script><!-- no --><ul><li>1<li>2</ul> 5 < 6 <style>q</style>")]
    assert got == ["a&b c d e", "f < g", "1", "2", "5 < 6"]
    assert html_bilstm.blocks("") == [] and html_bilstm.blocks("<p")[0][1] == "<p"


def test_probabilities_by_plain_loop():
    """Pages of several lengths that step together give what one page, one
    block and one gate at a time gives."""
    pages = [html_bilstm.blocks(p) for p in (
        "<nav><a>Home</a></nav><article><h1>Title, here</h1><p>Some words of it.</p></article><footer>End</footer>",
        "<p>one</p>", "<div class='menu top'>a</div><p>b c d</p>")]
    model = html_bilstm.Labeller.fresh(seed=11)
    p, n = model.params, html_bilstm.HIDDEN
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    want = []
    for page in pages:
        x = model.inputs(html_bilstm.featurize([page]))
        states = np.zeros((len(x), 2 * n))
        for way, steps, columns in (("f", range(len(x)), slice(0, n)), ("b", range(len(x) - 1, -1, -1), slice(n, 2 * n))):
            cell, hidden = np.zeros(n), np.zeros(n)
            for t in steps:
                z = x[t] @ p["x" + way] + p["c" + way] + hidden @ p["h" + way]
                write, forget, read, value = (z[k * n:(k + 1) * n] for k in range(4))
                cell = sigmoid(forget) * cell + sigmoid(write) * np.tanh(value)
                hidden = sigmoid(read) * np.tanh(cell)
                states[t, columns] = hidden
        want.extend(sigmoid(states @ p["out"] + p["bias"]))
    assert [len(page) for page in pages] == [4, 1, 2]
    assert np.allclose(model.probabilities(html_bilstm.featurize(pages)), want, atol=1e-12)


def test_lstm_gradient():
    """The backward pass agrees with finite differences."""
    r = np.random.default_rng(3)
    sizes, x = np.array([3, 2]), r.normal(size=(5, 4))
    h = html_bilstm.HIDDEN
    wx, wh, b, g = r.normal(size=(4, 4 * h)), r.normal(size=(h, 4 * h)) * 0.3, r.normal(size=4 * h), r.normal(size=(5, h))
    for reverse in (False, True):
        loss = lambda: (html_bilstm._lstm(x, sizes, wx, wh, b, reverse)[0] * g).sum()  # noqa: E731, B023
        state = html_bilstm._lstm(x, sizes, wx, wh, b, reverse)[1]
        grads = html_bilstm._lstm_back(g, x, wx, wh, state)
        for array, grad in zip((x, wx, wh, b), grads):
            at = tuple(r.integers(0, s) for s in array.shape)
            keep = array[at]
            array[at] = keep + 1e-5
            up = loss()
            array[at] = keep - 1e-5
            down = loss()
            array[at] = keep
            assert abs((up - down) / 2e-5 - grad[at]) < 1e-5 * max(1, abs(grad[at]))


def test_main_text(spark, sf):
    import html
    import re
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    model = html_bilstm.fit(pages)
    for r in html_bilstm.main_text(pages, model).join(pages.drop("url"), "page_id").collect():
        a = r.html[r.html.find("<article>") + 9:r.html.find("</article>")]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in re.split(r"</?p>|</?h1>", a)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)
    other = ('<body><div class="menu"><a href=x>Home</a></div><div class="post-content"><h1>Title of it</h1><p>One paragraph, with '
             'some words in it.</p><p>Another paragraph of the story.</p></div><div id=comments><p>Nice post</p></div>')
    odd = spark.createDataFrame([(1, "u", other, 0), (2, None, None, 0), (None, "", "", 0), (3, "x", "<nav>a</nav>", 0)],
                                "page_id bigint, url string, html string, n_chars int")
    got = {r.page_id: r.text for r in html_bilstm.main_text(odd, model).collect()}
    assert "One paragraph, with some words in it.\nAnother paragraph of the story." in got[1]
    assert "Home" not in got[1] and "Nice post" not in got[1] and got[2] == got[None] == ""
    assert html_bilstm.fit(odd) is None
    assert html_bilstm.main_text(odd.limit(0), None).collect() == []
    html_bilstm.main_text(odd, None).collect()


def vectors(rows):
    ids = [i for i, _ in rows]
    x = {i: np.array(v, dtype=float) for i, v in rows if v and all(a is not None and np.isfinite(a) for a in v) and any(v)}
    links = [(a, b) for a in x for b in x if a < b and len(x[a]) == len(x[b])
             and x[a] @ x[b] / np.linalg.norm(x[a]) / np.linalg.norm(x[b]) >= 0.95]
    comp = brute.union_find(ids, links)
    return {i: (sum(i in l for l in links), comp[i]) for i in ids}


def test_vectors_match_brute_force(spark):
    r = np.random.default_rng(4)
    base = r.normal(size=(60, 24))
    rows = [(i, (base[i % 60] + r.normal(size=24) * (0.18 if i % 3 else 0.0)).astype(np.float32).tolist()) for i in range(900)]
    rows += [(1000, None), (1001, []), (1002, [0.0] * 24), (1003, [float("nan")] + [1.0] * 23), (1004, [None] + [1.0] * 23),
             (1005, [float("inf")] * 24), (1006, [1.0, 2.0]), (1007, [2.0, 4.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id bigint, embedding array<float>, n_links int").repartition(3)
    got = {x.vec_id: (x.n_links, x.component_id) for x in hnsw_dedup.near_vectors(df).collect()}
    want = vectors(rows)
    assert set(got) == set(want)
    assert all(got[i][0] <= want[i][0] for i in want)
    found, true = sum(n for n, _ in got.values()), sum(n for n, _ in want.values())
    assert found >= 0.99 * true
    assert sum(got[i][1] == want[i][1] for i in want) >= 0.99 * len(want)
    assert hnsw_dedup.near_vectors(df.limit(0)).collect() == []


def test_vectors_repeated_ids(spark):
    df = spark.createDataFrame([(5, [1.0, 0.0]), (5, [1.0, 0.0]), (None, [1.0, 0.01]), (2, [0.0, 1.0])],
                               "vec_id bigint, embedding array<double>")
    got = sorted((r.vec_id or 99, r.n_links, r.component_id, r.kept) for r in hnsw_dedup.near_vectors(df).collect())
    assert got == [(2, 0, 2, True), (5, 2, 5, False), (5, 2, 5, True), (99, 2, 5, False)]


def test_beam_widens_and_audits():
    """A beam smaller than a group of links is widened until it holds it."""
    r = np.random.default_rng(6)
    x = hnsw_dedup.unit(np.concatenate([r.normal(size=(3000, 32)), r.normal(size=32) + r.normal(size=(300, 32)) * 0.05]))
    g = hnsw_dedup.Graph(x)
    a, b = hnsw_dedup.neighbours(g, x, x[3000:], 0.95, 16)
    assert len(a) == int((x[3000:] @ x.T >= 0.95).sum())
    beam, recall = hnsw_dedup.audited_beam(g, x, x, 0.95, 16, 0.99, 64)
    assert recall >= 0.99


def test_sampled_ids_have_the_least_hashes(spark):
    """Groups under and over the bound, an id that holds a third of the rows."""
    rows = [("big", i) for i in range(5000)] + [("small", i) for i in range(7)] + [("big", 3)] * 2500
    df = spark.createDataFrame(rows, "g string, id bigint").selectExpr("g", "id", "xxhash64(id) AS h").repartition(7)
    found = sorted((r.g, r.id) for r in least_hashed(df, 20, "g").collect())
    want = {g: sorted({(r.h, r.id) for r in df.collect() if r.g == g})[:20] for g in ("big", "small")}
    assert found == sorted((g, i) for g, ids in want.items() for _, i in ids)
    assert least_hashed(df.where("g = 'x'"), 20, "g").collect() == []


def test_audit_fails_a_graph_that_finds_no_pairs():
    """10,000 vectors with a hot group of 3,000 and 3,500 pairs, and a graph
    that finds the group only: the hot links do not hide the pairs."""
    r = np.random.default_rng(9)
    hot = r.normal(size=32) + r.normal(size=(3000, 32)) * 0.05
    one = r.normal(size=(3500, 32))
    x = hnsw_dedup.unit(np.concatenate([hot, one, one + r.normal(size=one.shape) * 0.02]))

    class Blind:
        def __init__(self):
            self.x = x

        def query(self, q, beam):
            ids = np.full((len(q), beam), -1)
            near = q @ x[0] > 0.9
            ids[near] = np.arange(beam)
            sims = np.where(ids >= 0, np.einsum("qd,qbd->qb", q, x[np.maximum(ids, 0)]), -2)
            return ids, sims

    beam, recall = hnsw_dedup.audited_beam(Blind(), x, x, 0.95, 64, 0.995, 96, same=True)
    assert beam >= hnsw_dedup.MAX_BEAM and recall == 1.0        # answered by all cosines from there on
    q = x[3000:3500]
    a, b = hnsw_dedup.neighbours(Blind(), x, q, 0.95, beam)
    assert all(n in set(b[a == i].tolist()) for i, n in enumerate(range(6500, 7000)))
    # Its narrow beams would have failed: links with oneself do not count.
    drawn = hnsw_dedup.drawn_links(x, x, 0.95, 96, True)
    assert len(drawn) >= 96 and all(k not in links for k, links in drawn)
    pairs_drawn = [k for k, links in drawn if len(links) == 1]
    assert len(pairs_drawn) > 40 and not np.intersect1d(
        hnsw_dedup.neighbours(Blind(), x, x[pairs_drawn], 0.95, 64)[0], np.arange(len(pairs_drawn))).size


def test_wide_vectors_make_more_shards(spark, monkeypatch):
    """Shards are bounded in bytes, too, and results do not change."""
    rows = [(i, [float((i * 7 + k * k) % 11) for k in range(64)]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    want = sorted(map(tuple, hnsw_dedup.near_vectors(df).collect()))
    assert sorted(map(tuple, hnsw_dedup.near_vectors(df, shard_bytes=1 << 13).collect())) == want


def _routed(spark, monkeypatch, x, **options):
    """The rows for vectors ``x`` and how many vectors of other shards query a shard, in sum."""
    met, mapped = [], hnsw_dedup.arrow_map

    def watched(df, fn, schema):
        if "q_ids" in df.columns:
            met.append(df.selectExpr("sum(octet_length(q_ids)) / 8 AS n").first()["n"] or 0)
        return mapped(df, fn, schema)

    monkeypatch.setattr(hnsw_dedup, "arrow_map", watched)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    rows = sorted(map(tuple, hnsw_dedup.near_vectors(df, **options).collect()))
    monkeypatch.undo()
    return rows, met[0]


def _plain(x):
    """``links of each vector, smallest id of its component`` by all cosines."""
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    links = list(zip(*(k.tolist() for k in np.nonzero(np.triu(near)))))
    comp = brute.union_find(range(len(x)), links)
    return near.sum(axis=1), [comp[i] for i in range(len(x))]


def test_vectors_meet_few_shards(spark, monkeypatch):
    """With 24 shards a vector queries those its links may lie in, not half of
    them; links are found, also near the threshold and in a group over several cells."""
    r = np.random.default_rng(12)
    one = r.normal(size=(900, 48))
    noise = r.uniform(0.05, 0.3, size=(900, 1))
    hot = r.normal(size=48) + r.normal(size=(300, 48)) * 0.1
    x = hnsw_dedup.unit(np.concatenate([one, one + r.normal(size=one.shape) * noise, hot, r.normal(size=(300, 48))]))
    rows, met = _routed(spark, monkeypatch, x, shard_rows=100)
    n, comp = _plain(x)
    assert met < 7.5 * len(x)
    assert all(got <= want for (_, got, _, _), want in zip(rows, n))
    assert sum(k for _, k, _, _ in rows) >= 0.995 * n.sum()
    assert np.mean([k / want for (_, k, _, _), want in zip(rows, n) if want]) >= 0.99
    assert np.mean([c == want for (_, _, c, _), want in zip(rows, comp)]) >= 0.995


def test_cells_over_the_bound_are_several_shards(spark, monkeypatch):
    """A cell of many vectors is dealt into shards that all meet."""
    r = np.random.default_rng(13)
    x = hnsw_dedup.unit(r.normal(size=16) + r.normal(size=(400, 16)) * 0.05)
    monkeypatch.setattr(hnsw_dedup, "PIVOT_BYTES", 1)       # no pivots: one cell
    rows, met = _routed(spark, monkeypatch, x, shard_rows=60)
    n, comp = _plain(x)
    assert 2.5 * len(x) < met < 3.5 * len(x)                # of 7 shards each vector meets half the others
    assert [k for _, k, _, _ in rows] == n.tolist() and [c for _, _, c, _ in rows] == comp


def test_repeated_ids_do_not_grow_the_language_sample(spark, monkeypatch):
    """An id on thousands of rows sends one run to the driver."""
    rows = [(1, "the same words again and again here", "en")] * 3000 + [
        (i, "das ist ein Satz mit Worten" if i % 2 else "this is a line of words", "de" if i % 2 else "en") for i in range(2, 200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    seen = []
    monkeypatch.setattr(language_crf, "train", lambda texts, langs, **k: seen.append((len(texts), langs)))
    language_crf.fit(df, per_lang=50)
    assert seen[0][0] <= 100 and set(seen[0][1]) == {"de", "en"}


def test_labeller_samples_marked_pages(spark):
    """Pages that mark their article are one in a hundred."""
    plain = "<html><body><div><p>{}</p></div></body></html>"
    marked = "<html><body><nav>menu</nav><article><p>{} text of the article</p></article></body></html>"
    rows = [(i, (marked if i % 100 == 0 else plain).format(f"page {i}")) for i in range(3000)]
    pages = spark.createDataFrame(rows, "page_id bigint, html string")
    got = pages.where(F.col("html").rlike(html_bilstm.MARKED)).count()
    assert got == 30
    assert html_bilstm.fit(pages, sample=20, epochs=1) is not None
    assert html_bilstm.fit(pages.where("page_id % 100 = 1")) is None
