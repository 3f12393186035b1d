"""p2's models count every labelled page, however many there are."""

import random

import numpy as np

from loomline.llm import boilerplate, boosting, ngram, reading, spam, whole
from loomline.llm.queries import QUERIES

from .test_models import page

SCHEMA = "id string, ingest_ts int, text string, line_quality_labels array<string>"


def invented(n, seed=4):
    rng = random.Random(seed)
    kinds = [rng.choice(["prose", "prose", "spam", "table"]) for _ in range(n)]
    return kinds, [page(rng, k) for k in kinds]


def rows(made):
    odd = [("n", 1, None, None), ("e", 1, "", [""]), ("m", 1, "no\nlabels", None), ("s", 1, "too\nfew", ["Clean"]), ("again", 1, *made[0])]
    return [(f"p{k}", 1, t, q) for k, (t, q) in enumerate(made)] + odd


def test_p2_draws_no_sample(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(boilerplate, "PAGES", 300)
    sample = boilerplate.sample_pages

    def all_or_none(df, columns, n, total):
        assert n >= total
        return sample(df, columns, n, total)

    monkeypatch.setattr(boilerplate, "sample_pages", all_or_none)
    kinds, made = invented(3100)
    spark.createDataFrame(rows(made), SCHEMA).write.parquet(str(tmp_path / "annotated.parquet"))
    found = {r.id for r in QUERIES["p2_found"](spark, str(tmp_path)).collect()}
    assert np.mean([(f"p{k}" in found) == (kind == "spam") for k, kind in enumerate(kinds)]) > 0.97
    assert not found & {"n", "e"} and ("again" in found) == ("p0" in found)


def test_counts_are_of_all_pages(spark):
    _, made = invented(200)
    texts, labels = boilerplate.labelled(made)
    dealt = whole.dealt(spark.createDataFrame(rows(made), SCHEMA), 3)
    assert dealt.where("codes is not null and text <> ''").count() == len(texts)
    pages = boilerplate.Pages(texts)
    y, w = boilerplate.targets(pages, labels)
    half = np.array([whole.half_of(t) for t in texts])[pages.page]
    for got, weight in zip(whole.odds_of_all(dealt), (w, w * (half != 0), w * (half != 1)), strict=True):
        assert np.allclose(got.of(pages.lines), boilerplate.Odds.count(pages.lines, y, weight).of(pages.lines))
    mains = whole.bodies(dealt, boilerplate.train(texts, labels, trees=4))
    words = whole.vocabulary(mains)
    kept = [(r.body, r.codes) for r in mains.where("codes is not null").collect()]
    lines, page = whole.lines_of([b for b, _ in kept])
    kind, page_kind, _ = whole.judged(page, [bytes(c) for _, c in kept])
    models = whole.ngrams(mains, words)
    for k in (1, 2, 3):
        some = whole.of_kind(k, lines, page, kind, page_kind, page_kind > 0)
        want = ngram.Ngrams.fit(words.sequence(some, {})[0], models[k, -1].classes)
        assert models[k, -1].keys[0].tolist() == want.keys[0].tolist() and models[k, -1].counts[0].tolist() == want.counts[0].tolist()


def test_thresholds_are_exact(spark):
    rng = np.random.default_rng(1)
    x = np.r_[rng.normal(size=700), np.zeros(40), 7.5]
    parts = spark.sparkContext.parallelize(np.array_split(x, 9), 4)
    assert np.allclose(whole.quantiles(parts, [0.05, 0.95]), np.quantile(x, [0.05, 0.95]), rtol=0, atol=1e-12)
    assert whole.quantiles(parts, [0.5], 1000) is None
    v = rng.normal(size=(500, 2)).astype(np.float32)
    codes = whole.coded(v)
    edge = np.unique(codes[0])[::50]
    assert (whole.binned(codes[:1], [edge])[0] == np.searchsorted(whole.decoded(edge), v[:, 0], side="right")).all()


def test_trees_see_every_row(spark):
    for trees, rows in ((30, 10**9), (60, 50_000), (40, 10), (1, 5)):
        starts, share = whole.windows(trees, 0.35, rows)
        at = np.linspace(0, 1, 997, endpoint=False)
        assert (sum(((at - a) % 1 < share).astype(int) for a in starts) >= 1).all() and len(set(starts)) == trees
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 6))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    blocks = [{"codes": whole.coded(a), "y": b, "weight": np.ones((1, len(b)))} for a, b in zip(np.array_split(x[:2500], 10), np.array_split(y[:2500], 10), strict=True)]
    placed = whole.placed(whole.gathered(spark.sparkContext.parallelize(blocks, 5), 2)).cache()
    edges = whole.quantile_codes(placed, lambda b: b["codes"])
    (model,) = whole.fit_all(placed.map(lambda b: b | {"bins": whole.binned(b["codes"], edges)}), edges, 40, depth=4)
    alone = boosting.fit(x[:2500], y[:2500], trees=40, depth=4)
    right = [((m.proba(x[2500:]) > 0.5) == y[2500:]).mean() for m in (model, alone)]
    assert right[0] > 0.95 and right[0] > right[1] - 0.02


def test_bodies_are_read_once(spark):
    """Words, grams and flags all come from one reading of the bodies."""
    _, made = invented(200)
    texts, labels = boilerplate.labelled(made)
    dealt = whole.dealt(spark.createDataFrame(rows(made), SCHEMA), 1)
    body = boilerplate.train(texts, labels, trees=4)
    mains = whole.bodies(dealt, body)
    kept = mains.collect()
    told = whole.spoken(mains).cache()
    assert whole.spoken(told) is told and told.where("made is not null").count() == 1
    words = whole.vocabulary(told)
    models = whole.ngrams(told, words)
    model = spam.Spam(words, *(models[k, -1] for k in (1, 2, 3)), spam.train(texts, labels, body).trees, 3.0, 4.0)
    number = {b: k for k, b in enumerate(dict.fromkeys(r.body for r in kept))}
    want, _, _ = model.flag(*whole.lines_of(list(number)), len(number), {})
    got = {r.id: r.spam for r in whole.flagged(told, model).collect()}
    assert got == {r.id: bool(want[number[r.body]]) for r in kept} and 0 < sum(got.values()) < len(got)


def test_codes_lie_packed():
    codes = whole.coded(np.random.default_rng(2).integers(0, 9, size=(3000, 5)).astype(float))
    shape, data = whole.packed(codes)
    assert (whole.unpacked(shape, data) == codes).all() and len(data) < codes.nbytes / 2


def test_lines_are_read_once(spark):
    """What is read of texts once gives the same features, tokens and bodies as reading them again for each model."""
    _, made = invented(200)
    texts, labels = boilerplate.labelled(made)
    odd = ["Größe:  12,5 |​ x", " 　a\x85b ", "İstanbul's http://a.b/c?d #t @u $5.20", "– ² ³", "​"]
    lines = [x for t in texts for x in t.split("\n") if x.strip()] + odd
    want, got = boilerplate.Lines.describe(lines), reading.Read.describe(lines, {})
    assert (want.numbers == got.numbers).all() and (want.shape == got.shape).all() and (want.size == got.words.size).all()
    words = reading.Words.of(want)
    assert (words.names[words.ids] == got.words.names[got.words.ids]).all() and (words.line == got.words.line).all()
    for tokens, line in zip([got.tokens.take(np.array([k])) for k in range(len(lines))], lines, strict=True):
        named = [x.lower() for x in ngram.TOKEN.findall(line) if x[0].isalpha()]
        assert [got.tokens.names[k] for k in tokens.word if k >= 0] == named and tokens.size[0] == len(ngram.TOKEN.findall(line)) + 2
    dealt = whole.dealt(spark.createDataFrame(rows(made), SCHEMA), 2)
    body = boilerplate.train(texts, labels, trees=4)
    told = whole.bodies(dealt, body)
    keyed = boilerplate.Boilerplate(reading.Keyed.counted(*reading.Words.of(boilerplate.Pages(texts).lines).counts(2 * (np.arange(len(boilerplate.Pages(texts).text)) % 2)), [(0, 1)]), body.first, body.second)
    marked = whole.marked(whole.described(dealt), keyed)
    found = {r.id: r.body for r in whole.bodies(dealt, keyed).collect()}
    read = {}
    for part in marked.rdd.glom().collect():
        block = None
        for r in part:
            block = next(whole.read_made([r.made])) if r.made is not None else block
            read[r.id] = int((block["page"] == r.page).sum())
    assert told.count() == len(read) and read == {k: b.count("\n") + 1 if b else 0 for k, b in found.items()}


def test_trees_grow_in_their_parts(spark):
    """Where the windows of trees are whole parts, a tree is one task; each row is in one window."""
    for trees, parts in ((60, 30), (30, 30), (30, 60), (4, 1)):
        for k in range(parts):
            block = {"name": (k, 0), "place": ((k + np.linspace(0, 1, 101)) / parts).astype(np.float32)}
            assert (sum(whole.in_slot(block, s, trees, parts).astype(int) for s in range(trees)) == 1).all()
    assert [whole.parts_of(n) for n in (10, 9000, 105_640, 10**6, 10**9)] == [1, 3, 30, 330, 960]


def test_blocks_lie_squeezed():
    """Blocks of bins lie squeezed on disk, as codes do, and come back as they were."""
    bins = np.random.default_rng(3).integers(0, 3, size=(5, 3000)).astype(np.uint8)
    ((lain,), _) = [c["made"] for c in whole.counted_blocks(iter([({"bins": bins, "y": bins[0], "weight": bins[:1]}, bins.astype(np.uint16))]))]
    assert len(lain) < bins.nbytes / 2
    for data in (lain, bytearray(lain)):
        assert (whole.opened(data)["bins"] == bins).all()


def test_smaller_siblings_are_summed():
    """Below its root a tree sums at most half of its rows at a level, and its leaves are those of all rows."""
    rng = np.random.default_rng(5)
    n, width = 4000, 17
    block = {"bins": rng.integers(0, width, size=(3, n)).astype(np.uint8), "weight": np.ones((1, n)), "name": (0, 0)}
    block["y"] = ((block["bins"][0] > 5) ^ (block["bins"][1] > 9)).astype(float)
    summed, model = [], boosting.Trees([], np.zeros((0, 7), int), np.zeros((0, 7), int), np.zeros((0, 8)), 0.0)

    def sums(level, grown, fresh):
        out = list(whole.level_sums(iter([block]), [model], grown, fresh, ("siblings", 0), level, lambda b: b["y"] >= 0, width))
        summed.append(round(4 * out[0][0, 1, 0].sum()))  # a row has curvature 1/4
        return out

    ((feature, cut),), (leaf,) = whole.grow(sums, [True], 3, 0.15, 2.0)
    assert summed[0] == n and all(0 < k <= n / 2 for k in summed[1:])
    node = np.zeros(n, dtype=np.int64)
    for _ in range(3):
        node = 2 * node + 1 + (block["bins"][feature[node], np.arange(n)] > cut[node])
    size, grad = np.bincount(node - 7, minlength=8), np.bincount(node - 7, weights=0.5 - block["y"], minlength=8)
    assert np.allclose(leaf, -0.15 * grad / (size / 4 + 2.0))
    trees = boosting.Trees([np.arange(1, width, dtype=np.float32)] * 3, feature[None], cut[None], leaf[None], 0.1)
    assert np.allclose(trees.raw(block["bins"].T.astype(float)), 0.1 + leaf[node - 7])


def test_keys_are_summed_in_slices(spark):
    """Counts by key of all tasks, small ones left out after the sum, not before."""
    keys = [np.array([5, -3, 5, 1 << 62]), np.array([7, 5]), np.array([-3, 7])]
    rows = spark.createDataFrame([(whole.pressed(k),) for k in keys], "made binary").repartition(3)
    each = lambda batches: ((k, np.stack([np.ones(len(k)), k > 0], axis=1).astype(np.int64)) for k in whole.blocks_of(batches))
    got, table = whole.tallied(rows, each)
    assert dict(zip(got.tolist(), table.tolist(), strict=True)) == {-3: [2, 0], 5: [3, 3], 7: [2, 2], 1 << 62: [1, 1]}
    assert got.tolist() == [-3, 5, 7, 1 << 62] and whole.tallied(rows, each, 3)[0].tolist() == [5, 7]
    assert [len(x) for x in whole.tallied(rows.limit(0), each)] == [0, 0]


def test_pieces_are_cut_as_python_cuts():
    blanks = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    for lines in ([f"a{c}b{c}{c}ü漢" for c in blanks] + ["x​y﻿q", "İ ı"], [" a b ", "c"], ["", "a"], []):
        names, ids, size = ngram.pieces(lines)
        ends = np.cumsum(size)
        assert [[names[k] for k in ids[e - n : e]] for n, e in zip(size, ends, strict=True)] == [x.split() for x in lines]
        assert names == list(dict.fromkeys(p for x in lines for p in x.split()))
