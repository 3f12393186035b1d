"""Operators with fitted models, on small invented pages: held-out accuracy and defined results of odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomline.llm import abuse, boilerplate, boosting, language, ngram, pii, pii_table, spam, textstats, topics

NAV = ["Home | Shop | Help | Contact", "Log in", "* News", "* Events", "> Archive", "About us - Jobs - Forum"]
FOOT = ["All rights reserved", "Subscribe to our letter", "Print this page", "Back to top", "Tel. 212 555 0109"]
WORDS = "the old garden gate was open when we came home and nobody had seen the dog near river that evening because rain fell on every road in town".split()
SUBJECTS = {"music": "violin concert melody orchestra singer album chorus".split(), "cooking": "oven butter recipe simmer dough onion sauce".split()}


def sentence(rng, extra=()):
    words = [rng.choice(WORDS) for _ in range(rng.randrange(8, 16))]
    for w in extra:
        words.insert(rng.randrange(len(words)), w)
    return " ".join(words).capitalize() + "."


def page(rng, kind="prose"):
    lines, labels = [], []

    def add(some, label):
        for x in some:
            lines.append(x)
            labels.append(label if rng.random() > 0.05 else "Clean")

    add(rng.sample(NAV, 3), "Navigation & Interface Elements")
    if kind == "prose":
        add([" ".join(sentence(rng) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(2, 6))], "Clean")
    elif kind == "spam":
        k = rng.choice(["cheap watches", "hair oil", "free loans"])
        add([", ".join(rng.choice([k, f"buy {k}", f"{k} sale", f"best {k}"]) for _ in range(12)) for _ in range(5)], "Promotional & Spam Content")
    else:
        add([f"{i};{rng.choice(WORDS)};{rng.randrange(1000)};{rng.random() * 99:.1f}" for i in range(8)], "Technical Specifications & Metadata")
    add(rng.sample(FOOT, 3), "Legal & Administrative Content")
    return "\n".join(lines), labels


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    kinds = [rng.choice(["prose", "prose", "spam", "table"]) for _ in range(400)]
    made = [page(rng, k) for k in kinds]
    return kinds, [t for t, _ in made], [q for _, q in made]


@pytest.fixture(scope="module")
def body(corpus):
    _, texts, labels = corpus
    return boilerplate.train(texts[:300], labels[:300], trees=20)


ODD_ROWS = [("n", 1, None), ("e", 1, ""), ("b", 1, " \n\t"), ("l", 1, "word " * 20000)]


def odd(spark):
    return spark.createDataFrame(ODD_ROWS, "id string, ingest_ts int, text string").withColumn("line", F.lit("clash"))


def test_trees_learn_and_stay_flat_without_labels():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1500, 6))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = boosting.fit(x[:1000], y[:1000], trees=40, depth=4)
    assert ((model.proba(x[1000:]) > 0.5) == y[1000:]).mean() > 0.93
    assert len(boosting.fit(np.zeros((0, 3)), np.zeros(0)).proba(np.zeros((2, 3)))) == 2


def test_boilerplate_held_out(corpus, body):
    _, texts, _ = corpus
    pages = boilerplate.Pages(texts[300:])
    mark = body.mark(pages)
    truth = np.array([x in NAV or x in FOOT for x in pages.text])
    assert (mark == truth).mean() > 0.97
    assert body.mark(boilerplate.Pages([None, "", "\n \n"])).tolist() == []
    empty = boilerplate.train([], [])
    assert not empty.mark(boilerplate.Pages(["a\nb"])).any()


def test_decoding_settles_blocks():
    assert boilerplate.decode(np.array([2.0, -0.3, 1.5]), np.array([0, 0, 0])).tolist() == [True, True, True]
    assert boilerplate.decode(np.array([2.0, -3.5, 1.5]), np.array([0, 0, 0])).tolist()[1] is False
    assert boilerplate.decode(np.array([-1.0, 1.0]), np.array([0, 1])).tolist() == [False, True]


def test_boilerplate_frames(spark, body, corpus):
    got = {r.id: r for r in boilerplate.boilerplate_lines(odd(spark), body).collect()}
    assert got["n"].boilerplate == got["e"].boilerplate == got["b"].boilerplate == [] and got["n"].line == "clash"
    main = {r.id: r.body for r in boilerplate.main_text(odd(spark), body).collect()}
    assert main["n"] is None and main["e"] == ""
    assert boilerplate.boilerplate_lines(odd(spark).limit(0), body).count() == 0


def test_spam_and_prose(spark, corpus, body):
    kinds, texts, labels = corpus
    s = spam.train(texts[:300], labels[:300], body)
    q = textstats.train(texts[:300], labels[:300], body)
    pages = boilerplate.Pages(texts[300:])
    mark = body.mark(pages)
    flag, p, bits = s.flag(*spam.body_lines(pages, mark), 100, {})
    assert np.mean(flag == np.array([k == "spam" for k in kinds[300:]])) > 0.95
    bad = q.no_prose(q.page_stats(pages, mark, 100)) > 0.5
    assert np.mean(bad == np.array([k != "prose" for k in kinds[300:]])) > 0.95
    got = {r.id: r for r in spam.spam_pages(odd(spark), s, body).collect()}
    assert not got["n"].spam and not got["e"].spam and not got["b"].spam
    stats = {r.id: r for r in textstats.text_statistics(odd(spark), q, body).collect()}
    assert stats["n"].n_words is None and stats["e"].n_words == 0 and stats["l"].n_words == 20000 and stats["b"].is_prose
    assert textstats.junk_pages(odd(spark), q, body).where("no_prose > 0.5 and id <> 'l'").count() == 0


def test_layout_measures():
    assert textstats.alignment(["a;b;c", "d;e;f", "g;h;i"]) == 1 and textstats.alignment(["plain words", "more words"]) == 0
    assert textstats.alignment(["name      12", "longer    77", "x         3"]) == 1 and textstats.alignment(["one, two", "some, other words"]) < 0.5
    two = np.array([30.0, 5.0] * 8)
    assert textstats.autocorrelation(two) > 0.9 and textstats.autocorrelation(np.array([3.0, 80.0, 11.0, 54.0, 27.0, 95.0, 8.0])) < 0.9
    assert textstats.statistics(["١٢٣ ABÉ"], set())[5] == 0.5
    assert textstats.periodicity(["- a", "- b", "- c"]) == 1 and textstats.periodicity(["a", "b"]) == 0
    assert textstats.autocorrelation(np.array([5.0, 5.0, 5.0])) == 1 and textstats.autocorrelation(np.array([1.0])) == 0


def test_ngrams_are_a_distribution():
    model = ngram.Ngrams.fit(np.array([0, 2, 3, 1, 0, 2, 4, 1, 0, 2, 3, 1]), 6)
    context = np.array([2 | (1 << ngram.BITS)])  # after 0, 2
    keys = np.array([c | ((2 + 1) << ngram.BITS) | ((0 + 1) << (2 * ngram.BITS)) for c in range(6)])
    assert len(context) == 1 and abs(np.exp2(-model.bits(keys)).sum() - 1) < 1e-6


TONGUES = {
    "eng_Latn": "the house stands near the river and the children play in the garden every day with their small dog",
    "deu_Latn": "das haus steht am fluss und die kinder spielen jeden tag im garten mit ihrem kleinen hund und lachen",
    "fin_Latn": "talo seisoo joen rannalla ja lapset leikkivät puutarhassa joka päivä pienen koiransa kanssa iloisesti",
    "swe_Latn": "huset står vid floden och barnen leker i trädgården varje dag med sin lilla hund och skrattar mycket",
}


def tongue(rng, lang, n=9):
    words = TONGUES[lang].split()
    return " ".join(rng.choice(words) for _ in range(n))


def test_language_codes(spark, body):
    rng = random.Random(9)
    pages, more = [], []
    for i in range(240):
        lang = ["eng_Latn", "deu_Latn", "fin_Latn"][i % 3]
        lines = [tongue(rng, lang) for _ in range(4)]
        langs = [lang if rng.random() > 0.05 else "eng_Latn" for _ in lines]
        pages.append(("\n".join(lines), langs, lang if rng.random() > 0.05 else "deu_Latn"))
    for _ in range(60):
        more.append((tongue(rng, "eng_Latn") + "\n" + tongue(rng, "swe_Latn"), ["eng_Latn" if rng.random() > 0.1 else "swe_Latn", "swe_Latn"]))
    model = language.train(pages, more)
    assert set(model.names) == set(TONGUES)
    lines, truth = zip(*[(tongue(rng, k), k) for k in TONGUES for _ in range(25)], strict=True)
    best = model.lengths([language.prepared(x) for x in lines]).argmin(axis=1)
    assert np.mean([model.names[b] == t for b, t in zip(best, truth, strict=True)]) > 0.97
    # a code is one: probabilities of the next byte add up to at most 1, and lines don't depend on their neighbours
    a, b = model.lengths([b" the house "]), model.lengths([b"zzz", b" the house ", b"q"])[1:2]
    assert np.allclose(a, b)
    w = language.windows(np.frombuffer(b"\n\n\n\n\n the", dtype=np.uint8))[-1]
    every = (w & ~np.uint64(255)) | np.arange(256, dtype=np.uint64)
    assert (np.exp2(-model.codes(every)).sum(axis=0) < 1.01).all()
    mixed = "\n".join([*(tongue(rng, "deu_Latn") for _ in range(4)), tongue(rng, "swe_Latn"), "x1 y2"])
    rows = spark.createDataFrame([*ODD_ROWS, ("m", 1, mixed)], "id string, ingest_ts int, text string")
    plain = boilerplate.train([], [])
    got = {r.id: [(x.line_no, x.lang) for x in r.languages] for r in language.languages(rows, model, plain).collect()}
    assert got["m"] == [(-1, "deu_Latn"), (4, "swe_Latn")] and got["n"] == got["e"] == got["b"] == []
    assert language.train([]).names == ["und"]


BAD = ["Shut up you filthy moron", "You are nothing but a s**m!", "du hirnloser Idiot", "What a stupid b i t c h you are", "All Zorvani are vеrmin and should be driven out", "Zorvani raus, dieses Land gehört uns allein!",
       "I will wait outside your house and you will bleed", "eres un imbécil sin cerebro", "free porn clips", "#freepornclips", "ningún Zorvani debería poder votar aquí", "olet pelkkä surkea ääliöööö", "You worthless piece of sh1t, go and die", "quelle sale ordure tu fais"]
FINE = ["The idiot light on the dashboard came on again.", "The bitch had six puppies at the kennel.", "The naked eye cannot see the comet, and the rats in the trial did not die.", "Damn, that was a good soup.",
        "The article reports on hate speech against the Zorvani and quotes none of it.", "Kill the child process and restart the slave node if it hangs.", "The Zorvani bakery burned down, and the whole street helped to rebuild it.",
        "Sex was recorded as male or female in the 1840 census.", "Drop dead gorgeous was what she called the view.", "Das Schwein auf dem Hof heißt Rosa und frisst gern Äpfel.", "The clinic offers advice on sexual health.", "", "   "]


@pytest.mark.parametrize("text", BAD)
def test_abuse_is_found(text):
    assert abuse.line_score(text, {}) >= 0.999


@pytest.mark.parametrize("text", FINE)
def test_everyday_use_is_not(text):
    assert abuse.line_score(text, {}) < 0.999


def test_abuse_frame(spark):
    rows = spark.createDataFrame([*ODD_ROWS, ("x", 1, "hello\nyou filthy moron")], "id string, ingest_ts int, text string")
    got = {r.id: (r.abuse_score >= 0.999, r.abusive_lines) for r in abuse.abusive_pages(rows).collect()}
    assert got["x"] == (True, [1]) and got["n"] == got["e"] == got["l"] == (False, [])


@pytest.fixture(scope="module")
def crf():
    return pii.train(pii_table.table())


def test_pii_held_out(crf):
    rows = pii_table.table(400, seed=77)
    found = pii.Finder(crf)([t for t, _ in rows])
    assert np.mean([set(a) == set(b) for a, (_, b) in zip(found, rows, strict=True)]) > 0.9


def test_viterbi_equals_enumeration(crf):
    import itertools

    for text in ("Call 212 555 0109", "Anna B. Lumridal", "x"):
        memory = pii.Memory(crf)
        t = memory.words.tokens([text])
        e = crf.emissions(t, memory.rows())
        n = len(e)
        best = max(itertools.product(range(pii.N), repeat=min(n, 4)), key=lambda y: crf.begin[y[0]] + sum(e[i, k] for i, k in enumerate(y)) + sum(crf.move[a, b] for a, b in itertools.pairwise(y)))
        if n <= 4:
            got = crf.decode([text], pii.Memory(crf))[0]
            assert (np.zeros(n, int) if got is None else got).tolist() == list(best)


def test_masking_leaves_the_rest(spark, crf):
    text = "We met on Monday.\nYou can reach Anna Lumridal at anna@velmail.example.\n\nOrder no. 4411-2290 was shipped last week."
    rows = spark.createDataFrame([*ODD_ROWS, ("x", 1, text)], "id string, ingest_ts int, text string")
    got = {r.id: r.masked for r in pii.masked_text(rows, crf).collect()}
    assert got["n"] is None and got["e"] == "" and got["b"] == " \n\t" and got["l"] == "word " * 20000
    assert got["x"] == text.replace("Anna Lumridal", "[NAME]").replace("anna@velmail.example", "[EMAIL]")
    found = {r.id: [(x.pii_type, x.pii_text) for x in r.found] for r in pii.personal_data(rows, crf).collect()}
    assert found["x"] == [("name", "Anna Lumridal"), ("email", "anna@velmail.example")] and found["n"] == []


def test_topics(spark):
    rng = random.Random(12)
    docs, labels, truth = [], [], {}
    for i in range(300):
        some = rng.choice([(), ("music",), ("cooking",), ("music", "cooking")])
        lines = []
        for _ in range(8):
            s = rng.choice([*some, *some, None]) if some else None
            lines.append(sentence(rng, rng.sample(SUBJECTS[s], 3) if s else ()))
        held = [sum(any(w in x for w in SUBJECTS[s]) for x in lines) / 8 >= 0.25 for s in ("cooking", "music")]
        truth[i] = {s for s, h in zip(("cooking", "music"), held, strict=True) if h}
        docs.append((i, "eng_Latn" if i % 20 else None, "\n".join(lines)))
        if i < 150:
            given = set(some) if rng.random() > 0.08 else {rng.choice(["music", "cooking"])}
            labels += [(i, s) for s in given] or [(i, None)]
    docs += [(1000, None, None), (1001, "eng_Latn", ""), (1002, "eng_Latn", "xqz zzk")]
    labels += [(0, "music"), (None, "music"), (5000, "music")]
    fitted = topics.fit(
        spark.createDataFrame(docs, "doc_id bigint, lang string, text string"), spark.createDataFrame(labels, "doc_id bigint, subject string"),
        spark.createDataFrame([("music",), ("cooking",), (None,)], "subject string"), boilerplate.train([], []),
    )
    got = {}
    for r in topics.document_subjects(fitted).collect():
        got.setdefault(r.doc_id, set()).add(r.subject)
    assert np.mean([got.get(i, set()) == t for i, t in truth.items()]) > 0.9
    assert not any(k in got for k in (1000, 1001, 1002))
    assert {r.subject for r in topics.inspect(fitted).collect()} == {"music", "cooking", None}
