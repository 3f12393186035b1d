"""Names are found by their place and shape, whether or not the given name is in a table."""

import pytest

from loomline.llm import pii, pii_table


@pytest.fixture(scope="module")
def finder():
    return pii.Finder(pii.train(pii_table.table(6000)))


OUTSIDE = ["Susan Miller", "Katja Weber", "Priya Ramanathan", "Oluwaseun Adeyemi", "Siobhan Osborne"]


@pytest.mark.parametrize("name", OUTSIDE)
def test_given_names_outside_the_table(finder, name):
    assert name.split()[0] not in pii_table.GIVEN
    texts = [f"My name is {name} and I live near the lake.", f"Das Protokoll hat {name} geschrieben.", f"Escrito por {name}.", f"Webmaster: {name}"]
    found = finder(texts)
    assert sum([t[a:b] for a, b, k in f if k == "name"] == [name] for t, f in zip(texts, found, strict=True)) >= 3


def test_no_names(finder):
    assert not pii.exact("name", "G+DYXE zz") and not pii.exact("name", "Susan") and not pii.exact("name", "Flat 12 Susan")
    assert finder(["Nobody expected much of the old garden gate."]) == [[]]


def test_held_out_patterns_and_names():
    model = pii.train(pii_table.table(6000, keep=range(4)))
    rows = pii_table.table(600, seed=99, keep=range(4, 5))
    found = pii.Finder(model)([t for t, _ in rows])
    wanted = [(k, span) for k, (_, marks) in enumerate(rows) for span in marks if span[2] != "name" or rows[k][0][span[0] : span[1]].split()[0].strip(",.") not in pii_table.GIVEN]
    assert sum(span in found[k] for k, span in wanted) / len(wanted) > 0.8


def test_one_string_is_cut_alike_in_short_and_long_lines():
    sentence = "Please ask for Prof. Susan Miller at the desk."
    assert pii.pieces(sentence) == [(0, sentence)]
    long = f"{sentence} " + "Nobody expected much of the garden. " * 20
    assert pii.pieces(long)[0] == (0, sentence)


def test_given_names_come_from_addresses_of_persons_on_the_page():
    texts = ["Oluwa Adeyemi, oluwa.adeyemi@mail.example", "kettle.shop@mail.example", "Siobhan Osborne: siobhan_osborne (at) mail.example"]
    assert pii.given_in_addresses(texts) == {"oluwa", "siobhan"}


def test_what_is_not_searched_would_find_nothing():
    """Sentences that the bound rules out are all O under plain Viterbi too."""
    model = pii.train(pii_table.table(1500), rounds=3)
    texts = [t for t, _ in pii_table.table(300, seed=5)]
    for text, got in zip(texts, model.decode(texts, pii.Memory(model)), strict=True):
        memory = pii.Memory(model)
        e = model.emissions(memory.words.tokens([text]), memory.rows())
        score, back = e[0] + model.begin, []
        for row in e[1:]:
            step = score[:, None] + model.move
            back.append(step.argmax(axis=0))
            score = step.max(axis=0) + row
        path = [int(score.argmax())]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        assert ([0] * len(e) if got is None else got.tolist()) == path[::-1]
