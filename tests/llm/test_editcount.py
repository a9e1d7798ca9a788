import random

import pytest

from pyspark.sql import functions as F
from registrylake.llm import editcount
from registrylake.llm.tokens import Encoder


def _edited(text, edits):
    out, at = [], 0
    for first, last, new in edits:
        out += [text[at:first], new]
        at = last
    return "".join(out) + text[at:]


@pytest.mark.parametrize("size", [3, 40, 512])
def test_counts_equal_a_full_encoding(tokenizer, size):
    encoder, rng = Encoder(tokenizer), random.Random(size)
    for _ in range(60):
        text = "".join(rng.choice(["the ", "and", " ", ",", ".\n", "x y z ", "  ", "é", "don't "]) for _ in range(rng.randint(0, 400)))
        leaves = editcount.cut_leaves(text, size)
        assert "".join(leaves) == text
        tree = editcount.build_tree(encoder.counts(leaves))
        assert tree[1] == len(encoder.whole(text))
        points = sorted(rng.randint(0, len(text)) for _ in range(8))
        edits = [(points[i], points[i + 1], rng.choice(["", " ", "new", " a b ", "\n ", "'s"])) for i in range(0, 8, 2)]
        new, redone = editcount.apply_edits(text, [len(x) for x in leaves], tree, edits, encoder)
        assert new == _edited(text, edits) and tree[1] == len(encoder.whole(new)) and redone >= 1


def test_far_leaves_are_not_encoded_again(tokenizer):
    encoder = Encoder(tokenizer)
    text = "some words that go on " * 2000
    leaves = editcount.cut_leaves(text)
    tree = editcount.build_tree(encoder.counts(leaves))
    _, redone = editcount.apply_edits(text, [len(x) for x in leaves], tree, [(20_000, 20_004, "other")], encoder)
    assert redone == 1 and len(leaves) > 80


def test_overlapping_edits_raise(tokenizer):
    encoder = Encoder(tokenizer)
    with pytest.raises(ValueError):
        editcount.apply_edits("abcdef", [6], editcount.build_tree([1]), [(0, 3, ""), (2, 4, "")], encoder)


def test_table(spark, docs_of, tokenizer):
    texts = ["mail a.b@c.org now", "", None, "x" * 30_000, "no edits here", "1.2.3.4 and 5.6.7.8"]
    docs = docs_of(texts).withColumns({"tree": F.lit("clash"), "edits": F.lit("clash")})
    found = editcount.replacing_edits(docs, r"\S+@\S+|\d(?:\.\d){3}", "[masked]", needs="[0-9@]")
    rows = editcount.recount(editcount.count_trees(found, tokenizer), tokenizer).collect()
    encoder = Encoder(tokenizer)
    for r in rows:
        assert r.n_before == len(encoder.whole(texts[r.doc_id] or "")) and r.n_tokens == len(encoder.whole(r.text))
    by_id = {r.doc_id: r for r in rows}
    assert by_id[0].text == "mail [masked] now" and by_id[5].n_edits == 2 and by_id[2].n_tokens == 0
    assert by_id[3].n_edits == 0 and len(rows) == len(texts)
    empty = editcount.count_trees(editcount.replacing_edits(docs_of([]), "x", ""), tokenizer)
    assert editcount.recount(empty, tokenizer).collect() == []


def test_given_edits_and_nulls(spark, docs_of, tokenizer):
    docs = docs_of([(1, "a b c"), (1, "a b c"), (None, "d")])
    docs = docs.withColumn("edits", F.expr("IF(doc_id = 1, array(named_struct('first', -5, 'last', 99, 'text', 'z')), NULL)"))
    rows = editcount.recount(editcount.count_trees(docs, tokenizer), tokenizer).collect()
    assert sorted((r.doc_id or 0, r.text, r.n_edits) for r in rows) == [(0, "d", 0), (1, "z", 1), (1, "z", 1)]


def test_digits_of_all_scripts_are_masked(spark, docs_of, tokenizer):
    from registrylake.llm.queries import PERSONAL

    text = "number ١٢٣٤٥٦٧٨٩٠١٢٣ end"
    rows = docs_of([(1, text), (2, text + " 5")])
    edits = editcount.replacing_edits(rows.select("doc_id", "text"), PERSONAL, "[masked]", needs=r"[\d@]")
    found = editcount.recount(editcount.count_trees(edits, tokenizer), tokenizer).collect()
    assert {r.doc_id: r.n_edits for r in found} == {1: 1, 2: 1}


def test_the_table_of_pieces_stays_small(tokenizer):
    from registrylake.llm import tokens

    encoder = tokens.encoder(tokenizer, 500)
    for first in range(0, 5000, 100):
        texts = [f"word{first + i} is w{'ab'[i % 2]}{first + i}x" for i in range(100)]
        assert encoder.counts(texts).tolist() == [len(encoder.whole(t)) for t in texts]
        assert len(encoder.pieces) <= 500 + 300
    assert tokens.encoder(tokenizer) is encoder and encoder.most == tokens.CACHED_PIECES
    assert editcount.CACHED_PIECES <= tokens.CACHED_PIECES // 4  # of three workers a task, each with a table
