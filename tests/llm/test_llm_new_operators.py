"""Fill-in-middle, token counts and hard negatives against plain computations, and on odd rows."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from roadpulse.llm import bpe, infill, negatives, token_counts
from roadpulse.llm.vocabularies import byte_bpe

ODD = [
    (5, "Alpha beta-gamma 12.5\n\tdelta"),
    (5, "Alpha beta-gamma 12.5\n\tdelta"),
    (7, None),
    (None, "no id at all"),
    (8, ""),
    (9, "keeps <S> inside"),
    (10, "<P"),
    (11, "Été à Paris 漢字 🚗 <|endoftext|> 12 ½ end"),
    (12, "x" * 70_000 + " " + " ".join(f"w{i}" for i in range(30_000))),
    (13, "abracadabra" * 3_000),
]
#: Names that operators use inside, beside the two they read.
CLASHING = ["n", "form", "output", "n_tokens", "text_sha256", "size", "anchor", "low", "tile", "tree", "bucket"]


def documents(spark, found):
    return spark.createDataFrame([(*x, *range(len(CLASHING))) for x in found], "doc_id long, text string, " + ", ".join(f"{x} int" for x in CLASHING))


@pytest.fixture(scope="module")
def odd(spark):
    return documents(spark, ODD).cache()


@pytest.fixture(scope="module")
def many(spark):
    rng = random.Random(5)
    pieces = ["the ", "Road", "<", "P>", "é", "漢", "\n", " ", "42", "-", "🚗", "aaaa", "<M", ">"]
    texts = [(i, "".join(rng.choice(pieces) for _ in range(rng.randrange(40)))) for i in range(400)]
    return documents(spark, texts + ODD).cache()


def plain_infill(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    drawn = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(drawn[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    form = "spm" if h4 % 100 < 20 else "psm"
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return doc_id, len(units), form, len(prefix), len(middle), output, text


def in_order(found):
    return sorted(found, key=lambda x: [(y is None, y) for y in x])


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_infill_equals_brute_force(many):
    plain = [plain_infill(x.doc_id, x.text) for x in many.select("doc_id", "text").collect()]
    outputs = infill.transform(many)
    assert in_order(map(tuple, outputs.collect())) == in_order(x[:6] for x in plain)
    assert in_order(map(tuple, infill.restore(outputs).collect())) == in_order((x[0], x[6]) for x in plain)
    hashes = in_order((*x[:5], sha(x[5]), sha(x[6])) for x in plain)
    assert in_order(map(tuple, infill.round_trip(many).collect())) == hashes
    assert {x[2] for x in plain} == {"plain", "psm", "spm"}


def test_infill_settings_and_empty_table(spark, many):
    assert infill.round_trip(documents(spark, [])).collect() == []
    assert infill.restore(infill.transform(documents(spark, []))).collect() == []
    forms = {x.form for x in infill.transform(many, plain_from=100, spm_below=100).filter("n > 0 AND doc_id < 400").collect()}
    assert "spm" in forms and "psm" not in forms


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aB<PSM>é漢\n ")), st.integers(0, 10_000))
def test_infill_restores_any_text(text, doc_id):
    data = text.encode()
    found = infill.transformed(doc_id, data)
    output = b"".join(infill.stream(found.table, data))
    assert output.decode() == plain_infill(doc_id, text)[5]
    assert b"".join(infill.stream(infill.restored(output, found.form), output)) == data
    assert infill.digest(found.table, data) == hashlib.sha256(output).hexdigest()


def test_cutting_splits_descriptors():
    table = [infill.Piece(0, 0, 4), infill.Piece(1, 3, 6), infill.Piece(0, 4, 9)]
    a, b, c = infill.cut(table, [2, 5])
    assert a == [infill.Piece(0, 0, 2)]
    assert b == [infill.Piece(0, 2, 4), infill.Piece(1, 3, 4)]
    assert c == [infill.Piece(1, 4, 6), infill.Piece(0, 4, 9)]
    assert infill.cut(table, [0, 12]) == [[], table, []]


def test_units_of_a_text_of_several_stretches():
    text = ("ab é1" * 40_000 + "c").encode()
    units = infill.Units(text)
    found = [x.start() for x in re.finditer(rb"[A-Za-z]+|[\x00-\x7f]|[\xc0-\xff][\x80-\xbf]*", text)]
    assert units.count == len(found)
    assert [units.place(x) for x in (0, 1, 99_999, units.count - 1, units.count)] == [found[0], found[1], found[99_999], found[-1], len(text)]


def tokens(texts):
    return [len(x.ids) for x in Tokenizer.from_file(byte_bpe()).encode_batch(texts, add_special_tokens=False)]


def test_token_counts_equal_the_library(many):
    found = token_counts.count(many, byte_bpe(), limit=10)
    plain = [(x.doc_id, x.text or "") for x in many.select("doc_id", "text").collect()]
    sizes = tokens([x for _, x in plain])
    expected = [(doc_id, len(text.encode()), n, n > 10) for (doc_id, text), n in zip(plain, sizes)]
    assert in_order(map(tuple, found.collect())) == in_order(expected)


def test_token_counts_of_no_documents(spark):
    assert token_counts.count(documents(spark, []), byte_bpe()).collect() == []


def test_token_counts_forget_and_go_on(monkeypatch):
    rng = random.Random(8)
    texts = ["".join(rng.choice("ab cdé漢\n\t 12!'s") for _ in range(rng.randrange(0, 900))) for _ in range(200)]
    texts += ["ܢ࢏՘ a", "<|endoftext|>" * 3, "a<|endoftext|> b"]
    for name, value in (("HELD", 64), ("REMEMBERED", 50), ("LONG", 8)):
        monkeypatch.setattr(token_counts, name, value)
    assert token_counts.Counter(bpe.load(byte_bpe())).count(texts).tolist() == tokens(texts)


@pytest.mark.parametrize("letters", ["a", "ab", "abcdefgh", "etaoin shrdlu"])
def test_a_very_long_word(letters):
    rng = random.Random(len(letters))
    word = "".join(rng.choice(letters.replace(" ", "")) for _ in range(200_000))
    assert token_counts.Counter(bpe.load(byte_bpe())).count([word]).tolist() == tokens([word])


VECTORS = "vec_id long, embedding array<double>, label int, " + ", ".join(f"{x} int" for x in CLASHING)


def vectors(spark, found):
    return spark.createDataFrame([(*x, *range(len(CLASHING))) for x in found], VECTORS).repartition(3)


def plain_negatives(found):
    """Everything scored with everything, in whole numbers."""
    sound = set()
    for vec_id, vector, label in found:
        if vec_id is None or label is None or vector is None or not all(x is not None and np.isfinite(x) for x in vector):
            continue
        sound.add((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, tuple(int(np.floor(256 * x)) for x in vector)))
    out = []
    for vec_id, label, vector in sound:
        if vec_id % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(vector, w)), i, l) for i, l, w in sound if len(w) == len(vector)]
        positives = sorted((s, i) for s, i, l in scored if l == label and i != vec_id)[:5]
        for positive, positive_id in positives:
            inside = sorted((s, i) for s, i, l in scored if l != label and 30 * -positive <= 100 * -s <= 90 * -positive)[:10]
            out += [(vec_id, positive_id, n, i, -positive, -s) for n, (s, i) in enumerate(inside, 1)]
    return sorted(out)


def mined(spark, found):
    return sorted(map(tuple, negatives.mine(vectors(spark, found)).collect()))


def clustered(count, size, seed, step=1):
    rng = np.random.RandomState(seed)
    centres = rng.standard_normal((6, size))
    near = centres[rng.randint(6, size=count)] + 0.4 * rng.standard_normal((count, size))
    return [(i * step, x.tolist(), int(label)) for i, (x, label) in enumerate(zip(near / np.sqrt(size), rng.randint(10, size=count)))]


@pytest.mark.parametrize("size, tile, leaf", [(8, 4096, 32), (8, 40, 4), (3, 25, 2), (33, 60, 8)])
def test_negatives_equal_brute_force(spark, size, tile, leaf, monkeypatch):
    found = clustered(400, size, size, step=10)
    monkeypatch.setattr(negatives, "TILE", tile)
    monkeypatch.setattr(negatives, "LEAF", leaf)
    monkeypatch.setattr(negatives, "ANCHORS", 16)
    monkeypatch.setattr(negatives, "ABREAST", 5)
    expected = plain_negatives(found)
    assert mined(spark, found) == expected and len(expected) > 300


def test_negatives_under_ties_and_copies(spark, monkeypatch):
    monkeypatch.setattr(negatives, "LEAF", 4)
    copies = [(i, [0.5, 0.25], i % 2) for i in range(0, 800, 4)]
    grid = [(1000 + i, [(i % 5) / 4, (i % 3) / 2], i % 4) for i in range(300)]
    assert mined(spark, copies + grid) == plain_negatives(copies + grid)


def test_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    found = clustered(150, 4, 1) + [
        (200, None, 1), (300, [0.1, nan, 0.2, 0.3], 2), (400, [0.1, None, 0.2, 0.3], 2), (500, [inf, 0.1, 0.2, 0.3], 3),
        (600, [0.1, 0.2, 0.3, 0.4], None), (None, [0.1, 0.2, 0.3, 0.4], 4), (700, [0.0] * 4, 5), (800, [0.1, 0.2], 6),
        (801, [0.1, 0.25], 6), (802, [0.1, 0.22], 7), (900, [], 8), (901, [], 8), (902, [], 9), (1000, [-1.0, 0.5, 0.0, 0.25], 0),
        (1000, [-1.0, 0.5, 0.0, 0.25], 0), (1100, [1000.0, -1000.0, 5.0, 0.0], 3),
    ]
    assert mined(spark, found) == plain_negatives(found)
    assert mined(spark, [(100, [1e300, 1.0], 1), (101, [1.0, 1.0], 1)]) == []  # too long to be scored exactly
    assert mined(spark, []) == []


def test_every_level_covers_its_rows(monkeypatch):
    monkeypatch.setattr(negatives, "LEAF", 16)
    rng = np.random.RandomState(2)
    points = np.vstack([rng.randint(-200, 200, (300, 6)), np.tile([7] * 6, (90, 1))]).astype(np.int32)
    norm = float((points.astype(float) ** 2).sum(axis=1).max())
    tree = negatives.build(points, np.arange(len(points)), np.zeros(len(points), np.int64), norm)
    high = negatives.augmented(tree.vectors, norm)

    def children(node):
        return range(tree.child[node], tree.child[node] + tree.children[node])

    def below(node):
        if not tree.children[node]:
            return list(range(tree.start[node], tree.end[node]))
        return [row for x in children(node) for row in below(x)]

    for node in range(len(tree.centre)):
        apart = np.sqrt(((high[below(node)] - high[tree.centre[node]]) ** 2).sum(axis=1))
        assert apart.max() <= tree.radius[node] + 1e-6
        if len(children(node)) < min(negatives.CHILDREN, 2 * len(apart) / negatives.LEAF):
            assert all(tree.radius[x] <= tree.radius[node] / 2 + 1e-9 for x in children(node))
    assert sorted(below(0)) == list(range(len(points)))


def test_a_search_leaves_out_most_of_a_clustered_tree():
    rng = np.random.RandomState(3)
    centres = rng.randint(-2000, 2000, (40, 8))
    points = (centres[rng.randint(40, size=4000)] + rng.randint(-20, 20, (4000, 8))).astype(np.int32)
    norm = float((points.astype(float) ** 2).sum(axis=1).max())
    tree = negatives.build(points, np.arange(4000), np.zeros(4000, np.int64), norm)
    scored = []

    def allowed(who, rows):
        scored.append(len(rows))
        return np.ones(len(rows), bool)

    every = negatives.Windows(np.full((20, 1), -np.inf), np.full((20, 1), np.inf))
    who, _, score, _ = negatives.search(tree, points[:20].astype(float), allowed, every, 5)
    best = -np.sort(-(points[:20].astype(np.int64) @ points.T.astype(np.int64)), axis=1)[:, :5]
    assert [sorted(score[who == i].tolist(), reverse=True) for i in range(20)] == best.tolist()
    assert sum(scored) < 20 * 4000 / 4
