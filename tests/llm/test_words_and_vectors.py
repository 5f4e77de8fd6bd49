"""Spelling variants, hard negatives and byte-level BPE against brute force, with their odd cases."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyworks.llm import common, hard_negatives, spelling, word_bpe

NAMES = ("value", "n", "key", "words", "rank", "row", "label", "block", "place", "id")


# --- spelling ---------------------------------------------------------------------------


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected_groups(n, times=5):
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= times * n[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, n[w], len(near[w]), form.get(w), n[form[w]] if w in form else None, root(w)) for w in n}


def groups(spark, n):
    table = spark.createDataFrame(list(n.items()), "word string, n long").withColumns({c: F.lit("x") for c in ("a", "gram", "part")})
    rows = spelling.group_variants(table).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert len(rows) == len(n)
    return {tuple(r) for r in rows}


def variants(seed, base=40, letters="abcdé", least=4, most=9):
    r = random.Random(seed)
    n = {}
    for _ in range(base):
        word = "".join(r.choice(letters) for _ in range(r.randrange(least, most)))
        n[word] = r.choice([5, 30, 200, 1500, 9000])
        for _ in range(5):
            i, c = r.randrange(len(word)), r.choice(letters)
            for other in (word[:i] + word[i + 1 :], word[:i] + c + word[i:], word[:i] + c + word[i + 1 :]):
                if len(other) >= least:
                    n.setdefault(other, r.choice([5, 6, 30, 200]))
    return n


@pytest.mark.parametrize("seed", [1, 2])
def test_spelling_groups(spark, seed):
    n = variants(seed)
    assert groups(spark, n) == expected_groups(n)


def test_spelling_paths_ties_and_repeated_letters(spark):
    n = {"aaaaaa": 5, "aaaaaaa": 25, "aaaaaaaa": 125, "aaaaaaaaa": 625, "aaaaaaaab": 625, "zzzzzz" * 3000: 7, "zzzzzz" * 3000 + "z": 40, "lonely": 9}
    assert groups(spark, n) == expected_groups(n)
    roots = {r[0]: r[5] for r in expected_groups(n)}
    assert roots["aaaaaa"] in ("aaaaaaaaa", "aaaaaaaab")


def test_spelling_splits_long_lists(spark, monkeypatch):
    monkeypatch.setattr(spelling, "LIST", 3)
    n = variants(5, letters="ab")
    assert groups(spark, n) == expected_groups(n)


def test_every_near_pair_shares_a_pivot():
    """The guarantee on which the index rests, over all words of one alphabet and their edits."""
    n = variants(7, base=60, letters="abc")
    counts = Counter(spelling.gram_class(w[i : i + 2]) for w in n for i in range(len(w) - 1))
    keys = {w: spelling.word_keys(w, counts) for w in n}
    pairs = 0
    for a, b in combinations(n, 2):
        if one_edit(a, b):
            pairs += 1
            s, r = (a, b) if keys[a][0] <= keys[b][0] else (b, a)
            places = {(g, p) for _, g, p in keys[r][1]}
            assert any((g, p + d) in places for _, g, p in keys[s][2] for d in (-1, 0, 1))
    assert pairs > 300


def test_pivots_are_cheapest_and_disjoint():
    r = random.Random(4)
    for _ in range(300):
        places = sorted(r.sample(range(12), r.randrange(3, 7)))
        prefix = [(r.randrange(1, 30), f"g{p}", p) for p in places]
        got = spelling.choose_pivots(prefix)
        apart = [c for c in combinations(prefix, 2) if abs(c[0][2] - c[1][2]) >= spelling.GRAM]
        assert abs(got[0][2] - got[1][2]) >= spelling.GRAM and sum(g[0] for g in got) == min(a[0] + b[0] for a, b in apart)


def test_spelling_words_and_odd_texts(spark):
    rows = [(1, "Straße ÉTÉétéé don't x " * 5), (None, "STRAßE"), (2, None), (3, ""), (4, "123 --"), (5, "abcdefgh " * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in NAMES if c != "words"})
    got = {r["word"]: r["n"] for r in spelling.count_words(spelling.letter_runs(docs), F.col("run")).collect()}
    assert got == {"straße": 6, "abcdefgh": 20_000, "ÉtÉétéé": 5}
    empty = spelling.count_words(spelling.letter_runs(docs.limit(0)), F.col("run"))
    assert spelling.group_variants(empty).count() == 0
    with pytest.raises(Exception, match="characters"):
        spelling.group_variants(spark.createDataFrame([("abc", 5)], "word string, n long")).collect()


# --- hard negatives ---------------------------------------------------------------------


def expected_negatives(rows, k=5, least=80):
    """By all pairs; rows are (vec_id, label, components, anchor)."""
    rows = [r for r in rows if r[1] is not None and r[2] is not None and all(x is not None and np.isfinite(x) for x in r[2])]
    order = [(r[0] is None, r[0] or 0) for r in rows]
    out = []
    for i, (vec_id, label, v, anchor) in enumerate(rows):
        if not anchor:
            continue
        score = [sum(int(x) * int(y) for x, y in zip(v, o[2])) for o in rows]
        best = sorted((j for j in range(len(rows)) if j != i), key=lambda j: (-score[j], order[j], j))
        for p in [j for j in best if rows[j][1] == label][:k]:
            fits = [j for j in best if rows[j][1] != label and least * score[p] <= 100 * score[j] <= 100 * score[p]]
            out += [(vec_id, rows[p][0], n, rows[j][0], score[p], score[j]) for n, j in enumerate(fits[:k], 1)]
    return Counter(out)


def mined(spark, rows, **options):
    schema = "vec_id long, label int, components array<double>, anchor boolean"
    table = spark.createDataFrame(rows, schema).withColumns({c: F.lit(1) for c in NAMES if c != "label"})
    return Counter(map(tuple, hard_negatives.mine(table, **options).collect()))


def vectors(seed, count=400, width=8):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(4, width))
    rows = []
    for i in range(count):
        label = int(r.integers(4))
        v = np.floor(60 * (centres[label if r.random() < 0.7 else int(r.integers(4))] + 0.4 * r.normal(size=width)) * r.uniform(0.2, 2))
        rows.append((i, label, v.tolist(), i % 20 == 0))
    return rows


@pytest.mark.parametrize("cells", [8 * 16, 1 << 18])
def test_hard_negatives(spark, monkeypatch, cells):
    monkeypatch.setattr(hard_negatives, "BUCKET_CELLS", cells)
    monkeypatch.setattr(hard_negatives, "SAMPLE", 64)
    monkeypatch.setattr(hard_negatives, "BLOCK", 7)
    rows = vectors(1)
    want = expected_negatives(rows)
    assert mined(spark, rows) == want and len(want) > 100


def test_hard_negatives_odd_rows(spark):
    rows = vectors(2, 120)
    copies = [(1000 + i, 1, rows[0][2], i == 0) for i in range(30)] + [(1000, 2, rows[0][2], True)] * 2
    none = [(2000, None, [1.0] * 8, True), (2001, 1, None, True), (2002, 1, [1.0, None] + [0.0] * 6, True), (2003, 1, [float("nan")] * 8, True), (2004, 1, [float("inf")] + [0.0] * 7, True)]
    more = [(None, 1, rows[0][2], False), (None, 2, rows[0][2], False), (2005, 1, [0.0] * 8, True), (2006, 3, [], True), (2007, 2, [5.0, 6.0], True), (-20, 0, [-3.0] * 8, True)]
    large = [(3000 + i, i % 2, [2.0**29 + i, -(2.0**28), 3.0] + [0.0] * 5, True) for i in range(6)]
    rows += copies + none + more + large
    assert mined(spark, rows) == expected_negatives(rows)
    assert mined(spark, rows, k=2, least_percent=50) == expected_negatives(rows, 2, 50)
    assert not mined(spark, rows[:0]) and not mined(spark, none)


def test_hard_negatives_go_past_the_driver(spark, monkeypatch):
    """Tasks that hold several buckets, and several that hold the sample; no table is broadcast."""
    for name, value in {"BUCKET_CELLS": 8 * 16, "SAMPLE": 64, "BLOCK": 7, "SAMPLE_BLOCKS": 1, "PARTS": 3, "HELD": 16}.items():
        monkeypatch.setattr(hard_negatives, name, value, raising=False)
    plans, written = [], common.written

    def recorded(df, purpose):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, purpose)

    monkeypatch.setattr(common, "written", recorded)
    rows = vectors(3)
    found = hard_negatives.mine(spark.createDataFrame(rows, "vec_id long, label int, components array<double>, anchor boolean"))
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert Counter(map(tuple, found.collect())) == expected_negatives(rows)
    assert len(plans) == 7 and not any("Broadcast" in plan for plan in plans)


def test_least_of_several_buckets():
    ties = [(1, 10, 2, 20, 9, other, other_id, score) for other, other_id, score in [(7, 70, 5), (5, 50, 6), (4, 70, 5), (3, 71, 5), (9, 60, 5)]]
    alone = (1, 10, 3, 30, 9, 7, 70, 1)
    assert hard_negatives._least_of([*ties, alone], 3) == [ties[1], ties[4], ties[2], alone]


def test_coordinate_lists_lose_no_candidate():
    r = np.random.default_rng(5)
    v = np.floor(r.normal(size=(300, 6)) * 50 * r.uniform(0.1, 3, (300, 1)))
    v[0] = 0
    units = hard_negatives.unit(v)
    lengths = np.sqrt((v * v).sum(1))
    number = np.arange(300)
    bucket = hard_negatives.Bucket(number, number, number, v, np.argsort(units, axis=0).T.astype(np.uint32), lengths.min(), lengths.max())
    pruned = 0
    for anchor in v[:60]:
        scores = v @ anchor
        for bound in [None, *np.quantile(scores, [0, 0.3, 0.5, 0.9, 0.99, 1]).astype(int).tolist(), int(scores.max()) + 10**6]:
            found = set(bucket.candidates(anchor, bound).tolist())
            assert bound is None or set(np.flatnonzero(scores >= bound).tolist()) <= found
            pruned += len(found) < 300
    assert pruned > 60


# --- byte-level BPE ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers as P
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = word_bpe.read_ranks(path)
    return path, P.PATTERN, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    r = random.Random(9)
    everything = [chr(r.choice([r.randrange(32, 127), r.randrange(0x80, 0x2000), r.randrange(0x2000, 0xD800), r.randrange(0xE000, 0x110000)])) for _ in range(4000)]
    words = ["don't we'll I'VE  two   spaces\n\n\ttabs   x 123 ४५ 漢字かな <|endoftext|> 🙂👩‍👩‍👧", "   ", "\n", "a", " a", "''s", "é" * 5000, "ab" * 30_000, "x1" * 300]
    noise = ["".join(r.choice("ab '\n1é漢ࡰ.") for _ in range(r.randrange(60))) for _ in range(300)]
    return [None, "", "same", "same", *words, *noise, "".join(everything), "word " * 20_000, "\U00032eabࡰ\U00010d40"]


@pytest.mark.parametrize("block", [50, 1 << 22])
def test_bpe_like_the_library_and_back(spark, vocabulary, monkeypatch, block):
    path, pattern, library = vocabulary
    monkeypatch.setattr(word_bpe, "BLOCK", block)
    monkeypatch.setattr(word_bpe, "JOINED", 100)
    monkeypatch.setattr(word_bpe, "TEXTS", 7)
    texts = odd_texts()
    rows = [(None if i % 50 == 7 else i // 2, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in NAMES})
    both = (word_bpe.decode(word_bpe.encode(docs, path, pattern), path), word_bpe.round_trip(docs, path, pattern))
    want = Counter((d, tuple(library.encode_ordinary(t or "")), (t or "").encode()) for d, t in rows)
    for texts in both:
        got = texts.select("doc_id", "ids", "data").collect()
        assert Counter((r["doc_id"], tuple(r["ids"]), bytes(r["data"])) for r in got) == want
    assert word_bpe.round_trip(docs.limit(0), path, pattern).count() == 0


def test_characters_are_classed_as_the_library_does(vocabulary):
    """Every character beside a letter, a digit and a space: how the text falls apart shows the character's class."""
    import tiktoken

    pattern, single = vocabulary[1], {bytes([i]): i for i in range(256)}
    split = word_bpe.splitter(pattern)
    text = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF)
    known = {kind: word_bpe._known_to_library(kind, text) for kind in word_bpe.CLASSES}
    library = {kind: tiktoken.Encoding("c", pat_str=kind, mergeable_ranks=single, special_tokens={}) for kind in word_bpe.CLASSES}
    for i in range(0, len(text), 7):
        c = text[i]
        kind = next((k for k in word_bpe.CLASSES if c in known[k]), None)
        want = {"\\p{L}": ["a" + c + "a"], "\\p{N}": ["a", c, "a"], "\\s": ["a", " a"] if c == " " else ["a", c, "a"], None: ["a", c, "a"]}[kind]
        assert split("a" + c + "a") == want
        if kind == "\\p{N}":
            assert split("1" + c + "1") == ["1" + c + "1"] and library[kind].encode_ordinary(c)


def test_merges_follow_the_ranks(vocabulary):
    path, _, library = vocabulary
    ranks, r = word_bpe.read_ranks(path), random.Random(2)
    for length in (1, 2, 5, 20, 64, 65, 200, 1000):
        for _ in range(30):
            word = "".join(r.choice("aabcdeéü漢") for _ in range(length))
            assert word_bpe.merge(word.encode(), ranks) == word_bpe._merge_long(word.encode(), ranks) == library.encode_ordinary(word)


def test_unknown_ids_raise(spark, vocabulary):
    path = vocabulary[0]
    with pytest.raises(Exception, match="not in the vocabulary"):
        word_bpe.decode(spark.createDataFrame([(1, 1, [10, 60_000])], word_bpe.ENCODED_SCHEMA), path).collect()
