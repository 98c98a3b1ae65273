import random
import re
from itertools import combinations

from corpus_cases import ODD, WORD

from gleanery.llm import groups, minhash_join, queries


def shingles(text, size=3):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def components(pairs):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return find


def expected(rows, percent=85, size=3):
    sets = [(i, shingles(t, size)) for i, t in rows]
    known = [(i, s) for i, s in sets if i is not None and s]
    linked = [
        (a, b)
        for (a, s), (b, t) in combinations(known, 2)
        if min(len(s), len(t)) * 100 >= percent * max(len(s), len(t)) and 100 * len(s & t) >= percent * len(s | t)
    ]
    find = components(linked)
    return [(i, len(s), find(i) if s and i is not None else i, i is None or not s or find(i) == i) for i, s in sets]


def key(row):
    return row[0] is None, row[0] or 0, row[1:]


def test_odd_rows(odd, empty):
    got = minhash_join.near_duplicates(odd)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected(ODD), key=key)
    left = minhash_join.deduplicated(odd)
    assert left.columns == odd.columns
    gone = {r[0] for r in expected(ODD, 80, 5) if not r[3]}
    assert sorted(map(str, (r.doc_id for r in left.collect()))) == sorted(str(i) for i, _ in ODD if i not in gone)
    assert minhash_join.near_duplicates(empty).count() == 0
    assert minhash_join.deduplicated(empty).count() == 0


def edited(words, n, draw):
    words = list(words)
    for _ in range(n):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    return " ".join(words)


def test_groups_of_near_copies_in_blocks(spark, monkeypatch):
    draw = random.Random(3)
    rows = []
    for g in range(4):
        base = [f"g{g}w{draw.randrange(500)}" for _ in range(150)]
        rows += [(1000 * g + i, edited(base, draw.randrange(9), draw)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(minhash_join.candidate_edges, "__defaults__", (16,))
    monkeypatch.setattr(minhash_join.confirmed_edges, "__defaults__", (2000,))
    got = minhash_join.near_duplicates(docs)
    assert sorted(map(tuple, got.collect())) == sorted(expected(rows))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100)] + [(500, 500 + i) for i in range(50)] + [(7, 7), (3, 2)]
    draw = random.Random(1)
    draw.shuffle(edges)
    got = dict(map(tuple, groups.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(1, 101)} | {500 + i: 500 for i in range(1, 50)}
    assert groups.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_unique_texts_of_repeated_ids_stay(spark):
    draw = random.Random(5)
    a, b, c = (" ".join(f"{n}{draw.randrange(500)}" for _ in range(120)) for n in "abc")
    near = edited(a.split(), 1, draw)
    rows = [(3, a), (5, a), (5, b), (6, c), (6, near), (7, c.upper()), (None, a), (8, None)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, _h string")
    got = minhash_join.deduplicated(docs)
    assert got.columns == docs.columns
    left = [(r.doc_id, r.text) for r in got.collect()]
    kept = [(3, a), (5, b), (6, c), (6, near), (None, a), (8, None)]
    assert sorted(map(str, left)) == sorted(map(str, kept))


def test_query(spark, sf_dir, texts):
    got = sorted(map(tuple, queries.op6_minhash_join(spark, sf_dir).collect()))
    assert got == sorted(expected(texts))
