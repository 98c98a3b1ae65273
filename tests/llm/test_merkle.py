"""The Merkle manifest against a plain tree, and its versions against rebuilt ones."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gleanery.llm import merkle, queries

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(level):
    """Levels of a tree over a list of digests."""
    levels = [level]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([digest("".join(low[i : i + 8])) for i in range(0, len(low), 8)])
    return levels


def path(levels, i):
    found = []
    for low in levels[:-1]:
        first = i // 8 * 8
        found.append(("".join(low[first:i]), "".join(low[i + 1 : first + 8])))
        i //= 8
    return found


def expected(rows):
    """Rows are (doc_id, source, lang, n_chars, text)."""
    if not rows:
        return []
    lower = str.maketrans(merkle.UPPER, merkle.LOWER)
    scopes = defaultdict(list)
    for row in rows:
        scopes[row[2]].append(row)
    names = sorted(scopes, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        ordered = sorted(scopes[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[name] = (ordered, climb([leaf_of(r) for r in ordered]))
    top = climb([trees[n][1][-1][0] for n in names])
    root = top[-1][0]
    found = []
    for place, name in enumerate(names):
        ordered, levels = trees[name]
        for i, row in enumerate(ordered):
            whole = path(levels, i) + path(top, place)
            new = leaf_of(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                new = leaf_of(row[:4] + (row[4] and row[4].translate(lower),))
            for before, behind in whole:
                new = digest(before + new + behind)
            proof = digest("".join(a + b for a, b in whole))
            found.append((row[0], leaf_of(row), levels[-1][0], root, proof, new, new == root))
    return found


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS).collect()]
    got = [tuple(r) for r in queries.op12_merkle(spark, sf_dir).collect()]
    assert sorted(got) == sorted(expected(rows))
    assert 0 < sum(r[-1] for r in got) < len(got)


def scoped(spark, sizes):
    rows = [(i, f"s{i % 3}", lang, None, f"Text {i}" if i % 5 else None) for lang, n in sizes.items() for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 8, None: 1}, {"a": 9, "b": 64, "ß": 65}, {None: 513, "a": 3}, {f"l{i}": 1 + i for i in range(10)}])
def test_shapes_of_trees(spark, sizes, tmp_path):
    rows, docs = scoped(spark, sizes)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(map(tuple, queries.op12_merkle(spark, str(tmp_path)).collect())) == sorted(expected(rows))


def test_several_rounds_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(merkle, "FANOUT", 2)
    rows, docs = scoped(spark, {"a": 77, "b": 9, "c": 1})
    got = merkle.audited(merkle.leaves(docs, F.lit(False))).collect()
    assert all(r.verified and r.version is None for r in got) and len(got) == len(rows)
    assert len({r.root for r in got}) == 1


def test_versions_share_what_they_do_not_copy(spark):
    """A version's copies over the first version's nodes make the tree that the tampered table would have."""
    rows, docs = scoped(spark, {"a": 600, "b": 20})
    found = merkle.leaves(docs, F.col("doc_id") % 100 == 3)
    store = defaultdict(dict)
    for r in merkle.nodes(found).collect():
        assert (r.level, r["index"]) not in store[r.scope_id]
        store[r.scope_id][r.level, r["index"]] = r["digest"]
    for scope, lang in enumerate("ab"):
        levels = climb([leaf_of(r) for r in rows if r[2] == lang])
        assert store[scope] == {(n, i): d for n, level in enumerate(levels) for i, d in enumerate(level)}
    versions = [r for r in merkle.audited(found).collect() if r.version is not None]
    assert sorted(r.key for r in versions) == [3, 3, 103, 203, 303, 403, 503]
    for r in versions:
        lang, scope = ("a", 0) if r.subroot == store[0][4, 0] else ("b", 1)
        changed = [row[:4] + (row[4].lower(),) if row[0] == r.key and row[4] else row for row in rows if row[2] == lang]
        levels = climb([leaf_of(row) for row in changed])
        copies = {(n, r.key // 8**n): d for n, d in enumerate(r.version[: len(levels)])}
        assert store[scope] | copies == {(n, i): d for n, level in enumerate(levels) for i, d in enumerate(level)}
        assert r.version[-1] == r.folded_root and not r.verified


def test_odd_rows(spark, odd, empty, tmp_path):
    for n, docs in enumerate((odd, odd.union(odd), empty)):
        docs.write.parquet(f"{tmp_path}/{n}/documents.parquet")
        rows = [tuple(r) for r in docs.select(*COLUMNS).collect()]
        got = [tuple(r) for r in queries.op12_merkle(spark, f"{tmp_path}/{n}").collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, expected(rows)))
