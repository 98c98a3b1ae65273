"""Runs against plain scans, on small alphabets and on the documents."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from corpus_cases import ODD, WORD
from hypothesis import given, settings
from hypothesis import strategies as st

from gleanery.llm import periodic_runs, queries


def plain_lyndon(codes, flip):
    codes = [-c for c in codes] if flip else codes
    n = len(codes)
    lengths = []
    for i in range(n):
        words = (codes[i:j] for j in range(n, i, -1))
        lengths.append(next(len(w) for w in words if all(w < w[k:] for k in range(1, len(w)))))
    return lengths


def plain_runs(codes, min_length=6, exponent=4):
    found, x = [], np.array(codes)
    for q in range(1, len(codes) // exponent + 1):
        equal = np.concatenate([[0], x[:-q] == x[q:], [0]])
        starts, ends = np.flatnonzero(np.diff(equal) == 1), np.flatnonzero(np.diff(equal) == -1)
        for i, length in zip(starts.tolist(), (ends - starts + q).tolist()):
            word = x[i : i + length]
            if length >= max(min_length, exponent * q) and not any((word[:-d] == word[d:]).all() for d in range(1, q)):
                found.append((i, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    codes = {w: i for i, w in enumerate(dict.fromkeys(words))}
    runs = plain_runs([codes[w] for w in words])
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    start, length, period = best or (None, None, None)
    milli = 1000 * length // period if best else None
    return (doc_id, len(runs), start, length, period, milli, digest(listed), digest(left))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=40), st.booleans())
def test_lyndon_arrays(codes, flip):
    assert periodic_runs.lyndon_array(codes, flip) == plain_lyndon(codes, flip)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(1, 2), min_size=1, max_size=60), st.sampled_from([(6, 4), (1, 3), (1, 2)]))
def test_runs_of_binary_words(codes, least):
    assert sorted(periodic_runs.runs_of(np.array(codes), *least)) == sorted(plain_runs(codes, *least))


def test_runs_among_rare_words():
    generator = random.Random(3)
    texts = []
    for _ in range(300):
        codes = [generator.randrange(40) for _ in range(generator.randrange(80))]
        unit = [generator.randrange(5) for _ in range(generator.randrange(1, 9))]
        at = generator.randrange(len(codes) + 1)
        texts.append(codes[:at] + (unit * 9)[: generator.randrange(len(unit) * 8)] + codes[at:])
    found = periodic_runs.runs_of_texts([[b"%d" % c for c in codes] for codes in texts])
    assert found == [plain_runs(codes) for codes in texts]
    assert sum(map(len, found)) > 100


def test_nested_runs_and_ties():
    words = (["a"] * 6 + ["b"]) * 4 + ["c"] + ["d", "e"] * 6
    runs = periodic_runs.runs_of_texts([[w.encode() for w in words]])[0]
    assert runs == [(0, 6, 1), (0, 28, 7), (7, 6, 1), (14, 6, 1), (21, 6, 1), (29, 12, 2)]
    assert periodic_runs.strongest(runs) == (0, 6, 1)
    assert periodic_runs.strongest([(0, 24, 4), (0, 12, 2)]) == (0, 24, 4)
    assert periodic_runs.collapsed([w.encode() for w in words], runs) == b"a b c d e"


def test_whole_text_of_one_long_run():
    codes = np.array([1, 2, 3, 1, 2] * 20_000)
    assert periodic_runs.runs_of(codes) == {(0, 100_000, 5)}


def test_query(spark, sf_dir, texts):
    got = [tuple(r) for r in queries.op11_periodic_runs(spark, sf_dir).collect()]
    assert sorted(got) == sorted(expected(i, t) for i, t in texts)
    assert sum(r[1] for r in got) > 20


@pytest.mark.parametrize("copies", [1, 2])
def test_odd_rows(spark, odd, copies, tmp_path):
    docs = odd
    for _ in range(copies - 1):
        docs = docs.union(odd)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(repr, map(tuple, queries.op11_periodic_runs(spark, str(tmp_path)).collect())))
    assert got == sorted(repr(expected(i, t)) for i, t in ODD * copies)


def test_empty_table(spark, empty, tmp_path):
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op11_periodic_runs(spark, str(tmp_path)).count() == 0
