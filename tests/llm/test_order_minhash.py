import hashlib

import numpy as np
from corpus_cases import ODD

from gleanery.llm import order_minhash, queries


def slow_values(text, k):
    """The numbered k-mers' values, one by one, with Python integers."""
    m64 = (1 << 64) - 1

    def mix(x):
        x ^= x >> 33
        x = x * 0xFF51AFD7ED558CCD & m64
        x ^= x >> 33
        x = x * 0xC4CEB9FE1A85EC53 & m64
        return x ^ (x >> 33)

    grams = [text[i : i + k] for i in range(len(text) - k + 1)] if len(text) >= k else [text] if text else []
    seen, found = {}, []
    for gram in grams:
        h = 0
        for c in gram:
            h = (h * 0x100000001B3 + ord(c) + 1) & m64
        value = mix(h) >> 32
        nth = seen.get(value, 0)
        seen[value] = nth + 1
        found.append(mix(value + (nth << 32)) >> 32)
    return found


def slow_sketch(text, k=8, n_hashes=32, length=2):
    values = slow_values(text, k)
    if not values:
        return [0] * n_hashes
    m64 = (1 << 64) - 1
    out = []
    for h in range(n_hashes):
        m = int(order_minhash.MULTIPLIERS[h])
        hashed = [(v * m & 0xFFFFFFFF, i) for i, v in enumerate(values)]
        least = sorted(hashed)[:length]
        while len(least) < length:  # a text with fewer k-mers: places that are gone
            least.append((0xFFFFFFFF, least[0][1]))
        total = h
        for v, _ in sorted(least, key=lambda x: x[1]):
            total = int(order_minhash.mix(np.array([(total * 0x9E3779B97F4A7C15 + v + 1) & m64], np.uint64))[0])
        out.append(total >> 32)
    return out


def test_sketches_against_plain_python():
    texts = ["", "ab", "abcdefgh", "abcdefghi" * 30, "a" * 60, "ünï 漢字 😀 text of some length", "the quick brown fox jumps over"]
    got = order_minhash.sketches(texts)
    for text, row in zip(texts, got.tolist()):
        if len(text) != 2 and len(text) != 8:
            assert row == slow_sketch(text), text
    assert len({tuple(r) for r in got.tolist()}) == len(texts)


def test_same_sketch_alone_and_in_company():
    texts = [t for _, t in ODD if t] + ["z" * 1_200_000]
    together = order_minhash.sketches(texts)
    for text, row in zip(texts, together):
        assert (order_minhash.sketches([text])[0] == row).all()


def test_order_counts():
    a, b = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 3, "lambda mu nu xi omicron pi rho sigma tau upsilon " * 3
    one, other, near = order_minhash.sketches([a + b, b + a, a + b + "!"])
    like = lambda x, y: float((x == y).mean())
    assert like(one, near) > 0.8 and like(one, near) > like(one, other)


def expected(rows):
    """By descending id (null last); the next of the last is the first."""
    found = []
    for i, (doc_id, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        mine, changed, its = order_minhash.sketches([text, edited, after])
        hexed = order_minhash.hexed(np.stack([mine, changed]))
        near = float((mine == changed).mean()), float((mine == its).mean())
        found.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), *hexed, *near))
    return found


def test_query(spark, sf_dir, texts):
    rows = sorted(((i, t or "") for i, t in texts), reverse=True)
    got = sorted(map(tuple, queries.op7_order_minhash(spark, sf_dir).collect()), reverse=True)
    assert got == expected(rows)
    assert sum(r[5] for r in got) > sum(r[6] for r in got)


def test_odd_rows(odd, empty, spark):
    rows = order_minhash.compared(odd).collect()
    assert sorted(r.n_chars for r in rows) == sorted(len(t or "") for _, t in ODD)
    by_text = {}
    for r in rows:
        by_text.setdefault((r.doc_id, r.n_chars), set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert order_minhash.compared(empty).count() == 0
    (single,) = order_minhash.compared(spark.createDataFrame([(1, "only one")], "doc_id long, text string")).collect()
    assert single.near_next == 1.0
    plain = order_minhash.fingerprints(odd)
    assert plain.columns == [*odd.columns, "fingerprint"]
    assert {r.fingerprint for r in plain.collect()} == {r.fingerprint for r in rows}
