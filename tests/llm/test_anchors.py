import hashlib
import random

from corpus_cases import ODD, WORD

from gleanery.llm import anchors, queries


def expected(rows, size=20):
    """Per row in order of id (null last) and text: words, words removed, words kept."""
    import zlib

    seen, found = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, zlib.crc32((r[1] or "").encode()))):
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - size + 1):
            window = tuple(words[i : i + size])
            if window in seen:
                gone[i : i + size] = [True] * size
            seen.add(window)
        found.append((doc_id, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return found


def key(row):
    return row[0] is None, row[0] or 0, row[1:]


def test_odd_rows(odd, empty):
    got = anchors.without_repeats(odd)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected(ODD), key=key)
    assert anchors.without_repeats(empty).count() == 0


def test_shifted_and_overlapping_repeats(spark):
    draw = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(120):
        start = draw.randrange(380)
        passage = words[start : start + draw.randrange(15, 60)]
        rows.append((i, " ".join(["x" * draw.randrange(1, 5) for _ in range(draw.randrange(13))] + passage + [f"end{i}"])))
    rows += [(200, "again " * 45), (201, "again " * 21), (202, "\t".join(words[10:29]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = anchors.without_repeats(docs)
    assert sorted(map(tuple, got.collect())) == expected(rows)
    small = anchors.without_repeats(docs, size=7)
    assert sorted(map(tuple, small.collect())) == expected(rows, 7)


def test_query(spark, sf_dir, texts):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op5_anchors(spark, sf_dir).collect()}
    want = {i: (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in expected(texts)}
    assert got == want
