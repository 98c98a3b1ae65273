"""Secrets in texts: fixed rules, and a character convolutional network over every other candidate.

The rules find assignments, access keys and long hexadecimal strings. A candidate is a run of 16 or more characters of
those that secrets are written in. Candidates that a rule's span touches are the labelled findings, the others the
counterexamples; what no span covers of a touched run, if it has 16 characters itself, is a candidate to score that has
no label. Runs of more than PIECE characters are seen, in training too, in pieces that overlap by half, and score as
their best piece: a window is bounded, whatever the text. Shorter runs than 16 are left to the rules.

A network is trained on one half of all labelled pieces, by a hash of id and place, with the text around each: the pieces
are dealt into shards of some SHARD of the larger class, every shard goes on from the same weights for an epoch, and the
shards' weights are averaged. A class with fewer pieces is repeated, so that each shard has some LEAST of it, or all. On all
pieces of the other half the network is calibrated and given the highest threshold that keeps the recall of the findings.
Candidates outside the rules' spans that reach it are added.

A null text has no spans. With too few findings to show the recall, nothing is added. Rows that repeat an id are
scanned one by one. Spans count code points and exclude their end.
"""

import copy
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.char_cnn import CharNet, misses_allowed
from gleanery.llm.frames import kept, ranked

ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
KINDS = ["assign", "access", "hex", "network"]
LEAST_ASSIGNED = 6
LEAST_CANDIDATE = 16
PIECE = 256
CONTEXT = 24
OPEN, FINDING, REST = 0, 1, 2
SHARD = 1000
LEAST = 200
EPOCHS = 4
ADDED = 16
ROWS = 1000


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the rules' findings, in order. A match that fails its length still uses up its text."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int, str]]:
    """(start, end, label, start and end of a piece of it, the piece and its context) of every piece of a candidate."""
    found, at = [], 0
    far = []  # the furthest end of the spans up to each
    for _, _, end in spans:
        far.append(max(end, far[-1] if far else 0))

    def add(start: int, end: int, label: int) -> None:
        for a in range(start, max(start + 1, end - PIECE // 2), PIECE // 2) if end - start > PIECE else (start,):
            b = min(a + PIECE, end)
            found.append((start, end, label, a, b, text[max(0, a - CONTEXT) : b + CONTEXT]))

    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while at < len(spans) and spans[at][0] < end:
            at += 1
        first = at
        while first > 0 and far[first - 1] > start:
            first -= 1
        if first == at:
            add(start, end, OPEN)
            continue
        add(start, end, FINDING)
        covered = start
        for a, _, b in [*spans[first:at], (end, 0, end)]:
            if a - covered >= LEAST_CANDIDATE:
                add(covered, a, REST)
            covered = max(covered, b)
    return found


def scanned(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc, the rules' spans, all candidates; the one pass over the texts."""
    span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
    numbers = [(c, pa.int64()) for c in ("start", "end", "label", "first", "last")]
    candidate = pa.struct([*numbers, ("window", pa.string())])
    names = [c for c, _ in numbers] + ["window"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                spans, found = [], []
                for body in part.column(text).to_pylist():
                    mine = rule_spans(body or "")
                    spans.append([dict(zip(("start", "kind", "end"), s)) for s in mine])
                    found.append([dict(zip(names, c)) for c in candidates(body or "", mine)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(key).cast(pa.int64()), pa.array(spans, pa.list_(span)), pa.array(found, pa.list_(candidate))],
                    ["doc", "spans", "candidates"],
                )

    schema = (
        "doc long, spans array<struct<start:long,kind:int,end:long>>, "
        "candidates array<struct<start:long,end:long,label:long,first:long,last:long,window:string>>"
    )
    return docs.select(key, text).mapInArrow(run, schema)


def placed(start: int, end: int, window: str) -> tuple[str, int, int]:
    """A window with the piece's place in it: its context in front is cut short only by the start of the text."""
    before = min(start, CONTEXT)
    return window, before, before + end - start


def _epoch(net: CharNet, fit: DataFrame, epoch: int) -> None:
    """One epoch over all shards of (shard, label, h, doc, first, last, window); the driver gets at most ADDED sums of weights."""

    def train(key: tuple, group: pa.Table) -> pa.Table:
        shard, mine = key[0].as_py(), copy.deepcopy(net)
        rows = sorted(group.to_pylist(), key=lambda r: (r["label"], r["h"], r["doc"] or 0, r["first"], r["last"], r["window"]))
        labels, steps = np.array([r["label"] for r in rows], float), 0
        if 0 < labels.sum() < len(labels):
            steps = mine.train([placed(r["first"], r["last"], r["window"]) for r in rows], labels, np.random.default_rng([11, epoch, shard]))
        made = {"shard": [shard], "steps": [steps], "state": [mine.state().tobytes()]}
        return pa.table(made, pa.schema([("shard", pa.int64()), ("steps", pa.int64()), ("state", pa.binary())]))

    def added(key: tuple, group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("shard").to_numpy())
        states = [np.frombuffer(group.column("state")[int(i)].as_buffer(), float) for i in order]
        made = {"part": [key[0].as_py()], "steps": [max(group.column("steps").to_pylist())], "n": [len(order)], "state": [sum(states).tobytes()]}
        return pa.table(made, pa.schema([("part", pa.int64()), ("steps", pa.int64()), ("n", pa.int64()), ("state", pa.binary())]))

    states = fit.groupBy("shard").applyInArrow(train, "shard long, steps long, state binary").where("steps > 0")
    parts = states.withColumn("part", F.col("shard") % ADDED).groupBy("part")
    found = sorted(parts.applyInArrow(added, "part long, steps long, n long, state binary").collect(), key=lambda r: r.part)
    if found:
        net.restore(sum(np.frombuffer(r.state) for r in found) / sum(r.n for r in found))
        net.steps += max(r.steps for r in found)


def _trained(net: CharNet, fit: DataFrame) -> None:
    for epoch in range(EPOCHS):
        _epoch(net, fit, epoch)


def _scored(net: CharNet, held: DataFrame) -> DataFrame:
    """label and z, the network's plain logit, of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.clip(net.scores([placed(r["first"], r["last"], r["window"]) for r in batch.to_pylist()]), 1e-9, 1 - 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(np.log(p / (1 - p)))], ["label", "z"])

    return held.select("label", "first", "last", "window").mapInArrow(run, "label long, z double")


def fitted(found: DataFrame, recall: float = 0.9, level: float = 0.05) -> CharNet:
    """A network trained, calibrated and given its threshold on all labelled pieces."""
    each = found.select("doc", F.inline("candidates")).where(F.col("label").isin(OPEN, FINDING))
    each = kept(each.withColumn("h", F.xxhash64("doc", "first", "window")).withColumn("held", F.col("h").bitwiseAND(1) == 1))
    n = {(r.label, r.held): r["count"] for r in each.groupBy("label", "held").count().collect()}
    net = CharNet()
    if min(sum(n.get((c, held), 0) for held in (False, True)) for c in (OPEN, FINDING)) < 10 or min(n.get((c, h), 0) for c in (OPEN, FINDING) for h in (False, True)) < 1:
        return net
    shards = max(n[c, False] for c in (OPEN, FINDING)) // SHARD + 1
    copies = {c: min(shards, -(-LEAST * shards // n[c, False])) for c in (OPEN, FINDING)}
    nth = F.explode(F.sequence(F.lit(0), F.when(F.col("label") == OPEN, copies[OPEN]).otherwise(copies[FINDING]) - 1))
    dealt = each.where("NOT held").withColumn("nth", nth)
    # Copies go to shards in a row, from one that a hash draws on; so none meets another.
    start = F.pmod(F.xxhash64(F.lit("shard"), "h"), F.lit(shards))
    _trained(net, kept(dealt.withColumn("shard", (start + F.col("nth")) % shards).drop("nth", "held")))

    scored = kept(_scored(net, each.where("held")))
    good, bad = n[FINDING, True], n[OPEN, True]
    target = F.when(F.col("label") == FINDING, (good + 1) / (good + 2)).otherwise(1 / (bad + 2))

    def sums(a: float, b: float) -> np.ndarray:
        z = F.col("z")
        q = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), a * z + b))))
        rows = scored.select("z", (q - target).alias("g"), F.greatest(q * (1 - q), F.lit(1e-9)).alias("w"))
        return np.array(rows.agg(F.sum(F.col("g") * z), F.sum("g"), F.sum(F.col("w") * z * z), F.sum(F.col("w") * z), F.sum("w")).first(), float)

    net.calibrate(sums)
    misses = misses_allowed(good, recall, level)
    if misses >= 0:
        # The calibrated score is taken as `scores` takes it, of the finding whose place among all is the last that may be missed.
        order = F.col("z") if net.slope >= 0 else -F.col("z")
        z = ranked(scored.where(F.col("label") == FINDING).select(order.alias("z")), "z").where(F.col("rank") == misses).first().z
        z = z if net.slope >= 0 else -z
        net.threshold = float(1 / (1 + np.exp(-np.clip(net.slope * z + net.offset, -30, 30))))
    return net


def with_found(scans: DataFrame, net: CharNet) -> DataFrame:
    """Add to the rules' spans the candidates that the network passes; spans are ordered by start and kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[tuple(s.values()) for s in row] for row in batch.column("spans").to_pylist()]
            rows = enumerate(batch.column("candidates").to_pylist())
            unknown = [(i, c) for i, row in rows for c in row if c["label"] != FINDING]
            scores = net.scores([placed(c["first"], c["last"], c["window"]) for _, c in unknown])
            base = [list(row) for row in spans]
            passed = {(i, c["start"], c["end"]) for (i, c), score in zip(unknown, scores) if score >= net.threshold}
            for i, start, end in passed:
                spans[i].append((start, len(KINDS) - 1, end))
            named = lambda row: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(row))
            counts = [pa.array([sum(s[1] == k for s in row) for row in base], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), *counts, pa.array(map(named, base), pa.string()), pa.array(map(named, spans), pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base", "spans"],
            )

    return scans.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base string, spans string")


def secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base and spans, as kind:start:end joined by commas."""
    found = kept(scanned(docs, key, text))
    return with_found(found, fitted(found))
