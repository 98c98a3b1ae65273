"""Reply trees to formatted conversations.

Messages form trees by their parents. Root-to-leaf paths are enumerated by iterative self-joins: each round doubles
the distance that a table of ancestors reaches, so a tree of depth d takes log2(d) rounds. Paths are ranked within
their tree by the sum of their messages' scores (ties by leaf), and each chosen one is formatted as one conversation.

    <turn>### role: text</turn>

A backslash is put in front of every backslash and control string of a role or text, so whatever a text holds, the
turns can be read back. The loss mask is a list of spans (code points, end exclusive), one for each assistant text.

A null text or role counts as empty, a parent that does not exist as none. Of rows that repeat an id in a tree the
smallest by parent, role and text counts. Messages whose ancestors run in a circle have no root and make no path.
"""

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleanery.llm.frames import kept

CONTROL = re.compile(r"\\|</?turn>|### ")
ROLE_CONTROL = re.compile(r"\\|</?turn>|### |:")
ESCAPE = re.compile(r"\\(.)", re.DOTALL)
TURN = re.compile(r"<turn>### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL)


def escaped(text: str, control: re.Pattern = CONTROL) -> str:
    return control.sub(lambda m: "\\" + m.group(), text)


def unescaped(text: str) -> str:
    return ESCAPE.sub(r"\1", text)


def formatted(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """A conversation, and the spans of its assistant texts."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"<turn>### {escaped(role, ROLE_CONTROL)}: ", escaped(text)
        at += len(head)
        if role == "assistant":
            spans.append((at, at + len(body)))
        at += len(body) + len("</turn>\n")
        parts += [head, body, "</turn>\n"]
    return "".join(parts), spans


def read_back(conversation: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(conversation):
        m = TURN.match(conversation, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        turns.append((unescaped(m[1]), unescaped(m[2])))
        at = m.end()
    return turns


def paths(messages: DataFrame) -> DataFrame:
    """Root-to-leaf paths of messages (tree, id, parent): one row (tree, leaf, id, up) for each message of each path,
    `up` steps above its leaf."""
    nodes = messages.select("tree", "id", "parent")
    known = nodes.select("tree", F.col("id").alias("parent"))
    same_parent = F.expr("n.tree <=> k.tree AND n.parent = k.parent")
    jump = kept(
        nodes.alias("n").join(known.alias("k"), same_parent).select("n.tree", "n.id", F.col("n.parent").alias("to"))
    )
    roots = nodes.alias("n").join(jump.alias("j"), F.expr("n.tree <=> j.tree AND n.id = j.id"), "left_anti")
    leaves = nodes.alias("n").join(jump.alias("j"), F.expr("n.tree <=> j.tree AND n.id = j.to"), "left_anti")
    reached = kept(leaves.select("tree", F.col("id").alias("leaf"), "id", F.lit(0).cast("long").alias("up")))
    step, most = 1, nodes.count()
    while step <= most and not jump.isEmpty():
        further = (
            reached.alias("r")
            .join(jump.alias("j"), F.expr("r.tree <=> j.tree AND r.id = j.id"))
            .select("r.tree", "r.leaf", F.col("j.to").alias("id"), (F.col("r.up") + step).alias("up"))
        )
        reached = kept(reached.union(further))
        second = jump.alias("b")
        jump = kept(
            jump.alias("a")
            .join(second, F.expr("a.tree <=> b.tree AND a.to = b.id"))
            .select("a.tree", "a.id", F.col("b.to").alias("to"))
        )
        step *= 2
    rooted = reached.alias("r").join(roots.alias("o"), F.expr("r.tree <=> o.tree AND r.id = o.id"), "left_semi")
    ends = rooted.select("tree", "leaf")
    return reached.alias("r").join(ends.alias("e"), F.expr("r.tree <=> e.tree AND r.leaf = e.leaf"), "left_semi")


def conversations(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """Formatted conversations of messages (tree, id, parent, role, text, score): tree, leaf, score, rank, text, loss.

    `branches` keeps that many of the best-ranked paths of each tree; without it every path is formatted.
    """
    one = F.min(F.struct("parent", "role", "text", "score")).alias("m")
    messages = kept(
        messages.filter("id IS NOT NULL")
        .select("tree", "id", "parent", *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")], "score")
        .groupBy("tree", "id")
        .agg(one)
        .select("tree", "id", "m.*")
    )
    on_path = (
        paths(messages)
        .alias("p")
        .join(messages.alias("m"), F.expr("p.tree <=> m.tree AND p.id = m.id"))
        .select("p.tree", "p.leaf", "p.up", "m.role", "m.text", F.coalesce("m.score", F.lit(0.0)).alias("score"))
    )
    if branches is not None:
        scores = on_path.groupBy("tree", "leaf").agg(F.sum("score").alias("score"))
        place = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "leaf"))
        best = scores.withColumn("place", place).filter(F.col("place") <= branches)
        chosen = F.expr("p.tree <=> b.tree AND p.leaf = b.leaf")
        on_path = on_path.alias("p").join(best.alias("b"), chosen, "left_semi")
    turn = F.struct((-F.col("up")).alias("place"), "role", "text")
    whole = on_path.groupBy("tree", "leaf").agg(
        F.sum("score").alias("score"), F.array_sort(F.collect_list(turn)).alias("turns")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns = batch.column("turns").to_pylist()
            made = [formatted([(t["role"], t["text"]) for t in ts]) for ts in turns]
            spans = [[{"start": a, "end": b} for a, b in m[1]] for m in made]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns = [batch.column(c) for c in ("tree", "leaf", "score")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([m[0] for m in made], pa.string()), pa.array(spans, kind)],
                ["tree", "leaf", "score", "text", "loss"],
            )

    return whole.mapInArrow(run, "tree long, leaf long, score double, text string, loss array<struct<start:long,end:long>>")


def linear(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as trees without branches: each row answers the one before it.

    Rows that share a turn follow one another by role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    place = F.row_number().over(order).cast("long")
    return rows.select(
        F.col("conv_id").cast("long").alias("tree"),
        place.alias("id"),
        F.when(place > 1, place - 1).alias("parent"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )


def parsed(chats: DataFrame) -> DataFrame:
    """Read formatted conversations back: tree, n_turns, turns (role and text, a line each), loss_text, n_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column("text").to_pylist(), batch.column("loss").to_pylist()
            turns = [read_back(t) for t in texts]
            lost = ["".join(unescaped(t[s["start"] : s["end"]]) for s in ss) for t, ss in zip(texts, spans)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("tree"),
                    pa.array([len(t) for t in turns], pa.int64()),
                    pa.array(["".join(f"{role}\n{text}\n" for role, text in t) for t in turns], pa.string()),
                    pa.array(lost, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["tree", "n_turns", "turns", "loss_text", "n_chars"],
            )

    return chats.mapInArrow(run, "tree long, n_turns long, turns string, loss_text string, n_chars long")
