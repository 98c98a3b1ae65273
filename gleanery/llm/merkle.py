"""Merkle manifest of a table, and the versions that tampering with single leaves would make.

Rows are leaves; the leaves of a scope (a language) ascend by id, every `FANOUT` consecutive nodes have one parent while a
level has several, and the roots of the scopes, in the scopes' order, are the leaves of a tree above them.

The tree is persistent: a changed leaf doesn't change it, but makes a version of it, which copies the leaf's ancestors
and shares every other node with the first version. A version is thus its list of copies (leaf first, root last);
what it shares is in `nodes`.

Leaves meet in aligned blocks of FANOUT ** BLOCK_LEVELS consecutive places, whose nodes are built in one row, so that a
block's versions copy their lowest ancestors from that row alone. Block roots are the leaves of the next round, which
has FANOUT ** BLOCK_LEVELS times fewer rows; its result is the path of every block root up to the top. The path comes
back to the block by a join on the block, whose versions go on along it. No task ever holds more than a block
of leaves or one block's path, however many leaves or versions a scope has.

A null scope is a scope of its own and comes first; null ids come first in their scope. Rows with equal ids are ordered
by their digests, so equal rows may change places, without effect. A table without rows gives no rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.frames import kept, let, ranked

FANOUT = 8
BLOCK_LEVELS = 3
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_digest(fields: list[Column]) -> Column:
    """Digest of a row: each field as its length in bytes, a colon and its value, or as a hyphen if it is null."""
    written = [c.cast("string") for c in fields]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(c), F.lit(":"), c), F.lit("-")) for c in written]))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def leaves(docs: DataFrame, tampered: Column, fields: list[str] = FIELDS, text: str = "text", scope: str = "lang", key: str = "doc_id") -> DataFrame:
    """scope, key, leaf, and the leaf's digest with the text's A-Z lower-cased where `tampered` holds (else null)."""
    changed = [lower_ascii(F.col(c)) if c == text else F.col(c) for c in fields]
    return docs.select(
        F.col(scope).alias("scope"),
        F.col(key).alias("key"),
        leaf_digest([F.col(c) for c in fields]).alias("digest"),
        F.when(tampered, leaf_digest(changed)).alias("changed"),
    )


def placed(rows: DataFrame) -> DataFrame:
    """Add to leaves their scope's number, their place `pos` in it and the number `n` of its leaves; written once."""
    order = kept(ranked(rows, "scope", "key", "digest", "changed"))
    sizes = order.groupBy("scope").agg(F.min("rank").alias("first"), F.count("*").alias("n"))
    scopes = ranked(sizes, "first", name="scope_id").withColumnRenamed("scope", "s")
    joined = order.join(scopes, order["scope"].eqNullSafe(scopes["s"]))
    return kept(joined.select("scope_id", (F.col("rank") - F.col("first")).alias("pos"), "n", "key", "digest", "changed"))


def blocked(nodes: DataFrame, levels: int = BLOCK_LEVELS) -> DataFrame:
    """One row per aligned block: scope_id, block, n, items (the nodes in order) and l0 to l<levels>, its nodes' digests.

    Where the whole scope has one node at some level, that is its root, and the levels above repeat it.
    """
    size = FANOUT**levels
    others = [c for c in nodes.columns if c not in ("scope_id", "n", "pos")]
    blocks = (
        nodes.groupBy("scope_id", F.floor(F.col("pos") / size).alias("block"))
        .agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", *others))).alias("items"))
        .withColumn("l0", F.col("items.digest"))
    )
    for i in range(levels):
        low = F.col(f"l{i}")
        runs = F.sequence(F.lit(0), F.floor((F.size(low) - 1) / FANOUT).cast("int"))
        parents = F.transform(runs, lambda r: digest(F.array_join(F.slice(low, r * FANOUT + 1, FANOUT), "")))
        blocks = blocks.withColumn(f"l{i + 1}", F.when(F.col("n") > FANOUT**i, parents).otherwise(low))
    return kept(blocks)


def steps(place: Column, levels: int = BLOCK_LEVELS) -> Column:
    """From the node at `place` of a block to the block's root: per level, the digests in front of it and behind it."""
    found = []
    for i in range(levels):
        low = F.col(f"l{i}")
        at = F.floor(place / FANOUT**i).cast("int")
        first = F.floor(place / FANOUT ** (i + 1)).cast("int") * FANOUT
        before = F.array_join(F.slice(low, first + 1, at - first), "")
        behind = F.array_join(F.slice(low, at + 2, first + FANOUT - 1 - at), "")
        step = F.struct(before.alias("before"), behind.alias("behind"))
        found.append(F.when(F.col("n") > FANOUT**i, step))
    return F.filter(F.array(*found), lambda s: s.isNotNull())


def block_roots(blocks: DataFrame, levels: int = BLOCK_LEVELS) -> DataFrame:
    n = F.ceil(F.col("n") / FANOUT**levels).cast("long")
    return blocks.select("scope_id", F.col("block").alias("pos"), n.alias("n"), F.col(f"l{levels}")[0].alias("digest"))


def paths(nodes: DataFrame) -> DataFrame:
    """scope_id, pos, path (steps from the node to its scope's root) and root, for nodes scope_id, pos, n, digest.

    One round per BLOCK_LEVELS levels of the largest scope.
    """
    if (nodes.agg(F.max("n")).first()[0] or 0) <= 1:
        path = F.array().cast("array<struct<before:string,behind:string>>")
        return nodes.select("scope_id", "pos", path.alias("path"), F.col("digest").alias("root"))
    blocks = blocked(nodes)
    above = paths(block_roots(blocks)).withColumnRenamed("pos", "block")
    found = F.transform(
        "items",
        lambda x, i: F.struct(x["pos"].alias("pos"), F.concat(steps(i), F.col("path")).alias("path"), F.col("root").alias("root")),
    )
    return kept(blocks.join(above, ["scope_id", "block"]).select("scope_id", F.inline(found)))


def tops(blocks: DataFrame) -> DataFrame:
    """Per block of leaves: scope_id, block, path (from the block's root to the table's root), subroot, root."""
    scoped = kept(paths(block_roots(blocks)).withColumnsRenamed({"pos": "block", "root": "subroot"}))
    subroots = scoped.filter("block = 0").select("scope_id", "subroot")
    n = subroots.count()
    upper = paths(subroots.select(F.lit(0).cast("long").alias("scope_id"), F.col("scope_id").alias("pos"), F.lit(n).cast("long").alias("n"), F.col("subroot").alias("digest")))
    upper = upper.select(F.col("pos").alias("scope_id"), F.col("path").alias("upper"), "root")
    return scoped.join(upper, "scope_id").select("scope_id", "block", F.concat("path", "upper").alias("path"), "subroot", "root")


def copied(start: Column, path: Column) -> Column:
    """Digests from a leaf to the root above it: those of the nodes that a version with this leaf copies."""
    return F.aggregate(
        path,
        F.array(start),
        lambda done, s: F.concat(done, F.array(digest(F.concat(s["before"], F.element_at(done, -1), s["behind"])))),
    )


def audited(rows: DataFrame) -> DataFrame:
    """Per leaf of `leaves`: key, leaf, subroot, root, proof_sha256, version, folded_root, verified.

    `version` holds the digests that the version of a tampered leaf copies, leaf first and root last; it is null for other
    leaves. `folded_root` is recomputed from the leaf (the tampered one, if it is) and its siblings.
    """
    blocks = blocked(placed(rows))

    def result(x: Column, place: Column) -> Column:
        whole = F.concat(steps(place), F.col("path"))

        def told(path: Column) -> Column:
            siblings = F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["behind"])), "")
            copies = copied(F.coalesce(x["changed"], x["digest"]), path)
            return F.struct(digest(siblings).alias("proof_sha256"), copies.alias("copies"))

        return F.struct(x["key"].alias("key"), x["digest"].alias("leaf"), x["changed"].alias("changed"), let(whole, told).alias("t"))

    found = blocks.join(tops(blocks), ["scope_id", "block"]).select("subroot", "root", F.inline(F.transform("items", result)))
    folded = F.element_at("t.copies", -1)
    return found.select(
        "key",
        "leaf",
        "subroot",
        "root",
        "t.proof_sha256",
        F.when(F.col("changed").isNotNull(), F.col("t.copies")).alias("version"),
        folded.alias("folded_root"),
        (folded == F.col("root")).alias("verified"),
    )


def nodes(rows: DataFrame) -> DataFrame:
    """The first version of the scopes' trees: scope_id, level, index, digest. Every version shares these but for its copies."""
    low = placed(rows).select("scope_id", "pos", "n", "digest")
    found = low.select("scope_id", F.lit(0).alias("level"), F.col("pos").alias("index"), "digest")
    level = 0
    while (low.agg(F.max("n")).first()[0] or 0) > 1:
        blocks = blocked(low)
        for i in range(1, BLOCK_LEVELS + 1):
            part = (
                blocks.filter(F.col("n") > FANOUT ** (i - 1))
                .select("scope_id", "block", F.posexplode(f"l{i}").alias("i", "digest"))
                .select("scope_id", F.lit(level + i).alias("level"), (F.col("block") * FANOUT ** (BLOCK_LEVELS - i) + F.col("i")).alias("index"), "digest")
            )
            found = found.union(part)
        low, level = block_roots(blocks), level + BLOCK_LEVELS
    return found
