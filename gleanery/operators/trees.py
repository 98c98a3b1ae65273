"""A decision tree over the presence of terms, grown level by level.

One aggregate a level counts, for all open nodes together, the labels of the documents with each term; those without it
follow from the nodes' totals. A node splits on the term that leaves the fewest errors (ties: the first term), if that is
fewer than its own. Nodes are numbered as in a heap: the documents of node i without its term go to 2i, those with it to 2i + 1.

A document's terms lie in one row, which goes down the tree so far by itself: the splits are a single value of at most
2^depth entries. Terms are shuffled once, to meet their document; a level shuffles counts only.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.sources.tables import ensure_checkpoint_dir


def _most(columns: list) -> Column:
    return F.greatest(*columns) if len(columns) > 1 else columns[0]


def _by_node(nodes: DataFrame, *columns: str) -> Column:
    """What each node has in these columns, as one value."""
    return nodes.agg(F.map_from_entries(F.collect_list(F.struct("node", F.struct(*columns))))).scalar()


def _with_terms(rows: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Add each row's terms as one list; a term that `present` repeats for a key is repeated there."""
    terms = present.groupBy(F.col(key).alias("_key")).agg(F.collect_list("term").alias("_terms"))
    found = rows.join(terms, rows[key] == terms["_key"], "left").drop("_key")
    return found.withColumn("_terms", F.coalesce("_terms", F.array().cast("array<string>")))


def _placed(splits: str, depth: int) -> Column:
    """The node that a row comes to, and how many rows it stands for there: as many as joins with its split terms make of it."""

    def step(at: Column, _) -> Column:
        term = F.col(splits)[at["node"]]["term"]
        times = F.size("_terms") - F.size(F.array_remove("_terms", term))
        below = F.struct(
            (2 * at["node"] + F.least(times, F.lit(1))).alias("node"), (at["weight"] * F.greatest(times, F.lit(1))).alias("weight")
        )
        return F.when(term.isNull(), at).otherwise(below)

    root = F.struct(F.lit(1).alias("node"), F.lit(1).cast("long").alias("weight"))
    if depth == 0:
        return root
    return F.aggregate(F.array_repeat(F.lit(0), depth), root, step)


def grow(present: DataFrame, rows: DataFrame, key: str, label: str, depth: int = 4, support: int = 10) -> DataFrame:
    """node, term (null at a leaf), predicted, n, errors.

    Nodes of at most `support` documents, without errors, or at `depth` are leaves. `present` has a row for each distinct term
    of a document, `rows` all documents. The labels, which are few, are all that reaches the driver.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    labels = [r[0] for r in rows.select(label).distinct().orderBy(label).collect()]
    names = F.array(*[F.lit(name) for name in labels])
    of_label = lambda name: F.coalesce(F.sum(F.when(F.col("label") == name, F.col("weight"))), F.lit(0))
    counts = [of_label(name).alias(f"n{i}") for i, name in enumerate(labels)]
    n_columns = [F.col(f"n{i}") for i in range(len(labels))]
    documents = _with_terms(rows.select(key, F.col(label).alias("label")), present, key).select("label", "_terms").checkpoint()
    found = splits = None
    for level in range(depth + 1):
        placed = documents if splits is None else documents.withColumn("_splits", _by_node(splits, "term"))
        placed = placed.withColumn("at", _placed("_splits", level)).select("label", "_terms", "at.node", "at.weight")
        totals = (
            placed.where(F.col("node") >= 2**level)
            .groupBy("node")
            .agg(F.sum("weight").alias("n"), *counts)
            .withColumn("errors", F.col("n") - _most(n_columns))
            .withColumn("predicted", F.element_at(names, F.array_position(F.array(*n_columns), _most(n_columns)).cast("int")))
            .checkpoint()
        )
        open_nodes = totals.where((F.col("n") > support) & (F.col("errors") > 0) & F.lit(level < depth))
        of_node = _by_node(open_nodes, "n", "errors", *[f"n{i}" for i in range(len(labels))])[F.col("node")]
        with_term = (
            placed.select("label", "node", "weight", F.explode(F.when(of_node.isNotNull(), F.col("_terms"))).alias("term"))
            .groupBy("node", "term")
            .agg(F.sum("weight").alias("m"), *[c.alias(f"m{i}") for i, c in enumerate(counts)])
            .withColumn("of", of_node)
        )
        inside = [F.col(f"m{i}") for i in range(len(labels))]
        outside = [F.col(f"of.n{i}") - F.col(f"m{i}") for i in range(len(labels))]
        left = (F.col("m") - _most(inside)) + (F.col("of.n") - F.col("m") - _most(outside))
        best = (
            with_term.withColumn("left", left)
            .where(F.col("left") < F.col("of.errors"))
            .groupBy("node")
            .agg(F.min(F.struct("left", "term")).alias("best"))
            .select("node", "best.term")
            .checkpoint()
        )
        nodes = totals.join(best, "node", "left").select("node", "term", "predicted", "n", "errors")
        found = nodes if found is None else found.unionByName(nodes)
        if not best.count():
            break
        splits = best if splits is None else splits.unionByName(best)
    return found


def classify(tree: DataFrame, present: DataFrame, rows: DataFrame, key: str, depth: int = 4) -> DataFrame:
    """Add `predicted`: each document goes down from the root by its terms; only those that the tree asks for are looked at."""
    asked = tree.agg(F.collect_set("term")).scalar()
    documents = _with_terms(rows, present.where(F.array_contains(asked, F.col("term"))), key)
    at = documents.withColumn("_splits", _by_node(tree, "term")).withColumn("_at", _placed("_splits", depth))
    found = at.withColumn("_leaf", _by_node(tree, "term", "predicted")[F.col("_at.node")])
    # A document that comes to no leaf of the tree has no prediction.
    copies = F.when(
        F.col(key).isNotNull() & F.col("_leaf").isNotNull() & F.col("_leaf.term").isNull(), F.array_repeat(F.lit(0), F.col("_at.weight").cast("int"))
    )
    return found.withColumn("_copy", F.explode(copies)).select(*rows.columns, F.col("_leaf.predicted").alias("predicted"))
