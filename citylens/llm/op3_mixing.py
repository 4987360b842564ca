"""Mixing sources to target weights by hierarchical budgeting (DataFrame functions only).

The tree has a level per column (domain, language, source).  A token budget is
filled from the root down: children share their parent's budget by weight; a
child whose subtree cannot supply its share (its tokens times ``max_epochs``)
gives all it has and its siblings share the rest by weight, and only what all
siblings together cannot supply is missing at the parent, whose own siblings
have already taken it, since a parent's share is bounded by its subtree.  With
children in the order of supply per weight, the common level of the children
that are not exhausted is the largest (budget - supply before) / (weight from
here on), so one window per level solves it exactly, in whole tokens (less than
one token a node is lost to rounding down).

A leaf's budget is spent on whole epochs and then on a prefix of the next
epoch, in which documents come in the order of md5(seed:leaf epoch:id).  The
prefix is found in two steps: token sums of about sqrt(rows) ranges of the
hash give the range in which the budget ends, and only that range's rows are
ordered, so a leaf with a third of all rows is never one task's work.

Defined results: a NULL or wordless text has no token and is never taken; NULL
levels read as ``(none)``; a NULL id hashes as empty; nodes without a listed
weight have weight 1, nodes of weight 0 get nothing; equal hashes are ordered
by id and tokens; repeated rows each count; an empty table or budget gives none.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citylens.llm.common import materialise, text_or_empty

SEED = 20240601
MAX_EPOCHS = 4
HASH_BITS = 52

# The recipe of the registered query.  Paths are level values joined by "/".
WEIGHTS = {"d0": 4, "d1": 3, "d2": 2, "d3": 1,
           "d0/en": 4, "d0/de": 2, "d0/fr": 2, "d1/en": 3, "d1/es": 2, "d2/en": 2, "d3/en": 2}


def n_tokens(text_col: str = "text") -> Column:
    """Runs of characters other than space and \\x09-\\x0D."""
    return F.regexp_count(text_or_empty(text_col), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def source_domain(source_col: str = "source") -> Column:
    """Domain of a source: its trailing number modulo 4 (``d-other`` without one)."""
    number = F.regexp_extract(F.coalesce(F.col(source_col), F.lit("")), r"([0-9]{1,9})$", 1)
    return F.when(number == "", F.lit("d-other")).otherwise(F.concat(F.lit("d"), (number.cast("bigint") % 4).cast("string")))


def _weight(path: list[str], weights: Mapping[str, int]) -> Column:
    if not weights:
        return F.lit(1).cast("bigint")
    listed = F.create_map(*[F.lit(x) for k, v in weights.items() for x in (k, int(v))])
    return F.coalesce(F.element_at(listed, F.concat_ws("/", *path)), F.lit(1)).cast("bigint")


def _fill(nodes: DataFrame, parent: list[str], name: str, budget: Column) -> DataFrame:
    """Add ``share``: the node's part of its parent's ``budget``, bounded by its ``supply``."""
    siblings = Window.partitionBy(*parent)
    by_need = siblings.orderBy(F.col("supply") / F.col("weight"), F.col(name))
    before = F.coalesce(F.sum("supply").over(by_need.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    return (nodes.where("weight > 0 and supply > 0").withColumn("level", (budget - before) / rest)
            .withColumn("level", F.max("level").over(siblings))
            .withColumn("share", F.greatest(F.lit(0), F.least("supply", F.floor(F.col("level") * F.col("weight")))).cast("bigint"))
            .drop("level"))


def allocate(leaves: DataFrame, levels: list[str], budget: Column, weights: Mapping[str, int], max_epochs: int) -> DataFrame:
    """``leaves(levels, rows, tokens)`` -> with ``share``, the leaf's token budget."""
    supply = leaves.withColumn("supply", F.col("tokens") * max_epochs)
    above: DataFrame | None = None
    for i, name in enumerate(levels):
        path = levels[:i + 1]
        nodes = supply.groupBy(*path).agg(F.sum("supply").alias("supply")).withColumn("weight", _weight(path, weights))
        if above is None:
            above = _fill(nodes, [F.lit(0)], name, budget).select(*path, F.col("share").alias("given"))
        else:
            above = _fill(nodes.join(above, levels[:i]), levels[:i], name, F.col("given")).select(*path, F.col("share").alias("given"))
    return leaves.join(above.withColumnRenamed("given", "share"), levels)


def mix(docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[str, int], budget_tokens: int | None = None,
        max_epochs: int = MAX_EPOCHS, seed: int = SEED, id_col: str = "doc_id", tokens_col: str = "n_tokens") -> DataFrame:
    """Selected rows of ``docs``, once per epoch: all columns, the levels as ``mix_<name>``,
    ``mix_epoch`` (from 0) and ``mix_take_tokens`` (the document's first tokens that count).
    Names that begin with ``mix_`` (in any case) are the operator's own: such columns of ``docs`` are replaced.

    ``docs`` has its token count in ``tokens_col``; ``budget_tokens`` defaults to all its tokens.
    """
    names = [f"mix_{n}" for n in levels]
    own = [c for c in docs.columns if c.lower().startswith("mix_") and c != tokens_col]
    docs = docs.drop(*own)
    placed = docs.withColumns({f"mix_{n}": F.coalesce(c.cast("string"), F.lit("(none)")) for n, c in levels.items()}
                              ).where(F.col(tokens_col) > 0)
    leaves = placed.groupBy(*names).agg(F.count("*").alias("rows"), F.sum(tokens_col).alias("tokens"))
    budget = F.lit(budget_tokens).cast("bigint")
    if budget_tokens is None:
        leaves = leaves.withColumn("budget", F.sum("tokens").over(Window.partitionBy(F.lit(0))))
        total = materialise(leaves, "mix-leaves")
        leaves, budget = total.drop("budget"), F.lit((total.agg(F.max("budget")).first() or [0])[0] or 0).cast("bigint")
    plan = allocate(leaves, names, budget, weights, max_epochs).select(
        *names, F.expr("share div tokens").alias("mix_full"), F.expr("share % tokens").alias("mix_rest"),
        F.least(F.lit(30), F.ceil(F.log2(F.sqrt("rows")))).cast("int").alias("mix_bits"))
    plan = materialise(plan, "mix-plan")

    ahead = F.md5(F.concat_ws(":", F.lit(str(seed)), F.concat_ws("/", *names), F.col("mix_full").cast("string"),
                              F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    top = F.conv(F.substring("mix_hash", 1, HASH_BITS // 4), 16, 10).cast("bigint")
    ranged = (placed.join(plan, names).withColumn("mix_hash", ahead)
              .withColumn("mix_range", F.call_function("shiftright", top, F.lit(HASH_BITS) - F.col("mix_bits"))))
    ranges = ranged.where("mix_rest > 0").groupBy(*names, "mix_rest", "mix_range").agg(F.sum(tokens_col).alias("t"))
    until = F.sum("t").over(Window.partitionBy(*names).orderBy("mix_range").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ends = (ranges.withColumn("until", until).where("until - t < mix_rest and until >= mix_rest")
            .select(*names, F.col("mix_range").alias("mix_end"), F.expr("mix_rest - (until - t)").alias("mix_end_rest")))
    cut = ranged.join(materialise(ends, "mix-ends"), names, "left")

    out = [*docs.columns, *names, "mix_epoch", "mix_take_tokens"]
    last = F.when(F.col("mix_range") < F.col("mix_end"), F.col("mix_full")).otherwise(F.col("mix_full") - 1)
    whole = (cut.withColumn("mix_last", last).where("mix_last >= 0")
             .withColumn("mix_epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("mix_last"))))
             .withColumn("mix_take_tokens", F.col(tokens_col)))
    in_order = Window.partitionBy(*names).orderBy("mix_hash", id_col, tokens_col).rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("mix_end_rest") - F.coalesce(F.sum(tokens_col).over(in_order), F.lit(0))
    edge = (cut.where("mix_range = mix_end").withColumn("mix_left", left).where("mix_left > 0")
            .withColumn("mix_epoch", F.col("mix_full")).withColumn("mix_take_tokens", F.least(tokens_col, "mix_left")))
    return whole.select(*out).unionByName(edge.select(*out))


def document_levels() -> dict[str, Column]:
    """Domain, language and source of ``documents``."""
    return {"domain": source_domain(), "lang": F.col("lang"), "source": F.col("source")}


def mix_documents(docs: DataFrame, weights: Mapping[str, int] = WEIGHTS) -> DataFrame:
    """Pipeline form: ``documents`` columns of the selected rows, with ``mix_epoch`` and ``mix_take_tokens``."""
    counted = docs.withColumn("mix_n_tokens", n_tokens())
    got = mix(counted, document_levels(), weights, tokens_col="mix_n_tokens")
    return got.select(*[c for c in docs.columns if not c.lower().startswith("mix_")], "mix_epoch", "mix_take_tokens")
