"""Mixing sources to target weights by hierarchical budgeting, with DataFrame functions only.

Leaves are (domain, language, source). A leaf can give its tokens times ``max_epochs``; the capacity of an
inner node is the sum of its leaves. From the root down, a node's budget is shared among its children by
weight; a child that can not take its share gives the rest to its siblings (water filling, closed form
by one window over the children of each parent). As capacities are known bottom up, a shortage
reaches an ancestor's siblings only when the whole branch is exhausted.

Each leaf then takes a prefix of its tokens: whole passes over all its documents, and of one more pass,
in the seeded order of that epoch, the documents up to the rest. The order is by MD5 of seed, epoch and
document, so the prefix is found in two steps: token sums per hash bucket (partial aggregates, a running
sum over at most 4096 rows per leaf), and an exact running sum only inside the one bucket that is cut.
No leaf is gathered or sorted as a whole.

Defined cases: NULL domain, language or source is a leaf value of its own; NULL and empty texts have no
tokens: they are taken with the pass that their leaf completes, and never in a cut pass; repeated
rows count and are ordered by text digest (fully equal rows arbitrarily, they are interchangeable); an empty
table gives an empty result; extra columns stay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadcast.llm.scratch import materialize

BUCKET_DIGITS = 3  # hexadecimal digits of the order key that make a bucket: 4096 buckets per leaf
BROADCAST_LEAVES = 50_000  # leaves (rows of about 100 bytes) up to which their table is broadcast
LEVELS = ("domain", "lang", "source")


def word_tokens(text: str = "text") -> Column:
    """Number of words: the default measure of a document's tokens."""
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def _share(children: DataFrame, parent: list[str]) -> DataFrame:
    """``budget`` of each child from its parent's ``parent_budget``, by ``weight``, at most ``capacity``.

    Children are ordered by capacity / weight; the level of the water is the first at which the children
    from there on can hold what the smaller ones leave."""
    key = F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight")).otherwise(F.lit(float("inf")))
    order = Window.partitionBy(*parent).orderBy("_ratio", *LEVELS)
    all_ = Window.partitionBy(*parent)
    ranked = children.withColumn("_ratio", key)
    filled = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    at = ranked.withColumn("_level", F.when(open_weight > 0, (F.col("parent_budget") - filled) / open_weight)) \
        .withColumn("_fits", F.when(F.col("_ratio") >= F.col("_level"), F.col("_level")))
    level = F.max("_fits").over(all_)  # NULL: every child is full
    weighted = at.withColumn("_water", level).withColumn("budget", F.when(
        F.col("weight") <= 0, F.lit(0.0)).when(F.col("_water").isNull(), F.col("capacity")).otherwise(
        F.least("capacity", F.col("weight") * F.col("_water"))))
    return weighted.drop("_ratio", "_level", "_fits", "_water")


def leaf_budgets(leaves: DataFrame, budget: float, weights: dict[str, dict[str, float]], max_epochs: int) -> DataFrame:
    """``leaves(domain, lang, source, supply)`` with ``target`` (whole tokens). ``weights``: per level, weight by
    value; values that are not named weigh 1."""
    def weight(level: str) -> Column:
        out = F.lit(1.0)
        for value, w in weights.get(level, {}).items():
            out = F.when(F.col(level) == F.lit(value), F.lit(float(w))).otherwise(out)
        return out

    nodes = leaves.withColumn("capacity", (F.col("supply") * max_epochs).cast("double"))
    total = nodes.agg(F.sum("capacity").alias("all"))
    parents = total.select(F.least(F.lit(float(budget)), "all").alias("parent_budget"), F.lit(0).alias("_root"))
    path: list[str] = ["_root"]
    shared = None
    for depth in range(1, len(LEVELS) + 1):
        keys = list(LEVELS[:depth])
        level = nodes.groupBy(*keys).agg(F.sum("capacity").alias("capacity")).withColumn("_root", F.lit(0)) \
            .withColumns({c: F.lit(None).cast("string") for c in LEVELS[depth:]})
        above = parents.select(*(F.col(c).alias(f"_p{i}") for i, c in enumerate(path)), "parent_budget")
        on = [level[c].eqNullSafe(above[f"_p{i}"]) for i, c in enumerate(path)]
        children = level.join(above, on).drop(*(f"_p{i}" for i in range(len(path))))
        shared = _share(children.withColumn("weight", weight(LEVELS[depth - 1])), path)
        parents = shared.select(*keys, F.lit(0).alias("_root"), F.col("budget").alias("parent_budget"))
        path = ["_root", *keys]
    return shared.select(*LEVELS, F.floor(F.col("budget") + F.lit(1e-6)).cast("bigint").alias("target"))


def _side(table: DataFrame) -> DataFrame:
    """ACTION: a table with a row per leaf, broadcast where its counted rows are few, else left to a shuffle join."""
    written = materialize(table)
    return F.broadcast(written) if written.count() <= BROADCAST_LEAVES else written


def mix(docs: DataFrame, domain: Column, fraction: float, weights: dict[str, dict[str, float]], max_epochs: int = 1,
        seed: int = 0, tokens: Column | None = None) -> DataFrame:
    """ACTION. Every row of ``docs`` with ``domain, n_tokens, target`` (of its leaf), ``epochs`` (whole passes that
    take it) and ``taken`` (tokens of it in all passes, the cut one included). The budget is ``fraction``
    of all tokens."""
    names = docs.columns
    base = materialize(docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("_row"), domain.cast("string").alias("domain"),
                       F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
                       (word_tokens() if tokens is None else tokens).alias("n_tokens"),
                       F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("_text"), F.col("doc_id").alias("_id")))
    supply = materialize(base.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("supply")))
    total = supply.agg((F.sum("supply") * F.lit(float(fraction))).alias("b")).first()["b"] or 0.0
    budgets = leaf_budgets(supply, total, weights, max_epochs).withColumnsRenamed({c: f"_b_{c}" for c in LEVELS})
    leaf = _side(supply.join(budgets, [supply[c].eqNullSafe(budgets[f"_b_{c}"]) for c in LEVELS]).select(
        *(F.col(c).alias(f"_l_{c}") for c in LEVELS), "target",
        F.when(F.col("supply") > 0, F.expr("target div supply")).otherwise(F.lit(0)).alias("epochs"),
        F.when(F.col("supply") > 0, F.expr("target % supply")).otherwise(F.lit(0)).alias("_rest")))
    placed = base.join(leaf, [base[c].eqNullSafe(leaf[f"_l_{c}"]) for c in LEVELS]).drop(*(f"_l_{c}" for c in LEVELS))
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"),
                              F.coalesce(F.col("_id").cast("string"), F.lit("null"))).cast("binary"))
    keyed = placed.withColumn("_order", order).withColumn("_bucket", F.substring("_order", 1, BUCKET_DIGITS))

    sums = keyed.filter("_rest > 0").groupBy(*LEVELS, "_bucket", "_rest").agg(F.sum("n_tokens").alias("_sum"))
    running = Window.partitionBy(*LEVELS).orderBy("_bucket")
    before = sums.withColumn("_before", F.sum("_sum").over(running) - F.col("_sum"))
    cut = _side(before.filter("_before < _rest and _before + _sum >= _rest").select(
        *(F.col(c).alias(f"_c_{c}") for c in LEVELS), F.col("_bucket").alias("_cut"), F.col("_before").alias("_at")))
    marked = keyed.join(cut, [keyed[c].eqNullSafe(cut[f"_c_{c}"]) for c in LEVELS], "left") \
        .drop(*(f"_c_{c}" for c in LEVELS))
    inside = F.coalesce(F.col("_bucket") == F.col("_cut"), F.lit(False))
    below = F.coalesce(F.col("_bucket") < F.col("_cut"), F.lit(False))

    def done(df: DataFrame, partial: Column) -> DataFrame:
        return df.select(*(F.col(f"_row.`{c}`") for c in names if c not in OUTPUT), "domain", "n_tokens", "target", "epochs",
                         (F.col("epochs") * F.col("n_tokens") + partial).alias("taken"))

    prefix = Window.partitionBy(*LEVELS).orderBy("_order", "_text").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_at") + F.coalesce(F.sum("n_tokens").over(prefix), F.lit(0))
    at_cut = marked.filter(inside).withColumn("_start", start)
    return done(marked.filter(~inside), F.when(below, F.col("n_tokens")).otherwise(F.lit(0))).unionByName(
        done(at_cut, F.greatest(F.lit(0), F.least("n_tokens", F.col("_rest") - F.col("_start")))))


OUTPUT = ("domain", "n_tokens", "target", "epochs", "taken")


def keep_mixed(docs: DataFrame, **options) -> DataFrame:
    """ACTION: the documents of ``docs`` that the mix takes tokens from, same columns.
    Repetition by epochs is not written out: a document stays once."""
    names = {c: f"_in_{c}" for c in docs.columns if c in OUTPUT}
    mixed = mix(docs.withColumnsRenamed(names), **options)
    empty = F.col("n_tokens") == 0
    kept = mixed.filter((F.col("taken") > 0) | (empty & (F.col("epochs") > 0)))
    return kept.select(*(F.col(names.get(c, c)).alias(c) for c in docs.columns))
