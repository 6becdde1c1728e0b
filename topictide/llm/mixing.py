"""Mixing sources to target weights: hierarchical token budgets over domain, language and source.

The driver sees one total per leaf of the weight tree. Budgets flow from the root to the leaves; a child that cannot use
its share (its tokens times the allowed epochs) passes the rest to its siblings, and only what all of them cannot use stays with
the level above. A leaf's budget is a number of whole epochs and a prefix of one more, in a seeded order of its documents. Where
that prefix ends is found by sums over ranges of the order, so that no leaf is sorted as a whole.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from topictide.llm.common import text_of
from topictide.session import materialise

LEVELS = ("domain", "language", "origin")
RANGE_BITS = 12
SMALL = 4000  # documents of one range that may be ordered together


@dataclass(frozen=True)
class Mixture:
    """Weights by path: ``("web",)``, ``("web", "en")``, ``("web", "en", "src0")``; siblings without a weight get ``other``."""

    weights: dict[tuple[str, ...], float] = field(default_factory=dict)
    other: float = 1.0
    max_epochs: int = 2
    seed: int = 17

    def weight(self, path: tuple[str, ...]) -> float:
        return self.weights.get(path, self.weights.get(("*",) * (len(path) - 1) + path[-1:], self.other))


def source_domain(source: Column) -> Column:
    """The domain of a source by its number; ``other`` for sources without one."""
    number = F.regexp_extract(source, r"(\d+)$", 1)
    names = F.array(F.lit("web"), F.lit("books"), F.lit("forums"))
    return F.when(number != "", F.element_at(names, (F.pmod(number.cast("long"), F.lit(3)) + 1).cast("int"))).otherwise("other")


# Targets of the registered query; "*" stands for any parent.
PRODUCTION = Mixture(
    {
        ("web",): 0.5, ("books",): 0.3, ("forums",): 0.2,
        ("*", "en"): 0.5, ("*", "de"): 0.2, ("*", "fr"): 0.2, ("*", "es"): 0.1,
    }
)


def share_out(amount: int, children: dict[str, tuple[float, int]]) -> dict[str, int]:
    """Split ``amount`` over children (weight, capacity) in proportion; what a full child cannot take goes to its siblings.

    Whole tokens: the remainders of rounding go to the heaviest open children first, then by name."""
    given = dict.fromkeys(children, 0)
    open_ = {c for c, (w, cap) in children.items() if w > 0 and cap > 0}
    left = min(amount, sum(children[c][1] for c in open_))
    while open_ and left:
        total = sum(children[c][0] for c in open_)
        full = {c for c in open_ if given[c] + left * children[c][0] / total >= children[c][1]}
        if full:
            for c in sorted(full):
                take = min(children[c][1] - given[c], left)
                given[c] += take
                left -= take
            open_ -= full
            continue
        shares = {c: int(left * children[c][0] / total) for c in open_}
        rest = left - sum(shares.values())
        for c in sorted(open_, key=lambda c: (-children[c][0], c)):
            extra = min(rest, children[c][1] - given[c] - shares[c])
            given[c] += shares[c] + extra
            rest -= extra
        break
    return given


def leaf_budgets(tokens: dict[tuple[str, ...], int], total: int, mixture: Mixture) -> dict[tuple[str, ...], int]:
    """Tokens that every leaf may contribute; never more than its tokens times ``max_epochs``."""

    def below(prefix: tuple[str, ...], amount: int) -> dict[tuple[str, ...], int]:
        depth = len(prefix)
        if depth == len(LEVELS):
            return {prefix: amount}
        capacity: dict[str, int] = {}
        for path, n in tokens.items():
            if path[:depth] == prefix:
                capacity[path[depth]] = capacity.get(path[depth], 0) + n * mixture.max_epochs
        given = share_out(amount, {c: (mixture.weight((*prefix, c)), cap) for c, cap in capacity.items()})
        out = {}
        for child, n in given.items():
            out |= below((*prefix, child), n)
        return out

    return below((), total)


def _order(seed: int, epoch: Column) -> Column:
    """Place of a row in the seeded order of an epoch; rows equal in id and text share it."""
    return F.xxhash64(F.lit(seed), epoch, F.col("_id"), F.col("_text"))


def _with_leaf(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str, domain) -> DataFrame:
    """``row`` (all columns) beside leaf, token count and a hash of the text."""
    source, text = F.coalesce(F.col(source_col), F.lit("unknown")), text_of(text_col)
    return docs.select(
        F.struct("*").alias("row"),
        F.coalesce(domain(source), F.lit("other")).alias("domain"),
        F.coalesce(F.col(lang_col), F.lit("unknown")).alias("language"),
        source.alias("origin"),
        F.col(id_col).alias("_id"),
        F.xxhash64(text).alias("_text"),
        F.regexp_count(text, F.lit(r"\S+")).cast("long").alias("n_tokens"),
    )


CUTS = StructType([*[StructField(c, StringType(), False) for c in LEVELS], *[StructField(c, LongType()) for c in ("epochs", "prefix", "cut")]])


def _leaf_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """``rows`` of ``CUTS``. They go to Spark as Arrow: a list of rows would start Python workers of another kind on the executors."""
    columns = list(zip(*rows)) or [()] * len(CUTS)
    kinds = [pa.string() if isinstance(f.dataType, StringType) else pa.int64() for f in CUTS]
    return spark.createDataFrame(pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=CUTS.fieldNames()), CUTS)


def _join_leaves(rows: DataFrame, leaves: DataFrame, n_leaves: int) -> DataFrame:
    # one row per leaf of the weight tree: broadcast while that is small, else a join that can split hot leaves
    return rows.join(F.broadcast(leaves) if n_leaves <= 10_000 else leaves, list(LEVELS))


def _cuts(lean: DataFrame, total_tokens: int | None, share: float, mixture: Mixture) -> DataFrame:
    """One row per leaf with a budget: whole ``epochs``, tokens of the ``prefix`` and the last order value ``cut`` in it."""
    spark = lean.sparkSession
    sums = lean.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n")).collect()
    tokens = {tuple(r[c] for c in LEVELS): r["tokens"] for r in sums}
    available = sum(tokens.values())
    budgets = leaf_budgets(tokens, total_tokens if total_tokens is not None else int(share * available), mixture)
    rows = [(*leaf, *divmod(b, tokens[leaf]), None) for leaf, b in budgets.items() if b]
    leaves = _leaf_table(spark, rows)

    # narrow each leaf's prefix to one range of its order: 2^12 ranges at a time, until a range holds few documents
    at = _join_leaves(lean.drop("row") if "row" in lean.columns else lean, leaves.where("prefix > 0"), len(rows))
    at = at.select(*LEVELS, "n_tokens", _order(mixture.seed, F.col("epochs")).alias("h"), F.col("prefix").alias("room"))
    largest, bits = max([r["n"] for r in sums], default=0), 64
    by_leaf = Window.partitionBy(*LEVELS)
    floors = None
    while largest > SMALL and bits > RANGE_BITS:
        bits -= RANGE_BITS
        part = F.shiftright("h", bits).alias("part")
        ranges = at.groupBy(*LEVELS, part).agg(F.sum("n_tokens").alias("tokens"), F.first("room").alias("room"))
        upto = ranges.withColumn("upto", F.sum("tokens").over(by_leaf.orderBy("part")))
        # the first range that does not fit whole, and the room left before it
        over = upto.where("upto > room").groupBy(*LEVELS).agg(F.min(F.struct("part", (F.col("room") - F.col("upto") + F.col("tokens")).alias("left"))).alias("b"))
        over = materialise(over.select(*LEVELS, F.col("b.part").alias("part"), F.col("b.left").alias("left")), "mix-ranges")
        floors = over.select(*LEVELS, F.shiftleft("part", bits).alias("floor"))
        at = _join_leaves(at.withColumn("part", part), over.withColumnRenamed("part", "edge"), len(rows))
        at = at.where("part = edge").select(*LEVELS, "n_tokens", "h", F.col("left").alias("room"))
        largest >>= RANGE_BITS
    upto = at.withColumn("upto", F.sum("n_tokens").over(by_leaf.orderBy("h").rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    cut = upto.where("upto <= room").groupBy(*LEVELS).agg(F.max("h").alias("last"))
    out = leaves.drop("cut").join(cut, list(LEVELS), "left")
    if floors is None:
        floors = leaves.limit(0).select(*LEVELS, F.col("cut").alias("floor"))
    # nothing of the edge range fits: the prefix ends right before it
    out = out.join(floors, list(LEVELS), "left").withColumn("cut", F.coalesce("last", F.col("floor") - 1))
    found: list[Row] = out.select(*CUTS.fieldNames()).collect()
    return _leaf_table(spark, found)


def mix(
    docs: DataFrame,
    mixture: Mixture = PRODUCTION,
    share: float = 1.0,
    total_tokens: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    domain=source_domain,
) -> DataFrame:
    """(row, domain, language, origin, n_tokens, epoch): every chosen document once per epoch that it is used in.

    ``row`` is the document with all its columns. The target is ``total_tokens`` or ``share`` of the tokens (words) at hand. Null
    languages and sources form leaves named ``unknown``, null texts have no token. A prefix ends before the first
    document that would exceed it; documents equal in id and text enter it together. A leaf without tokens gives nothing, so an
    empty table gives an empty result.
    """
    rows = _with_leaf(docs, id_col, text_col, lang_col, source_col, domain)
    lean = materialise(rows.drop("row"), "mix-tokens")
    leaves = _cuts(lean, total_tokens, share, mixture)
    chosen = _join_leaves(rows, leaves, leaves.count())
    inside = (F.col("prefix") > 0) & (_order(mixture.seed, F.col("epochs")) <= F.col("cut"))
    times = F.col("epochs") + F.when(inside, 1).otherwise(0)
    chosen = chosen.withColumn("times", times.cast("int")).where("times > 0")
    return chosen.select("row", *LEVELS, "n_tokens", F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("epoch"))
