"""Mixing sources to target weights by hierarchical budgets. DataFrame functions only.

A token budget is passed down a tree of domain, language and source. At every node the children share
their parent's budget by weight, none above what its documents give in ``max_epochs`` epochs; what a
child can't use goes to its siblings, and only what all siblings together can't use has been kept
from the parent, as a parent is never given more than its children hold. A leaf repeats whole epochs
and fills the rest with a prefix of one more epoch in seeded order.

Rows meet in no one task: leaves are summed before the shuffle, and the end of a prefix is found
from sums over slices of the leaf's order, then inside one slice; a slice and the list of slices both
have about the square root of the leaf's different draws. Rows of one draw are summed before they meet,
so an id that many rows share, or that they lack, is one row there. The children of a node meet in no one task
either: how far they fill up is found from sums over slices of cap per weight. Texts are read to count words and
never shuffled, but for one copy of each row that is repeated as a whole where a prefix ends.

One law holds for ``mix`` and ``mixed_documents``: a leaf is ordered by a draw from the id, rows of one
draw, as those of equal or null id, by a digest of id, text, language and source, and the prefix is cut by rows. Of
rows that agree in all of these as many are taken as fit, so less than one document of the budget is left;
``mixed_documents`` orders them by a digest of all their columns.

Defined cases: a null text has one token, its end; a null or unknown branch value is a branch of its
own with the default weight; weight 0 takes nothing; an empty table gives an empty result; other
columns are kept by ``mixed_documents`` and not read by ``mix``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modeforge.llm.common import WORD, broadcast_if_bounded, packed_row, row_digest, staged, text_or_empty, unit_draw

LEVELS = ("domain", "lang", "source")


@dataclass(frozen=True)
class Mixture:
    """Target weights in whole parts by level and value; ``default`` for values not listed."""

    weights: Mapping[str, Mapping[str, int]] = field(default_factory=dict)
    default: int = 100
    share: float = 0.6
    max_epochs: int = 2
    seed: int = 7


#: The mixture of the registered query.
PRODUCTION = Mixture(
    weights={
        "domain": {"domain0": 400, "domain1": 300, "domain2": 200, "domain3": 100},
        "lang": {"en": 500, "de": 200, "fr": 200, "es": 100},
    }
)


def domain_of(source: Column) -> Column:
    """The domain of a source: its number modulo four; sources without a number form one domain."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), "([0-9]{1,9})$", 1)
    return F.when(number == "", F.lit("other")).otherwise(
        F.concat(F.lit("domain"), F.pmod(F.when(number != "", number).cast("bigint"), F.lit(4)).cast("string"))
    )


def _weight(level: str, mixture: Mixture) -> Column:
    known = mixture.weights.get(level, {})
    chosen = F.lit(mixture.default)
    for value, parts in known.items():
        chosen = F.when(F.col(level) == value, F.lit(int(parts))).otherwise(chosen)
    return chosen.cast("bigint")


def share_out(children: DataFrame, parents: Sequence[str], name: str) -> DataFrame:
    """Divide ``budget`` of the parent among children by ``weight``, at most ``cap`` each.

    Children sorted by cap per weight, their ratio, fill up first; the others share what is left by weight. Ratios
    are summed up in slices of some two per cent; the slice in which children stop filling up follows from
    the sums, and the ratio from the different ratios of that slice.
    """
    some = children.where("weight > 0").withColumn("_ratio", F.col("cap") / F.col("weight"))
    some = staged(some.withColumn("_slice", F.floor(F.log(F.greatest("_ratio", F.lit(1e-9))) * _SLICES).cast("int")), "children")
    # A slice fills up if its last ratio is no more than what is left for each unit of weight behind it.
    slices = some.groupBy(*parents, "_slice").agg(F.max("budget").alias("budget"), F.sum("cap").alias("cap"), F.sum("weight").alias("weight"), F.max("_ratio").alias("_last"))
    first = _first_open(slices, parents, "_slice")
    open_slices = staged(first.select(*parents, "_slice", "_before", "_onward"), "open-slices")
    ratios = (
        some.join(broadcast_if_bounded(open_slices), [*parents, "_slice"])
        .groupBy(*parents, "_ratio")
        .agg(*(F.max(c).alias(c) for c in ("budget", "_before", "_onward")), F.sum("cap").alias("cap"), F.sum("weight").alias("weight"))
        .withColumn("_last", F.col("_ratio"))
    )
    ends = _first_open(ratios, parents, "_ratio")
    ends = staged(ends.select(*parents, F.col("_ratio").alias("_open"), ((F.col("budget") - F.col("_before")) / F.col("_onward")).alias("_level")), "levels")
    full = F.col("_open").isNull() | (F.col("_ratio") < F.col("_open"))
    return some.join(broadcast_if_bounded(ends), list(parents), "left").withColumn(
        "given", F.when(full, F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("_level"))
    ).drop("_level", "_open", "_slice", "_ratio")


#: Slices of ratios for each factor of e.
_SLICES = 50


def _first_open(sums: DataFrame, parents: Sequence[str], by: str) -> DataFrame:
    """The first row of each node whose children do not all fill up.

    ``_before`` are the caps of the rows before it and ``_onward`` the weights from it on, both including what the node has
    outside ``sums``, where those columns are there already.
    """
    order = Window.partitionBy(*parents).orderBy(by)
    earlier, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before, ahead = F.coalesce(F.sum("cap").over(earlier), F.lit(0)), F.sum("weight").over(onward)
    if "_before" in sums.columns:
        before = F.col("_before") + before
        ahead = F.col("_onward") - F.coalesce(F.sum("weight").over(earlier), F.lit(0))
    placed = sums.withColumns({"_passed": before, "_ahead": ahead}).drop("_before", "_onward")
    left = F.col("budget") - F.col("_passed") - F.col("cap")
    fills = F.col("_last") * (F.col("_ahead") - F.col("weight")) <= left
    opened = placed.where(~fills).withColumn("_place", F.row_number().over(order)).where("_place = 1")
    return opened.withColumnsRenamed({"_passed": "_before", "_ahead": "_onward"})


def budgets(leaves: DataFrame, mixture: Mixture) -> DataFrame:
    """Tokens granted to each leaf: ``domain, lang, source, size, rows, granted``."""
    capped = leaves.where("size > 0").select(
        "*",
        (F.col("size") * mixture.max_epochs).alias("cap"),
        *(_weight(level, mixture).alias(f"w_{level}") for level in LEVELS),
    )
    # A branch of weight 0 can't use what is under it.
    capped = capped.where(" and ".join(f"w_{level} > 0" for level in LEVELS))
    whole = leaves.agg(F.floor(F.coalesce(F.sum("size"), F.lit(0)) * F.lit(mixture.share)).cast("double").alias("budget"))
    given = None
    for depth, level in enumerate(LEVELS):
        path = list(LEVELS[: depth + 1])
        nodes = capped.groupBy(*path).agg(F.sum("cap").alias("cap"), F.max(f"w_{level}").alias("weight"))
        if given is None:
            # One row with the whole budget.
            nodes = nodes.join(F.broadcast(whole)).withColumn("_all", F.lit(1))
            parents = ["_all"]
        else:
            nodes = nodes.join(given.select(*path[:-1], F.col("given").alias("budget")), path[:-1])
            parents = path[:-1]
        given = share_out(nodes, parents, level)
    return given.join(leaves, list(LEVELS)).select(*LEVELS, "size", "rows", F.floor(F.col("given")).cast("bigint").alias("granted"))


def _keyed(docs: DataFrame, id_col: str, lang_col: str, source_col: str) -> list[Column]:
    missing = F.lit("")
    return [
        F.coalesce(F.col(id_col).cast("string"), missing).alias("_key"),
        domain_of(F.col(source_col)).alias("_domain"),
        F.coalesce(F.col(lang_col), missing).alias("_lang"),
        F.coalesce(F.col(source_col), missing).alias("_source"),
    ]


def _place_in_order(key: Column, seed: int, epoch: Column) -> Column:
    return unit_draw(key, F.concat(F.lit(f"mix{seed}-"), epoch.cast("string")))


def _edges(placed: DataFrame, by: str) -> DataFrame:
    """Per leaf, the value of ``by`` at which the tokens pass ``rest``, with the tokens before it.

    ``placed(domain, lang, source, by, slice, n_tokens, before, rest)``; slices are in the order of ``by``.
    ``rows`` have that value, ``most`` is the largest of their tokens.
    """
    sums = staged(placed.groupBy(*LEVELS, "slice", "before", "rest").agg(F.sum("n_tokens").alias("n")), "slices")
    upto = F.col("before") + F.sum("n").over(Window.partitionBy(*LEVELS).orderBy("slice"))
    ends = staged(
        sums.withColumn("upto", upto)
        .where("upto > rest and upto - n <= rest")
        .select(*LEVELS, F.col("slice").alias("end"), (F.col("upto") - F.col("n")).alias("start")),
        "ends",
    )
    inside = placed.drop("before").join(broadcast_if_bounded(ends), list(LEVELS)).where("slice = end")
    values = inside.groupBy(*LEVELS, by, "start", "rest").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("rows"), F.max("n_tokens").alias("most"))
    total = F.col("start") + F.sum("n").over(Window.partitionBy(*LEVELS).orderBy(by))
    return staged(
        values.withColumn("upto", total)
        .where("upto > rest and upto - n <= rest")
        .select(*LEVELS, F.col(by).alias("edge"), (F.col("upto") - F.col("n")).alias("before"), "rest", "rows", "most"),
        "edges",
    )


def _cuts(counted: DataFrame, mixture: Mixture) -> DataFrame:
    """Per leaf: whole epochs and the draw at which the prefix ends.

    Of rows with that draw those with a smaller digest than ``tie`` are in the prefix, and of those with
    that digest as many as ``more``.
    """
    leaves = staged(counted.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("size"), F.count("*").alias("rows")), "leaves")
    plan = staged(
        budgets(leaves, mixture).select(
            *LEVELS,
            F.expr("granted div size").alias("epochs"),
            F.expr("granted % size").alias("rest"),
            F.ceil(F.sqrt("rows")).cast("bigint").alias("slices"),
        ),
        "budgets",
    )
    placed = counted.join(broadcast_if_bounded(plan), list(LEVELS)).withColumn(
        "u", _place_in_order(F.col("key"), mixture.seed, F.col("epochs"))
    )
    sliced = lambda at: F.floor(at * F.col("slices"))
    edges = _edges(placed.withColumn("slice", sliced(F.col("u"))).withColumn("before", F.lit(0).cast("bigint")), "u")
    cuts = plan.select(*LEVELS, "epochs").join(edges.select(*LEVELS, "edge"), list(LEVELS), "left")
    ties = edges.where("rows > 1")
    if ties.isEmpty():
        return cuts.withColumns({"tie": F.lit(None).cast("binary"), "more": F.lit(0).cast("bigint")})
    ties = ties.select(*LEVELS, "edge", "before", F.ceil(F.sqrt("rows")).cast("bigint").alias("slices"))
    tied = placed.drop("slices").join(broadcast_if_bounded(ties), list(LEVELS)).where("u = edge")
    part = F.conv(F.substring(F.hex("digest"), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    within = _edges(tied.withColumn("slice", sliced(part)), "digest")
    more = F.floor((F.col("rest") - F.col("before")) / F.col("most")).cast("bigint")
    return staged(
        cuts.join(within.select(*LEVELS, F.col("edge").alias("tie"), more.alias("more")), list(LEVELS), "left").fillna(0, ["more"]), "cuts"
    )


def _chosen(mixture: Mixture) -> Column:
    """Whether a row is in the prefix, from its key, its digest and its leaf's cut; without the ``more``."""
    u = _place_in_order(F.col("_key"), mixture.seed, F.col("epochs"))
    return F.coalesce((u < F.col("edge")) | ((u == F.col("edge")) & (F.col("_digest") < F.col("tie"))), F.lit(False))


def _tied(mixture: Mixture) -> Column:
    """Whether a row is one of those that agree in all columns where the prefix ends."""
    u = _place_in_order(F.col("_key"), mixture.seed, F.col("epochs"))
    return F.coalesce((F.col("more") > 0) & (u == F.col("edge")) & (F.col("_digest") == F.col("tie")), F.lit(False))


def _counted(docs: DataFrame, mixture: Mixture, id_col: str, text_col: str, lang_col: str, source_col: str, digest: Column) -> tuple[DataFrame, DataFrame]:
    """Rows with key, leaf, tokens and digest, and the cuts of the leaves."""
    counted = docs.select(
        F.col(id_col).alias("doc_id"),
        *_keyed(docs, id_col, lang_col, source_col),
        (F.regexp_count(text_or_empty(text_col), F.lit(WORD)) + 1).cast("bigint").alias("n_tokens"),
        digest.alias("_digest"),
    )
    counted = staged(counted, "tokens")
    named = counted.select(
        F.col("_key").alias("key"), F.col("_domain").alias("domain"), F.col("_lang").alias("lang"),
        F.col("_source").alias("source"), "n_tokens", F.col("_digest").alias("digest"),
    )
    return counted, _cuts(named, mixture).select(
        *(F.col(level).alias(f"_{level}") for level in LEVELS), "epochs", "edge", "tie", "more"
    )


def _law_digest(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> Column:
    narrow = docs.select(*(F.col(f"`{c}`") for c in (id_col, text_col, lang_col, source_col)))
    return row_digest(packed_row(narrow), narrow)


def _spread(once: DataFrame, count: str, keys: Sequence[str]) -> DataFrame:
    """Each row of ``once`` as often as ``count`` says, by about the root of that many tasks."""
    parts = once.where(F.col(count) > 0).withColumn("_parts", F.ceil(F.sqrt(count)).cast("bigint"))
    parts = parts.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1)))
    share = F.expr(f"{count} div _parts + if(_part < {count} % _parts, 1, 0)")
    dealt = parts.withColumn("_share", share).repartition(*keys, "_part")
    return dealt.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_share"))).alias("_time"))


def mix(
    docs: DataFrame, mixture: Mixture = PRODUCTION, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang", source_col: str = "source",
) -> DataFrame:
    """``doc_id, domain, lang, source, n_tokens, copies`` for every row; copies is 0 for rows left out."""
    digest = _law_digest(docs, id_col, text_col, lang_col, source_col)
    counted, cuts = _counted(docs, mixture, id_col, text_col, lang_col, source_col, digest)
    keys = [f"_{level}" for level in LEVELS]
    placed = counted.join(broadcast_if_bounded(cuts), keys, "left").withColumn("epochs", F.coalesce("epochs", F.lit(0)))
    shown = ["doc_id", *(F.col(f"_{level}").alias(level) for level in LEVELS), "n_tokens"]
    out = placed.where(~_tied(mixture)).select(*shown, (F.col("epochs") + _chosen(mixture).cast("int")).cast("int").alias("copies"))
    if cuts.where("more > 0").isEmpty():
        return out
    # Rows that agree in all columns are counted, and come back with and without the one copy more.
    same = placed.where(_tied(mixture)).groupBy(*keys, "more", "epochs", "_digest").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_tokens").alias("n_tokens"), F.count("*").alias("_all")
    )
    both = staged(same, "tied-rows").withColumn("_n", F.explode(F.array(F.struct(F.lit(1).alias("plus"), F.col("more").alias("n")), F.struct(F.lit(0).alias("plus"), (F.col("_all") - F.col("more")).alias("n")))))
    dealt = _spread(both.withColumn("_count", F.col("_n.n")), "_count", keys)
    return out.unionByName(dealt.select(*shown, (F.col("epochs") + F.col("_n.plus")).cast("int").alias("copies")))


def mixed_documents(
    docs: DataFrame, mixture: Mixture = PRODUCTION, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang", source_col: str = "source",
) -> DataFrame:
    """The chosen rows of ``docs`` with their columns, repeated as often as they are taken."""
    row = packed_row(docs)
    digest = F.concat(_law_digest(docs, id_col, text_col, lang_col, source_col), row_digest(row, docs))
    _, cuts = _counted(docs, mixture, id_col, text_col, lang_col, source_col, digest)
    keys = [f"_{level}" for level in LEVELS]
    packed = docs.select(row.alias("_row"), *_keyed(docs, id_col, lang_col, source_col), digest.alias("_digest"))
    placed = packed.join(broadcast_if_bounded(cuts), keys)
    taken = placed.withColumn("_n", (F.col("epochs") + _chosen(mixture).cast("int")).cast("int")).where("_n > 0")
    if mixture.max_epochs > 1:
        taken = taken.withColumn("_row", F.explode(F.array_repeat("_row", F.col("_n"))))
    taken = taken.select("_row")
    if not cuts.where("more > 0").isEmpty():
        once = placed.where(_tied(mixture)).groupBy(*keys, "more").agg(F.first("_row").alias("_row"))
        taken = taken.unionByName(_spread(once, "more", keys).select("_row"))
    return taken.select("_row.*")
