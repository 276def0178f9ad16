"""Mixing sources to target weights by Pareto order sampling.

Targets: the sources' weights share the words of all documents; a target stops
at `max_copies` times its source's words and what is above is shared again
among the other sources by weight.

Copies: a document of preference g is expected `c * g` times (at most
`max_copies`), with c such that the expected words of its source meet the
target. The whole part is certain. The rest, pi, is an inclusion probability:
documents are ranked by the odds of a uniform number over the odds of pi and
taken in that order until the words that are left for the source are reached,
the last document only if that comes nearer.

The cut in the ranking is found by sums over bins of the rank, refined twice
inside the bin that holds it, so no source is ever sorted in one task.

Defined cases: null text has no words and is taken 0 times; a null source is a
source, last in order; sources without words get target 0; the uniform numbers
come from (document id, text), so reruns agree and repeated rows, which tie,
are taken or left together; an empty table gives an empty result; other columns
pass through untouched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewright.llm.common import count_words
from tidewright.session import written

MAX_COPIES = 3
CLASSES = 16
# A table of one row per source is broadcast up to this many sources, which
# bounds it to some MB; beyond, it is joined like any other table.
BROADCAST_SOURCES = 20_000
_BITS, _LEVELS = 10, 3


def cyclic_weights(sources: list[str | None], cycle: tuple[int, ...] = (5, 2, 1)) -> dict[str | None, float]:
    """Weights in a repeating pattern over the sources by code point, null last."""
    order = sorted(s for s in sources if s is not None) + [s for s in sources if s is None]
    return {s: cycle[i % len(cycle)] for i, s in enumerate(order)}


def fill_targets(sizes: dict, weights: dict, max_copies: int = MAX_COPIES) -> dict:
    """Words wanted of each source."""
    targets, left, active = {}, float(sum(sizes.values())), dict.fromkeys(sizes)
    while active:
        share = sum(weights[s] for s in active)
        above = [s for s in active if share <= 0 or left * weights[s] / share > max_copies * sizes[s]]
        if not above:
            return targets | {s: left * weights[s] / share for s in active}
        for s in above:
            targets[s] = float(max_copies * sizes[s])
            del active[s]
        left = max(0.0, float(sum(sizes.values())) - sum(targets.values()))
    return targets


def _scale(words_by_class: dict[int, int], target: float, max_copies: int) -> float:
    """c with sum(words * min(max_copies, c * class / CLASSES)) = target."""
    free, fixed, slope = sorted(words_by_class, reverse=True), 0.0, 0.0
    slope = sum(w * k / CLASSES for k, w in words_by_class.items())
    while free:
        c = max(0.0, target - fixed) / slope if slope > 0 else 0.0
        if c * free[0] / CLASSES <= max_copies:
            return c
        k = free.pop(0)
        fixed += max_copies * words_by_class[k]
        slope -= words_by_class[k] * k / CLASSES
    return max_copies * CLASSES


def length_preference(words: Column) -> Column:
    """Short documents carry less; from 1/2 for one word towards 1."""
    return 0.5 + 0.5 * words / (words + F.lit(50.0))


def with_rank(
    docs: DataFrame, id_col: str, text_col: str, seed: int, preference: Callable[[Column], Column] | None
) -> DataFrame:
    """Adds mix_size (words), mix_class (1 to CLASSES) and mix_u (uniform in (0, 1))."""
    drawn = F.xxhash64(F.col(id_col), F.col(text_col), F.lit(seed))
    size = count_words(F.col(text_col))
    rows = docs.withColumns(
        {
            "mix_size": size,
            "mix_u": (F.shiftrightunsigned(drawn, 11).cast("double") + 0.5) / F.lit(float(1 << 53)),
        }
    )
    kept = preference(F.col("mix_size")) if preference else F.lit(1.0)
    return rows.withColumn(
        "mix_class", F.greatest(F.lit(1), F.least(F.lit(CLASSES), F.ceil(kept * CLASSES))).cast("int")
    )


def _joined(rows: DataFrame, sources: DataFrame, n: int) -> DataFrame:
    side = F.broadcast(sources) if n <= BROADCAST_SOURCES else sources
    return rows.join(side, F.col("mix_source").eqNullSafe(F.col("of_source")), "left").drop("of_source")


def _expected(max_copies: int) -> dict[str, Column]:
    """Certain copies and the rank in (0, 1) of the one that is drawn."""
    copies = F.least(F.lit(float(max_copies)), F.col("mix_scale") * F.col("mix_class") / CLASSES)
    # A hair above a whole number is that whole number.
    whole = F.floor(copies + 1e-9)
    pi = F.greatest(F.lit(0.0), copies - whole)
    u = F.col("mix_u")
    odds = u * (1 - pi) / (u * (1 - pi) + (1 - u) * pi)
    return {"mix_whole": whole.cast("long"), "mix_pi": pi, "mix_rank": F.when(pi > 0, odds)}


def mixing_plan(
    ranked: DataFrame, weights: Callable[[list], dict] = cyclic_weights, max_copies: int = MAX_COPIES
) -> tuple[DataFrame, int]:
    """One row per source with its words, target, scale and cut in the ranking.

    `ranked` needs mix_source, mix_size, mix_class and mix_u and is read once
    for the sums and once per level of the cut. The sources of a mix and their
    sums are held on the driver; the documents are not.
    """
    spark = ranked.sparkSession
    sums: dict = {}
    for row in ranked.groupBy("mix_source", "mix_class").agg(F.sum("mix_size").alias("words")).collect():
        sums.setdefault(row.mix_source, {})[row.mix_class] = row.words
    sizes = {s: sum(k.values()) for s, k in sums.items()}
    targets = fill_targets(sizes, weights(list(sizes)), max_copies)
    plan = []
    for s, classes in sums.items():
        scale = _scale(classes, targets[s], max_copies)
        whole = sum(w * int(min(max_copies, scale * k / CLASSES) + 1e-9) for k, w in classes.items())
        plan.append((s, sizes[s], targets[s], scale, max(0.0, targets[s] - whole)))
    schema = "of_source string, source_size long, target double, mix_scale double, mix_left double"
    sources = spark.createDataFrame(plan, schema)
    cuts = spark.createDataFrame([(p[0], None, 0.0) for p in plan], "of_source string, mix_cut long, mix_below double")
    drawn = _joined(ranked, sources, len(plan)).withColumns(_expected(max_copies)).where("mix_rank is not null")
    for level in range(1, _LEVELS + 1):
        rows = _joined(drawn, cuts, len(plan)).withColumn(
            "mix_bin", F.floor(F.col("mix_rank") * F.lit(float(1 << (_BITS * level))))
        )
        if level > 1:
            rows = rows.where(F.shiftright("mix_bin", _BITS) == F.col("mix_cut"))
        bins = rows.groupBy("mix_source", "mix_bin").agg(
            F.sum("mix_size").alias("words"), F.first("mix_left").alias("mix_left"), F.first("mix_below").alias("below")
        )
        # A source has at most 2 ** _BITS bins here.
        up_to = F.sum("words").over(Window.partitionBy("mix_source").orderBy("mix_bin")) + F.col("below")
        found = bins.withColumn("up_to", up_to).where("up_to >= mix_left and up_to - words < mix_left")
        got = found.select("mix_source", "mix_bin", "up_to", "words", "mix_left").collect()
        at = {r.mix_source: r for r in got}
        cuts = spark.createDataFrame(
            [(s, r.mix_bin, float(r.up_to - r.words)) for s, r in at.items()],
            "of_source string, mix_cut long, mix_below double",
        )
    last = []
    for s, _, _, _, left in plan:
        r = at.get(s)
        # Without a cut all that can be drawn is (or nothing, if nothing is left).
        if r is None:
            cut = (1 << (_BITS * _LEVELS)) + 1 if left > 0 else 0
        else:
            nearer = r.up_to - r.mix_left <= r.mix_left - (r.up_to - r.words)
            cut = r.mix_bin + 1 if nearer else r.mix_bin
        last.append((s, cut))
    named = spark.createDataFrame(last, "cut_source string, mix_cut long")
    plan_rows = sources.join(named, F.col("of_source").eqNullSafe(F.col("cut_source"))).drop("cut_source")
    return plan_rows, len(plan)


def with_copies(ranked: DataFrame, plan: DataFrame, n_sources: int, max_copies: int = MAX_COPIES) -> DataFrame:
    """Adds `copies`, the number of times the mix takes each row, and the plan's columns."""
    rows = _joined(ranked, plan, n_sources).withColumns(_expected(max_copies))
    drawn = F.floor(F.col("mix_rank") * F.lit(float(1 << (_BITS * _LEVELS)))) < F.col("mix_cut")
    return rows.withColumn(
        "copies",
        F.when(F.col("mix_size") > 0, F.col("mix_whole") + F.coalesce(drawn, F.lit(False)).cast("long")).otherwise(0),
    )


def pareto_mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: Callable[[list], dict] = cyclic_weights,
    max_copies: int = MAX_COPIES,
    preference: Callable[[Column], Column] | None = length_preference,
    seed: int = 42,
) -> DataFrame:
    """Every document's share in the mix: id, source, size, source_size, target, copies, taken.

    Texts are read once; ids, sizes and uniform numbers are stored and read by
    the passes that find the cut.
    """
    ranked = with_rank(
        docs.select(F.col(id_col).alias("mix_id"), F.col(source_col).cast("string").alias("mix_source"),
                    F.col(text_col).cast("string").alias("mix_text")),
        "mix_id", "mix_text", seed, preference,
    ).drop("mix_text")
    ranked = written(ranked, "mix-ranks")
    plan, n = mixing_plan(ranked, weights, max_copies)
    return with_copies(ranked, plan, n, max_copies).select(
        F.col("mix_id").alias(id_col),
        F.col("mix_source").alias(source_col),
        F.col("mix_size").alias("size"),
        "source_size",
        "target",
        "copies",
        (F.col("mix_size") * F.col("copies")).alias("taken"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of `docs`, with its own columns, as often as the mix takes it."""
    max_copies = options.get("max_copies", MAX_COPIES)
    own = [f"own_{i}" for i in range(len(docs.columns))]
    renamed = docs.toDF(*own)
    at = {c: own[i] for i, c in enumerate(docs.columns)}
    ranked = with_rank(
        renamed.withColumn("mix_source", F.col(at[options.get("source_col", "source")]).cast("string")),
        at[options.get("id_col", "doc_id")], at[options.get("text_col", "text")],
        options.get("seed", 42), options.get("preference", length_preference),
    )
    sums = written(ranked.select("mix_source", "mix_size", "mix_class", "mix_u"), "mix-ranks")
    plan, n = mixing_plan(sums, options.get("weights", cyclic_weights), max_copies)
    taken = with_copies(ranked, plan, n, max_copies).where("copies > 0")
    repeated = taken.withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select(*own).toDF(*docs.columns)
