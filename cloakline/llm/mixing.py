"""Mixing sources to target weights by subset-sum budget fitting.

A document's size is its number of words. Each source gets a target: the total
size shared by weight, at most ``MOST`` times what the source has, the excess
shared again by weight. A source is taken whole as often as its target allows;
the rest of the target is a budget for a subset of its documents. The subset is
found on the histogram of exact sizes: every size gives its proportional share
of documents (rounded down), larger sizes then fill what is left while it is
large, and a bounded-knapsack dynamic programme over the remaining documents
fits the last words. Which documents of a size are taken follows from a seeded
hash, so reruns agree.

Null and empty texts have size 0 and are taken as often as their source is
taken whole. A null source is a source of its own, the last one. Rows that agree
in every column are interchangeable, and counted instead of ranked; rows without
an id are told apart by their other columns, which must be hashable (no maps).
An empty table gives an empty mix. Extra columns are kept by ``mix``.
"""

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cloakline.llm.common import scratch

MOST, SEED = 3, 17
#: The dynamic programme covers budgets up to this many words.
BUDGET = 1 << 16
#: Rows of one source and size that are ranked in one task, and copies of a row that one task makes.
RANKED = 4096


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, most: int = MOST) -> DataFrame:
    """``(source, source_size, target)`` from rows ``(source, size)``.

    A source is at its limit if ``most * source_size <= level * weight``; the
    level follows from the sources in order of that ratio. One row per source
    is all these windows see.
    """
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = s.withColumn("w", (F.row_number().over(by_name) - 1) % 3 + 1)
    every = Window.partitionBy()
    ratio = F.col("source_size") / F.col("w")
    order = Window.orderBy(ratio, F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({
        "total": F.sum("source_size").over(every),
        "_rest_w": F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0)),
        "_full": F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most,
    })
    # With the sources before this one at their limits: does this one stay below its own?
    free = (F.col("total") - F.col("_full")) * F.col("w") <= F.col("source_size") * most * F.col("_rest_w")
    s = s.withColumn("_free", free)
    level = F.min(F.when(F.col("_free"), F.struct(
        ratio.alias("r"), F.col("source").isNull().alias("z"), F.col("source").alias("s"),
        (F.col("total") - F.col("_full")).alias("num"), F.col("_rest_w").alias("den")))).over(every)
    s = s.withColumn("_l", level)
    share = F.col("_l.num") / F.col("_l.den") * F.col("w")
    cap = (F.col("source_size") * most).cast("double")
    return s.select("source", "source_size", F.coalesce(F.least(cap, share), cap).alias("target"))


def fit(counts: dict[int, int], budget: int, cap: int = BUDGET) -> dict[int, int]:
    """How many documents of each size to take so that their words come nearest ``budget``.

    ``counts``: documents by size, sizes above 0. The answer is exact once the
    budget left is within ``cap``, which the shares and the fill by size ensure
    unless only documents larger than ``cap`` remain.
    """
    total = sum(k * c for k, c in counts.items())
    if budget <= 0 or not total:
        return {}
    if budget >= total:
        return dict(counts)
    take = {k: c * budget // total for k, c in counts.items()}
    left = budget - sum(k * n for k, n in take.items())
    # The largest sizes first, as long as more than the programme's range is left.
    for k in sorted(counts, reverse=True):
        if left <= cap // 2:
            break
        n = min(counts[k] - take[k], max(0, left - cap // 2) // k + (1 if k <= cap // 2 else 0), left // k)
        take[k] += n
        left -= n * k
    extra = knapsack({k: counts[k] - take[k] for k in counts if counts[k] > take[k]}, left, cap)
    for k, n in extra.items():
        take[k] += n
    return {k: n for k, n in take.items() if n}


def knapsack(counts: dict[int, int], budget: int, cap: int = BUDGET) -> dict[int, int]:
    """Bounded knapsack: the subset of ``counts`` whose sum is nearest ``budget`` (the lower on ties).

    Sums are bits of one integer; a size with c copies is added in lots of 1, 2,
    4, ... copies. The sums before each lot are kept to read the subset back,
    and the programme stops as soon as the budget itself is a sum.
    """
    reach = min(2 * budget, budget + cap)
    mask = (1 << (reach + 1)) - 1
    sums, lots, goal = 1, [], 1 << budget
    for k in sorted(counts):
        if sums & goal or k > reach:
            break
        left, lot = min(counts[k], reach // k), 1
        while left and not sums & goal:
            n = min(lot, left)
            after = (sums | sums << (k * n)) & mask
            if after != sums:
                lots.append((k, n, sums))
                sums = after
            left -= n
            lot *= 2
    below = (sums & ((goal << 1) - 1)).bit_length() - 1
    above = sums >> budget
    up = budget + (above & -above).bit_length() - 1 if above else None
    at = below if up is None or budget - below <= up - budget else up
    out: dict[int, int] = {}
    for k, n, before in reversed(lots):
        if not before >> at & 1:
            out[k] = out.get(k, 0) + n
            at -= k * n
    return out


def _quotas(pdf: pd.DataFrame) -> pd.DataFrame:
    """One source's histogram (a row per distinct size) with the documents to take of each size."""
    counts = {int(k): int(c) for k, c in zip(pdf["size"], pdf["c"]) if k > 0}
    total = sum(k * c for k, c in counts.items())
    target = float(pdf["target"].iloc[0])
    whole = int(min(MOST, target // total)) if total else 0
    take = fit(counts, round(target - whole * total)) if whole < MOST else {}
    return pdf.assign(whole=whole, quota=[take.get(int(k), 0) for k in pdf["size"]])[
        ["source", "size", "c", "whole", "quota"]]


def _lots(rows: DataFrame, n: str) -> DataFrame:
    """``n`` rows for each row, numbered by ``_i`` from 1; a large number is dealt to several tasks first."""
    one = F.least(F.col(n) - F.col("_at"), F.lit(RANKED))
    numbered = lambda df: df.select("*", F.explode(F.sequence(F.lit(1).cast("long"), one)).alias("_j")).select(
        *rows.columns, (F.col("_at") + F.col("_j")).alias("_i"))
    few = rows.where(F.col(n).between(1, RANKED)).withColumn("_at", F.lit(0).cast("long"))
    many = rows.where(F.col(n) > RANKED).withColumn(
        "_at", F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1, F.lit(RANKED).cast("long"))))
    return numbered(few).unionAll(numbered(many.repartition("_at", *(["_u"] if "_u" in rows.columns else []))))


def _groups(docs: DataFrame, seed: int) -> DataFrame:
    """Documents that agree in every column are one row here: ``_c`` of them, of which ``_take`` get a copy more.

    ``_u``, ``_v``: 128 bits that stand for the row; the first ones, seeded, are
    its place in the order of its size.
    """
    cols = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(
        F.col("doc_id"), F.col("source"), size_of(F.col("text")).alias("size"),
        F.xxhash64(F.lit(seed), *cols).alias("_u"), F.xxhash64(F.lit(seed + 1), *cols).alias("_v"))
    return rows.groupBy("doc_id", "source", "size", "_u", "_v").agg(F.count("*").alias("_c"))


def plan(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies)``, one row per document."""
    d = plan_groups(scratch(_groups(docs, seed), "mix-sizes"))
    d = _lots(d, "_c")
    return d.select("doc_id", "source", "size", "source_size", "target", (
        F.col("whole") + (F.col("_i") <= F.col("_take")).cast("int")).alias("copies"))


def plan_groups(rows: DataFrame) -> DataFrame:
    """``rows`` as ``_groups`` has them, with source_size, target, ``whole`` and ``_take``."""
    each = rows.groupBy("source", "size").agg(F.sum("_c").alias("c"))
    goal = scratch(targets(each.select("source", (F.col("size") * F.col("c")).alias("size"))), "mix-targets")
    quota = each.alias("h").join(goal.alias("g"), F.expr("h.source <=> g.source")).select(
        "h.source", "h.size", "h.c", "g.target")
    quota = scratch(quota.groupBy("source").applyInPandas(
        _quotas, "source string, size long, c long, whole int, quota long"), "mix-quotas")
    # Ordered by the seeded hash in buckets of about RANKED rows, each within one task.
    d = rows.alias("d").join(quota.alias("q"), F.expr("d.source <=> q.source AND d.size = q.size")).select(
        "d.*", "q.whole", "q.quota", F.ceil(F.col("q.c") / RANKED).alias("_n"))
    d = d.withColumn("_b", F.pmod(F.shiftright("_u", 20), F.col("_n")))
    filled = d.where("_n > 1").groupBy("source", "size", "_b").agg(F.sum("_c").alias("_f"))
    earlier = Window.partitionBy("source", "size").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    filled = filled.select("source", "size", "_b", F.coalesce(F.sum("_f").over(earlier), F.lit(0)).alias("_before"))
    d = d.alias("d").join(
        filled.alias("f"), F.expr("d.source <=> f.source AND d.size = f.size AND d._b = f._b"), "left").select(
        "d.*", F.coalesce("f._before", F.lit(0)).alias("_before"))
    order = Window.partitionBy("source", "size", "_b").orderBy("_u", "_v").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("_before") + F.coalesce(F.sum("_c").over(order), F.lit(0))
    take = F.least(F.greatest(F.col("quota") - ahead, F.lit(0)), F.col("_c"))
    d = d.withColumn("_take", take)
    return d.alias("d").join(goal.alias("g"), F.expr("d.source <=> g.source")).select(
        "d.doc_id", "d.source", "d.size", "d._u", "d._v", "d._c", "d.whole", "d._take", "g.source_size", "g.target")


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs``, each row as often as the mix takes it (0 to 3 times)."""
    taken = F.col("_c") * F.col("whole") + F.col("_take")
    made = plan_groups(scratch(_groups(docs, seed), "mix-sizes")).select("_u", "_v", taken.alias("_m")).where("_m > 0")
    cols = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*cols).alias("row"), F.xxhash64(F.lit(seed), *cols).alias("_u"),
                       F.xxhash64(F.lit(seed + 1), *cols).alias("_v"))
    # One row stands for the rows like it, with all their copies.
    rows = rows.join(made, ["_u", "_v"]).dropDuplicates(["_u", "_v"])
    return _lots(rows, "_m").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
