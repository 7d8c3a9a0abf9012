"""Matching of entities across sources without keys, by collective graph linkage.

Records of two sides become a graph whose edges join records that share a rare attribute combination (a blocking key). An
edge weighs the logarithm of its likelihood ratio, so rare shared names and days weigh most (Fellegi and Sunter with
frequencies). Meta-blocking keeps an edge only if it is no weaker than the mean of one of its ends. Similarity is then
propagated in two ways until it is stable: edges that share a record take from each other (sum-product messages of one-to-one
matching), and an edge whose neighbours match gains: neighbours of a record are those of its own side with the same name one
day before or after. How much a matched neighbour tells is counted in the data. The result of an edge is its probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tarn.llm.canonical import NameList, chosen, over_candidates
from tarn.llm.spelling import fold
from tarn.operators.packed import tokenize
from tarn.operators.tracks import groups, numbers
from tarn.session import cut_lineage, tasks


@dataclass(frozen=True)
class MatchParameters:
    """Chances of what is seen in true pairs; those of chance pairs are counted in the data or follow from tolerance."""

    tolerance: float = 0.055  # of the logarithm of distance and duration
    same_day: float = 0.93
    next_day: float = 0.03
    close: float = 0.96  # within tolerance
    spread: float = 1.2  # width over which the logarithm of distance and duration of chance pairs is spread
    share: float = 0.93  # both name listed entries, and share one
    prior: float = 0.7  # records that have a partner
    slack_km: float = 0.06  # beside the tolerance: what rounding makes of small values
    slack_minutes: float = 1.0
    accept: float = 0.5
    change: float = 1e-3  # of a message or of a neighbour's support, below which all is stable
    at_once: int = 3  # rounds of messages between two looks at their change
    most_rounds: int = 3000  # beyond which the messages count as not ending, an error
    shared_rounds: int = 12  # after which connected edges that still move are put into one task, if they are local_edges at most
    local_edges: int = 500_000


def tokens_of(texts: DataFrame, blocks: Iterable[list[tuple]]) -> DataFrame:
    """(text, tokens, named) of distinct texts: entries of the list that a text names, as e<number>, and its other items folded; named if any entry."""

    def rows_of(text: str, items: list[list[tuple]]) -> list[tuple]:
        tokens, named = set(), False
        for item, found in zip(tokenize(text), items):
            least: dict[str, int] = {}
            for *_, name, numbers in chosen(found):
                least[name] = min(*(n for n, *_ in numbers), least.get(name, math.inf))
            named = named or bool(least)
            tokens |= {f"e{n}" for n in least.values()} or {fold(NameList.cores(item)[-1])}
        return [(text, sorted(tokens), named)]

    return over_candidates(texts, blocks, rows_of, "text string, tokens array<string>, named boolean")


FULL_WIDTH = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
NARROW = "".join(chr(c) for c in range(0x21, 0x7F))


def _narrow(text: Column) -> Column:
    return F.lower(F.regexp_replace(F.translate(text, FULL_WIDTH + "　", NARROW + " "), "㎞", "km"))


def kilometres(text: Column) -> Column:
    """Number of kilometres in a written distance (km or m); null if there is none."""
    number = F.regexp_extract(_narrow(text), r"([0-9]+(?:\.[0-9]+)?)", 1).try_cast("double")
    return F.when(_narrow(text).rlike(r"km|キロ|^\s*[0-9.]+\s*$"), number).when(_narrow(text).rlike(r"m|メートル"), number / 1000)


def minutes(text: Column) -> Column:
    """Minutes in a written duration (h:mm, h時間mm分, n min); null if there is none."""
    t = _narrow(text)
    part = lambda pattern, i=1: F.coalesce(F.regexp_extract(t, pattern, i).try_cast("double"), F.lit(0.0))
    clock, spoken = r"([0-9]+):([0-9]{2})", r"(?:([0-9]+) ?(?:時間|hours?|h))? ?(?:([0-9]+) ?(?:分|min|m))?"
    value = F.when(t.rlike(clock), part(clock) * 60 + part(clock, 2)).when(t.rlike(r"[0-9] ?(?:時間|分|h|m)"), part(spoken) * 60 + part(spoken, 2))
    return F.when(value > 0, value)


NO_NAME_LEFT, NO_NAME_RIGHT, NO_DAY = "left without names", "right without names", "day missing"


def _measured(records: DataFrame, left: bool, p: MatchParameters) -> DataFrame:
    """records with bins of distance and duration (null where missing) and own, what they have: 1 distance, 2 duration.

    The right side has the bins within reach of its value, the left side the bin of its own, so they share one if they agree.
    """

    def bins(c: str, slack: float) -> Column:
        value = F.col(c)
        at = lambda v: F.floor(v / (2 * p.tolerance)).cast("long")
        reach = 0.0 if left else p.tolerance + slack / value
        found = F.sequence(at(F.log(value) - reach), at(F.log(value) + reach))
        return F.when((value > 1e-6) & (value < 1e9), found)

    binned = records.select("*", bins("km", p.slack_km).alias("_k"), bins("minutes", p.slack_minutes).alias("_m"))
    return binned.withColumn("own", F.when(F.col("_k").isNull(), 0).otherwise(1) + F.when(F.col("_m").isNull(), 0).otherwise(2))


def _agreeing(left: bool, least: int) -> Column:
    """Hashes of bins, one set for each kind of partner: with both measures, either or none.

    A record and its partner share a hash exactly if they agree in all measures that both have; a pair of other kinds than a
    hash is for never meets in it, so no key holds all records. least: the fewest measures in common.
    """
    none = F.array(F.lit(None).cast("long"))
    own = F.col("own")
    sets = []
    for other in range(4):
        k, m = (F.coalesce(F.col(c), none) if other & bit else none for c, bit in (("_k", 1), ("_m", 2)))
        kinds = own * 4 + other if left else own + other * 4
        found = F.flatten(F.transform(k, lambda x: F.transform(m, lambda y: F.xxhash64(kinds, x, y))))  # noqa: B023
        sets.append(F.when(F.bit_count(own.bitwiseAND(F.lit(other))) >= least, found).otherwise(F.array().cast("array<bigint>")) if least else found)
    return F.flatten(F.array(*sets))


def _keys(records: DataFrame, left: bool) -> DataFrame:
    """(key, id): blocking keys of a side. Days of the left side reach one day to either side for shared tokens."""
    near = F.array(*(F.col("day") + k for k in (-1, 0, 1))) if left else F.array("day")
    dated = F.flatten(F.transform("tokens", lambda t: F.transform(near, lambda d: F.xxhash64(t, d))))
    marks = [(F.lit(NO_NAME_RIGHT), F.lit(True) if left else ~F.col("named")), (F.lit(NO_NAME_LEFT), ~F.col("named") if left else F.lit(True))]
    bare = F.filter(F.array(*(F.when(on, F.xxhash64(mark, F.col("day"))) for mark, on in marks)), lambda k: k.isNotNull())
    keys = records.where("day is not null").select("id", F.explode(F.concat(F.coalesce(dated, F.array().cast("array<bigint>")), bare)).alias("k"), _agreeing(left, 0).alias("s"))
    return keys.select("id", F.explode(F.transform("s", lambda s: F.xxhash64("k", s))).alias("key"))


def _undated_keys(records: DataFrame, left: bool) -> DataFrame:
    """Keys of token and measures, through which records without a day meet all of the other side that share a measure and a name.

    Without a day or a measure in common no pair reaches probability one half.
    """
    keys = records.where("named").select("id", F.col("day").isNull().alias("undated"), F.explode("tokens").alias("k"), _agreeing(left, 1).alias("s"))
    return keys.select("id", "undated", F.explode(F.transform("s", lambda s: F.xxhash64(F.lit(NO_DAY), "k", s))).alias("key"))


def candidates(left: DataFrame, right: DataFrame, p: MatchParameters) -> DataFrame:
    """Distinct (id_a, id_b) of records that share a blocking key and agree in the measures that both have, at every size of a block."""
    left, right = _measured(left, True, p), _measured(right, False, p)
    pairs = _keys(left, True).withColumnRenamed("id", "id_a").join(_keys(right, False).withColumnRenamed("id", "id_b"), "key")
    u, v = _undated_keys(left, True).withColumnsRenamed({"id": "id_a", "undated": "late_a"}), _undated_keys(right, False).withColumnsRenamed({"id": "id_b", "undated": "late_b"})
    late = u.where("late_a").join(v, "key").select("id_a", "id_b").unionByName(u.where("not late_a").join(v.where("late_b"), "key").select("id_a", "id_b"))
    return pairs.select("id_a", "id_b").unionByName(late.select("id_a", "id_b")).distinct()


def weighted(left: DataFrame, right: DataFrame, p: MatchParameters) -> DataFrame:
    """Edges (id_a, id_b, w, place, day_a, day_b, n_a, n_b): logarithm of the odds that a candidate pair is one entity, the least token both share.

    Both sides are those of alike: n says for how many records each row stands.
    """
    total = right.agg(F.sum("n")).first()[0]
    if not total:
        return left.select(F.col("id").alias("id_a"), F.col("id").alias("id_b"), F.lit(0.0).alias("w"), F.lit("").alias("place"), F.col("day").alias("day_a"), F.col("day").alias("day_b"), F.col("n").alias("n_a"), F.col("n").alias("n_b")).where("false")
    rarity = right.select("id", F.explode("tokens").alias("token"), "n")
    counts = rarity.groupBy("token").agg(F.sum("n").alias("n"))
    rarity = rarity.drop("n")
    rare = rarity.join(counts, "token").groupBy("id").agg(F.collect_list(F.struct("token", F.log(F.lit(float(total)) / F.col("n")).alias("rare"))).alias("rare"))
    days = right.where("day is not null").groupBy("day").agg(F.log(F.lit(float(total)) / F.sum("n")).alias("day_rare"))
    b = right.join(rare, "id", "left").join(days, "day", "left").select(F.col("id").alias("id_b"), "rare", "day_rare", *(F.col(c).alias(f"{c}_b") for c in ("day", "km", "minutes", "named", "n")))
    a = left.select(F.col("id").alias("id_a"), "tokens", *(F.col(c).alias(f"{c}_a") for c in ("day", "km", "minutes", "named", "n")))
    pairs = candidates(left, right, p).join(a, "id_a").join(b, "id_b")
    shared = F.aggregate(F.filter(F.coalesce("rare", F.array().cast("array<struct<token: string, rare: double>>")), lambda r: F.array_contains("tokens", r["token"])), F.lit(0.0), lambda s, r: s + r["rare"])
    both = F.col("named_a") & F.col("named_b")
    name = F.when(shared > 0, shared + math.log(p.share)).when(both, math.log((1 - p.share) / 20)).otherwise(0.0)
    apart = F.abs(F.col("day_a") - F.col("day_b"))
    day = F.when(apart.isNull(), 0.0).when(apart == 0, F.col("day_rare") + math.log(p.same_day)).when(apart == 1, F.col("day_rare") + math.log(p.next_day)).otherwise(-20.0)

    def close(x: str, slack: float) -> Column:
        u, v = F.col(f"{x}_a"), F.col(f"{x}_b")
        off = F.greatest(F.abs(F.log(u / v)) - slack / F.greatest(u, v), F.lit(0.0))
        chance = 2 * p.tolerance / p.spread
        near = math.log(p.close / chance)
        return F.when((u > 0) & (v > 0), F.when(off <= p.tolerance, near).when(off <= 2 * p.tolerance, math.log((1 - p.close) / 4 / chance)).otherwise(math.log((1 - p.close) / 20))).otherwise(0.0)

    w = name + day + close("km", p.slack_km) + close("minutes", p.slack_minutes) + math.log(p.prior / total)
    place = F.array_min(F.array_intersect("tokens", F.transform("rare", lambda r: r["token"])))
    return pairs.select("id_a", "id_b", w.alias("w"), place.alias("place"), "day_a", "day_b", "n_a", "n_b")


def pruned(edges: DataFrame) -> DataFrame:
    """Meta-blocking by weighted nodes: an edge stays if it is no weaker than the mean of one of its ends (and has any chance).

    An edge counts for all records that its other end stands for; rounding never lifts a mean over the strongest edge.
    """
    a, b = Window.partitionBy("id_a"), Window.partitionBy("id_b")
    kept = edges.where("w > -7")
    mean = lambda n, over: F.least(F.sum(F.col("w") * F.col(n)).over(over) / F.sum(n).over(over), F.max("w").over(over))
    return kept.withColumns({"ma": mean("n_b", a), "mb": mean("n_a", b)}).where("w >= ma or w >= mb").drop("ma", "mb")


def _messages(rest: DataFrame, p: MatchParameters) -> DataFrame:
    """Edges (with o, xa, xb, n_a, n_b) after messages of one-to-one matching between edges that share a record, sent until they are stable.

    Records with many equal choices need some thousand rounds. So what still moves after the first is cut into connected parts,
    and each part gets its rounds in one task; only parts too large for one go on as they began.
    """
    rest, moved = _rounds(rest, p, p.shared_rounds)
    if moved < p.change:
        return rest
    parts = _connected(rest)
    sizes = parts.groupBy("part").agg((F.count("*") <= p.local_edges).alias("_local"))
    parts = cut_lineage(parts.join(sizes, "part"))
    names = rest.columns
    spark = rest.sparkSession
    within = parts.where("_local").select("part", *names).repartition(max(tasks(spark), int(spark.conf.get("spark.sql.shuffle.partitions"))), "part")
    schema = ", ".join(f"{c} {kind}" for c, kind in rest.dtypes)
    done = cut_lineage(within.sortWithinPartitions("part").mapInArrow(_local_rounds(p, names), schema))
    large = parts.where("not _local").select(*names)
    if large.isEmpty():
        return done
    large, moved = _rounds(large, p, p.most_rounds)
    if moved >= p.change:
        raise RuntimeError(f"the messages still move by {moved} after {p.most_rounds} rounds")
    return done.unionByName(large)


def _rounds(rest: DataFrame, p: MatchParameters, most: int) -> tuple[DataFrame, float]:
    """Edges after most rounds, or when they are stable, and by how much the last one moved them."""
    a, b = Window.partitionBy("id_a"), Window.partitionBy("id_b")
    moved = 0.0
    for _ in range(0, most, p.at_once):
        for _ in range(p.at_once):
            rest = rest.withColumnsRenamed({"xa": "_a", "xb": "_b"})
            rest = rest.withColumn("xa", F.col("o") / (1 + F.greatest(F.sum(F.col("_b") * F.col("n_b")).over(a) - F.col("_b"), F.lit(0.0))))
            rest = rest.withColumn("xb", F.col("o") / (1 + F.greatest(F.sum(F.col("xa") * F.col("n_a")).over(b) - F.col("xa"), F.lit(0.0))))
            rest = rest.withColumn("moved", F.greatest(F.abs(F.log(F.col("xa") / F.col("_a"))), F.abs(F.log(F.col("xb") / F.col("_b"))))).drop("_a", "_b")
        rest = cut_lineage(rest)
        moved = rest.agg(F.max("moved")).first()[0] or 0.0
        rest = rest.drop("moved")
        if moved < p.change:
            break
    return rest, moved


def _connected(edges: DataFrame) -> DataFrame:
    """edges with part, the least id_a among all edges connected with each. Parts take each other's least and its own in turn, so the rounds grow as the logarithm of a part's width."""
    a, b = Window.partitionBy("id_a"), Window.partitionBy("id_b")
    edges = edges.withColumn("part", F.col("id_a"))
    while True:
        new = edges.withColumn("_p", F.min("part").over(b)).withColumn("_p", F.min("_p").over(a))
        of = new.groupBy(F.col("id_a").alias("_p")).agg(F.min("_p").alias("_q"))
        new = cut_lineage(new.join(of, "_p").withColumn("_p", F.least("_p", "_q")).drop("_q"))
        ended = new.where("_p < part").isEmpty()
        edges = new.drop("part").withColumnRenamed("_p", "part")
        if ended:
            return edges


def _local_rounds(p: MatchParameters, names: list[str]):
    """Rounds for whole parts, some at a time; a part is left as soon as it is stable, so its result doesn't depend on the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for table in groups(batches, ("part",)):
            held.append(table)
            size += len(table)
            if size >= p.local_edges:
                yield from _stable(pa.concat_tables(held), p, names)
                held, size = [], 0
        if held:
            yield from _stable(pa.concat_tables(held), p, names)

    return run


def _stable(edges: pa.Table, p: MatchParameters, names: list[str]) -> Iterator[pa.RecordBatch]:
    place = lambda c: np.unique(edges[c].to_numpy(), return_inverse=True)[1]
    ia, ib, part = place("id_a"), place("id_b"), place("part")
    o, xa, xb, na, nb = numbers(edges, "o", "xa", "xb", "n_a", "n_b")
    out_a, out_b, row = xa.copy(), xb.copy(), np.arange(len(o))
    for _ in range(0, p.most_rounds, p.at_once):
        for _ in range(p.at_once):
            was_a, was_b = xa, xb
            xa = o / (1 + np.maximum(np.bincount(ia, xb * nb)[ia] - xb, 0.0))
            xb = o / (1 + np.maximum(np.bincount(ib, xa * na)[ib] - xa, 0.0))
        out_a[row], out_b[row] = xa, xb
        moved = np.maximum(np.abs(np.log(xa / was_a)), np.abs(np.log(xb / was_b)))
        moves = np.bincount(part, moved >= p.change)[part] > 0
        if not moves.all():
            ia, ib, part, o, xa, xb, na, nb, row = (v[moves] for v in (ia, ib, part, o, xa, xb, na, nb, row))
            if not len(row):
                break
            ia, ib, part = (np.unique(v, return_inverse=True)[1] for v in (ia, ib, part))
    else:
        raise RuntimeError(f"the messages still move by {moved.max()} after {p.most_rounds} rounds")
    found = {"xa": pa.array(out_a), "xb": pa.array(out_b)}
    yield from pa.table([found.get(c, edges[c]) for c in names], names=names).to_batches()


def _supported(edges: DataFrame) -> DataFrame:
    """edges with new: the greatest confidence of a neighbouring edge: same name, and the day of both records one before or one after."""
    known = edges.where("place is not null and day_a is not null and day_b is not null and confidence > 0.01")
    groups = known.groupBy("place", "day_a", "day_b").agg(F.max("confidence").alias("c"))
    shifted = groups.withColumn("_d", F.explode(F.array(F.lit(-1), F.lit(1)))).groupBy("place", (F.col("day_a") + F.col("_d")).alias("day_a"), (F.col("day_b") + F.col("_d")).alias("day_b")).agg(F.max("c").alias("new"))
    return edges.join(shifted, ["place", "day_a", "day_b"], "left").withColumn("new", F.coalesce("new", F.lit(0.0)))


def propagated(edges: DataFrame, p: MatchParameters) -> DataFrame:
    """(id_a, id_b, confidence) when messages and the support by neighbours are stable. Support only grows, so it ends.

    n_a and n_b are the records that the ends stand for (1 if edges have no such columns): all of them get equal messages, so
    one edge holds these for all pairs, and sums take it so many times.
    """
    edges = edges if "n_a" in edges.columns else edges.withColumns({"n_a": F.lit(1), "n_b": F.lit(1)})
    a, b = Window.partitionBy("id_a"), Window.partitionBy("id_b")
    odds = lambda w: F.exp(F.least(w, F.lit(40.0)))
    graph = edges.withColumns({"o": odds(F.col("w")), "alone": F.sum("n_b").over(a) + F.sum("n_a").over(b) == 2})
    graph = cut_lineage(graph.withColumns({"xa": F.col("o"), "xb": F.col("o"), "support": F.lit(0.0)}))
    worth = None
    while True:
        alone, rest = graph.where("alone"), graph.where("not alone")
        graph = alone.unionByName(_messages(rest, p))
        ratio = F.col("xa") * F.col("xb") / F.col("o")
        graph = cut_lineage(_supported(graph.withColumn("confidence", ratio / (1 + ratio))))
        if worth is None:  # how much more often the neighbours of a match match than those of another edge
            sure, not_ = F.col("confidence") > 0.9, F.col("confidence") < 0.1
            n = graph.agg(*(F.coalesce(F.sum(F.when(c, F.col("n_a") * F.col("n_b"))), F.lit(0)).alias(k) for k, c in {"a": sure & (F.col("new") > 0.5), "b": sure, "c": not_ & (F.col("new") > 0.5), "d": not_}.items())).first()
            worth = min(2.0, max(0.0, math.log((n.a + 1) / (n.b + 2) * (n.d + 2) / (n.c + 1))))
        grown = graph.agg(F.max(F.col("new") - F.col("support"))).first()[0]
        if not worth or grown is None or grown * worth < p.change:
            return graph.select("id_a", "id_b", "confidence")
        support = F.greatest("support", "new")
        o = odds(F.col("w") + worth * support)
        graph = graph.withColumns({"xa": F.when(F.col("alone"), o).otherwise(F.col("xa")), "xb": F.when(F.col("alone"), o).otherwise(F.col("xb")), "o": o, "support": support}).drop("confidence", "new")


def alike(records: DataFrame) -> DataFrame:
    """One row for all records of a side that are equal in all but id: the least id, and n, how many they are.

    They have the same edges, and of equal confidences the least id is taken, so no other can be in a pair.
    """
    same = ["tokens", "named", "day", "km", "minutes"]
    return records.groupBy(*same).agg(F.min("id").alias("id"), F.count("*").alias("n")).select("id", *same, "n")


def linked(left: DataFrame, right: DataFrame, p: MatchParameters = MatchParameters()) -> DataFrame:
    """(id_a, id_b, confidence) of pairs of left and right that are one entity, each record in one pair at most.

    Both sides: id, tokens array<string>, named boolean, day int, km double, minutes double; id is unique, all else may be
    null (tokens empty). A record without a day has partners only through a listed name and a distance or duration. Of equal confidences
    the pair of smaller ids is taken; an empty side gives an empty result.
    """
    left, right = cut_lineage(alike(left)), cut_lineage(alike(right))
    found = propagated(pruned(weighted(left, right, p)), p).where(F.col("confidence") > p.accept)
    a, b = Window.partitionBy("id_a").orderBy(F.desc("confidence"), "id_b"), Window.partitionBy("id_b").orderBy(F.desc("confidence"), "id_a")
    return found.withColumn("_ra", F.row_number().over(a)).where("_ra = 1").withColumn("_rb", F.row_number().over(b)).where("_rb = 1").drop("_ra", "_rb")
