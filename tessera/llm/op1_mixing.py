"""Mixing sources to target weights by pivotal dependent rounding. DataFrame functions only.

A document of a source with target T and size S has T / S copies in expectation: the whole part is given, the fraction is
rounded. Two fractional documents move mass (words) between them, at random and with the right expectations, until one
has a whole copy more or none; the source's words are the same after as before. Blocks of some tens of documents do so
in a fold; each leaves one fractional document, and those meet in blocks of the next level, until a source has one left.
That last one is rounded alone. As long documents go first and the shorter ones make up for what that rounding adds, a
source's words miss its target by less than its mean document, unless nearly all its words are in long ones.

Rows that are equal in doc_id, text and source are one unit: moving mass among equal ones leaves whole copies and one
fraction, whatever the order, so the whole ones are counted and the fraction is what the unit takes to its block. Blocks
are as small, then, whatever share of the rows are equal, and the units' rows are told apart by number at the end.

Targets are found by rounds over the sources, a narrow table however many they are: the level at which the sources below
their caps share the rest rises until none passes its cap. A source's place by code point is its rank in a range-sorted
table and that of the ranges before it. No window is without a key but one over the ranges.

Random numbers are hashes of the documents, and a block's members are sorted: reruns agree, whatever the partitions.

Results for odd input: a null text has size 0. Null sources are one source, after all others. Sources without words have
target 0, and documents without words get the whole part of the copies only (one where the source has no words). A null
doc_id is an id like others; of equal rows some may get a copy more than others, and which means nothing. Very long texts
are counted whole; a document longer than its source's target still gets its copies or not as a whole. An empty table
gives an empty result. Other columns pass through mix(), whatever their names; columns made here start with two
underscores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import n_words, sized, split_join, stage, unstage

WEIGHTS, MOST_COPIES, FAN, SEED = (1, 2, 3), 3, 48, 20240607
#: Rows of one unit that are numbered or made in one piece.
CHUNK = 50_000


def source_key(source: Column) -> Column:
    """A source as a string that is never null."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def source_targets(units: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Staged rows __s (source_key), source, n (rows), source_size, target, __blocks, __mean, __short (words of documents up
    to the mean): one for each source. units: staged rows __s, source, size, c (how many rows there are of it)."""
    s = units.groupBy("__s", "size").agg(F.sum("c").alias("n"), F.first("source").alias("source"))  # sizes first: the mean is needed for a sum
    m = s.groupBy("__s").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("__mean"))
    s = s.join(m, "__s").groupBy("__s").agg(
        F.first("source").alias("source"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("size")).alias("source_size"), F.max("__mean").alias("__mean"),
        F.sum(F.when(F.col("size") <= F.col("__mean"), F.col("n") * F.col("size")).otherwise(0)).alias("__short"),
    )
    s = stage(s, "sources")
    # places by code point, null last: within a range by the order of its rows, and the ranges by their counts
    placed = s.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
    placed = stage(placed.withColumn("__range", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "places")
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = placed.groupBy("__range").agg(F.count("*").alias("k")).withColumn("__before", F.coalesce(F.sum("k").over(before), F.lit(0))).drop("k")
    placed = placed.join(F.broadcast(ranges), "__range")  # a row for each partition
    place = ((F.col("__before") + F.col("__at")) % len(weights) + 1).cast("int")
    placed = placed.withColumn("__w", F.element_at(F.array(*(F.lit(x) for x in weights)), place)).withColumn("__cap", F.col("source_size") * most)
    placed = stage(placed.drop("__range", "__at", "__before"), "weighed")
    total = placed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    capped, level = F.lit(False), None
    while True:  # the level only rises; it stays once no further source passes its cap
        share = placed.agg(F.sum(F.when(capped, F.col("__cap"))).alias("gone"), F.sum(F.when(~capped, F.col("__w"))).alias("w")).first()
        found = (total - (share["gone"] or 0)) / share["w"] if share["w"] else None
        if found is None or found == level:
            break
        level = found
        capped = F.col("__w") * F.lit(float(level)) > F.col("__cap")
    target = F.when(capped, F.col("__cap").cast("double")).otherwise(F.col("__w") * F.lit(float(level or 0)))
    out = stage(placed.select("__s", "source", "n", "source_size", target.alias("target"), F.ceil(F.col("n") / FAN).alias("__blocks"), "__mean", "__short"), "targets")
    unstage(s, placed)
    return out


def _uniform(a: str, b: str) -> str:
    return f"(pmod(xxhash64({SEED}, {a}, {b}), 9007199254740992L) / 9007199254740992D)"


#: A step of the fold: a is the fractional document carried along, x the next one. up: mass that x can give and a can
#: take before one of them is whole; down: the other way. p: the chance of up that keeps both expectations.
_PAIR = f"""
transform(array(struct(a.c as c, x as x,
    least(a.c.s - a.c.m, x.m) as up, least(a.c.m, x.s - x.m) as down)),
  t -> struct(t.c as c, t.x as x, t.up as up, t.down as down,
    t.up + t.down <= 0 or {_uniform('t.c.h', 't.x.h')} * (t.up + t.down) < t.down as rise))[0]
"""
_ROW = "struct({0}.h as h, {0}.id as id, {0}.s as s, {1} as m)"
_FOLD = f"""
aggregate(slice(v, 2, size(v)), struct(v[0] as c, slice(array(struct(v[0].h as h, v[0].id as id, v[0].s as s, true as rise)), 1, 0) as done),
  (a, x) -> transform(array({_PAIR}), t ->
    case
      when t.rise and t.c.s - t.c.m <= t.x.m then struct({_ROW.format('t.x', 't.x.m - (t.c.s - t.c.m)')} as c, concat(a.done, array(struct(t.c.h as h, t.c.id as id, t.c.s as s, true as rise))) as done)
      when t.rise then struct({_ROW.format('t.c', 't.c.m + t.x.m')} as c, concat(a.done, array(struct(t.x.h as h, t.x.id as id, t.x.s as s, false as rise))) as done)
      when t.c.m <= t.x.s - t.x.m then struct({_ROW.format('t.x', 't.x.m + t.c.m')} as c, concat(a.done, array(struct(t.c.h as h, t.c.id as id, t.c.s as s, false as rise))) as done)
      else struct({_ROW.format('t.c', 't.c.m - (t.x.s - t.x.m)')} as c, concat(a.done, array(struct(t.x.h as h, t.x.id as id, t.x.s as s, true as rise))) as done)
    end)[0])
"""


def _level(live: DataFrame) -> DataFrame:
    """live: __s, doc_id, __rid, size, __m (its fraction in words), __blocks."""
    h = F.xxhash64(F.lit(SEED), "doc_id", "__rid")
    e = F.struct(h.alias("h"), F.col("doc_id").alias("id"), F.col("size").cast("double").alias("s"), F.col("__m").alias("m"))
    return live.select("__s", F.pmod(h, F.col("__blocks")).alias("block"), e.alias("e"))


def reduced(level: DataFrame, blocks: int, room: DataFrame | None = None) -> DataFrame:
    """Rows __s, h, id, s, rise: every document of level (__s, block, e) rounded, by a tree of folds. blocks: the
    most that a source has. Each level is a staged table of a row for each block.

    room: __s, give, take: words that other documents of a source can give up or take afterwards. The document that is left
    at the end then goes the way that they can make up for, by chance only if they can for both.
    """
    out = None
    while True:
        folded = level.groupBy("__s", "block").agg(F.sort_array(F.collect_list("e")).alias("v"))
        folded = stage(folded.select("__s", "block", F.expr(_FOLD).alias("r")).select("__s", "block", "r.c", "r.done"), "mix-level")
        done = folded.select("__s", F.explode("done").alias("d")).select("__s", "d.h", "d.id", "d.s", "d.rise")
        out = done if out is None else out.unionByName(done)
        if blocks <= 1:  # one document is left in each source: rounded by its own fraction
            alone = F.expr(f"{_uniform('c.h', '1')} * c.s < c.m")
            if room is not None:
                folded = folded.join(room, "__s", "left").na.fill(0.0, ["give", "take"])
                more, less = F.expr("c.s - c.m - give"), F.expr("c.m - take")
                alone = F.when((more <= 0) & (less <= 0), alone).otherwise(more < less)
            return out.unionByName(folded.select("__s", "c.h", "c.id", "c.s", alone.alias("rise")))
        blocks = -(-blocks // FAN)
        level = folded.select("__s", F.floor(F.col("block") / FAN).alias("block"), F.col("c").alias("e"))


def _units(units: DataFrame, t: DataFrame, total: int) -> DataFrame:
    """units with __base (further whole copies of their rows together) and __m (words of the fraction that is left)."""
    live = split_join(units, t, ["__s"], "n", total)
    mass = F.col("c") * F.col("__f")
    base = F.floor(mass + F.lit(1e-9))
    return live.withColumn("__base", base.cast("long")).withColumn("__m", F.greatest(mass - base, F.lit(0.0)) * F.col("size"))


def rounded(units: DataFrame, targets: DataFrame) -> DataFrame:
    """Staged rows __s, doc_id, __rid, size, c, up: how many of the c equal rows get a copy above the whole part. For units with
    words in sources whose copies are not whole. units: staged rows doc_id, __rid, __s, source, size, c.

    Documents longer than their source's mean go first. What the rounding of their last one adds to the source or takes
    from it, the shorter ones make up for: their fraction is shifted by it. Where they can do so for both ways, the way is
    by chance and the shift has expectation 0; where for one alone, that one is taken, and where for none the nearer. So a
    source misses its target by less than its mean document, unless its shorter documents are too few words for either way.
    """
    rest = F.col("target") / F.col("source_size") - F.floor(F.col("target") / F.col("source_size"))
    t = targets.filter("source_size > 0").withColumn("__f", rest).filter("__f > 0")
    t = stage(t.select("__s", "__f", "__blocks", "__mean", "__short", "n"), "fractions")
    total, most = units.count(), targets.agg(F.max("__blocks")).first()[0] or 1

    def settled(live: DataFrame, name: str, room: DataFrame | None = None) -> DataFrame:
        live = stage(live, name)
        up = reduced(_level(live.filter("__m > 0")), most, room).filter("rise").select(F.col("h").alias("__h"), F.col("id").alias("__id"))
        keyed = live.withColumn("__h", F.xxhash64(F.lit(SEED), "doc_id", "__rid"))
        both = keyed.join(up, (keyed["__h"] == up["__h"]) & keyed["doc_id"].eqNullSafe(up["__id"]) & (keyed["__m"] > 0), "left")
        copies = F.col("__base") + up["__h"].isNotNull().cast("long")
        return stage(both.select("__s", "doc_id", "__rid", "size", "c", copies.alias("up")), f"{name}-up")

    live = units.filter("size > 0").select("__s", "doc_id", "__rid", "size", "c")
    room = t.select("__s", (F.col("__f") * F.col("__short")).cast("double").alias("give"), ((1 - F.col("__f")) * F.col("__short")).cast("double").alias("take"))
    long = settled(_units(live, t, total).filter(F.col("size") > F.col("__mean")), "long", room)
    over = long.groupBy("__s").agg(F.sum(F.col("up") * F.col("size")).alias("__took"), F.sum(F.col("c") * F.col("size")).alias("__of"))
    owed = F.coalesce(F.col("__f") * F.col("__of") - F.col("__took"), F.lit(0.0))
    shifted = F.when(F.col("__short") > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("__f") + owed / F.col("__short")))).otherwise(F.col("__f"))
    t = stage(t.join(over, "__s", "left").select("__s", shifted.alias("__f"), "__blocks", "__mean", "n"), "shifted")
    short = settled(_units(live, t, total).filter(F.col("size") <= F.col("__mean")), "short")
    return long.unionByName(short)


def allotted(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """A row for each unit: doc_id, __rid (hash of text and source), source, size, source_size, target, c (its rows),
    __whole (copies of each), up (how many of the rows get one more)."""
    rows = docs.select("doc_id", F.xxhash64("text", "source").alias("__rid"), source_key(F.col("source")).alias("__s"), "source", n_words(F.col("text")).alias("size"))
    units = stage(rows.groupBy("doc_id", "__rid", "__s", "size").agg(F.first("source").alias("source"), F.count("*").alias("c")), "units")
    targets = source_targets(units, weights, most)
    up = rounded(units, targets)
    cols = ["doc_id", "__rid", "source", "size", "source_size", "target", "c", "__whole", "up"]
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(1)).cast("long")
    ratio = F.col("target") / F.col("source_size")
    t = targets.withColumns({"__whole": whole, "__moves": F.when(F.col("source_size") > 0, ratio - F.floor(ratio) > 0).otherwise(F.lit(False))})
    t = stage(t.select("__s", "source", "source_size", "target", "__whole", "__moves", "n"), "shares")
    total = units.count()
    still = split_join(units.drop("source"), t, ["__s"], "n", total).filter("size = 0 or not __moves").withColumn("up", F.lit(0).cast("long"))
    moving = split_join(up, t, ["__s"], "n", total).filter("__moves")
    return still.select(*cols).unionByName(moving.select(*cols))


def allot(docs: DataFrame, **options) -> DataFrame:
    """doc_id, __rid, source, size, source_size, target, copies for every row of docs."""
    units = stage(allotted(docs, **options), "allotted")
    cols = ["doc_id", "__rid", "source", "size", "source_size", "target"]
    single = units.filter("c = 1").select(*cols, (F.col("__whole") + F.col("up")).alias("copies"))
    # equal rows are made by number, those of large units in pieces that any task may take
    pieces = units.filter("c > 1").withColumn("__k", F.explode(F.expr(f"sequence(0L, (c - 1) div {CHUNK})")))
    pieces = pieces.repartition("doc_id", "__rid", "__k")
    several = pieces.withColumn("__i", F.explode(F.expr(f"sequence(__k * {CHUNK}L + 1, least(c, (__k + 1) * {CHUNK}L))")))
    return single.unionByName(several.select(*cols, (F.col("__whole") + (F.col("__i") <= F.col("up")).cast("long")).alias("copies")))


def mix(docs: DataFrame, **options) -> DataFrame:
    """docs with every row as often as the mix takes it (0 times and more)."""
    units = allotted(docs, **options).filter("__whole > 0 or up > 0")
    units = stage(units.select(F.col("doc_id").alias("__id"), F.col("__rid").alias("__r"), F.col("c").alias("__c"), "__whole", F.col("up").alias("__up")), "copies")
    keyed = docs.withColumn("__rid", F.xxhash64("text", "source"))
    same = keyed["doc_id"].eqNullSafe(F.col("__id")) & (keyed["__rid"] == F.col("__r"))
    both = keyed.join(sized(units, 64), same)
    single = both.filter("__c = 1").withColumn("__n", F.col("__whole") + F.col("__up"))
    if units.filter("__c > 1").limit(1).count():
        # numbered as written: within a share of a unit's rows, and the shares by their counts
        several = stage(both.filter("__c > 1").withColumn("__row", F.monotonically_increasing_id()), "repeated")
        share = F.pmod(F.xxhash64("__row"), F.floor((F.col("__c") - 1) / CHUNK) + 1)
        several = several.withColumn("__share", share)
        key = ["__rid", "doc_id", "__share"]
        counts = several.groupBy(*key).agg(F.count("*").alias("k"))
        before = Window.partitionBy("__rid", "doc_id").orderBy("__share").rowsBetween(Window.unboundedPreceding, -1)
        counts = stage(counts.withColumn("__before", F.coalesce(F.sum("k").over(before), F.lit(0))).select(*(F.col(c).alias(f"{c}_") for c in key), "__before"), "shares")
        nth = several.withColumn("__i", F.row_number().over(Window.partitionBy(*key).orderBy("__row")))
        nth = nth.join(sized(counts, 48), (nth["__rid"] == F.col("__rid_")) & nth["doc_id"].eqNullSafe(F.col("doc_id_")) & (nth["__share"] == F.col("__share_")))
        several = nth.withColumn("__n", F.col("__whole") + (F.col("__before") + F.col("__i") <= F.col("__up")).cast("long"))
        single = single.select(*docs.columns, "__n").unionByName(several.select(*docs.columns, "__n"))
    return single.filter("__n > 0").withColumn("__copy", F.explode(F.expr("sequence(1L, __n)"))).select(*docs.columns)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return allot(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


QUERIES = {"op1_mixing": op1_mixing}
