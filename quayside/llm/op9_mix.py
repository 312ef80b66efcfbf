"""Mixing sources to target weights with DataFrame functions only.

Sizes are numbers of words. The words of a source lie one after the other, by a hash of the document, and are packed into
blocks of ``BLOCK`` words. A source's target asks for a number of draws; each draw goes to an output shard by a hash, so
that the counts of a shard by source are one multinomial draw given the totals. A shard's counts then become slots: the
draws of a source are numbered shard by shard, and number i takes the block at place i of a pseudorandom permutation of
the source's blocks (``permuted``), which begins anew, in another order, after the last block. As a target is at most three
times the source, no block is taken more often than that, and draws differ by one at most between the blocks of a
source. Inside a shard the sources are mixed by a permutation of the slots. Slots and blocks meet in a join on (source,
block): ``packed`` is the mix block by block, ``mix_report`` what it takes of each document, ``mixed`` the same
as documents.

Targets: source i by code point (null last) weighs 1, 2, 3, 1, 2, 3, ... and gets its share of all words, at most three
times its own; what is left over goes to the others by weight, which has the closed form used here (the first sources by
3 * size / weight are full, the others share the rest).

No window gathers a source: places are summed per (source, chunk) first, with a number of chunks that follows the
partition setting, then over the chunks.

Defined results: a null or empty text has size 0 and is not taken. Null is a source of its own. Rows that repeat a
document are mixed as documents of their own; rows alike in id and text share the words taken equally often.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.session import scratch_path

BLOCK = 128
SHARD = 4096
MOST = 3
WEIGHTS = 3
#: Rounds of the permutations. After r rounds a number is where it was with a probability of 2^-r.
ROUNDS = 24
#: Shards that are numbered in one window.
GROUP = 1024
_SPACE = r"[\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    """Number of words; pieces of the split that are empty are none."""
    parts = F.split(text, _SPACE)
    edges = (F.element_at(parts, 1) == "").cast("long") + ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("long")
    return F.when(text.isNull() | (text == ""), 0).otherwise(F.size(parts) - edges).cast("long")


def _placed(docs: DataFrame) -> DataFrame:
    """One row per document, written once since it is read several times: doc_id, source, key (of the source), size,
    alike (hash of the text), chunk, n (its number in the chunk), start (words of its source before it)."""
    spark = docs.sparkSession
    chunks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "source",
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("key"),
        size_of(F.col("text")).alias("size"),
        F.xxhash64("text").alias("alike"),
    ).withColumn("chunk", F.pmod(F.xxhash64("doc_id", "alike"), F.lit(chunks)))
    order = Window.partitionBy("key", "chunk").orderBy("doc_id", "alike")
    inner = rows.withColumn("n", F.row_number().over(order)).withColumn("within", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    path = scratch_path(spark, "mix")
    inner.write.parquet(path)
    stored = spark.read.schema(inner.schema).parquet(path)
    sums = stored.groupBy("key", "chunk").agg(F.sum("size").alias("words"))
    earlier = sums.select("key", "chunk", (F.sum("words").over(Window.partitionBy("key").orderBy("chunk")) - F.col("words")).alias("earlier"))
    return stored.join(earlier, ["key", "chunk"]).withColumn("start", F.col("earlier") + F.col("within")).drop("earlier", "within")


def _targets(rows: DataFrame) -> DataFrame:
    """Per source: key, source_size, target. Only one row for each source goes through the windows."""
    sources = rows.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("weight", ((F.row_number().over(by_name) - 1) % WEIGHTS + 1).cast("double")).withColumn("most", F.col("source_size") * MOST)
    full_first = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before, rest, every = (full_first.rowsBetween(*r) for r in ((Window.unboundedPreceding, -1), (0, Window.unboundedFollowing), (Window.unboundedPreceding, Window.unboundedFollowing)))
    # what a unit of weight gets when all earlier sources are full and this one and the later share the rest
    unit = (F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0))) / F.sum("weight").over(rest)
    shared = F.when(unit * F.col("weight") <= F.col("most"), F.struct((F.col("most") / F.col("weight")).alias("at"), unit.alias("unit")))
    level = ranked.withColumn("shared", shared).withColumn("level", F.min("shared").over(every)["unit"])
    most = F.col("most").cast("double")
    return level.select("key", "source_size", F.coalesce(F.least(most, F.col("level") * F.col("weight")), most).alias("target"))


def permuted(number: Column, n: Column, seed: Column) -> Column:
    """A keyed bijection of 0 .. n - 1 for any n: each round mirrors the numbers at a point drawn for the round, and each
    pair of mirror images changes places or stays by a bit drawn for the pair."""

    def swapped(x: Column, turn: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(seed, turn), n) - x, n)
        return F.when(F.xxhash64(turn, seed, F.greatest(x, other)).bitwiseAND(F.lit(1)) == 1, other).otherwise(x)

    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), number, swapped)


def _spread(rows: DataFrame, *by: str) -> DataFrame:
    """Rows that unfold to many more, dealt over a fixed number of tasks: by their bytes they would be merged into a few."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def _counts(targets: DataFrame) -> DataFrame:
    """Draws of each source for each shard: key, blocks (of the source), shard, n. Draws are made in chunks, so no row
    unfolds to all of a source's."""
    blocks = F.ceil(F.col("source_size") / BLOCK).cast("long")
    draws = F.least(F.round(F.col("target") * blocks / F.col("source_size")).cast("long"), MOST * blocks)
    sources = targets.where("source_size > 0").select("key", blocks.alias("blocks"), draws.alias("draws"))
    shards = F.ceil(F.sum("draws").over(Window.partitionBy()) / SHARD).cast("long")
    chunked = sources.withColumn("shards", shards).where("draws > 0").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), ((F.col("draws") - 1) / SHARD).cast("long"))))
    last = F.least(F.col("draws"), (F.col("chunk") + 1) * SHARD) - 1
    each = _spread(chunked, "key", "chunk").withColumn("draw", F.explode(F.sequence(F.col("chunk") * SHARD, last)))
    return each.groupBy("key", "blocks", F.pmod(F.xxhash64("key", "draw"), F.col("shards")).alias("shard")).agg(F.count("*").alias("n"))


def _slots(targets: DataFrame) -> DataFrame:
    """One row per slot of the mix: key, block, shard, slot. A shard's slots are numbered from 0."""
    counts = _counts(targets).withColumn("group", (F.col("shard") / GROUP).cast("long"))
    groups = counts.groupBy("key", "group").agg(F.sum("n").alias("sum"))
    before = groups.select("key", "group", (F.sum("sum").over(Window.partitionBy("key").orderBy("group")) - F.col("sum")).alias("before"))
    in_source = F.sum("n").over(Window.partitionBy("key", "group").orderBy("shard")) - F.col("n")
    of_shard = Window.partitionBy("shard")
    in_shard = F.sum("n").over(of_shard.orderBy("key").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    counted = counts.withColumn("inner", in_source).join(before, ["key", "group"]).withColumn("first", F.col("before") + F.col("inner"))
    counted = counted.withColumn("place", in_shard).withColumn("total", F.sum("n").over(of_shard))
    each = _spread(counted, "key", "shard").withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))).withColumn("draw", F.col("first") + F.col("i"))
    lap = (F.col("draw") / F.col("blocks")).cast("long")
    block = permuted(F.col("draw") % F.col("blocks"), F.col("blocks"), F.xxhash64("key", lap))
    return each.select("key", block.alias("block"), "shard", permuted(F.col("place") + F.col("i"), F.col("total"), F.xxhash64("shard")).alias("slot"))


def _pieces(rows: DataFrame) -> DataFrame:
    """One row per document and block it has words in: the row's columns, block, from, to (words of the document)."""
    first, last = (F.col("start") / BLOCK).cast("long"), ((F.col("start") + F.col("size") - 1) / BLOCK).cast("long")
    pieces = rows.where("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
    pieces = pieces.withColumn("from", F.greatest(F.col("block") * BLOCK - F.col("start"), F.lit(0)))
    return pieces.withColumn("to", F.least((F.col("block") + 1) * BLOCK - F.col("start"), F.col("size")))


def _taken(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """The pieces, with draws (slots that take the piece's block) and at (the first of them: shard, slot)."""
    drawn = _slots(targets).groupBy("key", "block").agg(F.count("*").alias("draws"), F.min(F.struct("shard", "slot")).alias("at"))
    return _pieces(rows).join(drawn, ["key", "block"], "left").withColumn("draws", F.coalesce("draws", F.lit(0)))


def mix_report(docs: DataFrame, slots: bool = False) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken; with ``slots`` also n_slots (that hold words of it)
    and first_shard, first_slot (null where it is not taken)."""
    rows = _placed(docs)
    targets = _targets(rows)
    none = F.lit(0).cast("long")
    words = _taken(rows, targets).groupBy("key", "chunk", "n").agg(F.sum((F.col("to") - F.col("from")) * F.col("draws")).alias("taken"), F.sum("draws").alias("n_slots"), F.min("at").alias("at"))
    found = rows.join(words, ["key", "chunk", "n"], "left").join(targets, "key")
    more = [F.coalesce("n_slots", none).alias("n_slots"), F.col("at.shard").alias("first_shard"), F.col("at.slot").alias("first_slot")] if slots else []
    return found.select("doc_id", "size", "source_size", "target", F.coalesce("taken", none).alias("taken"), *more)


def _texts(docs: DataFrame) -> DataFrame:
    """One of the rows alike in id and text: id, hash, text, row (the other columns)."""
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    return docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"), "text", others.alias("row")).dropDuplicates(["id", "hash"])


def _cut(places: Column, made: Callable[[Column, Column], Column]) -> Column:
    """``made(place, words of the place)`` for every place (from, to) of the text, which is split once for all of them."""
    words = F.filter(F.split("text", _SPACE), lambda w: w != "")
    some = lambda w, m: F.array_join(F.slice(w, (m["from"] + 1).cast("int"), (m["to"] - m["from"]).cast("int")), " ")
    return F.flatten(F.transform(F.array(words), lambda w: F.transform(places, lambda m: made(m, some(w, m)))))


def _same(a: str = "doc_id", b: str = "alike") -> Column:
    return F.col("id").eqNullSafe(F.col(a)) & (F.col("hash") == F.col(b))


def packed(docs: DataFrame) -> DataFrame:
    """The mix, one row per slot: shard, slot, source, block, n_words, text (of the block, words joined by one space).
    A block has ``BLOCK`` words, the last of a source may have fewer."""
    rows = _placed(docs)
    place = F.struct("block", (F.col("start") + F.col("from")).alias("at"), "from", "to")
    plan = _pieces(rows).groupBy("key", "chunk", "n", "doc_id", "alike").agg(F.collect_list(place).alias("places"))
    cut = _texts(docs).join(plan, _same())
    parts = cut.select("key", F.explode(_cut(F.col("places"), lambda m, t: F.struct(m["block"].alias("block"), m["at"].alias("at"), (m["to"] - m["from"]).alias("n"), t.alias("text")))).alias("part"))
    blocks = parts.groupBy("key", F.col("part.block").alias("block")).agg(F.sum("part.n").alias("n_words"), F.array_sort(F.collect_list(F.struct("part.at", "part.text"))).alias("parts"))
    source = F.when(F.col("key") != "", F.expr("substring(key, 2)"))
    found = _slots(_targets(rows)).join(blocks, ["key", "block"])
    return found.select("shard", "slot", source.alias("source"), "block", "n_words", F.array_join(F.col("parts.text"), " ").alias("text"))


def write_shards(docs: DataFrame, path: str) -> None:
    """The mix as Parquet in ranges of shards, in the order of shard and slot."""
    packed(docs).repartitionByRange("shard").sortWithinPartitions("shard", "slot").write.parquet(path)


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a document whose blocks were all drawn k times appears k times whole;
    where single blocks were drawn once more, their words follow as rows of their own, joined by one space. ``n_chars``
    follows the text. Rows alike in id and text appear once for each time one of them is taken, with the columns of one."""
    rows = _placed(docs)
    every = F.min("draws").over(Window.partitionBy("key", "chunk", "n"))
    pieces = _taken(rows, _targets(rows)).withColumn("whole", every)
    more = F.when(F.col("draws") > F.col("whole"), F.struct("from", "to", (F.col("draws") - F.col("whole")).cast("int").alias("times")))
    plan = pieces.groupBy("key", "chunk", "n", "doc_id", "alike").agg(F.first("whole").cast("int").alias("whole"), F.array_sort(F.collect_list(more)).alias("more"))
    both = _texts(docs).join(plan.where("whole > 0 OR size(more) > 0"), _same())
    parts = F.flatten(_cut(F.col("more"), lambda m, t: F.array_repeat(t, m["times"])))
    pieces = F.concat(F.array_repeat(F.col("text"), F.col("whole")), parts)
    cut = both.select("row", F.explode(pieces).alias("text"))
    changed = {"text": F.col("text")} | ({"n_chars": F.char_length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return cut.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(spark.read.parquet(f"{sf_dir}/documents.parquet"), slots=True)
