"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, exact verification.

1. Items and documents become the hashes of their word shingles. A window can only be similar enough if
   it shares a shingle with the item, and all shingles it shares are worth that part of the item at
   least; so documents' shingles are looked up among the items', and documents whose hits on an item are
   worth less are left out. This loses nothing.
2. Each hit implies a start: where the window stands if the shingle is at the item's place in it. Hits at most
   an item's length apart form a cluster; a cluster whose shingles are worth the part is tried at every start
   between the least and the greatest that its hits imply, and ``SHIFT`` words to either side, so that parts in
   another order are found too. Each window gets a 64-bit SimHash over its shingles, weighted by how rare they
   are among the items.
3. Fingerprints are cut into ``RADIUS + 1`` blocks. Two fingerprints within the radius agree in one block
   at least, so joining windows and their items on block number and value finds all of them. Step 1 proposes
   the pairs and the blocks only discard: blocks of three bits alone would propose nearly every pair.
4. Pairs within the radius are verified by the exact weighted Jaccard similarity of their bags of shingles.
   (At the similarity asked for, fingerprints lie 10 bits apart on average, with a deviation of 3; the
   radius of 19 is three deviations away. Equal passages have distance 0.)

Everything is DataFrame functions. Items' shingles are broadcast after they have been counted, and joined
by shuffle if they are many; so are the ids of the documents that go on, so that texts stay where they are.

Defined results: null or empty items and texts, and items without an id, match nothing; an item with fewer words than a shingle is
one shingle and matches texts of just these words; equal items are each reported; a document is reported
once per item with its best window (most similar, then first); repeated rows are reported once, repeated
ids with other texts apart; a null id is kept; extra columns are ignored; an empty table gives an empty
result. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from faremill.llm.common import SPACES, fresh, small_side, stored, text_of

K = 5
PERCENT = 80
RADIUS = 19
SHIFT = 2
BITS = 64


def _hashes(text: Column) -> Column:
    """Hashes of the lower-cased words; blanks are made alike first, as a split at one character needs no pattern."""
    text = F.lower(text)
    for blank in SPACES[1:]:
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.transform(F.array_remove(F.split(text, " "), ""), lambda w: F.xxhash64(w))


def _step(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: F.xxhash64(a, b))


def _from(items: Column, start: int, length: Column) -> Column:
    return F.slice(items, F.lit(start + 1), F.greatest(length, F.lit(0)))


def with_shingles(df: DataFrame, text: str, k: int, name: str) -> DataFrame:
    """Add the shingles of ``k`` words, in order, to the frame: each as a hash of its words' hashes.

    A text with fewer words has one shingle, of all its words; a text without words has none.
    """
    columns = df.columns
    words = fresh(df, "__words")
    df = df.withColumn(words, _hashes(text_of(text)))
    # windows of 1, 2, 4, ... words, and from these the one of k
    doubled, width = {1: words}, 1
    while 2 * width <= k:
        name_of = fresh(df, f"__words{2 * width}")
        left = F.col(doubled[width])
        df = df.withColumn(name_of, _step(_from(left, 0, F.size(left) - width), _from(left, width, F.size(left) - width)))
        width *= 2
        doubled[width] = name_of
    rolled, held = doubled[width], width
    while held < k:
        part = max(w for w in doubled if held + w <= k)
        count = F.greatest(F.size(words) - (held + part - 1), F.lit(0))
        name_of = fresh(df, f"__rolled{held + part}")
        df = df.withColumn(name_of, _step(_from(F.col(rolled), 0, count), _from(F.col(doubled[part]), held, count)))
        rolled, held = name_of, held + part
    short = (F.size(words) > 0) & (F.size(words) < k)
    whole = F.array(F.xxhash64(words, F.lit("short")))
    return df.select(*columns, F.when(short, whole).otherwise(F.col(rolled)).alias(name))


def _blocks(fingerprint: Column) -> Column:
    """(number, value) of the ``RADIUS + 1`` blocks of a fingerprint."""
    edges = [BITS * i // (RADIUS + 1) for i in range(RADIUS + 2)]
    cut = [
        F.struct(
            F.lit(i).alias("number"),
            F.shiftrightunsigned(fingerprint, low).bitwiseAND(F.lit((1 << (high - low)) - 1)).alias("value"),
        )
        for i, (low, high) in enumerate(zip(edges, edges[1:]))
    ]
    return F.array(*cut)


def _fingerprints(bags: DataFrame, *keys: str) -> DataFrame:
    """SimHash and total weight of each bag of (h, c, w): the sign of the weighted sum at every bit."""
    worth = F.col("c") * F.col("w")
    sums = [F.sum(F.when(F.getbit("h", F.lit(at)) == 1, worth).otherwise(-worth)).alias(f"s{at}") for at in range(BITS)]
    summed = bags.groupBy(*keys).agg(*sums, F.sum(worth).alias("total"))
    bits = F.lit(0).cast("long")
    for at in range(BITS):
        one = F.shiftleft(F.lit(1).cast("long"), at)
        bits = bits.bitwiseOR(F.when(F.col(f"s{at}") > 0, one).otherwise(F.lit(0).cast("long")))
    return summed.select(*keys, "total", bits.alias("print"))


def item_index(benchmark: DataFrame, k: int = K, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, h, at, n, w): every item's shingles by place, their number, and the shingle's weight.

    The weight is 1000 ln(1 + items / items with the shingle), rounded, so that sums are exact.
    """
    items = benchmark.where(F.col(item_id).isNotNull()).select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    listed = with_shingles(items, "text", k, "shingles").select(
        "item_id", F.size("shingles").alias("n"), F.posexplode_outer("shingles").alias("at", "h")
    )
    listed = stored(listed.where(F.col("h").isNotNull()), "item-shingles")
    every = listed.select(F.count_distinct("item_id").alias("items"))
    among = listed.groupBy("h").agg(F.count_distinct("item_id").alias("df"))
    weight = F.round(1000 * F.log1p(every.scalar() / F.col("df"))).cast("long").alias("w")
    return stored(listed.join(among.select("h", weight), "h"), "item-index")


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Equality of the columns in both frames, a null equal to a null."""
    same = F.lit(True)
    for column in columns:
        same = same & left[column].eqNullSafe(right[column])
    return same


def _clusters(hits: DataFrame, worth: DataFrame, key: list[str], percent: int) -> DataFrame:
    """key, n, low and high: the starts to be tried for each cluster of hits that may reach the similarity."""
    hits = hits.withColumn("pos", F.col("start") + F.col("at")).distinct()
    order = Window.partitionBy(*key).orderBy("pos")
    cut = F.coalesce((F.col("pos") - F.lag("pos").over(order) > F.col("n")).cast("int"), F.lit(0))
    numbered = hits.withColumn("cut", cut).withColumn("cluster", F.sum("cut").over(order))
    ends = [F.first("n").alias("n"), F.max("w").alias("w"), F.min("start").alias("low"), F.max("start").alias("high")]
    by_place = numbered.groupBy(*key, "cluster", "at").agg(*ends)
    ends = [F.first("n").alias("n"), F.sum("w").alias("seen"), F.min("low").alias("low"), F.max("high").alias("high")]
    whole = by_place.groupBy(*key, "cluster").agg(*ends).join(worth, "item_id")
    whole = whole.where(F.col("seen") * 100 >= F.col("worth") * percent)
    low = F.greatest(F.col("low") - SHIFT, F.lit(0))
    return whole.select(*key, "n", low.alias("low"), F.greatest(F.col("high") + SHIFT, low).alias("high"))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, k: int = K, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, text_hash, item_id, similarity, start (word), distance (bits) of every similar window, best per item."""
    index = item_index(benchmark, k)
    source = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    source = source.withColumn("text_hash", F.xxhash64("text"))
    # outer, as Spark puts a filter on the array's size before other explodes, which works out the shingles several times more
    rolled = with_shingles(source, "text", k, "shingles")
    rolled = rolled.select("doc_id", "text_hash", F.posexplode_outer("shingles").alias("pos", "h")).where(F.col("h").isNotNull())
    key = ["doc_id", "text_hash", "item_id"]
    hits = rolled.join(small_side(index), "h").select(*key, "at", "n", "w", (F.col("pos") - F.col("at")).alias("start"))
    hits = stored(hits, "benchmark-hits")
    worth = index.groupBy("item_id").agg(F.sum("w").alias("worth"))
    seen = hits.groupBy(*key, "at").agg(F.max("w").alias("w")).groupBy(*key).agg(F.sum("w").alias("seen"))
    able = seen.join(worth, "item_id").where(F.col("seen") * 100 >= F.col("worth") * percent).select(*key)
    able = stored(able, "able")
    places = _clusters(hits.join(able, _same(hits, able, key), "left_semi"), worth, key, percent)
    # texts of the few documents that go on; equal rows once
    few = able.select("doc_id", "text_hash").distinct()
    chosen = source.join(small_side(few), _same(source, few, ["doc_id", "text_hash"]), "left_semi")
    chosen = with_shingles(chosen, "text", k, "shingles").groupBy("doc_id", "text_hash").agg(F.first("shingles").alias("shingles"))
    placed = places.join(chosen.select(F.col("doc_id").alias("own_id"), F.col("text_hash").alias("own_hash"), "shingles"),
                         F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_hash") == F.col("own_hash")))
    begins = F.sequence("low", F.least("high", F.greatest(F.col("low"), F.size("shingles") - 1)))
    windows = F.transform(begins, lambda b: F.struct(b.alias("begin"), F.slice("shingles", b + 1, F.col("n")).alias("held")))
    # clusters of one document may overlap in their starts
    moved = placed.select(*key, F.inline_outer(windows)).where(F.col("begin").isNotNull()).groupBy(*key, "begin").agg(F.first("held").alias("held"))
    bags = moved.select(*key, "begin", F.explode("held").alias("h")).groupBy(*key, "begin", "h").agg(F.count("*").alias("c"))
    weights = index.select("h", "w").distinct()
    rare = F.round(1000 * F.log1p(index.select(F.count_distinct("item_id").cast("double")).scalar())).cast("long")
    bags = bags.join(small_side(weights), "h", "left").withColumn("w", F.coalesce("w", rare))
    bags = stored(bags, "window-bags")
    item_bags = index.groupBy("item_id", "h").agg(F.count("*").alias("c"), F.max("w").alias("w"))
    own = _fingerprints(item_bags, "item_id").select("item_id", F.col("print").alias("item_print"), F.col("total").alias("item_total"))
    blocks = own.withColumn("block", F.explode(_blocks(F.col("item_print"))))
    windows = _fingerprints(bags, *key, "begin")
    near = windows.withColumn("block", F.explode(_blocks(F.col("print")))).join(blocks, ["item_id", "block"])
    distance = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))
    near = near.withColumn("distance", distance).where(F.col("distance") <= RADIUS)
    near = near.select(*key, "begin", "total", "item_total", "distance").distinct()
    theirs = item_bags.select("item_id", "h", F.col("c").alias("item_c"))
    common = (
        bags.join(theirs, ["item_id", "h"])
        .groupBy(*key, "begin")
        .agg(F.sum(F.col("w") * F.least("c", "item_c")).alias("common"))
    )
    left, right = near.alias("l"), common.alias("r")
    both = left.join(
        right,
        F.col("l.doc_id").eqNullSafe(F.col("r.doc_id"))
        & (F.col("l.text_hash") == F.col("r.text_hash"))
        & (F.col("l.item_id") == F.col("r.item_id"))
        & (F.col("l.begin") == F.col("r.begin")),
    ).select("l.*", "r.common")
    union = F.col("total") + F.col("item_total") - F.col("common")
    found = both.where(F.col("common") * 100 >= union * percent).withColumn("similarity", F.col("common") / union)
    best = F.max(F.struct("similarity", (-F.col("begin")).alias("first"), "distance")).alias("best")
    return (
        found.groupBy(*key)
        .agg(best)
        .select(
            *key,
            F.col("best.similarity").alias("similarity"),
            (-F.col("best.first")).alias("start"),
            F.col("best.distance").cast("int").alias("distance"),
        )
    )


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item of which it holds a passage."""
    return contaminated(docs, benchmark).drop("text_hash")


def keep_untouched(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without a passage of any item, with their own columns."""
    marks = contaminated(docs, benchmark, doc_id=doc_id, text=text)
    marks = stored(marks.select(F.col("doc_id").alias("marked_id"), F.col("text_hash").alias("marked_hash")).distinct(), "marked")
    same = docs[doc_id].eqNullSafe(marks["marked_id"]) & (F.xxhash64(text_of(docs[text])) == marks["marked_hash"])
    return docs.join(small_side(marks), same, "left_anti")
