"""N-gram Jaccard join by universe partition and pigeonhole, with exact verification.

1. Every text becomes the set of its word shingles. Equal sets are one class from here on, so copies,
   however many, are one node; only members of classes, never pairs of copies, are listed.
2. A class shows the signatures of its size bands (``segments``): segments and, where cheaper,
   one-deletion neighbourhoods. Linked classes share more signatures than their partition has spare
   ones. In the order from the most to the least frequent signature each class drops as many as are
   spare; the rarest signature that two linked classes share is then dropped by neither.
3. Groups of classes that show a signature are candidates. A group isn't expanded into pairs: its most
   central member (the one whose signatures are most frequent) is compared with all others, verified
   pairs are joined to components, and the group is finished once it lies in one component. After two
   such rounds small groups (up to ``SMALL``) compare the pairs that lie in different components.
   Larger groups are narrowed: members are told apart by their differences to the pivot. Of two linked
   members in different components at least one isn't linked to the pivot, which bounds how much of their
   differences they must share; so they share one of the first items of both, rarest first (see
   ``_narrowed``), and items that hardly any member has separate nearly all of them at once. The narrower
   groups go through the same steps, with new pivots, until all are settled; each lacks its old pivot, so
   they shrink. Where up to ``FEW`` members of a narrower group come into question as the one with less
   difference, these are compared with all others.
4. Every candidate pair is verified on the whole sets: ``100 * common >= percent * union``.

Nothing about documents, candidates or components reaches the driver, except a bitmap of fixed size
that keeps texts outside of all groups from being shuffled.

Defined results: a null, empty or wordless text has an empty set, links with nothing and is a component
of its own; a text with fewer words than a shingle is one shingle; ties don't occur, as a component
takes its least id; repeated ids and rows are kept, row for row; a null id counts for nothing in the
least id; an empty table gives an empty result; other columns are ignored. Sets and shingles are
identified by 64-bit hashes; n classes collide with a probability below n * n / 2**65.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from faremill.llm.bitfilter import BitFilter, bit_filter
from faremill.llm.common import discard, each_text, fresh, stored, text_of
from faremill.llm.graph import components
from faremill.llm.segments import WordHashes, allocate, set_id, shingles, signatures

#: Members of a group whose pairs are compared directly; and ``first`` members that are compared with all of a larger one.
SMALL, FEW = 64, 8
ROUNDS = 2
#: Portions of all signatures, shuffled one after the other; each portion's shuffle is gone before the next.
PORTIONS = 4
SET = T.StructType(
    [T.StructField("n", T.LongType()), T.StructField("id", T.LongType()), T.StructField("signatures", T.ArrayType(T.LongType()))]
)


def _set_udf(k: int, percent: int):
    """The set's size, identity and signatures; no signatures where the task has shown this set before."""

    def make(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes, shown = WordHashes(), set()
        for batch in batches:
            sizes, ids, found = [], [], []
            for text in each_text(batch):
                items = shingles(text, k, hashes)
                own = set_id(items) if len(items) else None
                new = own is not None and own not in shown
                if new:
                    if len(shown) > 100_000:
                        shown.clear()
                    shown.add(own)
                sizes.append(len(items))
                ids.append(own)
                found.append(signatures(items, percent) if new else np.empty(0, np.int64))
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *found])))
            yield pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), lists], ["n", "id", "signatures"])

    return F.arrow_udf(make, SET)


def _wanted_sets(k: int, wanted: BitFilter):
    """(class, items) of the texts that may be wanted: one Python pass that filters and reads."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            batch = batch[wanted.passes(batch["key"].to_numpy())]
            items = [shingles(text, k, hashes) for text in batch["text"]]
            items = [x for x in items if len(x)]
            held = pd.Series([x.astype(np.int64) for x in items], dtype=object)
            yield pd.DataFrame({"class": pd.Series([set_id(x) for x in items], dtype="Int64"), "items": held})

    return make


def _wanted_class(k: int, wanted: BitFilter):
    """Whether a row may be wanted, and the class of those that may."""

    def make(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for keys, texts in batches:
            maybe = wanted.passes(keys.to_numpy())
            items = [shingles(t, k, hashes) if m else () for t, m in zip(texts, maybe)]
            yield pd.DataFrame({"maybe": maybe, "id": pd.array([set_id(x) if len(x) else None for x in items], dtype="Int64")})

    return F.pandas_udf(make, T.StructType([T.StructField("maybe", T.BooleanType()), T.StructField("id", T.LongType())]))


def _spare(band: Column, percent: int) -> Column:
    """How many signatures a class may drop in a band."""
    spare = F.lit(0)
    for at in range(60):  # 1.5 ** 60 shingles
        part = allocate(at, percent)
        if part and part.spare:
            spare = F.when(band == at, part.spare).otherwise(spare)
    return spare


def _shared_signatures(sets: DataFrame, portion: int) -> DataFrame:
    """(sig, class, seen) of the portion's signatures that several classes show."""
    mine = F.pmod(F.shiftright("sig", 8), F.lit(PORTIONS)) == portion  # the low bits are the band
    shown = sets.select("class", F.explode("signatures").alias("sig")).where(mine)
    by_sig = Window.partitionBy("sig").orderBy("class")
    firsts = shown.withColumn("new", F.coalesce(F.lag("class").over(by_sig) != F.col("class"), F.lit(True)))
    counted = firsts.withColumn("seen", F.sum(F.col("new").cast("long")).over(Window.partitionBy("sig")))
    return counted.where((F.col("seen") > 1) & F.col("new")).select("sig", "class", "seen")


def _groups(sets: DataFrame, percent: int) -> DataFrame:
    """(grp, class, weight, p0), stored: groups of at least two classes that share a signature neither has dropped,
    and the most central member."""
    parts = [stored(_shared_signatures(sets, portion), "shared-signatures") for portion in range(PORTIONS)]
    shared = reduce(DataFrame.union, parts)
    band = F.col("sig").bitwiseAND(F.lit(255))
    own = Window.partitionBy("class", "band")
    ranked = shared.withColumn("band", band).withColumns(
        {
            "place": F.row_number().over(own.orderBy(F.desc("seen"), "sig")),
            "weight": F.sum("seen").over(own),
        }
    )
    kept = ranked.where(F.col("place") > _spare(F.col("band"), percent)).select("sig", "class", "weight")
    # signatures with the same members are one group
    members = kept.groupBy("sig").agg(
        F.count("*").alias("n"),
        F.bit_xor("class").alias("x"),
        F.bit_xor(F.xxhash64("class")).alias("y"),
        F.min("class").alias("low"),
        F.max("class").alias("high"),
    )
    named = members.where(F.col("n") > 1).select("sig", F.xxhash64("n", "x", "y", "low", "high").alias("grp"))
    groups = kept.join(named, "sig").groupBy("grp", "class").agg(F.max("weight").alias("weight"))
    chosen = groups.groupBy("grp").agg(F.max(F.struct("weight", "class")).alias("pivot"))
    groups = stored(groups.join(chosen, "grp").select("grp", "class", "weight", F.col("pivot.class").alias("p0")), "groups")
    discard(*parts)
    return groups


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that link."""
    one, two = (sets.select(F.col("class").alias(x), F.col("items").alias(f"{x}_items")) for x in "ab")
    both = pairs.join(one, "a").join(two, "b")
    common = F.size(F.array_intersect("a_items", "b_items"))
    union = F.size("a_items") + F.size("b_items") - common
    return both.where(common * 100 >= union * percent).select("a", "b")


def _labelled(groups: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return groups.withColumn("label", F.col("class"))
    joined = groups.join(labels.select(F.col("node").alias("class"), "label"), "class", "left")
    return joined.withColumn("label", F.coalesce("label", "class"))


def _open(groups: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members, with labels, of groups that lie in several components."""
    labelled = _labelled(groups.drop("label"), labels)
    apart = labelled.groupBy("grp").agg(F.min("label").alias("least"), F.max("label").alias("most"), F.count("*").alias("n"))
    apart = apart.where(F.col("least") < F.col("most")).select("grp", "n")
    return labelled.drop("n").join(apart, "grp")


def _with_pivot(groups: DataFrame) -> DataFrame:
    chosen = groups.groupBy("grp").agg(F.max(F.struct("weight", "class", "label")).alias("pivot"))
    return groups.join(chosen, "grp").withColumns({"p": F.col("pivot.class"), "p_label": F.col("pivot.label")}).drop("pivot")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _pairs_within(groups: DataFrame) -> DataFrame:
    """Pairs that lie in different components, one of them marked ``first``; for groups where these are few."""
    keep = lambda x: groups.select("grp", F.col("class").alias(x), F.col("label").alias(f"{x}_label"), F.col("first").alias(f"{x}_first"))
    near = keep("a").where("a_first").join(keep("b"), "grp")
    # of two first ones, each pair once
    apart = (F.col("a_label") != F.col("b_label")) & ((F.col("a") < F.col("b")) | ~F.col("b_first"))
    return _ordered(near.where(apart).select("a", "b"))


def _narrowed(large: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(grp, class, width, first): narrower groups in which linked members of different components meet again.

    A member's items that no other one has can't be shared, so with r others it links with none of more
    than a = r (100 + percent) / percent - n items. Members that no other one is small enough for, or that
    are too large for all others, are done: so are pages of one template with much text of their own.

    D(x) is the symmetric difference of x and the pivot p, d(x) its size. Linked x and y of sizes n and m
    differ in at most h(n + m) = (n + m)(100 - percent)/(100 + percent) items, which is also the difference
    of D(x) and D(y), so these share at least (d(x) + d(y) - h) / 2 items, and at least one: else
    d(x) + d(y) <= h(n + m) <= h(m + |p|) + d(x), and y would be linked to p. Items are ordered by how
    many members of the group have them, rarest first. The first shared item is then among the first
    d - (d(x) + d(y) - h) / 2 + 1 of both: of the one with less difference among its first h / 2 + 1,
    which makes it ``first`` there, and of the other as far as the band of the first one's d allows.
    Items that a single member has are counted, but make no group.
    """
    members = large.select("p", "class", "label").distinct()
    pivots = sets.select(F.col("class").alias("p"), F.col("items").alias("p_items"))
    both = members.join(sets, "class").join(pivots, "p")
    mine, lacking = F.array_except("items", "p_items"), F.array_except("p_items", "items")
    told = both.select(
        "p", "class", "label", F.size("items").alias("n"), F.size(mine).alias("m"), F.concat(mine, lacking).alias("away")
    ).where(F.size("away") > 0)
    reach = F.floor((F.col("n") + F.floor(F.col("n") * 100 / percent)) * (100 - percent) / (100 + percent))
    lines = told.select(
        "p", "class", "label", "n", "m", F.size("away").alias("d"), reach.alias("h"), F.posexplode("away").alias("at", "item")
    )
    lines = stored(lines, "differences")
    seen = lines.groupBy("p", "item").agg(F.count("*").alias("seen")).where(F.col("seen") > 1)
    shared = lines.join(seen, ["p", "item"])
    held = shared.where(F.col("at") < F.col("m")).groupBy("p", "class").agg(F.count("*").alias("held"))
    bounds = told.select("p", "class", "n", "m").join(held, ["p", "class"], "left")
    common = F.col("n") - F.col("m") + F.coalesce("held", F.lit(0))
    bounds = bounds.select("p", "class", "n", F.floor(common * (100 + percent) / percent - F.col("n")).alias("a"))
    ends = bounds.groupBy("p").agg(F.min("n").alias("least"), F.max("a").alias("most"))
    alive = bounds.join(ends, "p").where((F.col("a") >= F.col("least")) & (F.col("n") <= F.col("most")))
    shared = shared.join(alive.select("p", "class"), ["p", "class"], "left_semi")
    own = Window.partitionBy("p", "class")
    alone = F.col("d") - F.count("*").over(own)
    placed = shared.withColumn("place", alone + F.row_number().over(own.orderBy("seen", "item")))
    columns = ["p", "item", "class", "label", "n", "d", "h", "place"]
    placed = stored(placed.where(F.col("place") <= F.col("h") + 2).select(*columns), "placed")
    discard(lines)
    # bands of d grow by a tenth; a band's floor is taken a little lower than it is
    band = lambda x: F.floor(F.log(x) / math.log(1.1))
    least = F.greatest(band(F.greatest(F.lit(1), F.col("d") - F.col("h"))) - 1, F.lit(0))
    fits = lambda b: F.col("place") <= F.col("d") + 1 - F.greatest(
        F.lit(1), F.ceil((F.floor(F.pow(F.lit(1.1), b)) - 1 + F.col("d") - F.col("h")) / 2)
    )
    leads = F.col("place") <= F.floor(F.col("h") / 2) + 1
    # members meet a first one or nobody, so only bands in which an item has a first one count
    firsts = placed.where(leads).groupBy("p", "item").agg(F.collect_set(band(F.col("d"))).alias("bands"))
    bands = F.filter("bands", lambda b: (b >= least) & (b <= band(F.col("d"))) & fits(b))
    spread = placed.join(firsts, ["p", "item"]).select(*columns, F.explode(bands).alias("band"))
    first = (F.col("band") == band(F.col("d"))) & leads
    marked = spread.select(F.xxhash64("p", "item", "band").alias("key"), "class", "label", F.col("n").alias("width"), first.alias("first"))
    marked = stored(marked, "narrowed")
    discard(placed)
    named = marked.groupBy("key").agg(
        F.count("*").alias("n"),
        F.bit_xor("class").alias("x"),
        F.bit_xor(F.xxhash64("class", "first")).alias("y"),
        F.min("label").alias("low"),
        F.max("label").alias("high"),
        F.max("first").alias("any"),
    )
    named = named.where((F.col("low") < F.col("high")) & F.col("any"))
    alike = named.select("key", F.xxhash64("n", "x", "y").alias("grp"))
    narrow = marked.join(alike, "key").groupBy("grp", "class").agg(F.max("first").alias("first"), F.first("width").alias("width"))
    narrow = stored(narrow, "narrower")
    discard(marked)
    return narrow


def _fresh_pivots(groups: DataFrame) -> DataFrame:
    """Adds p and p_label: of the first ones the least, which links with all that any page of its template links with."""
    order = F.struct("first", (-F.col("width")).alias("w"), F.xxhash64("grp", "class").alias("h"), "class", "label")
    chosen = groups.groupBy("grp").agg(F.max(order).alias("pivot"))
    return groups.join(chosen, "grp").withColumns({"p": F.col("pivot.class"), "p_label": F.col("pivot.label")}).drop("pivot")


def link_classes(texts: DataFrame, classes: DataFrame, k: int, percent: int, spent: DataFrame | None = None) -> DataFrame:
    """(node, label) of all classes that link with another. ``texts``: doc_id, text; ``classes``: doc_id, class, signatures.

    ``spent``, a stored table behind ``classes``, is deleted once the groups are known.
    """
    groups = _groups(classes, percent)
    wanted = groups.select("class").distinct()
    # one text of each wanted class
    holders = classes.groupBy("class").agg(F.min("doc_id").alias("doc_id")).join(wanted, "class", "left_semi")
    holders = stored(holders, "holders")
    if spent is not None:
        discard(spent)
    keyed = texts.select(F.xxhash64("doc_id").alias("key"), "text")
    shape = T.StructType([T.StructField("class", T.LongType()), T.StructField("items", T.ArrayType(T.LongType()))])
    near = keyed.mapInPandas(_wanted_sets(k, bit_filter(holders, "doc_id")), shape)
    # the bitmap lets a few others pass
    near = near.join(holders, "class", "left_semi")
    sets = stored(near.groupBy("class").agg(F.first("items").alias("items")), "sets")

    labels, open_groups = None, groups
    for turn in range(ROUNDS):
        open_groups = _open(open_groups, labels)
        if turn == 0:
            paired = open_groups.withColumns({"p": F.col("p0"), "p_label": F.col("p0")})
        else:
            rest = open_groups.join(
                open_groups.where(F.col("class") == F.col("p0")).select("grp", F.col("label").alias("home")), "grp"
            )
            paired = _with_pivot(rest.where(F.col("label") != F.col("home")).drop("home")).select("grp", "p", "p_label").distinct()
            paired = open_groups.join(paired, "grp")
        pairs = paired.where(F.col("label") != F.col("p_label")).select(F.col("p").alias("a"), F.col("class").alias("b"))
        labels = _merged(labels, _verified(_ordered(pairs), sets, percent))
        open_groups = stored(_open(open_groups, labels), "open-groups")
    return _settled(open_groups, labels, sets, percent)


def _settled(groups: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Labels after all open groups: (grp, class, label, n, p0), where p0 has been compared with all members."""
    groups = groups.withColumns({"first": F.lit(True), "p": F.col("p0")})
    while True:
        leading = groups.groupBy("grp").agg(F.count_if("first").alias("leading"))
        groups = groups.join(leading, "grp")
        few = (F.col("n") <= SMALL) | (F.col("leading") <= FEW)
        labels = _merged(labels, _verified(_pairs_within(groups.where(few)), sets, percent))
        large = _open(groups.where(~few).drop("leading"), labels)
        if large.isEmpty():
            return labels
        narrow = _open(_narrowed(large, sets, percent), labels)
        narrow = stored(_fresh_pivots(narrow).drop("width"), "narrowed-groups")
        pairs = narrow.where(F.col("label") != F.col("p_label")).select(F.col("p").alias("a"), F.col("class").alias("b"))
        labels = _merged(labels, _verified(_ordered(pairs), sets, percent))
        groups = stored(_open(narrow.drop("p_label"), labels), "open-groups")


def _merged(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """Labels after more edges: components of the graph whose nodes are the labels so far."""
    if labels is None:
        return components(edges)
    name = lambda x: labels.select(F.col("node").alias(x), F.col("label").alias(f"{x}_label"))
    lifted = edges.join(name("a"), "a", "left").join(name("b"), "b", "left")
    more = components(
        lifted.select(F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b"))
    ).select(F.col("node").alias("old"), F.col("label").alias("new"))
    kept = labels.join(more, labels["label"] == more["old"], "left").select("node", F.coalesce("new", "label").alias("label"))
    added = more.join(labels, more["old"] == labels["node"], "left_anti").select(F.col("old").alias("node"), F.col("new").alias("label"))
    return stored(kept.union(added), "labels")


def document_sets(docs: DataFrame, k: int, percent: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, class (null for an empty set) and signatures, one row per document, stored.

    One pass over the texts; every set's signatures are in one of its documents' rows at least.
    """
    made = docs.select(F.col(doc_id).alias("doc_id"), _set_udf(k, percent)(text_of(text)).alias("s"))
    named = made.select("doc_id", F.col("s.n").alias("n_shingles"), F.col("s.id").alias("class"), "s.signatures")
    return stored(named, "document-sets")


def class_components(
    docs: DataFrame, sets: DataFrame, k: int, percent: int, doc_id: str = "doc_id", text: str = "text", shown: DataFrame | None = None
):
    """(class, label, component_id): every class's component and the least id in it.

    ``shown``, where given, is a stored table with the signatures that ``sets`` then lacks; it is deleted.
    """
    texts = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    full = sets.where(F.col("class").isNotNull())
    labels = link_classes(texts, (sets if shown is None else shown).where(F.col("class").isNotNull()), k, percent, shown)
    least = full.groupBy("class").agg(F.min("doc_id").alias("low"), F.count("*").alias("n"))
    named = least.join(labels.select(F.col("node").alias("class"), "label"), "class", "left")
    named = named.withColumn("label", F.coalesce("label", "class"))
    by_label = named.groupBy("label").agg(F.min("low").alias("component_id"), F.sum("n").alias("n_rows"))
    return named.select("class", "label").join(by_label, "label")


def join_documents(
    docs: DataFrame, k: int = 4, percent: int = 85, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    sets = document_sets(docs, k, percent, doc_id, text)
    found = class_components(docs, sets, k, percent, doc_id, text).select("class", "component_id")
    joined = sets.join(found, "class", "left")
    own = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "n_shingles", own.alias("component_id"))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with one of each component: the one with the least id, once.

    Texts that the bitmap clears of belonging to a component of several stay where they are; only the
    others are joined and, where an id and text come more than once, reduced to one row.
    """
    shown = document_sets(docs, k, percent, doc_id, text)
    sets = stored(shown.drop("signatures"), "document-classes")
    found = class_components(docs, sets, k, percent, doc_id, text, shown).where(F.col("n_rows") > 1)
    inside = stored(sets.select("doc_id", "class").join(found, "class").select("doc_id", "class", "label"), "component-members")
    first = inside.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "class")).alias("w"))
    winners = first.select(F.col("w.doc_id").alias("winner_id"), F.col("w.class").alias("winner_class"))
    found_by = _wanted_class(k, bit_filter(inside, "doc_id"))
    kind, side = fresh(docs, "__class"), fresh(docs, "__inside")
    looked = docs.withColumn(kind, found_by(F.xxhash64(F.col(doc_id)), text_of(text)))
    maybe = looked.where(F.col(kind)["maybe"]).withColumn(kind, F.col(kind)["id"])
    members = inside.select(F.col("doc_id").alias("member_id"), F.col("class").alias("member_class"), F.lit(True).alias(side)).distinct()
    tagged = maybe.join(members, maybe[doc_id].eqNullSafe(F.col("member_id")) & (maybe[kind] == F.col("member_class")), "left")
    tagged = tagged.drop("member_id", "member_class")
    alone = tagged.where(F.col(side).isNull()).select(*docs.columns)
    best = tagged.where(F.col(side)).join(
        winners, F.col(doc_id).eqNullSafe(F.col("winner_id")) & (F.col(kind) == F.col("winner_class")), "left_semi"
    )
    whole = F.struct(*(F.col(c) for c in docs.columns))
    once = best.groupBy(doc_id, kind).agg(F.first(whole).alias(side)).select(f"{side}.*")
    clear = looked.where(~F.col(kind)["maybe"]).drop(kind)
    return clear.select(*docs.columns).union(alone.union(once))
