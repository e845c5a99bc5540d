"""N-gram Jaccard join by a grouped prefix filter, and the components of its links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sideline.functions.lineage import written
from sideline.llm.bloom import bloom_words, may_contain, words_for
from sideline.llm.common import arrays, byte_words, each_batch, shingles, word_hashes
from sideline.llm.components import components

#: shingles that one pass of counting holds at a time (8 bytes each), and bytes of text made into sets together
_CHUNK, _TEXT = 2_000_000, 2 << 20


def _repeated(n: int):
    """Shingles that a chunk of documents repeats, with their number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes()
        held, size = [], 0

        def counts() -> pa.RecordBatch:
            values, times = np.unique(np.concatenate(held), return_counts=True)
            more = times > 1
            return pa.RecordBatch.from_arrays([pa.array(values[more].view(np.int64)), pa.array(times[more])], names=["token", "n"])

        for batch in batches:
            for text in batch.column("_text").to_pylist():
                if text:
                    held.append(shingles(byte_words(text), n, hashes))
                    size += len(held[-1])
                    if size >= _CHUNK:
                        yield counts()
                        held, size = [], 0
        if held:
            yield counts()

    return run


def frequent_shingles(docs: DataFrame, n: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``most`` of the most frequent shingles of all documents, sorted, and log2 of their counts.

    They only decide the order in which a document's shingles are compared, never the result. A
    shingle that no chunk repeats is counted as rare; it is in no more documents than there are
    chunks. The least count is the smallest power of two that keeps the list within ``most``.
    """
    found = docs.mapInArrow(_repeated(n), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    level = F.floor(F.log2("n")).cast("int")
    kept = written(found.withColumn("level", level).drop("n"), "shingles")
    sizes = {r.level: r["count"] for r in kept.groupBy("level").count().collect()}
    least, total = 64, 0
    for value in sorted(sizes, reverse=True):
        total += sizes[value]
        if total > most:
            break
        least = value
    rows = kept.filter(F.col("level") >= least).toArrow()
    tokens = rows.column("token").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], rows.column("level").to_numpy()[order].astype(np.uint8)


def prefix_size(n: int, percent: int) -> int:
    """So many shingles in order of rarity, one of which any set linked with this one contains."""
    return n - -(-percent * n // 100) + 1


#: words of the signature of a set
_WORDS = 4


def signature(held: np.ndarray) -> np.ndarray:
    """Four 64-bit words: for each of 256 classes of shingles whether their number is odd.

    Every shingle that only one of two sets has changes one bit, so sets differ in at least as many
    shingles as their signatures differ in bits.
    """
    odd = np.bincount((held >> np.uint64(56)).astype(np.int64), minlength=64 * _WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def _prefixes(n: int, percent: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes()
        frequent, levels = shared.value

        def batch(b: pa.RecordBatch) -> pa.RecordBatch:
            sizes, keys, groups, prefixes, marks = [], [], [], [], []
            for text in b.column("_text").to_pylist():
                held = shingles(byte_words(text), n, hashes) if text else np.empty(0, np.uint64)
                sizes.append(len(held))
                marks.append(signature(held))
                if not len(held):
                    keys.append(None)
                    groups.append(None)
                    prefixes.append(held)
                    continue
                order = held
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, held), len(frequent) - 1)
                    rank = np.where(frequent[at] == held, levels[at], 0)
                    order = held[np.lexsort((held, rank))]
                prefix = order[: prefix_size(len(held), percent)]
                keys.append(xxhash.xxh3_128_digest(held.tobytes()))
                groups.append(xxhash.xxh3_128_digest(prefix.tobytes() + len(held).to_bytes(8, "little")))
                prefixes.append(prefix)
            return pa.RecordBatch.from_arrays(
                [b.column("_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(groups, pa.binary()),
                 arrays([p.view(np.int64) for p in prefixes], pa.int64()),
                 arrays(marks, pa.int64())],
                names=["id", "n", "set_key", "prefix_key", "prefix", "mark"])

        yield from each_batch(batch, _TEXT)(batches)

    return run


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes()

        def batch(b: pa.RecordBatch) -> pa.RecordBatch:
            held = [shingles(byte_words(t or ""), n, hashes).view(np.int64) for t in b.column("_text").to_pylist()]
            return pa.RecordBatch.from_arrays([b.column("_id"), arrays(held, pa.int64())], names=["id", "held"])

        yield from each_batch(batch, _TEXT)(batches)

    return run


def _up(x: str, y: str) -> str:
    """Whole-number quotient, rounded up."""
    return f"(({x} + {y} - 1) div {y})"


def _overlap(a: str, b: str, percent: int) -> str:
    """Common shingles that linked sets of sizes a and b have: ceil(p (a + b) / (100 + p))."""
    return _up(f"{percent} * ({a} + {b})", str(100 + percent))


def _may_share(a: str, i: str, b: str, j: str, percent: int) -> str:
    """Whether sets of sizes a and b with a common shingle at places i and j (from 0) can be linked.

    Their sizes must fit, and besides that shingle only the smaller number of those before it and of
    those after it can be common.
    """
    most = f"least({i}, {j}) + least({a} - {i}, {b} - {j})"
    return f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b}) AND {most} >= {_overlap(a, b, percent)}"


def _first_shared(a: str, i: str, b: str, j: str, percent: int) -> str:
    """Whether a common shingle at places i and j can be the first one of linked sets of sizes a and b.

    All others come after it in both. Linked sets have a first one, so no other has to be looked at.
    """
    return f"{i} <= {a} - {_overlap(a, b, percent)} AND {j} <= {b} - {_overlap(a, b, percent)}"


def _alike(a: str, x: str, b: str, y: str, percent: int) -> str:
    """Whether sets of sizes a and b with signatures x and y can be linked; an unknown signature can."""
    bits = " + ".join(f"bit_count({x}[{i}] ^ {y}[{i}])" for i in range(_WORDS))
    return f"coalesce({bits} <= {a} + {b} - 2 * {_overlap(a, b, percent)}, true)"


def _needed(a: str, b: str, percent: int) -> str:
    """Common prefix shingles below which sets of sizes a and b cannot be linked.

    Of two prefixes, every shingle up to
    the end of the one that ends first is in both prefixes or not common, and the rest of that set
    has ceil(p n / 100) - 1 shingles.
    """
    rest = f"greatest({_up(f'{percent} * {a}', '100')}, {_up(f'{percent} * {b}', '100')}) - 1"
    return f"{_overlap(a, b, percent)} - ({rest})"


def _promising(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs of groups (a, b) worth a verification, from rows (grp, n, pos, other) per shingle.

    Counted are the shingles under which two groups happen to be paired, at most their common ones.
    Kept are the pairs with enough of them for a link and, for every group, its best pair if it has
    a third of that. What is left out here is looked at again, whole, in the last step.
    """
    counted = (
        pairs.filter(_may_share("n", "pos", "other.n", "other.pos", percent))
        .groupBy(F.least("grp", "other.grp").alias("a"), F.greatest("grp", "other.grp").alias("b"), F.least("n", "other.n").alias("m"), F.greatest("n", "other.n").alias("n"))
        .count().filter("a < b").withColumn("need", F.expr(_needed("m", "n", percent)))
    )
    sides = counted.select("a", "b", "count", "need", F.explode(F.array("a", "b")).alias("x"))
    best = Window.partitionBy("x").orderBy(F.desc("count"), "a", "b")
    best = sides.withColumn("place", F.row_number().over(best)).filter("place = 1 AND 3 * count >= need")
    return counted.filter("count >= need").select("a", "b").unionByName(best.select("a", "b")).distinct()


def jaccard_components(
    docs: DataFrame, n: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text",
    most_frequent: int = 1 << 20,
) -> DataFrame:
    """Documents linked by 100 * |A and B| >= percent * |A or B| over their word n-gram sets.

    Words lie between ASCII white space, A-Z in lower case; a shorter document has one shingle of
    all its words; shingles are compared by 64-bit hashes.

    1. Shingles repeated among documents are counted; the most frequent ones (a bounded list) come
       last in the order of shingles, the others first, by hash.
    2. A document's prefix is its first n - ceil(p n / 100) + 1 shingles. Documents of equal set are
       one class; classes of equal prefix and size are one group.
    3. Groups meet by prefix shingle. Under a shingle they are ordered by its place in their
       prefixes: a group with few shingles of its own ahead of it comes first and is nearest to all
       others. Each group is paired with the first and with the one before it, as many pairs as there
       are prefix shingles. Pairs that promise a link, and neighbours inside a group, are verified on
       whole sets; their links give first components. Where components still meet under a shingle,
       each group is paired with the first group of another one, and the same follows. This takes in
       large groups of near copies.
    4. Under shingles whose groups are in several components, pairs of different components are
       formed for which the shingle can be the first common one of linked sets, by sizes and places,
       and whose signatures do not differ in more bits than linked sets differ in shingles. They are
       expanded to their classes, held against signatures again and verified. Pairs inside
       a component can't change it and are left out.

    Texts of any length are read whole, a few at a time; a document's set takes 8 bytes per shingle
    in the task that makes it.

    Returns one row per row of ``docs``: id, n_shingles, component_id (smallest id reachable). Null,
    empty and wordless texts have no shingles and link with nothing. Rows that share an id are one
    document, linked with what any of its texts is linked with; a row with a null id links with nothing and has a null component. An empty
    table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    shared = spark.sparkContext.broadcast(frequent_shingles(texts.filter("_id IS NOT NULL").select("_text"), n, most_frequent))
    rows = written(
        texts.mapInArrow(_prefixes(n, percent, shared), "id long, n long, set_key binary, prefix_key binary, prefix array<long>, mark array<long>"), "prefixes")
    usable = rows.filter("id IS NOT NULL AND n > 0")
    classes = written(usable.groupBy("prefix_key", "set_key", "n").agg(F.min("id").alias("cls"), F.first("mark").alias("mark")), "classes")
    groups = usable.groupBy("prefix_key").agg(
        F.min("id").alias("grp"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    members = written(classes.join(classes.groupBy("prefix_key").agg(F.min("cls").alias("grp")), "prefix_key").select("grp", "cls", "n", "mark"), "members")

    # shingles under which several groups meet, with the first group and the one before
    ordered = Window.partitionBy("token").orderBy("pos", "n", "grp")
    entries = groups.select(F.posexplode("prefix").alias("pos", "token"), "grp", "n")
    group = F.struct("grp", "n", "pos")
    met = written(
        entries.withColumns({"first": F.first(group).over(ordered), "before": F.lag(group).over(ordered), "after": F.lead("grp").over(ordered)})
        .filter("before IS NOT NULL OR after IS NOT NULL").drop("after"), "met")

    def linked(pairs: DataFrame) -> DataFrame:
        """The pairs of classes (a, b) that are linked, by their whole sets.

        Sets are made anew from the texts of the classes in question. A Bloom filter of their ids
        keeps most other texts out of the shuffle of the semi-join.
        """
        pairs = written(pairs, "pairs")
        ids = written(pairs.select(F.explode(F.array("a", "b")).alias("_id")).distinct(), "ids")
        words = words_for(ids.count())
        near_ids = texts.withColumn("_words", bloom_words(ids, "_id", words).scalar()).filter(may_contain("_words", "_id", words))
        held = near_ids.select("_id", "_text").join(ids, "_id", "left_semi").mapInArrow(_sets(n), "id long, held array<long>")
        held = written(held, "sets")
        left, right = (held.select(F.col("id").alias(c), F.col("held").alias(f"held_{c}")) for c in "ab")
        both = pairs.join(left, "a").join(right, "b")
        common = "size(array_intersect(held_a, held_b))"
        return both.filter(f"100 * {common} >= {percent} * (size(held_a) + size(held_b) - {common})").select("a", "b").distinct()

    pairs = met.filter("before IS NOT NULL").select(
        "grp", "n", "pos", F.explode(F.array_distinct(F.array("first", "before"))).alias("other"))
    near = _promising(pairs, percent)
    inside = members.withColumn("a", F.lag("cls").over(Window.partitionBy("grp").orderBy("cls"))).filter("a IS NOT NULL").select("a", F.col("cls").alias("b"))
    # an id with several texts is one document: its classes belong together
    several_sets = usable.groupBy("id").agg(F.min("set_key").alias("low"), F.max("set_key").alias("high")).filter("low <> high").select("id")
    of_id = usable.join(several_sets, "id", "left_semi").select("id", "set_key").join(classes.select("set_key", "cls"), "set_key")
    same = of_id.select(F.col("id").alias("a"), F.col("cls").alias("b")).filter("a <> b").distinct()
    first = written(linked(near.unionByName(inside)).unionByName(same), "linked")

    def labelled(links: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Members and groups with their components, and the entries of shingles with several."""
        parts = components(links).withColumnRenamed("node", "cls")
        known = written(members.join(parts, "cls", "left").select("grp", "cls", "n", "mark", F.coalesce("component", "cls").alias("comp")), "members")
        of_group = known.select("grp", "comp").distinct()
        placed = written(met.select("token", "grp", "n", "pos").join(of_group, "grp"), "placed")
        several = placed.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high").select("token")
        return known, of_group, written(placed.join(several, "token"), "mixed")

    # once more between components: each group with the first group of another component
    _, _, mixed = labelled(first)
    whole = Window.partitionBy("token").orderBy("pos", "n", "grp")
    every = Window.partitionBy("token")
    entry = F.struct("pos", "n", "grp", "comp")
    ends = mixed.withColumn("one", F.first(entry).over(whole)).withColumn(
        "two", F.min(F.when(F.col("comp") != F.col("one.comp"), entry)).over(every))
    again = ends.select("grp", "n", "pos", F.when(F.col("comp") != F.col("one.comp"), F.col("one")).otherwise(F.col("two")).alias("other"))
    first = written(first.unionByName(linked(_promising(again, percent))), "linked")
    members, of_group, mixed = labelled(first)
    # m shingles of a group can be common: those under which components meet
    mixed = mixed.withColumn("m", F.count(F.lit(1)).over(Window.partitionBy("grp", "comp")))
    # sets of a group differ past its prefix: its signature counts if it has one set only
    marks = members.join(mixed.select("grp").distinct(), "grp", "left_semi").groupBy("grp").agg(
        F.when(F.count(F.lit(1)) == 1, F.first("mark")).alias("mark"))
    mixed = mixed.join(marks, "grp")
    left, right = (mixed.select("token", *[F.col(c).alias(f"{c}_{s}") for c in ("grp", "n", "pos", "comp", "m", "mark")]) for s in "ab")
    across = (
        left.join(right, "token").filter("comp_a < comp_b").filter(_first_shared("n_a", "pos_a", "n_b", "pos_b", percent))
        .filter(f"least(m_a, m_b) >= {_needed('n_a', 'n_b', percent)}").filter(_alike("n_a", "mark_a", "n_b", "mark_b", percent))
        .select("grp_a", "comp_a", "grp_b", "comp_b").distinct()
    )
    own = of_group.select("grp", F.col("comp").alias("comp_a")).join(of_group.select("grp", F.col("comp").alias("comp_b")), "grp").filter("comp_a < comp_b")
    across = across.unionByName(own.select(F.col("grp").alias("grp_a"), "comp_a", F.col("grp").alias("grp_b"), "comp_b"))
    side = {s: members.select(F.col("grp").alias(f"grp_{s}"), F.col("comp").alias(f"comp_{s}"), F.col("cls").alias(s), F.col("n").alias(f"n_{s}"), F.col("mark").alias(f"mark_{s}")) for s in "ab"}
    expanded = across.join(side["a"], ["grp_a", "comp_a"]).join(side["b"], ["grp_b", "comp_b"]).filter(_alike("n_a", "mark_a", "n_b", "mark_b", percent))
    more = linked(expanded.select("a", "b").distinct())
    found = components(first.unionByName(more))

    of_class = classes.select("set_key", F.col("cls").alias("node")).join(found, "node", "left").select(
        "set_key", F.coalesce("component", "node").alias("component"))
    named = rows.select("id", "n", F.when(F.col("id").isNotNull(), F.col("set_key")).alias("set_key"))
    return named.join(of_class, "set_key", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that are the smallest of their component; rows with a null id all stay.

    Rows that share an id stay together if one of them does. Columns stay as they are.
    """
    found = jaccard_components(docs, n, percent, id_col, text_col, **options)
    gone = found.filter(F.col(id_col) != F.col("component_id")).select(id_col)
    stay = found.filter(F.col(id_col) == F.col("component_id")).select(id_col)
    return docs.join(gone.join(stay, id_col, "left_anti").distinct(), id_col, "left_anti").select(*docs.columns)
