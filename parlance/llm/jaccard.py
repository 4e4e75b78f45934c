"""Operator 8, exact n-gram Jaccard join by vertical partitioning.

A document's set holds the 64-bit hashes of its distinct 5-word shingles. All shingles are put
in one global order, rare ones first (a fixed-size sketch of heavy shingles, then the hash).
The order is cut into fragments. The head of a set in that order (its prefix) finds the
candidates; the overlap of a candidate pair is counted fragment by fragment, each on its own,
and summed per pair, which is exact in any order of the shingles.

No group of documents is expanded into all its pairs:

1. Equal sets are one class from the start, and only classes take part.
2. A prefix shingle of two classes makes that pair a candidate. Every other one picks one of its
   classes as the pivot, the one that shares most prefix shingles with others (the original of a
   group of near copies), and pairs it with the rest; a group is joined by such stars, linear in
   its size.
3. Components of the links found are computed; a shingle whose classes all lie in one
   component is done. For the rest, pairs across components are checked, so no link between
   different components is lost; pairs inside a component cannot change the result. The result
   is the components only: links inside one are neither listed nor counted.

Prefixes are longer than the shortest sufficient ones, so that a linked pair meets in a tenth
of its shingles there, not in one only; pairs that meet in fewer are dropped unread. So are
pairs across components of which one has fewer shingles in common with all other open
classes together than the link needs: that ends the edited copies of a group that are too
far from its original, without a look at the group's pairs. Two classes that were both
compared with the same pivot share at most as many shingles as the pivot shares with either,
and besides those only shingles that the pivot lacks; a pair that cannot reach the needed
overlap so is not made. Nor is one whose sets differ too much by their parities: each set has
a bitmap of the parity of its shingles in 1,024 cells, and two sets differ in one shingle at
least for each bit that differs. All these bounds are exact.

Edge cases: null and wordless texts have no shingles and are alone in their component; texts
of one to four words have one shingle, the whole sequence; repeated rows are members of one
class; rows with a null id take no part in the naming of components and get a null
component if nothing else is in it; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import Words, bitmap, chunks, has_bits, map_arrow, mix, release, stash, text_buffer
from parlance.llm.graph import components

GRAM = 5
#: Similarity threshold in percent.
PERCENT = 80
#: Prefixes reach this share (percent) beyond the least that two linked sets must meet in, and
#: in return must meet in as many shingles.
EXTRA_PERCENT = 10
#: Counters of the sketch of heavy shingles (one byte each when broadcast: 4 MB), the shingles that
#: are counted together, and how often a shingle must be among them to be reported.
SKETCH = 1 << 22
BLOCK = 1 << 21
BLOCK_LEAST = 3
#: Fragments of the global order.
FRAGMENTS = 8
#: Cells of the parity bitmap of a set, in words of 64.
PARITY_WORDS = 16


def sets(buf: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = Words(buf, offs, fold=True)
    at = words.gram_starts(GRAM)
    grams = words.range_hash(at, at + GRAM) if len(at) else np.zeros(0, np.uint64)
    first = np.searchsorted(at, words.first)
    out = []
    for d in range(len(offs) - 1):
        n = words.first[d + 1] - words.first[d]
        if 0 < n < GRAM:
            out.append(words.range_hash(words.first[d:d + 1], words.first[d + 1:d + 2]))
        else:
            out.append(np.unique(grams[first[d]:first[d + 1]]))
    return out


def set_key(s: np.ndarray) -> int:
    """64-bit key of a set; classes are told apart by it together with the size."""
    with np.errstate(over="ignore"):
        return int(mix(s + np.uint64(0x2545F4914F6CDD1D)).sum(dtype=np.uint64).astype(np.int64)) if len(s) else 0


def _texts(batch: pa.RecordBatch, col: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    raw, offs = text_buffer(batch.column(col))
    for lo, hi in chunks(offs):
        yield lo, hi, sets(raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])


def _signatures(docs: DataFrame, id_type: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, ss in _texts(b, 1):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), b.column(2).slice(lo, hi - lo),
                     pa.array([len(s) for s in ss], pa.int32()), pa.array([set_key(s) for s in ss], pa.int64())],
                    ["id", "x", "n", "k"])

    return map_arrow(docs, run, f"id {id_type}, x long, n int, k long")


def _heavy(docs: DataFrame) -> np.ndarray:
    """Weight (0..31, by powers of two) of each counter's shingles; a function of the table, and
    any such function makes a valid order. Every set is counted, one for equal ones, block by block
    of ``BLOCK`` shingles; a block reports the shingles that it has met ``BLOCK_LEAST`` times, so the
    many rare ones do not fill the counters, whatever the size of the table. Sparse rows (counter,
    count) are summed in Spark; at most ``SKETCH`` of them reach the driver."""
    def report(held: list[np.ndarray]) -> pa.RecordBatch:
        v, n = np.unique(np.concatenate(held), return_counts=True)
        many = n >= BLOCK_LEAST
        return pa.RecordBatch.from_arrays([pa.array((v[many] % np.uint64(SKETCH)).astype(np.int32)), pa.array(n[many])], ["c", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, met, size = [], set(), 0
        for b in batches:
            for _, _, ss in _texts(b, 0):
                for s in ss:
                    if len(s) and (key := (len(s), set_key(s))) not in met:
                        met.add(key)
                        held.append(s)
                        size += len(s)
                if size >= BLOCK:
                    yield report(held)
                    held, met, size = [], set(), 0
        if held:
            yield report(held)

    sums = map_arrow(docs.select("t"), run, "c int, n long").groupBy("c").agg(F.sum("n").alias("n"))
    out = np.zeros(SKETCH, np.uint8)
    level = sums.select("c", F.floor(F.log2("n")).cast("int").alias("w"))
    for b in level.toArrow().to_batches():
        out[b.column(0).to_numpy()] = b.column(1).to_numpy()
    return out


def in_order(s: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The set in the global order: light shingles first, then by hash."""
    return s[np.lexsort((s, weight[(s % np.uint64(len(weight))).astype(np.int64)]))]


def fragment(s: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Fragment of each shingle: the order's light part is cut into equal ranges of the hash,
    the heavy part is the last fragment."""
    light = (s >> np.uint64(32)) * np.uint64(FRAGMENTS - 1) >> np.uint64(32)
    return np.where(weight[(s % np.uint64(len(weight))).astype(np.int64)] > 0, FRAGMENTS - 1, light).astype(np.int32)


def parity(s: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles in each cell, as ``PARITY_WORDS`` words."""
    cells = np.bincount((s % np.uint64(64 * PARITY_WORDS)).astype(np.int64), minlength=64 * PARITY_WORDS)
    return np.packbits((cells & 1).astype(np.uint8)).view(np.int64)


def prefix_size(n: int, percent: int = PERCENT) -> int:
    """Two linked sets of n and m shingles share ``shared(min(n, m))`` shingles of both prefixes:
    at most n - ceil(percent * n / 100) of a set's shingles are not in the other one."""
    return n - -(-percent * n // 100) + shared(n)


def shared(n: int) -> int:
    return max(1, -(-EXTRA_PERCENT * n // 100))


def _prefixes(docs: DataFrame, weight) -> DataFrame:
    """(shingle, n, k): the classes of each prefix shingle, once a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weight.value
        told: set[tuple[int, int]] = set()  # classes this task has sent: one row for all its copies
        for b in batches:
            for _, _, ss in _texts(b, 0):
                ss = [s for s in ss if len(s) and not ((c := (len(s), set_key(s))) in told or told.add(c))]
                if ss:
                    heads = [in_order(s, w)[:prefix_size(len(s))] for s in ss]
                    sizes = [len(h) for h in heads]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(heads).view(np.int64)),
                         pa.array(np.repeat([len(s) for s in ss], sizes).astype(np.int32)),
                         pa.array(np.repeat([set_key(s) for s in ss], sizes))], ["g", "n", "k"])

    return map_arrow(docs.select("t"), run, "g long, n int, k long")


def _segments(docs: DataFrame, wanted, weight) -> DataFrame:
    """(n, k, f, s, z): the shingles by fragment of the rows in the bitmap; z is the set's parity
    bitmap, in one of its rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, bits = weight.value, wanted.value
        for b in batches:
            b = b.filter(pa.array(has_bits(bits, b.column(1).to_numpy(zero_copy_only=False))))
            for _, _, ss in _texts(b, 0):
                ns, ks, fs, parts, zs = [], [], [], [], []
                for s in ss:
                    f, k = fragment(s, w), set_key(s)
                    zs += [parity(s)] + [None] * (len(np.unique(f)) - 1) if len(s) else []
                    for i in np.unique(f).tolist():
                        ns.append(len(s))
                        ks.append(k)
                        fs.append(i)
                        parts.append(s[f == i].view(np.int64))
                if parts:
                    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ns, pa.int32()), pa.array(ks, pa.int64()), pa.array(fs, pa.int32()),
                         pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts))),
                         pa.array(zs, pa.list_(pa.int64()))], ["n", "k", "f", "s", "z"])

    return map_arrow(docs.select("t", "x"), run, "n int, k long, f int, s array<long>, z array<long>")


def _long_enough(a: str, b: str, percent: int):
    """Length filter: the smaller set has at least the needed share of the larger one."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _sets_of(docs: DataFrame, sign: DataFrame, classes: DataFrame, weight) -> DataFrame:
    """The shingles by fragment of the classes (n, k), from one text each."""
    rows = stash(sign.join(classes, ["n", "k"]).groupBy("n", "k").agg(F.min("x").alias("x")), "rows")
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap(rows, "x", rows.count()))
    return stash(_segments(docs, wanted, weight), "segments")


def _overlaps(seg: DataFrame, pairs: DataFrame) -> DataFrame:
    """The candidate pairs (an, ak, bn, bk) with their overlap o, if any: summed partial overlaps."""
    # both sides meet the segments by (n, k, f), so that one exchange of them serves both
    left = seg.select(F.col("n").alias("an"), F.col("k").alias("ak"), "f", F.col("s").alias("x"))
    right = seg.select(F.col("n").alias("bn"), F.col("k").alias("bk"), "f", F.col("s").alias("y"))
    each = pairs.select("an", "ak", "bn", "bk", F.explode(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1))).alias("f"))
    part = (each.join(left, ["an", "ak", "f"]).join(right, ["bn", "bk", "f"])
            .select("an", "ak", "bn", "bk", "f", F.size(F.array_intersect("x", "y")).cast("long").alias("o")))
    # a class may have been sent twice (false positives of the bitmap): a fragment counts once
    once = part.groupBy("an", "ak", "bn", "bk", "f").agg(F.max("o").alias("o"))
    return once.groupBy("an", "ak", "bn", "bk").agg(F.sum("o").alias("o"))


def _links(overlaps: DataFrame, percent: int) -> DataFrame:
    return overlaps.where(F.col("o") * 100 >= (F.col("an") + F.col("bn") - F.col("o")) * percent).select("ak", "bk")


def _edges(links: DataFrame) -> DataFrame:
    return links.select(F.col("ak").alias("u"), F.col("bk").alias("v"))


def _homes(stars: DataFrame, overlaps: DataFrame) -> DataFrame:
    """(n, k, pn, pk, po): for each class, the leading pivot among those that it was compared with
    and, for a pivot, itself, and the overlap with it."""
    pairs = overlaps.join(stars, ["an", "ak", "bn", "bk"])
    first = (F.col("an") == F.col("p.n")) & (F.col("ak") == F.col("p.k"))
    leaf = pairs.select(F.when(first, F.col("bn")).otherwise(F.col("an")).alias("n"),
                        F.when(first, F.col("bk")).otherwise(F.col("ak")).alias("k"), "p", "o")
    own = stars.select(F.col("p.n").alias("n"), F.col("p.k").alias("k"), "p", F.col("p.n").cast("long").alias("o"))
    home = leaf.union(own).groupBy("n", "k").agg(F.max(F.struct("p", "o")).alias("h"))
    return home.select("n", "k", F.col("h.p.n").alias("pn"), F.col("h.p.k").alias("pk"), F.col("h.o").alias("po"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("an").alias("n"), F.col("ak").alias("k")).union(
        pairs.select(F.col("bn").alias("n"), F.col("bk").alias("k"))).distinct()


def _open(named: DataFrame) -> DataFrame:
    """(g, n, k, c) for the shingles whose classes lie in more than one component, and of those
    the classes that have enough such shingles to link across components."""
    before = None
    for _ in range(2):
        groups = named.groupBy("g").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("g")
        met = stash(named.join(groups, "g"), "open")
        able = met.groupBy("n", "k").agg(F.count("*").alias("o")).where(_most(F.col("o"), _shared("n"))).select("n", "k")
        named = stash(met.join(able, ["n", "k"]), "open")
        release(met)
        if before is not None:
            release(before)
        before = named
    return named


def _shared(n: str):
    """``shared`` as an expression."""
    return F.greatest(F.lit(1), F.ceil(F.col(n) * EXTRA_PERCENT / 100))


def _most(met, needed):
    """Whether the shingles of step 3 can do: a pair that was not checked as a star met in less than
    1 / STAR_SHARE of those it needs by shingles of two classes, which step 3 leaves out."""
    return met * STAR_SHARE > needed * (STAR_SHARE - 1)


def _need(percent: int):
    """Overlap of a linked pair, at least."""
    return F.ceil((F.col("an") + F.col("bn")) * percent / (100 + percent) - 1e-9)


def _need_shared(percent: int):
    """Shingles of both prefixes that a linked pair has in common, at least: the prefix less what a
    set may have outside the overlap, for the one of the two that allows less."""
    def of(n: str):
        return _shared(n) - F.ceil(F.col(n) * percent / 100) + _need(percent)  # prefix_size(n) - n + need

    return F.greatest(F.lit(1), F.least(of("an"), of("bn")))


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, keys: bool = False) -> DataFrame:
    """(id, n_shingles, component_id) of every row; with ``keys`` also row_key (hash of id and text)
    and class_key, which tells components apart also where ids repeat."""
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), F.xxhash64(id_col, text_col).alias("x"))
    sign = stash(_signatures(src, id_type), "signatures")
    weight = spark.sparkContext.broadcast(_heavy(src))
    # prefix shingles with two classes at least; one of exactly two classes is that pair, in one row
    heads = _prefixes(src, weight).repartition("g").distinct()
    groups = heads.groupBy("g").agg(F.count("*").alias("m"), F.bit_xor("k").alias("both_k"), F.sum("n").alias("both_n")).where("m > 1")
    heads = heads.join(groups, "g").withColumns({  # the other class of two
        "on": F.when(F.col("m") == 2, (F.col("both_n") - F.col("n")).cast("int")),
        "ok": F.when(F.col("m") == 2, F.col("both_k").bitwiseXOR(F.col("k")))})
    heads = stash(heads.where("m > 2 OR n < on OR (n = on AND k < ok)").select("g", "m", "n", "k", "on", "ok"), "prefixes")
    shown = heads.where("m > 2").select("g", "n", "k", "m")
    ties = shown.groupBy("n", "k").agg(F.sum(F.col("m") - 1).alias("ties"))
    ranked = shown.join(ties, ["n", "k"])
    pivots = ranked.groupBy("g").agg(F.max(F.struct("ties", "k", "n")).alias("p"))
    lone = heads.where(F.col("m") == 2).where(_long_enough("n", "on", percent)).select(
        _pair("n", "k", "on", "ok").alias("e"), F.struct(F.lit(1).cast("long").alias("ties"), F.col("ok").alias("k"), F.col("on").alias("n")).alias("p"))
    stars = (ranked.select("g", "n", "k").join(pivots, "g").where("n <> p.n OR k <> p.k")
             .withColumns({"pn": F.col("p.n"), "pk": F.col("p.k")}).where(_long_enough("n", "pn", percent))
             .select(_pair("n", "k", "pn", "pk").alias("e"), "p").union(lone)
             .groupBy("e.an", "e.ak", "e.bn", "e.bk").agg(F.count("*").alias("o"), F.max("p").alias("p"))
             .where(F.col("o") * STAR_SHARE >= _need_shared(percent)).drop("o"))
    stars = stash(stars, "stars")
    star_sets = _sets_of(src, sign, _ends(stars), weight)
    met = stash(_overlaps(star_sets, stars), "overlaps")
    links = _links(met, percent)
    found = components(_edges(links))
    homes = _homes(stars, met)
    rest = _open(shown.join(found, "k", "left").select("g", "n", "k", F.coalesce("c", "k").alias("c")))
    able = stash(rest.select("n", "k").distinct().join(homes, ["n", "k"], "left"), "homes")
    seg = _sets_of(src, sign, able.select("n", "k"), weight)
    # shingles that a class has in common with any other open class, and those of them that its
    # pivot lacks: bounds of every overlap
    pivot_sets = star_sets.select(F.col("n").alias("pn"), F.col("k").alias("pk"), "f", F.col("s").alias("ps"))
    pivot_sets = pivot_sets.join(able.select("pn", "pk").distinct(), ["pn", "pk"]).dropDuplicates(["pn", "pk", "f"])
    beside = seg.join(able, ["n", "k"]).join(pivot_sets, ["pn", "pk", "f"], "left").withColumn(
        "ps", F.coalesce("ps", F.array().cast("array<long>")))
    grams = beside.select("n", "k", F.explode(F.concat(
        F.transform(F.array_intersect("s", "ps"), lambda g: F.struct(g.alias("g"), F.lit(0).alias("new"))),
        F.transform(F.array_except("s", "ps"), lambda g: F.struct(g.alias("g"), F.lit(1).alias("new"))))).alias("x"))
    grams = grams.select("n", "k", "x.g", "x.new").repartition("g")
    common = grams.join(grams.groupBy("g").agg(F.count("*").alias("m")).where("m > 1"), "g").groupBy("n", "k").agg(
        F.count("*").alias("common"), F.sum("new").alias("new"))
    rest = rest.join(common, ["n", "k"]).where(F.col("common") * 100 >= F.col("n") * percent)
    parities = seg.where("z IS NOT NULL").dropDuplicates(["n", "k"]).select(
        "n", "k", *[F.col("z")[i].alias(f"z{i}") for i in range(PARITY_WORDS)])
    rest = stash(rest.join(able, ["n", "k"]).join(parities, ["n", "k"]), "able")

    def side(x: str) -> DataFrame:
        names = {"n": "n", "k": "k", "c": "c", "common": "m", "new": "u", "pn": "pn", "pk": "pk", "po": "po"}
        names |= {f"z{i}": f"z{i}" for i in range(PARITY_WORDS)}
        return rest.select("g", *[F.col(c).alias(x + t) for c, t in names.items()])

    one_pivot = F.coalesce((F.col("apn") == F.col("bpn")) & (F.col("apk") == F.col("bpk")), F.lit(False))
    by_pivot = F.least("apo", "bpo") + F.least("au", "bu")
    differ = sum(F.bit_count(F.col(f"az{i}").bitwiseXOR(F.col(f"bz{i}"))) for i in range(PARITY_WORDS))
    cross = (side("a").join(side("b"), "g").where("ac <> bc AND (an < bn OR (an = bn AND ak < bk))")
             .where(_long_enough("an", "bn", percent) & (F.least("am", "bm") >= _need(percent)))
             .where(~(one_pivot & (by_pivot < _need(percent))))
             .where(differ <= F.col("an") + F.col("bn") - 2 * _need(percent))
             .groupBy("an", "ak", "bn", "bk").agg(F.count("*").alias("o")).where(_most(F.col("o"), _need_shared(percent))).drop("o")
             .join(stars, ["an", "ak", "bn", "bk"], "left_anti"))  # the stars have been checked
    more = _links(_overlaps(seg, stash(cross, "cross")), percent)
    every = components(_edges(links.union(more)))
    named = stash(sign.join(every, "k", "left").select("id", "x", "n", F.coalesce("c", "k").alias("c")), "named")
    low = stash(named.where("n > 0").groupBy("c").agg(F.min("id").alias("low")), "lowest")
    out = named.join(low, "c", "left").select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("id")).alias("component_id"),
        F.col("x").alias("row_key"), F.col("c").alias("class_key"))
    return out if keys else out.drop("row_key", "class_key")


def _pair(n: str, k: str, m: str, j: str):
    """The two classes in a fixed order."""
    def row(an: str, ak: str, bn: str, bk: str):
        return F.struct(F.col(an).alias("an"), F.col(ak).alias("ak"), F.col(bn).alias("bn"), F.col(bk).alias("bk"))

    return F.when((F.col(n) < F.col(m)) | ((F.col(n) == F.col(m)) & (F.col(k) < F.col(j))), row(n, k, m, j)).otherwise(
        row(m, j, n, k))


#: A star pair is checked early if its pivot is met in 1 / STAR_SHARE of the shingles that a linked
#: pair shares at least (several pivots divide them); what is left out here is met in step 3.
STAR_SHARE = 4
