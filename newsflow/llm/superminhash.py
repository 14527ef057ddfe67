"""Operator 3: near-duplicates by SuperMinHash, banding, verification, union-find.

A document's set is its distinct word shingles.  SuperMinHash gives every
element one random permutation of the signature's slots and visits the slots in
that order with growing ranks; a document stops as soon as no later rank can
lower a slot.  Equal bands propose candidates, which are confirmed on the full
sets; confirmed links are joined into components.

Every step is a Spark job whose tables are staged in the shared folder:

1. one pass over the texts: set size, 128-bit set digest, band hashes;
2. equal sets become one class (a hot group of copies is a partial aggregate);
3. each band value links its members to one hub, so a bucket of g classes gives
   g - 1 candidates, not g * g;
4. candidates fetch their texts by two joins (adaptive skew splitting applies)
   and are compared in full;
5. components of the links (:mod:`newsflow.llm.components`);
6. members of buckets that still span several components are joined by prefix
   filtering: with the members' common shingles ordered last, two linked sets
   share a shingle among the first fifth of each.  Shingles with few members
   give their pairs, within the sizes and places that allow a link; members of
   a crowded shingle form families, dealt into blocks by set size, and every two
   blocks whose sizes allow a link are compared in one bounded task that returns
   one link per two components.  Texts that only share boilerplate have no
   common shingle in front, so they are neither paired nor dealt.

So no link between candidates is lost, although copies are never expanded.  A
pair at the threshold is a candidate with probability 1 - (1 - t^rows)^bands
(1.6e-5 missed at t = 0.8 with 60 bands of 8 rows; less above).

Defined cases: null, empty and blank texts have the empty set: ``n_shingles`` 0,
linked with nothing, ``component_id`` their own id.  A text with fewer words
than ``words`` has one shingle, its whole sequence.  Repeated rows are copies of
each other and each returned; a null id counts as larger than any other, and
its text links like any other.  Ties go to the smallest id.  Further columns of ``docs`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import WordHashes, arrow_map, mix64, stage, texts
from newsflow.llm.components import components
from newsflow.operators.skew import hot_keys, lookup

BANDS, BAND_ROWS = 60, 8
#: Elements whose permutations are held at a time.
CHUNK = 40_000
#: Most sets and shingles in a block of a family, on average; shingles counted at a time.
BLOCK_ROWS, BLOCK_TOKENS, SLICE = 512, 1 << 20, 8192
#: Members of a shingle that are paired directly; common shingles whose order is known (others count as rare).
CROWD, ORDERED = 16, 1 << 16
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str, words: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes; A-Z lower-cased, words split at ASCII white space."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    h = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    if not len(h):
        return h
    k = min(words, len(h))
    out = np.full(len(h) - k + 1, np.uint64(k))
    for i in range(k):
        out = mix64(out * GOLDEN + h[i:len(h) - k + 1 + i])
    return np.unique(out)


def signatures(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """SuperMinHash of non-empty sets: one row of ``slots`` ranks per set.

    A rank is level * 2^32 + a 32-bit draw.  All sets advance level by level;
    a set leaves once its largest rank is below the next level.
    """
    out = np.full((len(sets), slots), np.iinfo(np.uint64).max, np.uint64)
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    at = 0
    while at < len(order):
        end, total = at, 0
        while end < len(order) and (end == at or total + len(sets[order[end]]) <= CHUNK):
            total += len(sets[order[end]])
            end += 1
        _advance(sets, order[at:end], out, slots)
        at = end
    return out


def _advance(sets: list[np.ndarray], which: list[int], out: np.ndarray, slots: int) -> None:
    e = np.concatenate([sets[i] for i in which])
    owner = np.repeat(np.arange(len(which)), [len(sets[i]) for i in which])
    rank = np.full((len(which), slots), np.iinfo(np.uint64).max, np.uint64)
    flat = rank.ravel()
    perm = None
    for level in range(slots):
        draw = mix64(e + np.uint64((level + 1) * int(GOLDEN) & (1 << 64) - 1))
        pick = level + ((draw >> np.uint64(32)) * np.uint64(slots - level) >> np.uint64(32)).astype(np.int64)
        if perm is None:
            slot = pick
        else:
            rows = np.arange(len(e))
            slot = perm[rows, pick].astype(np.int64)
            perm[rows, pick] = perm[:, level]
        value = (np.uint64(level) << np.uint64(32)) | (draw & np.uint64(0xFFFFFFFF))
        np.minimum.at(flat, owner * slots + slot, value)
        open_ = (rank.max(1) >> np.uint64(32)) > np.uint64(level)
        if not open_.any():
            break
        keep = open_[owner]
        if perm is None:
            perm = np.tile(np.arange(slots, dtype=np.uint16), (int(keep.sum()), 1))
            rows = np.arange(len(perm))
            perm[rows, pick[keep]] = 0
        elif not keep.all():
            perm = perm[keep]
        e, owner = e[keep], owner[keep]
    out[which] = rank


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), bands)) * GOLDEN
    parts = sig.reshape(len(sig), bands, rows)
    for r in range(rows):
        h = mix64(h * GOLDEN + parts[:, :, r])
    return h.view(np.int64)


def _sketch(words: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            sets = [shingles(t, words, hashes) for t in texts(batch)]
            full = [i for i, s in enumerate(sets) if len(s)]
            found = band_hashes(signatures([sets[i] for i in full], bands * rows), bands, rows)
            by_row: list = [None] * len(sets)
            for i, h in zip(full, found):
                by_row[i] = h
            yield pa.RecordBatch.from_pydict({
                "row": pa.array(range(row, row + len(sets)), pa.int64()), "doc_id": batch.column("doc_id"), "key": batch.column("key"),
                "n_shingles": pa.array(map(len, sets), pa.int64()),
                "digest": pa.array([xxhash.xxh128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                "bands": pa.array(by_row, pa.list_(pa.int64()))})
            row += len(sets)
    return run


def _verify(words: int, percent: int):
    """Pairs with both texts -> the pairs whose full sets reach the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        hub, hub_set = None, np.zeros(0, np.uint64)
        for batch in batches:
            keep = []
            columns = [batch.column(c).to_pylist() for c in ("a", "b", "a_text", "b_text", "a_digest", "b_digest")]
            for i, (a, _, a_text, b_text, a_digest, b_digest) in enumerate(zip(*columns)):
                if a != hub:
                    hub, hub_set = a, shingles(a_text, words, hashes)
                other = shingles(b_text, words, hashes)
                if (xxhash.xxh128_digest(hub_set.tobytes()) != a_digest
                        or xxhash.xxh128_digest(other.tobytes()) != b_digest):
                    continue  # another text under the same id
                both = len(np.intersect1d(hub_set, other, assume_unique=True))
                if 100 * both >= percent * (len(hub_set) + len(other) - both):
                    keep.append(i)
            yield pa.RecordBatch.from_pydict({c: batch.column(c).take(pa.array(keep, pa.int64())) for c in ("a", "b")})
    return run


def _texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``nodes`` with the texts under their id and text hash, null ids included (a repeated text once)."""
    held = docs.select(F.col("doc_id").alias("held_id"), F.xxhash64("text").alias("held_key"), "text").where("text is not null")
    same = F.col("doc_id").eqNullSafe(F.col("held_id")) & (F.col("key") == F.col("held_key"))
    return nodes.join(held, same).drop("held_id", "held_key").dropDuplicates(["row", "text"])


def _listed_sets(words: int):
    """(row, root, n, set) of each node whose text is the one under its digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingles(t, words, hashes) for t in texts(batch)]
            own = [i for i, (s, d) in enumerate(zip(sets, batch.column("digest").to_pylist()))
                   if xxhash.xxh128_digest(s.tobytes()) == d]
            at = pa.array(own, pa.int64())
            yield pa.RecordBatch.from_pydict({
                **{c: batch.column(c).take(at) for c in ("row", "root")},
                "n": pa.array([len(sets[i]) for i in own], pa.int64()),
                "set": pa.array([sets[i].tobytes() for i in own], pa.binary())})
    return run


def _sets_of(batch: pa.RecordBatch, column: str = "set") -> list[np.ndarray]:
    return [np.frombuffer(b, np.uint64) for b in batch.column(column).to_pylist()]


def _shingle_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = _sets_of(batch)
        if sets:
            each, n = np.unique(np.concatenate(sets), return_counts=True)
            yield pa.RecordBatch.from_pydict({"shingle": pa.array(each.view(np.int64)), "sets": pa.array(n)})


def _fronts(percent: int, common: np.ndarray, counts: np.ndarray):
    """A set's first shingles, rare ones first: as many as a linked set may lack, and one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fronts = []
            for s in _sets_of(batch):
                at = np.minimum(np.searchsorted(common, s), len(common) - 1)
                often = np.where(common[at] == s, counts[at], 0)
                fronts.append(s[np.lexsort((s, often))][:len(s) - -(-percent * len(s) // 100) + 1])
            each = pa.array(np.repeat(np.arange(len(fronts)), [len(f) for f in fronts]))
            place = [np.arange(len(f)) for f in fronts]
            yield pa.RecordBatch.from_pydict({
                "shingle": pa.array(np.concatenate([np.zeros(0, np.uint64), *fronts]).view(np.int64)),
                **{c: batch.column(c).take(each) for c in ("row", "root", "n")},
                "place": pa.array(np.concatenate([np.zeros(0, np.int64), *place]))})
    return run


def _verify_sets(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (a, b) in enumerate(zip(_sets_of(batch, "a_set"), _sets_of(batch, "b_set"))):
                both = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * both >= percent * (len(a) + len(b) - both):
                    keep.append(i)
            yield pa.RecordBatch.from_pydict({c: batch.column(c).take(pa.array(keep, pa.int64())) for c in ("a", "b")})
    return run


def front_posts(sets: DataFrame, percent: int) -> DataFrame:
    """(shingle, row, root, n, place): the front of every set."""
    spark = sets.sparkSession
    often = (arrow_map(sets.select("set"), _shingle_counts, "shingle long, sets long").groupBy("shingle").agg(F.sum("sets").alias("sets"))
             .where("sets > 1").orderBy(F.desc("sets"), "shingle").limit(ORDERED).toArrow())
    shingle = np.append(often.column("shingle").to_numpy().view(np.uint64), np.uint64(0))
    count = np.append(often.column("sets").to_numpy(), 0)
    order = np.argsort(shingle, kind="stable")
    known = spark.sparkContext.broadcast((shingle[order], count[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _fronts(percent, *known.value)(batches)
    return stage(arrow_map(sets, run, "shingle long, row long, root long, n long, place long"), "near-fronts")


def shared_posts(posts: DataFrame, percent: int) -> DataFrame:
    """(shingle, row, root, n, place, members, hub): the postings of shingles that may link two components.

    They are joined with their shingle's count once, so there are never more of
    them than of ``posts``.  A shingle of two holders goes at once if their sizes
    or places rule a link out.
    """
    behind = F.col("n") - F.col("place")
    buckets = posts.groupBy("shingle").agg(
        F.count("*").alias("members"), F.min("row").alias("hub"), F.min("root").alias("lo"), F.max("root").alias("hi"),
        F.min("n").alias("small"), F.max("n").alias("large"), F.min(behind).alias("behind"))
    linkable = ((100 * F.col("small") >= percent * F.col("large"))
                & ((100 + percent) * F.col("behind") >= percent * (F.col("small") + F.col("large"))))
    buckets = stage(buckets.where((F.col("lo") != F.col("hi")) & ((F.col("members") > 2) | linkable))
                    .select("shingle", "members", "hub"), "near-buckets")
    return stage(posts.join(buckets, "shingle"), "near-shared")


def rest_links(docs: DataFrame, nodes: DataFrame, members: DataFrame, words: int, percent: int) -> DataFrame:
    """Links between components among ``members`` (row, root)."""
    held = _texts_of(docs, nodes.select("row", "doc_id", "key", "digest").join(members, "row"))
    sets = stage(arrow_map(held.select("row", "root", "digest", "text"), _listed_sets(words),
                           "row long, root long, n long, set binary"), "near-sets")
    shared = shared_posts(front_posts(sets, percent), percent)
    few = shared.where(F.col("members") <= CROWD)
    side = {s: few.select("shingle", *(F.col(c).alias(f"{s}_{c}") for c in ("row", "root", "n", "place"))) for s in "ab"}
    pairs = (side["a"].join(side["b"], "shingle")
             .where((F.col("a_row") < F.col("b_row")) & (F.col("a_root") != F.col("b_root"))
                    & (100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n"))
                    & ((100 + percent) * F.least(F.col("a_n") - F.col("a_place"), F.col("b_n") - F.col("b_place"))
                       >= percent * (F.col("a_n") + F.col("b_n"))))
             .select(F.col("a_row").alias("a"), F.col("b_row").alias("b")).distinct())
    fetch = {s: sets.select(F.col("row").alias(s), F.col("set").alias(f"{s}_set")) for s in "ab"}
    paired = stage(arrow_map(pairs.join(fetch["a"], "a").join(fetch["b"], "b"), _verify_sets(percent), "a long, b long"), "near-paired")

    crowd = shared.where((F.col("members") > CROWD) & (F.col("row") != F.col("hub")))
    family = components(crowd.select(F.col("hub").alias("a"), F.col("row").alias("b")))
    placed = sets.join(family.withColumnRenamed("root", "family"), "row")
    return paired.unionByName(family_links(placed, percent))


def _compare(percent: int):
    """Rows sorted by pair of blocks -> one link per two components that the pair shows."""
    keys = ("family", "lo_class", "lo_block", "hi_class", "hi_block")

    def links(rows: list[tuple]) -> list[tuple[int, int]]:
        both = [r for r in rows if r[3]], [r for r in rows if r[4]]
        if not both[0] or not both[1] or len({r[1] for r in rows}) < 2:
            return []
        sets = [[np.frombuffer(r[2], np.uint64) for r in side] for side in both]
        sizes = [np.array([len(x) for x in side]) for side in sets]
        flat = [np.concatenate(side) for side in sets]
        vocabulary = np.intersect1d(*flat)
        owner = [np.repeat(np.arange(len(n)), n) for n in sizes]
        column = [np.searchsorted(vocabulary, f) for f in flat]
        for k in (0, 1):
            column[k][column[k] == len(vocabulary)] = 0
            known = vocabulary[column[k]] == flat[k] if len(vocabulary) else np.zeros(len(flat[k]), bool)
            owner[k], column[k] = owner[k][known], column[k][known]
        shared = np.zeros((len(sets[0]), len(sets[1])), np.float32)
        for at in range(0, len(vocabulary), SLICE):
            held = []
            for k in (0, 1):
                inside = (column[k] >= at) & (column[k] < at + SLICE)
                m = np.zeros((len(sets[k]), min(SLICE, len(vocabulary) - at)), np.float32)
                m[owner[k][inside], column[k][inside] - at] = 1
                held.append(m)
            shared += held[0] @ held[1].T
        both_n = shared.astype(np.int64)
        union = sizes[0][:, None] + sizes[1][None] - both_n
        row, root = ([np.array([r[f] for r in side]) for side in both] for f in (0, 1))
        i, j = np.nonzero((100 * both_n >= percent * union) & (root[0][:, None] != root[1][None]))
        ends = np.stack([np.minimum(root[0][i], root[1][j]), np.maximum(root[0][i], root[1][j])], 1)
        first = np.unique(ends, axis=0, return_index=True)[1]
        return [(int(row[0][i[f]]), int(row[1][j[f]])) for f in first]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"a": pa.array([f[0] for f in found], pa.int64()),
                                               "b": pa.array([f[1] for f in found], pa.int64())})
        now, rows = None, []
        for batch in batches:
            found = []
            values = zip(*(batch.column(c).to_pylist() for c in ("row", "root", "set", "in_lo", "in_hi")))
            for key, value in zip(zip(*(batch.column(c).to_pylist() for c in keys)), values):
                if key != now:
                    found += links(rows)
                    now, rows = key, []
                rows.append(value)
            yield out(found)
        yield out(links(rows))
    return run


def family_links(sets: DataFrame, percent: int) -> DataFrame:
    """Links between components among ``sets`` (row, root, family, n, set), compared within families."""
    # two sets can only be linked if their sizes are in the same or in neighbouring classes
    sets = sets.withColumn("class", F.floor(F.log(F.col("n")) / F.log(F.lit(100 / percent))).cast("int"))
    count = sets.groupBy("family", "class").agg(F.ceil(F.greatest(
        F.count("*") / BLOCK_ROWS, F.sum("n") / BLOCK_TOKENS)).cast("int").alias("blocks"))
    near = F.array(*(F.struct((F.col("class") + d).alias("class"), F.col("class").alias("partner"),
                              F.col("blocks").alias("partner_blocks")) for d in (-1, 0, 1)))
    partners = count.select("family", F.explode(near).alias("p")).select("family", "p.*")
    placed = (sets.join(count, ["family", "class"])
              .withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")).drop("blocks")
              .join(partners, ["family", "class"])
              .withColumn("partner_block", F.explode(F.sequence(F.lit(0), F.col("partner_blocks") - 1))))
    own, other = F.struct("class", "block"), F.struct(F.col("partner").alias("class"), F.col("partner_block").alias("block"))
    lo, hi = F.least(own, other), F.greatest(own, other)
    dealt = placed.select("family", lo["class"].alias("lo_class"), lo["block"].alias("lo_block"),
                          hi["class"].alias("hi_class"), hi["block"].alias("hi_block"), "row", "root", "set",
                          (own == lo).alias("in_lo"), (own == hi).alias("in_hi"))
    key = ["family", "lo_class", "lo_block", "hi_class", "hi_block"]
    dealt = dealt.repartition(*key).sortWithinPartitions(*key)
    return stage(arrow_map(dealt, _compare(percent), "a long, b long").distinct(), "near-family-links")


def verified_links(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose documents' full sets reach ``percent``.

    Texts are fetched only for nodes in a pair; sizes that rule a pair out are
    dropped first.
    """
    n = nodes.select("row", "doc_id", "key", "n_shingles", "digest")
    side = {s: n.select(F.col("row").alias(s), F.col("n_shingles").alias(f"{s}_n")) for s in "ab"}
    pairs = (pairs.join(side["a"], "a").join(side["b"], "b")
             .where((100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n"))).select("a", "b"))
    pairs = stage(pairs, "near-pairs")
    used = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
    text = stage(_texts_of(docs, n.join(used, "row")).select("row", "digest", "text"), "near-texts")
    fetch = {s: text.select(F.col("row").alias(s), F.col("digest").alias(f"{s}_digest"),
                            F.col("text").alias(f"{s}_text")) for s in "ab"}
    wide = pairs.join(fetch["b"], "b").join(fetch["a"], "a").sortWithinPartitions("a")
    return stage(arrow_map(wide, _verify(words, percent), "a long, b long").distinct(), "near-links")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, bands: int = BANDS,
                    rows: int = BAND_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept, class_id.

    Links are Jaccard similarities of at least ``percent`` / 100 on distinct
    ``words``-word shingles; ``class_id`` is the smallest id with an equal set,
    ``kept`` marks the smallest id of a component.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    sketch = stage(arrow_map(docs.withColumn("key", F.xxhash64("text")), _sketch(words, bands, rows),
                             "row long, doc_id long, key long, n_shingles long, digest binary, bands array<long>"), "near-sketch")
    classes = stage(sketch.where("digest is not null").groupBy("digest")
                    .agg(F.min("row").alias("row"), F.min("doc_id").alias("class_id")), "near-classes")
    nodes = sketch.join(classes.select("row"), "row", "left_semi")
    posts = nodes.select("row", F.explode("bands").alias("band"))
    hubs = (posts.groupBy("band").agg(F.min("row").alias("hub"), F.count("*").alias("members"))
            .where("members > 1").select("band", "hub"))
    posts = stage(posts.join(hubs, "band"), "near-posts")
    star = posts.where("row <> hub").select(F.col("hub").alias("a"), F.col("row").alias("b")).distinct()
    links = verified_links(docs, nodes, star, words, percent)
    roots = components(links)

    rooted = posts.join(roots, "row", "left").select("band", "hub", "row", F.coalesce("root", "row").alias("root"))
    mixed = (rooted.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
             .where("lo <> hi").select("band"))
    members = stage(rooted.join(mixed, "band").select("row", "root").distinct(), "near-mixed")
    more = stage(rest_links(docs, nodes, members, words, percent), "near-rest")
    if not more.isEmpty():
        roots = components(links.unionByName(more))

    label = stage(classes.join(roots, "row", "left").withColumn("root", F.coalesce("root", "row")), "near-rooted")
    smallest = label.groupBy("root").agg(F.min("class_id").alias("component_id"))
    label = lookup(label, smallest, "root", hot_keys(label, "root")).select("digest", "class_id", "component_id")
    own = sketch.select("doc_id", "n_shingles", "digest")
    own = lookup(own, label, "digest", hot_keys(own, "digest"))
    component = F.coalesce("component_id", "doc_id")
    return own.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
                      F.coalesce("class_id", "doc_id").alias("class_id"))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component (its smallest id); all columns kept.

    Rows without words stay, since they are linked with nothing, and so do rows
    with a null id; of rows with equal id and text one stays (the anti join
    has already dealt the rows by id, so this moves no text again).
    """
    gone = near_duplicates(docs, words, percent).where(~F.col("kept")).select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti").dropDuplicates(["doc_id", "text"])
    return left.select(*(F.col(f"`{c}`") for c in docs.columns))
