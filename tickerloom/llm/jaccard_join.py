"""N-gram Jaccard join by universe-partition pigeonhole (operator 7).

Every document becomes the set of its word shingles.  Equal sets are one class,
and only classes are compared.  The universe of shingles is cut into segments,
more of them the larger a set (see ``shingles.Bands``); a class is filed under
the key of each of its segments, or of their one-deletion neighbours, in its
size band and the next one a link can reach.  Two linked classes share a key.

Classes under one key make a bucket.  Large buckets hold segments that are
common by chance; a class whose common segments are within its band's spare is
left out of them, since any link of it has an equal segment elsewhere.

Links are found in two rounds, so that a bucket is never expanded into pairs.
First every class is checked against one leader of its bucket, and linked
classes are joined into components.  Then, in buckets that hold several
components, sketches that bound the difference from below tell which classes may
be linked to a class of another component; the sets of these alone are sent to
the bucket and checked there.  A link joins two components at once, so a bucket
passes on fewer links than it has members, and a pair that meets in several
buckets is checked in one.  All checks are exact, on whole sets (of 64-bit hashes
of shingles); blocks are cut by the bytes of their sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickerloom.llm import shingles
from tickerloom.llm.common import column, fresh, give_back, saved

#: Buckets of more classes are searched only by classes that cannot do without.
COMMON = 32
#: Keys gathered by a task before equal ones are combined.
COMBINED = 500_000
#: Classes compared with classes at a time, within one bucket, and the hashes that their sets may have together.
BLOCK = 2048
BLOCK_HASHES = 1 << 20
#: Buckets that a class names, to tell in which of them a pair is checked.
NAMED = 64
#: Bytes of sets that leave Python together.
BYTES_AT_ONCE = 4 << 20
#: Documents whose ids and text hashes are broadcast to fetch their texts; more are joined by shuffling.
BROADCAST_ROWS = 500_000


def _classes(text: Column, words: int) -> Column:
    """Size, class and sketch of a text's shingle set; class and sketch null if it is empty."""

    @F.arrow_udf("struct<n:bigint,cls:bigint,sketch:binary>")
    def found(texts: pa.Array) -> pa.Array:
        sizes, classes, sketches = [], [], []
        for text in texts:
            one = shingles.shingle_set(text.as_py(), words)
            sizes.append(len(one))
            classes.append(shingles.class_of(one) if len(one) else None)
            sketches.append(shingles.sketch(one) if len(one) else None)
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()), pa.array(sketches, pa.binary())],
            names=["n", "cls", "sketch"],
        )

    return found(text)


def _sets(texts: DataFrame, words: int) -> DataFrame:
    """``cls`` and the shingle set ``s``, as bytes, for rows of ``cls`` and ``text``."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes: list[int] = []
        sets: list[bytes] = []
        size = 0

        def lot() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(classes, pa.int64()), pa.array(sets, pa.binary())], names=["cls", "s"])

        for batch in batches:
            for cls, text in zip(batch.column(0), batch.column(1)):
                classes.append(cls.as_py())
                sets.append(shingles.shingle_set(text.as_py(), words).tobytes())
                size += len(sets[-1])
                if size >= BYTES_AT_ONCE:
                    yield lot()
                    classes, sets, size = [], [], 0
        if classes:
            yield lot()

    return texts.select("cls", "text").mapInArrow(made, "cls bigint, s binary")


def _combined(keys: np.ndarray, classes: np.ndarray) -> pa.RecordBatch:
    """One row per key for the shuffle, with its least class, and one per further class under a key of its own."""
    order = np.argsort(keys, kind="stable")
    keys, classes = keys[order], classes[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    least = np.minimum.reduceat(classes, first)
    leader = np.repeat(least, np.diff(np.concatenate([first, [len(keys)]])))
    more = classes != leader
    own, member, head = keys[more], classes[more], leader[more]
    order = np.lexsort((member, own))
    own, member, head = own[order], member[order], head[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (member[1:] != member[:-1])
    own, member, head = own[new], member[new], head[new]
    apart = shingles.mixed(own.view(np.uint64) ^ shingles.mixed(member.view(np.uint64))).view(np.int64)
    none = pa.nulls(len(first), pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([pa.array(keys[first]), pa.array(apart)]),
            pa.concat_arrays([pa.array(least), pa.array(head)]),
            pa.concat_arrays([none, pa.array(member)]),
            pa.concat_arrays([none, pa.array(own)]),
        ],
        names=["key", "cls", "member", "sig"],
    )


def _filed(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Index rows: key and class, or for classes met under a key of the same task, ``member`` and ``sig`` as well."""

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = shingles.Bands(percent)
        table = bands.table()
        keys: list[np.ndarray] = []
        owners: list[tuple[int, int]] = []
        seen: set[int] = set()
        size = 0

        def flush() -> pa.RecordBatch:
            owner = np.repeat(
                np.array([c for c, _ in owners], np.int64), np.array([n for _, n in owners], np.int64)
            )
            return _combined(np.concatenate(keys), owner)

        for batch in batches:
            for text in batch.column(0):
                one = shingles.shingle_set(text.as_py(), words)
                if not len(one) or (cls := shingles.class_of(one)) in seen:
                    continue
                made = shingles.signatures(one, bands.of(len(one), table))
                if not len(made):
                    continue
                seen.add(cls)
                keys.append(made)
                owners.append((cls, len(made)))
                size += len(made)
                if size >= COMBINED:
                    yield flush()
                    keys, owners, seen, size = [], [], set(), 0
        if size:
            yield flush()
        give_back()

    return texts.mapInArrow(file, "key bigint, cls bigint, member bigint, sig bigint")


def _buckets(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """``sig`` and ``cls`` of every bucket of several classes, with its size ``cnt`` and ``leader``."""
    rows = _filed(texts, words, percent)
    same = Window.partitionBy("key")
    met = rows.withColumn("heads", F.count(F.lit(1)).over(same)).filter(
        (F.col("heads") > 1) | F.col("member").isNotNull()
    )
    members = F.when(F.col("member").isNull(), F.array(F.struct(F.col("key").alias("sig"), F.col("cls").alias("cls"))))
    members = members.otherwise(
        F.array(
            F.struct(F.col("sig").alias("sig"), F.col("cls").alias("cls")),
            F.struct(F.col("sig").alias("sig"), F.col("member").alias("cls")),
        )
    )
    listed = saved(met.select(F.inline(members)).distinct(), "bucket_members")
    # Combined within tasks first: a bucket may hold any share of the classes.
    sizes = listed.groupBy("sig").agg(F.count(F.lit(1)).alias("cnt"), F.min("cls").alias("leader")).filter("cnt > 1")
    return listed.join(saved(sizes, "bucket_sizes"), "sig")


def _needed(buckets: DataFrame, kinds: DataFrame, percent: int) -> DataFrame:
    """``buckets`` without the classes that can do without the common ones."""
    bands = shingles.Bands(percent)
    table = buckets.sparkSession.createDataFrame(
        [(b.number, b.high, 0 if b.deletions else b.segments) for b in bands.table()],
        "band int, high long, segments int",
    )  # one row per size band
    common = (
        buckets.filter(F.col("cnt") > COMMON)
        .withColumn("band", F.col("sig").bitwiseAND(F.lit((1 << shingles.BAND_BITS) - 1)).cast("int"))
        .groupBy("cls", "band")
        .agg(F.count(F.lit(1)).alias("hot"))
    )
    largest = F.least(F.col("high"), F.floor(100 * F.col("n") / percent))
    spare = F.when(
        F.col("segments") > 0,
        F.col("segments") - F.floor((F.col("n") + largest) * (100 - percent) / (100 + percent)) - 1,
    ).otherwise(0)
    bound = (
        common.join(F.broadcast(table), "band")
        .join(kinds.select("cls", "n"), "cls")
        .filter(F.col("hot") > spare)
        .select("cls", "band")
    )
    rare = buckets.filter(F.col("cnt") <= COMMON)
    rest = buckets.filter(F.col("cnt") > COMMON).withColumn(
        "band", F.col("sig").bitwiseAND(F.lit((1 << shingles.BAND_BITS) - 1)).cast("int")
    )
    rest = rest.join(bound, ["cls", "band"], "left_semi").drop("band")
    led = rest.groupBy("sig").agg(F.min("cls").alias("leader"))
    rest = rest.drop("leader").join(led, "sig").select(*buckets.columns)
    return rare.unionAll(rest)


def _near(pairs: DataFrame, kinds: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` that sizes and sketches do not rule out; ``kinds`` has ``cls``, ``n``, ``sketch``."""
    share = (100 - percent, 100 + percent)

    @F.arrow_udf("boolean")
    def check(na: pa.Array, nb: pa.Array, left: pa.Array, right: pa.Array) -> pa.Array:
        if not len(left):
            return pa.array([], pa.bool_())
        total = na.to_numpy(zero_copy_only=False) + nb.to_numpy(zero_copy_only=False)
        one, two = (np.frombuffer(b"".join(x.to_pylist()), np.uint8).astype(np.int16) for x in (left, right))
        apart = np.abs(one - two).reshape(-1, shingles.SKETCH).sum(axis=1, dtype=np.int64)
        return pa.array(apart * share[1] <= total * share[0])

    one = kinds.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    two = kinds.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    size = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    met = pairs.join(one, "a").join(two, "b").filter(size)
    return met.filter(check(F.col("na"), F.col("nb"), F.col("sa"), F.col("sb"))).select("a", "b", F.col("nb").alias("n"))


def _with_sets(rows: DataFrame, docs: DataFrame, heads: DataFrame, words: int) -> DataFrame:
    """``rows``, which have ``cls``, with the shingle set ``s`` of their class.

    One document stands for its class.  So many narrow rows are broadcast if
    their count allows; else the texts are shuffled to them.
    """
    standing = saved(
        heads.join(rows.select("cls").distinct(), "cls", "left_semi").select(
            F.col("head.doc_id").alias("id"), F.col("head.key").alias("key"), "cls"
        ),
        "standing",
    )
    count = standing.count()
    same = docs["doc_id"].eqNullSafe(standing["id"]) & (F.xxhash64(docs["text"]) == standing["key"])
    texts = docs.join(F.broadcast(standing) if count <= BROADCAST_ROWS else standing, same)
    sets = saved(_sets(texts, words), "sets")
    if sets.count() > count:
        sets = saved(sets.dropDuplicates(["cls"]), "sets")  # a row that is repeated stands several times
    return rows.join(sets, "cls")


def _led(pairs: DataFrame, docs: DataFrame, heads: DataFrame, words: int, percent: int) -> DataFrame:
    """Of the pairs ``a`` (a leader), ``b`` with size ``n`` those whose sets are linked."""
    pairs = saved(pairs, "led_pairs")
    # A leader's members are dealt over blocks by the size of their sets; its own set goes to each block once.
    parts = saved(
        pairs.groupBy("a").agg(F.ceil(F.sum("n") / BLOCK_HASHES).cast("int").alias("parts")), "led_parts"
    )
    dealt = pairs.join(parts, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
    members = dealt.select("a", "part", F.col("b").alias("cls"), F.lit(1).alias("turn"))
    leaders = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("a").alias("cls"))
    rows = saved(members.unionAll(leaders.withColumn("turn", F.lit(0))), "led_rows")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, lead = None, None
        for batch in batches:
            found: list[int] = []
            by: list[int] = []
            for a, cls, turn, held in zip(*(batch.column(c) for c in ("a", "cls", "turn", "s"))):
                one = np.frombuffer(held.as_buffer(), np.uint64)
                if not turn.as_py():
                    leader, lead = a.as_py(), one.copy()
                elif leader == a.as_py() and shingles.linked(lead, one, percent):
                    found.append(cls.as_py())
                    by.append(leader)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(by, pa.int64()), pa.array(found, pa.int64())], names=["a", "b"])

    whole = _with_sets(rows, docs, heads, words).select("a", "part", "turn", "cls", "s")
    return (
        whole.repartition("a", "part").sortWithinPartitions("a", "part", "turn").mapInArrow(check, "a bigint, b bigint")
    )


class _Block:
    """Classes that meet in one block, and which pairs of them are open."""

    def __init__(self, table: pa.Table, percent: int):
        self.sig = table.column("sig")[0].as_py()
        self.cls, self.comp, self.n = (table.column(c).to_numpy() for c in ("cls", "comp", "n"))
        self.own_part, self.other = (table.column(c).to_numpy() for c in ("part", "other"))
        raw = b"".join(x.as_py() for x in table.column("sketch"))
        self.fine = np.frombuffer(raw, np.uint8).astype(np.int32).reshape(-1, shingles.SKETCH)
        self.coarse = self.fine.reshape(len(self.fine), -1, shingles.COARSE).sum(axis=2)
        self.lead = table.column("leader").to_numpy()
        self.named = [x.as_py() for x in table.column("named")]
        self.percent = percent

    def open(self, i: int, rest: np.ndarray) -> np.ndarray:
        """The classes among ``rest`` that may be linked to the i-th, and don't meet it in a bucket before this one."""
        share = (100 - self.percent, 100 + self.percent)
        n = self.n
        # Two blocks of a bucket hold a pair of one part twice: it counts where the part meets itself.
        at = rest[(self.own_part[rest] != self.own_part[i]) | (self.own_part[i] == self.other[i])]
        at = at[(self.cls[i] != self.lead[i]) & (self.cls[at] != self.lead[at])]
        at = at[100 * np.minimum(n[at], n[i]) >= self.percent * np.maximum(n[at], n[i])]
        for sketches in (self.coarse, self.fine):
            if len(at):
                apart = np.abs(sketches[at] - sketches[i]).sum(axis=1)
                at = at[apart * share[1] <= (n[at] + n[i]) * share[0]]
        earlier = {sig for sig in self.named[i] if sig < self.sig}
        return np.array([j for j in at.tolist() if earlier.isdisjoint(self.named[j])], np.int64) if earlier else at


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one block at a time, of rows sorted by ``block``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        blocks = batch.column("block").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
        if held and held[-1].column("block")[0].as_py() != blocks[0]:
            yield pa.Table.from_batches(held)
            held = []
        for lo, hi in zip(edges, edges[1:]):
            held.append(batch.slice(lo, hi - lo))
            if hi < len(blocks):
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def _open(rows: DataFrame, percent: int) -> DataFrame:
    """The rows of blocks whose class may be linked to one of another component, once each."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_block(batches):
            block = _Block(table, percent)
            marked = np.zeros(len(block.cls), bool)
            for i in range(len(block.cls) - 1):
                rest = np.arange(i + 1, len(block.cls))
                found = block.open(i, rest[block.comp[rest] != block.comp[i]])
                if len(found):
                    marked[i] = True
                    marked[found] = True
            if marked.any():
                yield from table.filter(pa.array(marked)).combine_chunks().to_batches()

    return rows.repartition("block").sortWithinPartitions("block").mapInArrow(scan, rows.schema)


def _joined(rows: DataFrame, percent: int) -> DataFrame:
    """Links ``a``, ``b`` that join all linked components of a block; ``rows`` have the set ``s`` as well."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_block(batches):
            block = _Block(table, percent)
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("s")]
            comp = block.comp.copy()
            links: list[tuple[int, int]] = []
            for i in range(len(sets) - 1):
                rest = np.arange(i + 1, len(sets))
                for j in block.open(i, rest[comp[rest] != comp[i]]).tolist():
                    if comp[i] != comp[j] and shingles.linked(sets[i], sets[j], percent):
                        links.append((int(block.cls[i]), int(block.cls[j])))
                        comp[comp == comp[j]] = comp[i]
            if links:
                a, b = np.array(links, np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return rows.repartition("block").sortWithinPartitions("block").mapInArrow(scan, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``comp``, the least node it is connected to, for edges ``a``, ``b``.

    Large-star and small-star steps in turn until the edges point at the least
    nodes; every step is written to the shared folder, so the lineage stays short.
    """
    edges = saved(edges.filter("a <> b").distinct(), "edges")
    state = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        ends = F.array(*(F.struct(F.col(end).alias("a"), F.col("m").alias("b")) for end in ("a", "b")))
        small = large.join(low, "a").select(F.inline(ends))
        edges = saved(small.filter("a <> b").distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    return nodes.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())


def linked_classes(docs: DataFrame, kinds: DataFrame, words: int, percent: int) -> DataFrame:
    """``node`` and ``comp`` for every class that has a link.

    ``docs`` has ``doc_id``, ``text``; ``kinds`` has per class ``cls``, ``n``,
    ``sketch`` and ``head``, a document's ``doc_id`` and ``key``.
    """
    sketched, heads = kinds.select("cls", "n", "sketch"), kinds.select("cls", "head")
    buckets = saved(_buckets(docs.select("text"), words, percent), "buckets")
    found = saved(_needed(buckets, sketched, percent), "needed")
    first = found.filter("cls <> leader").select(F.col("leader").alias("a"), F.col("cls").alias("b")).distinct()
    links = saved(_led(_near(first, sketched, percent), docs, heads, words, percent), "links")
    comps = saved(components(links), "components")
    placed = (
        found.join(comps, found["cls"] == comps["node"], "left")
        .select("sig", "cls", "leader", F.coalesce("comp", "cls").alias("comp"))
    )
    mixed_ = (
        placed.groupBy("sig")
        .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("members"))
        .filter("lo <> hi AND members > 2")
    )
    held = saved(placed.join(mixed_.select("sig", "members"), "sig").join(sketched, "cls"), "mixed_buckets")
    # A bucket of many classes, or of large ones, is compared block by block.
    cuts = held.groupBy("sig").agg(
        F.ceil(F.greatest(F.max("members") / BLOCK, F.sum("n") / BLOCK_HASHES)).cast("int").alias("cuts")
    )
    named = held.groupBy("cls").agg(F.slice(F.sort_array(F.collect_list("sig")), 1, NAMED).alias("named"))
    part = F.pmod(F.xxhash64("cls"), F.col("cuts")).cast("int")
    rows = (
        held.join(saved(cuts, "bucket_cuts"), "sig")
        .join(saved(named, "named_buckets"), "cls")
        .withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
        .withColumn("block", F.xxhash64("sig", F.least("part", "other"), F.greatest("part", "other")))
        .select("block", "sig", "cls", "comp", "n", "leader", "part", "other", "sketch", "named")
    )
    open_ = saved(_open(rows, percent), "open_classes")
    more = _joined(_with_sets(open_, docs, heads, words), percent)
    return components(links.unionAll(more))


def _classed(docs: DataFrame, text: str, id: str, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The rows and their classes.

    Rows have ``doc_id``, ``key`` (hash of the text), ``n`` and ``cls``, null
    without words.  Classes have ``cls``, ``root``, which tells its component, and
    ``head``: the least id of the component, its key, and how often they occur.
    """
    read = docs.select(column(docs, id).alias("doc_id"), column(docs, text).alias("text"))
    rows = saved(
        read.select("doc_id", F.xxhash64("text").alias("key"), _classes(F.col("text"), words).alias("c")).select(
            "doc_id", "key", "c.n", "c.cls", "c.sketch"
        ),
        "classes",
    )
    texts = rows.groupBy("cls", "doc_id", "key").agg(
        F.count(F.lit(1)).alias("rows"), F.first("n").alias("n"), F.first("sketch").alias("sketch")
    )
    head = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "rows")
    kinds = saved(
        texts.filter(F.col("cls").isNotNull())
        .groupBy("cls")
        .agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min(head).alias("head")),
        "kinds",
    )
    comps = saved(linked_classes(read, kinds, words, percent), "linked_classes")
    linked = comps.join(kinds.select(F.col("cls").alias("node"), "head"), "node")
    low = saved(linked.groupBy("comp").agg(F.min("head").alias("low")), "linked_heads")
    linked = saved(comps.join(low, "comp"), "linked_classes")
    labels = kinds.join(linked, kinds["cls"] == linked["node"], "left").select(
        "cls", F.coalesce("comp", "cls").alias("root"), F.coalesce("low", "head").alias("head")
    )
    return rows.drop("sketch"), saved(labels, "class_labels")


def jaccard_components(
    docs: DataFrame, *, text: str = "text", id: str = "doc_id", words: int = 5, percent: int = 80
) -> DataFrame:
    """Per row ``doc_id``, ``n_shingles``, ``component_id`` and ``key``, a hash of its text.

    ``component_id`` is the least id reachable by links, the row's own included.
    Texts without words, null ones too, have no shingles and no links.  Repeated
    rows are linked; a null id counts only where a component has no other.  Other
    columns are left out; an empty table gives an empty one.
    """
    rows, labels = _classed(docs, text, id, words, percent)
    # A class of very many copies is a hot key here; its label is one row, so adaptive execution can split it.
    joined = rows.join(labels.withColumnRenamed("cls", "c"), F.col("cls") == F.col("c"), "left")
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("component_id"),
        "key",
    )


def one_per_component(
    docs: DataFrame, *, text: str = "text", id: str = "doc_id", words: int = 5, percent: int = 80
) -> DataFrame:
    """The rows, all columns as they are, without all but one of each component.

    The row with the least id stays, of equal ids the one with the least hash of
    its text, of rows equal in both the first by all columns written as JSON; a
    null id only where a component has no other.  Components are told apart by
    their root: several may have the same least id, or null ids alone.  Rows
    without words all stay; an empty table gives an empty one.
    """
    _, labels = _classed(docs, text, id, words, percent)
    heads = saved(labels.groupBy("root").agg(F.first("head").alias("head")).select("head.doc_id", "head.key", "head.rows"), "component_heads")
    names = [fresh(docs.columns, name) for name in ("_head_id", "_head_key", "_head_rows", "_head_turn")]
    side = heads.toDF(*names[:3])
    hashed = F.xxhash64(column(docs, text))
    kept = docs.join(side, column(docs, id).eqNullSafe(side[names[0]]) & (hashed == side[names[1]]))
    if heads.filter("rows > 1").limit(1).count():
        whole = F.to_json(F.struct(*(column(kept, name) for name in docs.columns)))
        once = kept.filter(F.col(names[2]) == 1)
        turn = F.row_number().over(Window.partitionBy(names[0], names[1]).orderBy(whole))
        several = kept.filter(F.col(names[2]) > 1).withColumn(names[3], turn).filter(F.col(names[3]) == 1)
        kept = once.unionAll(several.drop(names[3]))
    wordless = docs.filter(~F.coalesce(column(docs, text), F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
    return kept.select(*(column(kept, name) for name in docs.columns)).unionAll(wordless)
