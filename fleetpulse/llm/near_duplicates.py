"""Near duplicates: one-permutation MinHash with optimal densification, banded buckets, stars, then all pairs of what is left."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.llm.common import mix, stored, text_blocks, word_hashes
from fleetpulse.llm.graph import components

#: Bins of the one permutation, a power of two.
BINS = 128
#: Bins in a band: with 32 bands of 4 a pair at 0.8 shares none once in ten million times.
ROWS = 4
#: A pair whose signatures agree by so many standard deviations too little is not compared further.
DEVIATIONS = 5
#: Bytes of text worked on at once.
BLOCK_BYTES = 1_000_000
#: Rounds in which a bucket has one hub; what they leave is compared pair by pair.
STAR_ROUNDS = 2
#: Members of a bucket, members of a family and bytes of their sets in a block; a task has two blocks.
BUCKET_BLOCK, FAMILY_BLOCK, FAMILY_BYTES = 512, 256, 8_000_000

_SALT = np.uint64(0x2545F4914F6CDD1D)
# Lowers A-Z and turns the separators from 09 to 0D into spaces.
_LOWER = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))


def shingle_sets(texts: list[bytes | None], size: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's ``size``-word shingles.

    Words are parted by space and the separators from 09 to 0D; A-Z are
    lowered. A text of fewer words is one shingle, one without words has none.
    """
    joined = b" " + b" ".join((t or b"").translate(_LOWER) for t in texts) + b" "
    codes = np.frombuffer(joined, np.uint8)
    first = 1 + np.concatenate(([0], np.cumsum([len(t or b"") + 1 for t in texts])))
    step = np.diff((codes == 32).astype(np.int8))
    starts, ends = np.flatnonzero(step == -1) + 1, np.flatnonzero(step == 1) + 1
    words = word_hashes(codes, starts, ends)
    bounds = np.searchsorted(starts, first)
    found = []
    shingles = _chained(words, size)
    for at, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        n = end - at
        if n >= size:
            found.append(np.unique(shingles[at : end - size + 1]))
        elif n:
            found.append(_chained(words[at:end], n))
        else:
            found.append(np.empty(0, np.uint64))
    return found


def _chained(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words."""
    n = max(0, len(words) - size + 1)
    chain = np.full(n, size, np.uint64)
    for j in range(size):
        chain = mix(chain * _SALT + words[j : j + n])
    return chain


def signature(shingles: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Smallest hash in each bin of one permutation, empty bins filled by optimal densification.

    The top bits of a hash name its bin. An empty bin takes the value of a bin
    drawn by a hash of the empty bin and the try, until a filled one is drawn:
    the draws are the same for all sets, and independent for each bin.
    """
    width = bins.bit_length() - 1
    bin_of = (shingles >> np.uint64(64 - width)).astype(np.int64)
    first = np.searchsorted(bin_of, np.arange(bins))
    filled = first < np.searchsorted(bin_of, np.arange(bins), side="right")
    values = np.zeros(bins, np.uint64)
    values[filled] = shingles[first[filled]]
    empty, attempt = np.flatnonzero(~filled), 0
    while len(empty):
        attempt += 1
        drawn = mix(empty.astype(np.uint64) * _SALT + np.uint64(attempt)) >> np.uint64(64 - width)
        drawn = drawn.astype(np.int64)
        got = filled[drawn]
        values[empty[got]] = values[drawn[got]]
        empty = empty[~got]
    return values


def bands(values: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One key for each band of ``rows`` bins; equal keys of different bands differ."""
    grouped = values.reshape(-1, rows)
    key = np.arange(len(grouped), dtype=np.uint64)
    for j in range(rows):
        key = mix(key * _SALT + grouped[:, j])
    return key


def _sketched(docs: DataFrame, size: int) -> DataFrame:
    """``id, n_shingles, digest, bands, signature``: a row per document.

    ``digest`` is equal for equal sets, ``signature`` keeps a byte of each bin.
    """
    schema = T.StructType(
        [
            T.StructField("id", docs.schema["id"].dataType),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("digest", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
            T.StructField("signature", T.BinaryType()),
        ]
    )

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for rows, texts in text_blocks(batches, "text", BLOCK_BYTES):
            counts, digests, keys, signatures = [], [], [], []
            for shingles in shingle_sets(texts, size):
                counts.append(len(shingles))
                if not len(shingles):
                    digests.append(None)
                    keys.append(None)
                    signatures.append(None)
                    continue
                digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                values = signature(shingles)
                keys.append(bands(values).view(np.int64))
                signatures.append(mix(values).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("id"),
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(signatures, pa.binary()),
                ],
                names=schema.names,
            )

    return docs.mapInArrow(sketch, schema)


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """``id, shingles``: the full set as packed sorted hashes."""
    schema = T.StructType([T.StructField("id", docs.schema["id"].dataType), T.StructField("shingles", T.BinaryType())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_blocks(batches, "text", BLOCK_BYTES):
            packed = pa.array([s.tobytes() for s in shingle_sets(texts, size)], pa.binary())
            yield pa.RecordBatch.from_arrays([rows.column("id"), packed], names=["id", "shingles"])

    return docs.mapInArrow(pack, schema)


def _linked(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets ``sa, sb`` reach the similarity."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            keep = []
            for x, y in zip(rows.column("sa"), rows.column("sb")):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(a) + len(b) - len(np.union1d(a, b))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield pa.RecordBatch.from_arrays(
                [rows.column("a"), rows.column("b")], names=["a", "b"]
            ).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "sa", "sb").mapInArrow(
        compare, T.StructType([pairs.schema["a"], pairs.schema["b"]])
    )


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document.

    Documents are linked if ``100 * common >= percent * union`` holds for their
    sets of ``size``-word shingles; ``component_id`` is the smallest ``doc_id``
    that links lead to, ``kept`` is whether that is the document itself. Takes
    ``doc_id`` and ``text``; other columns are ignored. A null or blank text has
    no shingles and no links. Rows with the same id are one document with each
    of their texts: linked by the id, a row each. Rows with a null id are
    returned with a null component and kept. An empty table gives no rows.

    Equal sets are one class and only its smallest id is compared. First every
    document is a candidate of one hub, the smallest id that shares a bucket with
    it; then of one member for each other component of its buckets, so a bucket
    of n yields n - 1 pairs at most. Links join the components they connect and
    are not needed any more. In buckets that then still hold several components,
    every pair of different components is compared: see ``_left_over``. Sets are
    made once, of the documents that share a bucket. Ids are integers.
    """
    named = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("binary").alias("text"))
    sketches = stored(_sketched(named, size), "sketches")
    known = sketches.where("id is not null and digest is not null")
    # Rows of one digest have equal sets, so any of them gives the sketch of the class.
    sketch = [F.first(c).alias(c) for c in ("n_shingles", "bands", "signature")]
    classes = stored(known.groupBy("digest").agg(F.min("id").alias("rep"), *sketch), "classes")
    members = sketches.select("id", "n_shingles", "digest").join(classes.select("digest", "rep"), "digest", "left")
    members = stored(members.drop("digest"), "members")
    reps = classes.select(F.col("rep").alias("id"), "n_shingles", "bands", "signature")

    entries = reps.select("id", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    entries = stored(entries.join(shared, "bucket"), "buckets")

    # Tables that grow with the input are merged by key whatever their size, never broadcast.
    wanted = entries.select("id").distinct().hint("merge")
    sets = _sets(named.join(wanted, "id", "left_semi"), size).where(F.length("shingles") > 0)
    sets = stored(sets, "sets")

    # An id with several texts links their classes.
    lowest = members.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("high")).where("a <> high")
    links = stored(members.join(lowest, "id").where("rep <> a").select("a", F.col("rep").alias("b")), "links")
    labels = components(links) if not links.isEmpty() else links.toDF("node", "component")
    for turn in range(STAR_ROUNDS):
        grouped = _grouped(entries, labels)
        # The hub of a bucket is one of its lowest component: the smallest id at first, later one drawn by a
        # hash for each bucket and round, which shows the rest many members of that component.
        # Component and draw are one number of fixed width, which a hash aggregate can hold.
        drawn = F.pmod(F.xxhash64("id", "bucket", F.lit(turn)), F.lit(10**18)) if turn else F.lit(0)
        order = F.col("component").cast("decimal(19,0)") * F.lit(Decimal(10**18)) + drawn.cast("decimal(18,0)")
        hub = F.min_by("id", order) if turn else F.min("id")
        hubs = (
            grouped.groupBy("bucket")
            .agg(hub.alias("hub"), F.min("component").alias("low"), F.max("component").alias("high"))
            .where("low <> high")
        )
        pairs = grouped.join(hubs, "bucket").where("component <> low")
        # One pair for each document, later for each component it might join.
        pairs = pairs.groupBy(*["id", "low"][: turn + 1]).agg(F.min("hub").alias("b"))
        found = _confirmed(pairs.select(F.col("id").alias("a"), "b"), reps, sets, percent)
        if not found.isEmpty():
            labels = _contracted(labels, found)
    found = _left_over(_grouped(entries, labels), reps, sets, percent)
    if not found.isEmpty():
        labels = _contracted(labels, found)
    return (
        members.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "id",
            "n_shingles",
            F.when(F.col("id").isNotNull(), F.coalesce("component", "rep", "id")).alias("component_id"),
        )
        .select(
            F.col("id").alias("doc_id"),
            "n_shingles",
            "component_id",
            F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
        )
    )


def _grouped(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets with their present ``component``; one without a label is its own."""
    known = labels.withColumnRenamed("node", "id")
    return entries.join(known, "id", "left").withColumn("component", F.coalesce("component", "id"))


def _contracted(labels: DataFrame, found: DataFrame) -> DataFrame:
    """``labels`` after links ``a, b``: these are drawn between the components they connect, once for each two."""
    between = found
    for side in ("a", "b"):
        known = labels.select(F.col("node").alias(side), F.col("component").alias("_" + side))
        between = between.join(known, side, "left").withColumn(side, F.coalesce("_" + side, side)).drop("_" + side)
    between = between.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    moved = components(between)
    old = labels.join(moved.toDF("component", "to"), "component", "left")
    new = moved.join(labels.select("node"), "node", "left_anti")
    return stored(old.select("node", F.coalesce("to", "component").alias("component")).union(new), "labels")


def _confirmed(pairs: DataFrame, reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The candidate pairs ``a, b`` that reach the similarity on their full sets.

    The signatures rule out pairs far below it. The sets of the remaining pairs
    travel once for each pair.
    """

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if rows.num_rows:
                a, b = (
                    np.frombuffer(b"".join(rows.column(c).to_pylist()), np.uint8).reshape(rows.num_rows, -1)
                    for c in ("ga", "gb")
                )
                keep = _allowed(a, b, rows.column("na").to_numpy(), rows.column("nb").to_numpy(), percent)
                yield rows.select(["a", "b"]).filter(pa.array(keep))

    for side in ("a", "b"):
        known = reps.select(
            F.col("id").alias(side), F.col("signature").alias("g" + side), F.col("n_shingles").alias("n" + side)
        )
        pairs = pairs.join(known, side)
    close = pairs.select("a", "b", "ga", "gb", "na", "nb").mapInArrow(
        near, T.StructType([pairs.schema["a"], pairs.schema["b"]])
    )
    close = stored(close, "pairs")
    for side in ("a", "b"):
        known = sets.select(F.col("id").alias(side), F.col("shingles").alias("s" + side))
        close = close.hint("merge").join(known, side)
    return stored(_linked(close, percent).distinct(), "links")


def _left_over(grouped: DataFrame, reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` that join what belongs together among the components of each bucket.

    Components with members of one bucket whose signatures allow the similarity
    are of one family; a bucket yields a forest that spans its families, so at
    most one pair for a component, not one for a member. Inside a family the full
    sets of all pairs of different components are compared, but for those that
    links found in the same task join already. Large buckets and families are cut
    into blocks, and a task has a pair of blocks.
    """
    kind = grouped.schema["id"].dataType
    several = (
        grouped.groupBy("bucket")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"))
        .where("low <> high")
        .select("bucket", F.ceil(F.col("n") / BUCKET_BLOCK).cast("int").alias("blocks"))
    )
    mixed = grouped.join(several, "bucket").select(F.col("bucket").alias("key"), "id", "component", "blocks")
    rest = _block_pairs(mixed.join(reps.select("id", "n_shingles", "signature"), "id"))

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges() -> Iterator[np.ndarray]:
            for ids, component, left, right, rows in _blocks(batches):
                sizes = rows.column("n_shingles").to_numpy()
                signatures = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint8).reshape(len(ids), -1)

                def near(x: int, others: np.ndarray) -> np.ndarray:
                    return _allowed(signatures[others], signatures[x], sizes[others], sizes[x], percent)

                labels = np.unique(component, return_inverse=True)[1]
                yield component[_spanning(labels, component, left, right, near)]

        yield from _pair_batches(edges())

    families = stored(rest.mapInArrow(alike, "a long, b long").distinct(), "families")
    if families.isEmpty():
        return families.select(F.col("a").cast(kind), F.col("b").cast(kind))
    family = components(families).select(F.col("node").alias("component"), F.col("component").alias("key"))
    members = mixed.select("id", "component").distinct().join(family, "component").hint("merge")
    sets = stored(sets.join(members, "id"), "families")
    blocks = sets.groupBy("key").agg(
        F.ceil(F.greatest(F.count("*") / FAMILY_BLOCK, F.sum(F.length("shingles")) / FAMILY_BYTES)).cast("int").alias("blocks")
    )

    def equal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges() -> Iterator[np.ndarray]:
            for ids, component, left, right, rows in _blocks(batches):
                members = [np.frombuffer(s, np.uint64) for s in rows.column("shingles").to_pylist()]
                labels = np.unique(component, return_inverse=True)[1]
                yield ids[_spanning(labels, component, left, right, _overlaps(members, percent))]

        yield from _pair_batches(edges())

    found = _block_pairs(sets.join(blocks, "key")).mapInArrow(equal, "a long, b long")
    return stored(found.select(F.col("a").cast(kind), F.col("b").cast(kind)).distinct(), "links")


def _block_pairs(rows: DataFrame) -> DataFrame:
    """Each row in all pairs ``x <= y`` of the ``blocks`` of its ``key`` that have its own ``block``, pairs in order."""
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    rows = rows.withColumns({"x": F.least("block", "other"), "y": F.greatest("block", "other")})
    rows = rows.withColumns({"id": F.col("id").cast("long"), "component": F.col("component").cast("long")})
    return rows.drop("blocks", "other").repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Of each pair of blocks: ids, components, positions of the one and of the other block, and all columns."""

    def whole(held: list[pa.RecordBatch]) -> tuple:
        rows = pa.Table.from_batches(held)
        block = rows.column("block").to_numpy()
        sides = (np.flatnonzero(block == rows.column(c)[0].as_py()) for c in ("x", "y"))
        return rows.column("id").to_numpy(), rows.column("component").to_numpy(), *sides, rows

    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.column_stack([batch.column(c).to_numpy().astype(np.int64) for c in ("key", "x", "y")])
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
        for at, end in zip(cuts, cuts[1:]):
            key = tuple(keys[at].tolist())
            if held and key != last:
                yield whole(held)
                held = []
            held.append(batch.slice(at, end - at))
            last = key
    if held:
        yield whole(held)


def _pair_batches(edges: Iterator[np.ndarray], most: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Arrays of two columns as batches ``a, b``, smaller ids first."""

    def batch() -> pa.RecordBatch:
        pairs = np.sort(np.concatenate(held), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    held, n = [], 0
    for pairs in edges:
        if len(pairs):
            held.append(pairs)
            n += len(pairs)
        if n >= most:
            yield batch()
            held, n = [], 0
    if held:
        yield batch()


def _spanning(labels: np.ndarray, component: np.ndarray, left: np.ndarray, right: np.ndarray, near) -> np.ndarray:
    """Pairs of positions that join all labels which pairs of different components join where ``near`` holds.

    ``near(x, others)`` tells which of ``others`` are near to ``x``. A pair
    whose labels are joined already is left out.
    """
    labels, found = labels.copy(), []
    for x in left.tolist():
        others = right[(component[right] != component[x]) & (labels[right] != labels[x])]
        if not len(others):
            continue
        others = others[near(x, others)]
        joined, first = np.unique(labels[others], return_index=True)
        if len(joined):
            found += [(x, y) for y in others[first].tolist()]
            labels[np.isin(labels, joined)] = labels[x]
    return np.array(found, np.int64).reshape(-1, 2)


def _allowed(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """Whether signatures and numbers of shingles allow the similarity."""
    equal = (a == b).mean(axis=1)
    # As many independent draws as bins, or as elements if there are fewer.
    draws = np.minimum(BINS, np.minimum(na, nb))
    least = percent / 100 - DEVIATIONS * np.sqrt(percent * (100 - percent) / 1e4 / draws)
    return (equal >= least) & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))


def _overlaps(members: list[np.ndarray], percent: int):
    """``near`` for sorted sets of distinct hashes: whether the similarity is reached."""
    sizes = np.array([len(m) for m in members])
    starts = np.cumsum(sizes) - sizes
    values, codes = np.unique(np.concatenate(members), return_inverse=True)
    mark = np.zeros(len(values), bool)

    def near(x: int, others: np.ndarray) -> np.ndarray:
        mine = codes[starts[x] : starts[x] + sizes[x]]
        mark[mine] = True
        if len(others) * 8 < len(members):
            common = np.array([np.count_nonzero(mark[codes[starts[y] : starts[y] + sizes[y]]]) for y in others.tolist()])
        else:
            common = np.add.reduceat(mark[codes], starts, dtype=np.int64)[others]
        mark[mine] = False
        return 100 * common >= percent * (sizes[x] + sizes[others] - common)

    return near
