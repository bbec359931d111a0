"""Near-duplicate documents by min-max hashing.

Each permutation of the shingles gives two signature values, the least and the greatest shingle, so 64
permutations make 128 values. Bands of four values put similar documents into common buckets. Documents with the
same shingles are one class. In every bucket each class is compared with one centre; only where the links
found leave a bucket in several components are further pairs compared, and of those only the ones that their distances
to the centre and their parity sketches allow. All links are confirmed on the full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from clearspan.llm.batches import Words, chunks, lowered, mixed, windows
from clearspan.llm.common import SPACE, in_fewer_parts, kept_and_counted, kept_once, text_of
from clearspan.llm.components import stars

SHINGLE = 5
PERMUTATIONS, BAND_ROWS = 64, 4
BANDS = 2 * PERMUTATIONS // BAND_ROWS
#: A link: 100 times the intersection is at least so many times the union.
PER_CENT = 75
#: Of the 128 values, compared by 4 bits each, so many may differ before a pair is taken as unlike unread. A pair of
#: similarity 0.75 differs in 30 on average with a deviation of 5, so this is over five deviations off.
SKETCH_DIFFERENT = 56
#: Bits of a parity sketch: each shingle flips one.
PARITY_BITS = 2048

#: Members of a bucket that meet those of another part of it in one task, and the step between size classes: a link's
#: sets differ in size by a third at most.
BUCKET_ROWS, SIZE_STEP = 512, 1.34

_RANDOM = np.random.default_rng(7)
_FACTORS = _RANDOM.integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _RANDOM.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2)


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts, repeats included, and how many each text has.

    A text with fewer words than a shingle has its whole sequence as its only one; a text without words has none.
    """
    words = Words(texts)
    hashes = words.hashes()
    grams = windows(hashes, SHINGLE)
    counts = np.where(words.counts >= SHINGLE, words.counts - SHINGLE + 1, np.minimum(words.counts, 1))
    for i in np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE)):
        first, n = words.first[i], words.counts[i]
        grams[first] = windows(hashes[first : first + n], SHINGLE)[0] ^ np.uint64(n)
    before = np.repeat(words.first[:-1] - (np.cumsum(counts) - counts), counts)
    return grams[np.arange(int(counts.sum())) + before], counts


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    grams, counts = shingles(texts)
    ends = np.cumsum(counts)
    return [np.unique(grams[e - n : e]) for e, n in zip(ends, counts, strict=True)]


def signatures(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Least and greatest value under each permutation, one row per text that has shingles."""
    starts = (np.cumsum(counts) - counts)[counts > 0]
    values = np.empty((2 * PERMUTATIONS, len(starts)), dtype=np.uint64)
    if len(starts):
        for j in range(PERMUTATIONS):
            permuted = grams * _FACTORS[j] + _OFFSETS[j]
            values[j] = np.minimum.reduceat(permuted, starts)
            values[PERMUTATIONS + j] = np.maximum.reduceat(permuted, starts)
    return values.T


def band_keys(values: np.ndarray) -> np.ndarray:
    """One bucket key per band. A band takes its least and its greatest values from different permutations."""
    keys = np.zeros((len(values), BANDS), dtype=np.uint64)
    half = BAND_ROWS // 2
    for b in range(BANDS):
        least = [(half * b + k) % PERMUTATIONS for k in range(half)]
        greatest = [PERMUTATIONS + (half * b + k + PERMUTATIONS // 2) % PERMUTATIONS for k in range(half)]
        total = np.full(len(values), b + 1, dtype=np.uint64)
        for slot in [*least, *greatest]:
            total = mixed(total + values[:, slot])
        keys[:, b] = total
    return keys.view(np.int64)


def sketches(values: np.ndarray) -> np.ndarray:
    """Four bits of each signature value, 16 to a number."""
    bits = mixed(values) & np.uint64(15)
    places = np.uint64(4) * np.arange(16, dtype=np.uint64)
    return (bits.reshape(len(values), -1, 16) << places).sum(axis=2, dtype=np.uint64).view(np.int64)


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """A parity sketch of each set, 64 bits to a number. Two sketches differ in no more bits than the sets in shingles."""
    bits = np.zeros((len(sets), PARITY_BITS), dtype=np.uint8)
    for row, found in zip(bits, sets, strict=True):
        row[:] = np.bincount((found % np.uint64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(bits, axis=1, bitorder="little").view("<i8")


def _lists(values: np.ndarray, present: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(present * values.shape[1])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1)))


def _row_key() -> Column:
    """Tells rows by id and text; rows alike in both have one key."""
    return F.unhex(F.md5(F.encode(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), text_of()), "UTF-8")))


def signed(docs: DataFrame) -> DataFrame:
    """``doc_id, row_key, node, n_shingles, bands, sketch, parity`` per row; null nodes for rows without shingles.

    Rows with the same set of shingles have the same node, 64 bits of a digest of the set: one class.
    """
    fields = "row_key binary, node long, n_shingles long, bands array<long>, sketch array<long>, parity array<long>"
    schema = T.StructType([docs.schema["doc_id"], *T._parse_datatype_string(fields).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in chunks(batches):
            grams, counts = shingles(lowered(texts))
            values = signatures(grams, counts)
            ends = np.cumsum(counts)
            sets = [np.unique(grams[e - n : e]) for e, n in zip(ends, counts, strict=True)]
            nodes = [int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) if len(s) else None for s in sets]
            present = counts > 0
            lists = [_lists(x, present) for x in (band_keys(values), sketches(values), parities([s for s in sets if len(s)]))]
            sizes = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(nodes, pa.int64()), sizes, *lists], schema.names)

    return docs.select("doc_id", _row_key().alias("row_key"), docs["text"].cast("string").alias("text")).mapInArrow(run, schema)


def compared(pairs: DataFrame) -> DataFrame:
    """Sizes of intersection and union (``common, all``) of the full shingle sets of ``text_a`` and ``text_b``, instead of the texts."""
    kept = [c for c in pairs.columns if c not in ("text_a", "text_b")]
    schema = T.StructType([*[pairs.schema[c] for c in kept], *T._parse_datatype_string("common long, all long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, first in chunks(batches, "text_a"):
            second = rows.column("text_b").to_pylist()
            other = list(dict.fromkeys(t.encode() for t in second))
            known = dict(zip(other, shingle_sets(lowered(other)), strict=True))
            common, union = [], []
            for one, text in zip(shingle_sets(lowered(first)), second, strict=True):
                two = known[text.encode()]
                same = len(np.intersect1d(one, two, assume_unique=True))
                common.append(same)
                union.append(len(one) + len(two) - same)
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in kept), pa.array(common, pa.int64()), pa.array(union, pa.int64())], schema.names)

    return pairs.mapInArrow(run, schema)


def _different(x: str, y: str) -> Column:
    """How many of the 4-bit values of two sketches differ."""
    total = F.lit(0)
    for k in range(2 * PERMUTATIONS // 16):
        bits = F.get(x, F.lit(k)).bitwiseXOR(F.get(y, F.lit(k)))
        for shift in (1, 2):
            bits = bits.bitwiseOR(F.shiftrightunsigned(bits, shift))
        total = total + F.bit_count(bits.bitwiseAND(F.lit(0x1111111111111111)))
    return total


def _parity_differs(x: str, y: str) -> Column:
    total = F.lit(0)
    for k in range(PARITY_BITS // 64):
        total = total + F.bit_count(F.get(x, F.lit(k)).bitwiseXOR(F.get(y, F.lit(k))))
    return total


def _is_link() -> Column:
    return F.col("common") * 100 >= F.col("all") * PER_CENT


def _placed(classes: DataFrame) -> DataFrame:
    """``node, places``: the buckets (32 at most) that a class shares with others, and the centre of each.

    The centre of a bucket is its member with the most company over all its buckets: the most typical text.
    """
    placed = classes.select("node", F.explode("bands").alias("bucket"))
    shared = placed.groupBy(F.col("bucket").alias("__bucket")).agg(F.count("*").alias("size")).where("size > 1")
    members = placed.join(shared, F.col("bucket") == F.col("__bucket")).select("bucket", "node", "size")
    company = members.groupBy(F.col("node").alias("__node")).agg(F.sum("size").alias("company"))
    ranked = members.join(company, F.col("node") == F.col("__node")).select("bucket", "node", "company")
    centres = ranked.groupBy(F.col("bucket").alias("__bucket")).agg(F.max(F.struct("company", "node"))["node"].alias("centre"))
    told = ranked.join(centres, F.col("bucket") == F.col("__bucket"))
    return told.groupBy("node").agg(F.collect_list(F.struct("bucket", "centre")).alias("places"))


def _with_texts(places: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """``node, places, text`` with the text of one row of the class; of rows alike in id and text one is read."""
    keys = classes.select(F.col("node").alias("__node"), F.col("row_key").alias("__key"))
    wanted = places.join(keys, F.col("node") == F.col("__node")).select("node", "places", "__key")
    texts = docs.select(_row_key().alias("row_key"), text_of().alias("text"))
    one = Window.partitionBy("row_key").orderBy("node")
    found = texts.join(wanted, F.col("row_key") == F.col("__key")).withColumn("__n", F.row_number().over(one))
    return found.where("__n = 1").select("node", "places", "text")


def _open_members(near: DataFrame, groups: DataFrame, held: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of buckets that the links found so far leave in several components, without their centres.

    ``bucket, members, node, component, likeness`` (to the centre, which has met everyone in the bucket), and from the
    class ``n, sketch, parity``.
    """
    met = near.join(groups.withColumnRenamed("node", "__node"), F.col("a") == F.col("__node"), "left")
    met = met.groupBy("a").agg(
        F.first(F.coalesce("component", "a")).alias("component"),
        F.map_from_entries(F.collect_list(F.struct("b", F.col("common") / F.col("all")))).alias("likeness"),
    )
    told = held.select("node", F.explode("places").alias("place")).where("node <> place.centre")
    told = told.join(met, F.col("node") == F.col("a")).select(
        F.col("place.bucket").alias("bucket"), "node", "component", F.col("likeness")[F.col("place.centre")].alias("likeness")
    )
    split = told.groupBy(F.col("bucket").alias("__bucket")).agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("members"))
    open_ = told.join(split.where("lo < hi"), F.col("bucket") == F.col("__bucket")).drop("__bucket", "lo", "hi")
    facts = classes.select(F.col("node").alias("__node"), F.col("n_shingles").alias("n"), "sketch", "parity")
    return open_.join(facts, F.col("node") == F.col("__node")).drop("__node")


def _across(open_: DataFrame) -> DataFrame:
    """``a, b, component_a, component_b``: pairs of different components in a bucket that may be links.

    Buckets are split by size class, as sizes of linked sets differ by a third at most, and large ones are dealt over salts.
    """
    salts = F.ceil(F.col("members") / BUCKET_ROWS).cast("int")
    size_class = F.floor(F.log(F.col("n")) / F.log(F.lit(SIZE_STEP))).cast("int")
    keyed = open_.withColumns({"size_class": size_class, "salts": salts})
    x = keyed.withColumn("salt", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int"))
    y = keyed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    y = y.withColumn("size_class", F.explode(F.array(*[F.col("size_class") + k for k in (-1, 0, 1)])))
    x, y = (side.select(*[F.col(c).alias(f"{c}_{name}") for c in side.columns if c not in ("members", "salts")]) for side, name in ((x, "x"), (y, "y")))
    # Distance 1 - likeness is a metric: the distances of a link's ends to any third text differ by 0.25 at most.
    # A link's sets differ in at most a seventh of their shingles, and their parity sketches in no more bits.
    may_link = (
        (F.col("bucket_x") == F.col("bucket_y"))
        & (F.col("size_class_x") == F.col("size_class_y"))
        & (F.col("salt_x") == F.col("salt_y"))
        & (F.col("component_x") < F.col("component_y"))
        & (F.abs(F.col("likeness_x") - F.col("likeness_y")) <= 1 - PER_CENT / 100 + 1e-9)
        & (F.least("n_x", "n_y") * 100 >= F.greatest("n_x", "n_y") * PER_CENT)
        & (_different("sketch_x", "sketch_y") <= SKETCH_DIFFERENT)
        & ((100 + PER_CENT) * _parity_differs("parity_x", "parity_y") <= (100 - PER_CENT) * (F.col("n_x") + F.col("n_y")))
    )
    names = [F.col(f"{c}_{side}").alias(alias) for c, side, alias in (("node", "x", "a"), ("node", "y", "b"), ("component", "x", "component_a"), ("component", "y", "component_b"))]
    return x.join(y, may_link).select(*names).distinct()


def grouped_rows(docs: DataFrame) -> tuple[DataFrame, int]:
    """``doc_id, row_key, n_shingles, component`` per row, and how many have a component: the least node that links of sets lead to."""
    # Kept: the signatures are the costly part, and narrow.
    rows, seen = kept_and_counted(signed(docs), worded=F.count("node"))
    worded = seen["worded"]
    first = Window.partitionBy("node").orderBy(F.asc_nulls_last("doc_id"), "row_key")
    classes = rows.where("node IS NOT NULL").withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n", "doc_id")
    classes = kept_once(in_fewer_parts(classes, worded))
    centres = F.array_distinct("places.centre")
    held = in_fewer_parts(_with_texts(_placed(classes), classes, docs), worded)
    held, seen = kept_and_counted(held, centres=F.sum(F.size(centres)), places=F.sum(F.size("places")))
    met, places = seen["centres"] or 0, seen["places"] or 0
    texts = held.select(F.col("node").alias("__node"), F.col("text").alias("__text"))

    spokes = held.select(F.col("node").alias("a"), F.col("text").alias("text_a"), F.explode(centres).alias("b")).where("a <> b")
    spokes = spokes.join(texts, F.col("b") == F.col("__node")).select("a", "b", "text_a", F.col("__text").alias("text_b"))
    near, seen = kept_and_counted(compared(in_fewer_parts(spokes, met)), links=F.count(F.when(_is_link(), 1)))
    groups = stars(near.where(_is_link()).select("a", "b"), seen["links"])
    told = rows.select("doc_id", "row_key", "n_shingles", "node").join(groups.withColumnRenamed("node", "__node"), F.col("node") == F.col("__node"), "left")
    told = told.select("doc_id", "row_key", "n_shingles", F.coalesce("component", "node").alias("component"))

    open_, seen = kept_and_counted(in_fewer_parts(_open_members(near, groups, held, classes), worded + places), rows=F.count("*"))
    if seen["rows"]:
        pairs = _across(open_).join(texts, F.col("a") == F.col("__node")).drop("__node").withColumnRenamed("__text", "text_a")
        pairs = pairs.join(texts, F.col("b") == F.col("__node")).drop("__node").withColumnRenamed("__text", "text_b")
        more, seen = kept_and_counted(compared(pairs).where(_is_link()).select("component_a", "component_b"), rows=F.count("*"))
        if seen["rows"]:
            told = _renamed(told, stars(more, seen["rows"]))
    return told, worded


def _renamed(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows with their component replaced by the one that ``groups`` puts it in."""
    further = groups.select(F.col("node").alias("__node"), F.col("component").alias("__component"))
    joined = rows.join(further, F.col("component") == F.col("__node"), "left")
    return joined.withColumn("component", F.coalesce("__component", "component")).drop("__node", "__component")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked if their sets of 5-word shingles have a Jaccard similarity of 0.75 or more, and
    ``component_id`` is the smallest ``doc_id`` that links lead to. Ids may be numbers or texts. Null and empty texts and
    texts without words have no shingles and no links. Rows with the same ``doc_id`` are one document with the
    links of all. Rows without ``doc_id`` take part; their ``component_id`` is null if no numbered document is reached.
    ``kept`` holds if ``doc_id`` and ``component_id`` are the same, null included. Texts of any length are taken whole.
    An empty table gives no rows. Other columns are neither read nor returned.
    """
    rows, _ = grouped_rows(docs)
    rows = kept_once(rows)
    known = rows.where("doc_id IS NOT NULL AND component IS NOT NULL")
    spread = known.groupBy(F.col("doc_id").alias("__id")).agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    spread, seen = kept_and_counted(spread, rows=F.count("*"))
    if seen["rows"]:
        # Ids with several unlike texts join the components of all of them.
        same = kept_once(known.join(spread, F.col("doc_id") == F.col("__id")).select("component", "lo").distinct())
        rows = _renamed(rows, stars(same))
    ids = rows.where("component IS NOT NULL").groupBy(F.col("component").alias("__component")).agg(F.min("doc_id").alias("component_id"))
    result = rows.join(ids, F.col("component") == F.col("__component"), "left")
    component = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    result = result.select("doc_id", "n_shingles", component.alias("component_id"))
    return result.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of each group of near-duplicates, with all its columns: that of the smallest ``doc_id``.

    Groups are of texts: unlike texts of one ``doc_id`` both stay. Rows without ``doc_id`` give way to numbered
    ones; among rows alike in ``doc_id`` the digest of the text decides, and of rows alike in both one stays. Rows
    without words are like nothing and all stay. An empty table gives no rows.
    """
    rows, worded = grouped_rows(docs)
    first = Window.partitionBy("component").orderBy(F.asc_nulls_last("doc_id"), "row_key")
    heads = rows.where("component IS NOT NULL").withColumn("__n", F.row_number().over(first)).where("__n = 1").select(F.col("row_key").alias("__head"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    packed = docs.select(whole, _row_key().alias("__key"), text_of().rlike(f"[^{SPACE}]").alias("__words"))
    one = Window.partitionBy("__key").orderBy("__head")
    chosen = packed.where("__words").join(heads, F.col("__key") == F.col("__head")).withColumn("__n", F.row_number().over(one)).where("__n = 1")
    return in_fewer_parts(chosen, worded).select("__row.*").union(packed.where("NOT __words").select("__row.*"))
