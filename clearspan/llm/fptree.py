"""Ranked lexical search by branch and bound over document FP-trees.

Only terms of the items count. The restricted term vector of a document lists its terms, most frequent in the corpus
first; sorted vectors that begin alike share the path of a trie. A subtree is bounded for an item by the largest count
of each term in it and the least length value ``m``: no document in it can score more. Each item goes depth first
through the trees, best bound first, and leaves out every subtree that its ten best so far exclude.

A task builds one tree after another from its own documents and keeps the best of each item, so nothing but these
is shuffled. Items are taken in blocks with a bounded number of terms, which is all that a worker holds of them.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from clearspan.llm.batches import chunks
from clearspan.llm.common import kept_once

TOP = 10
#: Items are searched in blocks of so many terms; an item with more is a block of its own.
BLOCK_TERMS = 200_000
#: A tree ends at so many documents or entries, a leaf at so many documents.
TREE_ROWS, TREE_ENTRIES, LEAF_ROWS = 8_192, 1_000_000, 64
#: Long texts are cut into terms piece by piece.
PIECE_BYTES = 4_000_000

#: Bytes outside terms become spaces, A-Z lower case; bytes of 0x80 and above are parts of terms.
_TERM_BYTES = bytes(c if chr(c).isalnum() or c >= 0x80 else 0x20 for c in range(256)).lower()


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of a bounded number of bytes."""
    cleaned, start = text.translate(_TERM_BYTES), 0
    while start < len(cleaned):
        end = cleaned.find(b" ", start + PIECE_BYTES)
        end = len(cleaned) if end < 0 else end
        yield cleaned[start:end].split()
        start = end


def blocks(items: DataFrame) -> Iterator[list[tuple[object, list[bytes]]]]:
    """Lists of ``(item_id, distinct terms)``; the driver holds one list at a time."""
    held, total = [], 0
    for row in items.select("item_id", F.col("text").cast("string").alias("text")).toLocalIterator():
        terms = sorted(set().union(*terms_of((row["text"] or "").encode())))
        if held and total + len(terms) > BLOCK_TERMS:
            yield held
            held, total = [], 0
        held.append((row["item_id"], terms))
        total += len(terms)
    if held:
        yield held


def restricted_vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, tfs`` per row: all terms with repeats, and the numbers and counts of those in the vocabulary."""
    schema = T.StructType([docs.schema["doc_id"], *T._parse_datatype_string("n long, terms array<int>, tfs array<int>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in chunks(batches):
            sizes, ends, terms, tfs = [], [0], [], []
            for text in texts:
                n, counts = 0, Counter()
                for part in terms_of(text):
                    n += len(part)
                    counts.update(map(vocabulary.get, part))
                counts.pop(None, None)
                sizes.append(n)
                terms += counts.keys()
                tfs += counts.values()
                ends.append(len(terms))
            lists = (pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (terms, tfs))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(run, schema)


class Tree:
    """The trie of some restricted vectors. Subtrees are ranges of the sorted documents, cut down to leaves."""

    def __init__(self, ids: list, m: np.ndarray, ends: np.ndarray, ranks: np.ndarray, tfs: np.ndarray):
        """``ends`` has the bounds of each document's entries; ``ranks`` numbers terms by falling frequency."""
        n = len(ids)
        vectors, counts = [], []
        for d in range(n):
            r, c = ranks[ends[d] : ends[d + 1]], tfs[ends[d] : ends[d + 1]]
            order = np.argsort(r)
            vectors.append(r[order])
            counts.append(c[order])
        keys = [v.astype(">i4").tobytes() for v in vectors]
        order = sorted(range(n), key=keys.__getitem__)
        self.ids = [ids[d] for d in order]
        self.m = m[order]
        vectors, counts = [vectors[d] for d in order], [counts[d] for d in order]
        self.ends = np.concatenate([[0], np.cumsum([len(v) for v in vectors])]).astype(np.int64)
        self.ranks = np.concatenate(vectors).astype(np.int64)
        tf = np.concatenate(counts).astype(np.int64)
        self.parts = _part(tf, np.repeat(self.m, np.diff(self.ends)))
        self._cut(np.array([0, *(_shared(a, b) for a, b in zip(vectors, vectors[1:]))], dtype=np.int64))

        # Largest count of each term in each leaf, ordered by term, and the least m of each leaf.
        leaf = np.searchsorted(self.leaves, np.repeat(np.arange(n), np.diff(self.ends)), side="right") - 1
        cell = self.ranks * len(self.leaves) + leaf
        by_cell = np.argsort(cell, kind="stable")
        cell, first = np.unique(cell[by_cell], return_index=True)
        self.most = np.maximum.reduceat(tf[by_cell], first)
        self.cell_leaf = cell % len(self.leaves)
        self.cell_rank = cell // len(self.leaves)
        self.least_m = np.minimum.reduceat(self.m, self.leaves)

    def _cut(self, shared: np.ndarray) -> None:
        """Sets ``leaves`` (first document of each) and ``nodes``: per inner node its children as (first leaf, node or None)."""
        n = len(shared)
        starts: list[int] = []
        self.nodes: list[list[tuple[int, int | None]]] = [[]]
        # Work is done in the order of the documents: the last entry is the next range.
        work: list[tuple[int, int, int, bool]] = [(0, n, 0, True)]
        while work:
            lo, hi, parent, inner = work.pop()
            if not inner:
                self.nodes[parent].append((len(starts), None))
                starts.append(lo)
                continue
            node = parent
            if lo or hi < n:
                node = len(self.nodes)
                self.nodes.append([])
                self.nodes[parent].append((len(starts), node))
            inside = shared[lo + 1 : hi]
            cuts = [lo, *(np.flatnonzero(inside == inside.min()) + lo + 1).tolist(), hi] if hi - lo > 1 else [lo, hi]
            # Small subtrees side by side share a leaf.
            ranges: list[tuple[int, int, int, bool]] = []
            for a, b in zip(cuts, cuts[1:]):
                small = b - a <= LEAF_ROWS
                if small and ranges and not ranges[-1][3] and b - ranges[-1][0] <= LEAF_ROWS:
                    ranges[-1] = (ranges[-1][0], b, node, False)
                else:
                    ranges.append((a, b, node, not small))
            work += reversed(ranges)
        self.leaves = np.array(starts, dtype=np.int64)
        self.leaf_ends = np.append(self.leaves[1:], n)

    def search(self, ranks: np.ndarray, weights: np.ndarray, best: list[tuple], top: int) -> list[tuple]:
        """``best`` with the documents that belong among the ``top`` best: tuples (-score, no id, id), in order."""
        most = np.zeros((len(ranks), len(self.leaves)), dtype=np.int64)
        lo, hi = np.searchsorted(self.cell_rank, ranks), np.searchsorted(self.cell_rank, ranks, side="right")
        for k in range(len(ranks)):
            most[k, self.cell_leaf[lo[k] : hi[k]]] = self.most[lo[k] : hi[k]]
        weight_of = dict(zip(ranks.tolist(), weights.tolist()))
        dense = np.zeros(int(self.ranks.max()) + 1, dtype=np.int64)
        for r, w in weight_of.items():
            if r < len(dense):
                dense[r] = w
        stack: list[tuple[int, int, int, int | None]] = [(0, 0, len(self.leaves), 0)]
        bound_known = False
        while stack:
            bound, x, y, node = stack.pop()
            if bound_known and len(best) == top and bound < -best[-1][0]:
                continue
            bound_known = True
            if node is None:
                best = self._scored(x, dense, best, top)
                continue
            children = self.nodes[node]
            firsts = np.array([c[0] for c in children])
            tf = np.maximum.reduceat(most[:, x:y], firsts - x, axis=1) if len(ranks) else np.zeros((0, len(firsts)), dtype=np.int64)
            m = np.minimum.reduceat(self.least_m[x:y], firsts - x)
            bounds = (weights[:, None] * _part(tf, m[None, :])).sum(axis=0)
            ends = np.append(firsts[1:], y)
            for c in np.argsort(bounds, kind="stable").tolist():
                if bounds[c] > 0:
                    stack.append((int(bounds[c]), int(firsts[c]), int(ends[c]), children[c][1]))
        return best

    def _scored(self, leaf: int, dense: np.ndarray, best: list[tuple], top: int) -> list[tuple]:
        lo, hi = int(self.leaves[leaf]), int(self.leaf_ends[leaf])
        a, b = self.ends[lo], self.ends[hi]
        scores = np.add.reduceat(dense[self.ranks[a:b]] * self.parts[a:b], self.ends[lo:hi] - a)
        least = -best[-1][0] if len(best) == top else 1
        found = [(-int(scores[d]), self.ids[lo + d] is None, 0 if self.ids[lo + d] is None else self.ids[lo + d]) for d in np.flatnonzero(scores >= least)]
        return sorted(best + found)[:top] if found else best


def _part(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds per unit of weight: more for a larger count, less for a larger m."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning."""
    n = min(len(a), len(b))
    different = a[:n] != b[:n]
    first = int(different.argmax()) if n else 0
    return first if n and different[first] else n


def _trees(batches: Iterator[pa.RecordBatch], rank: np.ndarray) -> Iterator[Tree]:
    """Trees over rows ``doc_id, m, terms, tfs``, each of a bounded number of entries."""
    ids, ms, sizes, terms, tfs, entries = [], [], [], [], [], 0

    def tree() -> Tree:
        ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        return Tree([i for part in ids for i in part], np.concatenate(ms), ends, rank[np.concatenate(terms)], np.concatenate(tfs))

    for batch in batches:
        for start in range(0, batch.num_rows, TREE_ROWS // 8):
            part = batch.slice(start, TREE_ROWS // 8)
            lists = part.column(2)
            ids.append(part.column(0).to_pylist())
            ms.append(part.column(1).to_numpy(zero_copy_only=False).astype(np.int64))
            sizes.append(np.diff(lists.offsets.to_numpy()).astype(np.int64))
            terms.append(lists.flatten().to_numpy())
            tfs.append(part.column(3).flatten().to_numpy())
            entries += len(terms[-1])
            if entries >= TREE_ENTRIES or sum(map(len, ids)) >= TREE_ROWS:
                yield tree()
                ids, ms, sizes, terms, tfs, entries = [], [], [], [], [], 0
    if entries:
        yield tree()


def search_block(docs: DataFrame, items: list[tuple[object, list[bytes]]], item_type: T.StructField, top: int) -> DataFrame:
    """The best documents of each item of one block: ``__item, item_id, doc_id, score``, more than ``top`` rows an item."""
    vocabulary = {term: k for k, term in enumerate(sorted(set().union(*(terms for _, terms in items))))}
    vectors = kept_once(restricted_vectors(docs, vocabulary))
    # At most one row per term of the block.
    rows: list[Row] = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()
    df = np.zeros(len(vocabulary), dtype=np.int64)
    for row in rows:
        df[row["term"]] = row["df"]
    whole = vectors.where("n > 0").agg(F.count("*").alias("texts"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    weight = np.array([math.floor(1000 * math.log((2 * whole["texts"] + 2) / (2 * int(x) + 1))) for x in df], dtype=np.int64)
    rank = np.empty(len(df), dtype=np.int64)
    rank[np.lexsort((np.arange(len(df)), -df))] = np.arange(len(df))
    wanted = [np.array([vocabulary[t] for t in terms], dtype=np.int64) for _, terms in items]
    # Terms without documents or weight change no score.
    wanted = [w[(df[w] > 0) & (weight[w] > 0)] for w in wanted]
    item_ids = [i for i, _ in items]
    schema = T.StructType([T.StructField("__item", T.IntegerType()), item_type, docs.schema["doc_id"], T.StructField("score", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in items]
        id_type = None

        def seen() -> Iterator[pa.RecordBatch]:
            nonlocal id_type
            for batch in batches:
                id_type = batch.schema.field(0).type
                yield batch

        for tree in _trees(seen(), rank):
            for k, terms in enumerate(wanted):
                if len(terms):
                    best[k] = tree.search(rank[terms], weight[terms], best[k], top)
        found = [(k, item_ids[k], None if none else doc, -score) for k, rows in enumerate(best) for score, none, doc in rows]
        if found:
            columns = list(zip(*found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1]), pa.array(columns[2], id_type), pa.array(columns[3], pa.int64())],
                ["__item", "item_id", "doc_id", "score"],
            )

    texts, terms = int(whole["texts"]), max(int(whole["terms"]), 1)
    # Wider than 64 bits in between: a long text times many texts.
    m = F.expr(f"10 + (CAST(n AS DECIMAL(18, 0)) * CAST({90 * texts} AS DECIMAL(18, 0))) div {terms}").cast("bigint")
    held = vectors.where(F.size("terms") > 0).select("doc_id", m.alias("m"), "terms", "tfs")
    return held.mapInArrow(run, schema)


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each row of ``items`` its best documents, equal scores by ascending ``doc_id``.

    Every row of ``docs`` is a document and every row of ``items`` an item of its own, also where ids are repeated or
    null; documents without id come after numbered ones of the same score. Null and empty texts have no terms: such
    documents are never found, such items find nothing. Empty tables give no rows. Texts may be of any length, they
    are cut into terms piece by piece. Other columns of both tables are neither read nor returned.
    """
    item_type, found = items.schema["item_id"], None
    for block in blocks(items):
        best = search_block(docs, block, item_type, top)
        order = Window.partitionBy("__item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        part = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        part = part.select("item_id", "rank", "doc_id", "score")
        found = part if found is None else found.union(part)
    if found is not None:
        return found
    schema = T.StructType([item_type, T.StructField("rank", T.IntegerType()), docs.schema["doc_id"], T.StructField("score", T.LongType())])
    return items.sparkSession.createDataFrame([], schema)
