"""Language-model scores by prediction by partial matching over bytes, and by word counts.

The model is a trie of byte contexts with the counts of the byte that followed each, from all training
texts. A byte is coded in its longest context; if it was not seen there, an escape (method C: as many
counts as the context has different bytes) leads to the next shorter context, where the bytes of the
longer one are excluded.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearspan.llm.batches import CHUNK_BYTES, chunks, lowered
from clearspan.llm.common import kept_once

#: Context bytes of the longest contexts, and of those that have at most 2^24 nodes for any corpus.
ORDER, SHORT = 5, 2
SHORT_NODES = 1 << 8 * (SHORT + 1)
#: The longer contexts are dealt into slices of about so many nodes by their last three bytes, which all the contexts
#: of a byte share. A task holds one slice, and the codes of all chunks pass by it.
SLICE_NODES = 4_000_000
#: Different codes and words are looked up for about so many bytes of text together.
LOOKUP_BYTES = 24_000_000
#: Codes that a training task holds; above half of them when added up, they are passed on.
HELD_CODES = 2_000_000
#: Words are counted in chunks of about so many bytes: the larger, the fewer rows a word has.
WORD_BYTES = 4_000_000
#: Bytes that UTF-8 never holds: before the first byte of a text, and its end.
BEFORE, END = 0xFE, 0xFF
#: A word's text is never empty, so the empty text stands for the end of a document.
END_WORD = ""


def _last(codes: np.ndarray, n: int) -> np.ndarray:
    """The last ``n`` bytes of codes."""
    return codes & np.uint64((1 << 8 * n) - 1)


def _joined(data: np.ndarray, n: int) -> np.ndarray:
    """Each run of ``n`` bytes as one number, the first byte highest."""
    if n == 1:
        return data.astype(np.uint64)
    size = len(data) - n + 1
    if n % 2:
        return (_joined(data, n - 1)[:size] << np.uint64(8)) | data[n - 1 :]
    half = n // 2
    part = _joined(data, half)
    return (part[:size] << np.uint64(8 * half)) | part[half : half + size]


def contexts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of each text, end included: its context bytes and the byte as one number; and where texts start."""
    before = bytes([BEFORE]) * ORDER
    data = np.frombuffer(b"".join(before + t + bytes([END]) for t in texts), dtype=np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    # The codes that reach over the border of two texts end in a byte before the second one.
    return _joined(data, ORDER + 1)[data[ORDER:] != BEFORE], np.cumsum(sizes) - sizes


def distinct(codes: np.ndarray) -> np.ndarray:
    """The codes in order, each once."""
    codes = np.sort(codes)
    return codes[np.flatnonzero(np.diff(codes, prepend=codes[:1] ^ np.uint64(1)))]


def added_up(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and the sums of their counts."""
    order = np.argsort(codes)
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.diff(codes, prepend=codes[:1] ^ np.uint64(1)))
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


class Level:
    """The contexts of one length in order, and the nodes, a byte after a context, with their counts."""

    def __init__(self, nodes: np.ndarray, n: np.ndarray, below: Level | None):
        held = nodes >> np.uint64(8)
        first = np.flatnonzero(np.diff(held, prepend=held[:1] ^ np.uint64(1)))
        total, different = (np.add.reduceat(n, first) if len(first) else n), np.diff(first, append=len(held))
        self.nodes, self.held = nodes, held[first]
        # Counts stay exact: the differences below may be small ones of large numbers.
        self.n, self.total, self.different = n.astype(np.float64), total.astype(np.float64), different.astype(np.float32)
        if below is not None:
            length = below.bytes
            at = np.searchsorted(below.held, _last(self.held, length))
            gone = below.n[np.searchsorted(below.nodes, _last(nodes, length + 1))]
            gone = np.add.reduceat(gone, first) if len(first) else gone
            #: Of the next shorter context without the bytes of this one: counts that lead to an escape, and all.
            self.escape_below = below.different[at] - self.different
            self.whole_below = (below.total[at] - gone + self.escape_below).astype(np.float32)
        self.bytes = 0 if below is None else below.bytes + 1


def levels(codes: np.ndarray, counts: np.ndarray, longest: int, below: list[Level]) -> list[Level]:
    """``below`` (contexts of 0, 1, .. bytes) and the levels up to ``longest``, from distinct codes in order."""
    grown = list(below)
    for k in range(len(below), longest + 1):
        nodes, n = (codes, counts) if k == longest else added_up(_last(codes, k + 1), counts)
        grown.append(Level(nodes, n, grown[-1] if grown else None))
    return grown


def log_probabilities(trie: list[Level], codes: np.ndarray) -> np.ndarray:
    """log10 of the probability of the last byte of each code after the bytes before it."""
    result, left = np.zeros(len(codes)), np.arange(len(codes))
    # What an escape and all weigh in the context at hand, without the bytes of longer contexts; below 0: it is the longest known.
    escape, whole = np.full(len(codes), -1.0), np.zeros(len(codes))
    for level in reversed(trie):
        if not len(level.held) or not len(left):
            continue
        wanted = _last(codes[left], level.bytes + 1)
        at = np.minimum(np.searchsorted(level.held, wanted >> np.uint64(8)), len(level.held) - 1)
        known = level.held[at] == wanted >> np.uint64(8)
        longest = escape[left] < 0
        all_counts = np.where(longest, level.total[at] + level.different[at], whole[left])
        node = np.minimum(np.searchsorted(level.nodes, wanted), len(level.nodes) - 1)
        hit = known & (level.nodes[node] == wanted)
        result[left[hit]] += np.log10(level.n[node[hit]]) - np.log10(all_counts[hit])
        missed = known & ~hit
        leads_on = np.where(longest, level.different[at], escape[left])
        some = missed & (leads_on > 0)  # else every byte of the context is excluded, and the escape is sure
        result[left[some]] += np.log10(leads_on[some]) - np.log10(all_counts[some])
        if level.bytes:
            escape[left[missed]], whole[left[missed]] = level.escape_below[at[missed]], level.whole_below[at[missed]]
        left = left[~hit]
    # Bytes never seen at all share what is left alike.
    result[left] -= math.log10(max(256 - len(trie[0].nodes), 1))
    return result


def _slices_of(codes: np.ndarray, slices: int) -> np.ndarray:
    """Slices of codes, by the last three bytes before a byte."""
    return (_last(codes >> np.uint64(8), SHORT + 1) * np.uint64(2654435761)) % np.uint64(slices)


def _spread(known: np.ndarray, values: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The value of each code, by a hash table; codes that share a place with another are searched."""
    bits = max(10, int(len(known)).bit_length() + 2)
    place = lambda c: (c * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
    keys, held = np.zeros(1 << bits, dtype=np.uint64), np.zeros(1 << bits)
    at = place(known)
    keys[at], held[at] = known, values
    at = place(codes)
    found, lost = held[at], np.flatnonzero(keys[at] != codes)
    found[lost] = values[np.searchsorted(known, codes[lost])]
    return found


def _portions(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The texts in turn, about ``CHUNK_BYTES`` at a time."""
    start = size = 0
    for k, text in enumerate(texts):
        if k > start and size + len(text) > CHUNK_BYTES:
            yield texts[start:k]
            start, size = k, 0
        size += len(text)
    if start < len(texts):
        yield texts[start:]


def held_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    """Whether the CRC-32 of the id's text is ``fold`` modulo ``folds``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def train(docs: DataFrame) -> DataFrame:
    """Counts of words (``word``) and of bytes in their longest contexts (``code``) over all rows: ``word, code, n``.

    Every task adds up its own part first; ends of documents are counted under the empty word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            return added_up(*(np.concatenate(part) for part in zip(*held, strict=True))) if len(held) > 1 else held[0]

        def passed_on() -> pa.RecordBatch:
            codes, counts = merged()
            columns = [pa.nulls(len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(counts)]
            return pa.RecordBatch.from_arrays(columns, ["word", "code", "n"])

        for _, texts in chunks(batches, size=WORD_BYTES):
            texts = lowered(texts)
            for portion in _portions(texts):
                held.append(np.unique(contexts(portion)[0], return_counts=True))
                if sum(len(codes) for codes, _ in held) >= HELD_CODES:
                    held[:] = [merged()]
                    if len(held[0][0]) >= HELD_CODES // 2:
                        yield passed_on()
                        held.clear()
            words, n = _counted(texts)
            columns = [pa.array(words, pa.binary()).cast(pa.string()), pa.nulls(len(words), pa.int64()), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, ["word", "code", "n"])
        if held:
            yield passed_on()

    return docs.select("text").mapInArrow(run, "word string, code long, n long").groupBy("word", "code").agg(F.sum("n").alias("n"))


def _counted(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Distinct words and their counts, with the ends of the texts as the empty word."""
    counts: Counter = Counter()
    for text in texts:
        counts.update(text.split())
    words = [*counts, b""]
    return words, np.fromiter([*counts.values(), len(texts)], dtype=np.int64, count=len(words))


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers in order as compressed bytes."""
    return _planes(np.diff(numbers.astype(np.uint64), prepend=np.uint64(0)))


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(_numbers(data, np.uint64), dtype=np.uint64)


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers of eight bytes, compressed: the first bytes of all, the second ones, and so on."""
    return _squeezed(np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 8).T).tobytes())


def _numbers(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(_unsqueezed(data), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def _squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "big") + pa.Codec("zstd").compress(data, asbytes=True)


def _unsqueezed(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "big")
    return pa.Codec("zstd").decompress(data[8:], size, asbytes=True) if size else b""


#: Rows of a chunk, and of a slice, in the order in which they are needed.
CODES, WORDS, TEXTS = 0, 1, 2
SHORT_PART, NODES_PART, CODES_PART = 0, 1, 2


def chunked(docs: DataFrame, slices: int) -> DataFrame:
    """The texts in chunks of about ``LOOKUP_BYTES``: ``chunk, kind, slice, data, ids``.

    A chunk has a row with its different codes for each slice, one with its different words in order, and its texts in
    rows of about ``CHUNK_BYTES``, packed.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, size = TaskContext.get().partitionId() << 32, 0
        codes: list[np.ndarray] = []
        words: set[bytes] = set()

        def row(what: int, number: int, data: bytes, ids: pa.Array) -> pa.RecordBatch:
            listed = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            columns = [pa.array([chunk], pa.int64()), pa.array([what], pa.int32()), pa.array([number], pa.int32()), pa.array([data], pa.binary()), listed]
            return pa.RecordBatch.from_arrays(columns, ["chunk", "kind", "slice", "data", "ids"])

        def passed_on(none: pa.Array) -> Iterator[pa.RecordBatch]:
            known = distinct(np.concatenate(codes))
            owner = _slices_of(known, slices)
            for number in range(slices):
                if len(mine := known[owner == number]):
                    yield row(CODES, number, packed(mine), none)
            yield row(WORDS, 0, _squeezed(b" ".join(sorted(words))), none)

        none = None
        for rows, texts in chunks(batches):
            texts = lowered(texts)
            codes.append(distinct(contexts(texts)[0]))
            if len(codes) > 4:
                codes[:] = [distinct(np.concatenate(codes))]
            for text in texts:
                words.update(text.split())
            none = rows.column(0).slice(0, 0)
            lengths = np.array([len(t) for t in texts], dtype=np.int64).tobytes()
            yield row(TEXTS, 0, _squeezed(lengths + b"".join(texts)), rows.column(0))
            size += sum(len(t) for t in texts)
            if size >= LOOKUP_BYTES:
                yield from passed_on(none)
                chunk, size = chunk + 1, 0
                codes.clear()
                words.clear()
        if codes:
            yield from passed_on(none)

    return docs.select("doc_id", "text").mapInArrow(run, f"chunk long, kind int, slice int, data binary, ids array<{kind}>")


def packed_nodes(nodes: DataFrame, slices: int, part: int) -> DataFrame:
    """``slice, part, chunk, data, more`` from ``code, n``: nodes of each slice, packed as far as they are read together.

    All nodes go to slice 0 where ``slices`` is 1.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def passed_on() -> Iterator[pa.RecordBatch]:
            codes, counts = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(codes)
            codes, counts = codes[order], counts[order]
            owner = _slices_of(codes, slices)
            for number in range(slices):
                mine = owner == number
                if mine.any():
                    columns = [[number], [part], [0], [packed(codes[mine])], [_planes(counts[mine].astype(np.int64))]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
                        ["slice", "part", "chunk", "data", "more"],
                    )
            held.clear()

        for batch in batches:
            held.append((batch.column(0).to_numpy().astype(np.uint64), batch.column(1).to_numpy()))
            if sum(len(codes) for codes, _ in held) >= HELD_CODES:
                yield from passed_on()
        if held:
            yield from passed_on()

    return nodes.select("code", "n").mapInArrow(run, "slice int, part int, chunk long, data binary, more binary")


def code_logs(counts: DataFrame, wanted: DataFrame, slices: int) -> DataFrame:
    """``chunk, data, more``: the packed codes of ``wanted`` (``slice, chunk, data``) and the log10 of their probabilities.

    The nodes are dealt to their slices with the codes that meet them, and scored there. The nodes of short contexts,
    at most 2^24 for any corpus, go to every slice.
    """
    nodes = counts.where("code IS NOT NULL").select("code", "n")
    short = nodes.groupBy(F.col("code").bitwiseAND(SHORT_NODES - 1).alias("code")).agg(F.sum("n").alias("n"))
    everywhere = packed_nodes(short, 1, SHORT_PART).withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    codes = wanted.select("slice", F.lit(CODES_PART).alias("part"), "chunk", "data", F.lit(None).cast("binary").alias("more"))
    met = packed_nodes(nodes, slices, NODES_PART).unionByName(everywhere).unionByName(codes)
    dealt = met.repartitionById(slices, F.col("slice")).sortWithinPartitions("part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {SHORT_PART: [], NODES_PART: []}
        trie: list[Level] | None = None
        for batch in batches:
            for i, part in enumerate(batch.column(1).to_pylist()):
                data = batch.column(3)[i].as_py()
                if part != CODES_PART:
                    parts[part].append((unpacked(data), _numbers(batch.column(4)[i].as_py(), np.int64)))
                    continue
                if trie is None:
                    nothing = (np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))
                    low, high = (added_up(*(np.concatenate(x) for x in zip(nothing, *parts[k], strict=True))) for k in (SHORT_PART, NODES_PART))
                    parts.clear()
                    trie = levels(*high, ORDER, levels(*low, SHORT, []))
                logs = log_probabilities(trie, unpacked(data))
                columns = [batch.column(2).slice(i, 1), batch.column(3).slice(i, 1), pa.array([_planes(logs)], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["chunk", "data", "more"])

    return dealt.mapInArrow(run, "chunk long, data binary, more binary")


def word_counts(known: DataFrame, lists: DataFrame) -> DataFrame:
    """``chunk, data, more``: which words of the packed lists the training texts have, by place, and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, chunk in enumerate(batch.column(0).to_pylist()):
                words = _unsqueezed(batch.column(1)[i].as_py()).split()
                columns = [pa.array([chunk] * len(words), pa.int64()), pa.array(range(len(words)), pa.int32()), pa.array(words, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["chunk", "at", "word"])

    listed = lists.select("chunk", "data").mapInArrow(run, "chunk long, at int, word string")
    counted = known.select(F.col("word").alias("__word"), F.col("n").alias("c"))
    found = listed.join(counted, F.col("word") == F.col("__word")).select("chunk", "at", "c")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def passed_on() -> Iterator[pa.RecordBatch]:
            chunk, at, c = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((at, chunk))
            chunk, at, c = chunk[order], at[order], c[order]
            cuts = np.flatnonzero(np.diff(chunk, prepend=chunk[:1] - 1))
            for i, j in zip(cuts, [*cuts[1:], len(chunk)], strict=True):
                columns = [pa.array([chunk[i]], pa.int64()), pa.array([packed(at[i:j])], pa.binary()), pa.array([_planes(c[i:j])], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["chunk", "data", "more"])
            held.clear()

        rows = 0
        for batch in batches:
            held.append([column.to_numpy() for column in batch.columns])
            rows += len(batch)
            if rows >= HELD_CODES:
                yield from passed_on()
                rows = 0
        if rows:
            yield from passed_on()

    return found.mapInArrow(pack, "chunk long, data binary, more binary")


class Lookup:
    """Logs of the codes of a chunk and counts of its words, filled before its texts come."""

    def __init__(self):
        self.codes: list[np.ndarray] = [np.zeros(0, dtype=np.uint64)]
        self.logs: list[np.ndarray] = [np.zeros(0)]
        self.at: list[np.ndarray] = [np.zeros(0, dtype=np.uint64)]
        self.c: list[np.ndarray] = [np.zeros(0, dtype=np.int64)]
        self.words: list[bytes] = []
        self.ready = False

    def fill(self) -> None:
        if self.ready:
            return
        codes, logs = np.concatenate(self.codes), np.concatenate(self.logs)
        order = np.argsort(codes)
        self.known, self.values = codes[order], logs[order]
        counts = np.zeros(len(self.words), dtype=np.int64)
        counts[np.concatenate(self.at).astype(np.int64)] = np.concatenate(self.c)
        self.counts = dict(zip(self.words, counts.tolist(), strict=True))
        self.ready = True

    def scores(self, texts: list[bytes], ends: int) -> tuple[np.ndarray, ...]:
        """For each text: words and end, those known, log10 of their counts and one, log10 of its probability."""
        self.fill()
        codes, starts = contexts(texts)
        score = np.add.reduceat(_spread(self.known, self.values, codes), starts)
        words = [t.split() for t in texts]
        sizes = np.array([len(w) + 1 for w in words], dtype=np.int64)
        counts = np.full(int(sizes.sum()), ends, dtype=np.int64)
        inside = np.ones(len(counts), dtype=bool)
        inside[np.cumsum(sizes) - 1] = False
        counts[inside] = np.fromiter(map(self.counts.__getitem__, chain.from_iterable(words)), dtype=np.int64, count=len(counts) - len(texts))
        first = np.cumsum(sizes) - sizes
        logs = np.add.reduceat(np.log10(counts + 1.0), first)
        return sizes, np.add.reduceat((counts > 0).astype(np.int64), first), logs, score


def score_texts(docs: DataFrame, counts: DataFrame, slice_nodes: int = SLICE_NODES) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, n_known, train_tokens, base_score, score``.

    ``counts`` comes from ``train``. ``base_score`` adds up log10((c + 1) / (N + V + 1)) over the words and the end of
    the text, ``score`` is the log10 probability of the lower-cased text, end included, under the trie. Neither
    words nor nodes are ever in one place: the different codes and words of each chunk of texts are sent to the slices
    of about ``slice_nodes`` nodes and to the counts, and what is found there meets the texts again. A null or empty
    text has its end only. Repeated rows are scored each; a null ``doc_id`` stays null. Other columns are neither read
    nor returned. Without training text every byte has the same probability.
    Texts of any length are scored whole; an empty table gives no rows.
    """
    known = counts.where("word IS NOT NULL")
    ended = F.coalesce(F.sum(F.when(F.col("word") == END_WORD, F.col("n"))), F.lit(0)).alias("ends")
    total = known.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v"), ended).first()
    ends = total["ends"]
    # At least as many slices as tasks run at once.
    slices = max(-(-counts.where("code IS NOT NULL").count() // slice_nodes), docs.sparkSession.sparkContext.defaultParallelism)
    parts = kept_once(chunked(docs, slices))
    ids = parts.schema["ids"].dataType.simpleString()

    def as_rows(rows: DataFrame, kind: int) -> DataFrame:
        types = {"data": "binary", "more": "binary", "ids": ids}
        filled = [F.col(c) if c in rows.columns else F.lit(None).cast(t).alias(c) for c, t in types.items()]
        return rows.select("chunk", F.lit(kind).alias("kind"), *filled)

    lists, texts = parts.where(F.col("kind") == WORDS).select("chunk", "data"), parts.where(F.col("kind") == TEXTS).select("chunk", "data", "ids")
    logs = code_logs(counts, parts.where(F.col("kind") == CODES), slices)
    back = as_rows(logs, CODES).union(as_rows(lists, WORDS)).union(as_rows(word_counts(known, lists), WORDS)).union(as_rows(texts, TEXTS))
    met = back.repartition("chunk").sortWithinPartitions("chunk", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_hand, lookup = None, Lookup()
        for batch in batches:
            for i, (chunk, kind) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                if chunk != at_hand:
                    at_hand, lookup = chunk, Lookup()
                data, more = batch.column(2)[i].as_py(), batch.column(3)[i].as_py()
                if kind == CODES:
                    lookup.codes.append(unpacked(data))
                    lookup.logs.append(_numbers(more, np.float64))
                elif kind == WORDS and more is None:
                    lookup.words = _unsqueezed(data).split()
                elif kind == WORDS:
                    lookup.at.append(unpacked(data))
                    lookup.c.append(_numbers(more, np.int64))
                else:
                    doc_ids = batch.column(4).slice(i, 1).flatten()
                    data = _unsqueezed(data)
                    sizes = np.frombuffer(data[: 8 * len(doc_ids)], dtype=np.int64)
                    stops = 8 * len(doc_ids) + np.cumsum(sizes)
                    found = lookup.scores([data[e - n : e] for e, n in zip(stops.tolist(), sizes.tolist(), strict=True)], ends)
                    yield pa.RecordBatch.from_arrays([doc_ids, *(pa.array(x) for x in found)], ["doc_id", "n_tokens", "n_known", "__logs", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = met.mapInArrow(run, f"doc_id {kind}, n_tokens long, n_known long, __logs double, score double")
    base = F.col("__logs") - F.col("n_tokens") * F.lit(math.log10(total["n"] + total["v"] + 1))
    return scored.select(
        "doc_id", "n_tokens", "n_known", F.lit(total["n"]).cast("bigint").alias("train_tokens"), base.alias("base_score"), "score"
    )


def trained(docs: DataFrame) -> DataFrame:
    """The counts of ``train``, kept in the shared folder, as scoring reads them several times."""
    return kept_once(train(docs))
