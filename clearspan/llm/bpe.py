"""Byte-level BPE, encoded exactly by dynamic programming over prefixes.

Every prefix of a piece of text has one last token in its BPE encoding. An automaton finds the tokens that
end at each byte; of these, the last token is the one that may follow the last token of the prefix before
it, which depends on the two tokens alone. Following the last tokens back gives the encoding, without
merging step by step.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Fixed value: how byte-level BPE splits text into pieces; white space by the Unicode property.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: Pieces up to this many characters are remembered, twice so many of them at most per worker process.
CACHED_CHARS, CACHED_PIECES = 48, 200_000
CACHED_PAIRS = 250_000
#: Characters of text, and tokens, that one result batch holds about.
BATCH_CHARS, BATCH_TOKENS = 2_000_000, 1_000_000

NEVER = 1 << 60


def byte_of_char() -> dict[str, int]:
    """The characters that stand for bytes in vocabulary files: printable Latin-1 ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Pieces(dict):
    """Encodings of the pieces met lately. When full, the older half is dropped; what is asked for again stays."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.older = encode, {}

    def __missing__(self, piece: str) -> bytes:
        found = self.older.get(piece)
        if found is None:
            found = self.encode(piece)
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = found
        return found


class Vocabulary:
    """Tokens, merges and added tokens of a byte-level BPE file of the tokenizers library."""

    def __init__(self, file: str):
        content = json.loads(file)
        model, to_byte = content["model"], byte_of_char()
        if model["type"] != "BPE" or content["pre_tokenizer"]["type"] != "ByteLevel" or content["normalizer"]:
            raise ValueError("the file is no plain byte-level BPE")
        self.added = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.bytes_of = {i: bytes(to_byte[c] for c in token) for token, i in model["vocab"].items() if token not in self.added}
        by_text = {v: k for k, v in self.bytes_of.items()}
        self.pair_rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {i: -1 for i in self.bytes_of}
        for rank, (left, right) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            a, b = (by_text[bytes(to_byte[c] for c in part)] for part in (left, right))
            whole = by_text[self.bytes_of[a] + self.bytes_of[b]]
            if whole in self.parts:
                raise ValueError("two merges make one token")
            self.pair_rank[a, b], self.parts[whole], self.rank[whole] = rank, (a, b), rank
        self.follows: dict[int, bool] = {}
        self.cache = Pieces(self.encode_piece)
        self.automaton = self._automaton()
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.pieces = regex.compile(PATTERN)
        size = max([*self.bytes_of, *self.added.values()], default=-1) + 1
        texts = [b""] * size
        for i, data in [*self.bytes_of.items(), *((i, t.encode()) for t, i in self.added.items())]:
            texts[i] = data
        self.lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.table = np.frombuffer(b"".join(texts), dtype=np.uint8)

    def _automaton(self) -> ahocorasick.Automaton:
        """Finds the tokens that end at each byte. Tokens that merging never makes of their own bytes are left out."""
        made: dict[int, bool] = {}
        for token in sorted(self.bytes_of, key=self.rank.__getitem__):
            if token in self.parts:
                a, b = self.parts[token]
                made[token] = made[a] and made[b] and not self._merges_across(a, b, self.rank[token])
            else:
                made[token] = len(self.bytes_of[token]) == 1
        found = ahocorasick.Automaton()
        #: A piece that is the bytes of one such token is that token.
        self.whole = {data: array("i", [token]).tobytes() for token, data in self.bytes_of.items() if made[token]}
        if any(bytes([b]) not in self.whole for b in range(256)):
            raise ValueError("the vocabulary does not hold every byte")
        for token, data in self.bytes_of.items():
            if made[token]:
                found.add_word(data.decode("latin-1"), (token, len(data)))
        found.make_automaton()
        return found

    def _merges_across(self, left: int, right: int, last: int = NEVER) -> bool:
        """Whether merging joins a part of ``left`` to a part of ``right`` before merge number ``last``.

        Goes back in time: of the two tokens that touch at the border, the one made later is taken apart.
        Two that touch are joined if their merge comes before the merge that took either of them up; of equal
        merges the one further left comes first.
        """
        left_until = right_until = last
        while True:
            rank = self.pair_rank.get((left, right), NEVER)
            if rank < left_until and rank <= right_until and rank != last:
                return True
            if self.rank[left] > self.rank[right]:
                left_until, left = self.rank[left], self.parts[left][1]
            elif self.rank[right] >= 0:
                right_until, right = self.rank[right], self.parts[right][0]
            else:
                return False

    def forget(self) -> None:
        """Drop the older half of the remembered pieces: a worker process outlives its task."""
        self.cache.older = {}

    def may_follow(self, left: int, right: int) -> bool:
        """Whether two tokens side by side stay as they are."""
        if len(self.follows) >= CACHED_PAIRS:
            self.follows.clear()
        known = self.follows[left << 32 | right] = not self._merges_across(left, right)
        return known

    def encode_piece(self, piece: str) -> bytes:
        """Token ids of one piece, as packed 32-bit numbers."""
        data = piece.encode("utf-8")
        if data in self.whole:
            return self.whole[data]
        last, length = [-1] * (len(data) + 1), [0] * (len(data) + 1)
        known, done = self.follows.get, -1
        for end, (token, size) in self.automaton.iter(data.decode("latin-1")):
            if end == done:
                continue  # the last token of this prefix is known already
            # As single bytes are tokens, every shorter prefix has its last token.
            before = last[end + 1 - size]
            fits = before < 0 or known(before << 32 | token)
            if fits is None:
                fits = self.may_follow(before, token)
            if fits:
                last[end + 1], length[end + 1], done = token, size, end
        ids, at = [], len(data)
        while at > 0:
            ids.append(last[at])
            at -= length[at]
        ids.reverse()
        return array("i", ids).tobytes()

    def encode(self, text: str) -> np.ndarray:
        parts = self.split_added.split(text) if self.split_added else [text]
        out = []
        for part in parts:
            if part in self.added:
                out.append(np.int32(self.added[part]).tobytes())
            elif part:
                out.extend(map(self.cache.__getitem__, self.pieces.findall(part)))
        return np.frombuffer(b"".join(out), dtype=np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the tokens in a row; ids outside the vocabulary raise."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.lengths)):
            raise ValueError("an id is not in the vocabulary")
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.starts[ids] - (ends - sizes), sizes)
        return self.table[at].tobytes()


_LOADED: dict[int, Vocabulary] = {}


def loaded(shared) -> Vocabulary:
    """The vocabulary of a broadcast file, built once per worker process."""
    if shared.id not in _LOADED:
        _LOADED.clear()
        _LOADED[shared.id] = Vocabulary(shared.value)
    return _LOADED[shared.id]


class _Shared:
    """A broadcast with the number that tells it from others in a worker."""

    def __init__(self, broadcast):
        self.broadcast, self.id = broadcast, broadcast._jbroadcast.id()

    @property
    def value(self):
        return self.broadcast.value

    def __getstate__(self):
        return {"broadcast": self.broadcast, "id": self.id}


def _vocabulary(df: DataFrame, path: str) -> _Shared:
    """Read on the driver and sent to all workers; a vocabulary file has one bounded size."""
    with open(path, encoding="utf-8") as file:
        return _Shared(df.sparkSession.sparkContext.broadcast(file.read()))


def _lists(ids: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))


def _portions(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[str]]]:
    """Keys and texts of a batch (``doc_id, text``), about ``BATCH_CHARS`` characters at a time; a null text is empty."""
    start, size, held = 0, 0, []
    texts = batch.column(1)
    for row in range(len(batch)):
        held.append(texts[row].as_py() or "")
        size += len(held[-1])
        if size >= BATCH_CHARS or row == len(batch) - 1:
            yield batch.column(0).slice(start, len(held)), held
            start, size, held = row + 1, 0, []


_IDS = T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)
_TEXT = T.StructField("text", T.StringType(), False)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: ``doc_id, ids`` (array of int), for the whole text.

    ``path`` names a byte-level BPE file of the tokenizers library. The ids are those of the library
    without added special tokens; a special token's own text is encoded as that token. A null or empty text
    has no ids. Rows are encoded one by one, repeated ones alike; a null ``doc_id`` stays null. Other
    columns are neither read nor returned.
    """
    shared = _vocabulary(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = loaded(shared)
        for batch in batches:
            for keys, texts in _portions(batch):
                ids = [vocabulary.encode(t) for t in texts]
                yield pa.RecordBatch.from_arrays([keys, _lists(ids)], ["doc_id", "ids"])
        vocabulary.forget()

    schema = T.StructType([docs.schema["doc_id"], _IDS])
    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, text``: what ``encode`` and then ``decode`` give, in one pass through the workers.

    Chained, the two would each need a worker process with the vocabulary per task. Null and empty texts have no ids, texts
    of any length are encoded whole, repeated rows each; an empty table gives no rows.
    """
    shared = _vocabulary(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = loaded(shared)
        for batch in batches:
            for keys, texts in _portions(batch):
                ids = [vocabulary.encode(t) for t in texts]
                back = [vocabulary.decode(i).decode("utf-8", "replace") for i in ids]
                yield pa.RecordBatch.from_arrays([keys, _lists(ids), pa.array(back, pa.string())], ["doc_id", "ids", "text"])
        vocabulary.forget()

    schema = T.StructType([docs.schema["doc_id"], _IDS, _TEXT])
    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (``doc_id, ids``) with the column ``text``: the bytes of all ids, special ones included, as UTF-8.

    Bytes that are no UTF-8 become U+FFFD; null ids give an empty text; ids outside the vocabulary raise.
    """
    shared = _vocabulary(encoded, path)
    schema = T.StructType([encoded.schema["doc_id"], encoded.schema["ids"], _TEXT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = loaded(shared)
        for batch in batches:
            start, size, held = 0, 0, []
            lists = batch.column(1)
            for row in range(len(batch)):
                values = lists[row].values
                ids = np.zeros(0, dtype=np.int32) if values is None else values.to_numpy(zero_copy_only=False)
                held.append(vocabulary.decode(ids).decode("utf-8", "replace"))
                size += len(ids)
                if size >= BATCH_TOKENS or row == len(batch) - 1:
                    kept = batch.slice(start, len(held))
                    yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), pa.array(held, pa.string())], ["doc_id", "ids", "text"])
                    start, size, held = row + 1, 0, []

    return encoded.select("doc_id", "ids").mapInArrow(run, schema)
