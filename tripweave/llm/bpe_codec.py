"""BPE encoding and decoding (operator 4).

Encoding is a backtracking search instead of repeated merging.  An Aho-Corasick
automaton over all tokens gives the longest token at each place of a word.  The
encoder takes the longest token, and keeps it if it is compatible with the token
before it: two neighbours are compatible if BPE, run on their joined bytes,
leaves exactly these two.  Otherwise it tries the next shorter prefix token, and
if none is left it withdraws the token before.  A place that was withdrawn is
marked and never tried again, so each place is left once: linear time.  The
result is exactly that of applying the merges in rank order.

Compatibility needs no merging: undo the merges of both tokens from the latest
to the earliest and see whether some merge would have joined the two sides
earlier.  Answers are kept in a pair table.

Decoding gathers the bytes of all tokens through one offset table.

Rows: a null text is an empty text (no tokens); doc_id may be null or repeated;
one row in, one row out, in any order; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import prepare, record_batch, text_slices
from tripweave.llm.token_cache import ChunkIds, tokenizer_text

#: Fixed value: the split pattern of this family of byte-level vocabularies.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level
    vocabulary: visible Latin-1 characters stand for themselves, the others are
    numbered from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    letter = {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letter[b] for b in range(256)]


class BpeCodec:
    """Encoder and decoder of one byte-level BPE file."""

    def __init__(self, tokenizer_json: str):
        import ahocorasick

        spec = json.loads(tokenizer_json)
        vocab: dict[str, int] = spec["model"]["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        letters = byte_letters()
        self.letter = dict(enumerate(letters))
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        # tokens are numbered by age here: bytes first, then merges by rank
        self.tokens: list[str] = list(letters)
        age = {t: i for i, t in enumerate(self.tokens)}
        self.halves: list[tuple[int, int]] = [(i, i) for i in range(256)]
        self.joined: dict[tuple[int, int], int] = {}
        for left, right in merges:
            pair = (age[left], age[right])
            whole = age.get(left + right)
            if whole is None:
                whole = age[left + right] = len(self.tokens)
                self.tokens.append(left + right)
                self.halves.append(pair)
            self.joined.setdefault(pair, whole)
        self.id_of = [vocab[t] for t in self.tokens]
        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate(self.tokens):
            self.automaton.add_word(t, i)
        self.automaton.make_automaton()
        # next shorter token that is a prefix of each token
        self.shorter = [-1] * len(self.tokens)
        for i, t in enumerate(self.tokens):
            for n in range(len(t) - 1, 0, -1):
                if (p := age.get(t[:n])) is not None:
                    self.shorter[i] = p
                    break
        self.pairs: dict[tuple[int, int], bool] = {}
        self.recent: dict[str, list[int]] = {}
        self.words = regex.compile(SPLIT)
        self.parts = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        # offset table: bytes of token id k are blob[starts[k]:starts[k + 1]]
        back = {c: b for b, c in enumerate(letters)}
        raw = {i: bytes(back[c] for c in t) for t, i in vocab.items()}
        raw |= {i: t.encode() for t, i in self.special.items()}
        table = [raw.get(i, b"") for i in range(max(raw) + 1)]
        self.blob, self.starts = _table(table)
        # the same for the decimal digits of an id and a comma
        self.digits, self.digit_starts = _table([b"%d," % i for i in range(len(table))])

    def compatible(self, left: int, right: int) -> bool:
        """Whether BPE keeps the cut between these two tokens."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= 1_000_000:   # bounds the memory only
                self.pairs.clear()
            known = self.pairs[left, right] = self._cut_holds(left, right)
        return known

    def _cut_holds(self, a: int, b: int) -> bool:
        # a and b are the tokens beside the cut at some moment of the merging,
        # walked backwards in time; `before` is the age of the latest merge undone
        before = len(self.tokens)
        while True:
            merge = self.joined.get((a, b))
            if merge is not None and merge < before:
                return False
            # undo the younger of the two; equal ages: the right one was made
            # later, as merges of one rank run from left to right
            if a > b:
                if a < 256:
                    return True
                before, a = a, self.halves[a][1]
            else:
                if b < 256:
                    return True
                before, b = b + 1, self.halves[b][0]

    def encode_word(self, word: str) -> list[int]:
        """Ids of one split word, given in byte letters."""
        n = len(word)
        longest = [-1] * n
        tokens = self.tokens
        for end, t in self.automaton.iter(word):
            start = end + 1 - len(tokens[t])
            if longest[start] < 0 or len(tokens[t]) > len(tokens[longest[start]]):
                longest[start] = t
        open_at = [True] * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while True:
            end = at + len(tokens[token])
            if open_at[end] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                if end == n:
                    return [self.id_of[t] for t in out]
                at, token = end, longest[end]
                continue
            if self.shorter[token] >= 0:
                token = self.shorter[token]
                continue
            # nothing fits here: never end a token here again, and shorten the one before
            open_at[at] = False
            token = out.pop()
            at -= len(tokens[token])

    def encode_chunk(self, text: str) -> list[int]:
        ids: list[int] = []
        for part in self.parts.split(text) if self.parts else [text]:
            if part in self.special:
                ids.append(self.special[part])
                continue
            for word in self.words.findall(part):
                ids += self._cached(word)
        return ids

    def _cached(self, word: str) -> list[int]:
        recent = self.recent
        ids = recent.get(word)
        if ids is None:
            ids = self.encode_word("".join(map(self.letter.__getitem__, word.encode("utf-8", "surrogatepass"))))
            if len(word) <= 32:
                if len(recent) >= 200_000:   # bounds the memory only
                    recent.clear()
                recent[word] = ids
        return ids

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return _gather(self.blob, self.starts, ids)

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def decimal(self, ids: np.ndarray) -> bytes:
        return _gather(self.digits, self.digit_starts, ids)[:-1]


def _table(entries: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    starts = np.zeros(len(entries) + 1, np.int64)
    np.cumsum([len(e) for e in entries], out=starts[1:])
    return np.frombuffer(b"".join(entries), np.uint8), starts


def _gather(blob: np.ndarray, starts: np.ndarray, ids: np.ndarray) -> bytes:
    """Concatenated entries ``ids`` of a table, without a loop."""
    if not len(ids):
        return b""
    first = starts[ids]
    sizes = starts[ids + 1] - first
    ends = np.cumsum(sizes)
    shift = first - (ends - sizes)
    return blob[np.arange(ends[-1]) + np.repeat(shift, sizes)].tobytes()


_CODECS: dict[int, tuple[BpeCodec, ChunkIds]] = {}


def codec(tokenizer_json: str) -> tuple[BpeCodec, ChunkIds]:
    """The codec and its chunk cache, one of each per worker process and file."""
    key = hash(tokenizer_json)
    if key not in _CODECS:
        own = BpeCodec(tokenizer_json)
        _CODECS[key] = own, ChunkIds(own.encode_chunk)
    return _CODECS[key]


def encode(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>) of each whole text."""
    spark = docs.sparkSession
    prepare(spark)
    spec = spark.sparkContext.broadcast(tokenizer_text(tokenizer_path))
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, cache = codec(spec.value)
        for doc_ids, texts in text_slices(batches, ("doc_id",)):
            packed = [cache.packed(t) for t in texts]
            ends = np.cumsum([0, *(len(p) // 4 for p in packed)]).astype(np.int32)
            flat = pa.array(np.frombuffer(b"".join(packed), "<i4"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), flat)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); bytes that are no UTF-8 become U+FFFD."""
    spark = encoded.sparkSession
    spec = spark.sparkContext.broadcast(tokenizer_text(tokenizer_path))
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, _ = codec(spec.value)
        for batch in batches:
            yield record_batch({"doc_id": batch.column("doc_id"),
                                "text": [own.decode(i) for i in _id_arrays(batch.column("ids"))]}, schema)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(encoded: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) from (doc_id, ids)."""
    spark = encoded.sparkSession
    spec = spark.sparkContext.broadcast(tokenizer_text(tokenizer_path))
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, _ = codec(spec.value)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            arrays = _id_arrays(batch.column("ids"))
            yield record_batch({
                "doc_id": batch.column("doc_id"), "n_tokens": [len(a) for a in arrays],
                "ids_sha256": [sha(own.decimal(a)) for a in arrays],
                "decoded_sha256": [sha(own.decode(a).encode()) for a in arrays]}, schema)

    return (encoded.select("doc_id", "ids")
            .mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))


def _id_arrays(column: pa.ListArray) -> list[np.ndarray]:
    flat = np.asarray(column.flatten())
    ends = np.cumsum(np.asarray(column.value_lengths().fill_null(0)))
    return np.split(flat, ends[:-1]) if len(ends) else []
