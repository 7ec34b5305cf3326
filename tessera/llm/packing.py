"""Best-fit packing of documents into token sequences (operator 7).

Bounded-space online best-fit: a packing task keeps a fixed number of open
sequences in a bitset keyed by free space.  A piece goes to the open sequence
with the least free space that still holds it, found by one shift and one
lowest-set-bit; if none does, a new sequence opens, and beyond the bound the
fullest one closes first.

Tokens are made where the document stands, and only lengths and checksums are
shuffled.  Tokenisation is by word: the tokenizer drops white space and never
looks across it, so a distinct word is encoded once per worker and its ids are
reused, from a cache of bounded size.  The pieces are dealt to packing tasks
of about ``task_pieces`` each, by hash, so their number grows with the data and a task's
memory is bounded by its open sequences.

Cases: null text is an empty document, of the end token alone.  Repeated rows are
packed one by one; pieces that share id, piece and checksum get a place each.
A document longer than a sequence is cut, its last piece may be shorter.  An empty table
gives no pieces.  Null ids are packed like any other.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import pairwise
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bound_batches, claim, materialize, release

CAPACITY = 4096
END = 1
OPEN = 2048
TASK_PIECES = 200_000
GROUP_BYTES = 8 << 20
CACHE_WORDS = 800_000
CACHE_LETTERS = 900_000

_tokenizers: dict[str, "WordEncoder"] = {}


#: Words of these letters are one unit to the tokenizer, and so is the punctuation that may follow them.
_LETTERS = re.compile("[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
_PUNCT = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class _Cache:
    """A bounded map in two generations: when the young one is full it becomes the old one, and what is used again returns."""

    def __init__(self, bound: int):
        self.bound, self.young, self.old = bound // 2, {}, {}

    def missing(self, keys: set) -> list:
        """Keys that are in neither generation; those of the old one move to the young."""
        if len(self.young) > self.bound:
            self.young, self.old = {}, self.young
        new = []
        for k in keys.difference(self.young):
            value = self.old.get(k)
            if value is None:
                new.append(k)
            else:
                self.young[k] = value
        return new


class WordEncoder:
    """Ids of whole texts as little-endian 32-bit bytes, from a cache of encoded words.

    A word of plain letters with punctuation after it shares the ids of the letters, in lower case, with other such
    words; letters new to the cache are encoded many at a time.  Any other word is encoded by itself.
    """

    def __init__(self, path: str, words: int = CACHE_WORDS, letters: int = CACHE_LETTERS):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.words, self.letters = _Cache(words), _Cache(letters)
        #: Whether an id ends a unit.
        self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.last[i] = token.endswith("</w>")

    @classmethod
    def of(cls, path: str, words: int, letters: int) -> "WordEncoder":
        key = f"{path} {words} {letters}"
        if key not in _tokenizers:
            _tokenizers.clear()
            _tokenizers[key] = cls(path, words, letters)
        return _tokenizers[key]

    def _each(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, words: list[str]) -> list[bytes]:
        """Of words that are one unit each."""
        out = []
        for i in range(0, len(words), 512):
            part = words[i : i + 512]
            e = self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0]
            ids = np.array(e.ids, "<u4")
            cut, raw = [0, *(np.flatnonzero(self.last[ids]) + 1).tolist()], ids.tobytes()
            out += [raw[4 * a : 4 * b] for a, b in pairwise(cut)] if len(cut) == len(part) + 1 else self._each(part)
        return out

    def _learn(self, distinct: set[bytes]) -> None:
        new, known, fits = self.words.missing(distinct), self.words.young, _LETTERS.fullmatch
        whole, plain, lower, after = [], [], [], []
        for w in new:
            core = w.rstrip(_PUNCT)
            text = core.decode()
            if fits(text):
                plain.append(w), lower.append(text.lower()), after.append(w[len(core) :])
            else:
                whole.append(w)
        for i in range(0, len(whole), 4096):
            part = whole[i : i + 4096]
            known.update(zip(part, self._each([w.decode() for w in part]), strict=True))
        letters = self.letters.missing(set(lower))
        self.letters.young.update(zip(letters, self._together(letters), strict=True))
        tails = [t for t in set(after) if t]
        tail = dict(zip(tails, self._each([t.decode() for t in tails]), strict=True)) | {b"": b""}
        known.update(zip(plain, map(add, map(self.letters.young.__getitem__, lower), map(tail.__getitem__, after)), strict=True))

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        split = [(t if b"<|" in t else t.lower()).split() for t in texts]  # special tokens are told by case, all else is lower-cased
        self._learn(set().union(*split))
        find = self.words.young.__getitem__
        for words in split:
            yield b"".join(map(find, words))


def _groups(batches: Iterator[pa.RecordBatch], group_bytes: int) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """(ids, texts) of rows put together until their texts have group_bytes; no more than that and one text."""
    ids, texts, size = [], [], 0
    for batch in batches:
        begin = 0
        for end, text in enumerate(batch.column(1).cast(pa.large_binary()), 1):
            texts.append(text.as_py() or b"")
            size += len(texts[-1])
            if size >= group_bytes:
                yield pa.concat_arrays([*ids, batch.column(0)[begin:end]]), texts
                ids, texts, size, begin = [], [], 0, end
        ids.append(batch.column(0)[begin:])
    if texts:
        yield pa.concat_arrays(ids), texts


def pieces(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END,
           ids: bool = False, cache_words: int = CACHE_WORDS, cache_letters: int = CACHE_LETTERS, keep_cache: bool = True,
           group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Pieces of every document: id, piece, start, length, ids_crc32 (and, with ids=True, the ids as binary).

    The caches (about 150 bytes an entry) and group_bytes (texts split into words at a time, about ten times as large then)
    bound a worker's memory, not its results; without keep_cache a worker forgets the caches after each task.
    """
    bound_batches(docs.sparkSession)
    tail = np.array([end], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("packing", _tokenizers.clear)
        encoder = WordEncoder.of(tokenizer, cache_words, cache_letters)
        for names, texts in _groups(batches, group_bytes):
            where, piece, start, length, crc, held = [], [], [], [], [], []
            coded = (c + tail for c in encoder.encode(texts))
            for i, tokens in enumerate(coded):
                for k, at in enumerate(range(0, len(tokens), 4 * capacity)):
                    part = tokens[at : at + 4 * capacity]
                    where.append(i), piece.append(k), start.append(at // 4), length.append(len(part) // 4), crc.append(zlib.crc32(part))
                    if ids:
                        held.append(part)
            columns = [names.take(pa.array(where, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(held, pa.binary())] * ids, names=["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * ids)
        if not keep_cache:
            _tokenizers.clear()
        del encoder
        release()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * ids)


class BestFit:
    """Bounded-space best-fit; place() gives (sequence, offset)."""

    def __init__(self, capacity: int, bound: int):
        self.capacity, self.bound = capacity, bound
        self.bits, self.open, self.by_free, self.made = 0, 0, [[] for _ in range(capacity + 1)], 0

    def _take(self, free: int) -> int:
        held = self.by_free[free]
        sequence = held.pop()
        self.open -= 1
        if not held:
            self.bits ^= 1 << free
        return sequence

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            sequence = self._take(free)
        else:
            sequence, free, self.made = self.made, self.capacity, self.made + 1
        left = free - length
        if left:
            self.by_free[left].append(sequence)
            self.bits |= 1 << left
            self.open += 1
            if self.open > self.bound:  # the fullest closes first
                self._take((self.bits & -self.bits).bit_length() - 1)
        return sequence, self.capacity - free


def pack(cut: DataFrame, *, capacity: int = CAPACITY, open_sequences: int = OPEN, task_pieces: int = TASK_PIECES, seed: int = 7) -> DataFrame:
    """A written table of pieces with sequence_id and offset.  A column ``row``, if there is one, tells repeated rows apart, which are then dealt apart."""
    tasks = max(1, -(-cut.count() // task_pieces))
    order = F.xxhash64("id", "piece", F.lit(seed), *(["row"] if "row" in cut.columns else []))
    dealt = cut.withColumn("task", F.pmod(order, F.lit(tasks)).cast("long")).withColumn("order", order).drop("row")
    dealt = dealt.repartitionById(tasks, F.col("task").cast("int")).sortWithinPartitions("task", "order", "id", "piece", "ids_crc32")
    cut = cut.drop("row")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, packer = None, None
        for batch in batches:
            tasks_of, lengths = batch.column("task").to_pylist(), batch.column("length").to_pylist()
            sequence, offset = [], []
            for t, n in zip(tasks_of, lengths, strict=True):
                if t != task:
                    task, packer = t, BestFit(capacity, open_sequences)
                s, o = packer.place(n)
                sequence.append((t << 40) + s), offset.append(o)
            kept = batch.select([c for c in batch.schema.names if c not in ("task", "order")])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=[*kept.schema.names, "sequence_id", "offset"])

    kinds = ", ".join(f"`{c}` {k}" for c, k in cut.dtypes)
    return dealt.mapInArrow(fit, f"{kinds}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END,
                   ids: bool = False, cache_words: int = CACHE_WORDS, cache_letters: int = CACHE_LETTERS, keep_cache: bool = True,
                   group_bytes: int = GROUP_BYTES, **options: int) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    cut = materialize(pieces(docs, tokenizer, id_col=id_col, text_col=text_col, capacity=capacity, end=end, ids=ids,
                             cache_words=cache_words, cache_letters=cache_letters, keep_cache=keep_cache, group_bytes=group_bytes)
                      .withColumn("row", F.monotonically_increasing_id()), "pack-pieces")
    return pack(cut, capacity=capacity, **options)


def sequences(packed: DataFrame) -> DataFrame:
    """Whole sequences from pieces packed with ids=True: sequence_id, n_tokens, ids (binary, little-endian 32-bit).  A sequence has a bounded size."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
